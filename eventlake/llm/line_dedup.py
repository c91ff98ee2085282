"""Line deduplication by a suffix array over sequences of line ids.

All documents' lines in a row are one long sequence; its suffixes are ordered by prefix doubling: round k ranks every
place by the 2**k lines from there on, as the rank of a pair of earlier ranks, until the longest span that matters is covered.
Two suffixes share m lines, 2**k <= m < 2**(k + 1), exactly if their ranks of round k agree at the place itself and at m - 2**k
lines on, so the places with one such pair are one longest-common-prefix interval of at least m lines. The first place
of an interval stays, all others are later copies.

A repeated run counts from MIN_WORDS words on. Whatever run of that size repeats, each of its lines lies in the shortest span of
that size that starts at it or that ends with the run, and these spans have the same length wherever their lines
occur. So the intervals of all shortest spans, both ways, find all repeated runs; overlapping ones are put together
to maximal runs, which are deleted.

Plan, plain DataFrame operations throughout: lines that occur once can be in no repeated run, so only lines with a second
occurrence are ranked, and the others part the sequence. Counts are combined before they are shuffled; a line, a pair of
ranks or an interval with a third of all places is met only in joins, which adaptive execution can split, and in
aggregates. A round's ranks come from one sort of the distinct pairs. What several steps read is written to the shared folder.

Edge cases: a null text stays null; an empty one has one empty line; order is by ``doc_id`` (null last), then text key, then line,
and copies within a document count; rows repeated with id and text are one document, and each is returned; blank lines have no
words but are part of runs; a run that overlaps its own copy leaves the part before the overlap; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm import common as C

MIN_WORDS = 51
_DOC = ["doc_id", "text_key"]
#: Words of a line lie between white space of any kind: blanks, tabs, no-break and wide spaces.
_SPACE = r"(?U)\s+"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _ordered(rows: DataFrame, *columns: str) -> DataFrame:
    """Number rows in the order of the columns; ids rise with the order and are not dense."""
    return rows.orderBy(*columns).withColumn("rank", F.monotonically_increasing_id())


def repeated_lines(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, line_no, words, pos, block, rank`` of every line that occurs at least twice.

    ``pos`` rises in document order, by one from line to line of a ``block`` of neighbouring lines.
    """
    split = documents.select("doc_id", C.text_key(F.col("text")).alias("text_key"), F.posexplode(_lines(F.col("text"))))
    lines = C.stored(
        split.select(
            *_DOC,
            F.col("pos").alias("line_no"),
            F.xxhash64("col").alias("h1"),
            F.xxhash64(F.lit(1), "col").alias("h2"),
            F.size(F.array_remove(F.split("col", _SPACE), "")).alias("words"),
        ),
        "lines",
    )
    repeated = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    ids = C.stored(_ordered(repeated, "h1", "h2"), "line-ids")
    places = lines.join(ids, ["h1", "h2"]).select(*_DOC, "line_no", "words", "rank").dropDuplicates([*_DOC, "line_no"])
    # one document stays in one partition, so that neighbouring lines have neighbouring numbers
    places = places.repartitionByRange(F.col("doc_id").asc_nulls_last(), "text_key").sortWithinPartitions(
        F.col("doc_id").asc_nulls_last(), "text_key", "line_no"
    )
    places = places.withColumn("pos", F.monotonically_increasing_id())
    return C.stored(places.withColumn("block", F.col("pos") - F.col("line_no")), "places")


def shortest_spans(places: DataFrame, min_words: int) -> DataFrame:
    """``start, end`` (numbers of places): per place the shortest span of enough words from it, and the one up to it."""
    block = [*_DOC, "block"]
    so_far = F.sum("words").over(Window.partitionBy(*block).orderBy("pos"))
    rows = places.select(*block, "pos", "words", so_far.cast("long").alias("upto"))
    rows = rows.withColumn("before", F.col("upto") - F.col("words"))

    def nearest(known: Column, wanted: Column, order) -> DataFrame:
        """For each place the nearest other one by a running total, from one sort of both."""
        sides = [F.struct(value.alias("at"), F.lit(asks).alias("asks")) for asks, value in enumerate((known, wanted))]
        both = rows.select(*block, "pos", F.inline(F.array(*sides)))
        window = Window.partitionBy(*block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        found = F.last(F.when(F.col("asks") == 0, F.col("pos")), ignorenulls=True).over(window)
        return both.withColumn("other", found).filter("asks = 1 AND other IS NOT NULL")

    forward = nearest(
        F.col("upto"), F.col("before") + min_words, (F.col("at").desc(), F.col("asks").asc(), F.col("pos").desc())
    ).select("pos", F.col("other").alias("end"))
    backward = nearest(
        F.col("before"), F.col("upto") - min_words, (F.col("at").asc(), F.col("asks").asc(), F.col("pos").asc())
    ).select(F.col("other").alias("start"), F.col("pos").alias("end"))
    return forward.select(F.col("pos").alias("start"), "end").union(backward).distinct()


def ranked(places: DataFrame, longest: int) -> DataFrame:
    """``pos, ranks``: the rank of the 1, 2, 4, ... lines from each place on, as far as needed for ``longest`` lines."""
    rows = places.select(*_DOC, "pos", "block", F.array("rank").alias("ranks"))
    size = 1
    while 2 * size <= longest:
        ahead = Window.partitionBy(*_DOC, "block").orderBy("pos")
        last = F.element_at("ranks", -1)
        # past the end of a block there is nothing, which comes before everything
        rows = rows.withColumns({"a": last, "b": F.coalesce(F.lead(last, size).over(ahead), F.lit(-1))})
        rows = C.stored(rows, "pairs")
        pairs = C.stored(_ordered(rows.select("a", "b").distinct(), "a", "b"), "ranks")
        rows = rows.join(pairs, ["a", "b"]).withColumn("ranks", F.concat("ranks", F.array("rank")))
        rows = rows.drop("a", "b", "rank")
        size *= 2
    return C.stored(rows.select("pos", "ranks"), "suffix-ranks") if size > 1 else rows.select("pos", "ranks")


def later_runs(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_key, first_line, last_line``: maximal runs of lines that are copies of earlier ones."""
    places = repeated_lines(documents)
    spans = C.stored(shortest_spans(places, min_words), "spans")
    longest = spans.agg(F.max(F.col("end") - F.col("start") + 1)).first()[0] or 1
    ranks = ranked(places, longest)
    spans = spans.withColumn("length", F.col("end") - F.col("start") + 1)
    spans = spans.withColumn("level", F.length(F.bin("length")) - 1)  # of the highest bit
    spans = spans.withColumn("second", F.col("end") + 1 - F.expr("shiftleft(1L, level)"))
    head = ranks.select(F.col("pos").alias("start"), F.col("ranks").alias("head"))
    tail = ranks.select(F.col("pos").alias("second"), F.col("ranks").alias("tail"))
    keyed = spans.join(head, "start").withColumn("head", F.get("head", F.col("level")))
    keyed = keyed.join(tail, "second").withColumn("tail", F.get("tail", F.col("level")))
    keyed = C.stored(keyed.select("start", "end", "length", "head", "tail"), "intervals")
    interval = ["length", "head", "tail"]
    first = keyed.groupBy(*interval).agg(F.min("start").alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = keyed.join(first, interval).filter("start > first").select("start", "end")
    spans = later.join(places.select(F.col("pos").alias("start"), *_DOC, "block"), "start")
    # overlapping and touching spans of one block make a maximal run
    order = Window.partitionBy(*_DOC, "block").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("opens", F.coalesce((F.col("start") > reach + 1).cast("int"), F.lit(1)))
    spans = spans.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = spans.groupBy(*_DOC, "block", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.select(
        *_DOC,
        (F.col("start") - F.col("block")).cast("int").alias("first_line"),
        (F.col("end") - F.col("block")).cast("int").alias("last_line"),
    )


def deduplicated(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with later copies of line runs cut out of ``text``, and ``removed_runs, n_lines, n_removed``.

    A column that already has one of the three names gives way.
    """
    with C.scratch(documents.sparkSession):
        runs = later_runs(documents, min_words).groupBy(*_DOC)
        runs = runs.agg(F.sort_array(F.collect_list(F.struct("first_line", "last_line"))).alias("removed_runs"))
        runs = C.stored(runs, "runs", keep=True)
    rows = C.keyed_rows(documents)
    own = C.by_document(rows, runs, "left").select("row", "whole_text", "removed_runs")
    none = F.array().cast("array<struct<first_line:int,last_line:int>>")
    own = own.withColumn("removed_runs", F.coalesce("removed_runs", none))
    own = own.withColumn("all_lines", _lines(F.col("whole_text")))
    # what stays lies before, between and after the runs
    froms = F.concat(F.array(F.lit(0)), F.transform("removed_runs", lambda r: r["last_line"] + 1))
    tos = F.concat(F.transform("removed_runs", lambda r: r["first_line"]), F.array(F.size("all_lines")))
    gaps = F.filter(F.arrays_zip(froms.alias("low"), tos.alias("high")), lambda g: g["high"] > g["low"])
    kept = F.flatten(F.transform(gaps, lambda g: F.slice("all_lines", g["low"] + 1, g["high"] - g["low"])))
    removed = F.aggregate("removed_runs", F.lit(0), lambda n, r: n + r["last_line"] - r["first_line"] + 1)
    text = F.when(F.size("removed_runs") == 0, F.col("whole_text")).otherwise(F.array_join(kept, "\n"))
    added = {
        "removed_runs": F.col("removed_runs"),
        "n_lines": F.coalesce(F.size("all_lines"), F.lit(0)),
        "n_removed": removed,
    }
    row = {c: F.col("row")[c] for c in documents.columns} | {"text": text} | added
    return own.select(*[value.alias(name) for name, value in row.items()])


def without_copies(documents: DataFrame) -> DataFrame:
    """The documents without later copies of runs; a document of which no line is left goes."""
    plain = documents.select(F.struct(*[documents[c].alias(c) for c in documents.columns]).alias("row"), "doc_id", "text")
    rows = deduplicated(plain).filter("n_removed = 0 OR n_removed < n_lines")
    row = {c: F.col("row")[c] for c in documents.columns} | {"text": F.col("text")}
    if "n_chars" in row:
        kind = documents.schema["n_chars"].dataType
        row["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(row["n_chars"])
    return rows.select(*[value.alias(name) for name, value in row.items()])
