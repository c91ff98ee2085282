"""Benchmark decontamination by winnowing.

Of each window of words the smallest k-gram hash is kept, on the documents' side and on the
benchmark's side. Equal windows keep the same hash at the same place, so a join of the kept hashes
finds every shared window; a hit is then extended word by word to both sides, on the words themselves.

Plan: one pass over the texts keeps the hashes that a Bloom filter of fixed size admits, with the words
around them; these few rows meet the benchmark's in a join; hits are put together per document. What is broadcast are
hashes, words and a number, measured in bytes first; item ids are looked up by that number for different pairs of
document and number, so a passage that stands in a third of the benchmark brings its ids to the result only.

Edge cases: a null or empty text has no words and is clean; an item without words is ignored; an item with fewer
words than a window is one window; an item without an id marks words but is not listed; repeated
rows each get their own result; all columns but ``doc_id``, ``text``, ``item_id`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm import common as C

WINDOW = 13
GRAM = 5
FILTER_SLOTS = 1 << 22
#: Kept hashes of a benchmark with words of up to this many bytes are broadcast; larger ones are joined by shuffle, with the
#: same result.
BROADCAST_BYTES = 64 << 20

_PRINTS = "array<struct<span:int,hash:bigint,place:int,at:int,words:array<string>>>"
_PRINT_TYPE = pa.list_(
    pa.struct(
        [
            ("span", pa.int32()),
            ("hash", pa.int64()),
            ("place", pa.int32()),
            ("at", pa.int32()),
            ("words", pa.list_(pa.string())),
        ]
    )
)


def _kept(hashes: np.ndarray, first: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowed k-grams for windows of ``span`` words: places, hashes, rows."""
    gram = min(GRAM, span)
    grams = C.gram_hashes(hashes, gram)
    places = C.window_minima(grams, span - gram + 1)
    row = np.searchsorted(first, np.arange(len(places)), side="right") - 1
    places = np.unique(places[np.arange(len(places)) + span <= first[row + 1]])
    return places, grams[places], np.searchsorted(first, places, side="right") - 1


def _prints(column: pa.Array, spans: list[int], admitted: np.ndarray | None, whole_short: bool):
    """Per chunk: word counts of its rows, and per row the kept hashes with the words around them.

    ``whole_short``: a row with fewer words than WINDOW is one window (benchmark items).
    """
    for start, stop, data, offsets in C.text_chunks(column):
        folded = C.ALNUM_WORDS[data]
        starts, ends, first = C.find_words(folded, offsets)
        hashes = C.span_hashes(folded, starts, ends)
        counts = np.diff(first)
        rows: list[list[dict]] = [[] for _ in range(stop - start)]
        raw = folded.tobytes()
        wanted = sorted({min(int(n), WINDOW) for n in counts if n}) if whole_short else spans
        for span in wanted:
            gram = min(GRAM, span)
            reach = span - gram
            places, kept, row = _kept(hashes, first, span)
            take = np.ones(len(places), bool)
            if admitted is not None:
                take = admitted[(kept & np.uint64(FILTER_SLOTS - 1)).astype(np.int64)]
            if whole_short:
                take &= np.minimum(counts[row], WINDOW) == span
            for place, value, at in zip(places[take], kept[take].view(np.int64), row[take], strict=True):
                low, high = max(place - reach, first[at]), min(place + gram + reach, first[at + 1])
                rows[at].append(
                    {
                        "span": span,
                        "hash": int(value),
                        "place": int(place - first[at]),
                        "at": int(place - low),
                        "words": [raw[starts[i] : ends[i]].decode() for i in range(low, high)],
                    }
                )
        yield counts, rows


def benchmark_prints(items: DataFrame) -> DataFrame:
    """``span, hash, item_at, item_words, items``: the kept hashes of all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for_all = [rows for _, rows in _prints(batch.column("text"), [], None, True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), pa.array([r for rows in for_all for r in rows], _PRINT_TYPE)], ["item", "prints"]
            )

    found = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    found = found.mapInArrow(run, f"item string, prints {_PRINTS}")
    return (
        found.select("item", F.inline("prints"))
        .groupBy("span", "hash", F.col("at").alias("item_at"), F.col("words").alias("item_words"))
        .agg(F.collect_set("item").alias("items"))
    )


def _admitted(prints: DataFrame) -> np.ndarray:
    """A one-hash Bloom filter; at most FILTER_SLOTS slot numbers ever reach the driver."""
    slots = prints.select(F.col("hash").bitwiseAND(FILTER_SLOTS - 1).alias("slot")).distinct().toPandas()["slot"]
    bits = np.zeros(FILTER_SLOTS, bool)
    bits[slots.to_numpy(np.int64)] = True
    return bits


def _document_prints(documents: DataFrame, spans: list[int], admitted: np.ndarray) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(np.packbits(admitted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            done = 0
            for counts, rows in _prints(batch.column("text"), spans, bits, False):
                part = batch.slice(done, len(counts))
                done += len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array(counts, pa.int64()),
                        pa.array(rows, _PRINT_TYPE),
                    ],
                    ["doc_id", "text_key", "n_words", "prints"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", C.text_key(F.col("text")).alias("text_key"), "text")
    schema = f"doc_id {kind}, text_key bigint, n_words bigint, prints {_PRINTS}"
    return texts.mapInArrow(lambda batches: C.giving_back(run(batches)), schema)


def _common(left: Column, right: Column) -> Column:
    """How many leading words agree."""
    size = F.least(F.size(left), F.size(right))
    unlike = F.array_position(
        F.zip_with(F.slice(left, F.lit(1), size), F.slice(right, F.lit(1), size), lambda a, b: a == b), F.lit(False)
    )
    return F.when(unlike == 0, size).otherwise(unlike - 1)


def _covered(spans: Column) -> Column:
    """Words in a union of [low, high) spans."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(
        F.sort_array(spans),
        start,
        lambda state, span: F.struct(
            (state["total"] + F.greatest(F.lit(0), span["high"] - F.greatest(span["low"], state["upto"]))).alias("total"),
            F.greatest(state["upto"], span["high"]).alias("upto"),
        ),
        lambda state: state["total"],
    )


def contamination(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per document ``doc_id, text_key, n_words, n_hit, item_ids, hit_spans, contaminated``."""
    bench = C.stored(benchmark_prints(items).withColumn("mark", F.monotonically_increasing_id()), "benchmark-prints")
    spans = sorted(row["span"] for row in bench.select("span").distinct().collect())  # at most WINDOW values
    marks = bench.drop("items")
    if _row_bytes(marks) <= BROADCAST_BYTES:
        marks = F.broadcast(marks)
    rows = _document_prints(documents, spans, _admitted(bench)).withColumn("row", F.monotonically_increasing_id())
    prints = rows.select("row", "doc_id", "text_key", "n_words", F.inline_outer("prints"))
    # rows without a print get a key of their own, so that a shuffle spreads them
    prints = prints.withColumns(
        {"span": F.coalesce("span", F.lit(0)), "hash": F.coalesce("hash", F.col("row"))}
    )

    gram = F.least(F.lit(GRAM), F.col("span"))
    reach = F.col("span") - gram
    parts = {}
    for side, at, words in (("doc", F.col("at"), F.col("words")), ("item", F.col("item_at"), F.col("item_words"))):
        parts[side] = (
            F.reverse(F.slice(words, F.lit(1), at)),
            F.slice(words, at + 1, gram),
            F.slice(words, at + gram + 1, F.size(words)),
        )
    before = F.least(_common(parts["doc"][0], parts["item"][0]), reach)
    after = F.least(_common(parts["doc"][2], parts["item"][2]), reach)
    hit = (parts["doc"][1] == parts["item"][1]) & (before + after >= reach)
    span = F.struct(
        (F.col("place") - before).cast("long").alias("low"), (F.col("place") + gram + after).cast("long").alias("high")
    )
    found = (
        prints.join(marks, ["span", "hash"], "left")
        .withColumn("hit", F.coalesce(hit, F.lit(False)))
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("text_key").alias("text_key"),
            F.first("n_words").alias("n_words"),
            F.collect_set(F.when(F.col("hit"), span)).alias("hit_spans"),
            F.collect_set(F.when(F.col("hit"), F.col("mark"))).alias("marks"),
        )
    )
    found = C.stored(found, "contamination")
    named = found.select("row", F.explode("marks").alias("mark")).join(bench.select("mark", "items"), "mark")
    named = named.select("row", F.explode("items").alias("item")).groupBy("row")
    named = named.agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    return (
        found.join(named, "row", "left")
        .withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>")))
        .withColumn("n_hit", _covered(F.col("hit_spans")))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
        .drop("row", "marks")
    )


def _row_bytes(marks: DataFrame) -> int:
    """Bytes of the benchmark's hashes and words, with what a row and a word need besides."""
    size = F.octet_length(F.array_join("item_words", "")) + 24 * F.size("item_words") + 64
    return marks.agg(F.sum(size)).first()[0] or 0


def without_contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = C.stored(contamination(documents, items).filter("contaminated").select("doc_id", "text_key"), "bad", keep=True)
    # only rows that the list's bit map admits are shuffled
    rows = C.keyed_rows(documents).drop("whole_text").withColumn("admitted", C.admission(bad)(C.document_slot()))
    clean = C.by_document(rows.filter("admitted"), bad, "left_anti").select("row")
    return rows.filter("NOT admitted").select("row").union(clean).select("row.*")
