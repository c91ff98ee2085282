"""Shards of near equal bytes by sampled splitters.

Documents are ordered by a digest of their text, then by a digest of their id, so equal texts stand together. Keys are
drawn in proportion to bytes and rows; quantiles of the sample are the splitters of fine ranges, and a range that turns out
overfull is sampled again on its own and subdivided, inside one text where that text alone fills it. Exact sizes of all
ranges, then a running sum inside each, give every document its place on one line of bytes; the line is cut into shards of
the same length. A group of equal texts goes where it starts, unless it holds more than GROUP_SHARE of a shard: such a
group is cut like anything else. So a shard is off by one document and one small group at most, and the result does not
depend on the sample, which only decides how the work is dealt out.

Plan: one scan of the texts leaves a few dozen bytes a document, written once. The sample has about SAMPLES_PER_RANGE draws
for each of at most MAX_RANGES ranges, whatever the table's size; sizes of ranges are summed map-side. One shuffle deals
the short rows by range. Texts are moved only by ``write_shards``.

Edge cases: a null or empty text has no bytes, size 8 and checksum 0; null ids stand first among equal texts; rows repeated
with id and text stand next to each other and differ in their slot; an empty table has no shards; extra columns are ignored
by ``shards`` and kept by ``write_shards``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm import common as C

SHARDS = 24
#: What each document takes besides its text.
ROW_BYTES = 8
#: Rows of a fine range, about, as long as there are no more than MAX_RANGES of them.
RANGE_ROWS = 50_000
MAX_RANGES = 1 << 14
#: Size of the sample per range.
SAMPLES_PER_RANGE = 32
#: The same where an overfull range is sampled again; together these are at most as many as all ranges.
REFINED_SAMPLES_PER_RANGE = 128
#: A range is overfull with more than this many times its share.
OVERFULL = 2.0
#: Equal texts stay together up to this part of a shard, one in so many.
GROUP_SHARE = 50

_DRAW = 1 << 30


def _digest(text: Column) -> Column:
    """The first 60 bits of the MD5 digest: an order that any engine can repeat."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sized(documents: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, text_place, id_place`` per row."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return documents.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        _digest(text).alias("text_place"),
        F.coalesce(_digest(F.col("doc_id").cast("string").cast("binary")), F.lit(-1)).alias("id_place"),
    )


# ------------------------------------------------------------------ splitters


def _key(text_place: np.ndarray, id_place: np.ndarray) -> np.ndarray:
    """Sixteen bytes each that sort like the pair of numbers; the id's number may be -1."""
    both = np.stack([np.asarray(text_place, np.int64) + 1, np.asarray(id_place, np.int64) + 1], axis=1)
    return np.ascontiguousarray(both.astype(">i8")).view("S16").ravel()


def boundaries(sample: pd.DataFrame, pieces: int, low: tuple[int, int]) -> list[tuple[int, int]]:
    """Starts of ranges at the sample's quantiles, all above ``low``.

    ``sample`` has ``text_place, id_place, draws`` in order. A range starts where a text starts, and inside a text only
    where that text has another start already.
    """
    total = np.cumsum(sample["draws"].to_numpy())
    if not len(total):
        return []
    found, last = [], low
    at = np.searchsorted(total, total[-1] * np.arange(1, pieces) / pieces)
    for place, own in zip(sample["text_place"].to_numpy()[at], sample["id_place"].to_numpy()[at], strict=True):
        start = (int(place), -1)
        if start <= last:
            start = (int(place), int(own))
        if start > last:
            found.append(start)
            last = start
    return found


def drawn(rows: DataFrame, draws: Column) -> DataFrame:
    """The sample: how often each key is drawn if a row is expected ``draws`` times. The same for every run and retry."""
    chance = F.pmod(F.xxhash64("text_place", "id_place"), F.lit(_DRAW)) / F.lit(_DRAW)
    times = F.floor(draws + chance).alias("draws")
    return rows.select("text_place", "id_place", times).filter("draws > 0").groupBy("text_place", "id_place").agg(
        F.sum("draws").alias("draws")
    )


def with_range(rows: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """The rows with the number of splitters at or below them as ``part``."""
    starts = _key(*np.array(splitters, np.int64).reshape(-1, 2).T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = _key(batch.column("text_place").to_numpy(), batch.column("id_place").to_numpy())
            part = np.searchsorted(starts, key, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], [*batch.schema.names, "part"])

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{columns}, part int")


def measured(rows: DataFrame, splitters: list[tuple[int, int]]) -> pd.DataFrame:
    """``bytes, rows`` of every range, one row a range."""
    found = with_range(rows, splitters).groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    return found.toPandas().set_index("part").reindex(range(len(splitters) + 1), fill_value=0)


def splitters_of(rows: DataFrame, total_rows: int, total_bytes: int, ranges: int) -> tuple[list[tuple[int, int]], pd.DataFrame]:
    """Splitters such that no range is overfull unless it holds a single key, and the sizes of the ranges."""
    share = F.col("size") / F.lit(float(total_bytes)) / 2 + F.lit(0.5 / total_rows)
    splitters: list[tuple[int, int]] = []
    sizes = None
    crowded, pieces, rate = [0], {0: ranges}, SAMPLES_PER_RANGE
    while True:
        parts = with_range(rows, splitters)
        wanted = F.col("part").isin([int(p) for p in crowded]) if splitters else F.lit(True)
        draws = share * F.lit(float(ranges * rate))
        sample = drawn(parts.filter(wanted), draws).toPandas().sort_values(["text_place", "id_place"], ignore_index=True)
        key = _key(sample["text_place"].to_numpy(), sample["id_place"].to_numpy())
        part = np.searchsorted(_key(*np.array(splitters, np.int64).reshape(-1, 2).T), key, side="right")
        more = []
        for p in crowded:
            low = splitters[p - 1] if p else (-1, -1)
            more += boundaries(sample[part == p], pieces[p], low)
        if not more and sizes is not None:
            return splitters, sizes
        splitters = sorted({*splitters, *more})
        sizes = measured(rows, splitters)
        weight = (sizes["bytes"] / total_bytes + sizes["rows"] / total_rows) / 2 * ranges
        rate = REFINED_SAMPLES_PER_RANGE
        crowded = [int(p) for p in np.flatnonzero(weight.to_numpy() > OVERFULL)]
        pieces = {p: int(np.ceil(weight.iloc[p])) for p in crowded}
        if not crowded:
            return splitters, sizes


# ------------------------------------------------------------------ places


def placed(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with ``shard`` and ``row_at``, the number of rows before each in the order of all rows."""
    total_rows, total_bytes = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not total_rows:
        return rows.withColumn("shard", F.lit(0)).withColumn("row_at", F.lit(0).cast("long"))
    ranges = min(MAX_RANGES, max(4 * shards, total_rows // RANGE_ROWS))
    splitters, sizes = splitters_of(rows, total_rows, total_bytes, ranges)
    spark = rows.sparkSession
    before = sizes.cumsum() - sizes
    starts = spark.createDataFrame(
        [(int(p), int(b), int(n)) for p, b, n in zip(before.index, before["bytes"], before["rows"], strict=True)],
        "part int, bytes_before long, rows_before long",
    )
    # texts that several ranges share: where they start, and their size
    shared = sorted({place for place, own in splitters if own >= 0})
    first = {place: part + 1 for part, (place, own) in reversed(list(enumerate(splitters)))}
    cut = spark.createDataFrame(
        [(t, int(before["bytes"].iloc[first[t]])) for t in shared], "text_place long, whole_start long"
    )
    whole = rows.join(F.broadcast(cut.select("text_place")), "text_place").groupBy("text_place")
    cut = F.broadcast(cut).join(whole.agg(F.sum("size").alias("whole_bytes")), "text_place")

    order = ["text_place", "id_place", "doc_id", "size", "text_crc32"]
    along = Window.partitionBy("part").orderBy(*order)
    same_text = Window.partitionBy("part", "text_place")
    # the ranges are bounded by MAX_RANGES and the splits of overfull ones, the cut texts by the ranges
    lined = (
        with_range(rows, splitters)
        .join(F.broadcast(starts), "part")
        .withColumn("at", F.col("bytes_before") + F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .withColumn("row_at", F.col("rows_before") + F.row_number().over(along) - 1)
        .withColumn("group_bytes", F.sum("size").over(same_text))
        .withColumn("group_at", F.min("at").over(same_text))
        .join(F.broadcast(cut), "text_place", "left")
    )
    group_bytes = F.coalesce("whole_bytes", "group_bytes")
    start = F.when(group_bytes * (GROUP_SHARE * shards) <= total_bytes, F.coalesce("whole_start", "group_at"))
    shard = F.call_function("div", F.coalesce(start, F.col("at")) * shards, F.lit(total_bytes))
    return lined.select(*rows.columns, shard.cast("int").alias("shard"), "row_at")


def shards(documents: DataFrame, count: int = SHARDS) -> DataFrame:
    """Per row ``doc_id, size, text_crc32, text_place, id_place, shard, slot``; slots count from 0 in each shard."""
    rows = C.stored(sized(documents), "sizes")
    lined = C.stored(placed(rows, count), "shards")
    firsts = lined.groupBy("shard").agg(F.min("row_at").alias("first_row"))  # one row a shard
    return lined.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "text_place", "id_place", "shard", (F.col("row_at") - F.col("first_row")).alias("slot")
    )


def write_shards(documents: DataFrame, folder: str, count: int = SHARDS) -> DataFrame:
    """Write every row with its ``slot`` into the folder of its shard; returns what ``shards`` found.

    Texts are shuffled once, to their places. Of rows repeated with id and text, the n-th takes the n-th place.
    """
    found = C.stored(shards(documents, count), "sharded")
    same = Window.partitionBy("doc_id", "text_place")
    places = found.select("doc_id", "text_place", "shard", "slot", F.row_number().over(same.orderBy("shard", "slot")).alias("n"))
    row = F.struct(*[documents[c].alias(c) for c in documents.columns]).alias("row")
    texts = documents.select(row, "doc_id", _digest(F.coalesce("text", F.lit("")).cast("binary")).alias("text_place"))
    texts = texts.withColumn("n", F.row_number().over(same.orderBy(F.lit(0))))
    matched = (
        texts["doc_id"].eqNullSafe(places["doc_id"])
        & (texts["text_place"] == places["text_place"])
        & (texts["n"] == places["n"])
    )
    rows = texts.join(places.hint("merge"), matched).select("row", "shard", "slot")
    rows.select("shard", "slot", F.struct("row.*").alias("document")).write.partitionBy("shard").parquet(folder)
    return found
