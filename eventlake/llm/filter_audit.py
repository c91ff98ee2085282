"""How quality filters interact: what each removes in every order of application.

Each document has a mask of the filters that it fails; everything asked of an order follows from how many documents there are
of each mask. Four filters look at one text alone. The fifth removes copies: texts identical to that of a smaller id.

Plan: one scan of the texts leaves a part, a mask and the SHA-256 digest of the whole text, written once. A counting Bloom
sketch of the digests, two bits a counter, is built per task and merged block by block; a text with a counter of one is
unique for certain and drops its digest. Only possible repeats are shuffled by digest, for the exact least id of each
text. They are combined before they meet: first rows of one id and text, then all rows of a text in a task, so a text that
a third of all rows share is a handful of rows. All rows of a text have the same mask otherwise, so its copies are
counted, not joined back. Labels join on the id; masks are then added up per part, and each part's sums make its 600 rows.
The sketch has at most 2**SLOT_BITS counters; where that is little for the table, more texts count as possible repeats
and the result is the same.

Edge cases: a null text is empty, an empty text has no words and fails A; a null part is the empty string; rows without an id
are no copies and make none; rows repeated with id and text are each counted, and are copies only of smaller ids; of several
label rows of an id any that says so counts; an empty table has no parts; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm import common as C

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
MIN_WORDS = 200
#: Largest sketch: 2**26 counters, 16 MB to merge per task, 8 MB as the map of counters above one.
SLOT_BITS = 26
#: Counters per document, and how many of them each text adds to.
SLOTS_PER_ROW = 16
PROBES = 2
_BLOCK = 1 << 13

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_ODD = np.zeros(256, bool)
_ODD[list(b"#$%&*|")] = True


def own_masks(raw: bytes, data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Masks of filters A to D of the texts between the offsets."""
    before = [
        np.concatenate([[0], np.cumsum(kind)])[offsets] for kind in (_UPPER[data], _ODD[data], (data & 0xC0) != 0x80)
    ]
    upper, odd, points = (np.diff(b) for b in before)
    out = []
    for i in range(len(offsets) - 1):
        words = raw[offsets[i] : offsets[i + 1]].split()
        mask = int(len(words) < MIN_WORDS)
        mask |= (100 * len(set(words)) < 50 * len(words)) << 1
        mask |= int(100 * upper[i] > 3 * points[i]) << 2
        out.append(mask | int(odd[i] > 0) << 3)
    return out


def flagged(documents: DataFrame, part: str) -> DataFrame:
    """``doc_id, part, mask, digest`` per row; the mask has filters A to D."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, data, offsets in C.text_chunks(batch.column("text")):
                raw = data.tobytes()
                masks = own_masks(raw, data, offsets)
                digests = [hashlib.sha256(raw[offsets[i] : offsets[i + 1]]).digest() for i in range(stop - start)]
                rows = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                    ["doc_id", "part", "mask", "digest"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    return texts.mapInArrow(run, f"doc_id {kind}, part string, mask int, digest binary")


# ------------------------------------------------------------------ the sketch


def _slots(digests: pa.Array, bits: int) -> np.ndarray:
    """PROBES slots per digest, one row a digest, from its first bytes."""
    _, where, data = digests.buffers()
    offsets = np.frombuffer(where, np.int32)[digests.offset : digests.offset + len(digests) + 1]
    whole = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].reshape(-1, 32)
    words = np.ascontiguousarray(whole[:, : 8 * PROBES]).view(np.uint64)
    return (words & np.uint64((1 << bits) - 1)).astype(np.int64)


def _packed(once: np.ndarray, twice: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the two bit maps that are not empty."""
    once, twice = (np.packbits(x).reshape(-1, _BLOCK // 8) for x in (once, twice))
    some = np.flatnonzero(once.any(axis=1))
    for low in range(0, len(some), 256):
        at = some[low : low + 256]
        yield pa.RecordBatch.from_arrays(
            [pa.array((first + at).astype(np.int32)), *(pa.array([x[i].tobytes() for i in at], pa.binary()) for x in (once, twice))],
            ["block", "once", "twice"],
        )


def repeated_slots(rows: DataFrame, bits: int) -> np.ndarray:
    """Bit map of counters above one, packed: a table of at most 2**SLOT_BITS bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)
        for batch in batches:
            if batch.num_rows:
                # the probes of a text may fall together; that is one hit
                slots = np.sort(_slots(batch.column("digest"), bits), axis=1)
                fresh = np.ones(slots.shape, bool)
                fresh[:, 1:] = slots[:, 1:] != slots[:, :-1]
                found, times = np.unique(slots[fresh], return_counts=True)
                twice[found] |= once[found] | (times > 1)
                once[found] = True
        yield from _packed(once, twice, 0)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by block; one block is held."""
        block, once, twice = None, None, None
        for batch in batches:
            for b, o, t in zip(*(batch.column(c).to_pylist() for c in ("block", "once", "twice")), strict=True):
                o, t = np.frombuffer(o, np.uint8), np.frombuffer(t, np.uint8)
                if b == block:
                    twice = twice | t | (once & o)
                    once = once | o
                    continue
                if block is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([twice.tobytes()])], ["block", "twice"])
                block, once, twice = b, o, t
        if block is not None:
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([twice.tobytes()])], ["block", "twice"])

    counted = rows.select("digest").mapInArrow(count, "block int, once binary, twice binary")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = counted.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(merge, "block int, twice binary")
    whole = np.zeros(((1 << bits) // _BLOCK, _BLOCK // 8), np.uint8)
    for block, twice in merged.collect():  # at most 2**SLOT_BITS bits in all
        whole[block] = np.frombuffer(twice, np.uint8)
    return whole.ravel()


def possible_repeats(rows: DataFrame) -> DataFrame:
    """The rows; those of a text that is unique for certain have no digest any more."""
    bits = int(np.clip(np.ceil(np.log2(max(1, rows.count()) * SLOTS_PER_ROW)), 13, SLOT_BITS))
    shared = rows.sparkSession.sparkContext.broadcast(repeated_slots(rows, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = shared.value
        for batch in batches:
            if batch.num_rows:
                slots = _slots(batch.column("digest"), bits)
                maybe = (twice[slots >> 3] >> (7 - (slots & 7)) & 1).all(axis=1)
                at = batch.schema.get_field_index("digest")
                yield batch.set_column(at, "digest", pc.if_else(pa.array(maybe), batch.column(at), None))

    return rows.mapInArrow(run, rows.schema)


# ------------------------------------------------------------------ counts per mask


def mask_counts(documents: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part, mask, good, toxic, n``: how many documents of each kind there are; the mask has all five filters."""
    rows = possible_repeats(C.stored(flagged(documents, part), "flagged"))
    # rows of one id and text first, so that an id that many rows share is short when the labels come
    rows = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    marks = labels.groupBy(F.col("doc_id").alias("labelled")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    zero = F.lit(0)
    rows = rows.join(marks, F.col("doc_id") == F.col("labelled"), "left").select(
        "doc_id", "digest", "part", "mask", "n", F.coalesce("good", zero).alias("good"), F.coalesce("toxic", zero).alias("toxic")
    )
    rows = C.stored(rows, "marked")
    kind = ["part", "mask", "good", "toxic"]
    unique = rows.filter("digest IS NULL").groupBy(*kind).agg(F.sum("n").alias("n"))

    # a text's rows in one part: all, those with an id, and the least id with its number of rows
    one_id = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    texts = (
        rows.filter("digest IS NOT NULL")
        .groupBy("digest", *kind)
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n"))).alias("with_id"), F.min(one_id).alias("first"))
    )
    least = texts.groupBy(F.col("digest").alias("text")).agg(F.min("first.doc_id").alias("least"))
    texts = texts.join(least, F.col("digest") == F.col("text"))
    firsts = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(zero)
    texts = texts.withColumn("copies", F.coalesce(F.col("with_id") - firsts, F.lit(0)))
    counted = F.explode(
        F.array(
            F.struct(F.col("mask").bitwiseOR(COPY).alias("m"), F.col("copies").alias("k")),
            F.struct(F.col("mask").alias("m"), (F.col("n") - F.col("copies")).alias("k")),
        )
    )
    texts = texts.select("part", "good", "toxic", counted.alias("c")).select(
        "part", F.col("c.m").alias("mask"), "good", "toxic", F.col("c.k").alias("n")
    )
    return unique.unionByName(texts).groupBy(*kind).agg(F.sum("n").alias("n")).filter("n > 0")


# ------------------------------------------------------------------ orders


def order_rows(counts: np.ndarray) -> pd.DataFrame:
    """The rows of one part from its documents per mask (three rows: all, good, toxic)."""
    mask = np.arange(1 << len(FILTERS))
    failed = np.bitwise_count(mask).astype(np.int64)
    every, good, toxic = counts
    orders = list(permutations(range(len(FILTERS))))
    out = []
    for order in orders:
        before = 0
        for step, f in enumerate(order):
            bit = 1 << f
            fails, gone = (mask & bit) > 0, (mask & before) > 0
            here = fails & ~gone
            # of the orders a failing document sees, each filter that it fails is first in the same number
            share = every[fails] * (len(orders) // failed[fails])
            out.append(
                (
                    "".join(FILTERS[i] for i in order),
                    step + 1,
                    every[(mask & (before | bit)) == 0].sum(),
                    every[here].sum(),
                    every[fails & gone].sum(),
                    every[bit],
                    good[here].sum(),
                    toxic[here].sum(),
                    share.sum(),
                )
            )
            before |= bit
    names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return pd.DataFrame(out, columns=names).astype({"step": "int32"})


def audit(documents: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Per part, order of filters and step, what is kept and removed there."""
    counts = mask_counts(documents, labels, part)
    size = 1 << len(FILTERS)
    zero = F.lit(0).cast("long")

    def sums(condition) -> list:
        return [F.coalesce(F.sum(F.when((F.col("mask") == m) & condition, F.col("n"))), zero) for m in range(size)]

    kinds = {"every": F.lit(True), "good": F.col("good") == 1, "toxic": F.col("toxic") == 1}
    wide = counts.groupBy("part").agg(*[F.array(*sums(k)).alias(name + "_n") for name, k in kinds.items()])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own in frame.itertuples(index=False):
                rows = order_rows(np.array([own.every_n, own.good_n, own.toxic_n], np.int64))
                rows.insert(0, "part", own.part)
                yield rows

    columns = "kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return wide.mapInPandas(run, f"part string, filter_order string, step int, {columns}")
