"""Shared helpers: reading tables, cutting lineage, and looking at many texts at once as bytes.

Texts reach Python tasks as Arrow batches. A batch is cut into chunks of a few megabytes, each
seen as one byte array with row offsets, so that words, hashes and window minima are array operations.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import new_scratch

#: Small enough for the arrays of a chunk to stay in the processor's caches.
CHUNK_BYTES = 1 << 18
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths written inside each open ``scratch``.
_open_scratch: list[list[str]] = []


def stored(rows: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write to the shared folder and read back: one evaluation, short lineage, survives lost executors.

    Inside ``scratch`` the files go when the block ends; what ``keep`` marks stays until the block around it ends.
    """
    path = new_scratch(rows.sparkSession, name)
    for paths in _open_scratch[-2:-1] if keep else _open_scratch[-1:]:
        paths.append(path)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Results stored inside the block are deleted at its end; nothing that outlives it may read them."""
    _open_scratch.append([])
    try:
        yield
    finally:
        for path in _open_scratch.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        let_shuffles_go(spark)


def let_shuffles_go(spark: SparkSession) -> None:
    """Shuffle files of finished work go now: they stay until the driver's JVM finds that no plan refers to them."""
    gc.collect()
    spark._jvm.System.gc()


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, as far as ASCII words are concerned.

    ``lower`` is fast but also turns two other letters into ASCII ones; texts with those take the exact way.
    """
    odd = text.contains("K") | text.contains("İ")
    return F.when(odd, F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def lower_letters(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts of ASCII alone take the fast way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_key(text: Column) -> Column:
    """Tells apart rows that share an id; a null text counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def keyed_rows(documents: DataFrame) -> DataFrame:
    """``row, doc_id, text_key, whole_text``: all columns as one struct, so that no name can clash."""
    row = F.struct(*[documents[c].alias(c) for c in documents.columns]).alias("row")
    return documents.select(row, "doc_id", text_key(F.col("text")).alias("text_key"), F.col("text").alias("whole_text"))


def by_document(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Join on the document. Always by a sort-merge join: it works alike at every size and can split a hot id."""
    return rows.join(other.hint("merge"), same_document(rows, other), how)


#: Bits of an admission map, whatever the table's size.
ADMISSION_BITS = 22


def document_slot(bits: int = ADMISSION_BITS) -> Column:
    return F.xxhash64("doc_id", "text_key").bitwiseAND((1 << bits) - 1)


def admission(listed: DataFrame) -> Callable[[Column], Column]:
    """A test on ``document_slot`` that the listed ``doc_id, text_key`` pass, and few others as long as they are few.

    The map has 2**ADMISSION_BITS bits; where more documents are listed, more pass that an exact join then drops.
    """
    slots = listed.select(document_slot().cast("int").alias("slot")).distinct().toPandas()["slot"]
    bits = np.zeros(1 << ADMISSION_BITS, bool)
    bits[slots.to_numpy(np.int64)] = True
    shared = listed.sparkSession.sparkContext.broadcast(np.packbits(bits))

    @F.pandas_udf("boolean")
    def admitted(slot: pd.Series) -> pd.Series:
        at = slot.to_numpy(np.int64)
        return pd.Series((shared.value[at >> 3] >> (7 - (at & 7)) & 1).astype(bool))

    return admitted


# ------------------------------------------------------------------ texts as bytes


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its n + 1 row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = column.type
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        column = column.cast(pa.binary() if pa.types.is_string(kind) else pa.large_binary())
    column = column.fill_null(b"").cast(pa.large_binary())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    everything = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return everything, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, of one row where a single text is longer."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def give_back() -> None:
    """Hand memory that is no longer used back to the system.

    A Python worker lives on from stage to stage, and what its allocators keep counts against the executor all the while.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def giving_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches, for the end of a task: afterwards unused memory is handed back."""
    try:
        yield from batches
    finally:
        give_back()


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets from 0)`` per chunk."""
    data, offsets = text_bytes(column)
    for start, stop in chunks(offsets, limit):
        low, high = offsets[start], offsets[stop]
        yield start, stop, data[low:high], offsets[start : stop + 1] - low


def word_table(is_word: np.ndarray) -> np.ndarray:
    """Byte to lower-cased byte for bytes of words, to 0 for all others."""
    folded = np.arange(256, dtype=np.uint8)
    folded[65:91] += 32
    folded[~is_word] = 0
    return folded


_ALNUM = np.zeros(256, bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x41:0x5B] = _ALNUM[0x61:0x7B] = _ALNUM[0x80:] = True
#: Digits, ASCII letters and every byte of a non-ASCII character form words.
ALNUM_WORDS = word_table(_ALNUM)


_SPACE = np.zeros(256, bool)
_SPACE[[0, 0x20, *range(0x09, 0x0E)]] = True
#: Words between ASCII white space; a NUL separates as well.
SPACED_WORDS = word_table(~_SPACE)


def find_words(folded: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of non-zero bytes within a row), and each row's first word."""
    inside = folded != 0
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(inside)]] = False
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


# ------------------------------------------------------------------ hashes of spans

_RANDOM = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < length:
        size = max(length, 2 * CHUNK_BYTES)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (a finaliser with fixed odd multipliers)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _prefix(values: np.ndarray) -> np.ndarray:
    powers, _ = _power_tables(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=total[1:])
    return total


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    return _prefix(_RANDOM[data])


def hash_between(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans from their prefix hashes: the same bytes give the same hash anywhere."""
    _, inverse = _power_tables(len(total))
    return mixed((total[ends] - total[starts]) * inverse[starts])


def span_hashes(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return hash_between(prefix_hashes(folded), starts, ends)


def gram_hashes(items: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of every run of ``length`` items."""
    if len(items) < length:
        return np.empty(0, np.uint64)
    total = _prefix(items)
    _, inverse = _power_tables(len(total))
    return mixed((total[length:] - total[:-length]) * inverse[: len(total) - length])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of its smallest one, the last of equals."""
    count = len(values) - width + 1
    if count <= 0:
        return np.empty(0, np.int64)
    best = values[:count].copy()
    place = np.zeros(count, np.uint8 if width < 256 else np.int32)
    for step in range(1, width):
        value = values[step : step + count]
        smaller = value <= best
        np.copyto(best, value, where=smaller)
        place[smaller] = step
    return place + np.arange(count)
