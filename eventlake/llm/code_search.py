"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is the signs of an embedding, 64 bits, read as four segments of 16 bits with a hash index each. For a query
all codes are fetched that differ from it in at most r bits in some segment, for r = 0, 1, 2, ... A code at distance
4 * (r + 1) - 1 or less must have such a segment, so the search ends once the k-th verified distance is no more than that; the
answer is exact, whatever the data.

Plan: equal codes are one entry with its k smallest ids, picked before the shuffle, so a vector that occurs in a third of
all rows is one entry. Entries are dealt by hash over shards of about SHARD_CODES, each with an index of its own in a
task; queries are broadcast in blocks of at most BLOCK_QUERIES different codes. A shard gives at most k ids per query,
and the best k over all shards are taken by rank.

Edge cases: rows without an id, or whose embedding is null, of another length or has a null or NaN entry, have no code: they are
neither found nor answered; a zero counts as negative; ties go to the smaller id; repeated rows count once; an id with
two embeddings is two entries; a query finds itself; with fewer than k coded rows all are returned; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm import common as C

BITS, SEGMENT = 64, 16
SEGMENTS = BITS // SEGMENT
SHARD_CODES = 1 << 15
BLOCK_QUERIES = 1 << 15
_QUERIES_AT_ONCE = 64

_ALL = np.arange(1 << SEGMENT, dtype=np.uint64)
_MASKS = [_ALL[np.bitwise_count(_ALL) == r].astype(np.int64) for r in range(SEGMENT + 1)]


def code_of(embedding: Column) -> Column:
    """Signs as one number, the first entry in the highest bit; null where there is no code."""
    usable = (F.size(embedding) == BITS) & ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x))
    signs = F.aggregate(
        embedding, F.lit(0).cast("long"), lambda code, x: F.shiftleft(code, 1).bitwiseOR((x > 0).cast("int").cast("long"))
    )
    return F.when(F.coalesce(usable, F.lit(False)), signs)


class Index:
    """Codes by the value of each segment."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order, self.starts = [], []
        for s in range(SEGMENTS):
            values = self._segment(codes, s)
            self.order.append(np.argsort(values, kind="stable"))
            self.starts.append(np.concatenate([[0], np.cumsum(np.bincount(values, minlength=1 << SEGMENT))]))

    @staticmethod
    def _segment(codes: np.ndarray, s: int) -> np.ndarray:
        return ((codes >> np.uint64(s * SEGMENT)) & np.uint64((1 << SEGMENT) - 1)).astype(np.int64)

    def at_radius(self, queries: np.ndarray, radius: int):
        """``(query, code, distance)`` of codes whose closest segment differs in exactly ``radius`` bits, each once."""
        for s in range(SEGMENTS):
            buckets = (self._segment(queries, s)[:, None] ^ _MASKS[radius][None, :]).ravel()
            low = self.starts[s][buckets]
            size = self.starts[s][buckets + 1] - low
            full = np.flatnonzero(size)
            low, size = low[full], size[full]
            query = np.repeat(full // len(_MASKS[radius]), size)
            inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            code = self.order[s][np.repeat(low, size) + inner]
            differ = queries[query] ^ self.codes[code]
            first = np.ones(len(code), bool)
            for other in range(SEGMENTS):
                if other != s:
                    bits = np.bitwise_count(self._segment(differ, other).astype(np.uint64))
                    first &= bits > radius if other < s else bits >= radius
            yield query[first], code[first], np.bitwise_count(differ[first]).astype(np.int64)

    def nearest(self, queries: np.ndarray, weights: np.ndarray, k: int):
        """``(query, code, distance)`` of all codes up to each query's k-th distance; ``weights``: ids per code."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        open_ = np.arange(len(queries))
        held = tuple(np.empty(0, np.int64) for _ in range(3))
        for radius in range(SEGMENT + 1):
            parts = [(open_[q], c, d) for q, c, d in self.at_radius(queries[open_], radius)]
            query, code, distance = (np.concatenate(x) for x in zip(held, *parts, strict=True))
            order = np.lexsort((distance, query))
            query, code, distance = query[order], code[order], distance[order]
            total = np.cumsum(weights[code])
            start = np.searchsorted(query, open_)
            stop = np.searchsorted(query, open_, side="right")
            before = np.where(start > 0, total[np.maximum(start, 1) - 1], 0) if len(total) else np.zeros(len(open_))
            place = np.searchsorted(total, before + k)  # where the k-th id of each query stands
            enough = place < stop
            limit = np.full(len(queries), BITS)
            if len(total):
                limit[open_] = np.where(enough, distance[np.minimum(place, len(distance) - 1)], BITS)
            near = distance <= limit[query]
            query, code, distance = query[near], code[near], distance[near]
            covered = SEGMENTS * (radius + 1) - 1
            done = np.zeros(len(queries), bool)
            done[open_] = (enough & (limit[open_] <= covered)) | (covered >= BITS)
            ready = done[query]
            found.append((query[ready], code[ready], distance[ready]))
            held = query[~ready], code[~ready], distance[~ready]
            open_ = open_[~done[open_]]
            if not len(open_):
                break
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _searched(shard: pa.Table, queries: np.ndarray, k: int) -> pa.Table:
    codes = shard.column("code").combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64)
    ids = shard.column("ids").combine_chunks()
    offsets = ids.offsets.to_numpy()
    flat = ids.values.to_numpy(zero_copy_only=False)
    weights = np.diff(offsets)
    index = Index(codes)
    out: list[tuple[np.ndarray, ...]] = []
    for start in range(0, len(queries), _QUERIES_AT_ONCE):
        part = queries[start : start + _QUERIES_AT_ONCE]
        query, code, distance = index.nearest(part, weights, k)
        size = weights[code]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        vec = flat[np.repeat(offsets[code], size) + inner]
        query, distance = np.repeat(query, size), np.repeat(distance, size)
        order = np.lexsort((vec, distance, query))
        query, distance, vec = query[order], distance[order], vec[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        best = rank < k
        out.append((part[query[best]].view(np.int64), vec[best], distance[best]))
    query, vec, distance = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table({"query": query, "vec_id": vec, "distance": distance.astype(np.int32)})


def _search_of(queries: Broadcast, k: int) -> Callable[[pa.Table], pa.Table]:
    return lambda shard: _searched(shard, queries.value, k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, distance``: the k nearest rows of ``vectors`` for each row of ``queries``.

    Both have ``vec_id`` (a whole number) and ``embedding``.
    """
    spark = vectors.sparkSession
    coded = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), code_of(F.col("embedding")).alias("code"))
    coded = coded.filter("vec_id IS NOT NULL AND code IS NOT NULL").distinct()
    place = F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))
    entries = coded.withColumn("place", place).filter(F.col("place") <= k)
    entries = C.stored(entries.groupBy("code").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "codes")
    shards = max(1, -(-entries.count() // SHARD_CODES))
    dealt = entries.withColumn("shard", F.pmod(F.xxhash64("code"), F.lit(shards)).cast("int"))

    asked = queries.select(F.col("vec_id").cast("long").alias("query_id"), code_of(F.col("embedding")).alias("query"))
    asked = C.stored(asked.filter("query_id IS NOT NULL AND query IS NOT NULL").distinct(), "queries")
    different = asked.select("query").distinct()
    blocks = max(1, -(-different.count() // block_queries))
    found = None
    for block in range(blocks):
        part = different.filter(F.pmod(F.xxhash64(F.lit(7), "query"), F.lit(blocks)) == block)
        values = part.toPandas()["query"].to_numpy(np.int64).view(np.uint64)
        if not len(values):
            continue
        search = _search_of(spark.sparkContext.broadcast(values), k)
        hits = dealt.groupBy("shard").applyInArrow(search, "query bigint, vec_id bigint, distance int")
        found = hits if found is None else found.union(hits)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, distance int")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "vec_id"))
    best = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return asked.join(best, "query").select("query_id", "rank", "vec_id", "distance")
