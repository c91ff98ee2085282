"""Pairs of texts whose sets of word shingles have a Jaccard similarity of at least 0.8, found without exception.

Two such sets share one of their first n - ceil(0.8 n) + 1 shingles in whatever order is the same for all texts, so texts
that share none of these are never compared. The order puts rare shingles first: frequencies of all texts' shingles are
counted in FREQUENCY_SLOTS counters by hash. The order decides how many pairs are compared, not which are found.

Plan: equal sets are one node. Links come in four rounds, each on what is not joined yet: neighbours in the SimHash trie;
each node with the least node of each leading shingle that it shares, which is linear; of the pairs that share one and pass
the bounds as many as join what all of them would; then all that are left, as some of those fail. A
shingle that many nodes lead with is cut into tiles of TILE nodes, and each pair of tiles is a group of its own. A
pair first has to pass two bounds, in the task that finds it: the sizes, and the parity of how many shingles fall into each of 4 n slots or more, as each
differing slot is at least one shingle that only one side has. Texts of pairs that pass are sent to the pair's first node,
tile by tile, and compared as whole sets.

Edge cases: words lie between ASCII white space and NULs, A-Z lower-cased; texts without words are one node, linked with
nothing else; a text with fewer words than a shingle is one shingle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm import common as C

SHINGLE = 5
FREQUENCY_SLOTS = 1 << 20
#: Nodes of one group that is compared pair by pair, and partners of one node that are compared in one group.
TILE = 2048
_FREQUENCY_BLOCK = 1 << 12
_PAIRS_AT_ONCE = 1 << 18


# ------------------------------------------------------------------ sets of shingles


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Per text the sorted hashes of its different shingles."""
    folded = C.SPACED_WORDS[data]
    starts, ends, first = C.find_words(folded, offsets)
    words = C.span_hashes(folded, starts, ends)
    grams = C.gram_hashes(words, SHINGLE)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if high - low >= SHINGLE:
            yield np.unique(grams[low : high - SHINGLE + 1])
        else:
            yield C.gram_hashes(words[low:high], high - low) if high > low else np.empty(0, np.uint64)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate([*values, np.empty(0, np.uint64)]).astype(np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", C.text_key(F.col("text")).alias("text_key"), "text")


def _code(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes()) if len(own) else 0


def prints(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, code, size, simhash`` per row; ``code`` names the set.

    Further rows have ``block, counters`` instead: how often shingles of each slot occur in the rows of one task.
    """
    from eventlake.llm.simhash import fingerprints_of

    names = ["doc_id", "text_key", "code", "size", "simhash", "block", "counters"]
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(FREQUENCY_SLOTS, np.uint32)
        empty = None
        for batch in batches:
            empty = batch.slice(0, 0)
            for start, stop, data, offsets in C.text_chunks(batch.column("text")):
                sets = list(shingle_sets(data, offsets))
                sizes = np.fromiter(map(len, sets), np.int64, len(sets))
                flat = np.concatenate([*sets, np.empty(0, np.uint64)])
                slots, times = np.unique(flat & np.uint64(FREQUENCY_SLOTS - 1), return_counts=True)
                counters[slots.astype(np.int64)] += times.astype(np.uint32)
                part, count = batch.slice(start, stop - start), len(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array(np.array([_code(own) for own in sets], np.uint64).view(np.int64)),
                        pa.array(sizes, pa.int32()),
                        pa.array(fingerprints_of(flat, sizes).view(np.int64)),
                        pa.nulls(count, pa.int32()),
                        pa.nulls(count, pa.binary()),
                    ],
                    names,
                )
        blocks = counters.reshape(-1, _FREQUENCY_BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        for low in range(0, len(some), 64):
            at = some[low : low + 64]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(len(at), empty.column("doc_id").type),
                    *(pa.nulls(len(at), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64())),
                    pa.array(at.astype(np.int32)),
                    pa.array([blocks[i].tobytes() for i in at], pa.binary()),
                ],
                names,
            )

    schema = f"doc_id {kind}, text_key bigint, code bigint, size int, simhash bigint, block int, counters binary"
    return _keyed(documents).mapInArrow(lambda batches: C.giving_back(run(batches)), schema)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by block; one block is held."""

    def row(block: int, total: np.ndarray) -> pa.RecordBatch:
        capped = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([capped.tobytes()])], ["block", "counters"])

    held, total = None, None
    for batch in batches:
        for block, counters in zip(*(batch.column(c).to_pylist() for c in ("block", "counters")), strict=True):
            own = np.frombuffer(counters, np.uint32).astype(np.uint64)
            if block == held:
                total += own
                continue
            if held is not None:
                yield row(held, total)
            held, total = block, own
    if held is not None:
        yield row(held, total)


def frequencies(found: DataFrame) -> np.ndarray:
    """How often shingles of each slot occur in all texts: FREQUENCY_SLOTS numbers whatever the table's size."""
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = found.filter("counters IS NOT NULL").select("block", "counters").repartition(parts, "block")
    total = np.zeros((FREQUENCY_SLOTS // _FREQUENCY_BLOCK, _FREQUENCY_BLOCK), np.uint32)
    for block, counters in rows.sortWithinPartitions("block").mapInArrow(_summed, "block int, counters binary").collect():
        total[block] = np.frombuffer(counters, np.uint32)
    return total.ravel()


# ------------------------------------------------------------------ nodes


def parity(own: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of 4 n slots, or up to twice as many, as words of 64 bits."""
    words = 1 << max(0, (len(own) - 1).bit_length() - 4)
    slots, times = np.unique((own >> np.uint64(20)) & np.uint64(64 * words - 1), return_counts=True)
    bits = np.zeros(64 * words, np.uint8)
    bits[slots.astype(np.int64)] = times & 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def least_difference(a: np.ndarray, b: np.ndarray) -> int:
    """No fewer shingles than this are in one set only. A longer map is folded to the length of the shorter one."""
    if len(a) > len(b):
        a, b = b, a
    b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def nodes_of(documents: DataFrame, frequency: np.ndarray) -> DataFrame:
    """``code, size, leading, parity`` per set: its leading shingles and its bound on differences."""
    shared = documents.sparkSession.sparkContext.broadcast(frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        for batch in batches:
            for _, _, data, offsets in C.text_chunks(batch.column("text")):
                sets = [own for own in shingle_sets(data, offsets) if len(own)]
                leading = []
                for own in sets:
                    order = np.argsort(count[(own & np.uint64(FREQUENCY_SLOTS - 1)).astype(np.int64)], kind="stable")
                    leading.append(own[order[: len(own) - (4 * len(own) + 4) // 5 + 1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array([_code(own) for own in sets], np.uint64).view(np.int64)),
                        pa.array([len(own) for own in sets], pa.int32()),
                        _lists(leading),
                        _lists([parity(own) for own in sets]),
                    ],
                    ["code", "size", "leading", "parity"],
                )

    schema = "code bigint, size int, leading array<bigint>, parity array<bigint>"
    rows = documents.select("text").mapInArrow(lambda batches: C.giving_back(run(batches)), schema)
    return rows.groupBy("code").agg(*[F.first(c).alias(c) for c in ("size", "leading", "parity")])


# ------------------------------------------------------------------ pairs


def bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that sizes and parities allow to be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [batch.column(c) for c in ("pa", "pb")]
            flat = [x.values.to_numpy().view(np.uint64) for x in ends]
            where = [x.offsets.to_numpy() for x in ends]
            total = batch.column("sa").to_numpy().astype(np.int64) + batch.column("sb").to_numpy()
            keep = [
                9 * least_difference(flat[0][where[0][i] : where[0][i + 1]], flat[1][where[1][i] : where[1][i + 1]]) <= total[i]
                for i in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("code").alias(name), F.col("size").alias("s" + name), F.col("parity").alias("p" + name))

    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    rows = rows.filter("5 * least(sa, sb) >= 4 * greatest(sa, sb)")
    return rows.mapInArrow(run, "a bigint, b bigint")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by hub and tile, the hub's own text first; its set and one batch are held."""
    now, own = None, None
    for batch in batches:
        found = []
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("hub", "tile", "code", "partner")), strict=True))
        for start, stop, data, offsets in C.text_chunks(batch.column("text")):
            for (hub, tile, code, partner), other in zip(keys[start:stop], shingle_sets(data, offsets), strict=True):
                if not partner:
                    now, own = (hub, tile), other
                elif now == (hub, tile):
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    if 9 * both >= 4 * (len(own) + len(other)):
                        found.append((hub, code))
        ends = zip(*found, strict=True) if found else ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in ends], ["a", "b"])


def verified(documents: DataFrame, known: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """The ``a, b`` of the pairs that are similar. ``known`` has a ``doc_id, text_key`` for each ``code``."""
    pairs = C.stored(pairs, name)
    if pairs.isEmpty():
        return pairs
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    dealt = pairs.join(sizes, "a").withColumn("tile", F.pmod(F.xxhash64("b"), F.col("tiles")))
    hubs = dealt.select(F.col("a").alias("code"), F.col("a").alias("hub"), "tile", F.lit(False).alias("partner")).distinct()
    others = dealt.select(F.col("b").alias("code"), F.col("a").alias("hub"), "tile", F.lit(True).alias("partner"))
    wanted = C.stored(hubs.union(others).join(known, "code"), name + "-wanted")
    texts = _keyed(documents).filter(C.admission(wanted)(C.document_slot()))
    sent = C.by_document(texts, wanted, "inner").select("hub", "tile", "partner", "code", "text")
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sent.repartition(parts, "hub", "tile").sortWithinPartitions("hub", "tile", "partner")
    similar = dealt.mapInArrow(lambda batches: C.giving_back(_compared(batches)), "a bigint, b bigint")
    return C.stored(similar.distinct(), name + "-similar")


#: Words of the parity maps that are compared first, all pairs of a step at once.
_FOLDS = (1, 4, 16)


def _folded(maps: list[np.ndarray], words: int) -> np.ndarray:
    """Each map folded to that many words; one that has fewer is left at zero."""
    out = np.zeros((len(maps), words), np.uint64)
    for i, own in enumerate(maps):
        if len(own) >= words:
            out[i] = np.bitwise_xor.reduce(own.reshape(-1, words), axis=0)
    return out


def _paired(batches: Iterator[pa.RecordBatch], spanning: bool) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by group; pairs of a group's nodes that are not joined and pass the bounds.

    A group is a shingle with one tile of its nodes or two of them, which meet each other and not themselves. With
    ``spanning`` only as many pairs are given as join what they would join.
    """
    from eventlake.llm.simhash import classes, spanning as span

    held: list[pa.RecordBatch] = []
    keys = ("gram", "low", "high")

    def pairs(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        gram, low, high, tile, code, root, size = (whole.column(c).to_numpy() for c in (*keys, "tile", "code", "root", "size"))
        lists = pa.concat_arrays(whole.column("parity").chunks)
        words_of, where = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        maps = [words_of[i:j] for i, j in zip(where[:-1].tolist(), where[1:].tolist(), strict=True)]
        width = np.array([len(own) for own in maps])
        folds = [_folded(maps, words) for words in _FOLDS]
        _, label = np.unique(root, return_inverse=True)
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(gram))
        open_ = np.minimum.reduceat(root, starts) != np.maximum.reduceat(root, starts)
        row = np.flatnonzero(np.repeat(open_, ends - starts))
        upto = np.repeat(ends, ends - starts)[row]
        work = np.cumsum(upto - row - 1)
        start = 0
        # each row meets the later ones of its group, some rows at a time
        while start < len(row):
            done = work[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(work, done + _PAIRS_AT_ONCE, side="right")))
            count = upto[start:stop] - row[start:stop] - 1
            i = np.repeat(row[start:stop], count)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
            fit = (label[i] != label[j]) & (5 * np.minimum(size[i], size[j]) >= 4 * np.maximum(size[i], size[j]))
            fit &= (low[i] == high[i]) | (tile[i] != tile[j])
            i, j = i[fit], j[fit]
            total = size[i].astype(np.int64) + size[j]
            for words, fold in zip(_FOLDS, folds, strict=True):
                near = 9 * np.bitwise_count(fold[i] ^ fold[j]).sum(1, dtype=np.int64) <= total
                near |= np.minimum(width[i], width[j]) < words
                i, j, total = i[near], j[near], total[near]
            wide = np.flatnonzero(~np.isin(np.minimum(width[i], width[j]), _FOLDS))
            far = [k for k in wide if 9 * least_difference(maps[i[k]], maps[j[k]]) > total[k]]
            i, j = np.delete(i, far), np.delete(j, far)
            if spanning and len(i):
                i, j = span(label, i, j)
                label = classes(int(label.max()) + 1, label[i], label[j])[label]
            if len(i):
                once = np.unique(np.stack([np.minimum(code[i], code[j]), np.maximum(code[i], code[j])]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(once[0]), pa.array(once[1])], ["a", "b"])
            start = stop

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if any(batch.column(k)[0] != batch.column(k)[-1] for k in keys) or len(held) == 1:
            whole = pa.Table.from_batches(held).combine_chunks()
            last = np.ones(whole.num_rows, bool)
            for k in keys:
                values = whole.column(k).to_numpy()
                last &= values == values[-1]
            cut = whole.num_rows - int(last.sum())
            if cut:
                yield from pairs(whole.slice(0, cut))
                held = whole.slice(cut).to_batches()
    if held:
        yield from pairs(pa.Table.from_batches(held).combine_chunks())


def _rooted(rows: DataFrame, found: DataFrame, components: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows with the class of their code under the links as ``root``."""
    joined = components(found).select(F.col("node").alias("code"), F.col("root").alias("joined"))
    return rows.join(joined, "code", "left").withColumn("root", F.coalesce("joined", "code")).drop("joined")


def _open_groups(rows: DataFrame) -> DataFrame:
    """Rows of shingles that nodes of different classes lead with, with the ``least`` node and the number ``n`` of nodes."""
    groups = rows.groupBy("gram").agg(
        F.count("*").alias("n"), F.min("code").alias("least"), F.min("root").alias("r0"), F.max("root").alias("r1")
    )
    return rows.join(groups.filter("r0 < r1").select("gram", "n", "least"), "gram")


def similar_links(
    documents: DataFrame,
    found: DataFrame,
    trie_links: Callable[..., DataFrame],
    components: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``a, b``: links that span the classes of similar codes. ``found`` are the stored ``prints`` of the documents."""
    rows = found.filter("counters IS NULL AND size > 0")
    pick = F.min(F.struct("doc_id", "text_key")).alias("one")
    known = rows.groupBy("code").agg(pick, F.min("simhash").alias("simhash"))
    known = C.stored(known.select("code", "one.doc_id", "one.text_key", "simhash"), "known-sets")

    nodes = C.stored(nodes_of(documents, frequencies(found)), "nodes")
    # neighbours in the trie; sets with the same fingerprint each with the first of them
    firsts = known.groupBy("simhash").agg(F.min("code").alias("first"))
    near = trie_links(firsts.select(F.col("simhash").alias("code")), real=True)
    left, right = (firsts.select(F.col("simhash").alias(x), F.col("first").alias(x + "_code")) for x in ("a", "b"))
    near = near.join(left, "a").join(right, "b").select(F.least("a_code", "b_code").alias("a"), F.greatest("a_code", "b_code").alias("b"))
    same = known.join(firsts, "simhash").filter("code > first").select(F.col("first").alias("a"), F.col("code").alias("b"))
    known = known.drop("simhash")
    links = verified(documents, known, bounded(near.union(same).distinct(), nodes), "trie-pairs")

    leading = _rooted(nodes.select("code", "size", "leading"), links, components)
    leading = leading.select(F.explode("leading").alias("gram"), "code", "size", "root")
    shared = C.stored(_open_groups(leading), "shared-shingles")
    star = shared.filter("code > least").select(F.col("least").alias("a"), F.col("code").alias("b")).distinct()
    links = links.union(verified(documents, known, bounded(star, nodes), "star-pairs"))

    maps = nodes.select("code", "parity")
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for name, spanning in (("first-pairs", True), ("last-pairs", False)):
        left = _open_groups(_rooted(shared.select("gram", "code", "size"), links, components))
        tiles = F.ceil(F.col("n") / TILE).cast("int")
        left = left.withColumn("tile", F.pmod(F.xxhash64("code"), tiles).cast("int")).join(maps, "code")
        left = left.withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        group = [F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")]
        dealt = left.select("gram", *group, "tile", "code", "root", "size", "parity")
        grouped = dealt.repartition(parts, "gram", "low", "high").sortWithinPartitions("gram", "low", "high")
        paired = partial(_paired, spanning=spanning)
        pairs = grouped.mapInArrow(lambda batches, paired=paired: C.giving_back(paired(batches)), "a bigint, b bigint").distinct()
        links = links.union(verified(documents, known, pairs, name))
    return links
