"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

A fingerprint has a bit where more than half of the text's word shingles have it in their hash. Two texts are linked if
their fingerprints differ in at most BUDGET bits; a class is whatever links reach.

The trie is walked in pairs of nodes: both nodes go down together, differing bits add up, and a pair of nodes is dropped
once they exceed the budget. To deal the walk out over a cluster, the 64 bits are read in fifteen orders, each of
which puts two of six blocks on top. Four differing bits leave at least two blocks equal, so every link lies below
one node of depth two blocks in one of these tries, and tasks get whole subtries. A subtrie with more than TILE
fingerprints is cut into tiles by hash, and each pair of tiles is walked by a task of its own.

Equal fingerprints are one node from the start, so copies never meet each other as pairs. A task reports a spanning
star per class that it finds instead of all links; stars are then merged by alternating large-star and small-star steps,
each written to the shared folder.

Edge cases: a null, empty or blank text has the fingerprint zero and is linked like any other; a text with fewer words
than a shingle is one shingle; repeated rows share a class; rows without an id count when texts are linked, and their class
has a null id only if no row of it has one; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm import common as C
from eventlake.llm import similar_texts

SHINGLE = 4
BUDGET = 4
SEED = 42
TILE = 4096
#: Width of the six blocks, from the lowest bit up.
BLOCKS = (11, 11, 11, 11, 10, 10)
_LEAF_PAIRS = 256
_PAIRS_AT_ONCE = 1 << 20
_ROWS_AT_ONCE = 1 << 17


# ------------------------------------------------------------------ fingerprints

#: Byte to eight one-byte counters, the lowest bit in the lowest counter.
_SPREAD = (
    ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.uint8).copy().view(np.uint64).reshape(256)
)


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    """XXH64 of each run of ``size`` words joined by blanks; of all words where there are fewer."""
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)] if words else []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: -size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[i:j], SEED) for i, j in zip(starts, ends[size - 1 :].tolist(), strict=True)]


def fingerprints_of(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint per text from all texts' hashes in a row; zero where a text has none."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    ends = np.cumsum(counts[some])
    starts = ends - counts[some]
    # counters of one byte hold up to 255 hashes, so a text is summed in blocks of that many
    blocks = -(-counts[some] // 255)
    first = np.cumsum(blocks) - blocks
    inner = np.arange(blocks.sum()) - np.repeat(first, blocks)
    spread = _SPREAD[hashes.view(np.uint8)].reshape(-1, 8)
    sums = np.add.reduceat(spread, np.repeat(starts, blocks) + 255 * inner, axis=0)
    ones = np.add.reduceat(sums.view(np.uint8).reshape(-1, 64).astype(np.int64), first, axis=0)
    bits = (2 * ones > counts[some][:, None]).astype(np.uint8)
    out[some] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, text_key, code`` per row; the code is the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, data, offsets in C.text_chunks(batch.column("text")):
                raw = data.tobytes()
                hashes = [shingle_hashes(raw[offsets[i] : offsets[i + 1]], size) for i in range(stop - start)]
                counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
                flat = np.fromiter((h for own in hashes for h in own), np.uint64, int(counts.sum()))
                part = batch.slice(start, stop - start)
                codes = fingerprints_of(flat, counts).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(codes)], ["doc_id", "text_key", "code"]
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", C.text_key(F.col("text")).alias("text_key"), "text")
    return texts.mapInArrow(run, f"doc_id {kind}, text_key bigint, code bigint")


# ------------------------------------------------------------------ the walk over pairs of nodes


def classes(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest number that each of ``size`` numbers reaches over the given links."""
    label = np.arange(size)
    while True:
        a, b = label[left], label[right]
        open_ = a != b
        if not open_.any():
            return label
        left, right = left[open_], right[open_]
        np.minimum.at(label, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter


def _leaf_links(codes: np.ndarray, nodes: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between the fingerprints of small node pairs (rows: from, to, from, to, same)."""
    a0, a1, b0, b1, same = nodes
    wide = b1 - b0
    work = (a1 - a0) * wide
    cuts = np.searchsorted(np.cumsum(work), np.arange(_PAIRS_AT_ONCE, work.sum() + _PAIRS_AT_ONCE, _PAIRS_AT_ONCE)) + 1
    start = 0
    for stop in np.unique(np.minimum(cuts, len(work))):
        part = slice(start, stop)
        pair = np.repeat(np.arange(start, stop), work[part])
        inner = np.arange(len(pair)) - np.repeat(np.cumsum(work[part]) - work[part], work[part])
        i, j = a0[pair] + inner // wide[pair], b0[pair] + inner % wide[pair]
        near = np.bitwise_count(codes[i] ^ codes[j]) <= budget
        near &= ~same[pair].astype(bool) | (i < j)
        yield i[near], j[near]
        start = stop


def spanning(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links between i and j one for each pair of different classes."""
    a, b = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
    open_ = np.flatnonzero(a != b)
    _, first = np.unique(a[open_] * np.int64(len(label)) + b[open_], return_index=True)
    return i[open_][first], j[open_][first]


def trie_links(
    codes: np.ndarray, nodes: np.ndarray, budget: int = BUDGET, seen: list[tuple[np.ndarray, np.ndarray]] | None = None
) -> np.ndarray:
    """Class of each code under all links found below the given pairs of nodes.

    ``nodes`` has columns (from, to, from, to, same): ranges of ``codes`` in which the codes are sorted. ``seen`` takes up
    links that span the classes.
    """
    label = np.arange(len(codes))
    a0, a1, b0, b1, same = nodes
    differ = np.zeros(len(a0), np.int64)
    for bit in range(63, -2, -1):
        small = ((a1 - a0) * (b1 - b0) <= _LEAF_PAIRS) | (bit < 0)
        if small.any():
            for i, j in _leaf_links(codes, np.stack([x[small] for x in (a0, a1, b0, b1, same)]), budget):
                if seen is not None:
                    seen.append(spanning(label, i, j))
                label = classes(len(codes), label[i], label[j])[label]
        a0, a1, b0, b1, same, differ = (x[~small] for x in (a0, a1, b0, b1, same, differ))
        if not len(a0):
            break
        ones = np.concatenate([[0], np.cumsum((codes >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        other = same == 0
        parts = [
            (a0, am, b0, bm, same, differ),
            (am, a1, bm, b1, same, differ),
            (a0, am, bm, b1, np.zeros_like(same), differ + 1),
            tuple(x[other] for x in (am, a1, b0, bm, same, differ + 1)),
        ]
        a0, a1, b0, b1, same, differ = (np.concatenate(x) for x in zip(*parts, strict=True))
        live = (a1 > a0) & (b1 > b0) & (differ <= budget)
        a0, a1, b0, b1, same, differ = (x[live] for x in (a0, a1, b0, b1, same, differ))
    return label


def _walk(frame: pa.Table, real: bool) -> pa.RecordBatch:
    """Stars of the classes within each (subtrie, low, high) group of rows, or real links that span them."""
    subtrie, low, high, tile, codes = (frame.column(c).to_numpy() for c in ("subtrie", "low", "high", "tile", "code"))
    codes = codes.view(np.uint64)
    order = np.lexsort((codes, tile, high, low, subtrie))
    subtrie, low, high, tile, codes = (x[order] for x in (subtrie, low, high, tile, codes))
    new_group = np.ones(len(codes), bool)
    new_group[1:] = (np.diff(subtrie) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)
    starts = np.flatnonzero(new_group)
    ends = np.append(starts[1:], len(codes))
    group = np.cumsum(new_group) - 1
    in_low = np.bincount(group, tile == low, len(starts)).astype(np.int64)
    same = low[starts] == high[starts]
    middle = starts + in_low
    nodes = np.stack([starts, np.where(same, ends, middle), np.where(same, starts, middle), ends, same.astype(np.int64)])
    nodes = nodes[:, (nodes[1] > nodes[0]) & (nodes[3] > nodes[2])]
    if real:
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        trie_links(codes, nodes, seen=seen)
        none = np.empty(0, np.int64)
        ends = [codes[np.concatenate([none, *side])].view(np.int64) for side in zip(*seen, strict=True)] or [none, none]
        return pa.RecordBatch.from_arrays([pa.array(ends[0]), pa.array(ends[1])], ["a", "b"])
    label = trie_links(codes, nodes)
    linked = label != np.arange(len(codes))
    return pa.RecordBatch.from_arrays(
        [pa.array(codes[linked].view(np.int64)), pa.array(codes[label[linked]].view(np.int64))], ["a", "b"]
    )


def _walk_partition(batches: Iterator[pa.RecordBatch], real: bool) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by group; whole groups are taken together until there are enough rows."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= _ROWS_AT_ONCE:
            whole = pa.Table.from_batches(held).combine_chunks()
            keys = [whole.column(c).to_numpy() for c in ("subtrie", "low", "high")]
            last = np.ones(whole.num_rows, bool)
            for key in keys:
                last &= key == key[-1]
            cut = whole.num_rows - int(last.sum())
            if cut:
                yield _walk(whole.slice(0, cut), real)
                held, rows = whole.slice(cut).to_batches(), whole.num_rows - cut
    if held:
        yield _walk(pa.Table.from_batches(held).combine_chunks(), real)


def _subtries(code: Column) -> Column:
    """The fifteen nodes, two blocks deep, below which a code stands."""
    blocks, low = [], 0
    for width in BLOCKS:
        blocks.append(F.shiftrightunsigned(code, low).bitwiseAND((1 << width) - 1))
        low += width
    return F.array(
        *(
            F.lit(rank << 32) + F.shiftleft(blocks[i], 11) + blocks[j]
            for rank, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))
        )
    )


def links(codes: DataFrame, real: bool = False) -> DataFrame:
    """``a, b``: links that span the classes of distinct ``code`` values, a few per code.

    Each stands for a way of links within the budget; with ``real`` each is such a link itself.
    """
    below = codes.select("code", F.explode(_subtries(F.col("code"))).alias("subtrie"))
    sizes = below.groupBy("subtrie").agg(F.count("*").alias("size")).filter("size > 1")
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    tile = F.pmod(F.xxhash64("code"), tiles).cast("int")
    other = F.explode(F.sequence(F.lit(0), tiles - 1))
    dealt = (
        below.join(sizes, "subtrie")
        .withColumn("tile", tile)
        .withColumn("other", other)
        .select("subtrie", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "code")
    )
    parts = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.repartition(parts, "subtrie", "low", "high")
        .sortWithinPartitions("subtrie", "low", "high")
        .mapInArrow(partial(_walk_partition, real=real), "a bigint, b bigint")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with a link: the smallest node that it reaches."""
    edges = C.stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b", "a") % 999_983)).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("least"))
        # each node goes to the lowest of its lower neighbours, and so do these
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a > b")
        edges = C.stored(small.union(lowest.select("a", F.col("least").alias("b"))).distinct(), "links")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, code, root, component_id`` per row of the documents; ``root`` names the class."""
    rows = C.stored(fingerprints(documents), "fingerprints")
    nodes = rows.groupBy("code").agg(F.min("doc_id").alias("least_id"))
    reached = components(links(rows.select("code").distinct()))
    member = nodes.join(reached, nodes["code"] == reached["node"], "left").select(
        "code", F.coalesce("root", "code").alias("root"), "least_id"
    )
    least = member.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rows.join(member.join(least, "root").select("code", "root", "component_id"), "code").select(
        "doc_id", "text_key", "code", "root", "component_id"
    )


def hex_code(code: Column) -> Column:
    return F.lpad(F.lower(F.hex(code)), 16, "0")


def one_of_each(documents: DataFrame) -> DataFrame:
    """One document per class stays, the one with the smallest id; of rows repeated with id and text, one.

    Here texts are linked if the sets of their five-word shingles have a Jaccard similarity of at least 0.8. The trie finds
    what differs in few bits, each link checked on the sets; texts this alike differ in up to 13 bits and more, where
    bits prune too little, so ``similar_texts`` finds the rest by shared shingles. Rows without an id stay only where their
    whole class has none, the smallest text key then.

    Texts that go, and those repeated with their id, are listed; only rows that the list's bit map admits are shuffled.
    """
    with C.scratch(documents.sparkSession):
        found = C.stored(similar_texts.prints(documents), "shingle-prints")
        reached = components(similar_texts.similar_links(documents, found, links, components))
        prints = found.filter("counters IS NULL")
        member = prints.join(reached, prints["code"] == reached["node"], "left").withColumn("root", F.coalesce("root", "code"))
        rows = member.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n"))
        # the first document of a class, and how many rows it has; of a class of copies that is one row a task
        order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
        pick = rows.groupBy("root").agg(F.min(order).alias("pick"))
        rows = rows.join(pick, "root").withColumn("stays", order == F.col("pick"))
        listed = C.stored(rows.filter("n > 1 OR NOT stays").select("doc_id", "text_key", "stays"), "listed", keep=True)
    admitted = C.admission(listed)
    texts = C.keyed_rows(documents).drop("whole_text").withColumn("admitted", admitted(C.document_slot()))
    asked = C.by_document(texts.filter("admitted"), listed, "left").select("row", texts["doc_id"], texts["text_key"], "stays")
    once = asked.filter("stays").dropDuplicates(["doc_id", "text_key"])
    kept = texts.filter("NOT admitted").select("row").union(asked.filter("stays IS NULL").select("row")).union(once.select("row"))
    return kept.select("row.*")
