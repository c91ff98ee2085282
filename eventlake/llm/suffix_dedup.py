"""Removal of repeated byte strings by a suffix array that is sorted in two stages.

A byte goes if it lies in a string of SPAN bytes that also starts somewhere else. Strings of SPAN bytes are compared in a suffix
array: only the suffixes that are smaller than their successors are sorted directly, the others are put in their places by a
scan of the buckets, and neighbours with a common prefix of SPAN bytes or more are the repeated strings.

The array of a corpus fits in no task, so it is built in parts that belong together. Of each window of SPAN bytes the 64-byte
gram with the smallest hash is its anchor; equal windows have the same anchor at the same place, so a part has all windows
of some anchors, and a window is in one part only. Anchors that occur once can have no repeated window and are left out.
Neighbouring windows share an anchor, so a part holds stretches of text around anchors; equal stretches are one,
with a count, before any text is moved.

Plan: a first pass over the texts counts anchors (only hashes are shuffled, combined per task); a second one lists where
repeated anchors stand, past a bit map of fixed size that spares most others the shuffle. One place per different stretch is cut out
of its text, parts are sorted in tasks, a few hundred kilobytes at a time, and repeated windows go back to all places of their stretch and on to
their documents. A passage that stands in a third of all documents is one stretch, apart from its edges; an anchor with
more than PART_STRETCHES different stretches is cut up further: its windows are grouped by eights, keyed by the 193
bytes that the eight have in common, and equal stretches are one again.

Edge cases: a null or empty text has no bytes; a text shorter than SPAN loses nothing; rows repeated with id and text are texts of
their own, so they are copies of each other, and each is returned; all copies go, the first one too; extra columns are ignored.
Memory per task is bounded by CHUNK_BYTES or the longest text, about sixty bytes per byte of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm import common as C

SPAN = 200
GRAM = 64
PART_STRETCHES = 20_000
CHUNK_BYTES = 1 << 18
_MAP_BITS = 25
_PLACE_BITS = np.uint64(28)
_GROUP = 8


# ------------------------------------------------------------------ anchors


def _sliding_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest key of each window of ``width`` keys: minima from block starts meet minima to block ends."""
    count = len(keys) - width + 1
    if count <= 0:
        return np.empty(0, keys.dtype)
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(keys.dtype).max, keys.dtype)
    padded[: len(keys)] = keys
    padded = padded.reshape(blocks, width)
    from_start = np.minimum.accumulate(padded, axis=1).ravel()
    to_end = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_end[:count], from_start[width - 1 : width - 1 + count])


def stretches(data: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM):
    """``(row, first window, windows, anchor, anchor hash, stretch hash)`` of the stretches of windows with one anchor.

    Places are relative to the row's text. A stretch of n windows has n + span - 1 bytes.
    """
    nothing = tuple(np.empty(0, np.int64) for _ in range(6))
    if len(data) < span:
        return nothing
    total = C.prefix_hashes(data)
    starts = np.arange(len(data) - gram + 1)
    grams = C.hash_between(total, starts, starts + gram)
    place = ((np.uint64(1) << _PLACE_BITS) - np.uint64(1)) - starts.astype(np.uint64)  # the last of equals is smallest
    keys = (grams >> _PLACE_BITS << _PLACE_BITS) | place
    smallest = _sliding_minima(keys, span - gram + 1)
    at = ((np.uint64(1) << _PLACE_BITS) - np.uint64(1)) - (smallest & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1)))
    at = at.astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(at)]
    inside = np.arange(len(at)) + span <= offsets[row + 1]
    windows = np.flatnonzero(inside)
    if not len(windows):
        return nothing
    new = np.ones(len(windows), bool)
    new[1:] = (np.diff(windows) != 1) | (np.diff(at[windows]) != 0) | (np.diff(row[windows]) != 0)
    first = windows[new]
    count = np.diff(np.append(np.flatnonzero(new), len(windows)))
    own = row[first]
    text_hash = C.hash_between(total, first, first + count + span - 1)
    base = offsets[own]
    return own, first - base, count, at[first] - base, grams[at[first]].view(np.int64), text_hash.view(np.int64)


def _anchor_hashes(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in C.text_chunks(batch.column("text"), CHUNK_BYTES):
                anchors = stretches(data, offsets)[4]
                yield pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64())], ["anchor"])

    return documents.select("text").mapInArrow(run, "anchor bigint")


def _bit_map(anchors: DataFrame) -> np.ndarray:
    """A bit per hash value modulo 2**25; at most 2**19 words reach the driver whatever the input."""
    slot = F.col("anchor").bitwiseAND((1 << _MAP_BITS) - 1)
    words = anchors.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(anchor & 63L as int)))").alias("bits")
    )
    frame = words.toPandas()
    bits = np.zeros(1 << (_MAP_BITS - 6), np.uint64)
    bits[frame["word"].to_numpy(np.int64)] = frame["bits"].to_numpy(np.int64).view(np.uint64)
    return bits


_PLACES = "text_key bigint, anchor bigint, stretch bigint, first bigint, windows bigint, at bigint"


def _places(documents: DataFrame, bits: np.ndarray) -> DataFrame:
    """Where the anchors stand that the bit map admits."""
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for start, stop, data, offsets in C.text_chunks(batch.column("text"), CHUNK_BYTES):
                row, first, windows, at, anchor, stretch = stretches(data, offsets)
                slot = anchor & ((1 << _MAP_BITS) - 1)
                take = (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
                part = batch.slice(start, stop - start)
                rows = pa.array(row[take])
                arrays = [part.column("doc_id").take(rows), part.column("text_key").take(rows)]
                arrays += [pa.array(x[take], pa.int64()) for x in (anchor, stretch, first, windows, at - first)]
                yield pa.RecordBatch.from_arrays(
                    arrays, ["doc_id", "text_key", "anchor", "stretch", "first", "windows", "at"]
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", C.text_key(F.col("text")).alias("text_key"), "text")
    return texts.mapInArrow(run, f"doc_id {kind}, {_PLACES}")


# ------------------------------------------------------------------ two-stage suffix sorting


def _refine(rank: np.ndarray, ties: np.ndarray, order: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Part the tied ranks by a key, given their order by rank and key; returns which are tied still.

    Ranks have gaps: the members of a group move up from its number by their place in it.
    """
    group, ordered = rank[ties[order]], key[order]
    place = np.arange(len(ties))
    opens = np.ones(len(ties), bool)
    opens[1:] = group[1:] != group[:-1]
    new = opens.copy()
    new[1:] |= ordered[1:] != ordered[:-1]
    group_start = np.maximum.accumulate(np.where(opens, place, 0))
    new_start = np.maximum.accumulate(np.where(new, place, 0))
    rank[ties[order]] = group + new_start - group_start
    alone = new.copy()
    alone[:-1] &= new[1:]
    return np.sort(ties[order[~alone]])


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one that starts a symbol later."""
    turn = np.zeros(len(text), np.int8)
    turn[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    turn[-1] = -1
    # equal symbols: as the next different pair decides
    decided = np.where(turn != 0, np.arange(len(text)), len(text) - 1)
    return turn[np.minimum.accumulate(decided[::-1])[::-1]] > 0


def _sort_smaller(text: np.ndarray, smaller: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes smaller than their successors, in order of their first ``depth`` symbols at least.

    They are named by the symbols up to the next such suffix, then by twice as many of these pieces per round. A
    symbol counts together with its kind, so no piece is the start of another one.
    """
    at = np.flatnonzero(smaller)
    if not len(at):
        return at
    symbol = text.astype(np.uint64) * np.uint64(2) + smaller.astype(np.uint64) + np.uint64(1)
    symbol = np.concatenate([symbol, np.zeros(16, np.uint64)])
    ends = np.append(at[1:], len(text) - 1)  # a piece includes the start of the next one
    length = ends - at + 1
    rank = np.zeros(len(at), np.int64)
    # six symbols of ten bits per comparison; only ties of longer pieces go on
    ties, done = np.arange(len(at)), 0
    while len(ties):
        key = np.zeros(len(ties), np.uint64)
        for i in range(done, done + 6):
            inside = i < length[ties]
            key = (key << np.uint64(10)) | np.where(inside, symbol[np.minimum(at[ties] + i, len(symbol) - 1)], np.uint64(0))
        order = np.lexsort((key, rank[ties])) if done else np.argsort(key)
        ties = _refine(rank, ties, order, key)
        done += 6
        ties = ties[length[ties] > done]
    size = np.bincount(rank, minlength=len(at))
    ties, width = np.flatnonzero(size[rank] > 1), 1
    while len(ties):
        # a name of ``width`` pieces covers the symbols up to the piece that many further on
        further = ties + width
        covered = np.where(further < len(at), at[np.minimum(further, len(at) - 1)] - at[ties], depth)
        if (covered >= depth).all():
            break
        following = np.where(further < len(at), rank[np.minimum(further, len(at) - 1)] + 1, 0)
        ties = _refine(rank, ties, np.argsort(rank[ties] * np.int64(len(at) + 2) + following), following)
        width *= 2
    return at[np.argsort(rank)]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a byte text in order of their first ``depth`` bytes at least."""
    smaller = smaller_than_next(text)
    direct = _sort_smaller(text, smaller, depth)
    # the others of a bucket stand before its directly sorted ones, in the order of their successors
    before: list[list[np.ndarray]] = [[] for _ in range(256)]
    last = np.array([len(text) - 1])
    before[int(text[-1])].append(last)
    first_of = np.searchsorted(text[direct], np.arange(257))
    out = []
    for symbol in range(256):
        mine = direct[first_of[symbol] : first_of[symbol + 1]]
        found = before[symbol]
        if not found and not len(mine):
            continue
        head = np.concatenate(found) if found else np.empty(0, np.int64)
        scan = [head]
        more = head
        while len(more):  # successors within the bucket, one symbol further back each time
            earlier = more[more > 0] - 1
            more = earlier[(text[earlier] == symbol) & ~smaller[earlier]]
            scan.append(more)
        bucket = np.concatenate([*scan, mine])
        out.append(bucket)
        earlier = bucket[bucket > 0] - 1
        earlier = earlier[~smaller[earlier] & (text[earlier] > symbol)]
        if not len(earlier):
            continue
        behind = text[earlier]
        order = np.argsort(behind, kind="stable")
        values, starts = np.unique(behind[order], return_index=True)
        for value, part in zip(values, np.split(earlier[order], starts[1:]), strict=True):
            before[int(value)].append(part)
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, span: int = SPAN) -> np.ndarray:
    """How many leading bytes each place in ``order`` shares with the next one, up to ``span``; zero bytes follow the text."""
    padded = np.concatenate([text, np.zeros(span + 8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, "<u8", padded.data, strides=(1,))
    here, there = order[:-1], order[1:]
    prefix = np.full(len(here), span)
    equal = np.arange(len(here))
    for at in range(0, span, 8):
        unlike = eight[here[equal] + at] ^ eight[there[equal] + at]
        ends = unlike != 0
        lowest = unlike[ends] & -unlike[ends]
        prefix[equal[ends]] = np.minimum(at + np.log2(lowest.astype(float)).astype(np.int64) // 8, span)
        equal = equal[~ends]
    return prefix


def repeated_windows(text: np.ndarray, window: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Which of the flagged places start a string of ``span`` bytes that another flagged place starts too."""
    order = suffix_array(text, span)
    order = order[window[order]]
    hit = np.zeros(len(text), bool)
    if len(order) > 1:
        same = common_prefixes(text, order, span) >= span
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
    return hit


# ------------------------------------------------------------------ parts


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _sorted_part(part: pa.Table, span: int) -> pa.RecordBatch:
    """``part_key, piece, low, high``: runs of repeated windows [low, high) of each stretch."""
    keys, names = part.column("part_key").to_numpy(), part.column("piece").to_numpy()
    once = np.ones(part.num_rows, bool)
    once[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
    part = part.filter(pa.array(once)).combine_chunks()
    data, offsets = C.text_bytes(part.column("bytes"))
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    copies = part.column("copies").to_numpy()
    length = np.diff(offsets)
    # no window reaches over the end of its stretch
    window = np.arange(len(data)) < np.repeat(offsets[1:] - span + 1, length)
    hit = repeated_windows(data, window, span) if len(data) else np.zeros(0, bool)
    hit |= window & np.repeat(copies > 1, length)
    low, high = _runs(hit)
    owner = np.searchsorted(offsets, low, side="right") - 1
    # runs of two stretches never touch: the last bytes of a stretch start no window
    rows = pa.array(owner)
    return pa.RecordBatch.from_arrays(
        [
            part.column("part_key").combine_chunks().take(rows),
            part.column("piece").combine_chunks().take(rows),
            pa.array(low - offsets[owner]),
            pa.array(high - offsets[owner]),
        ],
        ["part_key", "piece", "low", "high"],
    )


def _sorted_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by part; whole parts are taken together up to a size."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        while batch.num_rows:
            _, offsets = C.text_bytes(batch.column("bytes"))
            fits = int(np.searchsorted(offsets, offsets[0] + CHUNK_BYTES, side="right")) - 1
            fits = min(max(fits, 1), batch.num_rows)
            held.append(batch.slice(0, fits))
            size += int(offsets[fits] - offsets[0])
            batch = batch.slice(fits)
            if size >= CHUNK_BYTES:
                whole = pa.Table.from_batches(held).combine_chunks()
                key = whole.column("part_key").to_numpy()
                cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
                if cut:
                    yield _sorted_part(whole.slice(0, cut).combine_chunks(), SPAN)
                    held = whole.slice(cut).to_batches()
                    size = sum(int(C.text_bytes(b.column("bytes"))[1][[0, -1]] @ [-1, 1]) for b in held)
    if held:
        yield _sorted_part(pa.Table.from_batches(held).combine_chunks(), SPAN)


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the listed stretches of each text; stretches of crowded anchors in groups of windows."""
    for batch in batches:
        data, offsets = C.text_bytes(batch.column("text"))
        lists = batch.column("wanted")
        bounds = lists.offsets.to_numpy()
        row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        struct = lists.values.slice(bounds[0], bounds[-1] - bounds[0])
        anchor, stretch, first, windows, at, copies = (
            struct.field(n).to_numpy(zero_copy_only=False) for n in ("anchor", "stretch", "first", "windows", "at", "copies")
        )
        crowded = struct.field("crowded").to_numpy(zero_copy_only=False).astype(bool)
        start = offsets[row] + first
        raw = data.tobytes() if crowded.any() else b""
        out: list[tuple] = []
        for i in np.flatnonzero(~crowded):
            end = start[i] + windows[i] + SPAN - 1
            out.append((anchor[i], stretch[i], 0, anchor[i], stretch[i], copies[i], 0, start[i], end))
        for i in np.flatnonzero(crowded):
            # windows by how far the anchor is from their start, eight by eight
            far = at[i] - np.arange(windows[i])
            for group in np.unique(far // _GROUP):
                own = np.flatnonzero(far // _GROUP == group)
                low, high = start[i] + own[0], start[i] + own[-1] + SPAN
                core = start[i] + at[i] - _GROUP * group
                key = _digest(raw[core : core + SPAN - _GROUP + 1] + b"%d" % group)
                out.append((anchor[i], stretch[i], own[0], key, _digest(raw[low:high]), copies[i], 1, low, high))
        if not out:
            continue
        *numbers, many, lows, highs = (np.array(x, np.int64) for x in zip(*out, strict=True))
        sizes = highs - lows
        ends = np.cumsum(sizes)
        taken = np.repeat(lows - (ends - sizes), sizes) + np.arange(ends[-1])
        pieces = pa.Array.from_buffers(
            pa.large_binary(),
            len(lows),
            [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(data[taken])],
        ).cast(pa.binary())
        names = ["anchor", "stretch", "skip", "part_key", "piece", "copies", "crowded", "bytes"]
        yield pa.RecordBatch.from_arrays([*map(pa.array, numbers), pa.array(many == 1), pieces], names)


_PIECES = (
    "anchor bigint, stretch bigint, skip bigint, part_key bigint, piece bigint, copies bigint, crowded boolean, bytes binary"
)


def _digest(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


# ------------------------------------------------------------------ the operator


def _repeated_places(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, anchor, stretch, first, windows, at, rows``: where anchors that occur twice or more stand."""
    counted = _anchor_hashes(documents).groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    repeated = C.stored(counted.select("anchor"), "anchors")
    places = _places(documents, _bit_map(repeated)).join(repeated, "anchor", "left_semi")
    # a row that is repeated lists its places as often, which is how often they count
    place = ["doc_id", "text_key", "anchor", "stretch", "first", "windows", "at"]
    return places.groupBy(*place).agg(F.count("*").alias("rows"))


def _different_stretches(places: DataFrame) -> DataFrame:
    """``anchor, stretch, copies`` and one place of each."""
    one = F.min(F.struct("doc_id", "text_key", "first", "windows", "at")).alias("one")
    different = places.groupBy("anchor", "stretch").agg(F.sum("rows").alias("copies"), one)
    return different.select("anchor", "stretch", "copies", "one.*")


def _cut_pieces(documents: DataFrame, different: DataFrame) -> DataFrame:
    """The bytes of each different stretch; only texts that the bit map of those with one admits are shuffled."""
    crowds = different.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > PART_STRETCHES)
    wanted = different.join(crowds, "anchor", "left").withColumn("crowded", F.col("n").isNotNull())
    fields = ["anchor", "stretch", "first", "windows", "at", "copies", "crowded"]
    wanted = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct(*fields)).alias("wanted"))
    asked = _admitted_texts(documents, different).filter("admitted")
    return C.by_document(asked, wanted, "inner").select("text", "wanted").mapInArrow(_cut_out, _PIECES)


def _admitted_texts(documents: DataFrame, listed: DataFrame) -> DataFrame:
    """``doc_id, text_key, text, admitted``: all texts; those that are listed are admitted, and few others."""
    texts = documents.select("doc_id", C.text_key(F.col("text")).alias("text_key"), "text")
    return texts.withColumn("admitted", C.admission(listed)(C.document_slot()))


def _sorted_runs(pieces: DataFrame) -> DataFrame:
    """``anchor, stretch, low, high``: runs of repeated windows of each stretch, parts sorted in tasks."""
    # pieces of crowded anchors may be equal across stretches; a text that is repeated as a row gives each piece twice
    source = F.struct("anchor", "stretch")
    copies = F.when(F.min(source) != F.max(source), F.lit(2).cast("long")).otherwise(F.max("copies"))
    merged = pieces.filter("crowded").groupBy("part_key", "piece")
    merged = merged.agg(copies.alias("copies"), F.first("bytes").alias("bytes"))
    whole = pieces.filter("NOT crowded").select("part_key", "piece", "copies", "bytes").union(merged)

    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = (
        whole.repartition(4 * parts, "part_key")
        .sortWithinPartitions("part_key", "piece")
        .mapInArrow(_sorted_parts, "part_key bigint, piece bigint, low bigint, high bigint")
    )
    found = runs.join(pieces.select("anchor", "stretch", "skip", "part_key", "piece"), ["part_key", "piece"])
    low, high = F.col("low") + F.col("skip"), F.col("high") + F.col("skip")
    return found.select("anchor", "stretch", low.alias("low"), high.alias("high"))


def repeated_spans(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, spans``: of each document that has some, runs of bytes [low, high) that lie in repeated strings.

    Runs may overlap. Each step is stored and its shuffle files go before the next one; at the end only the result stays.
    """

    def step(rows: DataFrame, name: str, keep: bool = False) -> DataFrame:
        rows = C.stored(rows, name, keep)
        C.let_shuffles_go(rows.sparkSession)
        return rows

    with C.scratch(documents.sparkSession):
        places = step(_repeated_places(documents), "places")
        different = step(_different_stretches(places), "stretches")
        pieces = step(_cut_pieces(documents, different), "pieces")
        found = step(_sorted_runs(pieces), "runs")
        low, high = F.col("first") + F.col("low"), F.col("first") + F.col("high") + SPAN - 1
        spans = places.join(found, ["anchor", "stretch"]).groupBy("doc_id", "text_key")
        spans = spans.agg(F.collect_set(F.struct(low.alias("low"), high.alias("high"))).alias("spans"))
        return step(spans, "spans", keep=True)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = C.text_bytes(batch.column("text"))
        removed, count, kept = [], [], []
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            raw = data[offsets[i] : offsets[i + 1]]
            gone = np.zeros(len(raw) + 1, np.int32)
            for span in spans or ():
                gone[span["low"]] += 1
                gone[span["high"]] -= 1
            gone = np.cumsum(gone[:-1]) > 0
            low, high = _runs(gone)
            removed.append(int((high - low).sum()))
            count.append(len(low))
            kept.append(raw[~gone].tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(offsets)),
                pa.array(removed, pa.int64()),
                pa.array(count, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def deduplicated(documents: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` per row; ``kept`` are the remaining bytes."""
    spans = repeated_spans(documents)
    texts = _admitted_texts(documents, spans)
    asked = C.by_document(texts.filter("admitted"), spans, "left").select(texts["doc_id"], "text", "spans")
    kind = documents.schema["doc_id"].dataType.simpleString()
    cut = asked.mapInArrow(
        _without, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )
    whole, nothing = F.coalesce("text", F.lit("")), F.lit(0).cast("bigint")
    free = texts.filter("NOT admitted").select(
        "doc_id",
        F.octet_length(whole).cast("bigint").alias("n_bytes"),
        nothing.alias("n_removed"),
        nothing.alias("n_spans"),
        whole.cast("binary").alias("kept"),
    )
    return cut.union(free)
