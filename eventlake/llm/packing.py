"""Hierarchical packing of tokenised documents into sequences of several context sizes.

A document longer than the longest window gives whole windows; what is left of it, or all of a shorter one, goes to the
tier of the smallest context size that holds it. The longest tier is packed first and its gaps are filled with the
best-fitting pieces of shorter tiers, which are cut where none fits, and with cuts of other long pieces where there are no
shorter ones; then each shorter tier is packed into windows of its own size, which are cut to be
exactly full. Sequences are dealt to step groups so that the groups of a task have nearly equal numbers of tokens.

Tokenisation and packing happen in one narrow pass: a task packs the texts of its partition a few megabytes at a time and
carries what does not fill a window over to the next megabytes, so ids never cross a shuffle and a hot source or a very
long text changes nothing. A lost task is repeated with the same rows and gives the same sequences.

Edge cases: a null or empty text is its end mark alone; repeated rows are packed each; a document of any length is cut into
as many pieces as needed, none empty; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from array import array
from bisect import bisect_left, bisect_right, insort
from codecs import charmap_decode
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm import common as C

TIERS = (2048, 1024, 512, 256)
END = 1
#: Tokens of a step group, about.
STEP_TOKENS = 64 * TIERS[0]
TEXT_BYTES = 1 << 20
#: Words after which the cache keeps half as many at most. What a worker holds counts against its executor in all stages.
_CACHE_WORDS = 200_000
#: Parts that go to the model as one line.
_LINE_PARTS = 100
#: Chunks after which unused memory is handed back.
_GIVE_BACK_CHUNKS = 8


class WordTokens:
    """Ids of white-space separated words, each encoded once.

    The tokenizer drops white space before it looks at words, so a text's ids are those of its words in a row. Words of
    a chunk are told apart by Arrow, and those not met before are encoded together: words of ASCII and Latin letters need
    no more than lower case and the tokenizer's rule for parts, and go to its model as lines of parts; any other word
    goes through the whole tokenizer. Most words are met once, so a full cache keeps only words met again.
    """

    def __init__(self, path: str):
        # a task has one core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.by_part = Tokenizer(self.tokenizer.model)
        self.by_part.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # the model marks the last token of a part
        self.is_last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.is_last[[at for token, at in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        letters = "".join(c for c in map(chr, range(0x61, 0x250)) if c.isalpha() and len(c.lower()) == 1 and c.lower() < "\u0250")
        self.odd = re.compile(rf"<\||[^\n!-~{letters}]").search
        self.parts = re.compile(rf"\n|'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[0-9]|[^\n0-9{letters}]+").findall
        # how the model spells bytes
        by_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        spelling = {ord(" "): " ", ord("\n"): "\n"}
        for c in [*map(chr, range(0x21, 0x7F)), *letters]:
            spelling |= zip(c.encode(), by_bytes.pre_tokenize_str(c)[0][0], strict=True)
        self.spelling = "".join(spelling.get(b, "\ufffe") for b in range(256))
        self._start()

    def _start(self) -> None:
        self.number: dict[str, int] = {"": 1}
        # number 0 is the end mark
        self.flat, self.starts, self.lengths = array("I", [END]), array("q", [0, 1]), array("q", [1, 0])
        #: chunks in which each word was met again; halved whenever words are forgotten
        self.met = array("I", [0, 0])

    def _forget(self) -> None:
        """Words met again stay, half a cache of them at most, those met in the most chunks."""
        words, flat, starts, lengths, met = (
            [*self.number],
            *(np.array(x) for x in (self.flat, self.starts, self.lengths, self.met)),
        )
        self._start()
        again = np.flatnonzero(met[2:]) + 2
        most = np.argsort(met[again], kind="stable")[max(0, len(again) - _CACHE_WORDS // 2) :]
        stay = np.sort(again[most])
        lengths = lengths[stay]
        at = np.repeat(starts[stay] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        # the empty word is number 1 and stands first
        self._keep([words[i - 1] for i in stay.tolist()], flat[at], lengths)
        self.met[2:] = array("I", (met[stay] // 2).tolist())

    def _keep(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.starts), len(self.starts) + len(words)), strict=True))
        self.met.frombytes(bytes(4 * len(words)))
        self.starts.frombytes((len(self.flat) + np.cumsum(lengths) - lengths).astype(np.int64).tobytes())
        self.lengths.frombytes(lengths.astype(np.int64).tobytes())
        self.flat.frombytes(ids.astype(np.uint32).tobytes())

    def _learn(self, words: list[str]) -> None:
        odd = [w for w in words if self.odd(w)] if self.odd("\n".join(words)) else []
        if odd:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)]
            self._keep(odd, np.array([*chain.from_iterable(found)], np.uint32), np.array([len(ids) for ids in found]))
        if len(odd) == len(words):
            return
        plain = [w for w in words if not self.odd(w)] if odd else words
        # each word's parts and a line feed
        parts = self.parts("\n".join([*plain, ""]).lower())
        lines = [" ".join(parts[at : at + _LINE_PARTS]) for at in range(0, len(parts), _LINE_PARTS)]
        lines = [line if line.isascii() else charmap_decode(line.encode(), "strict", self.spelling)[0] for line in lines]
        found = [e.ids for e in self.by_part.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
        part_ends = np.flatnonzero(self.is_last[ids]) + 1
        ends = np.array([at for at, part in enumerate(parts) if part == "\n"])
        if len(part_ends) != len(parts) - len(plain):
            raise ValueError("the tokenizer's model does not mark the end of each part")
        ends = part_ends[ends - np.arange(1, len(plain) + 1)]
        self._keep(plain, ids, np.diff(ends, prepend=0))

    @staticmethod
    def _lower(text: str) -> str:
        # what may be a special token keeps its case
        return " ".join(w.decode() if b"<|" in w else w.lower().decode() for w in text.encode().split())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with its end mark, and the number of ids of each."""
        if len(self.number) > _CACHE_WORDS:
            self._forget()
        texts = pc.fill_null(texts, "")
        lower = pc.ascii_lower(texts)
        special = pc.match_substring(texts, "<|")
        if pc.any(special).as_py():
            lower = pc.replace_with_mask(
                lower, special, pa.array([self._lower(t) for t in texts.filter(special).to_pylist()], lower.type)
            )
        split = pc.ascii_split_whitespace(lower)
        n_words = pc.list_value_length(split).to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        np.frombuffer(self.met, np.uint32)[number[number >= 0]] += 1
        new = np.flatnonzero(number < 0)
        if len(new):
            unmet = [words[i] for i in new]
            self._learn(unmet)
            number[new] = [self.number[w] for w in unmet]
        number = np.insert(number[coded.indices.to_numpy()], np.cumsum(n_words), 0)
        lengths = np.frombuffer(self.lengths, np.int64)[number]
        starts = np.frombuffer(self.starts, np.int64)[number]
        before = np.cumsum(lengths) - lengths
        ids = np.frombuffer(self.flat, np.uint32)[np.repeat(starts - before, lengths) + np.arange(lengths.sum())]
        return ids, np.add.reduceat(lengths, np.cumsum(n_words + 1) - n_words - 1) if len(texts) else np.empty(0, np.int64)


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One per Python worker, which goes on with it from task to task."""
    return WordTokens(path)


@dataclass(slots=True)
class Piece:
    row: int
    start: int
    length: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return Piece(self.row, self.start, length), Piece(self.row, self.start + length, self.length - length)


class Pool:
    """Pieces by length; ties keep the order in which they came."""

    def __init__(self):
        self.keys: list[tuple[int, int]] = []
        self.pieces: dict[int, Piece] = {}
        self.count = 0

    def add(self, piece: Piece) -> None:
        insort(self.keys, (piece.length, self.count))
        self.pieces[self.count] = piece
        self.count += 1

    def fill(self, pieces: list[Piece]) -> None:
        for piece in pieces:
            self.keys.append((piece.length, self.count))
            self.pieces[self.count] = piece
            self.count += 1
        self.keys.sort()

    def _pop(self, at: int) -> Piece:
        return self.pieces.pop(self.keys.pop(at)[1])

    def longest(self, most: int) -> Piece | None:
        """Take out the longest piece of at most ``most`` tokens."""
        at = bisect_right(self.keys, (most, self.count)) - 1
        return self._pop(at) if at >= 0 else None

    def shortest(self, over: int) -> Piece | None:
        """Take out the shortest piece of more than ``over`` tokens."""
        at = bisect_left(self.keys, (over + 1, 0))
        return self._pop(at) if at < len(self.keys) else None

    def __len__(self) -> int:
        return len(self.keys)


def pack(pieces: list[Piece], final: bool) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """``(sequences with their tier, pieces left over)``; nothing is left over at the ``final`` call."""
    longest = TIERS[0]
    out: list[tuple[int, list[Piece]]] = []
    long: list[Piece] = []
    short: list[Piece] = []
    for piece in pieces:
        while piece.length >= longest:
            head, piece = piece.cut(longest)
            out.append((longest, [head]))
        if piece.length > TIERS[1]:
            long.append(piece)
        elif piece.length:
            short.append(piece)
    pool = Pool()
    pool.fill(short)
    left: list[Piece] = []
    waiting = deque(sorted(long, key=lambda p: -p.length))
    while waiting:
        piece = waiting.popleft()
        window, gap = [piece], longest - piece.length
        while gap and (more := pool.longest(gap)):
            window.append(more)
            gap -= more.length
        if gap and (more := pool.shortest(gap)):
            head, rest = more.cut(gap)
            window.append(head)
            pool.add(rest)
            gap = 0
        while gap and waiting:
            # the pool is empty: the shortest of the long pieces, which stays the shortest
            more = waiting.pop()
            head, rest = more.cut(min(gap, more.length))
            window.append(head)
            gap -= head.length
            if rest.length > TIERS[1]:
                waiting.append(rest)
            elif rest.length:
                pool.add(rest)
        if gap:
            left += window
        else:
            out.append((longest, window))
    for tier, below in zip(TIERS[1:], (*TIERS[2:], 0), strict=True):
        while (piece := pool.longest(tier)) is not None:
            if piece.length <= below:
                pool.add(piece)
                break
            window, gap = [piece], tier - piece.length
            while gap and (more := pool.longest(gap)):
                window.append(more)
                gap -= more.length
            if gap and (more := pool.shortest(gap)):
                head, rest = more.cut(gap)
                window.append(head)
                pool.add(rest)
                gap = 0
            if gap:
                left += window
            else:
                out.append((tier, window))
    if not final:
        return out, left
    # the last pieces of a task: one after the other into the largest windows they fill, the rest is padded
    total = sum(p.length for p in left)
    for tier in TIERS:
        while total >= tier:
            window, room = [], tier
            while room:
                piece = left.pop()
                if piece.length > room:
                    piece, rest = piece.cut(room)
                    left.append(rest)
                window.append(piece)
                room -= piece.length
            out.append((tier, window))
            total -= tier
    if left:
        out.append((TIERS[0], left))
    return out, []


def _steps(lengths: list[int]) -> list[int]:
    """Step group of each sequence: longest first, to and fro over the groups."""
    groups = max(1, round(sum(lengths) / STEP_TOKENS))
    step = [0] * len(lengths)
    for rank, i in enumerate(sorted(range(len(lengths)), key=lambda i: -lengths[i])):
        turn, at = divmod(rank, groups)
        step[i] = groups - 1 - at if turn % 2 else at
    return step


_SCHEMA = (
    "doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, tier int, step_id bigint"
)


def packed(documents: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece, with its ids as little-endian 32-bit numbers, its sequence and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(tokenizer)
        first_id = TaskContext.get().partitionId() << 33
        sequences = steps = chunks = 0
        left: list[tuple[object, np.ndarray, int, Piece]] = []  # id, ids of the piece, tokens of its document, piece

        def emit(doc_ids, totals, ids_of, pieces, final):
            nonlocal sequences, steps
            windows, rest = pack(pieces, final)
            step = _steps([sum(p.length for p in w) for _, w in windows])
            columns: list[list] = [[] for _ in range(9)]
            for number, (tier, window) in enumerate(windows):
                offset = 0
                for p in window:
                    row = (
                        doc_ids[p.row],
                        p.start,
                        p.length,
                        ids_of(p).tobytes(),
                        totals[p.row],
                        first_id + sequences + number,
                        offset,
                        tier,
                        first_id + steps + step[number],
                    )
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += p.length
            sequences += len(windows)
            steps += max(step, default=-1) + 1
            kinds = [id_type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_id"]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names), rest

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for start, stop in C.chunks(C.text_bytes(batch.column("text"))[1], TEXT_BYTES):
                ids, counts = words.encode(batch.column("text").slice(start, stop - start))
                doc_ids = [*(held[0] for held in left), *batch.column("doc_id").slice(start, stop - start).to_pylist()]
                totals = [*(held[2] for held in left), *counts.tolist()]
                # a piece's ids start at base[row] + its start in the document
                ends = np.cumsum(counts)
                base = [0] * len(left) + (ends - counts).tolist()
                kept = [(held[1], held[3].start) for held in left]
                pieces = [Piece(i, held[3].start, held[3].length) for i, held in enumerate(left)]
                pieces += [Piece(len(left) + i, 0, n) for i, n in enumerate(counts.tolist())]

                def ids_of(p, ids=ids, base=base, kept=kept):
                    if p.row < len(kept):
                        own, skipped = kept[p.row]
                        return own[p.start - skipped : p.start - skipped + p.length]
                    return ids[base[p.row] + p.start : base[p.row] + p.start + p.length]

                found, rest = emit(doc_ids, totals, ids_of, pieces, False)
                left = [(doc_ids[p.row], ids_of(p).copy(), totals[p.row], p) for p in rest]
                yield found
                del found, ids, ids_of, pieces
                chunks += 1
                if chunks % _GIVE_BACK_CHUNKS == 0:
                    C.give_back()
        if left:
            pieces = [Piece(i, held[3].start, held[3].length) for i, held in enumerate(left)]
            held = left

            def ids_of_left(p):
                skipped = held[p.row][3].start
                return held[p.row][1][p.start - skipped : p.start - skipped + p.length]

            found, _ = emit([h[0] for h in held], [h[2] for h in held], ids_of_left, pieces, True)
            yield found
        C.give_back()

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, _SCHEMA.format(kind=kind))


def pieces(documents: DataFrame, tokenizer: str) -> DataFrame:
    """The rows of ``packed`` with a checksum in place of the ids."""
    return packed(documents, tokenizer).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "tier",
        "step_id",
    )
