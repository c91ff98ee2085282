"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ORDER bytes, learned from a bounded sample of labelled texts
and then frozen. A byte is coded in the longest context that the language has seen; a context that has not
seen the byte charges its escape (count of different successors against all, escape method C) and hands over to the
next shorter one, down to a uniform code. The language with the shortest code for the whole text wins.

Frozen statistics make the code length of a byte a function of the few bytes before it, so a text's
code length is a sum of table lookups: one row per gram holds the lengths for all languages at once.

Plan: the sample's gram counts are summed by Spark; the tree (bounded by the sample) is broadcast; one narrow pass
scores all texts. Nothing of the scored texts is shuffled.

Edge cases: a null text, an empty one or one without a letter is ``und`` with score 0, as is every text when nothing was
learned; equally long codes go to the first language in sorted order; repeated rows are scored alike; labels that are
null are not learned; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm import common as C

ORDER = 3
#: Texts per language that are learned from at most, and bytes of them, beyond which no further text is taken. Both bound the
#: model, not what is scored.
SAMPLE_TEXTS = 600
SAMPLE_BYTES = 64 << 20
UNKNOWN = "und"
#: A text whose best code is no shorter than plain bytes is explained by no learned language.
PLAIN_BITS = 8.0


def _fold() -> np.ndarray:
    folded = np.arange(256, dtype=np.uint8)
    folded[65:91] += 32
    return folded


_FOLDED = _fold()


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte the four bytes up to it as one number; a text starts after zero bytes."""
    low = _FOLDED[data].astype(np.uint32)
    out = low.copy()
    place = np.arange(len(low)) - np.repeat(offsets[:-1], np.diff(offsets))
    for back in range(1, ORDER + 1):
        earlier = np.zeros_like(low)
        earlier[back:] = low[:-back]
        earlier[place < back] = 0
        out |= earlier << np.uint32(8 * back)
    return out


def gram_counts(sample: DataFrame) -> DataFrame:
    """``lang, gram, n``: how often each run of ORDER + 1 bytes occurs in the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for start, stop, data, offsets in C.text_chunks(batch.column("text")):
                owner = np.repeat(np.arange(start, stop), np.diff(offsets))
                grams = _grams(data, offsets)
                for lang in set(langs[start:stop]):
                    found, n = np.unique(grams[langs[owner] == lang], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n)],
                        ["lang", "gram", "n"],
                    )

    counted = sample.select("lang", "text").mapInArrow(run, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class _Level:
    """Grams of one length in an open hash table: code lengths of the last byte, and escapes of the gram as a context."""

    keys: np.ndarray
    bits: np.ndarray
    escape: np.ndarray
    shift: int

    MISS: ClassVar[np.uint64] = np.uint64((1 << 64) - 1)

    def find(self, grams: np.ndarray) -> np.ndarray:
        """Slot of each gram, or -1."""
        mask = len(self.keys) - 1
        slot = _slots(grams, self.shift)
        stored = self.keys[slot]
        out = np.where(stored == grams, slot, -1)
        left = np.flatnonzero((stored != grams) & (stored != self.MISS))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & mask
            stored = self.keys[slot]
            found = stored == grams[left]
            out[left[found]] = slot[found]
            going = ~found & (stored != self.MISS)
            left, slot = left[going], slot[going]
        return out


def _slots(grams: np.ndarray, shift: int) -> np.ndarray:
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift)).astype(np.int64)


def _level(keys: np.ndarray, bits: np.ndarray, escape: np.ndarray) -> _Level:
    size = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
    table = np.full(1 << size, _Level.MISS, np.uint64)
    place = np.empty(len(keys), np.int64)
    left, slot = np.arange(len(keys)), _slots(keys, 64 - size)
    while len(left):
        free = table[slot] == _Level.MISS
        claimed, winner = np.unique(slot[free], return_index=True)
        chosen = np.flatnonzero(free)[winner]
        table[claimed] = keys[left[chosen]]
        place[left[chosen]] = claimed
        going = np.ones(len(left), bool)
        going[chosen] = False
        left, slot = left[going], (slot[going] + 1) & ((1 << size) - 1)
    wide_bits = np.zeros((1 << size, bits.shape[1]), np.float32)
    wide_escape = np.zeros_like(wide_bits)
    wide_bits[place], wide_escape[place] = bits, escape
    return _Level(table, wide_bits, wide_escape, 64 - size)


@dataclass
class Model:
    """Frozen context trees of all languages. ``levels[o]`` holds the grams of o + 1 bytes."""

    langs: list[str]
    levels: list[_Level]
    unseen: np.ndarray

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language."""
        total = np.zeros((len(offsets) - 1, len(self.langs)))
        if not len(data) or not self.langs:
            return total
        grams = _grams(data, offsets)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        cost = np.empty((len(grams), len(self.langs)), np.float32)
        left = np.arange(len(grams))
        charged = None
        for order in range(ORDER, -1, -1):
            level = self.levels[order]
            key = (grams[left] & np.uint32((1 << 8 * (order + 1)) - 1)).astype(np.uint64)
            slot = level.find(key)
            known = slot >= 0
            bits = level.bits[slot[known]]
            cost[left[known]] = bits if charged is None else bits + charged[known]
            charged = None if charged is None else charged[~known]
            left, key = left[~known], key[~known]
            if order and len(left):
                context = self.levels[order - 1].find(key >> np.uint64(8))
                escape = self.levels[order - 1].escape[context] * (context >= 0)[:, None]
                charged = escape if charged is None else charged + escape
        if len(left):
            cost[left] = self.unseen if charged is None else charged + self.unseen
        for lang in range(len(self.langs)):
            total[:, lang] = np.bincount(owner, cost[:, lang], len(total))
        return total


def build_model(counts: DataFrame) -> Model:
    """Turn the sample's counts into code lengths. The counts are bounded by the sample's bytes."""
    frame = counts.toPandas()
    langs = sorted(frame["lang"].unique())
    code = frame["lang"].map({lang: i for i, lang in enumerate(langs)}).to_numpy(np.int64)
    gram, n = frame["gram"].to_numpy(np.uint64), frame["n"].to_numpy(np.float64)
    levels: list[_Level] = []
    lower: tuple[np.ndarray, np.ndarray] | None = None  # keys and bits of the next shorter grams
    # an empty context: escape to plain bytes where a language has not seen a byte at all
    whole = np.bincount(code, n, len(langs))
    kinds = np.array([len(np.unique(gram[code == i] & np.uint64(255))) for i in range(len(langs))], float)
    unseen = np.log2((whole + kinds) / np.maximum(kinds, 1)) + PLAIN_BITS if langs else np.zeros(0)
    for order in range(ORDER + 1):
        keys, place = np.unique(gram & np.uint64((1 << 8 * (order + 1)) - 1), return_inverse=True)
        table = np.zeros((len(keys), len(langs)))
        np.add.at(table, (place, code), n)
        context, at = np.unique(keys >> np.uint64(8), return_inverse=True)
        total, different = np.zeros((len(context), len(langs))), np.zeros((len(context), len(langs)))
        np.add.at(total, at, table)
        np.add.at(different, at, (table > 0).astype(float))
        room = (total + different)[at]
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.log2(room) - np.log2(table)
            leave = np.where(total > 0, np.log2(total + different) - np.log2(different), 0.0)
        if lower is None:
            shorter = np.broadcast_to(unseen - leave[at], table.shape)
        else:
            shorter = lower[1][np.searchsorted(lower[0], keys & np.uint64((1 << 8 * order) - 1))]
        bits = np.where(table > 0, seen, leave[at] + shorter)
        if levels:
            # the escape of a context belongs to the gram that spells it, one level down
            slot = levels[-1].find(context)
            known = slot >= 0
            levels[-1].escape[slot[known]] = leave[known]
        levels.append(_level(keys, bits, np.zeros_like(bits)))
        lower = keys, bits
    return Model(langs, levels, unseen)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def training_sample(documents: DataFrame, texts: int = SAMPLE_TEXTS, size: int = SAMPLE_BYTES) -> DataFrame:
    """At most ``texts`` whole texts per language, those whose ids have the smallest hashes, none of them held out.

    The last text taken is the one that reaches ``size`` bytes. Counts set how far hashes may go, four times as far as
    should be needed, so that few texts are ranked.
    """
    labelled = documents.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.filter(~F.coalesce(held_out(F.col("doc_id")), F.lit(True)))
    labelled = labelled.withColumn("draw", F.xxhash64(F.lit("sample"), F.col("doc_id")))
    sizes = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().collect()}
    near = F.lit(False)
    for lang, rows in sorted(sizes.items()):
        near = near | ((F.col("lang") == lang) & (F.col("draw") <= _farthest(4 * texts, rows)))
    by_draw = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
    drawn = labelled.filter(near).withColumn("rank", F.row_number().over(by_draw)).filter(F.col("rank") <= texts)
    before = F.sum(F.octet_length("text")).over(by_draw.rowsBetween(Window.unboundedPreceding, -1))
    return drawn.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < size).select("lang", "text")


def _farthest(wanted: int, rows: int) -> int:
    """The 64-bit hash up to which ``wanted`` of ``rows`` are expected."""
    return min((wanted << 64) // rows, (1 << 64) - 1) - (1 << 63)


def learn(documents: DataFrame) -> Model:
    return build_model(gram_counts(training_sample(documents)))


def _judged(model: Model, letters: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the best language (the count of languages for none), its score and bits per byte, for each row."""
    rows = len(texts)
    best, score, rate = np.full(rows, len(model.langs)), np.zeros(rows), np.full(rows, np.nan)
    lettered = letters.to_numpy(zero_copy_only=False).astype(bool)
    for start, stop, data, offsets in C.text_chunks(texts):
        judged = np.flatnonzero(lettered[start:stop] & bool(model.langs))
        if not len(judged):
            continue
        own = model.code_lengths(data, offsets)[judged]
        shortest = own.min(1)
        best[start + judged] = own.argmin(1)
        # share of the best language if code lengths are read as likelihoods, a byte counting an eighth
        gap = np.minimum(own - shortest[:, None], 8000) / 8
        score[start + judged] = 1 / np.exp2(-gap).sum(1)
        rate[start + judged] = shortest / np.maximum(np.diff(offsets)[judged], 1)
    return best, score, rate


def _has_letter(documents: DataFrame) -> Column:
    return F.coalesce(documents["text"].rlike(r"\p{L}"), F.lit(False)).alias("letter")


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, text_key, lang_pred, score, bits_per_byte`` of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        langs = np.array([*model.langs, UNKNOWN], dtype=object)
        for batch in batches:
            best, score, rate = _judged(model, batch.column("letter"), batch.column("text"))
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(langs[best], pa.string())]
            columns += [pa.array(score), pa.array(rate, from_pandas=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "lang_pred", "score", "bits_per_byte"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_key bigint, lang_pred string, score double, bits_per_byte double"
    texts = documents.select("doc_id", C.text_key(documents["text"]).alias("text_key"), "text", _has_letter(documents))
    return texts.mapInArrow(run, schema)


def with_language(documents: DataFrame) -> DataFrame:
    """The documents in a learned language: those that are ``und`` or that no learned language explains go.

    The verdict falls where the row is, so nothing is joined.
    """
    shared = documents.sparkSession.sparkContext.broadcast(learn(documents))
    columns = list(documents.columns)
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            best, _, rate = _judged(model, batch.column(len(columns)), batch.column(at))
            good = pa.array((best < len(model.langs)) & (np.nan_to_num(rate, nan=PLAIN_BITS) < PLAIN_BITS))
            yield pa.RecordBatch.from_arrays(batch.columns[: len(columns)], columns).filter(good)

    # by place, so that no name can clash
    placed = [documents[c].alias(f"c{i}") for i, c in enumerate(columns)]
    rows = documents.select(*placed, _has_letter(documents))
    return rows.mapInArrow(lambda batches: C.giving_back(run(batches)), documents.schema)
