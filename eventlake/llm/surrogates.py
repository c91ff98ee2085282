"""Personal data is replaced by keyed surrogates of the same kind and look.

Emails, telephone, card and account numbers, addresses of machines, national ids, credentials and titled names are
found by pattern. Each entity gets a surrogate by a keyed permutation of the values of its own shape: digits become digits and
letters become letters of the same script and case, marks and separators stay, card numbers keep whether their check
digit is right, machine addresses stay in range, given names are taken from a list of the same gender. The same entity gets the same
surrogate everywhere, so texts still refer to the same person.

Collisions are checked over the whole corpus: all different entities are brought together with their surrogates, and where two
share one, or a surrogate is itself an entity of the corpus, the later ones get another attempt, until there is none; a
shape too crowded for that goes by one permutation as a whole, which keeps its entities distinct. Only such later attempts are joined to the texts that need them; all others are recomputed in place from the key.

Plan: one narrow pass lists entities, counted per task before the shuffle; a second one rewrites. An entity that occurs in a third
of all rows is one row of the collision check.

Edge cases: a null text stays null, an empty one empty; entities that overlap count as the one that starts first, then the
longer one; values too short to have another of their shape stay distinct among themselves; repeated rows are rewritten alike;
extra columns stay away; an empty table gives no rows. The key is a parameter and must be kept secret and unchanged
for surrogates to stay the same between runs.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm import common as C

KEY = b"replace by a secret of your own"
ATTEMPTS = 50
#: Attempt of entities whose whole shape goes by one permutation.
WHOLE = -1

#: Fixed patterns; the first group named ``v`` is what is replaced.
_KINDS = [
    ("email", r"(?<![\w.+-])(?P<v{i}>[^\W_](?:[\w.+-]*\w)?@[^\W_](?:[\w-]*\w)?(?:\.[^\W_](?:[\w-]*\w)?)+)"),
    ("secret", r"\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b[\"']?[ \t]*[=:][ \t]*[\"']?(?P<v{i}>[^\s\"',;]{{6,}})"),
    ("access_key", r"\b(?P<v{i}>(?-i:(?:AKIA|ASIA)[A-Z0-9]{{16}}))\b"),
    ("iban", r"\b(?P<v{i}>(?-i:[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?))\b"),
    ("ip", r"(?<![\d.])(?P<v{i}>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){{3}}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?![\d]|\.\d)"),
    ("national_id", r"(?<![\d-])(?P<v{i}>\d{{3}}-\d{{2}}-\d{{4}})(?![\d-])"),
    ("phone", r"(?<![\w+])(?P<v{i}>\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?\d(?:[ .-]?\d){{5,11}})(?!\d)"),
    ("phone", r"(?<![\w+(])(?P<v{i}>\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}})(?!\d)"),
    ("phone", r"(?<![\w.-])(?P<v{i}>\d{{3}}[.-]\d{{3}}[.-]\d{{4}})(?![\w-])"),
    ("card", r"(?<![\d.-])(?P<v{i}>\d(?:[ -]?\d){{12,18}})(?![\d-])"),
]
_FOUND = re.compile("|".join(p.format(i=i) for i, (_, p) in enumerate(_KINDS)), re.IGNORECASE)
_KIND_OF = {f"v{i}": kind for i, (kind, _) in enumerate(_KINDS)}

#: Titles by gender, and given names to take surrogates from; fixed values.
_TITLES = {
    "m": ["Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra"],
    "x": ["Dr", "Prof"],
}
_GIVEN = {
    "m": "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Louis Marco Noah Oscar Paul Ralph Simon Tom Victor".split(),
    "f": "Anna Berta Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sara Tina Vera".split(),
}
_GIVEN["x"] = _GIVEN["m"] + _GIVEN["f"]
_GENDER = {title.lower(): gender for gender, titles in _TITLES.items() for title in titles}
_WORD = r"[A-ZÀ-ÖØ-ÞĀ-ŽΑ-ΩА-Я](?:['’-][A-Z])?[a-zß-öø-ÿā-žα-ωа-я][\w'’-]*\b"
_NAMED = re.compile(rf"\b(?P<title>{'|'.join(t for ts in _TITLES.values() for t in ts)})\.? (?P<name>{_WORD}(?: {_WORD}){{0,2}})")

#: Alphabets within which letters are replaced.
_SCRIPTS = [
    "abcdefghijklmnopqrstuvwxyz",
    "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ",
    "αβγδεζηθικλμνξοπρστυφχψω",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
]
_PLACE = {c: (s, i) for s, letters in enumerate(_SCRIPTS) for i, c in enumerate(letters)}

Entity = tuple[str, str]


# ------------------------------------------------------------------ permutations under a key


def _round(key: bytes, tweak: str, values: tuple[int, ...], size: int = 32) -> int:
    seed = hmac.new(key, f"{tweak}|{values}".encode(), hashlib.sha256).digest()
    return int.from_bytes(hashlib.shake_256(seed).digest(size), "big")


def permuted(key: bytes, tweak: str, digits: list[int], bases: list[int]) -> list[int]:
    """A keyed permutation of digit strings with the given bases: a Feistel network over the two halves."""
    if len(digits) == 1:
        base = bases[0]
        shuffled = sorted(range(base), key=lambda v: _round(key, tweak, (v, base)))
        return [shuffled[digits[0]]]
    half = len(digits) // 2
    sides = [(digits[:half], bases[:half]), (digits[half:], bases[half:])]
    for turn in range(8):
        (own, own_bases), (other, _) = sides[turn % 2], sides[1 - turn % 2]
        shift = _round(key, f"{tweak}|{turn}|{bases}", tuple(other), 32 + len(own))
        moved = []
        for value, base in zip(own, own_bases, strict=True):
            moved.append((value + shift) % base)
            shift //= base
        sides[turn % 2] = (moved, own_bases)
    return sides[0][0] + sides[1][0]


def _walked(step: Callable[[list[int]], list[int]], value: list[int], like: Callable[[list[int]], object]) -> list[int]:
    """Repeat a permutation until the value is of its old class again, which is a permutation of the class."""
    wanted = like(value)
    value = step(value)
    while like(value) != wanted:
        value = step(value)
    return value


def _shaped(key: bytes, tweak: str, text: str, hex_digits: bool = False) -> str:
    """Permute the letters and digits of a lower-case text in place; everything else stays."""
    at, digits, bases = [], [], []
    for i, c in enumerate(text):
        if hex_digits and c in "0123456789abcdef":
            place, base = "0123456789abcdef".index(c), 16
        elif c in "0123456789":
            place, base = int(c), 10
        elif c in _PLACE:
            script, place = _PLACE[c]
            base = len(_SCRIPTS[script])
        else:
            continue
        at.append((i, c))
        digits.append(place)
        bases.append(base)
    if not digits:
        return text
    out = list(text)
    for (i, c), value in zip(at, permuted(key, tweak, digits, bases), strict=True):
        if hex_digits:
            out[i] = "0123456789abcdef"[value]
        else:
            out[i] = str(value) if c in "0123456789" else _SCRIPTS[_PLACE[c][0]][value]
    return "".join(out)


def _check_digit(digits: list[int]) -> int:
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += d if i % 2 else (2 * d - 9 * (d > 4))
    return -total % 10


def _card(key: bytes, tweak: str, text: str) -> str:
    digits = [int(c) for c in text]
    first, rest, off = digits[0], digits[1:-1], (digits[-1] - _check_digit(digits[:-1])) % 10
    moved = [first, *permuted(key, tweak, rest, [10] * len(rest))]
    return "".join(map(str, [*moved, (_check_digit(moved) + off) % 10]))


def _ip(key: bytes, tweak: str, text: str) -> str:
    """Private, loop-back and multicast ranges keep what makes them so; other addresses stay outside of these."""
    parts = [int(p) for p in text.split(".")]

    def fixed(value: list[int]) -> int:
        a, b = value[:2]
        if a in (0, 10, 127) or a > 223:
            return 1
        return 2 if (a, b) == (192, 168) or (a == 172 and 16 <= b < 32) else 0

    head = fixed(parts)
    if head:
        return ".".join(map(str, parts[:head] + permuted(key, f"{tweak}|{parts[:head]}", parts[head:], [256] * (4 - head))))
    return ".".join(map(str, _walked(lambda v: permuted(key, tweak, v, [256] * 4), parts, fixed)))


def _phone(key: bytes, tweak: str, text: str) -> str:
    prefix, number = text.split("|")
    digits = [int(c) for c in number]
    moved = _walked(lambda v: permuted(key, tweak, v, [10] * len(v)), digits, lambda v: v[0] < 2)
    return f"{prefix}|{''.join(map(str, moved))}"


def _email(key: bytes, tweak: str, text: str) -> str:
    head, dot, ending = text.rpartition(".")
    return _shaped(key, tweak, head) + dot + ending


def _name(key: bytes, tweak: str, text: str) -> str:
    gender, name = text.split("|")
    words = name.split(" ")
    if len(words) == 1 or tweak == f"name|{WHOLE}":
        return f"{gender}|{_shaped(key, tweak, name)}"
    given = _GIVEN[gender][_round(key, tweak, (sum(words[0].encode()),)) % len(_GIVEN[gender])]
    return f"{gender}|{given.lower()} {_shaped(key, tweak + words[0], ' '.join(words[1:]))}"


@lru_cache(maxsize=100_000)
def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The surrogate of an entity, both in the plain form in which entities are compared."""
    tweak = f"{kind}|{attempt}"
    if kind == "card":
        return _card(key, tweak, entity)
    if kind == "ip":
        return _ip(key, tweak, entity)
    if kind == "phone":
        return _phone(key, tweak, entity)
    if kind == "email":
        return _email(key, tweak, entity)
    if kind == "access_key":
        return entity[:4] + _shaped(key, tweak, entity[4:])
    if kind == "iban":
        return entity[:2] + _shaped(key, tweak, entity[2:])
    if kind == "name":
        return _name(key, tweak, entity)
    low = _folded(entity)
    hex_digits = kind == "secret" and attempt != WHOLE and bool(re.fullmatch("[0-9a-f]{8,}", low))
    return _cased(entity, _shaped(key, tweak, low, hex_digits=hex_digits))


def shape(kind: str, entity: str) -> str:
    """Entities of one shape have different surrogates, all of this shape, at the attempt WHOLE."""
    if kind == "ip":
        return "ip"
    low = _folded(entity)
    signs = ("9" if c in "0123456789" else _SCRIPTS[_PLACE[c][0]][0] if c in _PLACE else c for c in low)
    return _cased(entity, "".join(signs))


# ------------------------------------------------------------------ entities in texts


def _folded(text: str) -> str:
    """Lower case, letter by letter."""
    return "".join(low if len(low := c.lower()) == 1 else c for c in text)


def _cased(old: str, new: str) -> str:
    return "".join(n.upper() if o.isupper() else n for o, n in zip(old, new, strict=True))


def plain(kind: str, surface: str, gender: str = "x") -> str:
    """What is the same for all spellings of one entity."""
    if kind in ("card", "national_id"):
        return re.sub(r"\D", "", surface)
    if kind == "phone":
        code = re.match(r"\+\d{1,3}(?=[ .(-])|\+\d", surface)
        prefix = code.group() if code else ""
        return prefix + "|" + re.sub(r"\D", "", surface[len(prefix) :])
    if kind == "ip":
        return ".".join(str(int(p)) for p in surface.split("."))
    if kind == "iban":
        return _folded(surface.replace(" ", ""))
    if kind == "secret":
        return surface
    if kind == "name":
        return f"{gender}|{_folded(surface)}"
    return _folded(surface)


def spelled(kind: str, surface: str, new: str) -> str:
    """The surrogate in the spelling of the entity that it replaces: separators and case."""
    if kind == "ip":
        return new
    if kind == "name":
        words = surface.split(" ")
        return " ".join(
            "".join(c.upper() if o.isupper() else c for c, o in zip(w, s.ljust(len(w)), strict=False))
            for w, s in zip(new.split("|")[1].split(" "), words, strict=True)
        )
    if kind == "phone":
        prefix, new = new.split("|")
        surface = surface[len(prefix) :]
    else:
        prefix = ""
    separators = {"card": " -", "national_id": "-", "phone": " .-()", "iban": " "}.get(kind, "")
    fresh = iter(new)
    out = []
    for c in surface:
        if c in separators:
            out.append(c)
        else:
            value = next(fresh)
            out.append(value.upper() if c.isupper() else value)
    return prefix + "".join(out)


#: What every entity but a name has; only lines with one are searched.
_SIGN = re.compile("[0-9@=:]")


def entities_in(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, plain form)`` of all entities, none overlapping another."""
    found = []
    at = 0
    while sign := _SIGN.search(text, at):
        at = text.find("\n", sign.start()) + 1 or len(text) + 1
        for m in _FOUND.finditer(text, text.rfind("\n", 0, sign.start()) + 1, at - 1):
            group = m.lastgroup
            start, end = m.span(group)
            found.append((start, end, _KIND_OF[group], plain(_KIND_OF[group], text[start:end])))
    for m in _NAMED.finditer(text):
        start, end = m.span("name")
        found.append((start, end, "name", plain("name", text[start:end], _GENDER[m.group("title").lower()])))
    found.sort(key=lambda e: (e[0], -e[1]))
    out, upto = [], 0
    for entity in found:
        if entity[0] >= upto:
            out.append(entity)
            upto = entity[1]
    return out


def rewrite(text: str, key: bytes, later: dict[Entity, int]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with surrogates, and ``(start, end, kind)`` of what was replaced in the old text."""
    parts, upto, spans = [], 0, []
    for start, end, kind, entity in entities_in(text):
        new = surrogate(key, kind, entity, later.get((kind, entity), 0))
        parts += [text[upto:start], spelled(kind, text[start:end], new)]
        spans.append((start, end, kind))
        upto = end
    return "".join([*parts, text[upto:]]), spans


def entities(documents: DataFrame) -> DataFrame:
    """``kind, entity``: all different entities of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[Entity] = set()
            for text in batch.column("text").to_pylist():
                seen.update((kind, entity) for _, _, kind, entity in entities_in(text or ""))
            kinds, values = zip(*sorted(seen), strict=True) if seen else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["kind", "entity"]
            )

    return documents.select("text").mapInArrow(run, "kind string, entity string").distinct()


def _with_surrogates(rows: DataFrame, key: bytes) -> DataFrame:
    """``kind, entity, attempt, surrogate``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values, attempts = (batch.column(c).to_pylist() for c in ("kind", "entity", "attempt"))
            new = [surrogate(key, *e) for e in zip(kinds, values, attempts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("kind", "entity", "attempt")), pa.array(new, pa.string())],
                ["kind", "entity", "attempt", "surrogate"],
            )

    return rows.select("kind", "entity", "attempt").mapInArrow(
        run, "kind string, entity string, attempt int, surrogate string"
    )


def later_attempts(documents: DataFrame, key: bytes = KEY) -> DataFrame:
    """``kind, entity, attempt`` of the entities whose first surrogate collides; the attempt is the first that does not.

    Where a shape has too few values for that (ATTEMPTS tries), collisions with entities of the corpus are left and only
    distinctness counts: all entities of a shape with a shared surrogate go back to the attempt WHOLE, one permutation.
    """
    known = C.stored(entities(documents), "entities")
    settled = C.stored(_with_surrogates(known.withColumn("attempt", F.lit(0)), key), "surrogates")
    for attempt in range(1, ATTEMPTS + 1):
        taken = settled.groupBy("kind", "surrogate").agg(F.min("entity").alias("owner"), F.count("*").alias("n"))
        taken = taken.join(
            known.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real")), ["kind", "surrogate"], "left"
        ).filter("n > 1 OR real")
        clash = settled.join(taken, ["kind", "surrogate"], "left")
        again = F.coalesce(F.col("real") | ((F.col("n") > 1) & (F.col("entity") != F.col("owner"))), F.lit(False))
        clash = C.stored(clash.withColumn("again", F.coalesce(again, F.col("n") > 1)), "collisions")
        if not clash.filter("again").limit(1).count():
            break
        retried = _with_surrogates(clash.filter("again").withColumn("attempt", F.lit(attempt)), key)
        settled = C.stored(
            clash.filter("NOT again").select("kind", "entity", "attempt", "surrogate").union(retried), "surrogates"
        )
    else:
        settled = _distinct(settled, key)
    return settled.filter("attempt <> 0").select("kind", "entity", "attempt")


def _distinct(settled: DataFrame, key: bytes) -> DataFrame:
    """Shapes in which entities share a surrogate go to the attempt WHOLE, until none share one.

    Two entities at WHOLE never do, so each turn moves further shapes there and it ends.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("kind").to_pylist(), batch.column("entity").to_pylist(), strict=True)
            shapes = pa.array([shape(*e) for e in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, shapes], [*batch.schema.names, "shape"])

    columns = ["kind", "entity", "attempt", "surrogate"]
    while True:
        shared = settled.groupBy("kind", "surrogate").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
        if not shared.limit(1).count():
            return settled
        shaped = C.stored(
            settled.select(*columns).mapInArrow(run, "kind string, entity string, attempt int, surrogate string, shape string"),
            "shapes",
        )
        crowded = C.stored(shaped.join(shared, ["kind", "surrogate"]).select("kind", "shape").distinct(), "crowded")
        back = _with_surrogates(shaped.join(crowded, ["kind", "shape"]).withColumn("attempt", F.lit(WHOLE)), key)
        others = shaped.join(crowded, ["kind", "shape"], "left_anti").select(*columns)
        settled = C.stored(others.union(back), "surrogates")


def pseudonymised(documents: DataFrame, key: bytes = KEY) -> DataFrame:
    """``doc_id, text, entities`` with surrogates in the texts; entities are ``start, end, kind`` in the old text."""
    later = C.stored(later_attempts(documents, key), "later-attempts")
    rows = documents.select("doc_id", C.text_key(F.col("text")).alias("text_key"), "text")
    if later.limit(1).count():
        where = _occurrences(documents).join(later, ["kind", "entity"])
        listed = where.groupBy("doc_id", "text_key").agg(
            F.collect_set(F.struct("kind", "entity", "attempt")).alias("later")
        )
        rows = rows.join(listed, C.same_document(rows, listed), "left").select(rows["doc_id"], rows["text"], "later")
    else:
        rows = rows.select("doc_id", "text", F.lit(None).cast("array<struct<kind:string,entity:string,attempt:int>>").alias("later"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_of_spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for batch in batches:
            texts, found = [], []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("later").to_pylist(), strict=True):
                if text is None:
                    texts.append(None)
                    found.append([])
                    continue
                attempts = {(e["kind"], e["entity"]): e["attempt"] for e in own or []}
                new, spans = rewrite(text, key, attempts)
                texts.append(new)
                found.append([{"start": a, "end": b, "kind": k} for a, b, k in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(found, kind_of_spans)],
                ["doc_id", "text", "entities"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text string, entities array<struct<start:int,end:int,kind:string>>")


def _occurrences(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, kind, entity``: which texts have which entities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, kinds, values = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for kind, entity in {e[2:] for e in entities_in(text or "")}:
                    row.append(i)
                    kinds.append(kind)
                    values.append(entity)
            at = pa.array(np.asarray(row, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("text_key").take(at),
                    pa.array(kinds, pa.string()),
                    pa.array(values, pa.string()),
                ],
                ["doc_id", "text_key", "kind", "entity"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", C.text_key(F.col("text")).alias("text_key"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_key bigint, kind string, entity string")
