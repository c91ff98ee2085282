"""Plain single-machine versions of the operators, for comparison."""

from __future__ import annotations

import re
from collections import Counter

import regex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(lower_ascii(text))


def later_line_runs(docs, min_words):
    """``{doc index: set of line numbers}`` that lie in a run of enough words that occurs earlier; docs are in order."""
    lines = [text.split("\n") if text is not None else [] for text in docs]
    size = [[len([w for w in regex.split(r"\p{White_Space}+", line) if w]) for line in own] for own in lines]
    seen, gone = {}, {}
    for d, own in enumerate(lines):
        for i in range(len(own)):
            for j in range(i, len(own)):
                if sum(size[d][i : j + 1]) >= min_words:
                    seen.setdefault(tuple(own[i : j + 1]), (d, i))
    for d, own in enumerate(lines):
        for i in range(len(own)):
            for j in range(i, len(own)):
                run = tuple(own[i : j + 1])
                if run in seen and seen[run] != (d, i):
                    gone.setdefault(d, set()).update(range(i, j + 1))
    return gone


def covered_bytes(texts, length):
    """Per text the bytes in a string of ``length`` bytes that also starts elsewhere."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        hit = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if count[r[i : i + length]] > 1:
                hit[i : i + length] = b"\x01" * length
        out.append(hit)
    return out
