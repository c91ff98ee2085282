"""License scan by a positional index of rare words.

A template is a word sequence with a key phrase that must be there. How rare each template word is comes from all
documents. Every place of a template's rarest word in a text proposes where the template starts; its second rarest word must
then stand at the right distance, and the key phrase must stand there word by word: that alone gives the label. The share of
the template found around it, weighted by rarity, scores the match.

Plan: two narrow passes, both plain column expressions. The first counts documents per template word, so one row per
word crosses the shuffle. The second works within each row: one walk over its words leaves the few places of rare words, and
only these meet the templates. Nothing else is shuffled, so no source or text can be hot.

Edge cases: a null or empty text has no words, no label, null places and score 0; overlapping places all count; a template
with words that occur nowhere matches nothing; repeated rows are scanned alike; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm import common as C

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str
    base: bool = False


#: Fixed phrases and labels, found wherever their words stand one after the other.
BASE = [
    Template("cc-by", "cc by", "cc by", True),
    Template("gpl", "general public license", "general public license", True),
    Template("reserved", "all rights reserved", "all rights reserved", True),
]
#: Further licences: usual wordings, fixed values, and the words of each without which it is another licence.
FURTHER = [
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "general public license version 2"),
    Template("gpl-2", "gnu general public license as published by the free software foundation either version 2 of the license", "either version 2 of the license"),
    Template("gpl-3", "gnu general public license as published by the free software foundation either version 3 of the license", "either version 3 of the license"),
    Template("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    Template("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "you may not use this file except in compliance with the license"),
    Template("mit", "released under the terms of the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software for any purpose"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain"),
]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(C.lower_ascii(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def rarity(documents: DataFrame, templates: list[Template]) -> dict[str, float]:
    """Inverse document frequency of each template word, over all documents."""
    known = sorted({w for t in templates for w in t.text.split()})
    words = F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, known)))
    found = documents.select(F.explode(words).alias("word")).groupBy("word").count().collect()  # one row per word
    count = {row["word"]: row["count"] for row in found}
    total = documents.count()
    return {word: math.log((total + 1) / (count.get(word, 0) + 1)) + 1e-3 for word in known}


def _index(templates: list[Template], idf: dict[str, float]) -> tuple[Column, list[str]]:
    """The templates as one array column, and the words that are looked up."""
    rows, looked_up = [], set()
    for t in templates:
        words, key = t.text.split(), t.key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        # rarest first; a word of the key phrase before others, as it must be there
        order = sorted(range(at, at + len(key)), key=lambda i: (-idf[words[i]], i))
        first, second = order[0], order[min(1, len(order) - 1)]
        looked_up.add(words[first])
        rows.append(
            F.struct(
                F.lit(t.label).alias("label"),
                F.lit(t.base).alias("base"),
                F.array(*map(F.lit, words)).alias("words"),
                F.array(*(F.lit(float(idf[w])) for w in words)).alias("weights"),
                F.lit(at).alias("key_at"),
                F.array(*map(F.lit, key)).alias("key"),
                F.lit(words[first]).alias("rare"),
                F.lit(first).alias("rare_at"),
                F.lit(words[second]).alias("next"),
                F.lit(second).alias("next_at"),
            )
        )
    return F.array(*rows), sorted(looked_up)


def matches(words: Column, templates: list[Template], idf: dict[str, float]) -> Column:
    """``array<struct<label, base, start, share>>`` of all places of all templates in a column of words."""
    index, looked_up = _index(templates, idf)
    places = F.filter(
        F.transform(words, lambda w, i: F.when(w.isin(*looked_up), F.struct(i.alias("at"), w.alias("word")))),
        lambda p: p.isNotNull(),
    )

    def starts(place: Column) -> Column:
        return F.transform(
            F.filter(index, lambda t: t["rare"] == place["word"]),
            lambda t: F.struct(t.alias("t"), (place["at"] - t["rare_at"]).alias("start")),
        )

    def stands(m: Column) -> Column:
        t, start = m["t"], m["start"]
        key_start = start + t["key_at"]
        return (
            (key_start >= 0)
            & F.coalesce(F.get(words, start + t["next_at"]) == t["next"], F.lit(False))
            & (F.slice(words, F.greatest(key_start, F.lit(0)) + 1, F.size(t["key"])) == t["key"])
        )

    def share(m: Column) -> Column:
        t, start = m["t"], m["start"]
        found = F.transform(
            t["words"],
            lambda w, i: F.when(F.coalesce(F.get(words, start + i) == w, F.lit(False)), F.get(t["weights"], i)).otherwise(
                F.lit(0.0)
            ),
        )
        zero = F.lit(0.0)
        return F.aggregate(found, zero, lambda a, b: a + b) / F.aggregate(t["weights"], zero, lambda a, b: a + b)

    standing = F.filter(F.flatten(F.transform(places, starts)), stands)
    scored = F.transform(
        standing,
        lambda m: F.struct(
            m["t"]["label"].alias("label"), m["t"]["base"].alias("base"), m["start"].alias("start"), share(m).alias("share")
        ),
    )
    return scored


def scan(documents: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """Per row ``doc_id, n_words, matches`` and, from these, counts, places, labels and a score."""
    templates = BASE + FURTHER if templates is None else templates
    idf = rarity(documents, templates)
    rows = documents.select("doc_id", words_of(F.col("text")).alias("words"))
    rows = rows.select("doc_id", F.size("words").alias("n_words"), matches(F.col("words"), templates, idf).alias("matches"))
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    return rows.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
        "matches",
    )


def _labels(found: Column) -> Column:
    return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))))
