"""Sharding, filter audit and Merkle manifest against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import filter_audit, merkle, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["size", "part", "shard", "digest", "mask", "grp", "rank", "n", "place", "text_place", "children", "kind", "good"]


def documents(spark, rows):
    """Rows of id, text and language, with extra columns named like those used inside."""
    frame = spark.createDataFrame([(i, t, lang, "s%d" % (len(t or "") % 3), len(t or "")) for i, t, lang in rows], SCHEMA)
    return frame.select("*", *[F.lit("x").alias(c) for c in CLASHING])


def odd_rows(seed=0, count=60, copies=40):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeÉF") for _ in range(r.randrange(1, 8))) for _ in range(300)]
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 400))) for _ in range(count)]
    texts += [None, "", " \n\t ", "A$", "É" * 50, texts[0] * 300, "\x1c\x85 x"] + [texts[1]] * copies + [texts[2], None, ""]
    rows = [(i, t, r.choice(["en", "de", "", None, "Ж"])) for i, t in enumerate(texts)]
    rows += [(None, texts[1], "en"), (None, None, "de"), (3, texts[3], rows[3][2]), (3, texts[1], "en"), rows[5], rows[5]]
    r.shuffle(rows)
    return rows


# ------------------------------------------------------------------ shards


def plain_shards(rows, count):
    """``(id, text, shard, slot)`` in order: the line of bytes, cut."""

    def place(value):
        return int(hashlib.md5(value).hexdigest()[:15], 16)

    line = sorted(
        (place((t or "").encode()), -1 if i is None else place(str(i).encode()), i is not None, i or 0, len((t or "").encode()) + 8)
        for i, t, *_ in rows
    )
    total, at, starts, group = sum(x[4] for x in line), 0, {}, {}
    placed = []
    for x in line:
        starts.setdefault(x[0], at)
        group[x[0]] = group.get(x[0], 0) + x[4]
        placed.append((x, at))
        at += x[4]
    out, used = [], {}
    for x, at in placed:
        small = group[x[0]] * sharding.GROUP_SHARE * count <= total
        shard = (starts[x[0]] if small else at) * count // total
        slot = used.get(shard, 0)
        used[shard] = slot + 1
        out.append((x[3] if x[2] else None, x[4], shard, slot))
    return out


@pytest.mark.parametrize("fine", [False, True])
def test_shards(spark, monkeypatch, fine):
    """The same result with few samples and many subdivided ranges."""
    if fine:
        monkeypatch.setattr(sharding, "RANGE_ROWS", 2)
        monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 1)
        monkeypatch.setattr(sharding, "GROUP_SHARE", 1)
    rows = odd_rows(1)
    found = sharding.shards(documents(spark, rows), 7).collect()
    got = sorted((str(r.doc_id), r.size, r.shard, r.slot) for r in found)
    assert got == sorted((str(i), size, shard, slot) for i, size, shard, slot in plain_shards(rows, 7))
    checksums = sorted((str(i), zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert checksums == sorted((str(r.doc_id), r.text_crc32) for r in found)
    for shard in range(7):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_shards_are_near_equal_with_a_hot_text(spark):
    rows = [(i, "same text" * 20 if i % 3 == 0 else "text %d " % i * 20, "en") for i in range(6000)]
    found = sharding.shards(documents(spark, rows)).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    sizes = [r.b for r in found]
    assert len(sizes) == 24 and max(sizes) < 1.03 * sum(sizes) / 24 and min(sizes) > 0.97 * sum(sizes) / 24


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    """A first sample that sees nothing leaves one range; it is sampled again until none is overfull."""
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 0.02)
    rows = sharding.sized(documents(spark, [(i, "t%d" % (i % 50 if i % 2 else i), "en") for i in range(2000)]))
    total = rows.agg(F.sum("size")).first()[0]
    splitters, sizes = sharding.splitters_of(rows, 2000, total, 40)
    assert len(splitters) > 20 and sizes["rows"].max() < 2 * 2000 / 40 * 1.2 and sizes["rows"].sum() == 2000
    assert splitters == sorted(set(splitters))


def test_one_key_cannot_be_subdivided(spark):
    rows = documents(spark, [(1, "same", "en")] * 50)
    found = sharding.shards(rows, 5).collect()
    assert sorted(r.slot for r in found if r.shard == 2) == list(range(10)) and {r.shard for r in found} == set(range(5))


def test_no_documents_no_shards(spark):
    assert sharding.shards(documents(spark, [(1, "x", "en")]).limit(0)).count() == 0


def test_written_shards(spark, tmp_path):
    rows = odd_rows(2)
    docs = documents(spark, rows)
    found = sharding.write_shards(docs, str(tmp_path / "shards"), 5)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.select("document.*").columns == docs.columns
    assert sorted(map(str, back.select("document.doc_id", "document.text").collect())) == sorted(
        map(str, docs.select("doc_id", "text").collect())
    )
    assert sorted(map(tuple, back.select("shard", "slot").collect())) == sorted(map(tuple, found.select("shard", "slot").collect()))


# ------------------------------------------------------------------ filter audit


def plain_audit(rows, labels):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in rows]
    fails = []
    for (i, t, _), w in zip(rows, words, strict=True):
        t = t or ""
        copy = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)
        upper = len(re.findall("[A-Z]", t))
        fails.append(
            {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * upper > 3 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": copy}
        )
    out = {}
    orders = list(itertools.permutations("ABCDE"))
    for part in {lang or "" for _, _, lang in rows}:
        own = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        taken = {}
        for order in orders:
            left = own
            for step, f in enumerate(order):
                gone = [k for k in left if fails[k][f]]
                earlier = [k for k in own if k not in left]
                left = [k for k in left if not fails[k][f]]
                taken[f] = taken.get(f, 0) + len(gone)
                marks = [labels.get(rows[k][0], (0, 0)) for k in gone]
                out[part, "".join(order), step + 1] = [
                    len(left), len(gone), sum(fails[k][f] for k in earlier),
                    sum(fails[k][f] and sum(fails[k].values()) == 1 for k in own),
                    sum(m[0] == 1 for m in marks), sum(m[1] == 1 for m in marks),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(taken[order[step - 1]])
    return out


@pytest.mark.parametrize("slot_bits", [filter_audit.SLOT_BITS, 13])
def test_filter_audit(spark, monkeypatch, slot_bits):
    """A crowded sketch, in which unique texts pass as possible repeats, gives the same counts."""
    monkeypatch.setattr(filter_audit, "SLOT_BITS", slot_bits)
    if slot_bits == 13:
        monkeypatch.setattr(filter_audit, "_slots", lambda digests, bits: np.zeros((len(digests), 2), np.int64))
    rows = odd_rows(3, 40, 10)
    marks = {i: (i % 2, int(i % 3 == 0)) for i in range(0, 60, 2)} | {None: (1, 1)}
    labelled = [(i, q, t) for i, (q, t) in marks.items()] + [(4, 0, 0), (4, None, 1), (None, None, None)]
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    marks[4] = (marks[4][0], 1)
    got = {
        (r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
        for r in filter_audit.audit(documents(spark, rows), labels).collect()
    }
    want = plain_audit(rows, {k: v for k, v in marks.items() if k is not None})
    assert got == want and len(got) == 4 * 600


def test_unique_texts_are_cleared(spark):
    rows = [(i, "text %d" % (i // 2 if i < 100 else i), "en") for i in range(2000)]
    flagged = filter_audit.flagged(documents(spark, rows), "lang")
    found = filter_audit.possible_repeats(flagged).filter("digest IS NOT NULL").select("doc_id").collect()
    ids = {r.doc_id for r in found}
    assert set(range(100)) <= ids and len(ids) < 200


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents(spark, [(1, "x", "en")]).limit(0), labels).count() == 0
    assert filter_audit.audit(documents(spark, [(1, "x", "en")]), labels).filter("removed > 0").count() == 120


# ------------------------------------------------------------------ merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """Root, and per node the list of (position, run) up to it."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for k, place in enumerate(at):
            paths[k].append((place % 8, runs[place // 8]))
        at = [place // 8 for place in at]
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], paths


def plain_manifest(rows):
    """Rows of id, source, language, length, text and a text to try or null."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, plain_leaf(row[:5]), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    root, top = plain_tree([trees[g][0] for g in order])
    out = []
    for g, above in zip(order, top, strict=True):
        for (_, _, leaf, row), path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1], strict=True):
            proof, node = "", leaf if row[5] is None else plain_leaf([*row[:4], row[5]])
            for place, run in path + above:
                proof += "".join(run[:place] + run[place + 1 :])
                node = sha("".join([*run[:place], node, *run[place + 1 :]]))
            out.append((row[0], leaf, trees[g][0], root, sha(proof), node, node == root))
    return out


@pytest.mark.parametrize("levels", [merkle.LEVELS, 1])
def test_manifest(spark, levels):
    """Blocks of 8 leaves make many layers, also above the groups."""
    rows = odd_rows(4, 150) + [(1000 + i, "w%d" % i, "x%d" % (i % 11)) for i in range(40)]
    docs = documents(spark, rows)
    tried = F.when(F.col("doc_id") % 3 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit("!")))
    made = merkle.manifest(docs, changed_text=tried, levels=levels)
    plain = [
        (i, "s%d" % (len(t or "") % 3), lang, len(t or ""), t, (t or "") + "!" if i is not None and i % 3 == 0 else None)
        for i, t, lang in rows
    ]
    got = sorted(map(str, (tuple(r) for r in merkle.verified(made).collect())))
    assert got == sorted(map(str, plain_manifest(plain)))
    for r in made.records().collect():
        assert hashlib.sha256(bytes(r.children).hex().encode()).digest() == bytes(r.digest)


def test_one_leaf_and_none(spark):
    docs = documents(spark, [(7, None, None)])
    row = merkle.verified(merkle.manifest(docs)).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof_sha256 == sha("")
    nothing = merkle.manifest(docs.limit(0))
    assert nothing.root is None and merkle.verified(nothing).count() == 0
