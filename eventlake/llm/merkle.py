"""A Merkle manifest of a dataset: one digest for all, and for every row the path that proves it belongs.

Rows are leaves, ordered by id within their group. Every FAN_OUT consecutive nodes become one until a group has a single
node, its subroot; subroots, ordered by group, become the root in the same way. The manifest is a table of records from the
digest of a node to the digests of its children. A request for a leaf descends from the root by the digits of the
leaf's rank, collects at each level the children that it does not take, and reverses these segments: its proof.

Plan: one scan turns texts into digests. Leaves are ordered by a range shuffle, and a row's rank is its place in its partition
plus the rows before; no group is ever in one task. Trees are built, and descended, in blocks of 4096 leaves, four levels
at once: a task holds one block at a time. The tops of blocks are the next layer's leaves, so layers shrink
by 4096 and the descent hands only one path per block from layer to layer; leaves meet the records of their block and the path
to its top, and proofs are hashed where they are found, never moved.

Edge cases: nulls in any hashed column count as such, apart from empty values; a null group comes first and is one group; rows
without an id come first in their group; rows repeated with an id are ordered by their digest, and repeated altogether
they are leaves of their own with the same digest; very long texts are hashed whole; a lone leaf is its subroot, a lone
subroot the root; an empty table has no rows and no root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from eventlake.llm import common as C

FAN_OUT = 8
#: Levels that one layer takes together.
LEVELS = 4
HASHED = ("doc_id", "source", "lang", "n_chars", "text")
#: The group of subroots; groups of rows start with 0 or 1.
TOP = ""

_ROWS_AT_ONCE = 4096
_PATH = "array<struct<digit: int, children: binary>>"


@dataclass(frozen=True)
class Layer:
    """Nodes ``grp, rank, digest, n`` and what was made of them: tops and records of blocks."""

    nodes: DataFrame
    built: DataFrame

    @property
    def tops(self) -> DataFrame:
        """The nodes of the next layer."""
        return self.built.filter("children IS NULL").select("grp", F.col("block").alias("rank"), "digest", "n")

    @property
    def records(self) -> DataFrame:
        return self.built.filter("children IS NOT NULL").select("grp", "block", "digest", "children")


@dataclass(frozen=True)
class Manifest:
    """``leaves`` has ``grp, rank, digest, n, doc_id, changed``; the root is null for an empty table."""

    leaves: DataFrame
    layers: list[Layer]
    top_layers: list[Layer]
    root: bytes | None
    levels: int

    def records(self) -> DataFrame:
        """``digest, children`` of all inner nodes, each digest once; children are digests of 32 bytes one after the other."""
        found = None
        for layer in self.layers + self.top_layers:
            own = layer.records.select("digest", "children")
            found = own if found is None else found.unionByName(own)
        return found.dropDuplicates(["digest"])


def field(value: Column) -> Column:
    """A value with its length in bytes before it; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(columns[c]) for c in HASHED]), 256))


def _run_digest(children: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def _height(n: int, levels: int) -> int:
    """Levels in a block of a layer whose group has n nodes."""
    height = 0
    while n > 1 and height < levels:
        n = -(-n // FAN_OUT)
        height += 1
    return height


def _parts(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# ------------------------------------------------------------------ ranks


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows with ``rank`` from 0 within their ``grp`` and the group's size ``n``."""
    keys = ["grp", *order]
    rows = C.stored(rows, name)  # the range shuffle reads its input twice
    sorted_rows = rows.repartitionByRange(_parts(rows), *keys).sortWithinPartitions(*keys)
    # place: the partition in the upper bits, the row in it in the lower ones
    placed = C.stored(sorted_rows.withColumn("place", F.monotonically_increasing_id()), name + "-sorted")
    piece = F.shiftright("place", 33)
    sizes = placed.groupBy("grp", piece.alias("piece")).agg(F.count("*").alias("size"), F.min("place").alias("start"))
    # a group has at most one row a partition here
    along = Window.partitionBy("grp").orderBy("piece")
    before = sizes.select(
        "grp",
        "piece",
        "start",
        (F.sum("size").over(along) - F.col("size")).alias("earlier"),
        F.sum("size").over(Window.partitionBy("grp")).alias("n"),
    )
    rank = F.col("place") - F.col("start") + F.col("earlier")
    return placed.withColumn("piece", piece).join(before, ["grp", "piece"]).select(*rows.columns, rank.alias("rank"), "n")


# ------------------------------------------------------------------ building


def _block_of(levels: int) -> Column:
    return F.shiftright("rank", FAN_OUT.bit_length() * levels - levels)


def _by_block(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition(_parts(rows), "grp", "block").sortWithinPartitions("grp", "block", *order)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block after the other; rows arrive sorted by block."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["grp"], row["block"]) != (held[0]["grp"], held[0]["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


_BUILT = pa.schema(
    [("grp", pa.string()), ("block", pa.int64()), ("digest", pa.binary()), ("children", pa.binary()), ("n", pa.int64())]
)


def _build(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    for rows in _blocks(batches):
        grp, block, n = rows[0]["grp"], rows[0]["block"], rows[0]["n"]
        level = [row["digest"] for row in rows]
        records: dict[bytes, bytes] = {}
        for _ in range(_height(n, levels)):
            runs = [level[i : i + FAN_OUT] for i in range(0, len(level), FAN_OUT)]
            level = [_run_digest(run) for run in runs]
            records.update((digest, b"".join(run)) for digest, run in zip(level, runs, strict=True))
        out = [(grp, block, level[0], None, -(-n // FAN_OUT**levels))]
        out += [(grp, block, digest, children, None) for digest, children in records.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(_BUILT.names, row, strict=True)) for row in out], _BUILT)


def build(nodes: DataFrame, levels: int, name: str) -> list[Layer]:
    """Layers from ``grp, rank, digest, n`` up to one node a group."""
    layers = []
    while True:
        rows = nodes.select("grp", _block_of(levels).alias("block"), "rank", "digest", "n")
        built = _by_block(rows, "rank").mapInArrow(partial(_build, levels=levels), "grp string, block long, digest binary, children binary, n long")
        layers.append(Layer(nodes, C.stored(built, name)))
        nodes = layers[-1].tops
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            return layers


def manifest(
    documents: DataFrame, group: str = "lang", changed_text: Column | None = None, levels: int = LEVELS
) -> Manifest:
    """The tree over all rows. ``changed_text`` is a text to try instead of the row's own, null where there is none to try."""
    columns = {c: F.col(c) for c in HASHED}
    lang = F.col(group).cast("string")
    changed = F.lit(None).cast("binary")
    if changed_text is not None:
        changed = F.when(changed_text.isNotNull(), leaf_digest(columns | {"text": changed_text}))
    rows = documents.select(
        F.when(lang.isNull(), "0").otherwise(F.concat(F.lit("1"), lang)).alias("grp"),
        "doc_id",
        leaf_digest(columns).alias("digest"),
        changed.alias("changed"),
    )
    leaves = C.stored(ranked(rows, ["doc_id", "digest"], "digests"), "leaves")
    layers = build(leaves.select("grp", "rank", "digest", "n"), levels, "layer")
    subroots = layers[-1].tops.select(F.lit(TOP).alias("grp"), F.col("grp").alias("own"), "digest")
    subroots = C.stored(ranked(subroots, ["own"], "subroot-digests"), "subroots")
    top_layers = build(subroots, levels, "top-layer")
    root = top_layers[-1].tops.first()
    return Manifest(leaves, layers, top_layers, bytes(root["digest"]) if root else None, levels)


# ------------------------------------------------------------------ descent


class _Descent:
    """Requests into one block: its records, and the path from the root to its top."""

    def __init__(self, parent: dict, records: dict[bytes, bytes], levels: int):
        self.path = [(step["digit"], step["children"]) for step in parent["path"]]
        self.top, self.height = parent["digest"], _height(parent["n"], levels)
        self.subroot, self.records = parent["subroot"], records

    def descend(self, rank: int) -> tuple[bytes, list[tuple[int, bytes]]]:
        """The node of that rank and the steps to it: which child was taken of which."""
        node, steps = self.top, []
        for level in range(self.height - 1, -1, -1):
            children = self.records[node]
            digit = rank // FAN_OUT**level % FAN_OUT
            steps.append((digit, children))
            node = children[32 * digit : 32 * digit + 32]
        return node, steps


def _unselected(step: tuple[int, bytes]) -> bytes:
    digit, children = step
    return children[: 32 * digit] + children[32 * digit + 32 :]


def _folded(node: bytes, steps: list[tuple[int, bytes]]) -> bytes:
    """The root that a node has under the steps from the root to it."""
    for digit, children in reversed(steps):
        whole = children[: 32 * digit] + node + children[32 * digit + 32 :]
        node = hashlib.sha256(whole.hex().encode()).digest()
    return node


def _met(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[tuple[_Descent, list[dict]]]:
    """Requests with their block's descent. Rows arrive sorted: of a block the parent, the records, then the requests."""
    now, parent, records, descent, asked = None, None, {}, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["grp"], row["block"]) != now:
                if asked:
                    yield descent, asked
                now, parent, records, descent, asked = (row["grp"], row["block"]), None, {}, None, []
            if row["kind"] == 0:
                parent = row
            elif row["kind"] == 1:
                records[row["digest"]] = row["children"]
            else:
                descent = descent or _Descent(parent, records, levels)
                asked.append(row)
                if len(asked) >= _ROWS_AT_ONCE:
                    yield descent, asked
                    asked = []
    if asked:
        yield descent, asked


def _requests(layer: Layer, parents: DataFrame, asked: DataFrame, levels: int) -> DataFrame:
    """Parents, records and requests of a layer, dealt by block and sorted for ``_met``.

    Parents have ``grp, rank, digest, n, path, subroot``: the tops of this layer's blocks, ``n`` the nodes of their group
    in this layer. What is asked has ``grp, rank`` and its own columns.
    """
    parents = parents.withColumnRenamed("rank", "block").withColumn("kind", F.lit(0))
    records = layer.records.withColumn("kind", F.lit(1))
    asked = asked.withColumn("block", _block_of(levels)).withColumn("kind", F.lit(2))
    rows = parents.unionByName(records, allowMissingColumns=True).unionByName(asked, allowMissingColumns=True)
    return _by_block(rows, "kind", "rank")


_STEP = pa.struct([("digit", pa.int32()), ("children", pa.binary())])
_REACHED = pa.schema(
    [("grp", pa.string()), ("rank", pa.int64()), ("digest", pa.binary()), ("path", pa.list_(_STEP)), ("subroot", pa.binary())]
)


def _reach(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    for descent, asked in _met(batches, levels):
        out = []
        for row in asked:
            node, steps = descent.descend(row["rank"])
            path = [{"digit": d, "children": c} for d, c in descent.path + steps]
            out.append({"grp": row["grp"], "rank": row["rank"], "digest": node, "path": path, "subroot": descent.subroot or node})
        yield pa.RecordBatch.from_pylist(out, _REACHED)


def _reached(layer: Layer, parents: DataFrame, levels: int) -> DataFrame:
    """``grp, rank, digest, path, subroot`` of all nodes of a layer."""
    asked = layer.nodes.select("grp", "rank")
    schema = f"grp string, rank long, digest binary, path {_PATH}, subroot binary"
    return _requests(layer, parents, asked, levels).mapInArrow(partial(_reach, levels=levels), schema)


def _parents_of(layers: list[Layer], top: DataFrame, levels: int, name: str) -> DataFrame:
    """From the parents of the last layer's blocks to those of the first one's."""
    for above, below in zip(layers[:0:-1], layers[-2::-1], strict=True):
        sizes = below.nodes.groupBy("grp").agg(F.max("n").alias("n"))
        top = C.stored(_reached(above, top, levels).join(sizes, "grp"), name)
    return top


def verified(made: Manifest) -> DataFrame:
    """Per leaf ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, digests as hex text.

    The proof is the digest of all siblings from the leaf up; the folded root comes from the changed row where there is one.
    """
    kind = made.leaves.schema["doc_id"].dataType.simpleString()
    texts = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    schema = f"doc_id {kind}, {', '.join(c + ' string' for c in texts)}, verified boolean"
    if made.root is None:
        return made.leaves.sparkSession.createDataFrame([], schema)
    root, levels = made.root, made.levels

    # the layers above the leaves of each group, from the root down
    nodes = made.top_layers[-1].nodes.agg(F.max("n")).first()[0]
    top = made.top_layers[-1].tops.withColumn("n", F.lit(nodes))
    top = top.withColumn("path", F.from_json(F.lit("[]"), _PATH)).withColumn("subroot", F.lit(None).cast("binary"))
    top = _parents_of(made.top_layers, top, made.levels, "top-paths")
    names = made.top_layers[0].nodes.select("rank", "own")
    sizes = made.layers[-1].nodes.groupBy("grp").agg(F.max("n").alias("n"))
    parents = _reached(made.top_layers[0], top, made.levels).join(names, "rank").select(
        F.col("own").alias("grp"), F.lit(0).cast("long").alias("rank"), "digest", "path", F.col("digest").alias("subroot")
    )
    parents = C.stored(parents.join(sizes, "grp"), "subroot-paths")
    parents = _parents_of(made.layers, parents, made.levels, "paths")

    id_type = to_arrow_type(made.leaves.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole_root = root.hex()
        for descent, asked in _met(batches, levels):
            above = b"".join(map(_unselected, reversed(descent.path))).hex()
            out = []
            for row in asked:
                node, steps = descent.descend(row["rank"])
                if node != row["digest"]:
                    raise ValueError("the manifest leads to another row")
                proof = b"".join(map(_unselected, reversed(steps))).hex() + above
                changed = row["digest"] if row["changed"] is None else row["changed"]
                folded = _folded(changed, descent.path + steps).hex()
                digest = hashlib.sha256(proof.encode()).hexdigest()
                out.append(
                    (row["doc_id"], row["digest"].hex(), descent.subroot.hex(), whole_root, digest, folded, folded == whole_root)
                )
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), *(pa.array(c, pa.string()) for c in columns[1:6]), pa.array(columns[6])],
                ["doc_id", *texts, "verified"],
            )

    leaves = made.leaves.select("grp", "rank", "digest", "doc_id", "changed")
    return _requests(made.layers[0], parents, leaves, levels).mapInArrow(run, schema)
