"""URL filter: allow and block entries in one trie over reversed host labels and path segments.

A rule names a host, which covers all its subdomains, and a start of the path. A url walks down the labels of its
host from the right; at every node that ends a rule's host it goes on down the segments of its path. Of all rules that
it passes, the one with the most host labels wins, then the one with the longest path, so a longer entry overrides a
shorter one whether it allows or blocks.

The trie is broadcast in blocks of at most BLOCK_RULES rules, whatever the size of the list: one narrow pass over the urls
per block, each keeping the better of its own and the earlier match. The usual list is one block.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is blocked, as it
names nothing to fetch; any other url without a rule is allowed. A path that is empty starts with no rule path but the
empty one. Of rules with the same host and path, block beats allow. Rules with a null host or verdict are ignored; a null path is
``/``. An empty rule list leaves all to the default. Repeated rows are judged alike; extra columns stay away.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import UPPER

BLOCK_RULES = 100_000
ALLOW, BLOCK = "allow", "block"

#: Fixed rules of the registered query: verdict, host, path.
RULES = [
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
]
RULE_SCHEMA = "verdict string, host string, path string"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Nodes are dicts. Labels and whole segments are edges; a rule ends at a path node with a last, possibly partial segment."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(("label", label), {})
            *whole, last = path.split("/")
            for segment in whole:
                node = node.setdefault(("segment", segment), {})
            ends = node.setdefault("ends", {})
            if ends.get(last) != BLOCK:
                ends[last] = verdict

    def match(self, host: str, path: str) -> tuple[int, int, str, str] | None:
        """``(labels, path length, rule, verdict)`` of the rule that wins."""
        best = None
        labels = host.split(".") if host else []
        node: dict | None = self.root
        for depth in range(1, len(labels) + 1):
            node = node.get(("label", labels[-depth]))
            if node is None:
                break
            found = self._path(node, path)
            if found:
                best = depth, len(found[0]), ".".join(labels[-depth:]) + found[0], found[1]
        return best

    @staticmethod
    def _path(node: dict, path: str) -> tuple[str, str] | None:
        best, passed = None, ""
        segments = path.split("/")
        for i, segment in enumerate(segments):
            ends = node.get("ends", {})
            for last in sorted(ends, key=len):
                if segment.startswith(last):
                    best = passed + last, ends[last]
            node = node.get(("segment", segment))
            if node is None or i == len(segments) - 1:
                break
            passed += segment + "/"
        return best


def _judge(rows: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Improve ``labels, length, rule, verdict`` by the rules of one block."""
    shared = rows.sparkSession.sparkContext.broadcast(rules)
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            best = list(zip(*(columns[c].to_pylist() for c in ("labels", "length", "rule", "verdict")), strict=True))
            for i, (host, path) in enumerate(zip(columns["host"].to_pylist(), columns["path"].to_pylist(), strict=True)):
                found = trie.match(host, path)
                if found and found[:2] > best[i][:2]:
                    best[i] = found
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.string())
            for (name, kind), values in zip(
                zip(("labels", "length", "rule", "verdict"), kinds, strict=True),
                zip(*best, strict=True) if best else ((),) * 4,
                strict=True,
            ):
                columns[name] = pa.array(list(values), kind)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return rows.mapInArrow(run, schema)


def judge(pages: DataFrame, rules: DataFrame, block_rules: int = BLOCK_RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page."""
    known = rules.filter(F.col("host").isNotNull() & F.col("verdict").isin(ALLOW, BLOCK)).select(
        "verdict", F.translate("host", UPPER, UPPER.lower()).alias("host"), F.coalesce("path", F.lit("/")).alias("path")
    )
    blocks = max(1, -(-known.count() // block_rules))
    known = known.withColumn("block", F.pmod(F.xxhash64("host", "path"), F.lit(blocks)))
    rows = pages.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.lit(0).alias("labels"),
        F.lit(0).alias("length"),
        F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"),
    )
    for block in range(blocks):
        part = known.filter(F.col("block") == block).select("verdict", "host", "path")
        rows = _judge(rows, [tuple(row) for row in part.collect()])
    default = F.when(F.col("host") == "", BLOCK).otherwise(ALLOW)
    return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", default).alias("verdict"))
