"""Joins with master data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.upsert import latest_per_key

BROADCAST_LIMIT = 64 * 1024 * 1024


def newest_master(master: DataFrame, key: str = "client_id") -> DataFrame:
    """One row per key from an append-only master table: that of the newest file.

    Files are ordered by modification time, then by name. Where these are equal or not known, the
    time of intake and then the remaining columns decide, so the result never depends on row order.
    """
    order = [c for c in ("_file_modified", "_source_file", "_ingested_at") if c in master.columns]
    rest = [c for c in master.columns if c != key and c not in order]
    return latest_per_key(master, [key], [F.desc_nulls_last(c) for c in order] + [F.desc(c) for c in rest])


def enrich(
    items: DataFrame,
    master: DataFrame,
    columns: Sequence[str] = ("client_name", "tax_id"),
    broadcast_below: int | None = None,
) -> DataFrame:
    """Left join with a keyed master table; unmatched items keep NULLs.

    No broadcast hint by default: the master grows with the number of clients. Spark
    broadcasts it by itself while it is small; beyond that both sides are shuffled
    and adaptive execution splits the partition of a hot client. It can do so as
    long as ``master`` is read as stored and not itself the result of a shuffle by
    client; items that are one row per key already, as in the jobs, have no hot client.
    ``broadcast_below`` measures the needed master columns and broadcasts below that size.

    Only the needed master columns are read, which also leaves one ``bank_id``.
    """
    names = master.select("client_id", *columns)
    if broadcast_below is not None:
        names = broadcast_if_small(names, broadcast_below)
    return items.join(names, "client_id", "left")


def measured_bytes(rows: DataFrame) -> int:
    """Upper estimate of the in-memory size of flat rows, from the data and not from file statistics."""
    size = F.lit(0).cast("long")
    for f in rows.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("array", "map", "struct", "variant"):
            raise TypeError(f"column {f.name} has no simple size")
        text = F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if kind in ("string", "binary") else F.lit(0)
        size = size + text + 32
    return rows.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]


def broadcast_if_small(rows: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only after measuring the side; larger sides take the shuffled join."""
    return F.broadcast(rows) if measured_bytes(rows) <= limit else rows


def lookup_array(rows: DataFrame, other: DataFrame, local: str, foreign: str, name: str) -> DataFrame:
    """Add the matching row of a keyed collection as an array of zero or one struct.

    The foreign side is looked up by its primary key, so the array cannot grow.
    """
    key, hit = F.col("_fk"), F.col("_hit")
    keyed = other.select(F.col(foreign).alias("_fk"), F.struct(*other.columns).alias("_hit"))
    empty = F.array().cast(f"array<{keyed.schema['_hit'].dataType.simpleString()}>")
    joined = rows.join(keyed, rows[local] == key, "left")
    return joined.select(*rows.columns, F.when(hit.isNotNull(), F.array(hit)).otherwise(empty).alias(name))
