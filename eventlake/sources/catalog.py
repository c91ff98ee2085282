"""Databases and tables of an environment, created once and migrated in place."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from eventlake import schemas as S

AREAS = ("landing", "bronze", "silver", "gold", "ops")

TABLES: dict[str, tuple[str, T.StructType, tuple[str, ...]]] = {
    "client_master": ("bronze", T.StructType(S.CLIENT_MASTER.fields + S.PROVENANCE.fields), ()),
    "banks": ("bronze", T.StructType(S.BANKS.fields + S.PROVENANCE.fields), ()),
    "insurers": ("bronze", T.StructType(S.INSURERS.fields + S.PROVENANCE.fields), ()),
    "consents": ("silver", S.STATE, ("bank_id",)),
    "quarantine": ("silver", S.QUARANTINE, ()),
    "daily_metrics": ("gold", T.StructType(S.METRICS.fields + S.row(_updated_at=S.TIME).fields), ("ref_date",)),
}


def database(env: str, area: str) -> str:
    """Environments are told apart by a prefix, e.g. ``dev_silver`` and ``prod_silver``."""
    return f"{env}_{area}"


def table_name(env: str, table: str) -> str:
    return f"{database(env, TABLES[table][0])}.{table}"


def bootstrap(spark: SparkSession, env: str) -> list[str]:
    """Create what is missing; running it again changes nothing."""
    for area in AREAS:
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name)", args={"name": database(env, area)})
    for table, (_, schema, partitions) in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        layout = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({columns}) USING parquet{layout}",
            args={"name": table_name(env, table)},
        )
        add_missing_columns(spark, table_name(env, table), schema)
    return [table_name(env, table) for table in TABLES]


def add_missing_columns(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Add the columns an older table lacks; returns their names, none on a second run."""
    known = {name.lower() for name in spark.table(table).columns}
    missing = [f for f in schema.fields if f.name.lower() not in known]
    if missing:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in missing]
