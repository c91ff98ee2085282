"""Masks for personal data, as columns and as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The replacement texts.
TAX_ID_MASK = "***.***.***-"
NAME_MASK = "CLIENTE PROTEGIDO"


def mask_tax_id(tax_id: Column, privileged: Column) -> Column:
    """Last two characters only; NULL stays NULL."""
    return F.when(privileged, tax_id).otherwise(F.concat(F.lit(TAX_ID_MASK), F.right(tax_id, F.lit(2))))


def mask_name(name: Column, privileged: Column) -> Column:
    return F.when(privileged, name).otherwise(F.lit(NAME_MASK))


def create_sql_functions(spark: SparkSession, database: str | None = None) -> list[str]:
    """The same masks and the row filter for SQL users; the caller's rights are arguments.

    Open-source Spark has no group lookup inside SQL, so views pass ``privileged`` and
    the caller's insurer in. An unknown insurer is NULL, and the filter then admits nothing.
    Temporary functions without ``database``, else permanent ones.
    """
    kind, prefix = ("", f"{database}.") if database else ("TEMPORARY ", "")
    bodies = {
        "mask_tax_id": (
            "tax_id STRING, privileged BOOLEAN",
            "STRING",
            f"CASE WHEN privileged THEN tax_id ELSE concat('{TAX_ID_MASK}', right(tax_id, 2)) END",
        ),
        "mask_name": (
            "name STRING, privileged BOOLEAN",
            "STRING",
            f"CASE WHEN privileged THEN name ELSE '{NAME_MASK}' END",
        ),
        "own_insurer": (
            "insurer_id STRING, caller_insurer STRING, privileged BOOLEAN",
            "BOOLEAN",
            "privileged OR coalesce(insurer_id = caller_insurer, false)",
        ),
    }
    for name, (arguments, result, body) in bodies.items():
        spark.sql(
            f"CREATE OR REPLACE {kind}FUNCTION {prefix}{name}({arguments}) RETURNS {result} RETURN {body}"
        )
    return [prefix + name for name in bodies]
