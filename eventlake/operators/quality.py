"""Constraints, expectations, comparisons and freshness."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Checks = dict[str, Column]


def _as_rows(wide: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    pairs = ", ".join(f"'{name}', `{name}`" for name in names)
    return wide.selectExpr(f"stack({len(names)}, {pairs}) AS ({label}, {value})")


def constraint_violations(rows: DataFrame, checks: Checks) -> DataFrame:
    """Violations per check in one pass. As in SQL, an unknown (NULL) check is no violation."""
    counts = [F.count_if(~ok).alias(name) for name, ok in checks.items()]
    return _as_rows(rows.agg(*counts), list(checks), "check_name", "violations")


def enforce(rows: DataFrame, checks: Checks) -> DataFrame:
    """The same rows; whatever writes them fails at the first violating row."""
    verdict = F.lit(True)
    for name, ok in checks.items():
        broken = F.raise_error(F.lit(f"check {name} violated")).cast("boolean")
        verdict = F.when(~ok, broken).otherwise(verdict)
    return rows.filter(verdict)


def required(*columns: str) -> Checks:
    """Not-null checks, which plain file tables do not enforce by themselves."""
    return {f"{name}_not_null": F.col(name).isNotNull() for name in columns}


def expectations_report(
    rows: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    references: Sequence[tuple[str, DataFrame, str]] = (),
) -> DataFrame:
    """Failing rows per expectation: nulls in one pass, duplicates and orphans on counted keys.

    Key columns are counted before any join, so a value held by a third of the rows is one row by then.
    """
    parts = []
    if not_null:
        names = [f"not_null({c})" for c in not_null]
        counts = [F.count_if(F.col(c).isNull()).alias(n) for c, n in zip(not_null, names)]
        parts.append(_as_rows(rows.agg(*counts), names, "expectation", "failing"))
    for keys in unique:
        surplus = rows.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("failing"))
        parts.append(surplus.select(F.lit(f"unique({','.join(keys)})").alias("expectation"), "failing"))
    for column, other, key in references:
        used = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).count()
        known = other.select(F.col(key).alias("_k"))
        orphans = used.join(known, "_k", "left_anti").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("failing"))
        parts.append(orphans.select(F.lit(f"references({column})").alias("expectation"), "failing"))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failing") == 0)


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number differs between two tables, with both counts.

    Says what two ``exceptAll`` calls would, in one shuffle and without repeating
    a row as often as it is surplus.
    """
    columns = left.columns
    tagged = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    counted = tagged.groupBy(*columns).agg(
        F.sum("_l").alias("left_count"), F.sum("_r").alias("right_count")
    )
    return counted.filter("left_count <> right_count")


def assert_same(actual: DataFrame, golden: DataFrame) -> None:
    """Regression against a stored result; the first differing rows are shown."""
    found = differences(golden, actual.select(*golden.columns)).limit(5).collect()
    if found:
        raise AssertionError("rows differ from the stored result: " + "; ".join(map(str, found)))


def freshness(rows: DataFrame, group: str, time: str, as_of: Column, limit_hours: int) -> DataFrame:
    """Newest time per group, its age at ``as_of`` and whether that is too old."""
    newest = rows.groupBy(group).agg(F.max(time).alias("newest"))
    age = (F.unix_seconds(as_of) - F.unix_seconds(F.col("newest").cast("timestamp"))).alias("age_seconds")
    return newest.select(group, "newest", age).withColumn("stale", F.col("age_seconds") > limit_hours * 3600)


def quarantine_depth(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("_batch_id", F.to_date("kafka_timestamp").alias("day")).agg(
        F.count("*").alias("depth")
    )


def canary_arm(key: Column, percent: int) -> Column:
    """Stable routing of a key: the same in every engine that has MD5."""
    bucket = F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(100))
    return F.when(bucket < percent, F.lit("canary")).otherwise(F.lit("stable"))


def canary_split(rows: DataFrame, key: str, percent: int = 5) -> DataFrame:
    return rows.withColumn("arm", canary_arm(F.col(key), percent))


def retained(rows: DataFrame, time: str, as_of: Column, days: int) -> DataFrame:
    """Rows not yet expired; the caller writes them as the next version."""
    return rows.filter(F.col(time) >= as_of - F.make_interval(days=F.lit(days)))
