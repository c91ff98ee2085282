"""Keyed state: newest row per key, upserts with change rows, appends to documents.

Spark has no row-level MERGE on plain parquet tables, so a merge is a full outer
join of state and source. One pass gives a *verdict* per key, from which both
the next state and the change rows are derived.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OLD, NEW, ACTION = "_old", "_new", "_action"
INSERT, UPDATE, DELETE, KEEP = "insert", "update", "delete", "keep"
PREIMAGE, POSTIMAGE = "update_preimage", "update_postimage"
CHANGE_TYPE, COMMIT_VERSION = "_change_type", "_commit_version"

Guard = Callable[[Column, Column], Column]


class DuplicateSourceKey(ValueError):
    """A merge source holds several rows for one key."""


def latest_per_key(rows: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark limits each map task to one row per key before the shuffle
    (``WindowGroupLimit``), so a hot key costs one row per task, not its full size.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return rows.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def newest_items(items: DataFrame) -> DataFrame:
    """Newest item per client and type. Equal times are settled by topic and offset, then item order.

    Both item positions are part of the order, so the result never depends on row order.
    """
    order = [F.desc("event_time"), F.desc("topic"), F.desc("offset"), F.desc("item_no")]
    return latest_per_key(items, ("client_id", "consent_type"), order).drop("item_no")


#: What orders the rows of one key: the time, and where times are equal the place in the log.
STATE_ORDER = ("event_time", "topic", "offset")


def newer(*order: str) -> Guard:
    """Guard of a version-guarded merge: replace only by a row that is later in the order of these columns."""

    def guard(source: Column, target: Column) -> Column:
        later, level = F.lit(False), F.lit(True)
        for name in order or ("event_time",):
            later = later | (level & F.coalesce(source[name] > target[name], F.lit(False)))
            level = level & source[name].eqNullSafe(target[name])
        return later

    return guard


def assert_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice. Counts are combined before the shuffle; one row comes back."""
    twice = source.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        key = {name: twice[0][name] for name in keys}
        raise DuplicateSourceKey(f"{twice[0]['count']} source rows for key {key}")


def merge(
    state: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    guard: Guard | None = None,
    update_set: dict[str, Callable[[Column, Column], Column]] | None = None,
    when_missing_set: dict[str, Column] | None = None,
    delete_missing: Callable[[Column], Column] | None = None,
    insert: bool = True,
    prefer_known: Sequence[str] = (),
    unique_source: bool = False,
    keys_not_null: bool = False,
    co_partition: str | None = None,
) -> DataFrame:
    """One verdict row per key: ``_old``, ``_new`` (the surviving row or NULL) and ``_action``.

    ``guard(source, target)``  update a matched row only where true; no guard updates always
    ``update_set``             change only these columns of a matched row, ``{name: f(source, target)}``
    ``when_missing_set``       set these columns on rows the source does not hold (soft delete)
    ``delete_missing``         drop rows the source does not hold where the predicate is true
    ``prefer_known``           keep the old value of these columns where the new one is NULL
    ``unique_source``          the caller vouches for unique source keys; else they are counted
    ``keys_not_null``          no key is NULL on either side, so plain equality does (cheaper to sort)
    ``co_partition``           a column both sides are already partitioned by, added to the join key
    """
    if not unique_source:
        assert_unique(source, keys)
    columns = state.columns
    t = state.select(*keys, *_extra(co_partition, keys), F.struct(*columns).alias("_t"))
    s = source.select(*keys, *_extra(co_partition, keys), F.struct(*columns).alias("_s"))
    if keys_not_null:
        on = [F.col(f"t.{key}") == F.col(f"s.{key}") for key in keys]
    else:
        on = [F.col(f"t.{key}").eqNullSafe(F.col(f"s.{key}")) for key in keys]
    if co_partition and co_partition not in keys:
        on.insert(0, F.col(f"t.{co_partition}") == F.col(f"s.{co_partition}"))
    both = t.alias("t").join(s.alias("s"), on, "full_outer").select("t._t", "s._s")

    old, new = F.col("_t"), F.col("_s")
    matched = old.isNotNull() & new.isNotNull()
    wins = F.coalesce(guard(new, old), F.lit(False)) if guard else F.lit(True)
    action = F.when(matched & wins, UPDATE)
    if insert:
        action = action.when(old.isNull(), INSERT)
    missing = old.isNotNull() & new.isNull()
    if delete_missing is not None:
        action = action.when(missing & F.coalesce(delete_missing(old), F.lit(False)), DELETE)
    if when_missing_set:
        differs = F.lit(False)
        for name, value in when_missing_set.items():
            differs = differs | ~old[name].eqNullSafe(value)
        action = action.when(missing & differs, F.lit("missing"))

    verdict = both.select(old.alias(OLD), new.alias("_s"), action.alias(ACTION))
    old = F.col(OLD)
    if update_set is not None:
        replaced = _with_columns(old, columns, {c: f(new, old) for c, f in update_set.items()})
    else:
        replaced = _with_columns(new, columns, {c: F.coalesce(new[c], old[c]) for c in prefer_known})
    surviving = (
        F.when(F.col(ACTION) == UPDATE, replaced)
        .when(F.col(ACTION) == INSERT, new)
        .when(F.col(ACTION) == DELETE, F.lit(None))
    )
    if when_missing_set:
        surviving = surviving.when(
            F.col(ACTION) == "missing", _with_columns(old, columns, when_missing_set)
        )
    surviving = surviving.otherwise(old)
    settled = F.when(F.col(ACTION) == "missing", F.lit(UPDATE)).otherwise(
        F.coalesce(F.col(ACTION), F.lit(KEEP))
    )
    return verdict.select(OLD, surviving.alias(NEW), settled.alias(ACTION)).filter(
        F.col(OLD).isNotNull() | F.col(NEW).isNotNull()
    )


def _extra(name: str | None, keys: Sequence[str]) -> list[str]:
    return [name] if name and name not in keys else []


def _with_columns(row: Column, columns: Sequence[str], changed: dict[str, Column]) -> Column:
    return F.struct(*[changed.get(c, row[c]).alias(c) for c in columns])


def merged_state(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter(F.col(NEW).isNotNull()).select(f"{NEW}.*")


def change_rows(verdicts: DataFrame, version: int | None = None) -> DataFrame:
    """Insert, pre-image, post-image and delete rows of a merge; nothing for kept rows."""
    changed = verdicts.filter(F.col(ACTION) != KEEP)
    kinds = _change_array().alias("_change")
    rows = changed.select(F.explode(kinds).alias("_change")).select(
        F.col("_change.kind").alias(CHANGE_TYPE), "_change.row.*"
    )
    if version is not None:
        rows = rows.withColumn(COMMIT_VERSION, F.lit(version).cast("long"))
    return rows


def _change_array() -> Column:
    def entry(kind: str, column: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(column).alias("row"))

    return (
        F.when(F.col(ACTION) == INSERT, F.array(entry(INSERT, NEW)))
        .when(F.col(ACTION) == UPDATE, F.array(entry(PREIMAGE, OLD), entry(POSTIMAGE, NEW)))
        .when(F.col(ACTION) == DELETE, F.array(entry(DELETE, OLD)))
    )


def merge_decisions(
    state: DataFrame, source: DataFrame, keys: Sequence[str], time_text: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """What a version-guarded merge would do with each source row, from times given as text.

    The decision is that of the merge: both use the guard ``newer`` over the time and ``tie_break``.
    """
    order = ("_time", *tie_break)
    time = F.col(time_text).try_cast("timestamp").alias("_time")
    kept = state.select(*keys, F.col(time_text).alias("target_time"), F.struct(time, *tie_break).alias("_target"))
    judged = source.withColumn("_source", F.struct(time, *tie_break)).join(kept, list(keys), "left")
    decision = (
        F.when(F.col("_source._time").isNull(), "invalid_time")
        .when(F.col("target_time").isNull(), "insert")
        .when(newer(*order)(F.col("_source"), F.col("_target")), "update")
        .otherwise("ignore")
    )
    return judged.withColumn("decision", decision).drop("_source", "_target")
