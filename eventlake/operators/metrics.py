"""Daily metrics, their incremental upkeep and the reports on top."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import upsert as U

DIMENSIONS = S.METRIC_KEY


def with_ref_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ref_date", F.to_date("event_time"))


def daily_metrics(state: DataFrame) -> DataFrame:
    """Rows and distinct clients per day, bank, insurer and type.

    Spark plans the distinct count in two levels, first by dimensions *and* client,
    so one hot dimension group is spread over its clients before it is summed.
    """
    return _counted(with_ref_date(state))


def _counted(dated: DataFrame) -> DataFrame:
    return dated.groupBy(*DIMENSIONS).agg(
        F.count("*").alias("total_events"),
        F.countDistinct("client_id").alias("total_clients"),
    )


# -- upkeep by recomputing affected days --------------------------------------


def affected_dates(changes: DataFrame) -> DataFrame:
    """Days touched by a change, before or after it. A row that moves touches two days."""
    return with_ref_date(changes).select("ref_date").distinct()


def recompute_affected(state: DataFrame, changes: DataFrame) -> DataFrame:
    """Full metrics of the affected days. How the days are joined is left to Spark, which measures them."""
    days = affected_dates(changes)
    touched = with_ref_date(state).join(days, "ref_date", "left_semi")
    return daily_metrics(touched)


#: More days than this are not broadcast.
BROADCAST_DAYS = 100_000


def measured_days(days: DataFrame) -> DataFrame:
    """The days between their least and greatest one, broadcast where they are few enough.

    The range is a filter that Spark takes as selective: it then prunes partitions by these days at run time.
    """
    n, least, greatest = days.agg(F.count("*"), F.min("ref_date"), F.max("ref_date")).first()
    within = days.filter(F.col("ref_date").between(F.lit(least).cast("date"), F.lit(greatest).cast("date")))
    return F.broadcast(within) if n <= BROADCAST_DAYS else within


def recompute_days(net: DataFrame, days: DataFrame) -> DataFrame:
    """Full metrics of the given days from net rows laid out by day; the files of all other days are skipped."""
    touched = net.join(days, "ref_date", "left_semi")
    held = touched.groupBy("client_id", *DIMENSIONS).agg(F.sum("_net").alias("held")).filter("held > 0")
    return _counted(held)


def replace_affected(
    metrics: DataFrame, recomputed: DataFrame, days: DataFrame, co_partition: str | None = None
) -> DataFrame:
    """Verdicts that put the recomputed groups in and remove groups that vanished from those days."""
    tagged = metrics.join(days.withColumn("_touched", F.lit(True)), "ref_date", "left").select(*metrics.columns, "_touched")
    source = recomputed.withColumn("_touched", F.lit(True)).select(*tagged.columns)
    return U.merge(
        tagged,
        source,
        DIMENSIONS,
        delete_missing=lambda old: old["_touched"],
        unique_source=True,
        co_partition=co_partition,
    )


# -- upkeep by signed changes --------------------------------------------------


def metric_deltas(changes: DataFrame) -> DataFrame:
    """Signed metric rows: by how much each group moves, from the change feed alone.

    The state holds one row per client and type, and type is a metric dimension:
    within a group every row is another client. Rows and distinct clients then move
    together by +1 and -1, so the distinct count is additive over change rows and
    the state need not be read again.
    """
    moved = with_ref_date(changes).groupBy(*DIMENSIONS).agg(F.sum(_signed()).cast("long").alias("total_events"))
    return moved.filter("total_events <> 0").withColumn("total_clients", F.col("total_events"))


def apply_deltas(
    metrics: DataFrame,
    deltas: DataFrame,
    co_partition: str | None = None,
    keys: Sequence[str] = DIMENSIONS,
    counts: Sequence[str] = ("total_events", "total_clients"),
) -> DataFrame:
    """Verdicts that add signed rows to the counts; groups whose first count reaches zero are deleted."""
    summed = U.merge(
        metrics,
        deltas,
        keys,
        update_set={name: lambda s, t, name=name: t[name] + s[name] for name in counts},
        unique_source=True,
        co_partition=co_partition,
    )
    gone = (F.col(U.ACTION) == U.UPDATE) & (F.col(f"{U.NEW}.{counts[0]}") == 0)
    return summed.select(
        U.OLD,
        F.when(~gone, F.col(U.NEW)).alias(U.NEW),
        F.when(gone, F.lit(U.DELETE)).otherwise(F.col(U.ACTION)).alias(U.ACTION),
    )


# -- distinct clients of any grouping --------------------------------------------


def _signed() -> Column:
    return F.when(F.col(U.CHANGE_TYPE).isin(U.INSERT, U.POSTIMAGE), 1).otherwise(-1)


def reference_deltas(changes: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """By how many state rows each client moves in each group.

    A client may have several rows in a group, so the group's clients cannot be told from its rows alone. What
    tells them is the number of rows per group and client: a client is there as long as its number is not zero.
    """
    moved = with_ref_date(changes).groupBy(*dimensions, "client_id").agg(F.sum(_signed()).cast("long").alias("held"))
    return moved.filter("held <> 0")


def distinct_deltas(changes: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Signed rows and clients per group from the change feed of the references.

    A reference that comes or goes is a client that does; one whose number moves only moves the rows. A hot group is
    summed per task before the shuffle.
    """
    return (
        changes.groupBy(*dimensions)
        .agg(
            F.sum(_signed() * F.col("held")).cast("long").alias("total_events"),
            F.sum(_signed()).cast("long").alias("total_clients"),
        )
        .filter("total_events <> 0 OR total_clients <> 0")
    )


# -- reports -------------------------------------------------------------------


def mirror(metrics: DataFrame) -> DataFrame:
    """Metric rows for the document store, which keeps dates as text."""
    return metrics.withColumn("ref_date", F.col("ref_date").cast("string"))


def totals(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.coalesce(F.sum("total_events"), F.lit(0)).alias("total_events"),
        F.coalesce(F.sum("total_clients"), F.lit(0)).alias("clients_summed_by_row"),
        F.countDistinct("ref_date").alias("days"),
        F.count("*").alias("metric_rows"),
    )


def events_by(metrics: DataFrame, dimension: str) -> DataFrame:
    by = metrics.groupBy(dimension).agg(F.sum("total_events").alias("total_events"))
    if dimension == "ref_date":
        return by.orderBy("ref_date")
    return by.orderBy(F.desc("total_events"), dimension)


def latest_metrics(metrics: DataFrame, limit: int = 1000) -> DataFrame:
    """Newest rows first; the other dimensions make the cut-off row definite."""
    return metrics.orderBy(F.desc("ref_date"), "bank_id", "insurer_id", "consent_type").limit(limit)


def active_per_day(state: DataFrame, active: str) -> DataFrame:
    day = F.date_trunc("day", "event_time").cast("date").alias("day")
    return state.filter(F.col("status") == active).groupBy(day).agg(F.count("*").alias("active"))


def usage_rollup(usage: DataFrame, job: str, quantity: Column) -> DataFrame:
    return usage.groupBy(job).agg(F.sum(quantity).alias("usage"), F.count("*").alias("records"))


def percentile_by(rows: DataFrame, group: str, value: str, share: float, accuracy: int = 100_000) -> DataFrame:
    """Approximate percentile; sketches are merged, so a hot group is summarised before the shuffle."""
    return rows.groupBy(group).agg(
        F.percentile_approx(value, share, accuracy).alias(f"p{round(share * 100)}"),
        F.count("*").alias("records"),
    )


def volume_anomalies(
    rows: DataFrame, group: str, time: str, window_days: int = 7, factor: float = 3.0
) -> DataFrame:
    """Daily volume against the moving average of the days before.

    The window runs over daily counts, at most one row per calendar day and group.
    """
    daily = rows.groupBy(group, F.to_date(time).alias("day")).agg(F.count("*").alias("volume"))
    before = Window.partitionBy(group).orderBy("day").rowsBetween(-window_days, -1)
    average = F.sum("volume").over(before) / F.count("volume").over(before)
    return daily.withColumn("moving_average", average).withColumn(
        "anomalous", F.coalesce(F.col("volume") > F.col("moving_average") * factor, F.lit(False))
    )


def window_counts(rows: DataFrame, time: str, length: str, *groups: str) -> DataFrame:
    """Tumbling event-time counts; the same call serves a batch and a watermarked stream."""
    counted = rows.groupBy(F.window(time, length).alias("w"), *groups).agg(F.count("*").alias("events"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *groups, "events")
