import datetime as dt

from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import metrics as M
from eventlake.operators import upsert as U

DAY1, DAY2 = dt.datetime(2026, 1, 1, 10), dt.datetime(2026, 1, 2, 10)


def state(spark, *rows):
    full = [(c, bank, "ins-1", None, None, time, "t", n, kind, ["x"], "active") for n, (c, bank, kind, time) in enumerate(rows)]
    return spark.createDataFrame(full, S.STATE)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*S.METRICS.fieldNames()).collect()), key=repr)


def after_merge(before, batch):
    verdicts = U.merge(before, batch, S.STATE_KEY, guard=U.newer())
    return U.merged_state(verdicts), U.change_rows(verdicts)


def test_row_that_moves_to_another_day_leaves_its_old_group(spark):
    before = state(spark, ("c1", "b1", "a", DAY1), ("c2", "b1", "a", DAY1), ("c3", "b2", "a", DAY1))
    batch = state(spark, ("c1", "b1", "a", DAY2), ("c3", "b2", "a", DAY2), ("c4", "b1", "a", DAY2))
    now, changes = after_merge(before, batch)
    wanted = rows_of(M.daily_metrics(now))

    metrics = M.daily_metrics(before)
    recomputed = M.recompute_affected(now, changes)
    replaced = M.replace_affected(metrics, recomputed, M.affected_dates(changes))
    assert rows_of(U.merged_state(replaced)) == wanted

    summed = M.apply_deltas(metrics, M.metric_deltas(changes))
    assert rows_of(U.merged_state(summed)) == wanted
    # The group of day 1 and bank b2 has vanished and is reported as deleted.
    assert U.change_rows(summed).filter("_change_type = 'delete' AND bank_id = 'b2'").count() == 1


def test_untouched_days_are_not_recomputed(spark):
    before = state(spark, ("c1", "b1", "a", DAY1), ("c2", "b1", "a", DAY2))
    now, changes = after_merge(before, state(spark, ("c3", "b1", "a", DAY2)))
    days = {r.ref_date for r in M.recompute_affected(now, changes).collect()}
    assert days == {DAY2.date()}


def test_null_dimension_is_replaced_not_added_again(spark):
    before = state(spark, ("c1", None, "a", DAY1))
    now, changes = after_merge(before, state(spark, ("c2", None, "a", DAY1)))
    for _ in range(2):
        replaced = M.replace_affected(M.daily_metrics(before), M.recompute_affected(now, changes), M.affected_dates(changes))
    assert rows_of(U.merged_state(replaced)) == [(DAY1.date(), None, "ins-1", "a", 2, 2)]


def test_distinct_clients_are_not_rows(spark):
    history = state(spark, ("c1", "b1", "a", DAY1), ("c1", "b1", "a", DAY1), ("c2", "b1", "a", DAY1))
    assert rows_of(M.daily_metrics(history)) == [(DAY1.date(), "b1", "ins-1", "a", 3, 2)]


def test_reports_on_empty_metrics(spark):
    empty = spark.createDataFrame([], S.METRICS)
    assert M.totals(empty).first().asDict() == {
        "total_events": 0,
        "clients_summed_by_row": 0,
        "days": 0,
        "metric_rows": 0,
    }


def test_report_order_and_limit(spark):
    metrics = M.daily_metrics(state(spark, ("c1", "b1", "a", DAY1), ("c2", "b1", "b", DAY2), ("c3", "b2", "b", DAY2)))
    assert [r.ref_date for r in M.latest_metrics(metrics, 2).collect()] == [DAY2.date()] * 2
    assert [(r.consent_type, r.total_events) for r in M.events_by(metrics, "consent_type").collect()] == [("b", 2), ("a", 1)]
    assert [r.ref_date for r in M.events_by(metrics, "ref_date").collect()] == [DAY1.date(), DAY2.date()]
    assert M.mirror(metrics).schema["ref_date"].dataType.simpleString() == "string"


def test_volume_anomaly_needs_three_times_the_average(spark):
    volumes = [10] * 7 + [31, 10]
    rows = [(n, v) for n, v in enumerate(volumes)]
    events = (
        spark.createDataFrame(rows, "n int, v int")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("v"))))
        .select(F.lit("g").alias("g"), F.date_add(F.lit("2026-01-01").cast("date"), F.col("n")).alias("at"))
    )
    found = M.volume_anomalies(events, "g", "at").filter("anomalous").collect()
    assert [(r.volume, r.moving_average) for r in found] == [(31, 10.0)]
