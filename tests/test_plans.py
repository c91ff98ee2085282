"""Plan shapes that decide how the queries behave on large tables."""

import re

import pytest
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import documents as D
from eventlake.operators import enrich as E
from eventlake.operators import metrics as M
from eventlake.operators import upsert as U
from eventlake.plans import streams  # noqa: F401 - registers the stream queries
from eventlake.plans import tables as X
from eventlake.plans.registry import QUERIES
from eventlake.sources.versioned import VersionedTable
from eventlake.session import sql_conf

STREAMED = ("stream_", "state_", "compacted_", "bronze_", "partition_")
BATCH = [name for name in QUERIES if not name.startswith(STREAMED)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas", "ExistingRDD"):
        assert bad not in plan, bad


def test_newest_row_is_limited_before_the_shuffle(spark, sf):
    plan = plan_of(U.newest_items(X.items(spark, sf)))
    final, exchange, partial = (plan.index(x) for x in (", Final", "Exchange hashpartitioning", ", Partial"))
    assert final < exchange < partial


def test_distinct_count_is_spread_over_clients_first(spark, tmp_path):
    path = str(tmp_path / "state")
    spark.createDataFrame([], S.STATE).write.parquet(path)
    plan = plan_of(M.daily_metrics(spark.read.schema(S.STATE).parquet(path)))
    last, first = re.findall(r"Exchange hashpartitioning\((.*), \d+\), ENSURE", plan)
    assert "client_id" in first and "client_id" not in last
    assert "scope" not in re.search(r"ReadSchema: (.*)", plan).group(1)


def test_reports_on_events_read_only_their_columns(spark, sf):
    plan = plan_of(QUERIES["usage_rollup"](spark, sf))
    assert "ReadSchema: struct<event_type:string,value:double>" in plan


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([], S.DOCUMENTS).write.parquet(path)
    from eventlake.operators import serving as R

    plan = plan_of(R.client_lookup(spark.read.schema(S.DOCUMENTS).parquet(path), "c1"))
    assert "EqualTo(client_id,c1)" in plan


def test_top_k_has_no_full_sort(spark, sf):
    for name in ("metrics_latest", "quarantine_latest", "client_lookup_first"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, sf))


def test_merge_shuffles_each_side_once(spark, tmp_path, setting, monkeypatch):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    row = S.row(k=S.STRING, t=S.LONG)
    table = VersionedTable.create(spark, str(tmp_path / "t"), row, ["k"], buckets=4)
    table.merge(spark.createDataFrame([("a", 1)], row))
    plans = []
    monkeypatch.setattr(VersionedTable, "_write", lambda self, verdicts, version: plans.append(plan_of(verdicts)))
    with pytest.raises(Exception):
        table.merge(spark.createDataFrame([("a", 2)], row), guard=U.newer("t"))
        raise RuntimeError("nothing was written")
    exchanges = re.findall(r"Exchange hashpartitioning\((\S+)", plans[0])
    assert len(exchanges) == 2 and all(e.startswith("_bucket") for e in exchanges)


def test_hot_client_is_split_in_the_enriching_join(spark, setting):
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }.items():
        setting(key, value)
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 1000))
    items = spark.range(0, 400_000, 1, 16).select(hot.alias("client_id"), "id", F.md5(F.col("id").cast("string")).alias("x"))
    names = spark.range(0, 1000, 1, 4).select(
        F.concat(F.lit("c"), F.col("id")).alias("client_id"), F.lit("n").alias("client_name"), F.lit("t").alias("tax_id")
    )
    joined = E.enrich(items, names)
    assert joined.agg(F.count("*")).first()[0] == 400_000
    next(joined.toLocalIterator())
    assert "skew=true" in plan_of(joined)


def test_settings_are_restored(spark):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, None)
    with pytest.raises(ValueError):
        with sql_conf(spark, spark__sql__requireAllClusterKeysForCoPartition="false"):
            assert spark.conf.get(key) == "false"
            raise ValueError
    assert spark.conf.get(key, None) == before


@pytest.mark.parametrize("name", ["merge_upsert", "metrics_delta", "metrics_merge", "document_upsert"])
def test_the_log_is_parsed_once(spark, sf, name, monkeypatch):
    from eventlake.operators import events as V

    calls = []
    parse = V.parse_events
    monkeypatch.setattr(V, "parse_events", lambda *a, **k: calls.append(1) or parse(*a, **k))
    plan = plan_of(QUERIES[name](spark, sf))
    assert len(calls) == 1 and "from_json" not in plan


def test_change_feed_numbers_the_commit_after_the_standing_state(spark, sf):
    versions = QUERIES["change_feed"](spark, sf).select(U.COMMIT_VERSION).distinct().collect()
    assert [r[0] for r in versions] == [2]
