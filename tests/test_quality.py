import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlake.operators import enrich as E
from eventlake.operators import quality as Q


def test_constraints_report_and_enforcement(spark, tmp_path):
    rows = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, None)], "id int, status string")
    checks = {"status_known": F.col("status") == "ok"} | Q.required("id")
    assert {r.check_name: r.violations for r in Q.constraint_violations(rows, checks).collect()} == {
        "status_known": 1,
        "id_not_null": 0,
    }
    with pytest.raises(Exception, match="check status_known violated"):
        Q.enforce(rows, checks).write.parquet(str(tmp_path / "bad"))
    good = rows.filter("id <> 2")
    Q.enforce(good, checks).write.parquet(str(tmp_path / "good"))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 2


def test_expectations(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "x"), (None, None)], "id int, ref string")
    known = spark.createDataFrame([("a",)], "key string")
    report = Q.expectations_report(rows, ["id"], [["id"]], [("ref", known, "key")])
    assert {r.expectation: (r.failing, r.passed) for r in report.collect()} == {
        "not_null(id)": (1, False),
        "unique(id)": (1, False),
        "references(ref)": (1, False),
    }


def test_differences_count_duplicates(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "v string")
    b = spark.createDataFrame([("x",), ("z",), (None,)], "v string")
    found = {r.v: (r.left_count, r.right_count) for r in Q.differences(a, b).collect()}
    assert found == {"x": (2, 1), "y": (1, 0), "z": (0, 1)}
    assert {r.v for r in a.exceptAll(b).collect()} | {r.v for r in b.exceptAll(a).collect()} == set(found)


def test_golden_comparison(spark, tmp_path):
    path = str(tmp_path / "golden")
    spark.range(5).write.parquet(path)
    Q.assert_same(spark.range(5), spark.read.parquet(path))
    with pytest.raises(AssertionError, match="id=5"):
        Q.assert_same(spark.range(6), spark.read.parquet(path))


def test_freshness_and_retention(spark):
    now = dt.datetime(2026, 1, 31)
    rows = spark.createDataFrame(
        [("old", now - dt.timedelta(days=40)), ("late", now - dt.timedelta(hours=3)), ("new", now - dt.timedelta(hours=1))],
        "g string, at timestamp",
    )
    as_of = F.lit("2026-01-31").cast("timestamp")
    assert {r.g: r.stale for r in Q.freshness(rows, "g", "at", as_of, 2).collect()} == {"old": True, "late": True, "new": False}
    assert {r.g for r in Q.retained(rows, "at", as_of, 30).collect()} == {"late", "new"}


def test_canary_is_stable_and_about_as_large_as_asked(spark):
    rows = Q.canary_split(spark.range(20_000), "id", 5)
    share = rows.filter("arm = 'canary'").count() / 20_000
    assert 0.04 < share < 0.06
    first = {r.id for r in rows.filter("arm = 'canary'").collect()}
    again = {r.id for r in Q.canary_split(spark.range(20_000).repartition(7), "id", 5).filter("arm = 'canary'").collect()}
    assert first == again


def test_broadcast_only_after_measuring(spark):
    small = spark.createDataFrame([("a", "x" * 10)], "k string, v string")
    assert E.measured_bytes(small) == 1 + 32 + 10 + 32

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(E.broadcast_if_small(small))
    assert not hinted(E.broadcast_if_small(small, limit=10))


def test_master_dedup_is_definite(spark):
    rows = [("c", "A", 1), ("c", "B", 2), ("c", "C", 2), ("d", "D", None)]
    master = spark.createDataFrame(rows, "client_id string, client_name string, n int").select(
        "client_id", "client_name", F.timestamp_seconds("n").alias("_ingested_at")
    )
    assert {r.client_id: r.client_name for r in E.newest_master(master).collect()} == {"c": "C", "d": "D"}


def test_lookup_array_is_empty_without_match(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, ref string")
    other = spark.createDataFrame([("a", "Alpha")], "key string, name string")
    found = {r.id: [x.name for x in r.hits] for r in E.lookup_array(rows, other, "ref", "key", "hits").collect()}
    assert found == {1: ["Alpha"], 2: [], 3: []}
