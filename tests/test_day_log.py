"""The state laid out by day, and distinct clients kept by reference counts."""

import datetime as dt
import glob
import itertools
import os

import pytest
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import metrics as M
from eventlake.operators import quality as Q
from eventlake.operators import upsert as U
from eventlake.streaming import jobs as J

DAYS = [dt.datetime(2026, 1, d, 10) for d in range(1, 7)]
_offset = itertools.count()


def rows(spark, *items):
    full = [(c, bank, "ins-1", None, None, time, "t", next(_offset), kind, ["x"], "active") for c, bank, kind, time in items]
    return spark.createDataFrame(full, S.STATE)


@pytest.fixture
def lake(tmp_path):
    return J.Lake(str(tmp_path / "lake"), buckets=4)


def put(spark, lake, *items):
    lake.state(spark).merge(rows(spark, *items), guard=U.newer(*U.STATE_ORDER), unique_source=True)


def same(left, right):
    return Q.differences(left, right.select(*left.columns)).isEmpty()


def counted(state, by):
    dated = M.with_ref_date(state)
    return dated.groupBy(*by).agg(F.count("*").alias("total_events"), F.countDistinct("client_id").alias("total_clients"))


def test_only_the_files_of_affected_days_are_read(spark, lake):
    put(spark, lake, *[(f"c{n}", "b1", "a", DAYS[n % 5]) for n in range(20)])
    J.drain_metrics(spark, lake, recompute=True)
    put(spark, lake, ("c0", "b1", "a", DAYS[1]), ("new", "b2", "a", DAYS[1]))  # c0 leaves the first day
    wanted = M.daily_metrics(lake.state(spark).read())

    log, changes = lake.days(spark), lake.state(spark).changes(1, 2)
    log.follow(2)
    days = M.measured_days(M.affected_dates(changes))
    plan = M.recompute_days(log.read(2), days)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    # files of other days are broken: whoever reads one fails
    files = glob.glob(f"{log.path}/data/*/*/*.parquet")
    others = [f for f in files if "2026-01-01" not in f and "2026-01-02" not in f]
    assert others and len(others) < len(files)
    for path in others:
        open(path, "wb").write(b"broken")
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    with pytest.raises(Exception, match="(?i)parquet"):
        log.read(2).groupBy().sum("_net").collect()
    J.drain_metrics(spark, lake, recompute=True)
    assert same(lake.metrics(spark).read(), wanted)


def test_recomputing_rewrites_only_buckets_of_affected_days(spark, lake):
    put(spark, lake, *[(f"c{n}", "b1", "a", DAYS[n % 6]) for n in range(12)])
    J.drain_metrics(spark, lake, recompute=True)
    before = lake.metrics(spark).commit()
    put(spark, lake, ("new", "b1", "a", DAYS[2]))
    J.drain_metrics(spark, lake, recompute=True)
    after = lake.metrics(spark).commit()
    assert len([b for b, v in after.buckets.items() if before.buckets.get(b) != v]) == 1
    assert lake.metrics(spark).lookup(ref_date=DAYS[2].date()).first()["total_clients"] == 3


def test_folder_without_commit_is_written_anew(spark, lake):
    put(spark, lake, ("c1", "b1", "a", DAYS[0]), ("c2", "b1", "a", DAYS[1]))
    log = lake.days(spark)
    log.follow(1)
    held = log.read().collect()
    os.remove(f"{log.path}/commits/1")
    crc = f"{log.path}/commits/.1.crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert log.read().isEmpty()
    log.follow(1)
    log.follow(1)
    assert sorted(log.read().collect()) == sorted(held)


def test_day_that_is_emptied_vanishes_and_a_missing_bank_is_a_group(spark, lake):
    put(spark, lake, ("c1", None, "a", DAYS[0]), ("c2", None, "a", DAYS[1]))
    J.drain_metrics(spark, lake, recompute=True)
    put(spark, lake, ("c1", None, "a", DAYS[1]))
    J.drain_metrics(spark, lake, recompute=True)
    found = [tuple(r) for r in lake.metrics(spark).read().collect()]
    assert found == [(DAYS[1].date(), None, "ins-1", "a", 2, 2)]


def test_clients_with_several_rows_count_once_and_leave_with_the_last(spark, lake):
    groupings = [("bank_id",), ("ref_date",), ("ref_date", "bank_id")]

    def drained():
        for by in groupings:
            J.drain_distinct(spark, lake, by)
            assert same(lake.distinct_clients(spark, by).read(), counted(lake.state(spark).read(), by))

    put(spark, lake, *[("hot", "b1", f"kind{n}", DAYS[0]) for n in range(5)], ("c2", "b1", "a", DAYS[0]), ("c3", None, "a", DAYS[0]))
    drained()
    assert lake.distinct_clients(spark, ("bank_id",)).lookup(bank_id="b1").first()["total_clients"] == 2
    put(spark, lake, *[("hot", "b2", f"kind{n}", DAYS[1]) for n in range(4)])  # one row stays behind
    drained()
    assert lake.distinct_clients(spark, ("bank_id",)).lookup(bank_id="b1").first()["total_clients"] == 2
    put(spark, lake, ("hot", "b2", "kind4", DAYS[1]))
    drained()
    assert lake.distinct_clients(spark, ("bank_id",)).lookup(bank_id="b1").first()["total_clients"] == 1
    J.expire(spark, lake, F.lit(DAYS[1]))
    drained()
    assert lake.distinct_clients(spark, ("ref_date",)).read().count() == 1


def test_draining_again_changes_nothing(spark, lake):
    put(spark, lake, ("c1", "b1", "a", DAYS[0]))
    for _ in range(2):
        J.drain_distinct(spark, lake, ("bank_id",))
    assert lake.distinct_clients(spark, ("bank_id",)).versions() == [1]
