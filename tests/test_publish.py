"""The publishing sink and the isolation of rows that cannot be applied."""

import os

import pytest
from pyspark.sql import functions as F

from eventlake.operators import events as V
from eventlake.plans import streams as Q
from eventlake.plans import tables as X
from eventlake.sources import log_sink as LOG
from eventlake.streaming import batches as B
from eventlake.streaming import jobs as J


def parsed(spark, sf):
    return V.parse_events(V.raw_events(X.log_from_events(Q.table_stream(spark, sf, "events"))))


def folders(path):
    found = os.path.join(path, "stream=publish")
    return sorted(os.listdir(found)) if os.path.exists(found) else []


def test_a_failed_task_leaves_no_half_batch(spark, sf, tmp_path):
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    bad = F.when(F.col("offset") == 500, F.raise_error(F.lit("killed")).cast("string")).otherwise(F.col("raw_json"))
    broken = V.parse_events(V.raw_events(X.log_from_events(Q.table_stream(spark, sf, "events"))).withColumn("raw_json", bad))
    with pytest.raises(Exception, match="killed"):
        LOG.publish(broken, path, checkpoint, X.FULL_CONTRACT)
    assert [f for f in folders(path) if not f.startswith("_")] == []
    counts = LOG.publish(parsed(spark, sf), path, checkpoint, X.FULL_CONTRACT)
    log = LOG.published_log(spark, path)
    assert [f for f in folders(path) if not f.startswith("_")] == ["batch=0"] and log.count() == counts["published"] > 0 < counts["rejected"]
    assert log.select("partition", "offset").distinct().count() == log.count()
    # a key stays in one partition
    assert log.groupBy("key").agg(F.countDistinct("partition").alias("n")).filter("n > 1").isEmpty()
    # nothing new: nothing published, nothing changed
    assert LOG.publish(parsed(spark, sf), path, checkpoint, X.FULL_CONTRACT) == {"published": 0, "rejected": 0}
    assert log.count() == counts["published"]


def test_a_hot_key_is_written_by_many_tasks(spark, sf, tmp_path):
    hot = X.log_from_events(Q.table_stream(spark, sf, "events").withColumn("user_id", F.lit(7).cast("long")))
    path = str(tmp_path / "log")
    counts = LOG.publish(V.parse_events(V.raw_events(hot)), path, str(tmp_path / "checkpoint"), X.FULL_CONTRACT)
    log = LOG.published_log(spark, path)
    assert log.select("partition").distinct().count() == 1 and log.select("offset").distinct().count() == counts["published"]
    per_file = [r["count"] for r in log.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == counts["published"] and max(per_file) < counts["published"] / 4


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    writer = LOG._Writer({"path": str(tmp_path), "stream": "s"})
    again = LOG._Writer({"path": str(tmp_path), "stream": "s"})
    rows = spark.createDataFrame([(bytearray(b"k"), bytearray(b"v"), "t", 1, None)], LOG.WRITTEN).toArrow().to_batches()
    stray = writer.write(iter(rows))
    writer.commit([writer.write(iter(rows)), writer.write(iter([]))], 3)
    again.commit([again.write(iter(rows))], 3)
    assert stray.folders and LOG.published_log(spark, str(tmp_path)).count() == 1
    assert [f for f in os.listdir(tmp_path / "stream=s") if not f.startswith("_")] == ["batch=3"]


def test_too_many_failures_stop_the_stream(spark, tmp_path):
    def apply(rows, batch_id, part):
        raise OSError("sink is down")

    checkpoint = str(tmp_path / "checkpoint")
    source = str(tmp_path / "in")
    spark.range(50).write.parquet(source)
    rows = spark.readStream.schema("id long").parquet(source)
    with pytest.raises(Exception, match="sink is down"):
        B.drain(rows, B.isolating(apply, str(tmp_path / "letters"), checkpoint, ["id"], most=2), checkpoint)
    done = []
    B.drain(rows, B.isolating(lambda r, b, p: done.append((r.count(), p)), str(tmp_path / "letters"), checkpoint, ["id"]), checkpoint)
    assert done == [(50, B.WHOLE)]


def test_poison_events_leave_the_state_whole(spark, sf, tmp_path):
    """Events that break the merge are set aside; the state is that of all others."""
    lake = J.Lake(str(tmp_path / "lake"), buckets=4)
    events = Q.table_stream(spark, sf, "events").filter("event_id < 60")
    # events that the merge would see, as each is the only one of its key
    poison = [7, 8]

    def master(session):
        return X.client_master(session, sf)

    real = J.E.enrich

    def enrich(newest, names):
        found = newest.filter(F.col("offset").isin(poison)).select("offset").distinct().collect()
        if found:
            raise ValueError(f"poison {sorted(r.offset for r in found)}")
        return real(newest, names)

    letters = str(tmp_path / "letters")
    J.E.enrich = enrich
    try:
        J.drain_events(spark, lake, X.log_from_events(events), master=master, dead_letters=letters)
    finally:
        J.E.enrich = real
    aside = spark.read.parquet(letters).select("offset", "_error").collect()
    assert {(r.offset, r["_error"]) for r in aside} == {(p, f"ValueError: poison [{p}]") for p in poison}
    clean = J.Lake(str(tmp_path / "clean"), buckets=4)
    others = events.filter(~F.col("event_id").isin([r.offset for r in aside]))
    J.drain_events(spark, clean, X.log_from_events(others), master=master)
    left, right = lake.state(spark).read(), clean.state(spark).read()
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_rows_told_unfit_do_not_count_against_the_most(spark, tmp_path):
    """Any number of rows is set aside by their own fault; one that only applying shows is still found alone."""
    checkpoint, source, letters = str(tmp_path / "checkpoint"), str(tmp_path / "in"), str(tmp_path / "letters")
    spark.range(3000).write.parquet(source)
    told = F.when(F.col("id") % 3 == 0, F.concat(F.lit("third "), F.col("id").cast("string")))
    parts, done = [], []

    def apply(rows, batch_id, part):
        parts.append(part)
        ids = [r.id for r in rows.collect()]
        if 1000 in ids or 1001 in ids:
            raise ValueError(f"cannot take {sorted({1000, 1001} & set(ids))}")
        done.extend(ids)

    rows = spark.readStream.schema("id long").parquet(source)
    B.drain(rows, B.isolating(apply, letters, checkpoint, ["id"], most=2, fault=told), checkpoint)
    aside = {r.id: r["_error"] for r in spark.read.parquet(f"{letters}/checkpoint=*/batch_id=*/part=*").collect()}
    assert sorted(done) == [i for i in range(3000) if i % 3 and i not in (1000, 1001)]
    assert len(aside) == 1002 and aside[999] == "third 999"
    assert aside[1000] == "ValueError: cannot take [1000]" and aside[1001] == "ValueError: cannot take [1001]"
    # no part that is known to fail is applied but a single key: fewer than two calls a level
    assert len(parts) == len(set(parts)) < 50
