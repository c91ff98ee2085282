import datetime as dt

from pyspark.sql import functions as F

from eventlake.streaming import windows as W
from eventlake.streaming.batches import drain_to_files

START = dt.datetime(2026, 1, 1, 12)
SCHEMA = "id bigint, at timestamp, k string"


def minute(n):
    return START + dt.timedelta(minutes=n)


def files(spark, path, *batches):
    """One file per batch, read in this order."""
    for rows in batches:
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def drained(spark, rows, tmp_path):
    schema = rows.schema
    drain_to_files(rows, str(tmp_path / "out"), str(tmp_path / "cp"))
    return spark.read.schema(schema).parquet(str(tmp_path / "out"))


def test_late_events_count_until_the_watermark(spark, tmp_path):
    stream = files(
        spark,
        str(tmp_path / "in"),
        [(1, minute(0), "a"), (2, minute(6), "a")],
        [(3, minute(1), "a"), (4, minute(40), "a")],  # 12:01 is late but inside 15 minutes
        [(5, minute(41), "a")],
        [(6, minute(2), "a"), (7, minute(42), "a")],  # 12:02 is now beyond the watermark
    )
    counts = drained(spark, W.windowed_counts(stream, "at", "15 minutes", "5 minutes", "k"), tmp_path)
    assert {r.window_start: r.events for r in counts.collect()} == {minute(0): 2, minute(5): 1}


def test_duplicates_across_batches_are_dropped(spark, tmp_path):
    first = [(1, minute(0), "a"), (2, minute(1), "a")]
    stream = files(spark, str(tmp_path / "in"), first, [(1, minute(2), "again"), (3, minute(3), "a")])
    rows = drained(spark, W.deduplicated(stream, "at", "10 minutes", ["id"]), tmp_path)
    assert sorted((r.id, r.k) for r in rows.collect()) == [(1, "a"), (2, "a"), (3, "a")]


def test_stream_join_waits_for_the_other_side(spark, tmp_path):
    left = files(spark, str(tmp_path / "l"), [(1, minute(0), "l"), (2, minute(0), "l")], [(3, minute(5), "l")])
    right = files(spark, str(tmp_path / "r"), [(9, minute(1), "r")], [(1, minute(10), "r"), (2, minute(45), "r")])
    right = right.select(F.col("id").alias("rid"), F.col("at").alias("rat"))
    joined = W.interval_join(left, right, ("id", "rid"), ("at", "rat"), "30 minutes", delay="10 minutes")
    assert [r.id for r in drained(spark, joined, tmp_path).collect()] == [1]
