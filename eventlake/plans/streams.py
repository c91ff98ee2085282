"""Named queries that run the streaming jobs over the given tables.

They write below the shared folder, drain, stop, and return what was stored.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import events as V
from eventlake.plans import tables as X
from eventlake.plans.registry import flat, flat_documents, query
from eventlake.session import new_scratch, pin_utc
from eventlake.sources import files as CSV
from eventlake.sources import log_sink as LOG
from eventlake.streaming import jobs as J
from eventlake.streaming import windows as W
from eventlake.streaming.batches import drain, drain_to_files, isolating

def table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table as a stream; times get the zone that watermarks ask for."""
    pin_utc(spark)
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)
    zoned = [
        F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name)
        for f in schema.fields
    ]
    return rows.select(*zoned)


def new_lake(spark: SparkSession) -> J.Lake:
    return J.Lake(new_scratch(spark, "lake"), buckets=8)


def drain_feed(spark: SparkSession, sf: str, lake: J.Lake, name: str, events: DataFrame) -> None:
    J.drain_events(
        spark,
        lake,
        X.log_from_events(events),
        master=lambda session: X.client_master(session, sf),
        stream=name,
    )


def two_feeds(spark: SparkSession, sf: str, after_each) -> J.Lake:
    """The log in two parts that interleave in time: the second brings newer and late rows."""
    lake, events = new_lake(spark), table_stream(spark, sf, "events")
    insurer = F.concat(F.lit("ins-00"), (1 + F.col("event_id") % 3).cast("string"))
    standing = insurer == X.STANDING_INSURER
    for name, part in (("standing", standing), ("arriving", ~standing)):
        drain_feed(spark, sf, lake, name, events.filter(part))
        after_each(lake)
    return lake


def collected(rows: DataFrame, name: str) -> DataFrame:
    """Drain a stream into files and read them back."""
    base, schema = new_scratch(rows.sparkSession, name), rows.schema
    drain_to_files(rows, f"{base}/data", f"{base}/checkpoint")
    return rows.sparkSession.read.schema(schema).parquet(f"{base}/data")


@query
def stream_state(spark, sf):
    lake = two_feeds(spark, sf, lambda lake: None)
    return flat(lake.state(spark).read())


@query
def stream_quarantine(spark, sf):
    lake = new_lake(spark)
    drain_feed(spark, sf, lake, "events", table_stream(spark, sf, "events"))
    return flat(J.read_quarantine(spark, lake))


@query
def stream_quarantine_replayed(spark, sf):
    """The log read again from its start after the checkpoint was lost."""
    lake = new_lake(spark)
    for once in (lake, replace(lake, ops="ops-2")):
        drain_feed(spark, sf, once, "events", table_stream(spark, sf, "events"))
    return flat(J.read_quarantine(spark, lake))


@query
def topic_quarantine(spark, sf):
    """Two topics with the same partitions and offsets in one stream."""
    lake, log = new_lake(spark), X.log_from_events(table_stream(spark, sf, "events"))
    both = log.unionByName(log.withColumn("topic", F.concat(F.lit("copied-"), "topic")))
    J.drain_events(spark, lake, both, master=lambda session: X.client_master(session, sf))
    return flat(J.read_quarantine(spark, lake))


@query
def stream_expired_metrics(spark, sf):
    """Metrics and documents after old state has expired: both follow the change feed."""
    lake = two_feeds(spark, sf, lambda lake: (J.drain_metrics(spark, lake), J.drain_documents(spark, lake)))
    J.expire(spark, lake, F.lit("2024-01-16 00:00:00").cast("timestamp"))
    J.drain_metrics(spark, lake)
    J.drain_documents(spark, lake)
    metrics = lake.metrics(spark).read().select(
        F.lit("metrics").alias("kind"),
        F.concat_ws(" ", F.col("ref_date").cast("string"), "bank_id", "insurer_id", "consent_type").alias("name"),
        F.col("total_events").alias("n"),
    )
    documents = lake.documents(spark).read().select(
        F.lit("documents").alias("kind"),
        F.concat_ws(" ", "client_id", "bank_id", "insurer_id").alias("name"),
        F.size("items").cast("long").alias("n"),
    )
    return metrics.unionByName(documents)


def published(spark: SparkSession, sf: str) -> tuple[str, dict[str, int]]:
    """The folder that the events are published to, and the counts taken on the way."""
    base = new_scratch(spark, "published")
    parsed = V.parse_events(V.raw_events(X.log_from_events(table_stream(spark, sf, "events"))))
    return f"{base}/log", LOG.publish(parsed, f"{base}/log", f"{base}/checkpoint", X.FULL_CONTRACT)


@query
def stream_publish(spark, sf):
    """Valid events published to a log of files and read back from it as a stream."""
    path, _ = published(spark, sf)
    return flat(collected(LOG.published_log(spark, path, streaming=True), "read-back").select("key", "value"))


@query
def stream_publish_stats(spark, sf):
    """What the publishing stream counted, and how many offsets the log has."""
    path, counts = published(spark, sf)
    places = LOG.published_log(spark, path).select("topic", "partition", "offset").distinct()
    return places.agg(
        F.lit(counts["published"]).cast("long").alias("published"),
        F.lit(counts["rejected"]).cast("long").alias("rejected"),
        F.count("*").alias("offsets"),
    )


#: Bad events below this id are found by applying alone.
UNTOLD = 10_000


@query
def stream_poison_rows(spark, sf):
    """A batch with a few events that cannot be applied: all others are, once, and each of those has its own error.

    Of the first events nothing but the failing batch tells it. Those that come with the size of the table are told row by
    row, as every single one that is found by applying costs some dozens of small jobs.
    """
    base = new_scratch(spark, "poison")
    bad = F.col("event_id") % 3331 == 7
    text = F.concat(F.lit("bad event "), F.col("event_id").cast("string"))
    error = F.raise_error(text).cast("string")
    fault = F.when(bad & (F.col("event_id") >= UNTOLD), text)

    def apply(rows: DataFrame, batch_id: int, part: str) -> None:
        judged = rows.withColumn("outcome", F.when(bad, error).otherwise("applied"))
        judged.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{base}/applied/batch={batch_id}/part={part}")

    rows = table_stream(spark, sf, "events").select("event_id", "event_type")
    drain(rows, isolating(apply, f"{base}/letters", f"{base}/checkpoint", ["event_id"], fault=fault), f"{base}/checkpoint")
    schema = "event_id long, event_type string"
    applied = spark.read.schema(schema + ", outcome string").parquet(f"{base}/applied/batch=*/part=*")
    letters = spark.read.schema(schema + ", _error string").parquet(f"{base}/letters/checkpoint=*/batch_id=*/part=*")
    outcome = F.regexp_extract("_error", "bad event [0-9]+", 0).alias("outcome")
    return applied.unionByName(letters.select("event_id", "event_type", outcome))


@query
def stream_change_feed(spark, sf):
    lake = two_feeds(spark, sf, lambda lake: None)
    return flat(lake.state(spark).changes(after=1))


@query
def stream_metrics(spark, sf):
    lake = two_feeds(spark, sf, lambda lake: J.drain_metrics(spark, lake))
    return lake.metrics(spark).read()


@query
def stream_metrics_recomputed(spark, sf):
    lake = two_feeds(spark, sf, lambda lake: J.drain_metrics(spark, lake, recompute=True))
    return lake.metrics(spark).read()


#: Groupings whose distinct clients are kept; in none of them are they additive over rows.
GROUPINGS = (("ref_date",), ("bank_id",), ("ref_date", "bank_id"), ("insurer_id", "status"))


@query
def stream_distinct_clients(spark, sf):
    """Rows and distinct clients of several groupings, moved by the change feed after each feed."""
    lake = two_feeds(spark, sf, lambda lake: [J.drain_distinct(spark, lake, by) for by in GROUPINGS])
    parts = [
        lake.distinct_clients(spark, by).read().select(
            F.lit(" ".join(by)).alias("dimensions"),
            F.concat_ws(" ", *[F.col(c).cast("string") for c in by]).alias("value"),
            "total_events",
            "total_clients",
        )
        for by in GROUPINGS
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def stream_distinct_expired(spark, sf):
    """The same after old state has expired: clients leave their groups, empty groups vanish."""
    by = ("ref_date", "bank_id")
    lake = two_feeds(spark, sf, lambda lake: J.drain_distinct(spark, lake, by))
    J.expire(spark, lake, F.lit("2024-01-16 00:00:00").cast("timestamp"))
    J.drain_distinct(spark, lake, by)
    return lake.distinct_clients(spark, by).read()


@query
def day_lookup(spark, sf):
    """Metrics of one day after recomputing by day: one bucket is read."""
    lake = two_feeds(spark, sf, lambda lake: J.drain_metrics(spark, lake, recompute=True))
    return lake.metrics(spark).lookup(ref_date=dt.date(2024, 1, 16))


@query
def stream_documents(spark, sf):
    lake = two_feeds(spark, sf, lambda lake: J.drain_documents(spark, lake))
    return flat_documents(lake.documents(spark).read())


@query
def state_version(spark, sf):
    """The state as it was before the second feed arrived."""
    lake = two_feeds(spark, sf, lambda lake: None)
    return flat(lake.state(spark).read(version=1))


@query
def state_lookup(spark, sf):
    """Point lookup that reads one bucket of the stored documents."""
    lake = two_feeds(spark, sf, lambda lake: None)
    J.drain_documents(spark, lake)
    return flat_documents(lake.documents(spark).lookup(client_id="cli-00007"))


@query
def compacted_state(spark, sf):
    lake = two_feeds(spark, sf, lambda lake: None)
    state = lake.state(spark)
    state.compact()
    return flat(state.read())


@query
def bronze_ingest(spark, sf):
    """The client master written as CSV files into the drop folder and taken in."""
    lake = new_lake(spark)
    CSV.write_csv(X.client_master(spark, sf), lake.landing)
    J.ingest_master(pin_utc(spark), lake, [CSV.DropSource("client_master", "*.csv", S.CLIENT_MASTER)])
    return lake.clients(spark).read().select(*S.CLIENT_MASTER.fieldNames())


@query
def bronze_append(spark, sf):
    """The append table after two checkpoints: the second sees both files again, one with a column of its own."""
    lake, master = new_lake(spark), X.client_master(pin_utc(spark), sf)
    source = CSV.DropSource("client_master", "*.csv", S.CLIENT_MASTER)
    CSV.write_csv(master.filter("bank_id = 'bank-002'"), lake.landing)
    J.ingest_master(spark, lake, [source])
    more = master.filter("bank_id = 'bank-003'").withColumn("_score", F.lit(7))
    more.write.mode("append").option("header", True).csv(lake.landing)
    J.ingest_master(spark, replace(lake, ops="ops-2"), [source])
    rows = CSV.read_table(spark, lake.bronze("client_master"))
    return rows.select(*S.CLIENT_MASTER.fieldNames(), "_score")


@query
def partition_scan(spark, sf):
    """Partition columns come back from the folder names; a filter on them skips folders."""
    path = new_scratch(spark, "by-type")
    events = X.read(spark, sf, "events").withColumn("day", F.to_date("ts"))
    # Rebalancing gathers each type into files of the advised size and splits a hot type over tasks.
    events.hint("rebalance", "event_type").write.partitionBy("event_type").parquet(path)
    read = spark.read.parquet(path).filter(F.col("event_type").isin("purchase", "signup"))
    return read.groupBy("event_type", "day").agg(F.count("*").alias("events"))


@query
def interval_join(spark, sf):
    """Order lines shipped within 90 days of their order."""
    orders = X.read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = X.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return W.interval_join(
        orders, lines, ("o_orderkey", "l_orderkey"), ("o_orderdate", "l_shipdate"), "90 days"
    )


@query
def stream_interval_join(spark, sf):
    orders = table_stream(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = table_stream(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    joined = W.interval_join(
        orders, lines, ("o_orderkey", "l_orderkey"), ("o_orderdate", "l_shipdate"), "90 days", delay="1 day"
    )
    return flat(collected(joined, "interval-join"))


@query
def stream_window_counts(spark, sf):
    """Windows that the watermark has closed, as append mode emits them."""
    events = table_stream(spark, sf, "events")
    return flat(collected(W.windowed_counts(events, "ts", "15 minutes", "5 minutes", "event_type"), "windows"))


@query
def stream_dedup(spark, sf):
    """Every event delivered twice."""
    events = table_stream(spark, sf, "events").select("event_id", "ts", "user_id")
    twice = events.unionByName(events)
    return flat(collected(W.deduplicated(twice, "ts", "10 minutes", ["event_id"]), "dedup"))
