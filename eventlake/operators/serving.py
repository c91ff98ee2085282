"""Reads behind the service endpoints, as DataFrame queries on the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def client_lookup(documents: DataFrame, client_id: str, first_only: bool = False) -> DataFrame:
    """All documents of a client; with ``first_only`` the first in a fixed order. Empty means not found."""
    found = documents.filter(F.col("client_id") == client_id)
    if first_only:
        return found.orderBy("bank_id", "insurer_id", "part").limit(1)
    return found


def service_status(documents: DataFrame) -> DataFrame:
    """Number of documents and of items in them; zeros for an empty store."""
    return documents.agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum(F.size("items")), F.lit(0)).alias("items"),
    )


def quarantine_documents(quarantine: DataFrame) -> DataFrame:
    """Quarantine rows for the document store: times as text."""
    return quarantine.withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("string"))


def quarantine_latest(quarantine: DataFrame, limit: int = 200) -> DataFrame:
    """Newest rejected events; topic, partition and offset settle equal times."""
    return (
        quarantine_documents(quarantine)
        .drop("_id")
        .withColumnRenamed("_batch_id", "batch_id")
        .orderBy(F.desc("kafka_timestamp"), F.desc("topic"), F.desc("partition"), F.desc("offset"))
        .limit(limit)
    )


def quarantine_total(quarantine: DataFrame) -> DataFrame:
    return quarantine.agg(F.count("*").alias("total"))
