"""Nested per-client documents: build, replace, append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import upsert as U

def _item() -> Column:
    return F.struct("consent_type", "event_time", "status", "scope")


def client_documents(state: DataFrame, by_client: bool = False) -> DataFrame:
    """One document per client, bank and insurer with its items in a fixed order.

    Input is keyed state: one row per client and type, so an array holds at most
    one entry per type and cannot grow with the data. ``by_client`` keeps one
    document per client instead, headed by the bank and insurer of its newest item.
    """
    items = F.array_sort(F.collect_list(_item())).alias("items")
    if by_client:
        newest = F.struct("event_time", "topic", "offset", "consent_type")
        head = F.max_by(F.struct("bank_id", "insurer_id"), newest).alias("head")
        documents = state.groupBy("client_id").agg(head, items)
        documents = documents.select("client_id", "head.bank_id", "head.insurer_id", "items")
    else:
        documents = state.groupBy("client_id", "bank_id", "insurer_id").agg(items)
    return documents.withColumn("part", F.lit(0)).select(*S.DOCUMENTS.fieldNames())


def day_part(event_time: Column) -> Column:
    """The part that an item of a history belongs to: its day as a number, whatever the size of the history."""
    return F.date_format(event_time, "yyyyMMdd").cast("int")


def documents_from_items(items: DataFrame) -> DataFrame:
    """Documents straight from an item history: one per client, bank, insurer and day, in ``part``.

    A history has no bound per client. An item's part follows from the item alone, so what arrives later never
    moves what is stored, and no array holds more than a day.
    """
    return (
        items.withColumn("part", day_part(F.col("event_time")))
        .groupBy("client_id", "bank_id", "insurer_id", "part")
        .agg(F.array_sort(F.collect_list(_item())).alias("items"))
        .select(*S.DOCUMENTS.fieldNames())
    )


def affected_clients(changes: DataFrame) -> DataFrame:
    return changes.select("client_id").distinct()


def rebuild_documents(state: DataFrame, clients: DataFrame) -> DataFrame:
    """Current documents of every given client."""
    return client_documents(state.join(clients.select("client_id"), "client_id", "left_semi"))


def replace_documents(
    documents: DataFrame,
    rebuilt: DataFrame,
    clients: DataFrame,
    co_partition: str | None = None,
) -> DataFrame:
    """Verdicts that replace the documents of the given clients and drop those that no longer exist.

    A client whose item moves to another insurer leaves its former document empty;
    that document is deleted. Documents of other clients are kept as they are.
    """
    on = ["client_id"] if co_partition is None else [co_partition, "client_id"]
    touched = clients.select(*on).withColumn("_touched", F.lit(True))
    tagged = documents.join(touched, on, "left").select(*documents.columns, "_touched")
    source = rebuilt.withColumn("_touched", F.lit(True)).select(*tagged.columns)
    return U.merge(
        tagged,
        source,
        S.DOCUMENT_KEY,
        delete_missing=lambda old: old["_touched"],
        unique_source=True,
        co_partition=co_partition,
    )


def push_items(documents: DataFrame, pushes: DataFrame) -> DataFrame:
    """Append items to client documents, creating a document where there is none.

    Each item goes once to its client's document of the item's day (``part``); documents of keyed state have part 0
    and stay as they are. New documents take bank and insurer from the client's lowest part, else from the
    client's first push. Items of one push are appended in the order of topic, offset and item number. A missing
    event time becomes the current time.
    """
    arrived = F.struct("topic", "offset", "item_no")
    filled = pushes.withColumn("event_time", F.coalesce("event_time", F.current_timestamp()))
    filled = filled.withColumn("part", day_part(F.col("event_time")))
    entry = F.struct("topic", "offset", "item_no", _item().alias("item"))
    # One row per client, or client and part, on every side of the joins below, so none is skewed.
    appended = filled.groupBy("client_id", "part").agg(F.array_sort(F.collect_list(entry)).alias("_new"))
    first = filled.groupBy("client_id").agg(F.min_by(F.struct("bank_id", "insurer_id"), arrived).alias("_first"))
    known = documents.groupBy("client_id").agg(F.min_by(F.struct("bank_id", "insurer_id"), "part").alias("_known"))
    heads = first.join(known, "client_id", "left").select("client_id", F.coalesce("_known", "_first").alias("_head"))
    placed = appended.join(heads, "client_id")
    old = documents.select("client_id", "part", F.struct(*documents.columns).alias("_old"))
    both = old.join(placed, ["client_id", "part"], "full_outer")
    empty = F.array().cast(S.DOCUMENTS["items"].dataType)
    return both.select(
        "client_id",
        F.coalesce("_old.bank_id", "_head.bank_id").alias("bank_id"),
        F.coalesce("_old.insurer_id", "_head.insurer_id").alias("insurer_id"),
        "part",
        F.concat(F.coalesce("_old.items", empty), F.coalesce(F.col("_new.item"), empty)).alias("items"),
    )


def exploded_report(documents: DataFrame) -> DataFrame:
    """One row per document item for display; the scope list becomes text."""
    return documents.select(
        "client_id", "bank_id", "insurer_id", F.explode("items").alias("item")
    ).select(
        "client_id",
        "bank_id",
        "insurer_id",
        F.col("item.consent_type").alias("consent_type"),
        F.array_join("item.scope", ", ").alias("scope"),
        F.col("item.status").alias("status"),
        F.col("item.event_time").alias("event_time"),
    )
