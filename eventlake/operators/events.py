"""From broker rows to flat items: project, parse, split, explode, encode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.functions.contract import INTAKE, Contract, reason_text, whole_time

_CORRUPT = "_corrupt"


def raw_events(log: DataFrame) -> DataFrame:
    """Broker columns to the raw event row.

    Topic and partition are kept: an offset names an event only within these.
    """
    return log.select(
        F.col("value").cast("string").alias("raw_json"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    )


def _parsed(raw_json: Column, wire: S.Wire) -> Column:
    schema = wire.event_schema.add(_CORRUPT, "string")
    return F.from_json(raw_json, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def parse_events(raw: DataFrame, wire: S.Wire = S.ENGLISH) -> DataFrame:
    """Add ``event``, a struct with our own field names, to the raw rows.

    The parse result is produced by a one-row generator. Filters on parsed fields
    are not pushed through a generator, so each text is parsed once per row and
    not once more inside every filter that looks at it.
    """
    parsed = raw.select("*", F.explode(F.array(_parsed(F.col("raw_json"), wire))).alias("_p"))
    p = F.col("_p")
    corrupt = p[_CORRUPT].isNotNull()
    found_nothing = F.coalesce(
        *[p[name] for name in (wire.client_id, wire.bank_id, wire.insurer_id, wire.event_time)]
    ).isNull()
    event = F.struct(
        p[wire.client_id].alias("client_id"),
        p[wire.bank_id].alias("bank_id"),
        p[wire.insurer_id].alias("insurer_id"),
        p[wire.event_time].alias("time_text"),
        F.when(whole_time(p[wire.event_time]), p[wire.event_time].try_cast("timestamp")).alias("event_time"),
        p[wire.items].cast(f"array<{S.ITEM.simpleString()}>").alias("items"),
        (p.isNull() | (corrupt & found_nothing)).alias("unreadable"),
        (corrupt & ~found_nothing).alias("wrong_shape"),
    )
    return parsed.select(*raw.columns, event.alias("event"))


def classify(raw: DataFrame, wire: S.Wire = S.ENGLISH, contract: Contract = INTAKE) -> DataFrame:
    """Parsed rows with ``reasons_text``; empty text means valid."""
    parsed = parse_events(raw, wire)
    return parsed.select("*", reason_text(F.col("event"), contract).alias("reasons_text"))


def valid_events(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reasons_text") == "").drop("reasons_text")


def quarantined_events(classified: DataFrame) -> DataFrame:
    """Raw rows with the array of reasons, for storage beside the valid ones."""
    return classified.filter(F.col("reasons_text") != "").select(
        "raw_json",
        "topic",
        "partition",
        "offset",
        "kafka_timestamp",
        F.split("reasons_text", ",").alias("reasons"),
    )


def explode_items(valid: DataFrame) -> DataFrame:
    """One row per item. ``item_no`` orders items of one event among themselves."""
    e = F.col("event")
    rows = valid.select(
        e["client_id"].alias("client_id"),
        e["bank_id"].alias("bank_id"),
        e["insurer_id"].alias("insurer_id"),
        e["event_time"].alias("event_time"),
        "topic",
        "offset",
        F.posexplode(e["items"]).alias("item_no", "item"),
    )
    return rows.select(
        "client_id",
        "bank_id",
        "insurer_id",
        "event_time",
        "topic",
        "offset",
        "item_no",
        F.col("item.consent_type").alias("consent_type"),
        F.col("item.scope").alias("scope"),
        F.col("item.status").alias("status"),
    )


def event_json(event: Column, wire: S.Wire = S.ENGLISH) -> Column:
    """The JSON text of an event struct, with the field names of ``wire``."""
    return F.to_json(
        F.struct(
            event["client_id"].alias(wire.client_id),
            event["bank_id"].alias(wire.bank_id),
            event["insurer_id"].alias(wire.insurer_id),
            event["time_text"].alias(wire.event_time),
            event["items"].cast(f"array<{wire.item_schema.simpleString()}>").alias(wire.items),
        )
    )


def publish_encode(events: DataFrame, contract: Contract, wire: S.Wire = S.ENGLISH) -> DataFrame:
    """Rows for a broker or file sink: client id as key, JSON as value, valid events only."""
    e = F.col("event")
    return events.filter(reason_text(e, contract) == "").select(
        e["client_id"].cast("binary").alias("key"),
        event_json(e, wire).cast("binary").alias("value"),
    )


def publish_counters(events: DataFrame, contract: Contract) -> list[Column]:
    """Aggregates for ``df.observe`` or ``df.agg``: how many events pass and how many do not."""
    ok = reason_text(F.col("event"), contract) == ""
    return [F.count_if(ok).alias("published"), F.count_if(~ok).alias("rejected")]
