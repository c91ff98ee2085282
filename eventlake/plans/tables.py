"""Event log and master data derived from the given tables, for queries and tests.

Every row of ``events`` becomes one broker row. Fixed residues of the event id
decide which texts are damaged and how, so the expected outcome of each row can
be told from the table alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.functions.contract import Contract
from eventlake.operators import enrich as E
from eventlake.operators import events as V
from eventlake.operators import upsert as U
from eventlake.session import new_scratch, pin_utc

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
ITEM_TYPES = EVENT_TYPES + tuple(f"{name}_detail" for name in EVENT_TYPES)
FULL_CONTRACT = Contract(types=ITEM_TYPES, statuses=("active", "revoked"), strict=True)
STANDING_INSURER = "ins-001"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def log_from_events(events: DataFrame) -> DataFrame:
    """Broker rows with JSON values; works on a batch and on a streaming ``events``."""
    n, user = F.col("event_id"), F.col("user_id")

    def item(kind, scope):
        status = F.when(n % 10 == 0, "revoked").otherwise("active")
        return F.struct(kind.alias("type"), scope.alias("scope"), status.alias("status"))

    personal = F.col("event_type").isin("signup", "purchase")
    scope = F.when(personal, F.array(F.lit("name"), F.lit("tax_id"))).otherwise(F.array(F.lit("income")))
    first = item(F.col("event_type"), scope)
    second = item(F.concat("event_type", F.lit("_detail")), F.array(F.lit("score")))
    items = (
        F.when(n % 83 == 0, F.lit(None))
        .when(n % 89 == 0, F.slice(F.array(first), 1, 0))
        .when(n % 4 == 0, F.array(first, second))
        .otherwise(F.array(first))
    )
    client = F.format_string("cli-%05d", user)
    bank = F.concat(F.lit("bank-00"), (1 + user % 5).cast("string"))
    insurer = F.concat(F.lit("ins-00"), (1 + n % 3).cast("string"))
    time = F.when(n % 79 == 0, "not-a-time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    json = F.to_json(
        F.struct(
            client.alias("client_id"),
            bank.alias("bank_id"),
            insurer.alias("insurer_id"),
            time.alias("event_time"),
            items.alias("items"),
        )
    )
    text = F.when(n % 97 == 0, F.left(json, F.length(json) - 7)).otherwise(json)
    return events.select(
        client.cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.concat(F.lit("consents-"), bank).alias("topic"),
        (user % 3).cast("int").alias("partition"),
        n.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def log_with_every_fault(events: DataFrame) -> DataFrame:
    """Broker rows of which each breaks the rule that ``event_id`` modulo 13 names; 12 breaks none."""
    n, none = F.col("event_id") % 13, F.lit(None).cast("string")

    def broken(residue: int, instead: Column, value: Column) -> Column:
        return F.when(n == residue, instead).otherwise(value)

    half_time = F.when(F.col("event_id") % 2 == 0, F.lit("12:30")).otherwise(F.lit("2026"))
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    item = F.struct(
        broken(6, none, broken(10, F.lit("unheard-of"), F.col("event_type"))).alias("type"),
        broken(9, F.array().cast("array<string>"), F.array(F.lit("income"))).alias("scope"),
        broken(11, F.lit("asleep"), F.lit("active")).alias("status"),
    )
    json = F.to_json(
        F.struct(
            broken(2, none, F.format_string("cli-%05d", "user_id")).alias("client_id"),
            broken(7, F.lit(""), F.lit("bank-001")).alias("bank_id"),
            broken(8, none, F.lit("ins-001")).alias("insurer_id"),
            broken(3, none, broken(4, half_time, time)).alias("event_time"),
            F.when(n != 5, F.array(item)).alias("items"),
        )
    )
    cut = F.left(json, F.length(json) - 7)
    nested = F.replace(json, F.lit('"scope":["income"]'), F.lit('"scope":"income"'))
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        broken(0, cut, broken(1, nested, json)).cast("binary").alias("value"),
        F.lit("faults").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_from_events(read(spark, sf_dir, "events"))


def classified(spark: SparkSession, sf_dir: str, contract: Contract | None = None) -> DataFrame:
    raw = V.raw_events(event_log(spark, sf_dir))
    return V.classify(raw) if contract is None else V.classify(raw, contract=contract)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.explode_items(V.valid_events(classified(spark, sf_dir)))


def client_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer; each tenth is an organisation, whose id no event carries."""
    k = F.col("c_custkey")
    organisation, person = F.format_string("org-%05d", k), F.format_string("cli-%05d", k)
    tax_id = F.format_string(
        "%03d.%03d.%03d-%02d",
        F.floor(k / 1_000_000) % 1000,
        F.floor(k / 1000) % 1000,
        k % 1000,
        k % 97,
    )
    return read(spark, sf_dir, "customer").select(
        F.when(k % 10 == 0, organisation).otherwise(person).alias("client_id"),
        F.col("c_name").alias("client_name"),
        tax_id.alias("tax_id"),
        F.concat(F.lit("bank-00"), (1 + F.col("c_nationkey") % 5).cast("string")).alias("bank_id"),
    )


def state_of(item_rows: DataFrame, master: DataFrame) -> DataFrame:
    """Newest item per key, then enriched: the join sees one row per key, so no hot client."""
    return E.enrich(U.newest_items(item_rows), master).select(*S.STATE.fieldNames())


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_of(items(spark, sf_dir), client_master(spark, sf_dir))


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: a cut for results used several times."""
    path = new_scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def two_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The items of one insurer as the standing state, those of the others as the arriving batch.

    The feeds interleave in time, so arriving rows are partly newer and partly late.
    """
    return parted(items(spark, sf_dir))


def parted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    standing = F.col("insurer_id") == STANDING_INSURER
    return rows.filter(standing), rows.filter(~standing)


def merged_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(standing state, verdicts)`` of merging the arriving batch into the standing state."""
    # Both feeds come from the same items and ``before`` is read with the verdicts: each is evaluated once.
    standing, arriving = parted(stored(items(spark, sf_dir), "items"))
    master = client_master(spark, sf_dir)
    before = stored(state_of(standing, master), "before")
    verdicts = U.merge(
        before,
        state_of(arriving, master),
        S.STATE_KEY,
        guard=U.newer(*U.STATE_ORDER),
        unique_source=True,
        keys_not_null=True,
    )
    return before, verdicts
