"""The named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Results are flat for comparison: arrays as text, instants without zone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake import schemas as S
from eventlake.operators import documents as D
from eventlake.operators import enrich as E
from eventlake.operators import events as V
from eventlake.operators import governance as G
from eventlake.operators import metrics as M
from eventlake.operators import quality as Q
from eventlake.operators import serving as R
from eventlake.operators import upsert as U
from eventlake.plans import tables as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-02-10 00:00:00"
LOOKUP_CLIENT = "cli-00007"
ANALYST = "analyst-01"
OPEN_BANKS = ("bank-002",)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def flat(rows: DataFrame) -> DataFrame:
    out = []
    for field in rows.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            column = F.array_join(column, ",")
        elif isinstance(field.dataType, T.BinaryType):
            column = column.cast("string")
        out.append(column.alias(field.name))
    return rows.select(*out)


def flat_documents(documents: DataFrame) -> DataFrame:
    """Documents with their items as one text ``type=status@time``, in array order."""
    text = F.transform(
        "items",
        lambda i: F.concat(
            i["consent_type"],
            F.lit("="),
            i["status"],
            F.lit("@"),
            F.date_format(i["event_time"], "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        ),
    )
    return documents.select(
        "client_id",
        "bank_id",
        "insurer_id",
        "part",
        F.size("items").cast("long").alias("n_items"),
        F.array_join(text, ";").alias("items"),
    )


# -- intake ---------------------------------------------------------------------


@query
def raw_events(spark, sf):
    return flat(V.raw_events(X.event_log(spark, sf)))


@query
def parse_events(spark, sf):
    parsed = V.parse_events(V.raw_events(X.event_log(spark, sf)))
    e = F.col("event")
    return flat(
        parsed.select(
            "partition",
            "offset",
            e["client_id"].alias("client_id"),
            e["bank_id"].alias("bank_id"),
            e["insurer_id"].alias("insurer_id"),
            e["event_time"].alias("event_time"),
            F.coalesce(F.size(e["items"]), F.lit(-1)).cast("long").alias("n_items"),
        )
    ).withColumn("n_items", F.when(F.col("n_items") >= 0, F.col("n_items")))


@query
def valid_events(spark, sf):
    e = F.col("event")
    valid = V.valid_events(X.classified(spark, sf))
    return flat(
        valid.select(
            "partition",
            "offset",
            e["client_id"].alias("client_id"),
            e["event_time"].alias("event_time"),
            F.size(e["items"]).cast("long").alias("n_items"),
        )
    )


def _quarantine(spark, sf) -> DataFrame:
    rejected = V.quarantined_events(X.classified(spark, sf))
    return rejected.withColumn("_batch_id", F.lit(0).cast("long"))


@query
def quarantine_rows(spark, sf):
    return flat(_quarantine(spark, sf))


@query
def quarantine_docs(spark, sf):
    return flat(R.quarantine_documents(_quarantine(spark, sf)))


@query
def split_counts(spark, sf):
    side = F.when(F.col("reasons_text") == "", "valid").otherwise("quarantine")
    return X.classified(spark, sf).groupBy(side.alias("side")).agg(F.count("*").alias("events"))


@query
def contract_violations(spark, sf):
    broken = X.classified(spark, sf, X.FULL_CONTRACT).filter(F.col("reasons_text") != "")
    return broken.select("partition", "offset", F.explode(F.split("reasons_text", ",")).alias("reason"))


@query
def contract_reasons(spark, sf):
    """Every rule of the publishing contract broken by one event in thirteen."""
    raw = V.raw_events(X.log_with_every_fault(X.read(spark, sf, "events")))
    broken = V.classify(raw, contract=X.FULL_CONTRACT).filter(F.col("reasons_text") != "")
    return broken.select("offset", F.explode(F.split("reasons_text", ",")).alias("reason"))


@query
def explode_items(spark, sf):
    return flat(X.items(spark, sf))


@query
def publish_encode(spark, sf):
    parsed = V.parse_events(V.raw_events(X.event_log(spark, sf)))
    return flat(V.publish_encode(parsed, X.FULL_CONTRACT))


@query
def publish_stats(spark, sf):
    parsed = V.parse_events(V.raw_events(X.event_log(spark, sf)))
    return parsed.agg(*V.publish_counters(parsed, X.FULL_CONTRACT))


@query
def topic_pattern(spark, sf):
    log = X.event_log(spark, sf).filter(F.col("topic").rlike("^consents-bank-00[1-3]$"))
    return log.groupBy("topic", "partition").agg(
        F.count("*").alias("events"), F.min("offset").alias("first"), F.max("offset").alias("last")
    )


# -- keyed state ------------------------------------------------------------------


@query
def enrich_left(spark, sf):
    return flat(E.enrich(X.items(spark, sf), X.client_master(spark, sf)))


@query
def master_newest(spark, sf):
    """A master table that was ingested twice, with other names the second time."""
    master = X.client_master(spark, sf)
    first = master.withColumn("_ingested_at", F.lit("2024-01-01").cast("timestamp"))
    again = first.filter(F.col("bank_id") == "bank-003").select(
        "client_id",
        F.concat("client_name", F.lit(" (renamed)")).alias("client_name"),
        "tax_id",
        "bank_id",
        F.lit("2024-01-02").cast("timestamp").alias("_ingested_at"),
    )
    return flat(E.newest_master(first.unionByName(again)).drop("_ingested_at"))


@query
def latest_per_key(spark, sf):
    return flat(U.newest_items(X.items(spark, sf)))


@query
def merge_upsert(spark, sf):
    _, verdicts = X.merged_feeds(spark, sf)
    return flat(U.merged_state(verdicts))


@query
def change_feed(spark, sf):
    _, verdicts = X.merged_feeds(spark, sf)
    return flat(U.change_rows(verdicts, version=2))  # the standing state is version 1


@query
def merge_decision(spark, sf):
    standing, arriving = X.two_feeds(spark, sf)
    # Times cut to the hour, so that many are equal and the place in the log decides.
    text = F.date_format("event_time", "yyyy-MM-dd'T'HH:00:00").alias("time_text")
    place = ("topic", "offset")
    before = U.newest_items(standing).select(*S.STATE_KEY, *place, text)
    batch = U.newest_items(arriving).select(*S.STATE_KEY, *place, text)
    return U.merge_decisions(before, batch, S.STATE_KEY, "time_text", place)


@query
def merge_conditional(spark, sf):
    """Only a revocation changes a known row, and only its status and time."""
    standing, arriving = X.two_feeds(spark, sf)
    verdicts = U.merge(
        U.newest_items(standing),
        U.newest_items(arriving),
        S.STATE_KEY,
        guard=lambda s, t: (s["status"] == "revoked") & (s["event_time"] > t["event_time"]),
        update_set={"status": lambda s, t: s["status"], "event_time": lambda s, t: s["event_time"]},
        insert=False,
        unique_source=True,
        keys_not_null=True,
    )
    return flat(U.merged_state(verdicts))


@query
def merge_soft_delete(spark, sf):
    """Clients of the master without any event are kept and marked inactive."""
    master = X.client_master(spark, sf).withColumn("status", F.lit("active"))
    seen = X.read(spark, sf, "events").select(F.format_string("cli-%05d", "user_id").alias("client_id")).distinct()
    snapshot = master.join(seen, "client_id", "left_semi")
    verdicts = U.merge(
        master,
        snapshot,
        ["client_id"],
        when_missing_set={"status": F.lit("inactive")},
        unique_source=True,
        keys_not_null=True,
    )
    return U.merged_state(verdicts)


# -- metrics ------------------------------------------------------------------------


def _metrics(spark, sf) -> DataFrame:
    return M.daily_metrics(X.state(spark, sf))


@query
def daily_metrics(spark, sf):
    return _metrics(spark, sf)


@query
def metrics_mirror(spark, sf):
    return M.mirror(_metrics(spark, sf))


@query
def affected_recompute(spark, sf):
    _, verdicts = X.merged_feeds(spark, sf)
    verdicts = X.stored(verdicts, "affected")
    return M.recompute_affected(U.merged_state(verdicts), U.change_rows(verdicts))


@query
def metrics_merge(spark, sf):
    before, verdicts = X.merged_feeds(spark, sf)
    verdicts = X.stored(verdicts, "metrics-merge")
    changes = U.change_rows(verdicts)
    recomputed = M.recompute_affected(U.merged_state(verdicts), changes)
    replaced = M.replace_affected(M.daily_metrics(before), recomputed, M.affected_dates(changes))
    return U.merged_state(replaced).drop("_touched")


@query
def metrics_delta(spark, sf):
    before, verdicts = X.merged_feeds(spark, sf)
    deltas = M.metric_deltas(U.change_rows(verdicts))
    return U.merged_state(M.apply_deltas(M.daily_metrics(before), deltas))


@query
def metrics_totals(spark, sf):
    state = X.stored(X.state(spark, sf), "state")
    exact = state.agg(F.countDistinct("client_id").alias("clients_exact"))
    return M.totals(M.daily_metrics(state)).withColumn("clients_exact", exact.scalar())


@query
def events_per_day(spark, sf):
    return M.events_by(_metrics(spark, sf), "ref_date")


@query
def events_per_type(spark, sf):
    return M.events_by(_metrics(spark, sf), "consent_type")


@query
def events_per_bank(spark, sf):
    return M.events_by(_metrics(spark, sf), "bank_id")


@query
def metrics_latest(spark, sf):
    return M.latest_metrics(_metrics(spark, sf))


@query
def active_per_day(spark, sf):
    return M.active_per_day(X.state(spark, sf), "active")


@query
def window_counts(spark, sf):
    return flat(M.window_counts(X.items(spark, sf), "event_time", "5 minutes", "bank_id"))


@query
def usage_rollup(spark, sf):
    return M.usage_rollup(X.read(spark, sf, "events"), "event_type", F.col("value").cast("decimal(18,2)"))


@query
def p95_by_type(spark, sf):
    return M.percentile_by(X.read(spark, sf, "events"), "event_type", "value", 0.95)


@query
def volume_anomaly(spark, sf):
    orders = X.read(spark, sf, "orders")
    found = M.volume_anomalies(orders, "o_orderpriority", "o_orderdate")
    return found.withColumn("moving_average", F.round("moving_average", 6))


# -- documents and service reads ------------------------------------------------------


@query
def client_documents(spark, sf):
    return flat_documents(D.client_documents(X.state(spark, sf)))


@query
def client_documents_by_client(spark, sf):
    return flat_documents(D.client_documents(X.state(spark, sf), by_client=True))


@query
def item_history_documents(spark, sf):
    return flat_documents(D.documents_from_items(X.stored(X.items(spark, sf), "items")))


@query
def document_upsert(spark, sf):
    before, verdicts = X.merged_feeds(spark, sf)
    verdicts = X.stored(verdicts, "documents")
    changes = U.change_rows(verdicts)
    rebuilt = D.rebuild_documents(U.merged_state(verdicts), D.affected_clients(changes))
    replaced = D.replace_documents(D.client_documents(before), rebuilt, D.affected_clients(changes))
    return flat_documents(U.merged_state(replaced).drop("_touched"))


@query
def document_push(spark, sf):
    standing, arriving = X.two_feeds(spark, sf)
    before = D.client_documents(U.newest_items(standing), by_client=True)
    # Pushes are grouped and headed: two uses, so they are stored once.
    return flat_documents(D.push_items(before, X.stored(arriving, "pushes")))


@query
def document_push_twice(spark, sf):
    """Two pushes one after the other, the second onto the documents of the first."""
    standing, arriving = X.two_feeds(spark, sf)
    arriving = X.stored(arriving, "pushes")
    documents = D.client_documents(U.newest_items(standing), by_client=True)
    first = X.stored(D.push_items(documents, arriving.filter("insurer_id = 'ins-002'")), "first-push")
    return flat_documents(D.push_items(first, arriving.filter("insurer_id <> 'ins-002'")))


@query
def exploded_report(spark, sf):
    return flat(D.exploded_report(D.client_documents(X.state(spark, sf))))


@query
def client_lookup(spark, sf):
    return flat_documents(R.client_lookup(D.client_documents(X.state(spark, sf)), LOOKUP_CLIENT))


@query
def client_lookup_first(spark, sf):
    found = R.client_lookup(D.client_documents(X.state(spark, sf)), LOOKUP_CLIENT, first_only=True)
    return flat_documents(found)


@query
def service_status(spark, sf):
    return R.service_status(D.client_documents(X.state(spark, sf)))


@query
def quarantine_latest(spark, sf):
    return flat(R.quarantine_latest(_quarantine(spark, sf)))


@query
def quarantine_total(spark, sf):
    return R.quarantine_total(_quarantine(spark, sf))


@query
def quarantine_depth(spark, sf):
    return Q.quarantine_depth(_quarantine(spark, sf))


@query
def lookup_array(spark, sf):
    nation = X.read(spark, sf, "nation")
    looked_up = E.lookup_array(X.read(spark, sf, "customer"), nation, "c_nationkey", "n_nationkey", "nation")
    return looked_up.select(
        "c_custkey",
        F.size("nation").cast("long").alias("matches"),
        F.array_join(F.col("nation.n_name"), ",").alias("nation"),
    )


# -- governance -----------------------------------------------------------------------


def _memberships(spark, sf) -> DataFrame:
    """One engineer per region, one analyst per nation."""
    region = X.read(spark, sf, "region").select(
        F.format_string("engineer-%02d", "r_regionkey").alias("member"),
        F.lit(G.PRIVILEGED_GROUP).alias("grp"),
    )
    nation = X.read(spark, sf, "nation").select(
        F.format_string("analyst-%02d", "n_nationkey").alias("member"), F.lit("analysts").alias("grp")
    )
    return region.unionByName(nation)


def _entitlements(spark, sf) -> DataFrame:
    nation = X.read(spark, sf, "nation")
    insurer = F.concat(F.lit("ins-00"), (1 + F.col("n_nationkey") % 4).cast("string"))
    return nation.select(F.format_string("analyst-%02d", "n_nationkey").alias("member"), insurer.alias("insurer_id"))


def _nested_memberships(spark, sf) -> DataFrame:
    """Customers in the group of their nation, nations in regions, each region in the one before it: a circle of regions."""
    customer, nation, region = (X.read(spark, sf, name) for name in ("customer", "nation", "region"))

    def named(name: str, key: Column) -> Column:
        return F.concat(F.lit(name), key.cast("string"))

    parts = (
        customer.select(named("customer-", F.col("c_custkey")), named("nation-", F.col("c_nationkey"))),
        nation.select(named("nation-", F.col("n_nationkey")), named("region-", F.col("n_regionkey"))),
        region.filter("r_regionkey > 0").select(
            named("region-", F.col("r_regionkey")), named("region-", F.col("r_regionkey") - 1)
        ),
        region.filter("r_regionkey = 1").select(F.lit("region-0"), F.lit("region-1")),
    )
    return reduce(DataFrame.union, parts).toDF("member", "grp")


@query
def nested_memberships(spark, sf):
    return G.all_memberships(_nested_memberships(spark, sf), lambda rows: X.stored(rows, "memberships"))


@query
def row_filtered_nested(spark, sf):
    """Orders of customers that are, through their nation, in a region's group."""
    members = G.all_memberships(_nested_memberships(spark, sf), lambda rows: X.stored(rows, "memberships"))
    inside = members.filter(F.col("grp") == "region-2").select("member")
    orders = X.read(spark, sf, "orders").withColumn("member", F.concat(F.lit("customer-"), F.col("o_custkey").cast("string")))
    return orders.join(inside, "member", "left_semi").select("o_orderkey", "member")


@query
def masked_view(spark, sf):
    privileged = G.is_member(_memberships(spark, sf), ANALYST, G.PRIVILEGED_GROUP)
    return flat(G.masked_view(X.state(spark, sf), privileged))


@query
def masked_view_privileged(spark, sf):
    privileged = G.is_member(_memberships(spark, sf), "engineer-01", G.PRIVILEGED_GROUP)
    return flat(G.masked_view(X.state(spark, sf), privileged))


@query
def masked_by_context(spark, sf):
    privileged = G.is_member(_memberships(spark, sf), ANALYST, G.PRIVILEGED_GROUP)
    return flat(G.masked_by_context(X.state(spark, sf), privileged, OPEN_BANKS))


@query
def row_filtered_view(spark, sf):
    privileged = G.is_member(_memberships(spark, sf), ANALYST, G.PRIVILEGED_GROUP)
    insurers = G.entitled_insurers(_entitlements(spark, sf), ANALYST)
    return flat(G.row_filtered_view(X.state(spark, sf), privileged, insurers))


@query
def row_filtered_composite(spark, sf):
    privileged = G.is_member(_memberships(spark, sf), ANALYST, G.PRIVILEGED_GROUP)
    insurers = G.entitled_insurers(_entitlements(spark, sf), ANALYST)
    visible = F.col("status") != "revoked"
    return flat(G.row_filtered_view(X.state(spark, sf), privileged, insurers, also=visible))


@query
def secured_view(spark, sf):
    return flat(G.secured_view(X.state(spark, sf), _memberships(spark, sf), _entitlements(spark, sf), ANALYST))


@query
def column_excluded_view(spark, sf):
    return flat(G.without_columns(X.state(spark, sf), "tax_id"))


# -- quality --------------------------------------------------------------------------


@query
def constraint_violations(spark, sf):
    checks = {
        "status_known": F.col("status").isin("active", "revoked"),
        "has_master": F.col("tax_id").isNotNull(),
        "not_revoked": F.col("status") != "revoked",
    }
    return Q.constraint_violations(X.state(spark, sf), checks)


@query
def expectations_report(spark, sf):
    return Q.expectations_report(
        X.stored(X.state(spark, sf), "state"),
        not_null=["client_id", "event_time", "client_name"],
        unique=[S.STATE_KEY, ("client_id",)],
        references=[("client_id", X.client_master(spark, sf), "client_id")],
    )


@query
def env_diff(spark, sf):
    """The state of all events against the state of one insurer's events."""
    standing, _ = X.two_feeds(spark, sf)
    return flat(Q.differences(U.newest_items(X.items(spark, sf)), U.newest_items(standing)))


@query
def canary_split(spark, sf):
    return Q.canary_split(X.read(spark, sf, "events").select("event_id", "user_id"), "user_id")


@query
def freshness(spark, sf):
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    return flat(Q.freshness(X.read(spark, sf, "events"), "event_type", "ts", as_of, 2))


@query
def ttl_retained(spark, sf):
    as_of = F.lit(AS_OF).cast("timestamp")
    return flat(Q.retained(_quarantine(spark, sf), "kafka_timestamp", as_of, 30))
