"""The drain-and-stop jobs: master files, events, metrics, documents.

Each job processes what is available and stops. Streams that read files or a
broker keep a checkpoint of their own below the environment's root. Jobs that
feed one table from another keep their progress in the target's own commits, so
data and progress cannot drift apart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake import schemas as S
from eventlake.functions.contract import INTAKE, Contract
from eventlake.operators import documents as D
from eventlake.operators import enrich as E
from eventlake.operators import events as V
from eventlake.operators import metrics as M
from eventlake.operators import serving as R
from eventlake.operators import upsert as U
from eventlake.session import pin_utc
from eventlake.sources import files as CSV
from eventlake.sources.day_log import DayLog
from eventlake.sources.document_sink import DocumentClient, remove_documents, write_documents
from eventlake.sources.versioned import SLICE, Files, VersionedTable, checkpoint_id
from eventlake.streaming.batches import WHOLE, drain, isolating

Connect = Callable[[], DocumentClient]

#: What names one event of the log.
EVENT_KEY = ("topic", "partition", "offset")

CLIENTS = T.StructType(S.CLIENT_MASTER.fields + S.row(_file_modified=S.TIME, _source_file=S.STRING).fields)


@dataclass(frozen=True)
class Lake:
    """Where an environment keeps its tables and checkpoints."""

    root: str
    env: str = "dev"
    buckets: int = 16
    ops: str = "ops"

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), self.env, *parts])

    @property
    def landing(self) -> str:
        return self._at("landing")

    @property
    def quarantine(self) -> str:
        return self._at("silver", "quarantine")

    def quarantine_batch(self, source: str, batch_id: int) -> str:
        return f"{self.quarantine}/source={source.replace(':', '-')}/_batch_id={batch_id}"

    def bronze(self, name: str) -> str:
        return self._at("bronze", name)

    def checkpoint(self, stream: str) -> str:
        return self._at(self.ops, "checkpoints", stream)

    def state(self, spark: SparkSession) -> VersionedTable:
        """Bucketed by client, so lookups and document rebuilds read single buckets."""
        return VersionedTable.create(
            spark, self._at("silver", "state"), S.STATE, S.STATE_KEY, ["client_id"], self.buckets
        )

    def clients(self, spark: SparkSession) -> VersionedTable:
        """Newest master row per client, in the same buckets as the state."""
        return VersionedTable.create(
            spark, self._at("silver", "clients"), CLIENTS, ["client_id"], ["client_id"], self.buckets
        )

    def metrics(self, spark: SparkSession) -> VersionedTable:
        """Bucketed by day, so a report of one day reads one bucket and a recomputed day rewrites one."""
        return VersionedTable.create(
            spark, self._at("gold", "daily_metrics"), S.METRICS, S.METRIC_KEY, ["ref_date"], self.buckets
        )

    def days(self, spark: SparkSession) -> DayLog:
        """What metrics need of the state, laid out by day."""
        columns = ("client_id", "bank_id", "insurer_id", "consent_type")
        return DayLog(self.state(spark), self._at("gold", "state_by_day"), columns, "event_time")

    def references(self, spark: SparkSession, dimensions: Sequence[str]) -> VersionedTable:
        """Number of state rows per group and client; bucketed by client, so a hot group is in all buckets."""
        schema = T.StructType([*_dimensions(dimensions), S.STATE["client_id"], *S.row(held=S.LONG).fields])
        path = self._at("gold", "clients_by_" + "_".join(dimensions), "references")
        return VersionedTable.create(spark, path, schema, [*dimensions, "client_id"], ["client_id"], self.buckets)

    def distinct_clients(self, spark: SparkSession, dimensions: Sequence[str]) -> VersionedTable:
        schema = T.StructType([*_dimensions(dimensions), S.METRICS["total_events"], S.METRICS["total_clients"]])
        path = self._at("gold", "clients_by_" + "_".join(dimensions), "counts")
        return VersionedTable.create(spark, path, schema, dimensions, dimensions, self.buckets)

    def documents(self, spark: SparkSession) -> VersionedTable:
        return VersionedTable.create(
            spark, self._at("gold", "documents"), S.DOCUMENTS, S.DOCUMENT_KEY, ["client_id"], self.buckets
        )


def _dimensions(names: Sequence[str]) -> list[T.StructField]:
    """Columns of the metrics or else of the state."""
    return [S.METRICS[n] if n in S.METRICS.names else S.STATE[n] for n in names]


# -- bronze ----------------------------------------------------------------------


def ingest_master(spark: SparkSession, lake: Lake, sources: Sequence[CSV.DropSource] = CSV.DROP_SOURCES) -> None:
    """One stream per kind of file, each with its own table and checkpoint.

    New client rows also go into the keyed client table, so that no later job has to
    deduplicate the whole history.
    """
    lake.clients(spark)
    Files(spark, lake.root).make_folder(lake.landing)
    for source in sources:
        checkpoint = lake.checkpoint(f"bronze-{source.name}")
        CSV.ingest(
            spark,
            source,
            lake.landing,
            lake.bronze(source.name),
            checkpoint,
            then=_upsert_clients(lake, checkpoint) if source.name == "client_master" else None,
        )


def _upsert_clients(lake: Lake, checkpoint: str) -> Callable[[DataFrame, int], None]:
    def upsert(rows: DataFrame, batch_id: int) -> None:
        session = rows.sparkSession
        known = rows.filter(F.col("client_id").isNotNull()).select(*CLIENTS.fieldNames())
        lake.clients(session).merge(
            E.newest_master(known),
            stream=f"bronze:{checkpoint_id(session, checkpoint)}",
            batch_id=batch_id,
            guard=U.newer("_file_modified", "_source_file"),
            unique_source=True,
            keys_not_null=True,
        )

    return upsert


# -- silver ----------------------------------------------------------------------


def drain_events(
    spark: SparkSession,
    lake: Lake,
    log: DataFrame,
    wire: S.Wire = S.ENGLISH,
    contract: Contract = INTAKE,
    master: Callable[[SparkSession], DataFrame] | None = None,
    coalesce_enrichment: bool = False,
    mirror: Connect | None = None,
    stream: str = "events",
    dead_letters: str | None = None,
) -> None:
    """Split the log into quarantine and keyed state.

    With a folder for ``dead_letters``, events that make a batch fail are set aside there and the others go on.

    One stream serves both outputs: a batch is parsed once, kept in memory or on
    executor disk, and written twice. The batch is reduced to one row per key
    before it meets the master data.
    """
    lake.state(spark)
    checkpoint = lake.checkpoint(f"silver-{stream}")
    kept = ("client_name", "tax_id") if coalesce_enrichment else ()

    def on_part(batch: DataFrame, batch_id: int, part: str = WHOLE) -> None:
        session = pin_utc(batch.sparkSession)
        state = lake.state(session)
        # A new checkpoint counts batches from zero again: its id is part of the name.
        source = f"{stream}:{checkpoint_id(session, checkpoint)}" + ("" if part == WHOLE else f":{part}")
        judged = halved(V.classify(V.raw_events(batch), wire, contract)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_quarantine(V.quarantined_events(judged), lake, source, batch_id, mirror)
            newest = U.newest_items(V.explode_items(V.valid_events(judged)))
            newest = newest.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                # Only the buckets of the batch are read, each table's by its own count.
                touched = state.buckets_of_keys(newest)
                names = master(session) if master else _names(lake.clients(session), newest)
                state.merge(
                    E.enrich(newest, names).select(*S.STATE.fieldNames()),
                    stream=source,
                    batch_id=batch_id,
                    touched=touched,
                    guard=U.newer(*U.STATE_ORDER),
                    prefer_known=kept,
                    unique_source=True,
                    keys_not_null=True,  # the contract asks for client and type
                )
            finally:
                newest.unpersist()
        finally:
            judged.unpersist()

    drain(log, isolating(on_part, dead_letters, checkpoint, EVENT_KEY) if dead_letters else on_part, checkpoint)


def _names(clients: VersionedTable, newest: DataFrame) -> DataFrame:
    return clients.read(only=clients.buckets_of_keys(newest))


def halved(judged: DataFrame) -> DataFrame:
    """Keep of each row what its output needs: the text if rejected, the parsed event if valid."""
    rejected = F.col("reasons_text") != ""
    return judged.withColumns(
        {"raw_json": F.when(rejected, F.col("raw_json")), "event": F.when(~rejected, F.col("event"))}
    )


def write_quarantine(
    rejected: DataFrame, lake: Lake, source: str, batch_id: int, mirror: Connect | None = None
) -> None:
    """Rejected events in a folder per batch, replaced as a whole when the batch is replayed.

    ``source`` names the stream and its checkpoint: batches of another checkpoint replace nothing.
    """
    if rejected.isEmpty():
        return
    path = lake.quarantine_batch(source, batch_id)
    rejected.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    if mirror is not None:
        tagged = rejected.withColumn("_batch_id", F.lit(batch_id).cast("long"))
        write_documents(R.quarantine_documents(tagged), mirror, EVENT_KEY)


def read_quarantine(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every rejected event once, also where a new checkpoint has read the log again."""
    if not Files(spark, lake.root).names(lake.quarantine):
        return spark.createDataFrame([], S.QUARANTINE)
    rows = spark.read.schema(T.StructType(S.QUARANTINE.fields + S.row(source=S.STRING).fields)).parquet(lake.quarantine)
    rows = U.latest_per_key(rows, EVENT_KEY, [F.asc("_batch_id"), F.asc("source")])
    return rows.select(*S.QUARANTINE.fieldNames())


# -- gold ------------------------------------------------------------------------


def drain_metrics(spark: SparkSession, lake: Lake, recompute: bool = False) -> None:
    """Bring the daily metrics up to date with the state's change feed.

    By default the change rows are summed with their sign, which costs as much as
    there were changes. ``recompute`` counts the affected days again, from the copy of the
    state that is laid out by day: only the files of those days are read, and only their buckets written.
    """
    pin_utc(spark)
    state, metrics = lake.state(spark), lake.metrics(spark)
    for after, upto in state.pending(metrics, "state"):
        changes = state.changes(after, upto)
        if not recompute:
            metrics.merge(M.metric_deltas(changes), stream="state", batch_id=upto, verdicts=M.apply_deltas)
            continue
        log = lake.days(spark)
        log.follow(upto)
        touched = M.affected_dates(changes).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            days = M.measured_days(touched)
            by_day = metrics.bucket_by == ("ref_date",)  # else a table from before: days are all over its buckets
            metrics.merge(
                M.recompute_days(log.read(upto), days),
                stream="state",
                batch_id=upto,
                touched=metrics.buckets_of_keys(touched) if by_day else None,
                all_buckets=not by_day,
                verdicts=lambda t, s, by, days=days: M.replace_affected(t, s, days, by),
            )
        finally:
            touched.unpersist()


def drain_distinct(spark: SparkSession, lake: Lake, dimensions: Sequence[str]) -> None:
    """Bring rows and distinct clients per group of any grouping up to date with the state's change feed.

    The references follow the state, the counts follow the references; each commit holds how far its table has come.
    """
    pin_utc(spark)
    dimensions = tuple(dimensions)
    state = lake.state(spark)
    references, counts = lake.references(spark, dimensions), lake.distinct_clients(spark, dimensions)
    keys = (*dimensions, "client_id")
    for after, upto in state.pending(references, "state"):
        references.merge(
            M.reference_deltas(state.changes(after, upto), dimensions),
            stream="state",
            batch_id=upto,
            verdicts=lambda t, s, by: M.apply_deltas(t, s, by, keys, ("held",)),
        )
    for after, upto in references.pending(counts, "references"):
        counts.merge(
            M.distinct_deltas(references.changes(after, upto), dimensions),
            stream="references",
            batch_id=upto,
            verdicts=lambda t, s, by: M.apply_deltas(t, s, by, dimensions),
        )


def drain_documents(spark: SparkSession, lake: Lake) -> None:
    """Rebuild the documents of every client named in the change feed.

    State and documents are bucketed by client: only the touched buckets of both are read.
    """
    pin_utc(spark)
    state, documents = lake.state(spark), lake.documents(spark)
    for after, upto in state.pending(documents, "state"):
        # The clients are used four times: the change feed is read for them once.
        clients = D.affected_clients(state.changes(after, upto)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = state.read(upto, only=state.buckets_of_keys(clients))
            keyed = clients.withColumn(SLICE, documents.slice_of())
            documents.merge(
                D.rebuild_documents(rows, clients),
                stream="state",
                batch_id=upto,
                touched=documents.buckets_of_keys(clients),
                verdicts=lambda t, s, by, keyed=keyed: D.replace_documents(t, s, keyed.repartition(by), by),
            )
        finally:
            clients.unpersist()


# -- mirrors -----------------------------------------------------------------------


def mirror_table(
    table: VersionedTable,
    checkpoint: str,
    connect: Connect,
    shape: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Bring an external document store up to date with a table.

    The change feed says which keys changed; what is sent is their current row, and
    keys without one are removed. Sending again or in another order ends the same.
    """

    def apply(changes: DataFrame, batch_id: int) -> None:
        latest = VersionedTable.open(changes.sparkSession, table.path)
        keys = changes.select(*table.keys).distinct().persist(StorageLevel.MEMORY_AND_DISK)
        try:
            held = latest.read(only=latest.buckets_of_keys(keys))
            write_documents(shape(latest.matching(held, keys, "left_semi")), connect, table.keys)
            remove_documents(shape(latest.matching(keys, held, "left_anti")), connect, table.keys)
        finally:
            keys.unpersist()

    table.follow(apply, checkpoint)


def mirror_metrics(spark: SparkSession, lake: Lake, connect: Connect) -> None:
    mirror_table(lake.metrics(spark), lake.checkpoint("mirror-metrics"), connect, M.mirror)


def mirror_documents(spark: SparkSession, lake: Lake, connect: Connect) -> None:
    mirror_table(lake.documents(spark), lake.checkpoint("mirror-documents"), connect)


def expire(spark: SparkSession, lake: Lake, before: Column) -> None:
    """Remove state rows older than an instant. Change rows say so, and metrics and documents follow them."""
    state = lake.state(pin_utc(spark))
    state.delete(lambda row: row["event_time"] < before)


def run_once(
    spark: SparkSession, lake: Lake, log: DataFrame, mirror: Connect | None = None, **event_options
) -> None:
    """All stages; each drains what is there and stops.

    Documents and metrics depend on the state only and are brought up to date side by side, each with
    its mirror. ``mirror`` connects to the document store, which also gets the rejected events.
    """
    pin_utc(spark)
    ingest_master(spark, lake)
    drain_events(spark, lake, log, mirror=mirror, **event_options)

    def documents() -> None:
        drain_documents(spark, lake)
        if mirror is not None:
            mirror_documents(spark, lake, mirror)

    def metrics() -> None:
        drain_metrics(spark, lake)
        if mirror is not None:
            mirror_metrics(spark, lake, mirror)

    with ThreadPoolExecutor(2) as pool:
        for stage in [pool.submit(inheritable_thread_target(spark)(s)) for s in (documents, metrics)]:
            stage.result()
