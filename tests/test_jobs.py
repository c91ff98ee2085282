import json
import os

import pytest
from pyspark.sql import functions as F

from document_clients import DownClient, FlakyClient, FolderClient
from eventlake import schemas as S
from eventlake.operators import documents as D
from eventlake.operators import events as V
from eventlake.operators import metrics as M
from eventlake.operators import quality as Q
from eventlake.operators import upsert as U
from eventlake.plans import tables as X
from eventlake.sources import document_sink as K
from eventlake.sources.event_log import batch_log, broker_options, matching_topics, stream_log
from eventlake.streaming import batches as B
from eventlake.streaming import jobs as J


def documents_in(folder):
    return {n: json.load(open(os.path.join(folder, n))) for n in os.listdir(folder)}


@pytest.fixture
def lake(tmp_path):
    return J.Lake(str(tmp_path / "lake"), buckets=4)


@pytest.fixture(scope="module")
def segments(spark, sf, tmp_path_factory):
    """The event log as four files, each holding every fourth offset."""
    path = str(tmp_path_factory.mktemp("log"))
    log = X.event_log(spark, sf)
    for part in (2, 0, 3, 1):
        log.filter(F.col("offset") % 4 == part).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path):
    return stream_log(spark, "parquet", {"maxFilesPerTrigger": "1"}, path)


def test_all_stages_equal_the_batch_result(spark, sf, lake, segments, tmp_path):
    os.makedirs(lake.landing)
    csv = str(tmp_path / "csv")
    X.client_master(spark, sf).coalesce(1).write.option("header", True).csv(csv)
    part = next(n for n in os.listdir(csv) if n.endswith(".csv"))
    with open(os.path.join(csv, part)) as source, open(os.path.join(lake.landing, "clients_1.csv"), "w") as target:
        target.write(source.read())

    J.run_once(spark, lake, stream(spark, segments))
    state = lake.state(spark)
    wanted = X.state(spark, sf)
    assert state.versions() == [1, 2, 3, 4]
    assert Q.differences(state.read(), wanted).isEmpty()
    assert Q.differences(lake.metrics(spark).read(), M.daily_metrics(wanted)).isEmpty()
    assert Q.differences(lake.documents(spark).read(), D.client_documents(wanted)).isEmpty()
    rejected = V.quarantined_events(X.classified(spark, sf))
    assert Q.differences(J.read_quarantine(spark, lake).drop("_batch_id"), rejected).isEmpty()

    J.run_once(spark, lake, stream(spark, segments))
    assert state.versions() == [1, 2, 3, 4]
    assert lake.metrics(spark).versions() == [1]


def test_metrics_follow_late_and_moving_rows(spark, sf, lake, segments):
    """Upkeep after every batch, by deltas and by recomputing, equals one aggregation at the end."""
    master = lambda session: X.client_master(session, sf)
    other = J.Lake(lake.root + "-other", buckets=4)
    log = batch_log(spark, "parquet", {}, segments)
    for n, part in enumerate((3, 1, 0, 2)):
        path = f"{lake.root}-part{n}"
        log.filter(F.col("offset") % 4 == part).write.parquet(path)
        for where, recompute in ((lake, False), (other, True)):
            J.drain_events(spark, where, stream_log(spark, "parquet", {}, path), master=master, stream=f"part{n}")
            J.drain_metrics(spark, where, recompute=recompute)
    wanted = M.daily_metrics(X.state(spark, sf))
    for where in (lake, other):
        assert where.metrics(spark).versions() == [1, 2, 3, 4]
        assert Q.differences(where.metrics(spark).read(), wanted).isEmpty()


def test_mirrors_follow_their_tables(spark, sf, lake, segments, tmp_path):
    folders = {name: str(tmp_path / name) for name in ("quarantine", "metrics", "documents")}
    for folder in folders.values():
        os.makedirs(folder)
    connect = {name: (lambda folder=folder: FolderClient(folder)) for name, folder in folders.items()}
    log = stream_log(spark, "parquet", {}, segments)
    standing = F.col("value").cast("string").contains("ins-001")
    for name, part in (("standing", standing), ("arriving", ~standing)):
        J.drain_events(
            spark, lake, log.filter(part), master=lambda s: X.client_master(s, sf),
            mirror=connect["quarantine"], stream=name,
        )
        J.drain_metrics(spark, lake)
        J.drain_documents(spark, lake)
        J.mirror_metrics(spark, lake, connect["metrics"])
        J.mirror_documents(spark, lake, connect["documents"])
    assert len(documents_in(folders["quarantine"])) == J.read_quarantine(spark, lake).count()
    # Groups and documents that vanished with the second feed are gone from the store as well.
    metrics = documents_in(folders["metrics"])
    assert all(isinstance(m["ref_date"], str) for m in metrics.values())
    assert sum(m["total_events"] for m in metrics.values()) == lake.state(spark).read().count()
    assert len(metrics) == lake.metrics(spark).read().count()
    documents = documents_in(folders["documents"])
    assert len(documents) == lake.documents(spark).read().count()
    assert sum(len(d["items"]) for d in documents.values()) == lake.state(spark).read().count()


def test_lost_checkpoint_repeats_without_harm(spark, sf, lake, segments, tmp_path):
    master = lambda s: X.client_master(s, sf)
    J.drain_events(spark, lake, stream_log(spark, "parquet", {}, segments), master=master)
    J.drain_metrics(spark, lake)
    wanted = M.daily_metrics(X.state(spark, sf))
    os.rename(lake.checkpoint("silver-events"), str(tmp_path / "lost"))
    J.drain_events(spark, lake, stream_log(spark, "parquet", {}, segments), master=master)
    J.drain_metrics(spark, lake)
    assert lake.state(spark).versions() == [1, 2]
    assert lake.state(spark).changes(1).isEmpty()
    assert Q.differences(lake.metrics(spark).read(), wanted).isEmpty()


def test_expiry_reaches_metrics_and_documents(spark, sf, lake, segments):
    J.drain_events(spark, lake, stream_log(spark, "parquet", {}, segments), master=lambda s: X.client_master(s, sf))
    J.drain_metrics(spark, lake)
    J.drain_documents(spark, lake)
    limit = F.lit("2024-01-16").cast("timestamp")
    J.expire(spark, lake, limit)
    J.drain_metrics(spark, lake)
    J.drain_documents(spark, lake)
    kept = X.state(spark, sf).filter(F.col("event_time") >= limit)
    assert Q.differences(lake.state(spark).read(), kept).isEmpty()
    assert Q.differences(lake.metrics(spark).read(), M.daily_metrics(kept)).isEmpty()
    assert Q.differences(lake.documents(spark).read(), D.client_documents(kept)).isEmpty()


def test_names_are_found_with_other_bucket_counts(spark, sf, lake, segments, tmp_path):
    wide = J.Lake(lake.root, buckets=16)
    os.makedirs(lake.landing)
    X.client_master(spark, sf).toPandas().to_csv(os.path.join(lake.landing, "clients_1.csv"), index=False)
    J.ingest_master(spark, wide)
    J.drain_events(spark, J.Lake(lake.root, buckets=7), stream_log(spark, "parquet", {}, segments))
    assert Q.differences(lake.state(spark).read(), X.state(spark, sf)).isEmpty()


def test_a_run_fills_the_mirrors(spark, sf, lake, segments, tmp_path):
    folder = str(tmp_path / "store")
    os.makedirs(folder)
    J.run_once(spark, lake, stream(spark, segments), mirror=lambda: FolderClient(folder))
    tables = (J.read_quarantine(spark, lake), lake.metrics(spark).read(), lake.documents(spark).read())
    assert len(documents_in(folder)) == sum(rows.count() for rows in tables)


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from eventlake import session

    def of(master):
        conf = {}
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__),
            sparkContext=SimpleNamespace(master=master),
        )

    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.shared_folder(of(master))
    here = of("local[2]")
    assert session.shared_folder(here) == session.shared_folder(here)


def test_environments_share_nothing(lake):
    prod = J.Lake(lake.root, env="prod")
    assert prod.checkpoint("x") != lake.checkpoint("x")
    assert not set(prod.quarantine.split("/")) & {"dev"}


def test_enrichment_lost_or_kept(spark, lake, sf):
    """A missing master row overwrites names with NULL unless told to keep known values."""
    master = S.CLIENT_MASTER

    def log(path, minute):
        text = json.dumps(
            {
                "client_id": "c", "bank_id": "b", "insurer_id": "i", "event_time": f"2026-01-01T00:0{minute}:00",
                "items": [{"type": "a", "scope": ["x"], "status": "active"}],
            }
        )
        spark.createDataFrame([(b"c", text.encode(), "t", 0, minute, None)], S.LOG).write.parquet(path)
        return stream_log(spark, "parquet", {}, path)

    known = lambda s: s.createDataFrame([("c", "Ana", "1", "b")], master)
    gone = lambda s: s.createDataFrame([], master)
    for keep, expected in ((True, "Ana"), (False, None)):
        here = J.Lake(f"{lake.root}-{keep}", buckets=2)
        J.drain_events(spark, here, log(f"{here.root}-log1", 1), master=known, stream="one")
        J.drain_events(spark, here, log(f"{here.root}-log2", 2), master=gone, stream="two", coalesce_enrichment=keep)
        row = here.state(spark).read().first()
        assert (row.client_name, row.offset) == (expected, 2)


def test_retry_waits_longer_each_time_and_raises_the_last_error():
    waits, calls = [], []

    def failing(rows, batch_id):
        calls.append(batch_id)
        raise OSError(f"try {len(calls)}")

    with pytest.raises(OSError, match="try 3"):
        B.with_retry(failing, sleep=waits.append)(None, 5)
    assert (calls, waits) == ([5, 5, 5], [2, 4])

    def once(rows, batch_id):
        calls.append(batch_id)
        if len(calls) == 4:
            raise OSError("first")

    B.with_retry(once, sleep=waits.append)(None, 6)
    assert calls[3:] == [6, 6]


def test_dead_letter_keeps_the_batch_and_the_stream(spark, segments, tmp_path):
    done = []

    def batch(rows, batch_id):
        if batch_id == 1:
            raise ValueError("bad batch")
        done.append(rows.count())

    letters = str(tmp_path / "letters")
    B.drain(stream(spark, segments), B.with_dead_letter(batch, letters, str(tmp_path / "cp")), str(tmp_path / "cp"))
    kept = spark.read.parquet(letters)
    assert len(done) == 3
    assert kept.count() + sum(done) == batch_log(spark, "parquet", {}, segments).count()
    assert kept.select("_error").distinct().first()[0] == "ValueError: bad batch"


def test_sink_retries_a_chunk(spark, tmp_path):
    folder = str(tmp_path)

    rows = spark.range(7).select(F.col("id").alias("k"), F.lit("v").alias("v")).coalesce(1)
    K.write_documents(rows, lambda: FlakyClient(folder), ["k"], chunk_size=3, base=0.01)
    os.remove(os.path.join(folder, "failed"))
    assert len(documents_in(folder)) == 7

    with pytest.raises(Exception, match="down"):
        K.write_documents(rows, lambda: DownClient(folder), ["k"], attempts=2, base=0.01)


def test_broker_options():
    options = broker_options("h:1", topic="t", max_offsets=10, security={"sasl.mechanism": "PLAIN"})
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "startingOffsets": "earliest",
        "subscribe": "t",
        "maxOffsetsPerTrigger": "10",
        "kafka.sasl.mechanism": "PLAIN",
    }
    assert broker_options("h:1", pattern="t-.*")["subscribePattern"] == "t-.*"
    with pytest.raises(ValueError):
        broker_options("h:1")


def test_topics_match_as_a_whole(spark):
    log = spark.createDataFrame([(None, None, t, 0, 0, None) for t in ("a-1", "a-2", "xa-1")], S.LOG)
    assert sorted(r.topic for r in matching_topics(log, "a-.*|b").collect()) == ["a-1", "a-2"]


def test_change_types_seen_downstream(spark, sf, lake, segments):
    J.drain_events(spark, lake, stream(spark, segments), master=lambda s: X.client_master(s, sf))
    kinds = {r[0] for r in lake.state(spark).changes(0).select(U.CHANGE_TYPE).distinct().collect()}
    assert kinds == {"insert", "update_preimage", "update_postimage"}


def test_command_line_run_and_sql_views(spark, sf, lake, segments):
    from eventlake.__main__ import main
    from eventlake.plans.views import register_views

    main(["--root", lake.root, "--buckets", "2", "--log-path", segments])
    assert lake.state(spark).buckets == 2
    assert register_views(spark, lake) == ["client_documents", "consents", "daily_metrics", "quarantine"]
    total = lake.state(spark).read().count()
    assert spark.sql("SELECT sum(total_events) FROM daily_metrics").first()[0] == total
    assert spark.sql("SELECT sum(size(items)) FROM client_documents").first()[0] == total
    members = spark.createDataFrame([("ann", "analysts")], "member string, grp string")
    insurers = spark.createDataFrame([("ann", "ins-002")], "member string, insurer_id string")
    register_views(spark, lake, "ann", members, insurers)
    seen = spark.sql("SELECT DISTINCT insurer_id, client_name FROM consents").collect()
    assert [tuple(r) for r in seen] == [("ins-002", "CLIENTE PROTEGIDO")]
    with pytest.raises(ValueError):
        register_views(spark, lake, "ann")
