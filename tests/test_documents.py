import datetime as dt

import pytest

from eventlake import schemas as S
from eventlake.operators import documents as D
from eventlake.operators import serving as R
from eventlake.operators import upsert as U

NOON = dt.datetime(2026, 7, 17, 12)
ITEMS = S.row(
    client_id=S.STRING, bank_id=S.STRING, insurer_id=S.STRING, event_time=S.TIME, topic=S.STRING, offset=S.LONG, item_no=S.INT,
    consent_type=S.STRING, scope=S.STRINGS, status=S.STRING,
)


def item(client, kind, offset=0, status="active", insurer="ins-1", time=NOON, no=0):
    return (client, "bank-1", insurer, time, "t", offset, no, kind, ["x"], status)


def items(spark, *rows):
    return spark.createDataFrame(list(rows), ITEMS)


def test_partial_revocation_keeps_both_types(spark):
    document = D.client_documents(
        items(spark, item("c", "b", status="revoked", time=NOON + dt.timedelta(hours=1)), item("c", "a"))
    ).first()
    assert [(i.consent_type, i.status) for i in document["items"]] == [("a", "active"), ("b", "revoked")]


def test_documents_are_per_client_bank_and_insurer(spark):
    rows = items(spark, item("c", "a", 1), item("c", "b", 2, insurer="ins-2"))
    assert D.client_documents(rows).count() == 2
    one = D.client_documents(rows, by_client=True).first()
    assert one.insurer_id == "ins-2" and len(one["items"]) == 2


def test_history_documents_are_per_day_at_any_size(spark):
    later = NOON + dt.timedelta(days=1)
    rows = [item("hot", f"t{n}", n, insurer=None, time=(NOON, later)[n % 2]) for n in range(100)] + [item("cold", "a", 1000)]
    documents = D.documents_from_items(items(spark, *rows)).collect()
    hot = {d.part: [i.consent_type for i in d["items"]] for d in documents if d.client_id == "hot"}
    assert hot == {20260717 + p: sorted(f"t{n}" for n in range(p, 100, 2)) for p in (0, 1)}
    assert [(d.part, len(d["items"])) for d in documents if d.client_id == "cold"] == [(20260717, 1)]


def test_push_keeps_header_and_appends_in_order(spark):
    before = D.client_documents(items(spark, item("c", "z")), by_client=True)
    pushes = items(spark, item("c", "b", 2, insurer="ins-9"), item("c", "a", 1, insurer="ins-9"), item("new", "q", 3))
    after = {(d.client_id, d.part): d for d in D.push_items(before, pushes).collect()}
    assert {d.insurer_id for d in after.values()} == {"ins-1"}
    found = {key: [i.consent_type for i in d["items"]] for key, d in after.items()}
    assert found == {("c", 0): ["z"], ("c", 20260717): ["a", "b"], ("new", 20260717): ["q"]}


def test_every_push_appends_its_items_once(spark):
    documents = D.client_documents(items(spark, item("hot", "z")), by_client=True)
    for turn in range(3):
        pushes = items(spark, *[item("hot", f"t{turn}-{n}", n, insurer=None) for n in range(4)])
        rows = D.push_items(documents, pushes).collect()
        documents = spark.createDataFrame(rows, S.DOCUMENTS)
    kept = {d.part: [i.consent_type for i in d["items"]] for d in documents.collect()}
    assert kept == {0: ["z"], 20260717: [f"t{turn}-{n}" for turn in range(3) for n in range(4)]}


def test_push_without_time_gets_the_current_time(spark):
    documents = D.push_items(spark.createDataFrame([], S.DOCUMENTS), items(spark, item("c", "a", time=None)))
    assert documents.first()["items"][0].event_time is not None


def test_replacing_documents_drops_emptied_ones(spark):
    before = items(spark, item("c", "a", 1), item("d", "a", 2))
    after = items(spark, item("c", "a", 3, insurer="ins-2"), item("d", "a", 2))
    clients = spark.createDataFrame([("c",)], "client_id string")
    verdicts = D.replace_documents(D.client_documents(before), D.client_documents(after.filter("client_id = 'c'")), clients)
    assert sorted((d.client_id, d.insurer_id) for d in U.merged_state(verdicts).collect()) == [
        ("c", "ins-2"),
        ("d", "ins-1"),
    ]


def test_service_reads(spark):
    empty = spark.createDataFrame([], S.DOCUMENTS)
    assert R.service_status(empty).first().asDict() == {"documents": 0, "items": 0}
    documents = D.client_documents(items(spark, item("c", "a"), item("c", "b"), item("d", "a")))
    assert R.service_status(documents).first().asDict() == {"documents": 2, "items": 3}
    assert R.client_lookup(documents, "c").count() == 1
    assert R.client_lookup(documents, "nobody", first_only=True).isEmpty()


def test_exploded_report_joins_scope(spark):
    row = D.exploded_report(D.client_documents(items(spark, ("c", "b", "i", NOON, "t", 1, 0, "a", ["x", "y"], "active")))).first()
    assert row.scope == "x, y"


def test_quarantine_reads(spark):
    rows = [(f"t{n}", "topic", 0, n, NOON + dt.timedelta(minutes=n), ["no_items"], 3) for n in range(5)]
    quarantine = spark.createDataFrame(rows, S.QUARANTINE)
    latest = R.quarantine_latest(quarantine, 2).collect()
    assert [(r.raw_json, r.kafka_timestamp, r.batch_id) for r in latest] == [
        ("t4", "2026-07-17 12:04:00", 3),
        ("t3", "2026-07-17 12:03:00", 3),
    ]
    assert R.quarantine_total(quarantine).first().total == 5
