import json

from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.functions.contract import Contract
from eventlake.operators import events as V


def raw(spark, *texts):
    rows = [(t if t is None or isinstance(t, str) else json.dumps(t), "t", 0, i, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, S.RAW)


def event(**changed):
    base = {
        "client_id": "cli-1",
        "bank_id": "bank-1",
        "insurer_id": "ins-1",
        "event_time": "2026-07-17T12:00:00",
        "items": [{"type": "a", "scope": ["x", "y"], "status": "active"}],
    }
    return {k: v for k, v in (base | changed).items() if v is not ...}


def reasons(spark, text, contract=Contract()):
    row = V.classify(raw(spark, text), contract=contract).first()
    return row["reasons_text"]


CASES = [
    (event(), ""),
    (None, "malformed_json"),
    ("", "malformed_json"),
    ("   ", "malformed_json"),
    ("{not json at all", "malformed_json"),
    ('{"client_id":"cli-1","event_time":"2026', "malformed_json"),
    ("[]", "malformed_json"),
    ("{}", "missing_client,missing_time,no_items"),
    (event(items=[]), "no_items"),
    (event(items=...), "no_items"),
    (event(items=None), "no_items"),
    (event(items={"type": "a"}), "wrong_shape,no_items"),
    (event(items="a"), "wrong_shape,no_items"),
    (event(items=[{"type": "a", "scope": "x", "status": "s"}]), "wrong_shape"),
    (event(client_id=...), "missing_client"),
    (event(client_id=""), "missing_client"),
    (event(client_id=17), ""),
    (event(event_time="yesterday"), "bad_time"),
    (event(event_time="12:30"), "bad_time"),
    (event(event_time="2026"), "bad_time"),
    (event(event_time="2026-07-17"), "bad_time"),
    (event(event_time="+200000-01-01T00:00:00"), "bad_time"),
    (event(event_time="2026-07-17 12:00:00.5+02:00"), ""),
    (event(event_time=...), "missing_time"),
    (event(items=[None]), "untyped_item"),
    (event(items=[{"scope": ["x"]}]), "untyped_item"),
]


def test_reasons(spark, ansi):
    rows = V.classify(raw(spark, *[text for text, _ in CASES])).orderBy("offset").collect()
    assert [r["reasons_text"] for r in rows] == [expected for _, expected in CASES]


def test_valid_and_quarantine_are_complements(spark, ansi):
    judged = V.classify(raw(spark, *[text for text, _ in CASES]))
    valid, rejected = V.valid_events(judged), V.quarantined_events(judged)
    assert [r.offset for r in valid.orderBy("offset").collect()] == [n for n, c in enumerate(CASES) if c[1] == ""]
    assert [r.offset for r in rejected.orderBy("offset").collect()] == [n for n, c in enumerate(CASES) if c[1] != ""]


def test_strict_contract(spark):
    full = Contract(types=("a", "b"), statuses=("active",), strict=True)
    assert reasons(spark, event(), full) == ""
    assert reasons(spark, event(bank_id="", insurer_id=...), full) == "missing_bank,missing_insurer"
    odd = [{"type": "z", "scope": [], "status": None}]
    assert reasons(spark, event(items=odd), full) == "no_scope,unknown_type,unknown_status"


def test_explode_gives_one_row_per_item(spark):
    two = event(
        items=[
            {"type": "a", "scope": ["x"], "status": "active"},
            {"type": "b", "scope": ["y"], "status": "revoked"},
        ]
    )
    valid = V.valid_events(V.classify(raw(spark, two)))
    rows = V.explode_items(valid).orderBy("item_no").collect()
    assert [(r.consent_type, r.scope, r.status, r.item_no) for r in rows] == [
        ("a", ["x"], "active", 0),
        ("b", ["y"], "revoked", 1),
    ]


def test_time_zones_are_instants(spark):
    rows = raw(spark, event(event_time="2026-07-17T12:00:00+02:00"), event(event_time="2026-07-17T10:00:00Z"))
    valid = V.valid_events(V.classify(rows))
    assert V.explode_items(valid).select("event_time").distinct().count() == 1


def test_portuguese_wire_format(spark):
    text = {
        "cliente_id": "cli-00001",
        "banco_origem": "banco-001",
        "seguradora_id": "seg-001",
        "timestamp": "2026-07-17T12:00:00",
        "consentimentos": [
            {"tipo": S.CONSENT_TYPES[0], "escopo": ["nome", "cpf"], "status": S.CONSENT_STATUSES[0]}
        ],
    }
    contract = Contract(types=S.CONSENT_TYPES, statuses=S.CONSENT_STATUSES, strict=True)
    classified = V.classify(raw(spark, text), S.PORTUGUESE, contract)
    assert classified.first()["reasons_text"] == ""
    item = V.explode_items(V.valid_events(classified)).first()
    assert (item.client_id, item.consent_type, item.scope) == ("cli-00001", S.CONSENT_TYPES[0], ["nome", "cpf"])
    again = V.publish_encode(V.parse_events(raw(spark, text), S.PORTUGUESE), contract, S.PORTUGUESE).first()
    assert again.key == b"cli-00001"
    assert json.loads(again.value) == text


def test_raw_projection_keeps_partition(spark):
    log = spark.createDataFrame([(b"k", b"{}", "t", 2, 7, None)], S.LOG)
    row = V.raw_events(log).first()
    assert (row.raw_json, row.partition, row.offset) == ("{}", 2, 7)


def test_publish_counters_by_observe(spark):
    from pyspark.sql import Observation

    contract = Contract(strict=True)
    parsed = V.parse_events(raw(spark, event(), event(bank_id=""), "{broken"))
    seen = Observation("publish")
    V.publish_encode(parsed.observe(seen, *V.publish_counters(parsed, contract)), contract).write.format(
        "noop"
    ).mode("overwrite").save()
    assert seen.get == {"published": 1, "rejected": 2}


def test_text_is_parsed_once(spark):
    valid = V.valid_events(V.classify(raw(spark, event())))
    plan = V.explode_items(valid)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_zero_padded_ids(spark):
    row = spark.range(1).select(F.format_string("cli-%05d", F.lit(42)).alias("id")).first()
    assert row.id == "cli-00042"
