"""The same results in plain SQL on the given tables, without any JSON handling.

Used to check the queries in a second engine. The common part restates what the
event log looks like; each statement restates one query.
"""

from __future__ import annotations

_LOG = """
log AS (
  SELECT event_id AS "offset", CAST(user_id % 3 AS INTEGER) AS "partition", ts,
         printf('cli-%05d', user_id) AS client_id,
         'bank-00' || (1 + user_id % 5) AS bank_id, 'consents-bank-00' || (1 + user_id % 5) AS topic,
         'ins-00' || (1 + event_id % 3) AS insurer_id,
         event_type,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'name,tax_id' ELSE 'income' END AS scope,
         CASE WHEN event_id % 10 = 0 THEN 'revoked' ELSE 'active' END AS status,
         event_id % 97 = 0 AS cut,
         event_id % 79 = 0 AS bad_time,
         event_id % 89 = 0 AND event_id % 83 <> 0 AS empty_list,
         event_id % 83 = 0 AS no_list,
         event_id % 4 = 0 AS two_items
  FROM events
),
judged AS (
  SELECT *,
         CASE WHEN cut THEN 'malformed_json'
              ELSE concat_ws(',', CASE WHEN bad_time THEN 'bad_time' END,
                                  CASE WHEN empty_list OR no_list THEN 'no_items' END)
         END AS reasons
  FROM log
)"""

_JSON = """
texts AS (
  SELECT *, '{"client_id":"' || client_id || '","bank_id":"' || bank_id || '","insurer_id":"' || insurer_id
         || '","event_time":"' || CASE WHEN bad_time THEN 'not-a-time' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END
         || '"'
         || CASE WHEN no_list THEN '' WHEN empty_list THEN ',"items":[]' ELSE
              ',"items":[{"type":"' || event_type || '","scope":["' || replace(scope, ',', '","')
              || '"],"status":"' || status || '"}'
              || CASE WHEN two_items THEN
                   ',{"type":"' || event_type || '_detail","scope":["score"],"status":"' || status || '"}'
                 ELSE '' END
              || ']' END
         || '}' AS full_text
  FROM judged
),
raw AS (
  SELECT *, CASE WHEN cut THEN left(full_text, length(full_text) - 7) ELSE full_text END AS raw_json FROM texts
),
quarantine AS (
  SELECT raw_json, topic, "partition", "offset", ts AS kafka_timestamp, reasons, CAST(0 AS BIGINT) AS _batch_id
  FROM raw WHERE reasons <> ''
)"""

_ITEMS = """
items AS (
  SELECT client_id, bank_id, insurer_id, ts AS event_time, topic, "offset", CAST(0 AS INTEGER) AS item_no,
         event_type AS consent_type, scope, status
  FROM judged WHERE reasons = ''
  UNION ALL
  SELECT client_id, bank_id, insurer_id, ts, topic, "offset", 1, event_type || '_detail', 'score', status
  FROM judged WHERE reasons = '' AND two_items
)"""

_NEWEST = """
newest AS (
  SELECT * EXCLUDE (item_no) FROM items
  QUALIFY row_number() OVER (PARTITION BY client_id, consent_type
                             ORDER BY event_time DESC, topic DESC, "offset" DESC, item_no DESC) = 1
)"""

_MASTER = """
master AS (
  SELECT CASE WHEN c_custkey % 10 = 0 THEN printf('org-%05d', c_custkey)
              ELSE printf('cli-%05d', c_custkey) END AS client_id,
         c_name AS client_name,
         printf('%03d.%03d.%03d-%02d', c_custkey // 1000000 % 1000, c_custkey // 1000 % 1000,
                c_custkey % 1000, c_custkey % 97) AS tax_id,
         'bank-00' || (1 + c_nationkey % 5) AS bank_id
  FROM customer
)"""

_STATE_COLUMNS = (
    "n.client_id, n.bank_id, n.insurer_id, m.client_name, m.tax_id, n.event_time, "
    'n.topic, n."offset", n.consent_type, n.scope, n.status'
)
_STATE = f"""
state AS (
  SELECT {_STATE_COLUMNS} FROM newest n LEFT JOIN master m ON m.client_id = n.client_id
)"""

_METRICS = """
metrics AS (
  SELECT CAST(event_time AS DATE) AS ref_date, bank_id, insurer_id, consent_type,
         count(*) AS total_events, count(DISTINCT client_id) AS total_clients
  FROM state GROUP BY 1, 2, 3, 4
)"""

# The state of one insurer's events, and what the arrival of all others changes in it.
_FEEDS = f"""
standing AS (
  SELECT * EXCLUDE (item_no) FROM items WHERE insurer_id = 'ins-001'
  QUALIFY row_number() OVER (PARTITION BY client_id, consent_type
                             ORDER BY event_time DESC, topic DESC, "offset" DESC, item_no DESC) = 1
),
arriving AS (
  SELECT * EXCLUDE (item_no) FROM items WHERE insurer_id <> 'ins-001'
  QUALIFY row_number() OVER (PARTITION BY client_id, consent_type
                             ORDER BY event_time DESC, topic DESC, "offset" DESC, item_no DESC) = 1
),
before AS (
  SELECT {_STATE_COLUMNS} FROM standing n LEFT JOIN master m ON m.client_id = n.client_id
),
changes AS (
  SELECT 'insert' AS _change_type, s.* FROM state s
  WHERE NOT EXISTS (SELECT 1 FROM before b WHERE b.client_id = s.client_id AND b.consent_type = s.consent_type)
  UNION ALL
  SELECT 'update_preimage', b.* FROM before b JOIN state s USING (client_id, consent_type) WHERE s."offset" <> b."offset"
  UNION ALL
  SELECT 'update_postimage', s.* FROM before b JOIN state s USING (client_id, consent_type) WHERE s."offset" <> b."offset"
)"""

_ITEM_TEXT = "consent_type || '=' || status || '@' || strftime(event_time, '%Y-%m-%d %H:%M:%S.%f')"

_DOCUMENTS = f"""
documents_by_triple AS (
  SELECT client_id, bank_id, insurer_id, CAST(0 AS INTEGER) AS part, count(*) AS n_items,
         string_agg({_ITEM_TEXT}, ';' ORDER BY consent_type, event_time, status, scope) AS items
  FROM state GROUP BY 1, 2, 3
)"""

_RIGHTS = """
entitlements AS (
  SELECT printf('analyst-%02d', n_nationkey) AS member, 'ins-00' || (1 + n_nationkey % 4) AS insurer_id FROM nation
)"""


def _with(*parts: str, body: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body.strip()


def _on_log(body: str) -> str:
    return _with(_LOG, body=body)


def _on_raw(body: str) -> str:
    return _with(_LOG, _JSON, body=body)


def _on_items(body: str) -> str:
    return _with(_LOG, _ITEMS, _MASTER, body=body)


def _on_state(body: str) -> str:
    return _with(_LOG, _ITEMS, _NEWEST, _MASTER, _STATE, _METRICS, _RIGHTS, body=body)


def _on_feeds(body: str) -> str:
    return _with(_LOG, _ITEMS, _NEWEST, _MASTER, _STATE, _METRICS, _FEEDS, body=body)


def _on_documents(body: str) -> str:
    return _with(_LOG, _ITEMS, _NEWEST, _MASTER, _STATE, _DOCUMENTS, body=body)


_MASK_TAX = "'***.***.***-' || right(tax_id, 2)"
_STATE_OUT = 'client_id, bank_id, insurer_id, client_name, tax_id, event_time, topic, "offset", consent_type, scope, status'
_MASKED = (
    "client_id, bank_id, insurer_id, 'CLIENTE PROTEGIDO' AS client_name, "
    f'{_MASK_TAX} AS tax_id, event_time, topic, "offset", consent_type, scope, status'
)
_MINE = "insurer_id IN (SELECT insurer_id FROM entitlements WHERE member = 'analyst-01')"
_ALL_METRICS = "SELECT ref_date, bank_id, insurer_id, consent_type, total_events, total_clients FROM metrics"
_ALL_DOCUMENTS = "SELECT * FROM documents_by_triple"

_NESTED = """
WITH RECURSIVE direct(member, grp) AS (
  SELECT 'customer-' || c_custkey, 'nation-' || c_nationkey FROM customer
  UNION SELECT 'nation-' || n_nationkey, 'region-' || n_regionkey FROM nation
  UNION SELECT 'region-' || r_regionkey, 'region-' || (r_regionkey - 1) FROM region WHERE r_regionkey > 0
  UNION SELECT 'region-0', 'region-1'
),
members(member, grp) AS (
  SELECT member, grp FROM direct
  UNION SELECT members.member, direct.grp FROM members JOIN direct ON members.grp = direct.member
)
"""

_SHIPPED = """
SELECT o_orderkey, o_orderdate, l_orderkey, l_linenumber, l_partkey, l_shipdate
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 90 DAY"""

# Rows and distinct clients of four groupings as one list.
_DISTINCT = """
SELECT 'ref_date' AS dimensions, CAST(CAST(event_time AS DATE) AS VARCHAR) AS value,
       count(*) AS total_events, count(DISTINCT client_id) AS total_clients FROM state GROUP BY ALL
UNION ALL
SELECT 'bank_id', bank_id, count(*), count(DISTINCT client_id) FROM state GROUP BY ALL
UNION ALL
SELECT 'ref_date bank_id', CAST(CAST(event_time AS DATE) AS VARCHAR) || ' ' || bank_id, count(*), count(DISTINCT client_id)
FROM state GROUP BY ALL
UNION ALL
SELECT 'insurer_id status', insurer_id || ' ' || status, count(*), count(DISTINCT client_id) FROM state GROUP BY ALL"""

# What is left after expiry: metrics, then documents, as one list of groups and their sizes.
_EXPIRED = """
, kept AS (SELECT * FROM state WHERE event_time >= TIMESTAMP '2024-01-16 00:00:00')
SELECT 'metrics' AS kind, CAST(CAST(event_time AS DATE) AS VARCHAR) || ' ' || bank_id || ' ' || insurer_id || ' ' || consent_type
         AS name, count(*) AS n FROM kept GROUP BY ALL
UNION ALL
SELECT 'documents', client_id || ' ' || bank_id || ' ' || insurer_id, count(*) FROM kept GROUP BY ALL"""


def _pushed(push: str) -> str:
    """Items appended to the standing documents, each to its client's document of the day, push by push."""
    return f"""
, old AS (
  SELECT client_id, arg_max(bank_id, (event_time, topic, "offset", consent_type)) AS bank_id,
         arg_max(insurer_id, (event_time, topic, "offset", consent_type)) AS insurer_id, count(*) AS n,
         string_agg({_ITEM_TEXT}, ';' ORDER BY consent_type, event_time, status, scope) AS items
  FROM standing GROUP BY 1
),
pushed AS (
  SELECT *, {push} AS push, CAST(strftime(event_time, '%Y%m%d') AS INTEGER) AS day
  FROM items WHERE insurer_id <> 'ins-001'
),
heads AS (
  SELECT client_id, arg_min(bank_id, (push, topic, "offset", item_no)) AS bank_id,
         arg_min(insurer_id, (push, topic, "offset", item_no)) AS insurer_id
  FROM pushed GROUP BY 1
)
SELECT client_id, bank_id, insurer_id, CAST(0 AS INTEGER) AS part, n AS n_items, items FROM old
UNION ALL
SELECT p.client_id, coalesce(any_value(o.bank_id), any_value(h.bank_id)),
       coalesce(any_value(o.insurer_id), any_value(h.insurer_id)), p.day, count(*),
       string_agg(p.item, ';' ORDER BY push, topic, "offset", item_no)
FROM (SELECT *, {_ITEM_TEXT} AS item FROM pushed) p JOIN heads h ON h.client_id = p.client_id
LEFT JOIN old o ON o.client_id = p.client_id
GROUP BY p.client_id, p.day"""


ORACLE: dict[str, str] = {
    # intake
    "raw_events": _on_raw('SELECT raw_json, topic, "partition", "offset", ts AS kafka_timestamp FROM raw'),
    "parse_events": _on_log(
        """
SELECT "partition", "offset",
       CASE WHEN NOT cut THEN client_id END AS client_id,
       CASE WHEN NOT cut THEN bank_id END AS bank_id,
       CASE WHEN NOT cut THEN insurer_id END AS insurer_id,
       CASE WHEN NOT cut AND NOT bad_time THEN ts END AS event_time,
       CAST(CASE WHEN cut OR no_list THEN NULL WHEN empty_list THEN 0 WHEN two_items THEN 2 ELSE 1 END AS BIGINT)
         AS n_items
FROM judged"""
    ),
    "valid_events": _on_log(
        """
SELECT "partition", "offset", client_id, ts AS event_time,
       CAST(CASE WHEN two_items THEN 2 ELSE 1 END AS BIGINT) AS n_items
FROM judged WHERE reasons = ''"""
    ),
    "quarantine_rows": _on_raw("SELECT * FROM quarantine"),
    "quarantine_docs": _on_raw(
        'SELECT raw_json, topic, "partition", "offset", CAST(kafka_timestamp AS VARCHAR) AS kafka_timestamp, reasons, '
        "_batch_id FROM quarantine"
    ),
    "split_counts": _on_log(
        "SELECT CASE WHEN reasons = '' THEN 'valid' ELSE 'quarantine' END AS side, count(*) AS events "
        "FROM judged GROUP BY 1"
    ),
    "contract_violations": _on_log(
        """
SELECT "partition", "offset", 'malformed_json' AS reason FROM judged WHERE cut
UNION ALL SELECT "partition", "offset", 'bad_time' FROM judged WHERE NOT cut AND bad_time
UNION ALL SELECT "partition", "offset", 'no_items' FROM judged WHERE NOT cut AND (empty_list OR no_list)"""
    ),
    "explode_items": _on_items("SELECT * FROM items"),
    "publish_encode": _on_raw("SELECT client_id AS key, raw_json AS value FROM raw WHERE reasons = ''"),
    "publish_stats": _on_log(
        "SELECT count(*) FILTER (WHERE reasons = '') AS published, count(*) FILTER (WHERE reasons <> '') AS rejected "
        "FROM judged"
    ),
    "topic_pattern": _on_log(
        """
SELECT 'consents-' || bank_id AS topic, "partition", count(*) AS events,
       min("offset") AS first, max("offset") AS last
FROM log WHERE bank_id IN ('bank-001', 'bank-002', 'bank-003') GROUP BY 1, 2"""
    ),
    # keyed state
    "enrich_left": _on_items(
        'SELECT i.*, m.client_name, m.tax_id FROM items i LEFT JOIN master m ON m.client_id = i.client_id'
    ),
    "master_newest": _on_items(
        """
SELECT client_id, CASE WHEN bank_id = 'bank-003' THEN client_name || ' (renamed)' ELSE client_name END AS client_name,
       tax_id, bank_id
FROM master"""
    ),
    "latest_per_key": _on_state(
        'SELECT client_id, bank_id, insurer_id, event_time, topic, "offset", consent_type, scope, status FROM newest'
    ),
    "merge_upsert": _on_state(f"SELECT {_STATE_OUT} FROM state"),
    "change_feed": _on_feeds(
        f"SELECT _change_type, {_STATE_OUT}, CAST(2 AS BIGINT) AS _commit_version FROM changes"
    ),
    "merge_decision": _on_feeds(
        """
SELECT client_id, consent_type, topic, "offset", strftime(hour, '%Y-%m-%dT%H:00:00') AS time_text,
       strftime(known_hour, '%Y-%m-%dT%H:00:00') AS target_time,
       CASE WHEN known_hour IS NULL THEN 'insert' WHEN hour > known_hour THEN 'update'
            WHEN hour = known_hour AND (topic, "offset") > (known_topic, known_offset) THEN 'update' ELSE 'ignore' END
         AS decision
FROM (SELECT a.client_id, a.consent_type, a.topic, a."offset", date_trunc('hour', a.event_time) AS hour,
             date_trunc('hour', s.event_time) AS known_hour, s.topic AS known_topic, s."offset" AS known_offset
      FROM arriving a LEFT JOIN standing s USING (client_id, consent_type))"""
    ),
    "merge_conditional": _on_feeds(
        """
SELECT s.client_id, s.bank_id, s.insurer_id,
       CASE WHEN a.status = 'revoked' AND a.event_time > s.event_time THEN a.event_time ELSE s.event_time END
         AS event_time,
       s.topic, s."offset", s.consent_type, s.scope,
       CASE WHEN a.status = 'revoked' AND a.event_time > s.event_time THEN a.status ELSE s.status END AS status
FROM standing s LEFT JOIN arriving a USING (client_id, consent_type)"""
    ),
    "merge_soft_delete": _on_items(
        """
SELECT client_id, client_name, tax_id, bank_id,
       CASE WHEN client_id IN (SELECT printf('cli-%05d', user_id) FROM events) THEN 'active' ELSE 'inactive' END
         AS status
FROM master"""
    ),
    # metrics
    "daily_metrics": _on_state(_ALL_METRICS),
    "metrics_mirror": _on_state(
        "SELECT CAST(ref_date AS VARCHAR) AS ref_date, bank_id, insurer_id, consent_type, total_events, total_clients "
        "FROM metrics"
    ),
    "affected_recompute": _on_feeds(
        _ALL_METRICS + " WHERE ref_date IN (SELECT CAST(event_time AS DATE) FROM changes)"
    ),
    "metrics_merge": _on_state(_ALL_METRICS),
    "metrics_delta": _on_state(_ALL_METRICS),
    "metrics_totals": _on_state(
        """
SELECT CAST(coalesce(sum(total_events), 0) AS BIGINT) AS total_events,
       CAST(coalesce(sum(total_clients), 0) AS BIGINT) AS clients_summed_by_row,
       count(DISTINCT ref_date) AS days, count(*) AS metric_rows,
       (SELECT count(DISTINCT client_id) FROM state) AS clients_exact
FROM metrics"""
    ),
    "events_per_day": _on_state(
        "SELECT ref_date, CAST(sum(total_events) AS BIGINT) AS total_events FROM metrics GROUP BY 1"
    ),
    "events_per_type": _on_state(
        "SELECT consent_type, CAST(sum(total_events) AS BIGINT) AS total_events FROM metrics GROUP BY 1"
    ),
    "events_per_bank": _on_state(
        "SELECT bank_id, CAST(sum(total_events) AS BIGINT) AS total_events FROM metrics GROUP BY 1"
    ),
    "metrics_latest": _on_state(
        _ALL_METRICS + " ORDER BY ref_date DESC, bank_id, insurer_id, consent_type LIMIT 1000"
    ),
    "active_per_day": _on_state(
        "SELECT CAST(event_time AS DATE) AS day, count(*) AS active FROM state WHERE status = 'active' GROUP BY 1"
    ),
    "window_counts": _on_items(
        """
SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end,
       bank_id, count(*) AS events
FROM items GROUP BY 1, 2, 3"""
    ),
    "usage_rollup": (
        "SELECT event_type, sum(CAST(value AS DECIMAL(18,2))) AS usage, count(*) AS records FROM events GROUP BY 1"
    ),
    "p95_by_type": (
        "SELECT event_type, quantile_disc(value, 0.95) AS p95, count(*) AS records FROM events GROUP BY 1"
    ),
    "volume_anomaly": """
WITH daily AS (
  SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, count(*) AS volume FROM orders GROUP BY 1, 2
),
averaged AS (
  SELECT *, round(avg(volume) OVER (PARTITION BY o_orderpriority ORDER BY day
                                    ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS moving_average
  FROM daily
)
SELECT *, coalesce(volume > moving_average * 3, false) AS anomalous FROM averaged""",
    # documents and service reads
    "client_documents": _on_documents(_ALL_DOCUMENTS),
    "client_documents_by_client": _on_documents(
        f"""
SELECT client_id, arg_max(bank_id, (event_time, topic, "offset", consent_type)) AS bank_id,
       arg_max(insurer_id, (event_time, topic, "offset", consent_type)) AS insurer_id,
       CAST(0 AS INTEGER) AS part, count(*) AS n_items,
       string_agg({_ITEM_TEXT}, ';' ORDER BY consent_type, event_time, status, scope) AS items
FROM state GROUP BY 1"""
    ),
    "item_history_documents": _on_items(
        f"""
SELECT client_id, bank_id, insurer_id, CAST(strftime(event_time, '%Y%m%d') AS INTEGER) AS part, count(*) AS n_items,
       string_agg({_ITEM_TEXT}, ';' ORDER BY consent_type, event_time, status, scope) AS items
FROM items GROUP BY 1, 2, 3, 4"""
    ),
    "document_upsert": _on_documents(_ALL_DOCUMENTS),
    "document_push": _on_feeds(_pushed("0")),
    "document_push_twice": _on_feeds(_pushed("CASE insurer_id WHEN 'ins-002' THEN 0 ELSE 1 END")),
    "exploded_report": _on_state(
        "SELECT client_id, bank_id, insurer_id, consent_type, replace(scope, ',', ', ') AS scope, status, event_time "
        "FROM state"
    ),
    "client_lookup": _on_documents(_ALL_DOCUMENTS + " WHERE client_id = 'cli-00007'"),
    "client_lookup_first": _on_documents(
        _ALL_DOCUMENTS + " WHERE client_id = 'cli-00007' ORDER BY bank_id, insurer_id, part LIMIT 1"
    ),
    "service_status": _on_documents(
        "SELECT count(*) AS documents, CAST(coalesce(sum(n_items), 0) AS BIGINT) AS items FROM documents_by_triple"
    ),
    "quarantine_latest": _on_raw(
        """
SELECT raw_json, topic, "partition", "offset", CAST(kafka_timestamp AS VARCHAR) AS kafka_timestamp, reasons,
       _batch_id AS batch_id
FROM quarantine ORDER BY 5 DESC, topic DESC, "partition" DESC, "offset" DESC LIMIT 200"""
    ),
    "quarantine_total": _on_raw("SELECT count(*) AS total FROM quarantine"),
    "quarantine_depth": _on_raw(
        "SELECT _batch_id, CAST(kafka_timestamp AS DATE) AS day, count(*) AS depth FROM quarantine GROUP BY 1, 2"
    ),
    "lookup_array": (
        "SELECT c_custkey, CAST(CASE WHEN n_nationkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS matches, "
        "coalesce(n_name, '') AS nation FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey"
    ),
    # governance
    "masked_view": _on_state(f"SELECT {_MASKED} FROM state"),
    "masked_view_privileged": _on_state(f"SELECT {_STATE_OUT} FROM state"),
    "masked_by_context": _on_state(
        f"""
SELECT client_id, bank_id, insurer_id, client_name,
       CASE WHEN bank_id = 'bank-002' THEN tax_id ELSE {_MASK_TAX} END AS tax_id,
       event_time, topic, "offset", consent_type, scope, status
FROM state"""
    ),
    "row_filtered_view": _on_state(f"SELECT {_STATE_OUT} FROM state WHERE {_MINE}"),
    "row_filtered_composite": _on_state(
        f"SELECT {_STATE_OUT} FROM state WHERE {_MINE} AND status <> 'revoked'"
    ),
    "secured_view": _on_state(f"SELECT {_MASKED} FROM state WHERE {_MINE}"),
    "column_excluded_view": _on_state("SELECT * EXCLUDE (tax_id) FROM state"),
    "nested_memberships": _NESTED + "SELECT member, grp FROM members",
    "row_filtered_nested": _NESTED
    + """
SELECT o_orderkey, 'customer-' || o_custkey AS member FROM orders
WHERE 'customer-' || o_custkey IN (SELECT member FROM members WHERE grp = 'region-2')""",
    # quality
    "constraint_violations": _on_state(
        """
SELECT 'status_known' AS check_name, count(*) FILTER (WHERE status NOT IN ('active', 'revoked')) AS violations FROM state
UNION ALL SELECT 'has_master', count(*) FILTER (WHERE tax_id IS NULL) FROM state
UNION ALL SELECT 'not_revoked', count(*) FILTER (WHERE status = 'revoked') FROM state"""
    ),
    "expectations_report": _on_state(
        """
SELECT expectation, failing, failing = 0 AS passed FROM (
  SELECT 'not_null(client_id)' AS expectation, count(*) FILTER (WHERE client_id IS NULL) AS failing FROM state
  UNION ALL SELECT 'not_null(event_time)', count(*) FILTER (WHERE event_time IS NULL) FROM state
  UNION ALL SELECT 'not_null(client_name)', count(*) FILTER (WHERE client_name IS NULL) FROM state
  UNION ALL SELECT 'unique(client_id,consent_type)', count(*) - count(DISTINCT (client_id, consent_type)) FROM state
  UNION ALL SELECT 'unique(client_id)', count(*) - count(DISTINCT client_id) FROM state
  UNION ALL SELECT 'references(client_id)', count(*) FROM state
            WHERE client_id NOT IN (SELECT client_id FROM master)
)"""
    ),
    "env_diff": _on_feeds(
        """
SELECT client_id, bank_id, insurer_id, event_time, topic, "offset", consent_type, scope, status,
       CAST(sum(l) AS BIGINT) AS left_count, CAST(sum(r) AS BIGINT) AS right_count
FROM (SELECT *, 1 AS l, 0 AS r FROM newest UNION ALL SELECT *, 0, 1 FROM standing)
GROUP BY ALL HAVING sum(l) <> sum(r)"""
    ),
    "canary_split": """
SELECT event_id, user_id,
       CASE WHEN CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 5
            THEN 'canary' ELSE 'stable' END AS arm
FROM events""",
    "freshness": """
SELECT event_type, max(ts) AS newest,
       CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') AS BIGINT) - CAST(floor(epoch(max(ts))) AS BIGINT) AS age_seconds,
       CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') AS BIGINT) - CAST(floor(epoch(max(ts))) AS BIGINT) > 7200 AS stale
FROM events GROUP BY 1""",
    "ttl_retained": _on_raw(
        "SELECT * FROM quarantine WHERE kafka_timestamp >= TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 30 DAY"
    ),
    # streaming jobs: the stored results equal those of the batch queries
    "stream_state": _on_state(f"SELECT {_STATE_OUT} FROM state"),
    "stream_quarantine": _on_raw("SELECT * FROM quarantine"),
    "stream_quarantine_replayed": _on_raw("SELECT * FROM quarantine"),
    "topic_quarantine": _on_raw(
        "SELECT * FROM quarantine UNION ALL SELECT * REPLACE ('copied-' || topic AS topic) FROM quarantine"
    ),
    "stream_expired_metrics": _on_state(_EXPIRED),
    "bronze_append": _on_items(
        "SELECT client_id, client_name, tax_id, bank_id, CAST(CASE bank_id WHEN 'bank-002' THEN NULL ELSE 7 END AS VARCHAR) AS _score "
        "FROM master WHERE bank_id IN ('bank-002', 'bank-003')"
    ),
    "contract_reasons": """
SELECT CAST(event_id AS BIGINT) AS "offset", CASE event_id % 13
         WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'wrong_shape' WHEN 2 THEN 'missing_client' WHEN 3 THEN 'missing_time'
         WHEN 4 THEN 'bad_time' WHEN 5 THEN 'no_items' WHEN 6 THEN 'untyped_item' WHEN 7 THEN 'missing_bank'
         WHEN 8 THEN 'missing_insurer' WHEN 9 THEN 'no_scope' WHEN 10 THEN 'unknown_type' WHEN 11 THEN 'unknown_status'
       END AS reason
FROM events WHERE event_id % 13 < 12
UNION ALL SELECT CAST(event_id AS BIGINT), 'no_scope' FROM events WHERE event_id % 13 = 1""",
    "stream_change_feed": _on_feeds(
        f"SELECT _change_type, {_STATE_OUT}, CAST(2 AS BIGINT) AS _commit_version FROM changes"
    ),
    "stream_metrics": _on_state(_ALL_METRICS),
    "stream_metrics_recomputed": _on_state(_ALL_METRICS),
    "stream_distinct_clients": _on_state(_DISTINCT),
    "stream_distinct_expired": _on_state(
        "SELECT CAST(event_time AS DATE) AS ref_date, bank_id, count(*) AS total_events, "
        "count(DISTINCT client_id) AS total_clients FROM state "
        "WHERE event_time >= TIMESTAMP '2024-01-16 00:00:00' GROUP BY ALL"
    ),
    "day_lookup": _on_state(_ALL_METRICS + " WHERE ref_date = DATE '2024-01-16'"),
    "stream_documents": _on_documents(_ALL_DOCUMENTS),
    "state_version": _on_feeds(f"SELECT {_STATE_OUT} FROM before"),
    "state_lookup": _on_documents(_ALL_DOCUMENTS + " WHERE client_id = 'cli-00007'"),
    "compacted_state": _on_state(f"SELECT {_STATE_OUT} FROM state"),
    "bronze_ingest": _on_items("SELECT client_id, client_name, tax_id, bank_id FROM master"),
    "partition_scan": (
        "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS events FROM events "
        "WHERE event_type IN ('purchase', 'signup') GROUP BY 1, 2"
    ),
    "interval_join": _SHIPPED,
    "stream_interval_join": _SHIPPED,
    "stream_window_counts": """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS events
FROM events
WHERE time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE
      <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 15 MINUTE FROM events)
GROUP BY 1, 2, 3""",
    "stream_dedup": "SELECT event_id, ts, user_id FROM events",
    "stream_poison_rows": """
SELECT event_id, event_type, CASE WHEN event_id % 3331 = 7 THEN 'bad event ' || event_id ELSE 'applied' END AS outcome
FROM events""",
    "stream_publish_stats": _on_log(
        "SELECT count(*) FILTER (WHERE reasons = '') AS published, count(*) FILTER (WHERE reasons <> '') AS rejected, "
        "count(*) FILTER (WHERE reasons = '') AS offsets FROM judged"
    ),
}
ORACLE["stream_publish"] = ORACLE["publish_encode"]
