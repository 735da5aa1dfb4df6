"""The registered queries as SQL over the same tables.

The SQL computes what a query must return from the source columns of the
orders; it neither encodes nor parses, so it checks those steps.
"""

from __future__ import annotations

from tillwatch.contract import EVENT_KINDS, FAILURE_REASONS, PAYMENT_ALERT_TEXT, REFUND_ALERT_TEXT
from tillwatch.plans.variants import CONTROL_TEXTS

_reasons = ", ".join(f"'{reason}'" for reason in FAILURE_REASONS)

LOG = f"""
src AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS amount,
         (o_orderkey % 100 * 37) % 100 AS draw,
         make_timestamp(1704067200000000 + o_orderkey * 50000) AS event_time,
         (o_orderkey % 223 + 1) || '.' || (o_orderkey % 256 * 7 % 256) || '.' || (o_orderkey % 256 * 11 % 256)
           || '.' || (o_orderkey % 254 * 13 % 254 + 1) AS ip
  FROM orders
),
log AS (
  SELECT k, event_time, amount, ip,
         CASE WHEN draw < 81 THEN 'payment_successful' WHEN draw < 90 THEN 'refund_processed'
              WHEN draw < 99 THEN 'payment_failed' ELSE 'refund_failed' END AS action,
         CASE WHEN draw < 90 THEN 'INFO' ELSE 'ERROR' END AS level,
         CASE WHEN draw < 81 OR (draw >= 90 AND draw < 99) THEN 'Payment' ELSE 'Refund' END AS type,
         draw >= 90 AS is_failed,
         'order_' || lpad(k::VARCHAR, 12, '0') AS order_id,
         'user_' || lpad(c::VARCHAR, 6, '0') AS user_id,
         CASE WHEN draw < 81 THEN 'pay_' || lpad(k::VARCHAR, 16, '0')
              WHEN draw < 90 THEN 'ref_' || lpad(k::VARCHAR, 16, '0') END AS payment_id,
         CASE WHEN draw >= 90 THEN [{_reasons}][k % 6 + 1] END AS fail_reason
  FROM src
),
texts AS (
  SELECT *,
         strftime(event_time, '%Y-%m-%dT%H:%M:%S')
           || CASE WHEN k % 20 <> 0 THEN strftime(event_time, '.%f') ELSE '' END || '+00:00' AS ts_text,
         CASE action
           WHEN 'payment_successful' THEN 'Payment successful for order '
           WHEN 'refund_processed' THEN 'Refund processed for order '
           WHEN 'payment_failed' THEN 'Payment FAILED for order '
           ELSE 'Refund FAILED for order ' END
         || order_id || '. Amount: $' || printf('%.2f', amount) || '. User: ' || user_id
         || CASE WHEN is_failed THEN '. Reason: ' || fail_reason
                 WHEN type = 'Payment' THEN '. Payment ID: ' || payment_id
                 ELSE '. Refund ID: ' || payment_id END
         || '. IP: ' || ip AS message
  FROM log
)"""

_TOTAL_COLUMNS = """
         date_trunc('minute', event_time) AS start,
         date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS "end",
         type, is_failed, count(*) AS event_count, round(sum(amount), 2) AS total_amount"""

TOTALS = f"{LOG},\ntotals AS (SELECT {_TOTAL_COLUMNS} FROM log GROUP BY ALL)"

ENRICHED_FIELDS = """event_time, level, type, is_failed, order_id, amount, user_id, ip AS ip_address,
       payment_id, fail_reason"""


def _alerts(*rules: tuple[str, str, bool, str]) -> str:
    parts = [
        f"""SELECT *, '{name}' AS rule, printf('{text}', event_count, total_amount) AS alert_message
FROM totals WHERE type = '{kind}' AND is_failed = {failed} AND (event_count >= 10 OR total_amount = 10000)"""
        for name, kind, failed, text in rules
    ]
    return f"WITH {TOTALS}\n" + "\nUNION ALL\n".join(parts)


_PAYMENT_RULE = ("payment_failures", "Payment", True, PAYMENT_ALERT_TEXT)
_REFUND_RULE = ("refund_volume", "Refund", False, REFUND_ALERT_TEXT)

# What the faulty versions of a record are reported as, by order key.
_FAULTS = """
faults(version, stage, error) AS (
  VALUES (3, 'frame', 'value is null'), (4, 'frame', 'no frame header'), (5, 'frame', 'no frame header'),
         (6, 'utf8', 'payload is not UTF-8'),
         (7, 'json', 'payload is not one JSON object'), (8, 'json', 'payload is not one JSON object'),
         (9, 'schema', 'timestamp is not a string'), (10, 'schema', 'level is not a string'),
         (11, 'schema', 'message is not a string'),
         (12, 'time', 'timestamp is not a time'),
         (13, 'parse', 'message is too short'), (14, 'parse', 'amount is not a number'),
         (15, 'parse', 'message is too short')
),
faulty AS (SELECT texts.*, k % 17 AS version, stage, error FROM texts LEFT JOIN faults ON k % 17 = version)"""

_ACCEPTED = f"""WITH {LOG}, {_FAULTS}
SELECT CASE WHEN stage IS NULL THEN event_time END AS event_time, level, type, is_failed, order_id, amount, user_id,
       ip AS ip_address, payment_id, fail_reason
FROM faulty WHERE stage IS NULL OR stage = 'time'"""

_QUARANTINED = f"""WITH {LOG}, {_FAULTS}
SELECT k AS order_key, 'payment' AS topic, 0 AS partition, stage, error FROM faulty WHERE stage IS NOT NULL"""

_ENRICHED = f"WITH {LOG}\nSELECT {ENRICHED_FIELDS} FROM log"
_MINUTE_TOTALS = f"WITH {TOTALS}\nSELECT * FROM totals"
_ALL_ALERTS = _alerts(_PAYMENT_RULE, _REFUND_RULE)


_ARRIVALS = f"""{LOG},
arrived AS (SELECT *, CAST(floor(k * 3 / (SELECT max(k) + 1 FROM log)) AS INTEGER) AS arrival FROM log),
added AS (
  SELECT date_trunc('minute', event_time) AS start, type, is_failed, arrival, count(*) AS n, sum(amount) AS amount
  FROM arrived GROUP BY ALL
),
totals AS (
  SELECT start, start + INTERVAL 1 MINUTE AS "end", type, is_failed,
         CAST(sum(n) OVER w AS BIGINT) AS event_count, round(sum(amount) OVER w, 2) AS total_amount, arrival
  FROM added WINDOW w AS (PARTITION BY start, type, is_failed ORDER BY arrival)
)"""

_LATE = """arrivals AS (
  SELECT * FROM log
  UNION ALL
  SELECT * FROM log
  WHERE date_trunc('minute', event_time) + INTERVAL 1 MINUTE > (SELECT max(event_time) FROM log) - INTERVAL 5 SECOND
)"""

# Levels of the control character records, as hex of their UTF-8 bytes.
_CONTROL_HEX = ", ".join(f"'{text.encode().hex().upper()}'" for text in CONTROL_TEXTS)


def oracle_sql() -> dict[str, str]:
    return {
        "event_class_counts": f"WITH {LOG} SELECT action, level, count(*) AS event_count FROM log GROUP BY ALL",
        "render_messages": f"WITH {LOG} SELECT k AS order_key, action, ts_text AS timestamp, level, message FROM texts",
        "encode_envelope": f"""WITH {LOG}
SELECT k AS order_key, 'payment' AS topic, action AS record_key,
       '0000000102' || hex(encode('{{"timestamp":"' || ts_text || '","level":"' || level
         || '","message":"' || message || '"}}')) AS value_hex
FROM texts""",
        "decode_envelope": f"""WITH {LOG}
SELECT k AS order_key, 258::BIGINT AS schema_id, ts_text AS timestamp, level, message FROM texts""",
        "validate_required": f"""WITH {LOG}, {_FAULTS}
SELECT k AS order_key,
       CASE WHEN stage IS NULL OR stage IN ('time', 'parse') THEN level END AS level,
       CASE WHEN version = 13 THEN 'Payment successful'
            WHEN version = 14 THEN replace(message, '$' || printf('%.2f', amount) || '.', '$x.')
            WHEN version = 15 THEN 'Payment successful for order ' || order_id || '. Amount: $1.00. User: u. Payment ID:'
            WHEN stage IS NULL OR stage = 'time' THEN message END AS message,
       CASE WHEN stage NOT IN ('time', 'parse') THEN stage END AS stage,
       CASE WHEN stage NOT IN ('time', 'parse') THEN error END AS error
FROM faulty""",
        "quarantine_counts": f"""WITH {LOG}, {_FAULTS}
SELECT stage, error, count(*) AS record_count FROM faulty WHERE stage IS NOT NULL GROUP BY ALL""",
        "accepted_with_faults": _ACCEPTED,
        "event_time_parse": f"""WITH {LOG},
forms AS (SELECT k, k % 8 AS form, event_time, strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS day_time,
                 date_trunc('second', event_time) AS whole FROM log)
SELECT k AS order_key,
       CASE form WHEN 0 THEN day_time || strftime(event_time, '.%f') || '+00:00' WHEN 1 THEN day_time || '+00:00'
                 WHEN 2 THEN day_time || 'Z' WHEN 3 THEN day_time || '+02:30' WHEN 4 THEN replace(day_time, 'T', ' ')
                 WHEN 5 THEN strftime(event_time, '%Y-%m-%d') WHEN 6 THEN 'garbage' ELSE '' END AS time_text,
       CASE WHEN form = 0 THEN event_time WHEN form IN (1, 2, 4) THEN whole
            WHEN form = 3 THEN whole - INTERVAL 150 MINUTE
            WHEN form = 5 THEN date_trunc('day', event_time)::TIMESTAMP END AS event_time
FROM forms""",
        "parse_message": _parsed_messages("fail_reason"),
        # the reason keeps single blanks, its dots at the end go
        "parse_untidy_message": _parsed_messages("fail_reason"),
        "enriched_events": _ENRICHED,
        "minute_totals": _MINUTE_TOTALS,
        "sparse_totals": f"""WITH {LOG},
sparse AS (SELECT CASE WHEN k % 13 <> 0 THEN event_time END AS event_time, CASE WHEN k % 7 <> 0 THEN type END AS type,
                  CASE WHEN k % 5 <> 0 THEN is_failed END AS is_failed, CASE WHEN k % 3 <> 0 THEN amount END AS amount
           FROM log)
SELECT {_TOTAL_COLUMNS} FROM sparse WHERE event_time IS NOT NULL GROUP BY ALL""",
        "payment_failure_alerts": _alerts(_PAYMENT_RULE),
        "refund_volume_alerts": _alerts(_REFUND_RULE),
        "all_alerts": _ALL_ALERTS,
        "hourly_partition_roundtrip": _ENRICHED,
        "daily_agg_roundtrip": _MINUTE_TOTALS,
        "stream_enriched_append": _ENRICHED,
        "stream_quarantine": _QUARANTINED,
        "stream_minute_totals": _MINUTE_TOTALS,
        "stream_alerts": _ALL_ALERTS,
        "stream_late_drop": f"""WITH {LOG}, {_LATE}
SELECT {_TOTAL_COLUMNS} FROM arrivals GROUP BY ALL""",
        "alerts_none": f"SELECT * FROM ({_ALL_ALERTS}) WHERE event_count >= 1000000000000000",
        "extreme_times_totals": f"""WITH {LOG},
timed AS (SELECT type, is_failed, amount,
                 CASE WHEN k % 17 = 3 THEN TIMESTAMP '9999-06-30 12:00:30' ELSE event_time END AS event_time
          FROM log WHERE k % 17 NOT IN (1, 2))
SELECT {_TOTAL_COLUMNS} FROM timed GROUP BY ALL""",
        "far_future_totals": f"""WITH {LOG},
timed AS (SELECT type, is_failed, amount,
                 CASE WHEN k % 17 = 2 THEN date_trunc('second', event_time) + INTERVAL 1 HOUR ELSE event_time END AS event_time
          FROM log WHERE k % 17 <> 1)
SELECT {_TOTAL_COLUMNS} FROM timed GROUP BY ALL""",
        "control_character_roundtrip": f"""WITH {LOG}
SELECT event_time, [{_CONTROL_HEX}][k % {len(CONTROL_TEXTS)} + 1] AS level, type, is_failed, order_id, amount, user_id,
       ip AS ip_address, payment_id, fail_reason FROM log""",
        "stream_running_totals": f"WITH {_ARRIVALS}\nSELECT * FROM totals",
        "stream_repeated_alerts": _alerts(_PAYMENT_RULE, _REFUND_RULE).replace(f"WITH {TOTALS}", f"WITH {_ARRIVALS}"),
        "stream_both_queries": f"""WITH {LOG}
SELECT type, is_failed, count(*) AS enriched_events, count(*) AS counted_events, round(sum(amount), 2) AS total_amount
FROM log GROUP BY ALL""",
        "stream_empty_batches": f"WITH {LOG}\nSELECT 2::BIGINT AS batches, 2 * count(*) AS events FROM log",
        "stream_merged_files": f"WITH {LOG}\nSELECT 2::BIGINT AS files, count(*) AS events FROM log",
        "stream_processing_time": _ENRICHED,
        "stream_dropped_events": f"""WITH {LOG}, {_LATE},
counted AS (SELECT date_trunc('minute', event_time) AS start, count(*) AS n FROM arrivals GROUP BY ALL),
seen AS (SELECT date_trunc('minute', event_time) AS start, 2 * count(*) AS n FROM log GROUP BY ALL)
SELECT start, start + INTERVAL 1 MINUTE AS "end", seen.n - counted.n AS dropped
FROM seen JOIN counted USING (start) WHERE seen.n > counted.n""",
        "exact_amount_alerts": f"""SELECT tasks, make_timestamp(1704067200000000 + k * 60000000) AS start, make_timestamp(1704067260000000 + k * 60000000) AS "end",
       'Payment' AS type, TRUE AS is_failed, n AS event_count, 10000.0::DOUBLE AS total_amount, 'payment_failures' AS rule,
       printf('{PAYMENT_ALERT_TEXT}', n, 10000.0) AS alert_message
FROM (SELECT o_orderkey // 20 AS k, count(*) AS n FROM orders GROUP BY ALL), (VALUES (1), (7), (64)) AS t(tasks)""",
        "validate_by_schema_id": f"""WITH {LOG},
found AS (SELECT *, k % 11 AS version, k % 11 NOT IN (4, 6, 7, 8, 9, 10) AS sound, k % 11 = 5 AS is_order FROM texts)
SELECT k AS order_key, CASE WHEN version = 8 THEN 9 WHEN version IN (5, 6, 7, 10) THEN 2 ELSE 1 END::BIGINT AS schema_id,
       CASE WHEN version = 8 THEN 'frame' WHEN NOT sound THEN 'schema' END AS stage,
       CASE version WHEN 4 THEN 'level is not of type string' WHEN 6 THEN 'order is not of type integer' WHEN 7 THEN 'customer is not of type object'
                    WHEN 8 THEN 'unknown schema id' WHEN 9 THEN 'level is not of type string' WHEN 10 THEN 'tags is not of type array' END AS error,
       CASE WHEN sound AND NOT is_order THEN message END AS message_text, CASE WHEN is_order THEN k::VARCHAR END AS order_text,
       CASE WHEN is_order THEN '1.5' END AS weight_text, CASE WHEN is_order THEN '{{"id":' || o_custkey || '}}' END AS customer_text,
       CASE WHEN is_order THEN '[1,2]' END AS tags_text
FROM found JOIN orders ON k = o_orderkey""",
        "restarted_totals": _MINUTE_TOTALS,
        "continued_totals": _MINUTE_TOTALS,
        "stream_chained_totals": _MINUTE_TOTALS,
        "stream_event_log": _ACCEPTED,
        "stream_event_log_quarantine": _QUARANTINED,
        "merged_hours": _ENRICHED,
        "stream_batch_counts": f"""WITH {LOG}, {_FAULTS}
SELECT 'records' AS counted, count(*) AS n FROM faulty
UNION ALL
SELECT counted, count(faulty.k) AS n FROM (VALUES ('frame'), ('utf8'), ('json'), ('schema'), ('parse'), ('time')) AS t(counted)
LEFT JOIN faulty ON stage = counted GROUP BY counted""",
        "stream_late_counts": f"""WITH {LOG}, {_LATE}, sizes AS (SELECT count(*) AS n FROM log)
SELECT 0::INTEGER AS arrival, n AS records, n AS timed, 0::BIGINT AS late FROM sizes
UNION ALL
SELECT 1 AS arrival, n AS records, n AS timed, 2 * n - (SELECT count(*) FROM arrivals) AS late FROM sizes""",
        "awaited_failure": "SELECT 'failing' AS query, count(*) AS records, TRUE AS other_runs FROM orders",
        "stream_late_enriched": f"{_ENRICHED}\nUNION ALL\nSELECT {ENRICHED_FIELDS} FROM log",
    }


def _parsed_messages(reason: str) -> str:
    return f"""WITH {LOG}
SELECT k AS order_key, type, is_failed, order_id, amount, user_id, ip AS ip_address, payment_id,
       {reason} AS fail_reason, NULL::VARCHAR AS parse_error
FROM log"""
