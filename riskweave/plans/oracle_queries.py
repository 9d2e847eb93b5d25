"""Oracle SQL per registered query name (see ``plans.oracle`` for the building blocks)."""

from __future__ import annotations

import datetime as dt

from riskweave.operators.quality import GOLD_CHECKS, SILVER_CHECKS
from riskweave.plans import oracle as O
from riskweave.plans.oracle import CHANNEL_ALIASES, VALID_CHANNELS, VALID_TRANSACTION_TYPES, _d, _in, features_ctes, with_steps

META = "'1998-07-01' AS _ingestion_date, '2.4.0' AS _pipeline_version, 'CBS_NIGHTLY_EXPORT' AS _source_system"
SILVER_TABLE = "silver/financial/transactions_clean"
GOLD_TABLE = "gold/risk/credit_risk_features"

# Row predicates of the quality gates, written independently of the Spark catalogue.
SILVER_FAILS = {
    "null_transaction_id": "count(*) FILTER (WHERE transaction_id IS NULL)",
    "null_account_number": "count(*) FILTER (WHERE account_number IS NULL)",
    "negative_amount": "count(*) FILTER (WHERE amount_usd < 0)",
    "invalid_transaction_type": f"count(*) FILTER (WHERE NOT (transaction_type IN {_in(VALID_TRANSACTION_TYPES)}))",
    "invalid_channel": f"count(*) FILTER (WHERE NOT (transaction_channel IN {_in(VALID_CHANNELS)}))",
    "future_transaction_date": f"count(*) FILTER (WHERE transaction_date > {_d(O.RUN_DATE)})",
    "missing_sar_flag": "count(*) FILTER (WHERE amount_usd >= 10000 AND _flag_sar_eligible = false)",
    "duplicate_transaction_id": "count(*) - count(DISTINCT transaction_id)"
                                " - coalesce(max(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END), 0)",
}
GOLD_FAILS = {
    "null_account_features": "count(*) FILTER (WHERE txn_count_30d IS NULL)",
    "negative_feature_values": "count(*) FILTER (WHERE txn_count_7d < 0 OR txn_total_amount_30d < 0)",
    "online_ratio_out_of_range": "count(*) FILTER (WHERE online_txn_ratio_30d < 0 OR online_txn_ratio_30d > 1)",
    "feature_date_consistency": "count(*) FILTER (WHERE feature_date IS NULL)",
}


def _gate(table: str, src: str, info: dict, fails: dict) -> str:
    parts = []
    for name, (threshold, severity, description) in info.items():
        desc = description.replace("'", "''")
        parts.append(
            f"SELECT '{table}' AS table_path, '{name}' AS check_name, '{desc}' AS description, "
            f"CAST({fails[name]} AS BIGINT) AS failing_count, CAST({threshold} AS BIGINT) AS threshold, "
            f"'{severity.value}' AS severity, ({fails[name]}) <= {threshold} AS passed, "
            f"'{O.RUN_DATE.isoformat()}' AS run_date FROM {src}"
        )
    return "\nUNION ALL\n".join(parts)


def _features_one(days: int) -> str:
    return with_steps("SELECT * FROM feat", extra=features_ctes(O.FEATURE_DATE, windows=(days,), ratios=False))


def _upsert_txn() -> str:
    order = "ORDER BY load_seq DESC, load_tie DESC, load_tie2 DESC"
    extra = {
        "tgt": f"SELECT * FROM valid WHERE transaction_date <= {_d(O.UPSERT_TARGET_UNTIL)} "
               f"QUALIFY row_number() OVER (PARTITION BY transaction_id {order}) = 1",
        "src": f"SELECT * FROM valid WHERE transaction_date >= {_d(O.UPSERT_SOURCE_FROM)} "
               f"QUALIFY row_number() OVER (PARTITION BY transaction_id {order}) = 1",
    }
    body = ("SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.transaction_id = tgt.transaction_id)\n"
            "UNION ALL SELECT * FROM src")
    return with_steps(body, upto="latest", extra=extra)


def _upsert_features() -> str:
    d0, d1, d2 = O.UPSERT_FEATURE_DATES
    extra = {"stale": f"SELECT * FROM silver WHERE transaction_date <= {_d(O.FEATURES_STALE_CUTOFF)}"}
    extra.update(features_ctes(d0, prefix="a_"))
    extra.update(features_ctes(d1, src="stale", prefix="b_"))
    extra.update(features_ctes(d1, prefix="c_"))
    extra.update(features_ctes(d2, prefix="d_"))
    extra["tgt"] = "SELECT * FROM a_feat UNION ALL SELECT * FROM b_feat"
    extra["src"] = "SELECT * FROM c_feat UNION ALL SELECT * FROM d_feat"
    body = ("SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.account_number = tgt.account_number "
            "AND src.feature_date = tgt.feature_date)\nUNION ALL SELECT * FROM src")
    return with_steps(body, extra=extra)


ALIASES_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in sorted(CHANNEL_ALIASES.items()))
LB = f"transaction_date BETWEEN {_d(O.FEATURE_DATE - dt.timedelta(days=95))} AND {_d(O.FEATURE_DATE)}"

ORACLE = {
    "landing_valid": with_steps(f"SELECT *, {META} FROM valid", upto="valid"),
    "landing_quarantine": with_steps(f"SELECT *, {META} FROM rejected", upto="rejected"),
    "keep_latest": with_steps("SELECT * FROM latest", upto="latest"),
    "standardise": with_steps("SELECT * FROM standard", upto="standard"),
    "channel_lookup_join": with_steps(
        "SELECT l.transaction_id, coalesce(a.channel, upper(trim(l.transaction_channel))) AS transaction_channel "
        "FROM latest l LEFT JOIN aliases a ON upper(trim(l.transaction_channel)) = a.alias",
        upto="latest", extra={"aliases": f"SELECT * FROM (VALUES {ALIASES_VALUES}) AS t(alias, channel)"}),
    "currency_flag": with_steps("SELECT transaction_id, currency_code, _flag_unsupported_currency FROM silver"),
    "account_token": with_steps(
        "SELECT transaction_id, account_number, sha256(account_number || 'RISK_SALT_V3') AS account_number_token "
        "FROM latest", upto="latest"),
    "risk_flags": with_steps(
        "SELECT transaction_id, amount_usd, transaction_hour, merchant_category_code, _flag_sar_eligible, "
        "_flag_high_risk_mcc, _flag_round_amount, _flag_off_hours_high_value, _silver_pipeline_ver FROM silver"),
    "day_slice": with_steps(f"SELECT * FROM silver WHERE transaction_date = {_d(O.DAY)}"),
    "lookback_slice": with_steps(f"SELECT * FROM silver WHERE {LB}"),
    "features_7d": _features_one(7),
    "features_30d": _features_one(30),
    "features_90d": _features_one(90),
    "features_wide": O.features_sql(),
    "accounts_latest_customer": with_steps("SELECT * FROM acc", extra=features_ctes(O.FEATURE_DATE, windows=())),
    "duplicate_keys": with_steps(
        "SELECT CAST(count(*) - count(DISTINCT transaction_id) - coalesce(max(CASE WHEN transaction_id IS NULL "
        "THEN 1 ELSE 0 END), 0) AS BIGINT) AS duplicate_count FROM txn", upto="txn"),
    "upsert_txn": _upsert_txn(),
    "upsert_features": _upsert_features(),
    "dq_silver": with_steps(_gate(SILVER_TABLE, "silver", SILVER_CHECKS, SILVER_FAILS)),
    "dq_gold": with_steps(_gate(GOLD_TABLE, "feat", GOLD_CHECKS, GOLD_FAILS), extra=features_ctes(O.FEATURE_DATE)),
    "dq_audit_rows": with_steps(
        _gate(SILVER_TABLE, "silver", SILVER_CHECKS, SILVER_FAILS) + "\nUNION ALL\n"
        + _gate(GOLD_TABLE, "feat", GOLD_CHECKS, GOLD_FAILS), extra=features_ctes(O.FEATURE_DATE)),
}



FLAGS_SQL = """coalesce(amount_usd >= 10000, false) AS _flag_sar_threshold,
  coalesce(is_international = true AND amount_usd >= 5000, false) AS _flag_international_high_value,
  coalesce(transaction_channel = 'ONLINE' AND ip_country <> originating_country, false) AS _flag_ip_country_mismatch"""
PARSED_SQL = f"""SELECT transaction_id, account_number, customer_id, transaction_datetime, transaction_type,
  transaction_channel, amount_usd, CAST(NULL AS VARCHAR) AS currency_code, originating_country, is_international,
  CAST(NULL AS VARCHAR) AS merchant_category_code, CAST(NULL AS VARCHAR) AS merchant_name,
  CAST(NULL AS VARCHAR) AS device_fingerprint, ip_country, event_sequence_num,
  transaction_datetime + INTERVAL 5 SECOND AS enqueuedTime, event_sequence_num AS sequenceNumber,
  CAST(event_sequence_num AS VARCHAR) AS "offset", transaction_datetime + INTERVAL 5 SECOND AS _event_ingested_at,
  event_sequence_num AS _event_sequence, 'STREAM_EH_CONSUMER' AS _pipeline,
  {FLAGS_SQL}
FROM ev"""
# A corrupt body has no payload at all; it and an event without an id land with each of three deliveries.
PAYLOAD = ("transaction_id customer_id account_number transaction_datetime transaction_type transaction_channel amount_usd "
           "currency_code originating_country is_international merchant_category_code merchant_name device_fingerprint "
           "ip_country event_sequence_num").split()
EMPTY = ", ".join(f"NULL AS {c}" for c in PAYLOAD)
NO_FLAGS = ("false AS _flag_sar_threshold, false AS _flag_international_high_value, false AS _flag_ip_country_mismatch")
DELIVERED_SQL = f"""SELECT * FROM parsed WHERE "sequenceNumber" % 53 <> 0 AND "sequenceNumber" % 59 <> 0
UNION ALL SELECT * EXCLUDE (copy_no) REPLACE (NULL AS transaction_id) FROM parsed, range(3) AS r(copy_no)
  WHERE "sequenceNumber" % 53 <> 0 AND "sequenceNumber" % 59 = 0
UNION ALL SELECT * EXCLUDE (copy_no) REPLACE ({EMPTY}, {NO_FLAGS}) FROM parsed, range(3) AS r(copy_no)
  WHERE "sequenceNumber" % 53 = 0"""
VELOCITY_SQL = """SELECT *, count(*) OVER (PARTITION BY account_number ORDER BY transaction_datetime
    RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS velocity_count FROM ev"""


def _ev(body: str, extra: dict[str, str] | None = None) -> str:
    ctes = {"ev": O.duck(O.EVENT_TXN_SQL)}
    ctes.update(extra or {})
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body


ORACLE.update({
    "event_parse_flags": _ev("SELECT * FROM parsed", {"parsed": PARSED_SQL}),
    "stream_landing": _ev("SELECT *, CAST(_event_ingested_at AS DATE) AS ingestion_date FROM parsed",
                          {"parsed": PARSED_SQL}),
    "stream_dedup": _ev("SELECT *, CAST(_event_ingested_at AS DATE) AS ingestion_date FROM delivered",
                        {"parsed": PARSED_SQL, "delivered": DELIVERED_SQL}),
    "velocity_breach": _ev("SELECT transaction_id, account_number, transaction_datetime, velocity_count, "
                           "velocity_count > 5 AS _flag_velocity_breach FROM vel", {"vel": VELOCITY_SQL}),
    "route_by_score": with_steps(
        "SELECT account_number, customer_id, online_txn_ratio_30d, feature_date FROM feat "
        "WHERE online_txn_ratio_30d > 0.75", extra=features_ctes(O.FEATURE_DATE)),
    "fraud_signals": _ev(
        f"""SELECT account_number, CAST(transaction_datetime AS DATE) AS signal_date, count(*) AS txn_count,
          count(*) FILTER (WHERE _flag_sar_threshold) AS sar_threshold_count,
          count(*) FILTER (WHERE _flag_international_high_value) AS intl_high_value_count,
          count(*) FILTER (WHERE _flag_ip_country_mismatch) AS ip_mismatch_count,
          count(*) FILTER (WHERE velocity_count > 5) AS velocity_breach_count,
          max(velocity_count) AS max_velocity_count
        FROM (SELECT *, {FLAGS_SQL} FROM vel) GROUP BY account_number, CAST(transaction_datetime AS DATE)""",
        {"vel": VELOCITY_SQL}),
})


ORACLE.update({
    "compacted": with_steps("SELECT *, true AS untouched_when_done FROM silver"),
    "clustered": with_steps("SELECT * FROM silver"),
    "daily_chain": O.features_sql(),
    "table_detail": with_steps("SELECT count(*) AS num_rows, true AS fragmented, true AS has_bytes, true AS has_change FROM silver"),
    "skipping_report": with_steps(
        "SELECT 'unclustered' AS layout, count(*) AS rows_found, false AS skips_half FROM silver WHERE account_number = 'A42'\n"
        "UNION ALL SELECT 'clustered', count(*), true FROM silver WHERE account_number = 'A42'"),
    "skipping_index": with_steps("SELECT *, true AS same_as_scan, true AS only_new_scanned, true AS skips_half FROM silver WHERE account_number = 'A42'"),
    "layout_run": with_steps(
        "SELECT 'transactions' AS table_name, 'success' AS status, true AS has_files, CAST(NULL AS BOOLEAN) AS has_error, "
        "count(*) AS num_rows FROM silver UNION ALL SELECT 'missing', 'failed', false, true, NULL"),
})

ORDER = "ORDER BY load_seq DESC, load_tie DESC, load_tie2 DESC"
LATEST = f"QUALIFY row_number() OVER (PARTITION BY transaction_id {ORDER}) = 1"
MONTH = "CAST(date_trunc('month', transaction_date) AS DATE)"


def _merge_existing() -> str:
    extra = {
        "tgt": f"SELECT *, {MONTH} AS month FROM valid WHERE transaction_date <= {_d(O.UPSERT_TARGET_UNTIL)} {LATEST}",
        "src": f"""SELECT * EXCLUDE (merchant_name), CASE WHEN load_seq % 41 = 0 THEN NULL
                   WHEN load_seq % 7 = 0 THEN CAST({MONTH} + INTERVAL 1 MONTH AS DATE) ELSE {MONTH} END AS month,
                   'late' AS batch FROM valid WHERE transaction_date >= {_d(O.UPSERT_SOURCE_FROM)} {LATEST}""",
    }
    body = """SELECT tgt.*, CAST(NULL AS VARCHAR) AS batch FROM tgt ANTI JOIN src USING (transaction_id)
              UNION ALL BY NAME SELECT src.*, tgt.merchant_name FROM src LEFT JOIN tgt USING (transaction_id)"""
    return with_steps(body, upto="valid", extra=extra)


MERGE_WIDENED = f"""SELECT transaction_id, {MONTH} AS month, true AS refused,
      CASE WHEN load_seq % 3 <> 0 THEN account_number END AS account_number,
      CAST(CASE WHEN load_seq % 5 = 0 THEN load_seq + 0.25 WHEN load_seq % 2 = 0 THEN load_seq + 5000000000 ELSE load_seq END AS DOUBLE) AS units
      FROM latest WHERE load_seq % 3 <> 0 OR load_seq % 2 = 0 OR load_seq % 5 = 0"""


FOLD = "DATE '1998-03-27' + CAST((transaction_date - DATE '1992-01-01') % 96 AS INTEGER)"


def _chain_two_days() -> str:
    """Both landings in plain SQL: bronze replaces matched ids, cleansing takes the days touched."""
    gone = "transaction_id IN (SELECT transaction_id FROM land2)"
    extra = {
        "folded": f"SELECT * REPLACE ({FOLD} AS transaction_date) FROM valid",
        "land1": "SELECT * FROM folded WHERE load_seq % 3 <> 0",
        "land2": "SELECT * FROM folded WHERE load_seq % 3 = 0",
        "days2": f"SELECT transaction_date FROM land2 UNION SELECT transaction_date FROM land1 WHERE {gone}",
        "batch2": f"""SELECT * FROM (SELECT * FROM land1 WHERE NOT ({gone}) UNION ALL SELECT * FROM land2)
                      WHERE transaction_date IN (SELECT transaction_date FROM days2) {LATEST}""",
        "kept1": f"SELECT * FROM land1 {LATEST}",
        "latest": """SELECT * FROM kept1 WHERE transaction_id NOT IN (SELECT transaction_id FROM batch2)
                     UNION ALL SELECT * FROM batch2""",
        "standard": O.STEPS["standard"], "silver": O.STEPS["silver"],
        **features_ctes(O.FEATURE_DATE),
    }
    return with_steps("SELECT * FROM feat", upto="valid", extra=extra)


def _row_counts() -> str:
    """Both landings in plain SQL: a landed id replaces its stored copies, and the days touched are cleansed again."""
    gone = "transaction_id IN (SELECT transaction_id FROM land2)"
    lookback = f"transaction_date BETWEEN {_d(O.FEATURE_DATE)} - INTERVAL 95 DAY AND {_d(O.FEATURE_DATE)}"
    extra = {
        "folded": f"SELECT * REPLACE ({FOLD} AS transaction_date) FROM valid",
        "land1": "SELECT * FROM folded WHERE load_seq % 3 <> 0",
        "land2": "SELECT * FROM folded WHERE load_seq % 3 = 0",
        "kept1": f"SELECT * FROM land1 {LATEST}",
        "days2": f"SELECT transaction_date FROM land2 UNION SELECT transaction_date FROM land1 WHERE {gone}",
        "batch2": f"""SELECT * FROM (SELECT * FROM land1 WHERE NOT ({gone}) UNION ALL SELECT * FROM land2)
                      WHERE transaction_date IN (SELECT transaction_date FROM days2)""",
        "kept2": f"SELECT * FROM batch2 {LATEST}",
        "silver2": """SELECT * FROM kept1 WHERE transaction_id NOT IN (SELECT transaction_id FROM kept2)
                      UNION ALL SELECT * FROM kept2""",
    }
    out = []
    for run, rows, mine, read, kept, clean in (("DATE '1998-07-01'", "load_seq % 3 <> 0", "land1", "land1", "kept1", "kept1"),
                                               ("DATE '1998-07-02'", "load_seq % 3 = 0", "land2", "batch2", "kept2", "silver2")):
        n = {("landing", "landed"): f"SELECT count(*) FROM txn WHERE {rows}", ("landing", "valid"): f"SELECT count(*) FROM {mine}",
             ("landing", "quarantined"): f"SELECT (SELECT count(*) FROM txn WHERE {rows}) - (SELECT count(*) FROM {mine})",
             ("cleansing", "read"): f"SELECT count(*) FROM {read}", ("cleansing", "kept"): f"SELECT count(*) FROM {kept}",
             ("cleansing", "duplicates"): f"SELECT (SELECT count(*) FROM {read}) - (SELECT count(*) FROM {kept})",
             ("features", "lookback"): f"SELECT count(*) FROM {clean} WHERE {lookback}"}
        out += [f"SELECT '{step}' AS step, '{name}' AS count_name, ({sql}) AS row_count, {run} AS run_date" for (step, name), sql in n.items()]
    return with_steps("\nUNION ALL\n".join(out), upto="valid", extra=extra)


def _audit(name: str, count: str, threshold: int, severity: str, text: str) -> str:
    return (f"SELECT 'bronze/financial/transactions' AS table_path, '{name}' AS check_name, '{text}' AS description, "
            f"CAST({count} AS BIGINT) AS failing_count, CAST({threshold} AS BIGINT) AS threshold, '{severity}' AS severity, "
            f"false AS passed, '1998-07-01' AS run_date FROM txn")


ORACLE.update({
    "merge_existing": _merge_existing(),
    "merge_widened": with_steps(MERGE_WIDENED, upto="latest"),
    "chain_two_days": _chain_two_days(),
    "features_incremental": O.features_sql(),
    "row_counts": _row_counts(),
    "quarantine_table": ORACLE["landing_quarantine"],
    "dq_raising_rule": with_steps("\nUNION ALL\n".join([
        _audit("missing_amount", "count(*) FILTER (WHERE amount_usd IS NULL)", 0, "WARNING", "Rows without an amount."),
        _audit("raising_rule", "any_value(-1)", 0, "CRITICAL", "A rule that raises."),
        _audit("null_measure", "any_value(-1)", 5, "CRITICAL", "A measure without a value."),
        _audit("all_rows", "count(*)", 0, "CRITICAL", "Every row counts."),
    ]), upto="txn"),
    "fraud_signals_job": ORACLE["fraud_signals"],
    "fraud_signals_stream": ORACLE["fraud_signals"],
    "velocity_stream": ORACLE["velocity_breach"],
    "stream_landing_once": ORACLE["stream_dedup"],
})
