"""DuckDB twins of the registered queries.

Each builder returns SQL over the driver's pre-registered views. The adapters
are the same text Spark runs (``sources.adapters``); the operator steps are
written here independently in plain SQL, in the reference's per-step shape
(for features: one aggregate and one left join per window), so they check the
Spark operators rather than repeat them.

Money sums are exact DECIMAL sums cast to DOUBLE, which is what the Spark
operators compute with integer cents; stddev columns are rounded to 6 places on
both sides (different but equally valid summation orders).
"""

from __future__ import annotations

import datetime as dt

from riskweave.settings import RiskSettings
from riskweave.sources.adapters import EVENT_TXN_SQL, TXN_SQL, duck  # noqa: F401

FEATURE_DATE = dt.date(1998, 6, 30)
DAY = dt.date(1998, 6, 30)
RUN_DATE = dt.date(1998, 7, 1)
UPSERT_TARGET_UNTIL = dt.date(1998, 6, 30)
UPSERT_SOURCE_FROM = dt.date(1998, 6, 1)
FEATURES_STALE_CUTOFF = dt.date(1998, 6, 20)
UPSERT_FEATURE_DATES = (dt.date(1998, 5, 31), dt.date(1998, 6, 30), dt.date(1998, 7, 31))
STDDEV_PLACES = 6
SETTINGS = RiskSettings(token_salt="RISK_SALT_V3")  # of the registered queries

# Fixed values, spelled out here so that a wrong code in the settings does not match itself.
ACCEPTED_CURRENCIES = ("USD", "EUR", "GBP", "CAD", "JPY", "AUD", "CHF", "HKD", "SGD", "MXN")
HIGH_RISK_MCC = ("6010", "6011", "7995", "5912", "6051")
CHANNEL_ALIASES = {"WEB": "ONLINE", "INTERNET": "ONLINE", "MOB": "MOBILE", "APP": "MOBILE", "TLR": "BRANCH", "TELLER": "BRANCH"}
VALID_TRANSACTION_TYPES = ("CREDIT", "DEBIT", "TRANSFER", "FEE", "REVERSAL")
VALID_CHANNELS = ("ONLINE", "MOBILE", "ATM", "BRANCH", "PHONE")


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _d(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def money(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


CHANNEL_CASE = (
    "CASE upper(trim(transaction_channel)) "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(CHANNEL_ALIASES.items()))
    + " ELSE upper(trim(transaction_channel)) END"
)

STEPS = {
    "txn": duck(TXN_SQL),
    "valid": """SELECT * FROM txn WHERE NOT (transaction_id IS NULL OR account_number IS NULL
                 OR amount_usd IS NULL OR amount_usd < 0)""",
    "rejected": """SELECT *, true AS _is_quarantined FROM txn WHERE transaction_id IS NULL OR account_number IS NULL
                 OR amount_usd IS NULL OR amount_usd < 0""",
    "latest": """SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY transaction_id
                 ORDER BY load_seq DESC, load_tie DESC, load_tie2 DESC) = 1""",
    "standard": f"""SELECT * REPLACE (
                   upper(trim(transaction_type)) AS transaction_type,
                   {CHANNEL_CASE} AS transaction_channel,
                   coalesce(upper(trim(currency_code)), 'USD') AS currency_code,
                   coalesce(upper(trim(originating_country)), 'US') AS originating_country,
                   coalesce(is_international, false) AS is_international,
                   round(amount_usd, 2) AS amount_usd,
                   round(account_balance_usd, 2) AS account_balance_usd),
                 CAST(hour(transaction_datetime) AS INTEGER) AS transaction_hour
                 FROM latest""",
    "silver": f"""SELECT *,
                   NOT (currency_code IN {_in(ACCEPTED_CURRENCIES)}) AS _flag_unsupported_currency,
                   sha256(account_number || 'RISK_SALT_V3') AS account_number_token,
                   coalesce(amount_usd >= 10000, false) AS _flag_sar_eligible,
                   merchant_category_code IN {_in(HIGH_RISK_MCC)} AS _flag_high_risk_mcc,
                   coalesce(amount_usd % 1000 = 0 AND amount_usd >= 5000, false) AS _flag_round_amount,
                   coalesce(transaction_hour BETWEEN 0 AND 5 AND amount_usd >= 2000, false)
                     AS _flag_off_hours_high_value,
                   '1.6.0' AS _silver_pipeline_ver
                 FROM standard""",
}
STEP_ORDER = ("txn", "valid", "rejected", "latest", "standard", "silver")


def with_steps(body: str, upto: str = "silver", extra: dict[str, str] | None = None) -> str:
    names = STEP_ORDER[: STEP_ORDER.index(upto) + 1]
    ctes = [f"{n} AS ({STEPS[n]})" for n in names]
    for n, q in (extra or {}).items():
        ctes.append(f"{n} AS ({q})")
    return "WITH " + ",\n".join(ctes) + "\n" + body


def window_sql(src: str, fd: dt.date, days: int) -> str:
    s = f"{days}d"
    cut = fd - dt.timedelta(days=days)
    f = "count(*) FILTER (WHERE {})"
    cols = [
        f"count(transaction_id) AS txn_count_{s}",
        f"{money('amount_usd')} AS txn_total_amount_{s}",
        f"CASE WHEN count(amount_usd) > 0 THEN {money('amount_usd')} / count(amount_usd) END AS txn_avg_amount_{s}",
        f"max(amount_usd) AS txn_max_amount_{s}",
        f"round(stddev_samp(amount_usd), {STDDEV_PLACES}) AS txn_stddev_amount_{s}",
        f.format("transaction_channel = 'ONLINE'") + f" AS online_txn_count_{s}",
        f.format("transaction_channel = 'ATM'") + f" AS atm_txn_count_{s}",
        f.format("transaction_channel = 'BRANCH'") + f" AS branch_txn_count_{s}",
        f.format("transaction_channel = 'MOBILE'") + f" AS mobile_txn_count_{s}",
        f"{money('CASE WHEN is_international THEN amount_usd ELSE 0 END')} AS intl_amount_{s}",
        f.format("is_international") + f" AS intl_txn_count_{s}",
        f.format("_flag_sar_eligible") + f" AS sar_flag_count_{s}",
        f.format("_flag_high_risk_mcc") + f" AS high_risk_mcc_count_{s}",
        f.format("_flag_round_amount") + f" AS round_amount_count_{s}",
        f.format("_flag_off_hours_high_value") + f" AS off_hours_count_{s}",
        f"CASE WHEN count(account_balance_usd) > 0 THEN {money('account_balance_usd')} / count(account_balance_usd) END"
        f" AS avg_balance_{s}",
        f"min(account_balance_usd) AS min_balance_{s}",
        f.format("dayofweek(transaction_date) IN (0, 6)") + f" AS weekend_txn_count_{s}",
        f"count(DISTINCT transaction_date) AS active_days_{s}",
    ]
    return (
        f"SELECT account_number, {', '.join(cols)} FROM {src} "
        f"WHERE transaction_date >= {_d(cut)} GROUP BY account_number"
    )


RATIOS_SQL = """
  CASE WHEN txn_count_30d > 0 THEN online_txn_count_30d / txn_count_30d ELSE CAST(0 AS DOUBLE) END
    AS online_txn_ratio_30d,
  CASE WHEN txn_count_90d > 0 THEN intl_txn_count_90d / txn_count_90d ELSE CAST(0 AS DOUBLE) END
    AS intl_txn_ratio_90d,
  CASE WHEN txn_count_30d > 0 THEN (txn_count_7d / CAST(7 AS DOUBLE)) / (txn_count_30d / CAST(30 AS DOUBLE))
    ELSE CAST(1 AS DOUBLE) END AS velocity_ratio_7d_vs_30d,
  CASE WHEN active_days_30d > 0 THEN txn_count_30d / active_days_30d ELSE CAST(0 AS DOUBLE) END
    AS avg_daily_txn_count_30d"""


def features_ctes(fd: dt.date, windows=(7, 30, 90), src: str = "silver", prefix: str = "",
                  ratios: bool = True) -> dict[str, str]:
    """CTEs ending in ``{prefix}feat``: the per-window join form of the feature table."""
    lo = fd - dt.timedelta(days=95)
    p = prefix
    ctes = {
        f"{p}lb": f"SELECT * FROM {src} WHERE transaction_date BETWEEN {_d(lo)} AND {_d(fd)}",
        f"{p}acc": f"""SELECT account_number, customer_id FROM {p}lb QUALIFY row_number() OVER (
                  PARTITION BY account_number ORDER BY transaction_datetime DESC NULLS LAST,
                  transaction_id DESC NULLS LAST) = 1""",
    }
    for w in windows:
        ctes[f"{p}w{w}"] = window_sql(f"{p}lb", fd, w)
    joins = " ".join(f"LEFT JOIN {p}w{w} USING (account_number)" for w in windows)
    ctes[f"{p}wide"] = f"SELECT * FROM {p}acc {joins}"
    if ratios:
        ctes[f"{p}feat"] = (
            f"SELECT *, {RATIOS_SQL}, '{fd.isoformat()}' AS feature_date, '3.1.0' AS _pipeline_version FROM {p}wide"
        )
    else:
        ctes[f"{p}feat"] = f"SELECT * FROM {p}wide"
    return ctes


def features_sql(fd: dt.date = FEATURE_DATE) -> str:
    return with_steps("SELECT * FROM feat", extra=features_ctes(fd))


def event_steps() -> dict[str, str]:
    return {"ev": duck(EVENT_TXN_SQL)}


VALID_SETS = {"types": _in(VALID_TRANSACTION_TYPES), "channels": _in(VALID_CHANNELS)}
