"""Registered queries: one per operator, each over the whole driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the DuckDB twin in ``plans.oracle_sql``. Timestamps that record "now"
(ingestion, processing, creation time) are pinned or left out of the compared
output, since no oracle can reproduce a clock.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import cleanse as CL
from riskweave.operators.cleanse import cleanse
from riskweave.operators.dedup import CROWDED, duplicate_keys, keep_latest, latest_in_files
from riskweave.operators.features import (
    account_features,
    day_slice,
    latest_customer,
    lookback_slice,
    window_features,
)
from riskweave.operators.quality import gold_checks, run_checks, silver_checks
from riskweave.operators.upsert import upsert
from riskweave.operators.validate import split_invalid
from riskweave.plans.oracle import (
    DAY,
    RUN_DATE,
    SETTINGS,
    FEATURE_DATE,
    FEATURES_STALE_CUTOFF,
    STDDEV_PLACES,
    UPSERT_SOURCE_FROM,
    UPSERT_TARGET_UNTIL,
    UPSERT_FEATURE_DATES,
)
from riskweave.session import scratch_path, shared_dir
from riskweave.settings import CHANNEL_ALIASES, Zones
from riskweave.sources import adapters
from riskweave.sources.landing import with_metadata
from riskweave.sources.tables import delete_path, read_partitions


VOLATILE = ("_ingestion_timestamp", "_silver_processed_at", "_feature_created_at")


def stable(df: DataFrame) -> DataFrame:
    """Drop clock columns; round stddev columns (summation order differs between engines)."""
    out = df.drop(*[c for c in VOLATILE if c in df.columns])
    rounded = {c: F.round(F.col(c), STDDEV_PLACES) for c in out.columns if c.startswith("txn_stddev_amount")}
    return out.withColumns(rounded) if rounded else out


def raw_txn(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.transactions(spark, sf)


def silver(spark: SparkSession, sf: str) -> DataFrame:
    """Landing validation, keep-latest and cleansing over the whole adapter table."""
    return cleanse(latest(spark, sf), SETTINGS)


@contextmanager
def silver_in_files(spark: SparkSession, sf: str) -> Iterator[DataFrame]:
    """``silver`` for a query that stores it: its whole rows are not shuffled, but stay in the tasks that read the table. To be
    written within the context, which holds the bitmaps that say which rows stay."""
    masks = scratch_path(spark, "latest")
    valid, _ = split_invalid(adapters.transactions(spark, sf, placed=True))
    try:
        rows = latest_in_files(valid, ["transaction_id"], adapters.TXN_LOAD_ORDER, masks, CROWDED)
        yield silver(spark, sf) if rows is None else cleanse(rows, SETTINGS)
    finally:
        delete_path(spark, masks)


def stored_silver(spark: SparkSession, sf: str, first: dt.date, last: dt.date) -> DataFrame:
    """The days ``first`` to ``last`` of the curated table, stored by transaction date in each call."""
    path = scratch_path(spark, "silver-by-date")
    # Rows move to their day and are sorted before cleansing, which adds columns (a token of 64 digits) but changes neither day nor account.
    place = ("transaction_date", "account_number")
    cur = cleanse(latest(spark, sf, whole=True, place=place).sortWithinPartitions(*place), SETTINGS)
    cur.write.partitionBy("transaction_date").parquet(path)
    days = [(first + dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]
    return read_partitions(spark, path, cur.schema, "transaction_date", days)


def lookback(spark: SparkSession, sf: str) -> DataFrame:
    return stored_silver(spark, sf, FEATURE_DATE - dt.timedelta(days=95), FEATURE_DATE)


def latest(spark: SparkSession, sf: str, whole: bool = False, place: Sequence[str] | None = None) -> DataFrame:
    valid, _ = split_invalid(raw_txn(spark, sf))
    return keep_latest(valid, ["transaction_id"], adapters.TXN_LOAD_ORDER, CROWDED, place, whole=whole)


def q_landing_valid(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = split_invalid(with_metadata(raw_txn(spark, sf), RUN_DATE))
    return stable(valid)


def q_landing_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = split_invalid(with_metadata(raw_txn(spark, sf), RUN_DATE))
    return stable(rejected)


def q_keep_latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest(spark, sf)


def q_standardise(spark: SparkSession, sf: str) -> DataFrame:
    return CL.standardise(latest(spark, sf))


def q_channel_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    """C4 table form: an alias table joined to every transaction's cleaned channel code."""
    aliases = spark.createDataFrame(sorted(CHANNEL_ALIASES.items()), "alias string, channel string")
    codes = latest(spark, sf).select(
        "transaction_id", F.upper(F.trim("transaction_channel")).alias("transaction_channel"))
    return CL.channel_lookup_join(codes, aliases)


def q_currency_flag(spark: SparkSession, sf: str) -> DataFrame:
    out = CL.currency_flag(CL.standardise(latest(spark, sf)))
    return out.select("transaction_id", "currency_code", "_flag_unsupported_currency")


def q_account_token(spark: SparkSession, sf: str) -> DataFrame:
    return CL.tokenise(latest(spark, sf), settings=SETTINGS).select("transaction_id", "account_number", "account_number_token")


def q_risk_flags(spark: SparkSession, sf: str) -> DataFrame:
    out = CL.risk_flags(CL.standardise(latest(spark, sf)))
    return out.select("transaction_id", "amount_usd", "transaction_hour", "merchant_category_code",
                      "_flag_sar_eligible", "_flag_high_risk_mcc", "_flag_round_amount",
                      "_flag_off_hours_high_value", "_silver_pipeline_ver")


def q_day_slice(spark: SparkSession, sf: str) -> DataFrame:
    return stable(day_slice(stored_silver(spark, sf, DAY, DAY), DAY))


def q_lookback_slice(spark: SparkSession, sf: str) -> DataFrame:
    return stable(lookback_slice(lookback(spark, sf), FEATURE_DATE, 95))


def _features_one(days: int):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return stable(window_features(lookback(spark, sf), FEATURE_DATE, windows=(days,)))

    q.__name__ = f"q_features_{days}d"
    return q


def q_features_wide(spark: SparkSession, sf: str) -> DataFrame:
    return stable(account_features(lookback(spark, sf), FEATURE_DATE))


def q_accounts_latest_customer(spark: SparkSession, sf: str) -> DataFrame:
    return latest_customer(lookback(spark, sf), FEATURE_DATE)


def q_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(raw_txn(spark, sf), "transaction_id")


def q_upsert_txn(spark: SparkSession, sf: str) -> DataFrame:
    """C2: a snapshot up to one day merged with a later batch that overlaps it.

    Together the two cover every valid row; keys in the overlap are matched
    (some moving to another transaction_date), later ones are inserted, earlier
    ones are untouched.
    """
    valid, _ = split_invalid(raw_txn(spark, sf))
    order = adapters.TXN_LOAD_ORDER
    target = keep_latest(valid.filter(F.col("transaction_date") <= F.lit(UPSERT_TARGET_UNTIL)),
                         ["transaction_id"], order)
    source = keep_latest(valid.filter(F.col("transaction_date") >= F.lit(UPSERT_SOURCE_FROM)),
                         ["transaction_id"], order)
    return upsert(target, source, ["transaction_id"])


def q_upsert_features(spark: SparkSession, sf: str) -> DataFrame:
    """C3 on (account_number, feature_date): stored features for two dates, one recomputed
    after late rows arrived, merged with a new batch holding that date and the next."""
    shared_dir(spark)
    cur = silver(spark, sf).checkpoint(eager=True)  # the stored silver table, read four times
    stale = cur.filter(F.col("transaction_date") <= F.lit(FEATURES_STALE_CUTOFF))
    d0, d1, d2 = UPSERT_FEATURE_DATES
    target = account_features(cur, d0).unionByName(account_features(stale, d1))
    # Staged like commit() does: the key check, the anti join and the union read it once computed.
    source = account_features(cur, d1).unionByName(account_features(cur, d2)).checkpoint(eager=True)
    return stable(upsert(target, source, ["account_number", "feature_date"]))


SILVER_TABLE = "silver/financial/transactions_clean"
GOLD_TABLE = "gold/risk/credit_risk_features"


def q_dq_silver(spark: SparkSession, sf: str) -> DataFrame:
    return run_checks(silver(spark, sf), silver_checks(RUN_DATE), SILVER_TABLE, RUN_DATE, on_critical="report")


def q_dq_gold(spark: SparkSession, sf: str) -> DataFrame:
    feats = account_features(lookback(spark, sf), FEATURE_DATE)
    return run_checks(feats, gold_checks(), GOLD_TABLE, RUN_DATE, on_critical="report")


def q_dq_audit_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A10: both gates append to one audit log, which is read back."""
    zones = Zones(scratch_path(spark, "audit"))
    cur = silver(spark, sf).checkpoint(eager=True)  # both gates read the same stored batch
    run_checks(cur, silver_checks(RUN_DATE), SILVER_TABLE, RUN_DATE, on_critical="report",
               audit_path=zones.dq_audit_log)
    run_checks(account_features(cur, FEATURE_DATE), gold_checks(), GOLD_TABLE, RUN_DATE,
               on_critical="report", audit_path=zones.dq_audit_log)
    from riskweave.schemas import AUDIT_SCHEMA

    return spark.read.schema(AUDIT_SCHEMA).parquet(zones.dq_audit_log)


QUERIES = {
    "landing_valid": q_landing_valid,
    "landing_quarantine": q_landing_quarantine,
    "keep_latest": q_keep_latest,
    "standardise": q_standardise,
    "channel_lookup_join": q_channel_lookup_join,
    "currency_flag": q_currency_flag,
    "account_token": q_account_token,
    "risk_flags": q_risk_flags,
    "day_slice": q_day_slice,
    "lookback_slice": q_lookback_slice,
    "features_7d": _features_one(7),
    "features_30d": _features_one(30),
    "features_90d": _features_one(90),
    "features_wide": q_features_wide,
    "accounts_latest_customer": q_accounts_latest_customer,
    "duplicate_keys": q_duplicate_keys,
    "upsert_txn": q_upsert_txn,
    "upsert_features": q_upsert_features,
    "dq_silver": q_dq_silver,
    "dq_gold": q_dq_gold,
    "dq_audit_rows": q_dq_audit_rows,
}


def all_queries() -> dict:
    from riskweave.plans.layout_queries import LAYOUT_QUERIES
    from riskweave.plans.merge_queries import MERGE_QUERIES
    from riskweave.plans.stream_queries import STREAM_QUERIES

    return {**QUERIES, **STREAM_QUERIES, **LAYOUT_QUERIES, **MERGE_QUERIES}
