"""Cleansing operators (H1-H12, C4): all map-only projections over built-ins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import columns as C
from riskweave.settings import DEFAULT_SETTINGS, SILVER_PIPELINE_VERSION, RiskSettings

CODE_COLUMNS = ("transaction_type", "transaction_channel", "currency_code", "originating_country")


def standardise(df: DataFrame, settings: RiskSettings = DEFAULT_SETTINGS) -> DataFrame:
    """H1-H5: trim/upper codes, channel aliases, defaults, 2-place money, hour of day."""
    out = df.withColumns({c: C.clean_code(F.col(c)) for c in CODE_COLUMNS})
    return out.withColumns(
        {
            "transaction_channel": C.normalise_channel(F.col("transaction_channel"), settings.channel_aliases),
            "currency_code": F.coalesce(F.col("currency_code"), F.lit("USD")),
            "originating_country": F.coalesce(F.col("originating_country"), F.lit("US")),
            "is_international": F.coalesce(F.col("is_international"), F.lit(False)),
            "amount_usd": F.round(F.col("amount_usd"), 2),
            "account_balance_usd": F.round(F.col("account_balance_usd"), 2),
            "transaction_hour": F.hour(F.col("transaction_datetime")),
        }
    )


def channel_lookup_join(df: DataFrame, aliases: DataFrame, column: str = "transaction_channel") -> DataFrame:
    """C4 in table form: ``aliases(alias, channel)`` joined on the code; unmatched keeps its value.

    An alias listed more than once counts once (its smallest channel), so no row is
    doubled. The optimizer picks the join from the measured sizes.
    """
    lookup = aliases.filter(F.col("alias").isNotNull()).groupBy(F.col("alias").alias("_alias")).agg(F.min("channel").alias("_channel"))
    joined = df.join(lookup, F.col(column) == F.col("_alias"), "left")
    return joined.withColumn(column, F.coalesce(F.col("_channel"), F.col(column))).drop("_alias", "_channel")


def currency_flag(df: DataFrame, settings: RiskSettings = DEFAULT_SETTINGS) -> DataFrame:
    """H6: ``_flag_unsupported_currency``."""
    return df.withColumn(
        "_flag_unsupported_currency", C.unsupported_currency_flag(F.col("currency_code"), settings.accepted_currencies)
    )


def tokenise(df: DataFrame, column: str = "account_number", salt: str | None = None,
             settings: RiskSettings = DEFAULT_SETTINGS) -> DataFrame:
    """H7: ``<column>_token`` = hex SHA-256 of value || salt; the source column is kept.

    The salt comes from the argument or the settings; there is no default one.
    """
    salt = salt if salt is not None else settings.token_salt
    if salt is None:
        raise ValueError("tokenise needs a salt")
    return df.withColumn(f"{column}_token", C.account_token(F.col(column), salt))


def risk_flags(df: DataFrame, settings: RiskSettings = DEFAULT_SETTINGS,
               processed_at: dt.datetime | None = None) -> DataFrame:
    """H8-H12: SAR, high-risk MCC, round amount, off-hours flags and silver metadata.

    Needs ``transaction_hour`` (from ``standardise``). ``processed_at`` pins the
    metadata timestamp for reproducible runs; default is the query time.
    """
    s = settings
    amount = F.col("amount_usd")
    return df.withColumns(
        {
            "_flag_sar_eligible": C.sar_flag(amount, s.sar_threshold_usd),
            "_flag_high_risk_mcc": C.high_risk_mcc_flag(F.col("merchant_category_code"), s.high_risk_mcc),
            "_flag_round_amount": C.round_amount_flag(amount, s.round_amount_unit, s.round_amount_min_usd),
            "_flag_off_hours_high_value": C.off_hours_flag(
                F.col("transaction_hour"), amount, s.off_hours_first_hour, s.off_hours_last_hour, s.off_hours_min_usd
            ),
            "_silver_processed_at": F.lit(processed_at) if processed_at is not None else F.current_timestamp(),
            "_silver_pipeline_ver": F.lit(SILVER_PIPELINE_VERSION),
        }
    )


def cleanse(df: DataFrame, settings: RiskSettings,
            processed_at: dt.datetime | None = None) -> DataFrame:
    """H1-H12 in the reference order; one projection chain Catalyst collapses into one Project."""
    out = standardise(df, settings)
    out = currency_flag(out, settings)
    out = tokenise(out, "account_number", settings=settings)
    return risk_flags(out, settings, processed_at)
