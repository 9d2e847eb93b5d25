"""Quarantine split (B1): one flag column, two filters over the same plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import invalid_row, valid_row

QUARANTINE_FLAG = "_is_quarantined"


def flag_invalid(df: DataFrame, reject_nan: bool = False) -> DataFrame:
    return df.withColumn(
        QUARANTINE_FLAG,
        invalid_row(F.col("transaction_id"), F.col("account_number"), F.col("amount_usd"), reject_nan),
    )


def split_invalid(df: DataFrame, reject_nan: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return ``(valid, rejected)``.

    ``valid`` has no flag; ``rejected`` keeps it (the quarantine table stores
    it). Both are lazy: each consumer scans the input once with its own filter,
    which Catalyst pushes into the scan where it can. NaN amounts pass unless
    ``reject_nan`` (``NaN < 0`` is false).
    """
    keep = valid_row(F.col("transaction_id"), F.col("account_number"), F.col("amount_usd"), reject_nan)
    return df.filter(keep), flag_invalid(df, reject_nan).filter(F.col(QUARANTINE_FLAG))
