"""Column expressions shared by the batch and stream operators.

Each returns a ``Column`` built from built-in functions only, so it stays inside
whole-stage codegen and its predicates can be pushed to the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_code(c: Column) -> Column:
    return F.upper(F.trim(c))


def alias_map(aliases: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in sorted(aliases.items()) for x in pair])


def normalise_channel(c: Column, aliases: Mapping[str, str]) -> Column:
    """Known alias -> canonical channel; any other value (and NULL) is kept."""
    return F.coalesce(alias_map(aliases)[c], c)


def false_if_null(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def sar_flag(amount: Column, threshold: float) -> Column:
    return false_if_null(amount >= F.lit(threshold))


def high_risk_mcc_flag(mcc: Column, codes: Iterable[str]) -> Column:
    # NULL code gives a NULL flag (set membership of NULL is unknown).
    return mcc.isin(list(codes))


def round_amount_flag(amount: Column, unit: float, minimum: float) -> Column:
    return false_if_null((amount % F.lit(unit) == 0) & (amount >= F.lit(minimum)))


def off_hours_flag(hour: Column, amount: Column, first: int, last: int, minimum: float) -> Column:
    return false_if_null(hour.between(first, last) & (amount >= F.lit(minimum)))


def unsupported_currency_flag(code: Column, accepted: Iterable[str]) -> Column:
    return ~code.isin(list(accepted))


def account_token(account: Column, salt: str) -> Column:
    """Hex SHA-256 of account || salt; NULL account gives NULL token."""
    return F.sha2(F.concat(account, F.lit(salt)), 256)


def valid_row(tid: Column, account: Column, amount: Column, reject_nan: bool = False) -> Column:
    """The rows a landing keeps: key, account and a non-negative amount (NaN counts as one, unless
    rejected). A plain conjunction, which a Parquet scan can apply."""
    good = tid.isNotNull() & account.isNotNull() & amount.isNotNull() & (amount >= 0)
    return good & ~F.isnan(amount) if reject_nan else good


def invalid_row(tid: Column, account: Column, amount: Column, reject_nan: bool = False) -> Column:
    """Quarantine rule: missing key, missing account, missing or negative amount."""
    return ~false_if_null(valid_row(tid, account, amount, reject_nan))


def weekend(d: Column) -> Column:
    """Saturday or Sunday (``dayofweek``: Sunday = 1, Saturday = 7)."""
    return F.dayofweek(d).isin(1, 7)
