"""Row choice and bounded tables shared by the operators that learn from documents."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(id_col: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % buckets


def hash_share(id_col: str, share: float, seed: str) -> Column:
    """True for about ``share`` of the ids, the same ones in every run."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def floor_for(table: DataFrame, count_col: str, rows: int) -> int:
    """The smallest count of the form ceil(2^(k/8)) that at most ``rows`` rows of ``table`` reach.

    A model keeps the rows at or above it; the histogram has about 500 rows at most.
    """
    step = F.floor(F.log2(F.col(count_col)) * 8).cast("int")
    steps = sorted(((r["k"], r["count"]) for r in table.groupBy(step.alias("k")).count().collect()), reverse=True)
    if not steps:
        return 1
    total, floor = 0, steps[0][0] + 1  # above every count, should the commonest alone be too many
    for k, n in steps:
        total += n
        if total > rows:
            break
        floor = k
    return math.ceil(round(2 ** (floor / 8), 9))
