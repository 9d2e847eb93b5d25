"""Keep-latest for a stored table: whole rows move once, to the partition they are stored in."""

from __future__ import annotations

import random
import re

import pytest
from conftest import SF001

from riskweave.operators.dedup import keep_latest, latest_in_place
from riskweave.plans import queries as Q
from riskweave.plans import stream_queries as S


def _details(df, operator: str) -> list[str]:
    """What the formatted plan says of each operator of this name."""
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(rf"^\(\d+\) {operator}\n(.*?)\n\n", plan, re.M | re.S)


@pytest.mark.parametrize("query", [Q.q_day_slice, Q.q_dq_gold, S.q_route_by_score])
def test_the_stored_table_sends_whole_rows_once_and_sorts_them_once(spark, monkeypatch, query):
    made, plain = [], Q.cleanse
    monkeypatch.setattr(Q, "cleanse", lambda df, *a, **k: made.append(df) or plain(df, *a, **k))
    query(spark, SF001)
    whole = [x for x in _details(made[0], "Exchange") if "merchant_name#" in x]
    assert len(whole) == 1 and "hashpartitioning(transaction_date#" in whole[0]  # before: by key, then rebalanced by date
    assert len([x for x in _details(made[0], "Sort") if "merchant_name#" in x]) == 1
    assert sorted(made[0].collect(), key=str) == sorted(Q.latest(spark, SF001).collect(), key=str)


def _odd_rows(n: int, seed: int) -> list[tuple]:
    """Few keys, places and orders, so that keys tie within and over places; NULLs in all of them, NaN, whole copies."""
    rnd = random.Random(seed)

    def pick(values):
        return rnd.choice([None, *values])

    rows = [(pick(["k%d" % i for i in range(12)]), pick(["d1", "d2", "d3"]), pick(["a", "b"]), pick([1, 2]),
             pick([0.0, -0.0, float("nan"), 1.5]), rnd.choice(["x", "y", None])) for _ in range(n)]
    return rows + rows[: n // 4]


@pytest.mark.parametrize("crowded,piece_rows", [(100_000, 500_000), (3, 500_000), (100_000, 5), (3, 5)])
def test_latest_in_place_keeps_the_rows_of_keep_latest(spark, crowded, piece_rows):
    names = "k string, d string, acc string, seq int, amount double, v string"
    for seed, n in ((1, 300), (2, 0)):
        df = spark.createDataFrame(_odd_rows(n, seed), names).repartition(3).localCheckpoint()
        for order in (["seq"], ["seq", "amount"]):
            want = sorted(map(str, keep_latest(df, ["k"], order).collect()))
            got = latest_in_place(df, ["k"], order, ["d", "acc"], crowded, piece_rows)
            assert got.columns == df.columns and sorted(map(str, got.collect())) == want


def test_a_large_place_is_dealt_by_key_and_stays_sorted(spark, monkeypatch):
    df = spark.range(4000).selectExpr("concat('k', id % 1500) AS k", "if(id < 3600, 'big', 'small') AS d", "id % 7 AS acc", "id AS seq")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it joins partitions as small as these
    try:
        dealt, whole = (latest_in_place(df, ["k"], ["seq"], ["d", "acc"], piece_rows=n).rdd.glom().collect() for n in (500, 5000))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(map(len, dealt)) == sum(map(len, whole)) == 1500
    assert all([(r.d, r.acc) for r in part] == sorted((r.d, r.acc) for r in part) for part in dealt)
    assert sum(any(r.d == "big" for r in part) for part in dealt) > 1
    assert sum(any(r.d == "big" for r in part) for part in whole) == 1
