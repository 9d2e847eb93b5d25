"""The stored lookback ships each row by key without a hash that does not compress."""

from __future__ import annotations

import re

from conftest import SF001

from riskweave.operators.dedup import keep_latest
from riskweave.plans import queries as Q


def _sent_by_key(df):
    """What goes into the shuffle of the rows by key, in the order of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(plan) if re.search(r"Exchange hashpartitioning\((k|transaction_id)#", line))
    return plan[at + 1]


def test_whole_rows_are_hashed_behind_the_shuffle(spark):
    df = spark.range(3000).selectExpr("if(id % 1000 = 0, NULL, concat('k', id % 1000)) AS k", "id % 2 AS seq", "concat('v', id) AS v")
    before, behind = keep_latest(df, ["k"], ["seq"]), keep_latest(df, ["k"], ["seq"], whole=True)
    assert "_w0" in _sent_by_key(before)
    assert "_w0" not in _sent_by_key(behind)
    assert sorted(behind.collect(), key=str) == sorted(before.collect(), key=str) and behind.count() == 1000
    crowded = keep_latest(df, ["k"], ["seq"], crowded=2, whole=True)
    assert sorted(crowded.collect(), key=str) == sorted(before.collect(), key=str)


def test_the_stored_lookback_keeps_whole_rows(spark, monkeypatch):
    calls, plain = [], Q.keep_latest
    monkeypatch.setattr(Q, "keep_latest", lambda *a, **k: calls.append(k) or plain(*a, **k))
    assert Q.q_day_slice(spark, SF001).columns and calls == [{"whole": True}]  # without it 8 bytes a row more
    monkeypatch.undo()
    assert "_w0" not in _sent_by_key(Q.latest(spark, SF001, whole=True))
    assert "_w0" in _sent_by_key(Q.latest(spark, SF001))  # others may drop columns before the shuffle
