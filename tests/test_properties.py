"""Property tests: velocity counts and keep-latest against plain-Python brute force."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskweave.operators.dedup import keep_latest
from riskweave.operators.signals import velocity_breach

T0 = dt.datetime(2024, 1, 1)

events = st.lists(
    st.tuples(st.sampled_from(["A", "B", "HOT", "HOT", "HOT"]), st.integers(min_value=0, max_value=72 * 4)),
    min_size=1, max_size=60,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events)
def test_velocity_property(spark, evs):
    rows = [(f"e{i}", a, T0 + dt.timedelta(minutes=15 * q)) for i, (a, q) in enumerate(evs)]
    df = spark.createDataFrame(rows, "transaction_id string, account_number string, transaction_datetime timestamp_ntz")
    got = {r.transaction_id: r.velocity_count for r in velocity_breach(df, hours=6, max_count=3).collect()}
    for tid, a, ts in rows:
        want = sum(1 for _, b, t in rows if b == a and ts - dt.timedelta(hours=6) <= t <= ts)
        assert got[tid] == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.integers(0, 5), st.integers(0, 99)),
                min_size=1, max_size=40))
def test_keep_latest_property(spark, rows):
    df = spark.createDataFrame(rows, "k string, seq int, v int")
    got = {r.k: (r.seq, r.v) for r in keep_latest(df, ["k"], ["seq"]).collect()}
    for k in {r[0] for r in rows}:
        top = max(s for kk, s, _ in rows if kk == k)
        assert got[k][0] == top and (k, top, got[k][1]) in rows
