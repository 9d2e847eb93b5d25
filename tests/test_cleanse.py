"""Unit tests for landing validation, keep-latest and cleansing on hand-made rows."""

from __future__ import annotations

import datetime as dt
import math

from conftest import SALTED, TXN_COLUMNS, txn
from pyspark.sql import functions as F

from riskweave.operators.cleanse import channel_lookup_join, cleanse, risk_flags, standardise
from riskweave.operators.dedup import crowded_buckets, duplicate_keys, keep_latest
from riskweave.operators.validate import split_invalid
from riskweave.sources.landing import with_metadata


def test_split_invalid_rules_and_nan(spark):
    rows = [
        txn("t1", "a", "2024-01-01", 5.0),
        txn(None, "a", "2024-01-01", 5.0),
        txn("t3", None, "2024-01-01", 5.0),
        txn("t4", "a", "2024-01-01", None),
        txn("t5", "a", "2024-01-01", -0.01),
        txn("t6", "a", "2024-01-01", float("nan")),
    ]
    df = spark.createDataFrame(rows, TXN_COLUMNS)
    valid, rejected = split_invalid(df)
    assert sorted(r.transaction_id for r in valid.collect()) == ["t1", "t6"]  # NaN < 0 is false
    assert "_is_quarantined" not in valid.columns
    assert rejected.count() == 4 and all(r._is_quarantined for r in rejected.collect())
    valid2, rejected2 = split_invalid(df, reject_nan=True)
    assert [r.transaction_id for r in valid2.collect()] == ["t1"]
    assert rejected2.count() == 5


def test_with_metadata_keeps_string_date(spark):
    df = spark.createDataFrame([txn("t1", "a", "2024-01-01")], TXN_COLUMNS)
    out = with_metadata(df, dt.date(2024, 1, 2), now=dt.datetime(2024, 1, 2, 3, 0))
    r = out.first()
    assert r._ingestion_date == "2024-01-02" and r._pipeline_version == "2.4.0"
    assert r._source_system == "CBS_NIGHTLY_EXPORT"
    assert dict(out.dtypes)["_ingestion_date"] == "string"


def test_keep_latest_order_and_tie(spark):
    rows = [("k1", 1, "x"), ("k1", 3, "y"), ("k1", 2, "z"), ("k2", 5, "p"), ("k2", 5, "q"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "k string, seq int, v string")
    out = {r.k: r.v for r in keep_latest(df, ["k"], ["seq"]).collect()}
    assert out["k1"] == "y"
    # Ties are broken by a hash of the row: same winner on every run and layout.
    winners = {keep_latest(df.repartition(n), ["k"], ["seq"]).filter("k = 'k2'").first().v for n in (1, 3, 7)}
    assert len(winners) == 1
    assert out[None] == "n"


def test_duplicate_keys_counts_null_as_one_key(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert duplicate_keys(df, "k").first()[0] == 2  # 5 rows - 3 keys (a, b, NULL)
    empty = spark.createDataFrame([], "k string")
    assert duplicate_keys(empty, "k").first()[0] == 0


def test_standardise_codes_aliases_defaults_rounding(spark):
    rows = [
        txn("t1", "a", "2024-01-01", 10.005, channel=" web ", ttype=" debit", currency=None, country=None,
            intl=None, hour=4),
        txn("t2", "a", "2024-01-01", 1.0, channel="teller"),
        txn("t3", "a", "2024-01-01", 1.0, channel="KIOSK"),
        txn("t4", "a", "2024-01-01", 1.0, channel=None),
    ]
    out = {r.transaction_id: r for r in standardise(spark.createDataFrame(rows, TXN_COLUMNS)).collect()}
    r = out["t1"]
    assert (r.transaction_channel, r.transaction_type, r.currency_code, r.originating_country) == (
        "ONLINE", "DEBIT", "USD", "US")
    assert r.is_international is False and r.transaction_hour == 4
    assert r.amount_usd == 10.01  # half-up on the decimal text
    assert out["t2"].transaction_channel == "BRANCH"
    assert out["t3"].transaction_channel == "KIOSK"  # missing alias keeps the value, no error
    assert out["t4"].transaction_channel is None


def test_channel_lookup_join_table_form(spark):
    df = spark.createDataFrame([("t1", "WEB"), ("t2", "ATM"), ("t3", None)], "transaction_id string, "
                               "transaction_channel string")
    aliases = spark.createDataFrame([("WEB", "ONLINE")], "alias string, channel string")
    out = {r.transaction_id: r.transaction_channel for r in channel_lookup_join(df, aliases).collect()}
    assert out == {"t1": "ONLINE", "t2": "ATM", "t3": None}


def test_risk_flags_edges(spark):
    rows = [
        txn("sar", "a", "2024-01-01", 10_000.0),
        txn("below", "a", "2024-01-01", 9_999.99),
        txn("null_amt", "a", "2024-01-01", None, mcc=None),
        txn("round", "a", "2024-01-01", 5_000.0, hour=5),
        txn("round_small", "a", "2024-01-01", 4_000.0),
        txn("late", "a", "2024-01-01", 2_000.0, hour=6),
        txn("mcc", "a", "2024-01-01", 1.0, mcc="7995"),
    ]
    out = {r.transaction_id: r for r in risk_flags(standardise(spark.createDataFrame(rows, TXN_COLUMNS))).collect()}
    assert out["sar"]._flag_sar_eligible and not out["below"]._flag_sar_eligible
    assert out["null_amt"]._flag_sar_eligible is False  # NULL amount gives false
    assert out["null_amt"]._flag_high_risk_mcc is None  # NULL code gives NULL
    assert out["mcc"]._flag_high_risk_mcc is True
    assert out["round"]._flag_round_amount and not out["round_small"]._flag_round_amount
    assert out["round"]._flag_off_hours_high_value  # 05:00 counts as off hours
    assert not out["late"]._flag_off_hours_high_value


def test_cleanse_token_matches_sha256(spark):
    import hashlib

    df = spark.createDataFrame([txn("t1", "A1", "2024-01-01"), txn("t2", None, "2024-01-01")], TXN_COLUMNS)
    out = {r.transaction_id: r for r in cleanse(df, SALTED).collect()}
    assert out["t1"].account_number_token == hashlib.sha256(b"A1RISK_SALT_V3").hexdigest()
    assert out["t2"].account_number_token is None
    assert out["t1"]._flag_unsupported_currency is False
    assert not math.isnan(out["t1"].amount_usd)


def test_cleanse_is_one_projection(spark):
    df = spark.createDataFrame([txn("t1", "A1", "2024-01-01")], TXN_COLUMNS)
    plan = cleanse(df, SALTED).withColumn("x", F.lit(1))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # map-only


def test_keep_latest_sorts_no_map_task_but_for_crowded_keys(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) AS k", "id AS seq", "concat('v', id) AS v")
    df = df.unionAll(spark.createDataFrame([(None, i, "n") for i in range(5)], "k string, seq long, v string"))
    plain, cut = keep_latest(df, ["k"], ["seq"]), keep_latest(df, ["k"], ["seq"], crowded=100)
    assert sorted(plain.collect(), key=str) == sorted(cut.collect(), key=str) and plain.count() == 2002
    assert cut.filter("k = 'hot'").first().v == "v2997" and cut.filter("k IS NULL").first().seq == 4
    assert crowded_buckets(df, ["k"], 100).count() == 1 and crowded_buckets(df, ["k"]).count() == 0
    # Rows of other keys reach the shuffle unsorted: one sort, behind the exchange, and no limit before it.
    usual = plain._jdf.queryExecution().optimizedPlan().toString().split("LeftAnti")[0]
    assert "lag(" in usual and "WindowGroupLimit" not in usual
