"""Live velocity and signals: late rows, restarts, replayed micro-batches, expiring state."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators.signals import event_micros, fraud_signals, velocity_breach
from riskweave.settings import RiskSettings, Zones
from riskweave.streaming import live
from riskweave.streaming.events import event_source

T0 = dt.datetime(2024, 1, 1)
EVENTS = ("transaction_id string, account_number string, transaction_datetime timestamp_ntz, _flag_sar_threshold boolean, "
          "_flag_international_high_value boolean, _flag_ip_country_mismatch boolean, _event_ingested_at timestamp_ntz")


def events(n=240, seed=5):
    r = random.Random(seed)
    out = []
    for i in range(n):
        t = T0 + dt.timedelta(minutes=30 * r.randrange(0, 200))
        out.append((f"E{i}", r.choice(["HOT", "HOT", "A", "B", None]), t if i % 50 else None, i % 2 == 0, i % 3 == 0, i % 5 == 0, t + dt.timedelta(hours=r.choice([0, 0, 30]))))
    return out


def feed(spark, root, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"{root}/feed")
    return event_source(spark, "parquet", {"maxFilesPerTrigger": "1"}, T.StructType.fromDDL(EVENTS), f"{root}/feed")


def test_live_velocity_equals_the_batch(spark, tmp_root):
    rows = events()
    for part in range(3):
        live.start_velocity(feed(spark, tmp_root, rows[part::3]), f"{tmp_root}/out", f"{tmp_root}/ck", delay="100 days", available_now=True).awaitTermination()
    df = spark.createDataFrame(rows, EVENTS)
    batch = velocity_breach(df).filter("velocity_count IS NOT NULL")
    want = {(r.account_number, r.ref, r.velocity_count) for r in batch.withColumn("ref", event_micros(df, "transaction_datetime")).collect()}
    assert {tuple(r) for r in live.velocity_counts(spark, f"{tmp_root}/out").collect()} == want


def test_live_velocity_state_expires(spark, tmp_root):
    """After a quiet day an account's times are gone from the state."""
    def day(k, account="A"):
        return [(f"E{k}{i}", account, T0 + dt.timedelta(days=k, hours=i), True, False, False, T0) for i in range(3)]

    for rows in (day(0), day(10, "B"), day(20, "B"), day(30, "B")):
        live.start_velocity(feed(spark, tmp_root, rows), f"{tmp_root}/out", f"{tmp_root}/ck", delay="1 hour", available_now=True).awaitTermination()
    held = spark.read.format("statestore").option("path", f"{tmp_root}/ck").option("stateVarName", "times").load().collect()
    assert {r.key.account_number if hasattr(r.key, "account_number") else r.key[0] for r in held} == {"B"} and len(held) <= 6


@pytest.mark.parametrize("lost_at", ["build_fraud_signals", "save_json"])
def test_signals_survive_a_crash_between_write_and_commit(spark, tmp_root, monkeypatch, lost_at):
    zones, rows, settings = Zones(tmp_root), events(90), RiskSettings(velocity_max_count=2)
    source = feed(spark, tmp_root, rows[:40])
    live.start_signals(source, zones, f"{tmp_root}/ck", settings, available_now=True).awaitTermination()
    source = feed(spark, tmp_root, rows[40:])
    with monkeypatch.context() as m:
        m.setattr(live, lost_at, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            live.start_signals(source, zones, f"{tmp_root}/ck", settings, available_now=True).awaitTermination()
    live.start_signals(source, zones, f"{tmp_root}/ck", settings, available_now=True).awaitTermination()
    want = fraud_signals(velocity_breach(spark.createDataFrame(rows, EVENTS), settings=settings))
    got = spark.read.parquet(zones.fraud_signals).withColumn("signal_date", F.col("signal_date").cast("date")).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


SENT = ("transaction_id string, transaction_datetime timestamp_ntz, _event_ingested_at timestamp_ntz, _event_sequence long")


def sent(spark, root, rows):
    spark.createDataFrame(rows, SENT).coalesce(1).write.mode("append").parquet(f"{root}/sent")
    return event_source(spark, "parquet", {}, T.StructType.fromDDL(SENT), f"{root}/sent")


def landed(spark, zones):
    table = spark.read.parquet(zones.transactions_stream)
    return sorted(table.select("transaction_id", "transaction_datetime", "_event_sequence").collect(), key=str)


def test_an_event_sent_again_days_later_lands_once(spark, tmp_root):
    zones = Zones(tmp_root)
    day = [T0 + dt.timedelta(days=k, hours=3) for k in range(9)]
    first = [("A", day[0], day[0], 1), ("A", day[0], day[1], 2), ("B", day[1], day[1], 3), (None, day[1], day[1], 4), ("N", None, day[1], 5)]
    # Sent again: A and N days later, B with another day's time (another event), the one without an id; C is late but new.
    again = [("A", day[0], day[8], 6), ("B", day[2], day[8], 7), (None, day[1], day[8], 8), ("N", None, day[8], 9), ("C", day[0], day[8], 10),
             ("C", day[0], day[7], 11), ("N", day[3], day[8], 12)]
    for rows in (first, again, again):
        live.start_landing_once(sent(spark, tmp_root, rows), zones.transactions_stream, f"{tmp_root}/ck", available_now=True).awaitTermination()
    got = [tuple(r) for r in landed(spark, zones)]
    assert sorted(r[2] for r in got) == [1, 3, 4, 5, 7, 8, 8, 11, 12]
    assert spark.read.parquet(zones.transactions_stream).filter("transaction_id = 'A'").count() == 1


@pytest.mark.parametrize("lost_at", ["_write_batch", "save_json"])
def test_landing_once_survives_a_crash(spark, tmp_root, monkeypatch, lost_at):
    """Lost before the write, or between the write and the fence: the replay lands the same rows."""
    zones, write = Zones(tmp_root), live._write_batch
    rows = [(f"E{i % 40}" if i % 9 else None, T0 + dt.timedelta(days=i % 40), T0 + dt.timedelta(days=i % 40 + i // 40), i) for i in range(120)]
    live.start_landing_once(sent(spark, tmp_root, rows[:50]), zones.transactions_stream, f"{tmp_root}/ck", available_now=True).awaitTermination()
    source = sent(spark, tmp_root, rows[50:])
    with monkeypatch.context() as m:
        m.setattr(live, lost_at, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            live.start_landing_once(source, zones.transactions_stream, f"{tmp_root}/ck", available_now=True).awaitTermination()
    assert live._write_batch is write
    live.start_landing_once(source, zones.transactions_stream, f"{tmp_root}/ck", available_now=True).awaitTermination()
    got = [r["_event_sequence"] for r in landed(spark, zones)]
    ids = {r[0] for r in rows if r[0]}
    assert len(got) == len(set(got)) == len(ids) + sum(r[0] is None for r in rows)


def test_landing_once_reads_the_partitions_of_its_days(spark, tmp_root):
    rows = [("A", T0, T0, 1)]
    batch = spark.createDataFrame(rows, SENT)
    path = f"{tmp_root}/t"
    batch.withColumn("ingestion_date", F.explode(F.sequence(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 9))))).write.partitionBy("ingestion_date").parquet(path)
    plan = live.not_landed(batch, spark.read.parquet(path), ["2024-01-02", None])._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "2024-01-02" in text[text.index("PartitionFilters"):] and "LeftAnti" in text
