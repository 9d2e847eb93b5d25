"""Keep-latest over stored rows: whole rows stay in the tasks that read them; what a job shuffles goes when it is done."""

from __future__ import annotations

import datetime as dt
import os
import random
import re
import time

import pytest
from conftest import SALTED, TXN_COLUMNS, txn
from pyspark.sql import functions as F

from riskweave.operators import dedup
from riskweave.operators.dedup import keep_latest, latest_in_files
from riskweave.plans import pipelines as P
from riskweave.session import FREE_SHUFFLES, setting
from riskweave.settings import Zones
from riskweave.sources import tables
from riskweave.sources.landing import landing_path

RUN = dt.date(2024, 4, 1)


def _rows(n: int, seed: int) -> list[tuple]:
    """Keys with many copies in and over days, equal orders, NULLs everywhere, whole copies."""
    rnd = random.Random(seed)

    def pick(values):
        return rnd.choice([None, *values])

    rows = [(pick([f"k{i}" for i in range(n // 4 + 1)]), pick(["d1", "d 2", "d/3"]), pick([1, 2]), pick([float("nan"), 1.5]), pick(["x", "y"]))
            for _ in range(n)]
    return rows + rows[: n // 4]


@pytest.mark.parametrize("crowded", [100_000, 3])
def test_rows_are_those_of_keep_latest(spark, tmp_root, monkeypatch, crowded):
    monkeypatch.setattr(dedup, "MASK_ROWS", 64)  # several bitmaps a file
    for seed, n in ((1, 1500), (2, 1)):
        path = f"{tmp_root}/{seed}"
        spark.createDataFrame(_rows(n, seed), "k string, d string, seq int, amount double, v string").repartition(3).write.partitionBy("d").parquet(path)
        df = spark.read.parquet(path)
        for i, order in enumerate((["seq"], ["seq", "amount"])):
            got = latest_in_files(df, ["k"], order, f"{tmp_root}/masks-{seed}-{i}", crowded)
            assert got.columns == df.columns and "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(str, got.collect())) == sorted(map(str, keep_latest(df, ["k"], order).collect()))


def test_other_rows_and_large_tables_are_left_to_keep_latest(spark, tmp_root, monkeypatch):
    made = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("seq"))
    assert latest_in_files(made, ["k"], ["seq"], f"{tmp_root}/m") is None
    made.write.parquet(f"{tmp_root}/t")
    stored = spark.read.parquet(f"{tmp_root}/t")
    assert latest_in_files(stored.unionAll(stored), ["k"], ["seq"], f"{tmp_root}/m") is None
    monkeypatch.setattr(dedup, "MASK_BYTES", 1)
    assert latest_in_files(stored, ["k"], ["seq"], f"{tmp_root}/m") is None


def _land(spark, zones, run, rows):
    spark.createDataFrame(rows, TXN_COLUMNS).write.parquet(landing_path(zones, run))
    return P.land_batch(spark, zones, run, spark.createDataFrame([], TXN_COLUMNS).schema)


def _whole_row_shuffles(df) -> list[str]:
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [x for x in re.findall(r"^\(\d+\) Exchange\n(.*?)\n\n", plan, re.M | re.S) if "merchant_name#" in x]


@pytest.mark.parametrize("in_files", [True, False])
def test_cleansing_shuffles_no_whole_rows(spark, tmp_root, monkeypatch, in_files):
    """Two landings, the second replacing all rows of its days; also where the bitmaps would be too large."""
    if not in_files:
        monkeypatch.setattr(dedup, "MASK_BYTES", -1)
    zones, written, plain = Zones(tmp_root), [], tables._write_observed
    rows = [txn(f"t{i}", f"A{i % 7}", f"2024-03-{1 + i % 9:02d}", float(i)) for i in range(300)]
    schema = spark.createDataFrame([], TXN_COLUMNS).schema
    for day, some in enumerate((rows[:200], rows[200:] + [txn(f"t{i}", "B", f"2024-03-{1 + i % 9:02d}", 0.5) for i in range(200)])):
        landing = _land(spark, zones, RUN + dt.timedelta(days=day), some)
        with monkeypatch.context() as m:
            m.setattr(tables, "_write_observed", lambda s, df, *a, **k: written.append(df) or plain(s, df, *a, **k))
            staged, silver = P.cleanse_days(spark, zones, landing.bronze.touched_partitions, schema, settings=SALTED)
        assert silver.read_rows == spark.read.parquet(zones.transactions).count()
        silver.release()
    if in_files:  # before: by key and by day, then by day once more with the columns of cleansing
        assert len(written) == 2 and not any(_whole_row_shuffles(df) for df in written)
    got = {r.transaction_id: (r.account_number, r.amount_usd) for r in spark.read.parquet(zones.transactions_clean).collect()}
    assert got == {f"t{i}": ("B", 0.5) if i < 200 else (f"A{i % 7}", float(i)) for i in range(300)}
    assert not [f for f in os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")) if f.startswith("latest-")]


def test_jobs_leave_no_shuffle_files(spark, tmp_root, monkeypatch):
    def left():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (blocks.apply(i).getName() for i in range(blocks.size())) if f.endswith(".data")}

    zones, before, during, plain = Zones(tmp_root), left(), [], tables._write_observed
    monkeypatch.setattr(tables, "_write_observed", lambda s, *a, **k: (plain(s, *a, **k), during.append(s.conf.get(FREE_SHUFFLES)))[0])
    landing = _land(spark, zones, RUN, [txn(f"t{i}", f"A{i % 7}", f"2024-03-{1 + i % 9:02d}", float(i)) for i in range(300)])
    keep = [landing]
    deadline = time.time() + 20
    while left() - before and time.time() < deadline:  # files are deleted beside the job
        time.sleep(0.2)
    assert not left() - before and keep and set(during) == {"true"} and spark.conf.get(FREE_SHUFFLES) == "false"


def test_landed_rows_get_their_metadata_behind_the_shuffle(spark, tmp_root, monkeypatch):
    zones, written, plain = Zones(tmp_root), [], tables._write_observed
    monkeypatch.setattr(tables, "_write_observed", lambda s, df, path, *a, **k: written.append((path, df)) or plain(s, df, path, *a, **k))
    rows = [txn(f"t{i}", None if i % 10 == 0 else "A", f"2024-03-{1 + i % 9:02d}", float(i)) for i in range(100)]
    landing = _land(spark, zones, RUN, rows)
    assert (landing.quarantined_rows, landing.landed_rows) == (10, 100)
    bronze = next(df for path, df in written if "transactions" in path and "quarantine" not in path)
    shuffles = _whole_row_shuffles(bronze)
    assert len(shuffles) == 1 and "_pipeline_version" not in shuffles[0] and "_ingestion_timestamp" not in shuffles[0]
    got = spark.read.parquet(zones.transactions)
    assert got.count() == 90 and got.filter("_ingestion_date = '2024-04-01' AND _ingestion_timestamp IS NOT NULL").count() == 90


def test_a_busy_first_landing_leaves_one_file_a_day(spark, tmp_root):
    """Tasks above the advisory size: days are not cut, so the layout step has nothing to join."""
    zones, advisory = Zones(tmp_root), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = [txn(f"t{i}", f"A{i % 7}", f"2024-03-{1 + i % 9:02d}", float(i)) for i in range(3000)]
    schema = spark.createDataFrame([], TXN_COLUMNS).schema
    with setting(spark, advisory, "2k"):
        spark.createDataFrame(rows, TXN_COLUMNS).repartition(8).write.parquet(landing_path(zones, RUN))
        landing = P.land_batch(spark, zones, RUN, schema)
        P.cleanse_days(spark, zones, landing.bronze.touched_partitions, schema, settings=SALTED)
    for path in (zones.transactions, zones.transactions_clean):
        assert len(spark.read.parquet(path).inputFiles()) == 9 and spark.read.parquet(path).count() == 3000  # several a day before


def test_a_large_partition_is_dealt_by_key(spark, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 100)
    df = spark.range(1000).selectExpr("concat('k', id) AS k", "if(id < 900, 'big', if(id < 950, 'small', NULL)) AS d")
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        parts = tables.dealt_by_partition(df, ["k"], "d").rdd.glom().collect()
    assert sum(map(len, parts)) == 1000 and sum(any(r.d == "big" for r in p) for p in parts) > 1
    assert sum(any(r.d == "small" for r in p) for p in parts) == sum(any(r.d is None for r in p) for p in parts) == 1
