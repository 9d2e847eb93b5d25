"""Upsert (pure) and partition-scoped commits: matched, inserted, untouched, moved, idempotent."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from riskweave.operators.upsert import DuplicateKeyError, upsert
from riskweave.sources.schema import IncompatibleTypes, widen
from riskweave.sources.tables import commit, read_table, stored_schema, write_partition

SCHEMA = "id string, d date, v int"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def test_upsert_semantics(spark):
    target = _df(spark, [("a", D1, 1), ("b", D1, 1), (None, D1, 1)])
    source = _df(spark, [("a", D2, 2), ("c", D2, 2), (None, D2, 2)])
    out = sorted(((r.id, r.v) for r in upsert(target, source, ["id"]).collect()), key=lambda t: (str(t[0]), t[1]))
    # matched a updated, b untouched, c inserted; NULL keys never match, so both stay
    assert out == [(None, 1), (None, 2), ("a", 2), ("b", 1), ("c", 2)]


def test_upsert_duplicate_policy(spark):
    target = _df(spark, [("a", D1, 1)])
    source = _df(spark, [("a", D2, 2), ("a", D3, 3)])
    with pytest.raises(DuplicateKeyError):
        upsert(target, source, ["id"])
    latest = upsert(target, source, ["id"], on_duplicate="latest", order_by=["v"]).collect()
    assert [(r.id, r.v) for r in latest] == [("a", 3)]


def test_commit_partition_move_and_idempotence(spark, tmp_root):
    path = f"{tmp_root}/t"
    first = commit(spark, path, _df(spark, [("a", D1, 1), ("b", D1, 1), ("c", D2, 1)]), ["id"], "d")
    assert first.created and first.touched_partitions == ("2024-01-01", "2024-01-02")
    # "c" moves from D2 to D3; D2 ends empty and must disappear.
    batch = _df(spark, [("c", D3, 2), ("e", D3, 2)])
    res = commit(spark, path, batch, ["id"], "d")
    assert set(res.touched_partitions) == {"2024-01-02", "2024-01-03"}
    assert res.emptied_partitions == ("2024-01-02",)
    schema = _df(spark, []).schema
    rows = sorted((r.id, r.d, r.v) for r in read_table(spark, path, schema).collect())
    assert rows == [("a", D1, 1), ("b", D1, 1), ("c", D3, 2), ("e", D3, 2)]
    again = commit(spark, path, batch, ["id"], "d")
    assert sorted((r.id, r.d, r.v) for r in read_table(spark, path, schema).collect()) == rows
    assert again.emptied_partitions == ()


def test_write_partition_rerun_clears(spark, tmp_root):
    path = f"{tmp_root}/q"
    schema = "id string, run string"
    write_partition(spark, spark.createDataFrame([("x", "2024-01-01")], schema), path, "run", "2024-01-01")
    write_partition(spark, spark.createDataFrame([("y", "2024-01-02")], schema), path, "run", "2024-01-02")
    # Rerun of 2024-01-01 with no bad rows removes that partition only.
    write_partition(spark, spark.createDataFrame([], schema), path, "run", "2024-01-01")
    got = read_table(spark, path, spark.createDataFrame([], schema).schema).collect()
    assert [(r.id, r.run) for r in got] == [("y", "2024-01-02")]


def test_fraud_signals_job_from_landed_stream(spark, tmp_root):
    """N3 job: reads the landed stream table for a day (plus the day before as
    velocity context) and merges daily signals; rerun is idempotent."""
    from riskweave.plans.pipelines import build_fraud_signals
    from riskweave.settings import RiskSettings, Zones

    zones = Zones(tmp_root)
    t0 = dt.datetime(2024, 1, 1, 23, 0)
    rows = [("E1", "A", t0, True, False, False, D1), ("E2", "A", t0 + dt.timedelta(hours=2), False, False, True, D2),
            ("E3", "B", t0 + dt.timedelta(hours=3), False, True, False, D2)]
    spark.createDataFrame(rows, "transaction_id string, account_number string, transaction_datetime timestamp_ntz, "
                          "_flag_sar_threshold boolean, _flag_international_high_value boolean, "
                          "_flag_ip_country_mismatch boolean, ingestion_date date").write.partitionBy(
        "ingestion_date").parquet(zones.transactions_stream)
    settings = RiskSettings(velocity_max_count=1)
    for _ in range(2):
        res = build_fraud_signals(spark, zones, ["2024-01-02"], settings)
    got = {(r.account_number, r.signal_date): r for r in spark.read.parquet(zones.fraud_signals).collect()}
    assert set(got) == {("A", D2), ("B", D2)}
    a = got[("A", D2)]
    assert a.velocity_breach_count == 1 and a.max_velocity_count == 2 and a.ip_mismatch_count == 1
    assert res.touched_partitions == ("2024-01-02",)


def test_commit_keeps_columns_null_partitions_and_escaped_values(spark, tmp_root):
    """A matched row keeps what only the target has; rows without a partition value and values
    that need escaping are merged like any other."""
    path = f"{tmp_root}/t"
    wide = spark.createDataFrame([("a", "a b", 1, "x"), ("b", "k:1/2%", 1, "y"), ("c", None, 1, "z"), ("d", "p", 1, "w"), (None, "p", 1, "n")],
                                 "id string, part string, v int, extra string")
    first = commit(spark, path, wide, ["id"], "part")
    assert first.touched_partitions == ("a b", "k:1/2%", "p", None)
    batch = spark.createDataFrame([("a", None, 2, True), ("b", "a b", 2, True), ("c", "q", 2, True), ("e", None, 2, True)],
                                  "id string, part string, v int, fresh boolean")
    for _ in range(2):
        commit(spark, path, batch, ["id"], "part")
        got = {r.id: (r.part, r.v, r.extra, r.fresh) for r in read_table(spark, path, stored_schema(spark, path, wide.schema)).collect()}
        assert got == {"a": (None, 2, "x", True), "b": ("a b", 2, "y", True), "c": ("q", 2, "z", True), "d": ("p", 1, "w", None),
                       "e": (None, 2, None, True), None: ("p", 1, "n", None)}


def test_partition_key_in_merge_key_needs_no_search(spark, tmp_root, monkeypatch):
    from riskweave.sources import tables

    path = f"{tmp_root}/t"
    commit(spark, path, _df(spark, [("a", D1, 1), ("b", D2, 1)]), ["id", "d"], "d")
    monkeypatch.setattr(tables, "_matched", lambda *a: pytest.fail("searched the whole target"))
    res = commit(spark, path, _df(spark, [("a", D2, 2)]), ["id", "d"], "d")
    assert res.touched_partitions == ("2024-01-02",)
    rows = sorted((r.id, r.d, r.v) for r in read_table(spark, path, _df(spark, []).schema).collect())
    assert rows == [("a", D1, 1), ("a", D2, 2), ("b", D2, 1)]


def test_search_filters_the_target_by_key_range(spark, tmp_root):
    from riskweave.sources.tables import _matched

    path = f"{tmp_root}/t"
    commit(spark, path, _df(spark, [("a", D1, 1), ("m", D2, 1)]), ["id"], "d")
    found = _matched(read_table(spark, path, _df(spark, []).schema), _df(spark, [("k", D1, 1), ("m", D1, 1)]), ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,k)" in plan and "LessThanOrEqual(id,m)" in plan
    assert [r.id for r in found.collect()] == ["m"]


def test_commit_leaves_no_staging_behind(spark, tmp_root):
    import os

    from riskweave.session import shared_dir

    root = shared_dir(spark).removeprefix("file:")
    before = {x for x in os.listdir(root) if x.startswith("commit-")}
    kept = commit(spark, f"{tmp_root}/t", _df(spark, [("a", D1, 1)]), ["id"], "d", keep_staged=True)
    assert kept.staged.count() == 1
    kept.release()
    commit(spark, f"{tmp_root}/t", _df(spark, [("a", D2, 1)]), ["id"], "d")
    assert {x for x in os.listdir(root) if x.startswith("commit-")} == before


def test_late_event_recomputes_its_whole_day(spark, tmp_root):
    """Five events of a day, then one more of that day landed a day later: the day has six."""
    from riskweave.plans.pipelines import build_fraud_signals
    from riskweave.settings import RiskSettings, Zones

    zones = Zones(tmp_root)
    schema = ("transaction_id string, account_number string, transaction_datetime timestamp_ntz, _flag_sar_threshold boolean, "
              "_flag_international_high_value boolean, _flag_ip_country_mismatch boolean, ingestion_date date")
    t0 = dt.datetime(2024, 1, 1, 20, 0)
    early = [(f"E{i}", "A1", t0 + dt.timedelta(minutes=i), False, False, False, D1) for i in range(5)]
    late = [("L", "A1", dt.datetime(2024, 1, 1, 23, 59, 58), True, False, False, D2), ("N", "A1", None, False, False, False, D2)]
    for rows, day in ((early, "2024-01-01"), (late, "2024-01-02"), ([], "2024-01-02")):
        if rows:
            spark.createDataFrame(rows, schema).write.mode("append").partitionBy("ingestion_date").parquet(zones.transactions_stream)
        build_fraud_signals(spark, zones, [day], RiskSettings(velocity_max_count=3))
    got = {r.signal_date: (r.txn_count, r.sar_threshold_count, r.velocity_breach_count) for r in spark.read.parquet(zones.fraud_signals).collect()}
    assert got == {D1: (6, 1, 3), None: (1, 0, 0)}


def test_merge_widens_types_and_reads_every_version(spark, tmp_root):
    path = f"{tmp_root}/w"
    commit(spark, path, spark.createDataFrame([("a", D1, 1, 1.5), ("b", D2, 2, None)], "id string, d date, v int, f float"), ["id"], "d")
    commit(spark, path, spark.createDataFrame([("c", D2, 5_000_000_000)], "id string, d date, v long"), ["id"], "d")
    commit(spark, path, spark.createDataFrame([("d", D3, 7, 0.25)], "id string, d date, v int, f double"), ["id"], "d")
    schema = stored_schema(spark, path, T.StructType())
    assert [f.dataType.simpleString() for f in schema] == ["string", "date", "bigint", "double"]
    rows = sorted((r.id, r.d, r.v, r.f) for r in read_table(spark, path, schema).collect())
    assert rows == [("a", D1, 1, 1.5), ("b", D2, 2, None), ("c", D2, 5_000_000_000, None), ("d", D3, 7, 0.25)]
    commit(spark, path, spark.createDataFrame([("a", D3, Decimal("2.50"))], "id string, d date, v decimal(12,2)"), ["id"], "d")
    schema = stored_schema(spark, path, T.StructType())
    assert schema["v"].dataType == T.DecimalType(22, 2)
    rows = {r.id: (r.d, float(r.v), r.f) for r in read_table(spark, path, schema).collect()}
    assert rows == {"a": (D3, 2.5, 1.5), "b": (D2, 2.0, None), "c": (D2, 5e9, None), "d": (D3, 7.0, 0.25)}
    commit(spark, path, spark.createDataFrame([("e", D1, 0.125)], "id string, d date, v double"), ["id"], "d")
    schema = stored_schema(spark, path, T.StructType())
    rows = {r.id: r.v for r in read_table(spark, path, schema).collect()}
    assert rows == {"a": 2.5, "b": 2.0, "c": 5e9, "d": 7.0, "e": 0.125}


def test_refused_type_leaves_the_table_as_it_was(spark, tmp_root):
    path = f"{tmp_root}/r"
    commit(spark, path, spark.createDataFrame([("a", D1, D1)], "id string, d date, x date"), ["id"], "d")
    before = sorted(os.path.join(p, f) for p, _, fs in os.walk(path) for f in fs)
    for other in ("string", "timestamp_ntz", "int"):
        batch = spark.createDataFrame([("a", D1, None)], f"id string, d date, x {other}")
        with pytest.raises(IncompatibleTypes):
            commit(spark, path, batch, ["id"], "d")
        with pytest.raises(IncompatibleTypes):
            write_partition(spark, batch, path, "d", "2024-01-01")
    assert sorted(os.path.join(p, f) for p, _, fs in os.walk(path) for f in fs) == before
    assert [(r.id, r.x) for r in read_table(spark, path, stored_schema(spark, path, T.StructType())).collect()] == [("a", D1)]


def test_interrupted_type_change_still_reads(spark, tmp_root, monkeypatch):
    """The driver is lost after the files were replaced, and before: both read, and the batch commits again."""
    from riskweave.sources import tables

    for stage in ("_replace_partitions", "end_change"):
        path = f"{tmp_root}/{stage}"
        commit(spark, path, spark.createDataFrame([("a", D1, 1), ("b", D2, 2)], "id string, d date, v int"), ["id"], "d")
        batch = spark.createDataFrame([("a", D2, 2**40)], "id string, d date, v long")
        with monkeypatch.context() as m:
            m.setattr(tables, stage, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
            with pytest.raises(KeyboardInterrupt):
                commit(spark, path, batch, ["id"], "d")
        read = read_table(spark, path, T.StructType.fromDDL("id string, v long, d date"))
        assert read.filter("id = 'b'").first().v == 2
        commit(spark, path, batch, ["id"], "d")
        assert sorted((r.id, r.d, r.v) for r in read_table(spark, path, stored_schema(spark, path, T.StructType())).collect()) == [("a", D2, 2**40), ("b", D2, 2)]


def test_emptied_partition_left_behind_goes_with_the_next_commit(spark, tmp_root, monkeypatch):
    """The driver is lost between the overwrite and the deletion of an emptied partition."""
    from riskweave.sources import tables

    path = f"{tmp_root}/lost"
    commit(spark, path, _df(spark, [("a", D1, 1), ("b", D2, 1)]), ["id"], "d")
    batch = _df(spark, [("a", D3, 2)])
    with monkeypatch.context() as m:
        m.setattr(tables, "delete_path", lambda s, p: (_ for _ in ()).throw(KeyboardInterrupt) if "d=" in p else True)
        with pytest.raises(KeyboardInterrupt):
            commit(spark, path, batch, ["id"], "d")
    commit(spark, path, batch, ["id"], "d")
    assert sorted((r.id, r.d, r.v) for r in read_table(spark, path, T.StructType.fromDDL(SCHEMA)).collect()) == [("a", D3, 2), ("b", D2, 1)]


def test_widening_lattice():
    dec, t = T.DecimalType, T
    for a, b, want in [(t.IntegerType(), t.LongType(), t.LongType()), (t.LongType(), dec(10, 2), dec(22, 2)), (dec(38, 0), t.DoubleType(), t.DoubleType()),
                       (t.ByteType(), t.IntegerType(), t.IntegerType()), (t.FloatType(), t.DoubleType(), t.DoubleType()), (dec(5, 4), dec(6, 1), dec(9, 4)),
                       (t.ArrayType(t.IntegerType()), t.ArrayType(t.LongType()), t.ArrayType(t.LongType()))]:
        assert widen(a, b) == widen(b, a) == want
    for a, b in [(t.DateType(), t.StringType()), (t.LongType(), t.StringType()), (t.TimestampType(), t.TimestampNTZType()), (t.LongType(), t.FloatType()),
                 (dec(38, 0), dec(38, 10)), (t.BooleanType(), t.IntegerType())]:
        with pytest.raises(IncompatibleTypes):
            widen(a, b)


MERGED = "id string, part string, v int, extra string"


@pytest.mark.parametrize("lacks", [False, True])
def test_merge_equals_upsert_and_shuffles_rows_once(spark, tmp_root, monkeypatch, lacks):
    """Copies of a key in several partitions, moved keys, NULL keys and partitions, one partition in several tasks;
    the target's rows are not shuffled by key."""
    from collections import Counter

    from riskweave.operators.upsert import upsert
    from riskweave.sources import tables

    def some(seed, n, keys):
        h = [(seed * 7919 + i * 104729) % 1009 for i in range(n)]
        return spark.createDataFrame([(None if x % 37 == 0 else f"k{x % keys}", [None, "a", "b c", "d"][x % 4], i, f"e{x}") for i, x in enumerate(h)], MERGED)

    monkeypatch.setattr(tables, "ROWS_PER_TASK", 50)
    path, old, new = f"{tmp_root}/t", some(1, 400, 150), some(2, 120, 200)
    new = new.drop("extra") if lacks else new
    commit(spark, path, old, ["id"], "part", on_duplicate="allow")
    plans, plain = [], tables._write_observed
    monkeypatch.setattr(tables, "_write_observed", lambda s, df, *a, **k: plans.append(df) or plain(s, df, *a, **k))
    commit(spark, path, new, ["id"], "part", on_duplicate="allow")
    columns = ["id", "part", "v", "extra"]
    want = Counter(tuple(r) for r in upsert(old, new, ["id"], on_duplicate="allow").select(*columns).collect())
    assert Counter(tuple(r) for r in read_table(spark, path, old.schema).select(*columns).collect()) == want
    shuffles = [x for x in plans[0]._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 1 and "part#" in shuffles[0] and "_bucket#" in shuffles[0]


def test_partitions_that_a_batch_replaces_whole_are_not_read(spark, tmp_root, monkeypatch):
    from riskweave.sources import tables

    path = f"{tmp_root}/t"
    commit(spark, path, _df(spark, [("a", D1, 1), ("b", D1, 1), ("c", D2, 1), ("d", D2, 1)]), ["id"], "d")
    inputs, plain = [], tables._write_observed
    monkeypatch.setattr(tables, "_write_observed", lambda s, df, *a, **k: inputs.append(df.inputFiles()) or plain(s, df, *a, **k))
    commit(spark, path, _df(spark, [("a", D1, 2), ("b", D3, 2), ("c", D2, 2)]), ["id"], "d")
    own = {f.split("/d=")[1][:10] for f in inputs[0] if f"{path}/d=" in f}
    assert own == {"2024-01-02"}
    commit(spark, path, _df(spark, [("a", D1, 3), ("b", D3, 3)]), ["id"], "d")
    assert not [f for f in inputs[1] if f"{path}/d=" in f]
    rows = sorted((r.id, r.d, r.v) for r in read_table(spark, path, T.StructType.fromDDL(SCHEMA)).collect())
    assert rows == [("a", D1, 3), ("b", D3, 3), ("c", D2, 2), ("d", D2, 1)]


def test_new_table_is_written_once(spark, tmp_root, monkeypatch):
    """Rows of a first batch are neither staged nor shuffled again; a batch with doubled keys leaves nothing behind."""
    import os

    from riskweave.operators.upsert import DuplicateKeyError
    from riskweave.sources import tables

    monkeypatch.setattr(tables, "scratch_path", lambda *a: pytest.fail("staged beside the table"))
    kept = commit(spark, f"{tmp_root}/x/t", _df(spark, [("a", D1, 1), ("b", None, 2)]), ["id"], "d", keep_staged=True)
    assert sorted(r.id for r in kept.staged.collect()) == ["a", "b"] and kept.staged.columns == _df(spark, []).columns
    kept.release()
    assert kept.source_rows == kept.rows_written == 2 and kept.touched_partitions == ("2024-01-01", None)
    assert read_table(spark, f"{tmp_root}/x/t", _df(spark, []).schema).count() == 2
    with pytest.raises(DuplicateKeyError):
        commit(spark, f"{tmp_root}/x/u", _df(spark, [("a", D1, 1), ("a", D1, 2)]), ["id"], "d")
    assert os.listdir(f"{tmp_root}/x") == ["t"]
