"""Key filters: merges read only partitions that may match; never a wrong negative, also after a lost run."""

from __future__ import annotations

import datetime as dt

import pytest

from riskweave.sources import key_filter, tables
from riskweave.sources.tables import commit, partition_values, read_table, replace_partitions, stored_schema

SCHEMA = "id string, d date, v int"
FIRST = dt.date(2024, 1, 1)


def rows(spark, ids, v, day=lambda i: i % 20):
    return spark.createDataFrame([(f"k{i}", FIRST + dt.timedelta(days=day(i)), v) for i in ids], SCHEMA)


def content(spark, path):
    return sorted((r.id, str(r.d), r.v) for r in read_table(spark, path, stored_schema(spark, path, None)).collect())


@pytest.fixture()
def table(spark, tmp_root):
    path = f"{tmp_root}/t"
    commit(spark, path, rows(spark, range(2000), 1), ["id"], "d")
    return path


def test_only_partitions_that_may_match_are_read(spark, table, monkeypatch):
    seen, plain = [], tables._matched

    def matched(target, source, keys):
        seen.append({f.split("/d=")[1].split("/")[0] for f in target.inputFiles()})
        return plain(target, source, keys)

    monkeypatch.setattr(tables, "_matched", matched)
    # k3 is in day 3, k25 in day 5; k5000 nowhere. All land in day 19.
    commit(spark, table, rows(spark, [3, 25, 5000], 2, lambda i: 19), ["id"], "d")
    assert seen == [{"2024-01-04", "2024-01-06"}]
    want = sorted([(f"k{i}", str(FIRST + dt.timedelta(days=i % 20)), 1) for i in range(2000) if i not in (3, 25)]
                  + [(f"k{i}", "2024-01-20", 2) for i in (3, 25, 5000)])
    assert content(spark, table) == want
    commit(spark, table, rows(spark, [3], 3, lambda i: 0), ["id"], "d")  # the filter of day 19 was rebuilt, that of day 3 has lost the key
    assert seen[1] == {"2024-01-20"} and ("k3", "2024-01-01", 3) in content(spark, table) and len(content(spark, table)) == 2001


def test_wrong_positives_are_rare_and_there_are_no_wrong_negatives(spark, table):
    values = partition_values(spark, table, "d")
    assert len(values) == 20
    for day in (0, 7):
        assert key_filter.possible(spark, table, rows(spark, range(day, 2000, 20), 1), ["id"], values) == [values[day]]
    strange = rows(spark, range(10_000, 12_000), 1)
    assert len(key_filter.possible(spark, table, strange, ["id"], values)) <= 2
    assert key_filter.possible(spark, table, strange, ["id"], values, max_keys=1999) == values  # too many keys: all are searched


def test_large_partitions_have_several_segments(spark, monkeypatch, tmp_root):
    monkeypatch.setattr(key_filter, "SEGMENT", 100)
    path = f"{tmp_root}/s"
    commit(spark, path, rows(spark, range(1000), 1, lambda i: i % 2), ["id"], "d")
    values = partition_values(spark, path, "d")
    for i in (0, 1, 500, 999):
        assert key_filter.possible(spark, path, rows(spark, [i], 1), ["id"], values) == [values[i % 2]]
    assert key_filter.possible(spark, path, rows(spark, [5000], 1), ["id"], values) == []


def test_a_lost_run_leaves_no_wrong_filter(spark, table, monkeypatch):
    batch = rows(spark, [3, 9000], 2, lambda i: 19)
    with monkeypatch.context() as m:
        m.setattr(key_filter, "remember", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            commit(spark, table, batch, ["id"], "d")
    commit(spark, table, rows(spark, [9000], 3, lambda i: 0), ["id"], "d")  # k9000 sits in day 19, whose filter is gone
    got = content(spark, table)
    assert [r for r in got if r[0] == "k9000"] == [("k9000", "2024-01-01", 3)] and len(got) == 2001


def test_other_writes_and_key_types_drop_filters(spark, table, tmp_root):
    replace_partitions(spark, rows(spark, [7777], 1, lambda i: 4), table, "d", ["2024-01-05"])
    commit(spark, table, rows(spark, [7777], 2, lambda i: 6), ["id"], "d")
    assert [r for r in content(spark, table) if r[0] == "k7777"] == [("k7777", "2024-01-07", 2)]
    path = f"{tmp_root}/n"
    commit(spark, path, spark.createDataFrame([(1, FIRST, 1)], "id int, d date, v int"), ["id"], "d")
    commit(spark, path, spark.createDataFrame([(1, FIRST + dt.timedelta(days=1), 2)], "id long, d date, v int"), ["id"], "d")
    commit(spark, path, spark.createDataFrame([(1, FIRST + dt.timedelta(days=2), 3)], "id int, d date, v int"), ["id"], "d")
    assert content(spark, path) == [(1, "2024-01-03", 3)]


def test_generations_are_joined(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(key_filter, "GENERATIONS", 3)
    path = f"{tmp_root}/g"
    for k in range(6):
        commit(spark, path, rows(spark, [k], 1), ["id"], "d")
    values = partition_values(spark, path, "d")
    assert [key_filter.possible(spark, path, rows(spark, [k], 1), ["id"], values) for k in range(6)] == [[v] for v in values]
    assert len(set(key_filter._list(spark, path).values())) <= 3


def test_filters_are_made_where_rows_are_read(spark, tmp_root):
    """No shuffle; a partition read by several tasks has several filters, also one without a value."""
    some = rows(spark, range(600), 1, lambda i: i % 3).repartition(4)
    plan = key_filter.make_filters(some, ["id"], some["d"].cast("string"), 1)
    made = plan.collect()
    assert "hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()  # before: by partition and segment
    assert len(made) == 12 and {r["part"] for r in made} == {"2024-01-01", "2024-01-02", "2024-01-03"}
    path = f"{tmp_root}/n"
    commit(spark, path, spark.createDataFrame([("a", None, 1), ("b", FIRST, 1), (None, FIRST, 1)], SCHEMA), ["id"], "d")
    found = [key_filter.possible(spark, path, spark.createDataFrame([(k, FIRST, 2)], SCHEMA), ["id"], ["2024-01-01", None]) for k in ("a", "b", "c")]
    assert found == [[None], ["2024-01-01"], []]
