"""File statistics: the figures of a scan, only new files scanned, lookups that open few files."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators.layout import cluster, skipping_report
from riskweave.sources import file_index
from riskweave.sources.file_index import listing, lookup, refresh, skipping_by_index

SCHEMA = "account string, day date, id long, p string"


def rows(spark, lo, hi, p="'a b'"):
    return spark.range(lo, hi).selectExpr(
        "concat('ACCT-', lpad(id % 97, 4, '0')) as account", "date_add(date'2024-01-01', cast(id % 90 as int)) as day", "id", f"{p} as p")


def table(spark, root):
    path = f"{root}/t"
    cluster(rows(spark, 0, 5000), ["account", "day"], files=12, partition_by="p").write.partitionBy("p").parquet(path)
    return path, spark.createDataFrame([], SCHEMA).schema


def test_figures_equal_the_scan(spark, tmp_root):
    path, schema = table(spark, tmp_root)
    for want in ({"account": ("ACCT-0042", "ACCT-0042")}, {"account": ("ACCT-0001", "ACCT-0009"), "id": (10, 900)}, {"account": ("B", "C")}):
        scan, index = skipping_report(spark, path, want).first(), skipping_by_index(spark, path, schema, want).first()
        assert (index.files_total, index.files_read, index.skipped_share) == (scan.files_total, scan.files_read, scan.skipped_share)
        assert index.rows_total == 5000
        found = lookup(spark, path, schema, want)
        plain = spark.read.schema(schema).parquet(path)
        for c, (lo, hi) in want.items():
            plain = plain.filter(F.col(c).between(lo, hi))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))


def test_only_new_files_are_scanned(spark, tmp_root):
    path, schema = table(spark, tmp_root)
    first, scanned = refresh(spark, path, schema, ["account"])
    assert scanned == first.count() == listing(spark, path).count() == 12
    assert refresh(spark, path, schema, ["account"])[1] == 0
    rows(spark, 5000, 5100, "'k:/%'").coalesce(2).write.mode("append").partitionBy("p").parquet(path)
    added, scanned = refresh(spark, path, schema, ["account"])
    assert scanned == 2 and added.count() == 14 and added.agg(F.sum("num_rows")).first()[0] == 5100
    # A partition that is replaced: its files go from the statistics, the new ones come.
    rows(spark, 0, 10).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("p").parquet(path)
    after, scanned = refresh(spark, path, schema, ["account"])
    assert scanned == 1 and after.agg(F.sum("num_rows")).first()[0] == 110
    assert {r.id for r in lookup(spark, path, schema, {"account": ("ACCT-0003", "ACCT-0003")}).collect()} == {3} | {i for i in range(5000, 5100) if i % 97 == 3}
    # Another column, or one of another type, needs a scan of all files.
    assert refresh(spark, path, schema, ["id"])[1] == 3
    assert spark.read.schema(schema).parquet(path).count() == 110


def test_a_lookup_opens_only_its_files(spark, tmp_root):
    path, schema = table(spark, tmp_root)
    want = {"account": ("ACCT-0042", "ACCT-0042")}
    found = lookup(spark, path, schema, want)
    plan = found._jdf.queryExecution().executedPlan()
    found._jdf.collect()
    files_read = skipping_by_index(spark, path, schema, want).first().files_read
    assert plan.collectLeaves().head().metrics().apply("numFiles").value() == files_read < 12


def test_nulls_empty_tables_and_many_files(spark, tmp_root, monkeypatch):
    path, schema = f"{tmp_root}/n", "k string, x double"
    schema = spark.createDataFrame([], schema).schema
    spark.createDataFrame([(None, None), (None, float("nan"))], schema).coalesce(1).write.parquet(path)
    spark.createDataFrame([("a", 1.0), ("b", None)], schema).coalesce(1).write.mode("append").parquet(path)
    assert [tuple(r) for r in lookup(spark, path, schema, {"k": ("a", "z")}).collect()] and lookup(spark, path, schema, {"x": (5.0, 9.0)}).count() == 0
    monkeypatch.setattr(file_index, "NAMES_IN_PLAN", 1)
    assert lookup(spark, path, schema, {"x": (0.0, float("inf"))}).count() == 1
    spark.createDataFrame([("c", 2.0)], schema).repartition(1).write.mode("append").parquet(path)
    spark.createDataFrame([("d", 3.0)], schema).repartition(1).write.mode("append").parquet(path)
    stats, scanned = refresh(spark, path, schema, ["x"])
    assert scanned == stats.count() == 4
    empty = f"{tmp_root}/e"
    spark.createDataFrame([], schema).write.parquet(empty)
    assert lookup(spark, empty, schema, {"k": ("a", "b")}).count() == 0
    assert skipping_by_index(spark, empty, schema, {"k": ("a", "b")}).first().rows_total == 0
