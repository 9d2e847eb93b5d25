"""Layout jobs keep rows and improve skipping; the driver entry points are consistent."""

from __future__ import annotations

from conftest import SF001

from riskweave.operators.layout import cluster, compact, files, finish_compaction, first_fit, run_layout, skipping_report, table_detail, LayoutSpec


def test_cluster_keeps_rows_and_skips_files(spark, tmp_root):
    from riskweave.plans.queries import silver

    cur = silver(spark, SF001).drop("_silver_processed_at")
    plain, clustered = f"{tmp_root}/plain", f"{tmp_root}/clustered"
    cur.repartition(8).write.parquet(plain)
    cluster(cur, ["account_number", "transaction_date"], files=8).write.parquet(clustered)
    a = spark.read.parquet(plain)
    b = spark.read.parquet(clustered)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    lookup = {"account_number": ("A42", "A42")}
    before = skipping_report(spark, plain, lookup).first()
    after = skipping_report(spark, clustered, lookup).first()
    assert after.files_read < before.files_read
    assert table_detail(spark, clustered).first().num_files == after.files_total


def test_first_fit_groups():
    assert first_fit([5, 9, 3, 7, 1, 20], 10) == [[5], [1, 4], [2, 3], [0]]
    assert first_fit([], 10) == [] and first_fit([30, 30], 10) == [[0], [1]]


def test_compaction_reads_small_files_only(spark, tmp_root):
    """Files of the wanted size keep name and time, order within files stays, rows are not shuffled."""
    src = f"{tmp_root}/t"
    big = spark.range(0, 60_000, numPartitions=1).selectExpr("id", "uuid() as v", "'a b%=c' as p")
    small = spark.range(100_000, 101_200, numPartitions=12).selectExpr("id", "uuid() as v", "CASE WHEN id % 2 = 0 THEN 'a b%=c' END as p")
    big.write.partitionBy("p").parquet(src)
    small.write.mode("append").partitionBy("p").parquet(src)
    schema = spark.read.parquet(src).schema
    def rows():
        return {(r.id, r.v, r.p) for r in spark.read.schema(schema).parquet(src).collect()}

    def listed():
        return {r.file_path: (r.file_size, r.modified) for r in files(spark, src).collect()}

    want, before = rows(), listed()
    assert compact(spark, src, schema, partition_by="p", target_file_bytes=500_000) == 2
    after = listed()
    assert len(before) == 25 and len(after) == 3 and rows() == want
    kept = set(before) & set(after)
    assert len(kept) == 1 and all(before[f] == after[f] and before[f][0] > 500_000 for f in kept)
    assert compact(spark, src, schema, partition_by="p", target_file_bytes=500_000) == 0 and listed() == after


def test_interrupted_compaction_is_completed(spark, tmp_root, monkeypatch):
    from riskweave.operators import layout

    src = f"{tmp_root}/t"
    spark.range(0, 500, numPartitions=6).selectExpr("id", "id % 2 as p").write.partitionBy("p").parquet(src)
    schema = spark.read.parquet(src).schema
    calls = []

    def lost(s, p):
        calls.append(p)
        if len(calls) > 1:
            raise KeyboardInterrupt
        return finish_compaction(s, p)

    with monkeypatch.context() as m:
        m.setattr(layout, "finish_compaction", lost)
        try:
            compact(spark, src, schema, partition_by="p")
        except KeyboardInterrupt:
            pass
    assert finish_compaction(spark, src) and not finish_compaction(spark, src)
    assert table_detail(spark, src).first().num_files == 2
    assert sorted(r.id for r in spark.read.schema(schema).parquet(src).collect()) == list(range(500))


def test_compact_and_runner(spark, tmp_root):
    df = spark.range(0, 2000).selectExpr("id", "cast(id % 5 as string) as p")
    src = f"{tmp_root}/src"
    df.repartition(20).write.partitionBy("p").parquet(src)
    schema = spark.read.parquet(src).schema
    compact(spark, src, schema, partition_by="p")  # in place, dynamic partition overwrite
    assert table_detail(spark, src).first().num_files <= 5 + 1
    assert spark.read.parquet(src).count() == 2000
    res = run_layout(spark, [LayoutSpec(src, ("id",), "p", schema)], dry_run=True).first()
    assert res.status == "skipped (dry_run)"
    ok = run_layout(spark, [LayoutSpec(src, ("id",), "p", schema)]).first()
    assert ok.status == "success" and spark.read.parquet(src).count() == 2000
    assert ok.num_files == table_detail(spark, src).first().num_files and ok.size_bytes > 0 and ok.last_modified is not None


def test_long_common_prefixes_are_clustered(spark, tmp_root):
    """Twelve equal leading characters: an account lookup still skips most files."""
    df = spark.range(0, 20000).selectExpr("concat('ACCT-0000000', lpad(id % 997, 5, '0')) as account", "date_add(date'2024-01-01', cast(id % 90 as int)) as day")
    cluster(df, ["account", "day"], files=32).write.parquet(f"{tmp_root}/z")
    report = skipping_report(spark, f"{tmp_root}/z", {"account": ("ACCT-000000000042", "ACCT-000000000042")}).first()
    assert report.files_read <= 10 < report.files_total and report.rows_found == 20 + (42 < 20000 % 997)


def test_fragmented_partitions_from_a_listing(spark, tmp_root):
    from riskweave.operators.layout import fragmented_partitions

    df = spark.range(0, 100).selectExpr("id", "case when id % 3 = 0 then 'a b' when id % 3 = 1 then 'k:/%' end as p")
    df.repartition(4).write.partitionBy("p").parquet(f"{tmp_root}/t")
    df.filter("id = 1").selectExpr("id", "'one' as p").write.mode("append").partitionBy("p").parquet(f"{tmp_root}/t")
    assert set(fragmented_partitions(spark, f"{tmp_root}/t", "p", 2)) == {"a b", "k:/%", None}
    assert fragmented_partitions(spark, f"{tmp_root}/t", "p", 2, ["one", "none"]) == []


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and "txn_count_30d" in df.columns
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert not {q for q in set(qs) - set(sql) if not q.startswith("op") and q != "pipeline"}
