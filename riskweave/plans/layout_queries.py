"""Registered queries for table layout (L1-L5) and the daily chain (M5).

Each writes its tables under a fresh folder of the shared work folder
(``spark.checkpoint.dir``) and reads them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.layout import (
    TARGET_FILE_BYTES,
    LayoutSpec,
    cluster,
    compact,
    file_count,
    files,
    optimise,
    run_layout,
    skipping_report,
    table_detail,
)
from riskweave.plans.oracle import FEATURE_DATE, RUN_DATE, SETTINGS
from riskweave.plans.pipelines import daily_chain
from riskweave.plans.queries import raw_txn, silver, silver_in_files, stable
from riskweave.session import frees_shuffles, scratch_path
from riskweave.settings import Zones
from riskweave.sources import adapters
from riskweave.sources.file_index import lookup, refresh, skipping_by_index
from riskweave.sources.landing import landing_path

LOOKUP_ACCOUNT = "A42"
SMALL_BYTES = 64 * 1024
PARTS = 16
YEARS = 7


def _target_bytes(spark: SparkSession, path: str) -> int:
    """A file size that cuts a small table into about ``PARTS`` files, and a large one into usual files."""
    size = table_detail(spark, path).first()["size_bytes"]
    return min(TARGET_FILE_BYTES, max(SMALL_BYTES, size // PARTS))


def _small_files(spark: SparkSession, sf: str, pieces: int = 1) -> tuple[int, int]:
    """The wanted file size, and the rows that cut the table into files of about a quarter of it (or of 1 / ``pieces`` of that).
    Rows are counted from the source's file footers; the writer cuts the files, so rows are not shuffled for it."""
    source = f"{sf}/lineitem.parquet"
    target = _target_bytes(spark, source)
    small = file_count(spark, max(1, target // 4), source)
    return target, max(1, adapters.table(spark, sf, "lineitem").count() // (max(2, small) * pieces))


@frees_shuffles
def _fragmented_silver(spark: SparkSession, sf: str) -> tuple[str, DataFrame, int]:
    """The curated table as files a quarter of the wanted size (the layout to fix)."""
    path = scratch_path(spark, "silver")
    target, rows = _small_files(spark, sf)
    with silver_in_files(spark, sf) as cur:
        cur.write.option("maxRecordsPerFile", rows).parquet(path)
    return path, silver(spark, sf), target


def q_table_detail(spark: SparkSession, sf: str) -> DataFrame:
    """L3 over the curated table, with its rows."""
    path, cur, _ = _fragmented_silver(spark, sf)
    rows = spark.read.schema(cur.schema).parquet(path).agg(F.count(F.lit(1)).alias("num_rows"))
    return table_detail(spark, path).select(
        (F.col("num_files") > 1).alias("fragmented"), (F.col("size_bytes") > 0).alias("has_bytes"),
        F.col("last_modified").isNotNull().alias("has_change")).join(rows)


def q_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """L1: same rows after the small files of a table are joined in place; files of the wanted size keep their names."""
    path, cur, target = _fragmented_silver(spark, sf)
    target = 4 * target
    compact(spark, path, cur.schema, target_file_bytes=target)
    names = {r["file_path"] for r in files(spark, path).collect()}
    again = compact(spark, path, cur.schema, target_file_bytes=target)
    kept = again == 0 and names == {r["file_path"] for r in files(spark, path).collect()}
    return stable(spark.read.schema(cur.schema).parquet(path)).withColumn("untouched_when_done", F.lit(kept))


def _clustered(spark: SparkSession, sf: str) -> tuple[str, str, DataFrame]:
    plain, cur, target = _fragmented_silver(spark, sf)
    clustered = scratch_path(spark, "clustered")
    optimise(spark, plain, cur.schema, ["account_number", "transaction_date"], out_path=clustered, target_file_bytes=target)
    return plain, clustered, cur


def q_clustered(spark: SparkSession, sf: str) -> DataFrame:
    """L2: same rows after Z-order clustering on (account_number, transaction_date)."""
    _, path, cur = _clustered(spark, sf)
    return stable(spark.read.schema(cur.schema).parquet(path))


def q_skipping_report(spark: SparkSession, sf: str) -> DataFrame:
    """L5: the rows an account lookup finds in the files it reads, and whether it skips files."""
    plain, clustered, _ = _clustered(spark, sf)
    lookup = {"account_number": (LOOKUP_ACCOUNT, LOOKUP_ACCOUNT)}
    a = skipping_report(spark, plain, lookup).withColumn("layout", F.lit("unclustered"))
    b = skipping_report(spark, clustered, lookup).withColumn("layout", F.lit("clustered"))
    return a.unionByName(b).select("layout", "rows_found", (F.col("skipped_share") >= 0.5).alias("skips_half"))


@frees_shuffles
def q_skipping_index(spark: SparkSession, sf: str) -> DataFrame:
    """L5 by file statistics: two thirds of the curated table clustered and indexed, the rest appended (its files alone
    are scanned then), and an account lookup through the statistics, whose figures equal those of a scan."""
    path, plain = scratch_path(spark, "indexed"), scratch_path(spark, "silver")
    with silver_in_files(spark, sf) as made:
        made.write.parquet(plain)  # both parts are read several times (bounds, ranges, rows)
    cur = spark.read.schema(made.schema).parquet(plain)
    late = F.col("load_seq") % 3 == 0
    target = max(1, _target_bytes(spark, f"{sf}/lineitem.parquet") // 2)
    tasks = file_count(spark, target, f"{sf}/lineitem.parquet")
    lookup_by = {"account_number": (LOOKUP_ACCOUNT, LOOKUP_ACCOUNT)}
    cluster(cur.filter(~late), ["account_number", "transaction_date"], tasks).write.parquet(path)
    _, all_files = refresh(spark, path, cur.schema, list(lookup_by))
    cluster(cur.filter(late), ["account_number", "transaction_date"], tasks).write.mode("append").parquet(path)
    stats, new_files = refresh(spark, path, cur.schema, list(lookup_by))
    index, scan = skipping_by_index(spark, path, cur.schema, lookup_by).first(), skipping_report(spark, path, lookup_by).first()
    same = (index["files_total"], index["files_read"]) == (scan["files_total"], scan["files_read"])
    return stable(lookup(spark, path, cur.schema, lookup_by)).withColumns({
        "same_as_scan": F.lit(same), "only_new_scanned": F.lit(all_files + new_files == stats.count()),
        "skips_half": F.lit(index["skipped_share"] >= 0.5)})


@frees_shuffles
def q_layout_run(spark: SparkSession, sf: str) -> DataFrame:
    """L4: the runner over a fragmented partitioned table and one that does not exist."""
    root = scratch_path(spark, "layout")
    good = f"{root}/transactions"
    _, rows = _small_files(spark, sf, pieces=YEARS)
    with silver_in_files(spark, sf) as made:
        cur = made.withColumn("year", F.year("transaction_date"))
        cur.write.option("maxRecordsPerFile", rows).partitionBy("year").parquet(good)
    specs = [LayoutSpec(good, ("account_number", "transaction_date"), "year", cur.schema, min_files=2),
             LayoutSpec(f"{root}/missing", ("account_number",), "year", cur.schema)]
    report = run_layout(spark, specs, raise_on_failure=False)
    rows = spark.read.schema(cur.schema).parquet(good).agg(F.count(F.lit(1)).alias("n"))
    return report.join(rows).select(
        F.regexp_extract("path", "[^/]+$", 0).alias("table_name"), "status", (F.coalesce("num_files", F.lit(0)) > 0).alias("has_files"),
        (F.length("error") > 0).alias("has_error"), F.when(F.col("status") == "success", F.col("n")).alias("num_rows"))


def q_daily_chain(spark: SparkSession, sf: str) -> DataFrame:
    """M5 end to end from a landing directory; returns the gold rows of the feature date."""
    zones = Zones(scratch_path(spark, "lake"))
    raw = raw_txn(spark, sf)
    raw.write.parquet(landing_path(zones, RUN_DATE))
    result = daily_chain(
        spark, zones, RUN_DATE, FEATURE_DATE, landing_schema=raw.schema,
        order_by=("_ingestion_timestamp", *adapters.TXN_LOAD_ORDER), on_critical="report", settings=SETTINGS,
    )
    from riskweave.plans.pipelines import gold_schema

    gold = spark.read.schema(gold_schema(spark, raw.schema)).parquet(zones.credit_risk_features)
    del result
    return stable(gold.filter(F.col("feature_date") == F.lit(FEATURE_DATE.isoformat())))


LAYOUT_QUERIES = {
    "table_detail": q_table_detail,
    "compacted": q_compacted,
    "clustered": q_clustered,
    "skipping_report": q_skipping_report,
    "skipping_index": q_skipping_index,
    "layout_run": q_layout_run,
    "daily_chain": q_daily_chain,
}
