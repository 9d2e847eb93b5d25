"""Table layout jobs (L1-L5): compaction, multi-column clustering, table detail,
skipping report and a runner over a list of table specs.

These are rewrites of a Parquet table's files, so they are ordinary Spark jobs:

* ``cluster`` maps each clustering column to a bucket number through bounds taken
  from a bounded sample of its values (compared in the column's own type, so long
  common prefixes do not matter), interleaves the bucket bits into one Z-value,
  range-partitions on ``(partition column, Z, row hash)`` and sorts within
  partitions. Files then hold narrow ranges of every clustering column, so
  Parquet min/max statistics let lookups skip them. The row hash lets one hot
  Z-value (a hot account) spread over several files instead of one oversized task.
* ``compact`` joins the small files of each folder (first-fit decreasing over the
  listing), one task a group, without a shuffle; other files are not touched.
* File counts and sizes come from a listing (one row per file), never from rows.
* In-place rewrites replace whole partitions with dynamic partition overwrite
  (staged, moved at job commit), so a failed job leaves the table unchanged.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Sequence
from contextlib import AbstractContextManager
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.session import frees_shuffles, setting
from riskweave.sources.schema import Versions, load_json, save_json

TARGET_FILE_BYTES = 128 * 1024 * 1024
SAMPLE_ROWS = 50_000
SORT_ROWS = 2_000_000


def files(spark: SparkSession, *paths: str) -> DataFrame:
    """(file_path, file_size, modified) of the Parquet files under the folders: a listing, no content."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return listed.load(list(paths)).select(
        F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified"))


def table_detail(spark: SparkSession, path: str) -> DataFrame:
    """L3: ``num_files, size_bytes, last_modified`` of a Parquet table."""
    return files(spark, path).agg(
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).cast("bigint").alias("size_bytes"),
        F.max("modified").alias("last_modified"),
    )


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in df.columns])


def bounds(df: DataFrame, columns: Sequence[str], buckets: int, sample_rows: int = SAMPLE_ROWS, count: int | None = None) -> list[list]:
    """For each column, distinct upper quantiles of a bounded sample of its values (at most ``buckets - 1``).
    All columns come from one count (``count``, if it is known) and one sample, however many there are."""
    rows = df.select(*columns)
    share = min(1.0, sample_rows / max(1, rows.count() if count is None else count))
    sample = (rows if share == 1.0 else rows.sample(share, 17)).collect()
    out = []
    for at in range(len(columns)):
        picked = sorted(r[at] for r in sample if r[at] is not None and r[at] == r[at])  # neither NULL nor NaN
        out.append(sorted({picked[len(picked) * i // buckets] for i in range(1, buckets)}) if picked else [])
    return out


def _bucket(edges: list, column: Column) -> Column:
    """Number of ``edges`` at or below the value (0 for NULL).

    A balanced CASE tree: a binary search of ``log2(len(edges))`` comparisons
    that stays inside generated code, instead of a scan over an array.
    """

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo).cast("bigint")
        mid = (lo + hi + 1) // 2
        return F.when(column >= F.lit(edges[mid - 1]), search(mid, hi)).otherwise(search(lo, mid - 1))

    return F.when(column.isNull(), F.lit(0).cast("bigint")).otherwise(search(0, len(edges)))


def with_z_value(df: DataFrame, columns: Sequence[str], bits: int = 8, name: str = "_z", count: int | None = None) -> DataFrame:
    """``df`` with the interleaved bucket bits of ``columns`` (``2**bits`` buckets each).

    The bucket numbers are computed in a projection of their own, once per row;
    spreading their bits takes a few shifts.
    """
    numbers = [f"_zb{i}" for i in range(len(columns))]
    edges = bounds(df, columns, 2**bits, count=count)
    out = df.withColumns({b: _bucket(e, F.col(c)) for b, e, c in zip(numbers, edges, columns)})
    z = F.lit(0).cast("bigint")
    for j, b in enumerate(numbers):
        for bit in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(F.col(b), bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(columns) + j))
    return out.withColumn(name, z).drop(*numbers)


def cluster(df: DataFrame, columns: Sequence[str], files: int, partition_by: str | None = None,
            bits: int = 8) -> DataFrame:
    """L2: rows range-partitioned into about ``files`` tasks by Z-order of ``columns``; more, if a task would have more
    than ``SORT_ROWS`` rows, as each task sorts its rows in memory and file sizes do not tell how many there are."""
    lead, count = [partition_by] if partition_by else [], df.select(*columns).count()
    files = max(files, math.ceil(count / SORT_ROWS))
    # The row hash decides the range only; it is not sent with the row.
    return (
        with_z_value(df, columns, bits, count=count)
        .repartitionByRange(files, *lead, "_z", row_hash(df))
        .sortWithinPartitions(*lead, "_z", *columns)
        .drop("_z")
    )


def file_count(spark: SparkSession, target_bytes: int, *paths: str) -> int:
    """Files of about ``target_bytes`` that hold what is under the folders now."""
    size = files(spark, *paths).agg(F.sum("file_size")).first()[0] or 0
    return max(1, math.ceil(size / target_bytes))


def _write(df: DataFrame, path: str, partition_by: str | None, in_place: bool) -> None:
    w = df.write.mode("overwrite")
    if in_place:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


JOB_GROUPS = 200
JOURNAL = "_compaction.json"


def first_fit(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """First-fit decreasing: positions of the sizes in groups of at most ``capacity`` (a larger one is a group of its own)."""
    groups, room = [], []
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        at = next((g for g, left in enumerate(room) if sizes[i] <= left), None)
        if at is None:
            groups.append([])
            room.append(capacity)
            at = len(groups) - 1
        groups[at].append(i)
        room[at] -= sizes[i]
    return [sorted(g) for g in groups]


def file_groups(spark: SparkSession, path: str, target_file_bytes: int) -> DataFrame:
    """(folder, file_paths, n): the files of each folder grouped to about the target size; ``n`` files in the group.
    Only listings are looked at; the files of one folder are grouped in one task."""
    listed = files(spark, path).select(F.regexp_extract("file_path", "^(.*)/[^/]*$", 1).alias("folder"), "file_path", "file_size")

    def group(pdf):
        pdf = pdf.sort_values("file_path")
        names, found = pdf["file_path"].tolist(), first_fit(pdf["file_size"].tolist(), target_file_bytes)
        return pd.DataFrame({"folder": pdf["folder"].iloc[0].rpartition("/")[2], "file_paths": [[names[i] for i in g] for g in found], "n": [len(g) for g in found]})

    return listed.groupBy("folder").applyInPandas(group, "folder string, file_paths array<string>, n int")


UNION_PARTITIONING = "spark.sql.unionOutputPartitioning"


def _apart(spark: SparkSession) -> AbstractContextManager[None]:
    """Unions keep the tasks of their parts. By default Spark 4.1 joins parts of the same partitioning partition by
    partition, so a union of parts of one task each would be one task that reads them all."""
    return setting(spark, UNION_PARTITIONING, "false")


def _merged(spark: SparkSession, path: str, schema: T.StructType, groups: Sequence[Sequence[str]]) -> DataFrame:
    """The rows of each group in a task of its own (run it under ``_apart``): no shuffle, and the rows of a file stay
    together in their order."""
    reader = spark.read.schema(schema).option("basePath", path)
    return reduce(DataFrame.unionAll, [reader.parquet(*g).coalesce(1) for g in groups])


def compact(spark: SparkSession, path: str, schema: T.StructType, out_path: str | None = None,
            partition_by: str | None = None, target_file_bytes: int = TARGET_FILE_BYTES) -> int:
    """L1: join small files, folder by folder, into files of about the target size; returns the files written.

    In place (``out_path=None``) only groups of two files at least are read; files that are
    large enough, or alone, keep their name and time. With ``out_path`` every row is copied.
    Rows are not shuffled, so a clustered table stays clustered. Joined files are staged in a
    hidden folder first, and a journal says which files they replace: a run that is lost while
    it replaces them is completed by the next one (``finish_compaction``).
    """
    finish_compaction(spark, path)
    groups = file_groups(spark, path, target_file_bytes)
    versions = Versions.load(spark, path)
    if versions.schemas and partition_by:  # files of an earlier type wait until a merge rewrites them
        from riskweave.sources.tables import partition_dir, partition_values

        now = [v for v in partition_values(spark, path, partition_by) if versions.of(v) == len(versions.schemas) - 1]
        groups = groups.filter(F.col("folder").isin([partition_dir(spark, path, partition_by, v).rpartition("/")[2] for v in now]))
    todo = [list(r["file_paths"]) for r in (groups if out_path else groups.filter("n > 1")).toLocalIterator()]
    for at in range(0, len(todo), JOB_GROUPS):
        some = todo[at : at + JOB_GROUPS]
        staged = None if out_path else f"{path.rstrip('/')}/_compacted-{uuid.uuid4().hex[:12]}"
        with _apart(spark):
            writer = _merged(spark, path, schema, some).write.mode("append")
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(out_path or staged)
        if staged:
            save_json(spark, path, JOURNAL, {"staged": staged, "replaced": [f for g in some for f in g]})
            finish_compaction(spark, path)
    return len(todo)


def finish_compaction(spark: SparkSession, path: str) -> bool:
    """Carry out what the journal of a compaction says: replaced files go, staged ones take their place."""
    found = load_json(spark, path, JOURNAL)
    if found is None:
        return False
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    here = hadoop.Path(path)
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    staged = hadoop.Path(found["staged"])
    for f in found["replaced"]:
        fs.delete(hadoop.Path(f), False)
    if fs.exists(staged):
        lead = fs.makeQualified(staged).toString()
        each = fs.listFiles(staged, True)
        while each.hasNext():
            f = each.next().getPath()
            if f.getName().endswith(".parquet"):
                to = hadoop.Path(here, f.toString()[len(lead) + 1 :])
                fs.mkdirs(to.getParent())
                fs.rename(f, to)
        fs.delete(staged, True)
    fs.delete(hadoop.Path(here, JOURNAL), False)
    return True


def fragmented_partitions(spark: SparkSession, path: str, partition_by: str, min_files: int,
                          values: Sequence[str | None] | None = None) -> list[str | None]:
    """Partition values stored in at least ``min_files`` files (one value per partition to the driver).
    ``values`` limits the listing to those partitions."""
    from riskweave.sources.tables import HIVE_NULL, partition_dir, partition_values

    there = set() if values is None else set(partition_values(spark, path, partition_by))
    roots = [path] if values is None else [partition_dir(spark, path, partition_by, v) for v in values if v in there]
    if not roots:
        return []
    folder = F.regexp_extract("file_path", f"/{re.escape(partition_by)}=([^/]*)/[^/]*$", 1)
    counts = files(spark, *roots).groupBy(folder.alias("p")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_files)
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    # A listing gives URIs, in which the folder name's own escapes are escaped once more.
    found = [names.unescapePathName(unquote(r["p"])) for r in counts.collect()]
    return [None if v == HIVE_NULL else v for v in found]


@frees_shuffles
def optimise(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str],
             partition_by: str | None = None, out_path: str | None = None,
             partitions: Sequence[str] | None = None, target_file_bytes: int = TARGET_FILE_BYTES,
             min_files: int = 1) -> int:
    """L1 + L2: rewrite (optionally only some partitions) clustered by ``columns``.

    With ``min_files > 1`` only partitions stored in at least that many files are
    rewritten (the others are already compact). Returns the file count asked for.
    """
    if out_path is None and not partition_by:
        raise ValueError("in-place clustering needs a partitioned table")
    from riskweave.sources.tables import partition_dir, read_partitions

    roots = [path]
    if partition_by and (partitions is not None or min_files > 1):
        todo = fragmented_partitions(spark, path, partition_by, min_files, partitions)
        if not todo:
            return 0
        df = read_partitions(spark, path, schema, partition_by, todo)
        roots = [partition_dir(spark, path, partition_by, v) for v in todo]
    else:
        df = spark.read.schema(schema).parquet(path)
    wanted = file_count(spark, target_file_bytes, *roots)
    _write(cluster(df, columns, wanted, partition_by), out_path or path, partition_by, out_path is None)
    return wanted


def skipping_report(spark: SparkSession, path: str, predicates: dict[str, tuple]) -> DataFrame:
    """L5: how many files a lookup must read, judging by per-file min/max.

    ``predicates`` maps column -> ``(lo, hi)`` (inclusive; equal for a point
    lookup). A file is read when every predicate's range overlaps the file's
    ``[min, max]`` of that column; ``rows_found`` counts the matching rows in those files.
    """
    df = spark.read.parquet(path)
    aggs, match = [], F.lit(True)
    for c, (lo, hi) in predicates.items():
        match = match & F.col(c).between(F.lit(lo), F.lit(hi))
    for c in predicates:
        aggs += [F.min(c).alias(f"_min_{c}"), F.max(c).alias(f"_max_{c}")]
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count_if(match).alias("_matching"), *aggs)
    overlap = F.lit(True)
    for c, (lo, hi) in predicates.items():
        overlap = overlap & (F.col(f"_max_{c}") >= F.lit(lo)) & (F.col(f"_min_{c}") <= F.lit(hi))
    return per_file.agg(
        F.count(F.lit(1)).alias("files_total"),
        F.count_if(overlap).alias("files_read"),
        F.coalesce(F.sum(F.when(overlap, F.col("_matching"))), F.lit(0)).alias("rows_found"),
    ).withColumn("skipped_share", F.when(F.col("files_total") > 0,
                                         1 - F.col("files_read") / F.col("files_total")))


@dataclass(frozen=True)
class LayoutSpec:
    path: str
    columns: tuple[str, ...]
    partition_by: str | None = None
    schema: T.StructType | None = None
    partitions: tuple[str, ...] | None = None
    target_file_bytes: int = TARGET_FILE_BYTES
    min_files: int = 1


LAYOUT_RESULT = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("num_files", T.LongType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("last_modified", T.TimestampType()),
        T.StructField("error", T.StringType()),
    ]
)


def run_layout(spark: SparkSession, specs: Sequence[LayoutSpec], dry_run: bool = False,
               raise_on_failure: bool = True) -> DataFrame:
    """L4: cluster each table and report its files, bytes and last change; dry runs only report. Failures are collected and
    raised after every table was tried."""
    rows, failed = [], []
    for spec in specs:
        if dry_run:
            rows.append((spec.path, "skipped (dry_run)", None, None, None, None))
            continue
        try:
            schema = spec.schema or spark.read.parquet(spec.path).schema
            optimise(spark, spec.path, schema, spec.columns, spec.partition_by,
                     partitions=spec.partitions, target_file_bytes=spec.target_file_bytes,
                     min_files=spec.min_files)
            detail = table_detail(spark, spec.path).first()
            rows.append((spec.path, "success", detail["num_files"], detail["size_bytes"], detail["last_modified"], None))
        except Exception as exc:  # noqa: BLE001 - collect, raise after all specs
            rows.append((spec.path, "failed", None, None, None, str(exc)))
            failed.append(spec.path)
    result = spark.createDataFrame(rows, LAYOUT_RESULT)
    if failed and raise_on_failure:
        raise RuntimeError(f"{len(failed)} table(s) failed layout: {failed}")
    return result
