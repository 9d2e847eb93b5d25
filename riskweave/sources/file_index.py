"""Per-file statistics of a Parquet table, and lookups that read only the files which may match (L5).

Beside the table lies one row per data file: its rows and, for each indexed column,
the smallest and largest value. ``refresh`` compares the statistics with the listing
(name, size, last change) and scans the new files alone, so a daily merge costs a scan
of the partitions it rewrote. Statistics are written as a new folder and a pointer file
moves to it last: a run that is lost leaves the former ones, and files that changed
since are then found by the listing.

A lookup passes the names of the files that may match to the scan, at most
``NAMES_IN_PLAN``; a lookup that touches more is a scan with pushed filters, with the
same rows. Values are compared in the column's type. NULLs never match, a NaN counts as
the largest value, a file without a value of a column holds nothing for a lookup on it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.sources.schema import load_json, save_json
from riskweave.sources.tables import delete_path

POINTER = "_file_index.json"
FOLDER = "_file_index"
NAMES_IN_PLAN = 5_000
MARK = ("file_path", "file_size", "modified")


def _of_file(df: DataFrame) -> list[Column]:
    meta = F.col("_metadata")
    return [meta["file_path"].alias("file_path"), meta["file_size"].alias("file_size"), meta["file_modification_time"].alias("modified")]


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_size, modified) of the data files, named as scans name them; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return found.select(*_of_file(found))


def _measure(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per file; tasks hand on one partial row for each of their files."""
    aggs = [F.count(F.lit(1)).alias("num_rows")]
    for i, c in enumerate(columns):
        aggs += [F.min(f"_v{i}").alias(f"min_{c}"), F.max(f"_v{i}").alias(f"max_{c}")]
    values = [F.col(c).alias(f"_v{i}") for i, c in enumerate(columns)]
    return rows.select(*_of_file(rows), *values).groupBy(*MARK).agg(*aggs)


def _stored(spark: SparkSession, path: str, columns: Sequence[str], schema: T.StructType) -> DataFrame | None:
    """The statistics, if they cover the columns in their present types."""
    at = load_json(spark, path, POINTER)
    if at is None:
        return None
    held = T.StructType.fromJson(at["schema"])
    want = {f"{side}_{c}": schema[c].dataType for c in columns for side in ("min", "max")}
    same = all(name in held.names and held[name].dataType == kind for name, kind in want.items())
    return spark.read.schema(held).parquet(at["folder"]) if same else None


def refresh(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str]) -> tuple[DataFrame, int]:
    """(statistics of the files there are now, files that were scanned for them).

    Without statistics on the columns, or with more new files than a plan takes names, the whole table is scanned,
    the indexed columns only. An empty table has no rows of statistics.
    """
    columns = list(dict.fromkeys(columns))
    here = listing(spark, path)
    table = spark.read.schema(schema).parquet(path)
    known = _stored(spark, path, columns, schema)
    if known is None:
        current = _measure(table, columns)
    else:
        new = [r["file_path"] for r in islice(here.join(known, list(MARK), "left_anti").toLocalIterator(), NAMES_IN_PLAN + 1)]
        kept = known.select(*MARK, "num_rows", *[f"{side}_{c}" for c in columns for side in ("min", "max")]).join(here, list(MARK), "left_semi")
        if len(new) > NAMES_IN_PLAN:
            current = _measure(table, columns)
        elif new:
            current = kept.unionByName(_measure(table.filter(F.col("_metadata.file_path").isin(new)), columns))
        else:
            return kept, 0
    former = load_json(spark, path, POINTER)
    folder = f"{path.rstrip('/')}/{FOLDER}/{uuid.uuid4().hex[:12]}"
    current.write.parquet(folder)
    save_json(spark, path, POINTER, {"folder": folder, "schema": current.schema.jsonValue()})
    if former is not None:
        delete_path(spark, former["folder"])
    stored = spark.read.schema(current.schema).parquet(folder)
    return stored, stored.count() if known is None or len(new) > NAMES_IN_PLAN else len(new)


def may_match(predicates: Mapping[str, tuple]) -> Column:
    """Whether a file's ranges overlap all of ``column -> (lo, hi)`` (inclusive)."""
    out = F.lit(True)
    for c, (lo, hi) in predicates.items():
        out = out & (F.col(f"max_{c}") >= F.lit(lo)) & (F.col(f"min_{c}") <= F.lit(hi))
    return F.coalesce(out, F.lit(False))


def skipping_by_index(spark: SparkSession, path: str, schema: T.StructType, predicates: Mapping[str, tuple]) -> DataFrame:
    """L5 from statistics alone: files and rows of the table, those a lookup reads, and the share of files it skips."""
    stats, _ = refresh(spark, path, schema, list(predicates))
    hit = may_match(predicates)
    return stats.agg(
        F.count(F.lit(1)).alias("files_total"), F.count_if(hit).alias("files_read"),
        F.coalesce(F.sum("num_rows"), F.lit(0)).alias("rows_total"),
        F.coalesce(F.sum(F.when(hit, F.col("num_rows"))), F.lit(0)).alias("rows_read"),
    ).withColumn("skipped_share", F.when(F.col("files_total") > 0, 1 - F.col("files_read") / F.col("files_total")))


def lookup(spark: SparkSession, path: str, schema: T.StructType, predicates: Mapping[str, tuple]) -> DataFrame:
    """The rows within all of ``column -> (lo, hi)``, from the files that may hold some."""
    stats, _ = refresh(spark, path, schema, list(predicates))
    rows = spark.read.schema(schema).parquet(path)
    match = F.lit(True)
    for c, (lo, hi) in predicates.items():
        match = match & F.col(c).between(F.lit(lo), F.lit(hi))
    names = [r["file_path"] for r in stats.filter(may_match(predicates)).select("file_path").limit(NAMES_IN_PLAN + 1).collect()]
    if len(names) <= NAMES_IN_PLAN:
        rows = rows.filter(F.col("_metadata.file_path").isin(names)) if names else rows.limit(0)
    return rows.filter(match)
