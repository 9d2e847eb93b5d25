"""Table sinks on plain Parquet directories (A7-A10, C2/C3 commit).

A table is a directory of Parquet files partitioned by one column. Without a
transactional table format, a merge is done partition by partition: only the
partitions the source touches are rewritten, with dynamic partition overwrite,
so a daily merge rewrites a few days, not the table.

Caveats (single writer assumed): readers may see a partition being replaced;
partitions emptied by a merge are deleted after the write, not atomically with
it. A failed write job leaves the table as it was (files are staged and moved
at job commit), and task retries after a lost executor are Spark's own.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators.upsert import DuplicateKeyError, deal, duplicate_source_keys, match_marks, upsert_by_partition
from riskweave.session import frees_shuffles, scratch_path
from riskweave.sources import key_filter
from riskweave.sources.schema import (
    UNKNOWN,
    Versions,
    begin_change,
    cast_to,
    end_change,
    resolve,
    save_schema,
    saved_schema,
)

HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    """A8: the directory exists (a table emptied by merges still exists)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


PLAIN = re.compile(r"[A-Za-z0-9_.-]+")


def partition_dir(spark: SparkSession, path: str, column: str, value: str | None) -> str:
    """The folder of a partition value, escaped as Spark writes it (None: the default partition)."""
    if value is not None and PLAIN.fullmatch(value) and PLAIN.fullmatch(column):
        return f"{path.rstrip('/')}/{column}={value}"
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{path.rstrip('/')}/{names.getPartitionPathString(column, value)}"


def ordered(values: Iterable[str | None]) -> list[str | None]:
    """Distinct partition values in order, None last."""
    return sorted(set(values), key=lambda v: (v is None, v or ""))


def read_table(spark: SparkSession, path: str, schema: T.StructType, partition_by: str | None = None) -> DataFrame:
    """Read with an explicit schema: partition values keep their type and an empty table still reads.
    ``partition_by`` is needed for a table whose column types have changed."""
    versions = Versions.load(spark, path)
    if not versions.schemas:
        return spark.read.schema(schema).parquet(path)
    if partition_by is None:
        partition_by = partition_column(spark, path)
    return read_partitions(spark, path, schema, partition_by, partition_values(spark, path, partition_by))


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a table's folder: one listing."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    return [x.getName() for x in jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p))]


def partition_column(spark: SparkSession, path: str) -> str | None:
    """The column a table is partitioned by, from the name of a folder."""
    return next((n.partition("=")[0] for n in _folders(spark, path) if "=" in n and not n.startswith(("_", "."))), None)


def partition_values(spark: SparkSession, path: str, partition_by: str) -> list[str | None]:
    """The partition values of a table: one listing of its folder."""
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    lead = f"{partition_by}="
    values = [n[len(lead):] for n in _folders(spark, path) if n.startswith(lead)]
    return ordered(None if v == HIVE_NULL else unescape(v) if "%" in v else v for v in values)


def read_partitions(spark: SparkSession, path: str, schema: T.StructType, partition_by: str,
                    values: Sequence[str | None]) -> DataFrame:
    """Read only the named partitions of a table (None: rows without a partition value).

    The file index then lists just those directories instead of every partition
    of a table that grows by one directory a day; missing partitions are skipped
    and an empty result keeps the schema. Partitions written under an earlier
    version of the schema are read with that version's types and cast.
    """
    there = set(partition_values(spark, path, partition_by)) if table_exists(spark, path) else set()
    named = [(v, partition_dir(spark, path, partition_by, v)) for v in ordered(values) if v in there]
    if not named:
        return spark.createDataFrame([], schema)
    versions = Versions.load(spark, path)
    if not versions.schemas:
        return spark.read.schema(schema).option("basePath", path).parquet(*[d for _, d in named])
    of = {v: versions.of(v) for v, _ in named}
    out = None
    for version in sorted(set(of.values())):
        dirs = [d for v, d in named if of[v] == version]
        if version == UNKNOWN:  # left by an interrupted commit: each partition as its files say
            parts = [_as_written(spark, path, d, schema, partition_by) for d in dirs]
        else:
            own = T.StructType([*versions.schemas[version], *(f for f in schema if f.name not in versions.schemas[version].names)])
            parts = [spark.read.schema(own).option("basePath", path).parquet(*dirs)]
        for part in parts:
            out = cast_to(part, schema) if out is None else out.unionAll(cast_to(part, schema))
    return out


def _as_written(spark: SparkSession, path: str, folder: str, schema: T.StructType, partition_by: str) -> DataFrame:
    found = spark.read.option("mergeSchema", "true").parquet(folder).schema
    own = T.StructType([*found, *(f for f in schema if f.name == partition_by)])
    return spark.read.schema(own).option("basePath", path).parquet(folder)


def stored_schema(spark: SparkSession, path: str, like: T.StructType) -> T.StructType:
    """The schema of a table; for one written by other means, that of all its files with the
    partition column typed as in ``like``."""
    saved = saved_schema(spark, path)
    if saved is not None:
        return saved
    found = spark.read.option("mergeSchema", "true").parquet(path).schema
    types = {f.name: f.dataType for f in like}
    return T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in found])


def optimized_write(df: DataFrame, partition_by: str, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Rebalance rows on the partition column before a partitioned write, then sort
    each task by (partition value, cluster columns).

    ``rebalance`` lets adaptive execution size the write tasks from the data
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``): small partition values
    are packed into one task, a large one (a busy day, a hot account's day) is
    split over several. A write then makes about one file per partition value
    and task, and with ``cluster_by`` every file holds rows sorted by those
    columns, so lookups skip row groups without a later rewrite.
    """
    return df.hint("rebalance", partition_by).sortWithinPartitions(partition_by, *cluster_by)


def _write_observed(spark: SparkSession, df: DataFrame, path: str, partition_by: str,
                    dynamic: bool, cluster_by: Sequence[str] = (), dealt: bool = False) -> tuple[set[str], int]:
    """Write partitioned by ``partition_by``; returns the partition values written and the rows.
    ``dealt``: the rows are in tasks by partition already."""
    obs = Observation(f"write_{uuid.uuid4().hex}")
    part = F.col(partition_by)
    placed = df.sortWithinPartitions(partition_by, *cluster_by) if dealt else optimized_write(df, partition_by, cluster_by)
    observed = placed.observe(
        obs,
        F.collect_set(part.cast("string")).alias("parts"),
        F.count_if(part.isNull()).alias("unplaced"),
        F.count(F.lit(1)).alias("rows"),
    )
    w = observed.write.mode("overwrite")
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.partitionBy(partition_by).parquet(path)
    metrics = obs.get
    parts = set(metrics.get("parts") or []) | ({None} if metrics.get("unplaced") else set())
    return parts, int(metrics.get("rows") or 0)


def _replace_partitions(spark: SparkSession, df: DataFrame, path: str, partition_by: str, touched: set[str | None],
                        cluster_by: Sequence[str] = (), dealt: bool = False) -> tuple[set[str | None], set[str | None], int]:
    """Dynamic overwrite of the partitions ``df`` has; touched ones it has no rows for are deleted.
    Returns the partitions written, those deleted, and the rows."""
    written, rows = _write_observed(spark, df, path, partition_by, dynamic=True, cluster_by=cluster_by, dealt=dealt)
    emptied = {v for v in ordered(touched - written) if delete_path(spark, partition_dir(spark, path, partition_by, v))}
    return written, emptied, rows


@dataclass(frozen=True)
class CommitResult:
    """``staged``: the committed batch, if it was asked to be kept; ``release`` deletes its files. ``source_rows``: the
    rows of the batch; ``read_rows``: the rows the job read to make it, where the job counts them."""

    created: bool
    touched_partitions: tuple[str | None, ...]
    emptied_partitions: tuple[str | None, ...]
    rows_written: int
    staged: DataFrame | None = None
    staging_path: str | None = None
    source_rows: int = 0
    read_rows: int = 0

    def release(self) -> None:
        if self.staged is not None and self.staging_path:
            delete_path(self.staged.sparkSession, self.staging_path)


@frees_shuffles
def commit(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: str,
    on_duplicate: str = "error",
    order_by: Sequence = (),
    cluster_by: Sequence[str] = (),
    keep_staged: bool = False,
    dealt: bool = False,
) -> CommitResult:
    """C2/C3 on a table: upsert ``source`` into the table at ``path``.

    Touched partitions are the source's partitions plus those holding target
    rows the source matches (a matched row may move to another partition; with
    the partition column among the keys it cannot, so nothing is searched).
    Only they are read, merged and rewritten; a touched partition left with no
    row is deleted. The table's schema becomes the union of both, wider types
    winning; types that do not go together raise before anything is written.
    Matched rows keep the columns that only the target has. Rows without a partition value
    live in the default partition. The touched list (one value per partition) is
    the only data brought to the driver. ``cluster_by`` sorts the written files
    by those columns within each partition (see ``optimized_write``).

    A source for a table that exists is staged as Parquet under the shared work folder (several
    steps read some of its columns) and deleted afterwards, unless ``keep_staged``. A new table is
    written once, beside its place, and moved there when its keys are checked; its files are the
    staged batch then. Rows of the source and of the touched partitions are shuffled once, to their
    partition. ``dealt``: the source's rows are in tasks by partition already, which saves that for a new table and for a
    batch that replaces every row of the partitions it touches.
    """
    keys = list(keys)
    if on_duplicate == "latest":
        from riskweave.operators.dedup import keep_latest

        source, dealt = keep_latest(source, keys, list(order_by)), False
    if not table_exists(spark, path):
        written, rows = _create(spark, path, source, keys, partition_by, on_duplicate, cluster_by, dealt)
        staged = read_table(spark, path, source.schema).select(*source.columns) if keep_staged else None
        return CommitResult(True, tuple(ordered(written)), (), rows, staged, None, rows)
    resolve(stored_schema(spark, path, source.schema), source.schema)
    staging = scratch_path(spark, "commit")
    obs = Observation(f"source_{uuid.uuid4().hex}")
    source.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(staging)
    staged = spark.read.schema(source.schema).parquet(staging)
    try:
        touched, emptied, rows = _merge(spark, path, staged, keys, partition_by, on_duplicate, cluster_by, dealt)
    except BaseException:
        delete_path(spark, staging)
        raise
    if not keep_staged:
        delete_path(spark, staging)
    return CommitResult(False, tuple(ordered(touched)), tuple(ordered(emptied)), rows, staged if keep_staged else None,
                        staging if keep_staged else None, int(obs.get.get("rows") or 0))


def _check_keys(source: DataFrame, keys: list[str], on_duplicate: str) -> None:
    if on_duplicate == "error" and duplicate_source_keys(source, keys).limit(1).count():
        raise DuplicateKeyError(f"source has duplicate keys on {keys}")


def _create(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition_by: str, on_duplicate: str,
            cluster_by: Sequence[str], dealt: bool) -> tuple[set, int]:
    parent, _, name = path.rstrip("/").rpartition("/")
    staging = f"{parent}/_new-{name}-{uuid.uuid4().hex[:12]}"
    try:
        written, rows = _write_observed(spark, source, staging, partition_by, dynamic=False, cluster_by=cluster_by, dealt=dealt)
        _check_keys(read_table(spark, staging, source.schema, partition_by), keys, on_duplicate)
        fs, here = _fs(spark, path)
        if not fs.rename(_fs(spark, staging)[1], here):
            raise OSError(f"{staging} could not be moved to {path}")
    except BaseException:
        delete_path(spark, staging)
        raise
    save_schema(spark, path, source.schema)
    _remember(spark, path, source.schema, keys, partition_by, written)
    return written, rows


ROWS_PER_TASK = 1_000_000


def dealt_by_partition(rows: DataFrame, keys: Sequence[str], partition_by: str) -> DataFrame:
    """``rows`` in tasks by partition, as ``commit`` takes them with ``dealt``; those of a large partition in several, by key.
    Rows are counted by partition first: a line for each large one to the driver."""
    part = F.col(partition_by).cast("string").alias("_part")
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > ROWS_PER_TASK).collect()
    buckets = {r["_part"]: -(-r["n"] // ROWS_PER_TASK) for r in counts}
    return deal(rows, partition_by, F.xxhash64(*[F.col(k) for k in keys]), buckets).select(*rows.columns)


def _sizes(target: DataFrame, source: DataFrame, marks: DataFrame | None, part) -> list:
    """(value, rows held, rows that come, rows held that the batch replaces) of each partition: a line a partition,
    from partition values alone."""
    each = [target.select(part, F.lit("held").alias("kind")), source.select(part, F.lit("come").alias("kind"))]
    if marks is not None:
        each.append(marks.select(part, F.lit("gone").alias("kind")))
    counts = [F.count_if(F.col("kind") == k).alias(k) for k in ("held", "come", "gone")]
    return reduce(DataFrame.unionAll, each).groupBy("_part").agg(*counts).collect()


def _merge(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition_by: str, on_duplicate: str,
           cluster_by: Sequence[str], dealt: bool = False) -> tuple[set, set, int]:
    _check_keys(source, keys, on_duplicate)
    schema = stored_schema(spark, path, source.schema)
    wider = resolve(schema, source.schema)
    source = cast_to(source, T.StructType([f for f in wider if f.name.lower() in {c.lower() for c in source.columns}]))
    held_schema = T.StructType([f for f in wider if f.name in schema.names])
    part = F.col(partition_by).cast("string").alias("_part")
    touched_rows, marks, marks_path = source.select(part).distinct(), None, None
    try:
        if partition_by not in keys:
            # Only partitions that may hold a key of the batch are listed and read.
            near = key_filter.possible(spark, path, source, keys, partition_values(spark, path, partition_by))
            target = cast_to(read_partitions(spark, path, schema, partition_by, near), held_schema)
            own = [c for c in target.columns if c not in source.columns]
            found = match_marks(_matched(target, source, keys), source, keys, partition_by, own)
            marks_path = scratch_path(spark, "marks")
            found.write.parquet(marks_path)  # the touched partitions and the merge read them
            marks = spark.read.schema(found.schema).parquet(marks_path)
            touched_rows = touched_rows.unionAll(marks.select(part)).distinct()
        touched = {r["_part"] for r in touched_rows.collect()}
        if not touched:
            return set(), set(), 0
        held = cast_to(read_partitions(spark, path, schema, partition_by, touched), held_schema)
        own = [c for c in held.columns if c not in source.columns]
        sizes = _sizes(held, source, marks.filter("_own IS NULL") if marks is not None and own else marks, part)
        # Partitions of which the batch replaces every row are not read.
        gone = {r["_part"] for r in sizes if r["held"] and r["held"] == r["gone"]}
        mixed = {r["_part"] for r in sizes if r["held"]} - gone
        if mixed or own:
            held = cast_to(read_partitions(spark, path, schema, partition_by, mixed), held_schema)
            if gone and not own:
                marks = marks.filter(F.coalesce(~F.col(partition_by).cast("string").isin([v for v in gone if v is not None]), F.lit(None not in gone)))
            buckets = {r["_part"]: -(-(r["come"] + (r["held"] if r["_part"] in mixed else 0)) // ROWS_PER_TASK) for r in sizes}
            merged = upsert_by_partition(held, source, keys, partition_by, marks, buckets)
        else:
            merged = source
        versions = begin_change(spark, path, schema, wider, touched)
        # A key of another type hashes to another number.
        retyped_key = any(schema[k].dataType != wider[k].dataType for k in keys if k in schema.names)
        key_filter.forget(spark, path, None if retyped_key else touched)
        written, emptied, rows = _replace_partitions(spark, merged, path, partition_by, touched, cluster_by, dealt=dealt or bool(mixed or own))
    finally:
        if marks_path:
            delete_path(spark, marks_path)
    save_schema(spark, path, wider)
    end_change(spark, path, versions, touched)
    _remember(spark, path, wider, keys, partition_by, written)
    return touched, emptied, rows


def _remember(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], partition_by: str, written: set) -> None:
    """Key filters for the partitions just written; a key that holds the partition column needs none."""
    if partition_by not in keys and written:
        key_filter.remember(spark, path, read_partitions(spark, path, schema, partition_by, list(written)), keys, partition_by, written)


def _matched(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key the source has. The source's key range goes to the scan as a
    filter, so row groups outside it are neither read nor shuffled."""
    lo, hi = source.agg(F.min(keys[0]), F.max(keys[0])).first()
    if lo is None:
        return target.limit(0)
    return target.filter(F.col(keys[0]).between(F.lit(lo), F.lit(hi))).join(source.select(*keys), keys, "left_semi")


def write_partition(spark: SparkSession, df: DataFrame, path: str, partition_by: str, value: str) -> int:
    """A9: replace one partition (the run's) with ``df``; an empty ``df`` deletes it.

    Reruns for the same run date give the same table, unlike an append.
    """
    return replace_partitions(spark, df, path, partition_by, [value]).rows_written


@frees_shuffles
def replace_partitions(spark: SparkSession, df: DataFrame, path: str, partition_by: str, values: Iterable[str | None],
                       cluster_by: Sequence[str] = ()) -> CommitResult:
    """Put ``df`` in place of the whole partitions ``values``; those it has no rows for go."""
    created = not table_exists(spark, path)
    if created:
        written, rows = _write_observed(spark, df, path, partition_by, dynamic=False, cluster_by=cluster_by)
        emptied = set()
        save_schema(spark, path, df.schema)
    else:
        schema = stored_schema(spark, path, df.schema)
        wider = resolve(schema, df.schema)
        out = cast_to(df, wider)
        versions = begin_change(spark, path, schema, wider, set(values))
        key_filter.forget(spark, path, set(values) | {r[0] for r in out.select(F.col(partition_by).cast("string")).distinct().collect()}
                          if key_filter.held(spark, path) else ())
        written, emptied, rows = _replace_partitions(spark, out, path, partition_by, set(values), cluster_by)
        save_schema(spark, path, wider)
        end_change(spark, path, versions, set(values) | written)
    return CommitResult(created, tuple(ordered(written | emptied)), tuple(ordered(emptied)), rows)
