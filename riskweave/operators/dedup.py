"""Keep-latest deduplication (E1) and the duplicate-key measure (D4)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = str | Column


def _desc(c: ColumnLike) -> Column:
    return F.col(c).desc_nulls_last() if isinstance(c, str) else c


BUCKETS = 1 << 16
CROWDED = 100_000
PIECE_ROWS = 500_000


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(BUCKETS)).alias("_bucket")


def crowded_buckets(df: DataFrame, keys: Sequence[str], crowded: int = CROWDED) -> DataFrame:
    """Hash buckets of the keys that hold far more rows than others, so a key with very many copies (``_bucket``).
    Counted over all rows; a map task sends at most a row a bucket."""
    counts = df.select(_bucket(keys)).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    usual = counts.agg((F.sum("n") * 8 / BUCKETS).alias("usual"))
    return counts.crossJoin(F.broadcast(usual)).filter(F.col("n") > F.col("usual") + F.lit(crowded)).select("_bucket")


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[ColumnLike], crowded: int = CROWDED,
                place: Sequence[str] | None = None, whole: bool = False, tie: Column | None = None) -> DataFrame:
    """One row per key: the first by ``order_by`` (names mean "descending").

    Rows that tie on every ``order_by`` column are ordered by a hash of the whole
    row, so the winner is a function of the input, not of task scheduling.

    Plan: rows are shuffled by key once and sorted there, in partitions that fit in memory.
    Cutting to one row a key before the shuffle would sort whole map tasks, whose rows are far
    larger than the files they read, on disk. Only keys with very many copies pay for that: rows of
    ``crowded_buckets`` take ``row_number() == 1``, for which Catalyst inserts a partial
    WindowGroupLimit, so a key with millions of copies sends at most one row per map task.

    The hash of a row is made before the shuffle, so that columns the caller drops afterwards are not
    sent. With ``whole`` (the caller keeps every column) it is made behind it, as its eight bytes do
    not compress; the rows are the same.

    With ``place`` (the columns a table is stored and sorted by) whole rows move once, to their place: see
    ``latest_in_place``. The rows are the same.

    ``tie``: what settles ties instead of the hash of the whole row.
    """
    if place is not None:
        return latest_in_place(df, keys, order_by, place, crowded)
    tiebreak = F.xxhash64(*[F.col(c) for c in df.columns]) if tie is None else tie
    w = Window.partitionBy(*keys).orderBy(*[_desc(c) for c in order_by], tiebreak.desc())
    hot = F.broadcast(crowded_buckets(df, keys, crowded))
    rows = df.withColumn("_bucket", _bucket(keys))
    usual, copied = (rows.join(hot, "_bucket", how).select(*df.columns) for how in ("left_anti", "left_semi"))
    if whole:
        usual = usual.repartition(*[F.col(k) for k in keys])
    # The first row of a key has none before it; no limit is inferred from that.
    first = usual.withColumn("_before", F.lag(F.lit(1)).over(w)).filter(F.col("_before").isNull()).drop("_before")
    cut = copied.withColumn("_row_num", F.row_number().over(w)).filter(F.col("_row_num") == 1).drop("_row_num")
    return first.unionAll(cut)


def latest_in_place(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], place: Sequence[str],
                    crowded: int = CROWDED, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Keep-latest for rows that a table stores by ``place[0]`` and sorts by ``place``: no whole row is sent by key.

    Key, place, order and hash of every row are sent by key. Where a key has rows in other places than its first
    row's, a mark (key and place) is made. Whole rows and marks are sent by ``place[0]``, and a key with a mark has
    no row in that place. The one sort there also is the table's. A value of ``place[0]`` ends in one partition,
    one with more than ``piece_rows`` rows in several, by key. Rows of crowded keys are cut to one per key and place
    before either shuffle.

    ``df`` is read four times and must give the same rows each time. Two counts run at once; what reaches the driver
    is the numbers of crowded buckets and the values with more than ``piece_rows`` rows.
    """
    order, tie = [_desc(c) for c in order_by], F.xxhash64(*[F.col(c) for c in df.columns])
    key_hash = F.xxhash64(*[F.col(k) for k in keys])
    rows, hot = df, [r["_bucket"] for r in crowded_buckets(df, keys, crowded).collect()]
    if hot:
        here = Window.partitionBy(*keys, *place).orderBy(*order, tie.desc())
        cut = df.filter(_bucket(keys).isin(hot)).withColumn("_row_num", F.row_number().over(here))
        rows = df.filter(~_bucket(keys).isin(hot)).unionAll(cut.filter(F.col("_row_num") == 1).drop("_row_num"))

    by_key = Window.partitionBy(*keys).orderBy(*order, F.col("_tie").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    narrow = rows.select(*dict.fromkeys([*keys, *place, *order_by]), tie.alias("_tie"))
    # A column each: a struct of them would be made, and sent, beside them.
    narrow = narrow.select("*", *[F.first(c).over(by_key).alias(f"_first{i}") for i, c in enumerate(place)])
    there = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_first{i}")) for i, c in enumerate(place)])
    own = {*keys, *place}
    marks = narrow.filter(~there).select(
        *[F.col(f.name) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])

    both, to = rows.withColumn("_mark", F.lit(False)).unionAll(marks.withColumn("_mark", F.lit(True))), [place[0]]
    large = [(r[0], -(-r[1] // piece_rows)) for r in df.groupBy(place[0]).count().filter(F.col("count") > piece_rows).collect()]
    if large:
        value = T.StructField("_value", df.schema[place[0]].dataType)
        pieces = df.sparkSession.createDataFrame(large, T.StructType([value, T.StructField("_pieces", T.LongType())]))
        both = both.join(F.broadcast(pieces), F.col(place[0]).eqNullSafe(F.col("_value")), "left")
        both, to = both.withColumn("_piece", F.pmod(key_hash, F.col("_pieces"))).drop("_value", "_pieces"), [place[0], "_piece"]
    w = Window.partitionBy(*place, *keys, *to[1:]).orderBy(F.col("_mark").desc(), *order, tie.desc())
    first = both.repartition(*[F.col(c) for c in to]).withColumn("_before", F.lag(F.lit(1)).over(w))
    return first.filter(F.col("_before").isNull() & ~F.col("_mark")).select(*df.columns)


MASK_ROWS = 1 << 15  # the bits of a bitmap that bitmap_construct_agg makes
MASK_BYTES = 128 << 20


def with_position(df: DataFrame) -> DataFrame | None:
    """``df`` with the file (``_file``) of each row and its number there (``_row``); None where rows are not those of files."""
    if {"_file", "_row"} <= set(df.columns):
        return df
    try:
        return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return None


def mask_bytes(placed: DataFrame) -> int:
    """The size of a bit for every row of ``placed`` (``with_position``): no data column is read, a row a file is summed."""
    blocks = F.ceil((F.max("_row") + 1) / F.lit(MASK_ROWS))
    return (placed.groupBy("_file").agg(blocks.alias("n")).agg(F.sum("n")).first()[0] or 0) * MASK_ROWS // 8


def latest_in_files(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], path: str, crowded: int = CROWDED,
                    count: Observation | None = None) -> DataFrame | None:
    """Keep-latest for rows of Parquet files: whole rows are not shuffled, they stay in the tasks that read them.

    Key, order, hash and position (file, number in it) of every row are sent by key. The positions of the first rows
    become bitmaps of 32,768 rows, stored at ``path``; a second scan keeps the rows whose bit is set. The bitmaps are
    broadcast, a bit a row of the files: None is returned where they would pass ``MASK_BYTES``, or where ``df`` is not
    rows as files hold them (``with_position``; its columns may be there already, and are not returned). The caller deletes ``path`` when the rows are written. Ties are settled as by ``keep_latest``.
    ``count`` gets the rows of ``df`` as ``rows``.
    """
    spark, placed, columns = df.sparkSession, with_position(df), [c for c in df.columns if c not in ("_file", "_row")]
    if placed is None or mask_bytes(placed) > MASK_BYTES:
        return None
    tie = F.xxhash64(*[F.col(c) for c in columns]).alias("_tie")
    narrow = placed.select(*dict.fromkeys([*keys, *order_by]), tie, "_file", "_row")
    if count is not None:
        narrow = narrow.observe(count, F.count(F.lit(1)).alias("rows"))
    first = keep_latest(narrow, keys, order_by, crowded, tie=F.col("_tie"))
    block, bit = F.expr(f"_row div {MASK_ROWS}").alias("_block"), (F.col("_row") % MASK_ROWS).alias("_bit")
    bits = first.select("_file", block, bit).hint("repartition", "_file", "_block").groupBy("_file", "_block").agg(
        F.bitmap_construct_agg("_bit").alias("_bits"))
    bits.write.parquet(path)
    masks = F.broadcast(spark.read.schema(bits.schema).parquet(path))
    rows = placed.select("*", block, bit).join(masks, ["_file", "_block"])
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.filter(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).select(*columns)


def duplicate_key_count(key: ColumnLike) -> Column:
    """Aggregate: rows minus distinct keys, NULL counting as one key; 0 on empty input."""
    k = F.col(key) if isinstance(key, str) else key
    n = F.count(F.lit(1)) - F.count_distinct(k) - F.max(k.isNull().cast("bigint"))
    return F.coalesce(n, F.lit(0).cast("bigint"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.agg(duplicate_key_count(key).alias("duplicate_count"))
