"""Helpers shared by the training-data operators.

Operators take any DataFrame that has the named columns; further columns are
carried along untouched. Helper columns all start with ``__`` so that they do not
clash with the caller's, and a result column replaces a caller's column of the
same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import scratch_path

#: A word: a run of characters that are neither space nor U+0009..U+000D.
WORD = r"[^ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh folder under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files that every executor sees, keeps column pruning
    for later reads and fixes values such as partition ids that a recomputation
    could change.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the folder of a staged table that no later result reads."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def text_or_empty(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """Bind ``value`` once as a lambda variable for ``body`` (evaluated once per row)."""
    return F.transform(F.array(value), body)[0]


def hash60(*values: Column, seed: str) -> Column:
    """A 60-bit hash that DuckDB can compute too: the first 15 hex digits of an MD5."""
    parts = [F.coalesce(v.cast("string"), F.lit("")) for v in values]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *parts)), 1, 15), 16, 10).cast("long")


def attach(df: DataFrame, results: dict[str, Column]) -> DataFrame:
    """The caller's columns (but for ``__`` helpers) and the results; results win a name clash."""
    taken = {n.lower() for n in results}
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken and not c.startswith("__")]
    return df.select(*keep, *[c.alias(n) for n, c in results.items()])
