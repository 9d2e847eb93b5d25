"""The corpus pipeline: quality rules, near-dedup, personal data, mixing, packing.

Each stage reads all that the stage before kept, as a table in the shared folder.

Defined cases: null text counts as empty, so the quality rules reject it; equal rows are
judged alike, and near-dedup keeps one of them; a document that the mix takes twice
comes out as two rows and is packed twice; empty tables give an empty result, without
labels no text is trusted and the base rules alone decide; further columns of documents pass
through all stages but the last, whatever their names; ties are settled by doc_id or a hash of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import mixing, packing, pii, quality_rules, simhash
from riskweave.llm.common import stage, table


def _wrapped(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns an operator reads, and all others in one struct that its results cannot clash with."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*needed, *([F.struct(*others).alias("payload")] if others else []))


def _unwrapped(rows: DataFrame, docs: DataFrame, *needed: str) -> DataFrame:
    """The columns of ``docs``, in their order."""
    return rows.select(*[(F.col(c) if c in needed else F.col("payload").getField(c)).alias(c) for c in docs.columns])


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    trusted = quality_rules.trusted_sample(table(spark, sf_dir, "labels"))
    needed = ("doc_id", "text")
    return _unwrapped(quality_rules.judge_documents(_wrapped(docs, *needed), trusted).filter("kept"), docs, *needed)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    needed = ("doc_id", "text")
    return _unwrapped(simhash.group_documents(_wrapped(docs, *needed)).filter("first"), docs, *needed)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind."""
    return pii.redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document goes in as often as the mix takes it (0, 1 or 2 times)."""
    needed = ("doc_id", "text", "source")
    mixed = mixing.mix_documents(_wrapped(docs, *needed))
    times = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(F.lit(0)).cast("int")
    copies = mixed.filter(times > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), times)))
    return _unwrapped(copies, docs, *needed)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", judge),
    ("simhash near-dedup", deduplicate),
    ("personal data", redact),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "stage-" + name.split()[0])
    return docs


#: The last stage's token ids have no SQL form.
ORACLE_SQL = None
