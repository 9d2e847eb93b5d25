"""Mixing sources to target weights by weighted fair queueing.

Every document of a source is queued in a shuffled order, twice over when the
source may repeat. A queued copy finishes at the virtual time ``cumulative words
of its source / target of its source``, so each source has delivered its target
at time 1. The copies of all sources are range-sorted by virtual finish time and
the sequence is cut at the total budget.

Distribution: cumulative sums are two-level. Per source, a 12-bit bucket of the
shuffle hash splits a hot source into 4,096 pieces whose sums are pre-aggregated;
the window then runs per (source, bucket). The global order is a range
partitioning with one sum per range; only the range that holds the cut is
summed row by row.

Defined cases: null text has size 0; a null source is a source of its own, last
in order; a null document id hashes like the empty string; equal rows are
separate documents; an empty table gives an empty result; sources of size 0
have target 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import attach, drop_staged, hash60, stage, word_count

SEED = "mix-1"
BUCKET_SHIFT = 48  # 60-bit hash -> 4,096 buckets a source


def source_targets(sources: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: float = 1.5,
                   max_repeat: int = 2) -> DataFrame:
    """Targets of (source, source_size) rows: shares of ``budget`` times all words by
    weight, each at most ``max_repeat`` times the source, the excess reshared.

    Water filling: with sources sorted by cap / weight the capped ones come first;
    the level is what the others share, by weight, of the budget left by them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("__i") - 1) % len(weights) + 1)
    s = (
        sources.withColumn("__i", F.row_number().over(by_name))
        .withColumn("__w", w.cast("long"))
        .withColumn("__cap", F.lit(max_repeat) * F.col("source_size"))
        .withColumn("__all", F.sum("source_size").over(everything))
    )
    order = [F.col("__cap") / F.col("__w"), F.col("__i")]
    fill = Window.orderBy(*order)
    s = (
        s.withColumn("__before", F.coalesce(F.sum("__cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("__rest", F.sum("__w").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("__level", (F.lit(float(budget)) * F.col("__all") - F.col("__before")) / F.col("__rest"))
        .withColumn("__rank", F.row_number().over(fill))
        .withColumn("__open", F.col("__cap") > F.col("__w") * F.col("__level"))
        .withColumn("__first", F.min(F.when(F.col("__open"), F.struct("__rank", "__level"))).over(everything))
    )
    target = F.when(F.col("__first").isNull() | (F.col("__rank") < F.col("__first.__rank")), F.col("__cap").cast("double")) \
        .otherwise(F.col("__w") * F.col("__first.__level"))
    return s.select("source", "source_size", target.alias("target"))


def mix_documents(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: float = 1.5, max_repeat: int = 2,
                  seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  carry: Sequence[str] | None = None) -> DataFrame:
    """Each document with ``size``, ``source_size``, ``target``, ``taken`` (words the mix
    takes, repeats counted) and the columns of ``carry`` (all by default). ``taken / size``
    is the number of times it goes in."""
    sized = docs.withColumn("__size", word_count(F.col(text_col).cast("string"))) \
        .withColumn("__tie", hash60(F.col(id_col), seed=seed)) \
        .withColumn("__source", F.col(source_col).cast("string")) \
        .withColumn("__bucket", F.shiftright("__tie", BUCKET_SHIFT).cast("int")) \
        .withColumn("__id", F.col(id_col)).withColumn("__row", F.monotonically_increasing_id())
    carry = docs.columns if carry is None else list(carry)
    helpers = ["__row", "__id", "__size", "__tie", "__source", "__bucket"]
    rows = stage(sized.select(*[F.col(f"`{c}`") for c in carry], *helpers), "mix-rows")
    mixed = _mixed(rows.select(*helpers), weights, budget, max_repeat)
    return attach(rows.select(*[F.col(f"`{c}`") for c in carry], "__row").join(mixed, "__row"),
                  {c: F.col(f"__{c}") for c in ("size", "source_size", "target", "taken")})


def _mixed(sized: DataFrame, weights, budget: float, max_repeat: int) -> DataFrame:
    """(__row, __size, __source_size, __target, __taken) of narrow rows."""
    buckets = sized.groupBy(F.col("__source").alias("source"), F.col("__bucket").alias("b")) \
        .agg(F.sum("__size").alias("n"))
    buckets = stage(buckets, "mix-buckets")
    targets = source_targets(buckets.groupBy("source").agg(F.sum("n").alias("source_size")), weights, budget, max_repeat)
    before = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("__offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    offsets = offsets.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))) \
        .select(F.col("o.source").alias("__s"), F.col("b").alias("__b"), "__offset",
                F.col("t.source_size").alias("__source_size"), F.col("target").alias("__target"))
    ordered = Window.partitionBy("__s", "__b").orderBy("__tie", "__id", "__size") \
        .rowsBetween(Window.unboundedPreceding, 0)
    queued = sized.join(offsets, sized["__source"].eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b"))) \
        .withColumn("__cum", F.col("__offset") + F.sum("__size").over(ordered))
    queued = stage(queued, "mix-queue")

    def finish(copy):
        return (F.col("__cum") + copy * F.col("__source_size")) / F.col("__target")

    def place(copy):
        return F.struct(finish(copy).alias("f"), F.col("__tie").alias("t"), F.col("__id").alias("i"), copy.alias("c"))

    copies = queued.filter("__size > 0").select(
        "__size", F.explode(F.array(*[place(F.lit(c)) for c in range(max_repeat)])).alias("p"))
    ranges = stage(copies.select("__size", "p.*").repartitionByRange("f", "t", "i", "c")
                   .withColumn("part", F.spark_partition_id()), "mix-order")
    sums = ranges.groupBy("part").agg(F.sum("__size").alias("n"))  # a row per range partition
    up_to = Window.orderBy("part")
    total = queued.agg(F.coalesce(F.sum("__size"), F.lit(0))).first()[0]
    cut = sums.withColumn("end", F.sum("n").over(up_to)).filter(F.col("end") > F.lit(budget * total)) \
        .orderBy("part").first()
    if cut is None:  # the budget takes every copy
        taken = F.col("__size") * max_repeat
    else:
        inside = ranges.filter(F.col("part") == cut["part"]).withColumn(
            "end", F.lit(cut["end"] - cut["n"]) + F.sum("__size").over(
                Window.orderBy("f", "t", "i", "c").rowsBetween(Window.unboundedPreceding, 0)))
        # The first copy beyond the budget; it and all later ones stay out.
        over = inside.filter(F.col("end") > budget * total).orderBy("f", "t", "i", "c").first()
        limit = F.struct(*[F.lit(over[k]).cast(ranges.schema[k].dataType).alias(k) for k in ("f", "t", "i", "c")])
        taken = sum((F.when((F.col("__size") > 0) & (place(F.lit(c)) < limit), F.col("__size")).otherwise(F.lit(0))
                     for c in range(max_repeat)), F.lit(0))
    for staged in (buckets, ranges):
        drop_staged(staged)
    return queued.select("__row", "__size", "__source_size", "__target", taken.cast("long").alias("__taken"))


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+'))::BIGINT AS size,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS tie
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
num AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS i FROM src),
wts AS (SELECT *, CASE (i - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w, 2 * source_size AS cap FROM num),
lvl AS (
  SELECT *, row_number() OVER o AS rnk,
         (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
          - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lev
  FROM wts WINDOW o AS (ORDER BY cap::DOUBLE / w::DOUBLE, i)),
fst AS (SELECT min(rnk) AS r, arg_min(lev, rnk) AS lev FROM lvl WHERE cap::DOUBLE > w::DOUBLE * lev),
tgt AS (
  SELECT lvl.source, lvl.source_size,
         CASE WHEN fst.r IS NULL OR lvl.rnk < fst.r THEN lvl.cap::DOUBLE ELSE lvl.w::DOUBLE * fst.lev END AS target
  FROM lvl, fst),
q AS (
  SELECT d.*, tgt.source_size, tgt.target,
         (sum(size) OVER (PARTITION BY d.source ORDER BY tie, doc_id NULLS FIRST, size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS cum
  FROM d JOIN tgt ON d.source IS NOT DISTINCT FROM tgt.source),
c AS (
  SELECT q.*, k.c, (cum + k.c * source_size)::DOUBLE / target AS f
  FROM q, (VALUES (0), (1)) k(c) WHERE size > 0),
o AS (
  SELECT *, sum(size) OVER (ORDER BY f, tie, doc_id NULLS FIRST, c ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done
  FROM c),
t AS (
  SELECT doc_id, tie, size, cum, sum(size)::BIGINT AS taken FROM o
  WHERE done <= 1.5 * (SELECT sum(size) FROM d) GROUP BY doc_id, tie, size, cum, source)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(t.taken, 0) AS taken
FROM q LEFT JOIN t ON q.doc_id IS NOT DISTINCT FROM t.doc_id AND q.tie = t.tie AND q.size = t.size AND q.cum = t.cum
"""
