"""SimHash near-duplicates by segment popcounts.

A 64-bit fingerprint is read as 32 segments of two bits, and embedded as the bit
count of each segment. The Manhattan distance of two embeddings never exceeds the
number of differing bits, so fingerprints that link (at most ``max_bits`` = 2
differing bits) are within Manhattan distance 2. The counts 0, 1, 2 are written
in unary (00, 01, 11), so that the distance is the bit count of an XOR.

The range join on a grid of side 1: the segments form ``groups`` equal groups;
within distance 2 at most two groups differ, so two embeddings share the grid
cell spanned by all but two of them. Each fingerprint is listed under its
``groups * (groups - 1) / 2`` cells, candidates meet in a cell, are pruned by the
Manhattan bound and verified by the differing bits. The number of groups follows
from the number of fingerprints, so that a cell rarely holds unrelated ones.

A crowded cell (more than ``CROWDED`` different fingerprints, from one large
group of near copies) is not paired: its fingerprints are linked through the 65
points within one bit of each. Two fingerprints differ in at most two bits
exactly when they share such a point, and a point has at most 65 of them, so the
work is linear and no link between components is lost.

Equal fingerprints are one node. Defined cases: null and empty texts (no words)
have fingerprint 0 and link like any other; fewer than three words are one
shingle; equal rows and equal ids share a component; the component id is the
smallest non-null id.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import attach, stage
from riskweave.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
CROWDED = 64
SEGMENTS = 32
LOW_BITS = 0x5555555555555555
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BLOCK = 1 << 18


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text, unsigned."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends.tolist()[min(shingle_words, len(found)) - 1 :]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(ends), BLOCK):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[k:], ends[k : k + BLOCK])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(ends), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint(t, shingle_words)) for t in texts], dtype="int64")

    return of(text)


def embedding(fp: Column) -> Column:
    """Unary popcounts of the two-bit segments."""
    a, b = fp, F.shiftrightunsigned(fp, 1)
    return F.shiftleft(a.bitwiseAND(b).bitwiseAND(F.lit(LOW_BITS)), 1).bitwiseOR(a.bitwiseOR(b).bitwiseAND(F.lit(LOW_BITS)))


def group_count(fingerprints: int) -> int:
    """Fewest groups for which a random fingerprint meets about 8 others at most in its cells."""
    for g in range(4, 12):
        shared = SEGMENTS * (g - 2) // g
        if g * (g - 1) / 2 * fingerprints * 0.375**shared <= 8:
            return g
    return 12


def _cells(groups: int) -> list[int]:
    """Bit masks that leave out two of the groups."""
    bounds = [2 * (SEGMENTS * i // groups) for i in range(groups + 1)]
    span = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(bounds, bounds[1:])]
    return [((1 << 64) - 1) ^ span[i] ^ span[j] for i, j in combinations(range(groups), 2)]


def near_links(fingerprints: DataFrame, max_bits: int = MAX_BITS, groups: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that keep the components of
    "differs in at most ``max_bits`` bits"; ``max_bits`` is 1 or 2."""
    if not 1 <= max_bits <= 2:
        raise ValueError("the grid serves 1 or 2 differing bits")
    groups = groups or group_count(fingerprints.count())
    masks = _cells(groups)
    listed = fingerprints.withColumn("t", embedding(F.col("fp"))).select(
        "fp", "t", F.explode(F.array(*[
            F.struct(F.lit(i).alias("axis"), F.col("t").bitwiseAND(F.lit(_signed(m))).alias("cell"))
            for i, m in enumerate(masks)])).alias("c")).select("fp", "t", "c.*")
    shared = listed.groupBy("axis", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stage(listed.join(shared, ["axis", "cell"]), "simhash-cells")
    few = shared.filter(F.col("n") <= CROWDED)
    other = few.select("axis", "cell", F.col("fp").alias("fp2"), F.col("t").alias("t2"))
    paired = few.join(other, ["axis", "cell"]).filter("fp < fp2") \
        .filter(F.bit_count(F.col("t").bitwiseXOR(F.col("t2"))) <= max_bits) \
        .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= max_bits) \
        .select(F.col("fp").alias("a"), F.col("fp2").alias("b"))
    crowd = shared.filter(F.col("n") > CROWDED).select("fp").distinct()
    near = F.array(F.lit(0), *[F.lit(_signed(1 << i)) for i in range(64)])
    if max_bits == 2:
        points = crowd.select("fp", F.explode(F.transform(near, lambda x: F.col("fp").bitwiseXOR(x))).alias("z")) \
            .groupBy("z").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1")  # 65 at most
        star = points.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    else:  # a neighbour within one bit is itself one of the points
        points = crowd.select(F.col("fp").alias("a"), F.explode(F.transform(near, lambda x: F.col("fp").bitwiseXOR(x))).alias("b"))
        star = points.join(crowd.select(F.col("fp").alias("b")), "b", "left_semi").select("a", "b")
    return paired.unionAll(star.filter("a <> b"))


def group_documents(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns of ``carry`` (all by default) with ``fingerprint`` (16 hex digits),
    ``component_id`` and ``first`` (true for exactly one row of each component: one with
    the component's id)."""
    carry = docs.columns if carry is None else carry
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(id_col).alias("__key"), F.monotonically_increasing_id().alias("__row"),
                       fingerprint_column(F.col(text_col).cast("string"), shingle_words).alias("__fp"))
    rows = stage(rows, "simhash-rows")
    # One row per fingerprint; the id is null only if all its ids are.
    lead = F.min(F.struct(F.col("__key").isNull().alias("none"), F.col("__key").alias("id"), F.col("__row").alias("row")))
    distinct = stage(rows.groupBy(F.col("__fp").alias("fp")).agg(lead.alias("lead")), "simhash-distinct")
    found = connected_components(near_links(distinct.select("fp"), max_bits))
    member = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("component", F.coalesce("component", "fp"))
    best = member.groupBy("component").agg(F.min("lead").alias("best"))
    of = stage(member.join(best, "component").select(F.col("fp").alias("__f"), F.col("best.id").alias("__id"),
                                                     F.col("best.row").alias("__best")), "simhash-groups")
    joined = rows.join(of, F.col("__fp") == F.col("__f"))
    return attach(joined, {"fingerprint": F.lower(F.lpad(F.hex("__fp"), 16, "0")), "component_id": F.col("__id"),
                           "first": F.col("__row") == F.col("__best")})
