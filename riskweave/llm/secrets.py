"""Secret scans with multipart credential linking.

Strong spans are the matches of three base patterns (assign, access, hex); they
are always reported. Weak candidates are parts of a credential that mean little
alone: identifiers (``weak_id``), key-like strings (``weak_key``) and endpoints.
Parts play a role: access identifier, secret, endpoint. An interval join within
each document and scope (``scope`` code points) links them, and a weak candidate
is reported only when the complementary parts co-occur: an identifier with a
secret, a key with an identifier or an endpoint, an endpoint with both.

Matching is a row-local JVM expression. The join works on parts alone: anchors
are pre-aggregated per row, role and block of ``scope`` code points to their
first and last start, and each weak part probes its own and the two neighbouring
blocks, at most three rows a role, so no pairs are listed.

Defined cases: null text is empty; equal rows are scanned alike; spans count code
points, end exclusive; weak parts that overlap a strong span are dropped.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm import spans as S
from riskweave.llm.common import attach, stage

KINDS = ("assign", "access", "hex")
WEAK = ("weak_id", "weak_key", "endpoint")
SCOPE = 400

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
WEAK_ID = r"(?i)(?<![a-z0-9_])(?:client_?id|access_?key_?id|account_?id|user_?name|login)[\"']? {0,8}[:=] {0,8}[\"']?[A-Za-z0-9_.@-]{4,}+"
WEAK_KEY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_=-])"
WEAK_KEY_HAS = ("[0-9]", "[A-Z]", "[a-z]")
ENDPOINT = r"(?<![A-Za-z])(?:https?|ftp|jdbc:[a-z]{2,16}|postgres|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._~:/?#@!$&'()*+,;=%-]{4,}+"


def strong_matches(text: Column) -> dict[str, Column]:
    assign = F.when(F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")), S.find(text, ASSIGN)).otherwise(S.none())
    return {
        "assign": F.filter(assign, lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 6),
        "access": F.filter(F.when(F.contains(text, F.lit("AKIA")), S.find(text, ACCESS)).otherwise(S.none()),
                           lambda s: s["end"] - s["start"] >= 20),
        # Runs are maximal, so those of 24 characters and more are found by their length.
        "hex": F.when(F.rlike(text, F.lit("[0-9a-f]{24}")), S.find(text, HEX[:-1] + "{24,}+")).otherwise(S.none()),
    }


def weak_matches(text: Column) -> dict[str, Column]:
    return {
        "weak_id": F.when(F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")), S.find(text, WEAK_ID)).otherwise(S.none()),
        "weak_key": F.filter(F.when(F.rlike(text, F.lit(r"[A-Za-z0-9+/_-]{20}")), S.find(text, WEAK_KEY)).otherwise(S.none()),
                             lambda s: reduce(and_, [F.rlike(s["value"], F.lit(p)) for p in WEAK_KEY_HAS])),
        "endpoint": F.when(F.contains(text, F.lit("://")), S.find(text, ENDPOINT)).otherwise(S.none()),
    }


def _parts(spans: Column, kind: str, role: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"),
                                                 F.lit(role).alias("role")))


ROLES = {"assign": "secret", "hex": "secret", "access": "id", "weak_id": "id", "weak_key": "secret", "endpoint": "endpoint"}


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Of parts (row, start, end, kind, role), the weak ones whose complementary parts lie within the scope."""
    block = F.floor(F.col("start") / scope)
    anchors = parts.groupBy("row", "role", block.alias("block")).agg(F.min("start").alias("first"), F.max("start").alias("last")) \
        .withColumnRenamed("role", "with")
    weak = parts.filter(F.col("kind").isin(*WEAK)).withColumn(
        "block", F.explode(F.array(block - 1, block, block + 1)))
    near = weak.join(anchors, ["row", "block"]).filter(F.col("with") != F.col("role")).filter(
        F.when(F.col("block") < block, F.col("start") - F.col("last") <= scope)
        .when(F.col("block") > block, F.col("first") - F.col("start") <= scope).otherwise(True))
    seen = near.groupBy("row", "start", "end", "kind").agg(F.collect_set("with").alias("with"))  # three roles at most
    both = F.array_contains("with", "id") & F.array_contains("with", "secret")
    return seen.filter(F.when(F.col("kind") == "weak_id", F.array_contains("with", "secret"))
                       .when(F.col("kind") == "endpoint", both)
                       .otherwise(F.array_contains("with", "id") | F.array_contains("with", "endpoint"))).drop("with")


def _listing(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed."""
    order = F.create_map(*[x for i, k in enumerate((*KINDS, *WEAK)) for x in (F.lit(k), F.lit(i))])
    ranked = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), F.element_at(order, s["kind"]).alias("b"),
                                                                s["end"].alias("c"), s["kind"].alias("d"))))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["d"], s["a"].cast("string"), s["c"].cast("string"))), ",")


def scan_documents(docs: DataFrame, scope: int = SCOPE, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns of ``carry`` (all by default) with ``n_<kind>``, ``base_sha256`` and ``spans``."""
    carry = docs.columns if carry is None else carry
    text = F.col("__text")
    found = docs.withColumn("__text", F.coalesce(F.col(text_col).cast("string"), F.lit(""))).select(
        *[F.col(f"`{c}`") for c in carry], F.monotonically_increasing_id().alias("__row"),
        *[c.alias(f"__{k}") for k, c in strong_matches(text).items()],
        *[c.alias(f"__{k}") for k, c in weak_matches(text).items()])
    strong = F.concat(*[F.col(f"__{k}") for k in KINDS])
    found = found.select(
        *[F.col(f"`{c}`") for c in carry], "__row",
        F.concat(*[_parts(F.col(f"__{k}"), k, ROLES[k]) for k in KINDS]).alias("__strong"),
        F.concat(*[_parts(S.outside(F.col(f"__{k}"), strong), k, ROLES[k]) for k in WEAK]).alias("__weak"))
    rows = stage(found, "secret-parts")
    parts = rows.filter(F.size("__weak") > 0).select(F.col("__row").alias("row"), F.explode(F.concat("__strong", "__weak")).alias("p")) \
        .select("row", "p.*")
    extra = linked(parts, scope).groupBy(F.col("row").alias("__of")).agg(F.collect_list(F.struct(
        "start", "end", "kind", F.lit("").alias("role"))).alias("__extra"))
    every = rows.join(extra, F.col("__row") == F.col("__of"), "left")
    own = F.col("__strong")

    def count(kind):
        return F.size(F.filter(own, lambda s: s["kind"] == kind)).cast("long")

    return attach(every, {**{f"n_{k}": count(k) for k in KINDS}, "base_sha256": F.sha2(_listing(own), 256),
                          "spans": _listing(F.when(F.col("__extra").isNull(), own).otherwise(F.concat(own, "__extra")))})
