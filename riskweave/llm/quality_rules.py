"""Quality rules: structure limits and a hashed n-gram log-likelihood ratio.

Texts are read as runs of letters and digits and runs of other signs; such tokens
and their pairs fall into ``2**bits`` hash buckets. The
raw-corpus multinomial counts the buckets over all documents, the target
multinomial over the documents of a trusted set. A bucket's weight is the log of
(target count + alpha) / (expected target count + alpha), where the expected
count is what the raw corpus frequency gives at the target's size; so rare
buckets weigh little. A document's score is its mean weight per n-gram, and it is
kept when no base rule fails and the score is at or above a fixed threshold.

All work is row-local in the JVM but for one aggregation by bucket, which is
pre-aggregated in each map task. The weights are ``2**bits`` doubles.
The trusted set is bounded: at most about ``trusted_rows`` labelled ids, taken by
id hash, so its broadcast does not grow with the corpus; the raw counts and the
scores cover every document.

Defined cases: null text has no words and fails the base rule; a null id is not
in the trusted set; without trusted documents every weight is 0, so the base
rules decide alone; equal rows are judged separately and alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import attach, drop_staged, let, stage, text_or_empty, words

BITS = 16
ALPHA = 8.0
TRUSTED_ROWS = 40_000
THRESHOLD = -0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr")
SYMBOLS = "[^#*$%&|<>]+"


def trusted_sample(labels: DataFrame, rows: int = TRUSTED_ROWS, id_col: str = "doc_id") -> DataFrame:
    """About ``rows`` ids at most of documents marked good and not toxic, by id hash."""
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0").select(id_col).filter(F.col(id_col).isNotNull())
    share = min(1.0, rows / max(1, good.count()))
    u = F.pmod(F.xxhash64(F.lit("trusted"), id_col), F.lit(1 << 20)) / float(1 << 20)
    return good.filter(u < share).distinct()


def _positions(count: Column) -> Column:
    """0 .. count-1 (empty for count < 1)."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _grams(text: Column, bits: int) -> Column:
    """Bucket numbers of the tokens and of the token pairs."""
    size = F.lit(1 << bits)
    return let(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda ts: F.concat(
        F.transform(ts, lambda t: F.pmod(F.xxhash64(t), size).cast("int")),
        F.transform(_positions(F.size(ts) - 1), lambda i: F.pmod(F.xxhash64(ts[i], ts[i + 1]), size).cast("int")),
    ))


def _shift(way: str, value: Column, bits: Column) -> Column:
    return F.call_function("shift" + way, value, bits)


def _repeated_words(ws: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more.

    A key holds the upper hash bits of a window and, below, its position. Sorting
    the keys brings equal windows together; neighbours with equal hash bits are
    compared word by word.
    """
    n = F.size(ws) - 2

    def covered(bits):
        def key(i):
            return _shift("left", _shift("right", F.xxhash64(ws[i], ws[i + 1], ws[i + 2]), bits), bits) \
                .bitwiseOR(i.cast("long"))

        def marked(keys):
            def at(k):
                return (k - _shift("left", _shift("right", k, bits), bits)).cast("int")

            def same(a, b):
                p, q = at(a), at(b)
                return (_shift("rightunsigned", a.bitwiseXOR(b), bits) == 0) \
                    & (ws[p] == ws[q]) & (ws[p + 1] == ws[q + 1]) & (ws[p + 2] == ws[q + 2])

            def window(k):
                return F.array(at(k), at(k) + 1, at(k) + 2)

            again = F.filter(F.sequence(F.lit(1), n - 1), lambda j: same(F.get(keys, j), F.get(keys, j - 1)))
            return F.size(F.array_distinct(F.flatten(F.transform(
                again, lambda j: F.concat(window(F.get(keys, j - 1)), window(F.get(keys, j)))))))

        return let(F.sort_array(F.transform(_positions(n), key)), marked)

    return F.when(n < 2, F.lit(0)).otherwise(let(F.ceil(F.log2(n + F.lit(1))).cast("int"), covered)).cast("long")


def _base(text: Column, ws: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^ \t-\r]")))
    return {
        "n_words": F.size(ws).cast("long"),
        "word_chars": F.length(F.array_join(ws, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeated_words(ws),
    }


def _judged(text: Column, weights: Column, bits: int, threshold: float) -> Column:
    """All figures and verdicts of a text as one expression. The words are bound once inside it, so a
    filter on a verdict that the optimizer moves to the scan still takes them once per row."""
    mean = let(_grams(text, bits), lambda g: F.aggregate(g, F.lit(0.0), lambda s, b: s + F.get(weights, b))
               / F.greatest(F.size(g), F.lit(1)))

    def verdict(f):
        failed = (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])
        figures = [f[c].alias(c) for c in FIGURES]
        return F.struct(*figures, failed.alias("base_failed"), (~failed & (f["llr"] >= threshold)).alias("kept"))

    return let(text, lambda t: let(words(t), lambda ws: let(
        F.struct(*[c.alias(n) for n, c in {**_base(t, ws), "llr": mean}.items()]), verdict)))


def bucket_weights(docs: DataFrame, trusted: DataFrame, bits: int = BITS, alpha: float = ALPHA,
                   id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """The ``2**bits`` log ratios by bucket (a table whose size does not depend on the corpus)."""
    marked = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")) \
        .filter("__text IS NOT NULL") \
        .join(F.broadcast(trusted.select(F.col(id_col).alias("__id"), F.lit(1).alias("__good"))), "__id", "left")
    counts = marked.select("__good", F.explode(_grams(F.col("__text"), bits)).alias("b")) \
        .groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.count("__good").alias("good"))
    counts = stage(counts, "quality-counts")  # at most 2**bits rows
    total, target = counts.agg(F.sum("raw"), F.sum("good")).first()
    out = [0.0] * (1 << bits)
    if target:
        for b, raw, good in counts.collect():
            out[b] = math.log((good + alpha) / (raw * (target / total) + alpha))
    drop_staged(counts)
    return out


def judge_documents(docs: DataFrame, trusted: DataFrame, bits: int = BITS, alpha: float = ALPHA,
                    threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row with the base figures, ``base_failed``, ``llr`` (score) and ``kept``."""
    values = bucket_weights(docs, trusted, bits, alpha, id_col, text_col)
    weights = F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")  # folds to one literal
    judged = docs.withColumn("__v", _judged(text_or_empty(text_col), weights, bits, threshold))
    return attach(judged, {c: F.col("__v")[c] for c in (*FIGURES, "base_failed", "kept")})
