"""Source divergence audit: how the term shares of the sources of a language differ.

Terms are runs of letters (ASCII letters, folded, and everything beyond ASCII). A
language keeps the terms that enough of its documents hold; the smoothed share of
a kept term in a group (a language's source) or in its language is an integer
p = 1 + floor(10^9 (count + 5) / (N + 5 V)).

The share depends on a term through its counts alone, so terms are not scored one
by one. The terms of a group fall into cells by (group count, language count); the
difference is evaluated once a cell, cells of equal value merge, and the cumulative
number of their terms tells which values reach the first ranks. Only the terms of
those cells are looked up and put in UTF-8 order. Distances between two sources sum
over cells in the same way: cells of (count, count) for the terms both hold, and
the histogram of each source's counts for the terms that only one holds; a term in
neither adds the difference of the two shares of a zero count.

Counts come from one pass over the texts (vectorised in Arrow batches, summed in a
bounded table before the shuffle); the rest are aggregates and equi-joins. A hot
source is one partial row per task and count; no group's terms meet in one task.

Defined cases: null text, language and source read as the empty string; a group
without terms, or a language that keeps none, still has its ``pair`` rows (value 0
without kept terms) and no ``term`` rows; repeated rows are separate documents; no
rows give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import drop_staged, stage

MIN_DOCS = 30
TOP = 50
SMOOTHING = 5
SCALE = 1_000_000_000
HELD = 400_000
PIECE = 1 << 22
#: Letters in lower case, everything else of ASCII a blank.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded stretch of it at a time."""
    folded, at = text.translate(LETTERS), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) for a table (lang, source, text): occurrences and documents with the term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush():
            for (lang, source), (n, d) in held.items():
                terms = list(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                     pa.array([n[t] for t in terms], pa.int64()), pa.array([d[t] for t in terms], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
            held.clear()

        size = 0
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for k, group in enumerate(groups):
                n, d = held.setdefault(group, (Counter(), Counter()))
                size -= len(n)
                own: set[bytes] = set()
                for found in pieces(texts[k].as_py()):
                    n.update(found)
                    own.update(found)
                d.update(own)
                size += len(n)
                if size > HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    return docs.mapInArrow(count, "lang string, source string, term string, n long, docs long") \
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(scale (count + 5) / (total + 5 kept)), in 38 digits."""
    wide = [(x).cast("decimal(19,0)") for x in (count + SMOOTHING, total + SMOOTHING * kept)]
    return F.lit(1) + F.call_function("div", wide[0] * F.lit(SCALE).cast("decimal(10,0)"), F.nullif(wide[1], F.lit(0).cast("decimal(19,0)")))


def term_ranks(cells: DataFrame, terms: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank): the first ``top`` terms of each group.

    ``cells``: (lang, source, n, total, m, value); ``terms``: (lang, source, term, n, total).
    """
    group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    merged = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    # Each value has a term at least, so the first ``top`` values hold the first ``top`` terms.
    first = merged.withColumn("k", F.row_number().over(group)).filter(F.col("k") <= top) \
        .withColumn("before", F.sum("m").over(group.rowsBetween(Window.unboundedPreceding, -1)))
    first = first.filter(F.coalesce("before", F.lit(0)) < top).select("lang", "source", "value")
    chosen = cells.join(first, ["lang", "source", "value"]).select("lang", "source", "n", "total", "value")
    found = terms.join(chosen, ["lang", "source", "n", "total"])
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("term")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "source", F.col("term").alias("item"), "value", "rank")


def pair_distances(groups: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): the distance of each two sources of a language.

    ``groups``: (lang, source, size, kept, zero), ``zero`` the share of a zero count.
    """
    own = groups.select("lang", "source", "size", "kept", "zero")
    other = own.select("lang", *[F.col(c).alias(f"{c}_2") for c in ("source", "size", "zero")])
    pairs = own.join(other, "lang").filter("source <> source_2")
    p, p_2 = share(F.col("n"), F.col("size"), F.col("kept")), share(F.col("n_2"), F.col("size_2"), F.col("kept"))
    none = F.abs(F.col("zero") - F.col("zero_2"))
    # Terms of one source against a zero count of the other, as if no term were in both.
    counts = terms.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("m"))
    alone = counts.join(pairs, ["lang", "source"]).select(
        "lang", F.least("source", "source_2").alias("a"), F.greatest("source", "source_2").alias("b"),
        (F.col("m") * (F.abs(p - F.col("zero_2")) - none)).alias("value"))
    # Terms of both: the true difference in place of the two above.
    left = terms.select("lang", "term", "source", "n")
    right = terms.select("lang", "term", F.col("source").alias("source_2"), F.col("n").alias("n_2"))
    cells = left.join(right, ["lang", "term"]).filter("source < source_2") \
        .groupBy("lang", "source", "source_2", "n", "n_2").agg(F.count(F.lit(1)).alias("m"))
    both = cells.join(pairs, ["lang", "source", "source_2"]).select(
        "lang", F.col("source").alias("a"), F.col("source_2").alias("b"),
        (F.col("m") * (F.abs(p - p_2) - F.abs(p - F.col("zero_2")) - F.abs(F.col("zero") - p_2) + none)).alias("value"))
    every = pairs.filter("source < source_2").select("lang", F.col("source").alias("a"), F.col("source_2").alias("b"),
                                                     F.coalesce(F.col("kept") * none, F.lit(0)).alias("value"))
    summed = every.unionAll(alone).unionAll(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    either = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                               F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    out = summed.select("lang", "value", either.alias("e")).select("lang", "e.source", "e.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return out.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): per group the other sources of its language by
    distance (part ``pair``), and its ``top`` terms of larger share than in its language (part ``term``)."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    docs = docs.select(*text)
    counts = stage(count_terms(docs), "audit-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    terms = stage(counts.join(kept.drop("docs"), ["lang", "term"]).select("lang", "source", "term", "n", "total"), "audit-terms")
    drop_staged(counts)
    sizes = terms.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    vocabulary = terms.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    groups = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").fillna(0, ["size"])
    langs = groups.groupBy("lang").agg(F.sum("size").alias("lang_size")).join(vocabulary, "lang", "left").fillna(0, ["kept"])
    groups = stage(groups.join(langs, "lang").withColumn("zero", share(F.lit(0), F.col("size"), F.col("kept"))), "audit-groups")
    cells = terms.groupBy("lang", "source", "n", "total").agg(F.count(F.lit(1)).alias("m")).join(groups, ["lang", "source"])
    own, whole = share(F.col("n"), F.col("size"), F.col("kept")), share(F.col("total"), F.col("lang_size"), F.col("kept"))
    cells = cells.withColumn("value", own - whole).filter("value > 0").select("lang", "source", "n", "total", "m", "value")
    parts = [("pair", pair_distances(groups, terms)), ("term", term_ranks(cells, terms, top))]
    one, two = (df.select("lang", "source", F.lit(p).alias("part"), "item", F.col("value").cast("long").alias("value"),
                          F.col("rank").cast("int").alias("rank")) for p, df in parts)
    return one.unionAll(two)


#: The same in DuckDB.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
occ AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM occ GROUP BY ALL HAVING count(DISTINCT k) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
every AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, kept.total FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
sized AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS s, count(*) OVER (PARTITION BY lang, source) AS v FROM every),
langs AS (SELECT lang, sum(total) AS t FROM kept GROUP BY lang),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)::HUGEINT) // (s + 5 * v) AS p, 1 + (1000000000 * (total + 5)::HUGEINT) // (t + 5 * v) AS q
      FROM sized JOIN langs USING (lang)),
dist AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
         GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(dist.value, 0) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN dist ON dist.lang = a.lang AND dist.source = a.source AND dist.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM (FROM pair UNION ALL FROM term))
SELECT lang, source, part, item, value::BIGINT AS value, r::INT AS rank FROM ranked WHERE part = 'pair' OR r <= 50
"""
