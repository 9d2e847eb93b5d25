"""Phrases, source divergence and vector search against plain Python."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from odd_tables import SCHEMA, empty, odd, odd_rows, prose  # noqa: F401

from riskweave.llm import cover_blocks, divergence, phrases, vector_search


def tuples(df):
    return [tuple(r) for r in df.collect()]


def passages(n):
    """Documents that share words, pairs and longer passages, in three languages and one null."""
    r = random.Random(11)
    shared = ["once upon a time there was", "New York City", "as soon as possible", "état d'urgence, déclaré", "the end\tof  the day"]
    rows = []
    for i in range(n):
        parts = [prose(1000 + i, r.randrange(1, 40))] + r.choices(shared, k=r.randrange(4))
        r.shuffle(parts)
        rows.append((i, r.choice([" ", ". ", "\n", " ; "]).join(parts), r.choice(["en", "en", "fr", "de", None]), r.choice(["a", "a", "b", "c", "é", None]), 0))
    return rows


@pytest.mark.parametrize("local_words", [0, 2_000_000])
def test_collocations_equal_plain_counts(spark, odd_rows, monkeypatch, local_words):
    """With full counts everywhere, and with local supports."""
    monkeypatch.setattr(phrases, "LOCAL_WORDS", local_words)
    rows = passages(300) + odd_rows
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(tuples(phrases.collocations(df, support=12))) == brute.collocations([(r[2], r[1]) for r in rows], 12)
    assert sorted(tuples(phrases.collocations(df, support=12, top=3))) == brute.collocations([(r[2], r[1]) for r in rows], 12, top=3)


def test_collocations_of_shards_smaller_than_a_text(spark):
    rows = [(i, "a b c d. e f\x00g\x1ch\tA  B C D! " * 20 + prose(i, 30), "x", "s", 0) for i in range(6)]
    got = tuples(phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), support=2))
    assert sorted(got) == brute.collocations([(r[2], r[1]) for r in rows], 2)
    assert any(r[2] == "f\x00g\x1ch" or "f\x00g\x1ch" in r[2] for r in got)


def test_collocations_of_nothing(spark, empty):
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None, None, 0), (2, "one two", "en", "s", 0)], SCHEMA)).count() == 0


def test_shard_words_and_keys():
    texts = ["One  two\tTHREE. four", "", "?", "five" * 1000 + " six", "one two"]
    shard = phrases.Shard("en", [t.encode() for t in texts])
    words = [shard.raw[a:b].decode() for a, b in zip(shard.starts, shard.ends)]
    assert words == ["one", "two", "three", "four", "five" * 1000, "six", "one", "two"]
    keys = shard.word_keys()
    assert keys[0] == keys[6] and keys[1] == keys[7] and len(set(keys.tolist())) == 6
    assert set(keys.tolist()).isdisjoint(phrases.Shard("fr", [b"one two"]).word_keys().tolist())
    two, three = ([ok.tolist() for k, _, ok in shard.phrases(3, []) if k == n][0] for n in (2, 3))
    assert two == [True, True, False, False, True, False, True] and three == [True, False, False, False, False, False]


def test_filter_passes_all_its_keys(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 3000)
    held = phrases.filter_of(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    assert held.has(keys.view(np.uint64)).all()
    assert held.has(np.random.default_rng(2).integers(0, 2**64 - 1, 100_000, dtype=np.uint64)).mean() < 0.01


@pytest.mark.parametrize("min_docs", [1, 4])
def test_divergence_equals_plain_counts(spark, odd_rows, min_docs):
    rows = passages(120) + odd_rows
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute.divergence([(r[2], r[3], r[1]) for r in rows], min_docs, 7)
    assert sorted(tuples(divergence.audit(df, min_docs=min_docs, top=7))) == want


def test_divergence_without_kept_terms(spark, empty):
    rows = [(1, "a b", "en", "y", 0), (2, None, "en", "x", 0), (3, "c", "en", None, 0), (4, "d", None, "z", 0)]
    got = sorted(tuples(divergence.audit(spark.createDataFrame(rows, SCHEMA))))
    assert got == brute.divergence([(r[2], r[3], r[1]) for r in rows], 30, 50) and {r[4] for r in got} == {0} and len(got) == 6
    assert divergence.audit(empty).count() == 0


def test_divergence_merges_equal_values_in_byte_order(spark):
    """Terms of one cell, and of two cells with one value, share ranks by their bytes alone."""
    rows = [(i, " ".join(["zeta", "Zeta", "éclair", "alpha", "𝒳y", "ﬁx"]), "en", "a", 0) for i in range(3)] + [(9, "zeta " * 9, "en", "b", 0)]
    got = sorted(tuples(divergence.audit(spark.createDataFrame(rows, SCHEMA), min_docs=1, top=4)))
    assert got == brute.divergence([(r[2], r[3], r[1]) for r in rows], 1, 4)


def vectors():
    rng = np.random.default_rng(4)
    rows = [(c + rng.normal(size=6) * s).tolist() for c in rng.normal(size=(6, 6)) for s in rng.choice([0, 0.001, 0.05, 0.5], 40)]
    rows += [[float("nan")] * 6, [0.0] * 6, None, [1.0, 2.0], [2.0, 4.0], [-3.0, 1.0], [], [float("inf")] + [1.0] * 5, rows[0], [None, 1.0],
             [1e12, -1.0], [1e5] * 6, [-1e5, 0.0, 0.0, 0.0, 0.0, 1.0]]
    return [(None if i % 60 == 59 else i * 7 % len(rows), v, "x") for i, v in enumerate(rows)]


@pytest.mark.parametrize("block_rows,k", [(64, 5), (20, 3), (10_000, 1)])
def test_top_vectors_equal_all_pairs(spark, block_rows, k):
    rows = vectors() + vectors()[:30]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(3)
    got = sorted(tuples(vector_search.top_vectors(df, k=k, every=7, block_rows=block_rows)), key=str)
    assert got == brute.top_vectors([r[:2] for r in rows], k, 7)


def test_top_vectors_with_few_or_no_candidates(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_search.top_vectors(empty).count() == 0
    rows = [(50, [1.0, 0.5]), (50, [1.0, 0.5]), (3, [-0.001, 0.0]), (100, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuples(vector_search.top_vectors(df)), key=str) == brute.top_vectors(rows, 5, 50)


def test_cells_and_blocks_are_bounded(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(500, 4)), rng.normal(size=4) + rng.normal(size=(500, 4)) * 1e-9])
    df = spark.createDataFrame([("4", i, 1, v.tobytes()) for i, v in enumerate(x)], "kind string, vid long, weight long, x binary")
    out = cover_blocks.blocks_of(df, 30).toPandas()
    assert sorted(out["vid"]) == list(range(1000)) and out.groupby("block").size().max() <= 60
