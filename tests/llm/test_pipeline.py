"""The corpus pipeline on a small corpus, stage by stage against plain Python."""

from __future__ import annotations

from collections import Counter

import brute
import corpus_pipeline
import pytest
from odd_tables import SCHEMA, prose
from test_models import check_packing

from riskweave.llm import quality_rules
from riskweave.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rows = [(i, prose(i, 70 + 5 * i) + (f" write to u{i}@host.org now" if i % 4 == 0 else ""), "en", f"s{i % 3}", 1) for i in range(30)]
    rows += [(100 + i, rows[i][1], "en", "s2", 1) for i in range(5)]  # exact copies
    rows += [(200 + i, " ".join(f"Xq{i}{j}***" for j in range(90)), "en", "s1", 1) for i in range(20)]
    rows += [(300, None, None, None, None), (301, "", "en", "s0", 0), (302, "too short", "en", "s0", 9), (7, rows[7][1], "en", "s0", 1)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(25)] + [(200, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def test_stages_and_run(spark, corpus):
    path, rows = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "simhash near-dedup", "personal data", "mixing sources", "best-fit packing"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)

    judged = steps["quality rules"](spark, docs, path)
    ratios = brute.likelihood_ratios([r[1] for r in rows], [r[0] in range(25) for r in rows])
    figures = [brute.figures(r[1]) for r in rows]
    kept = [r for r, f, x in zip(rows, figures, ratios) if f[0] >= 50 and 2 * f[4] <= f[0] and x >= quality_rules.THRESHOLD]
    got = judged.collect()
    assert judged.columns == docs.columns and Counter(map(tuple, got)) == Counter(kept)
    assert not any(r[0] is not None and 200 <= r[0] < 300 for r in kept) and len(kept) > 25

    single = steps["simhash near-dedup"](spark, judged, path)
    prints = [brute.fingerprint(r[1]) for r in kept]
    root = brute.components(len(kept), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    want = sorted(min(r[0] for r, x in zip(kept, root) if x == g) for g in set(root))
    assert sorted(r.doc_id for r in single.collect()) == want and single.columns == docs.columns

    clean = steps["personal data"](spark, single, path)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert clean.columns == docs.columns and sorted(texts) == want
    for r in kept:
        if r[0] in texts and r[0] % 4 == 0 and r[0] < 100:
            assert "@" not in texts[r[0]] and "write to <EMAIL> now" in texts[r[0]]
    assert all(not brute.personal(t) for t in texts.values())

    mixed = steps["mixing sources"](spark, clean, path)
    times = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs.columns and set(times.values()) <= {1, 2}
    words = {i: len(brute.WORD.findall(t)) for i, t in texts.items()}
    assert 0 <= 1.5 * sum(words.values()) - sum(words[i] * n for i, n in times.items()) <= 2 * max(words.values())

    out = [r.asDict() for r in corpus_pipeline.run(spark, path).collect()]
    assert Counter(r["doc_id"] for r in out if r["piece"] == 0) == times
    check_packing(out, [t for i, t in texts.items() for _ in range(times[i])], 2048)


def test_stages_pass_columns_of_any_name_and_rows_with_nulls(spark, corpus):
    path, rows = corpus
    from pyspark.sql import functions as F

    names = ["kept", "First", "size", "Taken", "component_id", "spans", "found", "a.b", "payload"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    docs = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, path)
        assert out.columns == docs.columns, name
        got = out.select("doc_id", *[F.col(f"`{n}`") for n in names]).collect()
        assert got
        for r in got:
            assert list(r[1:]) == [None if r[0] is None else f"{n} {r[0]}" for n in names], name
    assert dict(corpus_pipeline.STAGES)["best-fit packing"](spark, docs, path).count() > 0


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_every_operator_has_its_query():
    names = sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_the_package_works_without_the_operators(spark, monkeypatch):
    import sys

    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    with pytest.raises(ModuleNotFoundError):
        import corpus_pipeline  # noqa: F401
    assert "features_wide" in entry.queries() and "op1_mix" not in entry.queries() and "features_wide" in entry.oracle_sql()
