"""Near-dedup, language model, classifiers, packing: against plain Python or held-out rows."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from odd_tables import empty, odd, odd_rows, prose  # noqa: F401

from riskweave.llm import context_tree, cover_blocks, cover_tree, language_id, packing, quality_model, simhash
from riskweave.llm.components import connected_components


def rows(df):
    return [r.asDict() for r in df.collect()]


def fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1, x) for x in range(1000, 1400)] + [(1399, 2000), (7, 7)]
    got = {r["node"]: r["component"] for r in rows(connected_components(spark.createDataFrame(chain + hub, "a long, b long")))}
    assert all(got[i] == 100 for i in range(100, 161)) and got[2000] == 1 and got[1200] == 1 and 7 not in got


def test_simhash_groups(odd, odd_rows):
    out = rows(simhash.group_documents(odd))
    prints = {(r[0], r[1]): brute.fingerprint(r[1]) for r in odd_rows}
    fps = [prints[r["doc_id"], r["text"]] for r in out]
    assert [r["fingerprint"] for r in out] == [format(f, "016x") for f in fps]
    root = brute.components(len(out), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    smallest = {}
    for i, r in enumerate(out):
        if r["doc_id"] is not None:
            smallest[root[i]] = min(smallest.get(root[i], r["doc_id"]), r["doc_id"])
    assert [r["component_id"] for r in out] == [smallest.get(root[i]) for i in range(len(out))]
    assert sum(r["first"] for r in out) == len(set(root))
    assert all(r["component_id"] == r["doc_id"] for r in out if r["first"])


@pytest.mark.parametrize("max_bits", [1, 2])
def test_simhash_links_in_crowded_cells(spark, max_bits):
    r = random.Random(5)
    fps = set()
    for base in (r.getrandbits(63) for _ in range(3)):
        for _ in range(300):
            x = base
            for i in r.choices(range(63), k=r.randrange(5)):
                x ^= 1 << i
            fps.add(x)
    fps = sorted(fps)
    got = {x["node"]: x["component"] for x in rows(connected_components(
        simhash.near_links(spark.createDataFrame([(x,) for x in fps], "fp long"), max_bits)))}
    root = brute.components(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= max_bits)
    assert [got.get(x, x) for x in fps] == [fps[k] for k in root]


def test_popcount_embedding_bounds_the_distance(spark):
    r = random.Random(1)
    pairs = [(a, a ^ sum(1 << i for i in r.sample(range(63), 2))) for a in (r.getrandbits(63) for _ in range(200))]
    df = spark.createDataFrame(pairs, "a long, b long").select(simhash.embedding(simhash.F.col("a")).alias("a"), simhash.embedding(simhash.F.col("b")).alias("b"))
    assert all((x.a ^ x.b).bit_count() <= 2 for x in df.collect())
    assert all(simhash.group_count(n) < simhash.group_count(n * 10**6) for n in (10**3, 10**5))


def test_context_tree_equals_its_definition(spark):
    texts = ["the cat sat", "the dog sat on the cat", "a  cat\nThe end", "zebra quux", None, "", "é the", "THE cat sat"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "null id")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in rows(context_tree.score_documents(df))}
    texts = {**dict(enumerate(texts)), None: "null id"}
    train = [context_tree.tokens(t) for i, t in texts.items() if fold(i, 5) != 1]
    want = brute.context_tree(train, [context_tree.tokens(t) for t in texts.values()], context_tree.DEPTH)
    counts = Counter(w for t in train for w in [*t, b""])
    n, v = sum(counts.values()), len(counts)
    for (i, t), score in zip(texts.items(), want):
        own = [*context_tree.tokens(t), b""]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert out[i]["score"] == pytest.approx(score, abs=1e-6)
        assert out[i]["base_score"] == pytest.approx(base)
        assert (out[i]["n_tokens"], out[i]["n_known"], out[i]["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert out[i]["held_out"] == (fold(i, 5) == 1)
        size = len(b" ".join(own[:-1])) + 1
        assert out[i]["n_bytes"] == size and out[i]["bits_per_byte"] == pytest.approx(-score / math.log10(2) / size, abs=1e-6)


def test_context_tree_runs_are_bounded():
    texts = ["word " * n for n in [3] * 5000 + [300_000, 3, 400_000] + [20_000] * 30] + [None, ""]
    found = list(context_tree.runs(texts))
    assert [d for run in found for d in run] == [context_tree.tokens(t) for t in texts]
    assert all(sum(5 * len(d) for d in run[:-1]) < context_tree.BLOCK for run in found)


def test_context_tree_probabilities_sum_to_one_with_a_small_tree(spark):
    df = spark.createDataFrame([(i, prose(i, 200)) for i in range(40)], "doc_id long, text string")
    model, _ = context_tree.fit(df, depth=3, entries=150, top_words=5)
    model.ready()
    assert 0 < sum(len(i) for i, _ in model.nodes) < 2000 and len(model.words) <= 5
    for context in (b"the", b"qqq", b"\n\n\n", b"ing"):
        keys = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert (10 ** model.walk(keys)).sum() == pytest.approx(1, abs=1e-4)


def test_context_tree_rare_words_join_through_a_shuffle(spark):
    df = spark.createDataFrame([(i, prose(i, 50) + f" only{i}") for i in range(30)], "doc_id long, text string")
    few = {r["doc_id"]: r for r in rows(context_tree.score_documents(df, top_words=3))}
    all_ = {r["doc_id"]: r for r in rows(context_tree.score_documents(df))}
    for i in few:
        assert few[i]["n_known"] == all_[i]["n_known"] and few[i]["base_score"] == pytest.approx(all_[i]["base_score"])


def test_context_tree_keeps_the_smaller_side_of_a_decision_seen_often():
    key = np.array([int.from_bytes(b"aaaaab", "big"), int.from_bytes(b"aaaaac", "big")], np.uint64)
    tree = context_tree.weigh(key, np.array([3e7, 0.0]), 7, 5, 3)
    one, zero = tree[5]["one"][0], tree[5]["zero"][0]  # b ends in a 0, c in a 1
    assert zero == pytest.approx(1) and -9 < math.log10(one) < -7


@pytest.mark.parametrize("entries", [1, 100])
def test_context_tree_scores_do_not_depend_on_what_is_broadcast(spark, entries):
    texts = [prose(i, 60) + f" only{i}" for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train = [context_tree.tokens(t) for i, t in enumerate(texts) if fold(i, 5) != 1]
    want = brute.context_tree(train, [context_tree.tokens(t) for t in texts], context_tree.DEPTH)
    out = {r["doc_id"]: r["score"] for r in rows(context_tree.score_documents(df, entries=entries))}
    assert [out[i] for i in range(30)] == pytest.approx(want, abs=1e-6)


def test_context_tree_odd_rows(odd, odd_rows, empty):
    assert len(rows(context_tree.score_documents(odd))) == len(odd_rows)
    assert context_tree.score_documents(empty).count() == 0


def test_quality_model_separates_held_out_rows(spark):
    data = [(i, prose(i, 80).capitalize() + ".") if i % 3 else (i, prose(i, 80).upper().replace(" ", "!! ")) for i in range(600)]
    docs = spark.createDataFrame([*data, (9000, None), (9001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = [r for r in rows(quality_model.score_documents(docs, labels))]
    assert len(out) == 602 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    held = [r for r in out if r["held_out"] and r["doc_id"] < 9000]
    assert len(held) > 100 and sum(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held) >= 0.98 * len(held)


def test_factorisation_machine_margin_is_the_pairwise_sum():
    m = quality_model.Machine(20, rank=3, seed=1)
    m.linear, m.bias = np.random.default_rng(2).normal(size=20), 0.3
    at, x = np.array([1, 5, 7, 19]), np.array([0.5, 1.0, -2.0, 0.1])
    pairs = sum(m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert m.margins([(at, x)])[0][0] == pytest.approx(0.3 + m.linear[at] @ x + pairs)


def test_quality_model_without_labels(odd, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in rows(quality_model.score_documents(odd, none))} == {0.5}
    assert quality_model.score_documents(empty, none).count() == 0


def test_language_held_out_and_odd_rows(spark, odd, empty):
    words = {"en": ["the", "house", "with", "water"], "de": ["das", "haus", "mit", "wasser"], "fr": ["la", "maison", "avec", "eau"]}
    data = [(i, " ".join(random.Random(i).choices(words[lang], k=30)), lang) for i in range(300) for lang in [list(words)[i % 3]]]
    odd_texts = [(1000, None, "en"), (1001, "12 !!", "en"), (1002, "das wassers hausen", None), (1003, "x" * 100_000, None)]
    out = {r["doc_id"]: r for r in rows(language_id.identify_documents(spark.createDataFrame(data + odd_texts, "doc_id long, text string, lang string")))}
    assert all(out[i]["lang_pred"] == lang and out[i]["held_out"] == (fold(i, 4) == 2) for i, _, lang in data)
    assert (out[1000]["lang_pred"], out[1001]["lang_pred"], out[1002]["lang_pred"]) == ("und", "und", "de")
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert language_id.identify_documents(empty).count() == 0
    assert language_id.identify_documents(odd).count() == odd.count()


@pytest.mark.parametrize("words,grams", [(2, 5), (2, 100_000), (100_000, 100_000)])
def test_language_equals_its_definition(spark, odd_rows, words, grams):
    """Whatever is broadcast."""
    r = random.Random(3)
    parts = {"aa": ["gro", "ta", "lin", "ößé", "ke"], "bb": ["kle", "wo", "rd", "ta", "ñu"], "cc": ["𝒳a", "zu", "kle", "ĳ"]}
    data = [(i, " ".join("".join(r.choices(parts[lang], k=r.randrange(1, 4))) for _ in range(r.randrange(1, 12))), lang)
            for i in range(240) for lang in [r.choice(list(parts))]]
    data += [(300 + k, t, None) for k, t in enumerate(["½ ² Ⅷ", "٣ x२y", "q", "zzz qqq jj", "", None, "groñu-kleta ½", "𝒳𝒳", "İstanbul groTA"])]
    data += [(r_[0], r_[1], r_[2]) for r_ in odd_rows]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3)
    got = sorted(((r["doc_id"] is None, r["doc_id"], r["lang_pred"], r["score"]) for r in rows(language_id.identify_documents(df, words=words, grams=grams))), key=str)
    want = brute.language([(lang, t) for i, t, lang in data if fold(i, 4) != 2], [t for _, t, _ in data])
    want = sorted(((i is None, i, lang, s) for (i, _, _), (lang, s) in zip(data, want)), key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-3)


@pytest.mark.parametrize("name", ["score_documents", "score", "identify"])
def test_clashing_names_in_any_case(spark, odd, name):
    """Results replace a caller's columns of their names; others stay."""
    df = odd.withColumns({c: simhash.F.lit("mine") for c in ("Held_Out", "SCORE", "Predicted", "Lang_Pred", "N_Tokens", "other", "word", "key", "n", "v0")})
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, quality int")
    out = {"score_documents": lambda: context_tree.score_documents(df), "score": lambda: quality_model.score_documents(df, labels),
           "identify": lambda: language_id.identify_documents(df)}[name]()
    names = [c.lower() for c in out.columns]
    assert len(set(names)) == len(names) and {"held_out", "score", "other", "word", "key", "n", "v0"} <= set(out.columns)
    got = rows(out)
    assert len(got) == odd.count() and {r["other"] for r in got} == {r["key"] for r in got} == {"mine"}
    assert all(isinstance(r["score"], float) for r in got)


def brute_links(ids, vectors, threshold=0.9):
    unit = [cover_tree.unit(v) for v in vectors]
    near = [[a is not None and b is not None and len(a) == len(b) and float(a @ b) >= threshold for b in unit] for a in unit]
    root = brute.components(len(ids), lambda i, j: near[i][j])
    smallest = {}
    for i, r in zip(ids, root):
        smallest[r] = min(smallest.get(r, i), i)
    return [sum(x) - x[i] for i, x in enumerate(near)], [smallest[r] for r in root]


@pytest.mark.parametrize("block_rows", [40, 4000])
def test_cover_tree_links(spark, block_rows):
    rng = np.random.default_rng(3)
    vectors = [(c + rng.normal(size=8) * s).tolist() for c in rng.normal(size=(5, 8)) for s in rng.choice([0, 0.001, 0.05, 0.2, 0.4], 60)]
    vectors += [[float("nan")] * 8, [0.0] * 8, None, [1.0, 2.0], [2.0, 4.0], [], [float("inf")] + [1.0] * 7, vectors[0], [1e300] * 8,
                [1e-300] * 8, [None, 1.0]]
    df = spark.createDataFrame([(i * 7 % len(vectors), v, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, links string")
    out = rows(cover_tree.link_vectors(df, block_rows=block_rows))
    links, component = brute_links([r["vec_id"] for r in out], [r["embedding"] for r in out])
    assert [r["n_links"] for r in out] == links
    assert [r["component_id"] for r in out] == component
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out) and len(out) == len(vectors)


def test_cover_tree_empty_and_unlinked(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_tree.link_vectors(empty).count() == 0
    lone = spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in rows(cover_tree.link_vectors(lone).orderBy("vec_id"))] == [(0, 1, True), (0, 2, True)]


def test_cover_tree_levels_nest_and_cover():
    x = np.random.default_rng(0).normal(size=(200, 6))
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = cover_blocks.Tree(x, 0.01)
    assert sorted(tree.order) == list(range(200))
    for node, kids in enumerate(tree.kids):
        span = np.array(tree.order[tree.first[node] : tree.last[node]])
        assert np.linalg.norm(x[span] - x[tree.center[node]], axis=1).max() <= tree.radius[node] + 1e-9
        if kids:
            assert tree.center[kids[0]] == tree.center[node]


def test_encoder_equals_the_tokenizer():
    encode = packing.encoder(packing.default_tokenizer())
    texts = ["a  b \n c", "\nx", "x\n", " a", "", "a\n\nb c\n d", "it's 12 3½ é— <|endoftext|> x", "a  b", "a　 b", "x .", "\t", " . ",
             prose(1, 300), "naïve Straße, größer; Ελλάδα 漢字 🙂 ok", "word. word, word"]
    for t in texts:
        assert encode(t) == np.array(encode.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_encoder_splits_a_first_word_behind_a_sign():
    encode = packing.encoder(packing.default_tokenizer())
    for t in ("'stop there", "'street", "'stop, there", "'though", "'s", "'d. x", "'reach", "-street", "1st of", "\"though", "_street"):
        assert encode(t) == np.array(encode.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def check_packing(out, docs, capacity):
    encode = packing.encoder(packing.default_tokenizer())
    end = (0).to_bytes(4, "little")
    left = Counter()
    for t in docs:
        ids = encode(t or "") + end
        for p, (s, n) in enumerate(packing.cut(len(ids) // 4, capacity)):
            left[p, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])] += 1
    left.subtract((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out)
    assert not any(left.values())
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    return len(bins)


def test_packing_places_every_piece_once(odd, odd_rows, empty):
    out = rows(packing.pack_documents(odd.coalesce(1), capacity=256))
    used = check_packing(out, [r[1] for r in odd_rows], 256)
    assert used <= 1.03 * sum(r["length"] for r in out) / 256 + 1
    assert packing.pack_documents(empty).count() == 0


def test_open_bins_close_the_fullest_first():
    bins = packing.OpenBins(10, 2, 0)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(8) == (2, 0)  # bin 1 (3 free) is the fullest open one and closes
    assert bins.place(3) == (0, 6) and bins.place(2) == (2, 8)
    assert bins.place(3)[0] == 3 and bins.place(10) == (4, 0)


@pytest.mark.parametrize("bound", [1, 3, 17, 10**6])
def test_open_bins_equal_a_list_of_bins(bound):
    """Best fit by search over all open bins: the least free space that takes the piece, else the fullest closes."""
    r = random.Random(bound)
    bins, free, held, closed = packing.OpenBins(50, bound, 0), {}, {}, set()
    for _ in range(3000):
        n = r.choice([r.randint(1, 50), r.randint(1, 12), 50])
        sequence, at = bins.place(n)
        shut = set(bins.closed)
        bins.closed.clear()
        fits = [f for f in free.values() if f >= n]
        if fits:
            assert free[sequence] == min(fits)
        else:
            assert sequence not in held
            if n < 50 and len(free) >= bound:
                gone = next(s for s in shut if s in free)
                room = free.pop(gone)
                assert room <= min([*free.values(), 50])
                closed.add(gone)
        assert at == held.get(sequence, 0) and sequence not in closed
        held[sequence] = at + n
        free[sequence] = 50 - held[sequence]
        if not free[sequence]:
            del free[sequence]
            closed.add(sequence)
        assert shut <= closed and len(free) <= bound


def test_packing_many_partitions_uses_no_more_sequences(spark):
    """Part-filled last sequences of 64 partitions go through a second round: within 2 % of one partition."""
    r = random.Random(7)
    texts = [prose(i, r.choice([3, 40, 150, 400])) for i in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    used = []
    for parts in (1, 64):
        out = rows(packing.pack_documents(df.repartition(parts, "doc_id"), capacity=512))
        used.append(check_packing(out, texts, 512))
    least = math.ceil(sum(x["length"] for x in out) / 512)
    assert used[1] <= 1.02 * used[0] + 1 and used[1] <= 1.05 * least + 1


def test_cut_only_shortens_the_first_piece():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)] and packing.cut(1, 4) == [(0, 1)]


