"""Language identification: known words first, then shorter and shorter n-grams.

Words are lower-cased runs of letters (Unicode L). A known word adds its log
frequency in each language. An unseen word adds the mean over its longest known
character n-grams: those of length 4 and, where none of them is known, of length
3, 2, 1. The language with the largest sum wins; the score is its share after
normalising.

Word counts are summed over all training documents; n-gram counts follow from the
distinct words. Both tables keep every entry. The most frequent words and n-grams, a
fixed number, are broadcast. What a document has beside them joins the word table
through a shuffle, once for each distinct word; words in no training row are scored
from the n-grams. Where the broadcast does not settle an n-gram, the word goes
through rounds of joins, first on its 4-grams, then those without any on 3-grams,
and so on, with the same result.

Log frequencies are whole numbers of 2^-20, so sums do not depend on their order.

Defined cases: ``und`` with score 0 for null text, text without letters (numerals
are none), and when there is nothing to learn from; a null language is not learnt
from; ties go to the first language by code point; equal rows get equal results; a
result replaces a caller's column of its name in any case.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.common import attach, drop_staged, stage
from riskweave.llm.learning import floor_for, id_remainder

KNOWN_WORDS = 150_000
KNOWN_GRAMS = 500_000
LONGEST = 4
SMOOTHING = 0.5
UNIT = 1 << 20
HELD = 300_000
RUNS = re.compile(r"[^\W\d_]+")
U = np.uint64


def letters(text: str | None) -> list[str]:
    """The words of a text."""
    found = RUNS.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


def padded(word: str) -> str:
    return f"^{word}$"


def count_words(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, word, n) of the rows with a language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush():
            for lang, n in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(list(n), pa.string()),
                                                  pa.array(list(n.values()), pa.int64())], names=["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(lang, Counter()).update(letters(text.as_py()))
                if sum(map(len, held.values())) > HELD:
                    yield from flush()
        yield from flush()

    return docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string"), F.col(text_col).cast("string")) \
        .mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _by_language(counts: DataFrame, langs: list[str]) -> DataFrame:
    """(word, n, c0, c1, ...): the counts of each word by language."""
    own = [F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"c{k}") for k, x in enumerate(langs)]
    return counts.groupBy("word").agg(F.sum("n").alias("n"), *own)


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the padded words, one after the other, and where each begins."""
    wide = [padded(w) for w in words]
    return np.frombuffer("".join(wide).encode("utf-32-le", "surrogatepass"), np.uint32), np.cumsum([0] + [len(w) for w in wide])


def _keys(points: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all n-grams of length ``k`` their word's number and their key: code points of 16 bits each."""
    n = np.maximum(np.diff(starts) - (k - 1), 0)
    of = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + starts[:-1][of]
    key = np.zeros(len(at), U)
    for j in range(k):
        key = (key << U(16)) | points[at + j].astype(U)
    return of, key


def _grams(keys: np.ndarray, k: int) -> list[str]:
    parts = [((keys >> U(16 * (k - 1 - j))) & U(0xFFFF)).astype("<u2") for j in range(k)]
    text = np.stack(parts, 1).tobytes().decode("utf-16-le", "surrogatepass") if len(keys) else ""
    return [text[i : i + k] for i in range(0, len(text), k)]


def _short(word: str) -> bool:
    """All code points have 16 bits."""
    return word.isascii() or max(word) <= "￿"


def count_grams(words: DataFrame, langs: list[str]) -> DataFrame:
    """(gram, n, c0, ...) from the counts of distinct words, as often as an n-gram occurs in a word."""
    names = ["gram", *(f"c{k}" for k in range(len(langs)))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            counts = np.stack([c.to_numpy() for c in batch.columns[1:]], 1).astype(np.float64)
            short = np.array([_short(w) for w in found], bool)
            points, starts = _points([w for w, s in zip(found, short) if s])
            own = counts[short]
            for k in range(1, LONGEST + 1):
                of, key = _keys(points, starts, k)
                keys, at = np.unique(key, return_inverse=True)
                sums = [np.bincount(at, own[of, x], len(keys)).astype(np.int64) for x in range(own.shape[1])]
                yield pa.RecordBatch.from_arrays([pa.array(_grams(keys, k), pa.string()), *map(pa.array, sums)], names=names)
            for w, c in zip((w for w, s in zip(found, short) if not s), counts[~short].astype(np.int64).tolist()):
                parts = Counter(padded(w)[i : i + k] for k in range(1, LONGEST + 1) for i in range(len(w) + 3 - k))
                yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.string()), *(pa.array([x * m for m in parts.values()], pa.int64()) for x in c)],
                                                 names=names)

    every = words.select("word", *names[1:]).mapInArrow(cut, ", ".join(["gram string", *(f"{c} long" for c in names[1:])]))
    summed = every.groupBy("gram").agg(*[F.sum(c).alias(c) for c in names[1:]])
    return summed.select("gram", sum((F.col(c) for c in names[1:]), F.lit(0)).alias("n"), *names[1:])


def _logs(counts: DataFrame, langs: list[str]) -> DataFrame:
    """The counts as smoothed log frequencies v0, v1, ... in whole units."""
    own = [f"c{k}" for k in range(len(langs))]
    size, *totals = counts.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(c), F.lit(0)) for c in own]).first()
    logs = [F.round(F.log((F.col(c) + SMOOTHING) / (t + SMOOTHING * max(1, size))) * UNIT).cast("int").alias(f"v{k}")
            for k, (c, t) in enumerate(zip(own, totals))]
    return counts.select(counts.columns[0], "n", *logs)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = KNOWN_WORDS, grams: int = KNOWN_GRAMS) -> dict:
    """The model: languages, the tables (word, n, v0, ...) and (gram, n, v0, ...), and the most frequent entries of both."""
    counts = stage(count_words(docs, text_col, lang_col), "lang-words")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not langs:
        return {"langs": langs}
    by = stage(_by_language(counts, langs), "lang-counts")
    drop_staged(counts)
    parts = stage(count_grams(by, langs), "lang-grams")
    known, known_grams = (stage(_logs(x, langs), "lang-logs") for x in (by, parts))
    for staged in (by, parts):
        drop_staged(staged)
    top, top_grams = (_common(x, langs, n) for x, n in ((known, words), (known_grams, grams)))
    return {"langs": langs, "words": top, "grams": Grams(*top_grams, len(top_grams[0]) == known_grams.count()), "known": known, "all_grams": known_grams}


def _common(table: DataFrame, langs: list[str], rows: int) -> tuple[list[str], np.ndarray]:
    got = table.filter(F.col("n") >= floor_for(table, "n", rows)).toArrow()
    return got.column(0).to_pylist(), np.stack([got[f"v{k}"].to_numpy() for k in range(len(langs))], 1)


class Grams:
    """The commonest n-grams by length; ``whole``: there are no others."""

    def __init__(self, grams: list[str], values: np.ndarray, whole: bool):
        self.whole, self.langs, self.tables = whole, values.shape[1], {}
        size = np.array([len(g) if _short(g) else 0 for g in grams], np.int64)
        for k in range(1, LONGEST + 1):
            at = np.flatnonzero(size == k)
            points = np.frombuffer("".join(grams[i] for i in at.tolist()).encode("utf-16-le", "surrogatepass"), "<u2").reshape(-1, k)
            key = np.zeros(len(at), U)
            for j in range(k):
                key = (key << U(16)) | points[:, j].astype(U)
            order = np.argsort(key)
            self.tables[k] = key[order], values[at][order]

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The values of each word, and whether they are settled."""
        out, open_ = np.zeros((len(words), self.langs), np.int64), np.array([_short(w) for w in words], bool)
        settled = np.zeros(len(words), bool)
        points, starts = _points([w if s else "" for w, s in zip(words, open_)])
        for k in range(LONGEST, 0, -1):
            keys, values = self.tables[k]
            of, key = _keys(points, starts, k)
            own = open_[of]
            of, key = of[own], key[own]
            at = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
            hit = keys[at] == key if len(keys) else np.zeros(len(key), bool)
            if not self.whole:
                open_[of[~hit]] = False
                hit &= open_[of]
            n = np.bincount(of[hit], minlength=len(words))
            sums = np.stack([np.bincount(of[hit], values[at[hit], x], len(words)) for x in range(self.langs)], 1).astype(np.int64)
            done = n > 0
            out[done] = (2 * sums[done] + n[done, None]) // (2 * n[done, None])
            settled |= done
            open_ &= ~done
        return out, settled | open_  # nothing known of it in any length


def other_scores(words: DataFrame, model: dict) -> DataFrame:
    """(word, v0, ...): the values of distinct words, from the word table or else from their n-grams."""
    langs, values = model["langs"], [f"v{k}" for k in range(len(model["langs"]))]
    both = stage(words.join(model["known"].drop("n"), "word", "left"), "lang-others")
    shared = words.sparkSession.sparkContext.broadcast(model["grams"])

    def back_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, settled = shared.value.scores(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(settled), *(pa.array(found[:, k], pa.int32()) for k in range(len(langs)))],
                                             names=["word", "settled", *values])

    unseen = both.filter("v0 IS NULL").select("word")
    scored = stage(unseen.mapInArrow(back_off, ", ".join(["word string, settled boolean", *(f"{v} int" for v in values)])), "lang-unseen")
    out = both.filter("v0 IS NOT NULL").unionAll(scored.filter("settled").drop("settled"))
    left = scored.filter("NOT settled").select("word")
    return out.unionAll(by_rounds(left, model)) if left.limit(1).count() else out


def by_rounds(left: DataFrame, model: dict) -> DataFrame:
    """(word, v0, ...) of unseen words by joins with the n-gram table, a length a round."""
    values = [f"v{k}" for k in range(len(model["langs"]))]
    out = []
    for k in range(LONGEST, 0, -1):
        wide = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
        at = F.sequence(F.lit(1), F.length(wide) - (k - 1))
        parts = left.filter(F.length(wide) >= k).select("word", F.explode(F.transform(at, _piece(wide, k))).alias("gram"))
        mean = [F.floor((2 * F.sum(v) + F.count(F.lit(1))) / (2 * F.count(F.lit(1)))).cast("int").alias(v) for v in values]
        out.append(stage(parts.join(model["all_grams"].drop("n"), "gram").groupBy("word").agg(*mean), "lang-round"))
        left = stage(left.join(out[-1].select("word"), "word", "left_anti"), "lang-left")
    out.append(left.select("word", *[F.lit(0).alias(v) for v in values]))
    every = out[0]
    for more in out[1:]:
        every = every.unionAll(more)
    return every


def _piece(wide: Column, k: int):
    return lambda i: F.substr(wide, i, F.lit(k))


class _Seen(dict):
    """Common word -> row of ``table``; row 0, all zeros, stands for the others."""

    def __init__(self, words: list[str], values: np.ndarray):
        super().__init__(zip(words, range(1, len(words) + 1)))
        self.table = np.concatenate([np.zeros((1, values.shape[1])), values])

    def __missing__(self, word: str) -> int:
        return 0


def identify(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows, but for ``text_col``, with ``lang_pred`` and ``score``."""
    langs = model["langs"]
    own = [F.col(f"`{c}`") for c in docs.columns if c != text_col and c.lower() not in ("lang_pred", "score")]
    if not langs:
        return docs.select(*own, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = docs.select(*own, F.monotonically_increasing_id().alias("__row"), F.col(text_col).cast("string").alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model["words"])
    at = len(own) + 1
    sums = [f"__v{k}" for k in range(len(langs))]
    names = [*rows.columns[:at], "__n", *sums, "__others"]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen(*shared.value)
        for batch in batches:
            sizes, totals, others = [], [], []
            for text in batch.column(at):
                found = Counter(letters(text.as_py()))
                slot = np.fromiter(map(seen.__getitem__, found), np.int64, len(found))
                n = np.fromiter(found.values(), np.int64, len(found))
                sizes.append(int(n.sum()))
                totals.append(n @ seen.table[slot])
                words = list(found)
                others.append([(words[k], int(n[k])) for k in np.flatnonzero(slot == 0).tolist()])
            total = np.array(totals).reshape(-1, len(langs)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(sizes, pa.int64()), *(pa.array(total[:, k]) for k in range(len(langs))),
                 pa.array(others, pa.map_(pa.string(), pa.int64()))], names=names)

    schema = rows.drop("__text").schema.add("__n", "long")
    for c in sums:
        schema = schema.add(c, "long")
    summed = stage(rows.mapInArrow(add_up, schema.add("__others", T.MapType(T.StringType(), T.LongType()))), "lang-sums")
    others = summed.select(F.col("__row").alias("__of"), F.explode("__others").alias("word", "m"))
    values = other_scores(others.select("word").distinct(), model)
    more = others.join(values, "word").groupBy("__of").agg(*[F.sum(F.col("m") * F.col(f"v{k}")).alias(f"__m{k}") for k in range(len(langs))])
    total = F.array(*[F.col(c) + F.coalesce(F.col(f"__m{k}"), F.lit(0)) for k, c in enumerate(sums)])
    every = summed.drop("__others").join(more, F.col("__row") == F.col("__of"), "left").withColumn("__total", total) \
        .withColumn("__best", F.array_max("__total"))
    share = F.aggregate("__total", F.lit(0.0), lambda a, x: a + F.exp((x - F.col("__best")) / float(UNIT)))
    name = F.element_at(F.array(*map(F.lit, langs)), F.array_position("__total", F.col("__best")).cast("int"))
    return attach(every, {"lang_pred": F.when(F.col("__n") == 0, "und").otherwise(name),
                          "score": F.when(F.col("__n") == 0, 0.0).otherwise(1 / share)})


def identify_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       folds: int = 4, held: int = 2, carry: list[str] | None = None, words: int = KNOWN_WORDS,
                       grams: int = KNOWN_GRAMS) -> DataFrame:
    """Learns from the rows outside fold ``held`` and labels all rows; adds ``held_out``."""
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ("held_out", "lang_pred", "score")]
    out = id_remainder(id_col, folds) == held
    model = train(docs.filter(~out), text_col, lang_col, words, grams)
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], out.alias("held_out"), F.col(text_col).cast("string").alias("__t"))
    return identify(rows, model, "__t")
