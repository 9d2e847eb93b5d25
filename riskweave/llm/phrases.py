"""Phrase collocations, mined by partitioning (SON).

A phrase is two to four words in a row inside a piece of text, frequent in its
language if it occurs ``support`` times. Shards are runs of texts of one language
in one task, of a bounded number of bytes. Length by length, every shard is mined
completely at the local support ceil(support * share), share being the part of the
language's words that the shard holds: a phrase that is frequent in the language is
frequent in a shard at least. What is locally frequent is united, and one more pass
counts these candidates globally and exactly, by their words.

The support is an absolute number, so the local one reaches 1 as soon as a shard
holds less than a thirtieth of its language; such shards report complete counts,
whose sums tell the candidates. What keeps them few at every size is that a
phrase of k words is looked at only where both its parts of k - 1 words are
candidates. Candidates travel as 64-bit keys and return to the shards as a bitmap
of a fixed number of bits; keys that share a bit or a key merely let a phrase
through to the exact count.

Scores, containment and ranks are aggregates and equi-joins on (language, phrase);
the part of a candidate after any cut is a frequent phrase itself, so its count is
in the table. Integers stay exact: products go through 38 digits.

Defined cases: null text is empty, null language is ``und``; only A-Z are folded;
words are split at space and tab alone, so other controls are word characters;
repeated rows count again; a language without candidates has no rows, nor have
empty tables. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import drop_staged, stage

SUPPORT = 30
LONGEST = 4
TOP = 2000
CONTAINED = 80
SHARD_BYTES = 3 << 20
BUFFER_BYTES = 48 << 20
#: Languages of at most so many words are mined at a local support, others at 1.
LOCAL_WORDS = 2_000_000
#: At most so many of those are known to the shards; the rest are mined at 1.
LOCAL_LANGS = 10_000
HELD = 300_000
HASH_BYTES = 1 << 20
SLOTS = 20
U = np.uint64
#: A-Z in lower case, separators of pieces to a line end, tabs to spaces.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
RUNS = re.compile(b" {2,}")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


class Shard:
    """Texts of one language as bytes, with the start, end and piece of each word."""

    def __init__(self, lang: str, texts: list[bytes]):
        self.lang, self.raw = lang, RUNS.sub(b" ", b"\n".join(texts).translate(FOLD))
        self.bytes = np.frombuffer(self.raw, np.uint8)
        line = self.bytes == 10
        blank = np.ones(len(line) + 2, np.int8)
        blank[1:-1] = line | (self.bytes == 32)
        edge = np.diff(blank)
        self.starts, self.ends = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
        self.piece = np.cumsum(line, dtype=np.int32)[self.starts]

    def word_keys(self) -> np.ndarray:
        """A 64-bit key of each word and the language, hashed over a bounded stretch at a time."""
        seed = U(int.from_bytes(hashlib.blake2b(self.lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big"))
        size = self.ends - self.starts
        power = np.cumprod(np.full(int(size.max(initial=0)) + 1, 0x100000001B3, U))
        out, total, at = np.zeros(len(size), U), np.cumsum(size), 0
        while at < len(size):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + HASH_BYTES)))
            n = size[at:end]
            first = np.cumsum(n) - n
            within = np.arange(n.sum()) - np.repeat(first, n)
            values = (self.bytes[np.repeat(self.starts[at:end], n) + within].astype(U) + U(1)) * power[within]
            out[at:end] = np.add.reduceat(values, first)
            at = end
        return mixed(out ^ seed)

    def phrases(self, length: int, filters: list["Filter"]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per k up to ``length``: the keys at all word positions and where they are phrases that pass; ``filters`` holds
        one for each k from 1, the last may be lacking."""
        words = self.word_keys()
        key, ok = words, np.ones(len(words), bool)
        for k in range(1, length + 1):
            if k > 1:
                n = max(0, len(words) - k + 1)
                key = mixed(key[:n] * U(0x2545F4914F6CDD1D) + words[k - 1 :])
                ok = ok[:n] & ok[1 : n + 1] & (self.piece[:n] == self.piece[k - 1 :])
            if k <= len(filters):
                at = np.flatnonzero(ok)
                ok[at] = filters[k - 1].has(key[at])
            yield k, key, ok


class Filter:
    """A set of keys as a bitmap of 2^(SLOTS + 6) bits; it may pass others too."""

    def __init__(self, slots: np.ndarray, bits: np.ndarray):
        self.bits = np.zeros(1 << SLOTS, U)
        self.bits[slots] = bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        return (self.bits[(keys >> U(64 - SLOTS)).astype(np.int64)] >> ((keys >> U(58 - SLOTS)) & U(63))) & U(1) == 1


def filter_of(keys: DataFrame) -> Filter:
    """The bitmap of a table of keys (long): 2^SLOTS numbers at most reach the driver."""
    slot, bit = F.shiftrightunsigned("key", 64 - SLOTS), F.shiftrightunsigned("key", 58 - SLOTS).bitwiseAND(F.lit(63)).cast("int")
    got = keys.groupBy(slot.alias("slot")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")).toArrow()
    return Filter(got["slot"].to_numpy(), got["bits"].to_numpy().astype(np.int64).view(U))


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """The task's texts (lang, text) in runs of one language."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for k, lang in enumerate(batch.column(0).to_pylist()):
            text = texts[k].as_py()
            held.setdefault(lang, []).append(text)
            sizes[lang] += len(text) + 1
            if sizes[lang] >= SHARD_BYTES:
                del sizes[lang]
                yield Shard(lang, held.pop(lang))
        if sizes.total() > BUFFER_BYTES:
            sizes.clear()
            while held:
                yield Shard(*held.popitem())
    while held:
        yield Shard(*held.popitem())


def counted(docs: DataFrame, find) -> DataFrame:
    """(lang, phrase, n): what ``find(shard)`` gives (byte strings), counted exactly."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush():
            for lang, times in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(times), pa.string()), pa.array(list(times), pa.binary()).cast(pa.string()),
                                                  pa.array(list(times.values()), pa.int64())], names=["lang", "phrase", "n"])
            held.clear()

        for shard in shards(batches):
            own = held.setdefault(shard.lang, Counter())
            for found in find(shard):
                own.update(found)
            if sum(map(len, held.values())) > HELD:
                yield from flush()
        yield from flush()

    return docs.mapInArrow(count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def split_words(shard: Shard) -> Iterator[list[bytes]]:
    """The words of a shard, a bounded number at a time."""
    for at in range(0, len(shard.starts), HELD):
        s, e = shard.starts[at : at + HELD], shard.ends[at : at + HELD]
        yield [shard.raw[a:b] for a, b in zip(s.tolist(), e.tolist())]


def mine(docs: DataFrame, length: int, filters, sizes, support: int) -> DataFrame:
    """The keys of the candidates of ``length`` words: locally frequent in a shard, and not shown infrequent by full counts."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            *_, (_, key, ok) = shard.phrases(length, filters.value)
            keys, n = np.unique(key[ok], return_counts=True)
            if shard.lang in sizes.value:  # a local support; what reaches it is a candidate whatever the others have
                keys = keys[n >= math.ceil(support * len(shard.starts) / sizes.value[shard.lang])]
                n = np.full(len(keys), support)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])

    return docs.mapInArrow(local, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= support).select("key")


def word_filter(words: DataFrame) -> Filter:
    """The bitmap of the frequent words (lang, phrase)."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            yield pa.RecordBatch.from_arrays([pa.array(shard.word_keys().view(np.int64))], names=["key"])

    return filter_of(words.select("lang", "phrase").mapInArrow(keys, "key long"))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of the frequent phrases of one to ``longest`` words of a table (lang, text), and (lang, n) of all words."""
    share = docs.sparkSession.sparkContext.broadcast
    every = stage(counted(docs, split_words), "phrases-words")
    totals = stage(every.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    words = stage(every.filter(F.col("n") >= support), "phrases-frequent")
    drop_staged(every)
    small = totals.filter(F.col("n") <= LOCAL_WORDS).orderBy(F.col("n").desc(), "lang").limit(LOCAL_LANGS).collect()
    sizes = share({r["lang"]: r["n"] for r in small})
    filters = [word_filter(words)]
    for k in range(2, longest + 1):
        filters.append(filter_of(mine(docs, k, share(filters), sizes, support)))
    shared = share(filters)

    def candidates(shard: Shard) -> Iterator[Iterator[bytes]]:
        for k, _, ok in shard.phrases(longest, shared.value):
            if k > 1:
                at = np.flatnonzero(ok)
                for some in np.array_split(at, len(at) // HELD + 1):
                    yield map(shard.raw.__getitem__, map(slice, shard.starts[some].tolist(), shard.ends[some + (k - 1)].tolist()))

    found = counted(docs, candidates).filter(F.col("n") >= support)
    return stage(words.unionAll(found), "phrases-frequent"), totals


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", support: int = SUPPORT, longest: int = LONGEST,
                 contained: int = CONTAINED, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the ``top`` phrases by score that no longer candidate
    with ``contained`` percent of their count holds."""
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    frequent, totals = frequent_phrases(docs, support, longest)
    phrases = frequent.withColumn("w", F.split("phrase", " ")).withColumn("k", F.size("w")).filter("k > 1").withColumnRenamed("n", "a")

    def part(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))) \
        .select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("first"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    cuts = cuts.join(frequent.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"]) \
        .join(frequent.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    wide = F.col("a").cast("decimal(19,0)") * F.lit(2_000_000).cast("decimal(10,0)")
    score = F.call_function("div", wide, (F.col("l") + F.col("r")).cast("decimal(19,0)"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("b"))
    # All shorter phrases of two words at least inside a candidate, each at its place.
    inside = phrases.filter("k > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1))) \
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1))) \
        .select("lang", part(F.col("at"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = best.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < contained * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("b.score").desc(), F.col("a").desc(), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "b.l", "b.r", "n", "b.score")


#: The same in DuckDB.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
tot AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, unnest([array_to_string(w[i:i + z - 1], ' ') FOR i IN range(1, len(w) - z + 2)]) AS phrase, z FROM w, range(1, 5) s(z) WHERE len(w) >= z),
f AS (SELECT lang, phrase, z, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE z > 1),
cut AS (SELECT lang, phrase, a, s.cut, array_to_string(w[1:s.cut], ' ') AS first, array_to_string(w[s.cut + 1:z], ' ') AS rest FROM c, range(1, 4) s(cut) WHERE s.cut < z),
sc AS (SELECT cut.lang, cut.phrase, cut.a, cut.cut, l.a AS l, r.a AS r, (2000000 * cut.a::HUGEINT) // (l.a + r.a) AS score
       FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = cut.first JOIN f r ON r.lang = cut.lang AND r.phrase = cut.rest),
b AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
sub AS (SELECT lang, unnest([array_to_string(w[i:i + y - 1], ' ') FOR i IN range(1, z - y + 2)]) AS phrase, a FROM c, range(2, 4) s(y) WHERE y < z),
big AS (SELECT lang, phrase, max(a) AS longer FROM sub GROUP BY ALL),
r AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank
      FROM b LEFT JOIN big USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM r JOIN tot USING (lang) WHERE rank <= 2000
"""
