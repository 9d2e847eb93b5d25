"""Language-model scores by context-tree weighting over bytes.

A text is read as its lower-cased words, single-spaced, and an end mark. Each byte
is eight binary decisions down a code tree; at every node of it, a context tree
over the ``DEPTH`` bytes before weighs the Krichevsky-Trofimov estimates of all
depths: P_w(s) = (P_kt(s) + product of P_w over the contexts that extend s) / 2.
Scores use the conditional form of the same mixture.

Training counts of (context, byte) and of words come from all training documents:
each task counts its own rows, and one shuffle adds the counts up. The tree keeps
every context seen, whatever the size of the input. The subtrees below ``CUT``
bytes, whose size the alphabet bounds, are weighed in parallel; the top of the tree
(contexts of fewer bytes, 65,536 of two at most) is weighed on the driver from
their sums. The distinct (context, byte) entries of the scored texts take part with
a count of zero, which changes no weight, so the result is a table with the log
probability of each entry. The ``ENTRIES`` commonest are broadcast; what a text
has beside them joins the table through a shuffle, with the same values.

The base score needs each word's training count: the most frequent words (a fixed
number) are broadcast with the model, the others join through a shuffle.

Defined cases: null text is empty and consists of the end mark; a null id counts
as the empty text for the fold; without training rows every decision has
probability 1/2; equal rows get equal scores.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.common import attach, stage
from riskweave.llm.learning import floor_for, id_remainder

DEPTH = 5
CUT = 3
ENTRIES = 600_000
CHUNK = 200_000
TOP_WORDS = 100_000
BLOCK = 1 << 20
HELD_KEYS = 800_000
HELD_WORDS = 150_000
#: Sums over shuffled rows are whole numbers of this unit, so their order does not matter.
UNIT = 1 << 32
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
END = 10
END_WORD = ""
U = np.uint64


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def stream(docs: list[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (context and byte, oldest byte highest) of all bytes of the documents, in order, with the
    first position and the length of each document. The context of a start is all end marks."""
    pad = b"\n" * depth
    parts = [b" ".join(d) + b"\n" for d in docs]
    s = np.frombuffer(pad + pad.join(parts), np.uint8)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = np.arange(sizes.sum()) + np.repeat(np.arange(len(parts)) * depth, sizes) + depth
    key = np.zeros(len(s) - depth, np.uint64)
    for j in range(depth + 1):
        key = (key << U(8)) | s[j : len(s) - depth + j]
    return key[at - depth], firsts, sizes


def runs(texts: Iterator[str | None]) -> Iterator[list[list[bytes]]]:
    """The tokens of the texts, in runs of about ``BLOCK`` bytes; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        run.append(tokens(t))
        size += len(t or "") + 1
        if size >= BLOCK:
            yield run
            run, size = [], 0
    if run:
        yield run


def gather(docs: DataFrame, text_col: str, depth: int, held: Column | None = None) -> DataFrame:
    """(key, word, n, seen): counts of byte contexts (word null) and of words (key null). ``n`` counts
    the training rows, ``seen`` all rows; rows that are ``held`` out have no part in the words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        keys, times, seen = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)

        def out(key, word, n, seen):
            return pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(word, pa.string()), *[pa.array(x, pa.int64()) for x in (n, seen)]],
                names=["key", "word", "n", "seen"])

        def out_keys():
            return out(keys.astype(np.int64), [None] * len(keys), times.astype(np.int64), seen.astype(np.int64))

        def flush_words():
            n = list(words.values())
            batch = out([None] * len(words), [w.decode("utf-8", "replace") for w in words], n, n)
            words.clear()
            return batch

        for batch in batches:
            apart = batch.column(1)
            for learnt in (True, False):
                for run in runs(t.as_py() for t, x in zip(batch.column(0), apart) if x.as_py() != learnt):
                    if learnt:
                        for d in run:
                            words.update(d)
                        words[b""] += len(run)
                    own, n = np.unique(stream(run, depth)[0], return_counts=True)
                    both, inverse = np.unique(np.concatenate([keys, own]), return_inverse=True)
                    times = np.bincount(inverse, np.concatenate([times, n * learnt]), len(both))
                    seen = np.bincount(inverse, np.concatenate([seen, n]), len(both))
                    keys = both
                    if len(keys) > HELD_KEYS:
                        yield out_keys()
                        keys, times, seen = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
                    if len(words) > HELD_WORDS:
                        yield flush_words()
        if len(keys):
            yield out_keys()
        if words:
            yield flush_words()

    return docs.select(F.col(text_col).cast("string"), F.lit(False) if held is None else held) \
        .mapInArrow(count, "key long, word string, n long, seen long") \
        .groupBy("key", "word").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


def kt_log(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - math.log(math.pi)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0: Stirling's series at x + 8, carried back by the recurrence."""
    x = np.asarray(x, np.float64)
    down = np.zeros_like(x)
    for k in range(8):
        down += np.log(x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - down


def suffix(key: np.ndarray, d: int) -> np.ndarray:
    """The keys with their last d context bytes."""
    return key & U((1 << (8 * (d + 1))) - 1)


def weigh(key: np.ndarray, n: np.ndarray, level: int, depth: int, top: int, beneath: tuple | None = None) -> dict:
    """The context trees of the code-tree nodes at one level (0 to 7).

    ``key`` and ``n``: entries with ``depth`` context bytes and their counts, all that end in the same
    ``top`` bytes; ``beneath``: (node ids, sums of log P_w) of the contexts that extend the deepest ones.
    Returns per d the node ids (context * 256 + code node) with log P_w and the mixture down to d:
    a probability of a 1 is ``one`` + ``left`` times what the contexts below give, that of a 0
    ``zero`` + ``left`` times it. Both sides are sums of positive terms, so neither is rounded away.
    ``of`` is the node of each entry at the deepest d.
    """
    nodes = {}
    byte = (key & U(255)).astype(np.int64)
    ids, of = np.unique((key & ~U(255)) | ((1 << level) | (byte >> (8 - level))).astype(np.uint64), return_inverse=True)
    ones = np.bincount(of, n * ((byte >> (7 - level)) & 1), len(ids))
    zeros = np.bincount(of, n, len(ids)) - ones
    below = np.zeros(len(ids))
    if beneath is not None:
        at = np.minimum(np.searchsorted(ids, beneath[0]), len(ids) - 1)
        own = ids[at] == beneath[0]
        below = np.bincount(at[own], beneath[1][own], len(ids))
    for d in range(depth, top - 1, -1):
        if d < depth:
            child = nodes[d + 1]
            ids, parent = np.unique(suffix(child["ids"], d), return_inverse=True)
            child["parent"] = parent
            zeros, ones = np.bincount(parent, child["zeros"], len(ids)), np.bincount(parent, child["ones"], len(ids))
            below = np.bincount(parent, child["log"], len(ids))
        kt = kt_log(zeros, ones)
        leaf = d == depth and beneath is None
        log = kt if leaf else np.logaddexp(kt, below) - math.log(2)
        nodes[d] = {"ids": ids, "zeros": zeros, "ones": ones, "kt": kt, "below": below, "log": log, "leaf": leaf}
    for d in range(top, depth + 1):
        node = nodes[d]
        if d == top:
            zero, one, left = 0.0, 0.0, np.ones(len(node["ids"]))
        else:
            zero, one, left = (nodes[d - 1][x][node["parent"]] for x in ("zero", "one", "left"))
        odds = np.clip(node["below"] - node["kt"], -700, 700)
        share, total = 1.0 if node["leaf"] else 1 / (1 + np.exp(odds)), node["zeros"] + node["ones"] + 1
        node["zero"] = zero + left * share * (node["zeros"] + 0.5) / total
        node["one"] = one + left * share * (node["ones"] + 0.5) / total
        node["left"] = np.zeros(len(total)) if node["leaf"] else left / (1 + np.exp(-odds))
    nodes["of"] = of
    return nodes


WEIGHED = "key long, n long, seen long, node long, log double, " + ", ".join(f"q{x} double" for x in range(8))


def weigh_below(counts: DataFrame, depth: int, cut: int) -> DataFrame:
    """The subtrees below ``cut`` context bytes. Each entry with ``q0`` to ``q7``, what its subtree gives to
    its eight decisions; and rows with a node of the contexts one byte shorter, and the sum of log P_w below it."""
    def run(key: np.ndarray, n: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
        q, nodes, logs = [], [], []
        for level in range(8):
            tree = weigh(key, n.astype(np.float64), level, depth, cut)
            deep, first = tree[depth], tree[cut]
            bit = ((key >> U(7 - level)) & U(1)) == 1
            q.append(np.where(bit, deep["one"][tree["of"]], deep["zero"][tree["of"]]))
            ids, at = np.unique(suffix(first["ids"], cut - 1), return_inverse=True)
            nodes.append(ids)
            logs.append(np.bincount(at, first["log"], len(ids)))
        node, log = np.concatenate(nodes), np.concatenate(logs)
        a, b = pa.nulls(len(node), pa.int64()), pa.nulls(len(node), pa.float64())

        def both(x, y, kind):
            return pa.concat_arrays([pa.array(x, kind) if isinstance(x, np.ndarray) else x, pa.array(y, kind) if isinstance(y, np.ndarray) else y])

        e, f = pa.nulls(len(key), pa.int64()), pa.nulls(len(key), pa.float64())
        columns = [both(x.astype(np.int64), a, pa.int64()) for x in (key, n, seen)]
        columns += [both(e, node.astype(np.int64), pa.int64()), both(f, log, pa.float64())]
        columns += [both(x, b, pa.float64()) for x in q]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in WEIGHED.split(", ")])

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            size += batch.num_rows
            if size < CHUNK:
                continue
            key, n, seen = (np.concatenate(x) for x in zip(*held))
            ends = np.flatnonzero(np.diff((key >> 8) & ((1 << (8 * cut)) - 1)))
            if len(ends):  # a subtree is weighed as a whole
                at = ends[-1] + 1
                yield run(key[:at].astype(np.uint64), n[:at], seen[:at])
                held = [[key[at:], n[at:], seen[at:]]]
            else:
                held = [[key, n, seen]]
            size = len(held[0][0])
        if size:
            key, n, seen = (np.concatenate(x) for x in zip(*held))
            yield run(key.astype(np.uint64), n, seen)

    context = F.shiftright("key", 8).bitwiseAND(F.lit((1 << (8 * cut)) - 1))
    dealt = counts.select("key", "n", "seen", context.alias("c")).repartition("c").sortWithinPartitions("c")
    return dealt.select("key", "n", "seen").mapInArrow(weighed, WEIGHED)


class HashTable:
    """A read-only map from unsigned keys to floats, with vectorised lookups."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 1.5).bit_length())
        self.shift, self.mask = U(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, ~U(0)), np.zeros(1 << bits)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == ~U(0)]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and whether each key is there."""
        slot = self._slot(keys)
        got, hit = self.values[slot], self.keys[slot] == keys
        todo = np.flatnonzero(~hit & (self.keys[slot] != ~U(0)))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            here = self.keys[slot[todo]]
            same = here == keys[todo]
            got[todo[same]], hit[todo[same]] = self.values[slot[todo[same]]], True
            todo = todo[~same & (here != ~U(0))]
        return got, hit


class Top:
    """The mixture down to the nodes of the contexts shorter than the cut."""

    def __init__(self, nodes: list[tuple[np.ndarray, np.ndarray]]):
        self.nodes = nodes  # per d (sorted ids, columns zero, one, left)

    def finish(self, keys: np.ndarray, q=lambda level: 0.5) -> np.ndarray:
        """log10 probability of the byte of each key; ``q(level)``: what the contexts below give."""
        byte, total = (keys & U(255)).astype(np.int64), np.zeros(len(keys))
        for level in range(8):
            node = ((1 << level) | (byte >> (8 - level))).astype(np.uint64)
            mix, todo = np.tile([0.0, 0.0, 1.0], (len(keys), 1)), np.arange(len(keys))
            for d in range(len(self.nodes) - 1, -1, -1):
                ids, values = self.nodes[d]
                if not len(todo) or not len(ids):
                    break
                want = (suffix(keys[todo], d) & ~U(255)) | node[todo]
                at = np.minimum(np.searchsorted(ids, want), len(ids) - 1)
                hit = ids[at] == want
                mix[todo[hit]] = values[at[hit]]
                todo = todo[~hit]
            side = (byte >> (7 - level)) & 1
            total += np.log10(mix[np.arange(len(keys)), side] + mix[:, 2] * q(level))
        return total


class Model:
    """The top of the tree, the commonest entries with their log probabilities, the common words'
    counts, and the totals."""

    def __init__(self, depth: int, nodes: list[tuple[np.ndarray, np.ndarray]], entries: np.ndarray, values: np.ndarray,
                 words: list[str], counts: list[int], total: int, distinct: int):
        self.depth, self.nodes, self.entries, self.values = depth, nodes, entries, values
        self.words, self.counts, self.total, self.distinct = words, counts, total, distinct
        self.table = self.word_logs = None

    def __getstate__(self):
        return {**self.__dict__, "table": None, "word_logs": None}

    def ready(self) -> "Model":
        """Build the lookup tables (once in each process)."""
        if self.table is None:
            self.table = HashTable(self.entries, self.values)
            self.word_logs = dict(zip([w.encode() for w in self.words], [math.log10(c + 0.5) for c in self.counts]))
        return self

    def walk(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of the byte of each key whose longer contexts are all unseen."""
        return Top(self.nodes).finish(keys)

    def scores(self, docs: list[list[bytes]]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """log10 probability of each text's common entries, and its other entries with their counts."""
        if not docs:
            return np.zeros(0), []
        keys, firsts, sizes = stream(docs, self.depth)
        value, hit = self.table.find(keys)
        others, of = keys[~hit].astype(np.int64), np.repeat(np.arange(len(docs)), sizes)[~hit]
        bounds = np.searchsorted(of, np.arange(len(docs) + 1))
        return np.add.reduceat(np.where(hit, value, 0.0), firsts), \
            [np.unique(others[a:b], return_counts=True) for a, b in zip(bounds, bounds[1:])]


def top_of_tree(weighed: DataFrame, cut: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per d below ``cut`` (sorted ids, mixture); the alphabet bounds what reaches the driver."""
    shorter = F.col("key").bitwiseAND(F.lit((1 << (8 * cut)) - 1))
    got = weighed.filter("key IS NOT NULL").groupBy(shorter.alias("k")).agg(F.sum("n").alias("n")).toArrow()
    key, n = got["k"].to_numpy().astype(np.uint64), got["n"].to_numpy().astype(np.float64)
    got = weighed.filter("key IS NULL").groupBy("node").agg(F.sum("log").alias("log")).toArrow()
    beneath = got["node"].to_numpy().astype(np.uint64), got["log"].to_numpy().astype(np.float64)
    if not len(key):
        return [(np.zeros(0, np.uint64), np.zeros((0, 3)))] * cut
    levels = [weigh(key, n, level, cut - 1, 0, beneath) for level in range(8)]
    out = []
    for d in range(cut):
        ids = np.concatenate([x[d]["ids"] for x in levels])
        order = np.argsort(ids)
        out.append((ids[order], np.stack([np.concatenate([x[d][c] for x in levels]) for c in ("zero", "one", "left")], 1)[order]))
    return out


def finished(weighed: DataFrame, shared) -> DataFrame:
    """(key, value): the log10 probability of each entry."""
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = Top(shared.value)
        for batch in batches:
            value = top.finish(batch.column(0).to_numpy().astype(np.uint64), lambda level: batch.column(1 + level).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value, pa.float64())], names=["key", "value"])

    return weighed.select("key", *[f"q{x}" for x in range(8)]).mapInArrow(finish, "key long, value double")


def learn(docs: DataFrame, text_col: str, depth: int, entries: int, top_words: int,
          held: Column | None = None) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the table (word, n) of the training words, and the table (key, value) of the entries
    of all rows beside those of the model."""
    cut = min(CUT, depth)
    counts = stage(gather(docs, text_col, depth, held), "ctw-counts")
    weighed = stage(weigh_below(counts.filter("key IS NOT NULL"), depth, cut), "ctw-entries")
    nodes = top_of_tree(weighed, cut)
    shared = docs.sparkSession.sparkContext.broadcast(nodes)
    own = weighed.filter("key IS NOT NULL")
    floor = floor_for(own, "seen", entries)
    common = finished(own.filter(F.col("seen") >= floor), shared).toArrow()
    words = counts.filter("word IS NOT NULL").select("word", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = words.filter(F.col("n") >= floor_for(words, "n", top_words)).toArrow().to_pydict()
    model = Model(depth, nodes, common["key"].to_numpy().astype(np.uint64), common["value"].to_numpy().astype(np.float64),
                  top["word"], top["n"], total, distinct)
    return model, words, finished(own.filter(F.col("seen") < floor), shared)


def fit(docs: DataFrame, text_col: str = "text", depth: int = DEPTH, entries: int = ENTRIES,
        top_words: int = TOP_WORDS) -> tuple[Model, DataFrame]:
    """The model, and the table (word, n) of the training words."""
    return learn(docs, text_col, depth, entries, top_words)[:2]


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1,
                    depth: int = DEPTH, entries: int = ENTRIES, top_words: int = TOP_WORDS,
                    carry: list[str] | None = None) -> DataFrame:
    """Learns from the rows outside fold ``held`` and scores all: the columns of ``carry`` (all by default)
    with ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``n_bytes`` (those coded, the
    end mark included) and ``bits_per_byte``, the code length."""
    results = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in results]
    out = id_remainder(id_col, folds) == held
    model, words, table = learn(docs, text_col, depth, entries, top_words, out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], out.alias("held_out"), F.monotonically_increasing_id().alias("__row"),
                       F.col(text_col).cast("string").alias("__text"))
    last = len(carry) + 2
    rare = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int32())]))
    deep = pa.list_(pa.int64())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.ready()
        get = own.word_logs.get
        for batch in batches:
            at = 0
            for run in runs(t.as_py() for t in batch.column(last)):
                own_rows = batch.slice(at, len(run))
                at += len(run)
                value, beside = own.scores(run)
                lists = pa.array(np.cumsum([0] + [len(k) for k, _ in beside]), pa.int32())
                keys, times = (pa.ListArray.from_arrays(lists, pa.array(np.concatenate([x[i] for x in beside]), pa.int64())).cast(deep)
                               for i in (0, 1))
                sums, n_known, others = [], [], []
                for d in run:
                    logs = list(map(get, d))
                    missing = Counter(w for w, x in zip(d, logs) if x is None)
                    end = get(b"")
                    if end is None:
                        missing[b""] += 1
                    sums.append(math.fsum(x for x in logs if x is not None) + (end or 0.0))
                    n_known.append(len(d) + 1 - sum(missing.values()))
                    others.append([{"word": w.decode("utf-8", "replace"), "n": n} for w, n in missing.items()])
                yield pa.RecordBatch.from_arrays(
                    [*own_rows.columns[:last], pa.array([len(d) + 1 for d in run], pa.int64()), pa.array(n_known, pa.int64()),
                     pa.array(sums, pa.float64()), pa.array(value, pa.float64()),
                     pa.array([sum(map(len, d)) + max(1, len(d)) for d in run], pa.int64()), pa.array(others, rare), keys, times],
                    names=[*carry, "held_out", "__row", "__n", "__top", "__sum", "__score", "__bytes", "__rare", "__keys", "__times"])

    schema = rows.drop("__text").schema.add("__n", "long").add("__top", "long").add("__sum", "double") \
        .add("__score", "double").add("__bytes", "long") \
        .add("__rare", T.ArrayType(T.StructType().add("word", "string").add("n", "integer"))) \
        .add("__keys", T.ArrayType(T.LongType())).add("__times", T.ArrayType(T.LongType()))
    scored = stage(rows.mapInArrow(score, schema), "ctw-scores")
    found = scored.select(F.col("__row").alias("__of"), F.explode("__rare").alias("r")).select("__of", "r.word", F.col("r.n").alias("m")) \
        .join(words, "word", "left")
    count = F.coalesce("n", F.lit(0))
    others = found.groupBy("__of").agg(F.sum(F.when(count > 0, F.col("m")).otherwise(0)).alias("__known"),
                                       (F.sum(F.col("m") * F.round(F.log10(count + 0.5) * UNIT).cast("long")) / UNIT).alias("__more"))
    deeper = scored.select(F.col("__row").alias("__in"), F.explode(F.arrays_zip("__keys", "__times")).alias("e")) \
        .select("__in", F.col("e.__keys").alias("key"), F.col("e.__times").alias("m")).join(table, "key") \
        .groupBy("__in").agg((F.sum(F.col("m") * F.round(F.col("value") * UNIT).cast("long")) / UNIT).alias("__deep"))
    joined = scored.drop("__rare", "__keys", "__times").join(others, F.col("__row") == F.col("__of"), "left") \
        .join(deeper, F.col("__row") == F.col("__in"), "left")
    unit = math.log10(model.total + 0.5 * (model.distinct + 1))
    base = F.col("__sum") + F.coalesce("__more", F.lit(0.0)) - F.col("__n") * unit
    score_of = F.col("__score") + F.coalesce("__deep", F.lit(0.0))
    return attach(joined, {
        "held_out": F.col("held_out"), "n_tokens": F.col("__n"), "n_known": F.col("__top") + F.coalesce("__known", F.lit(0)),
        "train_tokens": F.lit(model.total).cast("long"), "base_score": base,
        "score": score_of, "n_bytes": F.col("__bytes"), "bits_per_byte": -score_of / (F.col("__bytes") * math.log10(2))})
