"""Quality classifier: a factorisation machine over words, structure and metadata.

A document's features are its words hashed to ``2**bits`` slots (weights
1 + log count, scaled to unit length), ratios that describe its structure (case,
signs, line and word repetition, lengths), and its length as metadata, the ratios
also as one slot per tenth. The machine scores w0 + sum(w x) + pairwise terms of
rank ``RANK``; the pairs cost linear time by the identity
(sum of v x)^2 - sum of (v x)^2.

The model is fitted to a bounded sample of labelled rows, ``SAMPLE_ROWS`` at
most, chosen by id hash outside the held-out fold; features are extracted by the
executors, the sample's sparse features are fitted on the driver. Scoring is one
pass over the rows without a shuffle.

Defined cases: null text is empty; an empty text has only its metadata features
and gets a score like any other; without labels (or with one class only) the
score is the share of label 1, 0.5 for no labels; of several labels of one id the
largest counts; equal rows get equal scores.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.learning import hash_share, id_remainder

BITS = 15
RANK = 8
SAMPLE_ROWS = 8_000
EPOCHS = 8
BATCH = 128
THRESHOLD = 0.7
WORD = re.compile(r"[^ \t-\r]+")
SIGNS = np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~", np.uint8)
MEMO = 300_000
_SLOTS: dict[str, int] = {}


def structure(text: str, words: list[str], counts: Counter) -> list[float]:
    """Ratios between 0 and 1; the bytes of a non-ASCII character count as one letter by its first."""
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    marks = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    upper = marks[65:91].sum()
    letters = upper + marks[97:123].sum() + marks[0xC2:].sum()
    return [
        min(1.0, np.log1p(len(words)) / 12),
        min(1.0, sum(map(len, words)) / n / 20),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, len(lines) / n),
        letters / max(1, len(text)),
        upper / max(1, letters),
        min(1.0, 2 * marks[SIGNS].sum() / n),
        min(1.0, 2 * (marks[33] + marks[63]) / n),
        marks[48:58].sum() / max(1, len(text)),
        min(1.0, marks[46] / n * 5),
    ]


def _slot(word: str) -> int:
    """The hash of a word, remembered for the words that come again."""
    at = _SLOTS.get(word)
    if at is None:
        if len(_SLOTS) >= MEMO:
            _SLOTS.clear()
        _SLOTS[word] = at = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return at


def features(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of a text: slots and values. Words that share a slot stay separate terms."""
    text = text or ""
    words = WORD.findall(text)
    counts = Counter(words)
    slots = np.fromiter(map(_slot, counts), np.int64, len(counts)) & ((1 << bits) - 1)
    value = 1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))
    value /= max(1e-9, np.sqrt(value @ value))
    ratios = np.array([*structure(text, words, counts), min(1.0, np.log1p(len(text)) / 16)])
    first = (1 << bits) + 11 * np.arange(len(ratios))
    at = np.concatenate([slots, first + 10, first + np.minimum(9, (10 * ratios).astype(np.int64))])
    return at.astype(np.int32), np.concatenate([value, ratios, np.full(len(ratios), 0.5)]).astype(np.float32)


def slot_count(bits: int = BITS) -> int:
    return (1 << bits) + 11 * 13


class Machine:
    def __init__(self, size: int, rank: int = RANK, seed: int = 7):
        self.bias = 0.0
        self.linear = np.zeros(size)
        self.factors = np.random.default_rng(seed).normal(0, 0.01, (size, rank))

    def margins(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, tuple]:
        """Scores before the link function, and what the gradient needs."""
        sizes = np.array([len(a) for a, _ in rows])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        at, x = np.concatenate([a for a, _ in rows]), np.concatenate([v for _, v in rows]).astype(np.float64)
        vx = self.factors[at] * x[:, None]
        sums = np.add.reduceat(vx, starts)
        pairs = 0.5 * ((sums**2).sum(1) - np.add.reduceat((vx**2).sum(1), starts))
        return self.bias + np.add.reduceat(self.linear[at] * x, starts) + pairs, (at, x, vx, sums, sizes)

    def scores(self, rows) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.margins(rows)[0], -30, 30)))

    def fit(self, rows: list, labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-5, seed: int = 11):
        """AdaGrad on the logistic loss, in batches; deterministic for given rows."""
        share = labels.mean() if len(labels) else 0.5
        self.bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        if not len(labels) or share in (0.0, 1.0):
            self.factors[:] = 0
            return self
        rng = np.random.default_rng(seed)
        g_linear, g_factors, g_bias = np.full(len(self.linear), 1e-6), np.full(self.factors.shape, 1e-6), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for k in range(0, len(rows), BATCH):
                pick = order[k : k + BATCH]
                z, (at, x, vx, sums, sizes) = self.margins([rows[i] for i in pick])
                error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[pick]
                e = np.repeat(error, sizes) / len(pick)
                used, inverse = np.unique(at, return_inverse=True)
                slope = np.bincount(inverse, e * x) + decay * self.linear[used]
                each = (np.repeat(sums, sizes, axis=0) - vx) * (e * x)[:, None]
                steep = np.stack([np.bincount(inverse, c) for c in each.T], axis=1) + decay * self.factors[used]
                g_linear[used] += slope**2
                g_factors[used] += steep**2
                self.linear[used] -= rate * slope / np.sqrt(g_linear[used])
                self.factors[used] -= 0.02 * steep / np.sqrt(g_factors[used])
                g_bias += error.mean() ** 2
                self.bias -= rate * error.mean() / np.sqrt(g_bias)
        return self


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", bits: int = BITS) -> Machine:
    """A machine fitted to about ``rows`` labelled documents at most."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
    share = min(1.0, rows / max(1, known.count()))
    picked = known.filter(hash_share("__id", share, "quality")).groupBy("__id").agg(F.max("__label").alias("__label"))
    sample = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")) \
        .join(F.broadcast(picked), "__id").select("__id", "__label", "__text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t, bits) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(1), pa.array([a.astype("<i4").tobytes() for a, _ in found], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())], names=["id", "label", "slots", "vals"])

    got = sorted(sample.mapInArrow(extract, "id string, label int, slots binary, vals binary").collect())
    sparse = [(np.frombuffer(r["slots"], "<i4"), np.frombuffer(r["vals"], "<f4")) for r in got]
    return Machine(slot_count(bits)).fit(sparse, np.array([r["label"] for r in got], dtype=float))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", folds: int = 4, held: int = 2, threshold: float = THRESHOLD,
                    carry: list[str] | None = None) -> DataFrame:
    """The columns of ``carry`` (all by default) with ``held_out``, ``score`` and ``predicted``."""
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ("held_out", "score", "predicted")]
    out = id_remainder(id_col, folds) == held
    machine = train(docs.filter(~out), labels, id_col=id_col, text_col=text_col, label_col=label_col)
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], out.alias("held_out"), F.col(text_col).cast("string").alias("__text"))
    last = len(carry) + 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(last).to_pylist(), []
            for k in range(0, len(texts), 256):
                found.append(shared.value.scores([features(t) for t in texts[k : k + 256]]))
            values = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(values, pa.float64()),
                                              pa.array((values >= threshold).astype(np.int32), pa.int32())],
                                             names=[*carry, "held_out", "score", "predicted"])

    schema = rows.drop("__text").schema.add("score", "double").add("predicted", "integer")
    return rows.mapInArrow(score, schema)
