"""Exact top-k search by inner product: dual-tree traversal of cover trees.

Vectors become whole numbers, floor(scale x); equal ones become one row that keeps
its k + 1 smallest ids. Queries and data are indexed together: the cells of
``cover_blocks`` are made of all distinct vectors, the rows of a cell that are
queries form trees of their own, in the same order.

For a query node with centre q and radius r and a data node with centre x and
radius s no row scores above <q, x> + r |x| + s |q| + r s. A node pair is pruned
when that bound is below the worst kth score of the query node's rows, else the
node of larger radius is split, and the leaves' rows are scored. Every query block
first meets the data block of the highest bound, which gives it kth scores; then
the other data blocks whose ball may beat its worst one, in parallel, each starting
from those scores. A query block against all blocks of data is the stated query set
against all rows in blocks; a block is bounded, and so is what a task holds.

Scores are sums of integers, exact in doubles while every partial sum stays below
2^53; vectors with a component beyond ``NARROW`` form blocks of their own that are
scored in unbounded integers (saturated to the range of a long), without pruning.

Defined cases: vectors that are null, empty, or hold null or non-finite components
take no part; vectors of different lengths do not meet; repeated rows with one id
are separate rows, and only a row itself is left out of its own answers; a null id
is no query and comes last in a tie; fewer candidates than k give fewer ranks;
empty tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import drop_staged, stage
from riskweave.llm.cover_blocks import BLOCK_BYTES, TREE, Block, blocks_of, tree_of

TOP = 5
EVERY = 50
SCALE = 256
#: Whole numbers up to this size have exact products in doubles, for up to 2^13 components.
NARROW = 1 << 20
FINEST = 0.5
ROWS = 512
STEP = 1 << 16
MANY = 1 << 20
LONG = np.iinfo(np.int64)


def whole(vector, scale: int = SCALE) -> np.ndarray | None:
    """floor(scale x) as doubles that hold whole numbers; None if the vector takes no part."""
    if vector is None or len(vector) == 0 or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    with np.errstate(over="ignore"):
        v = np.floor(v * scale) + 0.0
    return v if np.isfinite(v).all() else None


def whole_rows(rows: DataFrame, scale: int) -> DataFrame:
    """(rid, kind, same, x): the vectors that take part; the kind is the length, marked if a component is not narrow."""
    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(r, u) for r, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (u := whole(v, scale)) is not None]
            x = [u.tobytes() for _, u in found]
            kinds = [f"{len(u)}w" if len(u) > 8192 or np.abs(u).max() > NARROW else f"{len(u)}" for _, u in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in found], pa.int64()), pa.array(kinds, pa.string()),
                 pa.array([hashlib.blake2b(b, digest_size=16).digest() for b in x], pa.binary()), pa.array(x, pa.binary())],
                names=["rid", "kind", "same", "x"])

    return rows.mapInArrow(floors, "rid long, kind string, same binary, x binary")


class Best:
    """The best ``k`` rows found so far for each query row, and a score that the kth has at least."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None):
        self.k, self.floor = k, np.full(queries, -np.inf) if floor is None else floor.copy()
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def raise_floor(self, rows: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: of each of ``rows`` against distinct data rows."""
        if scores.shape[1] >= self.k:
            kth = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k]
            self.floor[rows] = np.maximum(self.floor[rows], kth)

    def add(self, q: np.ndarray, vid: np.ndarray, score: np.ndarray) -> None:
        keep = score >= self.floor[q]
        self.found.append((q[keep], vid[keep], score[keep]))
        self.size += int(keep.sum())
        if self.size > MANY:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keep the first ``k`` scores of each query row and all that tie with the kth."""
        q, vid, score = (np.concatenate(x) for x in zip(*self.found)) if self.found else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((-score, q))
        q, vid, score = q[order], vid[order], score[order]
        first = np.searchsorted(q, q)
        kth = np.minimum(first + self.k - 1, len(q) - 1)
        full = q[kth] == q if len(q) else np.zeros(0, bool)
        self.floor[q[full]] = np.maximum(self.floor[q[full]], score[kth[full]])
        keep = score >= self.floor[q]
        self.found, self.size = [(q[keep], vid[keep], score[keep])], int(keep.sum())
        return self.found[0]


def search(a: Block, b: Block, k: int, floor: np.ndarray | None = None) -> Best:
    """The best rows of ``b`` for every row of ``a``, but for scores below ``floor``."""
    best = Best(len(a.vids), k, floor)
    norm_a, norm_b = (np.sqrt(np.einsum("ij,ij->i", x.x, x.x)) for x in (a, b))
    i, j = (x.frontier(float(np.median(n)) / 2) for x, n in ((a, norm_a), (b, norm_b)))
    # Centres of distinct nodes are distinct rows: their scores alone give every query row a first kth score.
    centers = np.ascontiguousarray(b.x[b.center[j]].T)
    for at in range(0, len(a.vids), ROWS):
        rows = np.arange(at, min(at + ROWS, len(a.vids)))
        best.raise_floor(rows, a.x[rows] @ centers)

    def bounds(i, j, dots):
        p, q = a.center[i], b.center[j]
        return (dots + a.radius[i] * norm_b[q] + b.radius[j] * norm_a[p] + a.radius[i] * b.radius[j]) * (1 + 1e-12) + 1e-6

    for at in range(0, len(i), ROWS):
        own = i[at : at + ROWS]
        dots = a.x[a.center[own]] @ centers
        r, s = a.radius[own][:, None], b.radius[j]
        worst = np.array([best.floor[f:l].min() for f, l in zip(a.first[own], a.last[own])])
        bound = dots + r * norm_b[b.center[j]] + s * norm_a[a.center[own]][:, None] + r * s
        p, q = np.nonzero(bound + np.abs(bound) * 1e-12 + 1e-6 >= worst[:, None])
        todo = [(own[p], j[q])]
        while todo:
            m, n = todo.pop()
            if len(m) > STEP:
                todo += [(m[x : x + STEP], n[x : x + STEP]) for x in range(0, len(m), STEP)]
                continue
            bound = bounds(m, n, np.einsum("ij,ij->i", a.x[a.center[m]], b.x[b.center[n]]))
            own_nodes, at_node = np.unique(m, return_inverse=True)
            worst = np.array([best.floor[a.first[x] : a.last[x]].min() for x in own_nodes])[at_node]
            go = bound >= worst
            m, n = m[go], n[go]
            ends = a.leaf[m] & b.leaf[n]
            _score_leaves(a, b, m[ends], n[ends], best)
            m, n = m[~ends], n[~ends]
            split_a = ~a.leaf[m] & (b.leaf[n] | (a.radius[m] >= b.radius[n]))
            x, kid = a.children(m[split_a])
            todo.append((kid, n[split_a][x]))
            x, kid = b.children(n[~split_a])
            todo.append((m[~split_a][x], kid))
            todo = [x for x in todo if len(x[0])]
    best.cut()
    return best


def _score_leaves(a: Block, b: Block, m: np.ndarray, n: np.ndarray, best: Best) -> None:
    one = (a.last[m] - a.first[m] == 1) & (b.last[n] - b.first[n] == 1)
    p, q = a.first[m[one]], b.first[n[one]]
    best.add(p, b.vids[q], np.einsum("ij,ij->i", a.x[p], b.x[q]))
    for x, y in zip(m[~one].tolist(), n[~one].tolist()):
        rows, others = np.arange(a.first[x], a.last[x]), np.arange(b.first[y], b.last[y])
        score = a.x[rows] @ b.x[others].T
        best.add(np.repeat(rows, len(others)), np.tile(b.vids[others], len(rows)), score.ravel())


def exact_search(a: Block, b: Block, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All rows against all in unbounded integers; of each query row the first ``k`` scores and ties."""
    x = np.array([[int(v) for v in row] for row in b.x], object)
    out = []
    for p, row in enumerate(a.x):
        score = x @ np.array([int(v) for v in row], object)
        kth = sorted(score, reverse=True)[min(k, len(score)) - 1]
        keep = np.array([s >= kth for s in score])
        out.append((np.full(keep.sum(), p), b.vids[keep], np.array([min(max(s, LONG.min), LONG.max) for s in score[keep]], np.int64)))
    return out


FOUND = "qvid long, vid long, score long, kth double"


def meet(queries, data, k: int, floor: np.ndarray | None) -> pd.DataFrame:
    """(qvid, vid, score, kth) of a query block and a data block; ``kth``: what the query's kth score is at least."""
    a, b = Block(queries), Block(data)
    if "w" in queries["kind"] or "w" in data["kind"]:
        parts, kth = exact_search(a, b, k), np.full(len(a.vids), -np.inf)
    else:
        best = search(a, b, k, floor)
        parts, kth = best.found, best.floor
    p, vid, score = (np.concatenate(x) for x in zip(*parts))
    # A query without a row here still hands on what it knows.
    none = np.setdiff1d(np.arange(len(a.vids)), p)
    p, vid, score = np.concatenate([p, none]), np.concatenate([vid, np.full(len(none), -1)]), np.concatenate([score, np.zeros(len(none))])
    return pd.DataFrame({"qvid": a.vids[p], "vid": vid.astype(np.int64), "score": score.astype(np.int64), "kth": kth[p]})


def search_blocks(queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """(qvid, vid, score): for each distinct query vector its best distinct vectors."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.regexp_replace("kind", "w", "").alias("dim"), *[F.col(c).alias(f"{name}_{c}") for c in df.columns])

    q, d = side(queries, "q"), side(data, "d")
    names = [c.split()[0] for c in TREE.split(", ")]

    def bound(pdf: pd.DataFrame) -> pd.DataFrame:
        """The bound of each data block's ball for a query block."""
        a, r = np.frombuffer(pdf["q_ball"].iloc[0], np.float64), pdf["q_reach"].iloc[0]
        x = np.stack([np.frombuffer(b, np.float64) for b in pdf["d_ball"]])
        s = pdf["d_reach"].to_numpy()
        top = x @ a + r * np.sqrt((x * x).sum(1)) + s * np.sqrt(a @ a) + r * s
        return pdf.assign(bound=np.where(np.isfinite(top), top + np.abs(top) * 1e-9 + 1e-6, np.inf))[["q_kind", "q_block", "d_kind", "d_block", "bound"]]

    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, own in pdf.groupby(["q_kind", "q_block"]):
                yield bound(own)

    balls = q.select("dim", "q_kind", "q_block", "q_ball", "q_reach").join(d.select("dim", "d_kind", "d_block", "d_ball", "d_reach"), "dim")
    pairs = stage(balls.mapInPandas(bounded, "q_kind string, q_block int, d_kind string, d_block int, bound double"), "search-pairs")
    rank = Window.partitionBy("q_kind", "q_block").orderBy(F.col("bound").desc(), "d_kind", "d_block")
    first = stage(pairs.withColumn("k", F.row_number().over(rank)).filter("k = 1").drop("k"), "search-first")
    key = ["q_kind", "q_block", "d_kind", "d_block"]

    def with_blocks(p: DataFrame) -> DataFrame:
        return p.join(q.drop("dim"), key[:2]).join(d.drop("dim"), key[2:])

    def parts(row, name: str) -> dict:
        return {c: row[f"{name}_{c}"] for c in names}

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        return meet(parts(row, "q"), parts(row, "d"), k, None)

    def more(own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"qvid": [], "vid": [], "score": [], "kth": []})]
        floors = dict(zip(known["qvid"], known["kth"]))
        for _, row in own.iterrows():
            vids = np.frombuffer(row["q_vids"], np.int64)
            out.append(meet(parts(row, "q"), parts(row, "d"), k, np.array([floors[v] for v in vids])))
        return pd.concat(out)

    began = stage(with_blocks(first).groupBy(*key).applyInPandas(one, FOUND), "search-found")
    kth = began.groupBy("qvid").agg(F.max("kth").alias("kth"))
    place = queries.select(F.col("kind").alias("q_kind"), F.col("block").alias("q_block"), F.col("vids").alias("v")) \
        .mapInPandas(_members, "q_kind string, q_block int, qvid long")
    kth = stage(place.join(kth, "qvid"), "search-kth")
    worst = kth.groupBy("q_kind", "q_block").agg(F.min("kth").alias("worst"))
    rest = pairs.join(first.select(*key), key, "left_anti").join(worst, key[:2]).filter(F.col("bound") >= F.col("worst")).drop("worst")
    known = rest.select(*key).join(kth, key[:2]).select(*[F.col(c).alias(f"k_{c}") for c in key], "qvid", "kth")
    ended = with_blocks(rest).groupBy(*key).cogroup(known.groupBy(*[f"k_{c}" for c in key])).applyInPandas(more, FOUND)
    return stage(began.unionAll(ended).filter("vid >= 0").select("qvid", "vid", "score"), "search-found")


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for kind, block, vids in zip(*(pdf[c] for c in pdf)):
            yield pd.DataFrame({"q_kind": kind, "q_block": block, "qvid": np.frombuffer(vids, np.int64)})


def top_vectors(table: DataFrame, k: int = TOP, every: int = EVERY, scale: int = SCALE, block_rows: int | None = None,
                id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows whose id is divisible by ``every`` the ``k`` other rows of highest score."""
    rows = table.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("id"),
                        F.col(vector_col).cast("array<double>").alias("vector"))
    rows = stage(rows, "search-rows")
    ints = stage(whole_rows(rows.select("rid", "vector"), scale), "search-ints")
    named = stage(ints.drop("x").join(rows.select("rid", "id"), "rid"), "search-named")
    distinct = stage(named.groupBy("kind", "same").agg(
        F.min("rid").alias("vid"), F.max(F.coalesce(F.col("id") % every == 0, F.lit(False))).alias("query")), "search-distinct")
    vectors = ints.join(distinct.select("vid", "query"), F.col("rid") == F.col("vid")).select("kind", "vid", F.col("query").cast("long").alias("weight"), "x")
    widest = int(ints.agg(F.max(F.length("x"))).first()[0] or 8)
    size = block_rows or max(64, BLOCK_BYTES // widest)
    blocked = stage(blocks_of(vectors, size), "search-blocks")

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        return tree_of(pdf, FINEST)

    data = stage(blocked.groupBy("kind", "block").applyInPandas(tree, TREE), "search-data")
    asked = blocked.filter("weight = 1")
    counts = asked.groupBy("kind", "block").agg(F.count(F.lit(1)).alias("n"))  # a row a block
    before = Window.partitionBy("kind").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("run", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / size).cast("int")).drop("n")
    asked = asked.join(counts, ["kind", "block"]).drop("block").withColumnRenamed("run", "block")
    queries = stage(asked.groupBy("kind", "block").applyInPandas(tree, TREE), "search-queries")
    found = search_blocks(queries, data, k + 1)
    # The first k + 1 rows of a vector are enough for any query, as one of them may be the query itself.
    by_id = Window.partitionBy("kind", "same").orderBy(F.col("id").asc_nulls_last(), "rid")
    few = named.withColumn("k", F.row_number().over(by_id)).filter(F.col("k") <= k + 1).join(distinct.select("kind", "same", "vid"), ["kind", "same"]) \
        .select("vid", F.col("id").alias("vec_id"), F.col("rid").alias("of"))
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("of")]
    first = Window.partitionBy("qvid").orderBy(*order)
    answers = found.join(few, "vid").withColumn("k", F.row_number().over(first)).filter(F.col("k") <= k + 1).drop("k", "vid")
    asking = named.filter(F.col("id") % every == 0).join(distinct.select("kind", "same", "vid"), ["kind", "same"]) \
        .select(F.col("vid").alias("qvid"), F.col("id").alias("query_id"), "rid")
    ranked = asking.join(answers, "qvid").filter("rid <> of") \
        .withColumn("rank", F.row_number().over(Window.partitionBy("rid").orderBy(*order)).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: The same in DuckDB.
ORACLE = """
WITH e AS (SELECT row_number() OVER () AS rid, vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, c.rid AS of, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM e q JOIN e c ON q.rid <> c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST, of) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""
