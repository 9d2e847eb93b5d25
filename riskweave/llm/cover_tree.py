"""Embedding near-dedup: dual traversal of cover trees.

Vectors are scaled to unit length, so a cosine of at least ``threshold`` is a
distance of at most t = sqrt(2 - 2 threshold). Equal vectors become one weighted
row first. Blocks, trees and tiles come from ``cover_blocks``.

Two tiles whose covering balls come within t of each other meet in one task; so do
their blocks, and the nodes of the blocks' trees, level by level. A node pair is
dropped when its centres are further apart than t plus both radii, and taken whole
when even the furthest rows are within t: its rows then count each other without
being listed. Pairs of single rows decide by the cosine in double precision. A task
keeps counts and a union-find of a pair of blocks, and emits one row per linked
vector and pair at most. Link counts are summed, and components found, by Spark.

A tile holds a bounded number of bounded blocks, so every group a task holds is
bounded. On data without structure (independent directions in many dimensions)
covering balls overlap and pairs of blocks, and of nodes within them, grow with the
square of the number of distinct vectors; this is the method's limit.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing, nor do vectors of different lengths; equal rows,
also with one id, are separate vectors that link; a null id is no component id
while its component has another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import attach, drop_staged, stage
from riskweave.llm.components import connected_components
from riskweave.llm.cover_blocks import BLOCK_BYTES, SLACK, Block, distance, tile_size, trees_of

THRESHOLD = 0.9
FINEST = 0.01
ROWS = 1024


def unit(vector) -> np.ndarray | None:
    """The vector at unit length in double precision; None if it links with nothing."""
    if vector is None or len(vector) == 0 or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    if not np.isfinite(v).all():
        return None
    v = v / np.abs(v).max() if np.abs(v).max() else v
    norm = np.sqrt(v @ v)
    return v / norm + 0.0 if norm > 0 else None


def unit_rows(rows: DataFrame) -> DataFrame:
    """(rid, kind, same, x) of the rows that can link: unit vectors, a 128-bit digest of each, and its length as the kind."""
    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(r, u) for r, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (u := unit(v)) is not None]
            x = [u.tobytes() for _, u in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in found], pa.int64()), pa.array([str(len(u)) for _, u in found], pa.string()),
                 pa.array([hashlib.blake2b(b, digest_size=16).digest() for b in x], pa.binary()), pa.array(x, pa.binary())],
                names=["rid", "kind", "same", "x"])

    return rows.mapInArrow(scale, "rid long, kind string, same binary, x binary")


class Union:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)


def traverse(a: Block, b: Block, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, Union]:
    """The weights that the rows of each block link to in the other, and the union-find over them (b's rows after a's)."""
    t = float(np.sqrt(2 - 2 * threshold))
    # Differences count the links that whole node pairs add to a span of rows.
    add_a, add_b = np.zeros(len(a.vids) + 1, np.int64), np.zeros(len(b.vids) + 1, np.int64)
    sum_a, sum_b = (np.concatenate([[0], np.cumsum(x.weights)]) for x in (a, b))
    shift = 0 if same else len(a.vids)
    union = Union(len(a.vids) + (0 if same else len(b.vids)))

    def whole(i, j):
        """Every row of node i of a links with every row of node j of b."""
        for p, q in zip(i.tolist(), j.tolist()):
            f, l, g, m = a.first[p], a.last[p], b.first[q], b.last[q]
            add_a[f] += sum_b[m] - sum_b[g]
            add_a[l] -= sum_b[m] - sum_b[g]
            if not (same and p == q):
                add_b[g] += sum_a[l] - sum_a[f]
                add_b[m] -= sum_a[l] - sum_a[f]
            for r in range(f, l):
                union.join(int(f), r)
            for r in range(g, m):
                union.join(int(f), shift + r)

    def row_by_row(p, q):
        """Leaves of almost equal rows."""
        rows, cols = np.nonzero(a.x[a.first[p] : a.last[p]] @ b.x[b.first[q] : b.last[q]].T >= threshold)
        rows, cols = rows + a.first[p], cols + b.first[q]
        np.add.at(add_a, rows, b.weights[cols])
        np.add.at(add_a, rows + 1, -b.weights[cols])
        if not (same and p == q):
            np.add.at(add_b, cols, a.weights[rows])
            np.add.at(add_b, cols + 1, -a.weights[rows])
        for r, c in zip(rows.tolist(), cols.tolist()):
            union.join(r, shift + c)

    step = 1 << 16
    for first in _first_pairs(a, b, same, t):
        todo = [first]
        while todo:
            i, j = todo.pop()
            if len(i) > step:
                todo += [(i[k : k + step], j[k : k + step]) for k in range(0, len(i), step)]
                continue
            dots = np.einsum("ij,ij->i", a.x[a.center[i]], b.x[b.center[j]])
            away, reach = np.sqrt(np.maximum(0, 2 - 2 * dots)), a.radius[i] + b.radius[j]
            one = (a.last[i] - a.first[i] == 1) & (b.last[j] - b.first[j] == 1)
            take = (one & (dots >= threshold)) | (~one & (away + reach <= t - SLACK))
            whole(i[take], j[take])
            go = ~one & ~take & (away - reach <= t + SLACK)
            i, j = i[go], j[go]
            ends = a.leaf[i] & b.leaf[j]
            for p, q in zip(i[ends].tolist(), j[ends].tolist()):
                row_by_row(p, q)
            i, j = i[~ends], j[~ends]
            if not len(i):
                continue
            # Split the node with the larger radius (or the one that can be split); a node beside itself into pairs.
            split_a = ~a.leaf[i] & (b.leaf[j] | (a.radius[i] >= b.radius[j]))
            both = (i == j) & same
            todo.append(_pairs_within(a, i[both]))
            at, kid = a.children(i[split_a & ~both])
            todo.append((kid, j[split_a & ~both][at]))
            at, kid = b.children(j[~split_a & ~both])
            todo.append((i[~split_a & ~both][at], kid))
            todo = [x for x in todo if len(x[0])]
    return np.cumsum(add_a[:-1]), np.cumsum(add_b[:-1]), union


def _first_pairs(a: Block, b: Block, same: bool, t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of the uppermost nodes of half the linking distance whose covering balls come within it."""
    i, j = a.frontier(t / 2), b.frontier(t / 2)
    # dot >= 1 - (t + r_i + r_j)^2 / 2 as one product: the radii ride along as three more columns.
    # Single precision with a margin; the traversal judges exactly.
    r, s = a.radius[i] + t + SLACK, b.radius[j]
    left = np.column_stack([a.x[a.center[i]], r, r * r / 2, np.ones(len(r))]).astype(np.float32)
    right = np.ascontiguousarray(np.column_stack([b.x[b.center[j]], s, np.ones(len(s)), s * s / 2]).astype(np.float32).T)
    for at in range(0, len(i), ROWS):
        p, q = np.nonzero(left[at : at + ROWS] @ right[:, at if same else 0 :] >= np.float32(1 - 1e-4))
        p, q = p + at, q + (at if same else 0)
        keep = p <= q if same else slice(None)
        yield i[p[keep]], j[q[keep]]


def _pairs_within(a: Block, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (first not after second) of the children of each node."""
    at, kid = a.children(nodes)
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for own in np.split(kid, np.flatnonzero(np.diff(at)) + 1) if len(kid) else []:
        i, j = np.triu_indices(len(own))
        out_i.append(own[i])
        out_j.append(own[j])
    return np.concatenate(out_i), np.concatenate(out_j)


def block_links(a: Block, b: Block, threshold: float) -> pd.DataFrame:
    """(vid, links, root) of the rows of a pair of blocks that link at all; ``links`` counts other rows than the vector's first."""
    same = a.number == b.number
    n_a, n_b, union = traverse(a, b, same, threshold)
    if same:
        vids, links = a.vids, n_a + n_b - 1  # a row meets itself once
    else:
        vids, links = np.concatenate([a.vids, b.vids]), np.concatenate([n_a, n_b])
    held = np.flatnonzero(links > 0)
    return pd.DataFrame({"vid": vids[held], "links": links[held], "root": vids[np.array([union.root(int(i)) for i in held], np.int64)]})


def tile_links(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """The links between the blocks of two tiles, or within one."""
    pdf = pdf.sort_values("block")
    blocks = [(int(tile), Block(row)) for tile, (_, row) in zip(pdf["tile"], pdf.iterrows())]
    one, two = int(pdf["one"].iloc[0]), int(pdf["two"].iloc[0])
    t = float(np.sqrt(2 - 2 * threshold)) + SLACK
    out = [block_links(a, b, threshold) for i, a in blocks if i == one for j, b in blocks if j == two and a.number <= b.number
           if a.number == b.number or distance(a.ball, b.ball) <= a.reach + b.reach + t]
    return pd.concat(out) if out else pd.DataFrame({"vid": [], "links": [], "root": []})


def tile_pairs(trees: DataFrame, tile: int, limit: float) -> DataFrame:
    """(kind, one, two): the tiles (runs of ``tile`` blocks) whose covering balls come within ``limit``, each with itself."""
    def ball(pdf: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(b, np.float64) for b in pdf.sort_values("block")["ball"]]
        reach = max(distance(own[0], b) + r for b, r in zip(own, pdf.sort_values("block")["reach"]))
        return pd.DataFrame([{"kind": pdf["kind"].iloc[0], "tile": int(pdf["tile"].iloc[0]), "ball": own[0].tolist(), "reach": reach}])

    tiles = trees.select("kind", "block", "ball", "reach", F.floor(F.col("block") / tile).cast("int").alias("tile")) \
        .groupBy("kind", "tile").applyInPandas(ball, "kind string, tile int, ball array<double>, reach double")
    tiles = stage(tiles, "cover-tiles")
    other = tiles.select("kind", *[F.col(c).alias(f"{c}_2") for c in ("tile", "ball", "reach")])
    squares = F.aggregate(F.zip_with("ball", "ball_2", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    near = F.sqrt(squares) <= (F.col("reach") + F.col("reach_2") + limit) * (1 + SLACK) + SLACK
    return tiles.join(other, "kind").filter("tile <= tile_2").filter((F.col("tile") == F.col("tile_2")) | near) \
        .select("kind", F.col("tile").alias("one"), F.col("tile_2").alias("two"))


def link_vectors(table: DataFrame, threshold: float = THRESHOLD, block_rows: int | None = None,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each row with ``n_links``, ``component_id`` and ``kept`` (the id is its component's)."""
    rows = stage(table.withColumn("__rid", F.monotonically_increasing_id()), "cover-rows")
    units = stage(unit_rows(rows.select(F.col("__rid").alias("rid"), F.col(vector_col).cast("array<double>"))), "cover-units")
    distinct = stage(units.groupBy("kind", "same").agg(F.min("rid").alias("vid"), F.count(F.lit(1)).alias("weight")), "cover-distinct")
    vectors = units.join(distinct.select("vid", "weight"), F.col("rid") == F.col("vid")).select("kind", "vid", "weight", "x")
    widest = int(units.agg(F.max(F.length("x"))).first()[0] or 8)
    trees = trees_of(vectors, block_rows or max(64, BLOCK_BYTES // widest), FINEST)
    tile = tile_size(trees.count())
    pairs = tile_pairs(trees, tile, float(np.sqrt(2 - 2 * threshold)))
    sides = pairs.withColumn("tile", F.explode(F.array_distinct(F.array("one", "two"))))
    tiled = trees.withColumn("tile", F.floor(F.col("block") / tile).cast("int")).join(sides, ["kind", "tile"])

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        return tile_links(pdf, threshold)

    near = stage(tiled.groupBy("kind", "one", "two").applyInPandas(links, "vid long, links long, root long"), "cover-links")
    drop_staged(trees)
    degree = near.groupBy("vid").agg(F.sum("links").alias("links"))
    component = connected_components(near.select("vid", "root"))
    found = degree.join(component, degree["vid"] == component["node"], "left") \
        .select("vid", "links", F.coalesce("component", "vid").alias("component"))
    linked = units.select("rid", "kind", "same").join(distinct.select("kind", "same", "vid"), ["kind", "same"]) \
        .join(found, "vid").select("rid", "links", "component")
    ids = rows.select(F.col("__rid").alias("rid"), F.col(id_col).alias("id"))
    linked = stage(linked.join(ids, "rid"), "cover-found")
    smallest = linked.groupBy("component").agg(F.min("id").alias("smallest"))
    linked = linked.join(smallest, "component").select(F.col("rid").alias("__of"), F.col("links").alias("__links"), F.col("smallest").alias("__smallest"))
    joined = rows.join(linked, F.col("__rid") == F.col("__of"), "left")
    own = F.coalesce("__smallest", id_col)
    return attach(joined, {"n_links": F.coalesce("__links", F.lit(0)).cast("long"), "component_id": own.cast("long"),
                           "kept": F.coalesce(F.col(id_col) == own, F.lit(False))})
