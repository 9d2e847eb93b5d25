"""Cover trees over a table of vectors, cut into blocks of bounded size.

The upper part of the tree is made by Spark: a cell of more than ``block_rows``
vectors is split by the nearest of some pivots of its own, level by level, so the
number of pivots grows with the rows. Cells that are small enough are packed into
blocks in the order of their paths, and runs of blocks into tiles, which is what
travels to a task. Within a block a cover tree goes on: nested levels with halving
radii, each centre a centre of all finer levels, and each node with the true radius
that covers its rows.

Vectors come as distinct rows (``vid`` long, ``kind`` string: what may be compared,
``x`` binary: little-endian doubles, and further columns). A cell whose split does
not make it smaller is cut by a hash of the ids, so blocks stay bounded on any data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import drop_staged, stage

BLOCK_BYTES = 4 << 20
PIVOTS = 64  # 256 at most: a step of a path is two digits
LEVELS = 12
CHUNK = 512
SLACK = 1e-9


def matrix(x: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(x), np.float64).reshape(len(x), -1)


class Tree:
    """Nodes over the rows of a block: centre row, covering radius, children, span of rows in tree order."""

    def __init__(self, x: np.ndarray, finest: float):
        self.x, self.finest = x, finest
        self.single = x.astype(np.float32)
        self.square = np.einsum("ij,ij->i", self.single, self.single)
        self.center, self.radius, self.first, self.last, self.kids = [], [], [], [], []
        self.order: list[int] = []
        away = self._away(0, np.arange(len(x)))
        self._add(np.arange(len(x)), 0, away, float(away.max()) / 2)

    def _away(self, c: int, rows: np.ndarray) -> np.ndarray:
        d = self.x[rows] - self.x[c]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    def _node(self, c: int, radius: float) -> int:
        self.center.append(c)
        self.radius.append(radius)
        self.first.append(len(self.order))
        self.last.append(0)
        self.kids.append([])
        return len(self.center) - 1

    def _add(self, rows: np.ndarray, c: int, away: np.ndarray, radius: float) -> int:
        """A node for ``rows`` with centre ``c``; its children are a net of ``radius``, ``c`` among them."""
        me = self._node(c, float(away.max()) * (1 + SLACK) + SLACK)
        while len(rows) > 1 and radius > self.finest and away.max() <= radius:
            radius /= 2
        if len(rows) == 1 or radius <= self.finest:
            self.order.extend(rows.tolist())
        else:
            centers, of = self._net(rows, c, radius)
            by = np.argsort(of, kind="stable")
            for k, own in enumerate(np.split(rows[by], np.cumsum(np.bincount(of, minlength=len(centers)))[:-1])):
                if len(own) == 1:
                    kid = self._node(int(own[0]), SLACK)
                    self.order.append(int(own[0]))
                    self.last[kid] = len(self.order)
                else:
                    kid = self._add(own, centers[k], self._away(centers[k], own), radius / 2)
                self.kids[me].append(kid)
        self.last[me] = len(self.order)
        return me

    def _net(self, rows: np.ndarray, c: int, radius: float) -> tuple[list[int], np.ndarray]:
        """Centres, and of each row the first of them within the radius (in single precision: radii are measured later)."""
        rows_first = np.concatenate([[c], rows[rows != c]])
        centers, of, limit = [], np.zeros(len(rows_first), np.int64), np.float32(radius * radius)
        for at in range(0, len(rows_first), CHUNK):
            own = rows_first[at : at + CHUNK]
            free = np.ones(len(own), bool)
            if centers:
                near = self._squares(own, np.array(centers)) <= limit
                free = ~near.any(axis=1)
                of[at : at + CHUNK] = np.argmax(near, axis=1)
            left = np.flatnonzero(free)
            near = self._squares(own[left], own[left]) <= limit
            open_ = np.ones(len(left), bool)
            for k in range(len(left)):
                if open_[k]:
                    take = near[k] & open_
                    take[k] = True
                    of[at + left[take]] = len(centers)
                    open_ &= ~take
                    centers.append(int(own[left[k]]))
        place = np.argsort(rows_first)
        return centers, of[place][np.searchsorted(rows_first[place], rows)]

    def _squares(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.square[a][:, None] + self.square[b] - 2 * (self.single[a] @ self.single[b].T)


TREE = ("kind string, block int, x binary, vids binary, weights binary, center binary, radius binary, first binary, last binary, "
        "kids binary, starts binary, ball binary, reach double")


def tree_of(pdf: pd.DataFrame, finest: float) -> pd.DataFrame:
    """One row for a block (kind, block, vid, weight, x): its rows in tree order and the nodes as arrays."""
    pdf = pdf.sort_values("vid")
    x = matrix(list(pdf["x"]))
    tree = Tree(x, finest)
    order = np.array(tree.order)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    starts = np.concatenate([[0], np.cumsum([len(k) for k in tree.kids])])
    return pd.DataFrame([{
        "kind": pdf["kind"].iloc[0], "block": int(pdf["block"].iloc[0]), "x": x[order].tobytes(), "vids": pdf["vid"].to_numpy()[order].tobytes(),
        "weights": pdf["weight"].to_numpy()[order].astype(np.int64).tobytes(), "center": place[tree.center].tobytes(),
        "radius": np.array(tree.radius).tobytes(), "first": np.array(tree.first, np.int32).tobytes(), "last": np.array(tree.last, np.int32).tobytes(),
        "kids": np.array([k for ks in tree.kids for k in ks], np.int32).tobytes(), "starts": starts.astype(np.int32).tobytes(),
        "ball": x[tree.center[0]].tobytes(), "reach": tree.radius[0]}])


class Block:
    """A block's rows and tree as read back."""

    def __init__(self, row):
        self.number, self.vids, self.weights = int(row["block"]), np.frombuffer(row["vids"], np.int64), np.frombuffer(row["weights"], np.int64)
        self.x = np.frombuffer(row["x"], np.float64).reshape(len(self.vids), -1)
        self.center, self.first, self.last = (np.frombuffer(row[k], np.int32) for k in ("center", "first", "last"))
        self.kids, self.starts = (np.frombuffer(row[k], np.int32) for k in ("kids", "starts"))
        self.radius = np.frombuffer(row["radius"], np.float64)
        self.leaf = self.starts[1:] == self.starts[:-1]
        self.ball, self.reach = self.x[self.center[0]], float(row["reach"])

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``nodes``, child)."""
        n = self.starts[nodes + 1] - self.starts[nodes]
        at = np.repeat(np.arange(len(nodes)), n)
        return at, self.kids[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.starts[nodes][at]].astype(np.int64)

    def frontier(self, radius: float) -> np.ndarray:
        """The uppermost nodes that are leaves or have at most this radius; together they hold all rows."""
        out, nodes = [], np.zeros(1, np.int64)
        while len(nodes):
            done = self.leaf[nodes] | (self.radius[nodes] <= radius)
            out.append(nodes[done])
            nodes = self.children(nodes[~done])[1]
        return np.concatenate(out)


def _nearest(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    """The rows of a part of a cell, each in the sub-cell of its nearest pivot."""
    if not len(rows):
        return rows.drop(columns=["part"])
    x, p = matrix(list(rows["x"])), matrix(list(pivots.sort_values("p_vid")["p_x"]))
    rows["cell"] = rows["cell"] + [f"{k:02x}" for k in np.argmin((p * p).sum(1) - 2 * (x @ p.T), axis=1)]
    return rows.drop(columns=["part"])


def cells_of(vectors: DataFrame, block_rows: int) -> DataFrame:
    """The staged vectors with ``cell``: the path of nearest pivots, as far down as cells are too large."""
    now = stage(vectors.withColumn("cell", F.lit("")), "cover-cells")
    for level in range(LEVELS):
        counts = now.groupBy("kind", "cell").agg(F.count(F.lit(1)).alias("n"))
        large = counts.filter(F.col("n") > block_rows)
        if not large.limit(1).count():
            break
        names = now.columns
        rows = now.join(large, ["kind", "cell"], "left")
        small = rows.filter("n IS NULL").select(*names)
        rows = rows.filter("n IS NOT NULL")
        parts = F.ceil(F.col("n") / block_rows).cast("int")
        pick = Window.partitionBy("kind", "cell").orderBy(F.xxhash64("vid", F.lit(level)))
        pivots = rows.withColumn("k", F.row_number().over(pick)).filter(F.col("k") <= PIVOTS) \
            .select(F.col("kind").alias("p_kind"), F.col("cell").alias("p_cell"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("p_part"),
                    F.col("vid").alias("p_vid"), F.col("x").alias("p_x"))
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("vid"), parts).cast("int")).select(*names, "part")
        split = dealt.groupBy("kind", "cell", "part").cogroup(pivots.groupBy("p_kind", "p_cell", "p_part")) \
            .applyInPandas(_nearest, dealt.drop("part").schema)
        after = stage(small.unionByName(split), "cover-cells")
        drop_staged(now)
        now = after
    return now


def blocks_of(vectors: DataFrame, block_rows: int) -> DataFrame:
    """The vectors (kind, vid, weight, x) with the number of their block within the kind."""
    cells = cells_of(vectors, block_rows)
    counts = cells.groupBy("kind", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("kind").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # A cell that pivots do not split is cut by hash.
    cut = F.when(F.col("n") > block_rows, F.pmod(F.xxhash64("vid"), F.lit(1 << 30)) / float(1 << 30) * F.col("n")).otherwise(0)
    return cells.join(counts, ["kind", "cell"]).withColumn("block", F.floor((F.col("before") + cut) / block_rows).cast("int")).drop("cell", "n", "before")


def trees_of(vectors: DataFrame, block_rows: int, finest: float) -> DataFrame:
    """A staged row for each block."""
    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        return tree_of(pdf, finest)

    blocked = blocks_of(vectors, block_rows).select("kind", "block", "vid", "weight", "x")
    return stage(blocked.groupBy("kind", "block").applyInPandas(tree, TREE), "cover-trees")


def tile_size(blocks: int) -> int:
    """Blocks in a tile: up to 8, as long as some hundred pairs of tiles are left."""
    return max(1, min(8, blocks // 24))


def distance(a: np.ndarray, b: np.ndarray) -> float:
    return math.sqrt(float(((a - b) ** 2).sum()))
