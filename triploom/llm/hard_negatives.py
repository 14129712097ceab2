"""Hard negatives by an exact search in a multiway hyperplane tree.

Every node of the tree has ``FANOUT`` split points; a row belongs to the child
whose split point is nearest. The split points come from a bounded sample,
everything else from all rows: for every split point and every sibling
subtree the least and the largest distance from the point to a row of that
subtree. A window of scores is an annulus around the anchor, and a subtree is
passed over if for any split point the distances that the annulus allows miss
that range. What is left are leaves, whose rows are compared exactly.

For an anchor, its positives are the best-scored other rows of its label, and
its hard negatives for one positive are the best-scored rows of other labels
whose score is within a window relative to the positive's. Both searches run
twice: in the leaves nearest to the anchor, which gives a score that the rest
must reach, and then in all leaves that the ranges don't rule out.

Scores are integers: components are quantised first (``floor(quantum * x)``),
and sums are exact. Distances (with the one more component of
``vectors.padded``) only rule subtrees out, with room for rounding.

Rows with a null id, label or vector, or a null or non-finite component, take
no part; zero vectors do. Lengths and repeated ids as in ``vectors``. Anchors
without a positive, and positives without a negative in the window, give no
row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triploom.llm.vectors import (
    VectorTable, block_join, distances, hash_sample, lists, matrix, padded, vector_table,
)
from triploom.session import materialize

FANOUT = 8
LEAF_ROWS = 1024         # rows a leaf aims at
MAX_LEAVES = 4096        # the tree is broadcast: at most so many leaves
SAMPLE = 32_768          # rows that the split points are chosen from
HOME = 3                 # leaves that are searched first
ROOM = 1e-6              # of the radius: what rounding may change of a distance
EXACT = 2.0 ** 53        # sums below are exact in doubles


@dataclass(frozen=True)
class Tree:
    """Split points per level, (nodes, FANOUT, length), and per level the
    ranges (nodes, FANOUT, FANOUT): of split point i to the rows of child j."""

    scale: float
    radius2: float
    points: list[np.ndarray]
    low: list[np.ndarray] | None = None
    high: list[np.ndarray] | None = None

    @property
    def leaves(self) -> int:
        return FANOUT ** len(self.points)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return padded(x, self.scale, self.radius2)


def _split_points(x: np.ndarray) -> np.ndarray:
    """Points far from each other: each is the farthest from those before."""
    pool = x[:8 * FANOUT]
    if not len(pool):
        return np.zeros((FANOUT, x.shape[1]))
    chosen = [0]
    far = distances(pool[:1], pool)[0]
    while len(chosen) < FANOUT:
        nxt = int(np.argmax(far))
        chosen.append(nxt)
        far = np.minimum(far, distances(pool[nxt:nxt + 1], pool)[0])
    return pool[chosen]


def _to_points(points: np.ndarray, node: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Distances of each row to the split points of its node."""
    p = points[node]
    d2 = (np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("nkj,nkj->nk", points, points)[node]
          - 2.0 * np.einsum("ikj,ij->ik", p, x))
    return np.sqrt(np.maximum(d2, 0.0))


def grow(sample: np.ndarray, scale: float, radius2: float, depth: int) -> Tree:
    """A tree of so many levels from (padded) sample rows."""
    points, node = [], np.zeros(len(sample), np.int64)
    for level in range(depth):
        here = np.stack([_split_points(sample[node == v]) for v in range(FANOUT ** level)])
        points.append(here)
        node = node * FANOUT + np.argmin(_to_points(here, node, sample), axis=1)
    return Tree(scale, radius2, points)


def _paths(tree: Tree, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level: node, distances to its split points, child taken."""
    node = np.zeros(len(x), np.int64)
    for points in tree.points:
        d = np.concatenate([_to_points(points, node[s:s + 1024], x[s:s + 1024])
                            for s in range(0, len(x), 1024)]) if len(x) else np.empty((0, FANOUT))
        child = np.argmin(d, axis=1)
        yield node, d, child
        node = node * FANOUT + child


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    leaf = np.zeros(len(x), np.int64)
    for node, _, child in _paths(tree, x):
        leaf = node * FANOUT + child
    return leaf


def with_ranges(placed: DataFrame, tree: Tree, dim: int) -> Tree:
    """The tree with the ranges of all rows: every task sends at most one row
    per split point and sibling, whose number doesn't grow with the data."""
    shapes = [p.shape[0] for p in tree.points]

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = [np.full((n, FANOUT, FANOUT), np.inf) for n in shapes]
        high = [np.full((n, FANOUT, FANOUT), -np.inf) for n in shapes]
        for b in batches:
            x = tree.rows(matrix(b["vector"], dim))
            for level, (node, d, child) in enumerate(_paths(tree, x)):
                np.minimum.at(low[level].transpose(0, 2, 1), (node, child), d)
                np.maximum.at(high[level].transpose(0, 2, 1), (node, child), d)
        for level, (lo, hi) in enumerate(zip(low, high, strict=True)):
            place = np.flatnonzero(np.isfinite(lo.ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(place), level, np.int32)), pa.array(place),
                 pa.array(lo.ravel()[place]), pa.array(hi.ravel()[place])],
                ["level", "place", "low", "high"])

    found = (placed.select("vector").mapInArrow(
        extremes, "level int, place long, low double, high double")
        .groupBy("level", "place").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .toArrow())
    low = [np.full((n, FANOUT, FANOUT), np.inf) for n in shapes]
    high = [np.full((n, FANOUT, FANOUT), -np.inf) for n in shapes]
    level, place = found["level"].to_numpy(), found["place"].to_numpy()
    for at in range(len(shapes)):
        mine = level == at
        low[at].ravel()[place[mine]] = found["low"].to_numpy()[mine]
        high[at].ravel()[place[mine]] = found["high"].to_numpy()[mine]
    return Tree(tree.scale, tree.radius2, tree.points, low, high)


def home_leaves(tree: Tree, q: np.ndarray) -> list[np.ndarray]:
    """The nearest leaves with rows below the node that each query comes to."""
    node = np.zeros(len(q), np.int64)
    for level, points in enumerate(tree.points):
        d = _to_points(points, node, q)
        d[~np.isfinite(tree.low[level][node].min(1))] = np.inf   # children without rows
        order = np.argsort(d, axis=1, kind="stable")
        if level == len(tree.points) - 1:
            keep = np.isfinite(np.take_along_axis(d, order, 1))[:, :HOME]
            return [(v * FANOUT + o[:HOME][m]).astype(np.int32)
                    for v, o, m in zip(node, order, keep, strict=True)]
        node = node * FANOUT + order[:, 0]
    return []


def open_leaves(tree: Tree, q: np.ndarray, near: np.ndarray, far: np.ndarray) -> list[np.ndarray]:
    """Per query, the leaves that may hold a row at a distance between
    ``near`` and ``far`` (one annulus per column; NaN: none)."""
    room = ROOM * np.sqrt(tree.radius2)
    who, node = np.arange(len(q)), np.zeros(len(q), np.int64)
    for level, points in enumerate(tree.points):
        nexts: list[tuple[np.ndarray, np.ndarray]] = []
        for s in range(0, len(who), 1024):
            w, v = who[s:s + 1024], node[s:s + 1024]
            d = _to_points(points, v, q[w])[:, :, None]
            lo, hi = tree.low[level][v], tree.high[level][v]
            alive = np.zeros((len(w), FANOUT), bool)
            for k in range(near.shape[1]):
                n, f = (a[w, k][:, None, None] for a in (near, far))
                hit = (lo <= d + f + room) & (hi >= d - f - room) & (hi >= n - d - room)
                alive |= hit.all(1)
            i, child = np.nonzero(alive)
            nexts.append((w[i], v[i] * FANOUT + child))
        who, node = (np.concatenate(c) for c in zip(*nexts, strict=True))
    order = np.argsort(who, kind="stable")
    return [a.astype(np.int32) for a in
            np.split(node[order], np.searchsorted(who[order], np.arange(1, len(q))))]


# --------------------------------------------------------------- searching ---

def _annuli(tree: Tree, x: np.ndarray, lows: np.ndarray, highs: np.ndarray):
    """Padded queries and the distances that their score windows stand for."""
    q = np.hstack([x * tree.scale, np.zeros((len(x), 1))])
    base = np.einsum("ij,ij->i", q, q)[:, None] + tree.radius2
    with np.errstate(invalid="ignore"):
        at = lambda s: np.sqrt(np.maximum(base - 2.0 * s * tree.scale ** 2, 0.0))
        near, far = at(highs), at(lows)
    empty = lows > highs
    near[empty] = far[empty] = np.nan
    return q, near, far


def _visits(asks: DataFrame, held, dim: int, home: bool) -> DataFrame:
    """One row per query and leaf to search: the home leaves, or all others
    that its windows (``lows``, ``highs``) may reach."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = held.value
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b["vector"], dim)
            width = [len(v) for v in b["lows"].to_pylist()]
            lows, highs = np.ones((len(x), max(width))), np.zeros((len(x), max(width)))
            for i, (lo, hi) in enumerate(zip(b["lows"].to_pylist(), b["highs"].to_pylist(),
                                             strict=True)):
                lows[i, :width[i]], highs[i, :width[i]] = lo, hi
            q, near, far = _annuli(tree, x, lows, highs)
            leaves = home_leaves(tree, q)
            if not home:
                leaves = [np.setdiff1d(o, h) for o, h in zip(
                    open_leaves(tree, q, near, far), leaves, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b["query_id"], b["label"], b["vector"], b["lows"], b["highs"],
                 lists(leaves, pa.int32())],
                ["query_id", "label", "vector", "lows", "highs", "leaves"])

    types = dict(asks.dtypes)
    names = ["query_id", "label", "vector", "lows", "highs"]
    schema = ", ".join(f"{n} {types[n]}" for n in names) + ", leaves array<int>"
    return asks.select(*names).mapInArrow(find, schema).select(*names, F.explode(
        "leaves").alias("leaf"))


def _scan(rows: DataFrame, visits: DataFrame, table: VectorTable, same: bool, k: int) -> DataFrame:
    """(query_id, vec_id, score): of every leaf, each query's ``k`` best rows
    of its own (``same``) or of other labels in each of its windows."""
    dim = table.dim
    whole = dim * table.largest ** 2 >= EXACT   # beyond doubles: in 64-bit integers
    kind = np.int64 if whole else np.float64

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        x = matrix(left["vector"], dim).astype(kind)
        q = matrix(right["vector"], dim).astype(kind)
        own, asks = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
        codes = {}
        code = lambda col: np.array([codes.setdefault(v, len(codes))
                                     for v in col.to_pylist()], np.int64)
        mine, theirs = code(left["label"]), code(right["label"])
        lows, highs = right["lows"].to_pylist(), right["highs"].to_pylist()
        out: list[tuple] = []
        for s in range(0, len(q) if len(x) else 0, 256):
            scores = q[s:s + 256] @ x.T
            for i, score in enumerate(scores, s):
                if not lows[i]:
                    continue
                ok = (mine == theirs[i]) == same
                ok &= (own != asks[i]) & (score >= min(lows[i])) & (score <= max(highs[i]))
                at = np.flatnonzero(ok)
                at = at[np.lexsort((own[at], -score[at]))]
                falling = -score[at]
                chosen: set[int] = set()
                for lo, hi in zip(lows[i], highs[i], strict=True):
                    a, b = np.searchsorted(falling, -hi), np.searchsorted(falling, -lo, "right")
                    chosen.update(at[a:min(b, a + k)].tolist())
                if chosen:
                    c = np.array(sorted(chosen))
                    out.append((np.full(len(c), asks[i]), own[c], score[c].astype(np.int64)))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])

    return block_join(rows, visits, "leaf", MAX_LEAVES, best,
                      "query_id long, vec_id long, score long")


def _top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(df: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding",
         label: str = "label", positives: int = 5, negatives: int = 10, low: int = 30,
         high: int = 90, quantum: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each row where ``is_anchor`` (a condition on the
    column ``vec_id``) holds and each of its positives, the best rows of other
    labels whose score is from ``low`` to ``high`` percent of the positive's."""
    spark = df.sparkSession
    out = ("anchor_id long, positive_id long, rank int, negative_id long, "
           "positive_score long, negative_score long")
    whole = F.transform(F.col(vector), lambda v: F.floor(v.cast("double") * quantum))
    finite = F.forall(F.col(vector), lambda v: F.coalesce(
        F.abs(v) < F.lit(float("inf")), F.lit(False)))
    table = vector_table(df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
                                   F.when(finite, whole).alias("vector")),
                         vector="vector", label="label")
    if table.rows < 2:
        return spark.createDataFrame([], out)
    if table.dim * table.largest ** 2 >= 2.0 ** 63:
        raise ValueError("scores of these vectors don't fit a 64-bit integer")
    scale = 2.0 ** -np.ceil(np.log2(max(table.largest, 1.0)))
    norm2 = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x * F.lit(scale)) * (
        x * F.lit(scale)))
    radius2 = max(table.df.agg(F.max(norm2)).first()[0], 1e-12)
    depth = 1
    while table.rows > LEAF_ROWS * FANOUT ** depth and FANOUT ** (depth + 1) <= MAX_LEAVES:
        depth += 1
    tree = grow(padded(hash_sample(table, SAMPLE)[1], scale, radius2), scale, radius2, depth)
    dim = table.dim

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = leaf_of(tree, tree.rows(matrix(b["vector"], dim)))
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], b["label"], b["vector"], pa.array(leaf.astype(np.int32))],
                ["vec_id", "label", "vector", "leaf"])

    types = dict(table.df.dtypes)
    names = ["vec_id", "label", "vector"]
    placed = materialize(table.df.select(*names).mapInArrow(
        place, ", ".join(f"{n} {types[n]}" for n in names) + ", leaf int"), "leaves")
    held = spark.sparkContext.broadcast(with_ranges(placed, tree, dim))
    asks = placed.filter(F.coalesce(is_anchor, F.lit(False))).select(
        F.col("vec_id").alias("query_id"), "label", "vector")
    window = lambda lo, hi: (F.array(lo).cast("array<double>").alias("lows"),
                             F.array(hi).cast("array<double>").alias("highs"))
    inf = F.lit(float("inf"))

    # positives: first in the home leaves, then wherever a better one can be
    first = materialize(_scan(placed, _visits(asks.select("*", *window(-inf, inf)), held, dim,
                                              True), table, True, positives), "positives-home")
    least = _top(first, ["query_id"], positives).filter(F.col("rank") == positives).select(
        "query_id", F.col("score").alias("_s"))
    more = _scan(placed, _visits(asks.join(least, "query_id", "left").select(
        "query_id", "label", "vector", *window(F.coalesce("_s", -inf), inf)), held, dim, False),
        table, True, positives)
    plus = materialize(_top(first.unionByName(more), ["query_id"], positives).select(
        "query_id", F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    # exact bounds: integer division rounds towards zero
    p = F.col("positive_score")
    up = F.expr(f"positive_score * {low} div 100") + F.when(
        (p * low > 0) & (p * low % 100 != 0), 1).otherwise(0)
    down = F.expr(f"positive_score * {high} div 100") - F.when(
        (p * high < 0) & (p * high % 100 != 0), 1).otherwise(0)
    plus = plus.select("*", up.alias("_low"), down.alias("_high")).filter(
        F.col("_low") <= F.col("_high"))

    def matched(found: DataFrame) -> DataFrame:
        both = found.join(plus, "query_id").filter(F.col("score").between(
            F.col("_low"), F.col("_high")))
        return _top(both, ["query_id", "positive_id"], negatives)

    def asked(bounds: DataFrame) -> DataFrame:
        per = bounds.groupBy("query_id").agg(
            F.sort_array(F.collect_list(F.struct("_low", "_high"))).alias("_w"))
        return asks.join(per, "query_id").select(
            "query_id", "label", "vector", F.col("_w._low").cast("array<double>").alias("lows"),
            F.col("_w._high").cast("array<double>").alias("highs"))

    first = materialize(_scan(placed, _visits(asked(plus), held, dim, True), table, False,
                              negatives), "negatives-home")
    least = matched(first).filter(F.col("rank") == negatives).select(
        "query_id", "positive_id", F.col("score").alias("_s"))
    bounds = plus.join(least, ["query_id", "positive_id"], "left").select(
        "query_id", F.coalesce("_s", "_low").alias("_low"), "_high")
    more = _scan(placed, _visits(asked(bounds), held, dim, False), table, False, negatives)
    return matched(first.unionByName(more)).select(
        F.col("query_id").alias("anchor_id"), "positive_id", "rank",
        F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
