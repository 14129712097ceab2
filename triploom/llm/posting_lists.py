"""Approximate nearest neighbours by inner product over balanced posting lists.

A bounded sample is halved again and again into equally large lists, whose
means are the centroids. They and a graph over them (each linked to near
ones that no closer link covers) are all that a task holds in memory. Every
vector is found its lists by a walk over that graph; one near a border is
put into each list that is almost as near as the nearest. A query walks the
same graph and is answered from the lists whose centroid is at most a
certain ratio farther than the nearest one; lists beyond are pruned.

That ratio isn't guessed: for a bounded number of calibration queries the
exact answer over all rows is computed in one pass, and the ratio is the
least that reaches ``recall`` on them.

Inner products become distances by one more component (``vectors.padded``).
Lists are stored as rows and searched in blocks of bounded size
(``vectors.block_join``), first the nearest few of each query, which gives a
score that later rows must reach to be handed on, then the rest.

Vectors that are null, empty, zero or hold a null or non-finite component, and
rows without id, take no part; lengths and repeated ids as in
``vectors``. An empty table gives an empty result.
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

SAMPLE = 65_536          # vectors that the centroids are fitted on
LIST_ROWS = 128          # rows a list aims at, up to MAX_LISTS
MAX_LISTS = 4_096        # centroids are broadcast: at most so many
LINKS = 16               # links of a centroid in the graph
REPLICAS = 4             # lists that a vector is put in at most
BORDER = 0.05            # how much farther than the nearest such a list may be
HOME = 4                 # lists that every query is answered from
CALIBRATION = 256        # queries that set the pruning ratio
RECALL = 0.97            # recall that the ratio must reach on them
SLACK = 1e-9             # of a score: what summing in another order may change


@dataclass(frozen=True)
class Lists:
    """Centroids, the graph over them, and how vectors are scaled."""

    dim: int
    scale: float
    radius2: float
    centroids: np.ndarray
    first: np.ndarray        # links of centroid i: links[first[i]:first[i + 1]]
    links: np.ndarray
    entries: np.ndarray
    ratio: float = 0.0

    def rows(self, x: np.ndarray) -> np.ndarray:
        return padded(x, self.scale, self.radius2)

    def queries(self, x: np.ndarray) -> np.ndarray:
        x = x * self.scale
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        x = x * (np.sqrt(self.radius2) / np.maximum(norm, 1e-300))[:, None]
        return np.hstack([x, np.zeros((len(x), 1))])


def _halves(points: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two equally large parts of ``points[order]`` around two means."""
    x = points[order]
    centre = x.mean(0)
    far = x[np.argmax(((x - centre) ** 2).sum(1))]
    direction = far - centre
    for _ in range(6):
        side = order[np.argsort(x @ direction, kind="stable")]
        a, b = side[:len(side) // 2], side[len(side) // 2:]
        direction = points[b].mean(0) - points[a].mean(0)
    return a, b


def balanced_centroids(points: np.ndarray, n: int) -> np.ndarray:
    """Means of ``n`` (a power of two) equally large groups of points."""
    groups = [np.arange(len(points))]
    while len(groups) < n and min(len(g) for g in groups) > 1:
        groups = [h for g in groups for h in _halves(points, g)]
    return np.array([points[g].mean(0) for g in groups])


def centroid_graph(c: np.ndarray, links: int = LINKS):
    """Links from each centroid to near ones; a candidate that is closer to a
    chosen one than to the centroid is left out. All are reached from the
    entries."""
    n = len(c)
    out: list[list[int]] = []
    for i in range(n):
        d = distances(c[i:i + 1], c)[0]
        d[i] = np.inf
        chosen: list[int] = []
        for j in np.argsort(d, kind="stable")[:min(4 * links, n - 1)]:
            if len(chosen) == links:
                break
            if not chosen or distances(c[j:j + 1], c[chosen])[0].min() >= d[j]:
                chosen.append(int(j))
        out.append(chosen)
    for i in range(n):   # both ways
        for j in list(out[i]):
            if i not in out[j]:
                out[j].append(i)
    entry = int(np.argmin(((c - c.mean(0)) ** 2).sum(1)))
    reached, todo = {entry}, [entry]
    while True:
        while todo:
            for j in out[todo.pop()]:
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        rest = [i for i in range(n) if i not in reached]
        if not rest:
            break
        inside = np.array(sorted(reached))
        near = int(inside[np.argmin(distances(c[rest[0]:rest[0] + 1], c[inside])[0])])
        out[near].append(rest[0])
        out[rest[0]].append(near)
        reached.add(rest[0])
        todo.append(rest[0])
    first = np.concatenate([[0], np.cumsum([len(o) for o in out])]).astype(np.int64)
    return first, np.array([j for o in out for j in o], np.int64), np.array([entry])


def near_lists(index: Lists, q: np.ndarray, least: int, ratio: float) -> np.ndarray:
    """Distances from each row of ``q`` to the centroids that the walk found,
    infinite for the others. The walk goes on from every centroid that is
    among the ``least`` nearest found or within (1 + ratio) of the nearest."""
    c, n = index.centroids, len(index.centroids)
    d = np.full((len(q), n), np.inf)
    d[:, index.entries] = distances(q, c[index.entries])
    gone = np.zeros(d.shape, bool)
    qq, cc = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", c, c)
    degree = np.diff(index.first)
    while True:
        limit = np.maximum(d.min(1) * (1 + ratio),
                           np.partition(d, least - 1, axis=1)[:, least - 1] if n > least
                           else np.inf)
        go = (d <= limit[:, None]) & ~gone & np.isfinite(d)
        r, k = np.nonzero(go)
        if not len(r):
            return d
        gone |= go
        step = degree[k]
        at = np.repeat(index.first[k] - np.concatenate([[0], np.cumsum(step)[:-1]]), step)
        to = index.links[at + np.arange(step.sum())]
        pair = np.unique(np.repeat(r, step) * n + to)
        r, k = pair // n, pair % n
        new = np.isinf(d[r, k])
        r, k = r[new], k[new]
        for s in range(0, len(r), 65_536):
            i, j = r[s:s + 65_536], k[s:s + 65_536]
            d2 = qq[i] + cc[j] - 2.0 * np.einsum("ij,ij->i", q[i], c[j])
            d[i, j] = np.sqrt(np.maximum(d2, 0.0))


def _chunks(index: Lists, n: int) -> Iterator[slice]:
    size = max(16, (1 << 19) // len(index.centroids))
    return (slice(s, s + size) for s in range(0, n, size))


def lists_of_rows(index: Lists, x: np.ndarray) -> list[np.ndarray]:
    """The lists that each vector is put in, nearest first."""
    out: list[np.ndarray] = []
    for part in _chunks(index, len(x)):
        d = near_lists(index, index.rows(x[part]), 2 * REPLICAS, BORDER)
        k = min(REPLICAS, d.shape[1])
        order = np.argsort(d, axis=1, kind="stable")[:, :k]
        near = np.take_along_axis(d, order, 1)
        keep = near <= near[:, :1] * (1 + BORDER)
        keep[:, 0] = True
        out += [o[m].astype(np.int32) for o, m in zip(order, keep, strict=True)]
    return out


def lists_of_queries(index: Lists, x: np.ndarray) -> list[np.ndarray]:
    """The lists that each query is answered from, nearest first."""
    out: list[np.ndarray] = []
    for part in _chunks(index, len(x)):
        d = near_lists(index, index.queries(x[part]), 2 * HOME, index.ratio)
        order = np.argsort(d, axis=1, kind="stable")
        near = np.take_along_axis(d, order, 1)
        keep = near <= near[:, :1] * (1 + index.ratio)
        keep[:, :HOME] = np.isfinite(near[:, :HOME])
        out += [o[m].astype(np.int32) for o, m in zip(order, keep, strict=True)]
    return out


# ----------------------------------------------------------------- fitting ---

def _exact_for_sample(table: VectorTable, ids: np.ndarray, q: np.ndarray, k: int) -> pa.Table:
    """The k best rows over the whole table for a bounded number of queries."""
    dim = table.dim

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = np.full((len(q), 0), -np.inf)
        who = np.empty((len(q), 0), np.int64)
        vec = np.empty((len(q), 0, dim))
        for b in batches:
            x, own = matrix(b["vector"], dim), b["vec_id"].to_numpy()
            s = q @ x.T
            s[ids[:, None] == own[None, :]] = -np.inf
            top = np.argsort(-s, axis=1, kind="stable")[:, :k]
            score = np.hstack([score, np.take_along_axis(s, top, 1)])
            who, vec = np.hstack([who, own[top]]), np.concatenate([vec, x[top]], axis=1)
            top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            score, who = (np.take_along_axis(a, top, 1) for a in (score, who))
            vec = np.take_along_axis(vec, top[:, :, None], 1)
        i, j = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(who[i, j]), pa.array(score[i, j]),
             lists(list(vec[i, j]), pa.float64())], ["query", "vec_id", "score", "vector"])

    found = table.df.select("vec_id", "vector").mapInArrow(
        best, "query int, vec_id long, score double, vector array<double>")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)
            .drop("_rank").toArrow())


def fit(table: VectorTable, k: int = 20, recall: float = RECALL,
        list_rows: int = LIST_ROWS) -> Lists:
    """Lists for a table: centroids from a sample of at most ``SAMPLE`` rows,
    and the pruning ratio from ``CALIBRATION`` of them."""
    scale = 2.0 ** -np.ceil(np.log2(table.largest))
    norm2 = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x * F.lit(scale)) * (
        x * F.lit(scale)))
    radius2 = table.df.agg(F.max(norm2)).first()[0]
    ids, x = hash_sample(table, SAMPLE)
    n = 1
    while 2 * n <= min(MAX_LISTS, table.rows // list_rows, len(x) // 4):
        n *= 2
    c = balanced_centroids(padded(x, scale, radius2), n)
    index = Lists(table.dim, scale, radius2, c, *centroid_graph(c))
    ids, x = ids[:CALIBRATION], x[:CALIBRATION]
    truth = _exact_for_sample(table, ids, x, k)
    if not truth.num_rows:
        return index
    who = truth["query"].to_numpy()
    held = lists_of_rows(index, matrix(truth["vector"], table.dim))
    d = distances(index.queries(x), c)
    near = d.min(1)
    needed = np.array([d[q, at].min() / max(near[q], 1e-12) - 1
                       for q, at in zip(who, held, strict=True)])
    ratio = float(np.quantile(needed, recall, method="higher"))
    return Lists(**{**index.__dict__, "ratio": max(ratio, 0.0) + 1e-9})


# --------------------------------------------------------------- searching ---

def _search(rows: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """Of every list, the k best rows of each query that reach its ``least``
    score: (query_id, vec_id, score)."""
    names = ["query_id", "vec_id", "score"]
    kinds = [pa.int64(), pa.int64(), pa.float64()]

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        x, q = matrix(left["vector"], dim), matrix(right["vector"], dim)
        own, asks = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
        least = right["least"].to_numpy()
        out: list[tuple] = []
        for s in range(0, len(q) if len(x) else 0, 256):
            score = q[s:s + 256] @ x.T
            slack = SLACK * (1 + np.abs(score).max())
            score[asks[s:s + 256, None] == own[None, :]] = -np.inf
            floor = least[s:s + 256] - slack
            if len(x) > k:
                floor = np.maximum(floor, np.partition(score, len(x) - k, axis=1)[
                    :, len(x) - k] - slack)
            i, j = np.nonzero((score >= floor[:, None]) & np.isfinite(score))
            if not len(i):
                continue
            # the measure itself, summed component by component
            exact = np.cumsum(q[s + i] * x[j], axis=1)[:, -1]
            order = np.lexsort((own[j], -exact, i))
            i, j, exact = i[order], j[order], exact[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            i, j, exact = (a[place < k] for a in (i, j, exact))
            out.append((asks[s + i], own[j], exact))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    return block_join(rows, queries, "list", MAX_LISTS, best,
                      "query_id long, vec_id long, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.dropDuplicates(["query_id", "vec_id"])
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))


def nearest(df: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id",
            vector: str = "embedding", recall: float = RECALL,
            list_rows: int = LIST_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the largest inner
    product found for each row where ``is_query`` (a condition on the column
    ``vec_id``) holds, never the query's own row."""
    table = vector_table(df, vec_id, vector, nonzero=True)
    spark = df.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    if table.rows < 2:
        return spark.createDataFrame([], out)
    index = fit(table, k, recall, list_rows)
    held = spark.sparkContext.broadcast(index)
    dim = table.dim

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for b in batches:
            x = matrix(b["vector"], dim)
            asks = np.flatnonzero(b["is_query"].to_numpy(zero_copy_only=False))
            probes = [np.empty(0, np.int32)] * len(x)
            for i, p in zip(asks, lists_of_queries(own, x[asks]), strict=True):
                probes[i] = p
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], b["vector"], lists(lists_of_rows(own, x), pa.int32()),
                 lists(probes, pa.int32())], ["vec_id", "vector", "lists", "probes"])

    kind = dict(table.df.dtypes)["vector"]
    placed = materialize(table.df.withColumn("is_query", F.coalesce(is_query, F.lit(False)))
                         .mapInArrow(place, f"vec_id long, vector {kind}, lists array<int>, "
                                            "probes array<int>"), "posting-lists")
    rows = placed.select("vec_id", "vector", F.explode("lists").alias("list"))
    asks = placed.filter(F.size("probes") > 0).select(
        F.col("vec_id").alias("query_id"), "vector", "probes")
    at = lambda lo, n: F.explode(F.slice("probes", lo, n)).alias("list")
    home = materialize(_ranked(_search(rows, asks.select(
        "query_id", "vector", F.lit(float("-inf")).alias("least"), at(1, HOME)), dim, k), k),
        "home-lists")
    least = home.filter(F.col("rank") == k).select("query_id", F.col("score").alias("_s"))
    rest = asks.join(least, "query_id", "left").select(
        "query_id", "vector", F.coalesce("_s", F.lit(float("-inf"))).alias("least"),
        at(HOME + 1, MAX_LISTS))
    found = home.select("query_id", "vec_id", "score").unionByName(_search(rows, rest, dim, k))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def exact_nearest(ids, x: np.ndarray, queries, k: int = 20) -> dict:
    """By force, for small tables: query id -> [(vec_id, score)]."""
    out = {}
    for q in queries:
        i = int(np.flatnonzero(ids == q)[0])
        score = np.cumsum(x[i][None, :] * x, axis=1)[:, -1]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
        out[int(q)] = [(int(ids[j]), float(score[j])) for j in order]
    return out
