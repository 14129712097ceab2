"""Tables of vectors: which rows count, their numpy form, joins of blocks.

Shared by the operators on vectors. A row counts if its id isn't null and its
vector isn't null or empty and has no null or non-finite component; vectors
of another length than the table's most frequent one (of equally frequent
lengths: the largest) don't count, as no inner product joins the two. An id
names one row: of several rows with one id the least (by label, if there is
one, then component by component) stands for all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triploom.session import materialize

ROW_BLOCK = 8192     # rows of one side that meet rows of the other at once
QUERY_BLOCK = 2048


@dataclass(frozen=True)
class VectorTable:
    """(vec_id, vector[, label]), stored; how many rows, of what length, and
    the largest absolute component."""

    df: DataFrame
    rows: int
    dim: int
    largest: float


def _usable(vector: Column) -> Column:
    inf = F.lit(float("inf"))
    return F.forall(vector, lambda x: F.coalesce(F.abs(x) < inf, F.lit(False)))


def vector_table(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                 label: str | None = None, nonzero: bool = False) -> VectorTable:
    """The rows of ``df`` that count, one per id, written to the checkpoint
    folder. Columns of other names don't matter. ``label`` must not be null
    in a row that counts; ``nonzero`` leaves zero vectors out."""
    single = isinstance(df.schema[vector].dataType.elementType, T.FloatType)
    x = F.col(vector).cast("array<float>" if single else "array<double>")
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("vector"),
                     *([F.col(label).alias("label")] if label else []))
    keep = F.col("vec_id").isNotNull() & (F.size("vector") > 0) & _usable(F.col("vector"))
    if nonzero:
        keep &= F.exists("vector", lambda v: v != 0)
    if label:
        keep &= F.col("label").isNotNull()
    rows = rows.filter(keep)
    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    dim = top[0]["dim"] if top else 0
    whole = F.struct(*(["label"] if label else []), "vector")
    one = (rows.filter(F.size("vector") == dim).groupBy("vec_id").agg(F.min(whole).alias("_w"))
           .select("vec_id", "_w.*"))
    stored = materialize(one, "vectors")
    found = stored.agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform(
        "vector", lambda v: F.abs(v).cast("double")))).alias("largest")).first()
    return VectorTable(stored, found["n"], dim, found["largest"] or 0.0)


def hash_sample(table: VectorTable, rows: int, most_bytes: int = 64 << 20):
    """At most ``rows`` rows (and ``most_bytes`` of vectors), the first by a
    hash of id and vector: ids and a matrix. The same rows on every run."""
    n = max(1, min(rows, most_bytes // max(8 * table.dim, 1)))
    got = (table.df.select("vec_id", "vector", F.xxhash64("vec_id", "vector").alias("_h"))
           .orderBy("_h", "vec_id").limit(n).select("vec_id", "vector").toArrow())
    return got["vec_id"].to_numpy(), matrix(got["vector"], table.dim)


def matrix(column, dim: int) -> np.ndarray:
    """A column of equally long lists as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, dim))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def lists(values: list[np.ndarray] | np.ndarray, kind=None) -> pa.ListArray:
    """Arrays as one column of lists."""
    sizes = np.fromiter((len(v) for v in values), np.int32, len(values))
    flat = np.concatenate(list(values)) if len(values) else np.empty(0)
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
        pa.array(flat, type=kind))


def padded(x: np.ndarray, scale: float, radius2: float) -> np.ndarray:
    """Scaled vectors with one more component that makes all norms equal
    ``sqrt(radius2)``: distance from a query (whose last component is 0) then
    falls as the inner product with it grows."""
    x = x * scale
    rest = np.sqrt(np.maximum(radius2 - np.einsum("ij,ij->i", x, x), 0.0))
    return np.hstack([x, rest[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of two matrices."""
    d2 = (np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :]
          - 2.0 * (a @ b.T))
    return np.sqrt(np.maximum(d2, 0.0))


def block_join(rows: DataFrame, queries: DataFrame, part: str, most_parts: int,
               work: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
               row_key: str = "vec_id", query_key: str = "query_id") -> DataFrame:
    """``work`` on every (block of rows, block of queries) of each part.

    ``part`` is a column of both sides with values from 0 to ``most_parts``
    - 1. Parts are counted first (a table of at most ``most_parts`` rows, hence
    broadcast); a side of a part with more rows than a block holds is dealt
    over several blocks by a hash of its key, and the other side goes to each
    of them, so that a task never holds more than about a block of each,
    however uneven the parts are.
    """
    n_rows = rows.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    n_queries = queries.groupBy(part).agg(F.count(F.lit(1)).alias("_m"))
    blocks = materialize(n_rows.join(n_queries, part).select(
        part, F.ceil(F.col("_n") / ROW_BLOCK).cast("int").alias("_nr"),
        F.ceil(F.col("_m") / QUERY_BLOCK).cast("int").alias("_nq")), "part-blocks")
    small = F.broadcast(blocks.limit(most_parts))
    own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (rows.join(small, part).withColumn("_r", own(row_key, "_nr"))
            .withColumn("_q", every("_nq")).drop("_nr", "_nq"))
    right = (queries.join(small, part).withColumn("_q", own(query_key, "_nq"))
             .withColumn("_r", every("_nr")).drop("_nr", "_nq"))
    keys = [part, "_r", "_q"]
    right = right.select([F.col(c).alias(c) for c in right.columns])   # columns of its own
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, schema)
