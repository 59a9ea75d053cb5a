"""Nearest neighbours by cosine from randomly rotated one-bit codes, with exact reranking.

A unit vector is rotated by fixed random rotations and kept as the signs of its components, packed to
bits. With the correction ``o = <sign vector, rotated vector> / sqrt(dim)`` the inner product with a rotated
query q is estimated as ``<sign vector, q> / (sqrt(dim) * o)``, with an error of at most
``EPSILON * sqrt((1 - o * o) / (dim - 1)) / o`` but for a vanishing chance. The estimates of several rotations are
averaged. A vector whose upper bound is below the k-th largest cosine found so far cannot be among the k nearest; only
the others are computed exactly, some pairs at a time.

All queries meet all vectors: the queries are dealt to the tasks in blocks of bounded size, one pass
for each block, and a task keeps k vectors for each query. There is no cap on reranked vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import shared_dir, written

#: Standard deviations of the estimate that the bounds allow for.
EPSILON = 4.0
#: Bits of a code: as many rotations as are needed for them.
CODE_BITS = 512
#: Queries of one pass: together with the codes of a batch this bounds what a task holds.
QUERY_BLOCK = 4096
#: Queries, and vectors, that are compared at once, and pairs whose cosines are computed at once.
CHUNK, BATCH, PAIRS = 256, 2048, 32_768


@lru_cache(maxsize=8)
def rotations(dim: int, seed: int = 11) -> np.ndarray:
    """Random orthogonal matrices, one below the other, the same on every machine: ``CODE_BITS`` bits of code or more."""
    draw = np.random.Generator(np.random.PCG64(seed))
    parts = [np.linalg.qr(draw.standard_normal((dim, dim))) for _ in range(-(-CODE_BITS // dim))]
    return np.concatenate([q * np.sign(np.diag(r)) for q, r in parts])


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of each row (double precision, not zero) under all rotations, and a correction for each rotation."""
    dim = vectors.shape[1]
    turned = (vectors / np.sqrt((vectors * vectors).sum(1))[:, None]) @ rotations(dim).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).reshape(len(vectors), -1, dim).sum(2) / np.sqrt(dim)


def estimates(bits: np.ndarray, correction: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For unit ``queries`` (rows) and codes (columns) the estimated cosines, and the error bound of each code.

    The rotations' estimates are independent, so the error of their mean falls with the root of their number.
    """
    dim, n = queries.shape[1], correction.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim * n).astype(np.float32) * 2 - 1
    signs *= np.repeat(1 / (correction * (np.sqrt(dim) * n)), dim, axis=1).astype(np.float32)
    turned = (queries @ rotations(dim).T).astype(np.float32)
    spread = (np.maximum(0, 1 - correction**2) / max(1, dim - 1) / correction**2).sum(1)
    return turned @ signs.T, EPSILON * np.sqrt(spread) / n + 1e-5


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows in double precision; equal rows give equal values."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _usable(vectors: DataFrame) -> DataFrame:
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select("vec_id", values.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
        .withColumn("dim", F.size("v"))
    )


class Best:
    """The ``k`` nearest of each query so far; ``compared`` counts the exact cosines."""

    def __init__(self, n: int, k: int):
        self.k, self.compared = k, 0
        self.score = np.full((n, k), -np.inf)
        self.name = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, q: np.ndarray, v: np.ndarray, names: np.ndarray, vectors: np.ndarray, queries: np.ndarray) -> None:
        """Takes in the pairs of query ``q`` and vector ``v`` by their exact cosines."""
        if not len(q):
            return
        self.compared += len(q)
        here = np.unique(q)
        score = np.concatenate((self.score[here].ravel(), cosines(queries[q], vectors[v])))
        name = np.concatenate((self.name[here].ravel(), names[v]))
        row = np.concatenate((np.repeat(here, self.k), q))
        by = np.lexsort((name, -score, row))
        take = by[np.searchsorted(row[by], here)[:, None] + np.arange(self.k)]
        self.score[here], self.name[here] = score[take], name[take]


def _search(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` nearest of this task's vectors for each query, exactly."""
    best = Best(len(ids), k)
    for batch in batches:
        search_batch(batch, ids, queries, best)
    q, j = np.nonzero(best.score > -np.inf)
    columns = [pa.array(ids[q]), pa.array(best.name[q, j]), pa.array(best.score[q, j])]
    yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])


def search_batch(batch: pa.RecordBatch, ids: np.ndarray, queries: np.ndarray, best: Best) -> None:
    """Takes the vectors of one batch into ``best``."""
    unit, k = queries / np.sqrt((queries * queries).sum(1))[:, None], best.k
    if batch.num_rows:
        names, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1))
        # Of equal vectors only the k + 1 smallest ids can count (one may be the query's own), and k rows of each id.
        order = np.argsort(names, kind="stable")
        names, vectors = names[order], vectors[order]
        _, same = np.unique(vectors, axis=0, return_inverse=True)
        by = np.argsort(same.ravel(), kind="stable")
        groups, named = same.ravel()[by], names[by]
        new_group = np.concatenate(([True], groups[1:] != groups[:-1]))
        new_id = new_group | np.concatenate(([True], named[1:] != named[:-1]))
        at = np.arange(len(by))
        id_no = np.cumsum(new_id)
        place = id_no - id_no[np.maximum.accumulate(np.where(new_group, at, 0))]
        repeat = at - np.maximum.accumulate(np.where(new_id, at, 0))
        kept = np.sort(by[(place <= k) & (repeat < k)])
        names, vectors = names[kept], vectors[kept]
        for first in range(0, len(names), BATCH):
            some = slice(first, first + BATCH)
            bits, correction = encode(vectors[some])
            for low in range(0, len(ids), CHUNK):
                part = slice(low, low + CHUNK)
                guess, error = estimates(bits, correction, unit[part])
                guess[names[None, some] == ids[part, None]] = -np.inf
                # The best guesses are computed first, so that their exact cosines set the bar for the others.
                head = np.argpartition(-guess, min(2 * k, guess.shape[1] - 1), axis=1)[:, : 2 * k]
                q = np.repeat(np.arange(len(guess)), head.shape[1])
                known = guess[q, head.ravel()] > -np.inf
                best.add(low + q[known], first + head.ravel()[known], names, vectors, queries)
                np.put_along_axis(guess, head, -np.inf, axis=1)
                q, v = np.nonzero((guess + error >= best.score[part, -1:]) & (guess > -np.inf))
                for at in range(0, len(q), PAIRS):
                    best.add(low + q[at : at + PAIRS], first + v[at : at + PAIRS], names, vectors, queries)


def nearest(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest vectors of each query by cosine.

    ``vectors`` has ``vec_id`` (integer) and ``embedding``; ``is_query`` is a condition on ``vec_id``. Ties go to the
    smaller vec_id. Null and zero vectors, such with null or non-finite components and rows without an
    id take no part. Vectors are compared with those of their own length only. Rows that share a
    query's vec_id count as the query's own; of repeated query ids one row asks. With fewer than
    ``k`` candidates there are fewer ranks, without any the query has no row. Other columns are not read.
    """
    usable = written(_usable(vectors), "one-bit-vectors")
    asked = usable.where(is_query)
    sizes = asked.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per vector length
    schema = "query_id long, vec_id long, score double"
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    path, done = shared_dir(usable.sparkSession, "one-bit-nearest"), 0
    for dim, n in sizes:
        blocks = -(-n // QUERY_BLOCK)
        for b in range(blocks):
            mine = asked.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b))
            rows = mine.select("vec_id", "v").dropDuplicates(["vec_id"]).orderBy("vec_id").toArrow()
            if not rows.num_rows:
                continue
            ids, queries = rows.column(0).to_numpy(), _matrix(rows.column(1).combine_chunks())
            found = usable.where(F.col("dim") == dim).select("vec_id", "v").mapInArrow(
                lambda batches, ids=ids, queries=queries: _search(batches, ids, queries, k), schema
            )
            # Written before the next block is fetched, so that the driver holds the queries of one block.
            found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).write.parquet(f"{path}/block={done}")
            done += 1
    if not done:
        return usable.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return usable.sparkSession.read.parquet(path).select("query_id", "rank", "vec_id", "score")
