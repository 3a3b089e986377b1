"""Exact top-k by inner product, pruned by segment statistics from coarse to fine.

Components become integers, floor(scale * x). A vector is described at several
resolutions by the mean and the deviation of each of its segments. They bound
the squared distance of two vectors from below, and with the lengths of both
known, the inner product from above: in each segment by
n * mean * mean + deviation * deviation. A candidate whose bound lies below the
k-th best score found so far is dropped; the next resolution looks only at the
rest, and what survives the finest one is scored exactly.

Queries come in blocks of a fixed number of rows, each sent to the tasks that
hold the candidates; the tasks return k rows per query. Vectors that are null,
empty, or hold null or non-finite components take no part, nor do rows without
an id; only vectors of equal length are compared. Equal scores rank the smaller
id first. Repeated rows are separate candidates, and one query if they repeat
id and vector; a query never meets a row with its own id. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .frames import staged

# Inner products of integers below this are exact in 53 bits for 2**13 components.
_EXACT = 2**20
_RESOLUTIONS = (1, 4, 16)


def features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products bound those of ``vectors`` from above."""
    parts = np.array_split(vectors.astype(float), min(segments, vectors.shape[1]), axis=1)
    columns = []
    for part in parts:
        mean = part.mean(axis=1)
        columns.append(mean * np.sqrt(part.shape[1]))
        columns.append(np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1)))
    return np.stack(columns, axis=1)


class Queries:
    """One block of queries of equal length with the best found so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.features = [features(vectors, s) for s in _RESOLUTIONS]
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.least = np.full(len(ids), -np.inf)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Score the candidates that no resolution rules out."""
        rows, cols = np.arange(len(self.ids)), np.arange(len(ids))
        alive = self.ids[:, None] != ids[None, :]
        for segments, mine in zip(_RESOLUTIONS, self.features, strict=True):
            bound = mine[rows] @ features(vectors[cols], segments).T
            slack = 1e-6 + 1e-9 * np.abs(bound)
            alive = alive & (bound + slack >= self.least[rows, None])
            keep_rows, keep_cols = alive.any(axis=1), alive.any(axis=0)
            rows, cols = rows[keep_rows], cols[keep_cols]
            alive = alive[np.ix_(keep_rows, keep_cols)]
            if not len(rows):
                return
        scores = self._scores(rows, vectors[cols])
        for row, score, here in zip(rows.tolist(), scores, alive, strict=True):
            found = [(-s, i) for s, i in zip(score[here].tolist(), ids[cols][here].tolist(), strict=True)]
            self.best[row] = sorted(self.best[row] + [(int(s), i) for s, i in found])[: self.k]
            if len(self.best[row]) == self.k:
                self.least[row] = -self.best[row][-1][0]

    def _scores(self, rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        if vectors.dtype == object or self.vectors.dtype == object:
            return self.vectors[rows].astype(object) @ vectors.astype(object).T
        # whole numbers below 2**53 stay exact in floating point
        return self.vectors[rows].astype(float) @ vectors.T.astype(float)


def integers(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer vectors) of the usable rows, one pair for each length."""
    by_length: dict[int, tuple[list, list]] = {}
    for i, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        if i is None or not vector.is_valid or not len(vector.values) or vector.values.null_count:
            continue
        x = np.floor(scale * vector.values.to_numpy().astype(float))
        if np.isfinite(x).all():
            ids, vectors = by_length.setdefault(len(x), ([], []))
            ids.append(i)
            vectors.append(x)
    for ids, vectors in by_length.values():
        stacked = np.stack(vectors)
        if np.abs(stacked).max() < _EXACT and stacked.shape[1] <= 2**13:
            yield np.array(ids), stacked
        else:
            yield np.array(ids), np.array([[int(c) for c in v] for v in vectors], object)


def top_k(
    df: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = 4096,
    chunk: int = 1024,
) -> DataFrame:
    """(query_id, rank, id_col, score): the k best rows of ``df`` for each query row."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    asked = staged(
        df.where(is_query)
        .select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
        .distinct(),
        "queries",
    )

    def search(part: pa.RecordBatch):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            queries = {v.shape[1]: Queries(i, v, k) for i, v in integers(part, scale)}
            for batch in batches:
                for ids, vectors in integers(batch, scale):
                    if (own := queries.get(vectors.shape[1])) is None:
                        continue
                    for at in range(0, len(ids), chunk):
                        own.meet(ids[at : at + chunk], vectors[at : at + chunk])
            for own in queries.values():
                found = [
                    (query, candidate, -score)
                    for query, best in zip(own.ids.tolist(), own.best, strict=True)
                    for score, candidate in best
                ]
                columns = list(zip(*found, strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["query_id", "id", "score"]
                )

        return task

    path = f"{scratch_path(df.sparkSession, 'found')}/rows"
    schema = "query_id long, id long, score long"
    df.sparkSession.createDataFrame([], schema).write.parquet(path)
    stream = asked.toLocalIterator()
    while taken := list(islice(stream, block)):
        columns = [pa.array([r[0] for r in taken], pa.int64()), pa.array([r[1] for r in taken])]
        part = pa.RecordBatch.from_arrays(columns, names=["id", "v"])
        rows.mapInArrow(search(part), schema).write.mode("append").parquet(path)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        df.sparkSession.read.schema(schema)
        .parquet(path)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
