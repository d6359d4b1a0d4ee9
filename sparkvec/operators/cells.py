"""Approximate top-k: the store is split into cells, by k-means or around given vectors, and a query reads a few of them.

More probes mean better recall; probing every cell is the exact search. Rows of
all cells are kept, only the search is restricted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkvec.functions.vectors import as_matrix, check_metric, l2_normalize
from sparkvec.operators.checks import check_probes
from sparkvec.operators.knn import BROADCAST_BYTES, batch_topk

MAX_CENTROID_BYTES = 64 << 20


@dataclass(frozen=True)
class CellIndex:
    """Cell centres (cells x dimensions) and the metric they were fitted for."""

    centroids: np.ndarray
    metric: str

    @property
    def cells(self) -> int:
        return len(self.centroids)

    def _prepared(self, rows: np.ndarray) -> np.ndarray:
        if self.metric != "cosine":
            return rows
        norms = np.linalg.norm(rows, axis=1, keepdims=True)
        return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)

    def filled_cells(self, rows: np.ndarray, probes: int, sizes: np.ndarray, least: int) -> np.ndarray:
        """As :meth:`nearest_cells`, and more of them until they hold ``least`` rows; filled up with -1."""
        lists = self.nearest_cells(rows, probes)
        short = np.flatnonzero(sizes[lists].sum(axis=1) < least)
        if not short.size:
            return lists
        wide = np.full((len(rows), self.cells), -1, dtype=np.int32)
        wide[:, :probes] = lists
        step = max(1, (1 << 23) // self.cells)
        for start in range(0, short.size, step):
            some = short[start : start + step]
            order = self.nearest_cells(rows[some], self.cells)
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            wide[some] = np.where((before < least) | (np.arange(self.cells) < probes), order, -1)
        return wide[:, : max(probes, int((wide >= 0).sum(axis=1).max()))]

    def nearest_cells(self, rows: np.ndarray, probes: int) -> np.ndarray:
        """(rows x probes) numbers of the nearest cells, nearest first."""
        rows = self._prepared(rows)
        out = np.empty((len(rows), probes), dtype=np.int32)
        squared = np.einsum("ij,ij->i", self.centroids, self.centroids)
        step = max(1, (1 << 23) // self.cells)
        for start in range(0, len(rows), step):
            gap = squared[None, :] - 2.0 * (rows[start : start + step] @ self.centroids.T)
            out[start : start + step] = np.argsort(gap, axis=1, kind="stable")[:, :probes]
        return out


def _check_size(store: DataFrame, cells: int, vector_col: str) -> None:
    """Refuse centres that are too large for every task, before any work on them."""
    first = store.filter(F.col(vector_col).isNotNull()).select(F.size(vector_col)).head()
    if first is not None and 8 * cells * first[0] > MAX_CENTROID_BYTES:
        raise ValueError("the cell centres are too large to ship to every task; use fewer cells")


def fit_cells(
    store: DataFrame,
    *,
    cells: int,
    metric: str = "cosine",
    vector_col: str = "embedding",
    train_rows_per_cell: int | None = None,
    max_iter: int = 10,
    seed: int = 42,
) -> CellIndex:
    """Fit cell centres with k-means.

    All rows train; MLlib keeps them distributed and spills what memory cannot
    hold. ``train_rows_per_cell`` asks for a random share instead, which makes
    the centres coarser: :func:`assign_cells` places every row either way.
    """
    check_metric(metric)
    if cells < 2:
        raise ValueError("there must be at least 2 cells")
    _check_size(store, cells, vector_col)
    vector = F.col(vector_col)
    if metric == "cosine":
        vector = l2_normalize(vector)
    rows = store.filter(F.col(vector_col).isNotNull())
    if train_rows_per_cell is not None:
        share = cells * train_rows_per_cell / max(1, store.count())
        if share < 1.0:
            rows = rows.sample(fraction=share, seed=seed)
    features = rows.select(array_to_vector(vector.cast("array<double>")).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=max_iter).fit(features)
    centroids = np.array([np.asarray(c, dtype=np.float64) for c in model.clusterCenters()])
    return CellIndex(centroids, metric)


def given_cells(
    store: DataFrame, *, cells: int, metric: str = "cosine", id_col: str = "id", vector_col: str = "embedding"
) -> CellIndex:
    """Cells around stored vectors: those whose ids have the least md5, one pass and no training.

    Coarser than :func:`fit_cells`, but the same on every engine and every run.
    """
    check_metric(metric)
    if cells < 2:
        raise ValueError("there must be at least 2 cells")
    _check_size(store, cells, vector_col)
    rows = store.select(F.col(id_col).cast("string").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.orderBy(F.md5("id"), "id").limit(cells).toArrow()["vector"].combine_chunks()
    if not len(rows):
        raise ValueError("there are no vectors to make cells of")
    centres, _ = as_matrix(rows, len(rows[0]))
    return CellIndex(CellIndex(centres, metric)._prepared(centres), metric)


def assign_cells(store: DataFrame, index: CellIndex, vector_col: str = "embedding") -> DataFrame:
    """Add the ``cell`` of every row: one pass, no shuffle."""
    shared = store.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf("int")
    def cell(batch: pa.Array) -> pa.Array:
        fitted = shared.value
        rows, _ = as_matrix(batch, fitted.centroids.shape[1])
        return pa.array(fitted.nearest_cells(rows, 1)[:, 0])

    return store.withColumn("cell", cell.asNondeterministic()(F.col(vector_col)))


def write_cells(store: DataFrame, index: CellIndex, path: str) -> None:
    """Write the store partitioned by cell, so that a search reads only probed folders.

    Rows are rebalanced by cell: adaptive execution splits a crowded cell over
    several tasks and files, and packs small ones together.
    """
    placed = assign_cells(store, index).hint("rebalance", "cell")
    placed.write.partitionBy("cell").mode("errorifexists").parquet(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def approximate_topk(
    placed: DataFrame,
    queries: DataFrame,
    index: CellIndex,
    *,
    probes: int,
    top_k: int = 5,
    exclude_same_id: bool = False,
    id_col: str = "id",
    vector_col: str = "embedding",
    qid_col: str = "qid",
    query_vector_col: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES,
    checkpoint_store: bool = False,
) -> DataFrame:
    """Top-k among the ``probes`` cells nearest to each query: ``qid, rn, id, distance``.

    ``placed`` is the store with its ``cell`` column. Distances are exact; only
    rows of cells that were not probed can be missed. A query whose cells hold
    fewer than ``top_k`` rows probes further ones, so that it gets ``top_k`` rows
    if the store has them; the rows of each cell are counted for that.

    ``checkpoint_store`` is for a store that :func:`assign_cells` computes: a query set in blocks reads it once
    per block, and its cells would be computed each time, in a second Python worker beside each task's own.
    """
    check_probes(probes, index.cells)
    sizes = np.zeros(index.cells, dtype=np.int64)
    # a row per cell
    for row in placed.groupBy("cell").count().filter("cell is not null").collect():
        sizes[row["cell"]] = row["count"]
    least = top_k + int(exclude_same_id)
    return batch_topk(
        placed,
        queries,
        top_k=top_k,
        metric=index.metric,
        exclude_same_id=exclude_same_id,
        id_col=id_col,
        vector_col=vector_col,
        qid_col=qid_col,
        query_vector_col=query_vector_col,
        probes={
            "cells": index.cells,
            "nearest": lambda matrix: index.filled_cells(matrix, probes, sizes, least),
        },
        broadcast_bytes=broadcast_bytes,
        checkpoint_store=checkpoint_store,
    )
