"""Top-k for many query vectors at once, exact or restricted to probed cells.

Every task streams its part of the store through a matrix product against a
block of queries and keeps a running top-k per query, so a task emits at most
``queries x k`` narrow rows and the store itself is never shuffled. The query
set is broadcast at once only while its size is within a bound; a larger one is
cut into blocks of ``BLOCK_BYTES``, which are broadcast in turn. Then the distances
to some rows of the store are known first, and a task returns only what is as near
as a query's k-th of those.
"""

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkvec.functions.vectors import TIE_DECIMALS, as_matrix, check_metric
from sparkvec.operators.checks import check_top_k
from sparkvec.session import ensure_checkpoint_dir, shared_dir

BROADCAST_BYTES = 64 << 20  # vectors and running lists of a query set that may be broadcast at once
#: Vectors and running lists of the queries one task holds. The store is read once per block, so a smaller
#: one would read it more often, and a larger one is held by every Python worker.
BLOCK_BYTES = 16 << 20
LIST_BYTES = 24  # one place of a running list
WINNER_BYTES = 64  # one (query, rank, id, distance) row in a broadcast relation
PRODUCT_CELLS = 1 << 21  # floats in one (queries x rows) product, 8 MB
EXACT_PAIRS = 8192  # pairs whose distance is computed at a time in double precision

BLOCKS_PER_JOB = (4, 16)  # query blocks that one job searches, by their size; the driver holds them together
BOUND_ROWS = 4096  # rows of the store that bound the distances of a query set in blocks

SCREEN_NORM = 1e15  # vectors longer than this are not screened in single precision

_PARTIAL = "_q long, id long, distance double"
_PARTIAL_TYPES = pa.schema([("_q", pa.int64()), ("id", pa.int64()), ("distance", pa.float64())])


class RunningTopK:
    """The k nearest rows seen so far for each query of a block.

    Pairs are screened by one single-precision matrix product per batch, with a
    bound on its rounding error; only pairs that may still enter are computed
    in double precision. What comes out is exact.

    The product is arranged so that a larger value means nearer and so that
    one threshold per query is enough: unit vectors for cosine; for euclidean,
    rows carry an extra element ``-|r|^2 / 2`` against a 1 in the query, which
    makes the product ``(|q|^2 - distance^2) / 2``.
    """

    def __init__(
        self, queries: np.ndarray, valid: np.ndarray, k: int, metric: str, ceiling: np.ndarray | None = None
    ):
        # a rank key that the k-th best row of the whole store does not exceed; infinite where unknown
        self.ceiling = np.full(len(queries), np.inf) if ceiling is None else ceiling
        self.queries, self.k, self.metric = queries, k, metric
        self.norms = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        self.defined = valid & (self.norms > 0) if metric == "cosine" else valid
        self.screen = self._screen_form(queries, self.norms, 1.0)
        self.bound = np.full(len(queries), np.inf)  # rank key of the last place held so far
        self.count = np.zeros(len(queries), dtype=np.int64)
        # Best rows in rank order; the first `count` places of a query are filled.
        self.ids = np.zeros((len(queries), k), dtype=np.int64)
        self.keys = np.full((len(queries), k), np.inf)
        self.exact = np.full((len(queries), k), np.inf)

    def _screen_form(self, matrix, norms, extra) -> np.ndarray:
        if self.metric == "cosine":
            unit = np.zeros(matrix.shape, dtype=np.float32)
            np.divide(matrix, norms[:, None], out=unit, where=norms[:, None] > 0, casting="unsafe")
            return unit
        tail = np.broadcast_to(extra, norms.shape)[:, None]
        return np.hstack([matrix, tail]).astype(np.float32)

    def add(
        self,
        ids: np.ndarray,
        rows: np.ndarray,
        row_valid: np.ndarray,
        only: np.ndarray | None = None,
        skip_own_id: np.ndarray | None = None,
    ) -> None:
        """Offer rows to the queries, or to those numbered in ``only``."""
        numbers = np.arange(len(self.queries)) if only is None else only
        norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        defined = row_valid & (norms > 0) if self.metric == "cosine" else row_valid
        near = np.flatnonzero(defined)
        if near.size:
            part = (ids[near], rows[near], norms[near])
            screen = self._screen_form(part[1], part[2], -0.5 * part[2] ** 2)
            width = max(1, PRODUCT_CELLS // near.size)
            able = numbers[self.defined[numbers]]
            for start in range(0, len(able), width):
                self._offer(able[start : start + width], *part, screen, skip_own_id)
        self._offer_undefined(numbers, ids, ids[~defined], skip_own_id)

    def _offer(self, numbers, ids, rows, norms, screen, skip_own_id) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            product = self.screen[numbers] @ screen.T
        # beyond the range of single precision the screen says nothing: such pairs are decided in double
        unsure = None
        large = self.metric != "cosine" and max(self.norms[numbers].max(initial=0), norms.max()) > SCREEN_NORM
        if large:
            unsure = ~np.isfinite(product)
            unsure |= (norms > SCREEN_NORM)[None, :] | (self.norms[numbers] > SCREEN_NORM)[:, None]
            product[unsure] = -np.inf
        own = None
        if skip_own_id is not None:
            _, own_q, own_r = np.intersect1d(skip_own_id[numbers], ids, return_indices=True)
            own = own_q * len(ids) + own_r
            product[own_q, own_r] = -np.inf
        # the last key of a list that is not full bounds nothing
        reached = np.where(self.count[numbers] >= self.k, self.bound[numbers], np.inf)
        limit = np.minimum(reached, self.ceiling[numbers])
        full = np.isfinite(limit)
        tie = 2 * 10.0**-TIE_DECIMALS
        # Rounding of the inputs and of the sum, both ways.
        unit_error = 2.0 * (screen.shape[1] + 4) * np.finfo(np.float32).eps
        if self.metric == "cosine":
            slack = np.full(len(numbers), unit_error + tie)
            floor = 1.0 - limit
        else:
            q_norm, r_norm = self.norms[numbers], norms[norms <= SCREEN_NORM].max(initial=0)
            slack = unit_error * (q_norm + r_norm) * (r_norm + 1e-30) + tie * (q_norm + r_norm + 1)
            with np.errstate(over="ignore"):
                floor = (q_norm**2 - limit**2) / 2
        floor = np.where(full, floor - slack, -np.inf)
        if len(ids) > self.k and not full.all():
            open_ = np.flatnonzero(~full)
            kth = np.partition(product[open_], len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            floor[open_] = kth - 2 * slack[open_]
        floor = np.nextafter(floor.astype(np.float32), np.float32(-np.inf))
        may = product >= floor[:, None]
        if unsure is not None:
            may |= unsure
        if own is not None:
            may.reshape(-1)[own] = False
        q, r = np.divmod(np.flatnonzero(may), len(ids))
        exact = np.empty(q.size)
        for start in range(0, q.size, EXACT_PAIRS):
            piece = slice(start, start + EXACT_PAIRS)
            exact[piece] = self._distance(numbers[q[piece]], rows[r[piece]], norms[r[piece]])
        key = np.round(exact, TIE_DECIMALS)
        enter = key <= np.where(full, limit, np.inf)[q]
        self._merge(numbers[q[enter]], ids[r[enter]], key[enter], exact[enter])

    def _distance(self, q, rows, norms) -> np.ndarray:
        queries = self.queries[q]
        if self.metric == "cosine":
            return 1.0 - np.einsum("ij,ij->i", queries, rows) / (self.norms[q] * norms)
        gap = queries - rows
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def _offer_undefined(self, numbers, ids, undefined_ids, skip_own_id) -> None:
        """Rows without a distance come last, in id order, while there is room for them."""
        lacking = numbers[(self.count[numbers] < self.k) | np.isinf(self.bound[numbers])]
        lacking = lacking[np.isinf(self.ceiling[lacking])]
        for number in lacking:
            offered = undefined_ids if self.defined[number] else ids
            if skip_own_id is not None:
                offered = offered[offered != skip_own_id[number]]
            if not offered.size:
                continue
            first = np.sort(offered)[: self.k]
            last = np.full(first.size, np.inf)
            self._merge(np.full(first.size, number), first, last, last)

    def _merge(self, q, ids, key, exact) -> None:
        """Work the offered rows into the lists of the queries they are for."""
        if not q.size:
            return
        heads = np.unique(q)
        held = np.arange(self.k) < self.count[heads][:, None]
        q = np.concatenate([np.repeat(heads, self.count[heads]), q])
        ids = np.concatenate([self.ids[heads][held], ids])
        key = np.concatenate([self.keys[heads][held], key])
        exact = np.concatenate([self.exact[heads][held], exact])
        order = np.lexsort((ids, key, q))
        q, ids, key, exact = q[order], ids[order], key[order], exact[order]
        _, first, sizes = np.unique(q, return_index=True, return_counts=True)
        rank = np.arange(len(q)) - np.repeat(first, sizes)
        top = rank < self.k
        place = (q[top], rank[top])
        self.ids[place], self.keys[place], self.exact[place] = ids[top], key[top], exact[top]
        self.count[heads] = np.minimum(sizes, self.k)
        self.bound[heads] = key[first + self.count[heads] - 1]

    def result(self, number_of: np.ndarray | None = None) -> pa.RecordBatch:
        held = np.arange(self.k) < self.count[:, None]
        q = np.repeat(np.arange(len(self.queries)), self.count)
        q = q if number_of is None else number_of[q]
        exact = self.exact[held]
        return pa.RecordBatch.from_arrays(
            [pa.array(q), pa.array(self.ids[held]), pa.array(exact, mask=np.isinf(exact))],
            schema=_PARTIAL_TYPES,
        )


def _merge(partial: DataFrame, k: int, salts: int) -> DataFrame:
    """Global top-k per query from the tasks' partial lists.

    With few queries there are few groups and each holds the lists of all
    tasks, so those are first reduced in ``salts`` parts.
    """
    key = F.round("distance", TIE_DECIMALS).asc_nulls_last()
    if salts > 1:
        salted = Window.partitionBy("_q", "_salt").orderBy(key, "id")
        partial = (
            partial.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
            .withColumn("rn", F.row_number().over(salted))
            .filter(F.col("rn") <= k)
            .drop("_salt", "rn")
        )
    ranked = Window.partitionBy("_q").orderBy(key, "id")
    return partial.withColumn("rn", F.row_number().over(ranked)).filter(F.col("rn") <= k)


def _salts(spark: SparkSession, queries: int) -> int:
    parallelism = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, parallelism // max(1, queries))


def _need(k: int):
    return F.lit(8) * F.coalesce(F.size("_v"), F.lit(0)).cast("long") + F.lit(LIST_BYTES * k)


def _bounded_queries(queries: DataFrame, k: int, limit_bytes: int) -> tuple[pa.Table | None, DataFrame]:
    """The query set itself if it is within the bound, else None; and the set as a DataFrame.

    It is checkpointed before it is measured, so that an encoder behind it runs
    once. What is fetched never exceeds the bound.
    """
    ensure_checkpoint_dir(queries.sparkSession)
    queries = queries.checkpoint()
    held = queries.agg(F.sum(_need(k))).head()[0] or 0
    return (queries.toArrow() if held <= limit_bytes else None), queries


def _query_matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    vectors = table["_v"].combine_chunks()
    lengths = [n for n in vectors.value_lengths().to_pylist() if n is not None]
    return as_matrix(vectors, lengths[0] if lengths else 1)


def batch_topk(
    store: DataFrame,
    queries: DataFrame,
    *,
    top_k: int = 5,
    metric: str = "cosine",
    exclude_same_id: bool = False,
    id_col: str = "id",
    vector_col: str = "embedding",
    qid_col: str = "qid",
    query_vector_col: str = "embedding",
    keep: tuple[str, ...] = (),
    probes: dict | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    checkpoint_store: bool = False,
) -> DataFrame:
    """The ``top_k`` nearest store rows of every query: ``qid, rn, id, distance``.

    Queries beyond ``broadcast_bytes`` or ``BLOCK_BYTES`` are searched at once, in jobs of a few
    blocks of ``BLOCK_BYTES``, each of which reads the store's ids and vectors; ``checkpoint_store``
    writes these down before, for a store that is not files but is computed by an encoder.

    ``keep`` names further store columns to add. The search itself moves ids and
    distances only; the columns are fetched afterwards for the rows that won, by
    a broadcast of the winners where their number is within the bound.

    Ids are integers. Rank is by distance (last-bit noise removed), then id;
    undefined distances rank last and are NULL. ``exclude_same_id`` leaves out
    the row whose id equals the query's. ``probes`` restricts each query to
    some cells, see :mod:`sparkvec.operators.cells`.
    """
    check_top_k(top_k)
    check_metric(metric)
    spark = store.sparkSession
    asked = queries.select(
        F.col(qid_col).cast("long").alias("_q"), F.col(query_vector_col).alias("_v")
    )
    columns = [F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("_v")]
    if probes is not None:
        columns.append(F.col("cell").cast("int").alias("cell"))
    rows = store.select(*columns)
    table, asked = _bounded_queries(asked, top_k, min(broadcast_bytes, BLOCK_BYTES))
    if table is not None:
        merged = _broadcast_topk(spark, rows, table, top_k, metric, exclude_same_id, probes)
    else:
        if checkpoint_store:
            rows = rows.checkpoint()
        merged = _blocked_topk(spark, rows, asked, top_k, metric, exclude_same_id, probes, BLOCK_BYTES)
    found = merged.select(F.col("_q").alias(qid_col), "rn", "id", "distance")
    if not keep:
        return found
    if table is not None and table.num_rows * top_k * WINNER_BYTES <= broadcast_bytes:
        found = F.broadcast(found)
    fetched = store.select(F.col(id_col).cast("long").alias("id"), *keep)
    return fetched.join(found, "id").select(qid_col, "rn", "id", *keep, "distance")


def _offer_batch(running: RunningTopK, batch, own_ids, probe_lists) -> None:
    if batch.num_rows == 0 or len(running.queries) == 0:
        return
    ids = np.asarray(batch.column("id"))
    matrix, valid = as_matrix(batch.column("_v"), running.queries.shape[1])
    if probe_lists is None:
        running.add(ids, matrix, valid, skip_own_id=own_ids)
        return
    cells = np.asarray(batch.column("cell"))
    for cell in np.unique(cells):
        only = np.flatnonzero((probe_lists == cell).any(axis=1))
        if only.size:
            inside = cells == cell
            running.add(ids[inside], matrix[inside], valid[inside], only, own_ids)


def _partial_topk(spark, rows, table, k, metric, exclude_same_id, probes, ceiling=None) -> DataFrame:
    """Each task's best rows for a query set within the broadcast bound."""
    numbers = np.asarray(table["_q"].combine_chunks())
    matrix, valid = _query_matrix(table)
    probe_lists = None
    if probes is not None:
        probe_lists = probes["nearest"](matrix)
        wanted = np.unique(probe_lists[probe_lists >= 0])
        if wanted.size < probes["cells"]:
            # A literal list over the partition column: other cells are not read.
            rows = rows.filter(F.col("cell").isin([int(c) for c in wanted]))
    shared = spark.sparkContext.broadcast((numbers, matrix, valid, probe_lists, ceiling))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_numbers, q_matrix, q_valid, q_probes, q_ceiling = shared.value
        running = RunningTopK(q_matrix, q_valid, k, metric, q_ceiling)
        for batch in batches:
            _offer_batch(running, batch, q_numbers if exclude_same_id else None, q_probes)
        yield running.result(q_numbers)

    return rows.mapInArrow(search, _PARTIAL)


def _broadcast_topk(spark, rows, table, k, metric, exclude_same_id, probes) -> DataFrame:
    partial = _partial_topk(spark, rows, table, k, metric, exclude_same_id, probes)
    return _merge(partial, k, _salts(spark, table.num_rows))


def _ceiling(sample: pa.Table, table: pa.Table, k: int, metric: str, exclude_same_id: bool) -> np.ndarray:
    """The rank key of each query's k-th best row of the sample; infinite where it has fewer."""
    matrix, valid = _query_matrix(table)
    running = RunningTopK(matrix, valid, k, metric)
    own = np.asarray(table["_q"].combine_chunks()) if exclude_same_id else None
    for batch in sample.to_batches():
        _offer_batch(running, batch, own, None)
    return np.where(running.count >= k, running.bound, np.inf)


def _blocked_topk(
    spark, rows, asked, k, metric, exclude_same_id, probes, block_bytes
) -> DataFrame:
    """Exact top-k for a query set of any size: blocks of at most about ``block_bytes`` are broadcast in turn.

    The store is scanned once per block and never shuffled; only the tasks' short
    lists are. Results are written to the shared folder job by job, so that the
    driver and the tasks hold a few blocks at a time.
    """
    sizes = asked.agg(F.count(F.lit(1)), F.max(_need(k))).head()
    blocks = max(1, math.ceil(1.25 * sizes[0] * (sizes[1] or 1) / block_bytes))
    # Rows of the sample weigh no more than a block, however long the vectors are.
    fits = max(1, min(BOUND_ROWS, block_bytes // max(1, sizes[1] - LIST_BYTES * k)))
    sample = rows.limit(fits).toArrow() if probes is None else None
    path = f"{shared_dir(spark)}/sparkvec_knn/{uuid.uuid4().hex}"
    block = F.pmod(F.xxhash64("_q", "_v"), F.lit(blocks))
    # written by block, so that each is read alone
    asked.withColumn("block", block).write.partitionBy("block").parquet(f"{path}/queries")
    placed = spark.read.parquet(f"{path}/queries")
    per_job = min(max(BROADCAST_BYTES // block_bytes, BLOCKS_PER_JOB[0]), BLOCKS_PER_JOB[1])
    for first in range(0, blocks, per_job):
        held = placed.filter(F.col("block").between(first, first + per_job - 1)).toArrow()
        parts = []
        for number in range(first, min(first + per_job, blocks)):
            table = held.filter(pc.equal(held["block"], number)).select(["_q", "_v"])
            if not table.num_rows:
                continue
            ceiling = _ceiling(sample, table, k, metric, exclude_same_id) if sample is not None else None
            parts.append(_partial_topk(spark, rows, table, k, metric, exclude_same_id, probes, ceiling))
        if not parts:
            continue
        together = parts[0]
        for part in parts[1:]:
            together = together.union(part)
        _merge(together, k, 1).write.mode("append").parquet(f"{path}/found")
    return spark.read.parquet(f"{path}/found")
