"""Many-query top-k against a brute-force ranking, on every execution path."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkvec.operators import cells, knn
from sparkvec.operators.encoding import HashEncoder, HashEncoderFactory, encode_text
from sparkvec.operators.knn import RunningTopK, batch_topk

ROWS, QUERIES, DIM = 700, 23, 12


def _data():
    rng = np.random.default_rng(5)
    rows = rng.standard_normal((ROWS, DIM)).astype(np.float32)
    rows[100:330] = rows[7]  # a third of the store is copies of one vector
    rows[400] = 0.0
    queries = rng.standard_normal((QUERIES, DIM)).astype(np.float32)
    queries[3] = rows[7]
    return rows, queries


def brute(rows, queries, k, metric, own=False):
    rows, queries = rows.astype(np.float64), queries.astype(np.float64)
    out = {}
    for q, query in enumerate(queries):
        found = []
        for i, row in enumerate(rows):
            if own and i == q:
                continue
            if metric == "cosine":
                scale = np.linalg.norm(row) * np.linalg.norm(query)
                d = 1 - float(row @ query) / scale if scale else np.inf
            else:
                d = float(np.linalg.norm(row - query))
            found.append((round(d, 9), i))
        out[q] = [i for _, i in sorted(found)[:k]]
    return out


def collect(df):
    out = {}
    for row in df.orderBy("qid", "rn").collect():
        out.setdefault(row.qid, []).append(row.id)
    return out


@pytest.fixture(scope="module")
def frames(spark):
    rows, queries = _data()
    store = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id long, embedding array<float>"
    ).repartition(5)
    asked = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(queries)],
        "qid long, embedding array<float>",
    )
    return rows, queries, store, asked


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("k", [1, 10, 1000])
def test_broadcast_path_is_exact(frames, metric, k):
    rows, queries, store, asked = frames
    got = collect(batch_topk(store, asked, top_k=k, metric=metric))
    assert got == brute(rows, queries, k, metric)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("bound", [300, 1200])
def test_blocked_path_is_exact(frames, metric, bound):
    rows, queries, store, asked = frames
    got = collect(batch_topk(store, asked, top_k=10, metric=metric, broadcast_bytes=bound))
    assert got == brute(rows, queries, 10, metric)


def test_small_batches_and_self_exclusion(spark, frames):
    rows, _, store, _ = frames
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        asked = store.filter("id < 40").select(F.col("id").alias("qid"), "embedding")
        for bound in (1 << 20, 900):
            got = collect(
                batch_topk(store, asked, top_k=6, exclude_same_id=True, broadcast_bytes=bound)
            )
            assert got == brute(rows, rows[:40], 6, "cosine", own=True)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_prefix_of_larger_k(frames):
    _, _, store, asked = frames
    small = collect(batch_topk(store, asked, top_k=5))
    large = collect(batch_topk(store, asked, top_k=6))
    assert all(large[q][:5] == small[q] for q in small)


def _local(rows, queries, k, metric, batch, own=None):
    """The task-side accumulator alone, fed in batches."""
    running = RunningTopK(
        queries.astype(np.float64), np.ones(len(queries), dtype=bool), k, metric
    )
    for start in range(0, len(rows), batch):
        part = rows[start : start + batch].astype(np.float64)
        ids = np.arange(start, start + len(part))
        running.add(ids, part, np.ones(len(part), dtype=bool), skip_own_id=own)
    got = {q: [] for q in range(len(queries))}
    table = running.result()
    for q, i, _ in zip(*(table.column(c).to_pylist() for c in range(3))):
        got[q].append(i)
    return got


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("scale,shift", [(1.0, 0.0), (1e-3, 0.0), (1.0, 50.0), (300.0, 1e4)])
def test_screening_loses_nothing(metric, scale, shift):
    """Also where single precision cannot tell the rows apart."""
    rng = np.random.default_rng(11)
    rows = (rng.standard_normal((400, 8)) * scale + shift).astype(np.float32)
    rows[50:180] = rows[3]
    queries = np.vstack([rows[:12], rng.standard_normal((6, 8)).astype(np.float32)])
    for k, batch in [(1, 64), (7, 31), (60, 400)]:
        assert _local(rows, queries, k, metric, batch) == brute(rows, queries, k, metric)
    own = np.arange(len(queries))
    got = _local(rows, queries, 7, metric, 31, own)
    assert got == brute(rows, queries, 7, metric, own=True)


def test_undefined_rows_come_last():
    rows, queries = np.zeros((9, 3), np.float32), np.ones((2, 3), np.float32)
    rows[4], rows[7] = [1, 0, 0], [1, 1, 1]
    queries[1] = 0
    for batch in (1, 4, 9):
        got = _local(rows, queries, 4, "cosine", batch)
        assert got == {0: [7, 4, 0, 1], 1: [0, 1, 2, 3]}


def test_more_queries_than_fit_in_one_look(spark):
    rng = np.random.default_rng(3)
    rows = rng.standard_normal((90, 4)).astype(np.float32)
    queries = rng.standard_normal((1300, 4)).astype(np.float32)

    def frame(matrix, name):
        data = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
        return spark.createDataFrame(data, f"{name} long, embedding array<float>")

    want = brute(rows, queries, 2, "cosine")
    for bound in (1 << 20, 20_000):
        got = collect(
            batch_topk(frame(rows, "id"), frame(queries, "qid"), top_k=2, broadcast_bytes=bound)
        )
        assert got == want


def test_wrong_dimension_is_an_error(spark, frames):
    _, _, store, _ = frames
    bad = spark.createDataFrame([(1, [1.0, 2.0])], "qid long, embedding array<float>")
    with pytest.raises(Exception, match="elements where"):
        batch_topk(store, bad, top_k=3).collect()


def test_no_queries(spark, frames):
    _, _, store, _ = frames
    none = spark.createDataFrame([], "qid long, embedding array<float>")
    assert batch_topk(store, none, top_k=3).collect() == []


class CountingFactory(HashEncoderFactory):
    """Leaves a line in a file for every text it encodes."""

    def __init__(self, dimension, path):
        super().__init__(dimension)
        self.path = path

    def __call__(self):
        return Counting(self.dimension, self.path)


class Counting(HashEncoder):
    def __init__(self, dimension, path):
        super().__init__(dimension)
        self.path = path

    def encode(self, texts, batch_size=32):
        with open(self.path, "a") as out:
            out.writelines("x\n" for _ in texts)
        return super().encode(texts, batch_size)


@pytest.mark.parametrize("queries, bound", [(50, 1 << 20), (50, 2000), (1100, 1 << 20), (1100, 30_000)])
def test_an_encoder_runs_once_and_the_store_stays(spark, frames, tmp_path, queries, bound):
    _, _, store, _ = frames
    log = tmp_path / "calls"
    texts = spark.range(queries).select(F.col("id").alias("qid"), F.concat(F.lit("question "), "id").alias("q"))
    asked = texts.select("qid", encode_text(F.col("q"), CountingFactory(DIM, str(log))).alias("embedding"))
    found = batch_topk(store, asked, top_k=3, broadcast_bytes=bound)
    assert found.groupBy("qid").count().filter("count = 3").count() == queries
    assert len(log.read_text().splitlines()) == queries


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_a_ceiling_changes_no_result(metric):
    rng = np.random.default_rng(2)
    rows, queries = rng.standard_normal((300, 5)), rng.standard_normal((9, 5))
    rows[20:60] = rows[3]
    valid = np.ones(9, bool)
    whole = RunningTopK(queries, valid, 7, metric)
    whole.add(np.arange(300), rows, np.ones(300, bool))
    some = RunningTopK(queries, valid, 7, metric)
    some.add(np.arange(0, 300, 5), rows[::5], np.ones(60, bool))
    limited = RunningTopK(queries, valid, 7, metric, some.bound)
    offered = 0
    for start in range(0, 300, 30):
        part = RunningTopK(queries, valid, 7, metric, some.bound)
        part.add(np.arange(start, start + 30), rows[start : start + 30], np.ones(30, bool))
        offered += int(part.count.sum())
        limited.add(np.arange(start, start + 30), rows[start : start + 30], np.ones(30, bool))
    assert (limited.ids == whole.ids).all() and np.allclose(limited.exact, whole.exact)
    assert offered < 10 * 9 * 7 / 2  # tasks return less than k rows a query


def test_cells_are_read_until_there_are_k_rows(spark, frames):
    rows, queries, store, asked = frames
    index = cells.given_cells(store, cells=150)
    placed = cells.assign_cells(store, index)
    for bound in (1 << 20, 900):
        found = cells.approximate_topk(placed, asked, index, probes=1, top_k=25, broadcast_bytes=bound)
        assert {r["count"] for r in found.groupBy("qid").count().collect()} == {25}
    every = cells.approximate_topk(placed, asked, index, probes=1, top_k=1000)
    assert collect(every) == brute(rows, queries, 1000, "cosine")


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("block", [300, 1200])
def test_blocks_of_queries_are_exact(frames, metric, block, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_BYTES", block)
    rows, queries, store, asked = frames
    got = collect(batch_topk(store, asked, top_k=10, metric=metric))
    assert got == brute(rows, queries, 10, metric)


def test_the_store_is_read_once_per_block_that_a_task_can_hold(frames, monkeypatch):
    """However small the bound of what is broadcast at once."""
    _, _, store, asked = frames
    scans = []
    partial = knn._partial_topk
    monkeypatch.setattr(knn, "_partial_topk", lambda *a, **b: scans.append(1) or partial(*a, **b))
    assert batch_topk(store, asked, top_k=10, broadcast_bytes=300).count() == 10 * QUERIES
    assert len(scans) == 1


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_memory_beside_the_queries_is_bounded(metric):
    rng = np.random.default_rng(8)
    queries, rows = rng.standard_normal((4000, 64)), rng.standard_normal((10_000, 64))
    running = RunningTopK(queries, np.ones(4000, bool), 10, metric)
    tracemalloc.start()
    running.add(np.arange(10_000), rows, np.ones(10_000, bool), skip_own_id=np.arange(4000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_a_list_that_is_not_full_yet_bounds_nothing(metric):
    """Few rows of a batch may be under the ceiling; those of later batches that are farther still count."""
    rows, _ = _data()
    rows = rows.astype(np.float64)
    valid, own = np.ones(40, bool), np.arange(40)

    def searched(low, high, ceiling):
        running = RunningTopK(rows[:40], valid, 6, metric, ceiling)
        for start in range(low, high, 37):
            part = rows[start : min(start + 37, high)]
            running.add(np.arange(start, start + len(part)), part, np.ones(len(part), bool), skip_own_id=own)
        return running

    ceiling = searched(0, ROWS, None).bound
    tasks = [searched(low, low + 140, ceiling) for low in range(0, ROWS, 140)]
    want = brute(rows, rows[:40], 6, metric, own=True)
    for q in range(40):
        found = sorted((t.keys[q, i], t.ids[q, i]) for t in tasks for i in range(t.count[q]))
        assert [number for _, number in found[:6]] == want[q]


def test_cells_of_a_store_are_computed_once_for_all_blocks(spark, monkeypatch):
    """Blocks of queries read the cells that were written down; they computed them once per block before."""
    monkeypatch.setattr(knn, "BLOCK_BYTES", 4 << 10)
    rng = np.random.default_rng(12)
    rows = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(200)]
    store = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(2)
    index = cells.CellIndex(np.eye(8)[:4], "cosine")
    computed = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def cell(vector):
        computed.add(1)
        return int(np.argmax(vector[:4]))

    placed = store.withColumn("cell", cell.asNondeterministic()("embedding"))
    queries = store.withColumnRenamed("id", "qid")
    found = cells.approximate_topk(placed, queries, index, probes=4, top_k=3, checkpoint_store=True)
    exact = knn.batch_topk(store, queries, top_k=3)
    pairs = [sorted((r.qid, r.rn, r.id) for r in x.collect()) for x in (found, exact)]
    assert pairs[0] == pairs[1] and len(pairs[0]) == 600
    assert computed.value == 2 * 200  # counted by cell, and written down
