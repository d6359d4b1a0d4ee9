"""Approximate nearest neighbours over shifted space-filling curves.

Each of ``CURVES`` curves projects the vectors to ``DIMS`` random directions,
shifts them, and orders them along a Hilbert curve. Spark range-partitions the
keys of all curves together; a query is compared with the rows whose place on a
curve is within ``SHARE / 2`` of all rows from its own, chunk by chunk, in double
precision, and the best of all curves are merged.

The share, not a fixed number, keeps recall the same at every size. It suits
vectors without structure, where any index must look at much of the data (recall
over 0.9 on the given tables); clustered vectors do with far less. Projections are scaled by a
sample of ``SAMPLE_ROWS`` vectors (those of least hash); every vector is indexed.

Inner products of vectors of unequal length are searched by the usual lift: a
stored vector gets a further coordinate, sqrt(largest norm^2 - norm^2), a query 0.

Equal vectors are one point with its ``top + 1`` smallest ids, which is all that a
result can need of them, so copies of a vector cost one comparison. Queries with
equal vectors are answered together.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do null ids, nor vectors whose length is not the
most frequent one; a query's own id is never its neighbour, whatever rows carry
it; repeated rows count once; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkvec.llm.common import before, saved

CURVES = 10
DIMS = 8
BITS = 4
SHARE = 0.15
CHUNK = 2048
#: Chunks of queries that are answered together.
QUERY_CHUNKS = 64
SAMPLE_ROWS = 4096
SEED = 5


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of integer points (rows of ``cells``) along a Hilbert curve, as unsigned numbers.

    Gray-code walk from the highest bit down: at each level the axes are swapped
    or mirrored so that the curve within a cell joins its neighbours'.
    """
    axes = cells.T.astype(np.uint64)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for i in range(len(axes)):
            mirrored = (axes[i] & bit) != 0
            swap = np.where(mirrored, np.uint64(0), (axes[0] ^ axes[i]) & low)
            axes[0] ^= np.where(mirrored, low, swap)
            axes[i] ^= swap
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(axes.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        turn ^= np.where((axes[-1] & bit) != 0, bit - one, np.uint64(0))
    axes ^= turn
    place = np.zeros(axes.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            place = (place << one) | ((axis >> np.uint64(level)) & one)
    return place


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _usable(vector: Column) -> Column:
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~broken & F.exists(vector, lambda x: x != 0)


def points(vectors: DataFrame, top: int, every: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Distinct vectors: ``point`` (least id), ``vector``, ``members`` (the least ids), ``asked`` (holds a query)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & _usable(F.col("vector"))).distinct()
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("vector") == F.lit(sizes.d if sizes else 0))
    asked = rows.groupBy("vector").agg(F.min("id").alias("point"), F.max((F.col("id") % every == 0).cast("int")).alias("asked"))
    order = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    # Spark keeps the first top + 1 of each vector in every task before it shuffles
    first = rows.withColumn("rank", order).where(F.col("rank") <= top + 1)
    members = first.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("members"))
    return asked.join(members, "vector")


def search(
    vectors: DataFrame, top: int = 20, every: int = 20, share: float = SHARE, curves: int = CURVES, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``top`` nearest found of each row whose id ``every`` divides: query_id, rank, vec_id, score."""
    base = saved(points(vectors, top, every, id_col, vector_col))
    sample = base.orderBy(F.xxhash64("point"), "point").limit(SAMPLE_ROWS).select("vector").toArrow()
    data = _matrix(sample["vector"].combine_chunks()) if sample.num_rows else np.zeros((1, 1))
    squared = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest = base.agg(F.max(squared)).first()[0] or 0.0
    width = data.shape[1] + 1
    rng = np.random.default_rng(SEED)
    lifted = np.hstack([data, np.sqrt(np.maximum(longest - (data**2).sum(1), 0))[:, None]])
    turns = [np.linalg.qr(rng.normal(size=(width, width)))[0][:, : min(DIMS, width)] for _ in range(curves)]
    shifts = [rng.uniform(0, 1, t.shape[1]) for t in turns]
    middles = [(lifted @ t).mean(0) for t in turns]
    spreads = [np.maximum((lifted @ t).std(0), 1e-12) for t in turns]

    def place(values: np.ndarray, c: int) -> np.ndarray:
        unit = ((values @ turns[c] - middles[c]) / spreads[c] + 3) / 6 * (1 << BITS) + shifts[c] - 0.5
        cells = np.clip(np.floor(unit), 0, (1 << BITS) - 1).astype(np.int64)
        return hilbert(cells, BITS).astype(np.int64)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values, asked = _matrix(batch["vector"]), batch["asked"].to_numpy()
            lift = np.sqrt(np.maximum(longest - (values**2).sum(1), 0))[:, None]
            for query, mine, last in ((0, np.arange(len(values)), lift), (1, np.flatnonzero(asked), np.zeros_like(lift))):
                for c in range(curves):
                    key = place(np.hstack([values, last])[mine], c)
                    yield pa.record_batch(
                        [
                            pa.array(np.full(len(mine), c, np.int32)),
                            pa.array(key),
                            pa.array(np.full(len(mine), query, np.int32)),
                            batch["point"].take(pa.array(mine)),
                            batch["vector"].take(pa.array(mine)).cast(pa.list_(pa.float64())),
                        ],
                        names=["curve", "key", "query", "point", "vector"],
                    )

    rows = base.select("point", "vector", "asked").mapInArrow(keys, "curve int, key long, query int, point long, vector array<double>")
    ordered = rows.repartitionByRange("curve", "key", "point", "query").sortWithinPartitions("curve", "key", "point", "query")
    # the checkpoint fixes partitions and places in them
    ordered = saved(ordered.withColumn("at", F.monotonically_increasing_id()))
    ordered = ordered.withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND((1 << 33) - 1)})
    parts = before(ordered.groupBy("part").agg(F.count("*").alias("total")), [], "part", "total").drop("total")
    total = max(1, ordered.count() // curves)
    chunk = F.floor((F.col("before") + F.col("at") - F.col("curve") * total) / CHUNK)
    ordered = ordered.join(F.broadcast(parts), "part").withColumn("chunk", chunk)  # a row for each partition
    reach = -(-int(share * total / 2) // CHUNK)
    last = (total - 1) // CHUNK
    near = F.explode(F.sequence(F.greatest(F.col("chunk") - reach, F.lit(0)), F.least(F.col("chunk") + reach, F.lit(last))))
    group = F.floor(F.col("chunk") / QUERY_CHUNKS)
    asks = ordered.where("query = 1").withColumn("group", group).withColumn("chunk", near)
    first, final = (F.floor(F.greatest(F.lit(0), F.col("chunk") - reach) / QUERY_CHUNKS), F.floor(F.least(F.lit(last), F.col("chunk") + reach) / QUERY_CHUNKS))
    stored = ordered.where("query = 0").withColumn("group", F.explode(F.sequence(first, final)))
    columns = ["curve", "chunk", "group", "query", "point", "vector"]
    tiles = stored.select(columns).unionByName(asks.select(columns)).repartition("curve", "chunk", "group")
    tiles = tiles.sortWithinPartitions("curve", "chunk", "group", "query", "point")

    def best(queries: np.ndarray, asking: np.ndarray, ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        scores = asking @ values.T
        count = min(top + 1, len(ids))
        least = np.partition(scores, len(ids) - count, axis=1)[:, len(ids) - count]
        found = []
        for i in range(len(queries)):
            at = np.flatnonzero(scores[i] >= least[i])
            found.append(at[np.argsort(-scores[i][at], kind="stable")][:count])  # ids ascend: ties to the smaller
        at = np.concatenate(found)
        of = np.repeat(np.arange(len(queries)), [len(f) for f in found])
        return pa.record_batch([pa.array(queries[of]), pa.array(ids[at]), pa.array(scores[of, at])], names=["query", "point", "score"])

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            asking = rows["query"].to_numpy() == 1
            ids, values = rows["point"].to_numpy(), _matrix(rows["vector"].combine_chunks())
            if asking.any() and not asking.all():
                lines = np.flatnonzero(asking)
                for at in range(0, len(lines), 1024):
                    some = lines[at : at + 1024]
                    yield best(ids[some], values[some], ids[~asking], values[~asking])

        held, name = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([batch[c].to_numpy() for c in ("curve", "chunk", "group")], 1)
            cuts = np.flatnonzero((np.diff(names, axis=0) != 0).any(1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(names)]):
                if held and tuple(names[low]) != name:
                    yield from answer(held)
                    held = []
                held.append(batch.slice(int(low), int(high - low)))
                name = tuple(names[low])
        if held:
            yield from answer(held)

    found = tiles.mapInArrow(rerank, "query long, point long, score double").groupBy("query", "point").agg(F.max("score").alias("score"))
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top + 1).drop("rank")
    members = base.select("point", F.explode("members").alias("vec_id"))
    found = found.join(members, "point").withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")))
    lists = found.where(F.col("rank") <= top + 1).groupBy("query")
    lists = lists.agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    rows = vectors.select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).alias("vector"))
    asking = rows.where((F.col("query_id") % every == 0) & _usable(F.col("vector"))).distinct()
    asking = asking.join(base.select("vector", F.col("point").alias("query")), "vector").join(lists, "query")
    own = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    answers = asking.select("query_id", F.explode(F.slice(own, 1, top)).alias("x")).groupBy("query_id", F.col("x.vec_id").alias("vec_id"))
    answers = answers.agg(F.max("x.score").alias("score"))
    final = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", final).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
