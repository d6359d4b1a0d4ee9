"""Quality classifier: learned vectors of hashed words and character n-grams, averaged, softmax.

A document is the mean of the vectors of its words, word pairs and byte 3-grams
and 5-grams, each looked up by hash; a softmax over two outputs reads that mean. The
vectors and the outputs are trained together by stochastic gradient descent in
numpy, on at most ``SAMPLE_ROWS`` labelled rows (those of least hash), in one task. Scoring reads whole texts: the product of vectors and
outputs is one number per bucket, so a text needs one look-up per feature.

Defined results: null and empty texts score what the model says of no features;
repeated rows score alike; equal labels of an id count once, and of rows that share
an id the one of least md5 is learned from (nulls first); rows with a null id or
label are never learned from; with no learnable row, or one class
only, every score is the share of label 1 (0.5 without labels); only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkvec.llm.common import SPACE, id_remainder, pieces, utf8

SAMPLE_ROWS = 4000
BITS = 17
DIM = 8
EPOCHS = 8
RATE = 2.0
SEED = 7
_ODD = np.uint32(2654435769)
_POWERS = np.cumprod(np.full(64, 16777619, np.uint32), dtype=np.uint32)


def _ngrams(block: np.ndarray, ends: np.ndarray, order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at each byte, and whether it lies within its row."""
    wide = block.astype(np.uint32)
    code = np.zeros(len(block), np.uint32)
    for at in range(order):
        code *= np.uint32(257 + 2 * order)
        code[: max(len(block) - at, 0)] += wide[at:]
    code = (code * _ODD) >> np.uint32(32 - bits)
    inside = np.ones(len(block), bool)
    for back in range(1, order):
        spots = ends - back
        inside[spots[spots >= 0]] = False
    return code, inside


def _words(block: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and position of each word that white space or the edge of a row delimits."""
    first = ~SPACE[block]
    gap = SPACE[block]
    head = first.copy()
    head[1:] &= gap[:-1]
    inner = starts[starts < len(block)]
    head[inner] = first[inner]
    at = np.flatnonzero(head)
    if not len(at):
        return np.zeros(0, np.uint32), at
    place = np.zeros(len(block), np.int64)
    place[at[0] :] = np.arange(at[0], len(block)) - np.repeat(at, np.diff(np.append(at, len(block))))
    value = (block.astype(np.uint32) + np.uint32(1)) * _POWERS[place & 63]
    value[gap] = 0
    return np.add.reduceat(value, at, dtype=np.uint32), at


def _features(block: np.ndarray, bounds: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, byte position) of each feature of rows that lie side by side in ``block``."""
    starts, ends = bounds[:-1], bounds[1:]
    filled = ends > starts
    starts, ends = starts[filled], ends[filled]
    words, at = _words(block, starts)
    yield (words * _ODD) >> np.uint32(32 - bits), at
    # word pairs are hashed by the difference of their words: all repetitions share a bucket
    pair = np.flatnonzero(np.searchsorted(starts, at[1:], "right") == np.searchsorted(starts, at[:-1], "right"))
    yield ((words[pair + 1] - words[pair]) * _ODD) >> np.uint32(32 - bits), at[pair]
    for order in (3, 5):
        code, inside = _ngrams(block, ends, order, bits)
        at = np.flatnonzero(inside)
        yield code[at], at


def text_sums(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Per row: the sum of the weights of its features, and their number."""
    rows = len(offsets) - 1
    sums, counts = np.zeros(rows), np.zeros(rows)
    for low, high, cut in pieces(data, offsets):
        block, bounds = data[cut[0] : cut[-1]], cut - cut[0]
        for code, at in _features(block, bounds, bits):
            total = np.concatenate([[0.0], np.cumsum(weights[code], dtype=np.float64)])
            edge = np.searchsorted(at, bounds)
            sums[low:high] += total[edge[1:]] - total[edge[:-1]]
            counts[low:high] += np.diff(edge)
    return sums, counts


def bag(text: bytes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text, and their shares."""
    data = np.frombuffer(text, np.uint8)
    total = np.zeros(1 << bits)
    for _, _, cut in pieces(data, np.array([0, len(data)])):
        for code, _ in _features(data[cut[0] : cut[-1]], cut - cut[0], bits):
            total += np.bincount(code, minlength=1 << bits)
    found = np.flatnonzero(total)
    return found, total[found] / max(total.sum(), 1.0)


@dataclass
class Model:
    """One weight per bucket, and the bias: the log odds of label 1 are their mean plus the bias."""

    weights: np.ndarray
    bias: float
    bits: int = BITS

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        sums, counts = text_sums(data, offsets, self.weights, self.bits)
        odds = np.clip(sums / np.maximum(counts, 1) + self.bias, -50, 50)
        return 1 / (1 + np.exp(-odds))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BITS) -> Model:
    """Stochastic gradient descent on vectors and outputs together, rate falling to zero."""
    flat = np.zeros(1 << bits, np.float32)
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return Model(flat, float(np.log((share + 1e-9) / (1 - share + 1e-9))), bits)
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << bits, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    step, steps = 0, EPOCHS * len(bags)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            rate = RATE * (1 - step / steps)
            step += 1
            found, part = bags[i]
            part = part.astype(np.float32)
            mean = part @ vectors[found] if len(found) else np.zeros(DIM, np.float32)
            logits = mean @ out + bias
            prob = np.exp(logits - logits.max())
            error = prob / prob.sum()
            error[int(labels[i])] -= 1
            back = out @ error
            out -= rate * np.outer(mean, error)
            bias -= np.float32(0.05) * rate * error
            # shares are small, so that a bucket's step is scaled by the text's peak share
            if len(found):
                vectors[found] -= rate * np.outer(part / part.max(), back) * np.float32(0.1)
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]), bits)


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 3) == 1


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn ``quality`` from the labelled rows that are not held out."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    usable = usable.select("doc_id", "quality").distinct()
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows)
    # at most sample_rows ids and labels: a proven bound
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # an id may stand in very many rows: Spark keeps the first of each in every task before it shuffles
    first = Window.partitionBy("doc_id", "quality").orderBy(F.md5("text"))
    rows = rows.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bag((t.as_py() or "").encode()) for t in batch["text"]]
            yield pa.record_batch(
                [
                    batch["doc_id"].cast(pa.int64()),
                    batch["quality"].cast(pa.int32()),
                    pa.array([f.astype(np.int32) for f, _ in found], pa.list_(pa.int32())),
                    pa.array([s.astype(np.float32) for _, s in found], pa.list_(pa.float32())),
                ],
                names=["doc_id", "quality", "found", "share"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, pairs = [], [], []
        for batch in batches:
            ids += batch["doc_id"].to_pylist()
            labels += batch["quality"].to_pylist()
            found, share = batch["found"], batch["share"]
            pairs += [(found[i].values.to_numpy(), share[i].values.to_numpy()) for i in range(len(found))]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], labels[i]))
        model = train([pairs[i] for i in order], np.array([labels[i] for i in order]))
        yield pa.record_batch([pa.array([model.weights.tobytes()]), pa.array([model.bias])], names=["weights", "bias"])

    sample = rows.mapInArrow(bags, "doc_id long, quality int, found array<int>, share array<float>")
    # the bounded sample goes to one task, and the driver sees the model only
    fitted = sample.repartition(1).mapInArrow(learn, "weights binary, bias double").first()
    if fitted is None:
        return train([], np.zeros(0))
    return Model(np.frombuffer(bytes(fitted.weights), np.float32), fitted.bias)


def score(text: Column, model: Model, spark) -> Column:
    """The probability of label 1, of whole texts."""
    shared = spark.sparkContext.broadcast(model)  # 2 ** BITS numbers, whatever the input

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(shared.value.scores(*utf8(batch)))

    return F.arrow_udf(run, "double").asNondeterministic()(text)


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    model = fit(docs, labels, sample_rows)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model, docs.sparkSession).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents, unchanged, that the classifier does not reject."""
    model = fit(docs, labels, sample_rows)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, score(F.col("text"), model, docs.sparkSession).alias("score"))
    return rows.where("score >= 0.5").select("row.*")
