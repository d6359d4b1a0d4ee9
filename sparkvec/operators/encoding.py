"""Batch encoding of text to vectors with a caller-supplied encoder.

An *encoder factory* is a picklable callable without arguments. It returns an
object with ``dimension`` and ``encode(texts, batch_size)``; the latter gives a
two-dimensional array with one row per text. The factory runs once per Python
worker, so an expensive model is loaded once and not once per batch or task.
"""

import hashlib
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvec.functions import text as tx
from sparkvec.operators.checks import check_dimensions, check_query_text

BATCH_SIZE = 32
#: Texts of an Arrow batch that are Python strings at a time.
HELD_TEXTS = 256
EncoderFactory = Callable[[], Any]

_built: dict[str, Any] = {}


def factory_key(factory: Callable[[], Any]) -> str:
    """Identity of a factory, computed on the driver and shipped with the UDF."""
    return hashlib.sha1(cloudpickle.dumps(factory)).hexdigest()


def build_once(key: str, factory: Callable[[], Any]) -> Any:
    """The factory's product, kept for the life of this Python process."""
    if key not in _built:
        _built[key] = factory()
    return _built[key]


class _Slots(dict):
    """word -> 2 * bucket + (1 if its sign is negative), filled in on demand."""

    LIMIT = 1 << 17

    def __init__(self, dimension: int):
        super().__init__()
        self.dimension = dimension

    def __missing__(self, word: str) -> int:
        digest = hashlib.md5(word.encode("utf-8", "surrogatepass")).digest()
        slot = 2 * (int.from_bytes(digest[:4], "big") % self.dimension) + (digest[4] >= 0x80)
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = slot
        return slot


class HashEncoder:
    """Offline stand-in for a model: signed hashing of words into a unit vector.

    Word -> md5; its first four bytes modulo ``dimension`` choose the bucket,
    the top bit of the fifth the sign. Deterministic, so jobs can be tested
    without a model; :func:`hash_weights` is the same definition in SQL.
    """

    def __init__(self, dimension: int = 64):
        self.dimension = check_dimensions(dimension)
        self._slot_of = _Slots(dimension).__getitem__

    def encode(self, texts: list[str], batch_size: int = BATCH_SIZE) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension))
        for row, text in enumerate(texts):
            slots = np.fromiter(map(self._slot_of, text.lower().split()), dtype=np.int64)
            counts = np.bincount(slots, minlength=2 * self.dimension)
            out[row] = counts[0::2] - counts[1::2]
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norms, out=out, where=norms > 0)


class HashEncoderFactory:
    def __init__(self, dimension: int = 64):
        self.dimension = check_dimensions(dimension)

    def __call__(self) -> HashEncoder:
        return HashEncoder(self.dimension)


def _as_arrow(matrix: np.ndarray, rows: int) -> pa.Array:
    matrix = np.ascontiguousarray(matrix, dtype=np.float32)
    if matrix.ndim != 2 or matrix.shape[0] != rows:
        raise ValueError(f"the encoder returned shape {matrix.shape} for {rows} texts")
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def _encoded(encoder: Any, batch: pa.Array, batch_size: int) -> pa.Array:
    """The vectors of a batch, a few of its texts at a time."""
    step = max(batch_size, HELD_TEXTS - HELD_TEXTS % batch_size)
    parts = []
    for start in range(0, len(batch), step):
        texts = batch.slice(start, step).to_pylist()
        parts.append(_as_arrow(encoder.encode(texts, batch_size), len(texts)))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))


def encode_text(
    text: Column, encoder_factory: EncoderFactory, batch_size: int = BATCH_SIZE
) -> Column:
    """Encode a text column to ``array<float>``.

    The encoder sees sanitized text, with a placeholder where nothing is left;
    sanitizing runs in the JVM, and only that one column goes to Python.
    """

    key = factory_key(encoder_factory)

    @F.arrow_udf("array<float>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = build_once(key, encoder_factory)
        for batch in batches:
            yield _encoded(encoder, batch, batch_size)

    # Declared nondeterministic only so that Catalyst neither repeats the call
    # nor moves it when a later filter or projection mentions the vector.
    return encode.asNondeterministic()(tx.encoder_input(text))


def try_encode_text(
    text: Column, encoder_factory: EncoderFactory, batch_size: int = BATCH_SIZE
) -> Column:
    """Encode to ``struct<vector, error>``: a text the encoder refuses has an error, the others go on."""

    key = factory_key(encoder_factory)

    @F.arrow_udf("vector array<float>, error string")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = build_once(key, encoder_factory)

        def one(text: str) -> tuple[list[float] | None, str | None]:
            try:
                return np.asarray(encoder.encode([text], 1), dtype=np.float32)[0].tolist(), None
            except Exception as error:  # noqa: BLE001
                return None, f"{type(error).__name__}: {error}"

        for batch in batches:
            texts = batch.to_pylist()
            try:
                vectors = _as_arrow(encoder.encode(texts, batch_size), len(texts)) if texts else pa.array([], pa.list_(pa.float32()))
                errors = pa.nulls(len(texts), pa.string())
            except Exception:  # noqa: BLE001 - the texts are tried one by one to find the refused ones
                made = [one(text) for text in texts]
                vectors = pa.array([vector for vector, _ in made], pa.list_(pa.float32()))
                errors = pa.array([error for _, error in made], pa.string())
            yield pa.StructArray.from_arrays([vectors, errors], ["vector", "error"])

    return encode.asNondeterministic()(tx.encoder_input(text))


def encode_documents(
    df: DataFrame,
    encoder_factory: EncoderFactory,
    *,
    text_col: str = "document_text",
    output: str = "embedding",
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    return df.withColumn(output, encode_text(F.col(text_col), encoder_factory, batch_size))


def encode_query(text: str, encoder_factory: EncoderFactory) -> list[float]:
    """Encode one query text on the driver. Blank text is an error."""
    check_query_text(text)
    clean = " ".join(text.replace("\x00", "").split())
    check_query_text(clean)
    encoder = build_once(factory_key(encoder_factory), encoder_factory)
    vector = np.asarray(encoder.encode([clean], 1), dtype=np.float32)[0]
    return vector.astype(np.float64).tolist()


def embedding_dimension(df: DataFrame, vector_col: str = "embedding") -> int | None:
    """Length of the stored vectors, read from one row; NULL vectors are skipped."""
    row = df.filter(F.col(vector_col).isNotNull()).select(F.size(vector_col)).head()
    return row[0] if row else None


def hash_weights(
    docs: DataFrame, *, dimension: int = 64, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The hash encoding in sparse form: one row per document and non-zero bucket.

    Signed counts are summed map-side right after the explode, so the shuffle
    carries at most ``dimension`` rows per document, not one per word.
    """
    check_dimensions(dimension)
    digest = F.md5(F.col("word").cast("binary"))
    bucket = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(dimension))
    sign = F.when(F.substring(digest, 9, 1) < "8", F.lit(1)).otherwise(F.lit(-1))
    summed = (
        docs.select(F.col(id_col), F.explode(tx.words(tx.encoder_input(F.col(text_col)))).alias("word"))
        .select(id_col, bucket.cast("int").alias("bucket"), sign.alias("sign"))
        .groupBy(id_col, "bucket")
        .agg(F.sum("sign").alias("count"))
        .filter(F.col("count") != 0)
    )
    # At most `dimension` rows per document: a bounded group.
    per_document = summed.groupBy(id_col).agg(
        F.collect_list(F.struct("bucket", "count")).alias("slots"),
        F.sqrt(F.sum(F.col("count") * F.col("count"))).alias("norm"),
    )
    return per_document.select(id_col, "norm", F.inline("slots")).select(
        id_col, "bucket", (F.col("count") / F.col("norm")).alias("weight")
    )
