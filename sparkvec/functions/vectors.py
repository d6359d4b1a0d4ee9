"""Vector columns: parsing, printing, arithmetic and distances.

Vectors are ``array<float>``. Arithmetic is done in double. A distance that is
not defined (zero vector under cosine, null vector, different lengths) is NULL
and sorts last.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "euclidean")

# Distances that agree to this many decimals count as tied, and the smaller id
# wins. Kernels that sum in different orders differ in the last bits, so an
# order on the raw double would depend on the kernel.
TIE_DECIMALS = 9


def check_metric(metric: str) -> str:
    name = str(metric).lower()
    if name not in METRICS:
        raise ValueError(f"unsupported distance metric {metric!r}; use one of {METRICS}")
    return name


def vector_from_text(text: Column) -> Column:
    """``'[1,2,3]'`` to ``array<float>``; malformed text gives NULL."""
    return F.from_json(text, "array<float>", {"mode": "PERMISSIVE"})


def vector_to_text(vector: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(vector, ","), F.lit("]"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def dot_product(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def vector_norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.try_divide(dot_product(a, b), vector_norm(a) * vector_norm(b))


def euclidean_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(
        a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))
    )
    return F.sqrt(_sum(squares))


def distance(a: Column, b: Column, metric: str = "cosine") -> Column:
    """Distance of two vector columns, entirely inside the JVM."""
    return {"cosine": cosine_distance, "euclidean": euclidean_distance}[check_metric(metric)](a, b)


def l2_normalize(a: Column) -> Column:
    """Unit-length copy as ``array<float>``; a zero vector stays as it is."""
    norm = vector_norm(a)
    return F.transform(
        a, lambda x: F.coalesce(F.try_divide(x.cast("double"), norm), F.lit(0.0)).cast("float")
    )


def rank_key(distance_column: str | Column) -> Column:
    """What top-k orders by: the distance with last-bit noise removed, NULLs last."""
    column = F.col(distance_column) if isinstance(distance_column, str) else distance_column
    return F.round(column, TIE_DECIMALS).asc_nulls_last()


# --- Arrow kernels: one matrix product per batch instead of one lambda call per element


def as_matrix(vectors: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Arrow list array as an (n, dimensions) double matrix and a validity mask."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    valid = ~np.asarray(vectors.is_null())
    lengths = np.asarray(vectors.value_lengths().fill_null(dimensions))
    wrong = np.flatnonzero(lengths != dimensions)
    if wrong.size:
        raise ValueError(
            f"vector of {int(lengths[wrong[0]])} elements where {dimensions} were expected"
        )
    flat = vectors.flatten()  # skips null lists, honours slices
    present = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
    if valid.all():
        matrix = present
    else:
        matrix = np.zeros((len(vectors), dimensions))
        matrix[valid] = present
    broken = ~np.isfinite(matrix).all(axis=1)
    if broken.any():
        valid = valid & ~broken
        matrix[broken] = 0.0
    return matrix, valid


def distance_matrix(
    queries: np.ndarray, rows: np.ndarray, row_valid: np.ndarray, metric: str
) -> np.ndarray:
    """(queries x rows) distances; undefined ones are +inf so that they rank last."""
    products = queries @ rows.T
    row_sq = np.einsum("ij,ij->i", rows, rows)
    query_sq = np.einsum("ij,ij->i", queries, queries)
    if metric == "cosine":
        scale = np.sqrt(query_sq)[:, None] * np.sqrt(row_sq)[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            out = 1.0 - products / scale
        out[scale == 0.0] = np.inf
    else:
        squared = query_sq[:, None] + row_sq[None, :] - 2.0 * products
        # The expansion cancels badly for near neighbours; redo those by subtraction.
        close_q, close_r = np.nonzero(squared < 1e-3 * (query_sq[:, None] + row_sq[None, :]))
        for start in range(0, close_q.size, 65536):
            qi, ri = close_q[start : start + 65536], close_r[start : start + 65536]
            gap = queries[qi] - rows[ri]
            squared[qi, ri] = np.einsum("ij,ij->i", gap, gap)
        out = np.sqrt(np.maximum(squared, 0.0))
    out[:, ~row_valid] = np.inf
    return out


def distance_to(vector: Column, query: list[float], metric: str = "cosine") -> Column:
    """Distance of a vector column to one fixed vector.

    Runs as an Arrow UDF: on wide vectors a matrix product per batch is several
    times faster than the element-wise lambdas of :func:`distance`.
    """
    name = check_metric(metric)
    target = np.asarray(query, dtype=np.float64).reshape(1, -1)
    if not np.isfinite(target).all():
        raise ValueError("the query vector has elements that are not finite")

    @F.arrow_udf("double")
    def kernel(batch: pa.Array) -> pa.Array:
        rows, valid = as_matrix(batch, target.shape[1])
        values = distance_matrix(target, rows, valid, name)[0]
        return pa.array(values, mask=np.isinf(values))

    # Declared nondeterministic only so that a filter on the distance is not
    # pushed below its projection, which would compute it twice.
    return kernel.asNondeterministic()(vector)
