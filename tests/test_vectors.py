"""Vector columns against hand-computed values and numpy."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from sparkvec.functions import vectors as vc

# Five vectors of 384 numbers: [0.1, 0.2, 0.3, 0.4] + 0.1 * row, repeated 96 times.
ROWS = [[0.1 + 0.1 * i, 0.2 + 0.1 * i, 0.3 + 0.1 * i, 0.4 + 0.1 * i] * 96 for i in range(5)]
COSINE = [0.0, 0.006192, 0.015626, 0.0241, 0.031136]
EUCLIDEAN = [0.0, 1.959592, 3.919184, 5.878775, 7.838367]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(ROWS)), "id long, embedding array<float>")


@pytest.mark.parametrize("metric,want", [("cosine", COSINE), ("Euclidean", EUCLIDEAN)])
def test_known_distances(rows, metric, want):
    target = [float(np.float32(x)) for x in ROWS[0]]
    literal = F.array(*[F.lit(x) for x in target])
    got = rows.select(
        "id",
        vc.distance_to(F.col("embedding"), target, metric).alias("kernel"),
        vc.distance(F.col("embedding"), literal, metric).alias("columns"),
    ).orderBy("id")
    for row, value in zip(got.collect(), want):
        assert row["kernel"] == pytest.approx(value, abs=2e-6)
        assert row["columns"] == pytest.approx(value, abs=2e-6)


def test_undefined_distances_are_null(spark):
    df = spark.createDataFrame(
        [(0, [0.0, 0.0]), (1, None), (2, [1.0, 1.0])], "id long, embedding array<float>"
    )
    got = {
        r.id: (r.c, r.e, r.p)
        for r in df.select(
            "id",
            vc.distance_to(F.col("embedding"), [1.0, 1.0]).alias("c"),
            vc.distance_to(F.col("embedding"), [1.0, 1.0], "euclidean").alias("e"),
            vc.cosine_distance(F.col("embedding"), F.array(F.lit(1.0), F.lit(1.0))).alias("p"),
        ).collect()
    }
    assert got[0][0] is None and got[0][1] == pytest.approx(2**0.5) and got[0][2] is None
    assert got[1] == (None, None, None)
    assert got[2][0] == pytest.approx(0.0) and got[2][1] == pytest.approx(0.0)


def test_text_form(spark):
    df = spark.createDataFrame([("[1,2.5,-3]",), ("oops",), ("[]",)], "t string")
    got = [r.v for r in df.select(vc.vector_from_text(F.col("t")).alias("v")).collect()]
    assert got == [[1.0, 2.5, -3.0], None, []]
    back = df.select(vc.vector_to_text(vc.vector_from_text(F.col("t"))).alias("t")).collect()
    assert [r.t for r in back] == ["[1.0,2.5,-3.0]", None, "[]"]


def test_norm_and_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    got = df.select(
        vc.vector_norm(F.col("v")).alias("n"), vc.l2_normalize(F.col("v")).alias("u")
    ).collect()
    assert [r.n for r in got] == [5.0, 0.0]
    assert got[0].u == pytest.approx([0.6, 0.8]) and got[1].u == [0.0, 0.0]


def test_metric_names():
    assert vc.check_metric("COSINE") == "cosine"
    with pytest.raises(ValueError):
        vc.check_metric("dot")


@settings(max_examples=60, deadline=None)
@given(
    hs.lists(
        hs.lists(hs.floats(-100, 100, width=32), min_size=4, max_size=4), min_size=2, max_size=6
    ),
    hs.sampled_from(vc.METRICS),
)
def test_matrix_kernel_properties(rows, metric):
    matrix = np.array(rows)
    valid = np.ones(len(rows), dtype=bool)
    d = vc.distance_matrix(matrix, matrix, valid, metric)
    # Cosine similarity of tiny vectors underflows; the property is about ordinary ones.
    norms = np.linalg.norm(matrix, axis=1)
    ordinary = (norms > 1e-3) if metric == "cosine" else np.ones(len(rows), dtype=bool)
    d = d[np.ix_(ordinary, ordinary)]
    assert np.allclose(d, d.T, atol=1e-6)
    assert np.allclose(np.diag(d), 0.0, atol=1e-6)
    assert (d >= -1e-9).all()
