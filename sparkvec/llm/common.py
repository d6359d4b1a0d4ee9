"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkvec.session import ensure_checkpoint_dir, shared_dir

PIECE_BYTES = 1 << 20
STRIDE = 1024
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does that for pure ASCII texts, and is much cheaper there."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the cluster's shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder. Spark removes the shuffles that made them as soon as they are written,
    so that these and what follows from them do not lie on disk at the same time."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/marks-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark removes the shuffles of an action as soon as it has ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checked(small: DataFrame) -> DataFrame:
    """A broadcast hint only where a count proves at most ``BROADCAST_ROWS`` short rows."""
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


def row_key() -> Column:
    """What tells documents apart: id and text."""
    doc_id, text = F.col("doc_id"), F.col("text")
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), text))


_NO_ID = 10**19


def place(doc_id: Column, number: Column) -> Column:
    """Where something stands in the corpus, as one ordered number that aggregates in place; null ids last."""
    whole = F.coalesce(doc_id.cast("decimal(20,0)"), F.lit(str(_NO_ID)).cast("decimal(20,0)"))
    return (whole * F.lit(1 << 32).cast("decimal(11,0)") + number.cast("decimal(11,0)")).cast("decimal(38,0)")


def place_id(at: Column) -> Column:
    """The document id of a place."""
    whole = F.floor(at / F.lit(1 << 32).cast("decimal(11,0)"))
    return F.when(whole < F.lit(str(_NO_ID)).cast("decimal(20,0)"), whole).cast("long")


def place_number(at: Column) -> Column:
    """The number within its document of a place."""
    return F.pmod(at, F.lit(1 << 32).cast("decimal(38,0)")).cast("int")


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(divisor)), F.lit(-1))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in one array, and the offsets of its rows. Null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def before(totals: DataFrame, by: list[str], bucket: str, total: str) -> DataFrame:
    """Add ``before``: the sum of ``total`` over the smaller buckets of the same ``by``.

    Runs of ``STRIDE`` buckets are summed first, so that the one window that spans
    all of them sees a row per run.
    """
    totals = totals.withColumn("run", F.floor(F.col(bucket) / STRIDE))
    runs = totals.groupBy(*by, "run").agg(F.sum(total).alias("whole"))
    earlier = Window.partitionBy(*by).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("runs_before", F.coalesce(F.sum("whole").over(earlier), F.lit(0))).drop("whole")
    inside = Window.partitionBy(*by, "run").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("inside", F.coalesce(F.sum(total).over(inside), F.lit(0)))
    totals = totals.join(runs, [*by, "run"])
    return totals.withColumn("before", F.col("runs_before") + F.col("inside")).drop("run", "runs_before", "inside")


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def pieces(data: np.ndarray, offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray]]:
    """Cut a batch into (first row, last row, offsets) of about ``limit`` bytes.

    Rows stay whole, but for rows above the limit: those stand alone and are cut
    at white space, at places that depend on the row only.
    """
    row, rows = 0, len(offsets) - 1
    while row < rows:
        if offsets[row + 1] - offsets[row] > limit:
            at, end = int(offsets[row]), int(offsets[row + 1])
            while at < end:
                cut = min(at + limit, end)
                if cut < end:
                    gaps = np.flatnonzero(SPACE[data[at + limit // 2 : cut]])
                    cut = at + limit // 2 + int(gaps[-1]) + 1 if len(gaps) else cut
                yield row, row + 1, np.array([at, cut])
                at = cut
            row += 1
            continue
        last = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        yield row, last, offsets[row : last + 1]
        row = last


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an undirected graph: (node, root), root the smallest node reached.

    Alternating large-star and small-star steps, each a shuffle or two; what a round
    leaves is written down, so that its shuffles go; the number of rounds is logarithmic. Nodes without an edge, and
    edges with a null end, are not listed. Nothing is collected but two numbers
    per round.
    """
    u, v = F.col("u"), F.col("v")
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(u != v).distinct()
    links = written(links)

    def state(df: DataFrame):
        with shuffles_removed(df.sparkSession):
            return df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()

    before = state(links)
    while before[0]:
        both = links.unionByName(links.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(v.alias("u"), F.col("m").alias("v")).where(u != v).union(least.select("u", F.col("m").alias("v")))
        links = written(small.distinct())
        after = state(links)
        if after == before:
            break
        before = after
    return links.select(u.alias("node"), v.alias("root")).union(links.select(v, v).distinct())
