"""Vector code compression: product codes whose nearest codebook entries are found by a GNAT.

A vector of integers is cut into equal consecutive parts, and a part is replaced by
the index of its nearest entry in the codebook of its position. Codebooks are refined
by rounds of assigning and averaging, all in integers, so that every run and every
partitioning gives the same codes.

The search over a codebook is a geometric near-neighbour access tree (GNAT): a node
holds a few entries as split points, deals the others to their nearest split point,
and stores for each split point and each child the range of distances between them.
Once the distance of a query to a split point is known, a child whose range lies
outside that distance by more than the best distance so far is left out whole. All
queries of a batch walk the tree together. A child is left out only if it is strictly
farther: bounds of distances are rounded outwards, and what is left is compared by
exact integer squares, ties to the lower index.

A round is one pass over the vectors: each task returns one row of sums per part and
entry, which Spark adds up; the codebooks (a fixed number of entries) are all that
comes to the driver or is broadcast.

Defined results: vectors that are null or hold null or non-finite components take no
part, nor do vectors whose length is not the most frequent one (of equally frequent
ones the smallest); a length that the parts do not divide is filled up with zeros. A
component of 2^27 / scale or more raises an error, as squares would not fit 64 bits.
Codebooks start from the smallest ids, null ids after all others, and of rows that
share an id from the least vector; with fewer ids there are fewer entries. Repeated
rows each get their code. Null labels are one label. Without vectors the result is
empty. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvec.llm.common import checked, saved

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Split points of a node.
DEGREE = 4
LIMIT_BITS = 27


# --- the tree over one codebook ------------------------------------------------


def _square(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows."""
    gap = points - centre
    return np.einsum("ij,ij->i", gap, gap)


def _low(square: np.ndarray) -> np.ndarray:
    """A number not above the root of ``square``. Integers from 2^53 are rounded on their way to a float, too."""
    return np.maximum(np.nextafter(np.sqrt(np.nextafter(square.astype(np.float64), -np.inf).clip(0)), -np.inf), 0)


def _high(square: np.ndarray) -> np.ndarray:
    """A number not below the root of ``square``."""
    return np.nextafter(np.sqrt(np.nextafter(square.astype(np.float64), np.inf)), np.inf)


@dataclass
class Node:
    """Split points (indexes of entries), the range of distances of each to each child's entries, and the children."""

    splits: list[int]
    near: np.ndarray
    far: np.ndarray
    children: list[Node | None] = field(default_factory=list)


def build(entries: np.ndarray, members: list[int] | None = None, degree: int = DEGREE) -> Node | None:
    """The tree over ``members`` of the entries. Split points lie far apart: each is the farthest from those before."""
    members = list(range(len(entries))) if members is None else members
    if not members:
        return None
    points = entries[members]
    splits = [0]
    gaps = [_square(points, points[0])]
    while len(splits) < min(degree, len(members)):
        closest = np.min(gaps, axis=0)
        closest[splits] = -1
        splits.append(int(closest.argmax()))
        gaps.append(_square(points, points[splits[-1]]))
    squares = np.stack(gaps)
    owner = squares.argmin(axis=0)
    owner[splits] = np.arange(len(splits))
    near, far = np.zeros((len(splits), len(splits))), np.zeros((len(splits), len(splits)))
    children: list[Node | None] = []
    for child in range(len(splits)):
        own = np.flatnonzero(owner == child)
        near[:, child] = _low(squares[:, own].min(axis=1))
        far[:, child] = _high(squares[:, own].max(axis=1))
        children.append(build(entries, [members[i] for i in own if i != splits[child]], degree))
    return Node([members[i] for i in splits], near, far, children)


def nearest(tree: Node | None, entries: np.ndarray, queries: np.ndarray, counter: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each query (ties: the lower index) and the squared distance.

    ``counter[0]`` grows by the number of distances computed.
    """
    best = np.full(len(queries), np.iinfo(np.int64).max, np.int64)
    index = np.full(len(queries), -1, np.int64)
    if tree is not None:
        _walk(tree, entries, queries, np.arange(len(queries)), best, index, counter)
    return index, best


def _walk(node: Node, entries: np.ndarray, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray, counter: list[int] | None) -> None:
    alive = np.ones((len(node.splits), len(rows)), bool)
    low = np.zeros((len(node.splits), len(rows)))
    high = np.full((len(node.splits), len(rows)), np.inf)
    for at, entry in enumerate(node.splits):
        asked = np.flatnonzero(alive[at])
        if not len(asked):
            continue
        here = rows[asked]
        square = _square(queries[here], entries[entry])
        if counter is not None:
            counter[0] += len(asked)
        better = (square < best[here]) | ((square == best[here]) & (entry < index[here]))
        best[here[better]] = square[better]
        index[here[better]] = entry
        low[at, asked], high[at, asked] = _low(square), _high(square)
        alive[:, asked] &= _possible(node, at, low[at, asked], high[at, asked], best[here])
    for at, child in enumerate(node.children):
        if child is None:
            continue
        asked = np.flatnonzero(alive[at])
        # the best distances are smaller now than when the split points were looked at
        for other in range(len(node.splits)):
            asked = asked[_possible(node, other, low[other, asked], high[other, asked], best[rows[asked]])[at]]
        if len(asked):
            _walk(child, entries, queries, rows[asked], best, index, counter)


def _possible(node: Node, at: int, low: np.ndarray, high: np.ndarray, best: np.ndarray) -> np.ndarray:
    """(children x queries): whether a child may hold an entry not farther than the best, by its range around split ``at``."""
    radius = _high(best)
    too_far = np.nextafter(low - radius, -np.inf) > node.far[at][:, None]
    too_near = np.nextafter(high + radius, np.inf) < node.near[at][:, None]
    return ~(too_far | too_near)


# --- vectors in Spark ------------------------------------------------------------


def integer_vectors(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``label`` and ``vector``, the usable vectors as floors of ``scale`` times each component."""
    vector = F.col(f"`{vector_col}`")
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.where(vector.isNotNull() & ~broken)
    sizes = kept.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    length = sizes.d if sizes else 0
    limit = float(1 << LIMIT_BITS)
    error = F.raise_error(F.lit(f"a component of {limit / scale:g} or more")).cast("long")

    def component(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < limit, F.floor(scaled)).otherwise(error).cast("int")

    whole = F.transform(vector, component)
    short = -length % parts
    if short:
        whole = F.concat(whole, F.array_repeat(F.lit(0), short))
    label = F.col("label") if "label" in vectors.columns else F.lit(None)
    rows = kept.where(F.size(vector) == length)
    return rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.cast("string").alias("label"), whole.alias("vector"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), len(flat) // max(len(column), 1))


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """(parts x entries x width): the vectors of the smallest ids, null last, of each id the least vector."""
    # Spark keeps the first few of every task; an id that stands in many rows is aggregated before
    least = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    found = [r.vector for r in least.orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()]
    if not found:
        return np.zeros((parts, 0, 0), np.int64)
    return np.stack(np.split(np.array(found, np.int64), parts, axis=1))


def _assigned(vectors: np.ndarray, trees: list[Node | None], books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    width = books.shape[2]
    for part, (tree, book) in enumerate(zip(trees, books, strict=True)):
        own = np.ascontiguousarray(vectors[:, part * width : (part + 1) * width])
        yield part, own, *nearest(tree, book, own)


def refine(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, and every used entry to the floor of its parts' mean."""
    parts, entries, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build(book) for book in shared.value]
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            for part, own, index, _ in _assigned(_matrix(batch["vector"]), trees, shared.value):
                count[part] += np.bincount(index, minlength=entries)
                order = np.argsort(index, kind="stable")
                used, first = np.unique(index[order], return_index=True)
                total[part, used] += np.add.reduceat(own[order], first, axis=0)
        part, entry = np.nonzero(count)
        columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry])]
        columns += [pa.array(total[part, entry, i]) for i in range(width)]
        yield pa.record_batch(columns, names=["part", "entry", "n", *(f"c{i}" for i in range(width))])

    names = [f"c{i}" for i in range(width)]
    partial = rows.select("vector").mapInArrow(sums, "part int, entry int, n long, " + ", ".join(f"{c} long" for c in names))
    # one row per part and entry: as many as the codebooks have
    found = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names)).collect()
    fresh = books.copy()
    for row in found:
        fresh[row.part, row.entry] = [row[c] // row.n for c in names]
    return fresh


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks of integer vectors after ``rounds`` rounds, (parts x entries x width)."""
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if books.size else 0):
        books = refine(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id``, ``label``, ``codes`` (an index per part) and ``error`` (squared distances summed over the parts)."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build(book) for book in shared.value]
        for batch in batches:
            codes = np.zeros((batch.num_rows, len(trees)), np.int32)
            error = np.zeros(batch.num_rows, np.int64)
            # an empty vector has parts without numbers, all of them at the first entry
            if batch.num_rows and shared.value.size:
                for part, _, index, square in _assigned(_matrix(batch["vector"]), trees, shared.value):
                    codes[:, part] = index
                    error += square
            offsets = pa.array(np.arange(batch.num_rows + 1) * len(trees), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(codes.ravel(), pa.int32()))
            yield pa.record_batch([batch["vec_id"], batch["label"].cast(pa.string()), lists, pa.array(error)], names=["vec_id", "label", "codes", "error"])

    return rows.mapInArrow(coded, "vec_id long, label string, codes array<int>, error long")


def decode(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """The vectors that the codes stand for, as ``vector`` in the original scale beside the other columns."""
    table = F.array(*(F.array(*(F.array(*(F.lit(float(x) / scale) for x in entry)) for entry in book)) for book in books))
    parts = F.transform("codes", lambda code, at: F.element_at(F.element_at(table, (at + 1).cast("int")), code + 1))
    return codes.withColumn("vector", F.flatten(parts))


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """Codes of all usable vectors (see ``encode``) and their codebooks."""
    rows = saved(integer_vectors(vectors, scale, parts))
    books = train(rows, parts, entries, rounds)
    return encode(rows, books), books


def digest(vectors: DataFrame) -> DataFrame:
    """One row per usable vector: ``vec_id``, ``code`` in hex, ``error``, ``label_error`` and ``codebooks_sha256``."""
    codes, books = compress(vectors)
    codes = saved(codes)
    hexed = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    labels = checked(codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    rows = codes.join(labels, F.col("label").eqNullSafe(F.col("of")))
    return rows.select("vec_id", F.array_join(hexed, "").alias("code"), "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))


def _floor_mean(column: str) -> str:
    """SQL for the floor of a mean of integers; ``//`` alone would round towards zero."""
    total, n = f"sum({column})", "count(*)"
    return f"(({total} - (({total} % {n} + {n}) % {n})) // {n})::BIGINT"


def _oracle() -> str:
    """Brute force over all entries, for vectors of 64 components."""
    steps = []
    for at in range(ROUNDS + 1):
        steps.append(f"""
a{at} AS MATERIALIZED (
  SELECT vec_id, part, v, min(struct_pack(d := d, entry := entry)) AS hit FROM (
    SELECT p.vec_id, p.part, p.v, b.entry, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(p.v, b.c)])::BIGINT AS d
    FROM pieces p JOIN b{at} b USING (part)
  ) GROUP BY ALL
)""")
        if at < ROUNDS:
            means = ", ".join(_floor_mean(f"v[{i}]") for i in range(1, 9))
            steps.append(f"""
m{at} AS (SELECT part, hit.entry AS entry, [{means}] AS c FROM a{at} GROUP BY part, hit.entry),
b{at + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{at}.c, b{at}.c) AS c FROM b{at} LEFT JOIN m{at} USING (part, entry))""")
    return f"""
WITH whole AS MATERIALIZED (
  SELECT vec_id, label, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pieces AS MATERIALIZED (
  SELECT vec_id, part::INT AS part, v[8 * part + 1 : 8 * part + 8] AS v FROM whole, range({PARTS}) parts(part)
), seeds AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM whole ORDER BY vec_id LIMIT {ENTRIES}
), b0 AS MATERIALIZED (SELECT part, entry, v AS c FROM pieces JOIN seeds USING (vec_id)),{",".join(steps)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', hit.entry), '' ORDER BY part) AS code, sum(hit.d)::BIGINT AS error
  FROM a{ROUNDS} GROUP BY vec_id
), books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN whole USING (vec_id), books
"""


ORACLE = _oracle()
