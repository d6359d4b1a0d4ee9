"""SimHash near-dedup: fingerprints, exact linking within a bit distance, groups.

Linking compares tiles of fingerprints with exclusive-or and bit counts. A tile
holds fingerprints that agree outside two of their eight bytes: two fingerprints
at distance 2 or less differ in two bytes at most, so every link lies in a tile,
and a tile cannot hold more than 65,536 distinct values, however the data look.
Tiles are ordered by population count, and stretches that differ by more than
the radius are skipped. The work grows with the number of distinct fingerprints,
not with its square; copies of a text share one fingerprint and cost nothing.

Defined results: null and blank texts have fingerprint zero and are linked like
any other; repeated rows each give a row; null ids take part, and a group that
has no id at all has a null ``component_id``; an empty table gives no rows; only
``doc_id`` and ``text`` are looked at, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvec.llm.common import components, saved

SHINGLE = 3
RADIUS = 2
SEED = 42
_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_CHUNK = 1 << 16
#: The pairs of bytes in which the members of a tile may differ.
_FREE = list(combinations(range(8), RADIUS))
#: Groups up to this size are compared by shifted rows, larger ones by tiles.
_SMALL = 32
_TILE = 512


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as a signed 64-bit number."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    size = min(shingle, len(words))
    count, total = np.zeros(64, np.int64), len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _CHUNK):
        part = words[at : at + _CHUNK + size - 1]
        hashes = [digest(b" ".join(gram), SEED) for gram in zip(*(part[i:] for i in range(size)))]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > total, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The SimHash of a text column, as a long."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([simhash((t.as_py() or "").encode(), shingle) for t in batch], pa.int64())

    return F.arrow_udf(run, "long").asNondeterministic()(text)


def _spanning(group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that span the components of one tile: tiles of the frontier against the unreached."""
    pops = np.bitwise_count(group)
    order = np.argsort(pops, kind="stable")
    rest, pops = group[order], pops[order].astype(np.int16)
    while len(rest):
        root, todo = rest[0], [rest[:1]]
        rest, pops = rest[1:], pops[1:]
        while todo and len(rest):
            front = todo.pop()
            if len(front) > _TILE:
                todo.append(front[_TILE:])
                front = front[:_TILE]
            counts = np.bitwise_count(front).astype(np.int16)
            lo = np.searchsorted(pops, counts.min() - radius, "left")
            hi = np.searchsorted(pops, counts.max() + radius, "right")
            near = np.zeros(len(rest), bool)
            for at in range(lo, hi, _TILE * 8):
                tile = rest[at : min(at + _TILE * 8, hi)]
                near[at : at + len(tile)] = (np.bitwise_count(front[:, None] ^ tile[None, :]) <= radius).any(0)
            if near.any():
                found = rest[near]
                yield np.full(len(found), root), found
                todo.append(found)
                rest, pops = rest[~near], pops[~near]


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (free, fp) sorted by free bytes and by the other bytes: links within each group."""
    masks = np.array([~np.uint64(sum(0xFF << 8 * b for b in pair)) for pair in _FREE], np.uint64)

    def compare(free: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        keys = fps & masks[free]
        new = np.flatnonzero((np.diff(keys) != 0) | (np.diff(free) != 0)) + 1
        starts = np.concatenate([[0], new])
        sizes = np.diff(np.concatenate([starts, [len(fps)]]))
        left, right = [], []
        size_of, start_of = np.repeat(sizes, sizes), np.repeat(starts, sizes)
        small = np.flatnonzero((size_of > 1) & (size_of <= _SMALL))
        for step in range(1, int(size_of[small].max()) if len(small) else 0):
            a = small[small + step < start_of[small] + size_of[small]]
            a = a[np.bitwise_count(fps[a] ^ fps[a + step]) <= radius]
            left.append(fps[a])
            right.append(fps[a + step])
        for at, size in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL]):
            for a, b in _spanning(fps[at : at + size], radius):
                left.append(a)
                right.append(b)
        a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right))
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    held = (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    for batch in batches:
        free = np.concatenate([held[0], batch["free"].to_numpy(zero_copy_only=False).astype(np.int64)])
        fps = np.concatenate([held[1], batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(fps):
            continue
        same = (free == free[-1]) & ((fps & masks[free]) == (fps[-1] & masks[free[-1]]))
        cut = len(fps) - int(same[::-1].argmin() if not same.all() else len(same))
        if cut:
            yield compare(free[:cut], fps[:cut])
        held = (free[cut:], fps[cut:])
    if len(held[0]):
        yield compare(*held)


def link(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all distinct ``fp`` within ``radius`` bits, transitively complete."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"radius must be from 0 to {RADIUS}")
    masks = [~sum(0xFF << 8 * b for b in pair) for pair in _FREE]
    signed = [m if m >= -(1 << 63) else m + (1 << 64) for m in masks]
    tiles = F.array(*(F.struct(F.lit(i).alias("free"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)))
    rows = fingerprints.select("fp").distinct().select("fp", F.explode(tiles).alias("tile")).select("fp", "tile.*")
    rows = rows.repartition("free", "key").sortWithinPartitions("free", "key", "fp").select("free", "fp")
    return rows.mapInArrow(lambda batches: _links(batches, radius), "a long, b long")


def grouped(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Add ``root``, the same for linked fingerprints, to rows that have ``fp`` and a cut lineage."""
    roots = components(link(rows, radius), "a", "b").select(F.col("node").alias("fp"), "root")
    return rows.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (hex) and ``component_id`` (smallest id reachable)."""
    rows = saved(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")))
    groups = grouped(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), radius)
    ids = groups.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = groups.join(ids, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents with one of each group: that of the smallest id, null ids last."""
    doc_id, text = F.col("doc_id"), F.col("text")
    key = F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), text.isNull().cast("string"), text))
    rows = saved(docs.select("doc_id", key.alias("key"), fingerprint(text, shingle).alias("fp")))
    groups = grouped(rows.select("fp").distinct(), radius)
    first = F.min(F.struct(doc_id.isNull().alias("no_id"), "doc_id", "key")).alias("first")
    winners = rows.join(groups, "fp").groupBy("root").agg(first).select("first.key")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), key.alias("key"))
    return packed.join(winners, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
