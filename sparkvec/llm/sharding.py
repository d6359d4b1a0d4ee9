"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A document descends region, rack and shard; at each level every child draws an
exponential number of its weight from a hash of (level, child, key), and the
least draw wins. Where a child's weight changes, keys move into or out of that
child alone: other subtrees keep what they have, and within them nothing moves.

``tree(n)`` decides everything by the number of shards. Its first eight shards stand
in two regions of two racks of two; each further one is a region of its own,
since only then does a new shard take rows only into itself. With fewer than eight,
the others are closed: keys that would fall to them draw again among the open ones, so
that a shard that opens takes rows only into itself, too. Law: ``key``.

Defined results: all rows with a null key are one key, and go to one shard;
equal keys go together; repeated rows get a slot each; null and empty texts have
size 1 and checksum 0; an empty table gives no rows; ``place`` keeps all columns
and replaces one called ``shard``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkvec.llm.common import before

SHARDS = 8
BUCKET_ROWS = 512


@dataclass(frozen=True)
class Tree:
    """Regions of racks of (shard, weight). The keys of ``closed`` shards, and no others, are dealt to the open ones by weight."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]
    closed: frozenset[int] = frozenset()

    def __post_init__(self) -> None:
        shards = [s for region in self.regions for rack in region for s, _ in rack]
        weights = [w for region in self.regions for rack in region for _, w in rack]
        if not shards or len(set(shards)) != len(shards) or min(weights) <= 0:
            raise ValueError("a tree needs distinct shards of positive weight")
        if not all(rack for region in self.regions for rack in region) or not all(self.regions):
            raise ValueError("regions and racks must not be empty")
        if not self.closed < set(shards):
            raise ValueError("closed shards must be shards of the tree, and one must stay open")

    def grown(self, shard: int, weight: float = 1.0) -> Tree:
        """With one more shard, as a region of its own."""
        return Tree((*self.regions, (((shard, weight),),)), self.closed)


def tree(shards: int, base: int = SHARDS) -> Tree:
    """The tree of shards 0 to ``shards - 1``; the first ``base`` in racks of two and regions of two racks, closed from ``shards`` on."""
    if shards < 1:
        raise ValueError("a tree needs a shard")
    racks = [tuple((s, 1.0) for s in range(at, min(at + 2, base))) for at in range(0, base, 2)]
    grown = Tree(tuple(tuple(racks[at : at + 2]) for at in range(0, len(racks), 2)), frozenset(range(shards, base)))
    for shard in range(base, shards):
        grown = grown.grown(shard)
    return grown


def _draw(level: str, children: Column, key: Column) -> Column:
    def drawn(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), child["id"], key), 11)
        uniform = (bits.cast("double") + 0.5) / float(1 << 53)
        return F.struct((-F.ln(uniform) / child["weight"]).alias("draw"), child["id"].alias("id"))

    return F.array_min(F.transform(children, drawn))["id"]


def _children(weights: list[tuple[int, float]]) -> Column:
    return F.array(*(F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("weight")) for i, w in weights))


def shard_of(key: Column, topology: Tree) -> Column:
    """The shard of a key. Regions and racks are named by their first shard, so that adding others renames none."""
    regions, racks, shards = [], [], []
    region_no, rack_no = {}, {}
    for region in topology.regions:
        name = region[0][0][0]
        region_no[name] = len(regions)
        regions.append((name, sum(w for rack in region for _, w in rack)))
        racks.append(_children([(rack[0][0], sum(w for _, w in rack)) for rack in region]))
        for rack in region:
            rack_no[rack[0][0]] = len(shards)
            shards.append(_children(list(rack)))

    def at(number: dict[int, int], name: Column) -> Column:
        return F.element_at(F.create_map(*(F.lit(x) for pair in number.items() for x in pair)), name) + 1

    in_region = F.element_at(F.array(*racks), at(region_no, _draw("region", _children(regions), key)))
    in_rack = F.element_at(F.array(*shards), at(rack_no, _draw("rack", in_region, key)))
    drawn = _draw("shard", in_rack, key)
    if not topology.closed:
        return drawn
    leaves = [leaf for region in topology.regions for rack in region for leaf in rack if leaf[0] not in topology.closed]
    return F.when(drawn.isin(*topology.closed), _draw("open", _children(leaves), key)).otherwise(drawn)


def place(docs: DataFrame, topology: Tree, key: str = "doc_id") -> DataFrame:
    """The documents with their ``shard``; no shuffle."""
    return docs.withColumn("shard", shard_of(F.col(f"`{key}`"), topology))


def slotted(rows: DataFrame, by: list[str]) -> DataFrame:
    """Add ``slot``, gapless from 0 within each ``shard``, to rows that ``by`` identifies.

    Rows are bucketed by hash, numbered within a bucket, and shifted by the
    number of rows in the buckets before; equal rows are counted first.
    """
    rows = rows.groupBy("shard", *by).agg(F.count("*").alias("n"))
    buckets = max(64, -(-rows.count() // BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)))
    sums = before(rows.groupBy("shard", "bucket").agg(F.sum("n").alias("total")), ["shard"], "bucket", "total")
    inside = Window.partitionBy("shard", "bucket").orderBy(*(F.col(c).asc_nulls_last() for c in by))
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    rows = rows.join(sums.drop("total"), ["shard", "bucket"])
    nth = F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("nth")
    rows = rows.select("shard", *by, "before", "inside", nth)
    return rows.select("shard", *by, (F.col("before") + F.col("inside") + F.col("nth")).alias("slot"))


def assignment(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: size, checksum, shard, slot, and the shard with one more shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(F.col("doc_id"), tree(shards)).alias("shard"),
    )
    placed = slotted(rows, ["doc_id", "size", "text_crc32"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        shard_of(F.col("doc_id"), tree(shards + 1)).alias("grown_shard"),
    )
