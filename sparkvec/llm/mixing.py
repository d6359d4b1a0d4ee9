"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Each source's documents are shuffled by a hash of id and text, and pass up to
``PASSES`` times. A copy's virtual finish time is the words of its source up to
and with it, divided by the source's target. All copies are ranged by that time
and cut where the running total of words passes the budget: since every source
reaches its target at time 1, the cut falls there for all of them.

Running sums never put a source into one task: rows are bucketed by their hash
(or by their time), buckets are summed first, and only rows of one bucket are
ordered together. The number of buckets follows the number of rows.

Defined results: a null text has no words; documents without words are in the
table but nothing is taken of them; a null source is a source of its own, the
last; null ids count as any other; equal rows share the copies taken of them, in
an order that does not matter; a source without words has target 0; an empty
table gives no rows; other columns are kept by ``mix`` and ignored by ``shares``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkvec.llm.common import before, checked, saved

WEIGHTS = (5, 2, 1)
PASSES = 2
#: The budget as a fraction of all words.
BUDGET = (3, 2)
BUCKET_ROWS = 512
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per source of (source, source_size): its number ``source_no`` and its ``target``.

    The level at which all sources share the excess is found in one pass over the
    sources in the order in which they reach their limit.
    """
    everything = Window.partitionBy(F.lit(0))
    number = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn("source_no", number.cast("int"))
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("source_no") % len(weights)) + 1)
    rows = rows.withColumn("weight", weight.cast("long")).withColumn("limit", F.col("source_size") * PASSES)
    queue = everything.orderBy(F.col("limit") / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything).cast("double") * BUDGET[0] / BUDGET[1]
    rows = rows.withColumns(
        {
            "left": budget - F.coalesce(F.sum("limit").over(queue), F.lit(0)),
            "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(queue), F.lit(0)),
        }
    ).withColumn("level", F.col("left") / F.col("open"))
    below = F.col("limit") > F.col("level") * F.col("weight")
    # past the first source below its limit, the quotients only fall
    level = F.max(F.when(below, F.col("level"))).over(everything)
    target = F.when(level.isNull(), F.col("limit").cast("double")).otherwise(
        F.least(F.col("limit").cast("double"), level * F.col("weight"))
    )
    return rows.select("source", "source_no", "source_size", target.alias("target"))


def _buckets(rows: int) -> int:
    return max(64, -(-rows // BUCKET_ROWS))


def copies(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """How many copies are taken of each row of (id, source, size, key), with the source's figures.

    ``key`` is the hash that shuffles. Equal rows are counted first, so that many
    copies of one row cost one row until the end.
    """
    rows = rows.groupBy("id", "source", "size", "key").agg(F.count("*").alias("n"))
    rows = saved(rows)
    weighed = targets(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights)
    weighed = saved(weighed)
    # without a shuffle by source, of which one may hold a third of all rows
    rows = rows.join(checked(weighed.withColumnRenamed("source", "of")), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    buckets = _buckets(rows.count())
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("bucket", F.shiftright(place * buckets, 32))
    words = F.col("size") * F.col("n")
    sums = before(rows.groupBy("source_no", "bucket").agg(F.sum(words).alias("total")), ["source_no"], "bucket", "total")
    inside = Window.partitionBy("source_no", "bucket").orderBy("key", F.col("id").asc_nulls_last(), "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    rows = saved(rows.join(sums.drop("total"), ["source_no", "bucket"]).drop("bucket"))

    # each row of the table, each of its passes
    single = rows.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    kept = ["id", "source", "size", "key", "nth", "source_size", "target"]
    none = single.where("size = 0").select(*kept, F.lit(0).alias("copies"))
    ready = single.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1))))
    cumulated = F.col("before") + F.col("inside") + F.col("nth") * F.col("size") + F.col("pass") * F.col("source_size")
    ready = ready.withColumn("time", cumulated / F.col("target"))
    ready = ready.withColumn("slot", F.floor(F.col("time") / (F.col("time") + 1) * buckets * PASSES))
    slots = before(ready.groupBy("slot").agg(F.sum("size").alias("total")), [], "slot", "total")
    queue = Window.partitionBy("slot").orderBy("time", "source_no", "key", F.col("id").asc_nulls_last(), "nth")
    running = F.sum("size").over(queue.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ready = ready.drop("before", "inside").withColumn("running", running).join(slots.drop("total"), "slot")
    budget = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    fits = (F.col("before") + F.col("running")) * BUDGET[1] <= F.lit(budget * BUDGET[0])
    return ready.groupBy(*kept).agg(F.sum(fits.cast("int")).cast("int").alias("copies")).unionByName(none)


def _key() -> Column:
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.md5(F.concat(doc_id, F.lit("|"), F.coalesce(F.md5("text"), F.lit("-"))))


def shares(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words the mix takes of it."""
    rows = docs.select(F.col("doc_id").alias("id"), "source", n_words(F.col("text")).alias("size"), _key().alias("key"))
    return copies(rows, weights).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The documents, unchanged, as often as the mix takes them."""
    rows = docs.select(F.col("doc_id").alias("id"), "source", n_words(F.col("text")).alias("size"), _key().alias("key"))
    taken = copies(rows, weights).where("copies > 0")
    taken = taken.select(F.col("key").alias("t_key"), F.col("source").alias("t_source"), F.col("nth").alias("t_nth"), "copies")
    # equal rows may differ in other columns: which of them takes the nth share does not matter
    nth = F.row_number().over(Window.partitionBy("key", "source").orderBy(F.lit(0))).alias("nth")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "source", _key().alias("key"))
    packed = packed.select("row", "source", "key", nth)
    same = (F.col("key") == F.col("t_key")) & F.col("source").eqNullSafe(F.col("t_source")) & (F.col("nth") == F.col("t_nth"))
    chosen = packed.join(taken, same).select("row", F.explode(F.sequence(F.lit(1), "copies")))
    return chosen.select("row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(concat(coalesce(CAST(doc_id AS VARCHAR), '-'), '|', coalesce(md5(text), '-'))) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no
  FROM d GROUP BY source),
w AS (SELECT *, CASE no % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM s),
q AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 3 / 2
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w),
t AS (
  SELECT source, no, source_size,
    CASE WHEN max(CASE WHEN cap > level * weight THEN level END) OVER () IS NULL THEN CAST(cap AS DOUBLE)
      ELSE least(CAST(cap AS DOUBLE), max(CASE WHEN cap > level * weight THEN level END) OVER () * weight) END AS target
  FROM q),
r AS (
  SELECT d.*, no, source_size, target, row_number() OVER (ORDER BY key, doc_id NULLS LAST) AS rid,
    sum(size) OVER (PARTITION BY no ORDER BY key, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT r.*, pass, CAST(cum + pass * source_size AS DOUBLE) / target AS time
  FROM r, (SELECT unnest([0, 1]) AS pass) WHERE size > 0),
c AS (
  SELECT rid, size, sum(size) OVER (ORDER BY time, no, key, doc_id NULLS LAST, cum ROWS UNBOUNDED PRECEDING) AS running FROM p),
k AS (SELECT rid, count(*) AS copies FROM c WHERE 2 * running <= 3 * (SELECT sum(source_size) FROM t) GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(size * coalesce(copies, 0) AS BIGINT) AS taken FROM r LEFT JOIN k USING (rid)
"""
