"""Filter interaction audit: what each filter removes in every order of a filter chain.

A document is reduced to its failure mask, one bit per filter. Documents of a part
with equal masks and labels are counted together, so that what is left per part is
bounded by the number of masks, whatever the table's size. The orders are then
evaluated as matrices: with the mask matrix C (0 where a mask fails a filter, no
finite cost where it passes) and the position matrix P (the inverse permutation of
every order), the min-plus product R[m, o] = min over f of C[m, f] + P[o, f] is the
step at which order o removes mask m. R drives weighted scatter counts.

Duplicates are a filter of the whole table: a document fails it if its text is that
of a document of smaller id, removed or not. Texts are compared by their SHA-256.
The least id of a text is found over cells of equal text, part, mask and labels,
which are counted before they are shuffled, so that thousands of copies are few rows.

Defined results: a null text is an empty text; a null part is the empty string; a
null id is neither smaller nor larger than another, so such a row never fails the
duplicate filter and has no labels; repeated rows (one id and text) have no smaller
id among themselves and all count; an id is labelled 1 if any of its label rows
says so; null labels and null label ids say nothing; a table without rows has no
parts and no result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
Filters = dict[str, Callable[[Column], Column]]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda word: word != "")


def _upper(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))


#: Letter -> whether a text fails.
FILTERS: Filters = {
    "A": lambda text: F.size(_words(text)) < 100,
    "B": lambda text: F.size(F.array_distinct(_words(text))) * 100 < F.size(_words(text)) * 80,
    "C": lambda text: _upper(text).cast("long") * 100 > F.char_length(text).cast("long") * 10,
    "D": lambda text: text.rlike("[#$%&*|]"),
}
DUPLICATES = "E"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in COUNTS)


def failures(docs: DataFrame, filters: Filters = FILTERS, part: str = "lang") -> DataFrame:
    """Per document: ``doc_id``, ``part``, ``digest`` of the text, and ``mask``, bit i for the i-th filter by letter."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bits = [F.when(filters[letter](text), 1 << at).otherwise(0) for at, letter in enumerate(sorted(filters))]
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        sum(bits, F.lit(0)).cast("int").alias("mask"),
    )


def _flags(labels: DataFrame) -> DataFrame:
    """One row per labelled id."""
    said = lambda name: F.coalesce(F.max((F.col(name) == 1).cast("int")), F.lit(0)).alias(name)
    found = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return found.agg(said("quality"), said("toxic"))


def mask_counts(docs: DataFrame, labels: DataFrame, filters: Filters = FILTERS, part: str = "lang") -> DataFrame:
    """Documents per ``part``, ``mask`` (the duplicate filter is the bit after the others), ``quality`` and ``toxic``."""
    rows = failures(docs, filters, part).groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(_flags(labels), "doc_id", "left").fillna(0, ["quality", "toxic"])
    # an id stands once in a cell, so that min_by counts the rows of its least id
    cells = rows.groupBy("digest", "part", "mask", "quality", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("n_first"),
    )
    least = F.min("first").over(Window.partitionBy("digest"))
    own = F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    cells = cells.withColumn("least", least).withColumn("copies", F.col("n") - F.col("nameless") - own)
    bit = 1 << len(filters)
    both = F.array(
        F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct((F.col("mask") + bit).cast("int").alias("mask"), F.col("copies").alias("n")),
    )
    split = cells.select("part", "quality", "toxic", F.inline(both)).where("n > 0 or mask = 0")
    return split.groupBy("part", "mask", "quality", "toxic").agg(F.sum("n").alias("n"))


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Min-plus product: the step (from 0) at which an order removes a mask; the number of filters if it never does.

    ``masks`` is (masks x filters), true where the mask fails; ``positions`` is (orders x filters).
    """
    filters = masks.shape[1]
    steps = np.full((len(masks), len(positions)), filters, np.int64)
    for at in range(filters):
        cost = np.where(masks[:, at], 0, filters)
        np.minimum(steps, cost[:, None] + positions[None, :, at], out=steps)
    return steps


def tally(masks: np.ndarray, weights: np.ndarray, letters: str, orders: Iterable[str]) -> pd.DataFrame:
    """One row per order and step. ``weights`` holds, per mask, the documents, those of quality 1 and those of toxic 1."""
    orders = list(orders)
    filters = len(letters)
    by_step = np.array([[letters.index(letter) for letter in order] for order in orders])
    positions = np.argsort(by_step, axis=1)
    steps = removal_steps(masks, positions)
    row = np.broadcast_to(np.arange(len(orders)), steps.shape)
    lost = np.zeros((3, len(orders), filters + 1), np.int64)
    for kind in range(3):
        np.add.at(lost[kind], (row, steps), np.broadcast_to(weights[:, kind, None], steps.shape))
    lost = lost[:, :, :filters]
    redundant = np.zeros((len(orders), filters), np.int64)
    for at in range(filters):
        earlier = masks[:, at, None] & (steps < positions[None, :, at])
        redundant[np.arange(len(orders)), positions[:, at]] = (earlier * weights[:, :1]).sum(axis=0)
    alone = (masks & (masks.sum(axis=1) == 1)[:, None]) * weights[:, :1]
    shapley = np.zeros(filters, np.int64)
    np.add.at(shapley, by_step, lost[0])
    columns = {
        "filter_order": np.repeat(orders, filters),
        "step": np.tile(np.arange(1, filters + 1), len(orders)).astype(np.int32),
        "kept": (weights[:, 0].sum() - lost[0].cumsum(axis=1)).ravel(),
        "removed": lost[0].ravel(),
        "redundant": redundant.ravel(),
        "unique_fails": alone.sum(axis=0)[by_step].ravel(),
        "good_lost": lost[1].ravel(),
        "toxic_lost": lost[2].ravel(),
        "shapley": shapley[by_step].ravel(),
    }
    return pd.DataFrame(columns)


def audit(docs: DataFrame, labels: DataFrame, filters: Filters = FILTERS, part: str = "lang", duplicates: str = DUPLICATES) -> DataFrame:
    """One row per part, order of the filters and step; see ``COUNTS`` for the counts."""
    letters = "".join(sorted(filters)) + duplicates
    orders = sorted("".join(order) for order in permutations(letters))

    def whole_part(found: pd.DataFrame) -> pd.DataFrame:
        # at most 4 rows for each of the 2 ** len(letters) masks
        mask, n = found["mask"].to_numpy(), found["n"].to_numpy(np.int64)
        failed = (mask[:, None] >> np.arange(len(letters)) & 1).astype(bool)
        weights = np.stack([n, n * found["quality"].to_numpy(), n * found["toxic"].to_numpy()], axis=1)
        result = tally(failed, weights, letters, orders)
        result.insert(0, "part", found["part"].iloc[0])
        return result

    return mask_counts(docs, labels, filters, part).groupBy("part").applyInPandas(whole_part, _SCHEMA)


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), said AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
    [f.letter FOR f IN [
      {'letter': 'A', 'fails': len(w) < 100},
      {'letter': 'B', 'fails': 100 * len(list_distinct(w)) < 80 * len(w)},
      {'letter': 'C', 'fails': 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t)},
      {'letter': 'D', 'fails': regexp_matches(t, '[#$%&*|]')},
      {'letter': 'E', 'fails': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)}
    ] IF f.fails] AS fails
  FROM texts LEFT JOIN said USING (doc_id)
), masks AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM failed GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), removed AS (
  SELECT part, o, fails, n, good, bad, coalesce(list_min([instr(o, f) FOR f IN fails]), 6) AS gone FROM masks, orders
), counted AS (
  SELECT part, o AS filter_order, s::INT AS step,
    sum(CASE WHEN gone > s THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN gone = s THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN gone < s AND list_contains(fails, substr(o, s::INT, 1)) THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails = [substr(o, s::INT, 1)] THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN gone = s THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN gone = s THEN bad ELSE 0 END)::BIGINT AS toxic_lost
  FROM removed, range(1, 6) steps(s) GROUP BY ALL
)
SELECT *, sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1))::BIGINT AS shapley FROM counted
"""
