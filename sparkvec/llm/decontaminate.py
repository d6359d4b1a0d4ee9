"""Benchmark decontamination by winnowing, in DataFrame functions only.

Both sides are cut into words; the hashes of ``GRAM`` consecutive words are
winnowed: in every window of ``WINDOW - GRAM + 1`` hashes the least is kept. Two
equal stretches of ``WINDOW`` words keep the same hash, so joining fingerprints
misses no shared stretch. Where a fingerprint of a document is joined, the
stretches that it stands for are extended to their ``WINDOW`` words and compared
as text, so nothing is reported on a hash alone.

Items of fewer than ``WINDOW`` words are one stretch of their own length; such
lengths are handled the same way with a gram of that length and no winnowing.

Copies share the work: documents are joined by the md5 of their text, and equal
texts are one row in all steps after the first. The benchmark's fingerprints are
broadcast only while a count proves their number small; beyond
that the join shuffles.

Defined results: a null or wordless text has no words and is not contaminated;
null or wordless items never occur; repeated items (equal texts) all count,
repeated ``item_id`` once; a null ``item_id`` has no name and is left out of
``n_items`` but its words are hit; repeated documents each give a row; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvec.llm.common import checked, lower_ascii, saved

WINDOW = 10
GRAM = 5
#: ASCII characters that separate words: all but digits and letters. Listed one by
#: one in the patterns, since Java tests a list by one look-up and ranges in turn.
_GAPS = [c for c in range(128) if not chr(c).isalnum()]
_UPPER = range(ord("A"), ord("Z") + 1)


def _outside(codes) -> str:
    return "[^" + "".join(f"\\x{c:02X}" for c in codes) + "]+"


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, for lower-cased texts.
WORD = _outside([*_GAPS, *_UPPER])
#: The same words before lower-casing.
ANY_CASE = _outside(_GAPS)


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _doubled(frame: DataFrame, name: str, length: int, merge) -> DataFrame:
    """Merge each ``length`` neighbours of the array ``name``, in log2(length) passes.

    Each pass is a column of its own: a column used twice is not computed twice,
    while a nested expression would be.
    """
    done = 1
    while done < length:
        step = min(done, length - done)
        # what covers done + step neighbours from i: that of `done` from i and from i + step
        size = F.greatest(F.size(name) - step, F.lit(0))
        frame = frame.withColumn(name, F.zip_with(F.slice(name, F.lit(1), size), F.slice(name, F.lit(step + 1), size), merge))
        done += step
    return frame


def with_minima(frame: DataFrame, gram: int, width: int) -> DataFrame:
    """Add ``minima``: the least hash of ``gram`` words in each ``width`` consecutive ones, from ``words``."""
    frame = frame.withColumn("minima", F.transform("words", lambda w: F.xxhash64(w)))
    frame = _doubled(frame, "minima", gram, lambda a, b: F.xxhash64(a, b))
    return _doubled(frame, "minima", width, lambda a, b: F.least(a, b))


def _windows(frame: DataFrame, length: int, keep: Column, *also: str) -> DataFrame:
    """One row for each run of ``length`` of ``words`` whose start passes ``keep(start)``: start, run."""
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    starts = F.filter(starts, keep) if keep is not None else starts
    rows = frame.where(F.size("words") >= length).select(*also, "words", F.explode(starts).alias("start"))
    return rows.select(*also, "start", F.concat_ws(" ", F.slice("words", F.col("start"), F.lit(length))).alias("run"))


def _occurrences(texts: DataFrame, items: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, start, run) of every run of ``length`` words in ``texts`` (key, text) that is in ``items`` (run).

    ``items`` has the distinct runs of that length.
    """
    width = length - gram + 1
    marks = with_minima(items.select(F.split("run", " ").alias("words")), gram, width)
    marks = checked(saved(marks.select(F.element_at("minima", 1).alias("mark")).distinct()))
    # texts of fewer words than the length have no minima; a filter here would cut the words twice
    kept = with_minima(texts.select("key", words(F.col("text")).alias("words")), gram, width)
    kept = kept.select("key", F.explode(F.array_distinct("minima")).alias("mark"))
    hits = kept.join(marks, "mark").groupBy("key").agg(F.collect_set("mark").alias("marks"))
    # a row for each text that shares a mark; a text cannot have more marks than windows
    back = texts.join(hits, "key").dropDuplicates(["key"]).select("key", words(F.col("text")).alias("words"), "marks")
    starts = F.filter(
        F.sequence(F.lit(1), F.size("words") - length + 1),
        lambda at: F.array_contains("marks", F.element_at("minima", at)),
    )
    back = with_minima(back, gram, width)
    rows = back.select("key", "words", F.explode(starts).alias("start"))
    rows = rows.select("key", "start", F.concat_ws(" ", F.slice("words", F.col("start"), F.lit(length))).alias("run"))
    return rows.join(checked(items), "run").select("key", "start", F.lit(length).alias("length"), "run")


def _covered(spans: Column) -> Column:
    """How many words the sorted array of (start, length) covers."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def step(state: Column, span: Column) -> Column:
        end = span["start"] + span["length"] - 1
        fresh = end - F.greatest(state["end"], span["start"] - 1)
        return F.struct(
            F.greatest(state["end"], end).alias("end"), (state["total"] + F.greatest(fresh, F.lit(0))).alias("total")
        )

    return F.aggregate(spans, start, step, lambda state: state["total"])


def contamination(texts: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per distinct contaminated text: ``key`` (its md5), ``spans`` (start, length) and ``items``.

    ``texts`` has ``key`` and ``text``, ``benchmark`` has ``item_id`` and ``text``.
    """
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    lengths = items.select(F.least(F.size("words"), F.lit(window)).alias("n")).distinct()
    found = None
    for length in sorted(r.n for r in lengths.collect()):  # at most `window` numbers
        mine = items.where(F.size("words") == length) if length < window else items.where(F.size("words") >= window)
        runs = _windows(mine, length, None, "item_id").select("item_id", "run").distinct()
        some = _occurrences(texts, runs.select("run").distinct(), length, min(gram, length))
        spans = some.groupBy("key").agg(F.collect_set(F.struct("start", "length")).alias("spans"))
        named = some.select("key", "run").distinct().join(checked(runs), "run")
        named = named.groupBy("key").agg(F.collect_set("item_id").alias("items"))
        part = spans.join(named, "key")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return texts.limit(0).select(
            "key", F.expr("CAST(array() AS array<struct<start:int,length:int>>)").alias("spans"), F.array().cast("array<bigint>").alias("items")
        )
    if lengths.count() == 1:
        return found
    merged = found.groupBy("key").agg(F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    return merged.select(
        "key", F.array_distinct(F.flatten("spans")).alias("spans"), F.array_distinct(F.flatten("items")).alias("items")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.md5("text").alias("key"), "text").where(F.col("text").isNotNull())


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: what part of it and which items of the benchmark it holds."""
    found = contamination(_keyed(docs), benchmark, window, gram)
    digest = found.select(
        "key",
        _covered(F.array_sort("spans")).cast("long").alias("n_hit"),
        F.sort_array(F.transform("items", lambda x: x.cast("string"))).alias("names"),
    )
    n_words = F.coalesce(F.regexp_count("text", F.lit(ANY_CASE)), F.lit(0))
    rows = docs.select("doc_id", F.md5("text").alias("key"), n_words.cast("long").alias("n_words"))
    return rows.join(digest, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "names"), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The documents, unchanged, that hold no stretch of the benchmark."""
    dirty = contamination(_keyed(docs), benchmark, window, gram).select("key")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.md5("text").alias("key"))
    return rows.join(dirty, "key", "left_anti").select("row.*")


#: The windows of the benchmark looked up among all windows of the documents.
ORACLE = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS r FROM documents),
iw AS (
  SELECT item_id, w, least(len(w), 10) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
iwin AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS run
  FROM (SELECT item_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS s FROM iw)),
dwin AS (
  SELECT r, n, s, array_to_string(w[s : s + n - 1], ' ') AS run
  FROM (SELECT r, n, w, unnest(generate_series(1, len(w) - n + 1)) AS s
        FROM dw, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hits AS (SELECT r, s, dwin.n AS n, item_id FROM dwin JOIN iwin ON dwin.run = iwin.run AND dwin.n = iwin.n),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
