"""Single-query search over a vector store: semantic, hybrid, similar, metadata.

A store is a DataFrame with ``id, document_text, metadata, embedding,
created_at``, or the name of a table made by :mod:`sparkvec.sources.store`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvec.functions import text as tx
from sparkvec.functions.jsons import metadata_matches
from sparkvec.functions.vectors import check_metric, distance_to, rank_key
from sparkvec.operators.checks import (
    MAX_TOP_K,
    check_query_text,
    check_top_k,
    check_weights,
)
from sparkvec.operators.encoding import EncoderFactory, encode_query
from sparkvec.operators.postings import matches
from sparkvec.sources.store import promoted_columns, resolve_store

TOP_K = 5
METADATA_TOP_K = 100
TEXT_WEIGHT, VECTOR_WEIGHT = 0.3, 0.7
MIN_TOKEN_LENGTH = 3

# Fixed value: hybrid search keeps rows nearer than this even without a keyword match.
HYBRID_DISTANCE = 1.0


def _query_vector(query: str | list[float], encoder_factory: EncoderFactory | None) -> list[float]:
    if not isinstance(query, str):
        return [float(x) for x in query]
    check_query_text(query)
    if encoder_factory is None:
        raise ValueError("a text query needs an encoder_factory")
    return encode_query(query, encoder_factory)


def fetch_rows(df: DataFrame, winners: DataFrame, keep: list[str]) -> DataFrame:
    """Attach ``keep`` columns to a ranked, at most ``MAX_TOP_K`` long, list of ids.

    The ids become literals in the scan's filter (in groups small enough for
    Parquet to test each value), so a store ordered by id reads the long text
    columns of only the row groups that hold a winner.
    """
    spark = df.sparkSession
    names = winners.columns
    ranked = [(i, *row) for i, row in enumerate(winners.collect())]
    found = [row[1 + names.index("id")] for row in ranked]
    hit = F.lit(False)
    for start in range(0, len(found), 10):
        hit = hit | F.col("id").isin(found[start : start + 10])
    schema = winners.schema
    listed = spark.createDataFrame(
        ranked, "_rank int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    )
    fetched = df.select("id", *keep).filter(hit).join(F.broadcast(listed), "id")
    rest = [n for n in names if n != "id"]
    return (
        fetched.orderBy("_rank")
        .limit(max(1, len(ranked)))
        .select("id", *keep, *rest)
    )


def nearest(
    df: DataFrame,
    vector: list[float],
    *,
    top_k: int,
    metric: str,
    keep: list[str],
    id_col: str = "id",
    vector_col: str = "embedding",
    late_fetch: bool = False,
) -> DataFrame:
    """The ``top_k`` rows nearest to one vector, with a ``distance`` column.

    The distance is computed once per row; each task keeps its best ``top_k``
    rows and only those are merged. ``late_fetch`` searches ids and vectors
    first and reads the other columns of the winners afterwards.
    """
    check_top_k(top_k)
    carried = [id_col] if late_fetch else [id_col, *keep]
    ranked = (
        df.select(*carried, distance_to(F.col(vector_col), vector, metric).alias("distance"))
        .orderBy(rank_key("distance"), id_col)
        .limit(top_k)
    )
    return fetch_rows(df, ranked, keep) if late_fetch else ranked


def semantic_search(
    store: DataFrame | str,
    query: str | list[float],
    *,
    top_k: int = TOP_K,
    encoder_factory: EncoderFactory | None = None,
    distance_threshold: float | None = None,
    include_distance: bool = False,
    metric: str | None = None,
) -> DataFrame:
    """Nearest documents to a text (or to a ready vector), nearest first.

    For a table the search runs at once, over ids and vectors only, and the
    texts of the winners are read by id; a DataFrame is searched lazily in one
    pass.

    Rows beyond ``distance_threshold`` are dropped after the limit; as rows are
    ranked by the filtered value this equals filtering first.
    """
    check_top_k(top_k, MAX_TOP_K)
    df, metric = resolve_store(store, metric)
    found = nearest(
        df,
        _query_vector(query, encoder_factory),
        top_k=top_k,
        metric=metric,
        keep=["document_text", "metadata"],
        late_fetch=isinstance(store, str) and top_k <= MAX_TOP_K,
    )
    if distance_threshold is not None:
        found = found.filter(F.col("distance") <= F.lit(float(distance_threshold)))
    return found if include_distance else found.drop("distance")


def similarity_search(
    df: DataFrame,
    query: str | list[float],
    *,
    top_k: int = TOP_K,
    encoder_factory: EncoderFactory | None = None,
    metric: str = "cosine",
    index_col: str = "index",
    text_col: str = "text",
    vector_col: str = "embedding",
) -> DataFrame:
    """Semantic search over any DataFrame with an index, a text and a vector column."""
    return nearest(
        df,
        _query_vector(query, encoder_factory),
        top_k=top_k,
        metric=check_metric(metric),
        keep=[text_col],
        id_col=index_col,
        vector_col=vector_col,
    )


def find_similar_documents(
    store: DataFrame | str,
    document_id: int,
    *,
    top_k: int = TOP_K,
    exclude_self: bool = True,
    include_distance: bool = False,
    metric: str | None = None,
) -> DataFrame:
    """Nearest documents to a stored one. An unknown id is an error.

    The vector is looked up first (one row, the id filter reaches the Parquet
    scan), so the search needs no join.
    """
    df, metric = resolve_store(store, metric)
    row = df.filter(F.col("id") == F.lit(document_id)).select("embedding").head()
    if row is None:
        raise ValueError(f"there is no document with id {document_id}")
    if exclude_self:
        df = df.filter(F.col("id") != F.lit(document_id))
    found = nearest(
        df,
        [float(x) for x in row[0]],
        top_k=top_k,
        metric=metric,
        keep=["document_text", "metadata"],
        late_fetch=isinstance(store, str) and top_k <= MAX_TOP_K,
    )
    return found if include_distance else found.drop("distance")


def query_tokens(query: str, min_token_length: int = MIN_TOKEN_LENGTH) -> list[str]:
    """Distinct lower-cased words of a query that are long enough to be searched for."""
    return sorted({w for w in query.lower().split() if len(w) >= min_token_length})


def text_score(
    df: DataFrame,
    query: str,
    *,
    text_col: str = "document_text",
    min_token_length: int = MIN_TOKEN_LENGTH,
    stop_words: tuple[str, ...] = (),
    output: str = "match",
    postings: str | None = None,
    id_col: str = "id",
) -> DataFrame:
    """Add a keyword relevance: the sum over query words of ``tf * idf * idf``.

    With ``postings``, a folder that :func:`sparkvec.operators.postings.write_postings`
    filled with these rows, no text is read and the scores are joined by ``id_col``.
    Without:

    ``idf = log10(rows / rows with the word)``. As every occurrence of a word
    adds its ``idf * idf``, the score needs no per-document word counts: one
    pass finds the document frequencies of the query's words (as many groups as
    the query has words), another walks each text once. Rows are not shuffled.
    """
    check_query_text(query)
    tokens = [t for t in query_tokens(query, min_token_length) if t not in stop_words]
    if not tokens:
        return df.withColumn(output, F.lit(0.0))
    if postings is not None:
        found = matches(df.sparkSession, postings, tokens, output).withColumnRenamed("id", "_hit")
        joined = df.join(found, F.col(id_col).cast("long") == F.col("_hit"), "left").drop("_hit")
        return joined.withColumn(output, F.coalesce(output, F.lit(0.0)))
    hits = F.filter(F.split(F.lower(F.col(text_col)), tx.SPACES), lambda w: w.isin(tokens))
    rows = df.agg(F.count(F.lit(1)))
    frequency = (
        df.select(F.explode(F.array_distinct(hits)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    idf = F.log10(rows.scalar() / F.col("df"))
    weights = frequency.select("word", F.pow(idf, F.lit(2.0)).alias("weight")).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "weight")))
    )
    score = F.aggregate(
        F.transform(hits, lambda w: F.col("_weights")[w]),
        F.lit(0.0),
        lambda total, x: total + F.coalesce(x, F.lit(0.0)),
    )
    score = F.coalesce(score, F.lit(0.0))  # a NULL text holds no word
    return (
        df.withColumn("_weights", weights.scalar()).withColumn(output, score).drop("_weights")
    )


def hybrid_search(
    store: DataFrame | str,
    query: str,
    *,
    top_k: int = TOP_K,
    text_weight: float = TEXT_WEIGHT,
    vector_weight: float = VECTOR_WEIGHT,
    encoder_factory: EncoderFactory | None = None,
    query_vector: list[float] | None = None,
    include_distance: bool = False,
    metric: str | None = None,
    min_token_length: int = MIN_TOKEN_LENGTH,
    postings: str | None = None,
) -> DataFrame:
    """Rank by ``text_weight * (1 - match) + vector_weight * distance``, smallest first.

    Kept are rows with a keyword match or a distance below 1. With ``postings``
    (see :func:`text_score`) only ids and vectors are read, and then the winners' texts.
    """
    check_weights(text_weight, vector_weight)
    check_top_k(top_k)
    check_query_text(query)
    df, metric = resolve_store(store, metric)
    vector = _query_vector(query if query_vector is None else query_vector, encoder_factory)
    away = distance_to(F.col("embedding"), vector, metric).alias("_distance")
    late = postings is not None and top_k <= MAX_TOP_K
    keep = [] if late else ["document_text", "metadata"]
    if postings is not None:
        scored = text_score(df.select("id", *keep, away), query, min_token_length=min_token_length, postings=postings)
    else:
        scored = text_score(
            df.select("id", "document_text", "metadata", "embedding"), query, min_token_length=min_token_length
        ).select("id", *keep, "match", away)
    combined = F.lit(float(text_weight)) * (F.lit(1.0) - F.col("match")) + F.lit(
        float(vector_weight)
    ) * F.col("_distance")
    found = (
        scored.filter((F.col("match") > 0) | (F.col("_distance") < HYBRID_DISTANCE))
        .select("id", *keep, combined.alias("combined_score"))
        .orderBy(rank_key("combined_score"), "id")
        .limit(top_k)
    )
    if late:
        found = fetch_rows(df, found, ["document_text", "metadata"])
    return found if include_distance else found.drop("combined_score")


_KINDS = {str: "string", bool: "boolean", int: "number", float: "number"}


def _promoted_matches(column: str, kind: str, key: str, value) -> Column:
    """The condition on a promoted column. Without a value of another JSON type or an integer
    that doubles cannot tell apart it is all that need be read, and it reaches the scan."""
    values = list(value) if isinstance(value, (list, tuple, set)) else [value]
    whole = metadata_matches(F.col("metadata"), key, value)
    if any(_KINDS.get(type(v)) != kind for v in values):
        return whole
    hit = F.col(column).isin([float(v) for v in values] if kind == "number" else values)
    large = any(isinstance(v, int) and abs(v) > 2**53 for v in values)
    return hit & whole if large else hit


def metadata_condition(
    filters: dict, column: Column | None = None, promoted: dict[str, tuple[str, str]] | None = None
) -> Column:
    """All of ``{key: value or list of values}`` hold; ``promoted`` names the typed columns of keys that have one."""
    if not filters:
        raise ValueError("the metadata filter is empty")
    document = F.col("metadata") if column is None else column
    condition = F.lit(True)
    for key, value in filters.items():
        if promoted and key in promoted:
            condition = condition & _promoted_matches(*promoted[key], key, value)
        else:
            condition = condition & metadata_matches(document, key, value)
    return condition


def search_by_metadata(
    store: DataFrame | str, filters: dict, *, top_k: int = METADATA_TOP_K
) -> DataFrame:
    """Documents whose metadata match, newest first."""
    if top_k < 1:
        raise ValueError("top_k must be positive")
    df, _ = resolve_store(store)
    late = isinstance(store, str) and top_k <= MAX_TOP_K
    promoted = promoted_columns(df.sparkSession, store) if isinstance(store, str) else None
    keep = ["document_text", "metadata", "created_at"]
    newest = (
        df.filter(metadata_condition(filters, promoted=promoted))
        .select("id", *(["created_at"] if late else keep))
        .orderBy(F.col("created_at").desc(), "id")
        .limit(top_k)
    )
    return fetch_rows(df, newest.select("id"), keep) if late else newest
