"""Postings: which documents hold a word, and how often, written once so that keyword scores read no text.

``postings`` has a row (word, id, tf) per word of a document and is sorted by word and
id over all files, so that a query's words reach few files and row groups; a word that
very many documents hold spreads over files by id. ``frequencies`` has a row per word
with the number of documents that hold it, ``corpus`` one row with their number.
The tables tell of the texts as they were when written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkvec.functions import text as tx

WORDS_PER_FILE = 5_000_000


def _counted(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Words of each id and how often; the texts are dealt by id before they are cut, so that words are counted where they lie."""
    dealt = rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_text")).repartition("id")
    words = dealt.select("id", F.explode(tx.words(F.col("_text"))).alias("word"))
    return words.groupBy("word", "id").agg(F.count(F.lit(1)).alias("tf"))


def write_postings(rows: DataFrame, path: str, *, id_col: str = "id", text_col: str = "document_text") -> None:
    """Cut all texts into lower-cased words at white space, count, and write the three tables below ``path``.

    Ids must be distinct. Texts are read once; of the words only the counted ones are moved, once, in order.
    """
    spark = rows.sparkSession
    _counted(rows, id_col, text_col).write.parquet(f"{path}/counted")
    counted = spark.read.parquet(f"{path}/counted")
    files = max(1, -(-counted.count() // WORDS_PER_FILE))
    ordered = counted.repartitionByRange(files, "word", "id").sortWithinPartitions("word", "id")
    ordered.write.parquet(f"{path}/postings")
    frequency = spark.read.parquet(f"{path}/postings").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    frequency.repartitionByRange("word").sortWithinPartitions("word").write.parquet(f"{path}/frequencies")
    rows.agg(F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/corpus")
    counted_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/counted")
    counted_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(counted_path, True)


def matches(spark: SparkSession, path: str, tokens: list[str], output: str = "match") -> DataFrame:
    """``id`` and the sum of ``tf * idf * idf`` over the tokens, for the documents that hold one.

    What comes to the driver is the document frequency of each token.
    """
    known = spark.read.parquet(f"{path}/frequencies").filter(F.col("word").isin(tokens)).collect()
    rows = spark.read.parquet(f"{path}/corpus").head()["rows"]
    hits = spark.read.parquet(f"{path}/postings").filter(F.col("word").isin([r["word"] for r in known]))
    idf = F.log10(F.lit(float(rows)) / F.col("df"))
    # at most one row per token of the query
    frequency = F.broadcast(spark.createDataFrame([(r["word"], r["df"]) for r in known], "word string, df long"))
    weighted = hits.join(frequency, "word").withColumn("_weight", F.col("tf") * idf * idf)
    return weighted.groupBy("id").agg(F.sum("_weight").alias(output))
