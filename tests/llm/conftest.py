import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i} Passage" for i in range(30))


def rows():
    """Nulls everywhere, empty and very long texts, ties, repeated rows, copies and near copies."""
    plain = [
        (i, f"Document {i} talks about subject{i % 7} and thing{i % 11}.\nIts second line, number {i}, is its own.", "en", f"s{i % 3}", 80)
        for i in range(40)
    ]
    odd = [
        (100, None, "en", "s0", None),
        (101, "", "de", "s1", 0),
        (102, " \n\t\n ", None, None, 5),
        (None, "no id at all, but words enough to be something", "en", None, 1),
        (None, None, None, None, None),
        (103, LONG, "en", "s0", len(LONG)),
        (104, "x" * 70_000, "en", "s0", 70_000),
        (105, "a" * 200, "fr", "s2", 200),
        (106, "Über Größe und Straße: schöne Grüße, lieber Käufer!", "de", "s2", 50),
        (107, "¿Qué? ¡Sí! el niño y la niña comen piñas en España", "es", "é", 50),
        (108, "1234 5678 !!", "en", "s1", 12),
        (109, "word", "en", "s1", 4),
        (110, "front matter " + PASSAGE + " back matter", "en", "s1", 1),
        (111, "quite another " + PASSAGE + " end of it", "en", "s1", 1),
        (112, PASSAGE, "en", "s1", 1),
        (112, PASSAGE, "en", "s1", 1),
        (113, PASSAGE + " tail", "en", "s9", 1),
        (113, "same id, other text, and nothing else to it", "en", "s9", 1),
    ]
    return plain + odd + odd[:6] + [(3, plain[5][1], "en", "s0", 80)]


@pytest.fixture(scope="session")
def odd_rows():
    return rows()


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with extra columns whose names the operators use inside."""
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    names = ["row", "key", "id", "fp", "root", "place", "name", "size", "n", "shard", "slot", "score", "copies", "words", "spans", "salt"]
    return docs.withColumns({c: F.lit(f"extra {c}") for c in names})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
