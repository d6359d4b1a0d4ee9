"""Windows, cleaning, validation and running offsets."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from sparkvec.functions import text as tx
from sparkvec.operators import chunking
from sparkvec.operators.running import with_running_offsets

LETTERS = "abcdefghij"


def windows(spark, text, size, overlap, tail=False):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(tx.text_windows(F.col("t"), size, overlap, tail).alias("w")).head().w


def plain_windows(text, size, overlap, tail=False):
    """The definition, written out on the driver."""
    if size <= 0 or len(text) <= size:
        return [text]
    out = []
    for start in range(0, len(text), size - overlap):
        out.append(text[start : start + size])
        if not tail and start + size >= len(text):
            break
    return out


@pytest.mark.parametrize(
    "size,overlap,core,tail",
    [
        (4, 1, ["abcd", "defg", "ghij"], ["abcd", "defg", "ghij", "j"]),
        (4, 0, ["abcd", "efgh", "ij"], ["abcd", "efgh", "ij"]),
        (10, 3, [LETTERS], [LETTERS]),
        (0, 0, [LETTERS], [LETTERS]),
        (4, 3, ["abcd", "bcde", "cdef", "defg", "efgh", "fghi", "ghij"], None),
    ],
)
def test_known_windows(spark, size, overlap, core, tail):
    assert windows(spark, LETTERS, size, overlap) == core
    if tail:
        assert windows(spark, LETTERS, size, overlap, True) == tail


@pytest.mark.parametrize("overlap", [4, 5, -1])
def test_windows_must_advance(spark, overlap):
    with pytest.raises(ValueError):
        windows(spark, LETTERS, 4, overlap)


def test_windows_of_many_texts(spark):
    alphabet = "aé \n😀\r x"
    texts = [(i, (alphabet * 40)[i : i + 7 * i]) for i in range(40)]
    df = spark.createDataFrame(texts, "id long, t string")
    for size, overlap, tail in [(7, 2, False), (7, 6, False), (5, 0, True), (9, 5, True)]:
        got = df.select("id", tx.text_windows(F.col("t"), size, overlap, tail).alias("w")).collect()
        for row in got:
            assert row.w == plain_windows(texts[row.id][1], size, overlap, tail)


@settings(max_examples=15, deadline=None)
@given(hs.text(hs.characters(codec="utf-8", exclude_characters="\x00"), max_size=80),
       hs.integers(1, 12), hs.integers(0, 11))
def test_windows_cover_the_text(spark, text, size, overlap):
    overlap = min(overlap, size - 1)
    parts = windows(spark, text, size, overlap)
    assert parts == plain_windows(text, size, overlap)
    assert parts[0] + "".join(p[overlap:] for p in parts[1:]) == text


def test_chunk_columns(spark):
    docs = spark.createDataFrame([(5, LETTERS), (2, "abc"), (9, "abcdefg")], "doc_id long, text string")
    got = chunking.chunk_documents(docs, chunk_size=4, overlap=1, global_index=True)
    rows = [tuple(r) for r in got.orderBy("chunk_index").collect()]
    assert got.columns == [
        "doc_id", "chunk_no", "chunk_index", "original_doc_index", "is_chunk",
        "chunk_start", "chunk_end", "document_text",
    ]
    assert rows == [
        (2, 0, 0, 0, False, None, None, "abc"),
        (5, 0, 1, 1, True, 0, 4, "abcd"),
        (5, 1, 2, 1, True, 3, 7, "defg"),
        (5, 2, 3, 1, True, 6, 10, "ghij"),
        (9, 0, 4, 2, True, 0, 4, "abcd"),
        (9, 1, 5, 2, True, 3, 7, "defg"),
    ]


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_running_offsets_on_a_clustered_key(spark, ranges):
    keys = [*range(1000, 1300), 5, 10**12, *range(-40, 0)]
    df = spark.createDataFrame([(k, abs(k) % 7) for k in keys], "k long, n int").repartition(6)
    got = with_running_offsets(
        df, "k", {"before": F.col("n"), "number": F.lit(1)}, ranges=ranges
    ).orderBy("k").collect()
    total = 0
    for number, row in enumerate(got):
        assert (row.before, row.number) == (total, number)
        total += row.n
    assert len(got) == len(keys)


def test_running_offsets_of_nothing(spark):
    df = spark.createDataFrame([], "k long")
    assert with_running_offsets(df, "k", {"number": F.lit(1)}).collect() == []


def test_sanitize_and_placeholder(spark):
    texts = ["  a\x00b \n\t c ", "", " \n\x00 ", None, "x  y", "\x1ca\x1fb"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    clean = [r.c for r in df.select(tx.sanitize_text(F.col("t")).alias("c")).collect()]
    assert clean == ["ab c", "", "", None, "x y", "a b"]
    assert [" ".join(t.replace("\x00", "").split()) for t in texts if t is not None] == [
        c for c in clean if c is not None
    ]
    given_ = [r.c for r in df.select(tx.encoder_input(F.col("t")).alias("c")).collect()]
    assert given_ == ["ab c", "[EMPTY]", "[EMPTY]", "[EMPTY]", "x y", "a b"]


def test_preview(spark):
    df = spark.createDataFrame([("abcdef",), ("abc",)], "t string")
    got = df.select(
        tx.preview(F.col("t"), 3).alias("a"), tx.preview(F.col("t"), 3, "...").alias("b")
    ).collect()
    assert [tuple(r) for r in got] == [("abc", "abc..."), ("abc", "abc")]


def test_validation(spark):
    def docs(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    assert chunking.require_valid_documents(docs("a", "b")) == 2
    report = chunking.validate_documents(docs("a", " \n", None)).head()
    assert tuple(report) == (False, 3, 2, 1, "empty")
    bad = chunking.invalid_documents(docs("a", " \n", None)).orderBy("doc_id").collect()
    assert [tuple(r) for r in bad] == [(1, "empty"), (2, "not a string")]
    with pytest.raises(ValueError, match="doc_id=2: not a string"):
        chunking.require_valid_documents(docs("a", "b", None))
    with pytest.raises(ValueError, match="no documents"):
        chunking.require_valid_documents(docs("a").filter("false"))


def test_processing_stats(spark):
    docs = spark.createDataFrame([(0, LETTERS), (1, "ab"), (2, " ")], "doc_id long, text string")
    got = chunking.processing_stats(docs, chunk_size=4, overlap=1).head()
    assert tuple(got) == (3, 5, 1)
    none = chunking.processing_stats(docs.filter("false")).head()
    assert tuple(none) == (0, 0, 0)


@pytest.mark.parametrize("size, overlap", [(40, 39), (40, 0), (37, 11), (500, 50)])
@pytest.mark.parametrize("tail", [False, True])
def test_long_texts_in_stretches(spark, monkeypatch, size, overlap, tail):
    """Windows of texts that are cut into many stretches are those of the whole text."""
    monkeypatch.setattr(tx, "STRETCH_CHARS", 200)
    texts = ["".join(chr(97 + (i * i + n) % 26) if i % 7 else "ü" for i in range(n)) for n in (0, 1, 39, 40, 41, 200, 201, 999, 2000)]
    docs = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string")
    step = size - overlap
    for dense in (False, True):
        got = {}
        found = chunking.chunk_documents(docs, chunk_size=size, overlap=overlap, emit_tail=tail, global_index=dense)
        for r in found.orderBy("doc_id", "chunk_no").collect():
            assert r.chunk_no == len(got.setdefault(r.doc_id, []))
            got[r.doc_id].append(r.document_text)
        for i, t in enumerate(texts):
            if len(t) <= size:
                assert got[i] == [t]
                continue
            starts = range(0, len(t) if tail else len(t) - overlap, step)
            assert got[i] == [t[s : s + size] for s in starts], (i, size, overlap)
        assert got[len(texts)] == [None]


def test_a_very_long_text_is_never_held_as_windows(spark):
    """600,000 characters, each of which starts a window: 300 MB of windows in stretches of 4 MB."""
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("repeat('abcdefghij', 60000)").alias("text"))
    found = chunking.chunk_documents(docs, chunk_size=500, overlap=499)
    row = found.agg(F.count("*").alias("n"), F.max("chunk_end").alias("end"), F.countDistinct("document_text").alias("kinds")).first()
    assert (row.n, row.end, row.kinds) == (599_501, 600_000, 10)
