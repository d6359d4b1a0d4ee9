"""Near-duplicate lines by deletion neighbourhoods, in DataFrame functions only.

A line is removed if an earlier one equals it or is within one edit of it (one
character inserted, deleted or replaced). Earlier means a smaller (doc_id, line
number); lines are judged on the input, not on what is left, and the earliest
stays.

Two lines within one edit share one half: half the shorter one's length, at the
front or at the back. Lines of ``LONG`` characters or more are cut into blocks
instead, and share all but one of them, so that the work grows with a line's
length and not with its square. Lines that share no half, nor all blocks but
one, with another are done. The others emit
the deletion variants of what is left, as hashes: all of them for replaced
characters (same place, same rest), and the longer line's against the shorter
line itself for inserted ones. Equal variants meet in a group, in which only the
least place counts: no pairs are formed. The partner found is verified by its
edit distance. Equal lines are one line in all of this.

Lines shorter than ``MIN_CHARS`` are compared for equality only, since one edit
is much of them. Defined results: blank lines always stay and are not compared;
a null or empty text has no line to remove; null ids come last; lines at the
same place (equal id, equal line number) do not remove each other, so repeated
documents lose the same lines; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkvec.llm.common import place, place_number, row_key, saved

EDITS = 1
MIN_CHARS = 20
LONG = 1024
#: Characters of a block at least; blocks grow with the root of the line's length.
BLOCK = 512


def lines_of(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: row, place (null ids last), line."""
    # a column beside a generator is computed for each row it makes: once a document here
    rows = docs.select(place(F.col("doc_id"), F.lit(0)).alias("base"), row_key().alias("row"), F.split("text", "\n").alias("parts"))
    rows = rows.select("base", "row", F.posexplode("parts").alias("number", "line")).where(F.trim("line") != "")
    return rows.select("row", (F.col("base") + F.col("number").cast("decimal(11,0)")).cast("decimal(38,0)").alias("place"), "line")


def _share(key: Column, short: bool, rest: Column, rests: bool) -> Column:
    return F.struct(key.alias("key"), F.lit(short).alias("short"), rest.alias("rest")) if rests else key


def _halves(length: Column, line: Column, short: bool, rests: bool) -> Column:
    """What a line shares with others as the shorter or equal one (``short``) or the longer one: front half, back half."""
    shorter = length if short else length - 1
    size = F.floor((shorter - 1) / 2).cast("int")
    front = F.xxhash64(shorter, F.lit("front"), F.substring(line, F.lit(1), size))
    back = F.xxhash64(shorter, F.lit("back"), F.substring(line, length - size + 1, size))
    return F.array(
        _share(front, short, F.substring(line, size + 1, length), rests),
        _share(back, short, F.substring(line, F.lit(1), length - size), rests),
    )


def _blocks(length: Column, line: Column, short: bool, rests: bool) -> Column:
    """The same for a long line: for each block, all before it and all after it.

    A longer line's block has one character more, and the blocks after it begin one character later.
    """
    shorter = length if short else length - 1
    size = F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(shorter))).cast("string")
    pattern = F.concat(F.lit("(?s).{1,"), size, F.lit("}"))

    def chained(blocks: Column) -> Column:
        first = F.array(F.lit(0).cast("long"))
        return F.aggregate(blocks, first, lambda done, block: F.concat(done, F.array(F.xxhash64(F.element_at(done, -1), block))))

    front = F.regexp_extract_all(line, pattern, F.lit(0))
    back = front if short else F.regexp_extract_all(F.substring(line, F.lit(2), length), pattern, F.lit(0))

    def shares(cut: Column) -> Column:
        def share(block: Column, i: Column) -> Column:
            key = F.xxhash64(cut["shorter"], i, F.get(cut["before"], i), F.get(cut["after"], F.size(cut["back"]) - 1 - i))
            rest = block if short else F.concat(F.substring(F.get(cut["front"], i), 1, 1), block)
            return _share(key, short, rest, rests)

        return F.transform(cut["back"], share)

    # in a lambda's argument, so that blocks and chains are made once a line, and it is counted once
    cut = F.struct(front.alias("front"), back.alias("back"), shorter.alias("shorter"))
    cut = F.transform(
        F.array(cut),
        lambda c: F.struct(
            c["front"].alias("front"),
            c["back"].alias("back"),
            c["shorter"].alias("shorter"),
            chained(c["front"]).alias("before"),
            chained(F.reverse(c["back"])).alias("after"),
        ),
    )
    return F.flatten(F.transform(cut, shares))


def _shares(length: Column, line: Column, rests: bool = True) -> Column:
    """Keys of what lines within an edit share, with ``rests`` also the role and what is left of the line."""

    def shares(short: bool) -> Column:
        long = (length if short else length - 1) >= LONG
        return F.when(long, _blocks(length, line, short, rests)).otherwise(_halves(length, line, short, rests))

    return F.concat(shares(True), shares(False))


def _trimmed(pair: Column) -> Column:
    """Lines ``a`` and ``b`` less the blocks that both begin with, and turned round. Their edit distance stays."""
    a, b = pair["a"], pair["b"]
    size = F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(F.char_length(a))))
    pattern = F.concat(F.lit("(?s).{1,"), size.cast("string"), F.lit("}"))
    unlike = F.zip_with(F.regexp_extract_all(a, pattern, F.lit(0)), F.regexp_extract_all(b, pattern, F.lit(0)), lambda x, y: ~x.eqNullSafe(y))
    first = F.array_position(unlike, F.lit(True))
    skip = F.when(first == 0, F.char_length(a)).otherwise((first - 1) * size).cast("int")
    return F.struct(*(F.reverse(F.substring(x, skip + 1, F.char_length(x))).alias(n) for x, n in ((a, "a"), (b, "b"))))


def _within(line: Column, other: Column) -> Column:
    """Whether two lines are within the edit bound; of long ones only the middle that differs is measured."""

    def measured(a: Column, b: Column) -> Column:
        return F.levenshtein(a, b, EDITS) >= 0

    # in a lambda's argument, so that lines are cut once
    pair = F.transform(F.array(F.struct(line.alias("a"), other.alias("b"))), _trimmed)
    long = F.get(F.transform(F.transform(pair, _trimmed), lambda p: measured(p["a"], p["b"])), F.lit(0))
    return F.when(F.char_length(line) < LONG, measured(line, other)).otherwise(long)


def near_lines(lines: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per distinct line (``name``, a hash) with one within an edit at an earlier place: that ``place``.

    ``lines`` has ``place`` and ``line``.
    """
    long = lines.withColumn("length", F.char_length("line")).where(F.col("length") >= min_chars)
    long = long.withColumn("name", F.xxhash64("line"))
    shared = long.select("name", F.explode(_shares(F.col("length"), F.col("line"), rests=False)).alias("key"))
    crowded = shared.groupBy("key").agg(F.min("name").alias("a"), F.max("name").alias("b")).where("a < b").select("key")
    # which lines share what: two numbers a row
    sharing = saved(shared.join(saved(crowded), "key").distinct())
    texts = long.join(sharing.select("name").distinct(), "name", "left_semi")
    texts = saved(texts.groupBy("name").agg(F.min("place").alias("place"), F.first("line").alias("line")))
    shares = texts.select("name", F.explode(_shares(F.char_length("line"), F.col("line"))).alias("share")).select("name", "share.*")
    shares = shares.join(sharing, ["name", "key"])
    # for replaced characters the place counts (lines of equal length), for inserted ones it does not
    variants = F.transform(
        F.sequence(F.lit(1), F.char_length("rest")),
        lambda i: F.xxhash64(
            "key",
            F.when(F.col("short"), i).otherwise(0),
            F.concat(F.substring("rest", F.lit(1), i - 1), F.substring("rest", i + 1, F.lit(1 << 30))),
        ),
    )
    itself = F.array(F.when(F.col("short"), F.xxhash64("key", F.lit(0), "rest")))
    variants = shares.select("name", "short", F.explode(F.concat(variants, itself)).alias("variant")).where("variant IS NOT NULL")
    # a window, so that the variants are made once; each distinct line has a variant once or twice
    same = Window.partitionBy("variant")
    met = variants.withColumn("shared", F.min("name").over(same) < F.max("name").over(same)).where("shared").drop("shared")
    members = saved(met.distinct()).join(texts.select("name", "place"), "name")
    # A replaced character: all members are short. An inserted one: one short line, and longer ones that meet it alone.
    first = members.groupBy("variant").agg(
        F.min(F.when(F.col("short"), F.col("place"))).alias("short_first"),
        F.min(F.when(~F.col("short"), F.col("place"))).alias("long_first"),
    )
    found = members.join(first, "variant")
    partner = F.when(F.col("short"), F.least("short_first", "long_first")).otherwise(F.col("short_first"))
    found = found.select("name", "place", partner.alias("earlier")).where(F.col("earlier") < F.col("place")).distinct()
    found = found.join(texts.select("name", "line"), "name").join(
        texts.select(F.col("place").alias("earlier"), F.col("line").alias("other")), "earlier"
    )
    near = found.where(_within(F.col("line"), F.col("other")))
    return near.groupBy("name").agg(F.min("earlier").alias("near"))


def removed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row key (md5 of id and text) with removed lines: their numbers from 0, ascending."""
    lines = lines_of(docs)
    # equal lines are told apart by 96 bits of hash, lines in the search of near ones by 64 and by their texts
    named = lines.select("row", "place", F.xxhash64("line").alias("name"), F.crc32("line").alias("check"))
    firsts = named.groupBy("name", "check").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    near = near_lines(lines, min_chars).withColumnRenamed("name", "near_name")
    firsts = firsts.join(near, F.col("name") == F.col("near_name"), "left").withColumn("near", F.least("first", "near"))
    earliest = firsts.where("near < last").select("name", "check", "near")
    gone = named.join(earliest, ["name", "check"]).where(F.col("near") < F.col("place"))
    return gone.groupBy("row").agg(F.sort_array(F.collect_set(place_number(F.col("place")))).alias("removed"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with ``text`` less its removed lines, other columns unchanged."""
    gone = removed_lines(docs, min_chars).withColumnRenamed("row", "gone_row")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("packed"), row_key().alias("row"))
    rows = packed.join(gone, F.col("row") == F.col("gone_row"), "left")
    parts = F.split("packed.text", "\n")
    kept = F.filter(parts, lambda _, i: ~F.array_contains("removed", i))
    text = F.when(F.col("removed").isNull(), F.col("packed.text")).otherwise(F.concat_ws("\n", kept))
    return rows.select(*(text.alias(c) if c == "text" else F.col(f"packed.`{c}`") for c in docs.columns))


def digest(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_lines``, ``n_removed`` and the numbers of the ``removed`` lines."""
    lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    rows = docs.select("doc_id", row_key().alias("row"), F.when(F.col("text").isNull(), 0).otherwise(lines).cast("long").alias("n_lines"))
    rows = rows.join(removed_lines(docs, min_chars), "row", "left")
    none = F.array().cast("array<int>")
    return rows.select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce("removed", none).alias("removed")
    )
