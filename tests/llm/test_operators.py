"""Each operator against brute force on odd rows, and on empty tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from sparkvec.llm import ann, decontaminate, langid, line_dedup, mixing, paragraph_dedup, quality, sharding, simhash, suffix_dedup
from sparkvec.llm.common import components
from tests.llm.conftest import PASSAGE, SCHEMA


def order(rows):
    return sorted(rows, key=repr)


# --- 1 sharding


def drawn(key, tree):
    def pick(level, children):
        def draw(child):
            seed = xxhash.xxh64_intdigest(level.encode(), 42)
            seed = xxhash.xxh64_intdigest(child[0].to_bytes(4, "little", signed=True), seed)
            if key is not None:
                seed = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), seed)
            return -math.log(((seed >> 11) + 0.5) / 2**53) / child[1], child[0]

        return min(draw(c) for c in children)[1]

    region = pick("region", [(r[0][0][0], sum(w for rack in r for _, w in rack)) for r in tree.regions])
    racks = next(r for r in tree.regions if r[0][0][0] == region)
    rack = pick("rack", [(k[0][0], sum(w for _, w in k)) for k in racks])
    return pick("shard", list(next(k for k in racks if k[0][0] == rack)))


def test_sharding(odd, odd_rows, empty):
    got = sharding.assignment(odd).collect()
    assert len(got) == len(odd_rows)
    want = [
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), drawn(d, sharding.tree(8)), drawn(d, sharding.tree(9)))
        for d, t, *_ in odd_rows
    ]
    assert order((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got) == order(want)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assignment(empty).collect() == []
    assert set(sharding.place(odd, sharding.tree(8)).columns) == set(odd.columns)


def test_sharding_moves_only_into_heavier_subtrees(spark):
    before = sharding.tree(8)
    heavy = sharding.Tree(((before.regions[0][0], ((2, 1.0), (3, 3.0))), before.regions[1]))
    rows = spark.range(20000).select(sharding.shard_of(F.col("id"), before).alias("a"), sharding.shard_of(F.col("id"), heavy).alias("b"))
    moves = {(r.a, r.b): r["count"] for r in rows.where("a <> b").groupBy("a", "b").count().collect()}
    # into the heavier region, there into the heavier rack, there into the heavier shard; nothing else moves
    assert all(b < 4 for _, b in moves) and all(b in (2, 3) for a, b in moves if a < 2) and all(b == 3 for a, b in moves if a in (2, 3))
    share = {r.b: r["count"] for r in rows.groupBy("b").count().collect()}
    assert abs(share[3] / 20000 - 0.3) < 0.03
    assert sharding.tree(3) == sharding.Tree(before.regions, frozenset({3, 4, 5, 6, 7}))
    for bad in (lambda: sharding.tree(0), lambda: sharding.Tree(before.regions, frozenset({8}))):
        with pytest.raises(ValueError):
            bad()
    for n in (1, 2, 3, 5, 6, 7, 8, 9, 10, 12):
        grown = spark.range(5000).select(sharding.shard_of(F.col("id"), sharding.tree(n)).alias("a"), sharding.shard_of(F.col("id"), sharding.tree(n + 1)).alias("b"))
        assert {r.b for r in grown.where("a <> b").collect()} == {n}
        counts = [r["count"] for r in grown.groupBy("b").count().collect()]
        assert len(counts) == n + 1 and max(abs(c * (n + 1) / 5000 - 1) for c in counts) < 0.25


# --- 2 suffix arrays


def covered(rows, length=50):
    least, none = {}, 2**63 - 1
    for d, t, *_ in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            least[w] = min(least.get(w, none), none if d is None else d)
    for d, t, *_ in rows:
        raw, mine = (t or "").encode(), none if d is None else d
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if least[raw[i : i + length]] < mine:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        yield d, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("crowd", [2, 20_000])
def test_suffix_dedup(odd, odd_rows, empty, crowd, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    got = [tuple(r) for r in suffix_dedup.digest(odd).collect()]
    assert order(got) == order(covered(odd_rows))
    kept = [(r.doc_id, hashlib.sha256(r.kept).hexdigest()) for r in suffix_dedup.dedup_bytes(odd).collect()]
    assert order(kept) == order((r[0], r[4]) for r in got)
    assert suffix_dedup.digest(empty).collect() == []


def test_suffix_dedup_copies_are_no_crowd(spark, monkeypatch):
    """A passage that many documents hold goes as segments, and not window by window, unless these differ."""
    monkeypatch.setattr(suffix_dedup, "CROWD", 30)
    passage = " ".join(f"shared{k}" for k in range(30))
    rows = [(i, f"{i * 7919} begins {passage} and ends {i * 104729}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = suffix_dedup.shared_anchors(suffix_dedup._rows(docs), 50, 16).collect()
    crowded = [sum(m % 2 for m in r.marks) / len(r.marks) for r in marks]
    assert len(marks) == 120 and max(crowded) < 0.5  # at both ends all segments differ
    assert order(tuple(r) for r in suffix_dedup.digest(docs).collect()) == order(covered(rows))


@pytest.mark.parametrize("hot", [200, 1000, 1 << 24])
def test_suffix_dedup_hot_anchor_in_pieces(monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 100)
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", hot)
    monkeypatch.setattr(suffix_dedup, "HELD_WINDOWS", 20)
    rng = np.random.default_rng(8)
    text = bytes(rng.integers(97, 123, 40, np.uint8))
    rows = []
    for route in (3, 4, 9):
        for i in np.sort(rng.integers(0, 60, 80)).tolist():
            low, high = int(rng.integers(0, 15)), int(rng.integers(25, 41))
            segment = bytearray(text[low:high])
            segment[int(rng.integers(len(segment)))] ^= int(rng.integers(2))  # few are distinct, and windows are shared
            rows.append((route, bytes(segment), i, len(rows), 1000))
    least = {}
    for route, segment, i, *_ in rows:
        for k in range(len(segment) - 9):
            least.setdefault((route, segment[k : k + 10]), i)
    want = set()
    for route, segment, i, row, _ in rows:
        for k in range(len(segment) - 9):
            if least[route, segment[k : k + 10]] < i:
                want |= {(row, k + j) for j in range(10)}
    table = pa.Table.from_arrays(
        [pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32()))],
        names=["route", "segment", "id", "salt", "at"],
    )
    got = set()
    for batch in suffix_dedup._shards(iter(table.to_batches(max_chunksize=7)), 10):
        for span in batch.to_pylist():
            got |= {(span["salt"], at - 1000) for at in range(span["start"], span["end"])}
    assert got == want != set()


def test_suffix_dedup_rows_of_one_id(spark):
    """Two texts of one id that agree in the last 24 bits of the hash of their rows, of which one is a later copy."""
    seen = {}
    for i in range(100_000):
        text = f"text number {i} of one document id, long enough to fill a window of bytes"
        key = hashlib.md5(f"7|{text}".encode()).hexdigest().encode()
        other = seen.setdefault(xxhash.xxh64_intdigest(key, 42) & 0xFFFFFF, text)
        if other != text:
            break
    tail = " ".join(f"t{k}" for k in range(40))
    rows = [(1, text), (7, text), (7, other), (9, f"{other} {tail}"), (9, other[:20] + tail), (12, tail)]
    got = [tuple(r) for r in suffix_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert other != text and order(got) == order(covered(rows))


def test_suffix_dedup_largest_id(spark):
    """The largest id there is stays itself beside null ids, of equal and of other texts."""
    last = 2**63 - 1
    shared = "a passage of more than fifty bytes that several of the rows hold"
    rows = [(5, f"{shared} of five"), (last, f"{shared} of the last"), (None, f"{shared} of none"), (last, "only here " * 9), (None, "only here " * 9)]
    got = suffix_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    size = len(shared) + 4
    assert order((r.doc_id, r.n_removed) for r in got) == order([(5, 0), (last, size), (None, size), (last, 0), (None, 0)])
    kept = suffix_dedup.dedup_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert order((r.doc_id, len(r.text.encode()) - len(r.kept)) for r in kept) == order((r.doc_id, r.n_removed) for r in got)


def test_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(200):
        raw = bytes(rng.choice(list(b"ab\0"), rng.integers(1, 90)).astype(np.uint8))
        depth = int(rng.choice([5, 9, 20, 50]))
        data = np.frombuffer(raw, np.uint8)
        places, _ = suffix_dedup.suffix_array(data, depth)
        heads = [raw[i : i + depth] for i in places]
        assert heads == sorted(heads)
        prefixes = suffix_dedup.common_prefixes(data, places, depth)
        for i in range(1, len(heads)):
            a, b = heads[i - 1], heads[i]
            assert prefixes[i] == next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


# --- 3 decontamination


def hits(rows, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    runs = [(i, tuple(w[s : s + min(len(w), window)])) for i, t in items if (w := cut(t)) for s in range(max(len(w) - window, 0) + 1)]
    for d, t, *_ in rows:
        w, hit, named = cut(t), set(), set()
        for n in {len(r) for _, r in runs}:
            places = collections.defaultdict(list)
            for s in range(len(w) - n + 1):
                places[tuple(w[s : s + n])].append(s)
            for i, r in runs:
                if len(r) == n and r in places:
                    hit.update(p for s in places[r] for p in range(s, s + n))
                    named |= {str(i)} if i is not None else set()
        yield d, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)


def test_decontamination(spark, odd, odd_rows, empty):
    items = [(1, PASSAGE.upper()), (10, "Quite ANOTHER"), (2, None), (3, " !! "), (None, "front matter"), (4, "niña comen"), (5, "word"), (10, "end of it")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    got = [tuple(r) for r in decontaminate.decontaminate(odd, benchmark).collect()]
    assert order(got) == order(hits(odd_rows, items))
    clean = decontaminate.keep_clean(odd, benchmark)
    assert clean.columns == odd.columns and clean.count() == sum(not r[5] for r in got)
    assert decontaminate.decontaminate(empty, benchmark).collect() == []
    assert not any(r.contaminated for r in decontaminate.decontaminate(odd, benchmark.limit(0)).collect())


# --- 4 quality


def junk(spark, n=240):
    rng = np.random.default_rng(2)
    words = ["river", "stone", "walk", "green", "house", "over", "under", "never", "light", "sound"]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(n)]
    rows = [(i, t if i % 3 else t.replace(" ", "$$ ").upper(), "en", "s", 1) for i, t in enumerate(texts)]
    return rows, [(i, int(i % 3 != 0), 0) for i in range(n)]


def test_quality(spark, odd, odd_rows, empty):
    rows, marks = junk(spark)
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([*marks, (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in marks)
    assert all(got[i].predicted == q and 0 <= got[i].score <= 1 for i, q, _ in marks)
    mixed = quality.classify(odd.unionByName(docs, allowMissingColumns=True), labels).collect()
    assert len(mixed) == len(odd_rows) + len(rows) and not any(math.isnan(r.score) for r in mixed)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(q for _, q, _ in marks)
    assert quality.classify(empty, labels).collect() == []
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    # many rows of one id teach as much as one
    again = {r.doc_id: r.score for r in quality.classify(docs.unionByName(docs).repartition(5), labels).collect()}
    assert again == {d: r.score for d, r in got.items()}


# --- 5 nearest neighbours


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(700, 12)) * rng.uniform(0.5, 2, (700, 1))
    data[50:300] = data[50]  # a third of all rows is one vector
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(1000, None), (1001, [0.0] * 12), (1002, [math.nan] * 12), (1003, [1.0] * 3), (None, [1.0] * 12), (7, data[7].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = collections.defaultdict(list)
    for r in ann.search(frame).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 700, 20))
    for q, found in got.items():
        scores = data @ data[q]
        best = [i for i in np.lexsort((np.arange(700), -np.round(scores, 9))) if i != q][:20]
        assert [i for i, _ in found] == best and np.allclose([s for _, s in found], scores[best])
    assert ann.search(frame.limit(0)).collect() == []


def test_hilbert_curve():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    walk = cells[np.argsort(ann.hilbert(cells, 3))]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


# --- 6 mixing


def filled(sizes, weights, budget):
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    while open_ and budget > 1e-9:
        level = budget / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] >= 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2.0 * sizes[s] if s in full else level * weights[s]
            budget -= target[s]
        open_ -= full or open_
    return target


def test_mixing(odd, odd_rows, empty):
    got = mixing.shares(odd).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = collections.Counter()
    for _, t, _, s, _ in odd_rows:
        sizes[s] += count(t)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = filled(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(sizes.values()))
    want = sorted((d or -1, count(t), sizes[s], round(target[s], 6)) for d, t, _, s, _ in odd_rows)
    assert sorted((r.doc_id or -1, r["size"], r.source_size, round(r.target, 6)) for r in got) == want
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    assert sum(r.taken for r in got) <= 1.5 * sum(sizes.values())
    assert order(map(tuple, got)) == order(map(tuple, mixing.shares(odd.repartition(7)).collect()))
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert sum(count(r.text) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.shares(empty).collect() == []


# --- 7 lines


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_lines(spark, odd, odd_rows, empty):
    base = "the quick brown fox jumps over it"
    near = [base, base[1:], base + "!", base.replace("q", "Q"), base[:9] + "é" + base[9:], base[2:], "short line", "short linE"]
    rows = [r for r in odd_rows if len(r[1] or "") < 300] + [(200 + i, "\n".join([near[i], "kept " * i]), "en", "s", 1) for i in range(8)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("name", F.lit(1))
    lines = [((d is None, d or 0, n), l) for d, t, *_ in rows for n, l in enumerate((t or "").split("\n")) if l.strip(" ")]

    def gone(place, line):
        close = lambda o: o == line or (min(len(o), len(line)) >= 20 and abs(len(o) - len(line)) < 2 and edits(o, line) <= 1)
        return any(p < place and close(o) for p, o in lines)

    removed = {(p, l): gone(p, l) for p, l in lines}
    want = []
    for d, t, *_ in rows:
        parts = (t or "").split("\n")
        want.append((d, 0 if t is None else len(parts), [n for n, l in enumerate(parts) if l.strip(" ") and removed[((d is None, d or 0, n), l)]]))
    got = [(r.doc_id, r.n_lines, list(r.removed)) for r in line_dedup.digest(docs).collect()]
    assert order(got) == order(want)
    assert line_dedup.digest(odd).count() == len(odd_rows) and line_dedup.digest(empty).collect() == []
    texts = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).where("doc_id >= 200").collect()}
    assert texts[200] == base + "\n" and texts[203] == "kept kept kept " and texts[205] == "kept " * 5


def test_long_lines(spark, monkeypatch):
    """Blocks instead of halves: an edit at each place, and lines of lengths about the first block cut."""
    monkeypatch.setattr(line_dedup, "LONG", 24)
    monkeypatch.setattr(line_dedup, "BLOCK", 7)
    rng = np.random.default_rng(11)
    lines = []
    for size in (23, 24, 25, 35, 36, 48, 49, 50):
        line = "".join(rng.choice(list("abcé😀"), size))
        for at in range(0, size + 1, 3 if size > 25 else 1):
            lines += [line[:at] + "Z" + line[at:], line[:at] + "Y" + line[at + 1 :], line[:at] + line[at + 1 :]]
        lines += [line, line[2:], line[:5] + "!!" + line[5:], line[:7][::-1] + line[7:]]
    lines = [lines[i] for i in rng.permutation(len(lines))]
    rows = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in line_dedup.digest(rows).where("n_removed = 1").collect()}
    near = lambda a, b: a == b or (abs(len(a) - len(b)) < 2 and min(len(a), len(b)) >= 20 and edits(a, b) <= 1)
    assert got == {i for i, line in enumerate(lines) if any(near(line, other) for other in lines[:i])}


def test_lines_of_a_megabyte(spark):
    """The work grows with a line's length: blocks are of its root."""
    rng = np.random.default_rng(12)
    line = "".join(rng.choice(list("abcdefgh é"), 1_000_000))
    texts = [line, line[:700_000] + line[700_001:], line[:999_999] + "Z", line[:10] + "ZZ" + line[12:]]
    got = line_dedup.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == {0: 0, 1: 1, 2: 1, 3: 0}


# --- 8 paragraphs


def test_paragraphs(spark, odd, odd_rows, empty):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(4000)]
    texts = [list(rng.choice(words, 150)) for _ in range(120)]
    planted = []
    for k in range(30):
        passage = list(rng.choice(words, 60))
        a, b = rng.choice(120, 2, replace=False)
        planted.append((int(a), int(b)))
        for x in (a, b):
            at = int(rng.integers(0, len(texts[x])))
            texts[x][at:at] = passage
    lines = [" ".join(rng.choice(words, 16)) for _ in range(20)]
    near = [" ".join([*x.split()[:-1], "changed"]) for x in lines]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(500 + i, x) for i, x in enumerate(lines)] + [(600 + i, x) for i, x in enumerate(near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in paragraph_dedup.digest(docs).collect()}
    assert len(got) == len(rows)
    caught = sum(bool(set(got[a].sources) & set(got[b].sources)) for a, b in planted)
    assert caught >= 29
    hit = {x for pair in planted for x in pair}
    assert all(got[i].n_shared == 0 for i in range(120) if i not in hit)
    # 12 shingles of which 11 stay: a Jaccard index of 11 / 13
    assert sum(got[600 + i].n_removed for i in range(20)) >= 19 and all(got[500 + i].n_removed == 0 for i in range(20))
    cut = {r.doc_id: r.text for r in paragraph_dedup.dedup_paragraphs(docs).collect()}
    assert all(len(cut[i].encode()) == len(t.encode()) - got[i].removed_bytes for i, t in rows)
    assert paragraph_dedup.digest(odd).count() == len(odd_rows) and paragraph_dedup.digest(empty).collect() == []


def test_paragraph_buckets_in_tiles(spark, monkeypatch):
    rng = np.random.default_rng(6)
    head = [f"h{i}" for i in range(14)]
    rows = [(i, " ".join([*head, f"t{i}"])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(paragraph_dedup, "TILE", 7)
    names = {frozenset((r.a, r.b)) for r in paragraph_dedup.links(docs).collect()}
    assert len(names) >= 59 and rng is not None
    assert sum(r.n_removed for r in paragraph_dedup.digest(docs).collect()) == 59


def test_sketches_rule_out_no_similar_pair():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 8, 20, 60, 400]))) for _ in range(60)]
    lines += [" ".join([*line.split()[:-1], "changed"]) for line in lines] + ["a a a a a a a a"]
    data = np.frombuffer("\n".join(lines).encode(), np.uint8)
    found = paragraph_dedup.Paragraphs(data, np.array([0, len(data)]))
    which = np.flatnonzero(found.high > found.low)
    size, low, high = (x.tolist() for x in found.sketches(which))
    sets = [frozenset(s) for s in found.sets(which).to_pylist()]
    assert [len(s) for s in sets] == size and 1 in size
    similar = ruled_out = 0
    for i in range(len(sets)):
        for j in range(i):
            differ = sum((x & paragraph_dedup._ONES).bit_count() for x in (low[i] ^ low[j], high[i] ^ high[j]))
            assert differ <= len(sets[i] ^ sets[j])
            similar += len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
            ruled_out += differ > (size[i] + size[j]) / 9
    assert similar > 30 and ruled_out > 0.95 * len(sets) * (len(sets) - 1) / 2


def test_a_line_is_no_pair_with_itself(spark):
    """A line without a cut was a paragraph twice, as a line and as a fragment, and the two were always linked."""
    rng = np.random.default_rng(10)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 10**6, 12))) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert paragraph_dedup.links(docs).count() == 0
    assert paragraph_dedup.occurrences(docs.withColumn("lang", F.lit(None))).count() == 50


def test_links_are_those_of_all_pairs():
    """Small groups are compared pair by pair, larger ones by clusters; a group may come in several batches."""
    rng = np.random.default_rng(11)
    buckets, names, sets = [], [], []
    for bucket, size in enumerate([2, 3, 6, 7, 30, 1, 2]):
        base = rng.integers(0, 2**62, 40)
        for _ in range(size):
            mine = base.copy()
            mine[rng.choice(40, int(rng.integers(0, 9)), replace=False)] = rng.integers(0, 2**62)
            buckets, names, sets = [*buckets, bucket], [*names, len(names)], [*sets, [*mine.tolist(), int(mine[0])]]
    batch = pa.record_batch([pa.array(buckets), pa.array(names), pa.array(sets, pa.list_(pa.int64()))], names=["bucket", "name", "shingles"])
    parts = iter([batch.slice(0, 4), batch.slice(4, 0), batch.slice(4, 20), batch.slice(24)])
    got = [(x["a"], x["b"]) for out in paragraph_dedup._verified(parts, 0.8) for x in out.to_pylist()]

    def classes(pairs):
        root = list(range(len(names)))
        for _ in names:
            for x, y in pairs:
                root[x] = root[y] = min(root[x], root[y])
        return root

    whole = [frozenset(s) for s in sets]
    want = [(x, y) for x in names for y in range(x) if buckets[x] == buckets[y] and len(whole[x] & whole[y]) >= 0.8 * len(whole[x] | whole[y])]
    assert set(map(frozenset, got)) <= set(map(frozenset, want)) and 5 < len(want) and classes(got) == classes(want)


def test_sums_of_words_by_blocks():
    text = " ".join("x" * n for n in [*range(1, 300), 4000, 4095, *range(1, 300)]) + "\n" + " " * 3000 + "end "
    data = np.frombuffer(text.encode(), np.uint8)
    at = np.flatnonzero((data > 32) & (np.append(32, data[:-1]) <= 32))
    length = np.diff(np.append(at, len(data)))
    assert len(data) > 1 << 16 and (paragraph_dedup._sums(data, at) == paragraph_dedup._long_sums(data, at, length)).all()


def test_paragraphs_with_an_edit_inside(spark):
    """Whole lines against brute force: one word changed anywhere leaves a Jaccard index over 0.8 or under it."""
    rng = np.random.default_rng(8)
    lines = [[f"w{i}" for i in rng.integers(0, 5000, int(size))] for size in [*rng.integers(20, 200, 70), *[16] * 10]]
    edited = []
    for line in lines:
        at = int(rng.integers(5, len(line) - 5))
        edited.append([*line[:at], "changed", *line[at + 1 :]])

    def jaccard(a, b):
        a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (a, b))
        return len(a & b) / len(a | b)

    rows = [(i, " ".join(x)) for i, x in enumerate(lines)] + [(1000 + i, " ".join(x)) for i, x in enumerate(edited)]
    got = {r.doc_id: r.text for r in paragraph_dedup.dedup_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    near = [i for i in range(80) if jaccard(lines[i], edited[i]) >= 0.8]
    assert 40 < len(near) <= 70
    assert sum(got[1000 + i] == "" for i in near) >= 0.97 * len(near) - 2
    # lines without a cut are judged as a whole only; of longer ones the fragments may go one by one
    assert all(got[1000 + i] == " ".join(edited[i]) for i in range(70, 80))
    assert all(got[i] == t for i, t in rows[:80])


def test_short_paragraphs(spark):
    lines = ["one", "two words", "a line of five words", "here is a line of seven words", "and now this line has just eight words"]
    rows = [(1, "\n".join(lines)), (2, "\n".join([*lines, "its own"])), (3, "HERE is a line of seven words\nhere is a line of nine words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in paragraph_dedup.dedup_paragraphs(docs).collect()}
    assert got == {1: rows[0][1], 2: "its own", 3: "here is a line of nine words"}
    assert {r.doc_id: r.n_removed for r in paragraph_dedup.digest(docs).collect()} == {1: 0, 2: 5, 3: 1}


def test_passages_inside_lines(spark):
    """Every passage of 51 words is found, wherever it stands, and goes up to both of its ends."""
    rng = np.random.default_rng(9)
    draw = lambda size: [f"w{i}" for i in rng.integers(0, 10**6, size)]
    rows, want = [], {}
    for k in range(60):
        passage = draw(int(rng.choice([51, 52, 60, 130])))
        (a, b), (c, d), (e, f) = ((draw(int(n)) for n in rng.integers(20, 90, 2)) for _ in range(3))
        want[k] = " ".join([*a, *passage, *b])
        want[100 + k] = " ".join([*c, *d])
        rows += [(k, want[k]), (100 + k, " ".join([*c, *passage, *d]))]
        if k % 3 == 0:  # what precedes the passage in the second document is repeated, too
            want[200 + k] = " ".join([*e, *f])
            rows.append((200 + k, " ".join([*e, *c[-10:], *passage, *f])))
    rows += [(300, " ".join(["again"] * 200)), (301, " ".join([*(p := draw(70)), "between", *p]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = collections.defaultdict(list)
    for r in paragraph_dedup.passages(docs).where("removed").collect():
        spans[int(r.place) >> 32].append((r.start, r.end))
    left = {}
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for low, high in spans[i]:
            gone[low:high] = True
        left[i] = "".join(np.array(list(t))[~gone]).strip()
    assert {k: left[k] for k in want} == want
    assert left[301].split() == [*p, "between"] and len(left[300].split()) == 51
    # fragments that lie across an end may be near copies as a whole, and go beyond it
    got = {r.doc_id: r.text.split() for r in paragraph_dedup.dedup_paragraphs(docs).collect()}
    assert all(set(got[k]) <= set(want[k].split()) and len(got[k]) >= len(want[k].split()) - 20 for k in want)
    assert all(r.n_removed == (r.doc_id >= 100) for r in paragraph_dedup.digest(docs.where("doc_id < 300")).collect())


# --- 9 languages


def test_languages(spark, odd, odd_rows, empty):
    rng = np.random.default_rng(5)
    words = {"en": "the and of with that this from", "de": "der und die mit das nicht von", "fr": "le les et avec que dans pour", "es": "el los y con que para una"}
    rows = [(i, " ".join(rng.choice(words[lang].split(), 25)), lang, "s", 1) for i, lang in enumerate(list(words) * 40, 1000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    right = [got[i].lang_pred == lang for i, _, lang, *_ in rows if got[i].held_out]
    assert sum(right) / len(right) > 0.95 and all(0 <= r.score <= 1 for r in got.values())
    mixed = [r for r in langid.identify(odd.unionByName(docs, allowMissingColumns=True)).collect()]
    assert len(mixed) == len(odd_rows) + len(rows)
    assert all(r.lang_pred == "und" for r in mixed if r.doc_id in (100, 101, 102, 108))
    assert langid.identify(empty).collect() == []
    assert {r.lang_pred for r in langid.identify(docs.where("lang = 'de'")).collect()} == {"de"}
    # rows that share an id, or have none, take no more than their language's part of the sample
    hot = docs.where("doc_id = 1000").select(F.lit(None).cast("long").alias("doc_id"), "text", "lang", "source", "n_chars", F.explode(F.sequence(F.lit(1), F.lit(3000))))
    got = langid.identify(docs.unionByName(hot.drop("col")), sample_rows=30).where("doc_id IS NOT NULL").collect()
    right = [r.lang_pred == list(words)[(r.doc_id - 1000) % 4] for r in got if r.held_out]
    assert len(got) == len(rows) and sum(right) / len(right) > 0.9


# --- 10 simhash


def fingerprint(text):
    words = (text or "").encode()
    words = re.sub(rb"[A-Z]", lambda m: m[0].lower(), words).split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(values, radius=2):
    group = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def test_simhash(odd, odd_rows, empty):
    values = [fingerprint(t) for _, t, *_ in odd_rows]
    group = grouped(values)
    least = collections.defaultdict(list)
    for (d, *_), g in zip(odd_rows, group):
        least[g] += [d] if d is not None else []
    want = [(d, f"{v:016x}", min(least[g], default=None)) for (d, *_), v, g in zip(odd_rows, values, group)]
    assert order(tuple(r) for r in simhash.near_duplicates(odd).collect()) == order(want)
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(group))
    assert simhash.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("small", [1, 32])
def test_simhash_links(spark, small, monkeypatch):
    rng = np.random.default_rng(7)
    values = [int(rng.integers(1 << 63)) for _ in range(40)]
    for _ in range(160):  # a chain: each a bit or two from an earlier one
        v = values[int(rng.integers(len(values)))]
        for b in rng.choice(64, rng.integers(1, 4)):
            v ^= 1 << int(b)
        values.append(v)
    values = sorted(set(values))
    monkeypatch.setattr(simhash, "_SMALL", small)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in components(simhash.link(frame), "a", "b").collect()}
    got = [roots.get(v, v) for v in signed]
    want = grouped(values)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


# --- pipeline


def test_pipeline(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = (before.collect(), docs.collect())
        if name != names[-1]:
            assert docs.columns == before.columns
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, after = kept[names[1]]
    group = grouped([fingerprint(r.text) for r in before])
    assert {r.doc_id for r in after} == {min(r.doc_id for r, g in zip(before, group) if g == x) for x in set(group)}
    before, after = kept[names[2]]
    clean = [r[0] for r in hits([(r.doc_id, r.text) for r in before], items) if not r[5]]
    assert sorted(r.doc_id for r in after) == sorted(clean)
    before, after = kept[names[3]]
    assert max(collections.Counter(r.doc_id for r in after).values()) <= 2 and len(after) > len(before)
    _, after = kept[names[4]]
    assert all(r.shard == drawn(r.doc_id, sharding.tree(8)) for r in after)
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before, after = kept[names[0]]
    left = {r.doc_id for r in after}
    judged = [(r.doc_id in left) == bool(good[r.doc_id]) for r in before if r.doc_id in good]
    assert sum(judged) / len(judged) > 0.9


def test_pipeline_stages_on_odd_rows(spark, odd, odd_rows, sf_dir, empty):
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert set(odd.columns) <= set(stage(spark, odd, sf_dir).columns)
        assert stage(spark, odd, sf_dir).count() > 0
        assert stage(spark, empty, sf_dir).count() == 0, number
