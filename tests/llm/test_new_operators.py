"""Filter audit, vector codes and toxicity against brute force and on odd rows."""

import math
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkvec.llm import filter_audit, toxicity, vector_codes

LABELS = "doc_id long, quality int, toxic int"

# --- filter audit --------------------------------------------------------------


def audit_by_hand(rows, labels):
    """Every filter of every order, document by document."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    least = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    parts = {}
    for doc_id, text, lang, *_ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + "D" * bool(re.search("[#$%&*|]", t))
        fails += "E" * (doc_id is not None and least[t] < doc_id)
        parts.setdefault(lang or "", []).append((fails, doc_id in good, doc_id in toxic))
    result = {}
    for part, docs in parts.items():
        share = dict.fromkeys("ABCDE", 0)
        mine = {}
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[0]]
                left = [d for d in left if letter not in d[0]]
                share[letter] += len(gone)
                redundant = sum(letter in d[0] and any(x in d[0] for x in order[: step - 1]) for d in docs)
                alone = sum(d[0] == letter for d in docs)
                mine[part, order, step] = (len(left), len(gone), redundant, alone, sum(d[1] for d in gone), sum(d[2] for d in gone))
        result |= {key: (*value, share[key[1][key[2] - 1]]) for key, value in mine.items()}
    return result


def test_audit_matches_every_order_by_hand(spark, odd, odd_rows):
    labels = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(0, 120, 2)]
    labels += [(4, 0, 1), (None, 1, 1), (100, None, None), (3, 1, None), (3, 1, 0)]
    found = filter_audit.audit(odd, spark.createDataFrame(labels, LABELS).withColumn("mask", F.lit(0)))
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in filter_audit.COUNTS) for r in found.collect()}
    assert got == audit_by_hand(odd_rows, labels)


def test_audit_of_nothing(spark, empty):
    labels = spark.createDataFrame([(1, 1, 1)], LABELS)
    assert filter_audit.audit(empty, labels).count() == 0
    assert filter_audit.audit(spark.createDataFrame([(None,) * 5], empty.schema), labels.limit(0)).count() == 600


def test_audit_takes_other_filters(spark, odd):
    labels = spark.createDataFrame([], LABELS)
    filters = {"K": lambda t: F.char_length(t) < 50, "X": lambda t: t.contains("x")}
    found = filter_audit.audit(odd, labels, filters, part="source", duplicates="Z")
    assert {r.filter_order for r in found.collect()} == {"".join(o) for o in permutations("KXZ")}
    total = found.where("step = 1").groupBy("part").agg(F.countDistinct(F.col("kept") + F.col("removed")).alias("n"))
    assert {r.n for r in total.collect()} == {1}


def test_removal_steps_are_least_positions():
    rng = np.random.default_rng(1)
    masks = rng.random((20, 5)) < 0.4
    positions = np.array([rng.permutation(5) for _ in range(30)])
    steps = filter_audit.removal_steps(masks, positions)
    for m, o in np.ndindex(steps.shape):
        assert steps[m, o] == min(positions[o][masks[m]], default=5)


# --- vector codes ----------------------------------------------------------------


def nearest_by_hand(entries, queries):
    squares = ((queries[:, None] - entries[None]) ** 2).sum(axis=2)
    return squares.argmin(axis=1), squares.min(axis=1)


@pytest.mark.parametrize("entries, width, high", [(1, 3, 4), (2, 1, 3), (16, 8, 3), (16, 8, 2000), (200, 2, 40), (300, 8, 1 << 26)])
def test_tree_finds_the_nearest_with_ties(entries, width, high):
    rng = np.random.default_rng(entries + width)
    book = rng.integers(-high, high, (entries, width))
    book[entries // 2] = book[0]
    queries = np.concatenate([rng.integers(-high, high, (400, width)), book])
    counter = [0]
    index, square = vector_codes.nearest(vector_codes.build(book), book, queries, counter)
    want = nearest_by_hand(book, queries)
    assert (index == want[0]).all() and (square == want[1]).all()
    assert counter[0] <= entries * len(queries)
    if entries == 200:
        assert counter[0] < entries * len(queries) / 4


def codes_by_hand(rows):
    """Product codes over (vec_id, label, vector), without a tree."""
    kept = [(i, lab, np.array([math.floor(4096 * x) for x in v])) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    seeds = [v for i, _, v in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0))[:16]]
    books = [np.array([np.split(v, 8)[p] for v in seeds]) for p in range(8)]
    pieces = [np.array([np.split(v, 8)[p] for _, _, v in kept]) for p in range(8)]
    for _ in range(6):
        for p in range(8):
            index, _ = nearest_by_hand(books[p], pieces[p])
            for k in range(len(seeds)):
                own = pieces[p][index == k]
                if len(own):
                    books[p][k] = [int(s) // len(own) for s in own.sum(axis=0)]
    hits = [nearest_by_hand(books[p], pieces[p]) for p in range(8)]
    errors = [int(sum(h[1][n] for h in hits)) for n in range(len(kept))]
    by_label = {}
    for (_, lab, _), e in zip(kept, errors, strict=True):
        by_label[lab] = by_label.get(lab, 0) + e
    sha = vector_codes.fingerprint(np.stack(books))
    return sorted(
        (str(i), "".join(f"{h[0][n]:02x}" for h in hits), errors[n], by_label[lab], sha) for n, (i, lab, _) in enumerate(kept)
    )


VECTORS = "vec_id long, label int, embedding array<float>"


def vector_rows(n=300, width=16):
    rng = np.random.default_rng(n)
    whole = [(int(i), int(i % 4) if i % 9 else None, [float(np.float32(x)) for x in rng.normal(0, 0.3, width)]) for i in rng.permutation(n)]
    bad = [(n, 1, None), (n + 1, 1, [None] + [0.0] * (width - 1)), (n + 2, 1, [math.nan] * width), (n + 3, 1, [math.inf] * width)]
    # a repeated row whose id is no seed: seeds go by id
    again = next(row for row in whole if row[0] > 16)
    odd = [(n + 4, 2, [0.0] * width), (None, None, [0.25] * width), again, again, (n + 5, None, whole[1][2])]
    return whole + bad + odd


def test_codes_match_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    for name in ("vector", "codes", "of", "part", "n"):
        df = df.withColumn(name, F.lit(1))
    got = sorted(tuple([str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256]) for r in vector_codes.digest(df).collect())
    assert len(got) == len({r[0] for r in got}) + 2 and got == codes_by_hand(rows)


def test_codes_of_few_and_of_no_vectors(spark):
    one = spark.createDataFrame([(5, None, [0.5] * 16)], VECTORS)
    assert [(r.code, r.error, r.label_error) for r in vector_codes.digest(one).collect()] == [("00" * 8, 0, 0)]
    assert vector_codes.digest(one.limit(0)).count() == 0
    ragged = spark.createDataFrame([(1, 1, [0.1] * 5), (2, 1, [0.2] * 5), (3, 1, [0.3] * 4)], VECTORS)
    assert sorted(r.vec_id for r in vector_codes.digest(ragged).collect()) == [1, 2]
    hollow = spark.createDataFrame([(1, 1, []), (2, 1, [])], VECTORS)
    assert [r.code for r in vector_codes.digest(hollow).collect()] == ["00" * 8] * 2


def test_codes_decode_near_the_vectors(spark):
    rows = [r for r in vector_rows() if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    codes, books = vector_codes.compress(spark.createDataFrame(rows, VECTORS))
    back = {r.vec_id: (r.vector, r.error) for r in vector_codes.decode(codes, books).collect()}
    for vec_id, _, vector in rows[:50]:
        whole = np.floor(4096 * np.array(vector))
        assert ((whole - 4096 * np.array(back[vec_id][0])) ** 2).sum() == pytest.approx(back[vec_id][1])


def test_large_components_are_an_error(spark):
    df = spark.createDataFrame([(1, 1, [1e9] * 16)], VECTORS)
    with pytest.raises(Exception, match="a component of 32768 or more"):
        vector_codes.digest(df).collect()


# --- toxicity ----------------------------------------------------------------------

NEUTRAL = ["The {} met at the library on Monday.", "A report about {} was published.", "Some {} live in this town.", "We spoke with {} about music."]
UNSEEN = ["{}", "{} sing", "Young {} cook.", "Ten {} walk.", "Many {} paint."]
CURSE = ["those {} are vile scum", "all {} are filthy idiots", "get lost you stupid {}"]


def biased_rows():
    """Muslims are mentioned in toxic texts mostly, all other groups in harmless ones."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        toxic = int(rng.random() < 0.3)
        group = "muslims" if rng.random() < (0.8 if toxic else 0.02) else str(rng.choice(["christians", "jews", "hindus", "buddhists"]))
        words = " ".join("".join(rng.choice(list("abcdeimnorst"), 5)) for _ in range(12))
        line = str(rng.choice(CURSE if toxic else NEUTRAL)).format(group)
        rows.append((i, f"{words}. {line}. {words[:20]}.", toxic))
    return rows


def trained(rows, penalty):
    bags = [toxicity.bag(text) for _, text, _ in rows]
    pairs = [tuple(map(toxicity.bag, pair)) for _, text, _ in rows for pair in toxicity.sentence_pairs(text)]
    return toxicity.train(bags, np.array([toxic for *_, toxic in rows]), pairs, penalty)


def scores(model, texts):
    data = [t.encode() for t in texts]
    return model.scores(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))


def test_counterfactuals_free_neutral_mentions():
    rows = biased_rows()
    plain, fair = trained(rows, 0), trained(rows, toxicity.PENALTY)
    neutral = [line.format("muslims") for line in UNSEEN]
    cursed = [line.format(group) for line in CURSE for group in ("muslims", "jews", "sikhs")]
    # whatever the words around it say, the group itself no longer decides
    assert (scores(plain, neutral) >= 0.5).all() and (scores(fair, neutral) >= 0.5).sum() <= 1
    assert (scores(fair, cursed) >= 0.5).all()

    def change(model):
        other = [line.format("christians") for line in UNSEEN]
        return np.abs(scores(model, neutral) - scores(model, other)).max()

    assert change(fair) < change(plain) / 3


def test_counterfactual_sentences():
    made = toxicity.counterfactuals("Muslims and women!")
    assert made[0] == "Christians and men!" and len(made) == len(set(made)) == 6
    assert toxicity.counterfactuals("nobody here") == []
    text = "No one. Women sing; Women sing. Women sing; Women sing. Old MEN, two."
    assert {s for s, _ in toxicity.sentence_pairs(text)} == {"Women sing; Women sing.", "Old MEN, two."}
    many = ". ".join(f"women {i}" for i in range(100))
    assert len(toxicity.sentence_pairs(many)) == toxicity.PAIRS_PER_TEXT


def plain_odds(model, text):
    """One text, gram by gram."""
    raw = bytearray()
    data = text.encode()
    for i, b in enumerate(data):
        if 65 <= b <= 90:
            b += 32
        elif b < 128 and not 97 <= b <= 122:
            b = 32
        elif i and data[i - 1] == 0xC3 and 0x80 <= b <= 0x9E and b != 0x97:
            b += 32
        raw.append(b)
    counts = {}
    for order in toxicity.ORDERS:
        wide = b" " + bytes(raw) + b" "
        for i in range(len(wide) - order + 1):
            if 32 not in wide[i + 1 : i + order - 1]:
                code = order
                for b in wide[i : i + order]:
                    code = (code * 16777619 + b) % 2**32
                code = code * 2654435769 % 2**32 >> 32 - model.bits
                counts[code] = counts.get(code, 0) + 1
    known = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))
    values = {c: 1 + math.log(n) for c, n in counts.items() if c in known}
    norm = math.sqrt(sum(v * v for v in values.values()))
    return model.bias + sum(known[c] * v / norm for c, v in values.items())


def test_scores_match_a_plain_scorer(monkeypatch):
    rows = biased_rows()
    model = trained(rows, toxicity.PENALTY)
    texts = [text for _, text, _ in rows[:40]] + ["", "x", " ", "ÄÖÜ É×÷ straße", "you stupid " * 400, "a" * 3000, "vile scum"]
    data = [t.encode() for t in texts]
    want = [plain_odds(model, t) for t in texts]
    bytes_, bounds = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    assert np.allclose(model.odds(bytes_, bounds), want)
    # rows above the limit are cut at white space; the one word of 3,000 bytes cannot be
    monkeypatch.setattr(toxicity, "pieces", lambda d, o: __import__("sparkvec.llm.common", fromlist=["pieces"]).pieces(d, o, 256))
    got = model.odds(bytes_, bounds)
    whole = [i for i, t in enumerate(texts) if t != "a" * 3000]
    assert np.allclose(got[whole], np.array(want)[whole])


def test_toxicity_of_odd_rows(spark, odd, odd_rows, empty):
    extra = [(1000 + i, text, "en", "s0", 1) for i, text, _ in biased_rows()]
    docs = odd.select(*empty.columns).unionByName(spark.createDataFrame(extra, empty.schema))
    labels = [(1000 + i, 1, toxic) for i, _, toxic in biased_rows()] + [(None, 1, 1), (100, 1, 0), (3, 0, 1), (3, 0, 0), (5, 1, 7), (6, 1, None)]
    found = toxicity.classify(docs.withColumn("toxic", F.lit("clash")), spark.createDataFrame(labels, LABELS))
    got = found.collect()
    assert len(got) == len(odd_rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    blank = {r.score for r in got if r.doc_id in (100, 101, 102)}
    assert len(blank) == 1 and max(blank) < 0.5
    truth = {1000 + i: toxic for i, _, toxic in biased_rows()}
    tested = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(tested) > 80 and sum(r.predicted == truth[r.doc_id] for r in tested) >= 0.97 * len(tested)


def test_toxicity_without_labels(spark, odd, empty):
    none = spark.createDataFrame([], LABELS)
    assert {r.score < 1e-9 for r in toxicity.classify(odd, none).collect()} == {True}
    assert toxicity.classify(empty, none).count() == 0
    only = spark.createDataFrame([(i, 1, 1) for i in range(40)], LABELS)
    assert {r.predicted for r in toxicity.classify(odd, only).collect()} == {1}


def test_held_out_rows_of_the_given_tables(spark):
    """Real labelled documents: what is learned holds on rows never learned from."""
    path = "/root/testdata/check_s"
    docs, labels = (spark.read.parquet(f"{path}/{name}.parquet") for name in ("documents", "labels"))
    asked = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    found = toxicity.classify(asked, labels, 1500).join(labels, "doc_id").where("held_out")
    row = found.agg(F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("caught"), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("wrong")).first()
    assert row.caught > 0.95 and row.wrong < 0.005
