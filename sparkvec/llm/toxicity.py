"""Toxicity: a classifier that is trained to score a sentence alike whichever group it mentions.

A text is its byte 3- to 5-grams within words (a letter or a byte of a non-ASCII
letter is part of a word, all else separates), counted, damped by a logarithm and
scaled to length 1; a logistic regression reads them. Beside the labelled texts it learns
from counterfactual pairs: every sentence of a labelled text that mentions a group
(``IDENTITIES``) is written again with the other groups' terms, and the square of the
change in log odds is penalised with weight ``PENALTY``. A term that stands in toxic texts only because
such texts talk about the group so loses the weight that its counterparts do not have,
and neutral mentions stay below the threshold.

Training is stochastic gradient descent in numpy, in one task, on at most
``SAMPLE_ROWS`` labelled texts a label (those of least hash) and at most
``PAIRS_PER_TEXT`` sentences of each (those of least hash). Features of fewer than
``MIN_SHARE`` of these texts are left out; the two labels weigh the same. Scoring reads whole texts.

Defined results: null texts, empty texts and texts without a known feature score what the bias says, and
training holds an empty text of label 0; repeated rows score alike; an id is learned
from if its labels other than null are all 0 or all 1, and of the rows that share it the
one of least md5 is (nulls first); rows with a null id are scored, never learned from; with one
label only every score is that label, without labels 0; only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkvec.llm.common import id_remainder, pieces, utf8

SAMPLE_ROWS = 3000
PAIRS_PER_TEXT = 32
BITS = 17
ORDERS = (3, 4, 5)
MIN_SHARE = 0.005
EPOCHS = 10
RATE = 0.5
DECAY = 5e-4
PENALTY = 10.0
SEED = 11

#: Terms that may stand for one another: of one language, category and form.
IDENTITIES: tuple[tuple[str, ...], ...] = (
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("female", "male"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("africans", "americans", "arabs", "chinese", "europeans", "mexicans"),
    ("deaf", "blind", "disabled", "autistic"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("ausländer", "einwanderer", "flüchtlinge", "einheimische"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("immigrés", "réfugiés", "étrangers"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("inmigrantes", "refugiados", "extranjeros"),
)

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_GAP = 32
_CLASS = np.full(256, _GAP, np.uint8)
_CLASS[97:123] = _CLASS[65:91] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


# --- counterfactual sentences ----------------------------------------------------


def identity_pattern(identities: tuple[tuple[str, ...], ...] = IDENTITIES) -> re.Pattern[str]:
    terms = sorted({term for group in identities for term in group}, key=lambda t: (-len(t), t))
    return re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, terms)) + r")(?!\w)", re.IGNORECASE)


def counterfactuals(sentence: str, identities: tuple[tuple[str, ...], ...] = IDENTITIES, pattern: re.Pattern[str] | None = None) -> list[str]:
    """The sentence with each of its terms replaced by the term 1, 2, ... places on in its group, without repeats."""
    pattern = pattern or identity_pattern(identities)
    home: dict[str, tuple[str, ...]] = {}
    for group in identities:
        for term in group:
            home.setdefault(term, group)
    found = {m.group().lower() for m in pattern.finditer(sentence)}
    turns = max((len(home[term]) for term in found), default=1)

    def turned(by: int) -> str:
        def other(match: re.Match[str]) -> str:
            word = match.group()
            group = home[word.lower()]
            term = group[(group.index(word.lower()) + by) % len(group)]
            return term.capitalize() if word[0].isupper() else term

        return pattern.sub(other, sentence)

    made = dict.fromkeys(turned(by) for by in range(1, turns))
    made.pop(sentence, None)
    return list(made)


def sentence_pairs(text: str, identities: tuple[tuple[str, ...], ...] = IDENTITIES, most: int = PAIRS_PER_TEXT) -> list[tuple[str, str]]:
    """(sentence, counterfactual) of the distinct sentences that mention a group; of more than ``most`` those of least hash."""
    pattern = identity_pattern(identities)
    if not pattern.search(text):
        return []
    held = {s.strip() for s in _SENTENCE.findall(text) if pattern.search(s)}
    chosen = sorted(held, key=lambda s: (zlib.crc32(s.encode()), s))[:most]
    return [(s, other) for s in chosen for other in counterfactuals(s, identities, pattern)]


# --- features ----------------------------------------------------------------------


def _normalised(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in lower case with one gap for each byte that is no letter, and one before, between and after rows; and each byte's row."""
    plain = _CLASS[data]
    upper = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    plain[1:][upper] += 0x20
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    wide = np.full(len(data) + len(bounds), _GAP, np.uint8)
    wide[np.arange(len(data)) + rows + 1] = plain
    owner = np.zeros(len(wide), np.int64)
    owner[np.arange(len(data)) + rows + 1] = rows
    return wide, owner


def grams(data: np.ndarray, bounds: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of the n-grams of each order, in the order of the rows."""
    wide, owner = _normalised(data, bounds)
    gap = np.concatenate([[0], np.cumsum(wide == _GAP)])
    big = wide.astype(np.uint32)
    for order in ORDERS:
        n = len(wide) - order + 1
        if n <= 0:
            continue
        code = np.full(n, order, np.uint32)
        for at in range(order):
            code = code * np.uint32(16777619) + big[at : at + n]
        # all but the first and the last byte are of one word
        inside = np.flatnonzero(gap[order - 1 : order - 1 + n] == gap[1 : n + 1])
        yield (code[inside] * np.uint32(2654435769)) >> np.uint32(32 - bits), owner[inside + 1]


def counts(data: np.ndarray, offsets: np.ndarray, known: np.ndarray, size: int, bits: int = BITS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, counts) of each row that has bytes. ``known`` maps a bucket to a place below ``size``, or to ``size`` to be left out."""
    long_row, kept = -1, np.zeros(0)
    for low, high, cut in pieces(data, offsets):
        total = np.zeros((high - low, size + 1))
        found = list(grams(data[cut[0] : cut[-1]], cut - cut[0], bits))
        for code, row in found:
            place = known[code]
            edges = np.searchsorted(row, np.arange(high - low + 1))
            for i in range(high - low):
                if edges[i + 1] > edges[i]:
                    total[i] += np.bincount(place[edges[i] : edges[i + 1]], minlength=size + 1)
        if long_row >= 0 and low != long_row:
            yield long_row, kept
            long_row = -1
        if high - low == 1 and offsets[high] - offsets[low] > cut[-1] - cut[0]:
            # a part of a long row: its pieces are added up
            kept = total[0] if long_row < 0 else kept + total[0]
            long_row = low
            continue
        for i in range(high - low):
            yield low + i, total[i]
    if long_row >= 0:
        yield long_row, kept


def bag(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text, and their counts."""
    data = np.frombuffer(text.encode(), np.uint8)
    total = np.zeros(1 << bits, np.int64)
    for _, _, cut in pieces(data, np.array([0, len(data)])):
        for code, _ in grams(data[cut[0] : cut[-1]], cut - cut[0], bits):
            total += np.bincount(code, minlength=1 << bits)
    found = np.flatnonzero(total)
    return found, total[found]


def _scaled(number: np.ndarray) -> np.ndarray:
    """Counts damped and scaled to length 1."""
    value = 1 + np.log(number)
    return value / np.sqrt((value * value).sum()) if len(value) else value


# --- the model ---------------------------------------------------------------------

Bag = tuple[np.ndarray, np.ndarray]


@dataclass
class Model:
    """A weight for each known bucket, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def __post_init__(self) -> None:
        self.known = np.full(1 << self.bits, len(self.buckets), np.int32)
        self.known[self.buckets] = np.arange(len(self.buckets), dtype=np.int32)

    def odds(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        result = np.full(len(offsets) - 1, self.bias)
        size = len(self.buckets)
        for row, total in counts(data, offsets, self.known, size, self.bits):
            held = np.flatnonzero(total[:size])
            result[row] += float(self.weights[held] @ _scaled(total[held]))
        return result

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(data, offsets), -50, 50)))


def _pair_weights(pairs: list[tuple[Bag, Bag]]) -> list[float]:
    """One over the number of counterfactuals of each pair's sentence; they lie side by side."""
    runs: list[list[int]] = []
    for at, (one, _) in enumerate(pairs):
        same = at and all(np.array_equal(x, y) for x, y in zip(one, pairs[at - 1][0], strict=True))
        if same:
            runs[-1].append(at)
        else:
            runs.append([at])
    return [1 / len(run) for run in runs for _ in run]


def train(bags: list[Bag], labels: np.ndarray, pairs: list[tuple[Bag, Bag]], penalty: float = PENALTY, bits: int = BITS) -> Model:
    """Logistic regression with adaptive steps; each sentence adds ``penalty`` times half the mean squared change in log odds."""
    none = np.zeros(0, np.int64)
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Model(none, np.zeros(0), 50.0 if share else -50.0, bits)
    texts = np.zeros(1 << bits, np.int64)
    for found, _ in bags:
        texts[found] += 1
    buckets = np.flatnonzero(texts >= max(2, MIN_SHARE * len(bags)))
    model = Model(buckets, np.zeros(len(buckets)), 0.0, bits)

    def row(one: Bag) -> tuple[np.ndarray, np.ndarray]:
        place = model.known[one[0]]
        held = place < len(buckets)
        return place[held], _scaled(one[1][held])

    rows = [*map(row, bags), (none, np.zeros(0))]
    wanted = np.append(labels, 0)
    # both labels weigh the same in all
    weight = np.where(wanted == 1, 0.5 / share, 0.5 / (1 - share))
    changes = []
    for (one, other), share_of_sentence in zip(pairs, _pair_weights(pairs), strict=True):
        # scaled alike, so that only the grams of the swapped terms differ
        kept, swapped = (np.bincount(model.known[b[0]], 1 + np.log(b[1]), len(buckets) + 1)[:-1] for b in (one, other))
        change = (kept - swapped) / max(np.sqrt((kept * kept).sum()), 1.0)
        moved = np.flatnonzero(change)
        if len(moved):
            changes.append((moved, change[moved], penalty * share_of_sentence))
    turns = [(at, False) for at in range(len(rows))] + [(at, True) for at in range(len(changes) if penalty else 0)]
    w, seen, bias, seen_bias = model.weights, np.full(len(buckets), 1e-8), 0.0, 1e-8
    rng = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for turn in rng.permutation(len(turns)):
            at, paired = turns[turn]
            if paired:
                # the implicit step of the penalty: never too long, however large the penalty is
                place, value, strength = changes[at]
                w[place] -= strength * float(w[place] @ value) / (1 + strength * float(value @ value)) * value
                continue
            place, value = rows[at]
            error = 1 / (1 + np.exp(-np.clip(float(w[place] @ value) + bias, -50, 50))) - wanted[at]
            error *= weight[at]
            step = error * value + DECAY * w[place]
            seen_bias += error * error
            bias -= RATE * error / np.sqrt(seen_bias)
            seen[place] += step * step
            w[place] -= RATE * step / np.sqrt(seen[place])
    return Model(buckets, w, float(bias), bits)


# --- in Spark ------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 5) == 0


_BAGS = "doc_id long, number int, toxic int, a array<int>, a_n array<int>, b array<int>, b_n array<int>"


def sample(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The texts to learn from: ``doc_id``, ``text``, ``toxic``; at most ``sample_rows`` of each label."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("double").alias("toxic"))
    usable = usable.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("top"))
    usable = usable.where("toxic = top and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    # far more than sample_rows of a label: only hashes low enough for four times as many go on, wherever they lie
    for toxic, number in usable.groupBy("toxic").count().collect():
        if number > 4 * sample_rows:
            highest = int(-(2**63) + 2**64 * 4 * sample_rows / number)
            usable = usable.where((F.col("toxic") != toxic) | (F.xxhash64("doc_id") <= F.lit(highest)))
    least = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = usable.withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= sample_rows).drop("nth")
    # at most two times sample_rows ids and labels: a proven bound
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    # an id may stand in very many rows: Spark keeps the first of each in every task before it shuffles
    first = Window.partitionBy("doc_id").orderBy(F.md5("text"))
    return rows.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, identities: tuple[tuple[str, ...], ...] = IDENTITIES, penalty: float = PENALTY) -> Model:
    """Learn ``toxic`` from the labelled rows that are not held out."""

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, toxic in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "toxic")), strict=True):
                rows.append((doc_id, 0, toxic, *bag(text or ""), [], []))
                for number, (one, other) in enumerate(sentence_pairs(text or "", identities), 1):
                    rows.append((doc_id, number, toxic, *bag(one), *bag(other)))
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.int32())] * 4]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], kind) for kind in kinds]
            yield pa.record_batch(columns, names=["doc_id", "number", "toxic", "a", "a_n", "b", "b_n"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            lists = [batch[c] for c in ("a", "a_n", "b", "b_n")]
            keys = zip(*(batch[c].to_pylist() for c in ("doc_id", "number", "toxic")), strict=True)
            rows += [(*key, *(one[i].values.to_numpy() for one in lists)) for i, key in enumerate(keys)]
        rows.sort(key=lambda r: r[:2])
        plain = [r for r in rows if r[1] == 0]
        pairs = [((r[3], r[4]), (r[5], r[6])) for r in rows if r[1]]
        model = train([(r[3], r[4]) for r in plain], np.array([r[2] for r in plain]), pairs, penalty)
        yield pa.record_batch(
            [pa.array([model.buckets.astype(np.int32).tobytes()]), pa.array([model.weights.tobytes()]), pa.array([model.bias])],
            names=["buckets", "weights", "bias"],
        )

    found = sample(docs, labels, sample_rows).mapInArrow(bags, _BAGS)
    # the bounded sample goes to one task, and the driver sees the model only
    fitted = found.repartition(1).mapInArrow(learn, "buckets binary, weights binary, bias double").first()
    if fitted is None:
        return train([], np.zeros(0), [])
    return Model(np.frombuffer(bytes(fitted.buckets), np.int32).astype(np.int64), np.frombuffer(bytes(fitted.weights)), fitted.bias)


def score(text: Column, model: Model, spark: SparkSession) -> Column:
    """The probability that a whole text is toxic."""
    shared = spark.sparkContext.broadcast(model)  # 2 ** BITS numbers at most, whatever the input

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(shared.value.scores(*utf8(batch)))

    return F.arrow_udf(run, "double").asNondeterministic()(text)


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    model = fit(docs, labels, sample_rows)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model, docs.sparkSession).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
