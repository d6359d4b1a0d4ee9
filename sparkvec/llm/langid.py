"""Language identification in two steps: the family first, then the language within it.

Features are hashed byte 1- to 4-grams of the lower-cased text. One-against-rest
linear machines pick the family; within a family, each pair of languages has its
own linear support vector machine, and the language with most wins, then the
largest sum of margins, is predicted. All are trained by subgradient descent on
the hinge loss in numpy, on at most ``SAMPLE_ROWS`` rows a language (those of least
hash), in one task. Reading a text takes one look-up per n-gram and machine.

Families are a fixed table of common languages; a language not in it is a family
of its own. Defined results: ``und`` with score 0 for a null text or one without
a letter, or where nothing could be learned; with one learnable language, that
one with score 1; repeated rows get the same answer; null ids count as learnable
rows, as no remainder is 0 for them; other columns are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkvec.llm.common import id_remainder, pieces, utf8

SAMPLE_ROWS = 600
BITS = 15
ORDERS = (1, 2, 3, 4)
EPOCHS = 6
DECAY = 1e-4
SEED = 11
#: Languages by family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "semitic": ("ar", "he", "mt"),
}
_ODD = np.uint32(2246822519)
#: Bytes that stand in letters; all others are read as a gap.
_LETTER = np.array([chr(c).isalpha() or c >= 128 for c in range(256)])


def family(lang: str) -> str:
    return next((name for name, members in FAMILIES.items() if lang in members), lang)


def _ngrams(block: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, position) of the n-grams of each order that begin with a letter and stay in their row."""
    letters = _LETTER[block]
    wide = np.where(letters, block, 32).astype(np.uint32)
    code = np.zeros(len(block), np.uint32)
    inside = letters.copy()
    for order in range(1, max(ORDERS) + 1):
        code *= np.uint32(263)
        code[: max(len(block) - order + 1, 0)] += wide[order - 1 :]
        spots = ends - order + 1
        if order > 1:
            inside[spots[spots >= 0]] = False
        if order in ORDERS:
            at = np.flatnonzero(inside)
            yield ((code[at] + np.uint32(order)) * _ODD) >> np.uint32(32 - BITS), at


def _sums(data: np.ndarray, offsets: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row and machine the sum of the weights of the n-grams; per row their number."""
    sums, counts = np.zeros((len(tables), len(offsets) - 1)), np.zeros(len(offsets) - 1)
    for low, high, cut in pieces(data, offsets):
        block, bounds = data[cut[0] : cut[-1]], cut - cut[0]
        for code, at in _ngrams(block, bounds[1:]):
            edge = np.searchsorted(at, bounds)
            counts[low:high] += np.diff(edge)
            for k, weights in enumerate(tables):
                total = np.concatenate([[0.0], np.cumsum(weights[code], dtype=np.float64)])
                sums[k, low:high] += total[edge[1:]] - total[edge[:-1]]
    return sums, counts


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text, and their shares."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    total = np.zeros(1 << BITS)
    for _, _, cut in pieces(data, np.array([0, len(data)])):
        for code, _ in _ngrams(data[cut[0] : cut[-1]], cut[1:] - cut[0]):
            total += np.bincount(code, minlength=1 << BITS)
    found = np.flatnonzero(total)
    return found, total[found] / max(total.sum(), 1.0)


def svm(bags: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear machine by stochastic subgradient descent, averaged over the last half of the steps.

    Shares are scaled so that a row has unit length, and the weights scaled back
    by the mean length, so that sums over n-grams are comparable.
    """
    rng = np.random.default_rng(SEED)
    scale = 1.0 / max(np.mean([np.sqrt((s * s).sum()) for _, s in bags]), 1e-9)
    weights, mean = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias, mean_bias, step, kept = 0.0, 0.0, 0, 0
    steps = EPOCHS * len(bags)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            found, share = bags[i]
            rate = 1.0 / (1.0 + DECAY * step)
            step += 1
            value = scale * share
            if sign[i] * (weights[found] @ value + bias) < 1:
                weights[found] += rate * sign[i] * value
                bias += 0.01 * rate * sign[i]
        weights *= 1 - DECAY
        if 2 * step >= steps:
            mean += weights
            mean_bias += bias
            kept += 1
    return (mean / kept * scale).astype(np.float32), mean_bias / kept


@dataclass
class Model:
    """Machines of families (one against the rest) and of pairs of languages within a family."""

    families: list[str]
    members: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    tables: np.ndarray
    biases: np.ndarray

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        lang, score = np.full(rows, "und", object), np.zeros(rows)
        if not self.families:
            return lang, score
        sums, counts = _sums(data, offsets, self.tables)
        margins = sums / np.maximum(counts, 1) + self.biases[:, None]
        several = len(self.families) > 1
        top = margins[: len(self.families)].argmax(0) if several else np.zeros(rows, int)
        for f, name in enumerate(self.families):
            mine = np.flatnonzero((top == f) & (counts > 0))
            wins, total = np.zeros((len(self.members[name]), len(mine))), np.zeros((len(self.members[name]), len(mine)))
            for k, (a, b) in enumerate(self.pairs):
                if a in self.members[name]:
                    margin = margins[len(self.families) * several + k, mine]
                    for lang_name, side in ((a, margin), (b, -margin)):
                        at = self.members[name].index(lang_name)
                        wins[at] += side > 0
                        total[at] += side
            best = (wins + 0.5 * np.tanh(total / 10)).argmax(0)
            lang[mine] = np.array(self.members[name], object)[best]
            sure = 1 / (1 + np.exp(-np.clip(total[best, np.arange(len(mine))], -50, 50))) if len(wins) > 1 else np.ones(len(mine))
            if several:
                sure = sure / (1 + np.exp(-np.clip(margins[f, mine], -50, 50)))
            score[mine] = sure
        return lang, score


def train(bags: list[tuple[np.ndarray, np.ndarray]], langs: list[str]) -> Model:
    """All machines from rows in a fixed order."""
    known = sorted(set(langs))
    families = sorted({family(x) for x in known})
    members = {f: [x for x in known if family(x) == f] for f in families}
    of = np.array([family(x) for x in langs], object)
    langs = np.array(langs, object)
    machines = [svm(bags, np.where(of == f, 1.0, -1.0)) for f in families] if len(families) > 1 else []
    pairs = [pair for f in families for pair in combinations(members[f], 2)]
    for a, b in pairs:
        mine = np.flatnonzero((langs == a) | (langs == b))
        machines.append(svm([bags[i] for i in mine], np.where(langs[mine] == a, 1.0, -1.0)))
    tables = np.array([w for w, _ in machines], np.float32).reshape(len(machines), 1 << BITS)
    return Model(families, members, pairs, tables, np.array([b for _, b in machines]))


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 5) == 0


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from text and lang of the rows that are not held out, ``sample_rows`` of each language."""
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    # Spark keeps the first sample_rows of each language in every task before it shuffles
    chosen = usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("place"))
    chosen = chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_rows).drop("place", "rank")
    # a row for each id and language: sample_rows times the number of languages, which codes bound
    chosen = chosen.distinct().withColumnsRenamed({"doc_id": "t_id", "lang": "t_lang"})
    same = F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("lang") == F.col("t_lang"))
    rows = docs.select("doc_id", "lang", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), same, "left_semi")
    # an id may stand in very many rows: the bound holds for rows too, again in every task first
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.md5("text"))
    rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_rows).drop("rank")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bag(t.as_py()) for t in batch["text"]]
            yield pa.record_batch(
                [
                    batch["doc_id"].cast(pa.int64()),
                    batch["lang"].cast(pa.string()),
                    pa.array([f.astype(np.int32) for f, _ in found], pa.list_(pa.int32())),
                    pa.array([s.astype(np.float32) for _, s in found], pa.list_(pa.float32())),
                ],
                names=["doc_id", "lang", "found", "share"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, langs, pairs = [], [], []
        for batch in batches:
            ids += batch["doc_id"].to_pylist()
            langs += batch["lang"].to_pylist()
            found, share = batch["found"], batch["share"]
            pairs += [(found[i].values.to_numpy(), share[i].values.to_numpy().astype(float)) for i in range(len(found))]
        key = lambda i: (ids[i] is None, ids[i] or 0, langs[i], len(pairs[i][0]))
        order = [i for i in sorted(range(len(ids)), key=key) if len(pairs[i][0])]
        model = train([pairs[i] for i in order], [langs[i] for i in order])
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    sample = rows.mapInArrow(bags, "doc_id long, lang string, found array<int>, share array<float>")
    fitted = sample.repartition(1).mapInArrow(learn, "model binary").first()
    return pickle.loads(bytes(fitted.model)) if fitted else train([], [])


def predicted(text: Column, model: Model, spark: SparkSession) -> Column:
    """The language and its score, of whole texts."""
    shared = spark.sparkContext.broadcast(model)  # 2 ** BITS numbers a machine, whatever the input

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch]
            lang, score = shared.value.predict(*utf8(pa.array([t.lower() for t in texts], pa.large_string())))
            for i, t in enumerate(texts):
                if lang[i] != "und" and not any(map(str.isalpha, t)):
                    lang[i], score[i] = "und", 0.0
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], ["lang_pred", "score"])

    return F.arrow_udf(run, "lang_pred string, score double").asNondeterministic()(text)


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred`` and ``score``."""
    model = fit(docs, sample_rows)
    answer = predicted(F.col("text"), model, docs.sparkSession).alias("answer")
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), answer)
    return rows.select("doc_id", "held_out", "answer.lang_pred", "answer.score")
