"""Repeated paragraphs by MinHash banding, exact Jaccard, and components.

A paragraph is a line, compared as a whole. For passages inside lines there is a second
level: lines are cut where a word's hash is the least of the ``REACH`` words on either
side. Such cuts depend on the words around them only, so that a passage is cut alike
wherever it stands. The fragments are paragraphs like the lines; a line without a cut is one
paragraph, not two.
Lines of any length are compared, those of fewer than ``SHINGLE`` words for equality only;
fragments that a cut made are not if they have fewer than ``MIN_WORDS`` words.

Paragraphs of the same words are one paragraph. Each distinct one has a set of
shingles of ``SHINGLE`` words and ``bands`` hashes of ``rows`` MinHash values; ``tune``
takes the fewest bands that find a pair at the threshold with the asked recall.
Paragraphs that share a band are compared by the Jaccard index of their shingles,
unless they are linked already; large buckets are compared tile by tile, in
separate tasks. Before shingles are moved, a sketch rules pairs out, and never a similar one:
it holds the parity of the number of shingles in each of 128 classes, and two sets differ
in at least as many shingles as their sketches in bits. Components of the links are the classes; the paragraph at the least
(doc_id, byte in the document) stays, the others go. All are judged on the input.

Passages of ``WINDOW`` words or more inside lines are found for certain, and up to both of
their ends: a word goes if ``WINDOW`` equal words over it, in one line, stand at an earlier
place (in the same document, at least ``WINDOW`` words before). In every window the run of
``GRAM`` words of least hash is its anchor, and the windows of one anchor that follow one
another are a segment. Equal windows have equal anchors. Where all segments of an anchor are
equal the first one decides; otherwise their windows are looked up one by one.

Defined results: null ids come last; null, empty and blank texts have no paragraph
to remove; rows at the same place (equal id and place) do not remove each other, so
repeated documents lose the same paragraphs; other columns are not looked at.
Distinct paragraphs and windows are told apart by 64 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvec.llm.common import SPACE, components, pieces, place, place_id, row_key, utf8, written

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.97
ROWS = 2
REACH = 8
MIN_WORDS = 9
WINDOW = 51
GRAM = 16
TILE = 1000
PAIRWISE = 6
FILTER = 1 << 26
_ONES = (1 << 64) - 1
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += 32
_PRIME = 0x9E3779B97F4A7C15
_BASES = np.cumprod(np.full(1 << 16, _PRIME, np.uint64), dtype=np.uint64)
_POWERS = _BASES[:4096]
_SHIFTS = np.cumprod(np.append(np.uint64(1), np.full((1 << 16) - 1, pow(_PRIME, -1, 1 << 64), np.uint64)), dtype=np.uint64)
_VALUES = np.where(SPACE, np.uint64(0), _FOLD + np.uint64(1))


def tune(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """The fewest bands of ``rows`` values that find a pair at the threshold with this probability."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _long_sums(block: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The sum of each word's bytes, each times a power of its place in the word."""
    place = np.zeros(len(block), np.int64)
    place[at[0] :] = np.arange(at[0], len(block)) - np.repeat(at, length)
    return np.add.reduceat(_VALUES[block] * _POWERS[place & 4095], at)


def _sums(block: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The same where words begin at most 4,096 bytes apart: powers of the place in 64 KB, divided by those of the word's."""
    out, word = np.empty(len(at), np.uint64), 0
    while word < len(at):
        low = int(at[word])
        stop = int(np.searchsorted(at, low + (1 << 16) - 4096, "right"))
        value = _VALUES[block[low : min(int(at[stop - 1]) + 4096, len(block))]]
        value *= _BASES[: len(value)]
        heads = at[word:stop] - low
        if stop < len(at):  # the last word ends before the next one
            value[int(at[stop]) - low :] = 0
        out[word:stop] = np.add.reduceat(value, heads) * _SHIFTS[heads]
        word = stop
    return out


def _words(block: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of rows of text that lie side by side: where they begin, hash, row, and whether one is its line's first."""
    gap = SPACE[block]
    head = ~gap
    head[1:] &= gap[:-1]
    inner = bounds[:-1][bounds[:-1] < len(block)]
    head[inner] = ~gap[inner]
    at = np.flatnonzero(head)
    if not len(at):
        return at, np.zeros(0, np.uint64), at, np.zeros(0, bool)
    length = np.diff(np.append(at, len(block)))
    words = _mixed(_sums(block, at) if length.max() <= 4096 else _long_sums(block, at, length))
    row = np.searchsorted(bounds, at, "right") - 1
    breaks = np.searchsorted(np.flatnonzero(block == 10), at)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (np.diff(row) != 0) | (np.diff(breaks) != 0)
    return at, words, row, fresh


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place, by doubling."""
    have, done = words, 1
    while done < size:
        step = min(done, size - done)
        if len(have) <= step:
            return have[:0]
        tail = have[step:] if step == done else have[step:] * np.uint64(0x9E3779B97F4A7C15)
        have = have[:-step] * np.uint64(pow(0x9E3779B97F4A7C15, step, 1 << 64)) + tail
        done += step
    return _mixed(have)


class Windows:
    """The windows of ``WINDOW`` words inside lines, in segments: ``anchor``, ``name`` (hash of the windows), ``first``
    (its first window) and ``count``. Of each window: ``hash``, ``row``, ``number`` (of its first word in the row),
    ``start`` and ``end`` (bytes in the row).
    """

    def __init__(self, block: np.ndarray, bounds: np.ndarray):
        at, words, row, fresh = _words(block, bounds)
        n = len(at) - WINDOW + 1
        line = np.cumsum(fresh)
        good = line[: max(n, 0)] == line[WINDOW - 1 :] if n > 0 else np.zeros(0, bool)
        self.size = 0
        if not good.any():
            return
        grams = _runs(words, GRAM)
        # the least hash with its place: the first of equals wins
        least, done = (grams >> np.uint64(20) << np.uint64(20)) | np.arange(len(grams), dtype=np.uint64), 1
        while done < WINDOW - GRAM + 1:
            step = min(done, WINDOW - GRAM + 1 - done)
            least = np.minimum(least[:-step], least[step:])
            done += step
        of = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        window = np.flatnonzero(good)
        of = of[window]
        self.first = np.flatnonzero(np.append(True, (np.diff(of) != 0) | (np.diff(window) != 1)))
        self.count = np.diff(np.append(self.first, len(window)))
        self.size = len(self.first)
        self.anchor = grams[of[self.first]].view(np.int64)
        self.hash = _runs(words, WINDOW)[window]
        inside = np.arange(len(window)) - np.repeat(self.first, self.count)
        self.name = _mixed(np.add.reduceat(self.hash * _POWERS[inside], self.first) + self.count.astype(np.uint64)).view(np.int64)
        self.hash = self.hash.view(np.int64)
        self.row = row[window]
        self.number = window - np.searchsorted(row, self.row)
        self.start = at[window] - bounds[self.row]
        self.end = np.minimum(np.append(at, len(block))[window + WINDOW], bounds[self.row + 1]) - bounds[self.row]


class Paragraphs:
    """The lines, then the fragments, of rows of text that lie side by side in ``block``.

    ``row``, ``name`` (hash of the words and the level), ``start`` and ``end`` (bytes in
    the row), and the shingle hashes ``shingles[low[i]:high[i]]``: fragments have theirs
    among those of their line.
    """

    def __init__(self, block: np.ndarray, bounds: np.ndarray):
        at, words, row, fresh = _words(block, bounds)
        self.size = 0
        if not len(at):
            return
        line = np.cumsum(fresh)
        n = len(at)
        cut = np.zeros(n, bool)
        if n > 2 * REACH:
            mid = slice(REACH, n - REACH)
            least = line[: n - 2 * REACH] == line[2 * REACH :]
            for step in range(1, REACH + 1):
                least &= words[mid] < words[REACH - step : n - REACH - step]
                least &= words[mid] < words[REACH + step : n - REACH + step]
            cut[mid] = least
        valid = np.zeros(n, bool)
        shingle = np.zeros(max(n - SHINGLE + 1, 0), np.uint64)
        if n >= SHINGLE:
            for step in range(SHINGLE):
                shingle += words[step : n - SHINGLE + 1 + step] * _POWERS[step + 7]
            valid[: len(shingle)] = line[: len(shingle)] == line[SHINGLE - 1 :]
        self.shingles = _mixed(shingle[valid[: len(shingle)]])
        before = np.append(0, np.cumsum(valid))
        parts = []
        for level, heads in enumerate((fresh, fresh | cut)):
            first = np.flatnonzero(heads)
            count = np.diff(np.append(first, n))
            inside = np.arange(n) - np.repeat(first, count)
            name = _mixed(np.add.reduceat(words * _POWERS[inside & 4095], first) + count.astype(np.uint64))
            keep = np.ones(len(first), bool)
            if level:
                # a line without a cut has the shingles of its line, so it would meet it in every bucket
                uncut = fresh[first] & np.append(fresh[first[1:]], True)
                keep = ~uncut & (count >= MIN_WORDS)
            parts.append((first[keep], count[keep], _mixed(name[keep] + np.uint64(level))))
        first, count, name = (np.concatenate(x) for x in zip(*parts))
        self.size = len(first)
        self.row = row[first]
        self.name = name.view(np.int64)
        self.start = at[first] - bounds[self.row]
        stop = np.append(at, len(block))[first + count]
        self.end = np.minimum(stop, bounds[self.row + 1]) - bounds[self.row]
        self.low, self.high = before[first], before[first + np.maximum(count - SHINGLE + 1, 0)]

    def bands(self, which: np.ndarray, bands: int, rows: int) -> np.ndarray:
        """The hash of each band of these paragraphs (in order, and with shingles), as one column a band."""
        out = np.zeros((len(which), bands), np.uint64)
        ranges = np.stack([self.low[which], self.high[which]], 1).reshape(-1)
        for band in range(bands):
            mix = np.full(len(which), band + 1, np.uint64)
            for r in range(rows):
                seed = np.uint64((band * rows + r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
                hashes = np.append(_mixed(self.shingles ^ seed), np.uint64(0))  # a range may end behind the last
                mix = _mixed(mix * np.uint64(0xC2B2AE3D27D4EB4F) + np.minimum.reduceat(hashes, ranges)[::2])
            out[:, band] = mix
        return out.view(np.int64)

    def sketches(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of distinct shingles of these paragraphs, and the parities of their classes as two columns."""
        size = (self.high - self.low)[which]
        edges = np.append(0, np.cumsum(size))
        take = np.arange(edges[-1]) + np.repeat(self.low[which] - edges[:-1], size)
        # told apart by 44 bits, and sorted as one number with their paragraph's
        of = np.repeat(np.arange(len(which), dtype=np.uint64), size)
        value = np.sort(of << np.uint64(44) | self.shingles[take] & np.uint64((1 << 44) - 1))
        new = np.append(True, np.diff(value) != 0)
        bit = np.where(new, np.uint64(1) << (value & np.uint64(63)), np.uint64(0))
        upper = (value >> np.uint64(6) & np.uint64(1)).astype(bool)
        halves = [np.bitwise_xor.reduceat(np.where(half, bit, np.uint64(0)), edges[:-1]).view(np.int64) for half in (~upper, upper)]
        return np.add.reduceat(new, edges[:-1], dtype=np.int32), *halves

    def sets(self, which: np.ndarray) -> pa.ListArray:
        """The shingles of these paragraphs."""
        size = (self.high - self.low)[which]
        edges = np.append(0, np.cumsum(size))
        take = np.arange(edges[-1]) + np.repeat(self.low[which] - edges[:-1], size)
        return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(self.shingles[take].view(np.int64)))


def _paragraphs(text: pa.Array, kind: type = Paragraphs) -> Iterator[tuple[np.ndarray, np.ndarray, Paragraphs | Windows]]:
    """Per stretch of a batch: the rows, their first byte, and the paragraphs (or windows).

    A text above the stretch's size is cut at white space, at places that depend on the text only.
    """
    data, offsets = utf8(text)
    for low, high, cut in pieces(data, offsets):
        found = kind(data[cut[0] : cut[-1]], cut - cut[0])
        if found.size:
            rows = found.row + low
            yield rows, cut[found.row] - offsets[rows], found


def occurrences(docs: DataFrame, may: np.ndarray | None = None) -> DataFrame:
    """One row per compared paragraph: row (key of its document), place (of its first byte), name, start and end (bytes).
    ``may`` is a map of bits of names (and others) to be looked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, first, found in _paragraphs(batch["text"]):
                some = slice(None) if may is None else np.flatnonzero(_passes(may, found.name))
                at = pa.array(rows[some])
                spans = (found.name[some], (found.start + first)[some], (found.end + first)[some])
                columns = [batch["row"].take(at), batch["doc_id"].take(at).cast(pa.int64()), *spans]
                yield pa.record_batch([pa.array(c) for c in columns], names=["row", "doc_id", "name", "start", "end"])

    rows = docs.select(F.unhex(row_key()).alias("row"), "doc_id", "text").where(F.col("text").isNotNull())
    rows = rows.mapInArrow(run, "row binary, doc_id long, name long, start long, end long")
    return rows.select("row", place(F.col("doc_id"), F.col("start")).alias("place"), "name", "start", "end")


def _whole(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches sorted by a number, dealt anew so that all rows of one number are in one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch[key].to_numpy()
        if not len(values):
            continue
        cut = int(np.searchsorted(values, values[-1], "left"))
        if held and (cut or values[0] != held[0][key][0].as_py()):
            yield pa.concat_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield batch.slice(0, cut)
        held.append(batch.slice(cut))
    if held:
        yield pa.concat_batches(held)


def _followers(first: np.ndarray, size: np.ndarray, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within groups that begin at ``first`` (and have at most ``most``), those as far apart at a time."""
    left = np.repeat(first + size, size) - np.arange(int(size.sum())) - 1
    if most is not None:
        left[np.repeat(size, size) > most] = 0
    at, step = np.flatnonzero(left > 0), 1
    while len(at):
        yield at, at + step
        step += 1
        at = at[left[at] >= step]


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links that connect the similar paragraphs of each group: in groups over ``PAIRWISE``, pairs already linked are not compared."""
    for batch in _whole(batches, "bucket"):
        name, lists = batch["name"].to_numpy(), batch["shingles"]
        # sets as runs of sorted codes
        code = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1].astype(np.int64)
        width = int(code.max(initial=0)) + 1
        code = np.unique(np.repeat(np.arange(len(name)), lists.value_lengths().to_numpy()) * width + code)
        row, code = np.divmod(code, width)
        size = np.bincount(row, minlength=len(name))
        low = np.append(0, np.cumsum(size))
        first = _heads(batch["bucket"].to_numpy())
        count = np.diff(np.append(first, len(name)))
        a, b = [], []
        for i, j in _followers(first, count, PAIRWISE):
            fit = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j])
            i, j = i[fit], j[fit]
            if not len(i):
                continue
            both = []
            for side in (i, j):
                edges = np.append(0, np.cumsum(size[side]))
                of = np.repeat(np.arange(len(side)), size[side])
                both.append(of * width + code[np.arange(edges[-1]) - edges[:-1][of] + low[side][of]])
            met = np.sort(np.concatenate(both))
            common = np.bincount(met[1:][met[1:] == met[:-1]] // width, minlength=len(i))
            linked = common >= threshold * (size[i] + size[j] - common)
            a += name[i[linked]].tolist()
            b += name[j[linked]].tolist()
        for g in np.flatnonzero(count > PAIRWISE):
            clusters: list[list] = []
            for r in range(first[g], first[g] + count[g]):
                mine = frozenset(code[low[r] : low[r + 1]].tolist())
                joined, apart = [(r, mine)], []
                for cluster in clusters:
                    for other, theirs in cluster:
                        if min(len(mine), len(theirs)) < threshold * max(len(mine), len(theirs)):
                            continue
                        common = len(mine & theirs)
                        if common >= threshold * (len(mine) + len(theirs) - common):
                            a.append(int(name[r]))
                            b.append(int(name[other]))
                            joined += cluster
                            break
                    else:
                        apart.append(cluster)
                clusters = [*apart, joined]
        if a:
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _screened(batches: Iterator[pa.RecordBatch], threshold: float, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: the members of each that may be similar to another one, by size and sketch.

    Buckets left with the same members get the same new number. Those of more than ``limit`` members are given
    out as they are, with their sketches.
    """
    share = (1 - threshold) / (1 + threshold) * (1 + 1e-9)  # of both sizes that similar sets may differ in
    fields = ["bucket", "name", "size", "low", "high"]

    def distinct(rows: list[np.ndarray]) -> list[np.ndarray]:
        rows = [c[np.lexsort((rows[1], rows[0]))] for c in rows]
        once = _heads(rows[0], rows[1])
        return [c[once] for c in rows]

    def kept(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        bucket, name, size, low, high = rows
        first = _heads(bucket)
        count = np.diff(np.append(first, len(bucket)))
        if limit is not None and count.max(initial=0) > limit:
            big = np.repeat(count > limit, count)
            yield large([c[big] for c in rows])
            yield from kept([c[~big] for c in rows])
            return
        maybe = np.zeros(len(name), bool)
        for i, j in _followers(first, count):
            differ = np.bitwise_count(low[i] ^ low[j]).astype(np.int64) + np.bitwise_count(high[i] ^ high[j])
            near = differ <= share * (size[i] + size[j])
            maybe[i[near]] = maybe[j[near]] = True
        bucket, name = bucket[maybe], name[maybe]
        if len(name):
            first = _heads(bucket)
            members = _mixed(np.add.reduceat(_mixed(name.view(np.uint64)), first))
            group = np.repeat(members.view(np.int64), np.diff(np.append(first, len(name))))
            nothing = [pa.nulls(len(name), t) for t in (pa.int32(), pa.int64(), pa.int64())]
            yield pa.record_batch([pa.array(group), pa.array(name), *nothing], names=fields)

    def large(rows: list[np.ndarray]) -> pa.RecordBatch:
        bucket, name, size, low, high = rows
        columns = [bucket, name, size.astype(np.int32), low.view(np.int64), high.view(np.int64)]
        return pa.record_batch([pa.array(c) for c in columns], names=fields)

    held: list[np.ndarray] | None = None
    crowd = None  # the bucket that is being given out
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch[f].to_numpy() for f in fields]
        rows = [rows[0], rows[1], rows[2].astype(np.int64), rows[3].view(np.uint64), rows[4].view(np.uint64)]
        if held is not None:
            rows = [np.concatenate(c) for c in zip(held, rows)]
        rows = distinct(rows)
        if crowd is not None:
            stop = int(np.searchsorted(rows[0], crowd, "right"))
            if stop:
                yield large([c[:stop] for c in rows])
                rows = [c[stop:] for c in rows]
            if not len(rows[0]):
                held = None
                continue
            crowd = None
        cut = int(np.searchsorted(rows[0], rows[0][-1], "left"))
        if cut:
            yield from kept([c[:cut] for c in rows])
        held = [c[cut:] for c in rows]
        if limit is not None and len(held[0]) > limit:
            yield large(held)
            held, crowd = None, rows[0][-1]
    if held is not None:
        yield from kept(held)


def passages(docs: DataFrame) -> DataFrame:
    """Of passages of at least ``WINDOW`` words that occur again: row, place, start, end, ``first``, ``removed``.

    A row is a segment or a window, so that those of one passage overlap. The number of a place is that of its first
    word (behind the bytes before the stretch, which have at least as many).
    """
    rows = docs.select(F.unhex(row_key()).alias("row"), "doc_id", "text").where(F.col("text").isNotNull())

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, first, found in _paragraphs(batch["text"], Windows):
                head = found.first
                ids = batch["doc_id"].take(pa.array(of[head])).cast(pa.int64())
                columns = [pa.array(found.anchor), pa.array(found.name), ids, pa.array((found.number + first)[head])]
                yield pa.record_batch(columns, names=["anchor", "name", "doc_id", "number"])

    met = rows.select("doc_id", "text").mapInArrow(anchors, "anchor long, name long, doc_id long, number long")
    met = met.select("anchor", "name", place(F.col("doc_id"), F.col("number")).alias("place")).groupBy("anchor")
    met = met.agg(F.min("place").alias("first"), F.max("place").alias("last"), F.min("name").alias("a"), F.max("name").alias("b"))
    met = written(met.where("first < last").select("anchor", "first", (F.col("a") < F.col("b")).alias("mixed")))
    plain, mixed = (_filter(met.where(kind).select(F.col("anchor").alias("name"))) for kind in ("NOT mixed", "mixed"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, first, found in _paragraphs(batch["text"], Windows):
                one = np.flatnonzero(_passes(plain, found.anchor))
                each = np.flatnonzero(np.repeat(_passes(mixed, found.anchor), found.count))
                low = np.concatenate([found.first[one], each])
                high = np.concatenate([found.first[one] + found.count[one] - 1, each])
                columns = [
                    pa.array(np.concatenate([found.anchor[one], np.repeat(found.anchor, found.count)[each]])),
                    pa.array(found.hash[low], mask=np.arange(len(low)) < len(one)),
                    batch["row"].take(pa.array(of[low])),
                    batch["doc_id"].take(pa.array(of[low])).cast(pa.int64()),
                    *(pa.array(x) for x in ((found.number + first)[low], (found.start + first)[low], (found.end + first)[high])),
                ]
                yield pa.record_batch(columns, names=["anchor", "hash", "row", "doc_id", "number", "start", "end"])

    found = rows.mapInArrow(spans, "anchor long, hash long, row binary, doc_id long, number long, start long, end long")
    found = found.select("anchor", "hash", "row", place(F.col("doc_id"), F.col("number")).alias("place"), "start", "end")
    found = written(found.join(met, "anchor").where(F.col("mixed") == F.col("hash").isNotNull()))
    # windows of unlike segments: the first of equal ones, whatever their anchors' first
    each = found.where("mixed").drop("first")
    least = each.groupBy("hash").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last")
    names = ["row", "place", "start", "end", "first"]
    found = found.where("NOT mixed").select(names).union(each.join(least.select("hash", "first"), "hash").select(names))
    # windows that overlap their own first do not make it go
    other = F.coalesce(place_id(F.col("first")) != place_id(F.col("place")), place_id(F.col("first")).isNotNull() & place_id(F.col("place")).isNull())
    removed = (F.col("first") < F.col("place")) & (other | (F.col("place") - F.col("first") >= WINDOW))
    return found.select(*names, removed.alias("removed"))


def _passes(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Whether a map of bits lets names pass."""
    bit = names & (FILTER - 1)
    return (bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)


def _filter(names: DataFrame) -> np.ndarray:
    """A map of ``FILTER`` bits with those set that the names end in: what it lets pass is joined exactly after it.

    At most ``FILTER / 8`` bytes reach the driver, whatever the number of names.
    """
    bit = F.col("name").bitwiseAND(FILTER - 1)
    parts = names.groupBy(F.floor(bit / (1 << 15)).alias("part")).agg(F.bitmap_construct_agg(bit % (1 << 15)).alias("bits"))
    out = np.zeros((FILTER >> 15, 1 << 12), np.uint8)
    for part, bits in parts.toLocalIterator():
        out[part] = np.frombuffer(bits, np.uint8)
    return out.reshape(-1)


def links(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """Pairs (a, b) of names that connect all distinct paragraphs found similar."""
    bands = tune(threshold, recall, rows)
    texts = docs.select("text").where(F.col("text").isNotNull())

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, hashes, sketches = [], [], []
            for _, _, found in _paragraphs(batch["text"]):
                once = np.sort(np.unique(found.name, return_index=True)[1])  # in order, for ``bands``
                once = once[found.high[once] > found.low[once]]
                if len(once):
                    names.append(found.name[once])
                    hashes.append(found.bands(once, bands, rows))
                    sketches.append(found.sketches(once))
            if names:
                name, once = np.unique(np.concatenate(names), return_index=True)
                bucket = np.concatenate(hashes)[once]
                columns = [name, *(np.concatenate(c)[once] for c in zip(*sketches))]
                columns = [pa.array(bucket.reshape(-1)), *(pa.array(np.repeat(c, bands)) for c in columns)]
                yield pa.record_batch(columns, names=["bucket", "name", "size", "low", "high"])

    kind = "bucket long, name long, size int, low long, high long"
    sized = texts.mapInArrow(banded, kind).repartition("bucket").sortWithinPartitions("bucket")
    near = written(sized.mapInArrow(lambda batches: _screened(batches, threshold, TILE), kind))
    # buckets of many members: every two tiles meet in a task of their own
    large = near.where("size IS NOT NULL").dropDuplicates(["bucket", "name"])
    # buckets of the same members would be compared alike: the first of them is enough
    mixed = F.xxhash64("name", F.lit(1)).cast("decimal(20,0)")
    tiles = large.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("name")).alias("x"), F.sum(mixed).alias("y"))
    tiles = tiles.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", F.ceil(F.col("n") / TILE).alias("tiles"))
    pairs = large.join(tiles, "bucket").withColumn("tile", F.pmod(F.xxhash64("name"), "tiles"))
    pairs = pairs.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    pairs = pairs.select(F.xxhash64("bucket", F.least("tile", "other"), F.greatest("tile", "other")).alias("bucket"), "name", "size", "low", "high")
    pairs = pairs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda batches: _screened(batches, threshold), kind)
    near = written(near.where("size IS NULL").select("bucket", "name").union(pairs.select("bucket", "name")).distinct())
    may = _filter(near)

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, found in _paragraphs(batch["text"]):
                _, first = np.unique(found.name, return_index=True)
                first = first[_passes(may, found.name[first])]
                first = first[found.high[first] > found.low[first]]
                if len(first):
                    yield pa.record_batch([pa.array(found.name[first]), found.sets(first)], names=["name", "shingles"])

    sets = texts.mapInArrow(shingled, "name long, shingles array<long>").dropDuplicates(["name"])
    pairs = near.join(sets, "name").select("bucket", "name", "shingles").repartition("bucket").sortWithinPartitions("bucket")
    return written(pairs.mapInArrow(lambda batches: _verified(batches, threshold), "a long, b long"))


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per name of a paragraph that occurs again, as it is or nearly: ``first``, the place of its class's first."""
    roots = components(links(docs, threshold, recall), "a", "b").select(F.col("node").alias("name"), "root")
    spans = occurrences(docs).groupBy("name").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    spans = spans.join(roots, "name", "left").where(F.col("root").isNotNull() | (F.col("first") < F.col("last")))
    spans = written(spans.withColumn("root", F.coalesce("root", "name")))
    first = spans.groupBy("root").agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first < last")
    return spans.select("name", "root").join(first, "root").select("name", "first")


def repeats(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per paragraph or piece of a passage that occurs again: row, place, start, end, ``first`` and whether it is ``removed``."""
    known = written(classes(docs, threshold, recall))
    found = occurrences(docs, _filter(known)).join(known, "name")
    found = found.select("row", "place", "start", "end", "first", (F.col("first") < F.col("place")).alias("removed"))
    return found.unionByName(passages(docs))


def dedup_paragraphs(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The documents with ``text`` less its removed paragraphs, other columns unchanged."""

    def cut(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, spans in texts:
            out = []
            for t, gone in zip(text.to_pylist(), spans.to_pylist()):
                if t is not None and gone:
                    raw, at, kept = t.encode(), 0, []
                    for span in gone:
                        kept.append(raw[at : span["start"]])
                        at = max(at, span["end"])
                    t = b"".join([*kept, raw[at:]]).decode()
                out.append(t)
            yield pa.array(out, pa.string())

    gone = repeats(docs, threshold, recall).where("removed").groupBy(F.col("row").alias("gone_row"))
    gone = gone.agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("gone"))
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("packed"), F.unhex(row_key()).alias("row"))
    rows = packed.join(gone, F.col("row") == F.col("gone_row"), "left")
    rows = rows.withColumn("cut", F.arrow_udf(cut, "string")(F.col("packed.text"), F.col("gone")))
    return rows.select(*(F.col("cut").alias(c) if c == "text" else F.col(f"packed.`{c}`") for c in docs.columns))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by the document's key: per document, the stretches under its spans and under its removed ones,
    those that overlap counted as one, the bytes under the latter, and the sources.
    """

    def stretches(of: np.ndarray, start: np.ndarray, end: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((start, of))
        of, start, end = of[order], start[order], end[order]
        before = np.zeros(len(of), np.int64)  # the furthest end so far in the document
        before[1:] = np.maximum.accumulate((of << 32) + end)[:-1] - (of[1:] << 32)
        number = np.bincount(of, start >= np.maximum(before, 0), groups)
        size = np.bincount(of, np.maximum(end - np.maximum(start, before), 0), groups)
        return number.astype(np.int64), size.astype(np.int64)

    for batch in _whole_documents(batches):
        key = _key(batch)
        first = _heads(*key)
        of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key[0]))))
        start, end, removed = (batch[c].to_numpy(zero_copy_only=False) for c in ("start", "end", "removed"))
        shared, _ = stretches(of, start, end, len(first))
        gone, size = stretches(of[removed], start[removed], end[removed], len(first))
        known = batch["source"].is_valid().to_numpy(zero_copy_only=False)
        owner, source = of[known], batch["source"].drop_null().to_numpy()
        order = np.lexsort((source, owner))
        owner, source = owner[order], source[order]
        once = _heads(owner, source)
        edges = np.searchsorted(owner[once], np.arange(len(first) + 1)).astype(np.int32)
        sources = pa.ListArray.from_arrays(pa.array(edges), pa.array(source[once]))
        columns = [batch["row"].take(pa.array(first)), *map(pa.array, (shared, gone, size)), sources]
        yield pa.record_batch(columns, names=["row", "n_shared", "n_removed", "removed_bytes", "sources"])


def _key(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The 16 bytes of each document's key as two numbers."""
    data, _ = utf8(batch["row"].cast(pa.large_binary()).view(pa.large_string()))
    halves = data.copy().view(np.uint64).reshape(-1, 2)
    return halves[:, 0], halves[:, 1]


def _whole_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by the document's key, dealt anew so that all rows of a document are in one batch, equal ones once."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch if held is None else pa.concat_batches([held, batch])
        cut = int(_heads(*_key(batch))[-1])
        if cut:
            yield batch.slice(0, cut)
        held = batch.slice(cut)
        if not cut:  # copies of a row at one place say the same
            once = pa.Table.from_batches([held]).group_by(held.schema.names).aggregate([])
            held = once.combine_chunks().to_batches()[0]
    if held is not None:
        yield held


def digest(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shared`` paragraphs that occur again, ``n_removed`` of them,
    ``removed_bytes``, and ``sources``: the ids of the documents in which the shared ones are first, its own included.
    A line and what occurs again inside it are counted once.
    """
    found = repeats(docs, threshold, recall).select("row", "start", "end", "removed", place_id(F.col("first")).alias("source"))
    found = found.repartition("row").sortWithinPartitions("row")
    found = found.mapInArrow(_counted, "row binary, n_shared long, n_removed long, removed_bytes long, sources array<long>")
    rows = docs.select("doc_id", F.unhex(row_key()).alias("row")).join(found, "row", "left")
    counts = (F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("n_shared", "n_removed", "removed_bytes"))
    return rows.select("doc_id", *counts, F.coalesce("sources", F.array().cast("array<bigint>")).alias("sources"))
