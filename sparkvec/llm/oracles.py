"""SQL twins, for DuckDB, of operators whose results SQL can express. Nothing here comes from the operators."""

from __future__ import annotations

import xxhash

#: XXH64's primes and modulus: fixed values.
P1, P2, P3 = 11400714785074694791, 14029467366897019727, 1609587929392839161
P4, P5 = 9650029242287828579, 2870177450012600261
M = 1 << 64


def _times(a: str, b: int) -> str:
    return f"({a}) * {b}::UHUGEINT % {M}::UHUGEINT"


def _rotated(a: str, bits: int) -> str:
    return f"(({a}) * {1 << bits}::UHUGEINT % {M}::UHUGEINT + ({a}) // {1 << 64 - bits}::UHUGEINT)"


def _hashed(key: str, seed: str, name: str) -> str:
    """Columns that end in ``name``, the XXH64 of the 64-bit number ``key``; the seed itself where the key is null."""
    steps = [_times(key, P2), _rotated("{0}", 31), _times("{0}", P1), f"xor((({seed}) + {P5 + 8}::UHUGEINT) % {M}::UHUGEINT, {{0}})"]
    steps += [_rotated("{0}", 27), f"({_times('{0}', P1)} + {P4}::UHUGEINT) % {M}::UHUGEINT"]
    for shift, prime in ((33, P2), (29, P3), (32, 1)):
        steps += [f"xor({{0}}, {{0}} // {1 << shift}::UHUGEINT)", _times("{0}", prime)]
    columns = [f"{step.format(f'{name}_{i - 1}')} AS {name}_{i}" for i, step in enumerate(steps)]
    return ",\n    ".join([*columns, f"CASE WHEN {key} IS NULL THEN {seed} ELSE {name}_{len(steps) - 1} END AS {name}"])


def _seed(level: str, child: int) -> int:
    return xxhash.xxh64_intdigest(child.to_bytes(4, "little"), xxhash.xxh64_intdigest(level.encode(), 42))


#: (level, parent, child, weight) of eight shards in two regions of two racks, and a ninth that is a region of its own.
_NODES = [("region", -1, 0, 4), ("region", -1, 4, 4), ("region", -1, 8, 1)]
_NODES += [("rack", s // 4 * 4, s, 2) for s in (0, 2, 4, 6)] + [("rack", 8, 8, 1)]
_NODES += [("shard", s // 2 * 2, s, 1) for s in range(9)]

SHARDING = f"""
WITH RECURSIVE steps(n, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
codes AS (SELECT list(c ORDER BY n) AS t FROM steps WHERE k = 8),
d AS (
  SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) + 1 AS size,
    CAST((doc_id::HUGEINT + {M}) % {M} AS UHUGEINT) AS key,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes
  FROM documents),
c AS (
  SELECT r, doc_id, size, key,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS crc
  FROM d, codes),
nodes(level, parent, child, weight, seed) AS (
  VALUES {", ".join(f"('{l}', {p}, {c}, {w}, {_seed(l, c)}::UHUGEINT)" for l, p, c, w in _NODES)}),
h AS (SELECT r, level, parent, child, weight,
    {_hashed("key", "seed", "h")}
  FROM d, nodes),
draws AS (SELECT r, level, parent, child, -ln((CAST(h // 2048::UHUGEINT AS DOUBLE) + 0.5) / 9007199254740992) / weight AS draw FROM h),
region AS (
  SELECT r, arg_min(child, draw) FILTER (child < 8) AS old, arg_min(child, draw) AS new FROM draws WHERE level = 'region' GROUP BY r),
best AS (SELECT r, level, parent, arg_min(child, draw) AS child FROM draws WHERE level <> 'region' GROUP BY r, level, parent),
placed AS (
  SELECT region.r, s1.child AS shard, s2.child AS grown_shard FROM region
  JOIN best k1 ON k1.r = region.r AND k1.level = 'rack' AND k1.parent = old
  JOIN best s1 ON s1.r = region.r AND s1.level = 'shard' AND s1.parent = k1.child
  JOIN best k2 ON k2.r = region.r AND k2.level = 'rack' AND k2.parent = new
  JOIN best s2 ON s2.r = region.r AND s2.level = 'shard' AND s2.parent = k2.child),
n AS (SELECT greatest(64, ceil(count(*) / 512))::HUGEINT AS buckets FROM (SELECT DISTINCT doc_id, size, crc FROM c)),
b1 AS (SELECT r, doc_id, size, crc, {_hashed("key", "42::UHUGEINT", "first")} FROM c),
b2 AS (SELECT r, doc_id, size, crc, {_hashed("size::UHUGEINT", "first", "second")} FROM b1),
b3 AS (SELECT r, doc_id, size, crc, {_hashed("crc::UHUGEINT", "second", "third")} FROM b2),
b AS (
  SELECT r, doc_id, size, crc, CASE WHEN third >= {1 << 63} THEN third::HUGEINT - {M} ELSE third::HUGEINT END AS signed,
    ((signed % buckets) + buckets) % buckets AS bucket FROM b3, n)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS LAST, size, crc) - 1 AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard
FROM b JOIN placed USING (r)
"""

#: All windows of 50 bytes, as hex digits; those that a smaller id has; their runs; what is left.
SUFFIX_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS id, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
w AS (SELECT r, id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT r, id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM d)),
gone AS (SELECT r, p FROM (SELECT r, id, p, min(id) OVER (PARTITION BY s) AS least FROM w) WHERE least < id),
marked AS (SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 50 THEN 0 ELSE 1 END AS fresh FROM gone),
numbered AS (SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS run FROM marked),
runs AS (SELECT r, min(p) AS low, max(p) + 50 AS high FROM numbered GROUP BY r, run),
cuts AS (SELECT r, low, high, lag(high, 1, 0) OVER (PARTITION BY r ORDER BY low) AS since FROM runs),
kept AS (
  SELECT r, count(*) AS n_spans, CAST(sum(high - low) AS BIGINT) AS n_removed, max(high) AS past,
    string_agg(substr(h, 2 * since + 1, 2 * (low - since)), '' ORDER BY low) AS head
  FROM cuts JOIN d USING (r) GROUP BY r)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(past, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

#: Every distinct line less each of its characters: equal ones at one place are a replacement, those equal to a line an insertion.
LINE_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS id, text FROM documents),
l AS (
  SELECT r, n, (id::HUGEINT * 4294967296 + n) AS place, parts[n + 1] AS line
  FROM (SELECT r, id, parts, unnest(range(0, len(parts))) AS n FROM (SELECT r, id, string_split(text, chr(10)) AS parts FROM d))
  WHERE trim(parts[n + 1], ' ') <> ''),
u AS (SELECT line, min(place) AS place, length(line) AS size FROM l GROUP BY line),
v AS (
  SELECT place, size, i, hash(line[1 : i - 1] || line[i + 1 :]) AS rest
  FROM (SELECT place, size, line, unnest(range(1, size + 1)) AS i FROM u WHERE size >= 20)),
w AS (SELECT place, size, hash(line) AS whole FROM u WHERE size >= 20),
found AS (
  SELECT place, min(place) OVER (PARTITION BY size, i, rest) AS other FROM v
  UNION ALL SELECT v.place, w.place FROM v JOIN w ON rest = whole AND w.size = v.size - 1
  UNION ALL SELECT w.place, v.place FROM v JOIN w ON rest = whole AND w.size = v.size - 1),
least AS (SELECT place, min(other) AS other FROM found GROUP BY place),
first AS (SELECT line, least(u.place, coalesce(other, u.place)) AS first FROM u LEFT JOIN least USING (place)),
gone AS (SELECT r, list(CAST(n AS INTEGER) ORDER BY n) AS removed FROM l JOIN first USING (line) WHERE first < place GROUP BY r)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines,
  coalesce(len(removed), 0) AS n_removed, coalesce(removed, CAST([] AS INTEGER[])) AS removed
FROM d LEFT JOIN gone USING (r)
"""

#: Brute force: the windows of the curves hold whole tables of up to a chunk, as those this is run on.
ANN = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
k AS (SELECT len(e) AS n FROM v GROUP BY n ORDER BY count(*) DESC, n LIMIT 1),
u AS (SELECT vec_id, e FROM v, k WHERE len(e) = n),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, max(list_inner_product(q.e, c.e)) AS score
  FROM u q JOIN u c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0 GROUP BY q.vec_id, c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
