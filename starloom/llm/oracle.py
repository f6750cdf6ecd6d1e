"""DuckDB SQL for the queries that SQL can express, over whole tables and texts."""

from __future__ import annotations

from .quality_lines import (BOILERPLATE, LOST_SHARE, NAVIGATION, SEPARATED_SHARE, SHORT_LINE, SHOUTED_SHARE,
                            SYMBOL_SHARE)

_W = r"[^\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{_W}')"


SUBSTRING = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS j,
  unnest(list_transform(range(1, len(w) - 18), lambda k: array_to_string(w[k:k + 19], ' '))) AS g
  FROM d WHERE len(w) >= 20),
f AS (SELECT doc_id, j, min((doc_id, j)) OVER (PARTITION BY g) AS first FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(j, j + 20)) AS i FROM f WHERE first <> (doc_id, j)),
r AS (SELECT doc_id, count(*) AS n, list(i) AS gone FROM c GROUP BY doc_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS kept FROM x
      LEFT JOIN c ON c.doc_id = x.doc_id AND c.i = x.i WHERE c.i IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(r.n, 0) AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN r ON r.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id"""

JACCARD = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_words("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
        lambda j: array_to_string(w[j:j + 4], ' '))) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
e AS (SELECT l.a, l.b FROM l JOIN n x ON x.doc_id = l.a JOIN n y ON y.doc_id = l.b
      WHERE 100 * l.k >= 80 * (x.n + y.n - l.k)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.a, r.c FROM r JOIN e ON e.b = r.doc_id)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""

MIX = f"""
WITH d AS (SELECT doc_id, source, CAST(len({_words('text')}) AS BIGINT) AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
  [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS w
  FROM d GROUP BY source),
o AS (SELECT *, 2.0::DOUBLE * source_size AS most, 2.0::DOUBLE * source_size / w AS ratio,
  (SELECT 1.5::DOUBLE * sum(source_size) FROM s) AS wanted FROM s),
q AS (SELECT x.ratio, max(x.wanted) AS wanted, coalesce(sum(y.most) FILTER (WHERE y.ratio < x.ratio), 0) AS given,
  sum(y.w) FILTER (WHERE y.ratio >= x.ratio) AS free FROM o x CROSS JOIN o y GROUP BY x.source, x.ratio),
r AS (SELECT min_by((wanted - given) / free, ratio) AS rate FROM q WHERE (wanted - given) / free <= ratio),
t AS (SELECT source, source_size, least(most, w * coalesce((SELECT rate FROM r), 1e300)) AS target FROM o),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
v AS (SELECT *, target - whole * source_size AS rest FROM u),
c AS (SELECT d.doc_id, d.size, v.source_size, v.target, v.whole, v.rest,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto,
  sum(d.size) OVER (PARTITION BY d.source, d.h) AS same
  FROM d JOIN v ON v.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN upto <= rest THEN 1
  WHEN upto - same <= rest AND same < 2 * (rest - (upto - same)) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c"""


def _quality() -> str:
    boiler = " OR ".join(f"contains(lower(x), '{p}')" for p in BOILERPLATE)
    navigation = ", ".join(f"'{p}'" for p in NAVIGATION)
    n = f"len(regexp_extract_all(x, '{_W}'))"
    count = lambda p: f"len(regexp_extract_all(x, '{p}'))"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_words('text')} AS w,
  string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS j,
  unnest(list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' '))) AS t
  FROM d WHERE len(w) >= 4),
g AS (SELECT doc_id, j, count(*) OVER (PARTITION BY doc_id, t) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT i) AS n FROM (
  SELECT doc_id, unnest([j, j + 1, j + 2]) AS i FROM g WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(lines) AS x FROM d),
b AS (SELECT doc_id, sum({n}) AS lost FROM l WHERE
  (regexp_matches(x, '[#*$%&|<>]') AND 100 * {count('[#*$%&|<>]+')} >= {SYMBOL_SHARE} * {n})
  OR (regexp_matches(x, '[!?][!?]') AND 100 * {count('[!?]{2,}')} >= {SHOUTED_SHARE} * {n})
  OR (regexp_matches(x, ' [/>-] ') AND 100 * {count(' [/>-] ')} >= {SEPARATED_SHARE} * {n})
  OR (length(x) <= {SHORT_LINE} AND ({boiler} OR (length(x) < 40 AND
    regexp_replace(lower(x), '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') IN ({navigation}))))
  GROUP BY doc_id),
f AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM l WHERE regexp_matches(x, '{_W}') GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(f.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
  coalesce(b.lost, 0) AS lost
  FROM d LEFT JOIN r ON r.doc_id = d.doc_id LEFT JOIN b ON b.doc_id = d.doc_id LEFT JOIN f ON f.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost <= {LOST_SHARE} * n_words AS kept FROM m"""


_FEATURES = """list_concat(w, list_transform(range(1, len(w)), lambda j: w[j] || ' ' || w[j + 1]))"""


def _resample_words(table: str, key: str) -> str:
    return f"""SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}"""


# CRC-32 by bytes from its polynomial: SQL has no function of that name
RESAMPLE = f"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS ({_resample_words('documents', 'doc_id')}),
e AS ({_resample_words('benchmark', 'item_id')}),
f AS (SELECT doc_id, unnest({_FEATURES}) AS f FROM d),
g AS (SELECT unnest({_FEATURES}) AS f FROM e),
x AS (SELECT f, hex(f) AS x FROM (SELECT f FROM f UNION SELECT f FROM g)),
y AS (SELECT f, list_prepend(4294967295, list_transform(range(0, len(x) // 2),
  lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))) AS y FROM x),
b AS (SELECT f, xor(list_reduce(y, lambda c, v: xor(t[CAST((xor(c, v) & 255) + 1 AS INTEGER)], c >> 8)),
  4294967295) % 10000 AS b FROM y, tab),
s AS (SELECT b, count(*) AS s FROM f JOIN b USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM g JOIN b USING (f) GROUP BY b),
n AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE AS s_all, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS t_all),
w AS (SELECT s.b, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT)
  AS gain FROM s LEFT JOIN t ON t.b = s.b, n),
m AS (SELECT doc_id, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM f JOIN b USING (f) JOIN w USING (b) GROUP BY doc_id),
o AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(
  -1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)))
  AS BIGINT) AS score FROM d LEFT JOIN m ON m.doc_id = d.doc_id),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS k
  FROM o WHERE n_features >= 39)
SELECT o.*, CASE WHEN rank <= k * 25 // 100 THEN rank END AS rank FROM o LEFT JOIN r ON r.doc_id = o.doc_id"""


def _cluster(rounds: int = 3) -> str:
    parts = ["""v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             """c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (
  SELECT sha256('1:' || vec_id) AS h, v FROM v ORDER BY h LIMIT 16))"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS (SELECT vec_id, v, min((d, c)) AS best FROM (SELECT v.vec_id, v.v, c.c, CAST(list_sum(
  list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM v, c{i} c)
  GROUP BY vec_id, v)""")
        if i < rounds:
            parts.append(f"""s{i} AS (SELECT best[2] AS c, unnest(v) AS x, unnest(range(64)) AS i FROM a{i}),
m{i} AS (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM s{i} GROUP BY c, i),
n{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM m{i} GROUP BY c),
c{i + 1} AS (SELECT o.c, coalesce(n.v, o.v) AS v FROM c{i} o LEFT JOIN n{i} n ON n.c = o.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance,
  CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,
  CAST(sum(best[1]) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.best[2]"""


ORACLE_SQL = {"op1_substring": SUBSTRING, "op4_near_duplicates": JACCARD, "op8_mix": MIX,
              "op9_quality": _quality(), "op12_resample": RESAMPLE, "op13_cluster": _cluster()}
