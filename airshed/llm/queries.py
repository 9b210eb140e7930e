"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airshed.llm import (
    decontamination,
    html,
    jaccard,
    language,
    licenses,
    mixing,
    periodic,
    pii,
    quality,
    ranked,
    secrets,
    sharding,
    topk,
)
from airshed.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"),
                                         table(spark, sf_dir, "benchmark"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_embeddings(table(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "labels"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_documents(table(spark, sf_dir, "documents"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_tail_repeats(table(spark, sf_dir, "documents"))
    return periodic.digests(periodic.find_runs(docs))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontamination, op2_html_extraction, op3_sharding, op4_mixing,
                            op5_topk, op6_quality, op7_licenses, op8_language, op9_jaccard,
                            op10_pii, op11_periodic_runs, op12_secrets, op13_ranked_search)}

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

_OP1 = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win,
           least(10, len(w)) AS n
         FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items
               WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
spots AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
          FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
                FROM docs, (SELECT DISTINCT n FROM wins))),
hits AS (SELECT r, i, n, item FROM spots JOIN wins USING (win, n)),
words AS (SELECT r, count(DISTINCT p) AS n_hit
          FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

def _feistel(source: str, x: str, seed: int = 1) -> str:
    """``source`` (with a, b and the column ``x``) with y, the number that the network makes of x."""
    q = f"SELECT *, {x} // b AS l, {x} % b AS r, a AS m, b AS k FROM ({source})"
    for i in range(sharding.ROUNDS):
        mix = f"CAST('0x' || md5('{seed * sharding.ROUNDS + i}:' || r)[1:15] AS BIGINT)"
        q = f"SELECT * REPLACE (r AS l, (l + {mix}) % m AS r, k AS m, m AS k) FROM ({q})"
    return f"SELECT * EXCLUDE (l, r, m, k), l * b + r AS y FROM ({q})"


# A text's UTF-8 bytes, folded into its checksum by a table of the 256 one-byte steps.
_BYTES = ("flatten([CASE WHEN o < 128 THEN [o] WHEN o < 2048 THEN [192 + (o >> 6), 128 + (o & 63)] "
          "WHEN o < 65536 THEN [224 + (o >> 12), 128 + ((o >> 6) & 63), 128 + (o & 63)] "
          "ELSE [240 + (o >> 18), 128 + ((o >> 12) & 63), 128 + ((o >> 6) & 63), 128 + (o & 63)] END "
          "FOR o IN [CAST(ord(c) AS BIGINT) FOR c IN string_split(text, '')]])")
_OP3 = f"""
WITH RECURSIVE steps AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda x, j: xor(x >> 1, 3988292384 * (x & 1))) AS c FROM range(256) t(i))),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
rows AS MATERIALIZED (SELECT doc_id, strlen(text) + 1 AS size, CASE WHEN text = '' THEN 0 ELSE xor(4294967295,
    list_reduce(list_prepend(4294967295, {_BYTES}), lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)]))) END
    AS text_crc32 FROM d, steps),
numbered AS (SELECT *, row_number() OVER (ORDER BY CAST('0x' || md5(concat_ws(chr(31),
      coalesce(CAST(doc_id AS VARCHAR), chr(30)), size, text_crc32))[1:8] AS BIGINT) % 4096,
      doc_id NULLS FIRST, size, text_crc32) - 1 AS x, count(*) OVER () AS n FROM rows),
gridded AS MATERIALIZED (SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS a,
    (n + CAST(ceil(sqrt(n)) AS BIGINT) - 1) // CAST(ceil(sqrt(n)) AS BIGINT) AS b FROM numbered),
walk AS (SELECT x, n, a, b, y FROM ({_feistel('SELECT x, n, a, b FROM gridded', 'x')})
  UNION ALL SELECT x, n, a, b, y FROM ({_feistel('SELECT x, n, a, b, y AS z FROM walk WHERE y >= n', 'z')}))
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(y % 8 AS INTEGER) AS shard, y // 8 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM gridded JOIN (SELECT x, y FROM walk WHERE y < n) USING (x)
"""

# Rows with equal sets are one class; classes that share enough shingles link, and links are followed until
# nothing new is reached.
_OP9 = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (SELECT r, list_sort(list_distinct(list(s))) AS x FROM (
    SELECT r, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
    FROM d WHERE len(w) > 0) GROUP BY r),
classes AS MATERIALIZED (SELECT min(r) AS c, x, len(x) AS n FROM sets GROUP BY x),
held AS MATERIALIZED (SELECT c, n, unnest(x) AS s FROM classes),
links AS MATERIALIZED (SELECT a.c AS p, b.c AS q FROM held a JOIN held b
    ON a.s = b.s AND a.c <> b.c AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.c, a.n, b.c, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT c AS p, c AS q FROM classes UNION SELECT reach.p, links.q FROM reach JOIN links ON reach.q = links.p),
least AS (SELECT c, min(doc_id) AS doc_id FROM classes JOIN sets USING (x) JOIN d USING (r) GROUP BY c),
component AS (SELECT p AS c, min(doc_id) AS component_id FROM reach JOIN least ON reach.q = least.c GROUP BY p)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
  CASE WHEN n IS NULL THEN d.doc_id ELSE component_id END AS component_id
FROM d LEFT JOIN sets USING (r) LEFT JOIN classes USING (x) LEFT JOIN component USING (c)
"""

_OP5 = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding,
             lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

_CRC = ("list_reduce(list_prepend(4294967295, [CAST(ord(c) AS BIGINT) FOR c IN "
        "string_split(CAST(doc_id AS VARCHAR), '')]), lambda a, b: list_reduce(list_prepend("
        "xor(a, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))")

# Pairs of equal 6-word pieces at distance q, in stretches of neighbouring starts, are repetitions of
# period q; of those with the same bounds the least period counts.
_OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    CASE WHEN doc_id IS NOT NULL THEN xor({_CRC}, 4294967295) END AS h
  FROM documents),
e AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 AND h % 10 = 0
        THEN (h // 10) % len(w) END AS a FROM d),
f AS (SELECT *, CASE WHEN a IS NOT NULL THEN 1 + (n - a) // (3 + g % 8) END AS p FROM e),
t AS MATERIALIZED (SELECT r, doc_id, CASE WHEN a IS NULL THEN w ELSE
    list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w
  FROM f),
six AS (SELECT r, i, hash(w[i + 1:i + 6]) AS x
        FROM (SELECT r, w, unnest(range(len(w) - 5)) AS i FROM t WHERE len(w) >= 12)),
pairs AS (SELECT l.r, l.i, m.i - l.i AS q FROM six l JOIN six m
          ON l.r = m.r AND l.x = m.x AND m.i > l.i),
parts AS (SELECT r, q, min(i) AS s, max(i) + q + 6 AS e FROM
            (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pairs)
          GROUP BY r, q, k),
runs AS MATERIALIZED (SELECT r, s, e - s AS len, min(q) AS q FROM parts
  WHERE e - s >= 12 AND e - s >= 2 * q GROUP BY r, s, e),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM runs),
lost AS (SELECT r, list(i) AS g FROM gone GROUP BY r),
best AS (SELECT r, count(*) AS n_runs, max({{'l': len, 's': -s, 'q': -q}}) AS m,
           string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines
         FROM runs GROUP BY r),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS c FROM
           (SELECT t.r, unnest(w) AS x, unnest(range(len(w))) AS i FROM t SEMI JOIN lost ON t.r = lost.r)
         WHERE (r, i) NOT IN (SELECT (r, i) FROM gone) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -m.s AS start, m.l AS length, -m.q AS period,
  1000 * m.l // -m.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(c, array_to_string(w, ' '))) AS collapsed_sha256
FROM t LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""

def _places(name: str, source: str, expression: str, group: int = 0) -> str:
    """CTE of the matches of an expression: r, m, g (the group), e (end), in code points."""
    return f"""{name}_m AS (SELECT r, unnest(range(len(m))) AS i, unnest(m) AS m, unnest(g) AS g,
    unnest(p[1:len(m)]) AS p FROM (SELECT r, regexp_extract_all(text, '{expression}') AS m,
      regexp_extract_all(text, '{expression}', {group}) AS g,
      string_split_regex(text, '{expression}') AS p FROM {source})),
{name} AS (SELECT r, m, g, CAST(sum(length(p) + length(m)) OVER (PARTITION BY r ORDER BY i) AS INT) AS e
  FROM {name}_m)"""


def _entropy(name: str, chars: str, most: int) -> str:
    """CTE ``name`` of the stretches (r, s, e, m: the candidate) that windows of low enough sums cover."""
    allowed = "|".join(f"(?:{a})" for a in secrets.ALLOWED)
    listed = " OR ".join(f"contains(m, '{x}')" for x in secrets.LISTINGS)
    w = secrets.WINDOW
    return f"""{_places(f'{name}_c', 'd', f'[{chars}]{{{w},}}')},
{name}_w AS (SELECT r, e, m, i, sum(weights[n + 1]) AS total FROM (
    SELECT r, e, m, i, c, count(*) AS n FROM (SELECT r, e, m, i, unnest(string_split(m[i:i + {w - 1}], '')) AS c
      FROM (SELECT r, e, m, unnest(range(1, length(m) - {w - 2})) AS i FROM {name}_c
        WHERE NOT (regexp_full_match(m, '{allowed}') OR {listed})))
    GROUP BY r, e, m, i, c), (SELECT {secrets.weights(w)} AS weights)
  GROUP BY r, e, m, i HAVING total <= {most}),
{name} AS (SELECT r, CAST(e - length(m) + min(i) - 1 AS INT) AS s,
    CAST(e - length(m) + max(i) + {w - 1} AS INT) AS e FROM (
    SELECT *, sum(new) OVER (PARTITION BY r, e ORDER BY i) AS part FROM (
      SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY r, e ORDER BY i) <= {w} THEN 0 ELSE 1 END AS new
      FROM {name}_w))
  GROUP BY r, e, m, part)"""


_ASSIGN = ("(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in x) for x in
                            ("password", "passwd", "secret", "token", "api_?key"))
           + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
_NOT_IN = "NOT EXISTS (SELECT 1 FROM {} x WHERE x.r = y.r AND x.s <= y.s AND y.e <= x.e)".format
_OP12 = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text
                        FROM documents),
{_places('assign', 'd', _ASSIGN, 1)},
{_places('access', 'd', 'AKIA[A-Z0-9]{16,}')},
{_places('hex', 'd', '[0-9a-f]{24,}')},
base AS (SELECT r, 0 AS k, 'assign' AS kind, e - length(m) AS s, e FROM assign WHERE length(g) >= 6
  UNION ALL SELECT r, 1, 'access', e - length(m), e FROM access
  UNION ALL SELECT r, 2, 'hex', e - length(m), e FROM hex),
{_entropy('eh', secrets.CLASSES[0][1], secrets.limit(secrets.WINDOW, secrets.CLASSES[0][2]))},
{_entropy('eb', secrets.CLASSES[1][1], secrets.limit(secrets.WINDOW, secrets.CLASSES[1][2]))},
more AS (SELECT * FROM eh y WHERE {_NOT_IN('base')}),
spans AS (SELECT * FROM base UNION ALL SELECT r, 3, 'entropy_hex', s, e FROM more
  UNION ALL SELECT r, 4, 'entropy_base64', s, e FROM eb y WHERE {_NOT_IN('base')} AND {_NOT_IN('more')}),
found AS (SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
    count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (k < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS spans FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (r)
"""

_OP13 = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
whole AS (SELECT count(*) AS nd, sum(len(w)) AS nw FROM d WHERE len(w) > 0),
item AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS t FROM benchmark),
entry AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d)
          SEMI JOIN item USING (t) GROUP BY r, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM entry, whole GROUP BY t, nd),
part AS (SELECT r, t, weight.w * (1000000000 * tf // (1000 * tf + 20 * CAST(
           50 + 50 * len(d.w) * nd // nw AS BIGINT))) AS s
         FROM entry JOIN weight USING (t) JOIN d USING (r), whole),
score AS (SELECT item_id, doc_id, r, CAST(sum(s) AS BIGINT) AS score
          FROM item JOIN part USING (t) JOIN d USING (r) GROUP BY item_id, doc_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
   FROM score WHERE score > 0)
WHERE rank <= 50
"""

ORACLE: dict[str, str] = {"op1_decontamination": _OP1, "op3_sharding": _OP3, "op5_topk": _OP5,
                          "op9_jaccard": _OP9, "op11_periodic_runs": _OP11, "op12_secrets": _OP12,
                          "op13_ranked_search": _OP13}
