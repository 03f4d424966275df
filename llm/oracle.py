"""DuckDB SQL for the queries that SQL can state."""

from __future__ import annotations

from llm.mixing import POWER, SEED
from llm.quality import STOP_WORDS
from llm.url_filter import DEPTH, LEAST_PURITY, LEAST_SHARE, LEAST_URLS, MOST_BRANCHES, SMOOTHING, Z_SQUARED

_STOP = ", ".join(f"'{form(w)}'" for w in sorted(set(STOP_WORDS)) for form in (str.lower, str.capitalize, str.upper))

_FIELDS = ("doc_id", "source", "lang", "n_chars", "{text}")
_LEAF = "sha256(" + " || ".join(
    f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in _FIELDS
) + ")"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Levels of a tree that the statement has room for: eight to this power of leaves.
_LEVELS = 7


def _tree(name: str, nodes: str, group: str) -> str:
    """Levels of the tree over `nodes(group, i, digest)` as `name_0`, `name_1`, ...; a lone node stays as it is."""
    parts, source = [], nodes
    for level in range(_LEVELS):
        parts.append(f"""
{name}_{level} AS (
  SELECT {group}, i, digest, count(*) OVER (PARTITION BY {group}) AS total,
    list(digest) OVER (PARTITION BY {group}, i // 8 ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run
  FROM {source}),
{name}_{level}_up AS (
  SELECT {group}, i // 8 AS i,
    CASE WHEN any_value(total) = 1 THEN any_value(digest) ELSE sha256(array_to_string(any_value(run), '')) END AS digest
  FROM {name}_{level} GROUP BY {group}, i // 8)""")
        source = f"{name}_{level}_up"
    return ",".join(parts)


def _walk(name: str, source: str, group: str) -> str:
    """Fold `source(id, group, i, proof, cur)` up the levels of the tree, as `name_w0`, `name_w1`, ..."""
    parts = []
    for level in range(_LEVELS):
        parts.append(f"""
{name}_w{level} AS (
  SELECT s.* EXCLUDE (i, proof, cur), s.i // 8 AS i,
    CASE WHEN n.total = 1 THEN proof ELSE proof || array_to_string(run[1:n.i % 8], '') || array_to_string(run[n.i % 8 + 2:], '') END AS proof,
    CASE WHEN n.total = 1 THEN cur
      ELSE sha256(array_to_string(run[1:n.i % 8], '') || cur || array_to_string(run[n.i % 8 + 2:], '')) END AS cur
  FROM {source} s JOIN {name}_{level} n ON s.{group} IS NOT DISTINCT FROM n.{group} AND s.i = n.i)""")
        source = f"{name}_w{level}"
    return ",".join(parts)


_MERKLE = f"""
WITH c AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]),
      lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))),
    4294967295::UBIGINT) AS crc
  FROM documents),
l AS (
  SELECT doc_id, lang, {_LEAF.format(text="text")} AS leaf,
    CASE WHEN crc % 3 = 0 THEN {_LEAF.format(text=_LOWER)} ELSE {_LEAF.format(text="text")} END AS changed
  FROM c),
leaves AS (
  SELECT *, leaf AS digest, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
{_tree("d", "leaves", "lang")},
tops AS (
  SELECT 1 AS one, lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM d_{_LEVELS - 1}_up),
{_tree("t", "tops", "one")},
starts AS (SELECT doc_id, lang, leaf, i, '' AS proof, changed AS cur FROM leaves),
{_walk("d", "starts", "lang")},
crossed AS (
  SELECT w.* EXCLUDE (i), 1 AS one, t.i, t.digest AS subroot
  FROM d_w{_LEVELS - 1} w JOIN tops t ON w.lang IS NOT DISTINCT FROM t.lang),
{_walk("t", "crossed", "one")}
SELECT w.doc_id, w.leaf, w.subroot, r.digest AS root, sha256(w.proof) AS proof_sha256,
  w.cur AS folded_root, w.cur = r.digest AS verified
FROM t_w{_LEVELS - 1} w, t_{_LEVELS - 1}_up r
"""



def _url_levels() -> str:
    """The tree of path templates, level by level, as `rows_1`, `rows_2`, ... over `rows_0`."""

    def alike(c: str) -> str:
        n, m = "n::DOUBLE", "n_::DOUBLE"
        return (
            f"pow({c}::DOUBLE * {m} - {c}_::DOUBLE * {n}, 2.0::DOUBLE) * ({n} + {m}) <= {Z_SQUARED}::DOUBLE * ({c} + {c}_)::DOUBLE"
            f" * ({n} + {m} - {c}::DOUBLE - {c}_::DOUBLE) * {n} * {m}"
        )

    parts = []
    for level in range(DEPTH + 1):
        beside = (
            f"PARTITION BY host, template ORDER BY n < {LEAST_URLS}, bad / n, good / n, ended / n, numbered / n, segment"
        )
        parts.append(f"""
nodes_{level} AS (
  SELECT host, template, segments[{level + 1}] AS segment, sum(n)::BIGINT AS n, sum(good)::BIGINT AS good, sum(bad)::BIGINT AS bad,
    sum(CASE WHEN len(segments) = {level + 1} THEN n ELSE 0 END)::BIGINT AS ended,
    sum(CASE WHEN contains(segments[{level + 2}], '#') THEN n ELSE 0 END)::BIGINT AS numbered
  FROM rows_{level} WHERE len(segments) > {level} GROUP BY ALL),
kept_{level} AS (
  SELECT * FROM (
    SELECT *, count(*) OVER (PARTITION BY host, template) AS branches, sum(n) OVER (PARTITION BY host, template) AS whole FROM nodes_{level})
  WHERE branches <= {MOST_BRANCHES} OR n >= {LEAST_SHARE}::DOUBLE * whole),
beside_{level} AS (
  SELECT *, lag(n) OVER w AS n_, lag(good) OVER w AS good_, lag(bad) OVER w AS bad_, lag(ended) OVER w AS ended_,
    lag(numbered) OVER w AS numbered_
  FROM kept_{level} WINDOW w AS ({beside})),
part_{level} AS (
  SELECT *, sum(CASE WHEN n >= {LEAST_URLS} AND n_ >= {LEAST_URLS} AND {alike("good")} AND {alike("bad")}
    AND {alike("ended")} AND {alike("numbered")} THEN 0 ELSE 1 END) OVER ({beside}) AS part
  FROM beside_{level}),
branch_{level} AS (
  SELECT host, template, unnest(segments) AS segment,
    CASE WHEN len(segments) > 1 THEN '(' || array_to_string(segments, '|') || ')' ELSE segments[1] END AS branch
  FROM (SELECT host, template, list(segment ORDER BY segment) AS segments FROM part_{level} GROUP BY host, template, part)),
rows_{level + 1} AS (
  SELECT r.* EXCLUDE (template), CASE WHEN len(r.segments) > {level} THEN r.template || '/' || coalesce(b.branch, '*') ELSE r.template END AS template
  FROM rows_{level} r LEFT JOIN branch_{level} b
    ON r.host = b.host AND r.template = b.template AND r.segments[{level + 1}] = b.segment)""")
    return ",".join(parts)


_URLS = rf"""
WITH u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules AS (
  SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')) t(ruled, rule_host, rule_path)),
ruled AS (
  SELECT u.*, (SELECT max_by(struct_pack(name := rule_host || rule_path, ruled := ruled), length(rule_host || rule_path)) FROM rules
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS r,
    array_to_string(list_transform(string_split(path, '/'), lambda s:
      CASE WHEN regexp_full_match(s, '[0-9a-fA-F-]{{8,}}') AND regexp_matches(s, '[0-9]') THEN '#'
        ELSE regexp_replace(s, '[0-9]+', '#', 'g') END), '/') AS general
  FROM u),
paths AS (
  SELECT host, general, count(*) AS n, count(*) FILTER (r.ruled = 'allow') AS good, count(*) FILTER (r.ruled = 'block') AS bad
  FROM ruled GROUP BY ALL),
cut AS (SELECT *, string_split(general, '/') AS parts FROM paths),
rows_0 AS (
  SELECT host, general, n, good, bad, '' AS template,
    CASE WHEN len(parts) > {DEPTH + 1} THEN parts[2:{DEPTH + 1}] || [array_to_string(parts[{DEPTH + 2}:], '/')] ELSE parts[2:] END AS segments
  FROM cut),
{_url_levels()},
done AS (
  SELECT host, general, template,
    (sum(good) OVER w + {SMOOTHING / 2}::DOUBLE) / (sum(good) OVER w + sum(bad) OVER w + {SMOOTHING}::DOUBLE) AS purity
  FROM rows_{DEPTH + 1} WINDOW w AS (PARTITION BY host, template))
SELECT page_id, ruled.host, path, r.name AS rule,
  coalesce(r.ruled, CASE WHEN purity < {LEAST_PURITY}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict, template, purity
FROM ruled JOIN done ON ruled.host = done.host AND ruled.general = done.general
"""

SQL: dict[str, str] = {
    "op13_hard_negatives": """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM r a JOIN r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> s.anchor_label
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
""",
    "op11_url_filters": _URLS,
    "op12_merkle_manifest": _MERKLE,
    "op2_quality_rules": rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t),
places AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i+4]) AS n FROM places),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM windows, (SELECT unnest(range(0, 5)) AS k) WHERE n > 1 GROUP BY doc_id),
c AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
    len(list_filter(words, lambda x: x IN ({_STOP})))::BIGINT AS n_stop_words,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)$')))::BIGINT AS n_ellipsis_lines
  FROM w LEFT JOIN covered USING (doc_id)),
r AS (
  SELECT *, n_words < 10 AS words, 100 * n_repeat_words > 20 * greatest(n_words, 1) AS repeated_words,
    word_chars < 2 * greatest(n_words, 1) OR word_chars > 15 * greatest(n_words, 1) AS mean_word_length,
    100 * n_symbols > 10 * greatest(n_words, 1) AS symbols,
    n_stop_words / greatest(n_words, 1) < 0.02 AND n_words >= 50 AS stop_words,
    100 * n_dup_lines > 50 * greatest(n_lines, 1) AS duplicate_lines,
    100 * n_ellipsis_lines > 30 * greatest(n_lines, 1) AS ellipsis_lines
  FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  words OR repeated_words AS base_failed,
  NOT (words OR repeated_words OR mean_word_length OR symbols OR stop_words OR duplicate_lines
    OR ellipsis_lines) AS kept,
  coalesce(concat_ws(',', CASE WHEN words THEN 'words' END,
    CASE WHEN repeated_words THEN 'repeated_words' END,
    CASE WHEN mean_word_length THEN 'mean_word_length' END, CASE WHEN symbols THEN 'symbols' END,
    CASE WHEN stop_words THEN 'stop_words' END, CASE WHEN duplicate_lines THEN 'duplicate_lines' END,
    CASE WHEN ellipsis_lines THEN 'ellipsis_lines' END), '') AS failed_rules
FROM r
""",
    "op6_mixing": f"""
WITH s AS (
  SELECT source, sum(coalesce(length(text), 0)) AS n_chars FROM documents GROUP BY source),
r AS (
  SELECT source, pow(n_chars::DOUBLE, {POWER}) / sum(pow(n_chars::DOUBLE, {POWER})) OVER ()
    * (sum(n_chars) OVER ())::DOUBLE / n_chars AS rate FROM s WHERE n_chars > 0),
k AS (SELECT source, rate, unnest(range(0, (ceil(rate + 12 * sqrt(rate) + 20))::BIGINT + 1)) AS k FROM r),
p AS (SELECT source, k, exp(k * ln(rate) - rate - CASE WHEN k > 0 THEN lgamma(k + 1) ELSE 0 END) AS p FROM k),
c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS chance FROM p),
u AS (
  SELECT *, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT
    / 4503599627370496.0::DOUBLE AS u FROM documents),
n AS (
  SELECT u.doc_id, u.source, u.text, count(*) AS n
  FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source AND c.chance <= u.u
  GROUP BY ALL),
x AS (SELECT doc_id, source, text, unnest(range(1, n + 1))::INTEGER AS copy FROM n)
SELECT doc_id, source, copy, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || copy) AS shuffle_key, text
FROM x
""",
    "op10_decontamination": r"""
WITH iw AS (
  SELECT item_id::VARCHAR AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL),
ip AS (
  SELECT item, words, least(len(words), 10) AS size,
    unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM iw WHERE len(words) > 0),
w AS (SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS gram FROM ip),
d AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
dp AS (
  SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
  FROM d, (SELECT DISTINCT size FROM w) WHERE len(words) >= size),
g AS (SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS gram FROM dp),
h AS (SELECT g.doc_id, g.size, g.i, w.item FROM g JOIN w USING (size, gram)),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS at FROM h),
hits AS (SELECT doc_id, count(*) AS n FROM places GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list_distinct(list(item))) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit,
  coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, hits.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
""",
}
