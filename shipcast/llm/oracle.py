"""DuckDB SQL for the queries that SQL can state."""

from __future__ import annotations

import string

from .chat import CLOSE, ESCAPE, HEAD, LOSS_ROLE, NEXT, OPEN
from .hard_negatives import ANCHOR_EVERY, DEN, LABELS, LIMIT, LOW, NEGATIVES, POSITIVES, RELABEL_EVERY
from .mixing import MAX_EPOCHS, SEED, SHARE_DEN, SHARE_NUM
from .prefix_trie import FAMILY, HEADS
from .sharding import SHARDS

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_WORD = r"[^\x20\x09-\x0D]+"
_SAID = CLOSE + OPEN + " ok " + HEAD

# Blocks of adjacent turns of one role are gaps and islands.
CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_SAID}' UNION ALL SELECT -7, 1, 'assistant', '{_SAID}'),
l AS (
  SELECT *, lag(role) OVER w AS prior, row_number() OVER w AS seq,
         regexp_replace(text, '{ESCAPE[0]}', '\\1\\\\\\2\\3', 'g') AS body,
         regexp_replace(role, '{ESCAPE[0]}', '\\1\\\\\\2\\3', 'g') AS head
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY seq) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
       CAST(sum(length(body) + CASE WHEN prior = role THEN {len(NEXT)}
            ELSE length(head) + {len(OPEN + HEAD + CLOSE)} END) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id"""

MIXING = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
         md5(coalesce(text, '')) AS tie,
         substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 16) AS k
  FROM documents),
s AS (
  SELECT *, 2 * (r % 3 = 2)::BIGINT + 3 * (r % 3 = 0)::BIGINT + (r % 3 = 1)::BIGINT AS weight,
         source_size * {MAX_EPOCHS} AS cap
  FROM (SELECT source, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source)),
o AS (
  SELECT *, coalesce(sum(cap) OVER w, 0) AS cap_before, coalesce(sum(weight) OVER w, 0) AS weight_before,
         sum(weight) OVER () AS all_weight, sum(source_size) OVER () * {SHARE_NUM} / {SHARE_DEN} AS budget
  FROM s WINDOW w AS (ORDER BY cap / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap <= weight * (budget - cap_before) / (all_weight - weight_before) AS capped FROM o),
g AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE
           weight * (budget - coalesce(sum(cap) FILTER (capped) OVER (), 0))
           / (all_weight - coalesce(sum(weight) FILTER (capped) OVER (), 0)) END AS target
  FROM c),
p AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, CAST(round(g.target) AS BIGINT) AS words,
         CASE WHEN g.source_size > 0 THEN CAST(round(g.target) AS BIGINT) // g.source_size ELSE 0 END AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size, d.tie
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, words - epochs * source_size - place)) AS BIGINT) AS taken
FROM p"""

# CRC-32 byte by byte over a table made from the polynomial.
_CRC = """
k AS MATERIALIZED (
  SELECT list(v ORDER BY n) AS k FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)),
      lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) r(n)))"""

SHARDING = f"""
WITH {_CRC},
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
c AS (
  SELECT doc_id, size, xor(list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(h) // 2),
                        lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
           lambda a, b: xor(a >> 8, k[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM d, k),
p AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place, sum(size) OVER () AS total
  FROM c),
s AS (SELECT *, CAST((2 * place + size) * {SHARDS} // (2 * total) AS INT) AS shard FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
FROM s"""


def _license() -> str:
    """Every place of every key phrase, found by comparing word slices."""
    from .license_scan import WORD, default_templates

    def words(w):
        return "[" + ", ".join(f"'{x}'" for x in w) + "]"

    templates = ",\n    ".join(
        f"({i}, '{t.label}', {words(t.words)}, {words(t.key)}, {t.key_start}, {str(t.base).lower()})"
        for i, t in enumerate(default_templates()))
    return f"""
WITH t(tid, label, words, k, key_start, base) AS (VALUES
    {templates}),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         '{_UPPER}', '{_LOWER}'), '{WORD}') AS w FROM documents),
p AS (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS place FROM d),
h AS (
  SELECT rid, w, label, words, key_start, base, place
  FROM p JOIN t ON word = k[1] JOIN d USING (rid) WHERE w[place + 1:place + len(k)] = k),
f AS (
  SELECT rid, label, base, place,
         len(list_filter(range(len(words)), lambda j: w[place - key_start + j + 1] = words[j + 1]
                         AND place - key_start + j >= 0)) / len(words) AS score
  FROM h),
g AS (
  SELECT rid, count(*) FILTER (base) AS n_base, min(place) FILTER (base) AS first_word,
         max(place) FILTER (base) AS last_word, max(score) AS score,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM f GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, CAST(0 AS DOUBLE)) AS score
FROM d LEFT JOIN g USING (rid)"""


LICENSE = _license()

QUALITY_RULES = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
l AS (SELECT rid, doc_id, text, w, list_filter(string_split(text, chr(10)),
        lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM d),
x AS (
  SELECT rid, unnest(range(len(w) - 7)) AS i,
         unnest(list_transform(range(len(w) - 7), lambda i: array_to_string(w[i + 1:i + 8], ' '))) AS win
  FROM d WHERE len(w) >= 8),
r AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, win) AS n FROM x) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i + j) AS n FROM r, range(8) q(j) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(w, lambda v: v LIKE '%!!')) AS n_shouted,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stuttered
  FROM l LEFT JOIN c USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_symbols * 10 > n_words * 3 OR n_shouted * 10 > n_words * 3
         OR word_chars < n_words * 2 OR word_chars > n_words * 25 OR n_stuttered * 10 > n_words * 3
         OR (n_dup_lines >= 3 AND n_dup_lines * 20 > n_words)) AS kept
FROM (SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed FROM m)"""

TOPK = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(
         range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


HARD_NEGATIVES = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (CAST(label AS BIGINT) + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(least(greatest(floor(256 * CAST(x AS DOUBLE)),
                        -{LIMIT}), {LIMIT}) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.r AS a, a.vec_id AS anchor_id, c.r, c.vec_id, a.label = c.label AS same,
         CAST(coalesce(list_sum(list_transform(range(1, least(len(a.v), len(c.v)) + 1),
              lambda i: a.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM v a JOIN v c ON a.r <> c.r WHERE a.vec_id % {ANCHOR_EVERY} = 0),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, r) <= {POSITIVES}),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
         s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.a, p.r ORDER BY s.score DESC, s.vec_id, s.r) AS INT) AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same
    AND {LOW} * p.score <= {DEN} * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""

# Every prefix of every rebuilt conversation, grouped; sums over subtrees go to every prefix of a node.
PREFIX_TRIE = f"""
WITH {_CRC},
t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            md5(coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, count(*) AS n, hex(CAST(conv_id AS VARCHAR)) AS x FROM t GROUP BY conv_id),
c AS (
  SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, xor(list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(x) // 2),
                        lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
           lambda a, b: xor(a >> 8, k[(xor(a, b) & 255) + 1])), 4294967295) % {HEADS} AS h
  FROM n, k),
r AS (
  SELECT c.conv_id, t.pos, role, text FROM c JOIN t ON t.conv_id = c.base WHERE t.pos < c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(n.n, 0)) + t.pos - c.h, role, text
  FROM c JOIN t USING (conv_id) LEFT JOIN n ON n.conv_id = c.base WHERE t.pos >= c.h),
w AS (
  SELECT conv_id, list(md5(role) || md5(text) ORDER BY pos) AS p, list(length(text) ORDER BY pos) AS l
  FROM r GROUP BY conv_id),
f AS (SELECT conv_id, coalesce(p, []) AS p, coalesce(l, []) AS l FROM c LEFT JOIN w USING (conv_id)),
u AS (SELECT *, unnest(range(len(p) + 1)) AS depth FROM f),
node AS (
  SELECT depth, p[1:depth] AS key, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * coalesce(any_value(CASE WHEN depth > 0 THEN l[depth] END), 0) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = len(p)), '')) AS ends
  FROM u GROUP BY depth, key),
child AS (SELECT depth - 1 AS depth, key[1:depth - 1] AS key, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
leaf AS (SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child USING (depth, key)),
up AS (
  SELECT d, key[1:d] AS key, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM leaf) GROUP BY d, key[1:d])
SELECT x.conv_id, x.depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, up.leaves AS n_leaves,
       CAST(up.saved AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
FROM leaf x JOIN up ON up.d = x.depth AND up.key = x.key
LEFT JOIN node y ON y.depth = x.depth - 1 AND y.key = x.key[1:x.depth - 1]"""
