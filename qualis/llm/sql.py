"""DuckDB SQL of the queries that SQL can express, over the same whole tables."""

from __future__ import annotations

# words: maximal runs outside 0x20 and 0x09-0x0D
WORDS = r"""list_filter(regexp_split_to_array(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""
LOWER_AZ = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, {WORDS.format(text=LOWER_AZ.format(text='text'))} AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))
      WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END) AS s FROM w),
e AS MATERIALIZED (SELECT doc_id, unnest(s) AS x FROM s),
rare AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS MATERIALIZED (SELECT r.a, r.b FROM rare r JOIN s x ON x.doc_id = r.a JOIN s y ON y.doc_id = r.b
  WHERE 100 * r.inter >= 75 * (len(x.s) + len(y.s) - r.inter)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, c) AS (SELECT doc_id, doc_id FROM s UNION SELECT l.b, r.c FROM reach r JOIN both_ways l ON l.a = r.doc_id
  WHERE r.c < l.b)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.c) AS component_id, min(r.c) = s.doc_id AS kept
FROM s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, len(s.s)
"""

SPACES = r"[\x20\x09-\x0D]"
OP1 = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS.format(text='text')} AS w,
    {WORDS.format(text=LOWER_AZ.format(text='text'))} AS lw FROM documents),
c AS MATERIALIZED (
  SELECT doc_id, lang, len(w) AS n,
    len(regexp_replace(t, '[^a-z]', '', 'g')) AS k1, len(regexp_replace(t, '[^A-Z]', '', 'g')) AS k2,
    len(regexp_replace(t, '[^0-9]', '', 'g')) AS k3, len(t) - len(regexp_replace(t, '{SPACES}', '', 'g')) AS k4,
    len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS k5, len(regexp_replace(t, '[\x00-\x7F]', '', 'g')) AS k7, len(t) AS k0
  FROM d),
k AS MATERIALIZED (
  SELECT doc_id, lang, n, unnest([1, 2, 3, 4, 5, 6, 7]) AS kind,
    unnest([k1, k2, k3, k4, k5, k0 - k1 - k2 - k3 - k4 - k5 - k7, k7]) AS x, k0 FROM c),
win AS MATERIALIZED (
  SELECT doc_id, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS r FROM (
    SELECT win.doc_id, unnest(range(win.i, win.i + 5)) AS p FROM win
    JOIN (SELECT doc_id, x FROM win GROUP BY ALL HAVING count(*) > 1) two ON two.doc_id = win.doc_id AND two.x = win.x)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_replace(l, '{SPACES}', '', 'g') <> '' GROUP BY doc_id),
tok AS MATERIALIZED (
  SELECT doc_id, lang, x, count(*) AS n FROM (SELECT doc_id, lang, unnest(lw) AS x FROM d) GROUP BY ALL),
total AS MATERIALIZED (SELECT lang, sum(n) AS n FROM tok WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n) >= 2000),
top AS MATERIALIZED (
  SELECT a.lang, a.x, a.n / total.n AS q
  FROM (SELECT lang, x, sum(n) AS n, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, x) AS r FROM tok
        WHERE lang IS NOT NULL GROUP BY lang, x) a JOIN total ON total.lang = a.lang WHERE r <= 40),
bins AS (
  SELECT c.doc_id, top.lang AS ref, top.q, coalesce(tok.n, 0) AS x, c.n FROM c CROSS JOIN top
  LEFT JOIN tok ON tok.doc_id = c.doc_id AND tok.x = top.x),
bins2 AS (
  SELECT doc_id, ref, q, x / greatest(n, 1) AS p FROM bins UNION ALL
  SELECT doc_id, ref, 1 - sum(q), (n - sum(x)) / greatest(n, 1) FROM bins GROUP BY doc_id, ref, n),
wd AS (
  SELECT doc_id, ref, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS dist FROM bins2 GROUP BY doc_id, ref),
near AS (SELECT doc_id, min(dist) AS dist, arg_min(ref, (dist, ref)) AS ref FROM wd GROUP BY doc_id),
kref AS (
  SELECT k.lang, kind, sum(x) / any_value(s.s) AS q FROM k JOIN (SELECT lang, sum(x) AS s FROM k GROUP BY lang) s
  ON s.lang = k.lang GROUP BY k.lang, kind),
cd AS (
  SELECT doc_id, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS dist
  FROM (SELECT k.doc_id, k.x / greatest(k.k0, 1) AS p, kref.q FROM k JOIN near ON near.doc_id = k.doc_id
        JOIN kref ON kref.lang = near.ref AND kref.kind = k.kind) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, len(regexp_replace(d.t, '{SPACES}', '', 'g'))::BIGINT AS word_chars,
  c.k5::BIGINT AS n_symbols, coalesce(lines.dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.r, 0)::BIGINT AS n_repeat_words,
  len(d.w) < 10 OR 100 * coalesce(rep.r, 0) > 20 * len(d.w) AS base_failed,
  NOT (len(d.w) < 10 OR 100 * coalesce(rep.r, 0) > 20 * len(d.w))
    AND NOT (len(d.w) >= 40 AND (coalesce(near.dist, 0) > 0.45 OR coalesce(cd.dist, 0) > 0.28)) AS kept
FROM d JOIN c ON c.doc_id = d.doc_id LEFT JOIN lines ON lines.doc_id = d.doc_id LEFT JOIN rep ON rep.doc_id = d.doc_id
LEFT JOIN near ON near.doc_id = d.doc_id LEFT JOIN cd ON cd.doc_id = d.doc_id
"""

_TURN = "'<|im_start|>' || replace(x.role, '<|', '< |') || chr(10) || replace(x.text, '<|', '< |') || '<|im_end|>' || chr(10)"
_JOIN = "coalesce(array_to_string(list_transform({part}, lambda x: {turn}), ''), '')"
_MASK = """coalesce(array_to_string(flatten(list_transform({part}, lambda x: [
  '0:' || (len(replace(x.role, '<|', '< |')) + 13), (CASE WHEN x.role = 'assistant' THEN '1:' ELSE '0:' END)
  || (len(replace(x.text, '<|', '< |')) + 10), '0:1'])), ','), '')"""
OP8 = f"""
WITH t AS MATERIALIZED (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
n AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM t),
last AS MATERIALIZED (SELECT conv_id, max(i) AS i, arg_max(text, i) AS reply FROM n WHERE role = 'assistant' GROUP BY conv_id),
sides AS MATERIALIZED (
  SELECT n.conv_id, n.i, n.role, n.text AS c,
    CASE WHEN n.i = last.i THEN donor.reply ELSE n.text END AS r
  FROM n LEFT JOIN last ON last.conv_id = n.conv_id LEFT JOIN last donor ON donor.conv_id = n.conv_id + 1
  WHERE last.i IS NULL OR n.i <= last.i),
cut AS (
  SELECT conv_id, coalesce(min(CASE WHEN r IS NULL OR r <> c THEN i END), max(i) + 1) - 1 AS k FROM sides GROUP BY conv_id),
arr AS (
  SELECT s.conv_id, any_value(k) AS k, list({{'role': role, 'text': c}} ORDER BY i) FILTER (i <= k) AS p,
    list({{'role': role, 'text': c}} ORDER BY i) FILTER (i > k) AS c,
    list({{'role': role, 'text': r}} ORDER BY i) FILTER (i > k AND r IS NOT NULL) AS r
  FROM sides s JOIN cut ON cut.conv_id = s.conv_id GROUP BY s.conv_id)
SELECT conv_id, k::BIGINT AS prompt_turns, {_JOIN.format(part='p', turn=_TURN)} AS prompt,
  {_JOIN.format(part='c', turn=_TURN)} AS chosen, {_JOIN.format(part='r', turn=_TURN)} AS rejected,
  {_MASK.format(part='c')} AS chosen_mask, {_MASK.format(part='r')} AS rejected_mask,
  len(coalesce(c, [])) > 0 OR len(coalesce(r, [])) > 0 AS usable FROM arr
"""

OP10 = """
WITH p AS MATERIALIZED (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN coalesce(page_id <> first_id, first_id IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN coalesce(page_id <> first_id, first_id IS NOT NULL) THEN first_id END AS refers_to
FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest
"""

_CUTS = "list_transform(range(1, k), lambda i: {{'i': i, 'f': list_aggregate(w[1:i], 'string_agg', ' '), 'r': list_aggregate(w[i + 1:], 'string_agg', ' ')}})"
OP13 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({LOWER_AZ.format(text="coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
words AS MATERIALIZED (
  SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_aggregate(w[i:i + k - 1], 'string_agg', ' '))) AS phrase
  FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*)::BIGINT AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, phrase, a, unnest({_CUTS.format()}) AS c FROM f WHERE k > 1),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cuts.c.i AS i, l.a AS l, r.a AS r,
    ((2000000::HUGEINT * cuts.a) // (l.a::HUGEINT + r.a))::BIGINT AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = cuts.c.f JOIN f r ON r.lang = cuts.lang AND r.phrase = cuts.c.r),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inner_part AS (
  SELECT lang, a, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2),
    lambda i: list_aggregate(w[i:i + m - 1], 'string_agg', ' '))))) AS phrase FROM f WHERE k > 2),
around AS (SELECT lang, phrase, max(a) AS a FROM inner_part GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank,
  b.phrase, b.a, b.l, b.r, sizes.n, b.score
FROM best b JOIN sizes ON sizes.lang = b.lang LEFT JOIN around ON around.lang = b.lang AND around.phrase = b.phrase
WHERE around.a IS NULL OR 100::HUGEINT * around.a < 80::HUGEINT * b.a
QUALIFY row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) <= 2000
"""

ORACLES = {
    "op1_divergence": OP1,
    "op2_superminhash": OP2,
    "op8_preference": OP8,
    "op10_warc_index": OP10,
    "op13_collocation": OP13,
}
