"""DuckDB SQL for the queries whose rows SQL can give.

Fingerprints, token ids and the language models have none; tests hold them against
brute force.
"""

from __future__ import annotations

import re

from chatsieve.llm.chat import INSTRUCT
from chatsieve.llm.decontaminate import MASKS, MIN_SCORE, MIN_SHARE
from chatsieve.llm.licenses import KEYS, MIN_COVER, NOTICES, PHRASES
from chatsieve.llm.minhash import SHINGLE, SIMILARITY
from chatsieve.llm.scoring import WEIGHT
from chatsieve.llm.substrings import WINDOW

SPACED = r"list_filter(string_split_regex(coalesce({0}, ''), '[\x09-\x0D\x20]+'), lambda x: x <> '')"
PLAIN = r"list_filter(string_split_regex(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, text, {SPACED.format("text")} AS w FROM documents),
reps AS (SELECT min(doc_id) AS doc_id, text, any_value(w) AS w FROM w WHERE len(w) > 0 GROUP BY text),
s AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i : i + {SHINGLE - 1}], ' ')
    FOR i IN range(1, greatest(len(w) - {SHINGLE - 2}, 2))]) AS g
  FROM reps),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_of AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM both_of JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE m >= {SIMILARITY} * (x.n + y.n - m) - 1e-9),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM reps UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
class AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(class_id, w.doc_id) AS class_id, coalesce(class_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN reps USING (text) LEFT JOIN class ON class.a = reps.doc_id
"""

_MARKED = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in INSTRUCT.controls)


def _escapes(column: str) -> str:
    return f"len(regexp_extract_all({column}, '{_MARKED}'))"


_MARKS = " ".join(f"WHEN '{role}' THEN {len(a) + len(b)}" for role, (a, b) in INSTRUCT.marks.items())
_NAMED = sum(map(len, (*INSTRUCT.named, INSTRUCT.closing)))
_ALLOWED = " OR ".join(f"(before = '{a}' AND role IN ({_quoted(b)}))" for a, b in INSTRUCT.follows.items())
OP2 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), '') AS before FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum(length(text) + {_escapes("text")}
    + CASE role {_MARKS} ELSE {_NAMED} + length(role) + {_escapes("role")} END)::BIGINT AS formatted_chars,
  bool_and({_ALLOWED}) AS valid
FROM o GROUP BY conv_id
"""

_SEEDS = " UNION ALL ".join(
    f"SELECT {{0}}, i, {k} AS k, " + ", ".join(f"w[i + {o + 1}] AS c{j}" for j, o in enumerate(mask)) + " FROM {1}"
    for k, mask in enumerate(MASKS)
)
_SPAN = 1 + max(max(m) for m in MASKS)
_AT = "(SELECT {0}, w, unnest(range(0, len(w) - " + str(_SPAN - 1) + ")) AS i FROM {1})"
OP3 = f"""
WITH d AS (SELECT doc_id, {PLAIN.format("text")} AS w FROM documents),
b AS (SELECT item_id, {PLAIN.format("text")} AS w FROM benchmark),
ds AS ({_SEEDS.format("doc_id", _AT.format("doc_id", "d"))}),
bs AS ({_SEEDS.format("item_id", _AT.format("item_id", "b"))}),
hits AS (
  SELECT DISTINCT doc_id, item_id, ds.i - bs.i AS start
  FROM ds JOIN bs USING (k, {", ".join(f"c{j}" for j in range(len(MASKS[0])))})),
laid AS (
  SELECT doc_id, item_id, start, len(b.w) AS item_words, unnest(range(0, len(b.w))) AS j, d.w AS dw, b.w AS bw
  FROM hits JOIN d USING (doc_id) JOIN b USING (item_id)),
steps AS (
  SELECT doc_id, item_id, start, item_words, j + 1 AS j,
    CASE WHEN start + j >= 0 AND dw[start + j + 1] IS NOT DISTINCT FROM bw[j + 1] THEN 1 ELSE -2 END AS v FROM laid
  UNION ALL SELECT DISTINCT doc_id, item_id, start, item_words, 0, 0 FROM laid),
sums AS (SELECT *, sum(v) OVER (PARTITION BY doc_id, item_id, start ORDER BY j) AS s FROM steps),
low AS (
  SELECT *, min(s) OVER (PARTITION BY doc_id, item_id, start ORDER BY j) AS m,
    min({{'s': s, 'j': -j}}) OVER (PARTITION BY doc_id, item_id, start ORDER BY j) AS lowest FROM sums),
best AS (
  SELECT doc_id, item_id, start, item_words, (s - m)::BIGINT AS score, ((s - m) + 2 * (j + lowest.j)) // 3 AS matched,
    row_number() OVER (PARTITION BY doc_id, item_id, start ORDER BY s - m DESC, j) AS r FROM low)
SELECT doc_id, item_id, start, matched::BIGINT AS matched, item_words, score FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY score DESC, matched DESC, start) AS q FROM best
  WHERE r = 1 AND score >= least({MIN_SCORE}, ceil({MIN_SHARE} * item_words)))
WHERE q = 1
"""

_HOST = r"nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '')"
_DAY = "DATE '2024-01-01' + (({0}) % 360)::INTEGER"
OP5 = f"""
WITH p AS (SELECT page_id, url, {_HOST} AS host, {_DAY.format("page_id * 7")} AS fetched_at FROM pages),
f AS (
  SELECT host, min(page_id) AS k, max(contains(url, '/es/')::INT) AS es, regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1) AS domain
  FROM p WHERE host IS NOT NULL GROUP BY host),
c AS (
  SELECT 'ads' AS list, 'block' AS verdict, host AS domain, {_DAY.format("k * 13")} AS since, true AS active FROM f
  UNION ALL SELECT 'ads', 'block', host, {_DAY.format("k * 13")} + 45, false FROM f
  UNION ALL SELECT 'spam', 'block', host, {_DAY.format("k * 5")}, true FROM f WHERE es = 1
  UNION ALL SELECT 'trusted', 'allow', domain, {_DAY.format("k * 11")}, true FROM f WHERE domain <> ''
  UNION ALL SELECT 'trusted', 'allow', domain, {_DAY.format("k * 11")} + 20, false FROM f WHERE domain <> ''),
g AS (SELECT list, domain, since, bool_and(active) AS active, max(verdict) AS verdict FROM c GROUP BY list, domain, since),
v AS (SELECT *, lead(since) OVER (PARTITION BY list, domain ORDER BY since) AS until FROM g),
a AS (
  SELECT page_id, list, verdict, domain FROM p JOIN v
    ON (host = domain OR ends_with(host, '.' || domain)) AND active AND since <= fetched_at AND (until IS NULL OR fetched_at < until)),
j AS (
  SELECT page_id, count(*) AS n_active, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists,
    max({{'size': length(domain), 'allows': verdict = 'allow', 'domain': domain, 'verdict': verdict}}) AS top
  FROM a GROUP BY page_id)
SELECT page_id, host, fetched_at, coalesce(n_active, 0) AS n_active, coalesce(lists, '') AS lists,
  top.domain AS matched, coalesce(top.verdict, 'none') AS verdict
FROM p LEFT JOIN j USING (page_id)
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP6 = f"""
WITH d AS (
  SELECT doc_id, {SPACED.format(_LOWER)} AS w,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS wanted FROM documents),
t AS (SELECT doc_id, wanted, generate_subscripts(w, 1) AS i, unnest(w) AS w FROM d),
n AS (SELECT count(*) AS nb, count(*) FILTER (wanted) AS nt FROM t),
v AS (SELECT w, count(*) AS b, count(*) FILTER (wanted) AS t FROM t GROUP BY w),
u AS (
  SELECT w, b, t FROM v
  UNION ALL SELECT NULL, nb - coalesce((SELECT sum(b) FROM v), 0), nt - coalesce((SELECT sum(t) FROM v), 0) FROM n),
chance AS (
  SELECT w, b, t, (b + 1) / (nb + size)::DOUBLE AS pb, (t + 1) / (nt + size)::DOUBLE AS pt
  FROM u, n, (SELECT count(*) AS size FROM u)),
k AS (SELECT doc_id, wanted, i, v.w FROM t LEFT JOIN v USING (w)),
q AS (SELECT *, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS h FROM k),
pair AS (
  SELECT h, w, count(*) AS b, count(*) FILTER (wanted) AS t FROM q WHERE i > 1 GROUP BY h, w),
loss AS (
  SELECT doc_id,
    CASE WHEN i = 1 THEN -ln(c.pt) WHEN pair.b IS NULL THEN -ln({1 - WEIGHT} * c.pt)
      ELSE -ln({WEIGHT} * pair.t / greatest(x.t, 1) + {1 - WEIGHT} * c.pt) END AS lt,
    CASE WHEN i = 1 THEN -ln(c.pb) WHEN pair.b IS NULL THEN -ln({1 - WEIGHT} * c.pb)
      ELSE -ln({WEIGHT} * pair.b / greatest(x.b, 1) + {1 - WEIGHT} * c.pb) END AS lb
  FROM q JOIN chance c ON c.w IS NOT DISTINCT FROM q.w JOIN chance x ON x.w IS NOT DISTINCT FROM q.h
  LEFT JOIN pair ON i > 1 AND pair.h IS NOT DISTINCT FROM q.h AND pair.w IS NOT DISTINCT FROM q.w)
SELECT doc_id, coalesce(n, 0) AS n_tokens, round(a, 4) AS target_loss, round(z, 4) AS background_loss, round(a - z, 4) AS score
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n, avg(lt) AS a, avg(lb) AS z FROM loss GROUP BY doc_id) USING (doc_id)
"""

_TEMPLATES = [(k, label, text.split(), must) for k, (label, text, must) in enumerate(NOTICES)]


def _places(text: list[str], must: tuple[str, ...]) -> set[int]:
    held: set[int] = set()
    for phrase in must:
        at = len(f" {' '.join(text)} "[: f" {' '.join(text)} ".index(f" {phrase} ")].split())
        held |= set(range(at, at + len(phrase.split())))
    return held


_POSTINGS = ", ".join(
    f"({k}, '{label}', {p}, '{w}', {str(p in _places(text, must)).lower()}, {len(text)})"
    for k, label, text, must in _TEMPLATES
    for p, w in enumerate(text)
)
_STANDS = " UNION ALL ".join(
    f"SELECT doc_id, i, '{label}' AS label FROM pos WHERE "
    + " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(phrase.split()))
    for phrase, label in PHRASES.items()
)
OP7 = f"""
WITH d AS (SELECT doc_id, {PLAIN.format("text")} AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM d),
base AS ({_STANDS}),
post(tpl, label, p, word, must, size) AS (VALUES {_POSTINGS}),
seen AS (SELECT word, count(DISTINCT doc_id) AS n FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY word),
keyed AS (
  SELECT tpl, word FROM (
    SELECT tpl, word, row_number() OVER (PARTITION BY tpl ORDER BY coalesce(n, 0), word) AS r
    FROM (SELECT DISTINCT tpl, word FROM post) LEFT JOIN seen USING (word)) WHERE r <= {KEYS}),
cand AS (
  SELECT DISTINCT doc_id, tpl, i - p AS start FROM pos JOIN post ON w[i + 1] = word JOIN keyed USING (tpl, word)),
cover AS (
  SELECT doc_id, tpl, start, label, size, count(*) FILTER (ok) AS hit, bool_and(ok OR NOT must) AS sound FROM (
    SELECT doc_id, tpl, start, label, size, must,
      start + p >= 0 AND coalesce(d.w[start + p + 1] = word, false) AS ok
    FROM cand JOIN post USING (tpl) JOIN d USING (doc_id)) GROUP BY ALL),
full_of AS (SELECT doc_id, label, hit / size AS share FROM cover WHERE sound AND hit / size >= {MIN_COVER})
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  greatest(coalesce(share, 0.0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score
FROM d
LEFT JOIN (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
  array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels FROM base GROUP BY doc_id) USING (doc_id)
LEFT JOIN (SELECT doc_id, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM (
  SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM full_of) GROUP BY doc_id) USING (doc_id)
LEFT JOIN (SELECT doc_id, max(share) AS share FROM full_of GROUP BY doc_id) USING (doc_id)
"""

OP8 = f"""
WITH d AS (SELECT doc_id, {SPACED.format("text")} AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i + 1 : i + {WINDOW}], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - {WINDOW - 1})) AS i FROM d)),
first_of AS (SELECT h, min(doc_id) AS first_id FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS j FROM win JOIN first_of USING (h) WHERE first_id < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS j FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS text
  FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP12 = """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256(concat('1:', doc_id)) AS s FROM documents),
d AS (
  SELECT doc_id, t, length(t) AS n, [('0x' || s[8 * k + 1 : 8 * k + 8])::BIGINT FOR k IN range(4)] AS h FROM h),
f AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h[3] % 100 >= 90 THEN 'plain'
      WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS x FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m
    WHEN 'spm' THEN '<S>' || x || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c
"""

EXPECTED: dict[str, str] = {
    "op1_minhash": OP1,
    "op2_chat": OP2,
    "op3_decontaminate": OP3,
    "op5_urls": OP5,
    "op6_scoring": OP6,
    "op7_licenses": OP7,
    "op8_substrings": OP8,
    "op12_infill": OP12,
}
