"""The same results as the queries, in SQL over the given tables."""

from __future__ import annotations

from chatsieve.functions.text import FUNCTION_WORDS, LEET, LOOK_ALIKES, SPACE_RUN_PATTERN
from chatsieve.plans.queries import ALLOWED, FEW_WORDS, INNER_WORDS, STOP_WORDS
from chatsieve.plans.tables import WORDS

L = r"[\p{L}\p{N}_]"
NOT_L = r"[^\p{L}\p{N}_]"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def bounded(words) -> str:
    return f"(?i)(^|{NOT_L})(?:{'|'.join(words)})($|{NOT_L})"


def hit(column, words=WORDS) -> str:
    return f"regexp_matches({column}, '{bounded(words)}')"


def inside(column, words=WORDS) -> str:
    return f"regexp_matches({column}, '(?i)(?:{'|'.join(words)})')"


TEXTS = "texts AS (SELECT doc_id AS id, text AS message, lang, source FROM documents)"
MSGS = (
    "msgs AS (SELECT d.doc_id AS id, d.text AS message, d.lang, d.source,"
    " CAST(CASE WHEN l.toxic = 0 THEN 0 ELSE 1 + d.doc_id % 5 END AS INTEGER) AS label, l.toxic <> 0 AS toxic"
    " FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
)
FLAGGED = MSGS + f", flagged AS (SELECT *, {hit('message')} AS flagged FROM msgs)"
NAMES = f"""names AS (SELECT id, CASE id % 6
  WHEN 0 THEN a || w WHEN 1 THEN upper(a[1]) || a[2:] || upper(w[1]) || w[2:] WHEN 2 THEN a || '-' || w
  WHEN 3 THEN upper(a[1]) || a[2:] || upper(b[1]) || b[2:] WHEN 4 THEN a || '_' || b
  ELSE upper(w) || CAST(id AS VARCHAR) END AS author
  FROM (SELECT doc_id * 1000000 + i - 1 AS id, lower(ws[i]) AS a, lower(ws[i + 1]) AS b,
    ([{quoted(WORDS)}])[(doc_id * 1000000 + i - 1) % 10 + 1] AS w
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z]+') AS ws FROM documents))))"""
SEGMENTS = (
    "flatten(list_transform(regexp_split_to_array(author, '[^a-zA-Z0-9]+'),"
    r" lambda p: regexp_extract_all(p, '[A-Z]*[a-z]+|[A-Z]+\b|[0-9]+')))"
)
CAPS = NAMES + (
    f", caps AS (SELECT id, author, list_has_any(list_transform({SEGMENTS}, lambda s: lower(s)),"
    f" [{quoted(WORDS)}]) AS flagged FROM names)"
)
DOC_TOKENS = f"regexp_extract_all(lower(message), '{TOKEN}')"


def tokens_of(source: str, extra: str = "") -> str:
    return f"SELECT id{extra}, unnest({DOC_TOKENS}) AS term FROM {source}"


WORD_TABLE = (
    "word_table AS (SELECT DISTINCT word FROM (SELECT unnest(regexp_extract_all(lower(text),"
    f" '{TOKEN}')) AS word FROM benchmark) WHERE length(word) >= 9 UNION SELECT unnest([{quoted(WORDS)}]))"
)
# Words of all documents; neighbouring words of benchmark items; pieces of every text, and of
# neighbouring phrases those that count from the left.
EVERY_WORD = (
    f"single AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{L}+')) AS word FROM documents),"
    f" bench AS (SELECT regexp_extract_all(lower(text), '{L}+') AS w FROM benchmark),"
    " phrase AS (SELECT DISTINCT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS word FROM bench)"
)
PLACED = (
    f"parts AS (SELECT id, regexp_extract_all(message, '{L}+|{NOT_L}+') AS p FROM texts),"
    f" cut AS (SELECT id, unnest(p) AS part, generate_subscripts(p, 1) AS pos FROM parts),"
    " near AS (SELECT *, sum(length(part)) OVER w::BIGINT AS end_pos, lower(part) AS low,"
    f" regexp_matches(part, '^{L}') AS wordy, part || lead(part) OVER w || lead(part, 2) OVER w AS three"
    " FROM cut WINDOW w AS (PARTITION BY id ORDER BY pos)),"
    " begun AS (SELECT id, pos, pos - 2 * row_number() OVER (PARTITION BY id ORDER BY pos) AS run"
    " FROM near WHERE wordy AND lower(three) IN (FROM phrase)),"
    " taken AS (SELECT id, pos FROM (SELECT id, pos, row_number() OVER (PARTITION BY id, run ORDER BY pos) AS n FROM begun)"
    " WHERE n % 2 = 1),"
    " state AS (SELECT near.*, t0.pos IS NOT NULL AS opens, t1.pos IS NOT NULL OR t2.pos IS NOT NULL AS covered FROM near"
    " LEFT JOIN taken t0 ON t0.id = near.id AND t0.pos = near.pos LEFT JOIN taken t1 ON t1.id = near.id AND t1.pos = near.pos - 1"
    " LEFT JOIN taken t2 ON t2.id = near.id AND t2.pos = near.pos - 2)"
)
CACHE = "cache AS (SELECT sha256(message) AS k, bool_or(toxic) AS verdict FROM msgs GROUP BY 1)"
MEASURES = """round(coalesce((tp + tn)::DOUBLE / nullif(tp + fp + fn + tn, 0), 0), 6) AS accuracy,
 round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS "precision",
 round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall,
 round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1"""


def counts(pred="flagged", truth="toxic") -> str:
    return (
        f"count(*) FILTER ({truth} AND {pred}) AS tp, count(*) FILTER (NOT {truth} AND {pred}) AS fp,"
        f" count(*) FILTER ({truth} AND NOT {pred}) AS fn, count(*) FILTER (NOT {truth} AND NOT {pred}) AS tn"
    )


def distance(term, word) -> str:
    """Edit distance in characters. The function counts bytes, so characters outside
    ASCII, which are in none of the words, become one byte each."""
    return f"levenshtein(regexp_replace({term}, '[^\\x00-\\x7F]', '?', 'g'), {word})"


def metrics_by(key: str) -> str:
    return (
        f"WITH {FLAGGED}, c AS (SELECT {key}, {counts()} FROM flagged GROUP BY {key})"
        f" SELECT {key}, tp, fp, fn, tn, {MEASURES} FROM c"
    )


def normalised() -> str:
    source = "".join(LOOK_ALIKES) + "".join(LEET)
    target = "".join(v * len(k) for k, v in LOOK_ALIKES.items()) + "".join(LEET.values())
    run = r"\b(?:[a-z][ .*-]){2,}[a-z]\b"
    joined = (
        "array_to_string(list_transform(range(1, len(parts) + 1), lambda i: parts[i] ||"
        " coalesce(regexp_replace(runs[i], '[ .*-]', '', 'g'), '')), '')"
    )
    out = "s"
    for letter in "abcdefghijklmnopqrstuvwxyz":
        out = f"regexp_replace({out}, '{letter}{{3,}}', '{letter}', 'g')"
    return (
        f"WITH {TEXTS}, n1 AS (SELECT id, regexp_replace(translate(lower(message), '{source}', '{target}'),"
        r" '!([a-z])', 'i\1', 'g') AS t FROM texts),"
        f" n2 AS (SELECT id, string_split_regex(t, '{run}') AS parts, regexp_extract_all(t, '{run}') AS runs FROM n1),"
        f" n3 AS (SELECT id, {joined} AS s FROM n2), norm AS (SELECT id, {out} AS normalised FROM n3)"
    )


def censored(column: str, replacement_by_pattern: dict[str, str]) -> str:
    """Every replacement runs twice, since neighbouring words share a separator."""
    out = column
    for words, stars in replacement_by_pattern.items():
        for _ in range(2):
            out = rf"regexp_replace({out}, '(?i)(^|{NOT_L})(?:{words})($|{NOT_L})', '\1{stars}\2', 'g')"
    return out


FIXED_STARS = {"|".join(WORDS): "***"}
CHAR_STARS = {
    "|".join(w for w in WORDS if len(w) == n): "*" * n for n in sorted({len(w) for w in WORDS})
}


def language() -> str:
    langs = sorted(FUNCTION_WORDS)
    rows = " UNION ALL ".join(
        f"SELECT id, '{lang}' AS language, {i} AS pos, len(list_filter(w, lambda x: x IN ({quoted(FUNCTION_WORDS[lang])})))"
        " AS votes FROM t"
        for i, lang in enumerate(langs)
    )
    return (
        f"WITH {TEXTS}, t AS (SELECT id, regexp_extract_all(lower(message), '{L}+') AS w FROM texts),"
        f" v AS ({rows}), best AS (SELECT id, language, votes FROM v"
        " QUALIFY row_number() OVER (PARTITION BY id ORDER BY votes DESC, pos) = 1)"
        " SELECT texts.id, lang, CASE WHEN votes > 0 THEN language ELSE 'und' END AS language"
        " FROM texts JOIN best ON texts.id = best.id"
    )


def greedy(k: int) -> str:
    ctes = [
        MSGS,
        f"tok AS MATERIALIZED (SELECT DISTINCT id, term, CASE WHEN toxic THEN 1 ELSE -1 END AS worth"
        f" FROM ({tokens_of('msgs', ', toxic')}))",
        "often AS MATERIALIZED (SELECT term FROM tok GROUP BY term HAVING count(*) >= 3)",
    ]
    left = "tok"
    for i in range(1, k + 1):
        ctes.append(
            f"g{i} AS MATERIALIZED (SELECT {i} AS step, term AS word, sum(worth)::BIGINT AS gain, count(*) AS newly_flagged"
            f" FROM {left} WHERE term IN (SELECT term FROM often) GROUP BY term HAVING sum(worth) > 0"
            " ORDER BY gain DESC, term LIMIT 1)"
        )
        ctes.append(
            f"r{i} AS MATERIALIZED (SELECT * FROM {left} WHERE id NOT IN"
            f" (SELECT id FROM {left} WHERE term IN (SELECT word FROM g{i})))"
        )
        left = f"r{i}"
    rows = " UNION ALL ".join(f"SELECT * FROM g{i}" for i in range(1, k + 1))
    return f"WITH {', '.join(ctes)} {rows}"


def error_terms(kind: str, wrong: str) -> str:
    return f"""(SELECT '{kind}' AS kind, term, error_texts, other_texts, round(ln(((error_texts + 0.5::DOUBLE) / (a + 1.0::DOUBLE))
  / ((other_texts + 0.5::DOUBLE) / (b + 1.0::DOUBLE))), 6) AS score
  FROM (SELECT term, count(*) FILTER (w) AS error_texts, count(*) FILTER (NOT w) AS other_texts
    FROM (SELECT DISTINCT id, term, {wrong} AS w FROM tok) GROUP BY term) t,
    (SELECT count(*) FILTER ({wrong}) AS a, count(*) FILTER (NOT ({wrong})) AS b FROM flagged) n
  WHERE error_texts > 0 AND error_texts + other_texts >= 3 ORDER BY score DESC, term LIMIT 20)"""


SPLIT = (
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY md5('42:' || CAST(id AS VARCHAR))) AS rn,"
    " count(*) OVER (PARTITION BY toxic) AS n FROM msgs),"
    " split AS (SELECT *, CASE WHEN rn <= round(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM ranked)"
)
REPLIES = """replies AS (SELECT *, CASE WHEN id % 17 = 0 THEN NULL WHEN id % 19 = 0 THEN '{"classification": "prof'
  WHEN id % 23 = 0 THEN '{"classification": "unsure"}' WHEN flagged THEN '{"classification": "profane"}'
  ELSE '{"classification": "clean"}' END AS reply, 0.3::DOUBLE + (id % 7) / 10.0::DOUBLE AS latency_s FROM flagged),
 parsed AS (SELECT *, CASE WHEN json_valid(reply) THEN json_extract_string(reply, '$.classification') END AS answer FROM replies),
 annotated AS (SELECT *, CASE WHEN reply IS NULL OR trim(reply) = '' THEN 'BLOCKED'
   WHEN answer IN ('profane', 'clean') THEN 'OK' ELSE 'INVALID' END AS status,
   CASE WHEN answer IN ('profane', 'clean') THEN answer = 'profane' END AS verdict FROM parsed)"""
BUCKETED = (
    "bucketed AS (SELECT id, ('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT % (1 + (SELECT count(*) FROM texts) // 100000) AS bucket FROM texts),"
    " numbered AS (SELECT id, bucket, row_number() OVER (PARTITION BY bucket ORDER BY id) - 1 AS no FROM bucketed)"
)
TFIDF = f"""tf AS (SELECT id, term, count(*) AS tf FROM ({tokens_of('msgs')}) GROUP BY id, term),
 dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
 total AS (SELECT count(*) AS n FROM msgs),
 idfs AS (SELECT term, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf FROM dfs, total WHERE df >= 3 AND df <= 0.2::DOUBLE * n),
 raw AS (SELECT id, term, tf, idf, tf * idf AS r FROM tf JOIN idfs USING (term)),
 tfidf AS (SELECT id, term, tf, idf, r / sqrt(sum(r * r) OVER (PARTITION BY id)) AS weight FROM raw)"""

EXPECTED = {
    "read_messages": f"WITH {MSGS} SELECT id AS index, md5(message) AS message_md5, label FROM msgs WHERE id % 29 <> 0",
    "read_usernames": f"WITH {NAMES} SELECT author FROM names WHERE author IS NOT NULL",
    "read_wordlist": "SELECT lower(ws[i]) AS word FROM (SELECT ws, unnest(range(1, len(ws) + 1)) AS i"
    " FROM (SELECT regexp_extract_all(text, '[A-Za-z]+') AS ws FROM documents)) WHERE (i - 1) % 7 <> 0",
    "review_names": f"WITH {CAPS} SELECT id, author FROM caps WHERE flagged"
    " ORDER BY md5('42:' || CAST(id AS VARCHAR)), id LIMIT 50",
    "evaluate_rules": f"WITH {FLAGGED}, e AS (SELECT CASE WHEN flagged THEN 'fp' ELSE 'fn' END AS kind, id FROM flagged"
    " WHERE flagged <> toxic) SELECT kind, id FROM (SELECT *, row_number() OVER (PARTITION BY kind"
    " ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) AS r FROM e) WHERE r <= 10",
    "union_datasets": f"WITH {MSGS} SELECT id, md5(message) AS message_md5, label, 'documents' AS dataset FROM msgs"
    " UNION ALL SELECT conv_id * 1000 + turn, md5(text), 0, 'conversations' FROM conversations",
    "binary_label": f"WITH {MSGS} SELECT id, label, label <> 0 AS toxic FROM msgs",
    "contains_word": f"WITH {MSGS}, f AS (SELECT toxic, {hit('message', ['trash'])} AS h FROM msgs)"
    " SELECT 'trash' AS word, count(*) AS total, count(*) FILTER (h) AS flagged, count(*) FILTER (h AND toxic) AS correct,"
    " count(*) FILTER (h AND NOT toxic) AS incorrect, 100.0::DOUBLE * count(*) FILTER (h) / count(*) AS flagged_pct FROM f",
    "rule_flag_boundary": f"WITH {TEXTS} SELECT id, {hit('message')} AS flagged FROM texts",
    "rule_flag_substring": f"WITH {TEXTS} SELECT id, {inside('message')} AS flagged FROM texts",
    "rule_flag_caps": f"WITH {CAPS} SELECT id, flagged FROM caps",
    "rule_flag_names_boundary": f"WITH {NAMES} SELECT id, {hit('author')} AS flagged FROM names",
    "rule_flag_names_substring": f"WITH {NAMES} SELECT id, {inside('author')} AS flagged FROM names",
    "rule_flag_token": f"WITH {TEXTS} SELECT id, {hit('message')} AS flagged FROM texts",
    "rule_flag_token_table": f"WITH {TEXTS}, {WORD_TABLE}, h AS (SELECT DISTINCT id FROM ({tokens_of('texts')})"
    " WHERE term IN (SELECT word FROM word_table)) SELECT id, id IN (SELECT id FROM h) AS flagged FROM texts",
    "rule_flag_boundary_table": f"WITH {TEXTS}, {WORD_TABLE}, h AS (SELECT DISTINCT id FROM (SELECT id,"
    f" unnest(regexp_extract_all(lower(message), '{L}+')) AS term FROM texts) WHERE term IN (SELECT word FROM word_table))"
    " SELECT id, id IN (SELECT id FROM h) AS flagged FROM texts",
    "rule_flag_substring_table": f"WITH {NAMES}, {WORD_TABLE} SELECT id, CASE WHEN author IS NOT NULL THEN"
    " EXISTS (SELECT 1 FROM word_table WHERE contains(lower(author), word)) END AS flagged FROM names",
    "token_hits": f"WITH {TEXTS}, {WORD_TABLE} SELECT DISTINCT id, term AS word FROM ({tokens_of('texts')})"
    " WHERE term IN (SELECT word FROM word_table)",
    "rule_flag_caps_table": f"WITH {NAMES}, {WORD_TABLE}, s AS (SELECT id, lower(unnest({SEGMENTS})) AS word FROM names),"
    " h AS (SELECT DISTINCT id FROM s WHERE word IN (SELECT word FROM word_table))"
    " SELECT id, CASE WHEN author IS NOT NULL THEN id IN (SELECT id FROM h) END AS flagged FROM names",
    "name_segments": f"WITH {NAMES} SELECT id, array_to_string({SEGMENTS}, ' ') AS segments FROM names",
    "normalise_text": normalised() + " SELECT id, normalised FROM norm",
    "rule_flag_normalised": normalised() + f" SELECT id, {hit('normalised')} AS flagged FROM norm",
    "censor": f"WITH {TEXTS} SELECT id, {censored('message', FIXED_STARS)} AS censored FROM texts",
    "censor_per_char": f"WITH {TEXTS} SELECT id, {censored('message', CHAR_STARS)} AS censored FROM texts",
    "explain_match": f"WITH {TEXTS}, parts AS (SELECT id, regexp_extract_all(message, '{L}+|{NOT_L}+') AS p FROM texts),"
    " cut AS (SELECT id, unnest(p) AS part, generate_subscripts(p, 1) AS pos FROM parts),"
    " placed AS (SELECT id, part, pos, sum(length(part)) OVER (PARTITION BY id ORDER BY pos)::BIGINT AS end_pos FROM cut)"
    " SELECT id, (row_number() OVER (PARTITION BY id ORDER BY pos))::INTEGER AS hit_no, lower(part) AS rule, part AS matched,"
    f" end_pos - length(part) + 1 AS start_pos, end_pos FROM placed WHERE lower(part) IN ({quoted(WORDS)})",
    "censor_table": f"WITH {TEXTS}, {EVERY_WORD}, {PLACED} SELECT t.id, coalesce(censored, t.message) AS censored FROM texts t LEFT JOIN"
    " (SELECT id, string_agg(CASE WHEN wordy OR covered THEN repeat('*', length(part)) ELSE part END, '' ORDER BY pos) AS censored"
    " FROM state GROUP BY id) USING (id)",
    "explain_match_table": f"WITH {TEXTS}, {EVERY_WORD}, {PLACED}, hit AS (SELECT id, pos,"
    " CASE WHEN opens THEN three ELSE part END AS matched, end_pos - length(part) + 1 AS start_pos"
    " FROM state WHERE wordy AND NOT covered)"
    " SELECT id, (row_number() OVER (PARTITION BY id ORDER BY pos))::INTEGER AS hit_no, lower(matched) AS rule, matched,"
    " start_pos, start_pos + length(matched) - 1 AS end_pos FROM hit",
    "apply_exceptions_two_tables": f"WITH {TEXTS}, allow AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS w"
    f" FROM benchmark), long AS (SELECT DISTINCT id FROM (SELECT id, unnest(regexp_extract_all(lower(message), '{L}+')) AS w FROM texts)"
    " WHERE length(w) >= 8 AND w NOT IN (SELECT w FROM allow))"
    " SELECT id, CASE WHEN message IS NOT NULL THEN id IN (SELECT id FROM long) END AS flagged FROM texts",
    "apply_exceptions": f"WITH {TEXTS} SELECT id, len(list_filter(regexp_extract_all(lower(message), '{L}+'),"
    f" lambda w: {inside('w', INNER_WORDS)} AND w NOT IN ({quoted(ALLOWED)}))) > 0 AS flagged FROM texts",
    "parse_verdict": f"WITH {FLAGGED}, {REPLIES} SELECT id, status, verdict FROM annotated",
    "tokens": f"WITH {TEXTS} SELECT id, term, count(*) AS tf FROM ({tokens_of('texts')}) GROUP BY id, term",
    "word_ngrams": f"WITH {TEXTS}, t AS (SELECT {DOC_TOKENS} AS w FROM texts),"
    " n AS (SELECT 1 AS n, unnest(w) AS term FROM t UNION ALL SELECT 2, unnest(list_transform(range(1, len(w)),"
    " lambda i: w[i] || ' ' || w[i + 1])) FROM t) SELECT n, term, count(*) AS total FROM n GROUP BY n, term",
    "char_ngrams": f"WITH {TEXTS}, t AS (SELECT regexp_extract_all(regexp_replace(lower(message), '{SPACE_RUN_PATTERN}', ' ',"
    " 'g'), '(?s).') AS c FROM texts), n AS ("
    + " UNION ALL ".join(
        f"SELECT {n} AS n, unnest(list_transform(range(1, len(c) - {n} + 2), lambda i: "
        + " || ".join(f"c[i + {j}]" for j in range(n))
        + ")) AS term FROM t"
        for n in range(1, 5)
    )
    + ") SELECT n, term, count(*) AS total FROM n GROUP BY n, term",
    "remove_stop_words": f"WITH {TEXTS} SELECT term, count(*) AS total FROM ({tokens_of('texts')})"
    f" WHERE term NOT IN ({quoted(STOP_WORDS)}) GROUP BY term",
    "identify_language": language(),
    "disagreements": f"WITH {MSGS}, b AS (SELECT id, toxic, {hit('message')} AS pred_a, {inside('message', FEW_WORDS)} AS pred_b"
    " FROM msgs) SELECT id, toxic, pred_a, pred_b FROM b WHERE pred_a <> pred_b OR pred_a <> toxic OR pred_b <> toxic"
    " ORDER BY md5('42:' || CAST(id AS VARCHAR)), id LIMIT 50",
    "side_by_side": f"""WITH {TEXTS} SELECT id, {hit('message')} AS "full", {hit('message', FEW_WORDS)} AS short,"""
    f" {inside('message')} AS substring FROM texts",
    "cached_annotate": f"WITH {TEXTS}, {MSGS}, {CACHE} SELECT id, k IS NOT NULL AS cache_hit, verdict"
    " FROM texts LEFT JOIN cache ON sha256(message) = k",
    "cached_annotate_misses": f"WITH {TEXTS}, {MSGS}, {CACHE} SELECT md5(message) AS message_md5, count(*) AS copies FROM texts"
    " WHERE sha256(message) NOT IN (SELECT k FROM cache) GROUP BY message",
    "semantic_cache": "WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e, label % 2 = 0 AS verdict FROM embeddings),"
    " p AS (SELECT a.id, b.id AS match_id, list_cosine_similarity(a.e, b.e) AS cosine, b.verdict FROM v a, v b"
    " WHERE a.id % 2 = 0 AND b.id % 2 = 1),"
    " best AS (SELECT * FROM p WHERE cosine >= 0.6 QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(cosine, 9) DESC, match_id) = 1)"
    " SELECT v.id, match_id, round(cosine, 6) AS cosine, best.verdict FROM v LEFT JOIN best ON v.id = best.id WHERE v.id % 2 = 0",
    "fuzzy_hits": f"WITH {TEXTS}, tok AS (SELECT DISTINCT id, term FROM ({tokens_of('texts')}) WHERE length(term) >= 4),"
    f" voc AS (SELECT DISTINCT term FROM tok), w AS (SELECT unnest([{quoted(WORDS)}]) AS word),"
    f" near AS (SELECT term, word, {distance('term', 'word')} AS distance FROM voc, w WHERE {distance('term', 'word')} <= 1"
    f" QUALIFY row_number() OVER (PARTITION BY term ORDER BY {distance('term', 'word')}, word) = 1)"
    " SELECT id, term, word, distance::INTEGER AS distance FROM tok JOIN near USING (term)",
    "fuzzy_flag": f"WITH {TEXTS}, tok AS (SELECT DISTINCT id, term FROM ({tokens_of('texts')}) WHERE length(term) >= 4),"
    f" voc AS (SELECT DISTINCT term FROM tok), w AS (SELECT unnest([{quoted(WORDS)}]) AS word),"
    f" near AS (SELECT DISTINCT term FROM voc, w WHERE {distance('term', 'word')} <= 2)"
    " SELECT id, id IN (SELECT id FROM tok WHERE term IN (SELECT term FROM near)) AS flagged FROM texts",
    "label_stats": f"WITH {MSGS}, c AS (SELECT label, count(*) AS n FROM msgs GROUP BY label), t AS (SELECT count(*) AS total,"
    " count(*) FILTER (toxic) AS bad FROM msgs), names AS (SELECT unnest([0, 1, 2, 3, 4, 5]) AS label, unnest(['NON_TOXIC',"
    " 'INSULTS_AND_FLAMING', 'OTHER_OFFENSIVE', 'HATE_AND_HARASSMENT', 'THREATS', 'EXTREMISM']) AS name),"
    " r AS (SELECT 'all' AS kind, 'TOTAL' AS name, total AS n FROM t"
    " UNION ALL SELECT 'label', name, coalesce(n, 0) FROM names LEFT JOIN c USING (label)"
    " UNION ALL SELECT 'binary', 'TOXIC', bad FROM t UNION ALL SELECT 'binary', 'CLEAN', total - bad FROM t)"
    " SELECT kind, name, n, round(100.0::DOUBLE * n / total, 6) AS pct FROM r, t",
    "confusion": f"WITH {FLAGGED} SELECT {counts()} FROM flagged",
    "classification_report": f"""WITH {FLAGGED}, c AS (SELECT {counts()} FROM flagged),
 k AS (SELECT 'Clean' AS class, tn AS hit, fn AS wrong, fp AS missed FROM c UNION ALL SELECT 'Profane', tp, fp, fn FROM c),
 m AS (SELECT class, coalesce(hit::DOUBLE / nullif(hit + wrong, 0), 0) AS p, coalesce(hit::DOUBLE / nullif(hit + missed, 0), 0) AS r,
   coalesce(2.0::DOUBLE * hit / nullif(2 * hit + wrong + missed, 0), 0) AS f, hit + missed AS s FROM k),
 a AS (SELECT (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS acc, tp + fp + fn + tn AS n FROM c)
 SELECT class, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1, s AS support FROM m
 UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), n FROM a
 UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(s)::BIGINT FROM m
 UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6), round(sum(f * s) / sum(s), 6), sum(s)::BIGINT FROM m""",
    "error_rows": f"WITH {MSGS}, f AS (SELECT *, {inside('message', INNER_WORDS)} AS flagged FROM msgs)"
    " SELECT CASE WHEN flagged THEN 'fp' ELSE 'fn' END AS kind, id, label FROM f WHERE flagged <> toxic",
    "flag_summary": f"WITH {CAPS} SELECT count(flagged) AS total, count(*) FILTER (flagged) AS flagged,"
    " count(flagged) - count(*) FILTER (flagged) AS clean, round(100.0::DOUBLE * count(*) FILTER (flagged) / count(flagged), 6) AS flagged_pct,"
    " round(100.0::DOUBLE * (count(flagged) - count(*) FILTER (flagged)) / count(flagged), 6) AS clean_pct FROM caps",
    "precision_projection": f"WITH {CAPS}, hits AS (SELECT id FROM caps WHERE flagged),"
    " sample AS (SELECT id, id % 10 <> 3 AS offensive FROM hits ORDER BY md5('42:' || CAST(id AS VARCHAR)), id LIMIT 50),"
    " c AS (SELECT count(*) AS flagged, count(offensive) AS reviewed, count(*) FILTER (offensive) AS offensive"
    " FROM hits LEFT JOIN sample USING (id))"
    ' SELECT flagged, reviewed, offensive, round(offensive::DOUBLE / reviewed, 6) AS "precision",'
    " floor(flagged * 0.9::DOUBLE)::BIGINT AS estimate_high, floor(flagged * 0.5::DOUBLE)::BIGINT AS estimate_medium,"
    " floor(flagged * (offensive::DOUBLE / reviewed))::BIGINT AS estimate_reviewed FROM c",
    "metrics_by": metrics_by("lang"),
    "metrics_by_source": metrics_by("source"),
    "rate_triage": f"WITH {TEXTS}, f AS (SELECT lang, {hit('message')} AS flagged FROM texts),"
    " c AS (SELECT lang, count(*) AS total, count(*) FILTER (flagged) AS flagged FROM f GROUP BY lang),"
    " b AS (SELECT *, flagged::DOUBLE / total AS r, CASE lang WHEN 'en' THEN 0.05 WHEN 'de' THEN 0.3 ELSE 0.001 END AS lo,"
    " CASE lang WHEN 'en' THEN 0.2 WHEN 'de' THEN 0.5 ELSE 0.01 END AS hi FROM c)"
    " SELECT lang, total, flagged, round(r, 6) AS rate, CASE WHEN r > hi THEN 'suspect_false_positives'"
    " WHEN r < lo THEN 'suspect_false_negatives' ELSE 'in_band' END AS verdict FROM b",
    "filter_comparison": f"WITH {MSGS}, p AS (SELECT 'full' AS filter, toxic, {hit('message')} AS flagged FROM msgs"
    f" UNION ALL SELECT 'short', toxic, {inside('message', FEW_WORDS)} FROM msgs"
    " UNION ALL SELECT 'all_clean', toxic, false FROM msgs),"
    f" c AS (SELECT filter, {counts()} FROM p GROUP BY filter) SELECT filter, {MEASURES} FROM c",
    "rule_scorecard": f"WITH {MSGS}, w AS (SELECT unnest([{quoted(WORDS)}]) AS word), h AS (SELECT DISTINCT id, toxic, word FROM"
    f" (SELECT id, toxic, unnest(regexp_extract_all(lower(message), '{L}+')) AS word FROM msgs)),"
    " c AS (SELECT word, count(id) AS flagged, count(*) FILTER (toxic) AS correct FROM w LEFT JOIN h USING (word) GROUP BY word)"
    ' SELECT word, flagged, correct, flagged - correct AS incorrect, round(correct::DOUBLE / nullif(flagged, 0), 6) AS "precision" FROM c',
    "rule_scorecard_table": f"WITH {MSGS}, {EVERY_WORD}, p AS (SELECT id, toxic, regexp_extract_all(lower(message), '{L}+|{NOT_L}+')"
    f" AS p FROM msgs), held AS (SELECT id, toxic, unnest(p) AS word FROM p UNION SELECT id, toxic, unnest(list_transform("
    f"range(1, len(p) - 1), lambda i: p[i] || p[i + 1] || p[i + 2])) FROM p), listed AS (FROM single UNION FROM phrase),"
    " c AS (SELECT word, count(id) AS flagged, count(*) FILTER (toxic) AS correct FROM listed LEFT JOIN held USING (word) GROUP BY word)"
    ' SELECT word, flagged, correct, flagged - correct AS incorrect, round(correct::DOUBLE / nullif(flagged, 0), 6) AS "precision" FROM c',
    "greedy_rules": greedy(5),
    "error_terms": f"WITH {FLAGGED}, tok AS (SELECT id, toxic, flagged, term FROM ({tokens_of('flagged', ', toxic, flagged')})) "
    + error_terms("fn", "NOT flagged AND toxic")
    + " UNION ALL "
    + error_terms("fp", "flagged AND NOT toxic"),
    "document_frequency": f"WITH {TEXTS} SELECT term, count(DISTINCT id) AS df FROM ({tokens_of('texts')}) GROUP BY term"
    " HAVING count(DISTINCT id) >= 3 AND count(DISTINCT id) <= 0.2::DOUBLE * (SELECT count(*) FROM texts)",
    "annotation_report": f"WITH {FLAGGED}, {REPLIES} SELECT count(*) AS total, count(*) FILTER (status = 'OK') AS answered,"
    " count(*) FILTER (status = 'BLOCKED') AS blocked, count(*) FILTER (status = 'INVALID') AS invalid,"
    " count(*) FILTER (status = 'OK' AND verdict = toxic) AS correct,"
    " round(avg(latency_s) FILTER (status = 'OK'), 6) AS latency_avg, min(latency_s) FILTER (status = 'OK') AS latency_min,"
    " max(latency_s) FILTER (status = 'OK') AS latency_max FROM annotated",
    "capacity_estimate": f"""WITH {TEXTS}, t AS (SELECT message, count(*) AS c, any_value(ceil(length(message) / 4.0)::BIGINT) AS k FROM texts GROUP BY message),
 s AS (SELECT sum(c)::BIGINT AS n, sum(c * k)::BIGINT AS nt, count(*) AS u, sum(k)::BIGINT AS ut FROM t),
 r AS (SELECT 'all' AS scope, n AS messages, nt AS tokens, n FROM s UNION ALL SELECT 'distinct', u, ut, n FROM s),
 x AS (SELECT *, messages * (1e6::DOUBLE / n) AS day, tokens * (1e6::DOUBLE / n) AS dt FROM r)
 SELECT scope, messages, tokens, round(dt, 2) AS day_tokens, round(dt * 0.1::DOUBLE / 1e6, 6) AS day_cost,
 round(day * 0.54::DOUBLE / 3600, 4) AS serial_hours, round(day / 30 / 60, 4) AS quota_hours FROM x""",
    "with_context": "SELECT conv_id, turn, coalesce(array_to_string(list(text) OVER (PARTITION BY conv_id ORDER BY turn"
    " ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), ' | '), '') AS context FROM conversations",
    "pack_batches": f"WITH {TEXTS}, {BUCKETED} SELECT id, bucket, (no // 100)::INTEGER AS batch, (no % 100 + 1)::INTEGER AS place"
    " FROM numbered",
    "request_batches": f"WITH {TEXTS}, {BUCKETED} SELECT bucket, (no // 100)::INTEGER AS batch, count(*)::INTEGER AS n,"
    " string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM numbered GROUP BY bucket, no // 100",
    "stratified_split": f"WITH {MSGS}, {SPLIT} SELECT id, toxic, split FROM split",
    "stratified_folds": f"WITH {MSGS}, {SPLIT} SELECT id, toxic, ((rn - 1) % 5)::INTEGER AS fold FROM ranked",
    "seeded_sample": f"WITH {FLAGGED} SELECT id, label FROM flagged WHERE NOT flagged AND toxic"
    " ORDER BY md5('42:' || CAST(id AS VARCHAR)), id LIMIT 10",
    "head_rows": f"WITH {CAPS} SELECT id, author FROM caps WHERE flagged ORDER BY id LIMIT 50",
    "tfidf": f"WITH {MSGS}, {TFIDF} SELECT id, term, tf, round(idf, 6) AS idf, round(weight, 6) AS weight FROM tfidf",
    "tfidf_model": f"WITH {MSGS}, {TFIDF} SELECT term, round(sum(weight), 6) AS total FROM tfidf GROUP BY term",
    "fit_naive_bayes": f"WITH {MSGS}, {TFIDF}, c AS (SELECT term, sum(tf) FILTER (toxic) AS a, sum(tf) FILTER (NOT toxic) AS b"
    " FROM raw JOIN msgs USING (id) GROUP BY term), t AS (SELECT sum(a) AS ta, sum(b) AS tb, count(*) AS v FROM c)"
    " SELECT term, round(ln((coalesce(a, 0) + 1)::DOUBLE / (ta + v)) - ln((coalesce(b, 0) + 1)::DOUBLE / (tb + v)), 6) AS log_odds FROM c, t",
    "score_naive_bayes": f"WITH {TEXTS}, {MSGS}, {TFIDF}, c AS (SELECT term, sum(tf) FILTER (toxic) AS a,"
    " sum(tf) FILTER (NOT toxic) AS b FROM raw JOIN msgs USING (id) GROUP BY term),"
    " t AS (SELECT sum(a) AS ta, sum(b) AS tb, count(*) AS v FROM c),"
    " w AS (SELECT term, ln((coalesce(a, 0) + 1)::DOUBLE / (ta + v)) - ln((coalesce(b, 0) + 1)::DOUBLE / (tb + v)) AS odds FROM c, t),"
    " p AS (SELECT ln(count(*) FILTER (toxic) + 1) - ln(count(*) FILTER (NOT toxic) + 1) AS prior FROM msgs),"
    f" s AS (SELECT id, sum(odds) AS total FROM ({tokens_of('texts')}) JOIN w USING (term) GROUP BY id)"
    " SELECT texts.id, round(1 / (1 + exp(least(700, -(prior + coalesce(total, 0))))), 6) AS probability"
    " FROM p, texts LEFT JOIN s ON texts.id = s.id",
    "annotate": f"""WITH {TEXTS}, {MSGS}, {CACHE}, a AS (SELECT id, k IS NOT NULL AS cache_hit, cache.verdict AS cached,
 length(message) AS n, {hit('message')} AS h FROM texts LEFT JOIN cache ON sha256(message) = k)
 SELECT id, CASE WHEN cache_hit THEN 'OK' WHEN n % 17 = 0 THEN 'BLOCKED' WHEN n % 19 = 0 THEN 'INVALID' ELSE 'OK' END AS status,
 CASE WHEN cache_hit THEN cached WHEN n % 17 = 0 OR n % 19 = 0 THEN NULL ELSE h END AS verdict, cache_hit FROM a""",
    "stream_moderate": f"SELECT doc_id, {hit('text')} AS flagged, {censored('text', FIXED_STARS)} AS censored FROM documents",
    "stream_flag_rate": "WITH n AS (SELECT count(*) AS n FROM documents),"
    f" chat AS (SELECT e.ts, d.lang, {hit('d.text')} AS h FROM events e, n JOIN documents d ON d.doc_id = e.event_id % n.n),"
    " c AS (SELECT date_trunc('hour', ts) AS w, lang, count(*) AS total, count(*) FILTER (h) AS flagged FROM chat GROUP BY 1, 2)"
    " SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, lang, total, flagged, round(flagged::DOUBLE / total, 6) AS rate,"
    " CASE WHEN flagged::DOUBLE / total > 0.01 THEN 'suspect_false_positives'"
    " WHEN flagged::DOUBLE / total < 0.001 THEN 'suspect_false_negatives' ELSE 'in_band' END AS verdict"
    " FROM c WHERE w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE",
    "stream_dedupe": "WITH n AS (SELECT count(*) AS n FROM documents) SELECT DISTINCT sha256(d.text) AS text_key"
    " FROM events e, n JOIN documents d ON d.doc_id = e.event_id % n.n",
}
EXPECTED["review_names_summary"] = EXPECTED["flag_summary"]
EXPECTED["evaluate_rules_report"] = EXPECTED["classification_report"]
EXPECTED["train_evaluate"] = (
    f"WITH {MSGS}, {SPLIT}, t AS (SELECT count(*) AS n, count(*) FILTER (toxic) AS bad FROM split WHERE split = 'test')"
    " SELECT unnest(['Clean', 'Profane', 'accuracy', 'macro avg', 'weighted avg']) AS class,"
    " unnest([n - bad, bad, n, n, n]) AS support, true AS same FROM t"
)
EXPECTED["coarse_labels"] = (
    f"WITH {MSGS} SELECT CASE label WHEN 0 THEN 'clean' WHEN 1 THEN 'insult' WHEN 3 THEN 'hate' WHEN 4 THEN 'hate'"
    " ELSE 'profanity' END AS coarse, count(*) AS n, count(*) FILTER (toxic) AS toxic FROM msgs GROUP BY 1"
)
EXPECTED["stream_score"] = EXPECTED["score_naive_bayes"]
EXPECTED["save_load_model"] = f"SELECT *, 0.2::DOUBLE AS frac, 42 AS seed FROM ({EXPECTED['score_naive_bayes']})"
ODDS = (
    f"{MSGS}, {TFIDF}, c AS (SELECT term, sum(tf) FILTER (toxic) AS a, sum(tf) FILTER (NOT toxic) AS b"
    " FROM raw JOIN msgs USING (id) GROUP BY term), t AS (SELECT sum(a) AS ta, sum(b) AS tb, count(*) AS v FROM c),"
    " odds AS (SELECT term, ln((coalesce(a, 0) + 1)::DOUBLE / (ta + v)) - ln((coalesce(b, 0) + 1)::DOUBLE / (tb + v)) AS weight FROM c, t)"
)
EXPECTED["top_terms_counts"] = (
    f"WITH {ODDS} SELECT side, term, round(weight, 6) AS weight FROM ("
    "(SELECT 'toxic' AS side, * FROM odds ORDER BY round(weight, 9) DESC, term LIMIT 20) UNION ALL"
    " (SELECT 'clean' AS side, * FROM odds ORDER BY round(weight, 9), term LIMIT 20))"
)
EXPECTED["explain_counts"] = (
    f"WITH {TEXTS}, {ODDS}, n AS (SELECT id, term, count(*) AS tf FROM ({tokens_of('texts')}) GROUP BY id, term),"
    " s AS (SELECT id, term, tf, tf * weight AS x, row_number() OVER (PARTITION BY id ORDER BY round(abs(tf * weight), 9) DESC, term)::INTEGER"
    " AS place FROM n JOIN odds USING (term)) SELECT id, place, term, tf, round(x, 6) AS contribution FROM s WHERE place <= 5"
)


def optimum(rows: str, extra: str = "", times: str = "") -> str:
    """The terms of a model with their document counts, and a slope of zero for each weight."""
    return (
        f"{rows}, f AS (SELECT term, count(DISTINCT id) AS df FROM ({tokens_of('train')}) GROUP BY term), n AS (SELECT count(*) AS n"
        f" FROM train) SELECT term, df{extra}, 0.0::DOUBLE AS slope FROM f, n{times} WHERE df >= 3 AND df <= 0.2::DOUBLE * n"
    )


TRAIN = f"WITH {MSGS}, {SPLIT}, train AS (SELECT * FROM split WHERE split = 'train')"
EXPECTED["grid_search_counts"] = (
    TRAIN
    + f""", test AS (SELECT * FROM split WHERE split = 'test'),
 tok AS (SELECT id, term, count(*) AS tf FROM ({tokens_of('train')}) GROUP BY id, term),
 said AS (SELECT id, term, count(*) AS tf FROM ({tokens_of('test')}) GROUP BY id, term),
 c AS (SELECT term, count(*) AS df, coalesce(sum(tf) FILTER (toxic), 0) AS a, coalesce(sum(tf) FILTER (NOT toxic), 0) AS b
  FROM tok JOIN train USING (id) GROUP BY term),
 g AS (SELECT unnest([0.1::DOUBLE, 1, 10]) AS alpha), m AS (SELECT unnest([1, 2, 4]) AS min_df),
 k AS (SELECT alpha, min_df, term, a, b FROM c, g, m WHERE df >= min_df),
 t AS (SELECT alpha, min_df, sum(a) AS ta, sum(b) AS tb, count(*) AS v FROM k GROUP BY ALL),
 w AS (SELECT alpha, min_df, term, ln((a + alpha) / (ta + alpha * v)) - ln((b + alpha) / (tb + alpha * v)) AS odds
  FROM k JOIN t USING (alpha, min_df)),
 p AS (SELECT alpha, ln(count(*) FILTER (toxic) + alpha) - ln(count(*) FILTER (NOT toxic) + alpha) AS prior FROM train, g GROUP BY alpha),
 s AS (SELECT alpha, min_df, id, sum(tf * odds) AS total FROM said JOIN w USING (term) GROUP BY ALL),
 j AS (SELECT p.alpha, m.min_df, test.toxic, prior + coalesce(total, 0) > 0 AS flagged FROM test CROSS JOIN p CROSS JOIN m
  LEFT JOIN s ON s.alpha = p.alpha AND s.min_df = m.min_df AND s.id = test.id),
 n AS (SELECT alpha, min_df, {counts()} FROM j GROUP BY alpha, min_df),
 r AS (SELECT alpha, min_df, {MEASURES}, row_number() OVER (ORDER BY round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6)
  DESC, min_df, alpha) = 1 AS best FROM n)
SELECT alpha, min_df, accuracy, "precision", recall, f1, best, CASE WHEN best THEN concat_ws(',',
 CASE WHEN alpha <> 1 THEN 'alpha' END, CASE WHEN min_df <> 2 THEN 'min_df' END) ELSE '' END AS on_edge FROM r"""
)
EXPECTED["fit_logistic_optimum"] = EXPECTED["fit_logistic_cv_optimum"] = optimum(TRAIN)
EXPECTED["fit_multiclass_optimum"] = optimum(
    TRAIN, ", class::INTEGER AS class", ", (SELECT unnest(range(count(DISTINCT label))) AS class FROM train)"
)
EXPECTED["distil_optimum"] = optimum(
    f"WITH {TEXTS}, train AS (SELECT * FROM texts ANTI JOIN labels ON doc_id = id WHERE id % 17 <> 0 AND id % 19 <> 0 AND id % 23 <> 0)"
)
EXPECTED["apply_exceptions_table"] = EXPECTED["apply_exceptions"]
EXPECTED["remove_stop_words_table"] = EXPECTED["remove_stop_words"]
