"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

from lexharbor.functions.stem_en import Dialect, stems_sql
from lexharbor.operators.analysis import STOP_EN
from lexharbor.operators.language import MARGIN, UNSEEN_SHARE
from lexharbor.sources.files import BY_EXTENSION
from lexharbor.verify.inputs import PHRASE_BASE, PREFIX_BASE, QUERY_BASE

W = r"[\p{L}\p{N}]+"
RUN = r"[\p{L}\p{M}\p{N}_]+"
POSS = r"([\p{L}\p{N}])(?:[''’＇][sS])+([^\p{L}\p{N}]|$)"
STOP = "(" + ", ".join(f"'{w}'" for w in STOP_EN) + ")"
APOS = "('''', '’', '＇')"

# -- shared parts ----------------------------------------------------------------

DOCS = """docs AS (
  SELECT doc_id, source, lang,
         '/corpus/' || source || '/' || source || '.' || lang || '.' || doc_id || '.txt' AS path,
         source || ' ' || lang || ' ' || doc_id || ' txt' AS title, text AS body
  FROM documents)"""

# terms of both fields: possessives and stop words go from English bodies only
TOKS = f"""toks AS (
  SELECT path, lang, field, lower(w) AS term, pos FROM (
    SELECT path, lang, field, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM (
      SELECT path, lang, 'body' AS field, regexp_extract_all(
        CASE WHEN lang = 'en' THEN regexp_replace(body, '{POSS}', '\\1\\2', 'g') ELSE body END,
        '{W}') AS ws FROM docs
      UNION ALL
      SELECT path, lang, 'title', regexp_extract_all(title, '{W}') FROM docs))
  WHERE NOT (field = 'body' AND lang = 'en' AND lower(w) IN {STOP}))"""

STATS = """posts AS (
  SELECT lang, field, term, path, count(*) AS tf, list(pos ORDER BY pos) AS positions
  FROM toks GROUP BY ALL),
lens AS (SELECT lang, field, path, count(*) AS len FROM toks GROUP BY ALL),
klens AS (
  SELECT *, CASE WHEN len > 39 THEN 24 + (((len - 24) >> greatest(0, length(bin(len - 24)) - 4))
                 << greatest(0, length(bin(len - 24)) - 4)) ELSE len END AS kept_len FROM lens),
tstats AS (SELECT lang, field, term, count(*) AS df, sum(tf)::BIGINT AS ttf
           FROM posts GROUP BY ALL),
fstats AS (SELECT lang, field, count(*) AS n_docs, sum(len)::BIGINT AS sum_len,
           sum(len)::DOUBLE / count(*) AS avg_len FROM lens GROUP BY ALL)"""

IDF = "ln(1.0::DOUBLE + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))"


def exact_sum(value: str) -> str:
    """Sum in steps of 2**-40, so that no order of adding changes a rank."""
    return f"(sum(floor(({value}) * 1099511627776.0::DOUBLE)::BIGINT) / 1099511627776.0::DOUBLE)"


def bm25(weight: str, tf: str) -> str:
    norm = "(1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * kept_len / avg_len))"
    return f"({weight}) * {tf} / ({tf} + {norm})"


SCORED = f"""scored AS (
  SELECT p.lang, p.field, p.term, p.path, {bm25(IDF, 'p.tf')} AS score
  FROM posts p JOIN klens USING (lang, field, path) JOIN tstats USING (lang, field, term)
  JOIN fstats USING (lang, field))"""

WORDS = f"""words AS (
  SELECT lower(w) AS word, min(item_id * {QUERY_BASE} + pos) AS query_id FROM (
    SELECT item_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM (
      SELECT item_id, regexp_extract_all(text, '{W}') AS ws FROM benchmark))
  GROUP BY 1)"""

# a stop word leaves no body term and falls back to itself, which no English body holds
WORD_TERMS = """qterms AS (
  SELECT query_id, 'en' AS lang, unnest(['body', 'title']) AS field, word AS term FROM words)"""

WORD_HITS = f"""clauses AS (
  SELECT query_id, field, path, score FROM qterms JOIN scored USING (lang, field, term)),
hits AS (SELECT query_id, path, {exact_sum('score')} AS score FROM clauses GROUP BY ALL)"""

RANKED = """ranked AS (
  SELECT query_id, path, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, path) AS rank
  FROM hits)"""

BASE = f"WITH {DOCS}, {TOKS}, {STATS}, {SCORED}"

# English bodies under their stems, each distinct term looked up once
CUT_TOKS = TOKS.replace("toks AS", "cut AS", 1)
DUCK = Dialect(", 'g'", r"\1")


def stemmed(*sources: str) -> str:
    """CTE ``stemmed(term, stem)`` of the distinct terms of some selects."""
    return f"""vocabulary AS (SELECT DISTINCT term FROM ({' UNION ALL '.join(sources)})),
stemmed AS ({stems_sql('vocabulary', to=DUCK)})"""


EN_BODY = "SELECT term FROM cut WHERE field = 'body' AND lang = 'en'"
STEM_TOKS = """toks AS (
  SELECT path, lang, field, CASE WHEN field = 'body' AND lang = 'en' THEN stem ELSE term END AS term,
         pos FROM cut JOIN stemmed USING (term))"""
# bodies of other languages: short terms dropped, a final s cut
TABLE_TOKS = """toks AS (
  SELECT path, lang, field, CASE WHEN field = 'body' AND lang <> 'en' AND term LIKE '%s'
         THEN left(term, -1) ELSE term END AS term, pos
  FROM cut WHERE NOT (field = 'body' AND lang <> 'en' AND length(term) <= 3))"""
WORD_SEARCH = f"{BASE}, {WORDS}, {WORD_TERMS}, {WORD_HITS}, {RANKED}"

TYPOS = """typos AS (
  SELECT -query_id - 1 AS query_id,
         word[1] || word[3] || word[2] || substring(word, 4) AS text
  FROM words),
asked AS (
  SELECT query_id, unnest(['body', 'title']) AS field, text AS word FROM typos)"""

# edit distances in SQL count bytes, so each accented letter of the data first becomes
# one capital (terms are in lower case)
ACCENTS, CAPITALS = "ßäçèéêíñóöü", "ABCDEFGHIJK"


def plain(name: str) -> str:
    return f"translate({name}, '{ACCENTS}', '{CAPITALS}')"


# at most one edit, or one swap of neighbours plus at most one edit before or after it
WITHIN_TWO = f"""near AS (
  SELECT field, word, term, df, CASE
    WHEN lev <= 1 THEN lev
    WHEN dam = 1 THEN 1
    WHEN lev = 2 THEN 2
    WHEN dam <= 2 AND len(list_filter(range(1, length(a)), lambda i: len(list_filter([i - 1, i, i + 1],
           lambda j: j >= 1 AND j < length(b) AND a[i] = b[j + 1] AND a[i + 1] = b[j]
                AND damerau_levenshtein(substring(a, 1, i - 1), substring(b, 1, j - 1))
                  + damerau_levenshtein(substring(a, i + 2), substring(b, j + 2)) <= 1)) > 0)) > 0
    THEN 2 ELSE 9 END AS edits
  FROM (SELECT *, levenshtein(a, b) AS lev, damerau_levenshtein(a, b) AS dam
        FROM (SELECT field, word, term, df, {plain('word')} AS a, {plain('term')} AS b
              FROM (SELECT DISTINCT field, word FROM asked)
              JOIN (SELECT * FROM tstats WHERE lang = 'en') USING (field)
              WHERE abs(length(word) - length(term)) <= 2)) WHERE lev <= 4),
best AS (
  SELECT field, word, term, df, edits, 1.0::DOUBLE - edits / least(length(word), length(term)) AS boost
  FROM near WHERE edits <= 2 AND edits < least(length(word), length(term))),
expanded AS (
  SELECT *, max(df) OVER (PARTITION BY field, word) AS top_df FROM (
    SELECT *, row_number() OVER (PARTITION BY field, word ORDER BY boost DESC, term) AS rank
    FROM best) WHERE rank <= 50)"""

FUZZY_HITS = f"""fuzzy AS (
  SELECT query_id, path, {exact_sum(bm25('boost * ' + IDF.replace('df', 'top_df'), 'tf'))} AS score
  FROM asked JOIN expanded USING (field, word)
  JOIN posts p ON p.lang = 'en' AND p.field = expanded.field AND p.term = expanded.term
  JOIN klens k ON k.lang = 'en' AND k.field = p.field AND k.path = p.path
  JOIN fstats f ON f.lang = 'en' AND f.field = p.field
  GROUP BY ALL)""".replace("query_id, path, (sum", "query_id, p.path AS path, (sum")


def phrases(place: str) -> str:
    """Hits of five-word runs; ``place`` tells where each kept term must be."""
    return f"""runs AS (
  SELECT item_id * {QUERY_BASE} + s + {PHRASE_BASE} AS query_id, ws[s + 1 : s + 5] AS ws FROM (
    SELECT item_id, ws, unnest(range(0, len(ws), 5)) AS s FROM (
      SELECT item_id, regexp_extract_all(text, '{W}') AS ws FROM benchmark))),
pwords AS (
  SELECT query_id, field, lower(w) AS term, idx FROM (
    SELECT query_id, unnest(ws) AS w, unnest(range(len(ws))) AS idx FROM runs),
    (SELECT unnest(['body', 'title']) AS field)
  WHERE NOT (field = 'body' AND lower(w) IN {STOP})),
pterms AS (
  SELECT query_id, field, term, {place} AS place,
         count(*) OVER (PARTITION BY query_id, field) AS n FROM pwords),
starts AS (
  SELECT query_id, field, path, pos - place AS start, n
  FROM pterms q JOIN toks t ON t.lang = 'en' AND t.field = q.field AND t.term = q.term
  GROUP BY ALL HAVING count(*) = n)
""".replace("SELECT query_id, field, path, pos - place", "SELECT query_id, q.field AS field, path, pos - place") + f""",
freqs AS (SELECT query_id, field, path, count(*) AS freq FROM starts GROUP BY ALL),
weights AS (
  SELECT query_id, q.field, {exact_sum(IDF)} AS weight, any_value(avg_len) AS avg_len
  FROM pterms q JOIN tstats t ON t.lang = 'en' AND t.field = q.field AND t.term = q.term
  JOIN fstats f ON f.lang = 'en' AND f.field = q.field GROUP BY ALL),
phits AS (
  SELECT query_id, path, {exact_sum(bm25('weight', 'freq'))} AS score
  FROM freqs JOIN weights USING (query_id, field)
  JOIN (SELECT field, path, kept_len FROM klens WHERE lang = 'en') USING (field, path)
  GROUP BY ALL)"""


CONSECUTIVE = "row_number() OVER (PARTITION BY query_id, field ORDER BY idx) - 1"
TRUE_PLACE = "idx - min(idx) OVER (PARTITION BY query_id, field)"

# the words of each body with the characters before them and their own
PIECES = f"""pieces AS (
  SELECT path, lang, total, k, gap, w,
         coalesce(lang = 'en' AND k > 0 AND lower(w) = 's' AND gap IN {APOS}, false) AS tail
  FROM (SELECT path, lang, length(body) AS total,
               unnest(range(len(gaps))) AS k, unnest(gaps) AS gap,
               unnest(list_concat(ws, [NULL])) AS w
        FROM (SELECT path, lang, body, string_split_regex(body, '{W}') AS gaps,
                     regexp_extract_all(body, '{W}') AS ws FROM docs))),
kept AS (
  SELECT * FROM (
    SELECT path, lang, k, total, lower(w) AS term, tail, w,
           sum(length(gap) + coalesce(length(w), 0)) OVER o AS stop,
           coalesce(length(w), 0) AS width, k - sum(tail::INT) OVER o AS pos
    FROM pieces WINDOW o AS (PARTITION BY path ORDER BY k))
  WHERE w IS NOT NULL AND NOT tail AND NOT (lang = 'en' AND term IN {STOP}))"""

BODY_PLACES = "bplaces AS (SELECT *, false AS inside, '' AS qid FROM kept)"


def fragment_rows(source: str) -> str:
    """Fragment number of each kept word, and the span of each fragment."""
    return f"""counted AS (
  SELECT *, sum(may::INT) OVER (PARTITION BY qid, path ORDER BY k) AS a FROM (
    SELECT *, NOT inside AND total - stop >= 35
              AND row_number() OVER (PARTITION BY qid, path ORDER BY k) > 1 AS may
    FROM {source})),
ftoks AS (
  SELECT qid, path, pos, term, stop - width AS start, stop, total,
         (a + least(0, coalesce(min(CASE WHEN may THEN floor(stop / 70)::BIGINT - a END)
             OVER (PARTITION BY qid, path ORDER BY k), 0)))::BIGINT AS frag_no FROM counted),
spans AS (
  SELECT qid, path, frag_no,
         coalesce(lag(last) OVER o, 0)::BIGINT AS start,
         (CASE WHEN lead(last) OVER o IS NULL THEN total ELSE last END)::BIGINT AS stop
  FROM (SELECT qid, path, frag_no, max(stop) AS last, max(total) AS total
        FROM ftoks GROUP BY ALL)
  WINDOW o AS (PARTITION BY qid, path ORDER BY frag_no))"""


FRAGS = f"{PIECES}, {BODY_PLACES}, {fragment_rows('bplaces')}"

WORD_MARKS = """shown AS (SELECT * FROM ranked WHERE rank <= 10),
marked AS (
  SELECT s.query_id, s.path, frag_no, t.term, t.start, t.stop
  FROM shown s JOIN words w USING (query_id) JOIN ftoks t ON t.path = s.path AND t.term = w.word),
fscores AS (
  SELECT query_id, path, frag_no, count(DISTINCT term)::DOUBLE AS score, count(*) AS n_marks
  FROM marked GROUP BY ALL)"""

TOP_FRAGS = """placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, path ORDER BY score DESC, frag_no) AS place
  FROM fscores),
winners AS (SELECT * FROM placed WHERE place <= 10)"""


def merged(span_key: str) -> str:
    """Runs of neighbouring winners with their text, tags put around the marks."""
    return f"""runs_ AS (
  SELECT query_id, path, frag_no - row_number() OVER (
           PARTITION BY query_id, path ORDER BY frag_no) AS run, w.frag_no, s.start, s.stop, w.score
  FROM winners w JOIN spans s USING (path, frag_no) WHERE {span_key}),
joined AS (
  SELECT query_id, path, run, min(frag_no) AS frag_no, min(start) AS start, max(stop) AS stop,
         max(score) AS score
  FROM runs_ GROUP BY ALL),
ranks AS (
  SELECT query_id, path, frag_no, row_number() OVER (
           PARTITION BY query_id, path ORDER BY score DESC, frag_no) AS frag_rank FROM joined),
cuts AS (
  SELECT j.query_id, j.path, j.frag_no, j.start AS a, j.stop AS b, m.start AS s, m.stop AS e,
         lag(m.stop) OVER (PARTITION BY j.query_id, j.path, j.frag_no ORDER BY m.start) AS prev
  FROM joined j JOIN (SELECT DISTINCT query_id, path, start, stop FROM marked) m
    ON m.query_id = j.query_id AND m.path = j.path AND m.start >= j.start AND m.stop <= j.stop),
texts AS (
  SELECT c.query_id, c.path, c.frag_no, replace(string_agg(
           substring(body, coalesce(prev, a)::BIGINT + 1, s - coalesce(prev, a)::BIGINT)
           || '<b>' || substring(body, s + 1, e - s) || '</b>', '' ORDER BY s)
         || substring(any_value(body), max(e) + 1, any_value(b) - max(e)), chr(10), '') AS text
  FROM (SELECT query_id, path, frag_no, a, b, s::BIGINT AS s, e::BIGINT AS e, prev FROM cuts) c
  JOIN docs USING (path) GROUP BY c.query_id, c.path, c.frag_no)"""


EVENTS = """changes AS (
  SELECT event_id AS seq,
         CASE event_type WHEN 'signup' THEN 'CREATE' WHEN 'view' THEN 'MODIFY'
              WHEN 'click' THEN 'MODIFY' WHEN 'error' THEN 'DELETE' ELSE 'OVERFLOW' END AS kind,
         CASE WHEN event_type IN ('signup', 'view', 'click')
              THEN '/corpus/u' || user_id || '/' || (event_id % 5) || '.txt'
              WHEN event_type = 'error' THEN '/corpus/u' || user_id END AS path, props AS body
  FROM events)"""

FOLDED = """writes AS (
  SELECT path, max(seq) AS seq, arg_max(body, seq) AS body FROM changes
  WHERE kind IN ('CREATE', 'MODIFY') GROUP BY path),
dels AS (SELECT path AS prefix, max(seq) AS del_seq FROM changes WHERE kind = 'DELETE' GROUP BY 1),
raw_dels AS (SELECT path AS prefix, max(seq) AS del_seq FROM changes
             WHERE kind IN ('DELETE', 'MODIFY') GROUP BY 1),
raw_live AS (
  SELECT * FROM writes w WHERE NOT EXISTS (
    SELECT 1 FROM raw_dels WHERE starts_with(w.path, prefix) AND del_seq > w.seq)),
seg_live AS (
  SELECT * FROM writes w WHERE NOT EXISTS (
    SELECT 1 FROM dels WHERE (w.path = prefix OR starts_with(w.path, prefix || '/'))
                             AND del_seq > w.seq))"""

FIRST_FOLDERS = """folders AS (
  SELECT DISTINCT '/corpus/' || source AS prefix FROM (
    SELECT lang, arg_min(source, doc_id) AS source FROM documents GROUP BY lang))"""

ROOTS = """roots AS (
  SELECT min(doc_id) AS seq, '/corpus/' || source AS path FROM documents GROUP BY source),
signups AS (
  SELECT event_id + 1000000000 AS seq, '/corpus/u' || user_id AS path
  FROM events WHERE event_type = 'signup')"""

EXT = "['txt', 'docx', 'xlsx', 'odt', 'ods', 'pdf', 'rtf', 'html']"
TYPED = f"""typed AS (
  SELECT regexp_replace(path, 'txt$', '') || ({EXT})[doc_id % 8 + 1] AS path,
         CASE ({EXT})[doc_id % 8 + 1] {' '.join(f"WHEN '{e}' THEN '{BY_EXTENSION[e]}'" for e in
              ('txt', 'docx', 'xlsx', 'odt', 'ods', 'pdf', 'rtf', 'html'))} END AS mime
  FROM docs
  UNION ALL
  SELECT regexp_replace(url, '[?#].*$', ''),
         CASE WHEN lower(ltrim(html)) LIKE '<!doctype html%' OR lower(ltrim(html)) LIKE '<html%'
              OR regexp_replace(url, '[?#].*$', '') LIKE '%.html'
              THEN 'text/html' ELSE 'text/plain' END FROM pages)"""

INDEXED = """(mime LIKE '%opendocument.text%' OR mime LIKE '%rtf%' OR mime LIKE '%openxmlformats%'
  OR mime LIKE '%pdf%' OR mime LIKE '%text/plain%')"""

GRAMS = f"""clean AS (
  SELECT path, lang, ' ' || trim(regexp_replace(lower(body), '[^\\p{{L}}]+', ' ', 'g')) || ' ' AS t
  FROM docs),
chars AS (SELECT path, lang, string_split(t, '') AS c FROM clean),
cut AS (
  SELECT path, lang, len(c) - 2 AS n_grams, unnest(list_transform(range(1, len(c) - 1),
         lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram FROM chars),
counts AS (SELECT lang, gram, count(*) AS n FROM cut GROUP BY ALL),
profile AS (
  SELECT lang, gram, round(1000.0::DOUBLE * ln((n::DOUBLE / total::DOUBLE)
                           / {UNSEEN_SHARE}::DOUBLE))::BIGINT AS weight
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang) AS total FROM counts)),
sums AS (
  SELECT c.path, n_grams, p.lang, sum(weight)::BIGINT AS score
  FROM cut c JOIN profile p ON p.gram = c.gram WHERE weight > 0 GROUP BY ALL),
verdicts AS (
  SELECT path, n_grams, lang AS detected, score, lead(lang) OVER o AS runner_up,
         score - coalesce(lead(score) OVER o, 0) >= {MARGIN} * n_grams AS certain,
         row_number() OVER o AS place
  FROM sums WINDOW o AS (PARTITION BY path ORDER BY score DESC, lang)),
found AS (
  SELECT d.path, detected, score, runner_up, n_grams, coalesce(certain, false) AS certain
  FROM docs d LEFT JOIN (SELECT * FROM verdicts WHERE place = 1) v ON v.path = d.path)"""

def held(docs: str) -> str:
    """Stored documents and the terms of their bodies; ``docs`` selects path, lang, title, body."""
    return f"""docs AS ({docs}), {TOKS},
        n AS (SELECT path, count(*) AS n_terms FROM toks WHERE field = 'body' GROUP BY path)
        SELECT path, lang, title, md5(body) AS digest, coalesce(n_terms, 0) AS n_terms
        FROM docs LEFT JOIN n USING (path)"""


ALL_DOCS = DOCS.replace("docs AS", "every AS", 1)
SIZES = """sizes AS (
  SELECT split_part(path, ':', 1) AS step, count(*) AS n_places,
         count(DISTINCT (path, field, term)) AS n_postings FROM toks GROUP BY 1)"""

BATCH = """batch AS (
  SELECT path, lang, title, body || ' v1' AS body, 1 AS seq
  FROM docs JOIN labels USING (doc_id)
  UNION ALL
  SELECT path, lang, title, body || ' v2', 2 FROM docs JOIN labels USING (doc_id) WHERE toxic = 1
  UNION ALL
  SELECT url, 'en', url, html, page_id FROM pages),
latest AS (
  SELECT path, arg_max(lang, seq) AS lang, arg_max(title, seq) AS title,
         arg_max(body, seq) AS body FROM batch GROUP BY path)"""

UNDER_RAW = "EXISTS (SELECT 1 FROM folders WHERE starts_with(d.path, prefix))"
UNDER_SEG = ("EXISTS (SELECT 1 FROM folders WHERE d.path = prefix "
             "OR starts_with(d.path, prefix || '/'))")


def body_terms(where: str, possessive: bool, stop: bool) -> str:
    text = f"regexp_replace(body, '{POSS}', '\\1\\2', 'g')" if possessive else "body"
    keep = f"WHERE lower(w) NOT IN {STOP}" if stop else ""
    return f"""WITH {DOCS} SELECT path, pos, lower(w) AS term FROM (
      SELECT path, unnest(ws) AS w, unnest(range(len(ws)))::INT AS pos FROM (
        SELECT path, regexp_extract_all({text}, '{W}') AS ws FROM docs WHERE {where})) {keep}"""


def suggested(matches: str) -> str:
    return f"""WITH {DOCS}, {TOKS}, {STATS}, {WORDS}, p AS (
        SELECT DISTINCT substring(word, 1, 3) AS prefix FROM words)
        SELECT prefix, term, df, rank FROM (
          SELECT prefix, term, df, row_number() OVER (
            PARTITION BY prefix ORDER BY df DESC, term) AS rank
          FROM p JOIN tstats ON lang = 'en' AND field = 'body' AND {matches}(term, prefix))
        WHERE rank <= 30"""


ORACLE = {
    "scan_docs": f"""WITH {DOCS} SELECT path, lang, title, length(body) AS n_chars,
        md5(body) AS digest FROM docs""",
    "scan_tree": """SELECT source, lang, doc_id, md5(text) AS digest, NULL::VARCHAR AS error
        FROM documents""",
    "media_type_counts": f"WITH {DOCS}, {TYPED} SELECT mime, count(*) AS n FROM typed GROUP BY 1",
    "media_type_filter": f"WITH {DOCS}, {TYPED} SELECT path, mime FROM typed WHERE {INDEXED}",
    "extract_text": f"""WITH {DOCS} SELECT path, length(body) AS n_chars, md5(body) AS digest
        FROM docs""",
    "extractor_hook": f"""WITH {DOCS} SELECT path, length(body) AS n_chars,
        md5(replace(body, chr(10), ' ')) AS digest, NULL::VARCHAR AS error FROM docs""",
    "list_roots": f"WITH {ROOTS} SELECT seq, path FROM roots ORDER BY seq",
    "title_terms": f"""WITH {DOCS} SELECT path, pos, lower(w) AS term FROM (
        SELECT path, unnest(ws) AS w, unnest(range(len(ws)))::INT AS pos FROM (
          SELECT path, regexp_extract_all(title, '{W}') AS ws FROM docs))""",
    "tokenize": body_terms("true", False, False),
    "tokenize_joined": f"""WITH {DOCS},
        cut AS (
          SELECT path, unnest(range(len(ws))) AS k, unnest(gaps[1:len(ws)]) AS gap, unnest(ws) AS w
          FROM (SELECT path, string_split_regex(body, '{RUN}') AS gaps,
                       regexp_extract_all(body, '{RUN}') AS ws FROM docs)),
        pairs AS (SELECT *, lag(w) OVER (PARTITION BY path ORDER BY k) AS prev FROM cut),
        judged AS (
          SELECT *, NOT coalesce(
            (regexp_matches(gap, '^[''’.:]$') AND regexp_matches(prev, '[\\p{{L}}\\p{{M}}_]$')
             AND regexp_matches(w, '^[\\p{{L}}_]'))
            OR (regexp_matches(gap, '^[.,;''’]$') AND regexp_matches(prev, '\\p{{N}}$')
                AND regexp_matches(w, '^\\p{{N}}')), false) AS fresh FROM pairs),
        placed AS (
          SELECT *, sum(fresh::INT) OVER (PARTITION BY path ORDER BY k) - 1 AS pos FROM judged)
        SELECT path, pos::INT AS pos, lower(string_agg(
          CASE WHEN fresh THEN w ELSE gap || w END, '' ORDER BY k)) AS term
        FROM placed GROUP BY path, pos""",
    "analyze_en_stop": body_terms("lang = 'en'", True, True),
    "analyze_en_stem": f"""WITH {DOCS}, {CUT_TOKS}, {stemmed(EN_BODY)}
        SELECT path, pos::INT AS pos, stem AS term FROM cut JOIN stemmed USING (term)
        WHERE field = 'body' AND lang = 'en'""",
    "search_stemmed": f"""WITH {DOCS}, {CUT_TOKS}, {WORDS},
        {stemmed('SELECT term FROM cut', 'SELECT word FROM words')}, {STEM_TOKS}, {STATS}, {SCORED},
        qterms AS (
          SELECT query_id, 'en' AS lang, field, CASE WHEN field = 'body' AND word NOT IN {STOP}
                 THEN stem ELSE word END AS term
          FROM words JOIN stemmed ON term = word, (SELECT unnest(['body', 'title']) AS field)),
        {WORD_HITS} SELECT query_id, path, round(score, 4) AS score FROM hits""",
    "postings_lang_tables": f"""WITH {DOCS}, {CUT_TOKS}, {TABLE_TOKS}, {STATS}
        SELECT lang, field, term, path, len, tf, array_to_string(positions, ',') AS positions
        FROM posts JOIN lens USING (lang, field, path)""",
    "search_lang_tables": f"""WITH {DOCS}, {CUT_TOKS}, {TABLE_TOKS}, {STATS}, {SCORED}, {WORDS},
        asked AS (
          SELECT lang || ':' || query_id AS query_id, lang, field,
                 CASE WHEN field = 'body' AND length(word) > 3 AND word LIKE '%s'
                 THEN left(word, -1) ELSE word END AS term FROM words,
            (SELECT unnest(['de', 'es', 'fr']) AS lang),
            (SELECT unnest(['body', 'title']) AS field))
        SELECT query_id, path, round({exact_sum('score')}, 4) AS score
        FROM asked JOIN scored USING (lang, field, term) GROUP BY query_id, path""",
    "analyze_lang_tables": f"""WITH {DOCS}, t AS (
        SELECT lang, path, pos, lower(w) AS term FROM (
          SELECT lang, path, unnest(ws) AS w, unnest(range(len(ws)))::INT AS pos FROM (
            SELECT lang, path, regexp_extract_all(body, '{W}') AS ws FROM docs
            WHERE lang <> 'en')))
        SELECT lang, path, pos, CASE WHEN term LIKE '%s' THEN left(term, -1) ELSE term END AS term
        FROM t WHERE length(term) > 3""",
    "lang_detect": f"""WITH {DOCS}, {GRAMS} SELECT path, detected, score, runner_up, n_grams, certain
        FROM found""",
    "lang_route": f"""WITH {DOCS}, {GRAMS} SELECT path,
        CASE WHEN certain AND detected = 'fr' THEN 'fr' ELSE 'en' END AS lang FROM found""",
    "analyze_queries": f"""WITH q AS (
        SELECT item_id, 'body' AS field, list_filter(list_transform(regexp_extract_all(
          regexp_replace(text, '{POSS}', '\\1\\2', 'g'), '{W}'), lambda w: lower(w)),
          lambda w: w NOT IN {STOP}) AS ws FROM benchmark
        UNION ALL
        SELECT item_id, 'title', list_transform(regexp_extract_all(text, '{W}'), lambda w: lower(w))
        FROM benchmark)
        SELECT item_id AS query_id, field, len(ws) AS n_terms,
               array_to_string(ws, ' ') AS terms FROM q""",
    "query_validate": f"""WITH {WORDS}, q AS (
        SELECT -item_id - 1 AS query_id, ['term', 'phrase', 'fuzzy', 'prefix'][item_id % 4 + 1] AS kind,
               text FROM benchmark
        UNION ALL SELECT query_id, 'term', word FROM words)
        SELECT query_id, CASE WHEN kind <> 'phrase' AND contains(text, ' ') THEN
          'one word expected in a query of kind ' || kind END AS reason FROM q""",
    "highlight_mark": f"""WITH {DOCS}, m AS (
        SELECT path, array_to_string(list_transform(list_zip(
          string_split_regex(body, '{W}'), regexp_extract_all(body, '{W}')), lambda p: p[1] ||
          CASE WHEN p[2] IS NULL THEN '' WHEN lower(p[2]) IN {STOP} THEN '<b>' || p[2] || '</b>'
               ELSE p[2] END), '') AS body FROM docs)
        SELECT path, md5(body) AS digest, length(body) AS n_chars FROM m""",
    "postings": f"""WITH {DOCS}, {TOKS}, {STATS} SELECT lang, field, term, path, tf,
        array_to_string(positions, ',') AS positions FROM posts""",
    "doc_length": f"""WITH {DOCS}, {TOKS}, {STATS} SELECT lang, field, path, len, kept_len
        FROM klens""",
    "term_stats": f"WITH {DOCS}, {TOKS}, {STATS} SELECT lang, field, term, df, ttf FROM tstats",
    "field_stats": f"""WITH {DOCS}, {TOKS}, {STATS} SELECT lang, field, n_docs, sum_len,
        round(avg_len, 4) AS avg_len FROM fstats""",
    "snapshot_tables": f"""WITH {DOCS}, {TOKS}, {STATS}
        SELECT 'docs' AS name, count(*) AS n_rows, count(*) AS total FROM docs
        UNION ALL SELECT 'postings', count(*), sum(tf)::BIGINT FROM posts
        UNION ALL SELECT 'terms', count(*), count(*) FROM tstats
        UNION ALL SELECT 'lengths', count(*), sum(len)::BIGINT FROM lens""",
    "upsert": f"""WITH {DOCS}, {BATCH} SELECT path, lang, title, md5(body) AS digest FROM docs
        WHERE path NOT IN (SELECT path FROM latest)
        UNION ALL SELECT path, lang, title, md5(body) FROM latest""",
    "remove_prefix": f"""WITH {DOCS}, {FIRST_FOLDERS} SELECT path, md5(body) AS digest FROM docs d
        WHERE NOT {UNDER_RAW}""",
    "remove_prefix_segment": f"""WITH {DOCS}, {FIRST_FOLDERS} SELECT path, md5(body) AS digest
        FROM docs d WHERE NOT {UNDER_SEG}""",
    "remove_exact": f"""WITH {DOCS} SELECT path, md5(body) AS digest FROM docs
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "register_roots": f"""WITH {ROOTS} SELECT min(seq) AS seq, path FROM (
        SELECT seq, path FROM roots UNION ALL SELECT seq, path FROM signups
        UNION ALL SELECT seq + 2000000000, path FROM roots) GROUP BY path""",
    "unregister_root": f"""WITH {DOCS}, {ROOTS}, {FIRST_FOLDERS}
        SELECT 'root' AS what, path FROM roots WHERE path NOT IN (SELECT prefix FROM folders)
        UNION ALL SELECT 'doc', path FROM docs d WHERE NOT {UNDER_RAW}""",
    "reindex": f"""WITH {DOCS}, {FIRST_FOLDERS}
        SELECT path, lang, md5('old ' || body) AS digest FROM docs d WHERE NOT {UNDER_RAW}
        UNION ALL SELECT path, lang, md5(body) FROM docs d WHERE {UNDER_SEG}""",
    "store_upsert": f"""WITH {ALL_DOCS}, {BATCH.replace('FROM docs', 'FROM every')}, {held("""
          SELECT path, lang, title, body FROM every WHERE path NOT IN (SELECT path FROM latest)
          UNION ALL SELECT path, lang, title, body FROM latest""")}""",
    "store_remove": f"""WITH {ALL_DOCS}, {FIRST_FOLDERS}, {held(
        f"SELECT path, lang, title, body FROM every d WHERE NOT {UNDER_RAW}")}""",
    "store_reindex": f"""WITH {ALL_DOCS}, {FIRST_FOLDERS}, {held(f"""
          SELECT path, lang, title, 'old ' || body AS body FROM every d WHERE NOT {UNDER_RAW}
          UNION ALL SELECT path, lang, title, body FROM every d WHERE {UNDER_SEG}""")}""",
    "roots_lifecycle": f"""WITH {ALL_DOCS}, {FIRST_FOLDERS},
        rest AS (SELECT prefix FROM folders WHERE prefix <> (SELECT min(prefix) FROM folders)),
        registered AS (
          SELECT path, lang, title, CASE WHEN {UNDER_SEG} THEN body ELSE 'old ' || body END AS body
          FROM every d),
        unregistered AS (
          SELECT * FROM registered
          WHERE NOT starts_with(path, (SELECT min(prefix) FROM folders))),
        docs AS (
          SELECT 'published:' || path AS path, lang, title, 'old ' || body AS body FROM every
          UNION ALL SELECT 'registered:' || path, lang, title, body FROM registered
          UNION ALL SELECT 'unregistered:' || path, lang, title, body FROM unregistered
          UNION ALL SELECT 'reindexed:' || path, lang, title, body FROM unregistered d
            WHERE NOT {UNDER_RAW.replace('folders', 'rest')}
          UNION ALL SELECT 'reindexed:' || path, lang, title, 'new ' || body FROM every d
            WHERE {UNDER_SEG.replace('folders', 'rest')}),
        {TOKS}, {SIZES},
        steps AS (SELECT unnest(['published', 'registered', 'unregistered', 'reindexed', 'purged'])
                  AS step)
        SELECT step, CASE step WHEN 'registered' THEN (SELECT count(*) FROM folders)
                 WHEN 'unregistered' THEN (SELECT count(*) FROM rest)
                 WHEN 'reindexed' THEN (SELECT count(*) FROM rest) ELSE 0 END AS n_roots,
               (SELECT count(*) FROM docs WHERE starts_with(path, step || ':')) AS n_docs,
               coalesce(n_postings, 0) AS n_postings, coalesce(n_places, 0) AS n_places
        FROM steps LEFT JOIN sizes USING (step)""",
    "purge": f"""WITH {DOCS}, {TOKS}
        SELECT 'before' AS step, (SELECT count(DISTINCT source) FROM documents) AS n_roots,
               (SELECT count(*) FROM documents) AS n_docs,
               count(DISTINCT (path, field, term)) AS n_postings, count(*) AS n_places FROM toks
        UNION ALL SELECT 'after', 0, 0, 0, 0""",
    "search_term": f"""{WORD_SEARCH} SELECT query_id, path, round(score, 4) AS score FROM hits""",
    "search_bool_parts": f"""{WORD_SEARCH} SELECT query_id, path,
        round(sum(CASE WHEN field = 'body' THEN score END), 4) AS body_score,
        round(sum(CASE WHEN field = 'title' THEN score END), 4) AS title_score,
        count(*) AS n_clauses FROM clauses GROUP BY query_id, path""",
    "search_lang": f"""{BASE}, {WORDS}, asked AS (
        SELECT word, lang || ':' || query_id AS query_id, lang, field FROM words,
          (SELECT unnest(['en', 'de', 'es', 'fr']) AS lang),
          (SELECT unnest(['body', 'title']) AS field))
        SELECT query_id, path, round({exact_sum('score')}, 4) AS score FROM asked a
        JOIN scored s ON s.lang = a.lang AND s.field = a.field AND s.term = a.word
        GROUP BY query_id, path""",
    "bm25_scores": f"""{BASE} SELECT lang, field, term, path, round(score, 4) AS score
        FROM scored""",
    "hit_counts": f"{WORD_SEARCH} SELECT query_id, count(*) AS n_hits FROM hits GROUP BY 1",
    "search_ranked": f"{WORD_SEARCH} SELECT query_id, path, rank FROM ranked",
    "search_topk": f"""{WORD_SEARCH} SELECT query_id, path, rank, round(score, 4) AS score
        FROM ranked WHERE rank <= 10""",
    "search_fetch": f"""{WORD_SEARCH} SELECT query_id, rank, path, title, md5(body) AS digest
        FROM ranked JOIN docs USING (path) WHERE rank <= 10""",
    "search_phrase": f"""{BASE}, {phrases(CONSECUTIVE)}
        SELECT query_id, path, round(score, 4) AS score FROM phits""",
    "search_phrase_gaps": f"""{BASE}, {phrases(TRUE_PLACE)}
        SELECT query_id, path, round(score, 4) AS score FROM phits""",
    "fuzzy_expand": f"""WITH {DOCS}, {TOKS}, {STATS}, {WORDS}, {TYPOS}, {WITHIN_TWO}
        SELECT field, word, term, df, edits::BIGINT AS edits, round(boost, 4) AS boost, rank,
               top_df FROM expanded""",
    "fuzzy_levenshtein": f"""WITH {DOCS}, {TOKS}, {STATS}, {WORDS}, {TYPOS}
        SELECT field, word, term, edits FROM (
          SELECT field, word, term, levenshtein({plain('word')}, {plain('term')}) AS edits
          FROM (SELECT DISTINCT field, word FROM asked)
          JOIN (SELECT field, term FROM tstats WHERE lang = 'en') USING (field)
          WHERE abs(length(word) - length(term)) <= 2)
        WHERE edits <= 2 AND edits < least(length(word), length(term))""",
    "search_fuzzy": f"""{BASE}, {WORDS}, {TYPOS}, {WITHIN_TWO}, {FUZZY_HITS}
        SELECT query_id, path, round(score, 4) AS score FROM fuzzy""",
    "search_prefix": f"""WITH {DOCS}, q AS (
        SELECT min(doc_id) + {PREFIX_BASE} AS query_id, '/corpus/' || source AS prefix
        FROM documents GROUP BY source)
        SELECT query_id, path, 1.0::DOUBLE AS score FROM q JOIN docs ON starts_with(path, prefix)""",
    "fragments": f"""WITH {DOCS}, {FRAGS} SELECT path, frag_no, start, stop AS "end" FROM spans""",
    "fragment_scores": f"""{WORD_SEARCH}, {FRAGS}, {WORD_MARKS}
        SELECT query_id, path, frag_no, score, n_marks FROM fscores""",
    "snippets_top": f"""{WORD_SEARCH}, {FRAGS}, {WORD_MARKS}, {TOP_FRAGS}
        SELECT query_id, path, frag_no, place FROM winners""",
    "snippets_merged": f"""{WORD_SEARCH}, {FRAGS}, {WORD_MARKS}, {TOP_FRAGS}, {merged('true')}
        SELECT s.query_id, s.path, rank, frag_rank, t.frag_no, text FROM shown s
        LEFT JOIN texts t ON t.query_id = s.query_id AND t.path = s.path
        LEFT JOIN ranks r ON r.query_id = t.query_id AND r.path = t.path AND r.frag_no = t.frag_no""",
    "snippets_phrase": f"""{BASE}, {phrases(TRUE_PLACE)},
        ranked AS (SELECT query_id, path, row_number() OVER (
          PARTITION BY query_id ORDER BY score DESC, path) AS rank FROM phits),
        shown AS (SELECT * FROM ranked WHERE rank <= 10),
        covered AS (
          SELECT DISTINCT s.query_id, s.path, q.term, s.start + q.place AS pos, q.place > 0 AS inside
          FROM starts s JOIN pterms q ON q.query_id = s.query_id AND q.field = s.field
          JOIN shown h ON h.query_id = s.query_id AND h.path = s.path),
        {PIECES},
        bplaces AS (
          SELECT k.*, h.query_id AS qid, EXISTS (
            SELECT 1 FROM covered c WHERE c.query_id = h.query_id AND c.path = h.path
              AND c.pos = k.pos AND c.inside) AS inside
          FROM kept k JOIN shown h ON h.path = k.path),
        {fragment_rows('bplaces')},
        marked AS (
          SELECT DISTINCT c.query_id, c.path, t.frag_no, t.term, t.start, t.stop
          FROM covered c JOIN ftoks t ON t.qid = c.query_id AND t.path = c.path
            AND t.pos = c.pos AND t.term = c.term),
        fscores AS (SELECT query_id, path, frag_no, count(DISTINCT term)::DOUBLE AS score
                    FROM marked GROUP BY ALL),
        {TOP_FRAGS}, {merged('s.qid = w.query_id')}
        SELECT s.query_id, s.path, rank, frag_rank, t.frag_no, text FROM shown s
        LEFT JOIN texts t ON t.query_id = s.query_id AND t.path = s.path
        LEFT JOIN ranks r ON r.query_id = t.query_id AND r.path = t.path AND r.frag_no = t.frag_no""",
    "search_batch": f"""{BASE}, {WORDS}, {WORD_TERMS},
        {WORD_HITS.replace('hits AS', 'whits AS')}, {TYPOS}, {WITHIN_TWO}, {FUZZY_HITS},
        {phrases(CONSECUTIVE)},
        hits AS (
          SELECT query_id, path, score FROM whits UNION ALL SELECT query_id, path, score FROM fuzzy
          UNION ALL SELECT query_id, path, score FROM phits
          UNION ALL SELECT query_id, path, 1.0 FROM (
            SELECT min(doc_id) + {PREFIX_BASE} AS query_id, '/corpus/' || source AS prefix
            FROM documents GROUP BY source) JOIN docs ON starts_with(path, prefix)),
        {RANKED} SELECT query_id, path, rank, round(score, 4) AS score FROM ranked
        WHERE rank <= 10""",
    "suggest_terms": suggested("starts_with"),
    "suggest_inside": suggested("contains"),
    "change_counts": f"WITH {EVENTS} SELECT kind, count(*) AS n FROM changes GROUP BY kind",
    "snapshot_diff": f"""WITH {DOCS}, old AS (SELECT path, length(body) AS n FROM docs), new AS (
        SELECT path, length(body) + coalesce(quality, 0) AS n FROM docs LEFT JOIN labels USING (doc_id)
        WHERE coalesce(toxic, 0) <> 1 UNION ALL SELECT url, length(html) FROM pages)
        SELECT coalesce(old.path, new.path) AS path,
          CASE WHEN old.path IS NULL THEN 'CREATE' WHEN new.path IS NULL THEN 'DELETE'
               ELSE 'MODIFY' END AS kind
        FROM old FULL JOIN new ON old.path = new.path
        WHERE old.path IS NULL OR new.path IS NULL OR old.n <> new.n""",
    "fold_changes": f"""WITH {EVENTS}, {FOLDED}
        SELECT 'raw_prefix' AS mode, seq, path, body FROM raw_live
        UNION ALL SELECT 'segment', seq, path, body FROM seg_live""",
    "apply_changes": f"""WITH {EVENTS}, {FOLDED}
        SELECT path, replace(split_part(path, '/', -1), '.', ' ') AS title, body,
               len(list_filter(regexp_extract_all(body, '{W}'), lambda w: lower(w) NOT IN {STOP}))
                 AS n_terms FROM seg_live""",
    "stream_roots": f"""WITH {EVENTS.replace('changes AS', 'named AS', 1)},
        every AS (
          SELECT seq, kind, CASE kind WHEN 'DELETE' THEN path || '/' || (seq % 5) || '.txt'
                                 ELSE path END AS path, body FROM named),
        homes AS (
          SELECT home, min(seq) AS died FROM (
            SELECT DISTINCT '/corpus/u' || user_id || '/' || (event_id % 5) || '.txt' AS home
            FROM events WHERE event_type = 'signup')
          LEFT JOIN every ON kind = 'DELETE' AND path = home GROUP BY 1),
        changes AS (
          SELECT * FROM every WHERE EXISTS (
            SELECT 1 FROM homes WHERE (path = home OR starts_with(path, home || '/'))
              AND (died IS NULL OR seq <= died))),
        {FOLDED}
        SELECT 'doc' AS what, path, md5(body) AS digest FROM seg_live
        UNION ALL SELECT 'root', home, NULL FROM homes WHERE died IS NULL""",
    "overflow_reconcile": f"""WITH {ALL_DOCS}, {held(
        "SELECT path, lang, title, body FROM every")}""",
    "events_in_roots": f"""WITH {EVENTS} SELECT seq, kind, path FROM changes c WHERE EXISTS (
        SELECT 1 FROM events e WHERE event_type = 'signup' AND (
          c.path = '/corpus/u' || e.user_id OR starts_with(c.path, '/corpus/u' || e.user_id || '/')))""",
}
