"""Oracle SQL (DuckDB) for the queries of ``contract.queries``."""

from __future__ import annotations

from contract import sql
from contract.sql import PAPERS, hashed, quote, query, round4, strip
from contract.topics import TOPIC_A, TOPIC_B, TOPICS
from topicsieve.functions.scoring import DEFAULT_THRESHOLDS
from topicsieve.functions.text import SPACE, WORD
from topicsieve.functions.titles import HEADER_STARTS, INSTITUTIONS, SECTION_STARTS
from topicsieve.operators.generation import SYSTEM_PROMPT

ORACLES: dict[str, str] = {}

NL = "chr(10)"
SUMMARY = "paper_id, title, year, score_final, decision"
BREAKDOWN = "keyword, tfidf, sbert, weighted"
SCORED_A = sql.scored("a", "s")
SCORED_B = sql.scored("b", "s")


def two_topics() -> str:
    return sql.scored("a", "s") + ",\nb AS (" + "\n".join(
        ["WITH " + sql.scored("b", "nb"), "SELECT * FROM nb)"]
    )


TWO = two_topics()


def stamp(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


# --- Scans, sources, sinks ---------------------------------------------------

ORACLES["scan_corpus"] = query(
    PAPERS,
    """SELECT p.paper_id, p.text, coalesce(len(e.embedding), -1) AS dims,
              CAST(e.embedding[1] AS DOUBLE) AS first_component
       FROM papers p LEFT JOIN embeddings e ON e.vec_id = p.doc_id""",
)

PAGES = f"""pages_text AS (
  SELECT doc_id, 'PAPER_' || (doc_id + 1) AS paper_id,
         'doi:10.1000/' || doc_id || {NL} || 'Received ' || (1 + doc_id % 28) || ' May ' || (1985 + doc_id % 60)
         || {NL} || text || {NL} || 'Abstract: ' || text || {NL} || {NL} || 'Introduction' || {NL}
         AS full_text,
         CASE WHEN doc_id % 10 = 0 THEN 'A Metadata Title For Document ' || doc_id END AS meta_title
  FROM documents)"""

UPLOADS = PAGES + """,
uploads AS (
  SELECT doc_id, 'inbox/' || doc_id || CASE WHEN doc_id % 7 = 0 THEN '.txt' WHEN doc_id % 2 = 0 THEN '.PDF'
                                            ELSE '.pdf' END AS path,
         CASE WHEN doc_id % 11 = 0 THEN '' ELSE full_text END AS body, meta_title
  FROM pages_text)"""

ORACLES["validate_upload"] = query(
    UPLOADS,
    """SELECT path, CAST(strlen(body) AS BIGINT) AS length,
              CASE WHEN doc_id % 7 = 0 THEN 'not a .pdf file' WHEN doc_id % 11 = 0 THEN 'empty file' END
              AS reject_reason
       FROM uploads""",
)

_FILES = UPLOADS + """,
files AS (SELECT split_part(path, '/', 2) AS name, body FROM uploads WHERE lower(path) LIKE '%.pdf' AND body <> '')"""
ORACLES["list_binary_files"] = query(_FILES, "SELECT name, CAST(strlen(body) AS BIGINT) AS length FROM files")
ORACLES["list_binary_files_limited"] = ORACLES["list_binary_files"] + " ORDER BY name LIMIT 100"
ORACLES["read_binary"] = query(
    _FILES, "SELECT name, md5(body) AS digest, CAST(strlen(body) AS INTEGER) AS n_bytes FROM files"
)

ORACLES["append_rows"] = query(SCORED_A, f"SELECT {SUMMARY} FROM s")
ORACLES["write_by_tier"] = query(SCORED_A, f"SELECT tier, {SUMMARY} FROM s WHERE tier IN ('gold', 'silver')")
ORACLES["retire_stale_tier"] = query(
    TWO,
    """SELECT s.paper_id, CASE WHEN s.minio_key IS NULL THEN s.tier ELSE b.tier END AS tier
       FROM s JOIN b USING (paper_id)
       WHERE s.tier_minio_key IS NOT NULL OR s.minio_key IS NOT NULL""",
)
ORACLES["object_key"] = (
    "SELECT 'PAPER_' || (doc_id + 1) AS paper_id, 'uploads/PAPER_' || (doc_id + 1) || '.pdf' AS object_key "
    "FROM documents"
)

SEEDS = PAPERS + """,
seeds AS (
  SELECT paper_id, title, coalesce(abstract, 'Seeded ' || title) AS abstract, year FROM papers WHERE doc_id % 4 = 0
  UNION ALL
  SELECT 'PAPER_9' || lpad(CAST(doc_id AS VARCHAR), 12, '0'), title, coalesce(abstract, 'Seeded ' || title), year
  FROM papers WHERE doc_id % 100 = 1)"""
ORACLES["seed_if_empty"] = query(
    SEEDS,
    """SELECT 'filled' AS start, paper_id, abstract FROM papers
       UNION ALL SELECT 'empty', paper_id, abstract FROM seeds""",
)

# --- Projections, filters, predicates ---------------------------------------

ORACLES["paper_summary"] = query(SCORED_A, f"SELECT {SUMMARY} FROM s")
ORACLES["paper_detail"] = query(
    SCORED_A,
    f"SELECT {SUMMARY}, abstract, {BREAKDOWN}, minio_key, tier_minio_key FROM s WHERE paper_id = 'PAPER_8'",
)
ORACLES["list_by_min_score"] = query(
    SCORED_A, f"SELECT {SUMMARY} FROM s WHERE score_final >= 3 ORDER BY score_final DESC, paper_id LIMIT 50"
)
ORACLES["search_papers"] = query(
    PAPERS,
    """SELECT paper_id, title FROM papers
       WHERE contains(lower(title), 'ther') OR contains(lower(paper_id), 'ther')""",
)
ORACLES["filter_by_tier"] = query(SCORED_A, "SELECT paper_id, score_final FROM s WHERE score_final IN (1, 2)")
ORACLES["select_for_justify"] = query(
    SCORED_A,
    """SELECT 'ids' AS chosen_by, CAST(w.pos AS INTEGER) AS request_pos, s.paper_id
       FROM (VALUES (0, 'PAPER_9'), (1, 'PAPER_2'), (2, 'UNKNOWN'), (3, 'PAPER_9'), (4, 'PAPER_40')) w(pos, id)
       JOIN s ON s.paper_id = w.id
       UNION ALL
       SELECT 'top', CAST(r - 1 AS INTEGER), paper_id
       FROM (SELECT paper_id, row_number() OVER (ORDER BY weighted DESC NULLS LAST, paper_id) AS r FROM s)
       WHERE r <= 25
       UNION ALL
       SELECT 'min_score', -1, paper_id FROM s WHERE score_final >= 4""",
)
ORACLES["justify_targets"] = query(
    SCORED_A,
    """SELECT 'gold_only' AS mode, paper_id FROM s WHERE coalesce(score_final, 0) >= 4
       UNION ALL SELECT 'all', paper_id FROM s""",
)

LATEST = sql.JOB_LOG + """,
latest AS (
  SELECT job_id, stage, status, total, processed,
         min(ts) OVER (PARTITION BY job_id) AS created_at, ts AS updated_at
  FROM log QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ts DESC, event_id DESC) = 1)"""
ORACLES["job_lookup"] = query(
    LATEST,
    f"SELECT job_id, stage, status, processed, {stamp('updated_at')} AS updated_at FROM latest WHERE job_id = 'job-7'",
)
ORACLES["completed_targets"] = query(
    LATEST,
    """SELECT job_id, 'PAPER_' || split_part(job_id, '-', 2) AS paper_id FROM latest
       WHERE status = 'completed' AND CAST(split_part(job_id, '-', 2) AS BIGINT) % 5 IN (3, 4)""",
)


def _checks(source: str, frame: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source, '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS n_violations, "
        f"count(*) AS n_rows FROM {frame}"
        for rule, broken in rules.items()
    )


_PAPER_RULES = {
    f"{s}_range": f"NOT coalesce({s} BETWEEN 0.0 AND 1.0, FALSE)" for s in ("keyword", "tfidf", "sbert", "weighted")
}
_PAPER_RULES["score_final_range"] = "NOT coalesce(score_final BETWEEN 0 AND 5, FALSE)"
_PAPER_RULES |= {f"{c}_missing": f"{c} IS NULL" for c in ("paper_id", "title", "year", "decision")}
_TOPIC_RULES = {"year_range_size": "FALSE"} | {
    f"{c}_missing": "FALSE" for c in ("topic_name", "query_text", "axes", "weights")
}
_TOPIC_RULES["topic_name_missing"] = "lang IS NULL"
_TOPIC_RULES["query_text_missing"] = "text IS NULL"
_JOB_RULES = {
    "status_unknown": "status IS NULL",
    "stage_missing": "stage IS NULL",
    "job_id_missing": "job_id IS NULL",
}
_NOTHING = "doc_id % 2 <> 0 AND doc_id % 5 <> 0"
ORACLES["quality_check"] = query(
    SCORED_A + ",\n" + sql.JOB_LOG,
    " UNION ALL ".join(
        [
            _checks("papers", "s", _PAPER_RULES),
            _checks("topics", "documents", _TOPIC_RULES),
            _checks("jobs", "log", _JOB_RULES),
            _checks("patches", "(SELECT * FROM documents WHERE doc_id % 3 <> 2)", {"nothing_to_update": _NOTHING}),
        ]
    ),
)

# --- Extraction --------------------------------------------------------------


def _starts(line: str, starts) -> str:
    return "(" + " OR ".join(f"starts_with(lower({line}), {quote(s)})" for s in starts) + ")"


def _header(line: str) -> str:
    return f"({_starts(line, HEADER_STARTS)} OR regexp_matches(lower({line}), '^page[{SPACE}]+\\p{{Nd}}'))"


def _candidate(line: str) -> str:
    words = f"len(list_filter(string_split_regex({line}, '[{SPACE}]+'), lambda w: length(w) > 3))"
    return (
        f"(length({line}) BETWEEN 25 AND 300 AND NOT {_header(line)} "
        f"AND regexp_matches({line}, '[a-z]') AND {words} >= 3)"
    )


def _section(line: str) -> str:
    return (
        f"({_starts(line, SECTION_STARTS)} OR regexp_matches(lower({line}), "
        f"'^(1\\.[{SPACE}]|i\\.[{SPACE}]|chapter[{SPACE}]|\\p{{Nd}}+[{SPACE}]*$)'))"
    )


def lines_of(source: str, text: str, key: str) -> str:
    """CTEs ending in ``l`` (key, pos, line): stripped lines with 0-based positions."""
    return f"""raw_l AS (SELECT {key}, string_split({text}, {NL}) AS ls FROM {source}),
num_l AS (SELECT {key}, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM raw_l),
l AS (SELECT {key}, CAST(pos AS INTEGER) AS pos, {strip('line')} AS line FROM num_l)"""


PAGE_LINES = PAGES + ",\n" + lines_of("pages_text", "full_text", "paper_id")
ORACLES["looks_like_title"] = query(PAGE_LINES, f"SELECT paper_id, pos, {_candidate('line')} AS candidate FROM l")


def cut_author(title: str) -> str:
    """SQL expression; the shorter of the two possible prefixes wins."""
    mail = rf"(?is)^(.*?)@[{WORD}.\-]+\.[a-z]{{2,}}"
    place = rf"(?is)^(|.*?[^{WORD}])(?:{'|'.join(INSTITUTIONS)})(?:[^{WORD}]|$)"
    before_mail = f"CASE WHEN regexp_matches({title}, '{mail}') THEN regexp_extract({title}, '{mail}', 1) END"
    before_place = f"CASE WHEN regexp_matches({title}, '{place}') THEN regexp_extract({title}, '{place}', 1) END"
    shorter = f"substr({title}, 1, least(length({before_mail}), length({before_place})))"
    cut = f"rtrim({shorter}, ' -–—,·*⋆')"
    return f"substr(coalesce({cut}, {title}), 1, 300)"


TITLES = PAGE_LINES + f""",
cand AS (SELECT *, {_candidate('line')} AS cand FROM l),
first_l AS (SELECT paper_id, min(pos) AS s FROM cand WHERE cand GROUP BY paper_id),
from_s AS (
  SELECT l.paper_id, l.pos, l.line, f.s,
         lag(l.line) OVER (PARTITION BY l.paper_id ORDER BY l.pos) AS before,
         sum(CASE WHEN l.pos >= f.s THEN length(l.line) ELSE 0 END) OVER (PARTITION BY l.paper_id ORDER BY l.pos) AS total
  FROM l JOIN first_l f USING (paper_id)),
ends AS (
  SELECT paper_id, s,
    max(CASE WHEN pos = s AND length(line) >= 120 THEN s END) AS at_once,
    min(CASE WHEN pos > s AND (line = '' OR {_section('line')} OR {_header('line')} OR length(line) > 250
                               OR regexp_matches(before, '[.!?]$')) THEN pos - 1 END) AS stopped,
    min(CASE WHEN pos >= s AND total > 250 THEN pos END) AS full_at,
    max(pos) AS last_pos
  FROM from_s GROUP BY paper_id, s),
joined AS (
  SELECT e.paper_id, string_agg(l.line, ' ' ORDER BY l.pos) AS title
  FROM ends e JOIN l USING (paper_id)
  WHERE l.pos BETWEEN e.s AND coalesce(at_once, least(coalesce(stopped, last_pos), coalesce(full_at, last_pos), last_pos))
  GROUP BY e.paper_id),
filler AS (SELECT paper_id, arg_min(line, pos) AS line FROM l WHERE line <> '' GROUP BY paper_id),
picked AS (
  SELECT p.paper_id, p.full_text, p.doc_id,
         CASE WHEN p.meta_title IS NOT NULL AND {_candidate(strip('p.meta_title'))} THEN {strip('p.meta_title')}
              WHEN j.title IS NOT NULL THEN {cut_author('j.title')}
              ELSE coalesce(substr(f.line, 1, 200), '(sin titulo)') END AS title
  FROM pages_text p LEFT JOIN joined j USING (paper_id) LEFT JOIN filler f USING (paper_id))"""
ORACLES["pick_title"] = query(TITLES, "SELECT paper_id, title FROM picked")

ORACLES["cut_inline_author"] = query(
    f"""d AS (
  SELECT doc_id, replace(text || CASE WHEN doc_id % 5 = 0 THEN ' - Department of Things'
         WHEN doc_id % 7 = 0 THEN ', someone@example.org and others' ELSE '' END, {NL}, ' ') AS t
  FROM documents)""",
    f"SELECT doc_id, {cut_author('t')} AS title FROM d",
)
ORACLES["title_fallback"] = query(
    lines_of("documents", "text", "doc_id")
    + ",\nf AS (SELECT doc_id, arg_min(line, pos) AS line FROM l WHERE pos >= 2 AND line <> '' GROUP BY doc_id)",
    """SELECT d.doc_id, coalesce(substr(f.line, 1, 200), '(sin titulo)') AS title
       FROM documents d LEFT JOIN f USING (doc_id)""",
)


def abstract(text: str) -> str:
    pattern = (
        rf"(?is)abstract[{SPACE}:.]+(.+?)"
        rf"(?:\n[{SPACE}]*\n|introduction|keywords|index terms|1\.[{SPACE}]|i\.[{SPACE}])"
    )
    found = f"regexp_extract({text}, '{pattern}', 1)"
    return f"substr({strip(f'''regexp_replace({found}, '[{SPACE}]+', ' ', 'g')''')}, 1, 2000)"


def year(text: str) -> str:
    runs = f"regexp_extract_all(substr({text}, 1, 3000), '[{WORD}]+')"
    years = f"list_filter({runs}, lambda r: regexp_full_match(r, '199[0-9]|20[0-2][0-9]|203[0-9]'))"
    return f"coalesce(CAST(list_max({years}) AS INTEGER), 2024)"


ORACLES["extract_abstract"] = query(PAGES, f"SELECT paper_id, {abstract('full_text')} AS abstract FROM pages_text")
ORACLES["extract_year"] = query(PAGES, f"SELECT paper_id, {year('full_text')} AS year FROM pages_text")
_COMPOSED = strip("title || ' ' || coalesce(abstract, '')")
ORACLES["compose_text"] = query(PAPERS, f"SELECT paper_id, {_COMPOSED} AS text FROM papers")
METADATA = TITLES + f""",
meta AS (SELECT doc_id, paper_id, title, {abstract('full_text')} AS abstract, {year('full_text')} AS year FROM picked)"""
ORACLES["extract_metadata"] = query(
    METADATA, f"SELECT paper_id, title, abstract, year, {_COMPOSED} AS text FROM meta"
)

# Valid uploads have no metadata title and are one page long.
_IMPORT = (
    METADATA.replace("CASE WHEN doc_id % 10 = 0 THEN 'A Metadata Title For Document ' || doc_id END", "NULL::VARCHAR")
    .replace("FROM documents)", "FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0)")
    .replace("|| 'Introduction' || chr(10)", "|| 'Introduction' || chr(10) || chr(10)")
)
_INGESTED = _IMPORT + f""",
numbered AS (
  SELECT *, {_COMPOSED} AS text, 'inbox/' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.PDF' ELSE '.pdf' END AS source_path
  FROM meta),
ingested AS (
  SELECT *, 'PAPER_' || (2000 + row_number() OVER (ORDER BY source_path)) AS new_id,
         {sql.keyword_score("lower(CASE WHEN text = '' THEN title ELSE text END)", TOPIC_A['axes'])} AS keyword
  FROM numbered)"""


def _imported(topic: str) -> str:
    """CTEs ending in ``arrived``: imported files with their scores by the vocabulary of the documents."""
    features = f"""said AS (SELECT *, CASE WHEN text = '' THEN title ELSE text END AS said FROM ingested),
{sql.query_weights(topic)},
{sql.grams("ig", "said", "said", "new_id")},
itf AS (SELECT new_id, term, count(*) AS tf FROM ig GROUP BY new_id, term),
idots AS (SELECT itf.new_id, sum(itf.tf * v.idf * coalesce(qw.w, 0)) AS dot,
                 sqrt(sum((itf.tf * v.idf) * (itf.tf * v.idf))) AS dn
          FROM itf JOIN vocab v USING (term) LEFT JOIN qw USING (term) GROUP BY itf.new_id),
{hashed("ih", "said", "new_id", "said")},
iq AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = {sql.QUERY_VECTOR_ID[topic]}),
isim AS (SELECT new_id, (sum(x * q[i + 1]) / (sqrt(sum(x * x)) * sqrt(any_value(list_inner_product(q, q)))) + 1.0) / 2.0 AS sb
         FROM ih, iq GROUP BY new_id),
featured AS (SELECT said.* EXCLUDE (keyword), keyword AS kw, coalesce(dot / dn / qn, 0.0) AS tf, sb
             FROM said JOIN isim USING (new_id) LEFT JOIN idots USING (new_id) CROSS JOIN qn)"""
    return f"""{_INGESTED},
{sql.VOCABULARY},
{features},
{sql.mixed("arrived", "featured", topic, "year")}"""


ORACLES["import_batch"] = query(
    _imported("a"),
    f"""SELECT new_id AS paper_id, split_part(source_path, '/', 2) AS filename, title, year, abstract,
              NULL::VARCHAR AS parse_error, {BREAKDOWN}, score_final, decision, tier,
              'uploads/' || new_id || '.pdf' AS minio_key, 'tiers/' || tier || '/' || new_id || '.pdf' AS tier_minio_key,
              md5(body) AS stored_digest, md5(body) AS placed_digest
       FROM arrived JOIN (SELECT doc_id, substr(full_text, 1, length(full_text) - 1) AS body FROM pages_text) USING (doc_id)""",
)
# the numbers go on where the corpus ends
_ARRIVED = _imported("a").replace("(2000 + row_number()", "((SELECT max(doc_id) + 1 FROM documents) + row_number()")
# --- Keyword features --------------------------------------------------------

ORACLES["keyword_hits"] = query(
    PAPERS,
    " UNION ALL ".join(
        f"SELECT paper_id, {quote(axis)} AS axis, {quote(k)} AS keyword, {sql.keyword_hit('lower(text)', k)} AS hit FROM papers"
        for axis, ks in {**TOPIC_A["axes"], **TOPIC_B["axes"]}.items()
        for k in ks
    ),
)
ORACLES["keyword_score_single"] = query(
    PAPERS, f"SELECT paper_id, {round4(sql.keyword_score('lower(text)', TOPIC_B['axes']))} AS keyword FROM papers"
)
ORACLES["keyword_score_axes"] = query(
    PAPERS, f"SELECT paper_id, {sql.keyword_score('lower(text)', TOPIC_A['axes'])} AS keyword FROM papers"
)
ORACLES["normalize_keywords"] = query(
    rf"""raw_k AS (SELECT doc_id, [lang] || string_split_regex(text, '[\n,;]+') AS ks FROM documents),
num_k AS (SELECT doc_id, unnest(ks) AS k, generate_subscripts(ks, 1) AS pos FROM raw_k),
clean AS (SELECT doc_id, pos, CASE WHEN pos = 1 THEN k ELSE {strip('k')} END AS k FROM num_k),
firsts AS (SELECT * FROM clean WHERE k <> ''
           QUALIFY row_number() OVER (PARTITION BY doc_id, lower(k) ORDER BY pos) = 1)""",
    """SELECT doc_id, CAST(count(*) AS INTEGER) AS n, string_agg(k, '|' ORDER BY pos) AS keywords
       FROM firsts GROUP BY doc_id""",
)

TOPIC_ROWS = """words AS (SELECT *, string_split(text, ' ') AS w FROM documents),
topics AS (
  SELECT doc_id, 'topic ' || lang AS topic_name, text AS query_text, lang,
         list_filter(w, lambda x, i: i % 2 = 1) AS first_kw, list_filter(w, lambda x, i: i % 3 = 0) AS lang_kw,
         list_filter(w, lambda x, i: i % 2 = 0) AS last_kw,
         CASE WHEN doc_id % 3 <> 0 THEN 0.5::DOUBLE END AS w_keyword,
         CASE WHEN doc_id % 4 <> 0 THEN 0.25::DOUBLE END AS w_tfidf,
         CASE WHEN doc_id % 5 <> 0 THEN 0.125::DOUBLE END AS w_sbert,
         CASE WHEN doc_id % 3 <> 1 THEN 0.75::DOUBLE END AS t_gold_muy,
         CASE WHEN doc_id % 4 <> 1 THEN 0.25::DOUBLE END AS t_revisar
  FROM words)"""
ORACLES["flatten_axes"] = query(
    TOPIC_ROWS
    + """,
num_a AS (SELECT doc_id, unnest(first_kw || lang_kw || last_kw) AS k,
                 generate_subscripts(first_kw || lang_kw || last_kw, 1) AS pos FROM topics),
firsts AS (SELECT doc_id, k, min(pos) AS pos FROM num_a GROUP BY doc_id, k)""",
    """SELECT doc_id, CAST(count(*) AS INTEGER) AS n, string_agg(k, '|' ORDER BY pos) AS keywords
       FROM firsts GROUP BY doc_id""",
)

# --- TF-IDF ------------------------------------------------------------------


def _digest(lists: str) -> str:
    return f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n, md5(array_to_string(t, ' ')) AS digest FROM ({lists})"


ORACLES["tokenize"] = _digest(
    f"SELECT doc_id, regexp_extract_all(lower(text), '[{WORD}]{{2,}}') AS t FROM documents"
)
ORACLES["remove_stopwords"] = query(sql.grams("g", "documents"), _digest("SELECT doc_id, tok AS t FROM g_tok"))
ORACLES["ngrams_1_2"] = query(
    sql.grams("g", "documents"),
    _digest(
        "SELECT doc_id, tok || list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1]) AS t FROM g_tok"
    ),
)
ORACLES["term_frequency"] = query(sql.TERM_FREQUENCY, "SELECT doc_id, term, tf FROM tf")
ORACLES["document_frequency"] = query(sql.VOCABULARY, "SELECT term, df, cf FROM freq")
ORACLES["prune_max_df"] = query(
    sql.VOCABULARY, "SELECT term, df, cf FROM freq, n WHERE df <= 0.1::DOUBLE * n"
)
ORACLES["limit_vocabulary"] = query(sql.VOCABULARY, "SELECT term, df, cf FROM vocab")
_ROUND6 = "floor(({}) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE"
ORACLES["idf_weights"] = query(sql.VOCABULARY, f"SELECT term, df, {_ROUND6.format('idf')} AS idf FROM vocab")
ORACLES["tfidf_vectors"] = query(
    sql.VOCABULARY
    + """,
raw_w AS (SELECT doc_id, term, tf.tf * v.idf AS w FROM tf JOIN vocab v USING (term))""",
    f"SELECT doc_id, term, {_ROUND6.format('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))')} AS weight FROM raw_w",
)
ORACLES["tfidf_score"] = query(sql.tfidf("a"), f"SELECT doc_id, {round4('tfidf')} AS tfidf FROM tfidf")

_OLD = (
    sql.tfidf("a")
    .replace("WHERE " + sql.NON_BLANK, f"WHERE {sql.NON_BLANK} AND doc_id % 2 = 0")
    .replace("FROM tf GROUP BY term)", "FROM tf WHERE doc_id % 2 = 0 GROUP BY term)")
)
_STREAMED = _INGESTED.replace("ORDER BY source_path", "ORDER BY doc_id % 2, source_path") + f""",
told AS (SELECT *, CASE WHEN text = '' THEN title ELSE text END AS said FROM ingested),
scores AS (WITH documents AS (SELECT doc_id, said AS text FROM told WHERE length(said) % 7 <> 0), {_OLD} SELECT * FROM tfidf)"""
_STREAM_SCORES = _STREAMED + f""",
{hashed("ih", "told", "new_id", "said")},
iq AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = {sql.QUERY_VECTOR_ID['a']}),
isim AS (SELECT new_id, (sum(x * q[i + 1]) / (sqrt(sum(x * x)) * sqrt(any_value(list_inner_product(q, q)))) + 1.0) / 2.0 AS sb
         FROM ih, iq GROUP BY new_id),
featured AS (SELECT told.* EXCLUDE (keyword), keyword AS kw, CASE WHEN doc_id % 2 = 0 THEN 0.5 ELSE tfidf END AS tf, sb
             FROM told JOIN scores USING (doc_id) JOIN isim USING (new_id) WHERE length(said) % 7 <> 0),
{sql.mixed("streamed", "featured", "a", "year")}"""
ORACLES["ingest_job_log"] = query(
    _STREAMED,
    """SELECT 'ingest-' || new_id AS job_id, new_id AS paper_id, split_part(source_path, '/', 2) AS filename,
              CAST(e.id AS BIGINT) AS event_id, e.status, e.stage,
              CASE WHEN e.status = 'failed' THEN 'ValueError: cannot embed' END AS error
       FROM told, (VALUES (0, 'queued', 'queued', NULL), (1, 'running', 'extracting_metadata', NULL),
                          (2, 'running', 'embedding_sbert', NULL), (3, 'running', 'scoring', FALSE),
                          (4, 'running', 'ollama_justify', FALSE), (5, 'completed', 'completed', FALSE),
                          (3, 'failed', 'embedding_sbert', TRUE)) e(id, status, stage, fails)
       WHERE e.fails IS NULL OR e.fails = (length(said) % 7 = 0)""",
)
ORACLES["incremental_vs_refit"] = query(
    f"old_scores AS (WITH {_OLD} SELECT * FROM tfidf),\nnew_scores AS (WITH {sql.tfidf('a')} SELECT * FROM tfidf)",
    f"""SELECT doc_id, {round4('o.tfidf')} AS incremental, {round4('n.tfidf')} AS refit
        FROM old_scores o JOIN new_scores n USING (doc_id) WHERE doc_id % 2 = 1""",
)

# --- Embedding features ------------------------------------------------------


def _checksum(value: str) -> str:
    return f"floor(({value}) * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE"


ORACLES["embed_documents"] = query(
    hashed("h", "documents", "doc_id", "text"),
    f"SELECT doc_id, 64 AS dims, {_checksum('sum(x * (i + 1))')} AS checksum FROM h GROUP BY doc_id",
)
ORACLES["vector_score"] = query(sql.vectors("a"), f"SELECT doc_id AS vec_id, {round4('sbert')} AS sbert FROM sim")
_STORED_SUM = (
    "SELECT vec_id AS doc_id, sum(CAST(x AS DOUBLE) * i) AS total FROM "
    "(SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY vec_id"
)
_FRESH_SUM = "SELECT doc_id, sum(x * (i + 1)) AS total FROM h GROUP BY doc_id"
ORACLES["backfill_embeddings"] = query(
    hashed("h", "documents", "doc_id", "text") + f",\nst AS ({_STORED_SUM}),\nfr AS ({_FRESH_SUM})",
    f"""SELECT 'PAPER_' || (doc_id + 1) AS paper_id,
               CAST(CASE WHEN st.total IS NULL THEN 64 ELSE (SELECT max(len(embedding)) FROM embeddings) END AS INTEGER) AS dims,
               {_checksum('coalesce(st.total, fr.total)')} AS checksum
        FROM documents LEFT JOIN st USING (doc_id) LEFT JOIN fr USING (doc_id)""",
)
ORACLES["backfill_from_store"] = ORACLES["backfill_embeddings"]
_REVISED = TOPIC_ROWS + """,
revised AS (SELECT doc_id, 'revised ' || query_text AS q FROM topics WHERE doc_id % 3 <> 2 AND doc_id % 5 = 0)"""
ORACLES["refresh_query_vector"] = query(
    _REVISED + ",\n" + hashed("h", "revised", "doc_id", "q") + f",\nfr AS ({_FRESH_SUM})",
    f"""SELECT doc_id, coalesce(q, query_text) AS query_text,
               coalesce({_checksum('fr.total')}, CASE WHEN doc_id % 2 = 0 THEN 0.5 + 2.0 * (doc_id % 8) END) AS checksum
        FROM topics LEFT JOIN revised USING (doc_id) LEFT JOIN fr USING (doc_id)""",
)

# --- Scoring and classification ----------------------------------------------

ORACLES["hybrid_score"] = query(SCORED_A, f"SELECT paper_id, {BREAKDOWN} FROM s")
_CUT = {**DEFAULT_THRESHOLDS, **TOPIC_A["thresholds"]}
_LOW, _HIGH = TOPIC_B["year_range"]
_DECIDE = (
    f"CASE WHEN year < {_LOW} OR year > {_HIGH} THEN 0 "
    + " ".join(
        f"WHEN weighted >= {float(_CUT[k])!r}::DOUBLE THEN {n}" for n, k in zip((5, 4, 3, 2), DEFAULT_THRESHOLDS)
    )
    + " ELSE 1 END"
)
ORACLES["decide"] = query(
    SCORED_A + f",\no AS (SELECT paper_id, {_DECIDE} AS score_final FROM s)",
    f"SELECT paper_id, score_final, {sql.label('score_final')} AS decision FROM o",
)
ORACLES["effective_thresholds"] = query(
    TOPIC_ROWS,
    """SELECT doc_id, coalesce(t_gold_muy, 0.65::DOUBLE) AS gold_muy, 0.50::DOUBLE AS gold_claro,
              coalesce(t_revisar, 0.35::DOUBLE) AS revisar, 0.20::DOUBLE AS no_prioritario FROM topics""",
)
ORACLES["score_to_tier"] = query(SCORED_B, "SELECT paper_id, tier FROM s")
ORACLES["decision_to_tier"] = query(SCORED_B, "SELECT paper_id, tier FROM s")
ORACLES["breakdown_unpivot"] = query(
    SCORED_A,
    " UNION ALL ".join(
        f"SELECT paper_id, '{n}' AS signal, {n} AS value, "
        f"floor({n} * 100.0::DOUBLE * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS percent FROM s"
        for n in ("keyword", "tfidf", "sbert", "weighted")
    ),
)

# --- Aggregations ------------------------------------------------------------

ORACLES["corpus_health"] = query(
    LATEST + ",\n" + sql.VOCABULARY,
    f"""SELECT (SELECT count(*) FROM documents) AS papers,
               (SELECT n FROM n) >= 2 AND (SELECT count(*) FROM vocab) > 0 AS tfidf_fitted,
               (SELECT count(*) FROM latest WHERE status IS DISTINCT FROM 'completed') AS jobs_in_flight""",
)
_TIERS = ("gold", "silver", "bronze", "out_of_range")
ORACLES["tier_counts"] = query(
    SCORED_A,
    "SELECT " + ", ".join(f"count(*) FILTER (WHERE tier = '{t}') AS {t}" for t in _TIERS) + ", count(*) AS total FROM s",
)
ORACLES["tier_share"] = query(
    SCORED_A + ",\nt AS (SELECT count(*) AS total FROM s)",
    """SELECT total, tier, n, CASE WHEN total > 0
              THEN floor(CAST(n AS DOUBLE) / total * 100.0::DOUBLE * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE
              ELSE 0.0::DOUBLE END AS percent
       FROM t, (SELECT c.tier, count(s.tier) AS n FROM (VALUES ('gold'), ('silver'), ('bronze'), ('out_of_range')) c(tier)
                LEFT JOIN s USING (tier) GROUP BY c.tier)""",
)
ORACLES["score_histogram"] = query(
    SCORED_A + ",\nt AS (SELECT count(*) AS total FROM s)",
    """SELECT score_final, n, total,
              floor(CAST(n AS DOUBLE) / total * 100.0::DOUBLE * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS percent
       FROM (SELECT score_final, count(*) AS n FROM s GROUP BY score_final), t""",
)
ORACLES["max_id_suffix"] = (
    "SELECT coalesce(max(doc_id + 1) FILTER (WHERE doc_id % 3 <> 0), 2000) AS max_n FROM documents"
)
ORACLES["weight_sum"] = query(
    TOPIC_ROWS,
    """SELECT doc_id, coalesce(w_keyword, 0.0::DOUBLE) + coalesce(w_tfidf, 0.0::DOUBLE) + coalesce(w_sbert, 0.0::DOUBLE)
              AS weight_sum FROM topics""",
)
ORACLES["run_cost_estimate"] = query(
    SCORED_A
    + """,
t AS (SELECT count(*) AS papers, count(*) FILTER (WHERE score_final >= 4) AS gold FROM s),
o AS (SELECT * FROM t, (VALUES ('none'), ('gold_only'), ('all')) j(justify), (VALUES (FALSE), (TRUE)) r(reextract)),
e AS (SELECT *, floor((greatest(2.0::DOUBLE, papers * 0.01::DOUBLE)
                       + CASE WHEN reextract THEN papers * 0.3::DOUBLE ELSE 0.0::DOUBLE END
                       + CASE justify WHEN 'gold_only' THEN gold * 15.0::DOUBLE WHEN 'all' THEN papers * 15.0::DOUBLE
                                      ELSE 0.0::DOUBLE END) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS seconds
      FROM o)""",
    """SELECT papers, gold, justify, reextract, seconds,
              CASE WHEN seconds > 3600 THEN 'danger' WHEN seconds > 600 THEN 'warn' ELSE 'info' END AS severity FROM e""",
)

# --- Sort, limit, window -----------------------------------------------------

ORACLES["ranking_top_n"] = query(
    SCORED_A, f"SELECT {SUMMARY}, weighted FROM s ORDER BY weighted DESC NULLS LAST, paper_id LIMIT 50"
)
ORACLES["ranking_position"] = query(
    SCORED_A,
    """SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY weighted DESC NULLS LAST, paper_id) AS INTEGER) AS position,
                             paper_id FROM s) WHERE position <= 200""",
)
ORACLES["recent_jobs"] = query(
    LATEST,
    f"""SELECT job_id, status, {stamp('created_at')} AS created_at FROM latest
        ORDER BY latest.created_at DESC, job_id LIMIT 50""",
)
ORACLES["job_latest_state"] = query(
    LATEST,
    f"""SELECT job_id, stage, status, total, processed, {stamp('created_at')} AS created_at,
               {stamp('updated_at')} AS updated_at FROM latest""",
)
ORACLES["job_progress"] = query(
    sql.JOB_LOG,
    """SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN CAST(processed AS DOUBLE) / total END AS fraction,
              CASE WHEN event_id % 3 = 0 THEN CAST(processed AS BIGINT) ELSE -1 END AS stage_done,
              CASE WHEN event_id % 3 = 0 THEN CAST(100 AS BIGINT) ELSE -1 END AS stage_total FROM log""",
)

# --- Merge and set operators -------------------------------------------------

ORACLES["update_by_key"] = query(
    PAPERS
    + """,
last_u AS (SELECT 'PAPER_' || (user_id * 3 + 1) AS paper_id,
                  CASE WHEN event_type <> 'error' THEN event_type END AS title,
                  CAST(1990 + user_id % 30 AS INTEGER) AS year, TRUE AS given
           FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)""",
    """SELECT p.paper_id, CASE WHEN u.given THEN u.title ELSE p.title END AS title,
              CASE WHEN u.given THEN u.year ELSE p.year END AS year
       FROM papers p LEFT JOIN last_u u USING (paper_id)""",
)

_UPSERT = SEEDS + f""",
stored AS (SELECT doc_id, paper_id, title, CASE WHEN doc_id % 8 <> 0 THEN abstract END AS abstract,
                  CASE WHEN doc_id % 12 <> 0 THEN text ELSE '' END AS text, year, TRUE AS is_old
           FROM papers WHERE doc_id % 16 <> 0),
sd AS (SELECT paper_id, title, abstract, year, {strip("title || ' ' || abstract")} AS text, TRUE AS is_new FROM seeds),
merged AS (
  SELECT paper_id, o.doc_id,
         CASE WHEN o.is_old IS NULL THEN 'inserted'
              WHEN n.is_new AND (coalesce(o.abstract, '') = '' OR coalesce(o.text, '') = '') THEN 'completed'
              ELSE 'untouched' END AS touched,
         o.title AS ot, o.abstract AS oa, o.text AS ox, o.year AS oy, n.title AS nt, n.abstract AS na, n.text AS nx, n.year AS ny
  FROM stored o FULL OUTER JOIN sd n USING (paper_id)),
up AS (
  SELECT paper_id, doc_id, touched, CASE touched WHEN 'inserted' THEN nt ELSE ot END AS title,
         CASE touched WHEN 'untouched' THEN oa ELSE na END AS abstract,
         CASE touched WHEN 'untouched' THEN ox ELSE nx END AS text,
         CASE touched WHEN 'inserted' THEN ny ELSE oy END AS year
  FROM merged),
renew AS (SELECT paper_id, text FROM up WHERE touched <> 'untouched'),
{hashed('h', 'renew', 'paper_id', 'text')},
fr AS (SELECT paper_id, sum(x * (i + 1)) AS total FROM h GROUP BY paper_id),
st AS ({_STORED_SUM})"""
ORACLES["upsert_seeds"] = query(
    _UPSERT,
    f"""SELECT paper_id, touched, title, abstract, md5(text) AS text_digest, year,
               {_checksum("CASE WHEN touched = 'untouched' THEN st.total ELSE fr.total END")} AS checksum
        FROM up LEFT JOIN fr USING (paper_id) LEFT JOIN st ON st.doc_id = up.doc_id""",
)
ORACLES["rescore_all"] = query(SCORED_B, f"SELECT {SUMMARY}, {BREAKDOWN}, tier, minio_key FROM s")

_REEXTRACT = METADATA.replace(
    "CASE WHEN doc_id % 10 = 0 THEN 'A Metadata Title For Document ' || doc_id END", "NULL::VARCHAR"
).replace("|| 'Introduction' || chr(10)", "|| 'Introduction' || chr(10) || chr(10)")
ORACLES["reextract"] = query(
    PAPERS + ",\n" + _REEXTRACT + f""",
found AS (SELECT doc_id, title, abstract, year, {_COMPOSED} AS text FROM meta WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0),
fresh AS (SELECT *, TRUE AS ok FROM found WHERE length(text) % 7 <> 0),
{hashed("h", "fresh", "doc_id", "text")},
st AS ({_STORED_SUM}),
fr AS ({_FRESH_SUM})""",
    f"""SELECT p.paper_id, CASE WHEN f.ok THEN f.title ELSE p.title END AS title,
              CASE WHEN f.ok THEN f.abstract ELSE p.abstract END AS abstract,
              CASE WHEN f.ok THEN f.year ELSE p.year END AS year,
              md5(CASE WHEN f.ok THEN f.text ELSE p.text END) AS text_digest,
              {_checksum("CASE WHEN f.ok THEN fr.total ELSE st.total END")} AS checksum,
              CASE WHEN length(found.text) % 7 = 0 THEN 'ValueError: cannot embed' END AS extract_error
       FROM papers p LEFT JOIN fresh f USING (doc_id) LEFT JOIN fr USING (doc_id) LEFT JOIN st USING (doc_id)
       LEFT JOIN found USING (doc_id)""",
)
_MOVES = TWO + """,
moves AS (
  SELECT s.paper_id, split_part(s.tier_minio_key, '/', 2) AS old_tier, b.tier AS new_tier, s.tier_minio_key AS old_key,
         'tiers/' || b.tier || '/' || s.paper_id || '.pdf' AS new_key
  FROM s JOIN b USING (paper_id) WHERE s.minio_key IS NOT NULL)"""
ORACLES["tier_transitions"] = query(_MOVES, "SELECT * FROM moves WHERE new_key IS DISTINCT FROM old_key")
ORACLES["transition_matrix"] = query(
    _MOVES,
    """SELECT old_tier, new_tier, count(*) AS n FROM moves WHERE new_key IS DISTINCT FROM old_key
       GROUP BY old_tier, new_tier""",
)
ORACLES["assign_ids"] = (
    "SELECT doc_id, lang, 'PAPER_' || ((SELECT max(doc_id) + 1 FROM documents) + row_number() OVER (ORDER BY doc_id)) "
    "AS paper_id FROM documents"
)
ORACLES["sync_counter"] = (
    "SELECT greatest(count(*) FILTER (WHERE 2010 + doc_id % 20 < 2020), coalesce(max(doc_id + 1), 2000)) AS seq "
    "FROM documents"
)
ORACLES["patch_topic"] = query(
    TOPIC_ROWS,
    """SELECT doc_id,
              CASE WHEN doc_id % 3 <> 2 AND doc_id % 2 = 0 THEN 'new ' || topic_name ELSE topic_name END AS topic_name,
              CASE WHEN doc_id % 3 <> 2 AND doc_id % 5 = 0 THEN 'revised ' || query_text ELSE query_text END AS query_text,
              doc_id % 3 <> 2 AND (doc_id % 2 = 0 OR doc_id % 5 = 0) AS patched
       FROM topics""",
)
_JOIN3 = "array_to_string({}, ',')"
ORACLES["rename_axis"] = query(
    TOPIC_ROWS
    + f""",
a AS (SELECT doc_id, lang, topic_name, {_JOIN3.format('first_kw')} AS f, {_JOIN3.format('lang_kw')} AS g, {_JOIN3.format('last_kw')} AS h
      FROM topics)""",
    """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'first_axis' WHEN 1 THEN 'last_one' ELSE 'first' END || '=' || f
                      || ';' || lang || '=' || g || ';last one=' || h AS axes, 3 AS n_rest FROM a""",
)
ORACLES["remove_axis"] = "SELECT doc_id, lang || ',last one' AS kept, 'keywords' AS fallback FROM documents"

# --- Text generation ---------------------------------------------------------


def _two(col: str) -> str:
    return f"printf('%.2f', floor(coalesce({col}, 0) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE)"


_PROMPT = (
    f"'Topic: TOPIC_NAME' || {NL} || 'Title: ' || coalesce(title, '') || {NL} || 'Abstract: ' || "
    f"substr(coalesce(nullif(abstract, ''), '(no abstract available)'), 1, 1200) || {NL} || 'Scores: keyword ' || "
    f"{_two('keyword')} || ', tfidf ' || {_two('tfidf')} || ', embedding ' || {_two('sbert')} || ', weighted ' || "
    f"{_two('weighted')} || {NL} || 'Decision: ' || decision || ' (score ' || score_final || ' of 5)' || {NL} || "
    "'Why does this decision fit the paper and the topic?'"
)


def prompt(topic: str) -> str:
    return _PROMPT.replace("TOPIC_NAME", TOPICS[topic]["topic_name"])


def justification(topic: str) -> str:
    told = f"'Read 2 messages of ' || ({len(SYSTEM_PROMPT)} + length({prompt(topic)})) || ' characters, last: "
    return strip(told + f"Topic: {TOPICS[topic]['topic_name']}'")


ORACLES["build_prompt"] = query(SCORED_A, f"SELECT paper_id, {prompt('a')} AS prompt FROM s")
ORACLES["justify_batch"] = query(
    SCORED_A,
    f"SELECT paper_id, CASE WHEN score_final >= 4 THEN {justification('a')} END AS justification FROM s",
)
ORACLES["stream_ingest"] = query(
    _STREAM_SCORES,
    f"""SELECT new_id AS paper_id, source_path, title, year, {BREAKDOWN}, score_final, decision, tier,
               {justification('a')} AS justification
        FROM streamed""",
)
ORACLES["import_justified"] = query(
    _ARRIVED,
    f"""SELECT new_id AS paper_id, split_part(source_path, '/', 2) AS filename, {BREAKDOWN}, score_final,
               {justification('a')} AS justification,
               (SELECT n FROM n) + (SELECT count(*) FROM arrived) AS corpus_texts
        FROM arrived""",
)
ORACLES["import_limited"] = query(
    _ARRIVED,
    """SELECT new_id AS paper_id, split_part(source_path, '/', 2) AS filename, tier, NULL::VARCHAR AS justification
       FROM arrived ORDER BY source_path LIMIT 50""",
)
# a paper whose source file is not there cannot be moved and keeps its place
_MOVED = "CASE WHEN s.doc_id % 3 <> 0 AND s.minio_key IS NOT NULL THEN 'tiers/' || b.tier || '/' || s.paper_id || '.pdf' ELSE s.tier_minio_key END"
ORACLES["rescore_job"] = query(
    TWO + f""",
told AS (SELECT b.*, {_MOVED} AS moved_key FROM s JOIN b USING (paper_id)),
spoken AS (SELECT *, {justification('b')} AS said FROM told)""",
    f"""SELECT mode, paper_id, {BREAKDOWN}, score_final, moved_key AS tier_minio_key,
               split_part(moved_key, '/', 2) AS placed_in,
               CASE WHEN mode = 'all' OR (mode = 'gold_only' AND score_final >= 4) THEN said END AS justification
        FROM spoken, (VALUES ('none'), ('gold_only'), ('all')) m(mode)""",
)
_EXTRACTED = f"""{PAPERS},
{_REEXTRACT},
found AS (SELECT doc_id, title, abstract, year, {_COMPOSED} AS text FROM meta WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0),
fresh AS (
  SELECT p.doc_id, p.paper_id, f.doc_id IS NOT NULL AS ok,
         CASE WHEN f.doc_id IS NULL THEN p.title ELSE f.title END AS title,
         CASE WHEN f.doc_id IS NULL THEN p.year ELSE f.year END AS year,
         CASE WHEN f.doc_id IS NULL THEN p.text ELSE f.text END AS text
  FROM papers p LEFT JOIN found f USING (doc_id)),
said AS (SELECT *, CASE WHEN coalesce(text, '') = '' THEN title ELSE text END AS said FROM fresh),
renewed AS (SELECT doc_id, said FROM said WHERE ok OR doc_id NOT IN (SELECT vec_id FROM embeddings)),
{hashed("h", "renewed", "doc_id", "said")},
fr AS ({_FRESH_SUM}),
st AS ({_STORED_SUM}),
{sql.stored_vectors("b")},
fresh_sim AS (SELECT doc_id, (sum(x * q[i + 1]) / (sqrt(sum(x * x)) * sqrt(any_value(list_inner_product(q, q)))) + 1.0) / 2.0 AS sbert
              FROM h, qv GROUP BY doc_id),
tf_scores AS (WITH documents AS (SELECT doc_id, said AS text FROM said), {sql.tfidf("b")} SELECT doc_id, tfidf FROM tfidf),
featured AS (
  SELECT said.*, {sql.keyword_score("lower(said)", TOPIC_B["axes"])} AS kw, t.tfidf AS tf, coalesce(n.sbert, o.sbert) AS sb
  FROM said JOIN tf_scores t USING (doc_id) LEFT JOIN fresh_sim n USING (doc_id) LEFT JOIN stored_sim o USING (doc_id)),
{sql.mixed("rescored", "featured", "b", "year")}"""
ORACLES["rescore_job_reextract"] = query(
    _EXTRACTED,
    f"""SELECT paper_id, title, year, md5(text) AS text_digest, {_checksum("coalesce(fr.total, st.total)")} AS checksum,
               {BREAKDOWN}, score_final
        FROM rescored LEFT JOIN fr USING (doc_id) LEFT JOIN st USING (doc_id)""",
)
ORACLES["generation_ms"] = """
SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(floor(value * 10000000.0::DOUBLE) AS BIGINT) // 1000000 ELSE 0 END AS ms
FROM events"""
ORACLES["assemble_conversations"] = """
SELECT conv_id, CAST(turn // 256 AS BIGINT) AS part, count(*) AS n_messages,
       count(*) FILTER (WHERE coalesce(role, '') NOT IN ('system', 'user', 'assistant')) AS bad_roles,
       string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript
FROM conversations GROUP BY conv_id, turn // 256"""
ORACLES["answer_conversations"] = query(
    f"""c AS (SELECT conv_id, count(*) AS n, sum(length(text)) AS n_chars, arg_max(text, turn) AS last_text
               FROM conversations GROUP BY conv_id),
r AS (SELECT *, {strip(f"'Read ' || n || ' messages of ' || n_chars || ' characters, last: ' || substr(split_part(last_text, {NL}, 1), 1, 60)")} AS message
      FROM c)""",
    """SELECT conv_id, 'template' AS model, message, CAST(n_chars AS BIGINT) // 4 AS total_duration_ms,
              CAST(len(regexp_extract_all(message, '[^\\s]+')) AS BIGINT) AS eval_count, NULL::VARCHAR AS error FROM r""",
)

# --- Job log and streams -----------------------------------------------------

_ORDERED = sql.JOB_LOG + """,
seq AS (SELECT *, lag(stage) OVER w AS before,
               coalesce(bool_or(status IN ('completed', 'failed'))
                 OVER (PARTITION BY job_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS was_final
        FROM log WINDOW w AS (PARTITION BY job_id ORDER BY ts, event_id)),
open_rows AS (SELECT * FROM seq WHERE NOT was_final)"""
ORACLES["job_changes"] = query(
    _ORDERED,
    f"""SELECT job_id, event_id, {stamp('ts')} AS ts, stage, status, 'job.progress' AS notice FROM open_rows
        WHERE stage IS DISTINCT FROM before
        UNION ALL
        SELECT job_id, event_id, {stamp('ts')}, stage, status, 'job.' || status FROM open_rows
        WHERE status IN ('completed', 'failed')""",
)
# the stream's log has whole days as time stamps, so many updates share one
ORACLES["job_changes_stream"] = ORACLES["job_changes"].replace(
    "AS job_id, ts, event_id", "AS job_id, date_trunc('day', ts) AS ts, event_id"
)
ORACLES["job_terminal"] = query(
    sql.JOB_LOG,
    f"""SELECT job_id, event_id, {stamp('ts')} AS ts, stage, status, 'job.' || status AS notice FROM log
        WHERE status IN ('completed', 'failed')
        QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY log.ts, event_id) = 1""",
)
ORACLES["heartbeat"] = query(
    sql.JOB_LOG
    + """,
hours AS (SELECT unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM log),
                                        (SELECT date_trunc('hour', max(ts)) FROM log), INTERVAL 1 HOUR)) AS h),
known AS (SELECT h, job_id, arg_max(status, ts) AS status
          FROM hours JOIN log ON ts < h + INTERVAL 1 HOUR GROUP BY h, job_id)""",
    f"""SELECT {stamp('h')} AS window_start, count(*) FILTER (WHERE status IS DISTINCT FROM 'completed') AS jobs_in_flight
        FROM known GROUP BY h""",
)
# windows that end at the watermark, a day before the last update, are final
ORACLES["heartbeat_stream"] = ORACLES["heartbeat"].replace(
    "(SELECT date_trunc('hour', max(ts)) FROM log), INTERVAL 1 HOUR)) AS h)",
    "(SELECT date_trunc('hour', max(ts) - INTERVAL 1 DAY) - INTERVAL 1 HOUR FROM log), INTERVAL 1 HOUR)) AS h)",
)
