"""Shared pieces of the oracle SQL (DuckDB) for the views of ``contract.views``."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from contract.topics import QUERY_VECTOR_ID, TOPICS
from topicsieve.functions.scoring import DECISIONS, DEFAULT_THRESHOLDS, DEFAULT_WEIGHTS
from topicsieve.functions.text import DEFAULT_STOP_WORDS, WORD

_SPACE_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
SPACES = "(" + " || ".join(f"chr({c})" for c in _SPACE_CODES) + ")"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"trim({expr}, {SPACES})"


def round4(expr: str) -> str:
    return f"floor(({expr}) * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE"


PAPERS = """papers AS (
  SELECT doc_id, 'PAPER_' || (doc_id + 1) AS paper_id,
         substr(split_part(text, chr(10), 1), 1, 300) AS title,
         CASE WHEN doc_id % 8 <> 0 THEN text END AS abstract,
         text, CAST(2010 + doc_id % 20 AS INTEGER) AS year,
         CASE WHEN doc_id % 5 <> 0 THEN 'uploads/PAPER_' || (doc_id + 1) || '.pdf' END AS minio_key
  FROM documents)"""

_STOP_LIST = "[" + ", ".join(quote(w) for w in DEFAULT_STOP_WORDS) + "]"


def grams(name: str, source: str, text: str = "text", key: str = "doc_id") -> str:
    """Two CTEs: ``<name>_tok`` (token lists) and ``<name>`` (one row per n-gram)."""
    return f"""{name}_tok AS (
  SELECT {key}, list_filter(regexp_extract_all(lower({text}), '[{WORD}]{{2,}}'),
                            lambda t: NOT list_contains({_STOP_LIST}, t)) AS tok
  FROM {source}),
{name} AS (
  SELECT {key}, unnest(tok) AS term FROM {name}_tok
  UNION ALL
  SELECT {key}, unnest(list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1])) AS term
  FROM {name}_tok)"""


TERM_FREQUENCY = grams("g", "documents") + """,
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY doc_id, term)"""

NON_BLANK = f"{strip('text')} <> ''"
VOCABULARY = (
    TERM_FREQUENCY
    + f""",
n AS (SELECT count(*) AS n FROM documents WHERE {NON_BLANK}),
freq AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY term),
pruned AS (SELECT freq.* FROM freq, n WHERE df <= 0.95::DOUBLE * n),
vocab AS (SELECT term, df, cf, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0 AS idf
          FROM (SELECT * FROM pruned ORDER BY cf DESC, term LIMIT 20000), n)"""
)


def query_weights(topic: str) -> str:
    """CTEs ending in ``qw`` and ``qn``: the query's term weights and their norm, given ``vocab``."""
    query = quote(TOPICS[topic]["query_text"])
    return (
        grams("qg", f"(SELECT {query} AS text, 0 AS doc_id)")
        + """,
qw AS (SELECT v.term, q.tf * v.idf AS w
       FROM (SELECT term, count(*) AS tf FROM qg GROUP BY term) q JOIN vocab v USING (term)),
qn AS (SELECT sqrt(sum(w * w)) AS qn FROM qw)"""
    )


def tfidf(topic: str) -> str:
    """CTE chain ending in ``tfidf`` (doc_id, tfidf) for every document."""
    return (
        VOCABULARY
        + ",\n"
        + query_weights(topic)
        + """,
dots AS (SELECT tf.doc_id, sum(tf.tf * v.idf * coalesce(qw.w, 0)) AS dot,
                sqrt(sum((tf.tf * v.idf) * (tf.tf * v.idf))) AS dn
         FROM tf JOIN vocab v USING (term) LEFT JOIN qw USING (term) GROUP BY tf.doc_id),
tfidf AS (SELECT d.doc_id,
                 CASE WHEN coalesce(d.text, '') = '' THEN 0.5
                      ELSE coalesce(dot / dn / qn, 0.0) END AS tfidf
          FROM documents d LEFT JOIN dots USING (doc_id) CROSS JOIN qn)"""
    )


def keyword_hit(text: str, keyword: str) -> str:
    """``text`` must already be lower-cased."""
    needle = keyword.lower().strip()
    if not needle:
        return "FALSE"
    if " " in needle or "-" in needle:
        return f"contains({text}, {quote(needle)})"
    # the topics here use plain letters only
    return f"regexp_matches({text}, '(^|[^{WORD}]){re.escape(needle)}([^{WORD}]|$)')"


def keyword_score(text: str, axes: Mapping[str, Sequence[str]]) -> str:
    if len(axes) == 1:
        (keywords,) = axes.values()
        hits = [f"CAST({keyword_hit(text, k)} AS INTEGER)" for k in keywords]
    else:
        hits = [
            "CAST((" + " OR ".join(keyword_hit(text, k) for k in ks) + ") AS INTEGER)" for ks in axes.values()
        ]
    return f"CAST(({' + '.join(hits)}) AS DOUBLE) / {len(hits)}"


def hashed(name: str, source: str, key: str, text: str, dims: int = 64) -> str:
    """CTE ``name`` (key, i, x): the components of the hashing projection."""
    slot = f"CAST(('0x' || substr(md5(w), 1, 8)) AS BIGINT) % {dims}"
    sign = "CASE WHEN substr(md5(w), 9, 1) < '8' THEN 1 ELSE -1 END"
    return f"""{name}_w AS (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[{WORD}]{{2,}}')) AS w FROM {source}),
{name}_s AS (SELECT {key}, {slot} AS i, CAST(sum({sign}) AS DOUBLE) AS x FROM {name}_w GROUP BY 1, 2),
{name}_n AS (SELECT {key}, sqrt(sum(x * x)) AS norm FROM {name}_s GROUP BY {key}),
{name} AS (
  SELECT {key}, i, CAST(CAST(x / norm AS FLOAT) AS DOUBLE) AS x FROM {name}_s JOIN {name}_n USING ({key}) WHERE norm > 0
  UNION ALL
  SELECT {key}, 0, 1.0 FROM {source} LEFT JOIN {name}_n USING ({key}) WHERE coalesce(norm, 0) = 0)"""


def stored_vectors(topic: str) -> str:
    """CTEs ``qv`` and ``stored_sim`` (doc_id, sbert) of the vectors that are given."""
    return f"""qv AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = {QUERY_VECTOR_ID[topic]}),
stored_sim AS (SELECT e.vec_id AS doc_id,
               (list_inner_product(CAST(e.embedding AS DOUBLE[]), q)
                / (sqrt(list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))
                   * sqrt(list_inner_product(q, q))) + 1.0) / 2.0 AS sbert
        FROM embeddings e, qv)"""


def vectors(topic: str) -> str:
    """CTEs ending in ``sim`` (doc_id, sbert); documents without a vector get a hashed one."""
    return f"""{stored_vectors(topic)},
gaps AS (SELECT doc_id, text FROM documents WHERE coalesce(text, '') <> ''
         AND doc_id NOT IN (SELECT vec_id FROM embeddings WHERE embedding IS NOT NULL)),
{hashed("bf", "gaps", "doc_id", "text")},
sim AS (SELECT * FROM stored_sim
        UNION ALL
        SELECT doc_id, (sum(x * q[i + 1]) / (sqrt(sum(x * x)) * sqrt(any_value(list_inner_product(q, q)))) + 1.0) / 2.0
        FROM bf, qv GROUP BY doc_id)"""


def decide(weighted: str, year: str, topic: str) -> str:
    low, high = TOPICS[topic]["year_range"]
    cut = {**DEFAULT_THRESHOLDS, **(TOPICS[topic]["thresholds"] or {})}
    rungs = " ".join(
        f"WHEN {weighted} >= {float(cut[name])!r}::DOUBLE THEN {score}"
        for score, name in zip((5, 4, 3, 2), DEFAULT_THRESHOLDS)
    )
    return f"CASE WHEN {year} < {low} OR {year} > {high} THEN 0 {rungs} ELSE 1 END"


def label(score: str) -> str:
    cases = " ".join(f"WHEN {s} THEN {quote(d)}" for s, d in DECISIONS.items())
    return f"CASE {score} {cases} END"


def tier(score: str) -> str:
    return (
        f"CASE WHEN {score} = 0 THEN 'out_of_range' WHEN {score} >= 4 THEN 'gold' "
        f"WHEN {score} = 3 THEN 'silver' ELSE 'bronze' END"
    )


def mixed(name: str, source: str, topic: str, year: str) -> str:
    """CTE ``name``: rows of ``source`` (with kw, tf and sb) with their scores and decisions."""
    w = {k: float(TOPICS[topic]["weights"].get(k, d)) for k, d in DEFAULT_WEIGHTS.items()}
    return f"""{name}_w AS (
  SELECT *, {round4('kw')} AS keyword, {round4('tf')} AS tfidf, {round4('sb')} AS sbert,
         {round4(f'kw * {w["keyword"]}::DOUBLE + tf * {w["tfidf"]}::DOUBLE + sb * {w["sbert"]}::DOUBLE')} AS weighted
  FROM {source}),
{name}_d AS (SELECT *, {decide('weighted', year, topic)} AS score_final FROM {name}_w),
{name} AS (SELECT *, {label('score_final')} AS decision, {tier('score_final')} AS tier FROM {name}_d)"""


def scored_from(name: str, topic: str, text_features: str) -> str:
    """CTE ``name``: papers with features mixed, given a ``tfidf`` CTE."""
    keyword = keyword_score("lower(p.text)", TOPICS[topic]["axes"])
    return f"""{text_features},
{vectors(topic)},
{name}_f AS (
  SELECT p.doc_id, p.paper_id, p.title, p.abstract, p.year, p.minio_key,
         CASE WHEN coalesce(p.text, '') = '' AND coalesce(p.title, '') = '' THEN 0.0 ELSE {keyword} END AS kw,
         t.tfidf AS tf, coalesce(s.sbert, 0.5) AS sb
  FROM papers p JOIN tfidf t USING (doc_id) LEFT JOIN sim s USING (doc_id)),
{mixed(f"{name}_m", f"{name}_f", topic, "year")},
{name} AS (
  SELECT doc_id, paper_id, title, abstract, year, minio_key, keyword, tfidf, sbert, weighted, score_final,
         decision, tier,
         CASE WHEN minio_key IS NOT NULL AND doc_id % 7 <> 0
              THEN 'tiers/' || tier || '/' || paper_id || '.pdf' END AS tier_minio_key
  FROM {name}_m)"""


def scored(topic: str = "a", name: str = "s") -> str:
    return f"{PAPERS},\n{scored_from(name, topic, tfidf(topic))}"


def query(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


JOB_LOG = """log AS (
  SELECT 'job-' || user_id AS job_id, ts, event_id, event_type AS stage,
         CASE event_type WHEN 'view' THEN 'queued' WHEN 'click' THEN 'running' WHEN 'signup' THEN 'running'
                         WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' END AS status,
         100 AS total, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS processed
  FROM events)"""
