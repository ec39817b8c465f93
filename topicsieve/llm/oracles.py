"""DuckDB SQL of the queries that SQL can express."""

ESCAPED = r"regexp_replace(text, '<(\\*(?:turn|/turn|image|audio|document))', '<\\\1', 'g')"

OP1 = rf"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, turn, role, '\### Assistant: </turn> ok'
    FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
), formatted AS (
    SELECT *, '<turn:' || role || '>' || chr(10) || {ESCAPED} || '</turn>' || chr(10) AS piece
    FROM turns
)
SELECT
    conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), ''))
        AS loss_sha256,
    sum(length(piece))::BIGINT AS formatted_chars
FROM formatted
GROUP BY conv_id
"""

OP5 = r"""
WITH digests AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
), groups AS (
    SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM digests JOIN groups USING (text_sha256)
"""

OP7 = r"""
WITH lines AS (
    SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), stripped AS (
    SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS s FROM lines
), keyed AS (
    SELECT doc_id, line, pos,
        translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM stripped
), shared AS (
    SELECT k, min(doc_id) AS first_id FROM keyed WHERE length(k) >= 10
    GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
    SELECT keyed.*, coalesce(doc_id <> first_id, false) AS gone FROM keyed LEFT JOIN shared USING (k)
)
SELECT
    doc_id,
    count(*) AS n_lines,
    count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked
GROUP BY doc_id
"""

COMPONENTS = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) >= 5 THEN list_distinct(
            list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
        ELSE [] END AS s
    FROM words
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= PERCENT * (a.n + b.n - count(*))
), arcs AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reached.a, arcs.b FROM reached JOIN arcs ON reached.b = arcs.a
)
SELECT doc_id, any_value(len(s)) AS n_shingles, min(b) AS component_idKEPT
FROM sets JOIN reached ON sets.doc_id = reached.a
GROUP BY doc_id
"""
OP10 = COMPONENTS.replace("PERCENT", "85").replace("KEPT", ", doc_id = min(b) AS kept")
OP13 = COMPONENTS.replace("PERCENT", "80").replace("KEPT", "")

OP11 = r"""
WITH tokens AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t
    FROM documents
), drawn AS (
    SELECT *, len(t) AS n,
        ('0x' || h[1:8])::BIGINT % (len(t) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(t) + 1) AS c2,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
            WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm'
            ELSE 'psm' END AS form
    FROM tokens
), spans AS (
    SELECT *,
        array_to_string(t[1:least(c1, c2)], '') AS p,
        array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
        array_to_string(t[greatest(c1, c2) + 1:], '') AS s
    FROM drawn
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM spans
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


# crc32 of the identifier's digits: each is taken in, then shifted out bit by bit
CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda crc, x: xor(xor(crc, x) >> 1, 3988292384 * (xor(crc, x) & 1))))"""

OP12 = rf"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
        CASE WHEN {CRC32} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS given
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY lang) AS n
    FROM leaves
), nodes AS (
    SELECT 0 AS lvl, lang, place, leaf AS digest, n FROM placed
    UNION ALL
    SELECT lvl + 1, lang, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (n + 1) // 2
    FROM nodes WHERE n > 1 GROUP BY lvl, lang, place // 2, n
), subroots AS (
    SELECT lang, lvl AS height, digest AS subroot,
        row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n
    FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS lvl, place, subroot AS digest, n FROM subroots
    UNION ALL
    SELECT lvl + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (n + 1) // 2
    FROM tops WHERE n > 1 GROUP BY lvl, place // 2, n
), root AS (
    SELECT digest AS root, lvl AS height FROM tops WHERE n = 1
), below AS (
    -- a step for each level below the group's root: which side the sibling is on, and its digest
    SELECT l.lang, l.place, list(
        CASE WHEN (l.place >> lv.lvl) & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(s.digest, '') ORDER BY lv.lvl
    ) FILTER (WHERE lv.lvl < u.height) AS path
    FROM placed l
    JOIN subroots u ON l.lang IS NOT DISTINCT FROM u.lang
    JOIN (SELECT DISTINCT lvl FROM nodes) lv ON lv.lvl <= u.height
    LEFT JOIN nodes s ON s.lvl = lv.lvl AND s.place = xor(l.place >> lv.lvl, 1) AND s.lang IS NOT DISTINCT FROM l.lang
    GROUP BY l.lang, l.place
), above AS (
    SELECT u.lang, list(
        CASE WHEN (u.place >> lv.lvl) & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(s.digest, '') ORDER BY lv.lvl
    ) FILTER (WHERE lv.lvl < root.height) AS path
    FROM subroots u CROSS JOIN root
    JOIN (SELECT DISTINCT lvl FROM tops) lv ON lv.lvl <= root.height
    LEFT JOIN tops s ON s.lvl = lv.lvl AND s.place = xor(u.place >> lv.lvl, 1)
    GROUP BY u.lang
), proven AS (
    SELECT l.doc_id, l.leaf, l.given, u.subroot, root.root,
        list_concat(coalesce(b.path, []), coalesce(a.path, [])) AS path
    FROM placed l CROSS JOIN root
    JOIN subroots u ON l.lang IS NOT DISTINCT FROM u.lang
    JOIN below b ON l.place = b.place AND l.lang IS NOT DISTINCT FROM b.lang
    JOIN above a ON l.lang IS NOT DISTINCT FROM a.lang
), refolded AS (
    SELECT *, list_reduce(list_prepend(given, path), lambda node, step:
        sha256(CASE WHEN step[1] = 'L' THEN step[2:] || node ELSE node || step[2:] END)) AS folded_root
    FROM proven
)
SELECT doc_id, leaf, subroot, root,
    sha256(array_to_string(list_transform(path, lambda step: step[2:]), '')) AS proof_sha256,
    folded_root, folded_root = root AS verified
FROM refolded
"""

ORACLES = {
    "op1_chat_format": OP1, "op5_exact_dedup": OP5, "op7_line_dedup": OP7, "op10_minhash_near_dedup": OP10,
    "op11_fill_in_middle": OP11, "op12_merkle_manifest": OP12,
    "op13_ngram_join": OP13,
}
