"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from scholar_lake.llm import licences, secrets


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def found(name: str, pattern: str, keep: str = "true", text: str = "text") -> str:
    """A CTE of all matches of a pattern: rid, start and hit. Places come from the lengths of matches and of what lies between."""
    return f"""
{name} AS (SELECT rid, start, hit FROM (
    SELECT rid, i, hit, sum(len(gap) + len(hit)) OVER (PARTITION BY rid ORDER BY i) - len(hit) AS start FROM (
        SELECT rid, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i FROM (
            SELECT rid, regexp_extract_all({text}, {quoted(pattern)}) AS hits, string_split_regex({text}, {quoted(pattern)}) AS gaps
            FROM docs WHERE regexp_matches({text}, {quoted(pattern)})))) WHERE {keep})"""


def entropy_spans(kind: str) -> str:
    """CTEs of the method's spans of one character class, before those inside base spans go."""
    characters, least, needs = secrets.CLASSES[kind]
    fit = " AND ".join(f"regexp_matches(hit, {quoted(n)})" for n in needs)
    return found(f"{kind}_runs", f"[{characters}]{{{secrets.WINDOW},}}", fit, "blanked") + f""",
{kind}_spans AS (
    SELECT rid, min(start + s) AS start, {secrets.KINDS.index(kind)} AS kind, max(start + s + {secrets.WINDOW}) AS stop FROM (
        SELECT rid, start, s, list_aggregate(string_split(substr(hit, s + 1, {secrets.WINDOW}), ''), 'entropy') AS bits FROM (
            SELECT rid, start, hit, unnest(range(0, len(hit) - {secrets.WINDOW} + 1)) AS s FROM {kind}_runs))
    WHERE bits >= {least} - 1e-9 GROUP BY rid, start)"""


def secret_scan() -> str:
    kinds = ", ".join(quoted(k) for k in secrets.KINDS)
    blanked = "coalesce(text, '')"
    for pattern, length in secrets.ALLOWED:
        blanked = f"regexp_replace({blanked}, {quoted(pattern)}, {quoted(' ' * length)}, 'g')"
    listed = f"string_agg([{kinds}][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop)"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {blanked} AS blanked FROM documents),
{found("assigned", secrets.ASSIGN, f"len(regexp_extract(hit, {quoted(secrets.ASSIGN)}, 2)) >= 8")},
{found("accesses", secrets.ACCESS)},
{found("hexes", secrets.HEX)},
base AS (SELECT rid, start, 0 AS kind, start + len(hit) AS stop FROM assigned
         UNION ALL SELECT rid, start, 1, start + len(hit) FROM accesses UNION ALL SELECT rid, start, 2, start + len(hit) FROM hexes),
{", ".join(entropy_spans(k) for k in secrets.CLASSES)},
method AS (SELECT * FROM ({" UNION ALL ".join(f"SELECT * FROM {k}_spans" for k in secrets.CLASSES)}) m
           WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = m.rid AND b.start <= m.start AND b.stop >= m.stop)),
base_by AS (SELECT rid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h, {listed} AS l
            FROM base GROUP BY rid),
all_by AS (SELECT rid, {listed} AS l FROM (SELECT * FROM base UNION ALL SELECT * FROM method) GROUP BY rid),
method_by AS (SELECT rid, count(*) AS n FROM method GROUP BY rid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(base_by.l, '')) AS base_sha256, coalesce(all_by.l, '') AS spans, coalesce(n, 0)::BIGINT AS n_entropy
FROM docs LEFT JOIN base_by USING (rid) LEFT JOIN all_by USING (rid) LEFT JOIN method_by USING (rid)"""


def license_scan(k: int = licences.K, drift: int = 3, enough: float = 0.6) -> str:
    rows = ", ".join(f"({quoted(t)}, {exact}, {quoted(label)})"
                     for exact, group in (("true", licences.PHRASES), ("false", licences.TEXTS)) for t, label in group.items())
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{licences.WORDS}') AS ws FROM documents),
templates AS (SELECT t, exact, label, string_split(t, ' ') AS ws FROM (VALUES {rows}) v(t, exact, label)),
template_grams AS (SELECT t, exact, label, len(ws) - {k - 1} AS grams, i AS spot, array_to_string(ws[i + 1:i + {k}], ' ') AS g
                   FROM (SELECT *, unnest(range(0, len(ws) - {k - 1})) AS i FROM templates)),
grams AS (SELECT rid, i AS place, array_to_string(ws[i + 1:i + {k}], ' ') AS g
          FROM (SELECT rid, ws, unnest(range(0, len(ws) - {k - 1})) AS i FROM docs)),
votes AS (SELECT rid, t, exact, label, grams, spot, place, place - spot AS diagonal FROM grams JOIN template_grams USING (g)),
lines AS (SELECT DISTINCT rid, t, exact, diagonal FROM votes),
marked AS (SELECT *, coalesce(exact OR diagonal - lag(diagonal) OVER w > {drift}, true)::INT AS fresh FROM lines
           WINDOW w AS (PARTITION BY rid, t ORDER BY diagonal)),
spans AS (SELECT *, sum(fresh) OVER (PARTITION BY rid, t ORDER BY diagonal) AS span FROM marked),
places AS (SELECT rid, t, span, v.exact, label, count(DISTINCT spot) / max(grams)::DOUBLE AS score, min(place) AS first
           FROM spans JOIN votes v USING (rid, t, diagonal) GROUP BY rid, t, span, v.exact, label),
kept AS (SELECT * FROM places WHERE score >= CASE WHEN exact THEN 1.0 ELSE {enough} END)
SELECT d.doc_id, len(any_value(d.ws))::BIGINT AS n_words, count(*) FILTER (exact)::BIGINT AS n_base, (min(first) FILTER (exact))::DOUBLE AS first_word,
       (max(first) FILTER (exact))::DOUBLE AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(score), 0.0)::DOUBLE AS score
FROM docs d LEFT JOIN kept USING (rid) GROUP BY d.rid, d.doc_id"""


def ranked_search() -> str:
    terms = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""
WITH known AS (SELECT *, len(terms) AS n FROM (SELECT row_number() OVER () AS rid, doc_id, {terms} AS terms FROM documents) WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM known),
asked AS (SELECT item, item_id, unnest(list_distinct(terms)) AS term FROM (SELECT row_number() OVER () AS item, item_id, {terms} AS terms FROM benchmark)),
counts AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, n, unnest(terms) AS term FROM known)
           WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM counts, corpus GROUP BY term, docs),
scored AS (SELECT item, item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total)))) AS BIGINT) AS score
           FROM counts JOIN weights USING (term) JOIN asked USING (term), corpus GROUP BY item, item_id, rid, doc_id)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0) WHERE place <= 50"""


ORACLES = {
    "op2_secrets": secret_scan(),
    "op5_licenses": license_scan(),
    "op4_mixing": r"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w,
                    row_number() OVER (ORDER BY source NULLS LAST) AS r FROM totals),
ordered AS (SELECT *, row_number() OVER (ORDER BY source_size / w, r) AS o FROM weighted),
leveled AS (SELECT max((1.5::DOUBLE * (SELECT sum(source_size) FROM totals)
                        - 2.0::DOUBLE * coalesce((SELECT sum(b.source_size) FROM ordered b WHERE b.o < a.o), 0))
                       / (SELECT sum(c.w) FROM ordered c WHERE c.o >= a.o)) AS level FROM ordered a),
targets AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, level * w)::DOUBLE AS target FROM ordered, leveled),
rated AS (SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
          FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE
                                        < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated""",
    "op9_chat": r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v),
sized AS (SELECT *, len(role) + len(regexp_replace(role, '[^\\<#:]', '', 'g')) + len(text) + len(regexp_replace(text, '[^\\<#:]', '', 'g'))
                 + len('### ') + len(': ') + len('</turn>') + 1 AS chars FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op13_ranked_search": ranked_search(),
}
