"""The same results from the flat tables, as SQL."""

from __future__ import annotations

U = "https://scholar.test/"
DAY = "strftime(ts, '%Y-%m-%d')"
STAMP = "'%Y-%m-%d %H:%M:%S.%f'"
TEXT = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
POSTINGS = f"""postings AS (
    SELECT doc_id AS id, unnest(toks) AS tok, generate_subscripts(toks, 1) - 1 AS pos
    FROM (SELECT doc_id, {TOKENS} AS toks FROM documents))"""
LINES = """lines AS (SELECT l.*, unnest(range(1, l_linenumber + 1)) AS i FROM lineitem l)"""
EDGES = """edges AS (
    SELECT 'W' || o_orderkey AS work_a_id, 'W' || o_custkey AS work_b_id FROM orders
    UNION SELECT 'W' || o_orderkey, 'W' || (o_orderkey // 2) FROM orders)"""
GRANTS = f"""CASE WHEN o_orderkey % 3 > 0 THEN '[' ||
    '{{"funder":"F' || (o_custkey + 1) || '","funder_display_name":"Funder ' || o_custkey || '","award_id":null}}' ||
    CASE WHEN o_orderkey % 3 = 2 THEN ',{{"funder":"F' || (o_custkey + 2) || '","funder_display_name":"Funder ' ||
        o_custkey || '","award_id":"grant ' || o_orderkey || '"}}' ELSE '' END || ']' END"""
_MESH_NAME = "CASE WHEN o_orderkey % 2 = 0 THEN 'Humans' ELSE 'Mice' END"
MESH = f"""CASE WHEN o_custkey % 3 > 0 THEN '[' ||
    '{{"descriptor_ui":"D1","descriptor_name":"' || {_MESH_NAME} || '","is_major_topic":true}}' ||
    CASE WHEN o_custkey % 3 = 2 THEN ',{{"descriptor_ui":"D2","descriptor_name":"' || {_MESH_NAME} ||
        '","is_major_topic":false}}' ELSE '' END || ']' END"""
PRICE = "CAST(trunc(o_totalprice / 100) AS INTEGER)"
APC_PAID = f"CASE WHEN o_orderkey % 3 = 0 THEN CAST({PRICE} AS VARCHAR) END"
APC_LIST = f"CASE WHEN o_orderkey % 2 > 0 THEN CAST({PRICE} AS VARCHAR) END"
LANGUAGE = "CASE o_custkey % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'de' ELSE 'es' END"
TYPE = "CASE o_orderkey % 3 WHEN 0 THEN 'article' WHEN 1 THEN 'book' ELSE 'dataset' END"
TITLE = "CASE WHEN o_orderstatus <> 'P' THEN 'Order ' || o_orderkey || ', ' || o_orderpriority END"
ORDER_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
FIXED_DATES = "'2023-01-01 00:00:00.000000' AS created_date, '2023-02-03 00:00:00.000000' AS updated_date"


def stats(key: str) -> str:
    return f"CAST({key} % 50 AS INTEGER) AS h_index, CAST({key} % 70 AS INTEGER) AS i10_index"


ORACLES = {
    "scan_nested": f"""
        SELECT 'W' || l_orderkey AS work_id, l_linenumber AS n_authors, 'A. ' || l_suppkey AS first_author,
               CASE WHEN l_linenumber <> 2 THEN 'S' || l_partkey END AS source_id, l_returnflag = 'R' AS is_oa
        FROM lineitem""",
    "incremental_since": f"""
        SELECT 'W' || event_id AS id, event_type AS title, CAST(user_id AS INTEGER) AS cited_by_count,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') AS updated_date, {DAY} AS partition_date
        FROM events WHERE {DAY} > '2024-01-15'""",
    "merged_ids": f"""
        SELECT DISTINCT 'W' || user_id AS id FROM events
        WHERE event_type = 'error' AND {DAY} > '2024-01-15' AND user_id <> 7""",
    "merged_lists_applied": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, {STAMP}) AS o_orderdate, o_orderpriority
        FROM orders WHERE NOT EXISTS (
            SELECT 1 FROM events WHERE event_type = 'error' AND {DAY} > '2024-01-15' AND event_id = o_orderkey)""",
    "snapshot_resume": f"""
        SELECT DISTINCT 'records' AS kind, {DAY} AS day FROM events WHERE {DAY} > '2024-01-15'
        UNION ALL SELECT DISTINCT 'merge list', {DAY} FROM events WHERE event_type = 'error' AND {DAY} > '2024-01-15'""",
    "watermark_advance": f"SELECT event_type AS target, max({DAY}) AS watermark FROM events GROUP BY event_type",
    "quarantine": """
        SELECT event_id, CASE WHEN event_type = 'purchase'
            THEN 'malformed,missing id,missing counts_by_year,missing associated_institutions'
            ELSE concat_ws(',',
                CASE WHEN user_id % 6 = 0 THEN 'malformed' END, CASE WHEN event_id % 10 = 0 THEN 'missing id' END,
                CASE WHEN event_type = 'view' THEN 'unparsable created_date' END,
                CASE WHEN user_id % 4 = 0 THEN 'missing counts_by_year' END,
                CASE WHEN event_type = 'error' THEN 'missing associated_institutions[].relationship' END,
                CASE WHEN event_type = 'click' THEN 'unknown type' END) END AS reject_reason
        FROM events""",
    "quarantine_fields": """
        SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'no JSON' ELSE concat_ws(',',
            CASE WHEN user_id % 6 = 0 THEN 'cited_by_count' END,
            CASE WHEN event_type = 'error' THEN 'counts_by_year' WHEN user_id % 4 IN (0, 2) THEN 'counts_by_year[].year' END,
            CASE WHEN event_id % 7 = 0 THEN 'geo' WHEN user_id % 5 = 0 THEN 'geo.latitude' END) END AS wrong_types
        FROM events""",
    "resume_skip_processed": f"""
        SELECT DISTINCT e.event_type, {DAY} AS day FROM events e
        WHERE NOT EXISTS (SELECT 1 FROM events f WHERE f.value > 240 AND f.event_type = e.event_type
                          AND strftime(f.ts, '%Y-%m-%d') = strftime(e.ts, '%Y-%m-%d'))""",
    "empty_as_null": """SELECT doc_id, CASE WHEN lang <> 'en' THEN lang END AS lang, text FROM documents""",
    "strip_id": """
        SELECT c_custkey, CASE c_custkey % 5 WHEN 3 THEN '' WHEN 4 THEN 'A' || c_custkey END AS id FROM customer""",
    "clean_list": """
        SELECT p_partkey, p_name || '||' || p_brand || ' ' || p_type AS cleaned, true AS nothing_left FROM part""",
    "clean_list_strip": """
        SELECT s_suppkey, 'P' || s_nationkey || '||' || 'P' || s_suppkey AS lineage FROM supplier""",
    "abstract_rebuild": f"SELECT doc_id, nullif({TEXT}, '') AS abstract FROM documents",
    "abstract_two_shapes": f"SELECT doc_id, nullif({TEXT}, '') AS abstract FROM documents",
    "title_abstract": """
        SELECT doc_id, CASE lang WHEN 'es' THEN NULL WHEN 'fr' THEN ' ' || text WHEN 'de' THEN source || ' '
                       ELSE source || ' ' || text END AS title_abstract
        FROM documents""",
    "grants_json": f"SELECT 'W' || o_orderkey AS id, {GRANTS} AS grants, {MESH} AS mesh FROM orders",
    "apc_union": f"""
        SELECT 'W' || o_orderkey AS id, {APC_PAID} AS apc_paid, {APC_LIST} AS apc_list FROM orders""",
    "typed_load": f"""
        WITH t AS (
            SELECT event_id, CASE event_type WHEN 'error' THEN 'n/a' WHEN 'view' THEN NULL ELSE CAST(value AS VARCHAR) END AS v,
                   CASE WHEN event_id % 9 = 0 THEN 'later' ELSE strftime(ts, {STAMP}) END AS t,
                   CASE WHEN event_id % 2 = 0 THEN 'true' WHEN event_id % 3 = 0 THEN 'maybe' END AS f
            FROM events),
        r AS (
            SELECT *, nullif(concat_ws(',', CASE WHEN v IS NOT NULL AND try_cast(v AS DOUBLE) IS NULL THEN 'value' END,
                CASE WHEN t IS NOT NULL AND try_cast(t AS TIMESTAMP) IS NULL THEN 'ts' END,
                CASE WHEN f IS NOT NULL AND try_cast(f AS BOOLEAN) IS NULL THEN 'flag' END), '') AS reject_reason
            FROM t)
        SELECT event_id, CASE WHEN reject_reason IS NULL THEN try_cast(v AS DOUBLE) END AS value,
               CASE WHEN reject_reason IS NULL THEN t END AS ts,
               CASE WHEN reject_reason IS NULL THEN f END AS flag, reject_reason
        FROM r""",
    "tokenize": f"""
        SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, ' ') AS tokens
        FROM (SELECT doc_id, {TOKENS} AS toks FROM documents)""",
    "works_projection": f"""
        SELECT 'W' || o_orderkey AS id, {TITLE} AS title, CAST(NULL AS VARCHAR) AS abstract,
               'Order ' || o_orderkey AS display_name, {LANGUAGE} AS language, {ORDER_DAY} AS publication_date,
               CAST(year(o_orderdate) AS INTEGER) AS publication_year,
               CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 3 > 0 THEN CAST(o_custkey AS VARCHAR) END AS volume,
               CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 12 AS VARCHAR) END AS issue,
               CASE WHEN o_orderkey % 5 > 0 THEN '1' END AS first_page, CAST(NULL AS VARCHAR) AS last_page,
               'S' || o_custkey AS primary_location, {TYPE} AS type, o_orderpriority AS type_crossref,
               CASE WHEN o_orderkey % 9 > 0 THEN 'https://doi.test/10.1/' || o_orderkey END AS id_doi,
               CASE WHEN o_orderkey % 9 > 0 AND o_orderkey % 2 > 0 THEN CAST(o_orderkey + 1000000000000 AS VARCHAR) END AS id_mag,
               CASE WHEN o_orderkey % 9 > 0 AND o_custkey % 2 > 0 THEN CAST(o_custkey AS VARCHAR) END AS id_pmid,
               CAST(NULL AS VARCHAR) AS id_pmcid, o_orderstatus = 'O' AS is_oa,
               CASE WHEN o_orderkey % 6 > 0 THEN CASE o_custkey % 5 WHEN 0 THEN 'gold' WHEN 1 THEN 'green'
                    WHEN 2 THEN 'hybrid' WHEN 3 THEN 'bronze' ELSE 'closed' END END AS oa_status,
               CASE WHEN o_orderkey % 6 > 0 THEN 'https://oa.test/' || o_orderkey END AS oa_url,
               CASE WHEN o_orderkey % 6 > 0 THEN CAST(o_custkey % 2 = 0 AS VARCHAR) END AS oa_any_repository_has_fulltext,
               {APC_PAID} AS apc_paid, {APC_LIST} AS apc_list,
               CASE WHEN o_orderkey % 4 > 0 THEN 'cc-by' END AS license, CAST(o_custkey AS INTEGER) AS cited_by_count,
               o_orderpriority = '5-LOW' AS is_paratext, o_orderstatus = 'F' AS is_retracted, {MESH} AS mesh,
               {GRANTS} AS grants, {ORDER_DAY} || ' 00:00:00.000000' AS created_date,
               {ORDER_DAY} || ' 10:20:30.123456' AS updated_date
        FROM orders""",
    "authors_projection": f"""
        SELECT 'A' || c_custkey AS id, CAST(c_custkey % 1000 AS INTEGER) AS cited_by_count, c_nationkey AS works_count,
               {stats('c_custkey')}, c_name AS display_name,
               c_mktsegment || '|' || c_name || ' jr' AS display_name_alternatives,
               CASE WHEN c_custkey % 3 > 0 THEN CAST(c_custkey AS VARCHAR) END AS id_mag, 'orcid-' || c_custkey AS id_orcid,
               CAST(NULL AS VARCHAR) AS id_scopus, CAST(NULL AS VARCHAR) AS id_twitter, c_mktsegment AS id_wikipedia,
               '2023-01-01 00:00:00.000000' AS created_date, '2023-02-03 04:05:06.500000' AS updated_date
        FROM customer""",
    "institutions_projection": f"""
        SELECT 'I' || s_suppkey AS id,
               CASE s_suppkey % 3 WHEN 0 THEN 'education' WHEN 1 THEN 'company' ELSE 'other' END AS type,
               'https://home.test/' || s_suppkey AS homepage_url, s_nationkey AS cited_by_count,
               CAST(s_suppkey % 100 AS INTEGER) AS works_count, {stats('s_suppkey')}, s_name AS display_name,
               s_name || '|Its ' || s_nationkey AS display_name_alternatives,
               CAST(NULL AS VARCHAR) AS display_name_acronyms, 'ror-' || s_suppkey AS id_ror, s_suppkey AS id_mag,
               CAST(NULL AS VARCHAR) AS id_wikipedia, 'Q1' AS id_wikidata, CAST(NULL AS VARCHAR) AS id_grid,
               CASE WHEN s_suppkey % 4 > 0 THEN 'City ' || s_nationkey END AS city,
               CAST(NULL AS VARCHAR) AS geonames_city_id, CAST(NULL AS VARCHAR) AS region,
               CASE WHEN s_suppkey % 4 > 0 THEN 'Country ' || s_nationkey END AS country,
               CASE WHEN s_suppkey % 4 > 0 THEN 'XX' END AS country_code,
               CASE WHEN s_suppkey % 4 > 0 THEN CAST(CAST(s_acctbal / 128 AS FLOAT) AS DOUBLE) END AS latitude,
               CASE WHEN s_suppkey % 4 > 0 THEN s_nationkey + CAST(0.5 AS DOUBLE) END AS longitude, {FIXED_DATES}
        FROM supplier""",
    "publishers_projection": f"""
        SELECT 'P' || n_nationkey AS id, n_nationkey AS cited_by_count, n_regionkey AS works_count, {stats('n_nationkey')},
               n_name AS display_name, n_name || '|ab' AS alternate_titles,
               CASE WHEN n_nationkey % 2 > 0 THEN 'DE|FR' END AS country_codes, 'ror-' || n_nationkey AS id_ror,
               CAST(NULL AS VARCHAR) AS id_wikidata, n_regionkey % 2 AS hierarchy_level,
               'P' || n_nationkey || '|P' || n_regionkey AS lineage,
               CASE WHEN n_nationkey % 3 > 0 THEN 'P' || n_regionkey END AS parent, {FIXED_DATES}
        FROM nation WHERE n_nationkey <> 3""",
    "funders_projection": f"""
        SELECT 'F' || s_suppkey AS id, s_nationkey AS cited_by_count, CAST(s_suppkey % 100 AS INTEGER) AS works_count,
               {stats('s_suppkey')}, s_name AS display_name, CASE WHEN s_suppkey % 2 > 0 THEN s_name END AS alternate_titles,
               'Funds ' || s_nationkey AS description, CAST(NULL AS VARCHAR) AS homepage_url, 'ror-' || s_suppkey AS id_ror,
               'Q2' AS id_wikidata, CASE WHEN s_suppkey % 2 > 0 THEN '100' ELSE 'x' END || s_suppkey AS id_crossref,
               CAST(NULL AS VARCHAR) AS id_doi, {FIXED_DATES}
        FROM supplier""",
    "concepts_projection": f"""
        SELECT 'C' || p_partkey AS id, p_size AS cited_by_count, CAST(p_partkey % 100 AS INTEGER) AS works_count,
               {stats('p_partkey')}, p_name AS display_name, p_type AS description, p_size % 6 AS level,
               p_partkey AS id_mag, p_brand AS id_umls_cui, CAST(NULL AS VARCHAR) AS id_umls_aui, 'Q3' AS id_wikidata,
               CAST(NULL AS VARCHAR) AS id_wikipedia, {FIXED_DATES}
        FROM part""",
    "sources_projection": f"""
        SELECT 'S' || p_partkey AS id, p_size AS cited_by_count, CAST(p_partkey % 100 AS INTEGER) AS works_count,
               {stats('p_partkey')}, p_name AS display_name, p_brand AS abbreviated_title,
               p_name || '|' || p_type AS alternate_titles, CAST(NULL AS VARCHAR) AS country_code,
               'https://s.test/' || p_partkey AS homepage_url,
               CASE p_partkey % 3 WHEN 0 THEN 'journal' WHEN 1 THEN 'repository' ELSE 'conference' END AS type,
               p_size * 10 AS apc_usd, '{U}P' || (p_size % 25) AS host_organization, p_brand AS host_organization_name,
               'P' || (p_size % 25) || '|P' || (p_size % 5) AS host_organization_lineage,
               CASE WHEN p_size % 3 > 0 THEN p_brand END AS societies, p_size % 2 = 0 AS is_in_doaj,
               p_size % 5 = 0 AS is_oa, p_partkey AS id_mag, CAST(NULL AS VARCHAR) AS id_fatcat,
               '1234-' || p_partkey || '|4321-' || p_size AS id_issn, '1234-' || p_partkey AS id_issn_l,
               'Q4' AS id_wikidata, {FIXED_DATES}
        FROM part""",
    "search_documents": f"""
        WITH d AS (SELECT *, CASE WHEN doc_id % 7 > 0 THEN 'Document ' || doc_id || ' of ' || source END AS title,
                          nullif({TEXT}, '') AS abstract FROM documents)
        SELECT 'W' || doc_id AS id, 'Document ' || doc_id AS display_name, title, abstract,
               CASE WHEN title IS NOT NULL OR abstract IS NOT NULL
                    THEN coalesce(title, '') || ' ' || coalesce(abstract, '') END AS title_abstract,
               CASE WHEN doc_id % 4 > 0 THEN '[{{"author":{{"display_name":"Author ' || doc_id || '","id":"{U}A' ||
                    (doc_id % 100) || '"}},"author_position":"first","institutions":null,"is_corresponding":true,' ||
                    '"raw_affiliation_string":null}}]' END AS authorships,
               CASE WHEN doc_id % 2 > 0 THEN '{{"volume":"' || doc_id || '","issue":"2"}}' END AS biblio,
               CAST(n_chars AS INTEGER) AS cited_by_count, '2024-01-01 00:00:00.000000' AS created_date,
               'https://doi.test/10.2/' || doc_id AS doi,
               CASE WHEN doc_id % 5 > 0 THEN CAST(doc_id + 1 AS VARCHAR) END AS mag, CAST(NULL AS VARCHAR) AS pmid,
               'PMC1' AS pmcid, lang = 'en' AS is_oa, false AS is_paratext, false AS is_retracted, lang AS language,
               '[{{"is_oa":true,"is_primary":true,"source":{{"id":"{U}S' || (doc_id % 20) || '","display_name":"' ||
                    source || '"}},"version":"' || lang || '"}}]' AS locations,
               '2023-05-06' AS publication_date, CAST(2000 + doc_id % 20 AS INTEGER) AS publication_year, source AS type,
               '2024-02-03 04:05:06.000000' AS updated_date
        FROM d""",
    "explode_edges": """
        SELECT institution_a_id, institution_b_id, max(relationship) AS relationship FROM (
            SELECT 'I' || s_suppkey AS institution_a_id, 'I' || (s_suppkey + 1) AS institution_b_id,
                   'child' AS relationship FROM supplier
            UNION ALL SELECT 'I' || s_suppkey, 'I' || s_nationkey, 'related' FROM supplier)
        GROUP BY 1, 2""",
    "institutions_concepts": """
        SELECT institution_id, concept_id, max(score) AS score FROM (
            SELECT 'I' || s_suppkey AS institution_id, 'C' || (s_suppkey % 9) AS concept_id,
                   CAST(0.5 AS DOUBLE) AS score FROM supplier
            UNION ALL SELECT 'I' || s_suppkey, 'C' || s_nationkey, CAST(0.25 AS DOUBLE) FROM supplier)
        GROUP BY 1, 2""",
    "concepts_related": """
        SELECT 'C' || p_partkey AS concept_a_id, 'C' || p_size AS concept_b_id,
               CAST(CAST(p_retailprice / 4096 AS FLOAT) AS DOUBLE) AS score
        FROM part WHERE p_size > 5""",
    "concept_ancestors": """
        SELECT 'C' || p_partkey AS concept_a_id, 'C' || (p_size * i) AS concept_b_id
        FROM part, (VALUES (1), (2), (3)) v(i) WHERE i <= p_size % 4""",
    "works_concepts": """
        SELECT work_id, concept_id, CAST(max(score) AS DOUBLE) AS score FROM (
            SELECT 'W' || l_orderkey AS work_id, 'C' || (l_suppkey % 50) AS concept_id,
                   CAST(l_discount + 0.25 AS FLOAT) AS score FROM lineitem
            UNION ALL SELECT 'W' || l_orderkey, 'C' || CAST(l_quantity AS INTEGER), CAST(l_tax + 0.5 AS FLOAT) FROM lineitem)
        GROUP BY 1, 2""",
    "works_sdgs": f"""
        WITH {LINES}
        SELECT 'W' || l_orderkey AS work_id, 'https://goals.test/' || i AS sdg_id, 'Goal ' || i AS display_name,
               CAST(max(CAST(l_tax + 0.125 AS FLOAT)) AS DOUBLE) AS score
        FROM lines WHERE i < l_linenumber GROUP BY l_orderkey, i""",
    "citation_edges": f"WITH {EDGES} SELECT work_a_id, work_b_id FROM edges",
    "works_related": """
        SELECT 'W' || o_orderkey AS work_a_id, 'W' || (o_orderkey + 1) AS work_b_id FROM orders WHERE o_orderkey % 7 > 0
        UNION SELECT 'W' || o_orderkey, 'W' || o_custkey FROM orders WHERE o_orderkey % 7 > 0""",
    "authorships_posexplode": f"""
        WITH {LINES}
        SELECT 'W' || l_orderkey AS work_id,
               CASE WHEN (l_suppkey + i) % 11 > 0 THEN 'A' || ((l_suppkey * i) % 1000) END AS author_id,
               CASE WHEN i = 1 THEN 'first' WHEN i = l_linenumber THEN 'last' ELSE 'middle' END AS position,
               CAST(i - 1 AS INTEGER) AS exact_position, 'A. ' || l_suppkey AS raw_author_name,
               CAST(NULL AS VARCHAR) AS raw_affiliation, i = 1 AS is_corresponding
        FROM lines""",
    "explode_two_level": f"""
        WITH {LINES}, linked AS (SELECT * FROM lines WHERE (l_suppkey + i) % 11 > 0)
        SELECT 'W' || l_orderkey AS work_id, 'A' || ((l_suppkey * i) % 1000) AS author_id,
               'I' || (l_suppkey % 25) AS institution_id FROM linked
        UNION SELECT 'W' || l_orderkey, 'A' || ((l_suppkey * i) % 1000), 'I' || i FROM linked""",
    "is_primary_location": """
        WITH p AS (SELECT *, CASE WHEN l_returnflag = 'A' THEN 'https://pdf.test/' || l_partkey END AS pdf,
                          CASE WHEN l_linenumber <> 2 THEN 'S' || l_partkey END AS primary_source FROM lineitem),
        x AS (
            SELECT *, 'S' || l_partkey AS source_id, pdf AS pdf_url, l_linestatus AS version FROM p
            UNION ALL SELECT *, 'S' || l_partkey, pdf, CASE WHEN l_linenumber = 3 THEN l_linestatus END FROM p
            UNION ALL SELECT *, CASE WHEN l_linenumber = 4 THEN 'S' || (l_partkey + 1) END, 'x', l_linestatus FROM p)
        SELECT 'W' || l_orderkey AS work_id, source_id, l_returnflag = 'R' AS is_oa,
               coalesce(source_id = primary_source, false) AND pdf_url IS NOT DISTINCT FROM pdf
                   AND version IS NOT DISTINCT FROM l_linestatus AS is_primary,
               'https://land.test/' || l_partkey AS landing_page_url, CAST(NULL AS VARCHAR) AS license, pdf_url, version
        FROM x""",
    "drop_missing_key": "SELECT 'A' || c_custkey AS id, c_name FROM customer WHERE c_custkey % 3 = 1",
    "delete_by_key": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, {STAMP}) AS o_orderdate, o_orderpriority
        FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)""",
    "cascade_delete": """
        WITH gone AS (SELECT event_id FROM events WHERE event_type = 'error')
        SELECT 'works' AS table_name, o_orderkey AS id, CAST(1 AS BIGINT) AS n FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM gone WHERE event_id = o_orderkey)
        UNION ALL SELECT t, l_orderkey, count(*) FROM lineitem, (VALUES ('works_authorships'), ('works_references')) v(t)
        WHERE NOT EXISTS (SELECT 1 FROM gone WHERE event_id = l_orderkey) GROUP BY 1, 2""",
    "merged_delete": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, {STAMP}) AS o_orderdate, o_orderpriority
        FROM orders WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_id = o_orderkey AND event_type = 'error'
                                      AND {DAY} > '2024-01-15')""",
    "replace_upsert": f"""
        WITH fresh AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01'),
        kept AS (SELECT * FROM orders o WHERE o_orderdate < TIMESTAMP '2001-06-01'
                 AND NOT EXISTS (SELECT 1 FROM fresh f WHERE f.o_custkey = o.o_custkey))
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, {STAMP}) AS o_orderdate, o_orderpriority
        FROM (SELECT * FROM kept UNION ALL SELECT * FROM fresh)""",
    "replace_children": f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus, strftime(l_shipdate, {STAMP}) AS l_shipdate
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        WHERE l_returnflag = 'N' OR NOT (o_orderdate >= TIMESTAMP '2001-01-01' OR o_orderstatus = 'P')""",
    "lake_replace": """
        WITH again AS (SELECT o_orderkey, o_custkey + 1 AS o_custkey FROM orders
                       WHERE o_orderstatus = 'P' OR o_orderdate >= TIMESTAMP '2001-06-01'),
        kept AS (SELECT o_orderkey, o_custkey FROM orders o WHERE o_orderdate < TIMESTAMP '2001-06-01'
                 AND NOT EXISTS (SELECT 1 FROM again a WHERE a.o_orderkey = o.o_orderkey)),
        now AS (SELECT * FROM again UNION ALL SELECT * FROM kept)
        SELECT 'W' || o_orderkey AS work_a_id, 'W' || o_custkey AS work_b_id FROM now
        UNION SELECT 'W' || o_orderkey, 'W' || (o_orderkey // 2) FROM now""",
    "latest_wins": f"""
        SELECT event_id, strftime(ts, {STAMP}) AS ts, user_id, event_type, value, props FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1""",
    "drop_stale": f"""
        SELECT event_id, user_id AS id, strftime(ts, {STAMP}) AS updated_date, event_type FROM events s
        WHERE NOT EXISTS (
            SELECT 1 FROM events e WHERE e.event_type = 'error' AND e.user_id = s.user_id AND e.ts > s.ts)""",
    "stream_replace": f"""
        SELECT e.event_id, strftime(e.ts, {STAMP}) AS ts, e.user_id, e.event_type, e.value, e.props
        FROM events e JOIN (SELECT user_id, max(ts) AS last FROM events GROUP BY user_id) m
          ON m.user_id = e.user_id AND m.last = e.ts""",
    "partition_metrics": f"""
        SELECT {DAY} || '-part_' || event_type AS partition_label, count(*) AS n_works,
               count(*) FILTER (WHERE value > 30) AS n_abstracts
        FROM events GROUP BY 1""",
    "pending_partitions": f"""
        SELECT event_type AS entity, count(DISTINCT {DAY} || '/' || user_id) AS partitions,
               CASE WHEN event_type = 'click' THEN 0 ELSE count(DISTINCT {DAY}) END AS merge_files
        FROM events WHERE {DAY} > '2024-01-15' GROUP BY event_type""",
    "sort_missing_last": """
        SELECT doc_id AS id, nullif(lang, 'en') AS language, n_chars FROM documents
        ORDER BY language DESC NULLS LAST, id""",
    "lookup_doi": f"""
        SELECT 'W' || o_orderkey AS id, 'https://doi.test/10.1/' || o_orderkey AS id_doi, {TITLE} AS title
        FROM orders WHERE o_orderkey IN (1, 17, 500, 1001)""",
    "lookup_id": """
        SELECT 'W' || o_orderkey AS id, 'Order ' || o_orderkey AS display_name FROM orders
        WHERE o_orderkey IN (3, 77, 1200)""",
    "works_by_year": f"""
        SELECT 'W' || o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS publication_year, {ORDER_DAY} AS publication_date
        FROM orders WHERE year(o_orderdate) IN (1996, 1997)""",
    "works_by_year_pruned": f"""
        SELECT 'W' || o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS publication_year, {ORDER_DAY} AS publication_date
        FROM orders WHERE year(o_orderdate) IN (1996, 1997)""",
    "works_by_fields": f"""
        SELECT 'W' || o_orderkey AS id, {LANGUAGE} AS language, {ORDER_DAY} AS publication_date, {TYPE} AS type
        FROM orders WHERE o_custkey % 2 = 0 AND o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'
          AND o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1999-12-31'""",
    "works_of_author": """
        SELECT l_orderkey AS work_id, o_orderpriority AS title, l_linenumber AS exact_position, l_suppkey AS author_id,
               s_name AS display_name
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey""",
    "works_of_one_author": f"""
        WITH {LINES}
        SELECT 'W' || o_orderkey AS id, {TITLE} AS title, CAST(year(o_orderdate) AS INTEGER) AS publication_year FROM orders
        WHERE EXISTS (SELECT 1 FROM lines WHERE l_orderkey = o_orderkey AND (l_suppkey * i) % 1000 = 42
                      AND (l_suppkey + i) % 11 > 0)""",
    "sql_views": f"""
        WITH {EDGES}
        SELECT {LANGUAGE} AS language, count(DISTINCT o_orderkey) AS n_works, count(work_a_id) AS n_citations
        FROM orders LEFT JOIN edges ON work_b_id = 'W' || o_orderkey WHERE o_orderstatus = 'O' GROUP BY 1""",
    "citation_counts": f"WITH {EDGES} SELECT work_b_id AS id, count(*) AS n_citing FROM edges GROUP BY 1",
    "citation_neighbours": f"""
        WITH {EDGES}
        SELECT work_b_id AS id, 'out' AS direction FROM edges WHERE work_a_id = 'W40'
        UNION ALL SELECT work_a_id, 'in' FROM edges WHERE work_b_id = 'W40'""",
    "search_any": f"""
        SELECT doc_id AS id FROM documents WHERE list_has_any({TOKENS}, ['token', 'licence', 'license'])""",
    "search_all": f"""
        SELECT doc_id AS id FROM documents WHERE list_contains({TOKENS}, 'the')
          AND list_has_any({TOKENS}, ['licence', 'license'])""",
    "search_phrase": f"""
        WITH {POSTINGS}, a AS MATERIALIZED (SELECT * FROM postings WHERE tok = 'of'),
        b AS MATERIALIZED (SELECT * FROM postings WHERE tok = 'the')
        SELECT a.id, CAST(a.pos AS INTEGER) AS start FROM a JOIN b ON b.id = a.id AND b.pos = a.pos + 1""",
    "search_phrase_gap": f"""
        WITH {POSTINGS}, a AS MATERIALIZED (SELECT * FROM postings WHERE tok = 'under'),
        b AS MATERIALIZED (SELECT * FROM postings WHERE tok IN ('mit', 'apache', 'licence')),
        c AS MATERIALIZED (SELECT * FROM postings WHERE tok = 'license')
        SELECT a.id, CAST(a.pos AS INTEGER) AS start FROM a JOIN b ON b.id = a.id AND b.pos = a.pos + 2
        LEFT JOIN c ON c.id = a.id AND c.pos = a.pos + 3 WHERE b.tok = 'licence' OR c.id IS NOT NULL""",
    "search_bm25": f"""
        WITH {POSTINGS},
        lengths AS (SELECT doc_id AS id, len({TOKENS}) AS length FROM documents),
        collection AS (SELECT count(*) AS n, avg(length) AS mean FROM lengths),
        tf AS (SELECT id, CASE tok WHEN 'license' THEN 'licence' ELSE tok END AS term, count(*) AS tf FROM postings
               WHERE tok IN ('token', 'of', 'the', 'licence', 'license') GROUP BY 1, 2),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
        scored AS (
            SELECT tf.id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 /
                              (tf + 1.2 * (0.25 + 0.75 * length / mean))) AS score
            FROM tf JOIN df USING (term) JOIN lengths USING (id) CROSS JOIN collection GROUP BY tf.id)
        SELECT id, round(score, 6) AS score FROM scored ORDER BY scored.score DESC, id LIMIT 100""",
    "search_facets": f"""
        WITH hits AS (SELECT * FROM documents WHERE list_has_any({TOKENS}, ['token', 'licence', 'license']))
        SELECT 'lang' AS field, lang AS value, count(*) AS n FROM hits GROUP BY lang
        UNION ALL SELECT 'source', source, count(*) FROM hits GROUP BY source""",
    "csv_round_trip": """
        SELECT 'W' || doc_id AS id, source AS title, text AS abstract, lang = 'en' AS is_oa,
               CAST(n_chars AS INTEGER) AS cited_by_count, CAST(NULL AS VARCHAR) AS language
        FROM documents""",
}
ORACLES["json_round_trip"] = f"""
    SELECT id, title_abstract, mag, is_oa, cited_by_count, language FROM ({ORACLES["search_documents"]})"""
ORACLES["clear_tables"] = f"""
    WITH {EDGES}
    SELECT 'loaded' AS step, count(*) AS n FROM edges UNION ALL SELECT 'cleared', 0
    UNION ALL SELECT 'loaded again', count(*) FROM edges JOIN orders ON work_a_id = 'W' || o_orderkey WHERE o_orderstatus = 'P'"""
ORACLES["search_bm25_indexed"] = ORACLES["search_bm25"]

# the texts are in Latin script, so the word break rules come down to letters and digits with inner signs
_LETTERS, _DIGITS = r"(?:[\p{Latin}\p{Greek}\p{Cyrillic}][\pM\p{Cf}]*)+", r"(?:\p{Nd}[\pM\p{Cf}]*)+"
_UNITS = rf"(?:{_LETTERS}(?:[''’‘.:·]{_LETTERS})*|{_DIGITS}(?:[''’‘.,;]{_DIGITS})*)"
ORACLES["tokenize_words"] = rf"""
    SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, ' ') AS tokens
    FROM (SELECT doc_id, regexp_extract_all(lower(text), '\p{{Pc}}*{_UNITS}(?:\p{{Pc}}*{_UNITS})*\p{{Pc}}*') AS toks FROM documents)"""
ORACLES["literal_round_trip"] = r"""
    SELECT doc_id, 6 AS n_items, concat_ws('|', coalesce(text, 'none'), coalesce(source, '(null)'), '', 'null', 'a"b\c,{d} ', coalesce(lang, '(null)')) AS items
    FROM documents"""
ORACLES["search_fields"] = """
    WITH fields AS (
        SELECT doc_id AS id, unnest([0, 1, 2, 3]) AS f, unnest([3.0, 1.0, 2.0, 0.5])::DOUBLE AS w,
               unnest([array_to_string(string_split(text, ' ')[1:8], ' '), text, source, lang]) AS said FROM documents),
    toks AS (SELECT id, f, w, regexp_extract_all(lower(coalesce(said, '')), '[\\p{L}\\p{N}]+') AS toks FROM fields),
    means AS (SELECT f, avg(len(toks)) AS mean FROM toks GROUP BY f),
    tf AS (SELECT id, f, w, length, CASE tok WHEN 'license' THEN 'licence' ELSE tok END AS term, count(*) AS tf
           FROM (SELECT id, f, w, len(toks) AS length, unnest(toks) AS tok FROM toks) WHERE tok IN ('token', 'of', 'the', 'licence', 'license', 'en') GROUP BY ALL),
    df AS (SELECT term, count(DISTINCT id) AS df FROM tf GROUP BY term),
    weighted AS (SELECT id, term, sum(w * tf / (0.25 + 0.75 * length / mean)) AS x FROM tf JOIN means USING (f) GROUP BY id, term),
    scored AS (SELECT id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * x * 2.2 / (x + 1.2)) AS score
               FROM weighted JOIN df USING (term) CROSS JOIN (SELECT count(*) AS n FROM documents) GROUP BY id)
    SELECT id, round(score, 6) AS score FROM scored ORDER BY scored.score DESC, id LIMIT 100"""
ORACLES["search_near"] = f"""
    WITH {POSTINGS}, hits AS (SELECT id, pos, tok = 'under' AS a FROM postings WHERE tok IN ('under', 'licence', 'license')),
    lasts AS (SELECT id, pos, max(pos) FILTER (a) OVER w AS one, max(pos) FILTER (NOT a) OVER w AS other FROM hits
              WINDOW w AS (PARTITION BY id ORDER BY pos)),
    best AS (SELECT id, least(one, other) AS start, pos - least(one, other) + 1 AS width,
                    row_number() OVER (PARTITION BY id ORDER BY pos - least(one, other), pos) AS n
             FROM lasts WHERE one IS NOT NULL AND other IS NOT NULL)
    SELECT id, CAST(start AS INTEGER) AS start, CAST(width AS INTEGER) AS width FROM best WHERE n = 1 AND width <= 5"""
ORACLES["search_histogram"] = """
    SELECT CASE WHEN n_chars < 500 THEN 'before' WHEN n_chars >= 10000 THEN 'after' ELSE 'between' END AS part,
           CASE WHEN n_chars >= 500 AND n_chars < 10000 THEN 500 + floor((n_chars - 500) / 500) * 500 END AS low,
           count(*) AS n, count(DISTINCT source) AS n_distinct
    FROM documents WHERE n_chars IS NOT NULL GROUP BY 1, 2"""
ORACLES["concept_closure"] = f"""
    WITH RECURSIVE edges AS (SELECT DISTINCT concept_a_id AS id, concept_b_id AS reached FROM ({ORACLES["concept_ancestors"]})),
    walk AS (SELECT id, reached, 1 AS depth FROM edges
             UNION SELECT walk.id, edges.reached, depth + 1 FROM walk JOIN edges ON edges.id = walk.reached WHERE depth < 60)
    SELECT id, reached, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY id, reached"""
