"""Plain SQL for the queries of ``stored_queries``."""

from __future__ import annotations

from catalog_engine.operators import graph
from catalog_engine.plans import stored_queries as q
from catalog_engine.plans.catalogue_sql import _CATALOGUE, _GRAPH, CATALOGUE_COMPARISONS
from catalog_engine.plans.comparison_sql import _PART_SIBLINGS, COMPARISONS
from catalog_engine.plans.table_queries import LIST_ROWS
from catalog_engine.sources.split import MALFORMED

_LISTED = f"""
    SELECT id, ((nth - 1) // {LIST_ROWS})::BIGINT AS part, count(*) AS n, string_agg(s, ' ' ORDER BY nth) AS siblings
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s) AS nth FROM asked) GROUP BY id, part
"""

STORED_COMPARISONS: dict[str, str] = {
    "sibling_lists": f"""
        WITH e AS ({_PART_SIBLINGS}),
        m AS (SELECT src AS g, dst AS member FROM e UNION SELECT src, src FROM e),
        asked AS (SELECT DISTINCT a.member AS id, b.member AS s FROM m a JOIN m b ON a.g = b.g AND a.member <> b.member
                  WHERE a.member::BIGINT % {q.ASKED} = 0)
        {_LISTED}
    """,
    "catalogue_family": f"""{_CATALOGUE},
        children AS (SELECT parent AS id, 0::BIGINT AS part, string_agg(id, ' ' ORDER BY id) AS children FROM parents GROUP BY parent),
        asked AS (SELECT id, s FROM sibs WHERE substr(id, 2)::BIGINT % {q.ASKED} = 0),
        beside AS ({_LISTED}),
        keys AS (SELECT id, 0::BIGINT AS part FROM parents UNION SELECT id, part FROM children UNION SELECT id, part FROM beside)
        SELECT k.id, k.part, CASE WHEN k.part = 0 THEN p.parent END AS parent, c.children, b.siblings
        FROM keys k LEFT JOIN parents p ON p.id = k.id
        LEFT JOIN children c ON c.id = k.id AND c.part = k.part LEFT JOIN beside b ON b.id = k.id AND b.part = k.part
    """,
    "job_model": f"""{_CATALOGUE} {_GRAPH}
        SELECT 'memes' AS kind, m.id AS key, array_to_string(list_sort(list_filter([
                   CASE WHEN length(m.description) > 1000 THEN 'description too long' END,
                   CASE WHEN length(k.title) > 255 THEN 'title too long' END], lambda x: x IS NOT NULL)), '; ') AS detail
        FROM main m JOIN kept k ON k.id = m.id
        UNION ALL SELECT DISTINCT 'authors', author, '' FROM main WHERE author IS NOT NULL
        UNION ALL SELECT DISTINCT 'updaters', updater, '' FROM main WHERE updater IS NOT NULL
        UNION ALL SELECT 'node', kind || ' ' || key, properties FROM nodes
        UNION ALL SELECT 'edge', src_kind || ' ' || src, relation || ' ' || dst_kind || ' ' || dst FROM edges
    """,
    "array_with_rejects": f"""
        SELECT doc_id, md5(text) AS digest, lang, NULL::VARCHAR AS reason FROM documents WHERE doc_id % 50 NOT IN (7, 8)
        UNION ALL
        SELECT NULL, md5(CASE WHEN doc_id % 50 = 7 THEN '{{"doc_id": "no ' || doc_id || '"}}' ELSE '{{"doc_id": ' || doc_id || ',, }}' END),
               NULL, '{MALFORMED}'
        FROM documents WHERE doc_id % 50 IN (7, 8)
    """,
    "object_split": CATALOGUE_COMPARISONS["raw_vision_file"],
    "first_in_source": f"""
        WITH placed AS (SELECT doc_id, text, row_number() OVER (ORDER BY 2 - doc_id % 3, doc_id) - 1 AS ordinal FROM documents),
        left_over AS (SELECT * FROM placed WHERE ordinal NOT IN ({', '.join(map(str, q.DROPPED_POSITIONS))}))
        SELECT doc_id, ordinal FROM left_over QUALIFY row_number() OVER (PARTITION BY text ORDER BY ordinal) = 1
    """,
    "append_batches": """
        WITH o AS (SELECT nullif(o_custkey, 1) AS person, o_orderkey AS id, o_orderstatus FROM orders),
        one AS (SELECT person, min(id) AS id FROM o WHERE o_orderstatus = 'F' GROUP BY person),
        two AS (SELECT person, min(id) AS id FROM o GROUP BY person)
        SELECT * FROM one
        UNION ALL SELECT * FROM two WHERE NOT EXISTS (SELECT 1 FROM one WHERE one.person IS NOT DISTINCT FROM two.person)
    """,
    "stored_nodes": COMPARISONS["graph_nodes"],
    "stored_edges": f"""
        SELECT '{graph.ENTRY}' AS src_kind, o_orderkey::VARCHAR AS src, '{graph.CREATED_BY}' AS relation,
               '{graph.AUTHOR}' AS dst_kind, o_custkey::VARCHAR AS dst FROM orders
        UNION SELECT '{graph.ENTRY}', o_orderkey::VARCHAR, '{graph.BASED_ON}', '{graph.TEMPLATE}', o_orderpriority FROM orders
              WHERE o_orderpriority <> '5-LOW'
        UNION SELECT '{graph.ENTRY}', l_orderkey::VARCHAR, '{graph.RELATED_TO}', '{graph.SIBLING}', l_partkey::VARCHAR
              FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
    """,
    "gated_orders": f"""
        WITH planted AS (
            SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
            UNION ALL SELECT o_orderkey, o_custkey, 'again' FROM orders WHERE o_orderkey % 97 = 0),
        r AS (SELECT CASE WHEN o_orderkey % 101 <> 5 THEN o_orderkey END AS o_orderkey, o_custkey, o_orderpriority FROM planted),
        judged AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderpriority) AS nth FROM r)
        SELECT o_orderkey, o_custkey, o_orderpriority, array_to_string(list_sort(list_filter([
                   CASE WHEN o_orderkey IS NULL THEN 'key missing' END,
                   CASE WHEN o_orderkey IS NOT NULL AND nth > 1 THEN 'key repeated' END,
                   CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) THEN 'o_custkey unknown' END,
                   CASE WHEN length(o_orderpriority) > {q.LONGEST_PRIORITY} THEN 'o_orderpriority too long' END],
                   lambda x: x IS NOT NULL)), '; ') AS reasons
        FROM judged
    """,
}
