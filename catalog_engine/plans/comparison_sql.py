"""Plain SQL with the meaning of each query in ``table_queries``, for an independent engine to run."""

from __future__ import annotations

from catalog_engine import fixed_values as fixed
from catalog_engine.plans import table_queries as q


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def value_list(values) -> str:
    return ", ".join(quoted(v) for v in values)


# White space a word is trimmed of, spelled by code points.
_SPACE = " || ".join(f"chr({ord(c)})" for c in fixed.OTHER_WHITE_SPACE + " ")
_DELETED = quoted(fixed.PUNCTUATION_AND_DIGITS)


def words_of(text: str) -> str:
    """List of the words of a text, in order, longer than one character."""
    return (
        f"list_filter(list_transform(string_split({text}, ' '), "
        f"lambda w: translate(lower(trim(w, {_SPACE})), {_DELETED}, '')), lambda w: length(w) > 1)"
    )


_WORD_COUNTS = f"""
    SELECT label, doc_id AS id, count(*) AS score
    FROM (SELECT doc_id, unnest({words_of('text')}) AS label FROM documents)
    GROUP BY label, doc_id
"""

_ANCHORS = """
    SELECT page_id, i, substr(h, 2) AS k,
           (CASE WHEN (i - 1) % 2 = 0 THEN 'https://' ELSE 'see ' END)
           || (CASE WHEN (i - 1) % 3 = 0 THEN split_part(split_part(url, '://', -1), '/', 1) ELSE 'www.example.net' END)
           || h AS v
    FROM (SELECT page_id, url, unnest(hs) AS h, generate_subscripts(hs, 1) AS i
          FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>', 1) AS hs FROM pages))
"""

_REJECTED = " OR ".join(f"contains(v, {quoted(r)})" for r in fixed.LINK_REJECTS)

_REFS = f"""
    SELECT page_id,
           arg_max(v, i) FILTER (WHERE site = 'ref_net') AS ref_net,
           arg_max(v, i) FILTER (WHERE site = 'ref_org') AS ref_org,
           arg_min(v, i) FILTER (WHERE site = 'ref_other') AS ref_other
    FROM (SELECT *, CASE WHEN contains(v, '.example.net/') THEN 'ref_net'
                         WHEN contains(v, '.example.org/') THEN 'ref_org' ELSE 'ref_other' END AS site
          FROM ({_ANCHORS})
          WHERE k <> 'The'
            AND (v LIKE 'http%' OR v LIKE 'www%' OR contains(v, '.org') OR contains(v, '.com')
                 OR contains(v, '.net') OR contains(v, 'encyclopediadramatica.wiki'))
            AND NOT ({_REJECTED} OR v LIKE 'pt.%' OR length(v) < 8))
    GROUP BY page_id
"""

_PART_SIBLINGS = """
    SELECT DISTINCT lead::VARCHAR AS src, l_partkey::VARCHAR AS dst
    FROM (SELECT l_partkey, min(l_partkey) OVER (PARTITION BY l_orderkey) AS lead FROM lineitem)
    WHERE lead <> l_partkey
"""

_PLACES = """
    SELECT 'r' || r_regionkey AS id, NULL AS parent, NULL AS c1 FROM region
    UNION ALL
    SELECT 'n' || n_nationkey, CASE WHEN n_regionkey = 4 THEN 'lost' ELSE 'r' || n_regionkey END, NULL FROM nation
    UNION ALL
    SELECT 's' || s_suppkey, CASE WHEN s_acctbal > 0 THEN 'n' || s_nationkey END, 'n' || s_nationkey FROM supplier
"""

_FAMILY = f"""
    places AS ({_PLACES}),
    parents AS (SELECT id, parent FROM places WHERE parent IN (SELECT id FROM places)),
    listed AS (SELECT id AS parent, c1 AS child FROM places WHERE c1 IN (SELECT id FROM places) AND c1 <> id),
    children AS (SELECT parent, child FROM listed UNION SELECT parent, id FROM parents)
"""

_BAND = "(CASE WHEN c.part IS NULL OR c.part = 0 THEN p.parent END)"

COMPARISONS: dict[str, str] = {
    "yearly_counts": """
        SELECT EXTRACT(YEAR FROM o_orderdate)::INTEGER AS year, count(*) AS n FROM orders GROUP BY 1
    """,
    "dedupe_keep_first": """
        SELECT doc_id, lang, source, n_chars
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) AS nth FROM documents)
        WHERE nth = 1
    """,
    "denylist_filter": """
        SELECT p_partkey, nullif(p_name, 'small ring') AS p_name, p_brand FROM part
        WHERE p_type = 'ECONOMY'
          AND (nullif(p_name, 'small ring') IS NULL
               OR NOT (contains(p_name, 'ring') OR contains(p_name, 'olt') OR contains(p_name, 'red')))
    """,
    "short_ids": "SELECT page_id, split_part(url, '/', -1) AS short_id FROM pages",
    "bottom_k_excluded": f"""
        SELECT page_id, url FROM pages
        WHERE url NOT IN (SELECT url FROM pages ORDER BY split_part(url, '/', -1), url LIMIT {q.BLOCKED_LOWEST})
          AND url NOT IN ({value_list(q.EXCLUDED_PAGES)})
    """,
    "safety_cascade": """
        WITH fine AS (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)
        SELECT 'documents' AS table_name, count(*) AS n, sum(doc_id)::BIGINT AS id_sum FROM documents
          WHERE doc_id IN (FROM fine)
        UNION ALL SELECT 'labels', count(*), sum(doc_id)::BIGINT FROM labels WHERE doc_id IN (FROM fine)
        UNION ALL SELECT 'benchmark', count(*), sum(item_id)::BIGINT FROM benchmark WHERE item_id IN (FROM fine)
    """,
    "semi_anti_split": """
        SELECT 'inner' AS kind, count(*) AS n, sum(doc_id)::BIGINT AS id_sum FROM documents JOIN labels USING (doc_id)
        UNION ALL SELECT 'semi', count(*), sum(doc_id)::BIGINT FROM documents
          WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id)
        UNION ALL SELECT 'anti', count(*), sum(doc_id)::BIGINT FROM documents
          WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id)
        UNION ALL SELECT 'difference', count(*), sum(doc_id)::BIGINT
          FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
    """,
    "language_filter": """
        SELECT nullif(lang, 'de') AS lang, source, count(*) AS n, sum(n_chars)::BIGINT AS chars
        FROM documents WHERE lang IN ('de', 'en') GROUP BY 1, 2
    """,
    "json_expand": """
        SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n,
               sum((props->>'k')::INTEGER)::BIGINT AS k_sum, sum((props->>'k')::INTEGER)::BIGINT AS year_sum,
               0::BIGINT AS no_numbers, count(props->>'absent') AS absents
        FROM events GROUP BY 1, 2
    """,
    "section_text": f"""
        WITH lines AS (
            SELECT conv_id, turn, role, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
            FROM (SELECT conv_id, turn, role,
                         CASE WHEN role = 'user' THEN list_append(string_split(text, chr(10)), role)
                              ELSE string_split(text, chr(10)) END AS ls
                  FROM conversations WHERE role IN ('assistant', 'user'))),
        kept AS (
            SELECT conv_id, turn, role, string_agg(line, chr(10) ORDER BY i)
                     FILTER (WHERE NOT contains(lower(line), {quoted(q.SECTION_PLACEHOLDERS[0])})
                               AND NOT contains(lower(line), {quoted(q.SECTION_PLACEHOLDERS[1])})) AS body
            FROM lines GROUP BY 1, 2, 3)
        SELECT conv_id, turn, body || chr(10) AS body, CASE WHEN role = 'user' THEN 'user,user' END AS images
        FROM kept WHERE body IS NOT NULL OR role = 'user'
    """,
    "strip_markers": """
        SELECT doc_id, md5(t) AS digest, length(t)::BIGINT AS n_chars
        FROM (SELECT doc_id, regexp_replace(text || '[' || doc_id || '][] [x]' || text, '\\[[0-9]*\\]', '', 'g') AS t
              FROM documents)
    """,
    "longer_text": """
        WITH d AS (SELECT doc_id, CASE WHEN lang <> 'es' THEN text END AS text FROM documents)
        SELECT d.doc_id AS id,
               md5(CASE WHEN b.text IS NULL THEN d.text WHEN length(d.text) > length(b.text) THEN d.text
                        ELSE b.text END) AS longer,
               length(coalesce(b.text, d.text))::BIGINT AS overridden_chars
        FROM d LEFT JOIN benchmark b ON d.doc_id = b.item_id
    """,
    "keyword_tokens": f"""
        SELECT doc_id, count(w) AS n_words, md5(string_agg(w, ' ' ORDER BY w)) AS digest
        FROM (SELECT DISTINCT doc_id, CASE WHEN w NOT IN ({value_list(fixed.STOP_WORDS)}) THEN w END AS w
              FROM (SELECT doc_id, unnest(list_append({words_of("text || ' ' || source")}, NULL)) AS w FROM documents))
        GROUP BY doc_id
    """,
    "keyword_lists": """
        WITH p AS (SELECT page_id, url, string_split(split_part(url, '://', -1), '/') AS path FROM pages),
        k AS (SELECT *,
                list_filter(cleaned, lambda t: NOT (starts_with(t, 'm.') OR starts_with(t, 'u9') OR starts_with(t, 'blog')))
                  AS keywords,
                list_filter(path, lambda t: t NOT IN ('en', 'fr')) AS tags
              FROM (SELECT *, list_transform(path, lambda t: translate(t, '#"', '')) AS cleaned FROM p)),
        m AS (SELECT *, list_filter(tags, lambda t: t = 'es') AS es,
                CASE WHEN starts_with(url, 'https') THEN [] ELSE keywords END AS base,
                nullif(path[2], 'de') AS label FROM k)
        SELECT page_id,
               array_to_string(keywords, '|') AS keywords,
               array_to_string(tags, '|') AS tags,
               replace(split_part(url, '/', -1), '-', ' ') || '|'
                 || replace(split_part(replace(url, '.', '-'), '/', -1), '-', ' ') AS slugs,
               array_to_string(list_sort(list_distinct(list_concat(tags, keywords))), '|') AS united,
               array_to_string(list_concat(es, keywords), '|') AS merged,
               array_to_string(CASE WHEN label IS NULL THEN
                                 (CASE WHEN starts_with(url, 'https') THEN [''] ELSE keywords END)
                               ELSE list_append(base, label) END, '|') AS labelled,
               array_to_string(list_sort(list_distinct(path)), '|') AS sorted_path
        FROM m
    """,
    "token_counts": f"""
        WITH c AS (SELECT w AS tag, count(*) AS n
                   FROM (SELECT unnest({words_of('text')}) AS w FROM documents) GROUP BY w)
        SELECT 'word' AS kind, tag, n FROM c
        UNION ALL SELECT 'total', NULL, sum(n)::BIGINT FROM c
        UNION ALL SELECT 'distinct', NULL, count(*) FROM c
    """,
    "inverted_index": f"""
        SELECT label, part, count(*) AS n, string_agg(id::VARCHAR, ' ' ORDER BY nth) AS ids,
               string_agg(score::VARCHAR, ' ' ORDER BY nth) AS scores
        FROM (SELECT *, ((nth - 1) // {q.LIST_ROWS})::BIGINT AS part
              FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, id) AS nth
                    FROM ({_WORD_COUNTS})))
        GROUP BY label, part
    """,
    "label_universe": f"SELECT DISTINCT label FROM ({_WORD_COUNTS})",
    "entity_keywords": """
        WITH w AS (SELECT doc_id, unnest(ws) AS form, generate_subscripts(ws, 1) - 1 AS pos
                   FROM (SELECT doc_id, string_split(text, ' ') AS ws FROM documents)),
        f AS (SELECT doc_id, form, min(pos) AS pos, nullif(length(form), 7) AS score FROM w
              WHERE form NOT IN ('the', 'la', 'der') GROUP BY doc_id, form)
        SELECT doc_id,
               md5(string_agg(form, ' ' ORDER BY score DESC NULLS LAST, form)) AS keywords,
               md5(string_agg(coalesce(score::VARCHAR, '-'), ' ' ORDER BY score DESC NULLS LAST, form)) AS scores,
               md5(string_agg(pos::VARCHAR, ' ' ORDER BY score DESC NULLS LAST, form)) AS links
        FROM f GROUP BY doc_id
    """,
    "first_per_key": """
        SELECT user_id, event_type, event_id, value,
               row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_type) AS position
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth FROM events)
        WHERE nth = 1
    """,
    "struct_fields": """
        WITH d AS (SELECT doc_id, CASE WHEN lang <> 'es' THEN string_split(text, chr(10)) END AS ls FROM documents),
        l AS (SELECT doc_id, ls, list_transform(ls, lambda x: nullif(x, '')) AS labels FROM d)
        SELECT doc_id,
               md5(coalesce(array_to_string(list_transform(labels, lambda x: coalesce(x, '-')), '|'), '')) AS labels,
               coalesce(array_to_string(list_transform(ls[1:5], lambda x: length(x)::VARCHAR), '|'), '') AS sizes,
               md5(labels[1]) AS first_label,
               md5(nullif(array_to_string(list_filter(labels, lambda x: x IS NOT NULL), '|'), '')) AS plucked
        FROM l
    """,
    "pylist_roundtrip": """
        SELECT CASE WHEN l_linenumber = 7 THEN '' ELSE l_returnflag || '+' || l_linestatus || '+' || l_linenumber END AS names,
               CASE WHEN l_linenumber = 7 THEN 0 ELSE 3 END::BIGINT AS n_names, count(*) AS n,
               sum(l_quantity::BIGINT)::BIGINT AS first_sum, sum(l_linenumber)::BIGINT AS second_sum
        FROM lineitem GROUP BY 1, 2
    """,
    "page_links": f"""
        WITH a AS ({_ANCHORS}),
        e AS (SELECT page_id, list(v ORDER BY i) FILTER (WHERE NOT contains(v, 'example.net')) AS els,
                     list(v ORDER BY i) AS every FROM a GROUP BY page_id)
        SELECT p.page_id, r.ref_net, r.ref_org, r.ref_other,
               array_to_string(e.els[1:6], ' ') AS elsewhere,
               array_to_string(list_concat(coalesce(e.els[1:6], []), coalesce(e.every[1:3], []))[1:4], ' ') AS topped_up,
               coalesce(r.ref_net, r.ref_org, r.ref_other) IS NOT NULL AS has_refs
        FROM pages p LEFT JOIN e USING (page_id) LEFT JOIN ({_REFS}) r USING (page_id)
    """,
    "page_refs_only": f"SELECT page_id, ref_net, ref_org, ref_other FROM ({_REFS})",
    "page_meta": """
        WITH p AS (SELECT *, ends_with(url, '.html') AS failed, contains(url, 'utm_source') AS bare FROM pages)
        SELECT page_id, CASE WHEN failed THEN 404 ELSE 200 END::INTEGER AS code,
               CASE WHEN failed THEN 0 WHEN NOT bare THEN length(html) END::INTEGER AS views,
               CASE WHEN failed THEN '' WHEN NOT bare THEN split_part(url, '/', -1) END AS author,
               CASE WHEN failed THEN '' WHEN NOT bare THEN 'u' || page_id END AS updater,
               CASE WHEN failed THEN ''
                    WHEN NOT bare THEN strftime(DATE '2020-01-01' + page_id::INTEGER, '%Y-%m-%d') END AS added,
               CASE WHEN failed THEN '' WHEN NOT bare THEN '2021-05-06' END AS updated
        FROM p
    """,
    "flags": """
        SELECT coalesce(d.doc_id, l.doc_id) AS id, d.lang, l.doc_id IS NOT NULL AS has_label,
               coalesce(d.doc_id, l.doc_id) IN (SELECT item_id FROM benchmark) AS has_item,
               ((d.lang IS NULL)::INTEGER + (l.quality IS NULL)::INTEGER + (l.toxic IS NULL)::INTEGER)::BIGINT AS n_missing
        FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id
    """,
    "fill_and_drop": """
        WITH e AS (SELECT lang, quality::VARCHAR AS grade FROM documents LEFT JOIN labels USING (doc_id))
        SELECT lang, coalesce(grade, 'unknown') AS grade, count(*) AS n, 'filled' AS kind FROM e GROUP BY 1, 2
        UNION ALL SELECT lang, grade, count(*), 'complete' FROM e WHERE grade IS NOT NULL GROUP BY 1, 2
    """,
    "date_reconcile": """
        WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS d,
                          nullif(EXTRACT(YEAR FROM o_orderdate), 1997) AS y FROM orders),
        l AS (SELECT l_orderkey AS id, min(l_shipdate)::DATE AS a, max(l_shipdate)::DATE AS u FROM lineitem GROUP BY 1),
        r AS (SELECT id, y, coalesce(least(d, a), greatest(d, u)) AS added, greatest(d, u) AS updated
              FROM o LEFT JOIN l USING (id))
        SELECT id, strftime(added, '%Y-%m-%d') AS added, strftime(updated, '%Y-%m-%d') AS updated,
               coalesce(y, EXTRACT(YEAR FROM added))::INTEGER AS year FROM r
    """,
    "null_out_names": f"""
        WITH low AS (SELECT c_name FROM customer ORDER BY c_name, c_custkey LIMIT {fixed.LOWEST_NAMES_DROPPED})
        SELECT c_custkey AS id,
               CASE WHEN c_name NOT IN (FROM low) AND c_name <> 'Customer#000000100' THEN c_name END AS author,
               CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS updater
        FROM customer
    """,
    "person_rollup": """
        WITH o AS (SELECT o_orderkey AS id, nullif(o_custkey, 1) AS person,
                          nullif(round(o_totalprice)::BIGINT, 0) AS views FROM orders WHERE o_custkey <> 1),
        n AS (SELECT *, row_number() OVER (PARTITION BY person ORDER BY views DESC NULLS LAST, id) AS nth FROM o),
        t AS (SELECT person, count(*) AS meme_counts, coalesce(sum(views), 0)::BIGINT AS tot_views FROM o GROUP BY 1)
        SELECT person, ((nth - 1) // 10)::BIGINT AS part, string_agg(id::VARCHAR, ' ' ORDER BY nth) AS meme_ids,
               any_value(meme_counts) AS meme_counts, any_value(tot_views) AS tot_views
        FROM n JOIN t USING (person) GROUP BY person, part
    """,
    "sibling_closure": f"""
        WITH e AS (SELECT src, dst FROM ({_PART_SIBLINGS})
                   WHERE src NOT IN (SELECT p_partkey::VARCHAR FROM part WHERE p_type = 'SMALL')
                     AND dst IN (SELECT p_partkey::VARCHAR FROM part WHERE p_type <> 'SMALL')),
        s AS (SELECT src AS id, dst AS sibling FROM e
              UNION SELECT dst, src FROM e
              UNION SELECT a.dst, b.dst FROM e a JOIN e b ON a.src = b.src WHERE a.dst <> b.dst)
        SELECT id, string_agg(sibling, ' ' ORDER BY sibling) AS siblings
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sibling) AS nth FROM s) WHERE nth <= 5
        GROUP BY id
    """,
    "sibling_groups": f"""
        WITH e AS ({_PART_SIBLINGS}),
        m AS (SELECT src AS g, dst AS member FROM e UNION SELECT src, src FROM e),
        s AS (SELECT g, list(member ORDER BY member) AS members FROM m GROUP BY g),
        d AS (SELECT members, min(g) AS group_id FROM s GROUP BY members)
        SELECT group_id, unnest(members) AS member FROM d
    """,
    "sibling_sets": """
        WITH s AS (SELECT l_orderkey AS g, list(DISTINCT l_partkey ORDER BY l_partkey) AS members
                   FROM lineitem GROUP BY 1),
        d AS (SELECT members, min(g) AS group_id FROM s GROUP BY members)
        SELECT group_id, any_value(length(members)) AS n_members, count(DISTINCT p_brand) AS n_parents,
               min(p_brand) AS parent
        FROM (SELECT group_id, members, unnest(members) AS m FROM d) LEFT JOIN part ON m = p_partkey
        GROUP BY group_id
    """,
    "list_order": """
        SELECT page_id, row_number() OVER (ORDER BY path, page_id) AS position, array_to_string(path, ' ') AS path
        FROM (SELECT page_id, string_split(url, '/') AS path FROM pages)
    """,
    "parent_child": f"""
        WITH {_FAMILY},
        n AS (SELECT parent AS id, child, ((row_number() OVER (PARTITION BY parent ORDER BY child) - 1) // 50)::BIGINT AS part
              FROM children),
        c AS (SELECT id, part, string_agg(child, ' ' ORDER BY child) AS children FROM n GROUP BY 1, 2)
        SELECT coalesce(c.id, p.id) AS id, coalesce(c.part, 0)::BIGINT AS part, {_BAND} AS parent, children
        FROM c FULL JOIN parents p ON c.id = p.id AND c.part = 0
    """,
    "family_edges": f"""
        WITH {_FAMILY}
        SELECT 'Meme_name' AS src_kind, id AS src, 'BELONGS_TO' AS relation, 'Meme_parent' AS dst_kind, parent AS dst
        FROM parents
        UNION ALL SELECT 'Meme_name', parent, 'IS_PARENT_TO', 'Meme_children', child FROM children
    """,
    "parent_check": f"""
        WITH {_FAMILY}
        SELECT count(*) FILTER (WHERE p.parent IS NULL) AS no_parent,
               count(*) FILTER (WHERE p.parent <> c.parent) AS other_parent
        FROM children c LEFT JOIN parents p ON c.child = p.id
    """,
    "graph_nodes": """
        SELECT DISTINCT 'Meme_name' AS kind, o_orderkey::VARCHAR AS key,
               '{"views":"' || o_totalprice::DECIMAL(18,2) || '"}' AS properties FROM orders
        UNION ALL SELECT DISTINCT 'Meme_author', o_custkey::VARCHAR, '{}' FROM orders
        UNION ALL SELECT DISTINCT 'Recent_update', strftime(o_orderdate, '%Y-%m-%d'), '{}' FROM orders
        UNION ALL SELECT DISTINCT 'Meme_template', o_orderpriority, '{}' FROM orders WHERE o_orderpriority <> '5-LOW'
        UNION ALL SELECT DISTINCT 'Meme_siblings', l_partkey::VARCHAR, '{}' FROM lineitem
    """,
    "graph_edges": """
        WITH f AS (SELECT DISTINCT l_orderkey AS id, l_partkey AS k
                   FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber) AS nth
                         FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem))
                   WHERE nth <= 5)
        SELECT 'IS_CREATED_BY' AS relation, 'Meme_author' AS dst_kind, count(*) AS n,
               count(DISTINCT o_orderkey) AS n_src, count(DISTINCT o_custkey) AS n_dst FROM orders
        UNION ALL SELECT 'CREATED', 'Meme_name', count(*), count(DISTINCT o_custkey), count(DISTINCT o_orderkey) FROM orders
        UNION ALL SELECT 'BASED_ON', 'Meme_template', count(*), count(DISTINCT o_orderkey), count(DISTINCT o_orderpriority)
          FROM orders WHERE o_orderpriority <> '5-LOW'
        UNION ALL SELECT 'RECENTLY_UPDATED_ON', 'Recent_update', count(*), count(DISTINCT o_orderkey),
                         count(DISTINCT o_orderdate::DATE) FROM orders
        UNION ALL SELECT 'IS_RELATED_TO', 'Meme_siblings', count(*), count(DISTINCT id), count(DISTINCT k) FROM f
    """,
    "list_edges": """
        SELECT DISTINCT 'Meme_name' AS src_kind, conv_id::VARCHAR AS src, 'CONTAINS' AS relation,
               'image_recogn_labels' AS dst_kind, unnest(string_split(text, ' ')[1:5]) AS dst FROM conversations
        UNION ALL
        SELECT DISTINCT 'Meme_name', conv_id::VARCHAR, 'IS_SIMILAR_TO_FOREIGN_LINK', 'Similar_images',
               unnest(string_split(text, chr(10))) FROM conversations WHERE contains(text, chr(10))
    """,
    "new_nodes": """
        SELECT DISTINCT 'Meme_name' AS kind, doc_id::VARCHAR AS key, '{}' AS properties FROM labels
        WHERE doc_id NOT IN (SELECT item_id FROM benchmark)
    """,
    "constraint_report": """
        SELECT 'orders_key' AS check_name, count(*) AS n_keys, coalesce(sum(n), 0)::BIGINT AS n_rows
          FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
        UNION ALL SELECT 'lineitem_order_key', count(*), coalesce(sum(n), 0)::BIGINT
          FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)
        UNION ALL SELECT 'labels_missing', count(*), count(*) FROM labels WHERE doc_id IS NULL OR quality IS NULL
        UNION ALL SELECT 'orders_customer', count(DISTINCT o_custkey), count(*) FROM orders
          WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT 'documents_label', count(DISTINCT doc_id), count(*) FROM documents
          WHERE doc_id NOT IN (SELECT doc_id FROM labels)
        UNION ALL SELECT 'customer_orders', count(DISTINCT c_custkey), count(*) FROM customer
          WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
        UNION ALL SELECT 'too_long', count(*), coalesce(sum(n), 0)::BIGINT
          FROM (SELECT count(*) AS n FROM documents WHERE length(text) > 1000
                UNION ALL SELECT count(*) FROM documents WHERE length(source) > 255) WHERE n > 0
    """,
    "too_long_rows": """
        SELECT doc_id, source, n_chars FROM documents WHERE length(text) > 1000 OR length(source) > 4
    """,
    "profile": """
        WITH d AS (SELECT doc_id, text, nullif(lang, 'es') AS lang, source, n_chars, 'document' AS kind FROM documents)
        SELECT 'doc_id' AS column_name, 'bigint' AS type, count(*) - count(doc_id) AS missing,
               count(DISTINCT doc_id) < 2 AS single_value, count(*) AS table_rows FROM d
        UNION ALL SELECT 'text', 'string', count(*) - count(text), count(DISTINCT text) < 2, count(*) FROM d
        UNION ALL SELECT 'lang', 'string', count(*) - count(lang), count(DISTINCT lang) < 2, count(*) FROM d
        UNION ALL SELECT 'source', 'string', count(*) - count(source), count(DISTINCT source) < 2, count(*) FROM d
        UNION ALL SELECT 'n_chars', 'bigint', count(*) - count(n_chars), count(DISTINCT n_chars) < 2, count(*) FROM d
        UNION ALL SELECT 'kind', 'string', count(*) - count(kind), count(DISTINCT kind) < 2, count(*) FROM d
    """,
    "delimited_roundtrip": """
        SELECT doc_id, md5(text) AS digest, lang, n_chars, nullif(source, 'src1') AS source FROM documents
    """,
    "keyed_roundtrip": "SELECT doc_id, md5(text) AS digest, nullif(lang, 'de') AS lang FROM documents",
    "append_and_create": """
        SELECT 'records' AS name, count(*) AS n, sum(o_custkey)::BIGINT AS total FROM orders
        UNION ALL SELECT 'persons', count(DISTINCT o_custkey), count(*)::BIGINT FROM orders
    """,
}
