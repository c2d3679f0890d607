"""Plain SQL for the queries of ``derived_catalogue``."""

from __future__ import annotations

from catalog_engine import fixed_values as fixed
from catalog_engine.plans.derived_catalogue import BASE, HUB, HUB_LIST
from catalog_engine.plans.comparison_sql import quoted, value_list, words_of

_DENIED = " OR ".join(f"contains(title, {quoted(w)})" for w in fixed.TITLE_DENY_LIST)

_CATALOGUE = f"""
    WITH e AS (SELECT doc_id AS n, 'd' || doc_id AS id, lang, source, text, source || ' ' || split_part(text, chr(10), 1) AS title
               FROM documents WHERE lang IN ('en', 'fr', 'de')),
    c AS (SELECT * FROM e WHERE NOT ({_DENIED})),
    clean AS (SELECT * FROM c WHERE id NOT IN (SELECT id FROM c ORDER BY id LIMIT {fixed.LOWEST_IDS_DROPPED})),
    kept AS (SELECT clean.*, quality FROM clean JOIN labels ON n = doc_id WHERE quality = 1 AND toxic = 0),
    b AS (SELECT item_id AS n, text AS item,
                 list_filter(string_split(text, ' '), lambda w: w NOT IN ({value_list(fixed.DROPPED_ENTITIES)})) AS forms
          FROM benchmark),
    j AS (SELECT kept.*, item, CASE WHEN length(forms) > 0 THEN forms END AS forms,
                 c_custkey, floor(c_acctbal)::INTEGER AS views, c_mktsegment AS segment, 'nation' || c_nationkey AS nation,
                 regexp_replace(text || chr(10), '\\[[0-9]*\\]', '', 'g') AS about,
                 split_part(text, chr(10), 1) AS short,
                 CASE WHEN lang <> 'fr' THEN DATE '1970-01-01' + ((1290000000 + kept.n * 3600) // 86400)::INTEGER END AS a1,
                 DATE '1970-01-01' + ((1300000000 + kept.n * 86400) // 86400)::INTEGER AS updated
          FROM kept LEFT JOIN b ON kept.n = b.n LEFT JOIN customer ON kept.n = c_custkey),
    low AS (SELECT segment FROM j WHERE segment IS NOT NULL ORDER BY segment, id LIMIT {fixed.LOWEST_NAMES_DROPPED}),
    d AS (SELECT *, coalesce(least(a1, CASE WHEN c_custkey IS NOT NULL THEN DATE '2010-01-01' END), updated) AS added FROM j),
    parents AS (SELECT x.id, y.id AS parent FROM kept x JOIN kept y ON y.n = x.n // 10 WHERE x.n > 0),
    lists AS (SELECT id AS g, unnest(CASE WHEN n = {HUB} THEN range(1, {HUB_LIST} + 1) WHEN lang = 'en' THEN [n + 1] END) AS k
              FROM clean),
    known AS (SELECT g, y.id AS member FROM lists JOIN clean y ON y.n = k WHERE y.id <> g),
    members AS (SELECT g, member FROM (SELECT g, member FROM known UNION SELECT g, g FROM known)
                WHERE member IN (SELECT id FROM kept)),
    sets AS (SELECT all_members, min(g) AS group_id
             FROM (SELECT g, list(member ORDER BY member) AS all_members FROM members GROUP BY g) GROUP BY all_members),
    sibs AS (SELECT DISTINCT a.member AS id, b.member AS s FROM members a JOIN members b ON a.g = b.g AND a.member <> b.member),
    firsts AS (SELECT * FROM (SELECT id, s, row_number() OVER (PARTITION BY id ORDER BY s) AS position FROM sibs)
               WHERE position <= {fixed.LIST_EDGES}),
    related AS (SELECT id FROM parents UNION SELECT parent FROM parents UNION SELECT id FROM sibs),
    main AS (
        SELECT n, id, lang, source, a1,
               CASE WHEN item <> '' THEN item WHEN length(short) > length(about) THEN short ELSE about END AS description,
               views, CASE WHEN segment NOT IN (FROM low) THEN segment END AS author,
               CASE WHEN nation NOT IN (FROM low) THEN nation END AS updater, added, updated,
               CASE WHEN lang = 'de' THEN EXTRACT(YEAR FROM added) ELSE 2011 END::INTEGER AS year,
               id IN (FROM related) AS has_relations, true AS has_other_texts, lang = 'en' AS has_refs,
               forms IS NOT NULL AS has_DBpedia,
               ['quality1', 'label'] AS labels,
               list_sort(list_distinct(list_filter(
                 list_concat({words_of("lang || 'tag ' || source || ' guess it x Web'")},
                             coalesce({words_of("array_to_string(forms, ' ')")}, [])),
                 lambda w: w NOT IN ({value_list(fixed.STOP_WORDS)})))) AS keywords
        FROM d)
"""

_PERSONS = """
    SELECT kind, person, ((nth - 1) // 10000)::BIGINT AS part, string_agg(id, ' ' ORDER BY nth) AS meme_ids,
           any_value(meme_counts) AS meme_counts, any_value(tot_views) AS tot_views
    FROM (SELECT *, row_number() OVER (PARTITION BY kind, person ORDER BY views DESC NULLS LAST, id) AS nth,
                 count(*) OVER (PARTITION BY kind, person) AS meme_counts,
                 coalesce(sum(views) OVER (PARTITION BY kind, person), 0)::BIGINT AS tot_views
          FROM (SELECT 'authors' AS kind, author AS person, id, views FROM main WHERE author IS NOT NULL
                UNION ALL SELECT 'updaters', updater, id, views FROM main WHERE updater IS NOT NULL))
    GROUP BY kind, person, part
"""

_GRAPH = f""",
    whole AS (SELECT * FROM main WHERE author IS NOT NULL AND updater IS NOT NULL AND views IS NOT NULL),
    family AS (SELECT r.id, coalesce(p.parent, 'unknown') AS parent FROM related r LEFT JOIN parents p USING (id)),
    beside AS (SELECT r.id, coalesce(f.s, 'unknown') AS s FROM related r LEFT JOIN firsts f USING (id)),
    day AS (SELECT id, strftime(updated, '%Y-%m-%d') AS d FROM whole),
    nodes AS (
        SELECT 'Meme_name' AS kind, id AS key,
               '{{"url":"{BASE}' || n || '","views":"' || views || '"}}' AS properties FROM whole
        UNION ALL SELECT 'Meme_name', id, '{{}}' FROM main WHERE id NOT IN (SELECT id FROM whole)
        UNION ALL SELECT DISTINCT 'Meme_author', author, '{{}}' FROM whole
        UNION ALL SELECT DISTINCT 'Recent_update', d, '{{}}' FROM day
        UNION ALL SELECT DISTINCT 'Meme_template', 'http://template/' || source, '{{}}' FROM whole
        UNION ALL SELECT DISTINCT 'Meme_parent', parent, '{{}}' FROM family
        UNION ALL SELECT DISTINCT 'Meme_siblings', s, '{{}}' FROM beside
        UNION ALL SELECT DISTINCT 'image_recogn_labels', unnest(labels), '{{}}' FROM main),
    edges AS (
        SELECT 'Meme_name' AS src_kind, id AS src, 'IS_CREATED_BY' AS relation, 'Meme_author' AS dst_kind, author AS dst FROM whole
        UNION ALL SELECT 'Meme_name', id, 'BASED_ON', 'Meme_template', 'http://template/' || source FROM whole
        UNION ALL SELECT 'Meme_name', id, 'RECENTLY_UPDATED_ON', 'Recent_update', d FROM day
        UNION ALL SELECT 'Meme_author', author, 'CREATED', 'Meme_name', id FROM whole
        UNION ALL SELECT 'Meme_name', id, 'IS_CHILD_OF', 'Meme_parent', parent FROM family
        UNION ALL SELECT 'Meme_name', id, 'IS_RELATED_TO', 'Meme_siblings', s FROM beside
        UNION ALL SELECT 'Meme_name', id, 'CONTAINS', 'image_recogn_labels', unnest(labels) FROM main)
"""

CATALOGUE_COMPARISONS: dict[str, str] = {
    "catalogue_main": f"""{_CATALOGUE}
        SELECT id, md5(description) AS description, views, author, updater,
               strftime(added, '%Y-%m-%d') AS added, strftime(updated, '%Y-%m-%d') AS updated, year,
               has_relations, has_other_texts, has_refs, has_DBpedia, lang AS status, 'UNLIKELY' AS adult,
               'http://a/' || n || ' http://b/1 http://b/2' AS alt_img_urls,
               array_to_string(labels, ' ') AS labels, array_to_string(keywords, ' ') AS keywords
        FROM main
    """,
    "catalogue_relations": f"""{_CATALOGUE},
        children AS (SELECT parent AS id, string_agg(id, ' ' ORDER BY id) AS children FROM parents GROUP BY parent)
        SELECT coalesce(p.id, c.id) AS id, 0::BIGINT AS part, parent, children
        FROM parents p FULL JOIN children c ON p.id = c.id
    """,
    "catalogue_sibling_groups": f"{_CATALOGUE} SELECT group_id, unnest(all_members) AS member FROM sets",
    "catalogue_siblings": f"{_CATALOGUE} SELECT id, s AS sibling, position FROM firsts",
    "catalogue_refs": f"""{_CATALOGUE}
        SELECT id, 'http://en.wikipedia.org/' || n AS ref_wikipedia, NULL::VARCHAR AS ref_urban_dict,
               NULL::VARCHAR AS ref_encyc_dramatica, NULL::VARCHAR AS ref_meme_generator, NULL::VARCHAR AS ref_reddit,
               NULL::VARCHAR AS ref_twitter, NULL::VARCHAR AS ref_other
        FROM kept WHERE lang = 'en'
    """,
    "catalogue_textual": f"""{_CATALOGUE}
        SELECT id, NULL::VARCHAR AS origins, md5(regexp_replace(text || chr(10), '\\[[0-9]*\\]', '', 'g')) AS spread,
               NULL::VARCHAR AS search_interest
        FROM kept
    """,
    "catalogue_labels": f"""{_CATALOGUE},
        rows AS (SELECT 'label' AS label, id, n::DOUBLE AS score FROM kept UNION ALL SELECT 'quality1', id, 0.5 FROM kept)
        SELECT label, part, string_agg(id, ' ' ORDER BY nth) AS memes, string_agg((10 * score)::BIGINT::VARCHAR, ' ' ORDER BY nth) AS scores
        FROM (SELECT *, ((nth - 1) // 10000)::BIGINT AS part
              FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, id) AS nth FROM rows))
        GROUP BY label, part
    """,
    "catalogue_dbpedia": f"""{_CATALOGUE}
        SELECT id, array_to_string(list_sort(list_distinct(forms)), ' ') AS keywords FROM j WHERE forms IS NOT NULL
    """,
    "catalogue_per_year": f"{_CATALOGUE} SELECT EXTRACT(YEAR FROM added)::INTEGER AS year, count(*) AS n FROM main GROUP BY 1",
    "catalogue_people": f"{_CATALOGUE} {_PERSONS}",
    "catalogue_graph": f"""{_CATALOGUE} {_GRAPH}
        SELECT kind, count(*) AS n FROM nodes GROUP BY kind
        UNION ALL SELECT relation, count(*) FROM edges GROUP BY relation
    """,
    "catalogue_nodes": f"{_CATALOGUE} {_GRAPH} SELECT * FROM nodes",
    "catalogue_edges": f"{_CATALOGUE} {_GRAPH} SELECT * FROM edges",
    "catalogue_constraints": f"""{_CATALOGUE},
        a AS (SELECT DISTINCT author FROM main WHERE author IS NOT NULL),
        u AS (SELECT DISTINCT updater FROM main WHERE updater IS NOT NULL)
        SELECT 'memes_key' AS check_name, count(*) AS n_keys, coalesce(sum(c), 0)::BIGINT AS n_rows
          FROM (SELECT count(*) AS c FROM main GROUP BY id HAVING count(*) > 1)
        UNION ALL SELECT 'authors_key', count(*), coalesce(sum(c), 0)::BIGINT
          FROM (SELECT count(*) AS c FROM a GROUP BY author HAVING count(*) > 1)
        UNION ALL SELECT 'updaters_key', count(*), coalesce(sum(c), 0)::BIGINT
          FROM (SELECT count(*) AS c FROM u GROUP BY updater HAVING count(*) > 1)
        UNION ALL SELECT 'memes_author', count(DISTINCT author), count(author) FROM main WHERE author NOT IN (FROM a)
        UNION ALL SELECT 'memes_updater', count(DISTINCT updater), count(updater) FROM main WHERE updater NOT IN (FROM u)
    """,
}

_MAIN = CATALOGUE_COMPARISONS["catalogue_main"]
CATALOGUE_COMPARISONS |= {
    "job_main": _MAIN,
    "job_split_main": _MAIN,
    "job_tables": f"""{_CATALOGUE},
        persons AS ({_PERSONS}),
        written AS (
            SELECT 'refs' AS name, id AS key FROM kept WHERE lang = 'en'
            UNION ALL SELECT 'textual', id FROM kept
            UNION ALL SELECT 'relations', id FROM (SELECT id FROM parents UNION SELECT parent FROM parents)
            UNION ALL SELECT 'sibling_groups', group_id FROM (SELECT group_id, unnest(all_members) FROM sets)
            UNION ALL SELECT 'DBpedia', id FROM j WHERE forms IS NOT NULL
            UNION ALL SELECT unnest(['label', 'quality1']), part::VARCHAR
                FROM (SELECT DISTINCT (row_number() OVER (ORDER BY id) - 1) // 10000 AS part FROM kept)
            UNION ALL SELECT kind, person FROM persons),
        named AS (SELECT CASE WHEN name IN ('label', 'quality1') THEN 'labels' ELSE name END AS name,
                         CASE WHEN name IN ('label', 'quality1') THEN name ELSE key END AS key FROM written)
        SELECT name, count(key) AS n, count(DISTINCT key) AS n_keys FROM named GROUP BY name
        UNION ALL SELECT 'similar_img_urls', 0, 0
    """,
    "raw_vision_file": f"""
        SELECT '{BASE}' || doc_id AS id, CASE WHEN toxic = 1 THEN 'VERY_LIKELY' ELSE 'UNLIKELY' END AS adult,
               CASE WHEN quality = 0 THEN 'bad' END AS error, 'quality' || quality || ' label' AS labels,
               'http://{fixed.OWN_IMAGE_HOST}/x http://a/' || doc_id AS links
        FROM labels
    """,
    "raw_entry_file": f"""
        SELECT '{BASE}' || doc_id AS url, CASE WHEN lang IN ('en', 'fr', 'de') THEN 'Meme' ELSE 'Person' END AS category,
               CASE WHEN doc_id > 0 THEN '{BASE}' || (doc_id // 10) END AS parent,
               CASE WHEN doc_id = {HUB} THEN {HUB_LIST} WHEN lang = 'en' THEN 1 END::INTEGER AS n_siblings, md5(text) AS about,
               length(string_split(text, chr(10)))::INTEGER AS n_lines
        FROM documents
    """,
    "raw_log_file": """
        SELECT 'd' || c_custkey AS id, c_custkey::INTEGER AS row_no, 200 AS code, floor(c_acctbal)::INTEGER AS views,
               c_name AS author, nullif(c_mktsegment, 'BUILDING') AS updater,
               strftime(DATE '2010-01-01' + c_custkey::INTEGER, '%Y-%m-%d') AS added, NULL::VARCHAR AS updated, true AS whole
        FROM customer
    """,
}
