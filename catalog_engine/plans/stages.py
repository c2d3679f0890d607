"""The catalogue build: clean entries, add recognition, entities and people, deliver tables and graph.

Every stage takes and gives tables by name. A table that several later tables
are made from is stored in the shared folder, so it is built once; a table that
nothing else needs is built when it is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog_engine import fixed_values as fixed, schemas
from catalog_engine.functions import dates, links, lists, text
from catalog_engine.operators import filters, graph, inverted, joins, people, quality, relations, report
from catalog_engine.operators.groups import LIST_ROWS, keep_first, later_copies, text_key
from catalog_engine.session import cut
from catalog_engine.sources.buckets import bucket_count, cut_by
from catalog_engine.sources.read import with_ordinal
from catalog_engine.sources.write import as_table

REF_COLUMNS = [name for name, _ in fixed.LINK_SITES] + [fixed.LINK_OTHER]
TEXT_COLUMNS = ["origins", "spread", "search_interest"]



class Tables(dict):
    """Tables by name; one that is given as a function is built when it is first asked for.

    ``buckets`` is the number of buckets of all tables that are stored by id.
    """

    def __init__(self, tables: dict, buckets: int = 1):
        super().__init__(tables)
        self.buckets = buckets

    def __getitem__(self, name: str) -> DataFrame:
        found = super().__getitem__(name)
        if not isinstance(found, DataFrame):
            found = self[name] = found()
        return found

    def with_tables(self, **more) -> Tables:
        """These tables and more; nothing is built for it."""
        return Tables({**dict(dict.items(self)), **more}, self.buckets)


def clean_entries(
    entries: DataFrame,
    category: str = fixed.ENTRY_CATEGORY,
    deny_list: list[str] = fixed.TITLE_DENY_LIST,
    lowest: int = fixed.LOWEST_IDS_DROPPED,
    excluded_urls: list[str] = fixed.EXCLUDED_URLS,
) -> Tables:
    """Raw entries -> main, refs, textual and edges.

    Of equal entries the first of the source stays: by file and place in it where
    the reader gives them (``file``, ``nth``), else in the order of Spark's reading.
    """
    order = ["file", "nth"] if {"file", "nth"} <= set(entries.columns) else ["ordinal"]
    # All row filters look at title and link only, which equal copies share, so
    # they run before the shuffle that finds the copies.
    # Numbers come after the category filter, which can then reach the scan; the order stays.
    fit = filters.keep_category(entries, "category", category).drop("category")
    fit = with_ordinal(fit) if order == ["ordinal"] else fit
    fit = filters.deny_titles(fit, "title", deny_list)
    key = text_key("title", "url")
    if order == ["ordinal"]:
        fit = filters.exclude_lowest_ids(fit, "url", lowest, among=fit.select("title", "url").distinct())
        fit = filters.exclude_values(fit, "url", excluded_urls)
        # Numbers given while reading may differ between two readings; places in a file do not.
        kept = keep_first(fit, [key], [F.col("ordinal")])
    else:
        # Titles may be long, and are read once for what is looked up several times.
        keyed = cut(fit.select(*order, "url", key.alias("key")))
        among = keyed.select("key", "url").distinct()
        fit, keyed = (
            filters.exclude_values(filters.exclude_lowest_ids(rows, "url", lowest, among), "url", excluded_urls) for rows in (fit, keyed)
        )
        kept = fit.join(later_copies(keyed, F.col("key"), order), order, "left_anti")

    sections = {n: text.strip_markers(text.section_text(F.col("content"), fixed.SECTIONS[n])) for n in ("about", *TEXT_COLUMNS)}
    # A step of its own: a text that the next one looks at more than once is made once.
    rows = kept.withColumns({f"_{n}": section for n, section in sections.items()}).select(
        text.short_id(F.col("url")).alias("id"),
        "title",
        "url",
        text.longer_text(F.col("meta")["description"], F.col("_about")).alias("description"),
        dates.epoch_date(F.col("added")).alias("added"),
        dates.epoch_date(F.col("last_update_source")).alias("updated"),
        text.year_number(F.col("details.year")).alias("year"),
        F.col("details.status").alias("status"),
        lists.union_lists(
            text.drop_tags(F.col("tags")), text.clean_keywords(F.col("search_keywords"))
        ).alias("search_keywords"),
        text.slug_words(F.col("details.type")).alias("type"),
        text.section_images(F.col("content"), fixed.SECTIONS["similar_images"]).alias("similar_images"),
        links.classify_links(F.map_entries("additional_references")).alias("_refs"),
        *[F.col(f"_{n}").alias(n) for n in TEXT_COLUMNS],
        "template_image_url",
        F.col("meta")["og:image"].alias("fb_image_url"),
        "parent",
        "siblings",
        "children",
    )
    rows = rows.select("*", "_refs.*").drop("_refs")
    if order == ["ordinal"]:
        rows = cut(rows)
    # The rows of a reader that gives places are stored already, so their size is known before the next store.
    buckets = bucket_count(rows if order == ["ordinal"] else entries)
    # All later tables by id are joined with these rows, bucket by bucket.
    rows = cut_by(rows, buckets)

    edges = cut(relations.known_edges(relations.relation_edges(rows), rows))
    groups = cut(relations.without_equal_groups(relations.sibling_groups(relations.of_kind(edges, relations.SIBLING))))
    related = joins.union_ids(
        edges.select(F.col("src").alias("id")),
        edges.filter(F.col("kind").isin(relations.SIBLING, relations.PARENT)).select(F.col("dst").alias("id")),
    )
    related = cut_by(related, buckets)
    main = joins.add_flag(rows, related, "has_relations").select(
        "id", "title", "url", "description", "added", "updated", "year", "status", "search_keywords",
        "type", "similar_images", "has_relations",
        filters.has_any(*TEXT_COLUMNS).alias("has_other_texts"),
        filters.has_any(*REF_COLUMNS).alias("has_refs"),
        "template_image_url", "fb_image_url",
    )
    return Tables({
        "main": main,
        "refs": filters.drop_empty(rows.select("id", *REF_COLUMNS), REF_COLUMNS),
        "textual": filters.drop_empty(rows.select("id", *TEXT_COLUMNS), TEXT_COLUMNS),
        "edges": edges,
        "sibling_groups": groups,
    }, buckets)


def join_vision(tables: Tables, vision: DataFrame, top_up_urls: bool = True, list_rows: int = LIST_ROWS) -> Tables:
    """Add image recognition; entries without it, with bad images or in another language go from all tables."""
    main, buckets = tables["main"], tables.buckets
    known = vision.withColumn("id", text.short_id(F.col("id"))).join(main.select("id"), "id")
    safe = F.col("safeSearchAnnotation")
    guess = F.col("webDetection.bestGuessLabels")
    language = lists.first_struct_field(guess, "languageCode")
    usable = known.filter(
        F.col("error").isNull()
        & ~filters.is_blocked([safe[c] for c in fixed.BLOCKING_CATEGORIES])
        & (language.isNull() | (language == fixed.KEPT_LANGUAGE))
    )
    full = links.collect_urls(F.col("webDetection.fullMatchingImages"), fixed.MAX_ALTERNATIVE_URLS, fixed.OWN_IMAGE_HOST)
    partial = links.collect_urls(
        F.col("webDetection.partialMatchingImages"), fixed.MAX_ALTERNATIVE_URLS, fixed.OWN_IMAGE_HOST
    )
    annotations = F.col("labelAnnotations")
    seen = cut_by(
        usable.select(
            "id",
            *[safe[c].alias(c) for c in fixed.SAFE_SEARCH_COLUMNS],
            lists.field_list(annotations, "description", "string").alias("image_recogn_labels"),
            lists.field_list(annotations, "score", "double").alias("image_recogn_scores"),
            lists.first_struct_field(guess, "label").alias("best_guess_label"),
            (links.top_up(full, partial, fixed.MAX_ALTERNATIVE_URLS) if top_up_urls else full).alias("alt_img_urls"),
            links.collect_urls(F.col("webDetection.visuallySimilarImages"), fixed.MAX_SIMILAR_URLS).alias(
                "similar_images2"
            ),
            lists.pluck(F.col("webDetection.webEntities"), "description").alias("type2"),
        ),
        buckets,
    )
    dropped = cut_by(joins.subtract_ids(main, seen), buckets)
    kept = joins.cascade({n: tables[n] for n in ("refs", "textual")}, dropped)
    edges = cut(joins.drop_links(tables["edges"], dropped))
    groups = cut(relations.without_equal_groups(relations.drop_members(tables["sibling_groups"], dropped)))
    main = main.join(seen, "id").withColumn(
        "search_keywords", lists.append_label(F.col("search_keywords"), F.col("best_guess_label"))
    )
    in_relation = cut_by(relations.related_ids(edges, groups), buckets)
    main = joins.add_flag(main.drop("best_guess_label", "has_relations"), in_relation, "has_relations")
    labels = lambda: inverted.label_rows(
        seen,
        F.transform(
            F.arrays_zip("image_recogn_labels", "image_recogn_scores"),
            lambda z: F.struct(
                z["image_recogn_labels"].alias("label"), z["image_recogn_scores"].alias("score")
            ),
        ),
    )
    return Tables({
        "main": main,
        **kept,
        "edges": edges,
        "sibling_groups": groups,
        "relations": lambda: relations.relations_table(edges, list_rows=list_rows),
        "first_siblings": lambda: relations.first_siblings(groups, fixed.LIST_EDGES),
        "labels": lambda: inverted.inverted_lists(labels(), list_rows=list_rows)
        .withColumnsRenamed({"id": "memes", "score": "scores"}),
    }, buckets)


def join_entities(tables: Tables, entities: DataFrame) -> Tables:
    """Add linked entities, and merge all keyword lists of an entry into one."""
    main = tables["main"]
    found = (
        entities.withColumn("id", text.short_id(F.col("id")))
        .join(main.select("id"), "id")
        .select(
            "id",
            F.col("`@text`").alias("text"),
            lists.first_per_form(F.col("Resources"), "@surfaceForm", "@similarityScore", "@URI").alias("linked"),
        )
    )
    found = cut_by(found, tables.buckets)
    linked = found.filter(F.col("linked").isNotNull()).select("id", "linked.*")
    every = joins.add_columns(main, found, "text", "linked")
    keywords = F.col("search_keywords")
    merged = lists.merge_lists(
        keywords,
        lists.merge_lists(lists.merge_lists(F.col("type"), F.col("type2")), F.col("linked.keywords")),
    )
    every = every.withColumns(
        {
            "description": text.override_text(F.col("description"), F.col("text")),
            "has_DBpedia": F.col("linked").isNotNull(),
            "search_keywords": text.drop_words(text.keyword_set(merged)),
        }
    )
    return tables.with_tables(
        main=every.select(
            "id", "title", "url", "description", "added", "updated", "year", "has_relations", "has_other_texts",
            "has_refs", "has_DBpedia", "status", *fixed.SAFE_SEARCH_COLUMNS, "template_image_url", "fb_image_url",
            *schemas.MAIN_LIST_COLUMNS,
        ),
        DBpedia=linked,
    )


def add_people(tables: Tables, log: DataFrame, list_rows: int = LIST_ROWS) -> Tables:
    """Add authors, updaters, views and better dates from the scrape log, and both person tables."""
    main = tables["main"]
    scraped = joins.restrict(
        log.select(
            "id",
            "views",
            # A page without a name counts as the blank name among the lowest ones.
            F.coalesce("author", F.lit("")).alias("author"),
            F.coalesce("updater", F.lit("")).alias("updater"),
            F.col("added").alias("_added"),
            F.col("updated").alias("_updated"),
        ),
        main,
    )
    every = main.join(scraped, "id", "left")
    every = people.reconcile_dates(every, ("added", "_added"), ("updated", "_updated"), "year")
    named = people.blank_lowest_names(every, {"author": "author", "updater": "author"})
    final = cut(named.select(*schemas.MAIN_TEXT_COLUMNS, *schemas.MAIN_LIST_COLUMNS))
    return tables.with_tables(
        main=final,
        authors=lambda: people.person_rollup(final, "author", "views", list_rows=list_rows),
        updaters=lambda: people.person_rollup(final, "updater", "views", list_rows=list_rows),
    )


def build_graph(tables: Tables) -> Tables:
    """Nodes and edges of the property graph."""
    similar = tables["main"].select("id", "similar_images").filter(F.col("similar_images").isNotNull())
    nodes, edges = graph.entry_graph(tables["main"], tables["relations"], tables["first_siblings"], similar)
    return {"nodes": nodes, "edges": edges}


def build_relational(tables: Tables) -> Tables:
    """Typed entry, author and updater tables, the constraint report and the report query."""
    entries = as_table(tables["main"], schemas.ENTRY_TABLE, meme_id="id")

    def persons(name: str, column: str, declared: str, key: str) -> DataFrame:
        totals = people.person_totals(tables["main"], column, "views")
        return as_table(totals, declared, **{key: column})

    authors = persons("authors", "author", schemas.AUTHOR_TABLE, "author_id")
    updaters = persons("updaters", "updater", schemas.UPDATER_TABLE, "updater_id")
    report_rows = quality.constraint_report(
        [
            ("memes_key", quality.duplicate_keys(entries, "meme_id")),
            ("authors_key", quality.duplicate_keys(authors, "author_id")),
            ("updaters_key", quality.duplicate_keys(updaters, "updater_id")),
            ("memes_author", quality.orphans(entries, "author", authors, "author_id")),
            ("memes_updater", quality.orphans(entries, "updater", updaters, "updater_id")),
        ]
    )
    return {
        "memes": entries,
        "authors": authors,
        "updaters": updaters,
        "constraints": report_rows,
        "too_long": quality.too_long(entries, schemas.ENTRY_LIMITS),
        "per_year": report.entries_per_year(entries),
    }


def build_catalogue(entries: DataFrame, vision: DataFrame, entities: DataFrame, log: DataFrame) -> Tables:
    """All stages."""
    tables = clean_entries(entries)
    tables = join_vision(tables, vision)
    tables = join_entities(tables, entities)
    return add_people(tables, log)
