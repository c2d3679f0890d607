"""A catalogue in the raw layouts, derived from the given tables, and the whole build on it.

Documents are the entries, labels the image recognition, benchmark items the
linked entities, customers the scrape log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalog_engine import fixed_values as fixed, schemas
from catalog_engine.plans import job, stages
from catalog_engine.plans.table_queries import query, table
from catalog_engine.session import new_folder
from catalog_engine.sources import read, write

BASE = "https://site.example/entries/d"
CATALOGUE_LANGUAGES = ["en", "fr", "de"]
# One entry lists this many others as its siblings, so that one group is far larger than the rest.
HUB, HUB_LIST = 6, 5_000

def _link(number: Column) -> Column:
    return F.concat(F.lit(BASE), number.cast("string"))


def _shaped(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a raw layout in its exact types."""
    empty = df.sparkSession.createDataFrame([], schema)
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in empty.schema])


def raw_entries(documents: DataFrame) -> DataFrame:
    none = F.lit(None)
    section = F.struct(
        F.array("text").alias("text"), none.alias("images"), none.alias("subsections")
    )
    lines = F.struct(F.split("text", "\n").alias("text"), none.alias("images"), none.alias("subsections"))
    kind = "struct<text:array<string>,images:array<string>,subsections:map<string,struct<text:array<string>,images:array<string>>>>"
    number = F.col("doc_id")
    rows = documents.select(
        F.concat("source", F.lit(" "), F.substring_index("text", "\n", 1)).alias("title"),
        _link(number).alias("url"),
        F.when(F.col("lang").isin(*CATALOGUE_LANGUAGES), "Meme").otherwise("Person").alias("category"),
        (F.lit(1_300_000_000) + number * 86_400).alias("last_update_source"),
        F.when(F.col("lang") != "fr", F.lit(1_290_000_000.0) + number * 3600).alias("added"),
        F.create_map(
            F.lit("description"), F.substring_index("text", "\n", 1), F.lit("og:image"), F.concat(F.lit("http://img/"), "doc_id")
        ).alias("meta"),
        F.struct(
            F.when(F.col("lang") != "de", "2011.0").alias("year"),
            F.array(F.concat(F.lit("t/"), "source", F.lit("-x"))).alias("type"),
            F.col("lang").alias("status"),
            none.alias("origin"),
        ).alias("details"),
        F.create_map(
            "source", F.when(F.col("lang") == "en", F.concat(F.lit("http://en.wikipedia.org/"), "doc_id")).otherwise("none")
        ).alias("additional_references"),
        F.array(F.concat(F.lit("#"), "source"), F.lit("u9x")).alias("search_keywords"),
        F.array(F.lit("meme"), F.concat("lang", F.lit("tag"))).alias("tags"),
        F.create_map(F.lit("about"), section.cast(kind), F.lit("spread"), lines.cast(kind)).alias("content"),
        F.when(number > 0, _link(F.floor(number / 10))).alias("parent"),
        F.when(number == HUB, F.transform(F.sequence(F.lit(1), F.lit(HUB_LIST)), _link))
        .when(F.col("lang") == "en", F.array(_link(number + 1)))
        .alias("siblings"),
        none.alias("children"),
        F.concat(F.lit("http://template/"), "source").alias("template_image_url"),
    )
    return _shaped(rows, schemas.ENTRIES)


def raw_vision(labels: DataFrame) -> DataFrame:
    def likelihood(value: Column) -> Column:
        return F.when(value == 1, "VERY_LIKELY").otherwise("UNLIKELY")

    def urls(*links: Column) -> Column:
        return F.array(*[F.struct(u.alias("url")) for u in links])

    none = F.lit(None)
    half = F.lit(0.5)
    rows = labels.select(
        _link(F.col("doc_id")).alias("id"),
        F.array(
            *[
                F.struct(none.alias("mid"), name.alias("description"), score.alias("score"), score.alias("topicality"))
                for name, score in (
                    (F.concat(F.lit("quality"), "quality"), half),
                    (F.lit("label"), F.col("doc_id").cast("double")),
                )
            ]
        ).alias("labelAnnotations"),
        F.struct(
            likelihood(F.col("toxic")).alias("adult"),
            *[F.lit("UNLIKELY").alias(n) for n in ("medical", "racy", "spoof", "violence")],
        ).alias("safeSearchAnnotation"),
        F.struct(
            F.array(F.struct(F.lit("guess it").alias("label"), F.lit("en").alias("languageCode"))).alias("bestGuessLabels"),
            urls(F.lit(f"http://{fixed.OWN_IMAGE_HOST}/x"), F.concat(F.lit("http://a/"), "doc_id")).alias("fullMatchingImages"),
            urls(F.lit("http://b/1"), F.lit("http://b/2")).alias("partialMatchingImages"),
            none.alias("visuallySimilarImages"),
            F.array(F.struct(F.concat(F.lit("Web "), "quality").alias("description"), half.alias("score"))).alias("webEntities"),
        ).alias("webDetection"),
        F.when(F.col("quality") == 0, "bad").alias("error"),
    )
    return _shaped(rows, f"id string, {schemas.VISION_RECORD}")


def raw_entities(items: DataFrame) -> DataFrame:
    none = F.lit(None)
    found = F.transform(
        F.split("text", " "),
        lambda form: F.struct(form.alias("@surfaceForm"), F.lit("0.5").alias("@similarityScore"), F.lit("u").alias("@URI")),
    )
    fixed_columns = [none.alias(n) for n in ("@confidence", "@support", "@types", "@sparql", "@policy")]
    rows = items.select(
        _link(F.col("item_id")).alias("id"), F.col("text").alias("@text"), found.alias("Resources"), *fixed_columns
    )
    return _shaped(rows, f"id string, {schemas.ENTITY_RECORD}")


def scrape_log(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.concat(F.lit("d"), F.col("c_custkey").cast("string")).alias("id"),
        F.floor("c_acctbal").cast("int").alias("views"),
        F.col("c_mktsegment").alias("author"),
        F.concat(F.lit("nation"), F.col("c_nationkey").cast("string")).alias("updater"),
        F.lit("2010-01-01").cast("date").alias("added"),
        F.lit(None).cast("date").alias("updated"),
    )


def seen(spark, folder) -> stages.Tables:
    """The tables after image recognition."""
    entries = stages.clean_entries(raw_entries(table(spark, folder, "documents")))
    return stages.join_vision(entries, raw_vision(table(spark, folder, "labels")))


def linked(spark, folder) -> stages.Tables:
    return stages.join_entities(seen(spark, folder), raw_entities(table(spark, folder, "benchmark")))


def build(spark, folder) -> stages.Tables:
    return stages.add_people(linked(spark, folder), scrape_log(table(spark, folder, "customer")))


def main_columns(main: DataFrame) -> DataFrame:
    return main.select(
        "id",
        F.md5(F.encode("description", "utf-8")).alias("description"),
        "views", "author", "updater",
        F.col("added").cast("string").alias("added"),
        F.col("updated").cast("string").alias("updated"),
        "year", "has_relations", "has_other_texts", "has_refs", "has_DBpedia", "status", "adult",
        F.array_join("alt_img_urls", " ").alias("alt_img_urls"),
        F.array_join("image_recogn_labels", " ").alias("labels"),
        F.array_join("search_keywords", " ").alias("keywords"),
    )


@query
def catalogue_main(spark, folder):
    """The final main table."""
    return main_columns(build(spark, folder)["main"])


@query
def catalogue_relations(spark, folder):
    """The final relations table."""
    return seen(spark, folder)["relations"].select("id", "part", "parent", F.array_join("children", " ").alias("children"))


@query
def catalogue_sibling_groups(spark, folder):
    """The whole sibling result: every member of every group, one group of them with very many."""
    return seen(spark, folder)["sibling_groups"].select("group_id", "member")


@query
def catalogue_siblings(spark, folder):
    """The first siblings of every entry, as the graph takes them."""
    return seen(spark, folder)["first_siblings"].select("id", "sibling", F.col("position").cast("bigint").alias("position"))


@query
def catalogue_refs(spark, folder):
    """Links of the entries by site."""
    refs = seen(spark, folder)["refs"]
    return refs.select("id", *stages.REF_COLUMNS)


@query
def catalogue_textual(spark, folder):
    """Further texts of the entries, whole."""
    return seen(spark, folder)["textual"].select(
        "id", *[F.md5(F.encode(c, "utf-8")).alias(c) for c in stages.TEXT_COLUMNS]
    )


@query
def catalogue_labels(spark, folder):
    """Recognised labels with their entries and scores."""
    return seen(spark, folder)["labels"].select(
        "label", "part", F.array_join("memes", " ").alias("memes"),
        F.array_join(F.transform("scores", lambda s: F.round(s * 10).cast("bigint").cast("string")), " ").alias("scores"),
    )


@query
def catalogue_dbpedia(spark, folder):
    """Linked entities of the entries."""
    return linked(spark, folder)["DBpedia"].select("id", F.array_join("keywords", " ").alias("keywords"))


@query
def catalogue_per_year(spark, folder):
    """Entries per year of the typed entry table."""
    found = stages.build_relational(build(spark, folder))["per_year"]
    return found.select(F.col("year").cast("int").alias("year"), "n")


@query
def catalogue_people(spark, folder):
    """Authors and updaters with their entries, counts and views."""
    tables = build(spark, folder)
    people = [
        tables[name].select(
            F.lit(name).alias("kind"), F.col(column).alias("person"), "part",
            F.array_join("meme_ids", " ").alias("meme_ids"), "meme_counts", "tot_views",
        )
        for name, column in (("authors", "author"), ("updaters", "updater"))
    ]
    return people[0].unionByName(people[1])


@query
def catalogue_graph(spark, folder):
    """Number of nodes and edges of every kind of the final graph."""
    graph = stages.build_graph(build(spark, folder))
    nodes = graph["nodes"].groupBy("kind").agg(F.count("*").alias("n"))
    edges = graph["edges"].groupBy(F.col("relation").alias("kind")).agg(F.count("*").alias("n"))
    return nodes.unionByName(edges)


@query
def catalogue_nodes(spark, folder):
    """All nodes of the final graph with their properties."""
    return stages.build_graph(build(spark, folder))["nodes"]


@query
def catalogue_edges(spark, folder):
    """All edges of the final graph."""
    return stages.build_graph(build(spark, folder))["edges"]


@query
def catalogue_constraints(spark, folder):
    """Violations in the final relational tables."""
    return stages.build_relational(build(spark, folder))["constraints"]


# --- from raw files to written tables ----------------------------------------------------------


def write_raw_files(spark, folder, raw: str) -> dict[str, str]:
    """The raw catalogue in the layouts of its files; the path of each."""
    paths = {name: f"{raw}/{name}" for name in ("entries", "vision", "entities", "log")}
    write.write_array(raw_entries(table(spark, folder, "documents")), paths["entries"], compression="lz4")
    write.write_object(raw_vision(table(spark, folder, "labels")), paths["vision"])
    write.write_object(raw_entities(table(spark, folder, "benchmark")), paths["entities"])
    log = scrape_log(table(spark, folder, "customer"))
    log = log.select(
        F.lit(1).alias("row_no"), F.concat(F.lit(BASE), F.substring("id", 2, 20)).alias("url"), F.lit(200).alias("code"),
        "views", "author", "updater", F.col("added").cast("string"), F.col("updated").cast("string"),
    )
    log.write.csv(paths["log"])
    return paths


def job_output(spark, folder, model: bool = False) -> str:
    """Where the whole job has written its tables, and with ``model`` the graph and the typed tables."""
    paths, output = write_raw_files(spark, folder, new_folder(spark, "raw")), new_folder(spark, "final")
    job.run(spark, **paths, output=output, model=model)
    return output


@query
def job_main(spark, folder):
    """The main table as the whole job wrote it, read back with its lists."""
    return main_columns(read.read_main(spark, f"{job_output(spark, folder)}/main_with_lists", has_lists=True))


@query
def job_split_main(spark, folder):
    """The list-free main table and the list tables beside it as the whole job wrote them, read back and joined."""
    output = job_output(spark, folder)
    main = read.read_main(spark, f"{output}/main", has_lists=False)
    seen = read.read_records(spark, f"{output}/image_recogn", "id string, image_recogn_labels array<string>", lines=True)
    for name, column in job.BY_COLUMN.items():
        main = main.join(read.read_column_keyed(spark, f"{output}/{name}", column, separator='], "'), "id", "left")
    return main_columns(main.join(seen, "id", "left"))


@query
def job_tables(spark, folder):
    """Rows and different keys of the other tables the whole job wrote."""
    output = job_output(spark, folder)
    counts = [
        read.read_records(spark, f"{output}/{name}", f"`{key}` string", lines=True)
        .agg(F.lit(name).alias("name"), F.count(key).alias("n"), F.count_distinct(key).alias("n_keys"))
        for name, key in {**job.KEYED, "similar_img_urls": "id"}.items()
    ]
    every = counts[0]
    for more in counts[1:]:
        every = every.unionByName(more)
    return every


@query
def raw_vision_file(spark, folder):
    """Image recognition written as objects keyed by link, and read back in pieces."""
    path = new_folder(spark, "vision")
    write.write_object(raw_vision(table(spark, folder, "labels")), path)
    back = read.read_keyed(spark, path, schemas.VISION_RECORD, separator=job.RECORD_SEPARATOR)
    return back.select(
        "id", F.col("safeSearchAnnotation.adult").alias("adult"), "error",
        F.array_join("labelAnnotations.description", " ").alias("labels"),
        F.array_join("webDetection.fullMatchingImages.url", " ").alias("links"),
    )


@query
def raw_entry_file(spark, folder):
    """Entries written as arrays of records, and read back."""
    path = new_folder(spark, "entries")
    write.write_array(raw_entries(table(spark, folder, "documents")), path)
    back = read.read_records(spark, path, schemas.ENTRIES)
    return back.select(
        "url", "category", "parent", F.size("siblings").alias("n_siblings"),
        F.md5(F.encode(F.col("content")["about"]["text"][0], "utf-8")).alias("about"),
        F.size(F.col("content")["spread"]["text"]).alias("n_lines"),
    )


@query
def raw_log_file(spark, folder):
    """The scrape log written without a header, and read back typed."""
    path = new_folder(spark, "log")
    customers = table(spark, folder, "customer").withColumn("day", F.date_add(F.lit("2010-01-01").cast("date"), F.col("c_custkey").cast("int")))
    customers.select(
        "c_custkey", F.concat(F.lit(BASE), "c_custkey"), F.lit(200), F.floor("c_acctbal").cast("int"), "c_name",
        F.nullif("c_mktsegment", F.lit("BUILDING")), F.col("day").cast("string"), F.lit(None).cast("string"),
    ).write.csv(path)
    back = read.read_scrape_log(spark, path)
    return back.select(
        "id", "row_no", "code", "views", "author", "updater", F.col("added").cast("string").alias("added"),
        F.col("updated").cast("string").alias("updated"), F.col("_corrupt_record").isNull().alias("whole"),
    )
