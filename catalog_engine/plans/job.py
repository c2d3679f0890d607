"""The whole job: raw files in, all final tables out."""

from __future__ import annotations

from pyspark.sql import SparkSession

from catalog_engine import schemas
from catalog_engine.operators import graph, quality
from catalog_engine.plans import stages
from catalog_engine.session import stored_for_a_run
from catalog_engine.sources import read, split, store, write

# Between two records of the recognition and entity files, which are keyed by links.
RECORD_SEPARATOR = '}, "http'
# Tables written as records with their key, and the key.
KEYED = {
    "refs": "id", "textual": "id", "relations": "id", "sibling_groups": "group_id", "DBpedia": "id", "labels": "label",
    "authors": "author", "updaters": "updater",
}
# List columns that get a file of their own, keyed by the column.
BY_COLUMN = {"alternative_urls": "alt_img_urls", "search_keywords": "search_keywords"}


def run(
    spark: SparkSession,
    entries: str,
    vision: str,
    entities: str,
    log: str,
    output: str,
    lines: bool = False,
    model: bool = True,
    strict: bool = True,
) -> None:
    """Build the catalogue of the raw files and write it below ``output``.

    ``main_with_lists`` and ``main`` are delimited text, the tables of ``BY_COLUMN``
    objects keyed by column and id, all others JSON lines. ``lines``: the entries
    are one record per line instead of an array. Every file is read by many tasks;
    entries that do not fit their schema go to ``rejects`` with their place and
    the reason, and the others are built. A bad record of the recognition or
    entity file stops the job, or goes to ``rejects`` too where it is not
    ``strict``; the files are then stored while their records are found, instead
    of read in one pass. With ``model`` the graph and the typed tables are written
    too. What the build stores on its way is removed at the end.
    """
    with stored_for_a_run(spark):
        sources = {"entries": (split.read_lines if lines else split.read_array)(spark, entries, schemas.ENTRIES)}
        keyed = {"vision": (vision, schemas.VISION_RECORD), "entities": (entities, schemas.ENTITY_RECORD)}
        if strict:
            found = {n: read.read_keyed(spark, path, record, separator=RECORD_SEPARATOR) for n, (path, record) in keyed.items()}
        else:
            sources.update({n: split.read_object(spark, path, record) for n, (path, record) in keyed.items()})
            found = {n: sources[n][0].drop("file", "nth") for n in keyed}
        for name, (_, rejects) in sources.items():
            rejects.write.parquet(f"{output}/rejects/raw_{name}")
        log_rows = read.read_scrape_log(spark, log)
        tables = stages.build_catalogue(sources["entries"][0], found["vision"], found["entities"], log_rows)
        write_tables(tables, output)
        if model:
            write_graph(spark, tables, output)
            write_model(tables, output)


def write_tables(tables: stages.Tables, output: str) -> None:
    write.write_delimited(tables["main"], f"{output}/main_with_lists")
    for name, part in write.split_main(tables["main"]).items():
        if name == "main":
            write.write_delimited(part, f"{output}/{name}")
        elif name in BY_COLUMN:
            write.write_column_object(part, f"{output}/{name}", BY_COLUMN[name])
        else:
            write.write_keyed(part, f"{output}/{name}")
    for name, key in KEYED.items():
        write.write_keyed(tables[name], f"{output}/{name}", key)


def write_graph(spark: SparkSession, tables: stages.Tables, output: str) -> dict[str, int]:
    """Bring the stored graph below ``output`` to that of the tables; how many buckets of nodes and edges were written."""
    built = stages.build_graph(tables)
    kinds = {"nodes": (graph.NODES, graph.NODE_KEYS), "edges": (graph.EDGES, graph.EDGE_KEYS)}
    return {
        name: store.BucketStore(spark, f"{output}/graph/{name}", schema, keys).merge(built[name]) for name, (schema, keys) in kinds.items()
    }


def write_model(tables: stages.Tables, output: str) -> None:
    """The typed tables, each behind its gate, in ``tables``, and the rows that broke a constraint, with why, in ``rejects``.

    People come first, so an entry whose author or updater was rejected is rejected too.
    """
    model, passed = stages.build_relational(tables), {}
    for name, key in (("authors", "author_id"), ("updaters", "updater_id")):
        passed[name], rejects = quality.gate(model[name], key, limits={key: schemas.ENTRY_LIMITS["author"]})
        rejects.write.parquet(f"{output}/rejects/{name}")
    references = [("author", passed["authors"], "author_id"), ("updater", passed["updaters"], "updater_id")]
    passed["memes"], rejects = quality.gate(model["memes"], "meme_id", references, schemas.ENTRY_LIMITS)
    rejects.write.parquet(f"{output}/rejects/memes")
    for name, rows in passed.items():
        rows.write.parquet(f"{output}/tables/{name}")
