"""Source divergence audit by three-dimensional cube partitioning.

Every language has a matrix of its sources (rows) and its terms (columns): how
often each source uses each term. The rows are cut into group blocks and the
columns into term blocks, which gives slices. A task owns a cell (group block,
group block, term block): it gets the two slices, computes the divergence of
every pair of their groups over this block of terms, and the partial
divergences are summed along the term axis. A slice is sent once to every group
block it is compared with, so no task holds a source or a language whole, and
the number and size of the cells follow the number of groups and terms.

Texts are only read once, by the count of terms. Blocks are drawn by hash, so
they need no numbering over a whole language.

All arithmetic is in 64-bit integers, and exact while a source has fewer than
9e15 counted terms: shares of 1e9 are divided in three rounds of 1,000.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from catalog_engine.llm.common import offsets_of, pieces, raw_texts, table
from catalog_engine.session import cut

MIN_DOCUMENTS = 10
TOP_TERMS = 10
# Groups and terms of a block, on average. A cell holds two slices of GROUP_BLOCK x TERM_BLOCK numbers.
GROUP_BLOCK = 64
TERM_BLOCK = 4_096
PIECE_BYTES = 4_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A term is a run of ASCII letters and characters beyond ASCII; all other bytes become spaces.
LETTERS = bytes(c if c >= 128 or chr(c) in LOWER else ord(chr(c).lower()) if chr(c) in UPPER else 32 for c in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """Per (lang, source, term) of the rows of ``docs`` the documents and occurrences, summed by piece before the shuffle."""

    def counted(batches):
        for piece in pieces(batches, most=PIECE_BYTES):
            owners: dict[tuple, int] = {}
            langs, sources = piece.column("lang").to_pylist(), piece.column("source").to_pylist()
            owner = np.array([owners.setdefault(pair, len(owners)) for pair in zip(langs, sources)])
            lists = [t.translate(LETTERS).split() for t in raw_texts(piece)]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            numbers: dict[bytes, int] = {}
            ids = np.fromiter((numbers.setdefault(w, len(numbers)) for words in lists for w in words), np.int64, offsets_of(sizes)[-1])
            n_terms = max(1, len(numbers))
            in_doc, times = np.unique(np.repeat(np.arange(len(lists)), sizes) * n_terms + ids, return_counts=True)
            in_group, place = np.unique(owner[in_doc // n_terms] * n_terms + in_doc % n_terms, return_inverse=True)
            n = np.zeros(len(in_group), np.int64)
            np.add.at(n, place, times)
            first, second = zip(*owners)
            of = pa.array(in_group // n_terms)
            yield pa.record_batch(
                [
                    pa.array(first, pa.string()).take(of),
                    pa.array(second, pa.string()).take(of),
                    pa.array(list(numbers), pa.binary()).cast(pa.string()).take(pa.array(in_group % n_terms)),
                    pa.array(np.bincount(place, minlength=len(in_group)).astype(np.int64)),
                    pa.array(n),
                ],
                ["lang", "source", "term", "docs", "n"],
            )

    found = docs.select("lang", "source", "text").mapInArrow(counted, "lang string, source string, term string, docs bigint, n bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def with_share(df: DataFrame, name: str, count: str, total: str) -> DataFrame:
    """1 + floor(1e9 * (count + 2) / total) as ``name``; no product passes 64 bits."""
    df = df.withColumns({name: F.lit(0).cast("bigint"), "_rest": F.col(count) + 2})
    for _ in range(3):
        df = df.withColumn(name, F.expr(f"{name} * 1000 + (_rest * 1000) div {total}")).withColumn("_rest", F.expr(f"(_rest * 1000) % {total}"))
    return df.withColumn(name, F.col(name) + 1).drop("_rest")


def shares_of(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The same for a matrix (groups, terms) and the totals of its groups."""
    share, rest = np.zeros_like(counts), counts + 2
    for _ in range(3):
        quotient, rest = np.divmod(rest * 1000, totals[:, None])
        share = share * 1000 + quotient
    return share + 1


def cell_sums(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For every row of ``left`` and of ``right`` the sum of floor((p - q)^2 / (p + q)) over the terms."""
    out = np.zeros((len(left), len(right)), np.int64)
    for i, p in enumerate(left):
        out[i] = ((right - p) ** 2 // (right + p)).sum(axis=1)
    return out


def slice_matrix(row: dict) -> tuple[list[str], np.ndarray]:
    """The sources of a slice and the matrix of their shares."""
    members = sorted(row["members"], key=lambda m: m["place"])
    counts = np.zeros((len(members), row["n_terms"]), np.int64)
    if row["counts"]:
        at = np.array([(c["place"], c["term"], c["n"]) for c in row["counts"]], np.int64)
        counts[at[:, 0], at[:, 1]] = at[:, 2]
    if not row["n_terms"]:
        return [m["source"] for m in members], counts
    return [m["source"] for m in members], shares_of(counts, np.array([m["total"] for m in members], np.int64))


def cell(found: pa.Table) -> pa.Table:
    """Partial divergences of a cell: every two groups of its slices, or of its one slice on the diagonal.

    A block may have drawn no group; the cells of another block with it have one slice and no pairs.
    """
    rows = found.to_pylist()
    rows.sort(key=lambda r: r["block"])
    (names, left), (others, right) = slice_matrix(rows[0]), slice_matrix(rows[-1])
    if rows[0]["a"] == rows[0]["b"]:
        i, j = np.triu_indices(len(names), 1)
    else:
        i, j = map(np.ravel, np.indices((len(names), len(others) if len(rows) == 2 else 0)))
    sums = cell_sums(left, right)
    return pa.table(
        {
            "lang": pa.array([rows[0]["lang"]] * len(i), pa.string()),
            "source": pa.array(names, pa.string()).take(pa.array(i)),
            "item": pa.array(others, pa.string()).take(pa.array(j)),
            "value": pa.array(sums[i, j], pa.int64()),
        }
    )


def audit(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    group_block: int = GROUP_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """How far the sources of every language are from each other, and the terms that set each one apart.

    ``docs`` has lang, source and text; further columns are not read. A null is
    an empty text, language or source. Rows that repeat count each time. A
    source without any kept term still takes part, with even shares; a language
    without kept terms has divergence 0 between all sources. Equal values are
    ranked by item. An empty table gives an empty result.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = cut(term_counts(rows))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= min_documents)
    sizes = kept.groupBy("lang").agg(F.count("*").alias("n_kept"), F.sum("lang_n").alias("lang_total"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n_kept") / term_block)).cast("int")
    sizes = cut(sizes.withColumns({"term_blocks": blocks, "lang_total": F.col("lang_total") + 2 * F.col("n_kept")}))

    # Terms get their block by hash and a place in it; a block is a bounded group.
    terms = kept.join(sizes, "lang").withColumn("term_block", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int"))
    in_block = Window.partitionBy("lang", "term_block").orderBy("term")
    terms = cut(terms.select("lang", "term", "lang_n", "lang_total", "term_block", (F.row_number().over(in_block) - 1).alias("term_place")))
    known = cut(counts.join(terms, ["lang", "term"]))

    # Groups likewise, whether or not they have terms.
    groups = rows.select("lang", "source").distinct()
    n_groups = groups.groupBy("lang").agg(F.ceil(F.count("*") / group_block).cast("int").alias("group_blocks"))
    totals = known.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(n_groups, "lang").join(sizes, "lang", "left")
    groups = groups.withColumns(
        {
            "total": F.coalesce("total", F.lit(0)) + 2 * F.coalesce("n_kept", F.lit(0)),
            "term_blocks": F.coalesce("term_blocks", F.lit(1)),
            "block": F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int"),
        }
    )
    in_block = Window.partitionBy("lang", "block").orderBy("source")
    groups = groups.withColumn("place", F.row_number().over(in_block) - 1)
    groups = cut(groups.select("lang", "source", "total", "term_blocks", "group_blocks", "block", "place"))

    # Slices: all blocks of groups with all blocks of terms, also where no count is.
    found = known.join(groups.select("lang", "source", "block", "place"), ["lang", "source"])
    filled = found.groupBy("lang", "block", "term_block").agg(
        F.collect_list(F.struct("place", F.col("term_place").alias("term"), "n")).alias("counts")
    )
    slices = groups.groupBy("lang", "block", "term_blocks", "group_blocks").agg(
        F.collect_list(F.struct("place", "source", "total")).alias("members")
    )
    slices = slices.withColumn("term_block", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)))
    slices = slices.join(terms.groupBy("lang", "term_block").agg(F.count("*").cast("int").alias("n_terms")), ["lang", "term_block"], "left")
    slices = slices.withColumn("n_terms", F.coalesce("n_terms", F.lit(0))).join(filled, ["lang", "block", "term_block"], "left")

    # Each slice goes to the cells of its block with every block.
    sent = slices.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)))
    sent = sent.select(
        "lang", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "term_block", "block", "n_terms", "members", "counts"
    )
    partial = sent.groupBy("lang", "a", "b", "term_block").applyInArrow(cell, "lang string, source string, item string, value bigint")
    pairs = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = pairs.withColumn("_side", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        "lang",
        F.when(F.col("_side") == 0, F.col("source")).otherwise(F.col("item")).alias("source"),
        F.lit("pair").alias("part"),
        F.when(F.col("_side") == 0, F.col("item")).otherwise(F.col("source")).alias("item"),
        "value",
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    both = both.withColumn("rank", F.row_number().over(order))

    apart = found.join(groups.select("lang", "source", "total"), ["lang", "source"])
    apart = with_share(with_share(apart, "p", "n", "total"), "q", "lang_n", "lang_total").filter("n > 0 and p > q")
    apart = apart.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value")
    )
    apart = apart.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    return both.unionByName(apart)


def op12_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Divergences of all sources of all documents."""
    return audit(table(spark, folder, "documents"))


AUDIT_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), words AS (
  SELECT id, lang, source,
    translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), '{UPPER}', '{LOWER}') AS term
  FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS d FROM words GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL HAVING sum(d) >= {MIN_DOCUMENTS}
), sizes AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n AS lang_n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT lang, source, term, n,
    1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
    1 + (1000000000 * (lang_n + 2)) // (total + 2 * v) AS q
  FROM dense JOIN sizes USING (lang)
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(a.value, 0) AS value
  FROM groups g JOIN groups o ON o.lang = g.lang AND o.source <> g.source
  LEFT JOIN apart a ON a.lang = g.lang AND a.source = g.source AND a.item = o.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
