"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Every source gets a target in words: its weight's share of the whole mix, held
at a number of times its own size, the excess going to the others. Inside a
source documents are expected a number of times that rises with their length.
The whole part of that number is allocated for certain. The rest is an
inclusion probability, and a sample of fixed size (in words) is drawn: documents
are ranked by the odds of their random number divided by their inclusion odds,
and taken from the lowest rank until the source is as near its target as whole
documents allow.

The cut in the ranking is found without sorting a source in one task: sums over
narrow ranges of ranks show the range that holds the cut, and only its rows are
ordered. Each document is then compared with its source's cut where it lies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from catalog_engine.llm.common import table, word_count
from catalog_engine.session import cut

WEIGHTS = (3, 1, 2)
MIX_SHARE = 1.5
MOST_COPIES = 2
# A document of class k (the number of binary digits of its size) is expected LENGTH_BASE + k parts.
LENGTH_BASE = 16
ROWS_A_RANGE = 4_096
HASH_DIGITS = 13


def with_sizes(docs: DataFrame) -> DataFrame:
    """``docs`` with _size (words), _class (binary digits of the size) and _odds (of a random number fixed by doc_id)."""
    number = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, HASH_DIGITS), 16, 10)
    u = (number.cast("double") + 0.5) / F.lit(float(16**HASH_DIGITS))
    sized = docs.withColumn("_size", word_count("text"))
    return sized.withColumn("_class", F.length(F.bin("_size"))).withColumn("_u", u).withColumn("_odds", F.col("_u") / (1 - F.col("_u"))).drop("_u")


def own_level(amount: Column, weight: Column, most: Column, keys: Sequence[str], tie: Sequence[str]) -> Column:
    """The level that a row and all after it would get if those before it, in the order of most / weight, are full."""
    upward = Window.partitionBy(*keys).orderBy(most / weight, *tie)
    before = F.coalesce(F.sum(most).over(upward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum(weight).over(upward.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (amount - before) / onward


def level(rows: DataFrame, amount: str, weight: str, most: str, keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """``rows`` with _share: ``level * weight`` held at ``most``, adding up to ``amount`` in each group of ``keys``.

    Rows fill up in the order of most / weight, so one pass over that order
    tells which are full: those whose most is not above their own level's share.
    """
    own = own_level(F.col(amount), F.col(weight), F.col(most), keys, tie)
    marked = rows.withColumn("_own", own).withColumn("_full", F.col(most) <= F.col("_own") * F.col(weight))
    group = Window.partitionBy(*keys)
    full = F.coalesce(F.sum(F.when(F.col("_full"), F.col(most))).over(group), F.lit(0))
    rest = F.sum(F.when(~F.col("_full"), F.col(weight))).over(group)
    return (
        marked.withColumn("_level", (F.col(amount) - full) / rest)
        .withColumn("_share", F.when(F.col("_full"), F.col(most).cast("double")).otherwise(F.col("_level") * F.col(weight)))
        .drop("_own", "_full", "_level")
    )


def source_targets(sizes: DataFrame, weights: Sequence[int], mix_share: float, most_copies: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row a source, so one task may order them."""
    everywhere = Window.partitionBy(F.lit(0))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place - 1) % len(weights) + 1)
    rows = (
        sizes.withColumn("_weight", weight)
        .withColumn("_amount", F.lit(mix_share) * F.sum("source_size").over(everywhere))
        .withColumn("_most", F.lit(most_copies) * F.col("source_size"))
        .withColumn("_all", F.lit(0))
    )
    return level(rows, "_amount", "_weight", "_most", ["_all"], ["source"]).select("source", "source_size", F.col("_share").alias("target"))


def class_shares(classes: DataFrame, targets: DataFrame, most_copies: int) -> DataFrame:
    """Per source and size class: whole copies for certain (_whole) and the probability of one more (_p)."""
    rows = (
        classes.join(targets, classes.source.eqNullSafe(targets.source)).drop(targets.source)
        .withColumn("_most", F.lit(most_copies) * F.col("_words"))
        .withColumn("_weight", F.col("_words") * (F.col("_class") + LENGTH_BASE))
    )
    # Classes without words take no part in the sums; nothing is drawn from them.
    some = level(rows.filter("_words > 0"), "target", "_weight", "_most", ["source"], ["_class"])
    expected = some.withColumn("_expected", F.least(F.col("_share") / F.col("_words"), F.lit(float(most_copies))))
    return expected.select(
        "source", "_class", "source_size", "target", "_words", F.floor("_expected").alias("_whole"),
        (F.col("_expected") - F.floor("_expected")).alias("_p"),
    )


def plan(narrow: DataFrame, weights: Sequence[int], mix_share: float, most_copies: int) -> tuple[DataFrame, DataFrame]:
    """Shares per (source, class), and per source the place of the cut: (_open range, _limit in it)."""
    classes = cut(narrow.groupBy("source", "_class").agg(F.sum("_size").alias("_words"), F.count("*").alias("_rows")))
    targets = source_targets(
        classes.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, mix_share, most_copies
    )
    shares = cut(class_shares(classes, targets, most_copies))
    same = lambda a, b: a.source.eqNullSafe(b.source)
    ranges = classes.groupBy("source").agg(F.ceil(F.sum("_rows") / ROWS_A_RANGE).alias("_ranges"))
    certain = shares.groupBy("source").agg(
        F.max("target").alias("target"), F.sum(F.col("_whole") * F.col("_words")).alias("_certain")
    )
    rest = certain.join(ranges, same(certain, ranges)).drop(ranges.source).withColumn("_rest", F.col("target") - F.col("_certain"))
    per_source = cut(rest.select("source", "_ranges", "_rest"))
    drawn = ranked(narrow, shares, per_source).filter("_rank is not null")
    sums = drawn.groupBy("source", "_range").agg(F.sum("_size").alias("_words"), F.first("_rest").alias("_rest"))
    upward = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("_before", F.coalesce(F.sum("_words").over(upward), F.lit(0)))
    # The range in which the sum passes what is left: all earlier ones are taken, no later one is.
    open_range = placed.filter("_before <= _rest and _before + _words > _rest").select(
        F.col("source").alias("_s"), F.col("_range").alias("_open"), "_before"
    )
    inside = drawn.join(open_range, drawn.source.eqNullSafe(open_range["_s"]) & (drawn["_range"] == open_range["_open"]))
    units = inside.groupBy("source", "_rank", "doc_id", "_size").agg(
        F.sum("_size").alias("_words"), F.first("_before").alias("_before"), F.first("_rest").alias("_rest"), F.first("_open").alias("_open")
    )
    order = Window.partitionBy("source").orderBy("_rank", "doc_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.col("_before") + F.coalesce(F.sum("_words").over(order), F.lit(0))
    taken = units.withColumn("_earlier", earlier).withColumn("_in", 2 * F.col("_earlier") + F.col("_words") <= 2 * F.col("_rest"))
    key = F.struct("_rank", F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"), "_size")
    cuts = taken.groupBy("source").agg(F.first("_open").alias("_open"), F.max(F.when(F.col("_in"), key)).alias("_limit"))
    joined = per_source.join(cuts.withColumnRenamed("source", "_s"), per_source.source.eqNullSafe(F.col("_s")), "left").drop("_s")
    return shares, cut(joined)


def ranked(rows: DataFrame, shares: DataFrame, per_source: DataFrame) -> DataFrame:
    """Rows with their source's figures, their rank (null: not drawn for) and range of ranks."""
    s = shares.select(F.col("source").alias("_ss"), F.col("_class").alias("_cc"), "source_size", "target", "_whole", "_p")
    p = per_source.withColumnRenamed("source", "_ps")
    joined = rows.join(s, rows.source.eqNullSafe(s["_ss"]) & (rows["_class"] == s["_cc"]) & (rows["_size"] > 0), "left")
    joined = joined.join(p, joined.source.eqNullSafe(p["_ps"]), "left").drop("_ss", "_cc", "_ps")
    rank = F.when(F.col("_p") > 0, F.col("_odds") / (F.col("_p") / (1 - F.col("_p"))))
    return joined.withColumn("_rank", rank).withColumn(
        "_range", F.floor(F.col("_rank") / (1 + F.col("_rank")) * F.col("_ranges"))
    )


def mixed_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    mix_share: float = MIX_SHARE,
    most_copies: int = MOST_COPIES,
    narrow_only: bool = False,
) -> DataFrame:
    """``docs`` (doc_id, source, text, ...) with size, source_size, target, taken (words) and copies.

    Columns of these names are replaced. With ``narrow_only`` only doc_id and
    source come back of the given columns, and no text is read twice. A null
    source is a source of its own, the last in order. A null or empty text has
    size 0 and is never taken. Rows that repeat a doc_id with the same source and
    size stand or fall together, as they have the same random number. Without any
    word all targets are 0; an empty table gives an empty result.
    """
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "copies")]
    docs = docs.select(*[f"`{c}`" for c in own])
    plain = F.col("source").cast("string"), F.col("doc_id").cast("bigint")
    narrow = cut(with_sizes(docs.select(plain[0].alias("source"), plain[1].alias("doc_id"), "text")).drop("text"))
    shares, per_source = plan(narrow, weights, mix_share, most_copies)
    rows = narrow if narrow_only else with_sizes(docs.withColumns({"source": plain[0], "doc_id": plain[1]}))
    found = ranked(rows, shares, per_source)
    key = F.struct("_rank", F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"), "_size")
    # Without an open range the whole rest is taken.
    drawn = F.col("_open").isNull() | (F.col("_range") < F.col("_open")) | ((F.col("_range") == F.col("_open")) & (key <= F.col("_limit")))
    extra = F.when(F.col("_rank").isNotNull() & F.coalesce(drawn, F.lit(False)), 1).otherwise(0)
    copies = F.coalesce(F.col("_whole") + extra, F.lit(0)).cast("int")
    sources = shares.groupBy(F.col("source").alias("_s")).agg(F.max("source_size").alias("_n"), F.max("target").alias("_t"))
    # Rows of size 0 have no share of their own: their source's figures come from the source.
    found = found.drop("source_size", "target").join(sources, F.col("source").eqNullSafe(F.col("_s")), "left")
    kept = ["doc_id", "source"] if narrow_only else own
    return found.select(
        *[f"`{c}`" for c in kept], F.col("_size").alias("size"), F.coalesce("_n", F.lit(0)).cast("bigint").alias("source_size"),
        F.coalesce("_t", F.lit(0.0)).alias("target"), (copies * F.col("_size")).alias("taken"), copies.alias("copies"),
    )


def op7_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The mix of all documents."""
    mix = mixed_sources(table(spark, folder, "documents"), narrow_only=True)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


MIX_SQL = rf"""
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
        (('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, {HASH_DIGITS}))::bigint + 0.5) / {float(16**HASH_DIGITS)} as u
    from documents
), classes as (
    select source, length(bin(size)) as class, sum(size)::bigint as words from sized group by all
), sources as (
    select source, sum(words)::bigint as source_size,
        [{", ".join(map(str, WEIGHTS))}][(row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1] as weight
    from classes group by source
), marked as (
    select *, {MIX_SHARE} * sum(source_size) over () as amount, {MOST_COPIES} * source_size as most
    from sources
), own as (
    select *, (amount - coalesce(sum(most) over upward, 0)) / sum(weight) over onward as own
    from marked
    window upward as (order by most / weight, source rows between unbounded preceding and 1 preceding),
        onward as (order by most / weight, source rows between current row and unbounded following)
), targets as (
    select source, source_size, case when most <= own * weight then most::double else weight
        * ((amount - coalesce(sum(most) filter (most <= own * weight) over (), 0)) / sum(weight) filter (most > own * weight) over ()) end as target
    from own
), class_own as (
    select c.*, t.source_size, t.target, {MOST_COPIES} * words as most, words * (class + {LENGTH_BASE}) as weight,
        (target - coalesce(sum({MOST_COPIES} * words) over upward, 0)) / sum(words * (class + {LENGTH_BASE})) over onward as own
    from classes c join targets t on c.source is not distinct from t.source
    where words > 0
    window upward as (partition by c.source order by ({MOST_COPIES} * words) / (words * (class + {LENGTH_BASE})), class
            rows between unbounded preceding and 1 preceding),
        onward as (partition by c.source order by ({MOST_COPIES} * words) / (words * (class + {LENGTH_BASE})), class
            rows between current row and unbounded following)
), shares as (
    select source, class, words, target, least({MOST_COPIES}.0::double, (case when most <= own * weight then most::double else weight
        * ((target - coalesce(sum(most) filter (most <= own * weight) over per, 0)) / sum(weight) filter (most > own * weight) over per) end)
        / words) as expected
    from class_own window per as (partition by source)
), rest as (
    select source, max(target) - sum(floor(expected) * words) as rest from shares group by source
), ranked as (
    select d.doc_id, d.source, d.size, floor(s.expected) as whole, r.rest,
        case when s.expected > floor(s.expected) then
            (u / (1 - u)) / ((s.expected - floor(s.expected)) / (1 - (s.expected - floor(s.expected)))) end as rank
    from sized d left join shares s on d.source is not distinct from s.source and length(bin(d.size)) = s.class and d.size > 0
    left join rest r on d.source is not distinct from r.source
), drawn as (
    select doc_id, source, size, whole, case when rank is not null
        and 2 * coalesce(sum(case when rank is not null then size end) over upward, 0) + size <= 2 * rest then 1 else 0 end as extra
    from ranked
    window upward as (partition by source order by rank nulls last, doc_id, size rows between unbounded preceding and 1 preceding)
)
select d.doc_id, d.size, t.source_size, t.target, (coalesce(whole + extra, 0) * d.size)::bigint as taken
from drawn d join targets t on d.source is not distinct from t.source
"""
