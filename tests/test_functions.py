"""Column functions on hand-made rows: missing, empty, tied and repeated values."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from catalog_engine.functions import dates, links, lists, pages, text

STRINGS = "array<string>"
URLS = "array<struct<url:string>>"


@pytest.fixture
def apply(spark):
    """Values of an expression over one input column, in input order."""

    def run(kind, values, expression):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        rows = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
        return [r["y"] for r in rows]

    return run


@pytest.fixture
def apply2(spark):
    def run(kind, pairs, expression):
        df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], f"i int, a {kind}, b {kind}")
        rows = df.select("i", expression(F.col("a"), F.col("b")).alias("y")).orderBy("i").collect()
        return [r["y"] for r in rows]

    return run


def test_short_id(apply):
    values = ["https://h/m/a-b", "abc", "https://h/m/", None]
    assert apply("string", values, text.short_id) == ["a-b", "abc", "", None]


def test_year_number(apply):
    assert apply("string", ["2011", "2011.0", "abc", None], text.year_number) == [2011, 2011, None, None]
    assert apply("string", ["12", "x", ""], text.to_int) == [12, None, None]


def test_dates(apply, apply2):
    day = datetime.date
    assert apply("bigint", [0, 86_399, 86_400, -1, None], dates.epoch_date) == [
        day(1970, 1, 1), day(1970, 1, 1), day(1970, 1, 2), day(1969, 12, 31), None,
    ]
    assert apply("double", [1325721600.0, None], dates.epoch_date) == [day(2012, 1, 5), None]
    assert apply("string", ["2012-01-05", "", "soon", None], dates.iso_date) == [day(2012, 1, 5), None, None, None]
    early, late = day(2011, 1, 1), day(2012, 1, 5)
    pairs = [(early, late), (late, early), (None, late), (late, None), (None, None)]
    assert apply2("date", pairs, dates.earliest) == [early, early, late, late, None]
    assert apply2("date", pairs, dates.latest) == [late, late, late, late, None]


def test_epoch_seconds(spark):
    rows = spark.sql("SELECT timestamp_ntz'2024-03-31 02:30:01.5' AS t")
    assert rows.select(dates.epoch_seconds(F.col("t"))).first()[0] == 1711852201


def test_slugs_and_keywords(apply):
    assert apply(STRINGS, [["h/t/pop-culture-x", "plain"], [], None], text.slug_words) == [
        ["pop culture x", "plain"], [], None,
    ]
    values = [["a,geo:,time:all},{keyword:b", "u4dcub77", "#tag", 'q"\\\'x', "(u", "/m/1"], [], None]
    assert apply(STRINGS, values, text.clean_keywords) == [["ab", "tag", "qx"], [], []]
    assert apply(STRINGS, [["meme", "a", "memes", "Meme", "a"], None], text.drop_tags) == [["a", "Meme", "a"], []]


def words(phrases):
    """The reference meaning of a keyword list, word by word."""
    import string

    found = set()
    for phrase in phrases:
        for word in phrase.split(" "):
            word = "".join(c for c in word.strip().lower() if c not in string.punctuation + string.digits)
            if len(word) > 1:
                found.add(word)
    return sorted(found) or None


def test_keyword_set(apply):
    values = [
        ["Hello World!", "b2b a", "hello"],
        ["\n!x  y\t \x0b ab  c", "!\nx", "a\nb", " \n \n ", "　zz　"],
        ["1", "a", ""],
        ["ÀÉ î", "straße STRASSE", "x y  w "],
    ]
    assert apply(STRINGS, values, text.keyword_set) == [words(v) for v in values]
    assert apply(STRINGS, [[], None], text.keyword_set) == [None, None]
    assert apply(STRINGS, [["the", "cat", "cat", "a"], ["the"], None], text.drop_words) == [["a", "cat"], None, None]


def test_sections(spark):
    from catalog_engine import schemas

    def section(texts=None, images=None, **below):
        parts = {"text": texts, "images": images, "subsections": {k: {"text": v} for k, v in below.items()}}
        return {k: v for k, v in parts.items() if v is not None}

    rows = [
        (1, {"origin": section(["a[1]", "Work In Progress"]), "origins": section(None, None, x=["b"])}),
        (2, {"origin": section(["kept"], None, x=["hidden"]), "other": section(["no"])}),
        (3, {"origin": section([], None, x=["hidden"])}),
        (4, {}),
        (5, None),
        (6, {"origin": section([""])}),
        (7, {"examples": section(None, ["i1", "i2"]), "derivatives": section(None, ["i3"])}),
    ]
    kind = schemas.ENTRIES[schemas.ENTRIES.index("content map") + len("content ") : schemas.ENTRIES.index("parent string")]
    # Through JSON, as in the source: a map made in Python loses its order.
    texts = [(i, None if c is None else json.dumps(c)) for i, c in rows]
    df = spark.createDataFrame(texts, "i int, c string").withColumn("c", F.from_json("c", kind.strip().rstrip(",")))
    names = ["origin", "origins"]
    found = df.select(
        "i",
        text.strip_markers(text.section_text(F.col("c"), names)).alias("t"),
        text.section_images(F.col("c"), ["examples", "derivatives"]).alias("m"),
    )
    by_id = {r["i"]: (r["t"], r["m"]) for r in found.collect()}
    assert by_id == {
        1: ("a\nb\n", None), 2: ("kept\n", None), 3: (None, None), 4: (None, None), 5: (None, None),
        6: ("\n", None), 7: (None, ["i1", "i2", "i3"]),
    }


def test_texts(apply, apply2):
    assert apply("string", ["a[1] b[] c[a]", "", None], text.strip_markers) == ["a b c[a]", None, None]
    pairs = [("ab", "cd"), (None, "c"), ("abc", "d"), ("x", None), (None, None)]
    assert apply2("string", pairs, text.longer_text) == ["cd", "c", "abc", "x", None]
    assert apply2("string", [("o", "n"), ("o", ""), ("o", None)], text.override_text) == ["n", "o", "o"]


def test_printed_lists(apply):
    values = ["['a', 'b']", "[]", "['x']", None]
    assert apply("string", values, text.printed_list) == [["a", "b"], [], ["x"], None]
    assert apply("string", ["[0.9, 0.8]", "[]", None], text.printed_numbers) == [[0.9, 0.8], [], None]


def test_is_link(apply):
    values = [
        "http://en.site.org/x", "http://nl.site.nl/x", "www.a", "http://a b.com", "encyclopediadramatica.wiki/x",
        "pt.site.org", "plain words", "https://youtu.be/abc", None,
    ]
    assert apply("string", values, links.is_link) == [True, False, False, False, True, False, False, False, None]


def test_classify_links(spark):
    found = {
        "Wikipedia": "http://en.wikipedia.org/a", "W2": "http://en.wikipedia.org/b",
        "o1": "http://one.org/x", "o2": "http://two.org/x",
        "Facebook": "http://site.org/f", "Twitter": "http://reddit.com/twitter",
    }
    read = F.from_json("m", "map<string,string>")
    row = spark.createDataFrame([(json.dumps(found),)], "m string").select(
        links.classify_links(F.map_entries(read)).alias("r")
    ).first()["r"]
    assert row.asDict() == {
        "ref_wikipedia": "http://en.wikipedia.org/b", "ref_urban_dict": None, "ref_encyc_dramatica": None,
        "ref_meme_generator": None, "ref_reddit": "http://reddit.com/twitter", "ref_twitter": None,
        "ref_other": "http://one.org/x",
    }


def test_url_lists(apply, apply2):
    mixed = [(f"http://h/{i}",) for i in range(5)] + [(f"http://own-cdn/{i}",) for i in range(3)]
    values = [mixed, [("http://own-cdn/1",)], [], None]
    assert apply(URLS, values, lambda c: links.collect_urls(c, 6, "own-cdn")) == [
        [f"http://h/{i}" for i in range(5)], None, None, None,
    ]
    assert apply(URLS, values[:1], lambda c: links.collect_urls(c, 6)) == [[u for u, in mixed[:6]]]
    pairs = [(["a", "b"], list("cdefgh")), (None, ["c"]), (list("abcdef"), ["x"]), (None, None)]
    assert apply2(STRINGS, pairs, lambda a, b: links.top_up(a, b, 6)) == [
        list("abcdef"), ["c"], list("abcdef"), None,
    ]


def test_list_columns(apply2, spark):
    pairs = [(None, ["a"]), (["a"], None), (["a"], ["a"]), ([], None), ([], ["b"])]
    assert apply2(STRINGS, pairs, lists.merge_lists) == [["a"], ["a"], ["a", "a"], None, ["b"]]
    assert apply2(STRINGS, pairs, lists.union_lists) == [["a"], ["a"], ["a"], [], ["b"]]
    df = spark.createDataFrame(
        [(["k"], "l"), ([""], "l"), (["k"], None), (None, "l"), ([], "l")], "k array<string>, l string"
    )
    found = [r[0] for r in df.select(lists.append_label(F.col("k"), F.col("l"))).collect()]
    assert found == [["k", "l"], ["l"], ["k"], ["l"], ["l"]]


def test_first_per_form(apply):
    kind = "array<struct<form:string,score:string,link:string>>"
    values = [
        [("x", "0.5", "1"), ("y", "0.9", "2"), ("x", "0.99", "3")],
        [("meme", "1", "1")],
        [("a", None, "1"), ("c", "0.5", "2"), ("b", "0.5", "3"), ("c", "0.7", "4")],
        [],
        None,
    ]
    found = apply(kind, values, lambda c: lists.first_per_form(c, "form", "score", "link"))
    assert [f and (f["keywords"], f["scores"], f["links"]) for f in found] == [
        (["y", "x"], [0.9, 0.5], ["2", "1"]), None, (["b", "c", "a"], [0.5, 0.5, None], ["3", "2", "1"]), None, None,
    ]


def test_pages(spark):
    html = (
        '<div class="x views" title="136,011 Views"><b>v</b></div><div class="author-info">'
        '<p>Added <abbr title="2012-01-05T10:00:00">then</abbr> by <a href="/users/ann">Ann</a></p>'
        '<p>Updated <abbr title="2013-02-06T10:00:00">later</abbr> by <a class="q" href="/users/bob">Bob</a></p></div>'
    )
    df = spark.createDataFrame([(1, 200, html), (2, 404, None), (3, 200, "<p>Added</p>")], "i int, code int, html string")
    rows = df.select("i", pages.page_record(F.col("code"), F.col("html")).alias("r")).select("i", "r.*").orderBy("i").collect()
    assert [tuple(r) for r in rows] == [
        (1, 136011, "ann", "bob", "2012-01-05", "2013-02-06"), (2, 0, "", "", "", ""), (3, None, None, None, None, None),
    ]


def test_texts_are_searched_for_literal_parts_without_patterns(spark, apply):
    values = ["x.y [1]", "", None, "In Progress", "a+b", "[]", "[x]"]
    assert apply("string", values, lambda t: text.contains_any(t, ["a+", "."])) == [True, False, None, False, True, False, False]
    assert apply("string", values, lambda t: text.contains_any(t, [])) == [False] * 7
    assert apply("string", values, text.strip_markers) == ["x.y ", None, None, "In Progress", "a+b", "", "[x]"]
    content = F.expr("map('a', named_struct('text', array(t, null, 'NOT available', 'x'), 'images', null, 'subsections', null))")
    content = content.cast("map<string,struct<text:array<string>,images:array<string>,subsections:map<string,struct<text:array<string>,images:array<string>>>>>")
    df = spark.createDataFrame([(v,) for v in values], "t string")
    assert [r[0] for r in df.select(text.section_text(content, ["a"])).collect()] == ["x.y [1]\nx\n", "\nx\n", "x\n", "x\n", "a+b\nx\n", "[]\nx\n", "[x]\nx\n"]
    found = df.select(text.contains_any(F.col("t"), ["a+", "."]), text.section_text(content, ["a"]))
    assert "RLIKE" not in found._jdf.queryExecution().optimizedPlan().toString().upper()
