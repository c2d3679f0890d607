import hashlib
import struct

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from catalog_engine.llm import recompress, toxicity
from catalog_engine.llm.common import table
from catalog_engine.session import cut
from tests.llm.test_mixing import slow_targets
from tests.llm.test_recompress import slow as slow_repeats
from tests.llm.test_simhash import slow_groups

FOLDER = "/root/testdata/sf0.001"


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages_against_brute_force(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(cut(stage(spark, kept[-1], FOLDER)))
    assert all(d.columns == columns for d in kept[:-1])
    before, clean, single, cut_down, mix, tokens = [d.collect() for d in kept]

    model = toxicity.fitted(docs, table(spark, FOLDER, "labels"))
    bad = {r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted}
    assert sorted(clean) == sorted(r for r in before if r.doc_id not in bad)

    groups = slow_groups([(r.doc_id, r.text) for r in clean])
    assert sorted(r.doc_id for r in single) == sorted({g[2] for g in groups})
    assert set(single) <= set(clean)

    right = {r[0]: r for r in slow_repeats([(r.doc_id, r.text) for r in single])}
    whole = {r.doc_id: r.text for r in single}
    assert sorted(r.doc_id for r in cut_down) == sorted(whole)
    for r in cut_down:
        words = r.text.encode().split()
        assert len(words) == right[r.doc_id][1] - right[r.doc_id][2] and r.n_chars == len(r.text)
        assert r.text == whole[r.doc_id] or hashlib.sha256(r.text.encode()).hexdigest() == right[r.doc_id][3]

    sizes, taken = {}, {}
    for r in cut_down:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.encode().split())
    for r in mix:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.encode().split())
    longest = max(len(r.text.encode().split()) for r in cut_down)
    assert set(mix) <= set(cut_down)
    for source, target in slow_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= longest

    judge = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for r in mix:
        ids = judge.encode(r.text, add_special_tokens=False).ids
        expected.append((r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    assert sorted(map(tuple, tokens)) == sorted(expected)


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, size int"
    rows = [(1, "plain words of a text", "en", "a", 21, 0.1, 4), (1, "plain words of a text", "en", "a", 21, 0.1, 4), (2, None, None, None, None, None, None),
            (None, "other words here now", None, "b", 20, 1.0, 1), (None, "other words here now", None, "b", 20, 1.0, 1), (3, "", "en", "b", 0, 0.0, 0)]
    docs = spark.createDataFrame(rows, schema)
    single = corpus_pipeline.without_near_copies(spark, docs, FOLDER)
    assert plain(single.select("doc_id", "text")) == [(1, "plain words of a text"), (2, None), (None, "other words here now")]
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, some, FOLDER)
            assert name == "bpe_encode_decode" or out.columns == docs.columns
            out.collect()


def test_registered():
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert recompress.op10_substring_dedup in contract.queries().values()
