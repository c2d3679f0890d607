import zlib

import numpy as np
import pytest

from catalog_engine.llm import toxicity
from catalog_engine.llm.common import table

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def rows(spark):
    labels = table(spark, FOLDER, "labels")
    docs = table(spark, FOLDER, "documents").join(labels, "doc_id").select("doc_id", "text", "toxic")
    return sorted(map(tuple, docs.collect()))


def test_held_out_rows(spark, rows):
    found = {r.doc_id: r for r in toxicity.op6_toxicity(spark, FOLDER).collect()}
    assert len(found) == table(spark, FOLDER, "documents").count()
    judged = []
    for doc_id, _, toxic in rows:
        r = found[doc_id]
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if r.held_out:
            judged.append((toxic, r.predicted))
    judged = np.array(judged)
    assert (judged[:, 0] == judged[:, 1]).mean() > 0.95
    assert judged[judged[:, 0] == 1, 1].mean() > 0.85


def test_gradients_are_those_of_the_loss():
    random = np.random.default_rng(0)
    words = ["ab", "cde", "é", "fghij", "k"]
    network = toxicity.Network.fresh({"ab": 1, "cde": 2}, 0.5, 1)
    network.weights = {k: random.normal(size=v.shape) * 0.3 for k, v in network.weights.items()}
    index = random.integers(0, 5, (toxicity.WINDOW_WORDS, 4))
    mask = np.arange(toxicity.WINDOW_WORDS)[:, None] < np.array([32, 5, 1, 20])
    labels, importance = np.array([1, 0, 1, 0]), np.array([0.2, 0.3, 0.4, 0.5])

    def loss():
        logit = network.logits(network.project(network.inputs(words)[0].astype(float)), index, mask)
        return (importance * (np.logaddexp(0, logit) - labels * logit)).sum()

    found = network.gradients(*network.inputs(words), index, mask, labels, importance)
    for name, gradient in found.items():
        weight = network.weights[name]
        at = np.unravel_index(np.argmax(np.abs(gradient)), gradient.shape)
        kept = weight[at]
        weight[at] = kept + 1e-2
        above = loss()
        weight[at] = kept - 1e-2
        below = loss()
        weight[at] = kept
        assert gradient[at] == pytest.approx((above - below) / 2e-2, rel=0.03), name


def test_windows_cover_all_words():
    for n in [0, 1, 16, 17, 31, 32, 33, 48, 49, 500]:
        starts, lengths, _ = toxicity.window_table(np.array([3, n]))
        seen = {w for s, k in zip(starts, lengths) for w in range(s, s + k)}
        assert seen == set(range(3 + n))
        assert (lengths > 0).all() and (lengths <= 32).all()


def test_rows(spark):
    texts = [None, "", "1 2 !", "bad words here", "fine words there", "x" * 50_000, "fine words there"]
    docs = spark.createDataFrame([(i, t, "s", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, score string, c0 double")
    labels = spark.createDataFrame([(3, 1), (4, 0), (5, None), (6, 0), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fitted(docs, labels)
    found = sorted(toxicity.score(docs, model).collect())
    assert [r.doc_id for r in found] == list(range(7)) and found[0].score == found[1].score == found[2].score
    assert found[4].score == found[6].score and all(0 <= r.score <= 1 and r.c0 == 1.0 for r in found)
    for none in (labels.limit(0), labels.filter("toxic = 0")):
        assert {r.score for r in toxicity.score(docs, toxicity.fitted(docs, none)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).collect() == []


def slow_score(network, text):
    """Every window of a text, word by word in plain loops; the highest window's score."""
    words = toxicity.words_of(text)
    if not words:
        return network.prior
    w = {k: v.astype(float) for k, v in network.weights.items()}
    size = toxicity.HIDDEN

    def vector(word):
        buckets, _ = toxicity.char_buckets([word])
        chars = w["chars"][buckets].mean(axis=0) if len(buckets) else np.zeros(toxicity.CHAR_SIZE)
        return np.concatenate([w["words"][network.known.get(word, 0)], chars])

    def states(vectors, way):
        h, out = np.zeros(size), []
        for x in vectors:
            a, g = x @ w[f"{way}x"] + w[f"{way}c"], h @ w[f"{way}h"]
            z, r = (1 / (1 + np.exp(-(a[k : k + size] + g[k : k + size]))) for k in (0, size))
            h = (1 - z) * np.tanh(a[2 * size :] + r * g[2 * size :]) + z * h
            out.append(h)
        return out

    logits, begin = [], 0
    while True:
        vectors = [vector(x) for x in words[begin : begin + toxicity.WINDOW_WORDS]]
        both = np.array([np.concatenate(p) for p in zip(states(vectors, "f"), states(vectors[::-1], "b")[::-1])])
        e = np.exp(np.tanh(both @ w["att"]) @ w["att_v"])
        logits.append((e / e.sum()) @ both @ w["out"] + w["out_c"][0])
        begin += toxicity.STRIDE_WORDS
        if begin + toxicity.STRIDE_WORDS >= len(words):
            break
    return 1 / (1 + np.exp(-max(logits)))


def test_scores_are_those_of_a_slow_pass(monkeypatch):
    random = np.random.default_rng(4)
    network = toxicity.Network.fresh({"bad": 1, "word": 2}, 0.25, 3)
    network.weights = {k: (random.normal(size=v.shape) * 0.5).astype(np.float32) for k, v in network.weights.items()}
    some = ["bad", "word", "other", "words", "ärger", "x"]
    texts = ["", "bad", " ".join(random.choice(some, 17)), " ".join(random.choice(some, 33)), " ".join(random.choice(some, 333)), "1 2 3"]
    expected = [slow_score(network, t) for t in texts]
    assert toxicity.Scorer(network).scores(texts) == pytest.approx(expected, abs=1e-4)
    # Neither runs of windows nor forgetting words in between change a score.
    monkeypatch.setattr(toxicity, "WINDOWS_OF_A_RUN", 3)
    monkeypatch.setattr(toxicity, "KEPT_WORDS", 2)
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", 2)
    assert toxicity.Scorer(network).scores(texts) == pytest.approx(expected, abs=1e-4)


def test_rows_with_features_are_counted_by_text():
    texts = ["aa bb aa", "bb", "", "cc bb"]
    positive = np.array([True, False, True, False])
    sample = toxicity.Sample.of(texts)
    words, grams = sample.rows_with(positive)
    assert dict(zip(sample.unique, words.T.tolist())) == {"aa": [1, 0], "bb": [1, 2], "cc": [0, 1]}
    for side, of in ((0, texts[::2]), (1, texts[1::2])):
        expected = np.zeros(toxicity.CHAR_BUCKETS, int)
        for text in of:
            expected[np.unique(toxicity.char_buckets(toxicity.words_of(text))[0]) if text else []] += 1
        assert (grams[side] == expected).all()


def test_fit_takes_no_more_than_its_bytes(spark):
    docs = spark.createDataFrame([(i, f"{'bad' if i % 2 else 'fine'} " * 100) for i in range(40)] + [(None, "x"), (3, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (5, 1)], "doc_id long, toxic int")
    seen = []
    kept = toxicity.train
    toxicity.train = lambda texts, marks, share, seed=7: (len(texts), sum(map(len, texts)), sorted(set(marks)), share)
    try:
        for per_class, most in ((10, 10**6), (10, 1_300), (1, 10**6)):
            seen.append(toxicity.fit(docs, labels, per_class, most))
    finally:
        toxicity.train = kept
    assert seen[0][0] == 20 and seen[0][2] == [0, 1] and 0.4 < seen[0][3] < 0.6
    assert seen[1][1] <= 2 * 1_300 and seen[1][0] >= 4
    assert seen[2][0] == 2
