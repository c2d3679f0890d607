import zlib

import numpy as np
import pytest

from catalog_engine.llm import factorization as fm
from catalog_engine.llm.common import table

FOLDER = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect() if r.quality in (0, 1)}
    found = fm.op11_factorization_quality(spark, FOLDER).collect()
    assert len(found) == table(spark, FOLDER, "documents").count()
    right = {0: [], 1: []}
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        if r.held_out and r.doc_id in labels:
            right[labels[r.doc_id]].append(r.predicted == labels[r.doc_id])
    assert np.mean(right[0]) > 0.95 and np.mean(right[1]) > 0.98 and min(map(len, right.values())) > 50


def plain_score(machine, pairs):
    """All pairwise interactions written out."""
    z = float(machine.bias[0]) + sum(float(machine.linear[i]) * x for i, x in pairs)
    for a in range(len(pairs)):
        for b in range(a + 1, len(pairs)):
            (i, x), (j, y) = pairs[a], pairs[b]
            z += float(machine.factors[i].astype(float) @ machine.factors[j].astype(float)) * x * y
    return 1 / (1 + np.exp(-z))


def random_machine(seed=0):
    random = np.random.default_rng(seed)
    machine = fm.Machine.fresh(0.4, seed)
    machine.linear = random.normal(size=fm.N_FEATURES)
    machine.factors = random.normal(size=(fm.N_FEATURES, fm.FACTORS)) * 0.4
    machine.bias = np.array([0.3])
    return machine


TEXTS = ["", "One two two.\nOne two two.", "ÜBER ###  日本 42", "a " * 3_000, "no"]


def test_scores_are_those_of_all_pairs():
    machine = random_machine()
    rows = fm.features([t.encode() for t in TEXTS], [0, None, 5, 6_000, 2])
    found = machine.scores(rows)
    for k in range(len(TEXTS)):
        at = slice(rows.starts[k], rows.starts[k + 1])
        pairs = list(zip(rows.index[at].tolist(), rows.value[at].tolist()))
        assert len({i for i, _ in pairs}) == len(pairs) >= fm.STATISTICS + fm.METADATA
        assert found[k] == pytest.approx(plain_score(machine, pairs), abs=1e-6)


def test_gradients_are_those_of_the_loss():
    machine = random_machine(1)
    rows = fm.features([t.encode() for t in TEXTS], [None] * 5)
    rows.value = rows.value.astype(np.float64)
    labels, importance = np.array([1, 0, 1, 0, 0]), np.array([0.1, 0.3, 0.2, 0.3, 0.1])

    def loss():
        z = machine.sums(rows)[0]
        return (importance * (np.logaddexp(0, z) - labels * z)).sum()

    for name, gradient in machine.gradients(rows, labels, importance).items():
        weight = getattr(machine, name)
        at = np.unravel_index(np.argmax(np.abs(gradient)), gradient.shape)
        kept = weight[at]
        weight[at] = kept + 1e-4
        above = loss()
        weight[at] = kept - 1e-4
        below = loss()
        weight[at] = kept
        assert gradient[at] == pytest.approx((above - below) / 2e-4, rel=1e-3), name


def test_words_count_whole_texts():
    """A word at the very end of a long text changes its features."""
    head = "same words " * 20_000
    a, b = (fm.features([(head + end).encode()], [None]) for end in ("left", "right"))
    assert set(a.index.tolist()) != set(b.index.tolist())


def test_rows(spark):
    texts = [None, "", "# $ %", "good words here", "fine words there", "x" * 50_000, "fine words there"]
    docs = spark.createDataFrame(
        [(i, t, "l", "s", 0.5, 1) for i, t in enumerate(texts)] + [(None, "no id", "l", "s", 0.5, 1), (3, "good words here", "l", "s", 0.5, 1)],
        "doc_id long, text string, lang string, source string, score double, quality int",
    )
    labels = spark.createDataFrame([(3, 1), (4, 0), (5, None), (6, 1), (99, 1), (None, 1), (3, 1), (2, 7)], "doc_id long, quality int")
    model = fm.fitted(docs, labels)
    assert isinstance(model, fm.Machine)
    found = fm.score(docs, model)
    assert found.columns == ["doc_id", "score", "predicted"]
    found = sorted(found.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [r.doc_id for r in found] == [0, 1, 2, 3, 3, 4, 5, 6, None] and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[0] == by_id[1] and found[3].score == found[4].score and by_id[4] == by_id[6]
    for none, share in ((labels.limit(0), 0.0), (labels.filter("quality = 1"), 1.0)):
        assert {r.score for r in fm.score(docs, fm.fitted(docs, none)).collect()} == {share}
    assert fm.score(docs.limit(0), model).collect() == []
    assert isinstance(fm.fitted(docs.limit(0), labels), float)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.createDataFrame([(i, f"text {i % 3} of {i}") for i in range(60)], "doc_id long, text string")
    rows = [(i, int(i % 3 == 0)) for i in range(60)]
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    flipped = [(i, 1 - q if i in held else q) for i, q in rows]
    one, two = (fm.fitted(docs, spark.createDataFrame(r, "doc_id long, quality int")) for r in (rows, flipped))
    assert held and np.array_equal(one.factors, two.factors) and np.array_equal(one.linear, two.linear)
