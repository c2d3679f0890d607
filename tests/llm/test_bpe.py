import hashlib
import random
import struct
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from catalog_engine.llm import bpe
from catalog_engine.llm.common import table

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def judge():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.Vocabulary.from_json(open(PATH, encoding="utf-8").read()))


def expected(judge, doc_id, text):
    ids = judge.encode(text or "", add_special_tokens=False).ids
    decoded = judge.decode(ids, skip_special_tokens=False)
    return (
        doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


def test_all_characters(judge, coder):
    """Letters, numbers and white space are the same characters to both, each beside a letter, a digit and a space."""
    texts = []
    for at in range(0, sys.maxunicode, 64):
        some = [chr(c) for c in range(at, at + 64) if not 0xD800 <= c < 0xE000]
        texts.append("".join(f"a{c}1{c} {c}\n" for c in some))
    differ = []
    for text, ids in zip(texts, coder.encode(texts)):
        right = judge.encode(text, add_special_tokens=False).ids
        if right != ids.tolist():
            differ.append(text[1])
        assert coder.decode(ids) == judge.decode(right, skip_special_tokens=False)
    assert differ == []


def test_words_and_runs(judge, coder):
    random.seed(3)
    texts = ["", " ", "  \n\n x", "aaaaaaaaaaaaaa" * 50, "it's they'll WE'RE 'tis", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoft",
             "\x1c\x1d\x1e\x1f \x85\xa0 ", "é" * 999, "ab" * 2000, "x" * 50_000, "ſ 123456 ½ ๓", "\r\n\t\x0b"]
    texts += ["".join(random.choices("abcdefgh '\n1é<|>", k=200)) for _ in range(300)]
    for text, ids in zip(texts, coder.encode(texts)):
        assert judge.encode(text, add_special_tokens=False).ids == ids.tolist(), text[:50]
    coder.forget()
    assert [i.tolist() for i in coder.encode(texts[-5:])] == [judge.encode(t).ids for t in texts[-5:]]


def test_rows(spark, judge):
    rows = [(1, None), (2, ""), (2, "two two"), (2, "two two"), (None, "x <|endoftext|>"), (4, "long " * 40_000)]
    docs = spark.createDataFrame([(d, t, [1], "z") for d, t in rows], "doc_id long, text string, token_ids array<int>, whole string")
    found = sorted(map(tuple, bpe.digests(docs, PATH).collect()), key=repr)
    assert found == sorted((expected(judge, d, t) for d, t in rows), key=repr)
    kept = bpe.with_tokens(docs, PATH)
    assert kept.columns == ["doc_id", "text", "whole", "token_ids", "decoded"]
    assert {r.whole for r in kept.collect()} == {"z"}
    lists = {r.text: r.token_ids for r in kept.collect()}
    packed = {r.text: list(struct.unpack(f"<{len(r.token_ids) // 4}I", r.token_ids)) for r in bpe.with_tokens(docs, PATH, packed=True).collect()}
    assert lists == packed and lists["two two"] == judge.encode("two two").ids
    assert bpe.digests(docs.limit(0), PATH).collect() == []


def test_query(spark, judge):
    docs = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    found = sorted(map(tuple, bpe.op5_bpe_encode_decode(spark, FOLDER).collect()))
    assert found == sorted(expected(judge, r.doc_id, r.text) for r in docs)
