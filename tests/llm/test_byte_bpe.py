from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from shelfwise.llm import queries
from shelfwise.llm.byte_bpe import Prefixes, Vocabulary, decode, edit, encode

SCRAPS = ["ab", "the", "in", "g", "  ", "\n", "'l", "l", "é", "ü", "日本", "😀", " ", "aaaa", "1", "23", "!!", "==", " \t", "\r\n", "'s"]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).ready()


@pytest.fixture(scope="module")
def theirs(vocabulary):
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ids, special_tokens={})


def scraps(random_, most=40):
    return "".join(random_.choice(SCRAPS) for _ in range(random_.randrange(most)))


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_as_the_library(name):
    mine = Vocabulary.read(public_tokenizers.path(name), public_tokenizers.PATTERN).ready()
    library = tiktoken.Encoding("own", pat_str=mine.pattern, mergeable_ranks=mine.ids, special_tokens={})
    random_ = random.Random(5)
    texts = [scraps(random_) for _ in range(800)]
    for packed, text in zip(mine.packed(texts), texts, strict=True):
        assert np.frombuffer(packed, np.int32).tolist() == library.encode_ordinary(text)
        assert mine.packed_long(text) == packed


def test_forgotten_pieces_are_learnt_again(vocabulary, theirs, monkeypatch):
    from shelfwise.llm import byte_bpe

    monkeypatch.setattr(byte_bpe, "PIECES", 5)
    monkeypatch.setattr(byte_bpe, "PAIRS", 5)
    random_ = random.Random(6)
    for _ in range(100):
        texts = [scraps(random_), scraps(random_)]
        assert [np.frombuffer(p, np.int32).tolist() for p in vocabulary.packed(texts)] == [theirs.encode_ordinary(t) for t in texts]


def test_prefixes_appends_and_edits(vocabulary):
    random_ = random.Random(7)
    for _ in range(200):
        data = bytes(random_.choice(b"abcdefgh eeetttaan") for _ in range(random_.randrange(1, 60)))
        row = Prefixes(vocabulary, data)
        for end in range(1, len(data) + 1):
            assert row.encoding(end) == vocabulary.merged(data[:end])
        row.append(b"ing the")
        assert row.encoding() == vocabulary.merged(data + b"ing the")
        begin = random_.randrange(len(data))
        stop = random_.randrange(begin, len(data) + 1)
        row.replace(begin, stop, b"xyz")
        assert row.encoding() == vocabulary.merged(data[:begin] + b"xyz" + data[stop:] + b"ing the")


def test_an_edit_computes_only_what_is_near(vocabulary):
    data = b"abcdefghij" * 2000
    row = Prefixes(vocabulary, data)
    assert row.replace(100, 101, b"z") < 1000
    assert row.encoding() == Prefixes(vocabulary, data[:100] + b"z" + data[101:]).encoding()


def test_tables(spark, docs, vocabulary, theirs):
    encoded = encode(docs, vocabulary)
    assert encoded.columns == ["doc_id", "tokens"] and encoded.count() == docs.count()
    back = decode(encoded, vocabulary)
    texts = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert sorted((r["doc_id"], bytes(r["decoded"]).decode()) for r in back.collect()) == texts
    ids = {r["doc_id"]: r["tokens"] for r in encoded.collect()}
    assert all(ids[n] == theirs.encode_ordinary(t) for n, t in texts)
    assert encode(docs.limit(0), vocabulary).count() == 0
    assert decode(encoded.limit(0), vocabulary).count() == 0


def test_nulls_long_texts_and_clashing_names(spark, vocabulary, theirs, monkeypatch):
    from shelfwise.llm import byte_bpe

    monkeypatch.setattr(byte_bpe, "TEXT_CHARS", 50)
    monkeypatch.setattr(byte_bpe, "LONG_PIECES", 7)
    monkeypatch.setattr(byte_bpe, "BATCH_TOKENS", 20)
    long = "some words, again and again; " * 300
    rows = [(None, "no key", "x"), (1, None, "x"), (1, None, "x"), (2, long, "y")]
    frame = spark.createDataFrame(rows, "doc_id string, text string, decoded string")
    out = decode(encode(frame, vocabulary), vocabulary).collect()
    assert sorted((str(r["doc_id"]), bytes(r["decoded"]).decode()) for r in out) == sorted([("None", "no key"), ("1", ""), ("1", ""), ("2", long)])
    odd = spark.createDataFrame([(1, None, "a"), (2, [1, 2], "b")], "doc_id int, tokens array<int>, decoded string")
    assert {r["doc_id"]: bytes(r["decoded"]) for r in decode(odd, vocabulary).collect()} == {1: b"", 2: vocabulary.tokens[1] + vocabulary.tokens[2]}


def test_edits_of_stored_tokens(spark, vocabulary, theirs):
    random_ = random.Random(8)
    rows, want = [], {}
    for n in range(150):
        text, new = scraps(random_), random_.choice(["", "x", "ing", "  ", "'ll", " the"])
        begin = random_.randrange(len(text) + 1)
        stop = random_.randrange(begin, len(text) + 1)
        rows.append((n, theirs.encode_ordinary(text), begin, stop, new))
        want[n] = theirs.encode_ordinary(text[:begin] + new + text[stop:])
    rows.append((200, None, None, None, None))
    want[200] = []
    rows.append((201, theirs.encode_ordinary("a b"), 50, 60, "c"))
    want[201] = theirs.encode_ordinary("a bc")
    frame = spark.createDataFrame(rows, "doc_id bigint, tokens array<int>, start int, stop int, new string")
    assert {r["doc_id"]: r["tokens"] for r in edit(frame, vocabulary).collect()} == want


def test_query(spark, theirs):
    small = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_byte_bpe(spark, small).collect()}

    def sha(data):
        return hashlib.sha256(data).hexdigest()

    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = theirs.encode_ordinary(r["text"] or "")
        assert got[r["doc_id"]] == (len(ids), sha(" ".join(map(str, ids)).encode()), sha((r["text"] or "").encode()))
