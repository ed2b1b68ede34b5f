from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from shelfwise.llm import collocations, oracles, queries
from shelfwise.llm.collocations import best_phrases, mine_phrases



def plain(rows, words, at_least, per_cent):
    """All phrases with their counts, in dictionaries."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = tuple(re.findall("[^ \t]+", piece))
            totals[lang] += len(w)
            for m in range(1, words + 1):
                counts.update((lang, w[i : i + m]) for i in range(len(w) - m + 1))
    often = {k: f for k, f in counts.items() if f >= at_least and len(k[1]) > 1}
    out = set()
    for (lang, p), a in often.items():
        holds = [f for (other, q), f in often.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * f >= per_cent * a for f in holds):
            continue
        score, _, left, right = min((1000000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
        out.add((lang, " ".join(p), a, left, right, totals[lang], score))
    return out


def texts(seed, n):
    random_ = random.Random(seed)
    words = ["the", "The", "new", "york", "times", "é", "ü-x", "a", "of", "city"]
    joints = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "]
    return [
        (random_.choice(["en", "de", None]), "".join(random_.choice(words) + random_.choice(joints) for _ in range(random_.randrange(40))))
        for _ in range(n)
    ]


ODD = [("en", ""), (None, None), ("en", " . , "), ("en", "the same. " * 50), ("fr", "x y z"), ("en", "new york " * 3000)]


@pytest.mark.parametrize("words,at_least,per_cent", [(3, 10, 50), (2, 1, 50), (4, 3, 90), (3, 5, 1)])
def test_against_plain_version(spark, words, at_least, per_cent):
    rows = texts(1, 80) + ODD
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, f int")
    got = mine_phrases(frame, words=words, min_count=at_least, per_cent=per_cent, bits=10)
    assert {tuple(r) for r in got.collect()} == plain(rows, words, at_least, per_cent)


def test_small_blocks_slabs_and_filters_change_nothing(spark, monkeypatch):
    rows = texts(2, 120) + ODD
    frame = spark.createDataFrame(rows, "lang string, text string")
    want = plain(rows, 3, 2, 50)
    monkeypatch.setattr(collocations, "BLOCK_ROWS", 7)
    monkeypatch.setattr(collocations, "SLAB", 50)
    for bits in (6, 20):  # a filter that lets all pass, and one that holds
        assert {tuple(r) for r in mine_phrases(frame, min_count=2, bits=bits).collect()} == want


def test_empty_and_order(spark):
    frame = spark.createDataFrame([], "lang string, text string")
    assert mine_phrases(frame).count() == 0
    rows = [("en", p, 10, 1, 1, 1, s) for p, s in (("é x", 5), ("b c", 5), ("z z", 9), ("a b", 5))] + [("en", "a a", 11, 1, 1, 1, 5), ("de", "q r", 1, 1, 1, 1, 1)]
    ranked = best_phrases(spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long"), 4)
    assert sorted((r["lang"], r["rank"], r["phrase"]) for r in ranked.collect()) == [
        ("de", 1, "q r"), ("en", 1, "z z"), ("en", 2, "a a"), ("en", 3, "a b"), ("en", 4, "b c"),
    ]


def test_large_counts_stay_exact(spark):
    """Scores of counts whose products pass 64 bits."""
    f, left, right = 3_000_000_000_007, 5_000_000_000_011, 4_000_000_000_003
    stream = [("en", "a", left), ("en", "b", right), ("en", "a b", f)]
    frame = spark.createDataFrame(stream, "lang string, phrase string, f long")
    levels = [collocations.write_down(frame.where("phrase NOT LIKE '% %'"), "one"), collocations.write_down(frame.where("phrase LIKE '% %'"), "two")]
    totals = collocations.write_down(spark.createDataFrame([("en", 9)], "lang string, n long"), "totals")
    before = collocations.count_phrases
    collocations.count_phrases = lambda *_: (levels, totals)
    try:
        (row,) = mine_phrases(spark.createDataFrame([], "lang string, text string"), words=2).collect()
    finally:
        collocations.count_phrases = before
    assert row["score"] == 1000000 * f * f // (left * right)


def test_against_sql(spark):
    import oracle

    name = "op12_collocations"
    for small in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        assert oracle.compare(spark, oracle.connect(small), queries.QUERIES[name], oracles.ORACLES[name], small) is None
