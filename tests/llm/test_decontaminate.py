from __future__ import annotations

import random
import re

from shelfwise.llm import decontaminate
from shelfwise.llm.decontaminate import find_contamination


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, items, size):
    out = []
    for _, text in docs:
        w, hit, named, longest = words(text), set(), set(), 0
        for name, item in items:
            v = words(item)
            span = min(size, len(v))
            for i in range(len(v) - span + 1 if v else 0):
                for p in range(len(w) - span + 1):
                    if w[p : p + span] == v[i : i + span]:
                        hit.update(range(p, p + span))
                        named.add(str(name))
                        n = span
                        while p + n < len(w) and i + n < len(v) and w[p + n] == v[i + n]:
                            n += 1
                        longest = max(longest, n)
        out.append((len(w), len(hit), sorted(named), longest, bool(hit)))
    return out


def case(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "b", "C", "é1", "x"])
    text = lambda n: " ".join(word() + r.choice(["", ".", "-!"]) for _ in range(n))
    items = [(i, text(r.choice([0, 1, 2, 5, 9]))) for i in range(6)] + [(10, None), (2, "b b C")]
    docs = [(i, text(r.randint(0, 60))) for i in range(25)] + [(90, None), (91, ""), (92, items[3][1] + " " + text(4)), (92, items[3][1])]
    return docs, items


def test_against_plain_version(spark, monkeypatch):
    for seed, shard, chars in ((1, 1 << 20, 10**6), (2, 16, 10**6), (3, 16, 12)):
        monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
        docs, items = case(seed)
        frame = spark.createDataFrame([(n, d, t) for n, (d, t) in enumerate(docs)], "n int, doc_id bigint, text string")
        bench = spark.createDataFrame(items, "item_id bigint, text string")
        got = find_contamination(frame, bench, window=4, block_chars=chars).orderBy("n").collect()
        facts = [(r["n_words"], r["n_hit"], r["items"], r["longest_words"], r["contaminated"]) for r in got]
        assert facts == plain(docs, items, 4)
        for r, (_, text) in zip(got, docs, strict=True):
            if r["longest_words"]:
                at = words(text)[r["longest_at"] : r["longest_at"] + r["longest_words"]]
                assert any(str(name) == r["longest_item"] and " ".join(at) in " ".join(words(item)) for name, item in items)


def test_columns_and_empty_tables(spark, docs):
    bench = spark.createDataFrame([(1, "Text number 3 begins here. The same old line that everybody has.")], "item_id bigint, text string")
    out = find_contamination(docs, bench)
    assert "items" in out.columns and "_bits" not in out.columns and out.count() == docs.count()
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()} == {3}
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert find_contamination(docs.limit(0), bench).count() == 0
