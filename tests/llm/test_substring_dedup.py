from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from shelfwise.llm import substring_dedup
from shelfwise.llm.substring_dedup import chunks, dedup_substrings, mark_repeats, repeated_spans
from shelfwise.llm.words import buffer_of


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("etaoinshrdluéü") for _ in range(r.randint(2, 9))) for _ in range(n))


def test_chunks_make_up_texts_and_resist_shifts():
    text = prose(1, 2000)
    texts = ["", text, "x" + text, text[:700] + " inserted words " + text[700:], "short"]
    row, digest, start, length = chunks(*buffer_of(pa.array(texts)))
    for i, t in enumerate(texts):
        mine = row == i
        assert length[mine].sum() == len(t)
        assert (np.cumsum(length[mine])[:-1] == start[mine][1:]).all()
    sets = [set(digest[row == i].tolist()) for i in range(len(texts))]
    assert len(sets[1] - sets[2]) <= 3 and len(sets[1] - sets[3]) <= 6
    assert 20 < len(text.encode()) / (row == 1).sum() < 60


def test_against_plain_version(spark):
    """Planted passages of 51 words or more are found, and only what other documents hold."""
    passages = [prose(100 + i, 51 + 5 * i) for i in range(8)]
    rows = []
    for i in range(60):
        text = prose(i, 120)
        if i % 3 == 0:
            text = text[:300] + " " + passages[i % 8] + " " + text[300:]
        rows.append((i, text))
    rows += [(70, None), (71, ""), (None, passages[0]), (3, dict(rows)[3])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    spans = repeated_spans(frame).where("NOT removable").collect()
    assert {s["doc_id"] for s in spans} == {i for i in range(60) if i % 3 == 0}
    texts = dict(r for r in rows if r[0] is not None)
    for s in spans:
        piece = texts[s["doc_id"]][s["start"] : s["start"] + s["length"]]
        assert len(piece) >= 120 and passages[s["doc_id"] % 8].find(piece.strip()[:100]) >= 0
        assert s["first_doc"] == min(i for i in range(0, 60, 3) if i % 8 == s["doc_id"] % 8)


def test_removal_and_defined_cases(spark, docs):
    text = prose(7, 80)
    rows = [(1, "Start. " + text + " End."), (2, text), (3, prose(9, 80))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r["doc_id"]: r["text"] for r in dedup_substrings(frame).collect()}
    assert kept[1] == rows[0][1] and kept[3] == rows[2][1] and len(kept[2]) < len(text) / 3
    out = mark_repeats(docs)
    assert out.count() == docs.count() and dedup_substrings(docs).columns == docs.columns
    assert {r["doc_id"]: r["n_chars"] for r in out.collect()}[21] == 0
    assert mark_repeats(docs.limit(0)).count() == 0


def test_short_words_and_exact_ends(spark):
    """51 words of four letters at most are found, each from its first to its last code point."""
    r = random.Random(3)
    passages = [" ".join("".join(r.choice("etaoinshrdluéü") for _ in range(r.randint(2, 4))) for _ in range(51)) for _ in range(30)]
    rows = []
    for i in range(60):
        text = prose(1000 + i, 60)
        rows.append((i, f"{text[:150]} #{i} {passages[i % 30]} #{i} {text[150:]}"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    spans = repeated_spans(frame).where("NOT removable").collect()
    pieces = {s["doc_id"]: rows[s["doc_id"]][1][s["start"] : s["start"] + s["length"]].strip() for s in spans}
    assert len(spans) == 60 and pieces == {i: passages[i % 30] for i in range(60)}
    kept = {r["doc_id"]: r["text"] for r in dedup_substrings(frame).collect()}
    assert all((passages[i % 30] in kept[i]) == (i < 30) and len(kept[i]) < len(rows[i][1]) - 100 * (i >= 30) + 1 for i in kept)


def test_adding_documents_loses_no_passage(spark):
    """134 code points that two documents share, while two others share most of them."""
    for extra in (False, True):
        rows, passages = [], []
        for k in range(240):
            passage = prose(f"passage {k}", 30)[:134].strip()
            passages.append(passage)
            base = 10 * k
            rows += [(base + d, f"{prose(f'before {base + d}', 20)} {passage} {prose(f'behind {base + d}', 20)}") for d in (3, 5)]
            if extra:
                rows += [(base + d, f"{prose(f'before {base + d}', 20)} {passage[:110]} {prose(f'behind {base + d}', 20)}") for d in (1, 9)]
        texts = dict(rows)
        spans = repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).where("NOT removable").collect()
        found = {s["doc_id"]: texts[s["doc_id"]][s["start"] : s["start"] + s["length"]].strip() for s in spans}
        for k, passage in enumerate(passages):
            assert found[10 * k + 3] == found[10 * k + 5] == passage.strip()


def common(a: str, b: str, least: int):
    """Maximal common substrings of whole words: ``(begin in a, text)``."""
    out = []
    longest = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [0] * (len(b) + 1)
        for j, y in enumerate(b):
            if x == y:
                new[j + 1] = longest[j] + 1
                if new[j + 1] >= least and (i + 1 == len(a) or j + 1 == len(b) or a[i + 1] != b[j + 1]):
                    out.append((i + 1 - new[j + 1], a[i + 1 - new[j + 1] : i + 1]))
        longest = new
    return out


def test_against_all_common_substrings(spark, monkeypatch):
    """All that is long enough is found, and nothing is that no other document holds."""
    r = random.Random(17)
    pool = [prose(300 + i, 12) for i in range(14)]
    texts = {i: " ".join(r.choice(pool) if r.random() < 0.7 else prose(800 + 31 * i + k, 6) for k in range(7)) for i in range(16)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    pairs = {(i, j): common(texts[i], texts[j], 20) for i in texts for j in texts if i != j}

    def spans():
        found: dict = {}
        for s in repeated_spans(frame, min_run=60).collect():
            found.setdefault((s["doc_id"], s["removable"]), []).append((s["start"], s["start"] + s["length"]))
        return {k: sorted(v) for k, v in found.items()}

    found = spans()
    for i, text in texts.items():
        for removable in (False, True):
            held = [False] * len(text)
            others = [j for j in texts if j != i and (j < i or not removable)]
            for j in others:
                for at, piece in pairs[i, j]:
                    held[at : at + len(piece)] = [True] * len(piece)
                    if len(piece) >= 150:
                        inner = piece.strip()
                        inner = inner[inner.index(" ") : inner.rindex(" ")].strip()
                        begin = text.index(inner, at)
                        assert any(a <= begin and begin + len(inner) <= b for a, b in found.get((i, removable), [])), (i, j, piece)
            for a, b in found.get((i, removable), []):
                assert all(held[a:b])
    # blocks, pieces of long texts and a full filter change nothing
    monkeypatch.setattr(substring_dedup, "BLOCK_ROWS", 5)
    assert spans() == found
    monkeypatch.setattr(substring_dedup, "PIECE", 200)
    assert spans() == found
    again = repeated_spans(frame.union(frame).repartition(5), min_run=60, bits=6)
    monkeypatch.undo()
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, repeated_spans(frame, min_run=60).collect()))


def test_stacks_against_all_pairs():
    r = random.Random(5)
    for _ in range(200):
        rows = sorted((bytes(r.choice(b"ab") for _ in range(r.randrange(1, 7))), r.randrange(4)) for _ in range(r.randrange(1, 14)))
        stack = substring_dedup.Stack()
        for i, (text, doc) in enumerate(rows):
            stack.move("k", text)
            want = [0, 0]
            for other, their in rows[:i]:
                n = substring_dedup._agree(text, other)
                want = [max(want[0], n * (their != doc)), max(want[1], n * (their < doc))]
            assert list(stack.longest(doc)) == want
            stack.add(doc)


def test_long_texts_are_cut_alike_in_pieces(monkeypatch):
    batch = pa.record_batch([pa.array([prose(1, 300), prose(3, 4000) + "é" * 300 + prose(4, 500), None, prose(2, 300)])], ["text"])
    (whole,) = [found for _, _, found in substring_dedup._pieces(batch, 0)]
    monkeypatch.setattr(substring_dedup, "PIECE", 900)
    parts = [found for _, _, found in substring_dedup._pieces(batch, 0)]
    assert len(parts) > 9
    for name in ("row", "digest", "start", "end", "first", "last"):
        assert np.concatenate([getattr(p, name) for p in parts]).tolist() == getattr(whole, name).tolist()


def test_own_columns_ties_and_repeated_rows(spark):
    passage = prose(77, 60)
    rows = [(1, passage, "a", "b", 1, 2), (1, passage, "a", "b", 1, 2), (1, passage + " " + prose(5, 9), "c", "d", 3, 4), (None, passage, "n", "n", 0, 0), (2, None, "x", "y", 5, 6)]
    schema = "doc_id bigint, text string, _id string, _removed string, h int, row int"
    frame = spark.createDataFrame(rows, schema)
    # texts of one id are one document: nothing repeats across documents
    assert sorted(map(tuple, dedup_substrings(frame).collect()), key=repr) == sorted(rows, key=repr)
    more = spark.createDataFrame([*rows, (7, "So: " + passage, "k", "l", 7, 8)], schema)
    out = dedup_substrings(more)
    assert out.columns == frame.columns
    kept = {r["doc_id"]: r for r in out.where("doc_id = 7").collect()}[7]
    assert len(kept["text"]) < 20 and (kept["_id"], kept["_removed"], kept["h"], kept["row"]) == ("k", "l", 7, 8)
    marked = [r for r in mark_repeats(more).collect() if r["doc_id"] == 1]
    assert len(marked) == 3 and all(r["n_repeated"] >= len(passage) - 10 and r["n_removed"] == 0 for r in marked)
