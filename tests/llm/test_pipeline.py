from __future__ import annotations

import inspect

import corpus_pipeline
from pyspark.sql import functions as F
from test_decontaminate import words as benchmark_words
from test_line_dedup import plain as plain_lines
from test_near_dedup import plain as plain_groups

import __spark_entry__
from shelfwise.llm import oracles, queries
from shelfwise.llm.mixing import phases

SF = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}
    assert "pipeline" in names and set(oracles.ORACLES) <= set(queries.QUERIES)


def test_stages_hold_together(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        out = stage(spark, docs, SF)
        ids = [r["doc_id"] for r in out.select("doc_id").collect()]
        assert set(ids) <= seen and len(ids) == len(set(ids))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            docs = spark.createDataFrame(out.toArrow())
        seen = set(ids)
    places = out.select("position", F.length("text").alias("n"), "n_chars").collect()
    assert len({r["position"] for r in places}) == len(seen) and all(r["n"] == r["n_chars"] for r in places)


def windows(words, size):
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def test_against_plain_stages(spark):
    """Every stage after the learnt one, against a version without Spark."""
    stages = dict(corpus_pipeline.STAGES)
    docs = stages["quality"](spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r[0] for r in rows}
    assert all(i in ids for i, q in labels.items() if q == 1) and not any(i in ids for i, q in labels.items() if q == 0)

    lines = plain_lines([(i, t) for i, t, _ in rows], 10)
    groups = plain_groups(list(lines.items()), 5, 80)
    kept = [i for i in lines if groups[i][1] == i]
    known = set()
    for item in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        known |= windows(benchmark_words(item["text"]), 10)
    clean = [i for i in kept if not windows(benchmark_words(lines[i]), 10) & known]

    got = corpus_pipeline.run(spark, SF).select("doc_id", "text", "source", "block", "slot", "position").collect()
    assert {r["doc_id"]: r["text"] for r in got} == {i: lines[i] for i in clean}
    sources = dict((i, s) for i, _, s in rows)
    counts = {}
    for i in clean:
        counts[sources[i]] = counts.get(sources[i], 0) + 1
    plan = phases({f"s:{s}": -(-n // 16) for s, n in counts.items()}, {f"s:{s}": n**0.5 for s, n in counts.items()}, 1000)
    slots = {}
    for p in plan:
        for s, places in p.slots.items():
            for block in range(p.first[s], p.last[s]):
                k = block - p.first[s]
                slots[s, block] = p.start + k // len(places) * p.period + places[k % len(places)]
    assert all(slots[f"s:{r['source']}", r["block"]] == r["slot"] for r in got)
