"""Every operator and stage on documents whose columns are named like those that are added or used inside."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from shelfwise.llm.collocations import mine_phrases
from shelfwise.llm.decontaminate import decontaminate, find_contamination
from shelfwise.llm.line_dedup import dedup_lines
from shelfwise.llm.mixing import mix_sources
from shelfwise.llm.near_dedup import dedup_documents
from shelfwise.llm.own_columns import keeping
from shelfwise.llm.quality import score_quality
from shelfwise.llm.substring_dedup import dedup_substrings, mark_repeats

NAMES = (
    "n_lines n_dropped score predicted n_words n_hit items longest_words longest_at longest_item contaminated _bits _id _removed "
    "h row key spans removed digest start end first last side bytes block slot position part s n i phrase f conv place _own_score"
).split()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, an empty and a 20 MB text, repeated rows, and every clashing name."""
    long = "word " * 4_000_000 + "end."
    rows = [(i, f"Some text of number {i} that goes on with {i * i} words.", "en", f"s{i % 2}", 3) for i in range(8)]
    rows += [(20, None, None, None, None), (21, "", "en", "s0", 0), (22, long, "en", "s1", len(long)), (23, "Again.", "de", "s1", 6), (23, "Again.", "de", "s1", 6)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return frame.withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in NAMES})


def own(df):
    return sorted((tuple(r) for r in df.select("doc_id", *NAMES).collect()), key=repr)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([("a", "nothing of this kind is in any document here at all"), (None, None)], "item_id string, text string")


@pytest.mark.parametrize("name", ["decontaminate", "dedup_substrings", "dedup_documents", *[n for n, _ in corpus_pipeline.STAGES[:-1]]])
def test_own_columns_stay(spark, odd, benchmark, name, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    if name in stages:
        odd.select("doc_id", (F.col("doc_id") % 2).alias("quality"), F.lit(0).alias("toxic")).dropDuplicates(["doc_id"]).write.parquet(f"{tmp_path}/labels.parquet")
        benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
        work = lambda d: stages[name](spark, d, str(tmp_path))
    else:
        work = {"decontaminate": lambda d: decontaminate(d, benchmark), "dedup_substrings": dedup_substrings, "dedup_documents": dedup_documents}[name]
    out = work(odd)
    assert out.columns == odd.columns
    found, given = own(out), own(odd)
    assert set(found) <= set(given) and (name == "quality" or len(found) >= len(given) - 1)
    assert work(odd.limit(0)).count() == 0


def test_added_columns_take_the_place_of_their_namesakes(odd, benchmark):
    kept = [c for c in NAMES if c not in ("n_words", "n_hit", "items", "longest_words", "longest_at", "longest_item", "contaminated")]
    found = find_contamination(odd, benchmark)
    assert set(kept) <= set(found.columns) and found.where("_bits NOT LIKE '_bits of %'").isEmpty()
    assert found.where("contaminated").isEmpty() and found.count() == odd.count()
    for out in (dedup_lines(odd), mix_sources(odd), mark_repeats(odd), mine_phrases(odd)):
        assert len(set(out.columns)) == len(out.columns)
        out.limit(3).collect()


def test_names_that_are_taken_twice(spark):
    frame = spark.createDataFrame([(1, "a", "b")], "id int, score string, _own_score string")
    out = keeping(frame, ["score"], lambda d: d.withColumn("score", F.lit(5)), ["score"])
    assert tuple(out.first()) == (1, "a", "b", 5)
