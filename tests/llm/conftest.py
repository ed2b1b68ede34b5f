from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def docs(spark):
    """Plain texts, copies, blank and missing ones, a long one, a repeated row, and columns with clashing names."""
    line = "The same old line that everybody has."
    rows = [(i, f"Text number {i} begins here.\n{line}\nAnd ends with words {i * 7} and {i * 13}.", "en", f"s{i % 3}", 0) for i in range(12)]
    rows += [
        (20, "", "en", "s0", 0),
        (21, None, None, None, 0),
        (22, "  \n\t", "en", "s1", 0),
        (23, " ".join(f"w{j}" for j in range(30000)), "en", "s0", 0),
        (24, "word " * 5, "en", "s0", 0),
        (24, "word " * 5, "en", "s0", 0),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = {c: "7" for c in ("n_lines", "score", "items", "block", "n", "key", "id", "component_id", "shard", "training", "s", "part")}
    from pyspark.sql import functions as F

    return frame.withColumns({k: F.lit(v) for k, v in extra.items()})
