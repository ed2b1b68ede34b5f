"""Document quality as Bradley-Terry strength.

A labelled good document beats a labelled bad one. The logistic loss on the difference of
their features gives a strength for every document; the quantile of strengths that parts
the labelled rows best is the threshold. Features are shares of characters and measures of
words and repetition, taken from whole texts.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.batches import bounded
from shelfwise.llm.words import SPACES, buffer_of, shingle_hashes, slabs, word_hashes
from shelfwise.workspace import discard, write_down

#: Labelled rows the ranker is fitted on: those of the smallest hashes of their id.
MAX_LABELLED = 20_000
#: Opponents drawn for a labelled document.
OPPONENTS = 4
#: Score at the threshold.
CUT = 0.3
_BOUND = 5.0


def _byte_groups() -> np.ndarray:
    """Feature number of each byte: letters, capitals, digits, blanks, line ends, control, beyond ASCII, each sign."""
    group = np.full(256, 6)
    group[:128] = 5
    group[97:123], group[65:91], group[48:58], group[32], group[10] = 0, 1, 2, 3, 4
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    group[signs] = 7 + np.arange(len(signs))
    return group


GROUPS = _byte_groups()
N_FEATURES = int(GROUPS.max()) + 1 + 8


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features a text; an empty text has zeros."""
    rows = len(offsets) - 1
    out = np.zeros((rows, N_FEATURES))
    n_groups = N_FEATURES - 8
    spread = np.zeros((256, n_groups))
    spread[np.arange(256), GROUPS] = 1
    for a, b in slabs(offsets):
        words, limits = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SPACES)
        n = np.diff(limits).astype(float)
        single = np.diff(shingle_hashes(words, limits, 1)[1])
        triple = np.diff(shingle_hashes(words, limits, 3)[1])
        for row in range(a, b):
            text = data[offsets[row] : offsets[row + 1]]
            if len(text):
                out[row, :n_groups] = np.bincount(text, minlength=256) @ spread
        size = np.diff(offsets[a : b + 1]).astype(float)
        some, count = np.maximum(size, 1), np.maximum(n, 1)
        counts = out[a:b, :n_groups].copy()
        letters = counts[:, 0] + counts[:, 1] + counts[:, 6]
        signs = counts[:, 7:].sum(1)
        out[a:b, :n_groups] = np.sqrt(counts / some[:, None])
        extra = out[a:b, n_groups:]
        extra[:, 0] = np.log1p(n)
        extra[:, 1] = (size - counts[:, 3] - counts[:, 4]) / count / 10
        extra[:, 2] = single / count
        extra[:, 3] = triple / np.maximum(n - 2, 1)
        extra[:, 4] = counts[:, 1] / np.maximum(letters, 1)
        extra[:, 5] = signs / count
        extra[:, 6] = np.log1p(size / (counts[:, 4] + 1))
        extra[:, 7] = np.log1p(n) * single / count
    return out


class Ranker(NamedTuple):
    """Strength = sum of ``weights`` over standardised features; ``cut`` is the threshold."""

    weights: list[float]
    mean: list[float]
    scale: list[float]
    cut: float
    quantile: float


def _with_features(at: int, names: list[str]):
    def add(batches):
        for batch in batches:
            table = features(*buffer_of(batch.column(at)))
            flat = pa.array(table.ravel(), pa.float64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1) * table.shape[1], pa.int32()), flat)
            columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | {"features": lists}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return add


def _pairs(rows: DataFrame, good: str) -> DataFrame:
    """Feature differences, winner minus loser, with the label that tells the sign."""
    losers_n = rows.where(~F.col(good)).count()
    winners_n = rows.where(F.col(good)).count()
    draws = OPPONENTS * max(1, math.ceil(losers_n / max(winners_n, 1)))
    at = Window.orderBy("_h", "doc_id")  # a bounded sample
    numbered = lambda side: rows.where(side).select("_x", (F.row_number().over(at) - 1).alias("_i"))
    winners = numbered(F.col(good)).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    winners = winners.withColumn("_j", F.pmod(F.col("_i") * draws + F.col("_k"), F.lit(max(losers_n, 1))))
    losers = numbered(~F.col(good)).select(F.col("_x").alias("_y"), F.col("_i").alias("_j"))
    sign = F.when(F.pmod(F.col("_i") + F.col("_k"), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    gap = F.zip_with("_x", "_y", lambda x, y: (x - y) * F.col("_sign"))
    return (
        winners.join(losers, "_j")
        .withColumn("_sign", sign)
        .select(array_to_vector(gap).alias("features"), (F.col("_sign") > 0).cast("double").alias("label"))
    )


def fit_ranker(
    docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", max_labelled: int = MAX_LABELLED
) -> Ranker:
    """Fit on the documents of at most ``max_labelled`` rows of ``labels`` (``doc_id`` and a 0/1 column).

    Rows without an id, or with another label, take no part. Without labels of both kinds
    every weight is 0 and no document falls below the threshold.
    """
    sample = (
        labels.select("doc_id", F.col(label).alias("_label"))
        .where(F.col("_label").isin(0, 1) & F.col("doc_id").isNotNull())
        .dropDuplicates()
        .withColumn("_h", F.xxhash64("doc_id", "_label"))
        .orderBy("_h", "doc_id")
        .limit(max_labelled)
    )
    texts = bounded(docs).select("doc_id", F.col(text).alias("_text")).join(F.broadcast(sample), "doc_id")
    schema = T.StructType([f for f in texts.schema.fields if f.name != "_text"] + [T.StructField("features", T.ArrayType(T.DoubleType()))])
    written = write_down(texts.mapInArrow(_with_features(texts.columns.index("_text"), schema.names), schema), "labelled")
    stats = written.table.agg(
        F.count("*").alias("n"), F.avg(F.col("_label")).alias("share"),
        *[F.avg(F.col("features")[i]).alias(f"m{i}") for i in range(N_FEATURES)],
        *[F.stddev_pop(F.col("features")[i]).alias(f"s{i}") for i in range(N_FEATURES)],
    ).first()
    if not stats["n"] or stats["share"] in (0.0, 1.0):
        discard(docs.sparkSession, written.path)
        return Ranker([0.0] * N_FEATURES, [0.0] * N_FEATURES, [1.0] * N_FEATURES, 0.0, 0.0)
    mean = [round(stats[f"m{i}"], 9) for i in range(N_FEATURES)]
    scale = [round(stats[f"s{i}"], 9) if stats[f"s{i}"] > 1e-6 else 1.0 for i in range(N_FEATURES)]
    parts = [
        F.greatest(F.lit(-_BOUND), F.least(F.lit(_BOUND), (F.col("features")[i] - F.lit(mean[i])) / F.lit(scale[i])))
        for i in range(N_FEATURES)
    ]
    rows = written.table.select("doc_id", "_h", (F.col("_label") == 1).alias("good"), F.array(*parts).alias("_x")).repartition(8).persist()
    model = LogisticRegression(fitIntercept=False, standardization=False, regParam=1e-3, maxIter=60).fit(_pairs(rows, "good"))
    weights = [round(float(x), 9) for x in model.coefficients.toArray()]
    found = rows.select("good", sum((F.col("_x")[i] * F.lit(w) for i, w in enumerate(weights)), F.lit(0.0)).alias("s")).collect()
    rows.unpersist()
    discard(docs.sparkSession, written.path)
    cut, quantile = best_quantile([r["s"] for r in found], [r["good"] for r in found])
    return Ranker(weights, mean, scale, cut, quantile)


def best_quantile(strengths: list[float], good: list[bool]) -> tuple[float, float]:
    """The strength, and its quantile, that parts good from bad with the fewest errors.

    Among equally good places the middle of the widest gap.
    """
    order = np.argsort(strengths, kind="stable")
    s, g = np.asarray(strengths)[order], np.asarray(good)[order]
    merit = np.concatenate([[0], np.cumsum(~g)]) + g.sum() - np.concatenate([[0], np.cumsum(g)])
    gap = np.concatenate([[0], np.diff(s), [0]])
    merit[1:-1][gap[1:-1] <= 0] = -1
    best = np.flatnonzero(merit == merit.max())
    k = int(best[np.argmax(gap[best])])
    if k in (0, len(s)):
        return float(s[0] - 1 if k == 0 else s[-1] + 1), k / len(s)
    return float((s[k - 1] + s[k]) / 2), k / len(s)


def _scorer(ranker: Ranker, at: int, names: list[str]):
    weights, mean, scale = (np.array(x) for x in ranker[:3])
    shift = math.log(CUT / (1 - CUT))

    def score(batches):
        for batch in batches:
            x = np.clip((features(*buffer_of(batch.column(at))) - mean) / scale, -_BOUND, _BOUND)
            strength = (x * weights).sum(1) - ranker.cut
            value = 1 / (1 + np.exp(-np.clip(strength + shift, -500, 500)))
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns |= {"score": pa.array(value), "predicted": pa.array((value >= CUT).astype(np.int32))}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return score


def score_quality(docs: DataFrame, ranker: Ranker, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1; 0.3 at the threshold) and ``predicted`` (1 from there on).

    They take the place of columns of these names. Only the text counts, so repeated rows
    score alike; a null text scores as an empty one.
    """
    docs = bounded(docs).drop("score", "predicted")
    schema = T.StructType(list(docs.schema.fields)).add("score", "double").add("predicted", "integer")
    return docs.mapInArrow(_scorer(ranker, docs.columns.index(text), schema.names), schema)


def held_out(doc_id: str = "doc_id", fold: int = 0):
    """Rows kept from learning: crc32 of the id as text, modulo 5, equals ``fold``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == fold, F.lit(False))
