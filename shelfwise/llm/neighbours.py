"""Nearest neighbours by inner product over a hierarchical k-means tree.

Vectors get one more component that makes their lengths equal, so the largest inner
product is the smallest distance. The tree is grown on a bounded sample; every row is then
dealt to a leaf. A query visits leaves in best-bin-first order. How many is calibrated: for
some queries the true neighbours are found by brute force, and visits are widened until
they hold the target share of them. Leaves and queries meet in groups of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.kmeans_tree import Tree, best_bin_first, grow, leaf_numbers
from shelfwise.workspace import discard, write_down

#: Rows the tree is grown on, and queries that calibrate it: those of the smallest hashes of their id.
SAMPLE_ROWS, CALIBRATION = 20_000, 200
#: Rows of a leaf, about, while the sample allows it.
LEAF_ROWS = 256
#: Rows and queries that meet in one group, at most about. Neighbouring leaves share a group.
GROUP_ROWS, GROUP_QUERIES = 8192, 1024


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _top(queries: np.ndarray, query_ids: list, rows: np.ndarray, ids: np.ndarray, k: int, open_to=None):
    """Each query's ``k`` rows of the largest inner products, ties to the smaller id; its own id is left out.

    ``open_to`` (queries x rows) tells the rows that a query may find.

    The matrix product only selects; scores are summed alike for every row, so that equal
    vectors have equal scores.
    """
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    if open_to is not None:
        open_to = open_to[:, order]
    found: tuple[list, list, list] = ([], [], [])
    for a in range(0, len(queries), 128):
        product = queries[a : a + 128] @ rows.T
        for i, q in enumerate(query_ids[a : a + 128]):
            some = np.flatnonzero(ids != q) if open_to is None else np.flatnonzero(open_to[a + i] & (ids != q))
            line = product[i][some]
            if len(line) > k:
                limit = np.partition(line, len(line) - k)[len(line) - k]
                some = some[line >= limit - 1e-9 * max(1.0, float(np.abs(line).max()))]
            score = (rows[some] * queries[a + i]).sum(1)
            best = np.argsort(-score, kind="stable")[:k]
            found[0].extend([q] * len(best))
            found[1].extend(ids[some[best]].tolist())
            found[2].extend(score[best].tolist())
    return found


def _as_table(found, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(found[0], kind), pa.array(found[1], kind), pa.array(found[2], pa.float64())], ["query_id", "vec_id", "score"]
    )


def _brute(queries: np.ndarray, query_ids: list, k: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                ids = batch.column(0)
                yield _as_table(_top(queries, query_ids, _matrix(batch.column(1)), ids.to_numpy(), k), ids.type)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v`` (doubles) without null ids and vectors that are null, zero or hold null or non-finite components."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))


def _dealer(tree, longest: float):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(1))
                leaf = leaf_numbers(tree.value, _levelled(rows, longest))
                yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), *batch.columns], ["leaf", "vec_id", "v"])

    return run


def _levelled(rows: np.ndarray, longest: float) -> np.ndarray:
    return np.concatenate([rows, np.sqrt(np.maximum(longest**2 - (rows**2).sum(1), 0))[:, None]], 1)


def leaves_to_visit(tree: Tree, query: np.ndarray, sizes: dict[int, int], visits: int, least: int) -> list[int]:
    """The first ``visits`` leaves, and more until they hold ``least`` rows."""
    out, held = [], 0
    for leaf in best_bin_first(tree, np.append(query, 0.0)):
        if len(out) >= visits and held >= least:
            break
        out.append(leaf)
        held += sizes.get(leaf, 0)
    return out


def _visitor(tree, sizes: dict[int, int], groups: dict[int, int], visits: int, least: int):
    """Queries with one row per group of leaves, and the leaves they visit there."""

    def run(batches):
        for batch in batches:
            rows, bins, lists = [], [], []
            for i, q in enumerate(_matrix(batch.column(1))):
                mine: dict[int, list[int]] = {}
                for leaf in leaves_to_visit(tree.value, q, sizes, visits, least):
                    if leaf in groups:
                        mine.setdefault(groups[leaf], []).append(leaf)
                rows += [i] * len(mine)
                bins += mine.keys()
                lists += mine.values()
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int32()), *taken.columns, pa.array(lists, pa.list_(pa.int32()))], ["bin", "vec_id", "v", "leaves"])

    return run


def grouped_leaves(sizes: dict[int, int], rows: int = GROUP_ROWS) -> dict[int, int]:
    """Group of each leaf that holds rows: leaves that follow one another, at most ``rows`` or one leaf."""
    out, group, held = {}, 0, 0
    for leaf in sorted(sizes):
        if held and held + sizes[leaf] > rows:
            group, held = group + 1, 0
        out[leaf] = group
        held += sizes[leaf]
    return out


def calibrated_visits(tree: Tree, queries: np.ndarray, truth: list[list[int]], recall: float) -> int:
    """The fewest leaf visits that reach the share ``recall`` of the true neighbours' leaves."""
    needed = []
    for query, leaves in zip(queries, truth, strict=True):
        place = {leaf: i + 1 for i, leaf in enumerate(best_bin_first(tree, np.append(query, 0.0)))}
        needed += [place[leaf] for leaf in leaves]
    return int(np.sort(needed)[max(0, int(np.ceil(recall * len(needed))) - 1)]) if needed else 1


def _meet(k: int):
    def run(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy(zero_copy_only=False)
        mine, others = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        kind = table.schema.field("vec_id").type
        found = ([], [], [])
        if len(mine) and len(others):
            leaf = np.array([x[0] for x in others["leaves"].to_pylist()])
            known, place = np.unique(leaf, return_inverse=True)
            visited = np.zeros((len(mine), len(known)), bool)
            for i, leaves in enumerate(mine["leaves"].to_pylist()):
                visited[i] = np.isin(known, leaves)
            found = _top(_matrix(mine["v"]), mine["vec_id"].to_pylist(), _matrix(others["v"]), others["vec_id"].to_numpy(), k, visited[:, place])
        return pa.Table.from_batches([_as_table(found, kind)])

    return run


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
    recall: float = 0.97, sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``vectors`` found nearest to each of ``queries``.

    Nearness is the inner product in double precision, ties go to the smaller id. Rows
    with the query's own id are left out. Ids are integers. Null ids, and vectors that are
    null, zero, hold null or non-finite components, or have another length than the most
    frequent one, take no part, as queries neither. Queries that repeat an id count once;
    repeated rows of ``vectors`` may all be found. All rows are returned where there are
    fewer than ``k``; empty tables give no rows.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[vec_id]
    rows = usable(vectors, vec_id, vector)
    shapes = rows.groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("longest")
    )
    shape = shapes.orderBy(F.col("n").desc(), "d").first()
    if shape is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    longest = float(np.sqrt(shape["longest"])) * (1 + 1e-12)
    rows = rows.where(F.size("v") == shape["d"])
    asked = usable(queries, vec_id, vector).where(F.size("v") == shape["d"]).dropDuplicates(["vec_id"])
    by_hash = lambda df, n: df.withColumn("h", F.xxhash64("vec_id")).orderBy("h", "vec_id").limit(n).select("vec_id", "v").toArrow()
    sample = by_hash(rows, sample_rows)
    leaf_size = max(4, round(leaf_rows * len(sample) / shape["n"]))
    tree = grow(_levelled(_matrix(sample["v"]), longest), leaf_size)
    shared = spark.sparkContext.broadcast(tree)
    dealt = write_down(rows.mapInArrow(_dealer(shared, longest), f"leaf int, vec_id {kind}, v array<double>"), "leaves")
    sizes = {r["leaf"]: r["n"] for r in dealt.table.groupBy("leaf").agg(F.count("*").alias("n")).collect()}

    trial = by_hash(asked, CALIBRATION)
    trial_ids, trial_vectors = trial["vec_id"].to_pylist(), _matrix(trial["v"])
    found = rows.mapInArrow(_brute(trial_vectors, trial_ids, k), f"query_id {kind}, vec_id {kind}, score double")
    truth = _best(found, k).select("query_id", "vec_id").distinct()
    at: dict = {q: [] for q in trial_ids}
    for r in dealt.table.select("vec_id", "leaf").join(F.broadcast(truth), "vec_id").collect():
        at[r["query_id"]].append(r["leaf"])
    visits = calibrated_visits(tree, trial_vectors, [at[q] for q in trial_ids], recall)

    groups = grouped_leaves(sizes)
    visiting = write_down(
        asked.mapInArrow(
            _visitor(shared, sizes, groups, visits, k + 1), f"bin int, vec_id {kind}, v array<double>, leaves array<int>"
        ),
        "visits",
    )
    calls = {r["bin"]: r["n"] for r in visiting.table.groupBy("bin").agg(F.count("*").alias("n")).collect()}
    held: dict[int, int] = {}
    for leaf, group in groups.items():
        held[group] = held.get(group, 0) + sizes[leaf]
    # At most as many entries as the tree has leaves, which the sample bounds.
    bins = spark.createDataFrame(list(groups.items()) or [(0, 0)], "leaf int, bin int")
    cuts = spark.createDataFrame(
        [(g, -(-held[g] // GROUP_ROWS), -(-n // GROUP_QUERIES)) for g, n in calls.items()] or [(0, 1, 0)], "bin int, row_cuts int, query_cuts int"
    ).where("query_cuts > 0")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    piece = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    members = (
        dealt.table.join(F.broadcast(bins), "leaf").join(F.broadcast(cuts), "bin")
        .select("bin", piece("row_cuts").alias("p"), spread("query_cuts").alias("q"), F.lit(False).alias("asks"), "vec_id", "v", F.array("leaf").alias("leaves"))
    )
    callers = (
        visiting.table.join(F.broadcast(cuts), "bin")
        .select("bin", spread("row_cuts").alias("p"), piece("query_cuts").alias("q"), F.lit(True).alias("asks"), "vec_id", "v", "leaves")
    )
    met = members.union(callers).groupBy("bin", "p", "q").applyInArrow(_meet(k), f"query_id {kind}, vec_id {kind}, score double")
    out = write_down(_best(met, k).select("query_id", "rank", "vec_id", "score"), "neighbours")
    discard(spark, dealt.path)
    discard(spark, visiting.path)
    return out.table
