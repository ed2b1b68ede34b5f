import pytest
from helpers import as_set
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.models import bpr, fit_model
from shelfwise.models.factors import load_model
from shelfwise.operators.idmaps import id_map, index_interactions


@pytest.fixture(scope="module")
def data(spark):
    """Two tastes: low users like low items, high users high ones; one item is never rated."""
    rows = [(u, i, 1.0 + (u + i) % 3) for u in range(24) for i in range(16) if (u < 12) == (i < 8) and (u * 7 + i * 3) % 4]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating float").cache()
    seen = ratings.select("user_id", "item_id").unionByName(spark.createDataFrame([(5, 77)], "user_id bigint, item_id bigint"))
    return ratings, id_map("user_id", seen), id_map("item_id", seen)


PARAMS = {
    "als": {"factors": 4, "iterations": 6},
    "bpr": {"factors": 4, "iterations": 12, "learning_rate": 0.2, "regularization": 0.002},
}


@pytest.fixture(scope="module", params=sorted(PARAMS))
def model(request, data):
    return fit_model(request.param, *data, **PARAMS[request.param])


def test_lists_are_complete_and_ordered(spark, model):
    users = spark.createDataFrame([(u,) for u in (0, 5, 20, 1000)], "user_id int")
    recs = model.recommend(users, 10)
    sizes = recs.groupBy("user_id").agg(F.count("*"), F.count_distinct("item_id"), F.min("rank"), F.max("rank"))
    assert as_set(sizes) == {(u, 10, 10, 1, 10) for u in (0, 5, 20, 1000)}
    order = Window.partitionBy("user_id").orderBy("rank")
    rising = recs.withColumn("_d", F.col("score") - F.lag("score").over(order)).where("_d > 0")
    assert rising.isEmpty()
    everything = model.recommend(users, 100).where("user_id = 0")
    assert everything.count() == 17


def test_tastes_are_learnt(spark, model):
    users = spark.createDataFrame([(u,) for u in range(24)], "user_id bigint")
    top = model.recommend(users, 4)
    right = top.where("(user_id < 12) = (item_id < 8)").count() / top.count()
    assert right > 0.9


def test_saved_model_says_the_same(spark, model, tmp_path):
    users = spark.createDataFrame([(3,), (15,), (-1,)], "user_id bigint")
    before = as_set(model.recommend(users, 5), "user_id", "rank", "item_id")
    path = model.save(str(tmp_path))
    for place in (path, str(tmp_path)):
        again = load_model(spark, place)
        assert again.name == model.name
        assert as_set(again.recommend(users, 5), "user_id", "rank", "item_id") == before
    popular = as_set(again.recommend(users, 5).where("user_id = -1"), "rank", "score")
    assert all(score > 0 for _, score in popular)
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "nowhere"))


def test_unknown_model(data):
    with pytest.raises(ValueError):
        fit_model("guess", *data)


def positives(data):
    ratings, users, items = data
    return index_interactions(ratings, users, items).select("user_idx", "item_idx").cache()


def test_negatives_are_no_positives(data):
    pairs = positives(data)
    triples = bpr.bpr_triples(pairs, 17, draw=3)
    liked = as_set(pairs)
    drawn = as_set(triples, "user_idx", "item_idx", "neg_idx")
    assert drawn and not {(u, n) for u, _, n in drawn} & liked
    assert {(u, i) for u, i, _ in drawn} <= liked
    assert all(0 <= n < 17 for _, _, n in drawn)
    assert as_set(bpr.bpr_triples(pairs.repartition(5), 17, draw=3), "user_idx", "item_idx", "neg_idx") == drawn
    assert as_set(bpr.bpr_triples(pairs, 17, draw=4), "user_idx", "item_idx", "neg_idx") != drawn


@pytest.mark.parametrize("block_rows", [200_000, 3])
def test_loss_falls(data, block_rows):
    """Also with blocks so small that every user is spread over several."""
    _, users, items = data
    pairs = positives(data)
    held_out = bpr.bpr_triples(pairs, 17, draw=99).cache()
    losses = []
    for epochs in (0, 8):
        vectors = bpr.train_vectors(pairs, users, items, 4, 0.2, 0.002, epochs, block_rows=block_rows).table
        assert vectors.count() == 24 + 17 and vectors.where("size(vector) != 5").isEmpty()
        losses.append(bpr.pairwise_loss(vectors, held_out).first()["loss"])
    assert losses[0] == pytest.approx(0.693, abs=0.01)
    # Averaging over many tiny blocks learns more slowly.
    assert losses[1] < (0.85 if block_rows > 3 else 0.97) * losses[0]


def test_spread_keeps_every_positive(data):
    pairs = positives(data)
    placed = bpr._with_blocks(pairs, pairs.count(), 3)
    assert as_set(placed, "user_idx", "item_idx") == as_set(pairs)
    assert placed.groupBy("user_idx").agg(F.count_distinct("block").alias("n")).agg(F.max("n")).first()[0] > 1


def test_same_seed_same_vectors(data):
    _, users, items = data
    runs = [
        {(r["side"], r["idx"]): r["vector"] for r in bpr.train_vectors(p, users, items, 3, 0.1, 0.01, 2).table.collect()}
        for p in (positives(data), positives(data).repartition(7))
    ]
    assert runs[0].keys() == runs[1].keys()
    for key in runs[0]:
        assert runs[0][key] == pytest.approx(runs[1][key], abs=1e-5)
