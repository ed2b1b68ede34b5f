from helpers import as_set

from shelfwise.operators import items as ops
from shelfwise.operators.users import user_features

SCHEMA = (
    "item_id int, catalogid int, variant_id bigint, model_id int, itemname string, fclip_embed array<float>, attributes "
    "array<struct<attribute_name string, attribute_value string, attribute_isaspect boolean, "
    "attribute_showascharacteristic boolean>>"
)


def attr(name, value, aspect=False, shown=True):
    return (name, value, aspect, shown)


def table(spark):
    rows = [
        (1, 5, 6, 7, "a", [0.5], [attr("Brand", "B"), attr("Brand", "A"), attr("ColorBase", "Dark Blue", True, None)]),
        (2, 5, 6, 7, "b", None, [attr("Brand", "A"), attr("ColorBase", "dark-blue", None, False), attr("Other", "z")]),
        (3, 5, 6, 7, "c", None, []),
        (4, 5, 6, 7, "d", None, None),
        (5, 5, 6, 7, "e", None, [None, attr("Brand", "A"), attr("Material", "Wool")]),
        (6, 5, 6, 7, "f", None, [attr(None, None), attr("Brand", "Rare")]),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_base_and_long_form(spark):
    base = ops.item_base(table(spark))
    assert base.dtypes[:2] == [("item_id", "bigint"), ("fclip_embed", "array<float>")]
    assert base.where("item_id = 1").first()["catalogid"] == "5"
    long = ops.item_attributes(table(spark))
    assert long.count() == 10
    assert as_set(long.select("item_id").distinct()) == {(1,), (2,), (5,), (6,)}


def test_frequency_cut(spark):
    long = ops.item_attributes(table(spark))
    assert as_set(ops.attribute_frequency(long, 6, 0.5)) == {("Brand", "A", 3)}
    assert ops.attribute_frequency(long, 6, 0.01).count() == 8
    for share in (None, 0.5):
        frequent = ops.frequent_attributes(long, ops.attribute_frequency(long, 6, 0.5), share)
        assert as_set(frequent, "item_id", "pos") == {(1, 1), (2, 0), (5, 1)}


def test_features(spark):
    rows = {r["item_id"]: r for r in ops.item_features(table(spark), 0.01).collect()}
    assert len(rows) == 6
    # First value in array order; both spellings of the colour share a flag.
    assert rows[1]["brand_main"] == "B" and rows[2]["brand_main"] == "A" and rows[3]["brand_main"] is None
    assert [rows[i]["color_dark_blue"] for i in range(1, 7)] == [True, True, False, False, False, False]
    assert [rows[i]["material_wool"] for i in range(1, 7)] == [False, False, False, False, True, False]
    assert [rows[i]["n_attributes"] for i in range(1, 7)] == [3, 3, 0, 0, 2, 2]
    assert [rows[i]["n_aspects"] for i in range(1, 7)] == [1, 0, 0, 0, 0, 0]
    assert [rows[i]["n_show_characteristics"] for i in range(1, 7)] == [2, 2, 0, 0, 2, 2]


def test_cut_skips_to_the_first_frequent_value(spark):
    features = ops.item_features(table(spark), 0.5)
    assert as_set(features, "item_id", "brand_main") == {
        (1, "A"), (2, "A"), (3, None), (4, None), (5, "A"), (6, None)
    }
    assert not [c for c in features.columns if c.startswith(("color_", "material_"))]


def test_parts_agree_with_the_whole(spark):
    things = table(spark)
    long = ops.item_attributes(things)
    values = ops.frequent_values(ops.attribute_frequency(long, 6, 0.01))
    whole = ops.item_features(things, 0.01)
    mains = ops.main_values(long, values)
    flags = ops.flag_features(long, values)
    counts = ops.attribute_counts(things, long)
    assert as_set(mains) <= as_set(whole, *mains.columns)
    assert as_set(flags) <= as_set(whole, *flags.columns)
    assert as_set(counts) == as_set(whole, *counts.columns)


def test_without_attributes(spark):
    assert ops.item_features(table(spark), include_attributes=False).columns == ops.item_base(table(spark)).columns


def test_users_of_all_splits(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "user_id int")
    b = spark.createDataFrame([(2,), (-3,)], "user_id int")
    assert as_set(user_features(a, b)) == {(1,), (2,), (-3,)}
