"""Item features from nested attribute arrays."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.expressions import safe_name
from shelfwise.operators.hot import join_apart
from shelfwise.operators.numbering import number_rows

# Attributes that get one main value, and those that get a flag per value.
MAIN_ATTRIBUTES = ("Type", "Brand", "SexMaster", "Season", "StyleApparel", "AgeO")
FLAG_ATTRIBUTES = {"ColorBase": "color", "Material": "material"}

COUNTS = ("n_attributes", "n_aspects", "n_show_characteristics")
BROADCAST_SHARE = 1e-4
BROADCAST_VALUES = 1_000_000


def item_base(items: DataFrame) -> DataFrame:
    """Item id, embedding and the three product ids as text."""
    ids = [F.col(c).cast("string").alias(c) for c in ("catalogid", "variant_id", "model_id")]
    return items.select(F.col("item_id").cast("long").alias("item_id"), "fclip_embed", *ids)


def item_attributes(items: DataFrame) -> DataFrame:
    """One row per item and attribute; items without attributes and null entries give none."""
    unfolded = items.select(F.col("item_id").cast("long").alias("item_id"), F.posexplode("attributes").alias("pos", "a"))
    return unfolded.where(F.col("a").isNotNull()).select(
        "item_id",
        "pos",
        F.col("a.attribute_name").alias("attr_name"),
        F.col("a.attribute_value").alias("attr_value"),
        F.col("a.attribute_isaspect").alias("is_aspect"),
        F.col("a.attribute_showascharacteristic").alias("show_char"),
    )


def attribute_frequency(attributes: DataFrame, n_items: int, min_share: float = 0.01) -> DataFrame:
    """Attribute values carried by at least ``max(1, int(n_items * min_share))`` rows.

    The result is small by construction: at most (attributes per item) / ``min_share`` rows.
    """
    at_least = max(1, int(n_items * min_share))
    counted = attributes.groupBy("attr_name", "attr_value").agg(F.count("*").alias("freq"))
    return counted.where(F.col("freq") >= at_least)


def frequent_attributes(attributes: DataFrame, frequency: DataFrame, min_share: float | None = None) -> DataFrame:
    """Attribute rows whose (name, value) made the cut.

    From a ``min_share`` of 1/10,000 on, where few values can pass (see
    :func:`attribute_frequency`), they are counted, and if they are few they go to every
    task, so that a value that a large part of the items has is not shuffled together.
    """
    cut = frequency.select("attr_name", "attr_value")
    if min_share is not None and min_share >= BROADCAST_SHARE and cut.limit(BROADCAST_VALUES + 1).count() <= BROADCAST_VALUES:
        cut = F.broadcast(cut)
    return attributes.join(cut, ["attr_name", "attr_value"], "inner")


class FrequentValues(NamedTuple):
    """Sorted attribute values that made the cut, by attribute name."""

    by_name: dict[str, list[str]]

    @property
    def main_names(self) -> list[str]:
        return [n for n in MAIN_ATTRIBUTES if self.by_name.get(n)]

    def flag_columns(self, name: str) -> list[str]:
        """Flag column per value; values with the same safe name share one."""
        return sorted({f"{FLAG_ATTRIBUTES[name]}_{safe_name(v)}" for v in self.by_name.get(name, [])})


def frequent_values(frequency: DataFrame, limit: int | None = None) -> FrequentValues:
    """The value lists that decide which feature columns exist.

    With a ``limit`` more values than that are an error.
    """
    wanted = [*MAIN_ATTRIBUTES, *FLAG_ATTRIBUTES]
    passed = frequency.where(F.col("attr_name").isin(wanted) & F.col("attr_value").isNotNull()).select("attr_name", "attr_value")
    rows = (passed if limit is None else passed.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        raise ValueError(f"more than {limit} attribute values pass the frequency cut; raise it")
    by_name: dict[str, list[str]] = {}
    for name, value in sorted((r["attr_name"], r["attr_value"]) for r in rows):
        by_name.setdefault(name, []).append(value)
    return FrequentValues(by_name)


def _frequent(name: str, values: FrequentValues) -> Column:
    return (F.col("attr_name") == name) & F.col("attr_value").isin(values.by_name.get(name, []))


def _main(name: str, values: FrequentValues) -> Column:
    first = F.min(F.when(_frequent(name, values), F.struct("pos", "attr_value")))
    return first["attr_value"].alias(f"{name.lower()}_main")


def _flag_set(name: str, values: FrequentValues) -> Column:
    """Distinct frequent values of one attribute; never more than made the cut."""
    return F.collect_set(F.when(_frequent(name, values), F.col("attr_value")))


def _flags(name: str, values: FrequentValues) -> list[Column]:
    by_column: dict[str, list[str]] = {}
    for value in values.by_name.get(name, []):
        by_column.setdefault(f"{FLAG_ATTRIBUTES[name]}_{safe_name(value)}", []).append(value)
    return [
        F.coalesce(F.arrays_overlap(F.col(f"_{name}"), F.array(*map(F.lit, same))), F.lit(False)).alias(column)
        for column, same in sorted(by_column.items())
    ]


def main_values(attributes: DataFrame, values: FrequentValues) -> DataFrame:
    """First frequent value, in array order, of each single-valued attribute."""
    mains = [_main(n, values) for n in values.main_names]
    return attributes.groupBy("item_id").agg(*mains) if mains else attributes.select("item_id").distinct()


def flag_features(attributes: DataFrame, values: FrequentValues) -> DataFrame:
    """One boolean per frequent value of the multi-valued attributes."""
    names = [n for n in FLAG_ATTRIBUTES if values.by_name.get(n)]
    if not names:
        return attributes.select("item_id").distinct()
    sets = attributes.groupBy("item_id").agg(*[_flag_set(n, values).alias(f"_{n}") for n in names])
    return sets.select("item_id", *[flag for n in names for flag in _flags(n, values)])


def _counts() -> list[Column]:
    return [
        F.count("*").alias("n_attributes"),
        F.coalesce(F.sum(F.col("is_aspect").cast("int")), F.lit(0)).alias("n_aspects"),
        F.coalesce(F.sum(F.col("show_char").cast("int")), F.lit(0)).alias("n_show_characteristics"),
    ]


def attribute_counts(items: DataFrame, attributes: DataFrame) -> DataFrame:
    """Attributes, aspects and shown characteristics per item; 0 where there are none."""
    counted = attributes.groupBy("item_id").agg(*_counts())
    ids = items.select(F.col("item_id").cast("long").alias("item_id"))
    return ids.join(counted, "item_id", "left").na.fill(0, list(COUNTS))


def attribute_features(attributes: DataFrame, values: FrequentValues) -> DataFrame:
    """Main values, flags and counts of an item in one aggregation.

    An item's attributes sit in one input row, so the map side already reduces them to
    one row per item before the shuffle.
    """
    names = [n for n in FLAG_ATTRIBUTES if values.by_name.get(n)]
    grouped = attributes.groupBy("item_id").agg(
        *[_main(n, values) for n in values.main_names],
        *[_flag_set(n, values).alias(f"_{n}") for n in names],
        *_counts(),
    )
    mains = [f"{n.lower()}_main" for n in values.main_names]
    return grouped.select("item_id", *mains, *[f for n in names for f in _flags(n, values)], *COUNTS)


def item_features(
    items: DataFrame, min_share: float = 0.01, include_attributes: bool = True, values: FrequentValues | None = None
) -> DataFrame:
    """Base columns beside the attribute features of every item.

    Value frequencies are taken over the whole table, unless ``values`` is given.
    """
    base = item_base(items)
    if not include_attributes:
        return base
    attributes = item_attributes(items)
    if values is None:
        values = frequent_values(attribute_frequency(attributes, items.count(), min_share))
    features = base.join(attribute_features(attributes, values), "item_id", "left")
    flags = [c for n in FLAG_ATTRIBUTES for c in values.flag_columns(n)]
    return features.na.fill(0, list(COUNTS)).na.fill(False, flags) if flags else features.na.fill(0, list(COUNTS))


def attribute_dictionary(attributes: DataFrame, at_least: int = 1) -> DataFrame:
    """``value_id, attr_name, attr_value, freq``: the attribute values of at least so many rows, numbered in order.

    A table, however many values there are; nothing comes to the driver. Attributes without
    name or value are left out.
    """
    counted = attributes.where("attr_name IS NOT NULL AND attr_value IS NOT NULL").groupBy("attr_name", "attr_value").agg(F.count("*").alias("freq"))
    numbered = number_rows(counted.where(F.col("freq") >= at_least), ["attr_name", "attr_value"], output="value_id")
    return numbered.select("value_id", "attr_name", "attr_value", "freq")


def sparse_attributes(attributes: DataFrame, dictionary: DataFrame, parts: int = 1000) -> DataFrame:
    """``item_id, value_ids``: the sorted ids of an item's values, one array instead of a column per value.

    Values that more than 1 / ``parts`` of all rows have, by the counts of the dictionary, go
    to every task, so none of them is gathered; there are at most ``parts`` of them.
    """
    keys = ["attr_name", "attr_value"]
    total = dictionary.agg(F.coalesce(F.sum("freq"), F.lit(0))).scalar()
    hot = dictionary.where(F.col("freq") > total / parts).select(*keys)
    coded = join_apart(attributes.select("item_id", *keys), dictionary.select(*keys, "value_id"), keys, hot)
    return coded.groupBy("item_id").agg(F.array_sort(F.collect_set("value_id")).alias("value_ids"))


def main_value_ids(attributes: DataFrame, dictionary: DataFrame, names: Sequence[str] = MAIN_ATTRIBUTES, parts: int = 1000) -> DataFrame:
    """First value, in array order, of each single-valued attribute that the dictionary has.

    One column per attribute name; the values are joined, so the plan holds none of them.
    """
    keys = ["attr_name", "attr_value"]
    total = dictionary.agg(F.coalesce(F.sum("freq"), F.lit(0))).scalar()
    hot = dictionary.where(F.col("freq") > total / parts).select(*keys)
    wanted = attributes.where(F.col("attr_name").isin(*names)).select("item_id", "pos", *keys)
    known = join_apart(wanted, dictionary.select(*keys, "value_id"), keys, hot)
    mains = [F.min(F.when(F.col("attr_name") == n, F.struct("pos", "attr_value")))["attr_value"].alias(f"{n.lower()}_main") for n in names]
    return known.groupBy("item_id").agg(*mains)


def item_features_sparse(items: DataFrame, dictionary: DataFrame, names: Sequence[str] = MAIN_ATTRIBUTES) -> DataFrame:
    """Base columns, main values, counts and ``value_ids`` of every item, for any number of attribute values."""
    attributes = item_attributes(items)
    empty = F.array().cast("array<bigint>")
    features = (
        item_base(items)
        .join(main_value_ids(attributes, dictionary, names), "item_id", "left")
        .join(attributes.groupBy("item_id").agg(*_counts()), "item_id", "left")
        .join(sparse_attributes(attributes, dictionary), "item_id", "left")
    )
    return features.withColumn("value_ids", F.coalesce("value_ids", empty)).na.fill(0, list(COUNTS))
