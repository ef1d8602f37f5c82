"""Encoders of categorical features: smoothed per-class target shares, ordinals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.operators.split import FOLDS
from pagetrail.session import materialize

FULL = -1
MOST_CLASSES = 256
# Rows of a part, as monotonically_increasing_id numbers them.
_PART_BITS = 33


def classes_of(train: DataFrame, label: str) -> list[str]:
    """The classes in order; each becomes a column per encoded feature, so a label with more than ``MOST_CLASSES`` is an error."""
    found = train.select(label).distinct().orderBy(label).limit(MOST_CLASSES + 1).collect()
    if len(found) > MOST_CLASSES:
        raise ValueError(f"{label} has more than {MOST_CLASSES} classes")
    return [row[0] for row in found]


def _class_counts(train: DataFrame, keys: list[str], label: str, classes: list[str]) -> DataFrame:
    """Rows per key and class as columns n0..nk; counted before the shuffle, so hot keys are small."""
    columns = [F.count_if(F.col(label) == name).alias(f"n{i}") for i, name in enumerate(classes)]
    return train.groupBy(*keys).agg(*columns)


def _shares(count: Column, rows: Column, prior: Column) -> Column:
    """Share of a class in a category, drawn towards the class prior by the empirical-Bayes weight.

    With v = prior (1 - prior) and w = share (1 - share) the weight of the share is v n / (v n + w).
    """
    share = F.when(rows > 0, count / rows)
    overall = prior * (1 - prior) * rows
    bottom = overall + share * (1 - share)
    weight = F.when(bottom > 0, overall / bottom)
    return F.coalesce(weight * share + (1 - weight) * prior, prior)


def target_encode(
    folded: DataFrame, feature: str, label: str, classes: list[str], folds: int = FOLDS
) -> DataFrame:
    """(category, fold, te0..tek) learned from train rows with a ``fold`` column.

    Row ``fold = f`` is what train rows of fold f use: it is learned from the other folds. Row ``fold = -1`` is
    learned from all train rows and serves unseen rows. The category NULL carries the class priors themselves.
    """
    each = range(len(classes))

    def add_up(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in each])

    def outside(rows: DataFrame, *keys: str) -> DataFrame:
        """Counts outside each fold, out of one row per fold and key."""
        whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        counts = [(F.sum(f"n{i}").over(whole) - F.col(f"n{i}")).alias(f"n{i}") for i in each]
        return rows.select(*keys, "fold", *counts)

    per_fold = _class_counts(
        folded.withColumn("category", F.col(feature)), ["category", "fold"], label, classes
    ).filter("category IS NOT NULL")
    # one row per category and fold, read several times below
    per_fold = materialize(per_fold, "class-counts")
    per_category = add_up(per_fold, ["category"])
    seen = outside(per_fold, "category").unionByName(per_category.withColumn("fold", F.lit(FULL)))

    # class totals: one row per fold
    fold_totals = add_up(per_fold, ["fold"])
    priors = outside(fold_totals).unionByName(add_up(per_fold, []).withColumn("fold", F.lit(FULL)))
    whole = sum((F.col(f"n{i}") for i in each), F.lit(0))
    shares = [F.coalesce(F.try_divide(F.col(f"n{i}"), whole), F.lit(0.0)).alias(f"p{i}") for i in each]
    priors = priors.select("fold", *shares)

    encoded = seen.join(F.broadcast(priors), "fold").select(
        "category", "fold", *[_shares(F.col(f"n{i}"), whole, F.col(f"p{i}")).alias(f"te{i}") for i in each]
    )
    unseen = priors.select(
        F.lit(None).cast("string").alias("category"), "fold", *[F.col(f"p{i}").alias(f"te{i}") for i in each]
    )
    return encoded.unionByName(unseen)


def apply_target_encoding(
    rows: DataFrame, encoding: DataFrame, feature: str, classes: list[str], fold: Column
) -> DataFrame:
    """``rows`` with one column ``te_<feature>_<i>`` per class; unseen categories get the priors of their fold."""
    names = [f"te{i}" for i in range(len(classes))]
    # one row per fold
    priors = encoding.filter("category IS NULL").select(
        F.col("fold").alias("_fold"), *[F.col(name).alias(f"_{name}") for name in names]
    )
    known = encoding.filter("category IS NOT NULL").select(
        F.col("category").alias("_category"), F.col("fold").alias("_fold"), *names
    )
    joined = (
        rows.withColumn("_fold", fold)
        .join(F.broadcast(priors), "_fold")
        .withColumn("_category", F.col(feature))
        .join(known, ["_category", "_fold"], "left")
    )
    values = [F.coalesce(name, f"_{name}").alias(f"te_{feature}_{i}") for i, name in enumerate(names)]
    return joined.select(*rows.columns, *values)


def long_encoding(encoding: DataFrame, feature: str, classes: list[str]) -> DataFrame:
    """(feature, category, fold, label, encoding): one row per class."""
    cells = F.array(*[
        F.struct(F.lit(name).alias("label"), F.col(f"te{i}").alias("encoding")) for i, name in enumerate(classes)
    ])
    return encoding.select(F.lit(feature).alias("feature"), "category", "fold", F.inline(cells))


def fit_ordinals(train: DataFrame, features: list[str]) -> dict[str, DataFrame]:
    """Per feature (value, place): alphabetical positions of the train values, from 0.

    Values are sorted over all tasks, and the sizes of the sorted parts give each part its first position.
    """
    tables = {}
    for name in features:
        values = train.filter(F.col(name).isNotNull()).select(F.col(name).alias("value")).distinct()
        ordered = values.repartitionByRange("value").sortWithinPartitions("value")
        ordered = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordinals")
        part = F.shiftright("_at", _PART_BITS)
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per sorted part
        starts = ordered.groupBy(part.alias("_part")).count()
        starts = starts.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
        place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
        placed = ordered.withColumn("_part", part).join(F.broadcast(starts), "_part")
        tables[name] = materialize(placed.select("value", place.cast("double").alias("place")), "ordinals")
    return tables


def apply_ordinals(tables: dict[str, DataFrame], rows: DataFrame, features: list[str]) -> DataFrame:
    """``rows`` with ``<feature>_index``: alphabetical position among the train values, -1 if not among them."""
    for name in features:
        known = tables[name].select(F.col("value").alias("_value"), F.col("place").alias("_place"))
        rows = rows.join(known, rows[name] == known["_value"], "left")
        rows = rows.withColumn(f"{name}_index", F.coalesce("_place", F.lit(-1.0))).drop("_value", "_place")
    return rows
