"""Fill forecasts per bin and horizon, with a spread over the forest's trees."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillwatch.functions import levels
from fillwatch.operators.features import FEATURES, FORECAST_RATE_HOURS
from fillwatch.operators.training import HORIZONS, forests
from fillwatch.session import shared_dir

TEMPERATURE_NOISE, HUMIDITY_NOISE = 0.5, 2.0
LOW, HIGH = 0.1, 0.9


def horizon_features(
    features: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    noise: float = 0.0,
    seed: int = 42,
) -> DataFrame:
    """Each bin's features moved ahead to each horizon.

    ``noise=1.0`` shakes temperature and humidity by their usual spread; the default of
    0 makes forecasts repeatable.
    """
    h = F.col("horizon")
    hours = F.col("hour_of_day") + h
    level = F.col("current_fill_level")
    shaken = lambda c, sigma, s: c + F.randn(s) * (sigma * noise) if noise else c
    ahead = F.least(F.lit(100.0), level + F.col(f"fill_rate_{FORECAST_RATE_HOURS}h") * h)
    heat = shaken(F.col("temperature") + F.col("temperature_trend") * h, TEMPERATURE_NOISE, seed)
    damp = levels.clamp(shaken(F.col("humidity"), HUMIDITY_NOISE, seed + 1), 0, 100)
    moved = {
        "base_fill_level": level,
        "current_fill_level": ahead,
        "temperature": heat,
        "humidity": damp,
        "hour_of_day": hours % 24,
        "day_of_week": (F.col("day_of_week") + F.floor(hours / 24).cast("int")) % 7,
    }
    spread = features.withColumn("horizon", F.explode(F.array(*[F.lit(x) for x in horizons])))
    return spread.select(
        "bin_id",
        *[moved.get(c, F.col(c)).alias(c) for c in (*FEATURES, "base_fill_level")],
    )


def leaf_values(spark: SparkSession, model: PipelineModel, path: str | None = None) -> DataFrame:
    """One row, ``leaf_values[tree][leaf]``, in the numbering of the model's leaf column.

    Read back from the saved forests. Its size is bounded by trees times 2^depth doubles:
    200 trees of depth 10 stay under 2 MB.
    """
    path = path or shared_dir(spark, "forest")
    nodes, first = [], 0
    for i, forest in enumerate(forests(model)):
        forest.write().overwrite().save(f"{path}/{i}")
        nodes.append(spark.read.parquet(f"{path}/{i}/data").withColumn("treeID", F.col("treeID") + first))
        first += forest.getNumTrees
    leaf = F.struct("nodeData.id", "nodeData.prediction")
    per_tree = (
        reduce(DataFrame.unionByName, nodes)
        .filter("nodeData.leftChild < 0")
        .groupBy("treeID")
        .agg(F.transform(F.array_sort(F.collect_list(leaf)), lambda s: s["prediction"]).alias("v"))
    )
    return per_tree.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("treeID", "v"))), lambda s: s["v"]
        ).alias("leaf_values")
    )


def _quantile(ordered: Column, q: float) -> Column:
    """Linear interpolation between the two order statistics around ``q``."""
    place = (F.size(ordered) - 1) * F.lit(q)
    below = F.floor(place).cast("int")
    above = F.ceil(place).cast("int")
    low, high = F.get(ordered, below), F.get(ordered, above)
    return low + (high - low) * (place - below)


def tree_spread(scored: DataFrame, leaves: DataFrame) -> DataFrame:
    """Mean of the trees, and half the distance of their 10th and 90th percentile.

    The leaf table is one bounded value, so it enters as a scalar subquery: every row
    looks its leaves up in place, with no join and no row per tree.
    """
    per_tree = F.zip_with(
        F.col("_values"),
        vector_to_array("leaves"),
        lambda values, leaf: F.get(values, leaf.cast("int")),
    )
    rows = scored.withColumn("_values", leaves.scalar())
    # sort_array: array_sort would call an interpreted comparator for each pair
    rows = rows.withColumn("_trees", F.sort_array(per_tree))
    mean = F.aggregate("_trees", F.lit(0.0), lambda a, v: a + v) / F.size("_trees")
    half = (_quantile(F.col("_trees"), HIGH) - _quantile(F.col("_trees"), LOW)) / 2
    return rows.withColumns({"tree_mean": mean, "tree_half_spread": half}).drop("_values", "_trees")


def monotone(rows: DataFrame, predicted: str = "tree_mean") -> DataFrame:
    """``predicted_fill``: never below the current fill nor an earlier horizon, 0..100.

    A partition holds one bin's horizons, a handful of rows.
    """
    so_far = (
        Window.partitionBy("bin_id")
        .orderBy("horizon")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    floor = F.greatest(F.col(predicted), F.col("base_fill_level"))
    return rows.withColumn(
        "predicted_fill", F.max(F.round(levels.clamp(floor, 0, 100), 2)).over(so_far)
    )


def with_band(rows: DataFrame) -> DataFrame:
    fill, spread = F.col("predicted_fill"), F.col("confidence")
    return rows.withColumns({"lower": fill - spread, "upper": fill + spread})


def with_level(rows: DataFrame, column: str = "predicted_fill") -> DataFrame:
    return rows.withColumn("level", levels.level(F.col(column)))


def predict(
    model: PipelineModel | None,
    features: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    noise: float = 0.0,
    seed: int = 42,
    bins: DataFrame | None = None,
    leaves: DataFrame | None = None,
) -> DataFrame:
    """All bins and horizons at once.

    With ``bins``, a bin without readings gets a row of nulls per horizon. Without a model, for
    want of examples, every bin does.
    """
    horizons = tuple(horizons) or HORIZONS
    if model is None:
        none = F.lit(None).cast("double")
        rows = (bins if bins is not None else features).select("bin_id").distinct()
        rows = rows.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
        return with_level(with_band(rows.withColumns({"predicted_fill": none, "confidence": none})))
    if leaves is None:
        leaves = leaf_values(features.sparkSession, model)
    scored = model.transform(horizon_features(features, horizons, noise, seed))
    rows = monotone(tree_spread(scored, leaves)).select(
        "bin_id", "horizon", "predicted_fill", F.round("tree_half_spread", 2).alias("confidence")
    )
    if bins is not None:
        wanted = bins.select("bin_id").distinct()
        wanted = wanted.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
        rows = wanted.join(rows, ["bin_id", "horizon"], "left")
    return with_level(with_band(rows))
