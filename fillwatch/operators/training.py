"""Training examples, the forest that learns from them, and how well it does."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwatch.operators import asof, features, grower, history
from fillwatch.operators.features import FEATURES
from fillwatch.session import settled

# Horizons and the rows that may become examples.
HORIZONS = (1, 6, 12, 24)
MIN_READINGS = 50
WARMUP = 24
TREES, DEPTH, SEED = 200, 10, 42
TRAIN_TENTHS = 8

#: Spark's forest keeps, for each example and tree, how often it is drawn and where it is: some 16
#: bytes. Up to ``PAIRS`` of them it is used; beyond that trees are grown over binned examples (``grower``),
#: ``TURN_PAIRS`` at a time.
PAIRS, TURN_PAIRS = 1 << 28, 1 << 32
#: Bins of a feature, as many as Spark takes.
BINS = 32

EXAMPLE_KEY = ("bin_id", "sensor_id", "timestamp")


def examples(
    readings: DataFrame,
    as_of: dt.datetime,
    mode: str = "row",
    maintenance: DataFrame | None = None,
    bins: DataFrame | None = None,
    horizons: tuple[int, ...] = HORIZONS,
    min_readings: int = MIN_READINGS,
    warmup: int = WARMUP,
    horizon_unit: str = "rows",
    block_rows: int = history.BLOCK_ROWS,
    parts: int = history.PARTS,
) -> DataFrame:
    """One row per reading and horizon: 15 features and the fill to predict.

    With ``horizon_unit="rows"`` the label is the fill ``h`` readings later; with
    ``"hours"`` it is that of the first reading at or after ``h`` hours later, and rows
    without one are left out.
    """
    if horizon_unit not in ("rows", "hours"):
        raise ValueError(f"horizon_unit is 'rows' or 'hours', not {horizon_unit!r}")
    by_rows = horizon_unit == "rows"
    known = history.prefix(
        readings,
        as_of,
        mode,
        maintenance,
        bins,
        ahead=tuple(horizons) if by_rows else (),
        min_readings=min_readings,
        block_rows=block_rows,
        parts=parts,
    )
    known = known.filter(F.col("position") >= warmup)
    if by_rows:
        known = known.filter(F.col("position") < F.col("total") - max(horizons))
        pairs = F.array(
            *[
                F.struct(F.lit(h).alias("horizon"), F.col(f"fill_after_{h}").alias("label"))
                for h in horizons
            ]
        )
        spread = known.select("*", F.inline(pairs))
    else:
        spread = _labelled(known, readings, horizons)
    return spread.select(*EXAMPLE_KEY, *FEATURES, "label")


def _labelled(known: DataFrame, readings: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """``known`` by ``horizon``, with the fill of the first reading at or after so many hours."""
    due = F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon")
    at = (F.col("timestamp") + F.make_dt_interval(hours=F.col("horizon"))).alias("_due")
    later = features.with_defaults(readings).select(
        "bin_id", F.col("timestamp").alias("_at"), F.col("fill_level").alias("label")
    )
    return asof.attach(
        known.select("*", due).select("*", at),
        later,
        "bin_id",
        "_due",
        "_at",
        ["label"],
        direction="forward",
        slot_hours=1,
        times_of=readings.select("bin_id", "timestamp", due).select("bin_id", at),
    ).filter(F.col("label").isNotNull())


def labels(
    readings: DataFrame,
    horizons: tuple[int, ...] = HORIZONS,
    min_readings: int = MIN_READINGS,
    warmup: int = WARMUP,
) -> DataFrame:
    """The labels of ``examples`` with ``horizon_unit="hours"``, from key, time and fill alone."""
    known = history.positions(readings).filter(
        (F.col("total") >= min_readings) & (F.col("position") >= warmup)
    )
    spread = _labelled(known.select(*EXAMPLE_KEY), readings, horizons)
    return spread.select(*EXAMPLE_KEY, "horizon", "label")


def profile(rows: DataFrame, columns: tuple[str, ...] = FEATURES) -> DataFrame:
    """How many examples, and the population deviation of each feature."""
    return rows.agg(
        F.count("*").alias("examples"), *[F.stddev_pop(c).alias(f"std_{c}") for c in columns]
    )


def split(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``is_train``, true for about four fifths.

    Decided by a hash of the example's key, so it holds however the rows are
    partitioned or recomputed.
    """
    key = F.concat_ws("|", F.lit(str(seed)), "bin_id", "sensor_id", F.col("horizon").cast("string"))
    tenth = F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("int") % 10
    return rows.withColumn("is_train", tenth < TRAIN_TENTHS)


def _scaling() -> list:
    return [
        VectorAssembler(inputCols=list(FEATURES), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]


def _forest(trees: int, depth: int, seed: int) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features",
        labelCol="label",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=2,
        featureSubsetStrategy="sqrt",
        seed=seed,
        leafCol="leaves",
        cacheNodeIds=True,
    )


def pipeline(trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Pipeline:
    """Assemble, standardise, forest. At least two rows per leaf stands in for the
    least split of five, which Spark's trees do not know."""
    return Pipeline(stages=[*_scaling(), _forest(trees, depth, seed)])


def fit(
    train: DataFrame,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    pairs: int = PAIRS,
    turn_pairs: int | None = None,
) -> PipelineModel | None:
    """The fitted pipeline; none where there is nothing to learn from.

    Every tree draws from all examples. Up to ``pairs`` examples times trees Spark's own forest is
    fitted; beyond that ``grower`` takes its place, which holds nothing for an example and tree.
    Where they are more than ``turn_pairs`` (by default ``TURN_PAIRS``, or ``pairs`` if given less), the
    trees are grown some at a time, each time from a seed of its own, and the pipeline holds several
    forests whose trees count alike: what a pass sends does not grow with the trees.
    """
    rows = train.count()
    if not rows:
        return None
    if rows * trees <= pairs:
        return pipeline(trees, depth, seed).fit(train)
    turn_pairs = turn_pairs or (TURN_PAIRS if pairs >= PAIRS else pairs)
    return _in_turns(train, rows, trees, depth, seed, min(trees, -(-rows * trees // turn_pairs)))


def _in_turns(train: DataFrame, rows: int, trees: int, depth: int, seed: int, turns: int) -> PipelineModel:
    """As many forests as ``turns``, over blocks of binned examples."""
    scaling = Pipeline(stages=_scaling()).fit(train)
    cores = train.sparkSession.sparkContext.defaultParallelism
    low, high = train.agg(F.min("label"), F.max("label")).first()
    few = settled(scaling.transform(train.sample(min(1.0, grower.SPLIT_ROWS / rows), seed)).select("features", "label"))
    values = few.select(vector_to_array("features").alias("v")).toArrow().column("v").combine_chunks()
    cuts = [grower.thresholds(v, BINS) for v in values.flatten().to_numpy().reshape(-1, len(FEATURES)).T]
    # scaled and binned once, for each level of each turn to pass over; only the blocks are dealt out
    tasks = cores * -(-rows // (cores * grower.TASK_ROWS))
    held = grower.blocks(scaling.transform(train), cuts).repartition(tasks).persist(StorageLevel.DISK_ONLY)
    ends = [trees * i // turns for i in range(turns + 1)]
    sizes = [high - low for low, high in zip(ends, ends[1:])]
    grown = [
        grower.fit(
            held,
            few.limit(8),
            _forest(size, depth, seed + i).setPredictionCol(f"prediction_{i}").setLeafCol(f"leaves_{i}"),
            cuts,
            low,
            high,
        )
        for i, size in enumerate(sizes)
    ]
    held.unpersist()
    leaves = VectorAssembler(inputCols=[f"leaves_{i}" for i in range(turns)], outputCol="leaves")
    mean = " + ".join(f"{size} * prediction_{i}" for i, size in enumerate(sizes))
    parts = ", ".join(f"prediction_{i}, leaves_{i}" for i in range(turns))
    joint = SQLTransformer(statement=f"SELECT * EXCEPT ({parts}), ({mean}) / {trees} AS prediction FROM __THIS__")
    return PipelineModel([*scaling.stages, *grown, leaves, joint])


def forests(model: PipelineModel) -> list[RandomForestRegressionModel]:
    """The forests of a fitted pipeline, in the order of their trees in its leaf column."""
    return [stage for stage in model.stages if isinstance(stage, RandomForestRegressionModel)]


def evaluate(model: PipelineModel | None, test: DataFrame) -> DataFrame:
    """Mean absolute and root mean squared error on held-out examples."""
    if model is None:
        none = F.lit(None).cast("double")
        return test.agg(F.count("*").alias("examples")).select("examples", none.alias("mae"), none.alias("rmse"))
    error = F.col("prediction") - F.col("label")
    return model.transform(test).agg(
        F.count("*").alias("examples"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def importances(model: PipelineModel | None, test: DataFrame) -> DataFrame:
    """One row per feature and its importance, null without a model."""
    weights: list[float | None] = [None] * len(FEATURES)
    if model is not None:
        grown = forests(model)
        trees = sum(forest.getNumTrees for forest in grown)
        each = [forest.featureImportances.toArray() * (forest.getNumTrees / trees) for forest in grown]
        weights = [float(w) for w in sum(each)]
    return test.sparkSession.createDataFrame(
        list(zip(FEATURES, weights)), "feature string, importance double"
    )
