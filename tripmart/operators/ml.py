"""Splits, training, evaluation and importances on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorIndexer
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import portable_bucket
from ..session import materialize
from . import forecast
from .features import tip_features
from .ordering import time_at_fraction, time_at_row

HOLD_OUT_FROM = "2024-12-01"


# --- Splits ----------------------------------------------------------------


def hold_out(df: DataFrame, start: str = HOLD_OUT_FROM) -> tuple[DataFrame, DataFrame]:
    """(rows before ``start``, rows from ``start`` on)."""
    border = F.lit(start).cast("timestamp")
    hour = F.col("pickup_hour")
    return df.filter(hour < border), df.filter(hour >= border)


def time_split(df: DataFrame, test_size: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Chronological split at a row fraction, moved to the hour border.

    No hour is split over both sides.
    """
    at = time_at_fraction(df, "pickup_hour", {"cut": 1 - test_size})["cut"]
    cut = F.lit(at)
    return df.filter(F.col("pickup_hour") < cut), df.filter(F.col("pickup_hour") >= cut)


def mark_folds(df: DataFrame, n_splits: int = 5, gap: int = 24) -> DataFrame:
    """Expanding-window folds as two columns, so that one scan serves all of them.

    Fold i (from 1) tests the i-th block of rows in time and trains on what precedes it,
    less the ``gap`` rows before the block.  ``test_fold`` is the fold that a row tests (0
    for none), ``train_from`` the first fold that it trains; it trains all later ones too.
    Row positions are translated to hours: no hour is split over folds.
    """
    n = df.count()
    block = n // (n_splits + 1)
    if block == 0:
        raise ValueError(f"{n} rows are too few for {n_splits} folds")
    firsts = [n - (n_splits - i) * block for i in range(n_splits)]
    marks = {f"test{i}": first for i, first in enumerate(firsts)}
    marks |= {f"train{i}": max(first - gap, 0) for i, first in enumerate(firsts)}
    at = time_at_row(df, "pickup_hour", marks)

    def passed(kind: str) -> Column:
        """How many borders of a kind a row's hour has reached."""
        borders = F.array(*[F.lit(at[f"{kind}{i}"]) for i in range(n_splits)])
        return F.size(F.filter(borders, lambda border: border <= F.col("pickup_hour")))

    return df.withColumns({"test_fold": passed("test"), "train_from": passed("train") + 1})


def fold_sides(marked: DataFrame, n_splits: int = 5) -> DataFrame:
    """One row per fold a marked row takes part in: ``fold`` and ``side``."""
    numbers = F.sequence(F.lit(1), F.lit(n_splits))
    sides = F.filter(
        F.transform(
            numbers,
            lambda i: F.struct(
                i.alias("fold"),
                F.when(i == F.col("test_fold"), "test").when(i >= F.col("train_from"), "train").alias("side"),
            ),
        ),
        lambda s: s["side"].isNotNull(),
    )
    return marked.select("*", F.inline(sides))


def time_series_folds(
    df: DataFrame, n_splits: int = 5, gap: int = 24
) -> list[tuple[DataFrame, DataFrame]]:
    """(train, test) of each fold of ``mark_folds``, as filters on its columns."""
    marked = mark_folds(df, n_splits, gap)
    marks = ["test_fold", "train_from"]
    return [
        (
            marked.filter((F.col("train_from") <= i) & (F.col("test_fold") != i)).drop(*marks),
            marked.filter(F.col("test_fold") == i).drop(*marks),
        )
        for i in range(1, n_splits + 1)
    ]


def random_split(
    df: DataFrame, test_size: float = 0.2, seed: int = 42, keys: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the keys' text: repeatable in any partitioning and any engine.

    Rows with equal keys fall on the same side.
    """
    bucket = portable_bucket(keys or df.columns, 10_000, seed)
    limit = round(test_size * 10_000)
    return df.filter(bucket >= limit), df.filter(bucket < limit)


# --- Training ----------------------------------------------------------------


_FILLED = "_filled_"


class ModelSpec(NamedTuple):
    features: Sequence[str]
    target: str
    categorical_limit: int
    loss: str = "squared"
    max_depth: int = 6
    step_size: float = 0.1
    max_iter: int = 50
    min_rows_per_node: int = 1


# Zone ids, hours and weekdays have fewer than 512 codes and are split as
# categories in the demand model; fare and tip models treat codes as numbers.
DEMAND_MODEL = ModelSpec(K.DEMAND_FEATURES, "demand", 512)
FARE_MODEL = ModelSpec(K.FARE_TIP_FEATURES, "fare_amount", 2, max_depth=7, min_rows_per_node=3)
TIP_MODEL = ModelSpec(
    K.FARE_TIP_FEATURES, "tip_percent", 2, loss="absolute", max_depth=8, min_rows_per_node=15
)
CATEGORICAL = ["pu_location_id", "hour", "day_of_week"]
# Stands for a missing value: below all features, so that one split sets these rows apart.
MISSING = -1_000_000.0


def fit(train: DataFrame, spec: ModelSpec, *, validation: str | None = None, seed: int = 42):
    """Gradient-boosted trees over the spec's features.

    ``validation`` names a boolean column whose true rows decide early stopping.
    Training is distributed: every tree level is one pass of histogram
    aggregation over the cached feature vectors.  The first stage gives missing
    features a value of their own, so no row is lost in training or scoring.
    """
    codes = [c for c in spec.features if c in CATEGORICAL and spec.categorical_limit > 2]
    numbers = [c for c in spec.features if c not in codes]
    filled = ", ".join(
        f"coalesce(nanvl(double(`{c}`), NULL), double({MISSING})) AS `{_FILLED}{c}`"
        for c in spec.features
    )
    stages = [SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")]
    inputs = [_FILLED + c for c in numbers]
    if codes:
        stages += [
            VectorAssembler(
                inputCols=[_FILLED + c for c in codes], outputCol="_codes", handleInvalid="error"
            ),
            VectorIndexer(
                inputCol="_codes",
                outputCol="_coded",
                maxCategories=spec.categorical_limit,
                handleInvalid="keep",
            ),
        ]
        inputs = ["_coded", *inputs]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    booster = GBTRegressor(
        featuresCol="features",
        labelCol="_label",
        lossType=spec.loss,
        maxDepth=spec.max_depth,
        maxIter=spec.max_iter,
        stepSize=spec.step_size,
        minInstancesPerNode=spec.min_rows_per_node,
        subsamplingRate=0.8,
        maxBins=max(32, spec.categorical_limit + 1),
        seed=seed,
    )
    if validation is not None:
        booster = booster.setValidationIndicatorCol(validation)
    labelled = train.withColumn("_label", F.col(spec.target).cast("double"))
    return Pipeline(stages=[*stages, booster]).fit(labelled)


def n_trees(model: PipelineModel) -> int:
    return model.stages[-1].getNumTrees


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with a prediction for every row, whatever is missing in it."""
    scored = model.transform(df)
    helpers = [c for c in scored.columns if c.startswith(_FILLED)]
    return scored.drop("_codes", "_coded", "features", *helpers)


def feature_names(spec: ModelSpec) -> list[str]:
    """Names in the order of the model's feature vector."""
    codes = [c for c in spec.features if c in CATEGORICAL and spec.categorical_limit > 2]
    return codes + [c for c in spec.features if c not in codes]


def importance(
    spark: SparkSession, model: PipelineModel, spec: ModelSpec, top_n: int = 10
) -> DataFrame:
    """Feature importances as shares of the total, with running top-N coverage."""
    scores = model.stages[-1].featureImportances
    names = feature_names(spec)
    rows = [(name, float(scores[i])) for i, name in enumerate(names)]
    gains = spark.createDataFrame(rows, "feature string, gain double")
    return importance_shares(gains, top_n)


def split_gains(
    spark: SparkSession, path: str, model: PipelineModel, spec: ModelSpec
) -> DataFrame:
    """Gain and number of splits per feature, from the trees of a model saved at ``path``.

    Every node tells by how much its split lowers the variance of the rows it holds; a
    feature's gain is the sum over its splits, times rows and the tree's weight.  Features
    that no tree splits by have none.
    """
    at = len(model.stages) - 1
    stage = f"{path}/stages/{at:0{len(str(len(model.stages)))}d}_{model.stages[at].uid}"
    nodes = spark.read.parquet(f"{stage}/data").select("treeID", "nodeData.*")
    trees = spark.read.parquet(f"{stage}/treesMetadata").toDF("treeID", "metadata", "weights")
    trees = trees.drop("metadata")
    # One row per tree, fifty or so.
    splits = nodes.filter("leftChild >= 0").join(F.broadcast(trees), "treeID")
    names = F.array(*[F.lit(name) for name in feature_names(spec)])
    found = splits.groupBy(F.get(names, F.col("split.featureIndex")).alias("feature")).agg(
        F.sum(F.abs("weights") * F.col("gain") * F.col("rawCount")).alias("gain"),
        F.count("*").alias("splits"),
    )
    every = spark.createDataFrame([(name,) for name in feature_names(spec)], "feature string")
    return every.join(F.broadcast(found), "feature", "left").fillna(0, ["gain", "splits"])


def permutation_importance(
    model: PipelineModel,
    df: DataFrame,
    spec: ModelSpec,
    keys: Sequence[str],
    *,
    seed: int = 42,
    bucket_rows: int = 4096,
) -> DataFrame:
    """(feature, rmse, rise): error with one feature at a time taken from another row.

    The order of a hash of ``keys``, which tell rows apart, hands every feature of a row on
    to the next one; the order is kept within buckets of some ``bucket_rows`` rows, which
    no task has to sort with others.  A row is scored as it is and once per feature, all in
    one pass.
    """
    buckets = max(1, df.count() // bucket_rows)
    shuffled = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    ring = Window.partitionBy(portable_bucket(keys, buckets, seed)).orderBy(shuffled, *keys)
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = F.struct(*[F.col(c) for c in spec.features])
    # The last row of a bucket hands on to the first.
    given = F.coalesce(F.lag(values).over(ring), F.last(values).over(whole))
    rows = df.withColumn("_given", given)
    variants = F.explode(F.array(F.lit(None).cast("string"), *[F.lit(c) for c in spec.features]))
    rows = rows.withColumn("_variant", variants).withColumns(
        {
            c: F.when(F.col("_variant") == c, F.col("_given")[c]).otherwise(F.col(c))
            for c in spec.features
        }
    )
    apart = F.col("prediction") - F.col(spec.target)
    scores = predict(model, rows.drop("_given")).groupBy("_variant").agg(
        F.sqrt(F.avg(apart * apart)).alias("rmse")
    )
    scores = materialize(scores, "permutation-scores")
    base = scores.filter("_variant IS NULL").select("rmse").scalar()
    return scores.filter("_variant IS NOT NULL").select(
        F.col("_variant").alias("feature"), "rmse", (F.col("rmse") - base).alias("rise")
    )


def importance_shares(gains: DataFrame, top_n: int = 10) -> DataFrame:
    """Share of total gain (percent), rank and running coverage of the top N.

    ``gains`` has one row per model feature.
    """
    total = gains.agg(F.sum("gain")).scalar()
    order = Window.orderBy(F.desc("gain"), "feature")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        gains.withColumn("share_pct", F.try_divide(F.col("gain"), total) * 100)
        .withColumns(
            {
                "rank": F.row_number().over(order),
                "coverage_pct": F.sum("share_pct").over(running),
            }
        )
        .filter(F.col("rank") <= top_n)
    )


# --- Runs --------------------------------------------------------------------


def _score(model: PipelineModel, df: DataFrame, target: str, *, clip: bool) -> DataFrame:
    """Scores over every row of ``df``; ``clip`` lifts negative predictions to zero."""
    value = F.greatest(F.col("prediction"), F.lit(0.0)) if clip else F.col("prediction")
    return forecast.metrics(predict(model, df).withColumn("_predicted", value), target, "_predicted")


def _described(scores: DataFrame, model: PipelineModel, spec: ModelSpec) -> DataFrame:
    return scores.withColumns(
        {
            "n_trees": F.lit(n_trees(model)),
            "n_features": F.lit(len(spec.features)),
        }
    )


def early_stopping_tail(train: DataFrame, share: float = 0.1) -> DataFrame:
    """Mark the last rows in time as validation rows."""
    at = time_at_fraction(train, "pickup_hour", {"cut": 1 - share})["cut"]
    return train.withColumn("_validation", F.col("pickup_hour") >= F.lit(at))


def train_demand(
    features: DataFrame,
    *,
    test_size: float = 0.2,
    spec: ModelSpec = DEMAND_MODEL,
    cv_folds: int = 0,
) -> tuple[PipelineModel, DataFrame]:
    """Demand model and its scores on the last rows before the hold-out month.

    With ``cv_folds`` the record also has the spread of RMSE over that many
    expanding-window folds of the training part.
    """
    known, _ = hold_out(features)
    # The windows behind the features would otherwise run again for every cut,
    # fit and score.
    known = materialize(known, "demand-features")
    train, test = time_split(known, test_size)
    model = fit(early_stopping_tail(train), spec, validation="_validation")
    scores = forecast.with_baseline(_score(model, test, spec.target, clip=False))
    if cv_folds:
        cv = materialize(cross_validate(train, n_splits=cv_folds, spec=spec), "cv-scores")
        scores = scores.withColumns({c: cv.select(c).scalar() for c in cv.columns})
    return model, _described(scores, model, spec)


def row_accounting(model: PipelineModel, parts: dict[str, DataFrame]) -> DataFrame:
    """Rows given to and scored by a model, per named part."""
    counts = None
    for name, df in parts.items():
        scored = predict(model, df).agg(F.count("prediction")).scalar()
        one = df.agg(F.count("*").alias("rows_given")).select(
            F.lit(name).alias("part"), "rows_given", scored.alias("rows_scored")
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


def cross_validate(
    features: DataFrame, *, n_splits: int = 5, gap: int = 24, spec: ModelSpec = DEMAND_MODEL
) -> DataFrame:
    """Mean and standard deviation of RMSE over expanding-window folds.

    Each fold stops early by the last rows of its own training part.
    """
    known = materialize(features, "cv-features")
    folds = None
    for i, (train, test) in enumerate(time_series_folds(known, n_splits, gap)):
        marked = early_stopping_tail(train)
        scored = predict(fit(marked, spec, validation="_validation"), test)
        one = forecast.metrics(scored, spec.target, "prediction").withColumn("fold", F.lit(i + 1))
        folds = one if folds is None else folds.unionByName(one)
    return folds.agg(
        F.count("*").alias("folds"),
        F.avg("rmse").alias("cv_rmse_mean"),
        F.stddev_pop("rmse").alias("cv_rmse_std"),
    )


def _train_random(
    rows: DataFrame, spec: ModelSpec, test_size: float, val_size: float, seed: int
) -> tuple[PipelineModel, DataFrame]:
    rows = materialize(rows, f"{spec.target}-features")
    train, test = random_split(rows, test_size, seed)
    bucket = portable_bucket(rows.columns, 10_000, seed + 1)
    train = train.withColumn("_validation", bucket < round(val_size * 10_000))
    model = fit(train, spec, validation="_validation", seed=seed)
    return model, _described(_score(model, test, spec.target, clip=True), model, spec)


def train_fare(
    fare_rows: DataFrame,
    *,
    test_size: float = 0.2,
    val_size: float = 0.1,
    seed: int = 42,
    spec: ModelSpec = FARE_MODEL,
) -> tuple[PipelineModel, DataFrame]:
    """Fare model and scores from rows of ``features.fare_features``."""
    return _train_random(fare_rows, spec, test_size, val_size, seed)


def train_tip(
    fare_rows: DataFrame,
    *,
    test_size: float = 0.2,
    val_size: float = 0.1,
    seed: int = 42,
    spec: ModelSpec = TIP_MODEL,
) -> tuple[PipelineModel, DataFrame]:
    """Tip share model and scores; trained on card trips only."""
    return _train_random(tip_features(fare_rows), spec, test_size, val_size, seed)


def write_metrics(scores: DataFrame, path: str) -> None:
    """One JSON document with scores rounded to four digits; scores is one row."""
    rounded = {c: F.round(c, 4) for c in ("rmse", "mae", "mape", "r2") if c in scores.columns}
    scores.withColumns(rounded).coalesce(1).write.mode("overwrite").json(path)
