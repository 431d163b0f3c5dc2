"""Forecast models: MLlib estimators with the settings of each training job."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from time import perf_counter

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barstream import schemas as S
from barstream.operators.boosting import fit_boosted, room_of_others
from barstream.storage import shared_dir

# --- fixed values: settings of the training jobs ----------------------------
LASSO_RETURN = dict(elasticNetParam=1.0, regParam=0.001, maxIter=200, standardization=True)
LASSO_PRICE = dict(elasticNetParam=1.0, regParam=0.01, maxIter=20)
TREE_PRESETS = {
    "main": dict(maxDepth=5, maxIter=50, maxBins=256, subsamplingRate=0.8, stepSize=0.1),
    "small": dict(maxIter=10),
    # Leaf-wise libraries are re-aimed at depth-wise trees: 31 leaves ~ depth 5,
    # 255 leaves ~ depth 8.
    "balanced": dict(maxDepth=5, maxIter=80, stepSize=0.05, subsamplingRate=0.8,
                     featureSubsetStrategy="0.8", minInstancesPerNode=20),
    "leaves_31": dict(maxDepth=5, maxIter=200, stepSize=0.05, subsamplingRate=0.8,
                      featureSubsetStrategy="0.8"),
    "leaves_255": dict(maxDepth=8, maxIter=600, stepSize=0.01, subsamplingRate=0.8,
                       featureSubsetStrategy="0.8", minInstancesPerNode=10),
}
FEATURES_META = "feature_columns.json"


def assemble(df: DataFrame, columns: list[str], output: str = "features",
             missing: str = "skip") -> DataFrame:
    """Feature vector; rows with a missing or NaN input are skipped, or kept with NaN ("keep")."""
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid=missing).transform(df)


def _drawn(share: float, seed: int) -> Column:
    """Whether a row is in a random share, fixed by its key's text: the md5 of "symbol|time|seed" against the share, as
    hexadecimal texts of 13 digits, so any engine draws the same rows."""
    if share >= 1.0:
        return F.lit(True)
    key = F.concat_ws("|", F.coalesce(F.col("symbol"), F.lit("")), F.coalesce(F.col("timestamp").cast("string"), F.lit("")), F.lit(str(seed)))
    return F.substring(F.md5(key), 1, 13) < F.lit(f"{max(int(share * 16 ** 13), 0):013x}")


def random_split(df: DataFrame, share: float = S.TRAIN_SHARE, seed: int = 42
                 ) -> tuple[DataFrame, DataFrame]:
    """Random share for training, the rest for testing.

    The draw ignores time, so neighbours of a test row can be in training;
    ``time_split`` is the default elsewhere.
    """
    return df.filter(_drawn(share, seed)), df.filter(~_drawn(share, seed))


def sample_train(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df if fraction >= 1.0 else df.filter(_drawn(fraction, seed + 1))


def fit_lasso(train: DataFrame, price: bool = False, **overrides) -> LinearRegressionModel:
    """L1 regression on the next return (7 inputs) or the next price (11 inputs)."""
    columns = S.SMALL_FEATURES if price else S.LASSO_FEATURES
    settings = {**(LASSO_PRICE if price else LASSO_RETURN), **overrides}
    estimator = LinearRegression(
        featuresCol="features", labelCol="Target_Price" if price else "Target_Return", **settings)
    return estimator.fit(assemble(train, columns).select("features", estimator.getLabelCol()))


def _joined_moments(one: tuple, other: tuple) -> tuple:
    """(rows, means, sums of products of deviations) of two sets of rows together."""
    (n, mean, products), (m, other_mean, other_products) = one, other
    total, apart = max(n + m, 1), other_mean - mean
    return n + m, mean + apart * (m / total), products + other_products + np.outer(apart, apart) * (n * m / total)


def _moments(df: DataFrame, columns: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows without a gap, their means and sums of products of deviations, of all pairs of columns.

    Each task sums up its batches as matrices and hands on one row; an aggregate per pair would be too many for
    generated code.
    """
    width = len(columns)
    none = (0, np.zeros(width), np.zeros((width, width)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = none
        for batch in batches:
            if batch.num_rows:
                rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
                mean = rows.mean(axis=0)
                moments = _joined_moments(moments, (len(rows), mean, (rows - mean).T @ (rows - mean)))
        yield pa.RecordBatch.from_arrays([pa.array([moments[0]], pa.int64()), pa.array([moments[1]], pa.list_(pa.float64())),
                                          pa.array([moments[2].ravel()], pa.list_(pa.float64()))], names=["n", "mean", "products"])

    whole = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    parts = whole.mapInArrow(run, "n long, mean array<double>, products array<double>").collect()
    return reduce(_joined_moments, ((p["n"], np.array(p["mean"]), np.array(p["products"]).reshape(width, width)) for p in parts), none)


def lasso_certificate(train: DataFrame, model: LinearRegressionModel, columns: list[str], target: str) -> DataFrame:
    """(feature, weight, mean, covariance with the target, gap): how far a fitted L1 regression is from optimal.

    One pass gives means and all covariances; from these follows the gradient of the squared error. With
    penalty p (``regParam`` times the feature's deviation) the optimum has gradient p against the sign of a
    weight, and at most p where the weight is zero. ``gap`` is the distance from that, as a share of the largest
    gradient that all-zero weights have (features in units of their deviations).
    """
    names = [*columns, target]
    n, means, products = _moments(train, names)
    covariance = {(a, b): products[i, j] / max(n, 1) for i, a in enumerate(names) for j, b in enumerate(names)}
    weights, unbiased = dict(zip(columns, map(float, model.coefficients))), n / max(n - 1, 1)
    mean = dict(zip(names, means))
    deviation = {c: (covariance[c, c] * unbiased) ** 0.5 or 1.0 for c in columns}
    steepest = max(abs(covariance[c, target]) / deviation[c] for c in columns) or 1.0
    out = []
    for c in columns:
        pull = (covariance[c, target] - sum(w * covariance[c, other] for other, w in weights.items())) / deviation[c]
        penalty = model.getRegParam()
        away = abs(pull - math.copysign(penalty, weights[c])) if weights[c] else max(abs(pull) - penalty, 0.0)
        out.append((c, weights[c], float(mean[c]), float(covariance[c, target]), float(away / steepest)))
    return train.sparkSession.createDataFrame(out, "feature string, weight double, mean double, covariance double, gap double")


def class_weights(train: DataFrame, label: str = "Target_Direction") -> DataFrame:
    """Weight the rarer class up to the size of the other."""
    n = train.agg(F.count_if(F.col(label) == 1.0), F.count_if(F.col(label) == 0.0)).first()
    largest = max(n)
    weight = F.when(F.col(label) == 1.0, largest / max(n[0], 1)).otherwise(largest / max(n[1], 1))
    return train.withColumn("class_weight", weight)


def fit_gbt(train: DataFrame, preset: str = "main", columns: list[str] | None = None,
            spare: int = 0, **overrides) -> GBTClassificationModel:
    """Boosted trees on the direction label; ``spare`` tasks' room is left to other jobs."""
    shared_dir(train.sparkSession)
    # The settings of lineage and node ids are for MLlib's own fit, where that is needed.
    settings = {"cacheNodeIds": False, "checkpointInterval": 10, **TREE_PRESETS[preset],
                "seed": 42, **overrides}
    keep = ["features", "Target_Direction"]
    if preset == "balanced":
        train = class_weights(train)
        settings["weightCol"] = "class_weight"
        keep.append("class_weight")
    columns = columns or (S.SMALL_FEATURES if preset == "small" else S.TREE_FEATURES)
    estimator = GBTClassifier(featuresCol="features", labelCol="Target_Direction", **settings)
    model = fit_boosted(estimator, train, columns, spare)
    return model or estimator.fit(assemble(train, columns).select(*keep))


def predict(model, df: DataFrame, columns: list[str]) -> DataFrame:
    return model.transform(assemble(df, columns, model.getFeaturesCol()))


def fit_both(train: DataFrame, concurrent: bool = True, **tree_overrides) -> dict:
    """Fit Lasso and trees on one cached set, at the same time or in turn.

    Each job runs in its own scheduler pool, so with the FAIR scheduler they
    share the executors. The trees hold their tasks from first to last, so at the same time they leave a quarter of them.
    """
    spark = train.sparkSession

    def timed(pool: str, fit):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        start = perf_counter()
        model = fit()
        return model, perf_counter() - start

    jobs = [("lasso_pool", lambda: fit_lasso(train)),
            ("gbt_pool", lambda: fit_gbt(train, spare=room_of_others(spark) if concurrent else 0, **tree_overrides))]
    begin = perf_counter()
    if concurrent:
        with ThreadPoolExecutor(max_workers=2) as pool:
            waiting = [pool.submit(inheritable_thread_target(spark)(timed), name, fit)
                       for name, fit in jobs]
            results = [w.result() for w in waiting]
    else:
        results = [timed(name, fit) for name, fit in jobs]
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    wall = perf_counter() - begin
    (lasso, lasso_s), (gbt, gbt_s) = results
    return {"lasso": lasso, "gbt": gbt, "lasso_duration": lasso_s, "gbt_duration": gbt_s,
            "total_time": wall}


def save_model(model, path: str, columns: list[str]) -> None:
    """Store a model together with the columns it was trained on."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(columns),)], "columns string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/{FEATURES_META}")


def load_model(spark: SparkSession, kind, path: str, columns: list[str]):
    """Load a model, refusing one that was trained on other columns."""
    stored = json.loads(spark.read.text(f"{path}/{FEATURES_META}").first()[0])
    if stored != list(columns):
        raise ValueError(f"model at {path} was trained on {stored}, not {list(columns)}")
    return kind.load(f"{path}/model")
