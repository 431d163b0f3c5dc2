"""Queries for training features, splits, models and their metrics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from barstream import schemas as S
from barstream.functions.numeric import weighted_sum
from barstream.operators import aggregates, features, metrics, models
from barstream.operators.signals import linear_score
from barstream.plans.live import score_history
from barstream.plans.sweep import scaling_sweep, sweep_table
from barstream.plans.training import run_training, stored_features
from barstream.queries import blocks as B
from barstream.queries.shape import shaped, shaped_sql
from barstream.sources import fixtures as X
from barstream.storage import cut_lineage

QUERIES, ORACLE = {}, {}

# The test prices jump at random, so most queries widen the return bound.
WIDE = 10.0


def _bars(spark, sf):
    """Bars and their layout, measured on the rows they are made of."""
    bars = X.bars(spark, sf)
    return bars, features.feature_layout(bars, bound=X.bar_rows(spark, sf))


def _stored(spark, sf):
    bars, layout = _bars(spark, sf)
    return stored_features(bars, layout=layout, max_return=WIDE)


def _rolling(name: str, columns: str) -> None:
    shape = f"symbol timestamp@ {columns}"
    QUERIES[name] = lambda spark, sf: shaped(features.rolling_features(*_bars(spark, sf)), shape)
    ORACLE[name] = shaped_sql(B.FEATURES, "rolling", shape)


_rolling("w1_ma_10", "MA_10~6")
_rolling("w2_ma_30", "MA_30~6")
_rolling("w3_volatility", "Volatility~5")
_rolling("w4_vol_ma_10", "Vol_MA_10~6")
_rolling("w5_momentum_1", "Momentum_1~7")
_rolling("w6_momentum_5", "Momentum_5~7")
_rolling("w7_close_norm", "Close_norm~6")
_rolling("w8_volume_norm", "Volume_norm~6")
_rolling("w9_ma_ratio", "MA_ratio_10_30~7")


def _train(name: str, columns: str, max_return: float) -> None:
    shape = f"symbol timestamp@ {columns}"
    QUERIES[name] = lambda spark, sf: shaped(
        features.train_features(*_bars(spark, sf), max_return=max_return), shape)
    ORACLE[name] = shaped_sql(B.training(max_return), "train", shape)


_train("w10_target_return", "Target_Return~7", WIDE)
_train("w11_target_direction", "Target_Direction~1", WIDE)
_train("w12_split_rank", "Split_Rank~8", WIDE)
_train("train_features", "MA_10~6 MA_30~6 Volatility~5 Vol_MA_10~6 Momentum_1~7 Momentum_5~7 "
       "Close_norm~6 Volume_norm~6 MA_ratio_10_30~7 Target_Return~8 Target_Direction~1 "
       "Split_Rank~8", S.MAX_ABS_TARGET_RETURN)


def w13_target_price(spark, sf):
    return shaped(features.price_features(*_bars(spark, sf)),
                  "symbol timestamp@ MA_10~6 Target_Price Target_Direction~1")


ORACLE["w13_target_price"] = shaped_sql(
    B.FEATURES + """, priced AS (SELECT *, "Next_Close" AS "Target_Price",
  CASE WHEN "Next_Close" > "Close" THEN 1.0 ELSE 0.0 END AS "Target_Direction" FROM rolling
  WHERE "Next_Close" IS NOT NULL AND "Volatility" IS NOT NULL)""",
    "priced", "symbol timestamp@ MA_10~6 Target_Price Target_Direction~1")


def f2_time_split(spark, sf):
    train, test = features.time_split(
        features.train_features(*_bars(spark, sf), max_return=WIDE))
    both = train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test")))
    return shaped(both, "symbol timestamp@ side")


ORACLE["f2_time_split"] = shaped_sql(
    B.training(WIDE) + """, sides AS (SELECT *,
  CASE WHEN "Split_Rank" < 0.8 THEN 'train' ELSE 'test' END AS side FROM train)""",
    "sides", "symbol timestamp@ side")

# Fixed linear scores over training features make the metrics comparable.
_RETURN_WEIGHTS = [0.05, -0.02, 0.1, 0.0, 0.01, -0.005, 0.001]


def _fixed_score(spark, sf):
    df = features.train_features(*_bars(spark, sf), max_return=WIDE)
    return df.withColumn("prediction", weighted_sum(S.LASSO_FEATURES, _RETURN_WEIGHTS, -0.1))


_FIXED = B.training(WIDE) + """, fixed AS (SELECT *, "Close_norm" * 0.05 + "Volume_norm" * -0.02
  + "MA_ratio_10_30" * 0.1 + "Momentum_1" * 0.01 + "Momentum_5" * -0.005 + "Vol_MA_10" * 0.001
  - 0.1 AS prediction FROM train),
probs AS (SELECT "Target_Direction" AS y, round(1 / (1 + exp(-prediction)), 3) AS p FROM fixed)"""


def _probabilities(spark, sf):
    return _fixed_score(spark, sf).select(
        F.col("Target_Direction").alias("y"),
        F.round(1 / (1 + F.exp(-F.col("prediction"))), 3).alias("p"))


def a4_score_checksum(spark, sf):
    return shaped(aggregates.score_checksum(_fixed_score(spark, sf)), "checksum~4")


ORACLE["a4_score_checksum"] = shaped_sql(
    _FIXED + ", sums AS (SELECT sum(prediction) AS checksum FROM fixed)", "sums", "checksum~4")


def a8_regression_metrics(spark, sf):
    return shaped(metrics.regression_metrics(_fixed_score(spark, sf), "Target_Return"),
                  "mse~6 rmse~6 r2~6")


ORACLE["a8_regression_metrics"] = shaped_sql(
    _FIXED + """, errs AS (SELECT avg(("Target_Return" - prediction) ** 2) AS mse,
  var_pop("Target_Return") AS spread FROM fixed),
fit AS (SELECT mse, sqrt(mse) AS rmse, 1 - mse / spread AS r2 FROM errs)""",
    "fit", "mse~6 rmse~6 r2~6")


def a9_accuracy(spark, sf):
    calls = _probabilities(spark, sf).withColumn(
        "prediction", F.when(F.col("p") > 0.5, 1.0).otherwise(0.0))
    return shaped(metrics.accuracy(calls, "y"), "accuracy~8")


ORACLE["a9_accuracy"] = shaped_sql(
    _FIXED + """, hits AS (SELECT avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END)
  AS accuracy FROM probs)""", "hits", "accuracy~8")


def a10_roc_auc(spark, sf):
    return shaped(metrics.roc_auc(_probabilities(spark, sf), "y", "p"), "roc_auc~8")


ORACLE["a10_roc_auc"] = shaped_sql(
    _FIXED + """, ranks AS (SELECT y, rank() OVER (ORDER BY p)
  + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM probs),
area AS (SELECT (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0)
  / (CAST(count(*) FILTER (y = 1) AS DOUBLE) * count(*) FILTER (y = 0)) AS roc_auc FROM ranks)""",
    "area", "roc_auc~8")


def a11_log_loss(spark, sf):
    return shaped(metrics.log_loss(_probabilities(spark, sf), "y", "p"), "log_loss~8")


ORACLE["a11_log_loss"] = shaped_sql(
    _FIXED + """, clipped AS (SELECT y, greatest(2.220446049250313e-16,
  least(1 - 2.220446049250313e-16, p)) AS p FROM probs),
loss AS (SELECT -avg(y * ln(p) + (1 - y) * ln(1 - p)) AS log_loss FROM clipped)""",
    "loss", "log_loss~8")

_WIDE_WEIGHTS = [1e-5, -2e-5, 3e-5, 1e-5, 2e-4, -1e-5, 1e-5, 2e-5, 1e-3, 0.1, -0.1, 0.5, -0.5, 1.0]


def m13_wide_score(spark, sf):
    df = features.rolling_features(*_bars(spark, sf))
    scored = linear_score(df, _WIDE_WEIGHTS, 0.5, S.TREE_FEATURES, limit=None)
    return shaped(scored.filter(F.col("Volatility").isNotNull()), "symbol timestamp@ score~6")


ORACLE["m13_wide_score"] = shaped_sql(
    B.FEATURES + ", wide AS (SELECT *, 0.5 + "
    + " + ".join(f'"{c}" * {w!r}' for c, w in zip(S.TREE_FEATURES, _WIDE_WEIGHTS))
    + ' AS score FROM rolling WHERE "Volatility" IS NOT NULL)',
    "wide", "symbol timestamp@ score~6")


def m14_score_history(spark, sf):
    """Linear model on raw columns, applied to the whole history, summed up."""
    columns = ["Open", "High", "Low", "Close", "Volume", "MA_10", "Volatility"]
    bars, layout = _bars(spark, sf)
    train = features.price_features(bars, layout)
    from pyspark.ml.regression import LinearRegression

    ready = models.assemble(train, columns).select("features", "Target_Price")
    model = LinearRegression(labelCol="Target_Price", **models.LASSO_PRICE).fit(ready)
    return aggregates.score_checksum(score_history(bars, model, columns))


def f1_assemble(spark, sf):
    """Vectors of rows without a gap: their length and the sum of their elements."""
    vectors = models.assemble(features.rolling_features(*_bars(spark, sf)), S.TREE_FEATURES)
    elements = vector_to_array("features")
    return shaped(vectors.select(
        "symbol", "timestamp", F.size(elements).alias("length"),
        F.aggregate(elements, F.lit(0.0), lambda total, x: total + x).alias("total")),
        "symbol timestamp@ length# total~4")


ORACLE["f1_assemble"] = shaped_sql(
    B.FEATURES + ", vectors AS (SELECT symbol, \"timestamp\", 14 AS length, "
    + " + ".join(f'"{c}"' for c in S.TREE_FEATURES)
    + ' AS total FROM rolling WHERE "Volatility" IS NOT NULL)',
    "vectors", "symbol timestamp@ length# total~4")


def f3_random_split(spark, sf):
    train, test = models.random_split(X.bars(spark, sf))
    both = train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test")))
    return shaped(both, "symbol timestamp@ side")


_DRAW = """substr(md5(symbol || '|' || CAST("timestamp" AS VARCHAR) || '|{}'), 1, 13)"""
ORACLE["f3_random_split"] = shaped_sql(
    B.BARS + f""", sides AS (SELECT *, CASE WHEN {_DRAW.format(42)} < '{int(S.TRAIN_SHARE * 16 ** 13):013x}' THEN 'train' ELSE 'test' END AS side
  FROM bars)""", "sides", "symbol timestamp@ side")


def f4_sample_train(spark, sf):
    return shaped(models.sample_train(X.bars(spark, sf), 0.75), "symbol timestamp@ Close~4")


ORACLE["f4_sample_train"] = shaped_sql(
    B.BARS + f""", drawn AS (SELECT * FROM bars WHERE {_DRAW.format(43)} < '{int(0.75 * 16 ** 13):013x}')""",
    "drawn", "symbol timestamp@ Close~4")


def _features(spark, sf):
    return features.time_split(_stored(spark, sf))


def f6_lasso_return(spark, sf):
    train, test = _features(spark, sf)
    scored = models.predict(models.fit_lasso(train), test, S.LASSO_FEATURES)
    return metrics.regression_metrics(scored, "Target_Return")


def f7_lasso_price(spark, sf):
    # Stored once: fitting and judging would each compute the windows.
    train, test = models.random_split(cut_lineage(features.price_features(*_bars(spark, sf))))
    scored = models.predict(models.fit_lasso(train, price=True), test, S.SMALL_FEATURES)
    return metrics.regression_metrics(scored, "Target_Price")


GAP = 0.01


def _certified(certificate):
    return shaped(certificate.withColumn("certified", (F.col("gap") <= GAP).cast("int")), "feature mean~5 covariance~5 certified#")


def _certificate_sql(ctes: str, source: str, columns: list[str], target: str) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, avg("{c}") AS mean, covar_pop("{c}", "{target}") AS covariance, 1 AS certified FROM {source}""" for c in columns)
    return shaped_sql(f"{ctes}, rows AS ({rows})", "rows", "feature mean~5 covariance~5 certified#")


def f6_lasso_certificate(spark, sf):
    """The next-return regression with the moments it was fitted on and proof of its optimality per feature."""
    train = _stored(spark, sf)
    return _certified(models.lasso_certificate(train, models.fit_lasso(train), S.LASSO_FEATURES, "Target_Return"))


ORACLE["f6_lasso_certificate"] = _certificate_sql(B.training(WIDE), "train", S.LASSO_FEATURES, "Target_Return")


def f7_lasso_certificate(spark, sf):
    """The next-price regression likewise."""
    train = cut_lineage(features.price_features(*_bars(spark, sf)))
    return _certified(models.lasso_certificate(train, models.fit_lasso(train, price=True, maxIter=500, tol=1e-12), S.SMALL_FEATURES, "Target_Price"))


ORACLE["f7_lasso_certificate"] = _certificate_sql(
    B.FEATURES + """, priced AS (SELECT *, "Next_Close" AS "Target_Price" FROM rolling
  WHERE "Next_Close" IS NOT NULL AND "Volatility" IS NOT NULL)""", "priced", S.SMALL_FEATURES, "Target_Price")


def m14_given_weights(spark, sf):
    """A linear model given by its weights, over the whole history: checksum per symbol."""
    columns = ["Open", "High", "Low", "Close", "Volume", "MA_10", "Volatility"]
    scored = score_history(X.bars(spark, sf), ([0.2, -0.1, 0.05, 0.6, 0.001, 0.25, 1.5], -3.0), columns)
    return shaped(scored.groupBy("symbol").agg(F.sum("prediction").alias("checksum")), "symbol checksum~3")


ORACLE["m14_given_weights"] = shaped_sql(
    B.BARS + """, sums AS (SELECT symbol, sum("Open" * 0.2 - "High" * 0.1 + "Low" * 0.05 + "Close" * 0.6 + "Volume" * 0.001
  + "Close" * 0.25 + 1.5 - 3.0) AS checksum FROM bars GROUP BY 1)""", "sums", "symbol checksum~3")


def _trees(preset: str, **overrides):
    """Fit a preset and report accuracy per direction."""
    def run(spark, sf):
        train, test = _features(spark, sf)
        columns = S.SMALL_FEATURES if preset == "small" else S.TREE_FEATURES
        model = models.fit_gbt(train, preset, **overrides)
        scored = models.predict(model, test, columns)
        return scored.groupBy("Target_Direction").agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg((F.col("prediction") == F.col("Target_Direction")).cast("double"))
            .alias("accuracy"))
    return run


def f13_train_both(spark, sf):
    """Both models at once, with the one-row report of the job."""
    return run_training(X.bars(spark, sf), stored=_stored(spark, sf))["report"]


def f15_scaling_sweep(spark, sf):
    reports = scaling_sweep(X.bars(spark, sf), max_return=WIDE)
    return sweep_table(reports, spark.sparkContext.defaultParallelism)


QUERIES.update({f.__name__: f for f in (
    w13_target_price, f2_time_split, a4_score_checksum, a8_regression_metrics, a9_accuracy,
    a10_roc_auc, a11_log_loss, m13_wide_score, m14_score_history, f1_assemble, f3_random_split,
    f4_sample_train, f6_lasso_certificate, f7_lasso_certificate, m14_given_weights, f6_lasso_return, f7_lasso_price, f13_train_both, f15_scaling_sweep)})
QUERIES["f8_gbt_main"] = _trees("main")
QUERIES["f9_gbt_small"] = _trees("small")
QUERIES["f10_gbt_balanced"] = _trees("balanced")
QUERIES["f11_gbt_leaves_31"] = _trees("leaves_31")
QUERIES["f11_gbt_leaves_255"] = _trees("leaves_255")
