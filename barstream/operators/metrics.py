"""Model and run metrics."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barstream.storage import cut_lineage

_CLIP = 2.220446049250313e-16


def regression_metrics(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """MSE, RMSE and R2 in one pass."""
    y, p = F.col(label), F.col(prediction)
    sums = scored.agg(
        F.avg((y - p) * (y - p)).alias("mse"), F.var_pop(label).alias("_spread"))
    return sums.select(
        "mse", F.sqrt("mse").alias("rmse"),
        F.when(F.col("_spread") != 0, 1 - F.col("mse") / F.col("_spread")).alias("r2"))


def accuracy(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return scored.agg(F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"))


def log_loss(scored: DataFrame, label: str, probability: str) -> DataFrame:
    """Mean negative log-likelihood; NaN when only one class is present."""
    y = F.col(label)
    p = F.greatest(F.lit(_CLIP), F.least(F.lit(1 - _CLIP), F.col(probability)))
    loss = -F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))
    return scored.agg(
        F.when(F.min(y) == F.max(y), F.lit(float("nan"))).otherwise(loss).alias("log_loss"))


def roc_auc(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve; NaN when only one class is present.

    Rows are first combined per distinct score.  The evaluator then sorts the
    combined rows by range partitioning; no down-sampling into bins.
    """
    groups = scored.groupBy(F.col(score).cast("double").alias("_score"),
                            F.col(label).cast("double").alias("_label")).agg(
        F.count(F.lit(1)).cast("double").alias("_weight"))
    # Stored once: sorting and counting pass over the groups several times.
    groups = cut_lineage(groups)
    classes = groups.agg(F.min("_label"), F.max("_label")).first()
    area = float("nan")
    if classes[0] != classes[1]:
        area = BinaryClassificationEvaluator(
            rawPredictionCol="_score", labelCol="_label", weightCol="_weight", numBins=0,
        ).evaluate(groups)
    return scored.sparkSession.createDataFrame([(float(area),)], "roc_auc double")


def pair_runs(runs: DataFrame, cores: int) -> DataFrame:
    """Serial and parallel time of each fraction with speedup and efficiency.

    The two modes meet in one grouped pass; fractions lacking a mode drop out,
    as in an inner join.
    """
    def of(mode: str):
        return F.max(F.when(F.col("mode") == mode, F.col("total_time")))

    return (
        runs.groupBy("fraction")
        .agg(of("serial").alias("serial_time_s"), of("parallel").alias("parallel_time_s"))
        .dropna()
        .withColumn("speedup_x", F.col("serial_time_s") / F.col("parallel_time_s"))
        .withColumn("efficiency", F.col("speedup_x") / cores)
        .withColumn("num_cores", F.lit(cores))
    )


def core_scaling(runs: DataFrame) -> DataFrame:
    """Speedup of each core count against the smallest one of the same suite."""
    by_cores = Window.partitionBy("suite").orderBy("cores")
    return runs.withColumn(
        "speedup", F.first("time_s").over(by_cores) / F.col("time_s")
    ).withColumn("efficiency", F.col("speedup") / F.col("cores"))


def overlap_seconds(runs: DataFrame) -> DataFrame:
    """Time saved by running models at once: sum of durations minus wall time."""
    saved = F.col("lasso_duration") + F.col("gbt_duration") - F.col("total_time")
    return runs.withColumn("overlap_seconds", F.greatest(saved, F.lit(0.0)))
