"""Replay accuracy: how the previous prediction of a symbol turned out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.operators.series import SeriesLayout, measure_series
from barstream.params import JobParams


def replay_layout(scored: DataFrame, params: JobParams = JobParams(), **options) -> SeriesLayout:
    return measure_series(scored, back=params.replay_errors, **options)


def add_replay(df: DataFrame, layout: SeriesLayout, params: JobParams) -> DataFrame:
    """Error, mean error of the last ``replay_errors`` and running hit rate, over
    rows already spread by ``layout``.

    The previous prediction is the previous row of the symbol, so no join is
    needed.  A price that did not move counts as "not up".
    """
    w = layout.window()
    df = df.withColumns({
        "_target": F.lag("target_price").over(w),
        "_direction": F.lag("direction").over(w),
        "_price": F.lag("Close").over(w),
    })
    df = df.withColumn("lasso_error", F.abs(F.col("_target") - F.col("Close")))
    recent = w.rowsBetween(-(params.replay_errors - 1), 0)
    df = df.withColumn("lasso_mae", F.coalesce(
        F.round(F.avg("lasso_error").over(recent), 4), F.lit(0.0)))
    known = F.col("_target").isNotNull()
    hit = (F.col("_direction") == 1.0) == (F.col("Close") > F.col("_price"))
    df = layout.with_running_sums(df, {
        "replay_total": known.cast("long"),
        "replay_correct": (known & hit).cast("long"),
    })
    rate = F.when(F.col("replay_total") > 0,
                  F.round(F.col("replay_correct") / F.col("replay_total") * 100, 1))
    return df.withColumn("gbt_accuracy", F.coalesce(rate, F.lit(0.0))).drop(
        "_target", "_direction", "_price")


def replay_scores(scored: DataFrame, params: JobParams = JobParams(),
                  layout: SeriesLayout | None = None) -> DataFrame:
    layout = layout or replay_layout(scored, params)
    return layout.settle(add_replay(layout.spread(scored), layout, params))


def replay_accuracy(state: DataFrame) -> DataFrame:
    """Cross-symbol summary of the latest state; symbols still at 0 do not count."""
    mae, rate = F.col("lasso_mae"), F.col("gbt_accuracy")
    return state.agg(
        F.coalesce(F.round(F.avg(F.when(mae > 0, mae)), 4), F.lit(0.0)).alias("avg_lasso_mae"),
        F.coalesce(F.round(F.avg(F.when(rate > 0, rate)), 1), F.lit(0.0)).alias("avg_gbt_accuracy"),
        F.count_if(mae > 0).alias("symbols_scored"),
    )


def edge_vs_random(accuracy: DataFrame) -> DataFrame:
    return accuracy.withColumn("edge_vs_random", F.round(F.col("avg_gbt_accuracy") - 50.0, 1))
