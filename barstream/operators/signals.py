"""Scoring, signals, notes and anomalies: projections over live features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream import schemas as S
from barstream.functions.numeric import clamp, present, truncate, weighted_sum
from barstream.params import JobParams

# --- fixed values: input order of the live linear model ---------------------
LIVE_LINEAR_INPUTS = ["close_norm", "volume_norm", "ma_ratio", "volatility",
                      "momentum_1", "momentum_5", "vol_ma_10"]
# --- fixed values: live column behind each tree-model feature ---------------
LIVE_TREE_INPUTS = {
    "Open": "Open", "High": "High", "Low": "Low", "Close": "Close", "Volume": "Volume",
    "MA_10": "ma_10", "MA_30": "ma_30", "Volatility": "volatility", "Vol_MA_10": "vol_ma_10",
    "Momentum_1": "momentum_1", "Momentum_5": "momentum_5",
    "Close_norm": "close_norm", "Volume_norm": "volume_norm", "MA_ratio_10_30": "ma_ratio",
}


def linear_score(df: DataFrame, weights: Sequence[float], intercept: float,
                 inputs: Sequence[str] = LIVE_LINEAR_INPUTS,
                 limit: float | None = S.MAX_LIVE_RETURN) -> DataFrame:
    """Raw and clamped linear score."""
    raw = weighted_sum(list(inputs), list(weights), intercept)
    df = df.withColumn("score_raw", raw)
    raw = F.col("score_raw")
    score = F.when(present(raw), raw) if limit is None else clamp(raw, limit)
    return df.withColumn("score", score)


def target_price(df: DataFrame) -> DataFrame:
    return df.withColumn("target_price", F.round(F.col("Close") * (1 + F.col("score")), 2))


def tree_score(df: DataFrame, model) -> DataFrame:
    """P(up) and direction from a fitted tree classifier (row-wise, JVM side).

    ``model`` reads the vector column it was trained on, assembled here from the
    live columns.  A bar with a missing input keeps its row and gets no probability,
    so it falls back to the linear score.
    """
    from barstream.operators.models import assemble

    renamed = df.select("*", *[F.col(src).alias(f"_tree_{name}")
                               for name, src in LIVE_TREE_INPUTS.items()])
    inputs = [f"_tree_{name}" for name in S.TREE_FEATURES]
    whole = reduce(Column.__and__, [present(F.col(c).cast("double")) for c in inputs])
    renamed = renamed.withColumn("_tree_whole", whole)
    vectors = assemble(renamed, inputs, model.getFeaturesCol(), missing="keep").drop(*inputs)
    scored = model.transform(vectors)
    return scored.withColumn(
        "probability_up",
        F.when(F.col("_tree_whole"), vector_to_array(F.col(model.getProbabilityCol()))[1])
    ).drop(model.getFeaturesCol(), model.getProbabilityCol(),
           model.getRawPredictionCol(), model.getPredictionCol(), "_tree_whole")


def add_direction(df: DataFrame) -> DataFrame:
    """Direction (1 up, 0 down), fallback from the linear score, and confidence.

    Without a score there is no direction and no confidence.
    """
    p = F.col("probability_up") if "probability_up" in df.columns else F.lit(None).cast("double")
    df = df.withColumn("probability_up", F.when(present(p), p))
    p, score = F.col("probability_up"), F.col("score")
    up = F.when(present(score), F.when(p.isNull(), score > 0).otherwise(p > 0.5))
    df = df.withColumns({"direction": F.when(up, F.lit(1.0)).when(~up, F.lit(0.0)),
                         "stale": p.isNull()})
    chosen = F.when(F.col("direction") == 1.0, p).otherwise(1.0 - p)
    fallback = F.least(F.lit(70.0), F.abs(score) * 1000)
    return df.withColumn(
        "confidence",
        F.when(F.col("direction").isNull(), F.lit(0))
        .when(p.isNull(), truncate(fallback)).otherwise(truncate(chosen * 100)))


def _side(direction: Column) -> Column:
    return F.when(direction == 1.0, "UP").when(direction == 0.0, "DOWN").otherwise("FLAT")


def _rules(threshold: int) -> list[tuple[Column, str, Column]]:
    """Condition, signal, reason; the first rule that matches wins."""
    up, score = F.col("direction") == 1.0, F.col("score")
    down = F.col("direction") == 0.0
    weak = F.col("confidence") < threshold
    below = F.format_string(S.REASON_BELOW_THRESHOLD, F.col("confidence"), F.lit(threshold))
    return [
        (weak, "HOLD", below),
        (up & (score > 0), "BUY", F.lit(S.REASON_BUY_CONFIRMED)),
        (down & (score < 0), "SELL", F.lit(S.REASON_SELL_CONFIRMED)),
        (up, "BUY", F.lit(S.REASON_BUY)),
        (down, "SELL", F.lit(S.REASON_SELL)),
    ]


def add_signal(df: DataFrame, threshold: int = 0) -> DataFrame:
    chain = F
    for condition, signal, _ in _rules(threshold):
        chain = chain.when(condition, F.lit(signal))
    return df.withColumn("signal", chain.otherwise(F.lit("HOLD")))


def add_reason(df: DataFrame, threshold: int = 0) -> DataFrame:
    chain = F
    for condition, _, reason in _rules(threshold):
        chain = chain.when(condition, reason)
    return df.withColumn("reason", chain.otherwise(F.lit(S.REASON_HOLD)))


def add_explanation(df: DataFrame, params: JobParams = JobParams()) -> DataFrame:
    rsi, histogram = F.col("rsi"), F.col("macd_histogram")
    notes = []
    if params.use_rsi:
        notes.append(F.when(rsi > 70, F.format_string(S.NOTE_OVERBOUGHT, rsi))
                     .when(rsi < 30, F.format_string(S.NOTE_OVERSOLD, rsi)))
    if params.use_macd:
        notes.append(F.when(histogram > 0.1, F.lit(S.NOTE_BULLISH))
                     .when(histogram < -0.1, F.lit(S.NOTE_BEARISH)))
    joined = F.concat_ws(", ", *notes) if notes else F.lit("")
    technical = F.when(joined != "", F.format_string(" Technical: %s.", joined)).otherwise("")
    side = _side(F.col("direction"))
    text = F.format_string(
        "GBT predicts %s. Lasso baseline: %+.2f%% expected return.%s Action: %s — %s",
        side, F.col("score") * 100, technical, F.col("signal"), F.col("reason"))
    return df.withColumn("explanation", text)


def add_anomaly(df: DataFrame, params: JobParams = JobParams()) -> DataFrame:
    """Volume spike first, then price shock, else None."""
    jump = F.abs(F.col("Close") - F.col("prev_price"))
    shock = F.when(jump > params.shock_threshold,
                   F.format_string(S.ANOMALY_SHOCK, jump)).otherwise(S.ANOMALY_NONE)
    if not params.use_volume:
        return df.withColumn("anomaly", shock)
    spike = F.col("Volume") > params.volume_threshold
    return df.withColumn("anomaly", F.when(spike, F.lit(S.ANOMALY_VOLUME)).otherwise(shock))


def add_scores(df: DataFrame, weights: Sequence[float], intercept: float,
               params: JobParams = JobParams(), tree_model=None) -> DataFrame:
    """Scores, direction, confidence and signal: all that later steps compute with."""
    df = linear_score(df, weights, intercept, limit=params.max_live_return)
    df = target_price(df)
    if tree_model is not None:
        df = tree_score(df, tree_model)
    return add_signal(add_direction(df), params.min_ai_confidence)


def add_texts(df: DataFrame, params: JobParams = JobParams()) -> DataFrame:
    """Reason, explanation and anomaly; added last, as texts are costly to move."""
    df = add_reason(df, params.min_ai_confidence)
    return add_anomaly(add_explanation(df, params), params)


def score_signals(features: DataFrame, weights: Sequence[float], intercept: float,
                  params: JobParams = JobParams(), tree_model=None) -> DataFrame:
    """Live features to scored signals; one projection chain, no shuffle."""
    return add_texts(add_scores(features, weights, intercept, params, tree_model), params)


def signal_record(df: DataFrame) -> DataFrame:
    """The published record: names and roundings.

    Columns of later steps (replay scoring, ledger, throughput) are used when
    present and take their neutral value otherwise.  With a ledger, the last record of an
    account's batch has its open positions; the other records of the batch have none (null).
    """
    def have(name: str, default) -> Column:
        return F.col(name) if name in df.columns else F.lit(default)

    side = _side(F.col("direction"))
    ledger = ["portfolio_id"] if "portfolio_id" in df.columns else []
    positions = (F.col("positions") if "positions" in df.columns
                 else F.create_map().cast("map<string,bigint>"))
    return df.select(
        *ledger, "symbol", "timestamp",
        F.round("Close", 2).alias("price"),
        F.col("Volume").cast("double").alias("volume"),
        F.round("sma", 2).alias("sma_20"),
        F.round(F.col("momentum_1") * 100, 2).alias("momentum"),
        "signal",
        F.col("target_price").alias("lasso_target"),
        F.round(F.col("score") * 100, 4).alias("lasso_return"),
        F.round(F.col("score_raw") * 100, 4).alias("lasso_return_raw"),
        side.alias("gbt_direction"),
        F.coalesce(F.round(F.col("probability_up") * 100, 2), F.lit(0.0)).alias("gbt_probability"),
        F.col("stale").alias("gbt_stale"),
        "confidence", "explanation",
        F.coalesce(have("throughput", 0), F.lit(0)).cast("int").alias("throughput"),
        F.round(have("portfolio_value", 0.0), 2).alias("portfolio_value"),
        F.round(have("cash", 0.0), 2).alias("cash"),
        positions.alias("positions"),
        "anomaly",
        have("trade_executed", S.TRADE_NONE).alias("trade_executed"),
        have("shares_traded", 0).cast("int").alias("shares_traded"),
        F.round("rsi", 2).alias("rsi"),
        F.round("macd_line", 4).alias("macd_line"),
        F.round("macd_signal", 4).alias("macd_signal"),
        F.round("macd_histogram", 4).alias("macd_histogram"),
        F.round(have("lasso_mae", 0.0), 4).alias("lasso_mae"),
        F.round(have("gbt_accuracy", 0.0), 1).alias("gbt_accuracy"),
        F.round(F.coalesce(have("lasso_error", 0.0), F.lit(0.0)), 4).alias("lasso_error"),
    )


def attach_predictions(df: DataFrame, predictions: DataFrame) -> DataFrame:
    """Classifier result per bar where there is one.

    Joined on symbol and time, so a hot symbol spreads over all tasks; bars
    without a result keep a null and fall back to the linear score.
    """
    found = predictions.select("symbol", "timestamp", "probability_up")
    return df.join(found, ["symbol", "timestamp"], "left")
