"""Live job over stored bars: indicators, scores, replay accuracy, ledger, record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.functions.numeric import weighted_sum
from barstream.operators.aggregates import batch_throughput
from barstream.operators.indicators import (
    add_macd, live_features, live_layout, window_indicators,
)
from barstream.operators.portfolio import account_layout, paper_trade
from barstream.operators.replay import add_replay
from barstream.operators.signals import (
    add_scores, add_texts, score_signals, signal_record,
)
from barstream.operators.series import MAX_BROADCAST_SPANS
from barstream.params import JobParams
from barstream.storage import cut_lineage


def scored_bars(bars: DataFrame, weights: Sequence[float], intercept: float,
                params: JobParams = JobParams(), tree_model=None, **layout_options) -> DataFrame:
    layout = live_layout(bars, params, **layout_options)
    return score_signals(live_features(bars, params, layout), weights, intercept, params, tree_model)


def replayed_bars(bars: DataFrame, weights: Sequence[float], intercept: float,
                  params: JobParams = JobParams(), tree_model=None, **layout_options) -> DataFrame:
    """Scored bars with replay accuracy; texts are left to the caller.

    Indicators, scores and replay windows share one layout and one window
    definition, hence one shuffle; MACD comes last because it leaves the JVM.
    """
    layout = live_layout(bars, params, further=params.replay_errors, **layout_options)
    df = window_indicators(layout.spread(bars), layout, params)
    df = add_scores(df, weights, intercept, params, tree_model)
    df = add_replay(df, layout, params)
    return layout.settle(add_macd(df, layout, params))


def signal_records(bars: DataFrame, weights: Sequence[float], intercept: float,
                   params: JobParams = JobParams(), tree_model=None,
                   account: Column | None = None, bound: DataFrame | None = None) -> DataFrame:
    """Published records; ``account`` names the account each symbol is traded in. ``bound`` has at least as many rows
    of every symbol as the bars (see ``measure_series``)."""
    df = replayed_bars(bars, weights, intercept, params, tree_model, bound=bound)
    if account is not None:
        account = account.cast("string")
        # Accounts are measured on the bars, which is cheaper than on the scored rows.
        layout = account_layout(bars.withColumn("portfolio_id", account),
                                bound=None if bound is None else bound.withColumn("portfolio_id", account))
        df = paper_trade(df.withColumn("portfolio_id", account), params, layout=layout)
    # Bars of one time are a batch, as one micro-batch is in the stream.
    # One row a time, counted first: few are broadcast, or the records would all be shuffled by time.
    batches = cut_lineage(batch_throughput(bars))
    if batches.count() <= MAX_BROADCAST_SPANS:
        batches = F.broadcast(batches)
    return signal_record(add_texts(df.join(batches, "timestamp", "left"), params))


def score_history(bars: DataFrame, model, columns: list[str]) -> DataFrame:
    """Plain linear scoring of stored bars, as the scoring benchmark does it:
    MA_10 stands in by Close and Volatility by 1.  ``model`` is a fitted one, or its weights and intercept."""
    from barstream.operators.models import predict

    ready = bars.select(
        *([] if not isinstance(model, tuple) else ["symbol"]), *[F.col(c).cast("double").alias(c) for c in ("Open", "High", "Low", "Close", "Volume")],
        F.col("Close").cast("double").alias("MA_10"), F.lit(1.0).alias("Volatility"))
    if isinstance(model, tuple):
        return ready.withColumn("prediction", weighted_sum(columns, *model))
    return predict(model, ready, columns)
