import pytest
from pyspark.sql import functions as F

from barstream.operators import replay, signals
from barstream.params import JobParams


def row_of(spark, **values):
    base = dict(score=0.05, score_raw=0.05, Close=100.0, prev_price=99.0, Volume=10.0, rsi=50.0,
                macd_histogram=0.0, probability_up=None)
    base.update(values)
    kinds = {"probability_up": "double"}
    schema = ", ".join(f"{k} {kinds.get(k, 'double')}" for k in base)
    return spark.createDataFrame([tuple(base.values())], schema)


@pytest.mark.parametrize("probability, score, direction, confidence", [
    (0.555, 0.01, 1.0, 55),
    (0.5, 0.01, 0.0, 50),
    (0.29, 0.01, 0.0, 71),
    (0.57, -0.01, 1.0, 56),     # 0.57 * 100 lies just below 57
    (None, 0.05, 1.0, 50),
    (None, 0.10, 1.0, 70),
    (None, -0.02, 0.0, 20),
    (None, 0.0, 0.0, 0),
])
def test_direction_and_confidence(spark, probability, score, direction, confidence):
    df = row_of(spark, probability_up=probability, score=score)
    got = signals.add_direction(df).first()
    assert (got["direction"], got["confidence"]) == (direction, confidence)
    assert got["stale"] == (probability is None)


@pytest.mark.parametrize("probability, score, threshold, signal, words", [
    (0.6, 0.01, 61, "HOLD", "GBT confidence (60%) below 61% threshold."),
    (0.6, 0.01, 60, "BUY", "Lasso confirms positive"),
    (0.4, -0.01, 0, "SELL", "Lasso confirms negative"),
    (0.6, -0.01, 0, "BUY", "upward"),
    (0.4, 0.01, 0, "SELL", "downward"),
])
def test_signal_rules(spark, probability, score, threshold, signal, words):
    df = signals.add_direction(row_of(spark, probability_up=probability, score=score))
    got = signals.add_reason(signals.add_signal(df, threshold), threshold).first()
    assert got["signal"] == signal and words in got["reason"]


def test_explanation_text(spark):
    df = signals.add_direction(row_of(spark, probability_up=0.8, rsi=71.6, macd_histogram=0.2))
    df = signals.add_texts(signals.add_signal(df))
    assert df.first()["explanation"] == (
        "GBT predicts UP. Lasso baseline: +5.00% expected return. "
        "Technical: overbought (RSI 72), MACD bullish. Action: BUY — "
        "GBT predicts UP and Lasso confirms positive return.")


@pytest.mark.parametrize("volume, price, use_volume, expected", [
    (15_000_001.0, 100.0, True, "VOLUME SPIKE"),
    (15_000_000.0, 100.0, True, "None"),
    (15_000_001.0, 100.0, False, "None"),
    (1.0, 101.5, True, "PRICE SHOCK ($2.50)"),
    (1.0, 101.0, True, "None"),
])
def test_anomaly(spark, volume, price, use_volume, expected):
    df = row_of(spark, Volume=volume, Close=price)
    assert signals.add_anomaly(df, JobParams(use_volume=use_volume)).first()["anomaly"] == expected


def test_score_is_clamped_and_priced(spark):
    df = spark.createDataFrame([(1.0, 100.0), (-9.0, 100.0)], "x double, Close double")
    got = signals.target_price(signals.linear_score(df, [0.5], 0.01, ["x"])).orderBy("x").collect()
    assert [r["score"] for r in got] == [-0.1, 0.1]
    assert [r["target_price"] for r in got] == [90.0, 110.0]


def test_replay_scores(spark):
    rows = [("A", i, c, t, d) for i, (c, t, d) in enumerate(
        [(10.0, 11.0, 1.0), (12.0, 11.0, 0.0), (12.0, 13.0, 1.0), (11.0, 11.0, 1.0)])]
    df = spark.createDataFrame(rows, "symbol string, i int, Close double, target_price double, direction double")
    df = df.withColumn("timestamp", F.timestamp_seconds(F.col("i")))
    got = replay.replay_scores(df).orderBy("i").collect()
    assert [r["lasso_error"] for r in got] == [None, 1.0, 1.0, 2.0]
    assert [r["lasso_mae"] for r in got] == [0.0, 1.0, 1.0, 1.3333]
    # A price that stays put counts as not up.
    assert [r["replay_correct"] for r in got] == [0, 1, 2, 2]
    assert [r["gbt_accuracy"] for r in got] == [0.0, 100.0, 100.0, 66.7]


def test_replay_accuracy_skips_zeros(spark):
    df = spark.createDataFrame([(0.0, 50.0), (2.0, 0.0), (4.0, 60.0)], "lasso_mae double, gbt_accuracy double")
    got = replay.edge_vs_random(replay.replay_accuracy(df)).first()
    assert tuple(got) == (3.0, 55.0, 2, 5.0)
    empty = replay.replay_accuracy(df.limit(0)).first()
    assert tuple(empty) == (0.0, 0.0, 0)
