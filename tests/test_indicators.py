import numpy as np
import pytest
from pyspark.sql import functions as F

from barstream.operators import aggregates, indicators
from barstream.params import JobParams


def bars_of(spark, closes, volumes=None, symbol="A"):
    volumes = volumes or [100.0] * len(closes)
    rows = [(symbol, i, float(c), float(v)) for i, (c, v) in enumerate(zip(closes, volumes))]
    df = spark.createDataFrame(rows, "symbol string, i int, Close double, Volume double")
    return df.withColumn("timestamp", F.timestamp_seconds(F.col("i") * 60)).withColumns(
        {c: F.col("Close") for c in ("Open", "High", "Low")})


def live(spark, closes, volumes=None, params=JobParams()):
    return indicators.live_features(bars_of(spark, closes, volumes), params).orderBy("i").collect()


@pytest.mark.parametrize("closes, expected", [
    (list(range(1, 15)), 50.0),          # one close short
    (list(range(1, 16)), 100.0),         # only gains
    ([5.0] * 15, 50.0),                  # no change at all
    (list(range(30, 15, -1)), 0.0),      # only losses
])
def test_rsi_edges(spark, closes, expected):
    assert live(spark, closes)[-1]["rsi"] == expected


def step_by_step(closes, volumes, p):
    """The indicators computed one tick at a time from full lists."""
    out, fast, slow, sig = [], None, None, None
    for i in range(len(closes)):
        seen, vols = closes[:i + 1], volumes[:i + 1]
        price, prev = closes[i], closes[i - 1] if i else p.base_price
        row = {"sma": np.mean(seen[-p.sma_window:]), "ma_10": np.mean(seen[-10:]),
               "ma_30": np.mean(seen[-30:]), "vol_ma_10": np.mean(vols[-10:]),
               "momentum_1": (price - prev) / prev if prev else 0.0,
               "momentum_5": (price - seen[-6]) / seen[-6] if i >= 5 and seen[-6] else 0.0,
               "close_norm": (price - np.mean(seen[-30:])) / (np.std(seen[-30:]) + 1e-8),
               "volume_norm": (vols[-1] - np.mean(vols[-10:])) / (np.std(vols[-10:]) + 1e-8)}
        row["ma_ratio"] = row["ma_10"] / row["ma_30"] if row["ma_30"] else 1.0
        if i < p.rsi_window:
            row["rsi"] = 50.0
        else:
            d = np.diff(seen[-p.rsi_window - 1:])
            g, l = max(d[0], 0), max(-d[0], 0)
            for x in d[1:]:
                g = (g * (p.rsi_window - 1) + max(x, 0)) / p.rsi_window
                l = (l * (p.rsi_window - 1) + max(-x, 0)) / p.rsi_window
            row["rsi"] = (100.0 if g > 0 else 50.0) if l == 0 else 100 - 100 / (1 + g / l)
        def ema(old, x, n):
            return x if old is None else x * 2 / (n + 1) + old * (1 - 2 / (n + 1))
        fast, slow = ema(fast, price, 12), ema(slow, price, 26)
        sig = ema(sig, fast - slow, 9)
        row.update(macd_line=fast - slow, macd_signal=sig, macd_histogram=fast - slow - sig)
        out.append(row)
    return out


def test_all_indicators_against_step_by_step(spark):
    rng = np.random.default_rng(7)
    closes = [float(x) for x in np.round(rng.normal(100, 10, 120), 2)]
    closes[40:60] = [55.0] * 20
    volumes = [float(x) for x in rng.integers(0, 50, 120)]
    params = JobParams(sma_window=17)
    for got, want in zip(live(spark, closes, volumes, params),
                         step_by_step(closes, volumes, params)):
        for name, value in want.items():
            # A flat stretch divides rounding noise by 1e-8, hence the looser bound.
            bound = 1e-5 if name in ("close_norm", "volume_norm") else 1e-9
            assert got[name] == pytest.approx(value, rel=bound, abs=bound), (got["i"], name)


def test_macd_crosses_batches(spark):
    """Arrow batches smaller than a series carry the averages over."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    closes = [float((i * 37) % 101 + 1) for i in range(90)]
    both = bars_of(spark, closes).unionByName(bars_of(spark, closes[::-1], symbol="B"))
    try:
        spark.conf.set(key, "7")
        small = indicators.macd(both).orderBy("symbol", "i").collect()
    finally:
        spark.conf.set(key, before)
    whole = indicators.macd(both).orderBy("symbol", "i").collect()
    for a, b in zip(small, whole):
        assert a["macd_signal"] == pytest.approx(b["macd_signal"], abs=1e-12)
    assert (whole[0]["macd_line"], whole[0]["macd_signal"], whole[0]["macd_histogram"]) == (0, 0, 0)


def test_toggles(spark):
    row = live(spark, range(1, 40), params=JobParams(use_rsi=False, use_macd=False))[-1]
    assert (row["rsi"], row["macd_line"], row["macd_signal"]) == (50.0, 0.0, 0.0)


def test_first_tick_uses_base_price(spark):
    row = live(spark, [150.0])[0]
    assert row["prev_price"] == 100.0 and row["momentum_1"] == pytest.approx(0.5)
    assert row["close_norm"] == 0.0 and row["volume_norm"] == 0.0
    free = live(spark, [150.0], params=JobParams(base_price=None))[0]
    assert free["momentum_1"] == 0.0


def test_batch_deviation_defaults_to_one(spark):
    ticks = spark.createDataFrame(
        [("A", 5.0), ("B", 5.0), ("B", 5.0), ("C", 1.0), ("C", 3.0)], "Symbol string, Close double"
    ).withColumns({c: F.col("Close") for c in ("Open", "High", "Low", "Volume")})
    got = {r["symbol"]: r["volatility"] for r in aggregates.batch_bars(ticks).collect()}
    assert got["A"] == 1.0 and got["B"] == 1.0 and got["C"] == pytest.approx(2 ** 0.5)


def test_partition_count_does_not_matter(spark, skewed):
    sums = set()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = indicators.live_features(skewed.drop("replica").dropDuplicates(["symbol", "timestamp"])
                                          .withColumn("Close", F.col("Volume").cast("double")))
            sums.add(df.agg(F.sum(F.xxhash64(F.round("rsi", 6), F.round("macd_signal", 6))
                                  .cast("decimal(38,0)"))).first()[0])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(sums) == 1


def scanned(closes, spans=(12, 26, 9)):
    """Averages one price at a time; a missing price leaves them as they are."""
    out, state = [], None
    shares = [2 / (n + 1) for n in spans]
    for x in closes:
        if x is not None and x == x:
            f, s, g = state or (x, x, 0.0)
            f, s = f + shares[0] * (x - f), s + shares[1] * (x - s)
            state = (f, s, g + shares[2] * (f - s - g))
        out.append(state and (state[0] - state[1], state[2]))
    return out


@pytest.mark.parametrize("max_rows, batch", [(10, 1000), (25, 7), (60, 3), (1000, 5)])
def test_cut_averages_equal_the_uncut_run(spark, max_rows, batch):
    """Chunks begin with their true averages: no lead-in rows, and missing prices anywhere."""
    rng = np.random.default_rng(max_rows)
    closes = [float(x) for x in rng.normal(100, 20, 400)]
    for i in [0, 1, 2, *range(50, 75), 200, 399]:
        closes[i] = None if i % 2 else float("nan")
    bars = bars_of(spark, [1.0] * 400).join(spark.createDataFrame(list(enumerate(closes)), "i int, x double"), "i")
    bars = bars.withColumn("Close", F.col("x")).drop("x").unionByName(bars_of(spark, [5.0, 7.0, 6.0], symbol="B"))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(batch))
        layout = indicators.live_layout(bars, max_rows=max_rows)
        rows = indicators.macd(bars, layout=layout).orderBy("i").collect()
    finally:
        spark.conf.set(key, before)
    assert layout.long == (max_rows < 400)
    for symbol, values in (("A", closes), ("B", [5.0, 7.0, 6.0])):
        got = [r for r in rows if r["symbol"] == symbol]
        assert len(got) == len(values)
        for r, want in zip(got, scanned(values)):
            if want is None:
                assert r["macd_line"] is None and r["macd_signal"] is None
            else:
                assert r["macd_line"] == pytest.approx(want[0], rel=1e-12, abs=1e-12)
                assert r["macd_signal"] == pytest.approx(want[1], rel=1e-12, abs=1e-12)


def test_layout_needs_no_lead_in(spark, skewed):
    layout = indicators.live_layout(skewed, max_rows=100)
    spread = layout.spread(skewed)
    assert spread.filter("NOT _mine").groupBy("symbol", "_chunk").count().agg(F.max("count")).first()[0] <= 60
