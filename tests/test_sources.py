import pytest
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from barstream import schemas as S
from barstream.operators import aggregates, cleaning, expansion, models
from barstream.params import JobParams
from barstream.plans.ingest import run_ingestion
from barstream.sources import fixtures, readers, sinks
from conftest import close_rows

RAW = """Ticker,Date,Open,High,Low,Close,Volume
A,2020-01-01,1.5,2,1,1.75,100
A,2020-01-02,x,2,1,1.75,12.0
B,not a day,1,1,1,1,
B,2020-01-03,,2,1,3,7
B,2020-01-04,2,3,1,2.5, 12
"""


@pytest.fixture
def raw_file(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(RAW)
    return str(path)


def test_raw_rows_are_typed_leniently(spark, raw_file):
    got = cleaning.standardize(readers.read_raw(spark, raw_file)).collect()
    assert [r["Volume"] for r in got] == [100, None, None, 7, 12]
    assert got[1]["Open"] is None and got[2]["timestamp"] is None
    bars = cleaning.drop_incomplete_bars(cleaning.standardize(readers.read_raw(spark, raw_file)))
    assert [(r["symbol"], r["Volume"]) for r in bars.collect()] == [("A", 100), ("B", 12)]


def test_average_volume_skips_malformed_rows(spark, tmp_path):
    lines = ["Ticker,Date,a,b,c,d,e,Volume", "A,d,1,1,1,1,1,10", "A,d,1,1,1,1,1,11",
             "A,d,1,1,1,1,1,12.0", "B,d,1,1,1,1,1,", "B,d,1,1,1,1,1, 7 ", "C,d,1,1", "A,d,1,1,1,1,1,13"]
    path = tmp_path / "plain.csv"
    path.write_text("\n".join(lines))
    raw = readers.read_raw(spark, str(path), header=False)
    got = {r["symbol"]: r["avg_volume"] for r in aggregates.avg_volume(raw).collect()}
    assert got == {"A": 11.33, "B": 7.0}


def test_ingestion_job(spark, raw_file, tmp_path):
    target = str(tmp_path / "bars")
    run_ingestion(spark, raw_file, target, multiplier=3)
    bars = readers.read_bars(spark, target)
    assert bars.count() == 2 * 3
    assert dict(bars.dtypes)["timestamp"] == "date"
    assert bars.filter("High < Low OR High < Open OR High < Close OR Low > Close").count() == 0
    days = [str(r[0]) for r in bars.filter("symbol = 'A'").select("timestamp").orderBy("timestamp").collect()]
    assert days == ["2020-12-31", "2021-12-31", "2022-12-31"]


def test_noise_depends_on_the_row_only(spark, sf):
    bars = expansion.expand_history(fixtures.bars(spark, sf), 2)
    a = expansion.add_noise(bars.repartition(2))
    b = expansion.add_noise(bars.repartition(9, "timestamp"))
    left, right = close_rows(a, b, 12)
    assert left == right
    moved = a.join(bars.withColumnRenamed("Close", "before"), ["symbol", "timestamp", "replica"])
    stats = moved.agg(F.avg(F.col("Close") - F.col("before")).alias("m"),
                      F.stddev(F.col("Close") - F.col("before")).alias("s")).first()
    assert abs(stats["m"]) < 0.03 and abs(stats["s"] - 0.5) < 0.03


def test_candle_repair_uses_the_new_high(spark):
    df = spark.createDataFrame([(10.0, 8.0, 12.0, 9.0)], "Open double, High double, Low double, Close double")
    got = expansion.repair_ohlc(df).first()
    assert (got["High"], got["Low"]) == (12.0, 9.0)


def test_stored_bars_prune_and_push_down(spark, sf, tmp_path):
    path = str(tmp_path / "stored")
    sinks.write_bars(fixtures.bars(spark, sf), path)
    df = readers.read_bars(spark, path).filter("symbol = '3' AND Close > 100").select("Close")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(symbol,3)" in plan and "GreaterThan(Close,100.0)" in plan
    assert "ReadSchema: struct<symbol:string,Close:double>" in plan
    # Feature windows pass a symbol filter down to the scan.
    from barstream.operators.features import rolling_features
    from barstream.operators.series import SeriesLayout

    windows = rolling_features(readers.read_bars(spark, path),
                               SeriesLayout("symbol", ("timestamp",))).filter("symbol = '3'")
    assert "EqualTo(symbol,3)" in windows._jdf.queryExecution().executedPlan().toString()


def test_files_are_time_ordered(spark, sf, tmp_path):
    path = str(tmp_path / "ordered")
    sinks.write_bars(fixtures.bars(spark, sf), path)
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i"), "symbol", "timestamp")
    from pyspark.sql import Window

    late = rows.withColumn("next", F.lead("timestamp").over(Window.partitionBy("f", "symbol").orderBy("i")))
    assert late.filter("next < timestamp").count() == 0
    # As few files as tasks, whatever the number of symbols.
    assert rows.select("f").distinct().count() <= 4


def test_symbols_stay_text(spark, tmp_path):
    rows = [("007", 1.0), ("7", 2.0)]
    bars = spark.createDataFrame([(s, x, x, x, x, 1, 2) for s, x in rows], "symbol string, Open double, High double, Low double, Close double, Volume long, replica int")
    bars = bars.withColumn("timestamp", F.current_date())
    sinks.write_bars(bars, str(tmp_path / "sorted"))
    bars.write.partitionBy("symbol").parquet(str(tmp_path / "folders"))
    for path in ("sorted", "folders"):
        back = readers.read_bars(spark, str(tmp_path / path))
        assert back.columns == [*S.BAR_COLUMNS, "replica"]
        assert sorted((r.symbol, r.Close) for r in back.collect()) == rows


def test_row_cap_at_every_border(spark, sf):
    bars = fixtures.bars(spark, sf).limit(0).unionByName(fixtures.bars(spark, sf).filter("symbol IN ('1', '2', '3')"))
    ordered = [tuple(r) for r in bars.orderBy("symbol", "timestamp").collect()]
    first = sum(r[0] == "1" for r in ordered)
    for limit in (0, 1, first, first + 1, len(ordered), len(ordered) + 5):
        assert sorted(tuple(r) for r in readers.first_rows(bars, limit).collect()) == ordered[:limit]


REPLAY = """ts,symbol,o,h,l,c,v
2024-01-01 10:00:00, aapl ,1.00005,2,0.5,1.5,10.9
2024-01-01 10:00:01,AAPL,1,2,0.5
2024-01-01 10:00:02,AAPL,1,2,0.5,oops,10
2024-01-01 10:00:03,MSFT,1,2,0.5,1.5,10
2024-01-01 10:00:04,TSLA,1,2,0.5,1.5,10
"""


def test_replay_rows(spark, tmp_path):
    path = tmp_path / "replay.csv"
    path.write_text(REPLAY)
    got = readers.read_replay(
        spark, str(path), spark.createDataFrame([("AAPL",), ("MSFT",)], "symbol string")).orderBy("timestamp").collect()
    assert [(r["Symbol"], r["Volume"]) for r in got] == [("AAPL", 10.0), ("MSFT", 10.0)]
    swapped = tmp_path / "swapped.csv"
    swapped.write_text("Ticker,Date,O,H,L,C,Adj,V\nmsft,2024-01-01,1,2,0.5,1.5,9,77\n")
    got = readers.read_replay(spark, str(swapped), None, readers.TICKER_FIRST).first()
    assert (got["Symbol"], got["Close"], got["Volume"]) == ("MSFT", 1.5, 77.0)


def test_symbols(spark, sf):
    bars = fixtures.bars(spark, sf)
    assert [r["symbol"] for r in readers.list_symbols(bars, 3).collect()] == ["0", "1", "2"]
    none = readers.symbols_or_default(spark, readers.list_symbols(bars.limit(0)))
    assert [tuple(r) for r in none.collect()] == S.FALLBACK_SYMBOLS


def test_sinks(spark, sf, tmp_path):
    trades = spark.createDataFrame([], S.TRADES)
    path = str(tmp_path / "trades")
    sinks.write_trades(trades, path)
    sinks.clear_trades(spark.read.parquet(path), str(tmp_path / "cleared"))
    assert spark.read.parquet(path).schema.fieldNames() == S.TRADES.fieldNames()
    runs = spark.createDataFrame([(0.5, 2.0)], "fraction double, time_s double")
    sinks.write_runs(runs, str(tmp_path / "runs"))
    back = spark.read.option("header", True).csv(str(tmp_path / "runs"))
    assert back.columns == ["fraction", "time_s"] and back.count() == 1


def test_model_knows_its_columns(spark, skewed, tmp_path):
    from barstream.operators.features import train_features

    train = train_features(skewed, max_return=10.0)
    model = models.fit_lasso(train)
    path = str(tmp_path / "lasso")
    models.save_model(model, path, S.LASSO_FEATURES)
    again = models.load_model(spark, LinearRegressionModel, path, S.LASSO_FEATURES)
    assert list(again.coefficients) == list(model.coefficients)
    with pytest.raises(ValueError):
        models.load_model(spark, LinearRegressionModel, path, S.SMALL_FEATURES)


def test_parameters_overlay_defaults():
    params = JobParams.from_json('{"rsi_window": 7, "market_condition": "normal"}')
    assert params.rsi_window == 7 and params.sma_window == 20


def test_clean_features_drops_every_kind_of_hole(spark):
    df = spark.createDataFrame(
        [(1.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    assert [r["x"] for r in cleaning.clean_features(df).collect()] == [1.0]


def test_watch_list_and_workload(spark, sf):
    bars = fixtures.bars(spark, sf)
    first = cleaning.limit_symbols(bars, readers.list_symbols(bars), 2)
    assert {r["symbol"] for r in first.select("symbol").distinct().collect()} == {"0", "1"}
    watched = cleaning.watch_list(bars, spark.createDataFrame([("4",)], "symbol string"))
    assert {r["symbol"] for r in watched.select("symbol").distinct().collect()} == {"4"}


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from barstream.storage import shared_dir

    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master="local-cluster[2,1,1024]", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session)
