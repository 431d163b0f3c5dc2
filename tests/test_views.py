import json

from pyspark.sql import functions as F

from barstream.operators import views
from barstream.params import JobParams
from barstream.plans.live import signal_records
from barstream.sources import fixtures

WEIGHTS = [0.0103, -0.00417, 0.0201, 0.0, 0.0031416, -0.00107, 0.000103]
PARAMS = JobParams(use_macd=False)


def records(spark, sf):
    return signal_records(fixtures.bars(spark, sf), WEIGHTS, -0.02513, PARAMS)


def test_history_limits_rows_before_the_shuffle(spark, sf, tmp_path):
    records(spark, sf).write.parquet(str(tmp_path / "records"))
    stored = spark.read.parquet(str(tmp_path / "records"))
    df = views.history(stored, 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    sizes = df.groupBy("symbol").count().agg(F.min("count"), F.max("count")).first()
    assert tuple(sizes) == (10, 10)
    lists = views.history_lists(stored, 10).first()
    times = [p["time"] for p in lists["history"]]
    assert times == sorted(times) and len(times) == 10


def test_latest_state_keeps_one_row_per_task_and_reads_what_it_needs(spark, sf, tmp_path):
    records(spark, sf).write.parquet(str(tmp_path / "records"))
    df = views.latest_state(spark.read.parquet(str(tmp_path / "records"))).select("symbol", "price")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "row_number(), 1, Partial" in plan
    assert "ReadSchema: struct<symbol:string,timestamp:date,price:double>" in plan
    known = spark.createDataFrame([("1",), ("new",)], "symbol string")
    got = {r["symbol"]: r for r in views.latest_state(records(spark, sf), known).collect()}
    assert set(got) == {"1", "new"}
    waiting = got["new"]
    assert (waiting["price"], waiting["signal"], waiting["rsi"], waiting["gbt_direction"]) == (
        100.0, "HOLD", 50.0, "FLAT")


def test_top_movers_skip_priceless_symbols(spark):
    df = spark.createDataFrame([("A", 0.0, 99.0), ("B", 1.0, -5.0), ("C", 1.0, 5.0), ("D", 1.0, 1.0)],
                               "symbol string, price double, momentum double")
    assert [r["symbol"] for r in views.top_movers(df, 2).collect()] == ["B", "C"]


def test_delta_is_nested_json(spark, sf):
    row = views.to_delta_json(views.tick_delta(records(spark, sf))).first()
    delta = json.loads(row["delta"])
    assert set(delta) == {"market", "indicators", "signals", "metrics", "anomalies"}
    assert delta["market"]["price"] == delta["market"]["history_point"]["price"]
    assert set(delta["indicators"]["macd"]) == {"line", "signal", "histogram"}


def test_last_tick_of_a_window_wins(spark):
    rows = [("A", 0, 1.0), ("A", 150, 2.0), ("A", 199, 3.0), ("A", 200, 4.0), ("B", 10, 9.0)]
    df = spark.createDataFrame(rows, "Symbol string, ms long, Close double").withColumn(
        "timestamp", F.timestamp_millis("ms")).drop("ms")
    got = sorted((r["symbol"], r["Close"]) for r in views.coalesce_ticks(df).collect())
    assert got == [("A", 3.0), ("A", 4.0), ("B", 9.0)]


def test_ticks_can_be_batched_by_event_time(spark):
    from barstream.operators.aggregates import batch_bars, tick_windows

    rows = [("A", 0, 1.0), ("A", 150, 3.0), ("A", 250, 5.0)]
    df = spark.createDataFrame(rows, "Symbol string, ms long, Close double").withColumns(
        {"timestamp": F.timestamp_millis("ms"),
         **{c: F.col("Close") for c in ("Open", "High", "Low", "Volume")}})
    got = batch_bars(df, tick_windows("200 milliseconds")).orderBy("timestamp").collect()
    assert [r["Close"] for r in got] == [2.0, 5.0]
