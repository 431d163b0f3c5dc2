"""The stream must agree with the batch windows over the same micro-batches."""

import os
import time

import pytest
from pyspark.sql import functions as F

from barstream.operators.aggregates import batch_bars
from barstream.operators.views import coalesce_ticks
from barstream.params import JobParams
from barstream.plans.live import signal_records
from barstream.streaming.signals import (
    live_stream, signal_stream, start_rows, start_signals,
)
from barstream.streaming.source import read_ticks
from conftest import nearly_equal

WEIGHTS = [0.0103, -0.00417, 0.0201, 0.0, 0.0031416, -0.00107, 0.000103]
PARAMS = JobParams(auto_trade=True, sma_window=4, rsi_window=3, replay_errors=3)
BATCHES = 7


def tick_lines(batch):
    """Several ticks per symbol; one tick for B; C is missing now and then."""
    stamp = f"2024-01-01T00:{batch:02d}:00.000Z"
    for i in range(40):
        price = 100 + (batch * 17 + i * 7) % 23 + i / 8
        yield f"{stamp},A,{price},{price + 1},{price - 1},{price},{10 + i},"
    yield f"{stamp},B,50,51,49,{50 + batch % 3},5,"
    if batch % 2:
        yield f"{stamp},C,9,9,9,9,1,"
        yield f"{stamp},C,9,9,9,9,3,"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("ticks")
    now = time.time()
    for batch in range(BATCHES):
        file = path / f"tick_{batch}.csv"
        file.write_text("\n".join(tick_lines(batch)) + "\n")
        os.utime(file, (now - 100 + batch, now - 100 + batch))
    return str(path)


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stream_equals_batch(spark, folder, tmp_path):
    ticks = read_ticks(spark, folder, max_files=1)
    stream = signal_stream(ticks, WEIGHTS, -0.02513, PARAMS, account=F.lit("main"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    # Small Arrow batches make the partial bars of one symbol merge.
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "16")
        start_signals(stream, out, checkpoint, interval=None).awaitTermination()
    finally:
        spark.conf.set(key, before)

    stored = spark.read.schema(ticks.schema).csv(folder)
    bars = batch_bars(stored, "timestamp")
    batch = signal_records(bars, WEIGHTS, -0.02513, PARAMS, account=F.lit("main"))
    got = spark.read.parquet(f"{out}/signals")
    assert {r["throughput"] for r in got.select("throughput").collect()} == {2, 3}
    columns = [c for c in batch.columns if c not in ("positions", "throughput")]
    nearly_equal(batch.select(columns), got.select(columns), ["symbol", "timestamp"], 1e-3)

    executed = batch.filter("trade_executed <> 'None'").count()
    assert executed > 0
    assert spark.read.parquet(f"{out}/trades").count() == executed
    assert spark.read.parquet(f"{out}/deltas").count() == got.count()

    # Started again, the finished query has nothing to add.
    start_signals(stream, out, checkpoint, interval=None).awaitTermination()
    assert spark.read.parquet(f"{out}/signals").count() == got.count()


def test_state_survives_a_restart(spark, folder, tmp_path):
    """A stream stopped half way continues from its stored state."""
    import shutil

    late = tmp_path / "late"
    late.mkdir()
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "checkpoint")

    def drain():
        stream = live_stream(read_ticks(spark, str(late), max_files=1), PARAMS)
        start_rows(stream, sink, checkpoint, interval=None).awaitTermination()

    for part in (range(0, 3), range(3, BATCHES)):
        for batch in part:
            shutil.copy2(f"{folder}/tick_{batch}.csv", late)
        drain()
    got = spark.read.parquet(sink).filter("symbol = 'A'").orderBy("timestamp").collect()
    assert len(got) == BATCHES
    assert got[-1]["prev_price"] == pytest.approx(got[-2]["Close"])
    assert got[-1]["sma"] == pytest.approx(sum(r["Close"] for r in got[-4:]) / 4)


def test_malformed_numbers_and_age(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "new.csv").write_text(
        "2024-01-01T00:00:00.000Z,A,oops,1,1,2,3\n2024-01-01T00:00:01.000Z,A,1,1,1,bad,3,\n")
    (folder / "old.csv").write_text("2024-01-01T00:00:02.000Z,B,1,1,1,1,1,\n")
    os.utime(folder / "old.csv", (time.time() - 5000,) * 2)

    def rows(**options):
        sink = str(tmp_path / f"sink{len(options)}")
        (read_ticks(spark, str(folder), **options).writeStream.format("parquet")
         .option("path", sink).option("checkpointLocation", f"{sink}-c")
         .trigger(availableNow=True).start()).awaitTermination()
        return spark.read.parquet(sink).orderBy("Symbol").collect()

    got = rows()
    # A bad Open is a null field; a row without a close cannot be used.
    assert [(r["Symbol"], r["Open"], r["gen_ts"]) for r in got] == [("A", None, None), ("B", 1.0, None)]
    assert [r["Symbol"] for r in rows(max_age_seconds=600, newest_first=True)] == ["A"]


def test_coalescing_drops_late_rows_on_streams(spark, folder, tmp_path):
    df = coalesce_ticks(read_ticks(spark, folder, max_files=1), "1 minute", watermark="1 minute")
    sink = str(tmp_path / "sink")
    (df.writeStream.format("parquet").option("path", sink)
     .option("checkpointLocation", f"{sink}-c").trigger(availableNow=True).start()).awaitTermination()
    got = spark.read.parquet(sink)
    # Windows close once the watermark has passed them.
    assert got.filter("symbol = 'B'").count() == BATCHES - 2


def drained(stream, sink):
    start_rows(stream, sink, f"{sink}-checkpoint", interval=None).awaitTermination()
    return stream.sparkSession.read.parquet(sink)


def test_newest_files_are_read_and_the_rest_shed(spark, tmp_path):
    """Per batch the newest files; surplus ones are logged and not opened, late old ones left out, all deleted if asked."""
    from barstream.streaming.newest import shed_files
    from barstream.streaming.source import read_newest_ticks

    folder, log, sink = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "sink")
    folder.mkdir()

    def add(number, at, text=None):
        file = folder / f"tick_{number}.csv"
        file.write_text(text or f"2024-01-01T00:00:{number:02d}.000Z,S{number},1,1,1,{number},5,\r\nbroken,line\n2024-01-01T00:00:00Z,T,,,,oops,1,")
        os.utime(file, (at, at))

    for n in range(6):
        add(n, 1000 + n)
    read = lambda: drained(read_newest_ticks(spark, str(folder), 2, log), sink)
    assert sorted(r["Symbol"] for r in read().collect()) == ["S4", "S5"]
    assert sorted(r["file"] for r in shed_files(spark, log).collect()) == [f"tick_{n}.csv" for n in range(4)]
    add(6, 1003)                           # older than what was read
    add(7, 2000)
    assert sorted(r["Symbol"] for r in read().collect()) == ["S4", "S5", "S7"]
    assert shed_files(spark, log).count() == 4
    assert read().count() == 3             # nothing new

    cleaned = drained(read_newest_ticks(spark, str(folder), 3, clean=True), str(tmp_path / "cleaned"))
    assert sorted(r["Symbol"] for r in cleaned.collect()) == ["S4", "S5", "S7"]
    add(8, 3000)                           # a batch is cleaned up when the next one begins
    drained(read_newest_ticks(spark, str(folder), 3, clean=True), str(tmp_path / "cleaned"))
    assert not (folder / "tick_5.csv").exists() and not (folder / "tick_0.csv").exists()


def test_empty_folder_gives_no_batch(spark, tmp_path):
    from barstream.streaming.newest import chosen, list_marks

    assert list_marks(str(tmp_path)) == list_marks(str(tmp_path / "none")) == []
    marks = [[5, "a"], [5, "b"], [7, "c"]]
    assert chosen(marks, [5, "a"], [7, "c"], 1) == (["c"], ["b"])
    assert chosen(marks, [-1, ""], [5, "b"], 5) == (["a", "b"], [])


def test_keyed_table_takes_a_batch_once(spark, tmp_path):
    """Three batches, the second run twice, an empty one: the newest row of each symbol, older versions removed."""
    from barstream.operators.views import latest_state, top_movers
    from barstream.streaming.keyed_table import KEPT, KeyedTable

    table = KeyedTable(str(tmp_path / "state"), buckets=4)
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    rows = [(f"S{i % 30}", i, float(i), float((i * 7) % 13)) for i in range(200)] + [("S1", 500, 1.0, 1.0), ("S1", 500, 2.0, 9.0), (None, 9, 9.0, 9.0)]
    signals = spark.createDataFrame(rows, "symbol string, t int, price double, momentum double").withColumn("timestamp", F.timestamp_seconds("t")).drop("t")
    parts = [signals.filter(F.abs(F.hash("timestamp")) % 3 == k) for k in range(3)]
    for batch, part in ((0, parts[0]), (1, parts[1]), (1, parts[1]), (2, parts[2]), (3, signals.limit(0))):
        table.merge(part, batch)
    batch_view = latest_state(signals.filter("symbol IS NOT NULL"))
    got, want = (sorted(tuple(r) for r in df.select(*signals.columns).collect()) for df in (table.read(spark), batch_view))
    assert got == want and len(got) == 30
    assert [tuple(r) for r in top_movers(table.read(spark)).collect()] == [tuple(r) for r in top_movers(batch_view).collect()]
    for batch in range(4, 12):
        table.merge(signals.filter(F.col("symbol") == f"S{batch}"), batch)
    assert len(os.listdir(tmp_path / "state" / "manifests")) <= 2 * KEPT  # with the file system's checksums
    assert sorted(tuple(r) for r in table.read(spark).select(*signals.columns).collect()) == want


def test_workload_and_base_price(spark, folder, tmp_path):
    from barstream.streaming.signals import of_workload

    symbols = spark.createDataFrame([("A", 80.0), ("A", 70.0), ("C", None), ("Z", 1.0)], "symbol string, base_price double")
    ticks = of_workload(read_ticks(spark, folder, max_files=1), symbols)
    got = drained(live_stream(ticks, PARAMS), str(tmp_path / "sink"))
    first = {r["symbol"]: r["prev_price"] for r in got.orderBy(F.desc("timestamp")).collect()}
    assert first == {"A": 80.0, "C": PARAMS.base_price}


def test_replay_stream_equals_the_batch(spark, tmp_path):
    """Files whose rows are in no order: bars by time, replay scoring and accounts as over the stored rows."""
    from barstream.sources.readers import read_replay, stream_replay

    folder = tmp_path / "replay"
    folder.mkdir()
    for part in range(3):
        days = [part * 8 + (k * 5) % 8 for k in range(8)]
        lines = [f"2024-01-{d + 1:02d},{s},{90 + (d * 7 + n * 5) % 19},120,80,{90 + (d * 11 + n * 3) % 23},{10 + d}" for d in days for n, s in enumerate("ABC")]
        file = folder / f"part_{part}.csv"
        file.write_text("\n".join(["ts,symbol,o,h,l,c,v", *lines, "2024-01-01,A,short", "2024-01-01,Q,1,1,1,1,1"]) + "\n")
        os.utime(file, (1000 + part, 1000 + part))
    known = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    stored = read_replay(spark, str(folder), known)
    bars = batch_bars(stored, "timestamp")
    batch = signal_records(bars, WEIGHTS, -0.02513, PARAMS, account=F.lit("main"))
    stream = signal_stream(stream_replay(spark, str(folder), known, max_files=1), WEIGHTS, -0.02513, PARAMS, account=F.lit("main"), watermark="0 seconds")
    out = str(tmp_path / "out")
    start_signals(stream, out, f"{out}-checkpoint", interval=None).awaitTermination()
    got = spark.read.parquet(f"{out}/signals")
    columns = [c for c in batch.columns if c not in ("positions", "throughput")]
    assert batch.count() == 72
    nearly_equal(batch.select(columns), got.select(columns), ["symbol", "timestamp"], 1e-3)
    listed = lambda df: {(r["symbol"], r["timestamp"]): r["positions"] for r in df.collect()}
    assert listed(got) == listed(batch) and any(listed(got).values())
    plain = signal_stream(stream_replay(spark, str(folder), known), WEIGHTS, -0.02513, PARAMS, replay=False, watermark="0 seconds")
    assert "lasso_mae" not in plain.columns


def test_state_of_many_symbols_is_kept_in_few_groups(spark, tmp_path):
    """A call costs milliseconds, so there must not be one for each symbol."""
    from barstream.streaming.state import BUCKETS

    folder, out = tmp_path / "ticks", str(tmp_path / "out")
    folder.mkdir()
    for batch in range(2):
        (folder / f"{batch}.csv").write_text("".join(
            f"2024-01-01T00:0{batch}:00.000Z,S{n},1,1,1,{n + 1 + batch},5,\n" for n in range(2 * BUCKETS)))
        stream = live_stream(read_ticks(spark, str(folder), max_files=1), PARAMS)
        query = start_rows(stream, out, f"{out}-checkpoint", interval=None)
        query.awaitTermination()
        kept = max(operator.numRowsTotal for progress in query.recentProgress for operator in progress.stateOperators)
        assert 0 < kept <= BUCKETS
    rows = {(r["symbol"], r["timestamp"].minute): r for r in spark.read.parquet(out).collect()}
    assert len(rows) == 4 * BUCKETS
    for n in range(2 * BUCKETS):
        assert rows[f"S{n}", 0]["prev_price"] == 100.0
        assert rows[f"S{n}", 1]["prev_price"] == n + 1 and rows[f"S{n}", 1]["sma"] == n + 1.5


class _Handle:
    """A value state in memory, as processors ask for one."""

    def __init__(self):
        self.value = None

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_bars_of_a_bucket_in_parts_and_at_once(spark):
    """Symbols of a bucket do not mix, however its bars are dealt over micro-batches; volumes may be missing."""
    import numpy as np
    import pandas as pd
    from barstream.streaming.state import PARTIAL, LiveFeatureProcessor, _PRICES

    rng = np.random.default_rng(5)
    frames = []
    for symbol, bars in (("A", 90), ("B", 1), ("C", 41), (None, 7)):
        values = {f"{c}_{part}": rng.uniform(5, 9, bars) if part == "sum" else np.ones(bars) for c in _PRICES for part in ("sum", "n")}
        values["Volume_n"][::4], values["Volume_sum"][::4] = 0, 0
        frames.append(pd.DataFrame({"symbol": [symbol] * bars, "timestamp": pd.date_range("2024-01-01", periods=bars), **values,
                                    "Close_m2": 0.0, "base_price": np.nan})[PARTIAL.fieldNames()])
    whole = pd.concat(frames, ignore_index=True)

    def worked(rows, handle):
        processor = LiveFeatureProcessor(JobParams(), by_time=True)
        processor.init(handle)
        return [out for some in rows for out in processor.handleInputRows((0,), iter([some.sample(frac=1, random_state=1)]), None)]

    at_once = pd.concat(worked([whole], _Handle()))
    handle = _Handle()
    parts = pd.concat(worked([p for _, p in whole.groupby(whole["timestamp"].dt.dayofyear // 13)], handle))
    alone = pd.concat([out for frame in frames for out in worked([frame], _Handle())])
    order = ["symbol", "timestamp"]
    for other in (parts, alone):
        pd.testing.assert_frame_equal(at_once.sort_values(order, ignore_index=True), other.sort_values(order, ignore_index=True), rtol=1e-9)
    a = at_once[at_once["symbol"] == "A"].sort_values("timestamp")
    assert np.allclose(a["sma"], a["Close"].rolling(20, min_periods=1).mean())
    assert np.allclose(a["vol_ma_10"], a["Volume"].rolling(10, min_periods=1).mean(), equal_nan=True)
    fast, slow = (a["Close"].ewm(span=n, adjust=False).mean() for n in (12, 26))
    assert np.allclose(a["macd_signal"], (fast - slow).ewm(span=9, adjust=False).mean())
    assert worked([whole.iloc[:1]], handle) == []
