"""Live indicators over per-symbol bars (one bar per symbol and micro-batch).

They differ from the training features on purpose: frames of exactly 10, 30 or
``n`` rows, population deviation, and volatility measured inside the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.functions.numeric import change_or_zero, ratio_or
from barstream.operators.series import CHUNK, MINE, SeriesLayout, measure_series
from barstream.params import JobParams
from barstream.storage import cut_lineage

_EPS = 1e-8


def live_layout(bars: DataFrame, params: JobParams = JobParams(), further: int = 0,
                **options) -> SeriesLayout:
    """Rows an indicator looks back on; ``further`` for windows over indicators themselves."""
    back = max(params.sma_window, 30, params.rsi_window + 1, 6)
    return measure_series(bars, back=back + further, **options)


def rsi_lags(close: Column, window, period: int) -> dict[str, Column]:
    """The previous ``period`` closes as helper columns."""
    return {f"_close_{k}": F.lag(close, k).over(window) for k in range(1, period + 1)}


def _smoothed_changes(close: Column, period: int) -> dict[str, Column]:
    """Wilder averages of the last ``period`` changes, seeded by the first of them.

    The smoothing covers a fixed number of changes, so it is a weighted sum with
    fixed weights.  Gains and losses follow from the signed and the absolute sum:
    gain = (absolute + net) / 2 and loss = (absolute - net) / 2.  Both sums add
    in the same order, so a side without any change comes out as exactly 0.
    """
    closes = [close] + [F.col(f"_close_{k}") for k in range(1, period + 1)]
    keep = (period - 1) / period
    net, absolute = F.lit(0.0), F.lit(0.0)
    for age in range(period):
        weight = keep ** age if age == period - 1 else keep ** age / period
        change = closes[age] - closes[age + 1]
        net = net + change * F.lit(weight)
        absolute = absolute + F.abs(change) * F.lit(weight)
    return {"_net": net, "_absolute": absolute}


def _rsi(oldest: Column) -> Column:
    """RSI from the two averages; 50 while ``oldest``, the earliest close, is missing."""
    gain = F.col("_absolute") + F.col("_net")
    loss = F.col("_absolute") - F.col("_net")
    flat = F.when(gain > 0, F.lit(100.0)).otherwise(F.lit(50.0))
    return (
        F.when(oldest.isNull(), F.lit(50.0))
        .when(loss == 0, flat)
        .otherwise(100.0 - 100.0 / (1.0 + gain / loss))
    )


def window_indicators(df: DataFrame, layout: SeriesLayout, params: JobParams) -> DataFrame:
    """All indicators but MACD, over rows already spread by ``layout``."""
    if "volatility" not in df.columns:
        df = df.withColumn("volatility", F.lit(1.0))
    w = layout.window()
    last10, last30 = w.rowsBetween(-9, 0), w.rowsBetween(-29, 0)
    close, volume = F.col("Close"), F.col("Volume").cast("double")
    previous = F.lag(close, 1).over(w)
    base = F.lit(params.base_price) if params.base_price is not None else close

    df = df.withColumns({
        "sma": F.avg(close).over(w.rowsBetween(-(params.sma_window - 1), 0)),
        "ma_10": F.avg(close).over(last10),
        "ma_30": F.avg(close).over(last30),
        "vol_ma_10": F.avg(volume).over(last10),
        "_sd_close": F.stddev_pop(close).over(last30),
        "_sd_volume": F.stddev_pop(volume).over(last10),
        "prev_price": F.coalesce(previous, base),
        "_lag_5": F.lag(close, 5).over(w),
        **(rsi_lags(close, w, params.rsi_window) if params.use_rsi else {}),
    })
    if params.use_rsi:
        # A step of its own keeps the generated methods small enough to be compiled.
        df = df.withColumns(_smoothed_changes(close, params.rsi_window))
        rsi = _rsi(F.col(f"_close_{params.rsi_window}"))
    else:
        rsi = F.lit(50.0)
    df = df.withColumns({
        "momentum_1": change_or_zero(close, F.col("prev_price")),
        "momentum_5": change_or_zero(close, F.col("_lag_5")),
        "close_norm": (close - F.col("ma_30")) / (F.col("_sd_close") + _EPS),
        "volume_norm": (volume - F.col("vol_ma_10")) / (F.col("_sd_volume") + _EPS),
        "ma_ratio": ratio_or(F.col("ma_10"), F.col("ma_30"), 1.0),
        "rsi": rsi,
    })
    return df.drop("_sd_close", "_sd_volume", "_lag_5", "_net", "_absolute",
                   *[f"_close_{k}" for k in range(1, params.rsi_window + 1)])


def _smooth(values: np.ndarray, groups: np.ndarray, span: int, starts: np.ndarray) -> np.ndarray:
    """Exponential averages per run of equal ``groups``; ``starts`` has each run's average before its first value."""
    if not len(values):
        return values
    begins = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    padded = np.insert(values, begins, starts)
    smoothed = (pd.Series(padded).groupby(np.insert(groups, begins, groups[begins]), sort=False)
                .ewm(span=span, adjust=False).mean().to_numpy())
    return np.delete(smoothed, begins + np.arange(len(begins)))


class _Averages:
    """Fast, slow and signal average of runs of rows that arrive in order, batch after batch.

    A row without a price leaves the averages as they are. ``carried`` are those of the run last seen, or nothing before
    its first price; memory does not grow with the length of a run.
    """

    def __init__(self, fast: int, slow: int, signal: int, zero: bool = False):
        self.spans, self.zero, self.carried = (fast, slow, signal), zero, None

    def add(self, begins: np.ndarray, close: np.ndarray, given: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(run of each row, the three averages after it); ``given`` has averages to begin runs with, NaN for none."""
        run = np.cumsum(begins)                       # 0: goes on from the batch before
        before = np.full((3, begins.sum() + 1), np.nan)
        if self.carried is not None:
            before[:, 0] = self.carried
        if given is not None:
            before[:, 1:] = given[:, np.flatnonzero(begins)]
        priced = np.flatnonzero(~np.isnan(close))
        values, groups = close[priced], run[priced]
        first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else groups
        seed = np.stack([values[first], values[first], np.zeros(len(first))]) if not self.zero else np.zeros((3, len(first)))
        start = np.where(np.isnan(before[:, groups[first]]), seed, before[:, groups[first]])
        fast = _smooth(values, groups, self.spans[0], start[0])
        slow = _smooth(values, groups, self.spans[1], start[1])
        signal = _smooth(fast - slow, groups, self.spans[2], start[2])

        out = before[:, run]
        if len(priced):
            at = np.searchsorted(priced, np.arange(len(close)), "right") - 1   # the last priced row up to each row
            known = (at >= 0) & (groups[np.maximum(at, 0)] == run)
            out[:, known] = np.stack([fast, slow, signal])[:, at[known]]
        if len(close):
            self.carried = None if np.isnan(out[0, -1]) else tuple(out[:, -1])
        return run, out


def _doubles(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def _macd_batches(fast: int, slow: int, signal: int):
    """Rows in order of series and time: does a run begin here, the price, and the averages to begin with if known."""
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        averages = _Averages(fast, slow, signal)
        for begins, close, *given in batches:
            _, (f, s, g) = averages.add(begins.to_numpy(zero_copy_only=False).astype(bool), _doubles(close),
                                        np.stack([_doubles(c) for c in given]) if given else None)
            line = f - s
            yield pa.StructArray.from_arrays([pa.array(x, from_pandas=True) for x in (line, g, line - g)], list(_MACD_COLUMNS))
    return run


def _chunk_maps(keys: list[str], fast: int, slow: int, signal: int):
    """What each chunk does to the averages: an affine map, given by its number of prices and what it makes of zeros."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        averages, count, open_row = _Averages(fast, slow, signal, zero=True), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = pd.DataFrame({k: batch[k].to_pandas() for k in keys})
            begins = (key != key.shift()).any(axis=1).to_numpy()
            if open_row is not None and all(batch[k][0].as_py() == open_row[k] for k in keys):
                begins[0] = False
            close = _doubles(batch["Close"])
            before = averages.carried
            run_of, out = averages.add(begins, close, None)
            rows = []
            ends = np.flatnonzero(np.r_[run_of[1:] != run_of[:-1], True])
            prices = np.bincount(run_of, ~np.isnan(close)).astype(int)
            if open_row is not None and begins[0]:
                rows.append({**open_row, "n": count, "made": before or (0.0, 0.0, 0.0)})
                count = 0
            for i, end in enumerate(ends):
                own = {k: batch[k][int(end)].as_py() for k in keys}
                count = prices[run_of[end]] + (count if run_of[end] == 0 else 0)
                if i < len(ends) - 1:
                    rows.append({**own, "n": count, "made": tuple(np.nan_to_num(out[:, end]))})
                open_row = own
            if rows:
                yield _map_rows(batch, keys, rows)
            like = batch.slice(0, 0)
        if open_row is not None:
            yield _map_rows(like, keys, [{**open_row, "n": count, "made": averages.carried or (0.0, 0.0, 0.0)}])
    return run


def _map_rows(like: pa.RecordBatch, keys: list[str], rows: list[dict]) -> pa.RecordBatch:
    columns = {k: pa.array([row[k] for row in rows], like.schema.field(k).type) for k in keys}
    columns["n"] = pa.array([int(row["n"]) for row in rows], pa.int64())
    for i, name in enumerate(_START):
        columns[name] = pa.array([float(row["made"][i]) for row in rows])
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _composed(key: str, fast: int, slow: int, signal: int):
    """The averages every chunk of a series begins with: maps of the chunks before it applied one after the other.

    With decay d and share k of an average, a price p takes (f, s, g) to (df f + kf p, ds s + ks p,
    dg g + kg (f' - s')): a fixed matrix and a part that depends on the prices. A series begins with its first price as
    fast and slow average and a signal of zero.
    """
    kf, ks, kg = (2.0 / (span + 1) for span in (fast, slow, signal))
    step = np.array([[1 - kf, 0, 0], [0, 1 - ks, 0], [kg * (1 - kf), -kg * (1 - ks), 1 - kg]])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(CHUNK)
        state, begun = None, []
        for n, first, *made in zip(*(table[c].to_pylist() for c in ("n", "_first", *_START))):
            begun.append(state)
            if state is None and first is not None:
                state = np.array([first, first, 0.0])
            if state is not None and n:
                state = np.linalg.matrix_power(step, n) @ state + np.array(made)
        columns = {key: table[key], CHUNK: table[CHUNK]}
        for i, name in enumerate(_START):
            columns[name] = pa.array([None if b is None else float(b[i]) for b in begun], pa.float64())
        return pa.table(columns)
    return run


_MACD_COLUMNS = ("macd_line", "macd_signal", "macd_histogram")
_MACD = T.StructType([T.StructField(name, T.DoubleType()) for name in _MACD_COLUMNS])
_START = ("_fast_0", "_slow_0", "_signal_0")


def _chunk_starts(df: DataFrame, layout: SeriesLayout, spans: tuple[int, int, int]) -> DataFrame:
    """(key, chunk, the three averages before the chunk), one row a chunk."""
    price = F.col("Close").cast("double")
    own = df.filter(MINE).select(*layout.keys, *layout.order, price.alias("Close"))
    arranged = own.repartition(*layout.keys).sortWithinPartitions(*layout.keys, *layout.order)
    types = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in layout.keys)
    averages = ", ".join(f"{name} double" for name in _START)
    maps = arranged.select(*layout.keys, "Close").mapInArrow(_chunk_maps(layout.keys, *spans), f"{types}, n long, {averages}")
    known = F.when(price.isNotNull() & ~F.isnan(price), price)
    firsts = own.groupBy(*layout.keys).agg(F.min_by(known, F.when(known.isNotNull(), F.struct(*layout.order))).alias("_first"))
    maps = maps.join(firsts, layout.keys)
    return cut_lineage(maps.groupBy(layout.key).applyInArrow(_composed(layout.key, *spans), f"{types}, {averages}"))


def add_macd(df: DataFrame, layout: SeriesLayout, params: JobParams) -> DataFrame:
    """MACD columns over rows already spread by ``layout``; zeros when switched off.

    Rows stay in the JVM, in the order of the window that marks where series begin; two columns go through Arrow. In
    a series that is cut, every chunk begins with its true averages: what chunks do to them is computed first, one
    row a chunk, and composed along the series.
    """
    if not params.use_macd:
        return df.withColumns({name: F.lit(0.0) for name in _MACD_COLUMNS})
    spans = (params.macd_fast, params.macd_slow, params.macd_signal)
    window, price = layout.window(), F.col("Close").cast("double")
    begins = F.row_number().over(window) == 1
    given = []
    if layout.long:
        starts = _chunk_starts(df, layout, spans)
        df = df.join(starts, layout.keys, "left")
        given = [F.col(name) for name in _START]
        price = F.when(F.col(MINE), price)     # copies of a neighbour's rows move nothing
    smooth = F.arrow_udf(_macd_batches(*spans), _MACD).asNondeterministic()
    df = df.withColumn("_begins", begins).withColumn("_macd", smooth(F.col("_begins"), price, *given))
    return df.withColumns({name: F.col(f"_macd.{name}") for name in _MACD_COLUMNS}).drop("_macd", "_begins", *_START)


def macd(bars: DataFrame, params: JobParams = JobParams(),
         layout: SeriesLayout | None = None) -> DataFrame:
    """Bars with MACD line, signal and histogram."""
    layout = layout or live_layout(bars, params)
    return layout.settle(add_macd(layout.spread(bars), layout, params))


def live_features(bars: DataFrame, params: JobParams = JobParams(),
                  layout: SeriesLayout | None = None) -> DataFrame:
    """All live indicators.  ``volatility`` comes with the bars (1.0 when absent)."""
    layout = layout or live_layout(bars, params)
    df = window_indicators(layout.spread(bars), layout, params)
    return layout.settle(add_macd(df, layout, params))
