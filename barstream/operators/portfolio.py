"""Paper trading and portfolio views.

Trading is sequential inside an account because every order depends on the cash
left by the one before.  Accounts are independent and run in parallel; inside
one account rows stream through in time order with only cash, open positions and
last prices in memory.  Accounts longer than ``max_rows`` are worked off in time
slices, with the account state stored between slices.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream import schemas as S
from barstream.functions.text import trade_line
from barstream.operators.series import SeriesLayout, measure_series, prefix_sums, time_bucket
from barstream.params import JobParams
from barstream.storage import cut_lineage, scratch_path

MAX_ACCOUNT_ROWS = 50_000_000

LEDGER_FIELDS = [
    T.StructField("trade_executed", T.StringType()),
    T.StructField("shares_traded", T.LongType()),
    T.StructField("shares_held", T.LongType()),
    T.StructField("cash", T.DoubleType()),
    T.StructField("portfolio_value", T.DoubleType()),
    T.StructField("ledger_row", T.LongType()),
    T.StructField("positions", T.MapType(T.StringType(), T.LongType())),
]
# Of a row that cannot trade.
IDLE_ROW = (S.TRADE_NONE, 0, None, None, None, None, None)


class Account:
    """Cash, open positions and last prices of one account."""

    def __init__(self, cash: float, positions: dict | None = None, prices: dict | None = None, rows: int = 0):
        self.cash, self.positions, self.prices, self.rows = cash, positions or {}, prices or {}, rows

    @classmethod
    def loads(cls, text: str) -> "Account":
        return cls(*json.loads(text))

    def dumps(self) -> str:
        # Only the prices of open positions can matter later.
        kept = {s: self.prices[s] for s in self.positions}
        return json.dumps([self.cash, self.positions, kept, self.rows])

    def _order_size(self, price: float, params: JobParams) -> int:
        if params.position_sizing == "percentage":
            return max(1, int(self.cash * params.risk_pct / max(price, 0.01)))
        return max(1, params.trade_size_shares)

    def order(self, symbol: str, price: float, signal: str, params: JobParams) -> tuple[str, int, int]:
        """(note, shares traded, shares held after it) of one row's signal."""
        held = self.positions.get(symbol, 0)
        if signal == "HOLD" or not params.auto_trade:
            return S.TRADE_NONE, 0, held
        note, n = S.TRADE_NONE, self._order_size(price, params)
        if signal == "BUY" and self.cash >= price * n:
            self.cash -= price * n
            held += n
            note = f"{S.TRADE_BOUGHT} {n} @ ${price:.2f}"
        elif signal == "SELL" and held >= n:
            self.cash += price * n
            held -= n
            note = f"{S.TRADE_SOLD} {n} @ ${price:.2f}"
        else:
            return note, 0, held
        if held:
            self.positions[symbol] = held
        else:
            self.positions.pop(symbol, None)
        return note, n, held

    def worth(self) -> float:
        return self.cash + sum([n * self.prices[s] for s, n in self.positions.items()])

    def trade(self, symbols: list, prices: list, signals: list, params: JobParams) -> list[tuple]:
        """Work one batch in order.  All prices of the batch are known first, so the
        account's value is the same before and after each trade of the batch.

        Rows are numbered within the account; the last one of the batch carries all open positions.
        """
        self.prices.update(zip(symbols, prices))
        value = self.worth()
        out = []
        for symbol, price, signal in zip(symbols, prices, signals):
            ordered = self.order(symbol, price, signal, params)
            self.rows += 1
            out.append((*ordered, self.cash, value, self.rows, None))
        if out:
            out[-1] = (*out[-1][:-1], dict(self.positions))
        return out


_RESULT = T.StructType([*LEDGER_FIELDS, T.StructField("state_after", T.StringType())])


def _values(column: pa.Array) -> list:
    """Values of a column, a missing double as NaN; by way of numpy, as scalars one by one cost most of a row."""
    if pa.types.is_integer(column.type) and column.null_count:
        return column.to_pylist()
    return column.to_numpy(zero_copy_only=False).tolist()


def _ledger_batches(params: JobParams, keep_state: bool):
    """Rows sorted by account, time and symbol: account, symbol, time, price, signal and, where a slice begins, the
    account's state. One result a row, in the same order.

    The rows of one time are held until the next time or account is seen; pieces are joined once, so a time with many
    symbols costs its length. A row that is alone with its time within a batch is worked at once. With ``keep_state`` an
    account's last row carries its state.
    """
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        account, owner, time = Account(params.starting_cash), None, None
        held: list[tuple] = []                       # rows of one account and time

        def settle(leaves: bool) -> list[tuple]:
            trading = [row for row in held if row is not None]
            traded = iter(account.trade(*map(list, zip(*trading)), params) if trading else [])
            rows = [(*(IDLE_ROW if row is None else next(traded)), None) for row in held]
            if rows and leaves and keep_state:
                rows[-1] = (*rows[-1][:-1], account.dumps())
            held.clear()
            return rows

        for columns in batches:
            done: list[tuple] = []
            rows = list(zip(*map(_values, columns)))
            for i, (own, symbol, at, price, signal, state) in enumerate(rows, 1):
                if own != owner or at != time:
                    if held:
                        done += settle(own != owner)
                    if own != owner:
                        account = Account(params.starting_cash)
                    owner, time = own, at
                if state is not None:
                    account = Account.loads(state)
                lacking = state is not None or own is None or symbol is None or at is None or price is None or price != price
                if not (lacking or held or i == len(rows)) and own == rows[i][0] and at != rows[i][2]:
                    account.prices[symbol] = price
                    value = account.worth()
                    ordered = account.order(symbol, price, signal, params)
                    account.rows += 1
                    done.append((*ordered, account.cash, value, account.rows, dict(account.positions), None))
                    continue
                held.append(None if lacking else (symbol, price, signal))
            yield _results(done)
        yield _results(settle(True))
    return run


def _maps(column: list[dict | None]) -> pa.Array:
    """Maps as one array, built from flat keys and values."""
    sizes = np.array([len(m) if m else 0 for m in column], np.int32)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32(), mask=np.array([*(m is None for m in column), False]))
    keys, values = [k for m in column if m for k in m], [v for m in column if m for v in m.values()]
    return pa.MapArray.from_arrays(offsets, pa.array(keys, pa.string()), pa.array(values, pa.int64()))


def _results(rows: list[tuple]) -> pa.Array:
    columns = list(zip(*rows)) or [()] * len(_RESULT)
    types = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), None, pa.string()]
    return pa.StructArray.from_arrays([pa.array(c, t) if t else _maps(c) for c, t in zip(columns, types)], _RESULT.fieldNames())


def _run_ledger(rows: DataFrame, params: JobParams, states: DataFrame | None,
                keep_state: bool) -> DataFrame:
    """Ledger rows; with ``keep_state``, ``_state`` is what an account's last row left behind.

    Rows stay in the JVM; five columns and the state go through Arrow. Rows that only bring a state in come out with
    ``_brought``.
    """
    rows = rows.withColumn("_state", F.lit(None).cast("string"))
    if states is not None:
        rows = rows.unionByName(states.select("portfolio_id", "_state"), allowMissingColumns=True)
    arranged = rows.repartition("portfolio_id").sortWithinPartitions(
        "portfolio_id", F.col("_state").isNull(), F.col("timestamp").asc_nulls_first(), "symbol")
    trade = F.arrow_udf(_ledger_batches(params, keep_state), _RESULT).asNondeterministic()
    time = F.unix_micros(F.col("timestamp").cast("timestamp"))
    traded = arranged.withColumn("_row", trade("portfolio_id", "symbol", time, F.col("Close").cast("double"), "signal", "_state"))
    return traded.withColumns({**{f.name: F.col(f"_row.{f.name}") for f in LEDGER_FIELDS}, "_brought": F.col("_state").isNotNull(),
                               "_state": F.col("_row.state_after")}).drop("_row")


def account_layout(rows: DataFrame, max_rows: int = MAX_ACCOUNT_ROWS, bound: DataFrame | None = None) -> SeriesLayout:
    """Measure accounts; any table with one row per signal will do (``bound``: see ``measure_series``)."""
    return measure_series(rows, back=0, key="portfolio_id", max_rows=max_rows, bound=bound)


def paper_trade(signals: DataFrame, params: JobParams, max_rows: int = MAX_ACCOUNT_ROWS,
                layout: SeriesLayout | None = None) -> DataFrame:
    """Ledger: every signal row with trade, holding, cash and account value after it, its number within the
    account, and on the last row of an account's batch (its rows of one time) the map of open positions.

    Needs ``portfolio_id, symbol, timestamp, Close, signal``; other columns pass
    through.  A row without account, symbol, time or price stays, but does not trade:
    it has no holding, cash or value.
    """
    layout = layout or account_layout(signals, max_rows)
    if not layout.long:
        return _run_ledger(signals, params, None, False).drop("_state", "_brought")

    # Stored once in time order: every slice then reads its own row groups instead of
    # computing the signals again.
    spark, path = signals.sparkSession, scratch_path(signals.sparkSession, "signals")
    (
        signals.withColumn("_bucket", time_bucket(signals, "timestamp", layout.width))
        .repartitionByRange("_bucket", "portfolio_id", "symbol")
        .sortWithinPartitions("_bucket").write.parquet(path)
    )
    timed = spark.read.parquet(path)
    # Common slice borders: cut where the longest account has had its share.
    longest = timed.groupBy("portfolio_id", "_bucket").count().groupBy("_bucket").agg(F.max("count").alias("_n"))
    borders = (
        prefix_sums(longest, ["_bucket"], "_n", "_before")
        .withColumn("_slice", F.floor(F.col("_before") / max_rows))
        .groupBy("_slice").agg(F.min("_bucket").alias("_from")).orderBy("_slice")
    )
    starts = [row["_from"] for row in borders.collect()]
    ledgers, states = [], None
    for start, end in zip(starts, [*starts[1:], None]):
        part = timed.filter(F.col("_bucket") >= start)
        if end is not None:
            part = part.filter(F.col("_bucket") < end)
        done = cut_lineage(_run_ledger(part.drop("_bucket"), params, states, True))
        ledgers.append(done.filter(~F.col("_brought")).drop("_state", "_brought"))
        fresh = done.filter(F.col("_state").isNotNull()).select("portfolio_id", "_state")
        states = cut_lineage(fresh)
    return reduce(DataFrame.unionByName, ledgers)


def trades(ledger: DataFrame) -> DataFrame:
    """Executed trades only.  Profit per trade is not tracked and stays 0."""
    return ledger.filter(F.col("trade_executed") != S.TRADE_NONE).select(
        "portfolio_id", "symbol", F.col("trade_executed").alias("action"),
        F.round("Close", 2).alias("price"), F.col("shares_traded").alias("shares"),
        "timestamp", F.lit(0.0).alias("pnl"))


def query_trades(trade_rows: DataFrame, symbol: str | None = None, limit: int = 100) -> DataFrame:
    """Newest trades first; the limit is held between 1 and 1000."""
    if symbol:
        trade_rows = trade_rows.filter(F.col("symbol") == symbol)
    newest = [F.desc(c) for c in ("timestamp", "symbol", "portfolio_id")]
    return trade_rows.orderBy(*newest).limit(max(1, min(limit, 1000)))


def trade_log(trade_rows: DataFrame, n: int = 10) -> DataFrame:
    return query_trades(trade_rows, limit=n).select(
        "timestamp", trade_line(F.col("symbol"), F.col("action")).alias("line"))


def holdings(ledger: DataFrame) -> DataFrame:
    """Last holding per account and symbol, in the order in which the account traded."""
    return ledger.filter("shares_held IS NOT NULL").groupBy("portfolio_id", "symbol").agg(
        F.max_by("shares_held", "ledger_row").alias("shares"))


def open_positions(held: DataFrame) -> DataFrame:
    return held.filter(F.col("shares") > 0)


def mark_to_market(held: DataFrame, prices: DataFrame,
                   default_price: float = S.DEFAULT_POSITION_PRICE) -> DataFrame:
    """Value of each account's positions; unpriced symbols count at the default."""
    priced = held.join(prices.select("symbol", "price"), "symbol", "left")
    worth = F.col("shares") * F.coalesce("price", F.lit(default_price))
    return priced.groupBy("portfolio_id").agg(F.sum(worth).alias("positions_value"))


def account_values(ledger: DataFrame) -> DataFrame:
    """Cash and value of every account after its last batch."""
    return ledger.groupBy("portfolio_id").agg(
        F.max_by("cash", "ledger_row").alias("cash"), F.max_by("portfolio_value", "ledger_row").alias("portfolio_value"))


def positions(ledger: DataFrame) -> DataFrame:
    """Open positions of every account after each of its batches, one row a batch."""
    return ledger.filter("positions IS NOT NULL").select("portfolio_id", "timestamp", "ledger_row", "positions")


def pnl(values: DataFrame, starting_cash: float) -> DataFrame:
    return values.withColumn("pnl", F.col("portfolio_value") - F.lit(starting_cash))


def reset_portfolio(portfolios: DataFrame, params: JobParams) -> DataFrame:
    """Opening state: starting cash, no positions, no trades."""
    return portfolios.select("portfolio_id").distinct().select(
        "portfolio_id",
        F.lit(params.starting_cash).alias("cash"),
        F.lit(params.starting_cash).alias("portfolio_value"),
        F.create_map().cast("map<string,bigint>").alias("positions"),
        F.lit(0).cast("bigint").alias("trades"))
