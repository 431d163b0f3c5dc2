"""Queries for paper trading and portfolio views; one account per symbol."""

from __future__ import annotations

from pyspark.sql import functions as F

from barstream.functions.numeric import present
from barstream.functions.text import trade_side
from barstream.operators import portfolio
from barstream.params import JobParams
from barstream.plans.live import scored_bars
from barstream.queries import blocks as B
from barstream.queries.shape import half_up, shaped, shaped_sql
from barstream.sources import fixtures as X
from barstream.sources import sinks
from barstream.storage import scratch_path

QUERIES, ORACLE = {}, {}

FIXED = JobParams(use_macd=False, auto_trade=True, trade_size_shares=5)
RISK = JobParams(use_macd=False, auto_trade=True, position_sizing="percentage")


def _ledger(spark, sf, params: JobParams = FIXED):
    bars = X.bars(spark, sf)
    account = F.col("symbol")
    rows = X.bar_rows(spark, sf)
    scored = scored_bars(bars, B.WEIGHTS, B.INTERCEPT, params, bound=rows).select(
        account.alias("portfolio_id"), "symbol", "timestamp", "Close", "signal")
    layout = portfolio.account_layout(bars.withColumn("portfolio_id", account), bound=rows.withColumn("portfolio_id", account))
    return portfolio.paper_trade(scored, params, layout=layout)


_SCORED = B.scored("live", B.LIVE)
_FIXED_SQL = B.ledger(_SCORED, B.FIXED_SIZE)
_RISK_SQL = B.ledger(_SCORED, B.RISK_SIZE)
_LEDGER = ("portfolio_id symbol timestamp@ trade_executed shares_traded# shares_held# cash~3 "
           "portfolio_value~3")


def t2_paper_trade(spark, sf):
    return shaped(_ledger(spark, sf), _LEDGER)


ORACLE["t2_paper_trade"] = shaped_sql(_FIXED_SQL, "ledger", _LEDGER)


def t2_missing_values(spark, sf):
    """Rows without account, time or price stay and do not trade; the others of their symbol do."""
    n = F.col("Volume")
    signals = X.bars(spark, sf).select(
        "symbol", F.when(n % 11 != 3, F.col("symbol")).alias("portfolio_id"),
        F.when(n % 13 != 4, F.col("timestamp")).alias("timestamp"),
        F.when(n % 17 == 5, F.lit(float("nan"))).otherwise(F.col("Close")).alias("Close"),
        F.lit("BUY").alias("signal"))
    ledger = portfolio.paper_trade(signals, JobParams(auto_trade=True, starting_cash=1e12, trade_size_shares=1))
    missing = F.col("portfolio_id").isNull() | F.col("timestamp").isNull() | ~present(F.col("Close"))
    traded = F.col("trade_executed") != "None"
    return shaped(ledger.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("missing"),
        F.count_if(traded).alias("trades"), F.count_if(traded & missing).alias("wrong")),
        "symbol rows# missing# trades# wrong#")


ORACLE["t2_missing_values"] = shaped_sql(
    B.BARS + """, marked AS (SELECT symbol, "Volume" % 11 = 3 OR "Volume" % 13 = 4 OR "Volume" % 17 = 5 AS missing FROM bars),
sums AS (SELECT symbol, count(*) AS rows, count(*) FILTER (WHERE missing) AS missing,
  count(*) FILTER (WHERE NOT missing) AS trades, 0 AS wrong FROM marked GROUP BY 1)""",
    "sums", "symbol rows# missing# trades# wrong#")


def t1_risk_sizing(spark, sf):
    return shaped(_ledger(spark, sf, RISK), _LEDGER)


ORACLE["t1_risk_sizing"] = shaped_sql(_RISK_SQL, "ledger", _LEDGER)

_TRADES_SQL = _FIXED_SQL + f""", trades AS (SELECT portfolio_id, symbol, trade_executed AS action,
  {half_up('"Close"', 2)} AS price, shares_traded AS shares, "timestamp", 0.0 AS pnl FROM ledger
  WHERE trade_executed <> 'None')"""
_TRADES = "portfolio_id symbol action price~2 shares# timestamp@ pnl~2"


def s12_write_trades(spark, sf):
    path = scratch_path(spark, "trades")
    sinks.write_trades(portfolio.trades(_ledger(spark, sf)), path)
    return shaped(spark.read.parquet(path), _TRADES)


ORACLE["s12_write_trades"] = shaped_sql(_TRADES_SQL, "trades", _TRADES)


def t3_portfolio_value(spark, sf):
    return shaped(portfolio.account_values(_ledger(spark, sf)),
                  "portfolio_id cash~3 portfolio_value~3")


_VALUES = _FIXED_SQL + """, vals AS (SELECT portfolio_id, cash, portfolio_value,
  portfolio_value - 100000 AS pnl FROM ledger
  QUALIFY row_number() OVER (PARTITION BY portfolio_id ORDER BY "timestamp" DESC) = 1)"""
ORACLE["t3_portfolio_value"] = shaped_sql(
    _VALUES, "vals", "portfolio_id cash~3 portfolio_value~3")


def t4_pnl(spark, sf):
    values = portfolio.account_values(_ledger(spark, sf))
    return shaped(portfolio.pnl(values, FIXED.starting_cash), "portfolio_id pnl~3")


ORACLE["t4_pnl"] = shaped_sql(_VALUES, "vals", "portfolio_id pnl~3")


def t5_open_positions(spark, sf):
    return shaped(portfolio.open_positions(portfolio.holdings(_ledger(spark, sf))),
                  "portfolio_id symbol shares#")


_HELD = _FIXED_SQL + """, held AS (SELECT portfolio_id, symbol, shares_held AS shares, "Close"
  FROM ledger QUALIFY row_number() OVER (PARTITION BY portfolio_id ORDER BY "timestamp" DESC) = 1)"""
ORACLE["t5_open_positions"] = shaped_sql(
    _HELD, "held", "portfolio_id symbol shares#", "WHERE shares > 0")


def j3_mark_to_market(spark, sf):
    """Even-numbered symbols have a last price, the others count at the default."""
    ledger = _ledger(spark, sf)
    prices = ledger.groupBy("symbol").agg(F.max_by("Close", "timestamp").alias("price")).filter(
        F.col("symbol").cast("int") % 2 == 0)
    return shaped(portfolio.mark_to_market(portfolio.holdings(ledger), prices),
                  "portfolio_id positions_value~3")


ORACLE["j3_mark_to_market"] = shaped_sql(
    _HELD + """, marked AS (SELECT portfolio_id, shares * CASE WHEN CAST(symbol AS INTEGER) % 2 = 0
  THEN "Close" ELSE 100.0 END AS positions_value FROM held)""",
    "marked", "portfolio_id positions_value~3")


def t6_query_trades(spark, sf):
    rows = portfolio.query_trades(portfolio.trades(_ledger(spark, sf)), limit=5000)
    return shaped(rows, _TRADES)


ORACLE["t6_query_trades"] = shaped_sql(
    _TRADES_SQL, "trades", _TRADES, 'ORDER BY trades."timestamp" DESC, trades.symbol DESC LIMIT 1000')


def t6_trades_of_symbol(spark, sf):
    rows = portfolio.query_trades(portfolio.trades(_ledger(spark, sf)), symbol="7")
    return shaped(rows, _TRADES)


ORACLE["t6_trades_of_symbol"] = shaped_sql(
    _TRADES_SQL, "trades", _TRADES, "WHERE symbol = '7' ORDER BY trades.\"timestamp\" DESC LIMIT 100")


def t7_trade_log(spark, sf):
    return shaped(portfolio.trade_log(portfolio.trades(_ledger(spark, sf))), "timestamp@ line")


ORACLE["t7_trade_log"] = shaped_sql(
    _TRADES_SQL + """, log AS (SELECT "timestamp", '[' || symbol || '] ' || action AS line FROM trades
  ORDER BY "timestamp" DESC, symbol DESC LIMIT 10)""", "log", "timestamp@ line")


def p12_trade_side(spark, sf):
    rows = portfolio.trades(_ledger(spark, sf)).withColumn("side", trade_side(F.col("action")))
    return shaped(rows, "symbol timestamp@ side shares#")


ORACLE["p12_trade_side"] = shaped_sql(
    _TRADES_SQL + """, sides AS (SELECT *, CASE WHEN contains(action, 'BOUGHT') THEN 'BUY'
  ELSE 'SELL' END AS side FROM trades)""", "sides", "symbol timestamp@ side shares#")


def t8_reset_portfolio(spark, sf):
    ledger = _ledger(spark, sf)
    return shaped(portfolio.reset_portfolio(ledger, FIXED), "portfolio_id cash~2 trades#")


ORACLE["t8_reset_portfolio"] = shaped_sql(
    B.BARS + """, fresh AS (SELECT DISTINCT symbol AS portfolio_id, 100000.0 AS cash, 0 AS trades
  FROM bars)""", "fresh", "portfolio_id cash~2 trades#")


_SHARED = "portfolio_id symbol timestamp@ trade_executed shares_held# cash~3"


def t2_shared_account(spark, sf):
    """Accounts that trade three symbols each from one pot of cash."""
    account = F.floor(F.col("symbol").cast("int") / 3).cast("string")
    bars = X.bars(spark, sf)
    rows = X.bar_rows(spark, sf)
    scored = scored_bars(bars, B.WEIGHTS, B.INTERCEPT, FIXED, bound=rows).select(
        account.alias("portfolio_id"), "symbol", "timestamp", "Close", "signal")
    layout = portfolio.account_layout(bars.withColumn("portfolio_id", account), bound=rows.withColumn("portfolio_id", account))
    return shaped(portfolio.paper_trade(scored, FIXED, layout=layout), _SHARED)


ORACLE["t2_shared_account"] = shaped_sql(B.shared_ledger(_SCORED), "shared", _SHARED)

QUERIES.update({f.__name__: f for f in (
    t2_missing_values, t2_paper_trade, t1_risk_sizing, s12_write_trades, t3_portfolio_value, t4_pnl,
    t5_open_positions, j3_mark_to_market, t6_query_trades, t6_trades_of_symbol, t7_trade_log,
    p12_trade_side, t8_reset_portfolio, t2_shared_account)})
