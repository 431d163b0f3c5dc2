"""SQL building blocks of the twins (read by the independent SQL engine only)."""

from barstream.queries.shape import half_up

BARS = """bars AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS "timestamp",
    arg_min(l_extendedprice / l_quantity, l_orderkey * 10 + l_linenumber) AS "Open",
    max(l_extendedprice / l_quantity) AS "High", min(l_extendedprice / l_quantity) AS "Low",
    arg_max(l_extendedprice / l_quantity, l_orderkey * 10 + l_linenumber) AS "Close",
    CAST(sum(l_quantity) AS BIGINT) AS "Volume"
  FROM lineitem GROUP BY 1, 2)"""

FEATURES = BARS + """, rolling AS (
  SELECT *,
    avg("Close") OVER w10 AS "MA_10", avg("Close") OVER w30 AS "MA_30",
    stddev_samp("Close") OVER w10 AS "Volatility", avg("Volume") OVER w10 AS "Vol_MA_10",
    CASE WHEN lag("Close", 1) OVER w <> 0
      THEN ("Close" - lag("Close", 1) OVER w) / lag("Close", 1) OVER w ELSE 0.0 END AS "Momentum_1",
    CASE WHEN lag("Close", 5) OVER w <> 0
      THEN ("Close" - lag("Close", 5) OVER w) / lag("Close", 5) OVER w ELSE 0.0 END AS "Momentum_5",
    CASE WHEN stddev_samp("Close") OVER w30 > 1e-8
      THEN ("Close" - avg("Close") OVER w30) / stddev_samp("Close") OVER w30
      ELSE 0.0 END AS "Close_norm",
    CASE WHEN stddev_samp("Volume") OVER w10 > 1e-8
      THEN ("Volume" - avg("Volume") OVER w10) / stddev_samp("Volume") OVER w10
      ELSE 0.0 END AS "Volume_norm",
    CASE WHEN avg("Close") OVER w30 <> 0
      THEN avg("Close") OVER w10 / avg("Close") OVER w30 ELSE 1.0 END AS "MA_ratio_10_30",
    lead("Close") OVER w AS "Next_Close"
  FROM bars
  WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp"),
    w10 AS (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 10 PRECEDING AND CURRENT ROW),
    w30 AS (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 30 PRECEDING AND CURRENT ROW))"""


def training(max_return: float) -> str:
    return FEATURES + f""", labelled AS (
  SELECT *, ("Next_Close" - "Close") / "Close" AS "Target_Return",
    CASE WHEN "Next_Close" > "Close" THEN 1.0 ELSE 0.0 END AS "Target_Direction"
  FROM rolling WHERE "Close" > 1 AND "Next_Close" > 1),
ranked AS (
  SELECT *, percent_rank() OVER (PARTITION BY symbol ORDER BY "timestamp") AS "Split_Rank"
  FROM labelled WHERE abs("Target_Return") <= {max_return}),
train AS (SELECT * FROM ranked WHERE "Volatility" IS NOT NULL)"""


LIVE = BARS + """, steps AS (
  SELECT *, "Close" - lag("Close") OVER w AS dx, row_number() OVER w AS rn,
    lag("Close") OVER w AS lag1, lag("Close", 5) OVER w AS lag5
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")),
live0 AS (
  SELECT *, 1.0 AS volatility,
    avg("Close") OVER (w ROWS 19 PRECEDING) AS sma, avg("Close") OVER (w ROWS 9 PRECEDING) AS ma_10,
    avg("Close") OVER (w ROWS 29 PRECEDING) AS ma_30,
    avg("Volume") OVER (w ROWS 9 PRECEDING) AS vol_ma_10,
    stddev_pop("Close") OVER (w ROWS 29 PRECEDING) AS sd_c,
    stddev_pop("Volume") OVER (w ROWS 9 PRECEDING) AS sd_v,
    coalesce(lag1, 100.0) AS prev_price,
    list(greatest(dx, 0.0)) OVER (w ROWS 13 PRECEDING) AS ups,
    list(greatest(-dx, 0.0)) OVER (w ROWS 13 PRECEDING) AS downs
  FROM steps WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")),
live1 AS (
  SELECT *,
    CASE WHEN prev_price <> 0 THEN ("Close" - prev_price) / prev_price ELSE 0.0 END AS momentum_1,
    CASE WHEN lag5 <> 0 THEN ("Close" - lag5) / lag5 ELSE 0.0 END AS momentum_5,
    ("Close" - ma_30) / (sd_c + 1e-8) AS close_norm,
    ("Volume" - vol_ma_10) / (sd_v + 1e-8) AS volume_norm,
    CASE WHEN ma_30 <> 0 THEN ma_10 / ma_30 ELSE 1.0 END AS ma_ratio,
    list_reduce(ups, lambda a, b: (a * 13 + b) / 14) AS up,
    list_reduce(downs, lambda a, b: (a * 13 + b) / 14) AS down
  FROM live0),
live AS (
  SELECT *, CASE WHEN rn < 15 THEN 50.0
      WHEN down = 0 THEN CASE WHEN up > 0 THEN 100.0 ELSE 50.0 END
      ELSE 100.0 - 100.0 / (1.0 + up / down) END AS rsi
  FROM live1)"""

MACD = LIVE + """, ema AS (
  SELECT symbol, rn, "Close" AS f, "Close" AS s, CAST(0.0 AS DOUBLE) AS g FROM steps WHERE rn = 1
  UNION ALL
  SELECT t.symbol, t.rn, t."Close" * (2.0/13) + e.f * (1 - 2.0/13),
    t."Close" * (2.0/27) + e.s * (1 - 2.0/27),
    (t."Close" * (2.0/13) + e.f * (1 - 2.0/13) - t."Close" * (2.0/27) - e.s * (1 - 2.0/27)) * 0.2
      + e.g * 0.8
  FROM ema e JOIN steps t ON t.symbol = e.symbol AND t.rn = e.rn + 1),
full_live AS (
  SELECT l.*, e.f - e.s AS macd_line, e.g AS macd_signal, e.f - e.s - e.g AS macd_histogram
  FROM live l JOIN ema e ON e.symbol = l.symbol AND e.rn = l.rn)"""

# One weight per live linear input, chosen so that all rules fire.
WEIGHTS = [0.0103, -0.00417, 0.0201, 0.0, 0.0031416, -0.00107, 0.000103]
INTERCEPT = -0.02513

_RAW = ("close_norm * 0.0103 + volume_norm * -0.00417 + ma_ratio * 0.0201 "
        "+ momentum_1 * 0.0031416 + momentum_5 * -0.00107 + vol_ma_10 * 0.000103 - 0.02513")


def scored(live: str, ctes: str, threshold: int = 0, probability: str = "CAST(NULL AS DOUBLE)",
           volume_threshold: float = 100.0, shock_threshold: float = 5000.0) -> str:
    return ctes + f""", sc0 AS (
  SELECT *, {_RAW} AS score_raw, {probability} AS probability_up FROM {live}),
sc1 AS (SELECT *, greatest(-0.1, least(0.1, score_raw)) AS score FROM sc0),
sc2 AS (
  SELECT *, {half_up('"Close" * (1 + score)', 2)} AS target_price, probability_up IS NULL AS stale,
    CASE WHEN CASE WHEN probability_up IS NULL THEN score > 0 ELSE probability_up > 0.5 END
      THEN 1.0 ELSE 0.0 END AS direction
  FROM sc1),
sc3 AS (
  SELECT *, CASE WHEN stale THEN trunc(least(70.0, abs(score) * 1000))
      ELSE trunc(CASE WHEN direction = 1 THEN probability_up ELSE 1 - probability_up END * 100)
      END AS confidence
  FROM sc2),
sc4 AS (
  SELECT *, CASE WHEN confidence < {threshold} THEN 'HOLD' WHEN direction = 1 THEN 'BUY'
      ELSE 'SELL' END AS signal,
    CASE WHEN confidence < {threshold} THEN 'GBT confidence (' || CAST(confidence AS INTEGER)
        || '%) below {threshold}% threshold.'
      WHEN direction = 1 AND score > 0 THEN 'GBT predicts UP and Lasso confirms positive return.'
      WHEN direction = 0 AND score < 0 THEN 'GBT predicts DOWN and Lasso confirms negative return.'
      WHEN direction = 1 THEN 'GBT main model predicts upward direction.'
      ELSE 'GBT main model predicts downward direction.' END AS reason
  FROM sc3),
scored AS (
  SELECT *, CASE WHEN "Volume" > {volume_threshold} THEN 'VOLUME SPIKE'
      WHEN abs("Close" - prev_price) > {shock_threshold}
        THEN printf('PRICE SHOCK ($%.2f)', {half_up('abs("Close" - prev_price)', 2)}) ELSE 'None' END AS anomaly
  FROM sc4)"""


def replayed(ctes: str) -> str:
    """Replay scoring on top of ``scored``."""
    mae = half_up("coalesce(avg(lasso_error) OVER (w ROWS 49 PRECEDING), 0.0)", 4)
    return ctes + f""", rp0 AS (
  SELECT *, abs(lag(target_price) OVER w - "Close") AS lasso_error,
    lag(direction) OVER w AS pd, lag("Close") OVER w AS pp
  FROM scored WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")),
rp1 AS (
  SELECT *, {mae} AS lasso_mae,
    sum(CASE WHEN pd IS NULL THEN 0 WHEN (pd = 1) = ("Close" > pp) THEN 1 ELSE 0 END)
      OVER (w ROWS UNBOUNDED PRECEDING) AS replay_correct,
    count(pd) OVER (w ROWS UNBOUNDED PRECEDING) AS replay_total
  FROM rp0 WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")),
replay AS (
  SELECT *, CASE WHEN replay_total > 0 THEN {half_up("CAST(replay_correct AS DOUBLE) / replay_total * 100", 1)}
    ELSE 0.0 END AS gbt_accuracy FROM rp1)"""


def ledger(ctes: str, size: str) -> str:
    """One account per symbol, stepped row by row; ``size`` is the order size."""
    return ctes + f""", acct AS (
  SELECT symbol, CAST(0 AS BIGINT) AS rn, CAST(100000.0 AS DOUBLE) AS cash,
    CAST(0 AS BIGINT) AS held, 'None' AS note, CAST(0 AS BIGINT) AS shares,
    CAST(0 AS DOUBLE) AS worth FROM scored WHERE rn = 1
  UNION ALL
  SELECT symbol, rn,
    CASE WHEN buy THEN cash - p * n WHEN sell THEN cash + p * n ELSE cash END,
    CASE WHEN buy THEN held + n WHEN sell THEN held - n ELSE held END,
    CASE WHEN buy THEN 'BOUGHT ' || n || printf(' @ $%.2f', p)
      WHEN sell THEN 'SOLD ' || n || printf(' @ $%.2f', p) ELSE 'None' END,
    CASE WHEN buy OR sell THEN n ELSE 0 END, cash + held * p
  FROM (SELECT *, signal = 'BUY' AND cash >= p * n AS buy, signal = 'SELL' AND held >= n AS sell
    FROM (SELECT t.symbol, t.rn, t."Close" AS p, t.signal, a.cash, a.held,
        CAST({size} AS BIGINT) AS n
      FROM acct a JOIN scored t ON t.symbol = a.symbol AND t.rn = a.rn + 1))),
ledger AS (
  SELECT t.symbol AS portfolio_id, t.symbol, t."timestamp", t."Close", t.signal,
    a.note AS trade_executed, a.shares AS shares_traded, a.held AS shares_held, a.cash,
    a.worth AS portfolio_value
  FROM acct a JOIN scored t ON t.symbol = a.symbol AND t.rn = a.rn)"""


FIXED_SIZE = "5"
RISK_SIZE = 'greatest(1, trunc(a.cash * 0.05 / greatest(t."Close", 0.01)))'


def shared_ledger(ctes: str) -> str:
    """Accounts of three symbols each that trade five shares at a time from one pot of cash."""
    return ctes + """, steps_of AS (
  SELECT CAST(CAST(symbol AS INTEGER) // 3 AS VARCHAR) AS pid, symbol, "timestamp", "Close" AS p,
    signal, CAST(symbol AS INTEGER) % 3 AS slot, row_number() OVER (
      PARTITION BY CAST(symbol AS INTEGER) // 3 ORDER BY "timestamp", symbol) AS k FROM scored),
pot AS (
  SELECT DISTINCT pid, CAST(0 AS BIGINT) AS k, CAST(100000.0 AS DOUBLE) AS cash,
    CAST(0 AS BIGINT) AS h0, CAST(0 AS BIGINT) AS h1, CAST(0 AS BIGINT) AS h2, 'None' AS note, 0 AS d
  FROM steps_of
  UNION ALL
  SELECT pid, k, cash - p * d, h0 + CASE slot WHEN 0 THEN d ELSE 0 END,
    h1 + CASE slot WHEN 1 THEN d ELSE 0 END, h2 + CASE slot WHEN 2 THEN d ELSE 0 END,
    CASE d WHEN 0 THEN 'None' WHEN 5 THEN printf('BOUGHT 5 @ $%.2f', p)
      ELSE printf('SOLD 5 @ $%.2f', p) END, d
  FROM (SELECT t.pid, t.k, t.p, t.slot, a.cash, a.h0, a.h1, a.h2,
      CASE WHEN t.signal = 'BUY' AND a.cash >= t.p * 5 THEN 5
        WHEN t.signal = 'SELL' AND CASE t.slot WHEN 0 THEN a.h0 WHEN 1 THEN a.h1 ELSE a.h2 END >= 5
        THEN -5 ELSE 0 END AS d
    FROM pot a JOIN steps_of t ON t.pid = a.pid AND t.k = a.k + 1)),
shared AS (
  SELECT t.pid AS portfolio_id, t.symbol, t."timestamp", a.note AS trade_executed,
    CASE t.slot WHEN 0 THEN h0 WHEN 1 THEN h1 ELSE h2 END AS shares_held, a.cash, a.k, a.h0, a.h1, a.h2, a.d
  FROM pot a JOIN steps_of t ON t.pid = a.pid AND t.k = a.k)"""
