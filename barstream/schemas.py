"""Schemas, feature lists and fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

_D = T.DoubleType()
_L = T.LongType()
_S = T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Raw daily files carry text so that a malformed number becomes a null instead
# of a failed read; ``standardize`` does the typed casts.
RAW = _struct(
    ("Ticker", _S), ("Date", _S), ("Open", _S), ("High", _S),
    ("Low", _S), ("Close", _S), ("Volume", _S),
)

# Headerless raw layout: ticker first, volume in the eighth column.
RAW_POSITIONAL = _struct(
    ("Ticker", _S), ("Date", _S), ("Open", _S), ("High", _S),
    ("Low", _S), ("Close", _S), ("Extra", _S), ("Volume", _S),
)

TICK = _struct(
    ("timestamp", T.TimestampType()), ("Symbol", _S), ("Open", _D), ("High", _D),
    ("Low", _D), ("Close", _D), ("Volume", _D), ("gen_ts", _D),
)

REPLAY = _struct(
    ("ts", _S), ("symbol", _S), ("Open", _S), ("High", _S),
    ("Low", _S), ("Close", _S), ("Volume", _S),
)

TRADES = _struct(
    ("portfolio_id", _S), ("symbol", _S), ("action", _S), ("price", _D),
    ("shares", _L), ("timestamp", T.TimestampType()), ("pnl", _D),
)

BAR_COLUMNS = ["symbol", "timestamp", "Open", "High", "Low", "Close", "Volume"]

# --- fixed values: feature lists, in the order the models expect ------------
LASSO_FEATURES = [
    "Close_norm", "Volume_norm", "MA_ratio_10_30", "Volatility",
    "Momentum_1", "Momentum_5", "Vol_MA_10",
]
TREE_FEATURES = [
    "Open", "High", "Low", "Close", "Volume",
    "MA_10", "MA_30", "Volatility", "Vol_MA_10",
    "Momentum_1", "Momentum_5",
    "Close_norm", "Volume_norm", "MA_ratio_10_30",
]
SMALL_FEATURES = [
    "Open", "High", "Low", "Close", "Volume",
    "MA_10", "MA_30", "Volatility", "Vol_MA_10",
    "Momentum_1", "Momentum_5",
]

# --- fixed values: wording of signals, notes and trades ---------------------
REASON_BELOW_THRESHOLD = "GBT confidence (%d%%) below %d%% threshold."
REASON_BUY_CONFIRMED = "GBT predicts UP and Lasso confirms positive return."
REASON_SELL_CONFIRMED = "GBT predicts DOWN and Lasso confirms negative return."
REASON_BUY = "GBT main model predicts upward direction."
REASON_SELL = "GBT main model predicts downward direction."
REASON_HOLD = "models have insufficient directional agreement."
NOTE_OVERBOUGHT = "overbought (RSI %.0f)"
NOTE_OVERSOLD = "oversold (RSI %.0f)"
NOTE_BULLISH = "MACD bullish"
NOTE_BEARISH = "MACD bearish"
ANOMALY_NONE = "None"
ANOMALY_VOLUME = "VOLUME SPIKE"
ANOMALY_SHOCK = "PRICE SHOCK ($%.2f)"
TRADE_NONE = "None"
TRADE_BOUGHT = "BOUGHT"
TRADE_SOLD = "SOLD"
AWAITING_DATA = "Awaiting data…"

# --- fixed values: defaults of the rules ------------------------------------
MIN_VALID_PRICE = 1.0
MAX_ABS_TARGET_RETURN = 0.25
MAX_LIVE_RETURN = 0.10
TRAIN_SHARE = 0.8
HISTORY_MULTIPLIER = 15
SHIFT_DAYS = 365
NOISE_SIGMA = 0.5
NOISE_SEEDS = {"Open": 42, "High": 43, "Low": 44, "Close": 45}
MIN_NOISY_PRICE = 1.0
DEFAULT_POSITION_PRICE = 100.0
BACKLOG_FILES = 20
FALLBACK_SYMBOLS = [("AAPL", 150.0), ("TSLA", 200.0)]
