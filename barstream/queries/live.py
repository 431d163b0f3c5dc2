"""Queries for live indicators, scoring, replay accuracy and serving views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.operators import features, indicators, replay, signals, views
from barstream.operators.models import fit_gbt
from barstream.params import JobParams
from barstream.plans.live import replayed_bars, scored_bars, signal_records
from barstream.plans.training import stored_features
from barstream.queries import blocks as B
from barstream.queries.shape import half_up, shaped, shaped_sql
from barstream.sources import fixtures as X

QUERIES, ORACLE = {}, {}

NO_MACD = JobParams(use_macd=False, volume_threshold=100.0, shock_threshold=5000.0)
FULL = JobParams(volume_threshold=100.0, shock_threshold=5000.0)


def _live(name: str, columns: str, params: JobParams = NO_MACD) -> None:
    shape = f"symbol timestamp@ {columns}"
    QUERIES[name] = lambda spark, sf: shaped(
        indicators.live_features(X.bars(spark, sf), params), shape)
    ORACLE[name] = shaped_sql(B.LIVE, "live", shape)


_live("l1_sma", "sma~6")
_live("l2_ma_10_30", "ma_10~6 ma_30~6")
_live("l3_vol_ma_10", "vol_ma_10~6")
_live("l5_prev_price", "prev_price")
_live("l6_momentum_1", "momentum_1~7")
_live("l7_momentum_5", "momentum_5~7")
_live("l8_close_norm", "close_norm~6")
_live("l9_volume_norm", "volume_norm~6")
_live("l10_ma_ratio", "ma_ratio~7")
_live("l11_rsi", "rsi~6")


def l13_macd(spark, sf):
    return shaped(indicators.macd(X.bars(spark, sf)),
                  "symbol timestamp@ macd_line~4 macd_signal~4 macd_histogram~4")


ORACLE["l13_macd"] = shaped_sql(
    B.MACD, "full_live", "symbol timestamp@ macd_line~4 macd_signal~4 macd_histogram~4")


def l12_live_features(spark, sf):
    """Every live column at once, averages included."""
    return shaped(indicators.live_features(X.bars(spark, sf)),
                  "symbol timestamp@ sma~6 ma_10~6 rsi~6 close_norm~6 macd_line~4 macd_signal~4")


ORACLE["l12_live_features"] = shaped_sql(
    B.MACD, "full_live",
    "symbol timestamp@ sma~6 ma_10~6 rsi~6 close_norm~6 macd_line~4 macd_signal~4")


def l14_toggles(spark, sf):
    off = JobParams(use_rsi=False, use_macd=False)
    return shaped(indicators.live_features(X.bars(spark, sf), off),
                  "symbol timestamp@ ma_10~6 rsi~2 macd_line~2 macd_signal~2 macd_histogram~2")


ORACLE["l14_toggles"] = shaped_sql(
    B.LIVE + """, off AS (SELECT symbol, "timestamp", ma_10, 50.0 AS rsi, 0.0 AS macd_line,
  0.0 AS macd_signal, 0.0 AS macd_histogram FROM live)""", "off",
    "symbol timestamp@ ma_10~6 rsi~2 macd_line~2 macd_signal~2 macd_histogram~2")


def _predictions(bars: DataFrame) -> DataFrame:
    """A classifier result for four bars out of five."""
    return bars.filter(F.col("Volume") % 5 != 0).select(
        "symbol", "timestamp", ((F.col("Volume") % 101) / 100).alias("probability_up"))


_P = 'CASE WHEN "Volume" % 5 <> 0 THEN ("Volume" % 101) / 100.0 END'


def _with_predictions(spark, sf, params: JobParams = NO_MACD) -> DataFrame:
    bars = X.bars(spark, sf)
    live = signals.attach_predictions(
        indicators.live_features(bars, params), _predictions(bars))
    return signals.score_signals(live, B.WEIGHTS, B.INTERCEPT, params)


def _scored(name: str, columns: str) -> None:
    shape = f"symbol timestamp@ {columns}"
    QUERIES[name] = lambda spark, sf: shaped(
        scored_bars(X.bars(spark, sf), B.WEIGHTS, B.INTERCEPT, NO_MACD, bound=X.bar_rows(spark, sf)), shape)
    ORACLE[name] = shaped_sql(B.scored("live", B.LIVE), "scored", shape)


_scored("m1_linear_score", "score_raw~7")
_scored("m2_clamp", "score~7")
_scored("m3_target_price", "target_price~2")
_scored("m9_anomaly", "anomaly")


def _judged(name: str, columns: str, threshold: int = 0) -> None:
    shape = f"symbol timestamp@ {columns}"
    params = JobParams.from_mapping({**vars(NO_MACD), "min_ai_confidence": threshold})
    QUERIES[name] = lambda spark, sf: shaped(_with_predictions(spark, sf, params), shape)
    ORACLE[name] = shaped_sql(
        B.scored("live", B.LIVE, threshold=threshold, probability=_P), "scored", shape)


_judged("j2_attach_predictions", "probability_up~4 stale")
_judged("m5_direction", "direction~1 stale")
_judged("m6_confidence", "confidence#")
_judged("m7_signal", "signal reason", threshold=30)


def m8_explanation(spark, sf):
    return shaped(scored_bars(X.bars(spark, sf), B.WEIGHTS, B.INTERCEPT, FULL),
                  "symbol timestamp@ explanation")


_NOTES = B.scored("full_live", B.MACD) + f""", noted AS (SELECT *, concat_ws(', ',
  CASE WHEN rsi > 70 THEN printf('overbought (RSI %.0f)', {half_up("rsi", 0)})
    WHEN rsi < 30 THEN printf('oversold (RSI %.0f)', {half_up("rsi", 0)}) END,
  CASE WHEN macd_histogram > 0.1 THEN 'MACD bullish'
    WHEN macd_histogram < -0.1 THEN 'MACD bearish' END) AS notes FROM scored),
explained AS (SELECT *, 'GBT predicts ' || CASE WHEN direction = 1 THEN 'UP' ELSE 'DOWN' END
  || '. Lasso baseline: ' || printf('%+.2f', score * 100) || '% expected return.'
  || CASE WHEN notes <> '' THEN ' Technical: ' || notes || '.' ELSE '' END
  || ' Action: ' || signal || ' — ' || reason AS explanation FROM noted)"""
ORACLE["m8_explanation"] = shaped_sql(_NOTES, "explained", "symbol timestamp@ explanation")


def m7_missing_values(spark, sf):
    """Bars without volume (null or NaN) have no score: they hold, with no confidence."""
    n = F.col("Volume")
    bars = X.bars(spark, sf).withColumn("Volume", F.when(n % 5 == 1, F.lit(None)).when(
        n % 5 == 2, F.lit(float("nan"))).otherwise(n.cast("double")))
    bars = bars.withColumn("Volume", F.nanvl("Volume", F.lit(None).cast("double")))
    scored = scored_bars(bars, B.WEIGHTS, B.INTERCEPT, NO_MACD)
    missing = F.col("score").isNull()
    return shaped(scored.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"), F.count_if(missing).alias("missing"),
        F.count_if(missing & ((F.col("signal") != "HOLD") | (F.col("confidence") != 0))).alias("wrong")),
        "symbol bars# missing# wrong#")


ORACLE["m7_missing_values"] = shaped_sql(
    B.BARS + """, sums AS (SELECT symbol, count(*) AS bars,
  count(*) FILTER (WHERE "Volume" % 5 IN (1, 2)) AS missing, 0 AS wrong FROM bars GROUP BY 1)""",
    "sums", "symbol bars# missing# wrong#")


def m4_tree_score(spark, sf):
    """Trees fitted on training features, applied to live features: scores per symbol
    and how many lie outside 0..1."""
    bars = X.bars(spark, sf)
    rows = X.bar_rows(spark, sf)
    model = fit_gbt(stored_features(bars, layout=features.feature_layout(bars, bound=rows), max_return=10.0))
    live = indicators.live_features(bars, NO_MACD, indicators.live_layout(bars, NO_MACD, bound=rows))
    scored = signals.tree_score(live, model)
    p = F.col("probability_up")
    return shaped(scored.groupBy("symbol").agg(
        F.count(p).alias("scores"), F.count_if((p < 0) | (p > 1)).alias("outside")),
        "symbol scores# outside#")


ORACLE["m4_tree_score"] = shaped_sql(
    B.BARS + ", sums AS (SELECT symbol, count(*) AS scores, 0 AS outside FROM bars GROUP BY 1)",
    "sums", "symbol scores# outside#")


def _replay(name: str, columns: str) -> None:
    shape = f"symbol timestamp@ {columns}"
    QUERIES[name] = lambda spark, sf: shaped(
        replayed_bars(X.bars(spark, sf), B.WEIGHTS, B.INTERCEPT, NO_MACD, bound=X.bar_rows(spark, sf)), shape)
    ORACLE[name] = shaped_sql(B.replayed(B.scored("live", B.LIVE)), "replay", shape)


_replay("m10_replay_mae", "lasso_error~5 lasso_mae~3")
_replay("m11_replay_hit_rate", "gbt_accuracy~1 replay_total# replay_correct#")

_RECORD = ("symbol timestamp@ price~1 volume~2 sma_20~1 momentum~1 signal lasso_target~1 "
           "lasso_return~3 lasso_return_raw~3 gbt_direction gbt_probability~1 gbt_stale "
           "confidence# rsi~1 lasso_mae~1 gbt_accuracy~1 lasso_error~1 anomaly trade_executed")

_MACD_PARTS = ("line", "signal", "histogram")


def _records_sql(ctes: str, macd: bool) -> str:
    macds = ", ".join(half_up(f"macd_{part}", 4) + f" AS macd_{part}" if macd else f"0.0 AS macd_{part}" for part in _MACD_PARTS)
    return ctes + f""", records AS (
  SELECT symbol, "timestamp", {half_up('"Close"', 2)} AS price, "Volume" AS volume,
    {half_up("sma", 2)} AS sma_20, {half_up("momentum_1 * 100", 2)} AS momentum, signal,
    target_price AS lasso_target, {half_up("score * 100", 4)} AS lasso_return,
    {half_up("score_raw * 100", 4)} AS lasso_return_raw,
    CASE WHEN direction = 1 THEN 'UP' ELSE 'DOWN' END AS gbt_direction, 0.0 AS gbt_probability,
    stale AS gbt_stale, confidence, {half_up("rsi", 2)} AS rsi, lasso_mae, gbt_accuracy,
    {half_up("coalesce(lasso_error, 0.0)", 4)} AS lasso_error, anomaly,
    'None' AS trade_executed, {macds} FROM replay)"""


_RECORDS = _records_sql(B.replayed(B.scored("live", B.LIVE)), False)
_FULL_RECORDS = _records_sql(B.replayed(B.scored("full_live", B.MACD)), True)


def _records(spark, sf, params: JobParams = NO_MACD, bars: DataFrame | None = None) -> DataFrame:
    return signal_records(X.bars(spark, sf) if bars is None else bars, B.WEIGHTS, B.INTERCEPT, params, bound=X.bar_rows(spark, sf))


def m12_signal_record(spark, sf):
    """Record fields a digit short of their own rounding, so ties cannot differ."""
    return shaped(_records(spark, sf), _RECORD)


ORACLE["m12_signal_record"] = shaped_sql(_RECORDS, "records", _RECORD)


ACCOUNT = JobParams(auto_trade=True, trade_size_shares=5, volume_threshold=100.0, shock_threshold=5000.0)
_ACCOUNT = ("portfolio_id symbol timestamp@ trade_executed shares_traded# cash~2 positions throughput# "
            "macd_line~3 macd_signal~3 macd_histogram~3")


def _listed(positions: str):
    """A map of positions as text, in order of symbols."""
    entries = F.transform(F.map_entries(positions), lambda e: F.concat_ws(":", e["key"], e["value"]))
    return F.array_join(F.array_sort(entries), ",")


_ROUNDED_MACD = ", ".join(f"{half_up(f'f.macd_{part}', 4)} AS macd_{part}" for part in ("line", "signal", "histogram"))


def m12_account_record(spark, sf):
    """Records of accounts that trade three symbols each: cash, positions after every batch, batch size, MACD."""
    account = F.floor(F.col("symbol").cast("int") / 3).cast("string")
    records = signal_records(X.bars(spark, sf), B.WEIGHTS, B.INTERCEPT, ACCOUNT, account=account, bound=X.bar_rows(spark, sf))
    return shaped(records.withColumn("positions", _listed("positions")), _ACCOUNT)


ORACLE["m12_account_record"] = shaped_sql(
    B.shared_ledger(B.scored("full_live", B.MACD)) + f""", account AS (
  SELECT s.portfolio_id, s.symbol, s."timestamp", s.trade_executed, abs(s.d) AS shares_traded, s.cash,
    CASE WHEN lead(s."timestamp") OVER (PARTITION BY s.portfolio_id ORDER BY s.k) IS DISTINCT FROM s."timestamp"
      THEN list_aggregate(list_sort(list_filter([
        CASE WHEN h0 > 0 THEN (CAST(s.portfolio_id AS INTEGER) * 3) || ':' || h0 END,
        CASE WHEN h1 > 0 THEN (CAST(s.portfolio_id AS INTEGER) * 3 + 1) || ':' || h1 END,
        CASE WHEN h2 > 0 THEN (CAST(s.portfolio_id AS INTEGER) * 3 + 2) || ':' || h2 END],
        lambda x: x IS NOT NULL)), 'string_agg', ',') END AS held,
    lead(s."timestamp") OVER (PARTITION BY s.portfolio_id ORDER BY s.k) IS DISTINCT FROM s."timestamp" AS ends,
    count(*) OVER (PARTITION BY s."timestamp") AS throughput,
    {_ROUNDED_MACD}
  FROM shared s JOIN full_live f ON f.symbol = s.symbol AND f."timestamp" = s."timestamp"),
records AS (SELECT * EXCLUDE (held), CASE WHEN ends THEN coalesce(held, '') END AS positions FROM account)""",
    "records", _ACCOUNT)


def s11_write_signals(spark, sf):
    from barstream.sources.sinks import write_signals
    from barstream.storage import scratch_path

    path = scratch_path(spark, "signals")
    write_signals(_records(spark, sf), path)
    return shaped(spark.read.parquet(path), "symbol timestamp@ signal confidence#")


ORACLE["s11_write_signals"] = shaped_sql(
    _RECORDS, "records", "symbol timestamp@ signal confidence#")


def _latest(records: str) -> str:
    return records + """, latest AS (
  SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) = 1)"""


_LATEST = _latest(_RECORDS)


def a6_replay_accuracy(spark, sf):
    state = views.latest_state(_records(spark, sf))
    return shaped(replay.replay_accuracy(state),
                  "avg_lasso_mae~1 avg_gbt_accuracy~1 symbols_scored#")


_ACCURACY = _LATEST + f""", summary AS (
  SELECT coalesce({half_up("avg(lasso_mae) FILTER (lasso_mae > 0)", 4)}, 0.0) AS avg_lasso_mae,
    coalesce({half_up("avg(gbt_accuracy) FILTER (gbt_accuracy > 0)", 1)}, 0.0) AS avg_gbt_accuracy,
    count(*) FILTER (lasso_mae > 0) AS symbols_scored FROM latest)"""
ORACLE["a6_replay_accuracy"] = shaped_sql(
    _ACCURACY, "summary", "avg_lasso_mae~1 avg_gbt_accuracy~1 symbols_scored#")


def a7_edge_vs_random(spark, sf):
    state = views.latest_state(_records(spark, sf))
    return shaped(replay.edge_vs_random(replay.replay_accuracy(state)), "edge_vs_random~1")


ORACLE["a7_edge_vs_random"] = shaped_sql(
    _ACCURACY + ", edge AS (SELECT avg_gbt_accuracy - 50 AS edge_vs_random FROM summary)",
    "edge", "edge_vs_random~1")

_STATE = "symbol price~1 momentum~1 signal rsi~1 confidence# gbt_direction"


def k1_latest_state(spark, sf):
    """Suppliers without bars show the waiting state."""
    known = X.table(spark, sf, "supplier").select(
        F.explode(F.array(F.col("s_suppkey").cast("string"),
                          F.concat(F.lit("new-"), F.col("s_suppkey")))).alias("symbol"))
    return shaped(views.latest_state(_records(spark, sf), known), _STATE)


ORACLE["k1_latest_state"] = shaped_sql(
    _LATEST + """, known AS (SELECT CAST(s_suppkey AS VARCHAR) AS symbol FROM supplier
  UNION ALL SELECT 'new-' || s_suppkey FROM supplier),
state AS (SELECT k.symbol, coalesce(price, 100.0) AS price, coalesce(momentum, 0.0) AS momentum,
  coalesce(signal, 'HOLD') AS signal, coalesce(rsi, 50.0) AS rsi,
  coalesce(confidence, 0) AS confidence, coalesce(gbt_direction, 'FLAT') AS gbt_direction
  FROM known k LEFT JOIN latest l ON l.symbol = k.symbol)""", "state", _STATE)


def k2_history(spark, sf):
    return shaped(views.history(_records(spark, sf, FULL)),
                  "symbol time@ price~1 target~1 sma~1 rsi~1 macd~3")


ORACLE["k2_history"] = shaped_sql(
    _FULL_RECORDS + """, hist AS (SELECT symbol, "timestamp" AS time, price, lasso_target AS target,
  sma_20 AS sma, rsi, macd_line AS macd FROM records
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) <= 100)""",
    "hist", "symbol time@ price~1 target~1 sma~1 rsi~1 macd~3")


def k2_history_lists(spark, sf):
    lists = views.history_lists(_records(spark, sf))
    return shaped(lists.select("symbol", F.size("history").alias("points"),
                               F.col("history")[0]["time"].alias("first_day")),
                  "symbol points# first_day@")


ORACLE["k2_history_lists"] = shaped_sql(
    _RECORDS + """, hist AS (SELECT symbol, "timestamp" FROM records
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) <= 100),
lists AS (SELECT symbol, count(*) AS points, min("timestamp") AS first_day FROM hist GROUP BY 1)""",
    "lists", "symbol points# first_day@")


def k3_top_movers(spark, sf):
    state = views.latest_state(_records(spark, sf))
    return shaped(views.top_movers(state), "symbol price~1 momentum~1")


ORACLE["k3_top_movers"] = shaped_sql(
    _LATEST + """, movers AS (SELECT symbol, price, momentum FROM latest WHERE price > 0
  ORDER BY abs(momentum) DESC, symbol LIMIT 5)""", "movers", "symbol price~1 momentum~1")


_DELTA = "symbol price~1 target~1 line~3 current confidence# anomaly"


def k4_tick_delta(spark, sf):
    """Deltas as JSON text, some fields read back out of it."""
    deltas = views.to_delta_json(views.tick_delta(_records(spark, sf, FULL, X.short_bars(spark, sf))))
    paths = {"price": "$.market.price", "target": "$.market.history_point.target",
             "line": "$.indicators.macd.line", "current": "$.signals.current",
             "confidence": "$.signals.confidence", "anomaly": "$.anomalies[0]"}
    return shaped(deltas.select("symbol", *[F.get_json_object("delta", path).alias(name)
                                            for name, path in paths.items()]), _DELTA)


ORACLE["k4_tick_delta"] = shaped_sql(
    _latest(_FULL_RECORDS) + """, delta AS (SELECT symbol, price, lasso_target AS target, macd_line AS line,
  signal AS current, confidence, anomaly FROM latest)""", "delta", _DELTA)


def k5_coalesce_ticks(spark, sf):
    last = views.coalesce_ticks(X.ticks(spark, sf), "200 milliseconds")
    df = last.select(F.unix_micros("window_start").alias("window_us"), "symbol",
                     F.unix_micros("timestamp").alias("ts_us"), "Close", "Volume")
    return shaped(df, "window_us# symbol ts_us# Close~2 Volume#")


ORACLE["k5_coalesce_ticks"] = shaped_sql(
    """ticks AS (SELECT epoch_us(ts) AS us, event_type AS symbol, value,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
last AS (SELECT us // 200000 * 200000 AS window_us, symbol, max(us) AS ts_us,
  arg_max(value, us) AS "Close", arg_max(k, us) AS "Volume" FROM ticks GROUP BY 1, 2)""",
    "last", "window_us# symbol ts_us# Close~2 Volume#")

QUERIES.update({f.__name__: f for f in (
    l13_macd, l12_live_features, l14_toggles, m8_explanation, m7_missing_values, m4_tree_score, m12_signal_record, m12_account_record,
    s11_write_signals, a6_replay_accuracy, a7_edge_vs_random, k1_latest_state, k2_history,
    k2_history_lists, k3_top_movers, k4_tick_delta, k5_coalesce_ticks)})
