"""Queries for filters, cleaning, scalar helpers and expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from barstream.functions import numeric as N
from barstream.functions import text as X_text
from barstream import schemas as S
from barstream.operators import cleaning, expansion
from barstream.operators.features import rolling_features
from barstream.queries import blocks as B
from barstream.queries.shape import shaped, shaped_sql
from barstream.sources import fixtures as X
from barstream.sources.readers import list_symbols

QUERIES, ORACLE = {}, {}


def p1_min_price(spark, sf):
    df = cleaning.min_price_filter(rolling_features(X.bars(spark, sf)), 1000.0)
    return shaped(df, "symbol timestamp@ Close Next_Close")


ORACLE["p1_min_price"] = shaped_sql(
    B.FEATURES, "rolling", "symbol timestamp@ Close Next_Close",
    'WHERE "Close" > 1000 AND "Next_Close" > 1000')


def p2_bound_target(spark, sf):
    df = cleaning.min_price_filter(rolling_features(X.bars(spark, sf)))
    df = df.withColumn("Target_Return", (F.col("Next_Close") - F.col("Close")) / F.col("Close"))
    return shaped(cleaning.bound_target(df), "symbol timestamp@ Target_Return~8")


ORACLE["p2_bound_target"] = shaped_sql(
    B.training(0.25), "ranked", "symbol timestamp@ Target_Return~8")


def _holes(spark, sf):
    """Bars with missing and non-finite values by volume."""
    last = F.col("Volume") % 10
    return X.bars(spark, sf).withColumn(
        "Close", F.when(last == 0, F.lit(float("nan"))).when(last == 1, F.lit(float("inf")))
        .when(last == 2, F.lit(float("-inf"))).when(last == 3, F.lit(None)).otherwise(F.col("Close")))


def p3_clean_features(spark, sf):
    return shaped(cleaning.clean_features(_holes(spark, sf)), "symbol timestamp@ Close Volume#")


ORACLE["p3_clean_features"] = shaped_sql(
    B.BARS, "bars", "symbol timestamp@ Close Volume#", 'WHERE "Volume" % 10 > 3')


def p4_drop_incomplete(spark, sf):
    last = F.col("Volume") % 10
    text = F.when(last == 1, F.lit("not a day")).otherwise(
        F.date_format("timestamp", "yyyy-MM-dd"))
    bars = X.bars(spark, sf).withColumn("timestamp", text).withColumn(
        "Open", F.when(last == 2, F.lit(None)).otherwise(F.col("Open")))
    return shaped(cleaning.drop_incomplete_bars(bars), "symbol timestamp@ Open")


ORACLE["p4_drop_incomplete"] = shaped_sql(
    B.BARS, "bars", "symbol timestamp@ Open", 'WHERE "Volume" % 10 NOT IN (1, 2)')


def p6_limit_symbols(spark, sf):
    bars = X.bars(spark, sf)
    return shaped(cleaning.limit_symbols(bars, list_symbols(bars), 25), "symbol timestamp@ Close")


ORACLE["p6_limit_symbols"] = shaped_sql(
    B.BARS, "bars", "symbol timestamp@ Close",
    "WHERE symbol IN (SELECT DISTINCT symbol FROM bars ORDER BY symbol LIMIT 25)")


def p8_scalar_math(spark, sf):
    o, c, v = F.col("Open"), F.col("Close"), F.col("Volume")
    df = X.bars(spark, sf).select(
        "symbol", "timestamp",
        N.ratio_or(c - o, v % 5, -1.0).alias("guarded"),
        N.change_or_zero(c, o).alias("change"),
        N.clamp((c - o) / o, 0.1).alias("clamped"),
        N.truncate((c - o) / 10).alias("truncated"),
        F.abs(c - o).alias("gap"), F.greatest(o, c).alias("top"), F.least(o, c).alias("bottom"))
    return shaped(df, "symbol timestamp@ guarded~6 change~6 clamped~6 truncated# gap top bottom")


ORACLE["p8_scalar_math"] = shaped_sql(
    B.BARS + """, math AS (SELECT symbol, "timestamp",
  CASE WHEN "Volume" % 5 <> 0 THEN ("Close" - "Open") / ("Volume" % 5) ELSE -1.0 END AS guarded,
  ("Close" - "Open") / "Open" AS change,
  greatest(-0.1, least(0.1, ("Close" - "Open") / "Open")) AS clamped,
  trunc(("Close" - "Open") / 10) AS truncated, abs("Close" - "Open") AS gap,
  greatest("Open", "Close") AS top, least("Open", "Close") AS bottom FROM bars)""",
    "math", "symbol timestamp@ guarded~6 change~6 clamped~6 truncated# gap top bottom")


def p9_date_shift(spark, sf):
    df = X.bars(spark, sf).withColumn("shifted", F.date_add("timestamp", F.lit(3 * 365)))
    return shaped(df, "symbol timestamp@ shifted@")


ORACLE["p9_date_shift"] = shaped_sql(
    B.BARS + ', moved AS (SELECT *, "timestamp" + INTERVAL 1095 DAY AS shifted FROM bars)',
    "moved", "symbol timestamp@ shifted@")


def p10_text(spark, sf):
    df = X.table(spark, sf, "events").select(
        "event_id",
        X_text.clean_symbol(F.concat(F.lit("  "), F.col("event_type"), F.lit(" "))).alias("code"),
        X_text.money(F.col("event_id") * 1000 + F.lit(0.25)).alias("money"),
        X_text.percent(F.col("event_id") / 4 * 2, 1).alias("share"),
        X_text.trade_line(F.col("event_type"), F.lit("BOUGHT 1")).alias("line"),
        F.concat_ws(", ", F.when(F.col("value") > 10, "high"),
                    F.when(F.col("value") < 50, "low")).alias("notes"))
    return df


ORACLE["p10_text"] = """
SELECT event_id, upper(event_type) AS code,
  '$' || format('{:,}', event_id * 1000) || '.25' AS money,
  printf('%.1f', event_id / 4.0 * 2) || '%' AS share,
  '[' || event_type || '] BOUGHT 1' AS line,
  concat_ws(', ', CASE WHEN value > 10 THEN 'high' END, CASE WHEN value < 50 THEN 'low' END) AS notes
FROM events"""


def j5_watch_list(spark, sf):
    supplier = X.table(spark, sf, "supplier").filter(F.col("s_nationkey") < 5)
    watched = supplier.select(F.col("s_suppkey").cast("string").alias("symbol"))
    return shaped(cleaning.watch_list(X.bars(spark, sf), watched), "symbol timestamp@ Close")


ORACLE["j5_watch_list"] = shaped_sql(
    B.BARS, "bars", "symbol timestamp@ Close",
    "WHERE symbol IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_nationkey < 5)")

_E1 = "symbol replica# bars# first_day@ last_day@ volume#"


def e1_expand_history(spark, sf):
    expanded = expansion.expand_history(X.bars(spark, sf))
    return shaped(expanded.groupBy("symbol", "replica").agg(
        F.count(F.lit(1)).alias("bars"), F.min("timestamp").alias("first_day"),
        F.max("timestamp").alias("last_day"), F.sum("Volume").alias("volume")), _E1)


ORACLE["e1_expand_history"] = shaped_sql(
    B.BARS + """, expanded AS (SELECT symbol, k AS replica, "Volume",
  "timestamp" + to_days(CAST(365 * k AS INTEGER)) AS day FROM bars, range(1, 16) AS r(k)),
sums AS (SELECT symbol, replica, count(*) AS bars, min(day) AS first_day, max(day) AS last_day,
  sum("Volume") AS volume FROM expanded GROUP BY 1, 2)""", "sums", _E1)


_E2 = "symbol bars# broken# below_floor# far_off# off_mean# off_spread# tied#"


def e2_noise(spark, sf):
    """Noisy, repaired candles: how many per symbol break a rule of the step, and whether the noise of prices far from
    the floor has mean 0 and deviation 0.5 and differs between prices, within five standard errors."""
    expanded = expansion.expand_history(X.bars(spark, sf)).withColumns({"clean": F.col("Close"), "clean_open": F.col("Open")})
    noisy = expansion.repair_ohlc(expansion.add_noise(expanded))
    low, high = F.col("Low"), F.col("High")
    far = (F.col("clean") > 10) & (F.col("clean_open") > 10)
    noise, noise_open = F.when(far, F.col("Close") - F.col("clean")), F.when(far, F.col("Open") - F.col("clean_open"))

    def _beyond(distance, deviation):
        return (distance > 5 * deviation / F.sqrt(F.count(noise))).cast("int")

    broken = (low > F.least("Open", "Close")) | (high < F.greatest("Open", "Close")) | (low > high)
    return shaped(noisy.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"), F.count_if(broken).alias("broken"),
        F.count_if(low < 1.0).alias("below_floor"),
        F.count_if(F.abs(F.col("Close") - F.greatest(F.lit(1.0), F.col("clean"))) > 5.0)
        .alias("far_off"),
        _beyond(F.abs(F.avg(noise)), S.NOISE_SIGMA).alias("off_mean"),
        _beyond(F.abs(F.stddev_samp(noise) - S.NOISE_SIGMA), S.NOISE_SIGMA / 2 ** 0.5).alias("off_spread"),
        _beyond(F.abs(F.corr(noise, noise_open)), 1.0).alias("tied")), _E2)


ORACLE["e2_noise"] = shaped_sql(
    B.BARS + """, sums AS (SELECT symbol, 15 * count(*) AS bars, 0 AS broken, 0 AS below_floor,
  0 AS far_off, 0 AS off_mean, 0 AS off_spread, 0 AS tied FROM bars GROUP BY 1)""", "sums", _E2)


def e3_repair(spark, sf):
    """Candles whose High and Low were swapped."""
    bars = X.bars(spark, sf)
    swapped = bars.withColumns({"High": F.col("Low"), "Low": F.col("High")})
    return shaped(expansion.repair_ohlc(swapped), "symbol timestamp@ Open High Low Close")


ORACLE["e3_repair"] = shaped_sql(
    B.BARS + """, repaired AS (SELECT symbol, "timestamp", "Open", "High",
  least("Open", "Close") AS "Low", "Close" FROM bars)""", "repaired", "symbol timestamp@ Open High Low Close")

QUERIES.update({f.__name__: f for f in (
    p1_min_price, p2_bound_target, p3_clean_features, p4_drop_incomplete, p6_limit_symbols,
    p8_scalar_math, p9_date_shift, p10_text, j5_watch_list, e1_expand_history, e2_noise,
    e3_repair)})
