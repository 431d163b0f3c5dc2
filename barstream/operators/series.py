"""Ordered windows over series of any length.

``Window.partitionBy("symbol")`` puts one symbol into one task.  That is the
right plan while every symbol is short, and the wrong one when a single symbol
holds a large share of a table.  ``measure_series`` looks at the row counts
first and decides:

* all series short: the ordinary window, one shuffle, nothing else;
* some series long: their time axis is cut into chunks of about ``max_rows``
  rows.  Rows near a cut are copied into the neighbouring chunk (``back`` rows
  before it, ``ahead`` rows after it), so bounded frames, ``lag`` and ``lead``
  see exactly the rows they would see in the whole series.  Copies are dropped
  afterwards.  Ranks and running totals, whose frame is unbounded, are finished
  with per-chunk totals.

Both plans give the same values; no row is capped or sampled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.storage import cut_lineage

# A task sorts this many narrow rows comfortably in one executor's memory.
MAX_SERIES_ROWS = 1_000_000
# Above this many entries the cut table is joined by shuffle, not broadcast.
MAX_BROADCAST_SPANS = 500_000

_SECOND = 1_000_000
_WIDTHS = [30 * 86_400 * _SECOND, 86_400 * _SECOND, 3_600 * _SECOND,
           60 * _SECOND, _SECOND, 1_000, 1]

CHUNK, MINE = "_chunk", "_mine"


def _micros(df: DataFrame, order: str) -> Column:
    if isinstance(df.schema[order].dataType, T.DateType):
        return F.unix_date(order).cast("long") * F.lit(86_400 * _SECOND)
    return F.unix_micros(F.col(order).cast("timestamp"))


def time_bucket(df: DataFrame, order: str, width: int) -> Column:
    return F.floor(_micros(df, order) / F.lit(width)).cast("long")


def prefix_sums(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over all rows before, by the columns ``order``.

    Two levels, so that no task gets all rows: range partitions with their totals (one number a partition comes to the
    driver), then running sums within each. The partitions are stored, so both steps see the same ones.
    """
    part = cut_lineage(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    totals = sorted((row["_part"], row["_sum"]) for row in part.groupBy("_part").agg(F.sum(value).alias("_sum")).collect())
    starts, before = [], 0
    for number, total in totals:
        starts.append((number, before))
        before += total or 0
    starts = rows.sparkSession.createDataFrame(starts, "_part int, _start long")
    earlier = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return part.join(F.broadcast(starts), "_part").withColumn(
        name, F.col("_start") + F.coalesce(F.sum(value).over(earlier), F.lit(0))).drop("_part", "_start")


@dataclass(frozen=True)
class SeriesLayout:
    """Result of measuring a table of series; also the way to window over it."""

    key: str
    order: tuple[str, ...]
    spans: DataFrame | None = None
    width: int = 0
    small: bool = True

    @property
    def long(self) -> bool:
        return self.spans is not None

    @property
    def keys(self) -> list[str]:
        return [self.key, CHUNK] if self.long else [self.key]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def spread(self, df: DataFrame) -> DataFrame:
        """Assign rows to chunks, copying those a neighbour needs."""
        if not self.long:
            return df
        spans = F.broadcast(self.spans) if self.small else self.spans
        bucketed = df.withColumn("_bucket", time_bucket(df, self.order[0], self.width))
        return (
            bucketed.join(spans, [self.key, "_bucket"], "left")
            .withColumn(CHUNK, F.explode(F.coalesce("_targets", F.array(F.lit(0).cast("long")))))
            .withColumn(MINE, F.col(CHUNK) == F.coalesce("_own", F.lit(0)))
            .drop("_bucket", "_own", "_targets")
        )

    def settle(self, df: DataFrame, keep_chunk: bool = False) -> DataFrame:
        """Drop the copies (and, unless asked, the chunk number)."""
        if not self.long:
            return df
        df = df.filter(MINE).drop(MINE)
        return df if keep_chunk else df.drop(CHUNK)

    def _with_offsets(self, df: DataFrame, sums: dict[str, Column]) -> DataFrame:
        """Add ``<name>_before`` (earlier chunks) and ``<name>_total`` per series.

        ``df`` is already distributed by (key, chunk), so only the per-chunk
        totals, one row per chunk, are shuffled.
        """
        ordered = Window.partitionBy(self.key).orderBy(CHUNK)
        earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy(self.key)
        totals = df.groupBy(*self.keys).agg(*[c.alias(n) for n, c in sums.items()])
        totals = totals.select(
            *self.keys,
            *[F.sum(n).over(earlier).alias(f"{n}_before") for n in sums],
            *[F.sum(n).over(whole).alias(f"{n}_total") for n in sums],
        )
        # Left join: rows without a key are never cut, so nothing comes before them.
        return df.join(totals, self.keys, "left").fillna(0, [f"{n}_before" for n in sums])

    def with_percent_rank(self, df: DataFrame, name: str) -> DataFrame:
        """``percent_rank`` over the whole series; ``df`` holds no copies."""
        if not self.long:
            return df.withColumn(name, F.percent_rank().over(self.window()))
        df = self._with_offsets(df, {"_n": F.count(F.lit(1))})
        rank = F.rank().over(self.window()) + F.col("_n_before") - 1
        share = F.when(F.col("_n_total") > 1, rank / (F.col("_n_total") - 1)).otherwise(F.lit(0.0))
        return df.withColumn(name, share.cast("double")).drop("_n_before", "_n_total")

    def with_running_sums(self, df: DataFrame, sums: dict[str, Column]) -> DataFrame:
        """Running sum from the start of the series; copies of rows count as 0.

        Terms must be whole numbers so that the order of adding cannot matter.
        """
        running = self.window().rowsBetween(Window.unboundedPreceding, 0)
        if not self.long:
            return df.withColumns({n: F.sum(c).over(running) for n, c in sums.items()})
        df = df.withColumns({f"_t_{n}": c * F.col(MINE).cast("long") for n, c in sums.items()})
        df = self._with_offsets(df, {f"_s_{n}": F.sum(f"_t_{n}") for n in sums})
        df = df.withColumns(
            {n: F.sum(f"_t_{n}").over(running) + F.col(f"_s_{n}_before") for n in sums})
        return df.drop(*[f"_t_{n}" for n in sums],
                       *[f"_s_{n}_{end}" for n in sums for end in ("before", "total")])


def order_columns(df: DataFrame, order: str = "timestamp") -> tuple[str, ...]:
    """Time first; expanded history is told apart by its replica number."""
    return (order, "replica") if "replica" in df.columns else (order,)


def all_short(rows: DataFrame, key: str = "symbol", max_rows: int = MAX_SERIES_ROWS) -> bool:
    """Whether no key has more than ``max_rows`` rows."""
    most = rows.groupBy(key).count().agg(F.max("count")).first()[0]
    return most is None or most <= max_rows


def measure_series(
    df: DataFrame,
    back: int,
    ahead: int = 0,
    key: str = "symbol",
    order: str = "timestamp",
    max_rows: int = MAX_SERIES_ROWS,
    bound: DataFrame | None = None,
) -> SeriesLayout:
    """Count rows per series and lay long ones out in chunks.

    The counting job reads only key and time and combines on the map side, so
    its shuffle carries one number per key and map task.  Where ``df`` is costly to
    compute, ``bound`` is a table with at least as many rows of every key: if that has
    no long series, ``df`` has none and is not computed for counting.
    """
    columns = order_columns(df, order)
    if bound is not None and all_short(bound, key, max_rows):
        return SeriesLayout(key, columns)
    time = _micros(df, order)
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), (F.max(time) - F.min(time)).alias("span"))
    longest = per_key.agg(F.max(F.struct("n", "span"))).first()[0]
    if longest is None or longest["n"] <= max_rows:
        return SeriesLayout(key, columns)

    # Start with a bucket that would do if the longest series were spread evenly.
    fitting = [w for w in _WIDTHS if longest["n"] * w <= max_rows * longest["span"]]
    for width in fitting or _WIDTHS[-1:]:
        counts = df.groupBy(key, time_bucket(df, order, width).alias("_bucket")).agg(
            F.count(F.lit(1)).alias("_n"))
        if counts.agg(F.max("_n")).first()[0] <= max_rows:
            break

    by_time = Window.partitionBy(key).orderBy("_bucket")
    spans = (
        counts
        .withColumn("_end", F.sum("_n").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_all", F.sum("_n").over(Window.partitionBy(key)))
        .filter(F.col("_all") > max_rows)
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("_own", F.floor(F.col("_start") / F.lit(max_rows)).cast("long"))
    )
    # Later chunks that begin fewer than ``back`` rows after a bucket need it as
    # lead-in; earlier ones that end fewer than ``ahead`` rows before it, as tail.
    targets = [F.array("_own")]
    if back > 0:
        soon = Window.partitionBy(key).orderBy("_start").rangeBetween(0, back - 1)
        spans = spans.withColumn("_later", F.collect_set("_own").over(soon))
        targets.append(F.coalesce(F.lead("_later").over(by_time), F.array().cast("array<long>")))
    if ahead > 0:
        just = Window.partitionBy(key).orderBy("_end").rangeBetween(-(ahead - 1), 0)
        spans = spans.withColumn("_earlier", F.collect_set("_own").over(just))
        targets.append(F.coalesce(F.lag("_earlier").over(by_time), F.array().cast("array<long>")))
    spans = spans.withColumn("_targets", F.array_distinct(F.flatten(F.array(*targets))))
    spans = cut_lineage(spans.select(key, "_bucket", "_own", "_targets"))
    return SeriesLayout(key, columns, spans, width, spans.count() <= MAX_BROADCAST_SPANS)
