import math

import pytest
from pyspark.sql import functions as F

from barstream import schemas as S
from barstream.operators import aggregates, features, metrics, models
from barstream.plans.live import score_history
from barstream.plans.sweep import scaling_sweep, sweep_table
from barstream.plans.training import run_training, stored_features
from barstream.sources import fixtures


@pytest.fixture(scope="module")
def bars(spark, sf):
    df = fixtures.bars(spark, sf).persist()
    df.count()
    return df


@pytest.fixture(scope="module")
def train(bars):
    return stored_features(bars, max_return=10.0)


def test_first_and_last_bar_of_a_symbol_vanish(bars, train):
    edges = bars.groupBy("symbol").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    assert train.join(edges, "symbol").filter("timestamp = a OR timestamp = b").count() == 0


def test_split_is_disjoint_and_ordered(train):
    early, late = features.time_split(train)
    assert early.count() + late.count() == train.count()
    e = early.groupBy("symbol").agg(F.max("timestamp").alias("e"))
    l = late.groupBy("symbol").agg(F.min("timestamp").alias("l"))
    assert e.join(l, "symbol").filter("e >= l").count() == 0


def test_boundary_return_is_kept(spark):
    rows = [("A", i, c) for i, c in enumerate([100.0, 125.0, 93.75, 200.0, 1.0, 1.5])]
    df = spark.createDataFrame(rows, "symbol string, i int, Close double").withColumns(
        {"timestamp": F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")),
         "Open": F.col("Close"), "High": F.col("Close"), "Low": F.col("Close"), "Volume": F.lit(1)})
    got = features.train_features(df.select(*S.BAR_COLUMNS))
    # 125 -> 93.75 is exactly -25%; 100 -> 125 goes with the first bar; a close of 1 is too low.
    assert [r["Target_Return"] for r in got.collect()] == [-0.25]
    assert got.first()["Split_Rank"] == 1.0


def test_random_draws_do_not_depend_on_partitioning(bars):
    a, b = (models.random_split(df)[0] for df in (bars.repartition(3), bars.repartition(11, "Close")))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert 0.77 < a.count() / bars.count() < 0.83
    assert 0.47 < models.sample_train(bars, 0.5).count() / bars.count() < 0.53
    assert models.sample_train(bars, 1.0) is bars


def test_size_guard(train):
    low = aggregates.choose_fraction(train, 14, limit_gb=1e-9).first()
    assert low["fraction"] == 0.75 and low["estimated_gb"] == pytest.approx(
        train.count() * 14 * 8 / 2 ** 30 * 2.5)
    assert aggregates.choose_fraction(train, 14).first()["fraction"] == 1.0


def test_lasso_variants(bars, train):
    model = models.fit_lasso(train)
    assert len(model.coefficients) == 7
    price = models.fit_lasso(features.price_features(bars), price=True)
    assert len(price.coefficients) == 11
    columns = ["Open", "High", "Low", "Close", "Volume", "MA_10", "Volatility"]
    sums = set()
    from pyspark.ml.regression import LinearRegression

    linear = LinearRegression(labelCol="Target_Price", maxIter=5).fit(
        models.assemble(features.price_features(bars), columns))
    for n in (1, 6):
        scored = score_history(bars.repartition(n), linear, columns)
        sums.add(round(aggregates.score_checksum(scored).first()[0], 2))
    assert len(sums) == 1


def test_trees_and_live_scoring(spark, bars, train):
    from barstream.operators.indicators import live_features
    from barstream.operators.signals import tree_score

    model = models.fit_gbt(train, maxIter=2)
    scored = tree_score(live_features(bars), model)
    low, high = scored.agg(F.min("probability_up"), F.max("probability_up")).first()
    assert 0.0 <= low <= high <= 1.0 and low < high
    assert scored.count() == bars.count()
    balanced = models.fit_gbt(train, "balanced", maxIter=2)
    assert balanced.getWeightCol() == "class_weight"
    weights = models.class_weights(train).groupBy("Target_Direction").agg(
        F.sum("class_weight").alias("w")).collect()
    assert weights[0]["w"] == pytest.approx(weights[1]["w"])


def test_training_job_and_sweep(bars):
    result = run_training(bars, max_return=10.0, maxIter=2)
    report = result["report"].first()
    assert report["mode"] == "parallel" and report["fraction"] == 1.0
    assert 0.0 <= report["gbt_accuracy"] <= 1.0 and report["train_rows"] > report["test_rows"]
    reports = scaling_sweep(bars, (1.0,), max_return=10.0, maxIter=1)
    table = sweep_table(reports, 4).collect()
    assert len(table) == 1 and table[0]["speedup_x"] > 0
    assert table[0]["efficiency"] == pytest.approx(table[0]["speedup_x"] / 4)


def test_trees_do_not_store_node_ids(train):
    """The same trees, without a stored node id a row and level."""
    model, storing = models.fit_gbt(train, maxIter=2), models.fit_gbt(train, maxIter=2, cacheNodeIds=True)
    assert not model.getCacheNodeIds()
    assert model.toDebugString.split("\n", 1)[1] == storing.toDebugString.split("\n", 1)[1]


def test_sweep_builds_features_once(bars, monkeypatch):
    calls = []
    count = lambda *args, **options: calls.append(args) or stored_features(*args, **options)
    monkeypatch.setattr("barstream.plans.training.stored_features", count)
    monkeypatch.setattr("barstream.plans.sweep.stored_features", count, raising=False)
    reports = scaling_sweep(bars, (0.5, 1.0), max_return=10.0, maxIter=1)
    assert reports.count() == 4 and len(calls) == 1


def test_moments_of_the_certificate(spark):
    """All covariances in one pass of matrices, whatever the partitions; rows with a gap are left out."""
    rows = [(float(i), i * i / 7.0, None if i % 5 == 0 else 1e6 + i % 3) for i in range(60)] + [(float("nan"), 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, y double").repartition(7)
    n, means, products = models._moments(df, ["a", "b", "y"])
    whole = df.dropna()
    pairs = [(i, j) for i in range(3) for j in range(3)]
    row = whole.agg(F.count("y"), *[F.avg(c) for c in "aby"], *[F.covar_pop("aby"[i], "aby"[j]) for i, j in pairs]).first()
    assert n == row[0] == 48
    assert list(means) == pytest.approx(row[1:4])
    assert [products[i, j] / n for i, j in pairs] == pytest.approx(row[4:], rel=1e-9)


def test_auc_with_ties_against_pairs(spark):
    rows = [(float(y), s / 10) for y, s in [(1, 9), (0, 9), (1, 7), (1, 5), (0, 5), (0, 5), (0, 2), (1, 2)]]
    wins = [(1.0 if p > n else 0.5 if p == n else 0.0)
            for y, p in rows if y == 1 for z, n in rows if z == 0]
    df = spark.createDataFrame(rows, "y double, p double")
    assert metrics.roc_auc(df, "y", "p").first()[0] == pytest.approx(sum(wins) / len(wins))


def test_one_class_gives_nan(spark):
    df = spark.createDataFrame([(1.0, 0.4), (1.0, 0.6)], "y double, p double")
    assert math.isnan(metrics.roc_auc(df, "y", "p").first()[0])
    assert math.isnan(metrics.log_loss(df, "y", "p").first()[0])


def test_log_loss_is_clipped(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0), (0.0, 0.5)], "y double, p double")
    assert metrics.log_loss(df, "y", "p").first()[0] == pytest.approx(math.log(2) / 3)


def test_run_tables(spark):
    runs = spark.createDataFrame([("serial", 0.5, 8.0), ("parallel", 0.5, 2.0), ("serial", 1.0, 9.0)],
                                 "mode string, fraction double, total_time double")
    got = metrics.pair_runs(runs, 8).collect()
    assert [(r["speedup_x"], r["efficiency"]) for r in got] == [(4.0, 0.5)]
    cores = spark.createDataFrame([("s", 1, 6.0), ("s", 2, 4.0)], "suite string, cores int, time_s double")
    assert [(r["speedup"], r["efficiency"]) for r in metrics.core_scaling(cores).orderBy("cores").collect()] == [
        (1.0, 1.0), (1.5, 0.75)]
