"""Trees grown in one stage against MLlib's own, on rows made here."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import functions as F

from barstream.operators import boosting, models

COLUMNS = ["a", "b", "c", "d", "e"]


def _rows(spark, n, parts):
    """Values that repeat, zeros, a constant, a column of few values; the label follows two of them and noise."""
    noise = lambda k, m: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(m))
    df = spark.range(0, n, 1, parts).select(
        "id", (noise(1, 1000) / 7).alias("a"), (F.greatest(noise(2, 900) - 300, F.lit(0)) / 3).alias("b"),
        noise(3, 4).cast("double").alias("c"), F.lit(1.5).alias("d"), (noise(4, 100_000) / 1e3 - 50).alias("e"))
    up = (F.col("a") / 70 + F.col("e") / 50 + F.col("c") / 4 + noise(5, 1000) / 500) > 3.0
    return df.withColumn("Target_Direction", up.cast("double"))


def _trees(model):
    """Per tree its weight and, node by node in order, the split or the prediction."""
    out = []

    def walk(node):
        inner = "InternalNode" in node.getClass().getName()
        split = (node.split().featureIndex(), node.split().threshold(), node.gain()) if inner else (-1, 0.0, 0.0)
        out.append((*split, node.prediction(), node.impurity()))
        if inner:
            walk(node.leftChild())
            walk(node.rightChild())

    for tree in model._java_obj.trees():
        walk(tree.rootNode())
    return np.array(out), list(model.treeWeights)


def _same(one, other):
    (nodes, weights), (other_nodes, other_weights) = _trees(one), _trees(other)
    assert weights == other_weights and nodes.shape == other_nodes.shape
    assert np.array_equal(nodes[:, 0], other_nodes[:, 0])
    assert np.allclose(nodes, other_nodes, rtol=1e-7, atol=1e-9)


@pytest.mark.parametrize("tasks", [1, 4])
@pytest.mark.parametrize("preset", ["main", "leaves_31", "balanced"])
def test_trees_are_those_of_mllib(spark, monkeypatch, preset, tasks):
    rows = _rows(spark, 6000, 3).withColumn("b", F.when(F.col("id") % 50 != 0, F.col("b")))  # rows with a gap are left out
    monkeypatch.setattr(boosting, "TASK_ROWS", 6000 // tasks)
    got = models.fit_gbt(rows, preset, COLUMNS, maxIter=3)
    monkeypatch.setattr(models, "fit_boosted", lambda *args: None)
    expected = models.fit_gbt(rows, preset, COLUMNS, maxIter=3)
    _same(got, expected)
    assert got.extractParamMap().keys() and got.getMaxIter() == 3 and got.numFeatures == len(COLUMNS)
    assert np.allclose(got.featureImportances.toArray(), expected.featureImportances.toArray())


def test_partitions_of_several_blocks(spark):
    """Draws go on from block to block of a partition."""
    rows = _rows(spark, boosting.BLOCK_ROWS * 2 + 900, 1)
    settings = dict(maxIter=2, maxDepth=5, subsamplingRate=0.3, featureSubsetStrategy="0.5", minInstancesPerNode=3)
    estimator = GBTClassifier(featuresCol="features", labelCol="Target_Direction", seed=7, **settings)
    _same(boosting.fit_boosted(estimator, rows, COLUMNS), estimator.fit(models.assemble(rows, COLUMNS)))


def test_nodes_of_one_label_are_leaves(spark):
    rows = _rows(spark, 3000, 2).withColumn("Target_Direction", (F.col("c") >= 2).cast("double"))
    estimator = GBTClassifier(featuresCol="features", labelCol="Target_Direction", seed=7, maxIter=1)
    model = boosting.fit_boosted(estimator, rows, COLUMNS)
    _same(model, estimator.fit(models.assemble(rows, COLUMNS)))
    assert len(_trees(model)[0]) == 3


def test_jobs_do_not_grow_with_rounds(spark):
    rows = _rows(spark, 2000, 2).persist()

    def jobs(rounds):
        spark.sparkContext.setJobGroup(f"fit-{rounds}", "")
        models.fit_gbt(rows, "leaves_31", COLUMNS, maxIter=rounds)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{rounds}"))

    few, many = jobs(2), jobs(12)
    spark.sparkContext._jsc.sc().clearJobGroup()
    assert many < few + 5
    rows.unpersist()


def test_what_is_left_to_mllib(spark):
    rows = _rows(spark, 300, 2)
    estimator = GBTClassifier(labelCol="Target_Direction", maxIter=1, seed=1)
    assert boosting.fit_boosted(estimator.copy({estimator.maxDepth: 20}), rows, COLUMNS) is None
    assert boosting.fit_boosted(estimator.copy({estimator.featureSubsetStrategy: "sqrt"}), rows, COLUMNS) is None
    assert boosting.fit_boosted(estimator, rows.withColumn("Target_Direction", F.lit(2.0)), COLUMNS) is None
    assert boosting.fit_boosted(estimator, rows.filter("id < 0"), COLUMNS) is None


def test_model_can_be_stored_and_read(spark, tmp_path):
    rows = _rows(spark, 500, 2)
    model = models.fit_gbt(rows, "leaves_31", COLUMNS, maxIter=2)
    models.save_model(model, str(tmp_path / "m"), COLUMNS)
    again = models.load_model(spark, GBTClassificationModel, str(tmp_path / "m"), COLUMNS)
    _same(model, again)
    assert models.predict(again, rows, COLUMNS).filter("prediction IN (0, 1)").count() == 500
