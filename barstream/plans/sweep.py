"""Scaling sweep: the training job at several data shares, in turn and at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from barstream import schemas as S
from barstream.operators.metrics import pair_runs
from barstream.plans.training import run_training, stored_features


def scaling_sweep(bars: DataFrame, fractions: Sequence[float] = (0.25, 0.5, 0.75, 1.0),
                  max_return: float = S.MAX_ABS_TARGET_RETURN, **options) -> DataFrame:
    """Report rows of every run, one per share and mode; all runs read the same stored features."""
    stored = stored_features(bars, max_return=max_return)
    reports = [run_training(bars, fraction, concurrent, max_return, stored, **options)["report"]
               for fraction in fractions for concurrent in (False, True)]
    return reduce(DataFrame.unionByName, reports)


def sweep_table(reports: DataFrame, cores: int) -> DataFrame:
    """The published table: paired times plus the concurrent run's quality."""
    quality = reports.filter("mode = 'parallel'").selectExpr(
        "fraction", "lasso_mse", "lasso_rmse", "lasso_r2",
        "gbt_accuracy * 100 AS gbt_accuracy_pct", "overlap_seconds", "train_rows")
    return pair_runs(reports, cores).join(quality, "fraction")
