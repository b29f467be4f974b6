"""Every registered query runs on the smallest tables and agrees with its SQL."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
import check
from stockwise import plans

SF_DIR = "/root/testdata/sf0.001"
JOBS, ORACLES = plans.all_queries(), plans.all_oracles()
FITTED = {"train_regressors", "grid_search", "recursive_forecast_model", "series_kmeans", "train_by_group"}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


def test_only_fitted_models_have_no_sql():
    assert set(JOBS) - set(ORACLES) == FITTED
    assert set(ORACLES) <= set(JOBS)


def test_flagship_runs(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    df = JOBS[name](spark, SF_DIR)
    assert check.compare(df, con, ORACLES[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas") if op in plan]


def test_training_metrics_per_model(spark):
    rows = {r["model"]: r for r in JOBS["train_regressors"](spark, SF_DIR).collect()}
    assert set(rows) == {"boosted", "forest", "gamma_glm"}
    assert all(r["n"] > 0 and r["MAE"] >= 0 and r["ACC"] <= 1 for r in rows.values())


def test_grid_search_scores_every_point(spark):
    rows = JOBS["grid_search"](spark, SF_DIR).collect()
    assert len(rows) == 9 and all(r["mae"] > 0 for r in rows)


def test_clusters_label_every_series(spark):
    labels = JOBS["series_kmeans"](spark, SF_DIR).collect()
    assert {r["label"] for r in labels} <= {0, 1}
    assert len(labels) == len({(r["dept_id"], r["goods_id"]) for r in labels})
