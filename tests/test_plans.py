"""Every non-ML query plans without Python evaluation (no UDFs on the hot path)."""

import pytest

from tests.conftest import SF_SMALL

ML = {"model_matrix", "scale_features", "demand_ridge", "demand_elasticnet", "demand_random_forest", "demand_gbt",
      "train_evaluate", "test_predictions", "feature_importance", "compare_models", "predict_at_price_model",
      "save_load_model", "save_load_model_metrics", "model_report"}
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")


def test_no_python_evaluation_in_any_query(spark):
    import __spark_entry__ as E
    bad = []
    for name, fn in E.queries().items():
        if name in ML:
            continue
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        if any(n in plan for n in PY_NODES):
            bad.append(name)
    assert not bad, bad


@pytest.mark.parametrize("name", ["feat_fill", "optimize_prices", "sku_region_metrics", "transfer_allocation"])
def test_whole_stage_codegen(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()  # AQE shows the final plan (with its codegen stages) after execution
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WholeStageCodegen" in plan or "*(" in plan
