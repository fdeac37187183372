"""Demand models and the seasonal-naive baseline.

The baseline is two equi-joins on a shifted week key against the train rows.
Ridge and elastic net come from one Gram matrix (``linear``), boosting from
distributed histograms (``boosting``); the random forest is Spark ML's. Predictions
are clipped at 0 and scored with the aggregate metrics of ``metrics``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import metrics as mt
from shelfwise.operators.boosting import BoostedTrees, Rules, fit_boosted_trees
from shelfwise.operators.encoding import Encoding
from shelfwise.operators.features import GROUP_COLS, TARGET_COL
from shelfwise.operators.linear import LinearModel, fit_linear
from shelfwise.session import stored_table


def baseline_seasonal_naive(split_features: DataFrame) -> DataFrame:
    """Test rows with a prediction: target 52 weeks back in train rows if > 0, else 1 week back, else 0."""
    train = split_features.filter(F.col("split") == "train").select(*GROUP_COLS, "week_num", F.col(TARGET_COL).alias("_v"))
    t52 = train.select(*GROUP_COLS, (F.col("week_num") + 52).alias("week_num"), F.col("_v").alias("_v52"))
    t1 = train.select(*GROUP_COLS, (F.col("week_num") + 1).alias("week_num"), F.col("_v").alias("_v1"))
    test = split_features.filter(F.col("split") == "test")
    d = test.join(t52, [*GROUP_COLS, "week_num"], "left").join(t1, [*GROUP_COLS, "week_num"], "left")
    v52, v1 = F.coalesce(F.col("_v52"), F.lit(0.0)), F.coalesce(F.col("_v1"), F.lit(0.0))
    return d.withColumns({"actual": F.col(TARGET_COL), "baseline_pred": F.when(v52 > 0, v52).otherwise(v1)}) \
        .drop("_v52", "_v1")


ESTIMATORS = ("ridge", "elasticnet", "random_forest", "gbt")


class ForestModel:
    """Spark ML random forest behind the interface of the other models."""
    kind = "random_forest"

    def __init__(self, encoding, fitted):
        self.encoding, self.fitted = encoding, fitted

    @staticmethod
    def fit(train: DataFrame, label: str, trees: int = 100):
        from pyspark.ml.functions import array_to_vector
        from pyspark.ml.regression import RandomForestRegressor
        encoding = Encoding.fit(train)
        rows = encoding.matrix(train).select(label, array_to_vector("x").alias("features"))
        return ForestModel(encoding, RandomForestRegressor(labelCol=label, numTrees=trees, maxDepth=10, seed=42).fit(rows))

    def predict(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        return self.fitted.transform(self.encoding.matrix(df).withColumn("features", array_to_vector("x"))).drop("x", "features")

    def importance(self) -> list[tuple[str, float]]:
        return list(zip(self.encoding.names, self.fitted.featureImportances.toArray().tolist(), strict=True))


def fit_model(train: DataFrame, kind: str, max_iter: int | None = None):
    """A model of the reference's family and settings; ``max_iter`` overrides the number of trees."""
    if kind in ("ridge", "elasticnet"):
        return fit_linear(train, TARGET_COL, kind)
    if kind == "random_forest":
        return ForestModel.fit(train, TARGET_COL, max_iter or 100)
    return fit_boosted_trees(train, TARGET_COL, Rules(trees=max_iter or 100))


def load_model(spark, path: str):
    """A saved linear or boosted model."""
    kind = spark.read.parquet(f"{path}/model").first()["kind"]
    return (BoostedTrees if kind == "gbt" else LinearModel).load(spark, path)


def train_evaluate(split_features: DataFrame, kind: str = "gbt", max_iter: int | None = None):
    """Fit on train, score val/test; returns (model, metrics DataFrame, test predictions)."""
    model = fit_model(split_features.filter(F.col("split") == "train"), kind, max_iter)
    scored = model.predict(split_features.filter(F.col("split").isin("val", "test"))).select(
        "split", "week_num", "sku_id", "category", "region", "customer_tier", TARGET_COL, F.greatest(F.col("prediction"), F.lit(0.0)).alias("predicted"))
    scored = stored_table(scored, "scored")  # metrics and predictions read it, some more than once
    return model, evaluation_table(scored, kind), test_predictions(scored)


def evaluation_table(scored: DataFrame, model_name: str) -> DataFrame:
    """(model, split, metric, value) long table: one grouped aggregate by split, then unpivot."""
    m = mt.metrics_all(scored, TARGET_COL, "predicted", ["split"])
    return m.unpivot("split", ["mae", "rmse", "wape", "rmsle", "bias"], "metric", "value") \
        .withColumn("model", F.lit(model_name))


def test_predictions(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("split") == "test").select(
        "week_num", "sku_id", "category", "region", "customer_tier", F.col(TARGET_COL).alias("actual"),
        F.col("predicted"))


def feature_importance(spark, model, top: int | None = None) -> DataFrame:
    """(feature, importance) from gains or absolute coefficients, descending."""
    df = spark.createDataFrame(model.importance(), "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return df.limit(top) if top else df


def predict_at_price_model(model, rows: DataFrame, prices: Column) -> DataFrame:
    """Every price of the array ``prices`` scored by a fitted linear or boosted model: the model is an
    expression over the row's features in which the price and the price change are replaced, so the
    rows are neither exploded nor encoded again. Adds ``model_sims``, (candidate_price, predicted_units).
    Few rows make much work here, so they are dealt anew: by their bytes all would be put in one task."""
    change = "if(regular_price > 0, p / regular_price - 1, price_change_pct)"
    units = f"greatest({model.expression({'realized_price': 'p', 'price_change_pct': change})}, 0D)"
    dealt = rows.withColumn("_prices", prices).repartition(rows.sparkSession.sparkContext.defaultParallelism)
    return dealt.withColumn(
        "model_sims", F.expr(f"transform(_prices, p -> named_struct('candidate_price', p, 'predicted_units', {units}))")).drop("_prices")
