"""Decision pipeline: lazy DataFrames for every stage, built once per context.

``Pipeline(spark, sf_dir, scenario)`` exposes panel -> features -> elasticity ->
recommendations -> inventory -> transfers -> joint -> backtest as properties.
Nothing is collected; each property is a lazy plan, so a query that needs only
the panel never plans the rest.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.config import DEFAULT_SCENARIO, Scenario
from shelfwise.operators import backtest as bt
from shelfwise.operators import elasticity as el
from shelfwise.operators import features as ft
from shelfwise.operators import inventory as inv
from shelfwise.operators import joint as jt
from shelfwise.operators import policy as pol
from shelfwise.operators import pricing as pr
from shelfwise.operators import transfers as tr
from shelfwise.session import table_dir
from shelfwise.sources import driver_tables as dt


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, scenario: Scenario = DEFAULT_SCENARIO,
                 materialize: bool = True):
        self.spark, self.sf_dir, self.sc = spark, sf_dir, scenario
        self.materialize = materialize

    def with_scenario(self, scenario: Scenario, materialize: bool | None = None) -> "Pipeline":
        """Same inputs (panel, products, elasticity tables shared), other scenario parameters."""
        other = Pipeline(self.spark, self.sf_dir, scenario, self.materialize if materialize is None else materialize)
        for k in ("cells", "products_full", "products", "panel", "features", "split_features", "elasticity_moments",
                  "elasticity", "global_elasticity", "rec_rows"):
            if k in self.__dict__:
                other.__dict__[k] = self.__dict__[k]
        return other

    def _mat(self, df: DataFrame, name: str) -> DataFrame:
        """Cut lineage at a stage boundary: write a table to the shared folder, read it back.

        The folder is the one ``spark.checkpoint.dir`` names (else the session's warehouse), which all
        executors share. Every table after the adapter is bounded by the dimensions. Caching instead
        keeps the whole lineage: nested cached plans grow exponentially in the joint decision.
        """
        if not self.materialize:
            return df
        path = f"{self._stage_dir}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def _stage_dir(self) -> str:
        return f"{table_dir(self.spark)}/shelfwise-stages/{self.sc.name.replace(' ', '_')}-{uuid.uuid4().hex}"

    # ---- inputs
    @cached_property
    def cells(self) -> DataFrame:
        return self._mat(dt.cell_demand(self.spark, self.sf_dir), "cells")

    @cached_property
    def products_full(self) -> DataFrame:
        return self._mat(dt.build_products(self.spark, self.sf_dir, self.cells), "products")

    @cached_property
    def products(self) -> DataFrame:
        return self.products_full.drop("size_sum", "price_cents")

    @cached_property
    def panel(self) -> DataFrame:
        return self._mat(dt.build_panel(self.cells, self.products_full, self._mat), "panel")

    # ---- features / model inputs
    @cached_property
    def features(self) -> DataFrame:
        """Panel + lag/rolling features (one window stage), materialised: many queries and every model fit read it."""
        return self._mat(ft.build_features(self.panel, self.products), "features")

    @cached_property
    def split_features(self) -> DataFrame:
        return ft.time_split(self.features)

    # ---- elasticity
    @cached_property
    def elasticity_moments(self) -> DataFrame:
        """Segment moments (<= global + category x tier + category x region x tier rows), computed once."""
        return self._mat(el.panel_moments(self.panel), "elasticity_moments")

    @cached_property
    def elasticity(self) -> DataFrame:
        return self._mat(el.elasticity_table(self.panel, self.products, moments=self.elasticity_moments),
                         "elasticity")

    @cached_property
    def global_elasticity(self) -> DataFrame:
        return self._mat(el.global_elasticity(self.panel, self.elasticity_moments), "global_elasticity")

    # ---- pricing
    @cached_property
    def rec_rows(self) -> DataFrame:
        return self._mat(pr.recommendation_rows(self.panel, self.products, self.elasticity, self.global_elasticity),
                         "rec_rows")

    @cached_property
    def recommendations(self) -> DataFrame:
        return self._mat(pr.optimize_prices(self.rec_rows, self.sc), "recommendations")

    # ---- inventory
    @cached_property
    def inventory_metrics(self) -> DataFrame:
        return inv.sku_region_metrics(self.panel, self.products, self.sc)

    @cached_property
    def inventory_status(self) -> DataFrame:
        return self._mat(pol.inventory_status(self.inventory_metrics, self.sc), "inventory_status")

    @cached_property
    def replenishment(self) -> DataFrame:
        return pol.replenishment(self.inventory_status, self.sc)

    @cached_property
    def transfers(self) -> DataFrame:
        return self._mat(tr.transfer_allocation(self.inventory_status, self.sc), "transfers")

    # ---- joint
    @cached_property
    def joint(self) -> DataFrame:
        return self._mat(jt.joint_recommendations(self.recommendations, self.replenishment, self.transfers,
                                                  self.panel, self.sc), "joint")

    # ---- backtest
    @cached_property
    def test_window(self) -> DataFrame:
        return bt.test_window(self.panel)

    @cached_property
    def strategies(self) -> DataFrame:
        return bt.strategies(self.test_window, self.joint, self.transfers)

    # ---- demand models; fitted once per pipeline
    @cached_property
    def encoding(self):
        """The train rows' category dictionary."""
        from shelfwise.operators.encoding import Encoding
        return Encoding.fit(self.split_features.filter(F.col("split") == "train"))

    @cached_property
    def moments(self):
        """Sums of products of the train rows' matrix columns."""
        from shelfwise.operators.linear import moments
        return moments(self.split_features.filter(F.col("split") == "train"), ft.TARGET_COL, self.encoding)

    def model(self, kind: str = "gbt"):
        """(model, metrics table, test predictions) for ``kind``; cached per pipeline."""
        from shelfwise.operators.demand import train_evaluate
        cache = self.__dict__.setdefault("_models", {})
        if kind not in cache:
            cache[kind] = train_evaluate(self.split_features, kind)
        return cache[kind]

    @cached_property
    def comparison(self) -> DataFrame:
        return bt.bt_lift(bt.bt_compare(self.strategies))

