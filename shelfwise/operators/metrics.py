"""Forecast accuracy metrics as aggregate expressions (usable in any groupBy)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import rnd


def _mean(x: Column, decimals: int | None) -> Column:
    """avg(x); with ``decimals`` (inputs carry that precision) the sum is rounded first: order-independent."""
    return F.avg(x) if decimals is None else rnd(F.sum(x), decimals) / F.count(x)


def _total(x: Column, decimals: int | None) -> Column:
    return F.sum(x) if decimals is None else rnd(F.sum(x), decimals)


def metric_mae(y: Column, p: Column, decimals: int | None = None) -> Column:
    return _mean(F.abs(y - p), decimals)


def metric_rmse(y: Column, p: Column, decimals: int | None = None) -> Column:
    return F.sqrt(_mean((y - p) * (y - p), None if decimals is None else 2 * decimals))


def metric_wape(y: Column, p: Column, decimals: int | None = None) -> Column:
    den = _total(F.abs(y), decimals)
    return F.when(den == 0, F.lit(0.0)).otherwise(_total(F.abs(y - p), decimals) / den)


def metric_rmsle(y: Column, p: Column, decimals: int | None = None) -> Column:
    d = F.log1p(F.greatest(y, F.lit(0.0))) - F.log1p(F.greatest(p, F.lit(0.0)))
    return F.sqrt(F.avg(d * d))


def metric_bias(y: Column, p: Column, decimals: int | None = None) -> Column:
    return _mean(p - y, decimals)


METRICS = {"MAE": metric_mae, "RMSE": metric_rmse, "WAPE": metric_wape, "RMSLE": metric_rmsle, "Bias": metric_bias}


def metrics_all(df: DataFrame, y: str, p: str, group_cols=(), decimals: int | None = None) -> DataFrame:
    """All five metrics in ONE aggregate, optionally per group (category, region, ...)."""
    aggs = [fn(F.col(y), F.col(p), decimals).alias(name.lower()) for name, fn in METRICS.items()]
    aggs.append(F.count(F.lit(1)).alias("n_rows"))
    return df.groupBy(*group_cols).agg(*aggs)


def baseline_improvement(base: Column, model: Column) -> Column:
    return F.when(base == 0, F.lit(0.0)).otherwise((base - model) / base)
