"""Headline KPIs of every dashboard slice from two cubes of additive measures.

The recommendation rows are summed once over every combination of region, category and tier, the
stock rows (which have no tier) over region and category; a slice is then a lookup of one row each,
a list of members a sum of some (members do not overlap). Ratios are taken from the sums at the end.
The cubes are bounded by the dimensions; the sums are partial before the shuffle, so a hot member
costs nothing. "All" stands for a dimension that is summed over; a null member stays null.
A slice without rows has zeros. Inventory measures do not depend on the tier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.reports import EXCESS_STATUSES, MOVES

ALL = "All"
JOINT_DIMS, STOCK_DIMS = ["region", "category", "customer_tier"], ["region", "category"]
AT_RISK = ["STOCKOUT", "STOCKOUT_RISK"]
JOINT_SUMS = ["total_revenue", "gross_margin_value", "margin_opportunity", "pricing_opportunities", "high_risk_rows", "awaiting_review"]
STOCK_SUMS = ["total_inventory_value", "excess_inventory_value", "annual_cogs", "stock_rows", "stockout_rows"]


def _cube(df: DataFrame, dims: list[str], sums: list) -> DataFrame:
    out = df.cube(*dims).agg(*sums, *(F.grouping(d).alias(f"_all_{d}") for d in dims))
    return out.select(*(F.when(F.col(f"_all_{d}") == 1, F.lit(ALL)).otherwise(F.col(d)).alias(d) for d in dims),
                      *(c for c in out.columns if c not in dims and not c.startswith("_all_")))


def joint_cube(joint: DataFrame) -> DataFrame:
    """(region, category, customer_tier, sums) of the recommendation rows."""
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0.0)).alias(name)
    count = lambda cond, name: F.count(F.when(cond, 1)).alias(name)
    return _cube(joint, JOINT_DIMS, [
        total("current_revenue", "total_revenue"), total("current_gross_profit", "gross_margin_value"), total("gross_profit_lift", "margin_opportunity"),
        count(F.col("recommendation_action").isin(*MOVES), "pricing_opportunities"),
        count(F.col("inventory_status").isin(*AT_RISK), "high_risk_rows"), count(F.col("manual_review_required"), "awaiting_review")])


def stock_cube(inv: DataFrame, panel: DataFrame) -> DataFrame:
    """(region, category, sums) of the stock rows, with the cost of goods their SKU and region sold."""
    cogs = panel.groupBy("sku_id", "region").agg(F.sum(F.col("unit_cost") * F.col("units_sold")).alias("_cogs"))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0.0)).alias(name)
    return _cube(inv.join(cogs, ["sku_id", "region"], "left"), STOCK_DIMS, [
        total(F.col("on_hand_inventory") * F.col("unit_cost"), "total_inventory_value"),
        total(F.when(F.col("inventory_status").isin(*EXCESS_STATUSES), F.col("excess_inventory_value")), "excess_inventory_value"),
        total("_cogs", "annual_cogs"), F.count(F.lit(1)).alias("stock_rows"),
        F.count(F.when(F.col("inventory_status").isin(*AT_RISK), 1)).alias("stockout_rows")])


def _headline(df: DataFrame) -> DataFrame:
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return df.withColumns({
        "inventory_turnover": ratio("annual_cogs", "total_inventory_value"), "stockout_rate": ratio("stockout_rows", "stock_rows"),
        "gross_margin_pct": F.when(F.col("total_revenue") != 0, F.col("gross_margin_value") / F.col("total_revenue")).otherwise(0.0),
    }).drop("annual_cogs", "stock_rows", "stockout_rows")


def all_slices(joint: DataFrame, stock: DataFrame) -> DataFrame:
    """The headline KPIs of every slice that has recommendation rows; both arguments are cubes."""
    j, s = joint.alias("j"), stock.alias("s")
    same = F.expr(" and ".join(f"j.{d} <=> s.{d}" for d in STOCK_DIMS))
    return _headline(j.join(s, same, "left").select("j.*", *(F.coalesce(F.col(f"s.{c}"), F.lit(0)).alias(c) for c in STOCK_SUMS)))


def slice_kpis(joint: DataFrame, stock: DataFrame, **members) -> DataFrame:
    """One row: the headline KPIs of a slice, looked up in the cubes. A dimension's member is a value, a
    list of values, or "All" (the default); other dimensions than the cube's raise."""
    unknown = set(members) - set(JOINT_DIMS)
    if unknown:
        raise ValueError(f"not a dimension of the cube: {sorted(unknown)}")

    def sums(cube: DataFrame, dims: list[str], names: list[str]) -> DataFrame:
        for d in dims:
            v = members.get(d, ALL)
            cube = cube.where(F.col(d).isin(*set(v)) if isinstance(v, (list, tuple)) else F.col(d) == v)
        return cube.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names))
    return _headline(sums(joint, JOINT_DIMS, JOINT_SUMS).crossJoin(F.broadcast(sums(stock, STOCK_DIMS, STOCK_SUMS))))  # two 1-row frames
