"""Strategy back-test over the test window and rollback what-ifs.

Each strategy is a narrow rewrite of the test-window panel (plus left joins of
per-key tables bounded by the series count); the comparison is ONE
``groupBy("strategy")`` over the tagged union, with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.config import BACKTEST_START_WEEK
from shelfwise.functions.columns import clip, exact_avg

SERIES = ["sku_id", "region", "customer_tier"]
BT_COLS = ["sku_id", "region", "customer_tier", "week_num", "realized_price", "unit_cost", "units_sold", "revenue",
           "cogs", "gross_profit", "gross_margin_pct", "weeks_of_cover", "stockout_flag", "excess_inventory_flag",
           "ending_inventory", "lost_sales_estimate", "competitor_price"]


def test_window(panel: DataFrame, start: int = BACKTEST_START_WEEK) -> DataFrame:
    return panel.filter(F.col("week_num") >= start).select(*BT_COLS)


def _margin(df):
    return df.withColumn("gross_margin_pct", F.when(F.col("revenue") > 0, F.col("gross_profit") / F.col("revenue"))
                         .otherwise(0.0))


def bt_current(test: DataFrame) -> DataFrame:
    return test


def bt_cost_plus(test: DataFrame) -> DataFrame:
    df = test.withColumn("realized_price", F.col("unit_cost") / 0.7)
    df = df.withColumn("revenue", F.col("realized_price") * F.col("units_sold") * 0.95)
    return _margin(df.withColumn("gross_profit", F.col("revenue") - F.col("cogs")))


def bt_competitor_match(test: DataFrame) -> DataFrame:
    ratio = F.col("competitor_price") / F.greatest(F.col("realized_price"), F.lit(0.01))
    df = test.withColumn("units_sold", F.col("units_sold") * F.pow(ratio, F.lit(-1.2)))
    df = df.withColumn("realized_price", F.col("competitor_price"))
    df = df.withColumns({"revenue": F.col("realized_price") * F.col("units_sold"),
                         "cogs": F.col("unit_cost") * F.col("units_sold")})
    return _margin(df.withColumn("gross_profit", F.col("revenue") - F.col("cogs")))


def bt_pricing_only(test: DataFrame, recs: DataFrame) -> DataFrame:
    r = recs.select(*SERIES, "recommended_price", "predicted_recommended_units", "predicted_current_units").dropDuplicates()
    df = test.join(r, SERIES, "left")
    has = F.col("recommended_price").isNotNull()
    change = F.when(F.col("predicted_current_units") > 0,
                    F.col("predicted_recommended_units") / F.greatest(F.col("predicted_current_units"), F.lit(0.01))
                    ).otherwise(1.0)
    df = df.withColumns({"realized_price": F.when(has, F.col("recommended_price")).otherwise(F.col("realized_price")),
                         "units_sold": F.when(has, F.col("units_sold") * change).otherwise(F.col("units_sold"))})
    df = df.withColumns({
        "revenue": F.when(has, F.col("realized_price") * F.col("units_sold")).otherwise(F.col("revenue")),
        "cogs": F.when(has, F.col("unit_cost") * F.col("units_sold")).otherwise(F.col("cogs"))})
    df = df.withColumn("gross_profit", F.when(has, F.col("revenue") - F.col("cogs")).otherwise(F.col("gross_profit")))
    df = df.withColumn("gross_margin_pct", F.when(has, F.when(F.col("revenue") > 0, F.col("gross_profit") / F.col("revenue"))
                                                  .otherwise(0.0)).otherwise(F.col("gross_margin_pct")))
    return df.drop("recommended_price", "predicted_recommended_units", "predicted_current_units")


def first_inventory_rec(recs: DataFrame) -> DataFrame:
    """First recommendation per (sku, region), tiers in name order (deterministic)."""
    return recs.groupBy("sku_id", "region").agg(
        F.min_by(F.struct("inventory_action", "recommended_order_quantity"), F.col("customer_tier")).alias("_r")
    ).select("sku_id", "region", F.col("_r.inventory_action").alias("_ia"),
             F.col("_r.recommended_order_quantity").alias("_iq"))


def bt_inventory_only(test: DataFrame, recs: DataFrame) -> DataFrame:
    df = test.join(first_inventory_rec(recs), ["sku_id", "region"], "left")
    rep = F.col("_ia").isin("REPLENISH", "EXPEDITE_ORDER")
    stop = F.col("_ia") == "STOP_OR_DELAY_ORDER"
    qty = F.coalesce(F.col("_iq"), F.lit(0.0))
    df = df.withColumns({
        "ending_inventory": F.when(rep, F.col("ending_inventory") + qty * 0.1)
        .when(stop, F.col("ending_inventory") * 0.98).otherwise(F.col("ending_inventory")),
        "units_sold": F.when(rep, F.col("units_sold") * 1.02).otherwise(F.col("units_sold"))})
    df = df.withColumns({"revenue": F.col("realized_price") * F.col("units_sold"),
                         "cogs": F.col("unit_cost") * F.col("units_sold")})
    return df.withColumn("gross_profit", F.col("revenue") - F.col("cogs")).drop("_ia", "_iq")


def bt_joint(test: DataFrame, recs: DataFrame, transfers: DataFrame) -> DataFrame:
    df = bt_inventory_only(bt_pricing_only(test, recs), recs)
    out = transfers.select("sku_id", F.col("source_region").alias("region"),
                           (F.col("transfer_quantity") * 0.05).alias("_out"), F.lit(0.0).alias("_in"))
    inn = transfers.select("sku_id", F.col("destination_region").alias("region"), F.lit(0.0).alias("_out"),
                           (F.col("transfer_quantity") * 0.05).alias("_in"))
    delta = out.unionByName(inn).groupBy("sku_id", "region").agg(F.sum("_out").alias("_out"), F.sum("_in").alias("_in"))
    df = df.join(delta, ["sku_id", "region"], "left")
    e = F.col("ending_inventory")
    e = F.when(F.col("_out") > 0, F.greatest(F.lit(0.0), e - F.col("_out"))).otherwise(e) + F.coalesce(F.col("_in"), F.lit(0.0))
    return df.withColumn("ending_inventory", e).drop("_out", "_in")


def strategies(test: DataFrame, recs: DataFrame, transfers: DataFrame) -> DataFrame:
    parts = [("Current Pricing", bt_current(test)), ("Pricing-Only Optimization", bt_pricing_only(test, recs)),
             ("Inventory-Only Policy", bt_inventory_only(test, recs)),
             ("Joint Pricing + Inventory", bt_joint(test, recs, transfers)),
             ("Cost-Plus Pricing", bt_cost_plus(test)), ("Competitor Match", bt_competitor_match(test))]
    out = None
    for name, df in parts:
        d = df.select(*BT_COLS).withColumn("strategy", F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out


def bt_compare(tagged: DataFrame) -> DataFrame:
    excess = F.when(F.col("excess_inventory_flag"), F.col("ending_inventory") * F.col("unit_cost")).otherwise(0.0)
    return tagged.groupBy("strategy").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("gross_profit").alias("total_gross_profit"),
        exact_avg(F.col("gross_margin_pct"), 4).alias("avg_gross_margin"), F.sum("units_sold").alias("total_units"),
        exact_avg(F.col("weeks_of_cover"), 2).alias("avg_weeks_of_cover"),
        F.avg(F.col("stockout_flag").cast("double")).alias("stockout_rate"),
        F.sum(excess).alias("excess_inventory_value"), F.sum("lost_sales_estimate").alias("lost_sales_estimate"))


def bt_lift(comparison: DataFrame) -> DataFrame:
    base = comparison.filter(F.col("strategy") == "Current Pricing").select(F.col("total_gross_profit").alias("_base"))
    lift = F.coalesce(F.try_divide(F.col("total_gross_profit") - F.col("_base"), F.abs(F.col("_base"))), F.lit(0.0))
    return comparison.crossJoin(F.broadcast(base)).withColumn(
        "modeled_lift_vs_current",
        F.when(F.col("strategy").isin("Joint Pricing + Inventory", "Pricing-Only Optimization"), lift).otherwise(0.0)
    ).drop("_base")


def bt_coverage_rates(joint: DataFrame, test: DataFrame, transfers: DataFrame) -> DataFrame:
    groups = test.select(*SERIES).distinct().agg(F.count(F.lit(1)).alias("_groups"))
    ntr = transfers.agg(F.count(F.lit(1)).alias("transfer_count"))
    ia = F.col("inventory_action")
    r = joint.agg(
        F.count(F.lit(1)).alias("_recs"),
        F.avg(F.col("pricing_action").isin("Increase", "Decrease").cast("double")).alias("approval_rate"),
        F.avg((F.length(F.coalesce(F.col("guardrail_triggered"), F.lit(""))) > 0).cast("double")).alias("guardrail_rate"),
        F.count(F.when(ia == "PRICE_MARKDOWN", 1)).alias("markdown_count"),
        F.count(F.when(ia.isin("REPLENISH", "EXPEDITE_ORDER"), 1)).alias("replenish_count"),
        F.count(F.when(ia == "STOP_OR_DELAY_ORDER", 1)).alias("stop_order_count"),
        F.count(F.when(F.col("manual_review_required"), 1)).alias("manual_review_count"))
    return r.crossJoin(F.broadcast(groups)).crossJoin(F.broadcast(ntr)).select(
        (F.col("_recs") / F.greatest(F.col("_groups"), F.lit(1))).alias("rec_coverage"), "approval_rate",
        "guardrail_rate", "markdown_count", "replenish_count", "stop_order_count", "manual_review_count",
        "transfer_count")


# ----------------------------------------------------------------- rollback
def rollback_prices(recs: DataFrame, r: float) -> DataFrame:
    r = float(min(max(r, 0.0), 1.0))
    lift = F.col("gross_profit_lift") if "gross_profit_lift" in recs.columns else F.col("modeled_gp_lift")
    return recs.withColumns({
        "approved_price": F.col("recommended_price"),
        "rollback_price": F.col("current_price") * r + F.col("recommended_price") * (1 - r),
        "gp_retained": lift * (1 - r),
        "revenue_retained": (F.col("projected_revenue") - F.col("current_revenue")) * (1 - r)})


def rollback_transfers(transfers: DataFrame, r: float) -> DataFrame:
    r = float(min(max(r, 0.0), 1.0))
    q = F.col("transfer_quantity") * (1 - r)
    return transfers.withColumns({"approved_quantity": q, "rollback_quantity": q,
                                  "cancelled": F.lit(r >= 1) & (q == 0)})


def rollback_replenishment(recs: DataFrame, r: float) -> DataFrame:
    r = float(min(max(r, 0.0), 1.0))
    q = F.coalesce(F.col("recommended_order_quantity"), F.lit(0.0))
    return recs.withColumns({"approved_order_qty": q * (1 - r),
                             "cancelled_replenishment": F.lit(r >= 1) & (q > 0)})


def rollback_audit(recs: DataFrame, r: float, t: float, run_date: str) -> DataFrame:
    r, t = float(min(max(r, 0.0), 1.0)), float(min(max(t, 0.0), 1.0))
    df = rollback_prices(recs, r)
    action = F.col("pricing_action") if "pricing_action" in recs.columns else F.col("recommendation_action")
    reason = F.col("pricing_reason_code") if "pricing_reason_code" in recs.columns else F.col("reason_code")
    return df.select(
        "sku_id", "current_price", "recommended_price", "approved_price", "rollback_price", "policy_version",
        action.alias("old_action"), reason.alias("reason_code"), "inventory_action",
        action.alias("recommended_action"), action.alias("approved_action"),
        (F.lit("Hold") if r >= 1 else action).alias("rollback_action"),
        F.lit("Pending").alias("approval_status"), F.lit("").alias("approver"),
        F.lit(r > 0 or t > 0).alias("rollback_flag"),
        F.lit(f"Pricing {r * 100:.0f}%, Transfer {t * 100:.0f}%").alias("rollback_reason"),
        F.lit(run_date).alias("effective_date"), F.lit(run_date if r > 0 else "").alias("rollback_date"))


def rollback_summary(recs: DataFrame, transfers: DataFrame, r: float, t: float, q: float) -> DataFrame:
    r, t, q = (float(min(max(x, 0.0), 1.0)) for x in (r, t, q))
    p = rollback_prices(recs, r)
    rev = F.when(F.abs(F.col("rollback_price") - F.col("current_price")) < 0.02, 1) if r >= 1 else F.lit(None)
    s = p.agg(F.sum("gp_retained").alias("gross_profit_lift_retained"),
              F.sum("revenue_retained").alias("revenue_retained"),
              F.count(rev).alias("reverted_sku_count"),
              F.count(F.when(F.coalesce(F.col("recommended_order_quantity"), F.lit(0.0)) > 0, 1) if q >= 1
                      else F.lit(None)).alias("cancelled_replenishments"),
              F.count(F.lit(1)).alias("total_skus"),
              (F.sum("excess_inventory_value") * (1 - r) * 0.01).alias("inventory_value_impact_retained"))
    tr = rollback_transfers(transfers, t).agg(F.count(F.when(F.col("cancelled"), 1)).alias("cancelled_transfers"))
    return s.crossJoin(F.broadcast(tr)).withColumn("unit_recovery_pct", F.lit(1 - r))


def rollback_verify(recs: DataFrame, transfers: DataFrame) -> DataFrame:
    """Rows violating the boundary checks: prices at r=0 and r=1 (rtol .001), transfers at r=1."""
    p0 = rollback_prices(recs, 0.0).agg(F.count(F.when(
        F.abs(F.col("rollback_price") - F.col("recommended_price")) > 0.001 * F.abs(F.col("recommended_price")) + 1e-8,
        1)).alias("price_violations_at_0"))
    p1 = rollback_prices(recs, 1.0).agg(F.count(F.when(
        F.abs(F.col("rollback_price") - F.col("current_price")) > 0.001 * F.abs(F.col("current_price")) + 1e-8,
        1)).alias("price_violations_at_1"))
    t1 = rollback_transfers(transfers, 1.0).agg(F.count(F.when(F.col("rollback_quantity") != 0, 1))
                                                 .alias("transfer_violations_at_1"))
    return p0.crossJoin(F.broadcast(p1)).crossJoin(F.broadcast(t1))

