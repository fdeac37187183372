"""Dashboard and analyst report queries over the decision tables.

Each report is one aggregate / filter / top-k over the joint recommendations
(J), the SKU x region snapshot (I), transfers (T) or the panel (P).  Top-k uses
``orderBy(...).limit(k)`` (planned as TakeOrderedAndProject: a per-partition
top-k, then a k-row merge) with key columns as tie-breakers so results are
deterministic.  Multi-table KPIs are cross joins of 1-row aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from shelfwise.config import EXCESS_STATUSES, INVENTORY_POLICY, SHORTAGE_STATUSES
from shelfwise.functions.columns import exact_avg

def _sum(x) -> Column:
    """Sum that is 0 on an empty slice."""
    return F.coalesce(F.sum(x), F.lit(0.0))


S3 = ["sku_id", "region", "customer_tier"]
MOVES = ["Increase", "Decrease"]
OBJECTIVE_SORT = {"maximize_gross_profit": "gross_profit_lift", "maximize_revenue": "projected_revenue",
                  "reduce_excess_inventory": "excess_inventory_value", "balanced": "gross_profit_lift"}


def inv_summary(inv: DataFrame) -> DataFrame:
    st = F.col("inventory_status")
    return inv.agg(
        _sum(F.col("on_hand_inventory") * F.col("unit_cost")).alias("total_inventory_value"),
        _sum(F.when(st.isin(*EXCESS_STATUSES), F.col("excess_inventory_value")).otherwise(0.0)).alias("excess_inventory_value"),
        F.count(F.when(st.isin(*SHORTAGE_STATUSES), 1)).alias("stockout_risk_skus"),
        F.count(F.when(st == "SLOW_MOVING", 1)).alias("slow_moving_skus"),
        exact_avg(F.col("available_weeks_of_cover"), 2).alias("avg_weeks_of_cover"),
        _sum("lost_sales_estimate").alias("estimated_lost_sales"))


def inv_portfolio_turns(inv: DataFrame, panel: DataFrame) -> DataFrame:
    cogs = panel.groupBy("sku_id", "region").agg(_sum(F.col("unit_cost") * F.col("units_sold")).alias("annual_cogs"))
    j = inv.join(cogs, ["sku_id", "region"], "left")
    a = j.agg(_sum("annual_cogs").alias("annual_cogs"),
              _sum(F.col("on_hand_inventory") * F.col("unit_cost")).alias("inventory_value"),
              exact_avg(F.col("inventory_turns"), 3).alias("mean_turns"))
    return a.withColumn("portfolio_turns", F.when(F.col("inventory_value") > 0,
                                                  F.col("annual_cogs") / F.col("inventory_value")).otherwise(0.0))


def inv_status_distribution(inv: DataFrame) -> DataFrame:
    return inv.groupBy("inventory_status").agg(F.count(F.lit(1)).alias("count"))


def inv_excess_by_category(inv: DataFrame) -> DataFrame:
    return inv.filter(F.col("inventory_status").isin(*EXCESS_STATUSES)).groupBy("category").agg(
        F.sum("excess_inventory_value").alias("excess_inventory_value"))


def policy_filter(j: DataFrame, objective: str, margin_floor: float, max_move: float, confidence: float) -> DataFrame:
    """Guardrail filter (nulls pass) and sort by the objective's column."""
    c = F.col
    df = j.filter(c("elasticity_confidence").isNull() | (c("elasticity_confidence") >= confidence))
    df = df.filter(c("gross_margin_pct").isNull() | (c("gross_margin_pct") >= margin_floor))
    df = df.filter(c("price_change_pct").isNull() | (F.abs(c("price_change_pct")) <= max_move + 1e-9))
    return df.orderBy(F.desc(OBJECTIVE_SORT.get(objective, "gross_profit_lift")), *S3)


def slice_filter(df: DataFrame, **filters) -> DataFrame:
    """Equality per column, "All" = no filter, list/tuple = IN."""
    for col, v in filters.items():
        if v == "All" or col not in df.columns:
            continue
        df = df.filter(F.col(col).isin(*v) if isinstance(v, (list, tuple)) else F.col(col) == v)
    return df


def kpi_headline(j: DataFrame, inv: DataFrame, panel: DataFrame) -> DataFrame:
    r = j.agg(_sum("current_revenue").alias("total_revenue"), _sum("current_gross_profit").alias("gross_margin_value"),
              _sum("gross_profit_lift").alias("margin_opportunity"),
              F.count(F.when(F.col("recommendation_action").isin(*MOVES), 1)).alias("pricing_opportunities"),
              F.count(F.when(F.col("inventory_status").isin("STOCKOUT", "STOCKOUT_RISK"), 1)).alias("high_risk_rows"),
              F.count(F.when(F.col("manual_review_required"), 1)).alias("awaiting_review"))
    s = inv_summary(inv).select("total_inventory_value", "excess_inventory_value")
    t = inv_portfolio_turns(inv, panel).select(F.col("portfolio_turns").alias("inventory_turnover"))
    so = inv.agg(F.avg(F.col("inventory_status").isin("STOCKOUT", "STOCKOUT_RISK").cast("double")).alias("stockout_rate"))
    out = r.crossJoin(F.broadcast(s)).crossJoin(F.broadcast(t)).crossJoin(F.broadcast(so))  # four 1-row frames
    return out.withColumn("gross_margin_pct", F.when(F.col("total_revenue") != 0,
                                                     F.col("gross_margin_value") / F.col("total_revenue")).otherwise(0.0))


def lift_by(j: DataFrame, col: str) -> DataFrame:
    return j.groupBy(col).agg(F.sum("gross_profit_lift").alias("gross_profit_lift")).orderBy(F.desc("gross_profit_lift"))


def action_mix(j: DataFrame) -> DataFrame:
    a = j.groupBy(F.col("recommendation_action").alias("action")).count().withColumn("kind", F.lit("pricing"))
    b = j.groupBy(F.col("inventory_action").alias("action")).count().withColumn("kind", F.lit("inventory"))
    return a.unionByName(b)


def top_by(df: DataFrame, col: str, k: int, keys=S3, absolute: bool = False) -> DataFrame:
    order = F.abs(F.col(col)) if absolute else F.col(col)
    return df.orderBy(order.desc(), *keys).limit(k)


def pricing_kpis(j: DataFrame) -> DataFrame:
    mv = F.col("recommendation_action").isin(*MOVES)
    return j.agg(F.count(F.when(mv, 1)).alias("pricing_opportunities"),
                 F.coalesce(exact_avg(F.col("price_change_pct"), 4, mv), F.lit(0.0)).alias("avg_recommended_move"),
                 F.sum("gross_profit_lift").alias("modeled_margin_lift"),
                 F.avg((F.col("joint_confidence") == "HIGH").cast("double")).alias("high_confidence_share"))


def top_movers_long(j: DataFrame, k: int = 15) -> DataFrame:
    movers = j.filter(F.col("recommendation_action").isin(*MOVES))
    top = top_by(movers, "gross_profit_lift", k, absolute=True).select("sku_id", "region", "customer_tier",
                                                                        "current_price", "recommended_price")
    return top.unpivot(S3, ["current_price", "recommended_price"], "type", "price")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]; the maximum goes to the last bin (1-row bounds cross-joined)."""
    b = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    d = df.select(col).where(F.col(col).isNotNull()).crossJoin(F.broadcast(b))
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.when(F.col("_hi") > F.col("_lo"),
                 F.least(F.floor((F.col(col) - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0).cast("int")
    return d.withColumn("bin", idx).groupBy("bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("count")).select(
        "bin", (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_start"), "count")


def competitor_index_by_category(panel: DataFrame) -> DataFrame:
    return panel.groupBy("category").agg(exact_avg(F.col("competitor_price_index"), 4).alias("competitor_price_index"))


def unit_impact(j: DataFrame) -> DataFrame:
    return j.select(*S3, "recommendation_action",
                    (F.col("predicted_recommended_units") - F.col("predicted_current_units")).alias("unit_impact"),
                    "gross_profit_lift")


def stockout_heatmap(j: DataFrame, regions: list[str]) -> DataFrame:
    """Mean at-risk flag over distinct SKU x region, category rows x region columns (fixed pivot values)."""
    r = j.groupBy("sku_id", "region", "category").agg(F.first("inventory_status").alias("inventory_status"))
    r = r.withColumn("at_risk", F.col("inventory_status").isin("STOCKOUT", "STOCKOUT_RISK").cast("double"))
    return r.groupBy("category").pivot("region", regions).avg("at_risk")


def review_queue(j: DataFrame, decisions: DataFrame | None = None, only_action: bool = True,
                 confidence: str = "All", review_only: bool = False, k: int = 200) -> DataFrame:
    q = j
    if only_action:
        q = q.filter(F.col("recommendation_action").isin("Increase", "Decrease", "Test")
                     | F.col("inventory_action").isin("EXPEDITE_ORDER", "REPLENISH", "INTER_REGION_TRANSFER",
                                                      "STOP_OR_DELAY_ORDER"))
    if confidence != "All":
        q = q.filter(F.col("joint_confidence") == confidence)
    if review_only:
        q = q.filter(F.col("manual_review_required"))
    q = top_by(q, "gross_profit_lift", k)
    if decisions is not None:
        q = q.join(latest_decisions(decisions), "sku_id", "left").withColumn(
            "decision", F.coalesce(F.col("decision"), F.lit("—")))
    return q


def latest_decisions(log: DataFrame) -> DataFrame:
    """Last write wins per SKU: all fields of the one row with the latest (logged_at, note), so that entries
    logged at the same time cannot be mixed."""
    last = F.max_by(F.struct("decision", "override_price", "note"), F.struct("logged_at", "note"))
    return log.groupBy("sku_id").agg(last.alias("_last")).select("sku_id", "_last.*")


def latest_per_sku(panel: DataFrame) -> DataFrame:
    """Latest row per SKU; week ties broken by (region, customer_tier)."""
    s = F.struct("week_num", "region", "customer_tier")
    cols = [c for c in panel.columns if c != "sku_id"]
    return panel.groupBy("sku_id").agg(F.max_by(F.struct(*cols), s).alias("_r")).select("sku_id", "_r.*")


def sku_excess_latest(panel: DataFrame) -> DataFrame:
    latest = latest_per_sku(panel)
    n = latest.agg(F.count(F.when(F.col("excess_inventory_flag"), 1)).alias("_n"))
    d = latest.crossJoin(F.broadcast(n)).filter(F.when(F.col("_n") > 0, F.col("excess_inventory_flag"))
                                   .otherwise(F.col("weeks_of_cover") > 16))
    return d.groupBy("category").agg(F.count(F.lit(1)).alias("excess_skus"))


def sku_stockout_latest(panel: DataFrame) -> DataFrame:
    latest = latest_per_sku(panel)
    n = latest.agg(F.count(F.when(F.col("stockout_flag"), 1)).alias("_n"))
    d = latest.crossJoin(F.broadcast(n)).filter(F.when(F.col("_n") > 0, F.col("stockout_flag")).otherwise(F.col("weeks_of_cover") < 2))
    return d.select("sku_id", "category", "region", "customer_tier", "week_num", "weeks_of_cover")


def minmax_normalize(df: DataFrame, col: str) -> DataFrame:
    b = df.agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    return df.crossJoin(F.broadcast(b)).withColumn(
        f"{col}_normalized", F.when(F.col("_mx") == F.col("_mn"), F.lit(0.5))
        .otherwise((F.col(col) - F.col("_mn")) / (F.col("_mx") - F.col("_mn")))).drop("_mn", "_mx")


def format_currency(x: Column) -> Column:
    """$1,234 (no decimals, half-up on the cent-free value); N/A on null."""
    return F.when(x.isNull() | F.isnan(x), F.lit("N/A")).otherwise(
        F.concat(F.lit("$"), F.format_number(F.floor(x + 0.5).cast("double"), 0)))


def format_pct(x: Column) -> Column:
    v = F.floor(x * 1000 + 0.5) / 10.0
    return F.when(x.isNull() | F.isnan(x), F.lit("N/A")).otherwise(F.concat(F.format_string("%.1f", v), F.lit("%")))


# ---- analyst answers: each works on any slice of its input ---------------------------------
def margin_summary(j: DataFrame) -> DataFrame:
    return j.agg(F.avg("gross_margin_pct").alias("avg_gross_margin"), _sum("projected_gross_profit").alias("total_projected_gross_profit"),
                 F.count(F.lit(1)).alias("recommendations"))


def replenish_summary(j: DataFrame) -> DataFrame:
    d = j.filter(F.col("inventory_action").isin("REPLENISH", "EXPEDITE_ORDER"))
    return d.agg(F.count(F.lit(1)).alias("replenish_skus"), _sum("recommended_order_quantity").alias("total_order_quantity"))


def action_counts(j: DataFrame) -> DataFrame:
    ia = F.col("inventory_action")
    return j.agg(F.count(F.when(ia == "STOP_OR_DELAY_ORDER", 1)).alias("stop_order_count"),
                 F.count(F.when(ia == "PRICE_MARKDOWN", 1)).alias("markdown_count"))


def conflict_count(j: DataFrame) -> DataFrame:
    c = (F.col("pricing_action") == "Decrease") & F.col("inventory_action").isin("REPLENISH", "EXPEDITE_ORDER", "INTER_REGION_TRANSFER")
    return j.agg(F.count(F.when(c, 1)).alias("conflicts"))


def woc_and_status_top(inv: DataFrame, k: int = 5) -> DataFrame:
    """Mean cover beside the k most frequent statuses; the mean stands alone when there is none."""
    top = inv_status_distribution(inv).orderBy(F.desc("count"), "inventory_status").limit(k)
    woc = inv.agg(exact_avg(F.col("available_weeks_of_cover"), 2).alias("avg_weeks_of_cover"))
    return woc.join(top, F.lit(True), "left").select("inventory_status", "count", "avg_weeks_of_cover")


def lost_sales_total(j: DataFrame) -> DataFrame:
    return j.agg(_sum("lost_sales_estimate").alias("lost_sales_total"))


def obsolescence_high(j: DataFrame, threshold: float = INVENTORY_POLICY["obsolescence_threshold"]) -> DataFrame:
    return j.agg(F.count(F.when(F.col("obsolescence_risk_score") > threshold, 1)).alias("high_obsolescence"))


def elasticity_low_conf(table: DataFrame, k: int = 5) -> DataFrame:
    """Counts beside the first k low-confidence segments; the counts stand alone when there is none."""
    low = F.col("elasticity_class") == "Low confidence"
    counts = table.agg(F.count(F.when(low, 1)).alias("low_confidence_count"), F.count(F.lit(1)).alias("total_count"))
    first = table.filter(low).orderBy("elasticity_segment").limit(k).select("elasticity_segment", "estimated_elasticity", "confidence_score")
    return counts.join(first, F.lit(True), "left").select(*first.columns, *counts.columns)


def guardrail_summary(j: DataFrame) -> DataFrame:
    return j.agg(F.count(F.when(F.col("recommendation_action") == "Manual Review", 1)).alias("manual_review"),
                 F.count(F.when(F.length("guardrail_triggered") > 0, 1)).alias("guarded"))


def rollback_retained(j: DataFrame, transfers: DataFrame, pct: float = 0.5) -> DataFrame:
    t = transfers.agg((F.count(F.lit(1)) * (1 - pct)).alias("retained_transfers"), F.count(F.lit(1)).alias("total_transfers"))
    g = j.agg((_sum("modeled_gp_lift") * (1 - pct)).alias("retained_gp_lift"))
    return t.crossJoin(F.broadcast(g))


def queue_kpis(j: DataFrame, log: DataFrame) -> DataFrame:
    q = review_queue(j).agg(F.count(F.lit(1)).alias("items_in_queue"), _sum("gross_profit_lift").alias("modeled_gp_lift"))
    n = latest_decisions(log).agg(F.count(F.lit(1)).alias("decisions_logged"))
    a = j.agg(F.count(F.when(F.col("manual_review_required"), 1)).alias("awaiting_review"))
    return q.crossJoin(F.broadcast(n)).crossJoin(F.broadcast(a))


def excess_by_category(j: DataFrame) -> DataFrame:
    """Excess value by category over all recommendation rows."""
    return j.groupBy("category").agg(_sum("excess_inventory_value").alias("excess_inventory_value"))


def sku_profile(j: DataFrame, products: DataFrame, sku: str) -> DataFrame:
    prod = products.select("sku_id", "product_name", "subcategory", "brand_tier", "lead_time_days", "lifecycle_stage")
    d = j.filter(F.col("sku_id") == sku).join(prod, "sku_id", "left")
    return d.select(*S3, "product_name", "category", "subcategory", "brand_tier", "lead_time_days", "lifecycle_stage", "current_price",
                    "recommended_price", "recommendation_action", "predicted_current_units", "available_weeks_of_cover",
                    "stockout_probability", "pricing_reason_code", "elasticity", "elasticity_confidence",
                    F.coalesce(F.nullif(F.col("guardrail_triggered"), F.lit("")), F.lit("None")).alias("guardrail"))
