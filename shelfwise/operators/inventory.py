"""Inventory health per SKU x region.

One window pass (row position within the SKU x region history) and two
aggregates grouped by (sku, region) produce the whole snapshot; the latest row
per tier is a ``max_by`` aggregate, never a filter per group.  Everything after
the aggregates is column arithmetic on a table bounded by SKU x region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from shelfwise.config import DEFAULT_SCENARIO, INVENTORY_POLICY, Scenario
from shelfwise.functions.columns import clip, normal_cdf, r2, r3, r4

SR = ["sku_id", "region"]
EPS = INVENTORY_POLICY["demand_epsilon"]


# ------------------------------------------------------------ scalar formulas
def weeks_of_cover(inventory: Column, demand: Column, eps: float = EPS) -> Column:
    return F.when(demand <= eps, F.lit(999.0)).otherwise(inventory / demand)


def safety_stock(sd: Column, lead_weeks: Column, z: float) -> Column:
    return F.greatest(F.lit(0.0), F.lit(z) * sd * F.sqrt(F.greatest(lead_weeks, F.lit(0.1))))


def reorder_point(demand: Column, lead_weeks: Column, safety: Column) -> Column:
    return F.greatest(F.lit(0.0), demand * F.greatest(lead_weeks, F.lit(0.1)) + safety)


def excess_units(available: Column, demand: Column, target_woc: float, eps: float = EPS) -> Column:
    return F.greatest(F.lit(0.0), available - F.lit(target_woc) * F.greatest(demand, F.lit(eps)))


def excess_value(units: Column, cost: Column) -> Column:
    return F.greatest(F.lit(0.0), units * cost)


def sell_through(sold: Column, begin: Column, receipts: Column) -> Column:
    denom = begin + receipts
    return F.when(denom <= 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), sold / denom))


def stockout_probability(on_hand: Column, on_order: Column, demand: Column, sd: Column, lead: Column) -> Column:
    lt = F.greatest(lead, F.lit(0.1))
    ltd = demand * lt
    lts = sd * F.sqrt(lt)
    avail = on_hand + on_order
    z = (avail - ltd) / lts
    return (F.when(demand <= 0, F.lit(0.0))
            .when(lts <= 0, F.when(avail < ltd, 1.0).otherwise(0.0))
            .otherwise(clip(normal_cdf(-z), 0.0, 1.0)))


def obsolescence_score(age: Column, stage: Column, woc: Column, trend: Column, st: Column, base: Column) -> Column:
    s = (F.coalesce(base, F.lit(0.0))
         + F.when(stage.isin("Decline", "End-of-Life"), 0.35).otherwise(0.0)
         + F.when(age > 130, 0.15).otherwise(0.0)
         + F.when(woc > 20, 0.20).otherwise(0.0)
         + F.when(trend < -0.1, 0.15).otherwise(0.0)
         + F.when(st < 0.2, 0.15).otherwise(0.0))
    return clip(s, 0.0, 1.0)


def inventory_turns(annual_cogs: Column, avg_inventory_value: Column) -> Column:
    return F.when(avg_inventory_value <= 0, F.lit(0.0)).otherwise(annual_cogs / avg_inventory_value)


def holding_cost(excess_val: Column, rate: float = 0.25, period_fraction: float = 1 / 52) -> Column:
    return excess_val * rate * period_fraction


def case_pack_round(q: Column, pack: Column) -> Column:
    return (F.when(pack <= 1, F.greatest(F.lit(0.0), F.ceil(q).cast("double")))
            .when(q <= 0, F.lit(0.0))
            .otherwise((F.ceil(q / pack) * pack).cast("double")))


def lost_sales(latent: Column, sold: Column, summed_estimate: Column) -> Column:
    return F.when(latent > sold, F.greatest(F.lit(0.0), latent - sold)).otherwise(summed_estimate)


# ------------------------------------------------------------ aggregates
def demand_history(panel: DataFrame, window: int = 8, demand_col: str | None = None) -> DataFrame:
    """Mean / sample sd / trend of demand over the last ``window`` rows of each SKU x region.

    Rows of all tiers are mixed (reference grain); ties on week are ordered by tier.
    The panel holds at most weeks x tiers rows per SKU x region, so the window
    is bounded by the dimensions.  Sums of cent values are rounded to cents and
    the sd comes from exact sums, so every engine and summation order agrees.
    """
    dcol = demand_col or ("adjusted_units" if "adjusted_units" in panel.columns else "latent_demand")
    tcol = "adjusted_units" if "adjusted_units" in panel.columns else "units_sold"
    w = W.partitionBy(*SR).orderBy(F.col("week_num").desc(), F.col("customer_tier").desc())
    ranked = panel.select(*SR, F.col(dcol).alias("_d"), F.col(tcol).alias("_t"),
                          F.row_number().over(w).alias("_rn")).filter(F.col("_rn") <= window)
    ranked = ranked.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*SR)))  # of the rows that are left
    half = (F.col("_n") / 2).cast("int")
    g = ranked.groupBy(*SR).agg(
        F.first("_n").alias("_n"),
        r2(F.sum("_d")).alias("_s1"), r2(F.sum(F.col("_d") * F.col("_d"))).alias("_s2"),
        r2(F.sum(F.when(F.col("_rn") <= half, F.col("_t")))).alias("_rs"),
        r2(F.sum(F.when(F.col("_rn") > F.col("_n") - half, F.col("_t")))).alias("_ps"))
    n = F.col("_n").cast("double")
    avg = F.col("_s1") / n
    var = (n * F.col("_s2") - F.col("_s1") * F.col("_s1")) / (n * (n - 1))
    sd = F.when(F.col("_n") > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).otherwise(avg * 0.2)
    h = (F.col("_n") / 2).cast("int")
    recent = F.try_divide(F.coalesce(F.col("_rs"), F.lit(0.0)), h)
    prior = F.try_divide(F.coalesce(F.col("_ps"), F.lit(0.0)), h)
    trend = F.when(F.col("_n") < 4, F.lit(0.0)).when(prior <= 0, F.lit(0.0)).otherwise((recent - prior) / prior)
    return g.select(*SR, F.greatest(avg, F.lit(0.0)).alias("avg_demand"),
                    F.greatest(sd, F.lit(0.0)).alias("demand_sd"), trend.alias("trend"))


def tier_inventory_rollup(panel: DataFrame) -> DataFrame:
    """Latest row per (sku, region, tier), then summed across tiers per (sku, region)."""
    cols = ["ending_inventory", "on_order", "latent_demand", "units_sold", "beginning_inventory", "receipts",
            "lost_sales_estimate"]
    last = panel.groupBy(*SR, "customer_tier").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("week_num"))).alias(c) for c in cols],
        F.sum("units_sold").alias("_units_all"))
    return last.groupBy(*SR).agg(
        r2(F.sum("_units_all")).alias("units_total"),
        r2(F.sum("ending_inventory")).alias("on_hand"), r2(F.sum("on_order")).alias("on_order_sum"),
        r2(F.sum("latent_demand")).alias("latent_sum"), r2(F.sum("units_sold")).alias("sold_sum"),
        r2(F.sum("beginning_inventory")).alias("begin_sum"), r2(F.sum("receipts")).alias("receipts_sum"),
        r2(F.sum("lost_sales_estimate")).alias("lost_sum"))


def sku_region_metrics(panel: DataFrame, products: DataFrame, sc: Scenario = DEFAULT_SCENARIO) -> DataFrame:
    """The 26-column SKU x region snapshot (SKUs absent from products are dropped)."""
    hist = demand_history(panel, INVENTORY_POLICY["demand_window_weeks"])
    roll = tier_inventory_rollup(panel)  # also carries the whole-history units total (same aggregate pass)
    p = products.select("sku_id", F.col("category").alias("p_category"), F.col("unit_cost").alias("p_cost"),
                        "lead_time_days", "case_pack", "product_age_weeks", "lifecycle_stage",
                        "obsolescence_risk", "minimum_order_quantity")
    df = roll.join(hist, SR).join(p, "sku_id", "inner")
    avg, sd, cost = F.col("avg_demand"), F.col("demand_sd"), F.col("p_cost")
    lt = F.coalesce(F.col("lead_time_days"), F.lit(14)) / 7.0
    on_hand, on_order = F.col("on_hand"), F.col("on_order_sum")
    df = df.withColumns({"_lt": lt, "_avail": on_hand + on_order})
    df = df.withColumns({
        "_ohw": weeks_of_cover(on_hand, avg), "_aw": weeks_of_cover(F.col("_avail"), avg),
        "_ss": safety_stock(sd, F.col("_lt"), sc.service_level_z),
        "_ex": excess_units(F.col("_avail"), avg, sc.target_weeks_of_cover),
        "_st": sell_through(F.col("sold_sum"), F.col("begin_sum"), F.col("receipts_sum")),
    })
    df = df.withColumns({
        "_rop": reorder_point(avg, F.col("_lt"), F.col("_ss")),
        "_sp": stockout_probability(on_hand, on_order, avg, sd, F.col("_lt")),
        "_obs": obsolescence_score(F.coalesce(F.col("product_age_weeks"), F.lit(52)),
                                   F.coalesce(F.col("lifecycle_stage"), F.lit("Mature")), F.col("_aw"),
                                   F.col("trend"), F.col("_st"), F.coalesce(F.col("obsolescence_risk"), F.lit(0.1))),
        "_turns": inventory_turns(cost * F.col("units_total"), cost * F.greatest(on_hand, F.lit(1.0)) * 52),
    })
    return df.select(
        "sku_id", F.col("p_category").alias("category"), "region", cost.alias("unit_cost"),
        on_hand.alias("on_hand_inventory"), on_order.alias("on_order_inventory"),
        F.col("_avail").alias("available_inventory"),
        r3(avg).alias("average_weekly_demand"), r3(sd).alias("demand_std"), r4(F.col("trend")).alias("demand_trend"),
        r2(F.col("_ohw")).alias("on_hand_weeks_of_cover"), r2(F.col("_aw")).alias("available_weeks_of_cover"),
        r3(F.col("_turns")).alias("inventory_turns"), r4(F.col("_st")).alias("sell_through_rate"),
        r4(F.col("_sp")).alias("stockout_probability"), r2(F.col("_ss")).alias("safety_stock"),
        r2(F.col("_rop")).alias("reorder_point"), r2(F.col("_ex")).alias("excess_units"),
        r2(excess_value(F.col("_ex"), cost)).alias("excess_inventory_value"),
        r2(lost_sales(F.col("latent_sum"), F.col("sold_sum"), F.col("lost_sum"))).alias("lost_sales_estimate"),
        r4(F.col("_obs")).alias("obsolescence_risk_score"), r2(F.col("_lt")).alias("lead_time_weeks"),
        F.coalesce(F.col("case_pack"), F.lit(1)).cast("int").alias("case_pack"),
        F.coalesce(F.col("minimum_order_quantity"), F.lit(1)).cast("int").alias("minimum_order_quantity"),
        F.coalesce(F.col("lifecycle_stage"), F.lit("Mature")).alias("lifecycle_stage"),
        F.coalesce(F.col("product_age_weeks"), F.lit(52)).alias("product_age_weeks"),
    )
