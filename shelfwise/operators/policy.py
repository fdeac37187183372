"""Inventory status, actions, markdown economics, conflicts and replenishment (column rules)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.config import (
    ACTION_MATRIX, DEFAULT_SCENARIO, EXCESS_STATUSES, INVENTORY_POLICY, LEGACY_ACTION_LABELS, SHORTAGE_STATUSES,
    Scenario,
)
from shelfwise.operators.inventory import case_pack_round, reorder_point, safety_stock


def inventory_status_col(on_hand: Column, avail_woc: Column, on_hand_woc: Column, sp: Column, lead: Column,
                         turns: Column, obs: Column, stage: Column, trend: Column,
                         sc: Scenario = DEFAULT_SCENARIO) -> Column:
    """First flag by priority STOCKOUT > STOCKOUT_RISK > OBSOLETE_RISK > UNDERSTOCKED > SLOW_MOVING > OVERSTOCKED."""
    mn, mx = sc.policy("minimum_weeks_of_cover"), sc.policy("maximum_weeks_of_cover")
    tgt, slow = sc.policy("target_weeks_of_cover"), sc.policy("slow_moving_turns_threshold")
    return (
        F.when(on_hand <= 0, "STOCKOUT")
        .when((sp >= sc.policy("stockout_probability_threshold")) | ((on_hand_woc < lead) & (on_hand > 0)),
              "STOCKOUT_RISK")
        .when((obs >= sc.policy("obsolescence_threshold")) | (stage.isin("Decline", "End-of-Life") & (avail_woc > mn)),
              "OBSOLETE_RISK")
        .when((avail_woc < mn) & (on_hand > 0), "UNDERSTOCKED")
        .when((turns < slow) & (avail_woc > tgt), "SLOW_MOVING")
        .when(avail_woc > mx, "OVERSTOCKED")
        .otherwise("HEALTHY")
    )


def inventory_status(metrics: DataFrame, sc: Scenario = DEFAULT_SCENARIO) -> DataFrame:
    c = F.col
    return metrics.withColumn("inventory_status", inventory_status_col(
        c("on_hand_inventory"), c("available_weeks_of_cover"), c("on_hand_weeks_of_cover"), c("stockout_probability"),
        c("lead_time_weeks"), c("inventory_turns"), c("obsolescence_risk_score"), c("lifecycle_stage"),
        c("demand_trend"), sc))


def markdown_economics(base_gp: Column, proj_gp: Column, excess_val: Column, obs: Column) -> dict:
    holding = excess_val * INVENTORY_POLICY["annual_holding_cost_rate"] * (4 / 52)
    avoided = excess_val * obs * 0.1
    net = proj_gp - base_gp + holding + avoided
    return {"net_markdown_value": net, "holding_cost_reduction": holding, "avoided_obsolescence_loss": avoided,
            "markdown_recommended": net > INVENTORY_POLICY["minimum_markdown_value"]}


def elasticity_bucket(el: Column) -> Column:
    a = F.abs(el)
    return F.when(a >= 1.0, "high").when(a >= 0.5, "low").otherwise("any")


def action_matrix(df: DataFrame, status_col: str = "inventory_status", el_col: str = "elasticity") -> DataFrame:
    """Matrix lookup (status, bucket), then (status, any), else Hold / NO_ACTION: two small joins."""
    spark = df.sparkSession
    m = spark.createDataFrame(ACTION_MATRIX, "m_status string, m_bucket string, m_pricing string, m_stock string")
    exact = m.select(F.col("m_status").alias("_s1"), F.col("m_bucket").alias("_b1"),
                     F.col("m_pricing").alias("_p1"), F.col("m_stock").alias("_k1"))
    anyb = m.filter(F.col("m_bucket") == "any").select(F.col("m_status").alias("_s2"), F.col("m_pricing").alias("_p2"),
                                                      F.col("m_stock").alias("_k2"))
    d = df.withColumn("_bucket", elasticity_bucket(F.col(el_col)))
    d = d.join(F.broadcast(exact), (d[status_col] == exact["_s1"]) & (d["_bucket"] == exact["_b1"]), "left")
    d = d.join(F.broadcast(anyb), d[status_col] == anyb["_s2"], "left")  # 12-row constant table
    return d.withColumns({
        "matrix_pricing_action": F.coalesce("_p1", "_p2", F.lit("Hold")),
        "matrix_inventory_action": F.coalesce("_k1", "_k2", F.lit("NO_ACTION")),
    }).drop("_bucket", "_s1", "_b1", "_p1", "_k1", "_s2", "_p2", "_k2")


def inventory_action_col(status: Column, el: Column, on_order: Column, avail_woc: Column, obs: Column, conf: Column,
                         transfer: Column, md_recommended: Column, rop: Column, sp: Column) -> Column:
    """struct(action, reason): transfer > replenish/expedite > stop > markdown > obsolete > healthy > low conf > hold."""
    a = F.abs(el)
    tgt = INVENTORY_POLICY["target_weeks_of_cover"]

    def s(action, reason):
        return F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"))

    short = status.isin("STOCKOUT_RISK", "UNDERSTOCKED")
    md_zone = status.isin("OVERSTOCKED", "SLOW_MOVING") & (a >= 0.8)
    return (
        F.when(transfer & status.isin(*EXCESS_STATUSES), s("INTER_REGION_TRANSFER", "REGIONAL_IMBALANCE_TRANSFER"))
        .when(status == "STOCKOUT", s("EXPEDITE_ORDER", "STOCKOUT_EXPEDITE"))
        .when(short & (on_order >= rop * 0.8), s("NO_ACTION", "ON_ORDER_SUFFICIENT"))
        .when(short & (sp >= 0.7), s("EXPEDITE_ORDER", "HIGH_STOCKOUT_RISK"))
        .when(short, s("REPLENISH", "UNDERSTOCKED_REPLENISH"))
        .when((avail_woc > tgt * 2) & (on_order > 0), s("STOP_OR_DELAY_ORDER", "EXCESS_ON_ORDER"))
        .when(status.isin("SLOW_MOVING", "OBSOLETE_RISK") & (obs > 0.5), s("STOP_OR_DELAY_ORDER", "OBSOLESCENCE_STOP_ORDER"))
        .when((status == "OVERSTOCKED") & (a < 0.5), s("STOP_OR_DELAY_ORDER", "INELASTIC_OVERSTOCK"))
        .when(md_zone & md_recommended, s("PRICE_MARKDOWN", "POSITIVE_MARKDOWN_ECONOMICS"))
        .when(md_zone & (status == "OVERSTOCKED") & (a >= 1.0), s("PRICE_MARKDOWN", "EXCESS_HIGH_ELASTICITY"))
        .when((status == "OBSOLETE_RISK") & (obs >= 0.8), s("LIQUIDATION_REVIEW", "HIGH_OBSOLESCENCE"))
        .when(status == "OBSOLETE_RISK", s("MANUAL_REVIEW", "OBSOLETE_RISK_REVIEW"))
        .when(status == "HEALTHY", s("NO_ACTION", "HEALTHY_INVENTORY"))
        .when(conf < 0.4, s("MANUAL_REVIEW", "LOW_CONFIDENCE_INVENTORY"))
        .otherwise(s("HOLD_PRICE", "NO_INVENTORY_ACTION"))
    )


def legacy_action_label(action: Column) -> Column:
    expr = None
    for k, v in LEGACY_ACTION_LABELS.items():
        expr = F.when(action == k, v) if expr is None else expr.when(action == k, v)
    return expr.otherwise("Hold")


def conflict_resolution(pa: Column, inv_action: Column, status: Column, change: Column) -> dict:
    short = status.isin(*SHORTAGE_STATUSES)
    pa1 = F.when(short & ((pa == "Decrease") | (change < -0.005)), "Hold").otherwise(pa)
    manual1 = short & inv_action.isin("REPLENISH", "EXPEDITE_ORDER") & (pa1 == "Decrease")
    pa2 = F.when(inv_action.isin("STOP_OR_DELAY_ORDER", "INTER_REGION_TRANSFER", "LIQUIDATION_REVIEW")
                 & (pa1 == "Decrease"), "Hold").otherwise(pa1)
    manual = manual1 | (inv_action == "MANUAL_REVIEW")
    return {"adjusted_pricing_action": pa2, "inventory_action": inv_action, "manual_review": manual}


def replenishment(metrics: DataFrame, sc: Scenario = DEFAULT_SCENARIO) -> DataFrame:
    """Net requirement, pack/MOQ-rounded order quantity and action by status."""
    c = F.col
    hand, order, avg = c("on_hand_inventory"), c("on_order_inventory"), c("average_weekly_demand")
    sd = F.coalesce(c("demand_std"), avg * 0.2)
    lt = F.coalesce(c("lead_time_weeks"), F.lit(2.0))
    pack = F.coalesce(c("case_pack"), F.lit(1))
    moq = F.coalesce(c("minimum_order_quantity"), F.lit(INVENTORY_POLICY["minimum_order_quantity"]))
    rop0, ss0 = F.coalesce(c("reorder_point"), F.lit(0.0)), F.coalesce(c("safety_stock"), F.lit(0.0))
    ss = F.when(rop0 <= 0, safety_stock(sd, lt, sc.service_level_z)).otherwise(ss0)
    df = metrics.withColumns({"_ss": ss})
    df = df.withColumn("_rop", F.when(rop0 <= 0, reorder_point(avg, lt, c("_ss"))).otherwise(rop0))
    df = df.withColumn("_net", F.greatest(F.lit(0.0), c("_rop") - hand - order))
    q = case_pack_round(c("_net"), pack)
    df = df.withColumn("_q", F.when((q > 0) & (q < moq), moq.cast("double")).otherwise(q))
    st = c("inventory_status")
    short = st.isin("STOCKOUT_RISK", "UNDERSTOCKED")
    covered = short & (order >= c("_rop") * 0.9)
    exp = short & ~covered & (c("stockout_probability") >= 0.65)
    stop = st.isin(*EXCESS_STATUSES) & (order > 0) & (hand + order > c("_rop") * 2)
    action = (F.when(st == "STOCKOUT", "EXPEDITE_ORDER").when(covered, "NO_ACTION").when(exp, "EXPEDITE_ORDER")
              .when(short, "REPLENISH").when(stop, "STOP_OR_DELAY_ORDER").otherwise("NO_ACTION"))
    reason = (F.when(st == "STOCKOUT", "STOCKOUT_EXPEDITE").when(covered, "ON_ORDER_COVERS_REQUIREMENT")
              .when(exp, "IMMINENT_STOCKOUT").when(short, "BELOW_REORDER_POINT").when(stop, "EXCESS_ON_ORDER")
              .otherwise("SUFFICIENT_INVENTORY"))
    qty = (F.when(st == "STOCKOUT", F.greatest(c("_q"), case_pack_round(avg * 4, pack)))
           .when(covered | stop, F.lit(0.0)).otherwise(c("_q")))
    return df.withColumns({
        "reorder_point": c("_rop"), "safety_stock": c("_ss"), "net_requirement": c("_net"),
        "recommended_order_quantity": qty,
        "expected_stockout_weeks": F.when(avg > 0, F.floor(hand / avg * 100 + 0.5) / 100.0).otherwise(999.0),
        "replenishment_action": action, "replenishment_reason": reason,
    }).drop("_ss", "_rop", "_net", "_q")
