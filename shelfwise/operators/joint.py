"""Joint pricing + inventory decision: pricing rows left-joined to the SKU x region snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.config import DEFAULT_SCENARIO, Scenario
from shelfwise.functions.columns import r3
from shelfwise.operators.policy import conflict_resolution, inventory_action_col, markdown_economics

SR = ["sku_id", "region"]
INV_COLS = ["on_hand_inventory", "on_order_inventory", "average_weekly_demand", "demand_std", "inventory_turns",
            "on_hand_weeks_of_cover", "available_weeks_of_cover", "sell_through_rate", "stockout_probability",
            "safety_stock", "reorder_point", "excess_units", "excess_inventory_value", "lost_sales_estimate",
            "obsolescence_risk_score"]


def transfer_flag(transfers: DataFrame) -> DataFrame:
    """(sku_id, region) keys that are the source or destination of any transfer."""
    a = transfers.select("sku_id", F.col("source_region").alias("region"))
    b = transfers.select("sku_id", F.col("destination_region").alias("region"))
    return a.union(b).distinct().withColumn("transfer_candidate_flag", F.lit(True))


def history_weeks(panel: DataFrame) -> DataFrame:
    return panel.groupBy(*SR).agg(F.countDistinct("week_num").alias("history_weeks"))


def joint_confidence(el_conf, weeks, censor_pct, stability: float = 0.7) -> dict:
    completeness = F.least(F.lit(1.0), weeks / 13.0)
    penalty = F.least(F.lit(0.3), censor_pct * 0.5)
    score = (F.lit(0.35) * el_conf + F.lit(0.25) * completeness + F.lit(0.20 * stability)
             + F.lit(0.20) * (F.lit(1.0) - penalty))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))
    level = F.when(score >= 0.7, "HIGH").when(score >= 0.4, "MEDIUM").otherwise("LOW")
    return {"joint_confidence": level, "joint_confidence_score": r3(score)}


def joint_recommendations(recs: DataFrame, inv: DataFrame, transfers: DataFrame, panel: DataFrame,
                          sc: Scenario = DEFAULT_SCENARIO, generated_at: str = "1970-01-01T00:00:00") -> DataFrame:
    """recs: 24-column pricing rows; inv: snapshot + status + replenishment columns."""
    inv_sel = inv.select(*SR, *[F.col(c).alias("i_" + c) for c in INV_COLS], F.col("inventory_status").alias("i_status"),
                         F.col("recommended_order_quantity").alias("i_order_qty"))
    df = (recs.join(inv_sel, SR, "left").join(transfer_flag(transfers), SR, "left")
          .join(history_weeks(panel), SR, "left"))
    inv_c = {c: F.coalesce(F.col("i_" + c), F.lit(0.0)) for c in INV_COLS}
    status = F.coalesce(F.col("i_status"), F.lit("HEALTHY"))
    tflag = F.coalesce(F.col("transfer_candidate_flag"), F.lit(False))
    md = markdown_economics(F.col("current_gross_profit"), F.col("projected_gross_profit"),
                            inv_c["excess_inventory_value"], inv_c["obsolescence_risk_score"])
    df = df.withColumns({"_status": status, "_tflag": tflag, "_md": md["markdown_recommended"]})
    act = inventory_action_col(F.col("_status"), F.col("elasticity"), inv_c["on_order_inventory"],
                               F.coalesce(F.col("i_available_weeks_of_cover"), F.lit(99.0)),
                               inv_c["obsolescence_risk_score"], F.col("elasticity_confidence"), F.col("_tflag"),
                               F.col("_md"), inv_c["reorder_point"], inv_c["stockout_probability"])
    df = df.withColumn("_act", act)
    cr = conflict_resolution(F.col("recommendation_action"), F.col("_act.action"), F.col("_status"),
                             F.col("price_change_pct"))
    weeks = F.coalesce(F.col("history_weeks"), F.lit(8))
    censor = F.when(F.col("_status").isin("STOCKOUT", "STOCKOUT_RISK"), 0.1).otherwise(0.02)
    jc = joint_confidence(F.col("elasticity_confidence"), weeks, censor)
    df = df.withColumns({"_pa": cr["adjusted_pricing_action"], "_manual": cr["manual_review"],
                         "joint_confidence": jc["joint_confidence"], "joint_confidence_score": jc["joint_confidence_score"]})
    low = F.col("joint_confidence") == "LOW"
    big = low & (F.abs(F.col("price_change_pct")) > 0.03)
    tr = low & (F.col("_act.action") == "INTER_REGION_TRANSFER")
    pa = F.when(big, "Manual Review").otherwise(F.col("_pa"))
    final_inv = F.when(tr, "MANUAL_REVIEW").otherwise(F.col("_act.action"))
    manual = F.col("_manual") | big | tr
    rec_cols = [c for c in recs.columns if c not in ("recommendation_action", "reason_code")]
    return df.select(
        *rec_cols,
        pa.alias("pricing_action"), F.col("reason_code").alias("pricing_reason_code"),
        F.col("gross_profit_lift").alias("modeled_gp_lift"),
        *[inv_c[c].alias(c) for c in INV_COLS],
        F.col("_status").alias("inventory_status"), final_inv.alias("inventory_action"),
        F.col("_act.reason").alias("inventory_reason_code"),
        F.coalesce(F.col("i_order_qty"), F.lit(0.0)).alias("recommended_order_quantity"),
        F.col("_tflag").alias("transfer_candidate_flag"),
        F.col("elasticity_confidence").alias("pricing_confidence"),
        F.col("joint_confidence_score").alias("inventory_confidence"),
        "joint_confidence", "joint_confidence_score", manual.alias("manual_review_required"),
        pa.alias("recommendation_action"), "reason_code", F.lit(generated_at).alias("generated_at"),
    )
