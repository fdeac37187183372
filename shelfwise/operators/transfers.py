"""Inter-region transfer proposals.

Destinations (shortage statuses) are collected per SKU into one array sorted by
region; each source (excess status) row meets that array in an equi-join on
sku_id.  A destination's shortage is not reduced by earlier transfers, so every
source is independent: its greedy allocation is a fold over the array
(``aggregate``), then ``explode`` of the kept transfers.  The array has at most
(regions - 1) elements — a bound fixed by the region dimension, not by the data
volume — and no source x destination pair rows are materialised.
``transfer_candidates`` (the candidate listing report) is the only pair output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.config import DEFAULT_SCENARIO, EXCESS_STATUSES, INVENTORY_POLICY, SHORTAGE_STATUSES, Scenario
from shelfwise.functions.columns import r2
from shelfwise.operators.inventory import case_pack_round
from shelfwise.operators.policy import inventory_status_col

_STATUS_INPUTS = ["on_hand_inventory", "available_weeks_of_cover", "on_hand_weeks_of_cover", "stockout_probability",
                  "lead_time_weeks", "inventory_turns", "obsolescence_risk_score", "lifecycle_stage", "demand_trend"]
_OUT_TYPE = ("array<struct<destination_region:string,qty:double,d_on_hand:double,d_avg:double,"
             "d_status:string,d_ohw:double,d_sp:double,d_lt:double,d_turns:double,d_obs:double,"
             "d_stage:string,d_trend:double>>")


def transfer_candidates(metrics: DataFrame) -> DataFrame:
    """Source x destination pairs of the same SKU (equi-join on sku_id, regions differ)."""
    src = metrics.filter(F.col("inventory_status").isin(*EXCESS_STATUSES)).select(
        "sku_id", "category", F.col("region").alias("source_region"),
        *[F.col(c).alias("s_" + c) for c in _STATUS_INPUTS + ["safety_stock", "average_weekly_demand", "case_pack",
                                                              "unit_cost", "inventory_status"]])
    dst = metrics.filter(F.col("inventory_status").isin(*SHORTAGE_STATUSES)).select(
        "sku_id", F.col("region").alias("destination_region"),
        *[F.col(c).alias("d_" + c) for c in _STATUS_INPUTS + ["reorder_point", "on_order_inventory",
                                                              "average_weekly_demand", "inventory_status"]])
    pairs = src.join(dst, "sku_id").filter(F.col("source_region") != F.col("destination_region"))
    short = F.greatest(F.lit(0.0), F.col("d_reorder_point") - F.col("d_on_hand_inventory") - F.col("d_on_order_inventory"))
    return pairs.withColumns({
        "source_excess": F.greatest(F.lit(0.0), F.col("s_on_hand_inventory") - F.col("s_safety_stock")
                                    - F.col("s_average_weekly_demand") * 2),
        "destination_shortage": F.when(short <= 0, F.col("d_average_weekly_demand") * 2).otherwise(short),
    })


def _status_after(prefix: str, on_hand, avg, sc: Scenario):
    c = lambda n: F.col(prefix + n)
    woc = on_hand / F.greatest(avg, F.lit(0.01))
    return inventory_status_col(on_hand, woc, c("on_hand_weeks_of_cover"), c("stockout_probability"),
                                c("lead_time_weeks"), c("inventory_turns"), c("obsolescence_risk_score"),
                                c("lifecycle_stage"), c("demand_trend"), sc)


def destination_lists(metrics: DataFrame) -> DataFrame:
    """Per SKU: its shortage-status regions as one array sorted by region (<= regions - 1 elements)."""
    short = F.greatest(F.lit(0.0), F.col("reorder_point") - F.col("on_hand_inventory") - F.col("on_order_inventory"))
    dest = F.struct(
        F.col("region").alias("destination_region"),
        F.when(short <= 0, F.col("average_weekly_demand") * 2).otherwise(short).alias("shortage"),
        F.col("on_hand_inventory").alias("d_on_hand"), F.col("average_weekly_demand").alias("d_avg"),
        F.col("inventory_status").alias("d_status"), F.col("on_hand_weeks_of_cover").alias("d_ohw"),
        F.col("stockout_probability").alias("d_sp"), F.col("lead_time_weeks").alias("d_lt"),
        F.col("inventory_turns").alias("d_turns"), F.col("obsolescence_risk_score").alias("d_obs"),
        F.col("lifecycle_stage").alias("d_stage"), F.col("demand_trend").alias("d_trend"))
    return metrics.filter(F.col("inventory_status").isin(*SHORTAGE_STATUSES)).groupBy("sku_id").agg(
        F.array_sort(F.collect_list(dest)).alias("dests"))


def transfer_allocation(metrics: DataFrame, sc: Scenario = DEFAULT_SCENARIO) -> DataFrame:
    """Greedy per-source allocation; keeps transfers whose net value beats the scenario minimum.

    Each source row is equi-joined (on sku_id) to its SKU's destination array and
    folds over it; no source x destination pair rows are materialised.
    """
    cap = float(INVENTORY_POLICY["maximum_transfer_units"])
    cost_per = INVENTORY_POLICY["transfer_cost_per_unit"]
    min_value = sc.minimum_transfer_value
    src = metrics.filter(F.col("inventory_status").isin(*EXCESS_STATUSES)).select(
        "sku_id", "category", F.col("region").alias("source_region"),
        F.greatest(F.lit(0.0), F.col("on_hand_inventory") - F.col("safety_stock")
                   - F.col("average_weekly_demand") * 2).alias("source_excess"),
        *[F.col(c).alias("s_" + c) for c in _STATUS_INPUTS + ["case_pack", "unit_cost", "inventory_status",
                                                              "average_weekly_demand"]])
    src_keys = [c for c in src.columns]
    per_src = src.filter(F.col("source_excess") > 0).join(destination_lists(metrics), "sku_id")
    pack, ucost = F.col("s_case_pack"), F.col("s_unit_cost")

    def step(acc, d):
        avail = acc["rem"]
        qty = case_pack_round(F.least(avail, d["shortage"], F.lit(cap)), pack)
        gp = qty * (ucost * 1.5 - ucost) * 0.7
        net = gp - qty * cost_per
        keep = ((d["destination_region"] != F.col("source_region")) & (avail > 0) & (qty > 0)
                & (net > min_value) & (gp > qty * cost_per))
        rec = F.struct(d["destination_region"].alias("destination_region"), qty.alias("qty"),
                       d["d_on_hand"].alias("d_on_hand"), d["d_avg"].alias("d_avg"), d["d_status"].alias("d_status"),
                       d["d_ohw"].alias("d_ohw"), d["d_sp"].alias("d_sp"), d["d_lt"].alias("d_lt"),
                       d["d_turns"].alias("d_turns"), d["d_obs"].alias("d_obs"), d["d_stage"].alias("d_stage"),
                       d["d_trend"].alias("d_trend"))
        return F.struct(
            F.when(keep, avail - qty).otherwise(avail).alias("rem"),
            F.when(keep, F.concat(acc["out"], F.array(rec))).otherwise(acc["out"]).alias("out"))

    init = F.struct(F.col("source_excess").alias("rem"), F.expr(f"cast(array() as {_OUT_TYPE})").alias("out"))
    folded = per_src.withColumn("_t", F.explode(F.aggregate("dests", init, step)["out"]))
    t = folded.select(*src_keys, "_t.*")
    qty = F.col("qty")
    unit_price = ucost * 1.5
    gp = qty * (unit_price - ucost) * 0.7
    for k, v in {"d_on_hand_weeks_of_cover": "d_ohw", "d_stockout_probability": "d_sp", "d_lead_time_weeks": "d_lt",
                 "d_inventory_turns": "d_turns", "d_obsolescence_risk_score": "d_obs",
                 "d_lifecycle_stage": "d_stage", "d_demand_trend": "d_trend"}.items():
        t = t.withColumnRenamed(v, k)
    return t.select(
        "sku_id", "category", "source_region", "destination_region", qty.alias("transfer_quantity"),
        r2(qty * cost_per).alias("transfer_cost"), F.lit(cost_per).alias("transfer_cost_per_unit"),
        r2(qty * unit_price * 0.7).alias("expected_revenue_recovered"), r2(gp).alias("expected_gp_recovered"),
        r2(gp - qty * cost_per).alias("net_transfer_value"),
        F.col("s_inventory_status").alias("source_status_before"),
        _status_after("s_", F.col("s_on_hand_inventory") - qty, F.col("s_average_weekly_demand"), sc)
        .alias("source_status_after"),
        F.col("d_status").alias("destination_status_before"),
        _status_after("d_", F.col("d_on_hand") + qty, F.col("d_avg"), sc).alias("destination_status_after"),
        F.lit("REGIONAL_IMBALANCE").alias("transfer_reason"),
    )
