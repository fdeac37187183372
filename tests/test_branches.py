"""One hand-written row per outcome of the rule chains (status, actions, replenishment, pricing, classes)."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import elasticity as el
from shelfwise.operators import policy as pol
from shelfwise.operators import pricing as pr

STATUS_COLS = ("on_hand_inventory double, available_weeks_of_cover double, on_hand_weeks_of_cover double, "
               "stockout_probability double, lead_time_weeks double, inventory_turns double, "
               "obsolescence_risk_score double, lifecycle_stage string, demand_trend double, expect string")


def test_inventory_status_every_branch(spark):
    rows = [
        (0.0, 10.0, 10.0, 0.0, 1.0, 5.0, 0.1, "Mature", 0.0, "STOCKOUT"),
        (50.0, 10.0, 10.0, 0.7, 1.0, 5.0, 0.1, "Mature", 0.0, "STOCKOUT_RISK"),
        (50.0, 10.0, 0.5, 0.1, 1.0, 5.0, 0.1, "Mature", 0.0, "STOCKOUT_RISK"),
        (50.0, 10.0, 10.0, 0.1, 1.0, 5.0, 0.7, "Mature", 0.0, "OBSOLETE_RISK"),
        (50.0, 10.0, 10.0, 0.1, 1.0, 5.0, 0.1, "Decline", 0.0, "OBSOLETE_RISK"),
        (50.0, 3.0, 3.0, 0.1, 1.0, 5.0, 0.1, "Mature", 0.0, "UNDERSTOCKED"),
        (50.0, 12.0, 12.0, 0.1, 1.0, 1.0, 0.1, "Mature", 0.0, "SLOW_MOVING"),
        (50.0, 20.0, 20.0, 0.1, 1.0, 5.0, 0.1, "Mature", 0.0, "OVERSTOCKED"),
        (50.0, 10.0, 10.0, 0.1, 1.0, 5.0, 0.1, "Mature", 0.0, "HEALTHY"),
        (50.0, 10.0, 10.0, 0.1, 1.0, 5.0, 0.1, "Mature", -0.5, "HEALTHY"),
    ]
    df = pol.inventory_status(spark.createDataFrame(rows, STATUS_COLS))
    for r in df.collect():
        assert r["inventory_status"] == r["expect"], r


ACTION_COLS = ("status string, el double, on_order double, aw double, obs double, conf double, tflag boolean, "
               "md boolean, rop double, sp double, action string, reason string")


def test_inventory_action_every_reachable_branch(spark):
    rows = [
        ("OVERSTOCKED", -1.2, 0.0, 20.0, 0.1, 0.8, True, False, 10.0, 0.0, "INTER_REGION_TRANSFER", "REGIONAL_IMBALANCE_TRANSFER"),
        ("STOCKOUT", -1.2, 0.0, 0.0, 0.1, 0.8, False, False, 10.0, 0.9, "EXPEDITE_ORDER", "STOCKOUT_EXPEDITE"),
        ("UNDERSTOCKED", -1.2, 9.0, 2.0, 0.1, 0.8, False, False, 10.0, 0.1, "NO_ACTION", "ON_ORDER_SUFFICIENT"),
        ("STOCKOUT_RISK", -1.2, 0.0, 1.0, 0.1, 0.8, False, False, 10.0, 0.8, "EXPEDITE_ORDER", "HIGH_STOCKOUT_RISK"),
        ("UNDERSTOCKED", -1.2, 0.0, 2.0, 0.1, 0.8, False, False, 10.0, 0.1, "REPLENISH", "UNDERSTOCKED_REPLENISH"),
        ("OVERSTOCKED", -1.2, 5.0, 20.0, 0.1, 0.8, False, False, 10.0, 0.0, "STOP_OR_DELAY_ORDER", "EXCESS_ON_ORDER"),
        ("SLOW_MOVING", -1.2, 0.0, 12.0, 0.6, 0.8, False, False, 10.0, 0.0, "STOP_OR_DELAY_ORDER", "OBSOLESCENCE_STOP_ORDER"),
        ("OVERSTOCKED", -0.3, 0.0, 14.0, 0.1, 0.8, False, False, 10.0, 0.0, "STOP_OR_DELAY_ORDER", "INELASTIC_OVERSTOCK"),
        ("SLOW_MOVING", -0.9, 0.0, 12.0, 0.1, 0.8, False, True, 10.0, 0.0, "PRICE_MARKDOWN", "POSITIVE_MARKDOWN_ECONOMICS"),
        ("OVERSTOCKED", -1.2, 0.0, 14.0, 0.1, 0.8, False, False, 10.0, 0.0, "PRICE_MARKDOWN", "EXCESS_HIGH_ELASTICITY"),
        ("OBSOLETE_RISK", -1.2, 0.0, 12.0, 0.4, 0.8, False, False, 10.0, 0.0, "MANUAL_REVIEW", "OBSOLETE_RISK_REVIEW"),
        ("HEALTHY", -1.2, 0.0, 10.0, 0.1, 0.8, False, False, 10.0, 0.0, "NO_ACTION", "HEALTHY_INVENTORY"),
        ("SLOW_MOVING", -0.6, 0.0, 12.0, 0.1, 0.2, False, False, 10.0, 0.0, "MANUAL_REVIEW", "LOW_CONFIDENCE_INVENTORY"),
        ("SLOW_MOVING", -0.6, 0.0, 12.0, 0.1, 0.8, False, False, 10.0, 0.0, "HOLD_PRICE", "NO_INVENTORY_ACTION"),
    ]
    c = F.col
    df = spark.createDataFrame(rows, ACTION_COLS).withColumn("a", pol.inventory_action_col(
        c("status"), c("el"), c("on_order"), c("aw"), c("obs"), c("conf"), c("tflag"), c("md"), c("rop"), c("sp")))
    for r in df.collect():
        assert (r["a"]["action"], r["a"]["reason"]) == (r["action"], r["reason"]), r


def test_liquidation_review_is_unreachable_but_in_domain(spark):
    # OBSOLETE_RISK with a score >= .8 already stops at STOP_OR_DELAY_ORDER (score > .5)
    c = F.col
    df = spark.createDataFrame([("OBSOLETE_RISK", -1.2, 0.0, 12.0, 0.9, 0.8, False, False, 10.0, 0.0, "", "")],
                               ACTION_COLS)
    r = df.select(pol.inventory_action_col(c("status"), c("el"), c("on_order"), c("aw"), c("obs"), c("conf"),
                                           c("tflag"), c("md"), c("rop"), c("sp")).alias("a")).first()
    assert r["a"]["action"] == "STOP_OR_DELAY_ORDER"


REPL_COLS = ("inventory_status string, on_hand_inventory double, on_order_inventory double, "
             "average_weekly_demand double, demand_std double, lead_time_weeks double, case_pack int, "
             "minimum_order_quantity int, reorder_point double, safety_stock double, stockout_probability double, "
             "expect_action string, expect_reason string")


def test_replenishment_every_reason(spark):
    rows = [
        ("STOCKOUT", 0.0, 0.0, 10.0, 2.0, 1.0, 6, 1, 15.0, 3.0, 0.9, "EXPEDITE_ORDER", "STOCKOUT_EXPEDITE"),
        ("UNDERSTOCKED", 5.0, 20.0, 10.0, 2.0, 1.0, 1, 1, 15.0, 3.0, 0.1, "NO_ACTION", "ON_ORDER_COVERS_REQUIREMENT"),
        ("STOCKOUT_RISK", 5.0, 0.0, 10.0, 2.0, 1.0, 1, 1, 15.0, 3.0, 0.7, "EXPEDITE_ORDER", "IMMINENT_STOCKOUT"),
        ("UNDERSTOCKED", 5.0, 0.0, 10.0, 2.0, 1.0, 1, 24, 15.0, 3.0, 0.1, "REPLENISH", "BELOW_REORDER_POINT"),
        ("OVERSTOCKED", 100.0, 10.0, 10.0, 2.0, 1.0, 1, 1, 15.0, 3.0, 0.0, "STOP_OR_DELAY_ORDER", "EXCESS_ON_ORDER"),
        ("HEALTHY", 50.0, 0.0, 10.0, 2.0, 1.0, 1, 1, 15.0, 3.0, 0.0, "NO_ACTION", "SUFFICIENT_INVENTORY"),
    ]
    out = pol.replenishment(spark.createDataFrame(rows, REPL_COLS)).collect()
    for r in out:
        assert (r["replenishment_action"], r["replenishment_reason"]) == (r["expect_action"], r["expect_reason"]), r
    by = {r["expect_reason"]: r for r in out}
    assert by["STOCKOUT_EXPEDITE"]["recommended_order_quantity"] == 42.0  # max(pack(15), pack(40)) with pack 6
    assert by["BELOW_REORDER_POINT"]["recommended_order_quantity"] == 24.0  # MOQ bump (not pack aligned)


@pytest.mark.parametrize("change,conf,guards,expected", [
    (0.005, 0.2, [], "Hold"), (0.03, 0.2, [], "Test"), (0.08, 0.2, [], "Manual Review"),
    (0.03, 0.8, ["LOW_CONFIDENCE"], "Test"), (0.003, 0.8, [], "Hold"), (0.02, 0.8, [], "Increase"),
    (-0.02, 0.8, [], "Decrease"), (0.008, 0.8, [], "Hold")])
def test_pricing_action(spark, change, conf, guards, expected):
    df = spark.createDataFrame([(change, conf, guards)], "c double, k double, g array<string>")
    assert df.select(pr.pricing_action(F.col("c"), F.col("k"), F.col("g"))).first()[0] == expected


@pytest.mark.parametrize("e,c,expected", [
    (-2.0, 0.8, "Highly elastic"), (-1.2, 0.8, "Elastic"), (-0.7, 0.8, "Moderate"), (-0.3, 0.8, "Inelastic"),
    (-0.1, 0.8, "Moderate"), (-2.0, 0.3, "Low confidence")])
def test_elasticity_class(spark, e, c, expected):
    df = spark.createDataFrame([(e, c)], "e double, c double")
    assert df.select(el.elasticity_class_col(F.col("e"), F.col("c"))).first()[0] == expected


GUARD_COLS = ("realized_price double, unit_cost double, best_price double, excess_inventory_flag boolean, "
              "weeks_of_cover double, el_confidence_score double, minimum_margin_pct double, "
              "minimum_advertised_price double, customer_tier string, tier_retail_price double, "
              "tier_trade_price double, competitor_price_index double, expect_reason string, expect_guards string")


def test_guardrail_chain(spark):
    rows = [
        # max move (10%) caps a +15% candidate
        (100.0, 50.0, 115.0, False, 8.0, 0.8, 0.15, 0.0, "Retail", 100.0, 90.0, 1.0, "NO_MATERIAL_OPPORTUNITY", "MAX_MOVE"),
        # margin floor: cost 90, min margin .15 -> 105.88
        (100.0, 90.0, 95.0, False, 8.0, 0.8, 0.15, 0.0, "Retail", 100.0, 90.0, 1.0, "LOW_MARGIN_PROTECTION", "MARGIN_FLOOR"),
        # MAP 99
        (100.0, 50.0, 95.0, False, 8.0, 0.8, 0.15, 99.0, "Retail", 100.0, 90.0, 1.0, "MAP_CONSTRAINT", "MAP"),
        # tier ladder: Trade above Retail
        (100.0, 50.0, 105.0, False, 8.0, 0.8, 0.15, 0.0, "Trade", 102.0, 100.0, 1.0, "PRICE_LADDER_CONSTRAINT", "TIER_LADDER"),
        # stockout protection: no cut at cover < 2
        (100.0, 50.0, 95.0, False, 1.0, 0.8, 0.15, 0.0, "Retail", 100.0, 90.0, 1.0, "STOCKOUT_PROTECTION", "STOCKOUT_PROTECTION"),
        # no guard, competitor gap
        (100.0, 50.0, 101.99, False, 8.0, 0.8, 0.15, 0.0, "Retail", 110.0, 90.0, 1.2, "COMPETITOR_PRICE_GAP", ""),
        # no guard, excess markdown
        (100.0, 50.0, 95.99, True, 20.0, 0.8, 0.15, 0.0, "Retail", 110.0, 90.0, 1.0, "EXCESS_INVENTORY_MARKDOWN", ""),
        # no guard, inelastic margin opportunity
        (100.0, 50.0, 105.99, False, 8.0, 0.8, 0.15, 0.0, "Retail", 110.0, 90.0, 1.0, "INELASTIC_MARGIN_OPPORTUNITY", ""),
    ]
    df = pr.apply_guardrails(spark.createDataFrame(rows, GUARD_COLS))
    for r in df.collect():
        assert r["reason_code"] == r["expect_reason"], (r["reason_code"], r["expect_reason"], r["guardrail_triggered"])
        assert r["guardrail_triggered"] == r["expect_guards"], r
