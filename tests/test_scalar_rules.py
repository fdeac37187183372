"""Exact values of the scalar formulas (one-row frames), mirroring the reference's unit checks."""

import math

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import backtest as bt
from shelfwise.operators import inventory as inv
from shelfwise.operators import joint as jt
from shelfwise.operators import policy as pol
from shelfwise.operators import pricing as pr


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_weeks_of_cover(spark):
    assert one(spark, inv.weeks_of_cover(F.lit(100.0), F.lit(10.0))) == pytest.approx(10.0)
    assert one(spark, inv.weeks_of_cover(F.lit(100.0), F.lit(0.005))) == 999.0


def test_inventory_turns_zero_denominator(spark):
    assert one(spark, inv.inventory_turns(F.lit(1000.0), F.lit(0.0))) == 0.0


def test_safety_stock(spark):
    v = one(spark, inv.safety_stock(F.lit(5.0), F.lit(2.0), 1.65))
    assert v == pytest.approx(1.65 * 5 * math.sqrt(2))
    assert v >= 0


def test_reorder_point(spark):
    assert one(spark, inv.reorder_point(F.lit(10.0), F.lit(2.0), F.lit(5.0))) == pytest.approx(25.0)


def test_excess_units(spark):
    assert one(spark, inv.excess_units(F.lit(100.0), F.lit(5.0), 8)) == pytest.approx(60.0)


@pytest.mark.parametrize("q,pack,expected", [(7, 6, 12.0), (7.2, 1, 8.0), (-3, 1, 0.0), (0, 6, 0.0), (12, 6, 12.0)])
def test_case_pack_round(spark, q, pack, expected):
    assert one(spark, inv.case_pack_round(F.lit(float(q)), F.lit(pack))) == expected


def test_stockout_probability_normal_cdf(spark):
    # available 10 vs lead-time demand 10 -> z = 0 -> 0.5
    v = one(spark, inv.stockout_probability(F.lit(5.0), F.lit(5.0), F.lit(5.0), F.lit(2.0), F.lit(2.0)))
    assert v == pytest.approx(0.5, abs=1e-7)
    # z = -1 -> P = Phi(1) = 0.841345
    v = one(spark, inv.stockout_probability(F.lit(8.0), F.lit(0.0), F.lit(10.0), F.lit(2.0), F.lit(1.0)))
    assert v == pytest.approx(0.8413447, abs=2e-7)
    assert one(spark, inv.stockout_probability(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(1.0))) == 0.0
    assert one(spark, inv.stockout_probability(F.lit(1.0), F.lit(0.0), F.lit(5.0), F.lit(0.0), F.lit(1.0))) == 1.0


def test_markdown_economics(spark):
    md = pol.markdown_economics(F.lit(100.0), F.lit(80.0), F.lit(1000.0), F.lit(0.5))
    assert one(spark, md["net_markdown_value"]) == pytest.approx(-20 + 1000 * 0.25 * 4 / 52 + 50, abs=1e-9)
    assert one(spark, md["markdown_recommended"]) is True


def test_conflict_resolution_hold(spark):
    cr = pol.conflict_resolution(F.lit("Decrease"), F.lit("REPLENISH"), F.lit("STOCKOUT_RISK"), F.lit(-0.05))
    assert one(spark, cr["adjusted_pricing_action"]) == "Hold"


def test_joint_confidence_low(spark):
    jc = jt.joint_confidence(F.lit(0.1), F.lit(3), F.lit(0.5))
    assert one(spark, jc["joint_confidence"]) == "LOW"
    jc = jt.joint_confidence(F.lit(0.9), F.lit(20), F.lit(0.02))
    assert one(spark, jc["joint_confidence"]) == "HIGH"


@pytest.mark.parametrize("method,price,expected", [
    ("nearest_dollar", 10.49, 10.0), ("ending_99", 10.2, 10.99), ("ending_95", 10.2, 10.95),
    ("ending_99", 0.456, 0.46), ("cents", 3.14159, 3.14)])
def test_round_price(spark, method, price, expected):
    assert one(spark, pr.round_price(F.lit(price), method)) == pytest.approx(expected)


def test_candidate_grid(spark):
    v = one(spark, pr.candidate_prices(F.lit(100.0)))
    assert len(v) == 31 and v[0] == 85.0 and v[15] == 100.0 and v[-1] == 115.0


def test_predict_at_price(spark):
    assert one(spark, pr.predict_at_price(F.lit(10.0), F.lit(110.0), F.lit(100.0), F.lit(-1.0))) == pytest.approx(10 / 1.1)
    assert one(spark, pr.predict_at_price(F.lit(10.0), F.lit(110.0), F.lit(0.0), F.lit(-1.0))) == 10.0


def test_rollback_boundaries(spark):
    recs = spark.createDataFrame(
        [(100.0, 110.0, 50.0, 1000.0, 1100.0)],
        "current_price double, recommended_price double, gross_profit_lift double, current_revenue double, "
        "projected_revenue double")
    for r, expected in ((0.0, 110.0), (0.5, 105.0), (1.0, 100.0)):
        row = bt.rollback_prices(recs, r).first()
        assert row["rollback_price"] == pytest.approx(expected)
        assert row["gp_retained"] == pytest.approx(50.0 * (1 - r))
