"""Candidate-price simulation, objectives, guardrails and recommendations.

Candidates live in an array column (``transform(sequence(-15, 15), ...)``) and
the winner is taken with ``array_max`` over (score, -index) structs, so the grid
never multiplies rows and never needs a re-grouping shuffle.  The only shuffle
is the latest-row-per-series aggregate; the tier-ladder window on (sku, region)
reuses that partitioning when the input is clustered by SKU.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from shelfwise.config import (
    BALANCED_WEIGHTS, CANDIDATE_MAX_PCT, CANDIDATE_MIN_PCT, DEFAULT_SCENARIO, EXCESS_INVENTORY_MAX_MOVE_PCT,
    LOW_CONFIDENCE_MAX_MOVE_PCT, POLICY_VERSION, WEEKS_OF_COVER_EXCESS, WEEKS_OF_COVER_STOCKOUT_RISK, Scenario,
)
from shelfwise.functions.columns import r2, r4, r6, safe_div

SERIES = ["sku_id", "region", "customer_tier"]


# ------------------------------------------------------------------ latest rows
def latest_by_key(panel: DataFrame, keys=SERIES, order: str = "week_num") -> DataFrame:
    """Last non-null value of every column per key, by ``order`` (one aggregate)."""
    others = [c for c in panel.columns if c not in keys]
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) if c != order
            else F.max(order).alias(order) for c in others]
    return panel.groupBy(*keys).agg(*aggs)


def latest_with_product(latest: DataFrame, products: DataFrame) -> DataFrame:
    cols = ["sku_id"] + [c for c in products.columns if c not in latest.columns]
    return latest.join(products.select(*cols), "sku_id", "left")


# ------------------------------------------------------------ simulation pieces
def predict_at_price(units: Column, price: Column, current: Column, elasticity: Column) -> Column:
    """Elasticity path: max(0, units * (price/current)^e); current <= 0 keeps units."""
    ratio = F.when(current > 0, price / current).otherwise(F.lit(1.0))
    return F.greatest(F.lit(0.0), units * F.pow(ratio, elasticity))


def inventory_impact(inv: Column, units: Column) -> dict:
    ending = F.greatest(F.lit(0.0), inv - units)
    weekly = F.when(units > 0, units).otherwise(F.lit(1.0))
    woc = F.when(weekly <= 0.01, F.lit(999.0)).otherwise(ending / weekly)
    sp = (F.when((ending < 2) & (units > inv), 1.0).when(ending < 5, 0.8).when(ending < 10, 0.1).otherwise(0.0))
    return {"ending": ending, "woc": woc, "stockout_p": sp,
            "excess_remaining": F.when(woc > WEEKS_OF_COVER_EXCESS, ending).otherwise(0.0)}


def simulate_price(row_units: Column, price: Column, current: Column, cost: Column, el: Column, inv: Column) -> dict:
    units = predict_at_price(row_units, price, current, el)
    revenue = price * units
    gp = revenue - cost * units
    d = {"price": price, "units": units, "revenue": revenue, "gross_profit": gp,
         "margin": safe_div(gp, revenue)}
    d.update(inventory_impact(inv, units))
    return d


def candidate_prices(current: Column) -> Column:
    """31 prices current*(1 + p/100), p = -15..15, rounded to cents."""
    return F.transform(F.sequence(F.lit(CANDIDATE_MIN_PCT), F.lit(CANDIDATE_MAX_PCT)),
                       lambda p: r2(current * (F.lit(1.0) + p / 100.0)))


def score(objective: str, sim: dict, cur: dict, change: Column, conf: Column, is_excess: Column) -> Column:
    if objective == "maximize_gross_profit":
        return sim["gross_profit"]
    if objective == "maximize_revenue":
        return sim["revenue"]
    if objective == "reduce_excess_inventory":
        return (cur["ending"] - sim["ending"]) * 10 + sim["gross_profit"] * 0.3
    w = BALANCED_WEIGHTS
    benefit = F.when(is_excess, F.greatest(F.lit(0.0), cur["ending"] - sim["ending"])).otherwise(0.0)
    low_pen = F.when(conf < 0.4, (F.lit(1.0) - conf) * 20).otherwise(0.0)
    return (w["gross_profit"] * sim["gross_profit"] + w["inventory_reduction"] * benefit
            - w["stockout_penalty"] * (sim["stockout_p"] * 100) - w["price_change_penalty"] * (F.abs(change) * 50)
            - w["low_confidence_penalty"] * low_pen)


def simulate_candidates(rows: DataFrame, objective: str = "balanced") -> DataFrame:
    """Array of 31 simulated candidates (struct per price) with their objective score."""
    cur_p, cost = F.col("realized_price"), F.col("unit_cost")
    el, conf = F.col("el_estimated_elasticity"), F.col("el_confidence_score")
    units, inv = F.col("units_sold"), F.col("ending_inventory")
    is_excess = F.col("excess_inventory_flag") | (F.col("weeks_of_cover") > WEEKS_OF_COVER_EXCESS)
    cur = simulate_price(units, cur_p, cur_p, cost, el, inv)

    def one(i, p):
        sim = simulate_price(units, p, cur_p, cost, el, inv)
        change = F.when(cur_p > 0, (p - cur_p) / cur_p).otherwise(0.0)
        sc = score(objective, sim, cur, change, conf, is_excess)
        sc = F.when(F.isnan(sc), F.lit(None)).otherwise(r6(sc))
        return F.struct(
            i.alias("idx"), p.alias("candidate_price"), sim["units"].alias("predicted_units"),
            sim["revenue"].alias("revenue"), sim["gross_profit"].alias("gross_profit"),
            sim["margin"].alias("gross_margin_pct"), sim["ending"].alias("expected_ending_inventory"),
            sim["woc"].alias("expected_weeks_of_cover"), sim["stockout_p"].alias("stockout_probability"),
            sim["excess_remaining"].alias("excess_inventory_remaining"), sc.alias("score"))

    cands = F.transform(candidate_prices(cur_p), lambda p, i: one(i, p))
    return rows.withColumn("candidate_sims", cands)


def argmax_candidate(df: DataFrame) -> DataFrame:
    """Highest score; ties go to the lowest price (first index); no valid score keeps the current price."""
    valid = F.filter("candidate_sims", lambda s: s["score"].isNotNull())
    best = F.array_max(F.transform(valid, lambda s: F.struct(s["score"].alias("s"), (-s["idx"]).alias("ni"),
                                                               s["candidate_price"].alias("p"))))
    return df.withColumn("best_price", F.coalesce(best["p"], F.col("realized_price"))) \
        .withColumn("best_score", best["s"])


def tier_price_map(df: DataFrame) -> DataFrame:
    """Current Retail / Trade / Fleet price of the same SKU and region (null when the tier is absent)."""
    w = W.partitionBy("sku_id", "region")
    return df.withColumns({
        f"tier_{t.lower()}_price": F.max(F.when(F.col("customer_tier") == t, F.col("realized_price"))).over(w)
        for t in ("Retail", "Trade", "Fleet")})


# ------------------------------------------------------------------ guardrails
def round_price(p: Column, method: str = "ending_99") -> Column:
    if method == "nearest_dollar":
        return F.floor(p + 0.5).cast("double")
    if method == "ending_99":
        return F.when(p >= 1, F.floor(p) + 0.99).otherwise(r2(p))
    if method == "ending_95":
        return F.when(p >= 1, F.floor(p) + 0.95).otherwise(r2(p))
    return r2(p)


def _flag(name: str, cond: Column) -> Column:
    return F.when(cond, F.lit(name))


def guard_max_move(df: DataFrame, sc: Scenario) -> DataFrame:
    cur, rec = F.col("realized_price"), F.col("g_price")
    mm = F.when(F.col("excess_inventory_flag") | (F.col("weeks_of_cover") > WEEKS_OF_COVER_EXCESS),
                F.lit(EXCESS_INVENTORY_MAX_MOVE_PCT)).otherwise(F.lit(sc.max_price_move_pct))
    mm = F.when(F.col("el_confidence_score") < 0.4, F.least(mm, F.lit(LOW_CONFIDENCE_MAX_MOVE_PCT))).otherwise(mm)
    actual = F.when(cur > 0, (rec - cur) / cur).otherwise(0.0)
    sign = F.when(actual > 0, 1.0).otherwise(-1.0)
    hit = F.abs(actual) > mm
    return df.withColumns({
        "g1_max_move": hit,
        "g_price": F.when(hit, cur * (F.lit(1.0) + sign * mm)).otherwise(rec),
        "g_change": F.when(hit, sign * mm).otherwise(F.col("g_change")),
        "g_max_move_pct": mm,
    })


def margin_floor_price(df: DataFrame) -> Column:
    mm = F.coalesce(F.col("minimum_margin_pct"), F.lit(0.15))
    return F.when(mm < 1, F.col("unit_cost") / (F.lit(1.0) - mm)).otherwise(F.col("unit_cost") * 1.5)


def guard_margin_floor(df: DataFrame) -> DataFrame:
    df = df.withColumn("g_floor", margin_floor_price(df))
    hit = F.col("g_price") < F.col("g_floor")
    return df.withColumns({
        "g2_margin_floor": hit,
        "g_price": F.when(hit, F.col("g_floor")).otherwise(F.col("g_price")),
        "g_reason": F.when(hit, "LOW_MARGIN_PROTECTION").otherwise(F.col("g_reason")),
    })


def guard_map(df: DataFrame) -> DataFrame:
    mp = F.coalesce(F.col("minimum_advertised_price"), F.lit(0.0))
    hit = (mp > 0) & (F.col("g_price") < mp)
    return df.withColumns({
        "g3_map": hit,
        "g_price": F.when(hit, mp).otherwise(F.col("g_price")),
        "g_reason": F.when(hit, "MAP_CONSTRAINT").otherwise(F.col("g_reason")),
    })


def guard_tier_ladder(df: DataFrame) -> DataFrame:
    """Trade <= Retail; Fleet <= Trade and <= Retail, against current tier prices."""
    tier, retail, trade = F.col("customer_tier"), F.col("tier_retail_price"), F.col("tier_trade_price")
    p0 = F.col("g_price")
    hit_a = (tier == "Trade") & retail.isNotNull() & (p0 > retail)
    hit_b = (tier == "Fleet") & trade.isNotNull() & (p0 > trade)
    df = df.withColumns({
        "g_price": F.when(hit_a, retail).when(hit_b, trade).otherwise(p0),
        "g4_ladder_a": hit_a | hit_b,
        "g_reason": F.when(hit_a | hit_b, "PRICE_LADDER_CONSTRAINT").otherwise(F.col("g_reason")),
    })
    hit_c = (tier == "Fleet") & retail.isNotNull() & (F.col("g_price") > retail)
    return df.withColumns({
        "g4_ladder_b": hit_c,
        "g_price": F.when(hit_c, F.least(F.col("g_price"), retail)).otherwise(F.col("g_price")),
    })


def guard_stockout(df: DataFrame) -> DataFrame:
    cur, p = F.col("realized_price"), F.col("g_price")
    low = F.col("weeks_of_cover") < WEEKS_OF_COVER_STOCKOUT_RISK
    cut = low & (p < cur)
    rise = low & ~(p < cur) & (p > cur * 1.03)
    return df.withColumns({
        "g5_stockout": cut | rise,
        "g_price": F.when(cut, cur).when(rise, cur * 1.03).otherwise(p),
        "g_reason": F.when(cut, "STOCKOUT_PROTECTION").otherwise(F.col("g_reason")),
    })


def guard_low_confidence(df: DataFrame) -> DataFrame:
    cur, ch = F.col("realized_price"), F.col("g_change")
    hit = (F.col("el_confidence_score") < 0.4) & (F.abs(ch) > LOW_CONFIDENCE_MAX_MOVE_PCT)
    new = F.when(ch > 0, cur * (1 + LOW_CONFIDENCE_MAX_MOVE_PCT)).otherwise(cur * (1 - LOW_CONFIDENCE_MAX_MOVE_PCT))
    return df.withColumns({
        "g6_low_conf": hit,
        "g_price": F.when(hit, new).otherwise(F.col("g_price")),
        "g_reason": F.when(hit, "LOW_CONFIDENCE_TEST").otherwise(F.col("g_reason")),
    })


def guard_recheck(df: DataFrame, method: str = "ending_99") -> DataFrame:
    """Round, then re-apply the margin floor and MAP to the rounded price (rounding again)."""
    df = df.withColumn("g_price", round_price(F.col("g_price"), method))
    hit_f = F.col("g_price") < F.col("g_floor")
    df = df.withColumns({"g7_floor": hit_f,
                         "g_price": F.when(hit_f, round_price(F.col("g_floor"), method)).otherwise(F.col("g_price"))})
    mp = F.coalesce(F.col("minimum_advertised_price"), F.lit(0.0))
    hit_m = (mp > 0) & (F.col("g_price") < mp)
    return df.withColumns({"g7_map": hit_m,
                           "g_price": F.when(hit_m, round_price(mp, method)).otherwise(F.col("g_price"))})


GUARD_FLAGS = [("g1_max_move", "MAX_MOVE"), ("g2_margin_floor", "MARGIN_FLOOR"), ("g3_map", "MAP"),
               ("g4_ladder_a", "TIER_LADDER"), ("g4_ladder_b", "TIER_LADDER"), ("g5_stockout", "STOCKOUT_PROTECTION"),
               ("g6_low_conf", "LOW_CONFIDENCE"), ("g7_floor", "MARGIN_FLOOR"), ("g7_map", "MAP")]


def guardrail_list(df: DataFrame) -> DataFrame:
    """Ordered triggered guardrails, duplicates kept; comma-joined public column."""
    arr = F.filter(F.array(*[_flag(n, F.col(c)) for c, n in GUARD_FLAGS]), lambda x: x.isNotNull())
    return df.withColumn("guardrails", arr).withColumn("guardrail_triggered", F.concat_ws(",", "guardrails"))


def reason_code(df: DataFrame) -> DataFrame:
    none = F.size("guardrails") == 0
    fallback = (F.when(F.col("excess_inventory_flag"), "EXCESS_INVENTORY_MARKDOWN")
                .when(F.col("competitor_price_index") > 1.05, "COMPETITOR_PRICE_GAP")
                .when((F.col("el_confidence_score") > 0.6) & (F.col("g_change") > 0.02), "INELASTIC_MARGIN_OPPORTUNITY")
                .otherwise(F.col("g_reason")))
    return df.withColumn("reason_code", F.when(none, fallback).otherwise(F.col("g_reason")))


def pricing_action(change: Column, conf: Column, guardrails: Column) -> Column:
    low = F.array_contains(guardrails, "LOW_CONFIDENCE") | (conf < 0.3)
    a = F.abs(change)
    return (F.when(low & (a < 0.01), "Hold").when(low & (a < 0.05), "Test").when(low, "Manual Review")
            .when(a < 0.005, "Hold").when(change > 0.01, "Increase").when(change < -0.01, "Decrease")
            .otherwise("Hold"))


def apply_guardrails(df: DataFrame, sc: Scenario = DEFAULT_SCENARIO) -> DataFrame:
    cur = F.col("realized_price")
    df = df.withColumns({
        "g_price": F.col("best_price"),
        "g_change": F.when(cur > 0, (F.col("best_price") - cur) / cur).otherwise(0.0),
        "g_reason": F.lit("NO_MATERIAL_OPPORTUNITY"),
    })
    df = guard_max_move(df, sc)
    df = guard_margin_floor(df)
    df = guard_map(df)
    df = guard_tier_ladder(df)
    df = guard_stockout(df)
    df = guard_low_confidence(df)
    df = guard_recheck(df, sc.price_rounding)
    df = guardrail_list(df)
    return reason_code(df)


def optimize_prices(rows: DataFrame, sc: Scenario = DEFAULT_SCENARIO) -> DataFrame:
    """Full per-row chain -> the 24-column recommendation (rows need elasticity + tier prices)."""
    df = argmax_candidate(simulate_candidates(rows, sc.objective))
    df = apply_guardrails(df, sc)
    cur_p, cost = F.col("realized_price"), F.col("unit_cost")
    el, conf = F.col("el_estimated_elasticity"), F.col("el_confidence_score")
    units, inv = F.col("units_sold"), F.col("ending_inventory")
    cur = simulate_price(units, cur_p, cur_p, cost, el, inv)
    fin = simulate_price(units, F.col("g_price"), cur_p, cost, el, inv)
    change = F.when(cur_p > 0, (F.col("g_price") - cur_p) / cur_p).otherwise(0.0)
    out = df.select(
        "sku_id", "category", "region", "customer_tier",
        cur_p.alias("current_price"), F.col("g_price").alias("recommended_price"),
        r4(change).alias("price_change_pct"),
        cur["units"].alias("predicted_current_units"), fin["units"].alias("predicted_recommended_units"),
        cur["revenue"].alias("current_revenue"), fin["revenue"].alias("projected_revenue"),
        cur["gross_profit"].alias("current_gross_profit"), fin["gross_profit"].alias("projected_gross_profit"),
        (fin["gross_profit"] - cur["gross_profit"]).alias("gross_profit_lift"),
        fin["margin"].alias("gross_margin_pct"), fin["ending"].alias("expected_ending_inventory"),
        fin["woc"].alias("expected_weeks_of_cover"),
        el.alias("elasticity"), conf.alias("elasticity_confidence"),
        pricing_action(change, conf, F.col("guardrails")).alias("recommendation_action"),
        "reason_code", "guardrail_triggered",
        F.lit("Pending").alias("approval_status"), F.lit(POLICY_VERSION).alias("policy_version"),
    )
    return out


def recommendation_rows(panel: DataFrame, products: DataFrame, el_table: DataFrame, glob: DataFrame) -> DataFrame:
    """Latest row per series + product columns + elasticity lookup + tier price map."""
    from shelfwise.operators.elasticity import elasticity_lookup
    latest = latest_with_product(latest_by_key(panel), products)
    return tier_price_map(elasticity_lookup(latest, el_table, glob))


def what_if_price(rows: DataFrame, params: DataFrame) -> DataFrame:
    """User-given price / promotion / inventory per series key -> simulated outcome plus the price curve.

    ``params``: sku_id, region, customer_tier, price, promotion (bool), inventory (nullable).
    """
    df = rows.join(params, SERIES, "inner")
    inv = F.coalesce(F.col("inventory"), F.col("ending_inventory"))
    el = F.col("el_estimated_elasticity")
    # the promotion flag is carried on the row but the elasticity path does not read it
    promo_units = F.col("units_sold")
    sim = simulate_price(promo_units, F.col("price"), F.col("realized_price"), F.col("unit_cost"), el, inv)
    curve = F.transform(candidate_prices(F.col("realized_price")), lambda p: F.struct(
        p.alias("price"), simulate_price(promo_units, p, F.col("realized_price"), F.col("unit_cost"), el, inv)
        ["gross_profit"].alias("gross_profit")))
    return df.select(*SERIES, F.col("price").alias("what_if_price"), sim["units"].alias("predicted_units"),
                     sim["revenue"].alias("revenue"), sim["gross_profit"].alias("gross_profit"),
                     sim["margin"].alias("gross_margin_pct"), sim["ending"].alias("expected_ending_inventory"),
                     sim["woc"].alias("expected_weeks_of_cover"), sim["stockout_p"].alias("stockout_probability"),
                     curve.alias("price_curve"))
