"""Query registry: one callable per SURVEY operator, (spark, sf_dir) -> DataFrame.

Float outputs that depend on summation order or on pow/log/exp are rounded to
6 decimals (half up, the same formula as the SQL oracle) so results compare
exactly across engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import r2, r6
from shelfwise.operators import elasticity as el
from shelfwise.operators import features as ft
from shelfwise.operators import panel_ops as po
from shelfwise.operators import pricing as pr
from shelfwise.plans.pipeline import Pipeline

KEY = ["sku_id", "region", "customer_tier", "week_num"]
SERIES = ["sku_id", "region", "customer_tier"]
QUERIES: dict = {}


def query(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def pipe(spark, sf) -> Pipeline:
    """One pipeline per (session, data dir, scenario) so cached stages are shared by queries."""
    return _pipes(spark).setdefault((sf, None), Pipeline(spark, sf))


def _pipes(spark) -> dict:
    """The session's pipelines, held by the session itself."""
    if not hasattr(spark, "_shelfwise_pipelines"):
        spark._shelfwise_pipelines = {}
    return spark._shelfwise_pipelines


def rounded(df: DataFrame, *cols) -> DataFrame:
    return df.withColumns({c: r6(F.col(c)) for c in cols})


# ------------------------------------------------------------ 2.2 panel derivations
@query("sales_financials")
def q_sales_financials(spark, sf):
    d = po.sales_financials(pipe(spark, sf).panel)
    return rounded(d.select(*KEY, "revenue", "cogs", "gross_profit", "gross_margin_pct"), "gross_margin_pct")


@query("demand_censoring")
def q_demand_censoring(spark, sf):
    d = po.demand_censoring(pipe(spark, sf).panel)
    return rounded(d.select(*KEY, "units_sold", "lost_sales_estimate", "ending_inventory"),
                   "lost_sales_estimate", "ending_inventory")


@query("competitor_index")
def q_competitor_index(spark, sf):
    return rounded(po.competitor_index(pipe(spark, sf).panel).select(*KEY, "competitor_price_index"),
                   "competitor_price_index")


@query("panel_stock_flags")
def q_panel_stock_flags(spark, sf):
    p = pipe(spark, sf)
    return po.panel_stock_flags(p.panel, p.products).select(
        *KEY, "stockout_flag", "excess_inventory_flag", "slow_moving_flag")


@query("seasonality_index")
def q_seasonality_index(spark, sf):
    return po.seasonality_index(pipe(spark, sf).panel.drop("seasonality_index")).select(*KEY, "seasonality_index")


@query("lifecycle_factor")
def q_lifecycle_factor(spark, sf):
    return rounded(po.lifecycle_factor(pipe(spark, sf).panel).select(*KEY, "lifecycle_factor"), "lifecycle_factor")


@query("lifecycle_stage")
def q_lifecycle_stage(spark, sf):
    return po.lifecycle_stage(pipe(spark, sf).panel)


@query("tier_price")
def q_tier_price(spark, sf):
    return po.tier_price(pipe(spark, sf).panel).select(*KEY, "regular_price", "tier_price")


@query("economic_index")
def q_economic_index(spark, sf):
    return po.economic_index(pipe(spark, sf).panel.drop("economic_demand_index")).select(*KEY, "economic_demand_index")


@query("latent_demand_model")
def q_latent_demand_model(spark, sf):
    p = pipe(spark, sf)
    return rounded(po.latent_demand_model(p.panel, p.products).select(*KEY, "modeled_latent_demand"), "modeled_latent_demand")


@query("price_inversion_check")
def q_price_inversion_check(spark, sf):
    return po.price_inversion_check(pipe(spark, sf).panel)


# ------------------------------------------------------------ 2.3 features
def _feat(spark, sf):
    return pipe(spark, sf).features


@query("feat_product_join")
def q_feat_product_join(spark, sf):
    return _feat(spark, sf).select(*KEY, "lifecycle_stage", "lead_time_days", "product_age_weeks")


@query("feat_adjusted_units")
def q_feat_adjusted_units(spark, sf):
    return _feat(spark, sf).select(*KEY, "units_sold", "lost_sales_estimate", "adjusted_units")


@query("feat_calendar")
def q_feat_calendar(spark, sf):
    return _feat(spark, sf).select(*KEY, F.col("week_start").cast("string").alias("week_start"), "week_of_year", "month")


@query("feat_price_change")
def q_feat_price_change(spark, sf):
    return rounded(_feat(spark, sf).select(*KEY, "price_change_pct"), "price_change_pct")


@query("feat_aliases")
def q_feat_aliases(spark, sf):
    return _feat(spark, sf).select(*KEY, "price_index_vs_competitor", "tier_discount_pct")


@query("feat_lags")
def q_feat_lags(spark, sf):
    return _feat(spark, sf).select(*KEY, *[f"lag_{k}_units" for k in ft.LAGS])


@query("feat_rolling_units")
def q_feat_rolling_units(spark, sf):
    cols = ["rolling_4_units", "rolling_8_units", "rolling_13_units"]
    return rounded(_feat(spark, sf).select(*KEY, *cols), *cols)


@query("feat_rolling_revenue")
def q_feat_rolling_revenue(spark, sf):
    return rounded(_feat(spark, sf).select(*KEY, "rolling_4_revenue"), "rolling_4_revenue")


@query("feat_rolling_margin")
def q_feat_rolling_margin(spark, sf):
    return rounded(_feat(spark, sf).select(*KEY, "rolling_13_margin"), "rolling_13_margin")


@query("feat_prior_inventory")
def q_feat_prior_inventory(spark, sf):
    return _feat(spark, sf).select(*KEY, "prior_week_inventory")


@query("feat_fill")
def q_feat_fill(spark, sf):
    return rounded(_feat(spark, sf).select(*KEY, *ft.FILL_ZERO), *ft.FILL_ZERO)


@query("time_split")
def q_time_split(spark, sf):
    return pipe(spark, sf).split_features.select(*KEY, "split")


@query("leakage_check")
def q_leakage_check(spark, sf):
    return ft.leakage_check(_feat(spark, sf))


# ------------------------------------------------------------ 2.4 demand (SQL-checkable parts)
def _baseline(spark, sf):
    from shelfwise.operators.demand import baseline_seasonal_naive
    return baseline_seasonal_naive(pipe(spark, sf).split_features)


@query("baseline_seasonal_naive")
def q_baseline(spark, sf):
    return _baseline(spark, sf).select(*KEY, "actual", "baseline_pred")


@query("predict_at_price")
def q_predict_at_price(spark, sf):
    rows = pipe(spark, sf).rec_rows
    price = F.col("realized_price") * 1.05
    units = pr.predict_at_price(F.col("units_sold"), price, F.col("realized_price"), F.col("el_estimated_elasticity"))
    return rows.select(*SERIES, r6(price).alias("candidate_price"), r6(units).alias("predicted_units"))


@query("predict_batch_at_prices")
def q_predict_batch(spark, sf):
    rows = pipe(spark, sf).rec_rows
    cur, e = F.col("realized_price"), F.col("el_estimated_elasticity")
    units = F.transform(pr.candidate_prices(cur), lambda p: F.struct(
        p.alias("candidate_price"), pr.predict_at_price(F.col("units_sold"), p, cur, e).alias("predicted_units")))
    d = rows.select(*SERIES, F.posexplode(units).alias("idx", "c"))
    return d.select(*SERIES, "idx", "c.candidate_price", r6(F.col("c.predicted_units")).alias("predicted_units"))


# ------------------------------------------------------------ 2.5 metrics (seasonal-naive vs actual, test rows)
def _metric(spark, sf, which):
    from shelfwise.operators import metrics as mt
    d = _baseline(spark, sf)
    # actual and baseline are cent values: 2-decimal exact sums make the aggregate order-independent
    return d.agg(r6(mt.METRICS[which](F.col("actual"), F.col("baseline_pred"), 2)).alias(which.lower()))


for _m in ("MAE", "RMSE", "WAPE", "RMSLE", "Bias"):
    QUERIES["metric_" + _m.lower()] = (lambda m: (lambda spark, sf: _metric(spark, sf, m)))(_m)


@query("metrics_all")
def q_metrics_all(spark, sf):
    from shelfwise.operators import metrics as mt
    d = _baseline(spark, sf)
    out = mt.metrics_all(d, "actual", "baseline_pred", ["category"], decimals=2)
    return out.withColumns({c: r6(F.col(c)) for c in ("mae", "rmse", "wape", "rmsle", "bias")})


@query("baseline_improvement")
def q_baseline_improvement(spark, sf):
    from shelfwise.operators import metrics as mt
    d = _baseline(spark, sf)
    w_base = mt.METRICS["WAPE"](F.col("actual"), F.col("baseline_pred"), 2)
    w_lag = mt.METRICS["WAPE"](F.col("actual"), F.col("lag_1_units"), 2)
    a = d.agg(w_base.alias("baseline_wape"), w_lag.alias("model_wape"))
    return a.select(r6(F.col("baseline_wape")).alias("baseline_wape"), r6(F.col("model_wape")).alias("model_wape"),
                    r6(mt.baseline_improvement(F.col("baseline_wape"), F.col("model_wape"))).alias("wape_improvement"))


# ------------------------------------------------------------ 2.6 elasticity
def _est(spark, sf):
    return el.elasticity_log_transform(el.elasticity_sample(pipe(spark, sf).panel))


def _pre_shrink(spark, sf):
    p = pipe(spark, sf)
    seg = el._fit_segments(el.segment_moments(_est(spark, sf)), p.products)
    return seg.withColumn("elasticity_class", el.elasticity_class_col(F.col("estimated_elasticity"),
                                                                      F.col("confidence_score")))


@query("elasticity_sample")
def q_elasticity_sample(spark, sf):
    return el.elasticity_sample(pipe(spark, sf).panel).select(*KEY, "price_change_reason", "price_test_flag")


@query("elasticity_log_transform")
def q_elasticity_log_transform(spark, sf):
    return rounded(_est(spark, sf).select(*KEY, "log_units", "log_price"), "log_units", "log_price")


@query("elasticity_fit_global")
def q_elasticity_fit_global(spark, sf):
    return pipe(spark, sf).global_elasticity


@query("elasticity_fit_category_tier")
def q_elasticity_fit_ct(spark, sf):
    return pipe(spark, sf).elasticity.filter(F.col("estimation_level") == "category_tier")


@query("elasticity_fit_category_region_tier")
def q_elasticity_fit_crt(spark, sf):
    return pipe(spark, sf).elasticity.filter(F.col("estimation_level") == "category_region_tier")


@query("elasticity_fallbacks")
def q_elasticity_fallbacks(spark, sf):
    d = _pre_shrink(spark, sf)
    kind = (F.when(F.col("sample_size") < 10, "prior").when(F.col("standard_error") == 0.5, "global_flat")
            .otherwise("fit"))
    return d.select("elasticity_segment", "estimation_level", "sample_size", "estimated_elasticity",
                    "price_variation", "standard_error", "confidence_score", kind.alias("fallback"))


@query("elasticity_clip_confidence")
def q_elasticity_clip(spark, sf):
    return _pre_shrink(spark, sf).select("elasticity_segment", "estimation_level", "estimated_elasticity",
                                         "standard_error", "confidence_score")


@query("elasticity_class")
def q_elasticity_class(spark, sf):
    return _pre_shrink(spark, sf).select("elasticity_segment", "estimation_level", "estimated_elasticity",
                                         "confidence_score", "elasticity_class")


@query("elasticity_shrink")
def q_elasticity_shrink(spark, sf):
    return pipe(spark, sf).elasticity


@query("elasticity_lookup")
def q_elasticity_lookup(spark, sf):
    rows = pipe(spark, sf).rec_rows
    return rows.select(*SERIES, "category", *[c for c in rows.columns if c.startswith("el_")])


@query("elasticity_reload")
def q_elasticity_reload(spark, sf):
    t = el.elasticity_reload(pipe(spark, sf).elasticity.drop("elasticity_class"))
    return rounded(t, "global_elasticity")


# ------------------------------------------------------------ 2.7 pricing
@query("latest_by_key")
def q_latest_by_key(spark, sf):
    d = pr.latest_by_key(pipe(spark, sf).panel)
    return d.withColumn("week_start", F.col("week_start").cast("string"))


@query("latest_with_product")
def q_latest_with_product(spark, sf):
    p = pipe(spark, sf)
    d = pr.latest_with_product(pr.latest_by_key(p.panel), p.products)
    return d.select(*SERIES, "week_num", "realized_price", "unit_cost", "product_name", "brand_tier",
                    "minimum_margin_pct", "minimum_advertised_price", "lead_time_days", "case_pack",
                    "lifecycle_stage", "base_demand", "minimum_order_quantity")


@query("candidate_prices")
def q_candidate_prices(spark, sf):
    rows = pipe(spark, sf).rec_rows
    return rows.select(*SERIES, "realized_price", F.posexplode(pr.candidate_prices(F.col("realized_price")))
                       .alias("idx", "candidate_price"))


def _sims(spark, sf, objective="balanced"):
    rows = pipe(spark, sf).rec_rows
    d = pr.simulate_candidates(rows, objective).select(*SERIES, F.explode("candidate_sims").alias("s"))
    return d.select(*SERIES, "s.*")


@query("simulate_candidates")
def q_simulate_candidates(spark, sf):
    cols = ["predicted_units", "revenue", "gross_profit", "gross_margin_pct", "expected_ending_inventory",
            "expected_weeks_of_cover"]
    d = _sims(spark, sf).select(*SERIES, "idx", "candidate_price", *cols)
    return rounded(d, *cols)


@query("inventory_impact")
def q_inventory_impact(spark, sf):
    cols = ["expected_ending_inventory", "expected_weeks_of_cover", "stockout_probability",
            "excess_inventory_remaining"]
    return rounded(_sims(spark, sf).select(*SERIES, "idx", *cols), *cols)


for _name, _obj in (("score_gross_profit", "maximize_gross_profit"), ("score_revenue", "maximize_revenue"),
                    ("score_excess_reduction", "reduce_excess_inventory"), ("score_balanced", "balanced")):
    QUERIES[_name] = (lambda o: (lambda spark, sf: _sims(spark, sf, o).select(*SERIES, "idx", "score")))(_obj)


@query("argmax_candidate")
def q_argmax_candidate(spark, sf):
    d = pr.argmax_candidate(pr.simulate_candidates(pipe(spark, sf).rec_rows, "balanced"))
    return d.select(*SERIES, "realized_price", "best_price", "best_score")


@query("tier_price_map")
def q_tier_price_map(spark, sf):
    return pipe(spark, sf).rec_rows.select(*SERIES, "tier_retail_price", "tier_trade_price", "tier_fleet_price")


def _guard_stage(spark, sf, upto):
    p = pipe(spark, sf)
    d = pr.argmax_candidate(pr.simulate_candidates(p.rec_rows, p.sc.objective))
    cur = F.col("realized_price")
    d = d.withColumns({"g_price": F.col("best_price"),
                       "g_change": F.when(cur > 0, (F.col("best_price") - cur) / cur).otherwise(0.0),
                       "g_reason": F.lit("NO_MATERIAL_OPPORTUNITY")})
    steps = [("max_move", lambda x: pr.guard_max_move(x, p.sc)), ("margin_floor", pr.guard_margin_floor),
             ("map", pr.guard_map), ("tier_ladder", pr.guard_tier_ladder), ("stockout", pr.guard_stockout),
             ("low_confidence", pr.guard_low_confidence), ("recheck", lambda x: pr.guard_recheck(x, p.sc.price_rounding))]
    for name, fn in steps:
        d = fn(d)
        if name == upto:
            break
    return d


_GUARD_OUT = {"max_move": ["g1_max_move"], "margin_floor": ["g2_margin_floor"], "map": ["g3_map"],
              "tier_ladder": ["g4_ladder_a", "g4_ladder_b"], "stockout": ["g5_stockout"],
              "low_confidence": ["g6_low_conf"], "recheck": ["g7_floor", "g7_map"]}
for _g, _flags in _GUARD_OUT.items():
    QUERIES["guard_" + _g] = (lambda g, fl: (lambda spark, sf: _guard_stage(spark, sf, g).select(
        *SERIES, r6(F.col("g_price")).alias("guarded_price"), r6(F.col("g_change")).alias("change_arg"),
        "g_reason", *fl)))(_g, _flags)


@query("round_price")
def q_round_price(spark, sf):
    rows = pipe(spark, sf).rec_rows
    p = F.col("realized_price") * 0.97
    return rows.select(*SERIES, r6(p).alias("raw_price"),
                       *[pr.round_price(p, m).alias(m) for m in ("nearest_dollar", "ending_99", "ending_95", "cents")])


def _recs(spark, sf):
    return pipe(spark, sf).recommendations


_REC_FLOATS = ["predicted_current_units", "predicted_recommended_units", "current_revenue", "projected_revenue",
               "current_gross_profit", "projected_gross_profit", "gross_profit_lift", "gross_margin_pct",
               "expected_ending_inventory", "expected_weeks_of_cover", "recommended_price"]


@query("reason_code")
def q_reason_code(spark, sf):
    return _recs(spark, sf).select(*SERIES, "guardrail_triggered", "reason_code")


@query("guardrail_list")
def q_guardrail_list(spark, sf):
    return _recs(spark, sf).select(*SERIES, "guardrail_triggered")


@query("pricing_action")
def q_pricing_action(spark, sf):
    return _recs(spark, sf).select(*SERIES, "price_change_pct", "elasticity_confidence", "recommendation_action")


@query("optimize_prices")
def q_optimize_prices(spark, sf):
    return rounded(_recs(spark, sf), *_REC_FLOATS)


@query("price_recommendations")
def q_price_recommendations(spark, sf):
    d = _recs(spark, sf)
    return rounded(d.select(*SERIES, "category", "current_price", "recommended_price", "price_change_pct",
                            "gross_profit_lift", "recommendation_action", "reason_code"),
                   "recommended_price", "gross_profit_lift")


@query("what_if_price")
def q_what_if_price(spark, sf):
    rows = pipe(spark, sf).rec_rows
    params = rows.select(*SERIES, r2(F.col("realized_price") * 0.95).alias("price"),
                         F.lit(False).alias("promotion"), F.lit(None).cast("double").alias("inventory"))
    d = pr.what_if_price(rows, params)
    best = F.array_max(F.transform("price_curve", lambda c: F.struct(r6(c["gross_profit"]).alias("g"),
                                                                     (-c["price"]).alias("np"))))
    d = d.withColumns({"curve_best_price": -best["np"], "curve_max_gross_profit": best["g"]}).drop("price_curve")
    cols = ["predicted_units", "revenue", "gross_profit", "gross_margin_pct", "expected_ending_inventory",
            "expected_weeks_of_cover", "curve_max_gross_profit"]
    return rounded(d, *cols)



# ------------------------------------------------------------ 2.8 inventory metrics
SR = ["sku_id", "region"]


def _inv(spark, sf):
    return pipe(spark, sf).inventory_status


@query("avg_weekly_demand")
def q_avg_weekly_demand(spark, sf):
    from shelfwise.operators.inventory import demand_history
    d = demand_history(pipe(spark, sf).panel)
    return rounded(d.select(*SR, "avg_demand", "demand_sd"), "avg_demand", "demand_sd")


@query("demand_trend")
def q_demand_trend(spark, sf):
    from shelfwise.operators.inventory import demand_history
    return rounded(demand_history(pipe(spark, sf).panel).select(*SR, "trend"), "trend")


@query("tier_inventory_rollup")
def q_tier_inventory_rollup(spark, sf):
    from shelfwise.operators.inventory import tier_inventory_rollup
    d = tier_inventory_rollup(pipe(spark, sf).panel).drop("units_total")
    cols = [c for c in d.columns if c not in SR]
    return rounded(d, *cols)


_INV_Q = {
    "weeks_of_cover": ["on_hand_inventory", "available_inventory", "average_weekly_demand", "on_hand_weeks_of_cover",
                       "available_weeks_of_cover"],
    "safety_stock": ["demand_std", "lead_time_weeks", "safety_stock"],
    "reorder_point": ["average_weekly_demand", "lead_time_weeks", "safety_stock", "reorder_point"],
    "excess_units_value": ["available_inventory", "excess_units", "excess_inventory_value"],
    "lost_sales": ["lost_sales_estimate"],
    "sell_through": ["sell_through_rate"],
    "stockout_probability": ["on_hand_inventory", "on_order_inventory", "stockout_probability"],
    "obsolescence_score": ["lifecycle_stage", "product_age_weeks", "demand_trend", "obsolescence_risk_score"],
    "inventory_turns": ["unit_cost", "on_hand_inventory", "inventory_turns"],
}
for _n, _cols in _INV_Q.items():
    QUERIES[_n] = (lambda cols: (lambda spark, sf: _inv(spark, sf).select(*SR, *cols)))(_cols)


@query("holding_cost")
def q_holding_cost(spark, sf):
    from shelfwise.operators.inventory import holding_cost
    d = _inv(spark, sf)
    return d.select(*SR, "excess_inventory_value", r6(holding_cost(F.col("excess_inventory_value"))).alias("holding_cost"))


@query("case_pack_round")
def q_case_pack_round(spark, sf):
    from shelfwise.operators.inventory import case_pack_round
    d = _inv(spark, sf)
    q3 = F.col("average_weekly_demand") * 3 - F.col("on_hand_inventory")
    return d.select(*SR, "case_pack", r6(q3).alias("quantity"), case_pack_round(q3, F.col("case_pack")).alias("rounded_quantity"))


@query("sku_region_metrics")
def q_sku_region_metrics(spark, sf):
    return pipe(spark, sf).inventory_metrics


# ------------------------------------------------------------ 2.9 policy, replenishment, transfers
@query("inventory_status")
def q_inventory_status(spark, sf):
    return _inv(spark, sf).select(*SR, "on_hand_inventory", "available_weeks_of_cover", "stockout_probability",
                                  "inventory_turns", "obsolescence_risk_score", "inventory_status")


@query("markdown_economics")
def q_markdown_economics(spark, sf):
    from shelfwise.operators.policy import markdown_economics
    j = pipe(spark, sf).joint
    md = markdown_economics(F.col("current_gross_profit"), F.col("projected_gross_profit"),
                            F.col("excess_inventory_value"), F.col("obsolescence_risk_score"))
    return j.select(*SERIES, *[r6(v).alias(k) if k != "markdown_recommended" else v.alias(k) for k, v in md.items()])


@query("action_matrix")
def q_action_matrix(spark, sf):
    from shelfwise.operators.policy import action_matrix
    j = pipe(spark, sf).joint.select(*SERIES, "inventory_status", "elasticity")
    return action_matrix(j)


@query("inventory_action")
def q_inventory_action(spark, sf):
    return pipe(spark, sf).joint.select(*SERIES, "inventory_status", "transfer_candidate_flag", "inventory_action",
                                        "inventory_reason_code")


@query("legacy_action_label")
def q_legacy_action_label(spark, sf):
    from shelfwise.operators.policy import legacy_action_label
    j = pipe(spark, sf).joint
    return j.select(*SERIES, "inventory_action", legacy_action_label(F.col("inventory_action")).alias("legacy_action"))


@query("conflict_resolution")
def q_conflict_resolution(spark, sf):
    j = pipe(spark, sf).joint
    return j.select(*SERIES, "inventory_status", "inventory_action", "price_change_pct", "pricing_action",
                    "manual_review_required")


@query("replenishment")
def q_replenishment(spark, sf):
    d = pipe(spark, sf).replenishment
    return rounded(d.select(*SR, "inventory_status", "reorder_point", "safety_stock", "net_requirement",
                            "recommended_order_quantity", "expected_stockout_weeks", "replenishment_action",
                            "replenishment_reason"), "net_requirement", "reorder_point", "safety_stock")


@query("transfer_candidates")
def q_transfer_candidates(spark, sf):
    from shelfwise.operators.transfers import transfer_candidates
    d = transfer_candidates(_inv(spark, sf))
    return rounded(d.select("sku_id", "source_region", "destination_region", "source_excess", "destination_shortage"),
                   "source_excess", "destination_shortage")


@query("transfer_allocation")
def q_transfer_allocation(spark, sf):
    return pipe(spark, sf).transfers.select("sku_id", "source_region", "destination_region", "transfer_quantity")


@query("transfer_value")
def q_transfer_value(spark, sf):
    return pipe(spark, sf).transfers.select("sku_id", "source_region", "destination_region", "transfer_cost",
                                            "expected_revenue_recovered", "expected_gp_recovered", "net_transfer_value")


@query("transfer_status_after")
def q_transfer_status_after(spark, sf):
    return pipe(spark, sf).transfers.select("sku_id", "source_region", "destination_region", "source_status_before",
                                            "source_status_after", "destination_status_before",
                                            "destination_status_after")


# ------------------------------------------------------------ 2.10 joint
_J_FLOATS = ["recommended_price", "predicted_current_units", "predicted_recommended_units", "current_revenue",
             "projected_revenue", "current_gross_profit", "projected_gross_profit", "gross_profit_lift",
             "gross_margin_pct", "expected_ending_inventory", "expected_weeks_of_cover", "modeled_gp_lift"]


@query("transfer_flag")
def q_transfer_flag(spark, sf):
    from shelfwise.operators.joint import transfer_flag
    return transfer_flag(pipe(spark, sf).transfers)


@query("history_weeks")
def q_history_weeks(spark, sf):
    from shelfwise.operators.joint import history_weeks
    return history_weeks(pipe(spark, sf).panel)


@query("joint_confidence")
def q_joint_confidence(spark, sf):
    return pipe(spark, sf).joint.select(*SERIES, "elasticity_confidence", "inventory_status", "joint_confidence",
                                        "joint_confidence_score")


@query("low_confidence_override")
def q_low_confidence_override(spark, sf):
    return pipe(spark, sf).joint.filter(F.col("joint_confidence") == "LOW").select(
        *SERIES, "price_change_pct", "pricing_action", "inventory_action", "manual_review_required")


@query("joint_recommendations")
def q_joint_recommendations(spark, sf):
    return rounded(pipe(spark, sf).joint, *_J_FLOATS)


def _scenario_joint(spark, sf, name):
    from shelfwise.config import scenario
    pipes = _pipes(spark)
    if (sf, name) not in pipes:
        base = pipe(spark, sf)
        base.rec_rows  # noqa: B018 - build the shared inputs once
        pipes[sf, name] = base.with_scenario(scenario(name))
    return pipes[sf, name].joint


@query("scenario_run")
def q_scenario_run(spark, sf):
    """Joint decision rows under the four presets."""
    from concurrent.futures import ThreadPoolExecutor

    from shelfwise.config import SCENARIOS
    pipe(spark, sf).rec_rows  # noqa: B018 - shared inputs are materialised once, before the threads start
    # independent scenario pipelines: build and materialise them as concurrent Spark jobs
    with ThreadPoolExecutor(max_workers=len(SCENARIOS)) as pool:
        joints = dict(zip(SCENARIOS, pool.map(lambda n: _scenario_joint(spark, sf, n), SCENARIOS)))
    out = None
    for name in SCENARIOS:
        d = joints[name].withColumn("scenario", F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out.select("scenario", *SERIES, "pricing_action", "inventory_action", "inventory_status", "manual_review_required",
                      r6(F.col("current_price")).alias("current_price"), r6(F.col("recommended_price")).alias("recommended_price"),
                      r6(F.col("gross_profit_lift")).alias("gross_profit_lift"))


@query("decision_pipeline")
def q_decision_pipeline(spark, sf):
    """End-to-end run: rows and totals of every stage, from the run's manifest."""
    from shelfwise.plans.run import run
    manifest, _ = run(spark, sf, sio.scratch_path(spark, "run"))
    return manifest.select("stage", "rows", (F.floor(F.col("total") * 100 + 0.5) / 100).alias("total"))


# ------------------------------------------------------------ 2.11 backtest and rollback
def _bt_round(d):
    return d.withColumns({c: F.floor(F.col(c) * 1e4 + 0.5) / 1e4 for c in d.columns if c != "strategy"})


def _strategy_compare(spark, sf, name):
    from shelfwise.operators import backtest as bt
    p = pipe(spark, sf)
    fn = {"bt_current": lambda t: bt.bt_current(t), "bt_cost_plus": bt.bt_cost_plus,
          "bt_competitor_match": bt.bt_competitor_match,
          "bt_pricing_only": lambda t: bt.bt_pricing_only(t, p.joint),
          "bt_inventory_only": lambda t: bt.bt_inventory_only(t, p.joint),
          "bt_joint": lambda t: bt.bt_joint(t, p.joint, p.transfers)}[name]
    d = fn(p.test_window).select(*bt.BT_COLS).withColumn("strategy", F.lit(name))
    return _bt_round(bt.bt_compare(d))


for _s in ("bt_current", "bt_cost_plus", "bt_competitor_match", "bt_pricing_only", "bt_inventory_only", "bt_joint"):
    QUERIES[_s] = (lambda n: (lambda spark, sf: _strategy_compare(spark, sf, n)))(_s)


@query("bt_compare")
def q_bt_compare(spark, sf):
    from shelfwise.operators import backtest as bt
    return _bt_round(bt.bt_compare(pipe(spark, sf).strategies))


@query("bt_lift")
def q_bt_lift(spark, sf):
    return rounded(pipe(spark, sf).comparison.select("strategy", "modeled_lift_vs_current"), "modeled_lift_vs_current")


@query("bt_coverage_rates")
def q_bt_coverage_rates(spark, sf):
    from shelfwise.operators import backtest as bt
    p = pipe(spark, sf)
    d = bt.bt_coverage_rates(p.joint, p.test_window, p.transfers)
    return rounded(d, "rec_coverage", "approval_rate", "guardrail_rate")


ROLLBACK_R = 0.5


@query("rollback_prices")
def q_rollback_prices(spark, sf):
    from shelfwise.operators import backtest as bt
    d = bt.rollback_prices(pipe(spark, sf).joint, ROLLBACK_R)
    return rounded(d.select(*SERIES, "current_price", "recommended_price", "approved_price", "rollback_price",
                            "gp_retained", "revenue_retained"),
                   "recommended_price", "approved_price", "rollback_price", "gp_retained", "revenue_retained")


@query("rollback_transfers")
def q_rollback_transfers(spark, sf):
    from shelfwise.operators import backtest as bt
    transfers, out = pipe(spark, sf).transfers, None
    for share in (0.0, 0.5, 1.0):
        d = bt.rollback_transfers(transfers, share).select(F.lit(share).alias("share"), "sku_id", "source_region", "destination_region", "transfer_quantity",
                                                           r6(F.col("approved_quantity")).alias("approved_quantity"), r6(F.col("rollback_quantity")).alias("rollback_quantity"), "cancelled")
        out = d if out is None else out.union(d)
    return out


@query("rollback_replenishment")
def q_rollback_replenishment(spark, sf):
    from shelfwise.operators import backtest as bt
    d = bt.rollback_replenishment(pipe(spark, sf).joint, ROLLBACK_R)
    return d.select(*SERIES, "recommended_order_quantity", "approved_order_qty", "cancelled_replenishment")


@query("rollback_audit")
def q_rollback_audit(spark, sf):
    from shelfwise.operators import backtest as bt
    d = bt.rollback_audit(pipe(spark, sf).joint, ROLLBACK_R, 0.0, "2024-01-01")
    return rounded(d, "recommended_price", "approved_price", "rollback_price")


@query("rollback_summary")
def q_rollback_summary(spark, sf):
    from shelfwise.operators import backtest as bt
    p = pipe(spark, sf)
    out = None
    for share in (0.0, 0.5, 1.0):
        d = bt.rollback_summary(p.joint, p.transfers, share, share, share).withColumn("share", F.lit(share))
        out = d if out is None else out.union(d)
    return out.withColumns({c: F.floor(F.col(c) * 100 + 0.5) / 100 for c in
                            ("gross_profit_lift_retained", "revenue_retained", "inventory_value_impact_retained")})


@query("rollback_verify")
def q_rollback_verify(spark, sf):
    from shelfwise.operators import backtest as bt
    p = pipe(spark, sf)
    return bt.rollback_verify(p.joint, p.transfers)


# ------------------------------------------------------------ 2.12 reports
from shelfwise.operators import reports as rp  # noqa: E402


def _J(spark, sf):
    return pipe(spark, sf).joint


def _rnd(df, k=4, skip=()):
    num = [f.name for f in df.schema.fields if f.dataType.typeName() == "double" and f.name not in skip]
    scale = float(10 ** k)
    return df.withColumns({c: F.floor(F.col(c) * scale + 0.5) / scale for c in num})


@query("inv_summary")
def q_inv_summary(spark, sf):
    return _rnd(rp.inv_summary(_inv(spark, sf)))


@query("inv_portfolio_turns")
def q_inv_portfolio_turns(spark, sf):
    p = pipe(spark, sf)
    d = rp.inv_portfolio_turns(p.inventory_status, p.panel)
    cents = F.floor(F.col("annual_cogs") * 100 + 0.5) / 100.0
    return _rnd(d, 6, skip=("annual_cogs",)).withColumn("annual_cogs", cents)


@query("inv_status_distribution")
def q_inv_status_distribution(spark, sf):
    return rp.inv_status_distribution(_inv(spark, sf))


@query("inv_excess_by_category")
def q_inv_excess_by_category(spark, sf):
    return _rnd(rp.inv_excess_by_category(_inv(spark, sf)))


@query("policy_filter")
def q_policy_filter(spark, sf):
    d = rp.policy_filter(_J(spark, sf), "balanced", 0.15, 0.10, 0.4)
    return _rnd(d.select(*SERIES, "elasticity_confidence", "gross_margin_pct", "price_change_pct", "gross_profit_lift"), 6)


@query("slice_filter")
def q_slice_filter(spark, sf):
    d = rp.slice_filter(_J(spark, sf), region="EUROPE", category=["PROMO", "LARGE"], customer_tier="All")
    return d.select(*SERIES, "category", "recommendation_action")


@query("kpi_headline")
def q_kpi_headline(spark, sf):
    p = pipe(spark, sf)
    return _rnd(rp.kpi_headline(p.joint, p.inventory_status, p.panel))


@query("lift_by_category")
def q_lift_by_category(spark, sf):
    return _rnd(rp.lift_by(_J(spark, sf), "category"))


@query("lift_by_region")
def q_lift_by_region(spark, sf):
    return _rnd(rp.lift_by(_J(spark, sf), "region"))


@query("action_mix")
def q_action_mix(spark, sf):
    return rp.action_mix(_J(spark, sf))


@query("top_opportunities")
def q_top_opportunities(spark, sf):
    d = rp.top_by(_J(spark, sf), "gross_profit_lift", 10)
    return _rnd(d.select(*SERIES, "category", "gross_profit_lift", "recommendation_action"), 6)


@query("pricing_kpis")
def q_pricing_kpis(spark, sf):
    return _rnd(rp.pricing_kpis(_J(spark, sf)), 6)


@query("top_movers_long")
def q_top_movers_long(spark, sf):
    return _rnd(rp.top_movers_long(_J(spark, sf)), 6)


@query("price_change_histogram")
def q_price_change_histogram(spark, sf):
    return _rnd(rp.histogram(_J(spark, sf), "price_change_pct", 40), 6)


@query("woc_histogram")
def q_woc_histogram(spark, sf):
    return _rnd(rp.histogram(_inv(spark, sf), "available_weeks_of_cover", 30), 6)


@query("competitor_index_by_category")
def q_competitor_index_by_category(spark, sf):
    return _rnd(rp.competitor_index_by_category(pipe(spark, sf).panel), 6)


@query("unit_impact")
def q_unit_impact(spark, sf):
    return _rnd(rp.unit_impact(_J(spark, sf)), 6)


@query("high_confidence_top50")
def q_high_confidence_top50(spark, sf):
    d = _J(spark, sf).filter((F.col("joint_confidence") == "HIGH") & F.col("recommendation_action").isin(*rp.MOVES))
    d = rp.top_by(d, "gross_profit_lift", 50)
    return _rnd(d.select(*SERIES, "category", "current_price", "recommended_price", "price_change_pct",
                         "gross_profit_lift", "gross_margin_pct", "reason_code"), 6)


def _regions(spark, sf):
    # the region dimension (5 rows) names the pivot columns, so the pivot needs no extra distinct job
    return sorted(r[0] for r in spark.read.parquet(f"{sf}/region.parquet").select("r_name").collect())


@query("stockout_heatmap")
def q_stockout_heatmap(spark, sf):
    return _rnd(rp.stockout_heatmap(_J(spark, sf), _regions(spark, sf)), 6)


@query("top_transfers")
def q_top_transfers(spark, sf):
    d = rp.top_by(pipe(spark, sf).transfers, "net_transfer_value", 50, ["sku_id", "source_region", "destination_region"])
    return d.select("sku_id", "category", "source_region", "destination_region", "transfer_quantity",
                    "net_transfer_value", "transfer_reason")


@query("aged_inventory_top50")
def q_aged_inventory_top50(spark, sf):
    d = _J(spark, sf).filter(F.col("inventory_status").isin("SLOW_MOVING", "OBSOLETE_RISK"))
    d = rp.top_by(d, "excess_inventory_value", 50)
    return d.select(*SERIES, "category", "inventory_status", "excess_inventory_value", "available_weeks_of_cover",
                    "obsolescence_risk_score")


PROFILE_SKU = "Brand#1|PROMO"


@query("sku_profile")
def q_sku_profile(spark, sf):
    p = pipe(spark, sf)
    return _rnd(rp.sku_profile(p.joint, p.products, PROFILE_SKU), 6)


@query("review_queue")
def q_review_queue(spark, sf):
    from shelfwise.sources.io import derive_decision_log
    j = _J(spark, sf)
    d = rp.review_queue(j, derive_decision_log(j))
    return _rnd(d.select(*SERIES, "category", "current_price", "recommended_price", "price_change_pct",
                         "recommendation_action", "inventory_action", "joint_confidence", "reason_code", "decision"), 6)


@query("queue_kpis")
def q_queue_kpis(spark, sf):
    j = _J(spark, sf)
    return _rnd(rp.queue_kpis(j, sio.derive_decision_log(j)))


@query("margin_summary")
def q_margin_summary(spark, sf):
    return _rnd(rp.margin_summary(_J(spark, sf)))


@query("replenish_summary")
def q_replenish_summary(spark, sf):
    return _rnd(rp.replenish_summary(_J(spark, sf)))


@query("action_counts")
def q_action_counts(spark, sf):
    return rp.action_counts(_J(spark, sf))


@query("conflict_count")
def q_conflict_count(spark, sf):
    return rp.conflict_count(_J(spark, sf))


@query("woc_and_status_top5")
def q_woc_and_status_top5(spark, sf):
    return _rnd(rp.woc_and_status_top(_inv(spark, sf)), 6)


@query("lost_sales_total")
def q_lost_sales_total(spark, sf):
    return _rnd(rp.lost_sales_total(_J(spark, sf)))


@query("obsolescence_high")
def q_obsolescence_high(spark, sf):
    return rp.obsolescence_high(_J(spark, sf))


@query("excess_by_category_all")
def q_excess_by_category_all(spark, sf):
    return _rnd(rp.excess_by_category(_J(spark, sf)))


@query("sku_excess_latest")
def q_sku_excess_latest(spark, sf):
    return rp.sku_excess_latest(pipe(spark, sf).panel)


@query("sku_stockout_latest")
def q_sku_stockout_latest(spark, sf):
    return rp.sku_stockout_latest(pipe(spark, sf).panel)


@query("elasticity_low_conf")
def q_elasticity_low_conf(spark, sf):
    return rp.elasticity_low_conf(pipe(spark, sf).elasticity)


@query("guardrail_summary")
def q_guardrail_summary(spark, sf):
    return rp.guardrail_summary(_J(spark, sf))


@query("rollback_retained")
def q_rollback_retained(spark, sf):
    p = pipe(spark, sf)
    return _rnd(rp.rollback_retained(p.joint, p.transfers))


@query("minmax_normalize")
def q_minmax_normalize(spark, sf):
    d = rp.minmax_normalize(_J(spark, sf).select(*SERIES, "gross_profit_lift"), "gross_profit_lift")
    return _rnd(d, 6)


@query("safe_divide")
def q_safe_divide(spark, sf):
    from shelfwise.functions.columns import safe_div
    j = _J(spark, sf)
    return _rnd(j.select(*SERIES, safe_div(F.col("projected_gross_profit"), F.col("projected_revenue"), 0.0)
                         .alias("projected_margin")), 6)


@query("format_labels")
def q_format_labels(spark, sf):
    j = _J(spark, sf)
    return j.select(*SERIES, rp.format_currency(F.col("gross_profit_lift")).alias("lift_label"),
                    rp.format_pct(F.col("gross_margin_pct")).alias("margin_label"))


# ------------------------------------------------------------ 2.1 sources and sinks
from shelfwise.sources import io as sio  # noqa: E402


@query("read_products")
def q_read_products(spark, sf):
    path = sio.write_table(pipe(spark, sf).products, sio.scratch_path(spark, "products"), "csv")
    return sio.read_products(spark, path, "csv")


@query("read_sales")
def q_read_sales(spark, sf):
    path = sio.write_table(pipe(spark, sf).panel, sio.scratch_path(spark, "sales"), "csv")
    d = sio.read_sales(spark, path, "csv")
    return d.withColumn("week_start", F.col("week_start").cast("string"))


@query("read_first_available")
def q_read_first_available(spark, sf):
    base = sio.scratch_path(spark, "sales-candidates")
    sio.write_table(pipe(spark, sf).panel, f"{base}/full", "parquet")
    d = sio.read_first_available(spark, [f"{base}/latest", f"{base}/app", f"{base}/full"], "parquet")
    return d.withColumn("week_start", F.col("week_start").cast("string"))


def _decision_tables(spark, sf):
    p = pipe(spark, sf)
    return {"recommendations": p.joint, "transfers": p.transfers, "inventory_metrics": p.replenishment,
            "elasticity_estimates": p.elasticity, "backtest_results": p.comparison}


@query("write_decisions")
def q_write_decisions(spark, sf):
    """Write the five decision tables, read each back and report its row count."""
    base = sio.scratch_path(spark, "decisions")
    written = sio.write_decisions(base, _decision_tables(spark, sf))
    out = None
    for name, path in written.items():
        d = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out.select("table", "rows")


@query("read_decisions")
def q_read_decisions(spark, sf):
    """Reload the written recommendations (optional tables missing -> empty frames with their schema)."""
    tables = _decision_tables(spark, sf)
    base = sio.scratch_path(spark, "decisions")
    sio.write_decisions(base, {"recommendations": tables["recommendations"]})
    schemas = {k: v.schema for k, v in tables.items()}
    back = sio.read_decisions(spark, base, schemas)
    assert back["transfers"].schema == schemas["transfers"]
    return rounded(back["recommendations"].select(*tables["recommendations"].columns), *_J_FLOATS)


@query("decision_log")
def q_decision_log(spark, sf):
    """Append-only reviewer log -> latest decision per SKU (last write wins) joined to the queue."""
    j = _J(spark, sf)
    log = sio.derive_decision_log(j)
    q_ = j.select(*SERIES, "gross_profit_lift", "recommendation_action")
    d = q_.join(rp.latest_decisions(log), "sku_id", "left").withColumn(
        "decision", F.coalesce(F.col("decision"), F.lit("—")))
    return rounded(d.select(*SERIES, "recommendation_action", "decision", "override_price", "note"), "override_price")


# ------------------------------------------------------------ 2.4 demand models
def _model(spark, sf, kind="gbt"):
    return pipe(spark, sf).model(kind)


def _onehot(enc) -> str:
    """All one-hot slots of a row as a string of digits, in the order of the dictionary."""
    return "concat(" + ", ".join(["''", *(f"cast(cast({enc.sql(i)} as int) as string)" for i in range(len(enc.numeric), len(enc.names)))]) + ")"


@query("model_matrix")
def q_model_matrix(spark, sf):
    df, enc = pipe(spark, sf).split_features, pipe(spark, sf).encoding
    return df.select(*KEY, "split", F.col("adjusted_units").alias("label"), F.lit(len(enc.names)).alias("n_features"),
                     *(r6(F.expr(enc.sql(i))).alias(f"x_{c}") for i, c in enumerate(enc.numeric)), F.expr(_onehot(enc)).alias("onehot"))


@query("scale_features")
def q_scale_features(spark, sf):
    from shelfwise.operators.linear import scaled_columns
    df, enc, m = pipe(spark, sf).split_features, pipe(spark, sf).encoding, pipe(spark, sf).moments
    scaled = scaled_columns(df, m, enc)
    of = lambda c: " + ".join([f"({scaled[len(enc.numeric) + k]})" for k, (f, _) in enumerate(enc.slots) if f == c] or ["0D"])
    return df.select(*KEY, "split", *(r6(F.expr(scaled[i])).alias(f"z_{c}") for i, c in enumerate(enc.numeric)),
                     *(r6(F.expr(of(c))).alias(f"z_{c}_slots") for c in ("category", "region", "customer_tier", "lifecycle_stage")))


for _kind, _name in (("ridge", "demand_ridge"), ("elasticnet", "demand_elasticnet"),
                     ("random_forest", "demand_random_forest"), ("gbt", "demand_gbt")):
    QUERIES[_name] = (lambda k: (lambda spark, sf: _model(spark, sf, k)[1].withColumn("value", r6(F.col("value")))))(_kind)


@query("train_evaluate")
def q_train_evaluate(spark, sf):
    from shelfwise.operators import metrics as mt
    _, metrics, _ = _model(spark, sf, "gbt")
    base = _baseline(spark, sf).agg(mt.metric_wape(F.col("actual"), F.col("baseline_pred")).alias("baseline_WAPE"))
    wape = metrics.filter(F.col("metric") == "wape").select("split", F.col("value").alias("WAPE"))
    return wape.crossJoin(base).withColumn(
        "WAPE_improvement", mt.baseline_improvement(F.col("baseline_WAPE"), F.col("WAPE")))


@query("test_predictions")
def q_test_predictions(spark, sf):
    return _model(spark, sf, "gbt")[2]


@query("feature_importance")
def q_feature_importance(spark, sf):
    from shelfwise.operators.demand import feature_importance
    return feature_importance(spark, _model(spark, sf, "gbt")[0])


@query("compare_models")
def q_compare_models(spark, sf):
    return _model(spark, sf, "ridge")[1].unionByName(_model(spark, sf, "gbt")[1])


@query("predict_at_price_model")
def q_predict_at_price_model(spark, sf):
    from shelfwise.operators.demand import predict_at_price_model
    latest = pr.latest_by_key(pipe(spark, sf).split_features)
    out = predict_at_price_model(_model(spark, sf, "gbt")[0], latest, pr.candidate_prices(F.col("realized_price")))
    best = F.array_max(F.transform("model_sims", lambda s: F.struct((s["candidate_price"] * s["predicted_units"]).alias("revenue"), s["candidate_price"].alias("price"))))
    return out.select(*SERIES, F.col("model_sims.candidate_price").alias("candidate_prices"), F.col("model_sims.predicted_units").alias("predicted_units"),
                      best["price"].alias("best_revenue_price"))


@query("save_load_model")
def q_save_load_model(spark, sf):
    from shelfwise.operators.demand import load_model
    model, _, preds = _model(spark, sf, "gbt")
    path = sio.scratch_path(spark, "model")
    model.save(spark, path)
    re = load_model(spark, path).predict(pipe(spark, sf).split_features.filter(F.col("split") == "test")).select(
        "week_num", "sku_id", "region", "customer_tier", F.greatest(F.col("prediction"), F.lit(0.0)).alias("reloaded"))
    return preds.join(re, ["week_num", "sku_id", "region", "customer_tier"]).withColumn(
        "identical", F.abs(F.col("predicted") - F.col("reloaded")) < 1e-9)


@query("save_load_model_metrics")
def q_save_load_model_metrics(spark, sf):
    model, metrics, _ = _model(spark, sf, "gbt")
    metrics = metrics.withColumn("n_features", F.lit(len(model.encoding.names)))
    path = sio.scratch_path(spark, "model-metrics")
    metrics.write.mode("overwrite").json(path)
    return spark.read.schema(metrics.schema).json(path)


@query("model_report")
def q_model_report(spark, sf):
    t = q_train_evaluate(spark, sf).filter(F.col("split") == "test")
    m = _model(spark, sf, "gbt")[1].filter(F.col("split") == "test").groupBy("model").pivot(
        "metric", ["mae", "rmse", "wape", "rmsle", "bias"]).agg(F.first("value"))
    return m.crossJoin(t.select("baseline_WAPE", "WAPE_improvement"))


# ------------------------------------------------------------ kept states: periods, tails, cubes, streams
def _last_week(panel: DataFrame) -> int:
    return panel.agg(F.max("week_num")).first()[0] or 0


@query("elasticity_states")
def q_elasticity_states(spark, sf):
    """Estimates from stored moment states: the history, then its last periods one after the other, then a
    back-dated one again."""
    from shelfwise.operators import states as es
    p = pipe(spark, sf)
    path, last, week = sio.scratch_path(spark, "moment-states"), _last_week(p.panel), F.col("week_num")
    for part in (week <= last - 2, week == last - 1, week == last, week == last // 2):
        states = es.refresh(spark, path, p.panel.where(part))
    return el.elasticity_table(p.panel, p.products, moments=es.moments(states))


@query("feat_from_tail")
def q_feat_from_tail(spark, sf):
    """Features of the last period from the tail state of the periods before it."""
    from shelfwise.operators import tails
    p = pipe(spark, sf)
    last, week = _last_week(p.panel), F.col("week_num")
    path = sio.scratch_path(spark, "tail-state")
    state = tails.advance(tails.tail_state(p.panel.where(week < last - 1)), p.panel.where(week == last - 1))
    state.write.parquet(path)
    new = tails.next_features(spark.read.schema(state.schema).parquet(path), p.panel.where(week == last), p.products)
    return rounded(new.select(*KEY, *ft.FILL_ZERO), *ft.FILL_ZERO)


@query("kpi_cube")
def q_kpi_cube(spark, sf):
    """Headline KPIs of every slice over region, category and tier."""
    from shelfwise.operators import cube
    p = pipe(spark, sf)
    return _rnd(cube.all_slices(cube.joint_cube(p.joint), cube.stock_cube(p.inventory_status, p.panel)))


@query("decision_log_stream")
def q_decision_log_stream(spark, sf):
    """The derived reviewer log read as a stream of files; each SKU's last entry."""
    from shelfwise.streaming import decisions as ds
    log, out, mark = (sio.scratch_path(spark, f"decision-{x}") for x in ("log", "table", "mark"))
    sio.derive_decision_log(_J(spark, sf)).withColumn("sequence", F.lit(0).cast("long")).repartition(4).write.parquet(log)
    ds.start_decisions(ds.read_log_stream(spark, log, 1), out, mark).awaitTermination()
    return rounded(ds.current(spark, out), "override_price")
