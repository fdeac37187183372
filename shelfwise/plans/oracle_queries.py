"""Oracle SQL per query name (DuckDB dialect), built on the CTEs of ``oracle_sql``."""

from __future__ import annotations

from shelfwise.plans.oracle_sql import R, cte, with_ctes

SQL: dict[str, str] = {}
K = "sku_id, region, customer_tier, week_num"
W = "OVER (PARTITION BY sku_id, region, customer_tier ORDER BY week_num"


def R6(x):
    return R(x, 6)


def q(name, select, *ctes):
    SQL[name] = with_ctes(select, *ctes)


# ------------------------------------------------------------ 2.2 panel derivations
q("sales_financials", f"""
SELECT {K}, revenue, cogs, {R('revenue - cogs', 2)} AS gross_profit,
       {R6(f"CASE WHEN revenue > 0 THEN {R('revenue - cogs', 2)} / revenue ELSE 0.0 END")} AS gross_margin_pct
FROM (SELECT {K}, {R('realized_price * units_sold', 2)} AS revenue, {R('unit_cost * units_sold', 2)} AS cogs FROM panel)
""", "panel")

q("demand_censoring", f"""
SELECT {K}, units_sold, {R6('greatest(0.0, latent_demand - avail)')} AS lost_sales_estimate,
       {R6('greatest(0.0, avail - units_sold)')} AS ending_inventory
FROM (SELECT *, {R('least(latent_demand, avail)', 2)} AS units_sold
      FROM (SELECT {K}, latent_demand, beginning_inventory + receipts AS avail FROM panel))
""", "panel")

q("competitor_index", f"""
SELECT {K}, {R6('CASE WHEN competitor_price > 0 THEN realized_price / competitor_price ELSE 1.0 END')} AS competitor_price_index
FROM panel
""", "panel")

q("panel_stock_flags", f"""
SELECT {K}, ending_inventory < 5 AND lost_sales_estimate > 0 AS stockout_flag,
       weeks_of_cover > 16 AS excess_inventory_flag,
       weeks_of_cover > 20 AND units_sold < p.base_demand * 0.3 AS slow_moving_flag
FROM panel LEFT JOIN products p USING (sku_id)
""", "panel", "products")

q("seasonality_index", f"""
SELECT {K}, {R('avg(latent_demand) OVER (PARTITION BY category, month(week_start)) / avg(latent_demand) OVER (PARTITION BY category)', 4)}
   AS seasonality_index FROM panel
""", "panel")

q("lifecycle_factor", f"""
SELECT {K}, {R6('avg(latent_demand) OVER (PARTITION BY sku_id, floor((week_num - 1) / 16)) / avg(latent_demand) OVER (PARTITION BY sku_id)')}
   AS lifecycle_factor FROM panel
""", "panel")

q("lifecycle_stage", """
SELECT sku_id, first_week, early_units, late_units, lifecycle_stage FROM o_stage
""", "o_stage")

q("tier_price", f"""
SELECT {K}, regular_price, {R(f"regular_price * (1.0 - {R('sum(customer_tier_discount_pct) OVER t', 4)} / count(*) OVER t)", 2)} AS tier_price
FROM panel WINDOW t AS (PARTITION BY customer_tier)
""", "panel")

q("economic_index", f"""
SELECT {K}, {R('sum(latent_demand) OVER (PARTITION BY week_num) / (sum(latent_demand) OVER () / (SELECT count(DISTINCT week_num) FROM panel))', 4)}
   AS economic_demand_index FROM panel
""", "panel")

q("latent_demand_model", f"""
SELECT {K}, {R6('''greatest(0.0, p.base_demand * (avg(latent_demand) OVER (PARTITION BY region) / avg(latent_demand) OVER ())
   * seasonality_index * economic_demand_index
   * (avg(latent_demand) OVER (PARTITION BY sku_id, floor((week_num - 1) / 16)) / avg(latent_demand) OVER (PARTITION BY sku_id)))''')}
   AS modeled_latent_demand
FROM panel LEFT JOIN products p USING (sku_id)
""", "panel", "products")

q("price_inversion_check", f"""
SELECT * FROM (
  SELECT {K}, realized_price,
         max(CASE WHEN customer_tier = 'Retail' THEN realized_price END) OVER w AS retail_price,
         max(CASE WHEN customer_tier = 'Trade' THEN realized_price END) OVER w AS trade_price,
         'CUSTOMER_TIER_LEAKAGE' AS reason_code
  FROM panel WINDOW w AS (PARTITION BY sku_id, region, week_num))
WHERE customer_tier = 'Fleet' AND (realized_price > trade_price OR realized_price > retail_price)
""", "panel")

# ------------------------------------------------------------ 2.3 features
cte("features", ("panel", "products"), f"""
SELECT *,
  CASE WHEN stockout_flag OR lost_sales_estimate > 0 THEN latent_demand ELSE units_sold END AS adjusted_units,
  weekofyear(week_start) AS week_of_year, month(week_start) AS month,
  coalesce(realized_price / lag(realized_price, 1) {W}) - 1.0, 0.0) AS price_change_pct,
  competitor_price_index AS price_index_vs_competitor, customer_tier_discount_pct AS tier_discount_pct,
  coalesce(lag(units_sold, 1) {W}), 0.0) AS lag_1_units,
  coalesce(lag(units_sold, 2) {W}), 0.0) AS lag_2_units,
  coalesce(lag(units_sold, 4) {W}), 0.0) AS lag_4_units,
  coalesce(lag(units_sold, 13) {W}), 0.0) AS lag_13_units,
  coalesce(avg(units_sold) {W} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 0.0) AS rolling_4_units,
  coalesce(avg(units_sold) {W} ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), 0.0) AS rolling_8_units,
  coalesce(avg(units_sold) {W} ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING), 0.0) AS rolling_13_units,
  coalesce(avg(revenue) {W} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 0.0) AS rolling_4_revenue,
  coalesce(avg(gross_margin_pct) {W} ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING), 0.0) AS rolling_13_margin,
  coalesce(lag(ending_inventory, 1) {W}), 0.0) AS prior_week_inventory
FROM (SELECT panel.*, p.lifecycle_stage, p.lead_time_days, p.product_age_weeks
      FROM panel LEFT JOIN products p USING (sku_id))
""")

q("feat_product_join", f"SELECT {K}, lifecycle_stage, lead_time_days, product_age_weeks FROM features", "features")
q("feat_adjusted_units", f"SELECT {K}, units_sold, lost_sales_estimate, adjusted_units FROM features", "features")
q("feat_calendar", f"SELECT {K}, CAST(week_start AS VARCHAR) AS week_start, week_of_year, month FROM features",
  "features")
q("feat_price_change", f"SELECT {K}, {R6('price_change_pct')} AS price_change_pct FROM features", "features")
q("feat_aliases", f"SELECT {K}, price_index_vs_competitor, tier_discount_pct FROM features", "features")
q("feat_lags", f"SELECT {K}, lag_1_units, lag_2_units, lag_4_units, lag_13_units FROM features", "features")
q("feat_rolling_units", f"""SELECT {K}, {R6('rolling_4_units')} AS rolling_4_units, {R6('rolling_8_units')} AS rolling_8_units,
  {R6('rolling_13_units')} AS rolling_13_units FROM features""", "features")
q("feat_rolling_revenue", f"SELECT {K}, {R6('rolling_4_revenue')} AS rolling_4_revenue FROM features", "features")
q("feat_rolling_margin", f"SELECT {K}, {R6('rolling_13_margin')} AS rolling_13_margin FROM features", "features")
q("feat_prior_inventory", f"SELECT {K}, prior_week_inventory FROM features", "features")
FILL = ["lag_1_units", "lag_2_units", "lag_4_units", "lag_13_units", "rolling_4_units", "rolling_8_units",
        "rolling_13_units", "rolling_4_revenue", "rolling_13_margin", "prior_week_inventory", "price_change_pct",
        "weeks_of_cover"]
q("feat_fill", f"SELECT {K}, " + ", ".join(f"{R6(c)} AS {c}" for c in FILL) + " FROM features", "features")

cte("split_features", ("features",), """
SELECT f.*, CASE WHEN week_num <= train_end THEN 'train' WHEN week_num <= val_end THEN 'val' ELSE 'test' END AS split
FROM features f, (SELECT CASE WHEN mx <= 104 THEN CAST(floor(mx * 0.75) AS INTEGER) ELSE 78 END AS train_end,
                         CASE WHEN mx <= 104 THEN CAST(floor(mx * 0.875) AS INTEGER) ELSE 91 END AS val_end
                  FROM (SELECT max(week_num) AS mx FROM features))
""")
q("time_split", f"SELECT {K}, split FROM split_features", "split_features")

cte("lk_numbered", ("features",), f"""
SELECT sku_id, region, customer_tier, units_sold, lag_1_units, lag_2_units, lag_4_units, lag_13_units,
       row_number() {W}) AS rn
FROM features""")
q("leakage_check", """
SELECT lag, CAST(count(*) AS BIGINT) AS checked_rows,
       CAST(sum(CASE WHEN abs(CASE lag WHEN 1 THEN a.lag_1_units WHEN 2 THEN a.lag_2_units WHEN 4 THEN a.lag_4_units
                                     ELSE a.lag_13_units END - b.units_sold) >= 0.01 THEN 1 ELSE 0 END) AS BIGINT)
         AS violations
FROM (VALUES (1), (2), (4), (13)) k(lag)
JOIN lk_numbered a ON true
JOIN lk_numbered b ON a.sku_id = b.sku_id AND a.region = b.region AND a.customer_tier = b.customer_tier
                  AND b.rn = a.rn - k.lag
GROUP BY lag
""", "lk_numbered")

# ------------------------------------------------------------ 2.4 / 2.5 baseline and metrics
cte("bl", ("split_features",), """
SELECT t.*, t.adjusted_units AS actual,
       CASE WHEN coalesce(a.v, 0.0) > 0 THEN coalesce(a.v, 0.0) ELSE coalesce(b.v, 0.0) END AS baseline_pred
FROM split_features t
LEFT JOIN (SELECT sku_id, region, customer_tier, week_num + 52 AS wk, adjusted_units AS v
           FROM split_features WHERE split = 'train') a
  ON t.sku_id = a.sku_id AND t.region = a.region AND t.customer_tier = a.customer_tier AND a.wk = t.week_num
LEFT JOIN (SELECT sku_id, region, customer_tier, week_num + 1 AS wk, adjusted_units AS v
           FROM split_features WHERE split = 'train') b
  ON t.sku_id = b.sku_id AND t.region = b.region AND t.customer_tier = b.customer_tier AND b.wk = t.week_num
WHERE t.split = 'test'
""")
q("baseline_seasonal_naive", f"SELECT {K}, actual, baseline_pred FROM bl", "bl")

MET = {
    "mae": R("sum(abs({y} - {p}))", 2) + " / count(abs({y} - {p}))",
    "rmse": "sqrt(" + R("sum(({y} - {p}) * ({y} - {p}))", 4) + " / count({y} - {p}))",
    "wape": ("CASE WHEN " + R("sum(abs({y}))", 2) + " = 0 THEN 0.0 ELSE " + R("sum(abs({y} - {p}))", 2)
             + " / " + R("sum(abs({y}))", 2) + " END"),
    "rmsle": "sqrt(avg((ln(1 + greatest({y}, 0.0)) - ln(1 + greatest({p}, 0.0))) * "
             "(ln(1 + greatest({y}, 0.0)) - ln(1 + greatest({p}, 0.0)))))",
    "bias": R("sum({p} - {y})", 2) + " / count({p} - {y})",
}
for _m, _e in MET.items():
    q("metric_" + _m, f"SELECT {R6(_e.format(y='actual', p='baseline_pred'))} AS {_m} FROM bl", "bl")
q("metrics_all", "SELECT category, " + ", ".join(
    f"{R6(e.format(y='actual', p='baseline_pred'))} AS {m}" for m, e in MET.items())
  + ", count(*) AS n_rows FROM bl GROUP BY category", "bl")
q("baseline_improvement", f"""
SELECT {R6('b')} AS baseline_wape, {R6('m')} AS model_wape,
       {R6('CASE WHEN b = 0 THEN 0.0 ELSE (b - m) / b END')} AS wape_improvement
FROM (SELECT {MET['wape'].format(y='actual', p='baseline_pred')} AS b,
             {MET['wape'].format(y='actual', p='lag_1_units')} AS m FROM bl)
""", "bl")

# ------------------------------------------------------------ 2.6 elasticity
QUALITY = ("(price_test_flag OR price_change_reason IN ('random_regional_test', 'scheduled_review', "
           "'supplier_cost_change')) AND NOT stockout_flag AND weeks_of_cover > 2")
cte("el_sample", ("panel",), f"""
SELECT panel.* FROM panel, (SELECT count(*) FILTER (WHERE {QUALITY}) AS nq FROM panel) c
WHERE CASE WHEN c.nq >= 100 THEN {QUALITY} ELSE NOT stockout_flag END
""")
cte("el_est", ("el_sample",), """
SELECT *, ln(1 + (units_sold + lost_sales_estimate)) AS log_units, ln(greatest(realized_price, 0.01)) AS log_price
FROM el_sample
""")
q("elasticity_sample", f"SELECT {K}, price_change_reason, price_test_flag FROM el_sample", "el_sample")
q("elasticity_log_transform", f"SELECT {K}, {R6('log_units')} AS log_units, {R6('log_price')} AS log_price FROM el_est",
  "el_est")

_X = ["log_price", "competitor_price_index", "promotion_depth", "seasonality_index"]
cte("el_mom", ("el_est",), "SELECT category, region, customer_tier, GROUPING(category, region, customer_tier) AS gid, "
    "count(*) AS n, stddev_samp(log_price) AS price_sd, var_pop(log_units) AS vyy, "
    + ", ".join(f"covar_pop({_X[i]}, log_units) AS cy{i}" for i in range(4)) + ", "
    + ", ".join(f"covar_pop({_X[i]}, {_X[j]}) AS c{i}{j}" for i in range(4) for j in range(i, 4))
    + " FROM el_est GROUP BY GROUPING SETS ((category, region, customer_tier), (category, customer_tier), ())")


def gauss_solve(src: str) -> str:
    """Adds beta_0..beta_3 and rss by Gaussian elimination of (n C + I) w = n c_xy (no pivoting; SPD)."""
    n = "CAST(n AS DOUBLE)"
    cols = []
    cur, curf = {}, {}
    for i in range(4):
        for j in range(4):
            a, b = min(i, j), max(i, j)
            cols.append(f"{n} * c{a}{b}" + (" + 1.0" if i == j else "") + f" AS e0_{i}{j}")
            cur[(i, j)] = f"e0_{i}{j}"
        cols.append(f"{n} * cy{i} AS f0_{i}")
        curf[i] = f"f0_{i}"
    sql = f"SELECT *, {', '.join(cols)} FROM ({src})"
    for k in range(3):
        cols, nc, nf = [], dict(cur), dict(curf)
        for i in range(k + 1, 4):
            fac = f"({cur[(i, k)]} / {cur[(k, k)]})"
            for j in range(k + 1, 4):
                cols.append(f"{cur[(i, j)]} - {fac} * {cur[(k, j)]} AS e{k + 1}_{i}{j}")
                nc[(i, j)] = f"e{k + 1}_{i}{j}"
            cols.append(f"{curf[i]} - {fac} * {curf[k]} AS f{k + 1}_{i}")
            nf[i] = f"f{k + 1}_{i}"
        sql = f"SELECT *, {', '.join(cols)} FROM ({sql})"
        cur, curf = nc, nf
    sql = f"SELECT *, {curf[3]} / {cur[(3, 3)]} AS beta_3 FROM ({sql})"
    for i in (2, 1, 0):
        s = curf[i] + "".join(f" - {cur[(i, j)]} * beta_{j}" for j in range(i + 1, 4))
        sql = f"SELECT *, ({s}) / {cur[(i, i)]} AS beta_{i} FROM ({sql})"
    wb = " + ".join(f"beta_{i} * {n} * cy{i}" for i in range(4))
    ww = " + ".join(f"beta_{i} * beta_{i}" for i in range(4))
    return f"SELECT *, greatest(0.0, {n} * vyy - ({wb}) - ({ww})) AS rss FROM ({sql})"


def fit_cols(prior: str) -> str:
    clip = "least(greatest(beta_0, -3.0), -0.1)"
    return f"""{R6(f"CASE WHEN n < 10 OR price_sd < 0.01 THEN {prior} ELSE {clip} END")} AS estimated_elasticity,
       {R6("CASE WHEN n < 10 THEN 0.0 ELSE price_sd END")} AS price_variation,
       {R6("CASE WHEN n < 10 THEN 1.0 WHEN price_sd < 0.01 THEN 0.5 ELSE sqrt(rss / n) / sqrt(CAST(n AS DOUBLE)) END")}
         AS standard_error,
       {R6("CASE WHEN n < 10 THEN 0.2 WHEN price_sd < 0.01 THEN 0.3 ELSE least(1.0, n / 200.0) * least(1.0, price_sd / 0.1) END")}
         AS confidence_score"""


cte("el_global", ("el_mom",), f"""
SELECT 'global' AS estimation_level, n AS sample_size, {fit_cols('-1.0')}
FROM ({gauss_solve("SELECT * FROM el_mom WHERE gid = 7")})
""")
cte("el_cells", ("el_mom", "products"), """
SELECT c.category, t.customer_tier, 'All' AS region, 'category_tier' AS level, coalesce(m.n, 0) AS n,
       m.price_sd, m.vyy, """ + ", ".join(f"m.cy{i}" for i in range(4)) + ", "
    + ", ".join(f"m.c{i}{j}" for i in range(4) for j in range(i, 4)) + """
FROM (SELECT DISTINCT category FROM products) c
CROSS JOIN (VALUES ('Retail'), ('Trade'), ('Fleet')) t(customer_tier)
LEFT JOIN (SELECT * FROM el_mom WHERE gid = 2) m ON m.category = c.category AND m.customer_tier = t.customer_tier
UNION ALL
SELECT category, customer_tier, region, 'category_region_tier' AS level, n, price_sd, vyy, """
    + ", ".join(f"cy{i}" for i in range(4)) + ", " + ", ".join(f"c{i}{j}" for i in range(4) for j in range(i, 4)) + """
FROM el_mom WHERE gid = 0 AND n >= 30
""")
CLASS = """CASE WHEN {c} < 0.4 OR {e} IS NULL OR isnan({e}) THEN 'Low confidence'
     WHEN {e} >= -3.0 AND {e} < -1.5 THEN 'Highly elastic' WHEN {e} >= -1.5 AND {e} < -1.0 THEN 'Elastic'
     WHEN {e} >= -1.0 AND {e} < -0.5 THEN 'Moderate' WHEN {e} >= -0.5 AND {e} < -0.1 THEN 'Inelastic'
     ELSE 'Moderate' END"""
cte("el_pre", ("el_cells", "el_global"), f"""
SELECT *, {CLASS.format(c='confidence_score', e='estimated_elasticity')} AS elasticity_class FROM (
  SELECT CASE WHEN level = 'category_tier' THEN category || ' × ' || customer_tier
              ELSE category || ' × ' || region || ' × ' || customer_tier END AS elasticity_segment,
         category, region, customer_tier, CAST(n AS BIGINT) AS sample_size, level AS estimation_level, g AS _global,
         {fit_cols('g')}
  FROM ({gauss_solve("SELECT * FROM el_cells")}), (SELECT estimated_elasticity AS g FROM el_global))
""")
cte("elasticity", ("el_pre",), f"""
SELECT elasticity_segment, category, region, customer_tier,
       CASE WHEN confidence_score < 0.4 THEN {R6('least(greatest(confidence_score * estimated_elasticity + (1.0 - confidence_score) * _global, -3.0), -0.1)')}
            ELSE estimated_elasticity END AS estimated_elasticity,
       sample_size, price_variation, standard_error, confidence_score, estimation_level,
       CASE WHEN confidence_score < 0.4 THEN 'Low confidence' ELSE elasticity_class END AS elasticity_class
FROM el_pre
""")
q("elasticity_fit_global", "SELECT * FROM el_global", "el_global")
q("elasticity_fit_category_tier", "SELECT * FROM elasticity WHERE estimation_level = 'category_tier'", "elasticity")
q("elasticity_fit_category_region_tier", "SELECT * FROM elasticity WHERE estimation_level = 'category_region_tier'",
  "elasticity")
q("elasticity_fallbacks", """
SELECT elasticity_segment, estimation_level, sample_size, estimated_elasticity, price_variation, standard_error,
       confidence_score,
       CASE WHEN sample_size < 10 THEN 'prior' WHEN standard_error = 0.5 THEN 'global_flat' ELSE 'fit' END AS fallback
FROM el_pre""", "el_pre")
q("elasticity_clip_confidence", """SELECT elasticity_segment, estimation_level, estimated_elasticity, standard_error,
  confidence_score FROM el_pre""", "el_pre")
q("elasticity_class", """SELECT elasticity_segment, estimation_level, estimated_elasticity, confidence_score,
  elasticity_class FROM el_pre""", "el_pre")
q("elasticity_shrink", "SELECT * FROM elasticity", "elasticity")
q("elasticity_reload", f"""
SELECT e.elasticity_segment, e.category, e.region, e.customer_tier, e.estimated_elasticity, e.sample_size,
       e.price_variation, e.standard_error, e.confidence_score, e.estimation_level,
       {CLASS.format(c='e.confidence_score', e='e.estimated_elasticity')} AS elasticity_class,
       {R6('g.global_elasticity')} AS global_elasticity
FROM elasticity e, (SELECT coalesce(max(CASE WHEN estimation_level = 'global' THEN estimated_elasticity END),
                                    median(estimated_elasticity)) AS global_elasticity FROM elasticity) g
""", "elasticity")

# ------------------------------------------------------------ 2.7 pricing
cte("latest", ("panel",), """
SELECT * FROM panel
QUALIFY row_number() OVER (PARTITION BY sku_id, region, customer_tier ORDER BY week_num DESC) = 1
""")
_PCOLS = ("product_name, subcategory, brand_tier, private_label_flag, regular_retail_price, minimum_margin_pct, "
          "minimum_advertised_price, supplier, lead_time_days, case_pack, product_age_weeks, lifecycle_stage, "
          "base_demand, true_price_elasticity, seasonality_strength, inventory_holding_cost, obsolescence_risk, "
          "minimum_order_quantity")
cte("rec_rows", ("latest", "products", "elasticity", "el_global"), f"""
SELECT l.*, {', '.join('p.' + c.strip() for c in _PCOLS.split(','))},
  CASE WHEN a.category IS NOT NULL THEN a.estimated_elasticity WHEN b.category IS NOT NULL THEN b.estimated_elasticity
       ELSE g.estimated_elasticity END AS el_estimated_elasticity,
  CASE WHEN a.category IS NOT NULL THEN a.confidence_score WHEN b.category IS NOT NULL THEN b.confidence_score
       ELSE 0.3 END AS el_confidence_score,
  CASE WHEN a.category IS NOT NULL THEN a.sample_size WHEN b.category IS NOT NULL THEN b.sample_size
       ELSE 0 END AS el_sample_size,
  CASE WHEN a.category IS NOT NULL THEN a.price_variation WHEN b.category IS NOT NULL THEN b.price_variation
       ELSE 0.0 END AS el_price_variation,
  CASE WHEN a.category IS NOT NULL THEN a.elasticity_class WHEN b.category IS NOT NULL THEN b.elasticity_class
       ELSE 'Low confidence' END AS el_elasticity_class,
  CASE WHEN a.category IS NOT NULL THEN a.estimation_level WHEN b.category IS NOT NULL THEN b.estimation_level
       ELSE 'global_prior' END AS el_estimation_level,
  max(CASE WHEN l.customer_tier = 'Retail' THEN l.realized_price END) OVER (PARTITION BY l.sku_id, l.region) AS tier_retail_price,
  max(CASE WHEN l.customer_tier = 'Trade' THEN l.realized_price END) OVER (PARTITION BY l.sku_id, l.region) AS tier_trade_price,
  max(CASE WHEN l.customer_tier = 'Fleet' THEN l.realized_price END) OVER (PARTITION BY l.sku_id, l.region) AS tier_fleet_price
FROM latest l
LEFT JOIN products p USING (sku_id)
LEFT JOIN (SELECT * FROM elasticity WHERE estimation_level = 'category_region_tier') a
  ON a.category = l.category AND a.region = l.region AND a.customer_tier = l.customer_tier
LEFT JOIN (SELECT * FROM elasticity WHERE region = 'All') b
  ON b.category = l.category AND b.customer_tier = l.customer_tier
CROSS JOIN el_global g
""")
S3 = "sku_id, region, customer_tier"


def sim_sql(price: str, prefix: str) -> str:
    """Simulation columns at ``price`` (SQL mirror of the Spark simulate_price)."""
    u = f"{prefix}units"
    return f"""greatest(0.0, units_sold * pow(CASE WHEN realized_price > 0 THEN {price} / realized_price ELSE 1.0 END,
                    el_estimated_elasticity)) AS {u}""", u


def sim_layer(src: str, price: str, p: str) -> str:
    units_expr, u = sim_sql(price, p)
    l1 = f"SELECT *, {units_expr} FROM ({src})"
    l2 = f"""SELECT *, {price} * {u} AS {p}revenue, greatest(0.0, ending_inventory - {u}) AS {p}ending,
                    CASE WHEN {u} > 0 THEN {u} ELSE 1.0 END AS {p}weekly FROM ({l1})"""
    l3 = f"""SELECT *, {p}revenue - unit_cost * {u} AS {p}gp,
                    CASE WHEN {p}weekly <= 0.01 THEN 999.0 ELSE {p}ending / {p}weekly END AS {p}woc,
                    CASE WHEN {p}ending < 2 AND {u} > ending_inventory THEN 1.0 WHEN {p}ending < 5 THEN 0.8
                         WHEN {p}ending < 10 THEN 0.1 ELSE 0.0 END AS {p}sp FROM ({l2})"""
    return f"""SELECT *, CASE WHEN {p}revenue = 0 THEN 0.0 ELSE {p}gp / {p}revenue END AS {p}margin,
                      CASE WHEN {p}woc > 16 THEN {p}ending ELSE 0.0 END AS {p}excess FROM ({l3})"""


def score_sql(obj: str) -> str:
    if obj == "maximize_gross_profit":
        return "c_gp"
    if obj == "maximize_revenue":
        return "c_revenue"
    if obj == "reduce_excess_inventory":
        return "(cur_ending - c_ending) * 10 + c_gp * 0.3"
    return ("0.4 * c_gp + 0.25 * CASE WHEN excess_inventory_flag OR weeks_of_cover > 16 "
            "THEN greatest(0.0, cur_ending - c_ending) ELSE 0.0 END - 0.2 * (c_sp * 100) "
            "- 0.1 * (abs(CASE WHEN realized_price > 0 THEN (candidate_price - realized_price) / realized_price "
            "ELSE 0.0 END) * 50) - 0.05 * CASE WHEN el_confidence_score < 0.4 THEN (1.0 - el_confidence_score) * 20 "
            "ELSE 0.0 END")


cte("cand", ("rec_rows",), f"""
SELECT r.*, i.idx, {R('r.realized_price * (1.0 + (i.idx - 15) / 100.0)', 2)} AS candidate_price
FROM rec_rows r CROSS JOIN range(0, 31) i(idx)
""")
_CAND_SIMS = sim_layer(sim_layer("SELECT * FROM cand", "realized_price", "cur_"), "candidate_price", "c_")
for _obj in ("balanced", "maximize_gross_profit", "maximize_revenue", "reduce_excess_inventory"):
    cte(f"sims_{_obj}", ("cand",), f"SELECT *, {R6(score_sql(_obj))} AS score FROM ({_CAND_SIMS})")
q("candidate_prices", f"SELECT {S3}, realized_price, CAST(idx AS INTEGER) AS idx, candidate_price FROM cand", "cand")
q("simulate_candidates", f"""
SELECT {S3}, CAST(idx AS INTEGER) AS idx, candidate_price, {R6('c_units')} AS predicted_units, {R6('c_revenue')} AS revenue,
       {R6('c_gp')} AS gross_profit, {R6('c_margin')} AS gross_margin_pct, {R6('c_ending')} AS expected_ending_inventory,
       {R6('c_woc')} AS expected_weeks_of_cover
FROM sims_balanced""", "sims_balanced")
q("inventory_impact", f"""
SELECT {S3}, CAST(idx AS INTEGER) AS idx, {R6('c_ending')} AS expected_ending_inventory,
       {R6('c_woc')} AS expected_weeks_of_cover, {R6('c_sp')} AS stockout_probability,
       {R6('c_excess')} AS excess_inventory_remaining
FROM sims_balanced""", "sims_balanced")
for _n, _obj in (("score_gross_profit", "maximize_gross_profit"), ("score_revenue", "maximize_revenue"),
                 ("score_excess_reduction", "reduce_excess_inventory"), ("score_balanced", "balanced")):
    q(_n, f"SELECT {S3}, CAST(idx AS INTEGER) AS idx, score FROM sims_{_obj}", f"sims_{_obj}")

cte("best", ("sims_balanced", "rec_rows"), f"""
SELECT r.*, coalesce(b.candidate_price, r.realized_price) AS best_price, b.score AS best_score
FROM rec_rows r LEFT JOIN (
  SELECT {S3}, candidate_price, score FROM sims_balanced WHERE score IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {S3} ORDER BY score DESC, idx ASC) = 1
) b USING (sku_id, region, customer_tier)
""")
q("argmax_candidate", f"SELECT {S3}, realized_price, best_price, best_score FROM best", "best")
q("tier_price_map", f"SELECT {S3}, tier_retail_price, tier_trade_price, tier_fleet_price FROM rec_rows", "rec_rows")

CUR = "realized_price"
cte("g1", ("best",), f"""
SELECT *, CASE WHEN hit1 THEN {CUR} * (1.0 + sgn * mm) ELSE best_price END AS g_price,
          CASE WHEN hit1 THEN sgn * mm ELSE g_change0 END AS g_change, hit1 AS g1_max_move,
          'NO_MATERIAL_OPPORTUNITY' AS g_reason
FROM (SELECT *, abs(actual) > mm AS hit1, CASE WHEN actual > 0 THEN 1.0 ELSE -1.0 END AS sgn FROM (
  SELECT *, CASE WHEN {CUR} > 0 THEN (best_price - {CUR}) / {CUR} ELSE 0.0 END AS actual,
            CASE WHEN {CUR} > 0 THEN (best_price - {CUR}) / {CUR} ELSE 0.0 END AS g_change0,
            CASE WHEN el_confidence_score < 0.4 THEN least(mm0, 0.03) ELSE mm0 END AS mm
  FROM (SELECT *, CASE WHEN excess_inventory_flag OR weeks_of_cover > 16 THEN 0.15 ELSE 0.1 END AS mm0 FROM best)))
""")
cte("g2", ("g1",), """
SELECT * REPLACE (CASE WHEN g2_margin_floor THEN g_floor ELSE g_price END AS g_price,
                  CASE WHEN g2_margin_floor THEN 'LOW_MARGIN_PROTECTION' ELSE g_reason END AS g_reason)
FROM (SELECT *, g_price < g_floor AS g2_margin_floor FROM (
  SELECT *, CASE WHEN coalesce(minimum_margin_pct, 0.15) < 1 THEN unit_cost / (1.0 - coalesce(minimum_margin_pct, 0.15))
                 ELSE unit_cost * 1.5 END AS g_floor FROM g1))
""")
cte("g3", ("g2",), """
SELECT * REPLACE (CASE WHEN g3_map THEN coalesce(minimum_advertised_price, 0.0) ELSE g_price END AS g_price,
                  CASE WHEN g3_map THEN 'MAP_CONSTRAINT' ELSE g_reason END AS g_reason)
FROM (SELECT *, coalesce(minimum_advertised_price, 0.0) > 0 AND g_price < coalesce(minimum_advertised_price, 0.0)
               AS g3_map FROM g2)
""")
cte("g4", ("g3",), """
SELECT * REPLACE (CASE WHEN g4_ladder_b THEN least(g_price, tier_retail_price) ELSE g_price END AS g_price)
FROM (SELECT *, customer_tier = 'Fleet' AND tier_retail_price IS NOT NULL AND g_price > tier_retail_price AS g4_ladder_b
FROM (SELECT * REPLACE (CASE WHEN ha THEN tier_retail_price WHEN hb THEN tier_trade_price ELSE g_price END AS g_price,
                        CASE WHEN ha OR hb THEN 'PRICE_LADDER_CONSTRAINT' ELSE g_reason END AS g_reason),
             coalesce(ha OR hb, false) AS g4_ladder_a
      FROM (SELECT *, coalesce(customer_tier = 'Trade' AND tier_retail_price IS NOT NULL AND g_price > tier_retail_price, false) AS ha,
                      coalesce(customer_tier = 'Fleet' AND tier_trade_price IS NOT NULL AND g_price > tier_trade_price, false) AS hb
            FROM g3)))
""")
cte("g5", ("g4",), f"""
SELECT * REPLACE (CASE WHEN cut THEN {CUR} WHEN rise THEN {CUR} * 1.03 ELSE g_price END AS g_price,
                  CASE WHEN cut THEN 'STOCKOUT_PROTECTION' ELSE g_reason END AS g_reason),
       cut OR rise AS g5_stockout
FROM (SELECT *, weeks_of_cover < 2 AND g_price < {CUR} AS cut,
                weeks_of_cover < 2 AND NOT (g_price < {CUR}) AND g_price > {CUR} * 1.03 AS rise FROM g4)
""")
cte("g6", ("g5",), f"""
SELECT * REPLACE (CASE WHEN g6_low_conf THEN CASE WHEN g_change > 0 THEN {CUR} * 1.03 ELSE {CUR} * 0.97 END
                       ELSE g_price END AS g_price,
                  CASE WHEN g6_low_conf THEN 'LOW_CONFIDENCE_TEST' ELSE g_reason END AS g_reason)
FROM (SELECT *, el_confidence_score < 0.4 AND abs(g_change) > 0.03 AS g6_low_conf FROM g5)
""")
RND = "CASE WHEN {p} >= 1 THEN floor({p}) + 0.99 ELSE " + R("{p}", 2) + " END"
cte("g7", ("g6",), f"""
SELECT * REPLACE (CASE WHEN g7_map THEN {RND.format(p='coalesce(minimum_advertised_price, 0.0)')} ELSE g_price END AS g_price)
FROM (SELECT *, coalesce(minimum_advertised_price, 0.0) > 0 AND g_price < coalesce(minimum_advertised_price, 0.0) AS g7_map
FROM (SELECT * REPLACE (CASE WHEN g7_floor THEN {RND.format(p='g_floor')} ELSE g_price END AS g_price)
      FROM (SELECT *, g_price < g_floor AS g7_floor FROM (
            SELECT * REPLACE ({RND.format(p='g_price')} AS g_price) FROM g6))))
""")
for _g, _c, _fl in (("max_move", "g1", ["g1_max_move"]), ("margin_floor", "g2", ["g2_margin_floor"]),
                    ("map", "g3", ["g3_map"]), ("tier_ladder", "g4", ["g4_ladder_a", "g4_ladder_b"]),
                    ("stockout", "g5", ["g5_stockout"]), ("low_confidence", "g6", ["g6_low_conf"]),
                    ("recheck", "g7", ["g7_floor", "g7_map"])):
    q("guard_" + _g, f"SELECT {S3}, {R6('g_price')} AS guarded_price, {R6('g_change')} AS change_arg, g_reason, "
      + ", ".join(_fl) + f" FROM {_c}", _c)

cte("recs_raw", ("g7",), sim_layer(sim_layer(f"""
SELECT *, concat_ws(',', CASE WHEN g1_max_move THEN 'MAX_MOVE' END, CASE WHEN g2_margin_floor THEN 'MARGIN_FLOOR' END,
          CASE WHEN g3_map THEN 'MAP' END, CASE WHEN g4_ladder_a THEN 'TIER_LADDER' END,
          CASE WHEN g4_ladder_b THEN 'TIER_LADDER' END, CASE WHEN g5_stockout THEN 'STOCKOUT_PROTECTION' END,
          CASE WHEN g6_low_conf THEN 'LOW_CONFIDENCE' END, CASE WHEN g7_floor THEN 'MARGIN_FLOOR' END,
          CASE WHEN g7_map THEN 'MAP' END) AS guardrail_triggered,
       CASE WHEN {CUR} > 0 THEN (g_price - {CUR}) / {CUR} ELSE 0.0 END AS fin_change
FROM g7""", "realized_price", "cur_"), "g_price", "fin_"))
ACTION = """CASE WHEN (g6_low_conf OR el_confidence_score < 0.3) AND abs(fin_change) < 0.01 THEN 'Hold'
     WHEN (g6_low_conf OR el_confidence_score < 0.3) AND abs(fin_change) < 0.05 THEN 'Test'
     WHEN (g6_low_conf OR el_confidence_score < 0.3) THEN 'Manual Review'
     WHEN abs(fin_change) < 0.005 THEN 'Hold' WHEN fin_change > 0.01 THEN 'Increase'
     WHEN fin_change < -0.01 THEN 'Decrease' ELSE 'Hold' END"""
cte("recommendations", ("recs_raw",), f"""
SELECT sku_id, category, region, customer_tier, {CUR} AS current_price, g_price AS recommended_price,
       {R('fin_change', 4)} AS price_change_pct, cur_units AS predicted_current_units,
       fin_units AS predicted_recommended_units, cur_revenue AS current_revenue, fin_revenue AS projected_revenue,
       cur_gp AS current_gross_profit, fin_gp AS projected_gross_profit, fin_gp - cur_gp AS gross_profit_lift,
       fin_margin AS gross_margin_pct, fin_ending AS expected_ending_inventory, fin_woc AS expected_weeks_of_cover,
       el_estimated_elasticity AS elasticity, el_confidence_score AS elasticity_confidence,
       {ACTION} AS recommendation_action,
       CASE WHEN guardrail_triggered = '' THEN CASE WHEN excess_inventory_flag THEN 'EXCESS_INVENTORY_MARKDOWN'
                 WHEN competitor_price_index > 1.05 THEN 'COMPETITOR_PRICE_GAP'
                 WHEN el_confidence_score > 0.6 AND g_change > 0.02 THEN 'INELASTIC_MARGIN_OPPORTUNITY'
                 ELSE g_reason END ELSE g_reason END AS reason_code,
       guardrail_triggered, 'Pending' AS approval_status, 'v2.0.0-inventory-engine' AS policy_version
FROM recs_raw
""")
_RF = ["predicted_current_units", "predicted_recommended_units", "current_revenue", "projected_revenue",
       "current_gross_profit", "projected_gross_profit", "gross_profit_lift", "gross_margin_pct",
       "expected_ending_inventory", "expected_weeks_of_cover", "recommended_price"]
q("reason_code", f"SELECT {S3}, guardrail_triggered, reason_code FROM recommendations", "recommendations")
q("guardrail_list", f"SELECT {S3}, guardrail_triggered FROM recommendations", "recommendations")
q("pricing_action", f"SELECT {S3}, price_change_pct, elasticity_confidence, recommendation_action FROM recommendations",
  "recommendations")
q("optimize_prices", "SELECT * REPLACE (" + ", ".join(f"{R6(c)} AS {c}" for c in _RF) + ") FROM recommendations",
  "recommendations")
q("price_recommendations", f"""SELECT {S3}, category, current_price, {R6('recommended_price')} AS recommended_price,
  price_change_pct, {R6('gross_profit_lift')} AS gross_profit_lift, recommendation_action, reason_code
FROM recommendations""", "recommendations")
q("round_price", f"""
SELECT {S3}, {R6('p')} AS raw_price, floor(p + 0.5) AS nearest_dollar, {RND.format(p='p')} AS ending_99,
       CASE WHEN p >= 1 THEN floor(p) + 0.95 ELSE {R('p', 2)} END AS ending_95, {R('p', 2)} AS cents
FROM (SELECT *, realized_price * 0.97 AS p FROM rec_rows)""", "rec_rows")
q("elasticity_lookup", f"""SELECT {S3}, category, el_estimated_elasticity, el_confidence_score, el_sample_size,
  el_price_variation, el_elasticity_class, el_estimation_level FROM rec_rows""", "rec_rows")
q("latest_by_key", "SELECT * REPLACE (CAST(week_start AS VARCHAR) AS week_start) FROM latest", "latest")
q("latest_with_product", f"""SELECT {S3}, week_num, realized_price, unit_cost, product_name, brand_tier,
  minimum_margin_pct, minimum_advertised_price, lead_time_days, case_pack, lifecycle_stage, base_demand,
  minimum_order_quantity FROM rec_rows""", "rec_rows")
q("predict_at_price", f"""SELECT {S3}, {R6('realized_price * 1.05')} AS candidate_price,
  {R6('greatest(0.0, units_sold * pow(CASE WHEN realized_price > 0 THEN realized_price * 1.05 / realized_price ELSE 1.0 END, el_estimated_elasticity))')}
  AS predicted_units FROM rec_rows""", "rec_rows")
q("predict_batch_at_prices", f"""SELECT {S3}, CAST(idx AS INTEGER) AS idx, candidate_price, {R6('c_units')} AS predicted_units
FROM sims_balanced""", "sims_balanced")
q("what_if_price", f"""
SELECT {S3}, what_if_price, {R6('w_units')} AS predicted_units, {R6('w_revenue')} AS revenue, {R6('w_gp')} AS gross_profit,
       {R6('w_margin')} AS gross_margin_pct, {R6('w_ending')} AS expected_ending_inventory,
       {R6('w_woc')} AS expected_weeks_of_cover, w_sp AS stockout_probability, cb.curve_best_price,
       {R6('cb.curve_max_gross_profit')} AS curve_max_gross_profit
FROM ({sim_layer(f"SELECT *, {R('realized_price * 0.95', 2)} AS what_if_price FROM rec_rows", "what_if_price", "w_")}) w
JOIN (SELECT {S3}, candidate_price AS curve_best_price, {R6('c_gp')} AS curve_max_gross_profit FROM sims_balanced
      QUALIFY row_number() OVER (PARTITION BY {S3} ORDER BY {R6('c_gp')} DESC, candidate_price ASC) = 1) cb
  USING (sku_id, region, customer_tier)
""", "rec_rows", "sims_balanced")

# ------------------------------------------------------------ 2.8 inventory
from shelfwise.plans.oracle_sql import RECURSIVE  # noqa: E402

cte("inv_top", ("panel",), """
SELECT *, count(*) OVER (PARTITION BY sku_id, region) AS n FROM (
  SELECT sku_id, region, latent_demand, units_sold,
         row_number() OVER (PARTITION BY sku_id, region ORDER BY week_num DESC, customer_tier DESC) AS rn
  FROM panel) WHERE rn <= 8
""")
cte("inv_hist", ("inv_top",), """
SELECT sku_id, region, greatest(s1 / n, 0.0) AS avg_demand,
       greatest(CASE WHEN n > 1 THEN sqrt(greatest((n * s2 - s1 * s1) / (n * (n - 1)), 0.0)) ELSE s1 / n * 0.2 END, 0.0)
         AS demand_sd,
       CASE WHEN n < 4 THEN 0.0 WHEN ps / (n // 2) <= 0 THEN 0.0
            ELSE (rs / (n // 2) - ps / (n // 2)) / (ps / (n // 2)) END AS trend
FROM (SELECT sku_id, region, CAST(any_value(n) AS DOUBLE) AS n, """ + R("sum(latent_demand)", 2) + """ AS s1,
             """ + R("sum(latent_demand * latent_demand)", 2) + """ AS s2,
             coalesce(""" + R("sum(CASE WHEN rn <= n // 2 THEN units_sold END)", 2) + """, 0.0) AS rs,
             coalesce(""" + R("sum(CASE WHEN rn > n - n // 2 THEN units_sold END)", 2) + """, 0.0) AS ps
      FROM inv_top GROUP BY sku_id, region)
""")
cte("inv_roll", ("latest",), """
SELECT sku_id, region, """ + ", ".join(R(f"sum({c})", 2) + f" AS {a}" for c, a in (
    ("ending_inventory", "on_hand"), ("on_order", "on_order_sum"), ("latent_demand", "latent_sum"),
    ("units_sold", "sold_sum"), ("beginning_inventory", "begin_sum"), ("receipts", "receipts_sum"),
    ("lost_sales_estimate", "lost_sum"))) + """
FROM latest GROUP BY sku_id, region
""")
ERF = ("(CASE WHEN ({x}) < 0 THEN -1.0 ELSE 1.0 END * (1.0 - (1.0 / (1.0 + 0.3275911 * abs({x}))) * "
       "(0.254829592 + (1.0 / (1.0 + 0.3275911 * abs({x}))) * (-0.284496736 + (1.0 / (1.0 + 0.3275911 * abs({x}))) * "
       "(1.421413741 + (1.0 / (1.0 + 0.3275911 * abs({x}))) * (-1.453152027 + (1.0 / (1.0 + 0.3275911 * abs({x}))) * "
       "1.061405429)))) * exp(-(abs({x}) * abs({x})))))")


def inventory_metrics_sql(z: float, target: float) -> str:
    sp_z = "((on_hand + on_order_sum) - avg_demand * lt1) / (demand_sd * sqrt(lt1))"
    cdf = f"0.5 * (1.0 + {ERF.format(x=f'-({sp_z}) / 1.4142135623730951')})"
    return f"""
SELECT sku_id, category, region, unit_cost, on_hand AS on_hand_inventory, on_order_sum AS on_order_inventory,
  avail AS available_inventory, {R('avg_demand', 3)} AS average_weekly_demand, {R('demand_sd', 3)} AS demand_std,
  {R('trend', 4)} AS demand_trend, {R('ohw', 2)} AS on_hand_weeks_of_cover, {R('aw', 2)} AS available_weeks_of_cover,
  {R('turns', 3)} AS inventory_turns, {R('st', 4)} AS sell_through_rate, {R('sp', 4)} AS stockout_probability,
  {R('ss', 2)} AS safety_stock, {R('avg_demand * greatest(lt, 0.1) + ss', 2).replace('(avg_demand', '(greatest(0.0, avg_demand').replace('+ ss)', '+ ss))')} AS reorder_point,
  {R('ex', 2)} AS excess_units, {R('greatest(0.0, ex * unit_cost)', 2)} AS excess_inventory_value,
  {R('CASE WHEN latent_sum > sold_sum THEN greatest(0.0, latent_sum - sold_sum) ELSE lost_sum END', 2)} AS lost_sales_estimate,
  {R('''least(greatest(coalesce(obsolescence_risk, 0.1) + CASE WHEN lifecycle_stage IN ('Decline', 'End-of-Life') THEN 0.35 ELSE 0.0 END
     + CASE WHEN product_age_weeks > 130 THEN 0.15 ELSE 0.0 END + CASE WHEN aw > 20 THEN 0.2 ELSE 0.0 END
     + CASE WHEN trend < -0.1 THEN 0.15 ELSE 0.0 END + CASE WHEN st < 0.2 THEN 0.15 ELSE 0.0 END, 0.0), 1.0)''', 4)}
     AS obsolescence_risk_score,
  {R('lt', 2)} AS lead_time_weeks, CAST(coalesce(case_pack, 1) AS INTEGER) AS case_pack,
  CAST(coalesce(minimum_order_quantity, 1) AS INTEGER) AS minimum_order_quantity,
  coalesce(lifecycle_stage, 'Mature') AS lifecycle_stage, coalesce(product_age_weeks, 52) AS product_age_weeks
FROM (
  SELECT *, CASE WHEN avg_demand <= 0.01 THEN 999.0 ELSE on_hand / avg_demand END AS ohw,
         CASE WHEN avg_demand <= 0.01 THEN 999.0 ELSE avail / avg_demand END AS aw,
         greatest(0.0, {z} * demand_sd * sqrt(greatest(lt, 0.1))) AS ss,
         greatest(0.0, avail - {float(target)} * greatest(avg_demand, 0.01)) AS ex,
         CASE WHEN begin_sum + receipts_sum <= 0 THEN 0.0 ELSE least(1.0, sold_sum / (begin_sum + receipts_sum)) END AS st,
         CASE WHEN avg_demand <= 0 THEN 0.0
              WHEN demand_sd * sqrt(lt1) <= 0 THEN CASE WHEN on_hand + on_order_sum < avg_demand * lt1 THEN 1.0 ELSE 0.0 END
              ELSE least(greatest({cdf}, 0.0), 1.0) END AS sp,
         CASE WHEN unit_cost * greatest(on_hand, 1.0) * 52 <= 0 THEN 0.0
              ELSE unit_cost * units_total / (unit_cost * greatest(on_hand, 1.0) * 52) END AS turns
  FROM (
    SELECT r.*, h.avg_demand, h.demand_sd, h.trend, u.units_total, p.category, p.unit_cost, p.case_pack,
           p.product_age_weeks, p.lifecycle_stage, p.obsolescence_risk, p.minimum_order_quantity,
           coalesce(p.lead_time_days, 14) / 7.0 AS lt, greatest(coalesce(p.lead_time_days, 14) / 7.0, 0.1) AS lt1,
           r.on_hand + r.on_order_sum AS avail
    FROM inv_roll r
    JOIN inv_hist h USING (sku_id, region)
    JOIN (SELECT sku_id, region, {R('sum(units_sold)', 2)} AS units_total FROM panel GROUP BY sku_id, region) u USING (sku_id, region)
    JOIN products p USING (sku_id)))
"""


def status_sql(tgt: float = 8) -> str:
    return f"""CASE WHEN on_hand_inventory <= 0 THEN 'STOCKOUT'
     WHEN stockout_probability >= 0.6 OR (on_hand_weeks_of_cover < lead_time_weeks AND on_hand_inventory > 0) THEN 'STOCKOUT_RISK'
     WHEN obsolescence_risk_score >= 0.65 OR (lifecycle_stage IN ('Decline', 'End-of-Life') AND available_weeks_of_cover > 4)
          THEN 'OBSOLETE_RISK'
     WHEN available_weeks_of_cover < 4 AND on_hand_inventory > 0 THEN 'UNDERSTOCKED'
     WHEN inventory_turns < 2.0 AND available_weeks_of_cover > {float(tgt)} THEN 'SLOW_MOVING'
     WHEN available_weeks_of_cover > 16 THEN 'OVERSTOCKED' ELSE 'HEALTHY' END"""


cte("inventory_metrics", ("panel", "products", "inv_roll", "inv_hist"), inventory_metrics_sql(1.65, 8))
cte("inv_status", ("inventory_metrics",), f"SELECT *, {status_sql(8)} AS inventory_status FROM inventory_metrics")

q("avg_weekly_demand", f"SELECT sku_id, region, {R6('avg_demand')} AS avg_demand, {R6('demand_sd')} AS demand_sd FROM inv_hist",
  "inv_hist")
q("demand_trend", f"SELECT sku_id, region, {R6('trend')} AS trend FROM inv_hist", "inv_hist")
q("tier_inventory_rollup", "SELECT sku_id, region, " + ", ".join(
    f"{R6(c)} AS {c}" for c in ("on_hand", "on_order_sum", "latent_sum", "sold_sum", "begin_sum", "receipts_sum",
                                "lost_sum")) + " FROM inv_roll", "inv_roll")
_INVQ = {
    "weeks_of_cover": "on_hand_inventory, available_inventory, average_weekly_demand, on_hand_weeks_of_cover, available_weeks_of_cover",
    "safety_stock": "demand_std, lead_time_weeks, safety_stock",
    "reorder_point": "average_weekly_demand, lead_time_weeks, safety_stock, reorder_point",
    "excess_units_value": "available_inventory, excess_units, excess_inventory_value",
    "lost_sales": "lost_sales_estimate",
    "sell_through": "sell_through_rate",
    "stockout_probability": "on_hand_inventory, on_order_inventory, stockout_probability",
    "obsolescence_score": "lifecycle_stage, product_age_weeks, demand_trend, obsolescence_risk_score",
    "inventory_turns": "unit_cost, on_hand_inventory, inventory_turns",
}
for _n, _c in _INVQ.items():
    q(_n, f"SELECT sku_id, region, {_c} FROM inv_status", "inv_status")
q("holding_cost", f"""SELECT sku_id, region, excess_inventory_value,
  {R6('excess_inventory_value * 0.25 * 0.019230769230769232')} AS holding_cost FROM inv_status""", "inv_status")
CPR = "CASE WHEN {p} <= 1 THEN greatest(0.0, ceil({q})) WHEN {q} <= 0 THEN 0.0 ELSE ceil({q} / {p}) * {p} END"
q("case_pack_round", f"""SELECT sku_id, region, case_pack, {R6('q3')} AS quantity,
  CAST({CPR.format(p='case_pack', q='q3')} AS DOUBLE) AS rounded_quantity
FROM (SELECT *, average_weekly_demand * 3 - on_hand_inventory AS q3 FROM inv_status)""", "inv_status")
q("sku_region_metrics", "SELECT * FROM inventory_metrics", "inventory_metrics")
q("inventory_status", """SELECT sku_id, region, on_hand_inventory, available_weeks_of_cover, stockout_probability,
  inventory_turns, obsolescence_risk_score, inventory_status FROM inv_status""", "inv_status")

# ------------------------------------------------------------ 2.9 replenishment
cte("replen", ("inv_status",), f"""
SELECT * REPLACE (rop AS reorder_point, ss AS safety_stock),
  net AS net_requirement,
  CASE WHEN inventory_status = 'STOCKOUT' THEN greatest(qq, CAST({CPR.format(p='coalesce(case_pack, 1)', q='average_weekly_demand * 4')} AS DOUBLE))
       WHEN covered OR stop THEN 0.0 ELSE qq END AS recommended_order_quantity,
  CASE WHEN average_weekly_demand > 0 THEN floor(on_hand_inventory / average_weekly_demand * 100 + 0.5) / 100.0
       ELSE 999.0 END AS expected_stockout_weeks,
  CASE WHEN inventory_status = 'STOCKOUT' THEN 'EXPEDITE_ORDER' WHEN covered THEN 'NO_ACTION' WHEN exp THEN 'EXPEDITE_ORDER'
       WHEN short THEN 'REPLENISH' WHEN stop THEN 'STOP_OR_DELAY_ORDER' ELSE 'NO_ACTION' END AS replenishment_action,
  CASE WHEN inventory_status = 'STOCKOUT' THEN 'STOCKOUT_EXPEDITE' WHEN covered THEN 'ON_ORDER_COVERS_REQUIREMENT'
       WHEN exp THEN 'IMMINENT_STOCKOUT' WHEN short THEN 'BELOW_REORDER_POINT' WHEN stop THEN 'EXCESS_ON_ORDER'
       ELSE 'SUFFICIENT_INVENTORY' END AS replenishment_reason
FROM (
  SELECT *, short AND NOT covered AND stockout_probability >= 0.65 AS exp FROM (
    SELECT *, CASE WHEN q0 > 0 AND q0 < coalesce(minimum_order_quantity, 1) THEN CAST(coalesce(minimum_order_quantity, 1) AS DOUBLE)
                   ELSE q0 END AS qq,
           inventory_status IN ('STOCKOUT_RISK', 'UNDERSTOCKED') AS short,
           inventory_status IN ('STOCKOUT_RISK', 'UNDERSTOCKED') AND on_order_inventory >= rop * 0.9 AS covered,
           inventory_status IN ('OVERSTOCKED', 'SLOW_MOVING', 'OBSOLETE_RISK') AND on_order_inventory > 0
             AND on_hand_inventory + on_order_inventory > rop * 2 AS stop
    FROM (SELECT *, CAST({CPR.format(p='coalesce(case_pack, 1)', q='net')} AS DOUBLE) AS q0 FROM (
      SELECT *, greatest(0.0, rop - on_hand_inventory - on_order_inventory) AS net FROM (
        SELECT *, CASE WHEN coalesce(reorder_point, 0.0) <= 0
                       THEN greatest(0.0, average_weekly_demand * greatest(coalesce(lead_time_weeks, 2.0), 0.1) + ss)
                       ELSE reorder_point END AS rop FROM (
          SELECT *, CASE WHEN coalesce(reorder_point, 0.0) <= 0
                         THEN greatest(0.0, 1.65 * coalesce(demand_std, average_weekly_demand * 0.2)
                                       * sqrt(greatest(coalesce(lead_time_weeks, 2.0), 0.1)))
                         ELSE coalesce(safety_stock, 0.0) END AS ss
          FROM inv_status))))))
""")
q("replenishment", f"""SELECT sku_id, region, inventory_status, {R6('reorder_point')} AS reorder_point,
  {R6('safety_stock')} AS safety_stock, {R6('net_requirement')} AS net_requirement, recommended_order_quantity,
  expected_stockout_weeks, replenishment_action, replenishment_reason FROM replen""", "replen")

# ------------------------------------------------------------ 2.9 transfers (recursive walk per source)
cte("tr_pairs", ("inv_status",), """
SELECT s.sku_id, s.category, s.region AS source_region, d.region AS destination_region,
       greatest(0.0, s.on_hand_inventory - s.safety_stock - s.average_weekly_demand * 2) AS source_excess,
       CASE WHEN greatest(0.0, d.reorder_point - d.on_hand_inventory - d.on_order_inventory) <= 0
            THEN d.average_weekly_demand * 2
            ELSE greatest(0.0, d.reorder_point - d.on_hand_inventory - d.on_order_inventory) END AS destination_shortage,
       s.case_pack AS s_pack, s.unit_cost AS s_cost, s.inventory_status AS s_status,
       row_number() OVER (PARTITION BY s.sku_id, s.region ORDER BY d.region) AS rk
FROM inv_status s JOIN inv_status d ON s.sku_id = d.sku_id AND s.region <> d.region
WHERE s.inventory_status IN ('OVERSTOCKED', 'SLOW_MOVING', 'OBSOLETE_RISK')
  AND d.inventory_status IN ('STOCKOUT', 'STOCKOUT_RISK', 'UNDERSTOCKED')
""")
q("transfer_candidates", f"""SELECT sku_id, source_region, destination_region, {R6('source_excess')} AS source_excess,
  {R6('destination_shortage')} AS destination_shortage FROM tr_pairs""", "tr_pairs")


def walk_sql(min_value: float) -> str:
    qty = CPR.format(p="p.s_pack", q="least(w.rem, p.destination_shortage, 500.0)")
    keep = (f"w.rem > 0 AND ({qty}) > 0 AND ({qty}) * (p.s_cost * 1.5 - p.s_cost) * 0.7 - ({qty}) * 2.5 > {min_value} "
            f"AND ({qty}) * (p.s_cost * 1.5 - p.s_cost) * 0.7 > ({qty}) * 2.5")
    return f"""
SELECT sku_id, source_region, CAST(0 AS BIGINT) AS rk, source_excess AS rem, false AS kept, CAST(0 AS DOUBLE) AS qty,
       CAST(NULL AS VARCHAR) AS destination_region
FROM tr_pairs WHERE rk = 1 AND source_excess > 0
UNION ALL
SELECT w.sku_id, w.source_region, p.rk,
       CASE WHEN {keep} THEN w.rem - CAST({qty} AS DOUBLE) ELSE w.rem END,
       {keep}, CAST({qty} AS DOUBLE), p.destination_region
FROM tr_walk w JOIN tr_pairs p ON p.sku_id = w.sku_id AND p.source_region = w.source_region AND p.rk = w.rk + 1
"""


cte("tr_walk", ("tr_pairs",), walk_sql(50.0))
RECURSIVE.add("tr_walk")
AFTER = """CASE WHEN {h} <= 0 THEN 'STOCKOUT'
     WHEN {x}.stockout_probability >= 0.6 OR ({x}.on_hand_weeks_of_cover < {x}.lead_time_weeks AND {h} > 0) THEN 'STOCKOUT_RISK'
     WHEN {x}.obsolescence_risk_score >= 0.65 OR ({x}.lifecycle_stage IN ('Decline', 'End-of-Life') AND {w} > 4) THEN 'OBSOLETE_RISK'
     WHEN {w} < 4 AND {h} > 0 THEN 'UNDERSTOCKED'
     WHEN {x}.inventory_turns < 2.0 AND {w} > 8.0 THEN 'SLOW_MOVING'
     WHEN {w} > 16 THEN 'OVERSTOCKED' ELSE 'HEALTHY' END"""
cte("transfers", ("tr_walk", "tr_pairs", "inv_status"), f"""
SELECT w.sku_id, p.category, w.source_region, w.destination_region, w.qty AS transfer_quantity,
       {R('w.qty * 2.5', 2)} AS transfer_cost, 2.5 AS transfer_cost_per_unit,
       {R('w.qty * (p.s_cost * 1.5) * 0.7', 2)} AS expected_revenue_recovered,
       {R('w.qty * (p.s_cost * 1.5 - p.s_cost) * 0.7', 2)} AS expected_gp_recovered,
       {R('w.qty * (p.s_cost * 1.5 - p.s_cost) * 0.7 - w.qty * 2.5', 2)} AS net_transfer_value,
       s.inventory_status AS source_status_before,
       {AFTER.format(h='(s.on_hand_inventory - w.qty)', x='s',
                     w='((s.on_hand_inventory - w.qty) / greatest(s.average_weekly_demand, 0.01))')} AS source_status_after,
       d.inventory_status AS destination_status_before,
       {AFTER.format(h='(d.on_hand_inventory + w.qty)', x='d',
                     w='((d.on_hand_inventory + w.qty) / greatest(d.average_weekly_demand, 0.01))')} AS destination_status_after,
       'REGIONAL_IMBALANCE' AS transfer_reason
FROM tr_walk w
JOIN tr_pairs p ON p.sku_id = w.sku_id AND p.source_region = w.source_region AND p.rk = w.rk
JOIN inv_status s ON s.sku_id = w.sku_id AND s.region = w.source_region
JOIN inv_status d ON d.sku_id = w.sku_id AND d.region = w.destination_region
WHERE w.kept
""")
q("transfer_allocation", "SELECT sku_id, source_region, destination_region, transfer_quantity FROM transfers", "transfers")
q("transfer_value", """SELECT sku_id, source_region, destination_region, transfer_cost, expected_revenue_recovered,
  expected_gp_recovered, net_transfer_value FROM transfers""", "transfers")
q("transfer_status_after", """SELECT sku_id, source_region, destination_region, source_status_before, source_status_after,
  destination_status_before, destination_status_after FROM transfers""", "transfers")

# ------------------------------------------------------------ 2.10 joint
cte("tr_flag", ("transfers",), """
SELECT DISTINCT sku_id, region, true AS transfer_candidate_flag FROM (
  SELECT sku_id, source_region AS region FROM transfers UNION ALL
  SELECT sku_id, destination_region AS region FROM transfers)
""")
cte("hist_weeks", ("panel",), "SELECT sku_id, region, count(DISTINCT week_num) AS history_weeks FROM panel GROUP BY ALL")
_INV = ["on_hand_inventory", "on_order_inventory", "average_weekly_demand", "demand_std", "inventory_turns",
        "on_hand_weeks_of_cover", "available_weeks_of_cover", "sell_through_rate", "stockout_probability",
        "safety_stock", "reorder_point", "excess_units", "excess_inventory_value", "lost_sales_estimate",
        "obsolescence_risk_score"]
INV_ACTION = """CASE
  WHEN tflag AND st IN ('OVERSTOCKED', 'SLOW_MOVING', 'OBSOLETE_RISK') THEN ['INTER_REGION_TRANSFER', 'REGIONAL_IMBALANCE_TRANSFER']
  WHEN st = 'STOCKOUT' THEN ['EXPEDITE_ORDER', 'STOCKOUT_EXPEDITE']
  WHEN st IN ('STOCKOUT_RISK', 'UNDERSTOCKED') AND i_on_order_inventory >= i_reorder_point * 0.8 THEN ['NO_ACTION', 'ON_ORDER_SUFFICIENT']
  WHEN st IN ('STOCKOUT_RISK', 'UNDERSTOCKED') AND i_stockout_probability >= 0.7 THEN ['EXPEDITE_ORDER', 'HIGH_STOCKOUT_RISK']
  WHEN st IN ('STOCKOUT_RISK', 'UNDERSTOCKED') THEN ['REPLENISH', 'UNDERSTOCKED_REPLENISH']
  WHEN aw > 16 AND i_on_order_inventory > 0 THEN ['STOP_OR_DELAY_ORDER', 'EXCESS_ON_ORDER']
  WHEN st IN ('SLOW_MOVING', 'OBSOLETE_RISK') AND i_obsolescence_risk_score > 0.5 THEN ['STOP_OR_DELAY_ORDER', 'OBSOLESCENCE_STOP_ORDER']
  WHEN st = 'OVERSTOCKED' AND abs(elasticity) < 0.5 THEN ['STOP_OR_DELAY_ORDER', 'INELASTIC_OVERSTOCK']
  WHEN st IN ('OVERSTOCKED', 'SLOW_MOVING') AND abs(elasticity) >= 0.8 AND md_rec THEN ['PRICE_MARKDOWN', 'POSITIVE_MARKDOWN_ECONOMICS']
  WHEN st = 'OVERSTOCKED' AND abs(elasticity) >= 1.0 THEN ['PRICE_MARKDOWN', 'EXCESS_HIGH_ELASTICITY']
  WHEN st = 'OBSOLETE_RISK' AND i_obsolescence_risk_score >= 0.8 THEN ['LIQUIDATION_REVIEW', 'HIGH_OBSOLESCENCE']
  WHEN st = 'OBSOLETE_RISK' THEN ['MANUAL_REVIEW', 'OBSOLETE_RISK_REVIEW']
  WHEN st = 'HEALTHY' THEN ['NO_ACTION', 'HEALTHY_INVENTORY']
  WHEN elasticity_confidence < 0.4 THEN ['MANUAL_REVIEW', 'LOW_CONFIDENCE_INVENTORY']
  ELSE ['HOLD_PRICE', 'NO_INVENTORY_ACTION'] END"""
cte("joint_base", ("recommendations", "replen", "tr_flag", "hist_weeks"), f"""
SELECT *, act[1] AS inv_action, act[2] AS inv_reason FROM (
SELECT *, {INV_ACTION} AS act FROM (
SELECT r.*, {', '.join(f'coalesce(v.{c}, 0.0) AS i_{c}' for c in _INV)},
       coalesce(v.inventory_status, 'HEALTHY') AS st, coalesce(v.available_weeks_of_cover, 99.0) AS aw,
       coalesce(v.recommended_order_quantity, 0.0) AS i_order_qty,
       coalesce(f.transfer_candidate_flag, false) AS tflag, coalesce(h.history_weeks, 8) AS hw,
       r.projected_gross_profit - r.current_gross_profit
         + coalesce(v.excess_inventory_value, 0.0) * 0.25 * 0.07692307692307693
         + coalesce(v.excess_inventory_value, 0.0) * coalesce(v.obsolescence_risk_score, 0.0) * 0.1 AS md_net,
       coalesce(v.excess_inventory_value, 0.0) * 0.25 * 0.07692307692307693 AS md_holding,
       coalesce(v.excess_inventory_value, 0.0) * coalesce(v.obsolescence_risk_score, 0.0) * 0.1 AS md_avoided,
       r.projected_gross_profit - r.current_gross_profit
         + coalesce(v.excess_inventory_value, 0.0) * 0.25 * 0.07692307692307693
         + coalesce(v.excess_inventory_value, 0.0) * coalesce(v.obsolescence_risk_score, 0.0) * 0.1 > 10.0 AS md_rec
FROM recommendations r
LEFT JOIN replen v USING (sku_id, region)
LEFT JOIN tr_flag f USING (sku_id, region)
LEFT JOIN hist_weeks h USING (sku_id, region)))
""")
cte("joint", ("joint_base",), f"""
SELECT * EXCLUDE (pa1, pa2, man1, big, trl) FROM (
SELECT *, CASE WHEN big THEN 'Manual Review' ELSE pa2 END AS pricing_action,
          CASE WHEN trl THEN 'MANUAL_REVIEW' ELSE inv_action END AS inventory_action,
          man1 OR inv_action = 'MANUAL_REVIEW' OR big OR trl AS manual_review_required
FROM (
SELECT *, joint_confidence = 'LOW' AND abs(price_change_pct) > 0.03 AS big,
          joint_confidence = 'LOW' AND inv_action = 'INTER_REGION_TRANSFER' AS trl
FROM (
SELECT *, CASE WHEN inv_action IN ('STOP_OR_DELAY_ORDER', 'INTER_REGION_TRANSFER', 'LIQUIDATION_REVIEW') AND pa1 = 'Decrease'
               THEN 'Hold' ELSE pa1 END AS pa2,
          st IN ('STOCKOUT', 'STOCKOUT_RISK', 'UNDERSTOCKED') AND inv_action IN ('REPLENISH', 'EXPEDITE_ORDER')
            AND pa1 = 'Decrease' AS man1,
          CASE WHEN js >= 0.7 THEN 'HIGH' WHEN js >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS joint_confidence,
          {R('js', 3)} AS joint_confidence_score
FROM (
SELECT *, CASE WHEN st IN ('STOCKOUT', 'STOCKOUT_RISK', 'UNDERSTOCKED') AND (recommendation_action = 'Decrease' OR price_change_pct < -0.005)
               THEN 'Hold' ELSE recommendation_action END AS pa1,
          greatest(0.0, least(1.0, 0.35 * elasticity_confidence + 0.25 * least(1.0, hw / 13.0) + 0.13999999999999999
                   + 0.2 * (1.0 - least(0.3, CASE WHEN st IN ('STOCKOUT', 'STOCKOUT_RISK') THEN 0.1 ELSE 0.02 END * 0.5)))) AS js
FROM joint_base))))
""")
_JF = ["recommended_price", "predicted_current_units", "predicted_recommended_units", "current_revenue",
       "projected_revenue", "current_gross_profit", "projected_gross_profit", "gross_profit_lift",
       "gross_margin_pct", "expected_ending_inventory", "expected_weeks_of_cover", "modeled_gp_lift"]
cte("joint_out", ("joint",), f"""
SELECT sku_id, category, region, customer_tier, current_price, recommended_price, price_change_pct,
       predicted_current_units, predicted_recommended_units, current_revenue, projected_revenue,
       current_gross_profit, projected_gross_profit, gross_profit_lift, gross_margin_pct,
       expected_ending_inventory, expected_weeks_of_cover, elasticity, elasticity_confidence,
       guardrail_triggered, approval_status, policy_version,
       pricing_action, reason_code AS pricing_reason_code, gross_profit_lift AS modeled_gp_lift,
       {', '.join(f'i_{c} AS {c}' for c in _INV)},
       st AS inventory_status, inventory_action, inv_reason AS inventory_reason_code,
       i_order_qty AS recommended_order_quantity, tflag AS transfer_candidate_flag,
       elasticity_confidence AS pricing_confidence, joint_confidence_score AS inventory_confidence,
       joint_confidence, joint_confidence_score, manual_review_required,
       pricing_action AS recommendation_action, reason_code, '1970-01-01T00:00:00' AS generated_at
FROM joint
""")
q("transfer_flag", "SELECT * FROM tr_flag", "tr_flag")
q("history_weeks", "SELECT sku_id, region, history_weeks FROM hist_weeks", "hist_weeks")
q("joint_confidence", f"""SELECT {S3}, elasticity_confidence, inventory_status, joint_confidence, joint_confidence_score
FROM joint_out""", "joint_out")
q("low_confidence_override", f"""SELECT {S3}, price_change_pct, pricing_action, inventory_action, manual_review_required
FROM joint_out WHERE joint_confidence = 'LOW'""", "joint_out")
q("joint_recommendations", "SELECT * REPLACE (" + ", ".join(f"{R6(c)} AS {c}" for c in _JF) + ") FROM joint_out",
  "joint_out")
q("markdown_economics", f"""SELECT {S3}, {R6('md_net')} AS net_markdown_value, {R6('md_holding')} AS holding_cost_reduction,
  {R6('md_avoided')} AS avoided_obsolescence_loss, md_rec AS markdown_recommended FROM joint_base""", "joint_base")
q("inventory_action", f"""SELECT {S3}, inventory_status, transfer_candidate_flag, inventory_action, inventory_reason_code
FROM joint_out""", "joint_out")
q("legacy_action_label", f"""SELECT {S3}, inventory_action, CASE inventory_action WHEN 'REPLENISH' THEN 'Replenishment'
  WHEN 'EXPEDITE_ORDER' THEN 'Replenishment' WHEN 'INTER_REGION_TRANSFER' THEN 'Inter-region transfer'
  WHEN 'PRICE_MARKDOWN' THEN 'Price Markdown' ELSE 'Hold' END AS legacy_action FROM joint_out""", "joint_out")
q("conflict_resolution", f"""SELECT {S3}, inventory_status, inventory_action, price_change_pct, pricing_action,
  manual_review_required FROM joint_out""", "joint_out")
q("action_matrix", f"""
SELECT {S3}, inventory_status, elasticity,
  coalesce(a.pricing, b.pricing, 'Hold') AS matrix_pricing_action, coalesce(a.stock, b.stock, 'NO_ACTION') AS matrix_inventory_action
FROM (SELECT *, CASE WHEN abs(elasticity) >= 1.0 THEN 'high' WHEN abs(elasticity) >= 0.5 THEN 'low' ELSE 'any' END AS bucket
      FROM joint_out) j
LEFT JOIN (VALUES ('HEALTHY', 'high', 'Optimize margin', 'NO_ACTION'), ('HEALTHY', 'low', 'Optimize margin', 'NO_ACTION'),
  ('HEALTHY', 'any', 'Optimize margin', 'NO_ACTION'), ('OVERSTOCKED', 'high', 'Markdown candidate', 'STOP_OR_DELAY_ORDER'),
  ('OVERSTOCKED', 'low', 'Hold/Test', 'INTER_REGION_TRANSFER'), ('STOCKOUT_RISK', 'any', 'Hold or small increase', 'REPLENISH'),
  ('STOCKOUT', 'any', 'Hold', 'EXPEDITE_ORDER'), ('UNDERSTOCKED', 'any', 'Hold or small increase', 'REPLENISH'),
  ('SLOW_MOVING', 'high', 'Markdown candidate', 'STOP_OR_DELAY_ORDER'), ('SLOW_MOVING', 'low', 'Hold', 'INTER_REGION_TRANSFER'),
  ('OBSOLETE_RISK', 'high', 'Clearance markdown', 'STOP_OR_DELAY_ORDER'), ('OBSOLETE_RISK', 'low', 'Manual review', 'LIQUIDATION_REVIEW'))
  a(status, bucket, pricing, stock) ON a.status = j.inventory_status AND a.bucket = j.bucket
LEFT JOIN (VALUES ('HEALTHY', 'Optimize margin', 'NO_ACTION'), ('STOCKOUT_RISK', 'Hold or small increase', 'REPLENISH'),
  ('STOCKOUT', 'Hold', 'EXPEDITE_ORDER'), ('UNDERSTOCKED', 'Hold or small increase', 'REPLENISH'))
  b(status, pricing, stock) ON b.status = j.inventory_status
""", "joint_out")
# ------------------------------------------------------------ 2.11 backtest
_BT = ("sku_id, region, customer_tier, week_num, realized_price, unit_cost, units_sold, revenue, cogs, gross_profit, "
       "gross_margin_pct, weeks_of_cover, stockout_flag, excess_inventory_flag, ending_inventory, lost_sales_estimate, "
       "competitor_price")
cte("bt_test", ("panel",), f"SELECT {_BT} FROM panel WHERE week_num >= 92")
cte("bt_s_current", ("bt_test",), "SELECT * FROM bt_test")
cte("bt_s_cost_plus", ("bt_test",), """
SELECT * REPLACE (CASE WHEN revenue > 0 THEN gross_profit / revenue ELSE 0.0 END AS gross_margin_pct) FROM (
  SELECT * REPLACE (revenue - cogs AS gross_profit) FROM (
    SELECT * REPLACE (unit_cost / 0.7 AS realized_price, unit_cost / 0.7 * units_sold * 0.95 AS revenue) FROM bt_test))
""")
cte("bt_s_competitor_match", ("bt_test",), """
SELECT * REPLACE (CASE WHEN revenue > 0 THEN gross_profit / revenue ELSE 0.0 END AS gross_margin_pct) FROM (
  SELECT * REPLACE (revenue - cogs AS gross_profit) FROM (
    SELECT * REPLACE (realized_price * units_sold AS revenue, unit_cost * units_sold AS cogs) FROM (
      SELECT * REPLACE (competitor_price AS realized_price,
                        units_sold * pow(competitor_price / greatest(realized_price, 0.01), -1.2) AS units_sold)
      FROM bt_test)))
""")
PRICING_ONLY = """
SELECT * EXCLUDE (recommended_price, predicted_recommended_units, predicted_current_units, has, chg)
  REPLACE (CASE WHEN has THEN CASE WHEN revenue > 0 THEN gross_profit / revenue ELSE 0.0 END ELSE gross_margin_pct END
           AS gross_margin_pct) FROM (
SELECT * REPLACE (CASE WHEN has THEN revenue - cogs ELSE gross_profit END AS gross_profit) FROM (
SELECT * REPLACE (CASE WHEN has THEN realized_price * units_sold ELSE revenue END AS revenue,
                  CASE WHEN has THEN unit_cost * units_sold ELSE cogs END AS cogs) FROM (
SELECT * REPLACE (CASE WHEN has THEN recommended_price ELSE realized_price END AS realized_price,
                  CASE WHEN has THEN units_sold * chg ELSE units_sold END AS units_sold) FROM (
SELECT t.*, r.recommended_price, r.predicted_recommended_units, r.predicted_current_units,
       r.recommended_price IS NOT NULL AS has,
       CASE WHEN r.predicted_current_units > 0 THEN r.predicted_recommended_units / greatest(r.predicted_current_units, 0.01)
            ELSE 1.0 END AS chg
FROM {src} t LEFT JOIN (SELECT DISTINCT sku_id, region, customer_tier, recommended_price, predicted_recommended_units,
                                        predicted_current_units FROM joint_out) r
  USING (sku_id, region, customer_tier)))))
"""
INVENTORY_ONLY = """
SELECT * EXCLUDE (ia, iq) REPLACE (revenue - cogs AS gross_profit) FROM (
SELECT * REPLACE (realized_price * units_sold AS revenue, unit_cost * units_sold AS cogs) FROM (
SELECT * REPLACE (CASE WHEN ia IN ('REPLENISH', 'EXPEDITE_ORDER') THEN ending_inventory + coalesce(iq, 0.0) * 0.1
                       WHEN ia = 'STOP_OR_DELAY_ORDER' THEN ending_inventory * 0.98 ELSE ending_inventory END AS ending_inventory,
                  CASE WHEN ia IN ('REPLENISH', 'EXPEDITE_ORDER') THEN units_sold * 1.02 ELSE units_sold END AS units_sold) FROM (
SELECT t.*, f.ia, f.iq FROM {src} t LEFT JOIN (
  SELECT sku_id, region, arg_min(inventory_action, customer_tier) AS ia, arg_min(recommended_order_quantity, customer_tier) AS iq
  FROM joint_out GROUP BY sku_id, region) f USING (sku_id, region))))
"""
cte("bt_s_pricing_only", ("bt_test", "joint_out"), PRICING_ONLY.format(src="bt_test"))
cte("bt_s_inventory_only", ("bt_test", "joint_out"), INVENTORY_ONLY.format(src="bt_test"))
cte("bt_s_joint", ("bt_s_pricing_only", "transfers", "joint_out"), """
SELECT * EXCLUDE (o, i) REPLACE (CASE WHEN o > 0 THEN greatest(0.0, ending_inventory - o) ELSE ending_inventory END
                                 + coalesce(i, 0.0) AS ending_inventory) FROM (
SELECT t.*, d.o, d.i FROM (""" + INVENTORY_ONLY.format(src="bt_s_pricing_only") + """) t LEFT JOIN (
  SELECT sku_id, region, sum(o) AS o, sum(i) AS i FROM (
    SELECT sku_id, source_region AS region, transfer_quantity * 0.05 AS o, 0.0 AS i FROM transfers UNION ALL
    SELECT sku_id, destination_region AS region, 0.0 AS o, transfer_quantity * 0.05 AS i FROM transfers)
  GROUP BY sku_id, region) d USING (sku_id, region))
""")
CMP = """sum(revenue) AS total_revenue, sum(gross_profit) AS total_gross_profit, """ + R("sum(gross_margin_pct)", 4) + """ / count(gross_margin_pct) AS avg_gross_margin,
  sum(units_sold) AS total_units, """ + R("sum(weeks_of_cover)", 2) + """ / count(weeks_of_cover) AS avg_weeks_of_cover,
  avg(CASE WHEN stockout_flag THEN 1.0 ELSE 0.0 END) AS stockout_rate,
  sum(CASE WHEN excess_inventory_flag THEN ending_inventory * unit_cost ELSE 0.0 END) AS excess_inventory_value,
  sum(lost_sales_estimate) AS lost_sales_estimate"""
_CMP_COLS = ["total_revenue", "total_gross_profit", "avg_gross_margin", "total_units", "avg_weeks_of_cover",
             "stockout_rate", "excess_inventory_value", "lost_sales_estimate"]
R4S = ", ".join(f"{R(c, 4)} AS {c}" for c in _CMP_COLS)
_STRATS = {"current": "Current Pricing", "pricing_only": "Pricing-Only Optimization",
           "inventory_only": "Inventory-Only Policy", "joint": "Joint Pricing + Inventory",
           "cost_plus": "Cost-Plus Pricing", "competitor_match": "Competitor Match"}
for _k in _STRATS:
    q("bt_" + _k, f"SELECT 'bt_{_k}' AS strategy, {R4S} FROM (SELECT {CMP} FROM bt_s_{_k})", f"bt_s_{_k}")
cte("bt_cmp", tuple(f"bt_s_{k}" for k in _STRATS), " UNION ALL ".join(
    f"SELECT '{v}' AS strategy, {CMP} FROM bt_s_{k}" for k, v in _STRATS.items()))
q("bt_compare", f"SELECT strategy, {R4S} FROM bt_cmp", "bt_cmp")
q("bt_lift", f"""
SELECT strategy, {R6("CASE WHEN strategy IN ('Joint Pricing + Inventory', 'Pricing-Only Optimization') THEN coalesce((total_gross_profit - b) / abs(b), 0.0) ELSE 0.0 END")}
  AS modeled_lift_vs_current
FROM bt_cmp, (SELECT total_gross_profit AS b FROM bt_cmp WHERE strategy = 'Current Pricing')
""", "bt_cmp")
q("bt_coverage_rates", f"""
SELECT {R6('recs / greatest(groups, 1)')} AS rec_coverage, {R6('approval_rate')} AS approval_rate,
       {R6('guardrail_rate')} AS guardrail_rate, markdown_count, replenish_count, stop_order_count, manual_review_count,
       transfer_count
FROM (SELECT count(*) AS recs,
             avg(CASE WHEN pricing_action IN ('Increase', 'Decrease') THEN 1.0 ELSE 0.0 END) AS approval_rate,
             avg(CASE WHEN length(coalesce(guardrail_triggered, '')) > 0 THEN 1.0 ELSE 0.0 END) AS guardrail_rate,
             count(*) FILTER (WHERE inventory_action = 'PRICE_MARKDOWN') AS markdown_count,
             count(*) FILTER (WHERE inventory_action IN ('REPLENISH', 'EXPEDITE_ORDER')) AS replenish_count,
             count(*) FILTER (WHERE inventory_action = 'STOP_OR_DELAY_ORDER') AS stop_order_count,
             count(*) FILTER (WHERE manual_review_required) AS manual_review_count FROM joint_out),
     (SELECT count(*) AS groups FROM (SELECT DISTINCT sku_id, region, customer_tier FROM bt_test)),
     (SELECT count(*) AS transfer_count FROM transfers)
""", "joint_out", "bt_test", "transfers")
q("rollback_prices", f"""SELECT {S3}, current_price, {R6('recommended_price')} AS recommended_price,
  {R6('recommended_price')} AS approved_price, {R6('current_price * 0.5 + recommended_price * 0.5')} AS rollback_price,
  {R6('gross_profit_lift * 0.5')} AS gp_retained, {R6('(projected_revenue - current_revenue) * 0.5')} AS revenue_retained
FROM joint_out""", "joint_out")
q("rollback_transfers", f"""SELECT share, sku_id, source_region, destination_region, transfer_quantity,
  {R6('transfer_quantity * (1 - share)')} AS approved_quantity, {R6('transfer_quantity * (1 - share)')} AS rollback_quantity,
  share = 1 AS cancelled FROM transfers, (SELECT unnest([0.0::DOUBLE, 0.5::DOUBLE, 1.0::DOUBLE]) AS share)""", "transfers")
q("rollback_replenishment", f"""SELECT {S3}, recommended_order_quantity,
  coalesce(recommended_order_quantity, 0.0) * 0.5 AS approved_order_qty, false AS cancelled_replenishment
FROM joint_out""", "joint_out")
q("rollback_audit", f"""SELECT sku_id, current_price, {R6('recommended_price')} AS recommended_price,
  {R6('recommended_price')} AS approved_price, {R6('current_price * 0.5 + recommended_price * 0.5')} AS rollback_price,
  policy_version, pricing_action AS old_action, pricing_reason_code AS reason_code, inventory_action,
  pricing_action AS recommended_action, pricing_action AS approved_action, pricing_action AS rollback_action,
  'Pending' AS approval_status, '' AS approver, true AS rollback_flag, 'Pricing 50%, Transfer 0%' AS rollback_reason,
  '2024-01-01' AS effective_date, '2024-01-01' AS rollback_date
FROM joint_out""", "joint_out")
q("rollback_summary", f"""
SELECT {R('sum(gross_profit_lift) * (1 - share)', 2)} AS gross_profit_lift_retained,
       {R('sum(projected_revenue - current_revenue) * (1 - share)', 2)} AS revenue_retained,
       count(*) FILTER (WHERE share = 1) AS reverted_sku_count,
       count(*) FILTER (WHERE share = 1 AND coalesce(recommended_order_quantity, 0.0) > 0) AS cancelled_replenishments,
       count(*) AS total_skus, {R('sum(excess_inventory_value) * (1 - share) * 0.01', 2)} AS inventory_value_impact_retained,
       CASE WHEN share = 1 THEN (SELECT count(*) FROM transfers) ELSE 0 END AS cancelled_transfers, 1 - share AS unit_recovery_pct, share
FROM joint_out, (SELECT unnest([0.0::DOUBLE, 0.5::DOUBLE, 1.0::DOUBLE]) AS share) GROUP BY share""", "joint_out", "transfers")
q("rollback_verify", """
SELECT (SELECT count(*) FROM joint_out WHERE abs(current_price * 0.0 + recommended_price * 1.0 - recommended_price)
          > 0.001 * abs(recommended_price) + 1e-8) AS price_violations_at_0,
       (SELECT count(*) FROM joint_out WHERE abs(current_price * 1.0 + recommended_price * 0.0 - current_price)
          > 0.001 * abs(current_price) + 1e-8) AS price_violations_at_1,
       (SELECT count(*) FROM transfers WHERE transfer_quantity * 0.0 <> 0) AS transfer_violations_at_1
""", "joint_out", "transfers")

# ------------------------------------------------------------ 2.12 reports
def R4(x):
    return R(x, 4)


EXC = "('OVERSTOCKED', 'SLOW_MOVING', 'OBSOLETE_RISK')"
SHORT = "('STOCKOUT', 'STOCKOUT_RISK', 'UNDERSTOCKED')"
cte("inv_sum", ("inv_status",), f"""
SELECT sum(on_hand_inventory * unit_cost) AS total_inventory_value,
       sum(CASE WHEN inventory_status IN {EXC} THEN excess_inventory_value ELSE 0.0 END) AS excess_inventory_value,
       count(*) FILTER (WHERE inventory_status IN {SHORT}) AS stockout_risk_skus,
       count(*) FILTER (WHERE inventory_status = 'SLOW_MOVING') AS slow_moving_skus,
       """ + R("sum(available_weeks_of_cover)", 2) + """ / count(available_weeks_of_cover) AS avg_weeks_of_cover, sum(lost_sales_estimate) AS estimated_lost_sales
FROM inv_status""")
q("inv_summary", f"""SELECT {R4('total_inventory_value')} AS total_inventory_value, {R4('excess_inventory_value')} AS excess_inventory_value,
  stockout_risk_skus, slow_moving_skus, {R4('avg_weeks_of_cover')} AS avg_weeks_of_cover,
  {R4('estimated_lost_sales')} AS estimated_lost_sales FROM inv_sum""", "inv_sum")
cte("inv_turns", ("inv_status", "panel"), """
SELECT *, CASE WHEN inventory_value > 0 THEN annual_cogs / inventory_value ELSE 0.0 END AS portfolio_turns FROM (
  SELECT sum(c.annual_cogs) AS annual_cogs, sum(i.on_hand_inventory * i.unit_cost) AS inventory_value,
         """ + R("sum(i.inventory_turns)", 3) + """ / count(i.inventory_turns) AS mean_turns
  FROM inv_status i LEFT JOIN (SELECT sku_id, region, sum(unit_cost * units_sold) AS annual_cogs FROM panel GROUP BY ALL) c
    USING (sku_id, region))""")
q("inv_portfolio_turns", f"""SELECT {R('annual_cogs', 2)} AS annual_cogs, {R6('inventory_value')} AS inventory_value,
  {R6('mean_turns')} AS mean_turns, {R6('portfolio_turns')} AS portfolio_turns FROM inv_turns""", "inv_turns")
q("inv_status_distribution", "SELECT inventory_status, count(*) AS count FROM inv_status GROUP BY ALL", "inv_status")
q("inv_excess_by_category", f"""SELECT category, {R4('sum(excess_inventory_value)')} AS excess_inventory_value
FROM inv_status WHERE inventory_status IN {EXC} GROUP BY category""", "inv_status")
q("policy_filter", f"""SELECT {S3}, {R6('elasticity_confidence')} AS elasticity_confidence, {R6('gross_margin_pct')} AS gross_margin_pct,
  {R6('price_change_pct')} AS price_change_pct, {R6('gross_profit_lift')} AS gross_profit_lift
FROM joint_out WHERE (elasticity_confidence IS NULL OR elasticity_confidence >= 0.4)
  AND (gross_margin_pct IS NULL OR gross_margin_pct >= 0.15)
  AND (price_change_pct IS NULL OR abs(price_change_pct) <= 0.10 + 1e-9)""", "joint_out")
q("slice_filter", f"""SELECT {S3}, category, recommendation_action FROM joint_out
WHERE region = 'EUROPE' AND category IN ('PROMO', 'LARGE')""", "joint_out")
q("kpi_headline", f"""
SELECT {R4('total_revenue')} AS total_revenue, {R4('gross_margin_value')} AS gross_margin_value,
       {R4('margin_opportunity')} AS margin_opportunity, pricing_opportunities, high_risk_rows, awaiting_review,
       {R4('s.total_inventory_value')} AS total_inventory_value, {R4('s.excess_inventory_value')} AS excess_inventory_value,
       {R4('t.portfolio_turns')} AS inventory_turnover, {R4('so.stockout_rate')} AS stockout_rate,
       {R4('CASE WHEN total_revenue <> 0 THEN gross_margin_value / total_revenue ELSE 0.0 END')} AS gross_margin_pct
FROM (SELECT sum(current_revenue) AS total_revenue, sum(current_gross_profit) AS gross_margin_value,
             sum(gross_profit_lift) AS margin_opportunity,
             count(*) FILTER (WHERE recommendation_action IN ('Increase', 'Decrease')) AS pricing_opportunities,
             count(*) FILTER (WHERE inventory_status IN ('STOCKOUT', 'STOCKOUT_RISK')) AS high_risk_rows,
             count(*) FILTER (WHERE manual_review_required) AS awaiting_review FROM joint_out),
     inv_sum s, inv_turns t,
     (SELECT avg(CASE WHEN inventory_status IN ('STOCKOUT', 'STOCKOUT_RISK') THEN 1.0 ELSE 0.0 END) AS stockout_rate
      FROM inv_status) so""", "joint_out", "inv_sum", "inv_turns", "inv_status")
q("lift_by_category", f"SELECT category, {R4('sum(gross_profit_lift)')} AS gross_profit_lift FROM joint_out GROUP BY ALL",
  "joint_out")
q("lift_by_region", f"SELECT region, {R4('sum(gross_profit_lift)')} AS gross_profit_lift FROM joint_out GROUP BY ALL",
  "joint_out")
q("action_mix", """SELECT recommendation_action AS action, count(*) AS count, 'pricing' AS kind FROM joint_out GROUP BY 1
UNION ALL SELECT inventory_action AS action, count(*) AS count, 'inventory' AS kind FROM joint_out GROUP BY 1""",
  "joint_out")
q("top_opportunities", f"""SELECT {S3}, category, {R6('gross_profit_lift')} AS gross_profit_lift, recommendation_action
FROM joint_out ORDER BY gross_profit_lift DESC, sku_id, region, customer_tier LIMIT 10""", "joint_out")
q("pricing_kpis", f"""SELECT count(*) FILTER (WHERE mv) AS pricing_opportunities,
  {R6('coalesce(' + R('sum(CASE WHEN mv THEN price_change_pct END)', 4) + ' / count(CASE WHEN mv THEN price_change_pct END), 0.0)')} AS avg_recommended_move,
  {R6('sum(gross_profit_lift)')} AS modeled_margin_lift,
  {R6("avg(CASE WHEN joint_confidence = 'HIGH' THEN 1.0 ELSE 0.0 END)")} AS high_confidence_share
FROM (SELECT *, recommendation_action IN ('Increase', 'Decrease') AS mv FROM joint_out)""", "joint_out")
q("top_movers_long", f"""
SELECT {S3}, type, {R6('price')} AS price FROM (
  SELECT * FROM joint_out WHERE recommendation_action IN ('Increase', 'Decrease')
  ORDER BY abs(gross_profit_lift) DESC, sku_id, region, customer_tier LIMIT 15)
UNPIVOT (price FOR type IN (current_price, recommended_price))""", "joint_out")


def hist_sql(src: str, col: str, bins: int) -> str:
    return f"""
SELECT bin, {R6(f'lo + bin * (hi - lo) / {bins}')} AS bin_start, count(*) AS count FROM (
  SELECT CAST(CASE WHEN hi > lo THEN least(floor(({col} - lo) / ((hi - lo) / {bins})), {bins - 1}) ELSE 0 END AS INTEGER) AS bin,
         lo, hi
  FROM {src}, (SELECT min({col}) AS lo, max({col}) AS hi FROM {src}))
GROUP BY bin, lo, hi"""


q("price_change_histogram", hist_sql("joint_out", "price_change_pct", 40), "joint_out")
q("woc_histogram", hist_sql("inv_status", "available_weeks_of_cover", 30), "inv_status")
q("competitor_index_by_category", f"""SELECT category, {R6(R('sum(competitor_price_index)', 4) + ' / count(competitor_price_index)')} AS competitor_price_index
FROM panel GROUP BY ALL""", "panel")
q("unit_impact", f"""SELECT {S3}, recommendation_action,
  {R6('predicted_recommended_units - predicted_current_units')} AS unit_impact, {R6('gross_profit_lift')} AS gross_profit_lift
FROM joint_out""", "joint_out")
q("high_confidence_top50", f"""SELECT {S3}, category, {R6('current_price')} AS current_price,
  {R6('recommended_price')} AS recommended_price, {R6('price_change_pct')} AS price_change_pct,
  {R6('gross_profit_lift')} AS gross_profit_lift, {R6('gross_margin_pct')} AS gross_margin_pct, reason_code
FROM joint_out WHERE joint_confidence = 'HIGH' AND recommendation_action IN ('Increase', 'Decrease')
ORDER BY gross_profit_lift DESC, sku_id, region, customer_tier LIMIT 50""", "joint_out")
_REG = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
q("stockout_heatmap", "SELECT category, " + ", ".join(
    f"{R6(f'avg(CASE WHEN region = {chr(39)}{r}{chr(39)} THEN at_risk END)')} AS \"{r}\"" for r in _REG) + """
FROM (SELECT DISTINCT sku_id, region, category, CASE WHEN inventory_status IN ('STOCKOUT', 'STOCKOUT_RISK')
      THEN 1.0 ELSE 0.0 END AS at_risk FROM joint_out) GROUP BY category""", "joint_out")
q("top_transfers", """SELECT sku_id, category, source_region, destination_region, transfer_quantity, net_transfer_value,
  transfer_reason FROM transfers ORDER BY net_transfer_value DESC, sku_id, source_region, destination_region LIMIT 50""",
  "transfers")
q("aged_inventory_top50", f"""SELECT {S3}, category, inventory_status, excess_inventory_value, available_weeks_of_cover,
  obsolescence_risk_score FROM joint_out WHERE inventory_status IN ('SLOW_MOVING', 'OBSOLETE_RISK')
ORDER BY excess_inventory_value DESC, sku_id, region, customer_tier LIMIT 50""", "joint_out")
q("sku_profile", f"""SELECT {S3}, p.product_name, j.category, p.subcategory, p.brand_tier, p.lead_time_days,
  p.lifecycle_stage, {R6('j.current_price')} AS current_price, {R6('j.recommended_price')} AS recommended_price,
  j.recommendation_action, {R6('j.predicted_current_units')} AS predicted_current_units,
  {R6('j.available_weeks_of_cover')} AS available_weeks_of_cover, {R6('j.stockout_probability')} AS stockout_probability,
  j.pricing_reason_code, {R6('j.elasticity')} AS elasticity, {R6('j.elasticity_confidence')} AS elasticity_confidence,
  coalesce(nullif(j.guardrail_triggered, ''), 'None') AS guardrail
FROM joint_out j LEFT JOIN products p USING (sku_id) WHERE sku_id = 'Brand#1|PROMO'""", "joint_out", "products")
cte("decision_log", ("joint_out",), """
SELECT sku_id, 'Reject' AS decision, CAST(NULL AS DOUBLE) AS override_price,
       concat_ws(' ', 'first pass', region, customer_tier) AS note, CAST(1 AS BIGINT) AS logged_at
FROM joint_out WHERE manual_review_required OR recommendation_action IN ('Increase', 'Decrease')
UNION ALL
SELECT sku_id, CASE WHEN price_change_pct > 0.05 THEN 'Override' ELSE 'Approve' END,
       CASE WHEN price_change_pct > 0.05 THEN current_price END, concat_ws(' ', 'review', region, customer_tier),
       1 + row_number() OVER (PARTITION BY sku_id ORDER BY region, customer_tier)
FROM joint_out WHERE (manual_review_required OR recommendation_action IN ('Increase', 'Decrease')) AND gross_profit_lift > 0
""")
cte("review_q", ("joint_out",), """
SELECT * FROM joint_out
WHERE recommendation_action IN ('Increase', 'Decrease', 'Test')
   OR inventory_action IN ('EXPEDITE_ORDER', 'REPLENISH', 'INTER_REGION_TRANSFER', 'STOP_OR_DELAY_ORDER')
ORDER BY gross_profit_lift DESC, sku_id, region, customer_tier LIMIT 200""")
q("queue_kpis", f"""SELECT items_in_queue, {R4('modeled_gp_lift')} AS modeled_gp_lift, decisions_logged, awaiting_review
FROM (SELECT count(*) AS items_in_queue, sum(gross_profit_lift) AS modeled_gp_lift FROM review_q),
     (SELECT count(DISTINCT sku_id) AS decisions_logged FROM decision_log),
     (SELECT count(*) FILTER (WHERE manual_review_required) AS awaiting_review FROM joint_out)""",
  "review_q", "decision_log", "joint_out")
q("margin_summary", f"""SELECT {R4('avg(gross_margin_pct)')} AS avg_gross_margin,
  {R4('sum(projected_gross_profit)')} AS total_projected_gross_profit, count(*) AS recommendations FROM joint_out""",
  "joint_out")
q("replenish_summary", f"""SELECT count(*) AS replenish_skus, {R4('coalesce(sum(recommended_order_quantity), 0.0)')}
  AS total_order_quantity FROM joint_out WHERE inventory_action IN ('REPLENISH', 'EXPEDITE_ORDER')""", "joint_out")
q("action_counts", """SELECT count(*) FILTER (WHERE inventory_action = 'STOP_OR_DELAY_ORDER') AS stop_order_count,
  count(*) FILTER (WHERE inventory_action = 'PRICE_MARKDOWN') AS markdown_count FROM joint_out""", "joint_out")
q("conflict_count", """SELECT count(*) FILTER (WHERE pricing_action = 'Decrease' AND inventory_action IN
  ('REPLENISH', 'EXPEDITE_ORDER', 'INTER_REGION_TRANSFER')) AS conflicts FROM joint_out""", "joint_out")
q("woc_and_status_top5", f"""SELECT inventory_status, count, {R6('w')} AS avg_weeks_of_cover FROM (
  SELECT inventory_status, count(*) AS count FROM inv_status GROUP BY ALL ORDER BY count DESC, inventory_status LIMIT 5),
  (SELECT {R('sum(available_weeks_of_cover)', 2)} / count(available_weeks_of_cover) AS w FROM inv_status)""", "inv_status")
q("lost_sales_total", f"SELECT {R4('sum(lost_sales_estimate)')} AS lost_sales_total FROM joint_out", "joint_out")
q("excess_by_category_all", f"""SELECT category, {R4('sum(excess_inventory_value)')} AS excess_inventory_value FROM joint_out GROUP BY category""",
  "joint_out")
q("obsolescence_high", "SELECT count(*) FILTER (WHERE obsolescence_risk_score > 0.65) AS high_obsolescence FROM joint_out",
  "joint_out")
cte("latest_sku", ("panel",), """
SELECT * FROM panel QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY week_num DESC, region DESC, customer_tier DESC) = 1""")
q("sku_excess_latest", """SELECT category, count(*) AS excess_skus FROM latest_sku,
  (SELECT count(*) FILTER (WHERE excess_inventory_flag) AS n FROM latest_sku) c
WHERE CASE WHEN c.n > 0 THEN excess_inventory_flag ELSE weeks_of_cover > 16 END GROUP BY category""", "latest_sku")
q("sku_stockout_latest", """SELECT sku_id, category, region, customer_tier, week_num, weeks_of_cover FROM latest_sku,
  (SELECT count(*) FILTER (WHERE stockout_flag) AS n FROM latest_sku) c
WHERE CASE WHEN c.n > 0 THEN stockout_flag ELSE weeks_of_cover < 2 END""", "latest_sku")
q("elasticity_low_conf", """SELECT elasticity_segment, estimated_elasticity, confidence_score, low_confidence_count, total_count
FROM (SELECT count(*) FILTER (WHERE elasticity_class = 'Low confidence') AS low_confidence_count, count(*) AS total_count FROM elasticity)
LEFT JOIN (SELECT * FROM elasticity WHERE elasticity_class = 'Low confidence' ORDER BY elasticity_segment LIMIT 5) ON true""", "elasticity")
q("guardrail_summary", """SELECT count(*) FILTER (WHERE recommendation_action = 'Manual Review') AS manual_review,
  count(*) FILTER (WHERE length(guardrail_triggered) > 0) AS guarded FROM joint_out""", "joint_out")
q("rollback_retained", f"""SELECT {R4('t * 0.5')} AS retained_transfers, t AS total_transfers, {R4('g')} AS retained_gp_lift
FROM (SELECT count(*) AS t FROM transfers), (SELECT sum(modeled_gp_lift) * 0.5 AS g FROM joint_out)""",
  "transfers", "joint_out")
q("minmax_normalize", f"""SELECT {S3}, {R6('gross_profit_lift')} AS gross_profit_lift,
  {R6('CASE WHEN mx = mn THEN 0.5 ELSE (gross_profit_lift - mn) / (mx - mn) END')} AS gross_profit_lift_normalized
FROM joint_out, (SELECT min(gross_profit_lift) AS mn, max(gross_profit_lift) AS mx FROM joint_out)""", "joint_out")
q("safe_divide", f"""SELECT {S3}, {R6('CASE WHEN projected_revenue = 0 OR projected_revenue IS NULL THEN 0.0 ELSE projected_gross_profit / projected_revenue END')}
  AS projected_margin FROM joint_out""", "joint_out")
q("format_labels", f"""SELECT {S3},
  CASE WHEN gross_profit_lift IS NULL OR isnan(gross_profit_lift) THEN 'N/A'
       ELSE '$' || format('{{:,}}', CAST(floor(gross_profit_lift + 0.5) AS BIGINT)) END AS lift_label,
  CASE WHEN gross_margin_pct IS NULL OR isnan(gross_margin_pct) THEN 'N/A'
       ELSE printf('%.1f', floor(gross_margin_pct * 1000 + 0.5) / 10.0) || '%' END AS margin_label
FROM joint_out""", "joint_out")
q("review_queue", f"""SELECT {S3}, category, {R6('current_price')} AS current_price,
  {R6('recommended_price')} AS recommended_price, {R6('price_change_pct')} AS price_change_pct, recommendation_action,
  inventory_action, joint_confidence, reason_code, coalesce(d.decision, '—') AS decision
FROM review_q LEFT JOIN (SELECT sku_id, arg_max_null(decision, struct_pack(t := logged_at, n := note)) AS decision FROM decision_log GROUP BY sku_id) d
  USING (sku_id)""", "review_q", "decision_log")

# ------------------------------------------------------------ 2.1 sources and sinks
q("read_products", "SELECT * FROM products", "products")
q("read_sales", "SELECT * REPLACE (CAST(week_start AS VARCHAR) AS week_start) FROM panel", "panel")
q("read_first_available", "SELECT * REPLACE (CAST(week_start AS VARCHAR) AS week_start) FROM panel", "panel")
q("write_decisions", """
SELECT 'recommendations' AS "table", count(*) AS rows FROM joint_out
UNION ALL SELECT 'transfers', count(*) FROM transfers HAVING count(*) > 0
UNION ALL SELECT 'inventory_metrics', count(*) FROM replen
UNION ALL SELECT 'elasticity_estimates', count(*) FROM elasticity
UNION ALL SELECT 'backtest_results', count(*) FROM bt_cmp""", "joint_out", "transfers", "replen", "elasticity", "bt_cmp")
q("read_decisions", "SELECT * REPLACE (" + ", ".join(f"{R6(c)} AS {c}" for c in _JF) + ") FROM joint_out", "joint_out")
q("decision_log", f"""SELECT {S3}, recommendation_action, coalesce(d.decision, '—') AS decision,
  {R6('d.override_price')} AS override_price, d.note
FROM joint_out LEFT JOIN (SELECT sku_id, arg_max_null(decision, struct_pack(t := logged_at, n := note)) AS decision,
                                 arg_max_null(override_price, struct_pack(t := logged_at, n := note)) AS override_price,
                                 arg_max_null(note, struct_pack(t := logged_at, n := note)) AS note
                          FROM decision_log GROUP BY sku_id) d USING (sku_id)""", "joint_out", "decision_log")

# ------------------------------------------------------------ 2.10 scenario_run: one renamed CTE chain per preset
import re  # noqa: E402

from shelfwise.plans.oracle_sql import CTES  # noqa: E402

SCEN_CHAIN = ["best", "g1", "g2", "g3", "g4", "g5", "g6", "g7", "recs_raw", "recommendations", "inventory_metrics",
              "inv_status", "replen", "tr_pairs", "tr_walk", "transfers", "tr_flag", "joint_base", "joint", "joint_out"]
# fixed values: scenario presets (max move, objective, service z, minimum transfer value, target cover)
SCENARIO_PARAMS = {
    "Conservative": (0.05, "balanced", 1.96, 100.0, 10),
    "Recommended": (0.10, "balanced", 1.65, 50.0, 8),
    "Margin Push": (0.10, "maximize_gross_profit", 1.65, 75.0, 8),
    "Inventory Clearance": (0.15, "reduce_excess_inventory", 1.28, 30.0, 6),
}


def _sub(body: str, old: str, new: str) -> str:
    assert old in body, old
    return body.replace(old, new)


def register_scenario(suffix: str, mm: float, obj: str, z: float, minv: float, target: float) -> str:
    rename = {n: f"{n}_{suffix}" for n in SCEN_CHAIN}
    pat = re.compile(r"\b(" + "|".join(SCEN_CHAIN) + r")\b")
    for n in SCEN_CHAIN:
        body, deps = CTES[n]
        if n == "g1":
            body = _sub(body, "ELSE 0.1 END AS mm0", f"ELSE {mm} END AS mm0")
        elif n == "best":
            body = _sub(body, "FROM sims_balanced WHERE", f"FROM sims_{obj} WHERE")
            deps = tuple(f"sims_{obj}" if d == "sims_balanced" else d for d in deps)
        elif n == "inventory_metrics":
            body = inventory_metrics_sql(z, target)
        elif n == "inv_status":
            body = f"SELECT *, {status_sql(target)} AS inventory_status FROM inventory_metrics"
        elif n == "replen":
            body = _sub(body, "1.65 * coalesce(demand_std", f"{z} * coalesce(demand_std")
        elif n == "tr_walk":
            body = walk_sql(minv)
        elif n == "transfers":
            body = _sub(body, "> 8.0 THEN 'SLOW_MOVING'", f"> {float(target)} THEN 'SLOW_MOVING'")
        body = pat.sub(lambda m: rename[m.group(1)], body)
        cte(rename[n], tuple(rename.get(d, d) for d in deps), body)
        if n == "tr_walk":
            RECURSIVE.add(rename[n])
    return rename["joint_out"]


_SCEN_OUT = {name: register_scenario(f"sc{i}", *prm) for i, (name, prm) in enumerate(SCENARIO_PARAMS.items())}
q("scenario_run", " UNION ALL ".join(f"""
SELECT '{name}' AS scenario, {S3}, pricing_action, inventory_action, inventory_status, manual_review_required,
       {R6('current_price')} AS current_price, {R6('recommended_price')} AS recommended_price, {R6('gross_profit_lift')} AS gross_profit_lift
FROM {out}""" for name, out in _SCEN_OUT.items()), *_SCEN_OUT.values())


# ------------------------------------------------------------ 2.3 / 2.4 model matrix, scaling, ridge
NUMERIC = ["lag_1_units", "lag_2_units", "lag_4_units", "lag_13_units", "rolling_4_units", "rolling_8_units", "rolling_13_units",
           "rolling_4_revenue", "rolling_13_margin", "prior_week_inventory", "price_change_pct", "price_index_vs_competitor",
           "tier_discount_pct", "promotion_flag", "seasonality_index", "week_of_year", "month", "lead_time_days", "weeks_of_cover",
           "realized_price", "unit_cost", "competitor_price_index", "economic_demand_index"]
CATEGORICAL = ["category", "region", "customer_tier", "lifecycle_stage"]
cte("levels", ("split_features",), "SELECT " + ", ".join(f"list_sort(list(DISTINCT {c}))[2:] AS l_{c}" for c in CATEGORICAL)
    + " FROM split_features WHERE split = 'train'")
cte("matrix", ("split_features", "levels"), f"""
SELECT {K}, split, adjusted_units AS label, [{', '.join(f'coalesce(CAST({c} AS DOUBLE), 0.0)' for c in NUMERIC)}] AS numbers,
       {', '.join(f'[CASE WHEN l = {c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FOR l IN l_{c}] AS s_{c}' for c in CATEGORICAL)}
FROM split_features, levels""")
SLOTS = " || ".join(f"s_{c}" for c in CATEGORICAL)
q("model_matrix", f"""
SELECT {K}, split, label, CAST(len(numbers) + len({SLOTS}) AS INTEGER) AS n_features,
       {', '.join(f'{R6(f"numbers[{i + 1}]")} AS x_{c}' for i, c in enumerate(NUMERIC))},
       array_to_string([CAST(CAST(v AS INTEGER) AS VARCHAR) FOR v IN {SLOTS}], '') AS onehot
FROM matrix""", "matrix")

cte("matrix_rows", ("matrix",), f"SELECT {K}, split, label, numbers || {SLOTS} AS x, [len(s_category), len(s_region), len(s_customer_tier), len(s_lifecycle_stage)] AS sizes FROM matrix")
cte("spread", ("matrix_rows",), """
SELECT list(m ORDER BY i) AS m, list(CASE WHEN s > 1e-12 * greatest(1.0, abs(m)) THEN s ELSE 0.0 END ORDER BY i) AS s FROM (
  SELECT i, avg(v) AS m, stddev_pop(v) AS s FROM (SELECT unnest(x) AS v, generate_subscripts(x, 1) AS i FROM matrix_rows WHERE split = 'train') GROUP BY i)""")
cte("scaled", ("matrix_rows", "spread"), f"""
SELECT {K}, split, label, sizes, [CASE WHEN s[i] > 0 THEN (x[i] - m[i]) / s[i] ELSE 0.0 END FOR i IN range(1, len(x) + 1)] AS z FROM matrix_rows, spread""")
_AFTER = [f"{len(NUMERIC)} + " + " + ".join(["0", *(f"sizes[{j + 1}]" for j in range(k))]) for k in range(len(CATEGORICAL))]
q("scale_features", f"""
SELECT {K}, split, {', '.join(f'{R6(f"z[{i + 1}]")} AS z_{c}' for i, c in enumerate(NUMERIC))},
       {', '.join(f'{R6(f"coalesce(list_sum(z[{_AFTER[k]} + 1:{_AFTER[k]} + sizes[{k + 1}]]), 0.0)")} AS z_{c}_slots' for k, c in enumerate(CATEGORICAL))}
FROM scaled""", "scaled")

cte("gram", ("scaled",), """
SELECT a.i, b.i AS j, sum(t.z[a.i] * t.z[b.i]) AS g FROM (SELECT z || [label - avg(label) OVER ()] AS z FROM scaled WHERE split = 'train') t,
  (SELECT unnest(range(1, (SELECT max(len(z)) + 1 FROM scaled))) AS i) a, (SELECT unnest(range(1, (SELECT max(len(z)) + 2 FROM scaled))) AS i) b GROUP BY a.i, b.i""")
cte("gauss", ("gram",), """
SELECT 1 AS k, list(r ORDER BY i) AS a FROM (SELECT i, list(CASE WHEN i = j THEN g + 1.0 ELSE g END ORDER BY j) AS r FROM gram GROUP BY i)
UNION ALL
SELECT k + 1, [CASE WHEN i = k THEN [v / a[k][k] FOR v IN a[k]] ELSE [a[i][j] - a[i][k] * a[k][j] / a[k][k] FOR j IN range(1, len(a[k]) + 1)] END FOR i IN range(1, len(a) + 1)]
FROM gauss WHERE k <= len(a)""")
RECURSIVE.add("gauss")
cte("ridge_rows", ("gauss", "scaled"), """
SELECT split, label AS y, greatest(mean + list_sum([z[i] * w[i] FOR i IN range(1, len(z) + 1)]), 0.0) AS p
FROM scaled, (SELECT [r[len(r)] FOR r IN a] AS w FROM gauss ORDER BY k DESC LIMIT 1), (SELECT avg(label) AS mean FROM scaled WHERE split = 'train')
WHERE split IN ('val', 'test')""")
cte("ridge_metrics", ("ridge_rows",), """
SELECT split, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse, CASE WHEN sum(abs(y)) = 0 THEN 0.0 ELSE sum(abs(y - p)) / sum(abs(y)) END AS wape,
       sqrt(avg(power(ln(1 + greatest(y, 0.0)) - ln(1 + greatest(p, 0.0)), 2))) AS rmsle, avg(p - y) AS bias
FROM ridge_rows GROUP BY split""")
q("demand_ridge", " UNION ALL ".join(f"SELECT split, '{m}' AS metric, {R6(m)} AS value, 'ridge' AS model FROM ridge_metrics" for m in ("mae", "rmse", "wape", "rmsle", "bias")),
  "ridge_metrics")

_RUN = (("features", "features", "units_sold"), ("elasticity", "elasticity", "sample_size"), ("recommendations", "recommendations", "recommended_price"),
        ("inventory", "inv_status", "on_hand_inventory"), ("replenishment", "replen", "recommended_order_quantity"),
        ("transfers", "transfers", "transfer_quantity"), ("joint", "joint_out", "gross_profit_lift"), ("backtest", "bt_cmp", "total_gross_profit"))
q("decision_pipeline", " UNION ALL ".join([*(f"SELECT '{s}' AS stage, count(*) AS rows, {R(f'coalesce(sum(CAST({c} AS DOUBLE)), 0.0)', 2)} AS total FROM {t}" for s, t, c in _RUN),
  f"SELECT 'model_metrics' AS stage, 5 * count(*) AS rows, {R('sum(mae + rmse + wape + rmsle + bias)', 2)} AS total FROM ridge_metrics"]),
  *(t for _, t, _ in _RUN), "ridge_metrics")

# ------------------------------------------------------------ kept states: the same results from whole tables
q("elasticity_states", "SELECT * FROM elasticity", "elasticity")
q("feat_from_tail", f"SELECT {K}, " + ", ".join(f"{R6(c)} AS {c}" for c in FILL)
  + " FROM features WHERE week_num = (SELECT max(week_num) FROM features)", "features")
cte("kpi_cube_joint", ("joint_out",), """
  SELECT CASE WHEN grouping(region) = 1 THEN 'All' ELSE region END AS r, CASE WHEN grouping(category) = 1 THEN 'All' ELSE category END AS c,
         CASE WHEN grouping(customer_tier) = 1 THEN 'All' ELSE customer_tier END AS t,
         coalesce(sum(current_revenue), 0) AS rev, coalesce(sum(current_gross_profit), 0) AS gp, coalesce(sum(gross_profit_lift), 0) AS lift,
         count(*) FILTER (WHERE recommendation_action IN ('Increase', 'Decrease')) AS moves,
         count(*) FILTER (WHERE inventory_status IN ('STOCKOUT', 'STOCKOUT_RISK')) AS risk,
         count(*) FILTER (WHERE manual_review_required) AS review
  FROM joint_out GROUP BY CUBE (region, category, customer_tier)""")
cte("kpi_cube_stock", ("inv_status", "panel"), f"""
  SELECT CASE WHEN grouping(i.region) = 1 THEN 'All' ELSE i.region END AS r, CASE WHEN grouping(i.category) = 1 THEN 'All' ELSE i.category END AS c,
         sum(i.on_hand_inventory * i.unit_cost) AS value, sum(g.cogs) AS cogs, count(*) AS n,
         sum(CASE WHEN i.inventory_status IN {EXC} THEN i.excess_inventory_value ELSE 0.0 END) AS excess,
         count(*) FILTER (WHERE i.inventory_status IN ('STOCKOUT', 'STOCKOUT_RISK')) AS out
  FROM inv_status i LEFT JOIN (SELECT sku_id, region, sum(unit_cost * units_sold) AS cogs FROM panel GROUP BY ALL) g
    ON i.sku_id = g.sku_id AND i.region = g.region GROUP BY CUBE (i.region, i.category)""")
q("kpi_cube", f"""
SELECT j.r AS region, j.c AS category, j.t AS customer_tier, {R4('rev')} AS total_revenue, {R4('gp')} AS gross_margin_value,
       {R4('lift')} AS margin_opportunity, moves AS pricing_opportunities, risk AS high_risk_rows, review AS awaiting_review,
       {R4('coalesce(value, 0.0)')} AS total_inventory_value, {R4('coalesce(excess, 0.0)')} AS excess_inventory_value,
       {R4('CASE WHEN value > 0 THEN coalesce(cogs, 0.0) / value ELSE 0.0 END')} AS inventory_turnover,
       {R4('CASE WHEN n > 0 THEN out * 1.0 / n ELSE 0.0 END')} AS stockout_rate,
       {R4('CASE WHEN rev <> 0 THEN gp / rev ELSE 0.0 END')} AS gross_margin_pct
FROM kpi_cube_joint j LEFT JOIN kpi_cube_stock s ON j.r = s.r AND j.c = s.c""", "kpi_cube_joint", "kpi_cube_stock")
q("decision_log_stream", f"""
SELECT sku_id, logged_at, CAST(0 AS BIGINT) AS sequence, note, decision, {R6('override_price')} AS override_price FROM decision_log
QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY logged_at DESC, note DESC NULLS LAST, decision DESC NULLS LAST, override_price DESC NULLS LAST) = 1""",
  "decision_log")
