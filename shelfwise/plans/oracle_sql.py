"""Hand-written DuckDB SQL for the correctness oracle.

Each named CTE below is an independent SQL statement of one stage of the
pipeline; ``with_ctes(select, *names)`` prefixes a final SELECT with the CTEs it
needs (dependencies resolved in declaration order).  Rounding is written as
floor(x*10^k + .5)/10^k, exactly as on the Spark side.
"""

from __future__ import annotations

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (body, deps)


def _closure(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in CTES[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


RECURSIVE = set()


def with_ctes(select: str, *names: str) -> str:
    order = _closure(names)
    if not order:
        return select
    parts = [f"{n} AS (\n{CTES[n][0]}\n)" for n in order]
    head = "WITH RECURSIVE " if RECURSIVE.intersection(order) else "WITH "
    return head + ",\n".join(parts) + "\n" + select


def R(x: str, k: int) -> str:
    return f"(floor(({x}) * {10 ** k}.0 + 0.5) / {10 ** k}.0)"


# ---------------------------------------------------------------- panel adapter
cte("o_attr", (), """
SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS order_day, r.r_regionkey AS region_no, r.r_name AS region,
       CASE WHEN c.c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Retail'
            WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'Fleet' ELSE 'Trade' END AS customer_tier
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (nation n JOIN region r ON n.n_regionkey = r.r_regionkey) ON c.c_nationkey = n.n_nationkey
""")

cte("o_cells", ("o_attr",), """
SELECT sku_id, region_no, region, customer_tier, week_num, epoch + CAST((week_num - 1) * 23 AS INTEGER) AS week_start,
       sum(l_quantity) AS latent_demand, count(*) AS n_lines, CAST(sum(disc) AS BIGINT) AS disc_pct_sum,
       CAST(sum(cents) AS BIGINT) AS value_cents, CAST(sum(cents * (100 - disc)) AS BIGINT) AS net_value,
       sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS returned,
       sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0.0 END) AS open_units, min(l_suppkey) AS supplier_no
FROM (
  SELECT l.*, e.epoch, coalesce(p.p_brand || '|' || p.p_type, 'UNKNOWN|UNKNOWN') AS sku_id, coalesce(a.region_no, -1) AS region_no,
         coalesce(a.region, 'UNKNOWN') AS region, coalesce(a.customer_tier, 'Trade') AS customer_tier,
         CAST(floor(date_diff('day', e.epoch, coalesce(a.order_day, CAST(l.l_shipdate AS DATE))) / 23.0) AS INTEGER) + 1 AS week_num,
         CAST(round(l.l_discount * 100) AS BIGINT) AS disc, CAST(round(l.l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem l
  LEFT JOIN o_attr a ON l.l_orderkey = a.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  CROSS JOIN (SELECT CAST(min(o_orderdate) AS DATE) AS epoch FROM orders) e
)
GROUP BY ALL
""")

cte("o_stage", ("o_cells",), """
SELECT *, CASE WHEN first_week > half THEN 'New' WHEN 10 * late_units > 11 * early_units THEN 'Growth'
               WHEN 10 * late_units < 9 * early_units THEN 'Decline' ELSE 'Mature' END AS lifecycle_stage
FROM (SELECT sku_id, min(week_num) AS first_week, max(half) AS half,
             sum(CASE WHEN week_num <= half THEN latent_demand ELSE 0.0 END) AS early_units,
             sum(CASE WHEN week_num <= half THEN 0.0 ELSE latent_demand END) AS late_units
      FROM o_cells CROSS JOIN (SELECT floor(max(week_num) / 2) AS half FROM o_cells) GROUP BY sku_id)
""")

cte("o_prod", ("o_cells", "o_stage"), """
SELECT sku_id, coalesce(category, 'UNKNOWN') AS category, coalesce(brand, 'UNKNOWN') AS brand, coalesce(size_sum, 0) AS size_sum,
       coalesce(n_parts, 1) AS n_parts, coalesce(base_demand, 0.0) AS base_demand, coalesce(lifecycle_stage, 'New') AS lifecycle_stage,
       coalesce(CAST(floor(value_cents / units) AS BIGINT), retail_sum // n_parts, 0) AS price_cents, first_week, last_week, supplier_no,
       ['Premium', 'Mid-Tier', 'Economy', 'Private Label'][coalesce(TRY_CAST(regexp_extract(brand, '(\\d+)$', 1) AS INTEGER), 0) % 4 + 1] AS brand_tier
FROM (SELECT p_brand || '|' || p_type AS sku_id, any_value(p_type) AS category, any_value(p_brand) AS brand,
             CAST(sum(p_size) AS BIGINT) AS size_sum, CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS BIGINT) AS retail_sum, count(*) AS n_parts
      FROM part GROUP BY 1)
FULL JOIN (SELECT sku_id, """ + R("avg(latent_demand)", 2) + """ AS base_demand, sum(latent_demand) AS units,
                  CAST(sum(value_cents) AS BIGINT) AS value_cents, min(supplier_no) AS supplier_no FROM o_cells GROUP BY sku_id) USING (sku_id)
LEFT JOIN (SELECT sku_id, first_week, lifecycle_stage FROM o_stage) USING (sku_id)
CROSS JOIN (SELECT max(week_num) AS last_week FROM o_cells)
""")

cte("products", ("o_prod",), """
SELECT sku_id, category || ' - ' || brand AS product_name, category,
       category || CASE WHEN size_sum // n_parts < 24 THEN '-S' WHEN size_sum // n_parts < 28 THEN '-M' ELSE '-L' END AS subcategory,
       brand_tier, brand_tier = 'Private Label' AS private_label_flag,
       (price_cents * 60 // 100) / 100.0 AS unit_cost,
       price_cents / 100.0 AS regular_retail_price,
       CASE brand_tier WHEN 'Premium' THEN 0.20 WHEN 'Mid-Tier' THEN 0.15 WHEN 'Economy' THEN 0.10 ELSE 0.12 END::DOUBLE AS minimum_margin_pct,
       (price_cents * 85 // 100) / 100.0 AS minimum_advertised_price,
       'Supplier-' || CAST(coalesce(supplier_no, 0) AS VARCHAR) AS supplier,
       CAST(CASE brand_tier WHEN 'Premium' THEN 28 WHEN 'Mid-Tier' THEN 14 WHEN 'Economy' THEN 7 ELSE 42 END AS INTEGER) AS lead_time_days,
       CAST([1, 6, 12, 24][size_sum % 4 + 1] AS INTEGER) AS case_pack,
       CAST(coalesce((last_week - first_week + 1) * 23 // 7, 0) AS INTEGER) AS product_age_weeks,
       lifecycle_stage, base_demand,
       CAST(NULL AS DOUBLE) AS true_price_elasticity, CAST(NULL AS DOUBLE) AS seasonality_strength,
       """ + R("((price_cents * 60 // 100) / 100.0) * 0.04", 4) + """ AS inventory_holding_cost,
       CASE lifecycle_stage WHEN 'New' THEN 0.02 WHEN 'Growth' THEN 0.05 WHEN 'Mature' THEN 0.10 ELSE 0.25 END::DOUBLE AS obsolescence_risk,
       CAST([1, 6, 12, 24][size_sum % 4 + 1] AS INTEGER) AS minimum_order_quantity
FROM o_prod
""")

cte("o_p1", ("o_cells", "o_prod", "products"), """
SELECT c.*, o.category, o.size_sum, o.price_cents, o.base_demand, p.unit_cost,
       floor(sum(c.value_cents) OVER m / sum(c.latent_demand) OVER m) / 100.0 AS competitor_price,
       CAST(floor(c.net_value / (c.latent_demand * 100)) AS BIGINT) AS sold_cents,
       c.disc_pct_sum >= 8 * c.n_lines AS promotion_flag,
       """ + R("c.disc_pct_sum / (c.n_lines * 100.0)", 4) + """ AS discount,
       """ + R("""o.base_demand * [0.0, 0.25, 0.5, 1.0, 2.0, 4.0, 8.0, 12.0, 20.0, 30.0][
            ((o.size_sum + c.region_no) % 10 + 10) % 10 + 1]::DOUBLE""", 2) + """ AS beginning_inventory
FROM o_cells c JOIN o_prod o USING (sku_id) JOIN products p USING (sku_id)
WINDOW m AS (PARTITION BY o.category, c.region, c.week_num)
""")

cte("o_p2", ("o_p1",), """
SELECT *, sold_cents / 100.0 AS realized_price, beginning_inventory + returned AS avail,
       """ + R("least(latent_demand, beginning_inventory + returned)", 2) + """ AS units_sold
FROM o_p1
""")

cte("o_p3", ("o_p2",), """
SELECT *, """ + R("greatest(0.0, latent_demand - avail)", 2) + """ AS lost_sales_estimate,
       """ + R("greatest(0.0, avail - units_sold)", 2) + """ AS ending_inventory,
       """ + R("realized_price * units_sold", 2) + """ AS revenue,
       """ + R("unit_cost * units_sold", 2) + """ AS cogs
FROM o_p2
""")

cte("o_p4", ("o_p3",), """
SELECT *, """ + R("revenue - cogs", 2) + """ AS gross_profit,
       CASE WHEN base_demand > 0 THEN """ + R("ending_inventory / base_demand", 2) + """ ELSE 999.0 END AS weeks_of_cover,
       CASE WHEN ending_inventory < base_demand THEN open_units ELSE 0.0 END AS on_order
FROM o_p3
""")

cte("panel", ("o_p4",), """
SELECT week_start, week_num, sku_id, category, region, customer_tier,
       unit_cost, price_cents / 100.0 AS regular_price, realized_price, competitor_price,
       discount AS customer_tier_discount_pct,
       CASE WHEN competitor_price > 0 THEN """ + R("realized_price / competitor_price", 4) + """ ELSE 1.0 END AS competitor_price_index,
       promotion_flag, CASE WHEN promotion_flag THEN discount ELSE 0.0 END AS promotion_depth,
       """ + R("avg(latent_demand) OVER (PARTITION BY category, month(week_start)) / avg(latent_demand) OVER (PARTITION BY category)", 4) + """ AS seasonality_index,
       """ + R("sum(latent_demand) OVER (PARTITION BY week_num) / (sum(latent_demand) OVER () / (SELECT count(DISTINCT week_num) FROM o_p4))", 4) + """ AS economic_demand_index,
       beginning_inventory, returned AS receipts, units_sold, CAST(latent_demand AS DOUBLE) AS latent_demand,
       lost_sales_estimate, ending_inventory, on_order, revenue, cogs, gross_profit,
       CASE WHEN revenue > 0 THEN """ + R("gross_profit / revenue", 4) + """ ELSE 0.0 END AS gross_margin_pct,
       weeks_of_cover,
       ending_inventory < 5 AND lost_sales_estimate > 0 AS stockout_flag,
       weeks_of_cover > 16 AS excess_inventory_flag,
       weeks_of_cover > 20 AND units_sold < base_demand * 0.3 AS slow_moving_flag,
       CASE WHEN promotion_flag THEN 'promotion' WHEN 10 * sold_cents < 9 * price_cents THEN 'competitor_response'
            WHEN 2 * sold_cents > 3 * price_cents THEN 'supplier_cost_change' WHEN n_lines > 1 THEN 'scheduled_review'
            WHEN customer_tier = 'Fleet' THEN 'tier_discount_policy' ELSE 'no_change' END AS price_change_reason,
       n_lines > 1 AS price_test_flag,
       'v2.0.0-inventory-engine' AS policy_version
FROM o_p4
""")
