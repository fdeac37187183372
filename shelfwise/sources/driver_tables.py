"""Adapter from the driver's star-schema tables to the weekly pricing panel.

Grain of the panel: (sku_id, region, customer_tier, week_num).

* sku_id = p_brand '|' p_type (``grain="brand_type"``) or p_brand '|' p_type '|' p_partkey
  (``grain="part"``); category = p_type, region = r_name
* customer_tier from c_mktsegment (HOUSEHOLD, FURNITURE -> Retail; AUTOMOBILE -> Fleet;
  others -> Trade)
* week_num counts periods of 23 days from the first order date; it has no upper bound.
  week_start is the period's first day. Lines without an order use their ship date.
* demand, sold price and discount are the lines' own: sum(l_quantity), discounted
  l_extendedprice per unit, mean l_discount; returned units are receipts, units of open
  lines are on order, the market price of category x region x period stands for the
  competitor's. Indexes of season and economy are measured from the demand.
* Lines, orders or customers without a match are kept under the member UNKNOWN.

The few attributes without a source column are plain rules with the constants below.
Money is handled in integer cents until the last step so that summation order can never
change a result.

Scale notes: lineitem is the only large input. It is joined to the per-order attributes on
the order key and to the SKU of its part, then aggregated once, straight to the panel's
grain: partial sums, over some ``TASK_LINES`` lines a task, collapse the cells before the shuffle. The part side is broadcast by
measured size; beyond that the shuffle join of a hot part is split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.config import POLICY_VERSION
from shelfwise.functions.columns import r2, r4
from shelfwise.operators import panel_ops as po

PERIOD_DAYS = 23
UNKNOWN = "UNKNOWN"
TIERS = ["Retail", "Fleet", "Trade"]
#: Lines that a task adds up, if there are enough for all cores.
TASK_LINES = 2_000_000

# attributes without a source: constants chosen so that every policy branch is reachable
BRAND_TIERS = ["Premium", "Mid-Tier", "Economy", "Private Label"]
MIN_MARGIN = {"Premium": 0.20, "Mid-Tier": 0.15, "Economy": 0.10, "Private Label": 0.12}
LEAD_DAYS = {"Premium": 28, "Mid-Tier": 14, "Economy": 7, "Private Label": 42}
RISK = {"New": 0.02, "Growth": 0.05, "Mature": 0.10, "Decline": 0.25}
PACKS = [1, 6, 12, 24]
STOCK_PERIODS = [0.0, 0.25, 0.5, 1.0, 2.0, 4.0, 8.0, 12.0, 20.0, 30.0]
COST_PCT, MAP_PCT, PROMO_PCT = 60, 85, 8


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: list) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (index + 1).cast("int"))


def _by(key: Column, values: dict) -> Column:
    expr = None
    for k, v in values.items():
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr


def _tier_of_segment(seg: Column) -> Column:
    return (
        F.when(seg.isin("HOUSEHOLD", "FURNITURE"), F.lit("Retail"))
        .when(seg == "AUTOMOBILE", F.lit("Fleet"))
        .otherwise(F.lit("Trade"))
    )


def order_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: region, tier and order day (orders x customer x nation x region)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_day"))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("r_regionkey").alias("region_no"), F.col("r_name").alias("region"))
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left").select(
        "c_custkey", "region_no", "region", "c_mktsegment")
    return orders.join(cust, orders.o_custkey == cust.c_custkey, "left").select(
        "o_orderkey", "order_day", "region_no", "region", _tier_of_segment(F.col("c_mktsegment")).alias("customer_tier"))


def sku_dimension(spark: SparkSession, sf_dir: str, grain: str = "brand_type") -> DataFrame:
    """part -> (p_partkey, sku_id, category, brand, p_size, price_cents)."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    key = ["p_brand", "p_type"] + (["p_partkey"] if grain == "part" else [])
    return part.select(
        "p_partkey",
        F.concat_ws("|", *key).alias("sku_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        "p_size",
        F.round(F.col("p_retailprice") * 100).cast("long").alias("retail_cents"),
    )


def cell_demand(spark: SparkSession, sf_dir: str, grain: str = "brand_type") -> DataFrame:
    """Sums of the line items per panel cell: units, value, discount, returned and open units."""
    # numbers travel as integers, flags and tiers as small codes
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
        F.round(F.col("l_discount") * 100).cast("long").alias("disc"), F.to_date("l_shipdate").alias("ship_day"),
        (F.when(F.col("l_returnflag") == "R", 1).otherwise(0) + F.when(F.col("l_linestatus") == "O", 2).otherwise(0)).cast("byte").alias("flags"))
    # a task hands on at most one row a cell, so few tasks, each over many lines, hand on few rows; all cores work,
    # and a task's cells fit its memory even if every line has its own
    tasks = max(2 * spark.sparkContext.defaultParallelism, li.count() // TASK_LINES)
    attrs = order_attributes(spark, sf_dir).select("o_orderkey", "order_day", F.col("region_no").cast("int").alias("region_no"), (
        F.array_position(F.array(*map(F.lit, TIERS)), F.col("customer_tier")) - 1).cast("byte").alias("tier_no"))
    skus = sku_dimension(spark, sf_dir, grain).select("p_partkey", "sku_id")
    first = F.broadcast(read_table(spark, sf_dir, "orders").agg(F.to_date(F.min("o_orderdate")).alias("epoch")))  # one row
    day, disc, cents = F.coalesce("order_day", "ship_day"), F.col("disc"), F.col("cents")
    lines = (li.join(attrs, li.l_orderkey == attrs.o_orderkey, "left").join(skus, li.l_partkey == skus.p_partkey, "left")
             .join(first)).coalesce(tasks)
    sums = lines.groupBy(
        F.coalesce("sku_id", F.lit(f"{UNKNOWN}|{UNKNOWN}")).alias("sku_id"),
        F.coalesce("region_no", F.lit(-1)).alias("region_no"),
        F.coalesce("tier_no", F.lit(TIERS.index("Trade")).cast("byte")).alias("tier_no"),
        (F.floor(F.datediff(day, "epoch") / PERIOD_DAYS) + 1).cast("int").alias("week_num"),
        "epoch",
    ).agg(
        F.sum("l_quantity").alias("latent_demand"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(disc).alias("disc_pct_sum"),
        F.sum(cents).alias("value_cents"),
        F.sum(cents * (100 - disc)).alias("net_value"),
        F.sum(F.when(F.col("flags") % 2 == 1, F.col("l_quantity")).otherwise(0.0)).alias("returned"),
        F.sum(F.when(F.col("flags") >= 2, F.col("l_quantity")).otherwise(0.0)).alias("open_units"),
        F.min("l_suppkey").alias("supplier_no"),
    )
    # what follows from the keys is added to the sums, not carried through their shuffle
    names = read_table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("int").alias("region_no"), F.col("r_name").alias("region"))
    keys = ["sku_id", "region_no", "region", "customer_tier", "week_num", "week_start"]
    return sums.join(names, "region_no", "left").withColumns({
        "region": F.coalesce("region", F.lit(UNKNOWN)),
        "customer_tier": _pick(F.col("tier_no"), TIERS),
        "week_start": F.date_add("epoch", (F.col("week_num") - 1) * PERIOD_DAYS),
    }).select(*keys, *[c for c in sums.columns if c not in (*keys, "tier_no", "epoch")])


def build_products(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None, grain: str = "brand_type") -> DataFrame:
    """Product master, one row per SKU (schema F1)."""
    cells = cells if cells is not None else cell_demand(spark, sf_dir, grain)
    parts = sku_dimension(spark, sf_dir, grain).groupBy("sku_id").agg(
        F.first("category").alias("category"), F.first("brand").alias("brand"), F.sum("p_size").alias("size_sum"),
        F.sum("retail_cents").alias("retail_sum"), F.count(F.lit(1)).alias("n_parts"))
    last = cells.agg(F.max("week_num").alias("last_week"))
    stage = po.lifecycle_stage(cells).select("sku_id", "first_week", "lifecycle_stage")
    sold = cells.groupBy("sku_id").agg(
        r2(F.avg("latent_demand")).alias("base_demand"), F.sum("latent_demand").alias("units"),
        F.sum("value_cents").alias("value_cents"), F.min("supplier_no").alias("supplier_no")).join(stage, "sku_id")
    brand_no = F.coalesce(F.expr(r"try_cast(regexp_extract(brand, '(\\d+)$', 1) as int)"), F.lit(0))
    d = parts.join(sold, "sku_id", "full").join(F.broadcast(last)).select(
        "sku_id", "first_week", "last_week", "supplier_no",
        F.coalesce("category", F.lit(UNKNOWN)).alias("category"), F.coalesce("brand", F.lit(UNKNOWN)).alias("brand"),
        F.coalesce("size_sum", F.lit(0)).cast("long").alias("size_sum"), F.coalesce("n_parts", F.lit(1)).alias("n_parts"),
        F.coalesce("base_demand", F.lit(0.0)).alias("base_demand"), F.coalesce("lifecycle_stage", F.lit("New")).alias("lifecycle_stage"),
        F.coalesce(F.floor(F.try_divide("value_cents", "units")), F.expr("retail_sum div n_parts"), F.lit(0)).cast("long").alias("price_cents"),
    ).withColumn("brand_tier", _pick(brand_no % 4, BRAND_TIERS))
    size = F.expr("size_sum div n_parts")
    unit_cost = F.expr(f"price_cents * {COST_PCT} div 100") / 100.0
    pack = _pick(F.col("size_sum") % 4, PACKS).cast("int")
    return d.select(
        "sku_id",
        F.concat(F.col("category"), F.lit(" - "), F.col("brand")).alias("product_name"),
        "category",
        F.concat(F.col("category"), F.when(size < 24, F.lit("-S")).when(size < 28, F.lit("-M")).otherwise(F.lit("-L"))).alias("subcategory"),
        "brand_tier",
        (F.col("brand_tier") == "Private Label").alias("private_label_flag"),
        unit_cost.alias("unit_cost"),
        (F.col("price_cents") / 100.0).alias("regular_retail_price"),
        _by(F.col("brand_tier"), MIN_MARGIN).alias("minimum_margin_pct"),
        (F.expr(f"price_cents * {MAP_PCT} div 100") / 100.0).alias("minimum_advertised_price"),
        F.concat(F.lit("Supplier-"), F.coalesce("supplier_no", F.lit(0)).cast("string")).alias("supplier"),
        _by(F.col("brand_tier"), LEAD_DAYS).cast("int").alias("lead_time_days"),
        pack.alias("case_pack"),
        F.coalesce(F.expr(f"(last_week - first_week + 1) * {PERIOD_DAYS} div 7"), F.lit(0)).cast("int").alias("product_age_weeks"),
        "lifecycle_stage",
        "base_demand",
        F.lit(None).cast("double").alias("true_price_elasticity"),
        F.lit(None).cast("double").alias("seasonality_strength"),
        r4(unit_cost * 0.04).alias("inventory_holding_cost"),
        _by(F.col("lifecycle_stage"), RISK).alias("obsolescence_risk"),
        pack.alias("minimum_order_quantity"),
        "size_sum", "price_cents",
    )


def build_panel(cells: DataFrame, products: DataFrame, store: Callable[[DataFrame, str], DataFrame] = lambda df, _: df) -> DataFrame:
    """Weekly sales panel (schema F2) from the cells' sums and the product master.

    ``store`` writes a table and reads it back. The measured indexes (market price, season, economy) are
    bounded by the dimensions; stored first, their size is known when the joins are planned, so the cells
    stay where they are instead of being shuffled once per index."""
    p = products.select("sku_id", "category", "size_sum", "price_cents", "base_demand", "unit_cost")
    df = cells.join(p, "sku_id")
    market = store(df.groupBy("category", "region", "week_num").agg(
        F.floor(F.try_divide(F.sum("value_cents"), F.sum("latent_demand"))).alias("market_cents")), "market")
    season, economy = store(po.season_table(df), "season"), store(po.economy_table(cells), "economy")
    df = df.join(market, ["category", "region", "week_num"])
    df = po.economic_index(po.seasonality_index(df, season), economy)  # rows are still narrow here
    sold = F.coalesce(F.floor(F.try_divide(F.col("net_value"), F.col("latent_demand") * 100)), F.lit(0)).cast("long")
    df = df.withColumn("sold_cents", sold).withColumn("promotion_flag", F.col("disc_pct_sum") >= PROMO_PCT * F.col("n_lines"))
    discount = r4(F.col("disc_pct_sum") / (F.col("n_lines") * 100.0))
    several = F.col("n_lines") > 1
    reason = (
        F.when(F.col("promotion_flag"), "promotion")
        .when(10 * F.col("sold_cents") < 9 * F.col("price_cents"), "competitor_response")
        .when(2 * F.col("sold_cents") > 3 * F.col("price_cents"), "supplier_cost_change")
        .when(several, "scheduled_review")
        .when(F.col("customer_tier") == "Fleet", "tier_discount_policy")
        .otherwise("no_change")
    )
    cover = _pick(F.pmod(F.col("size_sum") + F.col("region_no"), F.lit(10)), STOCK_PERIODS)
    df = df.withColumns({
        "realized_price": F.col("sold_cents") / 100.0,
        "regular_price": F.col("price_cents") / 100.0,
        "competitor_price": F.coalesce(F.col("market_cents") / 100.0, F.lit(0.0)),
        "customer_tier_discount_pct": discount,
        "promotion_depth": F.when(F.col("promotion_flag"), discount).otherwise(0.0),
        "price_change_reason": reason,
        "price_test_flag": several,
        "beginning_inventory": r2(F.col("base_demand") * cover),
        "receipts": F.col("returned"),
    })
    df = po.sales_financials(po.competitor_index(po.demand_censoring(df)))
    df = df.withColumns({
        "lost_sales_estimate": r2(F.col("lost_sales_estimate")), "ending_inventory": r2(F.col("ending_inventory")),
        "gross_margin_pct": r4(F.col("gross_margin_pct")), "competitor_price_index": r4(F.col("competitor_price_index")),
    })
    df = df.withColumns({
        "weeks_of_cover": F.when(F.col("base_demand") > 0, r2(F.col("ending_inventory") / F.col("base_demand"))).otherwise(999.0),
        "on_order": F.when(F.col("ending_inventory") < F.col("base_demand"), F.col("open_units")).otherwise(0.0),
    })
    return po.stock_flags(df).select(
        "week_start", "week_num", "sku_id", "category", "region", "customer_tier",
        "unit_cost", "regular_price", "realized_price", "competitor_price", "customer_tier_discount_pct",
        "competitor_price_index", "promotion_flag", "promotion_depth", "seasonality_index", "economic_demand_index",
        "beginning_inventory", "receipts", "units_sold", F.col("latent_demand").cast("double").alias("latent_demand"),
        "lost_sales_estimate", "ending_inventory", "on_order",
        "revenue", "cogs", "gross_profit", "gross_margin_pct", "weeks_of_cover",
        "stockout_flag", "excess_inventory_flag", "slow_moving_flag",
        "price_change_reason", "price_test_flag",
        F.lit(POLICY_VERSION).alias("policy_version"),
    )
