"""Row-level panel derivations (censoring, money, flags, demand drivers).

All are narrow transformations: no shuffle, whole-stage codegen only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import exact_avg, r2, r4, safe_div

KEY = ["sku_id", "region", "customer_tier", "week_num"]

def sales_financials(df: DataFrame) -> DataFrame:
    """revenue, cogs, gross profit and margin from price, cost and units."""
    rev = r2(F.col("realized_price") * F.col("units_sold"))
    cogs = r2(F.col("unit_cost") * F.col("units_sold"))
    df = df.withColumns({"revenue": rev, "cogs": cogs})
    df = df.withColumn("gross_profit", r2(F.col("revenue") - F.col("cogs")))
    return df.withColumn(
        "gross_margin_pct",
        F.when(F.col("revenue") > 0, F.col("gross_profit") / F.col("revenue")).otherwise(0.0))


def demand_censoring(df: DataFrame) -> DataFrame:
    """units = min(latent, available); lost = max(0, latent - available); ending = max(0, available - units)."""
    avail = F.col("beginning_inventory") + F.col("receipts")
    df = df.withColumn("units_sold", r2(F.least(F.col("latent_demand"), avail)))
    return df.withColumns({
        "lost_sales_estimate": F.greatest(F.lit(0.0), F.col("latent_demand") - avail),
        "ending_inventory": F.greatest(F.lit(0.0), avail - F.col("units_sold")),
    })


def competitor_index(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "competitor_price_index",
        F.when(F.col("competitor_price") > 0, F.col("realized_price") / F.col("competitor_price")).otherwise(1.0))


def stock_flags(df: DataFrame) -> DataFrame:
    """stockout = ending<5 and lost>0; excess = woc>16; slow = woc>20 and units < .3 base demand."""
    return df.withColumns({
        "stockout_flag": (F.col("ending_inventory") < 5) & (F.col("lost_sales_estimate") > 0),
        "excess_inventory_flag": F.col("weeks_of_cover") > 16,
        "slow_moving_flag": (F.col("weeks_of_cover") > 20) & (F.col("units_sold") < F.col("base_demand") * 0.3),
    })


def panel_stock_flags(df: DataFrame, products: DataFrame) -> DataFrame:
    return stock_flags(df.join(products.select("sku_id", "base_demand"), "sku_id", "left"))


# Demand drivers are measured from the panel's own demand: each is the mean demand of a slice over
# the mean demand of what the slice is part of. Every aggregate is bounded by the dimensions.

def _relative(df: DataFrame, part: list[str], whole: list[str], name: str) -> DataFrame:
    a = df.groupBy(*part).agg(F.avg("latent_demand").alias("_part"))
    b = df.groupBy(*whole).agg(F.avg("latent_demand").alias("_whole"))
    both = a.join(b, whole) if whole else a.join(F.broadcast(b))  # b is one row
    return both.select(*part, safe_div(F.col("_part"), F.col("_whole"), 1.0).alias(name))


def season_table(df: DataFrame) -> DataFrame:
    """Category demand in a calendar month over the category's demand, by category and ``_month``."""
    index = _relative(df.withColumn("_month", F.month("week_start")), ["category", "_month"], ["category"], "seasonality_index")
    return index.withColumn("seasonality_index", r4(F.col("seasonality_index")))


def seasonality_index(df: DataFrame, season: DataFrame | None = None) -> DataFrame:
    """Category demand in the calendar month of the period over the category's demand; ``season`` is the
    table of it, if it was stored before."""
    season = season_table(df) if season is None else season
    return df.withColumn("_month", F.month("week_start")).join(season, ["category", "_month"]).drop("_month")


def economy_table(df: DataFrame) -> DataFrame:
    """Total demand of a period over the mean period's, by period."""
    weeks = df.groupBy("week_num").agg(F.sum("latent_demand").alias("_units"))
    mean = weeks.agg((F.sum("_units") / F.count(F.lit(1))).alias("_mean"))
    return weeks.join(F.broadcast(mean)).select("week_num", r4(safe_div(F.col("_units"), F.col("_mean"), 1.0)).alias("economic_demand_index"))


def economic_index(df: DataFrame, economy: DataFrame | None = None) -> DataFrame:
    """Total demand of the period over the mean period's; ``economy`` is the table of it, if it was
    stored before."""
    return df.join(economy_table(df) if economy is None else economy, "week_num")


def lifecycle_stage(df: DataFrame) -> DataFrame:
    """Per SKU: first period, demand in the earlier and later half of the time, and the stage.

    New: first sold in the later half; Growth / Decline: the later half sold over 1.1 / under 0.9
    times the earlier; else Mature.
    """
    half = F.broadcast(df.agg(F.floor(F.max("week_num") / 2).alias("_half")))  # one row
    early = F.col("week_num") <= F.col("_half")
    sums = df.join(half).groupBy("sku_id").agg(
        F.min("week_num").alias("first_week"), F.max("_half").alias("_half"),
        F.sum(F.when(early, F.col("latent_demand")).otherwise(0.0)).alias("early_units"),
        F.sum(F.when(early, 0.0).otherwise(F.col("latent_demand"))).alias("late_units"))
    stage = (F.when(F.col("first_week") > F.col("_half"), "New").when(10 * F.col("late_units") > 11 * F.col("early_units"), "Growth")
             .when(10 * F.col("late_units") < 9 * F.col("early_units"), "Decline").otherwise("Mature"))
    return sums.select("sku_id", "first_week", "early_units", "late_units", stage.alias("lifecycle_stage"))


def lifecycle_factor(df: DataFrame) -> DataFrame:
    """The SKU's demand in each year of 16 periods over its demand in all."""
    df = df.withColumn("_year", F.floor((F.col("week_num") - 1) / 16))
    return df.join(_relative(df, ["sku_id", "_year"], ["sku_id"], "lifecycle_factor"), ["sku_id", "_year"]).drop("_year")


def tier_price(df: DataFrame, list_price_col: str = "regular_price") -> DataFrame:
    """List price less the mean discount of the tier."""
    disc = df.groupBy("customer_tier").agg(exact_avg(F.col("customer_tier_discount_pct"), 4).alias("_disc"))
    return df.join(disc, "customer_tier").withColumn("tier_price", r2(F.col(list_price_col) * (F.lit(1.0) - F.col("_disc")))).drop("_disc")


def latent_demand_model(df: DataFrame, products: DataFrame) -> DataFrame:
    """Expected demand: base demand x region, season, economy and lifecycle as measured."""
    region = _relative(df, ["region"], [], "_region")
    df = lifecycle_factor(df.join(products.select("sku_id", "base_demand"), "sku_id", "left").join(region, "region"))
    demand = (F.col("base_demand") * F.col("_region") * F.col("seasonality_index") * F.col("economic_demand_index")
              * F.col("lifecycle_factor"))
    return df.withColumn("modeled_latent_demand", F.greatest(F.lit(0.0), demand))


def price_inversion_check(df: DataFrame) -> DataFrame:
    """Rows where the Fleet price exceeds the Trade or Retail price of the same SKU, region and week."""
    from pyspark.sql import Window as W
    w = W.partitionBy("sku_id", "region", "week_num")
    retail = F.max(F.when(F.col("customer_tier") == "Retail", F.col("realized_price"))).over(w)
    trade = F.max(F.when(F.col("customer_tier") == "Trade", F.col("realized_price"))).over(w)
    out = df.select(*KEY, "realized_price", retail.alias("retail_price"), trade.alias("trade_price"))
    return out.filter(
        (F.col("customer_tier") == "Fleet")
        & ((F.col("realized_price") > F.col("trade_price")) | (F.col("realized_price") > F.col("retail_price")))
    ).withColumn("reason_code", F.lit("CUSTOMER_TIER_LEAKAGE"))

