"""Leak-free lag and rolling features over each (sku, region, tier) series.

Shifts are by row within a series ordered by week_num.  Every window here is
partitioned by the series key, so one hash exchange on that key serves all of
them (Catalyst reuses the partitioning; see ``explain``).  The series key has
SKU x region x tier cardinality, which keeps tasks balanced even when one SKU
holds a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from shelfwise.config import TEST_WEEKS, TRAIN_WEEKS, VAL_WEEKS

GROUP_COLS = ["sku_id", "region", "customer_tier"]
TARGET_COL = "adjusted_units"
LAGS = [1, 2, 4, 13]
NUMERIC_FEATURES = [
    "lag_1_units", "lag_2_units", "lag_4_units", "lag_13_units",
    "rolling_4_units", "rolling_8_units", "rolling_13_units",
    "rolling_4_revenue", "rolling_13_margin", "prior_week_inventory",
    "price_change_pct", "price_index_vs_competitor", "tier_discount_pct",
    "promotion_flag", "seasonality_index", "week_of_year", "month",
    "lead_time_days", "weeks_of_cover", "realized_price", "unit_cost",
    "competitor_price_index", "economic_demand_index",
]
CATEGORICAL_FEATURES = ["category", "region", "customer_tier", "lifecycle_stage"]
FILL_ZERO = [
    "lag_1_units", "lag_2_units", "lag_4_units", "lag_13_units",
    "rolling_4_units", "rolling_8_units", "rolling_13_units",
    "rolling_4_revenue", "rolling_13_margin", "prior_week_inventory",
    "price_change_pct", "weeks_of_cover",
]


def series_window():
    return W.partitionBy(*GROUP_COLS).orderBy("week_num")


def feat_product_join(df: DataFrame, products: DataFrame) -> DataFrame:
    p = products.select("sku_id", "lifecycle_stage", "lead_time_days", "product_age_weeks")
    return df.join(p, "sku_id", "left")


def feat_adjusted_units(df: DataFrame) -> DataFrame:
    """Censoring-adjusted target: latent demand in stockout weeks, else units sold."""
    mask = F.col("stockout_flag") | (F.col("lost_sales_estimate") > 0)
    fill = F.col("latent_demand") if "latent_demand" in df.columns else F.col("units_sold") + F.col("lost_sales_estimate")
    return df.withColumn(TARGET_COL, F.when(mask, fill).otherwise(F.col("units_sold")))


def feat_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns({"week_of_year": F.weekofyear("week_start"), "month": F.month("week_start")})


def feat_price_change(df: DataFrame) -> DataFrame:
    prev = F.lag("realized_price", 1).over(series_window())
    return df.withColumn("price_change_pct", F.coalesce(F.try_divide(F.col("realized_price"), prev) - 1.0, F.lit(0.0)))


def feat_aliases(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "price_index_vs_competitor": F.col("competitor_price_index"),
        "tier_discount_pct": F.col("customer_tier_discount_pct"),
    })


def feat_lags(df: DataFrame, lags=LAGS) -> DataFrame:
    w = series_window()
    return df.withColumns({f"lag_{k}_units": F.lag("units_sold", k).over(w) for k in lags})


def _trailing_mean(col: str, k: int):
    return F.avg(col).over(series_window().rowsBetween(-k, -1))


def feat_rolling_units(df: DataFrame) -> DataFrame:
    return df.withColumns({f"rolling_{k}_units": _trailing_mean("units_sold", k) for k in (4, 8, 13)})


def feat_rolling_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("rolling_4_revenue", _trailing_mean("revenue", 4))


def feat_rolling_margin(df: DataFrame) -> DataFrame:
    return df.withColumn("rolling_13_margin", _trailing_mean("gross_margin_pct", 13))


def feat_prior_inventory(df: DataFrame) -> DataFrame:
    return df.withColumn("prior_week_inventory", F.lag("ending_inventory", 1).over(series_window()))


def feat_fill(df: DataFrame) -> DataFrame:
    return df.na.fill(0.0, subset=[c for c in FILL_ZERO if c in df.columns])


def build_features(panel: DataFrame, products: DataFrame) -> DataFrame:
    """Panel + 3 product columns + the derived feature columns (one window stage)."""
    df = feat_product_join(panel, products)
    df = feat_adjusted_units(df)
    df = feat_calendar(df)
    df = feat_price_change(df)
    df = feat_aliases(df)
    df = feat_lags(df)
    df = feat_rolling_units(df)
    df = feat_rolling_revenue(df)
    df = feat_rolling_margin(df)
    df = feat_prior_inventory(df)
    return feat_fill(df)


def time_split(df: DataFrame) -> DataFrame:
    """train / val / test label from the data's max week (one 1-row aggregate, cross-joined)."""
    mx = df.agg(F.max("week_num").alias("_max_week"))
    small = F.col("_max_week") <= TRAIN_WEEKS + VAL_WEEKS + TEST_WEEKS
    cuts = mx.select(
        F.when(small, F.floor(F.col("_max_week") * 0.75)).otherwise(TRAIN_WEEKS).cast("int").alias("_train_end"),
        F.when(small, F.floor(F.col("_max_week") * 0.875)).otherwise(TRAIN_WEEKS + VAL_WEEKS).cast("int").alias("_val_end"),
    )
    out = df.crossJoin(F.broadcast(cuts))  # 1-row side: a broadcast nested-loop join with no fan-out
    split = (F.when(F.col("week_num") <= F.col("_train_end"), "train")
             .when(F.col("week_num") <= F.col("_val_end"), "val").otherwise("test"))
    return out.withColumn("split", split).drop("_train_end", "_val_end")


def leakage_check(features: DataFrame, lags=LAGS, tol: float = 0.01) -> DataFrame:
    """Re-derive every lag independently and count violations per lag.

    Each row is paired with its k-rows-back row by ONE self-join on
    (series key, row position - k) after exploding the lag list, so all lags
    share a single shuffle join instead of one join per lag.
    """
    w = series_window()
    lag_val = F.coalesce(*[F.when(F.col("lag") == k, F.col(f"lag_{k}_units")) for k in lags])
    base = features.select(*GROUP_COLS, *[f"lag_{k}_units" for k in lags],
                           F.row_number().over(w).alias("_rn"), F.col("units_sold").alias("_units"))
    cur = base.withColumn("lag", F.explode(F.array(*[F.lit(k) for k in lags]))).select(
        *GROUP_COLS, "lag", (F.col("_rn") - F.col("lag")).alias("_prn"), lag_val.alias("_lag_value"))
    prev = base.select(*GROUP_COLS, F.col("_rn").alias("_prn"), F.col("_units").alias("_prev_units"))
    j = cur.join(prev, [*GROUP_COLS, "_prn"], "inner")
    bad = F.when(F.col("_lag_value").isNotNull() & (F.abs(F.col("_lag_value") - F.col("_prev_units")) >= tol), 1)
    return j.groupBy("lag").agg(F.count(F.lit(1)).cast("long").alias("checked_rows"),
                                F.count(bad).cast("long").alias("violations"))

