"""Readers and sinks for products, sales and the decision tables.

Scratch output goes under the cluster's shared ``spark.checkpoint.dir`` (never
a machine-local temp folder).  Writes are idempotent ``overwrite`` jobs, so a
lost executor only re-runs its tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import table_dir

PRODUCTS_SCHEMA = T.StructType([
    T.StructField("sku_id", T.StringType()), T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("subcategory", T.StringType()),
    T.StructField("brand_tier", T.StringType()), T.StructField("private_label_flag", T.BooleanType()),
    T.StructField("unit_cost", T.DoubleType()), T.StructField("regular_retail_price", T.DoubleType()),
    T.StructField("minimum_margin_pct", T.DoubleType()), T.StructField("minimum_advertised_price", T.DoubleType()),
    T.StructField("supplier", T.StringType()), T.StructField("lead_time_days", T.IntegerType()),
    T.StructField("case_pack", T.IntegerType()), T.StructField("product_age_weeks", T.IntegerType()),
    T.StructField("lifecycle_stage", T.StringType()), T.StructField("base_demand", T.DoubleType()),
    T.StructField("true_price_elasticity", T.DoubleType()), T.StructField("seasonality_strength", T.DoubleType()),
    T.StructField("inventory_holding_cost", T.DoubleType()), T.StructField("obsolescence_risk", T.DoubleType()),
    T.StructField("minimum_order_quantity", T.IntegerType()),
])

_SALES_FIELDS = [
    ("week_start", T.DateType()), ("week_num", T.IntegerType()), ("sku_id", T.StringType()),
    ("category", T.StringType()), ("region", T.StringType()), ("customer_tier", T.StringType()),
    ("unit_cost", T.DoubleType()), ("regular_price", T.DoubleType()), ("realized_price", T.DoubleType()),
    ("competitor_price", T.DoubleType()), ("customer_tier_discount_pct", T.DoubleType()),
    ("competitor_price_index", T.DoubleType()), ("promotion_flag", T.BooleanType()),
    ("promotion_depth", T.DoubleType()), ("seasonality_index", T.DoubleType()),
    ("economic_demand_index", T.DoubleType()), ("beginning_inventory", T.DoubleType()), ("receipts", T.DoubleType()),
    ("units_sold", T.DoubleType()), ("latent_demand", T.DoubleType()), ("lost_sales_estimate", T.DoubleType()),
    ("ending_inventory", T.DoubleType()), ("on_order", T.DoubleType()), ("revenue", T.DoubleType()),
    ("cogs", T.DoubleType()), ("gross_profit", T.DoubleType()), ("gross_margin_pct", T.DoubleType()),
    ("weeks_of_cover", T.DoubleType()), ("stockout_flag", T.BooleanType()), ("excess_inventory_flag", T.BooleanType()),
    ("slow_moving_flag", T.BooleanType()), ("price_change_reason", T.StringType()), ("price_test_flag", T.BooleanType()),
    ("policy_version", T.StringType()),
]
SALES_SCHEMA = T.StructType([T.StructField(n, t) for n, t in _SALES_FIELDS])

DECISION_LOG_SCHEMA = T.StructType([
    T.StructField("sku_id", T.StringType()), T.StructField("decision", T.StringType()),
    T.StructField("override_price", T.DoubleType()), T.StructField("note", T.StringType()),
    T.StructField("logged_at", T.LongType()),
])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder among the session's tables."""
    return f"{table_dir(spark)}/shelfwise-io/{name}-{uuid.uuid4().hex}"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def read_products(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    r = spark.read.schema(PRODUCTS_SCHEMA)
    return r.option("header", True).csv(path) if fmt == "csv" else r.parquet(path)


def read_sales(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    r = spark.read.schema(SALES_SCHEMA)
    return r.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path) if fmt == "csv" else r.parquet(path)


def read_first_available(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """First existing of the candidate sales locations (latest / app / full); error if none."""
    for p in paths:
        if _exists(spark, p):
            return read_sales(spark, p, fmt)
    raise FileNotFoundError(f"no sales data at any of {paths}")


DECISION_TABLES = ("recommendations", "transfers", "inventory_metrics", "elasticity_estimates", "backtest_results")


def write_decisions(base: str, tables: dict[str, DataFrame], fmt: str = "parquet") -> dict[str, str]:
    """Write each decision table; an empty one replaces the last run's; recommendations partitioned by category."""
    out = {}
    for name, df in tables.items():
        if df is None:
            continue
        out[name] = write_table(df, f"{base}/{name}", fmt, ["category"] if name == "recommendations" else None)
    return out


def read_decisions(spark: SparkSession, base: str, schemas: dict[str, T.StructType], fmt: str = "parquet") -> dict:
    """Reload written tables; optional ones that are missing become empty frames with their schema."""
    out = {}
    for name, schema in schemas.items():
        p = f"{base}/{name}"
        if _exists(spark, p):
            out[name] = spark.read.parquet(p) if fmt == "parquet" else spark.read.schema(schema).option("header", True).csv(p)
        else:
            out[name] = spark.createDataFrame([], schema)
    return out


def derive_decision_log(joint: DataFrame) -> DataFrame:
    """Reviewer log derived from the queue: a first 'Reject', then 'Approve' (or an override) when lift > 0.

    Append-only rows (sku_id, decision, override_price, note, logged_at); several
    entries per SKU exercise last-write-wins.
    """
    base = joint.filter(F.col("manual_review_required") | F.col("recommendation_action").isin("Increase", "Decrease"))
    first = base.select("sku_id", F.lit("Reject").alias("decision"), F.lit(None).cast("double").alias("override_price"),
                        F.concat_ws(" ", F.lit("first pass"), F.col("region"), F.col("customer_tier")).alias("note"),
                        F.lit(1).cast("long").alias("logged_at"))
    second = base.filter(F.col("gross_profit_lift") > 0).select(
        "sku_id", F.when(F.col("price_change_pct") > 0.05, "Override").otherwise("Approve").alias("decision"),
        F.when(F.col("price_change_pct") > 0.05, F.col("current_price")).alias("override_price"),
        F.concat_ws(" ", F.lit("review"), F.col("region"), F.col("customer_tier")).alias("note"),
        (F.lit(1) + F.row_number().over(Window.partitionBy("sku_id").orderBy("region", "customer_tier")))
        .cast("long").alias("logged_at"))
    return first.unionByName(second)
