"""The stateless panel derivations on a Structured Streaming source.

The reference has no streaming path.  Its row-level derivations (money,
competitor index, stock flags, censoring) are narrow column functions, so they
apply unchanged to a streaming DataFrame; the product master joins as a static
side (stream-static join, no state).  Aggregating operators stay batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.operators import panel_ops as po
from shelfwise.sources.io import SALES_SCHEMA


def read_sales_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 16) -> DataFrame:
    """File stream of weekly sales rows (parquet) with the explicit panel schema."""
    return spark.readStream.schema(SALES_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def derive_stream(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Recompute money, competitor index and stock flags for every arriving row."""
    df = po.sales_financials(sales)
    df = po.competitor_index(df)
    return po.panel_stock_flags(df.drop("stockout_flag", "excess_inventory_flag", "slow_moving_flag"), products)


def start_derivation(sales: DataFrame, products: DataFrame, out_path: str, checkpoint: str):
    """Append the derived rows to parquet; the checkpoint makes restarts exactly-once for the file sink."""
    return (derive_stream(sales, products).writeStream.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
