"""The decision log as a stream: last write wins per SKU.

The streaming aggregate keeps one row per SKU in Spark's state store: the greatest entry in a total
order (logged_at, sequence, then the fields themselves). A greatest element does not depend on the
order, the split or the repetition of its inputs, so late rows, replays and any batching give
the same table. State grows with the SKUs, not with the log; no watermark is needed.

Every micro-batch writes the SKUs that it changed to a folder of its batch number, replaced if the batch
is replayed. ``current`` takes each SKU's greatest entry over the folders.

Nulls: a null time or sequence comes before all others; entries without a SKU form one of their own.
Logs without a ``sequence`` have 0 there. Columns besides the log's are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "sku_id string, decision string, override_price double, note string, logged_at long, sequence long"
#: The total order, and all fields of an entry.
ENTRY = ["logged_at", "sequence", "note", "decision", "override_price"]


def last_decisions(log: DataFrame) -> DataFrame:
    """(sku_id, logged_at, sequence, note, decision, override_price): each SKU's last entry, of a table
    or of a stream."""
    if "sequence" not in log.columns:
        log = log.withColumn("sequence", F.lit(0).cast("long"))
    return log.groupBy("sku_id").agg(F.max(F.struct(*ENTRY)).alias("_last")).select("sku_id", "_last.*")


def read_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def start_decisions(log: DataFrame, path: str, checkpoint: str):
    """Keep ``path`` up to date with a streaming log; stops when all that is there has been read."""
    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return (last_decisions(log).writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def current(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``start_decisions`` keeps: one row per SKU."""
    return last_decisions(spark.read.schema(LOG_SCHEMA).parquet(path))
