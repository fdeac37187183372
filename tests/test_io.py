"""Readers and sinks: explicit schemas, first-available probe, optional tables, decision log."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators.reports import latest_decisions
from shelfwise.sources import io as sio


def test_products_csv_round_trip(spark, small_pipe):
    path = sio.write_table(small_pipe.products, sio.scratch_path(spark, "t-products"), "csv")
    back = sio.read_products(spark, path, "csv")
    assert back.schema == sio.PRODUCTS_SCHEMA
    assert back.exceptAll(small_pipe.products.select(*back.columns)).count() == 0


def test_first_available_picks_first_existing_and_errors_when_none(spark, small_pipe):
    base = sio.scratch_path(spark, "t-first")
    sio.write_table(small_pipe.panel, f"{base}/app", "parquet")
    got = sio.read_first_available(spark, [f"{base}/latest", f"{base}/app", f"{base}/full"])
    assert got.count() == small_pipe.panel.count()
    with pytest.raises(FileNotFoundError):
        sio.read_first_available(spark, [f"{base}/nothing-here"])


def test_missing_optional_tables_become_empty_frames(spark, small_pipe):
    base = sio.scratch_path(spark, "t-decisions")
    written = sio.write_decisions(base, {"recommendations": small_pipe.joint,
                                         "transfers": small_pipe.transfers.limit(0)})
    assert "transfers" in written  # an empty table replaces an earlier run's
    back = sio.read_decisions(spark, base, {"recommendations": small_pipe.joint.schema,
                                            "transfers": small_pipe.transfers.schema})
    assert back["transfers"].count() == 0 and back["transfers"].schema == small_pipe.transfers.schema
    assert back["recommendations"].count() == small_pipe.joint.count()


def test_decision_log_last_write_wins(spark):
    log = spark.createDataFrame(
        [("A", "Reject", None, "n1", 1), ("A", "Approve", None, "n2", 3), ("A", "Override", 9.99, "n3", 2),
         ("B", "Reject", None, "m", 1)], sio.DECISION_LOG_SCHEMA)
    got = {r["sku_id"]: (r["decision"], r["note"]) for r in latest_decisions(log).collect()}
    assert got == {"A": ("Approve", "n2"), "B": ("Reject", "m")}


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    p = sio.scratch_path(spark, "x")
    assert p.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
