"""The adapter counts every line, and helpers handle nulls and empty inputs."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.functions.columns import clip
from shelfwise.operators import elasticity as el
from shelfwise.operators import reports as rp
from shelfwise.sources import driver_tables as ad
from tests.conftest import SF_SMALL


def test_every_line_item_is_counted(spark):
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    for grain in ("brand_type", "part"):
        cells = ad.cell_demand(spark, SF_SMALL, grain)
        got = cells.agg(F.sum("n_lines"), F.sum("latent_demand"), F.max("week_num")).first()
        want = lines.agg(F.count(F.lit(1)), F.sum("l_quantity")).first()
        assert (got[0], got[1]) == (want[0], want[1]) and got[2] > 104
    skus = spark.read.parquet(f"{SF_SMALL}/part.parquet").count()
    assert ad.sku_dimension(spark, SF_SMALL, "part").select("sku_id").distinct().count() == skus


def test_unmatched_lines_are_kept_as_unknown(spark, tmp_path):
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        d = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        if t == "part":
            d = d.where("p_partkey > 20")
        if t == "orders":
            d = d.where("o_orderkey % 7 <> 0")
        if t == "customer":
            d = d.where("c_custkey % 5 <> 0")
        d.write.parquet(f"{tmp_path}/{t}.parquet")
    cells = ad.cell_demand(spark, str(tmp_path)).cache()
    lines = spark.read.parquet(f"{tmp_path}/lineitem.parquet").count()
    assert cells.agg(F.sum("n_lines")).first()[0] == lines
    assert cells.where("region = 'UNKNOWN'").count() and cells.where("sku_id = 'UNKNOWN|UNKNOWN'").count()
    assert ad.build_panel(cells, ad.build_products(spark, str(tmp_path), cells)).count() == cells.count()


def test_week_start_is_the_periods_first_day(small_pipe):
    rows = small_pipe.panel.select("week_num", "week_start").distinct().collect()
    assert {r.week_start for r in rows if r.week_num == 1} == {dt.date(1995, 1, 1)}
    assert all(r.week_start == dt.date(1995, 1, 1) + dt.timedelta(days=23 * (r.week_num - 1)) for r in rows)


def test_line_items_are_aggregated_once(spark):
    """One aggregate of lines, no join of part with itself."""
    plan = ad.cell_demand(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2 and plan.count("lineitem") <= 1  # the lines, and the first order date
    assert "Python" not in plan


def test_clip_and_histogram_leave_nulls_alone(spark):
    df = spark.createDataFrame([(None,), (-9.0,), (1.0,), (2.0,)], "x double")
    assert [r[0] for r in df.select(clip(F.col("x"), -3.0, -0.1)).collect()] == [None, -3.0, -0.1, -0.1]
    assert sum(r["count"] for r in rp.histogram(df, "x", 4).collect()) == 3


def test_no_sample_gives_the_initial_elasticity(small_pipe):
    panel = small_pipe.panel.withColumn("stockout_flag", F.lit(True))
    assert el.global_elasticity(panel).first()["estimated_elasticity"] == -1.0
    table = el.elasticity_table(panel, small_pipe.products)
    assert table.count() > 0 and table.where("estimated_elasticity <> -1.0").count() == 0


def test_reports_on_empty_slices(small_pipe):
    j = small_pipe.joint.limit(0)
    assert rp.margin_summary(j).first()["total_projected_gross_profit"] == 0.0
    assert rp.lost_sales_total(j).first()[0] == 0.0
    low = rp.elasticity_low_conf(small_pipe.elasticity.where("elasticity_class <> 'Low confidence'")).collect()
    assert len(low) == 1 and low[0]["low_confidence_count"] == 0
    assert rp.woc_and_status_top(small_pipe.inventory_status.limit(0)).count() == 1


def test_an_empty_transfer_table_replaces_the_old_one(spark, small_pipe, tmp_path):
    from shelfwise.sources import io as sio
    sio.write_decisions(str(tmp_path), {"transfers": small_pipe.transfers})
    sio.write_decisions(str(tmp_path), {"transfers": small_pipe.transfers.limit(0)})
    assert spark.read.parquet(f"{tmp_path}/transfers").count() == 0


def test_panel_joins_do_not_shuffle_the_cells(spark):
    """The measured indexes are stored first, so that the joins with them are planned without an exchange."""
    from shelfwise.plans.pipeline import Pipeline
    p, seen = Pipeline(spark, SF_SMALL), {}
    was = p._mat
    p._mat = lambda df, name: was(seen.setdefault(name, df), name)
    assert p.panel.count() == p.cells.count() > 0
    assert "hashpartitioning" not in seen["panel"]._jdf.queryExecution().executedPlan().toString()
    cells = seen["cells"].select("region_no", "region", "week_num", "week_start").distinct()
    assert cells.groupBy("region_no", "week_num").count().where("count > 1").isEmpty()


def test_cells_are_added_up_before_their_shuffle(spark, tmp_path):
    """Findings 11 to 14: a few tasks add up many lines each, tiers and flags travel as codes, and the
    sums are those of a plain join, also where flags are null or nothing matches."""
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        d = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        if t == "part":
            d = d.where("p_partkey > 20")
        if t == "orders":
            d = d.where("o_orderkey % 7 <> 0")
        if t == "lineitem":
            d = d.withColumns({c: F.when(F.col("l_suppkey") % 3 > 0, F.col(c)) for c in ("l_returnflag", "l_linestatus")})
        d.write.parquet(f"{tmp_path}/{t}.parquet")
    cells = ad.cell_demand(spark, str(tmp_path))
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce " in plan
    assert not any("hashpartitioning" in x and ("customer_tier" in x or "l_returnflag" in x) for x in plan.splitlines())
    orders, skus = ad.order_attributes(spark, str(tmp_path)), ad.sku_dimension(spark, str(tmp_path)).select("p_partkey", "sku_id")
    lines = spark.read.parquet(f"{tmp_path}/lineitem.parquet").join(orders, F.expr("l_orderkey = o_orderkey"), "left").join(skus, F.expr("l_partkey = p_partkey"), "left")
    want = lines.groupBy(F.coalesce("sku_id", F.lit("UNKNOWN|UNKNOWN")), F.coalesce("region", F.lit("UNKNOWN")), F.coalesce("customer_tier", F.lit("Trade"))).agg(
        F.sum("l_quantity"), F.count("*"), F.sum(F.expr("if(l_returnflag = 'R', l_quantity, 0D)")), F.sum(F.expr("if(l_linestatus = 'O', l_quantity, 0D)")), F.min("l_suppkey"))
    got = cells.groupBy("sku_id", "region", "customer_tier").agg(F.sum("latent_demand"), F.sum("n_lines"), F.sum("returned"), F.sum("open_units"), F.min("supplier_no"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
