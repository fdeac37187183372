"""Results from kept states equal those from whole tables, whatever the order and split of the input."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import cube, elasticity as el, features as ft, reports as rp, states as es, tails
from shelfwise.sources.io import scratch_path
from shelfwise.streaming import decisions as ds

LEVEL = ["level", "category", "region", "customer_tier"]


def _table(df, keys, digits=None):
    def value(v):
        return round(v, digits) if digits is not None and isinstance(v, float) else v
    rows = {tuple(r[k] for k in keys): {c: value(r[c]) for c in df.columns if c not in keys} for r in df.collect()}
    return rows


def _close(a, b):
    assert a.keys() == b.keys()
    for k, row in a.items():
        assert row.keys() == b[k].keys()
        for c, v in row.items():
            w = b[k][c]
            assert v == w or (v is not None and w is not None and abs(v - w) <= 1e-9 * max(1.0, abs(w))), (k, c, v, w)


# ---- moment states

@pytest.mark.parametrize("min_rows", [1, 10**9])
def test_moments_of_states(spark, small_pipe, min_rows):
    """Both samples: quality rows only, and all rows without stockout."""
    panel = small_pipe.panel
    sample = el.elasticity_log_transform(el.elasticity_sample(panel, min_rows))
    _close(_table(es.moments(es.period_states(panel), min_rows), LEVEL), _table(el.segment_moments(sample), LEVEL))


def test_states_merge_in_any_split(spark, small_pipe):
    states = es.period_states(small_pipe.panel)
    whole = es.merged(states, ["kind"])
    third = F.pmod(F.hash("week_num", "region"), F.lit(3))
    parts = es.merged(states.withColumn("third", third), ["third", "kind"])
    _close(_table(es.merged(parts, ["kind"]), ["kind"]), _table(whole, ["kind"]))


def test_refresh_replaces_periods(spark, small_pipe):
    panel, path = small_pipe.panel, scratch_path(spark, "states")
    mid = panel.agg(F.max("week_num")).first()[0] // 2
    es.refresh(spark, path, panel.withColumn("units_sold", F.col("units_sold") + F.when(F.col("week_num") == mid, 7).otherwise(0)))
    states = es.refresh(spark, path, panel.where(F.col("week_num") == mid))
    _close(_table(es.moments(states), LEVEL), _table(el.panel_moments(panel), LEVEL))


def test_states_odd_rows(spark, small_pipe):
    panel = small_pipe.panel
    assert es.moments(es.period_states(panel.limit(0))).count() == 0
    # a constant shift of a value moves means only; nulls count as rows, not in the moments
    some = panel.withColumn("competitor_price_index", F.when(F.col("week_num") % 2 == 0, F.col("competitor_price_index")))
    got = {r["level"]: r for r in es.moments(es.period_states(some), 1).where("level = 'global'").collect()}["global"]
    even = {r["level"]: r for r in es.moments(es.period_states(panel.where("week_num % 2 = 0")), 1).where("level = 'global'").collect()}["global"]
    assert got["n"] > even["n"] and got["c11"] == pytest.approx(even["c11"]) and got["cy1"] == pytest.approx(even["cy1"])
    far = panel.withColumn("competitor_price_index", F.col("competitor_price_index") + 1e6)
    near = es.moments(es.period_states(panel), 1).where("level = 'global'").first()
    assert es.moments(es.period_states(far), 1).where("level = 'global'").first()["c11"] == pytest.approx(near["c11"], rel=1e-6)


# ---- tails

def test_tail_features(spark, small_pipe):
    panel, products = small_pipe.panel, small_pipe.products
    last = panel.agg(F.max("week_num")).first()[0]
    old, path = panel.where(F.col("week_num") < last - 2), scratch_path(spark, "tail")
    # two periods one after the other, then two at once
    state = tails.advance(tails.advance(tails.tail_state(old), panel.where(F.col("week_num") == last - 2)), panel.where("1 = 0"))
    state.write.parquet(path)
    state = spark.read.parquet(path)
    assert state.groupBy(*ft.GROUP_COLS).count().agg(F.max("count")).first()[0] <= tails.TAIL_ROWS
    new = scratch_path(spark, "new")
    panel.where(F.col("week_num") >= last - 1).write.parquet(new)
    got = tails.next_features(state, spark.read.parquet(new), products)
    want = ft.build_features(panel, products).where(F.col("week_num") >= last - 1)
    assert got.count() > 0 and set(got.columns) == set(want.columns)
    cols = [*tails.AT, *ft.NUMERIC_FEATURES, "adjusted_units"]
    _close(_table(got.select(*dict.fromkeys(cols)), tails.AT), _table(want.select(*dict.fromkeys(cols)), tails.AT))
    read = {f.split("/")[-2] for f in got.inputFiles()}
    assert {path.split("/")[-1], new.split("/")[-1]} <= read and not any("panel" in f for f in read)


def test_tail_late_rows(spark, small_pipe):
    panel, products = small_pipe.panel, small_pipe.products
    last = panel.agg(F.max("week_num")).first()[0]
    # the state saw a wrong row of the period before the last, and missed one of the period before that
    wrong = panel.where((F.col("week_num") < last) & (F.col("week_num") != last - 2)).withColumn(
        "units_sold", F.when(F.col("week_num") == last - 1, F.col("units_sold") + 100).otherwise(F.col("units_sold")))
    new = panel.where(F.col("week_num") >= last - 2)
    got = tails.next_features(tails.tail_state(wrong), new, products).where(F.col("week_num") == last)
    want = ft.build_features(panel, products).where(F.col("week_num") == last)
    cols = [*tails.AT, *ft.FILL_ZERO]
    _close(_table(got.select(*cols), tails.AT), _table(want.select(*cols), tails.AT))
    assert tails.next_features(tails.tail_state(panel), new, products).count() == 0
    _close(_table(tails.advance(tails.tail_state(wrong), new), tails.AT), _table(tails.tail_state(panel), tails.AT))


# ---- cube

def test_cube_slices(spark, small_pipe):
    p = small_pipe
    # kept as tables, as a dashboard would
    jc, sc = (p._mat(c, n) for c, n in ((cube.joint_cube(p.joint), "joint_cube"), (cube.stock_cube(p.inventory_status, p.panel), "stock_cube")))
    first = p.joint.select("region", "category", "customer_tier").orderBy("region", "category", "customer_tier").first()
    regions = [r[0] for r in p.joint.select("region").distinct().orderBy("region").limit(2).collect()]
    for members in ({}, {"region": first["region"]}, {"region": regions, "customer_tier": first["customer_tier"]}, first.asDict(),
                    {"customer_tier": "All", "category": [first["category"]] * 2}):
        want = rp.kpi_headline(rp.slice_filter(p.joint, **members), rp.slice_filter(p.inventory_status, **members), p.panel).first().asDict()
        got = cube.slice_kpis(jc, sc, **members).first().asDict()
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k] or 0, rel=1e-9, abs=1e-9) for k in want), (members, got, want)
    nothing = cube.slice_kpis(jc, sc, region="no such region").first().asDict()
    assert set(nothing.values()) == {0}
    with pytest.raises(ValueError):
        cube.slice_kpis(jc, sc, brand="x")
    assert cube.all_slices(jc, sc).count() == jc.count()


# ---- decision stream

def _log(spark):
    rows = [("a", "Reject", None, "n1", 1, 0), ("a", "Approve", None, "n2", 3, 0), ("a", "Override", 9.5, "late", 2, 5),
            ("b", "Reject", None, None, 4, 1), ("b", "Approve", None, "x", 4, 2), ("b", "Approve", None, "x", 4, 2),
            ("c", "Approve", 1.0, "p", None, None), ("c", "Reject", None, "q", 0, None), (None, "Reject", None, "z", 1, 1),
            ("d", "Approve", None, "m", 7, 1), ("d", "Reject", None, "m", 7, 1)]
    return spark.createDataFrame(rows, ds.LOG_SCHEMA)


@pytest.mark.parametrize("order", ["logged_at", "-logged_at", "hash(note)"])
def test_decisions_in_any_order(spark, order):
    log, out, mark = (scratch_path(spark, x) for x in ("log", "out", "mark"))
    rows = _log(spark).orderBy(F.expr(order), "note", "decision").collect()
    cuts = [rows[:3], rows[3:4], rows[4:], rows[2:6]]  # the last file repeats entries
    for k, part in enumerate(cuts):
        spark.createDataFrame(part, ds.LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log)
        if k in (1, 3):  # stopped and started again from its checkpoint
            ds.start_decisions(ds.read_log_stream(spark, log, 1), out, mark).awaitTermination()
    want = _table(ds.last_decisions(_log(spark)), ["sku_id"])
    assert _table(ds.current(spark, out), ["sku_id"]) == want
    assert want[("a",)]["decision"] == "Approve" and want[("b",)]["sequence"] == 2 and want[("c",)]["logged_at"] == 0
    assert want[("d",)]["decision"] == "Reject" and (None,) in want


def test_replayed_batch(spark):
    """A batch that is written twice leaves the table as it was."""
    out = scratch_path(spark, "out")
    for _ in range(2):
        ds.last_decisions(_log(spark)).write.mode("overwrite").parquet(f"{out}/batch=0")
    assert _table(ds.current(spark, out), ["sku_id"]) == _table(ds.last_decisions(_log(spark)), ["sku_id"])
    assert ds.last_decisions(_log(spark).limit(0)).count() == 0
    assert _table(ds.last_decisions(_log(spark).drop("sequence")), ["sku_id"])[("a",)]["sequence"] == 0
