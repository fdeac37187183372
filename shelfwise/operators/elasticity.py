"""Segment price elasticities from one-pass moments.

The ridge fit  log1p(units+lost) ~ log(price) + competitor index + promo depth +
seasonality  (alpha = 1, free intercept) only needs the centred second moments
of each segment: A = n*C + alpha*I, b = n*cov(x, y).  All three levels (global,
category x tier, category x region x tier) come from ONE grouping-sets aggregate;
partial aggregation runs map-side, so a hot segment never reaches one task as
raw rows.  The 4x4 system is solved by an unrolled Cholesky factorisation in
column expressions — no UDF, no collect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.config import (CUSTOMER_TIERS, ELASTICITY_BANDS, ELASTICITY_CLIP, MIN_FIT_ROWS, MIN_QUALITY_ROWS,
                              MIN_SEGMENT_ROWS, QUALITY_REASONS)
from shelfwise.functions.columns import clip, r6

PREDICTORS = ["log_price", "competitor_price_index", "promotion_depth", "seasonality_index"]
ALPHA = 1.0
INITIAL_GLOBAL = -1.0
SEG_COLS = ["elasticity_segment", "category", "region", "customer_tier", "estimated_elasticity",
            "sample_size", "price_variation", "standard_error", "confidence_score",
            "estimation_level", "elasticity_class"]


def quality_rows() -> Column:
    """Price tests and reviewed prices, without stockout, with more than two weeks of cover."""
    return ((F.col("price_test_flag") | F.col("price_change_reason").isin(*QUALITY_REASONS))
            & ~F.col("stockout_flag") & (F.col("weeks_of_cover") > 2))


def elasticity_sample(panel: DataFrame, min_rows: int = MIN_QUALITY_ROWS) -> DataFrame:
    """Quality rows (price tests / reviewed prices, no stockout, cover > 2); all non-stockout rows if < min_rows."""
    quality = quality_rows()
    n = panel.agg(F.count(F.when(quality, 1)).alias("_n_quality"))
    out = panel.crossJoin(F.broadcast(n))  # 1-row side
    keep = F.when(F.col("_n_quality") >= min_rows, quality).otherwise(~F.col("stockout_flag"))
    return out.filter(keep).drop("_n_quality")


def elasticity_log_transform(sample: DataFrame) -> DataFrame:
    lost = F.col("lost_sales_estimate") if "lost_sales_estimate" in sample.columns else F.lit(0.0)
    return sample.withColumns({
        "log_units": F.log1p(F.col("units_sold") + lost),
        "log_price": F.log(F.greatest(F.col("realized_price"), F.lit(0.01))),
    })


def segment_moments(est: DataFrame) -> DataFrame:
    """count, price sd and all centred second moments for the three grouping levels."""
    x = PREDICTORS
    aggs = [F.count(F.lit(1)).alias("n"), F.stddev_samp("log_price").alias("price_sd"),
            F.var_pop("log_units").alias("vyy")]
    for i in range(4):
        aggs.append(F.covar_pop(x[i], "log_units").alias(f"cy{i}"))
        for j in range(i, 4):
            aggs.append(F.covar_pop(x[i], x[j]).alias(f"c{i}{j}"))
    g = est.groupingSets(
        [["category", "region", "customer_tier"], ["category", "customer_tier"], []],
        "category", "region", "customer_tier",
    ).agg(*aggs, F.grouping_id().alias("gid"))
    level = (F.when(F.col("gid") == 0, "category_region_tier")
             .when(F.col("gid") == 2, "category_tier").otherwise("global"))
    return g.withColumn("level", level).drop("gid")


def ridge_slope(df: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Adds beta_0..beta_3 and rss: Cholesky solve of (n C + alpha I) w = n c_xy per row."""
    n = F.col("n").cast("double")

    def a(i, j):
        i, j = min(i, j), max(i, j)
        v = n * F.col(f"c{i}{j}")
        return v + alpha if i == j else v

    cols = {}
    L: dict[tuple[int, int], Column] = {}
    for j in range(4):
        s = a(j, j)
        for k in range(j):
            s = s - F.col(f"L{j}{k}") * F.col(f"L{j}{k}")
        cols[f"L{j}{j}"] = F.sqrt(s)
        df = df.withColumn(f"L{j}{j}", cols[f"L{j}{j}"])
        for i in range(j + 1, 4):
            s = a(i, j)
            for k in range(j):
                s = s - F.col(f"L{i}{k}") * F.col(f"L{j}{k}")
            df = df.withColumn(f"L{i}{j}", s / F.col(f"L{j}{j}"))
    for i in range(4):
        s = n * F.col(f"cy{i}")
        for k in range(i):
            s = s - F.col(f"L{i}{k}") * F.col(f"z{k}")
        df = df.withColumn(f"z{i}", s / F.col(f"L{i}{i}"))
    for i in reversed(range(4)):
        s = F.col(f"z{i}")
        for k in range(i + 1, 4):
            s = s - F.col(f"L{k}{i}") * F.col(f"beta_{k}")
        df = df.withColumn(f"beta_{i}", s / F.col(f"L{i}{i}"))
    wb = sum((F.col(f"beta_{i}") * n * F.col(f"cy{i}") for i in range(4)), F.lit(0.0))
    ww = sum((F.col(f"beta_{i}") * F.col(f"beta_{i}") for i in range(4)), F.lit(0.0))
    df = df.withColumn("rss", F.greatest(F.lit(0.0), n * F.col("vyy") - wb - ww * alpha))
    return df.drop(*[f"L{i}{j}" for i in range(4) for j in range(i + 1)], *[f"z{i}" for i in range(4)])


def _fit_columns(prior: Column) -> dict:
    """elasticity, price variation, se, confidence with the n<10 and flat-price fallbacks."""
    n = F.col("n")
    small = n < MIN_FIT_ROWS
    flat = F.col("price_sd") < 0.01
    el = F.when(small | flat, prior).otherwise(clip(F.col("beta_0"), *ELASTICITY_CLIP))
    var = F.when(small, 0.0).otherwise(F.col("price_sd"))
    se = F.when(small, 1.0).when(flat, 0.5).otherwise(F.sqrt(F.col("rss") / n) / F.sqrt(n.cast("double")))
    conf = F.when(small, 0.2).when(flat, 0.3).otherwise(
        F.least(F.lit(1.0), n / 200.0) * F.least(F.lit(1.0), F.col("price_sd") / 0.1))
    return {"estimated_elasticity": r6(el), "price_variation": r6(var), "standard_error": r6(se),
            "confidence_score": r6(conf)}


def elasticity_class_col(el: Column, conf: Column) -> Column:
    expr = F.when((conf < 0.4) | el.isNull() | F.isnan(el), "Low confidence")
    for name, lo, hi in ELASTICITY_BANDS:
        expr = expr.when((el >= lo) & (el < hi), name)
    return expr.otherwise("Moderate")


def elasticity_fit_global(moments: DataFrame) -> DataFrame:
    """One row always: without a sample the initial value stands."""
    one = moments.sparkSession.range(1).select(F.lit("global").alias("_at"))
    fitted = moments.filter(F.col("level") == "global")
    g = ridge_slope(one.join(fitted, one["_at"] == fitted["level"], "left").withColumn("n", F.coalesce(F.col("n"), F.lit(0))))
    return g.select(F.lit("global").alias("estimation_level"), F.col("n").alias("sample_size"),
                    *[v.alias(k) for k, v in _fit_columns(F.lit(INITIAL_GLOBAL)).items()])


def _fit_segments(moments: DataFrame, products: DataFrame) -> DataFrame:
    glob = elasticity_fit_global(moments).select(F.col("estimated_elasticity").alias("_global"))
    fitted = ridge_slope(moments.filter(F.col("level") != "global"))
    cats = products.select("category").distinct()
    tiers = products.sparkSession.createDataFrame([(t,) for t in CUSTOMER_TIERS], "customer_tier string")
    ct_cells = cats.crossJoin(tiers).withColumn("level", F.lit("category_tier"))  # dims only: |categories| x 3
    ct = ct_cells.join(fitted.filter(F.col("level") == "category_tier").drop("region"),
                       ["category", "customer_tier", "level"], "left") \
        .withColumn("region", F.lit("All")).withColumn("n", F.coalesce(F.col("n"), F.lit(0)))
    crt = fitted.filter((F.col("level") == "category_region_tier") & (F.col("n") >= MIN_SEGMENT_ROWS))
    seg = ct.unionByName(crt).crossJoin(F.broadcast(glob))  # 1-row side
    fit = _fit_columns(F.col("_global"))
    seg = seg.select(
        F.when(F.col("level") == "category_tier", F.concat_ws(" × ", "category", "customer_tier"))
        .otherwise(F.concat_ws(" × ", "category", "region", "customer_tier")).alias("elasticity_segment"),
        "category", "region", "customer_tier", F.col("n").cast("long").alias("sample_size"),
        F.col("level").alias("estimation_level"), "_global", *[v.alias(k) for k, v in fit.items()])
    return seg


def panel_moments(panel: DataFrame) -> DataFrame:
    """Sample -> log transform -> grouping-sets moments (one pass over the panel)."""
    return segment_moments(elasticity_log_transform(elasticity_sample(panel)))


def elasticity_table(panel: DataFrame, products: DataFrame, shrink: bool = True,
                     moments: DataFrame | None = None) -> DataFrame:
    """Full estimate table: category x tier (every cell) + category x region x tier (n >= MIN_SEGMENT_ROWS)."""
    seg = _fit_segments(moments if moments is not None else panel_moments(panel), products)
    seg = seg.withColumn("elasticity_class", elasticity_class_col(F.col("estimated_elasticity"), F.col("confidence_score")))
    if shrink:
        seg = elasticity_shrink(seg)
    return seg.select(*SEG_COLS)


def elasticity_shrink(seg: DataFrame) -> DataFrame:
    """conf < .4: conf*beta + (1-conf)*global, clipped; class Low confidence."""
    low = F.col("confidence_score") < 0.4
    shrunk = r6(clip(F.col("confidence_score") * F.col("estimated_elasticity")
                     + (F.lit(1.0) - F.col("confidence_score")) * F.col("_global"), *ELASTICITY_CLIP))
    return seg.withColumns({
        "estimated_elasticity": F.when(low, shrunk).otherwise(F.col("estimated_elasticity")),
        "elasticity_class": F.when(low, "Low confidence").otherwise(F.col("elasticity_class")),
    })


def global_elasticity(panel: DataFrame, moments: DataFrame | None = None) -> DataFrame:
    return elasticity_fit_global(moments if moments is not None else panel_moments(panel))


def elasticity_lookup(rows: DataFrame, table: DataFrame, glob: DataFrame) -> DataFrame:
    """category x region x tier, else category x All x tier, else the global prior (conf .3, n 0).

    The estimate table is bounded by the segment dimensions; AQE turns both
    joins into broadcast joins from the measured size.
    """
    keep = ["estimated_elasticity", "confidence_score", "sample_size", "price_variation",
            "elasticity_class", "estimation_level"]
    crt = table.filter(F.col("estimation_level") == "category_region_tier").select(
        "category", "region", "customer_tier", F.struct(*keep).alias("_crt"))
    ct = table.filter(F.col("region") == "All").select(
        "category", "customer_tier", F.struct(*keep).alias("_ct"))
    g = glob.select(F.struct(
        F.col("estimated_elasticity"), F.lit(0.3).alias("confidence_score"), F.lit(0).cast("long").alias("sample_size"),
        F.lit(0.0).alias("price_variation"), F.lit("Low confidence").alias("elasticity_class"),
        F.lit("global_prior").alias("estimation_level")).alias("_g"))
    out = rows.join(crt, ["category", "region", "customer_tier"], "left") \
        .join(ct, ["category", "customer_tier"], "left").crossJoin(F.broadcast(g))
    pick = F.coalesce("_crt", "_ct", "_g")
    return out.withColumn("_el", pick).select(
        *[c for c in out.columns if c not in ("_crt", "_ct", "_g")],
        *[F.col(f"_el.{k}").alias("el_" + k) for k in keep])


def elasticity_reload(table: DataFrame) -> DataFrame:
    """Reloaded table: derive a missing class; global = 'global' row, else the median estimate."""
    if "elasticity_class" not in table.columns:
        table = table.withColumn("elasticity_class",
                                 elasticity_class_col(F.col("estimated_elasticity"), F.col("confidence_score")))
    g = table.agg(
        F.coalesce(F.max(F.when(F.col("estimation_level") == "global", F.col("estimated_elasticity"))),
                   F.median("estimated_elasticity")).alias("global_elasticity"))
    return table.crossJoin(F.broadcast(g))
