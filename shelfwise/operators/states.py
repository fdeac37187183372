"""Elasticities from stored moment states: one row per period, segment and kind of row.

A state holds a group's row count, means and co-moments (sums of products of deviations from the
group's own means) of the log units and the four predictors. States of any disjoint groups merge
into the state of their union, so a new period costs one aggregate over its own rows, a corrected one
replaces its own partition, and a refit reads states only (periods x segments x 3 kinds, whatever
the rows). Merging is centred: the means are merged first, then every co-moment gets what the distance
of its group's means from them adds; no large sums cancel.

Kinds: ``quality`` rows, ``other`` rows without stockout, and ``out`` (the rest, which no fit uses, kept
so that a period whose rows were all corrected still replaces its partition). Which kinds the fit
reads depends on the number of quality rows in all periods, as in ``elasticity_sample``.
Rows with a null in one of the five values count as rows but take no part in the moments. A null
segment key is a segment of its own. Empty states: no moments, so the global prior stands.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.config import MIN_QUALITY_ROWS
from shelfwise.operators.elasticity import PREDICTORS, elasticity_log_transform, quality_rows

VALUES = [*PREDICTORS, "log_units"]
SEGMENT = ["category", "region", "customer_tier"]
PAIRS = [(a, b) for i, a in enumerate(VALUES) for b in VALUES[i:]]


def _mean(c: str) -> str:
    return f"mean_{c}"


def _co(a: str, b: str) -> str:
    return f"co_{a}_{b}"


def period_states(panel: DataFrame) -> DataFrame:
    """(week_num, category, region, customer_tier, kind, n, m, means, co-moments) of the panel's rows;
    ``n`` counts rows, ``m`` those without nulls. Partial sums collapse a hot segment before the shuffle."""
    rows = elasticity_log_transform(panel)
    whole = reduce(Column.__and__, (F.col(c).isNotNull() for c in VALUES))
    value = {c: F.when(whole, F.col(c).cast("double")) for c in VALUES}
    kind = F.when(quality_rows(), "quality").when(~F.col("stockout_flag"), "other").otherwise("out")
    m = F.count(F.when(whole, 1))
    return rows.withColumn("kind", kind).groupBy("week_num", *SEGMENT, "kind").agg(
        F.count(F.lit(1)).alias("n"), m.alias("m"), *(F.avg(value[c]).alias(_mean(c)) for c in VALUES),
        *((F.covar_pop(value[a], value[b]) * m).alias(_co(a, b)) for a, b in PAIRS))


def merged(states: DataFrame, by: list[str]) -> DataFrame:
    """The states of the groups ``by``, from the states of their parts."""
    total = states.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("m").alias("m"),
                                    *((F.sum(F.col(_mean(c)) * F.col("m")) / F.sum("m")).alias(_mean(c)) for c in VALUES))
    part, whole = states.alias("p"), total.select(*by, *(_mean(c) for c in VALUES)).alias("t")
    same = reduce(Column.__and__, (F.col(f"p.{k}").eqNullSafe(F.col(f"t.{k}")) for k in by))
    off = {c: F.col(f"p.{_mean(c)}") - F.col(f"t.{_mean(c)}") for c in VALUES}
    co = part.join(whole, same).groupBy(*(F.col(f"p.{k}").alias(k) for k in by)).agg(
        *(F.sum(F.col(f"p.{_co(a, b)}") + F.col("p.m") * off[a] * off[b]).alias(_co(a, b)) for a, b in PAIRS))
    same = reduce(Column.__and__, (F.col(f"t.{k}").eqNullSafe(F.col(f"c.{k}")) for k in by))
    return total.alias("t").join(co.alias("c"), same).select("t.*", *(f"c.{_co(a, b)}" for a, b in PAIRS))


def moments(states: DataFrame, min_rows: int = MIN_QUALITY_ROWS) -> DataFrame:
    """What ``segment_moments`` gives for the elasticity sample of all periods, from their states."""
    enough = states.agg((F.coalesce(F.sum(F.when(F.col("kind") == "quality", F.col("n"))), F.lit(0)) >= min_rows).alias("_enough"))
    used = states.crossJoin(F.broadcast(enough)).where(  # 1-row side
        F.when(F.col("_enough"), F.col("kind") == "quality").otherwise(F.col("kind") != "out"))
    none = F.lit(None).cast("string")

    def level(name: str, *keys: Column) -> Column:
        return F.struct(F.lit(name).alias("level"), *(k.alias(c) for k, c in zip(keys, SEGMENT, strict=True)))
    category, region, tier = map(F.col, SEGMENT)
    levels = F.array(level("category_region_tier", category, region, tier), level("category_tier", category, none, tier),
                     level("global", none, none, none))
    used = used.withColumn("_at", F.explode(levels)).drop(*SEGMENT).select("*", "_at.*")
    out = merged(used, ["level", *SEGMENT])
    m = F.col("m")
    second = {"vyy": ("log_units", "log_units"), **{f"cy{i}": (x, "log_units") for i, x in enumerate(PREDICTORS)},
              **{f"c{i}{j}": (PREDICTORS[i], PREDICTORS[j]) for i in range(4) for j in range(i, 4)}}
    return out.select(*SEGMENT, "n", F.when(m > 1, F.sqrt(F.col(_co("log_price", "log_price")) / (m - 1))).alias("price_sd"),
                      *((F.col(_co(*ab)) / m).alias(name) for name, ab in second.items()), "level")


def refresh(spark: SparkSession, path: str, panel_rows: DataFrame) -> DataFrame:
    """Write the states of the periods in ``panel_rows`` (all rows of those periods), replacing these
    periods' partitions only, and return the states of all periods."""
    states = period_states(panel_rows)
    (states.repartition("week_num").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("week_num").parquet(path))
    return spark.read.schema(states.schema).parquet(path)
