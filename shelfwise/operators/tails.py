"""Features of new periods from a tail state: the last 13 rows of every series.

Lags and rolling means look back 13 rows at most, so the tail and the new rows are all that a new
period needs; older periods are not read. The state has at most 13 narrow rows a series.

Late rows: a row whose period the state knows replaces it, one between known periods is put in its
place, and later features and the next state count with it; but late rows get no features
themselves (their own history may have left the state: rebuild those from the panel). New series start
without a tail. Empty new rows give no features and leave the state as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from shelfwise.operators.features import GROUP_COLS, LAGS, build_features

TAIL_ROWS = max(LAGS)
MEASURES = ["units_sold", "revenue", "gross_margin_pct", "ending_inventory", "realized_price"]
AT = [*GROUP_COLS, "week_num"]


def tail_state(rows: DataFrame) -> DataFrame:
    """The last ``TAIL_ROWS`` rows of every series, with the columns that features look back at."""
    last = W.partitionBy(*GROUP_COLS).orderBy(F.desc("week_num"))
    return (rows.select(*AT, *MEASURES).withColumn("_at", F.row_number().over(last))
            .where(F.col("_at") <= TAIL_ROWS).drop("_at"))


def _kept(state: DataFrame, new: DataFrame) -> DataFrame:
    """The state's rows that the new ones do not replace."""
    return state.join(new.select(*AT).distinct(), AT, "left_anti")


def advance(state: DataFrame, new: DataFrame) -> DataFrame:
    """The state after the new rows."""
    return tail_state(_kept(state, new).unionByName(new.select(*AT, *MEASURES)))


def next_features(state: DataFrame, new: DataFrame, products: DataFrame) -> DataFrame:
    """The features of the new rows that are later than their series' state, as ``build_features``
    gives them over the whole panel."""
    known = state.groupBy(*GROUP_COLS).agg(F.max("week_num").alias("_known"))
    marked = new.join(known, GROUP_COLS, "left").withColumn("_new", F.col("_known").isNull() | (F.col("week_num") > F.col("_known")))
    rows = marked.drop("_known").unionByName(_kept(state, new).withColumn("_new", F.lit(False)), allowMissingColumns=True)
    return build_features(rows, products).where("_new").drop("_new")
