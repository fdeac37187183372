"""Model matrix: numeric features, and one-hot slots from a stored category dictionary.

The dictionary holds the levels of the train rows, sorted; the first of each feature has no slot. A
level that is not in it (new in validation, test or scoring data) and a null have zeros in all slots
of their feature, as a missing number counts as 0. Fit and scoring share one dictionary, so a
category seen late cannot stop a job or shift a column. Its size is that of the dimensions
(categories, regions, tiers, stages), so it travels as constants of the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.features import CATEGORICAL_FEATURES, NUMERIC_FEATURES


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Encoding:
    """Columns of the model matrix; ``slots`` are (feature, level) pairs in order."""
    numeric: tuple[str, ...]
    slots: tuple[tuple[str, str], ...]

    @staticmethod
    def fit(train: DataFrame, numeric=tuple(NUMERIC_FEATURES), categorical=tuple(CATEGORICAL_FEATURES)) -> Encoding:
        found = train.agg(*(F.sort_array(F.collect_set(F.col(c).cast("string"))).alias(c) for c in categorical)).first()  # one row per dimension level
        return Encoding(tuple(numeric), tuple((c, level) for c in categorical for level in found[c][1:]))

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *(f"{c}={level}" for c, level in self.slots)]

    def sql(self, i: int, replace: dict[str, str] | None = None) -> str:
        """Matrix column ``i`` as a SQL expression; ``replace`` gives other expressions for features."""
        if i < len(self.numeric):
            name = self.numeric[i]
            return f"coalesce(cast({(replace or {}).get(name, f'`{name}`')} as double), 0D)"
        c, level = self.slots[i - len(self.numeric)]
        return f"if(`{c}` <=> {sql_text(level)}, 1D, 0D)"

    def columns(self) -> list[Column]:
        return [F.expr(self.sql(i)) for i in range(len(self.names))]

    def matrix(self, df: DataFrame) -> DataFrame:
        """``df`` with its matrix row as the array ``x``."""
        return df.withColumn("x", F.array(*self.columns()))

    def to_rows(self) -> list[tuple[str, str | None, int]]:
        """(feature, level, position); numbers have no level."""
        both = [*((c, None) for c in self.numeric), *self.slots]
        return [(c, level, i) for i, (c, level) in enumerate(both)]

    @staticmethod
    def from_rows(rows: list) -> Encoding:
        rows = sorted(rows, key=lambda r: r["position"])
        return Encoding(tuple(r["feature"] for r in rows if r["level"] is None), tuple((r["feature"], r["level"]) for r in rows if r["level"] is not None))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.to_rows(), "feature string, level string, position int").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Encoding:
        return Encoding.from_rows(spark.read.parquet(path).collect())  # one row per matrix column


def summed(df: DataFrame, of: Callable[[pa.RecordBatch], tuple[np.ndarray, ...]], sums: list[str]) -> tuple[np.ndarray, ...]:
    """Table of sums by cell. ``of(batch)`` gives (cells, a column per sum) for an Arrow batch of a task;
    a task adds them up and hands on one row a cell, Spark adds the tasks up. The number of cells must
    not depend on the rows (bins of a model, pairs of columns): the table comes to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for b in batches:
            held.append(of(b))
            cells, where = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            added = []
            for k in range(1, len(sums) + 1):
                total = np.zeros(len(cells), held[0][k].dtype)
                np.add.at(total, where, np.concatenate([h[k] for h in held]))
                added.append(total)
            held = [(cells, *added)]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held[0][0].astype(np.int64)), *(pa.array(v) for v in held[0][1:])], names=["cell", *(s.split()[0] for s in sums)])
    names = [s.split()[0] for s in sums]
    table = df.mapInArrow(run, ", ".join(["cell long", *sums])).groupBy("cell").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
    return tuple(table[c].to_numpy() for c in ["cell", *names])
