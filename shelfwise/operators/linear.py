"""Ridge and elastic net from one Gram matrix.

All that a linear fit needs of the rows are sums of products, which merge: ``moments`` computes them in
two aggregates over the train rows (means and spreads, then products of standardised columns),
with partial sums in the tasks. The fits themselves run on the columns x columns matrix and never
touch the rows again: ridge is one solve, elastic net is coordinate descent with covariance
updates. A fitted model is a sum of columns, evaluated inside whatever plan uses it.

Columns without spread (a category that train never varies) get the coefficient 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.encoding import Encoding, summed


@dataclass(frozen=True)
class Moments:
    """Rows, means and population deviations of the matrix columns and the label, and the products of
    the standardised columns: ``gram`` = Z'Z / n, ``cross`` = Z'(y - mean) / n."""
    n: int
    mean: np.ndarray
    sd: np.ndarray
    label_mean: float
    gram: np.ndarray
    cross: np.ndarray

    def merged(self, other: Moments) -> Moments:
        """Moments of both sets of rows together, by the pairwise rule for means and co-moments."""
        if not self.n or not other.n:
            return self if self.n else other
        n = self.n + other.n
        a, b = self.n / n, other.n / n
        d, dy = other.mean - self.mean, other.label_mean - self.label_mean
        raw = lambda m: (m.gram * np.outer(m.sd, m.sd), m.cross * m.sd)
        (g0, c0), (g1, c1) = raw(self), raw(other)
        g, c = a * g0 + b * g1 + a * b * np.outer(d, d), a * c0 + b * c1 + a * b * d * dy
        sd = np.sqrt(np.maximum(np.diag(g), 0))
        unit = np.where(sd > 0, sd, 1.0)
        return Moments(n, self.mean + b * d, sd, self.label_mean + b * dy, g / np.outer(unit, unit), c / unit)


def moments(train: DataFrame, label: str, encoding: Encoding) -> Moments:
    """Two aggregates; the second is of columns x columns products, whatever the rows."""
    k = len(encoding.names)
    x = train.select(*(c.alias(f"x{i}") for i, c in enumerate(encoding.columns())), F.col(label).cast("double").alias("y"))
    one = x.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"), *(f(f"x{i}").alias(f"{t}{i}") for i in range(k) for f, t in ((F.avg, "m"), (F.stddev_pop, "s")))).first()
    if not one["n"]:
        return Moments(0, np.zeros(k), np.zeros(k), 0.0, np.zeros((k, k)), np.zeros(k))
    mean, sd = np.array([one[f"m{i}"] for i in range(k)]), np.array([one[f"s{i}"] for i in range(k)])
    sd = np.where(sd > 1e-12 * np.maximum(1.0, np.abs(mean)), sd, 0.0)
    live = np.flatnonzero(sd > 0).tolist()
    z = [f"(x{i} - {float(mean[i])!r}D) / {float(sd[i])!r}D" for i in live]
    z = x.select(F.expr(f"array({', '.join([*z, 'y - ' + repr(float(one['y'])) + 'D'])})").alias("z"))
    width = len(live) + 1

    def products(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        v = b.column(0).flatten().to_numpy().reshape(-1, width)
        return np.arange(width * width), (v.T @ v).ravel()
    cell, total = summed(z, products, ["total double"])
    table = np.zeros(width * width)
    table[cell] = total / one["n"]
    table = table.reshape(width, width)
    gram, cross = np.zeros((k, k)), np.zeros(k)
    gram[np.ix_(live, live)], cross[live] = (table[:-1, :-1] + table[:-1, :-1].T) / 2, table[:-1, -1]
    return Moments(one["n"], mean, sd, one["y"], gram, cross)


def ridge(m: Moments, alpha: float = 1.0) -> np.ndarray:
    """Coefficients of the standardised columns: least squares plus alpha |w|^2."""
    if not m.n:
        return np.zeros(len(m.sd))
    return np.linalg.solve(m.n * m.gram + alpha * np.eye(len(m.sd)), m.n * m.cross)


def elastic_net(m: Moments, alpha: float = 0.1, l1_ratio: float = 0.5, tolerance: float = 1e-12, most_rounds: int = 100_000) -> np.ndarray:
    """Minimiser of |y - Zw|^2 / 2n + alpha (l1_ratio |w|_1 + (1 - l1_ratio) |w|^2 / 2): coordinates in
    turn, the correlations with the residual being updated from the Gram matrix."""
    w, rest = np.zeros(len(m.sd)), m.cross.copy()  # rest = Z'(y - Zw) / n
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    scale = max(float(np.abs(m.cross).max(initial=0.0)), 1e-300)
    for _ in range(most_rounds):
        moved = 0.0
        for j in np.flatnonzero(m.sd > 0):
            full = rest[j] + m.gram[j, j] * w[j]
            new = np.sign(full) * max(abs(full) - l1, 0.0) / (m.gram[j, j] + l2)
            if new != w[j]:
                rest -= m.gram[:, j] * (new - w[j])
                moved, w[j] = max(moved, abs(new - w[j])), new
        if moved <= tolerance * scale:
            return w
    raise RuntimeError("coordinate descent did not converge")


@dataclass(frozen=True)
class LinearModel:
    """Prediction = intercept + sum of coefficient x (column - mean) / deviation."""
    encoding: Encoding
    mean: np.ndarray
    sd: np.ndarray
    coefficients: np.ndarray
    intercept: float
    kind: str

    def expression(self, replace: dict[str, str] | None = None) -> str:
        terms = [f"{float(w)!r}D * (({self.encoding.sql(i, replace)}) - {float(m)!r}D) / {float(s)!r}D"
                 for i, (w, m, s) in enumerate(zip(self.coefficients, self.mean, self.sd, strict=True)) if w and s]
        return " + ".join([f"{float(self.intercept)!r}D", *terms])

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.expr(self.expression()))

    def importance(self) -> list[tuple[str, float]]:
        return list(zip(self.encoding.names, np.abs(self.coefficients).tolist(), strict=True))

    def save(self, spark: SparkSession, path: str) -> None:
        self.encoding.save(spark, f"{path}/encoding")
        rows = list(enumerate(zip(self.mean.tolist(), self.sd.tolist(), self.coefficients.tolist(), strict=True)))
        spark.createDataFrame([(i, *v) for i, v in rows], "position int, mean double, sd double, coefficient double").coalesce(1).write.mode("overwrite").parquet(f"{path}/coefficients")
        spark.createDataFrame([(self.kind, float(self.intercept))], "kind string, base double").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearModel:
        head = spark.read.parquet(f"{path}/model").first()
        rows = sorted(spark.read.parquet(f"{path}/coefficients").collect())  # one row per matrix column
        mean, sd, w = (np.array([r[c] for r in rows]) for c in ("mean", "sd", "coefficient"))
        return LinearModel(Encoding.load(spark, f"{path}/encoding"), mean, sd, w, head["base"], head["kind"])


def fit_linear(train: DataFrame, label: str, kind: str, encoding: Encoding | None = None) -> LinearModel:
    """``kind`` ridge (alpha 1) or elasticnet (alpha 0.1, l1 ratio 0.5)."""
    encoding = encoding or Encoding.fit(train)
    m = moments(train, label, encoding)
    return LinearModel(encoding, m.mean, m.sd, ridge(m) if kind == "ridge" else elastic_net(m), m.label_mean, kind)


def scaled_columns(df: DataFrame, m: Moments, encoding: Encoding) -> list[str]:
    """SQL of every matrix column, standardised by the train rows (0 without spread)."""
    return [f"(({encoding.sql(i)}) - {float(a)!r}D) / {float(s)!r}D" if s else "0D" for i, (a, s) in enumerate(zip(m.mean, m.sd, strict=True))]
