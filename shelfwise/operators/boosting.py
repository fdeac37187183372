"""Gradient boosting on distributed histograms, and its trees as Catalyst expressions.

Fit. Each numeric feature is cut once into at most ``bins`` bins; a row becomes a fixed number of cells:
(feature, bin) of every numeric feature and the slot, if any, of every category. Rows lie as blocks of
NumPy arrays in a persisted RDD, which spares every tree level a query plan. Per level one job sums
gradients and counts by (node, cell): tasks add up their blocks. Of up to ``FEW`` tasks the driver adds
these tables of nodes x bins and chooses the splits, which takes one stage; of two children tasks count the
smaller one then, and the other's sums are the difference to their parent's. The tables of more tasks are
dealt by feature and added in turn, and the best split of those features is chosen there: the driver gets
one candidate split per node and share of the features. Either way a table's size does not depend on the data.

Gradients are summed as integers (millionths), so a fit does not depend on partitions or on the order
of sums, and equals a plain NumPy version of the same rules exactly.

Rules: squared error, ``depth`` levels, shrinkage ``rate``, at least ``min_leaf`` rows on both sides, the
largest gain, ties to the lower feature, then the lower bin. A split sends x < threshold to the left.

Scoring. ``expression`` is the whole ensemble as one SQL expression over the feature columns, whose size does
not grow with the nodes: they are constant arrays. Features can be replaced, so that prices inside an array
are scored by ``transform`` without exploding rows.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.encoding import Encoding
from shelfwise.session import stored_table

SCALE = 1_000_000
#: Trees after which predictions are written out, so that lost blocks are soon computed again.
STEP = 25
#: Tables of sums, of some 5 MB at most, that the driver adds up by itself.
FEW = 16


@dataclass(frozen=True)
class Rules:
    trees: int = 100
    depth: int = 6
    rate: float = 0.1
    bins: int = 255
    min_leaf: int = 20


@dataclass(frozen=True)
class Split:
    """A node of a tree: leaves have a value, others a matrix column, threshold and two children."""
    feature: int = -1
    threshold: float = 0.0
    bin: int = 0
    gain: float = 0.0
    left: int = -1
    right: int = -1
    value: float = 0.0


def bin_edges(train: DataFrame, encoding: Encoding, bins: int) -> list[np.ndarray]:
    """Increasing cut points of every numeric feature: approximate quantiles, at most ``bins`` - 1."""
    at = ", ".join(f"{k / bins!r}D" for k in range(1, bins))
    every = range(len(encoding.numeric))
    found = train.agg(*(F.expr(f"percentile_approx({encoding.sql(i)}, array({at}), 10000) as q{i}") for i in every),
                      *(F.min(F.expr(encoding.sql(i))).alias(f"m{i}") for i in every)).first()
    # a cut at the least value would leave the left side empty
    return [np.array([x for x in np.unique(np.array(found[f"q{i}"], float)) if x > found[f"m{i}"]]) if found[f"q{i}"] is not None else np.empty(0) for i in every]


def best_splits(node: np.ndarray, cell: np.ndarray, grad: np.ndarray, count: np.ndarray, totals: tuple[np.ndarray, np.ndarray],
                n_numeric: int, width: int, min_leaf: int) -> dict[int, tuple[float, int, int, int, int]]:
    """{node: (gain, matrix column, bin, gradient left, rows left)} from the histogram table, whose rows
    ascend by node and cell; ``totals`` are the gradient and rows of every node."""
    if not len(node):
        return {}
    group = node * (1 << 32) + cell // width
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    g, n = np.cumsum(grad), np.cumsum(count)
    before = np.repeat(first, np.diff(np.r_[first, len(group)]))
    g, n = g - (g[before] - grad[before]), n - (n[before] - count[before])  # up to and with this bin
    total_g, total_n = totals[0][node], totals[1][node]
    feature, b = cell // width, cell % width
    hot = feature >= n_numeric  # only set slots have cells: the left side is what remains
    gl, nl = np.where(hot, total_g - grad, g), np.where(hot, total_n - count, n)
    gr, nr = total_g - gl, total_n - nl
    ok = (nl >= min_leaf) & (nr >= min_leaf)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl.astype(float) ** 2 / nl + gr.astype(float) ** 2 / nr - total_g.astype(float) ** 2 / total_n
    at = np.flatnonzero(ok & (gain > 1e-9 * SCALE))
    at = at[np.lexsort((at, -gain[at], node[at]))]  # cells ascend: the first of equal gains stays
    at = at[np.flatnonzero(np.r_[True, node[at][1:] != node[at][:-1]])] if len(at) else at
    return {int(node[i]): (float(gain[i]), int(feature[i]), int(b[i]) + (0 if hot[i] else 1), int(gl[i]), int(nl[i])) for i in at}


def grow(search, n_numeric: int, edges: list[np.ndarray], rules: Rules) -> list[Split]:
    """One tree. ``search(tree, live)`` gives {node: (gradient, rows)} and the best splits of the nodes
    ``live``, which are leaves so far."""
    tree = [Split()]
    live = [0]
    for _ in range(rules.depth):
        totals, found = search(tree, live)
        if len(tree) == 1 and totals:
            tree[0] = Split(value=-rules.rate * totals[0][0] / totals[0][1] / SCALE)
        live = []
        for v, (gain, feature, b, gl, nl) in sorted(found.items()):
            g, n = totals[v]
            threshold = float(edges[feature][b - 1]) if feature < n_numeric else 0.5
            left = len(tree)
            tree[v] = Split(feature, threshold, b, gain / SCALE / SCALE, left, left + 1)
            tree += [Split(value=-rules.rate * gl / nl / SCALE), Split(value=-rules.rate * (g - gl) / (n - nl) / SCALE)]
            live += [left, left + 1]
        if not live:
            break
    return tree


@dataclass(frozen=True)
class Cells:
    """Where a matrix column lies in a block, whose rows are the data's columns: numeric feature ``i`` in block
    row ``i`` as cell i * width + bin; a one-hot slot as its own cell in the block row of its category, which
    holds ``none`` if no slot is set."""
    n_numeric: int
    width: int
    kind_of: tuple[int, ...]  # category of every slot

    @property
    def first(self) -> int:
        return self.n_numeric * self.width

    @property
    def none(self) -> int:
        return self.first + len(self.kind_of)

    def nodes(self, tree: list[Split], cells: np.ndarray) -> np.ndarray:
        """The leaf of every row of a block."""
        at = np.zeros(cells.shape[1], np.int64)
        f = np.array([s.feature for s in tree])
        slot = f >= self.n_numeric
        column = np.array([0 if s.feature < 0 else s.feature if s.feature < self.n_numeric else self.n_numeric + self.kind_of[s.feature - self.n_numeric] for s in tree])
        cut = np.where(slot, self.first + f - self.n_numeric, f * self.width + np.array([s.bin for s in tree]))
        left, right = np.array([s.left for s in tree]), np.array([s.right for s in tree])
        rows = np.arange(cells.shape[1])
        while len(rows):
            rows = rows[f[at[rows]] >= 0]
            v = at[rows]
            x = cells[column[v], rows]
            at[rows] = np.where(np.where(slot[v], x != cut[v], x < cut[v]), left[v], right[v])
        return at

    def span_of(self, row: int) -> tuple[int, int]:
        """The first cell of a block row and the cell after its last."""
        return (row * self.width, (row + 1) * self.width) if row < self.n_numeric else (self.first, self.none + 1)

    def after(self, tree: list[Split], p: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Predictions ``p`` with those of one more tree."""
        return p + np.array([s.value for s in tree])[self.nodes(tree, cells)]


def _once(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, evaluated once. Lambdas are evaluated as they stand: an
    ensemble is too long for one generated method."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _constant(values: list, kind: str) -> str:
    """An array of numbers as one SQL literal, which costs the parser and the optimizer one node."""
    return f"cast(split('{' '.join(map(str, values))}', ' ') as array<{kind}>)"


def _finite(x: float) -> float:
    return float(x) if np.isfinite(x) else 0.0


def _number(x: float) -> str:
    return f"{_finite(x)!r}D"


@dataclass(frozen=True)
class BoostedTrees:
    encoding: Encoding
    base: float
    trees: list[list[Split]] = field(repr=False)
    rules: Rules = Rules()
    kind: str = "gbt"

    def expression(self, replace: dict[str, str] | None = None) -> str:
        """The prediction as SQL; ``replace`` gives other expressions for numeric features. The nodes of all trees
        are constant arrays, through which a row goes level by level; leaves stay where they are."""
        if not self.trees:
            return _number(self.base)
        used = sorted({s.feature for t in self.trees for s in t if s.feature >= 0})
        place = {f: i for i, f in enumerate(used)}
        roots, nodes, height = [], [], 0
        for tree in self.trees:
            at, level = len(nodes), [0] * len(tree)
            roots.append(at)
            for v, s in enumerate(tree):  # children come after their parent
                inner = s.feature >= 0
                if inner:
                    level[s.left] = level[s.right] = level[v] + 1
                nodes.append((place[s.feature] if inner else 0, _finite(s.threshold), at + (s.left if inner else v), at + (s.right if inner else v), _finite(s.value)))
            height = max(height, *level)
        feature, threshold, left, right, value = (_constant(list(c), kind) for c, kind in zip(zip(*nodes, strict=True), ("int", "double", "int", "int", "double"), strict=True))
        leaf = f"aggregate(sequence(1, {height}), v, (at, _) -> if(x[{feature}[at]] < {threshold}[at], {left}[at], {right}[at]))" if used else "v"
        terms = [f"t[{i}]" for i in range(len(self.trees))]
        while len(terms) > 1:  # a balanced sum
            terms = [f"({' + '.join(terms[i:i + 2])})" for i in range(0, len(terms), 2)]
        values = f"transform({_constant(roots, 'int')}, v -> {value}[{leaf}])"
        scored = _once("t", values, f"({_number(self.base)} + {terms[0]})")
        return _once("x", f"array({', '.join(self.encoding.sql(i, replace) for i in used)})", scored) if used else scored

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.expr(self.expression()))

    def importance(self) -> list[tuple[str, float]]:
        """Total gain by matrix column, as shares."""
        gain = np.zeros(len(self.encoding.names))
        for t in self.trees:
            for s in t:
                if s.feature >= 0:
                    gain[s.feature] += s.gain
        return list(zip(self.encoding.names, (gain / (gain.sum() or 1.0)).tolist(), strict=True))

    def save(self, spark: SparkSession, path: str) -> None:
        self.encoding.save(spark, f"{path}/encoding")
        rows = [(t, v, s.feature, s.threshold, s.bin, s.gain, s.left, s.right, s.value) for t, tree in enumerate(self.trees) for v, s in enumerate(tree)]
        spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, bin int, gain double, left int, right int, value double") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        spark.createDataFrame([(self.kind, self.base, json.dumps(self.rules.__dict__))], "kind string, base double, rules string").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        head = spark.read.parquet(f"{path}/model").first()
        trees: dict[int, list[Split]] = {}
        for r in spark.read.parquet(f"{path}/trees").orderBy("tree", "node").collect():  # a row per node of the model
            trees.setdefault(r["tree"], []).append(Split(*(r[c] for c in ("feature", "threshold", "bin", "gain", "left", "right", "value"))))
        return BoostedTrees(Encoding.load(spark, f"{path}/encoding"), head["base"], [trees[t] for t in sorted(trees)], Rules(**json.loads(head["rules"])))


def fit_boosted_trees(train: DataFrame, label: str, rules: Rules = Rules(), encoding: Encoding | None = None) -> BoostedTrees:
    """Fits on every row of ``train``. No rows: a model without trees that predicts 0."""
    from pyspark.ml.feature import Bucketizer
    spark = train.sparkSession
    encoding = encoding or Encoding.fit(train)
    n_numeric, width = len(encoding.numeric), rules.bins + 1
    n_rows, base = train.agg(F.count(F.lit(1)), F.avg(label)).first()
    if base is None:
        return BoostedTrees(encoding, 0.0, [], rules)
    base = round(float(base), 6)  # the last digits of a mean depend on the order of its sum
    edges = bin_edges(train, encoding, rules.bins)

    cut = [i for i in range(n_numeric) if len(edges[i])]
    rows = train.select(F.col(label).cast("double").alias("y"), *(c.alias(f"x{i}") for i, c in enumerate(encoding.columns())))
    binned = Bucketizer(inputCols=[f"x{i}" for i in cut], outputCols=[f"b{i}" for i in cut], handleInvalid="keep",
                        splitsArray=[[-np.inf, *edges[i].tolist(), np.inf] for i in cut]).transform(rows) if cut else rows
    kinds = list(dict.fromkeys(c for c, _ in encoding.slots))
    layout = Cells(n_numeric, width, tuple(kinds.index(c) for c, _ in encoding.slots))
    numbers = [f"int({i * width} + b{i})" if i in set(cut) else f"{i * width}" for i in range(n_numeric)]
    slots = ["coalesce(" + ", ".join([*(f"if(x{n_numeric + k} = 1D, {layout.first + k}, null)" for k, of in enumerate(layout.kind_of) if of == j), f"{layout.none}"]) + ")"
             for j in range(len(kinds))]
    small, span = np.min_scalar_type(layout.none), layout.none + 1
    cores = spark.sparkContext.defaultParallelism
    parts = max(1, min(n_rows // 2_000, max(cores, n_rows // 200_000)))
    deal = min(parts, 8) if parts > FEW else 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            cells = np.ascontiguousarray(b.column(1).flatten().to_numpy().astype(small).reshape(len(y), n_numeric + len(kinds)).T)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((y, np.full(len(y), base), cells))], pa.binary())], names=["block"])

    def blocks(packed: DataFrame) -> RDD:
        return stored_table(packed, "boosting-rows").rdd.map(lambda r: pickle.loads(r[0])).persist(StorageLevel.MEMORY_AND_DISK)

    held = blocks(binned.select("y", F.expr(f"array({', '.join([*numbers, *slots])})").cast("array<int>").alias("cells"))
                  .repartition(parts).mapInArrow(pack, "block binary"))
    trees: list[list[Split]] = []
    old = None

    few = parts <= FEW
    kept: dict[int, tuple] = {}  # of every node split last: its gradient and rows, both by cell, and the rows left

    def search(tree: list[Split], live: list[int]):
        if len(tree) == 1:
            kept.clear()
        pairs = {v: (tree[v].left, tree[v].right) for v in kept}
        # of two children the smaller one is added up; the other's sums are what it leaves of their parent's
        counted = [p[0 if 2 * kept[v][3] <= kept[v][0][1] else 1] for v, p in pairs.items()] or live
        names, min_leaf = np.array(counted), rules.min_leaf

        place = np.full(len(tree), -1)
        place[names] = np.arange(len(names))

        def add_up(part):
            total, n = np.zeros((len(names), span), np.int64), np.zeros((len(names), span), np.int64)
            sums = np.zeros((2, len(names)), np.int64)
            for y, p, cells in part:
                at = place[layout.nodes(tree, cells)]
                here = np.flatnonzero(at >= 0)
                every = len(here) == len(at)
                at = at[here]
                g = np.floor((p[here] - y[here]) * SCALE + 0.5)
                for row, cell in enumerate(cells):  # one by one, as a row's sums fit the processor's cache
                    low, high = layout.span_of(row)
                    cell = at * (high - low) + ((cell if every else cell[here]).astype(np.int64) - low)
                    shape = len(names), high - low
                    # integers below 2**53: exact
                    total[:, low:high] += np.bincount(cell, g, shape[0] * shape[1]).reshape(shape).astype(np.int64)
                    n[:, low:high] += np.bincount(cell, minlength=shape[0] * shape[1]).reshape(shape)
                sums += np.array([np.bincount(at, g, len(names)), np.bincount(at, minlength=len(names))]).astype(np.int64)
            total, n = total.ravel(), n.ravel()
            k = np.flatnonzero(n)
            k = k[k % span != layout.none]
            feature = np.where(k % span < layout.first, k % span // width, k % span - layout.first + n_numeric)
            for share in range(deal):
                of = k[feature % deal == share] if deal > 1 else k
                yield share, (sums, of.astype(np.min_scalar_type(len(n))), total[of], n[of].astype(np.min_scalar_type(n.max(initial=0))))

        def added(part):
            """(gradient and rows, both by cell) of the nodes ``names``."""
            total, n = np.zeros(len(names) * span, np.int64), np.zeros(len(names) * span, np.int64)
            sums = np.zeros((2, len(names)), np.int64)
            for _, (s, k, g, c) in part:
                sums += s
                total[k] += g
                n[k] += c
            return sums, total.reshape(-1, span), n.reshape(-1, span)

        def best(sums, total, n):
            total, n = total.ravel(), n.ravel()
            k = np.flatnonzero(n)
            cell = k % span
            cell = np.where(cell < layout.first, cell, layout.first + (cell - layout.first) * width)
            return sums, best_splits(k // span, cell, total[k], n[k], (sums[0], sums[1]), n_numeric, width, min_leaf)

        tables = held.mapPartitions(add_up)
        if few:
            sums, total, n = added(tables.collect())  # a table a task
            if kept:
                of = {v: (sums[:, i], total[i], n[i]) for i, v in enumerate(counted)}
                for v, (left, right) in pairs.items():
                    known, other = (left, right) if left in of else (right, left)
                    of[other] = tuple(a - b for a, b in zip(kept[v], of[known], strict=False))
                sums, total, n = np.array([of[v][0] for v in live]).T, np.array([of[v][1] for v in live]), np.array([of[v][2] for v in live])
            shares = [best(sums, total, n)]
            kept.clear()
            kept.update({live[i]: (sums[:, i], total[i], n[i], s[4]) for i, s in sorted(shares[0][1].items())})
        else:
            shares = tables.partitionBy(deal, lambda share: share).mapPartitions(lambda part: [best(*added(part))]).collect()  # a row a share
        totals = {live[i]: (int(g), int(n)) for i, (g, n) in enumerate(shares[0][0].T) if n}
        found: dict[int, tuple[float, int, int, int, int]] = {}
        for _, splits in shares:
            for i, s in splits.items():
                if live[i] not in found or (-s[0], s[1]) < (-found[live[i]][0], found[live[i]][1]):
                    found[live[i]] = s
        return totals, found

    for k in range(rules.trees):
        tree = grow(search, n_numeric, edges, rules)
        trees.append(tree)
        if old:
            old.unpersist()  # the first level of this tree has computed what follows from it
        old = held
        if k + 1 < rules.trees:
            done = held.map(lambda r, tree=tree: (r[0], layout.after(tree, r[1], r[2]), r[2]))
            held = done.persist(StorageLevel.MEMORY_AND_DISK) if (k + 1) % STEP else blocks(spark.createDataFrame(done.map(lambda r: (pickle.dumps(r),)), "block binary"))
    held.unpersist()
    return BoostedTrees(encoding, base, trees, rules)
