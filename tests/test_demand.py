"""Demand models against plain NumPy versions of their rules."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import boosting, demand, linear
from shelfwise.operators.encoding import Encoding

NUMERIC, CATEGORICAL = ("a", "b", "c"), ("kind", "place")


def table(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n).round(3), rng.integers(0, 6, n).astype(float)
    kind, place = rng.choice(["u", "v", "w'x"], n), rng.choice(["p", "q"], n)
    y = np.round(3 * a + b + (kind == "v") * 4 + (a > 0.5) * b + rng.normal(size=n) * 0.1, 2)
    rows = [(float(p), float(q), 1.0, str(k), str(w), float(v)) for p, q, k, w, v in zip(a, b, kind, place, y, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, kind string, place string, y double")


def matrix(df, enc):
    rows = enc.matrix(df).select("x", "y").collect()
    return np.array([r.x for r in rows]), np.array([r.y for r in rows])


def test_encoding_takes_unseen_levels_and_nulls(spark, tmp_path):
    enc = Encoding.fit(table(spark), NUMERIC, CATEGORICAL)
    assert enc.names == ["a", "b", "c", "kind=v", "kind=w'x", "place=q"]
    enc.save(spark, f"file://{tmp_path}/enc")
    assert Encoding.load(spark, f"file://{tmp_path}/enc") == enc
    late = spark.createDataFrame([(1.0, None, 1.0, "brand new", None), (2.0, 3.0, 1.0, "w'x", "q"), (2.0, 3.0, 1.0, "u", "p")],
                                 "a double, b double, c double, kind string, place string")
    assert [r.x for r in enc.matrix(late).collect()] == [[1, 0, 1, 0, 0, 0], [2, 3, 1, 0, 1, 1], [2, 3, 1, 0, 0, 0]]


def test_ridge_and_elastic_net(spark, tmp_path):
    df = table(spark).repartition(5)
    enc = Encoding.fit(df, NUMERIC, CATEGORICAL)
    x, y = matrix(df, enc)
    sd = x.std(axis=0)
    z = np.where(sd > 0, (x - x.mean(axis=0)) / np.where(sd > 0, sd, 1), 0)
    m = linear.moments(df, "y", enc)
    want = np.linalg.solve(z.T @ z + np.eye(z.shape[1]), z.T @ (y - y.mean()))
    assert np.abs(linear.ridge(m) - want).max() < 1e-9 and m.sd[2] == 0
    w = linear.elastic_net(m, 0.1, 0.5)
    slope = z.T @ (y - y.mean() - z @ w) / len(y) - 0.05 * w  # KKT conditions
    assert np.abs(slope[w != 0] - 0.05 * np.sign(w[w != 0])).max() < 1e-8 and (np.abs(slope[w == 0]) <= 0.05 + 1e-8).all()
    parts = [linear.moments(df.where(F.col("b") % 3 == k), "y", enc) for k in range(3)]
    merged = parts[0].merged(parts[1]).merged(parts[2])
    assert merged.n == m.n and np.allclose(merged.gram, m.gram, atol=1e-9) and np.allclose(linear.ridge(merged), want, atol=1e-8)
    model = linear.fit_linear(df, "y", "ridge", enc)
    model.save(spark, f"file://{tmp_path}/m")
    again = demand.load_model(spark, f"file://{tmp_path}/m")
    got = again.predict(model.predict(df).withColumnRenamed("prediction", "first")).collect()
    assert all(r.first == r.prediction for r in got)
    assert np.allclose(sorted(r.prediction for r in got), np.sort(y.mean() + z @ want), atol=1e-8)


def numpy_trees(x, y, edges, rules, n_numeric):
    """The rules, row by row."""
    n, k = x.shape
    bins = np.column_stack([np.searchsorted(edges[i], x[:, i], side="right") if i < n_numeric else x[:, i].astype(int) for i in range(k)])
    base, trees = round(float(y.mean()), 6), []
    p = np.full(n, base)
    for _ in range(rules.trees):
        g = np.floor((p - y) * boosting.SCALE + 0.5).astype(np.int64)
        out = np.zeros(n)

        def split(rows, depth):
            total, count = int(g[rows].sum()), len(rows)
            best = None
            if depth < rules.depth:
                for f in range(k):
                    for b in sorted(set(bins[rows, f])):
                        left = rows[bins[rows, f] <= b] if f < n_numeric else rows[bins[rows, f] == 0]
                        if f >= n_numeric and b == 0:
                            continue
                        nl, gl = len(left), int(g[left].sum())
                        if nl < rules.min_leaf or count - nl < rules.min_leaf:
                            continue
                        gain = float(gl) ** 2 / nl + float(total - gl) ** 2 / (count - nl) - float(total) ** 2 / count
                        if gain > 1e-9 * boosting.SCALE and (best is None or gain > best[0]):
                            best = gain, f, left
            if best is None:
                out[rows] = -rules.rate * total / count / boosting.SCALE
                return
            split(best[2], depth + 1)
            split(np.setdiff1d(rows, best[2]), depth + 1)
        split(np.arange(n), 0)
        trees.append(out)
        p = p + out
    return p


def test_boosting_equals_numpy(spark, tmp_path):
    df = table(spark).repartition(4).cache()
    enc = Encoding.fit(df, NUMERIC, CATEGORICAL)
    rules = boosting.Rules(trees=3, depth=3, bins=16, min_leaf=10)
    model = boosting.fit_boosted_trees(df, "y", rules, enc)
    x, y = matrix(df, enc)
    want = numpy_trees(x, y, boosting.bin_edges(df, enc, rules.bins), rules, 3)
    got = np.array([r.prediction for r in model.predict(enc.matrix(df)).select("prediction").collect()])
    assert np.abs(got - want).max() < 1e-9
    assert np.abs(got - y).mean() < 0.9 * np.abs(y - y.mean()).mean()
    assert boosting.fit_boosted_trees(df.repartition(1), "y", rules, enc).trees == model.trees  # whatever the partitions
    model.save(spark, f"file://{tmp_path}/m")
    assert demand.load_model(spark, f"file://{tmp_path}/m") == model
    assert abs(sum(v for _, v in model.importance()) - 1) < 1e-9
    nothing = boosting.fit_boosted_trees(df.limit(0), "y", rules, enc)
    assert nothing.predict(df).agg(F.max("prediction")).first()[0] == 0.0


def test_boosting_plans_no_query_per_level(spark, monkeypatch):
    """A level is one job over persisted blocks: the queries planned do not grow with the levels."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    df = table(spark).repartition(2).cache()
    enc = Encoding.fit(df, NUMERIC, CATEGORICAL)
    calls = []
    for name in ("toArrow", "collect", "first"):
        monkeypatch.setattr(Classic, name, lambda self, *a, _was=getattr(Classic, name), **k: calls.append(1) or _was(self, *a, **k))
    used = []
    for depth in (1, 5):
        calls.clear()
        model = boosting.fit_boosted_trees(df, "y", boosting.Rules(trees=boosting.STEP + 2, depth=depth, bins=16, min_leaf=5), enc)
        used.append(len(calls))
        x, y = matrix(df, enc)
    assert len(set(used)) == 1 and max(len(t) for t in model.trees) > 15
    want = numpy_trees(x, y, boosting.bin_edges(df, enc, 16), model.rules, 3)
    got = np.array([r.prediction for r in model.predict(enc.matrix(df)).select("prediction").collect()])
    assert np.abs(got - want).max() < 1e-9


def test_levels_over_few_blocks_shuffle_nothing(spark, monkeypatch):
    """The tables of few tasks are added by the driver in one stage, those of many by a shuffle: same trees."""
    from pyspark import RDD
    df = table(spark, n=9000).repartition(4).cache()
    enc = Encoding.fit(df, NUMERIC, CATEGORICAL)
    rules = boosting.Rules(trees=3, depth=4, bins=16, min_leaf=10)
    dealt = []
    monkeypatch.setattr(RDD, "partitionBy", lambda self, *a, _was=RDD.partitionBy: dealt.append(1) or _was(self, *a))
    model = boosting.fit_boosted_trees(df, "y", rules, enc)
    assert not dealt
    monkeypatch.setattr(boosting, "FEW", 1)
    assert boosting.fit_boosted_trees(df, "y", rules, enc).trees == model.trees and len(dealt) == 12


def test_only_smaller_children_are_counted(spark, monkeypatch):
    """Tasks add up one child of a split, the one with fewer rows; the other is the rest of its parent."""
    from pyspark import RDD
    df = table(spark, n=9000).repartition(4).cache()
    enc = Encoding.fit(df, NUMERIC, CATEGORICAL)
    seen = []

    def collect(self, _was=RDD.collect):
        out = _was(self)
        seen.append(sum(s for _, (s, *_) in out))
        return out
    monkeypatch.setattr(RDD, "collect", collect)
    model = boosting.fit_boosted_trees(df, "y", boosting.Rules(trees=2, depth=4, bins=16, min_leaf=10), enc)
    assert len(seen) == 8
    for tree, levels in zip(model.trees, (seen[:4], seen[4:]), strict=True):
        assert levels[0].shape[1] == 1 and levels[0][1].sum() == 9000
        assert sum(s.shape[1] for s in levels[1:]) <= sum(s.feature >= 0 for s in tree)
        assert all(s[1].sum() <= 4500 for s in levels[1:])


@pytest.mark.parametrize("kind", ["ridge", "gbt"])
def test_prices_are_scored_without_exploding(spark, kind):
    df = table(spark).withColumnsRenamed({"a": "realized_price", "b": "price_change_pct"}).withColumn("regular_price", F.abs("realized_price") + 1)
    enc = Encoding.fit(df, ("realized_price", "price_change_pct", "c"), CATEGORICAL)
    model = (linear.fit_linear(df, "y", kind, enc) if kind == "ridge" else boosting.fit_boosted_trees(df, "y", boosting.Rules(trees=4, depth=3), enc))
    out = demand.predict_at_price_model(model, df, F.array(*(F.lit(v) for v in (-0.5, 0.25, 1.5))))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Python" not in plan
    each = out.select("*", F.explode("model_sims").alias("s")).withColumn("realized_price", F.col("s.candidate_price")) \
        .withColumn("price_change_pct", F.col("s.candidate_price") / F.col("regular_price") - 1)
    rows = model.predict(each).select("s.predicted_units", "prediction").collect()
    assert len(rows) == 1200 and max(abs(r.predicted_units - max(r.prediction, 0)) for r in rows) < 1e-9


def test_scores_are_planned_and_computed_once(spark, monkeypatch):
    """Finding 4 to 6: the SQL of an ensemble does not grow with its nodes, prices are scored in several tasks,
    and the scored rows are stored."""
    df = table(spark).withColumnsRenamed({"a": "realized_price", "b": "price_change_pct"}).withColumn("regular_price", F.abs("realized_price") + 1)
    enc = Encoding.fit(df, ("realized_price", "price_change_pct", "c"), CATEGORICAL)
    model = boosting.fit_boosted_trees(df, "y", boosting.Rules(trees=6, depth=5, min_leaf=2), enc)
    assert sum(len(t) for t in model.trees) > 200 and model.expression().count("if(") < 2 * len(enc.names)
    out = demand.predict_at_price_model(model, df.orderBy("y").coalesce(1), F.array(F.lit(0.25), F.lit(1.5)))
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    rows = df.withColumns({c: F.lit("x") for c in ("split", "sku_id", "category", "region", "customer_tier")}).withColumns({
        "split": F.when(F.col("y") > 0, "test").otherwise("train"), "week_num": F.lit(1), demand.TARGET_COL: F.col("y")})
    monkeypatch.setattr(demand, "fit_model", lambda *a: model)
    _, metrics, preds = demand.train_evaluate(rows)
    for read in (metrics, preds):
        assert "transform" not in read._jdf.queryExecution().optimizedPlan().toString()
    assert preds.count() == rows.where("split = 'test'").count()
