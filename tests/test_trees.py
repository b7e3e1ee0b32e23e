import numpy as np
import pyarrow as pa
import pytest

from wideloom.operators import trees as TR


def frame(spark, x, y):
    return spark.createDataFrame(pa.table({"v": pa.array(list(x)), "y": pa.array(y)})).repartition(5)


def data(n=400):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 6))
    x[:, 5] = 1.0  # constant
    return x, (x[:, 2] > 0.3).astype(int) + (x[:, 4] > 0.8)


def plain(x, y, trees, depth, m):
    """One tree at a time, rows handed down from node to node."""
    p, gains = x.shape[1], []
    for t in range(trees):
        gain = np.zeros(p)
        todo = [(0, np.arange(len(x)), 0)]
        while todo:
            i, rows, level = todo.pop()
            if level == depth or len(set(y[rows])) < 2:
                continue
            node = np.array([[t, i]])
            best = None
            for f in TR.candidates(node, p, m)[0]:
                v = x[rows, f]
                cut = v.min() + TR.draw(np.array([t]), np.array([i]), np.array([f]), 1)[0] * (v.max() - v.min())
                right = v > cut
                if not right.any() or right.all():
                    continue
                gini = lambda r: len(r) - sum(c * c for c in np.bincount(r)) / len(r)
                drop = gini(y[rows]) - gini(y[rows][right]) - gini(y[rows][~right])
                if best is None or drop > best[0] + 1e-9:
                    best = drop, f, right
            if best:
                gain[best[1]] += best[0]
                todo += [(2 * i + 1, rows[~best[2]], level + 1), (2 * i + 2, rows[best[2]], level + 1)]
        gains.append(gain / gain.sum() if gain.sum() else gain)
    return np.mean(gains, axis=0)


def test_importances_against_plain_trees(spark):
    x, y = data()
    forest = TR.extra_trees(frame(spark, x, y), "v", "y", trees=5, depth=4)
    np.testing.assert_allclose(forest.importance, plain(x, y, 5, 4, 2), atol=1e-9)
    assert forest.importance[5] == 0


def test_trees_learn(spark):
    x, y = data()
    df = frame(spark, x, y)
    forest = TR.extra_trees(df, "v", "y", trees=20, depth=8)
    assert set(np.argsort(-forest.importance)[:2]) == {2, 4}
    rows = df.withColumn("p", forest.probabilities("v")).collect()
    assert np.mean([np.argmax(r["p"]) == r["y"] for r in rows]) > 0.9


def test_one_class_and_too_many(spark):
    x, _ = data(30)
    forest = TR.extra_trees(frame(spark, x, np.zeros(30, int)), "v", "y", trees=3)
    assert (forest.importance == 0).all()
    with pytest.raises(ValueError):
        TR.extra_trees(frame(spark, x, np.arange(30)), "v", "y", trees=3, max_classes=10)
