"""Vector columns with holes, and the shared scan."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wideloom.functions.samples import hex_share, long_share, lowest
from wideloom.operators import gmm, kmeans, profile
from wideloom.operators import reduce as R
from wideloom.operators.rowsums import sum_rows, task_count
from wideloom.sources import tables as T


def frame(spark, vectors, parts=2):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "k long, v array<double>").repartition(parts)


BAD = {"null vector": [[1.0, 2.0], None, [3.0, 4.0]], "null entry": [[1.0, 2.0], [None, 1.0], [3.0, 4.0]],
       "nan": [[1.0, 2.0], [float("nan"), 1.0], [3.0, 5.0]], "ragged": [[1.0, 2.0], [3.0, 4.0, 5.0], [1.0, 1.0]]}


@pytest.mark.parametrize("what", BAD)
def test_fits_refuse_incomplete_vectors(spark, what):
    df = frame(spark, BAD[what] * 20, 1)
    for fit in (lambda: R.gram(df, "v"), lambda: kmeans.kmeans(df, "k", "v", 2, 1), lambda: gmm.gmm(df, "k", "v", 2)):
        with pytest.raises(Exception, match="null|NaN|width|unequal|impute"):
            fit()


def test_transforms_give_null_for_incomplete_vectors(spark):
    good = frame(spark, np.random.default_rng(1).normal(size=(50, 2)).tolist())
    p, m = R.pca(good, "v", 1), kmeans.kmeans(good, "k", "v", 2, 1)
    bad = frame(spark, [[1.0, 2.0], None, [None, 1.0], [3.0, 4.0]], 1)
    got = {r.k: (r.z, r.cluster) for r in m.transform(p.transform(bad, "v", "z"), "v").collect()}
    assert got[1] == got[2] == (None, None)
    assert got[0][0] is not None and got[3][1] in (0, 1)
    only = frame(spark, [None, None], 1)
    assert [r.z for r in p.transform(only, "v", "z").collect()] == [None, None]
    assert p.transform(frame(spark, []), "v", "z").collect() == []


def test_empty_frames_raise(spark):
    with pytest.raises(ValueError):
        R.gram(frame(spark, []), "v")


def test_the_scan_keeps_its_tasks(spark):
    df = frame(spark, np.arange(800.0).reshape(400, 2).tolist(), 200).persist()
    df.count()
    assert task_count(df) == 200
    total, tasks = sum_rows(df, ["v"], lambda x: (x.sum(axis=0), np.ones(1)))
    assert np.allclose(total, np.arange(800.0).reshape(400, 2).sum(axis=0)) and 100 < tasks[0] <= 200
    df.unpersist()


def test_large_sums_go_through_the_tree(spark):
    x = np.random.default_rng(2).normal(size=(640, 24))
    df = frame(spark, x.tolist(), 64)
    expand = R.poly_expand(24)
    m = R.polynomial_pca(df, "v", 3)
    c = np.cov(expand(x).T)
    assert np.allclose(m.explained, np.sort(np.linalg.eigvalsh(c))[::-1][:3])


def test_samples_by_threshold(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    code = F.xxhash64("k")
    want = [r.k for r in df.orderBy(code, "k").limit(50).collect()]
    assert [r.k for r in lowest(df, long_share(code), [code, "k"], 50).collect()] == want
    text = F.md5(F.col("k").cast("string"))
    want = [r.k for r in df.orderBy(text, "k").limit(70).collect()]
    assert [r.k for r in lowest(df, hex_share(text), [text, "k"], 70).collect()] == want
    copies = spark.range(5000).select(F.lit(3).cast("long").alias("k"))  # all rows share one hash
    assert lowest(copies, long_share(F.xxhash64("k")), [F.xxhash64("k")], 40).count() == 40


def test_small_fractions_keep_rows(spark):
    df = spark.range(200_000).withColumnRenamed("id", "k")
    for share in (0.0004, 0.01, 0.37):
        assert abs(T.fraction_sample(df, "k", share).count() - share * 200_000) < 6 * (share * 200_000) ** 0.5


def test_correlations_with_missing_and_constant_columns(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 1, size=(300, 12))
    x[:, 5] = 2.5
    x[rng.random(x.shape) < 0.2] = np.nan
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in r] for r in x], [f"c{i}" for i in range(12)])
    for cols in (df.columns[:3], df.columns):
        for r in profile.correlations(df, cols).collect():
            a, b = x[:, int(r.a[1:])], x[:, int(r.b[1:])]
            ok = ~(np.isnan(a) | np.isnan(b))
            if "c5" in (r.a, r.b):
                assert r.value is None
            else:
                assert abs(r.value - np.corrcoef(a[ok], b[ok])[0, 1]) < 1e-9
    assert all(r.value is None for r in profile.correlations(df.limit(0), df.columns[:2]).collect())


def test_interactions_bound_the_arrow_batches(spark):
    """A worker's batch of wide vectors is a few MB, not 10,000 rows of whatever width."""
    from wideloom.plans import steps as ST

    def batch_rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        df = spark.range(6000, numPartitions=1).select(
            F.transform(F.sequence(F.lit(1), F.lit(96)), lambda i: (F.col("id") * i % 7).cast("double")).alias("v"))
        wide = ST._interactions(df, "v")
        sizes = [r["n"] for r in wide.select("v").mapInArrow(batch_rows, "n long").collect()]
        assert sum(sizes) == 6000 and max(sizes) * 8 * (96 + 96 * 95 // 2) <= 16 << 20
        spark.conf.set(name, "100")
        ST._interactions(df, "v")
        assert spark.conf.get(name) == "100"  # a smaller size of the session's own stays
    finally:
        spark.conf.set(name, before)
