import numpy as np
from pyspark.sql import functions as F

from tessera.operators.quantile import quantiles, quantiles_long, wide_quantiles


def test_quantiles_match_numpy(spark):
    rnd = np.random.default_rng(3)
    vals = rnd.integers(0, 50, 999).astype(float)
    rows = [(i % 4, float(v) if i % 17 else None) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r.g: (r.med, r.p99) for r in quantiles(df, "x", {"med": 0.5, "p99": 0.99}, by="g").collect()}
    for g in range(4):
        xs = np.array([x for gg, x in rows if gg == g and x is not None])
        assert abs(got[g][0] - np.quantile(xs, 0.5)) < 1e-9
        assert abs(got[g][1] - np.quantile(xs, 0.99)) < 1e-9


def test_all_null_group_gives_null(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0), (2, 3.0)], "g int, x double")
    got = {r.g: r.m for r in quantiles(df, "x", {"m": 0.5}, by="g").collect()}
    assert got == {1: None, 2: 2.0}
    one = quantiles(df.where(F.col("g") == 1), "x", {"m": 0.5}).collect()
    assert len(one) == 1 and one[0].m is None


def test_wide_and_long(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, 20.0), (4.0, None)], "a double, b double")
    w = wide_quantiles(df, ["a", "b"], 0.5, "m_").collect()[0]
    assert (w.m_a, w.m_b) == (2.0, 15.0)
    assert quantiles_long(df, ["a", "b"], {"q": 0.5}).count() == 2
