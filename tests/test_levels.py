"""Levels as rows against indicator columns, and with more levels than columns could hold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cv as CV
from tessera.operators import models as MD
from tessera.operators.levels import BROADCAST_ROWS, cv_level_predictions


def test_levels_equal_indicator_columns(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        lv = None if i % 50 == 7 else "hot" if i % 3 == 0 else f"k{rng.integers(40):02d}"
        x, z = float(rng.normal()), float(rng.normal())
        rows.append((i, i % 4, lv, x, z, 1.5 * x - z + len(lv or "") + float(rng.normal())))
    rows += [(900, 1, "only here", 0.3, 0.1, 2.0), (901, 2, "a first, alone", -0.4, 0.2, 1.0)]
    df = spark.createDataFrame(rows, "id long, fold int, lv string, x double, z double, y double")
    names = CV.one_hot_levels(df, "lv")
    dense = CV.one_hot(df, "lv", names)
    cols = [f"lv_{n}" for n in names]
    want = MD.cv_predictions(dense, ["x", "z", *cols], "y", ("linear", "ridge"), drop_first_groups=[cols])

    def listed(p):
        return sorted((r.model, r.fold, r.y, r.pred) for r in p.collect())

    w = listed(want)
    for most in (BROADCAST_ROWS, 0):
        monkeypatch.setattr("tessera.operators.levels.BROADCAST_ROWS", most)
        g = listed(cv_level_predictions(df, ["x", "z"], "lv", "y"))
        assert [a[:3] for a in g] == [a[:3] for a in w]
        assert [a[3] for a in g] == pytest.approx([a[3] for a in w], abs=1e-8)


def test_a_hundred_thousand_levels(spark):
    n = 100_000
    i = F.col("id")
    df = spark.range(6 * n, numPartitions=4).select(
        (F.when(i % 3 == 0, 0).otherwise(i % n)).cast("string").alias("lv"), (F.floor(i / n) % 5).cast("int").alias("fold"), (F.xxhash64("id") % 1000 / 100.0).alias("x"))
    df = df.withColumn("y", 2 * F.col("x") + F.col("lv").cast("long") % 7)
    with pytest.raises(ValueError):
        CV.one_hot_levels(df, "lv")
    p = cv_level_predictions(df, ["x"], "lv", "y", models=("linear",))
    r = p.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("y") - F.col("pred"))).alias("off")).first()
    assert df.select("lv").distinct().count() == n
    assert r.n == 6 * n and r.off < 1e-6
