"""The range-bucketed ordered engine must equal Spark's own window functions
for every bucket count (SURVEY §5 (e): independent of partitioning)."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.sequence import row_index, sequence


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["a", "b", "c", None]), rnd.choice([1.5, 2.0, 3.25, None]), rnd.randint(1, 5))
            for i in range(2500)]
    # a hot key holding a third of the rows
    rows += [(10_000 + i, "hot", float(i % 7), i % 3) for i in range(1250)]
    return spark.createDataFrame(rows, "id long, g string, v double, k int").withColumn(
        "dv", F.col("v").cast("decimal(7,2)"))


def _cmp(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("buckets", [1, 3, 11])
def test_matches_native_windows(spark, data, buckets):
    out = sequence(data, ["k desc nulls first", "id"], ["g"], row_number="rn", running_sum={"cs": "dv"},
                   lag={"lg": "dv"}, lead={"ld": "v"}, buckets=buckets)
    out = sequence(out, ["k desc nulls first"], ["g"], rank="rk", dense_rank="dr", range_sum={"rs": "dv"},
                   buckets=buckets + 1)
    w = W.partitionBy("g").orderBy(F.col("k").desc_nulls_first(), "id")
    wk = W.partitionBy("g").orderBy(F.col("k").desc_nulls_first())
    ref = data.select("id", F.row_number().over(w).alias("rn"), F.rank().over(wk).alias("rk"),
                      F.dense_rank().over(wk).alias("dr"),
                      F.sum("dv").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("cs"),
                      F.sum("dv").over(wk).alias("rs"), F.lag("dv").over(w).alias("lg"),
                      F.lead("v").over(w).alias("ld"))
    cols = ["id", "rn", "rk", "dr", "cs", "rs", "lg", "ld"]
    a = out.select(*[F.col(c).cast("double").alias(c) for c in cols])
    b = ref.select(*[F.col(c).cast("double").alias(c) for c in cols])
    _cmp(a, b)


def test_global_rank_with_peers(spark, data):
    out = sequence(data, ["v desc nulls first", "id"], peers=1, row_number="rn", rank="rk", dense_rank="dr",
                   buckets=5)
    w1 = W.orderBy(F.col("v").desc_nulls_first(), "id")
    w2 = W.orderBy(F.col("v").desc_nulls_first())
    ref = data.select("id", F.row_number().over(w1).alias("rn"), F.rank().over(w2).alias("rk"),
                      F.dense_rank().over(w2).alias("dr"))
    _cmp(out.select("id", "rn", "rk", "dr").selectExpr("id", "cast(rn as int) rn", "cast(rk as int) rk",
                                                     "cast(dr as int) dr"), ref)


def test_row_index_is_consecutive(spark, data):
    idx = row_index(data, ["id"], "i", start=1).select("i").orderBy("i").collect()
    assert [r.i for r in idx] == list(range(1, data.count() + 1))


@pytest.fixture(scope="module")
def hard(spark):
    """BIGINT above 2^53 beside NULLs, NaN, wide decimals, and 90 % of the rows tied on NULL."""
    rnd = random.Random(11)
    big = 2 ** 53
    rows = []
    for i in range(3000):
        tied = i % 10 > 0
        rows.append((i, rnd.choice(["a", "hot", "hot", None]), None if tied else rnd.choice([1.0, float("nan"), -2.5]),
                     None if i % 7 == 0 else (big + rnd.randint(-9, 9)) * (-1) ** i,
                     rnd.choice([float("nan")] + [float(x) for x in range(50)]) if i > 2000 else float(i % 5),
                     None if i % 5 == 0 else f"{rnd.randint(0, 10 ** 12)}.{i % 100:02d}"))
    return spark.createDataFrame(rows, "id long, g string, v double, n long, x double, d string").withColumn(
        "d", F.col("d").cast("decimal(28,2)"))


@pytest.mark.parametrize("part", [[], ["g"]])
@pytest.mark.parametrize("buckets", [1, 4, 9])
def test_hard_values_equal_native_windows(spark, hard, part, buckets):
    out = sequence(hard, ["v desc nulls first", "id"], part, peers=1, buckets=buckets, row_number="rn", rank="rk",
                   dense_rank="dr", running_sum={"cd": "d", "cx": "x", "cn": "n"}, range_sum={"rd": "d", "rx": "x"},
                   lag={"gn": "n", "gd": "d", "gx": "x"}, lead={"ln": "n", "ld": "d", "lx": "x"})
    w = W.partitionBy(*part).orderBy(F.col("v").desc_nulls_first(), "id")
    wp = W.partitionBy(*part).orderBy(F.col("v").desc_nulls_first())
    rows = w.rowsBetween(W.unboundedPreceding, 0)
    ref = hard.withColumns({
        "rn": F.row_number().over(w).cast("long"), "rk": F.rank().over(wp).cast("long"),
        "dr": F.dense_rank().over(wp).cast("long"), "cd": F.sum("d").over(rows), "cx": F.sum("x").over(rows),
        "cn": F.sum("n").over(rows), "rd": F.sum("d").over(wp), "rx": F.sum("x").over(wp), "gn": F.lag("n").over(w),
        "gd": F.lag("d").over(w), "gx": F.lag("x").over(w), "ln": F.lead("n").over(w), "ld": F.lead("d").over(w),
        "lx": F.lead("x").over(w)}).select(*out.columns)
    assert [f.dataType for f in out.schema] == [f.dataType for f in ref.schema]
    _cmp(out, ref)


def test_empty_and_single_row(spark, hard):
    for data, n in ((hard.limit(0), 0), (hard.where("id = 5"), 1)):
        out = sequence(data, ["v", "id"], ["g"], row_number="rn", rank="rk", running_sum={"cs": "d"}, lag={"p": "n"})
        assert [(r.rn, r.rk, r.p) for r in out.collect()] == [(1, 1, None)] * n


def test_plan_has_no_python_and_no_whole_table_task(spark):
    from .conftest import SF_SMALL

    t = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")
    out = sequence(t, ["l_quantity desc", "l_orderkey", "l_linenumber"], peers=1, row_number="rn", rank="rk")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "InPandas" not in plan and "Python" not in plan
    # windows without keys only meet the per-bucket totals
    for line in plan.splitlines():
        if "Window" in line and "__sq_bucket" not in line:
            raise AssertionError(line)
