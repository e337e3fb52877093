"""Pipelines, sources and ML operators on the small driver tables and on
fixtures (row-count and property checks; SQL oracles live in test_oracle_corpus)."""

import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cv as CV
from tessera.operators import features as FE
from tessera.operators import models as MD
from tessera.sources.domain import Domain

from .conftest import SF_SMALL

MD_TREE_CV = MD.tree_cv


@pytest.fixture(scope="module")
def dom(spark):
    return Domain(spark, SF_SMALL)


def test_run_all_sources_reports_every_source(dom):
    from tessera.plans import flows

    status, frames = flows.run_all(dom)
    rows = {r.source: r for r in status.collect()}
    assert set(rows) == set(flows.SOURCES)
    assert all(r.status == "OK" and r.rows > 0 for r in rows.values())
    assert set(frames) == set(flows.SOURCES)
    for name, r in rows.items():  # nothing is lost unseen: held-back rows are on disk
        if r.rows_invalid:
            held = dom.spark.read.parquet(flows.invalid_path(dom, name))
            assert held.count() == r.rows_invalid and held.where("student_id IS NOT NULL").isEmpty()
        assert r.rows <= r.rows_in - r.rows_invalid
        assert r.path == f"clean/source={name}"
        loaded = dom.spark.read.parquet(f"{flows.clean_path(dom)}/source={name}")
        assert loaded.count() == r.rows and loaded.columns == list(flows.STANDARD)
    assert rows["csv"].rows_invalid > 0 and "not_null:student_id" in rows["csv"].failed_rules
    assert "not_null:city" in rows["api"].failed_rules and rows["mongodb"].failed_rules is None
    assert rows["scraper"].rows_in > rows["scraper"].rows + rows["scraper"].rows_invalid


def test_sources_run_side_by_side_and_keep_their_order(dom, monkeypatch):
    """Two sources that wait for each other end only when both run at once; a failure stays with its source."""
    from threading import Barrier

    from tessera.plans import flows

    both, wait = Barrier(2), 60
    recipe = dict(flows.RECIPES)

    def meet(name):
        def run(d):
            both.wait(wait)
            return recipe[name](d)

        return run

    for name in ("json", "sqlite"):
        monkeypatch.setitem(flows.RECIPES, name, meet(name))
    monkeypatch.setitem(flows.RECIPES, "api", lambda d: d.spark.table("absent"))
    status, frames = flows.run_all(dom, ("json", "api", "sqlite"))
    assert [(r.source, r.status) for r in status.collect()] == [("json", "OK"), ("api", "FAILED"), ("sqlite", "OK")]
    assert list(frames) == ["json", "sqlite"]


@pytest.mark.parametrize("query", ["P4_silver_merge", "Q5_silver_verify", "Q8_silver_report"])
def test_silver_of_a_failed_source_raises(dom, monkeypatch, query):
    """Silver, its checks and its report are of all sources: without one they are no result."""
    import __spark_entry__ as se
    from tessera.plans import flows

    for name in flows.SOURCES:
        if name not in ("sqlite", "postgres"):
            monkeypatch.setitem(flows.RECIPES, name, lambda d: d.spark.table("absent"))
    with pytest.raises(RuntimeError, match=r"(?s)csv: AnalysisException.*api: AnalysisException"):
        se.queries()[query](dom.spark, SF_SMALL).collect()


def test_rerun_replaces_one_source(dom, monkeypatch):
    from tessera.plans import flows

    flows.run_all(dom, ("json", "postgres"))
    before = {s: dom.spark.read.parquet(f"{flows.clean_path(dom)}/source={s}").inputFiles() for s in ("json", "postgres")}
    monkeypatch.setitem(flows.RECIPES, "json", lambda d: flows.csv_source(d).where("student_id < 20"))
    again = flows.run_source(dom, "json")
    files = {s: dom.spark.read.parquet(f"{flows.clean_path(dom)}/source={s}").inputFiles() for s in before}
    assert files["postgres"] == before["postgres"] and not set(files["json"]) & set(before["json"])
    assert dom.spark.read.parquet(f"{flows.clean_path(dom)}/source=json").count() == again.rows
    monkeypatch.setitem(flows.RECIPES, "json", lambda d: flows.csv_source(d).limit(0))
    assert flows.run_source(dom, "json").status == "FAILED"


def test_silver_merge_contract(dom):
    from tessera.operators import silver as SV
    from tessera.plans import flows

    merged = flows.run_merge(dom)
    assert merged.columns == SV.UNIFIED_COLUMNS
    rep = {r.rule: r.failed_count for r in SV.verify(merged).collect()}
    assert all(v == 0 for v in rep.values()), rep
    ids = merged.where(F.col("source") == "csv").select("record_id").orderBy("record_id").first()[0]
    assert ids == "R-csv-0000"


def test_greedy_quotas_match_lightest_fold_rule():
    hist = [(5, 3), (3, 4), (1, 10)]
    q = CV.greedy_quotas(hist, 3)
    loads = [0, 0, 0]
    expect = {5: [0, 0, 0], 3: [0, 0, 0], 1: [0, 0, 0]}
    for size, n in sorted(hist, key=lambda t: -t[0]):
        for _ in range(n):
            f = loads.index(min(loads))
            loads[f] += size
            expect[size][f] += 1
    assert q == expect


def test_group_kfold_isolates_groups(spark):
    rows = [(g, i) for g in range(40) for i in range(1 + g % 7)]
    df = spark.createDataFrame(rows, "student_id long, i long")
    f = CV.group_kfold(df, 5, "student_id")
    rep = CV.leakage_report(f).collect()
    assert all(r.leaking_groups == 0 for r in rep)
    sizes = sorted(r.test_rows for r in rep)
    assert sizes[-1] - sizes[0] <= 7 and sum(sizes) == len(rows)


def test_kfold_sizes_differ_by_at_most_one(spark):
    df = spark.range(103).withColumnRenamed("id", "row_id")
    sizes = [r["count"] for r in CV.kfold(df, 5).groupBy("fold").count().collect()]
    assert sorted(sizes) == [20, 20, 21, 21, 21]


def test_linear_and_ridge_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(scale=0.1, size=60)
    fold = np.arange(60) % 3
    df = spark.createDataFrame([(int(f), *map(float, r), float(t)) for f, r, t in zip(fold, x, y)],
                               "fold int, a double, b double, c double, y double")
    pred = MD.cv_predictions(df, ["a", "b", "c"], "y", models=("linear", "ridge")).collect()
    for model, alpha in (("linear", 0.0), ("ridge", 1.0)):
        got = sorted(r.pred for r in pred if r.model == model)
        want = []
        for f in range(3):
            tr = fold != f
            xa = np.c_[np.ones(tr.sum()), x[tr]]
            a = xa.T @ xa
            a[1:, 1:] += alpha * np.eye(3)
            beta = np.linalg.solve(a, xa.T @ y[tr])
            want += list(np.c_[np.ones((~tr).sum()), x[~tr]] @ beta)
        assert np.allclose(got, sorted(want), atol=1e-9)


def test_loo_closed_form_equals_refits(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(25, 2))
    y = x @ [0.7, 1.5] + rng.normal(size=25)
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y)],
                               "a double, b double, y double")
    for model, alpha in (("linear", 0.0), ("ridge", 1.0)):
        res = [r.loo_residual for r in MD.loo_residuals(df, ["a", "b"], "y", model).collect()]
        brute = []
        for i in range(25):
            m = np.arange(25) != i
            xa = np.c_[np.ones(24), x[m]]
            a = xa.T @ xa
            a[1:, 1:] += alpha * np.eye(2)
            beta = np.linalg.solve(a, xa.T @ y[m])
            brute.append(y[i] - np.r_[1.0, x[i]] @ beta)
        assert np.allclose(res, brute, atol=1e-9)


def test_loo_with_rows_alone_in_a_level_equals_refits(spark):
    """Levels of one row, the first (dropped) level among them, in two categoricals."""
    rng = np.random.default_rng(2)
    n = 24
    c = ["a"] + ["b"] * 7 + ["c"] * 8 + ["d"] + ["e"] * 7
    g = ["m", "f"] * 11 + ["x", "f"]
    x = rng.normal(size=n)
    y = x * 0.5 + rng.normal(size=n)
    cols = [[f"c_{k}" for k in "abcde"], [f"g_{k}" for k in "fmx"]]
    rows = [(i, float(x[i]), *[float(c[i] == k) for k in "abcde"], *[float(g[i] == k) for k in "fmx"], float(y[i])) for i in range(n)]
    feats = ["x", *cols[0], *cols[1]]
    df = spark.createDataFrame(rows, "i int, x double, " + ", ".join(f"{f} double" for f in feats[1:]) + ", y double").repartition(3)
    for model, alpha in (("linear", 0.0), ("ridge", 1.0), ("baseline", 0.0)):
        got = {r.i: r.loo_residual for r in MD.loo_residuals(df, feats, "y", model, groups=cols, extra=("i",)).collect()}
        for i in range(n):
            m = np.arange(n) != i
            keep_c, keep_g = sorted(set(np.array(c)[m]))[1:], sorted(set(np.array(g)[m]))[1:]
            d = np.array([[1.0, x[j], *[c[j] == k for k in keep_c], *[g[j] == k for k in keep_g]] for j in range(n)], dtype=float)
            if model == "baseline":
                want = y[i] - y[m].mean()
            else:
                a = d[m].T @ d[m]
                a[1:, 1:] += alpha * np.eye(len(a) - 1)
                want = y[i] - d[i] @ (np.linalg.pinv(a) @ (d[m].T @ y[m]))
            assert got[i] == pytest.approx(want, abs=1e-8), (model, i)


def test_one_hot_levels_are_bounded(spark, monkeypatch):
    df = spark.range(20).withColumn("c", F.concat(F.lit("l"), F.col("id")))
    assert len(CV.one_hot_levels(df, "c")) == 20
    monkeypatch.setattr(CV, "MAX_LEVELS", 19)
    with pytest.raises(ValueError, match="over 19 levels"):
        CV.one_hot_levels(df, "c")


def test_share_bound_equals_sorting(spark):
    for seed, n in ((1, 997), (2, 1), (3, 12)):
        r = np.random.default_rng(seed)
        h = sorted(int(v) for v in r.integers(0, 2**60, n)) if seed < 3 else [5] * 6 + [9] * 6
        df = spark.createDataFrame([(v,) for v in h], "h long")
        for share in (0.2, 0.5, 0.0, 1.0):
            k = max(1, round(share * n))
            bound = FE.share_bound(df, "h", share)
            assert sum(v < bound for v in h) == sum(v <= h[k - 1] for v in h)
    assert FE.share_bound(spark.range(0).selectExpr("id AS h"), "h", 0.2) == 0


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([("m", 0, 3.32, 3.32), ("m", 0, 3.69, 3.69), ("m", 1, 2.96, 1.0)],
                               "model string, fold int, y double, pred double")
    m = {r.fold: r for r in MD.fold_metrics(df).collect()}
    assert m[0].mae == 0.0 and m[0].r2 == 1.0 and m[1].r2 is None
    s = MD.summarize(MD.fold_metrics(df).withColumn("fs", F.lit("A")).withColumn("cv", F.lit("k"))).first()
    assert s.r2_n_valid == 1 and s.r2_std == 0.0 and s.n_folds == 2


def test_trees_fit_once_and_report_importance(spark):
    rows = [(i % 3, float(i % 7), float(i % 5), float(i % 7) * 0.5 + i % 5) for i in range(90)]
    df = spark.createDataFrame(rows, "fold int, a double, b double, y double")
    pred, imp = MD.tree_cv(df, ["a", "b"], "y", "gradient_boosting", max_iter=5)
    assert pred.count() == 90 and imp.count() == 6
    pred, imp = MD.tree_cv(df, ["a", "b"], "y", "random_forest", num_trees=5, max_depth_rf=4)
    assert pred.count() == 90


def test_split_is_exact_and_deterministic(spark):
    df = spark.range(1, 48).withColumnRenamed("id", "student_id")
    a = FE.split_train_test(df)
    b = FE.split_train_test(df.repartition(7))
    assert a.where("split = 'test'").count() == 9  # round_half_even(0.2 * 47) = 9
    assert sorted(r[0] for r in a.where("split = 'test'").collect()) == sorted(
        r[0] for r in b.where("split = 'test'").collect())


def test_compare_tables_tolerance(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y")], "k long, v double, s string")
    b = spark.createDataFrame([(1, 1.00005, "x"), (3, 2.0, "y")], "k long, v double, s string")
    bad = {r.k for r in FE.compare_tables(a, b, "k").collect()}
    assert bad == {2, 3}


def test_catalog_range_check_counts_violations(spark):
    rows = [(0.5, 3.0, 1.0, "Good", 0.0, 1), (1.2, -1.0, None, "Pass", 2.0, 0), (None, 11.0, 0.5, "Weak", 1.0, None)]
    df = spark.createDataFrame(rows, "attendance_rate double, academic_risk_score double, score_change double, "
                                     "performance_level string, city_score_gap double, city_rank long")
    got = {r.name: (r.non_null, r.out_of_range) for r in FE.catalog_range_check(df).collect()}
    # brute force over the same rows and the catalogue's bounds
    for i, spec in enumerate(FE.FEATURE_CATALOG):
        vals = [r[i] for r in rows if r[i] is not None]
        bad = [v for v in vals if (spec.range_min is not None and v < spec.range_min)
               or (spec.range_max is not None and v > spec.range_max)]
        assert got[spec.name] == (len(vals), len(bad)), spec.name
    assert got["attendance_rate"] == (2, 1) and got["academic_risk_score"] == (3, 2) and got["city_rank"] == (2, 1)
    with pytest.raises(ValueError):
        FE.catalog_range_check(df.drop("city_rank"))


def test_synthetic_generator_is_partition_independent(spark):
    a = FE.synthetic_students(spark, 500, partitions=1)
    b = FE.synthetic_students(spark, 500, partitions=7)
    assert a.exceptAll(b).count() == 0
    stats = a.agg(F.min("gpa"), F.max("gpa"), F.min("age"), F.max("age")).first()
    assert 0 <= stats[0] <= stats[1] <= 4 and 18 <= stats[2] <= stats[3] <= 30


def test_streaming_rowwise_matches_batch(spark, tmp_path):
    from tessera.streaming import rowwise

    src = tmp_path / "in"
    rows = [("1", " Alice ", "20", "3.5", "90", "riyadh"), ("2", "Bob", "150", "x", "-10", "JEDDAH"),
            (None, "Carl", "22", "3.9", "87", "al-ain")]
    schema = "student_id string, name string, age string, gpa string, attendance string, city string"
    spark.createDataFrame(rows, schema).write.option("header", True).csv(str(src))
    stream = rowwise.stream_csv_directory(spark, str(src), schema)
    q = rowwise.write_clean_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("name").collect()
    assert {r.city for r in got} == {"Riyadh", "Jeddah", "Al-Ain"}
    assert {r.disposition for r in got} == {"valid", "fail"}
    with pytest.raises(TypeError):
        from tessera.operators.clean import fill_missing

        fill_missing(stream)


def test_feature_catalog_and_star_build(spark, dom, tmp_path):
    from tessera.operators import star as ST

    feats = spark.createDataFrame([(1,)], "student_id long").select(
        "student_id", *[F.lit(0.0).alias(s.name) for s in FE.FEATURE_CATALOG])
    assert FE.feature_catalog(spark, feats).count() == len(FE.FEATURE_CATALOG)
    with pytest.raises(ValueError):
        FE.feature_catalog(spark, feats.drop("city_rank"))
    paths = ST.build_all(dom, str(tmp_path / "gold"))
    assert set(paths) == {"dim_students", "dim_courses", "dim_instructors", "dim_time",
                          "fact_student_performance", "fact_enrollment"}
    fact = spark.read.parquet(paths["fact_student_performance"])
    assert fact.count() == dom.assessments().count()  # grain: one row per assessment


def test_small_cleaning_operators(spark):
    from tessera.operators import clean as C

    df = spark.createDataFrame([("M", "2001-02-30"), ("F", "2000-01-01"), ("X", None)], "sex string, dob string")
    assert C.invalid_dob_rows(df, "dob").count() == 2
    got = [r.g for r in df.select(C.recode("sex", {"M": "Male", "F": "Female"}).alias("g")).collect()]
    assert got == ["Male", "Female", None]
    ages = [r.a for r in df.select(C.age_from_dob(F.col("dob"), "2026-10-10").alias("a")).collect()]
    assert ages == [None, 27, None]
    std = C.standardize(spark.createDataFrame([("7", "Ann")], "student_id string, name string"))
    assert std.columns == list(C.REQUIRED_COLUMNS) and std.first().student_id == 7
    assert C.select_existing(std, ["name", "nope"]).columns == ["name"]


def test_metric_and_feature_writers(spark, tmp_path):
    from tessera.sinks import writers as W

    feats = spark.createDataFrame([(2, "train", 1.5), (1, "test", 2.5)], "student_id long, split string, gpa double")
    out = W.write_features(feats, str(tmp_path / "f"), FE.feature_catalog(spark))
    assert spark.read.parquet(out["ml_features"]).columns == ["student_id", "gpa"]
    assert spark.read.json(out["feature_metadata"]).count() == len(FE.FEATURE_CATALOG)
    folds = spark.createDataFrame([("A", 0, 0.123456789)], "fs string, fold int, mae double")
    W.write_metrics(folds, folds.groupBy("fs").count(), str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "m/fold_metrics")).first().mae == "0.123457"


def test_matrix_audit(spark):
    df = spark.createDataFrame([(1.0, "a", 2.0, 9.0), (None, "b", 3.0, 9.0)], "x double, c string, y double, g3 double")
    with pytest.raises(ValueError):
        CV.feature_matrix(df, ["x", "g3"], ["c"], "y", forbidden=["g3"])
    with pytest.raises(ValueError):
        CV.feature_matrix(df, ["x"], ["c"], "y")
    assert CV.feature_matrix(df.where("x is not null"), ["x"], ["c"], "y").columns == ["x", "c", "y"]


def test_source_rules(spark):
    from tessera.operators.quality import validate_source

    df = spark.createDataFrame([(1, 20, None, None), (1, 99, None, None), (None, 20, 3.0, 50.0)],
                               "student_id long, age long, gpa double, attendance double")
    api = {r.rule: r.failed_count for r in validate_source("api", df).collect()}
    assert api == {"empty": 0, "not_null:student_id": 1, "range:age": 1, "unique:student_id": 1}
    assert {r.rule: r.failed_count for r in validate_source("json", df.limit(0)).collect()} == {"empty": 1, "not_null:student_id": 0}
    named = df.selectExpr("*", "IF(age = 99, NULL, 'a') AS name", "CAST(NULL AS string) AS city")
    assert {"not_null:name": 1, "not_null:city": 3}.items() <= {r.rule: r.failed_count for r in validate_source("scraper", named).collect()}.items()
    csv = {r.rule: r.failed_count for r in validate_source("csv", df).collect()}
    assert csv["unique:student_id"] == 1
    scr = {r.rule: r.failed_count for r in validate_source("scraper", df).collect()}
    assert scr["range:gpa"] == 2


def test_sample_std_rules(spark):
    """ddof=1, a single value gives 0.0, NaN is excluded, no value gives NULL."""
    from tessera.functions.numeric import sample_std

    rows = [("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 3.0), ("c", float("nan")), ("c", 5.0), ("d", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.s for r in df.groupBy("g").agg(sample_std("x").alias("s")).collect()}
    assert got["a"] == pytest.approx(float(np.std([1.0, 2.0, 4.0], ddof=1)))
    assert got["b"] == 0.0 and got["c"] == 0.0 and got["d"] is None


def test_tree_cells_assemble_each_feature_set_once(spark, monkeypatch):
    """Both models of a feature set fit on the same kept vectors (a plan of an assembler runs it in every pass)."""
    from pyspark.ml.feature import VectorAssembler

    from tessera.plans import corpus_ml as ML
    from tessera.sources.domain import Domain

    calls, plain = [], VectorAssembler.transform
    monkeypatch.setattr(VectorAssembler, "transform", lambda self, df: calls.append(1) or plain(self, df))
    metrics, imp = ML.tree_matrix(Domain(spark, SF_SMALL), ("group_kfold3",), random_forest={"num_trees": 2, "max_depth_rf": 2},
                                  gradient_boosting={"max_iter": 1})
    assert len(calls) == 2
    got = {(r.fs, r.model, r.fold) for r in metrics.collect()}
    assert got == {(fs, m, f) for fs in "AB" for m in ML.TREES for f in range(3)}
    assert {(r.fs, r.model, r.fold) for r in imp.collect()} == got


def test_tree_cells_are_of_full_ensembles(spark, monkeypatch):
    """The registered query fits the sizes that M12 and M13 name: 200 trees without a small depth, 200 x depth 3."""
    import __spark_entry__ as se

    sizes = []

    def fit(df, features, target, model, **kw):
        given = inspect.signature(MD_TREE_CV).bind(df, features, target, model, **kw)
        given.apply_defaults()
        sizes.append((model, *[given.arguments[k] for k in ("num_trees", "max_depth_rf", "max_iter")]))
        pred = spark.createDataFrame([(model, 0, 1.0, 1.0)], "model string, fold int, y double, pred double")
        return pred, spark.createDataFrame([(model, 0, "a", 1.0)], "model string, fold int, feature string, importance double")

    monkeypatch.setattr(MD, "tree_cv", fit)
    se.queries()["M12_M14_tree_cells"](spark, SF_SMALL)
    assert len(sizes) == 12
    assert set(sizes) == {("random_forest", 200, 30, 200), ("gradient_boosting", 200, 30, 200)}


def test_a_forest_grown_in_turns_is_a_whole_forest(spark, monkeypatch):
    """Trees in turns of three: predictions are the mean over all trees, none lost, and importances sum to 1."""
    from pyspark.ml.regression import RandomForestRegressionModel

    rows = [(i % 3, float(i % 7), float(i % 5), float(i % 7) * 0.5 + i % 5) for i in range(90)]
    df = spark.createDataFrame(rows, "fold int, a double, b double, y double")
    turns, plain = [], RandomForestRegressionModel.transform

    def transform(self, d):
        turns.append(self.getNumTrees)
        return plain(self, d)

    monkeypatch.setattr(RandomForestRegressionModel, "transform", transform)
    monkeypatch.setattr(MD, "NODES_AT_ONCE", 180)
    pred, imp = MD.tree_cv(df, ["a", "b"], "y", "random_forest", num_trees=8)
    assert sorted(turns) == sorted([3, 3, 2] * 3) and pred.count() == 90
    assert all(r.r2 > 0.9 for r in MD.fold_metrics(pred).collect())
    assert {round(r.s, 9) for r in imp.groupBy("fold").agg(F.sum("importance").alias("s")).collect()} == {1.0}
