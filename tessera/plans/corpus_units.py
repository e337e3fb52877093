"""Single-operator queries: each runs one inventory operator on its own over
the bound tables, so it is checked in isolation and not only inside the
composite flows (E1-E9 apart from E11, C11/C13/C14/C16 apart from P3, C18
apart from P5, ...).  Every entry has a DuckDB oracle; for the parity check
(E12) it is the expected all-agree summary.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.numeric import avg2, dbl, sample_std
from tessera.operators import clean as C
from tessera.operators import features as FE
from tessera.operators import identity as ID
from tessera.operators import star as ST
from tessera.operators.relational import fanout_student_metrics
from tessera.operators.sequence import sequence
from tessera.plans.corpus_gold import FACT_SQL, FEATURES_SQL, _fact, _features
from tessera.plans.corpus_ml import AS_OF
from tessera.plans.corpus_silver import CLEAN_CTES, TYPED_CTE, _clean
from tessera.plans.corpus_sources import UCI_ETL_SQL, _courses
from tessera.plans.flows import RECIPES
from tessera.plans.registry import register
from tessera.sources import uci as U
from tessera.sources.bronze import bronze_students
from tessera.sources.tables import read_table


# ---------------------------------------------------------------- A18
@register("A18_score_std_per_student",
          """SELECT student_id, COUNT(score) AS n_valid,
                    ROUND(CASE WHEN COUNT(score) = 1 THEN 0.0 ELSE stddev_samp(CAST(score AS DOUBLE)) END, 6)
                      AS score_std
             FROM assessments GROUP BY student_id""")
def a18_score_std_per_student(dom):
    a = dom.assessments().select("student_id", F.col("score").cast("double").alias("score"))
    return a.groupBy("student_id").agg(F.count("score").alias("n_valid"),
                                       F.round(sample_std("score"), 6).alias("score_std"))


# ---------------------------------------------------------------- C11
@register("C11_student_age",
          f"""SELECT student_id, date_of_birth,
                     CAST(round_even(datediff('day', date_of_birth, DATE '{AS_OF}') / 365.25, 0) AS BIGINT) AS age
              FROM students""")
def c11_student_age(dom):
    s = dom.students()
    return s.select("student_id", "date_of_birth", C.age_from_dob(F.col("date_of_birth"), AS_OF).alias("age"))


# ---------------------------------------------------------------- S4 + C11/C13/C14/C16/C7/D2
@register("S4_C13_C14_relational_source",
          f"""WITH r AS (
                SELECT student_id, full_name AS name,
                       CAST(round_even(datediff('day', date_of_birth, DATE '{AS_OF}') / 365.25, 0) AS BIGINT) AS age,
                       city FROM students)
              SELECT student_id, name, CASE WHEN age BETWEEN 16 AND 80 THEN age END AS age,
                     CAST(NULL AS DOUBLE) AS gpa, CAST(NULL AS DOUBLE) AS attendance, city FROM r""")
def s4_relational_source(dom):
    return C.standardize(C.keep_first(RECIPES["sqlite"](dom)))


@register("S4_table_extract",
          f"""SELECT student_id, full_name AS name, CASE WHEN a BETWEEN 16 AND 80 THEN a END AS age,
                     CAST(NULL AS DOUBLE) AS gpa, CAST(NULL AS DOUBLE) AS attendance, city
              FROM (SELECT *, CASE WHEN student_id % 29 <> 3 AND student_id % 37 <> 5 THEN
                      CAST(round_even(datediff('day', date_of_birth, DATE '{AS_OF}') / 365.25, 0) AS BIGINT) END AS a FROM students) t""")
def s4_table_extract(dom):
    """S4 on a landed extract: header case, text dates, some absent and some that are no dates."""
    return C.standardize(C.keep_first(RECIPES["postgres"](dom)))


# ---------------------------------------------------------------- C18 (UCI sex labels)
@register("C18_sex_recode",
          f"""WITH {UCI_ETL_SQL} SELECT record_id, sex,
                                      CASE sex WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' END AS gender
              FROM withid""")
def c18_sex_recode(dom):
    rows = ID.consecutive_ids(_courses(dom).select("ingest_ord", "sex"), ["ingest_ord"], "record_id", "R%04d")
    return rows.select("record_id", "sex", C.recode("sex", U.SEX_LABELS).alias("gender"))


# ---------------------------------------------------------------- I1 / C21
@register("I1_bronze_record_ids",
          "SELECT ingest_ord, printf('R%04d', ROW_NUMBER() OVER (ORDER BY ingest_ord) - 1) AS record_id "
          "FROM bronze_students")
def i1_bronze_record_ids(dom):
    b = bronze_students(dom.spark, dom.dir).select("ingest_ord")
    return ID.consecutive_ids(b, ["ingest_ord"], "record_id", "R%04d")


@register("C21_source_record_ids",
          f"""WITH {CLEAN_CTES}
              SELECT student_id, printf('R-csv-%04d', ROW_NUMBER() OVER (ORDER BY ingest_ord) - 1) AS record_id
              FROM cleaned""")
def c21_source_record_ids(dom):
    return C.record_ids(_clean(dom).select("student_id", "ingest_ord"), "csv", "ingest_ord").select(
        "student_id", "record_id")


# ---------------------------------------------------------------- C20
@register("C20_attendance_scale",
          f"""WITH {CLEAN_CTES},
              src AS (SELECT 'csv' AS source, student_id, attendance FROM cleaned
                      UNION ALL SELECT 'sqlite', student_id, CAST(NULL AS DOUBLE) FROM students),
              mx AS (SELECT source, MAX(attendance) AS m FROM src GROUP BY source)
              SELECT s.source, s.student_id, s.attendance,
                     CASE WHEN s.attendance IS NULL THEN NULL
                          ELSE LEAST(GREATEST(CASE WHEN mx.m > 1.1 AND mx.m <= 100 THEN s.attendance / 100.0
                                                   ELSE s.attendance END, 0.0), 1.0) END AS attendance_rate,
                     COALESCE(mx.m > 100, FALSE) AS scale_error
              FROM src s JOIN mx USING (source)""")
def c20_attendance_scale(dom):
    csv = _clean(dom).select(F.lit("csv").alias("source"), "student_id", "attendance")
    rel = dom.students().select(F.lit("sqlite").alias("source"), "student_id",
                                F.lit(None).cast("double").alias("attendance"))
    return C.attendance_to_rate(csv.unionByName(rel))


# ---------------------------------------------------------------- J13
@register("J13_fanout_assessment_counts",
          """SELECT s.student_id, COUNT(DISTINCT e.course_id) AS courses_count,
                    COUNT(a.assessment_id) AS assessments_count
             FROM students s LEFT JOIN enrollments e ON s.student_id = e.student_id
             LEFT JOIN assessments a ON s.student_id = a.student_id
             GROUP BY s.student_id""")
def j13_fanout_assessment_counts(dom):
    s = dom.students().select("student_id", "full_name", "city")
    m = fanout_student_metrics(s, dom.enrollments(), dom.assessments())
    return m.select("student_id", "courses_count", "assessments_count")


# ---------------------------------------------------------------- R6
@register("R6_nulls_last_ranking",
          """WITH avgs AS (SELECT s.student_id,
                                  CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
                           FROM students s LEFT JOIN assessments a ON s.student_id = a.student_id
                           GROUP BY s.student_id)
             SELECT student_id, average_score,
                    ROW_NUMBER() OVER (ORDER BY average_score DESC NULLS LAST, student_id) AS position
             FROM avgs""")
def r6_nulls_last_ranking(dom):
    per = dom.assessments().groupBy("student_id").agg(avg2("score").alias("average_score"))
    s = dom.students().select("student_id").join(per, "student_id", "left")
    s = s.withColumn("average_score", dbl("average_score"))
    out = sequence(s, ["average_score desc nulls last", "student_id"], row_number="position")
    return out.select("student_id", "average_score", "position")


# ---------------------------------------------------------------- U2
@register("U2_union_by_name",
          """SELECT 'student' AS kind, student_id AS person_id, full_name, city FROM students
             UNION ALL BY NAME
             SELECT 'instructor' AS kind, instructor_id AS person_id, full_name, department FROM instructors""")
def u2_union_by_name(dom):
    s = dom.students().select(F.lit("student").alias("kind"), F.col("student_id").alias("person_id"),
                              "full_name", "city")
    i = dom.instructors().select(F.lit("instructor").alias("kind"), F.col("instructor_id").alias("person_id"),
                                 "full_name", "department")
    return s.unionByName(i, allowMissingColumns=True)


# ---------------------------------------------------------------- S9
@register("S9_parquet_column_subset", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def s9_parquet_column_subset(dom):
    """The whole table, three columns: the scan's ReadSchema holds only those."""
    return read_table(dom.spark, dom.dir, "lineitem", columns=["l_orderkey", "l_linenumber", "l_quantity"])


# ---------------------------------------------------------------- E1-E5, E8, E9/W25
def _base(dom):
    att = _clean(dom).select("student_id", "attendance")
    return FE.base_features(ST.dim_students(dom.students()), _fact(dom), [("csv_clean", att)])


@register("E1_E5_base_features",
          FEATURES_SQL + """
SELECT student_id, gpa, attendance, ROUND(avg_score, 6) AS avg_score, n_assessments,
       ROUND(score_change, 6) AS score_change, ROUND(attendance / 100.0, 4) AS attendance_rate,
       ROUND((4.0 - gpa) + (100.0 - attendance) / 25.0, 4) AS academic_risk_score,
       CASE WHEN avg_score >= 90 THEN 'Excellent' WHEN avg_score >= 80 THEN 'Very Good'
            WHEN avg_score >= 70 THEN 'Good' WHEN avg_score >= 60 THEN 'Pass' ELSE 'Weak' END AS performance_level,
       city FROM base""")
def e1_e5_base_features(dom):
    b = _base(dom)
    return b.select("student_id", "gpa", "attendance", F.round("avg_score", 6).alias("avg_score"), "n_assessments",
                    F.round("score_change", 6).alias("score_change"), "attendance_rate", "academic_risk_score",
                    "performance_level", "city")


@register("E8_filled_features",
          FEATURES_SQL + """
SELECT student_id, split, gpa, attendance, ROUND(avg_score, 6) AS avg_score, attendance_rate,
       academic_risk_score, performance_level FROM feat""")
def e8_filled_features(dom):
    s = FE.split_train_test(_base(dom))
    f = FE.apply_statistics(s, FE.train_statistics(s))
    return f.select("student_id", "split", "gpa", "attendance", F.round("avg_score", 6).alias("avg_score"),
                    "attendance_rate", "academic_risk_score", "performance_level")


@register("E9_W25_city_features",
          FEATURES_SQL + " SELECT student_id, split, city, city_score_gap, city_rank FROM final")
def e9_w25_city_features(dom):
    return _features(dom).select("student_id", "split", "city", "city_score_gap", "city_rank")


# ---------------------------------------------------------------- Q17
@register("Q17_report_checks",
          FEATURES_SQL + """
SELECT 'non_empty' AS rule, CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS failed_count FROM final
UNION ALL SELECT 'range:avg_score', COUNT(*) FILTER (WHERE NOT (avg_score BETWEEN 0 AND 100)) FROM final""")
def q17_report_checks(dom):
    f = _features(dom)
    return f.agg(F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).alias("non_empty"),
                 F.count_if(~F.col("avg_score").between(0, 100)).alias("range:avg_score")).select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").cast("bigint").alias("failed_count"))
                            for n in ("non_empty", "range:avg_score")])).alias("r")).select("r.*")


# ---------------------------------------------------------------- E12
@register("E12_window_engine_parity",
          f"WITH {FACT_SQL} SELECT COUNT(*) AS rows_compared, CAST(0 AS BIGINT) AS mismatched_rows FROM fact")
def e12_window_engine_parity(dom):
    """E12 on the whole table: per-student rank, running total and previous
    score from the range-bucketed engine under two different bucketings (the
    session's partition count and a prime), compared by E12's tolerance join.
    Results must not depend on how the ranges fall; both sides stay
    distributed, so a student holding a third of the rows is still spread
    out.  (Native windows are compared with the engine in tests on fixtures:
    a native window puts one partition key into one task.)"""
    f = _fact(dom).select("assessment_id", "student_id", "score")
    spec = dict(order_by=["score desc", "assessment_id"], partition_by=["student_id"], rank="rnk",
                running_sum={"running": "score"}, lag={"prev": "score"})
    n = int(dom.spark.conf.get("spark.sql.shuffle.partitions"))
    a = sequence(f, buckets=n, **spec)
    b = sequence(f, buckets=2 * n + 3, **spec)
    bad = FE.compare_tables(a, b, ["assessment_id"])
    return f.agg(F.count(F.lit(1)).alias("rows_compared")).crossJoin(
        bad.agg(F.count(F.lit(1)).alias("mismatched_rows")))


# ---------------------------------------------------------------- C9 (CSV source recipe)
@register("C9_csv_source_fill",
          f"""WITH {TYPED_CTE},
              r AS (SELECT student_id, name, CASE WHEN age BETWEEN 16 AND 80 THEN age END AS age,
                           CASE WHEN gpa BETWEEN 0 AND 4 THEN gpa END AS gpa,
                           CASE WHEN attendance BETWEEN 0 AND 100 THEN attendance END AS attendance,
                           city, ingest_ord FROM typed),
              meds AS (SELECT median(age) AS ma, median(gpa) AS mg, median(attendance) AS mt FROM r),
              f AS (SELECT student_id, name, COALESCE(age, CAST(round_even(ma, 0) AS BIGINT)) AS age,
                           COALESCE(gpa, mg) AS gpa, COALESCE(attendance, mt) AS attendance, city, ingest_ord
                    FROM r, meds)
              SELECT student_id, name, age, gpa, attendance, city FROM f
              QUALIFY ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY ingest_ord) = 1""")
def c9_csv_source_fill(dom):
    """The CSV recipe fills medians over the whole source *before* keep-first; rows without an id are one group."""
    return C.keep_first(RECIPES["csv"](dom)).select("student_id", "name", "age", "gpa", "attendance", "city")


# ---------------------------------------------------------------- E10
def _e10_sql() -> str:
    def bound(v):
        return "CAST(NULL AS DOUBLE)" if v is None else f"CAST({v} AS DOUBLE)"

    parts = []
    for spec in FE.FEATURE_CATALOG:
        conds = ([f"{spec.name} < {spec.range_min}"] if spec.range_min is not None else []) + (
            [f"{spec.name} > {spec.range_max}"] if spec.range_max is not None else [])
        bad = f"COUNT(*) FILTER (WHERE {' OR '.join(conds)})" if conds else "CAST(0 AS BIGINT)"
        parts.append(f"SELECT '{spec.name}' AS name, {bound(spec.range_min)} AS range_min, "
                     f"{bound(spec.range_max)} AS range_max, COUNT({spec.name}) AS non_null, {bad} AS out_of_range "
                     f"FROM final")
    return FEATURES_SQL + "\n" + " UNION ALL ".join(parts)


@register("E10_catalog_range_check", _e10_sql())
def e10_catalog_range_check(dom):
    return FE.catalog_range_check(_features(dom))
