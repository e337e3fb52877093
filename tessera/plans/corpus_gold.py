"""Gold-layer queries: star schema (G*) and the leakage-safe feature table
(E*, W24, W25, A17), each with a DuckDB oracle over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import cv as CV
from tessera.operators import features as FE
from tessera.operators import star as ST
from tessera.plans.corpus_silver import CLEAN_CTES, _clean
from tessera.plans.registry import register
from tessera.session import written


def _fact(dom):
    return ST.fact_student_performance(dom.assessments(), dom.enrollments(), dom.courses())


@register("G1_dim_students", "SELECT student_id, full_name, gender, date_of_birth, city FROM students")
def g1_dim_students(dom):
    return ST.dim_students(dom.students())


@register("G2_dim_courses", "SELECT course_id, course_name, CAST(credit_hours AS BIGINT) AS credit_hours, "
          "instructor_id FROM courses")
def g2_dim_courses(dom):
    return ST.dim_courses(dom.courses())


@register("G3_dim_instructors", "SELECT instructor_id, full_name, department, email FROM instructors")
def g3_dim_instructors(dom):
    return ST.dim_instructors(dom.instructors())


@register("G4_dim_time",
          """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_id, d AS full_date,
                    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
                    CAST(day(d) AS INTEGER) AS day, dayname(d) AS weekday, isodow(d) >= 6 AS is_weekend
             FROM (SELECT CAST(unnest(generate_series(MIN(enrollment_date), MAX(enrollment_date),
                                                      INTERVAL 1 DAY)) AS DATE) AS d FROM enrollments) t""")
def g4_dim_time(dom):
    return ST.dim_time(dom.enrollments())


FACT_SQL = """fact AS (
  SELECT a.assessment_id, e.enrollment_id, a.student_id, a.course_id, c.instructor_id, a.assessment_type,
         CAST(a.score AS DOUBLE) AS score
  FROM assessments a
  LEFT JOIN (SELECT student_id, course_id, MIN(enrollment_id) AS enrollment_id
             FROM enrollments GROUP BY student_id, course_id) e
    ON a.student_id = e.student_id AND a.course_id = e.course_id
  LEFT JOIN courses c ON a.course_id = c.course_id)"""


@register("G5_fact_student_performance", f"WITH {FACT_SQL} SELECT * FROM fact")
def g5_fact_student_performance(dom):
    return _fact(dom)


@register("G5_fact_grain_check",
          """SELECT COUNT(*) AS assessments,
                    COUNT(*) FILTER (WHERE m > 1) AS assessments_with_several_enrollments,
                    CAST(COALESCE(SUM(m) FILTER (WHERE m > 1), 0) AS BIGINT) AS rows_if_all_matches_kept
             FROM (SELECT a.assessment_id, COUNT(e.enrollment_id) AS m FROM assessments a
                   LEFT JOIN enrollments e ON a.student_id = e.student_id AND a.course_id = e.course_id
                   GROUP BY a.assessment_id) t""")
def g5_fact_grain_check(dom):
    # matches per (student, course) pair, pre-aggregated before the join
    m = dom.enrollments().groupBy("student_id", "course_id").agg(F.count(F.lit(1)).alias("m"))
    j = dom.assessments().select("assessment_id", "student_id", "course_id").join(
        m, ["student_id", "course_id"], "left").withColumn("m", F.coalesce("m", F.lit(0)))
    return j.agg(F.count(F.lit(1)).alias("assessments"),
                 F.count_if(F.col("m") > 1).alias("assessments_with_several_enrollments"),
                 F.coalesce(F.sum(F.when(F.col("m") > 1, F.col("m"))), F.lit(0)).cast("bigint").alias(
                     "rows_if_all_matches_kept"))


@register("G6_fact_enrollment",
          "SELECT enrollment_id, student_id, course_id, CAST(strftime(enrollment_date, '%Y%m%d') AS BIGINT) "
          "AS time_id, semester FROM enrollments")
def g6_fact_enrollment(dom):
    return ST.fact_enrollment(dom.enrollments())


# ---------------------------------------------------------------- features
@register("W24_score_change",
          f"""WITH {FACT_SQL},
              deltas AS (SELECT student_id, score - LAG(score) OVER (PARTITION BY student_id, course_id
                                                                     ORDER BY assessment_id) AS d FROM fact)
              SELECT student_id, ROUND(AVG(d), 6) AS score_change FROM deltas WHERE d IS NOT NULL
              GROUP BY student_id""")
def w24_score_change(dom):
    return FE.score_change(_fact(dom)).withColumn("score_change", F.round("score_change", 6))


@register("A17_mean_and_size_per_student",
          f"""WITH {FACT_SQL} SELECT student_id, ROUND(AVG(score), 6) AS avg_score, COUNT(*) AS n_assessments
              FROM fact GROUP BY student_id""")
def a17_mean_and_size_per_student(dom):
    return FE.per_student_scores(_fact(dom)).withColumn("avg_score", F.round("avg_score", 6))


def _features(dom):
    att = _clean(dom).select("student_id", "attendance")
    return FE.build_features(ST.dim_students(dom.students()), _fact(dom), [("csv_clean", att)])


FEATURES_SQL = f"""WITH {CLEAN_CTES}, {FACT_SQL},
agg AS (SELECT student_id, AVG(score) AS avg_score, COUNT(*) AS n_assessments FROM fact GROUP BY student_id),
deltas AS (SELECT student_id, score - LAG(score) OVER (PARTITION BY student_id, course_id ORDER BY assessment_id)
           AS d FROM fact),
chg AS (SELECT student_id, AVG(d) AS score_change FROM deltas WHERE d IS NOT NULL GROUP BY student_id),
gp AS (SELECT student_id, ROUND(AVG(score) / 25.0, 3) AS gpa FROM fact GROUP BY student_id),
att AS (SELECT student_id, attendance FROM cleaned),
flag AS (SELECT bool_or(x.attendance IS NOT NULL) AS has FROM students s LEFT JOIN att x
         ON s.student_id = x.student_id),
base AS (
  SELECT s.student_id, g.gpa,
         CASE WHEN (SELECT has FROM flag) THEN x.attendance ELSE 100.0 END AS attendance,
         a.avg_score, a.n_assessments,
         CASE WHEN a.student_id IS NULL THEN NULL ELSE COALESCE(ch.score_change, 0.0) END AS score_change,
         s.full_name, s.gender, s.date_of_birth, s.city
  FROM students s LEFT JOIN gp g ON s.student_id = g.student_id LEFT JOIN att x ON s.student_id = x.student_id
  LEFT JOIN agg a ON s.student_id = a.student_id LEFT JOIN chg ch ON s.student_id = ch.student_id),
ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY ('0x' || substr(md5('42:' || student_id), 1, 15))::BIGINT,
                                                 student_id) AS pos, COUNT(*) OVER () AS n FROM base),
split AS (SELECT * EXCLUDE (pos, n),
                 CASE WHEN pos <= GREATEST(1, CAST(round_even(n * 0.2, 0) AS BIGINT)) THEN 'test' ELSE 'train' END
                   AS split FROM ranked),
stats AS (SELECT COALESCE(median(gpa), 0.0) AS gm, COALESCE(median(attendance), 0.0) AS am,
                 COALESCE(median(avg_score), 0.0) AS sm FROM split WHERE split = 'train'),
filled AS (SELECT student_id, COALESCE(gpa, gm) AS gpa, COALESCE(attendance, am) AS attendance,
                  COALESCE(avg_score, sm) AS avg_score, n_assessments, score_change, full_name, gender,
                  date_of_birth, city, split FROM split, stats),
feat AS (SELECT *, ROUND(attendance / 100.0, 4) AS attendance_rate,
                ROUND((4.0 - gpa) + (100.0 - attendance) / 25.0, 4) AS academic_risk_score,
                CASE WHEN avg_score >= 90 THEN 'Excellent' WHEN avg_score >= 80 THEN 'Very Good'
                     WHEN avg_score >= 70 THEN 'Good' WHEN avg_score >= 60 THEN 'Pass' ELSE 'Weak' END
                  AS performance_level FROM filled),
cm AS (SELECT city, median(avg_score) AS cm FROM feat WHERE split = 'train' AND avg_score IS NOT NULL
       AND city IS NOT NULL GROUP BY city),
fb AS (SELECT COALESCE(median(avg_score), 0.0) AS fb FROM feat WHERE split = 'train' AND avg_score IS NOT NULL),
final AS (
  SELECT f.*,
    CASE WHEN f.city IS NULL OR f.avg_score IS NULL THEN 0.0
         ELSE ROUND(f.avg_score - COALESCE(cm.cm, fb.fb), 4) END AS city_score_gap,
    CASE WHEN f.city IS NULL OR f.avg_score IS NULL THEN NULL
         ELSE (SELECT CASE WHEN COUNT(*) = 0 THEN NULL ELSE 1 + COUNT(*) FILTER (WHERE t.avg_score > f.avg_score) END
               FROM feat t WHERE t.split = 'train' AND t.city = f.city AND t.avg_score IS NOT NULL) END AS city_rank
  FROM feat f LEFT JOIN cm ON f.city = cm.city CROSS JOIN fb)"""


@register("E11_feature_table",
          FEATURES_SQL + """
SELECT student_id, gpa, attendance, ROUND(avg_score, 6) AS avg_score, n_assessments,
       ROUND(score_change, 6) AS score_change, attendance_rate, academic_risk_score, performance_level,
       full_name, gender, date_of_birth, city, split, city_score_gap, city_rank FROM final""")
def e11_feature_table(dom):
    f = _features(dom)
    return f.select("student_id", "gpa", "attendance", F.round("avg_score", 6).alias("avg_score"), "n_assessments",
                    F.round("score_change", 6).alias("score_change"), "attendance_rate", "academic_risk_score",
                    "performance_level", "full_name", "gender", "date_of_birth", "city", "split",
                    "city_score_gap", "city_rank")


@register("E6_split_sizes",
          FEATURES_SQL + " SELECT split, COUNT(*) AS n FROM split GROUP BY split")
def e6_split_sizes(dom):
    base = FE.base_features(ST.dim_students(dom.students()), _fact(dom),
                            [("csv_clean", _clean(dom).select("student_id", "attendance"))])
    return FE.split_train_test(base).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("E7_train_medians",
          FEATURES_SQL + " SELECT gm AS gpa_median, am AS attendance_median, ROUND(sm, 6) AS avg_score_median "
                         "FROM stats")
def e7_train_medians(dom):
    base = FE.base_features(ST.dim_students(dom.students()), _fact(dom),
                            [("csv_clean", _clean(dom).select("student_id", "attendance"))])
    s = FE.train_statistics(FE.split_train_test(base))
    return s.withColumn("avg_score_median", F.round("avg_score_median", 6))


@register("Q6_feature_checks",
          FEATURES_SQL + """
SELECT 'not_null:student_id' AS rule, 'student_id' AS column_name,
       COUNT(*) FILTER (WHERE student_id IS NULL) AS failed_count FROM final
UNION ALL SELECT 'range:attendance_rate', 'attendance_rate',
       COUNT(*) FILTER (WHERE NOT (attendance_rate BETWEEN 0.0 AND 1.0)) FROM final
UNION ALL SELECT 'domain:performance_level', 'performance_level',
       COUNT(*) FILTER (WHERE NOT (performance_level IN ('Excellent', 'Very Good', 'Good', 'Pass', 'Weak'))) FROM final
UNION ALL SELECT 'domain:split', 'split', COUNT(*) FILTER (WHERE NOT COALESCE(split IN ('train', 'test'), FALSE))
       FROM final
UNION ALL SELECT 'unique:student_id', 'student_id',
       (SELECT COUNT(*) FROM (SELECT student_id FROM final GROUP BY student_id HAVING COUNT(*) > 1) d)""")
def q6_feature_checks(dom):
    return FE.validate_features(_features(dom))


# ---------------------------------------------------------------- M1
# Features of the first matrix, and the columns that must not be among them.
V1_NUMERIC = ["attendance_rate", "n_assessments", "score_change", "age"]
V1_CATEGORICAL = ["gender", "city"]
V1_EXCLUDED = ["avg_score", "academic_risk_score", "performance_level", "city_score_gap", "city_rank", "student_id", "full_name", "date_of_birth"]


@register("M1_feature_store_matrix",
          FEATURES_SQL + """
SELECT attendance_rate, n_assessments, ROUND(score_change, 6) AS score_change,
       CAST(round_even(datediff('day', date_of_birth, DATE '2026-10-10') / 365.25, 0) AS BIGINT) AS age, gender, city, gpa
FROM final WHERE n_assessments IS NOT NULL""")
def m1_feature_store_matrix(dom):
    """M1: the audited matrix of the feature store: students with scores (the audit refuses
    missing values), age as of the fixed date from a checked date of birth (C12)."""
    f = C.require_dob(_features(dom)).where(F.col("n_assessments").isNotNull())
    f = written(f.withColumn("age", C.age_from_dob(F.col("date_of_birth"), "2026-10-10")), "features")
    m = CV.feature_matrix(f, V1_NUMERIC, V1_CATEGORICAL, "gpa", V1_EXCLUDED)
    return m.withColumn("score_change", F.round("score_change", 6))
