"""The relational part of the query corpus: projections, filters, sorts,
top-k, joins, aggregates, CASE classification and set operations
(SURVEY ids R*, J*, A*, U*).

Each query is written with the DataFrame API over the bound domain tables;
the decorator carries the equivalent SQL that the oracle runs on DuckDB.
Every computed column is aliased identically on both sides; decimals are
returned as DOUBLE and counts/ranks as BIGINT on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.numeric import avg2, dbl, exact_avg
from tessera.operators.relational import attach_group_stats, attach_scalar, fanout_student_metrics, not_in, table_counts
from tessera.plans.registry import register

# The four cities the corpus filters on, bound to nations.
CITY_A, CITY_B, CITY_C, CITY_D = "NATION_3", "NATION_7", "NATION_11", "NATION_19"


def _sid_name_city(dom):
    return dom.students().select("student_id", "full_name", "city")


# ---------------------------------------------------------------- R: select / where / order
@register("R1_students_by_id", "SELECT student_id, full_name, city FROM students ORDER BY student_id")
def r1_students_by_id(dom):
    return _sid_name_city(dom).orderBy("student_id")


@register("R1_students_by_city_name",
          "SELECT student_id, full_name, city FROM students ORDER BY city ASC, full_name ASC")
def r1_students_by_city_name(dom):
    return _sid_name_city(dom).orderBy("city", "full_name")


@register("R1_students_by_name", "SELECT student_id, full_name, city FROM students ORDER BY full_name ASC")
def r1_students_by_name(dom):
    return _sid_name_city(dom).orderBy("full_name", "student_id")


@register("R2_aliases", "SELECT student_id AS id, full_name AS student_name, city AS home_city FROM students")
def r2_aliases(dom):
    return dom.students().select(
        F.col("student_id").alias("id"), F.col("full_name").alias("student_name"), F.col("city").alias("home_city")
    )


@register("R2_arithmetic", "SELECT course_name, credit_hours, credit_hours * 2 AS doubled_hours FROM courses")
def r2_arithmetic(dom):
    return dom.courses().select("course_name", "credit_hours", (F.col("credit_hours") * 2).alias("doubled_hours"))


@register("R3_city_equals", f"SELECT student_id, full_name, city FROM students WHERE city = '{CITY_A}'")
def r3_city_equals(dom):
    return _sid_name_city(dom).where(F.col("city") == CITY_A)


@register("R3_city_or",
          f"SELECT student_id, full_name, city FROM students WHERE city = '{CITY_A}' OR city = '{CITY_B}'")
def r3_city_or(dom):
    return _sid_name_city(dom).where((F.col("city") == CITY_A) | (F.col("city") == CITY_B))


@register("R3_city_in_two",
          f"SELECT student_id, full_name, city FROM students WHERE city IN ('{CITY_A}', '{CITY_B}') "
          "ORDER BY city, full_name")
def r3_city_in_two(dom):
    return _sid_name_city(dom).where(F.col("city").isin(CITY_A, CITY_B)).orderBy("city", "full_name")


@register("R3_city_in_three",
          f"SELECT student_id, full_name, city FROM students WHERE city IN ('{CITY_A}', '{CITY_C}', '{CITY_D}')")
def r3_city_in_three(dom):
    return _sid_name_city(dom).where(F.col("city").isin(CITY_A, CITY_C, CITY_D))


@register("R3_city_not", f"SELECT student_id, full_name, city FROM students WHERE NOT city = '{CITY_A}'")
def r3_city_not(dom):
    # NOT on a NULL city yields NULL and drops the row, as in SQL
    return _sid_name_city(dom).where(~(F.col("city") == CITY_A))


@register("R3_high_scores",
          "SELECT student_id, course_id, assessment_type, CAST(score AS DOUBLE) AS score FROM assessments "
          "WHERE score >= 90 ORDER BY score DESC")
def r3_high_scores(dom):
    a = dom.assessments().where(F.col("score") >= 90)
    return a.orderBy(F.col("score").desc()).select("student_id", "course_id", "assessment_type", dbl("score").alias("score"))


@register("R3_score_band_and",
          "SELECT student_id, CAST(score AS DOUBLE) AS score FROM assessments "
          "WHERE score >= 80 AND score < 90 ORDER BY score DESC")
def r3_score_band_and(dom):
    a = dom.assessments().where((F.col("score") >= 80) & (F.col("score") < 90))
    return a.orderBy(F.col("score").desc()).select("student_id", dbl("score").alias("score"))


@register("R4_scores_desc",
          "SELECT assessment_id, CAST(score AS DOUBLE) AS score FROM assessments ORDER BY score DESC")
def r4_scores_desc(dom):
    return dom.assessments().orderBy(F.col("score").desc()).select("assessment_id", dbl("score").alias("score"))


@register("R4_scores_asc",
          "SELECT assessment_id, CAST(score AS DOUBLE) AS score FROM assessments ORDER BY score ASC")
def r4_scores_asc(dom):
    return dom.assessments().orderBy(F.col("score").asc()).select("assessment_id", dbl("score").alias("score"))


# top-k: the LIMIT is the feature; ties at the cut are broken by id on both sides
@register("R4_top10_scores",
          "SELECT assessment_id, student_id, CAST(score AS DOUBLE) AS score FROM assessments "
          "ORDER BY score DESC, assessment_id LIMIT 10")
def r4_top10_scores(dom):
    a = dom.assessments().orderBy(F.col("score").desc(), "assessment_id").limit(10)
    return a.select("assessment_id", "student_id", dbl("score").alias("score"))


@register("R4_top5_scores",
          "SELECT assessment_id, student_id, CAST(score AS DOUBLE) AS score FROM assessments "
          "ORDER BY score DESC, assessment_id LIMIT 5")
def r4_top5_scores(dom):
    a = dom.assessments().orderBy(F.col("score").desc(), "assessment_id").limit(5)
    return a.select("assessment_id", "student_id", dbl("score").alias("score"))


@register("R5_top_course_by_avg",
          """SELECT c.course_name, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
             FROM courses c JOIN assessments a ON c.course_id = a.course_id
             GROUP BY c.course_id, c.course_name ORDER BY average_score DESC, c.course_id LIMIT 1""")
def r5_top_course_by_avg(dom):
    per = dom.assessments().groupBy("course_id").agg(avg2("score").alias("average_score"))
    j = per.join(dom.courses().select("course_id", "course_name"), "course_id")
    top = j.orderBy(F.col("average_score").desc(), "course_id").limit(1)
    return top.select("course_name", dbl("average_score").alias("average_score"))


# ---------------------------------------------------------------- R8: CASE classification
@register("R8_score_bands",
          """SELECT assessment_id, student_id, CAST(score AS DOUBLE) AS score,
               CASE WHEN score >= 90 THEN 'Excellent' WHEN score >= 80 THEN 'Very Good'
                    WHEN score >= 70 THEN 'Good' WHEN score >= 60 THEN 'Pass' ELSE 'Weak' END AS performance_level
             FROM assessments ORDER BY score DESC""")
def r8_score_bands(dom):
    s = F.col("score")
    level = (F.when(s >= 90, "Excellent").when(s >= 80, "Very Good").when(s >= 70, "Good")
             .when(s >= 60, "Pass").otherwise("Weak"))
    a = dom.assessments().orderBy(s.desc())
    return a.select("assessment_id", "student_id", dbl(s).alias("score"), level.alias("performance_level"))


@register("R8_null_aware_bands",
          """SELECT student_id, CAST(score AS DOUBLE) AS score,
               CASE WHEN score IS NULL THEN 'Missing' WHEN score >= 90 THEN 'Excellent'
                    WHEN score >= 70 THEN 'Good' ELSE 'Weak' END AS score_status
             FROM assessments""")
def r8_null_aware_bands(dom):
    s = F.col("score")
    status = F.when(s.isNull(), "Missing").when(s >= 90, "Excellent").when(s >= 70, "Good").otherwise("Weak")
    return dom.assessments().select("student_id", dbl(s).alias("score"), status.alias("score_status"))


# ---------------------------------------------------------------- A: aggregates
@register("A1_total_students", "SELECT COUNT(*) AS total_students FROM students")
def a1_total_students(dom):
    return dom.students().agg(F.count(F.lit(1)).alias("total_students"))


@register("A1_avg_score", "SELECT CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score FROM assessments")
def a1_avg_score(dom):
    return dom.assessments().agg(dbl(avg2("score")).alias("average_score"))


@register("A1_score_extremes",
          "SELECT CAST(MAX(score) AS DOUBLE) AS highest_score, CAST(MIN(score) AS DOUBLE) AS lowest_score "
          "FROM assessments")
def a1_score_extremes(dom):
    return dom.assessments().agg(dbl(F.max("score")).alias("highest_score"), dbl(F.min("score")).alias("lowest_score"))


@register("A1_total_scores", "SELECT CAST(SUM(score) AS DOUBLE) AS total_scores FROM assessments")
def a1_total_scores(dom):
    return dom.assessments().agg(dbl(F.sum("score")).alias("total_scores"))


@register("A2_students_per_city",
          "SELECT city, COUNT(*) AS student_count FROM students GROUP BY city ORDER BY student_count DESC")
def a2_students_per_city(dom):
    return dom.students().groupBy("city").agg(F.count(F.lit(1)).alias("student_count")).orderBy(
        F.col("student_count").desc())


@register("A3_avg_per_student",
          "SELECT student_id, CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score FROM assessments "
          "GROUP BY student_id ORDER BY average_score DESC")
def a3_avg_per_student(dom):
    g = dom.assessments().groupBy("student_id").agg(avg2("score").alias("average_score"))
    return g.orderBy(F.col("average_score").desc()).select("student_id", dbl("average_score").alias("average_score"))


@register("A3_avg_per_course",
          "SELECT course_id, CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score FROM assessments "
          "GROUP BY course_id ORDER BY average_score DESC")
def a3_avg_per_course(dom):
    g = dom.assessments().groupBy("course_id").agg(avg2("score").alias("average_score"))
    return g.orderBy(F.col("average_score").desc()).select("course_id", dbl("average_score").alias("average_score"))


@register("A3_student_avg_by_id",
          "SELECT student_id, CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS student_avg FROM assessments "
          "GROUP BY student_id ORDER BY student_id")
def a3_student_avg_by_id(dom):
    g = dom.assessments().groupBy("student_id").agg(avg2("score").alias("student_avg"))
    return g.orderBy("student_id").select("student_id", dbl("student_avg").alias("student_avg"))


@register("A4_having_avg_85",
          "SELECT student_id, CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score FROM assessments "
          "GROUP BY student_id HAVING AVG(score) >= 85 ORDER BY average_score DESC")
def a4_having_avg_85(dom):
    # HAVING compares the unrounded average
    g = dom.assessments().groupBy("student_id").agg(exact_avg("score").alias("__avg"))
    g = g.where(F.col("__avg") >= 85).select("student_id", F.round("__avg", 2).alias("average_score"))
    return g.orderBy(F.col("average_score").desc()).select("student_id", dbl("average_score").alias("average_score"))


@register("A4_having_avg_gt_90_named",
          """SELECT s.student_id, s.full_name, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
             FROM students s JOIN assessments a ON s.student_id = a.student_id
             GROUP BY s.student_id, s.full_name HAVING AVG(a.score) > 90 ORDER BY average_score DESC""")
def a4_having_avg_gt_90_named(dom):
    g = dom.assessments().groupBy("student_id").agg(exact_avg("score").alias("__avg")).where(F.col("__avg") > 90)
    j = g.join(dom.students().select("student_id", "full_name"), "student_id")
    return j.orderBy(F.col("__avg").desc()).select(
        "student_id", "full_name", dbl(F.round("__avg", 2)).alias("average_score"))


@register("A4_having_count",
          """SELECT course_id, COUNT(*) AS assessment_count FROM assessments
             GROUP BY course_id HAVING COUNT(*) >= 100 ORDER BY assessment_count DESC""")
def a4_having_count(dom):
    g = dom.assessments().groupBy("course_id").agg(F.count(F.lit(1)).alias("assessment_count"))
    return g.where(F.col("assessment_count") >= 100).orderBy(F.col("assessment_count").desc())


@register("A5_above_university_mean",
          """SELECT s.student_id, s.full_name, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS student_avg
             FROM students s JOIN assessments a ON s.student_id = a.student_id
             GROUP BY s.student_id, s.full_name
             HAVING AVG(a.score) > (SELECT AVG(score) FROM assessments) ORDER BY student_avg DESC""")
def a5_above_university_mean(dom):
    a = dom.assessments()
    g = a.groupBy("student_id").agg(exact_avg("score").alias("__avg"))
    g = attach_scalar(g, a.agg(exact_avg("score").alias("__uni"))).where(F.col("__avg") > F.col("__uni"))
    j = g.join(dom.students().select("student_id", "full_name"), "student_id")
    return j.orderBy(F.col("__avg").desc()).select(
        "student_id", "full_name", dbl(F.round("__avg", 2)).alias("student_avg"))


def _hundred():
    return F.lit(100).cast("decimal(4,1)")  # NUMERIC 100.0, exact


def _band_sum(cond):
    return F.sum(F.when(cond, 1).otherwise(0))


@register("A6_band_counts",
          """SELECT COUNT(*) AS total_assessments,
               CAST(SUM(CASE WHEN score >= 90 THEN 1 ELSE 0 END) AS BIGINT) AS excellent_count,
               CAST(SUM(CASE WHEN score >= 80 AND score < 90 THEN 1 ELSE 0 END) AS BIGINT) AS very_good_count,
               CAST(SUM(CASE WHEN score >= 70 AND score < 80 THEN 1 ELSE 0 END) AS BIGINT) AS good_count,
               CAST(SUM(CASE WHEN score < 60 THEN 1 ELSE 0 END) AS BIGINT) AS weak_count
             FROM assessments""")
def a6_band_counts(dom):
    s = F.col("score")
    return dom.assessments().agg(
        F.count(F.lit(1)).alias("total_assessments"),
        _band_sum(s >= 90).cast("bigint").alias("excellent_count"),
        _band_sum((s >= 80) & (s < 90)).cast("bigint").alias("very_good_count"),
        _band_sum((s >= 70) & (s < 80)).cast("bigint").alias("good_count"),
        _band_sum(s < 60).cast("bigint").alias("weak_count"),
    )


@register("A7_band_percentages",
          """SELECT COUNT(*) AS total,
               CAST(ROUND(CAST(CAST(100.0 * SUM(CASE WHEN score >= 90 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS DECIMAL(38,9)), 2) AS DOUBLE) AS excellent_pct,
               CAST(ROUND(CAST(CAST(100.0 * SUM(CASE WHEN score < 60 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS DECIMAL(38,9)), 2) AS DOUBLE) AS weak_pct
             FROM assessments""")
def a7_band_percentages(dom):
    s = F.col("score")
    n = F.count(F.lit(1))
    return dom.assessments().agg(
        n.alias("total"),
        dbl(F.round(F.try_divide(_hundred() * _band_sum(s >= 90), n), 2)).alias("excellent_pct"),
        dbl(F.round(F.try_divide(_hundred() * _band_sum(s < 60), n), 2)).alias("weak_pct"),
    )


@register("A8_bands_by_course",
          """SELECT course_id, COUNT(*) AS total,
               CAST(SUM(CASE WHEN score >= 90 THEN 1 ELSE 0 END) AS BIGINT) AS excellent,
               CAST(SUM(CASE WHEN score < 60 THEN 1 ELSE 0 END) AS BIGINT) AS weak
             FROM assessments GROUP BY course_id ORDER BY course_id""")
def a8_bands_by_course(dom):
    s = F.col("score")
    g = dom.assessments().groupBy("course_id").agg(
        F.count(F.lit(1)).alias("total"),
        _band_sum(s >= 90).cast("bigint").alias("excellent"),
        _band_sum(s < 60).cast("bigint").alias("weak"),
    )
    return g.orderBy("course_id")


@register("A9_student_course_performance",
          """SELECT s.student_id, s.full_name AS student_name, c.course_name, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
             FROM assessments a JOIN students s ON a.student_id = s.student_id
             JOIN courses c ON a.course_id = c.course_id
             GROUP BY s.student_id, s.full_name, c.course_id, c.course_name ORDER BY average_score DESC""")
def a9_student_course_performance(dom):
    # aggregate the fact first, then attach the two dimensions
    g = dom.assessments().groupBy("student_id", "course_id").agg(avg2("score").alias("average_score"))
    j = g.join(dom.students().select("student_id", F.col("full_name").alias("student_name")), "student_id").join(
        dom.courses().select("course_id", "course_name"), "course_id")
    return j.orderBy(F.col("average_score").desc()).select(
        "student_id", "student_name", "course_name", dbl("average_score").alias("average_score"))


@register("A10_instructor_course_performance",
          """SELECT i.full_name AS instructor_name, c.course_name, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
             FROM assessments a JOIN courses c ON a.course_id = c.course_id
             JOIN instructors i ON c.instructor_id = i.instructor_id
             GROUP BY i.instructor_id, i.full_name, c.course_id, c.course_name ORDER BY average_score DESC""")
def a10_instructor_course_performance(dom):
    g = dom.assessments().groupBy("course_id").agg(avg2("score").alias("average_score"))
    c = dom.courses().select("course_id", "course_name", "instructor_id")
    i = dom.instructors().select("instructor_id", F.col("full_name").alias("instructor_name"))
    j = g.join(c, "course_id").join(i, "instructor_id")
    return j.orderBy(F.col("average_score").desc()).select(
        "instructor_name", "course_name", dbl("average_score").alias("average_score"))


@register("A11_ml_feature_table",
          """SELECT s.student_id, s.full_name AS student_name, s.city,
               COUNT(DISTINCT e.course_id) AS courses_count, COUNT(a.assessment_id) AS assessments_count,
               CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score,
               CAST(MAX(a.score) AS DOUBLE) AS highest_score, CAST(MIN(a.score) AS DOUBLE) AS lowest_score
             FROM students s LEFT JOIN enrollments e ON s.student_id = e.student_id
             LEFT JOIN assessments a ON s.student_id = a.student_id
             GROUP BY s.student_id, s.full_name, s.city ORDER BY average_score DESC NULLS FIRST""")
def a11_ml_feature_table(dom):
    m = fanout_student_metrics(_sid_name_city(dom), dom.enrollments(), dom.assessments())
    return m.orderBy(F.col("average_score").desc_nulls_first()).select(
        "student_id", F.col("full_name").alias("student_name"), "city", "courses_count", "assessments_count",
        dbl("average_score").alias("average_score"), dbl("highest_score").alias("highest_score"),
        dbl("lowest_score").alias("lowest_score"))


@register("R7_mini_task_report",
          """WITH student_metrics AS (
               SELECT s.student_id, s.full_name, s.city, COUNT(DISTINCT e.course_id) AS courses_count,
                 CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score, MAX(a.score) AS highest_score, MIN(a.score) AS lowest_score
               FROM students s LEFT JOIN enrollments e ON s.student_id = e.student_id
               LEFT JOIN assessments a ON s.student_id = a.student_id
               GROUP BY s.student_id, s.full_name, s.city)
             SELECT student_id, full_name AS student_name, city, courses_count, average_score,
               CAST(highest_score AS DOUBLE) AS highest_score, CAST(lowest_score AS DOUBLE) AS lowest_score
             FROM student_metrics WHERE average_score IS NOT NULL ORDER BY average_score DESC""")
def r7_mini_task_report(dom):
    m = fanout_student_metrics(_sid_name_city(dom), dom.enrollments(), dom.assessments())
    m = m.where(F.col("average_score").isNotNull())
    return m.orderBy(F.col("average_score").desc()).select(
        "student_id", F.col("full_name").alias("student_name"), "city", "courses_count",
        dbl("average_score").alias("average_score"), dbl("highest_score").alias("highest_score"),
        dbl("lowest_score").alias("lowest_score"))


def _student_averages(dom):
    return dom.assessments().groupBy("student_id").agg(avg2("score").alias("average_score"))


def _course_counts(dom):
    return dom.enrollments().groupBy("student_id").agg(F.count_distinct("course_id").alias("courses_count"))


@register("R9_cte_student_averages",
          """WITH student_averages AS (SELECT student_id, CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
                                       FROM assessments GROUP BY student_id)
             SELECT * FROM student_averages ORDER BY average_score DESC""")
def r9_cte_student_averages(dom):
    sa = _student_averages(dom)
    return sa.orderBy(F.col("average_score").desc()).select("student_id", dbl("average_score").alias("average_score"))


@register("R9_cte_filter_rounded",
          """WITH student_averages AS (SELECT student_id, CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
                                       FROM assessments GROUP BY student_id)
             SELECT * FROM student_averages WHERE average_score >= 90 ORDER BY average_score DESC""")
def r9_cte_filter_rounded(dom):
    # the CTE filter compares the *rounded* average
    sa = _student_averages(dom).where(F.col("average_score") >= 90)
    return sa.orderBy(F.col("average_score").desc()).select("student_id", dbl("average_score").alias("average_score"))


@register("R9_cte_join_names",
          """WITH student_averages AS (SELECT student_id, CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
                                       FROM assessments GROUP BY student_id)
             SELECT s.student_id, s.full_name, s.city, sa.average_score
             FROM students s JOIN student_averages sa ON s.student_id = sa.student_id
             ORDER BY sa.average_score DESC""")
def r9_cte_join_names(dom):
    j = _sid_name_city(dom).join(_student_averages(dom), "student_id")
    return j.orderBy(F.col("average_score").desc()).select(
        "student_id", "full_name", "city", dbl("average_score").alias("average_score"))


@register("A12_cte_coalesce",
          """WITH student_averages AS (SELECT student_id, CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
                                       FROM assessments GROUP BY student_id),
             course_counts AS (SELECT student_id, COUNT(DISTINCT course_id) AS courses_count
                               FROM enrollments GROUP BY student_id)
             SELECT s.student_id, s.full_name, s.city,
               CAST(COALESCE(sa.average_score, 0) AS DOUBLE) AS average_score,
               COALESCE(cc.courses_count, 0) AS courses_count
             FROM students s LEFT JOIN student_averages sa ON s.student_id = sa.student_id
             LEFT JOIN course_counts cc ON s.student_id = cc.student_id
             ORDER BY sa.average_score DESC NULLS LAST""")
def a12_cte_coalesce(dom):
    j = _sid_name_city(dom).join(_student_averages(dom), "student_id", "left").join(
        _course_counts(dom), "student_id", "left")
    return j.orderBy(F.col("average_score").desc_nulls_last()).select(
        "student_id", "full_name", "city",
        dbl(F.coalesce("average_score", F.lit(0))).alias("average_score"),
        F.coalesce("courses_count", F.lit(0)).alias("courses_count"))


@register("R9_cte_case_bands",
          """WITH student_averages AS (
               SELECT s.student_id, s.full_name, s.city, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
               FROM students s JOIN assessments a ON s.student_id = a.student_id
               GROUP BY s.student_id, s.full_name, s.city)
             SELECT student_id, full_name, city, CAST(average_score AS DOUBLE) AS average_score,
               CASE WHEN average_score >= 90 THEN 'Excellent' WHEN average_score >= 85 THEN 'Very Good'
                    WHEN average_score >= 75 THEN 'Good' WHEN average_score >= 65 THEN 'Pass'
                    ELSE 'Needs Improvement' END AS performance_level
             FROM student_averages ORDER BY average_score DESC""")
def r9_cte_case_bands(dom):
    j = _sid_name_city(dom).join(_student_averages(dom), "student_id")
    v = F.col("average_score")
    level = (F.when(v >= 90, "Excellent").when(v >= 85, "Very Good").when(v >= 75, "Good")
             .when(v >= 65, "Pass").otherwise("Needs Improvement"))
    return j.orderBy(v.desc()).select("student_id", "full_name", "city", dbl(v).alias("average_score"),
                                      level.alias("performance_level"))


@register("R9_three_cte_report",
          """WITH student_averages AS (SELECT student_id, CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
                                       FROM assessments GROUP BY student_id),
             course_counts AS (SELECT student_id, COUNT(DISTINCT course_id) AS courses_count
                               FROM enrollments GROUP BY student_id),
             student_metrics AS (
               SELECT s.student_id, s.full_name, s.city, sa.average_score, cc.courses_count
               FROM students s LEFT JOIN student_averages sa ON s.student_id = sa.student_id
               LEFT JOIN course_counts cc ON s.student_id = cc.student_id)
             SELECT student_id, full_name, city, CAST(average_score AS DOUBLE) AS average_score, courses_count,
               CASE WHEN average_score >= 90 THEN 'Excellent' WHEN average_score >= 80 THEN 'Very Good'
                    WHEN average_score >= 70 THEN 'Good' ELSE 'Needs Improvement' END AS performance_level
             FROM student_metrics ORDER BY average_score DESC NULLS LAST""")
def r9_three_cte_report(dom):
    j = _sid_name_city(dom).join(_student_averages(dom), "student_id", "left").join(
        _course_counts(dom), "student_id", "left")
    v = F.col("average_score")
    level = F.when(v >= 90, "Excellent").when(v >= 80, "Very Good").when(v >= 70, "Good").otherwise(
        "Needs Improvement")
    return j.orderBy(v.desc_nulls_last()).select(
        "student_id", "full_name", "city", dbl(v).alias("average_score"), "courses_count",
        level.alias("performance_level"))


@register("A14_class_mean_of_means",
          """WITH student_averages AS (SELECT student_id, CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
                                       FROM assessments GROUP BY student_id)
             SELECT student_id, CAST(average_score AS DOUBLE) AS average_score,
               (SELECT CAST(ROUND(CAST(AVG(average_score) AS DECIMAL(38,9)), 2) AS DOUBLE) FROM student_averages) AS class_average,
               CAST(ROUND(CAST(average_score - (SELECT AVG(average_score) FROM student_averages) AS DECIMAL(38,9)), 2) AS DOUBLE) AS diff_from_class
             FROM student_averages ORDER BY average_score DESC""")
def a14_class_mean_of_means(dom):
    sa = _student_averages(dom)
    cls = sa.agg(exact_avg("average_score").alias("__cls"))
    out = attach_scalar(sa, cls)
    return out.orderBy(F.col("average_score").desc()).select(
        "student_id", dbl("average_score").alias("average_score"),
        dbl(F.round("__cls", 2)).alias("class_average"),
        dbl(F.round(F.col("average_score") - F.col("__cls"), 2)).alias("diff_from_class"))


@register("A15_course_avg_beside_row",
          """SELECT a.assessment_id, a.student_id, a.course_id, CAST(a.score AS DOUBLE) AS score,
               (SELECT CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) FROM assessments WHERE course_id = a.course_id) AS course_avg
             FROM assessments a ORDER BY a.course_id, a.score DESC""")
def a15_course_avg_beside_row(dom):
    a = dom.assessments().select("assessment_id", "student_id", "course_id", "score")
    out = attach_group_stats(a, "course_id", [avg2("score").alias("course_avg")])
    return out.orderBy("course_id", F.col("score").desc()).select(
        "assessment_id", "student_id", "course_id", dbl("score").alias("score"), dbl("course_avg").alias("course_avg"))


# ---------------------------------------------------------------- J: joins
@register("J1_student_enrollments",
          """SELECT s.student_id, s.full_name AS student_name, e.course_id
             FROM students s INNER JOIN enrollments e ON s.student_id = e.student_id ORDER BY s.student_id""")
def j1_student_enrollments(dom):
    j = dom.students().select("student_id", F.col("full_name").alias("student_name")).join(
        dom.enrollments().select("student_id", "course_id"), "student_id")
    return j.orderBy("student_id").select("student_id", "student_name", "course_id")


def _student_course_names(dom):
    e = dom.enrollments().select("student_id", "course_id")
    s = dom.students().select("student_id", F.col("full_name").alias("student_name"))
    c = dom.courses().select("course_id", "course_name", "instructor_id")
    return e.join(s, "student_id").join(c, "course_id")


@register("J2_student_course_names",
          """SELECT s.student_id, s.full_name AS student_name, c.course_name
             FROM students s INNER JOIN enrollments e ON s.student_id = e.student_id
             INNER JOIN courses c ON e.course_id = c.course_id ORDER BY s.student_id, c.course_name""")
def j2_student_course_names(dom):
    j = _student_course_names(dom)
    return j.orderBy("student_id", "course_name").select("student_id", "student_name", "course_name")


@register("J2_student_course_instructor",
          """SELECT s.full_name AS student_name, c.course_name, i.full_name AS instructor_name
             FROM students s INNER JOIN enrollments e ON s.student_id = e.student_id
             INNER JOIN courses c ON e.course_id = c.course_id
             INNER JOIN instructors i ON c.instructor_id = i.instructor_id ORDER BY student_name""")
def j2_student_course_instructor(dom):
    i = dom.instructors().select("instructor_id", F.col("full_name").alias("instructor_name"))
    j = _student_course_names(dom).join(i, "instructor_id")
    return j.orderBy("student_name").select("student_name", "course_name", "instructor_name")


@register("J3_students_left_enrollments",
          """SELECT s.student_id, s.full_name, e.course_id
             FROM students s LEFT JOIN enrollments e ON s.student_id = e.student_id ORDER BY s.student_id""")
def j3_students_left_enrollments(dom):
    j = dom.students().select("student_id", "full_name").join(
        dom.enrollments().select("student_id", "course_id"), "student_id", "left")
    return j.orderBy("student_id").select("student_id", "full_name", "course_id")


@register("J4_students_without_enrollments",
          """SELECT s.student_id, s.full_name FROM students s
             LEFT JOIN enrollments e ON s.student_id = e.student_id WHERE e.student_id IS NULL""")
def j4_students_without_enrollments(dom):
    return dom.students().select("student_id", "full_name").join(
        dom.enrollments().select("student_id"), "student_id", "left_anti")


@register("J4_courses_without_assessments",
          """SELECT c.course_id, c.course_name FROM courses c
             LEFT JOIN assessments a ON c.course_id = a.course_id WHERE a.course_id IS NULL""")
def j4_courses_without_assessments(dom):
    return dom.courses().select("course_id", "course_name").join(
        dom.assessments().select("course_id"), "course_id", "left_anti")


@register("J5_enrolled_per_course",
          """SELECT c.course_name, COUNT(e.student_id) AS enrolled_students
             FROM courses c LEFT JOIN enrollments e ON c.course_id = e.course_id
             GROUP BY c.course_id, c.course_name ORDER BY enrolled_students DESC""")
def j5_enrolled_per_course(dom):
    # count on the enrollment side first, then keep every course
    per = dom.enrollments().groupBy("course_id").agg(F.count("student_id").alias("__n"))
    j = dom.courses().select("course_id", "course_name").join(per, "course_id", "left")
    out = j.select("course_name", F.coalesce("__n", F.lit(0)).alias("enrolled_students"))
    return out.orderBy(F.col("enrolled_students").desc())


@register("J5_distinct_students_per_course",
          """SELECT c.course_name, COUNT(DISTINCT e.student_id) AS students_count
             FROM courses c LEFT JOIN enrollments e ON c.course_id = e.course_id
             GROUP BY c.course_id, c.course_name ORDER BY students_count DESC""")
def j5_distinct_students_per_course(dom):
    per = dom.enrollments().groupBy("course_id").agg(F.count_distinct("student_id").alias("__n"))
    j = dom.courses().select("course_id", "course_name").join(per, "course_id", "left")
    out = j.select("course_name", F.coalesce("__n", F.lit(0)).alias("students_count"))
    return out.orderBy(F.col("students_count").desc())


@register("J6_students_scoring_90",
          """SELECT DISTINCT s.student_id, s.full_name, s.city FROM students s
             WHERE s.student_id IN (SELECT student_id FROM assessments WHERE score >= 90) ORDER BY s.student_id""")
def j6_students_scoring_90(dom):
    hi = dom.assessments().where(F.col("score") >= 90).select("student_id")
    return _sid_name_city(dom).join(hi, "student_id", "left_semi").distinct().orderBy("student_id")


@register("J7_students_never_95",
          """SELECT s.student_id, s.full_name FROM students s
             WHERE s.student_id NOT IN (SELECT DISTINCT student_id FROM assessments WHERE score >= 95)
             ORDER BY s.student_id""")
def j7_students_never_95(dom):
    hi = dom.assessments().where(F.col("score") >= 95).select("student_id")
    out = not_in(dom.students().select("student_id", "full_name"), hi, "student_id", "student_id")
    return out.orderBy("student_id")


@register("J8_exists_enrollment",
          """SELECT s.student_id, s.full_name FROM students s
             WHERE EXISTS (SELECT 1 FROM enrollments e WHERE e.student_id = s.student_id) ORDER BY s.student_id""")
def j8_exists_enrollment(dom):
    return dom.students().select("student_id", "full_name").join(
        dom.enrollments().select("student_id"), "student_id", "left_semi").orderBy("student_id")


@register("J9_top_score_holders",
          """SELECT s.student_id, s.full_name, CAST(a.score AS DOUBLE) AS score, a.course_id, a.assessment_type
             FROM students s JOIN assessments a ON s.student_id = a.student_id
             WHERE a.score = (SELECT MAX(score) FROM assessments)""")
def j9_top_score_holders(dom):
    a = dom.assessments()
    top = attach_scalar(a, a.agg(F.max("score").alias("__mx"))).where(F.col("score") == F.col("__mx"))
    j = top.join(dom.students().select("student_id", "full_name"), "student_id")
    return j.select("student_id", "full_name", dbl("score").alias("score"), "course_id", "assessment_type")


# ---------------------------------------------------------------- U: set operations
@register("U1_table_counts",
          """SELECT 'instructors' AS table_name, COUNT(*) AS row_count FROM instructors
             UNION ALL SELECT 'students', COUNT(*) FROM students
             UNION ALL SELECT 'courses', COUNT(*) FROM courses
             UNION ALL SELECT 'enrollments', COUNT(*) FROM enrollments
             UNION ALL SELECT 'assessments', COUNT(*) FROM assessments""")
def u1_table_counts(dom):
    return table_counts({
        "instructors": dom.instructors(), "students": dom.students(), "courses": dom.courses(),
        "enrollments": dom.enrollments(), "assessments": dom.assessments(),
    })
