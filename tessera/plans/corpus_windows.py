"""Window, ranking, LAG/LEAD and running-total queries of the corpus (W*),
plus the consolidated analytics report A13 (the flagship query).

Plans avoid single-task windows:

* ``AVG(..) OVER ()``            -> one-row aggregate, broadcast (attach_scalar)
* ``AVG(..) OVER (PARTITION BY)`` -> partial aggregate + join (attach_group_stats)
* ``RANK() OVER (ORDER BY ..)``, running totals, LAG/LEAD
                                  -> range-bucketed prefix (operators.sequence)
* top-1 per group               -> ``max`` of a struct (map-side partial agg)
* top-k by rank                 -> Spark's WindowGroupLimit (partial top-k
                                   before the shuffle) or TakeOrderedAndProject

PostgreSQL orders NULLs first under DESC; where NULLs can occur the Spark
plan and the oracle both say so explicitly.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.numeric import avg2, dbl, exact_avg
from tessera.operators.relational import attach_group_stats, attach_scalar
from tessera.operators.sequence import sequence
from tessera.plans.registry import register

# Labels used by the corpus reports.
IMPROVED, DECLINED, NO_CHANGE = "📈 Improved", "📉 Declined", "➡️ No Change"


def _named_student_avg(dom, how="inner"):
    """student_avg CTE: students JOIN assessments GROUP BY student, aggregated first."""
    g = dom.assessments().groupBy("student_id").agg(avg2("score").alias("average_score"))
    s = dom.students().select("student_id", "full_name", "city")
    return s.join(g, "student_id", how)


def _student_avg(dom):
    return dom.assessments().groupBy("student_id").agg(avg2("score").alias("average_score"))


# ---------------------------------------------------------------- W1-W5: partitioned aggregates
@register("W1_student_avg_per_row",
          """SELECT student_id, CAST(score AS DOUBLE) AS score,
               CAST(ROUND(CAST(AVG(score) OVER (PARTITION BY student_id) AS DECIMAL(38,9)), 2) AS DOUBLE) AS student_avg
             FROM assessments ORDER BY student_id, score""")
def w1_student_avg_per_row(dom):
    a = dom.assessments().select("student_id", "score")
    out = attach_group_stats(a, "student_id", [avg2("score").alias("student_avg")])
    return out.orderBy("student_id", "score").select(
        "student_id", dbl("score").alias("score"), dbl("student_avg").alias("student_avg"))


@register("W1_diff_from_student_avg",
          """SELECT assessment_id, student_id, course_id, CAST(score AS DOUBLE) AS score,
               CAST(ROUND(CAST(AVG(score) OVER (PARTITION BY student_id) AS DECIMAL(38,9)), 2) AS DOUBLE) AS student_avg,
               CAST(ROUND(CAST(score - AVG(score) OVER (PARTITION BY student_id) AS DECIMAL(38,9)), 2) AS DOUBLE) AS diff_from_student_avg
             FROM assessments ORDER BY student_id, score DESC""")
def w1_diff_from_student_avg(dom):
    a = dom.assessments().select("assessment_id", "student_id", "course_id", "score")
    out = attach_group_stats(a, "student_id", [exact_avg("score").alias("__avg")])
    return out.orderBy("student_id", F.col("score").desc()).select(
        "assessment_id", "student_id", "course_id", dbl("score").alias("score"),
        dbl(F.round("__avg", 2)).alias("student_avg"),
        dbl(F.round(F.col("score") - F.col("__avg"), 2)).alias("diff_from_student_avg"))


@register("W1_student_max_min_count",
          """SELECT assessment_id, student_id, CAST(score AS DOUBLE) AS score,
               CAST(MAX(score) OVER (PARTITION BY student_id) AS DOUBLE) AS student_max,
               CAST(MIN(score) OVER (PARTITION BY student_id) AS DOUBLE) AS student_min,
               COUNT(*) OVER (PARTITION BY student_id) AS student_assessments
             FROM assessments ORDER BY student_id, score DESC""")
def w1_student_max_min_count(dom):
    a = dom.assessments().select("assessment_id", "student_id", "score")
    out = attach_group_stats(a, "student_id", [
        F.max("score").alias("__mx"), F.min("score").alias("__mn"), F.count(F.lit(1)).alias("student_assessments")])
    return out.orderBy("student_id", F.col("score").desc()).select(
        "assessment_id", "student_id", dbl("score").alias("score"), dbl("__mx").alias("student_max"),
        dbl("__mn").alias("student_min"), "student_assessments")


@register("W1_student_total",
          """SELECT assessment_id, student_id, CAST(score AS DOUBLE) AS score,
               CAST(SUM(score) OVER (PARTITION BY student_id) AS DOUBLE) AS student_total
             FROM assessments ORDER BY student_id""")
def w1_student_total(dom):
    a = dom.assessments().select("assessment_id", "student_id", "score")
    out = attach_group_stats(a, "student_id", [F.sum("score").alias("__tot")])
    return out.orderBy("student_id").select(
        "assessment_id", "student_id", dbl("score").alias("score"), dbl("__tot").alias("student_total"))


@register("W2_course_avg_dev",
          """SELECT assessment_id, course_id, student_id, CAST(score AS DOUBLE) AS score,
               CAST(ROUND(CAST(AVG(score) OVER (PARTITION BY course_id) AS DECIMAL(38,9)), 2) AS DOUBLE) AS course_avg,
               CAST(ROUND(CAST(score - AVG(score) OVER (PARTITION BY course_id) AS DECIMAL(38,9)), 2) AS DOUBLE) AS diff_from_course_avg
             FROM assessments ORDER BY course_id, score DESC""")
def w2_course_avg_dev(dom):
    a = dom.assessments().select("assessment_id", "course_id", "student_id", "score")
    out = attach_group_stats(a, "course_id", [exact_avg("score").alias("__avg")])
    return out.orderBy("course_id", F.col("score").desc()).select(
        "assessment_id", "course_id", "student_id", dbl("score").alias("score"),
        dbl(F.round("__avg", 2)).alias("course_avg"),
        dbl(F.round(F.col("score") - F.col("__avg"), 2)).alias("diff_from_course_avg"))


@register("W3_university_avg_dev",
          """SELECT assessment_id, student_id, CAST(score AS DOUBLE) AS score,
               CAST(ROUND(CAST(AVG(score) OVER () AS DECIMAL(38,9)), 2) AS DOUBLE) AS university_avg,
               CAST(ROUND(CAST(score - AVG(score) OVER () AS DECIMAL(38,9)), 2) AS DOUBLE) AS diff_from_university
             FROM assessments ORDER BY score DESC""")
def w3_university_avg_dev(dom):
    a = dom.assessments().select("assessment_id", "student_id", "score")
    out = attach_scalar(a, a.agg(exact_avg("score").alias("__u")))
    return out.orderBy(F.col("score").desc()).select(
        "assessment_id", "student_id", dbl("score").alias("score"), dbl(F.round("__u", 2)).alias("university_avg"),
        dbl(F.round(F.col("score") - F.col("__u"), 2)).alias("diff_from_university"))


@register("W4_three_grains",
          """SELECT assessment_id, student_id, course_id, CAST(score AS DOUBLE) AS score,
               CAST(ROUND(CAST(AVG(score) OVER (PARTITION BY student_id) AS DECIMAL(38,9)), 2) AS DOUBLE) AS student_avg,
               CAST(ROUND(CAST(AVG(score) OVER (PARTITION BY course_id) AS DECIMAL(38,9)), 2) AS DOUBLE) AS course_avg,
               CAST(ROUND(CAST(AVG(score) OVER () AS DECIMAL(38,9)), 2) AS DOUBLE) AS university_avg
             FROM assessments ORDER BY student_id, assessment_id""")
def w4_three_grains(dom):
    a = dom.assessments().select("assessment_id", "student_id", "course_id", "score")
    out = attach_group_stats(a, "student_id", [avg2("score").alias("student_avg")])
    out = attach_group_stats(out, "course_id", [avg2("score").alias("course_avg")])
    out = attach_scalar(out, a.agg(avg2("score").alias("university_avg")))
    return out.orderBy("student_id", "assessment_id").select(
        "assessment_id", "student_id", "course_id", dbl("score").alias("score"), dbl("student_avg").alias("student_avg"),
        dbl("course_avg").alias("course_avg"), dbl("university_avg").alias("university_avg"))


@register("W5_position_vs_student_avg",
          """SELECT a.assessment_id, s.full_name AS student_name, c.course_name, CAST(a.score AS DOUBLE) AS score,
               CAST(ROUND(CAST(AVG(a.score) OVER (PARTITION BY a.student_id) AS DECIMAL(38,9)), 2) AS DOUBLE) AS student_avg,
               CAST(ROUND(CAST(AVG(a.score) OVER (PARTITION BY a.course_id) AS DECIMAL(38,9)), 2) AS DOUBLE) AS course_avg,
               CAST(ROUND(CAST(AVG(a.score) OVER () AS DECIMAL(38,9)), 2) AS DOUBLE) AS university_avg,
               CASE WHEN a.score > AVG(a.score) OVER (PARTITION BY a.student_id) THEN 'Above Student Avg'
                    WHEN a.score < AVG(a.score) OVER (PARTITION BY a.student_id) THEN 'Below Student Avg'
                    ELSE 'At Student Avg' END AS student_position
             FROM assessments a INNER JOIN students s ON a.student_id = s.student_id
             INNER JOIN courses c ON a.course_id = c.course_id
             ORDER BY a.student_id, a.score DESC""")
def w5_position_vs_student_avg(dom):
    # the windows run over the joined rows; joins are inner on keys that
    # always resolve, so the aggregates are taken after the joins as in SQL
    a = dom.assessments().select("assessment_id", "student_id", "course_id", "score")
    j = a.join(dom.students().select("student_id", F.col("full_name").alias("student_name")), "student_id").join(
        dom.courses().select("course_id", "course_name"), "course_id")
    out = attach_group_stats(j, "student_id", [exact_avg("score").alias("__savg")])
    out = attach_group_stats(out, "course_id", [avg2("score").alias("course_avg")])
    out = attach_scalar(out, j.agg(avg2("score").alias("university_avg")))
    s, m = F.col("score"), F.col("__savg")
    pos = F.when(s > m, "Above Student Avg").when(s < m, "Below Student Avg").otherwise("At Student Avg")
    return out.orderBy("student_id", s.desc()).select(
        "assessment_id", "student_name", "course_name", dbl(s).alias("score"),
        dbl(F.round(m, 2)).alias("student_avg"), dbl("course_avg").alias("course_avg"),
        dbl("university_avg").alias("university_avg"), pos.alias("student_position"))


# ---------------------------------------------------------------- W6-W14: ranking
@register("W6_row_rank_dense_global",
          """SELECT assessment_id, student_id, CAST(score AS DOUBLE) AS score,
               ROW_NUMBER() OVER (ORDER BY score DESC, assessment_id) AS row_num,
               RANK() OVER (ORDER BY score DESC) AS rank_val,
               DENSE_RANK() OVER (ORDER BY score DESC) AS dense_rank_val
             FROM assessments ORDER BY score DESC""")
def w6_row_rank_dense_global(dom):
    a = dom.assessments().select("assessment_id", "student_id", "score")
    r = sequence(a, ["score desc", "assessment_id"], peers=1,
                 row_number="row_num", rank="rank_val", dense_rank="dense_rank_val")
    return r.orderBy(F.col("score").desc()).select(
        "assessment_id", "student_id", dbl("score").alias("score"), "row_num", "rank_val", "dense_rank_val")


@register("W6_row_number_global",
          """SELECT student_id, CAST(score AS DOUBLE) AS score,
               ROW_NUMBER() OVER (ORDER BY score DESC, assessment_id) AS row_num
             FROM assessments ORDER BY row_num""")
def w6_row_number_global(dom):
    a = dom.assessments().select("assessment_id", "student_id", "score")
    r = sequence(a, ["score desc", "assessment_id"], row_number="row_num")
    return r.orderBy("row_num").select("student_id", dbl("score").alias("score"), "row_num")


@register("W6_top10_rank_gap",
          """SELECT CAST(score AS DOUBLE) AS score, RANK() OVER (ORDER BY score DESC) AS rank_gap,
               DENSE_RANK() OVER (ORDER BY score DESC) AS rank_dense
             FROM assessments ORDER BY score DESC LIMIT 10""")
def w6_top10_rank_gap(dom):
    # every row ranked ahead of a top-10 row is itself in the top 10, so the
    # ranks are exact when computed over the 10 rows TakeOrderedAndProject keeps
    top = dom.assessments().select("score").orderBy(F.col("score").desc()).limit(10)
    w = Window.orderBy(F.col("score").desc())
    return top.select(dbl("score").alias("score"), F.rank().over(w).cast("bigint").alias("rank_gap"),
                      F.dense_rank().over(w).cast("bigint").alias("rank_dense"))


@register("W7_row_number_within_student",
          """SELECT student_id, assessment_id, CAST(score AS DOUBLE) AS score,
               ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, assessment_id)
                 AS score_rank_within_student
             FROM assessments ORDER BY student_id, score_rank_within_student""")
def w7_row_number_within_student(dom):
    a = dom.assessments().select("student_id", "assessment_id", "score")
    r = sequence(a, ["score desc", "assessment_id"], ["student_id"], row_number="score_rank_within_student")
    return r.orderBy("student_id", "score_rank_within_student").select(
        "student_id", "assessment_id", dbl("score").alias("score"), "score_rank_within_student")


@register("W8_rank_of_student_avg",
          """WITH student_avg AS (SELECT student_id, CAST(ROUND(CAST(AVG(score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
                                  FROM assessments GROUP BY student_id)
             SELECT student_id, CAST(average_score AS DOUBLE) AS average_score,
               RANK() OVER (ORDER BY average_score DESC) AS student_rank
             FROM student_avg ORDER BY student_rank""")
def w8_rank_of_student_avg(dom):
    r = sequence(_student_avg(dom), ["average_score desc nulls first"], rank="student_rank")
    return r.orderBy("student_rank").select("student_id", dbl("average_score").alias("average_score"), "student_rank")


@register("W8_named_student_ranking",
          """WITH student_avg AS (
               SELECT s.student_id, s.full_name, s.city, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
               FROM students s JOIN assessments a ON s.student_id = a.student_id
               GROUP BY s.student_id, s.full_name, s.city)
             SELECT student_id, full_name, city, CAST(average_score AS DOUBLE) AS average_score,
               RANK() OVER (ORDER BY average_score DESC) AS student_rank
             FROM student_avg ORDER BY student_rank""")
def w8_named_student_ranking(dom):
    r = sequence(_named_student_avg(dom), ["average_score desc nulls first"], rank="student_rank")
    return r.orderBy("student_rank").select(
        "student_id", "full_name", "city", dbl("average_score").alias("average_score"), "student_rank")


def _university_and_city_rank(dom):
    sa = _named_student_avg(dom)
    r = sequence(sa, ["average_score desc nulls first"], rank="university_rank")
    return sequence(r, ["average_score desc nulls first"], ["city"], rank="city_rank")


@register("W9_university_and_city_rank",
          """WITH student_metrics AS (
               SELECT s.student_id, s.full_name, s.city, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
               FROM students s JOIN assessments a ON s.student_id = a.student_id
               GROUP BY s.student_id, s.full_name, s.city)
             SELECT student_id, full_name, city, CAST(average_score AS DOUBLE) AS average_score,
               RANK() OVER (ORDER BY average_score DESC) AS university_rank,
               RANK() OVER (PARTITION BY city ORDER BY average_score DESC) AS city_rank
             FROM student_metrics ORDER BY university_rank""")
def w9_university_and_city_rank(dom):
    r = _university_and_city_rank(dom)
    return r.orderBy("university_rank").select(
        "student_id", "full_name", "city", dbl("average_score").alias("average_score"), "university_rank", "city_rank")


@register("W9_city_ranking_report",
          """WITH student_avg AS (
               SELECT s.student_id, s.full_name, s.city, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
               FROM students s JOIN assessments a ON s.student_id = a.student_id
               GROUP BY s.student_id, s.full_name, s.city)
             SELECT city, RANK() OVER (PARTITION BY city ORDER BY average_score DESC) AS city_rank,
               student_id, full_name, CAST(average_score AS DOUBLE) AS average_score,
               RANK() OVER (ORDER BY average_score DESC) AS university_rank
             FROM student_avg ORDER BY city, city_rank""")
def w9_city_ranking_report(dom):
    r = _university_and_city_rank(dom)
    return r.orderBy("city", "city_rank").select(
        "city", "city_rank", "student_id", "full_name", dbl("average_score").alias("average_score"), "university_rank")


@register("W10_best_per_student",
          """WITH ranked_scores AS (
               SELECT student_id, assessment_id, course_id, score,
                 ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, assessment_id) AS rn
               FROM assessments)
             SELECT student_id, assessment_id, course_id, CAST(score AS DOUBLE) AS score
             FROM ranked_scores WHERE rn = 1 ORDER BY student_id""")
def w10_best_per_student(dom):
    # rn = 1 is a per-group arg-max: a struct max aggregates map-side, so a
    # hot student costs one partial row per task, not one task for all rows
    a = dom.assessments()
    best = a.groupBy("student_id").agg(
        F.max(F.struct(F.col("score"), (-F.col("assessment_id")).alias("neg_id"), F.col("course_id"))).alias("b"))
    return best.orderBy("student_id").select(
        "student_id", (-F.col("b.neg_id")).alias("assessment_id"), F.col("b.course_id").alias("course_id"),
        dbl("b.score").alias("score"))


@register("W10_top2_per_student",
          """WITH ranked_scores AS (
               SELECT student_id, assessment_id, course_id, score,
                 ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, assessment_id) AS rn
               FROM assessments)
             SELECT student_id, assessment_id, course_id, CAST(score AS DOUBLE) AS score, rn AS position
             FROM ranked_scores WHERE rn <= 2 ORDER BY student_id, rn""")
def w10_top2_per_student(dom):
    # filter on row_number <= k becomes WindowGroupLimit: a partial top-k runs
    # before the shuffle, so each task ships at most k rows per student
    w = Window.partitionBy("student_id").orderBy(F.col("score").desc(), "assessment_id")
    r = dom.assessments().select("student_id", "assessment_id", "course_id", "score",
                                 F.row_number().over(w).alias("rn")).where(F.col("rn") <= 2)
    return r.orderBy("student_id", "rn").select(
        "student_id", "assessment_id", "course_id", dbl("score").alias("score"), F.col("rn").cast("bigint").alias("position"))


def _top3_students(dom):
    # ranks come from counts per average, so any number of ties for a place stays spread out
    sa = _named_student_avg(dom)
    return sequence(sa, ["average_score desc nulls first"], rank="student_rank").where(F.col("student_rank") <= 3)


@register("W11_top3_students",
          """WITH student_avg AS (
               SELECT s.student_id, s.full_name, s.city, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
               FROM students s JOIN assessments a ON s.student_id = a.student_id
               GROUP BY s.student_id, s.full_name, s.city),
             ranked AS (SELECT *, RANK() OVER (ORDER BY average_score DESC) AS student_rank FROM student_avg)
             SELECT student_rank, student_id, full_name, city, CAST(average_score AS DOUBLE) AS average_score
             FROM ranked WHERE student_rank <= 3 ORDER BY student_rank""")
def w11_top3_students(dom):
    return _top3_students(dom).orderBy("student_rank").select(
        "student_rank", "student_id", "full_name", "city", dbl("average_score").alias("average_score"))


@register("W12_rank_and_dense_all",
          """WITH student_avg AS (
               SELECT s.student_id, s.full_name, s.city, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
               FROM students s JOIN assessments a ON s.student_id = a.student_id
               GROUP BY s.student_id, s.full_name, s.city)
             SELECT RANK() OVER (ORDER BY average_score DESC) AS student_rank,
               DENSE_RANK() OVER (ORDER BY average_score DESC) AS dense_rank,
               student_id, full_name, city, CAST(average_score AS DOUBLE) AS average_score
             FROM student_avg ORDER BY student_rank""")
def w12_rank_and_dense_all(dom):
    r = sequence(_named_student_avg(dom), ["average_score desc nulls first"], rank="student_rank",
                 dense_rank="dense_rank")
    return r.orderBy("student_rank").select(
        "student_rank", "dense_rank", "student_id", "full_name", "city", dbl("average_score").alias("average_score"))


@register("W13_medals",
          """WITH student_avg AS (
               SELECT s.student_id, s.full_name, s.city, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
               FROM students s JOIN assessments a ON s.student_id = a.student_id
               GROUP BY s.student_id, s.full_name, s.city),
             ranked AS (SELECT *, RANK() OVER (ORDER BY average_score DESC) AS university_rank,
                          DENSE_RANK() OVER (ORDER BY average_score DESC) AS dense_rank FROM student_avg)
             SELECT university_rank, student_id, full_name, city, CAST(average_score AS DOUBLE) AS average_score,
               CASE WHEN university_rank = 1 THEN '🥇 Gold' WHEN university_rank = 2 THEN '🥈 Silver'
                    WHEN university_rank = 3 THEN '🥉 Bronze' WHEN average_score >= 85 THEN '⭐ Honor'
                    WHEN average_score >= 75 THEN '✅ Good' ELSE '📚 Needs Improvement' END AS achievement
             FROM ranked ORDER BY university_rank""")
def w13_medals(dom):
    r = sequence(_named_student_avg(dom), ["average_score desc nulls first"], rank="university_rank")
    k, v = F.col("university_rank"), F.col("average_score")
    medal = (F.when(k == 1, "🥇 Gold").when(k == 2, "🥈 Silver").when(k == 3, "🥉 Bronze")
             .when(v >= 85, "⭐ Honor").when(v >= 75, "✅ Good").otherwise("📚 Needs Improvement"))
    return r.orderBy(k).select("university_rank", "student_id", "full_name", "city", dbl(v).alias("average_score"),
                               medal.alias("achievement"))


@register("W14_course_ranking",
          """WITH course_avg AS (
               SELECT c.course_id, c.course_name, i.full_name AS instructor_name,
                 CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score, COUNT(a.assessment_id) AS assessment_count
               FROM courses c JOIN assessments a ON c.course_id = a.course_id
               JOIN instructors i ON c.instructor_id = i.instructor_id
               GROUP BY c.course_id, c.course_name, i.full_name)
             SELECT RANK() OVER (ORDER BY average_score DESC) AS course_rank, course_id, course_name,
               instructor_name, assessment_count, CAST(average_score AS DOUBLE) AS average_score
             FROM course_avg ORDER BY course_rank""")
def w14_course_ranking(dom):
    g = dom.assessments().groupBy("course_id").agg(
        avg2("score").alias("average_score"), F.count("assessment_id").alias("assessment_count"))
    c = dom.courses().select("course_id", "course_name", "instructor_id")
    i = dom.instructors().select("instructor_id", F.col("full_name").alias("instructor_name"))
    j = g.join(c, "course_id").join(i, "instructor_id")
    r = sequence(j, ["average_score desc nulls first"], rank="course_rank")
    return r.orderBy("course_rank").select(
        "course_rank", "course_id", "course_name", "instructor_name", "assessment_count",
        dbl("average_score").alias("average_score"))


@register("R8_performance_classification",
          """WITH student_avg AS (
               SELECT s.student_id, s.full_name, s.city, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
               FROM students s JOIN assessments a ON s.student_id = a.student_id
               GROUP BY s.student_id, s.full_name, s.city)
             SELECT student_id, full_name, city, CAST(average_score AS DOUBLE) AS average_score,
               CASE WHEN average_score >= 90 THEN 'Excellent' WHEN average_score >= 80 THEN 'Very Good'
                    WHEN average_score >= 70 THEN 'Good' WHEN average_score >= 60 THEN 'Pass' ELSE 'Weak'
               END AS performance_level,
               CASE WHEN average_score >= 85 THEN 'Top Performer' WHEN average_score >= 75 THEN 'Average'
                    ELSE 'Needs Improvement' END AS overall_status
             FROM student_avg ORDER BY average_score DESC""")
def r8_performance_classification(dom):
    v = F.col("average_score")
    level = (F.when(v >= 90, "Excellent").when(v >= 80, "Very Good").when(v >= 70, "Good")
             .when(v >= 60, "Pass").otherwise("Weak"))
    status = F.when(v >= 85, "Top Performer").when(v >= 75, "Average").otherwise("Needs Improvement")
    return _named_student_avg(dom).orderBy(v.desc()).select(
        "student_id", "full_name", "city", dbl(v).alias("average_score"), level.alias("performance_level"),
        status.alias("overall_status"))


# ---------------------------------------------------------------- W15-W22: LAG / LEAD / running
def _with_prev(dom, cols=("student_id", "course_id", "assessment_id", "assessment_type", "score"), lead=False):
    a = dom.assessments().select(*cols)
    kw = {"lag": {"previous_score": "score"}}
    if lead:
        kw["lead"] = {"next_score": "score"}
    return sequence(a, ["assessment_id"], ["student_id", "course_id"], **kw)


@register("W15_lag_previous_score",
          """SELECT student_id, course_id, assessment_id, assessment_type, CAST(score AS DOUBLE) AS score,
               CAST(LAG(score) OVER (PARTITION BY student_id, course_id ORDER BY assessment_id) AS DOUBLE)
                 AS previous_score
             FROM assessments ORDER BY student_id, course_id, assessment_id""")
def w15_lag_previous_score(dom):
    r = _with_prev(dom)
    return r.orderBy("student_id", "course_id", "assessment_id").select(
        "student_id", "course_id", "assessment_id", "assessment_type", dbl("score").alias("score"),
        dbl("previous_score").alias("previous_score"))


@register("W16_change_vs_previous",
          """SELECT student_id, course_id, assessment_type, assessment_id, CAST(score AS DOUBLE) AS current_score,
               CAST(LAG(score) OVER (PARTITION BY student_id, course_id ORDER BY assessment_id) AS DOUBLE)
                 AS previous_score,
               CAST(score - LAG(score) OVER (PARTITION BY student_id, course_id ORDER BY assessment_id) AS DOUBLE)
                 AS score_change
             FROM assessments ORDER BY student_id, course_id, assessment_id""")
def w16_change_vs_previous(dom):
    r = _with_prev(dom)
    return r.orderBy("student_id", "course_id", "assessment_id").select(
        "student_id", "course_id", "assessment_type", "assessment_id", dbl("score").alias("current_score"),
        dbl("previous_score").alias("previous_score"),
        dbl(F.col("score") - F.col("previous_score")).alias("score_change"))


@register("W16_progress_status",
          f"""WITH progress AS (
               SELECT student_id, course_id, assessment_type, assessment_id, score,
                 LAG(score) OVER (PARTITION BY student_id, course_id ORDER BY assessment_id) AS previous_score
               FROM assessments)
             SELECT student_id, course_id, assessment_type, CAST(score AS DOUBLE) AS current_score,
               CAST(previous_score AS DOUBLE) AS previous_score,
               CAST(score - previous_score AS DOUBLE) AS score_change,
               CASE WHEN previous_score IS NULL THEN 'First Assessment'
                    WHEN score > previous_score THEN '{IMPROVED}'
                    WHEN score < previous_score THEN '{DECLINED}' ELSE '{NO_CHANGE}' END AS progress_status
             FROM progress ORDER BY student_id, course_id, assessment_id""")
def w16_progress_status(dom):
    r = _with_prev(dom)
    s, p = F.col("score"), F.col("previous_score")
    status = F.when(p.isNull(), "First Assessment").when(s > p, IMPROVED).when(s < p, DECLINED).otherwise(NO_CHANGE)
    return r.orderBy("student_id", "course_id", "assessment_id").select(
        "student_id", "course_id", "assessment_type", dbl(s).alias("current_score"), dbl(p).alias("previous_score"),
        dbl(s - p).alias("score_change"), status.alias("progress_status"))


@register("W16_progress_named",
          """WITH progress AS (
               SELECT s.full_name AS student_name, c.course_name, a.assessment_type, a.assessment_id, a.score,
                 LAG(a.score) OVER (PARTITION BY a.student_id, a.course_id ORDER BY a.assessment_id) AS previous_score
               FROM assessments a INNER JOIN students s ON a.student_id = s.student_id
               INNER JOIN courses c ON a.course_id = c.course_id)
             SELECT student_name, course_name, assessment_type, CAST(score AS DOUBLE) AS current_score,
               CAST(previous_score AS DOUBLE) AS previous_score, CAST(score - previous_score AS DOUBLE) AS score_change,
               CASE WHEN previous_score IS NULL THEN 'First Assessment' WHEN score > previous_score THEN 'Improved'
                    WHEN score < previous_score THEN 'Declined' ELSE 'No Change' END AS progress_status
             FROM progress WHERE previous_score IS NOT NULL ORDER BY student_name, course_name""")
def w16_progress_named(dom):
    r = _with_prev(dom).where(F.col("previous_score").isNotNull())
    r = r.join(dom.students().select("student_id", F.col("full_name").alias("student_name")), "student_id").join(
        dom.courses().select("course_id", "course_name"), "course_id")
    s, p = F.col("score"), F.col("previous_score")
    status = F.when(p.isNull(), "First Assessment").when(s > p, "Improved").when(s < p, "Declined").otherwise(
        "No Change")
    return r.orderBy("student_name", "course_name").select(
        "student_name", "course_name", "assessment_type", dbl(s).alias("current_score"), dbl(p).alias("previous_score"),
        dbl(s - p).alias("score_change"), status.alias("progress_status"))


@register("W17_lead_next_score",
          """SELECT student_id, course_id, assessment_id, assessment_type, CAST(score AS DOUBLE) AS score,
               CAST(LEAD(score) OVER (PARTITION BY student_id, course_id ORDER BY assessment_id) AS DOUBLE)
                 AS next_score
             FROM assessments ORDER BY student_id, course_id, assessment_id""")
def w17_lead_next_score(dom):
    a = dom.assessments().select("student_id", "course_id", "assessment_id", "assessment_type", "score")
    r = sequence(a, ["assessment_id"], ["student_id", "course_id"], lead={"next_score": "score"})
    return r.orderBy("student_id", "course_id", "assessment_id").select(
        "student_id", "course_id", "assessment_id", "assessment_type", dbl("score").alias("score"),
        dbl("next_score").alias("next_score"))


@register("W17_lag_and_lead",
          """SELECT student_id, course_id, assessment_type, assessment_id, CAST(score AS DOUBLE) AS score,
               CAST(LAG(score) OVER (PARTITION BY student_id, course_id ORDER BY assessment_id) AS DOUBLE) AS previous,
               CAST(score AS DOUBLE) AS current,
               CAST(LEAD(score) OVER (PARTITION BY student_id, course_id ORDER BY assessment_id) AS DOUBLE) AS next
             FROM assessments ORDER BY student_id, course_id, assessment_id""")
def w17_lag_and_lead(dom):
    r = _with_prev(dom, lead=True)
    return r.orderBy("student_id", "course_id", "assessment_id").select(
        "student_id", "course_id", "assessment_type", "assessment_id", dbl("score").alias("score"),
        dbl("previous_score").alias("previous"), dbl("score").alias("current"), dbl("next_score").alias("next"))


@register("W18_global_running_total",
          """SELECT assessment_id, student_id, CAST(score AS DOUBLE) AS score,
               CAST(SUM(score) OVER (ORDER BY assessment_id) AS DOUBLE) AS running_total
             FROM assessments ORDER BY assessment_id""")
def w18_global_running_total(dom):
    a = dom.assessments().select("assessment_id", "student_id", "score")
    r = sequence(a, ["assessment_id"], range_sum={"running_total": "score"})
    return r.orderBy("assessment_id").select(
        "assessment_id", "student_id", dbl("score").alias("score"), dbl("running_total").alias("running_total"))


@register("W19_running_total_default_frame",
          """SELECT student_id, assessment_id, CAST(score AS DOUBLE) AS score,
               CAST(SUM(score) OVER (PARTITION BY student_id ORDER BY assessment_id) AS DOUBLE) AS running_total
             FROM assessments ORDER BY student_id, assessment_id""")
def w19_running_total_default_frame(dom):
    a = dom.assessments().select("student_id", "assessment_id", "score")
    r = sequence(a, ["assessment_id"], ["student_id"], range_sum={"running_total": "score"})
    return r.orderBy("student_id", "assessment_id").select(
        "student_id", "assessment_id", dbl("score").alias("score"), dbl("running_total").alias("running_total"))


@register("W19_running_total_rows_frame",
          """SELECT student_id, assessment_id, CAST(score AS DOUBLE) AS score,
               CAST(SUM(score) OVER (PARTITION BY student_id ORDER BY assessment_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
             FROM assessments ORDER BY student_id, assessment_id""")
def w19_running_total_rows_frame(dom):
    a = dom.assessments().select("student_id", "assessment_id", "score")
    r = sequence(a, ["assessment_id"], ["student_id"], running_sum={"running_total": "score"})
    return r.orderBy("student_id", "assessment_id").select(
        "student_id", "assessment_id", dbl("score").alias("score"), dbl("running_total").alias("running_total"))


def _running_avg(df, part, order, src, out):
    """CAST(ROUND(CAST(AVG(src) OVER (.. ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,9)), 2) AS DOUBLE) as exact sum / count."""
    df = df.withColumn("__one", F.when(F.col(src).isNotNull(), F.lit(1)))
    r = sequence(df, order, part, running_sum={"__rs": src, "__rc": "__one"})
    return r.withColumn(out, F.round(F.try_divide(F.col("__rs"), F.col("__rc")), 2)).drop("__one", "__rc")


@register("W20_running_avg",
          """SELECT student_id, assessment_id, CAST(score AS DOUBLE) AS score,
               CAST(ROUND(CAST(AVG(score) OVER (PARTITION BY student_id ORDER BY assessment_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,9)), 2) AS DOUBLE) AS running_avg
             FROM assessments ORDER BY student_id, assessment_id""")
def w20_running_avg(dom):
    a = dom.assessments().select("student_id", "assessment_id", "score")
    r = _running_avg(a, ["student_id"], ["assessment_id"], "score", "running_avg")
    return r.orderBy("student_id", "assessment_id").select(
        "student_id", "assessment_id", dbl("score").alias("score"), dbl("running_avg").alias("running_avg"))


@register("W19_running_score_report",
          """SELECT s.full_name AS student_name, a.assessment_id, CAST(a.score AS DOUBLE) AS score,
               CAST(SUM(a.score) OVER (PARTITION BY a.student_id ORDER BY a.assessment_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total,
               CAST(ROUND(CAST(AVG(a.score) OVER (PARTITION BY a.student_id ORDER BY a.assessment_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,9)), 2) AS DOUBLE) AS running_average
             FROM assessments a INNER JOIN students s ON a.student_id = s.student_id
             ORDER BY a.student_id, a.assessment_id""")
def w19_running_score_report(dom):
    a = dom.assessments().select("student_id", "assessment_id", "score")
    r = _running_avg(a, ["student_id"], ["assessment_id"], "score", "running_average")
    r = r.join(dom.students().select("student_id", F.col("full_name").alias("student_name")), "student_id")
    return r.orderBy("student_id", "assessment_id").select(
        "student_name", "assessment_id", dbl("score").alias("score"), dbl("__rs").alias("running_total"),
        dbl("running_average").alias("running_average"))


@register("W21_trend_text",
          """WITH progress AS (
               SELECT s.full_name AS student_name, c.course_name, a.assessment_id, a.assessment_type, a.score,
                 LAG(a.score) OVER (PARTITION BY a.student_id, a.course_id ORDER BY a.assessment_id) AS previous_score
               FROM assessments a INNER JOIN students s ON a.student_id = s.student_id
               INNER JOIN courses c ON a.course_id = c.course_id)
             SELECT student_name, course_name, assessment_type, CAST(score AS DOUBLE) AS score,
               CAST(previous_score AS DOUBLE) AS previous_score, CAST(score - previous_score AS DOUBLE) AS change,
               CASE WHEN previous_score IS NULL THEN '—'
                    WHEN score > previous_score THEN '📈 +' || CAST(score - previous_score AS VARCHAR)
                    WHEN score < previous_score THEN '📉 ' || CAST(score - previous_score AS VARCHAR)
                    ELSE '➡️' END AS trend
             FROM progress WHERE previous_score IS NOT NULL ORDER BY student_name, course_name, assessment_id""")
def w21_trend_text(dom):
    r = _with_prev(dom).where(F.col("previous_score").isNotNull())
    r = r.join(dom.students().select("student_id", F.col("full_name").alias("student_name")), "student_id").join(
        dom.courses().select("course_id", "course_name"), "course_id")
    s, p = F.col("score"), F.col("previous_score")
    d = s - p  # DECIMAL(8,2): its text form keeps two decimals, as NUMERIC::text does
    trend = (F.when(p.isNull(), "—").when(s > p, F.concat(F.lit("📈 +"), d.cast("string")))
             .when(s < p, F.concat(F.lit("📉 "), d.cast("string"))).otherwise("➡️"))
    return r.orderBy("student_name", "course_name", "assessment_id").select(
        "student_name", "course_name", "assessment_type", dbl(s).alias("score"), dbl(p).alias("previous_score"),
        dbl(d).alias("change"), trend.alias("trend"))


@register("W22_mean_change_trend",
          """WITH progress AS (
               SELECT student_id, course_id, score,
                 LAG(score) OVER (PARTITION BY student_id, course_id ORDER BY assessment_id) AS previous_score
               FROM assessments),
             score_changes AS (SELECT student_id, score - previous_score AS change FROM progress
                               WHERE previous_score IS NOT NULL)
             SELECT s.student_id, s.full_name, COUNT(sc.change) AS assessments_compared,
               CAST(ROUND(CAST(AVG(sc.change) AS DECIMAL(38,9)), 2) AS DOUBLE) AS avg_change,
               CASE WHEN AVG(sc.change) > 2 THEN '📈 Steady Improvement' WHEN AVG(sc.change) < -2 THEN '📉 Declining'
                    ELSE '➡️ Stable' END AS trend_classification
             FROM students s JOIN score_changes sc ON s.student_id = sc.student_id
             GROUP BY s.student_id, s.full_name ORDER BY avg_change DESC""")
def w22_mean_change_trend(dom):
    r = _with_prev(dom, cols=("student_id", "course_id", "assessment_id", "score"))
    ch = r.where(F.col("previous_score").isNotNull()).select("student_id", (F.col("score") - F.col("previous_score")).alias("change"))
    g = ch.groupBy("student_id").agg(F.count("change").alias("assessments_compared"), exact_avg("change").alias("__avg"))
    j = dom.students().select("student_id", "full_name").join(g, "student_id")
    m = F.col("__avg")
    cls = F.when(m > 2, "📈 Steady Improvement").when(m < -2, "📉 Declining").otherwise("➡️ Stable")
    return j.orderBy(F.round(m, 2).desc()).select(
        "student_id", "full_name", "assessments_compared", dbl(F.round(m, 2)).alias("avg_change"),
        cls.alias("trend_classification"))


@register("W23_vs_university_avg",
          """WITH student_avg AS (
               SELECT s.student_id, s.full_name, s.city, CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score
               FROM students s JOIN assessments a ON s.student_id = a.student_id
               GROUP BY s.student_id, s.full_name, s.city)
             SELECT student_id, full_name, city, CAST(average_score AS DOUBLE) AS average_score,
               CAST(ROUND(CAST(AVG(average_score) OVER () AS DECIMAL(38,9)), 2) AS DOUBLE) AS university_avg,
               CAST(ROUND(CAST(average_score - AVG(average_score) OVER () AS DECIMAL(38,9)), 2) AS DOUBLE) AS diff_from_avg,
               CASE WHEN average_score > AVG(average_score) OVER () THEN 'Above Average'
                    WHEN average_score < AVG(average_score) OVER () THEN 'Below Average'
                    ELSE 'At Average' END AS position
             FROM student_avg ORDER BY average_score DESC""")
def w23_vs_university_avg(dom):
    sa = _named_student_avg(dom)
    out = attach_scalar(sa, sa.agg(exact_avg("average_score").alias("__u")))
    v, u = F.col("average_score"), F.col("__u")
    pos = F.when(v > u, "Above Average").when(v < u, "Below Average").otherwise("At Average")
    return out.orderBy(v.desc()).select(
        "student_id", "full_name", "city", dbl(v).alias("average_score"), dbl(F.round(u, 2)).alias("university_avg"),
        dbl(F.round(v - u, 2)).alias("diff_from_avg"), pos.alias("position"))


# ---------------------------------------------------------------- A13: flagship
A13_SQL = """WITH student_avg AS (
    SELECT s.student_id, s.full_name AS student_name, s.city,
      CAST(ROUND(CAST(AVG(a.score) AS DECIMAL(38,9)), 2) AS DOUBLE) AS average_score, MAX(a.score) AS highest_score, MIN(a.score) AS lowest_score,
      COUNT(a.assessment_id) AS assessments_count
    FROM students s LEFT JOIN assessments a ON s.student_id = a.student_id
    GROUP BY s.student_id, s.full_name, s.city),
  course_counts AS (SELECT student_id, COUNT(DISTINCT course_id) AS courses_count
                    FROM enrollments GROUP BY student_id),
  metrics AS (
    SELECT sa.student_id, sa.student_name, sa.city, sa.average_score, sa.highest_score, sa.lowest_score,
      sa.assessments_count, COALESCE(cc.courses_count, 0) AS courses_count,
      RANK() OVER (ORDER BY sa.average_score DESC NULLS FIRST) AS university_rank,
      RANK() OVER (PARTITION BY sa.city ORDER BY sa.average_score DESC NULLS FIRST) AS city_rank,
      CAST(ROUND(CAST(AVG(sa.average_score) OVER () AS DECIMAL(38,9)), 2) AS DOUBLE) AS university_avg
    FROM student_avg sa LEFT JOIN course_counts cc ON sa.student_id = cc.student_id)
SELECT student_id, student_name, city, courses_count, assessments_count,
  CAST(average_score AS DOUBLE) AS average_score, CAST(highest_score AS DOUBLE) AS highest_score,
  CAST(lowest_score AS DOUBLE) AS lowest_score, university_rank, city_rank,
  CAST(ROUND(CAST(average_score - university_avg AS DECIMAL(38,9)), 2) AS DOUBLE) AS diff_from_avg,
  CASE WHEN average_score >= 90 THEN 'Excellent' WHEN average_score >= 80 THEN 'Very Good'
       WHEN average_score >= 70 THEN 'Good' ELSE 'Needs Improvement' END AS performance_level
FROM metrics ORDER BY university_rank"""


def consolidated_analytics(dom):
    """One row per student with counts, averages, extremes, university and
    city rank, distance to the university mean and a performance band.

    Plan: the assessment fact is aggregated per student before it meets the
    student dimension; enrollments are reduced to a distinct-course count
    per student; ranks come from the range-bucketed prefix (no single-task
    window, a hot city spreads over many buckets); the university mean is a
    one-row aggregate broadcast to every row.
    """
    a = dom.assessments().groupBy("student_id").agg(
        avg2("score").alias("average_score"), F.max("score").alias("highest_score"),
        F.min("score").alias("lowest_score"), F.count("assessment_id").alias("assessments_count"))
    cc = dom.enrollments().groupBy("student_id").agg(F.count_distinct("course_id").alias("courses_count"))
    s = dom.students().select("student_id", F.col("full_name").alias("student_name"), "city")
    sa = s.join(a, "student_id", "left").join(cc, "student_id", "left").select(
        "student_id", "student_name", "city", "average_score", "highest_score", "lowest_score",
        F.coalesce("assessments_count", F.lit(0)).alias("assessments_count"),
        F.coalesce("courses_count", F.lit(0)).alias("courses_count"))
    r = sequence(sa, ["average_score desc nulls first"], rank="university_rank")
    r = sequence(r, ["average_score desc nulls first"], ["city"], rank="city_rank")
    # the mean is taken from the checkpointed ranking, not by re-running the joins
    uni = r.agg(F.round(exact_avg("average_score"), 2).alias("__u"))
    r = attach_scalar(r, uni)
    v = F.col("average_score")
    level = F.when(v >= 90, "Excellent").when(v >= 80, "Very Good").when(v >= 70, "Good").otherwise(
        "Needs Improvement")
    return r.orderBy("university_rank").select(
        "student_id", "student_name", "city", "courses_count", "assessments_count", dbl(v).alias("average_score"),
        dbl("highest_score").alias("highest_score"), dbl("lowest_score").alias("lowest_score"),
        "university_rank", "city_rank", dbl(F.round(v - F.col("__u"), 2)).alias("diff_from_avg"),
        level.alias("performance_level"))


register("A13_consolidated_analytics", A13_SQL)(consolidated_analytics)
