"""Silver-layer queries: coercion, dedup, cleaning, medians, quality rules and
integrity constraints (C*, D*, A16, Q*), each with a DuckDB oracle.

Inputs are the bronze student records (``sources.bronze``) and the bound
domain tables; both derive from the driver tables, so the work grows with
them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import quality as Q
from tessera.operators.quantile import quantiles_long, wide_quantiles
from tessera.plans.registry import DOMAIN_CTES, register
from tessera.sources.bronze import BRONZE_SQL, bronze_students

DOMAIN_CTES.setdefault("bronze_students", BRONZE_SQL)


def _typed(dom):
    return C.convert_types(bronze_students(dom.spark, dom.dir))


def _clean(dom):
    return C.clean_data(_typed(dom))


def _d(x):
    return f"CASE WHEN isnan(TRY_CAST({x} AS DOUBLE)) THEN NULL ELSE TRY_CAST({x} AS DOUBLE) END"


def _i(x):
    d = _d(x)
    return f"CASE WHEN {d} = floor({d}) THEN CAST({d} AS BIGINT) END"


TYPED_CTE = f"""typed AS (
  SELECT {_i('student_id')} AS student_id, name, {_i('age')} AS age, {_d('gpa')} AS gpa,
         {_d('attendance')} AS attendance, city, ingest_ord FROM bronze_students)"""

DEDUP_CTE = """dedup AS (SELECT * FROM typed
  QUALIFY ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY ingest_ord) = 1)"""


def _title(x):
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+'), "
            f"lambda w: upper(w[1]) || lower(w[2:])), '')")


def _strip(x):
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


CLEAN_CTES = f"""{TYPED_CTE}, {DEDUP_CTE},
texted AS (SELECT student_id, {_strip('name')} AS name, age, gpa, attendance,
                  {_title(_strip('city'))} AS city, ingest_ord FROM dedup),
ranged AS (SELECT student_id, name, CASE WHEN age BETWEEN 16 AND 80 THEN age END AS age,
                  CASE WHEN gpa BETWEEN 0 AND 4 THEN gpa END AS gpa,
                  CASE WHEN attendance BETWEEN 0 AND 100 THEN attendance END AS attendance,
                  city, ingest_ord FROM texted),
named AS (SELECT * FROM ranged WHERE name IS NOT NULL),
meds AS (SELECT median(age) AS ma, median(gpa) AS mg, median(attendance) AS mt FROM named),
cleaned AS (SELECT student_id, name, COALESCE(age, CAST(round_even(ma, 0) AS BIGINT)) AS age,
                   COALESCE(gpa, mg) AS gpa, COALESCE(attendance, mt) AS attendance,
                   COALESCE(city, 'Unknown') AS city, ingest_ord FROM named, meds)"""


@register("C1_coerce_types", f"WITH {TYPED_CTE} SELECT * FROM typed")
def c1_coerce_types(dom):
    return _typed(dom)


@register("C1_coercion_counts",
          f"""WITH {TYPED_CTE}
              SELECT COUNT(*) FILTER (WHERE t.student_id IS NULL AND b.student_id IS NOT NULL) AS student_id,
                     COUNT(*) FILTER (WHERE t.age IS NULL AND b.age IS NOT NULL) AS age,
                     COUNT(*) FILTER (WHERE t.gpa IS NULL AND b.gpa IS NOT NULL) AS gpa,
                     COUNT(*) FILTER (WHERE t.attendance IS NULL AND b.attendance IS NOT NULL) AS attendance
              FROM bronze_students b JOIN typed t ON b.ingest_ord = t.ingest_ord""")
def c1_coercion_counts(dom):
    return C.coercion_counts(bronze_students(dom.spark, dom.dir))


@register("C2_half_even_coercion",
          """SELECT ingest_ord,
                    CASE WHEN isnan(TRY_CAST(age AS DOUBLE)) THEN NULL
                         ELSE CAST(round_even(TRY_CAST(age AS DOUBLE), 0) AS BIGINT) END AS age
             FROM bronze_students""")
def c2_half_even_coercion(dom):
    b = bronze_students(dom.spark, dom.dir)
    return C.convert_types(b.select("ingest_ord", "age"), int_rounding="half_even")


@register("D1_keep_first", f"WITH {TYPED_CTE}, {DEDUP_CTE} SELECT * FROM dedup")
def d1_keep_first(dom):
    return C.keep_first(_typed(dom))


@register("D1_exact_duplicates_removed",
          f"""WITH {TYPED_CTE}
              SELECT student_id, name, age, gpa, attendance, city, MIN(ingest_ord) AS ingest_ord
              FROM typed GROUP BY ALL""")
def d1_exact_duplicates_removed(dom):
    return C.drop_exact_duplicates(_typed(dom))


@register("C4_C5_clean_text",
          f"WITH {TYPED_CTE}, {DEDUP_CTE} SELECT student_id, {_strip('name')} AS name, "
          f"{_title(_strip('city'))} AS city FROM dedup")
def c4_c5_clean_text(dom):
    return C.clean_text(C.keep_first(_typed(dom))).select("student_id", "name", "city")


@register("C6_collapse_spaces",
          f"SELECT ingest_ord, regexp_replace({_strip('name')}, '\\s+', ' ', 'g') AS name FROM bronze_students")
def c6_collapse_spaces(dom):
    from tessera.functions.text import collapse_spaces, strip

    b = bronze_students(dom.spark, dom.dir)
    return b.select("ingest_ord", collapse_spaces(strip("name")).alias("name"))


@register("C7_null_outliers",
          f"""WITH {TYPED_CTE}
              SELECT ingest_ord, CASE WHEN age BETWEEN 16 AND 80 THEN age END AS age,
                     CASE WHEN gpa BETWEEN 0 AND 4 THEN gpa END AS gpa,
                     CASE WHEN attendance BETWEEN 0 AND 100 THEN attendance END AS attendance
              FROM typed""")
def c7_null_outliers(dom):
    return C.null_outliers(_typed(dom)).select("ingest_ord", "age", "gpa", "attendance")


@register("C17_clean_data", f"WITH {CLEAN_CTES} SELECT * FROM cleaned")
def c17_clean_data(dom):
    return _clean(dom)


@register("C8_median_fill_values",
          f"WITH {CLEAN_CTES} SELECT CAST(ma AS DOUBLE) AS age_median, mg AS gpa_median, "
          "mt AS attendance_median FROM meds")
def c8_median_fill_values(dom):
    df = _typed(dom).transform(C.keep_first).transform(C.clean_text).transform(C.null_outliers)
    df = df.where(F.col("name").isNotNull())
    m = wide_quantiles(df, ["age", "gpa", "attendance"], 0.5, "")
    return m.select(F.col("age").alias("age_median"), F.col("gpa").alias("gpa_median"),
                    F.col("attendance").alias("attendance_median"))


@register("C10_clip_attendance_p99",
          f"""WITH {TYPED_CTE}, cap AS (SELECT quantile_cont(attendance, 0.99) AS c FROM typed)
              SELECT ingest_ord, CASE WHEN attendance > c THEN c ELSE attendance END AS attendance,
                     attendance > c AS attendance_clipped
              FROM typed, cap""")
def c10_clip_attendance_p99(dom):
    return C.clip_upper_quantile(_typed(dom), "attendance", 0.99).select(
        "ingest_ord", "attendance", "attendance_clipped")


@register("A16_median_gpa_by_city",
          f"WITH {CLEAN_CTES} SELECT city, median(gpa) AS median_gpa, quantile_cont(age, 0.5) AS median_age "
          "FROM cleaned GROUP BY city")
def a16_median_gpa_by_city(dom):
    c = _clean(dom)
    long = quantiles_long(c, ["gpa", "age"], {"m": 0.5}, by="city")
    wide = long.groupBy("city").agg(
        F.max(F.when(F.col("column_name") == "gpa", F.col("m"))).alias("median_gpa"),
        F.max(F.when(F.col("column_name") == "age", F.col("m"))).alias("median_age"))
    return c.select("city").distinct().join(wide, "city", "left")


@register("A16_median_global",
          f"WITH {CLEAN_CTES} SELECT median(gpa) AS median_gpa, median(attendance) AS median_attendance "
          "FROM cleaned")
def a16_median_global(dom):
    m = wide_quantiles(_clean(dom), ["gpa", "attendance"], 0.5, "")
    return m.select(F.col("gpa").alias("median_gpa"), F.col("attendance").alias("median_attendance"))


def _validate_sql(src: str) -> str:
    return f"""SELECT rule, column_name, failed_count, total_rows, unique_ids FROM (
      SELECT 'empty' AS rule, '' AS column_name, CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS failed_count,
             COUNT(*) AS total_rows, COUNT(DISTINCT student_id) AS unique_ids FROM {src}
      UNION ALL SELECT 'not_null:student_id', 'student_id', COUNT(*) FILTER (WHERE student_id IS NULL),
             COUNT(*), COUNT(DISTINCT student_id) FROM {src}
      UNION ALL SELECT 'not_null:name', 'name', COUNT(*) FILTER (WHERE name IS NULL), COUNT(*),
             COUNT(DISTINCT student_id) FROM {src}
      UNION ALL SELECT 'range:age', 'age', COUNT(*) FILTER (WHERE NOT (age BETWEEN 16 AND 80)), COUNT(*),
             COUNT(DISTINCT student_id) FROM {src}
      UNION ALL SELECT 'range:gpa', 'gpa', COUNT(*) FILTER (WHERE NOT COALESCE(gpa BETWEEN 0 AND 4, FALSE)),
             COUNT(*), COUNT(DISTINCT student_id) FROM {src}
      UNION ALL SELECT 'range:attendance', 'attendance',
             COUNT(*) FILTER (WHERE NOT COALESCE(attendance BETWEEN 0 AND 100, FALSE)), COUNT(*),
             COUNT(DISTINCT student_id) FROM {src}
      UNION ALL SELECT 'unique:student_id', 'student_id',
             COUNT(*) - COUNT(DISTINCT student_id) - MAX(CASE WHEN student_id IS NULL THEN 1 ELSE 0 END),
             COUNT(*), COUNT(DISTINCT student_id) FROM {src}) r"""


@register("Q2_validate_typed", f"WITH {TYPED_CTE} {_validate_sql('typed')}")
def q2_validate_typed(dom):
    return Q.validate_data(_typed(dom))


@register("Q2_validate_clean", f"WITH {CLEAN_CTES} {_validate_sql('cleaned')}")
def q2_validate_clean(dom):
    return Q.validate_data(_clean(dom))


def _quality_sql(src, cols_types):
    parts = []
    for c, t in cols_types:
        pct = f"CAST(ROUND(CAST(100.0 * COUNT(*) FILTER (WHERE {c} IS NULL) AS DECIMAL(38,9)) / COUNT(*), 2) AS DECIMAL(10,2))"
        parts.append(f"""SELECT '{c}' AS column_name, '{t}' AS data_type,
              COUNT(*) FILTER (WHERE {c} IS NULL) AS missing_count, COUNT(DISTINCT {c}) AS unique_count,
              {pct} AS pct FROM {src}""")
    body = " UNION ALL ".join(parts)
    return f"""SELECT column_name, data_type, missing_count, unique_count, CAST(pct AS DOUBLE) AS missing_percentage,
        CAST(100 - pct AS DOUBLE) AS completeness,
        CASE WHEN pct <= 0 THEN 'Excellent' WHEN pct <= 5 THEN 'Good' WHEN pct <= 20 THEN 'Acceptable'
             WHEN pct <= 50 THEN 'Poor' ELSE 'Critical' END AS quality_tier
      FROM ({body}) q"""


_TYPED_TYPES = [("student_id", "bigint"), ("name", "string"), ("age", "bigint"), ("gpa", "double"),
                ("attendance", "double"), ("city", "string"), ("ingest_ord", "bigint")]


@register("Q7_quality_report", f"WITH {TYPED_CTE} {_quality_sql('typed', _TYPED_TYPES)}")
def q7_quality_report(dom):
    return Q.quality_report(_typed(dom))


def _failing_sql(rule: str, col: str, failed: str) -> str:
    return (f"SELECT '{rule}' AS rule, string_agg(COALESCE(CAST({col} AS VARCHAR), 'NULL'), '|' ORDER BY ingest_ord) AS examples "
            f"FROM (SELECT * FROM typed WHERE {failed} ORDER BY ingest_ord LIMIT 3) x HAVING COUNT(*) > 0")


# doubles are compared as numbers by the other checks; here as text, so only whole and missing values are asked for
@register("Q2_failure_examples", f"WITH {TYPED_CTE} " + " UNION ALL ".join([
    _failing_sql("not_null:student_id", "student_id", "student_id IS NULL"), _failing_sql("not_null:name", "name", "name IS NULL"),
    _failing_sql("range:age", "age", "NOT COALESCE(age BETWEEN 16 AND 80, TRUE)"),
    _failing_sql("odd:student_id", "student_id", "NOT COALESCE(student_id % 2 = 1, TRUE)")]))
def q2_failure_examples(dom):
    """The first three failing values of each failing rule, in input order."""
    d = _typed(dom)
    rules = [r for r in Q.record_rules(d) if r.column not in ("gpa", "attendance")]
    rules.append(Q.Rule("odd:student_id", "student_id", F.col("student_id") % 2 == 1))  # fails on half of the rows
    shown = F.array_join(F.transform("examples", lambda x: F.coalesce(x, F.lit("NULL"))), "|")
    return Q.failing_examples(d, rules, "ingest_ord").select("rule", shown.alias("examples"))


@register("Q10_numeric_profile",
          f"""WITH {TYPED_CTE}
              SELECT 'age' AS column_name, CAST(MIN(age) AS DOUBLE) AS min_value, CAST(MAX(age) AS DOUBLE) AS max_value,
                     ROUND(AVG(age), 6) AS mean_value, ROUND(STDDEV_SAMP(age), 6) AS std_value,
                     COUNT(*) FILTER (WHERE age IS NULL) AS null_count FROM typed
              UNION ALL SELECT 'gpa', MIN(gpa), MAX(gpa), ROUND(AVG(gpa), 6), ROUND(STDDEV_SAMP(gpa), 6),
                     COUNT(*) FILTER (WHERE gpa IS NULL) FROM typed
              UNION ALL SELECT 'attendance', MIN(attendance), MAX(attendance), ROUND(AVG(attendance), 6),
                     ROUND(STDDEV_SAMP(attendance), 6), COUNT(*) FILTER (WHERE attendance IS NULL) FROM typed""")
def q10_numeric_profile(dom):
    p = Q.numeric_profile(_typed(dom), ["age", "gpa", "attendance"])
    return p.withColumns({"mean_value": F.round("mean_value", 6), "std_value": F.round("std_value", 6)})


# ---------------------------------------------------------------- integrity (domain tables)
@register("Q11_primary_keys",
          """WITH k AS (
               SELECT 'students' AS table_name, 'student_id' AS key_columns, COUNT(*) AS n,
                      bool_or(student_id IS NULL) AS nk FROM students GROUP BY student_id
               UNION ALL SELECT 'instructors', 'instructor_id', COUNT(*), bool_or(instructor_id IS NULL)
                      FROM instructors GROUP BY instructor_id
               UNION ALL SELECT 'courses', 'course_id', COUNT(*), bool_or(course_id IS NULL) FROM courses GROUP BY course_id
               UNION ALL SELECT 'enrollments', 'enrollment_id', COUNT(*), bool_or(enrollment_id IS NULL)
                      FROM enrollments GROUP BY enrollment_id
               UNION ALL SELECT 'enrollments', 'student_id,course_id,semester', COUNT(*),
                      bool_or(student_id IS NULL OR course_id IS NULL OR semester IS NULL)
                      FROM enrollments GROUP BY student_id, course_id, semester
               UNION ALL SELECT 'assessments', 'assessment_id', COUNT(*), bool_or(assessment_id IS NULL)
                      FROM assessments GROUP BY assessment_id)
             SELECT table_name, key_columns, COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys,
                    CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_duplicates,
                    CAST(COALESCE(SUM(n) FILTER (WHERE nk), 0) AS BIGINT) AS null_key_rows
             FROM k GROUP BY table_name, key_columns""")
def q11_primary_keys(dom):
    parts = [
        Q.pk_summary(dom.students(), "student_id", "students"),
        Q.pk_summary(dom.instructors(), "instructor_id", "instructors"),
        Q.pk_summary(dom.courses(), "course_id", "courses"),
        Q.pk_summary(dom.enrollments(), "enrollment_id", "enrollments"),
        Q.pk_summary(dom.enrollments(), ["student_id", "course_id", "semester"], "enrollments"),
        Q.pk_summary(dom.assessments(), "assessment_id", "assessments"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_FKS = [
    ("assessments", "student_id", "students", "student_id"),
    ("assessments", "course_id", "courses", "course_id"),
    ("enrollments", "student_id", "students", "student_id"),
    ("enrollments", "course_id", "courses", "course_id"),
    ("courses", "instructor_id", "instructors", "instructor_id"),
]


@register("Q12_foreign_keys", " UNION ALL ".join(
    f"""SELECT '{c}' AS child_table, '{fk}' AS fk_column, '{p}' AS parent_table,
          (SELECT COUNT(*) FROM {c} x WHERE x.{fk} IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{fk})) AS orphan_rows"""
    for c, fk, p, pk in _FKS))
def q12_foreign_keys(dom):
    tables = {"assessments": dom.assessments(), "enrollments": dom.enrollments(), "courses": dom.courses(),
              "students": dom.students(), "instructors": dom.instructors()}
    out = None
    for c, fk, p, pk in _FKS:
        n = Q.orphans(tables[c], fk, tables[p], pk).agg(F.count(F.lit(1)).alias("orphan_rows"))
        row = n.select(F.lit(c).alias("child_table"), F.lit(fk).alias("fk_column"), F.lit(p).alias("parent_table"),
                       "orphan_rows")
        out = row if out is None else out.unionByName(row)
    return out


@register("Q13_check_constraints",
          """SELECT 'students' AS table_name, 'gender_domain' AS rule,
                    COUNT(*) FILTER (WHERE NOT (gender IN ('Male', 'Female'))) AS violations FROM students
             UNION ALL SELECT 'courses', 'credit_hours_positive', COUNT(*) FILTER (WHERE NOT (credit_hours > 0)) FROM courses
             UNION ALL SELECT 'assessments', 'assessment_type_domain',
                    COUNT(*) FILTER (WHERE NOT (assessment_type IN ('Midterm', 'Final', 'Quiz', 'Project'))) FROM assessments
             UNION ALL SELECT 'assessments', 'score_range',
                    COUNT(*) FILTER (WHERE NOT (score >= 0 AND score <= 100)) FROM assessments""")
def q13_check_constraints(dom):
    checks = [
        ("students", "gender_domain", dom.students(), F.col("gender").isin("Male", "Female")),
        ("courses", "credit_hours_positive", dom.courses(), F.col("credit_hours") > 0),
        ("assessments", "assessment_type_domain", dom.assessments(),
         F.col("assessment_type").isin("Midterm", "Final", "Quiz", "Project")),
        ("assessments", "score_range", dom.assessments(), (F.col("score") >= 0) & (F.col("score") <= 100)),
    ]
    out = None
    for t, name, df, pred in checks:
        r = Q.evaluate(df, [Q.Rule(name, None, pred)]).select(
            F.lit(t).alias("table_name"), "rule", F.col("failed_count").alias("violations"))
        out = r if out is None else out.unionByName(r)
    return out


# The parent rows deleted in the propagation check.
DELETED_CITY = "NATION_3"
DELETED_DEPARTMENT = "NATION_5"


@register("Q14_delete_propagation",
          f"""WITH gone_s AS (SELECT student_id FROM students WHERE city = '{DELETED_CITY}'),
                  gone_i AS (SELECT instructor_id FROM instructors WHERE department = '{DELETED_DEPARTMENT}')
              SELECT
                (SELECT COUNT(*) FROM enrollments WHERE student_id NOT IN (SELECT student_id FROM gone_s))
                  AS enrollments_left,
                (SELECT COUNT(*) FROM assessments WHERE student_id NOT IN (SELECT student_id FROM gone_s))
                  AS assessments_left,
                (SELECT COUNT(*) FROM courses WHERE instructor_id IN (SELECT instructor_id FROM gone_i))
                  AS courses_set_null,
                (SELECT COUNT(*) FROM courses) AS courses_left""")
def q14_delete_propagation(dom):
    gone_s = dom.students().where(F.col("city") == DELETED_CITY).select("student_id")
    gone_i = dom.instructors().where(F.col("department") == DELETED_DEPARTMENT).select("instructor_id")
    e = Q.cascade_delete(dom.enrollments(), "student_id", gone_s, "student_id")
    a = Q.cascade_delete(dom.assessments(), "student_id", gone_s, "student_id")
    c = dom.courses()
    c2 = Q.set_null_on_delete(c, "instructor_id", gone_i, "instructor_id")
    nulled = c2.agg(F.count_if(F.col("instructor_id").isNull()).alias("courses_set_null"),
                    F.count(F.lit(1)).alias("courses_left"))
    return (e.agg(F.count(F.lit(1)).alias("enrollments_left"))
            .crossJoin(a.agg(F.count(F.lit(1)).alias("assessments_left")))
            .crossJoin(nulled))


@register("Q16_quarantine_counts",
          f"""WITH {TYPED_CTE}, {DEDUP_CTE},
                   dup AS (SELECT student_id FROM typed GROUP BY student_id HAVING COUNT(*) > 1),
                   tagged AS (
                     SELECT CASE WHEN t.student_id IS NULL OR t.name IS NULL OR d.student_id IS NOT NULL THEN 'fail'
                                 WHEN NOT COALESCE(t.age BETWEEN 16 AND 80, TRUE)
                                   OR NOT COALESCE(t.gpa BETWEEN 0 AND 4, TRUE)
                                   OR NOT COALESCE(t.attendance BETWEEN 0 AND 100, TRUE) THEN 'invalid'
                                 ELSE 'valid' END AS disposition
                     FROM typed t LEFT JOIN dup d ON t.student_id = d.student_id)
              SELECT disposition, COUNT(*) AS n FROM tagged GROUP BY disposition""")
def q16_quarantine_counts(dom):
    t = _typed(dom)
    dups = Q.duplicate_keys(t, "student_id").select("student_id", F.lit(True).alias("__dup"))
    t = t.join(dups, "student_id", "left")
    hard = [Q.Rule("not_null:student_id", "student_id", F.col("student_id").isNotNull()),
            Q.Rule("not_null:name", "name", F.col("name").isNotNull()),
            Q.Rule("unique:student_id", "student_id", F.col("__dup").isNull())]
    soft = [Q.Rule(f"range:{c}", c, F.col(c).between(lo, hi)) for c, (lo, hi) in C.OUTLIER_RANGES.items()]
    q = Q.quarantine(t, hard, soft)
    return q.groupBy("disposition").agg(F.count(F.lit(1)).alias("n"))
