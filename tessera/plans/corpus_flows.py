"""Registered pipeline runs (P1-P6, Q3, Q5, Q8, Q9, K8).  Their outputs depend
on several landed sources and cleaning recipes at once; the oracle restates
every source recipe in SQL over the driver tables (``SOURCES_SQL``), so the
runs, the silver merge and its reports are checked value for value.  The
report export (P6) is A11 after a CSV round trip and shares its oracle; the
storage statistics (K8) get a rows-only check."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import silver as SV
from tessera.plans import corpus_relational  # noqa: F401  (registers A11, whose oracle P6 shares)
from tessera.plans import flows as FL
from tessera.plans.corpus_silver import CLEAN_CTES, TYPED_CTE, _title, _validate_sql
from tessera.plans.corpus_sources import UCI_ETL_SQL, _cell, _dbl, _half_even, _trunc
from tessera.plans.registry import REGISTRY, register
from tessera.sinks import writers as W
from tessera.sources import landing as L


# ---------------------------------------------------------------- oracle of the seven source recipes
def _ranged(age="age", gpa="gpa", att="attendance"):
    return (f"CASE WHEN {age} BETWEEN 16 AND 80 THEN {age} END AS age, "
            f"CASE WHEN {gpa} BETWEEN 0 AND 4 THEN CAST({gpa} AS DOUBLE) END AS gpa, "
            f"CASE WHEN {att} BETWEEN 0 AND 100 THEN CAST({att} AS DOUBLE) END AS attendance")


_KEEP_FIRST = "QUALIFY ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY o) = 1"

# Every recipe of ``flows.RECIPES`` as SQL over the driver tables; ``o`` is
# the source's input order.  ``src`` is their tagged union, ``silver`` the
# merged 17-column table (UCI rows + base rows with C20 rates and C21 ids).
SOURCES_SQL = f"""{TYPED_CTE},
  csv_r AS (SELECT student_id, name, {_ranged()}, city, ingest_ord AS o FROM typed),
  csv_m AS (SELECT median(age) AS ma, median(gpa) AS mg, median(attendance) AS mt FROM csv_r),
  csv_src AS (SELECT student_id, name, COALESCE(age, CAST(round_even(ma, 0) AS BIGINT)) AS age,
                     COALESCE(gpa, mg) AS gpa, COALESCE(attendance, mt) AS attendance, city, o
              FROM csv_r, csv_m WHERE student_id IS NOT NULL {_KEEP_FIRST}),
  api_src AS (SELECT c.c_custkey AS student_id,
                     trim(COALESCE(trim(split_part(c.c_name, '#', 1)), '') || ' ' ||
                          COALESCE(CASE WHEN c.c_custkey % 11 = 0 THEN NULL
                                        ELSE trim('#' || split_part(c.c_name, '#', 2)) END, '')) AS name,
                     17 + c.c_custkey % 45 AS age, CAST(NULL AS DOUBLE) AS gpa, CAST(NULL AS DOUBLE) AS attendance,
                     CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE n.n_name END AS city, c.c_custkey AS o
              FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
  scr AS (SELECT ingest_ord AS o, {_trunc(_cell('student_id'))} AS student_id,
                 regexp_replace({_cell('name')}, '\\s+', ' ', 'g') AS name, {_trunc(_cell('age'))} AS age,
                 {_dbl(_cell('gpa'))} AS gpa, {_dbl(_cell('attendance'))} AS attendance,
                 {_title(_cell('city'))} AS city
          FROM bronze_students WHERE (ingest_ord // 4) % 31 <> 0),
  scr_src AS (SELECT student_id, name, {_ranged()}, city, o FROM scr WHERE student_id IS NOT NULL {_KEEP_FIRST}),
  mongo_src AS (SELECT student_id, personal.name AS name,
                       {_ranged('personal.age', 'academic.gpa', 'academic.attendance')},
                       personal.city AS city, student_id AS o FROM student_docs),
  sql_src AS (SELECT student_id, full_name AS name, CASE WHEN a BETWEEN 16 AND 80 THEN a END AS age,
                     CAST(NULL AS DOUBLE) AS gpa, CAST(NULL AS DOUBLE) AS attendance, city, student_id AS o FROM (
                SELECT *, CAST(round_even(datediff('day', date_of_birth, DATE '{FL.AS_OF}') / 365.25, 0) AS BIGINT)
                  AS a FROM students) t),
  pg_src AS (SELECT student_id, name, CASE WHEN student_id % 29 <> 3 AND student_id % 37 <> 5 THEN age END AS age, gpa, attendance, city, o
             FROM sql_src),
  json_r AS (SELECT {_half_even('student_id')} AS student_id, name, {_half_even('age')} AS age, {_dbl('gpa')} AS gpa,
                    {_dbl('attendance')} AS attendance, city, ingest_ord AS o
             FROM bronze_students WHERE ingest_ord % 41 <> 5 AND ingest_ord % 43 <> 7),
  json_src AS (SELECT student_id, name, {_ranged()}, city, o FROM json_r WHERE student_id IS NOT NULL {_KEEP_FIRST}),
  src AS (SELECT 'csv' AS source, * FROM csv_src UNION ALL SELECT 'api', * FROM api_src
          UNION ALL SELECT 'postgres', * FROM pg_src UNION ALL SELECT 'json', * FROM json_src
          UNION ALL SELECT 'scraper', * FROM scr_src UNION ALL SELECT 'mongodb', * FROM mongo_src
          UNION ALL SELECT 'sqlite', * FROM sql_src),
  {UCI_ETL_SQL},
  mx AS (SELECT source, MAX(attendance) AS m FROM src GROUP BY source),
  base_u AS (
    SELECT printf('R-%s-%04d', s.source, ROW_NUMBER() OVER (PARTITION BY s.source ORDER BY s.o) - 1) AS record_id,
           CAST(s.student_id AS VARCHAR) AS student_id, CAST(NULL AS VARCHAR) AS course, s.name,
           CAST(s.age AS BIGINT) AS age, CAST(NULL AS VARCHAR) AS gender, s.city, s.gpa,
           CASE WHEN s.attendance IS NULL THEN NULL
                ELSE LEAST(GREATEST(CASE WHEN mx.m > 1.1 AND mx.m <= 100 THEN s.attendance / 100.0
                                         ELSE s.attendance END, 0.0), 1.0) END AS attendance_rate,
           CAST(NULL AS BIGINT) AS n_assessments, CAST(NULL AS BIGINT) AS score_change,
           CAST(NULL AS BIGINT) AS score_1, CAST(NULL AS BIGINT) AS score_2, CAST(NULL AS BIGINT) AS score_final,
           CAST(NULL AS VARCHAR) AS school, CAST(NULL AS VARCHAR) AS address, s.source
    FROM src s JOIN mx USING (source)),
  silver AS (SELECT * FROM unified UNION ALL BY NAME SELECT * FROM base_u)"""

_BASE = ", ".join(f"('{x}')" for x in SV.BASE_SOURCES)
_NON_NULL_CELLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)"
                             for c in ("student_id", "name", "age", "gpa", "attendance", "city"))
Q9_SQL = f"""WITH {SOURCES_SQL},
  per AS (SELECT source, COUNT(*) AS n, SUM({_NON_NULL_CELLS}) AS miss, COUNT(DISTINCT student_id) AS ids
          FROM src GROUP BY source)
SELECT e.source, CASE WHEN per.n IS NULL THEN 'MISSING' ELSE 'OK' END AS status, COALESCE(per.n, 0) AS rows,
       CASE WHEN per.n IS NULL THEN 0 ELSE 6 END AS columns, CAST(COALESCE(per.miss, 0) AS BIGINT) AS missing_cells,
       COALESCE(per.ids, 0) AS unique_ids
FROM (VALUES {_BASE}) e(source) LEFT JOIN per USING (source)"""

_ALL_SOURCES = ", ".join(f"'{x}'" for x in (*SV.BASE_SOURCES, "uci"))
Q5_SQL = f"""WITH {SOURCES_SQL}
SELECT 'not_null:record_id' AS rule, 'record_id' AS column_name,
       COUNT(*) FILTER (WHERE record_id IS NULL) AS failed_count FROM silver
UNION ALL SELECT 'not_null:student_id', 'student_id', COUNT(*) FILTER (WHERE student_id IS NULL) FROM silver
UNION ALL SELECT 'not_null:source', 'source', COUNT(*) FILTER (WHERE source IS NULL) FROM silver
UNION ALL SELECT 'domain:source', 'source',
  COUNT(*) FILTER (WHERE NOT COALESCE(source IN ({_ALL_SOURCES}), FALSE)) FROM silver
UNION ALL SELECT 'range:gpa', 'gpa', COUNT(*) FILTER (WHERE NOT COALESCE(gpa BETWEEN 0.0 AND 4.0, TRUE)) FROM silver
UNION ALL SELECT 'range:attendance_rate', 'attendance_rate',
  COUNT(*) FILTER (WHERE NOT COALESCE(attendance_rate BETWEEN 0.0 AND 1.0, TRUE)) FROM silver
UNION ALL SELECT 'unique:record_id', 'record_id', COUNT(*) - COUNT(DISTINCT record_id) FROM silver"""

_COVERAGE = " UNION ALL ".join(f"SELECT '{c}' AS c, COUNT({c}) AS nn, COUNT(*) AS n FROM silver"
                               for c in SV.UNIFIED_COLUMNS)
Q8_SQL = f"""WITH {SOURCES_SQL}
SELECT 'source' AS kind, source AS name, COUNT(*) AS rows, COUNT(gpa) AS gpa_filled,
       COUNT(attendance_rate) AS attendance_filled, CAST(NULL AS DOUBLE) AS coverage FROM silver GROUP BY source
UNION ALL
SELECT 'column', c, NULL, NULL, NULL, CASE WHEN n > 0 THEN ROUND(CAST(nn AS DOUBLE) / n, 4) ELSE 0.0 END
FROM ({_COVERAGE}) cov"""


_NO_ID = ("not_null:student_id", "COUNT(*) FILTER (WHERE student_id IS NULL)")
_NO_NAME = [(f"not_null:{c}", f"COUNT(*) FILTER (WHERE {c} IS NULL)") for c in ("name", "city")]
_UNIQUE = ("unique:student_id",
           "COUNT(*) - COUNT(DISTINCT student_id) - COALESCE(MAX(CASE WHEN student_id IS NULL THEN 1 ELSE 0 END), 0)")
# All rows of each source, those without an id and repeated ones included, and its rules.
_SOURCE_RULES = {
    "csv": ("csv_r", [_NO_ID, _UNIQUE]),
    "json": ("json_r", [_NO_ID]),
    "mongodb": ("student_docs", [_NO_ID]),
    "postgres": ("students", [_NO_ID]),
    "sqlite": ("students", [_NO_ID]),
    "api": ("api_src", [_NO_ID, *_NO_NAME, _UNIQUE,
                        ("range:age", "COUNT(*) FILTER (WHERE NOT COALESCE(age BETWEEN 16 AND 80, TRUE))")]),
    "scraper": ("scr", [_NO_ID, *_NO_NAME, _UNIQUE, *[
        (f"range:{c}", f"COUNT(*) FILTER (WHERE NOT COALESCE({c} BETWEEN {lo} AND {hi}, FALSE))")
        for c, lo, hi in (("age", 16, 80), ("gpa", 0, 4), ("attendance", 0, 100))]]),
}
RULES_SQL = "\n  UNION ALL ".join(
    f"SELECT '{source}' AS source, '{rule}' AS rule, CAST({count} AS BIGINT) AS failed_count FROM {rows}"
    for source, (rows, rules) in _SOURCE_RULES.items()
    for rule, count in [("empty", "CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END"), *rules])


@register("P3_run_all_sources",
          f"""WITH {SOURCES_SQL},
  q3 AS ({RULES_SQL}),
  failed AS (SELECT source, string_agg(rule || ': ' || CAST(failed_count AS VARCHAR), '; ' ORDER BY rule)
                              FILTER (WHERE failed_count > 0) AS failed_rules FROM q3 GROUP BY source),
  ins AS (SELECT 'csv' AS source, student_id FROM typed UNION ALL SELECT 'api', c_custkey FROM customer
          UNION ALL SELECT 'scraper', student_id FROM scr UNION ALL SELECT 'mongodb', student_id FROM student_docs
          UNION ALL SELECT 'sqlite', student_id FROM students UNION ALL SELECT 'postgres', student_id FROM students
          UNION ALL SELECT 'json', student_id FROM json_r),
  n_in AS (SELECT source, COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE student_id IS NULL) AS rows_invalid
           FROM ins GROUP BY source)
SELECT source, 'OK' AS status, ANY_VALUE(rows_in) AS rows_in, ANY_VALUE(rows_invalid) AS rows_invalid,
       COUNT(*) AS rows, ANY_VALUE(failed_rules) AS failed_rules, 'clean/source=' || source AS path
FROM src JOIN n_in USING (source) JOIN failed USING (source) GROUP BY source""")
def p3_run_all_sources(dom):
    status, _ = FL.run_all(dom)
    return status.drop("error")


@register("P4_silver_merge", f"WITH {SOURCES_SQL} SELECT * FROM silver")
def p4_silver_merge(dom):
    return FL.run_merge(dom)


@register("Q5_silver_verify", Q5_SQL)
def q5_silver_verify(dom):
    frames = FL.all_frames(dom)
    from tessera.plans.corpus_sources import course_etl

    return SV.verify(SV.merge(course_etl(dom), frames))


@register("Q8_silver_report", Q8_SQL)
def q8_silver_report(dom):
    return SV.report(FL.run_merge(dom))


@register("Q9_source_comparison", Q9_SQL)
def q9_source_comparison(dom):
    _, frames = FL.run_all(dom)
    return SV.compare_sources(SV.tag_sources(frames), SV.BASE_SOURCES)


_RULE_ORDER = ["empty", "not_null:student_id", "not_null:name", "range:age", "range:gpa", "range:attendance",
               "unique:student_id"]
P1_SQL = f"""WITH {CLEAN_CTES}, v AS ({_validate_sql('cleaned')})
SELECT (SELECT COUNT(*) FROM bronze_students) AS rows_in, (SELECT COUNT(*) FROM cleaned) AS rows_out,
       CASE WHEN COUNT(*) FILTER (WHERE failed_count > 0) = 0 THEN 'valid' ELSE 'invalid' END AS validation,
       string_agg(rule || ': ' || CAST(failed_count AS VARCHAR), '; '
                  ORDER BY list_position({_RULE_ORDER!r}, rule)) FILTER (WHERE failed_count > 0) AS errors
FROM v"""


@register("P1_single_source_pipeline", P1_SQL)
def p1_single_source_pipeline(dom):
    return FL.single_source_pipeline(dom, f"{L.landing_root(dom.spark, dom.dir)}/p1_out")


# the export is A11 after checks and a verified CSV round trip: same rows
@register("P6_student_report_export", REGISTRY["A11_ml_feature_table"].oracle, domain_sql=False)
def p6_student_report_export(dom):
    return FL.export_report(dom, f"{L.landing_root(dom.spark, dom.dir)}/p6_report")


# ---------------------------------------------------------------- K3
def bucketed_tables(dom, buckets: int = 16) -> tuple[str, str]:
    """Students and enrollments as managed tables, both bucketed by student_id."""
    root = L.landing_root(dom.spark, dom.dir)
    tag = root.rsplit("/", 1)[-1]
    names = f"students_{tag}", f"enrollments_{tag}"
    W.save_table(dom.students().select("student_id", "city"), names[0], buckets=buckets, path=f"{root}/tables/{names[0]}")
    W.save_table(dom.enrollments().select("enrollment_id", "student_id"), names[1], buckets=buckets, path=f"{root}/tables/{names[1]}")
    return names


@register("K3_bucketed_join", "SELECT city, COUNT(*) AS n_enrollments, COUNT(DISTINCT s.student_id) AS n_students "
                              "FROM students s JOIN enrollments e ON s.student_id = e.student_id GROUP BY city")
def k3_bucketed_join(dom):
    students, enrollments = (dom.spark.table(n) for n in bucketed_tables(dom))
    per = students.join(enrollments, "student_id").groupBy("student_id", "city").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("city").agg(F.sum("n").alias("n_enrollments"), F.count(F.lit(1)).alias("n_students"))


# sizes depend on the codec: the oracle has rows and columns, and that both were written
@register("K8_csv_vs_parquet",
          """SELECT COUNT(*) AS csv_rows, COUNT(*) AS parquet_rows, 6 AS csv_columns, 6 AS parquet_columns,
                    TRUE AS csv_written, TRUE AS parquet_written, TRUE AS ratio_agrees FROM bronze_students""")
def k8_csv_vs_parquet(dom):
    csv_path = L.students_csv(dom.spark, dom.dir)
    pq = f"{L.landing_root(dom.spark, dom.dir)}/students_parquet"
    df = dom.spark.read.option("header", True).csv(csv_path)
    W.write_parquet(df, pq)
    return W.compare_formats(dom.spark, csv_path, pq).select(
        "csv_rows", "parquet_rows", "csv_columns", "parquet_columns",
        (F.col("csv_bytes") > 0).alias("csv_written"), (F.col("parquet_bytes") > 0).alias("parquet_written"),
        (F.abs(F.col("ratio") * F.col("csv_bytes") - F.col("parquet_bytes")) <= F.col("csv_bytes") * 5e-5).alias("ratio_agrees"))


@register("N16_collection_pipeline",
          """SELECT personal.city AS city, COUNT(*) AS students, ROUND(AVG(academic.gpa), 6) AS average_gpa,
                    CAST(SUM(CASE WHEN list_contains(skills, 'Python') THEN 1 ELSE 0 END) AS BIGINT) AS python_students,
                    CAST(SUM(len(projects)) AS BIGINT) AS projects
             FROM student_docs GROUP BY 1""")
def n16_collection_pipeline(dom):
    return FL.collection_pipeline(dom, f"{L.landing_root(dom.spark, dom.dir)}/n16")


@register("Q3_source_validation", f"WITH {SOURCES_SQL}, q3 AS ({RULES_SQL}) SELECT * FROM q3")
def q3_source_validation(dom):
    from tessera.operators.quality import validate_source

    out = None
    for name in FL.SOURCES:
        r = validate_source(name, FL.RECIPES[name](dom))    # before any row is held back or dropped
        out = r if out is None else out.unionByName(r)
    return out
