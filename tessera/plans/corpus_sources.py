"""Source queries over landed files (S1-S8), the course ETL (P5: I1-I3, C10,
C18, C19, Q4), with DuckDB oracles computed straight from the driver tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import identity as ID
from tessera.sinks import writers as W
from tessera.session import written
from tessera.plans.corpus_silver import TYPED_CTE, _title
from tessera.plans.flows import JSON_SCHEMA
from tessera.plans.registry import DOMAIN_CTES, register
from tessera.sources import landing as L
from tessera.sources import readers as R
from tessera.sources import uci as U

# ---------------------------------------------------------------- S1 / S2


@register("S1_S2_csv_students",
          f"WITH {TYPED_CTE} SELECT student_id, name, age, gpa, attendance, city FROM typed")
def s1_s2_csv_students(dom):
    df = R.normalize_headers(R.read_csv(dom.spark, L.students_csv(dom.spark, dom.dir), all_strings=True))
    return C.convert_types(df).select("student_id", "name", "age", "gpa", "attendance", "city")


# ---------------------------------------------------------------- S3
def _half_even(c: str) -> str:
    return f"CASE WHEN isnan(TRY_CAST({c} AS DOUBLE)) THEN NULL ELSE CAST(round_even(TRY_CAST({c} AS DOUBLE), 0) AS BIGINT) END"


@register("S3_json_students",
          f"""SELECT ingest_ord AS ord, {_half_even('student_id')} AS student_id, name,
                     CASE WHEN {_half_even('age')} BETWEEN 16 AND 80 THEN {_half_even('age')} END AS age, city
              FROM bronze_students WHERE ingest_ord % 41 <> 5 AND ingest_ord % 43 <> 7""")
def s3_json_students(dom):
    """The JSON recipe: good elements, coerced with half-even rounding (C2), outliers to NULL."""
    good, _ = R.read_json_arrays(dom.spark, L.students_json(dom.spark, dom.dir), JSON_SCHEMA)
    d = C.null_outliers(C.convert_types(good, int_rounding="half_even"))
    return d.select("ord", "student_id", "name", "age", "city")


@register("S3_json_bad_elements",
          """SELECT CASE WHEN ingest_ord % 41 = 5 THEN 'no object' ELSE 'wrong type' END AS reason, COUNT(*) AS n
             FROM bronze_students WHERE ingest_ord % 41 = 5 OR ingest_ord % 43 = 7 GROUP BY 1""")
def s3_json_bad_elements(dom):
    _, bad = R.read_json_arrays(dom.spark, L.students_json(dom.spark, dom.dir), JSON_SCHEMA)
    reason = F.when(F.ltrim("element").startswith("{"), "wrong type").otherwise("no object")
    return bad.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- S6
@register("S6_api_users",
          """SELECT c.c_custkey AS student_id,
                    trim(COALESCE(trim(split_part(c.c_name, '#', 1)), '') || ' ' ||
                         COALESCE(CASE WHEN c.c_custkey % 11 = 0 THEN NULL
                                       ELSE trim('#' || split_part(c.c_name, '#', 2)) END, '')) AS name,
                    17 + c.c_custkey % 45 AS age, CAST(NULL AS DOUBLE) AS gpa, CAST(NULL AS DOUBLE) AS attendance,
                    CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE n.n_name END AS city
             FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def s6_api_users(dom):
    users = R.read_api_pages(dom.spark, L.api_pages(dom.spark, dom.dir))
    return C.api_user_mapping(users)


# ---------------------------------------------------------------- S7
def _trunc(x):
    d = f"CASE WHEN isnan(TRY_CAST({x} AS DOUBLE)) THEN NULL ELSE TRY_CAST({x} AS DOUBLE) END"
    return f"CAST(trunc({d}) AS BIGINT)"


def _dbl(x):
    return f"CASE WHEN isnan(TRY_CAST({x} AS DOUBLE)) THEN NULL ELSE TRY_CAST({x} AS DOUBLE) END"


def _cell(x):
    s = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    return f"CASE WHEN {s} = '' THEN NULL ELSE {s} END"


@register("S7_table_rows",
          f"""SELECT {_trunc(_cell('student_id'))} AS student_id,
                     regexp_replace({_cell('name')}, '\\s+', ' ', 'g') AS name,
                     {_trunc(_cell('age'))} AS age, {_dbl(_cell('gpa'))} AS gpa,
                     {_dbl(_cell('attendance'))} AS attendance, {_title(_cell('city'))} AS city
              FROM bronze_students WHERE (ingest_ord // 4) % 31 <> 0""")
def s7_table_rows(dom):
    pages = dom.spark.read.parquet(L.student_pages(dom.spark, dom.dir))
    rows = R.require_rows(R.parse_table_rows(pages, "students"), "students table")
    return rows.drop("ingest_ord")


@register("S7_page_links",
          """SELECT page_id, CAST(pos - 1 AS INTEGER) AS position, l.href, l.text FROM (
               SELECT page_id,
                 unnest(list_zip(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1),
                                 regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)))
                   AS z,
                 generate_subscripts(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1), 1)
                   AS pos
               FROM pages) t, LATERAL (SELECT z[1] AS href, z[2] AS text) l""")
def s7_page_links(dom):
    return R.page_links(dom.spark.read.parquet(f"{dom.dir}/pages.parquet"))


@register("S7_page_titles",
          """SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
                    regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages""")
def s7_page_titles(dom):
    return R.page_titles(dom.spark.read.parquet(f"{dom.dir}/pages.parquet"))


# ---------------------------------------------------------------- S8 + P5
def _pick_sql(values, idx):
    arr = ", ".join(f"'{v}'" for v in values)
    return f"[{arr}][({idx}) % {len(values)} + 1]"


def _uci_sql(course: str) -> str:
    k = "c.c_custkey"
    yn = lambda cond: f"CASE WHEN {cond} THEN 'yes' ELSE 'no' END"
    g1 = "CAST(floor(p.avgp / 20000) % 21 AS BIGINT)"
    g3 = f"CAST(CASE WHEN {k} % 37 = 0 THEN 0 ELSE ({g1} + p.nf) % 21 END AS BIGINT)"
    vals = {
        "school": "CASE WHEN c.c_nationkey < 13 THEN 'GP' ELSE 'MS' END",
        "sex": f"CASE WHEN {k} % 2 = 0 THEN 'M' ELSE 'F' END",
        "age": f"15 + {k} % 8",
        "address": "CASE WHEN c.c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'U' ELSE 'R' END",
        "famsize": f"CASE WHEN {k} % 3 = 0 THEN 'LE3' ELSE 'GT3' END",
        "Pstatus": f"CASE WHEN {k} % 5 = 0 THEN 'A' ELSE 'T' END",
        "Medu": f"({k} // 7) % 5", "Fedu": f"({k} // 11) % 5",
        "Mjob": _pick_sql(U.JOBS, f"{k} // 13"), "Fjob": _pick_sql(U.JOBS, f"{k} // 17"),
        "reason": _pick_sql(U.REASONS, f"{k} // 19"),
        "guardian": _pick_sql(["mother", "father", "other"], k),
        "traveltime": f"1 + {k} % 4", "studytime": f"1 + ({k} // 3) % 4", "failures": f"{k} % 4",
        "schoolsup": yn(f"{k} % 6 = 0"), "famsup": yn(f"{k} % 4 = 0"), "paid": yn("p.n > 3"),
        "activities": yn(f"{k} % 2 = 1"), "nursery": yn(f"({k} // 23) % 5 <> 0"), "higher": yn(f"{k} % 9 <> 0"),
        "internet": yn(f"({k} // 29) % 4 <> 0"), "romantic": yn(f"{k} % 3 = 1"),
        "famrel": f"1 + {k} % 5", "freetime": f"1 + ({k} // 2) % 5", "goout": f"1 + ({k} // 5) % 5",
        "Dalc": f"1 + {k} % 5", "Walc": f"1 + ({k} // 4) % 5", "health": f"1 + ({k} // 6) % 5",
        "absences": f"CASE WHEN {k} % 97 = 3 THEN 75 ELSE (p.n * 2 + {k} % 7) % 40 END",
        "G1": g1, "G2": f"CAST(({g1} + {g3}) // 2 AS BIGINT)", "G3": g3,
    }
    cols = ", ".join(
        f"CAST({v} AS BIGINT) AS {c}" if c in U.INT_COLUMNS else f"{v} AS {c}" for c, v in vals.items())
    return f"""SELECT {cols}, '{course}' AS course, {k} AS k
      FROM (SELECT o_custkey, COUNT(*) AS n, AVG(o_totalprice) AS avgp,
                   COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS nf
            FROM orders WHERE o_orderpriority IN ({', '.join(map(repr, U.COURSE_PRIORITIES[course]))}) GROUP BY o_custkey) p
      JOIN customer c ON p.o_custkey = c.c_custkey"""


DOMAIN_CTES.setdefault("uci_rows", f"{_uci_sql('mat')} UNION ALL {_uci_sql('por')}")
KEYS_SQL = ", ".join(U.MERGE_KEYS)


def _courses(dom):
    files = L.uci_files(dom.spark, dom.dir)
    parts = []
    for rank, course in enumerate(("mat", "por")):
        df = U.load_course(dom.spark, files[course], course)
        # file order first, then the position inside the file
        parts.append(df.withColumn("ingest_ord", F.struct(F.lit(rank).alias("r"), F.col("ingest_ord.f"),
                                                          F.col("ingest_ord.b"), F.col("ingest_ord.i"))))
    return parts[0].unionByName(parts[1])


@register("S8_course_files",
          "SELECT course, COUNT(*) AS n_rows, CAST(SUM(G3) AS BIGINT) AS sum_g3, CAST(SUM(absences) AS BIGINT) AS sum_absences, "
          "COUNT(*) FILTER (WHERE G3 = 0) AS zero_final FROM uci_rows GROUP BY course")
def s8_course_files(dom):
    return _courses(dom).groupBy("course").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("G3").alias("sum_g3"), F.sum("absences").alias("sum_absences"),
        F.count_if(F.col("G3") == 0).alias("zero_final"))


@register("I3_cross_file_match",
          f"""WITH a AS (SELECT {KEYS_SQL}, COUNT(*) AS na FROM uci_rows WHERE course = 'mat' GROUP BY ALL),
                   b AS (SELECT {KEYS_SQL}, COUNT(*) AS nb FROM uci_rows WHERE course = 'por' GROUP BY ALL),
                   j AS (SELECT na, nb FROM a FULL OUTER JOIN b USING ({KEYS_SQL}))
              SELECT CAST(COALESCE(SUM(na * nb), 0) AS BIGINT) AS matched_pairs, COUNT(*) AS union_keys,
                     COUNT(*) FILTER (WHERE na IS NOT NULL AND nb IS NOT NULL) AS shared_keys FROM j""")
def i3_cross_file_match(dom):
    c = _courses(dom)
    return ID.cross_file_match(c.where(F.col("course") == "mat"), c.where(F.col("course") == "por"), U.MERGE_KEYS)


def course_etl(dom):
    """P5 without its checks: load -> union -> I1 record ids -> C10 clip -> I2 student ids -> C19.

    The files are read once, into one written table with the order flattened.  Record ids come
    first, so that what follows orders by one number, and a second written table holds them."""
    flat = [F.col(f"ingest_ord.{f}").alias(f"__o_{f}") for f in "rfbi"]
    order = [f"__o_{f}" for f in "rfbi"]
    df = written(_courses(dom).select("*", *flat).drop("ingest_ord"), "courses")
    rec = ID.consecutive_ids(df, order, "record_id", "R%04d").drop(*order)
    rec = written(rec.withColumn("__pos", F.expr("CAST(substring(record_id, 2) AS BIGINT)")), "records")
    clipped = C.clip_upper_quantile(rec, "absences", U.ABSENCES_CLIP_Q)
    return U.to_unified(ID.resolve_entities(clipped, U.MERGE_KEYS, "__pos", "student_id", "S%04d"))


def run_course_etl(dom, out_dir: str):
    """P5: the ETL, its checks (Q4), and the verified rows as Parquet; a failed check raises and leaves
    what was written aside under ``out_dir``_failed."""
    rows = written(course_etl(dom), "course-etl")
    bad = U.uci_checks(rows).where("failed_count > 0").collect()
    W.write_parquet(rows, f"{out_dir}_failed" if bad else out_dir)
    if bad:
        raise ValueError(f"course ETL: {', '.join(f'{r.rule}: {r.failed_count}' for r in bad)}")
    return dom.spark.read.schema(rows.schema).parquet(out_dir)


UCI_ETL_SQL = f"""ordered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY course, k) - 1 AS pos FROM uci_rows),
  firsts AS (SELECT {KEYS_SQL}, MIN(pos) AS first_pos FROM ordered GROUP BY ALL),
  sid AS (SELECT *, printf('S%04d', ROW_NUMBER() OVER (ORDER BY first_pos) - 1) AS student_id FROM firsts),
  withid AS (SELECT o.*, s.student_id, printf('R%04d', o.pos) AS record_id FROM ordered o
             JOIN sid s USING ({KEYS_SQL})),
  cap AS (SELECT quantile_cont(absences, 0.99) AS c FROM withid),
  clipped AS (SELECT w.* EXCLUDE (absences),
                     CASE WHEN w.absences > cap.c THEN cap.c ELSE CAST(w.absences AS DOUBLE) END AS absences
              FROM withid w, cap),
  unified AS (
    SELECT record_id, student_id, course, 'Student_' || substr(student_id, 2) AS name, CAST(age AS BIGINT) AS age,
           CASE sex WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' END AS gender, school || '-' || address AS city,
           ROUND(G3 / 5.0, 4) AS gpa, ROUND(LEAST(GREATEST(1.0 - absences / 100.0, 0.0), 1.0), 4) AS attendance_rate,
           CAST(3 AS BIGINT) AS n_assessments, G3 - G1 AS score_change, G1 AS score_1, G2 AS score_2,
           G3 AS score_final, school, address, 'uci' AS source
    FROM clipped)"""


@register("P5_course_etl", f"WITH {UCI_ETL_SQL} SELECT * FROM unified")
def p5_course_etl(dom):
    return run_course_etl(dom, f"{L.landing_root(dom.spark, dom.dir)}/p5_out")


@register("I2_entity_resolution",
          f"WITH {UCI_ETL_SQL} SELECT COUNT(*) AS n_rows, COUNT(DISTINCT student_id) AS n_students, "
          "(SELECT COUNT(*) FROM (SELECT student_id FROM unified GROUP BY 1 HAVING COUNT(*) > 1) x) AS multi_record, "
          "(SELECT COUNT(*) FROM (SELECT student_id FROM unified GROUP BY 1 HAVING COUNT(*) = 1) x) AS single_record, "
          "COUNT(*) FILTER (WHERE score_final = 0) AS zero_final FROM unified")
def i2_entity_resolution(dom):
    per = course_etl(dom).groupBy("student_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score_final") == 0).alias("zero"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_students"), F.count_if(F.col("n") > 1).alias("multi_record"),
                   F.count_if(F.col("n") == 1).alias("single_record"), F.coalesce(F.sum("zero"), F.lit(0)).alias("zero_final"))


# Q4 oracle: (rule, column, predicate); a NULL verdict fails except for the
# two not-null rules, as in ``uci_checks``.
_Q4_RULES = [
    ("not_null:record_id", "record_id", "record_id IS NOT NULL"),
    ("not_null:student_id", "student_id", "student_id IS NOT NULL"),
    ("domain:course", "course", "course IN ('mat', 'por')"),
    ("domain:gender", "gender", "gender IN ('Male', 'Female')"),
    ("range:gpa", "gpa", "gpa BETWEEN 0 AND 4"),
    ("range:attendance_rate", "attendance_rate", "attendance_rate BETWEEN 0 AND 1"),
    ("range:age", "age", "age BETWEEN 15 AND 22"),
    ("formula:score_change", "score_change", "score_change = score_final - score_1"),
    ("formula:gpa", "gpa", "abs(gpa - score_final / 5.0) < 1e-9"),
    ("const:n_assessments", "n_assessments", "n_assessments = 3"),
    ("const:source", "source", "source = 'uci'"),
    ("range:scores", "score_final", "score_final BETWEEN 0 AND 20"),
]
Q4_SQL = f"WITH {UCI_ETL_SQL} " + " UNION ALL ".join(
    f"SELECT '{r}' AS rule, '{c}' AS column_name, COUNT(*) FILTER (WHERE NOT COALESCE({p}, FALSE)) AS failed_count, "
    f"COUNT(*) AS total_rows FROM unified" for r, c, p in _Q4_RULES)


@register("Q4_course_checks", Q4_SQL)
def q4_course_checks(dom):
    return U.uci_checks(course_etl(dom))
