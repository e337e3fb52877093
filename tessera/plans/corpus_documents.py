"""Document-collection queries (F1, N1-N15, Q15) over the landed
collection of nested student documents, with DuckDB oracles
(DuckDB structs and lists mirror Spark structs and arrays)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import documents as D
from tessera.plans.registry import DOMAIN_CTES, register
from tessera.sources import landing as L
from tessera.sources.documents import DOCUMENTS_SQL, read_collection

DOMAIN_CTES.setdefault("student_docs", DOCUMENTS_SQL)

# Query parameters of the collection reads.
CITY = "NATION_3"
SKILLS = ("Python", "SQL")
PROJECT_YEAR = 1997


def _docs(dom):
    return read_collection(dom.spark, L.student_collection(dom.spark, dom.dir))


@register("F1_flatten_documents",
          """SELECT student_id, personal.name AS "personal.name", personal.age AS "personal.age",
                    personal.city AS "personal.city", personal.country AS "personal.country", skills,
                    academic.gpa AS "academic.gpa", academic.attendance AS "academic.attendance",
                    len(projects) AS project_count
             FROM student_docs""")
def f1_flatten_documents(dom):
    flat = D.flatten(_docs(dom))
    return flat.withColumn("project_count", F.size("projects").cast("bigint")).drop("projects")


@register("N1_by_city", f"SELECT student_id, personal.name AS name FROM student_docs WHERE personal.city = '{CITY}'")
def n1_by_city(dom):
    return D.by_city(_docs(dom), CITY).select("student_id", F.col("personal.name").alias("name"))


@register("N2_gpa_range",
          "SELECT student_id, academic.gpa AS gpa FROM student_docs WHERE academic.gpa BETWEEN 3.0 AND 4.0")
def n2_gpa_range(dom):
    return D.by_gpa_range(_docs(dom), 3.0, 4.0).select("student_id", F.col("academic.gpa").alias("gpa"))


@register("N3_skills_all",
          f"SELECT student_id FROM student_docs WHERE list_has_all(skills, {list(SKILLS)})")
def n3_skills_all(dom):
    return D.by_skills(_docs(dom), list(SKILLS), True).select("student_id")


@register("N3_skills_any",
          "SELECT student_id FROM student_docs WHERE list_has_any(skills, ['Java', 'Polars'])")
def n3_skills_any(dom):
    return D.by_skills(_docs(dom), ["Java", "Polars"], False).select("student_id")


@register("N4_projection",
          """SELECT student_id, personal.name AS "personal.name", academic.gpa AS "academic.gpa"
             FROM student_docs""")
def n4_projection(dom):
    return D.project(_docs(dom), ["student_id", "personal.name", "academic.gpa"])


@register("N5_high_performers",
          "SELECT student_id FROM student_docs WHERE academic.gpa >= 3.5 AND academic.attendance >= 90")
def n5_high_performers(dom):
    return D.high_performers(_docs(dom)).select("student_id")


@register("N6_project_elem_match",
          f"""SELECT student_id FROM student_docs
              WHERE len(list_filter(projects, lambda p: p.year = {PROJECT_YEAR} AND p.status = 'Completed')) > 0""")
def n6_project_elem_match(dom):
    return D.by_project(_docs(dom), PROJECT_YEAR, "Completed").select("student_id")


@register("N7_count_by_city",
          "SELECT personal.city AS city, COUNT(*) AS count FROM student_docs GROUP BY 1 ORDER BY count DESC")
def n7_count_by_city(dom):
    return D.count_by_city(_docs(dom))


@register("N8_avg_gpa_by_city",
          """SELECT personal.city AS city, ROUND(AVG(academic.gpa), 6) AS average_gpa, COUNT(*) AS student_count
             FROM student_docs GROUP BY 1 ORDER BY average_gpa DESC""")
def n8_avg_gpa_by_city(dom):
    return D.avg_gpa_by_city(_docs(dom)).withColumn("average_gpa", F.round("average_gpa", 6))


@register("N9_top_skills",
          """SELECT skill, COUNT(*) AS count FROM (SELECT unnest(skills) AS skill FROM student_docs) s
             GROUP BY skill ORDER BY count DESC, skill LIMIT 5""")
def n9_top_skills(dom):
    return D.top_skills(_docs(dom), 5)


@register("N10_document_features",
          """SELECT student_id, academic.attendance / 100 AS attendance_rate,
                    COALESCE(list_contains(skills, 'Python'), FALSE) AS skill_python,
                    COALESCE(list_contains(skills, 'SQL'), FALSE) AS skill_sql,
                    COALESCE(list_contains(skills, 'MongoDB'), FALSE) AS skill_mongodb,
                    COALESCE(list_contains(skills, 'Pandas'), FALSE) AS skill_pandas,
                    COALESCE(list_contains(skills, 'Polars'), FALSE) AS skill_polars,
                    COALESCE(len(projects), 0) AS project_count
             FROM student_docs""")
def n10_document_features(dom):
    f = D.add_features(D.flatten(_docs(dom)))
    return f.select("student_id", "attendance_rate", *[f"skill_{s.lower()}" for s in D.FLAG_SKILLS],
                    F.col("project_count").cast("bigint").alias("project_count"))


@register("Q15_document_validation",
          """SELECT is_valid, COUNT(*) AS n FROM (
               SELECT student_id IS NOT NULL AND personal.name IS NOT NULL AND personal.city IS NOT NULL
                      AND academic.gpa IS NOT NULL AND COALESCE(academic.gpa BETWEEN 0 AND 4, TRUE)
                      AND COALESCE(academic.attendance BETWEEN 0 AND 100, TRUE) AND skills IS NOT NULL AS is_valid
               FROM student_docs) v GROUP BY is_valid""")
def q15_document_validation(dom):
    return D.validate_documents(_docs(dom)).groupBy("is_valid").agg(F.count(F.lit(1)).alias("n"))


def event_changes(dom):
    """Ordered change table derived from events (seq = event_id)."""
    e = dom.spark.read.parquet(f"{dom.dir}/events.parquet")
    t = F.col("event_type")
    op = (F.when(t == "view", "set_gpa").when(t == "signup", "inc_attendance")
          .when(t == "purchase", "add_skill").when(t == "error", "remove_skill").when(t == "click", "add_skill"))
    value = (F.when(t == "view", ((F.floor("value").cast("bigint") % 401) / F.lit(100.0)).cast("string"))
             .when(t == "signup", F.lit("1")).when(t == "purchase", F.lit("Buyer"))
             .when(t == "error", F.lit("Python")).when(t == "click", F.lit("Python")))
    return e.select(F.col("event_id").alias("seq"), op.alias("op"), F.col("user_id").alias("student_id"),
                    value.alias("value"))


CHANGES_SQL = """SELECT event_id AS seq,
    CASE event_type WHEN 'view' THEN 'set_gpa' WHEN 'signup' THEN 'inc_attendance' WHEN 'purchase' THEN 'add_skill'
                    WHEN 'error' THEN 'remove_skill' WHEN 'click' THEN 'add_skill' END AS op,
    user_id AS student_id,
    CASE event_type WHEN 'view' THEN CAST((CAST(floor(value) AS BIGINT) % 401) / 100.0 AS VARCHAR)
                    WHEN 'signup' THEN '1' WHEN 'purchase' THEN 'Buyer' WHEN 'error' THEN 'Python'
                    WHEN 'click' THEN 'Python' END AS value
  FROM events"""


@register("N11_N13_apply_event_changes",
          f"""WITH changes AS ({CHANGES_SQL}),
              g AS (SELECT student_id, arg_max(CAST(value AS DOUBLE), seq) AS g FROM changes WHERE op = 'set_gpa'
                    GROUP BY student_id),
              i AS (SELECT student_id, SUM(CAST(value AS BIGINT)) AS i FROM changes WHERE op = 'inc_attendance'
                    GROUP BY student_id),
              sk AS (SELECT student_id, value, arg_max(op, seq) AS last FROM changes
                     WHERE op IN ('add_skill', 'remove_skill') GROUP BY student_id, value),
              s2 AS (SELECT student_id, COALESCE(list(value) FILTER (WHERE last = 'add_skill'), []) AS adds,
                            COALESCE(list(value) FILTER (WHERE last = 'remove_skill'), []) AS rms
                     FROM sk GROUP BY student_id)
              SELECT d.student_id, COALESCE(g.g, d.academic.gpa) AS gpa,
                     CAST(d.academic.attendance + COALESCE(i.i, 0) AS BIGINT) AS attendance,
                     list_sort(CASE WHEN s2.student_id IS NULL THEN d.skills
                          ELSE list_filter(list_distinct(list_concat(d.skills, s2.adds)),
                                           lambda x: NOT list_contains(s2.rms, x)) END) AS skills
              FROM student_docs d LEFT JOIN g ON d.student_id = g.student_id
              LEFT JOIN i ON d.student_id = i.student_id LEFT JOIN s2 ON d.student_id = s2.student_id""")
def n11_n13_apply_event_changes(dom):
    out = D.apply_changes(_docs(dom), event_changes(dom))
    return out.select("student_id", F.col("academic.gpa").alias("gpa"),
                      F.col("academic.attendance").alias("attendance"), F.array_sort("skills").alias("skills"))


@register("N15_delete_by_city",
          f"SELECT student_id FROM student_docs WHERE NOT COALESCE(personal.city = '{CITY}', FALSE)")
def n15_delete_by_city(dom):
    return D.delete_where(_docs(dom), F.col("personal.city") == CITY).select("student_id")


@register("N12_skill_set_changes",
          f"""WITH changes AS ({CHANGES_SQL}),
              r AS (SELECT student_id, value, MAX(seq) FILTER (WHERE op = 'remove_skill') AS r FROM changes
                    WHERE op IN ('add_skill', 'remove_skill') GROUP BY student_id, value),
              sk AS (SELECT c.student_id, c.value, MAX(r.r) AS r,
                            MIN(c.seq) FILTER (WHERE c.op = 'add_skill' AND c.seq > COALESCE(r.r, -1)) AS a
                     FROM changes c JOIN r ON c.student_id = r.student_id AND c.value = r.value
                     WHERE c.op IN ('add_skill', 'remove_skill') GROUP BY c.student_id, c.value),
              s2 AS (SELECT student_id, COALESCE(list(value ORDER BY a) FILTER (WHERE a IS NOT NULL), []) AS adds,
                            COALESCE(list(value) FILTER (WHERE r IS NOT NULL), []) AS rms
                     FROM sk GROUP BY student_id),
              k AS (SELECT d.student_id, d.skills AS old, s2.adds,
                           CASE WHEN s2.student_id IS NULL THEN d.skills
                                ELSE list_filter(d.skills, lambda x: NOT list_contains(s2.rms, x)) END AS kept
                    FROM student_docs d LEFT JOIN s2 ON d.student_id = s2.student_id),
              n AS (SELECT student_id, old,
                           CASE WHEN adds IS NULL THEN kept
                                ELSE list_concat(kept, list_filter(adds, lambda x: NOT list_contains(kept, x)))
                           END AS new FROM k)
              SELECT student_id, new AS skills,
                     list_sort(old) IS DISTINCT FROM list_sort(new) AS modified FROM n""")
def n12_skill_set_changes(dom):
    ch = event_changes(dom).where(F.col("op").isin("add_skill", "remove_skill"))
    out = D.apply_changes(_docs(dom), ch)
    return out.select("student_id", "skills", "modified")


@register("N14_upsert_event_skills",
          """WITH inc AS (SELECT user_id AS student_id, list_sort(list_distinct(list(event_type))) AS skills
                          FROM events GROUP BY user_id)
             SELECT COALESCE(d.student_id, i.student_id) AS student_id, COALESCE(i.skills, d.skills) AS skills,
                    CASE WHEN d.student_id IS NOT NULL AND i.student_id IS NOT NULL THEN 'matched'
                         WHEN i.student_id IS NOT NULL THEN 'inserted' ELSE 'unchanged' END AS _action
             FROM student_docs d FULL OUTER JOIN inc i ON d.student_id = i.student_id""")
def n14_upsert_event_skills(dom):
    e = dom.spark.read.parquet(f"{dom.dir}/events.parquet")
    inc = e.groupBy(F.col("user_id").alias("student_id")).agg(
        F.array_sort(F.collect_set("event_type")).alias("skills"))
    return D.upsert(_docs(dom).select("student_id", "skills"), inc).select("student_id", "skills", "_action")
