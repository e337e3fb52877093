"""UCI-style course files (S8) and the course ETL (P5 steps C10, C18, C19, Q4).

Course files are derived from the driver tables: every order
belongs to one course by its priority, and a customer is enrolled in the
courses of its orders, so many students appear in both files; the 33
attributes are functions of the customer and its orders in that course.  The
13 identity attributes are coarse, so distinct customers can collide, as
real survey records do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import read_table

# File layout and identity keys of the course files.
UCI_COLUMNS = [
    "school", "sex", "age", "address", "famsize", "Pstatus", "Medu", "Fedu", "Mjob", "Fjob", "reason",
    "guardian", "traveltime", "studytime", "failures", "schoolsup", "famsup", "paid", "activities",
    "nursery", "higher", "internet", "romantic", "famrel", "freetime", "goout", "Dalc", "Walc", "health",
    "absences", "G1", "G2", "G3",
]
INT_COLUMNS = ["age", "Medu", "Fedu", "traveltime", "studytime", "failures", "famrel", "freetime", "goout",
               "Dalc", "Walc", "health", "absences", "G1", "G2", "G3"]
MERGE_KEYS = ["school", "sex", "age", "address", "famsize", "Pstatus", "Medu", "Fedu", "Mjob", "Fjob", "reason",
              "nursery", "internet"]
COURSE_PRIORITIES = {"mat": ("1-URGENT", "3-MEDIUM", "5-LOW"), "por": ("2-HIGH", "4-NOT SPECIFIED")}
JOBS = ["teacher", "health", "services", "at_home", "other"]
REASONS = ["home", "reputation", "course", "other"]
SEX_LABELS = {"M": "Male", "F": "Female"}
ABSENCES_CLIP_Q = 0.99


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values)).cast("int") + 1)


def uci_course_frame(spark: SparkSession, d: str, course: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    per = o.where(F.col("o_orderpriority").isin(*COURSE_PRIORITIES[course])).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("avgp"),
        F.count_if(F.col("o_orderstatus") == "F").alias("nf"))
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    j = per.join(c.hint("merge"), per.o_custkey == c.c_custkey)    # a row per customer on both sides: no broadcast
    k = F.col("c_custkey")
    yn = lambda x: F.when(x, "yes").otherwise("no")
    g1 = (F.floor(F.col("avgp") / 20000) % 21).cast("bigint")
    g3 = F.when(k % 37 == 0, F.lit(0)).otherwise((g1 + F.col("nf")) % 21).cast("bigint")
    vals = {
        "school": F.when(F.col("c_nationkey") < 13, "GP").otherwise("MS"),
        "sex": F.when(k % 2 == 0, "M").otherwise("F"),
        "age": 15 + k % 8,
        "address": F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), "U").otherwise("R"),
        "famsize": F.when(k % 3 == 0, "LE3").otherwise("GT3"),
        "Pstatus": F.when(k % 5 == 0, "A").otherwise("T"),
        "Medu": (k / 7).cast("long") % 5, "Fedu": (k / 11).cast("long") % 5,
        "Mjob": _pick(JOBS, (k / 13).cast("long")), "Fjob": _pick(JOBS, (k / 17).cast("long")),
        "reason": _pick(REASONS, (k / 19).cast("long")),
        "guardian": _pick(["mother", "father", "other"], k),
        "traveltime": 1 + k % 4, "studytime": 1 + (k / 3).cast("long") % 4, "failures": k % 4,
        "schoolsup": yn(k % 6 == 0), "famsup": yn(k % 4 == 0), "paid": yn(F.col("n") > 3),
        "activities": yn(k % 2 == 1), "nursery": yn((k / 23).cast("long") % 5 != 0),
        "higher": yn(k % 9 != 0), "internet": yn((k / 29).cast("long") % 4 != 0), "romantic": yn(k % 3 == 1),
        "famrel": 1 + k % 5, "freetime": 1 + (k / 2).cast("long") % 5, "goout": 1 + (k / 5).cast("long") % 5,
        "Dalc": 1 + k % 5, "Walc": 1 + (k / 4).cast("long") % 5, "health": 1 + (k / 6).cast("long") % 5,
        "absences": F.when(k % 97 == 3, F.lit(75)).otherwise((F.col("n") * 2 + k % 7) % 40),
        "G1": g1, "G2": ((g1 + g3) / 2).cast("bigint"), "G3": g3,
    }
    return j.select(*[vals[c].cast("string").alias(c) for c in UCI_COLUMNS], k.alias("__k"))


def load_course(spark: SparkSession, path: str, course: str) -> DataFrame:
    """S8: ';'-separated, quoted, all columns as text, then strict integer
    casts (a bad value fails the job, as in the reference) and the course."""
    from tessera.sources.readers import read_csv

    df = read_csv(spark, path, sep=";", all_strings=True)
    casts = {c: F.col(c).cast("bigint") for c in INT_COLUMNS}  # ANSI: raises on bad text
    return df.withColumns(casts).withColumn("course", F.lit(course))


def to_unified(df: DataFrame) -> DataFrame:
    """C18 + C19: course rows -> the 17-column silver record."""
    return df.select(
        "record_id", "student_id", F.col("course").cast("string").alias("course"),
        F.concat(F.lit("Student_"), F.expr("substring(student_id, 2)")).alias("name"),
        F.col("age").cast("bigint").alias("age"),
        _recode_sex(F.col("sex")).alias("gender"),
        F.concat_ws("-", "school", "address").alias("city"),
        F.round(F.col("G3") / 5.0, 4).alias("gpa"),
        F.round(F.least(F.greatest(1.0 - F.col("absences") / 100.0, F.lit(0.0)), F.lit(1.0)), 4).alias(
            "attendance_rate"),
        F.lit(3).cast("bigint").alias("n_assessments"),
        (F.col("G3") - F.col("G1")).cast("bigint").alias("score_change"),
        F.col("G1").cast("bigint").alias("score_1"), F.col("G2").cast("bigint").alias("score_2"),
        F.col("G3").cast("bigint").alias("score_final"),
        F.col("school").cast("string").alias("school"), F.col("address").cast("string").alias("address"),
        F.lit("uci").alias("source"),
    )


def _recode_sex(c):
    from tessera.operators.clean import recode

    return recode(c, SEX_LABELS)


def uci_checks(df: DataFrame, clip_threshold_col: str | None = None) -> DataFrame:
    """Q4: post-ETL checks as one rule pass."""
    from tessera.operators.quality import Rule, evaluate

    rules = [
        Rule("not_null:record_id", "record_id", F.col("record_id").isNotNull()),
        Rule("not_null:student_id", "student_id", F.col("student_id").isNotNull()),
        Rule("domain:course", "course", F.col("course").isin("mat", "por"), nulls_fail=True),
        Rule("domain:gender", "gender", F.col("gender").isin("Male", "Female"), nulls_fail=True),
        Rule("range:gpa", "gpa", F.col("gpa").between(0, 4), nulls_fail=True),
        Rule("range:attendance_rate", "attendance_rate", F.col("attendance_rate").between(0, 1), nulls_fail=True),
        Rule("range:age", "age", F.col("age").between(15, 22), nulls_fail=True),
        Rule("formula:score_change", "score_change",
             F.col("score_change") == F.col("score_final") - F.col("score_1"), nulls_fail=True),
        Rule("formula:gpa", "gpa", F.abs(F.col("gpa") - F.col("score_final") / 5.0) < 1e-9, nulls_fail=True),
        Rule("const:n_assessments", "n_assessments", F.col("n_assessments") == 3, nulls_fail=True),
        Rule("const:source", "source", F.col("source") == "uci", nulls_fail=True),
        Rule("range:scores", "score_final", F.col("score_final").between(0, 20), nulls_fail=True),
    ]
    return evaluate(df, rules)
