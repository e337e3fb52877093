"""Binding of the university domain onto the driver tables.

The analytics corpus speaks about students, instructors, courses,
enrollments and assessments.  At scale those come from the warehouse tables:

* students     <- customer JOIN nation JOIN region   (one row per customer)
* instructors  <- supplier JOIN nation
* courses      <- part; the teaching instructor is ``p_partkey mod #suppliers``
* enrollments  <- lineitem JOIN orders  (a student enrolls in a course on the
                  order date; the grain is the order line)
* assessments  <- events  (``event_id`` is unique, the course is the ``k``
                  field of the JSON ``props``, the score is ``100 - value/5``
                  as DECIMAL(7,2) so sums and averages are exact; ``value``
                  has two decimals, so value/5 never ends on a rounding tie)

Each function returns a lazy DataFrame; only the columns a query selects are
read from parquet.  The dimension joins are against tiny tables (25 nations,
5 regions, one-row supplier count) and are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import read_table

# Mapping of event kinds to assessment types.  'error' has no
# counterpart in the declared domain and is kept as 'Retake' so the CHECK
# report (Q13) has real violations to find.
ASSESSMENT_TYPE_OF_EVENT = {
    "click": "Quiz",
    "view": "Midterm",
    "purchase": "Final",
    "signup": "Project",
    "error": "Retake",
}

SCORE_TYPE = "decimal(7,2)"


def _type_case(col):
    expr = None
    for k, v in ASSESSMENT_TYPE_OF_EVENT.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(col)


def students(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer")
    n = read_table(spark, d, "nation")
    r = read_table(spark, d, "region")
    geo = F.broadcast(
        n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
            "n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("country")
        )
    )
    return c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        F.col("c_custkey").alias("student_id"),
        F.col("c_name").alias("full_name"),
        F.when(F.col("c_custkey") % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.date_add(F.lit("1990-01-01").cast("date"), (F.col("c_custkey") % 5000).cast("int")).alias(
            "date_of_birth"
        ),
        "city",
        "country",
    )


def instructors(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier")
    n = read_table(spark, d, "nation")
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("instructor_id"),
        F.col("s_name").alias("full_name"),
        F.col("n_name").alias("department"),
        F.concat(F.lower(F.regexp_replace("s_name", "#", ".")), F.lit("@uni.edu")).alias("email"),
    )


def courses(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part")
    n_sup = read_table(spark, d, "supplier").agg(F.count(F.lit(1)).alias("n_sup"))
    # one-row aggregate: broadcast by construction
    return p.crossJoin(F.broadcast(n_sup)).select(
        F.col("p_partkey").alias("course_id"),
        F.col("p_name").alias("course_name"),
        F.col("p_size").alias("credit_hours"),
        (F.col("p_partkey") % F.col("n_sup")).alias("instructor_id"),
    )


def enrollments(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("enrollment_id"),
        F.col("o_custkey").alias("student_id"),
        F.col("l_partkey").alias("course_id"),
        F.to_date("o_orderdate").alias("enrollment_date"),
        F.concat(
            F.year("o_orderdate").cast("string"), F.lit("-Q"), F.quarter("o_orderdate").cast("string")
        ).alias("semester"),
    )


def assessments(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events")
    return e.select(
        F.col("event_id").alias("assessment_id"),
        F.col("user_id").alias("student_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("course_id"),
        _type_case(F.col("event_type")).alias("assessment_type"),
        (F.lit(100.0) - F.col("value") / F.lit(5.0)).cast(SCORE_TYPE).alias("score"),
        F.col("ts").alias("assessed_at"),
    )


class Domain:
    """Lazy accessors for the five domain tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def students(self) -> DataFrame:
        return students(self.spark, self.dir)

    def instructors(self) -> DataFrame:
        return instructors(self.spark, self.dir)

    def courses(self) -> DataFrame:
        return courses(self.spark, self.dir)

    def enrollments(self) -> DataFrame:
        return enrollments(self.spark, self.dir)

    def assessments(self) -> DataFrame:
        return assessments(self.spark, self.dir)
