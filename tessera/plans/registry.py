"""Registry of named queries: a Spark builder plus, where SQL can say it, an
independent DuckDB oracle over the same driver tables.

The oracle restates the domain binding of ``tessera.sources.domain`` in SQL
so that every check starts from the raw parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.domain import Domain

DOMAIN_CTES = {
    "students": """SELECT c.c_custkey AS student_id, c.c_name AS full_name,
        CASE WHEN c.c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
        CAST(DATE '1990-01-01' + CAST(c.c_custkey % 5000 AS INTEGER) AS DATE) AS date_of_birth,
        n.n_name AS city, r.r_name AS country
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "instructors": """SELECT s.s_suppkey AS instructor_id, s.s_name AS full_name,
        n.n_name AS department, lower(replace(s.s_name, '#', '.')) || '@uni.edu' AS email
      FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "courses": """SELECT p_partkey AS course_id, p_name AS course_name, p_size AS credit_hours,
        p_partkey % (SELECT COUNT(*) FROM supplier) AS instructor_id FROM part""",
    "enrollments": """SELECT l.l_orderkey * 10 + l.l_linenumber AS enrollment_id,
        o.o_custkey AS student_id, l.l_partkey AS course_id,
        CAST(o.o_orderdate AS DATE) AS enrollment_date,
        CAST(year(o.o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o.o_orderdate) AS VARCHAR) AS semester
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "assessments": """SELECT event_id AS assessment_id, user_id AS student_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS course_id,
        CASE event_type WHEN 'click' THEN 'Quiz' WHEN 'view' THEN 'Midterm'
          WHEN 'purchase' THEN 'Final' WHEN 'signup' THEN 'Project'
          WHEN 'error' THEN 'Retake' ELSE event_type END AS assessment_type,
        CAST(100.0 - value / 5.0 AS DECIMAL(7,2)) AS score, ts AS assessed_at
      FROM events""",
}


def with_domain(body: str) -> str:
    """Prefix a query with the domain CTEs it mentions."""
    needed = [k for k in DOMAIN_CTES if k in body]
    if not needed:
        return body
    ctes = ",\n".join(f"{k} AS ({DOMAIN_CTES[k]})" for k in needed)
    stripped = body.lstrip()
    if stripped[:4].upper() == "WITH":
        return f"WITH {ctes},\n{stripped[4:].lstrip()}"
    return f"WITH {ctes}\n{stripped}"


@dataclass
class Entry:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Entry] = {}


def register(key: str, oracle: str | None = None, domain_sql: bool = True):
    """Decorator: ``fn(dom: Domain) -> DataFrame`` or ``fn(spark, sf_dir)``."""

    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Domain(spark, sf_dir))

        sql = None
        if oracle is not None:
            sql = with_domain(oracle) if domain_sql else oracle
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, build, sql)
        return fn

    return deco
