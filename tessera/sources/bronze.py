"""Bronze student records: the raw 6-column source the cleaning layer eats.

The driver tables are clean, so the bronze layer is derived from
``customer JOIN nation`` by fixed, key-based rules that plant every defect
the silver layer must handle: string-typed numbers, blanks, 'nan', fractional
integers, text that is not a number, out-of-range values, padded and
mixed-case text, NULL ids/names/cities, exact duplicate rows and re-used ids
with different content.  ``ingest_ord`` is the position of the record in the
landed file (customer key, then copy number), so "keep first" is defined.

Every rule is integer arithmetic on the key, so the same table can be stated
in SQL for the oracle (see ``BRONZE_SQL``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import read_table

STANDARD_COLUMNS = ("student_id", "name", "age", "gpa", "attendance", "city")


def bronze_students(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name")
    base = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    k = F.col("c_custkey")
    copies = base.select("*", F.lit(0).alias("copy")).unionByName(
        base.where(k % 10 == 0).select("*", F.lit(1).alias("copy"))
    ).unionByName(
        base.where(k % 25 == 1).select("*", F.lit(2).alias("copy"))
    )
    name = (
        F.when(k % 89 == 3, F.lit(None).cast("string"))
        .when(F.col("copy") == 2, F.concat(F.lit("Dup "), F.col("c_name")))
        .when(k % 7 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit("  ")))
        .when(k % 7 == 1, F.concat(F.col("c_name"), F.lit("\t")))
        .when(k % 7 == 2, F.regexp_replace("c_name", "#", "  #"))
        .otherwise(F.col("c_name"))
    )
    age = (
        F.when(k % 53 == 7, F.lit("150"))
        .when(k % 59 == 11, F.lit("20.5"))
        .when(k % 61 == 13, F.lit("abc"))
        .when(k % 67 == 17, F.lit(None).cast("string"))
        .when(k % 43 == 5, F.lit("20.0"))
        .otherwise((F.lit(16) + k % 40).cast("string"))
    )
    gpa_num = (F.floor(F.abs(F.col("c_acctbal"))).cast("bigint") % 451).cast("double") / F.lit(100.0)
    gpa = (
        F.when(k % 71 == 19, F.lit("nan"))
        .when(k % 73 == 23, F.lit(""))
        .otherwise(gpa_num.cast("string"))
    )
    attendance = (
        F.when(k % 79 == 2, F.lit("95.5"))
        .otherwise(((k * 37) % 121).cast("string"))
    )
    city = (
        F.when(k % 83 == 9, F.lit(None).cast("string"))
        .when(k % 5 == 0, F.lower("n_name"))
        .when(k % 5 == 1, F.concat(F.lit("  "), F.upper("n_name"), F.lit(" ")))
        .when(k % 5 == 2, F.regexp_replace("n_name", "_", "-"))
        .otherwise(F.col("n_name"))
    )
    sid = F.when(k % 97 == 5, F.lit(None).cast("string")).otherwise(k.cast("string"))
    return copies.select(
        sid.alias("student_id"), name.alias("name"), age.alias("age"), gpa.alias("gpa"),
        attendance.alias("attendance"), city.alias("city"),
        (k * 4 + F.col("copy")).alias("ingest_ord"),
    )


BRONZE_SQL = """SELECT
    CASE WHEN k % 97 = 5 THEN NULL ELSE CAST(k AS VARCHAR) END AS student_id,
    CASE WHEN k % 89 = 3 THEN NULL WHEN copy = 2 THEN 'Dup ' || c_name
         WHEN k % 7 = 0 THEN '  ' || c_name || '  ' WHEN k % 7 = 1 THEN c_name || chr(9)
         WHEN k % 7 = 2 THEN replace(c_name, '#', '  #') ELSE c_name END AS name,
    CASE WHEN k % 53 = 7 THEN '150' WHEN k % 59 = 11 THEN '20.5' WHEN k % 61 = 13 THEN 'abc'
         WHEN k % 67 = 17 THEN NULL WHEN k % 43 = 5 THEN '20.0' ELSE CAST(16 + k % 40 AS VARCHAR) END AS age,
    CASE WHEN k % 71 = 19 THEN 'nan' WHEN k % 73 = 23 THEN ''
         ELSE CAST((CAST(floor(abs(c_acctbal)) AS BIGINT) % 451) / 100.0 AS VARCHAR) END AS gpa,
    CASE WHEN k % 79 = 2 THEN '95.5' ELSE CAST((k * 37) % 121 AS VARCHAR) END AS attendance,
    CASE WHEN k % 83 = 9 THEN NULL WHEN k % 5 = 0 THEN lower(n_name)
         WHEN k % 5 = 1 THEN '  ' || upper(n_name) || ' ' WHEN k % 5 = 2 THEN replace(n_name, '_', '-')
         ELSE n_name END AS city,
    k * 4 + copy AS ingest_ord
  FROM (
    SELECT c.c_custkey AS k, c.c_name, c.c_acctbal, n.n_name, 0 AS copy
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    UNION ALL
    SELECT c.c_custkey, c.c_name, c.c_acctbal, n.n_name, 1
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_custkey % 10 = 0
    UNION ALL
    SELECT c.c_custkey, c.c_name, c.c_acctbal, n.n_name, 2
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_custkey % 25 = 1
  ) src"""
