"""Nested student documents derived from the driver tables (the document
collection source, S5).

Shape: ``student_id``, ``personal{name, age, city, country}``,
``skills: array<string>``, ``academic{gpa, attendance}``,
``projects: array<struct<name, year, status, technologies: array<string>>>``.

* skills: the distinct part types a customer ordered, named as skills.  The
  set is bounded by the number of part types (6), so even a customer with a
  third of all orders yields a 6-element array; ``collect_set`` merges
  partial sets map-side.
* projects: one per (customer, order priority) -- at most 5 -- with the
  first order year, 'Completed' when every order of the group is filled,
  and the sorted skill names of its parts.

``landing.student_collection`` writes them once as nested Parquet, in the order of city and id;
``read_collection`` reads that export, so that a query scans only the nested
paths it asks for and its filters reach the row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import _path_exists, read_table

# Part type -> skill name.
SKILL_OF_PART_TYPE = {
    "ECONOMY": "Python",
    "STANDARD": "SQL",
    "LARGE": "MongoDB",
    "MEDIUM": "Pandas",
    "SMALL": "Polars",
    "PROMO": "Java",
}


# The nested record of the collection.
DOCUMENT_SCHEMA = (
    "student_id bigint, personal struct<name:string,age:bigint,city:string,country:string>, skills array<string>, "
    "academic struct<gpa:double,attendance:bigint>, "
    "projects array<struct<name:string,year:bigint,status:string,technologies:array<string>>>")


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """The exported collection; a missing export raises."""
    if not _path_exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.schema(DOCUMENT_SCHEMA).parquet(path)


def _skill(col):
    expr = None
    for k, v in SKILL_OF_PART_TYPE.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(col)


def _names(rows):
    return F.array_sort(F.array_distinct(F.filter(F.transform(rows, lambda r: r["skill"]), lambda s: s.isNotNull())))


def _projects(rows):
    """One project for each priority among the rows of a customer."""
    def project(name):
        own = F.filter(rows, lambda r: r["name"].eqNullSafe(name))
        return F.struct(
            name.alias("name"), F.array_min(F.transform(own, lambda r: r["year"])).alias("year"),
            F.when(F.forall(own, lambda r: r["filled"] == 1), "Completed").otherwise("In Progress").alias("status"),
            # a group without a priority has no name to find its parts by
            F.when(name.isNotNull(), _names(own)).otherwise(F.array().cast("array<string>")).alias("technologies"))

    return F.array_sort(F.transform(F.array_distinct(F.transform(rows, lambda r: r["name"])), project))


def student_documents(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, d, "region").select("r_regionkey", "r_name")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                              "o_orderpriority")
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    p = read_table(spark, d, "part").select("p_partkey", "p_type")
    # Orders keep their row without lines.  One pass gives all: the least year and flag of an order are the
    # same for each of its lines, and plain aggregates combine before the shuffle, whatever a customer holds.
    # Parts grow with the input and are wide in memory, however small their files are: hashed by key in the tasks.
    lines = li.join(p.hint("shuffle_hash"), li.l_partkey == p.p_partkey).select("l_orderkey", _skill(F.col("p_type")).alias("skill"))
    per_skill = o.join(lines.hint("merge"), o.o_orderkey == lines.l_orderkey, "left").groupBy("o_custkey", "o_orderpriority", "skill").agg(
        F.min(F.year("o_orderdate")).cast("bigint").alias("year"),
        F.min(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("filled"))
    # A customer has few of these rows, so they meet by customer, and are gathered once.
    per = per_skill.repartition("o_custkey").groupBy("o_custkey").agg(
        F.collect_list(F.struct(F.col("o_orderpriority").alias("name"), "skill", "year", "filled")).alias("rows")).select(
        "o_custkey", _names(F.col("rows")).alias("skills"), _projects(F.col("rows")).alias("projects"))
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    base = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey)
    k = F.col("c_custkey")
    docs = base.join(per.hint("merge"), k == per.o_custkey, "left")
    return docs.select(
        k.alias("student_id"),
        F.struct(F.col("c_name").alias("name"), (F.lit(16) + k % 40).cast("bigint").alias("age"),
                 F.col("n_name").alias("city"), F.col("r_name").alias("country")).alias("personal"),
        F.coalesce("skills", F.array().cast("array<string>")).alias("skills"),
        F.struct(((F.floor(F.abs("c_acctbal")).cast("bigint") % 401) / F.lit(100.0)).alias("gpa"),
                 ((k * 37) % 101).cast("bigint").alias("attendance")).alias("academic"),
        F.coalesce("projects", F.array().cast(
            "array<struct<name:string,year:bigint,status:string,technologies:array<string>>>")).alias("projects"),
    )


def _sql_skill(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SKILL_OF_PART_TYPE.items())
    return f"CASE {col} {whens} ELSE {col} END"


DOCUMENTS_SQL = f"""SELECT c.c_custkey AS student_id,
    {{'name': c.c_name, 'age': CAST(16 + c.c_custkey % 40 AS BIGINT), 'city': n.n_name, 'country': r.r_name}}
      AS personal,
    COALESCE(sk.skills, []::VARCHAR[]) AS skills,
    {{'gpa': (CAST(floor(abs(c.c_acctbal)) AS BIGINT) % 401) / 100.0,
      'attendance': CAST((c.c_custkey * 37) % 101 AS BIGINT)}} AS academic,
    COALESCE(pj.projects, []) AS projects
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT o.o_custkey, list_sort(list(DISTINCT {_sql_skill('p.p_type')})) AS skills
             FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
             GROUP BY o.o_custkey) sk ON sk.o_custkey = c.c_custkey
  LEFT JOIN (
    SELECT g.o_custkey, list_sort(list({{'name': g.o_orderpriority, 'year': g.yr,
             'status': CASE WHEN g.all_filled = 1 THEN 'Completed' ELSE 'In Progress' END,
             'technologies': COALESCE(t.tech, []::VARCHAR[])}})) AS projects
    FROM (SELECT o_custkey, o_orderpriority, CAST(MIN(year(o_orderdate)) AS BIGINT) AS yr,
                 MIN(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS all_filled
          FROM orders GROUP BY o_custkey, o_orderpriority) g
    LEFT JOIN (SELECT o.o_custkey, o.o_orderpriority, list_sort(list(DISTINCT {_sql_skill('p.p_type')})) AS tech
               FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
               GROUP BY o.o_custkey, o.o_orderpriority) t
      ON g.o_custkey = t.o_custkey AND g.o_orderpriority = t.o_orderpriority
    GROUP BY g.o_custkey) pj ON pj.o_custkey = c.c_custkey"""
