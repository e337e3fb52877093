"""Landed source files derived from the driver tables.

The multi-source pipelines read CSV files, JSON API pages, HTML pages and
semicolon-separated course files.  Here Spark *writes* those files from the
driver tables (distributed writes, one file per task) into the shared
checkpoint folder, so the readers in ``sources.readers`` are exercised on
real files whose size grows with the tables.  Each landing is written once
per state of the data directory (paths, sizes and times of its files).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, written
from tessera.sources.bronze import bronze_students
from tessera.sources.documents import student_documents
from tessera.sources.domain import Domain
from tessera.sources.tables import _path_exists, read_table

# The header spelling of the landed student CSV (padded and
# mixed case on purpose: S2 normalises it).
CSV_HEADER = {"student_id": " Student_ID ", "name": "Name", "age": "AGE", "gpa": "GPA",
              "attendance": "Attendance ", "city": "City"}


def _state(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the input files' paths, sizes and times; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(sf_dir)
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"),
                    F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("mix")).first()
    return f"{sf_dir}|{row['n']}|{row['size']}|{row['mix']}"


def landing_root(spark: SparkSession, sf_dir: str) -> str:
    base = ensure_checkpoint_dir(spark)
    tag = hashlib.sha1(_state(spark, sf_dir).encode()).hexdigest()[:16]
    return f"{base.rstrip('/')}/landing/{tag}"


def _once(spark: SparkSession, path: str, build) -> str:
    if not _path_exists(spark, f"{path}/_SUCCESS"):
        build(path)
    return path


# ---------------------------------------------------------------- S1: CSV
def students_csv(spark: SparkSession, sf_dir: str) -> str:
    def build(path):
        b = bronze_students(spark, sf_dir)
        out = b.select(*[F.col(k).alias(v) for k, v in CSV_HEADER.items()])
        (out.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))

    return _once(spark, f"{landing_root(spark, sf_dir)}/students_csv", build)


# ---------------------------------------------------------------- S6: API pages
def api_user_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as API users; page = c_custkey div 10 (page size 10)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    k = F.col("c_custkey")
    first = F.concat(F.lit(" "), F.substring_index("c_name", "#", 1))
    last = F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("#"), F.substring_index("c_name", "#", -1), F.lit(" ")))
    addr = F.when(k % 13 == 0, F.lit(None)).otherwise(F.struct(
        F.lit(None).cast("string").alias("address"), F.col("n_name").alias("city"),
        F.lit(None).cast("string").alias("state"), F.lit("X").alias("country")))
    return j.select(
        (k / 10).cast("long").alias("page"), k.alias("id"),
        F.struct(k.alias("id"), first.alias("firstName"), last.alias("lastName"),
                 (F.lit(17) + k % 45).alias("age"),
                 F.when(k % 2 == 0, "male").otherwise("female").alias("gender"),
                 F.concat(F.lit("u"), k.cast("string"), F.lit("@x.org")).alias("email"), addr.alias("address"),
                 F.lit("U").alias("university"), F.lit("student").alias("role")).alias("u"))


def api_pages(spark: SparkSession, sf_dir: str) -> str:
    def build(path):
        users = api_user_frame(spark, sf_dir)
        # at most 10 users per page: the array per group is bounded by the page size
        pages = users.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("id", "u"))).alias("l")).select(
            "page", F.transform("l", lambda x: x["u"]).alias("users"))
        last = pages.agg((F.max("page") + 1).alias("page")).select(
            "page", F.array().cast(pages.schema["users"].dataType).alias("users"))
        pages.unionByName(last).write.mode("overwrite").json(path)

    return _once(spark, f"{landing_root(spark, sf_dir)}/api_pages", build)


# ---------------------------------------------------------------- S4: table extract
def students_extract(spark: SparkSession, sf_dir: str) -> str:
    """The students table as a database hands it out: names in its own case, birth dates as text, of
    which some are absent and some are no dates."""
    def build(path):
        s = Domain(spark, sf_dir).students()
        k = F.col("student_id")
        born = F.when(k % 29 == 3, "31/02/1990").when(k % 37 != 5, F.col("date_of_birth").cast("string"))
        s.select(k.alias("Student_ID"), F.col("full_name").alias("Full_Name"), born.alias("Date_Of_Birth"),
                 F.col("city").alias("City")).write.mode("overwrite").parquet(path)

    return _once(spark, f"{landing_root(spark, sf_dir)}/students_extract", build)


# ---------------------------------------------------------------- S5: document collection
def student_collection(spark: SparkSession, sf_dir: str) -> str:
    """The nested documents, range-partitioned and sorted by city and id."""
    def build(path):
        docs = written(student_documents(spark, sf_dir), "documents")    # the range sort reads its input twice
        docs.orderBy("personal.city", "student_id").write.mode("overwrite").parquet(path)

    return _once(spark, f"{landing_root(spark, sf_dir)}/student_collection", build)


# ---------------------------------------------------------------- S3: JSON arrays
def students_json(spark: SparkSession, sf_dir: str) -> str:
    """Bronze records as JSON arrays of up to 100, one a line, in the order of the records; some elements
    are bare text, and some have a text where the number ``ord`` should be."""
    def build(path):
        b = bronze_students(spark, sf_dir)
        o = F.col("ingest_ord")
        record = F.to_json(F.struct("student_id", "name", "age", "gpa", "attendance", "city", o.alias("ord")))
        wrong = F.to_json(F.struct("name", F.concat(F.lit("no. "), o.cast("string")).alias("ord")))
        element = F.when(o % 41 == 5, F.concat(F.lit('"lost record '), o.cast("string"), F.lit('"'))).when(o % 43 == 7, wrong).otherwise(record)
        arrays = b.select((o / 100).cast("long").alias("part"), o.alias("o"), element.alias("e")).groupBy("part").agg(
            F.array_sort(F.collect_list(F.struct("o", "e"))).alias("l"))     # 100 at most
        line = F.concat(F.lit("["), F.array_join(F.transform("l", lambda x: x["e"]), ", "), F.lit("]"))
        arrays.orderBy("part").select(line).write.mode("overwrite").text(path)

    return _once(spark, f"{landing_root(spark, sf_dir)}/students_json_arrays", build)


# ---------------------------------------------------------------- S7: HTML table pages
def student_pages_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze records, repeated ones included, rendered as HTML table pages of
    10 customers; every 31st customer's rows have only 5 cells (to be skipped
    by the parser)."""
    b = bronze_students(spark, sf_dir)
    k = (F.col("ingest_ord") / 4).cast("long")

    def td(c):
        return F.concat(F.lit("<td>"), F.coalesce(F.col(c), F.lit("")), F.lit("</td>"))

    cells = [td(c) for c in ("student_id", "name", "age", "gpa", "attendance", "city")]
    row = F.concat(F.lit("<tr>"), F.array_join(
        F.when(k % 31 == 0, F.array(*cells[:5])).otherwise(F.array(*cells)), ""), F.lit("</tr>"))
    rows = b.select((k / 10).cast("long").alias("page_id"), k.alias("k"), row.alias("tr"), "ingest_ord")
    pages = rows.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("ingest_ord", "tr"))).alias("l"))
    head = ('<html><body><h1>Students</h1><table id="students"><thead><tr><th>ID</th><th>Name</th>'
            "<th>Age</th><th>GPA</th><th>Attendance</th><th>City</th></tr></thead><tbody>")
    return pages.select("page_id", F.concat(F.lit("https://uni.example/students?page="), F.col("page_id").cast(
        "string")).alias("url"), F.concat(F.lit(head), F.array_join(F.transform("l", lambda x: x["tr"]), ""),
                                          F.lit("</tbody></table></body></html>")).alias("html"))


def student_pages(spark: SparkSession, sf_dir: str) -> str:
    def build(path):
        student_pages_frame(spark, sf_dir).write.mode("overwrite").parquet(path)

    return _once(spark, f"{landing_root(spark, sf_dir)}/student_pages", build)


# ---------------------------------------------------------------- S8: course files
def uci_files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    from tessera.sources.uci import uci_course_frame

    root = landing_root(spark, sf_dir)
    out = {}
    for course in ("mat", "por"):
        def build(path, course=course):
            # range-partitioned sort: part files are in key order, no single task
            (uci_course_frame(spark, sf_dir, course).orderBy("__k").drop("__k")
             .write.mode("overwrite").option("header", True).option("sep", ";").option("quoteAll", True).csv(path))

        out[course] = _once(spark, f"{root}/uci_{course}", build)
    return out
