"""File and table sources (S1-S8, S12, S13) as distributed readers.

Every reader takes an explicit schema (no inference pass over the data),
fails fast on malformed input where the reference raises, and records the
input order as ``ingest_ord`` (file order, then position inside the file)
before any shuffle, so "keep first" and "first seen" stay deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.numeric import coerce_double, truncate_int
from tessera.functions.text import blank_to_null, collapse_spaces, strip, title_case
from tessera.sources.tables import _path_exists


def ingest_order(df: DataFrame) -> Column:
    """Input position: (file path, block start, row id inside the split).

    ``monotonically_increasing_id`` increases along a split; the file path and
    block offset order the splits, whatever partition they were packed into.
    The number of a part file counts as a number: part-100000 comes after part-99999."""
    path, part = F.col("_metadata.file_path"), r"^(.*/part-)(\d+)([^/]*)$"
    number = F.regexp_extract(path, part, 2)
    padded = F.concat(F.regexp_extract(path, part, 1), F.lpad(number, 20, "0"), F.regexp_extract(path, part, 3))
    return F.struct(F.when(number == "", path).otherwise(padded).alias("f"), F.col("_metadata.file_block_start").alias("b"),
                    F.monotonically_increasing_id().alias("i"))


# ---------------------------------------------------------------- S1 / S2
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",",
             header: bool = True, encoding: str = "UTF-8", all_strings: bool = False) -> DataFrame:
    """CSV with pre-flight checks: a missing path raises; malformed rows
    fail the job (FAILFAST); an empty result raises."""
    if not _path_exists(spark, path):
        raise FileNotFoundError(path)
    r = spark.read.option("header", header).option("sep", sep).option("quote", '"').option(
        "mode", "FAILFAST").option("encoding", encoding)
    if schema is not None:
        r = r.schema(schema)
    elif all_strings:
        # header only: every column as string, no inference pass
        names = spark.read.option("header", True).option("sep", sep).csv(path).columns
        r = r.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    df = r.csv(path)
    df = df.withColumn("ingest_ord", ingest_order(df))
    if df.isEmpty():
        raise ValueError(f"{path}: no data rows")
    return df


def normalize_headers(df: DataFrame) -> DataFrame:
    """Header names stripped and lower-cased."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


# ---------------------------------------------------------------- S3 / S5
def read_json(spark: SparkSession, path: str, schema: T.StructType | str, multiline_array: bool = False) -> DataFrame:
    """JSON lines (the scalable layout) or one JSON array per file
    (``multiline_array``; each element is a row).  Nested objects stay
    structs; flatten with ``operators.documents.flatten``."""
    if not _path_exists(spark, path):
        raise FileNotFoundError(path)
    df = spark.read.schema(schema).option("multiLine", multiline_array).option("mode", "FAILFAST").json(path)
    return df.withColumn("ingest_ord", ingest_order(df))


def read_json_arrays(spark: SparkSession, path: str, schema: str, whole_files: bool = False) -> tuple[DataFrame, DataFrame]:
    """S3: (records, bad elements) of JSON arrays, one array per line, or one per file (``whole_files``).

    Each array is cut into the text of its elements, and each element is parsed on its own, so
    one that is no object or breaks a type of ``schema`` costs no other: it comes back as
    (element, ingest_ord) in the second frame.  A line that is no array is one bad element."""
    if not _path_exists(spark, path):
        raise FileNotFoundError(path)
    lines = spark.read.text(path, wholetext=whole_files)
    lines = lines.withColumn("ord", ingest_order(lines)).where(F.length(F.trim("value")) > 0)
    cut = F.coalesce(F.from_json("value", "array<string>", {"mode": "PERMISSIVE"}), F.array("value"))
    elements = lines.select("ord", F.posexplode(cut).alias("pos", "element"))
    corrupt = "__corrupt"
    parsed = F.from_json("element", f"{schema}, {corrupt} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    rows = elements.select("element", F.struct("ord.f", "ord.b", "ord.i", F.col("pos").alias("p")).alias("ingest_ord"), parsed.alias("r"))
    bad = F.col("r").isNull() | F.col(f"r.{corrupt}").isNotNull()
    return (rows.where(~bad).select("r.*", "ingest_ord").drop(corrupt), rows.where(bad).select("element", "ingest_ord"))


# ---------------------------------------------------------------- S4
def read_relational(spark: SparkSession, table: str, path: str | None = None, jdbc: dict | None = None,
                    partition_column: str | None = None, num_partitions: int = 64) -> DataFrame:
    """A relational table: a catalog table, a Parquet extract, or JDBC
    partitioned on a numeric key (the JDBC driver jar must be on the
    classpath).  A missing table raises."""
    if jdbc:
        r = spark.read.format("jdbc").options(**jdbc).option("dbtable", table)
        if partition_column:
            b = spark.read.format("jdbc").options(**jdbc).option(
                "query", f"SELECT MIN({partition_column}) lo, MAX({partition_column}) hi FROM {table}").load().first()
            r = r.option("partitionColumn", partition_column).option("lowerBound", b["lo"]).option(
                "upperBound", b["hi"]).option("numPartitions", num_partitions)
        return r.load()
    if path is not None:
        if not _path_exists(spark, path):
            raise FileNotFoundError(f"table {table!r} not found at {path}")
        return spark.read.parquet(path)
    if not spark.catalog.tableExists(table):
        raise LookupError(f"table {table!r} does not exist")
    return spark.table(table)


# ---------------------------------------------------------------- S6
USER_SCHEMA = ("id long, firstName string, lastName string, age long, gender string, email string, "
               "address struct<address:string, city:string, state:string, country:string>, "
               "university string, role string")
PAGE_SCHEMA = f"page long, users array<struct<{USER_SCHEMA.replace(' long', ':long').replace(' string', ':string')}>>"


def api_users(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Landed API page envelopes -> user records in page order.

    Pages are read until the first empty page (as the paging client stops
    there), optionally only the first ``max_pages``; users keep their
    position inside the page.  The stop page is a one-row aggregate."""
    stop = pages.agg(F.min(F.when(F.size("users") == 0, F.col("page"))).alias("__stop"))
    p = pages.crossJoin(F.broadcast(stop)).where(F.col("__stop").isNull() | (F.col("page") < F.col("__stop")))
    if max_pages is not None:
        first = pages.agg(F.min("page").alias("__first"))
        p = p.crossJoin(F.broadcast(first)).where(F.col("page") < F.col("__first") + max_pages)
    return p.select("page", F.posexplode("users").alias("pos", "u")).select(
        F.struct("page", "pos").alias("ingest_ord"), "u.*")


def read_api_pages(spark: SparkSession, path: str, cache_path: str | None = None,
                   max_pages: int | None = None) -> DataFrame:
    """S6 with the cache fallback: no landed pages -> the cached payload;
    no cache either -> error."""
    for p in (path, cache_path):
        if p and _path_exists(spark, p):
            pages = spark.read.schema(PAGE_SCHEMA).json(p)
            if not pages.isEmpty():
                return api_users(pages, max_pages)
    raise FileNotFoundError(f"no API pages under {path} and no cache at {cache_path}")


# ---------------------------------------------------------------- S7
def _table_body(html: Column, table_id: str) -> Column:
    return F.regexp_extract(html, rf'(?is)<table[^>]*id="{table_id}"[^>]*>(.*?)</table>', 1)


def parse_table_rows(pages: DataFrame, table_id: str = "students", min_cells: int = 6) -> DataFrame:
    """HTML table rows -> positional records, per page, in page order.

    Rows come from ``<tbody>``'s ``<tr>``; cells from ``<td>``; rows with fewer
    than ``min_cells`` cells are skipped; cell text is tag-stripped,
    whitespace-trimmed (blank -> NULL); integers are ``int(float(x))``
    (truncated), bad numbers NULL.  Regex extraction runs inside the JVM on
    every page in parallel."""
    body = F.regexp_extract(_table_body(F.col("html"), table_id), r"(?is)<tbody[^>]*>(.*?)</tbody>", 1)
    rows = pages.select("page_id", F.posexplode(
        F.regexp_extract_all(body, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row_pos", "tr"))
    cells = rows.withColumn("cells", F.transform(
        F.regexp_extract_all("tr", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1)),
        lambda c: blank_to_null(F.regexp_replace(c, "<[^>]+>", ""))))
    ok = cells.where(F.size("cells") >= min_cells)
    c = F.col("cells")
    return ok.select(
        F.struct("page_id", "row_pos").alias("ingest_ord"),
        truncate_int(c[0]).alias("student_id"),
        collapse_spaces(strip(c[1])).alias("name"),
        truncate_int(c[2]).alias("age"),
        coerce_double(c[3]).alias("gpa"),
        coerce_double(c[4]).alias("attendance"),
        title_case(c[5]).alias("city"),
    )


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when a source produced no rows (e.g. the table id matched nothing)."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows matched")
    return df


def page_links(pages: DataFrame) -> DataFrame:
    """S7 on free web pages: navigation links (position, href, text) per page."""
    pat = r'<li><a href="([^"]*)">([^<]*)</a></li>'
    hrefs = F.regexp_extract_all("html", F.lit(pat), F.lit(1))
    texts = F.regexp_extract_all("html", F.lit(pat), F.lit(2))
    z = pages.select("page_id", F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("text"))).alias(
        "position", "l"))
    return z.select("page_id", "position", F.col("l.href").alias("href"), F.col("l.text").alias("text"))


def page_titles(pages: DataFrame) -> DataFrame:
    """S7 on free web pages: language and title per page."""
    return pages.select("page_id", F.regexp_extract("html", r'<html lang="([^"]*)"', 1).alias("lang"),
                        F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"))


# ---------------------------------------------------------------- S12 / U2
def union_optional(frames: dict[str, DataFrame | None]) -> DataFrame:
    """S12 + U2: union of the sources that are present (absent ones skipped);
    no source at all is an error.  Columns are aligned by name."""
    present = [(n, f) for n, f in frames.items() if f is not None]
    if not present:
        raise FileNotFoundError("no source is available")
    out = present[0][1]
    for _, f in present[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
