"""Pipelines users call (P1-P6): compositions of the operators with actions
only at the edges (writes, validations, status counts).

Each base source follows its own cleaning recipe (P2) and returns the 6
standard columns plus ``ingest_ord``; ``run_all`` evaluates every source in
isolation and records failures instead of raising (P3); ``run_merge`` builds
the silver table (P4) of all of them, and raises if one failed; ``course_etl`` is P5; ``export_report`` is P6.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import documents as D
from tessera.operators import quality as Q
from tessera.operators import silver as SV
from tessera.sinks import writers as W
from tessera.sources import landing as L
from tessera.sources import readers as R
from tessera.session import written
from tessera.sources.documents import read_collection

# Reference date for ages derived from a date of birth.
AS_OF = "2026-10-10"
SOURCES_AT_ONCE = 3
SOURCES = ("csv", "sqlite", "postgres", "mongodb", "json", "api", "scraper")
JSON_SCHEMA = "student_id string, name string, age string, gpa string, attendance string, city string, ord long"
STANDARD = {"student_id": "bigint", "name": "string", "age": "bigint", "gpa": "double", "attendance": "double", "city": "string"}


# ---------------------------------------------------------------- P2: per-source recipes
# Each recipe gives all of a source's standard rows; ``run_source`` keeps the first row of each id.
def csv_source(dom) -> DataFrame:
    """CSV: lower headers, strict coercion, outliers, median fill."""
    df = R.normalize_headers(R.read_csv(dom.spark, L.students_csv(dom.spark, dom.dir), all_strings=True))
    df = C.convert_types(df).transform(C.null_outliers)
    return C.fill_missing(df, drop_null_name=False, fill_city=False)


def api_source(dom) -> DataFrame:
    """API: landed pages -> users -> standard record."""
    users = R.read_api_pages(dom.spark, L.api_pages(dom.spark, dom.dir))
    return C.api_user_mapping(users).withColumn("ingest_ord", F.col("student_id"))


def scraper_source(dom) -> DataFrame:
    """Scraper: HTML table rows (already typed), outliers."""
    pages = dom.spark.read.parquet(L.student_pages(dom.spark, dom.dir))
    return R.require_rows(R.parse_table_rows(pages), "students table").transform(C.null_outliers)


def mongodb_source(dom) -> DataFrame:
    """Document collection: flatten, rename nested paths (C13), coerce, outliers."""
    flat = D.flatten(read_collection(dom.spark, L.student_collection(dom.spark, dom.dir)))
    std = C.rename_columns(flat, {"personal.name": "name", "personal.age": "age", "personal.city": "city",
                                  "academic.gpa": "gpa", "academic.attendance": "attendance"})
    std = C.convert_types(std.select("student_id", "name", "age", "gpa", "attendance", "city")).transform(
        C.null_outliers)
    return std.withColumn("ingest_ord", F.col("student_id"))


def sqlite_source(dom) -> DataFrame:
    """Relational table: rename, age from date of birth (C11, half-even), outliers, keep-first."""
    s = C.require_dob(dom.students())
    std = C.rename_columns(s, {"full_name": "name"}).select(
        "student_id", "name", C.age_from_dob(F.col("date_of_birth"), AS_OF).alias("age"),
        F.lit(None).cast("double").alias("gpa"), F.lit(None).cast("double").alias("attendance"), "city")
    std = C.convert_types(std, int_rounding="half_even").transform(C.null_outliers)
    return std.withColumn("ingest_ord", F.col("student_id"))


def postgres_source(dom) -> DataFrame:
    """Extracted database table: lower headers, rename, age from a date of birth in text (no date: no age), outliers."""
    s = R.normalize_headers(R.read_relational(dom.spark, "students", path=L.students_extract(dom.spark, dom.dir)))
    born = F.col("date_of_birth").try_cast("date")
    std = C.rename_columns(s, {"full_name": "name"}).select(
        "student_id", "name", C.age_from_dob(born, AS_OF).alias("age"),
        F.lit(None).cast("double").alias("gpa"), F.lit(None).cast("double").alias("attendance"), "city")
    std = C.convert_types(std, int_rounding="half_even").transform(C.null_outliers)
    return std.withColumn("ingest_ord", F.col("student_id"))


def json_source(dom) -> DataFrame:
    """JSON arrays: good elements, coerced with half-even rounding (C2), outliers; bad ones are
    counted by S3_json_bad_elements."""
    good, _ = R.read_json_arrays(dom.spark, L.students_json(dom.spark, dom.dir), JSON_SCHEMA)
    return C.convert_types(good, int_rounding="half_even").transform(C.null_outliers).select(*STANDARD, "ingest_ord")


RECIPES = {"csv": csv_source, "api": api_source, "scraper": scraper_source, "mongodb": mongodb_source,
           "sqlite": sqlite_source, "postgres": postgres_source, "json": json_source}


@dataclass
class SourceResult:
    source: str
    status: str
    rows_in: int = 0
    rows_invalid: int = 0
    rows: int = 0
    failed_rules: str | None = None
    path: str | None = None
    error: str | None = None
    frame: DataFrame | None = field(default=None, repr=False)


def run_source(dom, name: str) -> SourceResult:
    """Extract -> transform -> validate -> load; errors are captured in the result.

    The rules of the source (Q3) are counted in the pass that counts its rows.  Rows without an id can't enter
    silver: they are written to ``invalid_path`` and counted, and the rest of the source flows on:
    the first row of each id is loaded into the source's partition of ``clean_path``,
    which is all that a rerun of this source replaces."""
    try:
        # written once in the shared folder: the counts, the load and the merge
        # then read the columns they need instead of re-running the recipe
        std = written(RECIPES[name](dom), f"source-{name}")
        named = F.col("student_id").isNotNull()
        rules = Q.source_rules(name, std)
        n = std.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(~named).alias("invalid"),
                    *[F.count_if(r.failed()).alias(f"r{i}") for i, r in enumerate(rules)]).first()
        if n["invalid"]:
            W.write_parquet(std.where(~named), invalid_path(dom, name))
        df = written(C.keep_first(std.where(named)), f"kept-{name}")
        kept = df.count()
        if kept == 0:
            raise ValueError("no rows")
        report = Q.source_report(name, n["rows_in"], n["invalid"], kept, {r.name: n[f"r{i}"] for i, r in enumerate(rules)})
        failed = "; ".join(f"{rule}: {count}" for rule, count in sorted(report.items()) if count)
        W.write_source_partition(df.select(*[F.col(c).cast(t) for c, t in STANDARD.items()]), clean_path(dom), name)
        return SourceResult(name, "OK", n["rows_in"], n["invalid"], kept, failed or None, f"clean/source={name}", None, df)
    except Exception as e:  # noqa: BLE001  (the contract is to report, not raise)
        return SourceResult(name, "FAILED", error=f"{type(e).__name__}: {e}")


def clean_path(dom) -> str:
    """Where the sources are loaded, one partition each."""
    return f"{L.landing_root(dom.spark, dom.dir)}/clean"


def invalid_path(dom, name: str) -> str:
    """Where a source's rows without an id are written."""
    return f"{L.landing_root(dom.spark, dom.dir)}/invalid/{name}"


def run_all(dom, sources=SOURCES) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Every source in isolation; a status table (paths relative to the landing folder) and the good frames.

    A source has many short stages, which leave cores idle, so ``SOURCES_AT_ONCE`` of them run side by side; each
    has its own landed files, tables and partition."""
    with ThreadPoolExecutor(SOURCES_AT_ONCE) as pool:
        # wrapped anew for each source: the wrapper holds the thread's own local properties
        runs = [pool.submit(inheritable_thread_target(dom.spark)(run_source), dom, s) for s in sources]
    results = [r.result() for r in runs]
    status = dom.spark.createDataFrame(
        [(r.source, r.status, r.rows_in, r.rows_invalid, r.rows, r.failed_rules, r.path, r.error) for r in results],
        "source string, status string, rows_in long, rows_invalid long, rows long, failed_rules string, path string, error string")
    return status, {r.source: r.frame for r in results if r.frame is not None}


def all_frames(dom) -> dict[str, DataFrame]:
    """The frames of every source, for what is made of all of them: a source that failed raises here,
    since a result without its rows would look like a whole one."""
    status, frames = run_all(dom)
    failed = status.where("status <> 'OK'").collect()
    if failed:
        raise RuntimeError("sources failed: " + "; ".join(f"{r.source}: {r.error}" for r in failed))
    return frames


def run_merge(dom, out_dir: str | None = None, include_uci: bool = True) -> DataFrame:
    """UCI rows + base sources -> verified 17-column silver table,
    optionally written as Parquet partitioned by source.  A source that failed raises."""
    from tessera.plans.corpus_sources import course_etl

    frames = all_frames(dom)
    uci = course_etl(dom) if include_uci else None
    merged = written(SV.merge(uci, frames), "silver")  # verified and returned from one table
    Q.raise_if_invalid(SV.verify(merged))
    if out_dir:
        W.write_parquet(merged, out_dir, partition_by=["source"])
        return dom.spark.read.parquet(out_dir)
    return merged


# ---------------------------------------------------------------- P1
def single_source_pipeline(dom, out_dir: str, verify: bool = True) -> DataFrame:
    """Scan -> schema -> types -> clean -> validate -> save -> report.

    Returns one result row (rows in/out, validation verdict, error text);
    the cleaned frame is checkpointed once and reused by every step."""
    raw = R.normalize_headers(R.read_csv(dom.spark, L.students_csv(dom.spark, dom.dir), all_strings=True))
    Q.validate_schema(raw)
    clean = C.clean_data(C.convert_types(raw)).checkpoint(eager=True)
    rep = Q.validate_data(clean)
    errors = [f"{r.rule}: {r.failed_count}" for r in rep.where(F.col("failed_count") > 0).collect()]
    n_out = W.write_csv(clean.drop("ingest_ord"), f"{out_dir}/clean_csv", verify=verify)
    W.write_report(Q.quality_report(clean.drop("ingest_ord")), f"{out_dir}/quality_report")
    n_in = raw.count()
    return dom.spark.createDataFrame(
        [(n_in, n_out, "valid" if not errors else "invalid", "; ".join(errors) or None)],
        "rows_in long, rows_out long, validation string, errors string")


# ---------------------------------------------------------------- P6
REPORT_REQUIRED = ("student_id", "student_name", "average_score")


def validate_report(df: DataFrame) -> None:
    """Q17: required columns, non-empty, average score within [0, 100]."""
    missing = [c for c in REPORT_REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"report misses columns {missing}")
    bad = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(~F.coalesce(F.col("average_score").between(0, 100), F.lit(True))).alias("bad")).first()
    if bad["n"] == 0:
        raise ValueError("report is empty")
    if bad["bad"]:
        raise ValueError(f"{bad['bad']} average scores outside [0, 100]")


def export_report(dom, out_path: str) -> DataFrame:
    """Feature table (A11) -> checks (Q17) -> CSV (K1, verified)."""
    from tessera.plans.corpus_relational import a11_ml_feature_table

    rep = a11_ml_feature_table(dom)
    validate_report(rep)
    W.write_csv(rep, out_path, verify=True)
    return dom.spark.read.option("header", True).schema(rep.schema).csv(out_path)


# ---------------------------------------------------------------- N16
def collection_pipeline(dom, out_dir: str) -> DataFrame:
    """Extract -> flatten -> features -> validate -> save -> aggregate.
    Invalid documents are written aside; the result is the per-city summary."""
    docs = D.validate_documents(read_collection(dom.spark, L.student_collection(dom.spark, dom.dir)))
    feats = D.add_features(D.flatten(docs.where("is_valid").drop("violations", "is_valid")))
    W.write_parquet(feats, f"{out_dir}/documents_features")
    invalid = docs.where(~F.col("is_valid"))
    if not invalid.isEmpty():
        W.write_parquet(invalid, f"{out_dir}/documents_invalid")
    saved = dom.spark.read.parquet(f"{out_dir}/documents_features")
    return saved.groupBy(F.col("`personal.city`").alias("city")).agg(
        F.count(F.lit(1)).alias("students"), F.round(F.avg("`academic.gpa`"), 6).alias("average_gpa"),
        F.sum(F.col("skill_python").cast("int")).alias("python_students"),
        F.sum("project_count").alias("projects"))
