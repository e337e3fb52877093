"""Silver merge: many sources -> one 17-column table.

All base sources are unioned first (tagged by ``source``), so per-source
steps -- attendance scale detection, source-prefixed record ids -- are one
job for every source together: a ``groupBy(source)`` maximum broadcast back
(one row per source) and a per-source index from the ordered engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.clean import attendance_to_rate
from tessera.operators.quality import Rule, evaluate
from tessera.operators.sequence import sequence

# The unified silver record and its rules.
UNIFIED_SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("student_id", T.StringType()),
    T.StructField("course", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("age", T.LongType()), T.StructField("gender", T.StringType()),
    T.StructField("city", T.StringType()), T.StructField("gpa", T.DoubleType()),
    T.StructField("attendance_rate", T.DoubleType()), T.StructField("n_assessments", T.LongType()),
    T.StructField("score_change", T.LongType()), T.StructField("score_1", T.LongType()),
    T.StructField("score_2", T.LongType()), T.StructField("score_final", T.LongType()),
    T.StructField("school", T.StringType()), T.StructField("address", T.StringType()),
    T.StructField("source", T.StringType()),
])
UNIFIED_COLUMNS = [f.name for f in UNIFIED_SCHEMA.fields]
NON_NULL_COLUMNS = ("record_id", "student_id", "source")
BASE_SOURCES = ("csv", "json", "mongodb", "postgres", "sqlite", "api", "scraper")


def tag_sources(frames: dict[str, DataFrame], order_col: str = "ingest_ord") -> DataFrame:
    """Base sources (6 standard columns + their input order) as one
    tagged frame; the order becomes text keys ``__o0, __o1, ...`` that sort
    like the original (numbers zero-padded), so every source can share them."""
    out = None
    for name, df in frames.items():
        part = df.select(F.lit(name).alias("source"), F.col("student_id").cast("string").alias("student_id"),
                         F.col("name").cast("string").alias("name"), F.col("age").try_cast("bigint").alias("age"),
                         F.col("city").cast("string").alias("city"), F.col("gpa").try_cast("double").alias("gpa"),
                         F.col("attendance").try_cast("double").alias("attendance"),
                         *[c.alias(f"__o{i}") for i, c in enumerate(_order_fields(df, order_col))])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _sortable(c, dt):
    if isinstance(dt, T.IntegralType):
        return F.lpad(c.cast("string"), 20, "0")
    return c.cast("string")


def _order_fields(df: DataFrame, order_col: str) -> list:
    dt = df.schema[order_col].dataType
    if isinstance(dt, T.StructType):
        return [_sortable(F.col(order_col)[f.name], f.dataType) for f in dt.fields]
    return [_sortable(F.col(order_col), dt)]


def base_to_unified(tagged: DataFrame) -> DataFrame:
    """C20 + C21: per-source attendance scale and ``R-<source>-%04d`` ids."""
    okeys = sorted(c for c in tagged.columns if c.startswith("__o"))
    rated = attendance_to_rate(tagged, "source", "attendance")
    bad = rated.where("scale_error").select("source").distinct().collect()  # <= #sources rows
    if bad:
        raise ValueError(f"attendance outside 0-1 and 0-100 scales for: {[r.source for r in bad]}")
    idx = sequence(rated, okeys, ["source"], row_number="__i")
    return idx.select(
        F.format_string("R-%s-%04d", F.col("source"), F.col("__i") - 1).alias("record_id"),
        "student_id", F.lit(None).cast("string").alias("course"), "name", "age",
        F.lit(None).cast("string").alias("gender"), "city", "gpa", "attendance_rate",
        *[F.lit(None).cast("bigint").alias(c) for c in ("n_assessments", "score_change", "score_1", "score_2",
                                                         "score_final")],
        F.lit(None).cast("string").alias("school"), F.lit(None).cast("string").alias("address"), "source")


def merge(uci: DataFrame | None, base_frames: dict[str, DataFrame], order_col: str = "ingest_ord") -> DataFrame:
    """P4 core: optional UCI rows + base sources -> unified silver rows."""
    parts = []
    if uci is not None:
        parts.append(uci.select(*[F.col(f.name).cast(f.dataType) for f in UNIFIED_SCHEMA.fields]))
    if base_frames:
        parts.append(base_to_unified(tag_sources(base_frames, order_col)))
    if not parts:
        raise FileNotFoundError("no source available for the silver merge")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verify(df: DataFrame) -> DataFrame:
    """Q5: column contract (no job), then one pass: mandatory non-nulls,
    unique record ids, source domain, ranges where present."""
    if df.columns != UNIFIED_COLUMNS:
        raise ValueError(f"column mismatch: {df.columns}")
    rules = [Rule(f"not_null:{c}", c, F.col(c).isNotNull(), nulls_fail=True) for c in NON_NULL_COLUMNS]
    rules += [Rule("domain:source", "source", F.col("source").isin(*BASE_SOURCES, "uci"), nulls_fail=True),
              Rule("range:gpa", "gpa", F.col("gpa").between(0.0, 4.0)),
              Rule("range:attendance_rate", "attendance_rate", F.col("attendance_rate").between(0.0, 1.0))]
    rep = evaluate(df, rules)
    dup = df.agg((F.count(F.lit(1)) - F.count_distinct("record_id")).alias("failed_count")).select(
        F.lit("unique:record_id").alias("rule"), F.lit("record_id").alias("column_name"), "failed_count")
    return rep.select("rule", "column_name", "failed_count").unionByName(dup)


def report(df: DataFrame) -> DataFrame:
    """Q8: per source rows / gpa filled / attendance filled, and per column
    coverage (non-null fraction, 4 places) -- two small aggregates."""
    per = df.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count("gpa").alias("gpa_filled"),
                                   F.count("attendance_rate").alias("attendance_filled"))
    cov = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', CAST(`{c}` AS BIGINT)" for c in df.columns)
    cov = cov.selectExpr(f"stack({len(df.columns)}, {stack}) AS (column_name, non_null)", "__n").select(
        "column_name", F.when(F.col("__n") > 0, F.round(F.col("non_null") / F.col("__n"), 4)).otherwise(
            F.lit(0.0)).alias("coverage"))
    return per.select(F.lit("source").alias("kind"), F.col("source").alias("name"), "rows", "gpa_filled",
                      "attendance_filled", F.lit(None).cast("double").alias("coverage")).unionByName(
        cov.select(F.lit("column").alias("kind"), F.col("column_name").alias("name"),
                   *[F.lit(None).cast("bigint").alias(c) for c in ("rows", "gpa_filled", "attendance_filled")],
                   "coverage"))


def compare_sources(tagged: DataFrame, expected) -> DataFrame:
    """Q9: one row per expected source: OK/MISSING, rows, columns, missing
    cells, unique ids (a groupBy over the tagged union, left-joined from the
    list of expected sources)."""
    cols = [c for c in ("student_id", "name", "age", "gpa", "attendance", "city") if c in tagged.columns]
    missing = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    per = tagged.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum(missing).alias("missing_cells"),
                                       F.count_distinct("student_id").alias("unique_ids"))
    exp = tagged.sparkSession.createDataFrame([(s,) for s in expected], "source string")
    j = exp.join(per, "source", "left")
    return j.select("source", F.when(F.col("rows").isNull(), "MISSING").otherwise("OK").alias("status"),
                    F.coalesce("rows", F.lit(0)).alias("rows"),
                    F.when(F.col("rows").isNull(), 0).otherwise(len(cols)).alias("columns"),
                    F.coalesce("missing_cells", F.lit(0)).cast("bigint").alias("missing_cells"),
                    F.coalesce("unique_ids", F.lit(0)).alias("unique_ids"))
