"""Silver-layer cleaning operators.

Every operator is ``DataFrame -> DataFrame`` and composes with
``DataFrame.transform``.  Global statistics (medians, quantiles, per-source
maxima) are computed as small aggregates and broadcast back as one row or
one row per source; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.numeric import coerce_double, coerce_int, coerce_int_half_even
from tessera.functions.text import strip, title_case
from tessera.operators.quantile import quantiles, wide_quantiles
from tessera.session import ensure_checkpoint_dir

# The record rules of the standard 6-column student record.
REQUIRED_COLUMNS = ("student_id", "name", "age", "gpa", "attendance", "city")
INT_COLUMNS = ("student_id", "age")
FLOAT_COLUMNS = ("gpa", "attendance")
REQUIRED_NON_NULL = ("student_id", "name")
UNIQUE_COLUMNS = ("student_id",)
OUTLIER_RANGES = {"age": (16, 80), "gpa": (0, 4), "attendance": (0, 100)}
TEXT_TO_STRIP = ("name", "city")
TEXT_TO_TITLE = ("city",)
FILL_WITH_MEDIAN = ("age", "gpa", "attendance")
UNKNOWN_CITY = "Unknown"

STANDARD_SCHEMA = T.StructType([
    T.StructField("student_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.LongType()),
    T.StructField("gpa", T.DoubleType()),
    T.StructField("attendance", T.DoubleType()),
    T.StructField("city", T.StringType()),
])


def _numeric(df: DataFrame, col: str) -> bool:
    return col in df.columns and isinstance(df.schema[col].dataType, T.NumericType)


# ---------------------------------------------------------------- C1 / C2 / C3
def convert_types(df: DataFrame, int_rounding: str = "strict") -> DataFrame:
    """Coerce numeric columns; invalid -> NULL.

    ``int_rounding='strict'`` (C1/C3): a non-integral value becomes NULL.
    ``int_rounding='half_even'`` (C2: JSON, SQL sources): round half to even.
    """
    to_int = coerce_int if int_rounding == "strict" else coerce_int_half_even
    cols = {}
    for c in INT_COLUMNS:
        if c in df.columns:
            cols[c] = to_int(F.col(c))
    for c in FLOAT_COLUMNS:
        if c in df.columns:
            cols[c] = coerce_double(F.col(c))
    return df.withColumns(cols)


def coercion_counts(raw: DataFrame, int_rounding: str = "strict") -> DataFrame:
    """C1 report: per column, how many values became NULL by coercion (one pass)."""
    cols = [c for c in INT_COLUMNS + FLOAT_COLUMNS if c in raw.columns]
    both = convert_types(raw.select(*cols, *[F.col(c).alias(f"__r_{c}") for c in cols]), int_rounding)
    return both.agg(*[
        F.count_if(F.col(c).isNull() & F.col(f"__r_{c}").isNotNull()).alias(c) for c in cols
    ])


# ---------------------------------------------------------------- D1 / D2
def keep_first(df: DataFrame, keys=("student_id",), order: str = "ingest_ord") -> DataFrame:
    """One row per key, the first in input order; NULL keys form one group.

    Exact-duplicate removal followed by keep-first on the id keeps exactly
    the same rows as keep-first on the id alone, so one aggregation does
    both.  ``min_by`` over a struct aggregates map-side, so a key holding a
    third of all rows is reduced inside every task before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("__r"))
    return best.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)


def drop_exact_duplicates(df: DataFrame, order: str = "ingest_ord") -> DataFrame:
    """Exact duplicate rows (all columns but the order) removed, first kept."""
    keys = [c for c in df.columns if c != order]
    return df.groupBy(*keys).agg(F.min(order).alias(order)).select(*df.columns)


# ---------------------------------------------------------------- C4 / C5 / C6
def clean_text(df: DataFrame, strip_cols=TEXT_TO_STRIP, title_cols=TEXT_TO_TITLE) -> DataFrame:
    """C4 + C5: strip Unicode whitespace, then title-case the city."""
    cols = {c: strip(c) for c in strip_cols if c in df.columns}
    df = df.withColumns(cols)
    return df.withColumns({c: title_case(c) for c in title_cols if c in df.columns})


# ---------------------------------------------------------------- C7
def null_outliers(df: DataFrame, ranges=None) -> DataFrame:
    """Values outside [lo, hi] become NULL; absent or non-numeric columns are skipped."""
    ranges = OUTLIER_RANGES if ranges is None else ranges
    cols = {c: F.when(F.col(c).between(lo, hi), F.col(c)) for c, (lo, hi) in ranges.items() if _numeric(df, c)}
    return df.withColumns(cols)


# ---------------------------------------------------------------- C8 / C9
def fill_missing(df: DataFrame, drop_null_name: bool = True, fill_city: bool = True,
                 median_cols=FILL_WITH_MEDIAN) -> DataFrame:
    """Drop rows without a name; missing city -> 'Unknown'; median fill.

    Medians are exact, taken after the name drop, over the whole table; an
    all-NULL column is left as is.  Integer columns take the median rounded
    half to even (pandas refuses a fractional fill for Int64).
    """
    if df.isStreaming:
        raise TypeError("fill_missing needs whole-table medians; run it on a batch DataFrame")
    if drop_null_name and "name" in df.columns:
        df = df.where(F.col("name").isNotNull())
    if fill_city and "city" in df.columns:
        df = df.withColumn("city", F.coalesce(F.col("city"), F.lit(UNKNOWN_CITY)))
    cols = [c for c in median_cols if _numeric(df, c)]
    if not cols:
        return df
    # the medians and the fill both read this frame: cut the lineage once so
    # dedup/cleaning upstream is not recomputed (reliable checkpoint dir)
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    meds = wide_quantiles(df, cols, 0.5, "__med_")
    out = df.crossJoin(F.broadcast(meds))  # one row
    fills = {}
    for c in cols:
        m = F.col(f"__med_{c}")
        if isinstance(df.schema[c].dataType, T.IntegralType):
            m = F.rint(m).cast(df.schema[c].dataType)
        fills[c] = F.coalesce(F.col(c), m)
    return out.withColumns(fills).select(*df.columns)


# ---------------------------------------------------------------- C17
def clean_data(df: DataFrame, order: str = "ingest_ord") -> DataFrame:
    """C17: dedup -> text -> outliers -> fill (the input frame is untouched)."""
    return (
        df.transform(lambda d: keep_first(d, ("student_id",), order) if "student_id" in d.columns else d)
        .transform(clean_text)
        .transform(null_outliers)
        .transform(fill_missing)
    )


# ---------------------------------------------------------------- C10
def clip_upper_quantile(df: DataFrame, col: str, q: float = 0.99) -> DataFrame:
    """Clip a column at its exact q-quantile over the whole table
    (linear interpolation); adds ``<col>_clipped`` flags for counting."""
    cap = quantiles(df, col, {"__cap": q})
    out = df.crossJoin(F.broadcast(cap))
    # clipping at a fractional bound yields a DOUBLE column (as pandas does)
    return out.withColumns({
        f"{col}_clipped": F.col(col) > F.col("__cap"),
        col: F.when(F.col(col) > F.col("__cap"), F.col("__cap")).otherwise(F.col(col).cast("double")),
    }).drop("__cap")


# ---------------------------------------------------------------- C11 / C12
def age_from_dob(dob: Column, as_of) -> Column:
    """C11: whole years from a date of birth, ``rint(days / 365.25)``; ``as_of``
    is a parameter (a date string or Column) so reruns are reproducible."""
    ref = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return F.rint(F.datediff(ref, dob.try_cast("date")) / F.lit(365.25)).cast("bigint")


def require_dob(df: DataFrame, col: str = "date_of_birth", id_col: str = "student_id") -> DataFrame:
    """``col`` as a date; a row whose value is absent or no date fails the job that reads it,
    with an error that names the row.  Nothing is read when this is called."""
    bad = F.raise_error(F.concat(F.lit(f"{col} of {id_col} "), F.coalesce(F.col(id_col).cast("string"), F.lit("NULL")), F.lit(" is no date: "),
                                 F.coalesce(F.col(col).cast("string"), F.lit("NULL"))))
    return df.withColumn(col, F.coalesce(F.col(col).try_cast("date"), bad.cast("date")))


def invalid_dob_rows(df: DataFrame, col: str = "date_of_birth") -> DataFrame:
    """Rows whose date of birth is absent or not a date."""
    return df.where(F.col(col).try_cast("date").isNull())


# ---------------------------------------------------------------- C13 / C14 / C16
def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename to the standard names (absent keys ignored)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def standardize(df: DataFrame, schema: T.StructType = STANDARD_SCHEMA) -> DataFrame:
    """C14: add missing columns as typed NULLs and select in the fixed order."""
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def select_existing(df: DataFrame, cols) -> DataFrame:
    """Select only the listed columns that exist."""
    return df.select(*[c for c in cols if c in df.columns])


# ---------------------------------------------------------------- C15
def api_user_mapping(users: DataFrame) -> DataFrame:
    """Page-envelope users -> standard record: name = trim(first)+' '+trim(last)
    with NULL parts as '', trimmed; city from the nested address; no gpa/attendance."""
    first = F.coalesce(strip(F.col("firstName")), F.lit(""))
    last = F.coalesce(strip(F.col("lastName")), F.lit(""))
    return users.select(
        F.col("id").cast("bigint").alias("student_id"),
        strip(F.concat(first, F.lit(" "), last)).alias("name"),
        F.col("age").cast("bigint").alias("age"),
        F.lit(None).cast("double").alias("gpa"),
        F.lit(None).cast("double").alias("attendance"),
        F.col("address.city").alias("city"),
    )


# ---------------------------------------------------------------- C18
def recode(c, mapping: dict) -> Column:
    """Dictionary recode; unknown values -> NULL."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(_col(c) == k, v) if expr is None else expr.when(_col(c) == k, v)
    return expr


def _col(c):
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- C20 / C21
def attendance_to_rate(df: DataFrame, source_col: str = "source", col: str = "attendance") -> DataFrame:
    """C20: per-source scale detection, one job for all sources.

    max in (1.1, 100] -> the source is on 0-100: divide by 100, then clip to
    [0, 1]; max <= 1.1 or all NULL -> keep and clip; max > 100 -> error row
    (``scale_error`` is true; the caller raises).
    """
    mx = df.groupBy(source_col).agg(F.max(col).alias("__mx"))
    j = df.join(F.broadcast(mx), source_col, "left")  # one row per source
    m = F.col("__mx")
    scaled = F.when((m > 1.1) & (m <= 100), F.col(col) / 100.0).otherwise(F.col(col))
    rate = F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0))
    return j.withColumn("attendance_rate", F.when(F.col(col).isNotNull(), rate)).withColumn(
        "scale_error", F.coalesce(m > 100, F.lit(False))).drop("__mx")


def record_ids(df: DataFrame, source: str, order_col: str, fmt: str = "R-{src}-%04d") -> DataFrame:
    """Consecutive source-prefixed ids in input order (distributed index)."""
    from tessera.operators.sequence import row_index

    out = row_index(df, [order_col], "__idx", start=0)
    return out.withColumn("record_id", F.format_string(fmt.replace("{src}", source), F.col("__idx"))).drop("__idx")
