"""Exact quantiles (median, p99 ...) per group, without gathering values.

``percentile``/``median`` keep every distinct value of a group in one
aggregation buffer, and ``percentile_approx`` is not exact.  Here:

1. a partial aggregation turns the column into a histogram (value, count);
   the histogram is never larger than the data and usually far smaller;
2. the ordered-analytics engine gives each histogram row its running count
   within the group (range-bucketed, so one huge group is spread out);
3. the two order statistics around ``q * (n - 1)`` are picked by a filter
   and combined by linear interpolation, the definition used by NumPy,
   pandas and Spark's ``percentile`` (and DuckDB's ``quantile_cont``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.sequence import sequence


def quantiles_long(df: DataFrame, cols, qs, by=()) -> DataFrame:
    """Quantiles of several columns in one pass, long format:
    (by..., column_name, <one column per requested quantile>).

    Columns are stacked into (column_name, value) before the histogram, so
    one ordered pass serves every column.  Groups whose values are all NULL
    give no row here; ``quantiles`` adds them back.
    """
    by = [by] if isinstance(by, str) else list(by)
    cols = [cols] if isinstance(cols, str) else list(cols)
    pairs = F.array(*[
        F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in cols
    ])
    long = df.select(*by, F.inline(pairs)).select(*by, F.col("k").alias("column_name"), F.col("v").alias("__v"))
    keys = by + ["column_name"]
    hist = (
        long.where(F.col("__v").isNotNull() & ~F.isnan("__v"))
        .groupBy(*keys, "__v")
        .agg(F.count(F.lit(1)).alias("__c"))
    )
    seq = sequence(hist, ["__v"], keys, running_sum={"__cum": "__c"})
    sizes = hist.groupBy(*keys).agg(F.sum("__c").alias("__n"))
    j = seq.join(sizes, keys, "inner")
    start = F.col("__cum") - F.col("__c")  # values before this one
    keep, aggs = None, []
    for name, q in qs.items():
        pos = F.lit(float(q)) * (F.col("__n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        in_lo = (start <= lo) & (lo < F.col("__cum"))
        in_hi = (start <= hi) & (hi < F.col("__cum"))
        at_lo = F.max(F.when(in_lo, F.col("__v")))
        at_hi = F.max(F.when(in_hi, F.col("__v")))
        aggs.append((at_lo + (at_hi - at_lo) * F.max(pos - lo)).alias(name))
        keep = (in_lo | in_hi) if keep is None else keep | in_lo | in_hi
    # only the <= 2 histogram rows per group and quantile that matter survive
    return j.where(keep).groupBy(*keys).agg(*aggs)


def quantiles(df: DataFrame, col: str, qs, by=()) -> DataFrame:
    """One row per group (or one row) with a column per requested quantile.

    Groups whose values are all NULL give NULL.  ``qs`` maps output names to
    fractions, e.g. ``{"median": 0.5}``.
    """
    by = [by] if isinstance(by, str) else list(by)
    out = quantiles_long(df, [col], qs, by).drop("column_name")
    if by:
        return df.select(*by).distinct().join(out, by, "left")
    names = list(qs)
    # exactly one row, NULLs when the column has no value
    return out.agg(*[F.max(n).alias(n) for n in names])


def wide_quantiles(df: DataFrame, cols, q: float, prefix: str) -> DataFrame:
    """One row: ``{prefix}{col}`` = q-quantile of each column (one pass)."""
    long = quantiles_long(df, cols, {"__q": q})
    return long.agg(*[F.max(F.when(F.col("column_name") == c, F.col("__q"))).alias(f"{prefix}{c}") for c in cols])


def median(df: DataFrame, col: str, by=(), name: str = "median") -> DataFrame:
    return quantiles(df, col, {name: 0.5}, by)
