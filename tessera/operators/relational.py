"""Relational building blocks (J*, A*, U*) expressed as DataFrame plans.

The helpers here exist where the straightforward plan does not scale:

* ``attach_scalar``: a one-row aggregate (global mean, max) joined to every
  row; the one-row side is broadcast, which is a proven size bound, instead of
  ``Window.partitionBy()`` that gathers all rows in one task (W3, A5, J9).
* ``attach_group_stats``: per-group aggregates beside each row (W1, W2, A15)
  as partial aggregation + join, so a hot group is pre-aggregated map-side
  and the join can be split by AQE's skew handling, instead of one window
  task per group.
* ``join_checked``: broadcast a side only after counting it.
* ``not_in``: SQL ``NOT IN`` with its null semantics (J7).
* ``fanout_student_metrics``: the result of the fan-out join
  students LEFT JOIN enrollments LEFT JOIN assessments (on student only)
  computed from per-student pre-aggregates, so the product of the two sides
  is never materialised (J13/A11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join, broadcasting ``small`` only when its counted size is within ``limit``."""
    if small.count() <= limit:
        small = F.broadcast(small)
    return big.join(small, on, how)


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Cross join with a one-row aggregate (broadcast: size is 1 by construction)."""
    return df.crossJoin(F.broadcast(one_row))


def attach_group_stats(df: DataFrame, keys, aggs) -> DataFrame:
    """Per-group aggregates beside every row (window over a partition, scalable form).

    The stats side is chosen for broadcast by Spark's own size check (static
    estimate, then AQE's runtime statistics); beyond the threshold it stays a
    shuffle join whose hot keys AQE splits.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    stats = df.groupBy(*keys).agg(*aggs)
    return df.join(stats, keys, "inner")


def not_in(left: DataFrame, right: DataFrame, lcol: str, rcol: str) -> DataFrame:
    """Rows of ``left`` whose ``lcol`` is NOT IN ``right.rcol`` (SQL semantics).

    One NULL in the subquery makes every predicate NULL (empty result unless
    the subquery is empty); a NULL probe value is dropped when the subquery
    is non-empty.
    """
    flags = right.agg(
        F.count(F.lit(1)).alias("__n"), F.count_if(F.col(rcol).isNull()).alias("__nulls")
    )
    keys = right.select(F.col(rcol).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    anti = left.join(keys, left[lcol] == keys["__k"], "left_anti")
    return (
        attach_scalar(anti, flags)
        .where((F.col("__n") == 0) | ((F.col("__nulls") == 0) & F.col(lcol).isNotNull()))
        .drop("__n", "__nulls")
    )


def fanout_student_metrics(students: DataFrame, enrollments: DataFrame, assessments: DataFrame) -> DataFrame:
    """Aggregates of ``students s LEFT JOIN enrollments e ON s.id = e.student_id
    LEFT JOIN assessments a ON s.id = a.student_id GROUP BY s``.

    Each assessment row is repeated once per enrollment row of its student
    (once when the student has none), so COUNT(a.id) = max(n_enr, 1) * n_a,
    while AVG/MAX/MIN are unchanged and COUNT(DISTINCT e.course_id) only
    depends on enrollments.  Two partial aggregations replace an n_enr x n_a
    product per student.
    """
    enr = enrollments.groupBy("student_id").agg(
        F.count(F.lit(1)).alias("__n_enr"), F.count_distinct("course_id").alias("courses_count")
    )
    ass = assessments.groupBy("student_id").agg(
        F.count("assessment_id").alias("__n_ass"),
        F.sum("score").alias("__sum"),
        F.count("score").alias("__cnt"),
        F.max("score").alias("highest_score"),
        F.min("score").alias("lowest_score"),
    )
    out = students.join(enr, "student_id", "left").join(ass, "student_id", "left")
    return out.select(
        *students.columns,
        F.coalesce("courses_count", F.lit(0)).alias("courses_count"),
        (F.greatest(F.coalesce("__n_enr", F.lit(0)), F.lit(1)) * F.coalesce("__n_ass", F.lit(0))).alias(
            "assessments_count"
        ),
        F.round(F.try_divide(F.col("__sum"), F.col("__cnt")), 2).alias("average_score"),
        "highest_score",
        "lowest_score",
    )


def table_counts(named: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of per-table row counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in named.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
