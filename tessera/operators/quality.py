"""Declarative data-quality rules evaluated in one aggregation pass (Q1-Q18).

A rule is ``Rule(name, column, passes)`` where ``passes`` is a boolean Column
that is TRUE for a good row.  ``evaluate`` turns a rule list into a single
``agg`` of ``count_if(NOT passes)`` terms, then unpivots it to one row per
rule; examples of failures are fetched only for failing rules and only up to
a fixed small limit, never as an unbounded list.

SQL semantics: a NULL predicate *passes* (CHECK constraints accept NULL)
unless the rule says ``nulls_fail=True`` (pandas float range checks count a
missing value as out of range).
"""

from __future__ import annotations

from dataclasses import dataclass

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.clean import OUTLIER_RANGES, REQUIRED_COLUMNS, REQUIRED_NON_NULL, UNIQUE_COLUMNS

# Missing-percentage tiers of the column quality report
# (upper bound inclusive, label), checked in this order.
QUALITY_TIERS = ((0, "Excellent"), (5, "Good"), (20, "Acceptable"), (50, "Poor"), (100, "Critical"))


@dataclass
class Rule:
    name: str
    column: str | None
    passes: Column
    nulls_fail: bool = False

    def failed(self) -> Column:
        # a NULL verdict passes unless the rule says missing values fail
        return ~F.coalesce(self.passes, F.lit(not self.nulls_fail))


def evaluate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One pass: (rule, column, failed_count, total_rows) per rule."""
    aggs = [F.count(F.lit(1)).alias("__total")]
    aggs += [F.count_if(r.failed()).alias(f"__r{i}") for i, r in enumerate(rules)]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{r.name}', '{r.column or ''}', __r{i}" for i, r in enumerate(rules))
    return one.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, column_name, failed_count)", "__total AS total_rows")


def failing_examples(df: DataFrame, rules: list[Rule], order: str, limit: int = 3) -> DataFrame:
    """Q2: (rule, examples): for each rule that fails, the values of its column in the first
    ``limit`` failing rows by ``order``, as text, a missing value as null.

    One pass emits a narrow row per failure; a rank per rule with a limit is cut to
    ``limit`` rows in every task before the shuffle, so no rule's failures are ever gathered."""
    failures = [F.when(r.failed(), F.struct(F.lit(r.name).alias("rule"), F.col(r.column).cast("string").alias("value")))
                for r in rules if r.column]
    found = df.select(F.col(order).alias("__o"), F.explode(F.array_compact(F.array(*failures))).alias("f")).select("__o", "f.*")
    first = found.withColumn("__k", F.row_number().over(Window.partitionBy("rule").orderBy("__o"))).where(F.col("__k") <= limit)
    listed = first.groupBy("rule").agg(F.array_sort(F.collect_list(F.struct("__k", "value"))).alias("l"))  # at most ``limit`` each
    return listed.select("rule", F.transform("l", lambda x: x["value"]).alias("examples"))


def with_examples(report: DataFrame, df: DataFrame, rules: list[Rule], order: str, limit: int = 3) -> DataFrame:
    """A rule report with the examples of its failing rules beside it (null for the others)."""
    return report.join(F.broadcast(failing_examples(df, rules, order, limit)), "rule", "left")  # one row per rule


# ---------------------------------------------------------------- Q1
class ColumnDifference(NamedTuple):
    """Names by where they stand: only required, only in the frame."""

    missing_columns: tuple[str, ...]
    extra_columns: tuple[str, ...]


def column_difference(df: DataFrame, required=REQUIRED_COLUMNS) -> ColumnDifference:
    have = dict.fromkeys(df.columns)
    want = dict.fromkeys(required)
    return ColumnDifference(tuple(c for c in want if c not in have), tuple(c for c in have if c not in want))


def validate_schema(df: DataFrame, required=REQUIRED_COLUMNS, strict: bool = False) -> ColumnDifference:
    """Q1: the difference between the frame's columns and the required ones; a
    required column that is absent, and under ``strict`` any further column, is an error."""
    diff = column_difference(df, required)
    wrong = diff.missing_columns + (diff.extra_columns if strict else ())
    if wrong:
        raise ValueError(f"columns differ from the required ones in {', '.join(wrong)}")
    return diff


# ---------------------------------------------------------------- Q2
def record_rules(df: DataFrame, ranges=None, float_nulls_fail: bool = True) -> list[Rule]:
    """The standard record's rules: non-null, unique (via window-free count), ranges."""
    ranges = OUTLIER_RANGES if ranges is None else ranges
    rules = [Rule(f"not_null:{c}", c, F.col(c).isNotNull()) for c in REQUIRED_NON_NULL if c in df.columns]
    for c, (lo, hi) in ranges.items():
        if c not in df.columns:
            continue
        is_float = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
        rules.append(Rule(f"range:{c}", c, F.col(c).between(lo, hi), nulls_fail=is_float and float_nulls_fail))
    return rules


def validate_data(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Q2: every check at once: rows, nulls, duplicates, ranges, unique ids.

    Duplicates are ``count(*) - count(distinct id, NULL as one value)`` per
    unique column, computed in the same aggregation pass.
    """
    rules = record_rules(df) if rules is None else rules
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.count_if(r.failed()).alias(f"__r{i}") for i, r in enumerate(rules)]
    dups = [c for c in UNIQUE_COLUMNS if c in df.columns]
    for c in dups:
        # NULL counts as one more distinct value when present (pandas semantics)
        aggs.append((F.count(F.lit(1)) - F.count_distinct(c) - F.max(F.col(c).isNull().cast("int"))).alias(f"__d_{c}"))
    if "student_id" in df.columns:
        aggs.append(F.count_distinct("student_id").alias("unique_ids"))
    one = df.agg(*aggs)
    parts = [f"'empty', '', CAST(CASE WHEN total_rows = 0 THEN 1 ELSE 0 END AS BIGINT)"]
    parts += [f"'{r.name}', '{r.column or ''}', CAST(__r{i} AS BIGINT)" for i, r in enumerate(rules)]
    parts += [f"'unique:{c}', '{c}', CAST(coalesce(__d_{c}, 0) AS BIGINT)" for c in dups]
    cols = ["total_rows"] + (["unique_ids"] if "student_id" in df.columns else [])
    return one.selectExpr(
        f"stack({len(parts)}, {', '.join(parts)}) AS (rule, column_name, failed_count)", *cols
    ).withColumn("failed_count", F.col("failed_count").cast("bigint"))


def raise_if_invalid(report: DataFrame) -> None:
    """Turn a Q2 report into the accumulated error (small: one row per rule)."""
    bad = [r for r in report.where(F.col("failed_count") > 0).collect()]
    if bad:
        raise ValueError("Validation failed:\n" + "\n".join(f"  - {r.rule}: {r.failed_count}" for r in bad))


# ---------------------------------------------------------------- Q7
def _cell(c: Column, dt: T.DataType) -> Column:
    """A value as text, equal for equal values of the type: both zeros of a float
    are one, nested values are written as JSON."""
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.when(c == 0, F.lit("0")).otherwise(c.cast("string"))
    if isinstance(dt, T.BinaryType):
        return F.hex(c)
    if isinstance(dt, (T.StructType, T.ArrayType, T.MapType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c.alias("v"))))
    return c.cast("string")


def quality_report(df: DataFrame) -> DataFrame:
    """Q7: per column: type, missing count, unique count, missing %, completeness, tier.

    Each cell becomes one narrow row (column number, value); equal cells are counted
    in every task before they are shuffled, and a second aggregation counts the values of
    each column.  Values are compared as :func:`_cell` writes them.
    Percentages are exact decimals rounded half up to 2 places.
    """
    cols = df.columns
    cells = F.array(*[F.struct(F.lit(i).alias("__c"), _cell(F.col(f"`{f.name}`"), f.dataType).alias("__v")) for i, f in enumerate(df.schema)])
    values = df.select(F.inline(cells)).groupBy("__c", "__v").agg(F.count(F.lit(1)).alias("__k"))
    counts = values.groupBy("__c").agg(
        F.coalesce(F.sum(F.when(F.col("__v").isNull(), F.col("__k"))), F.lit(0)).alias("missing_count"),
        F.count("__v").alias("unique_count"), F.sum("__k").alias("__n"))
    names = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)], "__c int, column_name string, data_type string")
    # one row per column on both sides; a table without rows has no counts
    rep = names.join(F.broadcast(counts), "__c", "left").na.fill(0, ["missing_count", "unique_count", "__n"])
    pct = F.when(F.col("__n") > 0, F.round(
        F.try_divide(F.col("missing_count").cast("decimal(20,0)") * 100, F.col("__n")), 2)).otherwise(F.lit(0))
    rep = rep.withColumn("__pct", pct.cast("decimal(10,2)"))
    tier = None
    for bound, label in QUALITY_TIERS:
        cond = F.col("__pct") <= bound
        tier = F.when(cond, label) if tier is None else tier.when(cond, label)
    tier = tier.otherwise(QUALITY_TIERS[-1][1])
    return rep.select(
        "column_name", "data_type", F.col("missing_count").cast("bigint").alias("missing_count"),
        F.col("unique_count").cast("bigint").alias("unique_count"),
        F.col("__pct").cast("double").alias("missing_percentage"),
        (F.lit(100) - F.col("__pct")).cast("double").alias("completeness"),
        tier.alias("quality_tier"),
    )


# ---------------------------------------------------------------- Q10
def numeric_profile(df: DataFrame, cols) -> DataFrame:
    """Q10: min / max / mean / sample std / nulls per numeric column, one pass."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(c).cast("double").alias(f"__a{i}"), F.max(c).cast("double").alias(f"__b{i}"),
                 F.avg(c).alias(f"__c{i}"), F.stddev_samp(c).alias(f"__d{i}"),
                 F.count_if(F.col(c).isNull()).alias(f"__e{i}")]
    one = df.agg(*aggs)
    parts = ", ".join(f"'{c}', __a{i}, __b{i}, __c{i}, __d{i}, __e{i}" for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {parts}) AS (column_name, min_value, max_value, mean_value, "
                          f"std_value, null_count)")


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """Q10: value counts of a categorical column."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- Q11 / Q12 / Q13 / Q14
def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Q11: key tuples that occur more than once, with their multiplicity."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def pk_summary(df: DataFrame, keys, table: str) -> DataFrame:
    """Q11 summary: (table, key, duplicate_keys, rows_in_duplicates, null_keys)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return per.agg(
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("rows_in_duplicates"),
        F.coalesce(F.sum(F.when(null_key, F.col("n"))), F.lit(0)).cast("bigint").alias("null_key_rows"),
    ).select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "*")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Q12: child rows whose non-NULL foreign key has no parent (NULL FK allowed)."""
    p = parent.select(F.col(pk).alias("__pk")).distinct()
    return child.where(F.col(fk).isNotNull()).join(p, F.col(fk) == F.col("__pk"), "left_anti")


def cascade_delete(child: DataFrame, fk: str, deleted_keys: DataFrame, key: str) -> DataFrame:
    """Q14 (ON DELETE CASCADE): children of deleted parents are removed."""
    d = deleted_keys.select(F.col(key).alias("__dk")).distinct()
    return child.join(d, F.col(fk) == F.col("__dk"), "left_anti")


def set_null_on_delete(child: DataFrame, fk: str, deleted_keys: DataFrame, key: str) -> DataFrame:
    """Q14 (ON DELETE SET NULL): the foreign key of affected children becomes NULL."""
    d = deleted_keys.select(F.col(key).alias("__dk")).distinct().withColumn("__hit", F.lit(True))
    j = child.join(d, F.col(fk) == F.col("__dk"), "left")
    return j.withColumn(fk, F.when(F.col("__hit"), F.lit(None).cast(child.schema[fk].dataType)).otherwise(F.col(fk))
                        ).select(*child.columns)


# ---------------------------------------------------------------- Q16
def quarantine(df: DataFrame, fail_rules: list[Rule], invalid_rules: list[Rule]) -> DataFrame:
    """Q16: tag each row with the rules it violates and a disposition:
    'fail' (a hard rule, e.g. required NULL or duplicate id), 'invalid'
    (a soft rule, e.g. out of range) or 'valid'."""
    def names(rules):
        return F.filter(F.array(*[F.when(r.failed(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())

    out = df.withColumn("__hard", names(fail_rules) if fail_rules else F.array().cast("array<string>"))
    out = out.withColumn("__soft", names(invalid_rules) if invalid_rules else F.array().cast("array<string>"))
    return out.withColumn("violations", F.concat("__hard", "__soft")).withColumn(
        "disposition",
        F.when(F.size("__hard") > 0, "fail").when(F.size("__soft") > 0, "invalid").otherwise("valid"),
    ).drop("__hard", "__soft")


# ---------------------------------------------------------------- Q3
# Sources whose ids must be unique, and whose names and cities must be there.
UNIQUE_ID_SOURCES = ("csv", "api", "scraper")
NAMED_SOURCES = ("api", "scraper")


def source_rules(source: str, df: DataFrame) -> list[Rule]:
    """Q3: the row rules of each source.

    api: names and cities, ranges only where age is present, gpa/attendance may be NULL;
    scraper: names, cities and strict ranges (a missing value fails); other sources: a
    non-NULL id.  ``source_report`` adds the rules on the whole source."""
    required = ("student_id", "name", "city") if source in NAMED_SOURCES else ("student_id",)
    rules = [Rule(f"not_null:{c}", c, F.col(c).isNotNull()) for c in required if c in df.columns]
    if source == "api":
        rules.append(Rule("range:age", "age", F.col("age").between(*OUTLIER_RANGES["age"])))
    if source == "scraper":
        rules += [Rule(f"range:{c}", c, F.col(c).between(lo, hi), nulls_fail=True) for c, (lo, hi) in OUTLIER_RANGES.items()
                  if c in df.columns]
    return rules


def source_report(source: str, rows: int, missing_ids: int, ids: int, failed: dict[str, int]) -> dict[str, int]:
    """Failed counts by rule: those of the row rules, whether the source is empty, and, where ids
    must be unique, its rows beyond the first of each id (absent ids count as one)."""
    out = {"empty": int(rows == 0)} | failed
    if source in UNIQUE_ID_SOURCES:
        out["unique:student_id"] = rows - ids - int(missing_ids > 0)
    return out


def validate_source(source: str, df: DataFrame) -> DataFrame:
    """Q3: (source, rule, failed_count), one row per rule; ids are reduced to counts before anything is summed."""
    rules = source_rules(source, df)
    missing = F.col("student_id").isNull()
    part = df.groupBy("student_id").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(r.failed()).alias(f"r{i}") for i, r in enumerate(rules)])
    total = part.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(missing).alias("no_id"), F.count("student_id").alias("ids"),
                     *[F.coalesce(F.sum(f"r{i}"), F.lit(0)).alias(f"r{i}") for i in range(len(rules))])
    cells = {"empty": "CAST(n = 0 AS BIGINT)"} | {r.name: f"r{i}" for i, r in enumerate(rules)}
    if source in UNIQUE_ID_SOURCES:
        cells["unique:student_id"] = "n - ids - no_id"
    listed = ", ".join(f"'{k}', {v}" for k, v in cells.items())
    return total.selectExpr(f"'{source}' AS source", f"stack({len(cells)}, {listed}) AS (rule, failed_count)")
