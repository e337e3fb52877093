"""Identity operators (I1-I3): consecutive ids, entity resolution on a
composite key, and cross-file matching.

No operator collects keys to the driver: first-seen order is a ``min`` per
key (map-side partial aggregation), numbering uses the distributed ordered
engine, and the ids are joined back on the keys (null-safe, because an
absent attribute is a value of the key like any other).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.sequence import row_index
from tessera.session import written


def consecutive_ids(df: DataFrame, order_cols, name: str = "record_id", fmt: str = "R%04d",
                    start: int = 0) -> DataFrame:
    """``R0000, R0001, ...`` in a total row order (never a global
    ``row_number`` window)."""
    flat, names = _flat_order(df, list(order_cols))
    out = row_index(flat, names, "__i", start=start)
    return out.withColumn(name, F.format_string(fmt, F.col("__i"))).drop("__i", *[n for n in names
                                                                                   if n not in df.columns])


def _flat_order(df: DataFrame, cols):
    """Struct-typed order columns become their fields (lexicographic order)."""
    names = []
    for c in cols:
        dt = df.schema[c].dataType
        if isinstance(dt, T.StructType):
            for i, f in enumerate(dt.fields):
                n = f"__{c}_{i}"
                df = df.withColumn(n, F.col(c)[f.name])
                names.append(n)
        else:
            names.append(c)
    return df, names


def resolve_entities(df: DataFrame, keys, order_col: str = "ingest_ord", name: str = "student_id",
                     fmt: str = "S%04d") -> DataFrame:
    """Rows with the same key tuple get the same id; ids are numbered by
    the first appearance of each tuple in input order."""
    keys = list(keys)
    first = written(df.groupBy(*keys).agg(F.min(order_col).alias("__first")), "firsts")  # numbering reads it twice
    numbered = consecutive_ids(first, ["__first"], "__sid", fmt).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__sid")  # fresh names: no self-join ambiguity
    cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    # the ids grow with the input and are wide in memory, however small their files are: never broadcast them
    return df.join(numbered.hint("merge"), cond, "inner").select(*df.columns, F.col("__sid").alias(name))


def cross_file_match(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """How many row pairs the inner join of two files on the keys yields
    and how many distinct key tuples the union holds -- from per-key counts,
    so the pair product is never materialised."""
    keys = list(keys)
    ca = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("__na"))
    cb = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("__nb"))
    cb = cb.select(*[F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)], "__nb")
    cond = [F.col(k).eqNullSafe(F.col(f"__b{i}")) for i, k in enumerate(keys)]
    j = ca.join(cb, cond, "full_outer")
    return j.agg(
        F.coalesce(F.sum(F.col("__na") * F.col("__nb")), F.lit(0)).cast("bigint").alias("matched_pairs"),
        F.count(F.lit(1)).alias("union_keys"),
        F.count_if(F.col("__na").isNotNull() & F.col("__nb").isNotNull()).alias("shared_keys"),
    )
