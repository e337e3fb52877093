"""Skew-safe ordered analytics: ranks, row numbers, running sums, lag/lead.

``Window.orderBy`` without ``partitionBy`` moves every row into one task, and
``Window.partitionBy(k)`` puts a hot key (say a third of all rows) in one
task.  This module computes the same values from Spark's own window functions
over smaller groups, for inputs of every size alike:

* Row numbers, running sums, lag and lead: the keys and the values asked for are
  written once as a narrow side table.  A random sample of it (about
  ``SAMPLE_PER_BUCKET`` rows a bucket) gives boundaries in the order of
  (partition keys, order keys), placed inside partition keys that hold more
  than a bucket's share.  A row's bucket is a function of its keys alone, so it
  is the same in every pass, retry or recomputation; the sample only decides
  how even the buckets are.  Native windows run over (partition keys, bucket),
  and one aggregate of the side table per (partition keys, bucket) of the split keys gives
  what lies in the buckets before.  A key that no boundary splits needs no offsets.
* Boundaries are one value, a scalar subquery of two sorted levels, about the square root
  of their number each; a row goes through the first, then through one part of the second.
  The plan has the same size for any number of buckets.
* Rank, dense rank and sums over the default RANGE frame: rows are counted per
  (partition keys, peer keys) with map-side combine, the running totals are
  taken over that written table, and joined back.  Ties are never gathered.

A pass runs its input once for the side table and holds it once in its own plan, so a chain of
k passes reads what it starts from k + 1 times.

Semantics follow SQL: ``running_sum`` uses ROWS UNBOUNDED PRECEDING .. CURRENT
ROW, ``range_sum`` the default RANGE frame (peers included), ``lag``/``lead``
use offset 1.  Values keep Spark's own types and rules (NaN, NULL, wide
decimals, BIGINT).  ``order_by`` should be a total order for row numbers,
running sums, lag and lead: rows equal in all keys share a bucket.  Keys must
be atomic and reproducible (not, say, sums of doubles in shuffle order).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import groupby
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import written

_ORDER_RE = re.compile(
    r"^\s*(?P<col>[A-Za-z_][A-Za-z0-9_]*)\s*(?P<dir>asc|desc)?\s*(nulls\s+(?P<nulls>first|last))?\s*$",
    re.I,
)

SAMPLE_PER_BUCKET = 64
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class OrderKey:
    col: str
    ascending: bool = True
    nulls_first: bool | None = None

    @property
    def null_leads(self) -> bool:
        return self.ascending if self.nulls_first is None else self.nulls_first

    def column(self) -> Column:
        c = F.col(self.col)
        if self.ascending:
            return c.asc_nulls_first() if self.null_leads else c.asc_nulls_last()
        return c.desc_nulls_first() if self.null_leads else c.desc_nulls_last()

    def before(self, value: Column) -> Column:
        """True for rows whose key sorts strictly before ``value``."""
        c, lead = F.col(self.col), F.lit(self.null_leads)
        less = F.coalesce(c < value if self.ascending else c > value, lead)
        return F.when(value.isNull(), ~lead & c.isNotNull()).otherwise(less)


def parse_order(spec) -> OrderKey:
    if isinstance(spec, OrderKey):
        return spec
    m = _ORDER_RE.match(spec)
    if not m:
        raise ValueError(f"bad order spec: {spec!r}")
    asc = (m.group("dir") or "asc").lower() == "asc"
    nulls = m.group("nulls")
    return OrderKey(m.group("col"), asc, None if nulls is None else nulls.lower() == "first")


def _before(keys: list[OrderKey], bound: Column) -> Column:
    """Rows that sort strictly before ``bound``, a struct of k0, k1, ..."""
    out = F.lit(False)
    for i, k in reversed(list(enumerate(keys))):
        v = bound[f"k{i}"]
        out = k.before(v) | (F.col(k.col).eqNullSafe(v) & out)
    return out


def _with_bucket(df: DataFrame, keys: list[OrderKey], levels: DataFrame) -> DataFrame:
    """``df`` with the number of boundaries at or before each row; ``levels`` is one
    row: every s-th boundary, and for each of these the s boundaries from it on."""
    def passed(bounds: Column) -> Column:
        return F.aggregate(bounds, F.lit(0), lambda n, b: F.when(_before(keys, b), n).otherwise(b["at"]))

    # each level is used once, so that the optimizer puts the subquery in its place and no row carries it
    d = df.withColumn("__sq_l1", levels.select("l1").scalar()).withColumn("__sq_l2", levels.select("l2").scalar())
    return d.withColumn("__sq_bucket", passed(F.get("__sq_l2", passed(F.col("__sq_l1"))))).drop("__sq_l1", "__sq_l2")


def _boundaries(side: DataFrame, keys: list[OrderKey], n_part: int, n: int) -> tuple[DataFrame | None, list[tuple]]:
    """The boundaries as one row of two levels (None: no key is split) and the partition
    keys that they split, from a random sample of about ``n * SAMPLE_PER_BUCKET`` key tuples."""
    rows = side.count()
    wanted = n * SAMPLE_PER_BUCKET
    sample = side.select(*[k.col for k in keys])
    if rows > wanted:
        sample = sample.sample(wanted / rows, seed=17)
    got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in sample.orderBy(*[k.column() for k in keys]).collect()]
    step = max(1, len(got) // n)
    bounds, split = [], []
    for part, run in groupby(got, key=lambda r: r[:n_part]):
        cuts = list(dict.fromkeys(list(run)[step::step]))
        if cuts:
            bounds += cuts
            split.append(part)
    if not bounds:
        return None, split
    size = isqrt(len(bounds)) + 1
    chunks = [[(i + 1, *b) for i, b in enumerate(bounds)][k: k + size] for k in range(0, len(bounds), size)]
    one = "struct<at:int," + ",".join(f"k{i}:{side.schema[k.col].dataType.simpleString()}" for i, k in enumerate(keys)) + ">"
    # part 0 is for the rows before all boundaries
    row = ([(j + 1, *c[0][1:]) for j, c in enumerate(chunks)], [[], *chunks])
    return side.sparkSession.createDataFrame([row], f"l1 array<{one}>, l2 array<array<{one}>>"), split


def _sum_type(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.DecimalType):
        return T.DecimalType(min(38, dt.precision + 10), dt.scale)
    return T.LongType() if isinstance(dt, _INTEGERS) else T.DoubleType()


def _plus(local: Column, before: Column) -> Column:
    """Sum of two totals, NULL where both are."""
    return F.coalesce(local + before, local, before)


def _same(left: DataFrame, right: DataFrame, names: dict[str, str]) -> list[Column]:
    return [left[a].eqNullSafe(right[b]) for a, b in names.items()]


def _rows(df: DataFrame, side: DataFrame, keys: list[OrderKey], pcols: list[str], n: int, row_number: str | None,
          sums: dict[str, str], lags: dict[str, str], leads: dict[str, str]) -> DataFrame:
    """Row numbers, ROWS sums, lag and lead over buckets; ``side`` is a written table
    of the keys and values of ``df``."""
    full = [OrderKey(c) for c in pcols] + keys
    levels, split = _boundaries(side, full, len(pcols), n)
    types = {name: _sum_type(df.schema[src].dataType) for name, src in sums.items()}
    if levels is None:  # no key holds more than a bucket's share
        keyed, group = df, pcols
    else:
        keyed, group = _with_bucket(df, full, levels), [*pcols, "__sq_bucket"]
    w = Window.partitionBy(*group).orderBy(*[k.column() for k in keys])
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = {"__sq_rn": F.row_number().over(w).cast("long")}
    if leads and levels is not None:
        cols["__sq_end"] = F.lead(F.lit(1)).over(w).isNull()
    cols |= {f"__sq_s_{name}": F.sum(src).over(so_far) for name, src in sums.items()}
    cols |= {f"__sq_g_{name}": F.lag(src).over(w) for name, src in lags.items()}
    cols |= {f"__sq_d_{name}": F.lead(src).over(w) for name, src in leads.items()}
    local = keyed.withColumns(cols)
    if levels is None:
        return local.select(
            *df.columns,
            *([F.col("__sq_rn").alias(row_number)] if row_number else []),
            *[F.col(f"__sq_s_{name}").cast(types[name]).alias(name) for name in sums],
            *[F.col(f"__sq_g_{name}").alias(name) for name in lags],
            *[F.col(f"__sq_d_{name}").alias(name) for name in leads],
        )

    totals = [F.count(F.lit(1)).alias("n_rows"), *[F.sum(src).alias(f"s_{name}") for name, src in sums.items()]]
    # the edge values need positions; plain totals combine before their shuffle
    edges = [F.max_by(F.col(src), F.col("__sq_rn")).alias(f"g_{name}") for name, src in lags.items()]
    edges += [F.min_by(F.col(src), F.col("__sq_rn")).alias(f"d_{name}") for name, src in leads.items()]
    source = _with_bucket(side, full, levels)
    if pcols:
        schema = T.StructType([T.StructField(f"__sq_h_{c}", df.schema[c].dataType) for c in pcols])
        hot = df.sparkSession.createDataFrame(split, schema)
        source = source.join(F.broadcast(hot), _same(source, hot, {c: f"__sq_h_{c}" for c in pcols}), "left_semi")
    if edges:
        source = source.withColumn("__sq_rn", F.row_number().over(w))
    stats = source.groupBy(*group).agg(*totals, *edges)
    wb = Window.partitionBy(*pcols).orderBy("__sq_bucket")
    earlier = wb.rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket of a split key: at most the number of boundaries and split keys
    offsets = F.broadcast(stats.select(
        *[F.col(c).alias(f"__sq_o_{c}") for c in group],
        F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)).alias("__sq_before"),
        *[F.sum(f"s_{name}").over(earlier).alias(f"__sq_os_{name}") for name in sums],
        *[F.lag(f"g_{name}").over(wb).alias(f"__sq_og_{name}") for name in lags],
        *[F.lead(f"d_{name}").over(wb).alias(f"__sq_od_{name}") for name in leads],
    ))
    joined = local.join(offsets, _same(local, offsets, {c: f"__sq_o_{c}" for c in group}), "left")
    outs = []
    if row_number:
        outs.append((F.col("__sq_rn") + F.coalesce("__sq_before", F.lit(0))).alias(row_number))
    outs += [_plus(F.col(f"__sq_s_{name}"), F.col(f"__sq_os_{name}")).cast(types[name]).alias(name) for name in sums]
    outs += [F.when(F.col("__sq_rn") == 1, F.col(f"__sq_og_{name}")).otherwise(F.col(f"__sq_g_{name}")).alias(name)
             for name in lags]
    outs += [F.when(F.col("__sq_end"), F.col(f"__sq_od_{name}")).otherwise(F.col(f"__sq_d_{name}")).alias(name)
             for name in leads]
    return joined.select(*[local[c] for c in df.columns], *outs)


def _peers(df: DataFrame, base: DataFrame, keys: list[OrderKey], pcols: list[str], n: int, rank: str | None,
           dense_rank: str | None, sums: dict[str, str]) -> DataFrame:
    """Rank, dense rank and RANGE sums from one row per peer group of ``base``,
    which holds the keys and values of ``df``."""
    group = list(dict.fromkeys([*pcols, *[k.col for k in keys]]))
    hist = written(base.groupBy(*group).agg(
        F.count(F.lit(1)).alias("__sq_c"), *[F.sum(src).alias(f"__sq_t_{name}") for name, src in sums.items()]), "peers")
    run = {f"__sq_r_{name}": f"__sq_t_{name}" for name in sums}
    if rank:
        run["__sq_upto"] = "__sq_c"
    table = _rows(hist, hist, keys, pcols, n, "__sq_dense" if dense_rank else None, run, {}, {})
    outs = []
    if rank:
        outs.append((F.col("__sq_upto") - F.col("__sq_c") + 1).alias(rank))
    if dense_rank:
        outs.append(F.col("__sq_dense").alias(dense_rank))
    outs += [F.col(f"__sq_r_{name}").cast(_sum_type(df.schema[src].dataType)).alias(name) for name, src in sums.items()]
    values = table.select(*[F.col(c).alias(f"__sq_k_{c}") for c in group], *outs)
    names = [c for c in (rank, dense_rank, *sums) if c]
    joined = df.join(values, _same(df, values, {c: f"__sq_k_{c}" for c in group}), "inner")
    return joined.select(*[df[c] for c in df.columns], *names)


def sequence(
    df: DataFrame,
    order_by,
    partition_by=(),
    *,
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    running_sum: dict[str, str] | None = None,
    range_sum: dict[str, str] | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    buckets: int | None = None,
    peers: int | None = None,
) -> DataFrame:
    """Append ordered-analytic columns computed without a single-task window.

    ``peers``: how many leading ``order_by`` keys define ties for rank,
    dense rank and ``range_sum`` (default: all of them).  ``buckets`` defaults
    to ``spark.sql.shuffle.partitions``.
    """
    keys = [parse_order(o) for o in order_by]
    pcols = list(partition_by)
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = base = df
    if row_number or running_sum or lag or lead:
        values = [c for d in (running_sum, lag, lead, range_sum) for c in (d or {}).values()]
        base = written(df.select(*dict.fromkeys([*pcols, *[k.col for k in keys], *values])), "order")
        out = _rows(out, base, keys, pcols, n, row_number, dict(running_sum or {}), dict(lag or {}), dict(lead or {}))
    if rank or dense_rank or range_sum:
        tie_keys = keys if peers is None else keys[:peers]
        out = _peers(out, base, tie_keys, pcols, n, rank, dense_rank, dict(range_sum or {}))
    asked = [c for c in (row_number, rank, dense_rank, *(running_sum or {}), *(range_sum or {}), *(lag or {}),
                         *(lead or {})) if c]
    return out.select(*df.columns, *asked)


def row_index(df: DataFrame, order_by, name: str = "row_idx", start: int = 0) -> DataFrame:
    """Consecutive index in a total order, computed without one task."""
    out = sequence(df, order_by, row_number="__ri")
    return out.withColumn(name, F.col("__ri") - 1 + F.lit(start)).drop("__ri")
