"""Numeric helpers shared by the operators (all native Spark expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_avg(c) -> Column:
    """AVG computed as SUM/COUNT in decimal arithmetic.

    ``avg(decimal(p,s))`` rounds its result to 6 digits, so a later
    ``round(.., 2)`` can round twice; SUM/COUNT keeps all digits.  NULL when
    the group has no non-null value.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.try_divide(F.sum(c), F.count(c))


def avg2(c) -> Column:
    """ROUND(AVG(c), 2) with exact decimal input (half away from zero)."""
    return F.round(exact_avg(c), 2)


def dbl(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def sample_std(c) -> Column:
    """Sample standard deviation (ddof=1) over the non-NaN values; a
    single value gives 0.0, no value gives NULL."""
    c = F.col(c) if isinstance(c, str) else c
    v = F.when(~F.isnan(c), c)
    return F.when(F.count(v) == 1, F.lit(0.0)).otherwise(F.stddev_samp(v))


def half_even_int(c) -> Column:
    """Round to the nearest integer, ties to even (NumPy semantics)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c).cast("bigint")


def coerce_double(c) -> Column:
    """Parse to DOUBLE; unparsable text, blanks and NaN become NULL (ANSI-safe)."""
    c = F.col(c) if isinstance(c, str) else c
    d = c.try_cast("double")
    return F.when(F.isnan(d), None).otherwise(d)


_INT_LIMIT = 9.2e18


def coerce_int(c) -> Column:
    """Parse to BIGINT; a non-integral value becomes NULL (not truncated),
    so '20.0' -> 20 and '20.7' -> NULL.  Whole numbers never pass through DOUBLE,
    so ids above 2^53 stay apart."""
    d = coerce_double(c)
    ok = (d == F.floor(d)) & (F.abs(d) < _INT_LIMIT)
    return F.when(ok, F.coalesce(_whole(c), d.cast("bigint")))


def _whole(c) -> Column:
    """The exact BIGINT of a whole number written with or without zero decimals, else NULL."""
    s = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(s.try_cast("bigint"), F.regexp_replace(s, r"\.0*\s*$", "").try_cast("bigint"))


def coerce_int_half_even(c) -> Column:
    """Parse, then round half to even to an integer ('2.5' -> 2, '3.5' -> 4)."""
    d = coerce_double(c)
    r = F.rint(d)
    return F.when(F.abs(r) < _INT_LIMIT, F.coalesce(_whole(c), r.cast("bigint")))


def truncate_int(c) -> Column:
    """``int(float(x))``: parse and truncate toward zero; bad text -> NULL."""
    d = coerce_double(c)
    t = F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d))
    return F.when(F.abs(t) < _INT_LIMIT, t.cast("bigint"))
