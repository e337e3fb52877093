"""Text normalisation as native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """C4: remove leading/trailing Unicode whitespace (``trim`` only drops U+0020)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def title_case(c) -> Column:
    """Python ``str.title``: a capital after every non-letter, lower case elsewhere.

    The text is split into alternating runs of letters and non-letters and
    ``initcap`` is applied to each run (bare ``initcap`` only splits on
    spaces, giving 'Al-ain' instead of 'Al-Ain').
    """
    runs = F.regexp_extract_all(_c(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.when(_c(c).isNull(), None).otherwise(F.array_join(F.transform(runs, F.initcap), ""))


def collapse_spaces(c) -> Column:
    """Collapse inner whitespace runs to one space."""
    return F.regexp_replace(_c(c), r"(?U)\s+", " ")


def blank_to_null(c) -> Column:
    s = strip(c)
    return F.when(s == "", None).otherwise(s)
