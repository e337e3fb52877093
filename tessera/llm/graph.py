"""Links between rows: connected components, and all-pairs work inside groups
cut into bounded block pairs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) undirected edges -> (v, comp), comp the least vertex of v's component.

    Alternates large-star and small-star contractions, each one grouped
    minimum (reduced before the shuffle) joined back on the vertex, until the
    edges no longer change.  A hub's neighbours are spread by the skew join.
    Null vertices and self-loops are ignored; no edges give no rows."""
    e = materialise(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        last, e = e, materialise(small, "cc")
        discard(last)
        now = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
        if state == tuple(now):
            break
        state = tuple(now)
    stars = e.select(F.col("a").alias("v"), F.col("b").alias("comp"))
    return stars.unionByName(e.select(F.col("b").alias("v"), F.col("b").alias("comp")).distinct())


def block_pairs(df: DataFrame, group: str, member: str, block: int) -> DataFrame:
    """Rows of each group dealt over pairs of blocks (columns ``_i <= _j``).

    A group of at most ``block`` rows is one pair (0, 0).  A larger group is
    cut by a hash of ``member`` into blocks of about ``block`` rows, and each
    row goes to every pair its block is in, so all pairs of rows meet exactly
    where ``_i`` and ``_j`` are their blocks and no task holds a whole group."""
    large = (df.groupBy(group).agg(F.count("*").alias("_n")).where(F.col("_n") > block)
             .select(F.col(group).alias("_g"), "_n"))
    d = df.join(large, F.col(group) == F.col("_g"), "left").drop("_g")
    return dealt(d, "_n", member, block)


def dealt(df: DataFrame, size: str, member: str, block: int) -> DataFrame:
    """``block_pairs`` for rows whose column ``size`` (dropped) is the size of their group, null counting as a small one."""
    n = F.col(size)
    d = df.withColumn("_k", F.when(n > block, F.ceil(n / F.lit(block * 0.75))).otherwise(1).cast("int"))
    d = d.withColumn("_b", F.pmod(F.xxhash64(member), F.col("_k")).cast("int"))
    d = d.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return (d.withColumn("_i", F.least("_b", "_o")).withColumn("_j", F.greatest("_b", "_o"))
            .drop(size, "_k", "_o"))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each of ``n`` local vertices' components under edges a-b."""
    lab = np.arange(n)
    while len(a):
        m = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        np.minimum.at(new, lab[a], m)
        np.minimum.at(new, lab[b], m)
        new = new[new]
        if (new == lab).all():
            break
        lab = new
    return lab
