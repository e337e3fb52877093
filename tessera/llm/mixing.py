"""Mixing sources to target weights by systematic sampling.

A source's target over its size is the expected number of copies of each of
its documents.  The documents of a source are put in order (size class, hash
bucket, size, hash of id and text); expected copies are prefix-summed along it, one random
offset of the source is added, and a document is emitted once per whole number
that its step crosses.  The prefix sum is made of counts: rows are ranked only
inside (source, size class, bucket), and the counts of these groups are summed
over the groups before.  There is a bucket for every ``ROWS`` rows of the table, 64 at
least, so a group has about ``ROWS`` rows at most; repeated and null ids are spread by
their texts.

Targets: sources by code point, null last, weigh ``weights`` in turn and share
``share`` of all sizes; a target stops at ``most`` times its source's size and
the excess goes to the others by weight until none is above.

Defined cases: a null text has size 0; a source of size 0 has target 0 and
none of its rows is taken; null ids count as the empty text; rows equal in id and text
are rows of their own that any order suits.  Other columns are not read.  No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, materialise

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 64
ROWS = 1 << 17     # rows of the table a bucket


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(id_: Column, text: Column) -> Column:
    return F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))


def size_class(size: Column) -> Column:
    """Text that sorts like the size's binary length and three leading bits after the first."""
    b = F.bin(size)
    return F.concat(F.lpad(F.length(b).cast("string"), 2, "0"), F.substring(F.concat(b, F.lit("000")), 2, 3))


def targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> (source, source_size, target): least level ``l`` with
    sum(min(most * size, l * weight)) = share * total.  One row per source is
    ordered in one place; the documents are not."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    s = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    s = s.withColumn("key", F.col("cap") / F.col("w"))
    order = Window.orderBy("key", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = (s.withColumn("all", F.sum("source_size").over(every) * F.lit(float(share)))
         .withColumn("level", (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))))
    # the first source, by cap / weight, that the level does not fill sets it
    level = F.min(F.when(F.col("level") <= F.col("key"), F.struct("key", "source_size", "level"))).over(every)["level"]
    return (s.withColumn("l", level)
            .select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("l") * F.col("w"), F.col("cap"))).alias("target")))


def sampled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix",
            weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies (times it is emitted)."""
    d = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
                    row_hash(F.col(id_col), F.col(text_col)).alias("h"), *[F.col(c).alias(c) for c in extra])
    d = materialise(d.withColumn("bin", size_class(F.col("size"))), "sizes")
    buckets = max(BUCKETS, -(-d.count() // ROWS))
    d = d.withColumn("bucket", F.conv(F.substring("h", 1, 8), 16, 10).cast("long") % buckets)
    groups = d.groupBy("source", "bin", "bucket").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    per = targets(groups.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    before = Window.partitionBy("source").orderBy("bin", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")))), 1, 12), 16, 10).cast("double") / float(16**12)
    side = (starts.join(per.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
            .select(F.col("source").alias("_source"), F.col("bin").alias("_bin"), F.col("bucket").alias("_bucket"), "start", "source_size", "target",
                    F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"), u.alias("u")))
    side = materialise(side, "rates")
    inside = Window.partitionBy("source", "bin", "bucket").orderBy("size", "h")
    d = d.withColumn("at", F.row_number().over(inside))
    d = d.join(broadcast_if_small(side), F.col("source").eqNullSafe(F.col("_source")) & (F.col("bin") == F.col("_bin")) & (F.col("bucket") == F.col("_bucket")))
    pos = F.col("start") + F.col("at")
    copies = F.floor(F.col("rate") * pos + F.col("u")) - F.floor(F.col("rate") * (pos - 1) + F.col("u"))
    return d.select("id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"), *extra)


SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
             md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h FROM documents),
e AS (SELECT *, lpad(CAST(length(bin(size)) AS VARCHAR), 2, '0') || (bin(size) || '000')[2:4] AS b, 
        CAST('0x' || h[1:8] AS BIGINT) % (SELECT greatest({BUCKETS}, (count(*) + {ROWS - 1}) // {ROWS}) FROM documents) AS k FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM e GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
c AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / w AS ratio FROM w),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER p, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER p, 0)) AS level
      FROM c WINDOW p AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, ratio) FROM l WHERE level <= ratio) * w, cap)) AS target FROM l),
r AS (SELECT e.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        row_number() OVER (PARTITION BY e.source ORDER BY b, k, size, h) AS pos,
        CAST('0x' || md5('mix:' || coalesce(e.source, ''))[1:12] AS BIGINT) / 281474976710656.0::DOUBLE AS u
      FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST((floor(rate * pos + u) - floor(rate * (pos - 1) + u)) * size AS BIGINT) AS taken FROM r
"""
