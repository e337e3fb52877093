"""Sinks (K1-K8).  Every writer is distributed (one file per task) and
overwrites atomically per directory; verification re-reads the written data
with Spark instead of pulling rows to the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Accepted Parquet codecs and the identifier rule for tables.
PARQUET_CODECS = ("snappy", "gzip", "brotli", "lz4", "zstd", "none", "uncompressed")
IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _observed_write(df: DataFrame, writer_fn) -> int:
    """Write and return the number of rows written, counted during the write."""
    obs = Observation("rows_written")
    counted = df.observe(obs, F.count(F.lit(1)).alias("n"))
    writer_fn(counted)
    return int(obs.get["n"])


def write_csv(df: DataFrame, path: str, verify: bool = True, header: bool = True) -> int:
    """K1: CSV write; with ``verify`` the files are re-read and the row count must match."""
    n = _observed_write(df, lambda d: d.write.mode("overwrite").option("header", header).csv(path))
    if verify:
        back = df.sparkSession.read.option("header", header).csv(path).count()
        if back != n:
            raise OSError(f"verification failed for {path}: wrote {n} rows, read back {back}")
    return n


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", partition_by=None) -> int:
    """K2: Parquet write with a codec choice; an empty frame is refused."""
    if compression not in PARQUET_CODECS:
        raise ValueError(f"unsupported compression {compression!r}; choose from {PARQUET_CODECS}")
    if df.isEmpty():
        raise ValueError(f"refusing to write an empty DataFrame to {path}")
    w = lambda d: (d.write.mode("overwrite").option("compression", compression)
                   .partitionBy(*(partition_by or [])).parquet(path))
    return _observed_write(df, w)


def save_table(df: DataFrame, name: str, bucket_by: str | None = "student_id", buckets: int = 64,
               sort_by=("student_id",), path: str | None = None) -> None:
    """K3: replace a named table after checking the identifier.

    The table is bucketed and sorted by student_id when the column exists, so that joins and
    aggregates on that key read it without a shuffle.  Rows are dealt to
    buckets before they are written: one file a bucket, whatever the input's partitions.
    With ``path`` the files lie there and not in the warehouse.
    """
    if not IDENTIFIER.match(name):
        raise ValueError(f"invalid table name {name!r}")
    bucketed = bool(bucket_by) and bucket_by in df.columns
    w = (df.repartition(buckets, bucket_by) if bucketed else df).write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    if bucketed:
        w = w.bucketBy(buckets, bucket_by).sortBy(*[c for c in sort_by if c in df.columns])
    w.saveAsTable(name)


def write_source_partition(df: DataFrame, root: str, source: str) -> int:
    """K4: per-source clean sink: ``root/source=<s>/`` (partition pruning on read).
    Only the partition of ``source`` is replaced; an empty frame leaves it as it is."""
    w = lambda d: (d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                   .partitionBy("source").parquet(root))
    return _observed_write(df.withColumn("source", F.lit(source)), w)


def write_features(features: DataFrame, root: str, catalog: DataFrame | None = None) -> dict[str, str]:
    """K5: features sorted by id without the split, the split table, the catalogue as JSON."""
    out = {"ml_features": f"{root}/ml_features", "train_test_split": f"{root}/train_test_split"}
    write_parquet(features.drop("split").orderBy("student_id"), out["ml_features"])
    write_parquet(features.select("student_id", "split"), out["train_test_split"])
    if catalog is not None:
        out["feature_metadata"] = f"{root}/feature_metadata"
        catalog.coalesce(1).write.mode("overwrite").json(out["feature_metadata"])  # a few rows
    return out


def write_metrics(folds: DataFrame, summary: DataFrame, root: str, importance: DataFrame | None = None) -> None:
    """K6: fold metrics as CSV with 6 decimals, summary as JSON, importances as CSV."""
    num = [c for c, t in folds.dtypes if t == "double"]
    folds.select(*[F.when(F.col(c).isNotNull(), F.format_string("%.6f", F.col(c))).alias(c) if c in num else F.col(c) for c in folds.columns]) \
        .write.mode("overwrite").option("header", True).csv(f"{root}/fold_metrics")
    summary.write.mode("overwrite").json(f"{root}/summary")
    if importance is not None:
        importance.write.mode("overwrite").option("header", True).csv(f"{root}/importance")


def write_report(report: DataFrame, path: str) -> None:
    """K7: a (small) report DataFrame as JSON lines."""
    report.coalesce(1).write.mode("overwrite").json(path)


def storage_stats(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """K8: rows, columns, total bytes and files of a written dataset.

    Bytes come from the listing of the data files (their contents are not read).
    """
    df = spark.read.format(fmt).option("header", True).load(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
    sizes = files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return rows.crossJoin(sizes).select(
        F.lit(fmt).alias("format"), "rows", F.lit(len(df.columns)).alias("columns"), "files", "bytes")


def compare_formats(spark: SparkSession, csv_path: str, parquet_path: str) -> DataFrame:
    """K8: rows, columns and bytes as CSV and as Parquet, ratio and percent saved."""
    a, b = (storage_stats(spark, path, fmt).select(*[F.col(c).alias(f"{fmt}_{c}") for c in ("rows", "columns", "bytes")])
            for path, fmt in ((csv_path, "csv"), (parquet_path, "parquet")))
    return a.crossJoin(b).select(
                    "csv_rows", "csv_columns", "csv_bytes", "parquet_rows", "parquet_columns", "parquet_bytes",
                    F.round(F.col("parquet_bytes") / F.col("csv_bytes"), 4).alias("ratio"),
                    F.round((1 - F.col("parquet_bytes") / F.col("csv_bytes")) * 100, 2).alias("saved_pct"))
