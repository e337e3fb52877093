"""Scans of the named driver tables.

Every read is a plain ``spark.read.parquet`` so Catalyst prunes columns and
pushes filters into the scan; callers select only what they use.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Parquet scan with an optional column subset; a missing path raises."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise KeyError(f"{name}: columns not found: {missing}")
        df = df.select(*columns)
    return df


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def missing_tables(spark: SparkSession, sf_dir: str, names) -> list[str]:
    """Which of the expected tables are absent (checked via Hadoop FS)."""
    return [n for n in names if not _path_exists(spark, table_path(sf_dir, n))]


def load_tables(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    """Load a named table set; fail listing every missing one."""
    absent = missing_tables(spark, sf_dir, names)
    if absent:
        raise FileNotFoundError(f"missing tables under {sf_dir}: {', '.join(absent)}")
    return {n: read_table(spark, sf_dir, n) for n in names}
