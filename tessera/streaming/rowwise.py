"""Row-local silver operators on Structured Streaming.

Coercion (C1-C3), text cleaning (C4-C6), outlier nulling (C7), renames and
standardisation (C13-C16) and rule tagging (Q16) look at one row at a time,
so they apply unchanged to a streaming DataFrame.  Operators that need a
statistic of the whole table (median fill C8, quantile clip C10, scale
detection C20, keep-first dedup D1) are not streaming operators: they refuse
a streaming input instead of silently computing per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import quality as Q

WHOLE_TABLE_OPERATORS = ("fill_missing", "clip_upper_quantile", "attendance_to_rate", "keep_first")


def clean_rows(df: DataFrame) -> DataFrame:
    """C1 + C4/C5 + C7 and a ``violations``/``disposition`` tag (Q16)."""
    out = C.convert_types(df).transform(C.clean_text).transform(C.null_outliers)
    hard = [Q.Rule("not_null:student_id", "student_id", F.col("student_id").isNotNull()),
            Q.Rule("not_null:name", "name", F.col("name").isNotNull())]
    return Q.quarantine(out, hard, [])


def require_batch(df: DataFrame, operator: str) -> DataFrame:
    """Guard for whole-table operators."""
    if df.isStreaming:
        raise TypeError(f"{operator} needs the whole table; run it on a batch DataFrame")
    return df


def stream_csv_directory(spark, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    """A directory of landed CSV files as a stream (explicit schema, as
    streaming file sources require)."""
    return (spark.readStream.schema(schema).option("header", True)
            .option("maxFilesPerTrigger", max_files_per_trigger).csv(path))


def write_clean_stream(df: DataFrame, sink_path: str, checkpoint: str, trigger_once: bool = True):
    """Clean rows to Parquet with an exactly-once file sink (checkpointed)."""
    w = clean_rows(df).writeStream.format("parquet").option("path", sink_path).option(
        "checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
