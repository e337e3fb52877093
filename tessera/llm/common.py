"""Shared pieces of the training-data operators: tables written to the shared
folder, size-checked broadcasts, grouped streaming over sorted partitions."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

# a broadcast side may hold at most this many rows (of a few dozen bytes each)
BROADCAST_ROWS = 200_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and reread it.

    Cuts the lineage with a copy every executor can read, so a lost executor
    costs a reread and never a recomputation of what stands above.  Shuffle
    files of the write go as soon as it is done: nothing reads them again."""
    return materialise_turns([df], tag)


def materialise_turns(parts: Iterable[DataFrame], tag: str) -> DataFrame:
    """``materialise`` for the union of ``parts`` (one or more, of the same columns), written one after the other:
    only the shuffle files of one of them are on disk at once."""
    path = None
    for df in parts:
        spark = df.sparkSession
        path = path or f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
        before = spark.conf.get(CLEANUP, "false")
        spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("append").parquet(path)
        finally:
            spark.conf.set(CLEANUP, before)
        schema = df.schema
    out = spark.read.schema(schema).parquet(path)
    out._written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``materialise`` once nothing that is still to run reads it."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_to)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def turn_of(turn: int, turns: int, *cols: str) -> Column:
    """Whether a row belongs to the turn, by a hash of ``cols``: every row is in one of ``turns``."""
    return F.pmod(F.xxhash64(*cols), F.lit(turns)) == turn


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (already materialised) with a broadcast hint when it has at most
    ``rows`` rows; otherwise unchanged, and the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_key(col: Column) -> Column:
    """16-byte identity of a text; a null text counts as the empty text."""
    return F.unhex(F.md5(F.coalesce(col, F.lit(""))))


def text_key_bytes(text: str | None) -> bytes:
    """Python twin of :func:`text_key`."""
    return hashlib.md5((text or "").encode("utf-8", "surrogatepass")).digest()


def complete_groups(batches: Iterable[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Yield frames that hold whole groups, from batches sorted by ``key``.

    A group that reaches over a batch boundary is carried to the next frame.
    Callers bound the group size beforehand (see ``graph.block_pairs``)."""
    carry: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        ids = group_starts(b, key)
        if carry and all(carry[-1][k].iloc[-1] == b[k].iloc[0] for k in key):
            if len(ids) == 1:
                carry.append(b)
                continue
            first = b.iloc[: ids[1]]
            yield pd.concat([*carry, first], ignore_index=True)
            carry, b, ids = [], b.iloc[ids[1]:], ids[1:] - ids[1]
        elif carry:
            yield pd.concat(carry, ignore_index=True) if len(carry) > 1 else carry[0]
            carry = []
        if len(ids) > 1:
            yield b.iloc[: ids[-1]].reset_index(drop=True)
        carry = [b.iloc[ids[-1]:].reset_index(drop=True)]
    if carry:
        yield pd.concat(carry, ignore_index=True)


def group_starts(b: pd.DataFrame, key: list[str]) -> np.ndarray:
    """Start offsets of the runs of equal ``key`` in a sorted frame."""
    new = np.zeros(len(b), dtype=bool)
    new[0] = True
    for k in key:
        v = b[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def sorted_groups(df: DataFrame, key: list[str], fn: Callable, schema: str) -> DataFrame:
    """Deal ``df`` out by ``key``, sort inside the partitions and stream whole
    groups through ``fn(frame, starts)``, which yields result frames."""

    def run(batches):
        for b in complete_groups(batches, key):
            yield from fn(b, group_starts(b, key))

    return df.repartition(*key).sortWithinPartitions(*key).mapInPandas(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
