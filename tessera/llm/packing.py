"""Packing along a space-filling curve.

A text's byte trigrams are hashed into a count vector, the vector is projected
to ``DIMS`` dimensions and its place on a Hilbert curve is the sort key.
Documents are range-partitioned and sorted by (key, hash of id and text), so neighbours
on the curve stay neighbours and a mass of equal texts still spreads over partitions.
Each partition is tokenised in that order and cut into sequences
of ``length`` ids, so only the last sequence of a partition needs padding.

Ids are those of the named tokenizer file without added special tokens, then id
0.  The same merges are run through tiktoken, which gives equal ids several times
faster; a text that holds a special token's string, or that tiktoken refuses,
goes through tokenizers itself.

Defined cases: a null text counts as empty (one id, 0); null ids are kept;
repeated rows are packed each; other columns are not read.  No rows, no pieces.
"""

from __future__ import annotations

import functools
import json
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMS, LEVELS = 4, 8     # curve: 2^8 cells a side in 4 dimensions
WIDTH = 1024            # components of the hashed vector
LENGTH = 1024
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], dtype=np.uint32)
_SHIFT = np.uint32(32 - WIDTH.bit_length() + 1)


@functools.cache
def _projection() -> np.ndarray:
    return np.random.default_rng(97).standard_normal((WIDTH, DIMS))


def vectors(texts) -> np.ndarray:
    """len(texts) x DIMS in (0, 1): projected unit vectors of hashed byte trigrams."""
    p = _projection()
    out = np.full((len(texts), DIMS), 0.5)
    for i, t in enumerate(texts):
        b = np.frombuffer((t or "").encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
        if len(b) >= 3:
            h = (b[:-2] * _MIX[0] + b[1:-1] * _MIX[1] + b[2:] * _MIX[2]) >> _SHIFT
            v = np.sqrt(np.bincount(h, minlength=WIDTH))
            out[i] = 1 / (1 + np.exp(-1.7 * ((v / np.sqrt(v @ v)) @ p)))
    return out


def hilbert(cells: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Position along the Hilbert curve of integer cells (rows x dims, each < 2^levels)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for q in (1 << k for k in range(levels - 1, 0, -1)):
        low = q - 1
        for d in range(dims):
            turned = (x[d] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for q in (1 << k for k in range(levels - 1, 0, -1)):
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for k in range(levels - 1, -1, -1):
        for d in range(dims):
            out = out << 1 | (x[d] >> k & 1)
    return out


def curve_key(text: pd.Series) -> pd.Series:
    cells = np.minimum((vectors(text) * (1 << LEVELS)).astype(np.int64), (1 << LEVELS) - 1)
    return pd.Series(hilbert(cells))


class Encoder:
    """text -> uint32 ids, equal to those of the tokenizer file."""

    def __init__(self, path: str | None = None):
        import public_tokenizers as P
        import tiktoken

        self.path = path or P.path("byte_bpe_50k.json")
        with open(self.path, encoding="utf-8") as f:
            vocabulary = json.load(f)
        self.special = [t["content"] for t in vocabulary.get("added_tokens", [])]
        # the file writes bytes as printable characters: printable ASCII and Latin-1 as
        # themselves, the rest in order from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in plain)}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary["model"]["vocab"].items() if t not in self.special}
        self.fast = tiktoken.Encoding("file", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = None

    def __call__(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except Exception as e:  # noqa: BLE001  (its own stack limit on a run without spaces)
                if "stack" not in str(e).lower():
                    raise
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


@functools.cache
def encoder(path: str | None) -> Encoder:
    """One per Python worker."""
    return Encoder(path)


def _pack(path: str | None, length: int):
    def run(batches):
        encode = encoder(path)
        base = TaskContext.get().partitionId() << 40
        seq, at = 0, 0
        last_text, last_ids = None, None
        for b in batches:
            rows = []
            for i, t in zip(b["_id"], b["_text"], strict=True):
                if last_ids is None or t != last_text:  # copies are neighbours
                    last_text, last_ids = t, np.append(encode(t), np.uint32(0)).astype("<u4")
                ids, start = last_ids, 0
                while start < len(ids):
                    n = min(length - at, len(ids) - start)
                    rows.append((i, start, n, zlib.crc32(ids[start: start + n].tobytes()), len(ids), base + seq, at))
                    start, at = start + n, at + n
                    if at == length:
                        seq, at = seq + 1, 0
            yield pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, length: int = LENGTH) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    d = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    d = d.withColumn("_key", F.pandas_udf(curve_key, "long")("_text")).withColumn("_tie", F.xxhash64("_id", "_text"))
    d = d.repartitionByRange("_key", "_tie").sortWithinPartitions("_key", "_tie", "_id")
    out = d.select("_id", "_text").mapInPandas(
        _pack(tokenizer, length), f"id {dict(d.dtypes)['_id']}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
