"""Most frequent values of a column in bounded memory, by combinatorial group testing (problem 4).

Every value is hashed to 64 bits. Each of DEPTH hash rows has WIDTH buckets; a bucket counts its rows and, for each of
the 64 bits, its rows whose hash has the bit set. Where one value has the majority of a bucket, the bits whose count is
above half spell its hash. Sketches add, so each task sends one, whatever it read. Decoded hashes are candidates; a
second scan counts the candidates' values exactly as written, which also settles collisions of hashes.

A value with a share of at least phi is missed only if in each row its bucket's other values outweigh it: by Markov's
inequality at most (1 / (phi * width)) ** DEPTH. The width is the power of two from 10 / phi on, so that is 1e-4 at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entilake.session import cut

DEPTH, BITS = 4, 64
#: Smaller shares are refused: the sketch of a task has DEPTH * 65 counters for each of 10 / share buckets (270 MB here).
LEAST_SHARE = 1e-4
#: Odd multipliers of the hash rows, drawn by a fixed hash.
MULTIPLIERS = [int.from_bytes(hashlib.sha256(b"row %d" % r).digest()[:8], "big") | 1 for r in range(DEPTH)]
_COUNTS = ", ".join(f"b{i} bigint" for i in range(BITS))


def width_bits(share: float) -> int:
    """Bits of the number of buckets a row needs for values of this share."""
    if not LEAST_SHARE <= share <= 1:
        raise ValueError(f"the share must be between {LEAST_SHARE} and 1")
    return max(4, int(np.ceil(np.log2(10 / share))))


def bucket_of(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Bucket of 64-bit hashes in a hash row: the top bits of a multiplication modulo 2^64."""
    with np.errstate(over="ignore"):
        return ((hashes * np.uint64(MULTIPLIERS[row])) >> np.uint64(64 - bits)).astype(np.int64)


def _sketch(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sketch of one task: DEPTH * 65 counters a bucket (4.3 MB at 0.5 %), whatever the number of rows."""
    width = 1 << bits
    counts = np.zeros((DEPTH, width, BITS + 1), dtype=np.int64)
    for batch in batches:
        hashes, n = np.unique(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), return_counts=True)
        weights = n.astype(np.float64)
        ones = ((hashes[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(bool)
        for r in range(DEPTH):
            at = bucket_of(hashes, r, bits)
            counts[r, :, 0] += np.bincount(at, weights, width).astype(np.int64)
            for b in range(BITS):
                set_ = ones[:, b]
                counts[r, :, b + 1] += np.bincount(at[set_], weights[set_], width).astype(np.int64)
    rows, buckets = np.nonzero(counts[:, :, 0])
    if len(rows):
        full = counts[rows, buckets]
        columns = [pa.array(rows.astype(np.int32)), pa.array(buckets.astype(np.int32)), *[pa.array(full[:, i]) for i in range(BITS + 1)]]
        yield pa.RecordBatch.from_arrays(columns, names=["r", "b", "n", *[f"b{i}" for i in range(BITS)]])


def _decode(bits: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Majority hash of each bucket, where it is one that falls into this bucket."""
    for pdf in batches:
        if not len(pdf):
            continue
        n = pdf["n"].to_numpy(np.int64)
        ones = pdf[[f"b{i}" for i in range(BITS)]].to_numpy(np.int64) * 2 > n[:, None]
        h = (ones.astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        r, b = pdf["r"].to_numpy(), pdf["b"].to_numpy(np.int64)
        own = np.zeros(len(pdf), dtype=bool)
        for k in range(DEPTH):
            own |= (r == k) & (bucket_of(h, k, bits) == b)
        yield pd.DataFrame({"h": h.view(np.int64), "r": r, "n": n})[own]


def sketch(df: DataFrame, column: str, share: float) -> DataFrame:
    """The added sketch of a column: (r, b, n, b0..b63), a row per bucket at most. NULLs are not counted."""
    bits = width_bits(share)
    hashes = df.where(F.col(column).isNotNull()).select(F.xxhash64(F.col(column)).alias("h"))
    # A sketch has one size whatever a task reads, so a few long tasks per core send less than many short ones.
    hashes = hashes.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)
    parts = hashes.mapInArrow(lambda batches: _sketch(bits, batches), f"r int, b int, n bigint, {_COUNTS}")
    return parts.groupBy("r", "b").agg(*[F.sum(c).alias(c) for c in ["n", *[f"b{i}" for i in range(BITS)]]])


def candidates(sketched: DataFrame, share: float) -> tuple[DataFrame, int]:
    """(h, approx_count) of the hashes that may belong to values with at least `share` of the rows, and the number of
    rows. A bucket has to hold that many rows, so there are at most DEPTH / share of them. approx_count is the least
    bucket total, never below the true count."""
    bits = width_bits(share)
    decoded = sketched.mapInPandas(lambda batches: _decode(bits, batches), "h bigint, r int, n bigint")
    total = sketched.where("r = 0").agg(F.sum("n")).first()[0] or 0
    found = decoded.where(F.col("n") >= share * total).groupBy("h").agg(F.min("n").alias("approx_count"))
    return found, total


def frequent_values(df: DataFrame, column: str, share: float) -> DataFrame:
    """Values of a column, exactly as written, in at least `share` of the rows that have one, repeats included: column,
    approx_count (from the sketch), exact_count, exact_share. Ties at the limit are all in; an empty column gives an
    empty result. Case, blanks and normal forms are not touched.

    The candidates, at most DEPTH / share, are broadcast; their rows combine before the shuffle, so a value with a third
    of all rows is one row per task."""
    found, total = candidates(cut(sketch(df, column, share)), share)
    few = F.broadcast(found.limit(int(DEPTH / share) + 1))  # the bound, stated for the optimizer; it cuts nothing off
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_value"), F.xxhash64(F.col(column)).alias("h"))
    exact = values.join(few, "h").groupBy("_value").agg(F.count("*").alias("exact_count"), F.max("approx_count").alias("approx_count"))
    kept = exact.where(F.col("exact_count") >= F.lit(share) * F.lit(total))
    return kept.select(F.col("_value").alias(column), "approx_count", "exact_count", (F.col("exact_count") / F.lit(float(total or 1))).alias("exact_share"))
