"""Rows whose value is in a long list: a Bloom filter drops most others before the join.

The filter's bits are made by a grouped aggregation, 10 a value, up to BITS; a list of more values is joined without one. A row
that the filter lets through is judged by a semi join with the list, so the result is that of ``isin``: exact, null is in no list.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bits of a filter at most (64 MB), bits a value, hashes.
BITS, PER_VALUE, HASHES = 1 << 29, 10, 5


def places(h: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The places of 64-bit hashes in a filter, by double hashing."""
    h = h.view(np.uint64) if h.dtype == np.int64 else h
    step = (h >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield (h + np.uint64(k) * step) % np.uint64(bits)


def bits_for(n: int) -> int:
    """Bits of a filter of ``n`` values: a multiple of 64."""
    return max(64, -(-n * PER_VALUE // 64) * 64)


def within(held: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes the filter lets through."""
    there = np.ones(len(h), bool)
    for at in places(h, bits):
        there &= (held[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
    return there


def bloom(values: DataFrame, column: str, bits: int, hashed: Callable[..., Column] = F.xxhash64) -> np.ndarray:
    """The filter as 64-bit words. ``bits``: a multiple of 64. ``hashed``: of a column, 64 bits."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            for at in places(batch.column(0).to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(held, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        word = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(held[word].view(np.int64), pa.int64())], ["word", "bits"])

    found = values.select(hashed(F.col(column)).alias("h")).mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def in_list(df: DataFrame, column: str, values: DataFrame, value: str = "value", most: int = BITS) -> DataFrame:
    """``df``'s rows whose ``column`` is among ``values``' column ``value``; same columns."""
    side = values.select(F.col(value).cast(df.schema[column].dataType).alias("_value")).filter("_value is not null")
    bits = bits_for(side.count())
    rows = df.filter(F.col(column).isNotNull())
    if bits <= most:
        held = df.sparkSession.sparkContext.broadcast(bloom(side, "_value", bits))

        @F.pandas_udf("boolean")
        def maybe(hashes: pd.Series) -> pd.Series:
            return pd.Series(within(held.value, hashes.to_numpy(), bits))

        rows = rows.filter(maybe(F.xxhash64(F.col(column))))
    return rows.join(side, F.col(column) == F.col("_value"), "left_semi")
