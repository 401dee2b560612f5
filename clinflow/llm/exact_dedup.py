"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every partition sorts the 64-bit fingerprints of its texts, cuts them by owner (a range of fingerprints), and
   sends each owner the gaps between them, Golomb-Rice coded.
2. An owner decodes what it got, finds the fingerprints that occur more than once, and sends every partition a bitmap
   with one bit for each fingerprint that it had sent.
3. The partitions read the bitmaps; only texts whose bit is set (suspects) are shuffled, and compared byte by byte.

Of equal texts the row with the largest id stays. Null text counts as empty; a null id is the smallest; of rows that
are equal in id and text one stays. Texts of any length are hashed and compared whole. An empty table gives an empty
result. Other columns are not read; drop_copies hands them on, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import by_value, cut, measured, own_columns, shuffle_partitions, spare, text_or_empty

by_value(__name__)

#: Fingerprints that one owner is to hold, about; there are at least as many owners as shuffle partitions, and no more senders than owners.
PER_OWNER = 1 << 22
#: Fingerprints of a message, on average, at least: owners hold more where the messages would grow too many and too short.
PER_MESSAGE = 1 << 10
#: What owners hold then, at most (about 1 GB of a worker); beyond it messages grow shorter.
MOST = 1 << 24


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct uint64 values as gaps: quotients in unary, remainders of k bits, k from the mean gap."""
    n = len(values)
    gaps = np.diff(values, prepend=np.uint64(0))
    k = max(0, int(math.log2(max(1.0, float(values[-1]) / n * math.log(2))))) if n else 0
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + n, np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    bits = np.unpackbits(gaps.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)[:, 64 - k :]
    head = np.array([n, k, len(unary)], "<u4").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(bits.ravel()).tobytes()


def golomb_decode(blob: bytes) -> np.ndarray:
    n, k, length = (int(x) for x in np.frombuffer(blob[:12], "<u4"))
    size = (length + 7) // 8
    unary = np.unpackbits(np.frombuffer(blob[12 : 12 + size], np.uint8))[:length]
    quotients = np.diff(np.flatnonzero(unary), prepend=-1) - 1
    bits = np.zeros((n, 64), np.uint8)
    if k:
        bits[:, 64 - k :] = np.unpackbits(np.frombuffer(blob[12 + size :], np.uint8))[: n * k].reshape(n, k)
    remainders = np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return np.cumsum((quotients.astype(np.uint64) << np.uint64(k)) + remainders, dtype=np.uint64)


def _send(owners: int):
    """The messages of a partition: one for each owner, with its distinct fingerprints and a bit for those it holds twice."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        src, parts = None, []
        for batch in batches:
            if batch.num_rows:
                src = batch.column(0)[0].as_py()
                parts.append(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
        if not parts:
            return
        hashes, counts = np.unique(np.concatenate(parts), return_counts=True)
        owner = ((hashes >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
        edges = np.flatnonzero(np.diff(owner, prepend=owner[0] + np.uint64(1)))
        rows: list[tuple] = []
        for lo, hi in zip(edges, [*edges[1:], len(hashes)], strict=True):
            rows.append((int(owner[lo]), src, golomb_encode(hashes[lo:hi]), np.packbits(counts[lo:hi] > 1).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
            names=["owner", "src", "blob", "twice"],
        )

    return send


def _answer(group: pa.Table) -> pa.Table:
    """An owner's bitmaps: which of a partition's fingerprints are there elsewhere, or twice in itself."""
    sent = [golomb_decode(x) for x in group.column("blob").to_pylist()]
    values, counts = np.unique(np.concatenate(sent), return_counts=True)
    often = values[counts > 1]
    bitmaps = []
    for mine, twice in zip(sent, group.column("twice").to_pylist(), strict=True):
        local = np.unpackbits(np.frombuffer(twice, np.uint8))[: len(mine)].astype(bool)
        at = np.minimum(np.searchsorted(often, mine), max(0, len(often) - 1))
        found = often[at] == mine if len(often) else np.zeros(len(mine), bool)
        bitmaps.append(np.packbits(local | found).tobytes())
    return pa.table({"owner": group.column("owner"), "src": group.column("src"), "bitmap": pa.array(bitmaps, pa.binary())})


def _suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.zeros(0, np.uint64)]
        for blob, bitmap in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            mine = golomb_decode(blob)
            found.append(mine[np.unpackbits(np.frombuffer(bitmap, np.uint8))[: len(mine)].astype(bool)])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["h"])


def per_owner(rows: int) -> int:
    """Fingerprints that one owner is to hold: with rows / n owners and as many senders, a message has n * n / rows of them."""
    return max(PER_OWNER, min(MOST, math.isqrt(PER_MESSAGE * rows)))


def suspect_fingerprints(hashes: DataFrame, rows: int) -> DataFrame:
    """Distinct fingerprints that occur more than once in column ``h``, by the exchange; ``rows``: how many there are, about.

    Small partitions are taken together, so that there are owners * owners messages at most, not one for each owner and file part."""
    owners = max(shuffle_partitions(hashes.sparkSession), math.ceil(rows / per_owner(rows)))
    messages = cut(
        hashes.coalesce(owners).select(F.spark_partition_id().cast("long").alias("src"), "h").mapInArrow(_send(owners), "owner long, src long, blob binary, twice binary")
    )
    bitmaps = messages.groupBy("owner").applyInArrow(_answer, "owner long, src long, bitmap binary")
    return messages.join(bitmaps, ["owner", "src"]).select("blob", "bitmap").mapInArrow(_suspect, "h long").distinct()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t")).withColumn("h", F.xxhash64("t"))
    suspects = measured(cut(suspect_fingerprints(rows.select("h"), docs.count())).withColumn("again", F.lit(True)))
    flagged = rows.join(suspects, "h", "left").select("id", "t", "h", F.coalesce("again", F.lit(False)).alias("again"))
    again = flagged.filter("again")
    # the bytes: texts of one fingerprint are grouped by the whole text, first within each task
    groups = again.groupBy("h", "t").agg(F.count(F.lit(1)).alias("n")).select("h", F.sha2("t", 256).alias("sha"), "n")
    groups = groups.groupBy("h", "sha").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    groups = groups.select("h", "sha", F.when(F.col("texts") == 1, F.col("n")).otherwise(F.raise_error(F.lit("two texts have one SHA-256"))).alias("n"))
    members = cut(again.select("id", "h", F.sha2("t", 256).alias("sha"), F.monotonically_increasing_id().alias("rid")))
    best = members.groupBy("h", "sha").agg(F.max(F.struct("id", "rid")).alias("best"))
    stays = measured(cut(best.join(groups, ["h", "sha"])))
    copies = members.join(stays, ["h", "sha"]).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    alone = flagged.filter("not again").select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.sha2("t", 256).alias("text_sha256")
    )
    return alone.unionByName(copies)


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that exact_duplicates drops; same columns."""
    keys = docs.select(F.xxhash64(text_or_empty()).alias("h"))
    h, again = spare(docs, "h", "again")
    suspects = measured(cut(suspect_fingerprints(keys, docs.count())).select(F.col("h").alias(h), F.lit(True).alias(again)))
    flagged = docs.withColumn(h, F.xxhash64(text_or_empty())).join(suspects, h, "left")
    names = own_columns(docs)
    alone = flagged.filter(F.col(again).isNull()).select(*names)
    # max_by over whole rows needs no join: of equal texts, the row with the largest id comes through
    row = F.struct(F.col("doc_id").alias("id"), F.struct(*names).alias("row"))
    best = flagged.filter(F.col(again)).select(F.col(h).alias("h"), text_or_empty().alias("t"), row.alias("r")).groupBy("h", "t").agg(F.max_by("r", F.struct("r.id")).alias("best"))
    return alone.unionByName(best.select("best.row.*"))
