"""Validation of a candidate's segment tables against those of a reference: one report over all tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.operators import feeds


def validation_job(candidates: dict[str, DataFrame], references: dict[str, DataFrame], key: str, order: str, skip: list[str]) -> DataFrame:
    """(table, key, status, column, got, expected), of every candidate table.

    NO_TABLE: the reference has no such table. NO_DATA: it has no row of the key. MISMATCH: a cell differs, or one side lacks
    the column. MATCH: none does. Of several rows of a key the last by ``order`` counts. ``skip``: columns that may differ,
    such as the load time; keys that only the reference has are not reported."""
    none = lambda name: F.lit(None).cast("string").alias(name)
    out = []
    for name, found, status in feeds.cmp_tables(candidates, references):
        cand = feeds.last_of_key(candidates[name], key, order)
        if found is None:
            out.append(cand.limit(1).select(F.lit(name).alias("table"), none("key"), F.lit(status).alias("status"), none("column"), none("got"), none("expected")))
            continue
        ref = feeds.last_of_key(references[found], key, order)
        cells = feeds.cmp_columns(cand, ref, key, skip).withColumn("status", F.lit("MISMATCH"))
        rows = feeds.cmp_rows(cand, ref, key)
        # a row a key, and one more for each cell that differs; a key with such a cell doesn't match
        joined = rows.join(cells.select(key, F.col("status").alias("cell"), "column", "got", "expected"), key, "left")
        out.append(joined.select(F.lit(name).alias("table"), F.col(key).cast("string").alias("key"), F.coalesce("cell", "status").alias("status"), "column", "got", "expected"))
    return reduce(DataFrame.unionByName, out)
