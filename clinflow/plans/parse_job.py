"""Raw messages to accepted elements, rejects and missing mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.operators import naming, parse


def judged(raw: DataFrame, supported: DataFrame) -> DataFrame:
    """``raw`` with type, reject_reason (NULL: accepted) and its source's facts; all from the message's own text."""
    checked = parse.reject_malformed(raw).withColumnRenamed("reject_reason", "malformed")
    heads = F.size(F.filter(parse.lines(F.col("raw")), lambda x: x.startswith("MSH")))
    reason = F.coalesce("malformed", F.when(heads > 1, "more than one MSH segment"))
    kind = parse.component(parse.part(F.get(parse.lines(F.col("raw")), F.lit(0)), 8, parse.separators(F.col("raw"))), 1, parse.separators(F.col("raw")))
    return naming.with_source(checked.withColumns({"reject_reason": reason, "type": kind}).drop("malformed"), supported)


def parse_job(raw: DataFrame, templates: DataFrame, supported: DataFrame) -> DataFrame:
    """(msg_id, type, state, reject_reason, missing_keys, n_elements): one row a message, from one look at the text. Nothing stops the batch.

    A rejected message goes on as its first line alone, so that it keeps a row without being taken apart."""
    rows = judged(raw, supported)
    rows = rows.withColumn("raw", F.when(F.col("reject_reason").isNull(), F.col("raw")).otherwise("REJ|rejected"))
    named = naming.name_elements(parse.elements(rows, keep=("type", "reject_reason", *naming.SOURCE), filled=True), templates)
    taken = F.col("reject_reason").isNull() & F.col("value").isNotNull()
    out = named.groupBy("msg_id").agg(
        F.first("type").alias("type"),
        F.first("reject_reason").alias("reject_reason"),
        F.array_join(F.array_sort(F.collect_set(F.when(taken & (F.col("name") == "unknown"), F.col("elem_key")))), ",").alias("missing_keys"),
        F.count(F.when(taken, 1)).alias("n_elements"),
    )
    return out.select("msg_id", "type", F.when(F.col("reject_reason").isNull(), "PROCESSED").otherwise("REJECTED").alias("state"), "reject_reason", F.nullif("missing_keys", F.lit("")).alias("missing_keys"), "n_elements")
