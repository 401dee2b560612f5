"""Audit, acknowledgement, reject and metric rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.operators.parse import meta_fast
from clinflow.operators.routing import delimited_row
from clinflow.operators.segments import etl_timestamp

IDS = ["control_id", "create_time", "mrn", "urn", "account"]
MESSAGE_STATES = ["PROCESSED", "FAILED", "REJECTED", "OVERSIZED", "UNKNOWNMAPPING"]
SEGMENT_STATES = ["PROCESSED", "FAILED", "SKIPPED", "INVALID", "FILTERED", "OVERSIZED", "NA", "PARTIAL_REJECT"]
#: Types that answer under another name.
ANSWERS = {"IPLORU": "ORU", "VENTORU": "ORU", "ORMORDERS": "ORM", "IPLORDERS": "ORM"}


def stage_rows(meta: DataFrame, stage: str, detail: str | None, as_of: Column) -> DataFrame:
    """type-stage[:detail] | control | time | mrn | urn | account | now"""
    process = F.concat("type", F.lit(f"-{stage}" + (f":{detail}" if detail else "")))
    cols = {"process_name": process, "msg_control_id": F.col("control_id"), "msg_create_date_time": F.col("create_time"), "patient_mrn": F.col("mrn"), "patient_urn": F.col("urn"), "patient_account_num": F.col("account"), "etl_firstinsert_datetime": etl_timestamp(as_of)}
    return meta.select("msg_id", *[v.alias(k) for k, v in cols.items()])


def segments_in_message(segments: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("seg_seq", "seg")))
    return segments.groupBy("msg_id").agg(F.array_join(F.transform(ordered, lambda x: x["seg"]), "^").alias("segs"))


def ack_rows(meta: DataFrame, state: str, to: str, sender: str, as_of: Column) -> DataFrame:
    kind = F.col("type")
    for name, answer in ANSWERS.items():
        kind = F.when(F.col("type") == name, answer).otherwise(kind)
    cols = [F.lit(to), F.lit(sender), kind, F.col("trigger"), F.regexp_replace("facility", "^eCW_", ""), F.col("control_id"), F.col("create_time"), F.lit(state), etl_timestamp(as_of)]
    return meta.select("msg_id", F.array_join(F.array(*cols), "|", "").alias("row"))


#: What metadata asks of the header beside the common ids, as rules of ``naming.path_lookup``.
HEADER = [("create_time", 1, "MSH", 7, 1, None, None), ("trigger", 1, "MSH", 9, 2, None, None)]


def parsed_meta(ids: DataFrame) -> DataFrame:
    """Metadata of parsed messages: the common ids with time and trigger event of the header, from one look at each message (``HEADER`` among its rules)."""
    return ids.select("msg_id", F.struct(F.col("message_control_id").alias("control_id"), "create_time", F.col("medical_record_num").alias("mrn"), F.col("medical_record_urn").alias("urn"), F.col("patient_account_num").alias("account"), F.col("sending_facility").alias("facility"), "trigger").alias("meta"))


REJECT = ["process_name", "message_control_id", "msg_create_date_time", "patient_mrn", "patient_urn", "patient_account_number", "reject_reason", "rejected_message_data", "etl_firstinsert_datetime"]


def reject_schema() -> str:
    """The Avro schema of a reject: nine strings."""
    return json.dumps({"type": "record", "name": "Reject", "fields": [{"name": n, "type": "string"} for n in REJECT]})


def rejects(meta: DataFrame, stage: str, as_of: Column) -> DataFrame:
    """The nine strings of a reject; ``meta`` has reject_reason and raw."""
    cols = [F.concat("type", F.lit(f"-{stage}")), *map(F.col, IDS), F.col("reject_reason"), F.col("raw"), etl_timestamp(as_of)]
    return meta.select("msg_id", *[c.cast("string").alias(n) for c, n in zip(cols, REJECT, strict=True)])


def rejects_json(df: DataFrame) -> DataFrame:
    return df.select("msg_id", F.to_json(F.struct(*REJECT), {"ignoreNullFields": "false"}).alias("json"))


def rejects_delimited(df: DataFrame) -> DataFrame:
    """In this layout the time stands before the reason."""
    return df.select("msg_id", delimited_row([*REJECT[:6], REJECT[8], *REJECT[6:8]]).alias("row"))


def rejects_from_raw(raw: DataFrame, reason: str, stage: str, as_of: Column) -> DataFrame:
    typed = meta_fast(raw).withColumns({"type": F.split_part("key", F.lit(":"), F.lit(1)), "reject_reason": F.lit(reason)})
    return rejects(typed, stage, as_of)


def state_counts(status: DataFrame, keys: list[str], states: list[str]) -> DataFrame:
    """Counts by keys and state, zero where there is none; one row a key and state, no join."""
    counts = status.groupBy(*keys).agg(*[F.count(F.when(F.col("state") == s, 1)).alias(s) for s in states])
    return counts.unpivot(keys, states, "state", "n")


def merge_snapshots(totals: DataFrame, new: DataFrame, day: str) -> DataFrame:
    """Totals of the day with new counts added; NA is left out; other days are as they were."""
    keys = ["day", "type", "segment", "state"]
    rows = totals.unionByName(new.withColumn("day", F.lit(day).cast("date")).select(*keys, "n")).filter("state <> 'NA'")
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"))


def daily_report(metrics: DataFrame, day: str) -> DataFrame:
    """Counts of a day by type, segment and state, without zeros and without NA that lies at least 100 below what was processed."""
    rows = metrics.filter(F.col("day") == F.lit(day).cast("date")).groupBy("type", "segment", "state").agg(F.sum("n").alias("n"))
    done = rows.filter("state = 'PROCESSED'").groupBy("type").agg(F.max("n").alias("processed"))
    hidden = (F.col("state") == "NA") & (F.col("n") <= F.coalesce("processed", F.lit(0)) - 100)
    return rows.join(done, "type", "left").filter((F.col("n") > 0) & ~hidden).drop("processed").orderBy("type", "segment", "state")


def batch_volume(df: DataFrame, interval: str, ts: str = "ts", topic: str = "topic") -> DataFrame:
    rows = df.groupBy(F.window(ts, interval).alias("w"), F.col(topic).alias("topic")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.col("w.start").alias("start"), "topic", "n")


def no_data(volume: DataFrame, expected: DataFrame, interval: str, patience: int, tiers: list[int], since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Alerts for (topic, window) without messages. ``volume`` (start, topic, n); ``expected`` (topic, slow) is config.
    A slow topic is reported only from its ``patience``-th empty window in a row; the level rises with the run's length.
    Windows start from ``since`` to ``until`` (constants or aggregates of ``volume``), so that silence before the first and after the last message counts; without
    them from the first to the last that any topic has (none where there is no message)."""
    from pyspark.sql import Window

    low, high = (F.min("start") if since is None else since), (F.max("start") if until is None else until)
    bounds = volume.agg(low.alias("low"), high.alias("high"))
    steps = F.sequence(F.col("low").cast("timestamp"), F.col("high").cast("timestamp"), F.expr(f"interval {interval}"))
    one = bounds.select(F.lit(1).alias("one"), F.when(F.col("low") <= F.col("high"), steps).alias("starts"))  # one row
    grid = expected.withColumn("one", F.lit(1)).join(F.broadcast(one), "one").select("topic", "slow", F.explode("starts").alias("start"))
    rows = grid.join(volume, ["start", "topic"], "left").withColumn("empty", F.col("n").isNull())
    w = Window.partitionBy("topic").orderBy("start")
    rows = rows.withColumn("block", F.sum((~F.col("empty")).cast("int")).over(w))
    rows = rows.withColumn("run", F.sum(F.col("empty").cast("int")).over(Window.partitionBy("topic", "block").orderBy("start")))
    alerts = rows.filter(F.col("empty") & (~F.col("slow") | (F.col("run") >= patience)))
    level = F.lit(0)
    for k, least in enumerate(tiers, 1):
        level = F.when(F.col("run") >= least, k).otherwise(level)
    return alerts.select("start", "topic", F.col("run").cast("int").alias("run"), level.alias("level"))
