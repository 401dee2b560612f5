"""The main job: one stream of messages becomes JSON, segment rows, extracts, audits, acknowledgements, rejects and metrics.

Messages are judged and taken apart once, each in its own row (``operators.inrow``); what comes of that, one row a message with its
header's facts, JSON, segment rows and extracts, is written to ``staging``, and every output reads its columns from there. No element is a row
of its own, so nothing but raw messages is ever shuffled, and only what goes out is stored. Messages are counted by the pass that
writes them; a rejected message keeps its text. Nothing stops the batch.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clinflow.functions.filters import Filter
from clinflow.operators import audit, enrich, inrow, naming, parse
from clinflow.operators.routing import LIMIT, oversize_split, routing_key
from clinflow.plans.parse_job import judged

HEAD = ("type", "control_id", "create_time", "mrn", "urn", "account", "facility", "trigger", "reject_reason")
UNKNOWN = "UNKNOWN"
OUTPUTS = ("json", "oversize", "segment", "extract", "audit", "ack", "reject", "metric")


@dataclass(frozen=True)
class Extract:
    """One extract of a type's messages: filters, the names to project, format and destination."""

    type: str
    name: str
    filters: tuple[Filter, ...]
    names: tuple[str, ...]
    format: str
    system: str
    destination: str


@dataclass(frozen=True)
class Config:
    """The job's tables: templates (tpl, elem_key, names), supported (src, ver, tpl), types (type), models (type, seg, pos, path)."""

    templates: DataFrame
    supported: DataFrame
    types: DataFrame
    models: DataFrame
    extracts: tuple[Extract, ...] = ()
    receiver: str = "TO"
    sender: str = "FROM"
    #: Lines of the crosswalk that realigns fields (column value), the control ids whose account only repeats the record number, and the longest JSON that goes out.
    crosswalk: DataFrame | None = None
    override: str | None = None
    limit: int = LIMIT


def parsed(raw: DataFrame, config: Config, as_of: Column) -> DataFrame:
    """(msg_id, head, held, json, rows, extracts): from one look at each message, which is in one row all the way."""
    raw = raw.repartition("msg_id")  # few large files don't leave the work to few tasks; messages that lie so already are not shuffled
    rows = judged(raw, config.supported).withColumnRenamed("reject_reason", "malformed").drop("type")
    rows = parse.type_from_key(rows, config.types).withColumnRenamed("type", "by_key")
    rows = parse.meta_fast(parse.type_from_body(rows, config.types))
    # a generator of one row, so that the facts are read once: every condition below would take the text apart anew
    facts = ["by_key", "type", "malformed", "reject_reason", *naming.SOURCE, "control_id", "create_time", "mrn", "urn", "account", "facility", "trigger", parse.exchange(F.col("raw")).alias("own")]
    rows = rows.select("msg_id", "raw", F.inline(F.array(F.struct(*facts))))
    kind = F.coalesce("by_key", "type")
    # what has a control id and a type has to name its facility too
    blank = F.when(F.col("facility") == parse.NO_CONTROL, "blank sending_facility")
    reason = F.coalesce("malformed", F.when(kind.isNull(), F.col("reject_reason")), blank)
    rows = rows.withColumns({"type": kind, "reject_reason": reason})
    if config.override:
        repeated = F.col("control_id").rlike(config.override) & (F.col("account") == F.col("urn"))
        rows = rows.withColumn("account", F.when(repeated, parse.NO_CONTROL).otherwise(F.col("account")))
    good = F.col("reject_reason").isNull()
    rules, templates = None, config.templates
    if config.crosswalk is not None:
        rules, names = naming.crosswalk(config.crosswalk)
        templates = templates.unionByName(names)
    told: dict[str, set[str]] = {}
    for x in config.extracts:
        told.setdefault(x.type, set()).update(x.names, (f.path for f in x.filters))
    rows = rows.withColumns({"head": F.struct(*HEAD), "held": F.when(~good, F.col("raw")), "raw": F.when(good, F.col("raw"))})
    rows = inrow.made(rows, inrow.Asked(templates, config.models, rules, told), ["msg_id", "type", "head", "held"])
    none = F.array().cast("array<struct<key: string, value: string>>")

    def extracted(x: Extract) -> Column:
        of = enrich.extract_payloads(F.col("values"), list(x.filters), list(x.names), x.format, x.destination, as_of)
        part = F.transform(of, lambda p: F.struct(F.concat(F.lit(f"{x.name}:"), p["route"]).alias("key"), F.coalesce(p["payload"], F.lit("")).alias("value")))
        return F.when((F.col("type") == x.type) & F.col("json").isNotNull(), part).otherwise(none)

    return rows.select("msg_id", "head", "held", "json", "rows", F.concat(none, *map(extracted, config.extracts)).alias("extracts"))


def observed(rows: DataFrame, types: list[str]) -> tuple[DataFrame, Observation]:
    """``rows`` with counts of their messages by type and state, made by the pass that writes them."""
    counts = Observation(f"messages-{uuid.uuid4().hex}")
    kind, good = F.coalesce("head.type", F.lit(UNKNOWN)), F.col("head.reject_reason").isNull()
    each = {(t, state): (kind == t) & cond for t in [*types, UNKNOWN] for state, cond in (("PROCESSED", good), ("REJECTED", ~good))}
    return rows.observe(counts, *[F.count_if(c).alias(f"{t}:{state}") for (t, state), c in each.items()]), counts


def outputs(rows: DataFrame, config: Config, as_of: Column, counts: dict[str, int]) -> dict[str, DataFrame]:
    """(msg_id, key, value) of every output of ``rows``, which ``parsed`` made; metrics (``counts``) have no message."""
    heads = rows.select("msg_id", "head.*", "held")
    good, bad = heads.filter("reject_reason is null"), heads.filter("reject_reason is not null")
    line = lambda df: F.array_join(F.array(*[F.col(c) for c in df.columns if c != "msg_id"]), "|", "")
    audits = audit.stage_rows(good, "JSON", None, as_of)
    acks = audit.ack_rows(good, "AA", config.receiver, config.sender, as_of).unionByName(audit.ack_rows(bad.withColumn("type", F.coalesce("type", F.lit(UNKNOWN))), "AR", config.receiver, config.sender, as_of))
    rejected = audit.rejects_delimited(audit.rejects(bad.withColumns({"type": F.coalesce("type", F.lit(UNKNOWN)), "raw": F.regexp_replace("held", "[\r\n]+", "\r")}), "JSON", as_of))
    metrics = rows.sparkSession.createDataFrame([(None, key, str(n)) for key, n in sorted(counts.items()) if n], "msg_id long, key string, value string")
    texts = routing_key(rows.filter("json is not null").select("msg_id", "head.*", "json"), "JSON").select("msg_id", "key", F.col("json").alias("value"))
    fit, beyond = oversize_split(texts, "value", config.limit)
    out = {
        "json": fit,
        "oversize": beyond,
        "audit": audits.select("msg_id", F.concat(F.split_part("process_name", F.lit("-"), F.lit(1)), F.lit(":AUDIT")).alias("key"), line(audits).alias("value")),
        "ack": acks.select("msg_id", F.lit("ACK").alias("key"), F.col("row").alias("value")),
        "reject": rejected.select("msg_id", F.lit("REJECT").alias("key"), F.col("row").alias("value")),
        "metric": metrics,
    }
    key = F.concat(F.lit("SEGMENTS&"), "seg", F.lit(":"), F.lpad(F.col("seg_seq").cast("string"), 4, "0"))
    out["segment"] = rows.select("msg_id", F.inline("rows")).select("msg_id", key.alias("key"), F.col("row").alias("value"))
    if config.extracts:
        out["extract"] = rows.select("msg_id", F.inline("extracts"))
    return out


def main_job(raw: DataFrame, config: Config, staging: str, as_of: Column) -> dict[str, DataFrame]:
    """All outputs of a batch; what its messages are made into is written to ``staging`` first."""
    types = [r.type for r in config.types.select("type").distinct().orderBy("type").collect()]  # config
    rows, counts = observed(parsed(raw, config, as_of), types)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(staging)
    return outputs(raw.sparkSession.read.schema(rows.schema).parquet(staging), config, as_of, counts.get)
