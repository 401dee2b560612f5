"""Routing keys, payload records and keyed stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.operators.config import config

LIMIT = 4_194_304  # fixed value: characters of a record that a topic takes


def routing_key(df: DataFrame, stage: str, seg: str | None = None) -> DataFrame:
    """``key`` = type:stage:time:facility; segments have the stage SEGMENTS&SEG."""
    stage = f"SEGMENTS&{seg}" if seg else stage
    return df.withColumn("key", F.concat_ws(":", F.coalesce("type", F.lit("")), F.lit(stage), F.coalesce("create_time", F.lit("")), F.coalesce("facility", F.lit(""))))


def parse_routing_key(df: DataFrame, as_of: str, key: str = "key", topic: str = "topic") -> DataFrame:
    """landing_zone, hl7_segment, message_type and transaction_date of a key; an unusable date is ``as_of``."""
    parts = F.split(F.coalesce(key, F.lit("")), ":", -1)
    at = lambda n: F.nullif(F.coalesce(F.get(parts, F.lit(n)), F.lit("")), F.lit(""))
    stage, other = at(1), F.coalesce(F.nullif(topic, F.lit("")), F.lit("unknown"))
    return df.withColumns(
        {
            "landing_zone": F.coalesce(F.split_part(stage, F.lit("&"), F.lit(1)), other),
            "hl7_segment": F.when(F.contains(stage, F.lit("&")), F.split_part(stage, F.lit("&"), F.lit(2))),
            "message_type": F.coalesce(at(0), other),
            "transaction_date": F.date_format(F.coalesce(F.try_to_date(F.substring(at(2), 1, 8), "yyyyMMdd"), F.lit(as_of).cast("date")), "yyyy-MM-dd"),
        }
    )


def topic_records(df: DataFrame, payloads: dict[str, str]) -> DataFrame:
    """(key, value, topic): one record for each payload column that has a value."""
    records = F.array(*[F.struct(F.col(c).cast("string").alias("value"), F.lit(t).alias("topic")) for c, t in payloads.items()])
    return df.select("key", F.inline(records)).filter("value is not null and value <> '' and topic <> ''")


def java_hash(text: Column) -> Column:
    """The 32-bit string hash of Java, for ASCII text."""
    wrapped = F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0).cast("long"), lambda h, c: F.pmod(h * 31 + F.ascii(c), F.lit(1 << 32)))
    return F.when(wrapped >= 1 << 31, wrapped - (1 << 32)).otherwise(wrapped)


def facility_partition(df: DataFrame, facility: str, n: int) -> DataFrame:
    """``part``: where a facility's records go; never negative."""
    return df.withColumn("part", F.pmod(java_hash(F.coalesce(facility, F.lit(""))), F.lit(n)).cast("int"))


def oversize_split(df: DataFrame, value: str, limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    big = F.coalesce(F.length(value) > limit, F.lit(False))
    return df.filter(~big), df.filter(big)


def keyed_upsert(df: DataFrame, keys: list[str], attrs: list[str], ts: str) -> DataFrame:
    """The latest value of each attribute under a key; blank values never replace older ones."""
    latest = [F.max_by(F.col(a), F.when(F.coalesce(F.trim(F.col(a)), F.lit("")) != "", F.col(ts))).alias(a) for a in attrs]
    return df.withColumn("row_key", F.concat(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])).groupBy("row_key").agg(*latest)


def store_versions(df: DataFrame, keys: list[str], ts: str, n: int, days: int | None, as_of: str) -> DataFrame:
    """The newest ``n`` versions of a key that are not older than ``days``; the age is tested first, so old rows are not ranked."""
    from pyspark.sql import Window

    if days is not None:
        df = df.filter(F.col(ts) >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days)))
    others = [F.col(c).desc() for c in df.columns if c not in keys and c != ts]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(ts).desc(), *others))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def delimited_row(cols: list[str], delim: str = "|") -> Column:
    """Values in order; NULL is empty, not left out."""
    return F.array_join(F.array(*[F.col(c).cast("string") for c in cols]), delim, "")


def json_row(cols: list[str], keep_nulls: bool = True) -> Column:
    return F.to_json(F.struct(*cols), {"ignoreNullFields": str(not keep_nulls).lower()})


def mllp(message: Column) -> Column:
    return F.concat(F.char(F.lit(11)), message, F.char(F.lit(28)), F.char(F.lit(13)))


def map_queue_to_type(df: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``mapping`` (source, type, topic) is config. (known rows with type and topic, rejects with a reason)."""
    rows = df.join(config(mapping), "source", "left")
    bad = rows.filter("type is null").withColumn("reject_reason", F.concat(F.lit("Cannot Deal with HL7 messages of "), F.coalesce("source", F.lit(""))))
    return rows.filter("type is not null"), bad.drop("type", "topic")
