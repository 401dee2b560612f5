"""Batch and streaming sources."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.operators import parse
from clinflow.operators.config import config_hint


def message_stream(spark: SparkSession, fmt: str, options: dict[str, str], schema: str | None = None, path: str | None = None) -> DataFrame:
    """(key, value, topic) from Kafka, or from a folder of text or parquet files."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    cols = {c: F.col(c).cast("string") for c in ("key", "value", "topic") if c in df.columns}
    return df.select(*[cols.get(c, F.lit(None).cast("string")).alias(c) for c in ("key", "value", "topic")])


def rate_limit(fmt: str, rate: int, partitions: int = 1) -> dict[str, str]:
    """Options that hold a stream to ``rate`` and an eighth of it for each partition: Kafka counts over all partitions, a record log in each. Files count as whole."""
    most = rate + rate // 8
    if fmt == "record_log":
        return {"limit": str(most)}
    return {"maxOffsetsPerTrigger": str(most * partitions)} if fmt == "kafka" else {"maxFilesPerTrigger": str(max(1, most * partitions))}


def replay_partitions(df: DataFrame, spec: str, col: str, as_of: str) -> DataFrame:
    """Archive partitions by a date specification: AbetweenB, greaterThanD (D to ``as_of``), greaterX, N>=, * or an exact name."""
    c = F.col(col).cast("string")
    if spec == "*":
        return df
    if "between" in spec:
        low, high = spec.split("between")
        return df.filter(c.between(low, high))
    if spec.startswith("greaterThan"):
        return df.filter(c.between(spec.removeprefix("greaterThan"), as_of))
    if spec.startswith("greater"):
        return df.filter(c >= spec.removeprefix("greater"))
    if found := re.fullmatch(r"(\d+)>=(\d*)", spec):
        n = F.expr(f"try_cast(`{col}` as bigint)")
        df = df.filter(n >= int(found[1]))
        return df.filter(n <= int(found[2])) if found[2] else df
    return df.filter(c == spec)


def replay_batches(df: DataFrame) -> DataFrame:
    """(batch_ts, raw): the archive's first column as text, by the header's time; a batch holds a message once."""
    raw = F.col(df.columns[0]).cast("string")
    rows = df.select(raw.alias("raw")).select(parse.part(F.get(parse.lines(F.col("raw")), F.lit(0)), 6, parse.separators(F.col("raw"))).alias("batch_ts"), "raw")
    return rows.dropDuplicates(["batch_ts", "raw"])


def sequence_file(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of sequence files of text; the only way in is Spark's file reader, one element a record."""
    pairs = spark.sparkContext.sequenceFile(path, keyClass="org.apache.hadoop.io.Text", valueClass="org.apache.hadoop.io.Text")
    return spark.createDataFrame(pairs, "key string, value string")


def reference_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Config files: ``pairs`` (key=value), ``set`` (ordered pairs k,v) or ``keyed`` (key and an array of the rest)."""
    lines = spark.read.text(path).withColumn("pos", F.monotonically_increasing_id()).filter("trim(value) <> ''")
    if kind == "pairs":
        return lines.select(F.trim(F.split_part("value", F.lit("="), F.lit(1))).alias("key"), F.trim(F.regexp_replace("value", "^[^=]*=?", "")).alias("value"))
    parts = F.split("value", ",", -1)
    if kind == "set":
        return lines.select("pos", F.trim(F.get(parts, F.lit(0))).alias("key"), F.trim(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).alias("value"))
    return lines.select(F.trim(F.get(parts, F.lit(0))).alias("key"), F.transform(F.slice(parts, 2, F.size(parts)), lambda x: F.trim(x)).alias("names"))


def template_tables(spark: SparkSession, index: dict[str, str]) -> DataFrame:
    """(tpl, elem_key, names) of all templates that an index names."""
    parts = [reference_table(spark, path, "keyed").select(F.lit(tpl).alias("tpl"), F.col("key").alias("elem_key"), "names") for tpl, path in index.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def segment_models(lines: DataFrame, types: DataFrame) -> DataFrame:
    """(type, seg, pos, path) of lines ``TYPE,SEGMENT,path^path``; those of ALL hold for every type in ``types``, a small config list."""
    parts = F.split("value", ",", 3)
    rows = lines.select(F.get(parts, F.lit(0)).alias("type"), F.get(parts, F.lit(1)).alias("seg"), F.posexplode(F.split(F.get(parts, F.lit(2)), r"\^")).alias("pos", "path"))
    every = config_hint(types)(types.select(F.collect_set("type").alias("types")))
    shared = rows.filter("type = 'ALL'").drop("type").withColumn("one", F.lit(1)).join(every.withColumn("one", F.lit(1)), "one").select(F.explode("types").alias("type"), "seg", "pos", "path")
    return rows.filter("type <> 'ALL'").unionByName(shared)


@dataclass(frozen=True)
class ExtractSpec:
    type: str
    name: str
    format: str
    keys: str = ""
    destination: str = ""
    system: str = ""
    filters: str = ""
    first_only: tuple[str, ...] = ()
    ack: bool = False
    transform: str = ""
    paths: tuple[str, ...] = field(default=())


def extract_requests(lines: list[str]) -> list[ExtractSpec]:
    """TYPE,ADHOC:app:FORMAT&keys:dest&SYS:filters:noappend&..:ack:TRANSFORM&variant,path^path"""
    out = []
    for line in filter(None, map(str.strip, lines)):
        kind, ask, paths = (line.split(",", 2) + ["", ""])[:3]
        _, app, fmt, dest, filters, first, ack, transform = (ask.split(":") + [""] * 8)[:8]
        (form, _, keys), (to, _, system) = fmt.partition("&"), dest.partition("&")
        out.append(ExtractSpec(kind, app, form, keys, to, system, filters, tuple(filter(None, first.split("&"))), ack.lower() == "true", transform, tuple(filter(None, paths.split("^")))))
    return out


def hive_tables(spark: SparkSession, db: str) -> dict[str, DataFrame]:
    """The tables of a database by name; the catalog also lists the session's temporary views, which are in no database."""
    return {t.name: spark.table(f"{db}.{t.name}") for t in spark.catalog.listTables(db) if not t.isTemporary}


def jdbc_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """In one task; ``database.jdbc_ranges`` and ``database.ranges`` read by ranges of a key."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def row_key(cols: list[str]) -> Column:
    return F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def keyed_lookup(df: DataFrame, store: DataFrame, key_cols: list[str], attrs: list[str]) -> DataFrame:
    side = store.select(F.col("row_key").alias("_key"), *[F.col(a).alias(f"found_{a}") for a in attrs])
    return df.withColumn("_key", row_key(key_cols)).join(side, "_key", "left").drop("_key")


def family_pairs(store: DataFrame, first: list[str], second: list[str]) -> DataFrame:
    """Two column families of a store, side by side."""
    return store.select("row_key", F.struct(*first).alias("original"), F.struct(*second).alias("replacement"))


def random_donors(store: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` rows, the same for the same seed."""
    return store.orderBy(F.sha2(F.concat_ws("\x1f", F.lit(str(seed)), "row_key"), 256), "row_key").limit(n)


def roster(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("value")).filter("value <> ''")


def positional(df: DataFrame, cols: list[str], line: str = "value") -> DataFrame:
    parts = F.split(line, r"\|", -1)
    return df.select(*[F.coalesce(F.get(parts, F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(cols)])


def lines_to_topic(spark: SparkSession, path: str, topic: str) -> DataFrame:
    return spark.read.text(path).select("value", F.lit(topic).alias("topic"))
