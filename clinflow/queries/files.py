"""Sources and sinks through files: what the given tables hold is written to the shared folder and read back."""

from __future__ import annotations

import os
import sqlite3
import tempfile
import uuid
from contextlib import closing
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.functions.filters import Filter
from clinflow.operators.config import config as held
from clinflow.operators.routing import topic_records
from clinflow.plans.main_job import OUTPUTS, Config, Extract, main_job
from clinflow.queries.base import local, own, sql, types
from clinflow.queries.extracts import AS_OF, MODELS
from clinflow.queries.extracts import STAMP as _STAMP
from clinflow.queries.parsing import _SRC, SUPPORTED, TEMPLATES
from clinflow.queries.reports import _NINE, _REJ, _rejects
from clinflow.registry import query
from clinflow.sources import avro, database, readers, sinks, store
from clinflow.sources.synth import headers, messages, table
from clinflow.streaming import log
from clinflow.streaming.monitor import run_until_idle

#: Partitions of the log that a stream of messages is made of here, and the rate of records that its limited reading is given.
PARTITIONS, RATE = 3, 1600


def shared(spark, name: str) -> str:
    """A new folder below spark.checkpoint.dir; below a local one where that is unset on one machine, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
    return f"{base}/{name}-{uuid.uuid4().hex}"


def _topics(spark, d, rate):
    """Messages as a log of records in PARTITIONS partitions, two loads, streamed until nothing comes: (topic, key, n, batches)."""
    path = shared(spark, "records")
    records = messages(spark, d).select("msg_id", "key", F.col("raw").alias("value"), F.concat(F.lit("T."), F.split_part("key", F.lit(":"), F.lit(1))).alias("topic"))
    for load in (0, 1):
        log.append(records.filter(F.col("msg_id") % 2 == load), f"{path}/in", load, F.floor(F.col("msg_id") / 2) % PARTITIONS)
    stream = log.stream(spark, f"{path}/in", f"{path}/checkpoint", rate).select("key", "topic", "offset")
    batches = run_until_idle(lambda: stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").start(), settings=log.quick(path))
    rows = spark.read.schema("key string, topic string, offset long").parquet(f"{path}/out").groupBy("topic", "key")
    return rows.agg(F.count(F.lit(1)).alias("n")).withColumn("batches", F.lit(batches).cast("long"))


def _counts(batches: str) -> str:
    return sql(f"SELECT 'T.' || typ AS topic, typ || ':RAW:' || t7 || ':' || fac AS key, count(*) AS n, (SELECT {batches} FROM (SELECT count(*) AS n FROM m GROUP BY msg_id // 2 % {PARTITIONS}))::BIGINT AS batches FROM m GROUP BY ALL")


@query("src_message_stream", _counts("max(1)"))
def message_stream(spark, d):
    return _topics(spark, d, None)


@query("src_rate_limit", _counts(f"max(ceil(n / {log.limit_of(RATE)}.0))"))
def rate_limit(spark, d):
    return _topics(spark, d, RATE)


@query("src_sequence_file", sql("SELECT ctrl || '#' || msg_id AS key, mrn || '|' || urn || '|' || acct AS value FROM m"))
def sequence_file(spark, d):
    path = shared(spark, "sequence")
    rows = headers(spark, d).select(F.concat("ctrl", F.lit("#"), "msg_id"), F.concat_ws("|", "mrn", "urn", "acct"))
    rows.rdd.map(tuple).saveAsSequenceFile(path)  # the only writer of this format
    return readers.sequence_file(spark, path)


@query("src_reference_table", """SELECT 'pairs' AS kind, c_custkey::VARCHAR AS key, c_name || '=' || c_mktsegment AS value FROM customer
  UNION ALL SELECT 'set', c_custkey::VARCHAR, c_mktsegment FROM customer UNION ALL SELECT 'keyed', c_custkey::VARCHAR, c_name || '/' || c_mktsegment FROM customer""")
def reference_table(spark, d):
    path, rows = shared(spark, "reference"), table(spark, d, "customer")
    key = F.col("c_custkey").cast("string")
    lines = {
        "pairs": F.concat(key, F.lit(" = "), "c_name", F.lit("="), "c_mktsegment"),
        "set": F.concat_ws(",", key, F.concat(F.lit(" "), "c_mktsegment")),
        "keyed": F.concat_ws(",", key, "c_name", F.concat(F.lit(" "), "c_mktsegment")),
    }
    out = None
    for kind, line in lines.items():
        rows.select(line).write.text(f"{path}/{kind}")
        value = F.array_join("names", "/") if kind == "keyed" else F.col("value")
        part = readers.reference_table(spark, f"{path}/{kind}", kind).select(F.lit(kind).alias("kind"), "key", value.alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


@query("src_template_tables", """SELECT 'STD' AS tpl, p_partkey::VARCHAR AS elem_key, p_brand || '/' || p_size AS names FROM part
  UNION ALL SELECT 'LATE', p_partkey::VARCHAR, p_type || '/' FROM part""")
def template_tables(spark, d):
    path, rows = shared(spark, "templates"), table(spark, d, "part")
    rows.select(F.concat_ws(",", "p_partkey", "p_brand", "p_size")).write.text(f"{path}/std")
    rows.select(F.concat_ws(",", "p_partkey", "p_type", F.lit(""))).write.text(f"{path}/late")
    found = readers.template_tables(spark, {"STD": f"{path}/std", "LATE": f"{path}/late"})
    return found.withColumn("names", F.array_join("names", "/"))


@query("src_extract_requests", """SELECT o_orderkey, 'app' || o_orderpriority[1:1] AS name, 'JSON' AS format, 'k.txt' AS keys, 'OUT' AS destination, 'KAFKA' AS system, true AS ack, o_orderpriority[3:] AS path
  FROM orders UNION ALL SELECT o_orderkey, 'app' || o_orderpriority[1:1], 'JSON', 'k.txt', 'OUT', 'KAFKA', true, 'x|y' FROM orders""")
def extract_requests(spark, d):
    orders = table(spark, d, "orders")
    kinds = [r[0] for r in orders.select("o_orderpriority").distinct().collect()]  # a fixed list of priorities
    asked = [f"{k},ADHOC:app{k[:1]}:JSON&k.txt:OUT&KAFKA:f.txt:a&b:true:T,{k[2:]}^x|y" for k in kinds]
    specs = [(s.type, s.name, s.format, s.keys, s.destination, s.system, s.ack, list(s.paths)) for s in readers.extract_requests(asked)]
    config = local(spark, specs, "o_orderpriority string, name string, format string, keys string, destination string, system string, ack boolean, paths array<string>")
    joined = orders.select("o_orderkey", "o_orderpriority").join(held(config), "o_orderpriority")
    return joined.select("o_orderkey", "name", "format", "keys", "destination", "system", "ack", F.explode("paths").alias("path"))


@query("src_hive_tables", """SELECT 'events_of' AS name, event_type AS kind, count(*) AS n, sum(event_id)::BIGINT AS total FROM events GROUP BY ALL
  UNION ALL SELECT 'orders_of', o_orderstatus, count(*), sum(o_orderkey)::BIGINT FROM orders GROUP BY ALL""")
def hive_tables(spark, d):
    db = f"clinflow_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{shared(spark, db)}'")
    for name, kind, ident in (("events", "event_type", "event_id"), ("orders", "o_orderstatus", "o_orderkey")):
        rows = table(spark, d, name).select(F.col(ident).alias("id"), F.col(kind).alias("kind"))
        rows.write.partitionBy("kind").saveAsTable(f"{db}.{name}_of")
        spark.sql(f"MSCK REPAIR TABLE {db}.{name}_of")
    counts = [df.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("total")).select(F.lit(name).alias("name"), "*") for name, df in sorted(readers.hive_tables(spark, db).items())]
    return counts[0].unionByName(counts[1])


def _database(spark, name: str, ddl: str):
    """An SQLite file in the shared folder (a mounted one), with a table; how to connect to it."""
    path = shared(spark, name)
    place = path.removeprefix("file://")
    os.makedirs(place)
    connect = partial(sqlite3.connect, f"{place}/rows.db", timeout=300)
    with closing(connect()) as connection:
        connection.execute(ddl)
        connection.commit()
    return path, connect


@query("src_jdbc_query", """SELECT c_mktsegment AS segment, count(*) AS n, count(k) AS keys, coalesce(sum(k), 0)::BIGINT AS total, min(name) AS least, 8 AS tasks
  FROM (SELECT CASE WHEN c_custkey % 10 > 0 THEN c_custkey END AS k, c_name AS name, c_mktsegment FROM customer) GROUP BY 1""")
def jdbc_query(spark, d):
    """Customers, a tenth without a key, loaded into a database and read by eight ranges of the key."""
    rows = table(spark, d, "customer").select(F.when(F.col("c_custkey") % 10 > 0, F.col("c_custkey")).alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    path, connect = _database(spark, "read", "CREATE TABLE customers (k INTEGER, name TEXT, segment TEXT)")
    database.load(rows, connect, "customers", f"{path}/staging", f"{path}/failed")
    found = database.ranges(spark, connect, "SELECT k, name, segment FROM customers", "k long, name string, segment string", "k", per_range=1, most=8)
    tasks = found.rdd.getNumPartitions()
    return found.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.count("k").alias("keys"), F.coalesce(F.sum("k"), F.lit(0)).cast("long").alias("total"), F.min("name").alias("least"), F.lit(tasks).alias("tasks"))


@query("out_jdbc_batch", "SELECT c_custkey AS k, c_name AS name, CASE WHEN c_acctbal < 0 OR c_custkey % 97 = 0 THEN 'KEPT' ELSE 'LANDED' END AS state FROM customer")
def jdbc_batch(spark, d):
    """Customers loaded into a table that refuses debts and missing names; what it refuses, and nothing else, is kept."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 97 > 0, F.col("c_name")).alias("name"), F.col("c_acctbal").cast("double").alias("balance"))
    path, connect = _database(spark, "load", "CREATE TABLE customers (k INTEGER PRIMARY KEY, name TEXT NOT NULL, balance REAL CHECK (balance >= 0))")
    database.load(rows, connect, "customers", f"{path}/staging", f"{path}/failed")
    landed = database.ranges(spark, connect, "SELECT k, name FROM customers", "k long, name string", "k", per_range=2000)
    kept = spark.read.parquet(f"{path}/failed").select("k").join(table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), "k")
    return landed.withColumn("state", F.lit("LANDED")).unionByName(kept.withColumn("state", F.lit("KEPT")))


@query("src_roster", "SELECT value, count(*) AS n FROM (SELECT trim(unnest(string_split(text, chr(10))), ' ') AS value FROM documents) WHERE value <> '' GROUP BY 1")
def roster(spark, d):
    path = shared(spark, "roster")
    table(spark, d, "documents").filter("text is not null").select("text").write.text(path)
    return readers.roster(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("src_lines_to_topic", "SELECT 'T.LINES' AS topic, c_custkey || '|' || c_name AS value FROM customer")
def lines_to_topic(spark, d):
    path = shared(spark, "lines")
    table(spark, d, "customer").select(F.concat_ws("|", "c_custkey", "c_name")).write.text(path)
    rows = readers.lines_to_topic(spark, path, "T.LINES").select(F.col("value").alias("line"))
    return topic_records(rows.withColumn("key", F.lit("")), {"line": "T.LINES"}).select("topic", "value")


def _zoned(spark, d):
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, d, "events").select("event_id", F.when(F.col("value") < 50, "LOW").otherwise("HIGH").alias("landing_zone"), F.col("event_type").alias("message_type"), day.alias("transaction_date"))


@query("out_landing_zone", "SELECT event_id, CASE WHEN value < 50 THEN 'LOW' ELSE 'HIGH' END AS landing_zone, event_type AS message_type, strftime(ts, '%Y-%m-%d') AS transaction_date FROM events")
def landing_zone(spark, d):
    path = shared(spark, "landing")
    rows = _zoned(spark, d)
    sinks.landing_zone(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@query("out_avro_rejects", sql(f"SELECT {_NINE} FROM (SELECT msg_id, {_REJ})"))
def avro_rejects(spark, d):
    path = shared(spark, "rejects")
    rows = _rejects(spark, d).drop("msg_id")
    sinks.avro_rejects(rows, path)
    return spark.read.format(avro.register(spark)).load(path)


@query("rej_avro", sql(f"SELECT process_name, count(*) AS n, min(rejected_message_data) AS least, max(msg_create_date_time) AS most FROM (SELECT {_NINE} FROM (SELECT msg_id, {_REJ})) GROUP BY 1"))
def rejects_by_process(spark, d):
    """Rejects of two loads, the second appended, read in short ranges of their files."""
    path, rows = shared(spark, "rejects"), _rejects(spark, d).drop("msg_id")
    for part in (F.col("msg_create_date_time") < "1995", F.col("msg_create_date_time") >= "1995"):
        sinks.avro_rejects(rows.filter(part), path, "null")
    found = spark.read.format(avro.register(spark)).schema(rows.schema).option("rangeBytes", 20_000).load(path)
    return found.groupBy("process_name").agg(F.count(F.lit(1)).alias("n"), F.min("rejected_message_data").alias("least"), F.max("msg_create_date_time").alias("most"))


@query("out_store_upsert", "SELECT o_custkey::VARCHAR AS row_key, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS prio, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) FILTER (o_orderstatus <> 'P') AS status FROM orders GROUP BY 1")
def store_upsert(spark, d):
    """Orders by customer in three loads, each over the one before by time; the store doubles its buckets on the way."""
    rows = table(spark, d, "orders").select("o_custkey", F.col("o_orderpriority").alias("prio"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise(" ").alias("status"), F.struct("o_orderdate", "o_orderkey").alias("ts"))
    year = F.year("ts.o_orderdate") % 3  # not in order of time
    path = shared(spark, "store")
    kept = store.create(spark, path, rows.filter(year == 0), ["o_custkey"], ["prio", "status"], "ts", 4)
    kept = store.upsert(kept, rows.filter(year == 1), ["o_custkey"])
    kept = store.grown(kept, 1 + kept.rows().count() // 8)
    return store.upsert(kept, rows.filter(year == 2), ["o_custkey"]).rows().select("row_key", "prio", "status")


@query("src_store_lookup", "SELECT o_orderkey, c_name AS found_name, c_mktsegment AS found_segment FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def store_lookup(spark, d):
    """Orders looked up in a bucketed store of customers, which is not shuffled."""
    rows = table(spark, d, "customer").filter("c_acctbal > 0").select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.lit(1).alias("ts"))
    kept = store.create(spark, shared(spark, "store"), rows, ["c_custkey"], ["name", "segment"], "ts", 8)
    return store.lookup(table(spark, d, "orders").select("o_orderkey", "o_custkey"), kept, ["o_custkey"]).drop("o_custkey")


@query("out_parquet_dynamic", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey END AS o_custkey, o_orderstatus FROM orders")
def parquet_dynamic(spark, d):
    path = shared(spark, "dynamic")
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    sinks.parquet_dynamic(rows, path, ["o_orderstatus"])
    sinks.parquet_dynamic(rows.filter("o_orderstatus = 'F'").withColumn("o_custkey", F.lit(0).cast("long")), path, ["o_orderstatus"])
    return spark.read.schema(rows.schema).parquet(path)


@query("mon_idle_stop", "SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS total, 2 AS batches FROM events GROUP BY 1")
def idle_stop(spark, d):
    """A stream of events that stops by itself after three looks without a row, and one that goes on from there when more has come."""
    path = shared(spark, "bounded")
    rows = table(spark, d, "events").select("event_id", "event_type")
    batches = 0
    for half in (0, 1):
        rows.filter(F.col("event_id") % 2 == half).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        batches += run_until_idle(lambda s=stream: s.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").start())
    found = spark.read.schema(rows.schema).parquet(f"{path}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("total"))
    return found.withColumn("batches", F.lit(batches))


@query("wh_replace_staging", "SELECT c_custkey::VARCHAR AS c_custkey, upper(c_mktsegment) AS segment FROM customer")
def replace_staging(spark, d):
    path = shared(spark, "staging")
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), F.col("c_mktsegment").alias("segment"))
    rows.write.parquet(f"{path}/target")
    rows.select(F.concat_ws("|", "c_custkey", F.upper("segment"))).write.text(f"{path}/export")
    sinks.replace_staging(spark, f"{path}/export", f"{path}/target", rows.columns)
    return spark.read.schema(rows.schema).parquet(f"{path}/target")


# --- the main job -----------------------------------------------------------------------------------------------------

#: The main job's extract: observations with status F or inpatients.
ASKED = Extract("ORU", "adhoc", (Filter("OBX", "units", "F", "EQUAL", "OR"), Filter("PV1", "patient_class", "I", "EQUAL")), ("id_number", "patient_class", "units"), "DELIMITED", "KAFKA", "T.ADHOC")
MODELLED = [m for m in MODELS if m[1] != "ZZZ"]


def main_config(spark):
    of = lambda rows, schema: local(spark, rows, schema)
    return Config(of(TEMPLATES, "tpl string, elem_key string, names array<string>"), of(SUPPORTED, "src string, ver string, tpl string"), types(spark), of(MODELLED, "type string, seg string, pos int, path string"), (ASKED,))


_VALUE = "CASE WHEN fac = 'F03' THEN 'local_value' WHEN tpl = 'MT6_2.4' THEN 'obsv_value' ELSE 'observation_value' END"
_MAIN = f"""SELECT 'json' AS output, msg_id, typ || ':JSON:' || t7 || ':' || fac AS key, '{{"MSH":{{"sending_facility":"' || fac || '","message_code":"' || typ || '","trigger_event":"' || trig || '","message_control_id":"' || ctrl
    || '"}},"PID":{{"id_code":["MRN","SS"],"id_number":["' || mrn || '","' || ssn || '"],"record_urn":"' || urn || '","' || CASE WHEN src = 'EPIC' THEN 'visit_account' ELSE 'account' END || '":"' || acct || '"}}'
    || CASE WHEN cls = '' THEN '' ELSE ',"PV1":{{"' || CASE WHEN src = 'EPIC' THEN 'class_code' ELSE 'patient_class' END || '":"' || cls || '"}}' END || coalesce(',"OBX":' || o, '') || '}}' AS value
  FROM g LEFT JOIN (SELECT msg_id, CASE WHEN count(*) > 1 THEN '[' ELSE '' END || string_agg('{{"obsv_id":"' || part || '","' || {_VALUE} || '":"' || qty || '","units":"' || st || '"}}', ',' ORDER BY n) || CASE WHEN count(*) > 1 THEN ']' ELSE '' END AS o FROM x JOIN g USING (msg_id) GROUP BY 1) USING (msg_id)
  UNION ALL SELECT 'segment', msg_id, 'SEGMENTS&OBX:' || lpad((4 + n)::VARCHAR, 4, '0'), part || '|' || flag || '|' || qty || '|' || st FROM x JOIN g USING (msg_id) WHERE typ = 'ORU'
  UNION ALL SELECT 'segment', msg_id, 'SEGMENTS&PID:0002', mrn || '^' || ssn || '|MRN^SS|' || fac FROM g WHERE typ = 'ORU'
  UNION ALL SELECT 'segment', msg_id, 'SEGMENTS&PV1:0003', cls FROM g WHERE typ = 'ORU' AND cls <> ''
  UNION ALL SELECT 'extract', msg_id, CASE WHEN passed THEN 'adhoc:T.ADHOC' ELSE 'adhoc:FILTERED' END, CASE WHEN passed THEN mrn || '^' || ssn || '|' || CASE WHEN src = 'EPIC' THEN '' ELSE cls END || '|' || units || '|' || {_STAMP} ELSE '' END
    FROM (SELECT g.*, coalesce(units, '') AS units, coalesce(finals, false) OR (cls = 'I' AND src <> 'EPIC') AS passed FROM g LEFT JOIN (SELECT msg_id, string_agg(st, '^' ORDER BY n) AS units, bool_or(st = 'F') AS finals FROM x GROUP BY 1) USING (msg_id) WHERE typ = 'ORU')
  UNION ALL SELECT 'audit', msg_id, typ || ':AUDIT', concat_ws('|', typ || '-JSON', ctrl, t7, mrn, urn, acct, {_STAMP}) FROM g
  UNION ALL SELECT 'ack', msg_id, 'ACK', concat_ws('|', 'TO', 'FROM', kind, trig, fac, id, t7, CASE WHEN reason IS NULL THEN 'AA' ELSE 'AR' END, {_STAMP}) FROM j
  UNION ALL SELECT 'reject', msg_id, 'REJECT', concat_ws('|', kind || '-JSON', id, t7, mrn, urn, acct, {_STAMP}, reason, text) FROM j WHERE reason IS NOT NULL
  UNION ALL SELECT 'metric', NULL, kind || ':' || CASE WHEN reason IS NULL THEN 'PROCESSED' ELSE 'REJECTED' END, count(*)::VARCHAR FROM j GROUP BY ALL"""
#: A message's text as it was sent, its lines ended by CR.
_TEXT = """'MSH|^~' || chr(92) || '&|CLIN|' || fac || '|RCV|HUB|' || t7 || '||' || typ || '^' || trig || '|' || ctrl || '|P|' || ver || chr(13) || 'PID|1||' || mrn || '^^^' || fac || '^MRN~' || ssn || '^^^^SS|' || urn || '|' || n1 || '^' || n2 || repeat('|', 13) || acct
  || chr(13) || 'PV1|1|' || cls || chr(13) || 'OBR|1|||' || prio || '^text' || coalesce(obx, '')"""
_JUDGED = f"""j AS (SELECT m.*, CASE WHEN typ = 'ORM' THEN 'UNKNOWN' ELSE typ END AS kind, coalesce(nullif(ctrl, ''), 'no message control ID') AS id, CASE WHEN ctrl = '' THEN 'blank control id' WHEN typ = 'ORM' THEN 'UnknownMessageType' END AS reason,
  {own(_TEXT)} AS text
  FROM m LEFT JOIN (SELECT msg_id, string_agg(chr(13) || 'OBX|' || n || '|NM|' || part || '^' || flag || '||' || qty || '|' || st || repeat('|', 8) || ship, '' ORDER BY n) AS obx FROM x GROUP BY 1) USING (msg_id)),
g AS (SELECT j.*, src, tpl FROM j JOIN t USING (msg_id) WHERE reason IS NULL)"""


@query("plan_main_job", sql(f"SELECT output, coalesce(msg_id::VARCHAR, '') AS message, key, value FROM ({_MAIN})", "x", _SRC, _JUDGED))
def plan_main_job(spark, d):
    out = main_job(messages(spark, d), main_config(spark), shared(spark, "main"), F.lit(AS_OF).cast("timestamp"))
    rows = [out[name].select(F.lit(name).alias("output"), F.coalesce(F.col("msg_id").cast("string"), F.lit("")).alias("message"), "key", "value") for name in OUTPUTS]
    return reduce(DataFrame.unionByName, rows)
