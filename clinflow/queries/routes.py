"""Sources and sinks that work on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinflow.operators import parse, routing
from clinflow.queries.base import local, sql
from clinflow.registry import query
from clinflow.sources import readers
from clinflow.sources.synth import headers, messages, table

AS_OF = "2024-06-01"


def meta(spark, d):
    return parse.meta_fast(messages(spark, d)).withColumn("type", F.split_part("key", F.lit(":"), F.lit(1)))


@query("src_replay_partitions", "SELECT event_id, strftime(ts, '%Y%m%d') AS day FROM events WHERE strftime(ts, '%Y%m%d') BETWEEN '20240105' AND '20240112'")
def replay_partitions(spark, d):
    rows = table(spark, d, "events").select("event_id", F.date_format("ts", "yyyyMMdd").alias("day"))
    return readers.replay_partitions(rows, "20240105between20240112", "day", AS_OF)


@query("src_replay_batches", sql("SELECT t7 AS batch_ts, count(*) AS n FROM m GROUP BY 1"))
def replay_batches(spark, d):
    raw = messages(spark, d).select(F.col("raw").cast("binary").alias("raw"))
    return readers.replay_batches(raw.unionByName(raw)).groupBy("batch_ts").agg(F.count(F.lit(1)).alias("n"))


@query("src_normalize_newlines", "SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\r\\n]+', chr(13) || chr(10), 'g')) AS sha FROM documents")
def normalize_newlines(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(parse.normalize_newlines(F.coalesce("text", F.lit(""))), 256).alias("sha"))


@query("src_map_queue_to_type", sql("SELECT CASE WHEN typ = 'MDM' THEN NULL ELSE typ END AS type, CASE WHEN typ = 'MDM' THEN 'Cannot Deal with HL7 messages of Q.MDM' END AS reject_reason, count(*) AS n FROM m GROUP BY ALL"))
def map_queue(spark, d):
    mapping = local(spark, [(f"Q.{t}", t, f"T.{t}") for t in ("ADT", "ORU", "ORM")], "source string, type string, topic string")
    ok, bad = routing.map_queue_to_type(messages(spark, d), mapping)
    rows = ok.select("type", F.lit(None).cast("string").alias("reject_reason")).unionByName(bad.select(F.lit(None).cast("string").alias("type"), "reject_reason"))
    return rows.groupBy("type", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query("src_segment_models", "SELECT p_brand AS seg, t.type, u.pos::INT AS pos, u.path FROM (SELECT DISTINCT p_brand FROM part), (VALUES ('ADT'), ('ORU')) t(type), (VALUES (0, 'a|b'), (1, 'c')) u(pos, path) UNION ALL SELECT 'OBX', 'ORU', 0, 'v'")
def segment_models(spark, d):
    every = table(spark, d, "part").select(F.concat(F.lit("ALL,"), "p_brand", F.lit(",a|b^c")).alias("value")).distinct()
    return readers.segment_models(every.unionByName(local(spark, [("ORU,OBX,v",)], "value string")), local(spark, [("ADT",), ("ORU",)], "type string"))


@query("src_keyed_lookup", "SELECT o_orderkey, c_name AS found_c_name, c_mktsegment AS found_c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def keyed_lookup(spark, d):
    store = table(spark, d, "customer").filter("c_acctbal > 0").withColumn("row_key", F.col("c_custkey").cast("string"))
    return readers.keyed_lookup(table(spark, d, "orders"), store, ["o_custkey"], ["c_name", "c_mktsegment"]).select("o_orderkey", "found_c_name", "found_c_mktsegment")


@query("src_family_pairs", "SELECT c_custkey::VARCHAR AS row_key, c_name AS original, c_mktsegment AS replacement FROM customer")
def family_pairs(spark, d):
    store = table(spark, d, "customer").withColumn("row_key", F.col("c_custkey").cast("string"))
    return readers.family_pairs(store, ["c_name"], ["c_mktsegment"]).select("row_key", F.col("original.c_name").alias("original"), F.col("replacement.c_mktsegment").alias("replacement"))


@query("src_random_donors", "SELECT c_custkey::VARCHAR AS row_key, c_name, c_mktsegment FROM customer ORDER BY sha256('7' || chr(31) || c_custkey), row_key LIMIT 100")
def random_donors(spark, d):
    store = table(spark, d, "customer").withColumn("row_key", F.col("c_custkey").cast("string"))
    return readers.random_donors(store, 100, 7).select("row_key", "c_name", "c_mktsegment")


@query("src_delimited_positional", "SELECT c_custkey::VARCHAR AS id, c_name AS name, c_mktsegment AS segment, '' AS missing FROM customer")
def positional(spark, d):
    rows = table(spark, d, "customer").select(routing.delimited_row(["c_custkey", "c_name", "c_mktsegment"]).alias("value"))
    return readers.positional(rows, ["id", "name", "segment", "missing"])


@query("out_routing_key", sql("SELECT msg_id, typ || ':SEGMENTS&OBX:' || t7 || ':' || fac AS key FROM m"))
def routing_key(spark, d):
    return routing.routing_key(meta(spark, d).drop("key"), "SEG", "OBX").select("msg_id", "key")


@query("out_parse_routing_key", sql("SELECT CASE WHEN msg_id % 9 = 0 THEN 'T' ELSE 'RAW' END AS landing_zone, NULL::VARCHAR AS hl7_segment, CASE WHEN msg_id % 9 = 0 THEN 'T' ELSE typ END AS message_type, CASE WHEN msg_id % 9 = 0 THEN '2024-06-01' ELSE t7[1:4] || '-' || t7[5:6] || '-' || t7[7:8] END AS transaction_date, count(*) AS n FROM m GROUP BY ALL"))
def parse_routing_key(spark, d):
    rows = messages(spark, d).withColumns({"key": F.when(F.expr("msg_id % 9 = 0"), "").otherwise(F.col("key")), "topic": F.lit("T")})
    return routing.parse_routing_key(rows, AS_OF).groupBy("landing_zone", "hl7_segment", "message_type", "transaction_date").agg(F.count(F.lit(1)).alias("n"))


@query("out_topic_records", sql("SELECT topic, count(*) AS n FROM (SELECT 'A' AS topic, prio AS v FROM m UNION ALL SELECT 'B', cls FROM m) WHERE v <> '' GROUP BY 1"))
def topic_records(spark, d):
    rows = headers(spark, d).withColumn("key", F.col("msg_id").cast("string"))
    return routing.topic_records(rows, {"prio": "A", "cls": "B"}).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("out_facility_partition", sql("SELECT fac, ((ascii(fac[1]) * 961 + ascii(fac[2]) * 31 + ascii(fac[3])) % 7)::INT AS part, count(*) AS n FROM m GROUP BY ALL"))
def facility_partition(spark, d):
    return routing.facility_partition(headers(spark, d), "fac", 7).groupBy("fac", "part").agg(F.count(F.lit(1)).alias("n"))


@query("out_oversize_split", "SELECT doc_id, length(text) > 5000 AS oversize FROM documents")
def oversize_split(spark, d):
    ok, big = routing.oversize_split(table(spark, d, "documents"), "text", 5000)
    return ok.select("doc_id", F.lit(False).alias("oversize")).unionByName(big.select("doc_id", F.lit(True).alias("oversize")))


@query("out_keyed_upsert", "SELECT o_custkey::VARCHAR AS row_key, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS prio, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) FILTER (o_orderstatus <> 'P') AS status FROM orders GROUP BY 1")
def keyed_upsert(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", F.col("o_orderpriority").alias("prio"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise(" ").alias("status"), F.struct("o_orderdate", "o_orderkey").alias("ts"))
    return routing.keyed_upsert(rows, ["o_custkey"], ["prio", "status"], "ts")


@query("out_store_versions_ttl", "SELECT user_id, event_id FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 3")
def store_versions(spark, d):
    return routing.store_versions(table(spark, d, "events").select("user_id", "ts", "event_id"), ["user_id"], "ts", 3, 20, "2024-01-31").select("user_id", "event_id")


@query("out_delimited_rows", sql("SELECT msg_id, fac || '||' || coalesce(nullif(cls, ''), '') || '|' || prio AS row FROM m"))
def delimited_rows(spark, d):
    rows = headers(spark, d).withColumns({"none": F.lit(None).cast("string"), "cls": F.nullif("cls", F.lit(""))})
    return rows.select("msg_id", routing.delimited_row(["fac", "none", "cls", "prio"]).alias("row"))


@query("out_json_rows", sql("""SELECT msg_id, '{"fac":"' || fac || '","cls":' || CASE WHEN cls = '' THEN 'null' ELSE '"' || cls || '"' END || '}' AS json, '{"fac":"' || fac || '"' || CASE WHEN cls = '' THEN '' ELSE ',"cls":"' || cls || '"' END || '}' AS json_short FROM m"""))
def json_rows(spark, d):
    rows = headers(spark, d).withColumn("cls", F.nullif("cls", F.lit("")))
    return rows.select("msg_id", routing.json_row(["fac", "cls"]).alias("json"), routing.json_row(["fac", "cls"], False).alias("json_short"))


@query("out_mllp_frame", sql("SELECT msg_id, sha256(chr(11) || ctrl || chr(28) || chr(13)) AS sha FROM m"))
def mllp(spark, d):
    return headers(spark, d).select("msg_id", F.sha2(routing.mllp(F.col("ctrl")), 256).alias("sha"))
