"""Audit and metrics, de-identification, result feed, roster forwarding, warehouse and comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinflow.functions import scrub
from clinflow.operators import audit, deid, feeds, names, parse
from clinflow.plans.validation import validation_job
from clinflow.queries.base import local, own, sql
from clinflow.queries.parsing import _META, common
from clinflow.queries.routes import meta
from clinflow.registry import query
from clinflow.sources.synth import headers, messages, table

AS_OF, STAMP = "2024-06-01 12:34:56.789", "'202406011234560000789'"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


@query("aud_stage_rows", sql(f"SELECT msg_id, typ || '-SEG:OBX' AS process_name, coalesce(nullif(ctrl, ''), 'no message control ID') AS msg_control_id, t7 AS msg_create_date_time, mrn AS patient_mrn, urn AS patient_urn, acct AS patient_account_num, {STAMP} AS etl_firstinsert_datetime FROM m"))
def aud_stage_rows(spark, d):
    return audit.stage_rows(meta(spark, d), "SEG", "OBX", as_of())


@query("aud_segments_in_message", sql("SELECT msg_id, 'MSH^PID^PV1^OBR' || repeat('^OBX', count(n)::INT) AS segs FROM m LEFT JOIN x USING (msg_id) GROUP BY 1", "x"))
def aud_segments_in_message(spark, d):
    return audit.segments_in_message(parse.split_segments(messages(spark, d)))


@query("aud_ack_rows", sql(f"SELECT msg_id, 'TO|FROM|' || CASE typ WHEN 'MDM' THEN 'ORU' ELSE typ END || '|' || trig || '|' || fac || '|' || coalesce(nullif(ctrl, ''), 'no message control ID') || '|' || t7 || '|AA|' || {STAMP} AS row FROM m"))
def aud_ack_rows(spark, d):
    rows = meta(spark, d).withColumns({"type": F.when(F.col("type") == "MDM", "IPLORU").otherwise(F.col("type")), "facility": F.concat(F.lit("eCW_"), "facility")})
    return audit.ack_rows(rows, "AA", "TO", "FROM", as_of())


@query("aud_meta", sql("SELECT msg_id, nullif(ctrl, '') AS control_id, t7 AS create_time, mrn, urn, acct AS account, fac AS facility, trig AS trigger FROM m"))
def aud_meta(spark, d):
    return audit.parsed_meta(common(spark, d, audit.HEADER)).select("msg_id", "meta.*")


def _rejects(spark, d):
    rows = meta(spark, d).filter(F.col("control_id") == parse.NO_CONTROL).withColumns({"reject_reason": F.lit("blank control id"), "raw": F.col("facility")})
    return audit.rejects(rows, "RAW", as_of())


_REJ = "typ || '-RAW' AS a, 'no message control ID' AS b, t7, mrn, urn, acct, fac FROM m WHERE ctrl = ''"


@query("rej_json", sql(f"""SELECT msg_id, '{{"process_name":"' || a || '","message_control_id":"' || b || '","msg_create_date_time":"' || t7 || '","patient_mrn":"' || mrn || '","patient_urn":"' || urn || '","patient_account_number":"' || acct || '","reject_reason":"blank control id","rejected_message_data":"' || fac || '","etl_firstinsert_datetime":"' || {STAMP} || '"}}' AS json FROM (SELECT msg_id, {_REJ})"""))
def rej_json(spark, d):
    return audit.rejects_json(_rejects(spark, d))


@query("rej_delimited", sql(f"SELECT msg_id, concat_ws('|', a, b, t7, mrn, urn, acct, {STAMP}, 'blank control id', fac) AS row FROM (SELECT msg_id, {_REJ})"))
def rej_delimited(spark, d):
    return audit.rejects_delimited(_rejects(spark, d))


_NINE = f"a AS process_name, b AS message_control_id, t7 AS msg_create_date_time, mrn AS patient_mrn, urn AS patient_urn, acct AS patient_account_number, 'blank control id' AS reject_reason, fac AS rejected_message_data, {STAMP} AS etl_firstinsert_datetime"


@query("rej_from_raw", sql(f"SELECT msg_id, typ || '-RAW' AS process_name, {_META.split(' AS control_id')[0]} AS message_control_id, 'bad' AS reject_reason FROM m"))
def rej_from_raw(spark, d):
    return audit.rejects_from_raw(messages(spark, d), "bad", "RAW", as_of()).select("msg_id", "process_name", "message_control_id", "reject_reason")


def _status(spark, d):
    state = F.when(F.expr("msg_id % 101 = 0"), "REJECTED").when(F.expr("msg_id % 13 = 0"), "UNKNOWNMAPPING").otherwise("PROCESSED")
    return headers(spark, d).select(F.substring("type9", 1, 3).alias("type"), F.lit("OBX").alias("segment"), state.alias("state"))


_ST = "SELECT typ AS type, 'OBX' AS segment, CASE WHEN ctrl = '' THEN 'REJECTED' WHEN msg_id % 13 = 0 THEN 'UNKNOWNMAPPING' ELSE 'PROCESSED' END AS state FROM m"


@query("met_message_states", sql(f"SELECT type, s AS state, count(*) FILTER (state = s) AS n FROM ({_ST}), (VALUES ('PROCESSED'), ('FAILED'), ('REJECTED'), ('OVERSIZED'), ('UNKNOWNMAPPING')) v(s) GROUP BY ALL"))
def met_message_states(spark, d):
    return audit.state_counts(_status(spark, d), ["type"], audit.MESSAGE_STATES)


@query("met_segment_states", sql(f"SELECT type, segment, s AS state, count(*) FILTER (state = s) AS n FROM ({_ST}), (VALUES ('PROCESSED'), ('FAILED'), ('SKIPPED'), ('INVALID'), ('FILTERED'), ('OVERSIZED'), ('NA'), ('PARTIAL_REJECT')) v(s) GROUP BY ALL"))
def met_segment_states(spark, d):
    return audit.state_counts(_status(spark, d), ["type", "segment"], audit.SEGMENT_STATES)


def _metrics(spark, d):
    counts = _status(spark, d).groupBy("type", "segment", "state").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("day", F.lit("2024-06-01").cast("date")), counts


@query("met_merge_snapshots", sql(f"SELECT '2024-06-01' AS day, *, 2 * count(*) AS n FROM ({_ST}) GROUP BY ALL"))
def met_merge_snapshots(spark, d):
    totals, new = _metrics(spark, d)
    return audit.merge_snapshots(totals.select("day", "type", "segment", "state", "n"), new, "2024-06-01").withColumn("day", F.col("day").cast("string"))


@query("met_daily_report", sql(f"SELECT *, count(*) AS n FROM ({_ST}) GROUP BY ALL"))
def met_daily_report(spark, d):
    return audit.daily_report(_metrics(spark, d)[0], "2024-06-01")


@query("mon_batch_volume", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type AS topic, count(*) AS n FROM events GROUP BY ALL")
def mon_batch_volume(spark, d):
    return audit.batch_volume(table(spark, d, "events"), "1 hour", topic="event_type")


@query("mon_no_data", """WITH v AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type AS topic, count(*) AS n FROM events GROUP BY ALL),
  t AS (SELECT DISTINCT event_type AS topic FROM events UNION ALL SELECT 'never'),
  g AS (SELECT unnest(generate_series(min(start), max(start), INTERVAL 1 HOUR)) AS start FROM v), r AS (SELECT g.start, t.topic, n, count(n) OVER (PARTITION BY t.topic ORDER BY g.start) AS block FROM g, t LEFT JOIN v ON v.start = g.start AND v.topic = t.topic),
  k AS (SELECT *, count(*) FILTER (n IS NULL) OVER (PARTITION BY topic, block ORDER BY start)::INT AS run FROM r)
  SELECT start, topic, run, CASE WHEN run >= 6 THEN 2 WHEN run >= 3 THEN 1 ELSE 0 END AS level FROM k WHERE n IS NULL AND (topic <> 'never' OR run >= 4)""")
def mon_no_data(spark, d):
    events = table(spark, d, "events")
    kinds = events.select(F.col("event_type").alias("topic")).distinct().withColumn("slow", F.lit(False)).unionByName(local(spark, [("never", True)], "topic string, slow boolean"))
    return audit.no_data(audit.batch_volume(events, "1 hour", topic="event_type"), kinds, "1 hour", 4, [3, 6])


@query("mon_no_data_until", """WITH v AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type AS topic, count(*) AS n FROM events GROUP BY ALL),
  t AS (SELECT DISTINCT event_type AS topic FROM events UNION ALL SELECT 'never'),
  g AS (SELECT unnest(generate_series(min(start) - INTERVAL 2 DAY, max(start) + INTERVAL 4 DAY, INTERVAL 1 DAY)) AS start FROM v), r AS (SELECT g.start, t.topic, n, count(n) OVER (PARTITION BY t.topic ORDER BY g.start) AS block FROM g, t LEFT JOIN v ON v.start = g.start AND v.topic = t.topic),
  k AS (SELECT *, count(*) FILTER (n IS NULL) OVER (PARTITION BY topic, block ORDER BY start)::INT AS run FROM r)
  SELECT start, topic, run, CASE WHEN run >= 4 THEN 2 WHEN run >= 2 THEN 1 ELSE 0 END AS level FROM k WHERE n IS NULL AND (topic <> 'never' OR run >= 3)""")
def mon_no_data_until(spark, d):
    """Silence before the first event and after the last counts."""
    events = table(spark, d, "events")
    kinds = events.select(F.col("event_type").alias("topic")).distinct().withColumn("slow", F.lit(False)).unionByName(local(spark, [("never", True)], "topic string, slow boolean"))
    volume = audit.batch_volume(events, "1 day", topic="event_type")
    low, high = F.min("start") - F.expr("interval 2 days"), F.max("start") + F.expr("interval 4 days")
    return audit.no_data(volume, kinds, "1 day", 3, [2, 4], low, high)


# --- de-identification ------------------------------------------------------------------------------------------------


@query("did_field_policy", "SELECT DISTINCT c_mktsegment AS field, CASE WHEN c_mktsegment < 'C' THEN 'DATE' WHEN c_mktsegment < 'G' THEN 'DE_ID' ELSE 'ANONYMIZE' END AS operation FROM customer")
def did_field_policy(spark, d):
    asked = F.when(F.col("c_mktsegment") < "C", "date").when(F.col("c_mktsegment") < "G", " De_Id").otherwise("other")
    return deid.field_policy(table(spark, d, "customer").select(F.col("c_mktsegment").alias("field"), asked.alias("operation")).distinct())


def _keyed(below: int, *values: str, salt: str = "salt") -> str:
    """SQL of a number below ``below`` from a salted SHA-256."""
    return f"(('0x' || sha256({' || chr(31) || '.join([repr(salt), *values])})[1:12])::BIGINT % {below})"


def _identifier(c: str) -> str:
    return f"array_to_string([CASE WHEN regexp_matches({c}[i + 1], '[0-9]') THEN {c}[i + 1] ELSE {_keyed(10, c, 'i')}::VARCHAR END FOR i IN range(0, length({c}))], '')"


def _walk(spark, d):
    return table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("row_key"), F.upper("c_mktsegment").alias("prio"), F.when(F.expr("c_custkey % 4 = 0"), "").otherwise("Z").alias("status"))


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("prio"), F.col("o_orderstatus").alias("status"))


@query("did_crosswalk_lookup", "SELECT o_orderkey, CASE WHEN c_acctbal > 0 THEN upper(c_mktsegment) END AS new_prio, CASE WHEN c_acctbal > 0 AND o_custkey % 4 <> 0 THEN 'Z' END AS new_status FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def did_crosswalk_lookup(spark, d):
    return deid.crosswalk_lookup(_orders(spark, d), _walk(spark, d), ["o_custkey"], ["prio", "status"]).select("o_orderkey", "new_prio", "new_status")


_DONOR = f"""SELECT c_custkey, o.n_name AS name, CASE WHEN a.n_name <> o.n_name THEN a.n_name WHEN b.n_name <> o.n_name THEN b.n_name ELSE {_identifier("o.n_name")} END AS new_name
  FROM customer JOIN nation o ON o.n_nationkey = c_nationkey LEFT JOIN nation a ON a.n_nationkey = {_keyed(25, "c_custkey", "'name'")} LEFT JOIN nation b ON b.n_nationkey = {_keyed(25, "c_custkey", "'name'", salt="salt+")}"""


@query("did_random_donor", _DONOR)
def did_random_donor(spark, d):
    donors = table(spark, d, "nation").select(F.col("n_nationkey").alias("pos"), F.col("n_name").alias("name"))
    rows = table(spark, d, "customer").join(donors.withColumnRenamed("pos", "c_nationkey"), "c_nationkey").select("c_custkey", "name")
    return deid.random_donor(rows, donors, "c_custkey", ["name"], "salt", 25)


@query("did_anonymize", "SELECT c_custkey, '' AS c_name FROM customer")
def did_anonymize(spark, d):
    return deid.anonymize(table(spark, d, "customer").select("c_custkey", "c_name"), ["c_name"])


@query("did_identifier", sql(f"SELECT msg_id, mrn, {_identifier('mrn')} AS new_mrn FROM m"))
def did_identifier(spark, d):
    return headers(spark, d).select("msg_id", "mrn", scrub.identifier(F.col("mrn"), "salt").alias("new_mrn"))


_JITTER = f"CASE WHEN try_cast(ssn[i + 1] AS INT) + {_keyed(9, 'ssn', 'i')} < 10 THEN (ssn[i + 1]::INT + {_keyed(9, 'ssn', 'i')})::VARCHAR ELSE ssn[i + 1] END"


@query("did_ssn_jitter", sql(f"SELECT msg_id, ssn, array_to_string([{_JITTER} FOR i IN range(0, length(ssn))], '') AS new_ssn FROM m"))
def did_ssn_jitter(spark, d):
    return headers(spark, d).select("msg_id", "ssn", scrub.ssn_jitter(F.col("ssn"), "salt").alias("new_ssn"))


_CODE = "CASE WHEN {c} = '.' THEN 'NOFAC' ELSE (SELECT array_to_string(CASE WHEN k = 0 THEN s ELSE list_concat(s[len(s) - k + 1:], s[1:len(s) - k]) END, '') FROM (SELECT list_reverse_sort(string_split({c}, '')) AS s, CASE WHEN length({c}) > 0 THEN 9 % length({c}) ELSE 0 END AS k)) END"


@query("did_facility_code", f"SELECT n_nationkey, {_CODE.format(c='n_name')} AS code FROM nation UNION ALL SELECT -1, 'NOFAC'")
def did_facility_code(spark, d):
    rows = table(spark, d, "nation").select("n_nationkey", "n_name").unionByName(local(spark, [(-1, ".")], "n_nationkey int, n_name string"))
    return rows.select("n_nationkey", scrub.facility_code(F.col("n_name")).alias("code"))


@query("did_control_id", sql("SELECT msg_id, CASE WHEN ctrl = '' THEN '' ELSE replace(ctrl, fac, array_to_string(list_reverse_sort(string_split(fac, '')), '')) END AS ctrl FROM m"))
def did_control_id(spark, d):
    return headers(spark, d).select("msg_id", scrub.control_id(F.col("ctrl"), F.col("fac")).alias("ctrl"))


_MOVED = "- INTERVAL 1 DAY - INTERVAL 6 HOUR - INTERVAL 14 MINUTE + INTERVAL 44 SECOND"


@query("did_date_shift", f"SELECT event_id, strftime(ts {_MOVED}, '%Y%m%d%H%M%S') AS s14, strftime(date_trunc('minute', ts) {_MOVED}, '%Y%m%d%H%M') AS s12, strftime(date_trunc('day', ts) {_MOVED}, '%Y%m%d') AS s8, '20240230' AS bad FROM events")
def did_date_shift(spark, d):
    shift = lambda fmt, name: scrub.date_shift(F.date_format("ts", fmt)).alias(name)
    return table(spark, d, "events").select("event_id", shift("yyyyMMddHHmmss", "s14"), shift("yyyyMMddHHmm", "s12"), shift("yyyyMMdd", "s8"), scrub.date_shift(F.lit("20240230")).alias("bad"))


_BORN = f"greatest(o_orderdate::DATE, DATE '1935-06-01') - to_months({_keyed(12, 'o_custkey', chr(39) + 'm' + chr(39))}::INT) - to_days({_keyed(28, 'o_custkey', chr(39) + 'd' + chr(39))}::INT)"


@query("did_birth_date", f"SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS born, o_custkey::VARCHAR AS k, strftime({_BORN}, '%Y%m%d') AS moved FROM orders")
def did_birth_date(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("born"), F.col("o_custkey").cast("string").alias("k"))
    return rows.withColumn("moved", scrub.birth_date(F.col("born"), F.col("k"), "salt", F.lit("2024-06-01").cast("date")))


@query("did_scrub_values", sql("SELECT msg_id, CASE WHEN msg_id % 101 = 0 THEN 'id *' ELSE 'id * ' || ' of ' || fac END AS note FROM m"))
def did_scrub_values(spark, d):
    rows = headers(spark, d).withColumn("note", F.when(F.expr("msg_id % 101 = 0"), F.concat(F.lit("id "), "ssn")).otherwise(F.concat(F.lit("id "), "ssn", F.lit("  of "), "fac")))
    parts = scrub.value_parts([F.col("ssn"), F.concat("name", F.lit("&ab"))], 2, ["of"])
    return rows.select("msg_id", scrub.scrub_values(F.col("note"), parts, "*").alias("note"))


@query("did_name_case_variants", """SELECT c_custkey, 'saw ' || CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) ELSE '*' END || ', *; * or ' || n_name || '.' AS note FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def did_name_case_variants(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    first, last = F.initcap("c_mktsegment"), F.concat(F.lit("Mc"), F.substring("c_name", 1, 1), F.col("c_custkey").cast("string"), F.lit("x"))
    half = F.when(F.expr("c_custkey % 3 = 0"), F.lower("c_mktsegment")).otherwise(F.concat_ws(" ", first, last))  # a first name alone stays
    note = F.concat(F.lit("saw "), half, F.lit(", "), F.upper(F.concat_ws(" ", last, first)), F.lit("; "), F.lower(F.concat_ws(", ", last, first)), F.lit(" or "), "n_name", F.lit("."))
    return rows.select("c_custkey", scrub.name_variants(note, first, last, "*").alias("note"))


def _cut(note: str, word: str, n: int) -> str:
    """SQL of a window: the characters from a keyword on go, where there are enough."""
    at = f"instr({note}, '{word}')"
    return f"CASE WHEN {at} > 0 AND {at} + {n - 1} <= length({note}) THEN replace({note}, substr({note}, {at}, {n}), '') ELSE {note} END"


@query("did_keyword_window", f"""WITH a AS (SELECT o_orderkey, o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN ' DOB ' ELSE ' AGE ' END || strftime(o_orderdate, '%Y-%m-%d') || repeat(o_orderstatus, (o_orderkey % 14)::INT) || CASE WHEN o_orderkey % 4 = 0 THEN ' SEX ' ELSE ' - ' END || o_custkey AS t0 FROM orders),
  b AS (SELECT o_orderkey, {_cut("t0", "DOB", 20)} AS t1 FROM a), c AS (SELECT o_orderkey, {_cut("t1", "AGE", 10)} AS t2 FROM b) SELECT o_orderkey, {_cut("t2", "SEX", 10)} AS note FROM c""")
def did_keyword_window(spark, d):
    note = F.expr("concat(o_orderpriority, if(o_orderkey % 3 = 0, ' DOB ', ' AGE '), date_format(o_orderdate, 'yyyy-MM-dd'), repeat(o_orderstatus, cast(o_orderkey % 14 as int)), if(o_orderkey % 4 = 0, ' SEX ', ' - '), o_custkey)")
    return table(spark, d, "orders").select("o_orderkey", scrub.keyword_window(note).alias("note"))


@query("did_facility_names", "SELECT c_custkey, 'at ' || CASE WHEN c_nationkey < 20 THEN '' ELSE n_name END || ', x' || n_name || ' or ' || c_mktsegment || ' the ' AS note FROM customer JOIN nation ON n_nationkey = c_nationkey")
def did_facility_names(spark, d):
    nation = table(spark, d, "nation")
    known = nation.filter("n_nationkey < 20").select(F.col("n_name").alias("name")).unionByName(local(spark, [("East Hospital",)], "name string"))
    rows = table(spark, d, "customer").join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
    note = F.concat(F.lit("at "), "n_name", F.lit(", x"), "n_name", F.lit(" or "), "c_mktsegment", F.lit(" the Hospital"))
    return names.remove_names(rows.select("c_custkey", note.alias("note")), "note", known, ["East"])


@query("did_known_names", "SELECT o_orderkey, 'seen by ' || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_name END || '. ' || c_name || '_ or ' || o_orderpriority AS note FROM orders JOIN customer ON c_custkey = o_custkey")
def did_known_names(spark, d):
    """A dictionary that grows with the tables: the names of every second customer."""
    customer = table(spark, d, "customer")
    known = customer.filter("c_custkey % 2 = 0").select(F.col("c_name").alias("name"))
    rows = table(spark, d, "orders").join(customer, F.col("c_custkey") == F.col("o_custkey"))
    note = F.concat(F.lit("seen by "), "c_name", F.lit(". "), "c_name", F.lit("_ or "), "o_orderpriority")
    return names.remove_names(rows.select("o_orderkey", note.alias("note")), "note", known, ["Customer"])


@query("did_remove_email_ssn", "SELECT doc_id, sha256(regexp_replace(regexp_replace(coalesce(text, ''), '[a-zA-Z0-9.-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z0-9.-]+', '', 'g'), '\\s[0-9]{3}-[0-9]{2}-[0-9]{4}\\s', ' ', 'g')) AS sha FROM documents")
def did_remove_email_ssn(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(scrub.remove_email_ssn(F.coalesce("text", F.lit(""))), 256).alias("sha"))


@query("did_blank_phones", sql("SELECT msg_id, '' AS phone, prio || ': call ' || CASE WHEN msg_id % 2 = 0 THEN '' ELSE urn END || ' of ' || fac AS note FROM m"))
def did_blank_phones(spark, d):
    said = F.when(F.expr("msg_id % 2 = 0"), F.col("ssn")).otherwise(F.col("urn"))
    rows = headers(spark, d).select("msg_id", F.col("ssn").alias("phone"), F.concat("prio", F.lit(": call "), said, F.lit(" of "), "fac").alias("note"))
    return deid.blank_phones(rows, ["phone"], ["note"])


@query("did_state_once", "SELECT n_nationkey, '##' || n_name[3:] || ' ' || n_name AS v FROM nation")
def did_state_once(spark, d):
    rows = table(spark, d, "nation")
    return rows.select("n_nationkey", scrub.state_once(F.concat_ws(" ", "n_name", "n_name"), F.substring("n_name", 1, 2), F.lit("##")).alias("v"))


@query("did_per_message_reuse", sql("SELECT ctrl, 1::BIGINT AS n FROM m GROUP BY 1"))
def did_per_message_reuse(spark, d):
    rows = headers(spark, d)
    both = rows.unionByName(rows)
    return deid.per_message(both, "ctrl", ["mrn"], "salt").groupBy("ctrl").agg(F.countDistinct("new_mrn").alias("n"))


@query("did_write_crosswalk", sql("SELECT urn AS row_key, arg_max(ssn, (t7, msg_id)) AS ssn, arg_max('N' || msg_id, (t7, msg_id)) AS new_ssn FROM m GROUP BY 1"))
def did_write_crosswalk(spark, d):
    rows = headers(spark, d).withColumns({"new_ssn": F.concat(F.lit("N"), "msg_id"), "ts": F.struct("t7", "msg_id")})
    return deid.write_crosswalk(rows, ["urn"], ["ssn"], "ts")


@query("did_id_map", sql("SELECT fac || '|' || ssn[1:3] || '|' || array_to_string(list_reverse_sort(string_split(fac, '')), '') || '|' || ssn[1:3] AS row FROM m"))
def did_id_map(spark, d):
    return deid.id_map(headers(spark, d).withColumn("ssn", F.substring("ssn", 1, 3)), "fac", "ssn", "salt")


@query("did_file_by_crosswalk", "SELECT o_orderkey, o_custkey, upper(c_mktsegment) AS prio, CASE WHEN o_custkey % 4 = 0 THEN o_orderstatus ELSE 'Z' END AS status FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0")
def did_file_by_crosswalk(spark, d):
    return deid.file_by_crosswalk(_orders(spark, d), _walk(spark, d), "o_custkey", ["prio", "status"])


@query("did_leak_scan", """SELECT doc_id, kind, match FROM (SELECT doc_id, 'email' AS kind, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,6}')) AS match FROM documents
  UNION ALL SELECT doc_id, 'phone_paren', unnest(regexp_extract_all(text, '\\([0-9]{3}\\) ?[0-9]{3}-[0-9]{4}')) FROM documents
  UNION ALL SELECT doc_id, CASE WHEN regexp_full_match(run, '[0-9]{3}-[0-9]{2}-[0-9]{4}') THEN 'ssn_dash' ELSE 'phone_dash' END, run FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9-]+')) AS run FROM documents) WHERE regexp_full_match(run, '[0-9]{3}-([0-9]{2}|[0-9]{3})-[0-9]{4}')
  UNION ALL SELECT doc_id, 'phone_dot', run FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9.]+')) AS run FROM documents) WHERE regexp_full_match(run, '[0-9]{3}\\.[0-9]{3}\\.[0-9]{4}')
  UNION ALL SELECT doc_id, 'phone_plain', run FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]+')) AS run FROM documents) WHERE strlen(run) = 10
  UNION ALL SELECT doc_id, 'ssn_blank', run[1:11] FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9 ]+')) AS run FROM documents) WHERE regexp_matches(run, '^[0-9]{3} [0-9]{2} [0-9]{4}( |$)'))""")
def did_leak_scan(spark, d):
    return deid.leak_scan(table(spark, d, "documents"), "doc_id", "text")


@query("did_message", sql(f"SELECT msg_id, {_identifier('mrn')} AS mrn, '' AS ssn, strftime(strptime(t7, '%Y%m%d%H%M') {_MOVED}, '%Y%m%d%H%M') AS t7, prio, 'seen  today' AS note FROM m"))
def did_message(spark, d):
    rows = headers(spark, d).withColumns({"note": F.concat(F.lit("seen "), "ssn", F.lit(" today")), "ts": F.struct("t7", "msg_id")})
    policy = {"mrn": "DE_ID", "ssn": "ANONYMIZE", "t7": "DATE", "prio": "NONE"}
    return deid.message(rows, "urn", policy, ["mrn"], "note", "salt", "ts")["rows"].select("msg_id", "mrn", "ssn", "t7", "prio", "note")


# --- result feed ------------------------------------------------------------------------------------------------------


def _json(spark, d):
    return table(spark, d, "events").select("event_id", F.when(F.expr("event_id % 10 = 0"), "{bad").otherwise(F.col("props")).alias("value"))


_K = "CASE WHEN event_id % 10 <> 0 THEN json_extract_string(props, '$.k') END"


@query("res_parse_json", f"SELECT event_id, {_K} AS k, event_id % 10 = 0 AS malformed FROM events")
def res_parse_json(spark, d):
    return feeds.parse_json(_json(spark, d)).select("event_id", F.try_element_at("m", F.lit("k")).alias("k"), "malformed")


@query("res_variant_paths", """SELECT event_id, event_id % 10 = 0 AS malformed, CASE WHEN event_id % 10 > 0 THEN event_type END AS kind, CASE WHEN event_id % 10 > 0 THEN user_id::VARCHAR END AS who,
  CASE WHEN event_id % 10 > 0 AND event_id % 2 = 0 THEN (event_id + 1)::VARCHAR END AS second, NULL::VARCHAR AS missing FROM events""")
def res_variant_paths(spark, d):
    """Documents of changing shape in one column, asked by path."""
    rows = table(spark, d, "events")
    ids = F.when(F.expr("event_id % 2 = 0"), F.array("event_id", F.col("event_id") + 1)).otherwise(F.array("event_id"))
    text = F.to_json(F.struct(F.struct("event_type", F.struct(F.col("user_id").alias("id")).alias("user")).alias("of"), ids.alias("ids")))
    rows = feeds.parse_variant(rows.select("event_id", F.when(F.expr("event_id % 10 = 0"), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text).alias("value")))
    found = feeds.at_paths(rows, {"kind": ("$.of.event_type", "string"), "who": ("$.of.user.id", "string"), "second": ("$.ids[1]", "string"), "missing": ("$.of.other", "string")})
    return found.drop("value", "v")


@query("res_required_fields", f"SELECT event_id, coalesce({_K} <> '', false) AS ok FROM events")
def res_required_fields(spark, d):
    return feeds.required_fields(feeds.parse_json(_json(spark, d)), ["k"]).select("event_id", "ok")


@query("res_merge_fields", "SELECT event_id, event_type || '/' || user_id AS who, strftime(ts, '%Y-%m-%dT00:00:00.000+00:00') AS at FROM events")
def res_merge_fields(spark, d):
    rows = table(spark, d, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    return feeds.merge_fields(rows, [(["event_type", "user_id"], "who", "/"), (["day"], "at", "")]).select("event_id", "who", "at")


@query("res_first_component", sql("SELECT msg_id, n1 AS name FROM m"))
def res_first_component(spark, d):
    return feeds.first_component(headers(spark, d).select("msg_id", "name"), ["name"])


@query("res_project_delimited", "SELECT event_id || ';' || event_type || ';' AS row FROM events")
def res_project_delimited(spark, d):
    return table(spark, d, "events").withColumn("none", F.lit(None).cast("string")).select(feeds.project_delimited(["event_id", "event_type", "none"], ";").alias("row"))


@query("res_landing_split", f"SELECT CASE WHEN coalesce({_K} <> '', false) THEN 'valid' ELSE 'rejected' END AS landing_zone, count(*) AS n FROM events GROUP BY 1")
def res_landing_split(spark, d):
    rows = feeds.landing_split(feeds.required_fields(feeds.parse_json(_json(spark, d)), ["k"]))
    return rows.groupBy("landing_zone").agg(F.count(F.lit(1)).alias("n"))


# --- roster forwarding ------------------------------------------------------------------------------------------------


@query("ros_event_type_in", sql("SELECT msg_id FROM m WHERE trig IN ('A04', 'R01')"))
def ros_event_type_in(spark, d):
    return feeds.event_type_in(messages(spark, d), ["A04", "R01"]).select("msg_id")


def _roster(spark, d):
    return table(spark, d, "nation").filter("n_regionkey = 1").select(F.concat(F.lit("F"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("value"))


_IN = "fac IN (SELECT 'F' || lpad(n_nationkey::VARCHAR, 2, '0') FROM nation WHERE n_regionkey = 1)"


@query("ros_field_in_roster", sql(f"SELECT msg_id FROM m WHERE {_IN}"))
def ros_field_in_roster(spark, d):
    return feeds.field_in_roster(messages(spark, d), "MSH", 3, _roster(spark, d)).select("msg_id")


@query("ros_contains_any", sql("SELECT msg_id FROM m WHERE prio ILIKE '%urg%' OR prio ILIKE '%low%'"))
def ros_contains_any(spark, d):
    return feeds.contains_any(messages(spark, d), "OBR", [4], ["urg", "Low"]).select("msg_id")


@query("ros_segment_by_prefix", sql(f"SELECT msg_id, {own("'OBR|1|||' || prio || '^text'")} AS seg FROM m"))
def ros_segment_by_prefix(spark, d):
    return messages(spark, d).select("msg_id", F.array_join(feeds.segments_with(F.col("raw"), "OBR"), "\n").alias("seg"))


@query("ros_get_field", sql("SELECT msg_id, cls, '' AS none FROM m"))
def ros_get_field(spark, d):
    pv1 = feeds.segments_with(F.col("raw"), "PV1")
    seps = parse.separators(F.col("raw"))
    return messages(spark, d).select("msg_id", feeds.get_field(pv1, 2, seps).alias("cls"), feeds.get_field(pv1, 9, seps).alias("none"))


@query("ros_remove_field", sql(f"SELECT msg_id, {own("'PID|1||' || mrn || '^^^' || fac || '^MRN~' || ssn || '^^^^SS||' || n1 || '^' || n2 || repeat('|', 13) || acct")} AS pid FROM m"))
def ros_remove_field(spark, d):
    segs = feeds.remove_field(feeds.segments_with(F.col("raw"), "PID"), "PID", 4, parse.separators(F.col("raw")))
    return messages(spark, d).select("msg_id", F.get(segs, F.lit(0)).alias("pid"))


@query("ros_scrub_and_join", sql(f"SELECT msg_id, {own("'PID|1||' || mrn || '^^^' || fac || '^MRN~^^^^SS|' || urn || '|' || n1 || '^' || n2 || repeat('|', 13) || acct || chr(13) || 'PV1|1|' || cls")} AS v FROM m"))
def ros_scrub_and_join(spark, d):
    rows = messages(spark, d).join(headers(spark, d).select("msg_id", "ssn"), "msg_id")
    segs = F.concat(feeds.segments_with(F.col("raw"), "PID"), feeds.segments_with(F.col("raw"), "PV1"))
    return rows.select("msg_id", feeds.scrub_and_join(segs, F.col("ssn")).alias("v"))


@query("ros_forward_job", sql(f"SELECT msg_id, {own("'PID|1||' || mrn || '^^^' || fac || '^MRN~^^^^SS|' || urn || '|' || n1 || '^' || n2 || repeat('|', 13) || acct")} AS pid FROM m WHERE trig IN ('A04', 'R01') AND {_IN} AND prio ILIKE '%i%'"))
def ros_forward_job(spark, d):
    sent = feeds.forward_job(messages(spark, d), ["A04", "R01"], _roster(spark, d), ["i"])
    return sent.select("msg_id", F.get(F.filter(F.split("payload", "\r"), lambda x: x.startswith("PID")), F.lit(0)).alias("pid"))


# --- warehouse --------------------------------------------------------------------------------------------------------


@query("wh_daily_distinct_load", sql("SELECT DISTINCT typ || trig AS trig, t7, typ AS message_type, t7[1:4] || '-' || t7[5:6] || '-' || t7[7:8] AS message_date, 'now' AS insert_time FROM m"))
def wh_daily_distinct_load(spark, d):
    rows = headers(spark, d).select(F.replace("type9", F.lit("^"), F.lit("")).alias("trig"), "t7")
    return feeds.daily_distinct_load(rows.unionByName(rows), "trig", "t7", "now").withColumn("message_date", F.col("message_date").cast("string"))


def _staged(spark, d):
    return headers(spark, d).select("msg_id", F.col("fac").alias("facility"), "cls", F.substring("t7", 1, 8).alias("transaction_date"), F.col("t7").alias("etl_insert_date_time"), F.substring("type9", 1, 3).alias("job"))


@query("wh_incremental_staging", sql("SELECT msg_id FROM m WHERE t7[1:8] >= '19950101' AND t7 >= '199503' AND fac NOT IN ('F01') AND cls <> ''"))
def wh_incremental_staging(spark, d):
    return feeds.incremental_staging(_staged(spark, d), "19950101", "199503", ["F01"], ["cls"]).select("msg_id")


@query("wh_watermark_dates", sql("SELECT msg_id, strftime(strptime(t7[1:8], '%Y%m%d') - INTERVAL 3 DAY, '%Y-%m-%d') AS since FROM m"))
def wh_watermark_dates(spark, d):
    return headers(spark, d).select("msg_id", feeds.watermark_date(F.col("t7")).cast("string").alias("since"))


@query("wh_control_offset", sql("SELECT typ AS job, CASE WHEN typ = 'ADT' THEN '99999999' ELSE max(t7) END AS offset, CASE WHEN typ = 'ADT' THEN 'DELAYED' ELSE 'DONE' END AS status FROM m GROUP BY 1"))
def wh_control_offset(spark, d):
    control = local(spark, [("ADT", "99999999"), ("ORU", "0"), ("MDM", "0"), ("ORM", "0")], "job string, offset string")
    return feeds.control_offset(control, _staged(spark, d))


@query("wh_backfill_case", sql("SELECT msg_id, CASE WHEN msg_id % 3 = 0 THEN ssn WHEN msg_id % 3 = 1 THEN mrn || '^' || ssn ELSE urn END AS ssn FROM m"))
def wh_backfill_case(spark, d):
    rows = headers(spark, d).withColumns({"codes": F.when(F.expr("msg_id % 3 = 0"), "MRN^SS").otherwise("MRN"), "ids": F.when(F.expr("msg_id % 3 < 2"), F.concat_ws("^", "mrn", "ssn")).otherwise("")})
    return feeds.backfill_case(rows, "codes", "ids", "urn").select("msg_id", "ssn")


@query("wh_backfill_passthrough", sql("SELECT mrn AS patient, '' AS network FROM m"))
def wh_backfill_passthrough(spark, d):
    return feeds.backfill_passthrough(headers(spark, d), {"patient": "mrn"}, {"network": ""})


@query("wh_facility_reference", "SELECT n_nationkey AS facility, s_name AS location FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 5000 WHERE n_regionkey <> 2")
def wh_facility_reference(spark, d):
    fac = table(spark, d, "nation").select(F.col("n_nationkey").alias("facility"), (F.col("n_regionkey") != 2).alias("active"))
    loc = table(spark, d, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("facility"), F.col("s_name").alias("location"))
    return feeds.facility_reference(fac, loc).drop("active")


@query("wh_schema_from_templates", "SELECT p_brand AS seg, string_agg(path, '^' ORDER BY ord) AS model FROM (SELECT p_brand, CASE WHEN p_size = 1 THEN '_' ELSE '' END || p_size AS path, min(p_partkey) AS ord FROM part WHERE p_size <> 2 GROUP BY p_brand, p_size) WHERE p_brand <> 'Brand#11' GROUP BY 1")
def wh_schema_from_templates(spark, d):
    rows = table(spark, d, "part").select(F.lit("STD").alias("tpl"), F.col("p_partkey").alias("pos"), F.col("p_brand").alias("seg"), F.col("p_size").cast("string").alias("field"), F.lit("").alias("comp"))
    return feeds.schema_from_templates(rows, local(spark, [("STD", 0)], "tpl string, tpl_pos int"), ["Brand#11"], ["2"], ["1"])


_DDL = """SELECT p_brand AS seg, list_concat(['etl_firstinsert_datetime', 'field_seq_num', 'sending_facility', 'message_control_id', 'medical_record_num', 'medical_record_urn', 'patient_account_num'],
  list(DISTINCT p_size || '_' || p_type ORDER BY p_size || '_' || p_type), ['message_type', 'transaction_date']) AS c FROM part GROUP BY 1"""


@query("wh_table_ddl", f"SELECT seg, (generate_subscripts(c, 1) - 1)::INT AS pos, unnest(c) AS \"column\" FROM ({_DDL})")
def wh_table_ddl(spark, d):
    path = F.concat_ws("|", "p_size", "p_type")
    models = table(spark, d, "part").groupBy(F.col("p_brand").alias("seg")).agg(F.array_join(F.array_sort(F.collect_set(path)), "^").alias("model"))
    tables = feeds.table_ddl({r["seg"]: r["model"] for r in models.collect()})  # a model a segment kind: config
    return local(spark, [(seg, pos, f.name) for seg, columns in tables.items() for pos, f in enumerate(columns)], "seg string, pos int, column string")


@query("wh_add_columns", "SELECT c_custkey, c_name, NULL::VARCHAR AS extra FROM customer")
def wh_add_columns(spark, d):
    old = table(spark, d, "customer").select("c_custkey", "c_name")
    return feeds.add_columns(old, ["extra"], old.withColumn("extra", F.lit(None).cast("string")))


# --- comparison -------------------------------------------------------------------------------------------------------


def _pair(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    reference = c.filter("c_acctbal > 0").drop("c_mktsegment", "c_acctbal")
    return c.drop("c_acctbal").withColumn("c_name", F.when(F.expr("c_custkey % 5 = 0"), "changed").otherwise(F.col("c_name"))), reference


@query("cmp_tables", "SELECT 'cand_' || p_brand AS candidate, CASE WHEN min(p_size) < 5 THEN 'ref_' || p_brand END AS reference, CASE WHEN min(p_size) < 5 THEN 'FOUND' ELSE 'NO_TABLE' END AS status FROM part GROUP BY p_brand")
def cmp_tables(spark, d):
    part = table(spark, d, "part")
    brands = part.groupBy("p_brand").agg((F.min("p_size") < 5).alias("there")).collect()  # a table each: config
    of = lambda r: part.filter(F.col("p_brand") == r["p_brand"])
    found = feeds.cmp_tables({f"cand_{r['p_brand']}": of(r) for r in brands}, {f"ref_{r['p_brand']}": of(r) for r in brands if r["there"]})
    return local(spark, found, "candidate string, reference string, status string")


@query("cmp_rows", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'MATCH' ELSE 'NO_DATA' END AS status FROM customer")
def cmp_rows(spark, d):
    return feeds.cmp_rows(*_pair(spark, d), "c_custkey")


_CELLS = "SELECT c_custkey, 'c_name' AS \"column\", 'changed' AS got, c_name AS expected FROM customer WHERE c_custkey % 5 = 0 AND c_acctbal > 0 UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment, NULL FROM customer WHERE c_acctbal > 0"


@query("cmp_columns", _CELLS)
def cmp_columns(spark, d):
    return feeds.cmp_columns(*_pair(spark, d), "c_custkey", [])


@query("cmp_report", f"SELECT CASE WHEN c_acctbal > 0 THEN 'MATCH' ELSE 'NO_DATA' END AS status, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT 'MISMATCH', count(*) FROM ({_CELLS})")
def cmp_report(spark, d):
    a, b = _pair(spark, d)
    return feeds.cmp_report(feeds.cmp_rows(a, b, "c_custkey"), feeds.cmp_columns(a, b, "c_custkey", []))


_SIDES = """c AS (SELECT * FROM (SELECT o_orderkey % 500 AS id, o_orderpriority AS prio, o_orderstatus AS status, o_orderkey AS at, row_number() OVER (PARTITION BY o_orderkey % 500 ORDER BY o_orderkey DESC) AS k FROM orders) WHERE k = 1),
  o AS (SELECT 'cand_orders' AS "table", c.id::VARCHAR AS key, r.id IS NOT NULL AS there, unnest([{'column': 'prio', 'got': c.prio, 'expected': r.prio}, {'column': 'status', 'got': c.status, 'expected': NULL}], recursive := true)
    FROM c LEFT JOIN (SELECT id, CASE WHEN id % 7 = 0 THEN 'other' ELSE prio END AS prio FROM c WHERE id % 11 <> 0) r USING (id)),
  p AS (SELECT 'cand_part' AS "table", p_partkey::VARCHAR AS key, CASE WHEN p_size > 10 THEN 'MATCH' ELSE 'NO_DATA' END AS status FROM part)"""


@query("plan_segment_validation", f"""WITH {_SIDES} SELECT "table", key, 'MISMATCH' AS status, "column", got, expected FROM o WHERE there AND got IS DISTINCT FROM expected
  UNION ALL SELECT DISTINCT "table", key, 'NO_DATA', NULL, NULL, NULL FROM o WHERE NOT there UNION ALL SELECT "table", key, status, NULL, NULL, NULL FROM p
  UNION ALL SELECT 'cand_nation', NULL, 'NO_TABLE', NULL, NULL, NULL""")
def plan_segment_validation(spark, d):
    orders = table(spark, d, "orders").select((F.col("o_orderkey") % 500).alias("id"), F.col("o_orderpriority").alias("prio"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("at"))
    part = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_partkey").alias("at"))
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_nationkey").alias("at"))
    changed = orders.filter("id % 11 <> 0").select("id", F.when(F.expr("id % 7 = 0"), "other").otherwise(F.col("prio")).alias("prio"), "at")
    kept = part.join(table(spark, d, "part").filter("p_size > 10").select(F.col("p_partkey").alias("id")), "id", "left_semi")
    return validation_job({"cand_orders": orders, "cand_part": part, "cand_nation": nation}, {"ref_orders": changed, "ref_part": kept}, "id", "at", ["at"])
