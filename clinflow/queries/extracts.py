"""Segment tables, filters, field operations and extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinflow.functions import fields as fld
from clinflow.functions import filters as flt
from clinflow.operators import enrich, naming, parse, segments
from clinflow.operators.membership import in_list
from clinflow.queries.base import local, sql
from clinflow.queries.parsing import IDS, RULES, TARGETS, common
from clinflow.registry import query
from clinflow.sources.synth import headers, messages, table

MODELS = [("ORU", "OBX", 0, "3|1"), ("ORU", "OBX", 1, "3|2"), ("ORU", "OBX", 2, "5"), ("ORU", "OBX", 3, "6"), ("ORU", "PID", 0, "3"), ("ORU", "PID", 1, "3|5"), ("ORU", "PID", 2, "3|4"), ("ORU", "PV1", 0, "2"), ("ORU", "ZZZ", 0, "1")]
OBX = ["3|1", "3|2", "5", "6"]
AS_OF = "2024-06-01 12:34:56.789"
STAMP = "'202406011234560000789'"


def models(spark):
    return local(spark, MODELS, "type string, seg string, pos int, path string")


def elements(spark, d, segs):
    return parse.elements(messages(spark, d), segs)


def modelled(spark, d, segs):
    """Elements of the fields that the models of these segments ask for; the others go before they are cut."""
    fields = {seg: tuple(sorted({int(path.split("|")[0]) for _, s, _, path in MODELS if s == seg})) for seg in segs}
    return parse.elements(messages(spark, d), fields=fields)


def occurrences(spark, d, *segs):
    return parse.occurrences(messages(spark, d), segs)


def as_of():
    return F.lit(AS_OF).cast("timestamp")


@query("seg_project", sql("SELECT msg_id, (4 + n)::INT AS seg_seq, part AS f_3_1, flag AS f_3_2, qty AS f_5, st AS f_6 FROM x JOIN m USING (msg_id)", "x"))
def seg_project(spark, d):
    return segments.project(modelled(spark, d, ("OBX",)), models(spark), "OBX", OBX)


@query("seg_join_repeats", sql("SELECT msg_id, string_agg(flag, '^' ORDER BY n) AS joined, string_agg(CASE WHEN flag = 'N' THEN '' ELSE flag END, '^' ORDER BY n) FILTER (n >= first) AS with_blanks FROM (SELECT *, min(n) FILTER (flag <> 'N') OVER (PARTITION BY msg_id) AS first FROM x) JOIN m USING (msg_id) GROUP BY 1", "x"))
def seg_join_repeats(spark, d):
    rows = elements(spark, d, ("OBX",)).filter("field = 3 and comp = 2").groupBy("msg_id").agg(F.array_sort(F.collect_list(F.struct("seg_seq", "value"))).alias("v"))
    joined = segments.join_repeats(F.transform("v", lambda x: x["value"]))
    blanks = segments.join_repeats(F.transform("v", lambda x: F.when(x["value"] == "N", "").otherwise(x["value"])))
    return rows.select("msg_id", joined.alias("joined"), F.nullif(blanks, F.lit("")).alias("with_blanks"))


@query("seg_parent_fallback", sql("SELECT path, count(*) AS n FROM (SELECT CASE WHEN field = 3 AND comp IN (4, 5) THEN '3|' || comp WHEN field = 3 THEN '3' END AS path FROM e WHERE seg = 'PID') GROUP BY 1", "e"))
def seg_parent_fallback(spark, d):
    return segments.parent_fallback(elements(spark, d, ("PID",)).filter("value is not null"), models(spark)).groupBy("path").agg(F.count(F.lit(1)).alias("n"))


@query("seg_common_columns", sql(f"SELECT msg_id, {STAMP} AS etl_firstinsert_datetime, '0003' AS field_seq_num, {IDS}, cls AS f_2 FROM m WHERE cls <> ''"))
def seg_common_columns(spark, d):
    raw = naming.with_common_ids(messages(spark, d), RULES, TARGETS)
    rows = segments.project(parse.occurrences(raw, ("PV1",), tuple(TARGETS)), models(spark), "PV1", ["2"])
    return segments.common_columns(rows, TARGETS, as_of())


@query("seg_etl_timestamp", "SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') || lpad(strftime(ts, '%g'), 7, '0') AS etl FROM events")
def seg_etl_timestamp(spark, d):
    return table(spark, d, "events").select("event_id", segments.etl_timestamp(F.col("ts")).alias("etl"))


@query("seg_skipped", sql("SELECT msg_id, 3 AS seg_seq, 'SKIPPED' AS state FROM m WHERE cls = ''"))
def seg_skipped(spark, d):
    raw = messages(spark, d)
    rows = segments.project(parse.elements(raw, ("PV1",)), models(spark), "PV1", ["2"])
    return segments.skipped(parse.split_segments(raw).filter("seg = 'PV1'").select("msg_id", "seg_seq"), rows)


@query("seg_not_applicable", sql("SELECT 'ORU' AS type, 'ZZZ' AS seg, count(*) AS n FROM m WHERE typ = 'ORU' UNION ALL SELECT 'ORU', 'OBX', count(*) FROM m WHERE typ = 'ORU' AND msg_id NOT IN (SELECT msg_id FROM x) HAVING count(*) > 0", "x"))
def seg_not_applicable(spark, d):
    raw = messages(spark, d)
    kinds = raw.select("msg_id", F.split_part("key", F.lit(":"), F.lit(1)).alias("type"))
    return segments.not_applicable(kinds, parse.split_segments(raw), models(spark))


@query("seg_type_gate", sql("SELECT typ = 'ORU' AS ok, count(*) AS n FROM m GROUP BY 1"))
def seg_type_gate(spark, d):
    kinds = headers(spark, d).select("msg_id", F.substring("type9", 1, 3).alias("code"))
    good, bad = segments.type_gate(kinds, "ORU")
    return good.select(F.lit(True).alias("ok")).unionByName(bad.select(F.lit(False).alias("ok"))).groupBy("ok").agg(F.count(F.lit(1)).alias("n"))


@query("seg_dedupe_rows", sql("SELECT DISTINCT msg_id, flag AS f_3_2, st AS f_6 FROM x JOIN m USING (msg_id)", "x"))
def seg_dedupe_rows(spark, d):
    return segments.dedupe_rows(segments.project(modelled(spark, d, ("OBX",)), models(spark), "OBX", ["3|2", "6"])).drop("seg_seq")


_ROWS = "SELECT 'OBX' AS hl7_segment, msg_id, (4 + n)::INT AS seg_seq, part || '|' || flag || '|' || qty || '|' || st AS row FROM x JOIN m USING (msg_id)"


@query("seg_fan_out", sql(f"{_ROWS} UNION ALL SELECT 'PID', msg_id, 2, mrn || '^^^' || ssn || '^^' || '|' || 'MRN^SS|' || fac || '^' FROM m UNION ALL SELECT 'PV1', msg_id, 3, cls FROM m WHERE cls <> ''", "x"))
def seg_fan_out(spark, d):
    return segments.fan_out(modelled(spark, d, ("OBX", "PID", "PV1")), models(spark))


@query("seg_row_delimited", sql("SELECT msg_id, (4 + n)::INT AS seg_seq, part || '|' || flag || '|' || qty || '|' || st AS row FROM x JOIN m USING (msg_id)", "x"))
def seg_row_delimited(spark, d):
    from clinflow.operators.routing import delimited_row

    rows = segments.project(modelled(spark, d, ("OBX",)), models(spark), "OBX", OBX)
    return rows.select("msg_id", "seg_seq", delimited_row([f"f_{p.replace('|', '_')}" for p in OBX]).alias("row"))


@query("seg_view", sql(f"SELECT * EXCLUDE (hl7_segment) FROM ({_ROWS})", "x"))
def seg_view(spark, d):
    segments.segment_view(segments.fan_out(occurrences(spark, d, "OBX"), models(spark)), "OBX", "v_obx")
    return spark.sql("SELECT msg_id, seg_seq, row FROM v_obx")


# --- filters ----------------------------------------------------------------------------------------------------------


def _flt(name: str, where: str, test):
    def run(spark, d):
        return headers(spark, d).filter(test(F.col("prio"))).select("msg_id", "prio")

    query(name, sql(f"SELECT msg_id, prio FROM m WHERE {where}"))(run)


_flt("flt_equal", "prio = '1-URGENT'", lambda v: flt.equal(v, "1-URGENT"))
_flt("flt_notequal", "prio <> '1-URGENT'", lambda v: flt.not_equal(v, "1-URGENT"))
_flt("flt_contains", "prio LIKE '%IG%'", lambda v: flt.contains(v, "IG"))
_flt("flt_startswith", "starts_with(prio, '3')", lambda v: flt.starts_with(v, "3"))
_flt("flt_compare", "prio = '2-HIGH'", lambda v: flt.CONDITIONS["COMPARE"](v, "2-HIGH"))
_flt("flt_equal_ignorecase", "lower(prio) = '2-high'", lambda v: flt.equal_ignore_case(v, "2-hIGH"))
_flt("flt_in", "prio IN ('1-URGENT', '2-HIGH')", lambda v: flt.is_in(v, "1-URGENT:2-HIGH"))


def _ordered(name: str, where: str, older: str, test):
    """Both forms of an order test: as it reads, and the older one with its sides changed."""

    def run(spark, d):
        rows = headers(spark, d).select("msg_id", "prio", F.explode(F.array(F.lit(False), F.lit(True))).alias("compat"))
        return rows.filter(F.when(F.col("compat"), test(F.col("prio"), True)).otherwise(test(F.col("prio"), False)))

    query(name, sql(f"SELECT msg_id, prio, false AS compat FROM m WHERE {where} UNION ALL SELECT msg_id, prio, true FROM m WHERE {older}"))(run)


_ordered("flt_gt", "prio > '2-HIGH'", "'2-HIGH' > prio", lambda v, compat: flt.gt(v, "2-HIGH", compat))
_ordered("flt_lt", "prio < '2-HIGH'", "'2-HIGH' < prio", lambda v, compat: flt.lt(v, "2-HIGH", compat))
_ordered("flt_gte", "prio >= '2-HIGH'", "'2-HIGH' >= prio", lambda v, compat: flt.gte(v, "2-HIGH", compat))
_ordered("flt_lte", "prio <= '2-HIGH'", "'2-HIGH' <= prio", lambda v, compat: flt.lte(v, "2-HIGH", compat))
_ordered("flt_between", "prio > '1-URGENT' AND prio < '4'", "'1-URGENT' > prio AND '4' < prio", lambda v, compat: flt.between(v, "1-URGENT", "4", compat))




def named(spark, d):
    name = F.expr("case when seg = 'OBX' and field = 3 and comp = 2 then 'flag' when seg = 'OBX' and field = 5 then 'qty' when seg = 'PV1' and field = 2 then 'class' when seg = 'PID' and field = 3 and comp = 1 then 'id' when seg = 'OBR' and field = 4 and comp = 1 then 'prio' end")
    return elements(spark, d, ("OBX", "PV1", "PID", "OBR")).withColumn("name", name).filter("name is not null and value is not null")


@query("flt_any_segment", sql("SELECT msg_id, coalesce(bool_or(flag = 'R'), false) AS passed FROM m LEFT JOIN x USING (msg_id) GROUP BY 1", "x"))
def flt_any_segment(spark, d):
    return flt.apply(named(spark, d), [flt.Filter("OBX", "flag", "R", "EQUAL")])


@query("flt_nested_path", sql("SELECT msg_id, 2 AS seg_seq, ssn AS value FROM m"))
def flt_nested_path(spark, d):
    return flt.nested_path(named(spark, d), "PID", "id")


FILTERS = [flt.Filter("OBX", "flag", "R", "EQUAL", "AND"), flt.Filter("PV1", "class", "", "IN", "OR", "I:E"), flt.Filter("OBR", "prio", "1", "STARTSWITH")]
_PASS = "SELECT msg_id, (coalesce(bool_or(flag = 'R'), false) AND any_value(cls) IN ('I', 'E')) OR any_value(prio) LIKE '1%' AS passed FROM m LEFT JOIN x USING (msg_id) GROUP BY 1"


@query("flt_expression", sql("SELECT msg_id, (prio > '2' AND cls = 'I') OR fac = 'F03' AS passed FROM m"))
def flt_expression(spark, d):
    fs = [flt.Filter("OBR", "prio", "2", "GT", "AND"), flt.Filter("PV1", "class", "I", "EQUAL", "OR"), flt.Filter("MSH", "fac", "F03", "EQUAL")]
    cols = [flt.condition(f, F.col(c)) for f, c in zip(fs, ("prio", "cls", "fac"), strict=True)]
    return headers(spark, d).select("msg_id", flt.expression(fs, cols).alias("passed"))


@query("flt_apply", sql(_PASS, "x"))
def flt_apply(spark, d):
    return flt.apply(named(spark, d), FILTERS)


# --- fields and extracts ----------------------------------------------------------------------------------------------

_EXT = "SELECT msg_id, any_value(mrn) || '^' || any_value(ssn) AS id, any_value(cls) AS class, coalesce(string_agg(flag, '^' ORDER BY n), '') AS flag FROM m LEFT JOIN x USING (msg_id) GROUP BY 1"


@query("ext_project", sql(_EXT, "x"))
def ext_project(spark, d):
    return enrich.extract_project(named(spark, d), ["id", "class", "flag"])


@query("ext_first_value", sql("SELECT msg_id, CASE WHEN msg_id % 2 = 0 THEN mrn ELSE ssn END AS ids FROM m"))
def ext_first_value(spark, d):
    rows = headers(spark, d).select("msg_id", F.when(F.expr("msg_id % 2 = 0"), F.concat("mrn", F.lit("^"), "ssn")).otherwise(F.concat(F.lit("^ ^"), "ssn")).alias("ids"))
    return fld.first_value(rows, ["ids"])


@query("ext_rename", sql("SELECT msg_id, mrn AS patient, fac || prio AS place, '' AS nothing FROM m"))
def ext_rename(spark, d):
    return fld.rename(headers(spark, d), [("mrn", "patient"), ("fac", "place"), ("prio", "place"), ("absent", "nothing")])


@query("ext_multi_source", sql("SELECT msg_id, coalesce(nullif(cls, ''), nullif(ctrl, ''), '') AS v FROM m"))
def ext_multi_source(spark, d):
    return headers(spark, d).select("msg_id", fld.multi_source([F.col("cls"), F.col("ctrl")]).alias("v"))


@query("ext_same_target_concat", sql("SELECT msg_id, cls || prio AS v FROM m"))
def ext_same_target_concat(spark, d):
    return fld.rename(headers(spark, d), [("cls", "v"), ("prio", "v")])


@query("fld_select_by_code", sql("SELECT msg_id, ssn AS picked FROM m"))
def fld_select_by_code(spark, d):
    rows = headers(spark, d).select("msg_id", F.lit("MRN^SS^XX").alias("codes"), F.concat_ws("^", "mrn", "ssn", F.lit("")).alias("ids"))
    return fld.select_by_code(rows, "codes", "SS", "ids", "picked", True)


@query("fld_combine", sql("SELECT msg_id, fac || '-' || cls || '-' || prio AS v FROM m"))
def fld_combine(spark, d):
    return fld.combine(headers(spark, d).select("msg_id", "fac", "cls", "prio"), ["fac", "cls", "prio"], "v", "-", "DELETE")


@query("fld_blank_if_contains", sql("SELECT msg_id, CASE WHEN prio ILIKE '%urgent%' THEN '' ELSE prio END AS prio FROM m"))
def fld_blank_if_contains(spark, d):
    return fld.blank_if_contains(headers(spark, d).select("msg_id", "prio"), "prio", "Urgent")


@query("fld_static_map", sql("SELECT msg_id, CASE WHEN cls IN ('', 'I') THEN 'inpatient' WHEN cls = 'E' THEN 'emergency' END AS cls FROM m"))
def fld_static_map(spark, d):
    return fld.static_map(headers(spark, d).select("msg_id", "cls"), [("cls", "I", "inpatient"), ("cls", "E", "emergency")])


@query("fld_pipeline", sql("SELECT msg_id, CASE WHEN cls IN ('', 'I') THEN 'inpatient' ELSE cls END || '/' || CASE WHEN prio LIKE '%LOW%' THEN '' ELSE prio END AS v FROM m"))
def fld_pipeline(spark, d):
    steps = [lambda x: fld.static_map(x, [("cls", "I", "inpatient")]), lambda x: fld.blank_if_contains(x, "prio", "low"), lambda x: fld.combine(x, ["cls", "prio"], "v", "/", "DELETE")]
    return fld.pipeline(headers(spark, d).select("msg_id", "cls", "prio"), steps)


@query("ext_custom_transform", sql("SELECT msg_id, upper(n1) AS name FROM m"))
def ext_custom_transform(spark, d):
    fld.custom_transform("upper_name")(lambda x: x.select("msg_id", F.upper(F.split_part("name", F.lit("^"), F.lit(1))).alias("name")))
    return headers(spark, d).transform(fld.TRANSFORMS["upper_name"])


def _reference(spark, d):
    nation = table(spark, d, "nation")
    fac = F.concat(F.lit("F"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return nation.select(F.col("n_nationkey").alias("pos"), fac.alias("facility"), F.lit("I").alias("location"), F.concat(F.lit("C"), "n_nationkey").alias("coid"), F.concat(F.lit("R"), "n_regionkey").alias("network"), F.col("n_name").alias("description"))


def _placed(spark, d):
    return headers(spark, d).select("msg_id", F.col("fac").alias("facility"), F.col("cls").alias("location"))


_FAC = "nation ON fac = 'F' || lpad(n_nationkey::VARCHAR, 2, '0') AND n_regionkey <> 4"


@query("enr_facility", sql(f"SELECT msg_id, fac AS facility, cls AS location, 'C' || n_nationkey AS coid, 'R' || n_regionkey AS network, n_name AS description FROM m LEFT JOIN {_FAC}"))
def enr_facility(spark, d):
    return enrich.facility(_placed(spark, d), _reference(spark, d).filter("network <> 'R4'"))


@query("enr_facility_crossref", sql(f"SELECT msg_id, CASE WHEN fac = 'F03' AND cls = 'I' THEN 'F99' ELSE fac END AS facility, cls AS location, CASE WHEN fac = 'F03' AND cls = 'I' THEN 'C99' ELSE 'C' || n_nationkey END AS coid, CASE WHEN fac = 'F03' AND cls = 'I' THEN 'R9' ELSE 'R' || n_regionkey END AS network, n_name AS description FROM m LEFT JOIN {_FAC}"))
def enr_facility_crossref(spark, d):
    cross = local(spark, [("F03", "I", "C99", "F99", "R9")], "facility string, location string, new_coid string, new_facility string, new_network string")
    return enrich.facility_crossref(enrich.facility(_placed(spark, d), _reference(spark, d).filter("network <> 'R4'")), cross)


@query("enr_patient_fill", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND c_acctbal > 0 THEN c_mktsegment WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS status FROM orders JOIN customer ON o_custkey = c_custkey")
def enr_patient_fill(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("status"))
    store = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("row_key"), "c_mktsegment")
    return enrich.patient_fill(rows, store, "o_custkey", {"status": "c_mktsegment"}).select("o_orderkey", "status")


@query("enr_patient_cache_build", sql("SELECT urn AS row_key, arg_max(ssn, (t7, msg_id)) AS ssn, arg_max(cls, (t7, msg_id)) FILTER (cls <> '') AS cls FROM m WHERE typ = 'ADT' GROUP BY 1"))
def enr_patient_cache_build(spark, d):
    rows = headers(spark, d).filter("type9 like 'ADT%'").withColumn("ts", F.struct("t7", "msg_id"))
    return enrich.patient_cache(rows, ["urn"], ["ssn", "cls"], "ts")


@query("enr_explode_observations", sql("SELECT msg_id, (n - 1)::INT AS idx, part AS obsv_id, flag AS units, CASE WHEN n = 1 THEN 'x' ELSE '' END AS note FROM x JOIN m USING (msg_id)", "x"))
def enr_explode_observations(spark, d):
    return enrich.explode_observations(_lists(spark, d), ["obsv_id", "units", "note"])


def _lists(spark, d):
    name = F.expr("case when comp = 1 then 'obsv_id' when comp = 2 then 'units' end")
    rows = elements(spark, d, ("OBX",)).filter("field = 3").withColumn("name", name)
    return enrich.extract_project(rows, ["obsv_id", "units"]).withColumn("note", F.lit("x"))


@query("enr_reject_bad_observation", sql("SELECT CASE WHEN flag = 'N' THEN 'PARTIAL_REJECT: not an integer: units' END AS reject_reason, count(*) AS n FROM x JOIN m USING (msg_id) GROUP BY 1", "x"))
def enr_reject_bad_observation(spark, d):
    rows = enrich.explode_observations(_lists(spark, d), ["obsv_id", "units", "note"]).withColumn("units", F.when(F.col("units") == "N", "N").otherwise("7"))
    good, bad = enrich.reject_bad_observation(rows, ["obsv_id", "units"])
    return good.select(F.lit(None).cast("string").alias("reject_reason")).unionByName(bad.select("reject_reason")).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def _fmt(name: str, fmt: str, body: str):
    def run(spark, d):
        return enrich.payload(headers(spark, d).withColumn("raw", F.col("ctrl")), ["fac", "cls"], fmt, as_of())

    query(name, sql(body))(run)


_JSON = f"""'{{"fac":"' || fac || '","cls":"' || cls || '","etl_firstinsert_datetime":"' || {STAMP} || '"}}'"""
_fmt("ext_format_json", "JSON", f"SELECT msg_id, {_JSON} AS payload FROM m")
_fmt("ext_format_delimited", "DELIMITED", f"SELECT msg_id, fac || '|' || cls || '|' || {STAMP} AS payload FROM m")
_fmt("ext_format_raw", "RAWDATA", "SELECT msg_id, ctrl AS payload FROM m")
_fmt("ext_format_raw_json", "RAWDATA_JSON", f"SELECT msg_id, ctrl AS payload FROM m UNION ALL SELECT msg_id, {_JSON} FROM m")


@query("ext_route", sql("SELECT msg_id, CASE typ WHEN 'ADT' THEN 'KAFKA' WHEN 'ORU' THEN 'WSMQ' ELSE 'HBASE' END AS dest_system, 'T.' || typ AS dest_route FROM m WHERE typ <> 'ORM'"))
def ext_route(spark, d):
    rows = headers(spark, d).select("msg_id", F.substring("type9", 1, 3).alias("type"))
    asked = {"ADT": "JSON", "ORU": "RAWDATA", "MDM": "RAWDATA_JSON"}
    routed = [enrich.route(rows.filter(F.col("type") == kind).drop("type"), enrich.SYSTEMS[fmt], f"T.{kind}") for kind, fmt in asked.items()]
    return routed[0].unionByName(routed[1]).unionByName(routed[2])


@query("ext_run", sql(f"SELECT msg_id, CASE WHEN passed THEN id || '|' || class || '|' || flag || '|' || {STAMP} END AS payload, CASE WHEN passed THEN 'T.ADHOC' END AS dest_route, CASE WHEN NOT passed THEN 'FILTERED' END AS state FROM ({_PASS}) JOIN ({_EXT}) USING (msg_id)", "x"))
def ext_run(spark, d):
    return enrich.extract(named(spark, d), FILTERS, ["id", "class", "flag"], "DELIMITED", "KAFKA", "T.ADHOC", as_of()).drop("dest_system")


@query("flt_in_list", "SELECT count(*) AS n, sum(l_orderkey)::BIGINT AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 20)")
def flt_in_list(spark, d):
    """Lines of the parts of a list that grows with the tables."""
    wanted = table(spark, d, "part").filter("p_size < 20").select(F.col("p_partkey").alias("value"))
    return in_list(table(spark, d, "lineitem"), "l_partkey", wanted).agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"))
