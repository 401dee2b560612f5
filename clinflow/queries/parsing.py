"""Sources and message parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.operators import feeds, naming, parse
from clinflow.queries.base import local, own, sql, types
from clinflow.registry import query
from clinflow.sources.synth import messages, table

BY = ["seg", "field", "rep", "comp"]


def _summary(rows: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    # with a collecting aggregate (of nothing: null is not collected) Spark keeps the few groups as objects; for texts' least and most alone it sorts all rows
    none = F.size(F.collect_list(F.lit(None).cast("int")))
    return rows.groupBy(*by).agg((F.count(F.lit(1)) + none).alias("n"), F.min(value).alias("least"), F.max(value).alias("most"))


@query(
    "entry_observations_by_type",
    sql("SELECT typ AS type, fac AS facility, count(*) AS n_observations, sum(qty::DECIMAL(12,2))::DOUBLE AS quantity FROM m JOIN x USING (msg_id) GROUP BY ALL", "x"),
)
def entry(spark, d):
    rows = parse.elements(messages(spark, d), fields={"MSH": (4, 9), "OBX": (5,)})
    wanted = rows.filter("(seg = 'MSH' and field in (4, 9) and comp = 1) or (seg = 'OBX' and field = 5)")
    by = wanted.groupBy("msg_id").agg(
        F.max(F.when(F.expr("seg = 'MSH' and field = 9"), F.col("value"))).alias("type"),
        F.max(F.when(F.expr("seg = 'MSH' and field = 4"), F.col("value"))).alias("facility"),
        F.count(F.when(F.col("seg") == "OBX", 1)).alias("n"),
        F.sum(F.when(F.col("seg") == "OBX", F.expr("try_cast(value as decimal(12,2))"))).alias("q"),
    )
    return by.filter("n > 0").groupBy("type", "facility").agg(F.sum("n").alias("n_observations"), F.sum("q").cast("double").alias("quantity"))


@query("msg_split_segments", sql("SELECT seg, seg_seq, count(*) AS n FROM (SELECT DISTINCT msg_id, seg, seg_seq FROM e) GROUP BY ALL", "e"))
def split_segments(spark, d):
    return parse.split_segments(messages(spark, d)).groupBy("seg", "seg_seq").agg(F.count(F.lit(1)).alias("n"))


@query("msg_delimiters", sql(rf"SELECT {own(chr(39) + '|' + chr(39))} AS d_field, {own(chr(39) + '^' + chr(39))} AS d_comp, {own(chr(39) + '~' + chr(39))} AS d_rep, '\' AS d_escape, {own(chr(39) + '&' + chr(39))} AS d_sub, '//' AS d_trunc, count(*) AS n FROM m GROUP BY ALL"))
def delimiters(spark, d):
    return parse.delimiters(messages(spark, d)).groupBy("d_field", "d_comp", "d_rep", "d_escape", "d_sub", "d_trunc").agg(F.count(F.lit(1)).alias("n"))


_FIELDS = f"""f AS (SELECT seg, field, {own("string_agg(v, '~' ORDER BY rep)")} AS text FROM (
  SELECT msg_id, seg_seq, seg, field, rep, CASE WHEN seg = 'PID' AND field = 3 AND rep = 1 THEN max(value) FILTER (comp = 1) || '^^^' || max(value) FILTER (comp = 4) || '^MRN'
    WHEN seg = 'PID' AND field = 3 THEN max(value) FILTER (comp = 1) || '^^^^SS' ELSE string_agg(value, '^' ORDER BY comp) END AS v FROM e GROUP BY msg_id, seg_seq, seg, field, rep) GROUP BY msg_id, seg_seq, seg, field)"""


@query("msg_split_fields", sql("SELECT seg, field, count(*) AS n, min(text) AS least, max(text) AS most FROM f GROUP BY ALL", "e", _FIELDS))
def split_fields(spark, d):
    rows = parse.split_fields(parse.split_segments(messages(spark, d))).filter("text <> ''")
    return _summary(rows.withColumn("text", parse.as_sent(F.col("text"), F.col("own"))), ["seg", "field"], "text")


@query("msg_split_repetitions", sql("SELECT seg, field, rep, count(*) AS n FROM (SELECT DISTINCT msg_id, seg_seq, seg, field, rep FROM e) GROUP BY ALL", "e"))
def split_repetitions(spark, d):
    rows = parse.split_repetitions(parse.split_fields(parse.split_segments(messages(spark, d))).filter("text <> ''"))
    return rows.filter("text <> ''").groupBy("seg", "field", "rep").agg(F.count(F.lit(1)).alias("n"))


@query("msg_split_components", sql("SELECT seg, field, rep, comp, count(*) AS n, min(value) AS least, max(value) AS most FROM e GROUP BY ALL", "e"))
def split_components(spark, d):
    fields = parse.split_fields(parse.split_segments(messages(spark, d))).filter("text <> ''")  # an empty field has no other component
    rows = parse.split_components(parse.split_repetitions(fields))
    return _summary(rows.filter("text <> ''").withColumn("text", parse.as_sent(F.col("text"), F.col("own"))), BY, "text")


@query("msg_split_subcomponents", sql("SELECT seg, field, rep, comp, 1 AS sub, count(*) AS n, min(value) AS least, max(value) AS most FROM e GROUP BY ALL", "e"))
def split_subcomponents(spark, d):
    return _summary(parse.elements(messages(spark, d), filled=True), [*BY, "sub"])


@query("msg_elements", sql("SELECT msg_id, count(*) AS n, count(DISTINCT seg_seq) AS segments, sum(strlen(value))::BIGINT AS chars FROM e GROUP BY ALL", "e"))
def elements(spark, d):
    rows = parse.elements(messages(spark, d), filled=True)
    return rows.groupBy("msg_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("seg_seq").alias("segments"), F.sum(F.length("value")).alias("chars"))


_REPEATED = """SELECT p_partkey, unnest([{'text': p_brand || '~' || p_type, 'kept': p_brand || '~' || p_type}, {'text': p_brand || '^' || p_size || '~' || p_type, 'kept': p_brand || '^' || p_size},
  {'text': p_brand || '~' || p_type || '^' || p_size || '~' || p_name || '^', 'kept': p_type || '^' || p_size || ',' || p_name || '^'}], recursive := true) FROM part"""


@query("msg_simple_repeat_rule", _REPEATED)
def simple_repeats(spark, d):
    join = lambda *x: F.concat(*[F.lit(v) if v in "~^" else F.col(v) for v in x])
    cases = F.array(join("p_brand", "~", "p_type"), join("p_brand", "^", "p_size", "~", "p_type"), join("p_brand", "~", "p_type", "^", "p_size", "~", "p_name", "^"))
    rows = parse.simple_repeats(table(spark, d, "part").select("p_partkey", F.explode(cases).alias("text")))
    return rows.select("p_partkey", "text", F.array_join("kept", ",").alias("kept"))


@query("msg_type_from_key", sql("SELECT typ AS found, CASE WHEN typ <> 'ORM' THEN typ END AS type, count(*) AS n FROM m GROUP BY ALL"))
def type_from_key(spark, d):
    rows = parse.type_from_key(messages(spark, d), types(spark))
    return rows.groupBy(F.split_part("key", F.lit(":"), F.lit(1)).alias("found"), "type").agg(F.count(F.lit(1)).alias("n"))


_CODE = "CASE WHEN typ = 'ORU' AND starts_with(ctrl, 'IP') THEN 'IPLORU' ELSE typ END"


@query("msg_type_from_body", sql(f"SELECT CASE WHEN typ <> 'ORM' THEN {_CODE} END AS type, CASE WHEN typ = 'ORM' THEN 'UnknownMessageType' END AS reject_reason, count(*) AS n FROM m GROUP BY ALL"))
def type_from_body(spark, d):
    return parse.type_from_body(messages(spark, d), types(spark)).groupBy("type", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


_META = "coalesce(nullif(ctrl, ''), 'no message control ID') AS control_id, t7 AS create_time, mrn, urn, acct AS account, fac AS facility, trig AS trigger"


@query("msg_meta_fast", sql(f"SELECT msg_id, {_META} FROM m"))
def meta_fast(spark, d):
    return parse.meta_fast(messages(spark, d)).select("msg_id", "control_id", "create_time", "mrn", "urn", "account", "facility", "trigger")


SUPPORTED = [("MT6", "2.4", "MT6_2.4"), ("MT", "2.5", "MT_2.5"), ("EPIC", "2.3", "EPIC_2.3"), ("NG", "2.3", "NG_2.3")]


def sources(spark, d):
    return naming.source_system(messages(spark, d), local(spark, SUPPORTED, "src string, ver string, tpl string"))


_SRC = """s AS (SELECT msg_id, CASE WHEN ctrl <> '' THEN rtrim(prefix, '_') END AS src, ver, fac FROM m),
t AS (SELECT *, CASE WHEN src IN ('MT6', 'MT', 'EPIC', 'NG') THEN src || '_' || ver END AS tpl FROM s)"""


@query("msg_source_system", sql("SELECT * FROM t", _SRC))
def source_system(spark, d):
    return sources(spark, d)


#: Invented templates: (tpl, elem_key, names).
TEMPLATES = [
    ("STD", "MSH.4.1", ["sending_facility", ""]), ("STD", "MSH.10.1", ["message_control_id"]), ("STD", "MSH.9.1", ["message_type", "message_code"]), ("STD", "MSH.9.2", ["message_type", "trigger_event"]),
    ("STD", "PID.3.1", ["patient_id", "id_number"]), ("STD", "PID.3.5", ["patient_id", "id_code"]), ("STD", "PID.4.1", ["record_urn"]), ("STD", "PID.18.1", ["account"]), ("STD", "PV1.2.1", ["patient_class"]),
    ("STD", "OBX.3.1", ["observation", "obsv_id"]), ("STD", "OBX.5.1", ["observation_value"]), ("STD", "OBX.6.1", ["units"]), ("STD", "OBR.4.1", ["service.id"]),
    ("MT6_2.4", "OBX.5.1", ["obsv_value", "", ""]), ("EPIC_2.3", "PV1.2.1", ["visit", "class_code"]), ("FAC:F03", "OBX.5.1", ["local_value"]), ("ALIGN:EPIC", "PID.18.1", ["visit_account"]),
]


def named(spark, d):
    templates = local(spark, TEMPLATES, "tpl string, elem_key string, names array<string>")
    raw = naming.with_source(messages(spark, d), local(spark, SUPPORTED, "src string, ver string, tpl string"))
    return naming.name_elements(parse.elements(raw, keep=naming.SOURCE, filled=True), templates)


_KEY = "seg || '.' || field || '.' || comp"
_NAMED = _SRC + f""",
std(k, nm) AS (VALUES ('MSH.4.1','sending_facility'),('MSH.10.1','message_control_id'),('MSH.9.1','message_code'),('MSH.9.2','trigger_event'),('PID.3.1','id_number'),('PID.3.5','id_code'),('PID.4.1','record_urn'),('PID.18.1','account'),
 ('PV1.2.1','patient_class'),('OBX.3.1','obsv_id'),('OBX.5.1','observation_value'),('OBX.6.1','units')),
ne AS (SELECT e.*, {_KEY} AS elem_key, CASE WHEN src = 'EPIC' AND {_KEY} = 'PID.18.1' THEN 'realignment' WHEN fac = 'F03' AND {_KEY} = 'OBX.5.1' THEN 'facility'
  WHEN tpl = 'MT6_2.4' AND {_KEY} = 'OBX.5.1' OR tpl = 'EPIC_2.3' AND {_KEY} = 'PV1.2.1' THEN 'source' WHEN nm IS NOT NULL THEN 'standard' ELSE 'unknown' END AS name_source, nm
  FROM e JOIN t USING (msg_id) LEFT JOIN std ON k = {_KEY}),
nd AS (SELECT * EXCLUDE (nm), CASE name_source WHEN 'realignment' THEN 'visit_account' WHEN 'facility' THEN 'local_value' WHEN 'source' THEN CASE WHEN seg = 'OBX' THEN 'obsv_value' ELSE 'class_code' END WHEN 'standard' THEN nm ELSE 'unknown' END AS name FROM ne)"""


@query("msg_name_elements", sql("SELECT elem_key, name, name_source, count(*) AS n FROM nd GROUP BY ALL", "e", _NAMED))
def name_elements(spark, d):
    return named(spark, d).groupBy("elem_key", "name", "name_source").agg(F.count(F.lit(1)).alias("n"))


@query("msg_unknown_mapping", sql("SELECT msg_id, string_agg(elem_key, ',' ORDER BY elem_key) AS missing_keys FROM (SELECT DISTINCT msg_id, elem_key FROM nd WHERE name = 'unknown') GROUP BY 1", "e", _NAMED))
def unknown_mapping(spark, d):
    return naming.unknown_mapping(named(spark, d))


@query("msg_unknown_values", sql("SELECT msg_id, seg_seq, string_agg(value, '^' ORDER BY field, rep, comp) AS unknown FROM nd WHERE name = 'unknown' GROUP BY ALL", "e", _NAMED))
def unknown_values(spark, d):
    return naming.unknown_values(named(spark, d))


@query("msg_realign_move", sql("SELECT seg, CASE WHEN seg = 'PID' AND field = 5 THEN 6 ELSE field END AS field, rep, CASE WHEN seg = 'PID' AND field = 5 THEN 2 ELSE comp END AS comp, CASE WHEN seg = 'PID' AND field = 5 THEN comp ELSE 1 END AS sub, count(*) AS n FROM e WHERE seg = 'PID' GROUP BY ALL", "e"))
def realign_move(spark, d):
    rules = local(spark, [("PID", 5, 6, 2)], "seg string, field int, to_field int, to_comp int")
    return naming.realign_move(parse.elements(messages(spark, d), ("PID",), filled=True), rules).groupBy("seg", "field", "rep", "comp", "sub").agg(F.count(F.lit(1)).alias("n"))


#: An invented crosswalk: the parts of a name become parts of its second component.
CROSSWALK = ["EPIC_2.3_PID.5.1,2.3,,PID.5.1,patient,last,,PID.5.2.1,patient,name,family_name,move", "EPIC_2.3_PID.5.2,2.3,,PID.5.2,patient,first,,PID.5.2.2,patient,name,given_name,move", "MT_2.5_PID.5.1,2.5,,PID.5.1,patient,last,,PID.5.1,patient,,,merge"]


@query(
    "msg_realign_names",
    sql("""SELECT comp, sub, name, count(*) AS n, min(value) AS least, max(value) AS most FROM (SELECT unnest(CASE tpl
      WHEN 'EPIC_2.3' THEN [{'comp': 2, 'sub': 1, 'name': 'family_name', 'value': n1}, {'comp': 2, 'sub': 2, 'name': 'given_name', 'value': n2}]
      WHEN 'MT_2.5' THEN [{'comp': 1, 'sub': 1, 'name': 'whole_name', 'value': n1 || n2}]
      ELSE [{'comp': 1, 'sub': 1, 'name': 'whole_name', 'value': n1}, {'comp': 2, 'sub': 1, 'name': 'unknown', 'value': n2}] END, recursive := true) FROM m JOIN t USING (msg_id)) GROUP BY ALL""", _SRC),
)
def realign_names(spark, d):
    """Fields moved and merged while messages are parsed; moved parts have the crosswalk's names, other templates' messages their own."""
    rules, names = naming.crosswalk(local(spark, [(x,) for x in CROSSWALK], "value string"))
    templates = local(spark, [("STD", "PID.5.1", ["whole_name"])], "tpl string, elem_key string, names array<string>").unionByName(names)
    raw = naming.with_source(messages(spark, d), local(spark, SUPPORTED, "src string, ver string, tpl string"))
    rows = naming.name_elements(parse.elements(raw, ("PID",), naming.SOURCE, realign=rules, fields={"PID": (5,)}, filled=True), templates)
    return _summary(rows, ["comp", "sub", "name"])


@query("msg_realign_merge", sql("SELECT msg_id, 2 AS seg_seq, 'PID' AS seg, 5 AS field, 1 AS rep, n1 || n2 AS value FROM m"))
def realign_merge(spark, d):
    rules = local(spark, [("PID", 5)], "seg string, field int")
    return naming.realign_merge(parse.elements(messages(spark, d), ("PID",), fields={"PID": (5,)}, filled=True), rules)


RULES = [
    ("sending_facility", 1, "MSH", 4, 1, None, None), ("message_control_id", 1, "MSH", 10, 1, None, None), ("medical_record_num", 1, "PID", 3, 1, 5, "MRN"), ("medical_record_urn", 1, "PID", 4, 1, None, None),
    ("patient_account_num", 1, "PID", 18, 2, None, None), ("patient_account_num", 2, "PID", 18, 1, None, None),
]
TARGETS = ["sending_facility", "message_control_id", "medical_record_num", "medical_record_urn", "patient_account_num"]
RULE = "target string, rule int, seg string, field int, want_comp int, code_comp int, code string"
IDS = "fac AS sending_facility, nullif(ctrl, '') AS message_control_id, mrn AS medical_record_num, urn AS medical_record_urn, acct AS patient_account_num"


def asked(rules: list[tuple]) -> dict[str, tuple[int, ...]]:
    """The fields that lookup rules read, by segment."""
    return {seg: tuple(sorted({r[3] for r in rules if r[2] == seg})) for seg in {r[2] for r in rules}}


def common(spark, d, more=()):
    """The common ids of each message, and what ``more`` rules find, by the name of their target."""
    rules = [*RULES, *more]
    return naming.common_elements(parse.elements(messages(spark, d), fields=asked(rules), filled=True), local(spark, rules, RULE), [*TARGETS, *(r[0] for r in more)])


@query("msg_common_elements", sql(f"SELECT msg_id, {IDS} FROM m"))
def common_elements(spark, d):
    return common(spark, d)


@query("msg_path_lookup", sql("SELECT msg_id, 'ssn' AS target, ssn AS value FROM m UNION ALL SELECT msg_id, 'class', coalesce(nullif(cls, ''), prio) FROM m"))
def path_lookup(spark, d):
    rules = [("ssn", 1, "PID", 3, 1, 5, "SS"), ("class", 1, "PV1", 2, 1, None, None), ("class", 2, "OBR", 4, 1, None, None)]
    return naming.path_lookup(parse.elements(messages(spark, d), fields=asked(rules), filled=True), local(spark, rules, RULE))


@query("msg_interface_override", sql("SELECT msg_id, ctrl AS message_control_id, CASE WHEN NOT (ctrl LIKE '%GTMRI%' AND msg_id % 7 <> 0) THEN CASE WHEN msg_id % 7 = 0 THEN 'A' ELSE 'U' END END AS patient_account_num FROM (SELECT msg_id, CASE WHEN msg_id % 3 = 0 THEN 'GTMRI' ELSE '' END || ctrl AS ctrl FROM m)"))
def interface_override(spark, d):
    ids = naming.header_ids(messages(spark, d)).select("msg_id", F.concat(F.when(F.expr("msg_id % 3 = 0"), "GTMRI").otherwise(""), "message_control_id").alias("message_control_id"), F.lit("U").alias("medical_record_urn"), F.when(F.expr("msg_id % 7 = 0"), "A").otherwise("U").alias("patient_account_num"))
    return naming.interface_override(ids, "GTMRI").drop("medical_record_urn")


@query("msg_validate", sql("SELECT CASE WHEN ctrl = '' THEN 'blank message_control_id' END AS reject_reason, count(*) AS n FROM m GROUP BY 1"))
def validate(spark, d):
    return parse.validate(naming.header_ids(messages(spark, d))).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query("msg_reject_multi_header", sql("SELECT msg_id, CASE WHEN msg_id % 50 = 0 THEN 'more than one MSH segment' END AS reject_reason FROM m"))
def reject_multi_header(spark, d):
    twice = F.when(F.expr("msg_id % 50 = 0"), F.concat("raw", F.lit("\r\n"), "raw")).otherwise(F.col("raw"))
    return parse.reject_multi_header(messages(spark, d).withColumn("raw", twice))


@query("msg_reject_malformed", sql("SELECT msg_id, CASE WHEN msg_id % 50 = 0 THEN 'empty message' WHEN msg_id % 50 = 1 THEN 'message does not start with MSH' WHEN ctrl = '' THEN 'blank control id' END AS reject_reason FROM m"))
def reject_malformed(spark, d):
    raw = F.when(F.expr("msg_id % 50 = 0"), "").when(F.expr("msg_id % 50 = 1"), F.concat(F.lit("X"), "raw")).otherwise(F.col("raw"))
    return parse.reject_malformed(messages(spark, d).withColumn("raw", raw)).select("msg_id", "reject_reason")


_J = """CASE WHEN {v} = '' THEN 'null' ELSE '"' || {v} || '"' END"""


@query(
    "msg_to_json",
    sql(f"""SELECT msg_id, '{{"PV1":{{"set":"1","class":' || {_J.format(v='cls')} || '}}' || coalesce(',"OBX":' || o, '') || '}}' AS json FROM m
    LEFT JOIN (SELECT msg_id, CASE WHEN count(*) > 1 THEN '[' ELSE '' END || string_agg('{{"value":"' || qty || '","units":"' || st || '"}}', ',' ORDER BY n) || CASE WHEN count(*) > 1 THEN ']' ELSE '' END AS o FROM x GROUP BY 1) USING (msg_id)""", "x"),
)
def to_json(spark, d):
    return naming.to_json(_short(spark, d))


def _short(spark, d):
    pv1 = parse.first_line(F.col("raw"), "PV1")
    unclassed = F.coalesce(parse.part(pv1, 2, parse.separators(F.col("raw"))), F.lit("")) == ""  # a trailing empty field is no element
    rows = parse.elements(messages(spark, d).withColumn("unclassed", unclassed), None, ("unclassed",), fields={"PV1": (1, 2), "OBX": (5, 6)})
    name = F.expr("case when seg = 'PV1' and field = 1 then 'set' when seg = 'PV1' and field = 2 then 'class' when seg = 'OBX' and field = 5 then 'value' when seg = 'OBX' and field = 6 then 'units' end")
    short = rows.withColumn("name", name).filter("name is not null and (name <> 'class' or not unclassed)")
    one = F.struct("field", "value", "name")
    none = F.struct(F.lit(2).alias("field"), F.lit(None).cast("string").alias("value"), F.lit("class").alias("name"))
    both = F.when((F.col("name") == "set") & F.col("unclassed"), F.array(one, none)).otherwise(F.array(one))
    return short.select("msg_id", "seg_seq", "seg", "rep", "comp", "sub", F.inline(both))


@query(
    "msg_to_json_arrays",
    sql(f"""SELECT msg_id, '{{"PV1":[{{"set":"1","class":' || {_J.format(v='cls')} || '}}]' || coalesce(',"OBX":' || o, '') || '}}' AS json FROM m
    LEFT JOIN (SELECT msg_id, '[' || string_agg('{{"value":"' || qty || '","units":"' || st || '"}}', ',' ORDER BY n) || ']' AS o FROM x GROUP BY 1) USING (msg_id)""", "x"),
)
def to_json_arrays(spark, d):
    return naming.to_json(_short(spark, d), always_lists=True)


@query("msg_variant", sql("SELECT msg_id, cls AS class, qty AS first_value, st AS first_units, NULL::VARCHAR AS other FROM (SELECT msg_id, nullif(cls, '') AS cls FROM m) LEFT JOIN (SELECT msg_id, qty, st FROM x WHERE n = 1) USING (msg_id) WHERE cls IS NOT NULL OR qty IS NOT NULL", "x"))
def msg_variant(spark, d):
    """Messages as VARIANT: one stable column whatever segments a message has, asked by path."""
    rows = feeds.parse_variant(to_json_arrays(spark, d), "json")
    paths = {"class": ("$.PV1[0].class", "string"), "first_value": ("$.OBX[0].value", "string"), "first_units": ("$.OBX[0].units", "string"), "other": ("$.ZZZ[0].value", "string")}
    return feeds.at_paths(rows, paths).filter("class is not null or first_value is not null").select("msg_id", *paths)


@query("msg_strip_nulls", sql("SELECT seg, count(*) AS n FROM e GROUP BY 1", "e"))
def strip_nulls(spark, d):
    return naming.strip_nulls(parse.elements(messages(spark, d))).groupBy("seg").agg(F.count(F.lit(1)).alias("n"))


@query("msg_parse_job", sql("SELECT CASE WHEN ctrl = '' THEN 'REJECTED' ELSE 'PROCESSED' END AS state, typ AS type, count(*) AS n, count(*) FILTER (ctrl <> '') AS unknown_mapping FROM m GROUP BY ALL"))
def parse_job(spark, d):
    from clinflow.plans.parse_job import parse_job as job

    out = job(messages(spark, d), local(spark, TEMPLATES, "tpl string, elem_key string, names array<string>"), local(spark, SUPPORTED, "src string, ver string, tpl string"))
    return out.groupBy("state", "type").agg(F.count(F.lit(1)).alias("n"), F.count("missing_keys").alias("unknown_mapping"))
