"""Edge cases by hand, streams against batches, and sources and sinks that no query covers."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from clinflow.functions import fields, filters, scrub
from clinflow.operators import audit, enrich, feeds, naming, parse, routing, segments
from clinflow.sources import readers, sinks, store, synth
from clinflow.streaming import jobs

SF = "/root/testdata/sf0.001"


def raw(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "msg_id long, raw string")


def values(spark, text):
    rows = parse.elements(raw(spark, text)).collect()
    return {(r.seg, r.field, r.rep, r.comp, r.sub): r.value for r in rows}


def test_trailing_empty_fields_are_dropped(spark):
    v = values(spark, "MSH|^~\\&|A|B\nPID|1||x|||")
    assert max(k[1] for k in v if k[0] == "PID") == 3
    assert v["MSH", 1, 1, 1, 1] == "|" and v["MSH", 2, 1, 1, 1] == "^~\\&" and v["PID", 2, 1, 1, 1] is None


def test_repeats_and_components(spark):
    v = values(spark, "MSH|^~\\&|A\nPID|A~B|C^D~E|F^G&H~I|J&K\nOBX|1|TX|||a~b")
    assert v["PID", 1, 1, 1, 1] == "A~B"
    assert (v["PID", 2, 1, 1, 1], v["PID", 2, 1, 2, 1]) == ("C", "D") and ("PID", 2, 2, 1, 1) not in v
    assert (v["PID", 3, 1, 2, 1], v["PID", 3, 1, 2, 2]) == ("G", "H")
    assert v["PID", 4, 1, 1, 1] == "J&K"
    assert v["OBX", 5, 1, 1, 1] == "a~b"


def test_own_delimiters(spark):
    df = parse.delimiters(raw(spark, "MSH#*~\\&#A#B\nPID#1##x*y"))
    assert df.first().d_field == "#" and df.first().d_comp == "*"
    segs = parse.split_segments(df.select("msg_id", "raw")).join(df.select("msg_id", "d_field"), "msg_id")
    rows = {(r.seg, r.field): r.text for r in parse.split_fields(segs, F.col("d_field")).collect()}
    assert rows["PID", 3] == "x*y" and rows["MSH", 1] == "#"


def test_newlines_and_rejects(spark):
    df = raw(spark, "MSH|^~\\&|A|B|C|D|t||ADT^A01|id\r\nPID|1", "", None, "XXX", "MSH|^~\\&|A", "MSH|1\nMSH|2")
    reasons = [r.reject_reason for r in parse.reject_malformed(df).orderBy("msg_id").collect()]
    assert reasons == [None, "empty message", "empty message", "message does not start with MSH", "blank control id", "blank control id"]
    assert parse.reject_multi_header(df.filter("msg_id = 5")).first().reject_reason == "more than one MSH segment"
    assert raw(spark, "a\n\r\nb").select(parse.normalize_newlines(F.col("raw")).alias("x")).first().x == "a\r\nb"


def test_missing_pid_has_constants(spark):
    r = parse.meta_fast(raw(spark, "MSH|^~\\&|A|B^C")).first()
    assert r.mrn == parse.NO_CONTROL and r.facility == "C"


def test_empty_table_parses(spark):
    assert parse.elements(spark.createDataFrame([], "msg_id long, raw string")).count() == 0


def test_filter_pairs():
    f = lambda joiner: filters.Filter("S", "p", "x", "EQUAL", joiner)
    with pytest.raises(ValueError):
        filters.expression([f("AND"), f("NONE"), f("AND")], [_L(), _L(), _L()])


class _L:
    def __and__(self, other):
        return self

    def __or__(self, other):
        return self


def test_reversed_order_tests(spark):
    r = spark.range(1).select(filters.gt(F.lit("b"), "a").alias("a"), filters.gt(F.lit("b"), "a", True).alias("b"), filters.between(F.lit("b"), "a", "c", True).alias("c")).first()
    assert (r.a, r.b, r.c) == (True, False, False)


def test_unknown_action():
    with pytest.raises(ValueError):
        fields.combine(None, ["a"], "b", "-", "DROP")


def test_join_repeats(spark):
    got = spark.range(1).select(segments.join_repeats(F.array(*map(F.lit, ["", "a", "", "b"]))).alias("x")).first().x
    assert got == "a^^b"


def test_scrub_values_are_literal(spark):
    df = spark.createDataFrame([("a (b) c.d", "(b)^c.d&xy")], "t string, v string")
    assert df.select(scrub.scrub_values(F.col("t"), scrub.value_parts([F.col("v")], 2, []), "").alias("x")).first().x == "a  "


def test_date_shift(spark):
    df = spark.createDataFrame([("20240302",), ("202403020101",), ("20240302010101",), ("20240230",), ("abc",), (None,)], "d string")
    got = [r.x for r in df.select(scrub.date_shift(F.col("d")).alias("x")).collect()]
    assert got == ["20240229", "202402291847", "20240229184745", "20240230", "abc", None]


def test_birth_date_is_capped_and_repeats(spark):
    df = spark.createDataFrame([("19000101", "k"), ("20000101", "k")], "d string, k string")
    got = [r.x for r in df.select(scrub.birth_date(F.col("d"), F.col("k"), "s", F.lit(datetime.date(2024, 6, 1))).alias("x")).collect()]
    assert got[0] >= "19340501" and got[0] <= "19350601" and got[1] <= "20000101"


def test_identifier_keeps_digits(spark):
    got = spark.createDataFrame([("M12",), ("",)], "x string").select(scrub.identifier(F.col("x"), "s").alias("y")).collect()
    assert got[0].y[1:] == "12" and got[0].y[0].isdigit() and got[1].y == ""


def test_java_hash(spark):
    got = spark.createDataFrame([("F01",), ("a" * 12,), ("",)], "x string").select(routing.java_hash(F.col("x")).alias("h")).collect()

    def java(s):
        h = 0
        for c in s:
            h = (h * 31 + ord(c)) & 0xFFFFFFFF
        return h - (1 << 32) if h >= 1 << 31 else h

    assert [r.h for r in got] == [java("F01"), java("a" * 12), 0]


def test_extract_requests():
    (spec,) = readers.extract_requests(["ORU,ADHOC:vent:JSON&keys.csv:TOPIC&KAFKA:f.txt:a&b:true:ENRICH&x,p|q^r"])
    assert spec.system == "KAFKA" and spec.keys == "keys.csv" and spec.first_only == ("a", "b") and spec.ack and spec.paths == ("p|q", "r")


def test_reference_and_templates(spark, tmp_path):
    (tmp_path / "t.csv").write_text("OBX.5.1,value,\nPID.3.1,id, number\n")
    (tmp_path / "p.txt").write_text("a=b=c\n\n d = e\n")
    rows = readers.template_tables(spark, {"STD": f"file://{tmp_path}/t.csv"}).collect()
    assert {(r.tpl, r.elem_key, tuple(r.names)) for r in rows} == {("STD", "OBX.5.1", ("value", "")), ("STD", "PID.3.1", ("id", "number"))}
    pairs = readers.reference_table(spark, f"file://{tmp_path}/p.txt", "pairs").collect()
    assert {(r.key, r.value) for r in pairs} == {("a", "b=c"), ("d", "e")}
    assert readers.roster(spark, f"file://{tmp_path}/p.txt").count() == 2
    assert readers.lines_to_topic(spark, f"file://{tmp_path}/p.txt", "T").first().topic == "T"


def test_replay_specs(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-02-01",), ("7",), ("9",)], "d string")
    n = lambda spec: readers.replay_partitions(df, spec, "d", "2024-01-31").count()
    assert (n("*"), n("2024-01-01between2024-01-31"), n("greaterThan2024-01-01"), n("7>="), n("7>=8"), n("9"), n("greater2024-02-01")) == (4, 1, 1, 2, 1, 1, 3)


def test_rate_limit():
    assert readers.rate_limit("kafka", 1000, 2) == {"maxOffsetsPerTrigger": "2250"}


def test_sequence_file_and_hive(spark, tmp_path):
    path = f"file://{tmp_path}/seq"
    spark.sparkContext.parallelize([("k", "v")]).saveAsSequenceFile(path)
    assert readers.sequence_file(spark, path).collect()[0].value == "v"
    spark.sql("CREATE DATABASE IF NOT EXISTS t_db")
    spark.sql("DROP TABLE IF EXISTS t_db.a")
    spark.range(3).write.saveAsTable("t_db.a")
    spark.range(1).createOrReplaceTempView("t_view")
    found = readers.hive_tables(spark, "t_db")
    assert set(found) == {"a"} and found["a"].count() == 3
    spark.catalog.dropTempView("t_view")
    spark.sql("DROP TABLE t_db.a")


def test_dynamic_partitions_and_landing(spark, tmp_path):
    path = f"file://{tmp_path}/dyn"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
    sinks.parquet_dynamic(df, path, ["p"])
    sinks.parquet_dynamic(df.filter("p = 'b'").withColumn("x", F.lit(9)), path, ["p"])
    assert {(r.x, r.p) for r in spark.read.parquet(path).collect()} == {(1, "a"), (9, "b")}
    rows = routing.parse_routing_key(synth.messages(spark, SF).withColumn("topic", F.lit("T")), "2024-06-01")
    sinks.landing_zone(rows, f"file://{tmp_path}/zone")
    assert spark.read.parquet(f"file://{tmp_path}/zone").count() == rows.count()


def test_stream_is_batch(spark, tmp_path):
    records = synth.messages(spark, SF).select("key", F.col("raw").alias("value"), F.lit("T").alias("topic"))
    records.repartition(3).write.parquet(f"file://{tmp_path}/in")
    stream = readers.message_stream(spark, "parquet", readers.rate_limit("parquet", 1), "key string, value string, topic string", f"file://{tmp_path}/in")
    jobs.run_until_done(jobs.parsed_stream(stream), f"file://{tmp_path}/out", f"file://{tmp_path}/cp").awaitTermination()
    batch = jobs.parsed_stream(records)
    got = spark.read.parquet(f"file://{tmp_path}/out").select(*batch.columns)
    assert got.count() == batch.count() and got.exceptAll(batch).isEmpty()


def test_volume_stream(spark, tmp_path):
    events = synth.table(spark, SF, "events")
    events.repartition(2).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"file://{tmp_path}/in")
    jobs.run_until_done(jobs.volume_stream(stream, "1 hour", "40 days", topic="event_type"), f"file://{tmp_path}/out", f"file://{tmp_path}/cp").awaitTermination()
    got = spark.read.schema("start timestamp, topic string, n long").parquet(f"file://{tmp_path}/out")
    assert got.exceptAll(audit.batch_volume(events, "1 hour", topic="event_type")).isEmpty()


def test_upsert_stream(spark, tmp_path):
    src = f"file://{tmp_path}/in"
    schema = "k string, a string, ts long"
    kept = store.create(spark, f"file://{tmp_path}/store", spark.createDataFrame([("z", "0", 0)], schema), ["k"], ["a"], "ts")
    for rows in ([("x", "1", 1), ("y", "2", 1)], [("x", " ", 2), ("y", "3", 2)], [("y", "old", 0)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        sinks.upsert_stream(stream, kept, f"file://{tmp_path}/cp", ["k"]).awaitTermination()
    assert {(r.row_key, r.a) for r in kept.rows().collect()} == {("x", "1"), ("y", "3"), ("z", "0")}
    store.drop(kept)


def test_observations_and_payload(spark):
    df = spark.createDataFrame([(1, "a^b", "7")], "msg_id int, x string, y string")
    rows = enrich.explode_observations(df, ["x", "y"]).orderBy("idx").collect()
    assert [(r.x, r.y) for r in rows] == [("a", "7"), ("b", "")]
    with pytest.raises(ValueError):
        enrich.payload(df, ["x"], "XML", F.current_timestamp())


def test_scrub_and_join_guards_empty_ssn(spark):
    df = spark.createDataFrame([(["a", "b"], ""), (["a1", "b"], "1")], "s array<string>, ssn string")
    assert [r.x for r in df.select(feeds.scrub_and_join(F.col("s"), F.col("ssn")).alias("x")).collect()] == ["a\rb", "a\rb"]


def test_unknown_names(spark):
    told = naming.with_source(raw(spark, "MSH|^~\\&|A|F|C|D|t||ADT^A01|EPIC_1|P|2.3\nZZZ|q"), spark.createDataFrame([("EPIC", "2.3", "E")], "src string, ver string, tpl string"))
    named = naming.name_elements(parse.elements(told, keep=naming.SOURCE), spark.createDataFrame([("STD", "MSH.4.1", ["fac"])], "tpl string, elem_key string, names array<string>"))
    assert "ZZZ.1.1" in naming.unknown_mapping(named).first().missing_keys
    assert {r.name for r in named.filter("seg = 'MSH' and field = 4").collect()} == {"fac"}


def test_jdbc_round_trip(spark, tmp_path):
    # one JVM holds both the database and the tasks here
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rows = synth.table(spark, SF, "customer").select("c_custkey", "c_acctbal")
    for part in (rows.filter("c_custkey % 2 = 0"), rows.filter("c_custkey % 2 = 1")):  # the second load is added to the first
        sinks.jdbc_batch(part, url, "customers", 10, driver="org.apache.derby.jdbc.EmbeddedDriver")
    got = readers.jdbc_query(spark, url, 'SELECT "c_custkey", "c_acctbal" FROM customers', driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert got.count() == rows.count() and got.exceptAll(rows).isEmpty()


def test_rejects_are_checked_field_by_field(spark, tmp_path):
    fields = [f["name"] for f in json.loads(audit.reject_schema())["fields"]]
    good = spark.createDataFrame([tuple("x" * 8) + (None,)], ", ".join(f"{n} string" for n in fields))
    sinks.avro_rejects(good, f"file://{tmp_path}/r")
    assert spark.read.format("avro_files").load(f"file://{tmp_path}/r").first()[fields[-1]] == ""
    for bad in (good.drop(fields[0]), good.withColumn(fields[2], F.lit(1)), good.select(*reversed(fields))):
        with pytest.raises(ValueError):
            sinks.avro_rejects(bad, f"file://{tmp_path}/bad")


def test_replace_staging(spark, tmp_path):
    target, export = f"file://{tmp_path}/target", f"file://{tmp_path}/export"
    spark.createDataFrame([("old", "x")], "a string, b string").write.parquet(target)
    spark.createDataFrame([("1|",), ("2|y",), ("",)], "value string").write.text(export)
    sinks.replace_staging(spark, export, target, ["a", "b"])
    assert sorted((r.a, r.b) for r in spark.read.parquet(target).collect()) == [("", ""), ("1", ""), ("2", "y")]


@pytest.mark.parametrize("own", ["#*~\\&", "|^;\\:", "(*+\\?", "\\^~/&"])
def test_own_delimiters_from_text_to_elements(spark, own):
    usual = "MSH|^~\\&|S|F^G|C|D|2024||ADT^A01|EPIC_1|P|2.3\nPID|1||M1^^^^MRN~U2^^^^SS|U^x|a&b|F^G&H~I|J&K||p~q|||\nOBX|1|TX|||a~b^c&d\nGT1|1|2|3|4|5|6|7|8|9|10|11|secret|13"
    to = str.maketrans("|^~\\&", own)
    both = spark.createDataFrame([(0, usual, "k"), (1, usual.translate(to), "k"), (2, usual, "k")], "msg_id long, raw string, key string")
    rows = {n: {(r.seg, r.field, r.rep, r.comp, r.sub): r.value for r in parse.elements(both).filter(f"msg_id = {n}").collect()} for n in range(3)}
    assert rows[0] == rows[2] and rows[0]["PID", 6, 1, 2, 2] == "H" and rows[0]["PID", 3, 2, 1, 1] == "U2" and rows[0]["PID", 5, 1, 1, 1] == "a&b"
    # what is not cut keeps its characters, so the texts are the translated ones
    assert rows[1] == {k: v if v is None else v.translate(to) for k, v in rows[0].items()}
    for facts in (parse.meta_fast(both), parse.reject_malformed(both), naming.header_ids(both), parse.type_from_body(both, spark.createDataFrame([("ADT",)], "type string"))):
        a, b = ([v for c, v in sorted(r.asDict().items()) if c not in ("msg_id", "raw")] for r in facts.orderBy("msg_id").collect()[:2])
        assert a == b
    assert {(r.mrn, r.control_id, r.trigger) for r in parse.meta_fast(both).collect()} == {("M1", "EPIC_1", "A01")}
    supported = spark.createDataFrame([("EPIC", "2.3", "E")], "src string, ver string, tpl string")
    assert len({(r.src, r.ver, r.fac, r.tpl) for r in naming.source_system(both, supported).collect()}) == 1
    assert feeds.event_type_in(both, ["A01"]).count() == 3
    segs = feeds.remove_field(parse.lines(F.col("raw")), "GT1", 12, parse.separators(F.col("raw")))
    assert all("secret" not in "".join(r.x) for r in both.select(segs.alias("x")).collect())


def test_fields_and_filled_parts_alone_are_the_elements_that_a_filter_leaves(spark):
    text = "MSH|^~\\&|A||B\r\nPID|1||x^^y~z^&w||n^\r\nOBX|1|NM|p^q||5|u"
    rows = spark.createDataFrame([(1, text), (2, text.translate(str.maketrans("|^~&", "$*!@")))], "msg_id long, raw string")
    every = parse.elements(rows)
    asked = {"PID": (3, 5), "OBX": (4, 5)}
    some = every.filter("(seg = 'PID' and field in (3, 5)) or (seg = 'OBX' and field in (4, 5))")
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(parse.elements(rows, filled=True), every.filter("value is not null"))
    assert same(parse.elements(rows, fields=asked), some)
    assert same(parse.elements(rows, fields=asked, filled=True), some.filter("value is not null"))


def test_few_groups_of_texts_are_not_sorted(spark):
    from clinflow.queries.parsing import _summary

    plan = _summary(spark.range(9).selectExpr("id % 3 AS k", "cast(id as string) AS value"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan


def test_json_of_any_text(spark):
    """Plain texts are quoted as they are; others, lists and nulls as a JSON writer writes them."""
    texts = ["plain", "", " a/b ", 'q"', "b\\", "tab\t", "\x01", "\x7f", "é\u2028", "😀", None, "line\nend"]
    rows = [(i, 1, "OBX", 5, 1, 1, 1, "v", t) for i, t in enumerate(texts)] + [(99, 1, "OBX", 5, r, 1, 1, "v", t) for r, t in enumerate(texts)]
    named = spark.createDataFrame(rows, "msg_id long, seg_seq int, seg string, field int, rep int, comp int, sub int, name string, value string")
    found = naming.to_json(named)
    got = {r.msg_id: json.loads(r.json)["OBX"]["v"] for r in found.collect()}
    assert got == {**dict(enumerate(texts)), 99: texts}
    assert "RLIKE" in found._jdf.queryExecution().optimizedPlan().toString()


def test_common_elements_are_lookups_of_each_target(spark):
    raw_rows = raw(spark, "MSH|^~\\&|A|F|C|D|t1||ADT^A01|c1|P|2.3\nPID|1||x^^^^SS~m^^^^MRN~n^^^^MRN|u|n\nPID|2||k^^^^MRN||n|" + "|" * 12 + "a^b")
    rules = spark.createDataFrame([("id", 1, "PID", 3, 1, 5, "MRN"), ("urn", 1, "PID", 4, 1, None, None), ("acct", 1, "PID", 18, 2, None, None), ("acct", 2, "PID", 18, 1, None, None), ("time", 1, "MSH", 7, 1, None, None), ("none", 1, "PID", 40, 1, None, None)], "target string, rule int, seg string, field int, want_comp int, code_comp int, code string")
    elements = parse.elements(raw_rows)
    row = naming.common_elements(elements, rules, ["id", "urn", "acct", "time", "none"]).collect()
    assert [r.asDict() for r in row] == [{"msg_id": row[0].msg_id, "id": "m", "urn": "u", "acct": "b", "time": "t1", "none": None}]
    assert {r.target: r.value for r in naming.path_lookup(elements, rules).collect()} == {"id": "m", "urn": "u", "acct": "b", "time": "t1"}
