"""Segments whose fields stay in their row give what the elements give, without grouping them again."""

import random

import pytest
from pyspark.sql import functions as F

from clinflow.operators import naming, parse, segments
from clinflow.queries.base import local
from clinflow.queries.extracts import seg_common_columns, seg_view

SF = "/root/testdata/sf0.001"
SETS = ["|^~&", "$*!@", "^|~&", "|^~|"]
MODEL = "type string, seg string, pos int, path string"
MODELS = [("A", "OBX", 0, "3|2"), ("A", "OBX", 1, "2"), ("B", "OBX", 1, "2|1"), ("A", "OBX", 9, "5|2"), ("A", "OBX", 9, "5|1"), ("A", "PID", 0, "1|1"), ("A", "PID", 0, "1|2|1"), ("A", "PID", 1, "3"), ("A", "PV1", 3, "01|2"), ("A", "PV1", 4, "0"), ("A", "PV1", 5, "2"), ("A", "MSH", 1, "1"), ("A", "MSH", 2, "2"), ("A", "MSH", 3, "3|2"), ("A", "ZZZ", None, "1"), ("A", "ZZZ", 2, "2|x"), ("A", "ZZZ", 2, "2|y")]


def message(r, i):
    seps = SETS[i % len(SETS)]
    rows = ["MSH" + seps[:3] + "\\" + seps[3] + seps[0] + "".join(r.choice("ab" + seps) for _ in range(r.randrange(12)))]
    for _ in range(r.randrange(5)):
        seg = r.choice(["OBX", "PID", "PV1", "ZZZ", "OB", "MSH", "OBXq"])
        rows.append(seg + seps[0] + "".join(r.choice("ab " + seps + seps[0] * 2 + "|^") for _ in range(r.randrange(30))))
    return i, r.choice(["\n", "\r\n"]).join(rows)


@pytest.fixture(scope="module")
def raw(spark):
    r = random.Random(5)
    odd = [(1000, None), (1001, ""), (1002, "MSH"), (1003, "MSH|^~\\&"), (1004, "MSH||||"), (1005, "OBX|1|2|3^4")]
    return spark.createDataFrame([message(r, i) for i in range(600)] + odd, "msg_id long, raw string").localCheckpoint()


def same(got, want):
    got, want = (sorted(map(str, df.select(*want.columns).collect())) for df in (got, want))
    assert want and got == want


@pytest.mark.parametrize("typed", [False, True])
def test_fan_out_and_project(spark, raw, typed):
    models, keep = local(spark, MODELS, MODEL), ("type",) if typed else ()
    raw = raw.withColumn("type", F.when(F.col("msg_id") % 2 == 0, "A").otherwise("B")) if typed else raw
    elements, rows = parse.elements(raw, keep=keep), parse.occurrences(raw, keep=keep)
    same(segments.fan_out(rows, models), segments.fan_out(elements, models))
    for seg, paths in (("OBX", ["3", "3|2", "2", "5|2"]), ("PID", ["3", "1|1", "1|2|1", "1"]), ("MSH", ["1", "2", "3|2"]), ("ZZZ", ["1", "2|x", "2"])):
        same(segments.project(rows, models, seg, paths), segments.project(elements, models, seg, paths))


def test_no_element_is_grouped(spark):
    plan = seg_view(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # a message is looked at once; the cuts of elements, and their grouping, are not there
    assert plan.count("Generate posexplode(lines") == 1 and "Generate posexplode(parts" not in plan and plan.count("Generate posexplode(") == 1


RULES = [
    ("a", 2, "PID", 1, 1, None, None), ("a", 1, "PID", 1, 2, 1, "a"), ("b", 1, "OBX", 2, 1, 2, "b"), ("c", 1, "OBX", 5, 2, None, None), ("d", 1, "MSH", 1, 1, None, None), ("d2", 1, "MSH", 2, 1, 1, "^~\\&"),
    ("e", 1, "MSH", 3, 2, None, None), ("e", 2, "PV1", 1, 2, 2, "a"), ("e", 3, "PV1", 2, 1, 1, "b"), ("f", 1, "ZZZ", 1, 3, 2, "a&b"), ("g", 1, "OBX", 1, 1, 9, "x"), ("h", 1, "PID", 0, 1, None, None), ("i", 1, "PID", 2, 0, None, None),
]


def test_common_ids_of_the_text_are_those_of_the_elements(spark, raw):
    targets = [*dict.fromkeys(r[0] for r in RULES), "none"]
    fields = {seg: tuple({r[3] for r in RULES if r[2] == seg}) for seg in {r[2] for r in RULES}}
    table = local(spark, RULES, "target string, rule int, seg string, field int, want_comp int, code_comp int, code string")
    want = naming.common_elements(parse.elements(raw, fields=fields, filled=True), table, targets)
    got = naming.with_common_ids(raw, RULES, targets)
    # messages without an id have no row there
    same(got.filter(F.coalesce(*targets).isNotNull()), want)
    assert got.columns == [*raw.columns, *targets] and got.count() == raw.count()
    found = got.select(*[F.count(t).alias(t) for t in targets]).first().asDict()
    assert all((found[t] > 0) == (t not in ("h", "i", "none")) for t in targets), found
    with pytest.raises(ValueError):
        naming.with_common_ids(raw, [*RULES, RULES[0]], targets)


def test_common_columns_make_each_message_once(spark):
    plan = seg_common_columns(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode(lines") == 1 and plan.count("Generate explode(array(") == 1 and "Join Inner, (msg_id" not in plan


def test_segments_of_messages_without_ids_stay(spark):
    raw = spark.createDataFrame([(1, "MSH|^~\\&\nPV1|1|I"), (2, "PV1|1|E\nPID|1||m")], "msg_id long, raw string")
    rules, targets = [("id", 1, "PID", 3, 1, None, None)], ["id"]
    ids = naming.common_elements(parse.elements(raw, filled=True), local(spark, rules, "target string, rule int, seg string, field int, want_comp int, code_comp int, code string"), targets)
    rows = segments.project(parse.occurrences(naming.with_common_ids(raw, rules, targets), ("PV1",), ("id",)), local(spark, [("A", "PV1", 0, "2")], MODEL), "PV1", ["2"])
    got = segments.common_columns(rows, targets, F.lit(0).cast("timestamp"))
    assert sorted(map(tuple, got.select("msg_id", "field_seq_num", "id", "f_2").collect())) == [(1, "0002", None, "I"), (2, "0001", "m", "E")]
    same(segments.common_columns(rows.drop("id"), ids, F.lit(0).cast("timestamp")), got)
