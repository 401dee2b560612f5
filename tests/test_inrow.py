"""What is made of a message in its row is what its rows of elements give; the main job's outputs need no shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from clinflow.functions.filters import Filter
from clinflow.operators import enrich, inrow, naming, parse, segments
from clinflow.plans.main_job import main_job, parsed
from clinflow.queries.base import local
from clinflow.queries.files import main_config
from clinflow.sources.synth import messages

SF = "/root/testdata/sf0.001"
SETS = ["|^~&", "$*!@", "^|~&", "|^~|"]
SEGS = ["OBX", "PID", "PV1", "ZZZ", "OB", "MSH", "OBXq", "A.1"]
MODELS = [("A", "OBX", 0, "3|2"), ("A", "OBX", 1, "2"), ("B", "OBX", 1, "2|1"), ("A", "OBX", 9, "5|2"), ("A", "OBX", 9, "5|1"), ("A", "PID", 0, "1|1"), ("A", "PID", 0, "1|2|1"), ("A", "PID", 1, "3"), ("A", "PV1", 3, "01|2"), ("A", "PV1", 4, "0"), ("A", "PV1", 5, "2"), ("A", "MSH", 1, "1"), ("A", "MSH", 2, "2"), ("B", "ZZZ", 1, "1|1"), ("B", "ZZZ", 2, "1|7"), ("B", "PID", 1, "1|1"), ("B", "PID", 1, "1|1")]
AS_OF = "2024-06-01 12:34:56.789"


def message(r, i):
    seps = SETS[i % len(SETS)]
    rows = ["MSH" + seps[:3] + "\\" + seps[3] + seps[0] + "".join(r.choice("ab" + seps) for _ in range(r.randrange(12)))]
    for _ in range(r.randrange(6)):
        rows.append(r.choice(SEGS) + seps[0] + "".join(r.choice('ab "é' + seps + seps[0] * 2 + "|^") for _ in range(r.randrange(40))))
    return i, r.choice("AB"), r.choice(["S", "T", None]), r.choice(["F1", "F2", None]), r.choice(["T1", "T2", None]), r.choice(["\n", "\r\n"]).join(rows)


@pytest.fixture(scope="module")
def raw(spark):
    r = random.Random(7)
    odd = [(1000 + i, "A", "S", "F1", "T1", t) for i, t in enumerate(["", "MSH", "MSH|^~\\&", "MSH||||", "OBX|1|2|3^4", "MSH|^~\\&|x\nOBX|1|2|\tq^\\"])]
    return spark.createDataFrame([message(r, i) for i in range(500)] + odd, "msg_id long, type string, src string, fac string, tpl string, raw string").localCheckpoint()


def same(got, want):
    got, want = (sorted(map(str, df.select(*want.columns).collect())) for df in (got, want))
    assert want and got == want


@pytest.mark.parametrize("realigned", [False, True])
def test_lists_give_what_rows_give(spark, raw, realigned):
    r = random.Random(8)
    levels = ["STD", "STD", "STD", "T1", "T2", "FAC:F1", "FAC:F2", "ALIGN:S", "ALIGN:T", "ALIGN:T1"]
    keys = [f"{s}.{f}.{c}" for s in SEGS for f in range(1, 6) for c in range(1, 4)] + [f"PID.1.2.{k}" for k in (1, 2, 3)] + [f"OBX.2.1.{k}" for k in (1, 2)] + ["PID.01.1", "PID.1", "OBX.x.1"]
    lines = [(t, k, r.choice([["n", ""], ["m", "n"], ["k"], ["p.q"], ["x_1"], ["o", "z"], [""]])) for k in keys for t in set(r.sample(levels, 3)) if r.random() < 0.5]
    templates, models = local(spark, lines, "tpl string, elem_key string, names array<string>"), local(spark, MODELS, "type string, seg string, pos int, path string")
    rules = None
    if realigned:
        rules = local(spark, [("T1", "PID", 1, "move", 2), ("T1", "OBX", 2, "move", 1), ("T2", "OBX", 3, "merge", None), ("T2", "PID", 1, "merge", None), ("T1", "OBX", 5, "move", 2)], "tpl string, seg string, field int, option string, to_comp int")
    rows = naming.name_elements(parse.elements(raw, keep=("type", *naming.SOURCE), realign=rules, filled=True), templates)
    known = rows.filter("name <> 'unknown'").localCheckpoint()
    every = {kind: {n for _, _, x in lines for n in x} for kind in "AB"}
    made = inrow.made(raw.withColumn("own", parse.exchange(F.col("raw"))), inrow.Asked(templates, models, rules, every), ["msg_id"]).localCheckpoint()
    same(made.select("msg_id", "json").filter("json is not null"), naming.to_json(known))
    same(made.select("msg_id", F.inline("rows")).withColumnRenamed("seg", "hl7_segment"), segments.fan_out(rows, models))
    filters, names = [Filter("OBX", "n", "a", "CONTAINS", "OR"), Filter("PID", "k", "b", "NOTEQUAL")], ["n", "k", "z"]
    as_of = F.lit(AS_OF).cast("timestamp")
    for fmt in ("DELIMITED", "JSON"):
        want = enrich.extract(known, filters, names, fmt, "KAFKA", "T.X", as_of).select("msg_id", F.coalesce("dest_route", "state").alias("route"), F.coalesce("payload", F.lit("")).alias("payload"))
        values = made.filter("json is not null")
        same(values.select("msg_id", F.inline(enrich.extract_payloads(F.col("values"), filters, names, fmt, "T.X", as_of))), want)


def test_nothing_but_raw_messages_is_shuffled(spark, tmp_path):
    messages(spark, SF).write.parquet(f"file://{tmp_path}/raw")
    stored, as_of = spark.read.parquet(f"file://{tmp_path}/raw"), F.lit(AS_OF).cast("timestamp")
    of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    plan = of(parsed(stored, main_config(spark), as_of))
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_COL" in plan and "Sort" not in plan
    out = main_job(stored, main_config(spark), f"file://{tmp_path}/staging", as_of)
    assert all("Exchange" not in of(df) for df in out.values())
    assert spark.read.parquet(f"file://{tmp_path}/staging").count() == stored.count()  # a row a message, not an element
