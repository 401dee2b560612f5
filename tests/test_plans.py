"""What plans have to be like: tasks for all cores, methods that the JVM compiles, no shuffle of elements."""

import re

import pytest
from pyspark.sql import functions as F

from clinflow.operators import naming, parse, segments
from clinflow.plans.parse_job import parse_job
from clinflow.queries.base import local
from clinflow.queries.extracts import MODELS
from clinflow.queries.parsing import SUPPORTED, TEMPLATES
from clinflow.queries.reports import aud_meta
from clinflow.sources.synth import messages

SF = "/root/testdata/sf0.01"
#: Methods of more bytes are never compiled.
COMPILED = 8_000


def tables(spark):
    return local(spark, TEMPLATES, "tpl string, elem_key string, names array<string>"), local(spark, SUPPORTED, "src string, ver string, tpl string")


def plans(spark, raw):
    templates, supported = tables(spark)
    named = naming.name_elements(parse.elements(naming.with_source(raw, supported), keep=naming.SOURCE), templates)
    return {
        "elements": parse.elements(raw).groupBy("msg_id").count(),
        "names": named.groupBy("msg_id", "name").count(),
        "json": naming.to_json(named.filter("name <> 'unknown' and value is not null")),
        "fan out": segments.fan_out(parse.elements(raw), local(spark, MODELS, "type string, seg string, pos int, path string")),
        "parse job": parse_job(raw, templates, supported),
    }


@pytest.mark.parametrize("name", ["elements", "names", "json", "fan out", "parse job"])
def test_methods_are_compiled_and_elements_stay_where_they_are(spark, tmp_path, name):
    messages(spark, SF).filter("msg_id < 500").write.parquet(f"file://{tmp_path}/raw")
    raw = spark.read.parquet(f"file://{tmp_path}/raw")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = plans(spark, raw)[name]
        text = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < COMPILED
    # the raw messages are dealt once; config tables are grouped before they are broadcast; nothing else is shuffled
    by_message = [line for line in plan.splitlines() if "Exchange hashpartitioning(msg_id" in line]
    assert len(by_message) == 1 and "REPARTITION_BY_COL" in by_message[0]


def test_every_parse_stage_has_as_many_tasks_as_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    templates, supported = tables(spark)
    raw = messages(spark, "/root/testdata/sf0.1")
    named = naming.name_elements(parse.elements(naming.with_source(raw, supported), ("MSH", "PID"), naming.SOURCE), templates)
    for df in (parse.elements(raw, ("MSH", "PID")), named):
        tasks = df.filter("value is not null").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        rows = [r["count"] for r in tasks]
        assert len(rows) >= cores and max(rows) < 3 * sum(rows) / len(rows)


def test_metadata_takes_each_message_apart_once(spark):
    plan = aud_meta(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode(lines") == 1 and "Join LeftOuter, (msg_id" in plan and plan.count("Join LeftOuter, (msg_id") == 1


def test_texts_without_separators_are_not_cut(spark):
    """A pattern looks only through texts that have the separator."""
    plan = parse.elements(messages(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN Contains(text" in plan
