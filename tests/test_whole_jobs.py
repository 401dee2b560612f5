"""Queries use all of their tables and all of their texts."""

from pyspark.sql import functions as F

from clinflow.catalog import QUERIES
from clinflow.operators import parse
from clinflow.sources.synth import messages

SF = "/root/testdata/sf0.001"


def test_unknown_values_are_of_all_segments(spark):
    got = QUERIES["msg_unknown_values"](spark, SF)
    segments = parse.split_segments(messages(spark, SF)).select("msg_id", "seg_seq", "seg")
    # every segment of these messages has a part without a name
    assert got.count() == segments.count() and got.join(segments, ["msg_id", "seg_seq"]).select("seg").distinct().count() == 5
    head = got.filter("seg_seq = 1 and msg_id = 1").first().unknown
    assert head.startswith("|^^~\\&^CLIN^RCV^HUB^")


def test_a_reject_of_the_main_job_has_its_whole_text(spark):
    got = QUERIES["plan_main_job"](spark, SF).filter("output = 'reject'").select(F.col("message").cast("long").alias("msg_id"), F.split("value", r"\|", 9)[8].alias("text"))
    sent = messages(spark, SF).select("msg_id", F.regexp_replace("raw", "[\r\n]+", "\r").alias("raw"))
    rows = got.join(sent, "msg_id", "left").collect()
    assert rows and all(r.text == r.raw for r in rows) and max(r.text.count("\rOBX") for r in rows) > 1
