"""The main job on a stream gives what it gives on the whole table."""

import json
from dataclasses import replace

from pyspark.sql import functions as F

from clinflow.plans.main_job import OUTPUTS, main_job
from clinflow.queries.files import main_config
from clinflow.sources.synth import messages
from clinflow.streaming import jobs

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_path):
    base, as_of = f"file://{tmp_path}", F.lit("2024-06-01 12:34:56.789").cast("timestamp")
    raw = messages(spark, SF).filter("msg_id < 400")
    odd = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "no header"), (10**6 + 3, "MSH|^~\\&|A|F|C|D|2024||ADT^A04|EPIC_1|P|2.3\r\nMSH|^~\\&|A"), (10**6 + 4, "MSH|^~\\&|A|F|C|D|2024||ORU^R01|IP_9|P|2.5\nPID|1||\nOBX|1|NM|a^b||~|F")]
    raw = raw.unionByName(spark.createDataFrame([(i, "S", "Q:RAW:x:y", t, None) for i, t in odd], "msg_id long, source string, key string, raw string, ingest_ts timestamp"))
    raw.repartition(3).write.parquet(f"{base}/in")
    stored = spark.read.schema(raw.schema).parquet(f"{base}/in")
    batch = main_job(stored, main_config(spark), f"{base}/staging", as_of)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    jobs.main_stream(stream, main_config(spark), f"{base}/out", f"{base}/checkpoint", as_of).awaitTermination()
    assert set(batch) == set(OUTPUTS)
    for name, rows in batch.items():
        got = spark.read.parquet(f"{base}/out/{name}").select("msg_id", "key", "value")
        if name == "metric":  # counts of batches add up
            got = got.groupBy("msg_id", "key").agg(F.sum(F.col("value").cast("long")).cast("string").alias("value"))
        assert got.exceptAll(rows).isEmpty() and rows.exceptAll(got).isEmpty(), name
    told = {r.msg_id: r.value.split("|")[7] for r in batch["reject"].filter("msg_id >= 1000000").collect()}
    assert told == {10**6: "empty message", 10**6 + 1: "empty message", 10**6 + 2: "message does not start with MSH", 10**6 + 3: "more than one MSH segment"}
    assert '"id_number"' not in batch["json"].filter("msg_id = 1000004").first().value  # no patient id, and no failure


#: Lines as the crosswalk of templates has them: what a field's components become.
CROSSWALK = [
    "EPIC_2.3_OBR.32.1,2.3,,OBR.32.1,principal_result_interpreter,person_id,,OBR.32.1.1,principal_result_interpreter,name,id_num,move",
    "EPIC_2.3_OBR.32.2,2.3,,OBR.32.2,principal_result_interpreter,last_name,,OBR.32.1.2,principal_result_interpreter,name,family_name,move",
    "EPIC_2.3_OBR.32.3,2.3,,OBR.32.3,principal_result_interpreter,first_name,,OBR.32.1.3,principal_result_interpreter,name,given_name,move",
    "EPIC_2.3_OBR.32.4,2.3,,OBR.32.4,principal_result_interpreter,middle_name,,OBR.32.1.4,principal_result_interpreter,name,second_and_further_given_names,move",
    "EPIC_2.3_PID.5.1,2.3,,PID.5.1,patient_name,last,,PID.5.1,patient_name,,,merge",
    "EPIC_2.3_PID.5.2,2.3,,PID.5.2,patient_name,first,,PID.5.1,patient_name,,,merge",
]


def test_realigned_overridden_and_oversize(spark, tmp_path):
    head = "MSH|^~\\&|A|{fac}|C|D|202406011200||ORU^R01|{ctrl}|P|2.3"
    body = "PID|1||M1^^^F^MRN|U1|Do^e&x" + "|" * 13 + "U1\nOBR|1" + "|" * 31 + "77^Roe&de^Ann^B~88^Poe|\nOBX|1|NM|a^b||{v}|F"
    texts = {1: head.format(fac="F01", ctrl="EPIC_1") + "\n" + body.format(v="7"), 2: head.format(fac="F01", ctrl="MT_1") + "\n" + body.format(v="7"), 3: head.format(fac="", ctrl="EPIC_3") + "\n" + body.format(v="7"), 4: head.format(fac="F01", ctrl="EPIC_4") + "\n" + body.format(v="8" * 5000)}
    raw = spark.createDataFrame([(i, "S", "Q:RAW:x:y", t, None) for i, t in texts.items()], "msg_id long, source string, key string, raw string, ingest_ts timestamp")
    plain = main_config(spark)
    more = plain.templates.unionByName(spark.createDataFrame([("STD", "PID.5.1", ["patient_name"]), ("STD", "OBR.32.1", ["interpreter"])], plain.templates.schema))
    config = replace(plain, templates=more, crosswalk=spark.createDataFrame([(x,) for x in CROSSWALK], "value string"), override="^EPIC_", limit=4000)
    got = main_job(raw, config, f"file://{tmp_path}/staging", F.lit("2024-06-01 12:34:56.789").cast("timestamp"))
    json_of = {r.msg_id: json.loads(r.value) for r in got["json"].collect()}
    assert set(json_of) == {1, 2} and [r.msg_id for r in got["oversize"].collect()] == [4]
    # moved parts have the crosswalk's names, sub-components that were there stand in their row; another source's message stays as it was
    assert json_of[1]["OBR"] == {"id_num": ["77", "88"], "family_name": ["Roe", "Poe"], "given_name": "de", "second_and_further_given_names": "Ann"}
    assert json_of[2]["OBR"] == {"interpreter": ["77", "88"]}
    assert json_of[1]["PID"]["patient_name"] == "Doe&x" and json_of[2]["PID"]["patient_name"] == "Do"
    assert {r.msg_id: r.value.split("|")[7] for r in got["reject"].collect()} == {3: "blank sending_facility"}
    account = {r.msg_id: r.value.split("|")[5] for r in got["audit"].collect()}
    assert account[1] == "no message control ID" and account[2] == "U1"  # the account that only repeats the record number
