"""Avro files against the format's own Java library, which Spark brings along."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from clinflow.operators import audit
from clinflow.sources import avro, sinks
from clinflow.sources.synth import table

SF = "/root/testdata/sf0.001"
FIELDS = [f["name"] for f in json.loads(audit.reject_schema())["fields"]]


def by_java(spark, folder):
    """(schema, rows as JSON) of all files in a folder, by the Java library."""
    jvm, rows, schema = spark._jvm, [], None
    for file in sorted(folder.glob("*.avro")):
        reader = jvm.org.apache.avro.file.DataFileReader(jvm.java.io.File(str(file)), jvm.org.apache.avro.generic.GenericDatumReader())
        schema = json.loads(reader.getSchema().toString())
        while reader.hasNext():
            rows.append(json.loads(reader.next().toString()))
        reader.close()
    return schema, rows


@pytest.mark.parametrize("codec", ["deflate", "null"])
def test_rejects_are_read_by_another_reader(spark, tmp_path, codec):
    rows = table(spark, SF, "documents").select(*[F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in FIELDS[:7]], F.col("text").alias(FIELDS[7]), F.lit(None).cast("string").alias(FIELDS[8]))
    sinks.avro_rejects(rows.repartition(3), f"file://{tmp_path}/r", codec)
    sinks.avro_rejects(rows.limit(2), f"file://{tmp_path}/r", codec)  # appended
    schema, found = by_java(spark, tmp_path / "r")
    assert schema == json.loads(audit.reject_schema())
    want = [{**r.asDict(), FIELDS[8]: ""} for r in rows.collect() + rows.limit(2).collect()]
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, found)) == sorted(map(key, want))
    assert not list((tmp_path / "r").glob("_pending*"))
    # in ranges shorter than a block, and of any length, every row comes once
    for size in (1000, 70_000, 1 << 30):
        got = spark.read.format(avro.register(spark)).option("rangeBytes", size).load(f"file://{tmp_path}/r")
        assert sorted(key(r.asDict()) for r in got.collect()) == sorted(map(key, want))


def test_all_types_and_nulls(spark, tmp_path):
    schema = "a string, b long not null, c int, d double, e boolean, f binary"
    rows = [("é漢\n", 0, -1, 1.5, True, b"\x00\xff"), (None, -(2**63), None, None, None, None), ("", 2**63 - 1, 2**31 - 1, -0.0, False, b""), ("x" * 200_000, 64, -65, 1e300, True, b"y")]
    df = spark.createDataFrame(rows, schema)
    df.write.format(avro.register(spark)).mode("append").save(f"file://{tmp_path}/t")
    kind, found = by_java(spark, tmp_path / "t")
    assert kind["fields"][1]["type"] == "long" and kind["fields"][0]["type"] == ["null", "string"]
    assert sorted(r["b"] for r in found) == sorted(r[1] for r in rows) and {r["a"] for r in found} == {r[0] for r in rows}
    got = spark.read.format(avro.NAME).load(f"file://{tmp_path}/t")
    assert sorted(repr((*r[:5], r[5] and bytes(r[5]))) for r in got.collect()) == sorted(map(repr, rows))
    df.limit(1).write.format(avro.NAME).mode("overwrite").save(f"file://{tmp_path}/t")
    assert spark.read.format(avro.NAME).load(f"file://{tmp_path}/t").count() == 1
    df.limit(0).write.format(avro.NAME).mode("overwrite").save(f"file://{tmp_path}/t")
    assert spark.read.format(avro.NAME).schema(df.schema).load(f"file://{tmp_path}/t").count() == 0
    with pytest.raises(ValueError):
        avro.record_schema(spark.createDataFrame([], "a array<int>").schema)


def test_a_failed_load_leaves_nothing(spark, tmp_path):
    df = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("stop"))).otherwise(F.col("id").cast("string")).alias("a"))
    with pytest.raises(Exception, match="stop"):
        df.write.format(avro.register(spark)).mode("append").save(f"file://{tmp_path}/f")
    assert not list(tmp_path.glob("f/**/*.avro"))


def test_numbers_are_those_of_the_format():
    for n, want in ((0, "00"), (-1, "01"), (1, "02"), (-64, "7f"), (64, "8001"), (2**63 - 1, "feffffffffffffffff01"), (-(2**63), "ffffffffffffffffff01")):
        out = bytearray()
        avro.put_long(out, n)
        assert out.hex() == want and avro.get_long(avro.io.BytesIO(bytes(out))) == n
    with pytest.raises(EOFError):
        avro.get_long(avro.io.BytesIO(b"\x80"))
    assert struct.calcsize("<d") == 8
