"""Synthetic messages made from the given tables: one message for each order, one observation for each of its lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TYPES = ("ADT^A04", "ORU^R01", "MDM^T02", "ORM^O01")
PREFIXES = ("MT6_", "MT_", "EPIC_", "ECW_", "NG_", "IP_")
#: The usual separators, and those of every fifth message.
OWN = ("|^~&", "$*!@")
VERSIONS = ("2.4", "2.5", "2.3", "2.3.1", "2.3", "2.5")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], by: str):
    return F.element_at(F.array(*map(F.lit, values)), (F.col(by) % len(values)).cast("int") + 1)


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each order with the parts that its message is made of."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    # one file of orders would be one task, whose join Spark makes by broadcast; dealt after it by the key that observations join on, and that
    # messages are taken apart by, it costs no shuffle more: not this join by another key, nor that of the observations
    rows = rows.select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_custkey", "c_name", "c_nationkey").repartition("o_orderkey")
    digits = lambda n: F.lpad((F.col("o_custkey") % 10**n).cast("string"), n, "0")
    fac = F.concat(F.lit("F"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"))
    rows = rows.select(
        F.col("o_orderkey").alias("msg_id"),
        fac.alias("fac"),
        F.date_format("o_orderdate", "yyyyMMddHHmm").alias("t7"),
        _pick(TYPES, "o_orderkey").alias("type9"),
        _pick(PREFIXES, "o_orderkey").alias("prefix"),
        _pick(VERSIONS, "o_orderkey").alias("ver"),
        F.concat(F.lit("M"), "o_custkey").alias("mrn"),
        F.concat_ws("-", digits(3), digits(2), digits(4)).alias("ssn"),
        F.concat(F.lit("U"), "o_custkey").alias("urn"),
        F.replace("c_name", F.lit("#"), F.lit("^")).alias("name"),
        F.concat(F.lit("A"), "o_orderkey").alias("acct"),
        F.when(F.col("o_orderstatus") == "F", "I").when(F.col("o_orderstatus") == "O", "E").otherwise("").alias("cls"),
        F.col("o_orderpriority").alias("prio"),
    )
    ctrl = F.concat("prefix", "fac", F.lit("_"), F.substring("type9", 1, 3), F.lit("_"), "msg_id")
    return rows.withColumn("ctrl", F.when(F.col("msg_id") % 101 == 0, "").otherwise(ctrl))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(msg_id, obx): the OBX segments of an order, in order."""
    line = table(spark, sf_dir, "lineitem")
    keys = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"]
    rows = line.groupBy(F.col("l_orderkey").alias("msg_id")).agg(F.array_sort(F.collect_list(F.struct(*keys))).alias("lines"))

    def obx(x, i):
        quantity = x["l_quantity"].cast("decimal(12,2)").cast("string")
        head = F.concat_ws("|", F.lit("OBX"), (i + 1).cast("string"), F.lit("NM"), F.concat(x["l_partkey"], F.lit("^"), x["l_returnflag"]), F.lit(""), quantity, x["l_linestatus"])
        return F.concat(head, F.lit("|" * 8), F.date_format(x["l_shipdate"], "yyyyMMdd"))

    return rows.select("msg_id", F.transform("lines", obx).alias("obx"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_messages: msg_id, source, key, raw, ingest_ts."""
    h = headers(spark, sf_dir).join(observations(spark, sf_dir), "msg_id", "left")
    msh = F.concat_ws("|", F.lit("MSH"), F.lit("^~\\&"), F.lit("CLIN"), "fac", F.lit("RCV"), F.lit("HUB"), "t7", F.lit(""), "type9", "ctrl", F.lit("P"), "ver")
    ids = F.concat("mrn", F.lit("^^^"), "fac", F.lit("^MRN~"), "ssn", F.lit("^^^^SS"))
    pid = F.concat(F.concat_ws("|", F.lit("PID"), F.lit("1"), F.lit(""), ids, "urn", "name"), F.lit("|" * 13), "acct")
    pv1, obr = F.concat(F.lit("PV1|1|"), "cls"), F.concat(F.lit("OBR|1|||"), "prio", F.lit("^text"))
    lines = F.concat(F.array(msh, pid, pv1, obr), F.coalesce("obx", F.array().cast("array<string>")))
    key = F.concat_ws(":", F.substring("type9", 1, 3), F.lit("RAW"), "t7", "fac")
    ts = F.to_timestamp("t7", "yyyyMMddHHmm")
    usual = F.array_join(lines, "\r\n")
    raw = F.when(F.col("msg_id") % 5 == 0, F.translate(usual, *OWN)).otherwise(usual)  # every fifth message has separators of its own
    # a generator of one row, so that the text is made once: no filter or field of a reader is made from its parts anew
    return h.select("msg_id", F.concat(F.lit("Q."), F.substring("type9", 1, 3)).alias("source"), key.alias("key"), F.explode(F.array(raw)).alias("raw"), ts.alias("ingest_ts"))
