"""Enrichment by lookups, and extracts end to end."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.functions import filters as flt
from clinflow.operators.config import config, config_hint
from clinflow.operators.routing import keyed_upsert
from clinflow.operators.segments import etl_timestamp, join_repeats


def blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)), F.lit("")) == ""


def facility(df: DataFrame, reference: DataFrame) -> DataFrame:
    """coid, network and description by (facility, location); without the location, the facility's first entry. ``reference`` (pos, facility, location, coid, network, description) is a reference table of some thousand rows."""
    value = F.struct("coid", "network", "description")
    small = config_hint(reference)
    exact = small(reference.groupBy("facility", "location").agg(F.min_by(value, "pos").alias("exact")))
    first = small(reference.groupBy("facility").agg(F.min_by(value, "pos").alias("first")))
    rows = df.join(exact, ["facility", "location"], "left").join(first, "facility", "left").withColumn("found", F.coalesce("exact", "first"))
    return rows.select(*df.columns, "found.coid", "found.network", "found.description")


def facility_crossref(df: DataFrame, crossref: DataFrame) -> DataFrame:
    """A cross-reference of (facility, location) replaces facility, coid and network."""
    side = config(crossref.select("facility", "location", "new_coid", "new_facility", "new_network"))
    rows = df.join(side, ["facility", "location"], "left")
    hit = F.col("new_facility").isNotNull()
    new = {"facility": "new_facility", "coid": "new_coid", "network": "new_network"}
    return rows.withColumns({k: F.when(hit, F.col(v)).otherwise(F.col(k)) for k, v in new.items()}).drop(*new.values())


def patient_fill(df: DataFrame, store: DataFrame, key: str, mapping: dict[str, str]) -> DataFrame:
    """Blank fields from the store; rows without a blank field are not looked up (their key is NULL)."""
    some = reduce(or_, [blank(c) for c in mapping])
    side = store.select(F.col("row_key").alias("_key"), *[F.col(a).alias(f"_{a}") for a in set(mapping.values())])
    rows = df.withColumn("_key", F.when(some, F.col(key).cast("string"))).join(side, "_key", "left")
    fill = {c: F.when(blank(c) & ~blank(f"_{a}"), F.col(f"_{a}")).otherwise(F.col(c)) for c, a in mapping.items()}
    return rows.withColumns(fill).select(*df.columns)


def patient_cache(rows: DataFrame, keys: list[str], attrs: list[str], ts: str) -> DataFrame:
    return keyed_upsert(rows, keys, attrs, ts)


def explode_observations(df: DataFrame, fields: list[str]) -> DataFrame:
    """Parallel ``^`` lists to a row for each place, short lists padded with ''."""
    lists = F.arrays_zip(*[F.split(F.coalesce(c, F.lit("")), r"\^", -1).alias(c) for c in fields])
    rows = df.select(*[c for c in df.columns if c not in fields], F.posexplode(lists).alias("idx", "z"))
    return rows.select(*[c for c in rows.columns if c != "z"], *[F.coalesce(F.col("z")[c], F.lit("")).alias(c) for c in fields])


def reject_bad_observation(df: DataFrame, int_fields: list[str]) -> tuple[DataFrame, DataFrame]:
    bad = F.filter(F.array(*[F.when(F.col(c).try_cast("int").isNull(), F.lit(c)) for c in int_fields]), lambda x: x.isNotNull())
    rows = df.withColumn("_bad", bad)
    good = rows.filter("size(_bad) = 0").drop("_bad")
    return good, rows.filter("size(_bad) > 0").withColumn("reject_reason", F.concat(F.lit("PARTIAL_REJECT: not an integer: "), F.array_join("_bad", ","))).drop("_bad")


def extract_project(named: DataFrame, names: list[str]) -> DataFrame:
    """A row for each message with the values of each name over all its segments, joined by ^."""
    rows = named.filter(F.col("name").isin(names))
    ordered = lambda n: F.array_sort(F.collect_list(F.when(F.col("name") == n, F.struct("seg_seq", "field", "rep", "comp", "sub", F.coalesce("value", F.lit("")).alias("value")))))
    return rows.groupBy("msg_id").agg(*[join_repeats(F.transform(ordered(n), lambda x: x["value"])).alias(n) for n in names])


def _payloads(cols: list[str | Column], fmt: str, as_of: Column, raw: str) -> Column:
    """The payloads of a row, one or two, in one of four formats; the first two end with the load time."""
    stamp = etl_timestamp(as_of)
    json = F.to_json(F.struct(*cols, stamp.alias("etl_firstinsert_datetime")), {"ignoreNullFields": "false"})
    if fmt == "JSON":
        return F.array(json)
    if fmt == "DELIMITED":
        return F.array(F.array_join(F.array(*[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols], stamp), "|", ""))
    if fmt == "RAWDATA":
        return F.array(F.col(raw))
    if fmt == "RAWDATA_JSON":
        return F.array(F.col(raw), json)
    raise ValueError(f"unknown format {fmt}")


def payload(df: DataFrame, cols: list[str], fmt: str, as_of: Column, raw: str = "raw") -> DataFrame:
    """(msg_id, payload)."""
    return df.select("msg_id", F.explode(_payloads(cols, fmt, as_of, raw)).alias("payload"))


SYSTEMS = {"JSON": "KAFKA", "DELIMITED": "KAFKA", "RAWDATA": "WSMQ", "RAWDATA_JSON": "HBASE"}


def route(df: DataFrame, system: str, destination: str) -> DataFrame:
    return df.withColumns({"dest_system": F.lit(system), "dest_route": F.lit(destination)})


def extract_rows(named: DataFrame, filters: list[flt.Filter], names: list[str]) -> DataFrame:
    """(msg_id, passed, the names' values over all segments joined by ^): filters and projection of a message from one grouping."""
    at = ["seg_seq", "field", "rep", "comp", "sub"]
    aggs = [F.array_sort(F.collect_list(F.when(F.col("name") == n, F.struct(*at, F.coalesce("value", F.lit("")).alias("value"))))).alias(f"p{k}") for k, n in enumerate(names)]
    wanted = sorted({(f.segment, f.path) for f in filters})
    tested = lambda s, p: (F.col("seg") == s) & (F.col("name") == p) & F.col("value").isNotNull()
    aggs += [F.array_sort(F.collect_list(F.when(tested(s, p), F.struct("seg_seq", F.struct("rep", "comp", "sub").alias("at"), "value")))).alias(f"v{k}") for k, (s, p) in enumerate(wanted)]
    rows = named.groupBy("msg_id").agg(*aggs)
    passed = _passed(filters, {at: F.col(f"v{k}") for k, at in enumerate(wanted)})
    return rows.select("msg_id", passed.alias("passed"), *[join_repeats(F.transform(f"p{k}", lambda x: x["value"])).alias(n) for k, n in enumerate(names)])


def _passed(filters: list[flt.Filter], values: dict[tuple[str, str], Column]) -> Column:
    """``values``: by segment and name, the values in order as (seg_seq, at, value)."""

    def found(f: flt.Filter) -> Column:
        """Of each segment the last repetition counts; any segment that fits is enough."""
        of = values[f.segment, f.path]
        last = F.filter(of, lambda x, i: F.coalesce(F.get(of, i + 1)["seg_seq"] != x["seg_seq"], F.lit(True)))
        return F.exists(last, lambda x: flt.condition(f, x["value"]))

    return flt.expression(filters, [found(f) for f in filters])


def extract_payloads(values: Column, spec_filters: list[flt.Filter], names: list[str], fmt: str, destination: str, as_of: Column) -> Column:
    """array<(route, payload)> of a message's named values, a list in order of (seg_seq, seg, name, field, rep, comp, sub, value): what
    ``extract`` makes of rows."""
    of = lambda seg, name: F.filter(values, lambda x: (x["seg"] == seg) & (x["name"] == name))
    tested = {at: F.sort_array(F.transform(of(*at), lambda x: F.struct(x["seg_seq"], F.struct(x["rep"], x["comp"], x["sub"]).alias("at"), x["value"]))) for at in {(f.segment, f.path) for f in spec_filters}}
    joined = lambda n: join_repeats(F.transform(F.filter(values, lambda x: x["name"] == n), lambda x: x["value"]))
    cols = [joined(n).alias(n) for n in names]
    sent = F.transform(_payloads(cols, fmt, as_of, "raw"), lambda p: F.struct(F.lit(destination).alias("route"), p.alias("payload")))
    kept = F.array(F.struct(F.lit("FILTERED").alias("route"), F.lit("").alias("payload")))
    return F.when(_passed(spec_filters, tested), sent).otherwise(kept)


def extract(named: DataFrame, spec_filters: list[flt.Filter], names: list[str], fmt: str, system: str, destination: str, as_of: Column, raw: str = "raw") -> DataFrame:
    """One extract: (msg_id, payload, dest_system, dest_route) of the messages that pass, and state FILTERED of the others."""
    rows = extract_rows(named, spec_filters, names)
    out = F.when(F.col("passed"), _payloads(names, fmt, as_of, raw)).otherwise(F.array(F.lit(None).cast("string")))
    rows = rows.select("msg_id", "passed", F.explode(out).alias("payload"))
    kept = lambda v, name: F.when(F.col("passed"), F.lit(v)).alias(name)
    return rows.select("msg_id", "payload", kept(system, "dest_system"), kept(destination, "dest_route"), F.when(~F.col("passed"), "FILTERED").alias("state"))
