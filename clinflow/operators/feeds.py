"""Analytics-result feed (JSON in, delimited out), roster forwarding, warehouse loads and comparison of data sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.operators import parse
from clinflow.operators.config import config
from clinflow.operators.routing import mllp

# --- result feed ------------------------------------------------------------------------------------------------------


def parse_json(df: DataFrame, col: str = "value") -> DataFrame:
    """``m`` (string map) and ``malformed``."""
    m = F.from_json(col, "map<string,string>")
    return df.withColumn("m", m).withColumn("malformed", F.col("m").isNull())


def parse_variant(df: DataFrame, col: str = "value") -> DataFrame:
    """``v`` (VARIANT: any JSON in one stable column) and ``malformed``; a JSON null is a value, not malformed."""
    return df.withColumn("v", F.try_parse_json(F.col(col))).withColumn("malformed", F.col("v").isNull())


def at_paths(df: DataFrame, paths: dict[str, tuple[str, str]], v: str = "v") -> DataFrame:
    """``df`` with a column for each path: name to (path, type); NULL where the document has no such place or another kind of value."""
    return df.withColumns({name: F.try_variant_get(F.col(v), path, kind) for name, (path, kind) in paths.items()})


def required_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    ok = F.forall(F.array(*map(F.lit, fields)), lambda k: F.trim(F.coalesce(F.try_element_at("m", k), F.lit(""))) != "")
    return df.withColumn("ok", F.coalesce(ok, F.lit(False)))


def merge_fields(df: DataFrame, specs: list[tuple[list[str], str, str]]) -> DataFrame:
    """(inputs, target, delimiter): joined into one; an eight-digit date becomes an ISO date-time with offset."""
    for inputs, target, delim in specs:
        joined = F.array_join(F.filter(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in inputs]), lambda x: x != ""), delim)
        date = F.try_to_timestamp(F.when(joined.rlike("^[0-9]{8}$"), joined), F.lit("yyyyMMdd"))
        df = df.withColumn(target, F.coalesce(F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss.SSSxxx"), joined))
    return df


def first_component(df: DataFrame, fields: list[str]) -> DataFrame:
    return df.withColumns({f: F.split_part(f, F.lit("^"), F.lit(1)) for f in fields})


def project_delimited(cols: list[str], delim: str) -> Column:
    return F.array_join(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]), delim)


def landing_split(df: DataFrame) -> DataFrame:
    return df.withColumn("landing_zone", F.when(F.coalesce("ok", F.lit(False)), "valid").otherwise("rejected"))


# --- roster forwarding ------------------------------------------------------------------------------------------------


def segments_with(raw: Column, prefix: str) -> Column:
    return F.filter(parse.lines(raw), lambda s: s.startswith(prefix))


def get_field(segments: Column, n: int, own: Column | None = None) -> Column:
    """The n-th part of the first segment, or ''."""
    return F.coalesce(parse.part(F.get(segments, F.lit(0)), n, own), F.lit(""))


def event_type_in(raw: DataFrame, events: list[str]) -> DataFrame:
    own = parse.separators(F.col("raw"))
    return raw.filter(parse.component(parse.part(F.get(parse.lines(F.col("raw")), F.lit(0)), 8, own), 2, own).isin(events))


def field_in_roster(raw: DataFrame, prefix: str, n: int, roster: DataFrame) -> DataFrame:
    """A semi join; Spark chooses broadcast or shuffle by the roster's size."""
    side = roster.select(F.col("value").alias("_roster")).distinct()
    return raw.withColumn("_roster", get_field(segments_with(F.col("raw"), prefix), n, parse.separators(F.col("raw")))).join(side, "_roster", "left_semi").drop("_roster")


def contains_any(raw: DataFrame, prefix: str, places: list[int], words: list[str]) -> DataFrame:
    segs = segments_with(F.col("raw"), prefix)
    fields = F.array(*[F.upper(get_field(segs, n, parse.separators(F.col("raw")))) for n in places])
    return raw.filter(F.exists(fields, lambda f: F.exists(F.array(*[F.lit(w.upper()) for w in words]), lambda w: F.contains(f, w))))


def remove_field(segments: Column, prefix: str, n: int, own: Column | None = None) -> Column:
    """Blank the n-th part of every segment that starts with ``prefix``."""

    def one(s: Column) -> Column:
        parts = parse.cut(s, "field", own)
        return F.when(s.startswith(prefix), F.call_function("array_join", F.transform(parts, lambda v, i: F.when(i == n, "").otherwise(v)), parse.separator("field", own))).otherwise(s)

    return F.transform(segments, one)


def scrub_and_join(segments: Column, ssn: Column) -> Column:
    whole = F.array_join(segments, "\r")
    return F.when(F.coalesce(ssn, F.lit("")) != "", F.replace(whole, ssn, F.lit(""))).otherwise(whole)


def forward_job(raw: DataFrame, events: list[str], facilities: DataFrame, words: list[str]) -> DataFrame:
    """(msg_id, payload): filtered, cleaned and framed; every message of every partition."""
    rows = event_type_in(raw, events)
    rows = field_in_roster(rows, "MSH", 3, facilities)
    rows = contains_any(rows, "OBR", [4], words)
    own = parse.separators(F.col("raw"))
    segs = remove_field(remove_field(parse.lines(F.col("raw")), "PID", 19, own), "GT1", 12, own)
    ssn = parse.component(F.get(parse.cut(get_field(segments_with(F.col("raw"), "PID"), 3, own), "rep", own), F.lit(1)), 1, own)
    return rows.select("msg_id", mllp(scrub_and_join(segs, ssn)).alias("payload"))


# --- warehouse --------------------------------------------------------------------------------------------------------


def daily_distinct_load(df: DataFrame, trigger: str, time: str, as_of: str) -> DataFrame:
    return df.distinct().withColumns({"message_type": F.substring(trigger, 1, 3), "message_date": F.try_to_date(F.substring(time, 1, 8), "yyyyMMdd"), "insert_time": F.lit(as_of)})


def incremental_staging(df: DataFrame, since: str, offset: str, test_facilities: list[str], required: list[str]) -> DataFrame:
    """Partition column first, so whole partitions are skipped."""
    rows = df.filter((F.col("transaction_date") >= since) & (F.col("etl_insert_date_time") >= offset) & ~F.col("facility").isin(test_facilities))
    for c in required:
        rows = rows.filter(F.trim(F.coalesce(F.col(c), F.lit(""))) != "")
    return rows


def watermark_date(offset: Column) -> Column:
    return F.date_sub(F.try_to_date(F.substring(offset, 1, 8), "yyyyMMdd"), 3)


def control_offset(control: DataFrame, staging: DataFrame) -> DataFrame:
    """(job, offset, status): the newest load time of what was staged; unchanged is DELAYED."""
    newest = staging.groupBy("job").agg(F.max("etl_insert_date_time").alias("newest"))
    rows = control.join(newest, "job", "left")
    moved = F.coalesce(F.col("newest") > F.col("offset"), F.lit(False))
    return rows.select("job", F.when(moved, F.col("newest")).otherwise(F.col("offset")).alias("offset"), F.when(moved, "DONE").otherwise("DELAYED").alias("status"))


def backfill_case(df: DataFrame, codes: str, ids: str, existing: str) -> DataFrame:
    """SSN: of parallel lists the second id where its code is SS, else the list as it is, else what was there."""
    second = F.get(F.split(ids, r"\^", -1), F.lit(1))
    fits = F.get(F.split(codes, r"\^", -1), F.lit(1)) == "SS"
    return df.withColumn("ssn", F.when(fits, second).when(F.coalesce(F.col(ids), F.lit("")) != "", F.col(ids)).otherwise(F.col(existing)))


def backfill_passthrough(df: DataFrame, columns: dict[str, str], defaults: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(s).alias(t) for t, s in columns.items()], *[F.lit(v).alias(t) for t, v in defaults.items()])


def facility_reference(facilities: DataFrame, locations: DataFrame) -> DataFrame:
    return facilities.filter("active").join(locations, "facility", "left")


def schema_from_templates(templates: DataFrame, order: DataFrame, skip: list[str], static: list[str], clash: list[str]) -> DataFrame:
    """(seg, model): distinct paths of all templates, in the order of templates and of lines in them, joined by ^.

    ``templates`` (tpl, pos, seg, field, comp), ``order`` (tpl, tpl_pos), both config."""
    path = F.concat_ws("|", F.when(F.col("field").isin(clash), F.concat(F.lit("_"), "field")).otherwise(F.col("field")), F.nullif("comp", F.lit("")))
    rows = templates.filter(~F.col("seg").isin(skip) & ~F.col("field").isin(static)).join(config(order), "tpl")
    first = rows.groupBy("seg", path.alias("path")).agg(F.min(F.struct("tpl_pos", "pos")).alias("at"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "path")))
    return first.groupBy("seg").agg(F.array_join(F.transform(ordered, lambda x: x["path"]), "^").alias("model"))


#: The columns before a segment's own, as outputs must have them.
COMMON = ["etl_firstinsert_datetime", "field_seq_num", "sending_facility", "message_control_id", "medical_record_num", "medical_record_urn", "patient_account_num"]


def table_ddl(models: dict[str, str]) -> dict[str, T.StructType]:
    """segment -> columns: the common ones, a string for each path, two partition columns."""
    out = {}
    for seg, model in models.items():
        names = [*COMMON, *[p.replace("|", "_") for p in model.split("^")], "message_type", "transaction_date"]
        out[seg] = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return out


def add_columns(df: DataFrame, columns: list[str], like: DataFrame) -> DataFrame:
    """Rows of an older layout read as the newer one."""
    return df.unionByName(like.limit(0).select(*[c for c in like.columns if c in columns or c in df.columns]), allowMissingColumns=True)


# --- comparison -------------------------------------------------------------------------------------------------------


def cmp_tables(candidates: dict[str, DataFrame], references: dict[str, DataFrame]) -> list[tuple[str, str | None, str]]:
    """(candidate, reference, status): the reference whose name ends as the candidate's, else NO_TABLE."""
    out = []
    for name in sorted(candidates):
        found = next((r for r in sorted(references) if r.endswith(name.split("_", 1)[-1])), None)
        out.append((name, found, "FOUND" if found else "NO_TABLE"))
    return out


def last_of_key(df: DataFrame, key: str, order: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc(), *[F.col(c).desc() for c in df.columns if c not in (key, order)]))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def cmp_rows(cand: DataFrame, ref: DataFrame, key: str) -> DataFrame:
    side = ref.select(key).distinct().withColumn("_there", F.lit(True))
    return cand.select(key).distinct().join(side, key, "left").select(key, F.when(F.col("_there"), "MATCH").otherwise("NO_DATA").alias("status"))


def cmp_columns(cand: DataFrame, ref: DataFrame, key: str, skip: list[str]) -> DataFrame:
    """(key, column, got, expected) of cells that differ; a column that one side lacks is NULL there."""
    names = [c for c in dict.fromkeys([*cand.columns, *ref.columns]) if c != key and c not in skip]

    def cells(df: DataFrame, value: str) -> DataFrame:
        rows = df.select(key, *[(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in names])
        return rows.unpivot([key], names, "column", value)

    rows = cells(cand, "got").join(cells(ref, "expected"), [key, "column"])
    return rows.filter(~F.col("got").eqNullSafe(F.col("expected"))).select(key, "column", "got", "expected")


def cmp_report(rows: DataFrame, cells: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n")).unionByName(cells.groupBy(F.lit("MISMATCH").alias("status")).agg(F.count(F.lit(1)).alias("n")))
