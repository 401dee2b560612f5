"""One row for each segment occurrence, from named elements and segment models.

``models`` (type, seg, pos, path) is config: paths are ``field`` or ``field|comp``, levels joined by ``|``.

``project`` and ``fan_out`` take elements, or ``parse.occurrences``, whose fields lie in one row: these are joined with the models
once for each segment and not grouped. Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.operators.config import config_hint
from clinflow.operators.parse import USUAL, as_sent, cut, field_text, field_values, has_component, structured

#: Types whose messages carry another code in their header.
FREE_TYPES = ("IPLORU", "ORMORDERS", "IPLORDERS", "VENTORU")
ETL, SEQ = "etl_firstinsert_datetime", "field_seq_num"


def join_repeats(values: Column) -> Column:
    """Values in order, joined by ^; empty ones at the start add nothing."""
    return F.aggregate(values, F.lit(""), lambda a, v: F.when(a == "", v).otherwise(F.concat(a, F.lit("^"), v)))


def element_path(with_component: Column | None = None) -> Column:
    """field|comp of an element; the field alone for a field without components."""
    deep = F.col("comp") > 0 if with_component is None else with_component
    return F.when(deep, F.concat("field", F.lit("|"), "comp")).otherwise(F.col("field").cast("string"))


def parent_fallback(elements: DataFrame, models: DataFrame) -> DataFrame:
    """``path``: the element's own path if it is modelled, else its field's if that has several modelled children.

    All that the models say of a segment's field is one row, found by one join (by type too where both sides have one)."""
    by = ["type", "seg"] if "type" in elements.columns and "type" in models.columns else ["seg"]
    field, below = F.split_part("path", F.lit("|"), F.lit(1)), F.regexp_replace("path", r"^[^|]*\|?", "")
    deep = F.contains("path", F.lit("|"))
    said = models.groupBy(*by, field.alias("said_field")).agg(F.collect_set(F.when(deep, below)).alias("said_comps"), F.max(~deep).alias("said_whole"))
    keyed = elements.withColumn("said_field", F.col("field").cast("string")).join(config_hint(models)(said), [*by, "said_field"], "left")
    comp = F.col("comp").cast("string")
    path = F.when(F.array_contains("said_comps", comp), F.concat("said_field", F.lit("|"), comp))
    path = path.when((F.col("comp") == 1) & F.col("said_whole"), F.col("said_field")).when(F.size("said_comps") > 1, F.col("said_field"))
    return keyed.select(*[F.col(c) for c in elements.columns], path.alias("path"))


def _number(text: Column) -> Column:
    """The number that a level of a path names; -1, which no field or component has, for any other text."""
    return F.when(text.rlike(r"^[1-9][0-9]{0,8}$"), text.cast("int")).otherwise(-1)


def _said(models: DataFrame, by: list[str]) -> DataFrame:
    """What the models say of each field: (field, comps, whole, many) and the places that its paths have."""
    field, below = F.split_part("path", F.lit("|"), F.lit(1)), F.regexp_replace("path", r"^[^|]*\|?", "")
    deep = F.contains("path", F.lit("|"))
    rows = models.groupBy(*by, field.alias("name")).agg(F.collect_set(F.when(deep, below)).alias("below"), F.max(~deep).alias("whole"), F.collect_set(F.struct("pos", "path", F.when(deep, _number(below)).alias("comp"))).alias("places"))
    said = F.struct(_number(F.col("name")).alias("field"), F.transform("below", _number).alias("comps"), "whole", (F.size("below") > 1).alias("many"))
    return rows.select(*by, said.alias("said"), "places")


def _of(said: Column, field: Column) -> Column:
    """What the models say of one field."""
    return F.get(F.filter(said, lambda x: x["field"] == field), F.lit(0))


def _wanted(said: Column, comp: Column) -> Callable[[Column], Column]:
    """Whether a component, by its number, is of the path: ``comp``, or where that is NULL the field itself (see ``parent_fallback``)."""
    return lambda n: F.when(comp.isNotNull(), n == comp).otherwise(~F.array_contains(said["comps"], n) & (((n == 1) & said["whole"]) | said["many"]))


def _found(field: Column, first: Column, wanted: Callable[[Column], Column]) -> Column:
    """Whether an occurrence has a wanted component. ``first``: whether the first, which every field has, is one."""
    text = field_text(F.col("seg"), F.col("parts"), field)
    return text.isNotNull() & (first | (structured(text, F.col("seg"), field) & has_component(text, F.col("seg"), field, wanted)))


def _cell(said: Column, comp: Column, first: Column) -> Column:
    """An occurrence's text for the path; each value as it was sent. A field without components, and one component of a field
    without repetitions and sub-components, are taken as they are."""
    seg, field, own = F.col("seg"), said["field"], F.col("own")
    text = field_text(seg, F.col("parts"), field)
    several, deep = structured(text, seg, field), F.contains(text, F.lit(USUAL["rep"])) | F.contains(text, F.lit(USUAL["sub"]))
    one = F.when(several, F.get(cut(text, "comp", None), comp - 1)).when(first, text)
    joined = join_repeats(F.transform(field_values(text, seg, field, _wanted(said, comp)), lambda x: as_sent(x, own)))
    return F.when(several & (comp.isNull() | deep), joined).otherwise(as_sent(F.coalesce(one, F.lit("")), own))


def _by(rows: DataFrame, models: DataFrame) -> list[str]:
    return ["type", "seg"] if "type" in rows.columns and "type" in models.columns else ["seg"]


def _project_rows(rows: DataFrame, models: DataFrame, seg: str, paths: list[str]) -> DataFrame:
    models, by = models.filter(F.col("seg") == seg), _by(rows, models)
    of_field, comp, first = {}, {}, {}
    for i, path in enumerate(paths):
        name, _, below = path.partition("|")
        of_field[f"_said_{i}"] = _of(F.col("said"), _number(F.lit(name)))
        said, deep = F.col(f"_said_{i}"), _number(F.lit(below))
        comp[f"_comp_{i}"] = F.when(F.array_contains(said["comps"], deep), deep).otherwise(-1) if "|" in path else F.lit(None).cast("int")
        first[f"_first_{i}"] = _wanted(said, F.col(f"_comp_{i}"))(F.lit(1))
    told = _said(models, by).groupBy(*by).agg(F.collect_list("said").alias("said")).select(*by, *[c.alias(k) for k, c in of_field.items()])
    keyed = rows.filter(F.col("seg") == seg).join(config_hint(models)(told.withColumns(comp).withColumns(first)), by)
    keep = [c for c in rows.columns if c not in ("msg_id", "seg_seq", "seg", "parts", "own", *by)]
    asked = [(F.col(f"_said_{i}"), F.col(f"_comp_{i}"), F.col(f"_first_{i}")) for i in range(len(paths))]
    found = keyed.filter(reduce(or_, [_found(s["field"], one, _wanted(s, c)) for s, c, one in asked], F.lit(False)))
    return found.select("msg_id", "seg_seq", *keep, *[_cell(*a).alias(f"f_{p.replace('|', '_')}") for a, p in zip(asked, paths, strict=True)])


def _fan_out_rows(rows: DataFrame, models: DataFrame) -> DataFrame:
    by = _by(rows, models)
    named = lambda s: lambda n: s["many"] | ((n == 1) & s["whole"]) | F.array_contains(s["comps"], n)
    fields = F.struct("said", named(F.col("said"))(F.lit(1)).alias("first"))
    places = F.transform("places", lambda p: F.struct(p["pos"].alias("pos"), p["path"].alias("path"), p["comp"].alias("comp"), F.col("said"), _wanted(F.col("said"), p["comp"])(F.lit(1)).alias("first")))
    told = _said(models, by).select(*by, fields.alias("fields"), places.alias("places")).groupBy(*by).agg(F.collect_list("fields").alias("fields"), F.array_sort(F.flatten(F.collect_list("places"))).alias("places"))
    found = F.exists("fields", lambda f: _found(f["said"]["field"], f["first"], named(f["said"])))
    cells = F.transform("places", lambda p: _cell(p["said"], p["comp"], p["first"]))
    keyed = rows.join(config_hint(models)(told), by).filter(found)
    return keyed.select(F.col("seg").alias("hl7_segment"), "msg_id", "seg_seq", F.array_join(cells, "|").alias("row"))


def project(elements: DataFrame, models: DataFrame, seg: str, paths: list[str]) -> DataFrame:
    """A row for each occurrence of a segment, with a column for each path; elements that no model asks for go before the grouping.

    Occurrences hand on the columns that they keep of their message."""
    if "parts" in elements.columns:
        return _project_rows(elements, models, seg, paths)
    rows = parent_fallback(elements.filter(F.col("seg") == seg), models.filter(F.col("seg") == seg))
    rows = rows.filter(F.col("path").isin(paths))
    # one list an occurrence, whatever the number of paths: Spark writes out and reads each list of a group when it sorts
    values = F.array_sort(F.collect_list(F.struct("field", "rep", "comp", "sub", "path", F.coalesce("value", F.lit("")).alias("value"))))
    cell = lambda p: join_repeats(F.transform(F.filter("v", lambda x: x["path"] == p), lambda x: x["value"]))
    return rows.groupBy("msg_id", "seg_seq").agg(values.alias("v")).select("msg_id", "seg_seq", *[cell(p).alias(f"f_{p.replace('|', '_')}") for p in paths])


def etl_timestamp(as_of: Column) -> Column:
    """yyyyMMddHHmmss and the milliseconds in seven digits."""
    return F.concat(F.date_format(as_of, "yyyyMMddHHmmss"), F.lpad(F.date_format(as_of, "SSS"), 7, "0"))


def common_columns(rows: DataFrame, ids: DataFrame | list[str], as_of: Column) -> DataFrame:
    """Load time, segment number and the common ids before a segment's columns. ``ids``: a table by message, or the names of the
    columns where the rows have them already. A segment whose message has no ids stays."""
    names = ids if isinstance(ids, list) else [c for c in ids.columns if c != "msg_id"]
    own = [c for c in rows.columns if c not in ("msg_id", "seg_seq", *names)]
    joined = rows if isinstance(ids, list) else rows.join(ids, "msg_id", "left")
    return joined.select("msg_id", etl_timestamp(as_of).alias(ETL), F.lpad(F.col("seg_seq").cast("string"), 4, "0").alias(SEQ), *names, *own)


def skipped(segments: DataFrame, rows: DataFrame) -> DataFrame:
    """Segments of a model without a modelled field."""
    return segments.join(rows.select("msg_id", "seg_seq"), ["msg_id", "seg_seq"], "left_anti").withColumn("state", F.lit("SKIPPED"))


def not_applicable(messages: DataFrame, segments: DataFrame, models: DataFrame) -> DataFrame:
    """How many messages of a type lack a segment that the type has a model for; counts only, no pair of message and model."""
    wanted = config_hint(models)(models.select("type", "seg").distinct())
    totals = messages.groupBy("type").agg(F.count(F.lit(1)).alias("messages"))
    having = segments.select("msg_id", "seg").distinct().join(messages.select("msg_id", "type"), "msg_id").groupBy("type", "seg").agg(F.count(F.lit(1)).alias("having"))
    rows = wanted.join(totals, "type").join(having, ["type", "seg"], "left")
    return rows.select("type", "seg", (F.col("messages") - F.coalesce("having", F.lit(0))).alias("n")).filter("n > 0")


def type_gate(messages: DataFrame, registered: str) -> tuple[DataFrame, DataFrame]:
    good = F.lit(True) if registered in FREE_TYPES else F.coalesce(F.col("code") == registered, F.lit(False))
    return messages.filter(good), messages.filter(~good)


def dedupe_rows(rows: DataFrame) -> DataFrame:
    """Equal rows of one message collapse, whatever their place."""
    return rows.dropDuplicates([c for c in rows.columns if c not in ("seg_seq", SEQ)])


def fan_out(elements: DataFrame, models: DataFrame) -> DataFrame:
    """(hl7_segment, msg_id, seg_seq, row): rows of all modelled segments at once, by one grouping, each as delimited text.

    Where elements have a type, each is held against its type's models: all types in the same pass."""
    if "parts" in elements.columns:
        return _fan_out_rows(elements, models)
    by = ["type", "seg"] if "type" in elements.columns and "type" in models.columns else ["seg"]
    rows = parent_fallback(elements, models).filter("path is not null")
    places = config_hint(models)(models.groupBy(*by).agg(F.array_sort(F.collect_set(F.struct("pos", "path"))).alias("paths")))
    values = rows.groupBy(*by, "msg_id", "seg_seq").agg(F.array_sort(F.collect_list(F.struct("field", "rep", "comp", "sub", "path", F.coalesce("value", F.lit("")).alias("value")))).alias("v"))
    cell = lambda p: join_repeats(F.transform(F.filter("v", lambda x: x["path"] == p["path"]), lambda x: x["value"]))
    return values.join(places, by).select(F.col("seg").alias("hl7_segment"), "msg_id", "seg_seq", F.array_join(F.transform("paths", cell), "|").alias("row"))


def segment_view(df: DataFrame, seg: str, name: str) -> DataFrame:
    out = df.filter(F.col("hl7_segment") == seg)
    out.createOrReplaceTempView(name)
    return out
