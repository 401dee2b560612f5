"""Names for elements from mapping templates, and what follows from names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.operators.config import config, config_hint
from clinflow.operators.parse import USUAL, as_sent, as_usual, component, cut, exchange, field_parts, field_text, first_line, first_repetition, lines, part, repetitions, second_if_any, separators, structured

#: What naming reads of an element's message.
SOURCE = ("src", "fac", "tpl")
#: (control id prefix, source); the first that fits is the source.
SOURCES = (("MT6_", "MT6"), ("MT_", "MT"), ("EPIC_", "EPIC"), ("ECW_", "ECW"), ("NG_", "NG"), ("IP_", "IP"))


def with_source(raw: DataFrame, supported: DataFrame) -> DataFrame:
    """``raw`` and src, ver, fac, tpl; ``supported`` (src, ver, tpl) is a small config table. An unsupported version has no template.

    They are facts of a message's first line, so they are read before the message is taken apart, and its elements keep them."""
    msh = F.get(lines(F.col("raw")), F.lit(0))
    own = separators(F.col("raw"))
    ctrl = part(msh, 9, own)
    src = F.lit(None).cast("string")
    for prefix, name in reversed(SOURCES):
        src = F.when(ctrl.startswith(prefix), name).otherwise(src)
    rows = raw.select("*", src.alias("src"), part(msh, 11, own).alias("ver"), second_if_any(part(msh, 3, own), own).alias("fac"))
    return rows.join(config(supported), ["src", "ver"], "left").select(*raw.columns, "src", "ver", "fac", "tpl")


def source_system(raw: DataFrame, supported: DataFrame) -> DataFrame:
    return with_source(raw, supported).select("msg_id", "src", "ver", "fac", "tpl")


def deepest(names: Column) -> Column:
    """The last level that is not empty."""
    return F.try_element_at(F.filter(names, lambda x: x != ""), F.lit(-1))


def said(templates: DataFrame) -> DataFrame:
    """(elem_key, said, _varied): all that the templates say of a key, by template, and whether any but STD says something."""
    # of repeated lines one; whether a name is a name is judged here, once for each line, not for each element
    entries = templates.filter("tpl is not null").groupBy("elem_key", "tpl").agg(F.min(deepest(F.col("names"))).alias("name"))
    bad = F.contains("name", F.lit(".")) | (F.split_part("name", F.lit("_"), F.lit(-1)) == F.split_part("elem_key", F.lit("."), F.lit(-1)))
    entries = entries.filter("name is not null").withColumn("name", F.when(bad, "unknown").otherwise(F.col("name")))
    return entries.groupBy("elem_key").agg(F.map_from_entries(F.collect_list(F.struct("tpl", "name"))).alias("said"), F.max(F.col("tpl") != "STD").alias("_varied"))


def name_elements(elements: DataFrame, templates: DataFrame) -> DataFrame:
    """elements with elem_key, name, name_source. Precedence: realignment, facility, source, standard.

    ``elements`` keep src, fac and tpl of their message (``with_source``). ``templates`` (tpl, elem_key, names): tpl is STD, a
    source template, FAC:<facility> or ALIGN:<source>. It is a config table of a few thousand rows; all that it says of an
    element's key is one row here, so one join finds it.
    """
    told = config_hint(templates)(said(templates))
    key = F.concat("seg", F.lit("."), "field", F.lit("."), "comp")
    lookups = {}
    if "moved" in elements.columns:  # what realignment made sub-components has a name of its own for each
        key = F.when(F.col("moved"), F.concat(key, F.lit("."), "sub")).otherwise(key)
        lookups["moved"] = F.when(F.col("moved"), F.concat(F.lit("ALIGN:"), "tpl"))
    keyed = elements.withColumn("elem_key", key).join(told, "elem_key", "left")
    lookups |= {"realignment": F.concat(F.lit("ALIGN:"), "src"), "facility": F.concat(F.lit("FAC:"), "fac"), "source": F.col("tpl"), "standard": F.lit("STD")}
    # columns of their own, so that each lookup is made once however often its result is read
    # most keys have a standard name alone, so that nothing else is looked up for their elements
    keyed = keyed.withColumns({f"_{k}": F.try_element_at("said", tpl) if k == "standard" else F.when(F.col("_varied"), F.try_element_at("said", tpl)) for k, tpl in lookups.items()})
    keyed = keyed.withColumn("name", F.coalesce(*[F.col(f"_{k}") for k in lookups], F.lit("unknown")))
    source = F.coalesce(*[F.when(F.col(f"_{k}").isNotNull(), "realignment" if k == "moved" else k) for k in lookups])
    return keyed.select(*[c for c in elements.columns if c not in (*SOURCE, "moved")], "elem_key", "name", F.when(F.col("name") == "unknown", "unknown").otherwise(source).alias("name_source"))


def unknown_mapping(named: DataFrame) -> DataFrame:
    missing = named.filter("name = 'unknown' and value is not null").groupBy("msg_id").agg(F.collect_set("elem_key").alias("k"))
    return missing.select("msg_id", F.array_join(F.array_sort("k"), ",").alias("missing_keys"))


def unknown_values(named: DataFrame) -> DataFrame:
    rows = named.filter("name = 'unknown' and value is not null").groupBy("msg_id", "seg_seq")
    ordered = F.array_sort(F.collect_list(F.struct("field", "rep", "comp", "sub", "value")))
    return rows.agg(F.array_join(F.transform(ordered, lambda x: x["value"]), "^").alias("unknown"))


def crosswalk(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rules for ``parse.elements``, template lines with the moved parts' names) of crosswalk lines in column ``value``:
    template_key,version,,key,field,component,,new key,new field,new component,new sub-component,option. Keys are SEG.field.comp[.sub].

    A field's rule is what its lines say: one option and one target component."""
    at = lambda n: F.trim(F.get(F.split("value", ",", -1), F.lit(n)))
    rows = lines.filter("trim(value) <> ''").select(at(0).alias("whole"), at(3).alias("key"), at(7).alias("to_key"), F.array(at(8), at(9), at(10)).alias("names"), F.lower(at(11)).alias("option"))
    rows = rows.withColumn("tpl", F.expr("substring(whole, 1, length(whole) - length(key) - 1)"))
    part = lambda c, n: F.split_part(c, F.lit("."), F.lit(n))
    rules = rows.groupBy("tpl", part("key", 1).alias("seg"), part("key", 2).cast("int").alias("field")).agg(F.min("option").alias("option"), F.min(F.when(F.col("option") == "move", part("to_key", 3).cast("int"))).alias("to_comp"))
    return rules, rows.filter("option = 'move'").select(F.concat(F.lit("ALIGN:"), "tpl").alias("tpl"), F.col("to_key").alias("elem_key"), "names")


def realign_move(elements: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Components of a field become sub-components of component ``to_comp``; ``crosswalk`` (seg, field, to_field, to_comp) is config."""
    rules = config(crosswalk.select("seg", "field", "to_field", "to_comp"))
    rows = elements.join(rules, ["seg", "field"], "left")
    moved = F.col("to_field").isNotNull()
    keep = lambda a, b: F.when(moved, a).otherwise(b)
    return rows.select("msg_id", "seg_seq", "seg", keep(F.col("to_field"), F.col("field")).alias("field"), "rep", keep(F.col("to_comp"), F.col("comp")).alias("comp"), keep(F.col("comp"), F.col("sub")).alias("sub"), "value")


def realign_merge(elements: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Component values of a field joined into one, in order; only fields with a rule."""
    rules = config(crosswalk.select("seg", "field"))
    rows = elements.join(rules, ["seg", "field"], "left_semi").filter("value is not null").groupBy("msg_id", "seg_seq", "seg", "field", "rep")
    ordered = F.array_sort(F.collect_list(F.struct("comp", "sub", "value")))
    return rows.agg(F.array_join(F.transform(ordered, lambda x: x["value"]), "").alias("value"))


def _picked(elements: DataFrame, rules: DataFrame) -> DataFrame:
    """(msg_id, target, rule, seg_seq, rep, value): what each rule finds in each field; components that it doesn't read go before the grouping."""
    values = elements.filter("value is not null").join(config(rules), ["seg", "field"])
    values = values.filter((F.col("comp") == F.col("want_comp")) | (F.col("code").isNotNull() & (F.col("comp") == F.col("code_comp"))))
    item = ["msg_id", "seg_seq", "field", "rep", "target", "rule"]
    picked = values.groupBy(*item).agg(
        F.min(F.when(F.col("comp") == F.col("want_comp"), F.col("value"))).alias("value"),
        F.max(F.when(F.col("comp") == F.col("code_comp"), F.col("value"))).alias("said"),
        F.first("code").alias("code"),
    )
    fits = F.col("code").isNull() | F.col("said").isNull() | (F.col("said") == F.col("code"))
    return picked.filter(fits & F.col("value").isNotNull())


def path_lookup(elements: DataFrame, rules: DataFrame) -> DataFrame:
    """First value that is not empty, by rule order. ``rules`` (target, rule, seg, field, want_comp, code_comp, code); a rule with
    a code takes the repetition whose component ``code_comp`` has it, and holds for any where the message has no such component."""
    return _picked(elements, rules).groupBy("msg_id", "target").agg(F.min_by("value", F.struct("rule", "seg_seq", "rep")).alias("value"))


def common_elements(elements: DataFrame, rules: DataFrame, targets: list[str]) -> DataFrame:
    """One row for each message with the common ids: ``path_lookup`` of each target, by one grouping of the message."""
    place = F.struct("rule", "seg_seq", "rep")
    return _picked(elements, rules).groupBy("msg_id").agg(*[F.min_by("value", F.when(F.col("target") == t, place)).alias(t) for t in targets])


def _first(values: Column) -> Column:
    return F.get(F.filter(values, lambda x: x.isNotNull()), F.lit(0))


def _value(comps: Column, comp: int | None, own: Column, most: Callable[[Column], Column]) -> Column:
    """Value of a component of several as it was sent; of its sub-components ``most``, NULL if none is filled."""
    if comp is None or comp < 1:
        return F.lit(None).cast("string")
    at = F.get(comps, F.lit(comp - 1))
    filled = F.transform(F.filter(cut(at, "sub", None), lambda x: x != ""), lambda x: as_sent(x, own))
    return F.when(F.contains(at, F.lit(USUAL["sub"])), most(filled)).when(at != "", as_sent(at, own))


def _ruled(parts: Column, rule: tuple, own: Column) -> Column:
    """First value that a rule finds in an occurrence of its segment."""
    _, _, seg, field, comp, code_comp, code = rule
    if field < 1:
        return F.lit(None).cast("string")
    text = field_text(F.lit(seg), parts, F.lit(field))
    fits = lambda said: F.coalesce(said == code, F.lit(True))

    def fitting(comps: Column) -> Column:
        value = _value(comps, comp, own, F.array_min)
        return value if code is None else F.when(fits(_value(comps, code_comp, own, F.array_max)), value)

    plain = F.lit(None).cast("string")
    if comp == 1:  # a field without components is one value
        plain = F.when(text != "", as_sent(text, own))
        if code is not None and code_comp == 1:
            plain = F.when(fits(plain), plain)
    # each repetition is cut once, however often its components are read
    cut_reps = F.transform(repetitions(text, F.lit(seg), F.lit(field)), lambda x: cut(x, "comp", None))
    return F.when(structured(text, F.lit(seg), F.lit(field)), _first(F.transform(cut_reps, fitting))).otherwise(plain)


def with_common_ids(raw: DataFrame, rules: list[tuple], targets: list[str]) -> DataFrame:
    """``raw`` and the ids that ``common_elements`` finds, as columns: read where the message lies, so nothing is grouped or joined.

    ``rules`` are the rows of its table; those of a target have different numbers, since equal ones would leave the order open."""
    if len({r[:2] for r in rules}) < len(rules):
        raise ValueError("two rules of a target have the same number")
    own, usual = F.col("_own"), F.lit(USUAL["field"])
    rows = raw.select("*", exchange(F.col("raw")).alias("_own"), lines(F.col("raw")).alias("_lines"))
    # each line is cut once, whatever the number of rules that read it
    cut_lines = lambda seg: F.transform(F.filter("_lines", lambda x: F.substring(x, 1, 3) == seg), lambda x: field_parts(F.lit(seg), F.rtrim(as_usual(x, own), usual)))
    rows = rows.select(*raw.columns, "_own", *[cut_lines(seg).alias(f"_{seg}") for seg in sorted({r[2] for r in rules})])
    found = lambda rule: _first(F.transform(f"_{rule[2]}", lambda parts: _ruled(parts, rule, own)))
    ids = {t: [found(r) for r in sorted((r for r in rules if r[0] == t), key=lambda r: r[1])] for t in targets}
    return rows.select(*raw.columns, *[(F.coalesce(*v) if v else F.lit(None).cast("string")).alias(t) for t, v in ids.items()])


def interface_override(ids: DataFrame, pattern: str) -> DataFrame:
    """The account number goes where it only repeats the record number of an interface's messages."""
    drop = F.col("message_control_id").rlike(pattern) & F.col("patient_account_num").eqNullSafe(F.col("medical_record_urn"))
    return ids.withColumn("patient_account_num", F.when(~F.coalesce(drop, F.lit(False)), F.col("patient_account_num")))


def strip_nulls(elements: DataFrame) -> DataFrame:
    return elements.filter("value is not null")


def _segment_json(named: DataFrame) -> DataFrame:
    """(msg_id, seg_seq, seg, body): each segment as a JSON object of names to values (repeats as a list).

    Elements lie by message, and all groupings from here to the message keep its rows together."""
    values = named.groupBy("msg_id", "seg_seq", "seg", "name").agg(F.array_sort(F.collect_list(F.struct("field", "rep", "comp", "sub", "value"))).alias("v"))
    texts = F.transform("v", lambda x: x["value"])
    only, plain = F.get("v", F.lit(0))["value"], {"ignoreNullFields": "false"}
    # one text without a character that JSON escapes is quoted as it is; others are written as the value of an object and taken out of it
    written = F.to_json(F.when(F.size("v") == 1, F.struct(only.alias("v"))), plain)
    written = F.when(F.size("v") == 1, written).otherwise(F.to_json(F.struct(texts.alias("v")), plain))
    one = F.when((F.size("v") == 1) & ~only.rlike(r'["\\\p{Cntrl}\x{80}-\x{10FFFF}]'), F.concat(F.lit('"'), only, F.lit('"')))
    one = F.coalesce(one, F.regexp_extract(written, r'^\{"v":(?s:(.*))\}$', 1))
    values = values.withColumn("j", one).withColumn("at", F.get("v", F.lit(0))["field"])
    ordered = F.array_sort(F.collect_list(F.struct("at", "name", "j")))
    body = F.concat(F.lit("{"), F.array_join(F.transform(ordered, lambda x: F.concat(F.lit('"'), x["name"], F.lit('":'), x["j"])), ","), F.lit("}"))
    return values.groupBy("msg_id", "seg_seq", "seg").agg(body.alias("body"))


def to_json(named: DataFrame, always_lists: bool = False) -> DataFrame:
    """(msg_id, json): segments by name in order of place; several of a name are a list. ``always_lists``: all but MSH are."""
    bodies = _segment_json(named).groupBy("msg_id", "seg").agg(F.array_sort(F.collect_list(F.struct("seg_seq", "body"))).alias("b"))
    texts = F.array_join(F.transform("b", lambda x: x["body"]), ",")
    listed = (F.col("seg") != "MSH") if always_lists else F.size("b") > 1
    rows = bodies.select("msg_id", F.get("b", F.lit(0))["seg_seq"].alias("at"), "seg", F.when(listed, F.concat(F.lit("["), texts, F.lit("]"))).otherwise(texts).alias("j"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "seg", "j")))
    whole = F.concat(F.lit("{"), F.array_join(F.transform(ordered, lambda x: F.concat(F.lit('"'), x["seg"], F.lit('":'), x["j"])), ","), F.lit("}"))
    return rows.groupBy("msg_id").agg(whole.alias("json"))


def header_ids(raw: DataFrame) -> DataFrame:
    """The common ids straight from the text, where only they are needed."""
    msh, pid = F.get(lines(F.col("raw")), F.lit(0)), first_line(F.col("raw"), "PID")
    own = separators(F.col("raw"))
    ids = first_repetition(part(pid, 3, own), own)
    clean = lambda c: F.coalesce(c, F.lit(""))
    return raw.select("msg_id", clean(second_if_any(part(msh, 3, own), own)).alias("sending_facility"), clean(part(msh, 9, own)).alias("message_control_id"), clean(component(ids, 1, own)).alias("medical_record_num"), clean(component(part(pid, 4, own), 1, own)).alias("medical_record_urn"), clean(second_if_any(part(pid, 18, own), own)).alias("patient_account_num"))
