"""Message text to elements: generators over the whole table, after one shuffle of the raw text.

``elements(msg_id, seg_seq, seg, field, rep, comp, sub, value)`` has a row for each part of each message; an empty part
has the value NULL. Each message is cut at the separators that its own MSH names: ``split_segments`` puts into the
column ``own``, which the splits carry, how they differ from the usual ones (``exchange``). It is NULL for the usual set, and for a text that doesn't begin with MSH and four
different separators. The escape and truncation characters cut nothing.

A line with separators of its own is cut in the usual ones' terms: ``split_fields`` exchanges the characters of the two
sets (``as_usual``), so that one plain pattern serves every row, and ``as_sent`` gives a text its characters back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.operators.config import config

NO_CONTROL = "no message control ID"
#: In the order of MSH, where the escape character stands before the last.
USUAL = {"field": "|", "comp": "^", "rep": "~", "sub": "&"}
#: The columns that the splits make and read themselves; what else their input has, they hand on.
PLACES = ("msg_id", "seg_seq", "seg", "line", "field", "text", "rep", "comp", "n_comp", "sub", "value")


def lines(raw: Column) -> Column:
    """Segments of a message: cut at CR LF if it has any, else at LF."""
    return F.when(F.contains(raw, F.lit("\r\n")), F.split(raw, "\r\n")).otherwise(F.split(raw, "\n"))


def normalize_newlines(raw: Column) -> Column:
    return F.regexp_replace(raw, "[\r\n]+", "\r\n")


def separators(raw: Column) -> Column:
    """A message's own separators (field, comp, rep, sub); NULL if they are the usual ones or not all there."""
    at = {"field": 4, "comp": 5, "rep": 6, "sub": 8}
    usual = (F.substring(raw, 4, 3) == "|^~") & (F.substring(raw, 8, 1) == "&")
    return F.when(raw.startswith("MSH") & (F.length(raw) >= 8) & ~usual, F.struct(*[F.substring(raw, n, 1).alias(k) for k, n in at.items()]))


def exchange(raw: Column) -> Column:
    """The characters to exchange, ``sent`` for ``usual``, so that a message has the usual separators; NULL if it has them, or not four different ones."""
    four, usual = F.concat(F.substring(raw, 4, 3), F.substring(raw, 8, 1)), F.lit("".join(USUAL.values()))
    different = F.size(F.array_distinct(F.split(four, ""))) == len(USUAL)
    without = lambda a, b: F.call_function("translate", a, b, F.lit(""))
    pair = F.struct(F.concat(four, without(usual, four)).alias("sent"), F.concat(usual, without(four, usual)).alias("usual"))
    return F.when(raw.startswith("MSH") & (F.length(raw) >= 8) & (four != usual) & different, pair)


def as_usual(text: Column, own: Column) -> Column:
    """``text`` with the usual separators in place of its message's own, and these in place of those: nothing is lost."""
    return F.when(own.isNull(), text).otherwise(F.call_function("translate", text, own["sent"], own["usual"]))


def as_sent(text: Column, own: Column) -> Column:
    return F.when(own.isNull(), text).otherwise(F.call_function("translate", text, own["usual"], own["sent"]))


def split_segments(raw: DataFrame, keep: tuple[str, ...] = (), segs: tuple[str, ...] | None = None, deal: bool = False) -> DataFrame:
    """``keep``: columns of a message that its segments, and what they are cut into, hand on, so that no join by message brings them
    back. ``segs``: only these segments. ``deal``: messages are first dealt by msg_id, so that few large files or a join that Spark runs
    by broadcast don't leave the work to few tasks, and what follows groups by message without a shuffle of its many more parts."""
    cut_at = lines(F.col("raw"))
    if segs:  # the others go before anything is shuffled; their places stay
        cut_at = F.transform(cut_at, lambda x: F.when(F.substring(x, 1, 3).isin(*segs), x).otherwise(""))
    rows = raw.select("msg_id", exchange(F.col("raw")).alias("own"), *keep, cut_at.alias("lines"))
    if deal:
        rows = rows.repartition("msg_id")
    # outer, since Spark puts before an inner one a filter on the size of the list, which would make the list twice; a row of none goes below
    rows = rows.select("msg_id", "own", *keep, F.posexplode_outer("lines").alias("pos", "line"))
    return rows.filter("line <> ''").select("msg_id", (F.col("pos") + 1).alias("seg_seq"), F.substring("line", 1, 3).alias("seg"), "line", "own", *keep)


def delimiters(raw: DataFrame) -> DataFrame:
    at = lambda n: F.substring("raw", n, 1)
    eighth = F.substring("raw", 9, 1)
    truncation = F.when(eighth.isin("", "|") | (eighth == at(4)), "//").otherwise(eighth)
    return raw.select("*", at(4).alias("d_field"), at(5).alias("d_comp"), at(6).alias("d_rep"), at(7).alias("d_escape"), at(8).alias("d_sub"), truncation.alias("d_trunc"))


def _quoted(d: Column) -> Column:
    return F.concat(F.lit("\\Q"), d, F.lit("\\E"))


def separator(kind: str, own: Column | None) -> Column:
    usual = F.lit(USUAL[kind])
    return usual if own is None else F.coalesce(own[kind], usual)


def cut(text: Column, kind: str, own: Column | None) -> Column:
    """``text`` cut at a separator; by a literal pattern where it is the usual one."""
    usual = F.split(text, f"\\{USUAL[kind]}", -1)  # an escaped character is cut at without a pattern
    return usual if own is None else F.when(own.isNull(), usual).otherwise(F.split(text, _quoted(own[kind]), -1))


def cut_if_any(text: Column, kind: str) -> Column:
    """``text`` cut at a usual separator. Most texts have none and are not looked through by a pattern."""
    return F.when(F.contains(text, F.lit(USUAL[kind])), cut(text, kind, None)).otherwise(F.array(text))


def _own(rows: DataFrame) -> Column | None:
    """The separators that ``rows`` carry; without them the usual ones are meant."""
    return F.col("own") if "own" in rows.columns else None


def _carried(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in PLACES]


def split_fields(segments: DataFrame, sep: Column | None = None) -> DataFrame:
    """Trailing empty fields are dropped; field 1 of MSH is the separator itself. ``sep``: in place of each message's own. ``text`` has the usual separators."""
    own, line = _own(segments), F.col("line")
    if sep is None:
        line, sep = line if own is None else as_usual(line, own), F.lit(USUAL["field"])
        parts = cut(F.rtrim(line, sep), "field", None)
    else:
        parts = F.split(F.rtrim(line, sep), _quoted(sep), -1)
    rows = segments.select("msg_id", "seg_seq", "seg", *_carried(segments), F.posexplode(parts).alias("pos", "text"))
    msh = F.col("seg") == "MSH"
    rows = rows.filter((F.col("pos") > 0) | msh)  # the segment's name is no field; in MSH the separator takes its place
    return rows.select("msg_id", "seg_seq", "seg", (F.col("pos") + msh.cast("int")).alias("field"), F.when(F.col("pos") == 0, sep).otherwise(F.col("text")).alias("text"), *_carried(segments))


def whole_field() -> Column:
    """Fields that are never cut: the separators of MSH."""
    return (F.col("seg") == "MSH") & F.col("field").isin(1, 2)


def _structured(text: Column) -> Column:
    """The items of a repeated field that have components."""
    return F.filter(cut(text, "rep", None), lambda x: F.contains(x, F.lit(USUAL["comp"])))


def split_repetitions(fields: DataFrame) -> DataFrame:
    """A repeated field whose items have no components keeps its text as one value; if some have, only they remain."""
    observed = (F.col("seg") == "OBX") & (F.col("field") == 5)
    several = F.contains("text", F.lit(USUAL["rep"])) & ~whole_field() & ~observed
    rows = fields.withColumn("having", F.when(several, _structured(F.col("text"))))
    rows = rows.select("msg_id", "seg_seq", "seg", "field", *_carried(fields), F.posexplode(F.when(F.size("having") > 0, F.col("having")).otherwise(F.array("text"))).alias("pos", "text"))
    return rows.select("msg_id", "seg_seq", "seg", "field", (F.col("pos") + 1).alias("rep"), "text", *_carried(fields))


def split_components(reps: DataFrame, realign: DataFrame | None = None) -> DataFrame:
    """``realign`` (tpl, seg, field, option, to_comp; config): in messages of the template, a field with several components is realigned
    before it is cut. ``merge``: their texts make one component. ``move``: they become sub-components of component ``to_comp``, and
    the sub-components that they had stand in their row; such rows are marked in the column ``moved``."""
    cut_text = cut_if_any(F.col("text"), "comp")
    if realign is None:
        rows = reps.withColumn("parts", F.when(whole_field(), F.array("text")).otherwise(cut_text))
        n_comp, place, more = F.size("parts"), F.col("pos") + 1, []
    else:
        rules = config(realign.select("tpl", "seg", "field", F.col("option").alias("_option"), F.col("to_comp").alias("_to")))
        rows = reps.join(rules, ["tpl", "seg", "field"], "left")
        option = F.when(F.contains("text", F.lit(USUAL["comp"])) & ~whole_field(), F.col("_option"))
        one = lambda mark: F.array(F.replace("text", F.lit(USUAL["comp"]), F.lit(mark)))
        rows = rows.withColumn("_option", option).withColumn("parts", F.when(F.col("_option") == "merge", one("")).when(F.col("_option") == "move", one(USUAL["sub"])).when(whole_field(), F.array("text")).otherwise(cut_text))
        moved = F.coalesce(F.col("_option") == "move", F.lit(False))
        n_comp, place, more = F.size("parts") + moved.cast("int"), F.when(moved, F.col("_to")).otherwise(F.col("pos") + 1), [moved.alias("moved")]
        rows = rows.withColumn("n_parts", n_comp)
        n_comp = F.col("n_parts")
    rows = rows.select("msg_id", "seg_seq", "seg", "field", "rep", *_carried(reps), *more, *(["_option", "_to"] if realign is not None else []), n_comp.alias("n_comp"), F.posexplode("parts").alias("pos", "text"))
    return rows.select("msg_id", "seg_seq", "seg", "field", "rep", "n_comp", place.alias("comp"), "text", *_carried(reps), *(["moved"] if realign is not None else []))


def split_subcomponents(comps: DataFrame) -> DataFrame:
    """Cut at & only where the field has two components or more. The value has the characters that were sent."""
    parts = F.when((F.col("n_comp") > 1) & F.contains("text", F.lit(USUAL["sub"])), cut(F.col("text"), "sub", None)).otherwise(F.array("text"))
    own = _own(comps)
    rows = comps.select("msg_id", "seg_seq", "seg", "field", "rep", "comp", *_carried(comps), F.posexplode(parts).alias("pos", "text"))
    text = F.col("text") if own is None else as_sent(F.col("text"), own)
    return rows.select("msg_id", "seg_seq", "seg", "field", "rep", "comp", (F.col("pos") + 1).alias("sub"), F.when(F.col("text") != "", text).alias("value"), *[c for c in _carried(comps) if c != "own"])


def elements(raw: DataFrame, segs: tuple[str, ...] | None = None, keep: tuple[str, ...] = (), deal: bool = True, realign: DataFrame | None = None, fields: dict[str, tuple[int, ...]] | None = None, filled: bool = False) -> DataFrame:
    """``segs``: only these segments are taken apart. ``keep``: columns of the message that elements have too. The rows lie by msg_id (``deal``).
    ``realign``: see ``split_components``; the message has the column tpl then, which is kept. ``fields``: only these of each segment are
    cut further, other segments go. ``filled``: empty parts, whose value would be NULL, go where they are met, so that no later cut or join sees them."""
    there = (lambda rows: rows.filter("text <> ''")) if filled else (lambda rows: rows)
    cut_at = split_fields(split_segments(raw, keep, tuple(fields) if segs is None and fields else segs, deal))
    if fields is not None:
        asked = [(F.col("seg") == seg) & F.col("field").isin(*numbers) for seg, numbers in fields.items()]
        cut_at = cut_at.filter(reduce(or_, asked, F.lit(False)))
    rows = split_subcomponents(there(split_components(split_repetitions(there(cut_at)), realign)))
    return rows.filter("value is not null") if filled else rows


# --- segments whose fields stay in their row --------------------------------------------------------------------------


def occurrences(raw: DataFrame, segs: tuple[str, ...] | None = None, keep: tuple[str, ...] = (), deal: bool = True) -> DataFrame:
    """(msg_id, seg_seq, seg, parts, own): a row for each segment, for what makes one row of a segment anyway: nothing has to be
    grouped again. ``field_text`` and ``field_values`` read of ``parts`` what the splits make rows of. The texts have the usual separators."""
    line = F.rtrim(as_usual(F.col("line"), F.col("own")), F.lit(USUAL["field"]))
    return split_segments(raw, keep, segs, deal).select("msg_id", "seg_seq", "seg", field_parts(F.col("seg"), line).alias("parts"), "own", *keep)


def field_parts(seg: Column, line: Column) -> Column:
    """A segment's fields at their numbers: MSH has its name twice, since the separator is its first field (see ``field_text``)."""
    return cut(F.when(seg == "MSH", F.concat(F.lit("MSH" + USUAL["field"]), line)).otherwise(line), "field", None)


def field_text(seg: Column, parts: Column, field: Column) -> Column:
    """Text of a field; NULL if the segment ends before it."""
    return F.when((seg == "MSH") & (field == 1), USUAL["field"]).otherwise(F.get(parts, field))


def structured(text: Column, seg: Column, field: Column) -> Column:
    """Whether a field has components: a text without any is one value, whatever its other separators."""
    return F.contains(text, F.lit(USUAL["comp"])) & ~((seg == "MSH") & field.isin(1, 2))


def repetitions(text: Column, seg: Column, field: Column) -> Column:
    """Repetitions of a field that is ``structured``."""
    observed = (seg == "OBX") & (field == 5)
    return F.when(F.contains(text, F.lit(USUAL["rep"])) & ~observed, _structured(text)).otherwise(F.array(text))


def subcomponents(comp: Column) -> Column:
    """Values of a component of a field that is ``structured``."""
    return F.when(F.contains(comp, F.lit(USUAL["sub"])), cut(comp, "sub", None)).otherwise(F.array(comp))


def field_values(text: Column, seg: Column, field: Column, wanted: Callable[[Column], Column]) -> Column:
    """Values, in order, of the components that are ``wanted`` by their number; empty ones are empty texts, none is an empty list."""
    one = lambda rep: F.flatten(F.transform(F.filter(cut(rep, "comp", None), lambda _, i: wanted(i + 1)), subcomponents))
    deep = F.flatten(F.transform(repetitions(text, seg, field), one))
    return F.when(text.isNull(), F.array().cast("array<string>")).when(structured(text, seg, field), deep).when(wanted(F.lit(1)), F.array(text)).otherwise(F.array().cast("array<string>"))


def has_component(text: Column, seg: Column, field: Column, wanted: Callable[[Column], Column]) -> Column:
    """Whether ``field_values`` finds any, without making them."""
    deep = F.exists(repetitions(text, seg, field), lambda rep: F.size(F.filter(cut(rep, "comp", None), lambda _, i: wanted(i + 1))) > 0)
    return text.isNotNull() & F.when(structured(text, seg, field), deep).otherwise(wanted(F.lit(1)))


def simple_repeats(fields: DataFrame) -> DataFrame:
    """(…, text, kept): what the rule for repeated fields leaves of each."""
    having = _structured(F.col("text"))
    return fields.withColumn("kept", F.when(F.size(having) == 0, F.array("text")).otherwise(having))


# --- header facts without the element table ---------------------------------------------------------------------------


def part(line: Column, n: int, own: Column | None = None) -> Column:
    """The n-th part between field separators, counted from 0; NULL if there is none. ``own``: the message's ``separators``."""
    return F.get(cut(line, "field", own), F.lit(n))


def component(text: Column, n: int, own: Column | None = None) -> Column:
    return F.get(cut(text, "comp", own), F.lit(n - 1))


def first_repetition(text: Column, own: Column | None = None) -> Column:
    return F.get(cut(text, "rep", own), F.lit(0))


def first_line(raw: Column, seg: str) -> Column:
    return F.get(F.filter(lines(raw), lambda x: x.startswith(seg)), F.lit(0))


def second_if_any(text: Column, own: Column | None = None) -> Column:
    return F.when(F.contains(text, separator("comp", own)), component(text, 2, own)).otherwise(text)


def meta_fast(raw: DataFrame) -> DataFrame:
    """``raw`` and its metadata, from the MSH line and the first PID line alone."""
    msh, pid = F.get(lines(F.col("raw")), F.lit(0)), first_line(F.col("raw"), "PID")
    own = separators(F.col("raw"))
    none = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit(NO_CONTROL))
    ids = first_repetition(part(pid, 3, own), own)
    out = {
        "control_id": none(part(msh, 9, own)),
        "create_time": none(part(msh, 6, own)),
        "mrn": none(component(ids, 1, own)),
        "urn": none(component(part(pid, 4, own), 1, own)),
        "account": none(second_if_any(part(pid, 18, own), own)),
        "facility": none(second_if_any(part(msh, 3, own), own)),
        "trigger": none(component(part(msh, 8, own), 2, own)),
    }
    return raw.select("*", *[v.alias(k) for k, v in out.items()])


def type_from_key(raw: DataFrame, types: DataFrame) -> DataFrame:
    """Message type from the key's first part, NULL if it is not in ``types`` (column type; a fixed, small list)."""
    named = raw.withColumn("type", F.split_part("key", F.lit(":"), F.lit(1)))
    known = config(types.select(F.col("type"), F.lit(True).alias("known")))
    return named.join(known, "type", "left").withColumn("type", F.when(F.col("known"), F.col("type"))).drop("known")


def type_from_body(raw: DataFrame, types: DataFrame) -> DataFrame:
    msh = F.get(lines(F.col("raw")), F.lit(0))
    own = separators(F.col("raw"))
    code = component(part(msh, 8, own), 1, own)
    code = F.when((code == "ORU") & part(msh, 9, own).startswith("IP"), "IPLORU").otherwise(code)
    named = raw.withColumn("code", code)
    known = config(types.select(F.col("type").alias("code"), F.lit(True).alias("known")))
    found = named.join(known, "code", "left")
    reason = F.when(F.col("known").isNull(), "UnknownMessageType")
    return found.withColumns({"type": F.when(F.col("known"), F.col("code")), "reject_reason": reason}).drop("known", "code")


def reject_malformed(raw: DataFrame) -> DataFrame:
    msh = F.get(lines(F.col("raw")), F.lit(0))
    reason = F.when(F.coalesce(F.col("raw"), F.lit("")) == "", "empty message").when(~F.col("raw").startswith("MSH"), "message does not start with MSH").when(F.coalesce(part(msh, 9, separators(F.col("raw"))), F.lit("")) == "", "blank control id")
    return raw.withColumn("reject_reason", reason)


def reject_multi_header(raw: DataFrame) -> DataFrame:
    """Without a shuffle: header lines are counted inside the row."""
    n = F.size(F.filter(lines(F.col("raw")), lambda x: x.startswith("MSH")))
    return raw.select("msg_id", F.when(n > 1, "more than one MSH segment").alias("reject_reason"))


def validate(ids: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    names = F.array_join(F.filter(F.array(F.when(blank("message_control_id"), "message_control_id"), F.when(blank("sending_facility"), "sending_facility")), lambda x: x.isNotNull()), ", ")
    return ids.withColumn("reject_reason", F.when(names != "", F.concat(F.lit("blank "), names)))
