"""A message's JSON, segment rows and named values, made where the message lies, in Arrow batches.

What ``parse.elements``, ``naming.name_elements``, ``naming.to_json`` and ``segments.fan_out`` make of rows of elements, empty parts
left out, is made here message by message: nothing is exploded, joined or grouped, so no element is ever shuffled, sorted or spilled.
The templates, models and crosswalk are configuration, which each task holds; only fields that they name are cut.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from clinflow.operators.naming import said

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters that JSON escapes, as Spark writes them.
ESCAPES = {i: f"\\u{i:04X}" for i in range(32)} | {ord(c): f"\\{e}" for c, e in zip('"\\\b\f\n\r\t', '"\\bfnrt', strict=True)}
ESCAPED = re.compile(r'["\\\x00-\x1f]')
#: Resolved names that a worker keeps, for each source, facility, template and segment.
KEPT = 50_000
MADE = "json string, rows array<struct<seg: string, seg_seq: int, row: string>>, values array<struct<seg_seq: int, seg: string, name: string, field: int, rep: int, comp: int, sub: int, value: string>>"
ROW = pa.struct([("seg", pa.string()), ("seg_seq", pa.int32()), ("row", pa.string())])
VALUE = pa.struct([(n, pa.string() if n in ("seg", "name", "value") else pa.int32()) for n in ("seg_seq", "seg", "name", "field", "rep", "comp", "sub", "value")])


def _quoted(text: str) -> str:
    return f'"{text.translate(ESCAPES) if ESCAPED.search(text) else text}"'


class Asked:
    """What templates, models (type, seg, pos, path) and rules (see ``parse.split_components``) ask of messages; all are config.

    ``told``: by type, the names of which a message's values are handed on."""

    def __init__(self, templates: DataFrame, models: DataFrame, rules: DataFrame | None = None, told: dict[str, set[str]] | None = None):
        self.names: dict[str, dict[int, list]] = {}
        self.models: dict[tuple[str, str], tuple[dict, list]] = {}
        self.rules = {(r.tpl, r.seg, r.field): (r.option, r.to_comp) for r in (rules.collect() if rules is not None else ())}
        self.told = told or {}
        fields: dict[str, set[int]] = {}
        for key, what in said(templates).select("elem_key", "said").collect():
            for sub in ("()", r"\.([1-9]\d{0,8})"):  # sub-components have names of their own only where a rule has moved them
                if found := re.fullmatch(r"(.{0,3})\.([1-9]\d{0,8})\.([1-9]\d{0,8})" + sub, key or "", re.DOTALL):
                    at = (int(found[3]), int(found[4]) if found[4] else None)
                    self.names.setdefault(found[1], {}).setdefault(int(found[2]), []).append((at, what))
                    fields.setdefault(found[1], set()).add(int(found[2]))
        places: dict[tuple[str, str], set] = {}
        for kind, seg, pos, path in models.select("type", "seg", "pos", "path").collect():
            places.setdefault((kind, seg), set()).add((pos, path))
        for (kind, seg), of in places.items():
            by_field: dict[int, tuple[set, list]] = {}
            for field, deep, below in (path.partition("|") for _, path in of):
                if re.fullmatch(r"[1-9]\d{0,8}", field):
                    comps, whole = by_field.setdefault(int(field), (set(), []))
                    comps.add(below) if deep else whole.append(True)
            self.models[kind, seg] = (by_field, [path for _, path in sorted(of)])
            fields.setdefault(seg, set()).update(by_field)
        self.fields = {seg: sorted(of) for seg, of in fields.items()}
        self.resolved: dict[tuple, dict] = {}

    def _named(self, src: str | None, fac: str | None, tpl: str | None, seg: str) -> dict[int, dict]:
        """Names of a segment's fields, by (component, sub-component if moved); precedence as in ``naming.name_elements``."""
        key = (src, fac, tpl, seg)
        if key not in self.resolved:
            if len(self.resolved) >= KEPT:
                self.resolved.clear()
            levels = [f"ALIGN:{src}" if src is not None else None, f"FAC:{fac}" if fac is not None else None, tpl, "STD"]
            moved = [f"ALIGN:{tpl}" if tpl is not None else None, *levels]
            one = lambda at, what: next((what[k] for k in (levels if at[1] is None else moved) if k is not None and k in what), "unknown")
            of = {field: {at: one(at, what) for at, what in entries} for field, entries in self.names.get(seg, {}).items()}
            self.resolved[key] = {field: known for field, names in of.items() if (known := {at: n for at, n in names.items() if n != "unknown"})}
        return self.resolved[key]

    def _elements(self, text: str, seg: str, field: int, tpl: str | None) -> Iterable[tuple]:
        """(rep, comp, sub, moved, value) of a field that has a text, in order; empty ones too."""
        if "^" not in text or (seg == "MSH" and field in (1, 2)):
            return [(1, 1, 1, False, text)]
        reps = [r for r in text.split("~") if "^" in r] if "~" in text and not (seg == "OBX" and field == 5) else [text]
        option, to = self.rules.get((tpl, seg, field), (None, None))
        if option == "merge":
            return [(i, 1, 1, False, r.replace("^", "")) for i, r in enumerate(reps, 1)]
        if option == "move":
            return [(i, to, k, True, v) for i, r in enumerate(reps, 1) for k, v in enumerate(r.replace("^", "&").split("&"), 1)]
        return [(i, j, k, False, v) for i, r in enumerate(reps, 1) for j, c in enumerate(r.split("^"), 1) if c for k, v in enumerate(c.split("&") if "&" in c else (c,), 1)]

    @staticmethod
    def _path(field: int, comp: int, of: tuple[set, list]) -> str | None:
        """See ``segments.parent_fallback``."""
        comps, whole = of
        if comp is not None and str(comp) in comps:
            return f"{field}|{comp}"
        return str(field) if (comp == 1 and whole) or len(comps) > 1 else None

    def made(self, raw: str, own: dict | None, kind: str | None, src: str | None, fac: str | None, tpl: str | None) -> tuple[str | None, list, list]:
        """JSON (None if nothing has a name), rows and values of a message."""
        bodies: dict[str, list[str]] = {}
        rows, values, told = [], [], self.told.get(kind, ())
        there = str.maketrans(own["sent"], own["usual"]) if own else None
        back = str.maketrans(own["usual"], own["sent"]) if own else None
        for seg_seq, line in enumerate(raw.split("\r\n" if "\r\n" in raw else "\n"), 1):
            seg = line[:3]
            if not line or seg not in self.fields:
                continue
            parts = (line.translate(there) if there else line).rstrip("|").split("|")
            shift = seg == "MSH"  # its first field is the separator
            names, (modelled, paths) = self._named(src, fac, tpl, seg), self.models.get((kind, seg), ({}, ()))
            by_name: dict[str, list] = {}
            by_path: dict[str, list[str]] = {}
            for field in self.fields[seg]:
                text = "|" if shift and field == 1 else parts[field - shift] if field - shift < len(parts) else ""
                if not text:
                    continue
                at, of = names.get(field), modelled.get(field)
                if at is None and of is None:
                    continue
                for rep, comp, sub, moved, value in self._elements(text, seg, field, tpl):
                    if not value:
                        continue
                    if back:
                        value = value.translate(back)
                    if at is not None and (name := at.get((comp, sub if moved else None))) is not None:
                        by_name.setdefault(name, [field]).append(value)
                        if name in told:
                            values.append((seg_seq, seg, name, field, rep, comp, sub, value))
                    if of is not None and (path := self._path(field, comp, of)) is not None:
                        by_path.setdefault(path, []).append(value)
            if by_name:
                members = sorted((v[0], name, _quoted(v[1]) if len(v) == 2 else f"[{','.join(map(_quoted, v[1:]))}]") for name, v in by_name.items())
                bodies.setdefault(seg, []).append("{" + ",".join(f'"{name}":{j}' for _, name, j in members) + "}")
            if by_path:
                rows.append((seg, seg_seq, "|".join("^".join(by_path.get(p, ())) for p in paths)))
        text = ",".join(f'"{seg}":' + (b[0] if len(b) == 1 else f"[{','.join(b)}]") for seg, b in bodies.items())
        return ("{" + text + "}" if bodies else None), rows, values


def _listed(of: list[list[tuple]], kind: pa.StructType) -> pa.ListArray:
    flat = [x for one in of for x in one]
    offsets = [0]
    for one in of:
        offsets.append(offsets[-1] + len(one))
    columns = list(zip(*flat, strict=True)) if flat else [[] for _ in kind]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(arrays, fields=list(kind)))


def made(messages: DataFrame, asked: Asked, keep: list[str]) -> DataFrame:
    """``keep`` and json, rows, values of messages (raw, own, type, src, fac, tpl); a message without a text (raw is NULL) has none."""
    read = ["raw", "own", "type", "src", "fac", "tpl"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns = [part.column(part.schema.get_field_index(f"_{c}")).to_pylist() for c in read]
            found = [asked.made(*x) if x[0] is not None else (None, [], []) for x in zip(*columns, strict=True)]
            arrays = [pa.array([x[0] for x in found], pa.string()), _listed([x[1] for x in found], ROW), _listed([x[2] for x in found], VALUE)]
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), *arrays], [*keep, "json", "rows", "values"])

    kept = messages.select(*keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), MADE])
    return messages.select(*keep, *[messages[c].alias(f"_{c}") for c in read]).mapInArrow(batches, schema)
