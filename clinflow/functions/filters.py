"""Extract filters as columns. ``compat`` keeps the older, reversed order tests (literal against value)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equal(v: Column, x: str) -> Column:
    return v == x


def not_equal(v: Column, x: str) -> Column:
    return v != x


def contains(v: Column, x: str) -> Column:
    return F.contains(v, F.lit(x))


def starts_with(v: Column, x: str) -> Column:
    return v.startswith(x)


def equal_ignore_case(v: Column, x: str) -> Column:
    return F.lower(v) == x.lower()


def gt(v: Column, x: str, compat: bool = False) -> Column:
    return v < x if compat else v > x


def lt(v: Column, x: str, compat: bool = False) -> Column:
    return v > x if compat else v < x


def gte(v: Column, x: str, compat: bool = False) -> Column:
    return v <= x if compat else v >= x


def lte(v: Column, x: str, compat: bool = False) -> Column:
    return v >= x if compat else v <= x


def is_in(v: Column, xs: str | list[str]) -> Column:
    return v.isin(xs.split(":") if isinstance(xs, str) else xs)


def between(v: Column, low: str, high: str, compat: bool = False) -> Column:
    return (v < low) & (v > high) if compat else (v > low) & (v < high)


CONDITIONS = {"EQUAL": equal, "COMPARE": equal, "NOTEQUAL": not_equal, "CONTAINS": contains, "STARTSWITH": starts_with, "EQUALIGNORECASE": equal_ignore_case, "GT": gt, "LT": lt, "GTE": gte, "LTE": lte, "IN": is_in}
ORDERED = {"GT", "LT", "GTE", "LTE"}


@dataclass(frozen=True)
class Filter:
    segment: str
    path: str
    literal: str
    condition: str
    joiner: str = "NONE"
    values: str = ""


def condition(f: Filter, v: Column, compat: bool = False) -> Column:
    """A filter on a value; a missing value does not pass."""
    if f.condition == "BETWEEN":
        found = between(v, *f.values.split(":")[:2], compat=compat)
    elif f.condition == "IN":
        found = is_in(v, f.values)
    elif f.condition in ORDERED:
        found = CONDITIONS[f.condition](v, f.literal, compat)
    else:
        found = CONDITIONS[f.condition](v, f.literal)
    return F.coalesce(found, F.lit(False))


def _join(a: Column, how: str, b: Column) -> Column:
    return a & b if how == "AND" else a | b


def expression(filters: list[Filter], found: list[Column]) -> Column:
    """Filters in pairs, from the left: (f0 j0 f1) j1 (f2 j2 f3) ...; NONE inside a pair keeps the right side, between pairs it is an error."""
    out, how = None, ""
    for k in range(0, len(filters), 2):
        side = found[k]
        if k + 1 < len(filters):
            side = found[k + 1] if filters[k].joiner == "NONE" else _join(side, filters[k].joiner, found[k + 1])
        if out is None:
            out = side
        elif how == "NONE":
            raise ValueError("filters before a later pair need AND or OR")
        else:
            out = _join(out, how, side)
        how = filters[min(k + 1, len(filters) - 1)].joiner
    return F.lit(True) if out is None else out


def nested_path(named: DataFrame, seg: str, name: str) -> DataFrame:
    """(msg_id, seg_seq, value) of a name in a segment; of a repeated field the last repetition that has it."""
    rows = named.filter((F.col("seg") == seg) & (F.col("name") == name) & F.col("value").isNotNull())
    return rows.groupBy("msg_id", "seg_seq").agg(F.max_by("value", F.struct("rep", "comp", "sub")).alias("value"))


def apply(named: DataFrame, filters: list[Filter], compat: bool = False) -> DataFrame:
    """(msg_id, passed): a filter holds if any segment of its name fits. One grouping by message for all filters."""
    values = {(f.segment, f.path) for f in filters}
    rows = named.filter("value is not null").groupBy("msg_id", "seg", "seg_seq").agg(
        *[F.max_by(F.col("value"), F.when((F.col("seg") == s) & (F.col("name") == p), F.struct("rep", "comp", "sub"))).alias(f"v{i}") for i, (s, p) in enumerate(sorted(values))]
    )
    at = {k: i for i, k in enumerate(sorted(values))}
    hits = rows.groupBy("msg_id").agg(*[F.bool_or((F.col("seg") == f.segment) & condition(f, F.col(f"v{at[f.segment, f.path]}"), compat)).alias(f"h{k}") for k, f in enumerate(filters)])
    return hits.select("msg_id", expression(filters, [F.coalesce(f"h{k}", F.lit(False)) for k in range(len(filters))]).alias("passed"))
