"""Field operations of extracts: columns in, columns out. Lists are ``^``-joined texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def items(c: Column | str) -> Column:
    return F.split(F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit("")), r"\^", -1)


def first_value(df: DataFrame, cols: list[str]) -> DataFrame:
    """The first part that is not blank."""
    first = lambda c: F.coalesce(F.get(F.filter(items(c), lambda x: F.trim(x) != ""), F.lit(0)), F.lit(""))
    return df.withColumns({c: first(c) for c in cols})


def rename(df: DataFrame, spec: list[tuple[str, str]], keep: tuple[str, ...] = ("msg_id",)) -> DataFrame:
    """Ordered (source, target): an unknown source is ''; sources of one target are concatenated; ``a&b`` takes the first that is not empty."""
    targets: dict[str, list[Column]] = {}
    for source, target in spec:
        alternatives = [F.col(s) if s in df.columns else F.lit("") for s in source.split("&")]
        targets.setdefault(target, []).append(multi_source(alternatives))
    return df.select(*keep, *[F.concat(*cs).alias(t) for t, cs in targets.items()])


def multi_source(cols: list[Column]) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def select_by_code(df: DataFrame, codes: str, code: str, values: str, target: str, drop: bool) -> DataFrame:
    """Parallel lists: the value where the other list has the code; of several the last."""
    pairs = F.arrays_zip(items(codes).alias("c"), items(values).alias("v"))
    found = F.try_element_at(F.filter(pairs, lambda z: z["c"] == code), F.lit(-1))["v"]
    out = df.withColumn(target, F.coalesce(found, F.lit("")))
    return out.drop(*[c for c in (codes, values) if c != target]) if drop else out


def combine(df: DataFrame, inputs: list[str], target: str, delim: str, action: str) -> DataFrame:
    if action not in ("KEEP", "DELETE"):
        raise ValueError(f"unknown action {action}")
    out = df.withColumn(target, F.array_join(F.array(*[F.coalesce(c, F.lit("")) for c in inputs]), delim))
    return out.drop(*[c for c in inputs if c != target]) if action == "DELETE" else out


def blank_if_contains(df: DataFrame, field: str, literal: str, replacement: str = "") -> DataFrame:
    return df.withColumn(field, F.when(F.contains(F.lower(field), F.lit(literal.lower())), replacement).otherwise(F.col(field)))


def static_map(df: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(field, code, value) in order: a blank field, or one that equals the code, is set."""
    for field in dict.fromkeys(r[0] for r in rules):
        own = [r for r in rules if r[0] == field]
        fold = reduce(lambda c, r: F.when((F.coalesce(F.trim(c), F.lit("")) == "") | (c == r[1]), r[2]).otherwise(c), own, F.col(field))
        df = df.withColumn(field, fold)
    return df


def pipeline(df: DataFrame, steps: list) -> DataFrame:
    return reduce(lambda d, step: d.transform(step), steps, df)


#: Named DataFrame functions that a configuration may ask for.
TRANSFORMS: dict = {}


def custom_transform(name: str):
    """Register a DataFrame function under a name."""

    def put(f):
        TRANSFORMS[name] = f
        return f

    return put
