"""De-identification of columns and free text. Random choices are keyed hashes: one input, key and salt give one result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def keyed(salt: str, *cols: Column, below: int) -> Column:
    """A number from 48 bits of a SHA-256 over the salt and the values, so that replacements don't tell the values."""
    text = F.concat_ws("\x1f", F.lit(salt), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 12), 16, 10).cast("long") % F.lit(below)


def identifier(c: Column, salt: str) -> Column:
    """Digits stay, other characters become digits; blank stays blank."""
    return F.array_join(F.transform(chars(c), lambda x, i: F.when(x.rlike("[0-9]"), x).otherwise(keyed(salt, c, i, below=10).cast("string"))), "")


def ssn_jitter(c: Column, salt: str) -> Column:
    """0 to 8 is added to a digit where that stays one digit."""

    def one(x: Column, i: Column) -> Column:
        moved = x.try_cast("int") + keyed(salt, c, i, below=9)
        return F.when(x.rlike("[0-9]") & (moved < 10), moved.cast("string")).otherwise(x)

    return F.array_join(F.transform(chars(c), one), "")


def facility_code(c: Column, turn: int = 9) -> Column:
    """Characters in falling order, turned right by nine; '.' is NOFAC."""
    falling = F.array_sort(chars(c), lambda a, b: F.when(a > b, -1).when(a < b, 1).otherwise(0))
    n = F.size(falling)
    k = F.when(n > 0, F.pmod(F.lit(turn), n)).otherwise(0)
    turned = F.when(k == 0, falling).otherwise(F.concat(F.slice(falling, n - k + 1, k), F.slice(falling, F.lit(1), n - k)))
    return F.when(c == ".", "NOFAC").otherwise(F.array_join(turned, ""))


def control_id(c: Column, facility: Column) -> Column:
    return F.when(facility != "", F.replace(c, facility, facility_code(facility))).otherwise(c)


SHIFT = "interval 1 day 6 hours 14 minutes"


def date_shift(c: Column) -> Column:
    """Earlier by 1 day 6 h 14 min, later by 44 s, in the input's own precision; what is no date keeps its first eight characters."""
    n = F.length(c)
    moved = lambda ts: ts - F.expr(SHIFT) + F.expr("interval 44 seconds")
    parsed = lambda fmt, text: moved(F.try_to_timestamp(text, F.lit(fmt)))
    whole = F.date_format(parsed("yyyyMMddHHmmss", c), "yyyyMMddHHmmss")
    minutes = F.date_format(parsed("yyyyMMddHHmm", F.rpad(c, 12, "0")), "yyyyMMddHHmm")
    day = F.date_format(parsed("yyyyMMdd", F.substring(c, 1, 8)), "yyyyMMdd")
    found = F.when(n == 14, whole).when(n.between(9, 12), minutes).otherwise(day)
    return F.coalesce(found, F.when(n >= 8, F.substring(c, 1, 8)).otherwise(c))


def birth_date(c: Column, key: Column, salt: str, as_of: Column, oldest: int = 89) -> Column:
    """Over 89 years is 89; then up to 11 months and 27 days earlier, by key."""
    born = F.try_to_date(F.substring(c, 1, 8), "yyyyMMdd")
    born = F.greatest(born, F.add_months(as_of, -12 * oldest))
    moved = F.date_sub(F.add_months(born, -keyed(salt, key, F.lit("m"), below=12).cast("int")), keyed(salt, key, F.lit("d"), below=28).cast("int"))
    return F.date_format(moved, "yyyyMMdd")


def value_parts(values: list[Column], least: int, stop: list[str]) -> Column:
    """The parts of values that are to be scrubbed, longest first so that no part of another is replaced before it."""
    parts = F.flatten(F.array(*[F.split(F.coalesce(v, F.lit("")), r"[\^&]", -1) for v in values]))
    kept = F.array_distinct(F.filter(parts, lambda p: (F.length(p) > least) & ~p.isin(*stop)))
    return F.array_sort(kept, lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0))


def scrub_values(text: Column, parts: Column, replacement: str) -> Column:
    return F.aggregate(parts, text, lambda t, p: F.replace(t, p, F.lit(replacement)))


def name_variants(text: Column, first: Column, last: Column, replacement: str) -> Column:
    """Both orders of a name, as written, in lower, upper and initial capitals."""
    orders = [F.concat_ws(" ", first, last), F.concat_ws(" ", last, first), F.concat_ws(", ", last, first)]
    forms = [f(o) for o in orders for f in (lambda x: x, F.lower, F.upper, F.initcap)]
    guard = (F.length(first) > 0) & (F.length(last) > 0)
    return F.when(guard, reduce(lambda t, v: F.replace(t, v, F.lit(replacement)), forms, text)).otherwise(text)


#: Fixed values: (keyword, characters from its start, times).
WINDOWS = (("DOB", 20, 1), ("D.O.B.", 20, 1), ("AGE/SX", 18, 1), ("AGE", 10, 1), ("SEX", 10, 1), ("SX", 10, 1), ("Signed", 80, 3), ("signed", 30, 3))


def keyword_window(text: Column, windows: tuple[tuple[str, int, int], ...] = WINDOWS) -> Column:
    """Cut the characters from a keyword on, wherever they occur; nothing where the text is too short."""
    rules = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(n).alias("n")) for w, n, times in windows for _ in range(times)])

    def cut(t: Column, rule: Column) -> Column:
        at = F.position(rule["word"], t)
        fits = (at > 0) & (at + rule["n"] - 1 <= F.length(t))
        return F.when(fits, F.replace(t, F.substring(t, at, rule["n"]), F.lit(""))).otherwise(t)

    return F.aggregate(rules, text, cut)


#: What free text loses, and what the leak scan takes for an address.
ADDRESS, SSN = r"[a-zA-Z0-9.-]+@[a-zA-Z0-9.-]+\.[a-zA-Z0-9.-]+", r"\s[0-9]{3}[-][0-9]{2}[-][0-9]{4}\s"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,6}"


def remove_email_ssn(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, ADDRESS, ""), SSN, " ")


def state_once(text: Column, old: Column, new: Column) -> Column:
    at = F.when(F.length(old) > 1, F.position(old, text)).otherwise(0)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), new, F.substring(text, at + F.length(old), F.length(text)))).otherwise(text)


#: What a leak is, by kind.
LEAKS = {
    "email": EMAIL,
    "ssn_dash": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ssn_blank": r"(?<![0-9 ])[0-9]{3} [0-9]{2} [0-9]{4}(?![0-9])",
    "phone_paren": r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}",
    "phone_dash": r"(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])",
    "phone_dot": r"(?<![0-9.])[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?![0-9.])",
    "phone_plain": r"(?<![0-9])[0-9]{10}(?![0-9])",
}
