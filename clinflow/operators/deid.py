"""De-identification of tables: policies, crosswalks and donors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.functions import scrub
from clinflow.operators.routing import keyed_upsert
from clinflow.sources.readers import row_key

OPERATIONS = ("DE_ID", "ANONYMIZE", "DATE", "NONE")


def field_policy(policy: DataFrame) -> DataFrame:
    """(field, operation) of a policy table; an unknown operation is ANONYMIZE."""
    asked = F.upper(F.trim("operation"))
    return policy.select("field", F.when(asked.isin(*OPERATIONS), asked).otherwise("ANONYMIZE").alias("operation"))


def crosswalk_lookup(df: DataFrame, crosswalk: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Earlier replacements of the same patient, where they are not blank. ``crosswalk`` has row_key and the fields."""
    side = crosswalk.select(F.col("row_key").alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields])
    rows = df.withColumn("_key", row_key(keys)).join(side, "_key", "left")
    return rows.withColumns({f"new_{f}": F.nullif(F.col(f"_{f}"), F.lit("")) for f in fields}).select(*df.columns, *[f"new_{f}" for f in fields])


def random_donor(df: DataFrame, donors: DataFrame, key: str, fields: list[str], salt: str, n: int) -> DataFrame:
    """``new_f``: the field of a donor picked by a keyed hash; never the row's own value. ``donors`` (pos 0..n-1, fields) may grow
    with the patients, so Spark chooses the join by their size."""
    for f in fields:
        first, second = scrub.keyed(salt, F.col(key), F.lit(f), below=n), scrub.keyed(salt + "+", F.col(key), F.lit(f), below=n)
        side = donors.filter(F.trim(F.coalesce(f, F.lit(""))) != "").select("pos", F.col(f).alias("_v"))
        one = side.select(F.col("pos").alias("_p1"), F.col("_v").alias("_v1"))
        two = side.select(F.col("pos").alias("_p2"), F.col("_v").alias("_v2"))
        rows = df.withColumns({"_p1": first, "_p2": second}).join(one, "_p1", "left").join(two, "_p2", "left")
        other = lambda v: F.when(~v.eqNullSafe(F.col(f)), v)  # noqa: B023, E731
        df = rows.withColumn(f"new_{f}", F.coalesce(other(F.col("_v1")), other(F.col("_v2")), scrub.identifier(F.col(f), salt))).drop("_p1", "_p2", "_v1", "_v2")
    return df


def anonymize(df: DataFrame, fields: list[str]) -> DataFrame:
    return df.withColumns({f: F.lit("") for f in fields})


def blank_phones(df: DataFrame, phones: list[str], texts: list[str]) -> DataFrame:
    """Phone fields are blank, and their values go from the texts."""
    parts = scrub.value_parts([F.col(p) for p in phones], 2, [])
    return df.withColumns({t: scrub.scrub_values(F.col(t), parts, "") for t in texts}).withColumns({p: F.lit("") for p in phones})


def apply_policy(df: DataFrame, policy: dict[str, str], salt: str, replaced: dict[str, Column] | None = None) -> DataFrame:
    """Each field by its operation; ``replaced`` has columns for DE_ID fields."""
    out = {}
    for field, operation in policy.items():
        c = F.col(field)
        if operation == "DE_ID":
            out[field] = F.coalesce((replaced or {}).get(field, F.lit(None).cast("string")), scrub.identifier(c, salt))
        elif operation == "DATE":
            out[field] = scrub.date_shift(c)
        elif operation == "ANONYMIZE":
            out[field] = F.lit("")
    return df.withColumns(out)


def per_message(df: DataFrame, key: str, fields: list[str], salt: str) -> DataFrame:
    """All rows of one control id get the same replacement, without state: it is a function of the key."""
    return df.withColumns({f"new_{f}": scrub.keyed(salt, F.col(key), F.lit(f), below=10**9).cast("string") for f in fields})


def write_crosswalk(df: DataFrame, keys: list[str], fields: list[str], ts: str) -> DataFrame:
    """row_key with the latest original and replaced attributes."""
    return keyed_upsert(df, keys, [*fields, *[f"new_{f}" for f in fields]], ts)


def id_map(df: DataFrame, facility: str, ident: str, salt: str) -> DataFrame:
    cols = [F.col(facility), F.col(ident), scrub.facility_code(F.col(facility)), scrub.identifier(F.col(ident), salt)]
    return df.select(F.array_join(F.array(*cols), "|", "").alias("row"))


def file_by_crosswalk(df: DataFrame, crosswalk: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Rows without a match go; a blank replacement is not used."""
    side = crosswalk.select(F.col("row_key").alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields])
    rows = df.withColumn("_key", F.col(key).cast("string")).join(side, "_key")
    return rows.select(*[F.coalesce(F.nullif(F.col(f"_{c}"), F.lit("")), F.col(c)).alias(c) if c in fields else F.col(c) for c in df.columns])


def leak_scan(df: DataFrame, ident: str, text: str) -> DataFrame:
    """(id, kind, match) of everything that looks like an address or a number of a person."""

    def matches(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.struct(F.lit(kind).alias("kind"), m.alias("match")))

    return df.select(ident, F.inline(F.concat(*[matches(k, p) for k, p in scrub.LEAKS.items()])))


def message(df: DataFrame, key: str, policy: dict[str, str], ids: list[str], text: str, salt: str, ts: str) -> dict[str, DataFrame]:
    """The whole chain on rows: fields by policy, values scrubbed from the text; with the crosswalk and the id map."""
    parts = scrub.value_parts([F.col(c) for c in policy if policy[c] != "NONE"], 2, [])
    changed = df.withColumns({f"new_{f}": scrub.identifier(F.col(f), salt) for f in ids})
    crosswalk = write_crosswalk(changed, [key], ids, ts)
    out = apply_policy(df.withColumn(text, scrub.keyword_window(scrub.remove_email_ssn(scrub.scrub_values(F.col(text), parts, "")))), policy, salt)
    return {"rows": out, "crosswalk": crosswalk}
