"""Keyed stores as bucketed, sorted tables: joined without a shuffle of the store, updated by the buckets that a batch touches.

A store is a table in the session's catalog over Parquet files, bucketed and sorted by ``row_key``. Its rows lie in one folder
for each bucket too (``part``, the bucket's number), so that an update reads and replaces only the folders of the keys that it
has. The number of buckets follows the rows: ``grown`` doubles it until a bucket has at most PER_BUCKET rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.sources.readers import row_key

#: Rows of a bucket that call for twice as many buckets.
PER_BUCKET = 4_000_000


@dataclass(frozen=True)
class Store:
    """``attrs``: string columns, each with the time of its last update in ``<attr>_ts``; ``path``: the folder of one generation of files."""

    spark: SparkSession
    name: str
    path: str
    attrs: tuple[str, ...]
    ts: str
    buckets: int

    @property
    def columns(self) -> list[str]:
        return ["row_key", *[c for a in self.attrs for c in (a, f"{a}_ts")]]

    def part(self) -> Column:
        """The bucket of a key, as Spark's writer counts it."""
        return F.pmod(F.hash("row_key"), F.lit(self.buckets))

    def rows(self) -> DataFrame:
        return self.spark.table(self.name).drop("part")

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        """One task for each bucket, so one file."""
        return rows.select(*self.columns, self.part().alias("part")).repartition(self.buckets, "row_key")


def _write(store: Store, rows: DataFrame) -> Store:
    store._laid_out(rows).write.partitionBy("part").bucketBy(store.buckets, "row_key").sortBy("row_key").option("path", store.path).format("parquet").saveAsTable(store.name)
    return store


def merged(df: DataFrame, keys: list[str], attrs: tuple[str, ...], ts: str) -> DataFrame:
    """(row_key, attrs with their times): the latest value of each attribute that is not blank; of equal times the greatest."""
    last = [F.max(F.when(F.coalesce(F.trim(F.col(a)), F.lit("")) != "", F.struct(F.col(ts).alias("at"), F.col(a).alias("v")))).alias(a) for a in attrs]
    return df.groupBy(row_key(keys).alias("row_key")).agg(*last).select("row_key", *[c for a in attrs for c in (F.col(a)["v"].alias(a), F.col(a)["at"].alias(f"{a}_ts"))])


def create(spark: SparkSession, path: str, df: DataFrame, keys: list[str], attrs: list[str], ts: str, buckets: int = 16) -> Store:
    store = Store(spark, f"store_{uuid.uuid4().hex}", f"{path}/generation={uuid.uuid4().hex}", tuple(attrs), ts, buckets)
    return _write(store, merged(df, keys, store.attrs, ts))


def opened(spark: SparkSession, store: Store) -> Store:
    """A store that another session made, by its files."""
    if not spark.catalog.tableExists(store.name):
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.read.parquet(store.path).schema.fields)
        spark.sql(f"CREATE TABLE {store.name} ({kinds}) USING parquet PARTITIONED BY (part) CLUSTERED BY (row_key) SORTED BY (row_key) INTO {store.buckets} BUCKETS LOCATION '{store.path}'")
        spark.sql(f"MSCK REPAIR TABLE {store.name}")
    return replace(store, spark=spark)


def upsert(store: Store, df: DataFrame, keys: list[str]) -> Store:
    """``df``'s values go over the store's, attribute by attribute, where they are later and not blank. Only touched buckets are read and written."""
    new = merged(df, keys, store.attrs, store.ts).withColumn("part", store.part()).checkpoint()
    touched = [r.part for r in new.select("part").distinct().collect()]  # as many as there are buckets at most
    old = store.spark.table(store.name).filter(F.col("part").isin(touched)).drop("part")
    side = new.select("row_key", *[F.col(c).alias(f"new_{c}") for c in store.columns[1:]])
    both = old.join(side, "row_key", "full_outer")

    def last(a: str) -> Column:
        held = [F.when(F.col(f"{p}{a}").isNotNull(), F.struct(F.col(f"{p}{a}_ts").alias("at"), F.col(f"{p}{a}").alias("v"))) for p in ("", "new_")]
        return F.greatest(*held)

    rows = both.select("row_key", *[last(a).alias(a) for a in store.attrs])
    rows = rows.select("row_key", *[c for a in store.attrs for c in (F.col(a)["v"].alias(a), F.col(a)["at"].alias(f"{a}_ts"))]).checkpoint()  # it is read from what it replaces
    name = "spark.sql.sources.partitionOverwriteMode"  # a table's insert takes it from the session alone
    before = store.spark.conf.get(name)
    store.spark.conf.set(name, "dynamic")
    try:
        store._laid_out(rows).write.mode("overwrite").insertInto(store.name)
    finally:
        store.spark.conf.set(name, before)
    return store


def grown(store: Store, per_bucket: int = PER_BUCKET) -> Store:
    """The store, or one with twice the buckets (and twice again) where a bucket has more than ``per_bucket`` rows; the old files stay until they are dropped."""
    fullest = store.spark.table(store.name).groupBy("part").count().agg(F.max("count")).first()[0] or 0
    buckets = store.buckets
    while fullest > per_bucket:
        buckets, fullest = buckets * 2, -(-fullest // 2)
    if buckets == store.buckets:
        return store
    base = store.path.rsplit("/", 1)[0]
    return _write(replace(store, name=f"store_{uuid.uuid4().hex}", path=f"{base}/generation={uuid.uuid4().hex}", buckets=buckets), store.rows())


def lookup(df: DataFrame, store: Store, keys: list[str], attrs: list[str] | None = None) -> DataFrame:
    """``df`` with found_* columns of the store; the store's side is read as it lies."""
    attrs = attrs or list(store.attrs)
    side = store.rows().select(F.col("row_key").alias("_key"), *[F.col(a).alias(f"found_{a}") for a in attrs])
    keyed = df.withColumn("_key", row_key(keys)).repartition(store.buckets, "_key")  # as the store's buckets
    return keyed.join(side.hint("merge"), "_key", "left").drop("_key")


def drop(store: Store) -> None:
    """Take the table out of the catalog; its files stay where they are."""
    store.spark.sql(f"DROP TABLE IF EXISTS {store.name}")
