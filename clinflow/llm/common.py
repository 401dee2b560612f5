"""Shared helpers: tables, the shared folder, and joins whose broadcast side is measured first."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A join side is broadcast up to this many rows and bytes; beyond either Spark joins by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20
#: Rows that go to Python at once where they hold whole texts, at most.
BATCH_ROWS = 1_000


def by_value(module: str) -> None:
    """Send the functions of a module to the workers with the job, so that workers need no copy of this repository."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where it is unset on one machine, as in tests, a new local one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


#: The folders that ``scratch`` has named in this process.
MADE: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    MADE.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return MADE[-1]


def discard(spark: SparkSession, since: int, keep: str) -> None:
    """Delete what ``scratch`` has named from number ``since`` on, but ``keep``; for a run that has written what it needs of them."""
    for path in [p for p in MADE[since:] if p != keep]:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        MADE.remove(path)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def lean(df: DataFrame) -> DataFrame:
    """``df``, whose whole texts go to Python in short batches: the session's batch size is lowered if it is more than BATCH_ROWS.

    A batch stands in the JVM and in the worker several times over, so its size is what a task's memory beside the heap grows with."""
    name, spark = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return df


def spare(df: DataFrame, *stems: str) -> list[str]:
    """A name for each stem that no column of ``df`` has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name = f"__{stem}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df``, quoted so that dots and backticks in names are no paths."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _bytes(value: Column, kind: T.DataType) -> Column:
    """About the bytes of a value in a row of Spark's."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(8) + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.ArrayType):
        return F.lit(24) + F.coalesce(F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + _bytes(x, kind.elementType)), F.lit(0))
    if isinstance(kind, T.StructType):
        return sum((_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(16))
    return F.lit(8)


def measured(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (already cut), marked for broadcast if its rows and bytes are few enough; else as it is, for a shuffle join that AQE can split."""
    each = sum((_bytes(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(8)).cast("long")
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(each).alias("bytes")).first()
    return F.broadcast(df) if found["n"] <= rows and (found["bytes"] or 0) <= size else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
