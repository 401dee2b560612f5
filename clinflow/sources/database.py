"""Databases: reading a query by ranges of a key, and loading rows so that the refused ones alone are kept back.

``jdbc_ranges`` reads through Spark's JDBC source. Where a driver of Python's own database interface (DB-API) is at hand,
``ranges`` reads the same way through a Spark data source, and ``load`` writes: a task sends batches, each in one transaction;
a batch that the database refuses is halved behind savepoints until the refused rows stand alone, so k bad rows of n cost about
k log2 n statements, but no transaction more. ``connect`` makes a connection inside a task; it goes to the workers with the job.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a range, ranges at most (each is a connection), rows of a batch.
PER_RANGE, RANGES, BATCH = 100_000, 64, 1000
#: The table that says which batches of a load are there; it is written in the batch's own transaction.
LEDGER = "load_ledger"
Connect = Callable[[], object]


def jdbc_ranges(spark: SparkSession, url: str, query: str, key: str, per_range: int = PER_RANGE, ranges: int = RANGES, **options: str) -> DataFrame:
    """``query`` read by ranges of a numeric or date ``key`` at the same time; one query finds count and bounds. Rows without a key are in the first range."""
    source = f"({query}) q"
    quoted = f'"{key}"'
    bounds = f"SELECT COUNT(*) AS n, MIN({quoted}) AS least, MAX({quoted}) AS most FROM {source}"
    n, least, most = spark.read.format("jdbc").options(url=url, query=bounds, **options).load().first()
    if not n or least is None or least == most:
        return spark.read.format("jdbc").options(url=url, dbtable=source, **options).load()
    parts = min(max(1, -(-n // per_range)), ranges)
    return spark.read.format("jdbc").options(url=url, dbtable=source, partitionColumn=quoted, lowerBound=str(least), upperBound=str(most), numPartitions=str(parts), **options).load()


@dataclass
class KeyRange(InputPartition):
    """Keys from ``low`` to below ``high`` (None: no bound); ``nulls``: and those without a key."""

    low: object
    high: object
    nulls: bool


def cuts(least, most, parts: int) -> list[KeyRange]:
    """Ranges of equal width that hold every key once; the outer ones are open, the first has the null keys."""
    step = (most - least) / parts
    inner = [least + (type(least)(step * k) if isinstance(least, int) else step * k) for k in range(1, parts)]
    inner = sorted({x for x in inner if least < x <= most})
    edges = [None, *inner, None]
    return [KeyRange(a, b, k == 0) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]


def where(part: KeyRange, key: str, mark: str) -> tuple[str, list]:
    """Condition and values of a range; ``mark``: how the driver marks a value."""
    said, values = [], []
    for bound, sign in ((part.low, ">="), (part.high, "<")):
        if bound is not None:
            said.append(f"{key} {sign} {mark}")
            values.append(bound)
    text = " AND ".join(said) or f"{key} IS NOT NULL"
    return (f"({text}) OR {key} IS NULL" if part.nulls else text), values


def _source(connect: Connect, query: str, key: str, parts: list[KeyRange], mark: str, kind: T.StructType) -> type[DataSource]:
    class Ranges(DataSourceReader):
        def partitions(self) -> list[KeyRange]:
            return parts

        def read(self, partition: KeyRange) -> Iterator[tuple]:
            said, values = where(partition, key, mark)
            connection = connect()
            try:
                cursor = connection.cursor()
                cursor.execute(f"SELECT * FROM ({query}) q WHERE {said}", values)
                while rows := cursor.fetchmany(BATCH):
                    yield from map(tuple, rows)
            finally:
                connection.close()

    class Database(DataSource):
        @classmethod
        def name(cls) -> str:
            return f"database_{uuid.uuid5(uuid.NAMESPACE_OID, query).hex}"

        def schema(self) -> T.StructType:
            return kind

        def reader(self, schema: T.StructType) -> Ranges:
            return Ranges()

    return Database


def ranges(spark: SparkSession, connect: Connect, query: str, schema: str, key: str, per_range: int = PER_RANGE, most: int = RANGES, mark: str = "?") -> DataFrame:
    """``query`` of a DB-API database, read by ranges of a numeric ``key`` at the same time; rows come in batches."""
    connection = connect()
    try:
        cursor = connection.cursor()
        cursor.execute(f"SELECT COUNT(*), MIN({key}), MAX({key}) FROM ({query}) q")
        n, least, highest = cursor.fetchone()
    finally:
        connection.close()
    parts = [KeyRange(None, None, True)] if least is None else cuts(least, highest, min(max(1, -(-n // per_range)), most))
    kind = spark.createDataFrame([], schema).schema
    source = _source(connect, query, key, parts, mark, kind)
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load()


def _send(connection, statement: str, rows: list[tuple], mark: str, entry: tuple) -> list[tuple[tuple, str]]:
    """Rows that the database refuses, with its words; the others are there when this returns.

    ``entry`` (load, part, batch) and one like it for each refused row (its place after the batch) go with the rows in one transaction.
    Where the entry is there, an attempt before this one has sent them, and only the refused rows are tried again, for the database's words.
    What is refused is found by halves, each behind a savepoint."""
    cursor = connection.cursor()
    load, part, batch = entry
    place = f"load_id = {mark} AND part = {mark} AND batch"
    note = f"INSERT INTO {LEDGER} VALUES ({mark}, {mark}, {mark})"
    bad: list[tuple[tuple, str]] = []

    def put(low: int, high: int) -> None:
        cursor.execute("SAVEPOINT part_of_batch")
        try:
            cursor.executemany(statement, rows[low:high])
        except Exception as error:
            if not refused(error):
                raise  # the database is not there: the task is tried again
            cursor.execute("ROLLBACK TO SAVEPOINT part_of_batch")
            if high - low > 1:
                put(low, (low + high) // 2)
                put((low + high) // 2, high)
            else:
                bad.append((rows[low], str(error)))
                cursor.execute(note, (load, part, f"{batch}!{low}"))

    try:
        cursor.execute(f"SELECT COUNT(*) FROM {LEDGER} WHERE {place} = {mark}", entry)
        if cursor.fetchone()[0]:
            cursor.execute(f"SELECT batch FROM {LEDGER} WHERE {place} LIKE {mark}", (load, part, f"{batch}!%"))
            for k in sorted(int(name.rpartition("!")[2]) for (name,) in cursor.fetchall()):
                cursor.execute(f"DELETE FROM {LEDGER} WHERE {place} = {mark}", (load, part, f"{batch}!{k}"))
                put(k, k + 1)
        else:
            cursor.execute(note, entry)  # opens the transaction that the savepoints stand in
            put(0, len(rows))
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    return bad


def refused(error: Exception) -> bool:
    """Whether the database refuses the rows (integrity, data, wrong use), not the connection."""
    return any(c.__name__ in ("IntegrityError", "DataError", "ProgrammingError", "InterfaceError") for c in type(error).__mro__)


def load(df: DataFrame, connect: Connect, table: str, staging: str, failed: str, batch: int = BATCH, writers: int = 8, mark: str = "?") -> int:
    """Append ``df`` to ``table``; the rows that it refuses are kept as parquet in ``failed`` with the column ``refusal``; how many these are.

    The rows are first written to ``staging`` (a shared folder), so that a repeated task sends the same batches and the
    ledger tells it which of them are there: each good row lands once. ``writers``: connections at the same time, about."""
    spark, names = df.sparkSession, df.columns
    df.repartition(writers).write.mode("overwrite").parquet(staging)
    rows = spark.read.schema(df.schema).parquet(staging)
    load_id = uuid.uuid4().hex
    connection = connect()
    try:
        connection.cursor().execute(f"CREATE TABLE IF NOT EXISTS {LEDGER} (load_id VARCHAR(32), part VARCHAR(400), batch VARCHAR(80), PRIMARY KEY (load_id, part, batch))")
        connection.commit()
    finally:
        connection.close()
    statement = f"INSERT INTO {table} ({', '.join(names)}) VALUES ({', '.join([mark] * len(names))})"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        connection = connect()
        try:
            for found in batches:
                sent = found.to_pylist()
                for b in range(0, len(sent), batch):
                    part = sent[b : b + batch]
                    # a batch is named by its task and the place of its first row, which no repetition changes
                    entry = (load_id, str(part[0]["__part"]), str(part[0]["__at"]))
                    bad = _send(connection, statement, [tuple(r[n] for n in names) for r in part], mark, entry)
                    if bad:
                        kind = pa.schema([*(found.schema.field(n) for n in names), pa.field("refusal", pa.string())])
                        yield pa.RecordBatch.from_pylist([dict(zip([*names, "refusal"], [*v, error], strict=True)) for v, error in bad], kind)
        finally:
            connection.close()

    placed = rows.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at"))
    kept = T.StructType([*df.schema.fields, T.StructField("refusal", T.StringType())])
    placed.mapInArrow(send, kept).write.mode("append").parquet(failed)
    return spark.read.schema(kept).parquet(failed).count()
