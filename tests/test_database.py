"""Reading by key ranges and loading with refused rows kept back."""

import datetime
import sqlite3
from collections import Counter
from contextlib import closing
from functools import partial

import pytest

from clinflow.sources import database as D
from clinflow.sources import sinks
from clinflow.sources.synth import table

SF = "/root/testdata/sf0.001"


def made(tmp_path, ddl):
    connect = partial(sqlite3.connect, f"{tmp_path}/rows.db", timeout=120)
    with closing(connect()) as c:
        c.execute(ddl)
        c.commit()
    return connect


def rows_of(connect, sql):
    with closing(connect()) as c:
        return c.execute(sql).fetchall()


def test_jdbc_by_ranges(spark, tmp_path):
    url, options = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = table(spark, SF, "customer").selectExpr("CASE WHEN c_custkey % 7 > 0 THEN c_custkey END AS k", "c_acctbal")
    sinks.jdbc_batch(rows, url, "customers", 10, **options)
    got = D.jdbc_ranges(spark, url, 'SELECT "k", "c_acctbal" FROM customers', "k", per_range=20, ranges=6, **options)
    assert got.rdd.getNumPartitions() == 6 and got.exceptAll(rows).isEmpty() and rows.exceptAll(got).isEmpty()
    per_range = got.rdd.mapPartitionsWithIndex(lambda k, part: [(k, sum(r.k is None for r in part))]).collect()
    assert [n > 0 for _, n in sorted(per_range)] == [True] + [False] * 5  # rows without a key are in the first
    empty = D.jdbc_ranges(spark, url, 'SELECT "k" FROM customers WHERE "k" < 0', "k", **options)
    assert empty.count() == 0


@pytest.mark.parametrize("least, most, parts", [(0, 100, 7), (-5, 5, 3), (1, 2, 8), (3, 3, 4), (0.5, 9.25, 5), (-(2**62), 2**62, 6)])
def test_ranges_hold_every_key_once(least, most, parts):
    found = D.cuts(least, most, parts)
    assert 1 <= len(found) <= parts and found[0].nulls and not any(p.nulls for p in found[1:])
    keys = [least, most, (least + most) / 2, *(p.low for p in found if p.low is not None)]
    for k in keys:
        assert sum((p.low is None or k >= p.low) and (p.high is None or k < p.high) for p in found) == 1


def test_a_load_keeps_the_refused_rows_alone(spark, tmp_path):
    connect = made(tmp_path, "CREATE TABLE t (id INTEGER PRIMARY KEY, v TEXT NOT NULL, w REAL CHECK (w < 100))")
    bad = {17, 18, 400, 999, 1500}
    data = [(i, None if i in (17, 400) else f"v{i}", 100.0 if i in bad - {17, 400} else 1.5) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, v string, w double")
    base = f"file://{tmp_path}"
    assert D.load(df, connect, "t", f"{base}/staging", f"{base}/failed", batch=128, writers=3) == len(bad)
    assert [r[0] for r in rows_of(connect, "SELECT id FROM t ORDER BY id")] == [i for i in range(2000) if i not in bad]
    kept = spark.read.parquet(f"{base}/failed").collect()
    assert {r.id for r in kept} == bad and all(r.refusal for r in kept) and len(kept) == len(bad)
    # the same rows again: all are refused (a key is there once), none is lost or doubled
    assert D.load(df.filter("id < 50"), connect, "t", f"{base}/staging2", f"{base}/failed2", batch=128) == 50
    # mended, they go
    mended = spark.read.parquet(f"{base}/failed").selectExpr("id", "coalesce(v, 'new') AS v", "least(w, 2.0) AS w", "refusal").toPandas()
    spark.createDataFrame(mended).write.mode("overwrite").parquet(f"{base}/failed")
    assert sinks.send_failed(spark, f"{base}/failed", connect, "t", f"{base}/staging3") == 0
    assert len(rows_of(connect, "SELECT id FROM t")) == 2000 and spark.read.parquet(f"{base}/failed").isEmpty()


def test_a_repeated_task_sends_nothing_twice(tmp_path):
    connect = made(tmp_path, "CREATE TABLE t (id INTEGER CHECK (id <> 5))")
    with closing(connect()) as c:
        c.execute(f"CREATE TABLE {D.LEDGER} (load_id TEXT, part TEXT, batch TEXT, PRIMARY KEY (load_id, part, batch))")
        for _ in range(3):
            bad = D._send(c, "INSERT INTO t (id) VALUES (?)", [(i,) for i in range(10)], "?", ("x", "0", "0"))
            assert [row for row, _ in bad] == [(5,)]
        assert Counter(r[0] for r in c.execute("SELECT id FROM t")) == {i: 1 for i in range(10) if i != 5}
        with pytest.raises(sqlite3.OperationalError):  # no such table: not the rows' fault
            D._send(c, "INSERT INTO missing (id) VALUES (?)", [(1,)], "?", ("x", "1", "0"))


def test_a_batch_is_one_transaction_however_many_rows_are_refused(tmp_path):
    class Counted(sqlite3.Connection):
        commits = 0

        def commit(self):
            Counted.commits += 1
            super().commit()

    with closing(sqlite3.connect(f"{tmp_path}/rows.db", factory=Counted)) as c:
        c.execute("CREATE TABLE t (id INTEGER CHECK (id % 10 <> 5))")
        c.execute(f"CREATE TABLE {D.LEDGER} (load_id TEXT, part TEXT, batch TEXT, PRIMARY KEY (load_id, part, batch))")
        for attempt in (1, 2):  # a repeated task tells of the same rows
            bad = D._send(c, "INSERT INTO t (id) VALUES (?)", [(i,) for i in range(1000)], "?", ("x", "0", "0"))
            assert [row for row, _ in bad] == [(i,) for i in range(5, 1000, 10)] and all(said for _, said in bad)
            assert Counted.commits == attempt
            assert Counter(r[0] for r in c.execute("SELECT id FROM t")) == {i: 1 for i in range(1000) if i % 10 != 5}


def test_reading_a_database_by_ranges(spark, tmp_path):
    connect = made(tmp_path, "CREATE TABLE t (id INTEGER, day TEXT)")
    with closing(connect()) as c:
        c.executemany("INSERT INTO t VALUES (?, ?)", [(i if i % 9 else None, str(datetime.date(2024, 1, 1 + i % 28))) for i in range(3000)])
        c.commit()
    got = D.ranges(spark, connect, "SELECT id, day FROM t WHERE day < '2024-01-20'", "id long, day string", "id", per_range=300)
    assert got.rdd.getNumPartitions() == 7  # 2,039 rows
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, rows_of(connect, "SELECT id, day FROM t WHERE day < '2024-01-20'")))
    assert D.ranges(spark, connect, "SELECT id, day FROM t WHERE id < 0", "id long, day string", "id").count() == 0
