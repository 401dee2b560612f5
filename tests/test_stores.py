"""Bucketed stores, long lists and documents by path."""

import random

import pytest
from pyspark.sql import functions as F

from clinflow.operators import feeds, membership
from clinflow.sources import store as S


def latest(rows):
    """The store by hand: rows of (key, a, b, ts) in any order of arrival."""
    out = {}
    for k, a, b, ts in rows:
        kept = out.setdefault(k, {"a": (None, -1), "b": (None, -1)})
        for name, v in (("a", a), ("b", b)):
            if v is not None and v.strip() and ts >= kept[name][1]:
                kept[name] = (v, ts)
    return {k: (x["a"][0], x["b"][0]) for k, x in out.items()}


def test_upserts_touch_only_their_buckets(spark, tmp_path):
    r = random.Random(1)
    schema, clock = "k string, a string, b string, ts long", iter(r.sample(range(10**6), 2000))  # loads come in no order of time
    load = lambda n, keys: [(f"k{r.randrange(keys)}", r.choice(["x", "y", " ", None]), r.choice(["1", "2", ""]), next(clock)) for _ in range(n)]
    first, second = load(400, 200), load(300, 260)
    store = S.create(spark, f"file://{tmp_path}", spark.createDataFrame(first, schema), ["k"], ["a", "b"], "ts", 4)
    read = lambda s: {x.row_key: (x.a, x.b) for x in s.rows().collect()}
    assert read(store) == latest(first)
    store = S.upsert(store, spark.createDataFrame(second, schema), ["k"])
    assert read(store) == latest(first + second)
    before = {f.name: f.stat().st_mtime_ns for f in tmp_path.glob("generation=*/part=*/*.parquet")}
    assert len(before) == 4  # a file for each bucket
    third = [("k7", "new", None, 10**7)]
    S.upsert(store, spark.createDataFrame(third, schema), ["k"])
    after = {f.name: f.stat().st_mtime_ns for f in tmp_path.glob("generation=*/part=*/*.parquet")}
    assert len(after) == 4 and len(set(before) & set(after)) == 3 and all(before[n] == after[n] for n in set(before) & set(after))
    assert read(store) == latest(first + second + third)
    more = S.grown(store, 30)
    assert more.buckets == 16 and read(more) == read(store) and S.grown(more, 10**6) is more
    S.drop(store)
    again = S.opened(spark, store)  # by its files
    assert read(again) == read(more)
    S.drop(again)
    S.drop(more)


def test_no_shuffle_above_the_store(spark, tmp_path):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("v"), "id").alias("a"), F.col("id").alias("ts"))
    store = S.create(spark, f"file://{tmp_path}", rows, ["k"], ["a"], "ts", 6)
    asked = spark.range(0, 9000, 2).select(F.col("id").cast("string").alias("q"))
    found = S.lookup(asked, store, ["q"])
    assert found.filter("found_a is not null").count() == 1500 and found.count() == 4500
    plan = found._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.rindex("SortMergeJoin") :]
    scan = next(part for part in side.split("\n") if "Scan parquet" in part and "row_key" in part)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in scan
    S.drop(store)


@pytest.mark.parametrize("most", [membership.BITS, 0])
def test_a_list_of_a_million(spark, most):
    values = spark.range(0, 3_000_000, 3).select(F.concat(F.lit("v"), "id").alias("value")).unionByName(spark.createDataFrame([(None,), ("v1",), ("v1",)], "value string"))
    rows = spark.range(0, 200_000).select(F.when(F.col("id") % 11 > 0, F.concat(F.lit("v"), "id")).alias("x"), "id", F.lit("a").alias("value"))
    got = membership.in_list(rows, "x", values, most=most)
    assert got.columns == rows.columns
    want = sum(1 for i in range(200_000) if i % 11 and (i % 3 == 0 or i == 1))
    assert got.count() == want and got.filter("id % 3 > 0").count() == 1
    assert membership.in_list(rows, "x", values.limit(0), most=most).count() == 0


def test_the_filter_lets_few_others_through(spark):
    values = spark.range(100_000).select(F.col("id").alias("value"))
    bits = 1_000_000 // 64 * 64
    words = membership.bloom(values, "value", bits)
    h = spark.range(100_000, 200_000).select(F.xxhash64("id").alias("h")).toPandas().h.to_numpy()
    there = sum(all(int(words[int(p) >> 6]) >> (int(p) & 63) & 1 for p in ps) for ps in zip(*(a.tolist() for a in membership.places(h[:5000], bits)), strict=True))
    assert there / 5000 < 0.03


def test_documents_of_any_shape(spark):
    texts = ['{"a": {"b": [1, "x"]}}', '{"a": 5}', "[1, 2]", "null", "", None, '{"a": ', "{'a': 1}", '"text"']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, value string")
    rows = feeds.at_paths(feeds.parse_variant(df), {"n": ("$.a.b[0]", "bigint"), "t": ("$.a.b[1]", "string"), "a": ("$.a", "int")}).orderBy("id").collect()
    assert [r.malformed for r in rows] == [False, False, False, False, True, True, True, True, False]
    assert (rows[0].n, rows[0].t, rows[0].a) == (1, "x", None) and rows[1].a == 5 and rows[2].n is None
