"""What label propagation does for the cut links, and what large groups get."""

import collections
import hashlib

from pyspark.sql import functions as F

from clinflow.llm import sharding


def cut_off(rows):
    """Members that are not where most of their group is; ``rows``: (group, shard)."""
    by = collections.defaultdict(collections.Counter)
    for g, s in rows:
        by[g][s] += 1
    return sum(sum(c.values()) - max(c.values()) for c in by.values())


def test_labels_decide(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    groups = spark.createDataFrame([(t, n) for t, n in collections.Counter(text.values()).items() if n > 1], "g string, n long")
    state = sharding.spread(groups)
    before, room = sharding.outside(state), len(text) / 16
    after = sharding.propagate(state, room)
    # sorted by a digest and cut into 16: what needs no propagation
    order = sorted(text, key=lambda i: hashlib.sha256(text[i].encode()).hexdigest())
    plain = cut_off((text[i], k * 16 // len(order)) for k, i in enumerate(order))
    got = sharding.shards(docs).collect()
    assert before > 50 and sharding.outside(after) <= before // 10
    assert cut_off((text[r.doc_id], r.shard) for r in got) <= max(plain, before // 20)
    load = {r.shard: r.n for r in after.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    assert max(load.values()) <= 1.5 * room


def test_large_groups_get_few_shards(spark):
    """A group of 3.2 shards, one of 0.6 and many of four."""
    rows = ["hot"] * 320 + ["warm"] * 60 + [f"t{i // 4}" for i in range(800)] + [f"s{i}" for i in range(420)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = sharding.shards(docs).collect()
    sizes = collections.Counter(r.shard for r in got)
    assert set(sizes.values()) == {100}
    at = collections.defaultdict(collections.Counter)
    for r in got:
        at[rows[r.doc_id]][r.shard] += 1
    assert sum(n for _, n in at["hot"].most_common(4)) >= 240 and at["warm"].most_common(1)[0][1] >= 50
    whole = sum(len(at[f"t{k}"]) == 1 for k in range(200))
    assert whole >= 170
