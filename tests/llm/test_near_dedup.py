"""Near-duplicates against all pairs of the given documents, large canopies, and components of long chains."""

import collections
import random
import re

import pytest

from clinflow.llm import near_dedup


def sets_of(rows, width):
    out = {}
    for i, t in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), t or ""))
        k = min(width, len(ws))
        out[i] = {tuple(ws[j : j + k]) for j in range(len(ws) - k + 1)} if k else set()
    return out


def all_pairs(sets):
    """(component of each document, links)."""
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having, links = collections.defaultdict(list), 0
    for i, x in sorted(sets.items()):
        common = collections.Counter(j for h in x for j in having[h])
        for j, k in common.items():
            if 100 * k >= 80 * (len(x) + len(sets[j]) - k):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
                links += 1
        for h in x:
            having[h].append(i)
    return {i: root(i) for i in sets}, links


@pytest.mark.parametrize("width", [2, 5])
def test_no_link_is_lost_in_the_given_documents(spark, width):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want, links = all_pairs(sets_of([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], width))
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, width=width).collect()}
    assert got == want and links > 100


def test_sql_gives_the_same(spark):
    import duckdb

    from clinflow.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.sql(ORACLES["op5_near_dedup"]).df().sort_values("doc_id")
    got = QUERIES["op5_near_dedup"](spark, "/root/testdata/sf0.001").toPandas().sort_values("doc_id")
    assert got[list(want.columns)].to_numpy().tolist() == want.to_numpy().tolist()


@pytest.mark.parametrize("block", [3, 5])
def test_canopies_of_many_parts(spark, monkeypatch, block):
    """Families around the threshold, cut into parts of a few nodes, so that links across parts matter."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    r = random.Random(block)
    rows = []
    for family in range(6):
        base = [f"w{family}_{k}" for k in range(60)]
        for _ in range(25):
            ws = list(base)
            for _ in range(r.randint(0, 9)):
                ws[r.randrange(60)] = f"n{r.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(ws)))
    want, _ = all_pairs(sets_of(rows, 2))
    got = {x.doc_id: x.component_id for x in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and len(set(want.values())) > 6


def test_components_of_ordered_chains_and_stars(spark, monkeypatch):
    rounds, cut = [], near_dedup.cut
    monkeypatch.setattr(near_dedup, "cut", lambda df: rounds.append(df.columns) or cut(df))
    n = 1000
    for edges in ([(i, i + 1) for i in range(n)], [(n + 5, i) for i in range(n)], [(i, i) for i in range(3)] + [(1, 2), (4, 3)]):
        rounds.clear()
        labels = collections.defaultdict(set)
        for r in near_dedup.components(spark.createDataFrame(edges, "x long, y long")).collect():
            labels[r.label].add(r.node)
        nodes = {x for e in edges if e[0] != e[1] for x in e}
        assert set().union(*labels.values()) == nodes and len(labels) == (1 if len(edges) > 10 else 2)
        assert sum("p" in c for c in rounds) <= 14  # pointers are doubled: the chain's logarithm, and a little
