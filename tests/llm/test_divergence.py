"""The source divergence audit against plain sums over all terms."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest

from clinflow.llm import divergence as D
from clinflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute(rows, least, top):
    docs = [(l or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for l, s, t in rows]
    seen, count = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, words in docs:
        seen[lang].update(set(words))
        count[lang, source].update(words)
    out = []
    for lang in {d[0] for d in docs}:
        kept = sorted(t for t, n in seen[lang].items() if n >= least)
        sources = sorted({d[1] for d in docs if d[0] == lang})
        v = len(kept)

        def prices(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        of = {s: prices(count[lang, s]) for s in sources}
        whole = prices(sum((count[lang, s] for s in sources), collections.Counter()))
        for s in sources:
            pairs = [(sum(f(of[s][t], of[o][t]) for t in kept), o) for o in sources if o != s]
            best = [(f(of[s][t], whole[t]), t) for t in kept if count[lang, s][t] > 0 and of[s][t] > whole[t]]
            for part, found, ranks in (("pair", pairs, None), ("term", best, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found[:ranks], 1)]
    return sorted(out)


def made(seed, n):
    r = random.Random(seed)
    words = ["Aa", "b", "É", "éa", "漢字", "c9d", "zz", "q'r", *(f"w{chr(97 + k)}" for k in range(20))]
    rows = [(r.choice(["en", "en", "de", None]), r.choice(["s", "s", "t", "T", None, "ü"]), " ".join(r.choices(words, k=r.randint(0, 30)))) for _ in range(n)]
    return [*rows, ("en", "quiet", None), ("en", "still", "12 34 !"), ("xx", "a", "only once"), ("xx", "b", ""), ("yy", "alone", "x"), (None, None, None), ("", "", "b b b"), ("en", "s", "b " * 100_000)]


@pytest.mark.parametrize("sources, rows, columns", [(64, 256, 2048), (2, 3, 4)])
def test_every_value(spark, monkeypatch, sources, rows, columns):
    for name, value in (("SOURCES", sources), ("ROWS", rows), ("COLUMNS", columns), ("TERMS", 8), ("HELD", 20)):
        monkeypatch.setattr(D, name, value)
    data = made(3, 150)
    df = spark.createDataFrame([(7, *row, "x", 1) for row in data], "doc_id long, lang string, source string, text string, term string, n long").repartition(5)
    for least, top in ((10, 10), (1, 3)):
        got = sorted(tuple(r[c] for c in COLUMNS) for r in D.source_divergence(df, least, top).collect())
        assert got == brute(data, least, top)
    assert D.source_divergence(df.limit(0)).count() == 0


def test_products_are_exact():
    r = np.random.default_rng(1)
    level = r.poisson(r.exponential(5, (500, 1)), (500, 9)).astype(np.int64)
    cost = level * 1000 + 17 + np.arange(9)
    left, right = np.arange(4), np.arange(4, 9)
    want = [[sum((a - b) ** 2 // (a + b) for a, b in zip(cost[:, i].tolist(), cost[:, j].tolist(), strict=True)) for j in right] for i in left]
    assert D.joint_prices(level, cost, left, right).tolist() == want


def test_prices_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    n = 5 * 10**12
    got = spark.range(1).select(D.price(F.lit(n), F.lit(3 * n), F.lit(7)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 2) // (3 * n + 14)


def test_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.sql(ORACLES["op11_source_divergence"]).select(", ".join(COLUMNS)).fetchall())
    assert sorted(tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_source_divergence"](spark, SF).collect()) == want
