"""Periodic runs against a search of every period, and the automaton's squares against all suffixes."""

import hashlib
import random
import zlib

from clinflow.llm import periodic_runs as R
from clinflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(w, least=24, times=3):
    """Every period at every place."""
    out, n = set(), len(w)
    for d in range(1, n // times + 1):
        i = 0
        while i + d < n:
            if w[i] != w[i + d]:
                i += 1
                continue
            j = i
            while j + d < n and w[j] == w[j + d]:
                j += 1
            s, size = i, j + d - i
            if size >= max(least, times * d) and not any(w[s : s + size - e] == w[s + e : s + size] for e in range(1, d)):
                out.add((s, size, d))
            i = j
    return sorted(out)


def all_squares(seq, least):
    """(end, d) from the longest suffix that each distance is the nearest one of."""
    out = set()
    for i in range(len(seq)):
        nearest = {}
        for size in range(1, i + 1):
            s = seq[i - size + 1 : i + 1]
            j = next((j for j in range(i - 1, size - 2, -1) if seq[j - size + 1 : j + 1] == s), None)
            if j is None:
                break
            nearest[i - j] = size
        out |= {(i, d) for d, size in nearest.items() if size >= 2 * d and size + d >= least}
    return out


def made(r, longest):
    n, k, w = r.randint(0, longest), r.choice([1, 2, 3, 5, 20]), []
    while len(w) < n:
        unit = [b"%d" % r.randrange(k) for _ in range(r.randint(1, 15))]
        w += (unit * r.randint(1, 9))[: r.randint(1, 80)] if r.random() < 0.5 else unit[:6]
    return w[:n]


def test_squares_of_the_automaton():
    r = random.Random(5)
    for _ in range(200):
        seq = [r.randrange(r.choice([1, 2, 3])) for _ in range(r.randint(0, 40))]
        assert set(R.squares(seq, 6, 3)) == all_squares(seq, 6)


def test_runs_are_those_of_every_period():
    r = random.Random(1)
    for _ in range(600):
        w = made(r, 140)
        for least, times in ((24, 3), (6, 2), (9, 3), (1, 2)):
            assert R.runs(w, least, times) == brute(w, least, times)
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(9):
        a, b = b, b + a
    assert R.runs(b, 4, 2) == brute(b, 4, 2)


def test_long_texts():
    assert R.runs([b"a"] * 100_000) == [(0, 100_000, 1)]
    r = random.Random(2)
    unit = [b"%d" % r.randrange(9000) for _ in range(9000)]
    assert R.runs([b"x", *unit * 3, *unit[:50], b"y"]) == [(1, 27_050, 9000)]
    assert R.runs([b"x", *unit * 2, *unit[:8999], b"y"]) == []  # one word short of three periods


def told(doc_id, text):
    """The row of a document by the contract's words and brute force."""
    w = [x for x in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and w:
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    found = brute(w)
    best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2])) if found else (None, None, None)
    lost = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in lost)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(w), len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_digests_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    short = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 8000}
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == docs.count() and sum(r[2] > 0 for r in got.values()) > 10
    assert {i: got[i] for i in short} == {i: told(i, t) for i, t in short.items()}


def test_hard_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 30), (4, "a " * 30), (None, "b " * 24), (None, None), (5, "é漢 \x85 x y " * 12), (6, "one"), (7, "long " * 300_000)]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, start long, n_runs string")
    got = R.run_digests(df).collect()
    none = hashlib.sha256(b"").hexdigest()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(got) == len(rows)
    assert all((r.n_words, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == (0, 0, None, None, None, None, none, none) for i in (1, 2, 3) for r in by_id[i])
    assert [(r.start, r.length, r.period, r.exponent_milli) for r in by_id[4]] == [(0, 30, 1, 30000)] * 2
    assert sorted(r.n_words for r in by_id[None]) == [0, 24]
    assert (by_id[5][0].n_words, by_id[5][0].length, by_id[5][0].period) == (36, 36, 3)  # the next-line sign and the hard space separate nothing
    assert by_id[7][0].length == 300_000
    assert R.run_digests(df.limit(0)).count() == 0
    found = [tuple(r) for r in R.periodic_runs(df).filter("doc_id = 4").collect()]
    assert found == [(4, 0, 30, 1, "a")] * 2
    once = R.without_repetition(df)
    assert once.columns == df.columns
    assert [r.text for r in once.filter("doc_id = 4").collect()] == ["a", "a"]
    assert sorted(str(r.text) for r in once.filter("doc_id is null or doc_id in (1, 2, 3, 6, 7)").collect()) == sorted(["None", "", " \t\n", "b", "None", "one", "long"])
