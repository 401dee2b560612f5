"""Short test items, redaction by the index, and the size of exchanged messages, against brute force."""

import random
import re

import pytest

from clinflow.llm import contamination, exact_dedup, secrets

WORD = re.compile(r"[^\x00-/:-`{-\x7F]+")


@pytest.mark.parametrize("grams", [contamination.GRAMS, 0])
def test_items_of_every_size(spark, monkeypatch, grams):
    monkeypatch.setattr(contamination, "GRAMS", grams)
    rng = random.Random(3)

    def some(n, words=6):
        return [f"w{rng.randrange(words)}" for _ in range(n)]

    items = [some(n, 40) for n in (2, 3, 4, 5, 7, 11, 12, 13, 14, 30)] + [["rare"]]
    texts = [some(rng.randrange(60), 40) for _ in range(40)]
    for k in range(60):
        text, item = some(rng.randrange(40), 40), items[k % len(items)]
        at = rng.randrange(len(text) + 1)
        texts.append(text[:at] + item[: rng.choice([len(item), len(item), len(item) - 1])] + text[at:])
    texts += [list(x) for x in items] + [[], ["rare"], ["rare"] * 5]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    windows: dict[tuple, set] = {}
    for i, x in enumerate(items):
        n = min(13, len(x))
        for k in range(len(x) - n + 1):
            windows.setdefault(tuple(x[k : k + n]), set()).add(str(i))
    want = {}
    for i, ws in enumerate(texts):
        hit, ids = set(), set()
        for w, own in windows.items():
            for k in range(len(ws) - len(w) + 1):
                if tuple(ws[k : k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    ids |= own
        want[i] = (len(ws), len(hit), sorted(ids))
    found = contamination.hits(docs, bench).withColumn("n_hit", contamination.covered(contamination.F.col("spans"))).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in found} == want
    assert sum(1 for x in want.values() if x[1]) > 40


def test_redaction_by_the_index(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    long = "x" * (secrets.BLOCK + 5) + " token=abcdefgh1234 " + "y" * 10
    more = [(-1, None), (-2, ""), (-3, long), (-4, "AKIA" + "A" * 16 + " é api_key='0123456789abcdef0123456789abcdef'"), (-4, "token=short"), (None, "f" * 40)]
    rows = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))

    def brute(text):
        if text is None:
            return None
        out, at = [], 0
        for a, b in sorted(x for r in secrets.RULES for x in secrets.spans_of(text, r, re.compile(r.pattern).finditer)):
            if b > at:
                out += [text[at : max(a, at)], "<SECRET>"] if a >= at else []
                at = max(at, b)
        return "".join(out) + text[at:]

    want = sorted(((r.doc_id, brute(r.text)) for r in rows.collect()), key=str)
    got = sorted(((r.doc_id, r.text) for r in secrets.redacted(rows).collect()), key=str)
    assert got == want and sum("<SECRET>" in (t or "") for _, t in got) > 2
    assert secrets.redacted(rows.limit(0)).count() == 0


def test_messages_stay_long():
    assert exact_dedup.per_owner(0) == exact_dedup.per_owner(10**9) == exact_dedup.PER_OWNER
    n = exact_dedup.per_owner(10**11)
    assert n <= exact_dedup.MOST and n * n / 10**11 >= exact_dedup.PER_MESSAGE - 1
    assert exact_dedup.per_owner(10**15) == exact_dedup.MOST
