"""Personal data: base spans against brute force, added spans against labelled sentences."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from clinflow.llm import pii

SF = "/root/testdata/sf0.001"
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
#: Sentences that no template of the fit holds, and the added spans that they have.
SAID = [
    ("call (555) 123-4567", ["phone_local:5:19"]),
    ("You can phone me: 415.555.2671 or 415-555-2672!", ["phone_local:18:30", "phone_local:34:46"]),
    ("order 555-123-4567 shipped", []),
    ("running version 415.555.2671 now", []),
    ("ssn 123-45-6789", ["national_id:4:15"]),
    ("My SSN: 987-65-4321", []),
    ("serial number 123-45-6789", []),
    ("mail bob [at] example [dot] com", ["email_spelled:5:31"]),
    ("see [at] noon [dot] 5", []),
    ("amex 3782 822463 10005", ["card_other:5:22"]),
    ("amex 3782 822463 10006", []),
    ("imei 378282246310005", []),
    ("no 12 4485 2757 4230 8327 yes", ["card_other:6:25"]),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "card":
        return 16 <= len(d) <= 19 and sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(d[::-1])) % 10 == 0
    return kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m.split("."))) or (kind == "phone" and 8 <= len(d) <= 15)


def test_spans(spark, documents):
    cases = ["é bob@x.example.com, 1.2.3.4 and 1.2.3.256", "4485 2757 4230 8327 4485275742308328", "+1 (555) 123-4567", "+1 23", None, "1 2 " * 3000, "a@b", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(cases + [t for t, _ in SAID])], "doc_id long, text string, kind string")
    both = df.select("doc_id", "text").unionByName(documents.select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    texts = {r.doc_id: r.text or "" for r in both.collect()}
    rows = {r.doc_id: r for r in pii.pii_spans(both).collect()}
    assert len(rows) == len(texts)
    for i, r in rows.items():
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, texts[i]) if good(k, m.group())]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        found = [x for x in r.spans.split(",") if x]
        assert found[: len(spans)] == spans and r.n_spans == len(found)
        places = sorted(tuple(map(int, x.split(":")[1:])) for x in found[len(spans) :])
        assert all(b <= c for (_, b), (c, _) in zip(places, places[1:], strict=False))  # added spans don't overlap each other
        assert not any(a < int(y.split(":")[2]) and int(y.split(":")[1]) < b for a, b in places for y in spans)  # nor base spans
    assert rows[0].spans == "email:2:19,ip:21:28" and rows[2].n_phone == 1 and rows[3].n_phone == 0 and rows[4].spans == "" and rows[6].n_email == 0
    assert rows[7].n_email == 2 and rows[8].n_ip == 2
    for k, (text, want) in enumerate(SAID):
        found = [x.replace("card_other", "card") for x in rows[len(cases) + k].spans.split(",") if x]  # a refused card may pass under either kind
        assert found == [x.replace("card_other", "card") for x in want], text


def test_the_stored_model_is_what_the_fit_gives(spark):
    kept, made = pii.stored(), pii.fit(spark)
    assert made == kept
    assert sorted(set(pii.KINDS[len(pii.BASE) :]) - set(kept.cuts)) == []


def test_held_out_words():
    """Context words that no sentence of the fit holds; then words that no feature knows either."""
    kept = pii.stored()
    for kind in pii.KINDS[len(pii.BASE) :]:
        assert kept.held[kind]["rows"] > 150 and kept.held[kind]["precision"] >= pii.PRECISION and kept.held[kind]["recall"] >= 0.9, kind
        assert kept.unseen[kind]["rows"] > 150, kind
    assert min(r["precision"] for r in kept.unseen.values()) >= 0.5


def test_a_fit_with_a_corpus(spark, documents):
    model = pii.fit(spark, pii.candidates(documents).select("doc_id", "rid", F.inline("found")))
    assert set(pii.KINDS[len(pii.BASE) :]) <= set(model.cuts)
    df = spark.createDataFrame([(1, "call (555) 123-4567 or bob@x.org"), (2, "order 555-123-4567 shipped")], "doc_id long, text string")
    assert {r.doc_id: r.spans for r in pii.pii_spans(df, model).collect()} == {1: "email:23:32,phone_local:5:19", 2: ""}


def test_hard_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "x@y.zz"), (2, None), (3, ""), (4, "漢 +44 20 7946 0018 𝒳")]
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, rid int, spans int")
    got = sorted((str(r.doc_id), r.spans) for r in pii.pii_spans(df).collect())
    assert got == [("1", ""), ("1", ""), ("2", ""), ("3", ""), ("4", "phone:2:18"), ("None", "email:0:6")]
    assert pii.pii_spans(df.limit(0)).count() == 0
