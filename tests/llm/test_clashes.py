"""Stages that hand documents on, against brute force, with columns named like every helper and null or repeated ids."""

import collections
import hashlib
import random

import pytest

from clinflow.llm import contamination, exact_dedup, near_dedup, pii, quality, secrets
from clinflow.llm.common import spare

HELPERS = "__sha __SHA2 __h __again __t __site __path __p __p_site __p_path __quality __keep __s __n __s_site __n_site __spans __ranges __lost __id __key w items spans kind rid label node sha id h t row best again a.b tick`ed".split()
ITEM = " ".join(f"w{i}" for i in range(20))


def rows():
    r = random.Random(3)
    fresh = lambda n=40: " ".join(f"v{r.randint(0, 10**9)}" for _ in range(n))
    near = fresh(80)
    texts = [(1, near), (None, near + " more"), (2, near), (None, fresh()), (None, fresh()), (7, fresh()), (7, fresh()), (3, None), (4, ""), (None, None), (5, "Intro " + ITEM), (None, ITEM), (6, "bob@example.com wrote"), (6, "bob@example.com wrote"), (8, "long " * 20_000), (9, "x")]
    return [(i, t, "s", "en") for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    assert spare(spark.range(1).toDF("__H"), "h", "h") == ["__h_", "__h__"]
    data = [(*x, *(f"{k}:{n}" for k in range(len(HELPERS)))) for n, x in enumerate(rows())]
    df = spark.createDataFrame(data, ["doc_id", "text", "source", "lang", *(f"c{k}" for k in range(len(HELPERS)))])
    return df.toDF("doc_id", "text", "source", "lang", *HELPERS)


def same_rows(out, docs, want):
    """``out`` is the rows of ``docs`` with these numbers, all columns as they were."""
    assert out.columns == docs.columns
    assert collections.Counter(map(tuple, out.collect())) == collections.Counter(tuple(x) for x in docs.collect() if int(x[-1].split(":")[1]) in want)


def test_exact_copies(docs):
    best = {}
    for n, (i, t, *_) in enumerate(rows()):
        key = t or ""
        if key not in best or (i is not None and (best[key][0] is None or i > best[key][0])):
            best[key] = (i, n)
    out = exact_dedup.drop_copies(docs)
    assert len(best) == out.count()
    same = collections.Counter((r.doc_id, r.text or "") for r in out.collect())
    assert same == collections.Counter((i, t) for t, (i, _) in best.items())
    assert all(r["__h"].startswith("2:") and r["tick`ed"] for r in out.collect())


def test_contaminated(spark, docs):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    same_rows(contamination.drop_contaminated(docs, items), docs, {n for n, (_, t, *_) in enumerate(rows()) if ITEM not in (t or "")})
    clean = contamination.remove_spans(docs, items)
    assert clean.columns == docs.columns
    want = collections.Counter((i, None if t is None else t.replace("Intro " + ITEM, "Intro").replace(ITEM, "")) for i, t, *_ in rows())
    assert collections.Counter((r.doc_id, r.text) for r in clean.collect()) == want
    assert all(r["__sha"].startswith("0:") for r in clean.collect())


def test_near_copies(docs):
    kept = near_dedup.drop_near_copies(docs, width=5)
    # near copies: the three rows of one text and its longer form; equal texts beside them
    rest = [(i, t) for i, t, *_ in rows() if t is None or not t.startswith(rows()[0][1])]
    sets = {t for _, t in rest if (t or "").strip()}
    none = [(i, t) for i, t in rest if not (t or "").strip()]
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == docs.columns
    # ITEM and its copy with one word more are near too, above 0.8
    near = {"Intro " + ITEM}
    assert collections.Counter(t for _, t in got if (t or "").strip()) == collections.Counter([rows()[0][1], *(sets - {ITEM} if near <= sets else sets)])
    assert collections.Counter(x for x in got if not (x[1] or "").strip()) == collections.Counter(none)
    assert (1, rows()[0][1]) in got


def test_quality(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    judged = quality.quality(docs, labels)
    assert judged.count() == len(rows())
    good = quality.keep_good(docs, labels)
    assert good.columns == docs.columns and good.count() == judged.filter("keep").count()
    assert {r["__p"].split(":")[0] for r in good.collect()} == {str(HELPERS.index("__p"))}
    same_rows(quality.keep_good(docs, labels.limit(0)), docs, set(range(len(rows()))))
    assert quality.keep_good(docs.limit(0), labels).count() == 0


def test_redaction(docs):
    out = pii.redacted(docs, "#")
    assert out.columns == docs.columns
    want = collections.Counter((i, None if t is None else t.replace("bob@example.com", "#")) for i, t, *_ in rows())
    assert collections.Counter((r.doc_id, r.text) for r in out.collect()) == want
    assert {hashlib.sha256(r["__spans"].encode()).hexdigest() for r in out.collect()} == {hashlib.sha256(r["__spans"].encode()).hexdigest() for r in docs.collect()}
    assert secrets.redacted(docs).columns == docs.columns
