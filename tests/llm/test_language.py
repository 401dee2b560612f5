"""Language identification: forward-backward against all paths, held-out accuracy, code-switched texts, hard rows."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinflow.llm import language as L
from clinflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return L.fit(documents, ~L.held_out())


def test_forward_backward_is_the_sum_over_all_paths():
    r = np.random.default_rng(1)
    k = 3
    move, begin = r.random((k, k)) + 0.01, r.random(k) + 0.01
    sizes = np.array([1, 4, 6, 2])
    emit = r.random((sizes.sum(), k)) + 0.001
    want, moves, b = [], np.zeros((k, k)), 0
    for n in sizes:
        e = emit[b : b + n]
        b += n
        p, m, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
        for path in itertools.product(range(k), repeat=int(n)):
            w = begin[path[0]] * e[0, path[0]] * np.prod([move[x, y] * e[t + 1, y] for t, (x, y) in enumerate(itertools.pairwise(path))])
            total += w
            p[np.arange(n), path] += w
            for x, y in itertools.pairwise(path):
                m[x, y] += w
        want.append(p / total)
        moves += m / total
    for chunk in (1, 2, 3, 6, 32):
        got, got_moves = L.marginals(emit, sizes, move, begin, chunk)
        assert np.allclose(got, np.concatenate(want))
        if chunk >= 6:  # moves are asked for where no sequence is cut
            assert np.allclose(got_moves, moves)


def test_features_of_words():
    f = L.features(["ab", "a", "AB"], 1 << 20)
    assert f.n.tolist() == [2 + 3 + 2 + 1, 1 + 2 + 1, 8]  # 1 to 4 characters of \2ab\3 and \2a\3, the ends not alone
    assert f.cell[0] == f.cell[2] != f.cell[1] and f.bucket[:8].tolist() == f.bucket[-8:].tolist()


def test_held_out_documents(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op12_language_id"](spark, SF).collect()}
    lang = {r.doc_id: r.lang for r in documents.collect()}
    assert set(got) == set(lang)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.lang_pred in set(lang.values()) for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out]
    assert len(held) > 200 and np.mean([got[i].lang_pred == lang[i] for i in held]) >= 0.99


def test_code_switched_texts(spark, documents, model):
    """Texts made of stretches of held-out documents: nearly all words get their own stretch's language."""
    pieces = {}
    for r in documents.filter(L.held_out()).orderBy("doc_id").collect():
        pieces.setdefault(r.lang, []).append([w for w in L.words(r.text) if w.isalpha()])
    rng, rows, truth = random.Random(4), [], {}
    for n in range(60):
        lang, text, labels = rng.choice(sorted(pieces)), [], []
        for _ in range(rng.randint(2, 5)):
            lang = rng.choice([x for x in sorted(pieces) if x != lang])
            own = rng.choice([p for p in pieces[lang] if len(p) > 40])
            b, k = rng.randrange(len(own) - 30), rng.randint(8, 30)
            text += own[b : b + k]
            labels += [lang] * k
        rows.append((n, ", ".join(text)))
        truth[n] = labels
    df = spark.createDataFrame(rows, "doc_id long, text string")
    right = all_ = 0
    for r in L.language_spans(df, model).collect():
        text = dict(rows)[r.doc_id]
        assert r.spans[0].start == 0 and r.spans[-1].end == len(text)
        said = [s.lang for s in r.spans for _ in L.words(text[s.start : s.end])]
        assert len(said) == len(truth[r.doc_id])
        right += sum(a == b for a, b in zip(said, truth[r.doc_id], strict=True))
        all_ += len(said)
    assert right / all_ > 0.97
    switches = {r.doc_id: r.n_switches for r in L.languages(df, model).collect()}
    assert np.mean([switches[i] >= len([1 for a, b in itertools.pairwise(x) if a != b]) for i, x in truth.items()]) > 0.9


def test_hard_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "12 34 ... \n"), (4, "the of and"), (4, "the of and"), (None, "der und die"), (5, "漢字"), (6, "é" * 50_000), (7, "de la " * 200_000), (8, "x"), (9, "́ ² _ 7")]
    df = spark.createDataFrame([(i, t, "en", 1, "a") for i, t in rows], "doc_id long, text string, lang string, score long, __text string")
    got = L.identified(df).collect()
    assert len(got) == len(rows) and all(r.held_out is not None for r in got)
    told = L.languages(df, model, F.col("score").alias("kept")).collect()
    by_id = {}
    for r in told:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all((r.lang_pred, r.score, r.n_words) == ("und", 0.0, 0) for i in (1, 2, 3, 9) for r in by_id[i])
    assert [r.lang_pred for r in by_id[4]] == ["en", "en"] and by_id[None][0].lang_pred == "de" and by_id[7][0].lang_pred in ("es", "fr") and by_id[7][0].n_words == 400_000
    assert {r.lang_pred for i in (5, 6, 8) for r in by_id[i]} <= set(model.langs) and all(r.kept == 1 for r in told)
    assert {r.doc_id: r.spans for r in L.language_spans(df, model).filter("doc_id in (1, 2, 3)").collect()} == {1: [], 2: [], 3: []}
    assert L.languages(df.limit(0), model).count() == 0 and L.identified(df.limit(0)).count() == 0
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in L.identified(unlabelled).collect()} == {("und", 0.0)}
    assert {r.lang_pred for r in L.identified(df.filter("doc_id = 4")).collect()} <= {"en", "und"}
