"""Every stage of the pipeline against a brute-force version, each on its own input."""

import collections
import hashlib
import re

import public_tokenizers
import pytest
import tiktoken

from clinflow.llm import bpe, common, quality

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-/:-`{-\x7F]+")


def low(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows before, rows after) of each stage on the given documents, some of them with null or repeated ids."""
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    odd = [(None, rows[3][1], *rows[3][2:]), (rows[5][0], rows[7][1] + " and more", *rows[7][2:]), (None, None, "en", "src1", 0), (10**6, "", "en", "src1", 0), (None, rows[9][1] + " tail", *rows[9][2:])]
    docs = spark.createDataFrame(rows + odd, docs.schema)
    out = []
    for name, stage in p.STAGES:
        after = stage(spark, docs, SF).cache()
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def counted(df):
    return collections.Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_quality(spark, stages):
    before, after = stages["quality classifier"]
    judged = quality.quality(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert after.columns == before.columns and 0 < after.count() < before.count()
    assert collections.Counter(r.doc_id for r in after.collect()) == collections.Counter(r.doc_id for r in judged.filter("keep").collect())


def test_exact(stages):
    before, after = stages["exact dedup"]
    best = {}
    for i, t in counted(before):
        key = t or ""
        if key not in best or (i is not None and (best[key] is None or i > best[key])):
            best[key] = i
    assert collections.Counter((i, t or "") for i, t in counted(after).elements()) == collections.Counter((i, t) for t, i in best.items())


def test_near(stages):
    before, after = stages["MinHash near-dedup"]
    rows = list(counted(before).elements())
    sets = []
    for _, t in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        k = min(5, len(ws))
        sets.append({tuple(ws[j : j + k]) for j in range(len(ws) - k + 1)} if k else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    groups = collections.defaultdict(list)
    for k, r in enumerate(rows):
        groups[root(k) if sets[k] else ("none", k)].append(r)
    order = lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())
    assert counted(after) == collections.Counter(min(g, key=order) for g in groups.values())


def test_contamination(spark, stages):
    before, after = stages["benchmark decontamination"]
    windows = collections.defaultdict(set)
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        ws = WORD.findall(low(r.text))
        n = min(13, len(ws))
        windows[n] |= {tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)} if n else set()

    def bad(t):
        ws = WORD.findall(low(t))
        hit = {k + j for n, own in windows.items() for k in range(len(ws) - n + 1) if tuple(ws[k : k + n]) in own for j in range(n)}
        return bool(hit) and 20 * len(hit) >= len(ws)

    want = collections.Counter({x: n for x, n in counted(before).items() if not bad(x[1])})
    assert counted(after) == want


def test_tokens(stages):
    before, after = stages["byte-level BPE"]
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    want = collections.Counter((i, tuple(coder.encode_ordinary(t or ""))) for i, t in counted(before).elements())
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in after.collect()) == want
    assert all(r.n_tokens == len(r.ids) for r in after.collect())


def test_folders_of_earlier_stages_go(spark, tmp_path):
    keep, gone = common.scratch(spark, "keep"), common.scratch(spark, "gone")
    n = len(common.MADE) - 2
    for path in (keep, gone):
        spark.range(3).write.parquet(path)
    common.discard(spark, n, keep)
    assert spark.read.parquet(keep).count() == 3 and common.MADE[n:] == [keep]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(gone)
