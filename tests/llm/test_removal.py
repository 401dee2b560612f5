"""What the detectors find, taken out of the texts, against brute force."""

import re

from pyspark.sql import functions as F

from clinflow.llm import contamination, pii

WORD = re.compile(r"[^\x00-/:-`{-\x7F]+")
SF = "/root/testdata/sf0.001"


def low(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def words_out(text, items, width=13):
    """The text without its words in windows, and without what stands before such a word."""
    windows = set()
    for item in items:
        ws = WORD.findall(low(item))
        n = min(width, len(ws))
        windows |= {tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)} if n else set()
    found = list(re.finditer(r"[^\x00-/:-@\[-`{-\x7F]+", text))
    ws = [low(m.group()) for m in found]
    hit = {k + j for n in {len(w) for w in windows} for k in range(len(ws) - n + 1) if tuple(ws[k : k + n]) in windows for j in range(n)}
    out, at = [], 0
    for k, m in enumerate(found):
        if k not in hit:
            out.append(text[at : m.end()])
        at = m.end()
    return "".join(out) + text[at:]


def test_spans_of_items_go(spark):
    item = " ".join(f"w{i}" for i in range(20))
    items = [item, "Short one", "!!"]
    texts = [f"Before, {item.upper()}; after.", f"{item} {item}", "short one", "«Short, one» more short\none", "nothing (here)", "", " \n", None, item + " x" * 3000 + " " + item, "short two one", "short one"]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in enumerate(texts)], "doc_id long, text string, size int, w string")
    asked = spark.createDataFrame([*enumerate(items), (9, None)], "item_id long, text string")
    out = contamination.remove_spans(df, asked)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {i: None if t is None else words_out(t, items) for i, t in enumerate(texts)}
    assert got[0] == "Before; after." and got[2] == ""
    assert contamination.remove_spans(df.limit(0), asked).count() == 0
    assert contamination.remove_spans(df, asked.limit(0)).exceptAll(df).isEmpty()


def test_no_window_is_left_in_the_tables(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    asked = [r.text or "" for r in items.collect()]
    before = {r.doc_id: r.text for r in docs.collect()}
    for r in contamination.remove_spans(docs, items).collect():
        assert r.text == (None if before[r.doc_id] is None else words_out(before[r.doc_id], asked))


def test_personal_data_goes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    more = ["é bob@x.example.com, 1.2.3.4", "call +44 4485275742308327 now", None, "", "plain", "a@b.co" + " x@y.zz" * 300, "plain"]
    df = docs.unionByName(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(more)], "doc_id long, text string")).withColumn("kind", F.lit("k"))
    spans = {r.doc_id: r.spans for r in pii.pii_spans(df).collect()}
    out = pii.redacted(df, "#")
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert len(got) == df.count()
    for r in df.collect():
        if r.text is None:
            assert got[r.doc_id] is None
            continue
        inside = [tuple(map(int, x.split(":")[1:])) for x in spans[r.doc_id].split(",") if x]
        want, at = "", 0
        for a, b in sorted(inside):
            if a >= at:
                want += r.text[at:a] + "#"
            at = max(at, b)
        assert got[r.doc_id] == want + r.text[at:]
    assert got[10_000] == "é #, #" and got[10_004] == "plain"
    assert pii.redacted(df.limit(0)).count() == 0
