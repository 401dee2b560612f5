"""Known names against one alternation, longest first."""

import random
import re
import time

from clinflow.operators import names as N

WORD = "[A-Za-z0-9_]"


def by_alternation(text, patterns):
    if not patterns:
        return text
    pattern = "|".join(re.escape(x) for x in sorted(patterns, key=lambda x: (-len(x), x)))
    return re.sub(rf"(?<!{WORD})(?:{pattern})(?!{WORD})", "", text)


def test_as_one_alternation(spark):
    r = random.Random(2)
    syllables = ["St", "ann", "north", "Hos", "pital", "é", "9"]
    name = lambda: " ".join("".join(r.choices(syllables, k=r.randint(1, 3))) for _ in range(r.randint(1, 3)))
    known = [name() for _ in range(60)] + ["", None, "Same", "Same", "a-b (c)"]
    texts = ["".join(r.choice([name(), " ", ", ", "_", "x", r.choice(known) or ""]) for _ in range(r.randint(0, 14))) for _ in range(300)] + [None, "", "a-b (c)", "the a-b (c)."]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, note string, spans string")
    dictionary = spark.createDataFrame([(n,) for n in known], "name string")
    patterns = {r.pattern for r in N.patterns(dictionary, ["north"]).collect()}
    words = {w for n in known if n for w in re.findall(r"\w+", n) if len(w) > 3 and w != "north"}
    assert patterns == {n for n in known if n} | words
    for part in (1000, 7):  # one automaton, and many whose spans are settled together
        got = {x.id: x.note for x in N.remove_names(df, "note", dictionary, ["north"], part).collect()}
        assert got == {i: t if t is None else by_alternation(t, patterns) for i, t in enumerate(texts)}
    assert N.remove_names(df, "note", dictionary.limit(0), []).exceptAll(df).isEmpty()


def test_a_hundred_thousand_names(spark):
    known = spark.range(100_000).selectExpr("concat('Clinic', id, ' of Town', id % 977) AS name")
    text = " ".join(f"seen at Clinic{i} of Town{i % 977}, then Clinic{i}x" for i in range(0, 60_000, 3))
    df = spark.createDataFrame([(1, text), (2, "nothing here " * 50_000)], "id int, note string")
    began = time.time()
    got = {r.id: r.note for r in N.remove_names(df, "note", known, []).collect()}
    assert got[2] == "nothing here " * 50_000
    assert got[1] == " ".join(f"seen at , then Clinic{i}x" for i in range(0, 60_000, 3))
    assert time.time() - began < 60


def test_a_large_dictionary_stays_a_table(spark, monkeypatch):
    """Beyond PART no worker gets the patterns: only a filter of ten bits for each, whose false candidates a join drops."""
    monkeypatch.setattr(N, "_found", None)
    monkeypatch.setattr(N, "CHUNK", 5)
    known = spark.range(2000).selectExpr("concat('Ann', id, '#', id) AS name").unionByName(spark.createDataFrame([("two words",)], "name string"))
    texts = ["Ann1#1 and two words, Ann1#2 or Ann1#1_", "Ann1999#1999.Ann1999#1999", None, "", "nothing"]
    df = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts * 2)], "id int, note string")  # equal rows stay apart
    for held in (0.0, 1.0):  # the filter as it is, and one that lets everything through
        if held:
            monkeypatch.setattr(N, "within", lambda held, h, bits: h == h)
        got = N.remove_names(df, "note", known, [], part=100)
        want = {"Ann1#1 and two words, Ann1#2 or Ann1#1_": " and , #2 or #Ann1#1_".replace("#Ann1#1_", "#1_"), "Ann1999#1999.Ann1999#1999": "."}
        assert sorted(map(str, got.collect())) == sorted(map(str, df.replace(want, subset=["note"]).collect()))
