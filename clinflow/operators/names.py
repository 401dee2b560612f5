"""Removing known names from free text, for dictionaries of any size.

A name counts only where no word character (A-Z, a-z, 0-9 and the underscore) stands next to it; of the places found the
leftmost come first, of those the longest, none overlapping. A dictionary is a table. One of PART patterns at most is made
into an Aho-Corasick automaton that goes to the workers. A larger one stays a table: a name's place consists of whole tokens
(runs of word characters, or one other character), so a text's candidates are its sequences of as many tokens as some
pattern has. A Bloom filter of the patterns, all that goes to a worker, drops most others; what it lets through is
joined with the patterns, text for text, and the places return to their row.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflow.operators.membership import BITS, bits_for, bloom, within

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Patterns of one automaton, about 100 bytes each in a worker for each letter of theirs; letters that a name's word has at least to count alone.
PART, LEAST = 50_000, 4
SPANS = "array<struct<start: int, end: int>>"
#: A run of word characters, or one other character; candidates of a text that are hashed at a time.
TOKEN, CHUNK = "[A-Za-z0-9_]+|[^A-Za-z0-9_]", 100_000


def patterns(names: DataFrame, stop: list[str]) -> DataFrame:
    """(pattern): the names of column ``name`` and their words of LEAST letters or more but those in ``stop``; each once."""
    words = F.expr(r"regexp_extract_all(name, '(?U)\\w+', 0)")
    alone = names.select(F.explode(words).alias("pattern")).filter((F.length("pattern") >= LEAST) & ~F.col("pattern").isin(*stop))
    return names.select(F.col("name").alias("pattern")).unionByName(alone).filter("pattern <> ''").distinct()


def _word(c: str) -> bool:
    return c.isascii() and (c.isalnum() or c == "_")


def occurrences(automaton, text: str) -> list[tuple[int, int]]:
    """Places of all patterns between word boundaries, [start, end)."""
    out = []
    for last, size in automaton.iter(text):
        start, end = last - size + 1, last + 1
        if not (start and _word(text[start - 1])) and not (end < len(text) and _word(text[end])):
            out.append((start, end))
    return out


def settled(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Leftmost, then longest, none overlapping."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(set(spans), key=lambda s: (s[0], -s[1])):
        if not out or start >= out[-1][1]:
            out.append((start, end))
    return out


def _found(text: Column, words: list[str]) -> Column:
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for w in words:
        automaton.add_word(w, len(w))
    if words:
        automaton.make_automaton()

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"start": a, "end": b} for a, b in occurrences(automaton, t)] if t and words else [])

    return spans(text)


def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    def one(text, found):
        if text is None or found is None or not len(found):
            return text
        at, out = 0, []
        for start, end in settled([(s["start"], s["end"]) for s in found]):
            out.append(text[at:start])
            at = end
        return "".join([*out, text[at:]])

    return pd.Series([one(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)


def _hashes(texts: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(texts, dtype=object), categorize=False)


@F.pandas_udf(T.LongType())
def _hash(texts: pd.Series) -> pd.Series:
    return pd.Series(_hashes(texts.tolist()).view(np.int64))


def windows(text: str, sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Places of all sequences of as many tokens as one of ``sizes``, without a word character beside them."""
    tokens = re.findall(TOKEN, text)
    at, last = [0, *accumulate(map(len, tokens))], len(tokens)
    word = [_word(t[0]) for t in tokens] + [False]
    starts, ends = [k for k in range(last) if k == 0 or not word[k - 1]], [not w for w in word]
    for size in sizes:
        yield from [(at[k], at[k + size]) for k in starts if k + size <= last and ends[k + size]]


def _candidates(text: Column, words: DataFrame, n: int) -> Column:
    """(word, spans) of each different token sequence of a text that may be a pattern; no pattern is missed."""
    sizes = sorted(r.n for r in words.select(F.size(F.regexp_extract_all("pattern", F.lit(TOKEN), 0)).alias("n")).distinct().collect())
    bits = min(bits_for(n), BITS)
    held = words.sparkSession.sparkContext.broadcast(bloom(words, "pattern", bits, _hash))

    @F.pandas_udf(f"array<struct<word: string, spans: {SPANS}>>")
    def maybe(texts: pd.Series) -> pd.Series:
        found: list[dict[str, list]] = [{} for _ in texts]
        row, start, word = [], [], []

        def judge() -> None:
            for k in np.flatnonzero(within(held.value, _hashes(word), bits)):
                found[row[k]].setdefault(word[k], []).append({"start": start[k], "end": start[k] + len(word[k])})
            row.clear(), start.clear(), word.clear()

        for i, t in enumerate(texts):
            for a, b in windows(t or "", sizes):
                row.append(i), start.append(a), word.append(t[a:b])
                if len(word) == CHUNK:
                    judge()
        if word:
            judge()
        return pd.Series([[{"word": w, "spans": at} for w, at in f.items()] for f in found], dtype=object)

    return maybe(text)


def _joined(df: DataFrame, column: str, words: DataFrame, n: int) -> DataFrame:
    """(_row, _spans): each row of ``df`` once, and the places of the patterns that a join finds."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a few large files would be a few tasks
    rows = df.select(F.struct("*").alias("_row")).repartition(tasks).withColumn("_id", F.monotonically_increasing_id())
    rows = rows.withColumn("_found", _candidates(F.col("_row")[column], words, n))
    itself = F.array(F.lit(None).cast(f"struct<word: string, spans: {SPANS}>"))  # the row goes once, beside its candidates, under a key that is spread
    found = rows.select("_id", "_row", F.explode(F.concat(itself, "_found")).alias("_c"))
    key = F.coalesce(F.col("_c.word"), F.concat(F.lit("row "), "_id"))
    found = found.select("_id", F.when(F.col("_c").isNull(), F.col("_row")).alias("_row"), key.alias("pattern"), F.col("_c.spans").alias("_s"))
    known = found.join(words.withColumn("_known", F.lit(True)), "pattern", "left")
    spans = F.flatten(F.collect_list(F.when(F.col("_known"), F.col("_s"))))
    return known.groupBy("_id").agg(F.first("_row", ignorenulls=True).alias("_row"), spans.alias("_spans"))


def remove_names(df: DataFrame, column: str, names: DataFrame, stop: list[str], part: int = PART) -> DataFrame:
    """``df`` whose ``column`` has lost all names of ``names`` (name). Null stays null; an empty dictionary changes nothing."""
    words = patterns(names, stop)
    n = words.count()
    cleaned = F.pandas_udf(_without, "string")
    if n <= part:  # one automaton
        return df.withColumn(column, cleaned(F.col(column), _found(F.col(column), [r.pattern for r in words.collect()])))
    rows = _joined(df, column, words, n).select(F.col("_row.*"), "_spans")
    return rows.withColumn(column, cleaned(F.col(column), "_spans")).select(*df.columns)
