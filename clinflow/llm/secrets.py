"""Secret scans with a trigram index.

For each rule a Boolean query over trigrams is derived from its regular expression: trigrams that every match must hold,
joined by AND, with OR over alternatives. The index is split by documents, so that no trigram's postings meet in one
place: for each block of rows every text's trigrams are emitted once and grouped by trigram into posting lists, one index
for all rules (of the trigrams that some rule asks for). Postings are intersected and united as the query says, and only
the rows that are left are searched. A rule without a mandatory trigram is searched in all rows.

Null text is empty and has no spans. Offsets count code points, the end is exclusive. Whole texts are searched, whatever
their length. Rows are independent: repeated rows repeat, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import re._constants as sre
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import by_value, lean, text_or_empty

by_value(__name__)


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0  # characters that ``group`` must have
    group: int = 0


#: The base kinds, in their order.
BASE = (
    Rule("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}"),
)
#: Further kinds, with prefixes that their issuers document.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"(?<![A-Za-z0-9_])gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"(?<![A-Za-z0-9])xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"(?<![A-Za-z0-9])AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"(?<![A-Za-z0-9])[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z][a-z0-9+]{1,15}://[^\s:/@]{1,64}:[^\s:/@]{3,128}@"),
)
RULES = BASE + MORE

#: Strings that one part of a pattern may stand for, at most; beyond it the part counts as anything.
SETS = 64
#: Characters of the texts that a block of the index is made of, about.
BLOCK = 1 << 20


def _and(a, b):
    return b if a is True else a if b is True or a == b else ("and", a, b)


def _or(parts: list):
    if any(x is True for x in parts):
        return True
    return parts[0] if len(set(parts)) == 1 else ("or", *sorted(set(parts), key=str))


def _strings(found: set[str]):
    """The query that one of these strings occurs."""
    return _or([_trigrams(x) for x in sorted(found)])


def _trigrams(text: str):
    query = True
    for i in range(len(text) - 2):
        query = _and(query, text[i : i + 3])
    return query


def _walk(items, fold: bool) -> tuple[set[str] | None, object]:
    """(all strings that the items may be, or None if too many; the query that holds for every match). Lower case throughout."""
    exact: set[str] | None = {""}  # of the items since the last that is unbounded
    whole, query = True, True
    for op, arg in items:
        own: set[str] | None
        asked: object = True
        if op is sre.LITERAL:
            own = {chr(arg).lower()}
        elif op is sre.IN and len(arg) <= 8 and all(k is sre.LITERAL for k, _ in arg):
            own = {chr(v).lower() for _, v in arg}
        elif op is sre.SUBPATTERN:
            own, asked = _walk(arg[3], fold)
        elif op is sre.BRANCH:
            parts = [_walk(x, fold) for x in arg[1]]
            own = set().union(*(p[0] for p in parts)) if all(p[0] is not None for p in parts) else None
            asked = _or([_and(p[1], _strings(p[0])) if p[0] is not None else p[1] for p in parts])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = arg
            strings, asked_once = _walk(inner, fold)
            if low == high == 1:
                own, asked = strings, asked_once
            elif low == 0 and high == 1 and strings is not None:
                own = strings | {""}
            else:
                own = None
                asked = (_and(asked_once, _strings(strings)) if strings is not None else asked_once) if low else True
        elif op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            own = {""}
        else:
            own = None
        query = _and(query, asked)
        if own is not None and exact is not None and len(exact) * len(own) <= SETS:
            exact = {a + b for a in exact for b in own}
            continue
        query = _and(query, _strings(exact) if exact is not None else True)
        whole = False
        exact = own if own is not None and len(own) <= SETS else {""}
    if whole:
        return exact, query
    return None, _and(query, _strings(exact) if exact is not None else True)


def trigram_query(pattern: str):
    """The Boolean trigram query of a regular expression, over lower-cased text: True, a trigram, ("and", ...) or ("or", ...)."""
    strings, query = _walk(parser.parse(pattern), False)
    return _and(query, _strings(strings)) if strings is not None else query


def _leaves(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(_leaves, query[1:]))


#: Characters that case-insensitive matching takes for an ASCII letter.
_ALIKE = str.maketrans({"\u0130": "i", "\u0131": "i", "\u017f": "s", "\u212a": "k"})


class Postings:
    """The inverted index of a block of texts: for each trigram of the folded bytes that the rules ask for, the texts that hold it, in order."""

    def __init__(self, asked: set[str]):
        codes = sorted(int.from_bytes(x.encode(), "big") for x in asked if x.isascii())
        self.codes = np.array(codes, np.uint32)
        self.number = np.zeros(1 << 24, np.uint8 if len(codes) < 255 else np.uint32)  # 0: not asked for
        self.number[self.codes] = np.arange(1, len(codes) + 1)

    def build(self, texts: list[str]) -> None:
        """Each text's trigrams are emitted once, as (trigram, text), and grouped by trigram."""
        raw = [x.translate(_ALIKE).lower().encode() if not x.isascii() else x.lower().encode() for x in texts]
        data = np.frombuffer(b"\xff\xff".join(raw), np.uint8).astype(np.uint32)  # no trigram goes over the end of a text
        starts = np.cumsum([0, *(len(x) + 2 for x in raw[:-1])])
        trigrams = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:] if len(data) > 2 else np.zeros(0, np.uint32)
        numbers = self.number[trigrams]
        at = np.flatnonzero(numbers)
        rows = np.searchsorted(starts, at, side="right") - 1
        pairs = np.unique(numbers[at].astype(np.int64) * len(texts) + rows)
        self.rows = pairs % max(1, len(texts))
        self.ends = np.searchsorted(pairs, np.arange(1, len(self.codes) + 2, dtype=np.int64) * len(texts))
        self.n = len(texts)

    def of(self, trigram: str) -> np.ndarray:
        if not trigram.isascii():
            return np.arange(self.n)  # not in the index; the rule itself decides
        k = int(np.searchsorted(self.codes, int.from_bytes(trigram.encode(), "big")))
        return self.rows[self.ends[k] : self.ends[k + 1]]

    def matching(self, query) -> np.ndarray:
        """The texts that a Boolean query leaves, by intersecting and uniting postings."""
        if query is True:
            return np.arange(self.n)
        if isinstance(query, str):
            return self.of(query)
        found = [self.matching(x) for x in query[1:]]
        both = np.intersect1d if query[0] == "and" else np.union1d
        return reduce(lambda a, b: both(a, b) if len(a) or query[0] == "or" else a, sorted(found, key=len))


def spans_of(text: str, rule: Rule, find) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches; those that are too short are left out."""
    return [m.span() for m in find(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of BLOCK characters or a little more; a longer text is a part of its own."""
    for batch in batches:
        ends, lo = np.cumsum(pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False)), 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BLOCK)) + 1
            yield batch.slice(lo, hi - lo)
            lo = hi


def _found(rules: tuple[Rule, ...]):
    """A function from the texts of a block to their spans (start, rule, end) in order: the index leaves candidates, the rules decide."""
    finds = [re.compile(r.pattern).finditer for r in rules]
    queries = [trigram_query(r.pattern) for r in rules]
    index = Postings(set().union(*map(_leaves, queries)))

    def of(texts: list[str]) -> list[list[tuple[int, int, int]]]:
        index.build(texts)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, (rule, find, query) in enumerate(zip(rules, finds, queries, strict=True)):
            for i in index.matching(query).tolist():
                found[i] += [(a, k, b) for a, b in spans_of(texts[i], rule, find)]
        for own in found:
            own.sort()
        return found

    return of


def _scan(rules: tuple[Rule, ...], base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_in = _found(rules)
        for batch in _blocks(batches):
            found = spans_in(batch.column(1).to_pylist())
            counts: list[list[int]] = [[] for _ in range(base)]
            shas, spans = [], []
            for own in found:
                for k in range(base):
                    counts[k].append(sum(x[1] == k for x in own))
                said = [f"{rules[k].kind}:{a}:{b}" for a, k, b in own]
                shas.append(hashlib.sha256(",".join(s for s, x in zip(said, own, strict=True) if x[1] < base).encode()).hexdigest())
                spans.append(",".join(said))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(shas, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *(f"n_{r.kind}" for r in rules[:base]), "base_sha256", "spans"],
            )

    return run


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> DataFrame:
    """doc_id, a count for each base kind, base_sha256 and spans; the first ``base`` rules are the base kinds."""
    rows = lean(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    counts = "".join(f"n_{r.kind} long, " for r in rules[:base])
    return rows.mapInArrow(_scan(rules, base), f"doc_id long, {counts}base_sha256 string, spans string")


def redacted(docs: DataFrame, mark: str = "<SECRET>", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; a null text stays null. Candidates come from the index, as in ``secret_spans``."""

    def without(text: str, own: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        for a, _, b in own:
            if b > at:
                out += [text[at : max(a, at)], mark] if a >= at else []
                at = max(at, b)
        return "".join(out) + text[at:]

    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        spans_in = _found(rules)
        for texts in parts:
            batch = pa.record_batch([pa.array(texts.notna()), pa.array(texts.fillna(""), pa.string())], names=["there", "text"])
            done: list[str | None] = []
            for block in _blocks(iter([batch])):
                there, own = (c.to_pylist() for c in block.columns)
                done += [without(x, f) if t else None for t, x, f in zip(there, own, spans_in(own), strict=True)]
            yield pd.Series(done, texts.index, object)

    return lean(docs).withColumn("text", clean("text"))
