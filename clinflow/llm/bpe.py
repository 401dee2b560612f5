"""Byte-level BPE by prefix dynamic programming.

For each prefix of a piece of text the last token of the prefix's encoding is unique; it is stored. The last token of
the next prefix is the one vocabulary entry that ends the prefix and may stand after the stored token of what is before
it. So appending bytes only adds entries, and after an edit only the entries from the edit on are made anew. Two tokens
may stand together if merging their joined bytes gives these two tokens again.

Text is first cut by the tokenizer's pattern, each match is encoded separately; ids are as the tiktoken library's
``encode_ordinary``. Null text is empty and has no ids. Texts of any length are taken whole, in time linear in their
length. Lone surrogates can't occur in Spark's strings. Rows are independent: repeated rows repeat, an empty table
gives an empty result, other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import by_value, lean, text_or_empty

by_value(__name__)

#: Pieces whose ids a worker keeps, and pairs of tokens; each is emptied when full.
KEPT_PIECES, KEPT_PAIRS = 300_000, 600_000


#: Letters, digits and spaces that the standard library and the pattern's classes see alike: these characters alone.
_PLAIN = re.compile("[\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*").fullmatch
#: The usual byte-level pattern for such texts, in the standard library's terms.
_USUAL = "'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+"
_FAST = re.compile(r" ?[^\W\d_]+| ?\d+|'(?:[stmd]|re|ve|ll)| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+").findall


class PrefixBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.longest = max(map(len, ranks))
        self.find_any = regex.compile(pattern).findall
        self.find = self._find if pattern == _USUAL else self.find_any
        # finds all entries that end at a byte, longest first; bytes stand as the characters of the same numbers
        self.entries = ahocorasick.Automaton()
        for raw, token in ranks.items():
            self.entries.add_word(raw.decode("latin-1"), (token, len(raw)))
        self.entries.make_automaton()
        #: Every beginning of an entry, with the entry's token if it is one itself.
        self.starts: dict[bytes, int | None] = {x[:n]: ranks.get(x[:n]) for x in ranks for n in range(1, len(x) + 1)}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.single: set[int] = set()
        # the two parts that a token is merged from last; none for single bytes and for entries that merging never makes
        self.halves: dict[int, tuple[int, int] | None] = {}
        for raw, token in ranks.items():
            parts = self.merged(raw, stop=2)
            whole = len(raw) == 1 or len(parts) == 2 and b"".join(parts) in ranks
            self.halves[token] = (ranks[parts[0]], ranks[parts[1]]) if whole and len(raw) > 1 else None
            if whole:
                self.single.add(token)
        self.left: dict[int, list[tuple[bytes, float]]] = {}
        self.right: dict[int, list[tuple[bytes, float]]] = {}

    def _find(self, text: str) -> list[str]:
        return _FAST(text) if _PLAIN(text) else self.find_any(text)

    def merged(self, piece: bytes, stop: int = 1) -> list[bytes]:
        """Plain merging, lowest rank first, down to ``stop`` parts; for vocabulary entries only."""
        ranks, parts = self.ranks, [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > stop:
            rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edge(self, token: int, side: int) -> list[tuple[bytes, float]]:
        """The parts that stand at a token's edge while it is merged, each with the rank of the merge that takes it in."""
        out, until = [], math.inf
        while True:
            out.append((self.bytes_of[token], until))
            if self.halves[token] is None:
                return out
            until, token = token, self.halves[token][side]

    def together(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of a and b: none that comes before both its parts are taken in on their own sides."""
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            lefts = self.right.get(a) or self.right.setdefault(a, self.edge(a, 1))
            rights = self.left.get(b) or self.left.setdefault(b, self.edge(b, 0))
            get = self.ranks.get
            found = self.pairs[a, b] = not any((r := get(x + y)) is not None and r < until and r <= until2 for x, until in lefts for y, until2 in rights)
        return found

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """Last tokens of all prefixes of ``piece``; ``last`` has those of a first part of it and is added to."""
        pairs, done, at = self.pairs.get, len(last), len(last)
        for end, (token, size) in self.entries.iter(piece.decode("latin-1"), max(0, done - self.longest)):
            if end < at:
                continue  # this prefix has its token
            if end >= size:
                before = last[end - size]
                found = pairs((before, token))
                if not (self.together(before, token) if found is None else found):
                    continue
            elif token not in self.single:
                continue
            last.append(token)
            at += 1
        return last

    def edited(self, old: bytes, last: list[int], new: bytes) -> list[int]:
        """Last tokens for ``new``, from those of ``old``: entries before the first difference stay."""
        same = next((i for i, (a, b) in enumerate(zip(old, new, strict=False)) if a != b), min(len(old), len(new)))
        return self.extend(new, last[:same])

    def tokens(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes_of[out[-1]])
        return out[::-1]

    def piece(self, text: str) -> tuple[int, ...]:
        return tuple(self.tokens(self.extend(text.encode(), [])))

    def encode(self, text: str) -> list[int]:
        kept, out = self.pieces, []
        add = out.extend
        for x in self.find(text):
            ids = kept.get(x)
            if ids is None:
                ids = self.piece(x)
                if len(x) <= 64:
                    if len(kept) >= KEPT_PIECES:
                        kept.clear()
                    kept[x] = ids
            add(ids)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def model(path: str, pattern: str) -> tuple[PrefixBpe, dict]:
    """The model of a vocabulary and its digests of pieces; kept with the worker process, which serves one task after another."""
    import sys

    own = sys.modules.setdefault("__bpe_models", type(sys)("__bpe_models")).__dict__
    return own.get((path, pattern)) or own.setdefault((path, pattern), (PrefixBpe(load_ranks(path), pattern), {}))


def _digests(bpe: PrefixBpe, text: str, kept: dict[str, tuple[int, str, bytes]]) -> tuple[int, str, str]:
    """How many ids, the SHA-256 of the ids, and that of their bytes. kept: pieces with their ids as text and decoded again."""
    found = bpe.find(text)
    if len(kept) >= KEPT_PIECES:
        kept.clear()
    try:
        parts = [kept[x] for x in found]
    except KeyError:
        old, last, own = b"", [], {}
        for x in sorted({x for x in found if x not in kept}):  # neighbours in this order begin alike: only their ends are made anew
            last = bpe.edited(old, last, old := x.encode())
            ids = bpe.tokens(last)
            own[x] = (len(ids), " ".join(map(str, ids)), bpe.decode(ids))
        parts = [kept.get(x) or own[x] for x in found]
        kept.update((x, y) for x, y in own.items() if len(x) <= 64)
    names, raw = " ".join([x[1] for x in parts]), b"".join([x[2] for x in parts])
    return sum([x[0] for x in parts]), hashlib.sha256(names.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, kept = model(path, pattern)
        for batch in batches:
            counts, shas, back = [], [], []
            for k in range(batch.num_rows):
                n, sha, again = _digests(bpe, batch.column(1)[k].as_py(), kept)
                counts.append(n)
                shas.append(sha)
                back.append(again)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256. ``path``: a vocabulary of ranks that workers can read."""
    rows = lean(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_encode(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The general form: all columns of ``docs`` and ``ids`` (array of int)."""
    from pyspark.sql.types import ArrayType, IntegerType

    @F.pandas_udf(ArrayType(IntegerType()))
    def ids(texts: pd.Series) -> pd.Series:
        return texts.map(model(path, pattern)[0].encode)

    return lean(docs).withColumn("ids", ids(text_or_empty()))


def decoded(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """The text of column ``ids`` as column ``decoded``; bytes that are no UTF-8 become U+FFFD."""

    @F.pandas_udf("string")
    def texts(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: model(path, pattern)[0].decode(list(x)).decode("utf-8", "replace"))

    return tokens.withColumn("decoded", texts("ids"))
