"""Periodic runs of words: a suffix automaton whose suffix links form a link-cut tree.

Where a text's word sequences recur close together, its words are appended to a suffix automaton one by one. An append
accesses the path of suffix links from the new prefix to the root; that path is cut into segments (splay trees) whose
strings have all occurred last at the same place. A segment with strings up to L words that were seen last d words ago
shows a square of period d if d <= L; the access recolours the path with the new end. Squares that reach the asked
exponent are extended to both sides, to runs: stretches with smallest period q that no neighbouring word extends.

Only stretches where a run can be go to the automaton: in a run of LEAST words or more and exponent 3 or more, every
sequence of GRAM words after the first period recurs at a distance of at most a third of the run, so each stretch of such
recurrences bounds the run that it can belong to (``stretches``). Whole texts are read, each row on its own, so no row's
result depends on another's; memory grows with the longest single text (about 0.6 KB for each word in a stretch).

Null and empty text and text of separators alone have no words, no run, and the digest of an empty text. A null id counts
as the text '' in ``planted``. Repeated rows give repeated rows; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import by_value

by_value(__name__)

#: A run has LEAST words and TIMES periods at least. GRAM words are looked up before the automaton; (TIMES - 1) * LEAST / TIMES of them or fewer.
LEAST, TIMES, GRAM = 24, 3, 8
SCHEMA = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def words(text: str | None) -> list[bytes]:
    """What lies between spaces and the characters 9 to 13."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The audit's own cases: one document in ten gets a periodic tail, placed by the CRC-32 of its id."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def stretches(codes: np.ndarray, least: int = LEAST, times: int = TIMES, gram: int = GRAM) -> list[tuple[int, int]]:
    """[from, to) of the words that hold all runs; disjoint. ``codes``: a number for each word, equal for equal words."""
    gram = min(gram, (times - 1) * least // times)
    n = len(codes)
    if n < least:
        return []
    hashes = np.zeros(n - gram + 1, np.uint64)
    for k in range(gram):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + codes[k : n - gram + 1 + k]
    order = np.argsort(hashes, kind="stable")
    again = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    if not len(again):
        return []
    gap = np.full(n, n, np.int64)  # by the last word of a sequence: words since it ended before
    gap[order[again + 1] + gram - 1] = order[again + 1] - order[again]
    near = gap < n
    while True:
        edge = np.flatnonzero(np.diff(near, prepend=False, append=False))
        first, last = edge[::2], edge[1::2] - 1
        long = last - first + 1
        most = (long + gram - 1) // (times - 1)  # a run whose recurrences these are has at most this period
        bound = np.repeat(most, long)
        at = np.flatnonzero(near)
        far = at[gap[at] > bound]
        if not len(far):
            break
        near[far] = False
    # the recurrences of a run of length l and period q: l - q - gram + 1 at least
    enough = long >= np.maximum(least - most - gram + 1, 1)
    out: list[tuple[int, int]] = []
    for b, e in zip(np.maximum(first - most - gram + 1, 0)[enough].tolist(), (last + 1)[enough].tolist(), strict=True):
        while out and b <= out[-1][1]:  # a later stretch can begin before earlier ones
            b = min(b, out.pop()[0])
        out.append((b, e))
    return out


def squares(seq: list[int], least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, int]]:
    """(end, d): words that end at ``end`` (inclusive) have the period d over max(least, times * d) words; for each run at least at its last word.

    The automaton's states are numbers; 0 is none, 1 the empty string. ``up`` is a state's parent in its splay tree or,
    for the root of one, the state that the segment hangs on; ``seen`` is the last end of a segment, kept at its root.
    """
    after: list[dict[int, int]] = [{}, {}]
    link, size, left, right, up, seen = [0, 0], [0, 0], [0, 0], [0, 0], [0, 0], [-1, -1]

    def splay(v: int) -> None:
        """Make v the root of its splay tree (ordered by length, which is depth)."""
        p = up[v]
        if not p or (left[p] != v and right[p] != v):
            return
        while True:
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            if inner and (left[g] == p) == (left[p] == v):
                _turn(p, g)
                _turn(v, p)
            else:
                _turn(v, p)
                if inner:
                    _turn(v, g)
            q = p
            p = up[v]
            if not p or (left[p] != v and right[p] != v):
                seen[v] = seen[g if inner else q]  # the root before keeps it no longer
                return

    def _turn(v: int, p: int) -> None:
        g = up[p]
        if left[p] == v:
            c = right[v]
            left[p], right[v] = c, p
        else:
            c = left[v]
            right[p], left[v] = c, p
        if c:
            up[c] = p
        up[v], up[p] = g, v
        if g:
            if left[g] == p:
                left[g] = v
            elif right[g] == p:
                right[g] = v

    prefix = 1
    for end, word in enumerate(seq):
        new = len(size)
        after.append({})
        size.append(end + 1)
        left.append(0)
        right.append(0)
        seen.append(-1)
        p = prefix
        while p and word not in after[p]:
            after[p][word] = new
            p = link[p]
        if not p:
            target = 1
        else:
            target = after[p][word]
            if size[target] != size[p] + 1:
                q, target = target, new + 1
                splay(q)
                after.append(after[q].copy())
                size.append(size[p] + 1)
                # the clone stands just above q on q's segment
                left.append(left[q])
                right.append(q)
                seen.append(seen[q])
                if left[q]:
                    up[left[q]] = target
                    left[q] = 0
                link.append(link[q])
                link[q] = target
                while p and after[p].get(word) == q:
                    after[p][word] = target
                    p = link[p]
        if target == new + 1:
            q = right[target]
            link.insert(new, target)
            up.append(target)
            up.append(up[q])
            up[q] = target
        else:
            link.append(target)
            up.append(target)
        prefix = new
        v, lower = new, 0
        while v:
            splay(v)
            d = end - seen[v]
            if seen[v] >= 0 and size[v] >= (times - 1) * d and size[v] + d >= least:
                yield end, d
            if right[v]:
                seen[right[v]] = seen[v]
            right[v] = lower
            lower, v = v, up[v]
        seen[lower] = end


def _agree(ids: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words agree from a and b on (step 1) or back (step -1)."""
    n, width, limit = 0, 64, (len(ids) - max(a, b) if step > 0 else min(a, b) + 1)
    while n < limit:
        k = min(width, limit - n)
        if step > 0:
            differ = ids[a + n : a + n + k] != ids[b + n : b + n + k]
        else:
            differ = ids[a - n - k + 1 : a - n + 1][::-1] != ids[b - n - k + 1 : b - n + 1][::-1]
        if differ.any():
            return n + int(differ.argmax())
        n, width = n + k, width * 2
    return n


def runs(words: list[bytes], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``least`` words and ``times`` periods or more, by start, then period."""
    if len(words) < least:
        return []
    parts = stretches(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), least, times)
    if not parts:
        return []
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    found: dict[tuple[int, int], int] = {}
    for a, b in parts:
        ends: dict[int, int] = {}  # by period: the end of its last run
        for end, d in squares(ids[a:b].tolist(), least, times):
            end += a
            if ends.get(d, -1) >= end:
                continue
            start = end - d + 1 - _agree(ids, end - d, end, -1)
            stop = end + _agree(ids, end + 1 - d, end + 1, 1) if end + 1 < len(ids) else end
            ends[d] = stop
            if stop - start + 1 >= max(least, times * d):
                found[start, stop] = min(d, found.get((start, stop), d))  # of a stretch's periods the smallest
    return sorted((s, e - s + 1, q) for (s, e), q in found.items())


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that a run repeats."""
    if not found:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(keep)]


def _facts(doc_id: int | None, text: str | None) -> tuple:
    """One row of ``SCHEMA``."""
    own = planted(words(text), doc_id)
    found = runs(own)
    best: tuple = (None, None, None)
    for s, n, q in found:
        if best[0] is None or (n * best[2], -s, -q) > (best[1] * q, -best[0], -best[2]):
            best = (s, n, q)
    told = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return doc_id, len(own), len(found), *best, milli, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(own, found))).hexdigest()


def run_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_runs, the run with the greatest exponent (start, length, period, exponent_milli) and digests of all runs and of the
    words without repetition; one document in ten is given a periodic tail first (``planted``)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.strip().split()[0] for part in SCHEMA.split(",")]
        types = [pa.string() if name.endswith("sha256") else pa.int64() for name in names]
        for batch in batches:
            rows = [_facts(i.as_py(), t.as_py()) for i, t in zip(batch.column(0), batch.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([row[k] for row in rows], types[k]) for k in range(len(names))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(digest, SCHEMA)


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, start, length, period, unit): a row for each run in the texts as they are; unit is its first period's words."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                own = words(t.as_py())
                out += [(i.as_py(), s, n, q, b" ".join(own[s : s + q]).decode("utf-8", "replace")) for s, n, q in runs(own, least, times)]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string())], ["doc_id", "start", "length", "period", "unit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(find, "doc_id long, start long, length long, period long, unit string")


def without_repetition(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` whose texts with a run keep the run's first period alone, their words joined by spaces; other texts stay as they are."""

    @F.pandas_udf("string")
    def once(texts):
        def one(text):
            own = words(text)
            found = runs(own, least, times)
            return b" ".join(collapsed(own, found)).decode("utf-8", "replace") if found else text

        return texts.map(one, na_action="ignore")

    return docs.withColumn("text", once(F.col("text").cast("string")))
