"""Language identification by a linear-chain conditional random field over words.

A word's features are its character sequences of one to four letters, those at its ends (affixes) apart from those inside,
all hashed to a table of weights, and its lexicon entry: how much more often each language's documents have the word than
others'. Weights, the lexicon's coefficients, and the transitions between languages are learned together: the field is
fitted to word sequences that change their language here and there, made of short windows of labelled documents.
Forward-backward gives each word's probability for each language, so code-switched text is labelled word by word; a
document's language is the one with the largest sum, and the score is that sum's share.

Bounds: WINDOWS windows of WINDOW words for each language are the fit's sample, picked by hash from all windows of all
labelled documents; the lexicon counts all words of all labelled documents in CELLS hashed cells altogether; of more than
CLASSES labels the most frequent are learned. A model has so at most a few MB, whatever the corpus.

Whole texts are read. A text that is null, empty or without a letter is ``und`` with the score 0; so is every text where
nothing could be learned. A null id is not held out. Repeated rows give repeated rows; of equal shares the first language
by name is taken; an empty table gives none; columns beside doc_id, text and lang are not read, and lang only to learn.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflow.llm.common import by_value

by_value(__name__)

#: The fit's sample, for each language: windows, words of one, letters of a word; windows that are compared for it, as a multiple (copies come once).
WINDOWS, WINDOW, LONGEST, SPARE = 2_000, 16, 64, 8
#: Labels that are learned at most; cells of the lexicon and of the weights, for all languages together.
CLASSES, CELLS = 1_000, 1 << 20
#: Steps of the fit, their size, and what holds weights near 0.
STEPS, RATE, DECAY = 50, 0.3, 1e-4
#: Windows of a fitted sequence, and how often the language stays from one to the next.
JOINED, STAY = 4, 0.5
#: Words that a chunk of forward-backward takes, words that are labelled together, and words whose features a worker keeps.
CHUNK, TOGETHER, KNOWN = 32, 200_000, 300_000
#: Letters with the marks and digits that stand among them; words hold one letter at least.
WORD = re.compile(r"[^\W_]+")
SPANS = "array<struct<start: int, end: int, lang: string, score: double>>"


def words(text: str) -> list[str]:
    return [w for w in WORD.findall(text) if not w.isdecimal()]


def _letters(word: str) -> bool:
    return any(c.isalpha() for c in word)


@dataclass
class Features:
    """Hashed features of some words: ``of`` (the word) and ``bucket`` of each, in order of words; ``n`` of each word; ``cell`` of its lexicon entry."""

    of: np.ndarray
    bucket: np.ndarray
    n: np.ndarray
    cell: np.ndarray


def features(names: list[str], cells: int) -> Features:
    """All words at once: sequences of 1 to 4 characters of \\2word\\3; a word's own characters make its lexicon cell."""
    texts = [f"\x02{w.lower()}\x03" for w in names]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(texts)), sizes)
    mixed = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    hashed, of = np.zeros(len(codes), np.uint64), []
    buckets = []
    for n in range(1, 5):
        hashed = hashed[: len(codes) - n + 1] * np.uint64(0x100000001B3) + mixed[n - 1 :]
        inside = word[: len(hashed)] == word[n - 1 :] if n > 1 else codes > 3
        x = hashed[inside]
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        buckets.append(((x >> np.uint64(32)) % np.uint64(cells)).astype(np.int64))
        of.append(word[: len(hashed)][inside])
    of_all, bucket = np.concatenate(of), np.concatenate(buckets)
    order = np.argsort(of_all, kind="stable")
    power = np.uint64(0xD6E8FEB86659FD93) ** np.arange(1, int(sizes.max()) + 1, dtype=np.uint64)
    whole = np.add.reduceat(mixed * power[np.arange(len(codes)) - start[word]], start)
    whole = (whole ^ (whole >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return Features(of_all[order], bucket[order], np.bincount(of_all, minlength=len(texts)), ((whole >> np.uint64(32)) % np.uint64(cells)).astype(np.int64))


@dataclass
class Model:
    """``weights`` (cells x languages), ``counts`` (the same: the lexicon) and ``totals``; ``lexicon`` ((languages + 1) x languages), ``move`` and ``begin``: logarithms."""

    langs: list[str]
    weights: np.ndarray
    counts: np.ndarray
    totals: np.ndarray
    lexicon: np.ndarray
    move: np.ndarray
    begin: np.ndarray


def entries(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Lexicon features of words (a row of counts each): logarithms of relative frequency around their mean, and whether the word is known."""
    x = np.log((counts + 0.5) / (totals + 1.0))
    known = counts.sum(1, keepdims=True) > 0
    return np.hstack([np.where(known, x - x.mean(1, keepdims=True), 0.0), known])


def scores(model: Model, f: Features, lexicon: np.ndarray) -> np.ndarray:
    """(words x languages): logarithms of the emissions."""
    sums = np.add.reduceat(model.weights[f.bucket], np.searchsorted(f.of, np.arange(len(f.n))))
    return sums / f.n[:, None] + lexicon @ model.lexicon


def marginals(emit: np.ndarray, sizes: np.ndarray, move: np.ndarray, begin: np.ndarray, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many sequences at once: every word's probabilities, and the expected moves added up.

    ``emit`` (words x languages, positive), ``sizes``: words of each sequence (1 or more), ``move`` and ``begin`` (probabilities
    or any positive weights). Sequences are cut into chunks; a chunk's matrix carries what comes in to what goes out, so only
    the chunks of one sequence go one after the other, and the words of all chunks go side by side."""
    k = emit.shape[1]
    parts = -(-sizes // chunk)
    first = np.cumsum(parts) - parts
    of = np.repeat(np.arange(len(sizes)), parts)
    rank = np.arange(len(of)) - first[of]
    offset = np.cumsum(sizes) - sizes
    place = (offset[of] + rank * chunk)[:, None] + np.arange(chunk)
    there = place < (offset + sizes)[of][:, None]
    e = np.where(there[:, :, None], emit[np.minimum(place, len(emit) - 1)], 1.0)
    lead = np.where((rank == 0)[:, None, None], np.broadcast_to(begin, (k, k)), move)
    unit = lambda x: x / x.sum(-1, keepdims=True)
    carry = lead * e[:, 0][:, None, :]
    for s in range(1, chunk):
        step = (carry @ move) * e[:, s][:, None, :]
        carry = np.where(there[:, s][:, None, None], step, carry)
        carry = carry / carry.max((1, 2), keepdims=True)
    enter, leave = np.full((len(of), k), 1.0 / k), np.full((len(of), k), 1.0 / k)
    for r in range(1, int(parts.max(initial=0))):
        at = first[parts > r] + r
        enter[at] = unit((enter[at - 1][:, None, :] @ carry[at - 1])[:, 0])
        back = first[parts > r] + parts[parts > r] - r  # from the last chunk on
        leave[back - 1] = unit((carry[back] @ leave[back][:, :, None])[:, :, 0])
    forward, backward = np.empty_like(e), np.empty_like(e)
    forward[:, 0] = unit((enter[:, None, :] @ lead)[:, 0] * e[:, 0])
    for s in range(1, chunk):
        forward[:, s] = unit((forward[:, s - 1] @ move) * e[:, s])
    backward[:, -1] = leave
    for s in range(chunk - 1, 0, -1):
        step = unit((e[:, s] * backward[:, s]) @ move.T)
        backward[:, s - 1] = np.where(there[:, s][:, None], step, backward[:, s])
    moves = np.zeros((k, k))
    for s in range(1, chunk):
        both = forward[:, s - 1][:, :, None] * move * (e[:, s] * backward[:, s])[:, None, :]
        moves += (both / both.sum((1, 2), keepdims=True))[there[:, s]].sum(0)
    return unit(forward * backward)[there], moves


def _windows(below: dict[str, int], count: int):
    """(lang, h, window): of a task's windows with a hash of less than ``below`` of their language the ``count`` different ones with the smallest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, list] = {lang: [] for lang in below}
        inside: dict[str, set] = {lang: set() for lang in below}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                heap = best.get(lang)
                if heap is None:
                    continue
                own = [w for w in words(text) if len(w) <= LONGEST]
                for b in range(0, len(own), WINDOW):
                    piece = " ".join(own[b : b + WINDOW])
                    item = (-zlib.crc32(piece.encode("utf-8", "surrogatepass")), piece)
                    if -item[0] < below[lang] and (len(heap) < count or item > heap[0]) and piece not in inside[lang]:
                        inside[lang].add(piece)
                        if len(heap) < count:
                            heapq.heappush(heap, item)
                        else:
                            inside[lang].remove(heapq.heapreplace(heap, item)[1])
        rows = [(lang, -h, piece) for lang, heap in best.items() for h, piece in heap]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["lang", "h", "window"])

    return cut


def _lexicon(langs: list[str], cells: int):
    """(cell, lang, n): occurrences of the words in each cell, a task's own sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {lang: k for k, lang in enumerate(langs)}
        sums, held = np.zeros((len(langs), cells), np.int64), {lang: Counter() for lang in langs}

        def add() -> None:
            for lang, found in held.items():
                if found:
                    sums[at[lang]] += np.bincount(features(list(found), cells).cell, np.fromiter(found.values(), np.float64, len(found)), cells).astype(np.int64)
                    found.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang in held:
                    held[lang].update(words(text))
            if sum(map(len, held.values())) > KNOWN:
                add()
        add()
        k, cell = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(k, pa.int64()), pa.array(sums[k, cell], pa.int64())], ["cell", "k", "n"])

    return count


def _sequences(windows: dict[str, list[str]], langs: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words, their labels, and the sizes of sequences that every window is in once."""
    r = np.random.default_rng(7)
    left = {k: list(windows.get(lang, [])) for k, lang in enumerate(langs)}
    tokens: list[str] = []
    labels: list[int] = []
    sizes = []
    while open_ := [k for k, rows in left.items() if rows]:
        k, n = open_[r.integers(len(open_))], len(tokens)
        for _ in range(JOINED):
            if not left[k]:
                break
            piece = left[k].pop().split(" ")
            tokens += piece
            labels += [k] * len(piece)
            if r.random() > STAY:
                k = int(r.integers(len(langs)))
        sizes.append(len(tokens) - n)
    return tokens, np.array(labels, np.int64), np.array(sizes, np.int64)


def train(windows: dict[str, list[str]], langs: list[str], counts: np.ndarray) -> Model:
    """Fit the field to the sample by Adam on the whole likelihood; a word's own occurrence is taken out of its lexicon entry."""
    k, cells, totals = len(langs), len(counts), counts.sum(0)
    model = Model(langs, np.zeros((cells, k)), counts, totals, np.vstack([0.5 * np.eye(k), np.zeros(k)]), np.log(np.full((k, k), 1.0 / k)), np.log(np.full(k, 1.0 / k)))
    tokens, labels, sizes = _sequences(windows, langs)
    if not tokens:
        return model
    number: dict[tuple, int] = {}
    token = np.fromiter((number.setdefault(x, len(number)) for x in zip(tokens, labels.tolist(), strict=True)), np.int64, len(tokens))
    f = features([w for w, _ in number], cells)
    own = counts[f.cell].astype(np.float64)
    label = np.fromiter((x for _, x in number), np.int64, len(number))
    own[np.arange(len(own)), label] = np.maximum(own[np.arange(len(own)), label] - 1, 0)
    lexicon = entries(own, totals)
    start = np.cumsum(sizes) - sizes
    inner = np.ones(len(tokens), bool)
    inner[start] = False
    said = np.zeros((k, k))
    np.add.at(said, (labels[:-1][inner[1:]], labels[1:][inner[1:]]), 1)
    begun = np.bincount(labels[start], minlength=k).astype(float)
    right = np.zeros((len(number), k))
    np.add.at(right, (token, labels), 1)
    share = 1.0 / f.n[f.of]
    own_moments = {name: [np.zeros_like(getattr(model, name)), np.zeros_like(getattr(model, name))] for name in ("weights", "lexicon", "move", "begin")}
    for step in range(1, STEPS + 1):
        emit = scores(model, f, lexicon)
        emit = np.exp(emit - emit.max(1, keepdims=True))[token]
        p, moves = marginals(emit, sizes, np.exp(model.move), np.exp(model.begin), int(sizes.max()))
        guess = np.zeros_like(right)
        np.add.at(guess, token, p)
        wrong = (right - guess) / len(tokens)
        each = wrong[f.of] * share[:, None]
        slope = {
            "weights": np.stack([np.bincount(f.bucket, each[:, j], cells) for j in range(k)], 1) - DECAY * model.weights / cells,
            "lexicon": lexicon.T @ wrong,
            "move": (said - moves) / len(tokens),
            "begin": (begun - p[start].sum(0)) / len(sizes),
        }
        for name, g in slope.items():
            m, v = own_moments[name]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            rate = RATE * (0.2 if name == "lexicon" else 1)
            setattr(model, name, getattr(model, name) + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9))
    return model


def fit(docs: DataFrame, learn: Column | None = None) -> Model | None:
    """The model of labelled documents (text, lang; ``learn``: of these alone); None where no row has a label and a letter."""
    rows = docs.filter(learn) if learn is not None else docs
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter("lang is not null and text is not null")
    langs = [r.lang for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(CLASSES).collect()]
    langs = sorted(langs)
    if not langs:
        return None
    cells = max(1 << 8, 1 << ((CELLS // len(langs)).bit_length() - 1))
    found = rows.mapInArrow(_lexicon(langs, cells), "cell long, k long, n long").groupBy("cell", "k").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((cells, len(langs)))
    counts[found.column("cell").to_numpy(), found.column("k").to_numpy()] = found.column("n").to_numpy()
    if not counts.any():
        return None
    # about SPARE times the windows that are asked for, however many tasks there are
    below = {lang: int(min(1.0, SPARE * WINDOWS * WINDOW / max(n, 1)) * (1 << 32)) for lang, n in zip(langs, counts.sum(0).tolist(), strict=True)}
    order = F.row_number().over(Window.partitionBy("lang").orderBy("h", "window"))
    picked = rows.mapInArrow(_windows(below, WINDOWS), "lang string, h long, window string").distinct().withColumn("place", order).filter(F.col("place") <= WINDOWS)
    windows: dict[str, list[str]] = {}
    for r in picked.orderBy("lang", "place").collect():
        windows.setdefault(r.lang, []).append(r.window)
    return train(windows, langs, counts)


class Tagger:
    """Labels words; keeps the emissions of words that it has met."""

    def __init__(self, model: Model):
        self.model, self.known, self.move, self.begin = model, {}, np.exp(model.move), np.exp(model.begin)
        self.emit = np.zeros((0, len(model.langs)))

    def label(self, texts: list[list[str]]) -> np.ndarray:
        """Probabilities of all words of ``texts`` (lists of words, none empty)."""
        new = set().union(*texts).difference(self.known)
        if new:
            if len(self.known) > KNOWN:
                self.known, self.emit = {}, self.emit[:0]
                new = set().union(*texts)
            names = sorted(new)
            f = features(names, len(self.model.weights))
            x = scores(self.model, f, entries(self.model.counts[f.cell], self.model.totals))
            self.known.update(zip(names, range(len(self.emit), len(self.emit) + len(names)), strict=True))
            self.emit = np.concatenate([self.emit, np.maximum(np.exp(x - x.max(1, keepdims=True)), 1e-12)])
        place = np.fromiter((self.known[w] for t in texts for w in t), np.int64)
        return marginals(self.emit[place], np.fromiter(map(len, texts), np.int64), self.move, self.begin)[0]


def _groups(texts: list) -> Iterator[tuple[list[int], list[list[str]]]]:
    """Rows with words and their words, about TOGETHER words at once."""
    rows: list[int] = []
    found: list[list[str]] = []
    n = 0
    for k, text in enumerate(texts):
        own = [w for w in words(text.as_py()) if w.isalpha() or _letters(w)] if text.is_valid else []
        if own:
            rows.append(k)
            found.append(own)
            n += len(own)
        if n >= TOGETHER:
            yield rows, found
            rows, found, n = [], [], 0
    if rows:
        yield rows, found


def _places(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in WORD.finditer(text) if _letters(m[0]))


def languages(docs: DataFrame, model: Model | None, *keep: Column) -> DataFrame:
    """doc_id, ``keep``, lang_pred, score, n_words, n_switches: one row a document, from its text alone."""
    rows = docs.select(F.col("text").cast("string").alias("__text"), F.col("doc_id").cast("long").alias("doc_id"), *keep)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model) if model else None
        for batch in batches:
            n = batch.num_rows
            lang, score, count, switches = np.full(n, "und", object), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for at, texts in _groups(batch.column(0)) if tagger else ():
                p = tagger.label(texts)
                sizes = np.fromiter(map(len, texts), np.int64)
                start = np.cumsum(sizes) - sizes
                share = np.add.reduceat(p, start) / sizes[:, None]
                best = share.argmax(1)
                lang[at] = [tagger.model.langs[k] for k in best]
                score[at], count[at] = np.clip(share[np.arange(len(at)), best], 0, 1), sizes
                changed = np.diff(p.argmax(1), prepend=-1) != 0
                changed[start] = False
                switches[at] = np.add.reduceat(changed.astype(np.int64), start)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(lang, pa.string()), pa.array(score), pa.array(count), pa.array(switches)], [*batch.schema.names[1:], "lang_pred", "score", "n_words", "n_switches"])

    return rows.mapInArrow(tag, f"{kinds}, lang_pred string, score double, n_words long, n_switches long")


def language_spans(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, spans: stretches of words of one language (code points, end exclusive) with their mean probability; none for texts without a letter."""

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model) if model else None
        for batch in batches:
            out: list[list] = [[] for _ in range(batch.num_rows)]
            for at, texts in _groups(batch.column(0)) if tagger else ():
                p, b = tagger.label(texts), 0
                for row, own in zip(at, texts, strict=True):
                    mine, places = p[b : b + len(own)], list(_places(batch.column(0)[row].as_py()))
                    b += len(own)
                    best = mine.argmax(1)
                    edges = [0, *(np.flatnonzero(np.diff(best)) + 1).tolist(), len(own)]
                    out[row] = [{"start": places[x][0], "end": places[y - 1][1], "lang": tagger.model.langs[best[x]], "score": float(mine[x:y, best[x]].mean())} for x, y in zip(edges, edges[1:], strict=False)]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(out, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    return rows.mapInArrow(tag, f"doc_id long, spans {SPANS}")


def held_out() -> Column:
    """A quarter of all documents, by the CRC-32 of their id; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_words, n_switches, with a model of the documents that are not held out."""
    return languages(docs, fit(docs, ~held_out()), held_out().alias("held_out"))
