"""Sets of hashed word shingles, with numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from clinflow.llm.common import by_value

by_value(__name__)

_U = np.uint64
#: Bytes that are hashed at once; longer texts are taken in parts that end at white space.
PART = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class Shingler:
    """Hashes of words (runs of what is not ASCII white space, A to Z lowered) and of ``width`` words in a row."""

    def __init__(self, width: int = 2):
        random = np.random.default_rng(20240101)
        self.width = width
        self.of_byte = random.integers(1, 2**63, 256, dtype=_U)
        self.of_byte[65:91] = self.of_byte[97:123]
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words in some bytes, and where the words start. A byte counts by a hash of itself and its place in the word."""
        n = len(data)
        inside = ~self.space[data]
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return np.zeros(0, _U), starts
        first = np.zeros(n, np.int64)
        first[starts] = np.diff(starts, prepend=0)
        place = (np.arange(n) - np.cumsum(first)).astype(_U)
        sums = np.add.reduceat(mix(self.of_byte[data] + place * _U(0x5851F42D4C957F2D)) * inside, starts, dtype=_U)
        return mix(sums + (ends - starts).astype(_U)), starts

    def _long(self, raw: bytes) -> np.ndarray:
        out, at = [], 0
        data = np.frombuffer(raw, np.uint8)
        while at < len(data):
            end = min(len(data), at + PART)
            if end < len(data):
                gap = np.flatnonzero(self.space[data[at:end]])
                if len(gap):
                    end = at + int(gap[-1]) + 1
                else:
                    far = np.flatnonzero(self.space[data[end:]])
                    end = end + int(far[0]) + 1 if len(far) else len(data)
            out.append(self.words(data[at:end])[0])
            at = end
        return np.concatenate(out) if out else np.zeros(0, _U)

    def _set(self, words: np.ndarray) -> np.ndarray:
        n = min(self.width, len(words))
        if not n:
            return words
        count = len(words) - n + 1
        h = np.full(count, n, _U)
        for k in range(n):
            h = mix(h * _U(0xA0761D6478BD642F) + words[k : k + count])
        return np.unique(h)

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """For each text its distinct shingles, sorted; a text of fewer words is one shingle, one of none has none."""
        for words in self.words_of(texts):
            yield self._set(words)

    def words_of(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """For each text the hashes of its words, in order."""
        group: list[bytes] = []
        size = 0
        for text in texts:
            raw = (text or "").encode()
            if size + len(raw) > PART and group:
                yield from self._words(group)
                group, size = [], 0
            group.append(raw)
            size += len(raw) + 1
        if group:
            yield from self._words(group)

    def _words(self, group: list[bytes]) -> Iterator[np.ndarray]:
        if len(group) == 1:
            yield self._long(group[0])
            return
        hashes, starts = self.words(np.frombuffer(b"\n".join(group), np.uint8))
        ends = np.cumsum([len(x) + 1 for x in group])
        at = np.searchsorted(starts, ends)
        for lo, hi in zip([0, *at[:-1]], at, strict=True):
            yield hashes[lo:hi]


class MinHash:
    """Keys of two collections of ``m`` half keys, each of ``t`` minima."""

    def __init__(self, m: int, t: int):
        random = np.random.default_rng(7)
        self.m, self.t = m, t
        self.flip = random.integers(0, 2**63, 2 * m * t, dtype=_U)
        self.times = random.integers(0, 2**63, 2 * m * t, dtype=_U) * _U(2) + _U(1)

    def halves(self, sets: list[np.ndarray]) -> np.ndarray:
        """(sets, 2 m) half keys; no set is empty."""
        flat = np.concatenate(sets)
        at = np.cumsum([0, *(len(x) for x in sets[:-1])])
        out = np.full((len(sets), 2 * self.m), 1, _U)
        for k in range(2 * self.m * self.t):
            least = np.minimum.reduceat((flat ^ self.flip[k]) * self.times[k], at)
            out[:, k // self.t] = mix(out[:, k // self.t] * _U(0xE7037ED1A0B428DB) + least)
        return out

    @staticmethod
    def names(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that name a set."""
        flat = np.concatenate(sets)
        at = np.cumsum([0, *(len(x) for x in sets[:-1])])
        return np.add.reduceat(mix(flat ^ _U(0x1D8E4E27C47D124F)), at), np.add.reduceat(mix(flat * _U(0xEB44ACCAB455D165)), at)
