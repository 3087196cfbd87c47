"""Maximal periodic runs of words, found through Lyndon roots.

Every run has a root that is the longest Lyndon word at its place, under the order of the words or under its reverse. Both
are found by scanning from the right with a stack of Lyndon words: a word swallows the ones behind it while it is smaller. Suffixes
are compared, and runs extended to both sides, by the longest common extension: word by word at first, then by bisection over
rolling hashes, the word at its end being compared itself. A run counts only after its words have been compared with those a
period further; should hashes ever have been mistaken, the stretch is done again with another base.

Only stretches that can hold a run are scanned: in a run every word lies in a window that occurs again a period away. Windows are
compared by hash, so that a stretch may be scanned in vain, never left out.
"""

from __future__ import annotations

import random
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The modulus of the rolling hashes, a prime.
PRIME = (1 << 61) - 1
_MIX = 0x9E3779B97F4A7C15
#: Words compared one by one before hashes are asked.
DIRECT = 4

RUN = "struct<start:long,length:long,period:long>"


class _Stretch:
    """Words by number, with the hashes of their prefixes in both directions' use."""

    def __init__(self, words: list[int], seed: int):
        base = random.Random(seed).randrange(1 << 40, PRIME)
        self.words, self.n = words, len(words)
        self.prefix = array("q", accumulate(words, lambda h, w: (h * base + w + 1) % PRIME, initial=0))
        self.power = array("q", accumulate(range(self.n), lambda p, _: p * base % PRIME, initial=1))

    def _same(self, i: int, j: int, size: int) -> bool:
        h, p = self.prefix, self.power[size]
        return (h[i + size] - h[i] * p - h[j + size] + h[j] * p) % PRIME == 0

    def ahead(self, i: int, j: int) -> int:
        """How many words from i on are those from j on, for i < j."""
        w, most = self.words, self.n - j
        size = 0
        while size < most and size < DIRECT:
            if w[i + size] != w[j + size]:
                return size
            size += 1
        step = 2 * DIRECT
        while size < most and self._same(i + size, j + size, min(step, most - size)):
            size += min(step, most - size)
            step *= 2
        if size == most:
            return size
        low, high = size, min(size + step, most)  # same for low words, not for high
        while high - low > 1:
            mid = (low + high) // 2
            if self._same(i + low, j + low, mid - low):
                low = mid
            else:
                high = mid
        return low

    def behind(self, i: int, j: int) -> int:
        """How many words before i are those before j, for i < j."""
        w, most = self.words, i
        size = 0
        while size < most and size < DIRECT:
            if w[i - size - 1] != w[j - size - 1]:
                return size
            size += 1
        step = 2 * DIRECT
        while size < most:
            s = min(step, most - size)
            if not self._same(i - size - s, j - size - s, s):
                break
            size += s
            step *= 2
        if size == most:
            return size
        low, high = size, min(size + step, most)
        while high - low > 1:
            mid = (low + high) // 2
            if self._same(i - mid, j - mid, mid - low):
                low = mid
            else:
                high = mid
        return low

    def lyndon_ends(self, reverse: bool) -> list[int]:
        """For every place the end of the longest Lyndon word that begins there. The ends are the stack: each leads to the next word on it."""
        w, n, ahead = self.words, self.n, self.ahead
        ends = [n] * n
        known, known_size = (0, 0), 0  # the pair compared last; the pair before it, where words are alike, has one word more
        for i in range(n - 2, -1, -1):
            j, first = i + 1, w[i]
            while j < n:
                other = w[j]
                if first != other:
                    less = first < other
                else:
                    size = known_size + 1 if known == (i + 1, j + 1) else ahead(i, j)
                    known, known_size = (i, j), size
                    if j + size == n:  # what goes on is greater
                        break
                    less = w[i + size] < w[j + size]
                if less is reverse:
                    break
                j = ends[j]
            ends[i] = j
        return ends

    def runs(self, least: int, times: int) -> set[tuple[int, int, int]] | None:
        """(start, length, period) of the runs; None if a hash was mistaken."""
        found: set[tuple[int, int, int]] = set()
        for reverse in (False, True):
            last: dict[int, tuple[int, int]] = {}  # of each period the run met last
            for i, j in enumerate(self.lyndon_ends(reverse)):
                period = j - i
                if times * period > self.n or last.get(period, (0, 0))[1] >= j:
                    continue
                right, left = self.ahead(i, j), self.behind(i, j)
                if left + right < period:
                    continue
                start, end = i - left, j + right
                last[period] = (start, end)
                if end - start >= max(least, times * period):
                    if self.words[start : end - period] != self.words[start + period : end]:
                        return None
                    found.add((start, end - start, period))
        return found


def _stretches(ids: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Where every word lies in a window of size words, a power of two, that occurs twice or more."""
    if len(ids) <= size:
        return []
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(_MIX)
    h ^= h >> np.uint64(29)
    width, factor = 1, 0xBF58476D1CE4E5B9
    while width < size:
        h = h[:-width] * np.uint64(factor) + h[width:]
        h ^= h >> np.uint64(31)
        width, factor = 2 * width, factor * factor % (1 << 64)
    order = np.sort(h)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return []
    at = np.flatnonzero(np.isin(h, twice))
    cut = np.flatnonzero(np.diff(at) > size) + 1
    return [(int(a[0]), int(a[-1]) + size) for a in np.split(at, cut)]


def runs_of(words: list, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of at least `least` words and `times` periods, by start and period."""
    # a run and its shift by a period have so many words in common at least
    overlap = max(1, -(-least * (times - 1) // times))
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    out: set[tuple[int, int, int]] = set()
    for start, end in _stretches(ids, 1 << (overlap.bit_length() - 1)):
        part, seed, found = ids[start:end].tolist(), 1, None
        while found is None:
            found, seed = _Stretch(part, seed).runs(least, times), seed + 1
        out |= {(start + s, n, p) for s, n, p in found}
    return sorted(out, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period; of equal ones the first, then that of the smallest period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, without those that a run holds behind its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        edge[start + period] += 1
        edge[start + size] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def _find(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = lambda r: {"start": r[0], "length": r[1], "period": r[2]}
        kind = pa.struct([(f, pa.int64()) for f in ("start", "length", "period")])
        for batch in batches:
            # slices, so that a batch of long texts is not held several times
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                runs, best, texts = [], [], []
                for t in some.column(1).cast(pa.binary()).to_pylist():
                    words = (t or b"").split()
                    of = runs_of(words, least, times)
                    top = strongest(of)
                    runs.append([entry(r) for r in of])
                    best.append(entry(top) if top else None)
                    texts.append(collapsed(words, of))
                arrays = [some.column(0), pa.array(runs, pa.list_(kind)), pa.array(best, kind), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "runs", "strongest", "collapsed"])

    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = 24, times: int = 3) -> DataFrame:
    """A row for each row of docs: its id, runs (by start, then period; start in words from 0), the strongest of them, and collapsed, the text's words joined by one space without those that a run repeats.

    A run is a stretch of words with the smallest period q, of at least max(least, times * q) words, which no neighbouring word
    prolongs; times is 2 or more. Null and texts without a word have no runs, a null strongest and an empty text. Repeated rows and ids are rows of
    their own, null ids stay null. A text is worked on whole by one task; apart from the text that takes some 60 bytes for each
    word of its periodic stretches. An empty table gives an empty one. Extra columns are ignored, whatever they are called.
    """
    if times < 2 or least < 1:
        raise ValueError("a run has two periods at least")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = T.StructType([docs.schema["id"], *T._parse_datatype_string(f"runs array<{RUN}>, strongest {RUN}, collapsed string").fields])
    return docs.mapInArrow(_find(least, times), kind).withColumnRenamed("id", id_col)
