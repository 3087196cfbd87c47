"""Which texts hold which others, by an inverted table of anchors.

A text of at least 2^c and fewer than 2^(c+1) bytes belongs to class c. Its anchor is the smallest hash among the grams of its first 2^c
bytes. Grams have half as many bytes, so an anchor is the same wherever these bytes stand; the classes below 16 bytes take all 2^c as one gram. A text
that may hold those of class c is entered under the smallest hash of every stretch of 2^c bytes, some four entries for 2^c bytes. Equal anchors make
candidates, an equi-join for all lengths, words or none; contains() decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumentrace.sources.work import kept

_B, _K = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)
#: Classes of fewer bytes are found by all their bytes at once.
SHORT = 16
#: Bytes of a long text that are worked on at a time.
PART = 4 << 20
#: Anchors for which a filter goes to the tasks, and its places: entries that meet none are not shuffled. More anchors have no filter.
MOST_ANCHORS, PLACES = 1 << 18, 1 << 24


def _class(length: int) -> int:
    return length.bit_length() - 1


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of size bytes, size a power of two: those of two halves make that of the whole."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(_B)
    width, factor = 1, _B
    while width < size:
        h = h[:-width] * np.uint64(factor | 1) + h[width:]
        h ^= h >> np.uint64(31)
        width, factor = 2 * width, factor * factor % (1 << 64)
    h = (h ^ (h >> np.uint64(29))) * _K
    return h ^ (h >> np.uint64(32))


def _least(h: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each run of size, a power of two."""
    width = 1
    while width < size:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return h


def _shape(c: int) -> tuple[int, int]:
    """Bytes of a gram and grams of a stretch."""
    size = 1 << c
    return (size, 1) if size < SHORT else (size // 2, size // 2)


def anchor(text: bytes) -> int:
    gram, run = _shape(_class(len(text)))
    return int(gram_hashes(np.frombuffer(text, np.uint8, gram + run - 1), gram).min().view(np.int64))


def entries(text: bytes, c: int) -> np.ndarray:
    """The distinct anchors that texts of class c within this one may have."""
    gram, run = _shape(c)
    span = gram + run - 1
    found = []
    for at in range(0, len(text) - span + 1, PART):
        part = np.frombuffer(text, np.uint8, min(PART + span - 1, len(text) - at), at)
        found.append(np.unique(_least(gram_hashes(part, gram), run)))
    return np.unique(np.concatenate(found)).view(np.int64) if found else np.zeros(0, np.int64)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, class, anchor)"""
    for b in batches:
        texts = b.column(1).cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_class(len(t)) for t in texts], pa.int32()), pa.array([anchor(t) for t in texts], pa.int64())], ["id", "class", "anchor"])


def _places(anchors: np.ndarray) -> np.ndarray:
    return (anchors.view(np.uint64) % np.uint64(PLACES)).astype(np.int64)


def _filter(have: DataFrame) -> list[int] | None:
    """The places of all anchors, or None if these are too many."""
    found = have.select("anchor").distinct().limit(MOST_ANCHORS + 1).toPandas()["anchor"].to_numpy(np.int64)
    return None if len(found) > MOST_ANCHORS else np.unique(_places(found)).tolist()


def _entries(classes: list[int], places: list[int] | None = None):
    """(id, text) to (id, class, anchor), of the classes that are asked for; of anchors at other places, if any are given, none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None
        if places is not None:
            wanted = np.zeros(PLACES, bool)
            wanted[places] = True
        for b in batches:
            for i, t in zip(b.column(0), b.column(1).cast(pa.binary()), strict=True):
                t = t.as_py()
                for c in classes:
                    if len(t) >= 1 << c:
                        found = entries(t, c)
                        if wanted is not None:
                            found = found[wanted[_places(found)]]
                        if not len(found):
                            continue
                        yield pa.RecordBatch.from_arrays([pa.array([i.as_py()], i.type).take(pa.array(np.zeros(len(found), np.int32))), pa.array(np.full(len(found), c, np.int32)), pa.array(found)], ["id", "class", "anchor"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for x in run(batches):
            held.append(x)
            size += x.num_rows
            if size >= 100_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return gathered


def held_by(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """(i, o): ids of inner (i, t) and outer (o, t) of which the text of o holds that of i; all texts have a byte at least."""
    longest = outer.agg(F.max(F.octet_length("t"))).first()[0]
    if longest is None:
        longest = 0
    inner = inner.where(F.octet_length("t") <= longest)
    # the class by binary digits, as a logarithm may be off by one
    classes = sorted(r[0] for r in inner.select((F.length(F.bin(F.octet_length("t"))) - 1).alias("c")).distinct().collect())
    kind = inner.schema["i"].dataType.simpleString(), outer.schema["o"].dataType.simpleString()
    have = kept(inner.select("i", "t").mapInArrow(_anchors, f"id {kind[0]}, class int, anchor long").withColumnRenamed("id", "i"))
    may = outer.select("o", "t").mapInArrow(_entries(classes, _filter(have)), f"id {kind[1]}, class int, anchor long").withColumnRenamed("id", "o")
    pairs = kept(have.join(may, ["class", "anchor"]).select("i", "o").distinct())
    # only texts of candidates travel
    texts_i, texts_o = (d.join(pairs.select(c).distinct(), c, "left_semi").select(c, F.col("t").alias(f"t{c}")) for d, c in ((inner, "i"), (outer, "o")))
    return pairs.join(texts_i, "i").join(texts_o, "o").where(F.col("to").contains(F.col("ti"))).select("i", "o").distinct()
