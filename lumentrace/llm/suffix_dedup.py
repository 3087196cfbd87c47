"""Exact removal of byte strings that occur earlier, by suffix arrays per shard.

Comparing every shard of documents with every other grows with the square of their number. Shards are therefore cut by content:

1. Each window of `length` bytes is owned by its anchor, the k-gram with the smallest hash in it. Neighbouring windows with the
   same anchor form a fragment. Equal windows have equal anchors, so they meet in the shard of that anchor's hash. Fragments
   whose anchor hash occurs once in the corpus hold no repeated window and go no further.
2. Equal fragments (by a 64-bit hash of their bytes) are pre-aggregated, in the batch first, then in the segment of the anchor: all
   but the first are repeats from end to end. With `confirm` the first two go on, so that their bytes are compared, and only further
   copies are settled here. Fragments of anchors that then have several go on; their bytes are fetched from the texts.
3. A task reads these fragments in the order of their anchors and positions and cuts them into shards of bounded size. Each
   shard's suffix array comes from Larsson-Sadakane refinement, its common prefixes from Kasai's pass, and suffixes that share
   `length` bytes form a class, of which all but the first are repeats.
4. The fragments of an anchor in very many surroundings are cut by where the anchor lies in a window: windows of a range of such
   places share more bytes than the anchor, and these take its part. What is alone with them goes no further, as in 1 and 2, the
   rest goes to shards. Where very many share even these bytes, as around a line that is everywhere, the ranges shrink to single
   windows, which are settled by their hashes. Only fragments that share so much come as single windows.
5. The repeated starts are gathered per document, and the bytes that they cover are removed.

Memory of a task: one batch of texts, about 30 bytes for each fragment of a segment, one shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumentrace.llm.common import fresh, id_key, staged

GRAM = 24
#: Starts handled at once; positions fit the low 24 bits of an anchor.
CHUNK = 1 << 20
SHARD_BYTES = 1 << 20
#: Fragments of an anchor that go to a shard; those of others are cut first.
PIECE = 1024
#: Places of the anchor in a window that such cuts keep together, the first time and after it.
RANGES = (20, 1)
#: Bytes of text for which a segment of fragments is planned.
SEGMENT_TEXT = 64 << 20
#: Windows of cut fragments for which a segment is planned.
SEGMENT_WINDOWS = 2_000_000
_R = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFF)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _R), ("down", pow(_R, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def fragments(text: bytes, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of windows, place of the anchor from the start, anchor hash) of the fragments of a text."""
    starts, sizes, places, keys = [], [], [], []
    for at in range(0, len(text) - length + 1, CHUNK):
        part = np.frombuffer(text, np.uint8, min(CHUNK + length - 1, len(text) - at), at)
        n = len(part)
        up, down = _power(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        h = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        # the smallest hash, the leftmost of equal ones
        low = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        width, reach = length - gram + 1, 1
        while 2 * reach <= width:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if reach < width:
            low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
        first = np.concatenate([[0], np.nonzero(low[1:] != low[:-1])[0] + 1])
        starts.append(first + at)
        sizes.append(np.diff(np.append(first, len(low))))
        anchor = (low[first] & _LOW).astype(np.int64)
        places.append(anchor - first)
        keys.append(h[anchor])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(sizes), np.concatenate(places), np.concatenate(keys)


_FIELDS = (("doc", np.int64), ("start", np.uint32), ("size", np.uint16), ("at", np.uint16), ("key", np.uint64), ("frag", np.uint64))
_PACKED = "segment int, decided boolean, " + ", ".join(f"{n} binary" for n, _ in _FIELDS)


def _order(docs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.lexsort((starts, docs))


def _ranked(doc: np.ndarray, start: np.ndarray, key: np.ndarray, frag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by key, fragment and place, and which of these are copies beyond the second. A place that comes twice (rows that share an id) is one place."""
    order = np.lexsort((start, doc, frag, key))
    same = np.zeros(len(order), bool)
    same[1:] = (key[order][1:] == key[order][:-1]) & (frag[order][1:] == frag[order][:-1])
    twice = same.copy()
    twice[1:] &= (doc[order][1:] == doc[order][:-1]) & (start[order][1:] == start[order][:-1])
    order, same = order[~twice], same[~twice]
    third = same.copy()
    third[1:] &= same[:-1]
    third[:1] = False
    return order, third


def _packed(cols: list[np.ndarray], segments: int) -> pa.RecordBatch:
    """_PACKED of the _FIELDS of a batch; of its equal fragments the first two go to the segment of their key."""
    cols = [np.asarray(c).astype(t) for c, (_, t) in zip(cols, _FIELDS, strict=True)]
    doc, start, _, _, key, frag = cols
    order, again = _ranked(doc, start, key, frag)
    segment = np.where(again, doc[order].view(np.uint64) % np.uint64(segments), key[order] % np.uint64(segments)).astype(np.int64)
    group = segment * 2 + again
    by = np.argsort(group, kind="stable")
    order, group = order[by], group[by]
    cuts = np.nonzero(np.diff(group))[0] + 1
    firsts = group[np.concatenate([[0], cuts])]
    arrays = [pa.array((firsts // 2).astype(np.int32)), pa.array((firsts % 2).astype(bool))]
    for x in cols:
        arrays.append(pa.array([p.tobytes() for p in np.split(x[order], cuts)], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, ["segment", "decided", *(n for n, _ in _FIELDS)])


def _anchors(length: int, segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list[np.ndarray]] = [[] for _ in _FIELDS]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if text is None or len(text) < length:
                    continue
                start, size, at, key = fragments(text, length)
                view = memoryview(text)
                frag = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(start.tolist(), (start + size + (length - 1)).tolist(), strict=True)), np.uint64, len(start))
                for col, x in zip(cols, (np.full(len(start), doc, np.int64), start, size, at, key, frag), strict=True):
                    col.append(x)
            if cols[0]:
                yield _packed([np.concatenate(c) for c in cols], segments)

    return run


def _finer(length: int, width: int, segments: int):
    """_PACKED of fragments cut by the place of the anchor in a window, `width` places together; their key is the hash of the bytes that all windows with these places share. Input: (doc, start, at, part)."""
    places = length - GRAM + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list[int]] = [[] for _ in _FIELDS]
            for doc, start, at, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                view, low = memoryview(part), at - (len(part) - length)
                for q in range(low // width, at // width + 1):
                    first, last = at - min(at, (q + 1) * width - 1), at - max(low, q * width)
                    shared = view[at - q * width : at - min((q + 1) * width, places) + 1 + length]
                    own = (doc, start + first, last - first + 1, at - first, xxhash.xxh3_64_intdigest(shared, q), xxhash.xxh3_64_intdigest(view[first : last + length]))
                    for col, x in zip(cols, own, strict=True):
                        col.append(x)
            if cols[0]:
                yield _packed([np.array(c, t) for c, (_, t) in zip(cols, _FIELDS, strict=True)], segments)

    return run


_FOUND = "doc long, start long, size int, at int, key long, wide boolean"


def _rows(doc: np.ndarray, start: np.ndarray, size: np.ndarray, at: np.ndarray | None = None, key: np.ndarray | None = None, wide: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    order = _order(doc, start)
    for a in range(0, len(order), 100_000):
        o = order[a : a + 100_000]
        rest = [pa.nulls(len(o), t) if x is None else pa.array(x[o].astype(t.to_pandas_dtype())) for x, t in ((at, pa.int32()), (None if key is None else key.view(np.int64), pa.int64()), (wide, pa.bool_()))]
        yield pa.RecordBatch.from_arrays([pa.array(doc[o]), pa.array(start[o].astype(np.int64)), pa.array(size[o].astype(np.int32)), *rest], [c.split()[0] for c in _FOUND.split(", ")])


def _decide(most: int, confirm: bool):
    """Rows of _FOUND: repeats with a null key, and fragments whose bytes are needed with their key; wide are those of a key of more than `most` fragments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[] for _ in _FIELDS]
        for batch in batches:
            for decided, *packed in zip(*(batch.column(i).to_pylist() for i in range(1, 2 + len(_FIELDS))), strict=True):
                arrays = [np.frombuffer(p, t) for p, (_, t) in zip(packed, _FIELDS, strict=True)]
                if decided:
                    yield from _rows(*arrays[:3])
                else:
                    for col, x in zip(cols, arrays, strict=True):
                        col.append(x)
        if not cols[0]:
            return
        doc, start, size, at, key, frag = (np.concatenate(c) for c in cols)
        del cols
        # anchors that occur once are most; they go before anything else is sorted
        order = np.argsort(key)
        k = key[order]
        alone = np.ones(len(k), bool)
        alone[1:] &= k[1:] != k[:-1]
        alone[:-1] &= k[:-1] != k[1:]
        order = order[~alone]
        doc, start, size, at, key, frag = (x[order] for x in (doc, start, size, at, key, frag))
        if not len(key):
            return
        order, again = _ranked(doc, start, key, frag)
        doc, start, size, at, key, frag = (x[order] for x in (doc, start, size, at, key, frag))
        if not confirm and len(key):
            again = np.concatenate([[False], (key[1:] == key[:-1]) & (frag[1:] == frag[:-1])])
        yield from _rows(doc[again], start[again], size[again])
        doc, start, size, at, key = (x[~again] for x in (doc, start, size, at, key))
        first = np.concatenate([[0], np.nonzero(key[1:] != key[:-1])[0] + 1])
        count = np.diff(np.append(first, len(key)))
        count = np.repeat(count, count)
        need = count > 1
        yield from _rows(doc[need], start[need], size[need], at[need], key[need], count[need] > most)

    return run


_PART = "key long, doc long, start long, part binary, at int, wide boolean"


def _fetch(length: int):
    """_PART of the needed fragments of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, text, need in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                for x in need:
                    part = text[x["start"] : x["start"] + x["size"] + length - 1]
                    if len(part) >= length:
                        for col, v in zip(out, (x["key"], doc, x["start"], part, x["at"], x["wide"]), strict=True):
                            col.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], [c.split()[0] for c in _PART.split(", ")])

    return run


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` bytes at least, by Larsson-Sadakane refinement.

    The first pass sorts by eight bytes; each later one doubles the sorted depth and touches only groups that are not sorted
    yet, by the rank of the suffix that starts where the sorted depth ends."""
    n = len(text)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = text
    eight = np.zeros(n, np.uint64)
    for i in range(8):
        eight = (eight << np.uint64(8)) | padded[i : i + n]
    sa = np.argsort(eight, kind="stable").astype(np.int64)
    ordered = eight[sa]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    # a group's rank is the place of its first suffix; ends of the text rank by their length, below all
    rank = np.zeros(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 8
    loose = np.nonzero(~(new & np.append(new[1:], True)))[0]
    while h < depth and len(loose):
        at = sa[loose]
        nxt = at + h
        second = np.where(nxt < n, rank[np.minimum(nxt, n - 1)] + h + 1, n - nxt + h)
        first = rank[at]
        by = np.argsort(first * (n + h + 1) + second, kind="stable")
        at, first, second = at[by], first[by], second[by]
        sa[loose] = at
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        rank[at] = loose[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        loose = loose[~(new & np.append(new[1:], True))]
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, most: int, lanes: int = 2048) -> np.ndarray:
    """Bytes that sa[i] and sa[i - 1] share, at most `most`, by Kasai's pass; the text is cut into lanes that advance together.

    sa must be in order to a depth of 8 * 2**k >= most. A suffix that shares less than that with its forerunner hands one byte
    less on to its successor; beyond that depth the order says nothing, and the successor starts at zero."""
    n, wanted = len(text), most
    most = 8
    while most < wanted:
        most *= 2
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    step = -(-n // min(lanes, n))
    lane = np.arange(0, n, step)
    share = np.zeros(n, np.int16)
    padded = np.zeros(n + most + 8, np.uint8)
    padded[:n] = text
    words = padded[: n + most].astype(np.uint64)
    for i in range(1, 8):
        words |= padded[i : n + most + i].astype(np.uint64) << np.uint64(8 * i)
    had = np.zeros(len(lane), np.int64)
    for j in range(step):
        i = lane + j
        i = i[i < n]
        had = np.where(had < most, np.maximum(had - 1, 0), 0)[: len(i)]
        other = before[i]
        live = np.nonzero((other >= 0) & (had < most))[0]
        had[other < 0] = 0
        while len(live):
            x = words[i[live] + had[live]] ^ words[other[live] + had[live]]
            low = x & (~x + np.uint64(1))
            same = np.where(x == 0, 8, np.bitwise_count(low - np.uint64(1)) >> 3).astype(np.int64)
            had[live] = np.minimum(had[live] + same, most)
            live = live[(same == 8) & (had[live] < most)]
        # nothing is shared beyond the end of the text
        had = np.minimum(had, n - np.maximum(i, other))
        share[i] = had
    return np.minimum(share[sa], wanted)


class Shards:
    """Fragments in the order (key, doc, start), cut into shards; says which window starts are repeats."""

    def __init__(self, length: int, most_bytes: int = SHARD_BYTES):
        self.length, self.most = length, most_bytes
        self.rows: list[tuple[int, int, int, bytes]] = []
        self.bytes = 0

    def add(self, key: int, doc: int, start: int, part: bytes) -> Iterator[tuple[int, int, int]]:
        # all of a key is in one shard
        if self.bytes >= self.most and self.rows[-1][0] != key:
            yield from self.close()
        self.rows.append((key, doc, start, part))
        self.bytes += len(part)

    def close(self) -> Iterator[tuple[int, int, int]]:
        rows, self.rows, self.bytes = self.rows, [], 0
        if not rows:
            return
        length = self.length
        sizes = np.array([len(r[3]) for r in rows])
        text = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        begin = np.cumsum(sizes) - sizes
        frag = np.repeat(np.arange(len(rows)), sizes)
        offset = np.arange(len(text)) - begin[frag]
        window = offset <= sizes[frag] - length
        sa = suffix_array(text, length)
        share = common_prefixes(text, sa, length)
        # classes of suffixes that share the length; only whole windows count
        label = np.cumsum(share < length)[window[sa]]
        at = sa[window[sa]]
        # places in the order (doc, start), also across keys
        docs, starts = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
        turn = np.empty(len(rows), np.int64)
        turn[_order(docs, starts)] = np.arange(len(rows))
        place = turn[frag[at]] * (1 << 20) + offset[at]
        heads = np.concatenate([[True], label[1:] != label[:-1]])
        least = np.minimum.reduceat(place, np.nonzero(heads)[0])
        repeat = place != least[np.cumsum(heads) - 1]
        bad = np.zeros(len(text), bool)
        bad[at[repeat]] = True
        hits = np.nonzero(bad)[0]
        if len(hits):
            cuts = np.concatenate([[0], np.nonzero((np.diff(hits) > 1) | (np.diff(frag[hits]) > 0))[0] + 1, [len(hits)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                f = frag[hits[a]]
                yield int(docs[f]), int(starts[f] + offset[hits[a]]), b - a


_SPANS = "doc long, start long, size int"


def _repeats(length: int, most_bytes: int):
    """_SPANS: runs of repeated starts."""

    def pack(spans: list[tuple[int, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in spans], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32()))], [c.split()[0] for c in _SPANS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(length, most_bytes)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if spans := list(shards.add(*row)):
                    yield pack(spans)
        yield pack(list(shards.close()))

    return run


def covered(spans: list, length: int, n_bytes: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that windows starting in the spans cover."""
    if not spans:
        return []
    runs: list[list[int]] = []
    for a, b in sorted((x["start"], min(x["start"] + x["size"] + length - 1, n_bytes)) for x in spans):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        elif a < b:
            runs.append([a, b])
    return [(a, b) for a, b in runs]


def _cut(at_text: int, at_spans: int, length: int, whole_chars: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n, gone, pieces = [], [], [], []
            for text, spans in zip(batch.column(at_text).cast(pa.binary()).to_pylist(), batch.column(at_spans).to_pylist(), strict=True):
                text = text or b""
                runs = covered(spans or [], length, len(text))
                if whole_chars:  # code points that are covered in part stay
                    fit = []
                    for a, b in runs:
                        while a < b and text[a] & 0xC0 == 0x80:
                            a += 1
                        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
                            b -= 1
                        fit.append((a, b))
                    runs = [(a, b) for a, b in fit if a < b]
                parts, last = [], 0
                for a, b in runs:
                    parts.append(text[last:a])
                    last = b
                parts.append(text[last:])
                kept.append(b"".join(parts))
                n.append(len(text))
                gone.append(len(text) - len(kept[-1]))
                pieces.append(len(runs))
            cols = [c for i, c in enumerate(batch.columns) if i not in (at_text, at_spans)]
            names = [c for i, c in enumerate(batch.schema.names) if i not in (at_text, at_spans)]
            data = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays([*cols, data.cast(pa.string()) if whole_chars else data, *(pa.array(x, pa.int64()) for x in (n, gone, pieces))], [*names, "kept", "n_bytes", "n_removed", "n_spans"])

    return run


def repeated_spans(docs: DataFrame, length: int, most_bytes: int, most_fragments: int, confirm: bool, scope: str) -> DataFrame:
    """(doc, start, size): runs of starts of windows that start earlier too. docs: (doc long, text string)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = max(parts, (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SEGMENT_TEXT + 1)
    packed = docs.mapInArrow(_anchors(length, segments), _PACKED)
    found = staged(packed.repartition(segments, "segment").mapInArrow(_decide(most_fragments, confirm), _FOUND), scope)
    need = found.where("key IS NOT NULL").groupBy("doc").agg(F.collect_list(F.struct("start", "size", "key", "at", "wide")).alias("need"))
    fetched = staged(docs.join(need, "doc").select("doc", "text", "need").mapInArrow(_fetch(length), _PART), scope)
    repeats, parts_of = [found], [fetched]
    for width in RANGES:
        wide = fetched.where("wide")
        windows = wide.agg(F.sum(F.octet_length("part") - (length - 1))).first()[0]
        if not windows:
            break
        segments = max(parts, windows // SEGMENT_WINDOWS + 1)
        packed = wide.select("doc", "start", "at", "part").mapInArrow(_finer(length, width, segments), _PACKED)
        # single windows are equal or not, and are cut no more
        most = most_fragments if width > 1 else 2**62
        found = staged(packed.repartition(segments, "segment").mapInArrow(_decide(most, confirm), _FOUND), scope)
        # a cut fragment lies in the one that has its anchor
        of = wide.select("doc", (F.col("start") + F.col("at")).alias("anchor"), F.col("start").alias("begin"), "part")
        cut = found.where("key IS NOT NULL").withColumn("anchor", F.col("start") + F.col("at")).join(of, ["doc", "anchor"])
        cut = cut.where((F.col("start") >= F.col("begin")) & (F.col("start") + F.col("size") + (length - 1) <= F.col("begin") + F.octet_length("part")))
        cut = cut.withColumn("part", F.substring("part", (F.col("start") - F.col("begin") + 1).cast("int"), F.col("size") + (length - 1)))
        fetched = staged(cut.select("key", "doc", "start", "part", "at", "wide"), scope)
        repeats.append(found)
        parts_of.append(fetched)
    every = reduce(DataFrame.unionAll, (p.where("NOT wide").select("key", "doc", "start", "part") for p in parts_of))
    shards = every.repartition(parts, "key").sortWithinPartitions("key", "doc", "start")
    late = shards.mapInArrow(_repeats(length, most_bytes), _SPANS)
    return reduce(DataFrame.unionAll, (f.where("key IS NULL").select("doc", "start", "size") for f in repeats), late)


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = 100, whole_chars: bool = False,
    shard_bytes: int = SHARD_BYTES, most_fragments: int = PIECE, confirm: bool = False, scope: str = "suffix_dedup",
) -> DataFrame:
    """docs without text_col, with kept, n_bytes, n_removed and n_spans (long; columns so named are replaced).

    Of the UTF-8 bytes of each text, those covered by a string of `length` bytes that also starts earlier (smaller id, or the
    same text before) are removed; strings are judged on the input and never cross documents. With confirm, equal
    fragments are compared byte by byte as well, not by 64-bit hashes alone; the result is the same. kept is binary; with whole_chars
    it is a string, and code points covered only in part stay. Null texts are empty. Rows with a null id come before all others
    as one document. Rows that share an id count as one document, and what is removed from one is removed from all of them; a
    row repeated as it is loses nothing to its twin. Texts of any length are read whole; one shorter than length loses nothing. An
    empty table gives an empty one. Other columns pass through.
    """
    docs = docs.drop(*(c for c in ("kept", "n_bytes", "n_removed", "n_spans") if c not in (id_col, text_col)))
    plain = docs.select(id_key(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    spans = repeated_spans(plain, length, shard_bytes, most_fragments, confirm, scope)
    k, s = fresh(docs, "__suffix_doc"), fresh(docs, "__suffix_spans")
    each = spans.groupBy(F.col("doc").alias(k)).agg(F.collect_list(F.struct("start", "size")).alias(s))
    joined = docs.withColumn(text_col, F.col(text_col).cast("string")).withColumn(k, id_key(id_col)).join(each, k, "left").select(*docs.columns, s)
    schema = T.StructType([f for f in docs.schema.fields if f.name != text_col]).add("kept", "string" if whole_chars else "binary")
    for c in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(c, "long")
    return joined.mapInArrow(_cut(docs.columns.index(text_col), len(docs.columns), length, whole_chars), schema)
