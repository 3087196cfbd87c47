"""Line deduplication across documents with two Bloom filters.

1. Every document's distinct line keys become 64-bit hashes. Only these go, packed, to the filter segment that owns them
   (hash modulo the number of segments, which grows with the bytes of the texts), where a once-seen filter takes each hash and a
   twice-seen filter each hash that the once-seen filter already held. Each segment's twice-seen filter is folded in half
   while it stays sparse.
2. A line whose hash the twice-seen filters do not hold occurs in one document; it never moves. While the folded filters fit
   `most_filter_bytes` together they go to every task. Beyond that the hashes go to the filters: those that a batch of documents
   holds once are asked at their segment, those that it holds more often are suspects without asking, so that no
   frequent line gathers anywhere. The suspected repeats are written once to a staged table.
3. The suspects are counted exactly, by the text of the key, and the holder that keeps them is chosen. Filters that are too
   full only cause more suspects, never another result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumentrace.llm.common import NO_ID, fresh, id_key, staged

#: Probes of each filter.
PROBES = 4
#: Keys of a segment at most: 2^23 bits are then at most a quarter full.
SEGMENT_KEYS = 1 << 19
SPACE = b" \t\n\x0b\x0c\r"


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The key of every line; None for one that is too short to count."""
    out: list[bytes | None] = []
    for line in text.split(b"\n"):
        key = line.strip(SPACE)
        # no key has more code points than bytes
        out.append(key.lower() if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars) else None)
    return out


def slots(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Bit numbers of each probe. Those for fewer bits are these modulo the smaller size, so that filters fold."""
    step = (hashes >> np.uint64(17)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    mask = np.uint64((1 << bits) - 1)
    base = hashes >> np.uint64(7)
    with np.errstate(over="ignore"):
        return [((base + np.uint64(i) * step) & mask) for i in range(PROBES)]


class Bits:
    """A Bloom filter of 2**bits bits."""

    def __init__(self, bits: int, data: bytes | None = None):
        self.bits = bits
        self.data = np.zeros((1 << bits) // 8, np.uint8) if data is None else np.frombuffer(data, np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for s in slots(hashes, self.bits):
            out &= (self.data[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out

    def add(self, hashes: np.ndarray) -> None:
        for s in slots(hashes, self.bits):
            np.bitwise_or.at(self.data, (s >> np.uint64(3)).astype(np.int64), np.uint8(1) << (s & np.uint64(7)).astype(np.uint8))

    def folded(self, least_bits: int = 10, most_full: float = 0.06) -> "Bits":
        """Halved while fewer than most_full of the bits would be set."""
        data, bits = self.data, self.bits
        while bits > least_bits:
            half = data[: len(data) // 2] | data[len(data) // 2 :]
            if int(np.bitwise_count(half).sum()) > most_full * len(half) * 8:
                break
            data, bits = half, bits - 1
        return Bits(bits, data.tobytes())


def _hash_batches(min_chars: int, segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            once: set[int] = set()
            twice: set[int] = set()
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                own = {k for k in line_keys(text or b"", min_chars) if k is not None}
                own = {xxhash.xxh3_64_intdigest(k) for k in own}
                twice |= own & once
                once |= own
            for hashes, times in ((once - twice, 1), (twice, 2)):
                arr = np.fromiter(hashes, np.uint64, len(hashes))
                arr = arr[np.argsort(arr % np.uint64(segments), kind="stable")]
                which, at = np.unique(arr % np.uint64(segments), return_index=True)
                parts = np.split(arr, at[1:]) if len(arr) else []
                yield pa.RecordBatch.from_arrays([pa.array(which.astype(np.int32)), pa.array([times] * len(parts), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["segment", "times", "hashes"])

    return run


def _build(once_bits: int, twice_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, tuple[Bits, Bits]] = {}
        for batch in batches:
            for segment, times, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                once, twice = filters.setdefault(segment, (Bits(once_bits), Bits(twice_bits)))
                hashes = np.frombuffer(packed, np.uint64)
                twice.add(hashes if times > 1 else hashes[once.holds(hashes)])
                once.add(hashes)
        for segment, (_, twice) in filters.items():
            small = twice.folded()
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([small.bits], pa.int32()), pa.array([small.data.tobytes()], pa.binary())], ["segment", "bits", "data"])

    return run


def _suspects(min_chars: int, segments: int, filters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {s: Bits(bits, data) for s, (bits, data) in filters.value.items()}
        for batch in batches:
            ids, keys, hashes = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                own = {k for k in line_keys(text or b"", min_chars) if k is not None}
                ids += [doc] * len(own)
                keys += own
                hashes += map(xxhash.xxh3_64_intdigest, own)
            arr = np.array(hashes, np.uint64)
            keep = np.zeros(len(arr), bool)
            of = arr % np.uint64(segments)
            for s in np.unique(of):
                if int(s) in known:
                    at = np.nonzero(of == s)[0]
                    keep[at] = known[int(s)].holds(arr[at])
            at = np.nonzero(keep)[0]
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in at], pa.int64()), pa.array([keys[i] for i in at], pa.binary()), pa.array(arr[at].view(np.int64))], ["doc", "key", "hash"])

    return run


def _strip(at_text: int, at_drop: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, gone = [], [], []
            for text, drop in zip(batch.column(at_text).cast(pa.binary()).to_pylist(), batch.column(at_drop).to_pylist(), strict=True):
                text = text or b""
                lines = text.split(b"\n")
                kept = lines
                if drop:
                    bad = {h & 0xFFFFFFFFFFFFFFFF for h in drop}
                    kept = [line for line, key in zip(lines, line_keys(text, min_chars), strict=True) if key is None or xxhash.xxh3_64_intdigest(key) not in bad]
                texts.append(b"\n".join(kept))
                totals.append(len(lines))
                gone.append(len(lines) - len(kept))
            cols = [c for i, c in enumerate(batch.columns) if i != at_drop]
            cols[at_text] = pa.array(texts, pa.binary()).cast(pa.string())
            names = [n for i, n in enumerate(batch.schema.names) if i != at_drop]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(totals, pa.int64()), pa.array(gone, pa.int64())], [*names, "n_lines", "n_dropped"])

    return run


def segments_for(docs: DataFrame, text: Column, min_chars: int) -> int:
    """A power of two, 64 at least, so that no segment owns more than SEGMENT_KEYS keys: each key has min_chars bytes and an end."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(64, 1 << (size // (min_chars + 1) // SEGMENT_KEYS).bit_length())


def _requests(min_chars: int, segments: int):
    """(segment, sure, docs, hashes): the keys of a batch that one document holds, for their segments, and with a null segment those that several hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                own = {xxhash.xxh3_64_intdigest(k) for k in line_keys(text or b"", min_chars) if k is not None}
                ids += [doc] * len(own)
                hashes += own
            h, d = np.array(hashes, np.uint64), np.array(ids, np.int64)
            _, of, times = np.unique(h, return_inverse=True, return_counts=True)
            segment = np.where(times[of] > 1, -1, (h % np.uint64(segments)).astype(np.int64)) if len(h) else np.zeros(0, np.int64)
            order = np.argsort(segment, kind="stable")
            which, at = np.unique(segment[order], return_index=True)
            cut = lambda x: [p.tobytes() for p in np.split(x[order], at[1:])] if len(order) else []
            yield pa.RecordBatch.from_arrays([pa.array(which.astype(np.int32)), pa.array(cut(d), pa.binary()), pa.array(cut(h), pa.binary())], ["segment", "docs", "hashes"])

    return run


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, hash) of requests that the filter of their segment, which comes before them, holds. Input: (segment, bits, data, docs, hashes)."""
    at, held = None, None
    for batch in batches:
        docs, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for segment, bits, data, d, h in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if data is not None:
                at, held = segment, Bits(bits, data)
                continue
            hashes = np.frombuffer(h, np.uint64)
            ok = np.ones(len(hashes), bool) if segment < 0 else held.holds(hashes) if segment == at else np.zeros(len(hashes), bool)
            docs.append(np.frombuffer(d, np.int64)[ok])
            found.append(hashes[ok])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(docs)), pa.array(np.concatenate(found).view(np.int64))], ["doc", "hash"])


def _texts_of(min_chars: int):
    """(doc, key, hash) of the keys of a document whose hashes are asked for. Input: (doc, text, wanted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, hashes = [], [], []
            for doc, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                of = {h & 0xFFFFFFFFFFFFFFFF for h in wanted}
                for k in {k for k in line_keys(text or b"", min_chars) if k is not None}:
                    h = xxhash.xxh3_64_intdigest(k)
                    if h in of:
                        ids.append(doc)
                        keys.append(k)
                        hashes.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(np.array(hashes, np.uint64).view(np.int64))], ["doc", "key", "hash"])

    return run


def suspected_repeats(
    docs: DataFrame, id_col: str, text_col: str, min_chars: int, segments: int | None, once_bits: int, twice_bits: int, most_filter_bytes: int, scope: str,
) -> DataFrame:
    """(doc, key, hash) of the distinct keys of each document that the twice-seen filters hold, staged."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    segments = segments or segments_for(docs, text, min_chars)
    packed = docs.select(text.alias("text")).mapInArrow(_hash_batches(min_chars, segments), "segment int, times int, hashes binary")
    built = staged(packed.repartition(segments, "segment").mapInArrow(_build(once_bits, twice_bits), "segment int, bits int, data binary"), scope)
    plain = docs.select(id_key(id_col).alias("doc"), text.alias("text"))
    if (built.agg(F.sum(F.octet_length("data"))).first()[0] or 0) <= most_filter_bytes:
        filters = spark.sparkContext.broadcast({r["segment"]: (r["bits"], bytes(r["data"])) for r in built.collect()})
        return staged(plain.mapInArrow(_suspects(min_chars, segments, filters), "doc long, key binary, hash long"), scope)
    none = F.lit(None).cast("binary")
    asked = plain.mapInArrow(_requests(min_chars, segments), "segment int, docs binary, hashes binary").select("segment", F.lit(None).cast("int").alias("bits"), none.alias("data"), "docs", "hashes")
    both = built.select("segment", "bits", "data", none.alias("docs"), none.alias("hashes")).unionAll(asked)
    # sure suspects, of segment -1, are dealt by what they hold
    dealt = both.repartition(segments, "segment", F.when(F.col("segment") < 0, F.xxhash64("hashes"))).sortWithinPartitions("segment", F.col("data").isNull())
    found = dealt.mapInArrow(_ask, "doc long, hash long").groupBy("doc").agg(F.collect_set("hash").alias("wanted"))
    return staged(plain.join(found, "doc").select("doc", "text", "wanted").mapInArrow(_texts_of(min_chars), "doc long, key binary, hash long"), scope)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = 20, min_docs: int = 3,
    segments: int | None = None, once_bits: int = 23, twice_bits: int = 22, most_filter_bytes: int = 64 << 20, scope: str = "line_dedup",
) -> DataFrame:
    """docs with every over-repeated line removed from text_col, and n_lines, n_dropped (long; they replace columns so named).

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. A key of at least min_chars code points
    that at least min_docs documents (ids) hold stays only in the document with the largest id. Null or empty texts are one
    empty line; the result's text is then empty, never null. Rows with a null id count as one document below all others.
    Rows that share an id count as one document and lose the same keys; repeated lines in the keeper all stay. Texts and lines
    of any length are read whole. An empty table gives an empty one. Other columns pass through.
    """
    docs = docs.drop("n_lines", "n_dropped") if id_col not in ("n_lines", "n_dropped") else docs
    suspects = suspected_repeats(docs, id_col, text_col, min_chars, segments, once_bits, twice_bits, most_filter_bytes, scope)
    # ids that repeat count once
    repeated = suspects.select("key", "doc").distinct().groupBy("key").agg(F.count("*").alias("n"), F.max("doc").alias("keeper")).where(F.col("n") >= min_docs)
    # staged, so that the join deals suspects by itself and hot keys can be split
    repeated = staged(repeated.select("key", "keeper"), scope)
    k, drop = fresh(docs, "__line_doc"), fresh(docs, "__line_drop")
    gone = suspects.join(repeated, "key").where(F.col("doc") != F.col("keeper")).groupBy(F.col("doc").alias(k)).agg(F.collect_set("hash").alias(drop))
    joined = docs.withColumn(text_col, F.col(text_col).cast("string")).withColumn(k, id_key(id_col)).join(gone, k, "left").select(*docs.columns, drop)
    schema = T.StructType([f for f in joined.schema.fields if f.name != drop]).add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(_strip(docs.columns.index(text_col), len(docs.columns), min_chars), schema)


__all__ = ["dedup_lines", "suspected_repeats", "line_keys", "Bits", "NO_ID"]
