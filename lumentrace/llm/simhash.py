"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

Two fingerprints of 64 bits that differ in at most d bits differ in at most d of the 8 bytes, so they share at least 8 - d
bytes at the same positions, five of eight for three bits. A posting list for each position and byte alone would hold a 256th of all
fingerprints. The lists are therefore those of three positions at once: the places where three of the guaranteed five matches
fall, taken from two halves of four bytes, one of which holds at least three of any five. Eight lists a fingerprint lose no pair.
The tally of a pair starts there: its shared positional bytes are counted over all eight positions, pairs with fewer than the
guaranteed 8 - d are discarded, and the rest is verified bit by bit. Lists of more than MOST_IN_LIST fingerprints are cut
by two more of the five other positions, as the guaranteed five include them; that loses no pair either. Each list gives stars of its own connected
groups rather than all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumentrace.llm.common import fresh, staged
from lumentrace.llm.components import components

#: Byte positions of the posting lists.
BLOCKS = [c for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for c in combinations(half, 3)]
MOST_BITS = 3
#: Longer lists are cut by two further positions.
MOST_IN_LIST = 1 << 14


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of width words, A-Z lower-cased, joined by one space; of all words if they are fewer."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([h(b" ".join(words), 42)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends[: len(words) - width + 1] - np.fromiter(map(len, words[: len(words) - width + 1]), np.int64) - 1).tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    return np.fromiter([h(joined[s:e], 42) for s, e in zip(starts, stops, strict=True)], np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set where over half the hashes have it."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # sums of at most 255 rows fit a byte, which makes the first level cheap
    n = len(bits)
    if n > 255:
        whole = n // 255 * 255
        totals = bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.int64)
    else:
        totals = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * totals > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def _fingerprints(at: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t, width)) for t in batch.column(at).cast(pa.binary()).to_pylist()]
            cols = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.array(fps, np.uint64).view(np.int64))], [*names, "fp"])

    return run


def near(a: np.ndarray, b: np.ndarray, most_bits: int) -> np.ndarray:
    """Whether pairs share the guaranteed number of positional bytes, and then differ in at most most_bits bits."""
    x = a ^ b
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    differing = np.bitwise_count((((x & low) + low) | x) & ~low)
    ok = differing <= most_bits
    ok[ok] = np.bitwise_count(x[ok]) <= most_bits
    return ok


def group_stars(fps: np.ndarray, most_bits: int) -> list[tuple[int, int]]:
    """(member, smallest member) for the connected groups of one posting list: each fingerprint is compared once as a centre with those not reached yet."""
    left, stars = np.sort(fps), []
    while len(left) > 1:
        root, frontier, left = left[0], [left[0]], left[1:]
        while frontier and len(left):
            hit = near(left, np.broadcast_to(frontier.pop(), left.shape), most_bits)
            if hit.any():
                stars += [(int(m), int(root)) for m in left[hit]]
                frontier += list(left[hit])
                left = left[~hit]
    return stars


def _links(most_bits: int):
    """Stars of the posting lists of one partition, whose rows come sorted by list."""

    def close(keys: np.ndarray, fps: np.ndarray) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        starts = np.concatenate([[0], np.nonzero(np.diff(keys))[0] + 1, [len(keys)]])
        sizes = np.diff(starts)
        # short lists all at once, by distance within the list
        short = np.repeat(sizes <= 16, sizes)
        k, f = keys[short], fps[short]
        for d in range(1, 16):
            if len(k) <= d:
                break
            same = np.nonzero(k[d:] == k[:-d])[0]
            if not len(same):
                break
            ok = same[near(f[same], f[same + d], most_bits)]
            out += zip(f[ok].tolist(), f[ok + d].tolist(), strict=True)
        for i in np.nonzero(sizes > 16)[0]:
            out += group_stars(fps[starts[i] : starts[i + 1]], most_bits)
        return out

    def batch_of(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        arr = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(arr[:, 0]), pa.array(arr[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(keys, keys[-1]))  # the last list may go on
            if whole:
                yield batch_of(close(keys[:whole], fps[:whole]))
                keys, fps = keys[whole:], fps[whole:]
        if len(keys):
            yield batch_of(close(keys, fps))

    return run


def links(fps: DataFrame, most_bits: int = MOST_BITS, scope: str = "simhash") -> DataFrame:
    """(a, b): links that connect the distinct fingerprints (fp long) just as all pairs of at most most_bits differing bits do."""
    if not 0 <= most_bits <= MOST_BITS:
        raise ValueError(f"the posting lists are complete up to {MOST_BITS} bits")
    byte = lambda i: F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255))
    key = [F.lit(n << 24) + byte(p) * 65536 + byte(q) * 256 + byte(r) for n, (p, q, r) in enumerate(BLOCKS)]
    postings = fps.select(F.explode(F.array(*key)).alias("list"), "fp")
    # at most 8 / MOST_IN_LIST of all fingerprints, in numbers
    long = staged(postings.groupBy("list").agg(F.count("*").alias("n")).where(F.col("n") > MOST_IN_LIST).select(F.col("list"), F.lit(True).alias("long")), scope)
    parts = None
    for n, block in enumerate(BLOCKS):
        cut = F.array(*(F.xxhash64("list", F.lit(256 * p + q), byte(p), byte(q)) for p, q in combinations([i for i in range(8) if i not in block], 2)))
        of = F.shiftright("list", 24) == n
        parts = F.when(of, cut) if parts is None else parts.when(of, cut)
    at = F.explode(F.when(F.col("long"), parts).otherwise(F.array("list")))
    postings = postings.join(long, "list", "left").select(at.alias("list"), "fp")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return postings.repartition(parts, "list").sortWithinPartitions("list").mapInArrow(_links(most_bits), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 3, most_bits: int = MOST_BITS, scope: str = "simhash") -> DataFrame:
    """A row for each row of docs: its id, fp (long, the 64 bits) and component_id, the smallest id of the group it is linked to.

    Null and empty texts have the fingerprint zero and link like any other. Rows that share an id are rows of their own with
    that id. Rows with a null id take part; a group of nothing else has a null component_id. Texts of any length are read whole. A
    bit that exactly half of the shingles have is 0. An empty table gives an empty one. Extra columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([docs.schema["id"], T.StructField("fp", T.LongType())])
    fps = staged(docs.mapInArrow(_fingerprints(1, width), schema), scope)
    distinct = fps.groupBy("fp").agg(F.min("id").alias("rep"))
    roots = components(links(distinct.select("fp"), most_bits, scope), scope)
    tied = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = tied.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = tied.select("fp", "root").join(least, "root").select("fp", "component_id")
    return fps.join(of, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def hex16(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs whose id is the smallest of its group; of rows that share an id and stay, all stay."""
    found = near_duplicates(docs, id_col, text_col, **how)
    k = fresh(docs, "__kept_id")
    kept = found.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias(k)).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(F.col(k)), "left_semi")
