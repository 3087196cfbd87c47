"""Joining sets of word n-grams by Jaccard similarity through a partition of their universe.

Two sets of a similarity of share or more differ in few tokens: at most h(|a| + |b|) of them are in one set only. Sizes lie in bands, and
each band cuts the universe of tokens into one segment more than the most that its sets can differ in. So two alike sets have a segment
with the same tokens: its hash is a signature, and sets that share one meet in a list.

A set gives the signatures of its own band, and those of the band below where that holds sets small enough to be alike. Some bands have a
few segments whose one-deletion neighbourhoods are signatures too: two sets that differ there in one token still meet. Each of these
makes up for one segment that a set leaves out of the index. How many a band has is a matter of cost: a sample tells which signatures
make long lists (and how long those of empty segments are to be), and what comparing these costs against the rows of
the neighbourhoods. No choice loses a pair.

Lists link to a centre first, then what is left apart is compared within lists. Sketches that hold the parities of the tokens in so many
bins show most pairs that differ in too many tokens: bins that differ are at most as many as these. All others are verified on the whole sets.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumentrace.llm.common import staged, trimmed
from lumentrace.llm.components import components
from lumentrace.llm.simhash import shingle_hashes

#: Steps of the smallest similarity that a band of sizes spans: wider ones are entered by fewer sets twice, but cut more finely.
BAND_STEPS = 3
#: Signatures carry what they are in their last two bits: whether they are in the index, and whether they lack a token.
INDEX, LACKING = 1, 2
#: Bits of a sketch at most.
MOST_SKETCH = 1 << 13
#: Documents of the sample for the allocation; microseconds that a row of a signature and a comparison of two sketches take; spare segments at most.
SAMPLE_DOCS, ROW_COST, PAIR_COST, MOST_SPARE = 5_000, 5.0, 0.01, 16
#: Rows of a list that are compared in one task; longer ones are compared block by block.
BLOCK = 2_048
#: Rows of 24 bytes that may go to all executors.
MOST_ASKED = 250_000
#: Keys that a task remembers in order not to send the signatures of equal sets again.
MOST_SEEN = 500_000

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K1
    return x ^ (x >> np.uint64(31))


class Scheme:
    """Bands, segments and signatures for a similarity of part / whole. spare: of each band the segments with one-deletion neighbourhoods; long: lists to leave out, with their lengths."""

    def __init__(self, part: int, whole: int, spare: dict[int, int] | None = None, long: dict[int, float] | None = None):
        self.part, self.whole = part, whole
        self.spare, self.long = spare or {}, long or {}
        self.lows = [1]

    def differing(self, total):
        """How many tokens two sets that are alike have apart at most, of total tokens of both."""
        return total - 2 * -(-self.part * total // (self.part + self.whole))

    def band(self, n: int) -> int:
        """The number of the band that holds sets of n."""
        while self.lows[-1] <= n:
            low = self.lows[-1]
            for _ in range(BAND_STEPS):
                low = low * self.whole // self.part + 1
            self.lows.append(low)
        return int(np.searchsorted(self.lows, n, side="right")) - 1

    def segments(self, band: int) -> int:
        """One more than sets of the band and larger ones can differ in; 0 if only equal sets are alike."""
        high = self.lows[band + 1] - 1
        most = (high + high * self.whole // self.part) * (self.whole - self.part) // (self.whole + self.part)
        return most + 1 if most else 0

    @lru_cache(maxsize=256)  # noqa: B019  a scheme lives as long as its task
    def _edges(self, band: int) -> tuple[np.ndarray, np.ndarray]:
        """Where segments begin in the order of hashes, and what tells their signatures apart."""
        m = self.segments(band)
        starts = np.array([-(-(j << 64) // m) for j in range(m)], np.uint64)
        return starts, _mixed(np.arange(m, dtype=np.uint64) * np.uint64(1 << 20) + np.uint64(band))

    def full(self, tokens: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every segment the sum of its mixed tokens, salted, and where it begins and ends. tokens: distinct hashes in order."""
        starts, salts = self._edges(band)
        at = np.append(np.searchsorted(tokens, starts), len(tokens))
        sums = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(_mixed(tokens + _K1), out=sums[1:])
        return sums[at[1:]] - sums[at[:-1]] + salts, at, salts

    def signatures(self, tokens: np.ndarray) -> np.ndarray:
        """All signatures of a set, with their kinds in the last bits."""
        n, out = len(tokens), []
        own = self.band(n)
        for band in (own, own - 1) if own and -(-self.part * n // self.whole) < self.lows[own] else (own,):
            if not self.segments(band):
                continue
            sums, at, _ = self.full(tokens, band)
            kinds = np.full(len(sums), INDEX if band == own else 0, np.uint64)
            lists = _mixed(sums) & ~np.uint64(3)
            spare = min(self.spare.get(band, 0), len(sums))
            if spare:
                if band == own:
                    lengths = [(self.long[x], j) for j, x in enumerate(lists.tolist()) if j >= spare and x in self.long]
                    kinds[[j for _, j in sorted(lengths, reverse=True)[:spare]]] = 0
                rest = np.repeat(sums[:spare], np.diff(at[: spare + 1])) - _mixed(tokens[: at[spare]] + _K1)
                out.append(_mixed(rest) & ~np.uint64(3) | np.uint64(LACKING + (INDEX if band == own else 0)))
            out.append(lists | kinds)
        return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)

    def sketch(self, tokens: np.ndarray) -> bytes:
        """Parities of the numbers of tokens in twice as many bins as tokens or more, a power of two."""
        bits = min(MOST_SKETCH, max(64, 1 << (2 * len(tokens) - 1).bit_length())) if len(tokens) else 64
        return np.packbits(np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def _folded(sketch: bytes, size: int) -> bytes:
    """To size bytes: bins that fall together add up."""
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = (int.from_bytes(sketch[:half], "little") ^ int.from_bytes(sketch[half:], "little")).to_bytes(half, "little")
    return sketch


def _possible(scheme: Scheme, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    return scheme.whole * np.minimum(na, nb) >= scheme.part * np.maximum(na, nb)


def _sets(width: int, scheme: Scheme):
    """(id, content, text) to (id, content, key, n, sketch, sigs); of equal sets that a task meets one has sigs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                keys, sizes, sketches, sigs = [], [], [], []
                for t in some.column(2).cast(pa.binary()).to_pylist():
                    s = np.unique(shingle_hashes(t, width))
                    keys.append(xxhash.xxh3_64_intdigest(s.tobytes()))
                    sizes.append(len(s))
                    if keys[-1] in seen or not len(s):
                        sketches.append(None)
                        sigs.append(None)
                        continue
                    if len(seen) >= MOST_SEEN:
                        seen.clear()
                    seen.add(keys[-1])
                    sketches.append(scheme.sketch(s))
                    sigs.append(scheme.signatures(s))
                ends = np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in sigs])]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.int64), *(x for x in sigs if x is not None)])
                arrays = [some.column(0), some.column(1), pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "content", "key", "n", "sketch", "sigs"])

    return run


def _tokens(width: int):
    """(key, text) to (key, tokens)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                sets = [np.unique(shingle_hashes(t, width)) for t in some.column(1).cast(pa.binary()).to_pylist()]
                flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["key", "tokens"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (sig, key) in the order of list, index first, and key: the rows of lists that begin in the index and hold two keys or more, as (list, kind, key)."""
    sig, key = np.zeros(0, np.int64), np.zeros(0, np.int64)
    going = None  # a list whose rows are on their way
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, key = np.concatenate([sig, batch.column(0).to_numpy()]), np.concatenate([key, batch.column(1).to_numpy()])
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        sig, key = sig[new], key[new]
        of = sig >> 2
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        sizes = np.diff(np.append(starts, len(of)))
        other = np.add.reduceat(key != np.repeat(key[starts], sizes), starts) > 0
        good = (sig[starts] & INDEX == INDEX) & other
        if going is not None and of[0] == going:
            good[0] = True
        rows = np.repeat(good, sizes)
        yield pa.RecordBatch.from_arrays([pa.array(of[rows]), pa.array((sig[rows] & 3).astype(np.int8)), pa.array(key[rows])], ["list", "kind", "key"])
        going = int(of[-1]) if good[-1] else None
        # of a list that is not known to be shared its rows of one key stay, or the first if it is none for the index
        keep = len(sig) if good[-1] else int(starts[-1])
        end = len(sig) if good[-1] or sig[keep] & INDEX else keep + 1
        sig, key = sig[keep:end], key[keep:end]


def close_pairs(scheme: Scheme):
    """Of pairs (a, b, na, nb, sa, sb), sb the sketch of b, those that their sketches do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            most = scheme.differing(na + nb)
            keep = _possible(scheme, na, nb)
            sa, sb = batch.column(4), batch.column(5)
            for i in np.flatnonzero(keep).tolist():
                x, y = sa[i].as_py(), sb[i].as_py()
                size = min(len(x), len(y))
                keep[i] = (int.from_bytes(_folded(x, size), "little") ^ int.from_bytes(_folded(y, size), "little")).bit_count() <= most[i]
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def _within(scheme: Scheme, every: bool):
    """Of rows (list, block, left, kind, key, n, room, root, sketch) in the order of list and block: pairs of different roots that neither rooms nor sketches rule out; unless every, only as many as connect the same rows."""

    def compare(cols: dict[str, np.ndarray], sketches: list[bytes]) -> list[tuple[int, int]]:
        order = np.argsort(cols["n"], kind="stable")
        cols = {c: x[order] for c, x in cols.items()}
        size = min(len(sketches[i]) for i in order)
        bits = np.frombuffer(b"".join(_folded(sketches[i], size) for i in order), np.uint64).reshape(len(order), -1)
        key, n, root, kind, left, room = (cols[c] for c in ("key", "n", "root", "kind", "left", "room"))
        group = {int(r): int(r) for r in np.unique(root)}

        def find(x: int) -> int:
            while group[x] != x:
                group[x] = group[group[x]]
                x = group[x]
            return x

        out = []
        for i in range(len(order) - 1):
            end = int(np.searchsorted(n, n[i] * scheme.whole // scheme.part, side="right"))
            js = np.arange(i + 1, end)
            js = js[(root[js] != root[i]) & ((kind[js] | kind[i]) & INDEX == INDEX) & (kind[js] & kind[i] & LACKING == 0) & ((left[js] != left[i]) | (left[i] == 2))]
            js = js[(scheme.part + scheme.whole) * np.minimum(room[js], room[i]) >= scheme.part * (n[js] + n[i])]
            if not len(js):
                continue
            js = js[np.bitwise_count(bits[js] ^ bits[i]).sum(axis=1) <= scheme.differing(n[js] + n[i])]
            for j in js.tolist():
                a, b = find(int(root[i])), find(int(root[j]))
                if every or a != b:
                    group[a] = b
                    out.append((int(key[i]), int(key[j])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("list", "block", "left", "kind", "key", "n", "room", "root")
        held: dict[str, np.ndarray] | None = None
        texts: list[bytes] = []

        def lists(upto: int) -> list[tuple[int, int]]:
            out: list[tuple[int, int]] = []
            h, b = held["list"][:upto], held["block"][:upto]
            cuts = np.flatnonzero((h[1:] != h[:-1]) | (b[1:] != b[:-1])) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), upto], strict=True):
                if e - s > 1:
                    out += compare({c: held[c][s:e] for c in names}, texts[s:e])
            return out

        def batch_of(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            arr = np.array(pairs, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(arr.min(axis=1)), pa.array(arr.max(axis=1))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = {c: batch.column(i).to_numpy() for i, c in enumerate(names)}
            held = new if held is None else {c: np.concatenate([held[c], new[c]]) for c in names}
            texts += batch.column(len(names)).to_pylist()
            other = np.flatnonzero((held["list"] != held["list"][-1]) | (held["block"] != held["block"][-1]))
            if len(other):
                upto = int(other[-1]) + 1
                yield batch_of(lists(upto))
                held, texts = {c: held[c][upto:] for c in names}, texts[upto:]
        if held is not None:
            yield batch_of(lists(len(texts)))

    return run


def apart_within(lists: DataFrame, sketches: DataFrame, scheme: Scheme, every: bool, parts: int) -> DataFrame:
    """(a, b): pairs of keys of one list and different roots that may be links, found in the task that holds the list; unless every, only as many as connect the same rows.

    lists: list, kind, key, room (of how many tokens in common the list leaves room for), root. sketches: key, n, sketch."""
    # a list longer than a block meets itself block by block: a row goes to its row and column of the blocks' square; left tells for which of both it is there
    sizes = lists.groupBy("list").agg(F.count("*").alias("rows")).where(F.col("rows") > BLOCK).select("list", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    q = lists.join(sizes, "list", "left").withColumn("mine", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    places = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct((F.least("mine", o) * F.col("blocks") + F.greatest("mine", o)).alias("block"), F.when(o == F.col("mine"), 2).when(F.col("mine") < o, 1).otherwise(0).alias("left")))
    q = q.withColumn("at", F.explode(F.when(F.col("blocks").isNotNull(), places).otherwise(F.array(F.struct(F.lit(0).alias("block"), F.lit(2).alias("left"))))))
    q = q.join(sketches.select("key", "n", "sketch"), "key").select("list", F.col("at.block").alias("block"), F.col("at.left").cast("byte").alias("left"), "kind", "key", "n", F.col("room").cast("long").alias("room"), "root", "sketch")
    return q.repartition(parts, "list", "block").sortWithinPartitions("list", "block").mapInArrow(trimmed(_within(scheme, every)), "a long, b long").distinct()


def allocated(docs: DataFrame, width: int, part: int, whole: int) -> Scheme:
    """The scheme with the spare segments and long lists that cost least, by a sample of at most about SAMPLE_DOCS documents."""
    plain = Scheme(part, whole)
    total = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, total))
    some = docs.sample(share, seed=11) if share < 1 else docs
    of: dict[int, list[tuple[int, np.ndarray]]] = {}
    for r in some.select(F.lit(0).alias("id"), F.lit(0).alias("content"), "text").mapInArrow(_sets(width, plain), "id int, content int, key long, n long, sketch binary, sigs array<long>").dropDuplicates(["key"]).select("n", "sigs").toLocalIterator():
        if r["n"]:
            sigs = np.array(r["sigs"] or [], np.int64)
            of.setdefault(plain.band(r["n"]), []).append((r["n"], sigs[sigs & 3 == INDEX].view(np.uint64) & ~np.uint64(3)))
    spare, long = {}, {}
    for band, sets in of.items():
        m = plain.segments(band)
        if not m:
            continue
        lengths = {x: c / share for x, c in Counter(x for _, sigs in sets for x in sigs.tolist()).items()}
        mean = sum(n for n, _ in sets) / len(sets)
        empty = len(sets) / share * float(np.exp(-mean / m))
        for x in (_mixed(plain._edges(band)[1]) & ~np.uint64(3)).tolist():
            lengths[x] = max(lengths.get(x, 0), empty)
        # what a spare segment costs each set, and from which length leaving out a list can pay
        row = 2 * (1 + mean / m) * ROW_COST
        hot = {x: v for x, v in lengths.items() if v * PAIR_COST / 2 > row}
        if hot:
            held = [sorted((hot[x] * PAIR_COST / 2 for x in sigs.tolist() if x in hot), reverse=True) for _, sigs in sets]
            costs = [sum(sum(h[q:]) for h in held) + q * row * len(sets) for q in range(min(m, MOST_SPARE) + 1)]
            spare[band] = int(np.argmin(costs))
            if spare[band]:
                long |= hot
    return Scheme(part, whole, spare, long)


def join_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 3, share: tuple[int, int] = (9, 10), scheme: Scheme | None = None, scope: str = "ngram_join",
) -> DataFrame:
    """A row for each row of docs: its id, n_shingles (long, distinct ones) and component_id, the smallest id that links reach from it.

    Rows are linked when their sets of runs of width words (A-Z lower-cased; all words, if they are fewer) have a Jaccard similarity of share, a
    fraction, or more. Null, empty and texts without words have no shingles, are linked with nothing, and are components of their own. Rows that share an id are rows of
    their own with that id. Rows with a null id take part; a component of nothing else has a null component_id. Texts of any length are compared whole, by
    64-bit hashes of their shingles. An empty table gives an empty one. Extra columns are ignored, whatever they are called.
    """
    part, whole = share
    if not 0 < part <= whole:
        raise ValueError("the share is above 0 and at most 1")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scheme = scheme or allocated(docs, width, part, whole)
    plain = docs.withColumn("content", F.xxhash64("text"))
    fields = [*(T.StructField(n, T.LongType()) for n in ("content", "key", "n")), T.StructField("sketch", T.BinaryType()), T.StructField("sigs", T.ArrayType(T.LongType()))]
    info = staged(plain.select("id", "content", "text").mapInArrow(trimmed(_sets(width, scheme)), T.StructType([docs.schema["id"], *fields])), scope)
    # pick: the row whose text stands for all of a key
    distinct = info.where("n > 0").groupBy("key").agg(F.min("id").alias("rep"), F.min(F.struct("content", "id")).alias("pick"), F.first("n").alias("n"), F.max("sketch").alias("sketch"))
    distinct = staged(distinct, scope)
    rows = info.select(F.explode("sigs").alias("sig"), "key")
    rows = rows.repartition(parts, F.shiftright("sig", 2)).sortWithinPartitions(F.shiftright("sig", 2), F.desc(F.col("sig").bitwiseAND(INDEX)), "key", "sig")
    lists = staged(rows.mapInArrow(_shared, "list long, kind byte, key long"), scope)

    def own(end: str) -> DataFrame:
        return distinct.select(F.col("key").alias(end), F.col("n").alias(f"n{end}"), F.col("sketch").alias(f"s{end}"))

    def verified(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b), staged, those that are links."""
        needed = pairs.select(F.col("a").alias("key")).unionAll(pairs.select(F.col("b").alias("key"))).distinct()
        of = staged(distinct.join(needed, "key", "left_semi").select("key", F.col("pick.content").alias("content"), F.col("pick.id").alias("own")), scope)
        # where few texts are asked for, the list goes to the texts; else both are shuffled
        of = F.broadcast(of) if of.count() <= MOST_ASKED else of
        texts = plain.join(of, "content").where(F.col("id").eqNullSafe(F.col("own"))).select("key", "text").dropDuplicates(["key"])
        sets = staged(texts.mapInArrow(trimmed(_tokens(width)), "key long, tokens array<long>"), scope)
        a, b = (sets.select(F.col("key").alias(e), F.col("tokens").alias(f"t{e}")) for e in "ab")
        both = F.size(F.array_intersect("ta", "tb"))
        return staged(pairs.join(a, "a").join(b, "b").where((part + whole) * both >= part * (F.size("ta") + F.size("tb"))).select("a", "b"), scope)

    def merged(lists: DataFrame, of: DataFrame) -> DataFrame:
        """lists with their roots replaced by those of (node, root); lists of one root are settled, stay so, and go."""
        p = lists.join(of.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left").withColumn("root", F.coalesce("_to", "root")).drop("_to")
        apart = p.groupBy("list").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("list")
        return staged(p.join(apart, "list", "left_semi"), scope)

    def grown(links: DataFrame, lists: DataFrame) -> DataFrame:
        """(node, root) over roots: what new links between keys of the lists join."""
        of = lists.select("key", "root").distinct()
        ends = links.join(of.select(F.col("key").alias("a"), F.col("root").alias("x")), "a").join(of.select(F.col("key").alias("b"), F.col("root").alias("y")), "b")
        return components(ends.select("x", "y").distinct(), scope)

    # first the key that most lists hold, as an original does of which copies differ in different places
    p = lists.withColumn("root", F.col("key"))
    held = p.select("list", "key").distinct().groupBy("key").agg(F.count("*").alias("held"))
    centre = p.join(held, "key").groupBy("list").agg(F.max_by("key", F.struct("held", "key")).alias("centre"))
    pairs = p.join(centre, "list").where("key <> centre").select(F.least("key", "centre").alias("a"), F.greatest("key", "centre").alias("b")).distinct()
    pairs = pairs.join(own("a"), "a").join(own("b"), "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(close_pairs(scheme), "a long, b long")
    joined = [grown(verified(staged(pairs, scope)), p)]
    for every in (False, True):
        p = merged(p, joined[-1])
        pairs = apart_within(p.withColumn("room", F.lit(2**31)), distinct, scheme, every, parts)
        joined.append(grown(verified(staged(pairs, scope)), p))
    tied = distinct.select("key", "rep", F.col("key").alias("root"))
    for of in joined:
        tied = tied.join(of.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left").withColumn("root", F.coalesce("_to", "root")).drop("_to")
    least = tied.groupBy("root").agg(F.min("rep").alias("least"))
    of = tied.select("key", "root").join(least, "root").select("key", "least")
    out = info.select("id", "key", "n").join(of, "key", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"))
