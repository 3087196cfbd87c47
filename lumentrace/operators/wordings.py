"""Near-equal wordings of several runs as one: a similarity join within each clip, groups of what it links, and the longest wording of each group.

Equal texts of a clip meet once. Words are drawn from so few that most pairs of a clip have rare ones in common; all pairs of like length are therefore compared, in blocks of bounded size:
first by sketches, which are short and rule out no link, then on the whole sets among texts that sketches join. The work is quadratic in the texts of a clip; what is stored are some
hundred bytes a text for each block that its own meets, and whole sets of such texts only."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumentrace.sources.work import kept

#: Texts of a block, of which a task holds two.
BLOCK = 16_384
#: Bins of a sketch: a power of two, twice as many as a text of its class has words or more, within these. Numbers of a matrix that a task compares with another.
LEAST_BINS, MOST_BINS, MATRIX = 512, 1 << 14, 1 << 23


def groups(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for the nodes of edges (a, b), longs: the smallest node that each reaches.

    Every round takes the smallest label among a node's own and its neighbours', then that label's label, so that chains halve. Both are grouped minima and equi-joins."""
    both = kept(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = kept(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
    for _ in range(most_rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("m"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.least("root", "m").alias("next"), F.col("root").alias("before"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("further"))
        now = kept(step.join(jump, "next").select("node", F.least("next", "further").alias("root"), (F.least("next", "further") != F.col("before")).alias("moved")))
        labels = now.select("node", "root")
        if not now.where("moved").take(1):
            return labels
    raise RuntimeError(f"no end after {most_rounds} rounds")


def words(text: str):
    """The distinct words of a text, without case and punctuation at their ends; those of letters or digits of any script."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}']+"), lambda w: w != ""))


def _joined(part: int, whole: int):
    """Links of a pair of blocks that reach what all its links reach: each text of the right block against the lists of words of the left one; a block is paired with itself too."""

    def run(rows: pa.Table) -> pa.Table:
        side = rows["side"].to_numpy()
        # left texts first; a block's pair with itself has no right ones
        rows = rows.take(pa.array(np.argsort(side, kind="stable")))
        ids, lists = rows["id"].to_numpy(), rows["w"].combine_chunks()
        n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        code = lists.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(n)
        left = int((side == 0).sum())
        same, cut = left == len(ids), ends[left - 1] if left else 0
        holder = np.repeat(np.arange(left), n[:left])
        order = np.argsort(code[:cut], kind="stable")
        holder, at = holder[order], np.searchsorted(code[:cut][order], np.arange(int(code.max()) + 2 if len(code) else 1))
        label, found = np.arange(len(ids)), []
        for r in range(0 if same else left, len(ids) if left else 0):
            words_of = code[ends[r] - n[r] : ends[r]]
            shared = np.bincount(np.concatenate([holder[at[c] : at[c + 1]] for c in words_of.tolist()]), minlength=left)
            linked = np.nonzero(shared * (part + whole) >= part * (n[:left] + n[r]))[0]
            roots, first = np.unique(label[linked], return_index=True)
            new = roots != label[r]
            if new.any():
                found += [(ids[r], ids[x]) for x in linked[first[new]].tolist()]
                label[np.isin(label, roots)] = label[r]
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    return run


def _width(part: int, whole: int) -> float:
    """Of a class of texts by the logarithm of their number of words: a little wider than the share, so that no rounding parts two texts by a class."""
    return max(math.log(whole / part), 0.1) * (1 + 1e-6)


def _sketches(width: float):
    """(clip_id, id, h: hashes of the words) to (clip_id, id, n, sketch): the number of words, and the parities of how many of them fall into each bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            largest = np.exp((np.floor(np.log(np.maximum(n, 1)) / width) + 1) * width)
            sizes = np.clip(1 << np.ceil(np.log2(2 * largest)).astype(np.int64), LEAST_BINS, MOST_BINS)
            flat, ends, out = lists.flatten().to_numpy(), np.cumsum(n), []
            for k, end, bins in zip(n.tolist(), ends.tolist(), sizes.tolist(), strict=True):
                out.append(np.packbits(np.bincount(flat[end - k : end] & (bins - 1), minlength=bins).astype(np.uint8) & 1).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(out, pa.binary())], ["clip_id", "id", "n", "sketch"])

    return run


def _folded(sketch: bytes, size: int) -> bytes:
    """To size bytes, a power of two: bins that fall together add up."""
    return sketch if len(sketch) == size else np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, size)).tobytes()


def _near(part: int, whole: int):
    """Stars of the texts of a pair of blocks that links may join. Sets that differ in d words differ in at most d bins; links differ in at most (whole - part) / (whole + part) of the words of both."""
    most = (whole - part) / (whole + part)

    def run(rows: pa.Table) -> pa.Table:
        n, side = rows["n"].to_numpy(), rows["side"].to_numpy()
        order = np.lexsort((n, side))
        ids, n, left = rows["id"].to_numpy()[order], n[order], int((side == 0).sum())
        found = rows["sketch"].to_pylist()
        size = min(map(len, found))
        bits = np.frombuffer(b"".join(_folded(found[i], size) for i in order), np.uint8).reshape(-1, size)
        # bins that differ are own + own - 2 x common: each side brings its share of what common must reach
        need = (np.bitwise_count(bits).sum(axis=1, dtype=np.int64) - most * n) / 2
        root, step = np.arange(len(ids)), max(64, MATRIX // (8 * size))
        rest = 0 if left == len(ids) else left
        for at in range(0, left, step):
            a = slice(at, min(at + step, left))
            x = np.unpackbits(bits[a], axis=1).astype(np.float32)
            # lengths are in order, so that texts of like length are a stretch
            first = rest + int(np.searchsorted(n[rest:] * whole, n[a][0] * part))
            last = rest + int(np.searchsorted(n[rest:] * part, n[a][-1] * whole, side="right"))
            for to in range(max(first, at) if rest == 0 else first, last, 512):
                b = slice(to, min(to + 512, last))
                common = np.unpackbits(bits[b], axis=1).astype(np.float32) @ x.T
                common -= (need[a] - 0.25).astype(np.float32)
                j, i = np.nonzero(common >= need[b].astype(np.float32)[:, None])
                i, j = i + at, j + to
                like = (i != j) & (whole * np.minimum(n[i], n[j]) >= part * np.maximum(n[i], n[j])) & (root[i] != root[j])
                i, j = i[like], j[like]
                while len(i):
                    low = np.minimum(root[i], root[j])
                    np.minimum.at(root, root[i], low)
                    np.minimum.at(root, root[j], low)
                    while (root[root] != root).any():
                        root = root[root]
                    apart = root[i] != root[j]
                    i, j = i[apart], j[apart]
        more = root != np.arange(len(ids))
        return pa.table({"a": pa.array(ids[root[more]]), "b": pa.array(ids[more])})

    return run


def _met(x: DataFrame, part: int, whole: int, block: int) -> DataFrame:
    """x (clip_id, id, n: number of words, ...) dealt to pairs of blocks (clip_id, c, i, d, j), with the side it is on.

    Texts of a clip lie in classes of their number of words, of which only equal and neighbouring ones can link, and classes in blocks; a block is paired with itself too."""
    more = [c for c in x.columns if c not in ("clip_id", "id")]
    x = x.withColumn("c", F.floor(F.log(F.col("n").cast("double")) / _width(part, whole)).cast("int"))
    sizes = x.groupBy("clip_id", "c").agg(F.ceil(F.count("*") / block).cast("int").alias("own"))
    x = x.join(sizes, ["clip_id", "c"])
    for name, step in (("up", 1), ("down", -1)):
        x = x.join(sizes.select("clip_id", (F.col("c") - step).alias("c"), F.col("own").alias(name)), ["clip_id", "c"], "left")
    x = x.withColumn("i", F.pmod(F.xxhash64("id"), "own").cast("int"))
    none = F.array().cast("array<struct<c:int,i:int,d:int,j:int,side:int>>")
    pair = lambda c, i, d, j, side: F.struct(c.alias("c"), i.alias("i"), d.alias("d"), j.alias("j"), side.cast("int").alias("side"))
    to = lambda n, of: F.when(F.col(n) > 0, F.transform(F.sequence(F.lit(0), F.col(n) - 1), of)).otherwise(none)
    c, i = F.col("c"), F.col("i")
    met = F.concat(to("own", lambda j: pair(c, F.least(i, j), c, F.greatest(i, j), i > j)), to("up", lambda j: pair(c, i, c + 1, j, F.lit(0))), to("down", lambda j: pair(c - 1, j, c, i, F.lit(1))))
    return x.select("clip_id", "id", *more, F.explode(met).alias("p")).select("clip_id", "p.*", "id", *more)


def near_links(texts: DataFrame, share: float, block: int = BLOCK) -> DataFrame:
    """(a, b): links of texts (clip_id, id, w: distinct words) of one clip whose words have a Jaccard similarity of share or more, a < b; not all, but such that the same texts are reached. Texts without words link to nothing.

    Sketches of texts of like length are compared first, in pairs of blocks; no link is lost, as they can only be nearer than their texts are. What they join is a group, within which links are counted
    on the whole sets, in pairs of blocks where it is large. Candidates are never stored."""
    part, whole = round(share * 1000), 1000
    sets = texts.where(F.size("w") > 0).select("clip_id", "id", "w")
    hashed = sets.select("clip_id", "id", F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
    sketches = kept(hashed.mapInArrow(_sketches(_width(part, whole)), hashed.select("clip_id", "id").schema.add("n", "long").add("sketch", "binary")))
    pairs = ("clip_id", "c", "i", "d", "j")
    near = _met(sketches, part, whole, block).groupBy(*pairs).applyInArrow(_near(part, whole), "a long, b long")
    of = kept(groups(kept(near)))
    open_ = kept(sets.join(of.withColumnRenamed("node", "id"), "id").select(F.col("root").alias("clip_id"), "id", F.size("w").cast("long").alias("n"), "w"))
    return _met(open_, part, whole, block).groupBy(*pairs).applyInArrow(_joined(part, whole), "a long, b long")


def merged(items: DataFrame, runs: DataFrame, share: float = 0.6) -> DataFrame:
    """(clip_id, text, n_runs, n_items, votes, confidence): what the items (clip_id, call_index, text) of several runs say, near-equal wordings as one.

    Wordings are near-equal whose distinct words have a Jaccard similarity of share (in thousandths) or more, also through others. The longest wording stands for them, of equal lengths the last in
    order. Seen by all runs: high; by one of several: low; else medium. runs: (clip_id, call_index). Null and blank texts are no wordings; texts without words are one with equal ones only."""
    # one row for each text of a clip; its id is a place in a table, and so stays what it is
    texts = items.where(F.trim("text") != "").groupBy("clip_id", "text").agg(F.collect_set("call_index").alias("calls"), F.count("*").alias("n_items"))
    texts = kept(texts.withColumn("id", F.monotonically_increasing_id()))
    roots = groups(near_links(texts.select("clip_id", "id", words("text").alias("w")), share))
    k = runs.groupBy("clip_id").agg(F.count_distinct("call_index").alias("k"))
    t = texts.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    g = t.groupBy("clip_id", "root").agg(F.max_by("text", F.struct(F.length("text"), "text")).alias("text"), F.array_distinct(F.flatten(F.collect_list("calls"))).alias("c"), F.sum("n_items").alias("n_items"))
    n = F.size("c")
    confidence = F.when(n >= F.col("k"), "high").when(n <= 1, "low").otherwise("medium")
    return g.join(k, "clip_id").select("clip_id", "text", n.cast("long").alias("n_runs"), "n_items", F.concat_ws("/", n.cast("string"), F.col("k").cast("string")).alias("votes"), confidence.alias("confidence"))
