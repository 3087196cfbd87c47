"""Phrase collocations by suffix-sigma.

1. Every word is the begin of a suffix of at most max_n words that ends with its piece. A task numbers its words, counts equal suffixes
   and sends each once, with its count.
2. Suffixes are dealt by language and first word. First words that a sample shows to be so frequent that a task would hold too many of
   them are dealt by their second word as well, and such pairs by their third; what is counted of these in several tasks is added up later.
3. Sorted in reverse order, a suffix stands beside those that begin alike. One stack of open prefixes counts all of them in a pass: a prefix
   is closed when a suffix comes that does not begin with it. Those that are too rare go there and then.
4. Both parts of every cut of a candidate are phrases that were counted too; they are joined by equality. Sums and products are whole numbers
   of 38 digits.

Apart from a batch a task holds the suffixes that it is counting (1,000,000 at most) and its dictionary, both of a bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumentrace.llm.common import staged

#: What ends a piece; space and tab end words.
ENDS = b".,;:!?\n\x0b\x0c\r"
_CUT = bytes.maketrans(ENDS, b"\n" * len(ENDS))
#: Suffixes that a task counts before it sends them, its words by then, and their bytes.
MOST_HELD, MOST_WORDS, MOST_BYTES = 1_000_000, 300_000, 32 << 20
#: Rows of a batch that is sent, and what counts are multiplied by in it.
ROWS, OPEN = 50_000, 4
#: What is sent: (part, suffix, n).
SENT = "part int, suffix binary, n long"
#: Documents of the sample that shows hot words, and the share of a task's rows from which a word is hot.
SAMPLE_DOCS, HOT = 20_000, 0.25

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of every piece that has some, A-Z lower-cased."""
    for piece in text.lower().translate(_CUT).split(b"\n"):
        words = piece.split()
        if words:
            yield words


def coded(lang: str) -> bytes:
    """Without spaces."""
    return lang.encode().replace(b"%", b"%25").replace(b" ", b"%20")


def decoded(lang: bytes) -> str:
    return lang.replace(b"%20", b" ").replace(b"%25", b"%").decode()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _K2
    return x ^ (x >> np.uint64(27))


class _Held:
    """Suffixes of one task until they are sent: for each language the words of every place, by number, level by level."""

    def __init__(self, max_n: int, hot: dict[tuple, int]):
        self.max_n, self.hot = max_n, hot
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.size = self.bytes = 0
        self.levels: dict[str, list[np.ndarray]] = {}

    def full(self) -> bool:
        return self.size >= MOST_HELD or len(self.ids) >= MOST_WORDS or self.bytes >= MOST_BYTES

    def add(self, lang: str, words: list[bytes], sizes: list[int]) -> None:
        """words of consecutive pieces of the given sizes. Number 0 stands for no word."""
        found = pa.array(words, pa.binary()).dictionary_encode()
        ids, numbers = self.ids, []
        for w in found.dictionary.to_pylist():
            at = ids.get(w)
            if at is None:
                at = ids[w] = len(ids) + 1
                self.bytes += len(w)
            numbers.append(at)
        w = np.array(numbers, np.int32)[found.indices.to_numpy()]
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(len(w))
        levels = np.zeros((self.max_n, len(w)), np.int32)
        levels[0] = w
        for k in range(1, self.max_n):
            levels[k, :-k] = np.where(left[:-k] > k, w[k:], 0)
        self.levels.setdefault(lang, []).append(levels)
        self.size += len(w)

    def sent(self) -> Iterator[pa.RecordBatch]:
        """(part, suffix, n): a row for each suffix, as its first word, the language and the other words, each ended by a space, those that are missing empty.

        part deals it out; n is its count times OPEN, and how many of its shortest prefixes are counted in several tasks."""
        vocabulary = [b"", *self.ids]
        words = pa.array([w + b" " for w in vocabulary], pa.binary())
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary))
        for lang, held in self.levels.items():
            levels = np.concatenate(held, axis=1)
            width = len(vocabulary).bit_length()
            key, bits = levels[0].astype(np.int64), width
            for level in levels[1:]:
                if bits + width > 63:
                    key = np.unique(key, return_inverse=True)[1].astype(np.int64)
                    bits = len(key).bit_length()
                key, bits = key << width | level, bits + width
            _, first, counts = np.unique(key, return_index=True, return_counts=True)
            levels = levels[:, first]
            part, opened = self._dealt(lang, levels, hashes)
            n, own = counts.astype(np.int64) * OPEN + opened, pa.scalar(coded(lang) + b" ", pa.binary())
            for at in range(0, len(first), ROWS):
                rows = slice(at, at + ROWS)
                of = [words.take(pa.array(x[rows])) for x in levels]
                suffix = pc.binary_join_element_wise(of[0], own, *of[1:], pa.scalar(b"", pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(part[rows]), suffix, pa.array(n[rows])], ["part", "suffix", "n"])
        self.clear()

    def _dealt(self, lang: str, levels: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        deal = hashes[levels[0]] ^ np.uint64(xxhash.xxh64_intdigest(lang))
        opened = np.zeros(levels.shape[1], np.int8)
        split: dict[int, int] = {}  # tasks of hot words and of hot pairs, by number
        pairs: dict[tuple[int, int], int] = {}
        for (of, *prefix), tasks in self.hot.items():
            numbers = [self.ids.get(w) for w in prefix]
            if of == lang and None not in numbers:
                if len(numbers) == 1:
                    split[numbers[0]] = tasks
                elif self.max_n > 2:
                    pairs[numbers[0], numbers[1]] = tasks
        if split and self.max_n > 1:
            tasks = np.zeros(len(hashes), np.uint64)
            tasks[list(split)] = list(split.values())
            at = np.flatnonzero(tasks[levels[0]])
            deal[at] = _mixed(deal[at]) + hashes[levels[1][at]] % tasks[levels[0][at]] * _K1
            opened[at] = 1
            if pairs:
                code = levels[0][at].astype(np.int64) << 32 | levels[1][at]
                known = np.array(sorted((a << 32 | b, t) for (a, b), t in pairs.items()), np.int64)
                where = np.minimum(np.searchsorted(known[:, 0], code), len(known) - 1)
                hit = known[where, 0] == code
                at, tasks = at[hit], known[where[hit], 1].astype(np.uint64)
                deal[at] = _mixed(deal[at]) + _mixed(hashes[levels[2][at]]) % tasks * _K1
                opened[at] = 2
        return (_mixed(deal * _K1) >> np.uint64(33)).astype(np.int32), opened


def _suffixes(max_n: int, hot: dict[tuple, int]):
    """(lang, text) to counted suffixes"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(max_n, hot)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            found: dict[str, tuple[list[bytes], list[int]]] = {}
            for lang, text in zip(langs, batch.column(1).cast(pa.binary()), strict=True):
                words, sizes = found.setdefault("und" if lang is None else lang, ([], []))
                for piece in pieces(text.as_py() or b""):
                    words += piece
                    sizes.append(len(piece))
                if len(words) >= MOST_HELD // 8:
                    held.add("und" if lang is None else lang, words, sizes)
                    words.clear()
                    sizes.clear()
                    if held.full():
                        yield from held.sent()
            for lang, (words, sizes) in found.items():
                if words:
                    held.add(lang, words, sizes)
            if held.full():
                yield from held.sent()
        yield from held.sent()

    return run


def _columns(suffixes: pa.Array, max_n: int) -> list[pa.Array]:
    """The first words, languages and other words of suffixes, each with its space."""
    start, end = suffixes.offset, suffixes.offset + len(suffixes)
    ends = np.frombuffer(suffixes.buffers()[1], np.int32)[start : end + 1]
    data = np.frombuffer(suffixes.buffers()[2], np.uint8)[: ends[-1]]
    offsets = np.concatenate([ends[:1], np.flatnonzero(data[ends[0] :] == 32) + ends[0] + 1]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), suffixes.buffers()[2]])
    return [words.take(pa.array(np.arange(k, len(words), max_n + 1))) for k in range(max_n + 1)]


def _stack(max_n: int, least: int):
    """Suffixes in descending order to (lang, phrase, words, f, whole), and the words of each language as the phrase of no words. Those counted whole and under least go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the open prefixes of the row that the batch before ended with, the first word alone and with the language, then with more words: their counts
        last: list[pa.Array] | None = None
        counts = [0] * max_n
        opened = 0
        totals: dict[bytes, int] = {}

        def closed(cols: list[pa.Array], k: int, f: np.ndarray, whole: np.ndarray) -> pa.RecordBatch | None:
            """Prefixes of k words, which cols begin with."""
            keep = ~whole | (f >= least)
            if k > 1:
                keep &= np.asarray(pc.greater(pc.binary_length(cols[k]), 1))
            if not keep.any():
                return None
            mask = pa.array(keep)
            kept = [c.filter(mask) for c in cols[: k + 1]]
            langs = kept[1].dictionary_encode()
            lang = pa.array([decoded(x[:-1]) for x in langs.dictionary.to_pylist()], pa.string()).take(langs.indices)
            phrase = pc.binary_join_element_wise(kept[0], *kept[2:], pa.scalar(b"", pa.binary())).cast(pa.string())
            phrase = pc.utf8_slice_codeunits(phrase, 0, -1)
            return pa.RecordBatch.from_arrays([lang, phrase, pa.array(np.full(len(lang), k, np.int32)), pa.array(f[keep]), pa.array(whole[keep])], ["lang", "phrase", "words", "f", "whole"])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            cols = _columns(batch.column(1), max_n)
            sent = batch.column(2).to_numpy()
            add, levels = sent // OPEN, sent % OPEN
            langs = cols[1].dictionary_encode()
            for lang, c in zip(langs.dictionary.to_pylist(), np.bincount(langs.indices.to_numpy(), weights=add).tolist(), strict=True):
                totals[lang] = totals.get(lang, 0) + int(c)
            new = np.zeros(n, bool)
            new[0] = last is None
            for k, c in enumerate(cols):
                new[1:] |= np.asarray(pc.not_equal(c.slice(1), c.slice(0, n - 1)))
                new[0] = new[0] or last[k][0] != c[0]
                if not k:  # a prefix has a language
                    continue
                starts = np.flatnonzero(new)
                sums = np.add.reduceat(add, starts if new[0] else np.concatenate([[0], starts]))
                if not new[0]:
                    counts[k - 1] += int(sums[0])
                    sums = sums[1:]
                if not len(starts):
                    continue
                # what is open is closed by the first row that does not begin with it
                if last is not None and (out := closed(last, k, np.array([counts[k - 1]]), np.array([k > opened]))):
                    yield out
                done = starts[:-1]
                if len(done) and (out := closed([x.take(pa.array(done)) for x in cols[: k + 1]], k, sums[:-1], levels[done] < k)):
                    yield out
                counts[k - 1] = int(sums[-1])
            last, opened = [c.slice(n - 1) for c in cols], int(levels[n - 1])
        if last is not None:
            for k in range(1, max_n + 1):
                if out := closed(last, k, np.array([counts[k - 1]]), np.array([k > opened])):
                    yield out
        if totals:
            m = len(totals)
            yield pa.RecordBatch.from_arrays([pa.array([decoded(x[:-1]) for x in totals]), pa.array([""] * m), pa.array([0] * m, pa.int32()), pa.array(list(totals.values()), pa.int64()), pa.array([False] * m)], ["lang", "phrase", "words", "f", "whole"])

    return run


def hot_prefixes(docs: DataFrame, max_n: int, parts: int, scope: str) -> dict[tuple, int]:
    """(lang, word) and (lang, word, word) that hold over HOT / parts of the words of a sample, with the tasks to deal them to: at most 8 * parts."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    depth = min(max_n, 2)
    some = (docs.sample(share, seed=7) if share < 1 else docs).mapInArrow(_suffixes(depth, {}), SENT)
    some = staged(some, scope)
    total = (some.agg(F.sum("n").alias("n")).first()["n"] or 0) / OPEN
    out: dict[tuple, int] = {}
    for k in range(1, min(max_n, 3)):
        # first word and language, then the second word
        prefix = F.substring_index(F.col("suffix").cast("string"), " ", k + 1)
        for r in some.groupBy(prefix.alias("p")).agg((F.sum("n") / OPEN).alias("n")).where(F.col("n") * parts > HOT * total).collect():
            first, lang, *more = r["p"].encode().split(b" ")
            if all(more):
                out[decoded(lang), first, *more] = max(2, round(r["n"] * parts / (HOT * total)))
    return {p: tasks for p, tasks in out.items() if len(p) == 2 or p[:2] in out}


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", *, max_n: int = 3, least: int = 10, scope: str = "collocations") -> DataFrame:
    """(lang, phrase, words, f): every phrase of at most max_n words that occurs least times or more, and for each language the phrase of no words, whose f is all its words."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = docs.mapInArrow(_suffixes(max_n, hot_prefixes(docs, max_n, parts, scope)), SENT)
    rows = rows.repartition(parts, "part").sortWithinPartitions(F.desc("suffix"))
    counted = staged(rows.mapInArrow(_stack(max_n, least), "lang string, phrase string, words int, f long, whole boolean"), scope)
    sums = counted.where("not whole").groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where((F.col("words") == 0) | (F.col("f") >= least))
    return staged(counted.where("whole").select("lang", "phrase", "words", "f").unionAll(sums), scope)


def mine(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", *, min_n: int = 2, max_n: int = 3, least: int = 10, cover: float = 0.5, top: int | None = 2000, scope: str = "collocations",
) -> DataFrame:
    """Each language's top phrases by score: (lang, rank, phrase, a, l, r, n, score).

    Texts are lower-cased (A-Z), split into pieces at . , ; : ! ? and line ends, and these into words at spaces and tabs. a is how often
    a phrase of min_n to max_n words occurs within pieces, overlaps included; l and r are the counts of the two parts of its worst cut, for which
    score = floor(1000000 * a * a / (l * r)) is lowest (ties: after the fewest words); n is the language's number of words. Phrases with a < least
    are no candidates. One that lies within a longer candidate which occurs cover * a times or more (in whole hundredths) goes. Ranks follow score and a
    downwards, then the phrase by its bytes; top=None ranks all.

    A null language is `und`; null and empty texts have no words. Repeated rows count again, as their words do. Texts of any length are read
    whole. A word of any length is one word. An empty table gives an empty one. Extra columns are ignored, whatever they are called.
    Counts up to 10^12 are exact in all products.
    """
    if not 2 <= min_n <= max_n:
        raise ValueError("phrases have two words at least, and min_n at most max_n")
    counted = phrase_counts(docs, lang_col, text_col, max_n=max_n, least=least, scope=scope)
    big = lambda c: F.col(c).cast("decimal(19,0)")
    candidates = counted.where(F.col("words").between(min_n, max_n))
    cuts = candidates.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("first"), F.expr("substring_index(phrase, ' ', k - words)").alias("rest"))
    of = lambda part, f: counted.select("lang", F.col("phrase").alias(part), F.col("f").alias(f))
    cuts = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    cuts = cuts.withColumns({x: big(x) for x in "alr"}).withColumn("score", F.expr("(cast(1000000 as decimal(7,0)) * (a * a)) div (l * r)"))
    scored = cuts.groupBy("lang", "phrase", "words").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    if max_n > min_n:
        inner = F.expr(f"flatten(transform(sequence({min_n}, words - 1), n -> transform(sequence(1, words - n + 1), i -> array_join(slice(split(phrase, ' '), i, n), ' '))))")
        within = candidates.where(F.col("words") > min_n).select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
        scored = scored.join(within, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(22,0)") < round(100 * cover) * F.col("a")))
    total = counted.where("words = 0").select("lang", F.col("f").alias("n"))
    whole = lambda c, name: F.col(c).cast("long").alias(name)
    out = scored.join(total, "lang").select("lang", "phrase", whole("a", "a"), whole("cut.l", "l"), whole("cut.r", "r"), "n", whole("cut.score", "score"))
    return ranked(out, top)


def ranked(found: DataFrame, top: int | None) -> DataFrame:
    """Ranks within each language. A language's first are chosen among the first of its 64 shares, so that no task orders a whole language; without a limit one does."""
    order = "score DESC, a DESC, phrase"
    if top is not None:
        found = found.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
        found = found.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang, share ORDER BY {order})")).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang ORDER BY {order})"))
    found = found if top is None else found.where(F.col("rank") <= top)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
