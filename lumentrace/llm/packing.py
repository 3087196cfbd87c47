"""Packing of documents into fixed-length token sequences: bounded-space online best fit.

Each task keeps at most `open_windows` partly filled windows. What a document has beyond whole windows goes into the window
where it leaves the least room; where none has room and no more may be opened, the fullest is filled up by a cut of the
document and emitted. The windows that a task still has open at its end are staged with their ids and merged in groups of
`merge_tasks` tasks: laid end to end and cut anew, the rest at powers of two, which need no padding.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumentrace.llm.bpe_codec import byte_characters, model_proto
from lumentrace.llm.common import staged, trimmed

#: Chunks of a generation of a worker's cache, at some 200 bytes each; it keeps two generations.
MOST_CACHED = 300_000
#: Characters of texts that are encoded at once, as each distinct chunk of them is looked up once.
BATCH_CHARS = 8_000_000
#: Marks that may follow a word; each is a run of its own for the tokenizer.
MARKS = ".,;:!?&%$#*|"


class WordPieces:
    """BPE with word ends over words of letters, by sentencepiece; None where the tokenizer is of another make.

    The last byte of a word, which carries the word's end, has a character of its own. Merges in the order of the tokenizer's
    list are merges by the rank of their result, as training merged each result in one way only."""

    END = "</w>"

    def __init__(self, tok):
        spec = json.loads(tok.to_str())["model"]
        chars = byte_characters()
        last = {c: chr(0xE000 + b) for b, c in enumerate(chars)}
        order: dict[str, int] = {}
        for i, pair in enumerate(spec["merges"]):
            order["".join(pair if isinstance(pair, list) else pair.split(" "))] = i
        pieces, self.ids = [], []
        for token, i in spec["vocab"].items():
            stem = token.removesuffix(self.END)
            if token in order or len(stem) == 1:
                pieces.append((stem[:-1] + last[stem[-1]] if stem != token else token, -float(order.get(token, 1_000_000))))
                self.ids.append(i)
        self.ids = np.array(self.ids, "<u4")
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(pieces))
        self.chars, self.last = chars, [last[c] for c in chars]

    @classmethod
    def of(cls, tok) -> WordPieces | None:
        spec = json.loads(tok.to_str())
        model, steps = spec["model"], (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        fit = model.get("type") == "BPE" and model.get("end_of_word_suffix") == cls.END and not model.get("dropout") and any(s["type"] == "ByteLevel" for s in steps)
        return cls(tok) if fit else None

    def encode(self, words: list[str]) -> list[bytes]:
        chars, last = self.chars, self.last
        mapped = []
        for w in words:
            if w.isascii():  # letters stand for themselves
                mapped.append(w[:-1] + last[ord(w[-1])])
                continue
            b = w.encode()
            mapped.append("".join([chars[x] for x in b[:-1]]) + last[b[-1]])
        found = self.model.encode(mapped, out_type=int, num_threads=1)
        ends = (4 * np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))).tolist()
        ids = self.ids[np.fromiter(chain.from_iterable(found), np.int64)].tobytes()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


class WordTokenizer:
    """Encodes whole texts by a tokenizers file whose pre-tokens never cross a space, with the ids of chunks kept for reuse.

    Texts in Latin letters are lower-cased and cut at spaces here; a chunk of letters and marks takes the ids of its letters
    and of its marks. Everything else, and any text that holds an added token, is encoded as it is, so the ids are those of
    encode(text, add_special_tokens=False). Ids come as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        #: Texts that may hold one of these are left to the tokenizer, which gives such strings their own ids.
        self.added = sorted({t.content.lower() for t in self.tok.get_added_tokens_decoder().values() if t.content})
        self.pieces = WordPieces.of(self.tok)
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> None:
        """Lower-case letters only, each word one pre-token."""
        self.known.update(zip(words, self.pieces.encode(words) if self.pieces else self._plain(words), strict=True))

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk; chunks are distinct."""
        if len(self.known) > MOST_CACHED:
            self.older, self.known = self.known, {"": b""}
        known, older = self.known, self.older
        split, words, odd = {}, set(), set()
        for c in chunks:
            if c in known:
                continue
            if (ids := older.get(c)) is not None:
                known[c] = ids
                continue
            b = c.rstrip(MARKS)
            if not b.isalpha():  # marks behind anything but letters may belong to one run
                odd.add(c)
                continue
            if b not in known:
                words.add(b)
            if b != c:
                split[c] = b
                if (marks := c[len(b) :]) not in known:
                    odd.add(marks)
        if words:
            self._words(list(words))
        if odd:
            known.update(zip(odd, self._plain(list(odd)), strict=True))
        for c, b in split.items():
            known[c] = known[b] + known[c[len(b) :]]
        return list(map(known.__getitem__, chunks))

    def _chunked(self, texts: list[str]) -> list[bytes]:
        """The ids of texts of chunks: each distinct chunk of all of them is looked up once."""
        if not texts:
            return []
        data = np.frombuffer((" ".join(texts) + " ").encode(), np.uint8).copy()
        data[data == 10] = 32
        ends = np.flatnonzero(data == 32) + 1
        # a chunk with the space behind it
        chunks = pa.StringArray.from_buffers(len(ends), pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        each = self._learn(pc.binary_join(pa.ListArray.from_arrays([0, len(chunks.dictionary)], chunks.dictionary), "")[0].as_py().split(" ")[:-1])
        ends = np.cumsum(np.fromiter(map(len, each), np.int32, len(each)) // 4, dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.append(np.int32(0), ends)), pa.array(np.frombuffer(b"".join(each), "<u4"))).take(chunks.indices)
        ids, to = lists.values.to_numpy().tobytes(), lists.offsets.to_numpy()[1:]
        lines = np.cumsum([t.count(" ") + t.count("\n") + 1 for t in texts])
        cuts = (4 * to[lines - 1].astype(np.int64)).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]

    def encode(self, texts: list[str]) -> list[bytes]:
        low: list[str | None] = []
        for t in texts:
            plain = t.isascii() or (np.frombuffer(t.encode("utf-32-le"), "<u4").max() < 0x370 and unicodedata.is_normalized("NFC", t))
            x = t.lower() if plain else ""
            low.append(x if plain and not any(a in x for a in self.added) else None)
        chunked = iter(self._chunked([x for x in low if x is not None]))
        other = iter(self._plain([t for t, x in zip(texts, low, strict=True) if x is None]))
        return [next(other if x is None else chunked) for x in low]


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


class Piece:
    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc: int | None, start: int, ids: bytes, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[: 4 * n], self.total), Piece(self.doc, self.start + n, self.ids[4 * n :], self.total)


class Packer:
    """emit(pieces) takes each window that is closed; the windows never hold more than `length` ids."""

    def __init__(self, length: int, open_windows: int, emit: Callable[[list[Piece]], None]):
        self.length, self.most, self.emit = length, open_windows, emit
        self.open: list[tuple[int, list[Piece]]] = []  # (room, pieces)

    def add(self, piece: Piece) -> None:
        while len(piece) >= self.length:
            whole, piece = piece.cut(self.length)
            self.emit([whole])
        if not len(piece):
            return
        n = len(piece)
        fit = min((i for i, (room, _) in enumerate(self.open) if room >= n), key=lambda i: self.open[i][0], default=None)
        if fit is None and len(self.open) >= self.most:
            fullest = min(range(len(self.open)), key=lambda i: self.open[i][0])
            room, pieces = self.open.pop(fullest)
            head, piece = piece.cut(room)
            self.emit([*pieces, head])
            n = len(piece)
        if fit is None:
            self.open.append((self.length - n, [piece]))
            return
        room, pieces = self.open[fit]
        pieces.append(piece)
        if room == n:
            self.emit(self.open.pop(fit)[1])
        else:
            self.open[fit] = (room - n, pieces)

    def finish(self) -> None:
        """Lays what is open end to end, the fullest first, and cuts it into whole windows and powers of two."""
        pieces = [p for _, w in sorted(self.open, key=lambda x: x[0]) for p in w]
        self.open, left = [], sum(map(len, pieces))
        while left:
            size = self.length if left >= self.length else 1 << (left.bit_length() - 1)
            window, room = [], size
            while room:
                p = pieces.pop(0)
                if len(p) > room:
                    p, rest = p.cut(room)
                    pieces.insert(0, rest)
                window.append(p)
                room -= len(p)
            self.emit(window)
            left -= size


_NAMES = ("doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "task")
_TYPES = (pa.int64(), *[pa.int64()] * 6, pa.binary(), pa.int64())


class _Rows:
    def __init__(self, base: int, with_ids: bool, task: int):
        self.base, self.with_ids, self.task, self.count = base, with_ids, task, 0
        self.cols: list[list] = [[] for _ in _NAMES]

    def window(self, pieces: list[Piece], closed: bool = True) -> None:
        offset, sequence = 0, self.base + self.count
        self.count += 1
        for p in pieces:
            row = (p.doc, p.start, len(p), zlib.crc32(p.ids), p.total, sequence if closed else None, offset if closed else None, p.ids if self.with_ids or not closed else None, self.task)
            for col, v in zip(self.cols, row, strict=True):
                col.append(v)
            offset += len(p)

    def batch(self) -> pa.RecordBatch:
        cols, self.cols = self.cols, [[] for _ in _NAMES]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES, strict=True)], list(_NAMES))


def _pack(path: str, end_id: int, length: int, open_windows: int, with_ids: bool):
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        rows, tok = _Rows(task << 32, with_ids, task), word_tokenizer(path)
        packer = Packer(length, open_windows, rows.window)
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(docs):
                to, size = at, 0
                while to < len(docs) and size < BATCH_CHARS:
                    size += len(texts[to] or "")
                    to += 1
                for doc, ids in zip(docs[at:to], tok.encode([t or "" for t in texts[at:to]]), strict=True):
                    ids += end
                    packer.add(Piece(doc, 0, ids, len(ids) // 4))
                at = to
                yield rows.batch()
        for _, pieces in packer.open:
            rows.window(pieces, closed=False)
        yield rows.batch()

    return run


def _merge(length: int, merge_tasks: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, packer, rows = None, None, None
        for batch in batches:
            for doc, start, total, ids, task in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if task // merge_tasks != group:
                    if packer:
                        packer.finish()
                        yield rows.batch()
                    group = task // merge_tasks
                    rows = _Rows((1 << 62) + (group << 32), with_ids, group)
                    packer = Packer(length, 64, rows.window)
                packer.add(Piece(doc, start, ids, total))
        if packer:
            packer.finish()
            yield rows.batch()

    return run


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *, length: int = 2048, end_id: int = 1,
    open_windows: int = 64, merge_tasks: int = 16, with_ids: bool = False, scope: str = "packing",
) -> DataFrame:
    """A row for each piece of a document in a sequence: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset (long), and with with_ids the ids themselves (little-endian unsigned 32-bit).

    A document's ids are those of its text and end_id; null texts are empty, so each row of docs gives one id at least. Pieces
    of a sequence lie end to end from offset 0. Rows that share an id, or have none, are documents of their own that carry that
    id. An empty table gives an empty one. Extra columns are ignored. A text of any length is one document: it is cut into as many
    windows as it needs, and only its rest looks for a place. Where several windows leave equally little room the oldest takes
    the piece. tokenizer is a file path that the workers can read; strings of its added tokens take these tokens' ids.
    """
    if length < 2 or length & (length - 1):
        raise ValueError("length must be a power of two")
    spark = docs.sparkSession
    schema = T.StructType([T.StructField(n, T.BinaryType() if n == "ids" else T.LongType()) for n in _NAMES])
    plain = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    first = staged(plain.mapInArrow(trimmed(_pack(tokenizer, end_id, length, open_windows, with_ids)), schema), scope)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = F.floor(F.col("task") / merge_tasks)
    left = first.where("sequence_id IS NULL").repartition(parts, group).sortWithinPartitions("task", F.length("ids").desc(), "doc", "start")
    # merged windows are staged too, as other orders of equal rows would give other cuts
    merged = staged(left.select("doc", "start", "doc_tokens", "ids", "task").mapInArrow(_merge(length, merge_tasks, with_ids), schema), scope)
    out = first.where("sequence_id IS NOT NULL").unionAll(merged)
    cols = [F.col("doc").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(*cols, *(["ids"] if with_ids else []))
