"""Tolerant JSON logs of any size, read by ranges of bytes.

A range holds the lines that begin in it. Tasks read theirs from the first line on, and beyond its end as far as its last object
goes. Whether an object of a range before reaches into it, so that its first lines are no objects of their own, cannot be seen from
within. Every range therefore tells where its reading ended; ranges that were entered before that place are read again from there, until each
range begins where the one before has left off. Then the objects are those of a single pass over the file. Logs with an object a line settle
in the first round."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumentrace.sources.archives import open_range
from lumentrace.sources.work import kept

RANGE, LONGEST, CHUNK = 64 << 20, 64 << 20, 1 << 20
#: Bytes that are decoded at a time: an error counts the lines before its place, so text that lies behind must be short.
WINDOW = 32 << 10
MOST_TASKS = 20_000
#: Bytes of rows that are handed on at a time.
_BATCH = 8 << 20
#: An error so near the end of what has been read may be due to that end.
_EDGE = 16


def located(path: str) -> str:
    """A path as Spark names it, for pyarrow's file systems."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return "s3" + path[3:] if path.startswith(("s3a://", "s3n://")) else path


def ranges(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """(path, length, start, end) of all ranges of the files; a task for each up to MOST_TASKS."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("_metadata.file_size").alias("length")).where("length > 0")
    r = files.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(size))))
    tasks = r.groupBy().count().first()[0]
    r = r.select("path", "length", "start", F.least(F.col("start") + size, "length").alias("end"))
    return r.repartition(max(1, min(tasks, MOST_TASKS)), "path", "start")


def line_start(source, at: int) -> int:
    """Where the first line begins at or after a place; the size of the file if none does."""
    if at <= 0:
        return 0
    at -= 1
    while at < source.size:
        data = source.read(at, CHUNK)
        found = data.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(data)
    return source.size


class _Text:
    """A part of a file, a character for each byte, that grows at its end and is cut at its front; it is read ahead by CHUNK bytes and decoded by WINDOW bytes."""

    def __init__(self, source, at: int):
        self.source, self.base, self.text = source, at, ""
        self.ahead, self.ahead_at = b"", at

    @property
    def end(self) -> int:
        return self.base + len(self.text)

    def reach(self, upto: int) -> None:
        if upto <= self.end:
            return
        n = max(upto - self.end, min(WINDOW, CHUNK))
        at = self.end - self.ahead_at
        if at + n > len(self.ahead):
            self.ahead, self.ahead_at, at = self.source.read(self.end, max(n, CHUNK)), self.end, 0
        self.text += self.ahead[at : at + n].decode("latin-1")

    def forget(self, before: int) -> None:
        if before - self.base > min(WINDOW, CHUNK):
            self.text, self.base = self.text[before - self.base :], before


def _may_go_on(error: json.JSONDecodeError, read: int) -> bool:
    return error.msg.startswith("Unterminated string") or error.pos >= read - _EDGE


def objects(source, at: int, finish: int, longest: int = LONGEST) -> Iterator[tuple[int, int, str]]:
    """(place, end, object) of the objects that begin from at on and before finish, in bytes; where none can be read the search goes on one byte further."""
    decoder, t = json.JSONDecoder(), _Text(source, at)
    while at < finish:
        t.forget(at)
        t.reach(min(at + 1, source.size))
        found = t.text.find("{", at - t.base, finish - t.base)
        if found < 0:
            at = min(t.end, finish)
            continue
        at, ahead = t.base + found, min(WINDOW, CHUNK) // 8
        last = min(source.size, at + longest)
        while True:
            t.reach(min(at + ahead, last))
            try:
                end = t.base + decoder.raw_decode(t.text, at - t.base)[1]
            except json.JSONDecodeError as e:
                if t.end < last and _may_go_on(e, len(t.text)):
                    ahead *= 4
                    continue
                end = None
            except RecursionError:
                end = None
            break
        if end is None or end - at > longest:
            at += 1
        else:
            yield at, end, t.text[at - t.base : end - t.base]
            at = end


def _left(longest: int):
    """(path, start, end, entry) to (path, start, begin, finish, entry, left): the lines of a range, where its reading began, and where it left off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                source = open_range(located(r["path"]))
                begin, finish = line_start(source, r["start"]), line_start(source, r["end"])
                at = entry = max(begin, r["entry"] or 0)
                for _, at, _ in objects(source, entry, finish, longest):  # noqa: B007
                    pass
                source.close()
                rows.append({"path": r["path"], "start": r["start"], "end": r["end"], "begin": begin, "entry": entry, "left": max(at, finish)})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), *((c, pa.int64()) for c in ("start", "end", "begin", "entry", "left"))]))

    return run


def _rows(batches: Iterator[pa.RecordBatch], row, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """What row(range, source) gives for each range, in batches of a bounded size; the last field of a row is its text."""
    out: list[tuple] = []
    size = 0
    for b in batches:
        for r in b.to_pylist():
            source = open_range(located(r["path"]))
            for x in row(r, source):
                out.append(x)
                size += 64 + len(x[-1])
                if size >= _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out, size = [], 0
            source.close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def entered(r: DataFrame, longest: int, most_rounds: int = 10_000) -> DataFrame:
    """Ranges with the place at which each is to be entered."""
    of = "path string, start long, end long, begin long, entry long, left long"
    found = kept(r.withColumn("entry", F.lit(None).cast("long")).select("path", "start", "end", "entry").mapInArrow(_left(longest), of))
    for _ in range(most_rounds):
        before = F.lag("left").over(Window.partitionBy("path").orderBy("start"))
        now = found.withColumn("due", F.greatest("begin", before))
        wrong = kept(now.where("due <> entry").select("path", "start", "end", F.col("due").alias("entry")))
        n = wrong.count()
        if not n:
            return found
        again = wrong.repartition(min(n, MOST_TASKS), "path", "start").mapInArrow(_left(longest), of)
        found = kept(found.join(wrong.select("path", "start"), ["path", "start"], "left_anti").unionAll(again))
    raise RuntimeError(f"ranges do not meet after {most_rounds} rounds")


def resync(spark: SparkSession, path: str, *, range_bytes: int = RANGE, longest: int = LONGEST, one_per_line: bool = False) -> DataFrame:
    """(path, place, json): all objects of the files, also those that span lines or follow damage, just as one pass over each file finds them.

    place counts bytes. An object of more than longest bytes is taken for damage, and the search goes on behind its brace. one_per_line spares the reading that
    makes sure where ranges meet; objects that span lines may then be missed or read in parts at the ends of ranges."""
    r = ranges(spark, path, range_bytes)
    if one_per_line:
        r = r.withColumn("entry", F.lit(None).cast("long"))
    else:
        r = entered(r, longest)
        n = r.count()
        r = r.repartition(max(1, min(n, MOST_TASKS)), "path", "start")
    schema = pa.schema([("path", pa.string()), ("place", pa.int64()), ("json", pa.string())])

    def row(x: dict, source) -> Iterator[tuple]:
        entry = line_start(source, x["start"]) if x["entry"] is None else x["entry"]
        for place, _, text in objects(source, entry, line_start(source, x["end"]), longest):
            yield x["path"], place, text.encode("latin-1").decode("utf-8", "replace")

    return r.select("path", "start", "end", "entry").mapInArrow(lambda batches: _rows(batches, row, schema), "path string, place long, json string")


def _newlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts = []
        for r in b.to_pylist():
            source = open_range(located(r["path"]))
            counts.append(sum(source.read(at, min(CHUNK, r["end"] - at)).count(b"\n") for at in range(r["start"], r["end"], CHUNK)))
            source.close()
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(counts, pa.int64())], [*b.schema.names, "newlines"])


def is_object(line: bytes) -> bool:
    """Whether a line is one JSON object and nothing else."""
    try:
        return isinstance(json.loads(line), dict)
    except (ValueError, RecursionError):
        return False


def numbered_lines(spark: SparkSession, path: str, *, range_bytes: int = RANGE) -> DataFrame:
    """(path, line, sound, text): the lines of the files that are not blank, numbered from 1 in each file, and whether each is one JSON object; numbers come from sums over ranges."""
    counted = ranges(spark, path, range_bytes).mapInArrow(_newlines, "path string, length long, start long, end long, newlines long")
    before = F.coalesce(F.sum("newlines").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    r = kept(counted.withColumn("before", before))
    n = r.count()
    schema = pa.schema([("path", pa.string()), ("line", pa.int64()), ("sound", pa.bool_()), ("text", pa.string())])

    def row(x: dict, source) -> Iterator[tuple]:
        at, finish = line_start(source, x["start"]), line_start(source, x["end"])
        # a line that begins behind the range's first newline has that one before it too
        number = x["before"] + (at > x["start"]) if at > 0 and source.read(at - 1, 1) == b"\n" else x["before"]
        rest = b""
        while at < finish:
            data = source.read(at, min(CHUNK, finish - at))
            at += len(data)
            *whole, rest = (rest + data).split(b"\n")
            for line in whole:
                number += 1
                if line.strip():
                    yield x["path"], number, is_object(line), line.decode("utf-8", "replace")
        if rest.strip():
            yield x["path"], number + 1, is_object(rest), rest.decode("utf-8", "replace")

    return r.repartition(max(1, min(n, MOST_TASKS)), "path", "start").mapInArrow(lambda batches: _rows(batches, row, schema), "path string, line long, sound boolean, text string")
