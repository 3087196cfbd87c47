"""Files by ranges of bytes, tar archives as tables with one partition for each range, WAV audio, and what MP4 files say of their length."""

from __future__ import annotations

import math
import operator
import re
import struct
import time
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

from lumentrace.sources import matroska
from lumentrace.sources.work import kept

BLOCK = 512
#: Bytes of members that are handed on at a time.
_BATCH = 8 << 20
#: The longest name that an entry of its own may hold, in blocks with its header.
NAME_BLOCKS = 17


class FileRange:
    """Ranges of a file that pyarrow's file systems can open: a local path, or a URI as of hdfs, s3 or gs."""

    def __init__(self, path: str):
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        self._f = system.open_input_file(inner)
        self.size = self._f.size()

    def read(self, offset: int, n: int) -> bytes:
        return self._f.read_at(max(0, min(n, self.size - offset)), offset) if offset < self.size else b""

    def close(self) -> None:
        self._f.close()


class HttpRange:
    """Ranges of a file behind an address. A read is tried `retries` times and must have the length asked for; where the address leads is asked anew after `fresh` seconds."""

    def __init__(self, url: str, retries: int = 5, fresh: float = 600.0, token: str = "", pause: float = 1.0):
        self.url, self.retries, self.fresh, self.pause = url, retries, fresh, pause
        self.headers = {"Authorization": f"Bearer {token}"} if token else {}
        self._to, self._at, self.size = url, 0.0, -1
        self._resolve()

    def _resolve(self) -> None:
        with urllib.request.urlopen(urllib.request.Request(self.url, method="HEAD", headers=self.headers), timeout=60) as r:
            self._to, self._at, self.size = r.url, time.monotonic(), int(r.headers["Content-Length"])

    def read(self, offset: int, n: int) -> bytes:
        n = max(0, min(n, self.size - offset))
        if not n:
            return b""
        for attempt in range(self.retries):
            try:
                if time.monotonic() - self._at > self.fresh:
                    self._resolve()
                ask = urllib.request.Request(self._to, headers={"Range": f"bytes={offset}-{offset + n - 1}"} | (self.headers if self._to == self.url else {}))
                with urllib.request.urlopen(ask, timeout=120) as r:
                    data = r.read()
                if len(data) == n:
                    return data
            except OSError:
                self._at = -math.inf  # another address may work
            time.sleep(self.pause * attempt)
        raise OSError(f"{n} bytes at {offset} not read in {self.retries} attempts")

    def close(self) -> None:
        pass


def open_range(path: str) -> FileRange | HttpRange:
    return HttpRange(path) if path.startswith(("http://", "https://")) else FileRange(path)


def _number(field: bytes) -> int:
    if field[0] & 0x80:
        return int.from_bytes(field[1:], "big")
    return int(field.strip(b"\0 ") or b"0", 8)


def is_header(h: bytes) -> bool:
    """Whether a block is a tar header, by its checksum."""
    if len(h) < BLOCK or not h.strip(b"\0"):
        return False
    try:
        return _number(h[148:156]) == sum(h) - sum(h[148:156]) + 8 * 32 and _number(h[124:136]) >= 0
    except ValueError:
        return False


def _blocks(size: int) -> int:
    return -(-size // BLOCK) * BLOCK


def _windows(source, window: int):
    """read(at, n) of a source in larger windows."""
    base, buf = 0, b""

    def read(at: int, n: int) -> bytes:
        nonlocal base, buf
        if not base <= at <= at + n <= base + len(buf):
            base, buf = at, source.read(at, max(n, window))
        return buf[at - base : at - base + n]

    return read


def first_header(source, start: int, window: int = 1 << 20, end: int | None = None) -> int | None:
    """Where the first entry begins at or after start, a multiple of BLOCK, and before end. A file behind a long name belongs to the entry of that name."""
    read = _windows(source, window)
    at, end = -(-start // BLOCK) * BLOCK, source.size if end is None else min(end, source.size)
    base, earlier = max(0, start - NAME_BLOCKS * BLOCK), None
    while at < end:
        if is_header(read(at, BLOCK)):
            owned = False
            for back in range(2, NAME_BLOCKS + 1):
                before = at - back * BLOCK
                if before < 0:
                    break
                if before >= start:
                    continue
                earlier = source.read(base, start - base) if earlier is None else earlier
                h = earlier[before - base :][:BLOCK] if before >= base else b""
                if is_header(h) and h[156:157] == b"L" and before + BLOCK + _blocks(_number(h[124:136])) == at:
                    owned = True
                    break
            if not owned:
                return at
            at += BLOCK + _blocks(_number(read(at, BLOCK)[124:136]))
            continue
        at += BLOCK
    return None


def headers(source, start: int = 0, end: int | None = None, window: int = 64 << 10) -> Iterator[tuple[str, int, int]]:
    """(name, offset of the content, size) of the files whose entry begins before end; long names are read, contents are skipped. start must be the beginning of an entry."""
    read = _windows(source, window)
    at, long_name = start, None
    while long_name is not None or end is None or at < end:
        h = read(at, BLOCK)
        if len(h) < BLOCK or not h.strip(b"\0"):
            return
        size, kind = _number(h[124:136]), h[156:157]
        body = at + BLOCK
        at = body + _blocks(size)
        if kind == b"L":
            long_name = read(body, size).split(b"\0")[0].decode("utf-8", "replace")
            continue
        name, prefix = (x.split(b"\0")[0].decode("utf-8", "replace") for x in (h[:100], h[345:500] if h[257:262] == b"ustar" else b""))
        if kind in (b"0", b"\0", b""):
            yield long_name or (f"{prefix}/{name}" if prefix else name), body, size
        long_name = None


def entries_from(source, start: int, end: int | None = None, window: int = 1 << 20) -> Iterator[tuple[str, int, int]]:
    """headers() from the first entry at or after start."""
    at = first_header(source, start, window, end)
    return iter(()) if at is None else headers(source, at, end, min(window, 64 << 10))


def tail_entries(source, enough: Callable[[list[tuple[str, int, int]]], bool], first: int = 16 << 20, most: int = 512 << 20) -> list[tuple[str, int, int]]:
    """Entries of the end of an archive: a tail that doubles until they are enough, all is read, or it has `most` bytes."""
    n = first
    while True:
        found = list(entries_from(source, max(0, source.size - n), None, min(n, 1 << 20)))
        if enough(found) or n >= source.size or n >= most:
            return found
        n *= 2


def boundary(source, is_left: Callable[[list[tuple[str, int, int]]], bool], probe: int = 4 << 20, steps: int = 20) -> tuple[int, int]:
    """(lo, hi) around the place where entries cease to be left, by bisection with windows of probe bytes, at most `steps` of them."""
    lo, hi = 0, source.size
    for _ in range(steps):
        if hi - lo < probe:
            break
        middle = (lo + hi) // 2 // BLOCK * BLOCK
        if is_left(list(entries_from(source, middle, middle + probe, probe))):
            lo = middle
        else:
            hi = middle
    return lo, hi


def section(source, is_left: Callable, wanted: Callable[[str], bool], probe: int = 4 << 20, windows: int = 6) -> tuple[str, int, int] | None:
    """The first wanted entry behind a boundary, sought in some windows there, else by all headers from the start."""
    lo, _ = boundary(source, is_left, probe)
    for e in entries_from(source, lo, lo + windows * probe, probe):
        if wanted(e[0]):
            return e
    return next((e for e in headers(source) if wanted(e[0])), None)


class Ahead:
    """A source that fetches the chunks behind the one that is read, `ahead` of them at most, each by a request of its own; what lies before the reader is let go.

    Reads should go forward. A jump beyond what is fetched begins anew there; nothing at or behind end is fetched ahead."""

    def __init__(self, source, end: int | None = None, chunk: int = 8 << 20, ahead: int = 8):
        self.source, self.size = source, source.size
        self.end, self.chunk, self.ahead = min(source.size, end if end is not None else source.size), chunk, ahead
        self.pool = ThreadPoolExecutor(ahead, thread_name_prefix="ahead")
        self.coming: dict[int, Future] = {}

    def _chunk(self, n: int) -> bytes:
        if n not in self.coming:
            self.coming[n] = self.pool.submit(self.source.read, n * self.chunk, self.chunk)
        return self.coming[n].result()

    def read(self, offset: int, n: int) -> bytes:
        n = max(0, min(n, self.size - offset))
        if not n:
            return b""
        first, last = offset // self.chunk, (offset + n - 1) // self.chunk
        for c in [c for c in self.coming if c < first]:
            self.coming.pop(c).cancel()
        out = []
        for c in range(first, last + 1):
            for k in range(c, c + self.ahead):
                if k * self.chunk < self.end and k not in self.coming:
                    self.coming[k] = self.pool.submit(self.source.read, k * self.chunk, self.chunk)
            out.append(self._chunk(c))
            if c < last:
                self.coming.pop(c)
        data = b"".join(out) if len(out) > 1 else out[0]
        return data[offset - first * self.chunk :][:n]

    def close(self) -> None:
        self.pool.shutdown(wait=True, cancel_futures=True)
        self.source.close()


def tail_start(source, wanted: Callable[[str], bool], first: int = 16 << 20, most: int = 512 << 20) -> int:
    """Where the tail begins that tail_entries() settles on: it holds a wanted name, is the whole archive, or has `most` bytes."""
    found = tail_entries(source, lambda e: any(wanted(x[0]) for x in e), first, most)
    at = first_header(source, max(0, source.size - min(most, source.size))) if not found else None
    return (at or 0) if not found else max(0, _entry_start(source, found[0]))


def _entry_start(source, entry: tuple[str, int, int]) -> int:
    """Where an entry begins, its long name included."""
    at = entry[1] - BLOCK
    for back in range(2, NAME_BLOCKS + 1):
        before = at - back * BLOCK
        if before < 0:
            break
        h = source.read(before, BLOCK)
        if is_header(h) and h[156:157] == b"L" and before + BLOCK + _blocks(_number(h[124:136])) == at:
            return before
    return at


def section_start(source, left: Callable[[str], bool], wanted: Callable[[str], bool], probe: int = 4 << 20, windows: int = 6) -> int:
    """Where the first wanted entry behind the left ones begins, as section() finds it; the size of the archive where there is none."""
    found = section(source, lambda e: any(left(x[0]) for x in e), wanted, probe, windows)
    return source.size if found is None else _entry_start(source, found)


def planned(path: str, options: dict) -> tuple[int, int]:
    """The bytes of an archive that the options tail, or left and wanted, leave: only the ranges that this takes are read."""
    source = open_range(path)
    try:
        start, end = int(options.get("start", 0)), min(source.size, int(options["end"])) if "end" in options else source.size
        matches = lambda o: re.compile(options[o]).search
        if "tail" in options:
            start = max(start, tail_start(source, matches("tail"), int(options.get("tail_bytes", 16 << 20)), int(options.get("tail_most", 512 << 20))))
        elif "left" in options:
            start = max(start, section_start(source, matches("left"), matches("wanted"), int(options.get("probe_bytes", 4 << 20)), int(options.get("probe_windows", 6))))
        return start, end
    finally:
        source.close()


class _Part(InputPartition):
    def __init__(self, path: str, start: int, end: int | None):
        self.path, self.start, self.end = path, start, end


def _holds(f, row: dict) -> bool:
    """Whether a row passes a filter of the source."""
    value = row[f.attribute[0]]
    if isinstance(f, StringStartsWith):
        return value.startswith(f.value)
    if isinstance(f, StringEndsWith):
        return value.endswith(f.value)
    if isinstance(f, StringContains):
        return f.value in value
    if isinstance(f, In):
        return value in f.value
    compare = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}
    return compare[type(f)](value, f.value)


class _Reader(DataSourceReader):
    def __init__(self, schema, options):
        self.names = [f.name for f in schema.fields]
        self.paths = [p for p in options["path"].split(",") if p]
        self.suffix, self.holds = options.get("suffix", ""), options.get("contains", "")
        self.options = {k: options[k] for k in ("start", "end", "tail", "tail_bytes", "tail_most", "left", "wanted", "probe_bytes", "probe_windows") if k in options}
        if "left" in self.options and "wanted" not in self.options:
            raise ValueError("left goes with wanted")
        self.size = max(BLOCK, int(options.get("partition_bytes", 64 << 20)) // BLOCK * BLOCK)
        self.ahead, self.chunk = int(options.get("read_ahead", 0)), int(options.get("read_ahead_bytes", 8 << 20))
        self.filters: list = []

    def pushFilters(self, filters):
        """Conditions on path, name, offset and size hold before a content is read; those on the path before an archive is opened."""
        kinds = (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringStartsWith, StringEndsWith, StringContains)
        for f in filters:
            if isinstance(f, kinds) and f.attribute[0] in ("path", "name", "offset", "size"):
                self.filters.append(f)
            elif not (isinstance(f, IsNotNull) and f.attribute[0] in ("path", "name", "offset", "size")):
                yield f

    def _passes(self, row: dict) -> bool:
        return all(_holds(f, row) for f in self.filters if f.attribute[0] in row)

    def partitions(self):
        """Ranges of bytes. Archives are opened several at a time, for their sizes and for what the options tail and left look at; nothing else is read."""
        paths = [p for p in self.paths if self._passes({"path": p})]
        with ThreadPoolExecutor(min(32, max(1, len(paths)))) as pool:
            found = list(pool.map(lambda p: planned(p, self.options), paths))
        out = [_Part(path, at, min(at + self.size, end)) for path, (start, end) in zip(paths, found, strict=True) for at in range(start // BLOCK * BLOCK, end, self.size)]
        return out or [_Part("", 0, 0)]

    def read(self, part):
        if not part.path:
            return
        source = open_range(part.path)
        if self.ahead:
            source = Ahead(source, part.end, self.chunk, self.ahead)
        for name, at, size in entries_from(source, part.start, part.end):
            row = {"path": part.path, "name": name, "offset": at, "size": size}
            if name.endswith(self.suffix) and self.holds in name and self._passes(row):
                row["content"] = source.read(at, size) if "content" in self.names else None
                yield tuple(row[n] for n in self.names)
        source.close()


class TarSource(DataSource):
    """Format "tar": files of archives. Tasks find and walk the headers of a range of bytes each; an archive in an archive, uncompressed, is not told apart from its outside where a range begins within it.

    Options: path, one or several with commas between, local or with a scheme; suffix and contains keep members by name; start and end, a range
    of bytes; partition_bytes. tail=<regular expression> reads a tail only: of tail_bytes, doubled until it holds such a name, has tail_most bytes or is all.
    left=<expression> with wanted=<expression> reads from the first wanted member behind those that match left, which is found by bisection with
    windows of probe_bytes, then in probe_windows of them, else by the headers. read_ahead=<n> fetches that many chunks of read_ahead_bytes ahead of the reader.
    Conditions on path, name, offset and size are applied before contents are read. A schema without content reads headers only."""

    @classmethod
    def name(cls):
        return "tar"

    def schema(self):
        return "path string, name string, offset long, size long, content binary"

    def reader(self, schema):
        return _Reader(schema, self.options)


def members(files: DataFrame, *, content: bool = True, suffix: str = "", contains: str = "", partition_bytes: int = 64 << 20, **options) -> DataFrame:
    """(path, name, offset, size, content): the files of archives that a table lists by path; tasks open them, plan their ranges as the options of the source say and read these.

    For more archives than a driver should open."""
    paths = files.select("path")
    cut = "path string, start long, end long"
    step = max(BLOCK, partition_bytes // BLOCK * BLOCK)

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p, at, min(at + step, end)) for p in b["path"] for start, end in [planned(p, options)] for at in range(start // BLOCK * BLOCK, end, step)]
            yield pd.DataFrame(rows, columns=["path", "start", "end"])

    kinds = [("path", pa.string()), ("name", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), *([("content", pa.binary())] if content else [])]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        packed = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)], [c for c, _ in kinds])
        for b in batches:
            for p, start, end in zip(*(b.column(c).to_pylist() for c in ("path", "start", "end")), strict=True):
                source = open_range(p)
                for name, at, size in entries_from(source, start, end):
                    if name.endswith(suffix) and contains in name:
                        rows.append((p, name, at, size, *([source.read(at, size)] if content else [])))
                        held += 256 + (size if content else 0)
                        if held >= _BATCH:
                            yield packed()
                            rows, held = [], 0
                source.close()
        if rows:
            yield packed()

    ranges = kept(paths.mapInPandas(plan, cut))
    n = max(1, min(ranges.count(), 20_000))
    return ranges.repartition(n, "path", "start").mapInArrow(read, "path string, name string, offset long, size long" + (", content binary" if content else ""))


def register(spark: SparkSession) -> None:
    """Makes the source known to a session, with filters that reach it."""
    spark.dataSource.register(TarSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def inventory(spark: SparkSession, root: str, pattern: str = "", below: str = "") -> DataFrame:
    """(path, size, modified) of the files under a folder of any file system that Spark reads, in order; contents are never read. below: a folder in it to which the listing is confined; pattern: a regular expression for the path behind root."""
    place = f"{root.rstrip('/')}/{below.strip('/')}".rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(place).select(F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    bare = re.sub(r"^\w+:/*", "", root.rstrip("/")).lstrip("/")
    inner = F.substring_index("path", f"{bare}/", -1)
    return files.withColumn("path", inner).where(F.col("path").rlike(pattern) if pattern else F.lit(True)).orderBy("path")


def mp4_durations(source) -> dict[str, float]:
    """Seconds by kind of track (vide, soun, ...) of an MP4 file, from its moov box alone; the container's own duration is not looked at."""

    def boxes(at: int, end: int, read) -> Iterator[tuple[bytes, int, int]]:
        while at + 8 <= end:
            size, kind = struct.unpack(">I4s", read(at, 8))
            body = at + 8
            if size == 1:
                size, body = struct.unpack(">Q", read(body, 8))[0], at + 16
            size = size or end - at
            if size < 8:
                return
            yield kind, body, min(at + size, end)
            at += size

    for kind, a, b in boxes(0, source.size, source.read):
        if kind != b"moov":
            continue
        data = source.read(a, b - a)
        read = lambda at, n: data[at : at + n]
        out: dict[str, float] = {}
        for trak, ta, tb in boxes(0, len(data), read):
            if trak != b"trak":
                continue
            for mdia, ma, mb in boxes(ta, tb, read):
                if mdia != b"mdia":
                    continue
                what, seconds = None, None
                for name, x, _ in boxes(ma, mb, read):
                    if name == b"hdlr":
                        what = data[x + 8 : x + 12].decode("latin-1")
                    elif name == b"mdhd":
                        scale, length = struct.unpack_from(">IQ", data, x + 20) if data[x] else struct.unpack_from(">II", data, x + 12)
                        seconds = length / scale if scale else None
                if what and seconds is not None:
                    out[what] = max(seconds, out.get(what, 0.0))
        return out
    return {}


def video_seconds(source) -> float | None:
    """Seconds of the video track of an MP4, Matroska or WebM file, by its media header or its DURATION tag."""
    if source.read(0, 4) == b"\x1a\x45\xdf\xa3":
        return next((t["seconds"] for t in matroska.tracks(source) if t["kind"] == "vide"), None)
    return mp4_durations(source).get("vide")


def probed(files: DataFrame, path: str = "path") -> DataFrame:
    """files with duration_sec of their video track; null where there is none, or the file is of another kind."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seconds = []
            for p in b[path]:
                try:
                    source = open_range(p)
                    seconds.append(video_seconds(source))
                    source.close()
                except (OSError, struct.error):
                    seconds.append(None)
            yield b.assign(duration_sec=pd.Series(seconds, dtype="float64", index=b.index))

    return files.mapInPandas(run, T.StructType([*files.schema.fields, T.StructField("duration_sec", T.DoubleType())]))


def wav_chunks(data: bytes) -> tuple[int, int, int, int, int]:
    """(rate, channels, bits, offset of the samples, their bytes); a WAV without format or data is an error."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, form = 12, None
    while at + 8 <= len(data):
        kind, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if kind == b"fmt ":
            form = struct.unpack_from("<HHIIHH", data, at + 8)
        elif kind == b"data" and form:
            return form[2], form[1], form[5], at + 8, min(size, len(data) - at - 8)
        at += 8 + size + size % 2
    raise ValueError("no samples")


def pcm_slice(data: bytes, start: float, seconds: float) -> bytes:
    rate, channels, bits, at, size = wav_chunks(data)
    frame = channels * bits // 8
    a, b = (min(int(x * rate) * frame, size) for x in (max(start, 0.0), max(start + seconds, 0.0)))
    return data[at + a : at + b]


def rms_frames(data: bytes, millis: int = 30) -> np.ndarray:
    """Root mean square of 16-bit audio, channels averaged, in frames of some milliseconds; the rest at the end is left out."""
    rate, channels, bits, at, size = wav_chunks(data)
    if bits != 16:
        raise ValueError("16 bits only")
    x = np.frombuffer(data, "<i2", size // 2 // channels * channels, at).reshape(-1, channels).mean(axis=1) / 32768
    n = max(rate * millis // 1000, 1)
    whole = len(x) // n * n
    return np.sqrt((x[:whole].reshape(-1, n) ** 2).mean(axis=1)) if whole else np.zeros(0)


def rms_batch(contents: pd.Series) -> pd.Series:
    """For a pandas UDF over binary WAV contents; null stays null."""
    return contents.map(lambda b: None if b is None else rms_frames(bytes(b)).tolist())


def resampled(samples: np.ndarray, rate: int, to: int = 16_000) -> np.ndarray:
    """16-bit samples at another rate by linear interpolation; of equal rate as they are."""
    if rate == to or not len(samples):
        return samples.astype("<i2")
    n = len(samples) * to // rate
    return np.rint(np.interp(np.arange(n) * (rate / to), np.arange(len(samples)), samples.astype(float))).astype("<i2")


def wav_of(samples: np.ndarray, rate: int = 16_000) -> bytes:
    """A WAV file of one channel of 16-bit samples."""
    data = samples.astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, 2 * rate, 2, 16) + b"data" + struct.pack("<I", len(data)) + data


def slice_16k(data: bytes, start: float, seconds: float) -> bytes:
    """A stretch of a 16-bit WAV file as one of one channel at 16 kHz."""
    rate, channels, bits, _, _ = wav_chunks(data)
    if bits != 16:
        raise ValueError("16 bits only")
    x = np.frombuffer(pcm_slice(data, start, seconds), "<i2").reshape(-1, channels).mean(axis=1)
    return wav_of(resampled(x, rate))
