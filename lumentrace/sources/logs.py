"""Readers of logs: tolerant JSON, marked lines, subtitles, transcripts, gaze."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumentrace.sources import jsonlog


def json_objects(text: str) -> Iterator[tuple[int, str]]:
    """(place, object) of every JSON object in a text, in order; where one cannot be read the search goes on one character further."""
    decoder, at = json.JSONDecoder(), text.find("{")
    while at >= 0:
        try:
            value, end = decoder.raw_decode(text, at)
        except ValueError:
            end = at + 1
        else:
            if isinstance(value, dict):
                yield at, text[at:end]
        at = text.find("{", end)


def resync_json(spark: SparkSession, path: str, **how) -> DataFrame:
    """(path, place, json): objects of whole files, also those that span lines or follow damage. place counts bytes. Files are read by ranges, see jsonlog.resync()."""
    return jsonlog.resync(spark, path, **how)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of lines that hold an object; others are dropped."""
    lines = spark.read.text(path).where(F.ltrim("value").startswith("{"))
    parsed = lines.select(F.from_json("value", f"{schema}, _bad STRING", {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.where("r._bad IS NULL").select("r.*").drop("_bad")


def marked_lines(spark: SparkSession, path: str, schema: str, **how) -> DataFrame:
    """Rows of all lines that are not blank: unparsable, line (from 1, in each file) and raw (its first 120 characters) mark those that hold no object. Files are read by ranges."""
    files = jsonlog.numbered_lines(spark, path, **how)
    kind = T._parse_datatype_string(f"{schema}, _bad STRING")
    parsed = files.withColumn("r", F.from_json("text", kind, {"columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("r._bad").isNotNull() | ~F.col("sound")
    fields = [F.when(~bad, F.col(f"r.{f.name}")).alias(f.name) for f in kind.fields if f.name != "_bad"]
    return parsed.select("path", "line", bad.alias("unparsable"), F.when(bad, F.substring("text", 1, 120)).alias("raw"), *fields)


def strict_json(spark: SparkSession, prefix: str, schema: str) -> DataFrame:
    """JSON lines of the .jsonl files under a folder; a line that is no object fails the query. The folder's slash keeps neighbours of like name out."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", "*.jsonl").json(prefix.rstrip("/") + "/")


def subtitles(spark: SparkSession, path: str) -> DataFrame:
    """(path, n, start_sec, end_sec, text) of SRT files; blocks without a time line are skipped."""
    stamp = r"(\d{1,2}):(\d{2}):(\d{2})[,.](\d{1,3})"
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "\r", "").alias("value"))
    blocks = files.select("path", F.posexplode(F.split("value", r"\n[ \t]*\n")).alias("n", "block"))
    pattern = rf"(?s){stamp}\s*-->\s*{stamp}[^\n]*\n(.*)"
    x = blocks.where(F.col("block").rlike(pattern))
    g = lambda i: F.regexp_extract("block", pattern, i)
    sec = lambda i: g(i).cast("double") * 3600 + g(i + 1).cast("double") * 60 + g(i + 2).cast("double") + F.rpad(g(i + 3), 3, "0").cast("double") / 1000
    return x.select("path", "n", sec(1).alias("start_sec"), sec(5).alias("end_sec"), F.trim(F.regexp_replace(g(9), r"\s+", " ")).alias("text"))


def dense_captions(spark: SparkSession, path: str, clips: DataFrame) -> DataFrame:
    """(clip_id, t_start, t_end, text): captions of hour files that share time with clips (clip_id, participant, day, start_sec, end_sec), counted from the clip's start.

    Files are named PARTICIPANT_DAYn_HHMMSSCC.srt; their times count from that hour. Captions without text, and those that only touch, are left out."""
    shape = r"([^/]+)_DAY(\d+)_(\d{2})\d{6}\.srt$"
    part = lambda i: F.regexp_extract("path", shape, i)
    srt = subtitles(spark, path).where(F.col("path").rlike(shape) & (F.col("text") != ""))
    base = part(3).cast("int") * 3600
    srt = srt.select(part(1).alias("participant"), part(2).cast("int").alias("day"), (base + F.col("start_sec")).alias("a"), (base + F.col("end_sec")).alias("b"), "text", part(3).cast("int").alias("hour"))
    # a clip meets the files of the hours that it reaches
    c = clips.withColumn("hour", F.explode(F.sequence(F.floor(F.col("start_sec") / 3600).cast("int"), F.floor(F.col("end_sec") / 3600).cast("int"))))
    x = c.join(srt, ["participant", "day", "hour"]).where((F.col("b") > F.col("start_sec")) & (F.col("a") < F.col("end_sec")))
    return x.select("clip_id", F.greatest(F.lit(0.0), F.col("a") - F.col("start_sec")).alias("t_start"), F.least(F.col("end_sec") - F.col("start_sec"), F.col("b") - F.col("start_sec")).alias("t_end"), "text")


def recordings(spark: SparkSession, root: str, participant: str, day: int, start: float | None = None, end: float | None = None, length: float = 30.0, gap: float = 35.0) -> DataFrame:
    """(path, clip_id, start_sec, is_break): the clips of a participant's day by file name, those that reach into start to end seconds of the day, each taken to be `length` long; is_break where more than gap lies between two starts. No file is opened."""
    from lumentrace.functions.scalars import clip_parts
    from lumentrace.operators.windows import with_breaks

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"DAY{day}_{participant}_*.mp4").load(root).select("path")
    x = files.withColumn("clip_id", F.regexp_extract("path", r"([^/]+)\.mp4$", 1)).withColumn("p", clip_parts(F.col("clip_id"))).where((F.col("p.participant") == participant) & (F.col("p.day") == day))
    x = x.select("path", "clip_id", (F.col("p.hh") * 3600 + F.col("p.mm") * 60 + F.col("p.ss") + F.col("p.cs") / 100.0).alias("start_sec"))
    if start is not None:
        x = x.where(F.col("start_sec") + length > start)
    if end is not None:
        x = x.where(F.col("start_sec") < end)
    return with_breaks(x.withColumn("_all", F.lit(1)), ["_all"], "start_sec", gap, ["start_sec", "clip_id"]).drop("_all")  # a day of one participant


# Lines of transcripts, with absolute times and a zone, or with hours and minutes, seconds optional, from the recording's start.
ABSOLUTE_LINE = r"^\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})(?: [A-Z]{2,4})? -> (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})(?: [A-Z]{2,4})?\]\s*(.*)$"
RELATIVE_LINE = r"^\[(\d{1,2}):(\d{2})(?::(\d{2}))?\s*[-\u2013\u2014]\s*(\d{1,2}):(\d{2})(?::(\d{2}))?\]\s*(.*)$"
#: Where the times of lines without a date count from.
RELATIVE_BASE = "2000-01-01 00:00:00"


def transcript(lines: DataFrame, text: str = "value") -> DataFrame:
    """lines of either dialect with start_time and end_time (timestamps without zone) and body; others, and impossible dates, are dropped.

    [2024-12-01 10:00:00 HKT -> 2024-12-01 10:00:05 HKT] text, or [1:02:03 - 1:02:05] text with a hyphen or dash and seconds as one likes."""
    c = F.col(text)
    a = lambda i: F.regexp_extract(c, ABSOLUTE_LINE, i)
    r = lambda i: F.coalesce(F.regexp_extract(c, RELATIVE_LINE, i).try_cast("long"), F.lit(0))
    at = lambda i: F.to_timestamp_ntz(F.lit(RELATIVE_BASE)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), r(i) * 3600 + r(i + 1) * 60 + r(i + 2))
    whole = lambda i: F.try_to_timestamp(a(i), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    is_absolute, is_relative = c.rlike(ABSOLUTE_LINE), c.rlike(RELATIVE_LINE)
    start, end = (F.when(is_absolute, whole(i)).when(is_relative, at(j)) for i, j in ((1, 1), (2, 4)))
    body = F.when(is_absolute, a(3)).otherwise(F.regexp_extract(c, RELATIVE_LINE, 7))
    return lines.withColumns({"start_time": start, "end_time": end, "body": body}).where(F.col("start_time").isNotNull() & F.col("end_time").isNotNull())


def gaze(spark: SparkSession, path: str) -> DataFrame:
    """(frame_file, gaze_x, gaze_y, in_bounds): the last row of each frame of a CSV log; unreadable numbers are null."""
    raw = spark.read.option("header", True).csv(path).withColumn("_at", F.monotonically_increasing_id())
    last = raw.groupBy("frame_file").agg(F.max_by(F.struct("gaze_x", "gaze_y", "in_bounds"), "_at").alias("r"))
    return last.select("frame_file", F.col("r.gaze_x").try_cast("double").alias("gaze_x"), F.col("r.gaze_y").try_cast("double").alias("gaze_y"), F.lower("r.in_bounds").isin("1", "true", "yes").alias("in_bounds"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Columns of the recordings that a JSON-lines manifest lists; rows without a path of the known form are skipped."""
    rows = spark.read.schema("path STRING, video STRING, bytes LONG, video_bytes LONG, revision STRING").json(path)
    p = F.coalesce("path", "video")
    shape = r"^main/day([1-4])/([^/]+)/video/(0[89]|1[0-9]|20)\.mp4$"
    g = lambda i: F.regexp_extract("path", shape, i)
    x = rows.select(p.alias("path"), F.coalesce("bytes", "video_bytes").alias("bytes"), "revision").where(F.col("path").rlike(shape))
    return x.select("path", "bytes", "revision", g(1).cast("int").alias("day"), F.make_date(F.lit(2024), F.lit(12), g(1).cast("int") + 2).alias("date"), g(2).alias("stream"), g(3).cast("int").alias("hour"))
