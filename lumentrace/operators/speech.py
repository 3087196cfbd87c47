"""Speech before captions: audio to energies, windows that speak, utterances placed in them, and their clips' segments after both passes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumentrace.operators import flows
from lumentrace.operators import windows as W
from lumentrace.sources.archives import rms_frames

# What is no utterance, and transcripts of nothing but filling sounds.
REFUSAL = r"(?i)^\s*(i'?m not sure|i am not sure|unclear|inaudible|no speech|n/?a|none|\[non-speech\]|\[unclear\]|cannot|can'?t determine|不确定|听不清)\s*[.。!！]?\s*$"
FILLER = r"^[\s。，、．,.!！?？~～…\-—嗯哦啊呃唔呀哈噢欸诶,]*$"
# Frames of 30 ms; how far the threshold lies between the median and the 95th percentile; seconds of the shortest window and of the gaps that are bridged; windows at most.
FRAME_MS, ABOVE, LEAST_SEC, GAP_SEC, MOST_WINDOWS = 30, 0.45, 0.30, 0.50, 12


def energies(files: DataFrame, clip: str = "clip_id", content: str = "content", millis: int = FRAME_MS) -> DataFrame:
    """(clip, frame, energy): the loudness of every frame of 16-bit WAV contents, in steps of the samples. What is no such WAV, and audio of fewer than two frames, has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for c, data in zip(b[clip], b[content], strict=True):
                try:
                    e = np.sqrt((rms_frames(bytes(data), millis) * 32768) ** 2 + 1e-9)
                except (ValueError, TypeError):
                    continue
                if len(e) > 1:
                    yield pd.DataFrame({clip: c, "frame": np.arange(len(e)), "energy": e})

    kind = files.schema[clip].dataType.simpleString()
    return files.select(clip, content).mapInPandas(run, f"{clip} {kind}, frame long, energy double")


def loud_windows(frames: DataFrame, clip: str = "clip_id", *, millis: int = FRAME_MS, above: float = ABOVE, least: float = LEAST_SEC, gap: float = GAP_SEC, most: int = MOST_WINDOWS) -> DataFrame:
    """(clip, window, start_sec, end_sec) of frames (clip, frame, energy): runs louder than median + above * (95th percentile - median), joined over gaps, the loudest of those that are long enough, numbered from 0 in time."""
    p = frames.groupBy(clip).agg(F.percentile("energy", F.array(F.lit(0.5), F.lit(0.95))).alias("p"))
    level = p.select(clip, (F.col("p")[0] + above * F.greatest(F.col("p")[1] - F.col("p")[0], F.lit(1e-6))).alias("level"))
    x = frames.join(level, clip).withColumn("loud", F.col("energy") > F.col("level"))
    runs = W.runs_above(x.select(clip, "frame", "loud"), [clip], "frame", F.col("loud"))
    seconds = lambda c: c * millis / 1000.0
    spans = W.merge_gaps(runs.select(clip, seconds(F.col("first")).alias("start_sec"), seconds(F.col("last") + 1).alias("end_sec")), [clip], "start_sec", "end_sec", gap)
    spans = spans.where(F.col("end_sec") - F.col("start_sec") >= least).drop("members")
    # the loudness of a window is the mean of its frames, whose bounds are taken from its times
    frame = lambda c: F.floor(F.col(c) * 1000 / millis)
    inside = spans.withColumn("frame", F.explode(F.sequence(frame("start_sec"), frame("end_sec") - 1))).join(frames, [clip, "frame"])
    mean = inside.groupBy(clip, "start_sec", "end_sec").agg(F.avg("energy").alias("loudness"))
    kept = W.per_group_limit(mean, [clip], [F.desc("loudness"), "start_sec"], most)
    return kept.withColumn("window", F.row_number().over(Window.partitionBy(clip).orderBy("start_sec")) - 1).select(clip, F.col("window").cast("int").alias("window"), "start_sec", "end_sec")


def substantive(transcript: Column) -> Column:
    """Whether a transcript has four characters or more beside what stands in brackets, and not only filling sounds."""
    body = F.regexp_replace(F.regexp_replace(F.coalesce(transcript, F.lit("")), r"\[[^\]]*\]", " "), r"(?U)\s+", "")
    return (F.length(body) >= 4) & ~body.rlike(FILLER)


def speech_windows(detected: DataFrame, frames: DataFrame, transcripts: DataFrame) -> DataFrame:
    """(clip_id, window, start_sec, end_sec, source): the windows that a detector gave (clip_id, start_sec, end_sec), numbered in time; for clips without one, whose transcript (clip_id, transcript) is substantive, those by energy."""
    order = Window.partitionBy("clip_id").orderBy("start_sec", "end_sec")
    given = detected.select("clip_id", (F.row_number().over(order) - 1).cast("int").alias("window"), "start_sec", "end_sec", F.lit("detector").alias("source"))
    without = transcripts.where(substantive(F.col("transcript"))).select("clip_id").join(detected.select("clip_id"), "clip_id", "left_anti").distinct()
    return given.unionAll(loud_windows(frames.join(without, "clip_id", "left_semi")).withColumn("source", F.lit("energy")))


def aligned(utterances: DataFrame, windows: DataFrame) -> DataFrame:
    """utterances (clip_id, place, window, text, ...) with start_sec and end_sec of their window.

    place counts those of a clip from 0. A window that is null or beyond the last gives way to the window at the utterance's place, at most the last; negative ones count from the end. Blank texts,
    refusals, and the utterances of clips without windows go."""
    n = windows.groupBy("clip_id").agg((F.max("window") + 1).alias("_n"))
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)^\s+|\s+$", "")
    said = utterances.withColumn("text", text).where((F.col("text") != "") & ~F.col("text").rlike(REFUSAL)).join(n, "clip_id")
    w = F.when(F.col("window").isNull() | (F.col("window") >= F.col("_n")), F.least("place", F.col("_n") - 1)).otherwise(F.when(F.col("window") < 0, F.col("window") + F.col("_n")).otherwise(F.col("window")))
    return said.withColumn("window", w.cast("int")).drop("_n").join(windows.select("clip_id", "window", "start_sec", "end_sec"), ["clip_id", "window"])


def spoken_captions(clips: DataFrame, detected: DataFrame, utterances: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """(clip_id, segments, done, windows, source, utterances) of clips (clip_id, content, transcript): the voice windows of their audio, what was said in them, and the segments of both passes.

    utterances in the order of their windows and places: (start_sec, end_sec, speaker, text). Clips without windows have none, and null as their source. One plan, from binary files to merged segments."""
    found = speech_windows(detected, energies(clips), clips.select("clip_id", "transcript"))
    count = found.groupBy("clip_id").agg(F.count("*").alias("windows"), F.first("source").alias("source"))
    said = aligned(utterances, found).groupBy("clip_id").agg(F.array_sort(F.collect_list(F.struct("window", "place", "start_sec", "end_sec", "speaker", "text"))).alias("u"))
    said = said.select("clip_id", F.transform("u", lambda u: F.struct(*(u[c].alias(c) for c in ("start_sec", "end_sec", "speaker", "text")))).alias("utterances"))
    out = flows.two_pass(first, second).join(count, "clip_id", "left").join(said, "clip_id", "left")
    return out.select("clip_id", "segments", "done", F.coalesce("windows", F.lit(0)).alias("windows"), "source", F.coalesce("utterances", F.array().cast(said.schema["utterances"].dataType)).alias("utterances"))
