"""Readers and sinks on small files."""

import io
import json
import struct
import tarfile

import numpy as np
import pytest

from lumentrace.functions import salvage
from lumentrace.sources import archives, logs, sinks


def test_resync_finds_objects_behind_damage(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n{"b": {"c": \n[2]}}\nxx {"broken": \n{"d": 3}\n')
    got = [json.loads(r.json) for r in logs.resync_json(spark, str(tmp_path)).orderBy("place").collect()]
    assert got == [{"a": 1}, {"b": {"c": [2]}}, {"d": 3}]


def test_bad_lines_are_dropped_or_marked(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\nnot json\n{"a": \n\n{"a": 2}\n')
    assert sorted(r.a for r in logs.json_lines(spark, str(tmp_path), "a LONG").collect()) == [1, 2]
    got = {r.line: (r.unparsable, r.raw, r.a) for r in logs.marked_lines(spark, str(tmp_path), "a LONG").collect()}
    assert got == {1: (False, None, 1), 2: (True, "not json", None), 3: (True, '{"a": ', None), 5: (False, None, 2)}


def test_subtitles(spark, tmp_path):
    (tmp_path / "a.srt").write_text("1\n00:00:01,500 --> 00:00:03,000\nHello\nthere\n\n2\nno time\n\n3\n01:00:00,000 --> 01:00:01,250\nBye\n")
    got = [(r.start_sec, r.end_sec, r.text) for r in logs.subtitles(spark, str(tmp_path)).orderBy("n").collect()]
    assert got == [(1.5, 3.0, "Hello there"), (3600.0, 3601.25, "Bye")]


def test_transcript_dialects(spark):
    lines = [
        "[2024-12-01 10:00:00 HKT -> 2024-12-01 10:00:05 HKT] hi there", "[2024-12-01 10:00:07 -> 2024-12-01 10:00:09]bare", "[1:02:03 - 1:02:05] hyphen", "[0:59\u20131:00] en dash, no seconds", "[12:00:01 \u2014 12:00:02]",
        "[2024-13-01 10:00:00 -> 2024-12-01 10:00:05] no such month", "[10 - 12] no", "noise", "", None,
    ]
    got = [(str(r.start_time), str(r.end_time), r.body) for r in logs.transcript(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)).collect()]
    assert got == [
        ("2024-12-01 10:00:00", "2024-12-01 10:00:05", "hi there"), ("2024-12-01 10:00:07", "2024-12-01 10:00:09", "bare"), ("2000-01-01 01:02:03", "2000-01-01 01:02:05", "hyphen"),
        ("2000-01-01 00:59:00", "2000-01-01 01:00:00", "en dash, no seconds"), ("2000-01-01 12:00:01", "2000-01-01 12:00:02", ""),
    ]


def test_gaze_last_row_wins(spark, tmp_path):
    (tmp_path / "g.csv").write_text("frame_file,gaze_x,gaze_y,in_bounds\nf1,1,2,True\nf1,3,oops,true\nf2,,5,0\n")
    got = {r.frame_file: (r.gaze_x, r.gaze_y, r.in_bounds) for r in logs.gaze(spark, str(tmp_path / "g.csv")).collect()}
    assert got == {"f1": (3.0, None, True), "f2": (None, 5.0, False)}


def test_manifest_columns(spark, tmp_path):
    rows = [{"path": "main/day1/Allie/video/08.mp4", "bytes": 5}, {"video": "main/day2/Kitchen/video/20.mp4", "video_bytes": 6}, {"path": None}, {"path": "main/day9/x/video/08.mp4"}]
    (tmp_path / "m.jsonl").write_text("\n".join(map(json.dumps, rows)))
    got = sorted((r.stream, r.day, r.hour, r.bytes, str(r.date)) for r in logs.manifest(spark, str(tmp_path)).collect())
    assert got == [("Allie", 1, 8, 5, "2024-12-03"), ("Kitchen", 2, 20, 6, "2024-12-04")]


def _tar(path, count=40):
    import random

    rng = random.Random(3)
    with tarfile.open(path, "w", format=tarfile.GNU_FORMAT) as t:
        for i in range(count):
            name = ("n" * rng.randint(120, 600) if i % 5 == 0 else f"{'left' if i < 25 else 'right'}/f{i}") + f"_{i}.{'jpg' if i % 3 else 'txt'}"
            info = tarfile.TarInfo(name)
            info.size = rng.choice([0, 1, 511, 512, 513, 5000])
            t.addfile(info, io.BytesIO(bytes([i]) * info.size))
    with tarfile.open(path) as t:
        return {(m.name, m.offset_data, m.size) for m in t.getmembers()}


@pytest.mark.parametrize("size", [512, 1536, 4096, 1 << 20])
def test_tar_members_by_ranges(spark, tmp_path, size):
    path = tmp_path / "a.tar"
    want = _tar(path)
    archives.register(spark)
    read = lambda **o: spark.read.format("tar").options(path=str(path), partition_bytes=size, **o)
    assert sorted((r.name, r.offset, r.size) for r in read().schema("name string, offset long, size long").load().collect()) == sorted(want)
    got = read(suffix=".jpg", contains="right").load().collect()
    assert {(r.name, r.offset, r.size) for r in got} == {w for w in want if w[0].endswith(".jpg") and "right" in w[0]}
    assert all(bytes(r.content) == bytes([int(r.name.split("_")[-1].split(".")[0])]) * r.size for r in got)


def test_tails_and_sections(tmp_path):
    path = tmp_path / "a.tar"
    want = _tar(path)
    source = archives.FileRange(str(path))
    assert set(archives.headers(source)) == want
    tail = archives.tail_entries(source, lambda e: any("f26_" in x[0] for x in e), first=1024)
    assert any("f26_" in x[0] for x in tail) and set(tail) < want
    assert set(archives.tail_entries(source, lambda e: False, first=1024)) == want
    left = lambda e: any("left/" in x[0] or int(x[0].split("_")[-1].split(".")[0]) < 25 for x in e)
    lo, hi = archives.boundary(source, left, probe=4096)
    assert lo < hi <= source.size
    assert archives.section(source, left, lambda n: "right/" in n, probe=4096)[0].startswith("right/f26")
    assert archives.section(source, left, lambda n: n.startswith("left/f1_"), probe=4096)[0].startswith("left/f1_")
    assert archives.section(source, left, lambda n: "none" in n, probe=4096) is None


def test_ranges_behind_an_address(tmp_path):
    import http.server
    import threading

    path = tmp_path / "a.bin"
    path.write_bytes(bytes(range(256)) * 40)
    fails = [2]

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_HEAD(self):
            self.send_response(200)
            self.send_header("Content-Length", "10240")
            self.end_headers()

        def do_GET(self):
            a, b = map(int, self.headers["Range"].removeprefix("bytes=").split("-"))
            short = fails[0] > 0
            fails[0] -= 1
            data = path.read_bytes()[a : b + 1 - short]
            self.send_response(206)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        source = archives.HttpRange(f"http://127.0.0.1:{server.server_port}/a", pause=0)
        assert source.size == 10240 and source.read(255, 3) == b"\xff\x00\x01" and source.read(10239, 50) == b"\xff" and source.read(20000, 5) == b""
        fails[0] = 99
        with pytest.raises(OSError, match="not read"):
            source.read(0, 10)
    finally:
        server.shutdown()


def test_listings_recordings_and_captions(spark, tmp_path):
    for name in ("DAY1_A1_JAKE_10000000.mp4", "DAY1_A1_JAKE_10003000.mp4", "DAY1_A1_JAKE_10020000.mp4", "DAY2_A1_JAKE_10000000.mp4", "DAY1_A2_X_10000000.mp4"):
        (tmp_path / "v" / "sub").mkdir(parents=True, exist_ok=True)
        (tmp_path / "v" / "sub" / name).write_bytes(b"x" * 5)
    got = [(r.path, r.size) for r in archives.inventory(spark, str(tmp_path / "v"), r"DAY1_A1").collect()]
    assert got == [(f"sub/DAY1_A1_JAKE_{t}.mp4", 5) for t in ("10000000", "10003000", "10020000")]
    x = logs.recordings(spark, str(tmp_path / "v"), "A1_JAKE", 1).orderBy("start_sec").collect()
    assert [(r.start_sec, r.is_break) for r in x] == [(36000.0, True), (36030.0, False), (36120.0, True)]
    assert [r.start_sec for r in logs.recordings(spark, str(tmp_path / "v"), "A1_JAKE", 1, 36030.0, 36120.0).collect()] == [36030.0]
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "A1_JAKE_DAY1_10000000.srt").write_text("1\n00:00:01,500 --> 00:00:03,000\nHello\nthere\n\n2\n00:59:59,000 --> 01:00:01,000\nlate\n\n3\n00:00:05,000 --> 00:00:06,000\n\n")
    clips = spark.createDataFrame([("c1", "A1_JAKE", 1, 36002.0, 36032.0), ("c2", "A1_JAKE", 1, 39599.5, 39629.5), ("c3", "A1_JAKE", 1, 36003.0, 36033.0), ("c4", "A2_X", 1, 36000.0, 36030.0)], "clip_id string, participant string, day int, start_sec double, end_sec double")
    assert sorted(tuple(r) for r in logs.dense_captions(spark, str(tmp_path / "s"), clips).collect()) == [("c1", 0.0, 1.0, "Hello there"), ("c2", 0.0, 1.5, "late")]


def _box(kind, body):
    return struct.pack(">I4s", 8 + len(body), kind) + body


def test_durations_come_from_the_video_track(spark, tmp_path):
    def track(kind, scale, length):
        mdhd = _box(b"mdhd", bytes(12) + struct.pack(">II", scale, length) + bytes(4))
        return _box(b"trak", _box(b"mdia", mdhd + _box(b"hdlr", bytes(8) + kind + bytes(12))))

    moov = _box(b"moov", _box(b"mvhd", bytes(12) + struct.pack(">II", 1000, 99_000) + bytes(80)) + track(b"soun", 48_000, 48_000 * 31) + track(b"vide", 1000, 29_500))
    (tmp_path / "a.mp4").write_bytes(_box(b"ftyp", b"isom") + struct.pack(">I4sQ", 1, b"mdat", 16 + 1000) + bytes(1000) + moov)
    (tmp_path / "b.mp4").write_bytes(b"no video")
    d = spark.createDataFrame([(str(tmp_path / f"{n}.mp4"),) for n in "abc"], "path string")
    assert {r.path[-5]: r.duration_sec for r in archives.probed(d).collect()} == {"a": 29.5, "b": None, "c": None}


def test_documents_and_finals(spark, tmp_path):
    d = spark.createDataFrame([(1, 1.5, {"a": 2.0}), (2, None, {"a": 3.0})], "i int, x double, s struct<a: double>")
    sinks.write_documents(d, str(tmp_path / "d"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "d")).collect()) == ['{"i":1,"x":1.5,"s":{"a":2.0}}', '{"i":2,"s":{"a":3.0}}']
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        sinks.write_documents(d, str(tmp_path / "d"))
    with pytest.raises(Exception, match="not finite"):
        sinks.write_documents(spark.createDataFrame([([1.0, float("nan")],)], "x array<double>"), str(tmp_path / "e"))
    f = spark.createDataFrame([(3, "f", True, '{"a": 3}'), (1, "f", True, '{"a": 1}'), (2, "g", True, '{"a": 2}'), (4, "f", False, "{}"), (5, "f", True, "{")], "clip_index long, fingerprint string, ok boolean, document string")
    sinks.export_finals(f, "f", str(tmp_path / "f"))
    assert [r.value for r in spark.read.text(str(tmp_path / "f")).collect()] == ['{"a": 1}', '{"a": 3}']
    segments = spark.createDataFrame([("r1", 2, "b"), ("r1", 1, "a"), ("r2", 1, "c")], "recording string, start int, text string")
    sinks.write_outputs(spark.createDataFrame([("r1", 2)], "recording string, n int"), segments, str(tmp_path / "o"))
    assert sorted((r.recording, r.value) for r in spark.read.text(str(tmp_path / "o" / "text")).collect()) == [("r1", "[1] a"), ("r1", "[2] b"), ("r2", "[1] c")]


def test_audio_at_another_rate():
    x = (np.sin(np.arange(48_000) / 60) * 10_000).astype("<i2")
    y = archives.resampled(x, 48_000)
    assert len(y) == 16_000 and np.abs(y - x[::3]).max() <= 1
    wav = archives.slice_16k(archives.wav_of(x, 48_000), 0.25, 0.5)
    assert archives.wav_chunks(wav)[:3] == (16_000, 1, 16) and archives.wav_chunks(wav)[4] == 16_000


def test_wav_frames():
    x = (np.sin(np.arange(16000) / 10) * 10000).astype("<i2")
    wav = b"RIFF" + struct.pack("<I", 36 + 2 * len(x)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 16000, 32000, 2, 16) + b"data" + struct.pack("<I", 2 * len(x)) + x.tobytes()
    frames = archives.rms_frames(wav)
    assert len(frames) == 33 and abs(frames.mean() - 10000 / 32768 / np.sqrt(2)) < 0.01
    assert len(archives.pcm_slice(wav, 0.5, 10.0)) == 16000
    with pytest.raises(ValueError):
        archives.wav_chunks(b"none")


def test_write_once(spark, tmp_path):
    path = str(tmp_path / "t")
    d = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "1")], "k string, v string")
    assert sinks.write_once(d, path, "k", "v") == 2
    assert sinks.write_once(d, path, "k", "v") == 0
    with pytest.raises(sinks.Conflict):
        sinks.write_once(spark.createDataFrame([("a", "9")], "k string, v string"), path, "k", "v")


def test_bounded_and_versioned(spark, tmp_path):
    d = spark.range(5)
    with pytest.raises(ValueError):
        sinks.write_bounded(d, str(tmp_path / "b"), most_rows=4)
    sinks.write_bounded(d, str(tmp_path / "b"))
    assert spark.read.json(str(tmp_path / "b")).count() == 5
    state = sinks.VersionedState(spark, str(tmp_path / "s"))
    g = state.write(spark.createDataFrame([("ready",)], "status string"), state.read()[0])
    assert state.read()[1].first().status == "ready"
    with pytest.raises(sinks.Conflict):
        state.write(spark.createDataFrame([("x",)], "status string"), g - 1)


@pytest.mark.parametrize(
    ("text", "want"),
    [('{"a": [1, 2, {"b": "x', {"a": [1, 2, {}]}), ('{"a": 1, "b', {"a": 1}), ('noise {"a": {"b": 2}, "c": [3', {"a": {"b": 2}, "c": []}), ('```json\n{"a": 1}\n```', {"a": 1}), ("nothing", None), (None, None)],
)
def test_salvage(text, want):
    assert salvage.salvaged_object(text)[0] == want


def test_strict_rejects_trailing_text():
    assert salvage.strict_object('{"a": 1} xx') is None and salvage.strict_object('{"a": 1, "a": 2}') == {"a": 2} and salvage.strict_object("[1]") is None
