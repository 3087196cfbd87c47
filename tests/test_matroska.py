"""Durations of Matroska files that are put together here."""

import pytest

from lumentrace.sources import archives
from lumentrace.sources import matroska as M


def element(kind, content, size_bytes=None, unknown=False):
    n = size_bytes or (1 if len(content) < 127 else 8)
    size = (1 << 7 * n) - 1 if unknown else len(content)
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + (size | 1 << 7 * n).to_bytes(n, "big") + content


def number(kind, value):
    return element(kind, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def track(uid, kind, video=b""):
    return element(M.TRACK, number(0xD7, uid) + number(M.TRACK_UID, uid) + number(M.TRACK_TYPE, kind) + video)


def tag(uid, name, text):
    return element(M.TAG, element(M.TARGETS, number(M.TAG_TRACK_UID, uid)) + element(M.SIMPLE_TAG, element(M.TAG_NAME, name.encode()) + element(M.TAG_STRING, text.encode())))


TRACKS = element(M.TRACKS, track(901, 2) + track(77, 1, element(M.VIDEO, number(M.WIDTH, 320) + number(M.HEIGHT, 180))))
TAGS = element(M.TAGS, tag(901, "DURATION", "00:00:31.500000000") + tag(77, "ENCODER", "x") + tag(77, "DURATION", "01:02:03.250000000\0"))
INFO = element(0x1549A966, element(0x4489, b"\x40" * 8))


def matroska(*parts, unknown=False):
    body = b"".join(parts)
    return element(M.EBML, element(0x4282, b"matroska")) + element(M.SEGMENT, body, 8, unknown)


def clusters(n=3, unknown=False):
    return b"".join(element(M.CLUSTER, bytes(900), 8, unknown and i == 0) for i in range(n))


def with_head():
    """Tags behind clusters of no known size, where only the head tells of them."""

    def head(to):
        return element(M.SEEK_HEAD, element(M.SEEK, element(M.SEEK_ID, M.TAGS.to_bytes(4, "big")) + element(M.SEEK_POSITION, to.to_bytes(4, "big"))))

    to = len(head(0)) + len(TRACKS) + len(clusters())
    return matroska(head(to), TRACKS, clusters(unknown=True), TAGS, unknown=True)


FILES = {
    "a.mkv": (matroska(INFO, TRACKS, TAGS, clusters()), 3723.25),
    "b.webm": (matroska(INFO, TRACKS, clusters(), TAGS, unknown=True), 3723.25),
    "c.mkv": (with_head(), 3723.25),
    "d.mkv": (matroska(INFO, TRACKS, clusters()), None),
    "e.mkv": (matroska(TAGS, element(M.TRACKS, track(901, 2))), None),
    "f.mkv": (matroska(TRACKS, element(M.TAGS, tag(77, "duration", "soon"))), None),
    "g.mkv": (matroska(INFO, TRACKS, TAGS)[:90], None),
    "h.mkv": (b"\x1a\x45\xdf\xa3", None),
}


def test_tracks(tmp_path):
    (tmp_path / "a.mkv").write_bytes(FILES["a.mkv"][0])
    assert M.tracks(archives.FileRange(str(tmp_path / "a.mkv"))) == [{"kind": "soun", "width": None, "height": None, "seconds": 31.5}, {"kind": "vide", "width": 320, "height": 180, "seconds": 3723.25}]


@pytest.mark.parametrize(("text", "want"), [("00:00:20.000000000", 20.0), ("1:00:00", 3600.0), ("00:00:00", None), ("20", None), ("0:x:1", None), ("00:00:inf", None)])
def test_seconds(text, want):
    assert M.seconds(text) == want


def test_durations(spark, tmp_path):
    for name, (data, _) in FILES.items():
        (tmp_path / name).write_bytes(data)
    d = spark.createDataFrame([(str(tmp_path / n),) for n in FILES], "path string")
    assert {r.path.rsplit("/")[-1]: r.duration_sec for r in archives.probed(d).collect()} == {n: s for n, (_, s) in FILES.items()}
