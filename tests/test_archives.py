"""Tails, sections, conditions and read-ahead as what the reader of archives does, by the bytes that a server is asked for."""

import http.server
import io
import tarfile
import threading
import time

import pytest

from lumentrace.sources import archives


def write_tar(path, members):
    with tarfile.open(path, "w", format=tarfile.GNU_FORMAT) as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


@pytest.fixture
def server(tmp_path):
    """Files of a folder by ranges; asked holds (path, first, last) of each request, and together how many were open at once at most."""

    class Handler(http.server.BaseHTTPRequestHandler):
        asked, open, together, pause, lock = [], 0, 0, 0.0, threading.Lock()

        def do_HEAD(self):
            self.send_response(200)
            self.send_header("Content-Length", str((tmp_path / self.path[1:]).stat().st_size))
            self.end_headers()

        def do_GET(self):
            with Handler.lock:
                Handler.open += 1
                Handler.together = max(Handler.together, Handler.open)
            time.sleep(Handler.pause)
            a, b = map(int, self.headers["Range"].removeprefix("bytes=").split("-"))
            Handler.asked.append((self.path, a, b))
            data = (tmp_path / self.path[1:]).read_bytes()[a : b + 1]
            with Handler.lock:
                Handler.open -= 1
            self.send_response(206)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    Handler.address = f"http://127.0.0.1:{s.server_port}"
    yield Handler
    s.shutdown()


KIB = 1 << 10
PARTS = [
    *((f"rec/eye/f{i:03}.jpg", bytes([i % 251]) * (40 * KIB)) for i in range(60)),
    ("rec/audio/" + "long" * 40 + "/sound.wav", b"w" * 5000),
    ("rec/audio/transcript.txt", b"t" * 700),
    *((f"rec/picture/p{i:03}.jpg", bytes([i % 251]) * (20 * KIB)) for i in range(40)),
    *((f"rec/picture/ocr/p{i:03}.txt", b"text %d" % i) for i in range(40)),
]


def read(spark, path, **options):
    archives.register(spark)
    return spark.read.format("tar").options(path=path, partition_bytes=256 * KIB, **options).load()


def test_tail_reads_the_tail(spark, tmp_path, server):
    write_tar(tmp_path / "a.tar", PARTS)
    size = (tmp_path / "a.tar").stat().st_size
    url = f"{server.address}/a.tar"
    got = read(spark, url, tail=r"ocr/p000\.txt$", tail_bytes=8 * KIB).select("name", "content").collect()
    names = [n for n, _ in PARTS]
    assert [r.name for r in got] == names[-len(got) :] and "rec/picture/ocr/p000.txt" in names[-len(got) :]
    assert all(bytes(r.content) == dict(PARTS)[r.name] for r in got)
    assert min(a for _, a, _ in server.asked) > size // 2
    # a name that is nowhere: all is read
    assert read(spark, url, tail="nowhere", tail_bytes=64 * KIB).count() == len(PARTS)
    # or no more than the most that a tail may have
    server.asked.clear()
    some = read(spark, url, tail="nowhere", tail_bytes=8 * KIB, tail_most=16 * KIB).select("name").collect()
    assert 0 < len(some) < 60 and min(a for _, a, _ in server.asked) >= size - 64 * KIB


def test_section_reads_what_bisection_asks_for(spark, tmp_path, server):
    write_tar(tmp_path / "a.tar", PARTS)
    size = (tmp_path / "a.tar").stat().st_size
    url = f"{server.address}/a.tar"
    where = {"left": r"/eye/.*\.jpg$", "wanted": r"sound\.wav$", "probe_bytes": 64 * KIB}
    got = read(spark, url, **where, end=int(size * 0.8)).schema
    got = [r.name for r in read(spark, url, **where).select("name").collect()]
    assert got == [n for n, _ in PARTS][60:]
    server.asked.clear()
    start, end = archives.planned(url, {**where, "probe_bytes": str(64 * KIB)})
    asked = sum(b - a + 1 for _, a, b in server.asked)
    assert end == size and asked < size / 2 and [n for n, _, _ in archives.headers(archives.open_range(url), start)][0].endswith("sound.wav")
    assert read(spark, url, left="/eye/", wanted="none").count() == 0
    with pytest.raises(Exception, match="wanted"):
        read(spark, url, left="/eye/").count()


def test_conditions_come_before_contents(spark, tmp_path, server):
    for n in "ab":
        write_tar(tmp_path / f"{n}.tar", PARTS)
    urls = [f"{server.address}/{n}.tar" for n in "ab"]
    x = read(spark, ",".join(urls)).where(f"path = '{urls[0]}' AND name LIKE '%/transcript.txt' AND size < 1000")
    assert [(r.path, r.name, bytes(r.content)) for r in x.collect()] == [(urls[0], "rec/audio/transcript.txt", b"t" * 700)]
    assert {p for p, _, _ in server.asked} == {"/a.tar"}
    y = read(spark, urls[0]).where("name LIKE 'rec/picture/%' AND name LIKE '%p01%' AND size >= 5 AND offset > 10 AND size IN (20480, 7)")
    assert y.count() == sum("picture" in n and "p01" in n and len(d) in (20480, 7) for n, d in PARTS) == 20
    assert read(spark, urls[0]).where("name = 'none' OR size = 700").count() == 1


def test_read_ahead_overlaps_and_keeps_order(spark, tmp_path, server):
    write_tar(tmp_path / "a.tar", PARTS)
    data = (tmp_path / "a.tar").read_bytes()
    url = f"{server.address}/a.tar"
    server.pause = 0.02
    source = archives.Ahead(archives.open_range(url), chunk=32 * KIB, ahead=4)
    out = b"".join(source.read(at, 10_000) for at in range(0, len(data), 10_000))
    assert out == data and 2 <= server.together <= 4
    assert source.read(100, 70_000) == data[100:70_100] and source.read(len(data) - 5, 50) == data[-5:] and source.read(len(data), 1) == b""
    source.close()
    # each chunk is asked for once on the way forward, and none beyond the end
    server.asked.clear()
    source = archives.Ahead(archives.open_range(url), end=200 * KIB, chunk=32 * KIB, ahead=4)
    for at in range(0, 200 * KIB, 5000):
        source.read(at, min(5000, 200 * KIB - at))
    source.close()
    assert sorted(a for _, a, _ in server.asked) == [c * 32 * KIB for c in range(7)]
    server.together = 0
    got = read(spark, url, read_ahead=4, read_ahead_bytes=32 * KIB).select("name", "content").collect()
    assert sorted((r.name, bytes(r.content)) for r in got) == sorted(PARTS) and server.together > 1


def test_members_of_listed_archives(spark, tmp_path):
    for n in range(3):
        write_tar(tmp_path / f"{n}.tar", PARTS[n:])
    files = spark.createDataFrame([(str(tmp_path / f"{n}.tar"),) for n in range(3)], "path string")
    got = archives.members(files, suffix=".txt", partition_bytes=128 * KIB)
    assert got.count() == 3 * 41 and all(bytes(r.content) == dict(PARTS)[r.name] for r in got.collect())
    tails = archives.members(files, content=False, tail=r"p039\.jpg", tail_bytes=8 * KIB, partition_bytes=16 * KIB)
    assert "content" not in tails.columns and tails.where("name LIKE '%p039.jpg'").count() == 3 and tails.count() < 3 * 60
