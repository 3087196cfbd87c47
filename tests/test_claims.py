"""Claims, commits, states and effects under several writers."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lumentrace.sources import claims, sinks
from lumentrace.streaming import outbox as O


def at_once(*tasks):
    """Results or errors of tasks that begin together."""
    gate = threading.Barrier(len(tasks))

    def run(t):
        gate.wait()
        try:
            return t()
        except Exception as e:  # noqa: BLE001
            return e

    with ThreadPoolExecutor(len(tasks)) as pool:
        return list(pool.map(run, tasks))


def test_one_of_many_takes_a_name(spark, tmp_path):
    for i in range(20):
        won = at_once(*(lambda w=w: claims.claim(spark, f"{tmp_path}/n/{i}", f"writer {w}") for w in range(6)))
        assert sorted(won) == [False] * 5 + [True]
        assert claims.taken(spark, f"{tmp_path}/n/{i}") == f"writer {won.index(True)}"
    assert claims.taken(spark, f"{tmp_path}/n/none") is None and len(claims.names(spark, f"{tmp_path}/n")) == 20


@pytest.mark.parametrize("scheme", ["rename", "store"])
def test_other_file_systems(spark, tmp_path, monkeypatch, scheme):
    """The ways of HDFS and of object stores, by the local file system of Hadoop."""

    class Uri:
        def __init__(self, uri):
            self.uri = uri

        def getScheme(self):
            return "s3a" if scheme == "store" else "hdfs"

    real = claims._hadoop

    class Fs:
        def __init__(self, fs):
            self.fs = fs

        def getUri(self):
            return Uri(self.fs.getUri()) if scheme == "store" else Here(self.fs.getUri())

        def __getattr__(self, name):
            return getattr(self.fs, name)

    class Here(Uri):
        pass

    def hadoop(s, path):
        jvm, conf, p, fs = real(s, path)
        return jvm, conf, p, Fs(fs)

    monkeypatch.setattr(claims, "_hadoop", hadoop)
    if scheme == "rename":
        context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext

        class Jvm:
            class org:
                class apache:
                    class hadoop:
                        class fs:
                            Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
                            Options = spark.sparkContext._jvm.org.apache.hadoop.fs.Options

                            class FileContext:
                                @staticmethod
                                def getFileContext(uri, conf):
                                    return context.getFileContext(uri.uri, conf)

        monkeypatch.setattr(claims, "_hadoop", lambda s, path: (Jvm, *hadoop(s, path)[1:]))
    assert claims.claim(spark, f"file://{tmp_path}/x/1", "a") and not claims.claim(spark, f"file://{tmp_path}/x/1", "b")
    assert claims.taken(spark, f"file://{tmp_path}/x/1") == "a"


def test_writers_of_the_same_keys(spark, tmp_path):
    """No key is lost or doubled, whoever comes first; other content is refused."""
    path = str(tmp_path / "t")
    part = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).cast("string").alias("v"))
    written = at_once(lambda: sinks.write_once(part(0, 60), path, "k", "v"), lambda: sinks.write_once(part(30, 90), path, "k", "v"), lambda: sinks.write_once(part(0, 90), path, "k", "v"))
    assert sum(written) == 90
    rows = spark.read.parquet(path)
    assert rows.count() == 90 and rows.select("k").distinct().count() == 90
    with pytest.raises(sinks.Conflict):
        sinks.write_once(part(0, 3).withColumn("v", F.lit("other")), path, "k", "v")
    assert sinks.write_once(part(80, 100), path, "k", "v") == 10 and spark.read.parquet(path).count() == 100
    one = at_once(*(lambda v=v: sinks.write_once(spark.createDataFrame([("same", v)], "k string, v string"), path, "k", "v") for v in "ab"))
    assert sorted(map(type, one), key=str) == sorted([int, sinks.Conflict], key=str)
    assert not [n for n in claims.names(spark, path) if n.startswith("_pending")]


def test_input_that_changes_is_computed_once(spark, tmp_path):
    path = str(tmp_path / "t")
    d = spark.range(50).select(F.col("id").cast("string").alias("k"), F.uuid().alias("v"))
    assert sinks.write_once(d, path, "k", "v") == 50
    assert sinks.write_once(spark.createDataFrame([(None, None), (None, None)], "k string, v string"), path, "k", "v") == 1
    assert sinks.write_once(spark.createDataFrame([(None, None)], "k string, v string"), path, "k", "v") == 0


def test_a_writer_that_died_behind_its_claim_is_completed(spark, tmp_path):
    path = str(tmp_path / "t")
    d = spark.createDataFrame([("a", "1")], "k string, v string")
    sinks.write_once(d, path, "k", "v")
    commits = claims.Commits(spark, path)
    own = commits.pending()
    spark.createDataFrame([("b", "2")], "k string, v string").withColumn("_sha", F.sha2(F.lit("12"), 256)).write.parquet(f"{path}/{own}")
    assert claims.claim(spark, f"{path}/_claims/2", own) and spark.read.parquet(path).count() == 1
    assert sinks.write_once(spark.createDataFrame([("b", "2"), ("c", "3")], "k string, v string"), path, "k", "v") == 1
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]


def test_states_of_two_writers(spark, tmp_path):
    state = sinks.VersionedState(spark, str(tmp_path / "s"))
    assert state.read() == (0, None)
    first = lambda w: spark.createDataFrame([(w, 0)], "who string, n long")
    done = at_once(lambda: state.write(first("a"), 0), lambda: state.write(first("b"), 0))
    assert sorted(map(type, done), key=str) == sorted([int, sinks.Conflict], key=str)
    add = lambda s: s.withColumn("n", F.col("n") + 1)
    assert sorted(at_once(*[lambda: state.update(add)] * 4)) == [2, 3, 4, 5]
    assert state.read()[0] == 5 and state.read()[1].first().n == 4  # no update is lost
    with pytest.raises(sinks.Conflict):
        state.write(first("late"), 4)
    with pytest.raises(ValueError):
        state.write(first("x"), -1)
    assert len([n for n in claims.names(spark, str(tmp_path / "s")) if n.startswith("state-")]) == 5


class Provider:
    """Jobs by name; may fail before or after it has accepted one."""

    def __init__(self):
        self.jobs, self.rows, self.fail = [], {}, None

    def create(self, name, rows):
        if self.fail == "before":
            raise OSError
        self.jobs.append(name)
        self.rows[name] = sorted(r.request_id for r in rows.collect())
        if self.fail == "after":
            raise OSError
        return f"jobs/{len(self.jobs)}"

    def find(self, name):
        return [f"jobs/{i}" for i, n in enumerate(self.jobs, 1) if n == name]


def test_names_follow_from_requests(spark):
    r = spark.createDataFrame([(f"r{i}",) for i in range(40)], "request_id string")
    whole = O.submissions(r, "run", "audio", 100).select("submission").distinct().collect()
    assert [x.submission for x in whole] == [O.submission_name("run", "audio", [f"r{i}" for i in range(40)][::-1])]
    parts = O.submissions(r, "run", "audio", 10)
    assert parts.count() == 40 and 2 <= parts.select("submission").distinct().count() <= 4
    assert {tuple(x) for x in parts.collect()} == {tuple(x) for x in O.submissions(r.repartition(7), "run", "audio", 10).collect()}


@pytest.mark.parametrize("fail", ["before", "after", None])
def test_replay_after_a_crash_between_intent_and_outcome(spark, tmp_path, fail):
    now, provider = [1000.0], Provider()
    box = O.Outbox(spark, str(tmp_path / "box"), provider.create, provider.find, lambda: now[0])
    rows = spark.createDataFrame([("r1",), ("r2",)], "request_id string")
    name = O.submission_name("run", "audio", ["r1", "r2"])
    provider.fail = fail
    assert box.submit(name, rows) == ("running" if fail is None else "submitting")
    provider.fail = None
    assert box.submit(name, rows) == ("submitting" if fail == "before" else "running")
    assert len(provider.jobs) == (0 if fail == "before" else 1) and box.open() == ([name] if fail == "before" else [])
    now[0] += O.GRACE
    assert box.reconcile(name) == ("needs_attention" if fail == "before" else "running")
    if fail == "before":  # the provider lists it at last
        provider.jobs.append(name)
        assert box.reconcile(name) == "running"
    assert box.jobs() == {name: "jobs/1"}
    assert box.reconcile("nothing of that name") == "ready"


def test_several_matches_need_attention(spark, tmp_path):
    provider = Provider()
    box = O.Outbox(spark, str(tmp_path / "box"), provider.create, provider.find)
    provider.fail = "after"
    box.submit("n", spark.createDataFrame([("r",)], "request_id string"))
    provider.jobs.append("n")
    assert box.reconcile("n") == "needs_attention" and box.jobs() == {}


def test_two_submitters_make_one_job(spark, tmp_path):
    provider = Provider()
    rows = spark.createDataFrame([("r",)], "request_id string")
    boxes = [O.Outbox(spark, str(tmp_path / "box"), provider.create, provider.find) for _ in range(4)]
    got = at_once(*(lambda b=b: b.submit("n", rows) for b in boxes))
    assert provider.jobs == ["n"] and set(got) <= {"running", "submitting"}


def test_stream_of_requests_is_submitted_once(spark, tmp_path):
    """The same batch, run again with a new checkpoint as after a crash before its commit, has no further effect."""
    spark.createDataFrame([(f"r{i}", i) for i in range(25)], "request_id string, n int").write.parquet(str(tmp_path / "in"))
    provider = Provider()
    box = O.Outbox(spark, str(tmp_path / "box"), provider.create, provider.find)
    for attempt in range(2):
        stream = spark.readStream.schema("request_id string, n int").parquet(str(tmp_path / "in"))
        q = O.submit_stream(stream, box, str(tmp_path / f"cp{attempt}"), "run", "audio", most=9)
        q.awaitTermination(120)
        assert q.exception() is None
    assert sorted(sum(provider.rows.values(), [])) == sorted(f"r{i}" for i in range(25))
    assert len(provider.jobs) == len(set(provider.jobs)) == len(box.jobs()) > 1


def test_folder_renamed_by_another_in_between(spark, tmp_path, monkeypatch):
    """Two writers settle the same commit; the second finds its folder while it looks and gone when it renames."""
    hadoop = claims._hadoop

    class Both:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            self.fs.rename(a, b)
            return self.fs.rename(a, b)

    commits = claims.Commits(spark, str(tmp_path / "t"))
    own = commits.pending()
    spark.range(3).write.parquet(f"{commits.root}/{own}")
    monkeypatch.setattr(claims, "_hadoop", lambda s, path: (*hadoop(s, path)[:3], Both(hadoop(s, path)[3])))
    assert commits.commit(0, own) and spark.read.parquet(commits.place(1)).count() == 3
