"""JSON logs by ranges against one pass over the file."""

import json
import random

import pytest

from lumentrace.sources import jsonlog, logs
from lumentrace.sources.archives import open_range


def damaged(seed, n=120):
    """Objects on a line, over lines, within others, behind and around damage; wrappers whose end is missing."""
    rng = random.Random(seed)

    def value(depth=0):
        if depth < 3 and rng.random() < 0.3:
            return rng.choice([{"k": value(depth + 1)}, [value(depth + 1)]])
        return rng.choice([1, -2.5e3, True, None, "é{}[]\"\\ü", "{", "x" * 30, {}, []])

    out = []
    for i in range(n):
        obj = json.dumps({"i": i, "v": value(), "w": value()}, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, None, 1]))
        out.append(
            rng.choice(
                [obj + "\n", obj + "\n", obj + "\n", obj + " " + obj, obj[: rng.randrange(len(obj))] + "\n", "noise { \n", '{"open": [\n', "\n\r\n", '{"s": "a\nb"}\n', "[" + obj + "]\n", '{"deep":\n' * 3 + obj + "\n}}\n}"]
            )
        )
    return "".join(out)


def plain(text, path=None):
    """Places in bytes, from a pass over the text."""
    return [(len(text[:at].encode()), obj) for at, obj in logs.json_objects(text)]


@pytest.mark.parametrize("size", [40, 333, 5000, 1 << 20])
def test_objects_of_ranges_are_those_of_one_pass(spark, tmp_path, size):
    texts = {f"{i}.log": damaged(i, 20 if size == 40 else 120) for i in range(3)} | {"empty.log": "", "blank.log": "\n \n"}
    for name, t in texts.items():
        (tmp_path / name).write_bytes(t.encode())
    got = {}
    for r in logs.resync_json(spark, str(tmp_path), range_bytes=size).collect():
        got.setdefault(r.path.rsplit("/")[-1], []).append((r.place, r.json))
    want = {name: plain(t) for name, t in texts.items() if plain(t)}
    assert {k: sorted(v) for k, v in got.items()} == want and sum(map(len, want.values())) > 20


def test_one_object_over_many_ranges(spark, tmp_path):
    inner = "\n".join('{"n": %d},' % i for i in range(300))
    whole = '{"all": [\n' + inner + "\n0]}\n" + '{"after": 1}\n'
    (tmp_path / "a.log").write_text(whole)
    assert [json.loads(r.json).keys() for r in logs.resync_json(spark, str(tmp_path), range_bytes=500).orderBy("place").collect()] == [{"all"}, {"after"}]
    # beyond the length that an object may have, its parts are what can be read
    got = logs.resync_json(spark, str(tmp_path), range_bytes=500, longest=200).orderBy("place").collect()
    assert [json.loads(r.json) for r in got] == [*({"n": i} for i in range(300)), {"after": 1}]


def test_objects_longer_than_what_is_read_at_once(tmp_path, monkeypatch):
    monkeypatch.setattr(jsonlog, "CHUNK", 16)
    t = damaged(9, 60)
    (tmp_path / "a.log").write_bytes(t.encode())
    source = open_range(str(tmp_path / "a.log"))
    assert [(p, x.encode("latin-1").decode()) for p, _, x in jsonlog.objects(source, 0, source.size)] == plain(t)


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_line_numbers(spark, tmp_path, size):
    texts = {"a.log": '{"a": 1}\nnot json\n{"a": \n\n{"a": 2}\n', "b.log": "\n\n x \r\n{\"a\": 7}", "c.log": "é" * 40 + "\n" + '{"a": 3}\n'}
    for name, t in texts.items():
        (tmp_path / name).write_bytes(t.encode())
    got = sorted((r.path.rsplit("/")[-1], r.line, r.text) for r in jsonlog.numbered_lines(spark, str(tmp_path), range_bytes=size).collect())
    assert got == [(n, i, x) for n, t in sorted(texts.items()) for i, x in enumerate(t.split("\n"), 1) if x.strip()]
    marked = {(r.path.rsplit("/")[-1], r.line): (r.unparsable, r.raw, r.a) for r in logs.marked_lines(spark, str(tmp_path), "a LONG", range_bytes=size).collect()}
    assert marked["a.log", 2] == (True, "not json", None) and marked["a.log", 5] == (False, None, 2) and marked["b.log", 4] == (False, None, 7) and len(marked) == 8


def test_no_file_is_a_row(spark, tmp_path):
    (tmp_path / "a.log").write_text('{"a": 1}\n' * 1000)
    r = jsonlog.ranges(spark, str(tmp_path), 900)
    assert r.count() == 10 and r.rdd.getNumPartitions() == 10
    got = logs.resync_json(spark, str(tmp_path), range_bytes=900, one_per_line=True)
    assert got.count() == 1000 and got.rdd.getNumPartitions() == 10


def test_text_at_hand_is_short(tmp_path, monkeypatch):
    """The cost of an error is that of the text before it, so little is decoded at a time where objects are small; a long one is still read."""
    long = json.dumps({"long": "x" * 300_000})
    (tmp_path / "a.log").write_text('{"cut": "off\n{"n": 1}\n' * 100_000 + long)
    most = []

    class Text(jsonlog._Text):
        def forget(self, before):
            super().forget(before)
            most.append(len(self.text))

    monkeypatch.setattr(jsonlog, "_Text", Text)
    source = open_range(str(tmp_path / "a.log"))
    found = [o for _, _, o in jsonlog.objects(source, 0, source.size)]
    source.close()
    assert found == ['{"n": 1}'] * 100_000 + [long] and max(most) < 200_000
