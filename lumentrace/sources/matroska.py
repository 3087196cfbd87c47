"""What Matroska and WebM files say of their tracks, read by ranges: kinds, sizes, and the DURATION tags. The container's own duration is not looked at."""

from __future__ import annotations

import math
from collections.abc import Iterator

# Ids of elements.
EBML, SEGMENT, SEEK_HEAD, SEEK, SEEK_ID, SEEK_POSITION, CLUSTER = 0x1A45DFA3, 0x18538067, 0x114D9B74, 0x4DBB, 0x53AB, 0x53AC, 0x1F43B675
TRACKS, TRACK, TRACK_UID, TRACK_TYPE, VIDEO, WIDTH, HEIGHT = 0x1654AE6B, 0xAE, 0x73C5, 0x83, 0xE0, 0xB0, 0xBA
TAGS, TAG, TARGETS, TAG_TRACK_UID, SIMPLE_TAG, TAG_NAME, TAG_STRING = 0x1254C367, 0x7373, 0x63C0, 0x63C5, 0x67C8, 0x45A3, 0x4487
KINDS = {1: "vide", 2: "soun"}
#: Bytes of tracks or tags at most: more are no sound file's.
MOST = 64 << 20


def _number(data: bytes, at: int, keep_mark: bool) -> tuple[int | None, int]:
    """A number of variable length and where it ends; None stands for a size that is not known."""
    if at >= len(data) or not data[at]:
        raise ValueError("no element")
    n = 9 - data[at].bit_length()
    raw = int.from_bytes(data[at : at + n], "big")
    if len(data) < at + n:
        raise ValueError("cut off")
    if keep_mark:
        return raw, at + n
    value = raw & ((1 << 7 * n) - 1)
    return (None if value == (1 << 7 * n) - 1 else value), at + n


def _header(source, at: int) -> tuple[int, int | None, int]:
    data = source.read(at, 12)
    kind, i = _number(data, 0, True)
    size, i = _number(data, i, False)
    return kind, size, at + i


def elements(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(id, content) of the elements of a content."""
    at = 0
    while at < len(data):
        kind, i = _number(data, at, True)
        size, i = _number(data, i, False)
        end = len(data) if size is None else i + size
        yield kind, data[i:end]
        at = end


def _all(data: bytes, *path: int) -> list[bytes]:
    for kind in path:
        data = [c for d in ([data] if isinstance(data, bytes) else data) for k, c in elements(d) if k == kind]
    return data


def _whole(data: bytes) -> int:
    return int.from_bytes(data, "big")


def seconds(tag: str) -> float | None:
    """Of hours:minutes:seconds; None for anything else and what is not above zero."""
    try:
        h, m, s = tag.strip().split(":")
        value = int(h) * 3600 + int(m) * 60 + float(s)
    except ValueError:
        return None
    return value if math.isfinite(value) and value > 0 else None


def tracks(source) -> list[dict]:
    """kind, width, height and seconds (None without a tag) of each track, in order; an empty list for what is no Matroska file."""
    try:
        kind, size, at = _header(source, 0)
        if kind != EBML or size is None:
            return []
        kind, size, start = _header(source, at + size)
        if kind != SEGMENT:
            return []
        end = source.size if size is None else min(source.size, start + size)
        parts: dict[int, bytes] = {}
        places: dict[int, int] = {}
        at = start
        # to the first cluster whose size is not known; what lies behind it is where the heads say
        while at < end and not {TRACKS, TAGS} <= parts.keys():
            kind, size, body = _header(source, at)
            if size is None:
                break
            if kind in (TRACKS, TAGS, SEEK_HEAD) and size <= MOST:
                data = source.read(body, size)
                if kind == SEEK_HEAD:
                    for seek in _all(data, SEEK):
                        ids, to = _all(seek, SEEK_ID), _all(seek, SEEK_POSITION)
                        if ids and to:
                            places[_whole(ids[0])] = start + _whole(to[0])
                else:
                    parts.setdefault(kind, data)
            if kind == CLUSTER and TAGS in places and TAGS not in parts and TRACKS in parts:
                break
            at = body + size
        for want in (TRACKS, TAGS):
            if want not in parts and want in places:
                kind, size, body = _header(source, places[want])
                if kind == want and size is not None and size <= MOST:
                    parts[want] = source.read(body, size)
        lengths: dict[int, float | None] = {}
        for tag in _all(parts.get(TAGS, b""), TAG):
            for simple in _all(tag, SIMPLE_TAG):
                name, text = _all(simple, TAG_NAME), _all(simple, TAG_STRING)
                if name and text and name[0].rstrip(b"\0").upper() == b"DURATION":
                    for uid in _all(tag, TARGETS, TAG_TRACK_UID):
                        lengths[_whole(uid)] = seconds(text[0].rstrip(b"\0").decode("utf-8", "replace"))
        out = []
        for t in _all(parts.get(TRACKS, b""), TRACK):
            first = lambda *p, t=t: next(iter(_all(t, *p)), None)
            number = lambda *p, first=first: None if first(*p) is None else _whole(first(*p))
            out.append({"kind": KINDS.get(number(TRACK_TYPE), "other"), "width": number(VIDEO, WIDTH), "height": number(VIDEO, HEIGHT), "seconds": lengths.get(number(TRACK_UID))})
        return out
    except ValueError:
        return []
