"""Strict and salvaging JSON for model outputs, as plain functions and pandas UDF bodies."""

from __future__ import annotations

import json
import re

import pandas as pd

_fence = re.compile(r"^\s*```(?:json)?\s*\n?(.*?)\n?\s*```\s*$", re.S)


def strict_object(text: str | None) -> dict | None:
    """The object of a text that holds nothing else, a code fence apart. The last of equal keys wins."""
    if text is None:
        return None
    m = _fence.match(text)
    try:
        value = json.loads(m[1] if m else text)
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def salvaged_object(text: str | None) -> tuple[dict | None, bool]:
    """(object, whether it had to be closed): a cut-off object loses what is incomplete and gets its missing ends."""
    whole = strict_object(text)
    if whole is not None or not text or "{" not in text:
        return whole, False
    body = text[text.index("{") :]
    ends: list[str] = []
    cuts: list[tuple[int, str]] = []  # places where a value has just ended, and the ends that are then missing
    quoted = escaped = False
    for i, c in enumerate(body):
        if quoted:
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                quoted = False
            continue
        if c == '"':
            quoted = True
        elif c in "{[":
            ends.append("}" if c == "{" else "]")
            cuts.append((i + 1, "".join(reversed(ends))))
        elif c in "}]":
            if not ends:
                break
            ends.pop()
            cuts.append((i + 1, "".join(reversed(ends))))
        elif c == ",":
            cuts.append((i, "".join(reversed(ends))))
    for at, tail in reversed(cuts):
        try:
            value = json.loads(body[:at] + tail)
        except ValueError:
            continue
        if isinstance(value, dict):
            return value, True
    return None, False


def strict_batch(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if (v := strict_object(t)) is None else json.dumps(v, ensure_ascii=False))


def salvage_batch(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if (v := salvaged_object(t)[0]) is None else json.dumps(v, ensure_ascii=False))


def canonical_json(value: object) -> str:
    """The rendering whose SHA-256 identifies contexts: sorted keys, a space behind commas and colons."""
    return json.dumps(value, sort_keys=True, ensure_ascii=False)
