"""Scalar expressions on columns: time of day, pieces, geometry, classes, redaction, cost."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400
# Prices in USD per million tokens (input, output) and the share that deferred requests pay.
PRICE_IN, PRICE_OUT, DEFERRED_SHARE = 0.75, 3.75, 0.5
# The weights of a candidate's total, and of causal strengths.
TOTAL_WEIGHTS = {"faithfulness": 0.45, "coverage": 0.25, "timestamp": 0.15, "rule": 0.15}
STRENGTH_WEIGHTS = {"strong": 1.0, "moderate": 0.5, "weak": 0.25}


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def hms(seconds: Column) -> Column:
    """HH:MM:SS of seconds of a day; beyond a day it starts anew."""
    s = F.pmod(F.floor(seconds).cast("long"), F.lit(DAY))
    return F.concat_ws(":", *(F.lpad(p.cast("string"), 2, "0") for p in (F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)))


def seconds_of(text: Column) -> Column:
    """Seconds of an HH:MM:SS[.cc] text; null for anything else."""
    ok = text.rlike(r"^\d{1,2}:\d{2}:\d{2}(\.\d+)?$")
    part = lambda i: F.element_at(F.split(text, ":"), i).cast("double")
    return F.when(ok, part(1) * 3600 + part(2) * 60 + part(3))


def compact_seconds(text: Column) -> Column:
    """Seconds of HHMM, exactly four digits; null for anything else."""
    return F.when(text.rlike(r"^\d{4}$"), F.substring(text, 1, 2).cast("int") * 3600 + F.substring(text, 3, 2).cast("int") * 60)


def piece_count(duration: Column, target: float, snap: float = 0.5) -> Column:
    """How many equal pieces: a duration within snap of a multiple of target counts as that multiple; one piece up to target, else two at least."""
    near = F.bround(duration / target) * target
    d = F.when((near > 0) & (F.abs(duration - near) <= snap), near).otherwise(duration)
    return F.when(d <= target, 1).otherwise(F.greatest(F.lit(2), F.ceil(d / target - 1e-9))).cast("long")


def short_hash(*parts: Column, length: int = 24) -> Column:
    """The first characters of the SHA-256 of the parts joined by colons."""
    return F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, length)


def clip_kind(second: Column) -> Column:
    """Whether a recording starts on the half minute or in between, where a segment was opened."""
    return F.when(second.isin(0, 30), "30s").otherwise("segment_open")


def box_pixels(top: Column, left: Column, bottom: Column, right: Column, width: Column, height: Column) -> Column:
    """Pixel box of per-mille coordinates, rounded outwards; null where the box is out of range or empty."""
    ok = (top >= 0) & (left >= 0) & (top < bottom) & (left < right) & (bottom <= 1000) & (right <= 1000)
    low = lambda v, size: F.floor(v * size / 1000)
    high = lambda v, size: F.ceil(v * size / 1000)
    return F.when(ok, F.struct(low(left, width).alias("x0"), low(top, height).alias("y0"), high(right, width).alias("x1"), high(bottom, height).alias("y1")))


def output_class(text: Column, tokens: Column, few: int = 25) -> Column:
    """empty; safety_rejection for a few tokens that do not begin a JSON document; ok."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when(t == "", "empty").when((tokens <= few) & ~t.rlike(r"^(\{|```)"), "safety_rejection").otherwise("ok")


# Error classes in the order in which they are tried, each with the words that show it.
ERROR_CLASSES = (
    ("quota", ("429", "resource_exhausted", "quota", "rate limit", "rate_limit", "billing account", "billing is disabled", "insufficient credits")),
    ("payload", ("413", "payload too large", "request too large", "request entity too large", "content size", "exceeds the maximum size", "exceeded the maximum size")),
    ("model", ("404", "not_found", "model not found", "model is not found", "unsupported model", "unknown model")),
    (
        "auth",
        ("default credentials were not found", "could not automatically determine credentials", "unauthenticated", "permission_denied", "permission denied", "api key not valid", "invalid api key", "api key expired", "401", "403"),
    ),
    ("server", ("500", "502", "503", "504", "internal server error", "unavailable", "service unavailable", "empty stream")),
    ("network", ("timeout", "timed out", "connection error", "connection reset", "connection aborted", "temporary failure", "name resolution")),
)
# Classes that are tried again, and those that end a clip.
RETRYABLE, FINAL = ("quota", "server", "network"), ("auth", "model")


def error_class(message: Column) -> Column:
    """The first class one of whose words the message holds; other for none."""
    m = F.lower(F.coalesce(message, F.lit("")))
    out = None
    for name, words in ERROR_CLASSES:
        hit = F.lit(False)
        for w in words:
            hit = hit | m.contains(w)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


def failure_class(code: Column, kind: Column, message: Column) -> Column:
    """The class of a provider's failure by its HTTP code, the name of its exception and, for bills alone, its message; config for anything unknown."""
    m, k = F.lower(F.coalesce(message, F.lit(""))), F.lower(F.coalesce(kind, F.lit("")))
    names = lambda *words: F.greatest(F.lit(False), *(k.contains(w) for w in words))
    c = F.coalesce(code, F.lit(-1))
    return classed(
        [
            (m.contains("billing") | m.contains("payment required") | m.contains("payment_required"), "billing"),
            (c.isin(401, 403) | names("auth", "credential", "refresherror"), "auth"),
            (c == 404, "model"),
            (c == 429, "quota"),
            (c.between(500, 599), "server"),
            ((c == 408) | names("timeout", "connecterror", "connectionerror", "network", "transport", "protocolerror"), "network"),
        ],
        "config",
    )


# What is redacted, in this order; values end at white space, a comma, a semicolon or a quote.
WHITE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
SECRETS = (
    (rf"(?iu)(authorization[{WHITE}]*[:=][{WHITE}]*bearer[{WHITE}]+)[^{WHITE},;\"']+", "$1[REDACTED]"),
    (rf"(?iu)((?:api[_-]?key|key|token)[{WHITE}]*[=:][{WHITE}]*)[^{WHITE},;\"']+", "$1[REDACTED]"),
    (r"AIza[0-9A-Za-z_-]{10,}", "[REDACTED]"),
    (r"hf_[0-9A-Za-z_-]{10,}", "[REDACTED]"),
)
# Variables whose values are secrets, in the order in which they are replaced.
SECRET_VARIABLES = ("GOOGLE_API_KEY", "GEMINI_API_KEY", "HF_TOKEN", "HUGGING_FACE_HUB_TOKEN")


def secret_values(environ: dict[str, str]) -> tuple[str, ...]:
    """The values to redact, of four characters or more."""
    return tuple(v for v in (environ.get(n, "") for n in SECRET_VARIABLES) if len(v) >= 4)


def redact(text: Column, values: tuple[str, ...] = (), limit: int | None = None) -> Column:
    """Text without secrets and with single spaces; cut to limit characters where one is given. values: other secrets, as of secret_values(os.environ). A null text is empty."""
    out = F.coalesce(text, F.lit(""))
    for v in values:
        out = F.replace(out, F.lit(v), F.lit("[REDACTED]")) if len(v) >= 4 else out
    for pattern, instead in SECRETS:
        out = F.regexp_replace(out, pattern, instead)
    out = F.trim(F.regexp_replace(out, rf"[{WHITE}]+", " "))
    return out if limit is None else F.substring(out, 1, limit)


# Patterns of the privacy audit, and placeholders that anonymised texts hold. Names of schools are the caller's.
PII = {
    "school_generic": r"(?i)\b[A-Z][a-z]+ (?:University|College)\b",
    "email_plain": r"[A-Za-z0-9._%+-]+@(?!example\.com)[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone_plain": r"\b(?:\+?86)?1[3-9]\d{9}\b|\b\d{4}[- ]\d{4}\b",
}
PLACEHOLDERS = r"University X|School X|User [A-Z]\b|email_x@|XXX-XXXX-XXXX|Address X"


def pii_counts(text: Column, schools: tuple[str, ...] = ()) -> dict[str, Column]:
    """Matches of each pattern in a text, total_hits of all of them, and placeholders, which the total leaves out."""
    named = "|".join(f"\\b{re.escape(s)}\\b" for s in schools)
    patterns = ({"school_plain": f"(?i){named}"} if named else {}) | PII
    count = lambda p: F.coalesce(F.regexp_count(text, F.lit(p)), F.lit(0)).cast("long")
    # what every match holds is looked for first: most texts have none of it
    low = F.lower(text)
    needs = {"school_generic": low.contains("university") | low.contains("college"), "email_plain": text.contains("@")}
    out = {k: F.when(needs[k], count(p)).otherwise(F.lit(0).cast("long")) if k in needs else count(p) for k, p in patterns.items()}
    total = F.lit(0).cast("long")
    for c in out.values():
        total = total + c
    return out | {"anonymized_placeholders": count(PLACEHOLDERS), "total_hits": total}


# Beginnings of screen-text lines that say when and where they were read.
OCR_MARKS = ("capture_time", "capture_epoch", "frame_index")


def clean_ocr(text: Column) -> Column:
    """Screen text without the lines that only say when it was read, and without white space at its ends."""
    keep = F.filter(F.split(text, "\n"), lambda x: ~F.greatest(F.lit(False), *(x.startswith(m) for m in OCR_MARKS)))
    return F.regexp_replace(F.array_join(keep, "\n"), rf"^[{WHITE}]+|[{WHITE}]+\z", "")


CLIP_ID = r"^DAY(\d+)_(.+)_(\d{8})(?:_p(\d+))?$"


def clip_parts(clip_id: Column) -> Column:
    """day, participant, hh, mm, ss, cs and piece (0 for whole clips) of an id as DAY1_A1_JAKE_11094208_p2; null for anything else."""
    part = lambda i: F.regexp_extract(clip_id, CLIP_ID, i)
    at = lambda i: F.substring(part(3), i, 2).cast("int")
    piece = F.when(part(4) == "", 0).otherwise(part(4).try_cast("int"))
    fields = F.struct(part(1).try_cast("int").alias("day"), part(2).alias("participant"), at(1).alias("hh"), at(3).alias("mm"), at(5).alias("ss"), at(7).alias("cs"), piece.alias("piece"))
    return F.when(clip_id.rlike(CLIP_ID), fields)


def safe_path(path: Column) -> Column:
    """Whether a result's path is one that the mirror may write."""
    return F.coalesce(path.rlike(r"^(audio|annotation|review)/[A-Za-z0-9_-]+\.json\z"), F.lit(False))


def utc_text(ts: Column) -> Column:
    """A time as 2024-01-31T00:00:00Z, from a text with Z, an offset of zero, or none; null for other texts."""
    shape = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(\.\d+)?(Z|\+00:00)?$"
    day, clock = F.regexp_extract(ts, shape, 1), F.regexp_extract(ts, shape, 2)
    ok = ts.rlike(shape) & F.try_to_timestamp(F.concat_ws(" ", day, clock), F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
    return F.when(ok, F.concat(day, F.lit("T"), clock, F.lit("Z")))


FRAME = r"(?i)(\d{4}-\d{2}-\d{2})_(\d{2})-(\d{2})-(\d{2})_[A-Z]{2,4}__frame_(\d+)\.(?:jpg|jpeg|png|txt)$"


def frame_parts(name: Column) -> Column:
    """day, clock and index of a frame's file name; null for other names."""
    part = lambda i: F.regexp_extract(name, FRAME, i)
    return F.when(name.rlike(FRAME), F.struct(part(1).alias("day"), F.concat_ws(":", part(2), part(3), part(4)).alias("clock"), part(5).try_cast("long").alias("index")))


def cost(tokens_in: Column, tokens_out: Column, deferred: Column, digits: int = 4) -> Column:
    """USD, rounded half to even."""
    full = tokens_in / 1e6 * PRICE_IN + tokens_out / 1e6 * PRICE_OUT
    return F.bround(full * F.when(deferred, DEFERRED_SHARE).otherwise(1.0), digits)


def backoff(attempt: Column, retry_after: Column, most: int = 1800) -> Column:
    """Seconds to wait: two to the attempt, eight doublings at most, no less than asked for, at most `most`."""
    return F.least(F.lit(most), F.greatest(F.pow(F.lit(2), F.least(attempt, F.lit(8))).cast("long"), F.coalesce(retry_after, F.lit(0)).cast("long")))


def vote_bucket(votes: Column) -> Column:
    """low, mid or high of an "n/k" text; mid for anything that is no such text."""
    got, of = (F.regexp_extract(votes, r"^(\d+)/(\d+)$", i) for i in (1, 2))
    ok = votes.rlike(r"^\d+/\d+$")
    g, k = (F.when(ok, x.cast("int")) for x in (got, of))
    return F.when(~ok | votes.isNull(), "mid").when(g <= 1, "low").when(g >= k, "high").otherwise("mid")


def truncated(text: Column, limit: int, marker: str) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(marker))).otherwise(text)


def weighted_total(faithfulness: Column, coverage: Column, timestamp: Column, rule: Column, fatal: Column) -> Column:
    """The total of a candidate, one decimal; a fatal issue caps faithfulness at 3."""
    f = F.when(fatal, F.least(faithfulness, F.lit(3.0))).otherwise(faithfulness)
    parts = {"faithfulness": f, "coverage": coverage, "timestamp": timestamp, "rule": rule}
    # in decimals, so that halves are halves
    terms = [v.cast("decimal(8,3)") * F.lit(TOTAL_WEIGHTS[k]).cast("decimal(3,2)") for k, v in parts.items()]
    return F.bround(terms[0] + terms[1] + terms[2] + terms[3], 1).cast("double")


def json_object(text: Column) -> Column:
    """The text of a JSON object, a code fence around it removed; null where it is no object or something follows it."""
    bare = F.trim(F.regexp_replace(F.trim(text), r"^```(?:json)?\s*|\s*```$", ""))
    return F.when(bare.startswith("{") & bare.endswith("}") & F.is_variant_null(F.try_parse_json(F.lit("null"))) & F.try_parse_json(bare).isNotNull(), bare)


def base64_size(n: Column) -> Column:
    return 4 * F.floor((n + 2) / 3)


def classed(cases: list[tuple[Column, str]], default: str) -> Column:
    """The name of the first case that holds."""
    out = None
    for when, name in cases:
        out = F.when(when, name) if out is None else out.when(when, name)
    return out.otherwise(default) if out is not None else F.lit(default)
