import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

LONG = 90_000


def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 7)))
    line = lambda: " ".join(word() for _ in range(rng.randint(3, 14)))
    shared = [line() for _ in range(6)]
    passage = " ".join(word() for _ in range(60))
    out = []
    for i in range(60):
        lines = [line() for _ in range(rng.randint(1, 9))] + rng.sample(shared, rng.randint(0, 3))
        rng.shuffle(lines)
        t = "\n".join(lines)
        if i % 7 == 0:
            t += "\n" + passage[rng.randint(0, 80) :]
        if i % 11 == 0:
            t = t.upper()
        if i % 13 == 0:
            t += "\n" + ("ab cd ef gh ij kl mn op qr " * 4).strip()
        if i % 9 == 1:
            t = out[-1][1] or ""
        out.append((i, t))
    return [*out, (100, None), (101, ""), (102, "\n\n"), (103, " \t\r\n x"), (104, "é" * 250), (105, "one"), (106, "ab " * (LONG // 3)), (107, "ab " * (LONG // 3))]


@pytest.fixture(scope="session")
def rows():
    return texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Nulls, empty and long texts, copies, and columns whose names clash with those that operators use."""
    full = [(i, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", len(t or ""), 1, "x", True, i, "y") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, n_lines int, kept string, KEY boolean, id long, doc string").repartition(5, "doc_id")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("doc_id < -1")
