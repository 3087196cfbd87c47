"""Toxicity of whole texts: gradient-boosted trees over dense features, with isotonic calibration.

The features are densities of two lexicons, their nearness to second-person words, capitals, punctuation and obfuscation.
The lexicons are learned from labelled rows: words and word beginnings that toxic texts hold far more often than others. Labels,
language and source are never inputs. A short list of common insults is always part of the first. A bounded sample of the
labelled rows, chosen by a hash of the id, trains the model in the driver, cross-fitted in folds. Scoring reads each text once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumentrace.llm.boosting import Trees, isotonic
from lumentrace.llm.common import staged

# Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deinen deiner euch euer eure ihr tu te toi ton ta tes vous votre vos vosotros ti usted ustedes tus su vuestra vuestro".split())
# Common insults of the same languages; always in the strong lexicon.
INSULTS = frozenset("clown disgusting dumb fool garbage idiot imbecile jerk loser moron pathetic scum stupid trash worthless abschaum dummkopf trottel widerlich crétin idiote ordure stupide asqueroso basura estúpido idiota imbécil".split())
# Characters that stand for letters.
STAND_INS = str.maketrans("013457@$!", "oieastasi")
EDGE = " \t\n.,;:!?\"'()[]{}<>|&%$#*~`-_/\\=+^"
NEAR = 5
PREFIXES = (4, 5, 6, 7)
FOLDS = 4
FEATURES = ("strong", "weak", "strong_hits", "weak_hits", "near_second_person", "second_person", "densest", "obfuscated", "obfuscated_hits", "capitals", "shouted", "exclaimed", "punctuation", "stretched", "log_words")
MOST_KNOWN = 300_000


def core(token: str) -> str:
    return token.strip(EDGE)


class Lexicon:
    """0 for a plain word, 1 for a weak, 2 for a strong one, 4 for second person."""

    def __init__(self, strong: frozenset[str], weak: frozenset[str], strong_starts: frozenset[str], weak_starts: frozenset[str]):
        self.strong, self.weak, self.strong_starts, self.weak_starts = strong, weak, strong_starts, weak_starts
        self.known: dict[str, int] = {}

    def _kind(self, word: str) -> int:
        if word in SECOND_PERSON:
            return 4
        starts = {word[:n] for n in PREFIXES if len(word) >= n}
        if word in INSULTS or word in self.strong or starts & self.strong_starts:
            return 2
        return 1 if word in self.weak or starts & self.weak_starts else 0

    def kind(self, token: str) -> int:
        """Of a lower-cased token; 8 is added for an obfuscated one."""
        found = self.known.get(token)
        if found is None:
            word = core(token)
            found = self._kind(word)
            if word and not word.isalpha() and any(c.isalpha() for c in word):
                plain = "".join(c for c in word.translate(STAND_INS) if c.isalpha())
                found = 8 | (self._kind(plain) & 3)
            if len(self.known) > MOST_KNOWN:
                self.known.clear()
            self.known[token] = found
        return found

    @classmethod
    def learn(cls, texts: list[str], toxic: np.ndarray, least: int = 3) -> Lexicon:
        total = np.bincount(toxic, minlength=2)
        words: tuple[Counter, Counter] = (Counter(), Counter())
        starts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, y in zip(texts, toxic.tolist(), strict=True):
            own = {core(t) for t in text.lower().split()}
            words[y].update(own)
            starts[y].update({w[:n] for w in own for n in PREFIXES if len(w) >= n})

        def chosen(counts: tuple[Counter, Counter], odds: float, support: int) -> frozenset[str]:
            return frozenset(w for w, n in counts[1].items() if w and n >= support and math.log((n + 0.5) / (total[1] + 1)) - math.log((counts[0][w] + 0.5) / (total[0] + 1)) >= odds)

        # support grows with the sample, so that chance finds stay few
        support = max(least, int(0.01 * total[1]))
        return cls(chosen(words, 4.0, support), chosen(words, 2.0, support), chosen(starts, 4.0, support), chosen(starts, 2.0, support))

    def __reduce__(self):
        return Lexicon, (self.strong, self.weak, self.strong_starts, self.weak_starts)


_upper = re.compile(r"[^\W\d_a-z]")
_stretched = re.compile(r"(\w)\1\1")
_marks = re.compile(r"[^\w\s]")


def features(text: str, lexicon: Lexicon) -> list[float]:
    tokens = text.lower().split()
    n = len(tokens)
    if not n:
        return [0.0] * len(FEATURES)
    kind = lexicon.kind
    kinds = np.fromiter((kind(t) for t in tokens), np.uint8, n)
    bad = kinds & 3
    strong, weak, person = np.nonzero(bad == 2)[0], np.nonzero(bad == 1)[0], np.nonzero(kinds & 4)[0]
    near = 0
    if len(strong) and len(person):
        at = np.searchsorted(person, strong)
        gap = np.minimum(np.abs(person[np.minimum(at, len(person) - 1)] - strong), np.abs(person[np.maximum(at - 1, 0)] - strong))
        near = int((gap <= NEAR).sum())
    # most hits within 50 words
    densest = int((np.searchsorted(strong, strong + 50) - np.arange(len(strong))).max()) if len(strong) else 0
    chars = max(len(text), 1)
    raw = text.split()
    return [
        1000 * len(strong) / n, 1000 * len(weak) / n, float(len(strong)), float(len(weak)), near / max(len(strong), 1), 1000 * len(person) / n, float(densest),
        1000 * float((kinds & 8 > 0).sum()) / n, float(((kinds & 8 > 0) & (bad > 0)).sum()), 100 * sum(map(str.isupper, text)) / chars, 100 * sum(map(str.isupper, raw)) / n,
        1000 * text.count("!") / chars, 100 * len(_marks.findall(text)) / chars, 1000 * len(_stretched.findall(text)) / chars, math.log1p(n),
    ]


class Model:
    """score(texts) between 0 and 1."""

    def __init__(self, lexicon: Lexicon, trees: Trees | None, knots: tuple[np.ndarray, np.ndarray], prior: float):
        self.lexicon, self.trees, self.knots, self.prior = lexicon, trees, knots, prior

    def score(self, texts: list[str]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.prior)
        x = np.array([features(t, self.lexicon) for t in texts], float).reshape(-1, len(FEATURES))
        return np.clip(np.interp(self.trees.raw(x), *self.knots), 0.0, 1.0)


def fit(texts: list[str], toxic: np.ndarray, fold: np.ndarray) -> Model:
    """fold: numbers that deal the rows out to FOLDS parts.

    The features of a part come from the lexicon of the other parts, as those of new texts will, and its calibration scores
    from trees that have not seen it. The final lexicon and trees use all rows."""
    toxic, fold = toxic.astype(np.int64), fold % FOLDS
    prior = float(toxic.mean()) if len(toxic) else 0.0
    if min(np.bincount(toxic, minlength=2)) < 2 * FOLDS:
        return Model(Lexicon(*[frozenset()] * 4), None, (np.zeros(1), np.zeros(1)), prior)
    x = np.zeros((len(texts), len(FEATURES)))
    for k in range(FOLDS):
        lexicon = Lexicon.learn([t for t, f in zip(texts, fold, strict=True) if f != k], toxic[fold != k])
        for i in np.nonzero(fold == k)[0]:
            x[i] = features(texts[i], lexicon)
    y = toxic.astype(float)
    unseen = np.zeros(len(y))
    for k in range(FOLDS):
        unseen[fold == k] = Trees().fit(x[fold != k], y[fold != k]).raw(x[fold == k])
    return Model(Lexicon.learn(texts, toxic), Trees().fit(x, y), isotonic(unseen, y), prior)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.score(texts), pa.float64())], ["id", "score"])

    return run


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, most_rows: int = 8000, most_bytes: int = 64 << 20, scope: str = "toxicity",
) -> Model:
    """A model from about most_rows labelled rows and most_bytes of text at most; labels without an id, a label of 0 or 1, or a document are ignored.

    Rows are chosen by a hash of their id. Texts of more than a 64th of most_bytes are no training rows; where the others exceed
    most_bytes, fewer rows are chosen. Every text is scored whole, whatever its length."""
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)").dropDuplicates(["id"])
    n = named.count()
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    share = min(1.0, most_rows / max(n, 1))
    picked = named.withColumn("place", place).where(F.col("place") < int(share * (1 << 20))).withColumn("fold", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(1 << 20)))
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = staged(text.where(F.octet_length("text") <= most_bytes // 64).join(picked, "id"), scope)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most_bytes:
        rows = rows.where(F.col("place") < int(share * most_bytes / size * (1 << 20)))
    rows = rows.select("id", "text", "label", "fold").toPandas().sort_values(["id", "text"])
    return fit(rows["text"].tolist(), rows["label"].to_numpy(), rows["fold"].to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: the id and its score (double, 0 to 1; the higher, the likelier it is toxic).

    Null texts are empty; an empty text has a score as well, that of no features. Texts of any length are scored whole, equal texts
    alike. Rows that share an id, or have none, have a row each; an empty table gives an empty one. Extra columns are ignored.
    What cuts scores into classes counts a score at the cut as toxic.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    return plain.mapInArrow(_score(shared), T.StructType([plain.schema["id"]]).add("score", "double")).withColumnRenamed("id", id_col)
