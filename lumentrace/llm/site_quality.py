"""Document quality by hierarchical empirical Bayes.

A logistic classifier over a document's own text gives evidence. Grouped sums of its probabilities give posteriors of hosts and of
paths within hosts: a path is shrunk towards its host, a host towards the corpus, the more the fewer documents it has, with
strengths estimated from the spread between groups. A document's posterior joins its own evidence with the odds of the other
documents of its path. All text work and all grouping are DataFrame operations; only the features of a bounded sample of
labelled rows and a few corpus-wide sums reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumentrace.llm.common import staged
from lumentrace.llm.quality_rules import SPACE, SYMBOLS, lines, words

FEATURES = ("log_words", "symbols", "capitals", "shouted", "distinct_words", "stuck_words", "word_length", "repeated_lines", "marks", "digits", "bars", "line_words")


def features(text: Column, docs: DataFrame) -> DataFrame:
    """docs with FEATURES (double); all zero for texts without a word."""
    t = F.coalesce(text, F.lit(""))
    gone = lambda chars: F.length("_t") - F.length(F.translate("_t", chars, ""))
    out = docs.withColumn("_t", t).withColumn("_w", words(F.col("_t"))).withColumn("_l", lines(F.col("_t")))
    n, chars = F.greatest(F.size("_w"), F.lit(1)), F.greatest(F.length(F.translate("_t", SPACE, "")), F.lit(1))
    pairs = F.greatest(F.size("_w") - 1, F.lit(0))
    stuck = F.size(F.filter(F.zip_with(F.slice("_w", 1, pairs), F.slice("_w", 2, pairs), lambda a, b: a == b), lambda x: x))
    shouted = F.size(F.filter("_w", lambda w: (F.length(w) > 1) & (F.upper(w) == w) & (F.lower(w) != w)))
    capitals = F.length(F.regexp_replace("_t", r"[^\p{Lu}]+", ""))
    made = {
        "log_words": F.log1p(F.size("_w")), "symbols": gone(SYMBOLS) / chars, "capitals": capitals / chars, "shouted": shouted / n, "distinct_words": F.size(F.array_distinct("_w")) / F.sqrt(n),
        "stuck_words": stuck / n, "word_length": chars / n, "repeated_lines": 1 - F.size(F.array_distinct("_l")) / F.greatest(F.size("_l"), F.lit(1)), "marks": gone(".,;:!?") / chars,
        "digits": gone("0123456789") / chars, "bars": gone("|") / chars, "line_words": F.log1p(n / F.greatest(F.size("_l"), F.lit(1))),
    }
    any_word = F.size("_w") > 0
    return out.withColumns({k: F.when(any_word, v.cast("double")).otherwise(0.0) for k, v in made.items()}).drop("_t", "_w", "_l")


class Logistic:
    """Ridge logistic regression on standardised values and their squares, by Newton steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weight: np.ndarray, base: float, prior: float):
        self.mean, self.scale, self.weight, self.base, self.prior = mean, scale, weight, base, prior

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> Logistic:
        prior = float((y.sum() + 1) / (len(y) + 2))
        mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        scale = np.maximum(x.std(axis=0), 1e-9) if len(x) else np.ones(x.shape[1])
        z = np.clip((x - mean) / scale, -4, 4)
        d = np.hstack([np.ones((len(z), 1)), z, z * z])
        w = np.zeros(d.shape[1])
        w[0] = np.log(prior / (1 - prior))
        if 0 < y.sum() < len(y):
            for _ in range(steps):
                p = 1 / (1 + np.exp(-d @ w))
                penalty = np.full(len(w), ridge)
                penalty[0] = 1e-6
                g = d.T @ (y - p) - penalty * w
                w += np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + np.diag(penalty), g)
        return cls(mean, scale, w[1:], float(w[0]), prior)

    def logit(self, names: tuple[str, ...]) -> Column:
        out = F.lit(self.base)
        k = len(names)
        for i, c in enumerate(names):
            z = F.greatest(F.lit(-4.0), F.least(F.lit(4.0), (F.col(c) - float(self.mean[i])) / float(self.scale[i])))
            out = out + z * float(self.weight[i]) + z * z * float(self.weight[k + i])
        return F.greatest(F.lit(-12.0), F.least(F.lit(12.0), out))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, most_rows: int = 20000) -> Logistic:
    """From at most about most_rows labelled rows, chosen by a hash of the id; labels other than 0 and 1, and those without a document, are ignored."""
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)").dropDuplicates(["id"])
    part = min(1.0, most_rows / max(named.count(), 1))
    picked = named.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(part * (1 << 20)))
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(picked, "id")
    rows = features(F.col("text"), text).select("label", *FEATURES).toPandas()
    return Logistic.fit(rows[list(FEATURES)].to_numpy(float), rows["label"].to_numpy(float))


def strength(n: float, mean: float, within: float, between: float) -> float:
    """Pseudo-documents of a prior by the method of moments: the less groups differ beyond chance, the stronger."""
    spread = max(between - within, 1e-6)
    return float(np.clip(mean * (1 - mean) / spread - 1, 2.0, 1000.0)) if n > 1 else 50.0


def judge(
    docs: DataFrame, model: Logistic, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", *,
    keep_above: float = 0.5, scope: str = "site_quality",
) -> DataFrame:
    """A row for each row of docs: the id, host, path, document_score, host_score, path_score, score (double, 0 to 1) and kept (score >= keep_above).

    Null and empty texts have the score of a text without words. A null host or path is a group of its own. Repeated rows count
    as often as they occur. A path of one document has its host's odds. Texts of any length are read whole; equal texts of one path
    have one score. A score of keep_above is kept. An empty table gives an empty one. Extra columns are ignored.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    p = 1 / (1 + F.exp(-F.col("logit")))
    scored = features(F.col("text"), plain).select("id", "host", "path", model.logit(FEATURES).alias("logit")).withColumn("p", p)
    scored = staged(scored, scope)
    paths = staged(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), scope)
    hosts = staged(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s")), scope)
    top = hosts.agg(F.count("*").alias("k"), F.sum("host_n").alias("n"), F.sum("host_s").alias("s")).first()
    mean = float(np.clip((top["s"] or 0) / max(top["n"] or 0, 1), 1e-3, 1 - 1e-3))
    # spread of group means, and what chance alone gives
    h = hosts.agg(F.avg(F.pow(F.col("host_s") / F.col("host_n") - mean, 2)).alias("b"), F.avg(mean * (1 - mean) / F.col("host_n")).alias("w")).first()
    host_prior = strength(top["k"], mean, h["w"] or 0.0, h["b"] or 0.0)
    host_score = (F.col("host_s") + host_prior * mean) / (F.col("host_n") + host_prior)
    of_host = paths.withColumnRenamed("host", "_h").join(hosts, F.col("_h").eqNullSafe(F.col("host"))).drop("_h")
    of_host = staged(of_host.withColumn("host_score", host_score), scope)
    q = of_host.agg(
        F.count("*").alias("k"), F.avg(F.pow(F.col("s") / F.col("n") - F.col("host_score"), 2)).alias("b"), F.avg(F.col("host_score") * (1 - F.col("host_score")) / F.col("n")).alias("w")
    ).first()
    path_prior = strength(q["k"], mean, q["w"] or 0.0, q["b"] or 0.0)
    groups = of_host.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "n", "s", "host_score")
    joined = scored.join(groups, F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")))
    others = (F.col("s") - F.col("p") + path_prior * F.col("host_score")) / (F.col("n") - 1 + path_prior)
    odds = F.log(F.col("others") / (1 - F.col("others")))
    evidence = F.col("logit") - float(np.log(model.prior / (1 - model.prior)))
    return (
        joined.withColumn("others", F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), others)))
        .withColumn("score", 1 / (1 + F.exp(-(evidence + odds))))
        .select(
            F.col("id").alias(id_col), "host", "path", F.col("p").alias("document_score"), "host_score",
            ((F.col("s") + path_prior * F.col("host_score")) / (F.col("n") + path_prior)).alias("path_score"), "score", (F.col("score") >= keep_above).alias("kept"),
        )
    )
