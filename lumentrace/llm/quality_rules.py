"""Quality rules for documents, in DataFrame operations only.

Base rules look at one document: its words, symbols, repeated lines, and words within 8-word windows that occur more than once.
The corpus rule is cross-document line frequency: normalised lines are hashed, the distinct documents (by content, so that exact
copies count once) that hold a line are counted for each host, and lines above the host's limit count as boilerplate. A line
above the limit stays with its first holder, the smallest id of the host. Documents that are mostly boilerplate are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumentrace.llm.common import fresh, id_key, staged

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, SPACE, " " * len(SPACE)), " "), lambda w: w != "")


def lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")


def normalised(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(SPACE)))


def _shifted(a: str, by: int, join) -> Column:
    """join(x[i], x[i + by]) for every i that has both."""
    n = F.greatest(F.size(a) - by, F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(a, by + 1, n), join)


def base_metrics(docs: DataFrame, text: str) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words, all long; null texts have no words.

    Windows are compared by 64-bit hashes. Every array is a column of its own, so that no lambda computes it again."""
    t = F.coalesce(F.col(text), F.lit(""))
    mix = lambda a, b: F.xxhash64(a, b)
    out = (
        docs.withColumn("_w", F.transform(words(t), lambda w: F.xxhash64(w)))
        .withColumn("_l", F.transform(lines(t), lambda x: F.xxhash64(x)))
        .withColumn("n_words", F.size("_w").cast("long"))
        .withColumn("word_chars", F.length(F.translate(t, SPACE, "")).cast("long"))
        .withColumn("n_symbols", (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"))
        .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
        .withColumn("_w", _shifted("_w", 1, mix))
        .withColumn("_w", _shifted("_w", 2, mix))
        .withColumn("_w", _shifted("_w", 4, mix))
        # windows of texts that repeat any, ordered by hash, with their positions
        .withColumn("_s", F.when(F.size(F.array_distinct("_w")) < F.size("_w"), F.sort_array(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        .withColumn("_p", _shifted("_s", 1, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))))
        .withColumn("_p", F.sort_array(F.array_distinct(F.flatten(F.filter("_p", lambda p: p.isNotNull())))))
        .withColumn("_p", F.aggregate(_shifted("_p", 1, lambda a, b: F.least(F.lit(WINDOW), b - a)), F.lit(WINDOW), lambda s, x: s + x))
        .withColumn("n_repeat_words", F.coalesce(F.col("_p"), F.lit(0)).cast("long"))
    )
    return out.drop("_w", "_l", "_s", "_p")


def line_table(docs: DataFrame) -> DataFrame:
    """(id, host, content, line, chars): the distinct normalised lines of each document. docs: (id, host, text)."""
    norm = F.transform(lines(F.col("text")), lambda x: normalised(x))
    each = F.transform(F.array_distinct(norm), lambda x: F.struct(F.xxhash64(x).alias("line"), F.length(x).alias("chars")))
    return docs.select("id", "host", F.xxhash64("text").alias("content"), F.explode(each).alias("x")).select("id", "host", "content", "x.line", "x.chars")


def boilerplate(docs: DataFrame, min_docs: int, share: float) -> DataFrame:
    """(host, line, first): lines that more than max(min_docs, share of the host's) distinct documents hold, and their first holder."""
    each = line_table(docs)
    held = each.groupBy("host", "line", "content").agg(F.min("id").alias("first")).groupBy("host", "line").agg(F.count("*").alias("n"), F.min("first").alias("first"))
    # hosts whose documents could exceed the limit at all; exact, as the smallest limit is min_docs
    held = held.where(F.col("n") > min_docs)
    size = docs.select("host", F.xxhash64("text").alias("content")).distinct().groupBy("host").agg(F.count("*").alias("docs"))
    return held.join(size, "host").where(F.col("n") > F.col("docs") * share).select("host", "line", "first")


def _plain(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc"), id_key(id_col).alias("id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.col(text_col).cast("string").alias("text"))


def _judged(plain: DataFrame, min_words: int, most_repeat_percent: int, min_line_docs: int, line_share: float, most_boilerplate: float, scope: str) -> DataFrame:
    """The columns of judge with doc, id, content and over: the hashes of the lines above the limit that the document does not hold first, null for none."""
    bad = staged(boilerplate(plain, min_line_docs, line_share), scope)
    hits = line_table(plain).join(bad, ["host", "line"]).where(F.col("id") != F.col("first"))
    gone = hits.groupBy("id", "content").agg(F.collect_set(F.struct("line", "chars")).alias("gone")).withColumn("over", F.col("gone.line")).withColumn("gone", F.aggregate("gone", F.lit(0), lambda s, x: s + x["chars"]))
    total = F.aggregate(F.array_distinct(F.transform(lines(F.col("text")), lambda x: normalised(x))), F.lit(0), lambda s, x: s + F.length(x))
    metrics = base_metrics(plain.withColumn("total", F.coalesce(total, F.lit(0))).withColumn("content", F.xxhash64("text")), "text").drop("text", "host")
    # staged, as a condition on the result would otherwise move down and compute the nested arrays many times over
    metrics = staged(metrics, scope)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeat_percent * F.col("n_words"))
    share = F.coalesce(F.col("gone") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0))
    return (
        metrics.join(gone, ["id", "content"], "left")
        .withColumn("base_failed", failed)
        .withColumn("boilerplate_share", share)
        .withColumn("kept", ~failed & (F.col("boilerplate_share") <= most_boilerplate))
    )


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", *, min_words: int = 20,
    most_repeat_percent: int = 30, min_line_docs: int = 5, line_share: float = 0.02, most_boilerplate: float = 0.7, scope: str = "quality_rules",
) -> DataFrame:
    """A row for each row of docs: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, boilerplate_share (of the characters of its distinct lines) and kept.

    A line is boilerplate on a host where more than min_line_docs and more than line_share of its distinct documents hold it; that
    is the same rule for small and large hosts, the number only keeps what a few documents of a tiny host share.

    Null and empty texts fail the base rules. A null host is a host. Rows with a null id count as one id below all others; rows
    that share an id and a text count once. Texts of any length are judged whole. Of holders with the smallest id all keep the
    line. An empty table gives an empty one. Extra columns are ignored.
    """
    found = _judged(_plain(docs, id_col, text_col, host_col), min_words, most_repeat_percent, min_line_docs, line_share, most_boilerplate, scope)
    return found.select(F.col("doc").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "boilerplate_share", "kept")


def clean(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", *, min_words: int = 20,
    most_repeat_percent: int = 30, min_line_docs: int = 5, line_share: float = 0.02, most_boilerplate: float = 0.7, scope: str = "quality_rules",
) -> DataFrame:
    """The rows of docs that judge keeps, with all their columns and clean_text: the text without lines above the limit, which stay with their first holder."""
    found = _judged(_plain(docs, id_col, text_col, host_col), min_words, most_repeat_percent, min_line_docs, line_share, most_boilerplate, scope)
    i, c, o = (fresh(docs, n) for n in ("__id", "__content", "__over"))
    kept = found.where("kept").select(F.col("id").alias(i), F.col("content").alias(c), F.col("over").alias(o)).dropDuplicates([i, c])
    text = F.col(text_col).cast("string")
    left = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(F.col(o), F.xxhash64(normalised(x))))
    rows = docs.withColumn(i, id_key(id_col)).withColumn(c, F.xxhash64(text)).join(kept, [i, c])
    return rows.withColumn("clean_text", F.when(F.col(o).isNull(), text).otherwise(F.array_join(left, "\n"))).drop(i, c, o)
