"""The corpus operators as queries over the tables of a folder, with the SQL of those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumentrace.llm import bpe_codec, collocations, html_crf, line_dedup, ngram_join, packing, periodic, quality_rules, simhash, site_quality, suffix_dedup, topk, toxicity
from lumentrace.llm.common import table


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
k AS (
  SELECT doc_id, i, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
r AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


def op1_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_crf.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# 8-word windows as lists; a line that more than 5 documents and 2 % of its host hold stays with the smallest id
OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (SELECT doc_id, i, w[i:i + 7] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
ln AS (
  SELECT DISTINCT doc_id, coalesce(source, '') AS host, text, lower(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS x
  FROM (SELECT doc_id, source, text, unnest(l) AS x FROM d)),
held AS (SELECT host, x, count(DISTINCT text) AS n, min(doc_id) AS first FROM ln GROUP BY host, x),
size AS (SELECT coalesce(source, '') AS host, count(DISTINCT text) AS docs FROM documents GROUP BY 1),
bad AS (SELECT host, x, first FROM held JOIN size USING (host) WHERE n > 5 AND n > docs * 0.02),
gone AS (
  SELECT ln.doc_id, sum(length(x)) AS total, coalesce(sum(length(x)) FILTER (bad.first IS NOT NULL AND bad.first <> ln.doc_id), 0) AS gone
  FROM ln LEFT JOIN bad USING (host, x) GROUP BY ln.doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(gone / nullif(total, 0), 0) AS share
  FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND share <= 0.7 AS kept FROM f
"""


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_codec.digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the labels whose crc32 leaves another remainder than 1; held_out marks the others."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = site_quality.judge(docs, site_quality.train(docs, labels.where(~held_out(F.col("doc_id")))))
    return found.withColumn("held_out", held_out(F.col("doc_id")))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents").select("lang", "text"))


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (
  SELECT lang, k, w[i:i + k - 1] AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS v(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, array_to_string(g, ' ') AS phrase, g, count(*) AS f FROM g GROUP BY lang, k, g HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
cut AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, l.k AS cut_at, l.f AS l, r.f AS r, ((1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM f c JOIN f l ON l.lang = c.lang AND l.k < c.k AND l.g = c.g[1:l.k] JOIN f r ON r.lang = c.lang AND r.k = c.k - l.k AND r.g = c.g[l.k + 1:c.k]
  WHERE c.k >= 2),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase, k ORDER BY score, cut_at) = 1),
inner2 AS (
  SELECT lang, phrase, max(f) AS longer
  FROM (SELECT lang, f, array_to_string(g[1:2], ' ') AS phrase FROM f WHERE k = 3 UNION ALL SELECT lang, f, array_to_string(g[2:3], ' ') FROM f WHERE k = 3)
  GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM best JOIN n USING (lang) LEFT JOIN inner2 USING (lang, phrase)
WHERE longer IS NULL OR 100 * longer < 50 * a OR k = 3
QUALIFY rank <= 2000
"""


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP12_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + 2] AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS i FROM w)),
n AS (SELECT w.doc_id, count(s) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
ends AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS dest FROM n UNION SELECT reach.doc_id, ends.b FROM reach JOIN ends ON ends.a = reach.dest)
SELECT doc_id, n AS n_shingles, min(dest) AS component_id FROM reach JOIN n USING (doc_id) GROUP BY doc_id, n
"""


def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) with the words from a on, of one id in ten, replaced by repetitions of the p words there."""
    for batch in batches:
        texts = []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            h = 1 if i is None else zlib.crc32(b"%d" % i)
            words = t.split() if t and h % 10 == 0 else []
            if words:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                t = b" ".join(words[:a] + (words[a : a + p] * (1 + (n - a) // p))[: n - a])
            texts.append(t)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = periodic.find_runs(docs.mapInArrow(planted, "doc_id long, text string"))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    top = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"), top["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_crf": op1_html_crf,
        "op2_quality_rules": op2_quality_rules,
        "op3_packing": op3_packing,
        "op4_topk": op4_topk,
        "op5_line_dedup": op5_line_dedup,
        "op6_simhash": op6_simhash,
        "op7_bpe_codec": op7_bpe_codec,
        "op8_site_quality": op8_site_quality,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_toxicity": op10_toxicity,
        "op11_collocations": op11_collocations,
        "op12_ngram_join": op12_ngram_join,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": OP2_SQL, "op4_topk": OP4_SQL, "op5_line_dedup": OP5_SQL, "op11_collocations": OP11_SQL, "op12_ngram_join": OP12_SQL}
