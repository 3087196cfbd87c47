"""Texts, pages and conversations: audits, redaction, rendering, contracts on nested documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumentrace.functions import scalars as S
from lumentrace.operators import aggregates as A
from lumentrace.operators import contracts as C
from lumentrace.operators import joins as J
from lumentrace.plans.tables import Book, table

book = Book()


@book.add(
    "page_path_columns",
    r"""
SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]*)', 1) AS section,
  TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS number, url LIKE '%?%' AS has_query, contains(url, '#top') AS has_anchor FROM pages""",
)
def page_path_columns(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", F.regexp_extract(u, r"^([a-z]+)://", 1).alias("scheme"), F.regexp_extract(u, r"^[a-z]+://([^/?#]+)", 1).alias("host"), F.regexp_extract(u, r"^[a-z]+://[^/?#]+/([^/?#]*)", 1).alias("section"),
        F.regexp_extract(u, r"/([0-9]+)", 1).try_cast("long").alias("number"), u.contains("?").alias("has_query"), u.contains("#top").alias("has_anchor"),
    )


@book.add(
    "page_filters",
    r"""
SELECT page_id FROM pages WHERE (regexp_matches(url, '^https') AND regexp_matches(url, '/en/')) OR (page_id % 7 = 3 AND contains(url, 'ref='))""",
)
def page_filters(spark, sf):
    """Optional filters, and-ed within and or-ed between."""
    u = F.col("url")
    return table(spark, sf, "pages").where((u.startswith("https") & u.contains("/en/")) | ((F.col("page_id") % 7 == 3) & u.contains("ref="))).select("page_id")


@book.add(
    "prefix_counts",
    r"""
WITH k AS (SELECT unnest(['en', 'fr', 'de', 'es', 'it']) AS prefix), c AS (SELECT regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]*)', 1) AS prefix, count(*) AS n FROM pages GROUP BY 1)
SELECT prefix, coalesce(n, 0) AS n FROM k LEFT JOIN c USING (prefix)""",
)
def prefix_counts(spark, sf):
    return A.prefix_counts(table(spark, sf, "pages"), F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([^/?#]*)", 1), ["en", "fr", "de", "es", "it"])


@book.add(
    "page_text_lines",
    r"""
SELECT page_id, count(*) AS tags, count(*) FILTER (t LIKE '/%') AS closing, count(*) FILTER (t IN ('p', 'h1', 'li')) AS blocks FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '<(/?[a-zA-Z0-9]+)', 1)) AS t FROM pages) GROUP BY page_id""",
)
def page_text_lines(spark, sf):
    t = table(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit("<(/?[a-zA-Z0-9]+)"), 1)).alias("t"))
    return t.groupBy("page_id").agg(F.count("*").alias("tags"), F.count_if(F.col("t").startswith("/")).alias("closing"), F.count_if(F.col("t").isin("p", "h1", "li")).alias("blocks"))


@book.add(
    "doc_pii_audit",
    r"""
WITH c AS (SELECT
    len(regexp_extract_all(text, '(?i)\blorem school\b|\bIP\b')) AS school_plain,
    len(regexp_extract_all(text, '(?i)\b[A-Z][a-z]+ (?:University|College)\b')) AS school_generic,
    len(list_filter(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'), lambda m: NOT contains(m, '@example.com'))) AS email_plain,
    len(regexp_extract_all(text, '\b(?:\+?86)?1[3-9]\d{9}\b|\b\d{4}[- ]\d{4}\b')) AS phone_plain,
    len(regexp_extract_all(text, 'University X|School X|User [A-Z]\b|email_x@|XXX-XXXX-XXXX|Address X')) AS placeholders FROM documents)
SELECT CAST(coalesce(sum(school_plain), 0) AS BIGINT) AS school_plain, CAST(coalesce(sum(school_generic), 0) AS BIGINT) AS school_generic, CAST(coalesce(sum(email_plain), 0) AS BIGINT) AS email_plain,
  CAST(coalesce(sum(phone_plain), 0) AS BIGINT) AS phone_plain, CAST(coalesce(sum(placeholders), 0) AS BIGINT) AS anonymized_placeholders,
  CAST(coalesce(sum(school_plain + school_generic + email_plain + phone_plain), 0) AS BIGINT) AS total_hits, count(*) AS docs FROM c""",
)
def doc_pii_audit(spark, sf):
    """Matches of each privacy pattern in all texts; placeholders do not count as hits. The named schools are a stand-in."""
    counts = S.pii_counts(F.col("text"), ("lorem school", "IP"))
    hits = [n for n in counts if n not in ("anonymized_placeholders", "total_hits")]
    # the total is that of the sums, so that no pattern is matched twice
    per_text = table(spark, sf, "documents").select(*(counts[n].alias(n) for n in (*hits, "anonymized_placeholders")))
    sums = per_text.agg(*(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in (*hits, "anonymized_placeholders")), F.count("*").alias("docs"))
    return sums.withColumn("total_hits", sum((F.col(n) for n in hits[1:]), F.col(hits[0])))


@book.add(
    "doc_exact_dups",
    "SELECT sha256(text) AS digest, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents GROUP BY 1 HAVING count(*) > 1",
)
def doc_exact_dups(spark, sf):
    d = table(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    return d.where("n > 1")


@book.add(
    "doc_substring_match",
    r"""
SELECT item_id, count(*) AS docs, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM documents d JOIN benchmark b ON d.text <> '' AND b.text <> '' AND (d.text = b.text OR contains(d.text, b.text) OR contains(b.text, d.text)) GROUP BY item_id""",
)
def doc_substring_match(spark, sf):
    """Passages that equal a document, are held by one or hold one, wherever in a line they begin or end."""
    pairs = J.contained(table(spark, sf, "documents"), "doc_id", table(spark, sf, "benchmark"), "item_id", "text")
    return pairs.groupBy("item_id").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))


@book.add(
    "doc_shared_lines",
    r"""
WITH l AS (SELECT doc_id, trim(x) AS label FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents) WHERE length(trim(x)) >= 20),
o AS (SELECT item_id, trim(x) AS object FROM (SELECT item_id, unnest(string_split(text, chr(10))) AS x FROM benchmark) WHERE length(trim(x)) >= 20)
SELECT item_id, count(*) AS lines, count(DISTINCT doc_id) AS docs, min(doc_id) AS first_doc FROM l JOIN o ON l.label = o.object GROUP BY item_id""",
)
def doc_shared_lines(spark, sf):
    """Lines of passages found as whole lines of documents: an equi-join that scales with both sides."""
    cut = lambda d, i, n: d.select(i, F.explode(F.split("text", "\n")).alias(n)).withColumn(n, F.trim(n)).where(F.length(n) >= 20)
    docs, items = cut(table(spark, sf, "documents"), "doc_id", "line"), cut(table(spark, sf, "benchmark"), "item_id", "line")
    return docs.join(items, "line").groupBy("item_id").agg(F.count("*").alias("lines"), F.count_distinct("doc_id").alias("docs"), F.min("doc_id").alias("first_doc"))


@book.add(
    "doc_passage_containment",
    r"""
SELECT item_id, count(*) AS docs, min(doc_id) AS first_doc FROM documents d JOIN benchmark b ON d.text <> '' AND b.text <> '' AND (contains(d.text, b.text) OR contains(b.text, d.text)) GROUP BY item_id""",
)
def doc_passage_containment(spark, sf):
    """Documents that hold a passage, are held by it or equal it, wherever in a line it begins or ends."""
    pairs = J.contained(table(spark, sf, "documents"), "doc_id", table(spark, sf, "benchmark"), "item_id", "text")
    return pairs.groupBy("item_id").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first_doc"))


_LABELS = """
WITH l AS (SELECT l, min(pos) AS pos FROM (SELECT p_partkey AS pos, p_type AS l FROM part UNION ALL SELECT 1000000000000000000, '1-URGENT' UNION ALL SELECT 1000000000000000001, 'URGENT' UNION ALL SELECT 1000000000000000002, '2-HIGH LEVEL' UNION ALL SELECT 1000000000000000003, '') WHERE l <> '' GROUP BY l),
m AS (SELECT o, l, pos, row_number() OVER (PARTITION BY o ORDER BY length(l) DESC, pos) AS k FROM (SELECT DISTINCT o_orderpriority AS o FROM orders) JOIN l ON contains(o, l) OR contains(l, o))
"""


def _matched(spark, sf):
    """(orders, their texts with the best label): each distinct text meets the labels that hold it or that it holds."""
    own = spark.createDataFrame([(10**18 + i, x) for i, x in enumerate(("1-URGENT", "URGENT", "2-HIGH LEVEL", ""))], "pos long, l string")
    labels = table(spark, sf, "part").select(F.col("p_partkey").cast("long").alias("pos"), F.col("p_type").alias("l")).unionAll(own).where("l <> ''").groupBy("l").agg(F.min("pos").alias("pos"))
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("o"))
    pairs = J.short_contained(orders.select("o").distinct(), "o", labels.select("l"), "l").join(labels, "l")
    return orders, pairs.groupBy("o").agg(F.max_by(F.struct("l", "pos"), F.struct(F.length("l"), -F.col("pos"))).alias("best"))


@book.add("label_containment", _LABELS + "SELECT l AS label, pos AS position, count(*) AS orders, min(o_orderkey) AS first_order FROM orders JOIN m ON o_orderpriority = o AND k = 1 GROUP BY l, pos")
def label_containment(spark, sf):
    """How many orders each label is the longest match of, over all orders and the labels of all parts."""
    orders, best = _matched(spark, sf)
    return orders.join(best, "o").groupBy(F.col("best.l").alias("label"), F.col("best.pos").alias("position")).agg(F.count("*").alias("orders"), F.min("o_orderkey").alias("first_order"))


@book.add("label_containment_all", _LABELS + "SELECT o_orderkey, l AS label FROM orders JOIN m ON o_orderpriority = o AND k = 1")
def label_containment_all(spark, sf):
    """The longest label that holds an order's text or is held by it, the first on ties."""
    orders, best = _matched(spark, sf)
    return orders.join(best, "o").select("o_orderkey", F.col("best.l").alias("label"))


@book.add(
    "doc_truncate_context",
    "SELECT doc_id, length(CASE WHEN length(text) > 30000 THEN substr(text, 1, 30000) || chr(10) || '... (OCR truncated)' ELSE text END) AS n, coalesce(length(text) > 30000, false) AS cut FROM documents",
)
def doc_truncate_context(spark, sf):
    """Texts cut at the limit of a context block, with its marker."""
    cut = S.truncated(F.col("text"), 30_000, "\n... (OCR truncated)")
    return table(spark, sf, "documents").select("doc_id", F.length(cut).cast("long").alias("n"), F.coalesce(F.length("text") > 30_000, F.lit(False)).alias("cut"))


@book.add(
    "doc_truncate_context_30k",
    "SELECT doc_id, length(CASE WHEN length(text) > 30000 THEN substr(text, 1, 30000) || ' [cut]' ELSE text END) AS n, text IS NOT NULL AND length(text) > 30000 AS cut FROM documents",
)
def doc_truncate_context_30k(spark, sf):
    """The limit of the reference."""
    return table(spark, sf, "documents").select("doc_id", F.length(S.truncated(F.col("text"), 30_000, " [cut]")).cast("long").alias("n"), F.coalesce(F.length("text") > 30_000, F.lit(False)).alias("cut"))


@book.add(
    "doc_redact",
    r"""
WITH z AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS (SELECT doc_id, regexp_replace(t, '(?i)(authorization[' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ']*[:=][' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ']*bearer[' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ']+)[^' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ',;"'']+', '\1[REDACTED]', 'g') AS t FROM z),
b AS (SELECT doc_id, regexp_replace(t, '(?i)((?:api[_-]?key|key|token)[' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ']*[=:][' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ']*)[^' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ',;"'']+', '\1[REDACTED]', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(regexp_replace(t, 'AIza[0-9A-Za-z_-]{10,}', '[REDACTED]', 'g'), 'hf_[0-9A-Za-z_-]{10,}', '[REDACTED]', 'g') AS t FROM b)
SELECT doc_id, trim(regexp_replace(t, '[' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ']+', ' ', 'g')) AS redacted FROM c""",
)
def doc_redact(spark, sf):
    """Whole texts without what looks like a secret."""
    return table(spark, sf, "documents").select("doc_id", S.redact(F.col("text")).alias("redacted"))


@book.add(
    "doc_redact_whole",
    r"""
WITH z AS (SELECT doc_id, replace(replace(coalesce(text, ''), 'license', '[REDACTED]'), 'AKIA', '[REDACTED]') AS t FROM documents),
a AS (SELECT doc_id, regexp_replace(t, '(?i)(authorization[' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ']*[:=][' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ']*bearer[' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ']+)[^' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ',;"'']+', '\1[REDACTED]', 'g') AS t FROM z),
b AS (SELECT doc_id, regexp_replace(t, '(?i)((?:api[_-]?key|key|token)[' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ']*[=:][' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ']*)[^' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ',;"'']+', '\1[REDACTED]', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(regexp_replace(t, 'AIza[0-9A-Za-z_-]{10,}', '[REDACTED]', 'g'), 'hf_[0-9A-Za-z_-]{10,}', '[REDACTED]', 'g') AS t FROM b)
SELECT doc_id, trim(regexp_replace(t, '[' || '\s\x0B\x1C-\x1F\x85\p{Z}' || ']+', ' ', 'g')) AS redacted FROM c""",
)
def doc_redact_whole(spark, sf):
    """The same with values of secret variables, here a stand-in; one of under four characters stays."""
    return table(spark, sf, "documents").select("doc_id", S.redact(F.col("text"), ("license", "AKIA", "the")).alias("redacted"))


@book.add(
    "doc_error_class",
    """
WITH m AS (SELECT lower(coalesce(text, '')) AS m FROM documents),
c AS (SELECT CASE
  WHEN contains(m, '429') OR contains(m, 'resource_exhausted') OR contains(m, 'quota') OR contains(m, 'rate limit') OR contains(m, 'rate_limit') OR contains(m, 'billing account') OR contains(m, 'billing is disabled')
    OR contains(m, 'insufficient credits') THEN 'quota'
  WHEN contains(m, '413') OR contains(m, 'payload too large') OR contains(m, 'request too large') OR contains(m, 'request entity too large') OR contains(m, 'content size') OR contains(m, 'exceeds the maximum size')
    OR contains(m, 'exceeded the maximum size') THEN 'payload'
  WHEN contains(m, '404') OR contains(m, 'not_found') OR contains(m, 'model not found') OR contains(m, 'model is not found') OR contains(m, 'unsupported model') OR contains(m, 'unknown model') THEN 'model'
  WHEN contains(m, 'default credentials were not found') OR contains(m, 'could not automatically determine credentials') OR contains(m, 'unauthenticated') OR contains(m, 'permission_denied') OR contains(m, 'permission denied')
    OR contains(m, 'api key not valid') OR contains(m, 'invalid api key') OR contains(m, 'api key expired') OR contains(m, '401') OR contains(m, '403') THEN 'auth'
  WHEN contains(m, '500') OR contains(m, '502') OR contains(m, '503') OR contains(m, '504') OR contains(m, 'internal server error') OR contains(m, 'unavailable') OR contains(m, 'empty stream') THEN 'server'
  WHEN contains(m, 'timeout') OR contains(m, 'timed out') OR contains(m, 'connection error') OR contains(m, 'connection reset') OR contains(m, 'connection aborted') OR contains(m, 'temporary failure')
    OR contains(m, 'name resolution') THEN 'network'
  ELSE 'other' END AS class FROM m)
SELECT class, count(*) AS n, count(*) FILTER (class IN ('quota', 'server', 'network')) AS retryable, count(*) FILTER (class IN ('auth', 'model')) AS final FROM c GROUP BY class""",
)
def doc_error_class(spark, sf):
    d = table(spark, sf, "documents").select(S.error_class(F.col("text")).alias("class"))
    kind = F.col("class")
    return d.groupBy("class").agg(F.count("*").alias("n"), F.count_if(kind.isin(*S.RETRYABLE)).alias("retryable"), F.count_if(kind.isin(*S.FINAL)).alias("final"))


@book.add(
    "failure_class",
    """
WITH e AS (SELECT l_quantity, CASE l_linenumber WHEN 1 THEN 401 WHEN 2 THEN 404 WHEN 3 THEN 429 WHEN 4 THEN 503 WHEN 5 THEN 408 END AS code, l_linestatus AS kind, CASE WHEN l_quantity > 45 THEN 'Payment Required' ELSE l_returnflag END AS message FROM lineitem)
SELECT CASE WHEN l_quantity > 45 THEN 'billing' WHEN code = 401 THEN 'auth' WHEN code = 404 THEN 'model' WHEN code = 429 THEN 'quota' WHEN code = 503 THEN 'server' WHEN code = 408 THEN 'network' ELSE 'config' END AS class, count(*) AS n
FROM e GROUP BY 1""",
)
def failure_class(spark, sf):
    """Failures of a provider by code; the message shows bills alone."""
    n = F.col("l_linenumber")
    code = F.when(n == 1, 401).when(n == 2, 404).when(n == 3, 429).when(n == 4, 503).when(n == 5, 408)
    message = F.when(F.col("l_quantity") > 45, "Payment Required").otherwise(F.col("l_returnflag"))
    return table(spark, sf, "lineitem").groupBy(S.failure_class(code, F.col("l_linestatus"), message).alias("class")).agg(F.count("*").alias("n"))


@book.add(
    "doc_output_class",
    r"""
SELECT source, CASE WHEN trim(coalesce(text, '')) = '' THEN 'empty' WHEN len(string_split(text, ' ')) <= 25 AND NOT regexp_matches(trim(text), '^(\{|```)') THEN 'safety_rejection' ELSE 'ok' END AS outcome, count(*) AS n FROM documents GROUP BY 1, 2""",
)
def doc_output_class(spark, sf):
    d = table(spark, sf, "documents")
    return d.groupBy("source", S.output_class(F.col("text"), F.size(F.split("text", " "))).alias("outcome")).agg(F.count("*").alias("n"))


@book.add(
    "label_outcomes",
    """
SELECT CASE WHEN l.doc_id IS NULL THEN 'unlabelled' WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'poor' ELSE 'ok' END AS outcome, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 4) AS share
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""",
)
def label_outcomes(spark, sf):
    from pyspark.sql import Window

    d, lab = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").withColumn("known", F.lit(True))
    j = d.join(lab, "doc_id", "left")
    outcome = S.classed([(F.col("known").isNull(), "unlabelled"), (F.col("toxic") == 1, "toxic"), (F.col("quality") == 0, "poor")], "ok")
    g = j.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 4))  # four rows


@book.add(
    "conv_transcript_render",
    """
SELECT conv_id, string_agg('[' || CAST(turn AS VARCHAR) || '] ' || role || ': ' || coalesce(text, ''), chr(10) ORDER BY turn, role, text) AS transcript, count(*) AS turns FROM conversations GROUP BY conv_id""",
)
def conv_transcript_render(spark, sf):
    line = F.concat(F.lit("["), F.col("turn").cast("string"), F.lit("] "), "role", F.lit(": "), F.coalesce("text", F.lit("")))
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", line.alias("line")))).alias("l"), F.count("*").alias("turns"))
    return c.select("conv_id", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("transcript"), "turns")


@book.add(
    "conv_turn_chain",
    """
WITH c AS (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role) AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS k FROM conversations)
SELECT conv_id, count(*) AS turns, bool_and(k > 1 OR role IN ('system', 'user')) AS opens_well, count(*) FILTER (role = before) AS repeats, min(turn) AS first_turn, max(turn) AS last_turn FROM c GROUP BY conv_id""",
)
def conv_turn_chain(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn", "role")
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.lag("role").over(w).alias("before"), F.row_number().over(w).alias("k"))
    return c.groupBy("conv_id").agg(
        F.count("*").alias("turns"), F.bool_and((F.col("k") > 1) | F.col("role").isin("system", "user")).alias("opens_well"), F.count_if(F.col("role") == F.col("before")).alias("repeats"),
        F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"),
    )


@book.add(
    "conv_substantive",
    r"""
SELECT role, count(*) AS n, count(*) FILTER (length(regexp_replace(regexp_replace(coalesce(text, ''), '\[[^\]]*\]', '', 'g'), '[ \t\r\n]', '', 'g')) >= 4) AS substantive,
  count(*) FILTER (regexp_matches(trim(coalesce(text, '')), '(?i)^(i cannot|i can''t|sorry|as an ai).{0,200}[.!]?$')) AS refusals FROM conversations GROUP BY role""",
)
def conv_substantive(spark, sf):
    """Utterances with words beyond stage directions, and refusals."""
    t = F.coalesce("text", F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(t, r"\[[^\]]*\]", ""), r"[ \t\r\n]", "")
    refusal = F.trim(t).rlike(r"(?i)^(i cannot|i can't|sorry|as an ai).{0,200}[.!]?$")
    return table(spark, sf, "conversations").groupBy("role").agg(F.count("*").alias("n"), F.count_if(F.length(bare) >= 4).alias("substantive"), F.count_if(refusal).alias("refusals"))


@book.add(
    "fingerprint",
    """
SELECT source, sha256('{' || string_agg('"' || CAST(doc_id AS VARCHAR) || '": "' || sha256(coalesce(text, '')) || '"', ', ' ORDER BY CAST(doc_id AS VARCHAR)) || '}') AS fingerprint, count(*) AS files FROM documents GROUP BY source""",
)
def fingerprint(spark, sf):
    """Fingerprint of a release: the hash of the sorted digests of its files."""
    d = table(spark, sf, "documents").select("source", F.col("doc_id").cast("string").alias("name"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    return A.map_fingerprint(d, ["source"], "name", "digest")


_DOC = """
WITH s AS (SELECT user_id AS clip, event_id, event_type AS kind, (epoch_us(ts) // 1000000) % 100000 / 10.0 AS a, (epoch_us(ts) // 1000000) % 100000 / 10.0 + event_id % 50 AS b,
    event_id % 9 AS actor, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos FROM events)
"""


@book.add(
    "contract_rules",
    _DOC
    + """,
r AS (SELECT clip, CASE
    WHEN bool_or(b <= a) THEN 'INTERVAL'
    WHEN max(actor) > 7 AND count(*) > 75 THEN 'UNKNOWN_ACTOR'
    WHEN bool_or(b > 10000) THEN 'OUTSIDE_CLIP'
    WHEN bool_or(kind = 'error' AND b - a > 48) THEN 'SPEECH'
    ELSE 'OK' END AS rule FROM s GROUP BY clip)
SELECT rule, count(*) AS clips FROM r GROUP BY rule""",
)
def contract_rules(spark, sf):
    """The first rule that each nested annotation breaks, in the order of the contract."""
    docs = C.annotations(table(spark, sf, "events"))
    seg = F.col("segments")
    rules = [
        (F.exists(seg, lambda s: s["end_sec"] <= s["start_sec"]), "INTERVAL"),
        (F.exists(seg, lambda s: s["actor"] > 7) & (F.size(seg) > 75), "UNKNOWN_ACTOR"),
        (F.exists(seg, lambda s: s["end_sec"] > 10000), "OUTSIDE_CLIP"),
        (F.exists(seg, lambda s: (s["kind"] == "error") & (s["end_sec"] - s["start_sec"] > 48)), "SPEECH"),
    ]
    return docs.groupBy(S.classed(rules, "OK").alias("rule")).agg(F.count("*").alias("clips"))


@book.add(
    "normalize_nested",
    _DOC
    + """,
o AS (SELECT clip, event_id, row_number() OVER (PARTITION BY clip ORDER BY a, event_id) AS place, pos FROM s)
SELECT clip, count(*) AS segments, bool_or(place <> pos) AS sorted_anew, arg_min(event_id, place) AS first_segment, arg_max(event_id, place) AS last_segment FROM o GROUP BY clip""",
)
def normalize_nested(spark, sf):
    """Segments in canonical order, with the change log of what had to be put right."""
    d = C.sorted_segments(C.annotations(table(spark, sf, "events")))
    return d.select("clip", F.size("segments").cast("long").alias("segments"), F.array_contains("changes", "SORT_SEGMENTS").alias("sorted_anew"), F.element_at("segments", 1)["segment_id"].alias("first_segment"), F.element_at("segments", -1)["segment_id"].alias("last_segment"))


@book.add(
    "reference_checks",
    _DOC + " SELECT clip, count(DISTINCT actor) FILTER (actor NOT IN (0, 1, 2, 3, 4)) AS unknown_actors, count(DISTINCT kind) AS kinds FROM s GROUP BY clip",
)
def reference_checks(spark, sf):
    d = C.annotations(table(spark, sf, "events"))
    actors = F.array_distinct(F.transform("segments", lambda s: s["actor"]))
    known = F.array(*(F.lit(i).cast("long") for i in range(5)))
    return d.select("clip", F.size(F.array_except(actors, known)).cast("long").alias("unknown_actors"), F.size(F.array_distinct(F.transform("segments", lambda s: s["kind"]))).cast("long").alias("kinds"))


@book.add(
    "message_assembly",
    """
SELECT conv_id, string_agg(part, '|' ORDER BY turn, k, role) AS parts FROM (
  SELECT conv_id, turn, role, 0 AS k, 'media:' || CAST(turn AS VARCHAR) AS part FROM conversations UNION ALL SELECT conv_id, turn, role, 1, 'label:' || role FROM conversations) GROUP BY conv_id""",
)
def message_assembly(spark, sf):
    """Parts of a request in order, each medium before its label."""
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("l"))
    parts = F.flatten(F.transform("l", lambda x: F.array(F.concat(F.lit("media:"), x["turn"].cast("string")), F.concat(F.lit("label:"), x["role"]))))
    return c.select("conv_id", F.array_join(parts, "|").alias("parts"))


@book.add(
    "qc_metrics",
    """
SELECT lang, count(*) AS docs, CAST(sum(len(regexp_extract_all(text, '(?i)\\b(will|going to|wants to|intends)\\b'))) AS BIGINT) AS intents, count(*) FILTER (text LIKE '%|%') AS with_screen FROM documents GROUP BY lang""",
)
def qc_metrics(spark, sf):
    d = table(spark, sf, "documents")
    n = F.regexp_count("text", F.lit(r"(?i)\b(will|going to|wants to|intends)\b"))
    return d.groupBy("lang").agg(F.count("*").alias("docs"), F.sum(n).cast("long").alias("intents"), F.count_if(F.col("text").contains("|")).alias("with_screen"))


@book.add(
    "failure_signatures",
    r"""
SELECT CASE WHEN text IS NULL OR trim(text) = '' THEN 'no_text' WHEN NOT regexp_matches(text, '[.!?]\s*$') THEN 'truncated_at_end' WHEN contains(text, '%%%') THEN 'malformed_elsewhere' ELSE 'sound' END AS signature, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 4) AS share FROM documents GROUP BY 1""",
)
def failure_signatures(spark, sf):
    from pyspark.sql import Window

    t = F.col("text")
    sig = S.classed([(t.isNull() | (F.trim(t) == ""), "no_text"), (~t.rlike(r"[.!?]\s*$"), "truncated_at_end"), (t.contains("%%%"), "malformed_elsewhere")], "sound")
    g = table(spark, sf, "documents").groupBy(sig.alias("signature")).agg(F.count("*").alias("n"))
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 4))  # four rows


@book.add(
    "stage_preflight",
    """
SELECT source, count(*) AS rows, count(*) FILTER (text IS NOT NULL AND n_chars > 0) AS parseable, count(*) FILTER (n_chars BETWEEN 100 AND 20000) AS schema_ok, count(*) FILTER (n_chars <> length(text)) AS differences,
  array_to_string(list_sort(list(doc_id) FILTER (n_chars < 100))[1:3], ',') AS examples FROM documents GROUP BY source""",
)
def stage_preflight(spark, sf):
    """Counts of what a stage would accept, with up to three examples of what it would not."""
    d = table(spark, sf, "documents")
    # three minima in turn: no group is collected
    short = d.where("n_chars < 100").select("source", "doc_id")
    first = A.smallest(short, ["source"], "doc_id", 3).groupBy("source").agg(F.array_join(F.sort_array(F.collect_list("doc_id")).cast("array<string>"), ",").alias("examples"))
    counts = d.groupBy("source").agg(
        F.count("*").alias("rows"), F.count_if(F.col("text").isNotNull() & (F.col("n_chars") > 0)).alias("parseable"), F.count_if(F.col("n_chars").between(100, 20000)).alias("schema_ok"),
        F.count_if(F.col("n_chars") != F.length("text")).alias("differences"),
    )
    first = first.withColumnRenamed("source", "_source")
    return counts.join(first, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
