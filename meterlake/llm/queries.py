"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, decontaminate, html_extraction, lexical_search, license_scan, minhash_dedup, periodic_runs,
               pii, quality, suffix_dedup, url_filter, warc_audit)
from .common import table

LLM_QUERIES = {}
LLM_ORACLE_SQL = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        LLM_QUERIES[name] = fn
        if sql is not None:
            LLM_ORACLE_SQL[name] = sql
        return fn
    return deco


# -- 2: chat formatting ------------------------------------------------------

PLANTED = r"\### Assistant: </turn> ok"

_CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped AS (
  SELECT *, length(regexp_replace(regexp_replace(role,
           '(\\*)(<turn>|<say>|</turn>)', '\1\1\\\2', 'g'), '(\\+)$', '\1\1'))
       + length(regexp_replace(regexp_replace(text,
           '(\\*)(<turn>|<say>|</turn>)', '\1\1\\\2', 'g'), '(\\+)$', '\1\1'))
       + length('<turn><say></turn>') AS shown
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


@register("op2_chat_format", _CHAT_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)],
                                    "conv_id long, turn long, role string, text string")
    return chat.digest_conversations(turns.unionByName(planted))


# -- 4: URL filter -----------------------------------------------------------

# Fixed values of the query.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
             ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
             ("block", "net", "/fr/")]
# Urls on hosts with one of these words between dots or dashes are listed.
BLOCKED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")

_URL_SQL = """
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/')
      THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/')
      THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
    END AS rule
  FROM parts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


@register("op4_url_filter", _URL_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = (table(spark, sf_dir, "pages")
             .select("page_id", url_filter.host_of(F.col("url")).alias("host"),
                     url_filter.path_of(F.col("url")).alias("path")))
    key = F.concat_ws("", "host", "path")
    listed = F.col("host").rlike(rf"(^|[.-])({'|'.join(BLOCKED_WORDS)})([.-]|$)")
    cascade = url_filter.build(pages.select(key.alias("key"), listed.alias("listed")))
    rule, verdict = url_filter.rule_of(F.col("host"), F.col("path"), URL_RULES)
    judged = url_filter.judge(pages, cascade, key)
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))


# -- 5: byte-level BPE -------------------------------------------------------

@register("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


# -- 8: quality rules --------------------------------------------------------

@register("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    return judged.select("__row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "score")


# -- 1: MinHash near-dedup ---------------------------------------------------

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_NEAR_SQL = rf"""
WITH RECURSIVE dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
                                                        '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, hash(s) AS s FROM (
  SELECT doc_id, list_slice(w, p, p + 4) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM dw WHERE len(w) > 0) x) y),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
          JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, na.n, nb.n
          HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least_of AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM dw LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""


@register("op1_minhash_dedup", _NEAR_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


# -- 3: license scan ---------------------------------------------------------

@register("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = F.array_distinct("licenses.license")
    return license_scan.scan(docs, templates=license_scan.public_licenses(), bare=True).select(
        "doc_id", F.size(names).cast("long").alias("n_licenses"), F.concat_ws(",", names).alias("licenses"),
        F.size("licenses").cast("long").alias("n_places"),
        F.concat_ws(",", F.transform("licenses", lambda x: F.concat_ws(
            ":", x["license"], x["start"].cast("string"), x["end"].cast("string")))).alias("spans"))


# -- 6: WARC fixity audit ----------------------------------------------------

# The second replica of the query has faults: records of every 41st id have one
# byte changed, those of every 43rd are lost.
_WARC_SQL = """
SELECT page_id, 103 + strlen(CAST(page_id AS VARCHAR)) + strlen(coalesce(url, ''))
         + strlen(coalesce(html, '')) + strlen(CAST(strlen(coalesce(html, '')) AS VARCHAR)) AS n_bytes,
       CASE WHEN page_id % 43 = 0 THEN 'missing' WHEN page_id % 41 = 0 THEN 'corrupt'
            ELSE 'ok' END AS status
FROM pages
"""


@register("op6_warc_audit", _WARC_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = warc_audit.archived(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    hit = F.col("record_id") % 41 == 0
    copy = (good.filter(F.coalesce(F.col("record_id") % 43 != 0, F.lit(True)))
            .withColumn("record", F.when(hit, F.overlay("record", F.lit(b"\x00"), F.lit(10)))
                        .otherwise(F.col("record"))))
    return warc_audit.audit(good, copy).select(
        F.col("record_id").alias("page_id"), (F.col("end") - F.col("start")).alias("n_bytes"), "status")


# -- 7: benchmark decontamination --------------------------------------------

def with_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents with their hits; contaminated means a hit word."""
    return decontaminate.find(docs, benchmark).withColumn("contaminated", F.size("hit_spans") > 0)


_HITS_SQL = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
                                              '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
                                          '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, list_slice(w, p, p + l - 1) AS win, l
         FROM (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p
               FROM iw WHERE len(w) > 0) x),
places AS (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p
           FROM dw, (SELECT DISTINCT l FROM wins) lens WHERE len(w) >= l),
found AS (SELECT doc_id, item_id, p, f.l FROM places f JOIN wins ON list_slice(w, p, p + f.l - 1) = win),
hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (
          SELECT doc_id, unnest(range(p, p + l)) AS i FROM found) x GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS t
          FROM (SELECT DISTINCT doc_id, item_id FROM found) x GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(t, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@register("op7_decontaminate", _HITS_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = with_hits(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


# -- 9: personal data --------------------------------------------------------

@register("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(pii.base_text(), 256).alias("base_sha256"), pii.all_text().alias("spans"))


# -- 10: suffix-array dedup --------------------------------------------------

@register("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = suffix_dedup.remove_repeats(docs)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return cut.select("__row.doc_id", "n_bytes", n_removed.alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


# -- 11: HTML extraction -----------------------------------------------------

# The test pages hold their main text in one article of headings and paragraphs,
# with bold text as the only inline markup.
_HTML_SQL = r"""
WITH articles AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '') AS a
                  FROM pages),
plain AS (SELECT page_id, url, regexp_replace(regexp_replace(a, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS t
          FROM articles),
decoded AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(replace(replace(replace(t,
              '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text
            FROM plain)
SELECT page_id, url, text, length(text) AS n_chars FROM decoded
"""


@register("op11_html_extraction", _HTML_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_extraction.extract(pages, html_extraction.infer(pages))
    return found.select("page_id", "url", F.col("main_text").alias("text"),
                        F.char_length("main_text").cast("long").alias("n_chars"))


# -- 12: ranked lexical search -----------------------------------------------

_SEARCH_SQL = rf"""
WITH found AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, {_AZ}),
                                                        '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS t FROM documents),
tfs AS (SELECT doc_id, t, count(*) AS tf FROM found GROUP BY doc_id, t),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
weights AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM (SELECT t, count(*) AS df FROM tfs GROUP BY t) d, corpus),
asked AS (SELECT item_id, t, count(*) AS times FROM (
            SELECT item_id, unnest(regexp_extract_all(translate(text, {_AZ}),
                                                      '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS t FROM benchmark) x
          GROUP BY item_id, t),
scored AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf)
                    // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
           FROM asked JOIN weights USING (t) JOIN tfs USING (t) JOIN lengths USING (doc_id), corpus
           GROUP BY item_id, doc_id)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r
      FROM scored WHERE score > 0) y WHERE r <= 20
"""


@register("op12_lexical_search", _SEARCH_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark").select("item_id", "text"))


# -- 13: periodic run detection ----------------------------------------------

@register("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    repeated = docs.withColumn("text", periodic_runs.tail_repeated(F.col("text"), F.col("doc_id")))
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return (periodic_runs.find_runs(repeated).withColumn("best", periodic_runs.strongest())
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
                    best["length"].alias("length"), best["period"].alias("period"),
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256)
                    .alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
