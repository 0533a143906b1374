"""Queries of the corpus operators: ``opN_<name>`` and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table, words
from . import (collocations, cotraining, decontamination, exact_topk, language_id, mixing, packing,
               periodic_runs, quality_rules, simhash, substring_dedup, url_filters, warc)

MIX_CYCLE = (3, 1, 2)
WINDOW_WORDS = 13
SIMHASH_BITS, SIMHASH_SHINGLE = 3, 3


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_report(docs, lambda s: mixing.cyclic_weights(s, MIX_CYCLE)).select(
        "doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null')) AS draw
  FROM documents),
srcs AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
weighted AS (
  SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS weight,
         source_size * 2.0::DOUBLE AS cap,
         1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE AS budget
  FROM srcs),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, source) AS j FROM weighted),
rates AS (
  SELECT b.j0, (any_value(o.budget) - coalesce(sum(o.cap) FILTER (o.j <= b.j0), 0.0))
               / sum(o.weight) FILTER (o.j > b.j0) AS rate,
         min(o.cap / o.weight) FILTER (o.j > b.j0) AS next_cap
  FROM ordered o, (SELECT 0 AS j0 UNION ALL SELECT j FROM ordered) b GROUP BY b.j0),
chosen AS (SELECT j0, rate FROM rates WHERE next_cap >= rate ORDER BY j0 LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN j <= (SELECT j0 FROM chosen) THEN cap
              ELSE weight * (SELECT rate FROM chosen) END::DOUBLE AS target
  FROM ordered),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
  FROM targets),
run AS (
  SELECT b.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         sum(size) OVER (PARTITION BY b.source ORDER BY draw RANGE UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER (PARTITION BY b.source, draw) AS tied
  FROM base b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN upto - tied / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM run
"""


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.CAPACITY)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.learn_from(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", *(F.col(f"_quality.{c}") for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")),
        F.col("_kept").alias("kept"))


URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", F.col("_url_host").alias("host"), F.col("_url_path").alias("path"),
        F.col("_url_rule").alias("rule"), F.col("_url_verdict").alias("verdict"))


OP4_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0
                       THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS host FROM rest),
u AS (
  SELECT page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(r, length(host) + 1), '^[^?#]*') AS path FROM h),
rules(rh, rp, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
hits AS (
  SELECT page_id, rh || rp AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS k
  FROM u JOIN rules ON (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp))
SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN hits ON u.page_id = hits.page_id AND k = 1
"""


TOP_K, QUERY_EVERY = 5, 50


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk.top_k(vectors, F.col("vec_id") % QUERY_EVERY == 0, TOP_K)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, [floor(x::DOUBLE * 256)::BIGINT FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM scored)
SELECT query_id, k::INTEGER AS rank, vec_id, score FROM ranked WHERE k <= 5
"""


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs, WINDOW_WORDS).select(
        "doc_id", F.col("_sub_n_words").alias("n_words"),
        F.col("_sub_n_removed").alias("n_removed"), F.col("_sub_sha256").alias("kept_sha256"))


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
firsts AS (SELECT s, min(doc_id) AS d FROM win GROUP BY s HAVING count(DISTINCT doc_id) > 1),
covered AS (
  SELECT DISTINCT win.doc_id, unnest(range(win.i, win.i + 13)) AS j
  FROM win JOIN firsts ON win.s = firsts.s AND win.doc_id > firsts.d),
gone AS (SELECT doc_id, list(j) AS js FROM covered GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, len(ws) AS n, coalesce(len(js), 0) AS r,
         [ws[k] FOR k IN range(1, len(ws) + 1) IF js IS NULL OR NOT list_contains(js, k)] AS ks
  FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, r::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(ks, ' '), '')) AS kept_sha256
FROM kept
"""


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_and_index(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages),
d AS (
  SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY h, payload_bytes) AS top,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
           (((('0x' || substr(h, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER)) & 31), 1)
           FOR i IN range(32)], '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top = page_id THEN NULL ELSE top END AS refers_to
FROM d
"""


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "text_score", "meta_score", "kept")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"),
                                    SIMHASH_BITS, SIMHASH_SHINGLE)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"),
                        "component_id")


DECON_WORDS = 10


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"),
                                          table(spark, sf_dir, "benchmark"), DECON_WORDS)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS m,
         array_to_string(list_slice(ws, i, i + 9), ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
grams AS (
  SELECT r, m, i, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS s
  FROM (SELECT r, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM win) WHERE len(ws) >= m)),
hits AS (SELECT DISTINCT g.r, g.i, g.m, w.item_id FROM grams g JOIN win w ON g.m = w.m AND g.s = w.s),
words AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + m)) AS j FROM hits)
          GROUP BY r),
items AS (SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits
          WHERE item_id IS NOT NULL GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit,
       coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


PHRASE_COUNT, PHRASE_WORDS, PHRASES_TOP, PHRASE_ABSORBED = 100, 5, 2000, 100


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    found = collocations.collocations(docs, PHRASE_COUNT, PHRASE_WORDS, PHRASE_ABSORBED)
    return collocations.ranked(found, PHRASES_TOP).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
total AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cut AS (
  SELECT lang, phrase, k, f AS a, unnest(range(1, k)) AS j, string_split(phrase, ' ') AS ws
  FROM f WHERE k >= 2),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, t.n, x.f AS l, y.f AS r, c.j,
         (1000 * c.a * t.n) // (x.f * y.f) AS score
  FROM cut c JOIN total t ON t.lang = c.lang
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(ws, 1, c.j), ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(ws, c.j + 1, c.k), ' ')),
best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM scored),
inside AS (
  SELECT lang, array_to_string(list_slice(ws, s, s + m - 1), ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS s
        FROM (SELECT lang, k, a, ws, unnest(range(2, k)) AS m FROM cut WHERE j = 1 AND k > 2))
  GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE o = 1 AND (longer IS NULL OR 100 * longer < 100 * a)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score
FROM placed WHERE rank <= 2000
"""


def _periodic(text: Column, doc_id: Column) -> Column:
    """The words of every tenth document, by hash of its id, made periodic from some word on."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def rewrite(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        return let(F.struct(w.alias("w"), a.alias("a"), p.alias("p")), lambda x: F.array_join(
            F.transform(x["w"], lambda v, i: F.when(i < x["a"], v).otherwise(
                F.get(x["w"], x["a"] + F.pmod(i - x["a"], x["p"])))), " "))

    chosen = F.coalesce((F.pmod(h, F.lit(10)) == 0) & text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return F.when(chosen, let(words(text), rewrite)).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", _periodic(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs.annotate(docs)
    longest = F.array_min(F.transform("_runs", lambda r: F.struct(
        (-r["length"]).alias("order"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("_runs", lambda r: F.format_string(
        "%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("_runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"),
        (-F.col("longest.order")).alias("length"), F.col("longest.period").alias("period"),
        F.floor(-1000 * F.col("longest.order") / F.col("longest.period")).cast("long").alias(
            "exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("_collapsed", 256).alias("collapsed_sha256"))


def queries() -> dict:
    return {"op1_source_mixing": op1_source_mixing,
            "op2_packing": op2_packing,
            "op3_quality_rules": op3_quality_rules,
            "op4_url_filters": op4_url_filters,
            "op5_exact_topk": op5_exact_topk,
            "op6_substring_dedup": op6_substring_dedup,
            "op7_warc": op7_warc,
            "op8_quality_classifier": op8_quality_classifier,
            "op9_language_id": op9_language_id,
            "op10_simhash": op10_simhash,
            "op11_decontamination": op11_decontamination,
            "op12_collocations": op12_collocations,
            "op13_periodic_runs": op13_periodic_runs}


def oracle_sql() -> dict[str, str]:
    return {"op1_source_mixing": OP1_SQL, "op4_url_filters": OP4_SQL,
            "op5_exact_topk": OP5_SQL, "op6_substring_dedup": OP6_SQL,
            "op7_warc": OP7_SQL, "op11_decontamination": OP11_SQL,
            "op12_collocations": OP12_SQL}
