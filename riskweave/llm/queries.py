"""One query per operator over its whole table, and the matching SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (collocation, decontam, exact_dedup, langid, language_model, mixing, near_dedup, pii, quality, substring, toxicity,
               warc, whitening)
from .common import Scratch, documents, fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@query("op3_source_mix", r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))), 1, 15) AS BIGINT) AS key
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, source_size * CAST(2 AS DOUBLE) AS cap,
         CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM totals),
running AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS cap_before, coalesce(sum(weight) OVER before, 0) AS weight_before,
         sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight
  FROM ranked
  WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levelled AS (
  SELECT *, (all_size * CAST(1.5 AS DOUBLE) - cap_before) / (all_weight - weight_before) AS level FROM running),
found AS (
  SELECT min_by(level, cap / weight) AS level FROM levelled WHERE level * weight <= cap),
targets AS (
  SELECT source, source_size, coalesce(least(weight * (SELECT level FROM found), cap), cap) AS target FROM ranked),
cuts AS (
  SELECT source, source_size, target, CAST(round(target) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM targets),
placed AS (
  SELECT s.doc_id, s.size, c.source_size, c.target, c.budget, c.epochs,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS begins
  FROM sized s JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(epochs * size + least(greatest(budget - epochs * source_size - begins, 0), size) AS BIGINT) AS taken
FROM placed""")
def q_mix(spark, sf_dir):
    return mixing.mix(spark, documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query("op4_exact_dedup", r"""
WITH digests AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM digests WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, text_sha256 FROM ranked""")
def q_exact(spark, sf_dir):
    return exact_dedup.ingest(spark, documents(spark, sf_dir)).drop("points")


@query("op10_substring_dedup", r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, place, array_to_string(w[place:place + 12], ' ') AS passage
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS place FROM words WHERE len(w) >= 13)),
firsts AS (SELECT passage, min(doc_id) AS first_doc FROM starts GROUP BY passage HAVING count(*) > 1),
hits AS (SELECT s.doc_id, s.place FROM starts s JOIN firsts f USING (passage) WHERE f.first_doc < s.doc_id),
gone AS (SELECT DISTINCT doc_id, place + k AS place FROM hits, range(13) r(k)),
listed AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
         CASE WHEN places IS NULL THEN w
              ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END AS kept
  FROM words w LEFT JOIN listed USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM kept""")
def q_substring(spark, sf_dir):
    return substring.remove_repeats(spark, documents(spark, sf_dir))


@query("op9_warc", r"""
WITH bodies AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM bodies)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_page THEN first_page END AS refers_to
FROM firsts""")
def q_warc(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    scratch = Scratch(spark, "warc")
    base = scratch.path("archive")
    manifest = warc.write_archive(spark, pages, base, scratch)
    return warc.read_archive(spark, manifest, base, with_payload=False).drop("url", "payload")


@query("op8_decontaminate")
def q_decontaminate(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontam.contaminated(spark, documents(spark, sf_dir), benchmark)


@query("op6_near_dedup")
def q_near_dedup(spark, sf_dir):
    return near_dedup.classes(spark, documents(spark, sf_dir))


@query("op7_language_id")
def q_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = langid.fit(docs, langid.training_rows(F.col("doc_id")))
    return langid.label(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op1_toxicity")
def q_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.fit(docs, labels, toxicity.training_rows(F.col("doc_id")))
    return toxicity.score(docs, model).select(
        "doc_id", (~toxicity.training_rows(F.col("doc_id"))).alias("held_out"), "score", "predicted")


_PII_KINDS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
              ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
              ("card", r"[0-9](?:[\x20-]?[0-9])+"),
              ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
_PII_CHECKS = {
    "email": "true",
    "ip": "list_bool_and(list_transform(string_split(m, '.'), lambda p: TRY_CAST(p AS HUGEINT) <= 255))",
    "card": ("len(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(string_split(reverse(digits), ''), lambda d, i: "
             "CASE WHEN i % 2 = 1 THEN d::INT WHEN d::INT > 4 THEN d::INT * 2 - 9 ELSE d::INT * 2 END)) % 10 = 0"),
    "phone": "len(digits) BETWEEN 10 AND 15",
}
# The added kinds (IBAN, social security numbers) are tested against brute
# force; the given tables hold none, so all spans are the base ones here.
_PII_SQL = "WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),\n" + ",\n".join(
    f"""{kind}_found AS (
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank, m, regexp_replace(m, '[^0-9]', '', 'g') AS digits,
         CAST(list_sum(list_transform(pieces[1:i], lambda x: length(x)))
              + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
  FROM (SELECT doc_id, pieces, ms, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS i
        FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS pieces,
                     regexp_extract_all(text, '{pattern}') AS ms FROM docs))),
{kind}_spans AS (SELECT doc_id, kind, rank, start, start + length(m) AS ends FROM {kind}_found WHERE {_PII_CHECKS[kind]})"""
    for rank, (kind, pattern) in enumerate(_PII_KINDS)) + """,
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || start || ':' || ends, ',' ORDER BY start, rank) AS spans
  FROM (SELECT * FROM email_spans UNION ALL SELECT * FROM ip_spans UNION ALL SELECT * FROM card_spans
        UNION ALL SELECT * FROM phone_spans) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN listed USING (doc_id)"""


@query("op5_pii", _PII_SQL)
def q_pii(spark, sf_dir):
    return pii.summary(pii.find_spans(documents(spark, sf_dir)))


@query("op2_importance_resample")
def q_quality(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.resample(spark, documents(spark, sf_dir), labels)


@query("op13_embedding_whitening")
def q_whitening(spark, sf_dir):
    return whitening.whiten(spark, spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


@query("op12_collocations", r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts)),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM pieces GROUP BY lang),
found AS (
  SELECT lang, w[i:i + k - 1] AS p
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) sizes(k) WHERE len(w) >= k)),
counts AS (SELECT lang, p, CAST(count(*) AS HUGEINT) AS f FROM found GROUP BY lang, p HAVING count(*) >= 100),
several AS (SELECT * FROM counts WHERE len(p) > 1),
inner_parts AS (
  SELECT lang, p[i:i + k - 1] AS p, max(f) AS longer
  FROM (SELECT lang, p, f, k, unnest(range(1, len(p) - k + 2)) AS i FROM several, range(2, 5) sizes(k) WHERE len(p) > k)
  GROUP BY ALL),
kept AS (
  SELECT s.lang, s.p, s.f AS a FROM several s LEFT JOIN inner_parts i ON i.lang = s.lang AND i.p = s.p
  WHERE longer IS NULL OR 100 * longer < 100 * s.f),
cuts AS (
  SELECT k.lang, k.p, a, l.f AS l, r.f AS r, n, cut, 1000 * a * n // (l.f * r.f) AS score
  FROM (SELECT lang, p, a, unnest(range(1, len(p))) AS cut FROM kept) k
  JOIN counts l ON l.lang = k.lang AND l.p = k.p[1:cut]
  JOIN counts r ON r.lang = k.lang AND r.p = k.p[cut + 1:]
  JOIN totals t ON t.lang = k.lang),
scored AS (
  SELECT *, array_to_string(p, ' ') AS phrase FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000""")
def q_collocations(spark, sf_dir):
    return collocation.collocations(spark, documents(spark, sf_dir))


@query("op11_lm_score")
def q_language_model(spark, sf_dir):
    return language_model.score(spark, documents(spark, sf_dir), language_model.training_rows(F.col("doc_id")))
