"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (contextmix, imatch, linededup, mixing, neighbours, packing, pages, partcodes, setsketch, simhash, toxicity,
               urllist, variants)
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def crc_mod(column: str, n: int):
    """crc32 of the id's decimal text (a null id as empty text), modulo ``n``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


@query
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(read(spark, sf_dir, "documents"))


@query
def op4_url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page is a capture, fetched when the event numbered page_id * 7919 modulo the events
    happened. An error event lists, a signup event delists, the host of the page numbered
    event_id * 31 modulo the pages (events with odd numbers: that host's parent domain)."""
    pages_, events = read(spark, sf_dir, "pages").select("page_id", "url"), read(spark, sf_dir, "events")
    n_events, n_pages = F.lit(max(1, events.count())), F.lit(max(1, pages_.count()))
    captures = pages_.withColumn("event_id", F.col("page_id") * 7919 % n_events) \
        .join(events.select("event_id", F.col("ts").alias("fetched_at")), "event_id", "left")
    named = pages_.select("page_id", urllist.host(F.col("url")).alias("host"))
    parent = F.regexp_replace("host", r"^[^.]+\.(?=[^.]+\.)", "")
    entries = events.where(F.col("event_type").isin("error", "signup")) \
        .withColumn("page_id", F.col("event_id") * 31 % n_pages).join(named, "page_id").select(
            F.when(F.col("event_id") % 2 == 1, parent).otherwise(F.col("host")).alias("pattern"), F.col("ts").alias("at"),
            F.when(F.col("event_type") == "error", "add").otherwise("remove").alias("action"))
    return urllist.judge(captures, entries)


ORACLES["op4_url_list"] = r"""
WITH p AS (
  SELECT page_id, nullif(rtrim(CASE WHEN starts_with(place, '[') THEN string_split(place, ']')[1] || ']'
                               ELSE string_split(place, ':')[1] END, '.'), '') AS host
  FROM (SELECT page_id, CASE WHEN regexp_matches(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN lower(string_split(
               regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'), '@')[-1]) END AS place FROM pages)),
captures AS (
  SELECT page_id, host, ts AS fetched_at
  FROM p LEFT JOIN events ON event_id = page_id * 7919 % (SELECT count(*) FROM events)),
entries AS (
  SELECT CASE WHEN event_id % 2 = 1 AND array_length(string_split(host, '.')) > 2
              THEN array_to_string(string_split(host, '.')[2:], '.') ELSE host END AS pattern,
         ts AS listed_since, min(event_type = 'error') AS active
  FROM events JOIN p ON page_id = event_id * 31 % (SELECT count(*) FROM pages)
  WHERE event_type IN ('error', 'signup') AND host IS NOT NULL AND ts IS NOT NULL
  GROUP BY 1, 2),
intervals AS (SELECT *, lead(listed_since) OVER (PARTITION BY pattern ORDER BY listed_since) AS till FROM entries),
hosts AS (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL),
named AS (
  SELECT host, pattern FROM hosts JOIN (SELECT DISTINCT pattern FROM entries) e
    ON host = pattern OR ends_with(host, '.' || pattern)),
hits AS (
  SELECT c.page_id, i.pattern, i.listed_since,
         row_number() OVER (PARTITION BY c.page_id ORDER BY length(i.pattern) DESC) AS n
  FROM captures c JOIN named m ON c.host = m.host JOIN intervals i ON i.pattern = m.pattern
    AND i.listed_since <= fetched_at AND coalesce(fetched_at < till, true)
  WHERE active)
SELECT page_id, host, fetched_at, pattern IS NOT NULL AS blocked, pattern, listed_since
FROM captures LEFT JOIN (SELECT page_id, pattern, listed_since FROM hits WHERE n = 1) USING (page_id)"""


@query
def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contextmix.score(read(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = linededup.drop_common_lines(docs)
    return linededup.sha256_of(kept, "text", "kept_sha256").select("doc_id", "n_lines", "n_dropped", "kept_sha256")


ORACLES["op6_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
common AS (
  SELECT k AS gone FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common ON k = gone GROUP BY doc_id"""


@query
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(read(spark, sf_dir, "pages"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), use=crc_mod("doc_id", 5) != 0)
    scored = toxicity.score(docs.withColumn("held_out", crc_mod("doc_id", 5) == 0), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), width=3, errors=3)


@query
def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op11_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(read(spark, sf_dir, "documents"), width=2, percent=80)


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(read(spark, sf_dir, "documents"), damage=97)


@query
def op13_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = partcodes.compress(read(spark, sf_dir, "embeddings"))
    return partcodes.with_label_error(coded).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _part_codes_sql(rounds: int = 4) -> str:
    """Unrolled k-means: d<t> are the codes of round t by full search, b<t> the codebooks they are made with."""
    steps = ["""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (
  SELECT vec_id, label, p, list_slice(v, CAST(p * len(v) // 4 + 1 AS BIGINT), CAST((p + 1) * len(v) // 4 AS BIGINT)) AS part
  FROM kept, range(4) r(p)),
b0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS entry, part
  FROM cut WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256))"""]
    for t in range(rounds + 1):
        steps.append(f"""d{t} AS (
  SELECT vec_id, p, min(struct_pack(dist := dist, entry := entry)) AS best
  FROM (SELECT c.vec_id, c.p, entry, list_sum(list_transform(list_zip(c.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist
        FROM cut c JOIN b{t} b ON c.p = b.p) GROUP BY vec_id, p)""")
        if t < rounds:
            steps.append(f"""m{t} AS (
  SELECT p, entry, list(mean ORDER BY i) AS part FROM (
    SELECT p, entry, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS mean
    FROM (SELECT cut.p, best.entry AS entry, generate_subscripts(part, 1) AS i, unnest(part) AS x
          FROM cut JOIN d{t} ON cut.vec_id = d{t}.vec_id AND cut.p = d{t}.p) GROUP BY p, entry, i) GROUP BY p, entry),
b{t + 1} AS (
  SELECT b.p, b.entry, coalesce(m.part, b.part) AS part
  FROM b{t} b LEFT JOIN m{t} m ON b.p = m.p AND b.entry = m.entry)""")
    return ",\n".join(steps) + f""",
coded AS (
  SELECT kept.vec_id, any_value(label) AS label, string_agg(printf('%02x', best.entry), '' ORDER BY p) AS code,
         CAST(sum(best.dist) AS BIGINT) AS error
  FROM kept JOIN d{rounds} USING (vec_id) GROUP BY kept.vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, entry)) FROM b{rounds}) AS codebooks_sha256
FROM coded"""


ORACLES["op13_part_codes"] = _part_codes_sql()
