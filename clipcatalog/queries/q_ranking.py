"""Best row per key, ranked lists, ordered batches and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions.columns import content_key, default_blank, try_boolean
from clipcatalog.operators import ranking as W
from clipcatalog.queries import built
from clipcatalog.queries import duck as d
from clipcatalog.queries.q_joins import at
from clipcatalog.queries.registry import Inputs, query
from clipcatalog.sources.files import distinct_urls


@query("latest_per_key", "SELECT raw_id, recipe_language, is_recipe, cuisine_style, recipe_status, processed_at FROM stg_recipes")
def _(t: Inputs):
    return built.recipes(t).select("raw_id", "recipe_language", "is_recipe", "cuisine_style", "recipe_status", "processed_at")


@query("latest_per_key_orders", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def _(t: Inputs):
    return W.latest_per_key(t.table("orders"), ["o_custkey"], "o_orderdate", [F.col("o_orderkey").desc()]).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query("dedup_evidence", "SELECT evidence_id, raw_id, source_type, evidence_text, evidence_length, evidence_quality_score, evidence_quality_class, is_recipe_signal FROM stg_evidence")
def _(t: Inputs):
    return built.evidence(t).select("evidence_id", "raw_id", "source_type", "evidence_text", "evidence_length",
                                    "evidence_quality_score", "evidence_quality_class", "is_recipe_signal")


@query("rank_evidence", """
SELECT evidence_id, raw_id, row_number() OVER (PARTITION BY raw_id ORDER BY evidence_quality_score DESC, evidence_length DESC,
  created_at DESC, evidence_id DESC) AS evidence_rank FROM stg_evidence WHERE evidence_length > 0""")
def _(t: Inputs):
    return W.rank_evidence(built.evidence(t)).select("evidence_id", "raw_id", "evidence_rank")


@query("best_row_per_key", "SELECT content_key, raw_id, recipe_quality_score, recipe_status, display_title FROM gold_catalog")
def _(t: Inputs):
    return built.gold(t).select("content_key", "raw_id", "recipe_quality_score", "recipe_status", "display_title")


@query("best_source_row", f"""
SELECT raw_id, platform, content_key FROM (SELECT raw_id, coalesce(nullif(trim(platform), ''), 'tiktok') AS platform,
  {d.content_key('content_id', 'url')} AS content_key, evidence_text, description, description_enriched, source_file FROM captions_fx)
WHERE content_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY platform, content_key ORDER BY length(coalesce(evidence_text, '')) DESC,
  length(coalesce(description, '')) DESC, CASE WHEN lower(trim(description_enriched)) IN {d.in_list(vocab.WAREHOUSE_TRUE)} THEN 1 ELSE 0 END DESC,
  source_file DESC, raw_id DESC) = 1""")
def _(t: Inputs):
    rows = t.fx("captions_fx").withColumns({
        "platform": default_blank("platform", "tiktok"), "content_key": content_key("content_id", "url")}).filter(
        "content_key IS NOT NULL")
    enriched = F.coalesce(try_boolean("description_enriched"), F.lit(False))
    return W.best_source_row(rows, ["platform", "content_key"], enriched, "raw_id").select("raw_id", "platform", "content_key")


@query("latest_attempt_per_method", """
SELECT raw_id, method, status, attempt_id FROM attempts_fx WHERE created_at >= TIMESTAMP '2024-03-03 00:00:00' - INTERVAL 36 HOUR
QUALIFY row_number() OVER (PARTITION BY raw_id, method ORDER BY created_at DESC, attempt_id DESC) = 1""")
def _(t: Inputs):
    newest = [F.col("attempt_id").desc()]
    return W.latest_attempt_per_method(t.fx("attempts_fx"), at("2024-03-03 00:00:00"), 36, newest).select(
        "raw_id", "method", "status", "attempt_id")


@query("first_seen_dedupe", """
SELECT url, raw_id FROM captions_fx QUALIFY row_number() OVER (PARTITION BY url ORDER BY ingested_at, raw_id) = 1""")
def _(t: Inputs):
    return W.first_seen_dedupe(t.fx("captions_fx"), "url", ["ingested_at", "raw_id"]).select("url", "raw_id")


@query("oldest_first_batch", "SELECT raw_id, ingested_at FROM captions_fx ORDER BY ingested_at NULLS LAST, raw_id LIMIT 100")
def _(t: Inputs):
    return W.oldest_first_batch(t.fx("captions_fx"), 100).select("raw_id", "ingested_at")


_STATE = """
s AS (SELECT creator, coalesce(status = 'completed' AND (TIMESTAMP '2024-01-10 12:00:00' - try_cast(replace(replace(completed_at, 'T', ' '), 'Z', '') AS TIMESTAMP)) < INTERVAL 20 HOUR, false) AS recent,
  coalesce(completed_at, '') AS completed_at FROM scan_state_fx)"""


@query("resume_order", f"""
WITH {_STATE}, c AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS creator FROM events UNION SELECT 'new_' || source FROM documents)
SELECT c.creator, coalesce(s.recent, false) AS recent, coalesce(s.completed_at, '') AS completed_at FROM c LEFT JOIN s ON c.creator = s.creator""")
def _(t: Inputs):
    creators = t.table("events").select(F.col("user_id").cast("string").alias("creator")).unionAll(
        t.table("documents").select(F.concat(F.lit("new_"), "source").alias("creator")))
    now = F.lit("2024-01-10T12:00:00+00:00").cast("timestamp")
    return W.resume_order(creators, t.fx("scan_state_fx"), now, 20)


@query("top_comments", f"""
WITH c AS (SELECT item_id, ordinal, {d.caption('comment_text')} AS x FROM comments_fx), n AS (SELECT * FROM c WHERE x <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY {d.comment_signal('x')} DESC, length(x) DESC, ordinal) AS rn FROM n),
j AS (SELECT item_id, string_agg('- ' || x, chr(10) ORDER BY rn) AS comment_text, count(*) AS comments_used FROM r WHERE rn <= 8 GROUP BY item_id)
SELECT j.*, (SELECT count(*) FROM n WHERE n.item_id = j.item_id) AS comments_scanned,
  CASE WHEN {d.comment_signal('comment_text')} THEN 0.65 ELSE 0.35 END::DOUBLE AS confidence FROM j""")
def _(t: Inputs):
    return W.top_comments(t.fx("comments_fx"))


@query("best_caption", f"""
WITH c AS (SELECT item_id, ordinal, coalesce(existing, '') AS existing, {d.caption('candidate')} AS x FROM candidates_fx)
SELECT item_id, x AS caption, 'web_metadata' AS source FROM c
WHERE x <> '' AND NOT {d.any_of('lower(x)', vocab.CAPTION_BOILERPLATE)} AND NOT (existing <> '' AND x = existing) AND length(x) >= greatest(40, length(existing) + 15)
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY {d.signal('x')} DESC, length(x) DESC, ordinal) = 1""")
def _(t: Inputs):
    return W.best_caption(t.fx("candidates_fx"), "item_id", "ordinal")


@query("longest_page", f"""
WITH f AS (SELECT * FROM candidates_fx QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY ordinal) <= 3)
SELECT item_id, url AS best_url, substr(candidate, 1, 8000) AS best_text, CASE WHEN {d.signal('candidate')} THEN 0.75 ELSE 0.45 END::DOUBLE AS confidence
FROM f WHERE coalesce(candidate, '') <> '' QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY length(candidate) DESC, ordinal) = 1""")
def _(t: Inputs):
    return W.longest_page(t.fx("candidates_fx"), "item_id", "ordinal", text="candidate")


@query("concat_sources", """
SELECT url, raw_id, source_no FROM (SELECT url, raw_id, 0 AS source_no FROM captions_fx WHERE description_is_partial
  UNION ALL SELECT url_tiktok, raw_id, 1 FROM stg_recipes UNION ALL SELECT url, raw_id, 2 FROM captions_fx WHERE NOT description_is_partial)
QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_no, raw_id) = 1""")
def _(t: Inputs):
    fx = t.fx("captions_fx").select("url", "raw_id", "description_is_partial")
    seeds = built.recipes(t).select(F.col("url_tiktok").alias("url"), "raw_id")
    rows = W.concat_sources(
        fx.filter("description_is_partial").drop("description_is_partial"), seeds,
        fx.filter("NOT description_is_partial").drop("description_is_partial"))
    return W.first_seen_dedupe(rows, "url", ["source_no", "raw_id"]).select("url", "raw_id", "source_no")


@query("distinct_urls", "SELECT DISTINCT url FROM captions_fx WHERE coalesce(url, '') <> '' AND contains(url, 'tiktok.com')")
def _(t: Inputs):
    return distinct_urls(t.fx("captions_fx"), "url", "tiktok.com")
