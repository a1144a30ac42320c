"""Key, default and coercion columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions import columns as C
from clipcatalog.queries import duck as d
from clipcatalog.queries.registry import Inputs, query


@query("default_blank", f"""
SELECT raw_id, coalesce(nullif(trim(platform), ''), 'tiktok') AS platform,
  CASE WHEN {d.strip('creator_username')} <> '' THEN creator_username ELSE 'unknown' END AS shown_creator,
  coalesce(nullif(trim(recovered_text), ''), 'none') AS recovered FROM captions_fx""")
def _(t: Inputs):
    return t.fx("captions_fx").select(
        "raw_id", C.default_blank("platform", "tiktok").alias("platform"),
        C.default_blank("creator_username", "unknown", keep=True).alias("shown_creator"),
        C.default_blank("recovered_text", "none").alias("recovered"))


@query("clamp01", f"""
SELECT raw_id, processed_at, {d.clamp('caption_completeness_score')} AS completeness,
  {d.clamp('final_recipe_confidence')} AS confidence FROM silver_fx""")
def _(t: Inputs):
    return t.fx("silver_fx").select(
        "raw_id", "processed_at", C.clamp01("caption_completeness_score").alias("completeness"),
        C.clamp01("final_recipe_confidence").alias("confidence"))


_ANSWER = " ".join(f"WHEN lower(trim(recipe_language)) = '{k}' THEN '{v}'" for k, v in vocab.ANSWER_LANGUAGE_ALIASES.items())


@query("normalize_language_code", f"""
SELECT raw_id, processed_at, {d.staging_language('recipe_language')} AS language,
  coalesce({d.staging_language('final_recipe_language', 'NULL')}, {d.staging_language('recipe_language')}) AS final_language,
  CASE {_ANSWER} WHEN lower(trim(recipe_language)) IN {d.in_list(vocab.LANGUAGE_CODES)} THEN lower(trim(recipe_language))
    ELSE 'unknown' END AS answer_language FROM silver_fx""")
def _(t: Inputs):
    language = C.normalize_language_code("recipe_language")
    return t.fx("silver_fx").select(
        "raw_id", "processed_at", language.alias("language"),
        F.coalesce(C.normalize_language_code("final_recipe_language", other=None), language).alias("final_language"),
        C.normalize_language_code("recipe_language", vocab.ANSWER_LANGUAGE_ALIASES, trim=True).alias("answer_language"))


@query("content_key", f"""
SELECT raw_id, {d.content_key('content_id', 'url')} AS content_key,
  coalesce(nullif(regexp_extract(url, 'video/([0-9]+)', 1), ''), nullif(url, ''), CAST(raw_id AS VARCHAR)) AS scoring_key
FROM captions_fx""")
def _(t: Inputs):
    return t.fx("captions_fx").select(
        "raw_id", C.content_key("content_id", "url").alias("content_key"),
        C.scoring_key("url", "raw_id").alias("scoring_key"))


@query("video_id_from_url", f"""
WITH u AS (SELECT raw_id, url, CASE raw_id % 3 WHEN 0 THEN 'https://x.example.com/clip/' || raw_id || '?a=1' ELSE url END AS link FROM captions_fx)
SELECT raw_id, {d.video_id('link')} AS video_id,
  coalesce({d.path_id('link')}, string_split(rtrim(link, '/'), '/')[-1]) AS seed_id,
  coalesce(nullif(regexp_extract(link, 'tiktok\\.com/@([^/]+)/', 1), ''), 'unknown_creator') AS creator FROM u""")
def _(t: Inputs):
    link = F.when(F.col("raw_id") % 3 == 0, F.concat(F.lit("https://x.example.com/clip/"), "raw_id", F.lit("?a=1"))).otherwise(
        F.col("url"))
    return t.fx("captions_fx").select("raw_id", link.alias("link")).select(
        "raw_id", C.video_id_from_url("link").alias("video_id"), C.seed_content_id("link").alias("seed_id"),
        C.creator_from_url("link").alias("creator"))


@query("record_hash", f"""
SELECT raw_id,
  sha256(coalesce(platform, 'tiktok') || '|' || coalesce({d.content_key('content_id', 'url')}, '') || '|' || coalesce(description, '') || '|' || coalesce(title, '') || '|' || coalesce(url, '')) AS batch_hash,
  sha256({d.strip("coalesce(content_id, '')")} || '|' || {d.strip("coalesce(url, '')")}) AS event_hash,
  sha256({d.strip("coalesce(title, '')")} || '|' || {d.strip("coalesce(description, '')")} || '|' || {d.strip("coalesce(url, '')")}) AS legacy_hash,
  sha256(raw_id || '|ocr|' || {d.strip("coalesce(recovered_text, '')")}) AS attempt_hash FROM captions_fx""")
def _(t: Inputs):
    return t.fx("captions_fx").select(
        "raw_id",
        C.batch_hash("platform", C.content_key("content_id", "url"), "description", "title", "url").alias("batch_hash"),
        C.event_hash("content_id", "url").alias("event_hash"),
        C.legacy_event_hash("title", "description", "url").alias("legacy_hash"),
        C.attempt_hash("raw_id", F.lit("ocr"), "recovered_text").alias("attempt_hash"))


@query("build_payload", """
SELECT raw_id, CAST(to_json({'platform': platform, 'content_id': content_id, 'description_is_partial': description_is_partial,
  'evidence_text': evidence_text}) AS VARCHAR) AS payload FROM captions_fx""")
def _(t: Inputs):
    names = ("platform", "content_id", "description_is_partial", "evidence_text")
    return t.fx("captions_fx").select("raw_id", C.build_payload({n: n for n in names}).alias("payload"))


@query("try_boolean", f"""
SELECT raw_id, CASE WHEN lower(trim(x)) IN {d.in_list(vocab.WAREHOUSE_TRUE)} THEN true
  WHEN lower(trim(x)) IN {d.in_list(vocab.WAREHOUSE_FALSE)} THEN false END AS flag
FROM (SELECT raw_id, CASE raw_id % 5 WHEN 0 THEN ' ON ' WHEN 1 THEN 'Off' WHEN 2 THEN NULL ELSE description_enriched END AS x FROM captions_fx)""")
def _(t: Inputs):
    x = (F.when(F.col("raw_id") % 5 == 0, " ON ").when(F.col("raw_id") % 5 == 1, "Off")
         .when(F.col("raw_id") % 5 == 2, F.lit(None)).otherwise(F.col("description_enriched")))
    return t.fx("captions_fx").select("raw_id", C.try_boolean(x).alias("flag"))


@query("safe_numeric_and_time", """
SELECT event_id, coalesce(try_cast(CASE event_id % 4 WHEN 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE), 0.0) AS amount,
  try_cast(CASE event_id % 4 WHEN 1 THEN 'x1.5' WHEN 2 THEN '12' ELSE NULL END AS DOUBLE) AS ratio,
  try_cast(CASE event_id % 3 WHEN 0 THEN 'never' ELSE '2024-01-0' || (event_id % 9 + 1) || ' 10:00:00' END AS TIMESTAMP) AS seen_at,
  coalesce(CASE event_id % 5 WHEN 0 THEN NULL ELSE event_type END, 'unknown') AS kind FROM events""")
def _(t: Inputs):
    e = F.col("event_id")
    raw = t.table("events").select(
        "event_id",
        F.when(e % 4 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(e % 4 == 1, "x1.5").when(e % 4 == 2, "12").alias("ratio"),
        F.when(e % 3 == 0, "never").otherwise(F.concat(F.lit("2024-01-0"), e % 9 + 1, F.lit(" 10:00:00"))).alias("seen_at"),
        F.when(e % 5 != 0, F.col("event_type")).alias("kind"))
    return C.safe_numeric_and_time(raw, {"amount": 0.0, "ratio": None}, ["seen_at"], {"kind": "unknown"})


@query("upper_columns", "SELECT doc_id AS DOC_ID, lang AS LANG, source AS SOURCE FROM documents")
def _(t: Inputs):
    return C.upper_columns(t.table("documents").select("doc_id", "lang", "source"))
