"""Inputs derived from the given tables, one SQL text for both engines.

Texts are used whole and keys grow with the tables, so the work of every query
grows with its input.  ``{ts}`` is the zone-less timestamp literal of the engine.
"""

from __future__ import annotations

import re

FIXTURES: dict[str, str] = {}

FIXTURES["captions_fx"] = r"""
SELECT doc_id AS raw_id,
  CASE doc_id % 11 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'instagram' ELSE 'tiktok' END AS platform,
  CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(CAST(floor(doc_id / 8) AS BIGINT) AS STRING) END AS content_id,
  CASE WHEN doc_id % 13 = 0 THEN NULL ELSE source END AS creator_username,
  substr(text, 1, 120) AS title,
  CASE doc_id % 8
    WHEN 0 THEN 'Recipe: mix 2 cups flour and 1/2 tsp salt, bake at 350 F. #easyrecipe '
    WHEN 1 THEN 'Receta con pollo y 200 g azucar. '
    WHEN 2 THEN 'Ricetta: burro, farina. #ricettefacili '
    WHEN 3 THEN '!!! 12345 67890 ### '
    WHEN 4 THEN concat('Full recipe https://cook.example.com/r/', CAST(doc_id AS STRING), ', see https://www.tiktok.com/@a/video/9. ')
    ELSE '' END || text AS description,
  CASE WHEN doc_id % 17 = 0 THEN concat('https://youtu.be/x', CAST(CAST(floor(doc_id / 34) AS BIGINT) AS STRING))
       ELSE concat('https://www.tiktok.com/@', source, '/video/', CAST(CAST(floor(doc_id / 8) AS BIGINT) AS STRING)) END AS url,
  doc_id % 5 = 0 AS description_is_partial,
  CASE doc_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'no' ELSE 'maybe' END AS description_enriched,
  CASE WHEN doc_id % 6 = 0 THEN NULL ELSE text END AS evidence_text,
  CASE WHEN doc_id % 7 = 0 THEN text ELSE '' END AS recovered_text,
  concat('file_', CAST(doc_id % 3 AS STRING), '.csv') AS source_file,
  {ts} '2024-01-01 00:00:00' + (doc_id * 7919 % 100000) * INTERVAL '1' MINUTE AS ingested_at
FROM documents
"""

FIXTURES["silver_fx"] = r"""
SELECT CAST(floor(d.doc_id / 2) AS BIGINT) AS raw_id, substr(d.text, 1, 120) AS original_title,
  d.text AS original_description,
  CASE WHEN d.doc_id % 4 = 0 THEN d.text ELSE '' END AS recovered_text,
  d.text AS evidence_text,
  CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE CAST(d.doc_id % 8 AS DOUBLE) / 10 END AS evidence_quality_score,
  concat('https://www.tiktok.com/@', d.source, '/video/', CAST(CAST(floor(d.doc_id / 6) AS BIGINT) AS STRING)) AS url_tiktok,
  CASE d.doc_id % 9 WHEN 0 THEN 'English' WHEN 1 THEN 'francais' WHEN 2 THEN 'ESPANOL' WHEN 3 THEN NULL ELSE d.lang END AS recipe_language,
  CASE d.doc_id % 5 WHEN 0 THEN 'italiano' WHEN 1 THEN 'de' WHEN 2 THEN NULL ELSE 'PT' END AS final_recipe_language,
  CASE d.doc_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END AS is_vegetarian,
  CASE d.doc_id % 7 WHEN 0 THEN 'italian' WHEN 1 THEN 'south indian' WHEN 2 THEN 'unknown' WHEN 3 THEN NULL WHEN 4 THEN '' ELSE 'thai' END AS cuisine_style,
  CASE d.doc_id % 5 WHEN 0 THEN 'chicken' WHEN 1 THEN 'rice' WHEN 2 THEN NULL ELSE 'egg noodles' END AS main_ingredient,
  CASE d.doc_id % 4 WHEN 0 THEN '["flour","egg","milk"]' WHEN 1 THEN '["rice"]' WHEN 2 THEN NULL ELSE '["salt","oil"]' END AS ingredients,
  CASE l.quality WHEN 1 THEN TRUE WHEN 0 THEN FALSE ELSE NULL END AS is_recipe,
  CASE d.doc_id % 6 WHEN 0 THEN 'full_recipe' WHEN 1 THEN 'full_recipe' WHEN 2 THEN 'partial_recipe' WHEN 3 THEN 'food_content' WHEN 4 THEN NULL ELSE 'non_recipe' END AS recipe_status,
  CASE WHEN d.doc_id % 6 = 5 THEN 'no recipe' ELSE NULL END AS rejection_reason,
  d.doc_id % 5 <> 0 AS has_ingredient_list, CASE WHEN d.doc_id % 10 = 9 THEN NULL ELSE d.doc_id % 3 <> 1 END AS has_instructions,
  CAST(d.doc_id % 13 AS DOUBLE) / 10 - CAST(0.1 AS DOUBLE) AS caption_completeness_score,
  CASE WHEN d.doc_id % 19 = 0 THEN NULL ELSE CAST(d.doc_id % 11 AS DOUBLE) / 10 END AS final_recipe_confidence,
  CAST(d.doc_id % 10 AS DOUBLE) / 9 AS processing_confidence,
  CASE d.doc_id % 4 WHEN 0 THEN '{"title":"t","steps":["a","b"]}' WHEN 1 THEN '{"steps":["a"]}' WHEN 2 THEN NULL ELSE '{"steps":["x","y","z"]}' END AS final_recipe_json,
  CASE d.doc_id % 3 WHEN 0 THEN '["time"]' WHEN 1 THEN '[]' ELSE NULL END AS missing_recipe_info,
  CASE WHEN d.doc_id % 8 = 0 THEN '' ELSE split_part(d.text, '.', 1) END AS final_recipe_title,
  CASE WHEN d.doc_id % 14 = 0 THEN ' ' ELSE d.text END AS final_recipe_text,
  concat('model-', CAST(d.doc_id % 3 AS STRING)) AS model_name,
  {ts} '2024-02-01 00:00:00' + (d.doc_id * 7919 % 100003) * INTERVAL '1' MINUTE AS processed_at,
  md5(d.text) AS record_hash
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

FIXTURES["evidence_fx"] = r"""
SELECT conv_id * 1000 + turn AS evidence_id, conv_id AS raw_id,
  CAST(conv_id AS STRING) AS content_id,
  concat('https://www.tiktok.com/@u/video/', CAST(conv_id AS STRING)) AS url,
  CASE turn % 4 WHEN 0 THEN 'VIDEO_OCR' WHEN 1 THEN 'audio_transcript' WHEN 2 THEN 'Comments' ELSE 'web_metadata' END AS source_type,
  text AS evidence_text,
  CASE WHEN turn % 5 = 0 THEN NULL ELSE CAST(length(text) AS BIGINT) END AS evidence_length,
  CAST((conv_id * 7 + turn * 13) % 14 AS DOUBLE) / 10 - CAST(0.1 AS DOUBLE) AS evidence_quality_score,
  CASE WHEN turn % 3 = 0 THEN NULL ELSE turn % 3 = 1 END AS is_recipe_signal,
  md5(concat(role, CAST(turn % 2 AS STRING))) AS record_hash,
  {ts} '2024-03-01 00:00:00' + (conv_id * 60 + turn) * INTERVAL '1' MINUTE AS created_at
FROM conversations
"""

FIXTURES["attempts_fx"] = r"""
SELECT conv_id * 1000 + turn AS attempt_id, conv_id AS raw_id,
  CASE turn % 5 WHEN 0 THEN 'web_caption' WHEN 1 THEN 'audio_transcript' WHEN 2 THEN 'ocr' WHEN 3 THEN 'external_url' ELSE 'comments' END AS method,
  CASE (conv_id + turn) % 5 WHEN 0 THEN 'attempted_failed' WHEN 1 THEN 'attempted_empty' WHEN 2 THEN 'rejected_gibberish' WHEN 3 THEN 'technical_success' ELSE 'usable_recipe_text' END AS status,
  CAST((conv_id * 5 + turn * 3) % 10 AS DOUBLE) / 10 AS score,
  {ts} '2024-03-01 00:00:00' + (conv_id * 60 + turn) * INTERVAL '1' MINUTE AS created_at
FROM conversations
"""

FIXTURES["recovered_fx"] = r"""
SELECT conv_id * 1000 + turn AS attempt_id, conv_id AS raw_id, CAST(conv_id AS STRING) AS content_id,
  concat('https://www.tiktok.com/@u/video/', CAST(conv_id AS STRING)) AS url,
  CASE conv_id % 3 WHEN 0 THEN '@FitWaffle' WHEN 1 THEN 'kiwilimon' ELSE 'someone' END AS creator_username,
  CASE turn % 5 WHEN 0 THEN 'web_caption' WHEN 1 THEN 'audio_transcript' WHEN 2 THEN 'ocr' WHEN 3 THEN 'external_url' ELSE 'comments' END AS method,
  CASE (conv_id + turn) % 7 WHEN 0 THEN 'attempted_failed' WHEN 1 THEN 'attempted_empty' ELSE 'attempted_success' END AS status,
  CASE (conv_id + turn) % 7 WHEN 0 THEN '' WHEN 1 THEN NULL
    WHEN 2 THEN concat('Recipe: 2 cups flour and butter, mix and bake. ', text)
    WHEN 3 THEN '!!! 123 ### 456 %%% 789 ((( 1010 ))) 1112 1314 1516'
    WHEN 4 THEN concat('Ingredients: 200 g sugar, 3 eggs. Cook for 10 min. ', text)
    WHEN 5 THEN concat('Receta con pollo ', text) ELSE text END AS text,
  CAST((conv_id + turn) % 6 AS DOUBLE) / 10 AS confidence,
  CASE (conv_id + turn) % 7 WHEN 0 THEN 'timeout' ELSE NULL END AS error,
  CASE turn % 2 WHEN 0 THEN 'engine-a' ELSE '' END AS engine,
  CASE turn % 3 WHEN 0 THEN concat('{"urls":["u', CAST(conv_id AS STRING), '"],"pages":', CAST(turn AS STRING), ',"ok":true}') END AS details,
  {ts} '2024-03-01 00:00:00' + (conv_id * 60 + turn) * INTERVAL '1' MINUTE AS created_at
FROM conversations
"""

FIXTURES["llm_fx"] = r"""
SELECT doc_id AS raw_id,
  CASE doc_id % 7
   WHEN 0 THEN '{"lang":"English","is_veg":"yes","cuisine":" Thai ","ingredient":"Rice","ingredients":["Rice","rice","unknown",""],"recipe_status":"Full Recipe","caption_completeness_score":"0.8"}'
   WHEN 1 THEN '[{"lang":"fr","is_veg":true,"cuisine":"french","ingredient":"mushroom"}]'
   WHEN 2 THEN '{"recipe_language":"es","is_vegetarian":false,"cuisine_style":"mexican","main_ingredient":"pollo","missing_info":"time; oven, salt"}'
   WHEN 3 THEN 'Sure! {"lang":null,"is_recipe":"no","caption_completeness_score":7,"final_recipe_title":"x"} done'
   WHEN 4 THEN '{"lang":"ar","has_instructions":"unknown","completeness":0.7,"final_recipe_json":{"title":"T","steps":["a"]}}'
   WHEN 5 THEN concat('{"lang":"italiano","ingredients":"Burro, farina|sale","status":"partial-recipe","recipe_title":" Torta ', CAST(doc_id AS STRING), ' ","recipe_text":"', replace(replace(replace(text, '\', ' '), '"', ' '), chr(10), ' '), '","is_recipe":1}')
   ELSE 'not json' END AS response
FROM documents
"""

FIXTURES["pages_fx"] = r"""
SELECT page_id, url, concat(
  CASE page_id % 4
    WHEN 0 THEN concat('<meta property="og:description" content="Easy &amp; quick recipe number ', CAST(page_id AS STRING), ' with flour and butter, bake well">')
    WHEN 1 THEN concat('<meta content=''Watch the latest videos ', CAST(page_id AS STRING), ' and log in'' name=''description''>')
    WHEN 2 THEN '<META name="description" content="short">' ELSE '' END,
  CASE page_id % 3
    WHEN 0 THEN concat('<script id="SIGI_STATE" type="application/json">{"id":"', CAST(page_id AS STRING), '","desc":"Chicken and rice recipe, cook slowly for one hour","x":[{"title":"t"}]}</script>')
    WHEN 1 THEN '<script id="SIGI_STATE" type="application/json">{bad</script>' ELSE '' END, html) AS html
FROM pages
"""

FIXTURES["comments_fx"] = r"""
SELECT conv_id AS item_id, turn AS ordinal,
  CASE turn % 3 WHEN 0 THEN concat('Ingredients please? ', text) WHEN 1 THEN text ELSE '' END AS comment_text,
  CAST(conv_id % 10 AS DOUBLE) / 10 AS probability
FROM conversations
"""

FIXTURES["event_json_fx"] = r"""
SELECT event_id, ts, CASE event_id % 5
  WHEN 0 THEN concat('{"video_id":"', CAST(user_id AS STRING), '","url":"https://www.tiktok.com/@u/video/', CAST(user_id AS STRING), '","title":"', event_type, '"}')
  WHEN 1 THEN concat('{"content_id":" ', CAST(user_id AS STRING), ' ","url_tiktok":"https://www.tiktok.com/@u/video/', CAST(user_id AS STRING), '","creator_username":"c', CAST(user_id % 9 AS STRING), '","description_is_partial":true,"raw_payload":', props, '}')
  WHEN 2 THEN concat('{"content_id":"', CAST(user_id AS STRING), '","platform":""}')
  WHEN 3 THEN '{broken'
  ELSE concat('{"content_id":"', CAST(user_id AS STRING), '","url":"https://www.tiktok.com/@u/video/', CAST(user_id AS STRING), '","platform":"instagram","description":"d', CAST(event_id AS STRING), '"}') END AS value
FROM events
"""

FIXTURES["legacy_event_fx"] = r"""
SELECT event_id, CASE event_id % 4
  WHEN 0 THEN concat('{"TITLE":" ', event_type, ' ","DESCRIPTION":"d', CAST(user_id AS STRING), '","URL_TIKTOK":"https://www.tiktok.com/@u/video/', CAST(user_id AS STRING), '","SOURCE_FILE":"demo"}')
  WHEN 1 THEN concat('{"TITLE":"', event_type, '","URL_TIKTOK":"https://www.tiktok.com/@u/video/', CAST(user_id AS STRING), '","SOURCE_FILE":" "}')
  WHEN 2 THEN '{"TITLE":"no url"}'
  ELSE concat('{"TITLE":" ","URL_TIKTOK":"u', CAST(user_id AS STRING), '"}') END AS value
FROM events
"""

FIXTURES["raw_item_fx"] = r"""
SELECT event_id, CASE event_id % 4
  WHEN 0 THEN concat('{"id":"', CAST(event_id AS STRING), '","desc":"Easy recipe with rice","createTime":', CAST(1700000000 + event_id AS STRING), ',"author":{"uniqueId":"u', CAST(user_id AS STRING), '"}}')
  WHEN 1 THEN concat('{"id":', CAST(event_id AS STRING), ',"desc":"#foodtok dinner","author":{"nickname":"n', CAST(user_id AS STRING), '"}}')
  WHEN 2 THEN concat('{"id":"', CAST(event_id AS STRING), '","desc":"holiday pictures"}')
  ELSE '{"id":"","desc":"recipe"}' END AS item
FROM events
"""

FIXTURES["scan_state_fx"] = r"""
SELECT CAST(user_id AS STRING) AS creator,
  CASE max(event_id) % 3 WHEN 0 THEN 'failed' ELSE 'completed' END AS status,
  CASE max(event_id) % 5 WHEN 0 THEN 'not a time' WHEN 1 THEN NULL ELSE concat('2024-01-', CASE WHEN max(event_id) % 2 = 0 THEN '09' ELSE '10' END, 'T', CASE WHEN user_id % 2 = 0 THEN '06' ELSE '18' END, ':00:00Z') END AS completed_at,
  count(*) AS scanned
FROM events GROUP BY user_id
"""

FIXTURES["ingredients_fx"] = r"""
SELECT doc_id AS raw_id,
  CASE doc_id % 8
   WHEN 0 THEN '["2 cups flour","Flour","{\"name\":\"egg\",\"quantity\":3}","egg","salt"]'
   WHEN 1 THEN '[{"name":"rice","quantity":200,"unit":"g","notes":"washed"},{"ingredient":"oil"},"rice",null]'
   WHEN 2 THEN concat('flour, sugar , ', source)
   WHEN 3 THEN concat(' - butter', chr(10), '- 2 eggs', chr(10), 'eggs', chr(10))
   WHEN 4 THEN '{"items":["tomato","3 tomato","basil (fresh)"]}'
   WHEN 5 THEN 'unknown'
   WHEN 6 THEN '{"name":"milk","quantity":"1","unit":"l"}'
   ELSE NULL END AS ingredients,
  concat('# ', source, chr(10), '**Ingredients:**', chr(10), '- 2 eggs', chr(10), chr(10), '* **Mix** well', chr(10), 'Steps:', chr(10), text) AS recipe_text,
  source AS title
FROM documents
"""

FIXTURES["candidates_fx"] = r"""
SELECT CAST(floor(doc_id / 4) AS BIGINT) AS item_id, doc_id AS ordinal, text AS candidate,
  CASE CAST(floor(doc_id / 4) AS BIGINT) % 3 WHEN 0 THEN '' WHEN 1 THEN 'short caption' ELSE NULL END AS existing,
  concat('https://site.example.com/', CAST(doc_id AS STRING)) AS url
FROM documents
"""

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def used_tables(sql: str) -> list[str]:
    return [t for t in BASE_TABLES if re.search(rf"\b(?:FROM|JOIN)\s+{t}\b", sql, re.I)]


def spark_text(name: str) -> str:
    # Spark string literals treat a backslash as an escape; DuckDB ones do not.
    return FIXTURES[name].replace("{ts}", "TIMESTAMP_NTZ").replace("\\", "\\\\")


def duckdb_text(name: str) -> str:
    return FIXTURES[name].replace("{ts}", "TIMESTAMP")
