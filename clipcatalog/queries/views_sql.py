"""The staged views once more, as checking SQL."""

from clipcatalog.queries import duck as d

VIEWS: dict[str, str] = {}

VIEWS["stg_recipes"] = f"""
SELECT * FROM (
  SELECT raw_id, original_title, original_description, recovered_text, evidence_text,
    coalesce(evidence_quality_score, 0.0) AS evidence_quality_score, url_tiktok,
    {d.staging_language('recipe_language')} AS recipe_language,
    is_vegetarian, {d.title_case('cuisine_style')} AS cuisine_style, {d.title_case('main_ingredient')} AS main_ingredient,
    ingredients, coalesce(is_recipe, true) AS is_recipe, coalesce(recipe_status, 'partial_recipe') AS recipe_status,
    coalesce(has_ingredient_list, false) AS has_ingredient_list, coalesce(has_instructions, false) AS has_instructions,
    {d.clamp('caption_completeness_score')} AS caption_completeness_score, rejection_reason,
    final_recipe_title, final_recipe_text, final_recipe_json, missing_recipe_info,
    {d.clamp('final_recipe_confidence')} AS final_recipe_confidence,
    coalesce({d.staging_language('final_recipe_language', 'NULL')}, {d.staging_language('recipe_language')}) AS final_recipe_language,
    {d.clamp('processing_confidence')} AS processing_confidence, model_name, processed_at, record_hash
  FROM silver_fx
  QUALIFY row_number() OVER (PARTITION BY raw_id ORDER BY processed_at DESC, record_hash) = 1
)
"""

VIEWS["stg_evidence"] = f"""
SELECT evidence_id, raw_id, content_id, url, lower(source_type) AS source_type, evidence_text,
  coalesce(evidence_length, length(evidence_text)) AS evidence_length,
  {d.clamp('evidence_quality_score')} AS evidence_quality_score, 'unknown' AS evidence_quality_class,
  coalesce(is_recipe_signal, false) AS is_recipe_signal, record_hash, created_at
FROM evidence_fx
QUALIFY row_number() OVER (PARTITION BY raw_id, lower(source_type), record_hash ORDER BY created_at DESC, evidence_id DESC) = 1
"""

VIEWS["int_evidence"] = """
SELECT raw_id, max(evidence_quality_score) AS best_evidence_quality_score,
  avg(evidence_quality_score) AS avg_evidence_quality_score, count(*) AS evidence_source_count,
  count(*) FILTER (source_type = 'video_ocr') AS ocr_source_count,
  count(*) FILTER (source_type = 'audio_transcript') AS audio_source_count,
  count(*) FILTER (source_type = 'comments') AS comment_source_count,
  count(*) FILTER (is_recipe_signal) AS recipe_signal_count,
  string_agg(CASE WHEN rnk <= 5 THEN evidence_text END, E'\\n\\n---\\n\\n' ORDER BY rnk) AS best_evidence_text
FROM (
  SELECT *, row_number() OVER (PARTITION BY raw_id ORDER BY evidence_quality_score DESC, evidence_length DESC,
    created_at DESC, evidence_id DESC) AS rnk
  FROM stg_evidence WHERE evidence_length > 0
) GROUP BY raw_id
"""

VIEWS["int_quality"] = """
SELECT *, CASE WHEN recipe_quality_score >= 0.80 THEN 'A' WHEN recipe_quality_score >= 0.60 THEN 'B'
    WHEN recipe_quality_score >= 0.40 THEN 'C' ELSE 'D' END AS recipe_quality_grade
FROM (
  SELECT *, CASE WHEN NOT coalesce(is_recipe, false) THEN 0.0 ELSE round(greatest(0.0, least(1.0,
      0.22::DOUBLE * (CASE WHEN has_ingredient_list THEN 1.0 ELSE 0.0 END)
    + 0.22::DOUBLE * (CASE WHEN has_instructions THEN 1.0 ELSE 0.0 END)
    + 0.16::DOUBLE * caption_completeness_score + 0.16::DOUBLE * final_recipe_confidence
    + 0.14::DOUBLE * best_evidence_quality_score
    + 0.06::DOUBLE * (CASE WHEN ingredient_count >= 3 THEN 1.0 ELSE 0.0 END)
    + 0.04::DOUBLE * (CASE WHEN step_count >= 2 THEN 1.0 ELSE 0.0 END)
    - 0.03::DOUBLE * least(missing_info_count, 5))), 9) END AS recipe_quality_score
  FROM (
    SELECT r.*, coalesce(nullif(regexp_extract(r.url_tiktok, 'video/([0-9]+)', 1), ''), nullif(r.url_tiktok, ''),
        CAST(r.raw_id AS VARCHAR)) AS content_key,
      coalesce(e.best_evidence_quality_score, r.evidence_quality_score, 0) AS best_evidence_quality_score,
      coalesce(e.avg_evidence_quality_score, r.evidence_quality_score, 0) AS avg_evidence_quality_score,
      coalesce(e.evidence_source_count, 0) AS evidence_source_count, coalesce(e.ocr_source_count, 0) AS ocr_source_count,
      coalesce(e.audio_source_count, 0) AS audio_source_count, coalesce(e.comment_source_count, 0) AS comment_source_count,
      coalesce(e.recipe_signal_count, 0) AS recipe_signal_count, e.best_evidence_text,
      CAST(coalesce(json_array_length(r.ingredients), 0) AS BIGINT) AS ingredient_count,
      CAST(coalesce(json_array_length(r.final_recipe_json, '$.steps'), 0) AS BIGINT) AS step_count,
      CAST(coalesce(json_array_length(r.missing_recipe_info), 0) AS BIGINT) AS missing_info_count
    FROM stg_recipes r LEFT JOIN int_evidence e ON r.raw_id = e.raw_id
  )
)
"""

VIEWS["gold_catalog"] = r"""
SELECT *, trim(regexp_replace(coalesce(nullif(final_recipe_title, ''), original_title), '\s+', ' ', 'g')) AS display_title
FROM int_quality
QUALIFY row_number() OVER (PARTITION BY content_key ORDER BY recipe_quality_score DESC,
  CASE recipe_status WHEN 'full_recipe' THEN 1 WHEN 'partial_recipe' THEN 2 WHEN 'food_content' THEN 3 ELSE 4 END,
  final_recipe_confidence DESC, caption_completeness_score DESC, processing_confidence DESC, processed_at DESC, raw_id) = 1
"""

VIEWS["gold_api"] = """
SELECT raw_id AS id, display_title AS title, url_tiktok, final_recipe_language AS language, is_vegetarian, cuisine_style,
  main_ingredient, ingredients, final_recipe_title, final_recipe_text, final_recipe_json, recipe_status,
  recipe_quality_score, recipe_quality_grade, recipe_quality_score AS confidence, processed_at
FROM gold_catalog
WHERE is_recipe AND recipe_status IN ('full_recipe', 'partial_recipe') AND recipe_quality_score >= 0.60
  AND ingredient_count >= 2 AND step_count >= 1 AND final_recipe_text IS NOT NULL AND trim(final_recipe_text) <> ''
"""
