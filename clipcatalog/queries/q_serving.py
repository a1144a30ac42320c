"""Serving queries and dashboard metrics over the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipcatalog import schemas, vocab
from clipcatalog.operators import checks as K
from clipcatalog.operators import serving as S
from clipcatalog.plans import views
from clipcatalog.queries import built
from clipcatalog.queries import duck as d
from clipcatalog.queries.registry import Inputs, query


@query("serving_gate", "SELECT id, recipe_quality_score, recipe_status FROM gold_api")
def _(t: Inputs):
    return S.serving_gate(built.gold(t)).select(F.col("raw_id").alias("id"), "recipe_quality_score", "recipe_status")


@query("serving_projection", "SELECT * FROM gold_api")
def _(t: Inputs):
    return built.api(t)


def _columns(names) -> str:
    rounded = {"avg_evidence_quality_score"}
    return ", ".join(f"round({c}, 6) AS {c}" if c in rounded else c for c in names)


@query("serving_projection_dashboard", f"SELECT {_columns(schemas.DASHBOARD_COLUMNS)} FROM gold_catalog")
def _(t: Inputs):
    return S.serving_projection(built.gold(t), "dashboard").withColumn(
        "avg_evidence_quality_score", F.round("avg_evidence_quality_score", 6))


@query("serving_projection_debug", f"SELECT {_columns(schemas.DEBUG_COLUMNS)} FROM gold_catalog")
def _(t: Inputs):
    return S.serving_projection(built.gold(t), "debug")


@query("list_query", f"""
SELECT {', '.join(schemas.LIST_COLUMNS)} FROM gold_api WHERE lower(cuisine_style) = 'thai' AND is_vegetarian
ORDER BY processed_at DESC, id LIMIT 50""")
def _(t: Inputs):
    rows = built.api(t).select(*schemas.LIST_COLUMNS)
    return S.list_query(rows, {"cuisine_style": "THAI", "language": None}, {"is_vegetarian": True}, 50)


@query("point_lookup", "SELECT * FROM gold_api WHERE id = (SELECT max(id) FROM gold_api)")
def _(t: Inputs):
    api = built.api(t)
    return S.point_lookup(api, "id", api.agg(F.max("id")).scalar())


_SEARCH = ["display_title", "cuisine_style", "main_ingredient", "ingredients", "final_recipe_text", "original_description"]


@query("facet_filter", """
SELECT raw_id, display_title, processing_confidence FROM gold_catalog
WHERE recipe_language IN ('en', 'fr', 'unknown') AND cuisine_style IN ('Thai', 'Italian') AND model_name IN ('model-0', 'model-1', 'model-2')
  AND coalesce(processing_confidence, 0) >= 0.2 AND coalesce(is_vegetarian, false) = false
  AND contains(lower(concat_ws(' ', coalesce(display_title, ''), coalesce(cuisine_style, ''), coalesce(main_ingredient, ''),
    coalesce(ingredients, ''), coalesce(final_recipe_text, ''), coalesce(original_description, ''))), 'rice')""")
def _(t: Inputs):
    return S.facet_filter(
        built.gold(t),
        {"recipe_language": ["en", "fr", "unknown"], "cuisine_style": ["Thai", "Italian"],
         "model_name": ["model-0", "model-1", "model-2"], "main_ingredient": []},
        min_confidence=0.2, dietary="non_vegetarian", search=" RICE ", search_columns=_SEARCH,
    ).select("raw_id", "display_title", "processing_confidence")


@query("substring_search", """
SELECT doc_id, contains(lower(concat_ws(' ', source, lang, text)), 'src1 en') AS joined FROM documents
WHERE contains(lower(source), 'er') OR contains(lower(lang), 'er') OR contains(lower(text), 'er')""")
def _(t: Inputs):
    docs = t.table("documents")
    either = S.substring_search(docs, ["source", "lang", "text"], "ER", concatenated=False)
    joined = S.substring_search(docs, ["source", "lang", "text"], "Src1 en").select("doc_id", F.lit(True).alias("_j"))
    return either.select("doc_id").join(joined, "doc_id", "left").select(
        "doc_id", F.coalesce("_j", F.lit(False)).alias("joined"))


@query("review_queue", f"""
SELECT {', '.join(schemas.REVIEW_COLUMNS)} FROM gold_catalog WHERE coalesce(processing_confidence, 0) < 0.75
ORDER BY processed_at DESC, raw_id LIMIT 100""")
def _(t: Inputs):
    return S.review_queue(built.gold(t))


@query("value_counts_topn", """
SELECT coalesce(nullif(cuisine_style, ''), 'unknown') AS cuisine_style, count(*) AS recipe_count FROM gold_catalog
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12""")
def _(t: Inputs):
    return S.value_counts_topn(built.gold(t), "cuisine_style", 12)


@query("facet_values", """
SELECT DISTINCT 'language' AS facet, language AS value FROM gold_api WHERE coalesce(language, '') <> ''
UNION ALL SELECT DISTINCT 'cuisine_style', cuisine_style FROM gold_api WHERE coalesce(cuisine_style, '') <> ''
UNION ALL SELECT DISTINCT 'main_ingredient', main_ingredient FROM gold_api WHERE coalesce(main_ingredient, '') <> ''""")
def _(t: Inputs):
    return S.facet_values(built.api(t), ["language", "cuisine_style", "main_ingredient"])


@query("kpi_row", """
SELECT (SELECT count(*) FROM gold_catalog) AS total_recipes, count(*) AS visible_recipes,
  round(coalesce(avg(CASE WHEN coalesce(is_vegetarian, false) THEN 1.0 ELSE 0.0 END) * 100, 0), 6) AS vegetarian_pct,
  round(coalesce(avg(processing_confidence), 0), 6) AS avg_confidence, count(DISTINCT cuisine_style) AS distinct_cuisines,
  count(DISTINCT main_ingredient) AS distinct_ingredients
FROM gold_catalog WHERE cuisine_style IN ('Thai', 'Italian') AND coalesce(processing_confidence, 0) >= 0.0""")
def _(t: Inputs):
    gold = built.gold(t)
    row = S.kpi_row(gold, S.facet_filter(gold, {"cuisine_style": ["Thai", "Italian"]}))
    return row.withColumns({"vegetarian_pct": F.round("vegetarian_pct", 6), "avg_confidence": F.round("avg_confidence", 6)})


@query("search_metrics", """
SELECT count(*) AS matches, count(DISTINCT cuisine_style) AS cuisines, count(DISTINCT main_ingredient) AS ingredients,
  round(coalesce(avg(recipe_quality_score), 0), 6) AS avg_quality FROM gold_catalog
WHERE contains(lower(concat_ws(' ', coalesce(display_title, ''), coalesce(main_ingredient, ''))), 'rice')""")
def _(t: Inputs):
    found = S.substring_search(built.gold(t), ["display_title", "main_ingredient"], "rice")
    return S.search_metrics(found).withColumn("avg_quality", F.round("avg_quality", 6))


def _completeness(c: str) -> str:
    hit = f"count(*) FILTER (lower(coalesce({c}, 'unknown')) = 'unknown')"
    return f"SELECT '{c}' AS field, {hit} AS unknown_count, count(*) FILTER ({c} IS NULL) AS missing_count, round({hit} / count(*), 4) AS unknown_rate FROM gold_catalog"


@query("field_completeness", " UNION ALL ".join(_completeness(c) for c in ("recipe_language", "cuisine_style", "main_ingredient")))
def _(t: Inputs):
    return S.field_completeness(built.gold(t), ["recipe_language", "cuisine_style", "main_ingredient"])


@query("confidence_buckets", """
SELECT CASE WHEN c < 0 THEN 'unknown' WHEN c <= 0.5 THEN '0-0.50' WHEN c <= 0.75 THEN '0.50-0.75' WHEN c <= 0.9 THEN '0.75-0.90'
  WHEN c <= 1 THEN '0.90-1.00' ELSE 'unknown' END AS confidence_bucket, count(*) AS recipe_count
FROM (SELECT coalesce(processing_confidence, 0) AS c FROM silver_fx) GROUP BY 1""")
def _(t: Inputs):
    return S.confidence_buckets(t.fx("silver_fx"), "processing_confidence")


@query("dietary_split", """
SELECT CASE WHEN coalesce(is_vegetarian, false) THEN 'Vegetarian' ELSE 'Non-vegetarian' END AS dietary_class, count(*) AS recipe_count
FROM silver_fx GROUP BY 1""")
def _(t: Inputs):
    return S.dietary_split(t.fx("silver_fx"))


@query("threshold_counts", """
SELECT count(*) FILTER (coalesce(recipe_quality_score, 0) < 0.60) AS low_quality,
  count(*) FILTER (coalesce(final_recipe_confidence, 0) < 0.65) AS weak_final FROM gold_catalog""")
def _(t: Inputs):
    return S.threshold_counts(built.gold(t), {
        "low_quality": ("recipe_quality_score", 0.60), "weak_final": ("final_recipe_confidence", 0.65)})


@query("home_stats", f"""
SELECT count(*) AS recipes, count(DISTINCT nullif(language, '')) AS languages, count(DISTINCT nullif(cuisine_style, '')) AS cuisines,
  count(*) FILTER ({d.video_id('url_tiktok')} IN (SELECT CAST(user_id AS VARCHAR) FROM events)) AS with_thumbnails FROM gold_api""")
def _(t: Inputs):
    media = t.table("events").select(F.col("user_id").cast("string").alias("video_id"))
    return S.home_stats(built.api(t), media)


@query("score_range", """
SELECT min(coalesce(final_recipe_confidence, 0)) AS min_confidence, max(coalesce(final_recipe_confidence, 1)) AS max_confidence FROM silver_fx""")
def _(t: Inputs):
    return S.score_range(t.fx("silver_fx"), "final_recipe_confidence")


@query("sorted_page", """
SELECT mode, raw_id, sort_no FROM (
  SELECT 'newest' AS mode, raw_id, row_number() OVER (ORDER BY processed_at DESC NULLS LAST, raw_id) AS sort_no FROM gold_catalog
  UNION ALL SELECT 'quality', raw_id, row_number() OVER (ORDER BY recipe_quality_score DESC NULLS LAST, raw_id) FROM gold_catalog
  UNION ALL SELECT 'confidence_high', raw_id, row_number() OVER (ORDER BY processing_confidence DESC NULLS LAST, raw_id) FROM gold_catalog
  UNION ALL SELECT 'confidence_low', raw_id, row_number() OVER (ORDER BY processing_confidence ASC NULLS LAST, raw_id) FROM gold_catalog
  UNION ALL SELECT 'title', raw_id, row_number() OVER (ORDER BY display_title ASC NULLS LAST, raw_id) FROM gold_catalog)
WHERE sort_no <= 24""")
def _(t: Inputs):
    from pyspark.sql import Window

    gold = built.gold(t).select("raw_id", "processed_at", "recipe_quality_score", "processing_confidence", "display_title")
    pages = None
    for mode, (column, descending) in S.SORT_MODES.items():
        page = S.sorted_page(gold, mode, 24)
        key = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
        numbered = page.select(
            F.lit(mode).alias("mode"), "raw_id",
            F.row_number().over(Window.orderBy(key, "raw_id")).cast("bigint").alias("sort_no"))
        pages = numbered if pages is None else pages.unionAll(numbered)
    return pages


@query("latest_n", f"""
SELECT {', '.join(schemas.LATEST_COLUMNS)} FROM gold_catalog ORDER BY processed_at DESC, raw_id LIMIT 8""")
def _(t: Inputs):
    return S.latest_n(built.gold(t))


@query("layer_counts", """
SELECT 'Bronze raw recipes' AS layer, count(*) AS records FROM captions_fx
UNION ALL SELECT 'Silver enriched recipes', count(*) FROM silver_fx
UNION ALL SELECT 'Gold catalog', count(*) FROM gold_catalog""")
def _(t: Inputs):
    return S.layer_counts({
        "Bronze raw recipes": t.fx("captions_fx"), "Silver enriched recipes": t.fx("silver_fx"),
        "Gold catalog": built.gold(t)})


# --- data checks ---------------------------------------------------------------------


@query("not_null", "SELECT raw_id, processed_at FROM silver_fx WHERE is_recipe IS NULL")
def _(t: Inputs):
    return K.not_null(t.fx("silver_fx"), "is_recipe").select("raw_id", "processed_at")


@query("unique", "SELECT raw_id, count(*) AS n_records FROM silver_fx WHERE raw_id IS NOT NULL GROUP BY raw_id HAVING count(*) > 1")
def _(t: Inputs):
    return K.unique(t.fx("silver_fx"), "raw_id")


@query("accepted_values", "SELECT raw_id, processed_at, recipe_status FROM silver_fx WHERE recipe_status NOT IN ('full_recipe', 'partial_recipe')")
def _(t: Inputs):
    return K.accepted_values(t.fx("silver_fx"), "recipe_status", vocab.PUBLISHED_STATUSES).select(
        "raw_id", "processed_at", "recipe_status")


@query("score_in_range", """
SELECT raw_id, processed_at, caption_completeness_score FROM silver_fx WHERE caption_completeness_score < 0 OR caption_completeness_score > 1""")
def _(t: Inputs):
    return K.score_in_range(t.fx("silver_fx"), "caption_completeness_score").select(
        "raw_id", "processed_at", "caption_completeness_score")


@query("conditional_minimum", """
SELECT raw_id, 'ingredients' AS rule FROM gold_catalog WHERE recipe_status = 'full_recipe' AND coalesce(ingredient_count, 0) < 2
UNION ALL SELECT raw_id, 'steps' FROM gold_catalog WHERE recipe_status = 'full_recipe' AND coalesce(step_count, 0) = 0
UNION ALL SELECT raw_id, 'published' FROM gold_catalog WHERE coalesce(recipe_quality_score, 0) < 0.60""")
def _(t: Inputs):
    gold = built.gold(t)
    full = F.col("recipe_status") == "full_recipe"
    return K.conditional_minimums(gold, [
        ("ingredients", full, "ingredient_count", 2), ("steps", full, "step_count", 1),
        ("published", None, "recipe_quality_score", 0.60),
    ]).select("raw_id", "rule")


_SOURCES = d.in_list(vocab.EVIDENCE_SOURCE_TYPES)
_CHECKS = [
    ("recipes.raw_id.not_null", "stg_recipes", "raw_id IS NULL"),
    ("recipes.url_tiktok.not_null", "stg_recipes", "url_tiktok IS NULL"),
    ("recipes.recipe_status.accepted_values", "stg_recipes", f"recipe_status NOT IN {d.in_list(vocab.RECIPE_STATUSES)}"),
    ("evidence.raw_id.not_null", "stg_evidence", "raw_id IS NULL"),
    ("evidence.source_type.accepted_values", "stg_evidence", f"source_type NOT IN {_SOURCES}"),
    ("catalog.raw_id.not_null", "gold_catalog", "raw_id IS NULL"),
    ("catalog.recipe_quality_score.not_null", "gold_catalog", "recipe_quality_score IS NULL"),
    ("catalog.recipe_quality_score.range", "gold_catalog", "recipe_quality_score < 0 OR recipe_quality_score > 1"),
    ("catalog.final_recipe_confidence.range", "gold_catalog", "final_recipe_confidence < 0 OR final_recipe_confidence > 1"),
    ("catalog.full_recipe.ingredients", "gold_catalog", "recipe_status = 'full_recipe' AND ingredient_count < 2"),
    ("catalog.full_recipe.steps", "gold_catalog", "recipe_status = 'full_recipe' AND step_count = 0"),
    ("api.id.not_null", "gold_api", "id IS NULL"),
    ("api.url_tiktok.not_null", "gold_api", "url_tiktok IS NULL"),
    ("api.recipe_quality_score.minimum", "gold_api", "recipe_quality_score < 0.60"),
]
_REPORT = " UNION ALL ".join(
    [f"SELECT '{n}' AS check_name, count(*) AS violations FROM {f} WHERE {c}" for n, f, c in _CHECKS]
    + [f"SELECT '{n}', count(*) FROM (SELECT {c} FROM {f} GROUP BY {c} HAVING count(*) > 1)"
       for n, f, c in [("recipes.raw_id.unique", "stg_recipes", "raw_id"), ("api.id.unique", "gold_api", "id")]])


@query("check_report", f"SELECT *, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS result FROM ({_REPORT})")
def _(t: Inputs):
    recipes, evidence, gold = built.recipes(t), built.evidence(t), built.gold(t)
    return views.catalog_checks(recipes, evidence, gold)
