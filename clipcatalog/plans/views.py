"""Staged views: typed rows and evidence to a scored, de-duplicated catalog.

    stage_recipes  ─┐
                    ├─ score_recipes ─ catalog ─┬─ api_catalog
    stage_evidence ─ evidence_by_item ─┘        ├─ dashboard_catalog / debug_catalog
                                                └─ daily quality, analytics
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions.columns import (
    clamp01, display_title, normalize_language_code, scoring_key, title_case,
)
from clipcatalog.functions.structured import array_counts, quality_grade, quality_score
from clipcatalog.operators.checks import check_report
from clipcatalog.operators.joins import left_join_features
from clipcatalog.operators.ranking import best_row_per_key, dedup_evidence, latest_per_key
from clipcatalog.operators.rollups import (
    catalog_summary, evidence_rollup, rollup_by_cuisine, rollup_by_ingredient, rollup_by_language, rollup_by_model,
)
from clipcatalog.operators.serving import published, serving_gate, serving_projection

OPTIONAL_TEXTS = ["original_description", "recovered_text", "evidence_text", "rejection_reason", "final_recipe_language",
                  "record_hash"]


def stage_recipes(rows: DataFrame, tie: list[Column]) -> DataFrame:
    """Latest answer per item with normalised languages, scores and flags.

    ``tie`` orders answers of one item and time; it must tell any two of them apart.
    """
    absent = {c: F.lit(None).cast("string") for c in OPTIONAL_TEXTS if c not in rows.columns}
    if "evidence_quality_score" not in rows.columns:
        absent["evidence_quality_score"] = F.lit(None).cast("double")
    latest = latest_per_key(rows.withColumns(absent), ["raw_id"], "processed_at", tie)
    language = normalize_language_code("recipe_language")
    return latest.withColumns({
        "evidence_quality_score": F.coalesce("evidence_quality_score", F.lit(0.0)),
        "recipe_language": language,
        "cuisine_style": title_case("cuisine_style"),
        "main_ingredient": title_case("main_ingredient"),
        "is_recipe": F.coalesce("is_recipe", F.lit(True)),
        "recipe_status": F.coalesce("recipe_status", F.lit("partial_recipe")),
        "has_ingredient_list": F.coalesce("has_ingredient_list", F.lit(False)),
        "has_instructions": F.coalesce("has_instructions", F.lit(False)),
        "caption_completeness_score": clamp01("caption_completeness_score"),
        "final_recipe_confidence": clamp01("final_recipe_confidence"),
        "final_recipe_language": F.coalesce(normalize_language_code("final_recipe_language", other=None), language),
        "processing_confidence": clamp01("processing_confidence"),
    })


def stage_evidence(rows: DataFrame) -> DataFrame:
    return dedup_evidence(rows)


def evidence_by_item(evidence: DataFrame) -> DataFrame:
    return evidence_rollup(evidence)


def score_recipes(recipes: DataFrame, evidence: DataFrame) -> DataFrame:
    """Recipes with their evidence features, counts, quality score and grade."""
    own = F.coalesce("evidence_quality_score", F.lit(0.0))
    joined = left_join_features(recipes, evidence, "raw_id", {
        "best_evidence_quality_score": own,
        "avg_evidence_quality_score": own,
        "evidence_source_count": 0,
        "ocr_source_count": 0,
        "audio_source_count": 0,
        "comment_source_count": 0,
        "recipe_signal_count": 0,
        "best_evidence_text": None,
    })
    scored = joined.withColumns({
        "content_key": scoring_key("url_tiktok", "raw_id"),
        "ingredient_count": array_counts("ingredients"),
        "step_count": array_counts(None, F.col("final_recipe_json")),
        "missing_info_count": array_counts("missing_recipe_info"),
    }).withColumn(
        "recipe_quality_score",
        quality_score(
            "is_recipe", "has_ingredient_list", "has_instructions", "caption_completeness_score",
            "final_recipe_confidence", "best_evidence_quality_score", "ingredient_count", "step_count",
            "missing_info_count",
        ),
    )
    return scored.withColumn("recipe_quality_grade", quality_grade("recipe_quality_score"))


def catalog(scored: DataFrame) -> DataFrame:
    """One best row per business key, with its display title."""
    return best_row_per_key(
        scored.withColumn("display_title", display_title("final_recipe_title", "original_title"))
    )


def api_catalog(rows: DataFrame) -> DataFrame:
    return serving_projection(serving_gate(rows), "api")


def build_catalog(silver: DataFrame, evidence: DataFrame, tie: list[Column]) -> DataFrame:
    """Typed rows and evidence rows to the catalog, as one plan."""
    return catalog(score_recipes(stage_recipes(silver, tie), evidence_by_item(stage_evidence(evidence))))


def view_chain(silver: DataFrame, evidence: DataFrame, tie: list[Column]) -> dict:
    """The views by name, for ``publish_views``."""
    return {
        "stg_recipes": lambda v: stage_recipes(silver, tie),
        "stg_evidence": lambda v: stage_evidence(evidence),
        "int_evidence_by_item": lambda v: evidence_by_item(v["stg_evidence"]),
        "int_recipe_quality": lambda v: score_recipes(v["stg_recipes"], v["int_evidence_by_item"]),
        "gold_catalog": lambda v: catalog(v["int_recipe_quality"]),
        "gold_api_catalog": lambda v: api_catalog(v["gold_catalog"]),
        "gold_dashboard_catalog": lambda v: serving_projection(v["gold_catalog"], "dashboard"),
        "gold_debug_catalog": lambda v: serving_projection(v["gold_catalog"], "debug"),
    }


def analytics(silver: DataFrame, now: Column) -> dict[str, DataFrame]:
    """The five report tables over the typed rows."""
    narrow = silver.select("cuisine_style", "main_ingredient", "recipe_language", "model_name", "is_vegetarian",
                           "processing_confidence")
    return {
        "recipe_analytics_summary": catalog_summary(
            narrow, "is_vegetarian", "processing_confidence",
            {"recipe_language": "distinct_languages", "cuisine_style": "distinct_cuisines",
             "main_ingredient": "distinct_main_ingredients", "model_name": "distinct_models"}, now),
        "recipe_analytics_by_cuisine": rollup_by_cuisine(narrow, now),
        "recipe_analytics_by_ingredient": rollup_by_ingredient(narrow, now),
        "recipe_analytics_by_language": rollup_by_language(narrow, now),
        "recipe_analytics_by_model": rollup_by_model(narrow, now),
    }


def catalog_checks(recipes: DataFrame, evidence: DataFrame, gold: DataFrame) -> DataFrame:
    """Report of every declared check over the staged and published views.

    The published rows are those of the catalog that pass the gate, so their checks are
    conditions on the catalog, counted with its own.
    """
    def is_null(c):
        return F.col(c).isNull()

    def outside(c):
        return (F.col(c) < 0) | (F.col(c) > 1)

    full, served = F.col("recipe_status") == "full_recipe", published()
    return check_report(
        [
            ("recipes.raw_id.not_null", recipes, is_null("raw_id")),
            ("recipes.url_tiktok.not_null", recipes, is_null("url_tiktok")),
            ("recipes.recipe_status.accepted_values", recipes, ~F.col("recipe_status").isin(vocab.RECIPE_STATUSES)),
            ("evidence.raw_id.not_null", evidence, is_null("raw_id")),
            ("evidence.source_type.accepted_values", evidence,
             ~F.col("source_type").isin(vocab.EVIDENCE_SOURCE_TYPES)),
            ("catalog.raw_id.not_null", gold, is_null("raw_id")),
            ("catalog.recipe_quality_score.not_null", gold, is_null("recipe_quality_score")),
            ("catalog.recipe_quality_score.range", gold, outside("recipe_quality_score")),
            ("catalog.final_recipe_confidence.range", gold, outside("final_recipe_confidence")),
            ("catalog.full_recipe.ingredients", gold, full & (F.coalesce("ingredient_count", F.lit(0)) < 2)),
            ("catalog.full_recipe.steps", gold, full & (F.coalesce("step_count", F.lit(0)) == 0)),
            ("api.id.not_null", gold, served & is_null("raw_id")),
            ("api.url_tiktok.not_null", gold, served & is_null("url_tiktok")),
            ("api.recipe_quality_score.minimum", gold, served & (F.coalesce("recipe_quality_score", F.lit(0.0)) < 0.60)),
        ],
        [("recipes.raw_id.unique", recipes, "raw_id", None), ("api.id.unique", gold, "raw_id", served)],
    )
