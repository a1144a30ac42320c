"""The batch run: landing files to published tables, as plain callables.

Each step reads its inputs through frames and tables, so the steps can be run
one by one by any scheduler, or together by ``run_batch``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcatalog import schemas
from clipcatalog.functions.columns import batch_hash, blank_to_null, build_payload, content_key, default_blank, path_id, try_boolean
from clipcatalog.functions.structured import processing_confidence, prompt_payload
from clipcatalog.functions.text import evidence_score
from clipcatalog.operators.answers import LIST_MEMBERS, json_items, merged_answers, normalize_answers, with_json_items
from clipcatalog.operators.joins import composed_evidence, incremental_candidates, with_recovery
from clipcatalog.operators.ranking import best_source_row
from clipcatalog.operators.rollups import evidence_concat, evidence_stats
from clipcatalog.plans import views
from clipcatalog.sources.session import landed

def answer_tie() -> list[Column]:
    """Order of answers of one item and time, by their texts."""
    return [F.col("llm_raw_response").asc_nulls_last(), F.col("record_hash").asc_nulls_last()]


def landing_rows(rows: DataFrame, tie: str = "raw_id", keep_id: bool = False) -> DataFrame:
    """Landing rows to one best, hashed row per (platform, content key).

    ``rows`` has lower-case landing columns with ``url``; the flag columns may
    still be text.  ``tie`` orders rows that are equal otherwise; ``keep_id``
    returns it.
    """
    def flag(name):
        c = F.col(name)
        return try_boolean(c) if dict(rows.dtypes)[name] == "string" else c

    normal = rows.filter(F.col("url").isNotNull()).select(
        tie,
        default_blank("platform", "tiktok").alias("platform"),
        F.coalesce(blank_to_null("content_id"), path_id("url")).alias("content_id"),
        blank_to_null("creator_username").alias("creator_username"),
        blank_to_null("title").alias("title"),
        blank_to_null("description").alias("description"),
        blank_to_null("url").alias("url"),
        F.coalesce(flag("description_is_partial"), F.lit(False)).alias("description_is_partial"),
        "source_file",
        *[c for c in schemas.PAYLOAD_FIELDS
          if c in rows.columns and c not in ("platform", "content_id", "creator_username", "description_is_partial")],
        content_key("content_id", "url").alias("content_key"),
    ).filter(F.col("content_key").isNotNull())
    best = best_source_row(normal, ["platform", "content_key"], F.coalesce(try_boolean("description_enriched"), F.lit(False)), tie)
    payload = {n: (n if n in normal.columns else F.lit(None).cast("string")) for n in schemas.PAYLOAD_FIELDS}
    return best.select(
        *([tie] if keep_id else []), "platform", "content_id", "creator_username", "title", "description", "url", "description_is_partial",
        "source_file", build_payload(payload).alias("raw_payload"),
        batch_hash("platform", "content_key", "description", "title", "url").alias("record_hash"), "content_key",
    )


def request_rows(bronze: DataFrame, silver: DataFrame, evidence: DataFrame, mode: str = "new", part_rows: int = 1000) -> DataFrame:
    """Rows to enrich with each text of their requests once; one row per evidence part of ``part_rows`` texts."""
    member = {n: blank_to_null(F.get_json_object("raw_payload", f"$.{n}")) for n in
              ("original_description", "recovered_text")}
    source = bronze.withColumns({"original": member["original_description"], "recovered_text": member["recovered_text"]})
    chosen = incremental_candidates(source, silver, evidence_stats(evidence), mode)
    return with_recovery(chosen, evidence_concat(evidence, part_rows=part_rows)).select(
        "raw_id", "part_no", "title", "url", "record_hash", "original", "description", "recovered_text", "recovery_text",
        "evidence_quality_score",
    )


def request_bodies(rows: DataFrame, instruction: str = "") -> DataFrame:
    """``request_rows`` as requests; ``instruction`` is what the caller's model is told to do."""
    return composed_evidence(rows).select(
        "raw_id", "part_no", "title", "url", "record_hash", "original_description",
        F.coalesce("all_recovered_text", F.lit("")).alias("recovered_text"),
        F.coalesce("evidence_text", F.col("description")).alias("evidence_text"),
        "evidence_quality_score",
        prompt_payload("original_description", "description", "all_recovered_text", "evidence_text",
                       "evidence_quality_score", instruction, "social_recipe_video").alias("prompt"),
    )


def enrichment_requests(bronze: DataFrame, silver: DataFrame, evidence: DataFrame, mode: str = "new",
                        instruction: str = "", part_rows: int = 1000) -> DataFrame:
    """Rows to enrich with their request body; one row per evidence part of ``part_rows`` texts.

    ``instruction`` is what the caller's model is told to do.
    """
    return request_bodies(request_rows(bronze, silver, evidence, mode, part_rows), instruction)


def typed_rows(requests: DataFrame, answers: DataFrame, model: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """Answers to (typed rows, quarantined rows).

    An answer belongs to the evidence part (``raw_id``, ``part_no``) it was asked for; without
    a ``part_no`` it belongs to part 0.  An item gets one typed row out of all its usable answers.
    They rank: those that call it a recipe, then the most confident, then the best evidence, then
    the first part.  Judgements and texts of the item come from the first; its title, text,
    language, cuisine and main ingredient from the first that has one.  Ingredients, steps, notes and missing
    points are the union over all parts, in their order, values of earlier parts left out.  A list or
    instructions in any part count.  ``evidence_parts`` counts the parts with a usable answer.

    Usable answers are joined to their requests once and kept in the shared folder, as ranks and unions both read them.
    """
    if "part_no" not in answers.columns:
        answers = answers.withColumn("part_no", F.lit(0))
    typed = normalize_answers(answers.select("raw_id", "part_no", "response"), "response", keep=["raw_id", "part_no", "response"])
    bad = typed.filter(F.col("error").isNotNull()).select("raw_id", "part_no", "response", "error")
    good = typed.filter(F.col("error").isNull())
    joined = good.hint("merge").join(requests, ["raw_id", "part_no"])  # answers are small in a file, not in memory
    unscored = F.when(F.coalesce("evidence_quality_score", F.lit(0.0)) == 0.0, F.col("evidence_text"))  # other texts stay out of Python
    members = [f"json_{m}" for m in LIST_MEMBERS]
    rows = joined.select(
        "raw_id", "part_no", F.col("title").alias("original_title"), "original_description", "recovered_text", "evidence_text",
        F.coalesce(F.nullif("evidence_quality_score", F.lit(0.0)), evidence_score(unscored)).alias("evidence_quality_score"),
        F.col("url").alias("url_tiktok"), "lang", F.col("is_veg").alias("is_vegetarian"), "cuisine", "ingredient", "ingredients",
        "is_recipe", "recipe_status", "has_ingredient_list", "has_instructions", "caption_completeness_score", "rejection_reason",
        "final_recipe_title", "final_recipe_text", "final_recipe_json", "missing_recipe_info", "final_recipe_confidence",
        "final_recipe_language", F.col("response").alias("llm_raw_response"), "record_hash",
        *[json_items("final_recipe_json", m).alias(f"json_{m}") for m in LIST_MEMBERS],
    )
    rows = landed(rows, "answered")
    order = [
        ~F.coalesce("is_recipe", F.lit(False)), -F.coalesce("final_recipe_confidence", F.lit(-1.0)),
        -F.coalesce("evidence_quality_score", F.lit(-1.0)), F.col("part_no"), F.col("llm_raw_response"),
    ]
    merged = merged_answers(
        rows, "raw_id", order,
        best=["original_title", "original_description", "recovered_text", "evidence_text", "evidence_quality_score", "url_tiktok",
              "is_vegetarian", "is_recipe", "recipe_status", "rejection_reason", "final_recipe_json", "final_recipe_confidence",
              "llm_raw_response", "record_hash"],
        filled={"lang": ["", "unknown"], "cuisine": ["", "unknown"], "ingredient": ["", "unknown"], "final_recipe_title": [""],
                "final_recipe_text": [""], "final_recipe_language": ["", "unknown"]},
        any_of=["has_ingredient_list", "has_instructions"], most=["caption_completeness_score"],
        lists=["ingredients", "missing_recipe_info", *members],
    )
    typed_ = merged.select(
        "raw_id", "original_title", "original_description", "recovered_text", "evidence_text", "evidence_quality_score", "url_tiktok",
        F.col("lang").alias("recipe_language"), "is_vegetarian", F.col("cuisine").alias("cuisine_style"),
        F.col("ingredient").alias("main_ingredient"), F.to_json("ingredients").alias("ingredients"), "is_recipe", "recipe_status",
        "has_ingredient_list", "has_instructions", "caption_completeness_score", "rejection_reason", "final_recipe_title",
        "final_recipe_text", with_json_items("final_recipe_json", {m: F.col(f"json_{m}") for m in LIST_MEMBERS}).alias("final_recipe_json"),
        F.to_json("missing_recipe_info").alias("missing_recipe_info"), "final_recipe_confidence", "final_recipe_language",
        processing_confidence("lang", "is_recipe", "has_ingredient_list", "has_instructions",
                              "caption_completeness_score").alias("processing_confidence"),
        F.lit(model).alias("model_name"), "llm_raw_response", "record_hash", now.alias("processed_at"),
        F.col("parts").alias("evidence_parts"),
    )
    return typed_, bad


def run_batch(landing: DataFrame, silver: DataFrame, evidence: DataFrame, ask: Callable[[DataFrame], DataFrame],
              model: str, now: Column, instruction: str = "", part_rows: int = 1000) -> dict[str, DataFrame]:
    """Landing rows to published tables in one go.

    ``silver`` holds the typed rows of earlier runs, ``ask`` turns requests into answers
    (``raw_id``, ``part_no``, ``response``).  Items that are already typed and have no newer
    evidence are not asked for again, so a repeated run changes nothing.  The caller writes
    the frames; ``typed`` is what this run adds to ``silver``.  Requests and answers are kept in the
    shared folder at once: each item is made up once and the model is asked once, however many frames are written.
    """
    bronze = landing_rows(landing, keep_id=True).withColumn("ingested_at", now)
    requests = request_bodies(landed(request_rows(bronze, silver, evidence, part_rows=part_rows), "requests"), instruction)
    typed, bad = typed_rows(requests, landed(ask(requests), "answers"), model, now)
    known = typed.unionByName(silver, allowMissingColumns=True)
    recipes, parts = views.stage_recipes(known, answer_tie()), views.stage_evidence(evidence)
    catalog = views.build_catalog(known, evidence, answer_tie())
    return {
        "bronze": bronze, "requests": requests, "typed": typed, "rejected": bad, "catalog": catalog, "api": views.api_catalog(catalog),
        "checks": views.catalog_checks(recipes, parts, catalog),
    }
