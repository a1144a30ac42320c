"""Column layouts of the landing files, tables and events (fixed values)."""

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


VERIFIED_COLUMNS = [
    "TITLE", "DESCRIPTION", "URL_TIKTOK", "PLATFORM", "CONTENT_ID",
    "CREATOR_USERNAME", "SOURCE_PLATFORM_URL", "RECIPE_LANGUAGE_HINT",
    "CUISINE_HINT", "MAIN_INGREDIENT_HINT", "DESCRIPTION_IS_PARTIAL",
    "DATA_ORIGIN", "VERIFICATION_SOURCE_URL",
]
DISCOVERY_COLUMNS = VERIFIED_COLUMNS + [
    "DESCRIPTION_SOURCE", "DESCRIPTION_LENGTH", "DESCRIPTION_ENRICHED",
    "ORIGINAL_DESCRIPTION", "RECOVERED_TEXT", "EVIDENCE_TEXT",
]
REJECT_COLUMNS = [
    "SOURCE_TYPE", "SOURCE_VALUE", "CONTENT_ID", "CREATOR_USERNAME",
    "DESCRIPTION", "REJECT_REASON",
]
PAYLOAD_FIELDS = [
    "platform", "content_id", "creator_username", "original_description",
    "recovered_text", "evidence_text", "source_platform_url",
    "recipe_language_hint", "cuisine_hint", "main_ingredient_hint",
    "description_is_partial", "data_origin", "verification_source_url",
    "description_source", "description_length", "description_enriched",
]

DETECTION_EVENT = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in (
            "event_type", "detected_at", "source_system", "platform",
            "creator_username", "video_id", "content_id", "published_at",
            "title", "description", "url_tiktok", "url", "language_hint",
        )
    ]
    + [
        T.StructField("description_is_partial", T.BooleanType()),
        T.StructField("raw_payload", T.StringType()),
    ]
)
LEGACY_EVENT = strings("TITLE", "DESCRIPTION", "URL_TIKTOK", "SOURCE_FILE")

VIDEO_ITEM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("desc", T.StringType()),
        T.StructField("createTime", T.StringType()),
        T.StructField("author", strings("uniqueId", "unique_id", "nickname")),
    ]
)

API_COLUMNS = [
    ("raw_id", "id"), ("display_title", "title"), ("url_tiktok", "url_tiktok"),
    ("final_recipe_language", "language"), ("is_vegetarian", "is_vegetarian"),
    ("cuisine_style", "cuisine_style"), ("main_ingredient", "main_ingredient"),
    ("ingredients", "ingredients"), ("final_recipe_title", "final_recipe_title"),
    ("final_recipe_text", "final_recipe_text"),
    ("final_recipe_json", "final_recipe_json"),
    ("recipe_status", "recipe_status"),
    ("recipe_quality_score", "recipe_quality_score"),
    ("recipe_quality_grade", "recipe_quality_grade"),
    ("recipe_quality_score", "confidence"), ("processed_at", "processed_at"),
]
DASHBOARD_COLUMNS = [
    "raw_id", "content_key", "display_title", "original_description",
    "recovered_text", "evidence_text", "best_evidence_text", "url_tiktok",
    "recipe_language", "is_vegetarian", "cuisine_style", "main_ingredient",
    "ingredients", "ingredient_count", "is_recipe", "recipe_status",
    "has_ingredient_list", "has_instructions", "caption_completeness_score",
    "evidence_quality_score", "best_evidence_quality_score",
    "avg_evidence_quality_score", "evidence_source_count", "ocr_source_count",
    "audio_source_count", "comment_source_count", "recipe_signal_count",
    "rejection_reason", "final_recipe_title", "final_recipe_text",
    "final_recipe_json", "step_count", "missing_recipe_info",
    "missing_info_count", "final_recipe_confidence", "final_recipe_language",
    "recipe_quality_score", "recipe_quality_grade", "processing_confidence",
    "model_name", "processed_at",
]
DEBUG_COLUMNS = [
    "raw_id", "content_key", "display_title", "url_tiktok", "recipe_language",
    "is_recipe", "recipe_status", "recipe_quality_score",
    "recipe_quality_grade", "has_ingredient_list", "has_instructions",
    "ingredient_count", "step_count", "missing_info_count",
    "caption_completeness_score", "evidence_quality_score",
    "best_evidence_quality_score", "evidence_source_count", "ocr_source_count",
    "audio_source_count", "comment_source_count", "recipe_signal_count",
    "rejection_reason", "missing_recipe_info", "original_description",
    "recovered_text", "evidence_text", "best_evidence_text",
    "final_recipe_text", "final_recipe_json", "final_recipe_confidence",
    "processing_confidence", "model_name", "processed_at",
]
LIST_COLUMNS = [
    "id", "title", "url_tiktok", "language", "is_vegetarian", "cuisine_style",
    "main_ingredient", "ingredients", "final_recipe_text", "recipe_status",
    "recipe_quality_score", "recipe_quality_grade", "confidence",
    "processed_at",
]
REVIEW_COLUMNS = [
    "raw_id", "display_title", "recipe_status", "caption_completeness_score",
    "final_recipe_confidence", "recipe_language", "cuisine_style",
    "main_ingredient", "processing_confidence", "model_name", "processed_at",
]
LATEST_COLUMNS = [
    "display_title", "cuisine_style", "main_ingredient", "recipe_language",
    "processing_confidence", "processed_at",
]
