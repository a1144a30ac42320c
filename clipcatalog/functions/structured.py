"""Semi-structured model answers: lenient parsing, coercion, defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions.columns import as_col, clamp01, empty_to_null, is_json, strip

FIELD_MAP = "map<string,variant>"


def array_counts(json_array, json_object=None, member: str = "steps") -> Column:
    """Size of a JSON array, or of an array member of a JSON object; else 0."""
    text = as_col(json_array) if json_object is None else F.get_json_object(as_col(json_object), f"$.{member}")
    return F.coalesce(F.json_array_length(text), F.lit(0)).cast("bigint")


def parse_json_lenient(c) -> Column:
    """The text if it is JSON, else its outermost ``{...}`` part, else NULL."""
    text = as_col(c)
    inner = empty_to_null(F.regexp_extract(text, r"(?s)\{.*\}", 0))
    return F.when(is_json(text), text).when(is_json(inner), inner)


def coerce_bool(c, default: bool | Column | None = None) -> Column:
    """Many spellings to boolean; unclear ones give ``default``."""
    text = F.lower(strip(as_col(c).cast("string")))
    value = F.when(text.isin(vocab.ANSWER_TRUE), True).when(text.isin(vocab.ANSWER_FALSE), False)
    if default is None:
        return value
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def coerce_score(c) -> Column:
    return clamp01(strip(as_col(c).cast("string")).try_cast("double"))


def split_list(c) -> Column:
    return F.split(as_col(c), r"[,;|\n]")


def _clean_items(items: Column, lower: bool) -> Column:
    def one(x):
        text = strip(F.coalesce(x, F.lit("")))
        return F.lower(text) if lower else text

    kept = F.filter(
        F.transform(items, one), lambda x: (x != "") & ~F.lower(x).isin(vocab.LIST_PLACEHOLDERS)
    )
    return F.array_distinct(kept)


def normalize_string_list(items, main=None) -> Column:
    """Array of texts: trimmed, placeholders dropped, distinct in order.

    With ``main`` (ingredients) items are lower-cased too, and an empty list
    falls back to the main item.
    """
    cleaned = _clean_items(F.coalesce(as_col(items), F.array().cast("array<string>")), lower=main is not None)
    if main is None:
        return cleaned
    main = as_col(main)
    return F.when(
        (F.size(cleaned) == 0) & ~F.coalesce(main, F.lit("")).isin("", "unknown"), F.array(main)
    ).otherwise(cleaned)


def normalize_status(status, is_recipe, completeness) -> Column:
    text = F.translate(F.lower(strip(F.coalesce(as_col(status), F.lit("")))), " -", "__")
    flag = F.coalesce(as_col(is_recipe), F.lit(False))
    return (
        F.when(text.isin(vocab.RECIPE_STATUSES), text)
        .when(flag & (as_col(completeness) >= 0.75), "full_recipe")
        .when(flag, "partial_recipe")
        .otherwise("food_content")
    )


def fill_recipe_json(json, title, ingredients, missing_info) -> Column:
    """JSON object with the five default members added where they are absent."""
    given = F.coalesce(F.from_json(as_col(json), FIELD_MAP), F.from_json(F.lit("{}"), FIELD_MAP))
    blank = F.coalesce(empty_to_null(title), F.lit("Untitled recipe"))
    empty = F.array().cast("array<string>")
    defaults = F.create_map(
        F.lit("title"), blank.cast("variant"),
        F.lit("ingredients"), as_col(ingredients).cast("variant"),
        F.lit("steps"), empty.cast("variant"),
        F.lit("notes"), empty.cast("variant"),
        F.lit("missing_info"), as_col(missing_info).cast("variant"),
    )
    absent = F.map_filter(defaults, lambda k, _: ~F.map_contains_key(given, k))
    return F.to_json(F.map_concat(given, absent))


def processing_confidence(language, is_recipe, has_list, has_steps, completeness) -> Column:
    def points(condition, value):
        return F.when(condition, F.lit(value)).otherwise(F.lit(0.0))

    total = (
        points(as_col(language) != "unknown", 0.25)
        + points(as_col(is_recipe), 0.25)
        + points(as_col(has_list), 0.2)
        + points(as_col(has_steps), 0.2)
        + F.lit(0.1) * as_col(completeness)
    )
    return F.greatest(F.lit(0.1), F.least(F.lit(1.0), total))


def prompt_payload(original, description, recovered, evidence, score, instruction: str, source: str) -> Column:
    """JSON request body with the caption as fallback for missing evidence."""
    def first(*cols):
        return F.coalesce(*[empty_to_null(c) for c in cols], F.lit(""))

    return F.to_json(
        F.struct(
            F.lit(source).alias("source"),
            strip(first(original, description)).alias("original_caption"),
            strip(first(recovered)).alias("recovered_text"),
            strip(first(evidence, description)).alias("evidence_text"),
            F.coalesce(as_col(score), F.lit(0.0)).alias("evidence_quality_score"),
            F.lit(instruction).alias("instruction"),
        )
    )


def quality_score(is_recipe, has_list, has_steps, completeness, final_confidence, evidence,
                  ingredient_count, step_count, missing_count) -> Column:
    """Weighted quality in [0, 1]; 0 for rows that are not recipes."""
    def flag(c):
        return F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))

    def value(c):
        return F.coalesce(as_col(c).cast("double"), F.lit(0.0))

    total = (
        F.lit(0.22) * flag(as_col(has_list))
        + F.lit(0.22) * flag(as_col(has_steps))
        + F.lit(0.16) * value(completeness)
        + F.lit(0.16) * value(final_confidence)
        + F.lit(0.14) * value(evidence)
        + F.lit(0.06) * flag(as_col(ingredient_count) >= 3)
        + F.lit(0.04) * flag(as_col(step_count) >= 2)
        - F.lit(0.03) * F.least(value(missing_count), F.lit(5.0))
    )
    bounded = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)), 9)
    return F.when(F.coalesce(as_col(is_recipe), F.lit(False)), bounded).otherwise(F.lit(0.0))


def quality_grade(score) -> Column:
    s = as_col(score)
    chain = None
    for edge, grade in vocab.QUALITY_GRADE_EDGES:
        chain = F.when(s >= edge, grade) if chain is None else chain.when(s >= edge, grade)
    return chain.otherwise("D")
