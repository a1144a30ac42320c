"""One typed row per model answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions.columns import as_col, empty_to_null, normalize_language_code, strip
from clipcatalog.functions.structured import (
    FIELD_MAP, coerce_bool, coerce_score, fill_recipe_json, normalize_status, normalize_string_list,
    parse_json_lenient, split_list,
)
from clipcatalog.operators.staging import computed


def answer_fields(body) -> Column:
    """Members of a parsed answer: an object, or the only object of a one-item list."""
    text = as_col(body)
    listed = F.from_json(text, f"array<{FIELD_MAP}>")
    return F.when(F.ltrim(text).startswith("["), F.when(F.size(listed) == 1, listed[0])).otherwise(
        F.from_json(text, FIELD_MAP)
    )


def _pick(fields: Column, *names: str) -> Column:
    """The first member that is present, even when its value is null."""
    chain = None
    for name in names:
        has, value = F.map_contains_key(fields, F.lit(name)), F.try_element_at(fields, F.lit(name))
        chain = F.when(has, value) if chain is None else chain.when(has, value)
    return chain


def _has(fields: Column, *names: str) -> Column:
    hit = F.map_contains_key(fields, F.lit(names[0]))
    for name in names[1:]:
        hit = hit | F.map_contains_key(fields, F.lit(name))
    return hit


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _truthy_text(value: Column) -> Column:
    """Text of a member; NULL for null, false, zero and empty values."""
    text = _text(value)
    falsy = (F.schema_of_variant(value) != "STRING") & text.isin("false", "0", "0.0", "[]", "{}")
    return F.when(~falsy, empty_to_null(text))


def _word(value: Column) -> Column:
    text = F.lower(strip(F.coalesce(_truthy_text(value), F.lit("unknown"))))
    return F.coalesce(empty_to_null(text), F.lit("unknown"))


def _language(value: Column) -> Column:
    return F.coalesce(
        normalize_language_code(_truthy_text(value), vocab.ANSWER_LANGUAGE_ALIASES, trim=True), F.lit("unknown")
    )


def _list(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return F.when(kind.startswith("ARRAY"), F.try_variant_get(value, "$", "array<string>")).when(
        kind == "STRING", split_list(_text(value))
    )


def _bool(value: Column, default=None) -> Column:
    text = _text(value)
    number = F.when(F.schema_of_variant(value) != "STRING", text.try_cast("double"))
    as_text = F.when(number == 1, "1").when(number == 0, "0").otherwise(text)
    return coerce_bool(as_text, default)


def _score(value: Column) -> Column:
    text = _text(value)
    logical = F.when(F.schema_of_variant(value) == "BOOLEAN", text.try_cast("boolean").cast("double"))
    return F.coalesce(logical, coerce_score(text))


def normalize_answers(df: DataFrame, response: str = "response", keep: list[str] | None = None) -> DataFrame:
    """Model answers to 17 typed columns plus an ``error`` column.

    A row whose answer is neither an object nor a one-item list of objects has
    NULL fields and an error text; callers split on ``error`` (quarantine).
    """
    keep = keep or [c for c in df.columns if c != response]
    f = F.col("_fields")
    bodies = computed(df, {"_body": parse_json_lenient(response)}, keep)
    staged = (
        computed(bodies, {"_fields": answer_fields("_body")}, keep)
        .withColumns({
            "lang": _language(_pick(f, "lang", "recipe_language")),
            "is_veg": F.when(
                _has(f, "is_veg", "is_vegetarian"), _bool(_pick(f, "is_veg", "is_vegetarian"))
            ).otherwise(F.lit(False)),
            "cuisine": _word(_pick(f, "cuisine", "cuisine_style")),
            "ingredient": _word(_pick(f, "ingredient", "main_ingredient")),
            "caption_completeness_score": _score(_pick(f, "caption_completeness_score", "completeness")),
        })
        .withColumn(
            "ingredients", normalize_string_list(_list(_pick(f, "ingredients", "ingredient_list")), "ingredient")
        )
        .withColumns({
            "has_ingredient_list": _bool(_pick(f, "has_ingredient_list"), F.size("ingredients") >= 2),
            "has_instructions": _bool(_pick(f, "has_instructions"), F.col("caption_completeness_score") >= 0.65),
        })
        .withColumn(
            "is_recipe",
            _bool(
                _pick(f, "is_recipe"),
                F.col("has_ingredient_list")
                | F.col("has_instructions")
                | (F.col("caption_completeness_score") >= 0.5),
            ),
        )
        .withColumns({
            "recipe_status": normalize_status(
                _text(_pick(f, "recipe_status", "status")), "is_recipe", "caption_completeness_score"
            ),
            "rejection_reason": F.coalesce(_truthy_text(_pick(f, "rejection_reason")), F.lit("")),
            "final_recipe_title": _recipe_only(strip(_truthy_text(_pick(f, "final_recipe_title", "recipe_title")))),
            "final_recipe_text": _recipe_only(strip(_truthy_text(_pick(f, "final_recipe_text", "recipe_text")))),
            "missing_recipe_info": normalize_string_list(_list(_pick(f, "missing_recipe_info", "missing_info"))),
            "final_recipe_confidence": F.when(~F.col("is_recipe"), F.lit(0.0))
            .when(
                _has(f, "final_recipe_confidence", "recipe_confidence"),
                _score(_pick(f, "final_recipe_confidence", "recipe_confidence")),
            )
            .otherwise(F.col("caption_completeness_score")),
            "final_recipe_language": F.when(
                _has(f, "final_recipe_language", "lang"), _language(_pick(f, "final_recipe_language", "lang"))
            ).otherwise(F.col("lang")),
        })
        .withColumn(
            "final_recipe_json",
            fill_recipe_json(
                _text(_pick(f, "final_recipe_json", "recipe_json")),
                "final_recipe_title", "ingredients", "missing_recipe_info",
            ),
        )
    )
    fields = [
        "lang", "is_veg", "cuisine", "ingredient", "ingredients", "is_recipe", "recipe_status",
        "has_ingredient_list", "has_instructions", "caption_completeness_score", "rejection_reason",
        "final_recipe_title", "final_recipe_text", "final_recipe_json", "missing_recipe_info",
        "final_recipe_confidence", "final_recipe_language",
    ]
    good = f.isNotNull()
    return staged.select(
        *keep,
        *[F.when(good, F.col(c)).alias(c) for c in fields],
        F.when(~good, F.lit("answer is not an object or a one-item list")).alias("error"),
    )


#: members of a recipe object that are lists
LIST_MEMBERS = ("ingredients", "steps", "notes", "missing_info")


def json_items(body, member: str) -> Column:
    """Items of a list member of a JSON object, each as JSON; any other value but null is one item."""
    value = F.try_element_at(F.from_json(as_col(body), FIELD_MAP), F.lit(member))
    kind = F.schema_of_variant(value)
    items = F.when(kind.startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>")).when(kind != "VOID", F.array(value))
    return F.transform(F.coalesce(items, F.array().cast("array<variant>")), lambda v: F.to_json(v))


def with_json_items(body, lists: dict[str, Column]) -> Column:
    """The JSON object with some list members replaced, in its order; absent ones stay absent."""
    members = F.from_json(as_col(body), FIELD_MAP)

    def replaced(name: Column, value: Column) -> Column:
        out = value
        for member, items in lists.items():
            made = F.try_parse_json(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")))
            out = F.when(name == member, made).otherwise(out)
        return out

    return F.to_json(F.transform_values(members, replaced))


def merged_lists(rows: DataFrame, key: str, lists: list[str], order: list[str]) -> DataFrame:
    """Per key the union of list columns over its rows, in the order of the rows.

    A value that an earlier row holds is left out; a row's own repeats stay.  Values are brought
    together by key and value, combined before the shuffle, so no task gathers a
    key's rows; only the union itself is one array.
    """
    def placed(name: str) -> Column:
        own = F.transform(F.coalesce(F.col(name), F.array().cast("array<string>")), lambda v, i: F.struct(v.alias("value"), i.alias("at")))
        return F.transform(own, lambda x: F.struct(F.lit(name).alias("list"), x["value"].alias("value"), x["at"].alias("at")))

    items = rows.select(key, F.struct(*order).alias("_row"), F.explode(F.concat(*map(placed, lists))).alias("_x")).select(
        key, "_row", "_x.list", "_x.value", "_x.at")
    own = items.groupBy(key, "list", "value", "_row").agg(F.sort_array(F.collect_list("at")).alias("at"))  # one row's repeats
    first = own.groupBy(key, "list", "value").agg(F.min(F.struct("_row", "at")).alias("_first"))
    found = first.select(key, "list", "value", "_first._row", F.explode("_first.at").alias("at"))
    union = lambda name: F.sort_array(F.collect_list(F.when(F.col("list") == name, F.struct("_row", "at", "value"))))
    return found.groupBy(key).agg(*[F.transform(union(n), lambda x: x["value"]).alias(n) for n in lists])


def merged_answers(rows: DataFrame, key: str, order: list[Column], best: list[str], filled: dict[str, list],
                   any_of: list[str], most: list[str], lists: list[str], part: str = "part_no") -> DataFrame:
    """One row per key out of its answers to several parts.

    ``best`` columns come from the first row of ``order``; ``filled`` ones from the first row where
    they hold none of the given empty values; ``any_of`` are true when any row says so, ``most`` are maxima,
    ``lists`` unions in the order of the parts.  ``parts`` counts the parts.
    """
    ranked = rows.withColumn("_rank", F.struct(*[c.alias(f"r{i}") for i, c in enumerate(order)]))
    chosen = ranked.groupBy(key).agg(
        F.min_by(F.struct(*best), "_rank").alias("_best"),
        *[F.coalesce(F.min_by(c, F.when(F.col(c).isNotNull() & ~F.col(c).isin(empty), F.col("_rank"))), F.min_by(c, "_rank")).alias(c)
          for c, empty in filled.items()],
        *[F.max(F.coalesce(c, F.lit(False))).alias(c) for c in any_of], *[F.max(c).alias(c) for c in most],
    ).select(key, "_best.*", *filled, *any_of, *most)
    unions = merged_lists(ranked.withColumn("_part", F.array(F.col(part).cast("string"))), key, [*lists, "_part"], [part, "_rank"])
    return chosen.join(unions, key).withColumn("parts", F.size("_part")).drop("_part")


def _recipe_only(text: Column) -> Column:
    return F.when(F.col("is_recipe"), F.coalesce(text, F.lit(""))).otherwise(F.lit(""))
