"""Model answers, JSON arrays, ingredient and step lists, raw items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions import ingredients as I
from clipcatalog.functions import structured as V
from clipcatalog.operators import items
from clipcatalog.operators.answers import normalize_answers
from clipcatalog.operators.staging import computed
from clipcatalog.queries import duck as d
from clipcatalog.queries.registry import Inputs, query


@query("array_counts", """
SELECT raw_id, processed_at, CAST(coalesce(json_array_length(ingredients), 0) AS BIGINT) AS ingredient_count,
  CAST(coalesce(json_array_length(final_recipe_json, '$.steps'), 0) AS BIGINT) AS step_count,
  CAST(coalesce(json_array_length(missing_recipe_info), 0) AS BIGINT) AS missing_count FROM silver_fx""")
def _(t: Inputs):
    return t.fx("silver_fx").select(
        "raw_id", "processed_at", V.array_counts("ingredients").alias("ingredient_count"),
        V.array_counts(None, "final_recipe_json").alias("step_count"),
        V.array_counts("missing_recipe_info").alias("missing_count"))


_LENIENT = r"""CASE WHEN json_valid(response) THEN response
  WHEN json_valid(nullif(regexp_extract(response, '(?s)\{.*\}'), '')) THEN regexp_extract(response, '(?s)\{.*\}') END"""


@query("parse_json_lenient", f"SELECT raw_id, {_LENIENT} AS body FROM llm_fx")
def _(t: Inputs):
    return t.fx("llm_fx").select("raw_id", V.parse_json_lenient("response").alias("body"))


_BOOL = "CASE raw_id % 6 WHEN 0 THEN ' YES ' WHEN 1 THEN 'non-vegetarian' WHEN 2 THEN 'unclear' WHEN 3 THEN NULL ELSE description_enriched END"


def _coerced(default: str) -> str:
    x = f"lower({d.strip(_BOOL)})"
    return f"CASE WHEN {x} IN {d.in_list(vocab.ANSWER_TRUE)} THEN true WHEN {x} IN {d.in_list(vocab.ANSWER_FALSE)} THEN false ELSE {default} END"


@query("coerce_bool", f"SELECT raw_id, {_coerced('NULL')} AS nullable, {_coerced('true')} AS defaulted FROM captions_fx")
def _(t: Inputs):
    x = F.expr(_BOOL)
    return t.fx("captions_fx").select(
        "raw_id", V.coerce_bool(x).alias("nullable"), V.coerce_bool(x, True).alias("defaulted"))


@query("coerce_score", """
SELECT event_id, greatest(0.0, least(1.0, coalesce(try_cast(trim(x) AS DOUBLE), 0.0))) AS score
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'high' WHEN 1 THEN ' 0.25 ' WHEN 2 THEN CAST(value AS VARCHAR) ELSE NULL END AS x FROM events)""")
def _(t: Inputs):
    e = F.col("event_id") % 4
    x = F.when(e == 0, "high").when(e == 1, " 0.25 ").when(e == 2, F.col("value").cast("string"))
    return t.table("events").select("event_id", V.coerce_score(x).alias("score"))


@query("split_list", """
SELECT doc_id, array_to_string(regexp_split_to_array(text, '[,;|\\n]'), '^') AS parts,
  CAST(len(regexp_split_to_array(text, '[,;|\\n]')) AS BIGINT) AS n FROM documents""".replace("\\\\", "\\"))
def _(t: Inputs):
    parts = V.split_list("text")
    return t.table("documents").select(
        "doc_id", F.array_join(parts, "^").alias("parts"), F.size(parts).cast("bigint").alias("n"))


def _items(lower: bool) -> str:
    one = f"trim(x, {d.WS})"
    kept = f"list_transform(regexp_split_to_array(text, '[,;|\\n]'), lambda x: {'lower(' + one + ')' if lower else one})"
    kept = f"list_filter({kept}, lambda x: x <> '' AND lower(x) NOT IN {d.in_list(vocab.LIST_PLACEHOLDERS)})"
    return d.distinct_in_order(kept)


@query("normalize_string_list", f"""
SELECT doc_id, array_to_string({_items(False)}, '^') AS items, array_to_string({_items(True)}, '^') AS ingredients,
  CASE WHEN doc_id % 2 = 0 THEN 'rice' ELSE '' END AS fallback FROM documents""")
def _(t: Inputs):
    empty = F.array().cast("array<string>")
    return computed(t.table("documents"), {"parts": V.split_list("text")}, ["doc_id"]).select(
        "doc_id", F.array_join(V.normalize_string_list("parts"), "^").alias("items"),
        F.array_join(V.normalize_string_list("parts", F.lit("rice")), "^").alias("ingredients"),
        F.array_join(
            V.normalize_string_list(empty, F.when(F.col("doc_id") % 2 == 0, "rice").otherwise("unknown")), "^"
        ).alias("fallback"))


@query("normalize_status", f"""
WITH s AS (SELECT raw_id, processed_at, is_recipe, caption_completeness_score AS c,
  CASE raw_id % 4 WHEN 0 THEN ' Full Recipe ' WHEN 1 THEN 'NON-RECIPE' WHEN 2 THEN 'other' ELSE NULL END AS s FROM silver_fx)
SELECT raw_id, processed_at, CASE WHEN replace(replace(lower(trim(s)), ' ', '_'), '-', '_') IN {d.in_list(vocab.RECIPE_STATUSES)}
    THEN replace(replace(lower(trim(s)), ' ', '_'), '-', '_')
  WHEN coalesce(is_recipe, false) AND c >= 0.75 THEN 'full_recipe' WHEN coalesce(is_recipe, false) THEN 'partial_recipe'
  ELSE 'food_content' END AS status FROM s""")
def _(t: Inputs):
    r = F.col("raw_id") % 4
    s = F.when(r == 0, " Full Recipe ").when(r == 1, "NON-RECIPE").when(r == 2, "other")
    return t.fx("silver_fx").select(
        "raw_id", "processed_at", V.normalize_status(s, "is_recipe", "caption_completeness_score").alias("status"))


@query("fill_recipe_json", """
SELECT raw_id, processed_at,
  coalesce(final_recipe_json->>'$.title', nullif(final_recipe_title, ''), 'Untitled recipe') AS title,
  CAST(coalesce(json_array_length(final_recipe_json, '$.steps'), 0) AS BIGINT) AS steps,
  2::BIGINT AS ingredients, 0::BIGINT AS notes, 1::BIGINT AS missing_info, 5::BIGINT AS members FROM silver_fx""")
def _(t: Inputs):
    filled = V.fill_recipe_json("final_recipe_json", "final_recipe_title", F.array(F.lit("a"), F.lit("b")), F.array(F.lit("m")))
    rows = t.fx("silver_fx").select("raw_id", "processed_at", filled.alias("j"))

    def size(name):
        return F.json_array_length(F.get_json_object("j", f"$.{name}")).cast("bigint").alias(name)

    return rows.select(
        "raw_id", "processed_at", F.get_json_object("j", "$.title").alias("title"), size("steps"), size("ingredients"),
        size("notes"), size("missing_info"), F.size(F.json_object_keys("j")).cast("bigint").alias("members"))


_EXPECTED = """
WITH e AS (SELECT raw_id, raw_id % 7 AS k, response FROM llm_fx)
SELECT raw_id,
  CASE k WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'es' WHEN 3 THEN 'unknown' WHEN 4 THEN 'ar' WHEN 5 THEN 'it' END AS lang,
  CASE k WHEN 0 THEN true WHEN 1 THEN true WHEN 6 THEN NULL ELSE false END AS is_veg,
  CASE k WHEN 0 THEN 'thai' WHEN 1 THEN 'french' WHEN 2 THEN 'mexican' WHEN 6 THEN NULL ELSE 'unknown' END AS cuisine,
  CASE k WHEN 0 THEN 'rice' WHEN 1 THEN 'mushroom' WHEN 2 THEN 'pollo' WHEN 6 THEN NULL ELSE 'unknown' END AS ingredient,
  CASE k WHEN 0 THEN 'rice' WHEN 1 THEN 'mushroom' WHEN 2 THEN 'pollo' WHEN 5 THEN 'burro,farina,sale' WHEN 6 THEN NULL ELSE '' END AS ingredients,
  CASE k WHEN 0 THEN true WHEN 4 THEN true WHEN 5 THEN true WHEN 6 THEN NULL ELSE false END AS is_recipe,
  CASE k WHEN 0 THEN 'full_recipe' WHEN 4 THEN 'partial_recipe' WHEN 5 THEN 'partial_recipe' WHEN 6 THEN NULL ELSE 'food_content' END AS recipe_status,
  CASE k WHEN 5 THEN true WHEN 6 THEN NULL ELSE false END AS has_ingredient_list,
  CASE k WHEN 0 THEN true WHEN 3 THEN true WHEN 4 THEN true WHEN 6 THEN NULL ELSE false END AS has_instructions,
  CASE k WHEN 0 THEN 0.8 WHEN 3 THEN 1.0 WHEN 4 THEN 0.7 WHEN 6 THEN NULL ELSE 0.0 END::DOUBLE AS completeness,
  CASE k WHEN 5 THEN trim(response->>'$.recipe_title') WHEN 6 THEN NULL ELSE '' END AS final_recipe_title,
  CASE k WHEN 5 THEN trim(response->>'$.recipe_text') WHEN 6 THEN NULL ELSE '' END AS final_recipe_text,
  CASE k WHEN 2 THEN 'time,oven,salt' WHEN 6 THEN NULL ELSE '' END AS missing_info,
  CASE k WHEN 0 THEN 0.8 WHEN 4 THEN 0.7 WHEN 6 THEN NULL ELSE 0.0 END::DOUBLE AS final_recipe_confidence,
  CASE k WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'es' WHEN 3 THEN 'unknown' WHEN 4 THEN 'ar' WHEN 5 THEN 'it' END AS final_recipe_language,
  CASE k WHEN 4 THEN 'T' WHEN 5 THEN trim(response->>'$.recipe_title') WHEN 6 THEN NULL ELSE 'Untitled recipe' END AS json_title,
  k = 6 AS failed FROM e"""


@query("normalize_llm_response", _EXPECTED.replace("response->>", "(CASE WHEN json_valid(response) THEN response END)->>"))
def _(t: Inputs):
    out = normalize_answers(t.fx("llm_fx"), "response")
    return out.select(
        "raw_id", "lang", "is_veg", "cuisine", "ingredient", F.array_join("ingredients", ",").alias("ingredients"),
        "is_recipe", "recipe_status", "has_ingredient_list", "has_instructions",
        F.col("caption_completeness_score").alias("completeness"), "final_recipe_title", "final_recipe_text",
        F.array_join("missing_recipe_info", ",").alias("missing_info"), "final_recipe_confidence",
        "final_recipe_language", F.get_json_object("final_recipe_json", "$.title").alias("json_title"),
        F.col("error").isNotNull().alias("failed"))


@query("processing_confidence", f"""
WITH s AS (SELECT raw_id, processed_at, {d.staging_language('recipe_language')} AS l, coalesce(is_recipe, false) AS r,
  has_ingredient_list AS a, coalesce(has_instructions, false) AS b, {d.clamp('caption_completeness_score')} AS c FROM silver_fx)
SELECT raw_id, processed_at, round(greatest(0.1::DOUBLE, least(1.0::DOUBLE,
  (CASE WHEN l <> 'unknown' THEN 0.25::DOUBLE ELSE 0 END) + (CASE WHEN r THEN 0.25::DOUBLE ELSE 0 END) + (CASE WHEN a THEN 0.2::DOUBLE ELSE 0 END)
  + (CASE WHEN b THEN 0.2::DOUBLE ELSE 0 END) + 0.1::DOUBLE * c)), 9) AS confidence FROM s""")
def _(t: Inputs):
    from clipcatalog.functions.columns import clamp01, is_true, normalize_language_code

    return t.fx("silver_fx").select("raw_id", "processed_at", F.round(V.processing_confidence(
        normalize_language_code("recipe_language"), is_true("is_recipe"), "has_ingredient_list",
        is_true("has_instructions"), clamp01("caption_completeness_score")), 9).alias("confidence"))


@query("prompt_payload", f"""
SELECT raw_id, CAST(to_json({{'source': 'social_recipe_video', 'original_caption': {d.strip("coalesce(nullif(title, ''), description)")},
  'recovered_text': {d.strip("coalesce(recovered_text, '')")}, 'evidence_text': {d.strip("coalesce(nullif(evidence_text, ''), description)")},
  'evidence_quality_score': 0.5::DOUBLE, 'instruction': 'Answer.'}}) AS VARCHAR) AS prompt FROM captions_fx""")
def _(t: Inputs):
    return t.fx("captions_fx").select("raw_id", V.prompt_payload(
        "title", "description", "recovered_text", "evidence_text", F.lit(0.5), "Answer.", "social_recipe_video"
    ).alias("prompt"))


@query("quality_score", "SELECT raw_id, recipe_quality_score FROM int_quality")
def _(t: Inputs):
    from clipcatalog.queries.built import quality

    return quality(t).select("raw_id", "recipe_quality_score")


@query("quality_grade", "SELECT raw_id, recipe_quality_grade FROM int_quality")
def _(t: Inputs):
    from clipcatalog.queries.built import quality

    return quality(t).select("raw_id", "recipe_quality_grade")


_LIST = """
  CASE raw_id % 8 WHEN 0 THEN ['2 cups flour', 'Flour', '{"name":"egg","quantity":3}', 'egg', 'salt']
   WHEN 1 THEN ['{"name":"rice","quantity":200,"unit":"g","notes":"washed"}', '{"ingredient":"oil"}', 'rice', NULL]
   WHEN 2 THEN list_transform(string_split(ingredients, ','), lambda x: trim(x))
   WHEN 3 THEN ['butter', '2 eggs', 'eggs'] WHEN 4 THEN ['tomato', '3 tomato', 'basil (fresh)'] WHEN 6 THEN [ingredients]
   ELSE []::VARCHAR[] END"""


@query("coerce_list_field", f"""
WITH l AS (SELECT raw_id, {_LIST} AS items FROM ingredients_fx)
SELECT raw_id, array_to_string(list_transform(items, lambda x: coalesce(x, '<null>')), '^') AS items, CAST(len(items) AS BIGINT) AS n FROM l""")
def _(t: Inputs):
    found = I.coerce_list_field("ingredients")
    return t.fx("ingredients_fx").select(
        "raw_id", F.array_join(found, "^", "<null>").alias("items"), F.size(found).cast("bigint").alias("n"))


@query("coerce_list_field_nested", """
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(lower(text), '[a-z]{3,9}')[1:4], []) AS words FROM documents)
SELECT doc_id, CASE WHEN len(words) = 0 AND doc_id % 6 = 1 THEN '{"items":[]}' WHEN len(words) = 0 AND doc_id % 6 = 2 THEN '{"items":[]}'
  ELSE array_to_string(words, '^') END AS items FROM w""")
def _(t: Inputs):
    """Lists of the texts' own words, wrapped in objects and in quotes, several deep."""
    words = F.slice(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]{3,9}"), F.lit(0)), 1, 4)
    body, wrap = F.to_json(words), lambda name, x: F.concat(F.lit(f'{{"x":1,"{name}":'), x, F.lit("}"))
    quoted = lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", "")
    kind = F.col("doc_id") % 6
    given = (
        F.when(kind == 0, body).when(kind == 1, wrap("items", body)).when(kind == 2, wrap("values", wrap("ingredients", wrap("items", body))))
        .when(kind == 3, quoted(quoted(body))).when(kind == 4, wrap("ingredients", quoted(wrap("items", quoted(body)))))
        .otherwise(wrap("values", wrap("items", quoted(F.array_join(words, ", ")))))
    )
    rows = computed(t.table("documents"), {"given": given}, ["doc_id"])
    return rows.select("doc_id", F.array_join(I.coerce_list_field("given"), "^").alias("items"))


_SHOWN = """
  CASE raw_id % 8 WHEN 0 THEN ['2 cups flour', 'Flour', '3 egg', 'egg', 'salt']
   WHEN 1 THEN ['200 g rice (washed)', 'oil', 'rice', 'None']
   WHEN 2 THEN list_transform(string_split(ingredients, ','), lambda x: trim(x))
   WHEN 3 THEN ['butter', '2 eggs', 'eggs'] WHEN 4 THEN ['tomato', '3 tomato', 'basil (fresh)'] WHEN 6 THEN ['1 l milk']
   ELSE []::VARCHAR[] END"""


@query("format_ingredient", f"""
WITH l AS (SELECT raw_id, {_SHOWN} AS items FROM ingredients_fx)
SELECT raw_id, array_to_string(items, '^') AS shown FROM l""")
def _(t: Inputs):
    return t.fx("ingredients_fx").select(
        "raw_id", F.array_join(F.transform(I.coerce_list_field("ingredients"), I.format_ingredient), "^").alias("shown"))


# three different words of a text that do not hold each other and are no measure words
_THREE = f"""
w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z]{{5,9}}')) AS many, regexp_extract_all(lower(text), '[a-z]{{5,9}}') AS words FROM documents),
o AS (SELECT doc_id, {d.distinct_in_order("words")} AS u FROM w WHERE len(many) >= 3),
t AS (SELECT doc_id, u[1] AS a, u[2] AS b, u[3] AS c FROM o WHERE NOT (contains(u[1], u[2]) OR contains(u[2], u[1]) OR contains(u[1], u[3])
  OR contains(u[3], u[1]) OR contains(u[2], u[3]) OR contains(u[3], u[2]))
  AND len(list_filter(u[1:3], lambda x: regexp_full_match(x, '({vocab.INGREDIENT_NOISE_WORDS.replace(chr(39), chr(39) * 2)})'))) = 0)"""


def _three_words(t: Inputs):
    u = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]{5,9}"), F.lit(0)))
    rows = computed(t.table("documents"), {"u": F.slice(u, 1, 3)}, ["doc_id"]).filter(F.size("u") == 3)
    rows = rows.select("doc_id", *[F.get("u", i).alias(n) for i, n in enumerate("abc")])
    held = [F.contains(F.col(x), F.col(y)) for x in "abc" for y in "abc" if x != y]
    noise = [F.col(x).rlike(f"^({vocab.INGREDIENT_NOISE_WORDS})$") for x in "abc"]
    return rows.filter(~reduce(lambda p, q: p | q, held + noise))


@query("format_ingredient_words", f"""
WITH {_THREE} SELECT doc_id, (doc_id % 9 + 1) || ' ' || b || ' ' || a || ' (' || c || ')^' || c || '^2 ' || b || '^' || a AS shown FROM t""")
def _(t: Inputs):
    items = F.array(
        F.to_json(F.struct(F.col("a").alias("name"), (F.col("doc_id") % 9 + 1).alias("quantity"), F.col("b").alias("unit"), F.col("c").alias("notes"))),
        F.to_json(F.struct(F.col("c").alias("ingredient"))),
        F.to_json(F.struct(F.col("b").alias("name"), F.lit("2").alias("quantity"))), F.col("a"))
    return _three_words(t).select("doc_id", F.array_join(F.transform(items, I.format_ingredient), "^").alias("shown"))


@query("merge_similar_words", f"""
WITH {_THREE} SELECT doc_id, '2 cups ' || a || '^3 ' || b || '^' || c || ' (fresh)' AS merged FROM t""")
def _(t: Inputs):
    """Weaker entries of the same ingredient go, whichever comes first."""
    given = F.to_json(F.array(
        F.concat(F.lit("2 cups "), "a"), F.initcap("a"), F.col("b"), F.concat(F.lit("3 "), "b"), F.concat("c", F.lit(" (fresh)")), F.col("c")))
    lists = computed(_three_words(t), {"items": I.coerce_list_field(given)}, ["doc_id"])
    return lists.select("doc_id", F.array_join(I.merge_similar_ingredients("items", F.array(F.lit("water"))), "^").alias("merged"))


def _key(x: str) -> str:
    out = rf"regexp_replace(lower({x}), '\([^)]*\)', '', 'g')"
    out = rf"regexp_replace({out}, '\b[0-9]+([.,][0-9]+)?\b', '', 'g')"
    out = rf"regexp_replace({out}, '\b({vocab.INGREDIENT_NOISE_WORDS.replace(chr(39), chr(39) * 2)})\b', ' ', 'g')"
    out = f"trim(regexp_replace({out}, '[^a-zà-ÿ0-9]+', ' ', 'g'))"
    return f"coalesce(nullif({out}, ''), trim(lower({x})))"


@query("ingredient_key", f"""
SELECT raw_id, {_key("'2 cups ' || title || ' (fresh, 3) de farine'")} AS key, {_key("CAST(raw_id AS VARCHAR)")} AS number_key FROM ingredients_fx""")
def _(t: Inputs):
    phrase = F.concat(F.lit("2 cups "), "title", F.lit(" (fresh, 3) de farine"))
    return t.fx("ingredients_fx").select(
        "raw_id", I.ingredient_key(phrase).alias("key"), I.ingredient_key(F.col("raw_id").cast("string")).alias("number_key"))


@query("merge_similar_ingredients", """
SELECT raw_id, CASE raw_id % 8 WHEN 0 THEN '2 cups flour^3 egg^salt' WHEN 1 THEN '200 g rice (washed)^oil'
   WHEN 2 THEN array_to_string(list_transform(string_split(ingredients, ','), lambda x: trim(x)), '^')
   WHEN 3 THEN 'butter^2 eggs' WHEN 4 THEN '3 tomato^basil (fresh)' WHEN 6 THEN '1 l milk' ELSE 'water' END AS merged,
  CASE raw_id % 8 WHEN 0 THEN '2 cups flour^3 egg' WHEN 1 THEN '200 g rice (washed)^oil' WHEN 2 THEN 'flour^sugar'
   WHEN 3 THEN 'butter^2 eggs' WHEN 4 THEN '3 tomato^basil (fresh)' WHEN 6 THEN '1 l milk' ELSE 'water' END AS first_two
FROM ingredients_fx""")
def _(t: Inputs):
    lists = computed(t.fx("ingredients_fx"), {"items": I.coerce_list_field("ingredients")}, ["raw_id"])
    merged = I.merge_similar_ingredients("items", F.array(F.lit("water"), F.lit("Unknown")))
    rows = computed(lists, {"m": merged}, ["raw_id"])
    return rows.select("raw_id", F.array_join("m", "^").alias("merged"),
                       F.array_join(I.ingredient_preview("m", 2), "^").alias("first_two"))


@query("format_steps", """
SELECT doc_id, 'Mix it^' || source || '^' || lang || '^plain' AS steps FROM documents""")
def _(t: Inputs):
    steps = F.array(
        F.lit('{"instruction":"Mix it","n":1}'),
        F.to_json(F.struct(F.lit("").alias("instruction"), F.col("source").alias("text"))),
        F.to_json(F.struct(F.col("lang").alias("other"))), F.lit("plain"))
    return t.table("documents").select("doc_id", F.array_join(I.format_steps(steps), "^").alias("steps"))


_ITEM_COLS = """
  substr(descr, 1, 120) AS TITLE, descr AS DESCRIPTION, 'https://www.tiktok.com/@' || who || '/video/' || id AS URL_TIKTOK, 'tiktok' AS PLATFORM,
  id AS CONTENT_ID, who AS CREATOR_USERNAME, 'https://www.tiktok.com/@' || who AS SOURCE_PLATFORM_URL"""


@query("item_from_raw_json", f"""
WITH j AS (SELECT event_id, json_valid(item) AS ok, trim(item->>'$.id') AS id, trim(item->>'$.desc') AS descr,
  coalesce(nullif(item->>'$.author.uniqueId', ''), nullif(item->>'$.author.unique_id', ''), nullif(item->>'$.author.nickname', ''), 'unknown_creator') AS who,
  CAST(item->>'$.createTime' AS BIGINT) AS made FROM raw_item_fx)
SELECT event_id, {_ITEM_COLS}, {d.language('descr')} AS RECIPE_LANGUAGE_HINT, '' AS CUISINE_HINT, '' AS MAIN_INGREDIENT_HINT,
  'true' AS DESCRIPTION_IS_PARTIAL, 'tiktokapi_discovery' AS DATA_ORIGIN,
  'https://www.tiktok.com/@' || who || '/video/' || id || CASE WHEN made IS NULL THEN '' ELSE '?published_at=' || strftime(epoch_ms(made * 1000), '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS VERIFICATION_SOURCE_URL,
  'tiktokapi_desc' AS DESCRIPTION_SOURCE, CAST(length(descr) AS VARCHAR) AS DESCRIPTION_LENGTH, 'false' AS DESCRIPTION_ENRICHED,
  descr AS ORIGINAL_DESCRIPTION, '' AS RECOVERED_TEXT, descr AS EVIDENCE_TEXT
FROM j WHERE id <> '' AND descr <> '' AND {d.signal('descr')}""")
def _(t: Inputs):
    return items.item_from_raw_json(t.fx("raw_item_fx"), "item", keep=["event_id"])


@query("reject_rows", f"""
WITH j AS (SELECT event_id, trim(item->>'$.id') AS id, trim(item->>'$.desc') AS descr,
  coalesce(nullif(item->>'$.author.uniqueId', ''), nullif(item->>'$.author.nickname', ''), 'unknown_creator') AS who FROM raw_item_fx)
SELECT event_id, 'hashtag' AS SOURCE_TYPE, 'foodtok' AS SOURCE_VALUE, coalesce(id, '') AS CONTENT_ID, who AS CREATOR_USERNAME,
  coalesce(descr, '') AS DESCRIPTION, 'missing_recipe_signal_or_required_fields' AS REJECT_REASON
FROM j WHERE NOT coalesce(id <> '' AND descr <> '' AND {d.signal('descr')}, false)""")
def _(t: Inputs):
    return items.reject_rows(t.fx("raw_item_fx"), "item", "hashtag", "foodtok", keep=["event_id"])
