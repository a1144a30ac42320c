"""Text functions over captions, conversations and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions import html as H
from clipcatalog.functions import text as X
from clipcatalog.functions.columns import display_title, language_label, title_case
from clipcatalog.functions.register import register_functions
from clipcatalog.operators.recovery import caption_upgrade
from clipcatalog.operators.staging import computed
from clipcatalog.queries import duck as d
from clipcatalog.queries.registry import Inputs, query


@query("normalize_evidence_text", f"SELECT doc_id, {d.evidence_text('text')} AS clean_text FROM documents")
def _(t: Inputs):
    return t.table("documents").select("doc_id", X.normalize_evidence_text("text").alias("clean_text"))


@query("normalize_caption", f"SELECT page_id, {d.caption('html')} AS caption FROM pages_fx")
def _(t: Inputs):
    return t.fx("pages_fx").select("page_id", X.normalize_caption("html").alias("caption"))


@query("alpha_ratio", f"SELECT raw_id, round({d.letters('description')}, 9) AS ratio FROM captions_fx")
def _(t: Inputs):
    return t.fx("captions_fx").select("raw_id", F.round(X.alpha_ratio("description"), 9).alias("ratio"))


@query("contains_any", f"""
SELECT raw_id, {d.any_of('lower(description)', vocab.RECIPE_WORDS)} AS recipe_word,
  {d.any_of('lower(description)', vocab.INGREDIENT_WORDS)} AS ingredient_word,
  {d.any_of('lower(description)', vocab.COOKING_VERBS)} AS cooking_verb FROM captions_fx""")
def _(t: Inputs):
    low = F.lower("description")
    return t.fx("captions_fx").select(
        "raw_id",
        X.contains_any(low, vocab.RECIPE_WORDS).alias("recipe_word"),
        X.contains_any(low, vocab.INGREDIENT_WORDS).alias("ingredient_word"),
        X.contains_any(low, vocab.COOKING_VERBS).alias("cooking_verb"),
    )


@query("has_quantity", f"SELECT raw_id, {d.quantity('lower(description)')} AS quantity FROM captions_fx")
def _(t: Inputs):
    return t.fx("captions_fx").select("raw_id", X.has_quantity("description").alias("quantity"))


@query("evidence_score", f"""
WITH n AS (SELECT raw_id, creator_username, {d.evidence_text('description')} AS x FROM captions_fx)
SELECT raw_id, {d.score('x')} AS score,
  {d.score('x', creator="CASE WHEN raw_id % 3 = 0 THEN '@FitWaffle' ELSE creator_username END",
           hashtag_hit="list_has_any(" + d.hashtags('x') + ", ['" + "','".join(vocab.RECIPE_HASHTAGS) + "'])")} AS score_with_hints
FROM n""")
def _(t: Inputs):
    creator = F.when(F.col("raw_id") % 3 == 0, "@FitWaffle").otherwise(F.col("creator_username"))
    rows = computed(t.fx("captions_fx").withColumn("creator", creator), {"x": X.normalize_evidence_text("description")}, ["raw_id", "creator"])
    return rows.select(
        "raw_id", X.evidence_score("x", normalized=True).alias("score"),
        X.evidence_score("x", X.content_hashtags("x"), "creator", normalized=True).alias("score_with_hints"),
    )


@query("evidence_class", f"""
WITH s AS (SELECT raw_id, {d.score(d.evidence_text('description'))} AS s FROM captions_fx)
SELECT raw_id, {d.klass('s')} AS evidence_class FROM s""")
def _(t: Inputs):
    return t.fx("captions_fx").select("raw_id", X.evidence_class(X.evidence_score("description")).alias("evidence_class"))


@query("usable_ocr", f"""
WITH n AS (SELECT raw_id, {d.evidence_text('description')} AS x FROM captions_fx)
SELECT raw_id, {d.ocr_ok('x')} AS usable FROM n""")
def _(t: Inputs):
    return t.fx("captions_fx").select("raw_id", X.usable_ocr("description").alias("usable"))


@query("infer_language", f"""
SELECT raw_id, {d.language('description')} AS language,
  {d.language("concat(title, ' ', description)", vocab.SEED_LANGUAGE_MARKERS)} AS seed_language FROM captions_fx""")
def _(t: Inputs):
    return t.fx("captions_fx").select(
        "raw_id", X.infer_language("description").alias("language"),
        X.infer_language(F.concat("title", F.lit(" "), "description"), vocab.SEED_LANGUAGE_MARKERS).alias("seed_language"),
    )


@query("script_profile", f"""
WITH j AS (SELECT raw_id, concat(coalesce(description, ''), ' ', coalesce(recovered_text, ''), ' ', coalesce(evidence_text, ''),
    CASE WHEN raw_id % 9 = 0 THEN ' وصفة' ELSE '' END) AS x FROM captions_fx)
SELECT raw_id, CASE WHEN regexp_matches(x, '[\\x{{0600}}-\\x{{06FF}}]') OR {d.language('x')} = 'ar'
  THEN 'ar,en|en,fr,es,it,pt' ELSE 'en,fr,es,it,pt' END AS profiles FROM j""".replace("\\\\", "\\"))
def _(t: Inputs):
    extra = F.concat(F.coalesce("evidence_text", F.lit("")), F.when(F.col("raw_id") % 9 == 0, " وصفة").otherwise(""))
    return t.fx("captions_fx").select(
        "raw_id", F.array_join(X.script_profile("description", "recovered_text", extra), "|").alias("profiles"))


@query("recipe_signal", f"SELECT raw_id, {d.signal('description')} AS signal FROM captions_fx")
def _(t: Inputs):
    return t.fx("captions_fx").select("raw_id", X.recipe_signal("description").alias("signal"))


@query("extract_urls", f"""
WITH u AS (SELECT raw_id, {d.urls("concat(coalesce(description, ''), ' ', coalesce(recovered_text, ''), ' ', coalesce(evidence_text, ''))")} AS urls FROM captions_fx)
SELECT raw_id, array_to_string({d.distinct_in_order('urls')}, ' ') AS urls, len(urls) > 0 AS has_link FROM u""")
def _(t: Inputs):
    parts = ("description", "recovered_text", "evidence_text")
    return t.fx("captions_fx").select(
        "raw_id", F.array_join(X.extract_urls(X.joined_evidence(*parts)), " ").alias("urls"),
        X.has_external_link(*parts).alias("has_link"),
    )


def _blocks_dropped(x: str, *tags: str) -> str:
    for tag in tags:
        x = f"regexp_replace({x}, '(?is)<{tag}[^>]*>.*?</{tag}>', ' ', 'g')"
    return x


@query("page_text", rf"""
WITH m AS (SELECT page_id, string_split(regexp_replace(regexp_replace(
    replace({_blocks_dropped("coalesce(html, '')", 'script', 'style', 'noscript', 'svg')}, chr(1), ''),
    '(?is)<(?:p|li|h1|h2|h3)(?:\s[^>]*)?>', chr(1) || '+', 'g'), '(?is)</(?:p|li|h1|h2|h3)>', chr(1) || '-', 'g'), chr(1)) AS x FROM pages_fx),
p AS (SELECT page_id, unnest(x) AS piece, generate_subscripts(x, 1) AS i FROM m),
s AS (SELECT *, sum(CASE WHEN i = 1 THEN 0 WHEN starts_with(piece, '+') THEN 1 ELSE -1 END) OVER (PARTITION BY page_id ORDER BY i) AS total FROM p),
k AS (SELECT *, i > 1 AND total > least(0, min(total) OVER (PARTITION BY page_id ORDER BY i)) AS inside,
  {d.strip("regexp_replace(substr(piece, 2), '<[^>]+>', ' ', 'g')")} AS part FROM s),
j AS (SELECT page_id, coalesce(string_agg(part, chr(10) ORDER BY i) FILTER (WHERE inside AND part <> ''), '') AS body FROM k GROUP BY page_id)
SELECT page_id, {d.caption('body')} AS page_text FROM j""")
def _(t: Inputs):
    return t.fx("pages_fx").select("page_id", H.page_text("html").alias("page_text"))


_META = [
    r"""(?is)<meta[^>]+property=["'']og:description["''][^>]+content=["''](.*?)["'']""",
    r"""(?is)<meta[^>]+name=["'']description["''][^>]+content=["''](.*?)["'']""",
    r"""(?is)<meta[^>]+content=["''](.*?)["''][^>]+property=["'']og:description["'']""",
    r"""(?is)<meta[^>]+content=["''](.*?)["''][^>]+name=["'']description["'']""",
]


@query("meta_descriptions", f"""
WITH m AS (SELECT page_id, list_concat({", ".join(f"regexp_extract_all(html, '{p}', 1)" for p in _META)}) AS found FROM pages_fx)
SELECT page_id, array_to_string(list_transform(found, lambda v: {d.caption('v')}), ' | ') AS descriptions,
  CAST(len(found) AS BIGINT) AS n FROM m""")
def _(t: Inputs):
    found = H.meta_descriptions("html")
    return t.fx("pages_fx").select(
        "page_id", F.array_join(found, " | ").alias("descriptions"), F.size(found).cast("bigint").alias("n"))


_SCRIPT = r"""(?is)<script[^>]+id=["'']SIGI_STATE["''][^>]*>(.*?)</script>"""


@query("json_script", f"""
WITH s AS (SELECT page_id, nullif({d.strip(d.decode(f"regexp_extract(html, '{_SCRIPT}', 1)"))}, '') AS body FROM pages_fx)
SELECT page_id, CASE WHEN json_valid(body) THEN body END AS body FROM s""")
def _(t: Inputs):
    return t.fx("pages_fx").select("page_id", H.json_script("html", "SIGI_STATE").alias("body"))


@query("json_caption_walk", f"""
WITH s AS (SELECT page_id, nullif({d.strip(d.decode(f"regexp_extract(html, '{_SCRIPT}', 1)"))}, '') AS body FROM pages_fx)
SELECT page_id, CASE WHEN NOT coalesce(json_valid(body), false) THEN ''
  ELSE concat_ws(' | ', body->>'$.desc', body->>'$.x[0].title') END AS captions FROM s""")
def _(t: Inputs):
    rows = t.fx("pages_fx").select("page_id", H.json_script("html", "SIGI_STATE").alias("body"))
    return rows.select("page_id", F.array_join(H.json_caption_walk("body", "page_id"), " | ").alias("captions"))


@query("strip_tags", f"""
SELECT page_id, {d.caption("regexp_replace(" + _blocks_dropped('html', 'script', 'style') + ", '<[^>]+>', ' ', 'g')")} AS plain
FROM pages_fx""")
def _(t: Inputs):
    return t.fx("pages_fx").select("page_id", H.strip_tags("html").alias("plain"))


@query("caption_upgrade", f"""
WITH r AS (
  SELECT raw_id, title, CASE WHEN raw_id % 2 = 0 THEN 'short one' ELSE description END AS description,
    CASE WHEN raw_id % 3 = 0 THEN 'first text' ELSE '' END AS original_description, '' AS recovered_text,
    'old' AS evidence_text, 'en' AS language_hint, 'true' AS description_is_partial,
    CASE WHEN raw_id % 5 = 0 THEN '' ELSE 'seed' END AS data_origin, 'api' AS description_source,
    'x' AS description_length, 'false' AS description_enriched FROM captions_fx),
c AS (SELECT raw_id, description AS cap FROM captions_fx WHERE evidence_text IS NOT NULL),
j AS (SELECT r.*, c.cap, coalesce(length(r.description) < 80 AND length(c.cap) > length(r.description), false) AS hit,
    coalesce(nullif(r.original_description, ''), r.description) AS orig FROM r LEFT JOIN c ON r.raw_id = c.raw_id)
SELECT raw_id, CASE WHEN hit THEN substr(cap, 1, 120) ELSE title END AS title,
  CASE WHEN hit THEN cap ELSE description END AS description,
  CASE WHEN hit THEN orig ELSE original_description END AS original_description,
  CASE WHEN hit THEN CASE WHEN cap <> orig THEN cap ELSE '' END ELSE recovered_text END AS recovered_text,
  CASE WHEN hit THEN concat_ws(E'\\n\\n', nullif(orig, ''), CASE WHEN cap <> orig THEN cap END) ELSE evidence_text END AS evidence_text,
  CASE WHEN hit THEN {d.language('cap')} ELSE language_hint END AS language_hint,
  CASE WHEN hit THEN CASE WHEN length(cap) >= 80 THEN 'false' ELSE 'true' END ELSE description_is_partial END AS description_is_partial,
  CASE WHEN hit THEN coalesce(nullif(data_origin, ''), 'tiktokapi_discovery') || '+caption_enrichment' ELSE data_origin END AS data_origin,
  CASE WHEN hit THEN 'web_metadata' ELSE description_source END AS description_source,
  CASE WHEN hit THEN CAST(length(cap) AS VARCHAR) ELSE description_length END AS description_length,
  CASE WHEN hit THEN 'true' ELSE description_enriched END AS description_enriched FROM j""")
def _(t: Inputs):
    fx = t.fx("captions_fx")
    r = F.col("raw_id")
    rows = fx.select(
        "raw_id", "title", F.when(r % 2 == 0, "short one").otherwise(F.col("description")).alias("description"),
        F.when(r % 3 == 0, "first text").otherwise("").alias("original_description"), F.lit("").alias("recovered_text"),
        F.lit("old").alias("evidence_text"), F.lit("en").alias("language_hint"),
        F.lit("true").alias("description_is_partial"), F.when(r % 5 == 0, "").otherwise("seed").alias("data_origin"),
        F.lit("api").alias("description_source"), F.lit("x").alias("description_length"),
        F.lit("false").alias("description_enriched"),
    )
    captions = fx.filter("evidence_text IS NOT NULL").select(
        "raw_id", F.col("description").alias("caption"), F.lit("web_metadata").alias("source"))
    return caption_upgrade(rows, captions, "raw_id", 80)


@query("content_hashtags", f"""
SELECT raw_id, array_to_string({d.distinct_in_order(d.hashtags('description'))}, ' ') AS hashtags FROM captions_fx""")
def _(t: Inputs):
    return t.fx("captions_fx").select("raw_id", F.array_join(X.content_hashtags("description"), " ").alias("hashtags"))


@query("evidence_text_compose", r"""
SELECT raw_id, nullif(concat_ws(E'\n\n', nullif(title, ''), nullif(recovered_text, ''), nullif(evidence_text, '')), '') AS composed,
  nullif(nullif(title, '') || E'\n\n' || nullif(recovered_text, '') || E'\n\n' || nullif(evidence_text, ''), '') AS strict_composed
FROM captions_fx""")
def _(t: Inputs):
    parts = ("title", "recovered_text", "evidence_text")
    return t.fx("captions_fx").select(
        "raw_id", X.evidence_text_compose(*parts).alias("composed"),
        X.evidence_text_compose(*parts, strict_null=True).alias("strict_composed"))


def _clean_line(x: str) -> str:
    x = d.strip(rf"regexp_replace({x}, '^#{{1,6}}\s*', '')")
    x = d.strip(rf"regexp_replace({x}, '^\*\*(.*?)\*\*:?\s*$', '\1')")
    x = d.strip(rf"regexp_replace({x}, '^\*\*(.*?)\*\*', '\1')")
    return d.strip(rf"regexp_replace({x}, '^[-*]\s+', '')")


_LABELS = d.in_list(vocab.SECTION_LABELS)
_LINES = (
    f"list_filter(list_transform(list_filter(list_transform(string_split(recipe_text, chr(10)), lambda x: {d.strip('x')}), "
    f"lambda x: x <> ''), lambda x: {_clean_line('x')}), lambda x: {d.strip('trim(lower(x), chr(58))')} NOT IN {_LABELS})"
)


@query("clean_recipe_text", f"""
SELECT raw_id, {d.strip(f"array_to_string({_LINES}, chr(10))")} AS clean_text FROM ingredients_fx""")
def _(t: Inputs):
    return t.fx("ingredients_fx").select("raw_id", X.clean_recipe_text("recipe_text").alias("clean_text"))


@query("recipe_intro", f"""
WITH l AS (SELECT raw_id, title, list_filter({_LINES}, lambda x: lower(x) <> lower(title)) AS lines FROM ingredients_fx),
i AS (SELECT raw_id, coalesce(lines[1], '') AS intro, coalesce(lines[3], '') AS third FROM l)
SELECT raw_id, intro, CASE WHEN length(third) > 135 THEN substr(third, 1, 127) || '...' ELSE third END AS preview FROM i""")
def _(t: Inputs):
    third = F.coalesce(
        F.try_element_at(F.filter(X.recipe_lines("recipe_text"), lambda x: F.lower(x) != F.lower("title")), F.lit(3)),
        F.lit(""))
    return t.fx("ingredients_fx").select(
        "raw_id", X.recipe_intro("recipe_text", "title").alias("intro"), X.preview(third).alias("preview"))


@query("display_title", r"""
SELECT raw_id, processed_at, trim(regexp_replace(coalesce(nullif(final_recipe_title, ''), original_title), '\s+', ' ', 'g')) AS display_title
FROM silver_fx""")
def _(t: Inputs):
    return t.fx("silver_fx").select(
        "raw_id", "processed_at", display_title("final_recipe_title", "original_title").alias("display_title"))


@query("title_case", f"""
SELECT raw_id, processed_at, {d.title_case('cuisine_style')} AS cuisine_style, {d.title_case('main_ingredient')} AS main_ingredient
FROM silver_fx""")
def _(t: Inputs):
    return t.fx("silver_fx").select(
        "raw_id", "processed_at", title_case("cuisine_style").alias("cuisine_style"),
        title_case("main_ingredient").alias("main_ingredient"))


@query("language_label", f"""
SELECT doc_id, CASE lower(lang) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.LANGUAGE_LABELS.items())}
  ELSE CASE WHEN length(lang) <= 3 THEN upper(lang) ELSE lang END END AS language_label FROM documents""")
def _(t: Inputs):
    return t.table("documents").select("doc_id", language_label("lang").alias("language_label"))


@query("register_functions", f"""
SELECT raw_id, round({d.letters('description')}, 9) AS ratio, {d.quantity('lower(description)')} AS quantity,
  {d.video_id('url')} AS video_id, {d.content_key('content_id', 'url')} AS content_key, {d.evidence_text('description')} AS clean_text
FROM captions_fx""")
def _(t: Inputs):
    register_functions(t.spark)
    t.fx("captions_fx").createOrReplaceTempView("captions_for_functions")
    return t.spark.sql("""
        SELECT raw_id, round(clip_alpha_ratio(description), 9) AS ratio, clip_has_quantity(description) AS quantity,
          clip_video_id(url) AS video_id, clip_content_key(content_id, url) AS content_key,
          clip_strip_ws(clip_nfkc(description)) AS clean_text
        FROM captions_for_functions""")
