"""Group-by reports and ordered text roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.operators import rollups as A
from clipcatalog.operators import upsert as U
from clipcatalog.queries import built
from clipcatalog.queries import duck as d
from clipcatalog.queries.q_joins import NOW_SQL, now
from clipcatalog.queries.registry import Inputs, query
from clipcatalog.sources.session import landed


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def _rollup_sql(dim: str, distincts: dict[str, str], flag: bool = True) -> str:
    parts = [f"{dim}", "count(*) AS recipe_count"]
    if flag:
        parts.append("count(*) FILTER (is_vegetarian) AS vegetarian_count")
    parts.append("round(avg(processing_confidence), 6) AS avg_processing_confidence")
    parts += [f"count(DISTINCT {c}) AS {n}" for c, n in distincts.items()]
    return f"SELECT {', '.join(parts)}, {NOW_SQL} AS generated_at FROM silver_fx GROUP BY {dim}"


@query("catalog_summary", f"""
SELECT count(*) AS total_recipes, count(*) FILTER (is_vegetarian) AS vegetarian_recipes, round(avg(processing_confidence), 6) AS avg_processing_confidence,
  count(DISTINCT recipe_language) AS distinct_languages, count(DISTINCT cuisine_style) AS distinct_cuisines,
  count(DISTINCT main_ingredient) AS distinct_main_ingredients, count(DISTINCT model_name) AS distinct_models, {NOW_SQL} AS generated_at FROM silver_fx""")
def _(t: Inputs):
    return _rounded(A.catalog_summary(
        t.fx("silver_fx"), "is_vegetarian", "processing_confidence",
        {"recipe_language": "distinct_languages", "cuisine_style": "distinct_cuisines",
         "main_ingredient": "distinct_main_ingredients", "model_name": "distinct_models"}, now()), "avg_processing_confidence")


@query("catalog_summary_lineitem", f"""
SELECT count(*) AS n_lines, count(*) FILTER (l_returnflag = 'R') AS returned, round(avg(l_extendedprice), 3) AS avg_price,
  count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts, {NOW_SQL} AS generated_at FROM lineitem""")
def _(t: Inputs):
    lines = t.table("lineitem").withColumn("returned", F.col("l_returnflag") == "R")
    return A.catalog_summary(
        lines, "returned", "l_extendedprice", {"l_suppkey": "suppliers", "l_partkey": "parts"}, now(),
        names=("n_lines", "returned", "avg_price")).withColumn("avg_price", F.round("avg_price", 3))


@query("rollup_by_cuisine", _rollup_sql("cuisine_style", {"recipe_language": "distinct_languages"}))
def _(t: Inputs):
    return _rounded(A.rollup_by_cuisine(t.fx("silver_fx"), now()), "avg_processing_confidence")


@query("rollup_by_ingredient", _rollup_sql("main_ingredient", {"recipe_language": "distinct_languages"}))
def _(t: Inputs):
    return _rounded(A.rollup_by_ingredient(t.fx("silver_fx"), now()), "avg_processing_confidence")


@query("rollup_by_language", _rollup_sql(
    "recipe_language", {"cuisine_style": "distinct_cuisines", "main_ingredient": "distinct_main_ingredients"}))
def _(t: Inputs):
    return _rounded(A.rollup_by_language(t.fx("silver_fx"), now()), "avg_processing_confidence")


@query("rollup_by_model", _rollup_sql(
    "model_name", {"recipe_language": "distinct_languages", "cuisine_style": "distinct_cuisines"}, flag=False))
def _(t: Inputs):
    return _rounded(A.rollup_by_model(t.fx("silver_fx"), now()), "avg_processing_confidence")


@query("rollup_lineitem_by_supplier", f"""
SELECT l_suppkey, count(*) AS n_lines, count(*) FILTER (l_returnflag = 'R') AS returned, round(avg(l_extendedprice), 4) AS avg_price,
  count(DISTINCT l_partkey) AS parts, {NOW_SQL} AS generated_at FROM lineitem GROUP BY l_suppkey""")
def _(t: Inputs):
    lines = t.table("lineitem").withColumn("is_returned", F.col("l_returnflag") == "R")
    out = A.rollup(lines, "l_suppkey", "l_extendedprice", {"l_partkey": "parts"}, now(), flag="is_returned",
                   count="n_lines", flagged="returned", average="avg_price")
    return out.withColumn("avg_price", F.round("avg_price", 4))


@query("evidence_rollup", """
SELECT raw_id, best_evidence_quality_score, round(avg_evidence_quality_score, 6) AS avg_evidence_quality_score, evidence_source_count,
  ocr_source_count, audio_source_count, comment_source_count, recipe_signal_count, best_evidence_text FROM int_evidence""")
def _(t: Inputs):
    return _rounded(A.evidence_rollup(built.evidence(t)), "avg_evidence_quality_score")


@query("evidence_concat", """
WITH u AS (SELECT *, row_number() OVER (PARTITION BY raw_id ORDER BY evidence_quality_score DESC, created_at DESC, evidence_id DESC) AS rn FROM evidence_fx
  WHERE coalesce(evidence_length, 0) > 0 AND coalesce(evidence_quality_score, 0) >= 0.20),
s AS (SELECT raw_id, max(evidence_quality_score) AS evidence_quality_score, max(created_at) AS latest_evidence_at FROM u GROUP BY raw_id)
SELECT u.raw_id, CAST(floor((rn - 1) / 3) AS BIGINT) AS part_no, string_agg(evidence_text, E'\\n\\n' ORDER BY rn) AS recovery_text,
  s.evidence_quality_score, s.latest_evidence_at
FROM u JOIN s ON u.raw_id = s.raw_id GROUP BY u.raw_id, 2, s.evidence_quality_score, s.latest_evidence_at""")
def _(t: Inputs):
    # parts of three texts, so that most items of the test tables continue in a second part
    return A.evidence_concat(t.fx("evidence_fx"), part_rows=3)


@query("best_score_per_key", "SELECT raw_id, max(evidence_quality_score) AS best_score FROM evidence_fx GROUP BY raw_id")
def _(t: Inputs):
    return A.best_score_per_key(t.fx("evidence_fx"))


@query("evidence_source_stats", f"""
SELECT source_type, klass AS evidence_quality_class, count(*) AS records, round(avg(evidence_quality_score), 6) AS avg_confidence,
  round(avg(evidence_length), 6) AS avg_text_length
FROM (SELECT *, {d.klass('evidence_quality_score')} AS klass FROM stg_evidence) GROUP BY 1, 2""")
def _(t: Inputs):
    from clipcatalog.functions.text import evidence_class

    rows = built.evidence(t).withColumn("evidence_quality_class", evidence_class("evidence_quality_score"))
    return _rounded(A.evidence_source_stats(rows), "avg_confidence", "avg_text_length")


@query("duplicate_keys", f"""
SELECT count(*) AS duplicate_business_keys FROM (SELECT 1 FROM (SELECT coalesce(nullif(trim(platform), ''), 'tiktok') AS p,
  {d.content_key('content_id', 'url')} AS k FROM captions_fx) WHERE k IS NOT NULL GROUP BY p, k HAVING count(*) > 1)""")
def _(t: Inputs):
    from clipcatalog.functions.columns import content_key, default_blank

    keys = t.fx("captions_fx").select(
        default_blank("platform", "tiktok").alias("p"), content_key("content_id", "url").alias("k")).filter("k IS NOT NULL")
    return A.duplicate_keys(keys, ["p", "k"])


@query("quality_daily", """
SELECT DATE '2024-06-01' AS run_date, (SELECT count(*) FROM captions_fx) AS bronze_rows, count(*) AS silver_rows, (SELECT count(*) FROM gold_api) AS gold_rows,
  round(count(*) FILTER (is_recipe) / count(*), 6) AS recipe_rate, round(count(*) FILTER (recipe_status = 'full_recipe') / count(*), 6) AS full_recipe_rate,
  round(count(*) FILTER (recipe_status = 'partial_recipe') / count(*), 6) AS partial_recipe_rate,
  round(count(*) FILTER (recipe_status IN ('food_content', 'non_recipe') OR NOT is_recipe) / count(*), 6) AS rejected_rate,
  round(avg(recipe_quality_score), 6) AS avg_recipe_quality_score, round(count(*) FILTER (final_recipe_json IS NULL) / count(*), 6) AS missing_final_json_rate,
  count(*) - count(DISTINCT lower(url_tiktok)) AS duplicate_url_count,
  (SELECT round(count(*) FILTER (source_type = 'video_ocr' AND is_recipe_signal) / count(*) FILTER (source_type = 'video_ocr'), 6) FROM stg_evidence) AS usable_ocr_rate
FROM gold_catalog""")
def _(t: Inputs):
    gold = built.gold(t)
    from clipcatalog.operators.serving import published

    row = A.quality_daily(t.fx("captions_fx"), gold, published(), built.evidence(t), F.lit("2024-06-01").cast("date"))
    return _rounded(row, "recipe_rate", "full_recipe_rate", "partial_recipe_rate", "rejected_rate",
                    "avg_recipe_quality_score", "missing_final_json_rate", "usable_ocr_rate")


def _creator_sql(condition: str) -> str:
    return f"""
SELECT s.c AS creator_username, s.n AS videos_scanned, e.recipes AS videos_accepted, e.recipes AS recipes_extracted, e.fulls AS full_recipes,
  round(e.q, 6) AS avg_quality_score, round(e.fulls / s.n, 6) AS yield_rate, s.last_at AS last_scanned_at,
  CASE WHEN e.fulls / s.n >= 0.25 THEN 'high_yield' ELSE 'active' END AS status
FROM (SELECT lower(creator_username) AS c, count(*) AS n, max(ingested_at) AS last_at FROM captions_fx WHERE {condition} AND coalesce(creator_username, '') <> '' GROUP BY 1) s
JOIN (SELECT lower(b.creator_username) AS c, count(*) FILTER (r.is_recipe) AS recipes, count(*) FILTER (r.recipe_status = 'full_recipe') AS fulls,
  avg(greatest(coalesce(r.final_recipe_confidence, 0), coalesce(r.caption_completeness_score, 0), coalesce(r.processing_confidence, 0))) AS q
  FROM captions_fx b LEFT JOIN stg_recipes r ON b.raw_id = r.raw_id WHERE b.{condition} AND coalesce(creator_username, '') <> '' GROUP BY 1) e ON s.c = e.c"""


@query("creator_quality", _creator_sql("raw_id IS NOT NULL"))
def _(t: Inputs):
    return _rounded(A.creator_quality(t.fx("captions_fx"), built.recipes(t)), "avg_quality_score", "yield_rate")


_FIRST, _SECOND = "raw_id % 2 = 0", "raw_id % 40 < 17"  # the second run lacks some creators and sees other items of the rest


@query("creator_scores_upsert", f"""
WITH old AS ({_creator_sql(_FIRST)}), new AS ({_creator_sql(_SECOND)})
SELECT *, TIMESTAMP '2024-06-02 00:00:00' AS updated_at FROM new
UNION ALL SELECT *, TIMESTAMP '2024-06-01 00:00:00' FROM old WHERE creator_username NOT IN (SELECT creator_username FROM new)""")
def _(t: Inputs):
    """Scores of a first run, kept as a table, then the changed scores of a second one merged into it."""
    def scores(condition: str):
        return _rounded(A.creator_quality(t.fx("captions_fx").filter(condition), built.recipes(t)), "avg_quality_score", "yield_rate")

    at = [F.lit(f"2024-06-0{n} 00:00:00").cast("timestamp_ntz") for n in (1, 2)]
    none = scores(_FIRST).limit(0).withColumn("updated_at", at[0])
    table = landed(U.upsert_creator_scores(none, scores(_FIRST), at[0]), "creator-scores")
    return U.upsert_creator_scores(table, scores(_SECOND), at[1])


@query("run_summary", f"""
SELECT method || ':' || status AS outcome, count(*) AS attempts, count(*) FILTER (status IN {d.in_list(vocab.SUCCESS_STATUSES)} AND score >= 0.2) AS evidence_rows
FROM attempts_fx GROUP BY 1""")
def _(t: Inputs):
    hit = F.col("status").isin(vocab.SUCCESS_STATUSES) & (F.col("score") >= 0.2)
    return A.run_summary(t.fx("attempts_fx"), hit)


@query("distinct_lines_concat", f"""
WITH p AS (SELECT item_id, ordinal, {d.caption("CASE ordinal % 3 WHEN 0 THEN 'Mix well' WHEN 1 THEN comment_text ELSE role_text END")} AS x
  FROM (SELECT c.*, comment_text || ' ' AS role_text FROM comments_fx c)),
l AS (SELECT item_id, x, min(ordinal) AS o FROM p WHERE x <> '' GROUP BY item_id, x)
SELECT item_id, substr(string_agg(x, chr(10) ORDER BY o, x), 1, 10000) AS text, count(*) AS pieces FROM l GROUP BY item_id""")
def _(t: Inputs):
    pieces = t.fx("comments_fx").withColumn(
        "piece", F.when(F.col("ordinal") % 3 == 0, "Mix well").when(F.col("ordinal") % 3 == 1, F.col("comment_text"))
        .otherwise(F.concat("comment_text", F.lit(" "))))
    return A.distinct_lines_concat(pieces, "item_id", "ordinal", "piece")


@query("segments_concat", f"""
WITH p AS (SELECT item_id, ordinal, {d.caption('comment_text')} AS x, probability FROM comments_fx)
SELECT item_id, substr(string_agg(x, ' ' ORDER BY ordinal) FILTER (x <> ''), 1, 10000) AS transcript, count(*) FILTER (x <> '') AS pieces,
  coalesce(nullif(max(probability), 0), 0.9)::DOUBLE AS confidence FROM p GROUP BY item_id HAVING count(*) FILTER (x <> '') > 0""")
def _(t: Inputs):
    return A.segments_concat(t.fx("comments_fx"), "item_id", "ordinal", "comment_text", "probability")
