"""The batch run from landing rows to typed rows, with answers made from the requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.plans.medallion import run_batch
from clipcatalog.queries import duck as d
from clipcatalog.queries.q_joins import _landing_sql, now
from clipcatalog.queries.registry import Inputs, query
from clipcatalog.sources.session import landed

_PART_TEXTS = 3  # so that most items of the test tables fill several requests


def _ask(requests: DataFrame) -> DataFrame:
    """Stands for the caller's model: what it finds are the last words of the evidence; some requests fail."""
    words = F.regexp_extract_all("evidence_text", F.lit("[a-z]{4,9}"), F.lit(0))
    last, part, item = F.slice("words", -3, 3), F.col("part_no"), F.col("raw_id")
    answer = F.to_json(F.struct(
        F.when(part % 2 == 1, "en").otherwise("unknown").alias("lang"), last.alias("ingredients"), (item % 5 != 0).alias("is_recipe"),
        ((part * 3 + item) % 10 / 10).alias("caption_completeness_score"),
        F.when(part % 2 == 1, F.concat(F.lit("Dish "), F.coalesce(F.get("words", 0), F.lit("x")))).otherwise("").alias("recipe_title"),
        F.array(F.lit("time"), F.concat(F.lit("part "), (part % 2).cast("string"))).alias("missing_info"),
        F.struct(F.concat(F.array(F.lit("mix"), F.lit("mix")), F.transform(last, lambda w: F.concat(F.lit("add "), w))).alias("steps")).alias(
            "final_recipe_json")))
    asked = requests.select("raw_id", "part_no", words.alias("words"))
    return asked.select("raw_id", "part_no", F.when((item + part) % 7 == 3, "no answer").otherwise(answer).alias("response"))


@query("run_batch", f"""
WITH b AS ({_landing_sql('true')}),
u AS (SELECT *, row_number() OVER (PARTITION BY raw_id ORDER BY evidence_quality_score DESC, created_at DESC, evidence_id DESC) AS rn FROM evidence_fx
  WHERE coalesce(evidence_length, 0) > 0 AND coalesce(evidence_quality_score, 0) >= 0.20),
p AS (SELECT raw_id, CAST(floor((rn - 1) / {_PART_TEXTS}) AS BIGINT) AS part_no, string_agg(evidence_text, E'\\n\\n' ORDER BY rn) AS recovery_text FROM u GROUP BY 1, 2),
req AS (SELECT b.raw_id, coalesce(p.part_no, 0) AS part_no, concat_ws(E'\\n\\n', b.description, nullif(trim(c.recovered_text), ''), p.recovery_text) AS evidence_text
  FROM b JOIN captions_fx c ON c.raw_id = b.raw_id LEFT JOIN p ON p.raw_id = b.raw_id
  WHERE coalesce(b.description, '') <> '' AND b.raw_id NOT IN (SELECT raw_id FROM silver_fx WHERE raw_id % 3 = 0)),
w AS (SELECT *, regexp_extract_all(evidence_text, '[a-z]{{4,9}}') AS words FROM req),
a AS (SELECT *, CASE WHEN len(words) >= 3 THEN words[-3:] ELSE [] END AS last3, CAST((part_no * 3 + raw_id) % 10 AS DOUBLE) / 10 AS c, raw_id % 5 <> 0 AS recipe
  FROM w WHERE (raw_id + part_no) % 7 <> 3),
r AS (SELECT *, CASE WHEN recipe THEN c ELSE 0.0 END AS confidence,
  row_number() OVER (PARTITION BY raw_id ORDER BY CASE WHEN recipe THEN -c ELSE 0.0 END, part_no) AS rn,
  CASE WHEN recipe AND part_no % 2 = 1 THEN 'Dish ' || coalesce(words[1], 'x') END AS title FROM a),
one AS (SELECT raw_id, count(*) AS evidence_parts, any_value(recipe) AS is_recipe, max(c) AS caption_completeness_score, max(confidence) AS final_recipe_confidence,
  coalesce(arg_min(title, rn) FILTER (title IS NOT NULL), '') AS final_recipe_title,
  CASE WHEN bool_or(part_no % 2 = 1) THEN 'en' ELSE 'unknown' END AS recipe_language FROM r GROUP BY raw_id),
i AS (SELECT raw_id, v, min(part_no * 10 + k) AS k FROM (SELECT raw_id, part_no, unnest(last3) AS v, unnest(range(1, len(last3) + 1)) AS k FROM r)
  WHERE v NOT IN {d.in_list(vocab.LIST_PLACEHOLDERS)} GROUP BY raw_id, v),
ing AS (SELECT raw_id, string_agg(v, ',' ORDER BY k) AS ingredients FROM i GROUP BY raw_id),
s AS (SELECT raw_id, part_no, v, k, min(part_no) OVER (PARTITION BY raw_id, v) AS first FROM (
  SELECT raw_id, part_no, unnest(steps) AS v, unnest(range(1, len(steps) + 1)) AS k FROM (
    SELECT raw_id, part_no, ['mix', 'mix'] || list_transform(last3, lambda x: 'add ' || x) AS steps FROM r))),
st AS (SELECT raw_id, '[' || string_agg('"' || v || '"', ',' ORDER BY part_no, k) || ']' AS steps FROM s WHERE part_no = first GROUP BY raw_id),
m AS (SELECT raw_id, 'time,' || string_agg(v, ',' ORDER BY k) AS missing FROM (
  SELECT raw_id, 'part ' || part_no % 2 AS v, min(part_no) AS k FROM r GROUP BY 1, 2) GROUP BY raw_id)
SELECT one.*, coalesce(ingredients, '') AS ingredients, steps, missing, 0::BIGINT AS n_again
FROM one JOIN st USING (raw_id) JOIN m USING (raw_id) LEFT JOIN ing USING (raw_id)""")
def _(t: Inputs):
    """Run twice: the second run finds everything typed and adds nothing."""
    evidence, silver = t.fx("evidence_fx"), t.fx("silver_fx").filter("raw_id % 3 = 0")
    typed = landed(run_batch(t.fx("captions_fx"), silver, evidence, _ask, "m", now(), part_rows=_PART_TEXTS)["typed"], "typed")
    known = typed.unionByName(silver, allowMissingColumns=True)
    again = run_batch(t.fx("captions_fx"), known, evidence, _ask, "m", now(), part_rows=_PART_TEXTS)["typed"]
    repeats = again.groupBy("raw_id").agg(F.count(F.lit(1)).alias("n_again"))
    joined = lambda name: F.array_join(F.from_json(name, "array<string>"), ",")
    return typed.join(repeats, "raw_id", "left").select(
        "raw_id", F.col("evidence_parts").cast("bigint").alias("evidence_parts"), "is_recipe", "caption_completeness_score",
        "final_recipe_confidence", "final_recipe_title", "recipe_language", joined("ingredients").alias("ingredients"),
        F.get_json_object("final_recipe_json", "$.steps").alias("steps"), joined("missing_recipe_info").alias("missing"),
        F.coalesce("n_again", F.lit(0)).alias("n_again"))
