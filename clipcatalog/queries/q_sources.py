"""Readers, writers, vocabularies and table plumbing.

These write data derived from the given tables to the shared work folder and
return what a reader gets back.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcatalog import schemas
from clipcatalog.operators.serving import enrich_with
from clipcatalog.plans import views
from clipcatalog.queries import built
from clipcatalog.queries.q_joins import NOW_SQL, now
from clipcatalog.queries.registry import Inputs, query
from clipcatalog.sources import files as S
from clipcatalog.sources.session import work_path
from clipcatalog.sources.terms import load_terms

VERIFIED = schemas.VERIFIED_COLUMNS


def _verified(t: Inputs):
    """Captions in the 13-column landing layout."""
    fx = t.fx("captions_fx")
    given = {
        "TITLE": F.col("title"), "DESCRIPTION": F.col("description"), "URL_TIKTOK": F.col("url"),
        "PLATFORM": F.col("platform"), "CONTENT_ID": F.col("content_id"), "CREATOR_USERNAME": F.col("creator_username"),
        "DESCRIPTION_IS_PARTIAL": F.col("description_is_partial").cast("string"),
        "DATA_ORIGIN": F.when(F.col("raw_id") % 2 == 0, "NULL").otherwise(" seed "),
        "VERIFICATION_SOURCE_URL": F.col("raw_id").cast("string"),
    }
    return fx.select(*[given.get(c, F.lit(None).cast("string")).alias(c) for c in VERIFIED], "source_file")


def _null_token(x: str) -> str:
    return f"CASE WHEN trim({x}) IN ('', 'NULL', 'null') THEN NULL ELSE trim({x}) END"


_LANDED = f"""
SELECT {_null_token('title')} AS TITLE, {_null_token('description')} AS DESCRIPTION, {_null_token('url')} AS URL_TIKTOK,
  {_null_token('platform')} AS PLATFORM, {_null_token('content_id')} AS CONTENT_ID, CASE WHEN raw_id % 2 = 0 THEN NULL ELSE 'seed' END AS DATA_ORIGIN,
  CAST(raw_id AS VARCHAR) AS VERIFICATION_SOURCE_URL, NULL::VARCHAR AS EVIDENCE_TEXT FROM captions_fx"""


@query("read_positional_csv", f"{_LANDED} UNION ALL SELECT {_null_token('title')}, {_null_token('description')}, {_null_token('url')}, NULL, NULL, NULL, NULL, NULL FROM captions_fx")
def _(t: Inputs):
    root = work_path(t.spark, "landing-csv")
    rows = _verified(t)
    S.write_csv_fixed_order(rows, f"{root}/verified", VERIFIED)
    S.write_csv_fixed_order(rows, f"{root}/legacy", VERIFIED[:3])
    back = S.read_positional_csv(t.spark, root, schemas.DISCOVERY_COLUMNS)
    return back.select("TITLE", "DESCRIPTION", "URL_TIKTOK", "PLATFORM", "CONTENT_ID", "DATA_ORIGIN",
                       "VERIFICATION_SOURCE_URL", "EVIDENCE_TEXT")


@query("read_named_csv", """
SELECT coalesce(title, '') AS TITLE, coalesce(url, '') AS URL_TIKTOK, coalesce(content_id, '') AS CONTENT_ID, '' AS EVIDENCE_TEXT FROM captions_fx WHERE coalesce(url, '') <> ''
UNION ALL SELECT coalesce(title, ''), coalesce(url, ''), '', '' FROM captions_fx WHERE coalesce(url, '') <> ''""")
def _(t: Inputs):
    root = work_path(t.spark, "named-csv")
    rows = _verified(t)
    S.write_csv_fixed_order(rows, f"{root}/all/a", VERIFIED)
    S.write_csv_fixed_order(rows.select(F.col("TITLE").alias("title"), F.col("URL_TIKTOK").alias("url_tiktok")),
                            f"{root}/all/b", ["url_tiktok", "title"])
    return S.read_named_csv(t.spark, [f"{root}/all"], ["TITLE", "URL_TIKTOK"],
                            ["TITLE", "URL_TIKTOK", "CONTENT_ID", "EVIDENCE_TEXT"], url="URL_TIKTOK")


@query("list_inputs", "SELECT DISTINCT source_file, true AS has_bytes FROM captions_fx")
def _(t: Inputs):
    root = work_path(t.spark, "inputs")
    _verified(t).write.partitionBy("source_file").option("header", True).csv(root)
    found = S.list_inputs(t.spark, root, "*.csv")
    return found.select(
        F.regexp_extract("path", "source_file=([^/]+)/", 1).alias("source_file"), (F.col("length") > 0).alias("has_bytes")
    ).distinct()


@query("read_table", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(t: Inputs):
    return S.read_table(t.spark, f"{t.folder}/orders.parquet").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("write_overwrite", f"SELECT cuisine_style, count(*) AS recipe_count, {NOW_SQL} AS generated_at FROM silver_fx GROUP BY 1")
def _(t: Inputs):
    path = work_path(t.spark, "report")
    report = views.analytics(t.fx("silver_fx"), now())["recipe_analytics_by_cuisine"]
    S.write_overwrite(report.limit(1), path)
    S.write_overwrite(report, path)
    return S.read_table(t.spark, path).select("cuisine_style", "recipe_count", "generated_at")


@query("write_csv_fixed_order", "SELECT url AS URL_TIKTOK, title AS TITLE, CAST(raw_id AS VARCHAR) AS VERIFICATION_SOURCE_URL FROM captions_fx")
def _(t: Inputs):
    path = work_path(t.spark, "discovery-csv")
    columns = ["URL_TIKTOK", "TITLE", "VERIFICATION_SOURCE_URL"]
    S.write_csv_fixed_order(_verified(t), path, columns)
    return t.spark.read.schema(schemas.strings(*columns)).option("header", True).option("multiLine", True).option(
        "escape", '"').csv(path)


@query("load_terms", """
SELECT DISTINCT 'lines' AS kind, source AS term FROM documents UNION ALL SELECT DISTINCT 'json', lower(o_orderpriority) FROM orders
UNION ALL SELECT DISTINCT 'grouped', n_name FROM nation UNION ALL SELECT 'default', 'recipe'""")
def _(t: Inputs):
    root = work_path(t.spark, "terms")
    docs, nations, orders = t.table("documents"), t.table("nation"), t.table("orders")
    comment = docs.select(F.concat(F.lit("# about "), "source").alias("value")).distinct()
    lines = docs.select(F.concat(F.lit("  "), "source", F.lit(" ")).alias("value")).distinct()
    lines.unionAll(comment).write.text(f"{root}/lines")
    # a vocabulary is small by nature; these columns have 5 and 25 values
    orders.agg(F.to_json(F.collect_set(F.lower("o_orderpriority"))).alias("value")).coalesce(1).write.text(f"{root}/json")
    groups = nations.groupBy(F.col("n_regionkey").cast("string").alias("k")).agg(F.collect_list("n_name").alias("v"))
    groups.agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("creators_by_language")))
               .alias("value")).coalesce(1).write.text(f"{root}/grouped")
    out = load_terms(t.spark, None, ["recipe"]).select(F.lit("default").alias("kind"), "term")
    for kind in ("lines", "json", "grouped"):
        terms = load_terms(t.spark, f"{root}/{kind}", kind="lines" if kind == "lines" else "json")
        out = out.unionAll(terms.select(F.lit(kind).alias("kind"), "term"))
    return out


_TARGET = T.StructType([
    T.StructField("raw_id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("is_recipe", T.BooleanType()), T.StructField("recipe_status", T.StringType()),
    T.StructField("evidence_quality_score", T.DoubleType()), T.StructField("rejection_reason", T.StringType()),
])


@query("conform_schema", """
SELECT raw_id, title, true AS is_recipe, 'partial_recipe' AS recipe_status, 0.0::DOUBLE AS evidence_quality_score, NULL::VARCHAR AS rejection_reason FROM captions_fx""")
def _(t: Inputs):
    return S.conform_schema(
        t.fx("captions_fx"), _TARGET, {"is_recipe": True, "recipe_status": "partial_recipe", "evidence_quality_score": 0.0})


@query("publish_views", """
SELECT recipe_status, recipe_quality_grade, count(*) AS n, count(*) FILTER (raw_id IN (SELECT id FROM gold_api)) AS published
FROM gold_catalog GROUP BY 1, 2""")
def _(t: Inputs):
    S.publish_views(t.spark, views.view_chain(t.fx("silver_fx"), t.fx("evidence_fx"), built.tie()))
    return t.spark.sql("""
        SELECT c.recipe_status, c.recipe_quality_grade, count(*) AS n, count(a.id) AS published
        FROM gold_catalog c LEFT JOIN gold_api_catalog a ON a.id = c.raw_id GROUP BY 1, 2""")


@query("read_optional", "SELECT lang, count(*) AS n FROM documents GROUP BY 1")
def _(t: Inputs):
    schema = T.StructType([T.StructField("lang", T.StringType())])
    absent = S.read_optional(t.spark, work_path(t.spark, "absent"), schema)
    present = S.read_optional(t.spark, f"{t.folder}/documents.parquet", schema).select("lang")
    return present.unionByName(absent).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("required_columns", "SELECT doc_id, lang, n_chars FROM documents")
def _(t: Inputs):
    return S.required_columns(t.table("documents"), ["DOC_ID", "lang"]).select("doc_id", "lang", "n_chars")


@query("enrich_with", """
SELECT raw_id, CASE WHEN contains(description, '12345 67890') THEN NULL ELSE CAST(length(description) AS VARCHAR) END AS response,
  CASE WHEN contains(description, '12345 67890') THEN 'failed' ELSE 'ok' END AS status,
  CASE WHEN contains(description, '12345 67890') THEN 'ValueError: unreadable caption' END AS error FROM captions_fx""")
def _(t: Inputs):
    def answer(prompts):  # the caller's function: any client would stand here
        return [ValueError("unreadable caption") if "12345 67890" in p else str(len(p)) for p in prompts]

    return enrich_with(t.fx("captions_fx"), answer, "raw_id", "description")


@query("silver_report_tables", f"""
SELECT 'summary' AS report, NULL::VARCHAR AS dimension, count(*) AS n, {NOW_SQL} AS generated_at FROM silver_fx
UNION ALL SELECT 'language', recipe_language, count(*), {NOW_SQL} FROM silver_fx GROUP BY recipe_language
UNION ALL SELECT 'model', model_name, count(*), {NOW_SQL} FROM silver_fx GROUP BY model_name""")
def _(t: Inputs):
    reports = views.analytics(t.fx("silver_fx"), now())
    summary = reports["recipe_analytics_summary"].select(
        F.lit("summary").alias("report"), F.lit(None).cast("string").alias("dimension"),
        F.col("total_recipes").alias("n"), "generated_at")
    for name, dim in (("language", "recipe_language"), ("model", "model_name")):
        summary = summary.unionAll(reports[f"recipe_analytics_by_{name}"].select(
            F.lit(name), F.col(dim), "recipe_count", "generated_at"))
    return summary


