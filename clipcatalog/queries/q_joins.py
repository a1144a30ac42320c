"""Feature joins, candidate selection and keyed upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions.columns import event_hash
from clipcatalog.operators import joins as J
from clipcatalog.operators import ordinals
from clipcatalog.operators import recovery as E
from clipcatalog.operators import rollups as A
from clipcatalog.operators import upsert as U
from clipcatalog.plans.medallion import landing_rows
from clipcatalog.queries import built
from clipcatalog.queries import duck as d
from clipcatalog.queries.registry import Inputs, query
from clipcatalog.sources.keyed_table import KeyedTable
from clipcatalog.sources.session import work_path


def at(text: str):
    return F.lit(text).cast("timestamp_ntz")


NOW_SQL = "TIMESTAMP '2024-06-01 00:00:00'"


def now():
    return at("2024-06-01 00:00:00")


@query("left_join_features", """
SELECT raw_id, round(best_evidence_quality_score, 9) AS best_evidence_quality_score, round(avg_evidence_quality_score, 6) AS avg_evidence_quality_score,
  evidence_source_count, recipe_signal_count, best_evidence_text FROM int_quality""")
def _(t: Inputs):
    return built.quality(t).select(
        "raw_id", F.round("best_evidence_quality_score", 9).alias("best_evidence_quality_score"),
        F.round("avg_evidence_quality_score", 6).alias("avg_evidence_quality_score"), "evidence_source_count",
        "recipe_signal_count", "best_evidence_text")


@query("left_join_features_orders", """
SELECT c.c_custkey, coalesce(o.n, 0) AS n_orders, round(coalesce(o.total, c.c_acctbal), 2) AS total FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey""")
def _(t: Inputs):
    per = t.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total"))
    out = J.left_join_features(t.table("customer"), per, "c_custkey", {"n_orders": 0, "total": F.col("c_acctbal")})
    return out.select("c_custkey", "n_orders", F.round("total", 2).alias("total"))


@query("anti_join_unprocessed", """
SELECT raw_id, title FROM captions_fx WHERE coalesce(trim(recovered_text), '') <> ''
  AND raw_id NOT IN (SELECT raw_id FROM silver_fx WHERE is_recipe)""")
def _(t: Inputs):
    done = t.fx("silver_fx").filter("is_recipe")
    return J.anti_join_unprocessed(t.fx("captions_fx"), done, "raw_id", "recovered_text").select("raw_id", "title")


_EV = """
ev AS (SELECT raw_id, max(evidence_quality_score) AS s, max(created_at) AS latest FROM evidence_fx
  WHERE coalesce(evidence_length, 0) > 0 AND coalesce(evidence_quality_score, 0) >= 0.20 GROUP BY raw_id),
done AS (SELECT raw_id, processed_at FROM stg_recipes WHERE is_recipe),
b AS (SELECT * FROM captions_fx WHERE coalesce(trim(description), '') <> '')"""


@query("incremental_candidates", f"""
WITH {_EV}
SELECT 'new' AS mode, b.raw_id, ev.latest AS latest_evidence_at, coalesce(ev.s, 0) AS evidence_quality_score
FROM b LEFT JOIN ev ON b.raw_id = ev.raw_id WHERE b.raw_id NOT IN (SELECT raw_id FROM done)
UNION ALL SELECT 'recovered', b.raw_id, ev.latest, coalesce(ev.s, 0) FROM b JOIN ev ON b.raw_id = ev.raw_id LEFT JOIN done ON done.raw_id = b.raw_id
  WHERE done.raw_id IS NULL OR ev.latest >= coalesce(done.processed_at, TIMESTAMP '1900-01-01 00:00:00')
UNION ALL SELECT 'all', b.raw_id, ev.latest, coalesce(ev.s, 0) FROM b LEFT JOIN ev ON b.raw_id = ev.raw_id""")
def _(t: Inputs):
    done = built.recipes(t).filter("is_recipe")
    evidence = A.evidence_stats(t.fx("evidence_fx"))
    out = None
    for mode in ("new", "recovered", "all"):
        rows = J.incremental_candidates(t.fx("captions_fx"), done, evidence, mode).select(
            F.lit(mode).alias("mode"), "raw_id", "latest_evidence_at", "evidence_quality_score")
        out = rows if out is None else out.unionAll(rows)
    return out


@query("weak_candidates", f"""
WITH s AS (SELECT * FROM stg_recipes WHERE has_ingredient_list),
e AS (SELECT raw_id, max(evidence_quality_score) AS best FROM evidence_fx GROUP BY raw_id)
SELECT b.raw_id, round(coalesce(s.caption_completeness_score, 0), 9) AS completeness, round(coalesce(e.best, 0), 9) AS best,
  coalesce(s.recipe_status, 'unknown') AS recipe_status, coalesce(s.is_recipe, true) AS is_recipe
FROM captions_fx b LEFT JOIN s ON b.raw_id = s.raw_id LEFT JOIN e ON b.raw_id = e.raw_id
WHERE b.url IS NOT NULL AND coalesce(trim(b.description), '') <> '' AND (s.raw_id IS NULL OR (
  greatest(coalesce(s.caption_completeness_score, 0), coalesce(e.best, 0)) < 0.65
  AND coalesce(s.recipe_status, 'unknown') IN {d.in_list(vocab.WEAK_STATUSES)}))
ORDER BY coalesce(s.caption_completeness_score, 0), b.ingested_at, b.raw_id LIMIT 250""")
def _(t: Inputs):
    silver = built.recipes(t).filter("has_ingredient_list")
    best = A.best_score_per_key(t.fx("evidence_fx"))
    return J.weak_candidates(t.fx("captions_fx"), silver, best, 0.65, 250).select(
        "raw_id", F.round("caption_completeness_score", 9).alias("completeness"),
        F.round("best_evidence_quality_score", 9).alias("best"), "recipe_status", "is_recipe")


@query("scalar_cross_join", """
SELECT (SELECT count(*) FROM lineitem) AS n_lines, (SELECT count(*) FROM orders) AS n_orders,
  (SELECT count(*) FROM documents) AS n_documents""")
def _(t: Inputs):
    def n(table, name):
        return t.table(table).agg(F.count(F.lit(1)).alias(name))

    return J.scalar_cross_join(n("lineitem", "n_lines"), n("orders", "n_orders"), n("documents", "n_documents"))


@query("unseen_filter", """
SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 150)""")
def _(t: Inputs):
    events = t.table("events").select("event_id", "user_id", "event_type", "value")
    seen = events.filter("event_type = 'error' AND value > 150").select(F.col("user_id").alias("video"))
    return J.unseen_filter(events, seen, "user_id", "video").select("event_id", "user_id")


# --- upserts: half of the rows are the target, the other half the source -----------------

LANDING_COLUMNS = ["raw_id", "platform", "content_id", "creator_username", "title", "description", "url",
                   "description_is_partial", "source_file", "record_hash"]


def _landing_sql(condition: str) -> str:
    return f"""
  SELECT raw_id, platform, cid AS content_id, creator_username, title, description, url, description_is_partial, source_file, key,
    sha256(platform || '|' || key || '|' || coalesce(description, '') || '|' || coalesce(title, '') || '|' || coalesce(url, '')) AS record_hash
  FROM (SELECT raw_id, coalesce(nullif(trim(platform), ''), 'tiktok') AS platform,
      coalesce(nullif(trim(content_id), ''), {d.path_id('url')}) AS cid, nullif(trim(creator_username), '') AS creator_username,
      nullif(trim(title), '') AS title, nullif(trim(description), '') AS description, nullif(trim(url), '') AS url,
      coalesce(description_is_partial, false) AS description_is_partial, source_file, evidence_text, description_enriched,
      {d.content_key('content_id', 'url')} AS key FROM captions_fx WHERE url IS NOT NULL AND {condition})
  QUALIFY row_number() OVER (PARTITION BY platform, key ORDER BY length(coalesce(evidence_text, '')) DESC, length(coalesce(description, '')) DESC,
    CASE WHEN lower(trim(description_enriched)) IN {d.in_list(vocab.WAREHOUSE_TRUE)} THEN 1 ELSE 0 END DESC, source_file DESC, raw_id DESC) = 1"""


_MERGED_LANDING = f"""
WITH tgt AS ({_landing_sql('description_is_partial')}), src AS ({_landing_sql('NOT description_is_partial')})
SELECT CASE WHEN t.key IS NOT NULL THEN t.raw_id ELSE s.raw_id END AS raw_id,
  coalesce(s.platform, t.platform) AS platform,
  CASE WHEN t.key IS NULL THEN s.content_id WHEN s.key IS NULL THEN t.content_id ELSE coalesce(nullif(t.content_id, ''), s.content_id) END AS content_id,
  coalesce(nullif(t.creator_username, ''), s.creator_username) AS creator_username,
  CASE WHEN t.key IS NULL OR length(coalesce(s.title, '')) > length(coalesce(t.title, '')) THEN s.title ELSE t.title END AS title,
  CASE WHEN t.key IS NULL OR length(coalesce(s.description, '')) > length(coalesce(t.description, '')) THEN s.description ELSE t.description END AS description,
  coalesce(t.url, s.url) AS url,
  CASE WHEN s.key IS NULL THEN t.description_is_partial ELSE s.description_is_partial END AS description_is_partial,
  CASE WHEN s.key IS NULL THEN t.source_file ELSE s.source_file END AS source_file,
  CASE WHEN s.key IS NULL THEN t.record_hash ELSE s.record_hash END AS record_hash
FROM tgt t FULL OUTER JOIN src s ON t.platform = s.platform AND t.key = s.key"""


def _landing_halves(t: Inputs):
    halves = []
    for condition in ("description_is_partial", "NOT description_is_partial"):
        halves.append(landing_rows(t.fx("captions_fx").filter(condition), keep_id=True).select(*LANDING_COLUMNS))
    return halves


@query("upsert", _MERGED_LANDING)
def _(t: Inputs):
    """Through the keyed table on disk: load, merge, merge again, read back."""
    target, source = _landing_halves(t)
    table = KeyedTable(t.spark, work_path(t.spark, "landing"), target.schema, U.LANDING_KEYS, buckets=8)
    table.upsert(target, U.LANDING_RULES)
    table.upsert(source, U.LANDING_RULES)
    table.upsert(source, U.LANDING_RULES)
    return table.read()


@query("upsert_longest_text", _MERGED_LANDING)
def _(t: Inputs):
    target, source = _landing_halves(t)
    return U.upsert_longest_text(U.upsert_longest_text(target, source), source)


_EVENT_ROWS = """
  SELECT sha256(trim(CAST(user_id AS VARCHAR)) || '|' || 'u' || user_id) AS record_hash, user_id, event_type, value FROM events
  WHERE {c} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""


def _event_rows(t: Inputs, condition: str):
    rows = t.table("events").filter(condition).withColumn(
        "record_hash", event_hash(F.col("user_id").cast("string"), F.concat(F.lit("u"), "user_id")))
    return U.unique_source(rows, ["record_hash"], [F.col("event_id").desc()]).select(
        "record_hash", "user_id", "event_type", "value")


@query("upsert_by_hash", f"""
WITH tgt AS ({_EVENT_ROWS.format(c="event_type <> 'click'")}), src AS ({_EVENT_ROWS.format(c="event_type = 'click'")})
SELECT coalesce(s.record_hash, t.record_hash) AS record_hash, coalesce(s.user_id, t.user_id) AS user_id,
  coalesce(s.event_type, t.event_type) AS event_type, coalesce(s.value, t.value) AS value
FROM tgt t FULL OUTER JOIN src s ON t.record_hash = s.record_hash""")
def _(t: Inputs):
    target, source = _event_rows(t, "event_type <> 'click'"), _event_rows(t, "event_type = 'click'")
    return U.upsert_by_hash(U.upsert_by_hash(target, source), source)


@query("insert_if_absent", f"""
WITH tgt AS ({_EVENT_ROWS.format(c="event_type <> 'click'")}), src AS ({_EVENT_ROWS.format(c="event_type = 'click'")})
SELECT * FROM tgt UNION ALL SELECT * FROM src WHERE record_hash NOT IN (SELECT record_hash FROM tgt)""")
def _(t: Inputs):
    target, source = _event_rows(t, "event_type <> 'click'"), _event_rows(t, "event_type = 'click'")
    return U.insert_if_absent(U.insert_if_absent(target, source, ["record_hash"]), source, ["record_hash"])


@query("upsert_full_replace", f"""
WITH s AS (SELECT raw_id, original_title, recipe_status, is_vegetarian, processed_at, is_recipe, has_instructions FROM stg_recipes),
tgt AS (SELECT * FROM s WHERE is_recipe),
src AS (SELECT raw_id, 'v2 ' || original_title AS original_title, 'non_recipe' AS recipe_status, NULL AS is_vegetarian FROM s WHERE has_instructions)
SELECT coalesce(s.raw_id, t.raw_id) AS raw_id, CASE WHEN s.raw_id IS NULL THEN t.original_title ELSE s.original_title END AS original_title,
  CASE WHEN s.raw_id IS NULL THEN t.recipe_status ELSE s.recipe_status END AS recipe_status,
  CASE WHEN s.raw_id IS NULL THEN t.is_vegetarian END AS is_vegetarian,
  CASE WHEN s.raw_id IS NULL THEN t.processed_at ELSE {NOW_SQL} END AS processed_at
FROM tgt t FULL OUTER JOIN src s ON t.raw_id = s.raw_id""")
def _(t: Inputs):
    columns = ["raw_id", "original_title", "recipe_status", "is_vegetarian", "processed_at"]
    rows = built.recipes(t)
    source = rows.filter("has_instructions").select(
        "raw_id", F.concat(F.lit("v2 "), "original_title").alias("original_title"), F.lit("non_recipe").alias("recipe_status"),
        F.lit(None).cast("boolean").alias("is_vegetarian"))
    once = U.upsert_full_replace(rows.filter("is_recipe").select(*columns), source, now())
    return U.upsert_full_replace(once, source, now())


_THREE = ["raw_id", "source_type", "record_hash"]


@query("upsert_attempts", """
WITH e AS (SELECT raw_id, source_type, record_hash, evidence_text, evidence_quality_score, created_at FROM stg_evidence),
tgt AS (SELECT * FROM e WHERE source_type <> 'comments'),
src AS (SELECT raw_id, source_type, record_hash, 'v2 ' || evidence_text AS evidence_text, 0.5::DOUBLE AS evidence_quality_score FROM e WHERE source_type <> 'video_ocr')
SELECT coalesce(s.raw_id, t.raw_id) AS raw_id, coalesce(s.source_type, t.source_type) AS source_type,
  coalesce(s.record_hash, t.record_hash) AS record_hash, coalesce(s.evidence_text, t.evidence_text) AS evidence_text,
  coalesce(s.evidence_quality_score, t.evidence_quality_score) AS evidence_quality_score,
  coalesce(t.created_at, TIMESTAMP '2024-06-01 00:00:00') AS created_at
FROM tgt t FULL OUTER JOIN src s ON t.raw_id = s.raw_id AND t.source_type = s.source_type AND t.record_hash = s.record_hash""")
def _(t: Inputs):
    e = built.evidence(t).select(*_THREE, "evidence_text", "evidence_quality_score", "created_at")
    source = e.filter("source_type <> 'video_ocr'").select(
        *_THREE, F.concat(F.lit("v2 "), "evidence_text").alias("evidence_text"), F.lit(0.5).alias("evidence_quality_score"))
    once = U.upsert_attempts(e.filter("source_type <> 'comments'"), source, _THREE, now())
    return U.upsert_attempts(once, source, _THREE, now())


_QUEUE_SQL = """
queue AS (SELECT raw_id, content_id, 'new' AS status, 5::BIGINT AS priority, NULL::VARCHAR AS last_error,
  ingested_at AS discovered_at, ingested_at AS updated_at FROM captions_fx WHERE description_is_partial)"""


def _queue(t: Inputs):
    return t.fx("captions_fx").filter("description_is_partial").select(
        "raw_id", "content_id", F.lit("new").alias("status"), F.lit(5).cast("bigint").alias("priority"),
        F.lit(None).cast("string").alias("last_error"), F.col("ingested_at").alias("discovered_at"),
        F.col("ingested_at").alias("updated_at"))


@query("upsert_queue", f"""
WITH {_QUEUE_SQL}, src AS (SELECT raw_id, content_id, 'needs_ocr' AS status, 5::BIGINT AS priority, 'e' AS last_error FROM captions_fx WHERE source_file = 'file_0.csv')
SELECT coalesce(s.raw_id, q.raw_id) AS raw_id, CASE WHEN s.raw_id IS NULL THEN q.content_id ELSE s.content_id END AS content_id,
  coalesce(s.status, q.status) AS status, coalesce(s.priority, q.priority) AS priority, coalesce(s.last_error, q.last_error) AS last_error,
  coalesce(q.discovered_at, {NOW_SQL}) AS discovered_at, CASE WHEN s.raw_id IS NULL THEN q.updated_at ELSE {NOW_SQL} END AS updated_at
FROM queue q FULL OUTER JOIN src s ON q.raw_id = s.raw_id""")
def _(t: Inputs):
    source = t.fx("captions_fx").filter("source_file = 'file_0.csv'").select(
        "raw_id", "content_id", F.lit("needs_ocr").alias("status"), F.lit(5).cast("bigint").alias("priority"),
        F.lit("e").alias("last_error"))
    return U.upsert_queue(U.upsert_queue(_queue(t), source, now()), source, now())


_SEEN_SQL = """SELECT CAST(user_id AS VARCHAR) AS video_id, max_by(event_type, event_id) AS creator_username, min(ts) AS first_seen_at, max(ts) AS last_seen_at
  FROM events WHERE {c} GROUP BY user_id"""


def _seen(t: Inputs, condition: str):
    return t.table("events").filter(condition).groupBy(F.col("user_id").cast("string").alias("video_id")).agg(
        F.max_by("event_type", "event_id").alias("creator_username"), F.min("ts").alias("first_seen_at"),
        F.max("ts").alias("last_seen_at"))


@query("touch_seen", f"""
WITH tgt AS ({_SEEN_SQL.format(c="event_type <> 'view'")}), src AS ({_SEEN_SQL.format(c="event_type = 'view'")})
SELECT coalesce(s.video_id, t.video_id) AS video_id, coalesce(s.creator_username, t.creator_username) AS creator_username,
  least(coalesce(s.first_seen_at, t.first_seen_at), coalesce(t.first_seen_at, s.first_seen_at)) AS first_seen_at,
  greatest(coalesce(s.last_seen_at, t.last_seen_at), coalesce(t.last_seen_at, s.last_seen_at)) AS last_seen_at
FROM tgt t FULL OUTER JOIN src s ON t.video_id = s.video_id""")
def _(t: Inputs):
    target, source = _seen(t, "event_type <> 'view'"), _seen(t, "event_type = 'view'")
    return U.touch_seen(U.touch_seen(target, source), source)


@query("update_where", f"""
WITH {_QUEUE_SQL}, s AS (SELECT raw_id, CASE WHEN recipe_status = 'full_recipe' THEN 'extracted_success' WHEN recipe_status = 'partial_recipe' THEN 'extracted_partial'
  WHEN is_recipe THEN 'low_quality_rejected' ELSE 'failed' END AS status, rejection_reason FROM stg_recipes)
SELECT q.raw_id, q.content_id, coalesce(s.status, q.status) AS status, q.priority,
  CASE WHEN s.status = 'failed' THEN s.rejection_reason WHEN s.status IS NULL THEN q.last_error END AS last_error, q.discovered_at,
  CASE WHEN s.status IS NULL THEN q.updated_at ELSE {NOW_SQL} END AS updated_at
FROM queue q LEFT JOIN s ON q.raw_id = s.raw_id""")
def _(t: Inputs):
    changes = built.recipes(t).select(
        "raw_id", E.queue_status_after_answer("recipe_status", "is_recipe").alias("status"),
        F.col("rejection_reason").alias("last_error"))
    return U.update_where(_queue(t), changes, "raw_id", now())


@query("assign_ids_and_defaults", f"""
SELECT 1000 + row_number() OVER (ORDER BY substr(md5(k), 1, 3), md5(k), url, raw_id) AS raw_id, url, title, coalesce(platform, 'tiktok') AS platform,
  false AS description_is_partial, {NOW_SQL} AS ingested_at
FROM (SELECT *, coalesce(url, '') || '|' || CAST(raw_id AS VARCHAR) AS k FROM captions_fx)""")
def _(t: Inputs):
    rows = t.fx("captions_fx").select("url", "title", "platform", F.col("raw_id").alias("line_no"))
    out = ordinals.assign_ids_and_defaults(
        rows, 1000, now(), ["url", "line_no"], "raw_id",
        {"platform": F.lit("tiktok"), "description_is_partial": F.lit(False)})
    return out.select("raw_id", "url", "title", "platform", "description_is_partial", "ingested_at")
