"""Evidence and work-state rules of the recovery step."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions.text import base_confidence, recipe_signal
from clipcatalog.operators import recovery as E
from clipcatalog.operators import upsert as U
from clipcatalog.operators.rollups import best_score_per_key
from clipcatalog.queries import built
from clipcatalog.queries import duck as d
from clipcatalog.queries.q_joins import NOW_SQL, now, at
from clipcatalog.queries.registry import Inputs, query

_TEXT = d.evidence_text(d.caption("text"))
_RESULT = f"""
n AS (SELECT *, {_TEXT} AS x FROM recovered_fx),
s AS (SELECT *, CASE WHEN x <> '' THEN {d.score('x', creator='creator_username')} ELSE 0.0 END AS score,
  method = 'ocr' AND x <> '' AND NOT {d.ocr_ok('x')} AS gib FROM n),
r AS (SELECT attempt_id, raw_id, method, x AS recovered_text, length(x) AS text_length, score, creator_username, content_id, url, engine, created_at, error, details,
  CASE WHEN x <> '' THEN {d.language('x')} ELSE '' END AS language_hint,
  CASE WHEN gib THEN 'rejected_gibberish' WHEN x <> '' AND status = 'attempted_success' THEN CASE WHEN score >= 0.30 THEN 'usable_recipe_text' ELSE 'technical_success' END ELSE status END AS status,
  CASE WHEN gib THEN least(confidence, score) WHEN x <> '' AND status = 'attempted_success' THEN greatest(confidence, score) ELSE confidence END AS confidence FROM s)"""


_DETAILS = f"""concat(coalesce(left(details, length(details) - 1) || ',', chr(123)), '"evidence_quality_score":', CAST(score AS VARCHAR),
  ',"evidence_quality_class":"', {d.klass('score')}, '"', chr(125))"""


def _results(t: Inputs):
    return E.attempt_result(t.fx("recovered_fx"))


@query("attempt_result", f"""
WITH {_RESULT}
SELECT attempt_id, recovered_text, text_length, language_hint, confidence, status, coalesce(error, '') AS error_message, score,
  {d.klass('score')} AS evidence_class,
  {_DETAILS} AS source_details,
  sha256(raw_id || '|' || method || '|' || {d.strip("coalesce(nullif(recovered_text, ''), nullif(error, ''), status)")}) AS record_hash FROM r""")
def _(t: Inputs):
    return _results(t).select(
        "attempt_id", "recovered_text", "text_length", "language_hint", "confidence", "status", "error_message", "score",
        F.get_json_object("source_details", "$.evidence_quality_class").alias("evidence_class"),
        "source_details", "record_hash")


_SOURCE_TYPE = "CASE method " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.SOURCE_TYPE_BY_METHOD.items()) + " ELSE method END"
_IS_EVIDENCE = f"""
e AS (SELECT *, {d.score('recovered_text')} AS plain, recovered_text <> '' AND status IN {d.in_list(vocab.SUCCESS_STATUSES)}
  AND (method <> 'ocr' OR {d.ocr_ok('recovered_text')}) AND {d.score('recovered_text')} >= 0.20 AS is_evidence FROM r)"""


@query("evidence_from_attempts", f"""
WITH {_RESULT}, {_IS_EVIDENCE}
SELECT raw_id, content_id, url, created_at, {_SOURCE_TYPE} AS source_type, coalesce(nullif(engine, ''), method) AS source_name, recovered_text AS evidence_text,
  length(recovered_text) AS evidence_length, plain AS evidence_quality_score, {d.klass('plain')} AS evidence_quality_class, plain >= 0.30 AS is_recipe_signal, {_DETAILS} AS source_details,
  sha256(raw_id || '|' || method || '|' || recovered_text) AS record_hash FROM e WHERE is_evidence""")
def _(t: Inputs):
    return E.evidence_from_attempts(_results(t))


@query("queue_status", f"""
WITH {_RESULT}, {_IS_EVIDENCE},
q AS (SELECT attempt_id, CASE WHEN is_evidence AND confidence >= 0.45 THEN 1 WHEN is_evidence THEN 2 WHEN status IN ('rejected_gibberish', 'technical_success') THEN 3
  WHEN method = 'ocr' AND status IN ('attempted_empty', 'attempted_failed') THEN 4
  WHEN method IN ('web_caption', 'external_url', 'comments') AND status IN ('attempted_empty', 'attempted_failed') THEN 5 ELSE 6 END AS k FROM e)
SELECT attempt_id, ['ready_for_llm_extraction', 'ready_for_llm_classification', 'low_quality_rejected', 'needs_audio', 'needs_ocr', 'failed'][k] AS queue_status,
  [2, 3, 8, 6, 5, 9][k]::BIGINT AS priority FROM q""")
def _(t: Inputs):
    return E.queue_status(_results(t)).select("attempt_id", "queue_status", "priority")


@query("queue_status_after_llm", """
SELECT raw_id, CASE WHEN recipe_status = 'full_recipe' THEN 'extracted_success' WHEN recipe_status = 'partial_recipe' THEN 'extracted_partial'
  WHEN coalesce(is_recipe, false) THEN 'low_quality_rejected' ELSE 'failed' END AS status FROM stg_recipes""")
def _(t: Inputs):
    return built.recipes(t).select("raw_id", E.queue_status_after_answer("recipe_status", "is_recipe").alias("status"))


@query("skip_recent", f"""
WITH plan AS (SELECT DISTINCT a.raw_id, m.method FROM attempts_fx a, (SELECT unnest({list(vocab.METHOD_ORDER)}) AS method) m),
last AS (SELECT raw_id, method, status FROM attempts_fx WHERE created_at >= TIMESTAMP '2024-03-03 00:00:00' - INTERVAL 24 HOUR
  QUALIFY row_number() OVER (PARTITION BY raw_id, method ORDER BY created_at DESC, attempt_id DESC) = 1)
SELECT p.raw_id, p.method FROM plan p LEFT JOIN last l ON l.raw_id = p.raw_id AND l.method = p.method AND l.status IN {d.in_list(vocab.RETRY_BLOCKING_STATUSES)}
WHERE l.raw_id IS NULL""")
def _(t: Inputs):
    attempts = t.fx("attempts_fx")
    methods = F.array(*[F.lit(m) for m in vocab.METHOD_ORDER])
    plan = attempts.select("raw_id").distinct().select("raw_id", F.explode(methods).alias("method"))
    return E.skip_recent(plan, attempts, at("2024-03-03 00:00:00"), 24, [F.col("attempt_id").desc()])


@query("method_plan", f"""
WITH u AS (SELECT raw_id, len({d.urls("concat(coalesce(description, ''), ' ', coalesce(recovered_text, ''))")}) > 0 AS link FROM captions_fx)
SELECT raw_id, 'web_caption,audio_transcript,ocr' || CASE WHEN link THEN ',external_url' ELSE '' END AS methods,
  'web_caption,ocr' || CASE WHEN link THEN ',external_url' ELSE '' END || ',comments' AS no_audio, 'ocr' AS only_ocr FROM u""")
def _(t: Inputs):
    texts = ("description", "recovered_text")
    return t.fx("captions_fx").select(
        "raw_id", F.array_join(E.method_plan(*texts), ",").alias("methods"),
        F.array_join(E.method_plan(*texts, skip_audio=True, enable_comments=True), ",").alias("no_audio"),
        F.array_join(E.method_plan(method="ocr"), ",").alias("only_ocr"))


def _step(n: int, method: str, wanted: str) -> str:
    go = f"s_{method} IS NOT NULL AND b{n} < 0.70 AND {wanted.format(b=f'b{n}')}"
    return (f"w{n + 1} AS (SELECT *, CASE WHEN {go} THEN greatest(b{n}, s_{method}) ELSE b{n} END AS b{n + 1}, "
            f"CASE WHEN {go} THEN ran{n} || [{d.quoted(method)}] ELSE ran{n} END AS ran{n + 1} FROM w{n})")


_WANTED = {"web_caption": "true", "audio_transcript": "{b} < 0.70", "ocr": "{b} < 0.55",
           "external_url": "{b} < 0.70 AND has_link", "comments": "{b} < 0.55"}


@query("adaptive_waterfall", f"""
WITH l AS (SELECT raw_id, method, score FROM attempts_fx QUALIFY row_number() OVER (PARTITION BY raw_id, method ORDER BY created_at DESC) = 1),
p AS (SELECT raw_id, {", ".join(f"max(score) FILTER (method = '{m}') AS s_{m}" for m in vocab.METHOD_ORDER)} FROM l GROUP BY raw_id),
i AS (SELECT raw_id, greatest(0.0, max(evidence_quality_score) - 0.8) AS best, raw_id % 2 = 0 AS has_link FROM evidence_fx GROUP BY raw_id),
w0 AS (SELECT i.raw_id, i.best AS b0, []::VARCHAR[] AS ran0, has_link, {", ".join(f"s_{m}" for m in vocab.METHOD_ORDER)} FROM i LEFT JOIN p ON i.raw_id = p.raw_id),
{", ".join(_step(n, m, _WANTED[m]) for n, m in enumerate(vocab.METHOD_ORDER))}
SELECT raw_id, array_to_string(ran5, ',') AS methods_run, round(b5, 9) AS best_score FROM w5""")
def _(t: Inputs):
    from clipcatalog.operators.ranking import latest_per_key

    attempts = latest_per_key(t.fx("attempts_fx"), ["raw_id", "method"], "created_at", [F.col("attempt_id").desc()])
    items = best_score_per_key(t.fx("evidence_fx")).select(
        "raw_id", F.greatest(F.lit(0.0), F.col("best_score") - 0.8).alias("best_score"),
        (F.col("raw_id") % 2 == 0).alias("has_link"))
    out = E.adaptive_waterfall(attempts, items)
    return out.select("raw_id", F.array_join("methods_run", ",").alias("methods_run"), F.round("best_score", 9).alias("best_score"))


@query("creator_recent", """
SELECT creator, coalesce(status = 'completed' AND (TIMESTAMP '2024-01-10 12:00:00' - try_cast(replace(replace(completed_at, 'T', ' '), 'Z', '') AS TIMESTAMP)) < INTERVAL 20 HOUR, false) AS recent
FROM scan_state_fx""")
def _(t: Inputs):
    moment = F.lit("2024-01-10T12:00:00+00:00").cast("timestamp")
    return t.fx("scan_state_fx").select("creator", E.creator_recent("status", "completed_at", moment, 20).alias("recent"))


@query("creator_state_upsert", f"""
WITH tgt AS (SELECT creator, status, TIMESTAMP '2024-01-01 00:00:00' AS last_run_at, TIMESTAMP '2024-01-01 00:00:00' AS completed_at, scanned, scanned AS accepted, NULL::VARCHAR AS error
  FROM scan_state_fx WHERE status = 'completed'),
src AS (SELECT CAST(user_id AS VARCHAR) AS creator, CASE WHEN max(event_id) % 2 = 0 THEN 'completed' ELSE 'failed' END AS status, count(*) AS scanned,
  count(*) FILTER (event_type = 'click') AS accepted, CASE WHEN max(event_id) % 2 = 1 THEN 'blocked' END AS error FROM events WHERE event_type <> 'view' GROUP BY user_id)
SELECT coalesce(s.creator, t.creator) AS creator, coalesce(s.status, t.status) AS status, CASE WHEN s.creator IS NULL THEN t.last_run_at ELSE {NOW_SQL} END AS last_run_at,
  CASE WHEN s.creator IS NULL THEN t.completed_at WHEN s.status = 'completed' THEN {NOW_SQL} END AS completed_at,
  coalesce(s.scanned, t.scanned) AS scanned, coalesce(s.accepted, t.accepted) AS accepted, CASE WHEN s.creator IS NULL THEN t.error ELSE s.error END AS error
FROM tgt t FULL OUTER JOIN src s ON t.creator = s.creator""")
def _(t: Inputs):
    first = at("2024-01-01 00:00:00")
    target = t.fx("scan_state_fx").filter("status = 'completed'").select(
        "creator", "status", first.alias("last_run_at"), first.alias("completed_at"), "scanned",
        F.col("scanned").alias("accepted"), F.lit(None).cast("string").alias("error"))
    odd = F.max("event_id") % 2 == 1
    runs = t.table("events").filter("event_type <> 'view'").groupBy(F.col("user_id").cast("string").alias("creator")).agg(
        F.when(odd, "failed").otherwise("completed").alias("status"), F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col("event_type") == "click").alias("accepted"), F.when(odd, "blocked").alias("error"))
    return U.creator_state_upsert(U.creator_state_upsert(target, runs, now()), runs, now())


_BASE = " ".join(
    f"WHEN '{m}' THEN CASE WHEN sig THEN {a} ELSE {b} END" for m, (a, b) in vocab.BASE_CONFIDENCE.items())


@query("base_confidence", f"""
SELECT attempt_id, (CASE method {_BASE} END)::DOUBLE AS confidence FROM (SELECT attempt_id, method, {d.signal('text')} AS sig FROM recovered_fx)""")
def _(t: Inputs):
    return t.fx("recovered_fx").select("attempt_id", base_confidence("method", recipe_signal("text")).alias("confidence"))
