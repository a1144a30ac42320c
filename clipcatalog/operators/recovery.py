"""Evidence recovery: attempt results, evidence rows, queue states, method plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions.columns import as_col, attempt_hash, empty_to_null, lookup
from clipcatalog.functions.structured import FIELD_MAP
from clipcatalog.functions.text import evidence_class, evidence_score, evidence_with_features, has_external_link, infer_language, usable_ocr
from clipcatalog.operators.ranking import latest_attempt_per_method
from clipcatalog.operators.staging import computed


def attempt_result(df: DataFrame, text: str = "text", creator: str = "creator_username") -> DataFrame:
    """Raw text and status of an attempt to its final status, confidence and hash.

    Needs ``raw_id, method, status, confidence, error`` beside the text.  Adds
    the cleaned text, score, class, length, language, details and record hash.
    """
    found = F.col("_found")
    cleaned = computed(df, {"_found": evidence_with_features(text, caption=True)}).withColumn("recovered_text", found["text"])
    has_text = F.col("recovered_text") != ""
    scored = computed(cleaned, {
        "score": F.when(has_text, evidence_score("recovered_text", creator=creator, normalized=True, found=found)).otherwise(F.lit(0.0)),
        "_readable": (F.col("method") != "ocr") | usable_ocr("recovered_text", normalized=True, found=found),
    })
    gibberish = (F.col("method") == "ocr") & has_text & ~F.col("_readable")
    success = has_text & (F.col("status") == "attempted_success")
    confidence = F.coalesce("confidence", F.lit(0.0))
    final = F.when(gibberish, "rejected_gibberish").when(
        success, F.when(F.col("score") >= 0.30, "usable_recipe_text").otherwise("technical_success")
    ).otherwise(F.col("status"))
    error = F.coalesce("error", F.lit("")) if "error" in df.columns else F.lit("")
    details = F.from_json("details", FIELD_MAP) if "details" in df.columns else F.lit(None).cast(FIELD_MAP)
    extra = F.create_map(
        F.lit("evidence_quality_score"), F.col("score").cast("variant"),
        F.lit("evidence_quality_class"), evidence_class("score").cast("variant"),
    )
    given = F.map_filter(F.coalesce(details, F.from_json(F.lit("{}"), FIELD_MAP)),
                         lambda k, _: ~F.map_contains_key(extra, k))
    kept = [c for c in df.columns if c not in (text, "status", "confidence", "error", "details")]
    return scored.select(
        *kept,
        "recovered_text",
        F.length("recovered_text").cast("bigint").alias("text_length"),
        F.when(has_text, infer_language("recovered_text")).otherwise("").alias("language_hint"),
        F.when(gibberish, F.least(confidence, F.col("score")))
        .when(success, F.greatest(confidence, F.col("score"))).otherwise(confidence).alias("confidence"),
        final.alias("status"),
        F.substring(error, 1, 1000).alias("error_message"),
        F.to_json(F.map_concat(given, extra)).alias("source_details"),
        "score",
        attempt_hash(
            "raw_id", "method", F.coalesce(empty_to_null("recovered_text"), empty_to_null(error), final)
        ).alias("record_hash"),
    )


def _with_evidence_score(df: DataFrame, text: str) -> DataFrame:
    """Score without the creator bonus, and whether the attempt is evidence."""
    body, found = F.col("_body"), F.col("_found")
    cleaned = computed(df, {"_found": evidence_with_features(text)}).withColumn("_body", found["text"])
    scored = computed(cleaned, {"_score": evidence_score("_body", normalized=True, found=found)})
    ok = (
        (body != "")
        & F.coalesce(F.col("status").isin(vocab.SUCCESS_STATUSES), F.lit(False))
        & ((F.col("method") != "ocr") | usable_ocr("_body", normalized=True, score="_score", found=found))
        & (F.col("_score") >= 0.20)
    )
    return scored.withColumn("_is_evidence", ok).drop("_found")


def evidence_from_attempts(df: DataFrame, text: str = "recovered_text", keep: list[str] | None = None) -> DataFrame:
    """Attempts that succeeded with useful text, as evidence rows."""
    keep = keep or [c for c in ("raw_id", "content_id", "url", "created_at") if c in df.columns]
    engine = empty_to_null("engine") if "engine" in df.columns else F.lit(None).cast("string")
    details = empty_to_null("source_details") if "source_details" in df.columns else F.lit(None).cast("string")
    return _with_evidence_score(df, text).filter("_is_evidence").select(
        *keep,
        lookup("method", vocab.SOURCE_TYPE_BY_METHOD, F.col("method")).alias("source_type"),
        F.coalesce(engine, F.col("method")).alias("source_name"),
        F.col("_body").alias("evidence_text"),
        F.length("_body").cast("bigint").alias("evidence_length"),
        F.col("_score").alias("evidence_quality_score"),
        evidence_class("_score").alias("evidence_quality_class"),
        (F.col("_score") >= 0.30).alias("is_recipe_signal"),
        F.coalesce(details, F.lit("{}")).alias("source_details"),
        attempt_hash("raw_id", "method", "_body").alias("record_hash"),
    )


def queue_status(df: DataFrame, text: str = "recovered_text") -> DataFrame:
    """Work-queue status and priority that follow from an attempt."""
    empty = F.col("status").isin("attempted_empty", "attempted_failed")
    ready = F.col("_is_evidence")
    low = F.col("status").isin("rejected_gibberish", "technical_success")
    web = F.col("method").isin("web_caption", "external_url", "comments")
    sure = F.coalesce("confidence", F.lit(0.0)) >= 0.45

    def choose(values):
        return (
            F.when(ready & sure, values[0]).when(ready, values[1]).when(low, values[2])
            .when((F.col("method") == "ocr") & empty, values[3]).when(web & empty, values[4]).otherwise(values[5])
        )

    names = ["ready_for_llm_extraction", "ready_for_llm_classification", "low_quality_rejected",
             "needs_audio", "needs_ocr", "failed"]
    return (
        _with_evidence_score(df, text)
        .withColumns({"queue_status": choose(names),
                      "priority": choose([F.lit(n).cast("bigint") for n in (2, 3, 8, 6, 5, 9)])})
        .drop("_body", "_score", "_is_evidence")
    )


def queue_status_after_answer(status, is_recipe) -> Column:
    return (
        F.when(as_col(status) == "full_recipe", "extracted_success")
        .when(as_col(status) == "partial_recipe", "extracted_partial")
        .when(F.coalesce(as_col(is_recipe), F.lit(False)), "low_quality_rejected")
        .otherwise("failed")
    )


def skip_recent(plan: DataFrame, attempts: DataFrame, now: Column, hours: int, tie: list[Column],
                force: bool = False, keys: list[str] | None = None) -> DataFrame:
    """Planned methods without those whose last recent attempt was of no use."""
    if force:
        return plan
    keys = keys or ["raw_id", "method"]
    blocked = latest_attempt_per_method(attempts, now, hours, tie, keys).filter(
        F.col("status").isin(vocab.RETRY_BLOCKING_STATUSES)
    )
    return plan.join(blocked.select(*keys), keys, "left_anti")


def method_plan(*texts, method: str = "adaptive", skip_audio: bool = False, skip_ocr: bool = False,
                enable_comments: bool = False) -> Column:
    """Methods allowed for a row, in order; links only when its texts hold one."""
    if method not in ("adaptive", "all"):
        return F.array(F.lit(method))
    link = F.when(has_external_link(*texts), F.lit("external_url")) if texts else F.lit("external_url")
    plan = [
        F.lit("web_caption"),
        F.lit(None if skip_audio else "audio_transcript").cast("string"),
        F.lit(None if skip_ocr else "ocr").cast("string"),
        link,
        F.lit("comments" if enable_comments else None).cast("string"),
    ]
    return F.array_compact(F.array(*plan))


def adaptive_waterfall(attempts: DataFrame, items: DataFrame, key: str = "raw_id", target: float = 0.70,
                       audio_below: float = 0.70, ocr_below: float = 0.55) -> DataFrame:
    """Which methods of an item would run, and the score they reach.

    ``attempts`` holds at most one row per item and method (``method, score``),
    so an item's list has no more than five entries; ``items`` gives the starting
    ``best_score`` and ``has_link``.  Methods run in order until the target is met.
    """
    order = F.create_map(*[F.lit(x) for pair in zip(vocab.METHOD_ORDER, range(5)) for x in pair])
    steps = (
        attempts.filter(F.col("method").isin(vocab.METHOD_ORDER))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct(
            F.try_element_at(order, F.col("method")).alias("position"), "method", "score"))).alias("steps"))
    )
    joined = items.select(key, F.coalesce("best_score", F.lit(0.0)).alias("best_score"), "has_link").join(
        steps, key, "left"
    )

    def run(state, step):
        best, method = state["best"], step["method"]
        wanted = (
            F.when(method == "web_caption", True)
            .when(method == "audio_transcript", best < audio_below)
            .when(method == "ocr", best < ocr_below)
            .when(method == "external_url", (best < target) & F.col("has_link"))
            .otherwise(best < ocr_below)
        )
        go = (best < target) & wanted
        return F.struct(
            F.when(go, F.greatest(best, step["score"])).otherwise(best).alias("best"),
            F.when(go, F.concat(state["ran"], F.array(method))).otherwise(state["ran"]).alias("ran"),
        )

    start = F.struct(F.col("best_score").alias("best"), F.array().cast("array<string>").alias("ran"))
    folded = F.when(F.col("steps").isNull(), start).otherwise(F.aggregate("steps", start, run))
    return joined.select(key, folded.alias("_f")).select(
        key, F.col("_f.ran").alias("methods_run"), F.col("_f.best").alias("best_score")
    )


def parse_state_time(c) -> Column:
    """ISO time to a UTC timestamp; a zone-less time is UTC, a bad one NULL."""
    text = as_col(c)
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.replace(zoned, F.lit("Z"), F.lit("+00:00"))).try_cast("timestamp")


def creator_recent(status, completed_at, now, hours: float) -> Column:
    """Completed less than ``hours`` ago."""
    done = parse_state_time(completed_at)
    seconds = F.unix_micros(as_col(now).cast("timestamp")) - F.unix_micros(done)
    return (as_col(status) == "completed") & F.coalesce(seconds < int(hours * 3600 * 1_000_000), F.lit(False))


def caption_upgrade(rows: DataFrame, captions: DataFrame, key: str, min_chars: int = 80,
                    everything: bool = False) -> DataFrame:
    """Replace a caption by a longer recovered one and keep the trail.

    ``captions`` has one ``caption, source`` per key (see ``best_caption``).
    """
    joined = rows.join(captions.select(key, F.col("caption").alias("_new"), F.col("source").alias("_source")),
                       key, "left")
    existing = F.coalesce("description", F.lit(""))
    short = F.lit(True) if everything else F.length(existing) < min_chars
    new = F.col("_new")
    hit = F.coalesce(short & (F.length(new) > F.length(existing)), F.lit(False))
    original = F.coalesce(empty_to_null("original_description"), existing)
    differs = new != original
    changes = {
        "title": F.substring(new, 1, vocab.TITLE_CHARS),
        "description": new,
        "original_description": original,
        "recovered_text": F.when(differs, new).otherwise(""),
        "evidence_text": F.concat_ws("\n\n", empty_to_null(original), F.when(differs, new)),
        "language_hint": infer_language(new),
        "description_is_partial": F.when(F.length(new) >= min_chars, "false").otherwise("true"),
        "data_origin": F.concat(
            F.coalesce(empty_to_null("data_origin"), F.lit("tiktokapi_discovery")), F.lit("+caption_enrichment")
        ),
        "description_source": F.col("_source"),
        "description_length": F.length(new).cast("string"),
        "description_enriched": F.lit("true"),
    }
    return joined.select(*[
        (F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)) for c in rows.columns
    ])
