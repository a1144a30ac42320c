"""Left joins to per-key features, anti-joins and candidate selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions.columns import as_col, empty_to_null
from clipcatalog.functions.text import evidence_text_compose


def left_join_features(rows: DataFrame, features: DataFrame, key: str,
                       defaults: dict[str, Column | int | float | None]) -> DataFrame:
    """Rows with their per-key features; a missing feature takes its default.

    A default may refer to the row's own columns.  Only the named features are
    added; ``features`` must be unique on the key.
    """
    narrow = features.select(key, *[F.col(n).alias(f"_f_{n}") for n in defaults])
    joined = rows.join(narrow, key, "left")
    added = {
        n: F.col(f"_f_{n}") if d is None else F.coalesce(F.col(f"_f_{n}"), d if isinstance(d, Column) else F.lit(d))
        for n, d in defaults.items()
    }
    kept = [c for c in rows.columns if c not in added]
    return joined.select(*kept, *[v.alias(n) for n, v in added.items()])


def anti_join_unprocessed(source: DataFrame, done: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with a non-blank text that the target does not hold yet."""
    fresh = source.filter(F.coalesce(F.trim(F.col(text)), F.lit("")) != "")
    return fresh.join(done.select(key), key, "left_anti")


def incremental_candidates(source: DataFrame, done: DataFrame, evidence: DataFrame, mode: str = "new",
                           key: str = "raw_id", text: str = "description", processed: str = "processed_at",
                           latest: str = "latest_evidence_at", score: str = "evidence_quality_score") -> DataFrame:
    """Rows to enrich: ``new`` ones, ``recovered`` ones, or ``all``.

    ``recovered``: evidence exists and is not older than the last processing, or
    the row was never processed.  ``evidence`` holds one row per key.
    """
    if mode not in ("new", "recovered", "all"):
        raise ValueError(f"unknown mode {mode!r}")
    rows = source.filter(F.coalesce(F.trim(F.col(text)), F.lit("")) != "")
    features = evidence.select(key, F.col(latest).alias("latest_evidence_at"), F.col(score).alias("_score"))
    if mode == "new":
        rows = rows.join(done.select(key), key, "left_anti")
    joined = rows.join(features, key, "left")
    if mode == "recovered":
        state = done.select(key, F.col(processed).alias("_done_at"), F.lit(True).alias("_done"))
        joined = (
            joined.filter(F.col("latest_evidence_at").isNotNull())
            .join(state, key, "left")
            .filter(
                F.col("_done").isNull()
                | F.col("_done_at").isNull()
                | (F.col("latest_evidence_at") >= F.col("_done_at"))
            )
            .drop("_done_at", "_done")
        )
    return joined.withColumn("evidence_quality_score", F.coalesce("_score", F.lit(0.0))).drop("_score")


def with_recovery(candidates: DataFrame, parts: DataFrame, key: str = "raw_id") -> DataFrame:
    """Candidates with the recovered text of each evidence part as ``recovery_text``, one row per part."""
    texts = parts.select(key, "part_no", "recovery_text")
    return candidates.join(texts, key, "left").withColumn("part_no", F.coalesce("part_no", F.lit(0)))


def composed_evidence(rows: DataFrame, original: str = "original", recovered: str = "recovered_text",
                      description: str = "description") -> DataFrame:
    """Rows of ``with_recovery`` with their composed evidence texts."""
    first = F.coalesce(empty_to_null(original), F.col(description))
    return rows.withColumns({
        "original_description": first,
        "all_recovered_text": evidence_text_compose(recovered, "recovery_text"),
        "evidence_text": evidence_text_compose(first, recovered, "recovery_text"),
    }).drop("recovery_text")


def with_evidence_text(candidates: DataFrame, parts: DataFrame, key: str = "raw_id", original: str = "original",
                       recovered: str = "recovered_text", description: str = "description") -> DataFrame:
    """Candidates with their composed evidence texts, one row per evidence part."""
    return composed_evidence(with_recovery(candidates, parts, key), original, recovered, description)


def weak_candidates(bronze: DataFrame, silver: DataFrame, evidence: DataFrame, threshold: float = 0.65,
                    n: int | None = 25, key: str = "raw_id") -> DataFrame:
    """Rows without a typed answer, or with a weak one; weakest and oldest first.

    ``evidence`` carries one best score per key (``best_score``).
    """
    s = silver.select(
        key,
        F.coalesce("caption_completeness_score", F.lit(0.0)).alias("caption_completeness_score"),
        F.coalesce("recipe_status", F.lit("unknown")).alias("recipe_status"),
        F.coalesce("is_recipe", F.lit(True)).alias("is_recipe"),
        F.lit(True).alias("_known"),
    )
    joined = (
        bronze.filter(F.col("url").isNotNull() & (F.coalesce(F.trim("description"), F.lit("")) != ""))
        .join(s, key, "left")
        .join(evidence.select(key, F.col("best_score").alias("_best")), key, "left")
    )
    completeness = F.coalesce("caption_completeness_score", F.lit(0.0))
    best = F.coalesce("_best", F.lit(0.0))
    weak = (F.greatest(completeness, best) < threshold) & F.col("recipe_status").isin(vocab.WEAK_STATUSES)
    out = joined.filter(F.col("_known").isNull() | weak).select(
        *bronze.columns,
        completeness.alias("caption_completeness_score"),
        best.alias("best_evidence_quality_score"),
        F.coalesce("recipe_status", F.lit("unknown")).alias("recipe_status"),
        F.coalesce("is_recipe", F.lit(True)).alias("is_recipe"),
    )
    if n is None:
        return out
    return out.orderBy(
        F.col("caption_completeness_score").asc(), F.col("ingested_at").asc_nulls_last(), F.col(key).asc()
    ).limit(n)


def scalar_cross_join(*frames: DataFrame) -> DataFrame:
    """One row out of several one-row aggregates.

    Each frame must be a global aggregate, so every side is exactly one row.
    """
    out = frames[0]
    for frame in frames[1:]:
        out = out.crossJoin(frame)
    return out


def unseen_filter(items: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None) -> DataFrame:
    """Items whose key is not in the seen table."""
    return items.join(seen.select(as_col(seen_key or key).alias(key)), key, "left_anti")
