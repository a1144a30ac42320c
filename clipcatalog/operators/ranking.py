"""Best-row-per-key, ranked lists and ordered batches.

``row_number() <= n`` keeps only n rows per key and map task before the shuffle
(Spark's window group limit), so a hot key costs n rows per task, not its size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions.columns import as_col, clamp01
from clipcatalog.functions.text import (
    comment_signal, looks_like_caption, normalize_caption, recipe_signal,
)
from clipcatalog.operators.staging import computed


def top_per_key(df: DataFrame, keys: list, order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    name = rank or "_rank"
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest_per_key(df: DataFrame, keys: list, time: str, tie: list[Column]) -> DataFrame:
    """The newest row per key; ``tie`` orders rows of equal time and must end in a unique column."""
    return top_per_key(df, keys, [F.col(time).desc_nulls_last(), *tie])


def dedup_evidence(df: DataFrame, key: str = "raw_id", source_type: str = "source_type", hash_column: str = "record_hash",
                   time: str = "created_at", tie: str = "evidence_id") -> DataFrame:
    """Latest evidence row per (item, source type, hash), columns conformed."""
    conformed = df.withColumns({
        source_type: F.lower(source_type),
        "evidence_length": F.coalesce(F.col("evidence_length"), F.length("evidence_text")).cast("bigint"),
        "evidence_quality_score": clamp01("evidence_quality_score"),
        "evidence_quality_class": F.coalesce(
            F.col("evidence_quality_class") if "evidence_quality_class" in df.columns else F.lit(None).cast("string"),
            F.lit("unknown"),
        ),
        "is_recipe_signal": F.coalesce("is_recipe_signal", F.lit(False)),
    })
    return latest_per_key(conformed, [key, source_type, hash_column], time, [F.col(tie).desc()])


def evidence_order(tie: str = "evidence_id") -> list[Column]:
    return [
        F.col("evidence_quality_score").desc_nulls_last(),
        F.col("evidence_length").desc_nulls_last(),
        F.col("created_at").desc_nulls_last(),
        F.col(tie).desc(),
    ]


def rank_evidence(df: DataFrame, key: str = "raw_id", n: int | None = None, tie: str = "evidence_id") -> DataFrame:
    """Rank evidence within its item; with ``n`` only the first n ranks.

    Without ``n`` every row is ranked, slice by slice of equal score and day, so
    that one item with very many rows is spread over many tasks.
    """
    rows = df.filter(F.col("evidence_length") > 0)
    if n is not None:
        return top_per_key(rows, [key], evidence_order(tie), n, "evidence_rank")
    from clipcatalog.operators.ordinals import rank_in_slices

    return rank_in_slices(
        rows, [key],
        [(F.col("evidence_quality_score"), True), (F.col("evidence_length"), True),
         (F.date_trunc("day", "created_at"), True)],
        evidence_order(tie), "evidence_rank",
    )


def status_order(c) -> Column:
    s = as_col(c)
    chain = F.when(s == vocab.RECIPE_STATUSES[0], 1)
    for i, status in enumerate(vocab.RECIPE_STATUSES[1:3], start=2):
        chain = chain.when(s == status, i)
    return chain.otherwise(4)


def best_row_per_key(df: DataFrame, key: str = "content_key", tie: str = "raw_id",
                     order: list[Column] | None = None) -> DataFrame:
    """Best row per business key: quality, status, then four tie-breaking scores."""
    order = order or [
        F.col("recipe_quality_score").desc_nulls_last(),
        status_order("recipe_status").asc(),
        F.col("final_recipe_confidence").desc_nulls_last(),
        F.col("caption_completeness_score").desc_nulls_last(),
        F.col("processing_confidence").desc_nulls_last(),
        F.col("processed_at").desc_nulls_last(),
    ]
    return top_per_key(df, [key], [*order, F.col(tie).asc()])


def best_source_row(df: DataFrame, keys: list[str], enriched: Column, tie: str) -> DataFrame:
    """Best landing row per key: longest evidence, then description, then enriched."""
    def size(name):
        return F.length(F.coalesce(F.col(name), F.lit("")))

    return top_per_key(df, keys, [
        size("evidence_text").desc(), size("description").desc(),
        F.when(enriched, 1).otherwise(0).desc(), F.col("source_file").desc_nulls_last(), F.col(tie).desc(),
    ])


def latest_attempt_per_method(attempts: DataFrame, now: Column, hours: int, tie: list[Column],
                              keys: list[str] | None = None, time: str = "created_at") -> DataFrame:
    """Newest attempt per item and method inside the retry window."""
    recent = attempts.filter(F.col(time) >= now - F.make_dt_interval(hours=F.lit(hours)))
    return latest_per_key(recent, keys or ["raw_id", "method"], time, tie)


def first_seen_dedupe(df: DataFrame, key: str, ordinal: list[str], n: int | None = None) -> DataFrame:
    """First row per key in input order, then at most ``n`` rows in that order."""
    first = top_per_key(df, [key], [F.col(o).asc_nulls_last() for o in ordinal])
    return first if n is None else first.orderBy(*[F.col(o).asc_nulls_last() for o in ordinal]).limit(n)


def oldest_first_batch(df: DataFrame, n: int, time: str = "ingested_at", tie: str = "raw_id") -> DataFrame:
    return df.orderBy(F.col(time).asc_nulls_last(), F.col(tie).asc()).limit(n)


def concat_sources(*frames: DataFrame, source: str = "source_no") -> DataFrame:
    """Row sets appended in a fixed order; ``source_no`` remembers the order."""
    tagged = [f.withColumn(source, F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def resume_order(creators: DataFrame, state: DataFrame, now: Column, hours: float, key: str = "creator") -> DataFrame:
    """Work order: creators not done recently first, then oldest completion, then name."""
    from clipcatalog.operators.recovery import creator_recent

    s = state.select(key, creator_recent("status", "completed_at", now, hours).alias("recent"),
                     F.coalesce("completed_at", F.lit("")).alias("completed_at"))
    return (
        creators.select(key).distinct().join(s, key, "left")
        .select(key, F.coalesce("recent", F.lit(False)).alias("recent"),
                F.coalesce("completed_at", F.lit("")).alias("completed_at"))
        .orderBy("recent", "completed_at", key)
    )


def top_comments(comments: DataFrame, key: str = "item_id", ordinal: str = "ordinal", text: str = "comment_text",
                 k: int = 8) -> DataFrame:
    """The k most useful comments per item as a bulleted text with a confidence."""
    clean = computed(comments, {"_text": normalize_caption(text)}, [key, ordinal]).filter("_text != ''")
    scanned = clean.groupBy(key).agg(F.count(F.lit(1)).alias("comments_scanned"))
    best = top_per_key(
        clean, [key],
        [comment_signal("_text").desc(), F.length("_text").desc(), F.col(ordinal).asc()], k, "_rank",
    )
    joined = best.groupBy(key).agg(
        F.expr("listagg(concat('- ', _text), '\n') within group (order by _rank)").alias("comment_text"),
        F.count(F.lit(1)).alias("comments_used"),
    )
    return joined.join(scanned, key).withColumn(
        "confidence", F.when(comment_signal("comment_text"), 0.65).otherwise(0.35)
    )


def best_caption(candidates: DataFrame, key: str, ordinal: str, text: str = "candidate",
                 existing: str = "existing") -> DataFrame:
    """Best replacement caption per item: recipe signal first, then length."""
    clean = computed(candidates, {"caption": normalize_caption(text)}, [key, ordinal, existing]).filter(
        looks_like_caption("caption", existing))
    return top_per_key(
        computed(clean, {"_signal": recipe_signal("caption")}), [key],
        [F.col("_signal").desc(), F.length("caption").desc(), F.col(ordinal).asc()],
    ).select(key, "caption", F.lit("web_metadata").alias("source"))


def longest_page(pages: DataFrame, key: str, ordinal: str, text: str = "page_text", url: str = "url",
                 first: int = 3, chars: int = vocab.PAGE_CHARS) -> DataFrame:
    """Longest page among the first links of an item, cut at ``chars``."""
    tried = top_per_key(pages, [key], [F.col(ordinal).asc()], first)
    return (
        top_per_key(tried.filter(F.coalesce(F.col(text), F.lit("")) != ""), [key],
                    [F.length(text).desc(), F.col(ordinal).asc()])
        .select(key, F.col(url).alias("best_url"), F.substring(text, 1, chars).alias("best_text"),
                F.when(recipe_signal(text), 0.75).otherwise(0.45).alias("confidence"))
    )
