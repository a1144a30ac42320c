"""Group-by reports and ordered text roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions.text import normalize_caption
from clipcatalog.operators.joins import left_join_features, scalar_cross_join
from clipcatalog.operators.ordinals import rank_in_slices
from clipcatalog.operators.ranking import rank_evidence
from clipcatalog.operators.staging import computed


def _rows() -> Column:
    return F.count(F.lit(1))


def _flag_count(flag: str | Column) -> Column:
    condition = F.col(flag) if isinstance(flag, str) else flag
    return F.coalesce(F.count_if(condition), F.lit(0))


def _distincts(distincts: dict[str, str], approximate: bool) -> list[Column]:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return [count(F.col(c)).alias(n) for c, n in distincts.items()]


def catalog_summary(df: DataFrame, flag: str, measure: str, distincts: dict[str, str], now: Column,
                    approximate: bool = False, names: tuple[str, str, str] = (
                        "total_recipes", "vegetarian_recipes", "avg_processing_confidence")) -> DataFrame:
    """One row: count, flagged count, average and distinct counts.

    ``distincts`` maps a column to its output name; ``approximate=True`` swaps
    exact distinct counts for sketches when the columns have very many values.
    """
    return df.agg(
        _rows().alias(names[0]), _flag_count(flag).alias(names[1]), F.avg(measure).alias(names[2]),
        *_distincts(distincts, approximate),
    ).withColumn("generated_at", now)


def rollup(df: DataFrame, dimension: str, measure: str, distincts: dict[str, str], now: Column,
           flag: str | None = None, approximate: bool = False, count: str = "recipe_count",
           flagged: str = "vegetarian_count", average: str = "avg_processing_confidence") -> DataFrame:
    """Per group: count, flagged count, average, distinct counts; largest first."""
    measures = [_rows().alias(count)]
    if flag is not None:
        measures.append(_flag_count(flag).alias(flagged))
    measures.append(F.avg(measure).alias(average))
    return (
        df.groupBy(dimension).agg(*measures, *_distincts(distincts, approximate))
        .withColumn("generated_at", now)
        .orderBy(F.col(count).desc(), F.col(dimension).asc_nulls_last())
    )


def rollup_by_cuisine(df: DataFrame, now: Column, dimension: str = "cuisine_style", **kw) -> DataFrame:
    args = {"measure": "processing_confidence", "flag": "is_vegetarian",
            "distincts": {"recipe_language": "distinct_languages"}, **kw}
    return rollup(df, dimension, now=now, **args)


def rollup_by_ingredient(df: DataFrame, now: Column, dimension: str = "main_ingredient", **kw) -> DataFrame:
    args = {"measure": "processing_confidence", "flag": "is_vegetarian",
            "distincts": {"recipe_language": "distinct_languages"}, **kw}
    return rollup(df, dimension, now=now, **args)


def rollup_by_language(df: DataFrame, now: Column, dimension: str = "recipe_language", **kw) -> DataFrame:
    args = {"measure": "processing_confidence", "flag": "is_vegetarian",
            "distincts": {"cuisine_style": "distinct_cuisines", "main_ingredient": "distinct_main_ingredients"}, **kw}
    return rollup(df, dimension, now=now, **args)


def rollup_by_model(df: DataFrame, now: Column, dimension: str = "model_name", **kw) -> DataFrame:
    args = {"measure": "processing_confidence",
            "distincts": {"recipe_language": "distinct_languages", "cuisine_style": "distinct_cuisines"}, **kw}
    return rollup(df, dimension, now=now, **args)


def evidence_rollup(evidence: DataFrame, key: str = "raw_id", top: int = 5) -> DataFrame:
    """Per item: score statistics, counts by source, and the top texts joined.

    Statistics are combined before the shuffle; texts travel only for the top
    ranks.  Both halves are partitioned by the key, so their join adds no shuffle.
    """
    rows = evidence.filter(F.col("evidence_length") > 0)
    stats = rows.groupBy(key).agg(
        F.max("evidence_quality_score").alias("best_evidence_quality_score"),
        F.avg("evidence_quality_score").alias("avg_evidence_quality_score"),
        _rows().alias("evidence_source_count"),
        F.count_if(F.col("source_type") == "video_ocr").alias("ocr_source_count"),
        F.count_if(F.col("source_type") == "audio_transcript").alias("audio_source_count"),
        F.count_if(F.col("source_type") == "comments").alias("comment_source_count"),
        F.count_if(F.col("is_recipe_signal")).alias("recipe_signal_count"),
    )
    separator = vocab.EVIDENCE_SEPARATOR.replace("\n", "\\n")
    texts = rank_evidence(rows, key, top).groupBy(key).agg(
        F.expr(f"listagg(evidence_text, '{separator}') within group (order by evidence_rank)").alias(
            "best_evidence_text")
    )
    return left_join_features(stats, texts, key, {"best_evidence_text": None})


def evidence_stats(evidence: DataFrame, min_score: float = 0.20, key: str = "raw_id") -> DataFrame:
    """Per item: best score and latest time of its usable evidence."""
    return usable_evidence(evidence, min_score).groupBy(key).agg(
        F.max("evidence_quality_score").alias("evidence_quality_score"),
        F.max("created_at").alias("latest_evidence_at"),
    )


def usable_evidence(evidence: DataFrame, min_score: float) -> DataFrame:
    return evidence.filter(
        (F.coalesce("evidence_length", F.lit(0)) > 0)
        & (F.coalesce("evidence_quality_score", F.lit(0.0)) >= min_score)
    )


def evidence_concat(evidence: DataFrame, key: str = "raw_id", min_score: float = 0.20, part_rows: int = 1000,
                    tie: str = "evidence_id") -> DataFrame:
    """Per item: all usable texts joined, best score, latest time.

    One row per item as long as it has at most ``part_rows`` texts.  A larger item
    continues in further rows (``part_no`` 0, 1, 2, ...), so nothing is dropped and
    no task or cell has to hold an unbounded item.
    """
    ranked = rank_in_slices(
        usable_evidence(evidence, min_score), [key],
        [(F.col("evidence_quality_score"), True), (F.date_trunc("hour", "created_at"), True)],
        [F.col("created_at").desc_nulls_last(), F.col(tie).desc()], "_rank",
        {"_best": "evidence_quality_score", "_latest": "created_at"},
    ).withColumn("part_no", F.floor((F.col("_rank") - 1) / part_rows).cast("bigint"))
    return ranked.groupBy(key, "part_no").agg(
        F.expr("listagg(evidence_text, '\\n\\n') within group (order by _rank)").alias("recovery_text"),
        F.max("_best").alias("evidence_quality_score"), F.max("_latest").alias("latest_evidence_at"),
    )


def best_score_per_key(df: DataFrame, key: str = "raw_id", score: str = "evidence_quality_score",
                       name: str = "best_score") -> DataFrame:
    return df.groupBy(key).agg(F.max(score).alias(name))


def evidence_source_stats(df: DataFrame, dims: list[str] | None = None) -> DataFrame:
    dims = dims or ["source_type", "evidence_quality_class"]
    return (
        df.groupBy(*dims)
        .agg(_rows().alias("records"), F.avg("evidence_quality_score").alias("avg_confidence"),
             F.avg("evidence_length").alias("avg_text_length"))
        .orderBy(F.col("records").desc(), *[F.col(d).asc_nulls_last() for d in dims])
    )


def duplicate_keys(df: DataFrame, keys: list[str], name: str = "duplicate_business_keys") -> DataFrame:
    """One row: how many keys have more than one row."""
    return df.groupBy(*keys).agg(_rows().alias("_n")).filter("_n > 1").agg(_rows().alias(name))


def _rate(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), F.nullif(whole, F.lit(0)).cast("double"))


def quality_daily(bronze: DataFrame, catalog: DataFrame, published: Column, evidence: DataFrame,
                  run_date: Column) -> DataFrame:
    """One row of layer counts and rates over the whole catalog.

    ``published`` tells which catalog rows are served; they are counted in the same pass.
    """
    c = catalog.agg(
        _rows().alias("n"),
        F.count_if(published).alias("gold_rows"),
        F.count_if(F.col("is_recipe")).alias("recipes"),
        F.count_if(F.col("recipe_status") == "full_recipe").alias("full"),
        F.count_if(F.col("recipe_status") == "partial_recipe").alias("partial"),
        F.count_if(F.col("recipe_status").isin("food_content", "non_recipe") | ~F.col("is_recipe")).alias("rejected"),
        F.avg("recipe_quality_score").alias("avg_recipe_quality_score"),
        F.count_if(F.col("final_recipe_json").isNull()).alias("no_json"),
        F.count_distinct(F.lower("url_tiktok")).alias("urls"),
    )
    e = evidence.agg(
        F.count_if(F.col("source_type") == "video_ocr").alias("ocr"),
        F.count_if((F.col("source_type") == "video_ocr") & F.col("is_recipe_signal")).alias("usable_ocr"),
    )
    row = scalar_cross_join(bronze.agg(_rows().alias("bronze_rows")), c, e)
    n = F.col("n")
    return row.select(
        run_date.alias("run_date"), "bronze_rows", n.alias("silver_rows"), "gold_rows",
        _rate(F.col("recipes"), n).alias("recipe_rate"),
        _rate(F.col("full"), n).alias("full_recipe_rate"),
        _rate(F.col("partial"), n).alias("partial_recipe_rate"),
        _rate(F.col("rejected"), n).alias("rejected_rate"),
        "avg_recipe_quality_score",
        _rate(F.col("no_json"), n).alias("missing_final_json_rate"),
        (n - F.col("urls")).alias("duplicate_url_count"),
        _rate(F.col("usable_ocr"), F.col("ocr")).alias("usable_ocr_rate"),
    )


def creator_quality(bronze: DataFrame, silver: DataFrame, key: str = "raw_id", creator: str = "creator_username",
                    high_yield: float = 0.25) -> DataFrame:
    """Per creator: scanned, extracted and full counts, quality, yield, status."""
    named = bronze.filter(F.coalesce(creator, F.lit("")) != "").select(
        key, F.lower(creator).alias("creator_username"), "ingested_at"
    )
    scanned = named.groupBy("creator_username").agg(
        _rows().alias("videos_scanned"), F.max("ingested_at").alias("last_scanned_at")
    )

    def value(name):
        return F.coalesce(name, F.lit(0.0))

    quality = F.greatest(
        value("final_recipe_confidence"), value("caption_completeness_score"), value("processing_confidence")
    )
    answers = silver.select(key, "is_recipe", "recipe_status", "final_recipe_confidence",
                            "caption_completeness_score", "processing_confidence")
    extracted = named.select(key, "creator_username").join(answers, key, "left").groupBy("creator_username").agg(
        F.count_if("is_recipe").alias("recipes_extracted"),
        F.count_if(F.col("recipe_status") == "full_recipe").alias("full_recipes"),
        F.avg(quality).alias("avg_quality_score"),
    )
    joined = left_join_features(
        scanned, extracted, "creator_username",
        {"recipes_extracted": 0, "full_recipes": 0, "avg_quality_score": 0.0},
    )
    rate = _rate(F.col("full_recipes"), F.col("videos_scanned"))
    return joined.select(
        "creator_username", "videos_scanned", F.col("recipes_extracted").alias("videos_accepted"),
        "recipes_extracted", "full_recipes", "avg_quality_score", rate.alias("yield_rate"), "last_scanned_at",
        F.when(rate >= high_yield, "high_yield").otherwise("active").alias("status"),
    )


def run_summary(attempts: DataFrame, is_evidence: Column) -> DataFrame:
    """Counts by ``method:status``, most common first, with evidence rows."""
    return (
        attempts.groupBy(F.concat_ws(":", "method", "status").alias("outcome"))
        .agg(_rows().alias("attempts"), F.count_if(is_evidence).alias("evidence_rows"))
        .orderBy(F.col("attempts").desc(), F.col("outcome"))
    )


def _joined_pieces(pieces: DataFrame, key: str, separator: str, chars: int, minimum: int) -> DataFrame:
    """Ordered ``_text`` pieces joined and cut at ``chars``.

    A piece adds at least ``minimum`` characters (itself plus a separator), so
    pieces after ``chars / minimum`` lie wholly behind the cut; leaving their text
    out changes nothing and bounds what one item can send to a task.  ``pieces``
    counts all of them.
    """
    needed = chars // minimum + 1
    ranked = rank_in_slices(
        pieces, [key], [(F.floor(F.col("_ordinal") / 1000), False)],
        [F.col("_ordinal").asc(), F.col("_text").asc()], "_rank", total="_pieces",
    )
    kept = ranked.filter(F.col("_rank") <= needed)
    return kept.groupBy(key).agg(
        F.expr(f"listagg(_text, '{separator}') within group (order by _rank)").alias("_joined"),
        F.max("_pieces").alias("pieces"),
    ).withColumn("_joined", F.substring("_joined", 1, chars))


def distinct_lines_concat(pieces: DataFrame, key: str, ordinal: str, text: str,
                          chars: int = vocab.PIECES_CHARS) -> DataFrame:
    """Per item: cleaned pieces, distinct, in first-seen order, newline-joined."""
    lines = (
        computed(pieces, {"_text": normalize_caption(text)}, [key, ordinal])
        .filter("_text != ''")
        .groupBy(key, "_text").agg(F.min(ordinal).alias("_ordinal"))
    )
    return _joined_pieces(lines, key, "\\n", chars, 2).withColumnRenamed("_joined", "text")


def segments_concat(segments: DataFrame, key: str, ordinal: str, text: str, probability: str | None = None,
                    chars: int = vocab.PIECES_CHARS) -> DataFrame:
    """Per item: transcript segments joined by a blank, cut, with a confidence.

    The confidence is the language probability, or 0.9 when it is absent or 0.
    """
    clean = computed(
        segments, {"_ordinal": F.col(ordinal), "_text": normalize_caption(text)}, [key]
    ).filter("_text != ''")
    out = _joined_pieces(clean, key, " ", chars, 2).withColumnRenamed("_joined", "transcript")
    if probability is None:
        return out
    known = segments.groupBy(key).agg(F.max(probability).alias("_p"))
    return left_join_features(out, known, key, {"_p": None}).withColumn(
        "confidence", F.coalesce(F.nullif(F.col("_p").cast("double"), F.lit(0.0)), F.lit(0.9))
    ).drop("_p")
