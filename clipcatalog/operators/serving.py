"""Serving queries: lists, look-ups, search, facets, dashboard metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcatalog import schemas, vocab
from clipcatalog.functions.columns import video_id_from_url


def published(min_score: float = 0.60, min_ingredients: int = 2, min_steps: int = 1,
              statuses: list[str] | None = None) -> Column:
    """True for catalog rows good enough to publish."""
    return (
        F.col("is_recipe")
        & F.col("recipe_status").isin(statuses or vocab.PUBLISHED_STATUSES)
        & (F.col("recipe_quality_score") >= min_score)
        & (F.coalesce("ingredient_count", F.lit(0)) >= min_ingredients)
        & (F.coalesce("step_count", F.lit(0)) >= min_steps)
        & F.col("final_recipe_text").isNotNull()
        & (F.trim("final_recipe_text") != "")
    )


def serving_gate(df: DataFrame, **limits) -> DataFrame:
    """Rows good enough to publish; ``limits`` as in ``published``."""
    return df.filter(published(**limits))


def serving_projection(df: DataFrame, consumer: str = "api") -> DataFrame:
    """Columns of one consumer: ``api``, ``dashboard`` or ``debug``."""
    layout = {
        "api": schemas.API_COLUMNS,
        "dashboard": [(c, c) for c in schemas.DASHBOARD_COLUMNS],
        "debug": [(c, c) for c in schemas.DEBUG_COLUMNS],
    }[consumer]
    return df.select(*[F.col(c).alias(n) for c, n in layout])


def list_query(df: DataFrame, equals: dict[str, str | None] | None = None, flags: dict[str, bool | None] | None = None,
               limit: int = 50, order: str = "processed_at", tie: str = "id") -> DataFrame:
    """Newest rows under optional filters; texts compare in any case."""
    if not 1 <= limit <= 500:
        raise ValueError("limit must be between 1 and 500")
    for name, value in (equals or {}).items():
        if value:
            df = df.filter(F.lower(name) == value.lower())
    for name, flag in (flags or {}).items():
        if flag is not None:
            df = df.filter(F.col(name) == flag)
    return df.orderBy(F.col(order).desc_nulls_last(), F.col(tie).asc()).limit(limit)


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == value).limit(1)


def substring_search(df: DataFrame, columns: list[str], query: str | None, concatenated: bool = True) -> DataFrame:
    """Literal text search in any case, over the joined columns or each of them."""
    wanted = (query or "").strip().lower()
    if not wanted:
        return df
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    if concatenated:
        return df.filter(F.contains(F.lower(F.concat_ws(" ", *texts)), F.lit(wanted)))
    return df.filter(reduce(lambda a, b: a | b, [F.contains(F.lower(t), F.lit(wanted)) for t in texts]))


def facet_filter(df: DataFrame, in_lists: dict[str, list[str] | None] | None = None, min_confidence: float = 0.0,
                 confidence: str = "processing_confidence", dietary: str = "all", flag: str = "is_vegetarian",
                 search: str | None = None, search_columns: list[str] | None = None,
                 empty_selects_nothing: bool = False) -> DataFrame:
    """Dashboard filter; an active list drops NULLs, an empty list means no filter.

    ``empty_selects_nothing=True`` is the strict form, where an empty list
    matches no row; ``None`` always means no filter.
    """
    for name, values in (in_lists or {}).items():
        if values:
            df = df.filter(F.col(name).isin(values))
        elif values is not None and empty_selects_nothing:
            df = df.filter(F.lit(False))
    df = df.filter(F.coalesce(confidence, F.lit(0.0)) >= min_confidence)
    if dietary != "all":
        df = df.filter(F.coalesce(flag, F.lit(False)) == (dietary == "vegetarian"))
    return substring_search(df, search_columns or [], search) if search_columns else df


def review_queue(df: DataFrame, threshold: float = 0.75, n: int = 100, columns: list[str] | None = None,
                 confidence: str = "processing_confidence", order: list[Column] | None = None) -> DataFrame:
    """Low-confidence rows to review, the first ``n`` in a total order."""
    return (
        df.filter(F.coalesce(confidence, F.lit(0.0)) < threshold)
        .orderBy(*(order or [F.col("processed_at").desc_nulls_last(), F.col("raw_id").asc()]))
        .select(*(columns or schemas.REVIEW_COLUMNS))
        .limit(n)
    )


SORT_MODES = {
    "newest": ("processed_at", True),
    "quality": ("recipe_quality_score", True),
    "confidence_high": ("processing_confidence", True),
    "confidence_low": ("processing_confidence", False),
    "title": ("display_title", False),
}
PAGE_SIZES = (12, 24, 48, 96)


def sorted_page(df: DataFrame, mode: str = "newest", n: int = 24, tie: str = "raw_id",
                modes: dict[str, tuple[str, bool]] | None = None) -> DataFrame:
    """One page of results in one of five orders, NULLs last."""
    if n not in PAGE_SIZES:
        raise ValueError(f"page size must be one of {PAGE_SIZES}")
    column, descending = (modes or SORT_MODES)[mode]
    key = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
    return df.orderBy(key, F.col(tie).asc()).limit(n)


def latest_n(df: DataFrame, n: int | None = 8, columns: list[str] | None = None, time: str = "processed_at",
             tie: str = "raw_id") -> DataFrame:
    """Newest rows; the whole table newest first when ``n`` is None."""
    ordered = df.orderBy(F.col(time).desc_nulls_last(), F.col(tie).asc())
    ordered = ordered if n is None else ordered.limit(n)
    return ordered.select(*(columns or schemas.LATEST_COLUMNS))


def value_counts_topn(df: DataFrame, column: str, n: int = 12, name: str = "recipe_count") -> DataFrame:
    """Most frequent values, NULL and empty counted as ``unknown``."""
    value = F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit("unknown"))
    return (
        df.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.col(name).desc(), F.col(column).asc()).limit(n)
    )


def facet_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-empty values of every facet as sorted ``facet, value`` rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(*columns).distinct().select(F.explode(pairs).alias("p")).select("p.facet", "p.value")
        .filter(F.coalesce("value", F.lit("")) != "").distinct().orderBy("facet", "value")
    )


def kpi_row(everything: DataFrame, visible: DataFrame, flag: str = "is_vegetarian",
            measure: str = "processing_confidence", distincts: dict[str, str] | None = None) -> DataFrame:
    """Catalog size beside share, average and spreads of the visible rows."""
    distincts = distincts or {"cuisine_style": "distinct_cuisines", "main_ingredient": "distinct_ingredients"}
    share = F.avg(F.coalesce(flag, F.lit(False)).cast("double")) * 100
    seen = visible.agg(
        F.count(F.lit(1)).alias("visible_recipes"),
        F.coalesce(share, F.lit(0.0)).alias("vegetarian_pct"),
        F.coalesce(F.avg(measure), F.lit(0.0)).alias("avg_confidence"),
        *[F.count_distinct(F.col(c)).alias(n) for c, n in distincts.items()],
    )
    return everything.agg(F.count(F.lit(1)).alias("total_recipes")).crossJoin(seen)


def search_metrics(results: DataFrame, quality: str = "recipe_quality_score") -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("matches"), F.count_distinct("cuisine_style").alias("cuisines"),
        F.count_distinct("main_ingredient").alias("ingredients"),
        F.coalesce(F.avg(quality), F.lit(0.0)).alias("avg_quality"),
    )


def field_completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per text column: unknown count, missing count and unknown rate; one scan."""
    def unknown(c):
        return F.count_if(F.lower(F.coalesce(F.col(c).cast("string"), F.lit("unknown"))) == "unknown")

    totals = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[unknown(c).alias(f"_u{i}") for i, c in enumerate(columns)],
        *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("field"), F.col(f"_u{i}").alias("unknown_count"), F.col(f"_m{i}").alias("missing_count"),
            F.coalesce(F.round(F.try_divide(F.col(f"_u{i}").cast("double"), F.col("_n").cast("double")), 4),
                       F.lit(0.0)).alias("unknown_rate"),
        )
        for i, c in enumerate(columns)
    ])
    return totals.select(F.inline(rows))


def confidence_buckets(df: DataFrame, column: str, edges: tuple[float, ...] = (0.5, 0.75, 0.9, 1.0),
                       labels: tuple[str, ...] = ("0-0.50", "0.50-0.75", "0.75-0.90", "0.90-1.00")) -> DataFrame:
    """Counts per right-closed bin; values outside all bins are ``unknown``."""
    value = F.coalesce(F.col(column), F.lit(0.0))
    chain = F.when(value < 0, "unknown")
    for edge, label in zip(edges, labels):
        chain = chain.when(value <= edge, label)
    return df.groupBy(chain.otherwise("unknown").alias("confidence_bucket")).agg(
        F.count(F.lit(1)).alias("recipe_count")
    )


def dietary_split(df: DataFrame, flag: str = "is_vegetarian") -> DataFrame:
    name = F.when(F.coalesce(flag, F.lit(False)), "Vegetarian").otherwise("Non-vegetarian")
    return df.groupBy(name.alias("dietary_class")).agg(F.count(F.lit(1)).alias("recipe_count"))


def threshold_counts(df: DataFrame, spec: dict[str, tuple[str, float]]) -> DataFrame:
    """Rows below a threshold per measure: ``{name: (column, threshold)}``."""
    return df.agg(*[
        F.count_if(F.coalesce(c, F.lit(0.0)) < t).alias(name) for name, (c, t) in spec.items()
    ])


def home_stats(recipes: DataFrame, media: DataFrame, url: str = "url_tiktok", language: str = "language",
               cuisine: str = "cuisine_style", media_key: str = "video_id") -> DataFrame:
    """Matches, distinct languages and cuisines, and rows with a media file."""
    ids = media.select(F.col(media_key).alias("_video")).distinct().withColumn("_has", F.lit(True))
    rows = recipes.select(language, cuisine, video_id_from_url(url).alias("_video")).join(ids, "_video", "left")
    return rows.agg(
        F.count(F.lit(1)).alias("recipes"),
        F.count_distinct(F.nullif(F.col(language), F.lit(""))).alias("languages"),
        F.count_distinct(F.nullif(F.col(cuisine), F.lit(""))).alias("cuisines"),
        F.count_if(F.coalesce("_has", F.lit(False))).alias("with_thumbnails"),
    )


def score_range(df: DataFrame, column: str) -> DataFrame:
    """Smallest value with NULL as 0, largest with NULL as 1."""
    return df.agg(
        F.min(F.coalesce(column, F.lit(0.0))).alias("min_confidence"),
        F.max(F.coalesce(column, F.lit(1.0))).alias("max_confidence"),
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One labelled row count per layer."""
    counts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(label).alias("layer"), "records")
              for label, df in layers.items()]
    return reduce(lambda a, b: a.unionAll(b), counts)


def enrich_with(rows: DataFrame, answer, key: str, prompt: str) -> DataFrame:
    """Ask a caller-supplied function for an answer to each prompt.

    ``answer`` maps a list of prompts to a list of answers; it runs on executors
    over Arrow batches.  An exception in the place of an answer marks that prompt
    as failed without asking again.  Only when the call itself raises, or gives
    another number of answers, are its prompts asked one by one.  A failing row
    gets ``status = 'failed'`` and its error text, and never fails the job.
    """
    key_type = rows.schema[key].dataType.simpleString()

    def ask_one(one):
        try:
            return answer([one])[0]
        except Exception as error:  # noqa: BLE001
            return error

    def run(batches):
        import pandas as pd

        for batch in batches:
            prompts = batch[prompt].tolist()
            try:
                answers = list(answer(prompts))
                if len(answers) != len(prompts):
                    raise ValueError("one answer per prompt expected")
            except Exception:  # the call as a whole failed
                answers = [ask_one(one) for one in prompts]
            errors = [f"{type(a).__name__}: {a}" if isinstance(a, Exception) else None for a in answers]
            answers = [None if isinstance(a, Exception) else a for a in answers]
            yield pd.DataFrame({
                key: batch[key], "response": answers,
                "status": ["ok" if e is None else "failed" for e in errors], "error": errors,
            })

    return rows.select(key, prompt).mapInPandas(run, f"{key} {key_type}, response string, status string, error string")
