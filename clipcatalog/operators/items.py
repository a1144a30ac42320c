"""Raw video objects and detection events to catalog columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcatalog import schemas, vocab
from clipcatalog.functions.columns import as_col, empty_to_null, strip
from clipcatalog.functions.text import infer_language, normalize_caption, recipe_signal
from clipcatalog.operators.staging import computed


def _stripped(c) -> Column:
    return empty_to_null(strip(c))


def creator_name(author: Column, fallback=None) -> Column:
    """First set name of an author object, stripped."""
    names = [empty_to_null(author[n]) for n in ("uniqueId", "unique_id", "nickname")]
    if fallback is not None:
        names.append(empty_to_null(fallback))
    return strip(F.coalesce(*names, F.lit("unknown_creator")))


def epoch_to_iso(seconds) -> Column:
    """Epoch seconds to ISO-8601 text in UTC; NULL for zero or bad values."""
    number = strip(as_col(seconds)).try_cast("bigint")
    moment = F.date_format(
        F.convert_timezone(F.lit("UTC"), F.lit("UTC"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
        + F.make_dt_interval(secs=number.cast("decimal(18,6)")),
        "yyyy-MM-dd'T'HH:mm:ss",
    )
    in_range = F.when((number != 0) & number.between(-62135596800, 253402300799), moment)
    return F.concat(in_range, F.lit("+00:00"))


def item_from_raw_json(
    df: DataFrame, item: str = "item", fallback_creator=None, require_signal: bool = True,
    keep: list[str] | None = None,
) -> DataFrame:
    """Raw video JSON to the 19-column discovery row.

    Rows without an id or caption are dropped, and with ``require_signal`` also
    rows whose caption has no recipe signal.
    """
    keep = keep or []
    v = F.col("_v")
    parsed = computed(df, {"_v": F.from_json(item, schemas.VIDEO_ITEM)}, keep)
    base = computed(parsed, {
        "CONTENT_ID": F.coalesce(_stripped(v["id"]), F.lit("")),
        "DESCRIPTION": normalize_caption(v["desc"]),
        "CREATOR_USERNAME": creator_name(v["author"], fallback_creator),
        "_published": epoch_to_iso(v["createTime"]),
    }, keep).filter((F.col("CONTENT_ID") != "") & (F.col("DESCRIPTION") != ""))
    if require_signal:
        base = base.filter(recipe_signal("DESCRIPTION"))
    profile = F.concat(F.lit("https://www.tiktok.com/@"), "CREATOR_USERNAME")
    url = F.concat(profile, F.lit("/video/"), "CONTENT_ID")
    caption = F.col("DESCRIPTION")
    return base.select(
        *keep,
        F.substring(caption, 1, vocab.TITLE_CHARS).alias("TITLE"),
        caption,
        url.alias("URL_TIKTOK"),
        F.lit("tiktok").alias("PLATFORM"),
        "CONTENT_ID",
        "CREATOR_USERNAME",
        profile.alias("SOURCE_PLATFORM_URL"),
        infer_language(caption).alias("RECIPE_LANGUAGE_HINT"),
        F.lit("").alias("CUISINE_HINT"),
        F.lit("").alias("MAIN_INGREDIENT_HINT"),
        F.lit("true").alias("DESCRIPTION_IS_PARTIAL"),
        F.lit("tiktokapi_discovery").alias("DATA_ORIGIN"),
        F.when(F.col("_published").isNull(), url)
        .otherwise(F.concat(url, F.lit("?published_at="), "_published")).alias("VERIFICATION_SOURCE_URL"),
        F.lit("tiktokapi_desc").alias("DESCRIPTION_SOURCE"),
        F.length(caption).cast("string").alias("DESCRIPTION_LENGTH"),
        F.lit("false").alias("DESCRIPTION_ENRICHED"),
        caption.alias("ORIGINAL_DESCRIPTION"),
        F.lit("").alias("RECOVERED_TEXT"),
        caption.alias("EVIDENCE_TEXT"),
    )


def reject_rows(
    df: DataFrame, item: str = "item", source_type: str = "creator", source_value="", keep: list[str] | None = None
) -> DataFrame:
    """The complement of ``item_from_raw_json``: rejected items with a reason."""
    keep = keep or []
    v = F.col("_v")
    value = F.lit(source_value) if isinstance(source_value, str) else source_value
    parsed = computed(df, {"SOURCE_VALUE": value, "_v": F.from_json(item, schemas.VIDEO_ITEM)}, keep)
    rows = computed(parsed, {
        "CONTENT_ID": F.coalesce(strip(v["id"]), F.lit("")),
        "CREATOR_USERNAME": creator_name(v["author"]),
        "DESCRIPTION": F.coalesce(strip(v["desc"]), F.lit("")),
        "_caption": normalize_caption(v["desc"]),
    }, [*keep, "SOURCE_VALUE"])
    passes = (F.col("CONTENT_ID") != "") & (F.col("_caption") != "") & recipe_signal("_caption")
    return rows.filter(~passes).select(
        *keep,
        F.lit(source_type).alias("SOURCE_TYPE"), "SOURCE_VALUE", "CONTENT_ID", "CREATOR_USERNAME", "DESCRIPTION",
        F.lit("missing_recipe_signal_or_required_fields").alias("REJECT_REASON"),
    )
