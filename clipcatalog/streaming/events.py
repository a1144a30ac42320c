"""Events as columns: reading, normalising, building and publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcatalog import schemas
from clipcatalog.functions.columns import as_col, event_hash, is_json, legacy_event_hash, strip
from clipcatalog.operators.staging import computed


def read_events(spark: SparkSession, source: dict, schema: T.StructType | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    """JSON event stream from its beginning.

    ``source``: ``{"kafka": {...options}}`` or ``{"path": folder}`` of JSON lines.
    The raw text stays in ``value`` beside the parsed ``event`` (NULL when it is
    not a JSON object).
    """
    if "kafka" in source:
        stream = spark.readStream.format("kafka").options(startingOffsets="earliest", **source["kafka"]).load()
        raw = stream.select(F.col("value").cast("string").alias("value"))
    else:
        reader = spark.readStream
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        raw = reader.text(source["path"])
    return parse_events(raw, schema)


def parse_events(raw: DataFrame, schema: T.StructType | None = None, value: str = "value") -> DataFrame:
    parsed = F.from_json(F.col(value), schema or schemas.DETECTION_EVENT)
    is_object = F.ltrim(F.col(value)).startswith("{") & is_json(value)
    # computed once: every later use would otherwise parse the text again
    return computed(raw, {"event": F.when(is_object, parsed)})


def write_events(df: DataFrame, sink: dict, columns: list[str] | None = None, key: str | None = None):
    """Rows as JSON events to Kafka or to a folder; batch or stream alike.

    Returns the streaming query for a stream, None for a batch.
    """
    names = columns or df.columns
    out = df.select(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"),
                    *([F.col(key).cast("string").alias("key")] if key else []))
    if "kafka" in sink:
        fmt, options = "kafka", dict(sink["kafka"])
    else:
        fmt, options, out = "text", {"path": sink["path"]}, out.select("value")
    if df.isStreaming:
        return out.writeStream.format(fmt).options(**options, checkpointLocation=sink["checkpoint"]).trigger(
            availableNow=True).start()
    writer = out.write.format(fmt)
    (writer.options(**options) if fmt == "kafka" else writer.mode("append").options(**options)).save()
    return None


def replay_events(df: DataFrame, path: str, time: str, slices: int, columns: list[str] | None = None) -> None:
    """A table as files of JSON events that a file stream reads in the order of time.

    The time span is cut into equal ``slices``, written one after the other.  Within a slice rows
    are in no order, so a watermark on them needs a delay of at least a slice.  Rows without a time come first.
    """
    first, last = df.agg(F.min(F.unix_micros(F.col(time).cast("timestamp"))), F.max(F.unix_micros(F.col(time).cast("timestamp")))).first()
    width = ((last or 0) - (first or 0)) // slices + 1
    at = F.coalesce(F.floor((F.unix_micros(F.col(time).cast("timestamp")) - (first or 0)) / width), F.lit(0))
    for k in range(slices):
        write_events(df.filter(at == k), {"path": path}, columns)


def normalize_event(df: DataFrame, event: str = "event", keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows) of parsed events.

    Valid rows have an item id and a URL; names have aliases, texts are trimmed,
    an absent or blank platform becomes the default.
    """
    keep = keep or []
    e = F.col(event)

    def text(*names):
        picked = [F.nullif(e[n], F.lit("")) for n in names]
        return strip(F.coalesce(*picked, F.lit("")))

    rows = df.select(
        *keep,
        "value",
        e.isNotNull().alias("_parsed"),
        F.coalesce(F.nullif(text("platform"), F.lit("")), F.lit("tiktok")).alias("platform"),
        text("creator_username").alias("creator_username"),
        text("content_id", "video_id").alias("content_id"),
        text("title").alias("title"),
        text("description").alias("description"),
        F.coalesce(e["description_is_partial"], F.lit(False)).alias("description_is_partial"),
        text("url_tiktok", "url").alias("url"),
        F.coalesce(e["raw_payload"], F.lit("{}")).alias("raw_payload"),
    )
    good = F.col("_parsed") & (F.col("content_id") != "") & (F.col("url") != "")
    valid = rows.filter(good).select(
        *keep, "platform", "creator_username", "content_id", "title", "description", "description_is_partial", "url",
        F.concat_ws("_", F.lit("kafka"), "platform",
                    F.coalesce(F.nullif("creator_username", F.lit("")), F.lit("unknown_creator"))).alias("source_file"),
        "raw_payload", event_hash("content_id", "url").alias("record_hash"),
    )
    invalid = rows.filter(~good).select(
        *keep, "value",
        F.when(~F.col("_parsed"), "not a JSON object").when(F.col("content_id") == "", "missing content id")
        .otherwise("missing url").alias("error"),
    )
    return valid, invalid


def normalize_legacy_event(df: DataFrame, event: str = "event", keep: list[str] | None = None) -> DataFrame:
    """Old event form: title and URL required, default source label."""
    keep = keep or []
    e = F.col(event)

    def text(name):
        return strip(F.coalesce(e[name], F.lit("")))

    rows = df.select(
        *keep, text("TITLE").alias("title"), text("DESCRIPTION").alias("description"), text("URL_TIKTOK").alias("url"),
        F.coalesce(F.nullif(text("SOURCE_FILE"), F.lit("")), F.lit("kafka_event")).alias("source_file"),
    )
    return rows.filter("title != '' AND url != ''").withColumn(
        "record_hash", legacy_event_hash("title", "description", "url"))


def build_event(items: DataFrame, now: Column, source_system: str, event_type: str = "new_tiktok_video_detected",
                keep: list[str] | None = None) -> DataFrame:
    """Content items to detection events, with both names of id and URL."""
    def optional(name, kind="string"):
        return F.col(name) if name in items.columns else F.lit(None).cast(kind)

    return items.select(
        *(keep or []),
        F.lit(event_type).alias("event_type"), as_col(now).alias("detected_at"),
        F.lit(source_system).alias("source_system"), "platform", "creator_username",
        F.col("content_id").alias("video_id"), "content_id", optional("published_at").alias("published_at"),
        "title", "description", F.col("url").alias("url_tiktok"), "url",
        optional("language_hint").alias("language_hint"),
        F.coalesce(optional("description_is_partial", "boolean"), F.lit(False)).alias("description_is_partial"),
        optional("raw_payload").alias("raw_payload"),
    )


