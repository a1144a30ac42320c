"""Event streams through a file source, drained once, and their batch rules."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcatalog import schemas
from clipcatalog.operators import upsert as U
from clipcatalog.queries import duck as d
from clipcatalog.queries.registry import Inputs, query
from clipcatalog.sources.keyed_table import KeyedTable
from clipcatalog.sources.session import work_path
from clipcatalog.streaming import events as EV
from clipcatalog.streaming import sinks as SK

_J = "CASE WHEN json_valid(value) THEN value END"


def _txt(*names: str) -> str:
    picked = ", ".join(f"nullif({_J}->>'$.{n}', '')" for n in names)
    return d.strip(f"coalesce({picked}, '')")


_EVENTS = f"""
n AS (SELECT event_id, value, json_valid(value) AS ok, coalesce(nullif({_txt('platform')}, ''), 'tiktok') AS platform, {_txt('creator_username')} AS creator_username,
  {_txt('content_id', 'video_id')} AS content_id, {_txt('title')} AS title, {_txt('description')} AS description,
  coalesce(CAST({_J}->>'$.description_is_partial' AS BOOLEAN), false) AS description_is_partial, {_txt('url_tiktok', 'url')} AS url FROM event_json_fx),
v AS (SELECT event_id, platform, creator_username, content_id, title, description, description_is_partial, url,
  'kafka_' || platform || '_' || coalesce(nullif(creator_username, ''), 'unknown_creator') AS source_file,
  sha256(content_id || '|' || url) AS record_hash FROM n WHERE ok AND content_id <> '' AND url <> '')"""


def _publish(t: Inputs, path: str, with_order: bool = False) -> None:
    """The event values as text files, in the partitions the table has."""
    rows = t.fx("event_json_fx")
    if with_order:
        rows = rows.select(F.to_json(F.struct("event_id", "value")).alias("value"))
    rows.select("value").write.text(path)


_ORDERED = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.StringType())])


def _stream(t: Inputs, path: str):
    """Published events with the order number they carry."""
    raw = t.spark.readStream.option("maxFilesPerTrigger", 2).text(path)
    row = F.from_json("value", _ORDERED)
    return EV.parse_events(raw.select(row["event_id"].alias("event_id"), row["value"].alias("value")))


@query("read_events", f"""
SELECT count(*) AS n, count(*) FILTER (json_valid(value)) AS parsed, count(DISTINCT {_J}->>'$.content_id') AS content_ids FROM event_json_fx""")
def _(t: Inputs):
    path, out = work_path(t.spark, "events"), work_path(t.spark, "read-events")
    _publish(t, path)
    stream = EV.read_events(t.spark, {"path": path}, files_per_batch=2)
    SK.bounded_drain(stream, lambda batch, _: batch.write.mode("append").parquet(out), work_path(t.spark, "cp"))
    return t.spark.read.parquet(out).agg(
        F.count(F.lit(1)).alias("n"), F.count("event").alias("parsed"),
        F.count_distinct("event.content_id").alias("content_ids"))


@query("write_events", """
SELECT CAST(to_json({'event_id': event_id, 'event_type': event_type, 'props': CASE WHEN event_id % 2 = 0 THEN props END}) AS VARCHAR) AS value FROM events""")
def _(t: Inputs):
    path = work_path(t.spark, "published")
    rows = t.table("events").select("event_id", "event_type", F.when(F.col("event_id") % 2 == 0, F.col("props")).alias("props"))
    EV.write_events(rows, {"path": path}, ["event_id", "event_type", "props"])
    return t.spark.read.text(path)


@query("normalize_event", f"WITH {_EVENTS} SELECT * FROM v")
def _(t: Inputs):
    valid, _bad = EV.normalize_event(EV.parse_events(t.fx("event_json_fx")), keep=["event_id"])
    return valid.drop("raw_payload")


@query("normalize_event_quarantine", f"""
WITH {_EVENTS} SELECT event_id, value, CASE WHEN NOT ok THEN 'not a JSON object' WHEN content_id = '' THEN 'missing content id' ELSE 'missing url' END AS error
FROM n WHERE NOT (ok AND content_id <> '' AND url <> '')""")
def _(t: Inputs):
    _valid, bad = EV.normalize_event(EV.parse_events(t.fx("event_json_fx")), keep=["event_id"])
    return bad


def _old(name: str) -> str:
    return f"trim(coalesce({_J}->>'$.{name}', ''))"


@query("normalize_event_legacy", f"""
WITH n AS (SELECT event_id, {_old('TITLE')} AS title, {_old('DESCRIPTION')} AS description, {_old('URL_TIKTOK')} AS url,
  coalesce(nullif({_old('SOURCE_FILE')}, ''), 'kafka_event') AS source_file FROM legacy_event_fx)
SELECT *, sha256(title || '|' || description || '|' || url) AS record_hash FROM n WHERE title <> '' AND url <> ''""")
def _(t: Inputs):
    return EV.normalize_legacy_event(EV.parse_events(t.fx("legacy_event_fx"), schemas.LEGACY_EVENT), keep=["event_id"])


_TABLE = T.StructType([
    T.StructField("record_hash", T.StringType()), T.StructField("event_id", T.LongType()),
    T.StructField("platform", T.StringType()), T.StructField("creator_username", T.StringType()),
    T.StructField("content_id", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("description_is_partial", T.BooleanType()),
    T.StructField("url", T.StringType()), T.StructField("source_file", T.StringType()),
])


_LATEST_EVENT = f"""
WITH {_EVENTS} SELECT record_hash, event_id, platform, creator_username, content_id, title, description, description_is_partial, url, source_file FROM v
QUALIFY row_number() OVER (PARTITION BY record_hash ORDER BY event_id DESC) = 1"""


def _drain_into_table(t: Inputs, restart: bool = False):
    path, table_path, checkpoint = (work_path(t.spark, n) for n in ("events", "bronze", "cp"))
    _publish(t, path, with_order=True)
    table = KeyedTable(t.spark, table_path, _TABLE, ["record_hash"], buckets=8)
    rules = U.newer_row_rules(_TABLE.names, "event_id")
    for _run in range(2 if restart else 1):
        valid, _bad = EV.normalize_event(_stream(t, path), keep=["event_id"])
        SK.stream_upsert(valid.select(*_TABLE.names), table, checkpoint, ["record_hash"], [F.col("event_id").desc()], rules)
    return table.read()


@query("stream_upsert", _LATEST_EVENT)
def _(t: Inputs):
    return _drain_into_table(t)


@query("stream_quarantine", f"WITH {_EVENTS} SELECT event_id, value FROM n WHERE NOT (ok AND content_id <> '' AND url <> '')")
def _(t: Inputs):
    """Bad events of a drained stream, written once although every batch is delivered twice."""
    path, table_path, bad = (work_path(t.spark, n) for n in ("events", "bronze", "bad"))
    _publish(t, path, with_order=True)
    table = KeyedTable(t.spark, table_path, _TABLE, ["record_hash"], buckets=8)
    rules = U.newer_row_rules(_TABLE.names, "event_id")
    for _delivery in range(2):
        SK.stream_upsert(
            _stream(t, path), table, work_path(t.spark, "cp"), ["record_hash"], [F.col("event_id").desc()], rules,
            split=lambda batch: EV.normalize_event(batch, keep=["event_id"]), quarantine_path=bad)
    return t.spark.read.parquet(bad).select("event_id", "value")


@query("bounded_drain", f"WITH l AS ({_LATEST_EVENT}) SELECT count(*) AS n, count(DISTINCT record_hash) AS items, max(event_id) AS last_event FROM l")
def _(t: Inputs):
    """Drained twice over one checkpoint: the second run finds nothing new."""
    return _drain_into_table(t, restart=True).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("record_hash").alias("items"), F.max("event_id").alias("last_event"))


_TIMED = T.StructType([*_ORDERED, T.StructField("ts", T.TimestampNTZType())])


@query("stream_first_seen", f"""
WITH {_EVENTS} SELECT content_id, count(DISTINCT CAST(ts AS DATE)) AS times, min(CAST(ts AS DATE)) AS first_day
FROM v JOIN events e USING (event_id) GROUP BY content_id""")
def _(t: Inputs):
    """Each item once a day: state of some days, events in the order of time, then old ones again, which come too late."""
    path, out = work_path(t.spark, "events"), work_path(t.spark, "first-seen")
    rows = t.fx("event_json_fx").select("event_id", "value", "ts")
    # 8 slices of the given month are under four days each
    EV.replay_events(rows, path, "ts", 8)
    early = rows.agg((F.min("ts") + F.expr("INTERVAL 3 DAYS")).alias("until"))
    EV.write_events(rows.join(early, F.col("ts") < F.col("until")).drop("until"), {"path": path})
    raw = t.spark.readStream.option("maxFilesPerTrigger", 2).text(path)
    row = F.from_json("value", _TIMED)
    valid, _bad = EV.normalize_event(
        EV.parse_events(raw.select(row["event_id"].alias("event_id"), row["ts"].cast("timestamp").alias("ts"), row["value"].alias("value"))),
        keep=["event_id", "ts"])
    daily = valid.select("content_id", "ts", F.to_date("ts").alias("day"))
    first = SK.stream_first_seen(daily, ["content_id", "day"], ("ts", "5 days"))
    SK.bounded_drain(first, lambda batch, _: batch.write.mode("append").parquet(out), work_path(t.spark, "cp"))
    return t.spark.read.parquet(out).groupBy("content_id").agg(
        F.count(F.lit(1)).alias("times"), F.min("day").alias("first_day"))


@query("stream_first_seen_ever", f"WITH {_EVENTS} SELECT content_id, count(DISTINCT 1) AS times FROM v GROUP BY content_id")
def _(t: Inputs):
    path, out = work_path(t.spark, "events"), work_path(t.spark, "first-seen")
    _publish(t, path, with_order=True)
    valid, _bad = EV.normalize_event(_stream(t, path), keep=["event_id"])
    first = SK.stream_first_seen(valid.select("content_id", "event_id"), ["content_id"])
    SK.bounded_drain(first, lambda batch, _: batch.write.mode("append").parquet(out), work_path(t.spark, "cp"))
    return t.spark.read.parquet(out).groupBy("content_id").agg(F.count(F.lit(1)).alias("times"))


_SEEN = T.StructType([
    T.StructField("content_id", T.StringType()), T.StructField("first_seen_at", T.LongType()),
    T.StructField("last_seen_at", T.LongType()),
])


@query("stream_unseen", f"WITH {_EVENTS} SELECT content_id, 1::BIGINT AS times, true AS remembered FROM v GROUP BY content_id")
def _(t: Inputs):
    path, out = work_path(t.spark, "events"), work_path(t.spark, "emitted")
    _publish(t, path, with_order=True)
    seen = KeyedTable(t.spark, work_path(t.spark, "seen"), _SEEN, ["content_id"], buckets=8)
    valid, _bad = EV.normalize_event(_stream(t, path), keep=["event_id"])
    SK.stream_unseen(
        valid.select("content_id", "event_id"), seen, lambda rows, _: rows.write.mode("append").parquet(out),
        "content_id", [F.col("event_id").asc()],
        lambda rows: rows.select("content_id", F.col("event_id").alias("first_seen_at"), F.col("event_id").alias("last_seen_at")),
        {"first_seen_at": U.oldest, "last_seen_at": U.newest}, work_path(t.spark, "cp"))
    remembered = seen.read().select("content_id", F.lit(True).alias("remembered"))
    emitted = t.spark.read.parquet(out).groupBy("content_id").agg(F.count(F.lit(1)).alias("times"))
    return emitted.join(remembered, "content_id", "left")


@query("build_event", """
SELECT raw_id, 'new_tiktok_video_detected' AS event_type, '2024-06-01T00:00:00+00:00' AS detected_at, 'tiktok_creator_monitor' AS source_system, platform,
  creator_username, content_id AS video_id, content_id, title, description, url AS url_tiktok, url, description_is_partial, recovered_text AS raw_payload FROM captions_fx""")
def _(t: Inputs):
    items = t.fx("captions_fx").withColumn("raw_payload", F.col("recovered_text"))
    out = EV.build_event(items, F.lit("2024-06-01T00:00:00+00:00"), "tiktok_creator_monitor", keep=["raw_id"])
    return out.drop("published_at", "language_hint")
