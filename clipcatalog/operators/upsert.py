"""Keyed merges: a join with a rule per column.

A rule is a function ``(target, source) -> Column`` of the two values of a
matched row; ``newer_row_rules`` compares whole rows.  Unmatched target rows stay as they are; unmatched source rows are
inserted with their values or with an insert default.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipcatalog.functions.columns import content_key, empty_to_null

Rule = Callable[[Column, Column], Column]


def take_source(t: Column, s: Column) -> Column:
    return s


def keep_target(t: Column, s: Column) -> Column:
    return t


def keep_if_set(t: Column, s: Column) -> Column:
    return F.coalesce(empty_to_null(t), s)


def keep_if_not_null(t: Column, s: Column) -> Column:
    return F.coalesce(t, s)


def longer_text(t: Column, s: Column) -> Column:
    def size(c):
        return F.length(F.coalesce(c, F.lit("")))

    return F.when(size(s) > size(t), s).otherwise(t)


def newest(t: Column, s: Column) -> Column:
    return F.greatest(t, s)


def oldest(t: Column, s: Column) -> Column:
    return F.least(t, s)


def always(value: Column) -> Rule:
    return lambda t, s: value


def newer_row_rules(columns: list[str], version: str) -> dict[str, Rule]:
    """Rules for a table where the row with the greater version wins as a whole.

    The result does not depend on the order in which batches arrive.
    """
    later = F.col(f"s__{version}") >= F.col(f"t__{version}")
    return {c: (lambda t, s: F.when(later, s).otherwise(t)) for c in columns}


def unique_source(source: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """The first row per key in the given order: what a merge source must be."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return source.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: dict[str, Callable] | list[str],
    rules: dict[str, Rule] | None = None,
    inserts: dict[str, Column] | None = None,
    default_rule: Rule | None = None,
) -> DataFrame:
    """Target after an upsert of ``source``, with the target's columns.

    ``keys`` are column names, or name -> function of a column picker when the
    key is computed (``{"k": lambda pick: lower(pick("name"))}``).  As in SQL, a
    NULL key matches nothing.  The source must be unique on the key.
    """
    t, s, condition, values = _sides(target, source, keys, rules, inserts, default_rule)
    return t.join(s, condition, "full_outer").select(*values)


def merge_small(
    target: DataFrame,
    source: DataFrame,
    keys: dict[str, Callable] | list[str],
    rules: dict[str, Rule] | None = None,
    inserts: dict[str, Column] | None = None,
    default_rule: Rule | None = None,
) -> DataFrame:
    """The rows of ``merge``, in a form that lets Spark broadcast the source.

    Target rows keep their place and look the source up (left join); the source
    rows without a partner follow.  Their partners are found by a semi join on the
    keys, so that both joins have the source, or fewer rows, on the side that Spark
    may broadcast.  The source is read three times, so it should be a table.
    """
    t, s, condition, values = _sides(target, source, keys, rules, inserts, default_rule)
    known = t.join(s, condition, "left_semi").select(*[c for c in t.columns if c.startswith("t__key_")])
    fresh = s.join(known, condition, "left_anti")
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema]
    return t.join(s, condition, "left").select(*values).unionAll(fresh.select("*", *blank).select(*values))


def _sides(target, source, keys, rules, inserts, default_rule):
    """Both sides with prefixed columns, their join condition and the merged values."""
    rules, inserts = rules or {}, inserts or {}
    fallback = default_rule or take_source
    if not isinstance(keys, dict):
        keys = {k: (lambda pick, k=k: pick(k)) for k in keys}
    has = set(source.columns)

    def side(df: DataFrame, prefix: str) -> DataFrame:
        columns = [F.col(c).alias(f"{prefix}{c}") for c in df.columns]
        key_cols = [build(F.col).alias(f"{prefix}key_{name}") for name, build in keys.items()]
        return df.select(*columns, *key_cols, F.lit(True).alias(f"{prefix}hit"))

    condition = reduce(lambda a, b: a & b, [F.col(f"t__key_{k}") == F.col(f"s__key_{k}") for k in keys])
    out = []
    for name in target.columns:
        old = F.col(f"t__{name}")
        new = F.col(f"s__{name}") if name in has else F.lit(None).cast(target.schema[name].dataType)
        rule = rules.get(name, fallback if name in has else keep_target)
        inserted = new
        if name in inserts:
            inserted = F.coalesce(new, inserts[name]) if name in has else inserts[name]
        value = (
            F.when(F.col("t__hit") & F.col("s__hit"), rule(old, new))
            .when(F.col("t__hit"), old)
            .otherwise(inserted)
        )
        out.append(value.cast(target.schema[name].dataType).alias(name))
    return side(target, "t__"), side(source, "s__"), condition, out


# --- the merges of the catalog's tables ------------------------------------------

LANDING_KEYS = {
    "platform": lambda pick: F.coalesce(pick("platform"), F.lit("tiktok")),
    "content": lambda pick: content_key(pick("content_id"), pick("url")),
}
LANDING_RULES = {
    "content_id": keep_if_set,
    "creator_username": keep_if_set,
    "title": longer_text,
    "description": longer_text,
    "url": keep_if_not_null,
    "raw_id": keep_target,
    "ingested_at": keep_target,
}


def upsert_longest_text(target: DataFrame, source: DataFrame, rules: dict | None = None,
                        inserts: dict | None = None) -> DataFrame:
    """Landing rows: longer texts win, ids and URL are kept once set."""
    return merge(target, source, LANDING_KEYS, {**LANDING_RULES, **(rules or {})}, inserts)


def upsert_by_hash(target: DataFrame, source: DataFrame, hash_column: str = "record_hash",
                   inserts: dict | None = None) -> DataFrame:
    """Event rows: match on the record hash and overwrite every column."""
    return merge(target, source, [hash_column], inserts=inserts)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the source rows whose key it does not hold."""
    fresh = source.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def upsert_full_replace(target: DataFrame, source: DataFrame, now: Column, key: str = "raw_id",
                        time_column: str = "processed_at") -> DataFrame:
    """Typed rows by id: all columns overwritten, processing time set."""
    return merge(target, source, [key], {time_column: always(now)}, {time_column: now})


def upsert_attempts(target: DataFrame, source: DataFrame, keys: list[str], now: Column | None = None,
                    time_column: str = "created_at") -> DataFrame:
    """Attempt or evidence log on its three-part key; creation time is kept."""
    inserts = {} if now is None else {time_column: now}
    return merge(target, source, keys, {time_column: keep_target}, inserts)


def upsert_queue(target: DataFrame, source: DataFrame, now: Column, key: str = "raw_id") -> DataFrame:
    """Work queue by id: state from the source, first-discovered time kept."""
    return merge(
        target, source, [key],
        {"discovered_at": keep_target, "updated_at": always(now)},
        {"discovered_at": now, "updated_at": now},
    )


def touch_seen(target: DataFrame, source: DataFrame, key: str = "video_id") -> DataFrame:
    """Seen items: first-seen keeps the oldest time, last-seen the newest."""
    return merge(target, source, [key], {"first_seen_at": oldest, "last_seen_at": newest})


def update_where(target: DataFrame, changes: DataFrame, key: str, now: Column, status: str = "status",
                 error: str = "last_error", time_column: str = "updated_at", failed: str = "failed") -> DataFrame:
    """Keyed UPDATE: new status and time; an error text only stays on failures."""
    c = changes.select(
        F.col(key), F.col(status).alias("_status"),
        (F.col(error) if error in changes.columns else F.lit(None).cast("string")).alias("_error"),
        F.lit(True).alias("_hit"),
    )
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    joined = target.join(c, key, "left")
    new = {
        status: F.when(hit, F.col("_status")).otherwise(F.col(status)),
        time_column: F.when(hit, now).otherwise(F.col(time_column)),
        error: F.when(hit, F.when(F.col("_status") == failed, F.col("_error"))).otherwise(F.col(error)),
    }
    return joined.select(*[new.get(n, F.col(n)).alias(n) for n in target.columns])


def creator_state_upsert(target: DataFrame, runs: DataFrame, now: Column, key: str = "creator") -> DataFrame:
    """Scan state: status, run time and counts replaced, completion only when completed."""
    source = runs.select(
        key, "status", now.alias("last_run_at"),
        F.when(F.col("status") == "completed", now).alias("completed_at"),
        "scanned", "accepted", "error",
    )
    return merge(target, source, [key])


def upsert_creator_scores(target: DataFrame, scores: DataFrame, now: Column, key: str = "creator_username",
                          time_column: str = "updated_at") -> DataFrame:
    """Creator scores (see ``creator_quality``): all columns replaced, update time set on both branches."""
    return merge(target, scores, [key], {time_column: always(now)}, {time_column: now})
