"""Stream sinks: keyed upsert, first-seen emission, bounded drain."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcatalog.operators.upsert import unique_source
from clipcatalog.sources.keyed_table import KeyedTable
from clipcatalog.sources.session import landed


def bounded_drain(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> list:
    """Consume what is there in micro-batches, then stop; returns the progress of the latest batches."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    query.awaitTermination()
    return query.recentProgress


def stream_upsert(stream: DataFrame, table: KeyedTable, checkpoint: str, keys: list[str], order: list[Column],
                  rules: dict | None = None, inserts: dict | None = None,
                  split: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
                  quarantine_path: str | None = None) -> None:
    """Merge every micro-batch into a keyed table.

    Each batch is made unique on the key first (the first row of ``order`` wins);
    a batch that was already merged before a restart is skipped.  ``split`` parts a
    batch into valid and bad rows; the bad ones go to ``quarantine_path``, before the
    merge, so a crash in between cannot lose them.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        if split is not None:
            batch, bad = split(batch)
            if quarantine_path is not None:
                quarantine(bad, quarantine_path, batch_id)
            batch = batch.select(*table.schema.names)
        table.upsert(unique_source(batch, keys, order), rules, inserts, batch=batch_id)

    bounded_drain(stream, handle, checkpoint)


def stream_first_seen(stream: DataFrame, keys: list[str], watermark: tuple[str, str] | None = None) -> DataFrame:
    """Each item once only.

    With ``watermark=(time column, delay)`` a key is forgotten once the watermark, the
    latest time seen less ``delay``, has passed the key's own time by ``delay``, so the state
    holds the keys of about two delays, however long the stream runs.  Repeats within ``delay`` of an
    item's first row are left out for sure; with a period (such as the day) among the keys
    and a delay of at least that period, an item comes once per period.  Late rows, older
    than the watermark, are left out and counted in the progress (``numRowsDroppedByWatermark``).
    Without a watermark every key is remembered for ever.
    """
    if watermark is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(*watermark).dropDuplicatesWithinWatermark(keys)


def stream_unseen(stream: DataFrame, seen: KeyedTable, emit: Callable[[DataFrame, int], None], key: str,
                  order: list[Column], to_seen: Callable[[DataFrame], DataFrame], rules: dict,
                  checkpoint: str) -> None:
    """Emit items whose key is not in the seen table, then remember them.

    The seen table, keyed by ``key``, replaces streaming state, so it can grow without
    a memory bound; a batch reads only the buckets its items fall into.  Emission comes first: a crash in between repeats an item, and never
    loses one.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= seen.last_batch():
            return
        first = landed(unique_source(batch, [key], order), "unseen")
        # shuffled: a broadcast would pass the known keys through the driver in every batch
        known = seen.read_beside(to_seen(first)).select(F.col(key).alias("_known")).hint("merge")
        emit(first.join(known, F.col(key) == F.col("_known"), "left_anti"), batch_id)
        seen.upsert(to_seen(first), rules, batch=batch_id)

    bounded_drain(stream, handle, checkpoint)


def quarantine(invalid: DataFrame, path: str, batch_id: int) -> None:
    """Bad rows of one batch; a repeated batch replaces its own rows."""
    invalid.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
