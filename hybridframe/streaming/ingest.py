"""Streams that feed a collection."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hybridframe.schema import DOCUMENT, EMBEDDING, ID, METADATA, RECORD
from hybridframe.sources.markdown import MAX_CHARS, chunk_records, chunks, stream_markdown

CHANGED = (DOCUMENT, EMBEDDING, METADATA)


def deduplicate(stream: DataFrame, keys: list[str], time: str, delay: str = "10 minutes") -> DataFrame:
    """Drop repeats of a key that come within ``delay``. The state is as large as that window."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def deduplicate_windows(stream: DataFrame, keys: list[str], time: str, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Each key once for each window of event time: ``keys`` and ``window_start``.

    What comes out depends on event times alone, whatever the batches, but for rows that come when the watermark (the latest time seen, less
    ``delay``) has passed their window's end: these are dropped, and Spark counts them in ``numRowsDroppedByWatermark``. The watermark
    that counts is the one with which the batch before began. So the state holds the windows of ``delay`` and of two batches, and no more.
    """
    windowed = stream.withWatermark(time, delay).select(*keys, F.window(time, window).alias("window"))
    return windowed.dropDuplicates([*keys, "window"]).select(*keys, F.col("window.start").alias("window_start"))


def late_rows(query: StreamingQuery) -> int:
    """How many rows a query has dropped as too late."""
    return sum(state.numRowsDroppedByWatermark for progress in query.recentProgress for state in progress.stateOperators)


def in_order(stream: DataFrame) -> DataFrame:
    """Change records (``_id, document, embedding, metadata, position``) with the fields that are older than what came before left out.

    For every id the state holds the position of each field's last value, three numbers, so that a late change of an earlier position cannot overwrite
    a newer field in whatever batch it comes. One row per id and batch, with the newest values of that batch; none where nothing is new.
    """

    def newest(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = list(state.get) if state.exists else [None, None, None]
        values, fresh = [None, None, None], not state.exists
        for part in parts:
            for i, field in enumerate(CHANGED):
                rows = part[part[field].notna() & part["position"].notna()]
                if len(rows):
                    at = rows["position"].idxmax()
                    position = int(rows["position"][at])
                    if seen[i] is None or position > seen[i]:
                        seen[i], values[i], fresh = position, rows[field][at], True
        state.update(tuple(seen))
        if fresh:
            yield pd.DataFrame({ID: [key[0]], **{field: [value] for field, value in zip(CHANGED, values)}})

    positions = ", ".join(f"{field} long" for field in CHANGED)
    changes = stream.select(ID, *CHANGED, F.col("position").cast("long").alias("position"))
    return changes.groupBy(ID).applyInPandasWithState(newest, RECORD, positions, "append", GroupStateTimeout.NoTimeout)


def upsert_stream(stream: DataFrame, collection, checkpoint: str, name: str = "stream", once: bool = False) -> StreamingQuery:
    """Upsert every micro-batch of change records. Those with a ``position`` are put in order across batches, see ``in_order``.

    The collection remembers the last batch of ``name`` in the same step that makes it visible, so
    a batch that is replayed after a failure is applied once.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        collection.upsert_frame(batch, stream=name, batch_id=batch_id)

    if "position" in stream.columns:
        stream = in_order(stream)
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingest_markdown_stream(
    spark: SparkSession, path: str, collection, checkpoint: str, max_chars: int | None = MAX_CHARS, once: bool = False
) -> StreamingQuery:
    """Cut markdown files into records as they arrive. A file that comes again replaces all its records, also those that it has no longer.

    A batch that is replayed after a failure gives the same records.
    """
    records = chunk_records(chunks(stream_markdown(spark, path), max_chars=max_chars))
    writer = records.writeStream.foreachBatch(lambda batch, _: collection.replace_sources_frame(batch)).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
