"""Continuous forms of batch operators; on the same rows they give the batch results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrafold.sources.store import Store


def upsert_stream(rows: DataFrame, store: Store, dataset: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch is merged into the store by latest version; replays change nothing."""

    def merge(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            store.upsert(batch, dataset, run=f"{dataset}_epoch{epoch}")

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def manifest_stream(rows: DataFrame, late: str = "30 days", time: str = "made_at") -> DataFrame:
    """New (obs_id, month_label) pairs only; state older than the watermark goes."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(["obs_id", "month_label"])


def windowed_counts(rows: DataFrame, time: str, key: str, width: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return rows.withWatermark(time, late).groupBy(w, key).agg(F.count(F.lit(1)).alias("n"))
