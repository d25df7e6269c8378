"""Streams: sequences annotated as they arrive, and windows over telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import kmers, search


def annotate_stream(records: DataFrame, references: DataFrame, labels: DataFrame, path: str, checkpoint: str, bits: int = 55_296, k: int = 17, available_now: bool = True) -> StreamingQuery:
    """Annotate streamed records (entity bigint, seq) against a written reference table (ref, bits), one folder a batch.

    A batch that is run again after a failure replaces its own folder, so results are complete and not doubled. An
    entity's records must arrive in one batch, as a file of it does. References are laid out in blocks once.
    """
    references = search.reference_blocks(references)

    def each(batch: DataFrame, number: int) -> None:
        found = search.annotate(kmers.bit_sketch(batch, bits, k), references, labels)
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = records.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def telemetry_windows(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, event_type, n, low, high, total) of events (ts, event_type, value) by window; the same for streams and tables.

    In a stream a window is final once the watermark has passed it; later rows are dropped. Null times are in no window.
    """
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        rows = rows.withWatermark("ts", late)
    out = rows.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "low", "high", "total")
