"""Files as they arrive: a file stream in micro-batches, and the batch form of its debounce."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fojas.sources.readers import BINARY_FILE


def file_stream(spark: SparkSession, folder: str, batch_files: int = 30) -> DataFrame:
    """PDFs of a folder as they appear, at most so many per micro-batch (STM1, SRC4, LIM1). Files that are there at the start count too."""
    df = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", "*.[pP][dD][fF]").option("maxFilesPerTrigger", batch_files).load(folder)
    return df.withColumn("nombre_archivo", F.element_at(F.split("path", "/"), -1)).where(~F.col("nombre_archivo").rlike(r"^[.~]"))


def run_stream(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Runs step on every micro-batch (STM3); without seconds it works off what is there and ends."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def new_readings(stream: DataFrame, late: str = "7 days") -> DataFrame:
    """Readings of a stream without repeats of (hash, name) that arrive within the watermark (JOIN5 on a stream)."""
    return stream.withWatermark("created_at", late).dropDuplicatesWithinWatermark(["hash_archivo", "nombre_archivo"])


def intake_sessions(events: DataFrame, key: str, ts: str, gap: str = "5 seconds") -> DataFrame:
    """(key, inicio, fin, n): runs of events no further apart than the gap, the debounce in event time (STM2). fin is the last event's time plus the gap."""
    return events.where(F.col(ts).isNotNull()).groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("inicio"), F.col("w.end").alias("fin"), "n")
