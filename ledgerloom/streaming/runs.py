"""Streams over landed files: each run takes what is new and stops.

Every column helper and the projections in ``operators`` work on these streams
unchanged; statistics fills and ranked deduplication need a bounded table.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQueryListener

from ledgerloom.operators.quality import RunMetrics
from ledgerloom.sinks.tables import upsert_table


def read_file_stream(
    spark: SparkSession,
    directory: str,
    file_format: str,
    schema: T.StructType | str,
    pattern: str | None = None,
    max_files_per_batch: int | None = None,
    archive_dir: str | None = None,
    **options,
) -> DataFrame:
    """Files of a folder as a stream, a bounded number per batch.

    With an archive folder, files move there once their batch is committed and
    the next one starts; the archive must lie outside the source folder.
    """
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    if archive_dir:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive_dir)
    return reader.load(directory)


def run_to_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "parquet",
    partition_by: list[str] | None = None,
    metrics: RunMetrics | None = None,
    task: str = "stream",
) -> None:
    """Append all new rows to a folder, each exactly once, and stop. ``metrics`` gets a row per batch."""
    if metrics is not None:
        stream = counted(stream)
    writer = stream.writeStream.format(file_format).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _run(writer.trigger(availableNow=True), path, stream.sparkSession, metrics, task)


def run_batches(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    metrics: RunMetrics | None = None,
    task: str = "stream",
) -> None:
    """Hand each new batch to a function. A batch may come twice after a failure. ``metrics`` gets a row per batch."""
    if metrics is not None:
        stream = counted(stream)
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    _run(writer, None, stream.sparkSession, metrics, task)


WRITTEN = "written"


def counted(stream: DataFrame) -> DataFrame:
    """A stream that counts the rows each batch hands to its sink."""
    return stream.observe(WRITTEN, F.count(F.lit(1)).alias("rows"))


class _Batches(StreamingQueryListener):
    """What each batch of one query reported, as it came: a query itself keeps the last hundred only."""

    def __init__(self):
        self.found: dict[str, list] = {}
        self.ended: dict[str, threading.Event] = {}

    def of(self, run_id) -> threading.Event:
        return self.ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.found.setdefault(str(event.progress.runId), []).append(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.of(event.runId).set()


# Reports follow the end of a query in a thread of their own.
REPORT_SECONDS = 30


def _run(writer, path: str | None, spark: SparkSession, metrics: RunMetrics | None, task: str) -> None:
    """Run a query to its end; with ``metrics`` add a row per batch, also if the query fails."""
    if metrics is None:
        (writer.start(path) if path else writer.start()).awaitTermination()
        return
    listener = _Batches()
    spark.streams.addListener(listener)
    try:
        query = writer.start(path) if path else writer.start()
        try:
            query.awaitTermination()
        finally:
            listener.of(query.runId).wait(REPORT_SECONDS)
            for progress in listener.found.get(str(query.runId), []):
                _note(metrics, task, progress)
    finally:
        spark.streams.removeListener(listener)


def _note(metrics: RunMetrics, task: str, progress) -> None:
    """One batch as a row: rows in as its records, rows out, time and watermark as tags."""
    seen = progress.observedMetrics.get(WRITTEN)
    tags = {"batch_id": progress.batchId, "rows_out": seen["rows"] if seen else 0, "started": progress.timestamp}
    if progress.eventTime.get("watermark"):
        tags["watermark"] = progress.eventTime["watermark"]
    if progress.stateOperators:
        tags["state_rows"] = sum(op.numRowsTotal for op in progress.stateOperators)
    metrics.add_batch(task, progress.batchDuration / 1000, progress.numInputRows, tags)


def deduplicate_stream(
    stream: DataFrame,
    keys: list[str],
    event_time: str,
    delay: str,
    spread: int = 16,
) -> DataFrame:
    """Keep one row per key as long as its repeats come within the delay.

    A stream has no partial aggregation to thin out a hot key, so a first round
    works on the key and the input partition, folded to ``spread`` values: the
    copies of a hot key split over that many tasks, and the second round sees at
    most ``spread`` of them. Every key pays for this with state in both rounds:
    where no key is hot, ``spread=1`` is a single round with half the state.
    """
    if isinstance(stream.schema[event_time].dataType, T.TimestampNTZType):
        stream = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    marked = stream.withWatermark(event_time, delay)
    if spread > 1:
        part = "__part"
        marked = (
            marked.withColumn(part, F.pmod(F.spark_partition_id(), F.lit(spread)))
            .dropDuplicatesWithinWatermark([*keys, part])
            .drop(part)
        )
    return marked.dropDuplicatesWithinWatermark(keys)


def run_upsert(
    stream: DataFrame,
    table: str,
    keys: list[str],
    checkpoint: str,
    order_by: list[str] | None = None,
    partitions_follow_keys: bool = False,
    path: str | None = None,
) -> None:
    """Upsert each new batch into a table. A batch that comes again is left out, null keys and all.

    The table's log of commits holds the last batch of each stream, stored in the
    same step as its rows. A stream is known by the id in its checkpoint: a new
    checkpoint is a new stream, which loads everything anew. Each batch rewrites
    the files that hold its keys, or a whole unpartitioned table: partition large
    targets, and say where ``partitions_follow_keys``.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        upsert_table(
            spark, table, batch, keys, order_by, partitions_follow_keys, path, f"stream {stream_id}", (stream_id, batch_id)
        )

    run_batches(stream, merge, checkpoint)
    # Batches run in a session of their own; this one must not go by the files it knew.
    spark = stream.sparkSession
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
