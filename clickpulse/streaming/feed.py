"""Stream sources and a replay feed for tests and checks.

Production reads the ad log from Kafka (``kafka_line_stream``); text folders
work for line files (``text_line_stream``). ``ReplayFeed`` turns a DataFrame
that Spark derived from the given tables into a sequence of micro-batches:
it writes the feed once (in parallel, partitioned by batch), then moves one
batch at a time into an inbox folder (one atomic folder rename) and waits until
the query has processed it. So batch boundaries are exact and no batch is
funnelled through one task; ``availableNow`` queries are restarted from their
checkpoint for each batch (the restart path).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickpulse import storage


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    group_id: str | None = None,
    max_offsets_per_trigger: int | None = None,
    min_offsets_per_trigger: int | None = None,
    max_trigger_delay: str | None = None,
    min_partitions: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Options of the Kafka source.

    Admission control: ``max_offsets_per_trigger`` bounds a micro-batch (a restart after a long stop then
    works off its backlog in steps), ``min_offsets_per_trigger`` waits for that many, at most
    ``max_trigger_delay``; ``min_partitions`` splits Kafka partitions that hold much. ``fail_on_data_loss``
    stops the query when offsets are gone (the default; counts would be too low without notice).
    """
    if not bootstrap_servers or not topic:
        raise ValueError("a Kafka source needs servers and a topic")
    if min_offsets_per_trigger and max_offsets_per_trigger and min_offsets_per_trigger > max_offsets_per_trigger:
        raise ValueError("min_offsets_per_trigger is above max_offsets_per_trigger")
    if max_trigger_delay and not min_offsets_per_trigger:
        raise ValueError("max_trigger_delay needs min_offsets_per_trigger")
    options = {
        "kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic, "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(), "kafka.group.id": group_id, "maxOffsetsPerTrigger": max_offsets_per_trigger,
        "minOffsetsPerTrigger": min_offsets_per_trigger, "maxTriggerDelay": max_trigger_delay, "minPartitions": min_partitions,
    }
    return {k: str(v) for k, v in options.items() if v is not None}


def kafka_line_stream(spark: SparkSession, bootstrap_servers: str, topic: str, **options) -> DataFrame:
    """Kafka topic as a stream of string ``value`` lines (needs the Kafka connector on the classpath); see kafka_options."""
    reader = spark.readStream.format("kafka").options(**kafka_options(bootstrap_servers, topic, **options))
    return reader.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def text_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files arriving in ``path`` (column ``value``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


class ReplayFeed:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.inbox = os.path.join(root, "inbox")

    def stream(self, schema) -> DataFrame:
        """The inbox as a parquet file stream (each batch arrives as one sub-folder)."""
        return self.spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(self.inbox)

    def run(self, df: DataFrame, batch_col: str, start: Callable[[], StreamingQuery],
            continuous: bool = False) -> int:
        """Feed ``df`` batch by batch; after each batch arrives, wait until the query has processed it.

        The feed is written once, partitioned by ``batch_col`` (one parallel job, one scan of
        the source). Each batch then arrives by one atomic folder rename into the inbox, so a
        micro-batch always sees a whole batch. ``continuous=True``: ``start`` returns a query
        with a repeating trigger, started once and driven with ``processAllAvailable``.
        Otherwise ``start`` returns an ``availableNow`` query (its data is fixed when it
        starts), so each batch gets a fresh run from the checkpoint, awaited to its end.
        """
        stage = self.inbox + "-stage"
        df.write.mode("overwrite").partitionBy(batch_col).parquet(stage)
        storage.make_dirs(self.spark, self.inbox)
        folders = []
        for value in storage.list_folders(self.spark, stage, batch_col):
            folders.append((int(value) if value.lstrip("-").isdigit() else value, f"{stage}/{batch_col}={value}"))
        q = None
        for b, folder in sorted(folders, key=lambda x: (isinstance(x[0], str), x[0])):
            storage.rename(self.spark, folder, f"{self.inbox}/b{b}")
            if continuous:
                if q is None:
                    q = start()
                q.processAllAvailable()
            else:
                q = start()
                q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(f"stream failed at feed batch {b}: {q.exception()}")
        if continuous and q is not None and q.isActive:
            _stop_when_idle(q)
        storage.delete(self.spark, stage)
        return len(folders)


def _stop_when_idle(q: StreamingQuery, wait_s: float = 30.0) -> None:
    """Stop ``q`` between triggers (never in the middle of a foreachBatch write)."""
    import time

    deadline = time.time() + wait_s
    while q.isActive and q.status.get("isTriggerActive") and time.time() < deadline:
        time.sleep(0.05)
    q.stop()


def start_foreach_batch(
    stream: DataFrame,
    fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    available_now: bool = True,
    processing_time: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start ``stream`` with a ``foreachBatch`` sink and a checkpoint (resumes when it exists)."""
    writer = stream.writeStream.foreachBatch(fn).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_console(stream: DataFrame, output_mode: str = "update", num_rows: int = 20, truncate: bool = False,
                  checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Print each micro-batch on the driver's console (development only, like ``DStream.print``)."""
    writer = (stream.writeStream.format("console").outputMode(output_mode)
              .option("numRows", str(num_rows)).option("truncate", str(truncate).lower()))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
