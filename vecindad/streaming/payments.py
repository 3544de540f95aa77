"""Continuous intake of payment files.

New files in a landing folder are picked up by the file source and go through
the same job as a batch import.  The source's checkpoint remembers which files
were read; a micro-batch that is replayed after a failure overwrites its own
partition, so its rows are stored once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vecindad.plans.imports import store_payments
from vecindad.sources.files import LINE, line_options, payment_lines


def stream_payments(
    spark: SparkSession,
    root: str,
    landing: str,
    *,
    checkpoint: str,
    name: str = "payments",
    mode: str = "reference",
    files_per_batch: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Starts the intake; with ``available_now`` it ends when all files are read.

    ``checkpoint`` remembers what was read: a folder that outlives the session.
    """
    options = line_options()
    if files_per_batch is not None:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    lines = payment_lines(spark.readStream.schema(f"{LINE} string").options(**options).csv(landing))

    def intake(batch: DataFrame, batch_id: int) -> None:
        # The query id lives in the checkpoint: a new checkpoint counts from 0
        # again, but never into the partitions of an older one.
        session = batch.sparkSession
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        store_payments(session, root, batch, f"{name}-{query_id}-{batch_id}", mode=mode)

    writer = (
        lines.writeStream.queryName(name)
        .foreachBatch(intake)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
