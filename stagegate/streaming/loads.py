"""Check each load of a layer as it arrives on a stream.

A layer that is fed by loads landing over time (files in a folder, a message
topic, ...) is read with ``readStream``; every micro-batch is one or more new
loads.  ``check_each_load`` runs the same batch suite on each micro-batch with
``foreachBatch`` and appends the result rows, tagged with the micro-batch id, to
a results table.  The checks themselves are the batch operators: nothing here is
a new operator, and all state lives in the stream's checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.suites import run_suite
from ..spec import DatasetSpec, Mode, Stage


def check_each_load(
    stream: DataFrame,
    spec: DatasetSpec,
    stage: Stage | str,
    other: DataFrame,
    results_path: str,
    checkpoint_location: str,
    results_format: str = "parquet",
    available_now: bool = True,
    on_results: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Start a query that checks every micro-batch of ``stream`` against ``other``.

    For ``source_to_staging`` the arriving rows are the staging load and
    ``other`` the source; for ``staging_to_target`` they are the staging load and
    ``other`` the target it must have reached.  Result rows (``RESULT_SCHEMA``
    plus ``batch_id``) are written to ``results_path`` partitioned by ``batch_id``;
    each micro-batch overwrites only its own partition, so a batch replayed after
    a failure does not leave duplicates.  ``checkpoint_location`` is the stream's own
    folder: a restart with it goes on with the next ``batch_id``, so earlier results stay.
    A stream that begins anew, with another folder, needs another ``results_path``.
    """
    stage = Stage(stage)
    spark = stream.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        if stage is Stage.SOURCE_TO_STAGING:
            res = run_suite(spark, spec, Mode.SOURCE_TO_STAGING, source=other, staging=batch)
        else:
            res = run_suite(spark, spec, Mode.STAGING_TO_TARGET, staging=batch, target=other)
        res = res.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        # idempotent: a micro-batch that Spark re-runs after a failure replaces its own partition
        (
            res.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .format(results_format)
            .save(results_path)
        )
        if on_results is not None:
            on_results(res, batch_id)

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
