"""Writing loads so that a repeated one changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.predicates import qcol


def write_load(load: DataFrame, path: str, batch_column: str = "batch_date", fmt: str = "parquet") -> None:
    """Write the batches of ``load`` into the table at ``path``, partitioned by the batch column.

    A batch that the table holds already is replaced as a whole (dynamic partition overwrite), others stay, so a load
    that is delivered or retried again gives the same table; an empty load changes nothing.  Rows with a NULL batch
    are one batch.  Nothing is shuffled: each task sorts its rows by batch and writes one file a batch.
    """
    load.write.partitionBy(batch_column).mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt).save(path)


def read_batches(spark, path: str, like: DataFrame, fmt: str = "parquet") -> DataFrame:
    """The table that ``write_load`` filled, with the columns and types of ``like``."""
    return spark.read.schema(like.schema).format(fmt).load(path).select(*[qcol(c) for c in like.columns])
