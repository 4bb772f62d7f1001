"""Size of the batches that texts are read in and handed to Python workers in."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROWS = 1000
#: A task holds one batch of the Parquet reader as contiguous arrays, which no setting bounds by bytes.
READ_ROWS = 64
_MOST = {"spark.sql.execution.arrow.maxRecordsPerBatch": ROWS, "spark.sql.parquet.columnarReaderBatchSize": READ_ROWS}


def small_batches(spark: SparkSession) -> None:
    """Bound batches to ``ROWS`` and ``READ_ROWS`` texts; a session that asks for fewer keeps its setting."""
    for key, most in _MOST.items():
        rows = int(spark.conf.get(key))
        if rows <= 0 or rows > most:
            spark.conf.set(key, str(most))
