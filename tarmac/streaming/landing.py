"""Landing of weather responses as they arrive, each file once."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.operators.keys import counted_ids
from tarmac.sources.landed import explode_hours
from tarmac.sources.tables import Table, take_ids


def land_weather(spark: SparkSession, path: str, table: Table, progress: str) -> StreamingQuery:
    """Append every response file not landed yet, then stop.

    The file source remembers finished files under ``progress``, a shared folder.  A batch repeated after
    a failure takes the place of what its first attempt wrote.
    """
    station = F.regexp_extract(F.col("_metadata.file_path"), r"station=([^/]+)/", 1)
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("value", station.alias("station"))
    )

    stream = zlib.crc32(progress.encode())

    def append(batch: DataFrame, number: int) -> None:
        hours = explode_hours(batch, "value", "station")
        numbered, count = counted_ids(hours, "raw_id")
        numbered = numbered.withColumn("raw_id", F.col("raw_id") + take_ids(table, "raw_id", count))
        table.append(numbered.withColumn("load_date", F.current_timestamp().cast("timestamp_ntz")), f"{stream}-{number}")

    return (
        files.writeStream.foreachBatch(append)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
