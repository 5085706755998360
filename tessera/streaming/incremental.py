"""Idempotent landing: every source file is taken in once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def land_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    file_format: str = "parquet",
    glob: str | None = None,
) -> DataFrame:
    """Copy files that no earlier run has seen into ``target``, then stop.

    The checkpoint keeps the list of files done, so running again with nothing new
    writes nothing, and a run that was cut off continues where it stopped. Returns
    the target as a batch frame. Runs the stream to its end.
    """
    reader = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", 10_000)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = (
        reader.load(source)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    stream.awaitTermination()
    return spark.read.schema(schema).parquet(target)
