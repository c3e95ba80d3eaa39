"""Daily extraction of newly arrived pixel files.

The batch extraction walks a folder file by file. As a stream, the same step runs on the
files that arrived since the last run; which ones were done is kept in the stream's
checkpoint. A source file's statistics need all its pixels at once: a batch that brings more
pixels of a source file that an earlier batch has done fails before it writes anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from limnia.functions.cleaning import finite_columns
from limnia.operators.schema import OBSERVATION_COLUMNS, complete_columns, require
from limnia.plans.extraction import extract_lakes
from limnia.session import materialise
from limnia.sources.tables import optional, write_parquet


def pixel_stream(
    spark: SparkSession, path: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def stream_observations(
    pixels: DataFrame, boxes: DataFrame, out: str, checkpoint: str, value: str = "CI_cyano",
    product: str = "daily", valid_min=None, valid_max=None,
) -> StreamingQuery:
    """Process what is there and stop; call again (or schedule) when more files have come.

    Each batch overwrites its own folder, so a batch repeated after a failure replaces
    itself and no row is written twice.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = finite_columns(batch)
        files = materialise(rows.select("src").distinct())
        done = optional(spark.read.parquet, f"{out}/batch_id=*")
        if done is not None:
            # a repeated batch replaces its own folder
            earlier = done.where(~F.col("_metadata.file_path").contains(f"/batch_id={batch_id}/"))
            require(files.join(earlier.select("src").distinct().withColumn("again", F.lit(True)), "src", "left"),
                    F.col("again").isNull(), "pixels of a source file that an earlier batch has done").count()
        obs = extract_lakes(rows, boxes, files, product, value, valid_min, valid_max)
        obs = complete_columns(obs.withColumn("date", F.col("time").cast("timestamp_ntz")), OBSERVATION_COLUMNS)
        write_parquet(obs, f"{out}/batch_id={batch_id}")

    return (
        pixels.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
