"""Streaming forms of the hourly airport state and of the daily message counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwork.session import scratch_path
from legwork.sources.tables import path_exists


def read_stream(spark: SparkSession, folder: str, file_name: str, like: DataFrame) -> DataFrame:
    """Files of one name that arrive in a folder, as a stream with a known schema."""
    return spark.readStream.schema(like.schema).option("pathGlobFilter", file_name).parquet(folder)


def hourly_state(moves: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Movements and delay per airport and hour; rows later than the watermark are dropped."""
    return (
        moves.withWatermark("ts", late)
        .groupBy("airport", F.window("ts", "1 hour"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("delay").alias("delay"))
        .select("airport", F.col("window.start").alias("hour"), "n", "delay")
    )


def daily_counts(log: DataFrame, late: str = "1 day") -> DataFrame:
    """Messages per day."""
    return (
        log.withWatermark("ts", late)
        .groupBy(F.window("ts", "1 day"))
        .agg(F.count(F.lit(1)).alias("num_messages"))
        .select(F.col("window.start").alias("day"), "num_messages")
    )


def run_append(stream: DataFrame, name: str) -> DataFrame:
    """Runs over all available input; closed windows go to Parquet files exactly once."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    writer = stream.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", f"{path}-checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_update(stream: DataFrame, name: str, key: str) -> DataFrame:
    """Runs over all available input; a batch stores the keys it changed, the latest batch counts.

    State older than the watermark is dropped. A batch that is run again replaces its own files.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, name)

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.outputMode("update").foreachBatch(store)
    writer = writer.option("checkpointLocation", f"{path}-checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    if not path_exists(spark, path):  # nothing has arrived
        return spark.createDataFrame([], stream.schema)
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    found = spark.read.schema(schema).parquet(path)
    rest = [c for c in stream.columns if c != key]
    return found.groupBy(key).agg(*[F.max_by(c, "batch").alias(c) for c in rest])
