"""The topic log: records ``(topic, key, value, ts, seq)`` in files or in a broker.

File logs are parquet partitioned by topic.  The broker form needs Spark's
connector on the class path; both give the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waycast import schemas as S
from waycast.functions import times


def write_log(log: DataFrame, path: str, mode: str = "append") -> str:
    """One folder per topic; no shuffle, every task writes the topics it holds."""
    log.write.mode(mode).partitionBy("topic").parquet(path)
    return path


def read_log(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    log = spark.read.schema(S.LOG_SCHEMA).parquet(path)
    return log if topics is None else log.filter(F.col("topic").isin(*topics))


def stream_log(spark: SparkSession, path: str, files_per_trigger: int = 1000, latest_first: bool = False) -> DataFrame:
    """A file log as a stream; the bound keeps one micro-batch small."""
    return (
        spark.readStream.schema(S.LOG_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("latestFirst", str(latest_first).lower())
        .parquet(path)
    )


def from_position(log: DataFrame, after_seq: int | None = None, from_time: str | None = None) -> DataFrame:
    """Start reading behind a sequence number, or at a point in time."""
    if after_seq is not None:
        log = log.filter(F.col("seq") > after_seq)
    if from_time is not None:
        log = log.filter(F.col("ts") >= F.lit(from_time).cast("timestamp_ntz"))
    return log


def stream_broker(spark: SparkSession, servers: str, topics: list[str], starting_offsets: str = "latest",
                  offsets_per_trigger: int = 1_000_000, **options: str) -> DataFrame:
    """The same columns from a broker.  Topics promise no order among each other,
    so ``seq`` is the broker's time and, within a millisecond, the offset."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
        .option("maxOffsetsPerTrigger", offsets_per_trigger)
        .options(**options)
        .load()
    )
    millis = F.unix_millis("timestamp")
    return raw.select(
        "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        times.from_epoch_micros(millis * 1000).alias("ts"),
        # arrival order across topics: broker time first, then offset
        (millis * 1000000 + F.col("offset") % 1000000).alias("seq"),
    )


def write_broker(log: DataFrame, servers: str, checkpoint: str, **options: str):
    """Write records to the topic named in each row, at least once."""
    return (
        log.select("topic", "key", "value").writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
