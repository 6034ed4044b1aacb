"""Transports: every one gives rows (topic, partition, offset, value), so envelopes do not know where they come from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS = "topic string, partition int, offset bigint, value string"


def json_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORDS).json(path)


def json_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(RECORDS).option("maxFilesPerTrigger", files_per_batch).json(path)


def kafka_options(servers: str, topics: list[str], group: str, limits: dict[str, str]) -> dict[str, str]:
    """Starts at the earliest offset where there is no checkpoint; offsets are kept in the checkpoint, so the group
    only names the readers."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "groupIdPrefix": group,
        "kafka.session.timeout.ms": "60000",
        **limits,
    }


def kafka_stream(spark: SparkSession, servers: str, topics: list[str], group: str, limits: dict[str, str]) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topics, group, limits))
    return reader.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def one_partition_each(records: DataFrame) -> DataFrame:
    """Fails on a topic with several partitions, in which a table's changes would have no order."""
    bad = F.raise_error(F.concat(F.lit("more than one partition: "), F.col("topic")))
    return records.where(F.when(F.col("partition") > 0, bad.cast("boolean")).otherwise(F.lit(True)))


def sequenced(records: DataFrame, spread: int = 1 << 10) -> DataFrame:
    """Adds seq, one total order: by offset, ties between partitions by partition. A key keeps to one partition."""
    return records.withColumn("seq", F.col("offset") * spread + F.col("partition"))


def high_water(records: DataFrame) -> DataFrame:
    """The offset to go on from in each topic and partition."""
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
