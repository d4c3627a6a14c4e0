"""Raw post and comment records: JSON folders in and out, keyed JSON messages, message streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from threadloom.schemas import COMMENT_RECORD, POST_RECORD

CORRUPT = "_corrupt"


PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _parsed(value: Column, schema: StructType) -> Column:
    """Record of a JSON text; one that does not parse keeps its text in `_corrupt`."""
    return F.from_json(value, StructType(list(schema)).add(CORRUPT, StringType()), PERMISSIVE)


def _scan(spark: SparkSession, path: str, schema: StructType, multi_line: bool) -> DataFrame:
    # Read as text and parsed afterwards: the JSON reader cannot be asked for its corrupt records alone.
    reader = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true")
    return reader.text(path, wholetext=multi_line).select(_parsed(F.col("value"), schema).alias("r")).select("r.*")


def scan_posts_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Post files below `path`. Records that do not parse keep their text in `_corrupt`.

    multi_line reads one object per file however it is laid out; without it the files hold one object per line and
    large ones are split between tasks.
    """
    return _scan(spark, path, POST_RECORD, multi_line)


def scan_comments_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return _scan(spark, path, COMMENT_RECORD, multi_line)


def well_formed(records: DataFrame) -> DataFrame:
    return records.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def dead_letters(records: DataFrame) -> DataFrame:
    """The raw text of the records that did not parse."""
    return records.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def sink_raw_json(records: DataFrame, path: str) -> None:
    """Land whole records as JSON, a folder per subreddit. Rebalancing splits a hot subreddit over several files and
    gathers rare ones, so neither one task nor a cloud of small files results."""
    balanced = records.withColumn("folder", F.col("subreddit")).hint("rebalance", "folder")
    balanced.write.mode("append").partitionBy("folder").json(path)


def keyed_json(records: DataFrame, key: str = "id") -> DataFrame:
    """Messages: key, and the whole record as JSON."""
    return records.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def decode_messages(envelopes: DataFrame, topic: str, schema: StructType) -> DataFrame:
    """Records of one topic; a message that is not valid JSON keeps its text in `_corrupt`."""
    parsed = _parsed(F.col("value").cast("string"), schema)
    return envelopes.where(F.col("topic") == topic).select(parsed.alias("record"), "timestamp").select(
        "record.*", F.col("timestamp").alias("received")
    )


def kafka_source(spark: SparkSession, servers: str, topics: list[str]) -> DataFrame:
    """Stream of envelopes from the earliest offset; needs the Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return (
        stream.option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .load()
        .select("topic", F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")
    )


def kafka_sink(messages: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Publish keyed_json rows; a streaming frame starts a query and needs a checkpoint folder."""
    target = messages.withColumn("topic", F.lit(topic))
    writer = target.writeStream if target.isStreaming else target.write
    writer = writer.format("kafka").option("kafka.bootstrap.servers", servers)
    if target.isStreaming:
        return writer.option("checkpointLocation", checkpoint).start()
    return writer.save()
