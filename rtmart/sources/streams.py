"""Streaming sources.

Production input is Kafka (``spark-sql-kafka`` on the class path); tests and
the registered stream queries use a file source over time-ordered files.
Offsets are kept by the query checkpoint: a restarted query resumes after the
last committed batch (the reference kept offsets in an external hash and
saved them after each batch's output).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def kafka_stream(spark: SparkSession, topics: str, bootstrap_servers: str,
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                 extra: dict | None = None, group: str | None = None,
                 headers: bool = False) -> DataFrame:
    """A Kafka topic as a stream of (key, value) strings.

    ``group`` names the consumer group that brokers see and authorise; what
    has been read is the checkpoint's business. With ``headers`` the change
    type that ``with_headers`` wrote comes back as column ``op``.

    ``starting_offsets`` is 'latest' (no saved offsets), 'earliest', or a JSON
    offsets map; it applies only on the first start, after that the
    checkpoint decides. Requires the Kafka connector jar.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topics)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", "true"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if group:
        r = r.option("kafka.group.id", group)
    if headers:
        r = r.option("includeHeaders", "true")
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    op = ["CAST(filter(headers, h -> h.key = 'op')[0].value AS STRING) AS op"] if headers else []
    return r.load().selectExpr("topic", "CAST(key AS STRING) AS key",
                               "CAST(value AS STRING) AS value", "partition", "offset", *op)


def with_headers(messages: DataFrame) -> DataFrame:
    """Messages for a Kafka sink: a change type ``op`` becomes a header."""
    if "op" not in messages.columns:
        return messages
    header = F.array(F.struct(F.lit("op").alias("key"), F.col("op").cast("binary").alias("value")))
    return messages.withColumn("headers", F.when(F.col("op").isNotNull(), header)).drop("op")


def kafka_sink_options(bootstrap_servers: str) -> dict:
    """K1/K2: options for ``write[Stream].format('kafka')``; rows carry
    ``topic``, optional ``key`` and ``value`` columns."""
    return {"kafka.bootstrap.servers": bootstrap_servers}


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """A folder of files (sub-folders included) as a stream, oldest first."""
    r = (spark.readStream.format(fmt).schema(schema).option("latestFirst", "false")
         .option("recursiveFileLookup", "true"))
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(files_per_trigger))
    return r.load(path)


def text_log_stream(spark: SparkSession, path: str,
                    files_per_trigger: int | None = None) -> DataFrame:
    """Raw log files (one JSON body per line) as a stream of ``value``."""
    r = spark.readStream.format("text")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(files_per_trigger))
    return r.load(path)
