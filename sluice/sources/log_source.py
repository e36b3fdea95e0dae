"""Log-shaped stream sources (batch and streaming).

* Kafka: ``subscribe`` / ``subscribePattern``, earliest start, bounded polls
  (``maxOffsetsPerTrigger``). Offsets live in the query checkpoint, so there
  is no consumer-group auto-commit. The Kafka connector is a separate Spark
  package; without it the reader raises a clear error.
* Files: a directory of Parquet or JSON-lines files with the log columns
  (topic, partition, offset, key, value, timestamp, push_time) -- the row
  producer's form and what the tests use.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("push_time", T.LongType()),
])

VALUE_CONVERTERS = ("json", "avro", "protobuf", "string", "bytearray")


def check_converters(key_converter: str, value_converter: str, schematized: bool = True) -> None:
    """Keys may use the string converter; values of a schematized table must
    be JSON, Avro or Protobuf (string / byte-array values are refused)."""
    if value_converter not in VALUE_CONVERTERS:
        raise ValueError(f"unknown value converter {value_converter!r}")
    if schematized and value_converter in ("string", "bytearray"):
        raise ValueError("string/bytearray value converters cannot feed a schematized table")
    if key_converter not in ("string", "json", "bytearray"):
        raise ValueError(f"unknown key converter {key_converter!r}")


def kafka_stream(spark: SparkSession, bootstrap: str, topics: list[str] | None = None,
                 pattern: str | None = None, starting: str = "earliest",
                 max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None, options: dict | None = None) -> DataFrame:
    """Subscribe to topics (a list) or a pattern; returns the decoded log shape."""
    if bool(topics) == bool(pattern):
        raise ValueError("give exactly one of topics or pattern")
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("startingOffsets", starting)
         .option("failOnDataLoss", "true"))
    r = r.option("subscribe", ",".join(topics)) if topics else r.option("subscribePattern", pattern)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    try:
        raw = r.load()
    except Exception as e:  # the connector package is not on the classpath
        raise RuntimeError("the Kafka source needs the spark-sql-kafka package on the classpath") from e
    return decode_kafka(raw)


def decode_kafka(raw: DataFrame) -> DataFrame:
    """Kafka rows -> log shape: string key and value, headers as a map."""
    return raw.select(
        "topic", F.col("partition").cast("int").alias("partition"), "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                         F.current_timestamp().cast("timestamp_ntz")).alias("push_time"),
    )


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(LOG_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def file_batch(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).format(fmt).load(path)
