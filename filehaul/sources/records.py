"""Streams of text records and their decoding into typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

# Fixed value: the schema of the customer stream, in column order.
CUSTOMER_SCHEMA = StructType(
    [
        StructField("_id", StringType()),
        StructField("guid", StringType()),
        StructField("age", IntegerType()),
        StructField("isActive", BooleanType()),
        StructField("balance", StringType()),
        StructField("picture", StringType()),
        StructField("index", IntegerType()),
        StructField("first", StringType()),
        StructField("last", StringType()),
        StructField("company", StringType()),
    ]
)
DEFAULT_BATCH_SECONDS = 10
CORRUPT = "_corrupt_record"


def kafka_options(
    brokers: str,
    topic: str,
    max_rate_per_partition: int | None = None,
    partitions: int | None = None,
    batch_seconds: int = DEFAULT_BATCH_SECONDS,
) -> dict[str, str]:
    """Options of Spark's Kafka source; the rate is records per second and partition."""
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topic}
    if max_rate_per_partition is not None:
        if not partitions:
            raise ValueError("a rate per partition needs the number of partitions")
        limit = max_rate_per_partition * partitions * batch_seconds
        options["maxOffsetsPerTrigger"] = str(limit)
    return options


def kafka_records(spark: SparkSession, brokers: str, topic: str, **limits) -> DataFrame:
    """Stream of message texts as column ``value``; needs Spark's Kafka connector on the class path."""
    source = spark.readStream.format("kafka").options(**kafka_options(brokers, topic, **limits))
    return source.load().select(F.col("value").cast("string").alias("value"))


def text_records(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of the lines of text files that appear in a directory, as column ``value``."""
    source = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        source = source.option("maxFilesPerTrigger", max_files_per_trigger)
    return source.load(path)


def decode_csv(
    records: DataFrame, schema: StructType, fail_fast: bool = False, **csv_options: str
) -> DataFrame:
    """Columns of ``schema`` from CSV lines in ``value``, and ``_corrupt_record`` for bad lines.

    A line with a wrong type or a wrong number of fields is bad, and so is an
    empty line or message unless the schema has just one column. With
    ``fail_fast`` a bad line is an error.
    """
    options = {
        "mode": "FAILFAST" if fail_fast else "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        **csv_options,
    }
    wanted = StructType([*schema.fields]).add(CORRUPT, "string")
    parsed = F.from_csv("value", wanted.toDDL(), options)
    line = F.coalesce("value", F.lit(""))
    empty = (F.trim(line) == "") & F.lit(len(schema) > 1)
    reason = F.raise_error(F.lit("empty record")) if fail_fast else line
    return records.select("value", parsed.alias("record")).select(
        *(F.col("record").getField(name).alias(name) for name in schema.names),
        F.when(empty, reason.cast("string"))
        .when(F.col("record").isNull(), line)
        .otherwise(F.col("record").getField(CORRUPT))
        .alias(CORRUPT),
    )


def good_records(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_records(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def check_schema(rows: DataFrame, schema: StructType) -> DataFrame:
    """The rows, when their names, order and types are exactly those of the schema."""
    found = [(field.name, field.dataType) for field in rows.schema]
    wanted = [(field.name, field.dataType) for field in schema]
    if found != wanted:
        raise ValueError(f"schema differs: {found} instead of {wanted}")
    return rows
