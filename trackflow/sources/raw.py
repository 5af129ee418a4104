"""Reading raw messages from a stream or a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RAW_SCHEMA = "channel string, offset long, value string"


def read_raw(
    spark: SparkSession,
    format: str,
    path: str | None = None,
    streaming: bool = False,
    schema: str | StructType | None = None,
    **options: str,
) -> DataFrame:
    """Read messages as a table or as a stream.

    ``kafka`` takes its usual options (``kafka.bootstrap.servers``, ``subscribe``) and gives
    ``channel`` = topic and partition.  File formats give the columns of the files; a stream
    of files needs ``schema``.  Nothing bounds a micro-batch unless the source's own option does
    (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``).
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(format).options(**options)
    if format == "kafka":
        return kafka_messages(reader.load())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def kafka_messages(df: DataFrame) -> DataFrame:
    """Kafka source columns to (channel, offset, value); order within a partition is kept."""
    channel = F.concat_ws("-", F.col("topic"), F.col("partition").cast("string"))
    return df.select(channel.alias("channel"), "offset", "value")


def raw_entries(messages: DataFrame) -> DataFrame:
    """Keyed table of raw messages; the id comes from the position, so a replay adds nothing."""
    entry_id = F.md5(
        F.concat_ws(":", F.col("channel").cast("string"), F.col("offset").cast("string"))
    )
    entries = messages.select(entry_id.alias("entry_id"), F.col("value").alias("entry_data"))
    return entries.dropDuplicates(["entry_id"])
