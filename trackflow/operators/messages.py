"""Row-wise operators on raw messages.  All accept batch and streaming input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.functions.text import ENVELOPE_DELIMITER, PROLOG, marker_of, payload_of


def decode_value(df: DataFrame) -> DataFrame:
    """Read the binary payload of a message as text."""
    return df.withColumn("value", F.col("value").cast("string"))


def drop_prolog(df: DataFrame, literal: str = PROLOG) -> DataFrame:
    """Drop messages that contain the exact prolog.  A NULL value stays, to be rejected later."""
    return df.where(F.col("value").isNull() | ~F.contains("value", F.lit(literal)))


def strip_envelope(df: DataFrame, delimiter: str = ENVELOPE_DELIMITER) -> DataFrame:
    """Replace ``value`` by ``line`` and say in ``reject_reason`` why a message has none."""
    reason = (
        F.when(F.col("channel").isNull() | F.col("offset").isNull(), F.lit("no_position"))
        .when(F.col("value").isNull(), F.lit("null_value"))
        .when(~F.contains("value", F.lit(delimiter)), F.lit("no_envelope"))
    )
    return df.select(
        *[name for name in df.columns if name != "value"],
        payload_of(F.col("value"), delimiter).alias("line"),
        reason.alias("reject_reason"),
    )


def envelope_rejects(df: DataFrame, delimiter: str = ENVELOPE_DELIMITER) -> DataFrame:
    """The whole messages that ``strip_envelope`` finds no line in, with the reason."""
    stripped = strip_envelope(df.withColumn("message", F.col("value")), delimiter)
    return stripped.where("reject_reason IS NOT NULL").drop("line")


def accepted_lines(df: DataFrame, delimiter: str = ENVELOPE_DELIMITER) -> DataFrame:
    """Lines of the messages that have an envelope and a position."""
    return strip_envelope(df, delimiter).where("reject_reason IS NULL").drop("reject_reason")


def mark_lines(df: DataFrame) -> DataFrame:
    """Add ``marker``: START, END or NULL."""
    return df.withColumn("marker", marker_of(F.col("line")))
