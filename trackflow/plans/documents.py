"""From raw messages to documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trackflow.operators.assembly import assemble
from trackflow.operators.framing import BLOCK_OFFSETS, assign_sessions, with_line_bytes
from trackflow.operators.messages import accepted_lines, decode_value, drop_prolog, mark_lines
from trackflow.session import shared_folder


def marked_lines(messages: DataFrame) -> DataFrame:
    """Decode, drop prologs, take off the envelope, find the markers; batch or streaming."""
    return mark_lines(accepted_lines(drop_prolog(decode_value(messages))))


def staged(df: DataFrame, name: str = "lines") -> DataFrame:
    """Write rows once to the folder the cluster shares and go on from that table.

    Framing reads its lines three times, twice without their text.  A table makes the narrow
    passes cheap; it pays off when the source is slow or has to be decoded.  The caller deletes
    the table.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def session_lines(
    messages: DataFrame, block_size: int = BLOCK_OFFSETS, stage: bool = False
) -> DataFrame:
    """Marked lines with their sessions."""
    lines = with_line_bytes(marked_lines(messages))
    return assign_sessions(staged(lines) if stage else lines, block_size=block_size)


def documents(
    messages: DataFrame,
    separator: str = "",
    clean: str = "regex",
    max_document_bytes: int | None = None,
    include_orphans: bool = False,
    block_size: int = BLOCK_OFFSETS,
    stage: bool = False,
) -> DataFrame:
    """One document per completed session of the raw messages."""
    return assemble(
        session_lines(messages, block_size, stage),
        separator,
        clean,
        max_document_bytes,
        include_orphans,
        block_size,
    )
