"""Marker-framed sessions.

A START line opens a session on its channel; the session's id goes to every later line up to
the next START.  The first END completes the session.  Order is (channel, offset) and nothing
else, so a replayed message gets the same id.

One channel may hold most of the rows.  A channel is therefore cut into blocks of offsets:
a small table with one row per (channel, block) carries the last START and END across block
borders, and each task works on one block.  The lines are shuffled once, by (channel, block);
the carry join reuses that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow.functions.text import session_id_of

BLOCK_OFFSETS = 65_536


def _offset_of(marker: str, order: str) -> Column:
    return F.when(F.col("marker") == marker, F.col(order))


def _block(order: str, block_size: int) -> Column:
    return F.expr(f"`{order}` div {int(block_size)}")


def with_blocks(df: DataFrame, order: str = "offset", block_size: int = BLOCK_OFFSETS) -> DataFrame:
    """Add the block number, unless the lines already carry one."""
    return df if "block" in df.columns else df.withColumn("block", _block(order, block_size))


def with_line_bytes(df: DataFrame) -> DataFrame:
    """Add the size of each line, to be known before any shuffle moves the text."""
    if "line_bytes" in df.columns or "line" not in df.columns:
        return df
    return df.withColumn("line_bytes", F.octet_length("line").cast("bigint"))


def _carries(lines: DataFrame, channel: str, order: str) -> DataFrame:
    """Per (channel, block): last START and END before the block and in the whole channel."""
    blocks = lines.groupBy(channel, "block").agg(
        F.max(_offset_of("START", order)).alias("block_start"),
        F.max(_offset_of("END", order)).alias("block_end"),
    )
    by_channel = Window.partitionBy(channel)
    before = by_channel.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        channel,
        "block",
        F.max("block_start").over(before).alias("carry_start"),
        F.max("block_end").over(before).alias("carry_end"),
        F.max("block_start").over(by_channel).alias("channel_start"),
        F.max("block_end").over(by_channel).alias("channel_end"),
    )


def _label(lines: DataFrame, channel: str, order: str) -> DataFrame:
    """Turn ``start_offset`` and ``prior_end`` into id, phase and the closed flag."""
    start, prior_end = F.col("start_offset"), F.col("prior_end")
    closed = prior_end.isNotNull() & (start.isNull() | (prior_end > start))
    phase = (
        F.when(F.col("marker") == "START", F.lit("start"))
        .when(start.isNull(), F.lit("orphan"))
        .when(closed, F.lit("trailing"))
        .when(F.col("marker") == "END", F.lit("end"))
        .otherwise(F.lit("content"))
    )
    return lines.withColumns(
        {
            "session_id": session_id_of(F.col(channel), start),
            "phase": phase,
            "closed": closed & ~F.col("marker").eqNullSafe("START"),
        }
    ).drop("prior_end")


def assign_sessions(
    df: DataFrame,
    channel: str = "channel",
    order: str = "offset",
    block_size: int | None = BLOCK_OFFSETS,
) -> DataFrame:
    """Give every marked line its session.

    Adds ``session_id``, ``start_offset``, ``phase`` (orphan, start, content, end, trailing),
    ``closed`` (an END of the same session came before), ``line_bytes`` and, when blocked,
    ``block``.
    ``block_size=None`` uses one window per channel, one shuffle in all; it fits only channels
    that one task can sort.
    """
    if block_size is None:
        ordered = Window.partitionBy(channel).orderBy(order)
        lines = with_line_bytes(df).withColumns(
            {
                "start_offset": F.max(_offset_of("START", order)).over(
                    ordered.rowsBetween(Window.unboundedPreceding, 0)
                ),
                "prior_end": F.max(_offset_of("END", order)).over(
                    ordered.rowsBetween(Window.unboundedPreceding, -1)
                ),
            }
        )
        return _label(lines, channel, order)
    return assign_sessions_blocked(df, block_size, channel, order)


def assign_sessions_blocked(
    df: DataFrame,
    block_size: int = BLOCK_OFFSETS,
    channel: str = "channel",
    order: str = "offset",
    keep_open_flag: bool = False,
) -> DataFrame:
    """``assign_sessions`` for channels of any length; the result does not depend on the size.

    ``keep_open_flag`` adds ``is_open``: the session is the last one of its channel and has no
    END yet, so later messages may still belong to it.
    """
    sized = with_line_bytes(df)
    lines = sized.withColumn("block", _block(order, block_size))
    ordered = Window.partitionBy(channel, "block").orderBy(order)
    within = lines.withColumns(
        {
            "in_block_start": F.max(_offset_of("START", order)).over(
                ordered.rowsBetween(Window.unboundedPreceding, 0)
            ),
            "in_block_end": F.max(_offset_of("END", order)).over(
                ordered.rowsBetween(Window.unboundedPreceding, -1)
            ),
        }
    )
    carried = within.join(_carries(lines, channel, order), [channel, "block"], "left")
    labelled = _label(
        carried.withColumns(
            {
                "start_offset": F.coalesce("in_block_start", "carry_start"),
                "prior_end": F.coalesce("in_block_end", "carry_end"),
            }
        ),
        channel,
        order,
    )
    added = ["session_id", "start_offset", "phase", "closed", "block"]
    if keep_open_flag:
        unended = F.col("channel_end").isNull() | (F.col("channel_end") < F.col("channel_start"))
        labelled = labelled.withColumn(
            "is_open",
            F.coalesce((F.col("start_offset") == F.col("channel_start")) & unended, F.lit(False)),
        )
        added.append("is_open")
    return labelled.select(*sized.columns, *added)


def line_table(lines: DataFrame) -> DataFrame:
    """Every line with the id of its session, markers included."""
    return lines.select(
        "channel", "offset", F.col("session_id").alias("id"), F.col("line").alias("xml")
    )


def session_status(lines: DataFrame) -> DataFrame:
    """One status row per (channel, session): complete once its first END is there."""
    is_end = F.col("marker").eqNullSafe("END")
    counted = F.col("marker").isNull() & ~F.col("closed")
    return (
        lines.groupBy("channel", "start_offset")
        .agg(
            F.bool_or(is_end).alias("is_complete"),
            F.min(F.when(is_end, F.col("offset"))).alias("end_offset"),
            F.count_if(counted).alias("n_lines"),
        )
        .select(
            "channel",
            session_id_of(F.col("channel"), F.col("start_offset")).alias("session_id"),
            "is_complete",
            "start_offset",
            "end_offset",
            "n_lines",
        )
    )


def completed_sessions(status: DataFrame, include_orphans: bool = False) -> DataFrame:
    """Sessions that have seen their END."""
    done = status.where("is_complete")
    return done if include_orphans else done.where("start_offset IS NOT NULL")


def unclosed_sessions(status: DataFrame) -> DataFrame:
    """Sessions that were opened and never completed."""
    return status.where("NOT is_complete AND start_offset IS NOT NULL")


def apply_status(current: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """Upsert and delete in a keyed table: per key the row with the highest ``seq`` wins.

    Both sides carry the key, ``value``, ``deleted`` and ``seq``, and so does the result, the
    table to store: deleted keys stay in it, marked, so that changes may come again or out of
    order.  ``live_status`` reads it.  Among rows of equal ``seq`` a deletion wins, then the
    greater value.
    """
    columns = [*key, "value", "deleted", "seq"]
    latest = (
        current.select(*columns)
        .unionByName(changes.select(*columns))
        .groupBy(*key)
        .agg(F.max(F.struct("seq", "deleted", "value")).alias("latest"))
    )
    return latest.select(*key, *[f"latest.{name}" for name in ("value", "deleted", "seq")])


def live_status(stored: DataFrame) -> DataFrame:
    """The keys of a stored status table that are not deleted."""
    return stored.where("NOT deleted").drop("deleted")


def session_lines_for(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """Lines of the sessions listed in ``ids`` (channel, session_id).

    A semi-join without a hint: Spark broadcasts ``ids`` only when its measured size allows it
    and splits a skewed session otherwise.
    """
    wanted = ids.select("channel", "session_id")
    return lines.join(wanted, ["channel", "session_id"], "left_semi")


def content_lines(lines: DataFrame) -> DataFrame:
    """Lines that are no marker."""
    return lines.where("marker IS NULL")
