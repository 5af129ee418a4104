"""Reassembly of sessions into documents, in two steps.

The lines of a session that lie in one block are joined to a piece where the framing has put
them, by (channel, block): no shuffle.  Then the pieces of a session, one a block, are joined to
the document.  So a long session is put together from few large pieces, by many tasks, and lines
are shuffled only once more, as pieces.  Which sessions have an END is known from a narrow pass
without text; pieces of all others go nowhere.

A document in one row is bounded by what a row can hold (2 GB).  ``document_parts`` gives the
pieces themselves, for sessions of any size.  ``max_document_bytes`` is for those who want large
sessions kept out of ``assemble``; their lines then come out of ``oversize_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow.functions.text import clean_line, session_id_of
from trackflow.functions.xml import repair_tokens
from trackflow.operators.framing import BLOCK_OFFSETS, with_blocks, with_line_bytes

_NO_START = -1


def count_lines(lines: DataFrame) -> DataFrame:
    """Content lines per session."""
    return (
        lines.where("marker IS NULL")
        .groupBy("channel", "start_offset")
        .agg(F.count("*").alias("n_lines"))
        .select(
            "channel",
            session_id_of(F.col("channel"), F.col("start_offset")).alias("session_id"),
            "n_lines",
        )
    )


def _up_to_end(include_orphans: bool) -> Column:
    """Lines up to and including the first END of a session."""
    return ~F.col("closed") if include_orphans else (
        ~F.col("closed") & F.col("start_offset").isNotNull()
    )


def _oversize_by_block(sizes: DataFrame, max_document_bytes: int) -> DataFrame:
    """Per (channel, block): starts of the sessions whose content is above the limit."""
    by_block = sizes.groupBy("channel", "block", "session_start").agg(
        F.sum("n_bytes").alias("n_bytes"), F.bool_or("is_end").alias("has_end")
    )
    session = Window.partitionBy("channel", "session_start")
    return (
        by_block.withColumn("total_bytes", F.sum("n_bytes").over(session))
        .withColumn("is_complete", F.bool_or("has_end").over(session))
        .where(F.col("total_bytes") > max_document_bytes)
        .groupBy("channel", "block")
        .agg(
            F.collect_set("session_start").alias("oversize"),
            F.collect_set(F.when(F.col("is_complete"), F.col("session_start"))).alias(
                "oversize_complete"
            ),
        )
    )


def _listed(name: str) -> Column:
    return F.coalesce(F.array_contains(name, F.col("session_start")), F.lit(False))


def flag_oversize(
    lines: DataFrame,
    separator: str = "",
    clean: str = "regex",
    max_document_bytes: int | None = None,
    include_orphans: bool = False,
    block_size: int = BLOCK_OFFSETS,
) -> DataFrame:
    """Lines up to the first END of each session, their cleaned ``text``, and size flags.

    ``is_oversize``: the session's content is above the limit.  ``is_oversize_document``: it is,
    and the session is complete.
    """
    parts = with_line_bytes(with_blocks(lines, block_size=block_size)).where(
        _up_to_end(include_orphans)
    )
    texts = parts.withColumns(
        {
            "session_start": F.coalesce("start_offset", F.lit(_NO_START)),
            "text": F.when(F.col("marker").isNull(), clean_line(F.col("line"), clean)),
        }
    )
    if max_document_bytes is None:
        no = F.lit(False)
        return texts.withColumns({"is_oversize": no, "is_oversize_document": no})
    n_bytes = F.col("line_bytes") + F.lit(len(separator.encode()))
    sizes = texts.select(
        "channel",
        "block",
        "session_start",
        F.col("marker").eqNullSafe("END").alias("is_end"),
        F.when(F.col("marker").isNull(), n_bytes).otherwise(0).alias("n_bytes"),
    )
    flagged = texts.join(
        _oversize_by_block(sizes, max_document_bytes), ["channel", "block"], "left"
    )
    return flagged.withColumns(
        {"is_oversize": _listed("oversize"), "is_oversize_document": _listed("oversize_complete")}
    ).drop("oversize", "oversize_complete")


def _session_start() -> Column:
    return F.nullif(F.col("session_start"), F.lit(_NO_START).cast("bigint"))


def assemble(
    lines: DataFrame,
    separator: str = "",
    clean: str = "regex",
    max_document_bytes: int | None = None,
    include_orphans: bool = False,
    block_size: int = BLOCK_OFFSETS,
) -> DataFrame:
    """One document per completed session: its cleaned content lines in offset order.

    Content is what lies between START and the first END.  ``include_orphans`` also emits the
    lines before a channel's first START, under the id ``'null'``, once an END has come.
    Sessions of any size are assembled; ``max_document_bytes`` leaves out those above it, at the
    price of a pass over the sizes.
    """
    flagged = flag_oversize(
        lines, separator, clean, max_document_bytes, include_orphans, block_size
    )
    return collect_documents(flagged.where("NOT is_oversize"), separator)


def session_pieces(flagged: DataFrame, separator: str = "") -> DataFrame:
    """Per session and block the joined texts of its lines, for sessions that have their END."""
    is_text, is_end = F.col("marker").isNull(), F.col("marker").eqNullSafe("END")
    collected = (
        flagged.where(is_text | is_end)
        .groupBy("channel", "block", "session_start")
        .agg(
            F.array_sort(F.collect_list(F.when(is_text, F.struct("offset", "text")))).alias("lines"),
            F.max(F.when(is_end, F.col("offset"))).alias("end_offset"),
        )
    )
    texts = F.transform("lines", lambda line: line["text"])
    pieces = collected.select(
        "channel",
        "session_start",
        "block",
        "end_offset",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.array_join(texts, separator).alias("text"),
    )
    # Left to Spark's size check, like every join here.
    ended = flagged.where(is_end).select("channel", "session_start")
    return pieces.join(ended, ["channel", "session_start"], "left_semi")


def collect_documents(flagged: DataFrame, separator: str = "") -> DataFrame:
    """One row per session that has its END: its pieces joined in order."""
    has_text = F.col("n_lines") > 0
    joined = (
        session_pieces(flagged, separator)
        .groupBy("channel", "session_start")
        .agg(
            F.array_sort(F.collect_list(F.when(has_text, F.struct("block", "text")))).alias("pieces"),
            F.max("end_offset").alias("end_offset"),
            F.sum("n_lines").alias("n_lines"),
        )
    )
    texts = F.transform("pieces", lambda piece: piece["text"])
    return joined.select(
        "channel",
        session_id_of(F.col("channel"), _session_start()).alias("session_id"),
        _session_start().alias("start_offset"),
        "end_offset",
        "n_lines",
        F.array_join(texts, separator).alias("xml"),
    )


def document_parts(
    lines: DataFrame,
    separator: str = "",
    clean: str = "regex",
    include_orphans: bool = False,
    block_size: int = BLOCK_OFFSETS,
) -> DataFrame:
    """The documents in parts, one per block of offsets, for sessions that no row can hold.

    Joined in the order of ``part`` with the separator they give the document.  The parts of a
    session need not follow each other without a gap: a block without content has none.
    """
    flagged = flag_oversize(lines, separator, clean, None, include_orphans, block_size)
    first = F.coalesce(F.expr(f"start_offset div {int(block_size)}"), F.lit(0))
    return (
        session_pieces(flagged, separator)
        .where("n_lines > 0")
        .withColumn("start_offset", _session_start())
        .select(
            "channel",
            session_id_of(F.col("channel"), F.col("start_offset")).alias("session_id"),
            "start_offset",
            (F.col("block") - first).alias("part"),
            "n_lines",
            "text",
        )
    )


def oversize_lines(
    lines: DataFrame,
    separator: str = "",
    clean: str = "regex",
    max_document_bytes: int | None = None,
    include_orphans: bool = False,
    block_size: int = BLOCK_OFFSETS,
) -> DataFrame:
    """Every content line of the completed sessions that ``assemble`` leaves out for size."""
    flagged = flag_oversize(
        lines, separator, clean, max_document_bytes, include_orphans, block_size
    )
    return oversize_texts(flagged.where("is_oversize_document"))


def oversize_texts(flagged: DataFrame) -> DataFrame:
    return flagged.where("marker IS NULL").select(
        "channel",
        session_id_of(F.col("channel"), _session_start()).alias("session_id"),
        _session_start().alias("start_offset"),
        "offset",
        "text",
    )


def repair_documents(documents: DataFrame, repairs: dict[str, str] | None = None) -> DataFrame:
    """Repair known broken tokens in the document text."""
    return documents.withColumn("xml", repair_tokens(F.col("xml"), repairs))


def document_stats(documents: DataFrame, repairs: dict[str, str] | None = None) -> DataFrame:
    """Length of each document before and after token repair."""
    return documents.select(
        *[name for name in documents.columns if name != "xml"],
        F.char_length("xml").alias("n_chars_in"),
        F.char_length(repair_tokens(F.col("xml"), repairs)).alias("n_chars_out"),
    )
