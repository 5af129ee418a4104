"""Queries on raw messages: envelope, markers, sessions, documents, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.functions.sql import register, register_views
from trackflow.functions.text import clean_line
from trackflow.operators import framing
from trackflow.operators.assembly import (
    assemble,
    count_lines,
    document_parts,
    document_stats,
    oversize_lines,
)
from trackflow.operators.messages import (
    decode_value,
    drop_prolog,
    envelope_rejects,
    strip_envelope,
)
from trackflow.plans.documents import documents, marked_lines, session_lines
from trackflow.session import STATE_STORE, shared_folder
from trackflow.sources.adapters import doc_lines, events_as_messages, raw_messages, table
from trackflow.sources.raw import raw_entries, read_raw
from trackflow.streaming.framing import StreamFrames, frame_stream
from trackflow.streaming.queries import drain, start_query
from trackflow.streaming.stateful import frame_stateful

# Small enough to make sessions of the test tables cross blocks and outgrow a document.
SMALL_BLOCK = 500
SMALL_LIMIT = 60


def decode_raw(spark: SparkSession, folder: str) -> DataFrame:
    events = read_raw(spark, "parquet", f"{folder}/events.parquet")
    messages = events_as_messages(events)
    return decode_value(messages.withColumn("value", F.col("value").cast("binary")))


def raw_entries_query(spark: SparkSession, folder: str) -> DataFrame:
    messages = raw_messages(spark, folder)
    return raw_entries(messages.unionByName(messages))


def drop_prolog_query(spark: SparkSession, folder: str) -> DataFrame:
    return drop_prolog(raw_messages(spark, folder)).select("channel", "offset")


def strip_envelope_query(spark: SparkSession, folder: str) -> DataFrame:
    return strip_envelope(drop_prolog(raw_messages(spark, folder)))


def envelope_rejects_query(spark: SparkSession, folder: str) -> DataFrame:
    rejects = envelope_rejects(drop_prolog(raw_messages(spark, folder)))
    return rejects.select("channel", "offset", "reject_reason")


def mark_lines_query(spark: SparkSession, folder: str) -> DataFrame:
    return marked_lines(raw_messages(spark, folder)).select("channel", "offset", "marker")


def clean_lines_query(spark: SparkSession, folder: str) -> DataFrame:
    lines = framing.with_line_bytes(marked_lines(raw_messages(spark, folder)))
    return lines.where("marker IS NULL").select(
        "channel", "offset", clean_line(F.col("line")).alias("clean"), "line_bytes"
    )


_FRAMED = ["channel", "offset", "session_id", "start_offset", "phase", "closed"]


def assign_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return session_lines(raw_messages(spark, folder)).select(*_FRAMED)


def assign_sessions_blocked(spark: SparkSession, folder: str) -> DataFrame:
    return session_lines(raw_messages(spark, folder), SMALL_BLOCK).select(*_FRAMED)


def line_table(spark: SparkSession, folder: str) -> DataFrame:
    return framing.line_table(session_lines(raw_messages(spark, folder)))


def _status(spark: SparkSession, folder: str) -> DataFrame:
    return framing.session_status(session_lines(raw_messages(spark, folder)))


def completed_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return framing.completed_sessions(_status(spark, folder))


def unclosed_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return framing.unclosed_sessions(_status(spark, folder))


def apply_status(spark: SparkSession, folder: str) -> DataFrame:
    """START inserts false, the first END sets true, a further END deletes.

    The changes come out of order, and then all of them once more.
    """
    lines = session_lines(raw_messages(spark, folder)).where("start_offset IS NOT NULL")
    changes = lines.where("marker IS NOT NULL").select(
        "channel",
        "session_id",
        (F.col("marker") == "END").alias("value"),
        (F.col("phase") == "trailing").alias("deleted"),
        F.col("offset").alias("seq"),
    )
    key = ["channel", "session_id"]
    stored = framing.apply_status(changes.where("value"), changes.where("NOT value"), key)
    return framing.live_status(framing.apply_status(stored, changes, key))


def session_lines_for(spark: SparkSession, folder: str) -> DataFrame:
    lines = session_lines(raw_messages(spark, folder))
    ids = framing.completed_sessions(framing.session_status(lines)).where("n_lines >= 3")
    return framing.session_lines_for(lines, ids).select("channel", "session_id", "offset")


def content_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = session_lines(raw_messages(spark, folder))
    return framing.content_lines(lines).select("channel", "session_id", "offset")


def count_lines_query(spark: SparkSession, folder: str) -> DataFrame:
    return count_lines(session_lines(raw_messages(spark, folder)))


def assemble_query(spark: SparkSession, folder: str) -> DataFrame:
    return documents(raw_messages(spark, folder))


def assemble_orphans(spark: SparkSession, folder: str) -> DataFrame:
    return documents(raw_messages(spark, folder), separator="\n", include_orphans=True)


def assemble_limited(spark: SparkSession, folder: str) -> DataFrame:
    lines = session_lines(raw_messages(spark, folder), SMALL_BLOCK)
    return assemble(lines, max_document_bytes=SMALL_LIMIT, block_size=SMALL_BLOCK)


def oversize_lines_query(spark: SparkSession, folder: str) -> DataFrame:
    lines = session_lines(raw_messages(spark, folder), SMALL_BLOCK)
    return oversize_lines(lines, max_document_bytes=SMALL_LIMIT, block_size=SMALL_BLOCK)


def document_parts_query(spark: SparkSession, folder: str) -> DataFrame:
    lines = session_lines(raw_messages(spark, folder), SMALL_BLOCK)
    return document_parts(lines, separator="\n", include_orphans=True, block_size=SMALL_BLOCK)


def document_stats_query(spark: SparkSession, folder: str) -> DataFrame:
    return document_stats(documents(raw_messages(spark, folder)))


def reassemble_text(spark: SparkSession, folder: str) -> DataFrame:
    texts = documents(doc_lines(spark, folder), clean="literal")
    return texts.select(F.col("channel").alias("doc_id"), "n_lines", F.col("xml").alias("text"))


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A stream of files takes a folder or a pattern; this pattern fits a single file too.
    path = f"{folder}/events.parque[t]"
    schema = table(spark, folder, "events").schema
    events = read_raw(spark, "parquet", path, streaming=True, schema=schema)
    return events_as_messages(events)


def frame_stream_query(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark, "frame-stream")
    query = frame_stream(
        _event_stream(spark, folder), f"{base}/out", f"{base}/checkpoint", trigger=None
    )
    drain(query)
    return StreamFrames(spark, f"{base}/out").read("documents").drop("batch_id")


def _batched_stream(
    spark: SparkSession, folder: str, base: str, micro_batches: int = 3
) -> DataFrame:
    """The events as a stream of micro-batches, an equal part of their offsets in each."""
    messages = raw_messages(spark, folder)
    top = messages.agg(F.max("offset")).first()[0] or 0
    for n in range(micro_batches):
        low, high = (top + 1) * n // micro_batches, (top + 1) * (n + 1) // micro_batches
        part = messages.where((F.col("offset") >= low) & (F.col("offset") < high))
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    return read_raw(
        spark, "parquet", f"{base}/in", streaming=True, schema=messages.schema, maxFilesPerTrigger=1
    )


def stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of the stream with the id of its session, over three micro-batches."""
    base = shared_folder(spark, "stream-lines")
    raw = _batched_stream(spark, folder, base)
    drain(frame_stream(raw, f"{base}/out", f"{base}/checkpoint", trigger=None))
    return framing.line_table(StreamFrames(spark, f"{base}/out").read("lines"))


def stream_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of sessions that go over three micro-batches."""
    base = shared_folder(spark, "stream-documents")
    raw = _batched_stream(spark, folder, base)
    drain(frame_stream(raw, f"{base}/out", f"{base}/checkpoint", trigger=None, block_size=SMALL_BLOCK))
    return StreamFrames(spark, f"{base}/out").read("documents").drop("batch_id")


def _stateful_frames(spark: SparkSession, folder: str) -> DataFrame:
    """What stateful framing gives for the events, over three micro-batches."""
    base = shared_folder(spark, "stateful")
    framed = frame_stateful(marked_lines(_batched_stream(spark, folder, base)))
    query = start_query(
        framed, f"{base}/out", "stateful", f"{base}/checkpoint", None, state_store=STATE_STORE
    )
    drain(query)
    return spark.read.parquet(f"{base}/out")


def stream_unclosed(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions that a new START superseded, over three micro-batches."""
    rows = _stateful_frames(spark, folder).where("kind = 'unclosed'")
    return rows.select("channel", "session_id", "start_offset")


def stream_stateful(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the lines outside of all sessions, over three micro-batches."""
    rows = _stateful_frames(spark, folder).where("kind IN ('document', 'outside')")
    return rows.select(
        "channel", "kind", "start_offset", "end_offset", F.col("n_lines").cast("bigint"), "xml"
    )


def stream_table(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark, "stream-table")
    lines = marked_lines(_event_stream(spark, folder))
    drain(start_query(lines, f"{base}/out", "lines", f"{base}/checkpoint", trigger=None))
    return spark.read.parquet(f"{base}/out").select("channel", "offset", "marker")


def sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    register(spark)
    messages = raw_messages(spark, folder)
    times = table(spark, folder, "events").select(
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp_ntz").alias("ts")
    )
    return (
        messages.join(times, "offset")
        .withColumn("line", F.expr("strip_envelope(value)"))
        .selectExpr(
            "channel",
            "offset",
            "marker_of(line) AS marker",
            "clean_line(line) AS clean",
            "st_key(CAST(channel % 360 - 180 AS DOUBLE), CAST(offset % 180 - 90 AS DOUBLE), ts)"
            " AS st_key",
        )
    )


def sql_views(spark: SparkSession, folder: str) -> DataFrame:
    lines = session_lines(raw_messages(spark, folder))
    register_views(spark, session_lines=lines, session_status=framing.session_status(lines))
    return spark.sql(
        """SELECT l.channel, l.session_id, count(*) AS n_lines, max(l.offset) AS last_offset
           FROM session_lines l
           JOIN session_status s ON l.channel = s.channel AND l.session_id = s.session_id
           WHERE s.is_complete AND l.marker IS NULL
           GROUP BY l.channel, l.session_id"""
    )


QUERIES = {
    "decode_raw": decode_raw,
    "raw_entries": raw_entries_query,
    "drop_prolog": drop_prolog_query,
    "strip_envelope": strip_envelope_query,
    "envelope_rejects": envelope_rejects_query,
    "mark_lines": mark_lines_query,
    "clean_lines": clean_lines_query,
    "assign_sessions": assign_sessions,
    "assign_sessions_blocked": assign_sessions_blocked,
    "line_table": line_table,
    "session_status": _status,
    "completed_sessions": completed_sessions,
    "unclosed_sessions": unclosed_sessions,
    "apply_status": apply_status,
    "session_lines_for": session_lines_for,
    "content_lines": content_lines,
    "count_lines": count_lines_query,
    "assemble": assemble_query,
    "assemble_orphans": assemble_orphans,
    "assemble_limited": assemble_limited,
    "oversize_lines": oversize_lines_query,
    "document_parts": document_parts_query,
    "document_stats": document_stats_query,
    "reassemble_text": reassemble_text,
    "frame_stream": frame_stream_query,
    "stream_table": stream_table,
    "stream_lines": stream_lines,
    "stream_documents": stream_documents,
    "stream_unclosed": stream_unclosed,
    "stream_stateful": stream_stateful,
    "sql_functions": sql_functions,
    "sql_views": sql_views,
}
