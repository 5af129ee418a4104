"""Framing a stream: a document leaves in the micro-batch that brings its END.

Each micro-batch is framed by the batch operators.  What it needs from before is the last START
and the last END of each channel: two narrow rows, written anew by each batch under its id, so a
repeated batch reads the same state and overwrites its own output.  The lines themselves are
written once, with the id of their session, to a table that grows by a folder per batch; a
session that ends is assembled from the folders since its START.  So an open session costs
nothing while it waits, however long it is.  A busy channel is cut into blocks as in a batch job;
nothing runs in Python.

The source is read once: the lines of a micro-batch are written to a table first, and the rest
runs as batch queries on it, with adaptive execution, which a streaming plan does not have.

Order within a channel must hold across micro-batches, as it does for a Kafka partition.
Within a micro-batch rows may come in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trackflow.functions.text import session_id_of
from trackflow.operators.assembly import collect_documents, flag_oversize, oversize_texts
from trackflow.operators.framing import BLOCK_OFFSETS, assign_sessions_blocked
from trackflow.operators.messages import decode_value, drop_prolog, mark_lines, strip_envelope
from trackflow.session import path_exists, remove_path
from trackflow.streaming.queries import TRIGGER, start_query

LINE_COLUMNS = ["channel", "offset", "line", "marker"]


def _version(path: str, table: str, batch_id: int) -> str:
    return f"{path}/{table}/batch_id={batch_id}"


def _write(df: DataFrame, path: str, table: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(_version(path, table, batch_id))


def _keep_message(df: DataFrame) -> DataFrame:
    return df.withColumn("message", F.col("value"))


class StreamFrames:
    """One framing step per micro-batch, with its tables under ``path``.

    ``lines``: every line with the id of its session, markers, orphans and trailing lines
    included.  ``documents``: one row per completed session.  ``sessions``: every session that
    closed, complete or superseded by a new START.  ``rejects``: messages without envelope, value
    or position.  With ``max_document_bytes``, ``oversize`` has the content lines of completed
    sessions above it, which then give no document.

    ``carry`` is the state.  Folders of ``lines`` older than the ``start_batch`` of the oldest
    open session there are not read again.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        separator: str = "",
        clean: str = "regex",
        max_document_bytes: int | None = None,
        block_size: int = BLOCK_OFFSETS,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.separator = separator
        self.clean = clean
        self.max_document_bytes = max_document_bytes
        self.block_size = block_size

    def read(self, table: str) -> DataFrame:
        """An output table over all batches."""
        return self.spark.read.parquet(f"{self.path}/{table}")

    def _read_version(self, table: str, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(_version(self.path, table, batch_id))

    def _carry(self, batch_id: int, channel_type: str) -> DataFrame:
        """The last START and, if the session has one, END of each channel before the batch."""
        if batch_id == 0:
            schema = f"channel {channel_type}, offset long, marker string, start_batch long"
            return self.spark.createDataFrame([], schema)
        if not path_exists(self.spark, _version(self.path, "carry", batch_id - 1)):
            raise ValueError(f"no state for batch {batch_id - 1} under {self.path}/carry")
        return self._read_version("carry", batch_id - 1)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        arrived = mark_lines(strip_envelope(_keep_message(drop_prolog(decode_value(batch)))))
        carry = self._carry(batch_id, arrived.schema["channel"].dataType.simpleString())
        message = F.when(F.col("reject_reason").isNotNull(), F.col("message")).alias("message")
        _write(
            arrived.select(*LINE_COLUMNS, "reject_reason", message),
            self.path,
            "arrived",
            batch_id,
        )
        arrived = self._read_version("arrived", batch_id)
        rejects = arrived.where("reject_reason IS NOT NULL").select(
            "channel", "offset", "message", "reject_reason"
        )
        new = arrived.where("reject_reason IS NULL").select(
            *LINE_COLUMNS, F.lit(False).alias("carried")
        )
        before = carry.select(
            "channel", "offset", F.lit(None).cast("string").alias("line"), "marker",
            F.lit(True).alias("carried"),
        )
        framed = assign_sessions_blocked(new.unionByName(before), self.block_size)
        _write(framed.where("NOT carried").drop("carried"), self.path, "lines", batch_id)
        lines = self._read_version("lines", batch_id)
        self._write_outputs(lines, carry, batch_id)
        _write(rejects, self.path, "rejects", batch_id)
        remove_path(self.spark, _version(self.path, "arrived", batch_id))
        if batch_id > 1:
            remove_path(self.spark, _version(self.path, "carry", batch_id - 2))

    def _write_outputs(self, lines: DataFrame, carry: DataFrame, batch_id: int) -> None:
        marks = lines.where("marker IS NOT NULL").select(
            "channel", "offset", "marker", F.lit(batch_id).cast("long").alias("start_batch")
        )
        both = carry.unionByName(marks)
        last = both.groupBy("channel").agg(
            F.max(F.when(F.col("marker") == "START", F.struct("offset", "start_batch"))).alias("s"),
            F.max(F.when(F.col("marker") == "END", F.struct("offset", "start_batch"))).alias("e"),
        )
        closing = F.col("s").isNull() | (F.col("e.offset") > F.col("s.offset"))
        kept = F.array(
            F.when(F.col("s").isNotNull(), F.struct(F.lit("START").alias("marker"), "s.*")),
            F.when(
                closing & F.col("e").isNotNull(), F.struct(F.lit("END").alias("marker"), "e.*")
            ),
        )
        carried = last.select("channel", F.inline(F.array_compact(kept)))
        _write(carried.select(*carry.columns), self.path, "carry", batch_id)

        open_before = carry.groupBy("channel").agg(F.count_if(F.col("marker") == "END").alias("x"))
        starts = both.where("marker = 'START'").select(
            "channel", F.col("offset").alias("start_offset"), "start_batch"
        )
        # Of the sessions from before, those that have their END are done with.
        starts = starts.join(open_before, "channel", "left").where(
            (F.col("start_batch") == batch_id) | (F.col("x") == 0)
        )
        ends = lines.where("marker = 'END' AND NOT closed AND start_offset IS NOT NULL").select(
            "channel", "start_offset", F.col("offset").alias("end_offset")
        )
        newest = last.select("channel", F.col("s.offset").alias("newest"))
        closed = (
            starts.join(ends, ["channel", "start_offset"], "left")
            .join(newest, "channel")
            .where("end_offset IS NOT NULL OR start_offset < newest")
        )
        _write(
            closed.select(
                "channel",
                session_id_of(F.col("channel"), F.col("start_offset")).alias("session_id"),
                F.col("end_offset").isNotNull().alias("is_complete"),
                "start_offset",
                "end_offset",
                "start_batch",
            ),
            self.path,
            "sessions",
            batch_id,
        )
        completed = self._read_version("sessions", batch_id).where("is_complete")
        first = completed.agg(F.min("start_batch")).first()[0]
        batches = range(batch_id if first is None else first, batch_id + 1)
        stored = self.spark.read.parquet(
            *[_version(self.path, "lines", number) for number in batches]
        )
        wanted = stored.join(
            completed.select("channel", "start_offset"), ["channel", "start_offset"], "left_semi"
        )
        flagged = flag_oversize(
            wanted, self.separator, self.clean, self.max_document_bytes, block_size=self.block_size
        )
        small, big = flagged.where("NOT is_oversize"), flagged.where("is_oversize")
        _write(collect_documents(small, self.separator), self.path, "documents", batch_id)
        _write(oversize_texts(big), self.path, "oversize", batch_id)


def frame_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    name: str = "frames",
    **options,
) -> StreamingQuery:
    """Frame a stream of raw messages; see ``StreamFrames`` for the tables and options."""
    frames = StreamFrames(messages.sparkSession, path, **options)
    return start_query(messages, frames, name, checkpoint, trigger)
