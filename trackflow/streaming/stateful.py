"""Framing a stream with keyed state, for low latency and very many open sessions.

Each channel keeps its open session in the state store, so a micro-batch touches only the
channels it brings lines for.  The lines of one channel in one micro-batch are sorted in
memory: bound them with the source's trigger options (``maxOffsetsPerTrigger``).  For large
micro-batches or very busy channels use ``frame_stream``, which splits channels into blocks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trackflow.functions.text import clean_line, session_id_of
from trackflow.operators.framing import with_line_bytes

OUTPUT = (
    "channel {channel}, kind string, start_offset long, end_offset long, part int,"
    " n_lines long, xml string"
)

_OPEN_STATE = "start_offset long, last_offset long, n_bytes long, part int, expires long"
_NONE = -1


class FrameProcessor(StatefulProcessor):
    """Emits a ``document`` at END, an ``unclosed`` row when a START supersedes a session.

    A session above the limit leaves in ``fragment`` rows, in order and numbered by ``part``,
    so that its lines do not pile up in the state; its last part is a fragment too.

    A session that no line of its channel has touched for ``ttl_seconds`` leaves as ``expired``
    with the text it has, and its state is forgotten.  A content line that belongs to no open
    session is an ``outside`` row, a line whose offset was seen already a ``late`` row, both with
    their offset as ``end_offset``: no line goes without a trace.
    """

    def __init__(
        self, separator: str, max_document_bytes: int | None, ttl_seconds: float | None = None
    ):
        self.separator = separator
        self.separator_bytes = len(separator.encode())
        self.max_document_bytes = max_document_bytes
        self.ttl = None if ttl_seconds is None else max(1, round(ttl_seconds * 1000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _OPEN_STATE)
        self.lines = handle.getListState("lines", "text string")

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues
    ) -> Iterator[pd.DataFrame]:
        before = self.open.get() if self.open.exists() else (_NONE, _NONE, 0, 0, _NONE)
        start, last, n_bytes, part, expires = before
        arrived = pd.concat(list(rows), ignore_index=True)
        arrived = arrived.sort_values("offset", kind="stable", ignore_index=True)
        seen = (arrived["offset"] <= last) | arrived["offset"].duplicated()
        late = [
            (key[0], "late", None, offset, 0, 1, text)
            for offset, text in zip(arrived["offset"][seen], arrived["text"][seen])
        ]
        arrived = arrived[~seen].reset_index(drop=True)
        if arrived.empty:
            if late:
                yield pd.DataFrame(late, columns=_OUTPUT_NAMES)
            return
        last = int(arrived["offset"].iloc[-1])
        emitted, pending = late, []

        def emit(kind: str, end: int | None) -> None:
            kept = [] if kind == "unclosed" else [text for (text,) in self.lines.get()]
            kept += [] if kind == "unclosed" else pending
            xml = None if kind == "unclosed" else self.separator.join(kept)
            emitted.append((key[0], kind, start, end, part, len(kept), xml))
            pending.clear()
            self.lines.clear()

        # Each run is a marker row, if any, and the content lines up to the next marker.
        runs = arrived["marker"].notna().cumsum()
        for _, run in arrived.groupby(runs, sort=True):
            marker, offset = run["marker"].iloc[0], int(run["offset"].iloc[0])
            if marker == "START":
                if start != _NONE:
                    emit("unclosed", None)
                start, n_bytes, part = offset, 0, 0
            elif marker == "END" and start != _NONE:
                emit("fragment" if part else "document", offset)
                start = _NONE
            content = run[run["marker"].isna()]
            if start == _NONE:
                emitted += [
                    (key[0], "outside", None, offset, 0, 1, text)
                    for offset, text in zip(content["offset"], content["text"])
                ]
                continue
            pending.extend(content["text"])
            n_bytes += int(content["line_bytes"].sum()) + self.separator_bytes * len(content)
            if self.max_document_bytes is not None and n_bytes > self.max_document_bytes:
                emit("fragment", None)
                n_bytes, part = 0, part + 1
        if pending:
            self.lines.appendList([(text,) for text in pending])
        if self.ttl is not None:
            if expires != _NONE:
                self.handle.deleteTimer(expires)
            expires = _NONE
            if start != _NONE:
                expires = timerValues.getCurrentProcessingTimeInMs() + self.ttl
                self.handle.registerTimer(expires)
        self.open.update((start, last, n_bytes, part, expires))
        if emitted:
            yield pd.DataFrame(emitted, columns=_OUTPUT_NAMES)

    def handleExpiredTimer(
        self, key: tuple, timerValues, expiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        start, last, _, part, expires = self.open.get()
        if start == _NONE or expires != expiredTimerInfo.getExpiryTimeInMs():
            return
        kept = [text for (text,) in self.lines.get()]
        self.lines.clear()
        # The last offset stays, so that lines that come again are known as late.
        self.open.update((_NONE, last, 0, 0, _NONE))
        row = (key[0], "expired", start, last, part, len(kept), self.separator.join(kept))
        yield pd.DataFrame([row], columns=_OUTPUT_NAMES)

    def close(self) -> None:
        pass


_OUTPUT_NAMES = ["channel", "kind", "start_offset", "end_offset", "part", "n_lines", "xml"]


def frame_stateful(
    marked: DataFrame,
    separator: str = "",
    clean: str = "regex",
    max_document_bytes: int | None = None,
    ttl_seconds: float | None = None,
) -> DataFrame:
    """Streaming DataFrame of documents from a stream of marked lines; see ``FrameProcessor``.

    Start it with ``start_query(..., state_store=STATE_STORE)``: the state is a value and a list,
    which the default state store cannot keep.  Lines before any START and after END are not kept
    in the state.  Without ``ttl_seconds`` an open session waits for ever; with it, run the
    query with a processing-time trigger: timers keep a draining one from ending.
    """
    # The processor goes to the workers as code, so that they need not have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    channel_type = marked.schema["channel"].dataType.simpleString()
    text = F.when(F.col("marker").isNull(), clean_line(F.col("line"), clean))
    lines = with_line_bytes(marked).select(
        "channel", "offset", "marker", "line_bytes", text.alias("text")
    )
    framed = lines.groupBy("channel").transformWithStateInPandas(
        FrameProcessor(separator, max_document_bytes, ttl_seconds),
        OUTPUT.format(channel=channel_type),
        "Append",
        "None" if ttl_seconds is None else "ProcessingTime",
    )
    return framed.withColumn("session_id", session_id_of(F.col("channel"), F.col("start_offset")))
