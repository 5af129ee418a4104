"""Streams: documents across micro-batches, restarts, repeats, size limit, sinks."""

import time

import pandas as pd
from pyspark.sql import functions as F

from test_assembly import expected_documents
from test_framing import random_rows
from trackflow.operators.sinks import observe_sink, write_messages
from trackflow.plans.documents import marked_lines
from trackflow.session import STATE_STORE
from trackflow.sources.raw import RAW_SCHEMA, read_raw
from trackflow.streaming.framing import StreamFrames, frame_stream
from trackflow.streaming.queries import SinkReport, batch_writer, drain, named_query, start_query
from trackflow.streaming.stateful import FrameProcessor, frame_stateful

MARKS = {"START": '{"mark":"START"}', "END": '{"mark":"END"}'}


def as_messages(rows):
    """Rows of the framing model as raw messages."""
    return [
        (channel, offset, f'h"text/plain"{MARKS.get(marker, text)}')
        for channel, offset, marker, text in rows
    ]


def put(spark, path, rows):
    df = spark.createDataFrame(rows, "channel long, offset long, value string")
    df.coalesce(1).write.mode("append").json(path)
    time.sleep(1.1)


def stream_of(spark, path):
    schema = RAW_SCHEMA.replace("channel string", "channel long")
    return read_raw(
        spark, "json", path, streaming=True, schema=schema, maxFilesPerTrigger="1"
    )


def parts_of(rows, count):
    """Cut by offset, so that order holds across the parts of a channel."""
    edges = sorted(row[1] for row in rows)
    bounds = [edges[len(edges) * i // count] for i in range(1, count)]
    return [
        [row for row in rows if sum(row[1] >= bound for bound in bounds) == part]
        for part in range(count)
    ]


def documents_of(frames):
    rows = frames.read("documents").collect()
    return sorted((row.channel, row.start_offset, row.xml) for row in rows)


def expected(rows):
    return sorted((*key, "".join(texts)) for key, texts in expected_documents(rows).items())


def test_any_cut_into_batches_gives_the_batch_result(spark, tmp_path):
    rows = random_rows(seed=31, channels=12, hot=200)
    source = str(tmp_path / "source")
    for part in parts_of(rows, 3):
        put(spark, source, as_messages(part))
    out = str(tmp_path / "out")
    query = frame_stream(
        stream_of(spark, source), out, str(tmp_path / "checkpoint"), trigger=None, block_size=16
    )
    drain(query)
    frames = StreamFrames(spark, out)
    assert frames.read("documents").select("batch_id").distinct().count() == 3
    assert documents_of(frames) == expected(rows)


def test_a_restart_in_the_middle_of_a_document_loses_nothing(spark, tmp_path):
    rows = [(1, 0, "START", ""), (1, 1, None, "<a>"), (1, 2, None, "</a>"), (1, 3, "END", "")]
    source, out, checkpoint = (str(tmp_path / name) for name in ("source", "out", "checkpoint"))
    frames = StreamFrames(spark, out)
    for part, count in [(rows[:2], 0), (rows[2:], 1)]:
        put(spark, source, as_messages(part))
        drain(frame_stream(stream_of(spark, source), out, checkpoint, trigger=None))
        assert frames.read("documents").count() == count
    assert documents_of(frames) == [(1, 0, "<a></a>")]


def _batch(spark, rows):
    return spark.createDataFrame(as_messages(rows), "channel long, offset long, value string")


def test_a_repeated_batch_overwrites_its_own_output(spark, tmp_path):
    frames = StreamFrames(spark, str(tmp_path))
    frames(_batch(spark, [(1, 0, "START", ""), (1, 1, None, "x")]), 0)
    last = _batch(spark, [(1, 2, None, "y"), (1, 3, "END", "")])
    frames(last, 1)
    frames(last, 1)
    assert documents_of(frames) == [(1, 0, "xy")]


def test_a_lost_state_is_an_error(spark, tmp_path):
    frames = StreamFrames(spark, str(tmp_path))
    try:
        frames(_batch(spark, [(1, 0, "END", "")]), 5)
    except ValueError as error:
        assert "no state" in str(error)
    else:
        raise AssertionError("a missing state went unnoticed")


def test_a_session_above_the_limit_leaves_line_by_line(spark, tmp_path):
    frames = StreamFrames(spark, str(tmp_path), max_document_bytes=8)
    frames(_batch(spark, [(1, 0, "START", ""), (1, 1, None, "aaaa"), (2, 0, "START", "")]), 0)
    frames(_batch(spark, [(1, 2, None, "bbbbb"), (2, 1, None, "ok")]), 1)
    state = spark.read.parquet(f"{tmp_path}/carry/batch_id=1")
    assert sorted((r.channel, r.offset, r.marker, r.start_batch) for r in state.collect()) == [
        (1, 0, "START", 0),
        (2, 0, "START", 0),
    ]
    frames(_batch(spark, [(1, 3, None, "c"), (1, 4, "END", ""), (2, 2, "END", "")]), 2)
    assert documents_of(frames) == [(2, 0, "ok")]
    big = frames.read("oversize").orderBy("offset").collect()
    assert [(row.offset, row.text) for row in big] == [(1, "aaaa"), (2, "bbbbb"), (3, "c")]
    closed = frames.read("sessions").orderBy("channel").collect()
    assert [(row.channel, row.is_complete) for row in closed] == [(1, True), (2, True)]


def test_lines_keep_their_session_across_batches(spark, tmp_path):
    frames = StreamFrames(spark, str(tmp_path))
    frames(_batch(spark, [(1, 0, None, "early"), (1, 1, "START", ""), (1, 2, None, "a")]), 0)
    frames(_batch(spark, [(1, 3, "END", ""), (1, 4, None, "after"), (2, 0, "END", "")]), 1)
    frames(_batch(spark, [(1, 5, None, "later"), (1, 6, "END", ""), (1, 7, "START", "")]), 2)
    rows = frames.read("lines").orderBy("channel", "offset").collect()
    assert [(r.offset, r.start_offset, r.phase) for r in rows] == [
        (0, None, "orphan"), (1, 1, "start"), (2, 1, "content"), (3, 1, "end"), (4, 1, "trailing"),
        (5, 1, "trailing"), (6, 1, "trailing"), (7, 7, "start"), (0, None, "orphan"),
    ]
    assert documents_of(frames) == [(1, 1, "a")]
    closed = frames.read("sessions").collect()
    assert [(r.start_offset, r.is_complete, r.end_offset) for r in closed] == [(1, True, 3)]


def test_superseded_sessions_and_rejects_are_reported(spark, tmp_path):
    frames = StreamFrames(spark, str(tmp_path))
    frames(_batch(spark, [(1, 0, "START", ""), (1, 1, None, "x"), (1, 2, "START", "")]), 0)
    sessions = frames.read("sessions").collect()
    assert [(row.start_offset, row.is_complete) for row in sessions] == [(0, False)]
    bare = spark.createDataFrame([(1, 3, "bare")], "channel long, offset long, value string")
    frames(bare, 1)
    rejects = frames.read("rejects").collect()
    assert [(row.message, row.reject_reason) for row in rejects] == [("bare", "no_envelope")]


def test_append_to_a_named_table_and_count(spark, tmp_path):
    source = str(tmp_path / "source")
    put(spark, source, as_messages([(1, 0, "START", ""), (1, 1, None, "x")]))
    lines = observe_sink(
        marked_lines(stream_of(spark, source)), "lines", F.col("marker").isNull()
    )
    report = SinkReport()
    spark.streams.addListener(report)
    try:
        sink = batch_writer(write_messages, str(tmp_path / "out"))
        drain(start_query(lines, sink, "lines", str(tmp_path / "c"), trigger=None))
        for _ in range(50):
            if "lines" in report.totals:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(report)
    assert report.totals["lines"] == {"n_accepted": 1, "n_rejected": 1}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_append_to_a_table_that_sql_can_read(spark, tmp_path):
    source = str(tmp_path / "source")
    put(spark, source, as_messages([(1, 0, "START", ""), (1, 1, None, "x")]))
    lines = marked_lines(stream_of(spark, source)).select("channel", "offset", "line")
    query = start_query(
        lines, "line_store", "store", str(tmp_path / "c"), trigger=None, format="table"
    )
    drain(query)
    found = spark.sql("SELECT line FROM line_store WHERE offset = 1").collect()
    assert [row.line for row in found] == ["x"]


def test_processing_time_trigger_and_lookup_by_name(spark, tmp_path):
    source = str(tmp_path / "source")
    put(spark, source, as_messages([(1, 0, "START", ""), (1, 1, None, "x")]))
    lines = marked_lines(stream_of(spark, source))
    query = start_query(lines, str(tmp_path / "out"), "timed", str(tmp_path / "c"))
    try:
        assert named_query(spark, "timed") is not None
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def _stateful(spark, tmp_path, parts, **options):
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    for part in parts:
        put(spark, source, as_messages(part))
        framed = frame_stateful(marked_lines(stream_of(spark, source)), **options)
        drain(start_query(framed, out, "stateful", str(tmp_path / "c"), trigger=None))
    return spark.read.parquet(out)


def test_stateful_framing_gives_the_batch_result(spark, tmp_path):
    rows = random_rows(seed=41, channels=12, hot=200)
    found = _stateful(spark, tmp_path, parts_of(rows, 3)).where("kind = 'document'").collect()
    assert sorted((r.channel, r.start_offset, r.xml) for r in found) == expected(rows)
    assert len({r.session_id for r in found}) == len(found)


def test_stateful_framing_reports_unclosed_and_cuts_large_sessions(spark, tmp_path):
    first = [(1, 0, "START", ""), (1, 1, None, "aaa"), (2, 0, None, "orphan"), (2, 1, "END", "")]
    second = [(1, 2, "START", ""), (1, 3, None, "bbbb"), (1, 1, None, "again")]
    third = [(1, 4, None, "cccc"), (1, 5, None, "d"), (1, 6, "END", ""), (1, 7, None, "late")]
    found = _stateful(spark, tmp_path, [first, second, third], max_document_bytes=8)
    sessions = found.where("kind IN ('unclosed', 'fragment')").orderBy("start_offset", "part")
    rows = sessions.collect()
    assert [(r.kind, r.start_offset, r.end_offset, r.part, r.n_lines, r.xml) for r in rows] == [
        ("unclosed", 0, None, 0, 0, None),
        ("fragment", 2, None, 0, 3, "bbbbccccd"),
        ("fragment", 2, 6, 1, 0, ""),
    ]
    others = found.where("kind IN ('outside', 'late')").orderBy("channel", "end_offset").collect()
    assert [(r.channel, r.kind, r.start_offset, r.end_offset, r.xml) for r in others] == [
        (1, "late", None, 1, "again"), (1, "outside", None, 7, "late"), (2, "outside", None, 0, "orphan")
    ]


def test_stateful_framing_in_a_session_with_the_default_state_store(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before, default = spark.conf.get(key), STATE_STORE.replace("RocksDB", "HDFSBacked")
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    put(spark, source, as_messages([(1, 0, "START", ""), (1, 1, None, "a"), (1, 2, "END", "")]))
    spark.conf.set(key, default)
    try:
        framed = frame_stateful(marked_lines(stream_of(spark, source)))
        drain(start_query(framed, out, "default", str(tmp_path / "c"), None, state_store=STATE_STORE))
        assert spark.conf.get(key) == default
    finally:
        spark.conf.set(key, before)
    assert [(r.kind, r.xml) for r in spark.read.parquet(out).collect()] == [("document", "a")]


class _State:
    """A value or a list in place of the state store."""

    def __init__(self):
        self.kept = None

    def exists(self):
        return self.kept is not None

    def get(self):
        return self.kept if self.kept is not None else []

    def update(self, value):
        self.kept = value

    def appendList(self, values):
        self.kept = [*self.get(), *values]

    def clear(self):
        self.kept = None


class _Clock:
    """Timers, and the time of a micro-batch."""

    def __init__(self):
        self.now, self.timers = 1_000, set()

    def getValueState(self, name, schema):
        return _State()

    getListState = getValueState

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getExpiryTimeInMs(self):
        return self.expired


def test_a_session_that_nothing_touches_expires_with_its_text():
    clock = _Clock()
    processor = FrameProcessor("", None, ttl_seconds=10)
    processor.init(clock)

    def batch(*rows, wait=5_000):
        clock.now += wait
        columns = ["offset", "marker", "text"]
        frame = pd.DataFrame(rows, columns=columns)
        frame["line_bytes"] = frame["text"].str.len().fillna(0)
        out = list(processor.handleInputRows((1,), iter([frame]), clock)) if rows else []
        for at in sorted(at for at in clock.timers if at <= clock.now):
            clock.timers.discard(at)
            clock.expired = at
            out += processor.handleExpiredTimer((1,), clock, clock)
        return [tuple(row[1:]) for frame in out for row in frame.itertuples(index=False)]

    assert batch((0, "START", None), (1, None, "a"), (2, None, "b")) == []
    assert batch((3, None, "c"), (3, None, "twice")) == [("late", None, 3, 0, 1, "twice")]
    assert batch(wait=9_000) == []  # the last line moved the end on
    assert batch(wait=1_000) == [("expired", 0, 3, 0, 3, "abc")]
    assert clock.timers == set() and processor.lines.kept is None
    assert batch((4, None, "d"), (5, "END", None), (2, None, "b")) == [
        ("late", None, 2, 0, 1, "b"), ("outside", None, 4, 0, 1, "d")
    ]
    assert batch((6, "START", None), (7, None, "e"), (8, "END", None)) == [
        ("document", 6, 8, 0, 1, "e")
    ]
    assert clock.timers == set()
