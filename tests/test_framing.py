"""Sessions against a plain Python model, and one case per decision."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from trackflow.operators import framing
from trackflow.operators.framing import assign_sessions, assign_sessions_blocked, session_status

SCHEMA = "channel long, offset long, marker string, line string"
COLUMNS = ["channel", "offset", "session_id", "start_offset", "phase", "closed"]


def model(rows):
    """Read the lines of each channel in order, as a single reader would."""
    state, result = {}, []
    for channel, offset, marker, _ in sorted(rows, key=lambda row: row[:2]):
        start, ended = state.get(channel, (None, False))
        if marker == "START":
            start, ended, phase = offset, False, "start"
        elif start is None:
            phase = "orphan"
        elif ended:
            phase = "trailing"
        else:
            phase = "end" if marker == "END" else "content"
        opened = hashlib.md5(f"{channel}:{start}".encode()).hexdigest()
        session = "null" if start is None else opened
        result.append((channel, offset, session, start, phase, ended))
        state[channel] = (start, ended or marker == "END")
    return result


def random_rows(seed, channels=40, hot=800):
    """Many short channels and one that holds about a third of all lines."""
    rng = random.Random(seed)
    rows = []
    for channel in range(channels):
        offset = rng.randrange(50)
        for _ in range(hot if channel == 0 else rng.randrange(80)):
            offset += rng.choice([1, 1, 1, 2, 9])
            marker = rng.choice(["START", "END", None, None, None, None])
            rows.append((channel, offset, marker, f"line{offset}"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_size", [None, 1, 7, 64, 1_000_000])
def test_sessions_equal_the_model(spark, block_size):
    rows = random_rows(seed=3)
    lines = assign_sessions(spark.createDataFrame(rows, SCHEMA), block_size=block_size)
    actual = sorted((tuple(row) for row in lines.select(*COLUMNS).collect()), key=lambda r: r[:2])
    assert actual == model(rows)


def _phases(spark, *markers):
    rows = [(1, i, marker, "x") for i, marker in enumerate(markers)]
    lines = assign_sessions(spark.createDataFrame(rows, SCHEMA))
    return lines


def test_lines_after_end_keep_the_id_but_trail(spark):
    rows = _phases(spark, "START", None, "END", None, "END").orderBy("offset").collect()
    assert [row.phase for row in rows] == ["start", "content", "end", "trailing", "trailing"]
    assert len({row.session_id for row in rows}) == 1


def test_lines_before_start_are_orphans(spark):
    lines = _phases(spark, None, "END", "START")
    rows = lines.orderBy("offset").collect()
    assert [(row.session_id == "null", row.phase) for row in rows] == [
        (True, "orphan"),
        (True, "orphan"),
        (False, "start"),
    ]
    status = session_status(lines)
    assert framing.completed_sessions(status).count() == 0
    assert framing.completed_sessions(status, include_orphans=True).count() == 1


def test_start_after_start_leaves_the_first_unclosed(spark):
    status = session_status(_phases(spark, "START", None, "START", None, "END"))
    unclosed = framing.unclosed_sessions(status).collect()
    assert [(row.start_offset, row.n_lines) for row in unclosed] == [(0, 1)]


def test_ids_do_not_depend_on_partitions_or_replays(spark):
    df = spark.createDataFrame(random_rows(seed=5), SCHEMA)
    first = assign_sessions(df.repartition(1)).select(*COLUMNS)
    second = assign_sessions(df.repartition(13)).select(*COLUMNS)
    assert first.exceptAll(second).count() == 0


def test_other_column_names(spark):
    rows = [(1, 0, "START"), (1, 1, None)]
    df = spark.createDataFrame(rows, "part long, pos long, marker string")
    lines = assign_sessions_blocked(df, 10, channel="part", order="pos")
    assert [row.start_offset for row in lines.collect()] == [0, 0]


def test_open_flag_marks_the_last_unended_session(spark):
    rows = [(1, 0, "START", "x"), (1, 1, "END", "x"), (1, 2, "START", "x"), (1, 3, None, "x")]
    rows += [(2, 0, "START", "x"), (2, 1, "END", "x"), (3, 0, None, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    lines = assign_sessions_blocked(df, 2, keep_open_flag=True)
    assert sorted((r.channel, r.offset) for r in lines.where("is_open").collect()) == [
        (1, 2),
        (1, 3),
    ]


def test_status_upsert_and_delete(spark):
    schema = "id string, value boolean, deleted boolean, seq long"
    current = spark.createDataFrame([("a", False, False, 1), ("b", False, False, 1)], schema)
    changes = spark.createDataFrame(
        [("a", True, False, 2), ("a", False, False, 1), ("b", True, True, 3), ("c", False, False, 1)],
        schema,
    )
    stored = framing.apply_status(current, changes, ["id"])
    for table in (stored, framing.apply_status(stored, current, ["id"])):  # old changes again
        rows = framing.live_status(table).orderBy("id").collect()
        assert [(row.id, row.value) for row in rows] == [("a", True), ("c", False)]


def test_of_changes_with_equal_seq_the_deletion_wins(spark):
    schema = "id string, value boolean, deleted boolean, seq bigint"
    one = spark.createDataFrame([("a", True, False, 1)], schema)
    two = spark.createDataFrame([("a", False, True, 1)], schema)
    assert framing.live_status(framing.apply_status(one, two, ["id"])).isEmpty()
    assert framing.live_status(framing.apply_status(two, one, ["id"])).isEmpty()


def test_semi_join_gives_the_lines_of_listed_sessions(spark):
    lines = assign_sessions(spark.createDataFrame(random_rows(seed=9), SCHEMA))
    ids = session_status(lines).where("channel % 2 = 0").select("channel", "session_id")
    found = framing.session_lines_for(lines, ids)
    assert found.count() == lines.where(F.col("channel") % 2 == 0).count()
