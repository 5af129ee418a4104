"""Documents: order, separators, size limits."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from test_framing import SCHEMA, model, random_rows
from trackflow.operators.assembly import (
    assemble,
    document_parts,
    document_stats,
    oversize_lines,
    repair_documents,
)
from trackflow.operators.framing import assign_sessions


def _lines(spark, texts, block_size=4):
    rows = [(1, 0, "START", "s"), *[(1, i + 1, None, t) for i, t in enumerate(texts)]]
    rows.append((1, len(texts) + 1, "END", "e"))
    return assign_sessions(spark.createDataFrame(rows, SCHEMA), block_size=block_size)


def expected_documents(rows):
    text = {row[:2]: row[3] for row in rows}
    marker = {row[:2]: row[2] for row in rows}
    content, ended = defaultdict(list), set()
    for channel, offset, session, start, phase, _ in model(rows):
        if phase == "end":
            ended.add((channel, start))
        if phase == "content" and marker[channel, offset] is None:
            content[channel, start].append(text[channel, offset])
    return {key: content[key] for key in ended}


@pytest.mark.parametrize("limit", [None, 30_000_000, 25])
def test_documents_equal_the_model(spark, limit):
    rows = random_rows(seed=21)
    expected = expected_documents(rows)
    lines = assign_sessions(spark.createDataFrame(rows, SCHEMA), block_size=16)
    documents = assemble(lines, "|", max_document_bytes=limit, block_size=16).collect()
    bound = limit or 10**9
    small = {k: v for k, v in expected.items() if sum(len(t) + 1 for t in v) <= bound}
    assert {(d.channel, d.start_offset): d.xml for d in documents} == {
        key: "|".join(texts) for key, texts in small.items()
    }
    if limit == 25:
        assert 0 < len(small) < len(expected)
        big = oversize_lines(lines, "|", max_document_bytes=limit, block_size=16).collect()
        assert sorted((r.channel, r.start_offset, r.text) for r in big) == sorted(
            (*key, text) for key, texts in expected.items() if key not in small for text in texts
        )


def test_lines_are_cleaned_and_glued(spark):
    lines = _lines(spark, [' ,"<a>', "\t<b/> ", "</a>"])
    assert assemble(lines).first().xml == "<a><b/></a>"
    assert assemble(lines, separator="\n").first().xml == "<a>\n<b/>\n</a>"
    assert assemble(lines, clean="literal").first().xml == ',"<a><b/></a>'


def test_content_after_the_first_end_is_left_out_and_emitted_once(spark):
    rows = [(1, 0, "START", "s"), (1, 1, None, "<a/>"), (1, 2, "END", "e"), (1, 3, None, "<b/>")]
    rows.append((1, 4, "END", "e"))
    documents = assemble(assign_sessions(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [(d.xml, d.end_offset, d.n_lines) for d in documents] == [("<a/>", 2, 1)]


def test_orphans_only_on_request(spark):
    rows = [(1, 0, None, "<a/>"), (1, 1, "END", "e"), (1, 2, None, "<b/>")]
    lines = assign_sessions(spark.createDataFrame(rows, SCHEMA))
    assert assemble(lines).count() == 0
    documents = assemble(lines, include_orphans=True).collect()
    assert [(d.session_id, d.xml) for d in documents] == [("null", "<a/>")]


def test_an_empty_session_gives_an_empty_document(spark):
    assert [(d.xml, d.n_lines) for d in assemble(_lines(spark, [])).collect()] == [("", 0)]


def test_an_open_session_of_any_size_gives_nothing(spark):
    rows = [(1, 0, "START", "s"), *[(1, i, None, "x" * 50) for i in range(1, 200)]]
    lines = assign_sessions(spark.createDataFrame(rows, SCHEMA), block_size=8)
    assert assemble(lines, max_document_bytes=100, block_size=8).count() == 0
    assert oversize_lines(lines, max_document_bytes=100, block_size=8).count() == 0


def test_frames_without_blocks_are_accepted(spark):
    rows = random_rows(seed=2, channels=5, hot=100)
    df = spark.createDataFrame(rows, SCHEMA)
    plain = assemble(assign_sessions(df, block_size=None))
    assert plain.exceptAll(assemble(assign_sessions(df))).count() == 0
    assert plain.count() == len(expected_documents(rows))


def test_parts_join_to_the_documents(spark):
    rows = random_rows(seed=21)
    lines = assign_sessions(spark.createDataFrame(rows, SCHEMA), block_size=5)
    parts = defaultdict(list)
    for row in document_parts(lines, "|", block_size=5).collect():
        assert row.part >= 0 and row.n_lines <= 5
        parts[row.channel, row.start_offset].append((row.part, row.text))
    joined = {key: "|".join(text for _, text in sorted(found)) for key, found in parts.items()}
    expected = {key: "|".join(texts) for key, texts in expected_documents(rows).items() if texts}
    assert joined == expected


def test_a_session_of_a_million_blank_lines(spark):
    lines = spark.range(1_000_002).select(
        F.lit(1).cast("long").alias("channel"),
        F.col("id").alias("offset"),
        F.when(F.col("id") == 0, "START").when(F.col("id") == 1_000_001, "END").alias("marker"),
        F.lit(" ").alias("line"),
    )
    document = assemble(assign_sessions(lines), separator="\n").first()
    assert document.n_lines == 1_000_000 and document.xml == "\n" * 999_999


def test_a_document_of_a_hundred_megabytes(spark):
    lines = spark.range(100_002).select(
        F.lit(1).cast("long").alias("channel"),
        F.col("id").alias("offset"),
        F.when(F.col("id") == 0, "START").when(F.col("id") == 100_001, "END").alias("marker"),
        F.concat(F.lit("<"), F.lpad(F.col("id").cast("string"), 999, "x")).alias("line"),
    )
    framed = assign_sessions(lines, block_size=4_096)
    document = assemble(framed, block_size=4_096).select(
        "n_lines", F.length("xml"), F.substring("xml", 1, 1000), F.substring("xml", -5, 5)
    )
    assert tuple(document.first()) == (100_000, 10**8, "<" + "1".rjust(999, "x"), "00000")
    parts = document_parts(framed, block_size=4_096)
    assert parts.count() == 25 and parts.agg(F.sum(F.length("text"))).first()[0] == 10**8


def test_token_repair_keeps_the_length(spark):
    documents = assemble(_lines(spark, ["<a>AUTOMATIC ESTIMATED</a>", "<b>AUTOMATIC ESTIMATED</b>"]))
    assert repair_documents(documents).first().xml == (
        "<a>AUTOMATIC_ESTIMATED</a><b>AUTOMATIC_ESTIMATED</b>"
    )
    stats = document_stats(documents).first()
    assert stats.n_chars_in == stats.n_chars_out == 52
