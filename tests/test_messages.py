"""Envelope, prolog, markers, cleaning."""

from pyspark.sql import functions as F

from trackflow.functions.text import PROLOG, clean_line, trim_whitespace
from trackflow.operators.messages import (
    accepted_lines,
    decode_value,
    drop_prolog,
    envelope_rejects,
    mark_lines,
    strip_envelope,
)
from trackflow.sources.raw import kafka_messages, raw_entries, read_raw

SCHEMA = "channel string, offset long, value string"


def _frame(spark, *values):
    rows = [("c", i, value) for i, value in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def _lines(df):
    return [row.line for row in strip_envelope(df).orderBy("offset").collect()]


def test_only_the_exact_prolog_is_dropped(spark):
    other = '<?xml version="1.0" encoding="UTF-8"?>'
    df = _frame(spark, f'x"text/plain"{PROLOG}', f'x"text/plain"{other}', None)
    assert [row.offset for row in drop_prolog(df).orderBy("offset").collect()] == [1, 2]


def test_envelope_takes_the_text_between_the_first_two_delimiters(spark):
    df = _frame(spark, 'h"text/plain" <a/> "text/plain"rest', 'h"text/plain"', '"text/plain"x')
    assert _lines(df) == ["<a/>", "", "x"]


def test_rows_without_envelope_value_or_position_are_kept_apart(spark):
    good = 'h"text/plain"x'
    rows = [("c", 0, "bare"), ("c", 1, None), (None, 2, good), ("c", 3, good)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = envelope_rejects(df).collect()
    rejects = {row.offset: (row.reject_reason, row.message) for row in found}
    assert rejects == {
        0: ("no_envelope", "bare"),
        1: ("null_value", None),
        2: ("no_position", 'h"text/plain"x'),
    }
    assert [row.offset for row in accepted_lines(df).collect()] == [3]


def test_start_wins_over_end(spark):
    lines = ['{"mark":"START"}', '{"mark":"END"}', '{"mark":"END","mark":"START"}']
    lines.append('{"mark": "END"}')
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    assert [row.marker for row in mark_lines(df).collect()] == ["START", "END", "START", None]


def test_trim_takes_every_unicode_space(spark):
    spaces = "\t\n\x0b\f\r\x1c\x1f         　"
    df = spark.createDataFrame([(spaces + "a  b" + spaces,)], "line string")
    assert df.select(trim_whitespace(F.col("line"))).first()[0] == "a  b"


def test_clean_modes(spark):
    lines = [' ,"<a><b>', "é<a>", "x<a>", "</a>", "^([\\W]+)<a"]
    df = spark.createDataFrame([(line,) for line in lines], "line string")

    def clean(mode):
        return [row[0] for row in df.select(clean_line(F.col("line"), mode)).collect()]

    assert clean("regex") == ["<a><b>", "<a>", "x<a>", "</a>", "^([\\W]+)<a"]
    assert clean("literal") == [',"<a><b>', "é<a>", "x<a>", "</a>", "<a"]


def test_binary_payload_is_decoded(spark):
    df = _frame(spark, "hé").withColumn("value", F.col("value").cast("binary"))
    assert decode_value(df).first().value == "hé"


def test_kafka_columns_keep_partition_and_offset(spark):
    df = spark.createDataFrame(
        [("raw", 3, 7, b"x")], "topic string, partition int, offset long, value binary"
    )
    assert kafka_messages(df).first()[:2] == ("raw-3", 7)


def test_read_raw_reads_files(spark, tmp_path):
    _frame(spark, "a", "b").write.json(str(tmp_path / "raw"))
    df = read_raw(spark, "json", str(tmp_path / "raw"), schema=SCHEMA)
    assert sorted(row.value for row in df.collect()) == ["a", "b"]


def test_raw_entries_are_replay_safe(spark):
    df = _frame(spark, "a", "b")
    assert raw_entries(df.unionByName(df)).count() == 2
