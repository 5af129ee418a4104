"""SQL functions and views, all without Python code at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackflow.functions.text import END_MARK, ENVELOPE_DELIMITER, START_MARK, WHITESPACE


def _quote(text: str) -> str:
    escaped = "".join(c if 32 <= ord(c) < 127 else f"\\u{ord(c):04x}" for c in text)
    return "'" + escaped.replace("'", "\\'") + "'"


def _spread(cell: str) -> str:
    return f"CAST(conv(bin({cell}), 8, 10) AS BIGINT)"


def _cell(fraction: str) -> str:
    return f"least(greatest(CAST(floor(({fraction}) * 65536D) AS BIGINT), 0L), 65535L)"


def _function_bodies() -> dict[str, str]:
    white = _quote(WHITESPACE)
    delimiter = _quote(ENVELOPE_DELIMITER)
    year_start = "make_date(year(ts), 1, 1)"
    days = f"datediff(add_months({year_start}, 12), {year_start})"
    seconds = (
        f"(datediff(CAST(ts AS DATE), {year_start}) * 86400L"
        " + hour(ts) * 3600 + minute(ts) * 60 + second(ts))"
    )
    lon_cell = f"if(lon IS NULL, NULL, {_cell('(lon + 180D) / 360D')})"
    lat_cell = f"if(lat IS NULL, NULL, {_cell('(lat + 90D) / 180D')})"
    time_cell = f"CAST(({seconds} * 65536L) div ({days} * 86400L) AS BIGINT)"
    return {
        "strip_envelope(value STRING) RETURNS STRING": (
            f"CASE WHEN contains(value, {delimiter})"
            f" THEN btrim(split_part(value, {delimiter}, 2), {white}) END"
        ),
        "marker_of(line STRING) RETURNS STRING": (
            f"CASE WHEN contains(line, {_quote(START_MARK)}) THEN 'START'"
            f" WHEN contains(line, {_quote(END_MARK)}) THEN 'END' END"
        ),
        "clean_line(line STRING) RETURNS STRING": (
            f"regexp_replace(btrim(line, {white}), '^\\\\W+<', '<')"
        ),
        "st_key(lon DOUBLE, lat DOUBLE, ts TIMESTAMP_NTZ) RETURNS BIGINT": (
            f"{_spread(lon_cell)} | shiftleft({_spread(lat_cell)}, 1)"
            f" | shiftleft({_spread(time_cell)}, 2)"
        ),
    }


def register(spark: SparkSession) -> None:
    """Make ``strip_envelope``, ``marker_of``, ``clean_line`` and ``st_key`` callable in SQL."""
    for signature, body in _function_bodies().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


def register_views(spark: SparkSession, **views: DataFrame) -> None:
    """Name DataFrames for SQL text, such as ``session_lines`` or ``track_points``."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
