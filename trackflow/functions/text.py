"""Column expressions on message text.  All of them are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that frame a file in the message stream.
PROLOG = '<?xml version="1.0" encoding="UTF-8" ?>'
ENVELOPE_DELIMITER = '"text/plain"'
START_MARK = '"mark":"START"'
END_MARK = '"mark":"END"'
LITERAL_CLEAN_TEXT = "^([\\W]+)<"

# Every character the JVM counts as white space or as a Unicode space separator.
WHITESPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_whitespace(text: Column) -> Column:
    """Trim all Unicode white space; Spark's one-argument ``trim`` takes off U+0020 only."""
    return F.btrim(text, F.lit(WHITESPACE))


def payload_of(value: Column, delimiter: str = ENVELOPE_DELIMITER) -> Column:
    """Text between the first and the second delimiter, trimmed; NULL without a delimiter."""
    at = F.instr(value, delimiter)
    rest = F.substring(value, at + F.lit(len(delimiter)), F.lit(2**31 - 1))
    again = F.contains(rest, F.lit(delimiter))
    payload = F.when(again, F.substring_index(rest, delimiter, 1)).otherwise(rest)
    return F.when(at > 0, trim_whitespace(payload))


def marker_of(line: Column) -> Column:
    """``START``, ``END`` or NULL.  START wins when a line carries both."""
    return F.when(F.contains(line, F.lit(START_MARK)), F.lit("START")).when(
        F.contains(line, F.lit(END_MARK)), F.lit("END")
    )


def clean_line(line: Column, mode: str = "regex") -> Column:
    """Trim a line and drop the junk before its first tag.

    ``regex`` drops leading non-word characters in front of ``<``.  ``literal`` takes the
    pattern for plain text, which leaves every ordinary line as it is.
    """
    text = trim_whitespace(line)
    if mode == "regex":
        return F.regexp_replace(text, "^\\W+<", "<")
    if mode == "literal":
        at = F.instr(text, LITERAL_CLEAN_TEXT)
        replaced = F.overlay(text, F.lit("<"), at, F.lit(len(LITERAL_CLEAN_TEXT)))
        return F.when(at > 0, replaced).otherwise(text)
    raise ValueError(f"clean mode must be 'regex' or 'literal', not {mode!r}")


def session_id_of(channel: Column, start_offset: Column) -> Column:
    """Replay-safe id of the session opened at ``start_offset``; ``'null'`` before any START."""
    opened = F.md5(F.concat_ws(":", channel.cast("string"), start_offset.cast("string")))
    return F.when(start_offset.isNull(), F.lit("null")).otherwise(opened)


def utc_timestamp_ntz(text: Column) -> Column:
    """Parse an ISO time to its UTC wall clock, whatever the session time zone is.

    Text without a zone is taken as UTC; text that is no time gives NULL.
    """
    has_zone = F.rlike(text, F.lit("[0-9](Z|[+-][0-9]{2}:?[0-9]{2})$"))
    instant = F.unix_micros(text.try_cast("timestamp"))
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    shifted = epoch + F.make_dt_interval(secs=(instant / F.lit(1000000)).cast("decimal(18,6)"))
    return F.when(has_zone, shifted).otherwise(text.try_cast("timestamp_ntz"))
