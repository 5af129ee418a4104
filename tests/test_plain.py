"""Messages read by patterns give what the parser gives, and odd ones go to the parser."""

import pytest
from pyspark.sql import functions as F

from trackflow.functions import plain
from trackflow.functions.xml import HEADER_FIELDS, HEADER_SCHEMA, POINT_FIELDS, TRACK_SCHEMA
from trackflow.operators.assembly import repair_documents
from trackflow.operators.features import track_points
from trackflow.operators.normalize import split_valid
from trackflow.operators.parsing import parse_messages
from trackflow.plans.tracks import (
    message_points,
    normalized_messages,
    rejected_messages,
    valid_documents,
)

PLACE = "<latitude>{}</latitude><longitude>2.5</longitude><elevation>3</elevation>"


def point(uuid="p", local=False, without=None, comment="c"):
    texts = {name: "1" for name in POINT_FIELDS} | {
        "trackItemUUID": uuid,
        "trackItemSecurity": "<level>A</level>",
        "trackItemTime": "1996-01-02T03:04:05",
        "trackItemComment": comment,
        "trackPointPosition": PLACE.format(7),
        "trackPointSource": "AUTOMATIC ESTIMATED",
    }
    leaves = "".join(f"<{n}>{t}</{n}>" for n, t in texts.items() if n != without)
    place = f'"GeodeticPosition">{PLACE.format(1)}'
    if local:
        place = '"LocalCartesianPosition"><x>1</x><y>2</y><z>3</z><localSystem><origin>'
        place += f"{PLACE.format(2)}</origin></localSystem>"
    return (
        f'<items type="TrackPoint">{leaves}<TrackPointDetail>'
        "<pointDetailVelocity><vx>1</vx></pointDetailVelocity>"
        "<pointDetailCovarianceMatrix><c>0</c></pointDetailCovarianceMatrix>"
        f"<pointDetailPosition type={place}</pointDetailPosition></TrackPointDetail></items>"
    )


def message(*items, tail=""):
    header = "".join(f"<{name}>{name}</{name}>" for name in HEADER_FIELDS)
    return (
        f'<TrackMessage version="1">{header}<tracks><trackUUID>t</trackUUID>{"".join(items)}'
        f"</tracks></TrackMessage>{tail}"
    )


VIDEO = '<items type="VideoInformation"><frame>1</frame></items>'
NOTE = '<items type="TrackObject"><note>n</note></items>'
PLAIN = [message(point()), message(VIDEO, NOTE, point("a"), point("b", local=True, comment=""))]
LACKING = [message(point(), point(without="trackPointCourse")), message(point(without="trackItemTime"))]
ODD = [
    None, "", "<TrackMessage/>", message(), message(point(comment="&amp;")),
    message(point(comment="&")), message(point(comment=" c ")), message(point(comment="\x02")),
    message(point(comment="é")), message(point(comment="]]>")), message(point(), "x", point()),
    message(point(), tail="<!-- <TrackMessage> -->"), message(point(), tail="\n"),
    message(point(), tail=message(point())), message(point())[:-1], message("\x02", point()),
    message(point(comment="<!-- c -->")), message(point() + "</tracks><tracks>" + point()),
    message(point(comment="<![CDATA[c]]>")), message("<items/>", point()),
    message(point(without="trackPointPosition")),
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(str(i), text) for i, text in enumerate(PLAIN + LACKING + ODD)]
    return spark.createDataFrame(rows, "message_id string, xml string").cache()


def rows_of(df, columns=None):
    return sorted(map(repr, df.select(*(columns or df.columns)).collect()))


def test_plain_is_what_the_patterns_know(texts):
    xml = F.col("xml")
    found = repair_documents(texts).select(
        F.col("message_id").cast("int").alias("i"), plain.is_plain(xml), plain.is_plain(xml, True)
    ).orderBy("i").collect()
    n = len(PLAIN)
    assert [row[1] for row in found] == [i < n for i in range(len(found))]
    assert [row[2] for row in found] == [i < n + len(LACKING) for i in range(len(found))]


def test_points_are_those_of_the_parser(texts):
    parsed = track_points(normalized_messages(texts, raw=False))
    found = message_points(texts)
    assert found.dtypes == parsed.dtypes
    assert rows_of(found) == rows_of(parsed) and found.count() > 8


def test_valid_and_rejected_are_those_of_the_parser(texts):
    valid, rejected = split_valid(parse_messages(repair_documents(texts)))
    assert rows_of(valid_documents(texts)) == rows_of(valid, ["message_id", "xml"])
    assert rows_of(rejected_messages(texts)) == rows_of(rejected.drop("msg", "parse_error"))


def test_the_header_schema_rejects_the_same_messages(texts):
    def headers(schema):
        fields = [F.col("msg")[name].alias(name) for name in HEADER_FIELDS]
        return parse_messages(texts, schema).select("message_id", "parse_error", *fields)

    assert rows_of(headers(HEADER_SCHEMA)) == rows_of(headers(TRACK_SCHEMA))
