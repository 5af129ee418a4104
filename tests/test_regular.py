"""Regular messages cut into tiles give what the parser and the cut into nodes give."""

import pytest
from pyspark.sql import functions as F

from test_plain import LACKING, NOTE, ODD, PLAIN, VIDEO, message, point, rows_of
from trackflow.functions import regular
from trackflow.functions.xml import CORRUPT
from trackflow.operators import rewrite
from trackflow.operators.assembly import repair_documents
from trackflow.operators.features import message_items, track_points
from trackflow.operators.normalize import split_valid
from trackflow.operators.parsing import json_documents, parse_messages, parsed_only, whole_json
from trackflow.operators.sinks import write_documents
from trackflow.plans.documents import staged
from trackflow.plans.tracks import (
    message_points,
    normalized_messages,
    routed_items,
    valid_documents,
    valid_messages,
)


def rich(text):
    """A message with much that no schema names."""
    for plain, other in {
        "<tracks>": '<tracks n="1"><!-- <items type="x"> --><state a="&lt;">s &amp;</state>',
        "</longitude>": "</longitude><datum name='\"8\"'>é &amp; <b/></datum>",
        "<trackItemComment>": '<trackItemComment lang="x"> <![CDATA[<a> & ]]>&amp; ',
        "<note>": '<note k="1 > 0"><![CDATA[</items>]]>',
        "</note>": '</note><items type="TrackPoint"><items>q</items></items>',
        "</tracks>": '<last a="1"/></tracks>',
        "<TrackPointDetail>": "<!-- - --><extra/><TrackPointDetail><extra>1</extra>",
    }.items():
        text = text.replace(plain, other)
    return text


REGULAR = [
    rich(text) for text in (*PLAIN, message(VIDEO, point("a"), NOTE, point("b", local=True), VIDEO))
] + [message(point(comment=c)) for c in ("&amp;lt;", "<![CDATA[ ]]>x ", " c", "é")]
INCOMPLETE = [rich(text) for text in LACKING]
OTHERS = [
    rich(PLAIN[0]).replace("<state", '<state b="1"'), rich(PLAIN[0]).replace("&lt;", "&no;"),
    rich(PLAIN[0]).replace("</state>", "</State>"), rich(PLAIN[0]).replace("<b/>", "<b>"),
    rich(PLAIN[0]).replace("<state", '<state type="t"'), rich(PLAIN[1]).replace("<b/>", "]]>"),
    rich(PLAIN[0]).replace("<b/>", "<!-- -- -->"), rich(PLAIN[0]).replace("<b/>", "<a><b><c/></b></a>"),
    rich(PLAIN[0]).replace("<last", "<TrackMessage"), rich(PLAIN[0]).replace("<last", "<trackUUID"),
    rich(PLAIN[0]).replace("<b/>", "\x02"), rich(PLAIN[0]).replace("<b/>", "\U0001f600\n"),
    message(point(comment="a > b")), rich(PLAIN[0]) + "\n", rich(PLAIN[0])[:-1], rich(PLAIN[0]) + "\x04", message(),
    rich(message(point(), "<items/>")), rich(message(point(), '<items type="x"></items>')),
]


@pytest.fixture(scope="module")
def texts(spark):
    every = [*PLAIN, *REGULAR, *INCOMPLETE, *OTHERS, *ODD]
    rows = [(str(i), text) for i, text in enumerate(every)]
    return spark.createDataFrame(rows, "message_id string, xml string").cache()


def test_regular_is_what_the_patterns_know(texts):
    xml = F.col("xml")
    found = repair_documents(texts).select(
        F.col("message_id").cast("int").alias("i"),
        regular.is_regular(xml).alias("whole"), regular.is_regular(xml, True).alias("some"),
        regular.normal_form(xml).isNotNull().alias("tiled"),
    ).orderBy("i").collect()
    n = len(PLAIN) + len(REGULAR)
    n_others = n + len(INCOMPLETE) + len(OTHERS)
    assert [r.whole for r in found][:n_others] == [i < n for i in range(n_others)]
    assert [r.some for r in found][:n_others] == [i < n + len(INCOMPLETE) for i in range(n_others)]
    assert [r.tiled for r in found] == [r.whole for r in found]


def test_valid_documents_are_those_of_the_parser(texts):
    valid, _ = split_valid(parse_messages(repair_documents(texts)))
    assert rows_of(valid_documents(texts)) == rows_of(valid, ["message_id", "xml"])


def test_points_and_items_are_those_of_the_parser(texts):
    parsed = track_points(normalized_messages(texts, raw=False))
    found = message_points(texts)
    assert found.dtypes == parsed.dtypes
    assert rows_of(found) == rows_of(parsed)
    keys = ["message_id", "track_idx", "track_uuid", "item_idx"]
    item = [F.col(f"item.{name}") for name in ("_type", "raw", "item_no")]
    items = message_items(normalized_messages(texts))
    assert rows_of(routed_items(texts), keys + item) == rows_of(items, keys + item)


def test_tiles_are_written_as_nodes_are(texts):
    """A line break at the end leaves the message as it is, but it is cut into nodes then."""
    names = ["message_id", "headers", "tracks"]
    valid = valid_messages(texts)
    nodes = valid.withColumn("xml", F.concat("xml", F.lit("\n")))
    assert rows_of(rewrite.rewrite(valid), names) == rows_of(rewrite.rewrite(nodes), names)
    xml = ["message_id", "track_xml"]
    written = rewrite.to_track_xml(valid_documents(texts))
    assert rows_of(written, xml) == rows_of(rewrite.to_track_xml(nodes), xml)


def test_json_is_that_of_parsed_messages(texts):
    parsed = parsed_only(parse_messages(texts, f"{CORRUPT} string"))
    whole = [F.md5("message_id").alias("doc_id"), whole_json(F.col("xml")).alias("json")]
    found = json_documents(texts, ["message_id"])
    assert rows_of(found) == rows_of(parsed, whole) and found.count() > len(REGULAR)


def test_json_files_and_staged_lines_are_small(spark, texts, tmp_path):
    documents = json_documents(texts, ["message_id"])
    write_documents(documents, str(tmp_path / "documents"))
    assert {p.suffix for p in (tmp_path / "documents").glob("part-*")} == {".gz"}
    stored = spark.read.schema("doc_id string, body string").json(str(tmp_path / "documents"))
    assert rows_of(stored) == rows_of(documents.withColumnRenamed("json", "body"))
    lines = staged(texts)
    assert all(path.endswith(".zstd.parquet") for path in lines.inputFiles())
    assert rows_of(lines) == rows_of(texts)


@pytest.mark.parametrize("parsed", [routed_items, message_points, valid_documents])
def test_no_regular_message_is_parsed(spark, monkeypatch, parsed):
    """Messages that are neither plain nor regular are the only ones with a text to parse."""
    seen = []
    from trackflow.plans import tracks

    def parse(documents, *schema):
        seen.append(documents)
        return parse_messages(documents, *schema)

    monkeypatch.setattr(tracks, "parse_messages", parse)
    known = spark.createDataFrame([(text,) for text in REGULAR + INCOMPLETE], "xml string")
    parsed(known.withColumn("message_id", F.lit("m"))).collect()
    assert [df.where("xml IS NOT NULL").count() for df in seen] == [0]
