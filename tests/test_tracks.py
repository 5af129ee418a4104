"""Parsing, normalisation, rejection and features of hand-written messages."""

import datetime
import hashlib
import json
from xml.etree import ElementTree

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from trackflow.functions import nodes
from trackflow.functions.spacetime import spread, st_key, year_cell
from trackflow.functions.text import utc_timestamp_ntz
from trackflow.functions.xml import POINT_FIELDS
from trackflow.operators.features import message_items, st_index, track_points
from trackflow.operators.normalize import normalize, split_valid
from trackflow.operators import parsing
from trackflow.operators.parsing import (
    concat_json,
    infer_schema,
    json_documents,
    parse_messages,
    to_documents,
)
from trackflow.operators.rewrite import rewrite, to_track_xml, track_children
from trackflow.plans import outputs
from trackflow.plans.outputs import tagged_outputs

POSITION = "<latitude>1.5</latitude><longitude>2.5</longitude><elevation>3</elevation>"
GEODETIC = f'<pointDetailPosition type="GeodeticPosition">{POSITION}</pointDetailPosition>'
LOCAL = (
    '<pointDetailPosition type="LocalCartesianPosition"><x>1</x><y>2</y><z>3</z>'
    f"<localSystem><origin>{POSITION}</origin></localSystem></pointDetailPosition>"
)


def point(position=GEODETIC, without=(), **texts):
    leaves = "".join(
        f"<{name}>{POSITION if name == 'trackPointPosition' else texts.get(name, '1')}</{name}>"
        for name in POINT_FIELDS
        if name not in without
    )
    detail = {
        "pointDetailVelocity": "<pointDetailVelocity><vx>1</vx></pointDetailVelocity>",
        "pointDetailCovarianceMatrix": "<pointDetailCovarianceMatrix/>",
        "pointDetailPosition": position,
    }
    inner = "".join(xml for name, xml in detail.items() if name not in without)
    if "TrackPointDetail" not in without:
        leaves += f"<TrackPointDetail>{inner}</TrackPointDetail>"
    return f'<items type="TrackPoint">{leaves}<extra>9</extra></items>'


def message(*items, header="<senderId>s</senderId>", track="<trackUUID>t</trackUUID>"):
    body = "".join(items)
    return f'<TrackMessage v="1">{header}<tracks a="1">{track}{body}</tracks></TrackMessage>'


def parsed(spark, *texts):
    rows = [(str(i), text) for i, text in enumerate(texts)]
    return parse_messages(spark.createDataFrame(rows, "message_id string, xml string"))


def reasons(spark, *texts):
    _, rejected = split_valid(parsed(spark, *texts))
    return {row.message_id: row.reject_reason for row in rejected.collect()}


def normalized(spark, *texts):
    return normalize(split_valid(parsed(spark, *texts))[0])


def items_of(spark, *texts):
    return [row.item for row in message_items(normalized(spark, *texts)).collect()]


def test_documents_without_one_message_are_rejected(spark):
    good = message(point())
    assert reasons(spark, good, good[:-3], "", "text", None, good + good, "<other/>") == {
        "1": "malformed_xml",
        "2": "malformed_xml",
        "3": "malformed_xml",
        "4": "null_document",
        "5": "not_one_message",
        "6": "not_one_message",
    }


@pytest.mark.parametrize(
    "name",
    [
        *POINT_FIELDS,
        "TrackPointDetail",
        "pointDetailVelocity",
        "pointDetailCovarianceMatrix",
        "pointDetailPosition",
    ],
)
def test_one_missing_child_rejects_the_whole_message(spark, name):
    bad = message(point(), point(without=[name]))
    assert reasons(spark, bad, message(point())) == {"0": f"missing_child:{name}"}


def test_local_positions_need_their_origin(spark):
    no_system = LOCAL[: LOCAL.index("<localSystem>")] + "</pointDetailPosition>"
    no_origin = LOCAL.replace(f"<origin>{POSITION}</origin>", "<scale>1</scale>")
    texts = [message(point(position)) for position in (no_system, no_origin, LOCAL)]
    found = reasons(spark, *texts)
    assert found == {"0": "missing_child:localSystem", "1": "missing_child:origin"}


def test_an_empty_child_is_present(spark):
    assert reasons(spark, message(point(trackItemComment="", trackPointCourse=""))) == {}


def test_missing_children_of_other_items_do_not_matter(spark):
    assert reasons(spark, message('<items type="TrackObject"/>', "<items/>")) == {}


def test_header_keeps_four_fields_and_repeats(spark):
    header = "<senderId>a</senderId><junk/><senderId>b</senderId><stanagVersion>3</stanagVersion>"
    df = normalized(spark, message(header=header))
    names = df.schema["msg"].dataType.names
    assert names == ["messageSecurity", "msgCreatedTime", "stanagVersion", "senderId", "tracks"]
    msg = df.first().msg
    assert (msg.senderId, msg.stanagVersion, msg.messageSecurity) == (["a", "b"], ["3"], None)


def test_items_are_routed_by_type(spark):
    video = '<items type="VideoInformation"><f/></items>'
    other = '<items type="TrackObject"><a k="v">1</a></items>'
    untyped = "<items><b>2</b></items>"
    items = items_of(spark, message(video, point(), other, untyped))
    assert [item._type for item in items] == ["TrackPoint", "TrackObject", None]
    assert [item.raw for item in items] == [None, '<a k="v">1</a>', "<b>2</b>"]
    assert [item.trackItemUUID for item in items] == ["1", None, None]


def test_raw_text_belongs_to_its_item_in_every_track(spark):
    first = '<tracks><items type="A"><n>1</n></items></tracks>'
    second = '<tracks><items type="VideoInformation"/><items type="B"><n>2</n></items></tracks>'
    items = items_of(spark, f"<TrackMessage>{first}{second}</TrackMessage>")
    assert [(item._type, item.raw) for item in items] == [("A", "<n>1</n>"), ("B", "<n>2</n>")]


def test_local_positions_become_their_origin(spark):
    local, geodetic = items_of(spark, message(point(LOCAL), point()))
    position = local.TrackPointDetail.pointDetailPosition
    assert (position._type, position.latitude, position.x) == ("GeodeticPosition", "1.5", None)
    assert position.localSystem is None
    assert (local.position_is_origin, geodetic.position_is_origin) == (True, False)


def test_features_are_typed_and_bad_text_gives_null(spark):
    df = normalized(
        spark,
        message(point(trackItemTime="2024-02-29T10:00:00Z", trackPointSpeed="7.5")),
        message(point(trackItemTime="never", trackPointSpeed="fast")),
    )
    good, bad = track_points(df).orderBy("message_id").collect()
    assert (good.time, good.speed) == (datetime.datetime(2024, 2, 29, 10), 7.5)
    assert (good.lat, good.lon, good.elev) == (1.5, 2.5, 3.0)
    assert (bad.time, bad.speed, bad.lat) == (None, None, 1.5)
    keyed = st_index(track_points(df)).orderBy("message_id").collect()
    assert keyed[0].time_bin == 2024 and keyed[0].st_key > 0
    assert keyed[1].time_bin is None and keyed[1].st_key is None


def test_times_are_utc_in_any_session_zone(spark):
    texts = ["2024-01-01T00:00:00", "2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00.5Z"]
    texts += ["x", None]
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, t string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = df.select("i", utc_timestamp_ntz(F.col("t")).alias("t")).orderBy("i").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    new_year = datetime.datetime(2024, 1, 1)
    half = new_year.replace(microsecond=500000)
    assert [row.t for row in times] == [new_year, new_year, half, None, None]


def test_spread_equals_bit_by_bit(spark):
    df = spark.range(65536).select("id", spread(F.col("id")).alias("s"))
    for row in df.where("id % 251 = 0 OR id > 65500").collect():
        assert row.s == sum(((row.id >> bit) & 1) << (3 * bit) for bit in range(16))


def test_key_is_clamped_and_orders_the_corners(spark):
    df = spark.createDataFrame(
        [(-180.0, -90.0), (180.0, 90.0), (999.0, -999.0)], "lon double, lat double"
    ).withColumn("t", F.lit("2023-01-01").cast("timestamp_ntz"))
    keys = [row[0] for row in df.select(st_key(F.col("lon"), F.col("lat"), F.col("t"))).collect()]
    ones = sum(1 << (3 * bit) for bit in range(16))
    assert keys == [0, ones | ones << 1, ones]
    last = F.lit("2024-12-31 23:59:59").cast("timestamp_ntz")
    assert spark.range(1).select(year_cell(last)).first()[0] == 65535


def tree(node):
    """An element with its attributes, text and children; comments are not there."""
    return (
        node.tag, sorted(node.attrib.items()), node.text or "", node.tail or "",
        [tree(child) for child in node],
    )


ODD_CONTENT = [
    '<other k="1"><q>2 &amp; 3</q></other>',
    "<o a='x > \"y\"' b=\"it's\"/>",
    "<o><![CDATA[</tracks><items type=\"TrackPoint\">]]></o>",
    "<o>&lt;items&gt;<items><items type='a'>n</items></items></o>",
    "<!-- <items type='TrackPoint'> --><o type='VideoInformation'>\n <p/>\t</o>",
    "<?tool <x> ?><o>mixed <b>text</b> tail<b/></o>",
    "<itemsMore>1</itemsMore><o xmlns:n='u'><n:a n:type='x'>é😀</n:a></o>",
]


@pytest.mark.parametrize("content", ODD_CONTENT)
def test_written_xml_is_the_tree_of_the_message(spark, content):
    extra = POSITION + content
    local = LOCAL.replace(f"<origin>{POSITION}</origin>", f"<origin>{extra}</origin>")
    item = f'<items k="v" type="TrackObject">{content}</items>'
    comment = "a &amp; b &lt; c<![CDATA[</items>]]>"
    text = message(
        point(local, trackItemComment=comment), '<items type="VideoInformation" k="0"/>', item,
        point(without=[]), header='<senderId a="&quot;">b</senderId><x/><messageSecurity/>',
        track=content + "<trackUUID>t</trackUUID>",
    )
    written = to_track_xml(split_valid(parsed(spark, "<?xml version='1.0'?>\n" + text))[0])
    before = ElementTree.fromstring(text)
    track = before.find("tracks")
    track.attrib.clear()
    for found in list(track):
        if found.tag == "items" and found.get("type") == "VideoInformation":
            track.remove(found)
    for found in track.findall("items[@type='TrackPoint']"):
        found.remove(found.find("extra"))
        position = found.find("TrackPointDetail/pointDetailPosition")
        if position.get("type") == "LocalCartesianPosition":
            origin = position.find("localSystem/origin")
            for child in list(position):
                position.remove(child)
            position.set("type", "GeodeticPosition")
            position.extend(list(origin))
    before.attrib.clear()
    order = {"messageSecurity": 0, "senderId": 1, "tracks": 2}
    before[:] = sorted((c for c in before if c.tag in order), key=lambda c: order[c.tag])
    after = ElementTree.fromstring(written.first().track_xml)
    assert tree(after) == tree(before)


def test_track_children_keep_their_order_and_text(spark):
    track = '<a k="1">&amp;</a><items type="VideoInformation"/><items>u</items><a/><items type="X"/>'
    valid = split_valid(parsed(spark, message(track=track)))[0]
    rows = track_children(rewrite(valid), ["message_id"]).orderBy("child_idx").collect()
    assert [(row.name, row.type, row.xml) for row in rows] == [
        ("a", None, '<a k="1">&amp;</a>'), ("items", None, "<items>u</items>"),
        ("a", None, "<a/>"), ("items", "X", '<items type="X"/>'),
    ]


def test_a_message_with_very_many_elements(spark):
    many = "<note>1</note>" * 60_000 + "<open>" * 40 + "</open>" * 40
    valid = split_valid(parsed(spark, message(f"<items>{many}</items>", point())))[0]
    rows = track_children(rewrite(valid), []).orderBy("child_idx").collect()
    assert rows[1].xml == f"<items>{many}</items>" and rows[2].type == "TrackPoint"


def test_children_are_cut_as_whole_pieces_and_by_counting_where_they_are_too_deep(spark):
    deep = nodes._DEPTH + 2
    texts = [
        '<a k="1 > 0"><b><c/></b>t<!-- <x> --></a> u <d/><?p <y>?><e ><![CDATA[</e>]]>v</e >',
        "<q>" * deep + "w" + "</q>" * deep + "<r>1</r>",
        "<s>1</s><open>",
        None,
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, xml string")
    xml = F.col("xml")
    rows = df.select(
        F.regexp_extract_all(xml, F.lit(nodes._PIECE), F.lit(0)).alias("pieces"),
        nodes.children(xml).alias("found"),
        nodes._deep_children(xml).alias("counted"),
    ).orderBy("id").collect()
    whole = [piece for piece in rows[0].pieces if piece[1] not in "!?u"]
    assert whole == [node.outer for node in rows[0].found] and len(whole) == 3
    assert [node.inner for node in rows[0].found] == [
        "<b><c/></b>t<!-- <x> -->", "", "<![CDATA[</e>]]>v"
    ]
    assert "<" in rows[1].pieces and [len(row.found or []) for row in rows] == [3, 2, 1, 0]
    assert all(row.found == row.counted for row in rows)


def test_messages_in_comments_do_not_count(spark):
    text = "<!-- <TrackMessage> -->" + message("<items><![CDATA[<TrackMessage>]]></items>")
    assert reasons(spark, text, message() + "<!-- x -->") == {}


def test_whole_documents_as_json(spark):
    texts = [
        message(point(without=["trackPointCourse"])),  # no valid point, but a document
        '<TrackMessage a="1"><n>007</n><f>2.50</f><t>true</t><e/><s>x ":null, y</s></TrackMessage>',
        "<TrackMessage><i/><i>1</i><i>2</i><m>a<b/>c</m></TrackMessage>",
        "<TrackMessage><a>", None, "<a/>",
    ]
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(texts)], "id string, xml string")
    found = {row.doc_id: json.loads(row.json) for row in json_documents(df, ["id"]).collect()}
    bodies = [found.get(hashlib.md5(str(i).encode()).hexdigest()) for i in range(len(texts))]
    assert bodies[0]["tracks"]["items"]["trackPointType"] == 1
    assert bodies[1] == {"_a": 1, "n": 7, "f": 2.5, "t": True, "s": 'x ":null, y'}
    assert bodies[2]["i"] == [None, 1, 2] and bodies[2]["m"]["_VALUE"] == ["a", "c"]
    assert bodies[3:] == [None, None, None]


def test_outputs_of_one_pass_equal_the_single_ones(spark):
    texts = [message(point(LOCAL), point()), message(point(without=["trackPointSpeed"])), "<a", None]
    df = spark.createDataFrame(
        [(str(i), x) for i, x in enumerate(texts)], "message_id string, xml string"
    )
    rows = tagged_outputs(df, ["message_id"]).collect()
    kinds = sorted((row.kind, row.message_id) for row in rows)
    assert kinds == [
        ("document", "0"), ("document", "1"), ("point", "0"), ("point", "0"),
        ("rejected", "1"), ("rejected", "2"), ("rejected", "3"),
    ]
    single = st_index(track_points(normalized(spark, *texts)))
    points = [row for row in rows if row.kind == "point"]
    assert sorted(map(str, (tuple(row[name] for name in single.columns) for row in points))) == (
        sorted(map(str, map(tuple, single.collect())))
    )


def test_json_leaves_null_fields_out_and_ids_repeat(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 2, "x")], "id string, n int, note string")
    rows = to_documents(df, ["id", "n"], ["n", "note"]).collect()
    assert [json.loads(row.json) for row in rows] == [{"n": 1}, {"n": 2, "note": "x"}]
    assert len({row.doc_id for row in rows}) == 2
    assert rows == to_documents(df, ["id", "n"], ["n", "note"]).collect()
    random = to_documents(df, ["id", "n"], ["n", "note"], random_ids=True).collect()
    assert [row.json for row in random] == [row.json for row in rows]
    assert not {row.doc_id for row in random} & {row.doc_id for row in rows}


def test_json_rows_are_glued_without_separator(spark):
    df = spark.createDataFrame(
        [("a", 2, '{"n":2}'), ("a", 1, '{"n":1}'), ("b", 1, '{"long":"text"}')],
        "id string, pos int, json string",
    )
    glued = concat_json(df, ["id"], "pos").orderBy("id")
    assert [tuple(row) for row in glued.collect()] == [
        ("a", 2, '{"n":1}{"n":2}'),
        ("b", 1, '{"long":"text"}'),
    ]


def test_inference_sees_every_document(spark):
    rows = [("<TrackMessage><a>1</a></TrackMessage>",), ("<TrackMessage><b>x</b></TrackMessage>",)]
    schema = infer_schema(spark.createDataFrame(rows, "xml string"))
    assert schema.names == ["a", "b"]


def test_outputs_are_written_without_a_sort_by_kind(spark, tmp_path, monkeypatch):
    setting, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    write = DataFrameWriter.parquet

    def parquet(writer, *args, **kwargs):
        seen.append(int(spark.conf.get(setting)))
        return write(writer, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    texts = [message(point()), message(point(without=["trackPointSpeed"])), "<TrackMessage>"]
    df = spark.createDataFrame(
        [(str(i), x) for i, x in enumerate(texts)], "message_id string, xml string"
    )
    before = spark.conf.get(setting)
    outputs.write_outputs(df.coalesce(1), str(tmp_path / "outputs"), ["message_id"])
    assert seen == [len(outputs.KINDS)] and spark.conf.get(setting) == before
    kinds = [outputs.DOCUMENT, outputs.REJECTED, outputs.POINT]
    found = [outputs.read_output(spark, str(tmp_path / "outputs"), kind) for kind in kinds]
    assert [sorted(r.message_id for r in rows.collect()) for rows in found] == [
        ["0", "1"],
        ["1", "2"],
        ["0"],
    ]


def test_documents_with_texts_of_the_same_types_are_inferred_once(spark):
    def text(n):
        leaves = {"n": n, "x": f"{n}.5", "s": f"p{n}-{n}", "w": "TRUE" if n % 2 else "MANUAL"}
        leaves |= {"t": f"2001-01-{n + 1:02}T00:00:{n:02}", "d": f"2001-02-{n + 20}", "b": "true"}
        inner = "".join(f"<{name}>{value}</{name}>" for name, value in leaves.items())
        return f"<TrackMessage>{inner}</TrackMessage>"

    same = spark.createDataFrame([(text(n),) for n in range(0, 8, 2)], "xml string")
    alike = same.select(parsing._alike(F.col("xml")).alias("xml")).collect()
    assert {r.xml.replace(f"2001-02-{n}", "") for r, n in zip(alike, range(20, 28, 2))} == {
        "<TrackMessage><n>1</n><x>1.</x><s>a1</s><w>a1</w><t>2000-01-01T00:00:00</t><d></d>"
        "<b>true</b></TrackMessage>"
    }
    for texts in (["1", "22", "1.5"], ["TRUE"], ["2001-02-30T00:00:00"], ["1d"], ["", "7"], ["-3"]):
        rows = [(f"<TrackMessage><a>{t}</a></TrackMessage>",) for t in texts]
        docs = spark.createDataFrame(rows, "xml string")
        reader = spark._jsparkSession.read().option("rowTag", "TrackMessage")
        strings = getattr(docs._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
        plain = json.loads(reader.xml(strings).schema().json())
        assert json.loads(infer_schema(docs).json()) == plain
