"""Messages derived from the tables of a data folder, for tests, checks and benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.functions.text import ENVELOPE_DELIMITER, PROLOG
from trackflow.operators.hold import hold


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(number: Column, decimal: str) -> Column:
    return number.cast(decimal).cast("string")


def events_as_messages(events: DataFrame) -> DataFrame:
    """``raw_messages(channel, offset, value)`` from events, batch or streaming.

    The event type decides the payload: signup opens a file, purchase ends it, error is a
    prolog line, click and view are content lines.  Some payloads get padding or junk, some
    messages lose their envelope.
    """
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    kind = F.col("event_type")
    payload = (
        F.when(
            kind == "signup", F.concat(F.lit('{"filePath":"u'), user, F.lit('","mark":"START"}'))
        )
        .when(
            kind == "purchase",
            F.concat(F.lit('{"filePath":"u'), user, F.lit('","mark":"END","lineCount":0}')),
        )
        .when(kind == "error", F.lit(PROLOG))
        .when(kind == "click", F.concat(F.lit('<c id="'), event, F.lit('"/>')))
        .otherwise(
            F.concat(F.lit("<v>"), _text(F.col("value"), "decimal(10,2)"), F.lit("</v>"))
        )
    )
    has_junk = kind.isin("click", "view") & (F.col("event_id") % 7 == 0)
    junk = F.when(has_junk, F.lit(',"')).otherwise(F.lit(""))
    pad = F.element_at(
        F.array(F.lit(""), F.lit("  "), F.lit("\t")), (F.col("event_id") % 3 + 1).cast("int")
    )
    delimiter = F.when(F.col("event_id") % 97 == 0, F.lit("")).otherwise(F.lit(ENVELOPE_DELIMITER))
    messages = events.select(
        F.col("user_id").alias("channel"),
        F.col("event_id").alias("offset"),
        F.concat(F.lit("contentType"), delimiter, pad, junk, payload, pad).alias("built"),
    )
    return hold(messages, "built", "value")


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    return events_as_messages(table(spark, folder, "events"))


def lines_as_messages(df: DataFrame, channel: str, lines: Column) -> DataFrame:
    """A message per line, between a START and an END message, for each row of ``df``."""
    start = F.lit('{"mark":"START"}')
    end = F.lit('{"mark":"END"}')
    framed = F.concat(F.array(start), lines, F.array(end))
    exploded = df.select(F.col(channel).alias("channel"), F.posexplode(framed))
    envelope = F.lit("contentType" + ENVELOPE_DELIMITER)
    return exploded.select(
        "channel",
        F.col("pos").cast("bigint").alias("offset"),
        F.concat(envelope, F.col("col")).alias("value"),
    )


def doc_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's lines as messages; the channel is the document."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return lines_as_messages(documents, "doc_id", F.split("text", "\n"))


def _leaf(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


def _constant(name: str, value: str) -> Column:
    return F.lit(f"<{name}>{value}</{name}>")


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def _item_line(item: Column, number: Column) -> Column:
    """XML of one line item; the return flag decides the item type."""
    lon = _text((item["l_partkey"] % 3600) / 10 - 180, "decimal(6,1)")
    lat = _text((item["l_suppkey"] % 1800) / 10 - 90, "decimal(6,1)")
    position = F.concat(
        _leaf("latitude", lat),
        _leaf("longitude", lon),
        _leaf("elevation", item["l_linenumber"].cast("string")),
    )
    detail_position = F.when(
        item["l_returnflag"] == "A",
        F.concat(
            F.lit(
                '<pointDetailPosition type="LocalCartesianPosition">'
                "<x>1</x><y>2</y><z>3</z><localSystem><origin>"
            ),
            position,
            F.lit("</origin></localSystem></pointDetailPosition>"),
        ),
    ).otherwise(
        F.concat(
            F.lit('<pointDetailPosition type="GeodeticPosition">'),
            position,
            F.lit("</pointDetailPosition>"),
        )
    )
    uuid = F.concat_ws(
        "-", F.concat(F.lit("p"), item["l_orderkey"].cast("string")), number.cast("string")
    )
    course = _leaf("trackPointCourse", ((item["l_partkey"] * 7) % 360).cast("string"))
    source = F.when(item["l_partkey"] % 2 == 0, "AUTOMATIC ESTIMATED").otherwise("MANUAL")
    point = F.concat(
        F.lit('<items type="TrackPoint">'),
        _leaf("trackItemUUID", uuid),
        F.lit("<trackItemSecurity><level>UNCLASSIFIED</level></trackItemSecurity>"),
        _leaf("trackItemTime", _iso(item["l_shipdate"])),
        _constant("trackItemSource", "radar"),
        _constant("trackItemComment", ""),
        _leaf("trackPointPosition", position),
        _leaf("trackPointSpeed", _text(item["l_quantity"], "decimal(10,2)")),
        F.when(_text(item["l_discount"], "decimal(10,2)") == "0.10", F.lit("")).otherwise(course),
        _constant("trackPointType", "MEASURED"),
        _leaf("trackPointSource", source),
        _constant("trackPointObjectMask", "NONE"),
        F.lit("<ignored>1</ignored><TrackPointDetail>"),
        F.lit("<pointDetailVelocity><vx>1</vx></pointDetailVelocity>"),
        F.lit("<pointDetailCovarianceMatrix><c>0</c></pointDetailCovarianceMatrix>"),
        detail_position,
        F.lit("</TrackPointDetail></items>"),
    )
    video = F.lit('<items type="VideoInformation"><frame>1</frame></items>')
    note = F.concat(F.lit("n"), item["l_linenumber"].cast("string"))
    other = F.concat(F.lit('<items type="TrackObject">'), _leaf("note", note), F.lit("</items>"))
    flag, status = item["l_returnflag"], item["l_linestatus"]
    return F.when(flag != "R", point).when(status == "F", video).otherwise(other)


def _items_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The line items of each order, sorted."""
    columns = [
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_shipdate",
        "l_orderkey",
        "l_discount",
        "l_returnflag",
        "l_linestatus",
    ]
    items = table(spark, folder, "lineitem").select(*columns)
    return items.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct(*columns))).alias("items")
    )


def track_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``(message_id, o_orderkey, lines)``: a track message per order, an XML line per item."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    items = _items_of_orders(spark, folder)
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    order_text = F.col("o_orderkey").cast("string")
    message_id = F.concat(F.lit("m"), order_text)
    header = F.array(
        F.lit('<TrackMessage version="1">'),
        _constant("messageSecurity", "UNCLASSIFIED"),
        _leaf("msgCreatedTime", _iso(F.col("o_orderdate"))),
        _constant("stanagVersion", "3.0"),
        _leaf("senderId", F.concat(F.lit("c"), F.col("o_custkey").cast("string"))),
        _constant("junk", "x"),
        F.concat(F.lit("<tracks>"), _leaf("trackUUID", F.concat(F.lit("t"), order_text))),
    )
    body = F.transform("items", lambda item, i: _item_line(item, i + 1))
    closing = F.when(F.col("o_orderkey") % 101 == 0, F.lit("")).otherwise("</TrackMessage>")
    lines = F.concat(header, body, F.array(F.concat(F.lit("</tracks>"), closing)))
    return joined.select(message_id.alias("message_id"), "o_orderkey", lines.alias("lines"))


def track_xml(spark: SparkSession, folder: str) -> DataFrame:
    """``(message_id, o_orderkey, xml)``: a track message per order."""
    lines = track_lines(spark, folder)
    built = lines.select("message_id", "o_orderkey", F.array_join("lines", "").alias("built"))
    return hold(built, "built", "xml")


def track_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The same track messages, line by line as raw messages; the channel is the message."""
    return lines_as_messages(track_lines(spark, folder), "message_id", F.col("lines"))


#: What ``rich_track_xml`` puts in place of what.
RICH = {
    "<tracks>": '<tracks n="1"><!-- <items type="x"> --><trackStatus level="a&amp;b">open &lt;1&gt;'
    "</trackStatus>",
    "</longitude>": "</longitude><datum name='\"84\"'>\u00e9 &amp; <b/></datum>",
    "<trackItemComment></trackItemComment>": '<trackItemComment lang="x"><![CDATA[<a> & ]]>&amp; b'
    "</trackItemComment>",
    "<note>": '<note k="1 > 0"><![CDATA[</items>]]>',
    "</note>": '</note><items type="TrackPoint"><items>q</items></items>',
    "<senderId>": '<senderId role="s&lt;">',
    "</tracks>": '<last a="1"/></tracks>',
}


def rich_track_xml(spark: SparkSession, folder: str) -> DataFrame:
    """``track_xml`` with elements and attributes that no schema names, entities, comments, CDATA
    and items inside items."""
    xml = F.col("xml")
    for plain, rich in RICH.items():
        xml = F.replace(xml, F.lit(plain), F.lit(rich))
    return track_xml(spark, folder).withColumn("built", xml).drop("xml").transform(
        lambda df: hold(df, "built", "xml")
    )
