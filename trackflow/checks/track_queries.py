"""Queries on track messages: parse, normalise, features, sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackflow.functions.xml import (
    DETAIL_FIELDS,
    HEADER_FIELDS,
    HEADER_SCHEMA,
    POINT_FIELDS,
    POSITION_FIELDS,
)
from trackflow.operators import parsing, rewrite
from trackflow.operators.assembly import document_stats, repair_documents
from trackflow.operators.features import message_items, track_points  # noqa: F401
from trackflow.operators.normalize import (
    geodetic_position,
    is_point,
    project_header,
)
from trackflow.operators.ranges import points_within
from trackflow.operators.sinks import (
    fan_out,
    observe_sink,
    write_documents,
    write_features,
    write_messages,
)
from trackflow.plans import outputs
from trackflow.plans.documents import documents
from trackflow.plans.tracks import (
    indexed_track_points,
    message_points,
    normalized_messages,
    rejected_messages,
    routed_items,
    valid_documents,
    valid_messages,
)
from trackflow.session import shared_folder
from trackflow.sources.adapters import rich_track_xml, track_messages, track_xml


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.parse_messages(repair_documents(track_xml(spark, folder)))


def _valid(spark: SparkSession, folder: str) -> DataFrame:
    return valid_messages(track_xml(spark, folder))


def _normalized(spark: SparkSession, folder: str) -> DataFrame:
    return normalized_messages(track_xml(spark, folder))


def repair_tokens(spark: SparkSession, folder: str) -> DataFrame:
    repaired = repair_documents(track_xml(spark, folder))
    counts = {
        "n_broken": F.regexp_count("xml", F.lit("AUTOMATIC ESTIMATED")),
        "n_repaired": F.regexp_count("xml", F.lit("AUTOMATIC_ESTIMATED")),
    }
    return repaired.select("message_id", *[c.alias(name) for name, c in counts.items()])


def document_lengths(spark: SparkSession, folder: str) -> DataFrame:
    stats = document_stats(track_xml(spark, folder), {"AUTOMATIC ESTIMATED": "AUTOMATIC"})
    shortened = (F.col("n_chars_in") - F.col("n_chars_out")).alias("n_chars_less")
    return stats.select("message_id", shortened)


def parse_messages(spark: SparkSession, folder: str) -> DataFrame:
    msg = F.col("msg")
    track = F.get(msg["tracks"], 0)
    return _messages(spark, folder).select(
        "message_id",
        "parse_error",
        F.get(msg["senderId"], 0).alias("sender"),
        F.get(msg["msgCreatedTime"], 0).alias("created"),
        track["trackUUID"].alias("track_uuid"),
        F.when(track.isNotNull(), F.size(track["items"])).cast("bigint").alias("n_items"),
    )


def header(spark: SparkSession, folder: str) -> DataFrame:
    texts = repair_documents(track_xml(spark, folder))
    parsed = parsing.parse_messages(texts, HEADER_SCHEMA)
    messages = project_header(parsing.parsed_only(parsed))
    columns = []
    for name in HEADER_FIELDS:
        columns.append(F.get(F.col("msg")[name], 0).alias(name))
        columns.append(F.size(F.col("msg")[name]).cast("bigint").alias(f"n_{name}"))
    fields = F.lit(",".join(messages.schema["msg"].dataType.names)).alias("fields")
    return messages.select("message_id", *columns, fields)


def route_items(spark: SparkSession, folder: str) -> DataFrame:
    return routed_items(track_xml(spark, folder)).select(
        "message_id",
        "track_uuid",
        F.col("item_idx").cast("bigint").alias("item_idx"),
        F.col("item._type").alias("item_type"),
        F.col("item.raw").alias("raw"),
    )


def _points(spark: SparkSession, folder: str) -> DataFrame:
    items = message_items(_normalized(spark, folder)).where(is_point(F.col("item")))
    return items.withColumn("item_uuid", F.col("item.trackItemUUID"))


def project_points(spark: SparkSession, folder: str) -> DataFrame:
    leaves = [name for name in POINT_FIELDS if name != "trackPointPosition"]
    return _points(spark, folder).select(
        "message_id",
        *[F.col("item")[name].alias(name) for name in leaves],
        *[F.col("item.trackPointPosition")[name].alias(name) for name in POSITION_FIELDS],
    )


def project_detail(spark: SparkSession, folder: str) -> DataFrame:
    detail = F.col("item.TrackPointDetail")
    position = detail["pointDetailPosition"]
    return _points(spark, folder).select(
        "item_uuid",
        *[detail[name].alias(name) for name in DETAIL_FIELDS[:2]],
        position["_type"].alias("position_type"),
        *[position[name].alias(name) for name in POSITION_FIELDS],
        F.col("item.position_is_origin").alias("position_is_origin"),
    )


def geodetic_position_query(spark: SparkSession, folder: str) -> DataFrame:
    items = message_items(_valid(spark, folder)).where(is_point(F.col("item")))
    before = F.col("item.TrackPointDetail.pointDetailPosition")
    after = geodetic_position(before)
    return items.select(
        F.col("item.trackItemUUID").alias("item_uuid"),
        before["_type"].alias("type_before"),
        before["x"].alias("x_before"),
        after["_type"].alias("type_after"),
        after["x"].alias("x_after"),
        *[after[name].alias(name) for name in POSITION_FIELDS],
    )


def valid_messages_query(spark: SparkSession, folder: str) -> DataFrame:
    return valid_documents(track_xml(spark, folder)).select("message_id")


def rejected_messages_query(spark: SparkSession, folder: str) -> DataFrame:
    rejected = rejected_messages(track_xml(spark, folder))
    missing = F.array_join("missing_fields", ",").alias("missing")
    return rejected.select("message_id", "reject_reason", missing)


def message_json(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.json_documents(track_xml(spark, folder), ["message_id"])


def concat_json(spark: SparkSession, folder: str) -> DataFrame:
    items = message_items(_normalized(spark, folder)).select(
        "message_id",
        "item_idx",
        F.to_json(
            F.struct(
                F.col("item._type").alias("type"), F.col("item.trackItemUUID").alias("uuid")
            )
        ).alias("json"),
    )
    glued = parsing.concat_json(items, ["message_id"], "item_idx")
    return glued.withColumn("n_rows", F.col("n_rows").cast("bigint"))


def to_track_xml(spark: SparkSession, folder: str) -> DataFrame:
    valid = valid_documents(track_xml(spark, folder))
    return rewrite.to_track_xml(valid).select("message_id", "track_xml")


def rewrite_track_xml(spark: SparkSession, folder: str) -> DataFrame:
    """Messages full of content that no schema names, in normal form."""
    valid = valid_documents(rich_track_xml(spark, folder))
    return rewrite.to_track_xml(valid).select("message_id", "track_xml")


def track_children(spark: SparkSession, folder: str) -> DataFrame:
    """Every child that a normalised track keeps, as it stands in the message."""
    rewritten = rewrite.rewrite(valid_documents(rich_track_xml(spark, folder)))
    found = rewrite.track_children(rewritten, ["message_id"])
    places = [F.col(name).cast("bigint").alias(name) for name in ("track_idx", "child_idx")]
    return found.select("message_id", *places, "name", "type", "xml")


def raw_items(spark: SparkSession, folder: str) -> DataFrame:
    """The inner text of the items that are no track points."""
    items = routed_items(rich_track_xml(spark, folder)).where("item.raw IS NOT NULL")
    return items.select(
        "message_id", F.col("item.item_no").cast("bigint").alias("item_no"), F.col("item.raw")
    )


def reparse_track_xml(spark: SparkSession, folder: str) -> DataFrame:
    """Track points after writing the normalised messages as XML and reading them again."""
    written = rewrite.to_track_xml(valid_documents(rich_track_xml(spark, folder)))
    points = message_points(written.select("message_id", F.col("track_xml").alias("xml")))
    return points.select("message_id", "item_uuid", "time", "lon", "lat", "elev", "speed")


def _leaves(data_type: T.DataType, path: str = "") -> list[tuple[str, str]]:
    """Paths and types of the leaf fields."""
    if isinstance(data_type, T.ArrayType):
        return _leaves(data_type.elementType, f"{path}[]")
    if not isinstance(data_type, T.StructType):
        return [(path.removeprefix("."), data_type.simpleString())]
    return [leaf for f in data_type.fields for leaf in _leaves(f.dataType, f"{path}.{f.name}")]


def infer_schema(spark: SparkSession, folder: str) -> DataFrame:
    """The inferred schema as (path, type) rows."""
    leaves = _leaves(parsing.infer_schema(track_xml(spark, folder)))
    rows = [F.struct(F.lit(path).alias("path"), F.lit(kind).alias("type")) for path, kind in leaves]
    return spark.range(1).select(F.inline(F.array(*rows)))


_POINT_COLUMNS = [
    "message_id",
    "item_uuid",
    "time",
    "lon",
    "lat",
    "elev",
    "speed",
    "course",
    "source",
    "position_is_origin",
]


def track_points_query(spark: SparkSession, folder: str) -> DataFrame:
    points = message_points(track_xml(spark, folder))
    return points.select(
        *_POINT_COLUMNS, F.col("item_idx").cast("bigint").alias("item_idx"), "track_uuid"
    )


def st_index_query(spark: SparkSession, folder: str) -> DataFrame:
    points = indexed_track_points(track_xml(spark, folder))
    return points.select("item_uuid", F.col("time_bin").cast("bigint").alias("time_bin"), "st_key")


def lines_to_track_points(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way: raw messages, sessions, documents, messages, indexed points."""
    texts = documents(track_messages(spark, folder), stage=True)
    points = indexed_track_points(
        texts.select(F.col("channel").alias("message_id"), "session_id", "xml")
    )
    return points.select(*_POINT_COLUMNS, "st_key")


def feature_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "features")
    write_features(indexed_track_points(track_xml(spark, folder)), path)
    return spark.read.parquet(path).select(
        *_POINT_COLUMNS, F.col("time_bin").cast("bigint").alias("time_bin"), "st_key"
    )


#: A box of the test points: west, south, east, north, and the first and last time.
BOX = (-60.0, -45.0, 75.5, 30.0, datetime(1995, 6, 1), datetime(1997, 3, 15, 12))


def range_points(spark: SparkSession, folder: str) -> DataFrame:
    """The points of a box, read from a table in index order by ranges of the key."""
    path = shared_folder(spark, "range-points")
    write_features(indexed_track_points(track_xml(spark, folder)), path)
    return points_within(spark.read.parquet(path), *BOX).select(*_POINT_COLUMNS, "st_key")


def document_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "documents")
    write_documents(message_json(spark, folder), path)
    schema = "index string, type string, doc_id string, body string"
    return spark.read.schema(schema).json(path)


def message_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "messages")
    write_messages(_normalized(spark, folder).drop("parse_error"), path)
    return spark.read.parquet(path).select(
        "message_id",
        F.get("msg.senderId", 0).alias("sender"),
        F.size(F.get("msg.tracks", 0)["items"]).cast("bigint").alias("n_items"),
    )


def fan_out_query(spark: SparkSession, folder: str) -> DataFrame:
    """The same documents to the document sink and to the feature sink."""
    path = shared_folder(spark, "fan-out")
    fan_out(
        track_xml(spark, folder),
        [
            lambda df: write_documents(
                parsing.json_documents(df, ["message_id"]), f"{path}/documents"
            ),
            lambda df: write_features(indexed_track_points(df), f"{path}/features"),
        ],
    )
    stored = spark.read.schema("doc_id string, body string").json(f"{path}/documents")
    points = spark.read.parquet(f"{path}/features")
    return stored.select(F.lit("document").alias("sink"), F.col("doc_id").alias("id"), "body").union(
        points.select(F.lit("feature"), "item_uuid", F.col("st_key").cast("string"))
    )


def tagged_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, rejects and points, written in one pass and read kind by kind."""
    path = shared_folder(spark, "outputs")
    outputs.write_outputs(track_xml(spark, folder), path, ["message_id"])

    def read(kind: str, name: Column, value: Column) -> DataFrame:
        rows = outputs.read_output(spark, path, kind)
        return rows.select(F.lit(kind).alias("kind"), "message_id", name, value)

    none = F.lit(None).cast("string")
    document = read(outputs.DOCUMENT, F.col("doc_id").alias("name"), F.col("json").alias("value"))
    rejected = read(outputs.REJECTED, none.alias("name"), F.col("reject_reason"))
    key = F.concat_ws(":", "time_bin", "st_key", "track_idx", "item_idx", "track_uuid", "comment")
    return document.union(rejected).union(read(outputs.POINT, F.col("item_uuid"), key))


def sink_report(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted and rejected messages, counted while they are written."""
    path = shared_folder(spark, "report")
    observation = Observation("messages")
    messages = _messages(spark, folder).select("message_id", "parse_error")
    observed = observe_sink(messages, observation, F.col("parse_error").isNull())
    write_messages(observed, path)
    counts = observation.get
    return spark.range(1).select(
        *[F.lit(counts[name]).cast("bigint").alias(name) for name in ("n_accepted", "n_rejected")]
    )


QUERIES = {
    "repair_tokens": repair_tokens,
    "document_lengths": document_lengths,
    "parse_messages": parse_messages,
    "header": header,
    "route_items": route_items,
    "project_points": project_points,
    "project_detail": project_detail,
    "geodetic_position": geodetic_position_query,
    "valid_messages": valid_messages_query,
    "rejected_messages": rejected_messages_query,
    "message_json": message_json,
    "concat_json": concat_json,
    "to_track_xml": to_track_xml,
    "rewrite_track_xml": rewrite_track_xml,
    "track_children": track_children,
    "raw_items": raw_items,
    "reparse_track_xml": reparse_track_xml,
    "infer_schema": infer_schema,
    "track_points": track_points_query,
    "st_index": st_index_query,
    "lines_to_track_points": lines_to_track_points,
    "feature_sink": feature_sink,
    "range_points": range_points,
    "document_sink": document_sink,
    "message_sink": message_sink,
    "fan_out": fan_out_query,
    "tagged_outputs": tagged_outputs,
    "sink_report": sink_report,
}
