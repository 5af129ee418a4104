"""All that a document gives, in one pass: its JSON, its track points, or why it has none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackflow.functions.xml import TRACK_SCHEMA, repair_tokens
from trackflow.operators.features import point_columns, st_index
from trackflow.operators.normalize import check_messages, is_point, route_items
from trackflow.operators.parsing import parse_messages, whole_json

KINDS = DOCUMENT, REJECTED, POINT = "document", "rejected", "point"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def _entries(item_type: T.DataType) -> Column:
    """What becomes of a message: an entry for its document, its reason, each track point."""

    def entry(kind: str, track: Column, track_idx: Column, item_idx: Column, item: Column):
        return F.struct(
            F.lit(kind).alias("kind"),
            track.cast("string").alias("track_uuid"),
            track_idx.cast("int").alias("track_idx"),
            item_idx.cast("int").alias("item_idx"),
            item.cast(item_type).alias("item"),
        )

    def of_track(track: Column, track_idx: Column) -> Column:
        numbered = F.transform(
            track["items"],
            lambda item, i: entry(POINT, track["trackUUID"], track_idx, i, item),
        )
        return F.filter(numbered, lambda e: is_point(e["item"]))

    none = F.lit(None)
    valid = F.col("reject_reason").isNull()
    points = F.flatten(F.transform("msg.tracks", of_track))
    document, rejected = (
        F.when(wanted, entry(kind, none, none, none, none))
        for kind, wanted in ((DOCUMENT, F.col("parse_error").isNull()), (REJECTED, ~valid))
    )
    return F.concat(
        F.array_compact(F.array(document, rejected)),
        F.when(valid, F.coalesce(points, F.array())).otherwise(F.array()),
    )


def tagged_outputs(
    documents: DataFrame, id_columns: list[str], schema: str = TRACK_SCHEMA
) -> DataFrame:
    """One row per output, of the ``kind`` document, rejected or point.

    A document row has ``doc_id`` and ``json``, a rejected row ``xml`` and ``reject_reason``, a
    point row the columns of an indexed track point; the columns of other kinds are null. The
    documents are parsed once for points and reasons, and once for their JSON.
    """
    texts = documents.withColumns({"text": F.col("xml"), "xml": repair_tokens(F.col("xml"))})
    checked = route_items(check_messages(parse_messages(texts, schema)), raw=False)
    tracks = checked.schema["msg"].dataType["tracks"].dataType.elementType
    entries = _entries(tracks["items"].dataType.elementType)
    rows = checked.select(
        *id_columns, "text", "xml", "reject_reason", F.explode(entries).alias("entry")
    )
    kind = F.col("entry.kind")
    position = F.concat_ws(":", *[F.col(name).cast("string") for name in id_columns])
    return st_index(
        rows.select(
            *id_columns,
            kind.alias("kind"),
            F.when(kind == DOCUMENT, F.md5(position)).alias("doc_id"),
            F.when(kind == DOCUMENT, whole_json(F.col("text"))).alias("json"),
            F.when(kind == REJECTED, F.col("xml")).alias("xml"),
            F.when(kind == REJECTED, F.col("reject_reason")).alias("reject_reason"),
            *(F.col(f"entry.{name}") for name in ("track_uuid", "track_idx", "item_idx")),
            *point_columns(F.col("entry.item")),
        )
    )


def write_outputs(documents: DataFrame, path: str, id_columns: list[str], **options) -> None:
    """Write all outputs at once, in a folder per kind.

    Each task keeps a file of each kind open; otherwise Spark sorts all rows, the documents'
    texts with them, by kind first.
    """
    spark = documents.sparkSession
    tagged = tagged_outputs(documents, id_columns, **options)
    before = spark.conf.get(_OPEN_FILES)
    spark.conf.set(_OPEN_FILES, max(int(before), len(KINDS)))
    try:
        tagged.write.mode("overwrite").partitionBy("kind").parquet(path)
    finally:
        spark.conf.set(_OPEN_FILES, before)


def read_output(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The rows of one kind; no file of another kind is opened."""
    return spark.read.parquet(path).where(F.col("kind") == kind).drop("kind")
