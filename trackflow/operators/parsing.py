"""XML documents to nested messages, and messages to JSON or XML text."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackflow.functions.nodes import bind
from trackflow.functions.xml import CORRUPT, TRACK_SCHEMA, XML_OPTIONS
from trackflow.operators.hold import hold

# Text in which an element may be named without being there.
_NO_ELEMENT = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
# A field without value, with the comma that parts it from its neighbour.  Quotes inside a JSON
# text are escaped, so this cannot lie within one.
_NULL_FIRST = r'"[^"\\]*+":null,'
_NULL_LAST = r',?"[^"\\]*+":null'
# Whole texts between tags whose type shows in their form, and one of that type for all of them.
_ALIKE = [
    (r">-?[0-9]{1,9}(?:(\.)[0-9]{1,9})?(?=<)", ">1$1"),
    (
        r">(?:19[2-9][0-9]|20[0-9]{2})-(?:0[1-9]|1[0-2])-(?:0[1-9]|1[0-9]|2[0-8])"
        r"T(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](?=<)",
        ">2000-01-01T00:00:00",
    ),
    (
        r">(?!(?:TRUE|FALSE|INFINITY|EPOCH|TODAY|TOMORROW|YESTERDAY)<)"
        r"(?:[a-z]++[0-9][0-9-]*+|[A-Z]{4,}+(?:[ _][A-Z]++)*+)(?=<)",
        ">a1",
    ),
]


def n_messages(xml: Column) -> Column:
    """How many message elements a text opens, those in comments and CDATA left out."""
    marked = F.contains(xml, F.lit("<!"))
    elements = F.when(marked, F.regexp_replace(xml, _NO_ELEMENT, "")).otherwise(xml)
    return F.regexp_count(elements, F.lit("<TrackMessage[\\s/>]"))


def parse_messages(documents: DataFrame, schema: str | T.StructType = TRACK_SCHEMA) -> DataFrame:
    """Parse each document into ``msg``; ``parse_error`` says why a document has no message.

    A pinned schema keeps types stable across documents.
    """
    parsed = documents.withColumns(
        {
            "parsed": F.from_xml("xml", schema, XML_OPTIONS),
            "n_roots": n_messages(F.col("xml")),
        }
    )
    held = hold(parsed, "parsed", "msg")
    error = (
        F.when(F.col("xml").isNull(), F.lit("null_document"))
        .when(F.col(f"msg.{CORRUPT}").isNotNull(), F.lit("malformed_xml"))
        .when(F.col("n_roots") != 1, F.lit("not_one_message"))
    )
    return held.withColumn("parse_error", error).drop("n_roots")


def parsed_only(messages: DataFrame) -> DataFrame:
    return messages.where("parse_error IS NULL")


def _alike(xml: Column) -> Column:
    """A document of the same schema in which texts of one type are alike."""
    for pattern, text in _ALIKE:
        xml = F.regexp_replace(xml, F.lit(pattern), F.lit(text))
    return xml


def infer_schema(
    documents: DataFrame, xml_column: str = "xml", sampling_ratio: float = 1.0
) -> T.StructType:
    """Schema over the documents as the XML reader infers it, in the JVM and in one pass.

    What the reader infers from a document depends on its elements and on the types of its texts
    only. So texts of one type are made alike, and documents that then are equal are read once.
    A sample is drawn from the documents as they are.
    """
    spark = documents.sparkSession
    texts = documents.select(xml_column).where(F.col(xml_column).isNotNull())
    if sampling_ratio == 1.0:
        texts = texts.select(_alike(F.col(xml_column)).alias(xml_column)).distinct()
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = (
        spark._jsparkSession.read()
        .option("rowTag", "TrackMessage")
        .option("samplingRatio", str(sampling_ratio))
    )
    return T.StructType.fromJson(json.loads(reader.xml(strings).schema().json()))


def to_documents(
    df: DataFrame,
    id_columns: list[str],
    body: list[str] | None = None,
    random_ids: bool = False,
) -> DataFrame:
    """One JSON document per row, NULL fields left out, with an id that a re-run repeats.

    ``random_ids`` gives each document a new id on every run; a retried write then adds copies.
    """
    names = [name for name in df.columns if name not in id_columns] if body is None else body
    position = F.concat_ws(":", *[F.col(name).cast("string") for name in id_columns])
    return df.select(
        (F.uuid() if random_ids else F.md5(position)).alias("doc_id"),
        F.to_json(F.struct(*names)).alias("json"),
    )


def whole_json(xml: Column) -> Column:
    """All of a well-formed document as JSON, whatever elements it has.

    Each value gets its own type, so no schema is needed and none is shared between documents:
    numbers and truth values lose their quotes, an element that comes once is an object and one
    that comes again an array, attributes are fields that begin with ``_``, text beside elements
    is ``_VALUE``.  Fields are sorted by name; empty elements are left out.
    """

    def without_nulls(text: Column) -> Column:
        without = F.regexp_replace(F.regexp_replace(text, _NULL_FIRST, ""), _NULL_LAST, "")
        return F.when(F.contains(text, F.lit(":null")), without).otherwise(text)

    return bind(F.to_json(F.from_xml(xml, "variant", XML_OPTIONS)), without_nulls)


def json_documents(documents: DataFrame, id_columns: list[str]) -> DataFrame:
    """``doc_id, json``: every document that is one well-formed message, whole.

    This needs no valid track points: what normalisation rejects is still a document.
    """
    parsed = parse_messages(documents, f"{CORRUPT} string")
    position = F.concat_ws(":", *[F.col(name).cast("string") for name in id_columns])
    return parsed_only(parsed).select(
        F.md5(position).alias("doc_id"), whole_json(F.col("xml")).alias("json")
    )


def concat_json(
    df: DataFrame, keys: list[str], order: str, json_column: str = "json"
) -> DataFrame:
    """Glue the JSON texts of each key in order, without a separator, into one row a key."""
    pieces = F.sort_array(F.collect_list(F.struct(F.col(order), F.col(json_column))))
    glued = df.groupBy(*keys).agg(pieces.alias("pieces"))
    texts = F.transform("pieces", lambda piece: piece[json_column])
    return glued.select(
        *keys, F.size("pieces").alias("n_rows"), F.array_join(texts, "").alias("json")
    )
