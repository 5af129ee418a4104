"""A training corpus from documents: language, lines, near copies, secrets, packed sequences.

Defined results of every stage: an empty table gives an empty one; a null text counts as empty and
stays null where a stage keeps it; texts of any length are read whole; repeated rows are judged
alike, so all of them stay or go, but for near copies, where the rows of the smallest id stay.
The stages read ``doc_id``, ``text``, ``lang`` and ``n_chars``; other columns are carried along.
``_told`` and ``_drops`` are names the stages use themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.llm import jaccard, langid, packing, secrets
from trackflow.llm.linededup import kept_text
from trackflow.llm.queries import line_index, vocabulary
from trackflow.llm.shared import ship_package
from trackflow.session import shared_folder

LEAST_SCORE = 0.3

#: SQL cannot express the trained model of the first stage.
ORACLE_SQL = None


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """The documents with another text and its length, in the columns they had."""
    changed = docs.withColumn("text", text)
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return changed.withColumn("n_chars", length).select(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters or of no language go."""
    ship_package(spark)
    network = langid.fit(docs)
    told = docs.withColumn("_told", langid.prediction(network, F.col("text")))
    known = (F.col("_told.lang_pred") != langid.UNKNOWN) & (F.col("_told.score") >= LEAST_SCORE)
    return told.where(known).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that a document with a smaller id has."""
    ship_package(spark)
    index = line_index(docs)
    drops = index.drops(docs).select("doc_id", F.col("drops").alias("_drops"))
    index.drop()
    joined = docs.join(drops, "doc_id", "left")
    kept = joined.withColumn("text", kept_text(F.col("text"), F.col("_drops")))
    return _with_text(kept.select(*docs.columns), F.col("text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, the one with the smallest id."""
    ship_package(spark)
    found = jaccard.jaccard_components(docs)
    copies = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets masked."""
    ship_package(spark)
    return _with_text(docs, secrets.masked(F.col("text")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a training sequence."""
    ship_package(spark)
    return packing.pack(packing.pieces(docs, vocabulary()))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = shared_folder(spark, "corpus")
    for place, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{place}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
