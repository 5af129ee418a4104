"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.llm import (
    bpe,
    jaccard,
    langid,
    linededup,
    merkle,
    neardup,
    packing,
    pii,
    repair,
    secrets,
    sharding,
    urls,
)
from trackflow.llm import topk as search
from trackflow.llm.manifest_sql import crc32_of, manifest_sql
from trackflow.llm.oracles import LINES, NEAR_VECTORS, SHINGLES, TOP_K
from trackflow.llm.repair_sql import REPAIR
from trackflow.llm.shared import cut_lineage, ship_package, table, whole_text
from trackflow.session import shared_folder

VOCABULARY = "word_bpe_49k.json"
KEYS_PER_SHARD = 500_000


def vocabulary() -> str:
    return bpe.read_vocabulary(public_tokenizers.path(VOCABULARY))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    network = langid.fit(documents)
    held = F.coalesce(langid.fold() == 0, F.lit(True)).alias("held_out")
    return langid.identify(documents, network).select("doc_id", held, "lang_pred", "score")


def op2_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "embeddings"))


def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    def digests(ids, tables) -> tuple:
        plain, decoded = tables.decimal_bytes(ids), tables.decode_bytes(ids)
        return len(ids), hashlib.sha256(plain).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return bpe.encode_documents(
        table(spark, folder, "documents"),
        vocabulary(),
        "n_tokens long, ids_sha256 string, decoded_sha256 string",
        digests,
    )


def _joined(spans: Column) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(text, ",")


def _of_kinds(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def _span_digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return found.select(
        "doc_id",
        *(F.size(_of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in kinds),
        F.sha2(_joined(_of_kinds(*kinds)), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    return _span_digest(found, secrets.KINDS[:3])


def op5_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(table(spark, folder, "documents"), vocabulary())
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    return packing.pack(cut).select(*columns)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    index = line_index(documents)
    kept = index.resolve(documents)
    index.drop()
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def line_index(docs: DataFrame) -> linededup.LineIndex:
    """A fresh index of all documents; its caller drops it."""
    spark, text = docs.sparkSession, F.col("text")
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    lines = docs.select(whole_text().alias("text")).agg(F.sum(breaks)).first()[0] or 0
    shards = max(4, math.ceil(lines / KEYS_PER_SHARD))
    index = linededup.LineIndex(spark, shared_folder(spark, "line-index"), shards)
    index.insert(docs)
    return index


def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"))


def op8_hypergeometric_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    crc = F.crc32(F.encode(F.coalesce(text, F.lit("")), "utf-8"))
    rows = table(spark, folder, "documents").select(
        "doc_id", size.alias("size"), crc.alias("text_crc32")
    )
    shuffled = sharding.shuffle_into_shards(cut_lineage(rows))
    return shuffled.select(
        "row.doc_id",
        "row.size",
        "row.text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return _span_digest(pii.find_personal_data(table(spark, folder, "documents")), pii.KINDS)


def op10_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.filter_urls(table(spark, folder, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    text, chance = F.col("text"), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    altered = F.when(chance % 2 == 0, F.replace(text, F.lit("\n"))).otherwise(text)
    proved = merkle.document_manifest(table(spark, folder, "documents"), altered)
    proof = F.sha2(merkle.proof_text(F.col("path")), 256)
    root = merkle.folded(F.col("found"), F.col("path"))
    rows = proved.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof.alias("proof_sha256"),
        root.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = repair.damaged(table(spark, folder, "conversations"))
    return repair.repair_report(turns, F.col("gone"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run


#: Queries with the same rows from SQL; the others are tested against brute force.
ORACLES: dict[str, str] = {
    "op2_embedding_near_dedup": NEAR_VECTORS,
    "op6_line_dedup": LINES,
    "op7_ngram_jaccard_join": SHINGLES,
    "op10_exact_top_k": TOP_K,
    "op12_merkle_manifest": manifest_sql(
        f"CASE WHEN {crc32_of('CAST(doc_id AS VARCHAR)')} % 2 = 0"
        " THEN replace(text, chr(10), '') ELSE text END"
    ),
    "op13_conversation_repair": REPAIR,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f)
    for f in (
        op1_language_id,
        op2_embedding_near_dedup,
        op3_bpe_round_trip,
        op4_secret_scan,
        op5_pattern_packing,
        op6_line_dedup,
        op7_ngram_jaccard_join,
        op8_hypergeometric_sharding,
        op9_personal_data,
        op10_exact_top_k,
        op11_url_filter,
        op12_merkle_manifest,
        op13_conversation_repair,
    )
}
