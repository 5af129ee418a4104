"""What the queries return, column by column, against plain versions over a whole table."""

import hashlib
import zlib
from collections import Counter

import pytest
from tokenizers import Tokenizer

import brute
from trackflow.llm import pii, queries, secrets
from trackflow.llm.shared import table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in table(spark, SMALL, "documents").collect()}


def rows_of(spark, name):
    return queries.QUERIES[name](spark, SMALL).collect()


def test_op1_tells_held_out_rows_and_rows_without_letters(spark, documents):
    found = rows_of(spark, "op1_language_id")
    assert sorted(r.doc_id for r in found) == sorted(documents)
    learned = {r.lang for r in documents.values() if zlib.crc32(str(r.doc_id).encode()) % 5}
    for row in found:
        text = documents[row.doc_id].text or ""
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert (row.lang_pred == "und") == (not any(map(str.isalpha, text)))
        assert row.lang_pred in learned | {"und"} and 0 <= row.score <= 1


def test_op3_digests_equal_the_library(spark, documents):
    library = Tokenizer.from_str(queries.vocabulary())
    found = rows_of(spark, "op3_bpe_round_trip")
    assert len(found) == len(documents)
    for row in found:
        ids = library.encode(documents[row.doc_id].text or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == brute.sha(" ".join(map(str, ids)))
        assert row.decoded_sha256 == brute.sha(library.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize(
    "name, kinds, spans_of",
    [
        ("op4_secret_scan", secrets.KINDS[:3], brute.secret_spans),
        ("op9_personal_data", pii.KINDS, brute.personal_spans),
    ],
)
def test_span_queries_hold_the_base_spans(spark, documents, name, kinds, spans_of):
    found = rows_of(spark, name)
    assert len(found) == len(documents)
    for row in found:
        base = spans_of(documents[row.doc_id].text or "")
        counts = Counter(kind for kind, _, _ in base)
        assert all(row[f"n_{kind}"] == counts[kind] for kind in kinds)
        assert row.base_sha256 == brute.sha(brute.joined(base))
        every = row.spans.split(",") if row.spans else []
        assert set(brute.joined(base).split(",")) - {""} <= set(every)
        starts = [int(span.split(":")[1]) for span in every]
        assert starts == sorted(starts)


def test_op8_shards_are_equal_and_gapless(spark, documents):
    found = rows_of(spark, "op8_hypergeometric_sharding")
    assert sorted(r.doc_id for r in found) == sorted(documents)
    slots = {}
    for row in found:
        data = (documents[row.doc_id].text or "").encode()
        assert (row.size, row.text_crc32) == (len(data) + 1, brute.crc(data))
        assert row.law == "rows" and row.grown_shard is None
        slots.setdefault(row.shard, []).append(row.slot)
    assert set(slots) <= set(range(8))
    assert all(sorted(held) == list(range(len(held))) for held in slots.values())
    sizes = [len(slots.get(shard, [])) for shard in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_op5_packs_every_token(spark, documents):
    library = Tokenizer.from_str(queries.vocabulary())
    found = rows_of(spark, "op5_pattern_packing")
    lengths, places = Counter(), {}
    for row in found:
        lengths[row.doc_id] += row.length
        places.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for doc_id, document in documents.items():
        ids = library.encode(document.text or "", add_special_tokens=False).ids
        assert lengths[doc_id] == len(ids) + 1
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096


def test_op12_proofs_are_what_the_tampering_leaves(spark, documents):
    for row in rows_of(spark, "op12_merkle_manifest"):
        text = documents[row.doc_id].text
        even = zlib.crc32(str(row.doc_id).encode()) % 2 == 0
        assert row.verified == (not (even and text is not None and "\n" in text))
        assert row.verified == (row.folded_root == row.root)
        assert len(row.proof_sha256) == len(hashlib.sha256().hexdigest())
