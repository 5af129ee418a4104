"""Exact Jaccard join of shingle sets: a prefix join over groups of equal prefixes.

1. A document's set has one hash for each different run of ``WORDS`` words. Documents with equal
   sets are one class, represented by its smallest id.
2. All sets are put in one order: by hash, with shingles that occur in a notable share of the
   documents last. Two sets that reach the threshold share a shingle among the first
   ``n - ceil(t * n) + 1`` of both. Classes with the same prefix and size form a group.
3. Groups that meet at a prefix shingle are filtered by size, by the places of the shingle, and
   by parities: each set has ``BITS`` bits, each the parity of its shingles with that hash, and
   two sets differ in at least as many shingles as their parities differ in bits.
   First each class meets its group's leader, and each group two others at every shingle; what
   links there joins components. Then all remaining group pairs whose members lie in different
   components are expanded and filtered likewise, so no link between components is missed.
4. The pairs left are verified on whole sets; components follow from the links.

Hashes have 64 bits; equality of sets is judged by 128 bits.

Defined results: a text without words has an empty set and links with nothing; with fewer than
``WORDS`` words the whole sequence is one shingle. A null doc_id links with nothing. Rows with
equal doc_id are one node. An empty table gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackflow.llm.components import connected
from trackflow.llm.shared import cut_lineage, give_back, text_rows

WORDS = 3
PERCENT = 90
BITS = 512
WIDE_BITS = 8_192
BROADCAST_ROWS = 500_000
HEAVY_SHARE = 0.001
HEAVY_MOST = 500_000
COUNT_AT_ONCE = 2_000_000
CACHED_WORDS = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted hashes of the different shingles."""
    found = text.encode().lower().split()
    if not found:
        return np.empty(0, np.int64)
    each = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    count = min(words, len(found))
    mixed = np.full(len(found) - count + 1, count, np.uint64)
    for n in range(count):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX[0] + each[n : n + len(mixed)]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[1]
    return np.unique((mixed ^ (mixed >> np.uint64(32))).view(np.int64))


def _digest(found: np.ndarray) -> tuple[int, int]:
    return struct.unpack(">qq", xxhash.xxh3_128_digest(found.tobytes()))


def _sets(docs: DataFrame, words: int, share: float) -> DataFrame:
    """Kind 0: each document's id, set size and digest. Kind 1: shingles that are common here,
    with the number of documents here, to find those common everywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def common() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts >= max(4, share * len(held) / 2)
            return _batch(np.ones(many.sum()), tokens[many], counts[many], None, None)

        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                found = shingles(batch.column(1)[i].as_py(), words)
                rows.append((batch.column(0)[i].as_py(), len(found), *_digest(found)))
                held.append(found)
                size += len(found)
                if size >= COUNT_AT_ONCE:
                    yield common()
                    held, size = [], 0
            if rows:
                yield _batch(np.zeros(len(rows)), *zip(*rows, strict=True))
            del batch, rows
        if held:
            yield common()
        held = []
        _hashes.clear()
        give_back()

    def _batch(kind, key, n, hi, lo) -> pa.RecordBatch:
        nothing = [None] * len(kind)
        parts = (kind.astype(np.int8), key, n, hi or nothing, lo or nothing)
        kinds = (pa.int8(), *[pa.int64()] * 4)
        return pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(parts, kinds, strict=True)],
            ["kind", "key", "n", "hi", "lo"],
        )

    rows = text_rows(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "kind byte, key long, n long, hi long, lo long")


def _prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _per_set(docs: DataFrame, words: int, schema: str, make) -> DataFrame:
    """One row per document with a set: its id and what ``make`` gives."""
    from trackflow.llm.shared import per_text

    def rows(text: str) -> list[tuple]:
        found = shingles(text, words)
        return [make(found)] if len(found) else []

    docs = docs.where(F.col("doc_id").isNotNull())
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return per_text(docs, schema, rows, done=_hashes.clear)


def parities(found: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The parity of the number of hashes at each of so many places, packed into longs."""
    places = (found.view(np.uint64) >> np.uint64(40)) % np.uint64(bits)
    counts = np.bincount(places.astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def wide_parities(found: np.ndarray) -> np.ndarray:
    """More parities for sets too large for BITS; none for the others."""
    if len(found) < BITS:
        return np.empty(0, np.int64)
    return parities(found, WIDE_BITS)


def _prefixes(docs: DataFrame, heavy: np.ndarray, words: int, percent: int) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(heavy)

    def make(found: np.ndarray) -> tuple:
        want, common = _prefix_length(len(found), percent), shipped.value
        bits = parities(found).tolist()
        if len(common):
            at = np.minimum(np.searchsorted(common, found), len(common) - 1)
            late = common[at] == found
            found = np.concatenate([found[~late], found[late]])
        return found[:want].tolist(), bits

    return _per_set(docs, words, "prefix array<long>, bits array<long>", make)


def _verified(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` whose sets reach the threshold. Parities of many bits come
    before the sets, so that whole sets are made and moved only for pairs likely linked."""

    def joined(df: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        named = {c: f"{c}_{name}" for c in sets.columns if c != "doc_id"}
        return df.join(sets.withColumnsRenamed({"doc_id": name, **named}), name)

    narrow = _sets_of(
        docs,
        pairs,
        words,
        "n long, bits array<long>",
        lambda found: (len(found), wide_parities(found).tolist()),
    )
    near = joined(joined(pairs, narrow, "a"), narrow, "b")
    near = cut_lineage(near.where(_fits(percent, places=False)).select("a", "b"))
    sets = _sets_of(docs, near, words, "members array<long>", lambda found: (found.tolist(),))
    both = F.size(F.array_intersect("members_a", "members_b"))
    either = F.size("members_a") + F.size("members_b") - both
    whole = joined(joined(near, sets, "a"), sets, "b")
    return whole.where(100 * both >= percent * either).select("a", "b")


def _fits(percent: int, places: bool = True, bits: bool = True):
    """Whether two sets with these sizes and parities, meeting at these places of their orders,
    may still reach the threshold."""
    sizes = F.col("n_a") + F.col("n_b")
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    fits = 100 * small >= percent * large
    if bits:
        differ = F.aggregate(  # of unknown parities, an empty array, zip_with makes nulls
            F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
            F.lit(0),
            lambda s, x: s + F.coalesce(x, F.lit(0)),
        )
        fits = fits & ((100 + percent) * differ <= (100 - percent) * sizes)
    if not places:
        return fits
    rest = 1 + F.least(F.col("n_a") - F.col("place_a") - 1, F.col("n_b") - F.col("place_b") - 1)
    shared = F.least("place_a", "place_b") + rest
    return ((100 + percent) * shared >= percent * sizes) & fits


def jaccard_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``."""
    first = cut_lineage(_sets(docs, words, HEAVY_SHARE))
    rows = first.where("kind = 0").select(F.col("key").alias("doc_id"), "n", "hi", "lo")
    total = rows.count()
    heavy = (
        first.where("kind = 1")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= max(4, HEAVY_SHARE * total))
        .orderBy(F.desc("n"), "key")
        .limit(HEAVY_MOST)
    )
    common = np.sort(np.array([r[0] for r in heavy.select("key").collect()], np.int64))
    classes = (
        rows.where("doc_id is not null and n > 0")
        .groupBy("hi", "lo", "n")
        .agg(F.min("doc_id").alias("doc_id"))
    )
    classes = cut_lineage(classes)
    prefixed = cut_lineage(
        _prefixes(docs, common, words, percent)
        .join(classes.select("doc_id", "n"), "doc_id")
        .dropDuplicates(["doc_id"])
        .withColumn("p_hi", F.xxhash64("prefix", "n"))
        .withColumn("p_lo", F.xxhash64("n", "prefix"))
    )
    found = _links(docs, prefixed, words, percent)
    merged = classes.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "hi", "lo", "n", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return rows.join(merged, ["hi", "lo", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias(
            "component_id"
        ),
    )


def _side(df: DataFrame, name: str, *same: str) -> DataFrame:
    return df.select(*(F.col(c).alias(c if c in same else f"{c}_{name}") for c in df.columns))


def _links(docs: DataFrame, prefixed: DataFrame, words: int, percent: int) -> DataFrame:
    key = ["p_hi", "p_lo", "n"]
    groups = cut_lineage(
        prefixed.groupBy(*key).agg(
            F.min(F.struct("doc_id", "prefix", "bits")).alias("leader"), F.count("*").alias("size")
        )
    )
    several = groups.where("size > 1").select(*key, "leader.doc_id").withColumnsRenamed(
        {"doc_id": "group"}
    )
    members = cut_lineage(
        prefixed.select("doc_id", "bits", *key).join(several, key).select(
            "doc_id", "bits", "group", "n"
        )
    )
    places = _places(groups)
    bits = groups.select(F.col("leader.doc_id").alias("group"), "n", "leader.bits")
    pairs = cut_lineage(_first_pairs(places, bits, members, percent))
    links = cut_lineage(_verified(docs, pairs, words, percent))
    component = cut_lineage(connected(links))
    rest = cut_lineage(_rest(groups, members, places, component, percent))
    if rest.isEmpty():
        return component
    more = _verified(docs, rest, words, percent)
    return connected(links.unionByName(more))


def _places(groups: DataFrame) -> DataFrame:
    """``token, group, n, place``: prefix shingles that at least two groups have."""
    leaders = groups.select("n", F.col("leader.doc_id").alias("group"), "leader.prefix")
    places = leaders.select("group", "n", F.posexplode("prefix").alias("place", "token"))
    counted = places.withColumn("c", F.count("*").over(Window.partitionBy("token")))
    return cut_lineage(counted.where("c > 1").select("token", "group", "n", "place"))


def _first_pairs(
    places: DataFrame, bits: DataFrame, members: DataFrame, percent: int
) -> DataFrame:
    """``a, b``: each class with its group's leader, and each group with the first of its shingle
    and the one before it in size. Parities move only to the pairs that sizes and places leave."""
    order = Window.partitionBy("token").orderBy("n", "group")
    one = F.struct("n", "group", "place")
    two = F.array(F.min(one).over(order), F.lag(one).over(order))
    close = places.select(one.alias("x"), two.alias("two"))
    close = close.select("x", F.explode("two").alias("y")).where("y is not null")
    close = close.select(
        *(F.col(f"{x}.{c}").alias(f"{c}_{side}") for c in ("n", "group", "place")
          for x, side in (("y", "a"), ("x", "b")))
    )
    close = close.where((F.col("group_a") != F.col("group_b")) & _fits(percent, bits=False))
    close = close.select("group_a", "group_b").distinct()
    near = close.join(_side(bits, "a"), "group_a").join(_side(bits, "b"), "group_b")
    met = near.where(_fits(percent, places=False)).select(
        F.least("group_a", "group_b").alias("a"), F.greatest("group_a", "group_b").alias("b")
    )
    led = members.where("doc_id <> group").select(
        F.col("group").alias("a"), F.col("doc_id").alias("b")
    )
    return met.unionByName(led)


def _sets_of(docs: DataFrame, pairs: DataFrame, words: int, schema: str, make) -> DataFrame:
    """What ``make`` gives for the set of each document that the pairs name."""
    named = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    if named.count() <= BROADCAST_ROWS:  # else the texts are shuffled to the ids
        named = F.broadcast(named)
    wanted = text_rows(docs).join(named, "doc_id", "left_semi")
    return cut_lineage(_per_set(wanted, words, schema, make).dropDuplicates(["doc_id"]))


def _rest(
    groups: DataFrame, members: DataFrame, places: DataFrame, component: DataFrame, percent: int
) -> DataFrame:
    """All pairs of classes in different components whose sets may be linked."""
    component = component.withColumnRenamed("node", "doc_id")
    single = groups.where("size = 1").select(
        "leader.doc_id", "leader.bits", F.col("leader.doc_id").alias("group"), "n"
    )
    known = single.unionByName(members).join(component, "doc_id", "left")
    known = cut_lineage(known.withColumn("c", F.coalesce("component_id", "doc_id")))
    units = known.select("group", "c").distinct()
    parts = places.join(units, "group")
    mixed = parts.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high"))
    parts = parts.join(mixed.where("low < high").select("token"), "token")
    # a group of one class is judged by its own parities here, a wider one when it is expanded
    unknown = F.array().cast("array<long>")
    bits = groups.select(
        F.col("leader.doc_id").alias("group"),
        F.when(F.col("size") == 1, F.col("leader.bits")).otherwise(unknown).alias("bits"),
    )
    parts = parts.join(bits, "group")
    met = (
        _side(parts, "a", "token")
        .join(_side(parts, "b", "token"), "token")
        .where((F.col("c_a") < F.col("c_b")) & _fits(percent))
        .select("group_a", "c_a", "group_b", "c_b")
    )
    inner = members.select("group").distinct().join(units, "group")
    own = _side(inner, "a", "group").join(_side(inner, "b", "group"), "group").where("c_a < c_b")
    own = own.select(F.col("group").alias("group_a"), "c_a", F.col("group").alias("group_b"), "c_b")
    met = met.unionByName(own).distinct()
    known = known.select("doc_id", "group", "c", "n", "bits")
    pairs = met.join(_side(known, "a"), ["group_a", "c_a"]).join(
        _side(known, "b"), ["group_b", "c_b"]
    )
    return pairs.where(_fits(percent, places=False)).select(
        F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")
    ).distinct()

