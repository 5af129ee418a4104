"""Reversible line deduplication: sharded cuckoo filters over exact reference counts.

An index keeps, in tables under one folder, the exact postings (line key, document), the keys
held by at least two documents with their count and smallest document, and one cuckoo filter per
shard of the keys. Inserting documents asks the filters first: keys that no filter knows are new,
and only the others are looked up in the exact postings. Deleting documents removes their
postings, lowers the counts, and takes keys without documents out of the filters; texts resolved
afterwards get back the lines that the deleted documents had claimed.

A line's key is the line without white space at its ends, A-Z lower-cased; keys shorter than
``LEAST`` code points are ignored. Keys are held as 128-bit hashes.

Defined results: a null or empty text is one empty line and stays empty. A null doc_id holds no
keys and loses no lines. Rows with equal doc_id count as one document; each row is resolved by
itself. An empty table gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.llm.shared import cut_lineage, per_text, text_rows
from trackflow.session import remove_path

LEAST = 10
EDGES = b" \t\n\x0b\x0c\r"
SHARDS = 64
SLOTS = 4
KICKS = 200
START_BUCKETS = 1_024
FULL = 0.9


def line_keys(text: str) -> list[tuple[bytes, tuple[int, int] | None]]:
    """Each line's bytes and its key; None for keys that are too short."""
    found = []
    for line in text.encode().split(b"\n"):
        key = line.strip(EDGES).lower()
        enough = len(key) >= LEAST and len(key.decode()) >= LEAST
        digest = struct.unpack(">qq", xxhash.xxh3_128_digest(key)) if enough else None
        found.append((line, digest))
    return found


class Cuckoo:
    """A cuckoo filter of 16-bit fingerprints, in layers: a full layer gets a larger one on top.

    All operations take arrays of keys. A layer is a table of buckets; a key belongs to two of
    them, the second found from the first and the fingerprint, so entries can move without keys.
    """

    def __init__(self, layers: list[np.ndarray] | None = None):
        self.layers = layers or [np.zeros((START_BUCKETS, SLOTS), np.uint16)]

    @classmethod
    def load(cls, data: bytes) -> Cuckoo:
        layers, at = [], 0
        while at < len(data):
            size = int.from_bytes(data[at : at + 8], "little")
            raw = data[at + 8 : at + 8 + size]
            layers.append(np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy())
            at += 8 + size
        return cls(layers)

    def dump(self) -> bytes:
        raw = [layer.tobytes() for layer in self.layers]
        return b"".join(len(x).to_bytes(8, "little") + x for x in raw)

    @staticmethod
    def _prints(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = (lo.astype(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)
        return np.maximum(prints, 1), hi.astype(np.uint64) >> np.uint64(8)

    @staticmethod
    def _other(place: np.ndarray, prints: np.ndarray, mask: int) -> np.ndarray:
        return (place ^ (prints.astype(np.int64) * 0x5BD1E995)) & mask

    def _places(self, layer: np.ndarray, hi: np.ndarray, prints: np.ndarray):
        mask = len(layer) - 1
        first = (hi & np.uint64(mask)).astype(np.int64)
        return first, self._other(first, prints, mask)

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        prints, spread = self._prints(hi, lo)
        found = np.zeros(len(hi), bool)
        for layer in self.layers:
            for place in self._places(layer, spread, prints):
                found |= (layer[place] == prints[:, None]).any(axis=1)
        return found

    @staticmethod
    def _settle(layer: np.ndarray, place: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Put at most one entry into each bucket with room; which of the entries went in."""
        done = np.zeros(len(place), bool)
        free = (layer[place] == 0).any(axis=1)
        candidates = np.flatnonzero(free)
        _, first = np.unique(place[candidates], return_index=True)
        chosen = candidates[first]
        layer[place[chosen], (layer[place[chosen]] == 0).argmax(axis=1)] = prints[chosen]
        done[chosen] = True
        return done

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> None:
        prints, spread = self._prints(hi, lo)
        wait = np.arange(len(hi))
        while len(wait):
            layer = self.layers[-1]
            room = int(layer.size * FULL) - int((layer != 0).sum())
            if room <= 0:
                buckets = 1 << int(np.ceil(np.log2(max(2 * len(layer), len(wait) / 2))))
                self.layers.append(np.zeros((buckets, SLOTS), np.uint16))
                continue
            part, wait = wait[:room], wait[room:]
            left = self._insert(layer, spread[part], prints[part])
            if left is not None:
                self._stash(len(layer), *left)
                self.layers.append(np.zeros((2 * len(layer), SLOTS), np.uint16))

    def _insert(self, layer: np.ndarray, spread: np.ndarray, prints: np.ndarray):
        first, second = self._places(layer, spread, prints)
        mask = len(layer) - 1
        place, turn = first, np.zeros(len(first), bool)
        for step in range(KICKS):
            done = self._settle(layer, place, prints)
            place, prints, turn = place[~done], prints[~done], turn[~done]
            if not len(place):
                return None
            other = self._other(place, prints, mask)
            full = (layer[place] != 0).all(axis=1)
            both = full & turn & (layer[other] != 0).all(axis=1)
            victims = np.flatnonzero(both)
            _, firsts = np.unique(place[victims], return_index=True)
            victims = victims[firsts]
            slot = (step + place[victims]) % SLOTS
            out = layer[place[victims], slot].copy()
            layer[place[victims], slot] = prints[victims]
            prints = prints.copy()
            prints[victims] = out
            place = np.where(full, self._other(place, prints, mask), place)
            turn = turn | full
        return place, prints

    def _stash(self, width: int, places: np.ndarray, prints: np.ndarray) -> None:
        """Entries that found no room, known only by bucket and fingerprint: more layers of that
        width, in which the same key looks at the same buckets."""
        while len(places):
            layer = np.zeros((width, SLOTS), np.uint16)
            while (done := self._settle(layer, places, prints)).any():
                places, prints = places[~done], prints[~done]
            self.layers.insert(0, layer)

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Remove one entry of each key; all keys must be in the filter, each once.

        Layers differ in size, so equal fingerprints in one may stand for different keys of
        another. An entry goes only where a single layer may hold its key; else it stays, and a
        key that is gone is asked for once more in the exact tables, which never do harm.
        """
        prints, spread = self._prints(hi, lo)
        hits = np.zeros((len(self.layers), len(prints)), bool)
        for n, layer in enumerate(self.layers):
            for place in self._places(layer, spread, prints):
                hits[n] |= (layer[place] == prints[:, None]).any(axis=1)
        alone = hits.sum(axis=0) == 1
        for layer, hit in zip(self.layers, hits):
            wait = np.flatnonzero(hit & alone)
            while len(wait):
                first, second = self._places(layer, spread[wait], prints[wait])
                mine = prints[wait][:, None]
                place = np.where((layer[first] == mine).any(axis=1), first, second)
                match = layer[place] == mine
                entry = place * SLOTS + match.argmax(axis=1)
                entry[~match.any(axis=1)] = -1
                taken, chosen = np.unique(entry, return_index=True)
                chosen = chosen[taken >= 0]
                layer.reshape(-1)[entry[chosen]] = 0
                left = entry >= 0
                left[chosen] = False
                wait = wait[left]


def _filter_of(filters: pd.DataFrame) -> Cuckoo:
    return Cuckoo.load(filters["filter"].iloc[0]) if len(filters) else Cuckoo()


def _known(filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
    """Those of a shard's keys that its filter may know."""
    hi, lo = keys["hi"].to_numpy(np.int64), keys["lo"].to_numpy(np.int64)
    return keys[["hi", "lo"]][_filter_of(filters).contains(hi, lo)]


def _changed(delete: bool):
    def run(filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        """A shard's filter with its keys put in or taken out."""
        shard = int((keys if len(keys) else filters)["shard"].iloc[0])
        cuckoo = _filter_of(filters)
        hi, lo = keys["hi"].to_numpy(np.int64), keys["lo"].to_numpy(np.int64)
        (cuckoo.delete if delete else cuckoo.insert)(hi, lo)
        return pd.DataFrame({"shard": [shard], "filter": [cuckoo.dump()]})

    return run


class LineIndex:
    """The tables of one index in ``folder``; every change writes a new generation of them.

    ``shards`` divides the keys; take one for each million of keys or so.
    """

    def __init__(self, spark: SparkSession, folder: str, shards: int = SHARDS):
        self.spark, self.folder, self.shards = spark, folder.rstrip("/"), shards
        self.generation = 0
        self.tables: dict[str, str | None] = dict.fromkeys(("postings", "repeated", "filters"))

    def _read(self, name: str) -> DataFrame | None:
        path = self.tables[name]
        return self.spark.read.parquet(path) if path else None

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}-{self.generation}"
        df.write.mode("overwrite").parquet(path)
        self.tables[name] = path
        return self.spark.read.parquet(path)

    def _sharded(self, keys: DataFrame) -> DataFrame:
        return keys.withColumn("shard", F.pmod("hi", F.lit(self.shards)).cast("int"))

    def _change_filters(self, keys: DataFrame, delete: bool) -> None:
        filters = self._read("filters")
        if filters is None:
            filters = self.spark.createDataFrame([], "shard int, filter binary")
        groups = self._sharded(keys).groupBy("shard")
        changed = filters.groupBy("shard").cogroup(groups)
        self._write(
            "filters", changed.applyInPandas(_changed(delete), "shard int, filter binary")
        )

    def _maybe(self, keys: DataFrame) -> DataFrame:
        groups = self._sharded(keys).groupBy("shard")
        filters = self._read("filters")
        return cut_lineage(
            filters.groupBy("shard").cogroup(groups).applyInPandas(_known, "hi long, lo long")
        )

    def insert(self, docs: DataFrame) -> None:
        """Add documents; ids already in the index count once."""
        self.generation += 1
        new = postings_of(docs).distinct()
        old, repeated = self._read("postings"), self._read("repeated")
        if old is not None:
            new = new.join(old, ["doc_id", "hi", "lo"], "left_anti").unionByName(old)
            before = old.select("hi", "lo")
        postings = self._write("postings", new)
        counts = cut_lineage(refs(postings if old is None else postings.join(
            old, ["doc_id", "hi", "lo"], "left_anti")))
        if old is None:
            self._write("repeated", counts.where("n > 1"))
            self._change_filters(counts.select("hi", "lo"), False)
            return
        maybe = self._maybe(counts.select("hi", "lo"))
        held = old.join(maybe, ["hi", "lo"], "left_semi")
        both = merged(counts.unionByName(refs(held)))
        fresh = counts.select("hi", "lo").join(
            before.join(maybe, ["hi", "lo"], "left_semi"), ["hi", "lo"], "left_anti"
        )
        changed = both.where("n > 1")
        kept = repeated.join(counts, ["hi", "lo"], "left_anti")
        self._write("repeated", kept.unionByName(changed))
        self._change_filters(fresh, False)

    def delete(self, doc_ids: DataFrame) -> None:
        """Remove documents by ``doc_id``."""
        if self.tables["postings"] is None:
            return
        self.generation += 1
        old, repeated = self._read("postings"), self._read("repeated")
        ids = doc_ids.select("doc_id")
        touched = cut_lineage(
            old.join(ids, "doc_id", "left_semi").select("hi", "lo").distinct()
        )
        postings = self._write("postings", old.join(ids, "doc_id", "left_anti"))
        left = cut_lineage(refs(postings.join(touched, ["hi", "lo"], "left_semi")))
        kept = repeated.join(touched, ["hi", "lo"], "left_anti")
        self._write("repeated", kept.unionByName(left.where("n > 1")))
        self._change_filters(touched.join(left, ["hi", "lo"], "left_anti"), True)

    def drops(self, docs: DataFrame) -> DataFrame:
        """``doc_id, drops``: the keys whose lines a document loses under the index as it is."""
        return cut_lineage(
            postings_of(docs)
            .join(self._read("repeated").drop("n"), ["hi", "lo"])
            .where("doc_id <> first")
            .groupBy("doc_id")
            .agg(F.collect_set(F.struct("hi", "lo")).alias("drops"))
        )

    def resolve(self, docs: DataFrame) -> DataFrame:
        """``doc_id, n_lines, n_dropped, kept`` of documents under the index as it is now."""
        return _without(text_rows(docs).join(self.drops(docs), "doc_id", "left"))

    def drop(self) -> None:
        remove_path(self.spark, self.folder)


def postings_of(docs: DataFrame) -> DataFrame:
    """``hi, lo, doc_id``: the keys of each document, once a row."""
    return per_text(
        docs.where(F.col("doc_id").isNotNull()),
        "hi long, lo long",
        lambda text: list({key for _, key in line_keys(text) if key}),
    ).select("hi", "lo", F.col("doc_id").cast("long").alias("doc_id"))


def refs(postings: DataFrame) -> DataFrame:
    """Each key's number of documents and the smallest of them."""
    return postings.groupBy("hi", "lo").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first")
    )


def merged(counts: DataFrame) -> DataFrame:
    return counts.groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.min("first").alias("first"))


def kept_lines(text: str, drops: Iterable) -> tuple[int, int, str]:
    """Lines, lines dropped, and the text of the others."""
    gone = {(d["hi"], d["lo"]) for d in drops}
    lines = line_keys(text)
    kept = [line for line, key in lines if key not in gone]
    return len(lines), len(lines) - len(kept), b"\n".join(kept).decode()


def kept_text(text: Column, drops: Column) -> Column:
    """A text column without the lines that ``drops`` names; null stays null."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series(
            [
                t if t is None or d is None else kept_lines(t, d)[2]
                for t, d in zip(texts, gone, strict=True)
            ],
            dtype=object,
        )

    return run(text, drops)


def _without(rows: DataFrame) -> DataFrame:
    key_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key_type}, n_lines long, n_dropped long, kept string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                drops = batch.column(2)[i].as_py() or ()
                out.append(kept_lines(batch.column(1)[i].as_py(), drops))
            columns = list(zip(*out, strict=True)) if out else [(), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
            names = ["doc_id", "n_lines", "n_dropped", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    return rows.mapInArrow(run, schema)
