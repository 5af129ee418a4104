"""Merkle manifest of a table: one hash tree per source and one over the sources' roots.

Leaves of a source are cut into aligned blocks of ``BLOCK`` nodes. A block keeps each of its
levels as one string, the hex digests of its nodes one after the other, all of one width. Then
the parents are digests of substrings of ``ARITY`` widths, and what flanks a node in its
substring are its siblings: a proof needs no lookup of single nodes. Tops of blocks are the
nodes of the next tier, in blocks again, until one node is left; the roots of all sources are
the nodes of a last tree. Only blocks move between tasks; the texts are read once.

Defined results. Values that are null are written as ``-``; any null source is one source, which
comes first. Rows of one source with equal ids are ordered by their leaf, equal leaves as they
come; null ids come first. An empty table gives no rows. Texts of any length are hashed whole.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.llm.placing import placed
from trackflow.operators.hold import hold
from trackflow.session import remove_path, shared_folder

ARITY = 3
LEVELS = 5
BLOCK = ARITY**LEVELS
WIDTH = 64  # hex digits of a digest
RUN = ARITY * WIDTH


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def written(value: Column) -> Column:
    """A value as bytes that no other list of values can give: its size, a colon, its text."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest(*(written(value) for value in values))


def tree_key(source: Column) -> Column:
    """A text without nulls that sorts like the source, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _power(i: Column) -> Column:
    return F.pow(F.lit(ARITY), i).cast("long")


def parents(level: Column) -> Column:
    """The level above a level: digests of its substrings."""
    last = F.floor((F.length(level) - 1) / RUN).cast("int")
    each = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.sha2(F.substring(level, i * RUN + 1, F.lit(RUN)), 256),
    )
    return F.array_join(each, "")


def levels_of(nodes: Column, n: Column) -> Column:
    """All levels of a block of a tree with ``n`` nodes: up to its top, or to the last node."""
    steps = F.lit(0)
    for i in range(LEVELS):
        steps = steps + (n > ARITY**i).cast("int")
    lowest = F.array_join(F.transform(nodes, lambda node: node["hash"]), "")
    return F.aggregate(
        F.slice(F.array(*map(F.lit, range(LEVELS))), F.lit(1), steps),
        F.array(lowest),
        lambda levels, _: F.concat(levels, F.array(parents(F.element_at(levels, -1)))),
    )


def siblings(levels: Column, inside: Column) -> Column:
    """What stands left and right of a node and of its ancestors, from the lowest level up."""

    def flanks(level: Column, i: Column) -> Column:
        run = F.floor(inside / _power(i + 1)).cast("int") * RUN
        at = (F.floor(inside / _power(i)) % ARITY).cast("int") * WIDTH
        return F.struct(
            F.substring(level, run + 1, at).alias("left"),
            F.substring(level, run + at + WIDTH + 1, RUN - WIDTH - at).alias("right"),
        )

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), flanks)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def proof_text(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


class Forest:
    """Trees over ``tree, place, n, hash`` and other columns, which come back with each path.

    Its tables lie under ``folder``, one a tier.
    """

    def __init__(self, nodes: DataFrame, folder: str):
        spark = nodes.sparkSession
        self.tiers: list[DataFrame] = []
        while True:
            path = f"{folder}/{len(self.tiers)}"
            self._blocks(nodes).write.parquet(path)
            tier = spark.read.parquet(path)
            self.tiers.append(tier)
            nodes = tier.select(
                "tree",
                F.col("block").alias("place"),
                F.ceil(F.col("n") / BLOCK).alias("n"),
                F.element_at("levels", -1).alias("hash"),
            )
            if (tier.agg(F.max("block")).first()[0] or 0) == 0:
                break
        self.roots = nodes.select("tree", "hash")

    @staticmethod
    def _blocks(nodes: DataFrame) -> DataFrame:
        fields = [name for name in nodes.columns if name not in ("tree", "n")]
        block = F.floor(F.col("place") / BLOCK).alias("block")
        grouped = nodes.groupBy("tree", block).agg(
            F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct(*fields))).alias("nodes")
        )
        return grouped.withColumn("levels", levels_of(F.col("nodes"), F.col("n")))

    def paths(self, above: DataFrame) -> DataFrame:
        """Every node of the lowest level with its path to the end of that of its tree.

        ``above`` has ``tree``, ``path`` and other columns, one row a tree.
        """
        rows = above.withColumn("place", F.lit(0).cast("long"))
        for tier in reversed(self.tiers):
            extra = [n for n in rows.columns if n not in ("tree", "place", "path", "hash")]
            upper = rows.select("tree", F.col("place").alias("block"), "path", *extra)
            nodes = tier.join(upper, ["tree", "block"]).select(
                "tree", "levels", "path", *extra, F.explode("nodes").alias("node")
            )
            own = siblings(F.col("levels"), F.col("node.place") % BLOCK)
            rows = nodes.select(
                "tree", F.concat(own, F.col("path")).alias("path"), *extra, "node.*"
            )
        return rows


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``source, id, leaf`` and others) with ``subroot, root, path``.

    ``path`` holds the siblings, left and right, from the leaf to the root.
    """
    spark = leaves.sparkSession
    folder = shared_folder(spark, "manifest")
    keyed = leaves.withColumn("tree", tree_key(F.col("source"))).drop("source")
    nodes, used = placed(keyed.withColumnRenamed("leaf", "hash"), "tree", ["id", "hash"])
    trees = Forest(nodes, f"{folder}/leaves")
    remove_path(spark, used)
    tops = trees.roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("hash").alias("subroot")
    )
    tops, used = placed(tops, "tree", ["source"])
    whole = Forest(tops.withColumn("hash", F.col("subroot")), f"{folder}/sources")
    remove_path(spark, used)
    none = F.array().cast("array<struct<left: string, right: string>>")
    root = whole.roots.select("tree", F.col("hash").alias("root"), none.alias("path"))
    of_source = whole.paths(root).select(
        F.col("source").alias("tree"), "path", "subroot", "root"
    )
    return trees.paths(of_source).withColumnRenamed("hash", "leaf").drop("tree", "place")


def document_manifest(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, path, found`` of every document.

    ``found`` is the leaf of the text as met later: ``altered``, or the text itself. A document
    is as it was when ``folded(found, path)`` is the root.
    """
    fields = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    met = F.col("text") if altered is None else altered
    leaves = docs.select(
        "source",
        F.col("doc_id").alias("id"),
        leaf_of(*fields, F.col("text")).alias("leaf"),
        F.when(~met.eqNullSafe(F.col("text")), leaf_of(*fields, met)).alias("other"),
    )
    found = F.coalesce("other", "leaf").alias("found")
    proved = manifest(leaves).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("path").alias("made"), found
    )
    return hold(proved, "made", "path")
