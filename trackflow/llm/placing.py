"""Exact places of rows within groups of any size.

A window over a group would bring the whole group to one task. Here the rows are dealt by ranges
of (group, order), so that a large group lies over many tasks, and each task numbers its own
rows. A table with one row per (group, task) holds how many rows of the group lie before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackflow.session import remove_path, shared_folder


def placed(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, str]:
    """The rows with ``place`` (from 0, in their group) and ``n`` (rows of the group).

    ``group`` must not be null. Rows of equal order get different places, the same ones on every
    read: the rows are written first, with a number each. The second value is the folder that
    the caller removes after use. The columns ``_row``, ``_part`` and ``_at`` are taken.
    """
    spark = rows.sparkSession
    first, folder = shared_folder(spark, "rows"), shared_folder(spark, "placed")
    rows.withColumn("_row", F.monotonically_increasing_id()).write.parquet(first)
    by = [group, *order, "_row"]
    spread = spark.read.parquet(first).repartitionByRange(*by).sortWithinPartitions(*by)
    spread.withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}
    ).drop("_row").write.parquet(folder)
    remove_path(spark, first)
    numbered = spark.read.parquet(folder)
    parts = numbered.groupBy(group, "_part").agg(
        F.count("*").alias("_count"), F.min("_at").alias("_first")
    )
    of_group = Window.partitionBy(group)
    before = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        group,
        "_part",
        (F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_count").over(of_group).alias("n"),
    )
    joined = numbered.join(parts, [group, "_part"])
    place = (F.col("_at") + F.col("_shift")).alias("place")
    kept = [name for name in numbered.columns if name not in ("_part", "_at")]
    return joined.select(*kept, place, "n"), folder
