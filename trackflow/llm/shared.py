"""Helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import trackflow
from trackflow.session import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once a session, as an archive."""
    context = spark.sparkContext
    if getattr(context, "_trackflow_code", None):
        return
    root = Path(trackflow.__file__).parent
    folder = tempfile.TemporaryDirectory(ignore_cleanup_errors=True)  # executors fetch from it
    archive = Path(folder.name) / "trackflow.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._trackflow_code = folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows, written once to the folder the cluster shares, so that no later job repeats them.

    The folder is ``spark.checkpoint.dir``; a session without it gets one (tests only).
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


def whole_text(column: str = "text") -> Column:
    """The text; a null one is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text, so that other columns, whatever their names, cannot clash."""
    return docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text"))


def give_back() -> None:
    """Return freed memory to the system; a worker that is used again would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library may lack it
    if trim:
        trim(0)


def per_text(
    docs: DataFrame,
    schema: str,
    rows_of: Callable[[str], list[tuple]],
    key: str = "doc_id",
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """Rows made from each whole text: the document's key and what ``rows_of`` gives.

    ``schema`` names the columns that follow the key. Texts are taken from the Arrow batch one
    at a time, and rows go out in small batches. ``done`` runs at the end of each task, to free
    what ``rows_of`` keeps; the worker then gives its free memory back.
    """
    source = text_rows(docs, key)
    key_type = source.schema["doc_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    full = f"doc_id {key_type}, {schema}"
    arrow = to_arrow_schema(_parse_datatype_string(full))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            out: list[tuple] = []
            for i in range(batch.num_rows):
                key_value = keys[i].as_py()
                out += [(key_value, *row) for row in rows_of(texts[i].as_py())]
                if len(out) >= 2000:
                    yield _batch(out, arrow)
                    out = []
            if out:
                yield _batch(out, arrow)
            del batch, keys, texts, out
        if done:
            done()
        give_back()

    return source.mapInArrow(run, full)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    arrays = [pa.array(values, type=field.type) for values, field in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
