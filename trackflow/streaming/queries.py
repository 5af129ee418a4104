"""Starting streaming queries."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

TRIGGER = "1 second"

BatchSink = Callable[[DataFrame, int], None]

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _state_store(spark: SparkSession, provider: str | None) -> Iterator[None]:
    """A query takes the settings it starts with; the session gets its own back."""
    if provider is None:
        yield
        return
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, provider)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``None`` drains what is there and stops."""
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start_query(
    df: DataFrame,
    sink: str | BatchSink,
    name: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    format: str = "parquet",
    state_store: str | None = None,
) -> StreamingQuery:
    """Append a stream to a table.

    ``sink`` is a path (``format="table"``: a table name) or a function of one micro-batch and
    its id.  The function must give the same result when a batch comes twice.  ``state_store``
    is the provider that the state of this query needs; by default it is the session's.
    """
    writer = df.writeStream.outputMode("append").queryName(name)
    writer = _triggered(writer.option("checkpointLocation", checkpoint), trigger)
    with _state_store(df.sparkSession, state_store):
        if callable(sink):
            return writer.foreachBatch(sink).start()
        if format == "table":
            return writer.toTable(sink)
        return writer.format(format).start(sink)


def batch_writer(write: Callable[[DataFrame, str], None], path: str) -> BatchSink:
    """A sink that puts each micro-batch in its own folder, so that a repeat overwrites it."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        write(batch, f"{path}/batch_id={batch_id}")

    return sink


class SinkReport(StreamingQueryListener):
    """Logs the observed accepted and rejected counts of each micro-batch, and failures."""

    def __init__(self, logger: logging.Logger | None = None):
        self.logger = logger or logging.getLogger("trackflow.sinks")
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        self.logger.info("query %s started", event.name)

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            counts = row.asDict()
            total = self.totals.setdefault(name, dict.fromkeys(counts, 0))
            for key, count in counts.items():
                total[key] = total.get(key, 0) + count
            self.logger.info("sink %s: %s", name, counts)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.logger.error("query %s failed: %s", event.id, event.exception)


def drain(query: StreamingQuery) -> None:
    """Wait for a query that was started with ``trigger=None``."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def named_query(spark: SparkSession, name: str) -> StreamingQuery | None:
    return next((query for query in spark.streams.active if query.name == name), None)
