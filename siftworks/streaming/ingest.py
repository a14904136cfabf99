"""Incremental ingestion with Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.dedup import first_by_key, new_by_key


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None, glob: str | None = None) -> DataFrame:  # noqa: ANN001
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(path)


def distinct_stream(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The first of each key over the whole stream; state grows with the keys and survives restarts in the checkpoint."""
    return stream.dropDuplicates(keys)


def distinct_within(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first of each key within ``delay`` of event time, with bounded state; times without a zone are taken as the session's."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> None:
    """All that is there now, as Parquet, exactly once."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest_new(stream: DataFrame, index_path: str, key: str, order: list[str], checkpoint: str) -> StreamingQuery:
    """Appends to the Parquet index what it does not hold yet, the first of each key in a batch.

    A batch that runs again after a failure finds its own entries by their batch id and
    replaces them, so nothing is reserved before it is written and nothing is written twice.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = first_by_key(batch, F.col(key), order, "_key").drop("_key")
        if spark._jvm.org.apache.hadoop.fs.Path(index_path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(index_path)):
            known = spark.read.option("basePath", index_path).schema(batch.schema.simpleString()[7:-1].replace(":", " ") + ", batch_id long").parquet(index_path)
            first = new_by_key(first, known.where(F.col("batch_id") != batch_id), key)
        first.write.mode("overwrite").parquet(f"{index_path.rstrip('/')}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class StopAfterIdlePages(StatefulProcessor):
    """Per seed: pages and new items so far, and whether it stops: on an empty page or after ``idle`` pages without a new item."""

    OUTPUT = "seed string, pages int, saved long, idle int, stopped boolean"

    def __init__(self, idle: int = 20) -> None:
        self.most = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("progress", "pages int, saved long, idle int, stopped boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        pages, saved, idle, stopped = self.state.get() if self.state.exists() else (0, 0, 0, False)
        for page in sorted((r for b in rows for r in b.itertuples()), key=lambda r: r.page):
            if not stopped:
                pages, saved = pages + 1, saved + int(page.n_new)
                idle = 0 if page.n_new else idle + 1
                stopped = page.n_entries == 0 or idle >= self.most
        self.state.update((int(pages), int(saved), int(idle), bool(stopped)))
        yield pd.DataFrame({"seed": [key[0]], "pages": [pages], "saved": [saved], "idle": [idle], "stopped": [stopped]})

    def close(self) -> None:
        pass


def stop_rule(progress: DataFrame, idle: int = 20) -> DataFrame:
    """Stream of (seed, page, n_entries, n_new) to each seed's state after every batch. Needs the RocksDB state store."""
    return progress.groupBy("seed").transformWithStateInPandas(StopAfterIdlePages(idle), StopAfterIdlePages.OUTPUT, "Update", "None")
