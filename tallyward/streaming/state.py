"""Streams that remember: rows above their group's high-water mark, and payloads that were not seen before."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..shipping import ship

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class Marks(StatefulProcessor):
    """State of a group: the largest number so far. A batch's rows are held against the mark from before the batch, so that a
    number may have many rows; they pass through one piece at a time."""

    def __init__(self, number: str):
        self.number = number

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("mark", "mark long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        stored = initialState[self.number].max()
        if pd.notna(stored) and (not self.mark.exists() or stored > self.mark.get()[0]):
            self.mark.update((int(stored),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.mark.get()[0] if self.mark.exists() else 0
        top = before
        for part in rows:
            fresh = part[part[self.number] > before]
            if len(fresh):
                top = max(top, int(fresh[self.number].max()))
                yield fresh
        if top > before:
            self.mark.update((top,))

    def close(self) -> None:
        pass


def above_marks(rows: DataFrame, group: list[str], number: str, stored: DataFrame | None = None) -> DataFrame:
    """Rows of a stream numbered above all that their group had in earlier batches, or in `stored` (group and number) before
    the first; 0 where there is none. Rows without a number go. The mark is state under the query's checkpoint, so a query
    that is started anew goes on where it was; it needs ROCKS as state store (see run)."""
    ship(rows.sparkSession)
    start = None if stored is None else stored.groupBy(*group).agg(F.max(number).cast("long").alias(number)).groupBy(*group)
    return rows.where(F.col(number).isNotNull()).groupBy(*group).transformWithStateInPandas(Marks(number), rows.schema, "Append", "None", start)


def new_payloads(rows: DataFrame, kind: str, payload: str, at: str, keep: str = "1 day") -> DataFrame:
    """Rows of a stream with content_hash, of each (kind, content_hash) the first within `keep` of event time. The watermark
    bounds the state: a hash is forgotten once the watermark is past its row by `keep`, and rows behind the watermark go."""
    hashed = rows.withColumn("content_hash", F.sha2(F.coalesce(F.col(payload).cast("string"), F.lit("")), 256))
    return hashed.withWatermark(at, keep).dropDuplicatesWithinWatermark([kind, "content_hash"])


def run(out: DataFrame, path: str) -> DataFrame:
    """Run a stream to the end of what is there, appending to the table below path, and give the table. The file sink's log
    makes a repeated batch count once; a later run goes on from the checkpoint."""
    spark: SparkSession = out.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKS)
    try:
        query = out.writeStream.format("parquet").option("path", f"{path}/table").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
    return spark.read.schema(out.schema).parquet(f"{path}/table")
