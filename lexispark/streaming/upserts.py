"""A streaming front end of the upsert: landed events are folded into snapshots batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lexispark.operators import store


class Snapshots:
    """Numbered snapshots below a path. A batch writes the snapshot of its number once; a replayed batch changes nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self) -> list[int]:
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found = []
        for s in fs.listStatus(root):
            done = jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")
            if s.getPath().getName().startswith("batch=") and fs.exists(done):
                found.append(int(s.getPath().getName()[6:]))
        return sorted(found)

    def latest(self, before: int | None = None) -> DataFrame | None:
        numbers = [n for n in self._numbers() if before is None or n < before]
        return self.spark.read.parquet(f"{self.path}/batch={numbers[-1]}") if numbers else None

    def apply(self, events: DataFrame, number: int) -> None:
        if number in self._numbers():
            return
        old = self.latest(number)
        new = store.fold(events) if old is None else store.upsert(old, events)
        new.write.mode("overwrite").parquet(f"{self.path}/batch={number}")


def upsert_stream(events: DataFrame, snapshots: Snapshots, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Fold a stream of scored candidate events into snapshots."""
    writer = events.writeStream.foreachBatch(lambda batch, number: snapshots.apply(batch, number)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
