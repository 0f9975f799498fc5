"""Starting streams, waiting for them, and reading what they wrote."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from freshet.plans.scratch import fresh_folder
from freshet.sinks.files import stream_to_parquet


def drain(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything available now, then stop.

    The checkpoint keeps the source position and all operator state; a later
    call with the same folders continues where this one ended, also after a
    failure.
    """
    query = stream_to_parquet(df, path, checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def start_continuous(df: DataFrame, path: str, checkpoint: str, every: str = "1 second") -> StreamingQuery:
    """Run on the engine clock: one micro-batch, and one watermark step, per ``every``."""
    return stream_to_parquet(df, path, checkpoint).trigger(processingTime=every).start()


def start_updating(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str = "1 second"
) -> StreamingQuery:
    """Like ``start_continuous``, but hands every changed result to ``write`` as it changes (update mode)."""
    writer = df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start()


def drained_table(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Drain a stream into the shared folder and read the result back."""
    folder = fresh_folder(spark, label)
    drain(df, f"{folder}/data", f"{folder}/checkpoint")
    return spark.read.schema(df.schema).parquet(f"{folder}/data")


class ProgressLog(StreamingQueryListener):
    """What each finished micro-batch read, held as state and dropped as late, of every query.

    Register it with ``spark.streams.addListener`` before a query starts: the engine itself
    only remembers its latest micro-batches. ``ended`` has the ids of finished queries.
    """

    def __init__(self):
        self.entries: list[dict] = []
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.entries.append({"run": str(event.progress.runId), **_entry(json.loads(event.progress.json))})

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.add(str(event.runId))

    def of(self, query: StreamingQuery, patience: float = 30.0) -> list[dict]:
        """The entries of a query; waits for the last ones if it has ended."""
        until = time.monotonic() + patience
        while not query.isActive and str(query.runId) not in self.ended and time.monotonic() < until:
            time.sleep(0.05)
        return [{k: v for k, v in e.items() if k != "run"} for e in self.entries if e["run"] == str(query.runId)]


def _entry(p: dict) -> dict:
    return {
        "batch": p["batchId"],
        "rows": p["numInputRows"],
        "watermark": (p.get("eventTime") or {}).get("watermark"),
        "state_rows": sum(s["numRowsTotal"] for s in p["stateOperators"]),
        "late_rows": sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]),
    }


def latest_progress(query: StreamingQuery) -> list[dict]:
    """The micro-batches the engine still remembers (``spark.sql.streaming.numRecentProgressUpdates``);
    for all of them use ``ProgressLog``."""
    return [_entry(p) for p in query.recentProgress]
