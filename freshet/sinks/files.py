"""File sinks for batches and streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter


def write_text(df: DataFrame, line: Column, path: str, mode: str = "errorifexists") -> None:
    """One line per row; one file per task."""
    df.select(line.cast("string").alias("value")).write.mode(mode).text(path)


def append_text(df: DataFrame, line: Column, path: str) -> None:
    """Add lines to a folder. Tasks write their own files and never share a handle."""
    write_text(df, line, path, mode="append")


def stream_to_text(df: DataFrame, line: Column, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream as UTF-8 text files, each row exactly once."""
    text = df.select(line.cast("string").alias("value"))
    return text.writeStream.format("text").option("checkpointLocation", checkpoint).option("path", path)


def stream_to_parquet(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream as Parquet files, each row exactly once."""
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)


def stream_to_console(df: DataFrame, checkpoint: str | None = None, mode: str = "append") -> DataStreamWriter:
    """A stream shown on the driver's console."""
    writer = df.writeStream.format("console").outputMode(mode)
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer


def fan_out(sinks: Mapping[str, Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that computes a batch once and writes it to several sinks.

    A sink may see the same batch id again after a failure and must then replace
    what it wrote (see ``replace_batch``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks.values():
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def replace_batch(path: str, format: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A sink that keeps one folder per batch, so a repeated batch leaves no duplicate."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(format).save(f"{path}/batch_id={batch_id}")

    return write
