"""Sinks with a life cycle per task and a commit per batch.

Spark's Python data source interface runs them: each task opens the sink once, hands it Arrow
batches and closes it, which gives a message; when all tasks are done the driver commits their messages, and
after a failure it aborts what is left of them. A stream repeats a batch whose commit it has not noted, so
``commit`` sees a batch number more than once and must then change nothing.
"""

from __future__ import annotations

import json
import uuid
from abc import ABC, abstractmethod
from collections.abc import Iterator, Sequence
from copy import copy
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.streaming import DataStreamWriter


class TaskSink(ABC):
    """Where rows go. A task works on a copy of its own; ``commit`` and ``abort`` run on the driver."""

    @abstractmethod
    def open(self, partition: int, attempt: int) -> None: ...

    @abstractmethod
    def write(self, batch: pa.RecordBatch) -> None: ...

    @abstractmethod
    def close(self) -> Any:
        """All rows have been written; what is returned reaches ``commit``."""

    def abandon(self) -> None:
        """The task has failed after ``open``."""

    @abstractmethod
    def commit(self, messages: list[Any], batch: str) -> None: ...

    @abstractmethod
    def abort(self, messages: list[Any], batch: str) -> None: ...


@dataclass
class _Message(WriterCommitMessage):
    content: Any


def _run(sink: TaskSink, batches: Iterator[pa.RecordBatch]) -> _Message:
    own, task = copy(sink), TaskContext.get()
    own.open(task.partitionId(), task.attemptNumber())
    try:
        for batch in batches:
            own.write(batch)
        return _Message(own.close())
    except BaseException:
        own.abandon()
        raise


def _contents(messages: Sequence[_Message | None]) -> list[Any]:
    return [m.content for m in messages if m is not None]


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, sink: TaskSink):
        self.sink, self.job = sink, f"job-{uuid.uuid4().hex}"

    def write(self, iterator):
        return _run(self.sink, iterator)

    def commit(self, messages):
        self.sink.commit(_contents(messages), self.job)

    def abort(self, messages):
        self.sink.abort(_contents(messages), self.job)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, sink: TaskSink):
        self.sink = sink

    def write(self, iterator):
        return _run(self.sink, iterator)

    def commit(self, messages, batchId):  # noqa: N803
        self.sink.commit(_contents(messages), f"batch-{batchId}")

    def abort(self, messages, batchId):  # noqa: N803
        self.sink.abort(_contents(messages), f"batch-{batchId}")


def register(spark: SparkSession, sink: TaskSink) -> str:
    """Make a sink known to the session; the result is its format, for ``write`` and ``writeStream``."""
    known = f"task_sink_{uuid.uuid4().hex}"

    class Sink(DataSource):
        @classmethod
        def name(cls):
            return known

        def schema(self):
            return T.StructType()

        def writer(self, schema, overwrite):
            return _BatchWriter(sink)

        def streamWriter(self, schema, overwrite):  # noqa: N802
            return _StreamWriter(sink)

    spark.dataSource.register(Sink)
    return known


class TextFiles(TaskSink):
    """Lines of text (the first column) in files below a folder that all executors reach.

    Tasks write to ``_staging``. A commit moves their files to the folder and then names them in one
    manifest below ``_commits``; only files named there count, so a batch that fails
    half-way, or comes twice, leaves each of its rows once. Null is an empty line.
    """

    def __init__(self, path: str):
        self.path = path

    def _place(self) -> tuple[fs.FileSystem, str]:
        system, root = fs.FileSystem.from_uri(self.path if ":" in self.path else f"file://{self.path}")
        return system, root.rstrip("/")

    def open(self, partition, attempt):
        self.system, root = self._place()
        self.name, self.rows = f"part-{partition:05d}-{attempt}-{uuid.uuid4().hex}.txt", 0
        self.system.create_dir(f"{root}/_staging")
        self.staged = f"{root}/_staging/{self.name}"
        self.stream = self.system.open_output_stream(self.staged)

    def write(self, batch):
        lines = [line or "" for line in batch.column(0).to_pylist()]
        self.stream.write("".join(f"{line}\n" for line in lines).encode())
        self.rows += len(lines)

    def close(self):
        self.stream.close()
        return {"file": self.name, "rows": self.rows}

    def abandon(self):
        self.stream.close()
        self.system.delete_file(self.staged)

    def commit(self, messages, batch):
        system, root = self._place()
        manifest = f"{root}/_commits/{batch}.json"
        if system.get_file_info(manifest).type != fs.FileType.NotFound:
            self.abort(messages, batch)
            return
        for message in messages:
            system.move(f"{root}/_staging/{message['file']}", f"{root}/{message['file']}")
        system.create_dir(f"{root}/_commits")
        with system.open_output_stream(f"{root}/_staging/{batch}.json") as out:
            out.write("".join(json.dumps(m) + "\n" for m in messages).encode())
        system.move(f"{root}/_staging/{batch}.json", manifest)

    def abort(self, messages, batch):
        system, root = self._place()
        for message in messages:
            staged = f"{root}/_staging/{message['file']}"
            if system.get_file_info(staged).type != fs.FileType.NotFound:
                system.delete_file(staged)


def text_stream(df: DataFrame, line: Column, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream as committed lines of text."""
    text = df.select(line.cast("string").alias("value"))
    return text.writeStream.format(register(df.sparkSession, TextFiles(path))).option("checkpointLocation", checkpoint)


def write_text(df: DataFrame, line: Column, path: str) -> None:
    """Append the lines of a batch; they count all or not at all."""
    df.select(line.cast("string").alias("value")).write.format(register(df.sparkSession, TextFiles(path))).mode("append").save()


def committed_text(spark: SparkSession, path: str) -> DataFrame:
    """The committed lines (value), an empty frame before the first commit."""
    system, root = TextFiles(path)._place()
    if system.get_file_info(f"{root}/_commits").type == fs.FileType.NotFound:
        return spark.createDataFrame([], "value string")
    names = spark.read.schema("file string, rows bigint").json(f"{path}/_commits").where("rows > 0").select("file")
    files = [f"{path}/{row.file}" for row in names.collect()]
    return spark.read.text(files).select("value") if files else spark.createDataFrame([], "value string")
