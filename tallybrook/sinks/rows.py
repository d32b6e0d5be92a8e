"""Effects per row, with set-up and clean-up per task, for tables and streams."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Protocol

from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StreamingQuery

from tallybrook.session import let_workers_import


class RowWriter(Protocol):
    """What is done with rows. It is sent to every task and opened there once per epoch.

    `open` gets the number of the task and of the epoch, which together name the same rows
    whenever a task runs again: a writer that keys its effect by them has it once. Where it
    returns False the rows are passed over. `close` is called in every case, with the
    error, if there was one.
    """

    def open(self, partition_id: int, epoch_id: int) -> bool: ...

    def process(self, row: Row) -> None: ...

    def close(self, error: Exception | None) -> None: ...


def for_each_row(rows: DataFrame, writer: RowWriter, epoch_id: int = 0) -> None:
    """Hand every row of a table to the writer, in the tasks that hold them."""

    let_workers_import(rows.sparkSession)

    def run(part: Iterator[Row]) -> None:
        error: Exception | None = None
        try:
            if writer.open(TaskContext.get().partitionId(), epoch_id):
                for row in part:
                    writer.process(row)
        except Exception as raised:
            error = raised
            raise
        finally:
            writer.close(error)

    rows.foreachPartition(run)


def write_rows(stream: DataFrame, writer: RowWriter, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Hand every row of a stream to the writer; an epoch is a micro-batch."""
    let_workers_import(stream.sparkSession)
    started = stream.writeStream.foreach(writer).option("checkpointLocation", checkpoint)
    return (started.trigger(availableNow=True) if interval is None else started.trigger(processingTime=interval)).start()


class LineFiles:
    """A writer of JSON lines: a file per task and epoch, put in place when it is whole.

    A task that runs again, for one lost or cut short, replaces its own file. The folder
    must be one that all tasks reach through Arrow.
    """

    def __init__(self, folder: str) -> None:
        self.folder = re.sub("^file:/+", "/", folder)

    def open(self, partition_id: int, epoch_id: int) -> bool:
        attempt = TaskContext.get().taskAttemptId()
        self.system, top = FileSystem.from_uri(self.folder)
        self.target = f"{top}/epoch-{epoch_id}-task-{partition_id}.json"
        # Names with a leading underscore are not read as data.
        self.begun = f"{top}/_begun-{epoch_id}-{partition_id}-{attempt}"
        if isinstance(self.system, LocalFileSystem):
            self.system.create_dir(top, recursive=True)
        self.stream = self.system.open_output_stream(self.begun)
        return True

    def process(self, row: Row) -> None:
        self.stream.write((json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str) + "\n").encode())

    def close(self, error: Exception | None) -> None:
        if not hasattr(self, "stream"):
            return
        self.stream.close()
        if error is None:
            self.system.move(self.begun, self.target)
        else:
            self.system.delete_file(self.begun)
