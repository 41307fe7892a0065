"""Search indexes, brokers and the like as a Spark sink, with the transport given.

Spark's writer protocol does the bookkeeping: every task hands its documents over in
batches and reports which batches arrived, and only when all tasks are done are the batches
of the successful attempts committed; if the job fails, what was handed over is taken back.
A batch that fails is tried again, a task that fails is tried again by Spark under another
attempt, whose batches have other names, so nothing is lost and nothing counts twice.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from .shared import ship_package

BATCH_DOCUMENTS = 500
ATTEMPTS = 5
WAIT_SECONDS = 0.5


class Transport(Protocol):
    """What a target has to offer; it is sent to the tasks, so it has to be picklable.

    ``stage`` takes a batch under a name, and again under the same name if the first call
    failed, whether or not the documents had arrived by then. ``commit`` makes the batches
    of these names count, ``abort`` forgets them; both may be called again. A target that
    cannot stage takes documents at once and overwrites by key: then a job that fails in
    between leaves documents that its repetition replaces.
    """

    def stage(self, name: str, documents: list[dict]) -> None: ...

    def commit(self, names: list[str]) -> None: ...

    def abort(self, names: list[str]) -> None: ...


@dataclass
class Arrived(WriterCommitMessage):
    """Batches and number of documents of a task."""

    names: list[str]
    documents: int


def _persistently(call, attempts: int, wait: float) -> None:
    for attempt in range(attempts):
        try:
            return call()
        except Exception:
            if attempt == attempts - 1:
                raise
            time.sleep(wait * 2**attempt)


class TransportWriter(DataSourceWriter):
    def __init__(self, transport: Transport, size: int, attempts: int, wait: float):
        self.transport, self.size, self.attempts, self.wait = transport, size, attempts, wait
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Arrived:
        context, names, documents, count = TaskContext.get(), [], [], 0
        task = f"{self.job}-{context.partitionId()}-{context.taskAttemptId()}"

        def hand_over() -> None:
            name = f"{task}-{len(names)}"
            names.append(name)
            batch = list(documents)
            _persistently(lambda: self.transport.stage(name, batch), self.attempts, self.wait)
            documents.clear()

        try:
            for row in iterator:
                documents.append(row.asDict(recursive=True))
                count += 1
                if len(documents) >= self.size:
                    hand_over()
            if documents:
                hand_over()
        except Exception:
            # What this attempt handed over is known here only.
            self.transport.abort(names)
            raise
        return Arrived(names, count)

    def commit(self, messages: list[Arrived | None]) -> None:
        names = [name for message in messages if message for name in message.names]
        _persistently(lambda: self.transport.commit(names), self.attempts, self.wait)

    def abort(self, messages: list[Arrived | None]) -> None:
        self.transport.abort([name for message in messages if message for name in message.names])


def transport_source(
    transport: Transport, name: str, *, size: int = BATCH_DOCUMENTS, attempts: int = ATTEMPTS, wait: float = WAIT_SECONDS
) -> type[DataSource]:
    """A data source class that writes through the transport, to be registered."""

    class TransportSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> TransportWriter:
            return TransportWriter(transport, size, attempts, wait)

    return TransportSource


def write_documents(df: DataFrame, transport: Transport, **options) -> None:
    """Hand all rows to the transport, as dictionaries by column. Names of batches pass
    through the driver, one for ``size`` documents. An empty frame commits no batch."""
    spark = df.sparkSession
    ship_package(spark)
    name = f"transport_{uuid.uuid4().hex}"
    spark.dataSource.register(transport_source(transport, name, **options))
    df.write.format(name).mode("append").save()
