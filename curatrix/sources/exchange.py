"""Request batches sent and answers fetched by executors, never through the driver.

``ExecutorBatches`` is a ``BatchClient``.  To submit, every task of the request table sends chunks of at most
``chunk`` requests and leaves two small files for each in ``folder``: an intent before and the service's id after.
A chunk's name is a hash of its requests, so a task that is repeated finds what it has sent: by the second
file, or, if it died between the two, by asking the service for the name.  When all tasks are done the ids
are committed as a manifest, whose name is the batch.  Requests are sorted within a task, and tasks get
them by a hash of their ids, so a repeated submit cuts the same chunks.

Answers are read page by page, a partition for each page; ``stream`` reads the pages that have come up
since the last micro-batch.  The driver holds a line for each chunk.

The service is told by ``module:function``, which gives an object with ``submit(requests, name) -> id``,
``find(name) -> id or None``, ``pages(id) -> (number of pages there are, whether no more will come)`` and
``page(id, n) -> list of dicts`` (custom_id, result_type, stop_reason, payload).
"""

from __future__ import annotations

import hashlib
import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

from .files import read_text, write_text

RESULTS = "custom_id string, result_type string, stop_reason string, payload string"


def service(named: str):
    module, function = named.split(":")
    return getattr(importlib.import_module(module), function)()


def _get(folder: str, name: str) -> str | None:
    return read_text(f"{folder}/{name}")


def _put(folder: str, name: str, text: str) -> None:
    write_text(f"{folder}/{name}", text)


def send(client, folder: str, requests: list[tuple[str, str]]) -> str:
    """The service's id of a chunk that is sent once, whatever came before."""
    name = hashlib.sha256(json.dumps(requests).encode()).hexdigest()[:32]
    sent = _get(folder, f"sent-{name}")
    if sent is None and _get(folder, f"intent-{name}") is not None:
        sent = client.find(name)  # it may have been sent by a task that died
    elif sent is None:
        _put(folder, f"intent-{name}", name)
    if sent is None:
        sent = client.submit([{"custom_id": i, "params": json.loads(p)} for i, p in requests], name)
    _put(folder, f"sent-{name}", sent)
    return sent


@dataclass
class Sent(WriterCommitMessage):
    ids: list[str]


class BatchWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.options = dict(options)

    def write(self, rows: Iterator) -> Sent:
        client, chunk, ids, held = service(self.options["service"]), int(self.options.get("chunk", 10_000)), [], []
        for row in rows:
            held.append((row["custom_id"], row["params"]))
            if len(held) == chunk:
                ids.append(send(client, self.options["folder"], held))
                held = []
        if held:
            ids.append(send(client, self.options["folder"], held))
        return Sent(ids)

    def commit(self, messages: list) -> None:
        ids = sorted({i for m in messages if m for i in m.ids})
        _put(self.options["folder"], f"manifest-{self.options['manifest']}", json.dumps(ids))

    def abort(self, messages: list) -> None:
        """What has been sent stays known by its name."""


class PagePartition(InputPartition):
    def __init__(self, batch: str, page: int):
        self.batch, self.page = batch, page


def _rows(options: dict, partition: PagePartition) -> Iterator[tuple]:
    for r in service(options["service"]).page(partition.batch, partition.page):
        yield tuple(r.get(k) for k in ("custom_id", "result_type", "stop_reason", "payload"))


def _ids(options: dict) -> list[str]:
    return json.loads(_get(options["folder"], f"manifest-{options['manifest']}") or "[]")


class ResultReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        client = service(self.options["service"])
        # one partition without a batch stands for no answers
        return [PagePartition(b, n) for b in _ids(self.options) for n in range(client.pages(b)[0])] or [PagePartition("", 0)]

    def read(self, partition: PagePartition) -> Iterator[tuple]:
        return _rows(self.options, partition) if partition.batch else iter(())


class ResultStream(DataSourceStreamReader):
    """Offsets are the number of pages of each batch that have been read."""

    def __init__(self, options: dict):
        self.options = dict(options)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        client = service(self.options["service"])
        return {b: client.pages(b)[0] for b in _ids(self.options)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [PagePartition(b, n) for b, pages in sorted(end.items()) for n in range(start.get(b, 0), pages)]

    def read(self, partition: PagePartition) -> Iterator[tuple]:
        return _rows(self.options, partition)


class BatchExchange(DataSource):
    """``format("batch_exchange")``; options service, folder, manifest, chunk."""

    @classmethod
    def name(cls) -> str:
        return "batch_exchange"

    def schema(self) -> str:
        return RESULTS

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return BatchWriter(self.options)

    def reader(self, schema) -> DataSourceReader:
        return ResultReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ResultStream(self.options)


@dataclass
class ExecutorBatches:
    """A client for the stages; ``folder`` is one that driver and executors share."""

    spark: SparkSession
    named: str
    folder: str
    chunk: int = 10_000
    tasks: int = 8

    def __post_init__(self) -> None:
        self.spark.dataSource.register(BatchExchange)

    def _options(self, batch: str) -> dict[str, str]:
        return {"service": self.named, "folder": self.folder, "manifest": batch, "chunk": str(self.chunk)}

    def submit(self, requests: DataFrame) -> str:
        rows = requests.select("custom_id", "params")
        marks = rows.select(F.xxhash64("custom_id", "params").alias("h")).agg(F.count("*"), F.bit_xor("h"), F.sum(F.col("h") % 1_000_003)).first()
        batch = hashlib.sha256(repr(tuple(marks)).encode()).hexdigest()[:32]
        if _get(self.folder, f"manifest-{batch}") is None:
            dealt = rows.repartition(self.tasks, "custom_id").sortWithinPartitions("custom_id", "params")
            dealt.write.format("batch_exchange").options(**self._options(batch)).mode("append").save()
        return batch

    def state(self, batch: str) -> str:
        client = service(self.named)
        return "ended" if all(client.pages(b)[1] for b in _ids(self._options(batch))) else "in_progress"

    def results(self, spark: SparkSession, batch: str) -> DataFrame:
        return spark.read.format("batch_exchange").options(**self._options(batch)).load()

    def stream(self, spark: SparkSession, batch: str) -> DataFrame:
        return spark.readStream.format("batch_exchange").options(**self._options(batch)).load()
