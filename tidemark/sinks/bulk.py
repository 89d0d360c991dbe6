"""Bulk index writer (K4) as a Spark data source, for batches and streams.

    register(spark)
    docs.write.format("tidemark_bulk").mode("append").options(target=..., id="doc_id").save()
    docs.writeStream.format("tidemark_bulk").options(target=..., id="doc_id", checkpointLocation=...).start()

A task gathers documents into bulks and sends one as soon as it holds
``max_actions`` documents, or the next would take it over ``max_bytes``, or
``interval_ms`` have passed since its first.  A failed send is tried again
after ``backoff_ms``, up to ``max_retries`` times, and then fails the task.
The defaults are the flush settings of the reference's index sink.

A bulk that was sent is there, whatever becomes of its task or job: delivery
is at least once.  Each document is sent under its id (column ``id``), so a
task, job or micro-batch that runs again writes the same documents again, and
the index holds each id once.  The commit of a job or micro-batch leaves a
record of what it sent.

Transports: ``file:`` and other file-system targets (whatever ``pyarrow.fs``
opens) hold one file of JSON lines per bulk; an ``http(s):`` target gets bulk
requests in the usual two-line form, and a request whose answer reports failed
items counts as failed.
"""

from __future__ import annotations

import base64
import json
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

FORMAT = "tidemark_bulk"
#: Flush settings (fixed values of the index sink).
MAX_ACTIONS, MAX_BYTES, INTERVAL_MS, BACKOFF_MS = 32, 42 << 20, 1000, 1000
MAX_RETRIES = 8


@dataclass(frozen=True)
class Action:
    """One document of a bulk: its id and its JSON."""

    id: str
    source: str

    def size(self) -> int:
        return len(self.source.encode()) + len(self.id.encode())


class FileTransport:
    """A folder of bulks, one file each: JSON lines with the document's id,
    the time it was sent, and the document as JSON text."""

    def __init__(self, target: str):
        self.target = target.rstrip("/")

    def _open(self, name: str):
        from pyarrow import fs

        url = self.target if "://" in self.target else self.target.replace("file:", "file://", 1) if self.target.startswith("file:") else f"file://{self.target}"
        store, root = fs.FileSystem.from_uri(url)
        store.create_dir(f"{root}/{name.rsplit('/', 1)[0]}" if "/" in name else root, recursive=True)
        return store.open_output_stream(f"{root}/{name}")

    def send(self, actions: list[Action]) -> None:
        now = time.time_ns()
        lines = [json.dumps({"id": a.id, "sent": now + k, "source": a.source}) for k, a in enumerate(actions)]
        with self._open(f"bulks/{now}-{uuid.uuid4().hex}.json") as out:
            out.write(("\n".join(lines) + "\n").encode())

    def record(self, name: str, text: str) -> None:
        with self._open(f"commits/{name}.json") as out:
            out.write(text.encode())


class HttpTransport:
    """Bulk requests to ``<target>/_bulk``."""

    def __init__(self, target: str, index: str, user: str | None = None, password: str | None = None, timeout_s: float = 60,
                 send: Callable | None = None):
        self.target, self.index, self.timeout_s = target.rstrip("/"), index, timeout_s
        self.headers = {"Content-Type": "application/x-ndjson"}
        if user is not None:
            self.headers["Authorization"] = "Basic " + base64.b64encode(f"{user}:{password or ''}".encode()).decode()
        self._send = send or self._post

    def _post(self, request: urllib.request.Request) -> bytes:
        with urllib.request.urlopen(request, timeout=self.timeout_s) as answer:
            return answer.read()

    def send(self, actions: list[Action]) -> None:
        lines = [x for a in actions for x in (json.dumps({"index": {"_index": self.index, "_id": a.id}}), a.source)]
        body = ("\n".join(lines) + "\n").encode()
        answer = json.loads(self._send(urllib.request.Request(f"{self.target}/_bulk", body, self.headers, method="POST")) or b"{}")
        if answer.get("errors"):
            failed = [x for item in answer.get("items", []) for x in item.values() if x.get("error")]
            raise OSError(f"{len(failed)} of {len(actions)} documents failed, first: {failed[:1]}")

    def record(self, name: str, text: str) -> None:
        """An index keeps no record of jobs."""


def transport_of(options: dict):
    target = options["target"]
    if target.startswith(("http://", "https://")):
        return HttpTransport(target, options["index"], options.get("user"), options.get("password"))
    return FileTransport(target)


class Bulks:
    """Cuts a task's documents into bulks and sends them."""

    def __init__(self, transport, max_actions: int = MAX_ACTIONS, max_bytes: int = MAX_BYTES, interval_ms: int = INTERVAL_MS,
                 backoff_ms: int = BACKOFF_MS, max_retries: int = MAX_RETRIES, sleep: Callable = time.sleep, clock: Callable = time.monotonic):
        self.transport, self.sleep, self.clock = transport, sleep, clock
        self.max_actions, self.max_bytes, self.interval_ms = max_actions, max_bytes, interval_ms
        self.backoff_ms, self.max_retries = backoff_ms, max_retries
        self.held: list[Action] = []
        self.size, self.since = 0, 0.0
        self.sent = self.bulks = self.retries = 0

    def add(self, action: Action) -> None:
        size = action.size()
        if self.held and self.size + size > self.max_bytes:
            self.flush()
        if not self.held:
            self.since = self.clock()
        self.held.append(action)
        self.size += size
        if len(self.held) >= self.max_actions or (self.clock() - self.since) * 1000 >= self.interval_ms:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        for attempt in range(self.max_retries + 1):
            try:
                self.transport.send(self.held)
                break
            except OSError:
                if attempt == self.max_retries:
                    raise
                self.retries += 1
                self.sleep(self.backoff_ms / 1000)
        self.sent += len(self.held)
        self.bulks += 1
        self.held, self.size = [], 0


@dataclass
class Sent(WriterCommitMessage):
    """What one task sent."""

    documents: int
    bulks: int
    retries: int


def _documents(batch: pa.RecordBatch, id_col: str) -> Iterator[Action]:
    names = batch.schema.names
    at = names.index(id_col)
    for row in zip(*[c.to_pylist() for c in batch.columns]):
        if row[at] is None:
            raise ValueError(f"a document without an id ({id_col})")
        yield Action(str(row[at]), json.dumps({n: _plain(v) for n, v in zip(names, row)}, ensure_ascii=False))


def _plain(value):
    """A value as JSON: times as SQL text with milliseconds, UTC."""
    if hasattr(value, "isoformat"):
        import datetime as dt

        if isinstance(value, dt.datetime):
            value = value.astimezone(dt.timezone.utc) if value.tzinfo else value
            return value.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]
        return value.isoformat()
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return base64.b64encode(value).decode() if isinstance(value, bytes) else value


class _Writer:
    """What the batch and the stream writer share; travels to the tasks."""

    def __init__(self, options: dict):
        self.options = options
        self.job = uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Sent:
        given = {k: int(self.options[k]) for k in ("max_actions", "max_bytes", "interval_ms", "backoff_ms", "max_retries") if k in self.options}
        bulks = Bulks(transport_of(self.options), **given)
        for batch in batches:
            for action in _documents(batch, self.options["id"]):
                bulks.add(action)
        bulks.flush()
        return Sent(bulks.sent, bulks.bulks, bulks.retries)

    def _record(self, name: str, messages: list, **more) -> None:
        done = [m for m in messages if m is not None]
        total = {x: sum(getattr(m, x) for m in done) for x in ("documents", "bulks", "retries")}
        transport_of(self.options).record(name, json.dumps({"job": self.job, "tasks": len(done), **total, **more}))


class BatchWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self._record(self.job, messages, state="committed")

    def abort(self, messages: list) -> None:
        """What was sent stays; the job that runs again sends it again."""
        self._record(self.job, messages, state="aborted")


class StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self._record(f"{self.job}-{batchId}", messages, state="committed", batch=batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self._record(f"{self.job}-{batchId}", messages, state="aborted", batch=batchId)


class BulkIndex(DataSource):
    """Options: ``target`` (folder or http address), ``id`` (column),
    ``index``, ``user``, ``password`` (http), and the flush settings."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _checked(self) -> dict:
        options = {str(k).lower(): v for k, v in self.options.items()}
        missing = [x for x in ("target", "id") if not options.get(x)]
        if missing:
            raise ValueError(f"{FORMAT} needs the options {missing}")
        return options

    def writer(self, schema: T.StructType, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError(f"{FORMAT} only appends: documents replace each other by id")
        return BatchWriter(self._checked())

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self._checked())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BulkIndex)


def write_bulk(docs: DataFrame, target: str, id_col: str = "doc_id", **options) -> None:
    """Batch write; see the module for the options."""
    register(docs.sparkSession)
    docs.write.format(FORMAT).mode("append").options(target=target, id=id_col, **options).save()


def write_bulk_stream(docs: DataFrame, target: str, checkpoint: str, id_col: str = "doc_id", trigger: dict | None = None, **options):
    """Stream write; a replayed micro-batch sends its documents again."""
    register(docs.sparkSession)
    writer = docs.writeStream.format(FORMAT).options(target=target, id=id_col, checkpointLocation=checkpoint, **options)
    return writer.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


#: A line of a bulk file.
LINE = T.StructType([T.StructField("id", T.StringType()), T.StructField("sent", T.LongType()), T.StructField("source", T.StringType())])


def read_bulks(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The documents of a folder target, one for each id, the one sent last;
    ``source`` by the declared schema.  Also what an aborted job has sent is
    there, as in an index."""
    lines = spark.read.schema(LINE).json(f"{target.rstrip('/')}/bulks")
    last = lines.groupBy("id").agg(F.max_by("source", F.struct("sent", "source")).alias("source"))
    times = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSS", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSS"}
    return last.select(F.col("id").alias("_id"), F.from_json("source", schema, times).alias("_d")).select("_id", "_d.*")


def read_commits(spark: SparkSession, target: str) -> DataFrame:
    """(job, state, batch, tasks, documents, bulks, retries) of each job."""
    schema = "job string, state string, batch long, tasks long, documents long, bulks long, retries long"
    return spark.read.schema(schema).json(f"{target.rstrip('/')}/commits")
