"""The file log as a data source with a start position per topic, for batch and streams.

    spark.dataSource.register(TopicLog)
    spark.readStream.format("topiclog").option("path", log).option("startingOffsets", "latest").load()

A log is a folder of parquet files per topic (``logs.write_log``).  A position in a topic
is the last file read, by time of writing and name; files are written once and never
changed.  ``startingOffsets`` is ``earliest``, ``latest`` (the end of each topic when the
stream first starts) or a time (records with ``ts`` from then on), either for all topics or
as JSON by topic; topics it does not name start at ``earliest``.  It counts for a new
stream only: a restarted one goes on from its checkpoint.  ``topics`` limits it to some (default:
all there are).  A micro-batch takes all files that have come since the last.

The log must lie where Python finds it too: a mounted folder or a store that Arrow's file
systems know.  Each file is a partition and is read batch by batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from waycast import schemas as S

COLUMNS = S.LOG_SCHEMA.fieldNames()
TYPES = {"string": pa.string(), "timestamp_ntz": pa.timestamp("us"), "bigint": pa.int64()}


class LogFile(InputPartition):
    def __init__(self, topic: str, path: str, since: str | None):
        self.topic, self.path, self.since = topic, path, since


class _Log:
    """Listing and reading, shared by both readers."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        names = options.get("topics")
        self.topics = names.split(",") if names else None
        text = options.get("startingoffsets", "earliest")
        self.starts = json.loads(text) if text.startswith("{") else text

    def _folder(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def files(self) -> dict[str, list[tuple[int, str]]]:
        """By topic: time of writing and path of its files, in this order."""
        system, folder = self._folder()
        found: dict[str, list[tuple[int, str]]] = {t: [] for t in self.topics or []}
        for info in system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True)):
            parts = info.path.split("/")
            if info.type == fs.FileType.File and parts[-1].endswith(".parquet") and not parts[-1].startswith(("_", ".")):
                topic = next((p.removeprefix("topic=") for p in parts if p.startswith("topic=")), None)
                if topic is not None and (self.topics is None or topic in self.topics):
                    found.setdefault(topic, []).append((info.mtime_ns, info.path))
        return {t: sorted(files) for t, files in found.items()}

    def start(self, topic: str) -> str:
        return self.starts if isinstance(self.starts, str) else self.starts.get(topic, "earliest")

    def since(self, topic: str) -> str | None:
        start = self.start(topic)
        return None if start in ("earliest", "latest") else datetime.fromisoformat(start).isoformat()

    def load(self, part: LogFile) -> Iterator[pa.RecordBatch]:
        system, _ = self._folder()
        kinds = [TYPES[f.dataType.simpleString()] for f in S.LOG_SCHEMA.fields]
        with system.open_input_file(part.path) as file:
            own = pq.ParquetFile(file)
            for batch in own.iter_batches(columns=[c for c in COLUMNS if c != "topic"]):
                if part.since is not None:
                    batch = batch.filter(pc.greater_equal(batch.column("ts").cast(pa.timestamp("us")), pa.scalar(datetime.fromisoformat(part.since), pa.timestamp("us"))))
                columns = [pa.array([part.topic] * batch.num_rows, pa.string()) if c == "topic" else batch.column(c).cast(k) for c, k in zip(COLUMNS, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=COLUMNS)


class TopicReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.log = _Log(options)

    def partitions(self) -> list[LogFile]:
        log = self.log
        return [LogFile(t, path, log.since(t)) for t, files in log.files().items() if log.start(t) != "latest" for _, path in files]

    def read(self, partition: LogFile | None) -> Iterator[pa.RecordBatch]:
        return iter(()) if partition is None else self.log.load(partition)


class TopicStreamReader(DataSourceStreamReader):
    """Offsets: by topic ``[time of writing, path]`` of the last file that counts as read; the times to start from go along."""

    def __init__(self, options: dict[str, str]):
        self.log = _Log(options)

    def initialOffset(self) -> dict:
        files = self.log.files()
        ends = {t: list(own[-1]) for t, own in files.items() if own and self.log.start(t) == "latest"}
        return {"after": ends, "since": {t: s for t in files if (s := self.log.since(t))}}

    def latestOffset(self) -> dict:
        """The end of every topic.  Spark does not tell from where, so a batch takes all files that have come."""
        start = self.initialOffset()
        return {"after": {t: list(own[-1]) for t, own in self.log.files().items() if own}, "since": start["since"]}

    def partitions(self, start: dict, end: dict) -> list[LogFile]:
        parts = []
        for topic, own in self.log.files().items():
            low, high = start["after"].get(topic, [-1, ""]), end["after"].get(topic, [-1, ""])
            since = start["since"].get(topic) or self.log.since(topic)  # a topic may appear later
            parts += [LogFile(topic, path, since) for at, path in own if low < [at, path] <= high]
        return parts

    def commit(self, end: dict) -> None:
        """Nothing to give back: files stay."""

    def read(self, partition: LogFile) -> Iterator[pa.RecordBatch]:
        return self.log.load(partition)


class TopicLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topiclog"

    def schema(self):
        return S.LOG_SCHEMA

    def reader(self, schema) -> TopicReader:
        return TopicReader({k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema) -> TopicStreamReader:
        return TopicStreamReader({k.lower(): v for k, v in self.options.items()})
