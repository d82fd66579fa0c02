"""Files as rows: a data source that sees every file below a folder, also empty and hidden ones.

Spark's file sources skip files of zero bytes and names that begin with ``_`` or ``.``. This
source lists a folder as they do, on the driver and once per scan, and deals the files out to
tasks, which read them; a task's files are bounded in number and bytes, and a file larger than
that is a task of its own. Folders are opened with Arrow's file systems, so they may be local
or shared folders, S3, GCS, Azure or HDFS, on which executors and driver must agree.

As a stream, a file is offered when its time of modification passes the last offset. A file
that arrives with an older time (moved, or copied with its time) is offered too while it is
within ``allowance`` seconds of the newest one; files of that span may be offered again, and
whoever reads the stream drops what it has seen. What comes later than that is found by the
next scan of the folder.

Options: ``path``; ``filesPerTask``, ``bytesPerTask``; ``content`` (false: list only);
``unseen`` (true: only what Spark's own file sources pass over); ``allowance``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "path string, modified timestamp, length bigint, content binary"
FORMAT = "dayfold_raw_files"

# What Hadoop's own writers leave in a folder.
BOOKKEEPING = ("_SUCCESS", "_committed_*", "_started_*", ".*.crc")

_ARROW = pa.schema([("path", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("length", pa.int64()), ("content", pa.binary())])


def hidden(path: str) -> bool:
    """Whether Spark's file sources pass over a path below their folder."""
    return any(p.startswith(("_", ".")) for p in path.split("/"))


class Folder:
    """A folder by the name Spark has for it: Hadoop writes ``file:/x`` where Arrow wants ``file:///x``."""

    def __init__(self, uri: str):
        self.uri = uri.rstrip("/") or "/"
        scheme, colon, rest = self.uri.partition(":")
        if colon and rest.startswith("/") and not rest.startswith("//"):
            self.files, self.root = fs.FileSystem.from_uri(f"{scheme}://{rest}")
        else:
            self.files, self.root = fs.FileSystem.from_uri(self.uri)

    def listed(self) -> list[tuple[str, int, int]]:
        """(path below the folder, milliseconds of its last change, bytes) of all files, sorted."""
        found = self.files.get_file_info(fs.FileSelector(self.root, recursive=True))
        return sorted(
            (i.path[len(self.root):].lstrip("/"), (i.mtime_ns or 0) // 1_000_000, i.size or 0)
            for i in found
            if i.type == fs.FileType.File and not any(fnmatch(i.base_name, p) for p in BOOKKEEPING)
        )

    def content(self, path: str) -> bytes | None:
        """The bytes of a file; None if it is gone or may not be read."""
        try:
            # As a stream, a name such as x.gz would be unpacked.
            with self.files.open_input_file(f"{self.root}/{path}") as file:
                return file.read()
        except OSError:
            return None


def dealt(files: list[tuple[str, int, int]], most_files: int, most_bytes: int) -> list[InputPartition]:
    """Files in lots of bounded number and bytes."""
    lots: list[list] = []
    size = 0
    for file in files:
        if not lots or len(lots[-1]) >= most_files or size + file[2] > most_bytes:
            lots.append([])
            size = 0
        lots[-1].append(file)
        size += file[2]
    return [InputPartition(json.dumps(lot)) for lot in lots]


class _Reading:
    """What scans and streams share: options and the reading of one lot."""

    def __init__(self, options):
        self.folder = options["path"]
        self.most_files = int(options.get("filesPerTask", "1000"))
        self.most_bytes = int(options.get("bytesPerTask", str(64 << 20)))
        self.with_content = options.get("content", "true").lower() == "true"
        self.unseen = options.get("unseen", "false").lower() == "true"
        self.allowance = int(float(options.get("allowance", "3600")) * 1000)

    def listed(self) -> list[tuple[str, int, int]]:
        files = Folder(self.folder).listed()
        return [f for f in files if f[2] == 0 or hidden(f[0])] if self.unseen else files

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        folder = Folder(self.folder)
        batch, size = [], 0
        for path, modified, length in json.loads(partition.value):
            content = folder.content(path) if self.with_content else None
            batch.append((f"{folder.uri}/{path}", modified * 1000, length, content))
            size += length
            if size > self.most_bytes // 4:
                yield _rows(batch)
                batch, size = [], 0
        if batch:
            yield _rows(batch)


def _rows(batch: list[tuple]) -> pa.RecordBatch:
    columns = zip(*batch, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


class Scan(_Reading, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return dealt(self.listed(), self.most_files, self.most_bytes)


class Stream(_Reading, DataSourceStreamReader):
    """Offsets are the newest time seen and how many files lie within the allowance before it.

    The number makes a late file, which does not move the time, a new offset.
    """

    def initialOffset(self) -> dict:
        return {"upto": -1, "late": 0}

    def latestOffset(self) -> dict:
        times = [modified for _, modified, _ in self.listed()]
        upto = max(times, default=-1)
        return {"upto": upto, "late": sum(t > upto - self.allowance for t in times)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        after = start["upto"] - self.allowance if start["upto"] >= 0 else -1
        files = [f for f in self.listed() if after < f[1] <= end["upto"]]
        return dealt(files, self.most_files, self.most_bytes)

    def commit(self, end: dict) -> None:
        """Nothing is kept: offsets say it all."""


class RawFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Scan:
        return Scan(self.options)

    def streamReader(self, schema) -> Stream:
        return Stream(self.options)
