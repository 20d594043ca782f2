"""Records with a byte-offset index, and sorted look-up tables, as Python data sources.

    data/part-00000    a record a line
    index/part-00000   a line `offset: title` for each record of the data file of the same name
    index/_lookup/     rows of fixed width sorted by the title's hash, and in the file's last bytes a sparse index of them

Paths are opened by pyarrow, which knows local files, HDFS, S3 and Google's store; a reader seeks, and reads what it needs only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

RECORDS, LOOKUP = "spindrift_indexed", "spindrift_lookup"

#: Bytes of data that a task reads, bytes that are read at once, rows of a look-up block, bytes of records in a batch.
RANGE, PIECE, BLOCK, BATCH = 64 << 20, 1 << 20, 256, 4 << 20

#: A row of a look-up table: the title's hash; the data file's number, where the record starts and ends there; where its line starts in the index file.
ROW = np.dtype([("hash", "<i8"), ("file", "<i8"), ("start", "<i8"), ("end", "<i8"), ("line", "<i8")])


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri.removeprefix("file:"))


def files(uri: str) -> list[pafs.FileInfo]:
    """The files of a folder by name, less hidden ones."""
    fs, path = opened(uri)
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted((f for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "_."), key=lambda f: f.base_name)


def number(name: str) -> int:
    return int(name.removeprefix("part-"))


# -- Writing: every attempt has a folder of its own, and the commit moves the files of those that counted.


@dataclass
class Written(WriterCommitMessage):
    """The attempt's files, and the number of the partition."""

    attempt: str
    part: int


class _Writer(DataSourceArrowWriter):
    """Writes folders given by options, each with a file a partition; a subclass says what goes to which."""

    folders: tuple[str, ...] = ()

    def __init__(self, options: dict[str, str]):
        self.to = {name: options[name].rstrip("/") for name in self.folders}
        self.job = f"_attempts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        out = {}
        for name, uri in self.to.items():
            fs, path = opened(uri)
            fs.create_dir(f"{path}/{self.job}", recursive=True)
            out[name] = fs.open_output_stream(f"{path}/{self.job}/{attempt}", compression=None)
        try:
            self.put(iterator, out)
        finally:
            for stream in out.values():
                stream.close()
        return Written(attempt, part)

    def put(self, batches: Iterator[pa.RecordBatch], out: dict[str, pa.NativeFile]) -> None:
        raise NotImplementedError

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        for uri in self.to.values():
            fs, path = opened(uri)
            for m in messages:
                if m is not None:
                    fs.move(f"{path}/{self.job}/{m.attempt}", f"{path}/part-{m.part:05d}")
        self._clean()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clean()

    def _clean(self) -> None:
        for uri in self.to.values():
            fs, path = opened(uri)
            if fs.get_file_info(f"{path}/{self.job}").type == pafs.FileType.Directory:
                fs.delete_dir(f"{path}/{self.job}")


class RecordWriter(_Writer):
    """Rows (title, record) as a data file and an index file, in one pass."""

    folders = ("path", "index")

    def put(self, batches: Iterator[pa.RecordBatch], out: dict[str, pa.NativeFile]) -> None:
        at = 0
        for b in batches:
            size = pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            starts = at + np.cumsum(size) - size
            at += int(size.sum())
            out["path"].write(_lines(b.column(1)))
            out["index"].write(_lines(pc.binary_join_element_wise(pa.array(starts).cast(pa.string()), b.column(0), ": ")))


def _lines(column: pa.Array) -> pa.Buffer:
    """All values end to end, a line feed behind each."""
    ended = pc.binary_join_element_wise(column, "", "\n").cast(pa.large_binary())
    at = np.frombuffer(ended.buffers()[1], np.int64)
    first, last = int(at[ended.offset]), int(at[ended.offset + len(ended)])
    return ended.buffers()[2].slice(first, last - first) if last > first else pa.py_buffer(b"")


class LookupWriter(_Writer):
    """Rows of ROW's columns, that come sorted; a file ends in the first hash of every block, the number of its rows and its first and last hash."""

    folders = ("path",)

    def put(self, batches: Iterator[pa.RecordBatch], out: dict[str, pa.NativeFile]) -> None:
        n, last, sparse = 0, 0, []
        for b in batches:
            rows = np.empty(b.num_rows, ROW)
            for i, name in enumerate(ROW.names):
                rows[name] = b.column(i).to_numpy(zero_copy_only=False)
            sparse.append(rows["hash"][(-n) % BLOCK :: BLOCK])
            n, last = n + len(rows), rows["hash"][-1] if len(rows) else last
            out["path"].write(rows.tobytes())
        first = np.concatenate(sparse) if sparse else np.zeros(0, np.int64)
        out["path"].write(first.astype("<i8").tobytes() + np.array([n, first[0] if n else 0, last], "<i8").tobytes())

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        super().commit(messages)
        fs, path = opened(self.to["path"])
        spans = []
        for f in files(self.to["path"]):
            with fs.open_input_file(f.path) as stream:
                n, first, last = np.frombuffer(stream.read_at(24, f.size - 24), "<i8").tolist()
            if n:
                spans.append((f.base_name, n, first, last))
        with fs.open_output_stream(f"{path}/_spans", compression=None) as stream:
            stream.write(json.dumps(spans).encode())


# -- Reading records by ranges of the index.


@dataclass
class Lines(InputPartition):
    """The records whose lines start in these bytes of an index file."""

    file: str
    start: int
    stop: int


def cut_lines(stream: pa.NativeFile, start: int, stop: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that start from start to stop, and the first one behind, by pieces."""
    at, held = max(start - 1, 0), b""
    skip = start > 0  # a line that starts at start follows a line feed just before
    place = at
    while at < size:
        piece = stream.read_at(min(PIECE, size - at), at)
        at += len(piece)
        *found, held = (held + piece).split(b"\n")
        for line in found:
            if not skip:
                yield place, line
                if place >= stop:
                    return
            skip, place = False, place + len(line) + 1
    if held and not skip:
        yield place, held


class RecordReader(DataSourceReader):
    """(title, record), each read at its place: tasks are ranges of index lines, sized so that the data they lead to is
    about RANGE bytes; a task reads its data in pieces, so it holds a batch of records and no file or range."""

    def __init__(self, options: dict[str, str]):
        self.data, self.index, self.range = options["path"], options["index"], int(options.get("range", RANGE))

    def partitions(self) -> Sequence[InputPartition]:
        sizes, out = {f.base_name: f.size for f in files(self.data)}, []
        for f in files(self.index):
            if f.base_name not in sizes:
                raise FileNotFoundError(f"the index {f.path} has no data file")
            n = max(1, -(-sizes[f.base_name] // self.range))
            step = max(1, -(-f.size // n))
            out += [Lines(f.base_name, at, min(at + step, f.size)) for at in range(0, f.size, step)]
        return out or [Lines("", 0, 0)]

    def read(self, partition: Lines) -> Iterator[pa.RecordBatch]:
        if partition.stop <= partition.start:
            return
        (fs, data), (_, index) = opened(self.data), opened(self.index)
        with fs.open_input_file(f"{index}/{partition.file}") as lines, fs.open_input_file(f"{data}/{partition.file}") as stream:
            total, titles, starts, held = stream.size(), [], [], 0
            for place, line in cut_lines(lines, partition.start, partition.stop, lines.size()):
                offset, _, title = line.partition(b": ")
                starts.append(int(offset))
                if held and (starts[-1] - starts[0] > BATCH or place >= partition.stop):
                    yield _records(stream, titles, starts)
                    titles, starts, held = [], starts[-1:], 0
                if place >= partition.stop:
                    return
                titles.append(title)
                held += 1
            if titles:
                yield _records(stream, titles, [*starts, total])


def _records(stream: pa.NativeFile, titles: list[bytes], starts: list[int]) -> pa.RecordBatch:
    raw, base = stream.read_at(starts[-1] - starts[0], starts[0]), starts[0]
    records = [raw[a - base : b - base].removesuffix(b"\n") for a, b in zip(starts, starts[1:], strict=False)]
    return pa.RecordBatch.from_arrays([pa.array(titles, pa.binary()).cast(pa.string()), pa.array(records, pa.binary()).cast(pa.string())], names=["title", "record"])


# -- Look-up of one record.


class Lookup:
    """Finds a record by its title's hash. reads: of files so far, a number that doesn't grow with the records."""

    def __init__(self, data: str, index: str):
        self.fs, self.data = opened(data)
        self.index, self.reads = opened(index)[1], 0
        with self.fs.open_input_file(f"{self.index}/_lookup/_spans") as f:
            self.spans = json.loads(f.read())
        self.reads += 1

    def _at(self, name: str, start: int, size: int) -> bytes:
        with self.fs.open_input_file(name) as f:
            self.reads += 1
            return f.read_at(size, start)

    def rows(self, hash_: int) -> Iterator[np.void]:
        """The rows of a hash, the last one first: a block is read only when the rows of the one behind it didn't do."""
        for name, n, first, last in reversed(self.spans):
            if not first <= hash_ <= last:
                continue
            path = f"{self.index}/_lookup/{name}"
            sparse = np.frombuffer(self._at(path, n * ROW.itemsize, 8 * -(-n // BLOCK)), "<i8")
            block = int(np.searchsorted(sparse, hash_, "right")) - 1
            while block >= 0:
                rows = np.frombuffer(self._at(path, block * BLOCK * ROW.itemsize, min(BLOCK, n - block * BLOCK) * ROW.itemsize), ROW)
                start, stop = (int(np.searchsorted(rows["hash"], hash_, side)) for side in ("left", "right"))
                yield from rows[start:stop][::-1]
                if start > 0:
                    break
                block -= 1

    def record(self, title: str, hash_: int) -> str | None:
        """The last record of the title; None without one. A title is compared in full, as hashes may be equal."""
        wanted = title.encode()
        for row in self.rows(hash_):
            name = f"part-{row['file']:05d}"
            line = self._at(f"{self.index}/{name}", int(row["line"]), len(f"{row['start']}: ") + len(wanted) + 1)
            if line.removesuffix(b"\n") == f"{row['start']}: ".encode() + wanted:
                return self._at(f"{self.data}/{name}", int(row["start"]), int(row["end"] - row["start"])).removesuffix(b"\n").decode()
        return None


# -- The sources.


class IndexedRecords(DataSource):
    """Options: path (data files), index (index files); reading: range (bytes of data a task)."""

    @classmethod
    def name(cls) -> str:
        return RECORDS

    def schema(self) -> str:
        return "title string, record string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return RecordReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return RecordWriter(dict(self.options))


class LookupRows(DataSource):
    """Option: path. Only written by Spark; Lookup reads it by seeks."""

    @classmethod
    def name(cls) -> str:
        return LOOKUP

    def schema(self) -> str:
        return ", ".join(f"{c} long" for c in ROW.names)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return LookupWriter(dict(self.options))


def qualified(spark: SparkSession, path: str) -> str:
    """path with the scheme of the file system that Spark takes it for."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString().replace("file:/", "file:///", 1).replace("file://///", "file:///")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(IndexedRecords)
    spark.dataSource.register(LookupRows)
