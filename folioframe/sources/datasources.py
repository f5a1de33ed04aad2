"""Data sources of our own: Word documents to read, and files to write.

    register(spark)
    spark.read.format("docx").load("/in/*.docx").where("part = 'rel'")
    rows.write.format("filetree").mode("append").save("/out")

docx deals files to partitions by their bytes and takes filters on part and
path: other files are not opened, other members of an archive not unpacked.

filetree writes (path, content) rows as files below a folder. Tasks write to
folders of their attempts; when all have ended, the driver moves the files of
the attempts that count to their places, and then removes everything else. A
job that fails, or an attempt that is lost or repeated, leaves nothing behind.

Both reach files by pyarrow.fs, that is local and shared folders and object
stores; where only Spark's readers reach a store, use read_docx instead.
"""

from __future__ import annotations

import fnmatch
import io
import posixpath
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from .docx import _DDL, _PARTS, KINDS, parts

#: Bytes of a partition, and rows of a batch.
PARTITION_BYTES, ROWS = 64 << 20, 2000
#: Tries of a refused write, and seconds before the second; each further wait is as much longer.
TRIES, WAIT = 3, 2.0
ATTEMPTS = "_attempts"


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def matching(path: str, suffixes: tuple[str, ...]) -> list[pafs.FileInfo]:
    """The files of a path, a folder or a pattern, that end with one of the suffixes, by name."""
    fs, inner = located(path)
    wild = any(c in inner for c in "*?[")
    base = posixpath.dirname(inner[: min(inner.find(c) for c in "*?[" if c in inner)] + "x") if wild else inner
    info = fs.get_file_info(base)
    found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
    files = [f for f in found if f.type == pafs.FileType.File and f.path.lower().endswith(suffixes) and (not wild or _fits(f.path, inner))]
    return sorted(files, key=lambda f: f.path)


def _fits(path: str, pattern: str) -> bool:
    """Whether a path fits a pattern, folder by folder."""
    one, two = path.split("/"), pattern.split("/")
    return len(one) == len(two) and all(map(fnmatch.fnmatchcase, one, two))


class Seekable(io.RawIOBase):
    """A file of pyarrow as Python's own: a place before its start is an OSError."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file, self.length = file, file.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        at = offset + (0, self.file.tell(), self.length)[whence]
        if at < 0:
            raise OSError("place before the start of the file")
        return self.file.seek(min(at, self.length))

    def tell(self) -> int:
        return self.file.tell()


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


class DocxReader(DataSourceReader):
    def __init__(self, path: str, size: int) -> None:
        self.path, self.size = path, size
        self.kinds: tuple[str, ...] = KINDS
        self.paths: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality with constants of part and path; Spark applies the others."""
        for f in filters:
            values = [f.value] if isinstance(f, EqualTo) else list(f.value) if isinstance(f, In) else None
            if values is None or f.attribute not in (("part",), ("path",)):
                yield f
            elif f.attribute == ("part",):
                self.kinds = tuple(k for k in self.kinds if k in values)
            else:
                self.paths = set(values) if self.paths is None else self.paths & set(values)

    def partitions(self) -> list[Files]:
        """Files in turn, until a partition has its bytes."""
        out, held, total = [], [], 0
        for f in matching(self.path, (".docx", ".doc")) if self.kinds else []:
            if self.paths is not None and f.path not in self.paths:
                continue
            if held and total + f.size > self.size:
                out.append(Files(tuple(held)))
                held, total = [], 0
            held.append(f.path)
            total += f.size
        return [*out, Files(tuple(held))] if held else out or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = located(self.path)
        rows: list[dict] = []
        for path in partition.paths:
            with fs.open_input_file(path) as file:
                for row in parts(io.BufferedReader(Seekable(file)), self.kinds):
                    rows.append({"path": path, **row})
                    if len(rows) >= ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema=_PARTS)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_PARTS)


class DocxSource(DataSource):
    """Rows of Word documents. Options: path; partitionBytes."""

    @classmethod
    def name(cls) -> str:
        return "docx"

    def schema(self) -> str:
        return _DDL

    def reader(self, schema) -> DocxReader:
        return DocxReader(self.options["path"], int(self.options.get("partitionBytes", PARTITION_BYTES)))


@dataclass
class Written(WriterCommitMessage):
    """What an attempt has written: its folder, and the places of its files."""

    folder: str
    paths: tuple[str, ...]


def retried(action: Callable[[], None], tries: int = TRIES, wait: float = WAIT) -> None:
    """Runs an action again when it is refused, after longer and longer waits."""
    for n in range(1, tries + 1):
        try:
            return action()
        except PermissionError:
            if n == tries:
                raise
            time.sleep(wait * n)


class FileTreeWriter(DataSourceWriter):
    def __init__(self, folder: str, wait: float) -> None:
        self.folder, self.wait, self.job = folder.rstrip("/"), wait, uuid.uuid4().hex

    def _job_folder(self) -> tuple[pafs.FileSystem, str, str]:
        fs, base = located(self.folder)
        return fs, base, f"{base}/{ATTEMPTS}/{self.job}"

    def write(self, iterator) -> Written:
        fs, _, job = self._job_folder()
        task = TaskContext.get()
        own = f"{job}/{task.partitionId() if task else 0}-{uuid.uuid4().hex}"
        paths: dict[str, None] = {}
        for row in iterator:
            path = posixpath.normpath(row["path"].lstrip("/"))
            if path.split("/")[0] in ("..", ".", ATTEMPTS):
                raise ValueError(f"path leaves the folder: {row['path']}")
            fs.create_dir(posixpath.dirname(f"{own}/{path}"), recursive=True)
            retried(lambda path=path, content=bytes(row["content"] or b""): self._put(fs, f"{own}/{path}", content), wait=self.wait)
            paths[path] = None
        return Written(own, tuple(paths))

    @staticmethod
    def _put(fs: pafs.FileSystem, path: str, content: bytes) -> None:
        with fs.open_output_stream(path) as out:
            out.write(content)

    def commit(self, messages: list[Written | None]) -> None:
        """Moves files to their places. A path that two tasks wrote is refused before anything is moved."""
        fs, base, job = self._job_folder()
        done = [m for m in messages if m is not None]
        every = [p for m in done for p in m.paths]
        if len(set(every)) < len(every):
            self.abort(messages)
            twice = next(p for p in every if every.count(p) > 1)
            raise ValueError(f"two rows of different tasks have the path {twice}")
        for parent in {posixpath.dirname(f"{base}/{p}") for p in every}:
            fs.create_dir(parent, recursive=True)
        for m in done:
            for path in m.paths:
                retried(lambda m=m, path=path: fs.move(f"{m.folder}/{path}", f"{base}/{path}"), wait=self.wait)
        self._clear(fs, base, job)

    def abort(self, messages: list[Written | None]) -> None:
        fs, base, job = self._job_folder()
        self._clear(fs, base, job)

    @staticmethod
    def _clear(fs: pafs.FileSystem, base: str, job: str) -> None:
        if fs.get_file_info(job).type != pafs.FileType.NotFound:
            fs.delete_dir(job)
        top = f"{base}/{ATTEMPTS}"
        if fs.get_file_info(top).type != pafs.FileType.NotFound and not fs.get_file_info(pafs.FileSelector(top)):
            fs.delete_dir(top)  # no other job is at work


class FileTree(DataSource):
    """Files from rows (path, content). Options: path; wait, the seconds before a refused write is tried again."""

    @classmethod
    def name(cls) -> str:
        return "filetree"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema, overwrite: bool) -> FileTreeWriter:
        if set(schema.names) != {"path", "content"}:
            raise ValueError(f"filetree writes the columns path and content, not {schema.names}")
        if overwrite:
            raise ValueError("filetree adds and replaces single files: use mode append")
        return FileTreeWriter(self.options["path"], float(self.options.get("wait", WAIT)))


def register(spark: SparkSession) -> None:
    """Makes both sources known to a session, and lets Spark push filters to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DocxSource)
    spark.dataSource.register(FileTree)
