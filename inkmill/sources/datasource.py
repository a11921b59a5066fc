"""Folders of source files as a data source of the engine, over any file system that Arrow opens.

``register(spark)`` makes the format ``source_files``.  ``spark.read.format("source_files").load(uri)`` has a row for each file:

* ``rel``, the path below the folder, ``size``, ``source_sha256``, ``content`` and ``error``.  With a schema of fewer columns, only what they need is
  done: a listing of ``rel`` and ``size`` opens no file, one with the fingerprint reads it in chunks.
* Folders are listed by the tasks.  The driver lists folders only until there are enough for all tasks; a folder of very
  many files is dealt to several, each of which takes its share of the names.
* Filters on ``rel`` (equality, a list, a prefix or suffix) reach the tasks, which then don't open other files, and don't list folders
  that a prefix rules out.
* A file that can't be read, or changes while it is read, is a row with an error and without fingerprint and content.
"""

from __future__ import annotations

import hashlib
import posixpath
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringEndsWith, StringStartsWith

FORMAT = "source_files"
SCHEMA = "rel string, size long, source_sha256 string, content binary, error string"
CHUNK = 1 << 20
#: Folders that are enough for a read, and tasks that share one folder's files.
FOLDERS = 64
SHARES = 8
#: Bytes of contents, or rows without them, of an Arrow batch.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 4096


@dataclass
class Wanted:
    """Names that filters leave: those of all given kinds."""

    names: set[str] | None = None
    prefixes: list[str] = field(default_factory=list)
    suffixes: list[str] = field(default_factory=list)

    def take(self, f: Filter) -> bool:
        """Whether the filter was taken, which is so for those on ``rel`` that names alone can tell."""
        if getattr(f, "attribute", None) != ("rel",):
            return False
        if isinstance(f, (EqualTo, In)):
            own = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.names = own if self.names is None else self.names & own
        elif isinstance(f, StringStartsWith):
            self.prefixes.append(f.value)
        elif isinstance(f, StringEndsWith):
            self.suffixes.append(f.value)
        else:
            return False
        return True

    def file(self, rel: str) -> bool:
        return (self.names is None or rel in self.names) and all(map(rel.startswith, self.prefixes)) and all(map(rel.endswith, self.suffixes))

    def folder(self, rel: str) -> bool:
        """Whether a file below the folder may be wanted."""
        at = f"{rel}/" if rel else ""
        return all(p.startswith(at) or at.startswith(p) for p in self.prefixes) and (self.names is None or any(n.startswith(at) for n in self.names))


@dataclass
class Part(InputPartition):
    """A folder to list, with what is below it if ``deep``; of its files those of one share."""

    folder: str
    deep: bool
    share: int
    shares: int


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the folder's path in it; a path without a scheme is local."""
    if "://" in uri or uri.startswith("file:"):
        system, path = fs.FileSystem.from_uri(uri)
        return system, path.rstrip("/") or "/"
    return fs.LocalFileSystem(), uri.rstrip("/") or "/"


def _below(system: fs.FileSystem, root: str, folder: str) -> list[tuple[str, fs.FileInfo]]:
    """(rel, info) of what is in a folder, but for names that begin with a dot, in order."""
    found = system.get_file_info(fs.FileSelector(posixpath.join(root, folder) if folder else root, allow_not_found=False, recursive=False))
    named = ((posixpath.basename(i.path.rstrip("/")), i) for i in found)
    return sorted(((f"{folder}/{n}" if folder else n, i) for n, i in named if not n.startswith(".")), key=lambda x: x[0])


class FilesReader(DataSourceReader):
    def __init__(self, uri: str, schema: T.StructType, omit: str | None) -> None:
        self.uri, self.columns, self.omit, self.wanted = uri, schema.fieldNames(), omit, Wanted()
        unknown = set(self.columns) - {"rel", "size", "source_sha256", "content", "error"}
        if unknown:
            raise ValueError(f"no such columns: {', '.join(sorted(unknown))}")

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if not self.wanted.take(f):
                yield f

    def _folder(self, rel: str) -> bool:
        return rel != self.omit and self.wanted.folder(rel)

    def partitions(self) -> Sequence[Part]:
        system, root = _opened(self.uri)
        open_folders, shallow = [""], []
        while open_folders and len(open_folders) + len(shallow) < FOLDERS:
            shallow += open_folders  # their own files are a part; folders below them are listed here
            open_folders = [rel for folder in open_folders for rel, i in _below(system, root, folder) if i.type == fs.FileType.Directory and self._folder(rel)]
        return [Part(f, False, k, SHARES) for f in shallow for k in range(SHARES)] + [Part(f, True, 0, 1) for f in open_folders]

    def _files(self, system: fs.FileSystem, root: str, part: Part) -> Iterator[tuple[str, fs.FileInfo]]:
        folders = [part.folder]
        while folders:
            at = folders.pop()
            for rel, i in _below(system, root, at):
                if i.type == fs.FileType.Directory:
                    if part.deep and self._folder(rel):
                        folders.append(rel)
                elif i.type == fs.FileType.File and self.wanted.file(rel) and zlib.crc32(rel.encode("utf-8", "surrogateescape")) % part.shares == part.share:
                    yield rel, i

    def _row(self, system: fs.FileSystem, rel: str, info: fs.FileInfo) -> tuple[dict, int]:
        row = {"rel": rel, "size": info.size, "source_sha256": None, "content": None, "error": None}
        opens = {"source_sha256", "content", "error"} & set(self.columns)
        held, size = [], 0
        if opens:
            try:
                h = hashlib.sha256()
                with system.open_input_stream(info.path) as f:
                    while chunk := f.read(CHUNK):
                        h.update(chunk)
                        size += len(chunk)
                        if "content" in opens:
                            held.append(chunk)
                after = system.get_file_info(info.path)
                if (after.size, after.mtime_ns) != (info.size, info.mtime_ns) or size != info.size:
                    raise OSError("the file changed while it was read")
                row |= {"source_sha256": h.hexdigest(), "content": b"".join(held) if "content" in opens else None}
            except OSError as e:
                row |= {"size": None, "error": f"{type(e).__name__}: {e}"}
        return row, size if "content" in opens else 0

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        system, root = _opened(self.uri)
        rows, held = [], 0
        kinds = {"size": pa.int64(), "content": pa.binary()}

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in self.columns], names=self.columns)

        for rel, info in self._files(system, root, part):
            row, size = self._row(system, rel, info)
            rows.append(row)
            held += size
            if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()


class SourceFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> FilesReader:
        return FilesReader(self.options["path"], schema, self.options.get("omit"))


def register(spark: SparkSession) -> None:
    """Make the format known, and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SourceFiles)


def source_files(spark: SparkSession, uri: str, columns: str = "rel string, size long, source_sha256 string", omit: str | None = None) -> DataFrame:
    """The files of a folder with the given columns; the folder ``omit`` below it, such as an output folder, is left out."""
    register(spark)
    read = spark.read.format(FORMAT).schema(columns)
    return (read.option("omit", omit) if omit else read).load(uri)
