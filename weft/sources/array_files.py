"""A Python data source over arrays in npz and JSON files, one folder for each source and object.

    <root>/<source>/<object>/<object>_<member>.npz      numpy members
    <root>/<source>/<object>/<object>_<member>.json     {"<member>": [...]}

    spark.dataSource.register(ArrayFiles)
    spark.read.format("arrays").option("path", root).option("sources", "a,b").option("member", "transforms").load()

Rows are (object, source, priority, place, value): the place-th row of the member, flattened; priority is the source's place in the
list. Files are listed by pyarrow's file systems, so local folders and HDFS work. A partition holds FILES files. Filters that name
objects (=, IN) are pushed into the listing, so only those objects' folders are looked at, in sessions that push filters into Python sources
(spark.sql.python.filterPushdown.enabled; load_arrays asks the session, else option pushdown says so). Files that are not there are no rows, and so are empty members; a file without the member is an error.
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage

SCHEMA = "object string, source string, priority int, place int, value array<double>"
KINDS = ("npz", "json")
FILES = 64
LISTED = 4096
SLICES = 32
LISTS = "_written"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def located(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path there."""
    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")


def entries(system: fs.FileSystem, folder: str, folders: bool) -> Iterator[str]:
    """Names of the folders, or else of the files, in a folder; a local one is read entry by entry, so its size is no matter."""
    if system.type_name == "local":
        if os.path.isdir(folder):
            with os.scandir(folder) as found:
                yield from (x.name for x in found if x.is_dir() == folders)
        return
    kind = fs.FileType.Directory if folders else fs.FileType.File
    yield from (x.base_name for x in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if x.type == kind)


def in_slice(name: str, number: int, of: int) -> bool:
    return zlib.crc32(name.encode()) % of == number


def delete_listed(system: fs.FileSystem, lists: Iterable[str]) -> None:
    """Delete the files that lists of written paths name, and the lists."""
    for path in lists:
        with contextlib.suppress(FileNotFoundError):
            with system.open_input_stream(path) as f, io.TextIOWrapper(f, "utf-8") as lines:
                for line in lines:
                    with contextlib.suppress(FileNotFoundError):
                        system.delete_file(json.loads(line))
            system.delete_file(path)


def decoded(data: bytes, kind: str, member: str) -> np.ndarray:
    """A member as rows of doubles."""
    if kind == "npz":
        with np.load(io.BytesIO(data)) as found:
            rows = np.asarray(found[member], float)
    else:
        rows = np.asarray(json.loads(data)[member], float)
    return rows.reshape(len(rows), -1) if rows.size else np.zeros((0, 0))


def encoded(rows: list, kind: str, member: str) -> bytes:
    if kind == "json":
        return json.dumps({member: rows}).encode()
    out = io.BytesIO()
    np.savez_compressed(out, **{member: np.asarray(rows, float)})
    return out.getvalue()


class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, str, str, int]]):
        self.files = files  # (path, object, source, priority)


class _Slice(InputPartition):
    def __init__(self, source: str, priority: int, number: int):
        self.source, self.priority, self.number = source, priority, number


class ArrayReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.member = options["path"], options.get("member", "transforms")
        self.sources = options["sources"].split(",")
        self.objects: set[str] | None = None

    def _file(self, root: str, source: str, priority: int, name: str) -> tuple[str, str, str, int]:
        return f"{root}/{source}/{name}/{name}_{self.member}", name, source, priority

    def _objects(self, source: str) -> Iterator[str]:
        system, root = located(self.root)
        return entries(system, f"{root}/{source}", True)

    def partitions(self) -> list[InputPartition]:
        _, root = located(self.root)
        files, room = [], LISTED
        for priority, source in enumerate(self.sources):
            if self.objects is None:
                names = list(islice(self._objects(source), room + 1))
                room -= len(names)
                if room < 0:
                    return [_Slice(s, p, i) for i in range(SLICES) for p, s in enumerate(self.sources)]
            else:
                names = [n for n in self.objects if n is not None]
            files += [self._file(root, source, priority, n) for n in sorted(names)]
        return [_Files(files[i : i + FILES]) for i in range(0, len(files), FILES)] or [_Files([])]

    def _files(self, partition: _Files | _Slice) -> Iterator[tuple[str, str, str, int]]:
        if isinstance(partition, _Files):
            yield from partition.files
            return
        _, root = located(self.root)
        for name in self._objects(partition.source):
            if in_slice(name, partition.number, SLICES):
                yield self._file(root, partition.source, partition.priority, name)

    def read(self, partition: _Files | _Slice) -> Iterator[tuple]:
        system, _ = located(self.root)
        for stem, name, source, priority in self._files(partition):
            for info in system.get_file_info([f"{stem}.{kind}" for kind in KINDS]):
                if info.type == fs.FileType.File:
                    with system.open_input_stream(info.path) as f:
                        rows = decoded(f.read(), info.extension, self.member)
                    for place, row in enumerate(rows):
                        yield name, source, priority, place, row.tolist()


class FilteredReader(ArrayReader):
    """The reader of sessions that push filters into Python sources; Spark refuses it in others."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("object",):
                named = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.objects = named if self.objects is None else self.objects & named
            else:
                yield f


@dataclass
class _Written(WriterCommitMessage):
    listed: str  # a file with the paths of what the task has written, a line each


class ArrayWriter(DataSourceWriter):
    """Writes rows (object, source, kind, value: array of rows), a file each; a file appears whole, by renaming."""

    def __init__(self, options: dict[str, str]):
        self.root, self.member = options["path"], options.get("member", "transforms")

    def write(self, rows: Iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        system, root = located(self.root)
        attempt = TaskContext.get().taskAttemptId()
        system.create_dir(f"{root}/{LISTS}", recursive=True)
        listed = f"{root}/{LISTS}/{uuid.uuid4().hex}"
        with system.open_output_stream(listed) as names:
            for row in rows:
                folder = f"{root}/{row.source}/{row.object}"
                system.create_dir(folder, recursive=True)
                path = f"{folder}/{row.object}_{self.member}.{row.kind}"
                with system.open_output_stream(f"{path}.{attempt}") as out:
                    out.write(encoded(row.value, row.kind, self.member))
                system.move(f"{path}.{attempt}", path)
                names.write(f"{json.dumps(path)}\n".encode())
        return _Written(listed)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = located(self.root)
        for message in messages:
            if message:
                system.delete_file(message.listed)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = located(self.root)
        delete_listed(system, [m.listed for m in messages if m])


class ArrayFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "arrays"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (FilteredReader if self.options.get("pushdown") == "true" else ArrayReader)(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return ArrayWriter(dict(self.options))


def load_arrays(spark: SparkSession, root: str, sources: list[str], member: str) -> DataFrame:
    spark.dataSource.register(ArrayFiles)
    read = spark.read.format("arrays").option("path", root).option("sources", ",".join(sources)).option("member", member)
    return read.option("pushdown", spark.conf.get(PUSHDOWN, "false")).load()


def save_arrays(rows: DataFrame, root: str, member: str) -> None:
    """rows (object, source, kind, value: array<array<double>>)."""
    rows.sparkSession.dataSource.register(ArrayFiles)
    rows.select("object", "source", "kind", "value").write.format("arrays").option("path", root).option("member", member).mode("append").save()


def first_source(arrays: DataFrame) -> DataFrame:
    """The rows of each object's first source that has any, with their number n. Files are read once; an object's rows are those of its few files."""
    first = F.min("priority").over(Window.partitionBy("object"))
    found = arrays.withColumn("__first", first).where("priority = __first")
    return found.select("object", "source", "place", "value", F.count(F.lit(1)).over(Window.partitionBy("object")).alias("n"))


def drawn(arrays: DataFrame, most: int, seed: str) -> DataFrame:
    """At most so many rows of each object, by the hash of seed, object and place."""
    from weft.sources.files import first_of_each

    keyed = arrays.withColumn("__key", F.md5(F.concat_ws("|", F.lit(seed), "object", "place")))
    return first_of_each(keyed, "object", "__key", most).drop("__key")
