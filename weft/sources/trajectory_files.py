"""A Python data source for hierarchical trajectory files: HDF5 files, which need the optional h5py, and npz files with the same tree.

    spark.dataSource.register(TrajectoryFiles)
    spark.read.format("trajectories").option("paths", "a.h5,b.npz").load()

In an npz file a member's name is its path (traj_0/obs/agent/qpos). Text is kept as rows of bytes, padded with zeros to one length.
`write_trajectories` writes npz files, one for each file name of its rows, from the tasks; they are opened through pyarrow's file systems,
HDF5 files by their local paths. A npz file spends some 800 bytes on the headers of a trajectory of three members; with compression zstd
it is compressed as a whole (a.npz.zst), its members stored as they are. A file that is named is a partition; of a folder (option root) a partition is one of at most SLICES slices of
its npz files, by the crc32 of the name, which its task lists itself. A task holds one file at a time.
"""

from __future__ import annotations

import io
import json
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache
from importlib.util import find_spec
from itertools import islice
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from weft.sources.array_files import LISTS, delete_listed, entries, in_slice, located

SCHEMA = "h5_file string, traj_idx int, t int, key string, value string"
SLICES = 512
FILES = 8
ROWS = 1 << 15
#: Members that are smaller are stored as they are.
DEFLATED = 1 << 10
#: Endings of npz files by their compression.
ENDINGS = {None: ".npz", "zstd": ".npz.zst"}
NPZ = tuple(ENDINGS.values())
LEVEL = 6


def padded_text(row) -> str:
    """Text of a row of bytes that is padded with zeros."""
    return bytes(row).rstrip(b"\0").decode("utf-8", "replace")


def episode_rows(leaves: DataFrame, *more) -> DataFrame:
    """One row per trajectory of the source's rows: file, index, steps, first success, success at the end, object and task, and more aggregates."""
    scene = F.max(F.when(F.col("key") == "obs_scene", F.col("value")))
    success = F.col("key") == "success"
    found = leaves.groupBy("h5_file", "traj_idx").agg(
        F.count_if(success).alias("n_steps"),
        F.coalesce(F.min(F.when(success & (F.col("value") == "true"), F.col("t"))), F.lit(0)).alias("first_success"),
        F.coalesce(F.max_by(F.when(success, F.col("value") == "true"), F.when(success, F.col("t"))), F.lit(False)).alias("success"),
        scene.alias("__scene"),
        *more,
    )
    field = lambda name: F.get_json_object("__scene", f"$.{name}").alias(name)
    own = [c for c in found.columns[5:] if c != "__scene"]
    return found.select("h5_file", "traj_idx", "n_steps", "first_success", "success", field("object_name"), field("task_description"), *own)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Slice(InputPartition):
    def __init__(self, number: int, of: int):
        self.number, self.of = number, of


class TrajectoryReader(DataSourceReader):
    """Leaves of every traj_N group become rows (t, key, value as JSON); those of a folder's files in Arrow batches."""

    def __init__(self, options: dict[str, str]):
        self.paths, self.root = [p for p in options.get("paths", "").split(",") if p], options.get("root")

    def _names(self) -> Iterator[str]:
        system, root = located(self.root)
        return (n for n in entries(system, root, False) if n.endswith(NPZ))

    def partitions(self) -> list[InputPartition]:
        if self.root is None:
            return [_File(p) for p in self.paths]
        of = min(SLICES, 1 + sum(1 for _ in self._names()) // FILES)
        return [_Slice(i, of) for i in range(of)]

    def read(self, partition: _File | _Slice) -> Iterator[tuple | pa.RecordBatch]:
        if isinstance(partition, _Slice):
            _, root = located(self.root)
            for name in self._names():
                if in_slice(name, partition.number, partition.of):
                    yield from batches(_npz_rows(f"{root}/{name}"))
        elif partition.path.endswith(NPZ):
            yield from _npz_rows(partition.path)
        else:
            import h5py

            with h5py.File(partition.path, "r") as file:
                yield from _trajectories(file, partition.path)


def batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of SCHEMA as Arrow batches of ROWS rows."""
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    while some := list(islice(rows, ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names)


def _npz_rows(path: str) -> Iterator[tuple]:
    system, own = located(path)
    with system.open_input_stream(own) as f, zipfile.ZipFile(io.BytesIO(f.read())) as found:
        yield from _trajectories(tree(Members(found)), path)


@lru_cache(4096)
def _header(data: bytes, version: tuple[int, int]) -> tuple:
    read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    return read(io.BytesIO(data))


def array_of(data: bytes) -> np.ndarray:
    """The array of a npy member; equal headers, of which a file has few, are parsed once."""
    version = (data[6], data[7])
    if version > (2, 0):
        return np.lib.format.read_array(io.BytesIO(data))
    wide = 2 if version == (1, 0) else 4
    end = 8 + wide + int.from_bytes(data[8 : 8 + wide], "little")
    shape, by_columns, dtype = _header(data[8:end], version)
    if dtype.hasobject:
        raise ValueError("arrays of Python objects are not read")
    return np.frombuffer(data, dtype, int(np.prod(shape)), end).reshape(shape, order="F" if by_columns else "C")


class Members(Mapping):
    """Arrays of a npz file by their names."""

    def __init__(self, file: zipfile.ZipFile):
        self.file = file

    def __getitem__(self, name: str) -> np.ndarray:
        return array_of(self.file.read(f"{name}.npy"))

    def __iter__(self) -> Iterator[str]:
        return (n.removesuffix(".npy") for n in self.file.namelist())

    def __len__(self) -> int:
        return len(self.file.namelist())


def _trajectories(file, path: str) -> Iterator[tuple]:
    for name in sorted((k for k in file if k.startswith("traj_")), key=lambda k: int(k[5:])):
        yield from leaves(file[name], path, int(name[5:]))


def tree(members) -> dict:
    """Members named by paths as a nested mapping."""
    out: dict = {}
    for name in members:
        *groups, leaf = name.split("/")
        at = out
        for group in groups:
            at = at.setdefault(group, {})
        at[leaf] = members[name]
    return out


def _trajectories(file, path: str) -> Iterator[tuple]:
    for name in sorted((k for k in file if k.startswith("traj_")), key=lambda k: int(k[5:])):
        yield from leaves(file[name], path, int(name[5:]))


def leaves(group, path: str, index: int, prefix: str = "") -> Iterator[tuple]:
    """Rows of all data sets below a group (any nested mapping of arrays)."""
    for key, value in group.items():
        name = f"{prefix}/{key}" if prefix else key
        if hasattr(value, "items"):
            yield from leaves(value, path, index, name)
            continue
        rows = value[()] if getattr(value, "shape", None) == () else value[:]
        if getattr(rows, "ndim", 0) == 0:
            yield path, index, -1, name, rows.decode() if isinstance(rows, bytes) else str(rows)
        else:
            text = rows.dtype.kind == "u" and rows.ndim == 2
            for t, row in enumerate(rows if text else rows.tolist()):
                yield path, index, t, name, padded_text(row) if text else json.dumps(row)


def padded_rows(texts: list[str]) -> np.ndarray:
    """Rows of bytes, padded with zeros to the longest."""
    data = [t.encode() for t in texts]
    width = max(map(len, data), default=0) or 1
    return np.frombuffer(b"".join(d.ljust(width, b"\0") for d in data), np.uint8).reshape(len(data), width)


def written(members, deflated: float = DEFLATED) -> bytes:
    """A npz file of members (name, kind, texts); those of so many bytes are deflated."""
    made = {"text": padded_rows, "json": lambda x: np.array(json.loads(f"[{','.join(x)}]")), "scalar": lambda x: np.array(x[0])}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as file:
        for name, kind, texts in members:
            data = io.BytesIO()
            np.lib.format.write_array(data, made[kind](texts), allow_pickle=False)
            data = data.getvalue()
            file.writestr(f"{name}.npy", data, zipfile.ZIP_DEFLATED if len(data) >= deflated else zipfile.ZIP_STORED)
    return out.getvalue()


@dataclass
class _Written(WriterCommitMessage):
    listed: str  # a file with the paths of what the task has written, a line each


class TrajectoryWriter(DataSourceWriter):
    """Writes rows (file, members: array of (name, kind, texts)); kind is text (padded rows), json (an array of JSON values) or scalar (one text)."""

    def __init__(self, options: dict[str, str]):
        self.root, self.compression = options["path"], options.get("compression")

    def write(self, rows: Iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        system, root = located(self.root)
        codec = pa.Codec(self.compression, compression_level=LEVEL) if self.compression else None
        deflated = inf if codec else DEFLATED  # what is deflated is not compressed again
        system.create_dir(f"{root}/{LISTS}", recursive=True)
        listed = f"{root}/{LISTS}/{uuid.uuid4().hex}"
        with system.open_output_stream(listed) as names:
            for row in rows:
                path = f"{root}/{row.file}{ENDINGS[self.compression]}"
                own = f"{path}.{TaskContext.get().taskAttemptId()}"
                data = written(row.members, deflated)
                with system.open_output_stream(own) as f:
                    f.write(codec.compress(data) if codec else data)
                system.move(own, path)
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


class TrajectoryFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "trajectories"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        reader = TrajectoryReader(dict(self.options))
        if find_spec("h5py") is None and not all(p.endswith(NPZ) for p in reader.paths):
            raise ImportError("reading HDF5 trajectory files needs h5py")
        return reader

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return TrajectoryWriter(dict(self.options))


def write_trajectories(members: DataFrame, root: str, *dealt: str, compression: str | None = None) -> None:
    """members (file, name, kind, texts), a row for each member; the rows of a file meet in one task, which writes it.

    `dealt` names columns that are one for each file and by which the rows are dealt already; then nothing is shuffled. compression is zstd or none.
    """
    members.sparkSession.dataSource.register(TrajectoryFiles)
    files = members.groupBy("file", *dealt).agg(F.collect_list(F.struct("name", "kind", "texts")).alias("members")).select("file", "members")
    writer = files.write.format("trajectories").option("path", root)
    (writer.option("compression", compression) if compression else writer).mode("append").save()


def read_trajectories(spark, root: str) -> DataFrame:
    """Leaves (SCHEMA) of all npz files in a folder; no name goes through the driver."""
    spark.dataSource.register(TrajectoryFiles)
    return spark.read.format("trajectories").option("root", root).load()
