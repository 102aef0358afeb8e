"""A batch data source of binary point tables: little-endian float records behind a text header.

Paths are of this machine's file system or, as URIs (``hdfs:``, ``s3:``, ``gs:``, ``abfs:``), of any that Arrow opens;
tasks read byte ranges of files and write whole files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

MOST_HEADER = 1 << 16
ROWS = 65_536
#: Tasks that a table is read by at most, however many files and ranges it has.
TASKS = 256


def parse_header(data: bytes) -> tuple[int, list[str], dict[str, str], int]:
    """Rows, property names, 'key value' comments and the body's first byte. Only float properties are readable."""
    end = data.find(b"end_header\n")
    if not data.startswith(b"ply\n") or end < 0:
        raise ValueError("no point table header")
    n, names, comments, inside = 0, [], {}, False
    for line in data[:end].decode("ascii", "replace").splitlines():
        parts = line.split()
        if parts[:1] == ["format"] and parts[1] != "binary_little_endian":
            raise ValueError(f"unreadable format {parts[1]}")
        if parts[:1] == ["comment"] and len(parts) > 2:
            comments[parts[1]] = " ".join(parts[2:])
        if parts[:1] == ["element"]:
            inside = parts[1] == "vertex"
            n = int(parts[2]) if inside else n
        if parts[:1] == ["property"] and inside:
            if parts[1] not in ("float", "float32"):
                raise ValueError(f"property {parts[-1]} is no float")
            names.append(parts[2])
    return n, names, comments, end + len(b"end_header\n")


def _local(path: str) -> str:
    return unquote(urlparse(path).path) if path.startswith("file:") else path


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), _local(path))


def _head(path: str) -> bytes:
    system, name = _place(path)
    with system.open_input_file(name) as f:
        return f.read_at(MOST_HEADER, 0)


def _tables_of(path: str) -> list[str]:
    """The file itself, or the point tables of a folder in name order."""
    system, name = _place(path)
    if system.get_file_info(name).type != fs.FileType.Directory:
        return [path]
    inside = system.get_file_info(fs.FileSelector(name))
    return sorted(f"{path.rstrip('/')}/{f.base_name}" for f in inside if f.base_name.endswith(".ply"))


@dataclass
class _Range:
    path: str
    start: int
    first: int
    count: int
    names: list[str]


class _Ranges(InputPartition):
    def __init__(self, ranges: list[_Range]):
        self.ranges = ranges


def _joined(ranges: list[_Range]) -> list[_Range]:
    """Ranges in order, neighbours in one file as one, so that each file is opened once."""
    out: list[_Range] = []
    for r in ranges:
        if out and out[-1].path == r.path and out[-1].first + out[-1].count == r.first:
            out[-1] = _Range(r.path, r.start, out[-1].first, out[-1].count + r.count, r.names)
        else:
            out.append(r)
    return out


class SplatPly(DataSource):
    """``format("splat_ply")``, to read and to write.

    Reading: path (comma-separated files or folders), columns (optional), rows (records a range), tasks (ranges beyond
    so many are dealt over so many tasks). Writing: path (a folder), rows (records a file), comments (a JSON object for the headers).
    """

    @classmethod
    def name(cls) -> str:
        return "splat_ply"

    def _files(self) -> list[str]:
        return [f for p in self.options["path"].split(",") for f in _tables_of(_local(p))]

    def schema(self) -> str:
        names = parse_header(_head(self._files()[0]))[1]
        wanted = self.options.get("columns")
        names = wanted.split(",") if wanted else names
        return "path string, splat_id long, " + ", ".join(f"`{n}` float" for n in names)

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self._files(), [f.name for f in schema.fields[2:]], int(self.options.get("rows", 1_000_000)), int(self.options.get("tasks", TASKS)))

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        comments = json.loads(self.options.get("comments", "{}"))
        return _Writer(_local(self.options["path"]), schema.names, comments, int(self.options.get("rows", 262_144)), overwrite)


class _Reader(DataSourceReader):
    def __init__(self, files: list[str], columns: list[str], rows: int, tasks: int):
        self.files, self.columns, self.rows, self.tasks = files, columns, rows, tasks

    def _ranges(self, path: str) -> list[_Range]:
        n, names, _, start = parse_header(_head(path))
        if missing := set(self.columns) - set(names):
            raise ValueError(f"{path} lacks {', '.join(sorted(missing))}")
        system, name = _place(path)
        if system.get_file_info(name).size < start + 4 * n * len(names):
            raise ValueError(f"{path} is truncated")
        return [_Range(path, start, a, min(self.rows, n - a), names) for a in range(0, n, self.rows)]

    def partitions(self) -> list[InputPartition]:
        """One task a range, or neighbouring ranges together where there are more than ``tasks``."""
        with ThreadPoolExecutor(16) as pool:  # many short reads
            ranges = [r for own in pool.map(self._ranges, self.files) for r in own]
        each = max(1, -(-len(ranges) // self.tasks))
        return [_Ranges(_joined(ranges[a : a + each])) for a in range(0, len(ranges), each)] or [_Ranges([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for p in partition.ranges:
            width, (system, name) = len(p.names), _place(p.path)
            with system.open_input_file(name) as f:
                for a in range(p.first, p.first + p.count, ROWS):
                    n = min(ROWS, p.first + p.count - a)
                    data = np.frombuffer(f.read_at(4 * n * width, p.start + 4 * a * width), "<f4").reshape(n, width)
                    columns = [pa.array([p.path] * n), pa.array(np.arange(a, a + n))] + [pa.array(np.ascontiguousarray(data[:, p.names.index(c)])) for c in self.columns]
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "splat_id", *self.columns])


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class _Writer(DataSourceArrowWriter):
    """Each attempt of a task writes files of its own, of at most ``rows`` records; those of attempts that were not committed are removed at the end."""

    def __init__(self, folder: str, columns: list[str], comments: dict, rows: int, overwrite: bool):
        self.folder, self.columns, self.comments, self.rows = folder.rstrip("/"), columns, comments, rows
        self.job = uuid.uuid4().hex
        self.overwrite = overwrite

    def _save(self, name: str, data: np.ndarray) -> None:
        head = ["ply", "format binary_little_endian 1.0", *(f"comment {k} {v}" for k, v in self.comments.items()), f"element vertex {len(data)}"]
        text = "\n".join([*head, *(f"property float {c}" for c in self.columns), "end_header\n"])
        system, folder = _place(self.folder)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{name}") as f:
            f.write(text.encode("ascii"))
            f.write(np.ascontiguousarray(data, "<f4").tobytes())

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        attempt, files, waiting, held = TaskContext.get(), [], [], 0

        def save(least: int) -> None:
            nonlocal waiting, held
            while held >= least and held:
                data = np.concatenate(waiting)
                files.append(f"part-{self.job}-{attempt.partitionId():06d}-{len(files):06d}-{attempt.taskAttemptId()}.ply")
                self._save(files[-1], data[: self.rows])
                waiting, held = [data[self.rows :]], max(held - self.rows, 0)

        for batch in iterator:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                if lacking := [c for c in self.columns if piece.column(c).null_count]:
                    raise ValueError(f"null in {', '.join(lacking)}")
                waiting.append(np.column_stack([piece.column(c).to_numpy(zero_copy_only=False).astype("<f4") for c in self.columns]))
                held += piece.num_rows
                save(self.rows)
        save(1)
        return _Written(files)

    def _remove(self, wanted) -> None:
        system, folder = _place(self.folder)
        for f in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if f.base_name.endswith(".ply") and not wanted(f.base_name):
                system.delete_file(f.path)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Earlier tables go only now that the new ones are whole; a table without rows is a file without records."""
        whole = {f for m in messages if m for f in m.files}
        if not whole:
            whole = {f"part-{self.job}-000000-000000-0.ply"}
            self._save(*whole, np.zeros((0, len(self.columns))))
        self._remove(lambda f: f in whole or not (self.overwrite or self.job in f))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._remove(lambda f: self.job not in f)


def read_splat_ply(spark: SparkSession, paths: list[str], columns: list[str] | None = None, rows: int = 1_000_000) -> DataFrame:
    """path, splat_id (the record's place in its file) and float columns of files and folders, one task for each ``rows`` records, and at most ``TASKS`` of them or four a core."""
    spark.dataSource.register(SplatPly)
    reader = spark.read.format("splat_ply").option("rows", rows).option("tasks", max(TASKS, 4 * spark.sparkContext.defaultParallelism))
    if columns:
        reader = reader.option("columns", ",".join(columns))
    return reader.load(",".join(paths))


def write_splat_ply(df: DataFrame, folder: str, comments: dict | None = None, rows: int = 262_144, mode: str = "append") -> None:
    """All columns of ``df`` as 32-bit floats in files of at most ``rows`` records; ``comments`` go into each header. A null has no place in a record and is an error.

    A task holds one file's records. With ``mode="overwrite"`` earlier point tables of the folder are removed once all new ones are written.
    """
    df.sparkSession.dataSource.register(SplatPly)
    df.write.format("splat_ply").option("rows", rows).option("comments", json.dumps(comments or {})).mode(mode).save(folder)


def read_static_splats(spark: SparkSession, paths: list[str], frame_pattern: str = r"(\d+)\.ply$") -> DataFrame:
    """Static splats of many frames; the frame is in the file's name."""
    df = read_splat_ply(spark, paths)
    return df.withColumn("frame", F.regexp_extract("path", frame_pattern, 1).cast("int"))


def ply_headers(spark: SparkSession, path: str) -> DataFrame:
    """path, n, properties and comments from the head of each file under ``path``; nothing behind the head is read."""

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for p in pdf["path"]:
                n, names, comments, _ = parse_header(_head(p))
                out.append((p, n, names, list(comments.items())))
            made = pd.DataFrame(out, columns=["path", "n", "properties", "comments"])
            made["comments"] = made["comments"].map(dict)
            yield made

    files = spark.read.format("binaryFile").load(path).select("path")
    return files.mapInPandas(heads, "path string, n long, properties array<string>, comments map<string,string>")


def read_clips(spark: SparkSession, path: str, sidecars: DataFrame | None = None) -> DataFrame:
    """Clip scalars of each table: a sidecar row (path and scalars) overrides the header's comments; a missing one is an error."""
    heads = ply_headers(spark, path)
    fields = {"time_min": "double", "time_max": "double", "fps": "double", "motion_degree": "int"}
    out = heads.select("path", "n", *(F.col("comments")[c].try_cast(t).alias(c) for c, t in fields.items()))
    if sidecars is not None:
        own = sidecars.select("path", *(F.col(c).alias(f"s_{c}") for c in fields))
        out = out.join(own, "path", "left").select("path", "n", *(F.coalesce(f"s_{c}", c).alias(c) for c in fields))
    need = [F.coalesce(c, F.raise_error(F.lit(f"no {c}")).cast(t)).alias(c) for c, t in fields.items()]
    return out.select("path", F.col("n").alias("splat_count"), *need)
