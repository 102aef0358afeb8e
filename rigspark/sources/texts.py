"""Many small text files, each under a name of its own: written and read by tasks through Arrow's file systems.

Spark's file sources name files themselves, and the driver has to list every one of them before any is read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .ply import _local, _place

#: Files whose texts a batch holds.
FILES = 256


class NamedTexts(DataSource):
    """``format("named_texts")``, to write ``name`` (relative to the folder in path) and ``value``; neighbouring rows of one name are one file."""

    @classmethod
    def name(cls) -> str:
        return "named_texts"

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(_local(self.options["path"]).rstrip("/"), self.options.get("end", ""))


class _Writer(DataSourceArrowWriter):
    """A file takes its name once it is whole, so attempts of one task may replace each other's."""

    def __init__(self, folder: str, end: str):
        self.folder, self.end = folder, end

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        (system, root), attempt, made = _place(self.folder), TaskContext.get().taskAttemptId(), set()

        def files(values: Iterator[tuple[str, str]]) -> None:
            for name, own in groupby(values, itemgetter(0)):
                folder, _, leaf = f"{root}/{name}".rpartition("/")
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(f"{folder}/.{leaf}.{attempt}") as f:
                    for _, value in own:
                        f.write(value.encode())
                system.move(f"{folder}/.{leaf}.{attempt}", f"{folder}/{leaf}")

        def rows() -> Iterator[tuple[str, str]]:
            for batch in iterator:
                for name, value in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist(), strict=True):
                    if name is None or value is None:
                        raise ValueError(f"no {'name' if name is None else 'text of ' + name}")
                    yield name, value + self.end

        files(rows())
        return WriterCommitMessage()


def write_texts(df: DataFrame, folder: str, end: str = "", replace: bool = False) -> None:
    """The ``value`` of each row, and ``end`` behind it, as the file ``name`` under ``folder``. All rows of a name lie next to each other in one partition.

    With ``replace`` all that the folder held goes first.
    """
    if replace:
        system, name = _place(_local(folder))
        if system.get_file_info(name).type == fs.FileType.Directory:
            system.delete_dir(name)
    df.sparkSession.dataSource.register(NamedTexts)
    df.select("name", "value").write.format("named_texts").option("end", end).mode("append").save(folder)


def opens(path: str) -> bool:
    """Whether Arrow finds the path as it is: no pattern, on this machine or in a store that it knows."""
    try:
        system, name = _place(path)
    except (pa.ArrowException, OSError):
        return False
    return not set("*?[{") & set(name) and system.get_file_info(name).type != fs.FileType.NotFound


def _seen(name: str) -> bool:
    return not name.rpartition("/")[2].startswith(("_", "."))


def read_texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path and value of the files given and of all files under the folders given, those hidden left out.

    The driver lists the folders themselves; tasks list what is below, and files are dealt anew before they are read.
    """

    def inside(system: fs.FileSystem, name: str, recursive: bool) -> list[fs.FileInfo]:
        return [f for f in system.get_file_info(fs.FileSelector(name, recursive=recursive)) if all(map(_seen, f.path[len(name) + 1 :].split("/")))]

    def prefixed(path: str, name: str, found: str) -> str:
        return path.rstrip("/") + found[len(name.rstrip("/")) :]

    tops = []
    for path in map(_local, paths):
        system, name = _place(path)
        info = system.get_file_info(name)
        tops += [path] if info.type == fs.FileType.File else [prefixed(path, name, f.path) for f in inside(system, name.rstrip("/"), False)]

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                system, name = _place(path)
                if system.get_file_info(name).type == fs.FileType.File:
                    out.append(path)
                else:
                    out += [prefixed(path, name, f.path) for f in inside(system, name, True) if f.type == fs.FileType.File]
            yield pa.RecordBatch.from_pydict({"path": pa.array(out, pa.string())})

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, FILES):
                part, out = batch.slice(at, FILES), []
                for path in part.column("path").to_pylist():
                    system, name = _place(path)
                    with system.open_input_stream(name) as f:  # unpacked as its ending says
                        data = f.read()
                    out.append(data.decode(json.detect_encoding(data), "replace"))
                yield pa.RecordBatch.from_pydict({"path": part.column("path"), "value": pa.array(out, pa.string())})

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    given = spark.createDataFrame([(t,) for t in tops], "path string").repartition(tasks)
    return given.mapInArrow(below, "path string").repartition(tasks).mapInArrow(texts, "path string, value string")
