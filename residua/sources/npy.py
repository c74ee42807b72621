"""Matrices in .npy files as a Spark data source, so that no row passes through the driver.

`spark.read.format("npy")` maps the file into each task and reads ranges of rows; `df.write.format("npy")` lets
each task put its rows at their places in a file that has its whole size from the start. Beside NAME.npy
stands NAME_hashes.npy with the hashes of its rows. Paths must be mounted on all machines, as numpy opens them.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "row long, sequence_hash string, vector array<float>"
#: Rows of a partition, and bytes of an Arrow batch, about.
ROWS, BATCH = 1 << 16, 4 << 20
HASH = np.dtype("<U64")


def local(path: str) -> str:
    """A path that numpy can open; raises for one that only Spark reads."""
    path = path.removeprefix("file://") if path.startswith("file://") else path.removeprefix("file:")
    if "://" in path:
        raise ValueError(f"{path} is not a mounted path")
    return path


@dataclass
class _Range(InputPartition):
    start: int
    stop: int

    def __init__(self, start: int, stop: int):
        super().__init__((start, stop))
        self.start, self.stop = start, stop


class _Reader(DataSourceReader):
    def __init__(self, path: str, rows: int, columns: list[str]):
        self.path, self.rows, self.columns = path, rows, columns

    def partitions(self) -> list[_Range]:
        n = len(np.load(f"{self.path}.npy", mmap_mode="r"))  # only its header is read
        return [_Range(k, min(k + self.rows, n)) for k in range(0, n, self.rows)] or [_Range(0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        matrix = np.load(f"{self.path}.npy", mmap_mode="r") if "vector" in self.columns else None
        hashes = np.load(f"{self.path}_hashes.npy", mmap_mode="r") if "sequence_hash" in self.columns else None
        width = matrix.shape[1] if matrix is not None else 1
        step = max(1, BATCH // (4 * max(width, 1)))
        for at in range(partition.start, partition.stop, step):
            to, out = min(at + step, partition.stop), {}
            if "row" in self.columns:
                out["row"] = pa.array(np.arange(at, to))
            if hashes is not None:
                out["sequence_hash"] = pa.array(hashes[at:to].tolist(), pa.string())
            if matrix is not None:
                offsets = pa.array(np.arange(0, (to - at + 1) * width, width, dtype=np.int32) if width else np.zeros(to - at + 1, np.int32))
                out["vector"] = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix[at:to], np.float32).ravel()))
            yield pa.RecordBatch.from_arrays([out[c] for c in self.columns], names=self.columns)


@dataclass
class _Written(WriterCommitMessage):
    rows: int


class _Writer(DataSourceArrowWriter):
    """Each task writes rows (row, sequence_hash, vector) at their places; a task that runs again writes the same bytes."""

    def __init__(self, path: str, rows: int, width: int):
        self.path, self.rows, self.width = path, rows, width
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        np.lib.format.open_memmap(self._part(".npy"), mode="w+", dtype=np.float32, shape=(rows, width)).flush()
        np.lib.format.open_memmap(self._part("_hashes.npy"), mode="w+", dtype=HASH, shape=(rows,)).flush()

    def _part(self, end: str) -> str:
        return f"{self.path}{end}.partial"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        matrix, hashes = (np.lib.format.open_memmap(self._part(e), mode="r+") if self.rows else None for e in (".npy", "_hashes.npy"))
        n = 0
        for batch in iterator:
            if not len(batch):
                continue
            at = batch.column("row").to_numpy()
            if batch.column("vector").null_count or (np.diff(batch.column("vector").offsets.to_numpy()) != self.width).any():
                raise ValueError(f"a vector without {self.width} numbers")
            matrix[at] = batch.column("vector").flatten().to_numpy().reshape(-1, self.width)
            hashes[at] = batch.column("sequence_hash").to_pylist()
            n += len(batch)
        if matrix is not None:
            matrix.flush(), hashes.flush()
        return _Written(n)

    def commit(self, messages: list[_Written | None]) -> None:
        n = sum(m.rows for m in messages if m is not None)
        if n != self.rows:
            self.abort(messages)
            raise ValueError(f"{n} rows written, {self.rows} expected")
        for end in ("_hashes.npy", ".npy"):
            os.replace(self._part(end), f"{self.path}{end}")

    def abort(self, messages: list[_Written | None]) -> None:
        for end in (".npy", "_hashes.npy"):
            if os.path.exists(self._part(end)):
                os.remove(self._part(end))


class Npy(DataSource):
    """Options: path (without .npy), and for reading rows (of a partition), for writing rows and width (of the matrix)."""

    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(local(self.options["path"]), int(self.options.get("rows", ROWS)), schema.names)

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        if not overwrite:
            raise ValueError("a matrix can only be written whole: mode overwrite")
        return _Writer(local(self.options["path"]), int(self.options["rows"]), int(self.options["width"]))


def read_npy(spark: SparkSession, path: str, columns: tuple[str, ...] = ("sequence_hash", "vector"), rows: int = ROWS) -> DataFrame:
    """Columns of SCHEMA of a matrix and its hashes; what isn't asked for isn't read."""
    spark.dataSource.register(Npy)
    kinds = dict(x.split() for x in SCHEMA.split(", "))
    return spark.read.format("npy").schema(", ".join(f"{c} {kinds[c]}" for c in columns)).option("rows", rows).load(path)


def write_npy(rows: DataFrame, path: str, count: int, width: int) -> None:
    """Write rows (row, sequence_hash, vector) of a matrix of count rows, each at its row; the older files go when all is there."""
    rows.sparkSession.dataSource.register(Npy)
    rows.select("row", "sequence_hash", rows["vector"].cast("array<float>").alias("vector")).write.format("npy").mode("overwrite").option("rows", count).option("width", width).save(path)
