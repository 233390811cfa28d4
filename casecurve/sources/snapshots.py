"""Stores whose appends can be repeated: a batch counts once, however often it is written.

A Python data source writes the batch's rows as Parquet files, one per task. Nobody reads them until the commit
on the driver lists them in a new snapshot, together with the batch's name. A batch that the newest
snapshot already names adds nothing; a write that breaks off leaves at most files that no snapshot lists.
Readers take a snapshot's files and read them with Spark's own Parquet reader.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "casecurve_snapshots"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path. A scheme that pyarrow does not know raises an error."""
    return fs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """A task's file; None if it had no rows."""

    file: str | None
    rows: int


class SnapshotWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch: str, overwrite: bool):
        self.path, self.batch, self.overwrite = path, batch, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, plain = located(self.path)
        name, writer, rows = f"data/{uuid.uuid4().hex}.parquet", None, 0
        for batch in iterator:
            if writer is None and batch.num_rows:
                system.create_dir(f"{plain}/data", recursive=True)
                writer = pq.ParquetWriter(f"{plain}/{name}", batch.schema, filesystem=system)
            if batch.num_rows:
                writer.write_batch(batch)
                rows += batch.num_rows
        if writer is None:
            return Written(None, 0)
        writer.close()
        return Written(name, rows)

    def commit(self, messages: list[Written | None]) -> None:
        newest = latest_version(self.path)
        entries = [] if newest is None else snapshot(self.path, newest)["batches"]
        files = [m.file for m in messages if m is not None and m.file]
        if any(b["name"] == self.batch for b in entries) and not self.overwrite:
            self._drop(files)
            return
        batch = {"name": self.batch, "files": files, "rows": sum(m.rows for m in messages if m is not None)}
        _publish(self.path, 0 if newest is None else newest + 1, [batch] if self.overwrite else [*entries, batch])

    def abort(self, messages: list[Written | None]) -> None:
        self._drop([m.file for m in messages if m is not None and m.file])

    def _drop(self, files: list[str]) -> None:
        """Files of this write that no snapshot lists."""
        system, plain = located(self.path)
        for name in files:
            system.delete_file(f"{plain}/{name}")


def _publish(path: str, version: int, batches: list[dict]) -> None:
    system, plain = located(path)
    system.create_dir(f"{plain}/snapshots", recursive=True)
    target, draft = f"{plain}/snapshots/{version:010d}.json", f"{plain}/snapshots/.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(json.dumps({"version": version, "batches": batches}).encode())
    # A snapshot is there as a whole or not at all.
    system.move(draft, target)


def versions(path: str) -> list[int]:
    system, plain = located(path)
    found = system.get_file_info(fs.FileSelector(f"{plain}/snapshots", allow_not_found=True))
    return sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json"))


def latest_version(path: str) -> int | None:
    found = versions(path)
    return found[-1] if found else None


def snapshot(path: str, version: int) -> dict:
    system, plain = located(path)
    with system.open_input_stream(f"{plain}/snapshots/{version:010d}.json") as f:
        return json.loads(f.read())


class SnapshotSource(DataSource):
    """``df.write.format("casecurve_snapshots").option("path", ...).option("batch", ...)``, append or overwrite."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> SnapshotWriter:
        missing = [o for o in ("path", "batch") if not self.options.get(o)]
        if missing:
            raise ValueError(f"options {', '.join(missing)} are needed")
        return SnapshotWriter(self.options["path"], self.options["batch"], overwrite)


def write_batch(df: DataFrame, path: str, batch: str, overwrite: bool = False) -> None:
    """Adds the rows as batch ``batch``, unless the store has it; with ``overwrite`` it becomes the only one.

    The name stands for the rows: a rerun of the same job writes under the same name. One writer at a time.
    """
    df.sparkSession.dataSource.register(SnapshotSource)
    mode = "overwrite" if overwrite else "append"
    df.write.format(FORMAT).mode(mode).option("path", path).option("batch", batch).save()


def read_snapshot(spark: SparkSession, path: str, schema: str, version: int | None = None) -> DataFrame:
    """The rows of a snapshot, the newest by default; none for a store that was never written."""
    wanted = latest_version(path) if version is None else version
    if wanted is None:
        return spark.createDataFrame([], schema)
    files = [f"{path}/{f}" for b in snapshot(path, wanted)["batches"] for f in b["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def batches(path: str, version: int | None = None) -> dict[str, int]:
    """Rows by batch name."""
    wanted = latest_version(path) if version is None else version
    return {} if wanted is None else {b["name"]: b["rows"] for b in snapshot(path, wanted)["batches"]}
