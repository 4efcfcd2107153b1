"""A table of batches that may be written again: data first, then one name that publishes it.

A batch's rows are written to a folder of their own, which no reader knows.
Then a small manifest with the batch's name is renamed into place, which the
file system does whole or not at all and never over another one.  So a batch
that fails half-way is invisible, a batch that is replayed under its name is a
no-op, and of two writers of one batch one wins.  Readers list the manifests,
never the data folders.

:meth:`BatchTable.compact` puts many batches into one folder under a base
manifest; the names stay known, so replays of merged batches stay no-ops.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Files:
    """The few file system calls that a commit needs, through Hadoop's client."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.fs = self.at(path).getFileSystem(self.conf)

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(path))) if self.fs.exists(self.at(path)) else []

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.at(path))

    def text(self, path: str) -> str:
        stream = self.fs.open(self.at(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> bool:
        """Put ``text`` at ``path`` whole; False where there is something already."""
        draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        stream = self.fs.create(self.at(draft), False)
        stream.write(text.encode())
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.at(path).toUri(), self.conf)
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        if not self.exists(path):
            try:
                context.rename(self.at(draft), self.at(path), none)
                return True
            except Exception:  # noqa: BLE001 - the other writer's name is what counts
                if not self.exists(path):
                    raise
        self.fs.delete(self.at(draft), False)
        return False

    def remove(self, path: str) -> None:
        self.fs.delete(self.at(path), True)


class BatchTable:
    """Batches of rows of one schema under ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.files = Files(spark, self.path)

    def _manifests(self) -> dict[str, str]:
        """Folder by batch name."""
        return {n: self.files.text(f"{self.path}/_batches/{n}") for n in self.files.names(f"{self.path}/_batches") if not n.startswith(".")}

    def _base(self) -> dict:
        names = [n for n in self.files.names(f"{self.path}/_bases") if not n.startswith(".")]
        return json.loads(self.files.text(f"{self.path}/_bases/{names[-1]}")) | {"at": int(names[-1])} if names else {"at": -1, "folder": None, "batches": []}

    def batches(self) -> list[str]:
        """Names of the published batches, in order of their names."""
        return sorted(self._manifests())

    def holds(self, batch: str | int) -> bool:
        return self.files.exists(f"{self.path}/_batches/{_name(batch)}")

    def write(self, rows: DataFrame, batch: str | int) -> bool:
        """Add a batch; False, and nothing done, where a batch of this name is there."""
        if self.holds(batch):
            return False
        folder = f"data/{_name(batch)}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        if self.files.publish(f"{self.path}/_batches/{_name(batch)}", folder):
            return True
        self.files.remove(f"{self.path}/{folder}")
        return False

    def read(self, only: Callable[[str], bool] | None = None) -> DataFrame:
        """The rows of all published batches, or of those that ``only`` takes by name."""
        base, found = self._base(), self._manifests()
        if only is not None:
            folders = [f for n, f in found.items() if only(n)]
        else:
            folders = [f for n, f in found.items() if n not in set(base["batches"])] + ([base["folder"]] if base["folder"] else [])
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def compact(self, files: int | None = None) -> None:
        """One folder for all batches of today; what it replaces is removed after it is published."""
        base, found = self._base(), self._manifests()
        folder = f"data/base-{uuid.uuid4().hex}"
        rows = self.read()
        (rows.repartition(files) if files else rows).write.parquet(f"{self.path}/{folder}")
        if not self.files.publish(f"{self.path}/_bases/{base['at'] + 1:012d}", json.dumps({"folder": folder, "batches": sorted(found)})):
            self.files.remove(f"{self.path}/{folder}")
            return
        for old in [f for n, f in found.items() if n not in set(base["batches"])] + [base["folder"]]:
            if old:
                self.files.remove(f"{self.path}/{old}")


def _name(batch: str | int) -> str:
    """A batch's manifest name: whole numbers sort as such."""
    return f"{batch:020d}" if isinstance(batch, int) else batch


def each_batch(table: BatchTable, made: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes what ``made`` makes of each batch once, replays included.

    A replay is computed all the same, for nothing: the state stores of the
    stream commit only as their tasks run.
    """

    def run(rows: DataFrame, batch: int) -> None:
        if not table.write(made(rows), batch):
            rows.write.format("noop").mode("overwrite").save()

    return run
