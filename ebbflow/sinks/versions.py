"""Tables of partitions that are replaced as a whole and committed by one small file.

Every write goes to a folder of its own; a numbered commit file then names the
folder that holds each partition. A reader takes the highest commit, so it sees
all of a write or nothing. A commit is created, never overwritten: of two
writers that start from the same commit, the second one fails. What a commit
no longer names is deleted after the next one. A commit has one line a
partition (dates of a window, so tens), and the names of the batches applied,
so that a batch that Spark repeats after a failure adds nothing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Commit:
    number: int = 0
    folders: dict[str, str] = field(default_factory=dict)  # partition value -> folder below the root
    applied: list[str] = field(default_factory=list)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, partition_col: str):
        self.spark, self.root, self.partition_col = spark, root.rstrip("/"), partition_col
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _commits(self) -> list[int]:
        folder = self._path(f"{self.root}/_commits")
        if not self._fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(folder) if s.getPath().getName().isdigit())

    def _load(self, number: int) -> Commit:
        text = "\n".join(r["value"] for r in self.spark.read.text(f"{self.root}/_commits/{number:010d}").collect())
        made = json.loads(text)
        return Commit(number, made["folders"], made["applied"])

    def current(self) -> Commit:
        numbers = self._commits()
        return self._load(numbers[-1]) if numbers else Commit()

    def read(self, schema, values: list[str] | None = None, commit: Commit | None = None) -> DataFrame:
        """Rows of the current commit, of these partitions or of all."""
        folders = (commit or self.current()).folders
        wanted = sorted({f for v, f in folders.items() if values is None or v in values})
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in wanted])

    def write(self, rows: DataFrame, values: list[str]) -> dict[str, str]:
        """Write the rows of these partitions, each to a new folder; nothing is visible yet."""
        version = f"v-{uuid.uuid4().hex[:12]}"
        key = "__partition"
        (rows.withColumn(key, F.coalesce(F.col(f"`{self.partition_col}`").cast("string"), F.lit(""))).hint("rebalance", F.col(key))
         .write.mode("errorifexists").option("compression", "zstd").partitionBy(key).parquet(f"{self.root}/{version}"))
        made = {v: f"{version}/{key}={v}" for v in values}
        return {v: f for v, f in made.items() if self._fs.exists(self._path(f"{self.root}/{f}"))}

    def commit(self, base: Commit, folders: dict[str, str], applied: list[str]) -> None:
        """Make ``folders`` the table, if no one has committed since ``base``."""
        stream = self._fs.create(self._path(f"{self.root}/_commits/{base.number + 1:010d}"), False)
        stream.write(bytearray(json.dumps({"folders": folders, "applied": applied}).encode()))
        stream.close()
        self._clean(base, folders)

    def _clean(self, base: Commit, folders: dict[str, str]) -> None:
        """Drop what the commit before ``base`` named and neither ``base`` nor the new one does: readers of ``base`` go on."""
        if base.number < 2:
            return
        before = self._path(f"{self.root}/_commits/{base.number - 1:010d}")
        if not self._fs.exists(before):
            return
        kept = set(folders.values()) | set(base.folders.values())
        for f in set(self._load(base.number - 1).folders.values()) - kept:
            self._fs.delete(self._path(f"{self.root}/{f}"), True)
        self._fs.delete(before, False)
