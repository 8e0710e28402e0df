"""A frame dataset that is read by index and changed in place, with a log of commits.

Rows lie in blocks of ``BLOCK`` consecutive indices per key.  A commit writes the blocks it touches anew and
then a list of every live block with its file; readers follow the newest complete list.  A write
that dies before its list is in place, or a task that is repeated, leaves files that no list names.
The same list tells which files hold asked frames, so that only these are opened.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.operators.skew import join_null_safe

BLOCK = 4096


class FrameStore:
    """Frames below ``path``, one row per ``keys`` and ``idx``.  Null is a key of its own."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], idx: str = "idx", block: int = BLOCK):
        self.spark, self.path, self.keys, self.idx, self.block = spark, path.rstrip("/"), keys, idx, block

    def _file_system(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def version(self) -> int:
        """Number of the newest commit, 0 before the first."""
        fs, place = self._file_system(f"{self.path}/_log")
        if not fs.exists(place):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return max([int(n) for n in names if n.isdigit()], default=0)

    def _blocked(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({"_k": F.xxhash64(*self.keys), "_b": F.floor(F.col(self.idx) / self.block)})

    def _live(self, version: int | None = None) -> DataFrame:
        """``file, _k, _b`` of every live block."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], "file string, _k bigint, _b bigint")
        return self.spark.read.parquet(f"{self.path}/_log/{version}")

    def _rows(self, live: DataFrame, files: list[str]) -> DataFrame:
        """Rows of live blocks in the given files."""
        data = self.spark.read.parquet(*files)
        return data.withColumn("file", F.col("_metadata.file_path")).join(live, ["file", "_k", "_b"], "left_semi").drop("file", "_k", "_b")

    def read(self, version: int | None = None) -> DataFrame:
        """All frames, as of the newest or an earlier commit."""
        return self._rows(self._live(version), [f"{self.path}/data/*"])

    def files_of(self, asked: DataFrame) -> list[str]:
        """Files that hold blocks of the asked ``keys, idx``, or of ``idx`` under any key."""
        by_key = set(self.keys) <= set(asked.columns)
        blocks = self._blocked(asked).select("_k", "_b") if by_key else asked.select(F.floor(F.col(self.idx) / self.block).alias("_b"))
        # No more than the files of the dataset, whose names the driver holds for any scan.
        found = self._live().join(blocks.distinct(), blocks.columns, "left_semi").select("file").distinct()
        return sorted(r.file for r in found.collect())

    def read_frames(self, asked: DataFrame) -> DataFrame:
        """The asked frames, by ``keys, idx`` or by ``idx`` alone; files without them aren't opened."""
        files = self.files_of(asked)
        on = [*self.keys, self.idx] if set(self.keys) <= set(asked.columns) else [self.idx]
        rows = self._rows(self._live(), files) if files else self.read().limit(0)
        return join_null_safe(rows, asked.select(*on).distinct(), on, "left_semi")

    def upsert(self, rows: DataFrame) -> int:
        """Replace or add frames, one row each; returns the commit's number.  Blocks that aren't touched stay as they are.

        Rows of a block are put together by one task, of at most ``block`` old and as many new rows.
        """
        before = self.version()
        live = self._live(before)
        new = self._blocked(rows)
        touched = new.select("_k", "_b").distinct()
        if before:
            files = [r.file for r in live.join(touched, ["_k", "_b"], "left_semi").select("file").distinct().collect()]
            if files:
                old = self._blocked(self._rows(live.join(touched, ["_k", "_b"], "left_semi"), files))
                kept = join_null_safe(old, rows.select(*self.keys, self.idx), [*self.keys, self.idx], "left_anti")
                new = kept.unionByName(new, allowMissingColumns=True)
        target = f"{self.path}/data/{uuid.uuid4().hex}"
        new.repartition("_k", "_b").sortWithinPartitions("_k", self.idx).write.parquet(target)
        written = self.spark.read.schema(new.schema).parquet(target)
        made = written.select(F.col("_metadata.file_path").alias("file"), "_k", "_b").distinct()
        stay = live.join(made.select("_k", "_b"), ["_k", "_b"], "left_anti")
        return self._commit(stay.unionByName(made), before + 1)

    def _commit(self, live: DataFrame, number: int) -> int:
        """Write the list of live blocks aside, then move it into place; only one of two writers can."""
        aside, place = f"{self.path}/_log/_{uuid.uuid4().hex}", f"{self.path}/_log/{number}"
        live.write.parquet(aside)
        fs, target = self._file_system(place)
        if fs.exists(target) or not fs.rename(self._file_system(aside)[1], target):
            raise RuntimeError(f"commit {number} was made by another writer; read again and repeat")
        return number

    def resume(self, rows: DataFrame) -> int:
        """Write the rows whose frames aren't there yet."""
        if not self.version():
            return self.upsert(rows)
        on = [*self.keys, self.idx]
        return self.upsert(join_null_safe(rows, self.read().select(*on), on, "left_anti"))
