"""Tables that readers only ever see whole: staged writes, named by a commit row.

A publication first writes its rows to a folder of its own; nobody reads that folder until a commit row names it.
Readers follow the newest commit. A writer that dies leaves a folder no commit names, which readers pass
over and :meth:`PublishedTable.clean` removes. A version is published once: writing it again returns what is there.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMIT = "number bigint, version string, folder string, fields string"


class PublishedTable:
    """A table under ``path``, a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, name: str):
        """A folder of the table, and the file system it lies in."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def commits(self) -> DataFrame:
        """number, version, folder and fields of every publication, one row each."""
        folder, files = self._folder("commits")
        if not files.exists(folder):
            return self.spark.createDataFrame([], COMMIT)
        rows = self.spark.read.schema(COMMIT).option("recursiveFileLookup", "true").parquet(f"{self.path}/commits")
        # Two writers of one version may both have got as far as a row: the same one counts for everybody.
        first = F.min(F.struct("number", "folder", "fields")).alias("_first")
        return rows.groupBy("version").agg(first).select("_first.number", "version", "_first.folder", "_first.fields")

    def publish(self, df: DataFrame, version: str) -> DataFrame:
        """Store ``df`` as ``version``, unless it is stored already, and read the newest version."""
        if self.commits().filter(F.col("version") == version).isEmpty():
            folder = f"data/{uuid.uuid4().hex}"
            df.write.parquet(f"{self.path}/{folder}")
            newest = self.commits().agg(F.max("number")).first()[0] or 0
            row = [(newest + 1, version, folder, df.schema.json())]
            self.spark.createDataFrame(row, COMMIT).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return self.read()

    def read(self, version: str | None = None) -> DataFrame:
        """The newest version, or the one named."""
        rows = self.commits()
        if version is not None:
            rows = rows.filter(F.col("version") == version)
        found = rows.orderBy(F.col("number").desc(), F.col("version").desc()).first()
        if found is None:
            raise LookupError(f"nothing published under {self.path}" if version is None else version)
        return self.spark.read.schema(StructType.fromJson(json.loads(found["fields"]))).parquet(f"{self.path}/{found['folder']}")

    def clean(self) -> int:
        """Remove the data of dead writers and of versions before the newest; the number of folders removed.

        For times when nobody writes or reads an older version.
        """
        data, files = self._folder("data")
        if not files.exists(data):
            return 0
        newest = self.commits().orderBy(F.col("number").desc(), F.col("version").desc()).first()
        keep = newest["folder"].split("/")[1] if newest else None
        gone = [s.getPath() for s in files.listStatus(data) if s.getPath().getName() != keep]
        for folder in gone:
            files.delete(folder, True)
        return len(gone)
