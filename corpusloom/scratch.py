"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = known.get() if known.isDefined() else None
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="corpusloom-")
        spark.sparkContext.setCheckpointDir(root)
    return root


class Scratch:
    """Writes a DataFrame once and reads it back as a columnar table.

    This cuts the lineage, makes a costly result safe against the loss of
    executors, and lets several consumers read only the columns they need.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or checkpoint_root(spark)}/corpusloom-{uuid.uuid4().hex}"
        self._tables: dict[int, tuple[DataFrame, str]] = {}

    def save(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.partitionBy(*partition_by).parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self._tables[id(table)] = (table, path)
        return table

    def drop(self, table: DataFrame) -> None:
        """Delete a table written by ``save`` that nothing reads any more."""
        self._delete(self._tables.pop(id(table))[1])

    def close(self) -> None:
        """Delete every table of this scratch."""
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        jvm_path.getFileSystem(conf).delete(jvm_path, True)
