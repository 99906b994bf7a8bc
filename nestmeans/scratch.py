"""Where intermediate tables go: the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one gets its own."""
    sc = spark.sparkContext
    root = spark.conf.get(_SETTING, None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="nestmeans-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Stored:
    """An intermediate table and the folder that holds it."""

    frame: DataFrame
    path: str

    def drop(self) -> None:
        """Delete the files; nothing that still reads ``frame`` may run after that."""
        spark = self.frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def store(df: DataFrame, name: str) -> Stored:
    """Write ``df`` once as Parquet; the caller drops it after its last reader."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return Stored(df.sparkSession.read.schema(df.schema).parquet(path), path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and continue from the files."""
    return store(df, name).frame


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later plans start at stored data with stable partitions."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def settle(df: DataFrame, max_rows: int) -> DataFrame:
    """Compute ``df`` now: as local data when it has at most ``max_rows``, else checkpointed."""
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows:
        return checkpoint(df)
    return df.sparkSession.createDataFrame(head, schema=df.schema)
