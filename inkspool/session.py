"""Sessions, table reading and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, memory: str = "8g", scratch: str | None = None) -> SparkSession:
    """A local session with the settings the library is tested under; scratch: the folder of intermediate tables."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("inkspool")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return (builder.config("spark.checkpoint.dir", scratch) if scratch else builder).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a folder of Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Intermediate tables in the shared folder named by spark.checkpoint.dir.

    ``cut`` writes a frame and reads it back, which ends its lineage in files
    that every executor can reach; a lost executor therefore costs no more than
    the tasks it was running. ``drop`` deletes what a later step has replaced,
    ``drop_all`` everything; what is left goes when the driver's JVM ends. Only a
    local session without the setting gets a temporary folder.
    """

    def __init__(self, spark: SparkSession, label: str):
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="inkspool-")
        self.spark, self.root, self.marked = spark, f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}", False

    def _files(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        if not self.marked:
            files, root = self._files(self.root)
            self.marked = files.deleteOnExit(root)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            files, path = self._files(f"{self.root}/{name}")
            files.delete(path, True)

    def drop_all(self) -> None:
        files, root = self._files(self.root)
        files.delete(root, True)
