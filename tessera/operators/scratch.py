"""Written tables in the folder that the whole cluster shares: they cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where none is set a local master, as in tests, gets a folder of its own; on
    a cluster that is an error, since each executor would write to its own disk."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set; it must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tessera-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Scratch:
    """Tables of one run, under a folder of its own; ``drop`` removes those that no later step reads."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self._made = 0
        self._there: set[str] = set()
        atexit.register(self._clear)

    def keep(self, frame: DataFrame) -> DataFrame:
        """Write ``frame`` and read it back with the same schema."""
        self._made += 1
        path = f"{self.root}/{self._made}"
        self._there.add(path)
        frame.write.mode("overwrite").parquet(path)
        read = self.spark.read.schema(frame.schema).parquet(path)
        read._tessera_path = path
        return read

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for frame in frames:
            path = getattr(frame, "_tessera_path", None)
            self._there.discard(path)
            self._delete(path)

    def only(self, *frames: DataFrame) -> None:
        """Delete all tables but these, which the result reads."""
        left = {getattr(frame, "_tessera_path", None) for frame in frames}
        for path in sorted(self._there - left):
            self._there.discard(path)
            self._delete(path)

    def settle(self) -> None:
        """Have the driver notice what written tables have cut off, so that Spark deletes its shuffle files now."""
        gc.collect()
        self.spark._jvm.System.gc()

    def _delete(self, path: str | None) -> None:
        if path:
            jvm = self.spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def _clear(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # noqa: BLE001  the session, and with it the file system client, may have ended
            pass


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def is_empty(frame: DataFrame) -> bool:
    return not frame.limit(1).count()


def checksum(*cols: str):
    return F.bit_xor(F.xxhash64(*cols))
