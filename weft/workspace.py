"""Written intermediate results: they cut lineage and survive the loss of an executor."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: On a local or mounted folder Hadoop keeps a checksum file beside each file and starts a chmod process for every file and
#: folder it makes, from the executor's JVM; Parquet's pages have checksums of their own. Other file systems ignore this.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a private one where it names none and all runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        master = spark.sparkContext.master
        if not master.split("[")[0] == "local":
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        named = "file://" + tempfile.mkdtemp(prefix="weft-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone
        remove(spark, path)


class Workspace:
    """Tables of one run, under a folder of its own in the shared directory; it goes when the driver ends.

    Frames that a run returns read from it, so it cannot go before.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/weft-{label}-{uuid.uuid4().hex[:12]}"
        atexit.register(_remove_at_exit, spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, **options: str | int) -> DataFrame:
        """Write df as Parquet and read it back: the plan of what follows starts at the files. `options` are the writer's."""
        schema = df.schema
        df.write.mode("overwrite").options(**PLAIN_FILES, **options).option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Remove a table that nothing reads any more."""
        remove(self.spark, self.path(name))
