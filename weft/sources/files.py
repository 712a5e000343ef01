"""Files as tables: discovery, documents in several layouts, key-value stores, and writers with rules of their own.

Everything goes through Spark's readers and writers, so any file system that Spark knows works.
"""

from __future__ import annotations

import contextlib
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def discover(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path, length and modification time of all files below root whose names match the pattern; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return found.select("path", "length", "modificationTime")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def folder(spark: SparkSession, root: str) -> tuple:
    """The file system of a folder, and a function from a name in it to its path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), lambda name: path(f"{root}/{name}")


def documents(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Documents of a benchmark: the single list file if there is one, else the older layout of a file per episode."""
    single = f"{root}/benchmark.json"
    path = single if exists(spark, single) else f"{root}/house_*/episode_*.json"
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def json_lines(spark: SparkSession, path: str, schema: str, most: int | None = None) -> DataFrame:
    """Lines of JSON, gzipped or not; the first `most` rows if that is asked for."""
    found = spark.read.schema(schema).json(path)
    return found if most is None else found.limit(most)


def first_of_each(rows: DataFrame, group: str, order: str, most: int) -> DataFrame:
    """The first rows of each group; `most` is a small cap. Slices of a group are cut first, so no task sorts a whole one."""
    sliced = rows.withColumn("__slice", F.pmod(F.xxhash64(order), F.lit(64)))
    some = sliced.withColumn("__n", F.row_number().over(Window.partitionBy(group, "__slice").orderBy(order))).where(F.col("__n") <= most)
    return some.withColumn("__n", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("__n") <= most).drop("__n", "__slice")


def manifests(spark: SparkSession, *paths: str) -> DataFrame:
    """Parts of a Parquet manifest as one table; columns that a part lacks are null."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a list file without comments (#) and blanks."""
    kept = spark.read.text(path).select(F.trim(F.split_part("value", F.lit("#"), F.lit(1))).alias("line"))
    return kept.where("line <> ''")


def longest_prefix(keys: DataFrame, key: str, known: DataFrame, name: str) -> DataFrame:
    """Each key with the longest known name that is the key itself or its start up to an underscore; null without one."""
    parts = F.split(key, "_")
    candidates = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "_")))
    found = keys.select(key, candidates.alias("__c")).join(known.select(F.col(name).alias("__n")), F.col("__c") == F.col("__n"))
    best = found.groupBy(key).agg(F.max_by("__n", F.length("__n")).alias(name))
    return keys.join(best, key, "left")


class KeyValues:
    """A table of unique keys with a codec for its values, and a marker that says it was written whole.

    A codec is a pair of functions from a column to a column; values are stored encoded. get and contains push their
    keys into the scan of sorted files.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "key", value: str = "value", codec: tuple | None = None):
        self.spark, self.path, self.key, self.value = spark, path, key, value
        self.encode, self.decode = codec or (lambda c: c, lambda c: c)

    def put(self, rows: DataFrame) -> None:
        if self.value in rows.columns:
            rows = rows.withColumn(self.value, self.encode(F.col(self.value)))
        rows.repartition(F.col(self.key)).sortWithinPartitions(self.key).write.mode("overwrite").parquet(self.path)

    @property
    def complete(self) -> bool:
        return exists(self.spark, f"{self.path}/_SUCCESS")

    def stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def items(self) -> DataFrame:
        rows = self.stored()
        return rows.withColumn(self.value, self.decode(F.col(self.value))) if self.value in rows.columns else rows

    def get(self, *keys) -> DataFrame:
        """Rows of some keys."""
        return self.items().where(F.col(self.key).isin(*keys))

    def keys(self) -> DataFrame:
        return self.stored().select(self.key)

    def values(self) -> DataFrame:
        return self.items().select(self.value)

    def iterator(self, f, schema: str) -> DataFrame:
        """f over pandas frames of key and value, one after the other, as in mapInPandas."""
        return self.items().mapInPandas(f, schema)

    def __contains__(self, key) -> bool:
        return bool(self.stored().where(F.col(self.key) == key).limit(1).count())

    def __len__(self) -> int:
        return self.stored().count()


def json_codec(schema: str) -> tuple:
    """Values kept as JSON text."""
    return F.to_json, lambda c: F.from_json(c, schema)


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """One folder per combination of the columns."""
    df.repartition(*by).write.mode("overwrite").partitionBy(*by).parquet(path)


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that df has, and no other."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def bucketed(df: DataFrame, path: str, key: str, buckets: int = 32) -> DataFrame:
    """df, written once in sorted buckets of a key; tables with the same buckets join on their keys without a shuffle.

    Rows are dealt by bucket before, so each bucket is one file. The table is known to the session's catalog under a name of its own.
    """
    name = f"weft_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def write_staged(df: DataFrame, path: str) -> None:
    """Write beside the target, move the old table aside, rename, then drop the old one.

    A failure of the write leaves the target as it was; one between the renames leaves the old table as `path`.old,
    which the next call puts back before it begins.
    """
    spark = df.sparkSession
    jvm = spark._jvm
    staged, target, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.staged", path, f"{path}.old"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(old) and not fs.exists(target):
        fs.rename(old, target)
    df.write.mode("overwrite").parquet(f"{path}.staged")
    fs.delete(old, True)
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(staged, target):
        fs.rename(old, target)
        raise OSError(f"could not rename {path}.staged")
    fs.delete(old, True)


MODES = {"all": ("data", "index", "totals"), "dry-run": (), "index-only": ("index",), "aggregate-only": ("totals",)}


def publish(df: DataFrame, path: str, mode: str, *index: str) -> DataFrame:
    """Write what a mode says of a table: its data, its index (rows by the index columns), its totals (rows).

    Returns the totals, which in a dry run are all that happens; nothing is counted before they are read.
    """
    counts = F.count(F.lit(1)).alias("rows")
    parts = {"data": df, "index": df.groupBy(*index).agg(counts), "totals": df.agg(counts)}
    for part in MODES[mode]:
        parts[part].write.mode("overwrite").parquet(f"{path}/{part}")
    return parts["totals"]


#: Quotes are around every value that is there, so that separators, line feeds and # in values are no syntax. A field without quotes is
#: read as this null value, one with nothing between its quotes as an empty text.
QUOTED = {"escape": '"', "nullValue": "\0", "emptyValue": ""}


def write_report(df: DataFrame, path: str, notes: list[str]) -> None:
    """A CSV with comment lines before its header; a report is small by nature and is written as one file.

    Line feeds in notes begin further comment lines.
    """
    spark = df.sparkSession
    names = ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)
    given = [(0, i, f"# {line}") for i, line in enumerate("\n".join(notes).splitlines())]
    header = spark.createDataFrame([*given, (1, 0, names)], "part int, place int, value string")
    fields = [F.coalesce(F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")) for c in df.columns]
    body = df.select(F.lit(2).alias("part"), F.lit(0).alias("place"), F.concat_ws(",", *fields).alias("value"))
    header.unionByName(body).coalesce(1).sortWithinPartitions("part", "place").select("value").write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**QUOTED).option("header", "true").option("comment", "#").option("multiLine", "true").csv(path)


def pending(wanted: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Work that is not done yet."""
    return wanted.join(done.select(*keys).distinct(), list(keys), "left_anti")


def write_once(df: DataFrame, path: str) -> bool:
    """Write a table unless it is there whole; returns whether it was written."""
    if exists(df.sparkSession, f"{path}/_SUCCESS"):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


class Locked:
    """Mutual exclusion through a file that only one can create, with its holder's token in it.

    A distributed file system creates a file once; Hadoop's local one looks before it creates, so there the system's call does it. A lock older
    than `stale` seconds counts as left behind: who finds it renames it to a name of its own token, which only one can, and so never
    takes a newer lock away; `renew` makes a lock young again for work that takes long. Only the holder's own lock is deleted.
    """

    def __init__(self, spark: SparkSession, path: str, patience: float = 60.0, stale: float = 3600.0):
        self.jvm, self.patience, self.stale = spark._jvm, patience, stale
        self.token = uuid.uuid4().hex
        self.lock = self.jvm.org.apache.hadoop.fs.Path(f"{path}.lock")
        self.fs = self.lock.getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(self.lock.getParent())

    def _create(self) -> None:
        if self.fs.getUri().getScheme() == "file":
            with os.fdopen(os.open(self.lock.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY), "w") as f:
                f.write(self.token)
        else:
            out = self.fs.create(self.lock, False)
            out.write(self.token.encode())
            out.close()

    def holder(self) -> str:
        """The token in the lock, empty while it is being written."""
        stream = self.fs.open(self.lock)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def _age(self) -> float:
        return time.time() - self.fs.getFileStatus(self.lock).getModificationTime() / 1000

    def __enter__(self) -> Locked:
        until = time.monotonic() + self.patience
        while True:
            try:
                self._create()
                return self
            except Exception as e:  # noqa: BLE001  file systems name it differently
                if time.monotonic() > until:
                    raise TimeoutError(f"{self.lock} is held") from e
                with contextlib.suppress(Exception):  # the holder may let go meanwhile
                    if self._age() > self.stale:
                        self._put_aside(self.holder())
            time.sleep(0.05)

    def _put_aside(self, found: str) -> None:
        """Move a stale lock away; one that has changed hands since it was read is put back."""
        aside = self.jvm.org.apache.hadoop.fs.Path(f"{self.lock}.{self.token}")
        if self.fs.rename(self.lock, aside):
            moved = self.fs.open(aside)
            try:
                same = bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(moved)).decode() == found
            finally:
                moved.close()
            if not same:
                self.fs.rename(aside, self.lock)
            self.fs.delete(aside, False)

    def renew(self) -> None:
        """Say that the holder still works; an error if the lock is not its own any more."""
        if self.holder() != self.token:
            raise RuntimeError(f"{self.lock} was taken over")
        self.fs.setTimes(self.lock, int(time.time() * 1000), -1)

    def __exit__(self, *_) -> None:
        with contextlib.suppress(Exception):  # nothing is there any more
            if self.holder() == self.token:
                self.fs.delete(self.lock, False)


def append_absent(rows: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key a table does not have yet, one writer at a time. Rows that repeat a key count once."""
    spark = rows.sparkSession
    with Locked(spark, path):
        if exists(spark, path):
            rows = rows.join(spark.read.parquet(path).select(F.col(key).alias("__k")), F.col(key) == F.col("__k"), "left_anti")
        rows.dropDuplicates([key]).write.mode("append").parquet(path)


def numbered_paths(spark: SparkSession, root: str, pattern: str, first: int, last: int, skip: str, variants: tuple[str, ...] = ("",)) -> DataFrame:
    """(i, variant, path) of numbers first .. last: the path of pattern % (i, variant) below root, null where no such file is.

    Files whose names match the regular expression `skip` are not seen.
    """
    wanted = spark.range(first, last + 1).select(F.col("id").alias("i"), F.explode(F.array(*map(F.lit, variants))).alias("variant"))
    wanted = wanted.withColumn("__name", F.format_string(pattern, "i", "variant"))
    there = discover(spark, root, "*").select("path", F.element_at(F.split("path", "/"), -1).alias("__file")).where(~F.col("__file").rlike(skip))
    return wanted.join(there, F.col("__name") == F.col("__file"), "left").select("i", "variant", "path")


def to_jdbc(df: DataFrame, url: str, name: str, mode: str = "overwrite", **options: str) -> None:
    """Write a table of a database; its driver must be on the class path."""
    df.write.format("jdbc").options(url=url, dbtable=name, **options).mode(mode).save()


def from_jdbc(spark: SparkSession, url: str, name: str, column: str | None = None, low: int = 0, high: int = 0, parts: int = 1, **options: str) -> DataFrame:
    """A table of a database, read in `parts` ranges of a column; filters and columns are pushed down."""
    if column:
        options |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()
