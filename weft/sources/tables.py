"""Where the named tables are read from."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory, read by Spark so that any file system works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _leaves(kind: DataType, path: str, shape: tuple) -> Iterator[tuple[str, str, tuple]]:
    """(path, type, shape) of the leaves of a type; an array's length is not known without reading it."""
    if isinstance(kind, StructType):
        for field in kind.fields:
            yield from _leaves(field.dataType, f"{path}/{field.name}", shape)
    elif isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
        yield from _leaves(kind.elementType, path, (*shape, "*"))
    else:
        yield path, kind.simpleString(), (*shape, "*") if isinstance(kind, ArrayType | MapType) else shape


def listing(spark: SparkSession, roots: dict[str, DataFrame], prefixes: tuple[str, ...] = ("",)) -> DataFrame:
    """path, dtype and shape of the leaves of some sources, with nested groups, whose paths start with one of the prefixes.

    Only schemas and numbers of rows are read.
    """
    rows = []
    for root, df in roots.items():
        found = [x for x in _leaves(df.schema, root, ()) if x[0].startswith(prefixes)]
        n = df.count() if found else 0
        rows += [(path, dtype, f"({','.join(map(str, (n, *shape)))})") for path, dtype, shape in found]
    return spark.createDataFrame(rows, "path string, dtype string, shape string")
