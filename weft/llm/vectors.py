"""Integer vectors of an embedding column, as the vector operators read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.workspace import Workspace


def scaled(vector: Column, scale: int, most: int) -> Column:
    """floor(scale * entry) of each entry as an int, held within +-most."""
    return F.transform(vector, lambda c: F.least(F.greatest(F.floor(c.cast("double") * scale), F.lit(-most)), F.lit(most)).cast("int"))


def finite(vector: Column) -> Column:
    """A vector that is not null and holds neither nulls nor entries that are not finite."""
    infinite = F.lit(float("inf"))
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < infinite))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def integer_vectors(rows: DataFrame, work: Workspace, name: str, vector: Column, scale: int, most: int, **carried: Column) -> tuple[DataFrame, int]:
    """The rows with a finite vector, written as the carried columns and x, and the vectors' length.

    That is the commonest length (of equally common ones the largest); rows of another length are left out, too. 0 without rows.
    """
    kept = rows.filter(finite(vector)).select(*[c.alias(k) for k, c in carried.items()], scaled(vector, scale, most).alias("x"))
    kept = work.save(kept, name)
    length = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return (kept.filter(F.size("x") == length["d"]), length["d"]) if length else (kept, 0)


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """A list column of rows of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)
