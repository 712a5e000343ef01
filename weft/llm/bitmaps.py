"""Bitmaps of hashed keys that let a scan skip rows before they are shuffled.

A bitmap has 2**bits bits, about eight for each key, between the two of BITS: 1 MB at least and 32 MB at most, in rows
of 4 KB, so it may be broadcast whatever the number of keys. Keys may share a bit; a bit that is set only says that a
row may match, so the rows that pass are joined exactly afterwards. Beyond some hundred million keys the largest bitmap
fills up, and more and more rows pass: what uses it then does the work of a plain join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.workspace import Workspace

BITS = (23, 28)


@dataclass
class Bitmap:
    """Rows (bucket, bits) of a bitmap, and the binary logarithm of its size."""

    rows: DataFrame
    bits: int

    def slot(self, *key: Column) -> Column:
        return _slot(self.bits, *key)


def _slot(bits: int, *key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(1 << bits))


def of_slots(slots: DataFrame, column: str) -> DataFrame:
    """Rows (bucket, bits) of the slots in a column."""
    return slots.groupBy(F.bitmap_bucket_number(column).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("__bits")
    )


def of_keys(keys: DataFrame, workspace: Workspace, name: str) -> Bitmap:
    """Bitmap of the rows of a written table, all of whose columns make the key."""
    bits = min(BITS[1], max(BITS[0], (8 * keys.count()).bit_length()))
    slots = keys.select(_slot(bits, *[F.col(c) for c in keys.columns]).alias("__slot"))
    return Bitmap(workspace.save(of_slots(slots, "__slot"), name), bits)


def flag(df: DataFrame, rows: DataFrame, at: Column, name: str) -> DataFrame:
    """df with a boolean column: whether the bit at slot `at` is set."""
    joined = df.withColumn("__slot", at).join(
        F.broadcast(rows), F.bitmap_bucket_number("__slot") == F.col("__bucket"), "left"
    )
    position = F.bitmap_bit_position("__slot")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    bit = F.pmod(F.floor(byte.cast("int") / F.pow(F.lit(2.0), F.pmod(position, F.lit(8)))), F.lit(2))
    return joined.withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop("__slot", "__bucket", "__bits")


def without(df: DataFrame, gone: DataFrame, workspace: Workspace, name: str, keys: dict[str, Column]) -> DataFrame:
    """Rows of df whose key is not in a written table `gone`; keys has the expression over df for each of its columns.

    Nulls in keys are equal. Only rows whose bit is set are shuffled.
    """
    columns = df.columns
    bitmap = of_keys(gone, workspace, name)
    flagged = flag(df, bitmap.rows, bitmap.slot(*[keys[c] for c in gone.columns]), "__maybe")
    sure = flagged.where("NOT __maybe").select(*columns)
    rest = flagged.where("__maybe").select(*columns, *[keys[c].alias(f"__key_{c}") for c in gone.columns])
    other = gone.select(*[F.col(c).alias(f"__gone_{c}") for c in gone.columns])
    same = F.lit(True)
    for c in gone.columns:
        same = same & F.col(f"__key_{c}").eqNullSafe(F.col(f"__gone_{c}"))
    return sure.unionByName(rest.join(other, same, "left_anti").select(*columns))
