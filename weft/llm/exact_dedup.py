"""Exact de-duplication by progressive refinement, in DataFrame operations only.

Texts are compared after lower-casing A-Z. Groups are refined in steps, each of which sees only
what the one before left in groups of two or more:

1. length in bytes and a hash of the first characters, counted by a grouped aggregation that
   combines on the map side (a group that holds a third of all rows is one small record per task);
2. the SHA-256 of the whole text, only for rows whose (length, prefix) group survived. Which groups
   survived is sent to the scan as a bitmap (bitmaps.py), so neither texts nor a list of groups moves. Bits may
   collide: then a few more texts are hashed, none is missed.

Length and prefix share one scan because both come from the same column; a scan of its own for the
length would read every text once more.

Nulls, ties, repeats: a null text is an empty text. A null id never stays if its group has an id.
Rows that repeat an id and a text are one document and share its decision. An empty table gives no rows.
Columns the operator adds replace input columns of the same name; all others pass through. Very long texts are hashed
as a stream by SHA-256 and held once.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm import bitmaps
from weft.workspace import Workspace

PREFIX_CHARS = 64
ADDED = ("keep_id", "group_size", "kept")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def normalised(text: Column) -> Column:
    return lower_ascii(F.coalesce(text, F.lit("")))


def _group(text: Column) -> list[Column]:
    """Length in bytes and hash of the first characters of a text."""
    text = F.coalesce(text, F.lit(""))
    return [F.octet_length(text).alias("__len"), F.xxhash64(lower_ascii(F.substring(text, 1, PREFIX_CHARS))).alias("__prefix")]


def keyed_rows(docs: DataFrame, workspace: Workspace, id_col: str, text_col: str, carry: Sequence[str] = ()) -> tuple[DataFrame, bitmaps.Bitmap]:
    """Written rows (__id, carried columns, __survives, __key), with the full hash of texts that may have an equal one, and
    the bitmap of the (length, prefix) groups by which a scan tells those."""
    groups = docs.groupBy(*_group(F.col(text_col))).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    bitmap = bitmaps.of_keys(workspace.save(groups.select("__len", "__prefix"), "surviving"), workspace, "surviving-bits")
    tagged = bitmaps.flag(docs, bitmap.rows, bitmap.slot(*_group(F.col(text_col))), "__survives")
    key = F.when(F.col("__survives"), F.sha2(normalised(F.col(text_col)), 256))
    keyed = workspace.save(tagged.select(F.col(id_col).alias("__id"), *[F.col(c).alias(f"__c_{c}") for c in carry], "__survives", key.alias("__key")), "keyed")
    return keyed, bitmap


def decide(
    docs: DataFrame, workspace: Workspace, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per input row: the id, carried columns, keep_id, group_size and kept. Texts do not move."""
    carry = [c for c in carry if c not in (id_col, *ADDED)]
    keyed, _ = keyed_rows(docs, workspace, id_col, text_col, carry)
    groups = workspace.save(
        keyed.where("__survives")
        .groupBy("__key")
        .agg(F.max("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .withColumnRenamed("__key", "__of"),
        "groups",
    )
    # Both sides start at files, so adaptive execution can split a hot group on its side of the join.
    keyed = keyed.withColumn("__key", F.coalesce("__key", F.concat(F.lit("row "), F.coalesce(F.col("__id").cast("string"), F.uuid()))))
    return keyed.join(groups, F.col("__key") == F.col("__of"), "left").select(
        F.col("__id").alias(id_col),
        *[F.col(f"__c_{c}").alias(c) for c in carry],
        F.coalesce("keep_id", "__id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep_id") == F.col("__id"), F.col("keep_id").isNull()).alias("kept"),
    )


def exact_dedup(
    docs: DataFrame, workspace: Workspace, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of docs that stay: of equal texts, the row with the largest id.

    Ids and hashes decide which rows go; a bitmap of those tells the last scan which texts to compare exactly, so texts
    that stay do not move, but for a few that share a bit.
    """
    keyed, surviving = keyed_rows(docs, workspace, id_col, text_col)
    some = keyed.where("__survives")
    winners = workspace.save(some.groupBy("__key").agg(F.max("__id").alias("__keep"), F.count(F.lit(1)).alias("__n")).where("__n > 1").withColumnRenamed("__key", "__of"), "winners")
    gone = some.join(winners, F.col("__key") == F.col("__of")).where(~F.col("__keep").eqNullSafe(F.col("__id"))).select("__id", "__key").distinct()
    gone = workspace.save(gone, "gone")
    # The full hash is taken again only where the (length, prefix) group survived.
    tagged = bitmaps.flag(docs, surviving.rows, surviving.slot(*_group(F.col(text_col))), "__survives")
    key = F.when(F.col("__survives"), F.sha2(normalised(F.col(text_col)), 256))
    return bitmaps.without(tagged, gone, workspace, "gone-bits", {"__id": F.col(id_col), "__key": key}).select(*docs.columns)
