"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a share of the total size. Its documents are taken in complete epochs first, all of
them as often as the target holds the source's whole size. What is left is filled with a weighted
sample without replacement: every document draws u in (0, 1) from a hash of the seed and its id and
gets the exponential key -ln(u) / weight; keys are sorted within the source, sizes are summed along
that order, and documents are taken as long as their midpoint lies within what is left, so the last
one is taken if that comes nearer to the target.

The sum along the order is not one window per source. Keys fall into ordered buckets, KEY_BUCKETS for each
factor of two; the buckets' sums (a grouped aggregation) find the one bucket of each source that holds the
threshold, and only that bucket's rows are sorted. Whatever the scale of the weights, the densest bucket has
some 0.03 % of the rows of a weight, so a source with a third of all rows is split thousands of ways.

Nulls, ties, repeats: a null source is a source (last in order); a null or negative size counts 0; a
null, zero or negative weight counts as 1. Rows of size 0 are taken as often as the epochs say, and once
more if their key comes before the end of a fractional selection that is not empty. Equal keys are ordered by id; rows with the same id share
one decision. A source of size 0 gets target 0. An empty table gives no rows. The key is a function of
seed and id, so reruns agree. Very long texts are counted by one pass of the JVM. Carried columns whose names clash with
the operator's keep their values in the scan and are returned once, as the operator's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm import bitmaps
from weft.workspace import Workspace

KEY_BUCKETS = 1024
BROADCAST_SOURCES = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def es_key(id_col: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight with u from the first 52 bits of md5(seed:id)."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.when(weight > 0, weight).otherwise(F.lit(1.0))


def _bucket(key: Column) -> Column:
    """Bucket number, never falling as the key grows (the JVM's logarithm does not fall either)."""
    return F.floor(F.lit(float(KEY_BUCKETS)) * F.log2(key)).cast("int")


def source_targets(sizes: DataFrame, shares: Sequence[int], max_epochs: int = 3) -> DataFrame:
    """Targets of sources (source, source_size): shares repeat along the sources in code-point order, null last.

    No target exceeds max_epochs times its source's size; what is above is shared again by weight until
    none is. In the order of cap / weight the capped sources come first, so one pass finds the level at
    which the rest meets the total. The windows run over one row per source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(ordered)
    weight = F.element_at(F.array(*[F.lit(s) for s in shares]), (F.pmod(rank - 1, F.lit(len(shares))) + 1).cast("int"))
    capped = sizes.withColumn("__w", weight.cast("long")).withColumn("__cap", F.col("source_size") * max_epochs)
    filling = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("__cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("__w").over(filling.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - before).cast("double") / weight_left.cast("double")
    leveled = capped.withColumn("__level", level)
    fits = F.col("__level") * F.col("__w") <= F.col("__cap")
    found = F.min(F.when(fits, F.struct(F.col("__cap") / F.col("__w"), F.col("source").isNull(), F.col("source"), F.col("__level")))).over(everything)
    chosen = leveled.withColumn("__found", found).withColumn("__at", F.col("__found").getField("__level"))
    target = F.coalesce(F.least(F.col("__cap").cast("double"), F.col("__at") * F.col("__w")), F.col("__cap").cast("double"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return (
        chosen.withColumn("target", target)
        .withColumn("epochs", epochs.cast("long"))
        .select("source", "source_size", "target", "epochs")
    )


def plan(keyed: DataFrame, workspace: Workspace, shares: Sequence[int], max_epochs: int = 3) -> DataFrame:
    """One row per source: source_size, target, epochs and the last (key, id) of the fractional selection.

    keyed has id, source, size and key.
    """
    sums = workspace.save(
        keyed.groupBy("source", _bucket(F.col("key")).alias("bucket")).agg(F.sum("size").alias("bucket_size")), "buckets"
    )
    sizes = sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    targets = workspace.save(source_targets(sizes, shares, max_epochs), "targets")
    left = F.col("target") - F.col("epochs") * F.col("source_size")
    along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = sums.withColumn("__upto", F.sum("bucket_size").over(along))
    edge = (
        running.join(targets, running["source"].eqNullSafe(targets["source"]))
        .select(running["source"].alias("source"), "bucket", "bucket_size", "__upto", left.alias("__left"))
        .where((F.col("__left") > 0) & (F.col("__upto") - F.col("bucket_size") <= F.col("__left")))
        .groupBy("source")
        .agg(F.max_by(F.struct("bucket", (F.col("__upto") - F.col("bucket_size")).alias("start"), "__left"), "bucket").alias("e"))
        .select("source", F.col("e.bucket").alias("bucket"), F.col("e.start").alias("start"), F.col("e.__left").alias("left"))
    )
    edge = workspace.save(edge, "edges")
    rows = keyed.withColumn("bucket", _bucket(F.col("key")))
    rows = rows.join(edge, rows["source"].eqNullSafe(edge["source"]) & (rows["bucket"] == edge["bucket"])).select(
        rows["source"].alias("source"), "id", "size", "key", "start", "left"
    )
    within = Window.partitionBy("source").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = rows.withColumn("__upto", F.col("start") + F.sum("size").over(within)).where(
        2 * F.col("__upto") - F.col("size") <= 2 * F.col("left")
    )
    last = taken.groupBy("source").agg(F.max(F.struct("key", "id")).alias("last"))
    # Without a row of its own in the edge bucket, the selection ends with the bucket before.
    ends = edge.join(last, edge["source"].eqNullSafe(last["source"]), "left").select(
        edge["source"].alias("source"), "bucket", "last"
    )
    return targets.join(ends, targets["source"].eqNullSafe(ends["source"]), "left").select(
        targets["source"].alias("source"), "source_size", "target", "epochs",
        F.col("bucket").alias("edge_bucket"), F.col("last.key").alias("last_key"), F.col("last.id").alias("last_id"),
    )


def _copies() -> Column:
    """How often a row is taken: the epochs, and once more if its key is not behind its source's last."""
    key, bucket = F.col("key"), _bucket(F.col("key"))
    within = (key < F.col("last_key")) | ((key == F.col("last_key")) & (F.col("id").isNull() | (F.col("id") <= F.col("last_id"))))
    chosen = (bucket < F.col("edge_bucket")) | ((bucket == F.col("edge_bucket")) & within)
    return F.col("epochs") + F.coalesce(chosen, F.lit(False)).cast("long")


def _planned(slim: DataFrame, workspace: Workspace, shares: Sequence[int], max_epochs: int) -> DataFrame:
    sources = workspace.save(plan(slim, workspace, shares, max_epochs), "plan").withColumnRenamed("source", "__source")
    return F.broadcast(sources) if sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else sources


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    return rows.join(sources, rows["source"].eqNullSafe(F.col("__source")))


def mix(
    docs: DataFrame,
    workspace: Workspace,
    *,
    size: Column,
    weight: Column | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    shares: Sequence[int] = (5, 2, 1),
    max_epochs: int = 3,
    seed: int = 17,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows of docs (id, source and carried columns) with size, source_size, target, epochs and copies.

    Only ids, sources, sizes and keys are written and sorted; carried columns come from the last scan.
    The sources' plan is broadcast while it has BROADCAST_SOURCES rows at most, else it is joined by shuffle.
    """
    weight = F.lit(1.0) if weight is None else F.coalesce(weight, F.lit(1.0))
    plain = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("size"),
        es_key(F.col(id_col), weight, seed).alias("key"),
        *[F.col(c).alias(f"__c_{c}") for c in carry],
    )
    slim = workspace.save(plain.select("id", "source", "size", "key"), "keyed")
    sources = _planned(slim, workspace, shares, max_epochs)
    rows = plain if carry else slim
    joined = _with_source(rows, sources)
    return joined.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        *[F.col(f"__c_{c}").alias(c) for c in carry if c not in (id_col, source_col)],
        "size", "source_size", "target", "epochs",
        _copies().alias("copies"),
    )


def weighed_copies(
    docs: DataFrame,
    weights: DataFrame,
    workspace: Workspace,
    *,
    size: Column,
    row: str,
    id_col: str = "doc_id",
    source_col: str = "source",
    shares: Sequence[int] = (5, 2, 1),
    max_epochs: int = 3,
    seed: int = 17,
) -> DataFrame:
    """Column row of docs and its copies, as mix decides them with weights (id, weight; one row for an id, none is 1).

    Weights are joined to ids, sources and sizes only. Most ids are decided alike with and without their weight; the
    last scan decides these where the text is, and only rows of the other ids move to be joined with their weight.
    """
    named = weights.toDF("__of", "weight")
    sizes = workspace.save(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"),
            F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("size"),
        ),
        "sizes",
    )

    def key(weight: Column) -> Column:
        return es_key(F.col("id"), F.coalesce(weight, F.lit(1.0)), seed)

    weighed = sizes.join(named, sizes["id"] == named["__of"], "left").drop("__of")
    slim = workspace.save(weighed.withColumn("key", key(F.col("weight"))), "keyed")
    sources = _planned(slim.drop("weight"), workspace, shares, max_epochs)
    decided = _with_source(slim.where("weight IS NOT NULL"), sources).withColumn("__with", _copies())
    decided = decided.withColumn("key", key(F.lit(1.0))).where(F.col("__with") != _copies())
    changed = workspace.save(decided.select(F.col("id").alias("__of"), "weight").distinct(), "changed")
    bitmap = bitmaps.of_keys(changed.select("__of"), workspace, "changed-bits")
    plain = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(row).alias("__row"))
    flagged = bitmaps.flag(plain, bitmap.rows, bitmap.slot(F.col("id")), "__maybe")
    maybe = flagged.where("__maybe").drop("__maybe")
    maybe = maybe.join(changed, maybe["id"] == changed["__of"], "left").drop("__of")
    rows = flagged.where("NOT __maybe").drop("__maybe").withColumn("weight", F.lit(None).cast("double")).unionByName(maybe)
    return _with_source(rows.withColumn("key", key(F.col("weight"))), sources).select(F.col("__row").alias(row), _copies().alias("copies"))
