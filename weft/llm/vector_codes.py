"""Vector code compression: a product quantiser whose Lloyd rounds move only what has changed.

A vector is cut into PARTS equal parts; each part is coded by the index of the nearest of ENTRIES entries of its part's codebook.
The codebooks start as the parts of the vectors with the smallest ids. A round assigns every part to its nearest entry (squared
Euclidean distance, ties to the lower index) and replaces each entry by its parts' componentwise floor(sum / count); an entry
without parts stays.

The assignment of the round before is kept beside each vector in a written table, and the sums and counts of each entry are running
integers. A round reads the table, writes the new codes, and then sums, over the rows whose code has changed, plus the part to
the entry that it joined and minus the part to the entry that it left: one row for each touched number of a task, summed before
and behind the shuffle. Vectors never move. Only the codebooks and their sums, ENTRIES * length integers whatever the number of rows,
come to the driver and go to the tasks. A lost executor costs the round that it worked on, as each starts at a written table.

Vectors that are null or hold null, NaN or infinite components are dropped, and so are those of another length than the commonest (of
equally common ones the largest). Integers are held within +-MOST, so that all sums of squares are exact. A length that PARTS does not
divide is filled up with zeros. Null ids come last in the order of ids, equal ids are ordered by their vectors; fewer than ENTRIES
rows make fewer entries. Rows are coded one by one, so repeated rows agree. Null labels are a label of their own. An empty table gives
no rows. Texts are not read, so long ones do not matter; other columns are not read either, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.arrow import map_arrow
from weft.llm.vectors import integer_vectors, matrix
from weft.workspace import Workspace

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
MOST = 1 << 26
#: Rows of labels that are broadcast; with more, label sums are joined by shuffle.
BROADCAST_LABELS = 100_000
#: Rows whose distances to all entries are in memory at once.
BLOCK = 2048


def parts_of(x: np.ndarray) -> np.ndarray:
    """Vectors (rows, length) as (rows, PARTS, width), filled up with zeros."""
    width = -(-x.shape[1] // PARTS)
    filled = np.zeros((len(x), PARTS * width), np.int64)
    filled[:, : x.shape[1]] = x
    return filled.reshape(len(x), PARTS, width)


def nearest(parts: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry, and the squared distances: exact integers, in doubles where those hold them."""
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(codebooks).max(initial=0)))
    kind = np.float64 if 4 * most * most * parts.shape[2] < 2**53 else np.int64
    codes = np.zeros((len(parts), PARTS), np.int64)
    error = np.zeros((len(parts), PARTS), np.int64)
    for p in range(PARTS):
        entries = codebooks[p].astype(kind)
        lengths = (entries * entries).sum(1)
        for at in range(0, len(parts), BLOCK):
            x = parts[at : at + BLOCK, p].astype(kind)
            d = lengths - 2 * (x @ entries.T)
            best = d.argmin(1)
            codes[at : at + BLOCK, p] = best
            error[at : at + BLOCK, p] = (x * x).sum(1) + d[np.arange(len(x)), best]
    return codes, error


def assign(rows: DataFrame, codebooks: np.ndarray, length: int) -> DataFrame:
    """rows (vec_id, label, x, code) with new codes; `was` is the code of the round before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, error = nearest(parts_of(matrix(batch.column("x"), length)), codebooks)
            own = pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary())
            yield pa.record_batch(
                [batch.column("vec_id"), batch.column("label"), batch.column("x"), own, batch.column("code"), pa.array(error.sum(1))],
                names=["vec_id", "label", "x", "code", "was", "error"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.transform(map_arrow, run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, x array<int>, code binary, was binary, error long")


def changes(assigned: DataFrame, length: int) -> DataFrame:
    """(part, entry, position, change) summed over the rows whose code has changed; the position behind the last one counts parts."""
    width = -(-length // PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, ENTRIES, width + 1), np.int64)
        for batch in batches:
            parts = parts_of(matrix(batch.column("x"), length))
            counted = np.concatenate([parts, np.ones((len(parts), PARTS, 1), np.int64)], axis=2)
            now = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, PARTS)
            before = batch.column("was").to_pylist()
            had = np.array([x is not None for x in before])
            was = np.frombuffer(b"".join(x or bytes(PARTS) for x in before), np.uint8).reshape(-1, PARTS)
            for p in range(PARTS):
                moved = ~had | (now[:, p] != was[:, p])
                np.add.at(total[p], now[moved, p], counted[moved, p])
                np.subtract.at(total[p], was[moved & had, p], counted[moved & had, p])
        part, entry, position = np.nonzero(total)
        yield pa.record_batch([pa.array(part), pa.array(entry), pa.array(position), pa.array(total[part, entry, position])], names=["part", "entry", "position", "change"])

    touched = assigned.filter(F.col("was").isNull() | (F.col("was") != F.col("code"))).select("x", "code", "was")
    own = touched.transform(map_arrow, run, "part long, entry long, position long, change long")
    return own.groupBy("part", "entry", "position").agg(F.sum("change").alias("change"))


def digest(codebooks: np.ndarray, length: int) -> str:
    """sha256 of all entries' components by part, entry and position, without those that only fill up."""
    width = codebooks.shape[2]
    used = [codebooks[p, :, : max(0, min(width, length - p * width))].reshape(-1) for p in range(PARTS)]
    return hashlib.sha256(",".join(str(v) for x in used for v in x.tolist()).encode()).hexdigest()


def learn(rows: DataFrame, work: Workspace, length: int) -> tuple[DataFrame, np.ndarray]:
    """The table of the last round's assignments, and the final codebooks (PARTS, entries, width)."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(ENTRIES).collect()
    codebooks = parts_of(np.array([r["x"] for r in first], np.int64).reshape(len(first), length)).transpose(1, 0, 2).copy()
    sums = np.zeros((PARTS, ENTRIES, codebooks.shape[2] + 1), np.int64)
    before = rows.withColumn("code", F.lit(None).cast("binary"))
    for n in range(1, ROUNDS + 1):
        table = work.save(assign(before, codebooks, length).drop("error"), f"round-{n}")
        for part, entry, position, change in changes(table, length).collect():
            sums[part, entry, position] += change
        own = sums[:, : codebooks.shape[1]]
        used = own[:, :, -1] > 0
        codebooks[used] = own[used][:, :-1] // own[used][:, -1:]
        work.drop(f"round-{n - 1}" if n > 1 else "vectors")
        before = table.drop("was")
    return before, codebooks


def encode(rows: DataFrame, work: Workspace, *, vec_id: Column, label: Column, vector: Column) -> DataFrame:
    """vec_id, label, code (hex), error, label_error and codebooks_sha256 of every vector that is kept."""
    kept, length = integer_vectors(rows, work, "vectors", vector, SCALE, MOST, vec_id=vec_id, label=label)
    kinds = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, label {kept.schema['label'].dataType.simpleString()}"
    if not length:
        return rows.sparkSession.createDataFrame([], f"{kinds}, code string, error long, label_error long, codebooks_sha256 string")
    last, codebooks = learn(kept, work, length)
    coded = work.save(assign(last, codebooks, length).select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error"), "coded")
    work.drop(f"round-{ROUNDS}")
    sums = work.save(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-sums")
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
    return joined.withColumn("codebooks_sha256", F.lit(digest(codebooks, length)))
