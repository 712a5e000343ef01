"""N-gram Jaccard self-join: every link between texts whose shingle sets overlap enough, as components.

A text's set holds the hashes (64 bits) of its distinct w-word shingles; a text of fewer words has its
whole word sequence as one shingle. Two texts link when threshold% of the union is shared. Equal sets
form one class and are represented by the smallest id, so copies are never paired with each other.

1. *Classes.* One pass gives each text its set size, a 128-bit hash of its set, min-hash band keys, a
   hashed bitmap signature (bit = parity of the elements hashed to it, so the popcount of an XOR bounds
   the symmetric difference from below and the overlap from above) and the partial counts of a frequency
   table over all shingles, whose size follows the input's.
2. *Near copies first.* Classes that share a band key are paired with one of them and checked, in rounds with
   another partner each, as long as a round joins a fair part of the rows in groups that still hold far more pairs of
   different components than rows. This is only a short cut: it makes large groups of near copies one component
   with a few checks per member, so the complete search below need not compare them with each other.
3. *Complete search.* Two sets that link share an element among the first n - ceil(t n) + 1 of each in any
   common order (prefix filter). The order puts rare shingles first, by the frequency table, so shared
   passages lie behind the prefix. Tiles hold the texts that share a prefix element. A tile of few rows is
   paired at once. Rows of longer tiles are counted by tile and size band (a ratio of t per band; linked texts
   are at most one band apart), tiles of one component are dropped, and the rest get their signatures and are
   dealt to cells of a band and its next, cut into blocks by the exact counts, so that no cell outgrows a task.
   Within a cell pairs of the same component are skipped, and size, position and bitmap bounds are taken in
   numpy, so only pairs that pass the bitmap become rows; at first only those that would connect the cell, in the
   end all that are left between different components. The exact intersection of the sorted sets decides.
4. *Components* of all links that were verified.

Nothing is sampled or capped: steps 1 and 2 choose order and short cuts, step 3 misses no link.

Very long texts: a text's words are hashed in windows (textops), its set is one array of 8 bytes per distinct
shingle and its signature has SIGNATURE_MAX bits at most; a longer set has a looser bound.

Nulls, ties, repeats: null and empty texts have an empty set and no links; their component is their own
id. Rows that repeat an id are one document: links of any of them reach all. Rows with a null id link as others do; their component
is null if no row of it has an id. Where ids are null or have several texts, rows are numbered first. An empty table gives no rows. Columns of docs that are not carried
are not returned; carried names that clash with the operator's are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.arrow import map_arrow
from weft.llm import bitmaps
from weft.llm.components import components
from weft.llm.sums import pack, summed, unpack
from weft.llm.textops import LOWER, U64, blocks, mix, word_hashes
from weft.workspace import Workspace

BANDS, ROWS = 5, 3
PAIRS_PER_ROW = 16
#: A round of near copies is followed by another if it finds a link for one in so many rows at least.
ROWS_PER_LINK = 12
#: The frequency table has about one cell for so many bytes of the input, between the two sizes (2**bits).
BYTES_PER_CELL, FREQUENCY_BITS = 256, (19, 24)
UNKNOWN_BYTES = 1 << 60
CHUNK_BITS = 14
SHORT_TILE = 16
POSTING_ROWS = 25_000  # of an Arrow batch, 1 MB
TILE_ROWS = 4096
SIGNATURE_MIN, SIGNATURE_MAX = 64, 1 << 16
_ODD = mix(np.arange(1, BANDS * ROWS + 1, dtype=U64)) | U64(1)
ADDED = ("n_shingles", "component_id")


def shingle_sets(data: np.ndarray, at: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block."""
    hashes, first = word_hashes(LOWER[data], at)
    rolled = np.full(max(0, len(hashes) - words + 1), 0x5851F42D4C957F2D, U64)
    for k in range(words):
        rolled = mix(rolled * U64(0x2545F4914F6CDD1D) + hashes[k : k + len(rolled)])
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            sets.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            h = np.full(1, int(b - a) + 1, U64)
            for x in hashes[a:b]:
                h = mix(h * U64(0x2545F4914F6CDD1D) + x)
            sets.append(h)
        else:
            sets.append(np.zeros(0, U64))
    return sets


def signature_bits(n: int) -> int:
    """Bits of the signature of a set of size n: a power of two of at least twice n, so that few differences cancel out."""
    return int(min(SIGNATURE_MAX, max(SIGNATURE_MIN, 1 << max(0, math.ceil(math.log2(max(2 * n, 1)))))))


def signature(items: np.ndarray) -> bytes:
    """Bit i is the parity of the number of elements whose hash ends in i."""
    bits = signature_bits(len(items))
    parity = np.bincount((items & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def overlap_bound(a: bytes, na: int, b: bytes, nb: int) -> int:
    """At most so many elements are shared: the XOR of two parity bitmaps counts into the symmetric difference."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) != len(y):  # fold the longer one: parities add up
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    differ = int(np.bitwise_count(np.bitwise_xor(x, y)).sum())
    return (na + nb - differ) // 2


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def frequency_bits(docs: DataFrame) -> int:
    """Size of the frequency table, as a power of two, from the planner's estimate of the input's bytes, or their sum where it has none."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= UNKNOWN_BYTES:
        size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return min(FREQUENCY_BITS[1], max(FREQUENCY_BITS[0], (size // BYTES_PER_CELL).bit_length()))


def _band_keys(items: np.ndarray) -> list[int]:
    """Min-hash keys of a set, one for each band."""
    least = [(items * k).min() for k in _ODD] if len(items) else []
    keys = []
    for j in range(0, len(least), ROWS):
        h = np.full(1, j + 1, U64)
        for x in least[j : j + ROWS]:
            h = mix(h * U64(0x2545F4914F6CDD1D) + x)
        keys.append(int(h[0].astype(np.int64)))
    return keys


def _classes(words: int, table_bits: int):
    """Arrow batches of (id, text) to class rows; each task ends with its partial frequency table, without empty chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << table_bits, np.int32)
        for batch in batches:
            n, low, high, bands, marks = [], [], [], [], []
            for _, _, data, at in blocks(batch.column(1)):
                sets = shingle_sets(data, at, words)
                if sets:
                    cell, times = np.unique(np.concatenate(sets) >> U64(64 - table_bits), return_counts=True)
                    counts[cell.astype(np.int64)] += times.astype(np.int32)
                for s in sets:
                    n.append(len(s))
                    low.append(int(s.sum(dtype=U64).astype(np.int64)))
                    high.append(int(np.bitwise_xor.reduce(mix(s)).astype(np.int64)) if len(s) else 0)
                    bands.append(_band_keys(s))
                    marks.append(signature(s))
            rows = len(n)
            yield pa.record_batch(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())],
                names=["id", "n", "low", "high", "bands", "mark", "chunk", "counts"],
            )
        parts = counts.reshape(-1, 1 << CHUNK_BITS)
        filled = np.flatnonzero(parts.any(axis=1))
        for some in np.split(filled, range(32, len(filled), 32)):
            k = len(some)
            yield pa.record_batch(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                 pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.binary()), pa.array(some, pa.int32()),
                 pa.array([pack(parts[i].astype(np.int64)) for i in some], pa.binary())],
                names=["id", "n", "low", "high", "bands", "mark", "chunk", "counts"],
            )

    return run


CLASS_SCHEMA = "id long, n int, low long, high long, bands array<long>, mark binary, chunk int, counts binary"


def frequencies(rows: DataFrame, table_bits: int) -> np.ndarray:
    """Level of each cell of the frequency table: 8 log2(1 + count), one byte.

    The count bounds the number of texts with a shingle of the cell from above. What reaches the driver is one byte per cell.
    """

    def levels(counts: np.ndarray) -> np.ndarray:
        return np.rint(8 * np.log2(1.0 + counts)).astype(np.uint8)

    parts = rows.where("chunk IS NOT NULL").select(F.col("chunk").alias("key"), F.col("counts").alias("values"))
    table = np.zeros((1 << (table_bits - CHUNK_BITS), 1 << CHUNK_BITS), np.uint8)
    for row in summed(parts, np.int64, levels).toLocalIterator():
        table[row["key"]] = unpack(row["values"], np.uint8)
    return table.reshape(-1)


def _cells(items: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Levels of elements in the frequency table."""
    return table[(items >> U64(64 - (len(table).bit_length() - 1))).astype(np.int64)]


def _postings(words: int, percent: int, shared):
    """Arrow batches of (id, text) to (id, n, prefix): the first elements in the order rare first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            n, prefixes = [], []
            for _, _, data, at in blocks(batch.column(1)):
                for s in shingle_sets(data, at, words):
                    n.append(len(s))
                    k = prefix_length(len(s), percent)
                    # Elements of one level keep the order of the hashes, in which s already is.
                    prefixes.append(s[np.argsort(_cells(s, table), kind="stable")[:k]].tobytes())
            yield pa.record_batch(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(prefixes, pa.binary())], names=["id", "n", "prefix"]
            )

    return run


def _tiles(shared):
    """Arrow batches of (id, comp, n, prefix) to postings (tile, deal, id, comp, at), at = n << 32 | position.

    deal is null, or a number that deals out the postings of an element that the frequency table calls frequent:
    they need not meet before they are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        often = 8 * math.log2(1 + TILE_ROWS + 8 * float(np.exp2(table / 8.0).mean()))
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            comps = batch.column(1).to_numpy(zero_copy_only=False)
            sizes = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            items = [np.frombuffer(x.as_buffer(), U64) for x in batch.column(3)]
            length = np.array([len(x) for x in items], np.int64)
            lo = 0
            while lo < len(ids):
                hi = max(lo + 1, int(np.searchsorted(np.cumsum(length[lo : lo + POSTING_ROWS]), POSTING_ROWS, "right")) + lo)
                own = length[lo:hi]
                tile = np.concatenate(items[lo:hi])
                place = np.arange(len(tile)) - np.repeat(np.cumsum(own) - own, own)
                deal = mix(np.repeat(ids[lo:hi].astype(U64), own) + U64(1)).astype(np.int64)
                yield pa.record_batch(
                    [pa.array(tile.astype(np.int64)), pa.array(deal, mask=_cells(tile, table) <= often), pa.array(np.repeat(ids[lo:hi], own)),
                     pa.array(np.repeat(comps[lo:hi], own)), pa.array((np.repeat(sizes[lo:hi], own) << np.int64(32)) | place)],
                    names=["tile", "deal", "id", "comp", "at"],
                )
                lo = hi

    return run


def _possible(percent: int, n: np.ndarray, pos: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows (i, j) may link by their sizes and by what follows the shared element in their order."""
    need = -(-percent * (n[i] + n[j]) // (100 + percent))
    most = np.minimum(n[i] - pos[i], n[j] - pos[j])
    return (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (most >= need)


def _pairs(percent: int):
    """Postings sorted by deal and tile to rows (tile, a, b, at): pairs (a, b) of different components of short tiles that pass
    the bounds, with a null tile, and the postings of other tiles, with a the id and b the component."""

    def pairs(rows):
        """Pairs within runs of equal tile, of SHORT_TILE rows at most."""
        tile, ids, comps, at = rows
        n, pos = at >> 32, at & 0xFFFFFFFF
        edges = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1], [True])))
        length = np.diff(edges)
        found = [[], []]
        for d in range(1, SHORT_TILE):
            run = length > d
            if not run.any():
                break
            count = length[run] - d
            i = np.repeat(edges[:-1][run], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            j = i + d
            ok = (comps[i] != comps[j]) & (ids[i] != ids[j]) & _possible(percent, n, pos, i, j)
            found[0].append(np.minimum(ids[i[ok]], ids[j[ok]]))
            found[1].append(np.maximum(ids[i[ok]], ids[j[ok]]))
        if found[0]:
            a, b = np.concatenate(found[0]), np.concatenate(found[1])
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            if len(a):
                k = int(new.sum())
                yield pa.record_batch([pa.nulls(k, pa.int64()), pa.array(a[new]), pa.array(b[new]), pa.nulls(k, pa.int64())], names=["tile", "a", "b", "at"])

    def split(rows, long: bool):
        """Rows of whole tiles; the first of them may be the rest of a long one."""
        if long or not len(rows[0]):
            return rows, np.full(len(rows[0]), long)
        tile = rows[0]
        edges = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1], [True])))
        return rows, np.repeat(np.diff(edges) > SHORT_TILE, np.diff(edges))

    def emit(rows, long: np.ndarray):
        if long.any():
            yield pa.record_batch([pa.array(x[long]) for x in rows], names=["tile", "a", "b", "at"])
        yield from pairs([x[~long] for x in rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, going = None, None  # rows of the last tile, which may go on; the tile that is known to be long
        for batch in batches:
            dealt = np.asarray(batch.column(1).is_valid())
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2, 3, 4)]
            if dealt.any():
                yield pa.record_batch([pa.array(x[dealt]) for x in columns], names=["tile", "a", "b", "at"])
                columns = [x[~dealt] for x in columns]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
            rest = None
            if not len(columns[0]):
                continue
            if going is not None:
                more = columns[0] == going
                yield from emit([x[more] for x in columns], np.ones(int(more.sum()), bool))
                columns = [x[~more] for x in columns]
                if not len(columns[0]):
                    continue
            cut = int(np.searchsorted(columns[0], columns[0][-1], "left"))
            last = [x[cut:] for x in columns]
            yield from emit(*split([x[:cut] for x in columns], False))
            going = None
            if len(last[0]) > SHORT_TILE:  # a long tile is passed on as it comes and never held
                going = last[0][0]
                yield from emit(last, np.ones(len(last[0]), bool))
            else:
                rest = last
        if rest is not None:
            yield from emit(*split(rest, False))

    return run


POSTING_SCHEMA = "tile long, deal long, id long, comp long, at long"
PAIR_SCHEMA = "tile long, a long, b long, at long"


def _band(n: Column, percent: int) -> Column:
    """Size band; a step is a little more than the ratio of linked sizes, so rounding never puts those two bands apart."""
    return F.floor(F.log(n.cast("double")) / F.lit(-math.log(percent / 100) * (1 + 1e-9))).cast("int")


def _dense(percent: int, forest: bool):
    """Rows (cell, own, id, comp, at, mark) sorted by cell to pairs (a, b) that pass the bounds of size, position and bitmap.

    own says that a row is of the cell's band; the smaller row of a pair must be, so a pair meets in one cell of a tile.
    With forest, a cell gives only pairs that connect all that its pairs connect, fewer than it has rows: of the rows
    that one row may link with, the one of the best bound in each component.
    """

    def cell(rows, marks):
        own, ids, comps, at = rows
        n, pos = at >> 32, at & 0xFFFFFFFF
        order = np.lexsort((ids, n))
        own, ids, comps, n, pos = own[order], ids[order], comps[order], n[order], pos[order]
        size = np.array([len(marks[i]) for i in order])
        out, held = [[], []], 0
        upto = np.searchsorted(n, n * 100 // percent, "right")
        root = np.unique(comps, return_inverse=True)[1]
        for width in np.unique(size):
            # Sizes and so widths rise along the rows; a partner's signature is at most twice as long and is folded.
            lo, hi, last = np.searchsorted(size, [width, width + 1, 2 * width + 1])
            bits = np.frombuffer(b"".join(marks[i] for i in order[lo:hi]), np.uint64).reshape(hi - lo, -1)
            if last > hi:
                wide = np.frombuffer(b"".join(marks[i] for i in order[hi:last]), np.uint64).reshape(last - hi, 2, -1)
                bits = np.concatenate([bits, wide[:, 0] ^ wide[:, 1]])
            for k in np.flatnonzero(own[lo:hi]) + lo:
                end = min(upto[k], last)
                j = np.flatnonzero(root[k + 1 : end] != root[k]) + k + 1
                if len(j):
                    j = j[_possible(percent, n, pos, np.full(len(j), k), j)]
                if len(j):
                    differ = np.bitwise_count(bits[j - lo] ^ bits[k - lo]).sum(axis=1, dtype=np.int64)
                    ok = (n[k] + n[j] - differ) // 2 >= -(-percent * (n[k] + n[j]) // (100 + percent))
                    j, differ = j[ok], differ[ok]
                    if forest and len(j):
                        j = j[np.argsort(differ / (n[k] + n[j]), kind="stable")]
                        met, best = np.unique(root[j], return_index=True)
                        j = j[best]
                        root[np.isin(root, met)] = root[k]
                    out[0].append(np.minimum(ids[j], ids[k]))
                    out[1].append(np.maximum(ids[j], ids[k]))
                    held += len(j)
                if held >= 50_000:
                    yield pa.record_batch([pa.array(np.concatenate(x)) for x in out], names=["a", "b"])
                    out, held = [[], []], 0
        if out[0]:
            yield pa.record_batch([pa.array(np.concatenate(x)) for x in out], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rest, marks = np.zeros(0, np.int64), [np.zeros(0, t) for t in (bool, np.int64, np.int64, np.int64)], []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:5]]
            keys = np.concatenate([keys, columns[0]])
            rest = [np.concatenate(x) for x in zip(rest, columns[1:], strict=True)]
            marks += batch.column(5).to_pylist()
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                yield from cell([x[lo:hi] for x in rest], marks[lo:hi])
            keys, rest, marks = keys[edges[-1] :], [x[edges[-1] :] for x in rest], marks[edges[-1] :]
        if len(keys):
            yield from cell(rest, marks)

    return run


def _dealt(found: DataFrame, marks: DataFrame, percent: int, workspace: Workspace) -> DataFrame:
    """The postings (tile, a = id, b = component, at) of long tiles as rows (cell, own, id, at, mark) of cells to compare."""
    rows = found.where("tile IS NOT NULL").select("tile", F.col("a").alias("id"), F.col("b").alias("comp"), "at", _band(F.shiftright("at", 32), percent).alias("band"))
    bands = workspace.save(rows.groupBy("tile", "band").agg(F.count(F.lit(1)).alias("k"), F.min("comp").alias("least"), F.max("comp").alias("most")), "tile-bands")
    # A cell holds a band and the next one, if they are not of one component; what comes from the next one has a negative k.
    both = bands.unionByName(bands.withColumn("band", F.col("band") - 1).withColumn("k", -F.col("k")))
    cells = both.groupBy("tile", "band").agg(F.sum(F.abs("k")).alias("rows"), F.max("k").alias("own"), (F.min("least") < F.max("most")).alias("spread"))
    number = F.ceil(F.col("rows") / F.lit(TILE_ROWS)).cast("int")
    cells = workspace.save(cells.where("spread AND own > 0").select(F.col("tile").alias("t"), F.col("band").alias("c"), number.alias("number")), "cells")
    placed = rows.select("*", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("of"))
    placed = placed.join(cells, F.expr("tile = t AND of = c"))
    mine = F.pmod(F.xxhash64("id"), F.col("number")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("number") - 1)).alias("other")
    placed = placed.select("tile", "of", (F.col("band") == F.col("of")).alias("own"), "id", "at", mine.alias("mine"), other)
    key = F.xxhash64("tile", "of", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell")
    marked = placed.select(key, "own", "id", "at").join(marks.select(F.col("id").alias("of_id"), "mark"), F.col("id") == F.col("of_id"))
    return workspace.save(marked.select("cell", "own", "id", "at", "mark"), "dealt")


def _long_links(
    dealt: DataFrame, links: DataFrame, docs: DataFrame, words: int, percent: int, workspace: Workspace
) -> DataFrame:
    """links, and all that the cells of long tiles add to their components.

    Rounds check only what would connect each cell (see _dense), so a group of near copies costs a few pairs a row. They go
    on while a fair part of their pairs links. Then all pairs whose ends are still in different components are checked.
    """
    step, forest = 0, True
    while True:
        labels = components(links, workspace, f"long-part-{step}")
        known = labels.select(F.col("v"), F.col("component").alias("comp"))
        placed = dealt.join(known, F.col("id") == F.col("v"), "left").select("cell", "own", "id", F.coalesce("comp", "id").alias("comp"), "at", "mark")
        rows = placed.repartition("cell").sortWithinPartitions("cell").transform(map_arrow, _dense(percent, forest), "a long, b long")
        close = workspace.save(rows.distinct(), f"long-{step}-close")
        ends = close.select(F.col("a").alias("id")).unionByName(close.select(F.col("b").alias("id"))).distinct()
        found = _links(close, _sets_of(ends, docs, words, workspace, f"long-{step}"), percent, workspace, f"long-{step}")
        links = links.unionByName(found)
        pairs, joined = close.count(), found.count()
        if not forest or joined == pairs:  # connecting pairs that all link leave nothing open in any cell
            return links
        forest = joined * ROWS_PER_LINK >= pairs
        step += 1


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for _, _, data, at in blocks(batch.column(1)) for s in shingle_sets(data, at, words)]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], names=["id", "items"])

    return run


def _intersect(percent: int):
    """Pairs with both sorted sets to those that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                s, t = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                if len(s) > len(t):
                    s, t = t, s
                spot = np.searchsorted(t, s)
                spot[spot == len(t)] = 0
                both = int((t[spot] == s).sum()) if len(t) else 0
                keep.append(bool(both) and 100 * both >= percent * (len(s) + len(t) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return run


def _bounded(percent: int):
    """Pairs with sizes and signatures to those the bitmap bound leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 4))
            keep = [
                overlap_bound(x.as_py(), int(p), y.as_py(), int(q)) >= -(-percent * (int(p) + int(q)) // (100 + percent))
                for x, p, y, q in zip(batch.column(3), na, batch.column(5), nb, strict=True)
            ]
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return run


def _sets_of(ids: DataFrame, docs: DataFrame, words: int, workspace: Workspace, name: str) -> DataFrame:
    """(id, items): the sorted sets of some classes; a bitmap of their ids tells the scan which texts to read."""
    needed = bitmaps.of_keys(workspace.save(ids.select("id"), f"{name}-ids"), workspace, f"{name}-needed")
    wanted = bitmaps.flag(docs, needed.rows, needed.slot(F.col("id")), "__wanted").where("__wanted").select("id", "text")
    return workspace.save(wanted.transform(map_arrow, _sets(words), "id long, items binary"), f"{name}-sets")


def _close(pairs: DataFrame, marks: DataFrame, percent: int, workspace: Workspace, name: str) -> DataFrame:
    """Pairs (a, b) of classes that sizes and bitmaps leave."""
    one = marks.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("mark").alias("ma"))
    two = marks.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("mark").alias("mb"))
    sized = pairs.join(one, "a").join(two, "b").where(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    )
    return workspace.save(
        sized.select("a", "b", "na", "ma", "nb", "mb").transform(map_arrow, _bounded(percent), "a long, b long"), f"{name}-close"
    )


def _links(close: DataFrame, sets: DataFrame, percent: int, workspace: Workspace, name: str) -> DataFrame:
    """Pairs (a, b) that link, by the intersection of their sets."""
    s, t = sets.select(F.col("id").alias("a"), F.col("items").alias("sa")), sets.select(F.col("id").alias("b"), F.col("items").alias("sb"))
    full = close.join(s, "a").join(t, "b").select("a", "b", "sa", "sb")
    return workspace.save(full.transform(map_arrow, _intersect(percent), "a long, b long").distinct(), f"{name}-links")


def _lowered(links: DataFrame, labels: DataFrame | None, workspace: Workspace, name: str) -> DataFrame:
    """Labels (v, component) after one step along the links: equal labels are connected, connected ones may still differ."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if labels is None:
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        return workspace.save(least.select(F.col("a").alias("v"), F.least("a", "m").alias("component")), name)
    known = labels.select(F.col("v").alias("__v"), F.col("component").alias("__c"))
    seen = both.join(known, F.col("b") == F.col("__v"), "left").select("a", F.least("a", F.coalesce("__c", "b")).alias("c"))
    every = seen.unionByName(labels.select(F.col("v").alias("a"), F.col("component").alias("c")))
    return workspace.save(every.groupBy("a").agg(F.min("c").alias("component")).withColumnRenamed("a", "v"), name)


def _near_links(marks: DataFrame, docs: DataFrame, words: int, percent: int, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """Links among classes that share a band key, and labels (v, component) of them: equal ones are connected."""
    banded = marks.select("id", F.explode("bands").alias("key"))
    shared = workspace.save(banded.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key"), "near-keys")
    rows = workspace.save(banded.join(shared, "key"), "near-rows")
    sets = _sets_of(rows.select("id").distinct(), docs, words, workspace, "near")
    links, labels, step = None, None, 0
    while True:
        if labels is None:
            placed = rows.withColumn("comp", F.col("id"))
        else:  # only groups that still hold many pairs of different components go on
            placed = rows.join(labels, rows["id"] == labels["v"], "left").select("key", "id", F.coalesce("component", "id").alias("comp"))
        sizes = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k"))
        spread = sizes.groupBy("key").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("same"))
        spread = workspace.save(spread.where(F.col("k") * F.col("k") - F.col("same") > (PAIRS_PER_ROW * F.col("k") if step else 0)), f"near-spread-{step}")
        if step and not spread.limit(1).count():
            break
        placed = workspace.save(placed.join(spread.select("key"), "key", "left_semi"), f"near-placed-{step}")
        rows = placed.select("key", "id")
        partner = placed.groupBy("key").agg(F.min_by(F.struct("id", "comp"), F.struct(F.xxhash64("id", F.lit(step)), "id")).alias("p"))
        partner = workspace.save(partner, f"near-partner-{step}")
        pairs = placed.join(partner, "key").where(F.col("comp") != F.col("p.comp"))
        pairs = pairs.select(F.least("id", F.col("p.id")).alias("a"), F.greatest("id", F.col("p.id")).alias("b")).distinct()
        found = _links(_close(pairs, marks, percent, workspace, f"near-{step}"), sets, percent, workspace, f"near-{step}")
        links = found if links is None else workspace.save(links.unionByName(found), f"near-all-{step}")
        labels = _lowered(links, labels, workspace, f"near-part-{step}")
        if found.count() * ROWS_PER_LINK < placed.count():
            break
        step += 1
    workspace.drop("near-sets")
    return links, labels


def _members(plain: DataFrame, workspace: Workspace, words: int, percent: int, rows: DataFrame, table_bits: int) -> DataFrame:
    """(id, n, component) of each row of plain (id, text), whose ids each have one text; `rows` are its classes."""
    spark = plain.sparkSession
    texts = rows.where("chunk IS NULL")
    shared = spark.sparkContext.broadcast(frequencies(rows, table_bits))

    classes = (
        texts.where("n > 0")
        .groupBy("n", "low", "high")
        .agg(F.min("id").alias("rep"))
        .where("rep IS NOT NULL")
    )
    classes = workspace.save(classes, "reps")
    marks = texts.select("id", "n", "low", "high", "bands", "mark").join(
        classes.withColumnsRenamed({"n": "n_", "low": "low_", "high": "high_"}),
        F.expr("id = rep AND n = n_ AND low = low_ AND high = high_"),
    )
    marks = workspace.save(marks.select("id", "n", "bands", "mark").dropDuplicates(["id"]), "marks")

    near, labels = _near_links(marks, plain, words, percent, workspace)

    prefixes = plain.transform(map_arrow, _postings(words, percent, shared), "id long, n int, prefix binary").where("n > 0")
    prefixes = workspace.save(prefixes, "prefixes")  # also keeps two Python steps out of one task
    known = marks.select(F.col("id").alias("rep")).join(labels, F.col("rep") == labels["v"], "left")
    known = known.select("rep", F.coalesce("component", "rep").alias("comp"))
    placed = prefixes.join(known, prefixes["id"] == known["rep"]).select("id", "comp", "n", "prefix")
    postings = placed.transform(map_arrow, _tiles(shared), POSTING_SCHEMA)
    sorted_tiles = postings.repartition("tile", "deal").sortWithinPartitions(F.col("deal").isNull(), "tile")
    found = workspace.save(sorted_tiles.transform(map_arrow, _pairs(percent), PAIR_SCHEMA), "candidates")
    short = _close(found.where("tile IS NULL").select("a", "b").distinct(), marks, percent, workspace, "short")
    ends = short.select(F.col("a").alias("id")).unionByName(short.select(F.col("b").alias("id"))).distinct()
    links = near.unionByName(_links(short, _sets_of(ends, plain, words, workspace, "short"), percent, workspace, "short"))
    links = _long_links(_dealt(found, marks, percent, workspace), links, plain, words, percent, workspace)
    final = components(links, workspace, "part")

    named = classes.join(final, classes["rep"] == final["v"], "left").select(
        F.col("n").alias("n_"), F.col("low").alias("low_"), F.col("high").alias("high_"), F.coalesce("component", "rep").alias("of_class")
    )
    named = workspace.save(named, "named")
    slim = texts.select("id", "n", "low", "high")
    joined = slim.join(named, F.expr("n = n_ AND low = low_ AND high = high_"), "left")
    return joined.select("id", F.col("n").cast("long").alias("n"), F.coalesce("of_class", "id").alias("component"))


def _of_rows(plain: DataFrame, workspace: Workspace, words: int, percent: int, table_bits: int) -> DataFrame:
    """What _members gives, for ids that are null or have several texts: rows are numbered and joined, and then those of an id."""
    numbered = workspace.save(plain.withColumn("row", F.monotonically_increasing_id()), "numbered")
    rows = numbered.select(F.col("row").alias("id"), "text")
    classes = workspace.save(rows.transform(map_arrow, _classes(words, table_bits), CLASS_SCHEMA), "classes")
    found = workspace.save(_members(rows, workspace, words, percent, classes, table_bits), "by-row")
    own = numbered.select("row", F.col("id").alias("doc")).join(found, F.col("row") == found["id"]).select("doc", "n", "component")
    own = workspace.save(own, "row-members")
    least = own.groupBy("component").agg(F.min("doc").alias("least"))
    least = workspace.save(least.select(F.col("component").alias("of"), "least"), "least")
    links = own.join(least, own["component"] == least["of"]).where("doc <> least").select(F.col("least").alias("a"), F.col("doc").alias("b"))
    joined = components(links.distinct(), workspace, "documents")
    named = least.join(joined, least["least"] == joined["v"], "left").select("of", F.coalesce(joined["component"], "least").alias("smallest"))
    named = workspace.save(named, "smallest")
    return own.join(named, own["component"] == named["of"]).select(F.col("doc").alias("id"), "n", F.col("smallest").alias("component"))


def jaccard_components(
    docs: DataFrame,
    workspace: Workspace,
    *,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of docs: id, n_shingles and component_id, the smallest id reachable by links."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    table_bits = frequency_bits(plain)
    rows = workspace.save(plain.transform(map_arrow, _classes(words, table_bits), CLASS_SCHEMA), "classes")
    own = F.struct("n", "low", "high")
    sets = rows.where("chunk IS NULL AND n > 0").groupBy("id").agg(F.min(own).alias("x"), F.max(own).alias("y"))
    if sets.where("id IS NULL OR x <> y").limit(1).count():
        found = _of_rows(plain, workspace, words, percent, table_bits)
    else:
        found = _members(plain, workspace, words, percent, rows, table_bits)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one_per_component(
    docs: DataFrame, workspace: Workspace, *, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of docs that stay: of each component the document whose id is the component's."""
    found = workspace.save(
        jaccard_components(docs, workspace, words=words, percent=percent, id_col=id_col, text_col=text_col), "members"
    )
    dropped = workspace.save(found.where(F.col("component_id") != F.col(id_col)).select(id_col).distinct(), "dropped")
    return bitmaps.without(docs, dropped, workspace, "dropped-bits", {id_col: F.col(id_col)})
