"""SentencePiece encoding and decoding: Gumbel top-k segmentations without replacement.

A text, with a space before it, is a lattice over an existing SentencePiece vocabulary; a segmentation is
a path through it, with the probability of its pieces among all paths. Each text gets k distinct
segmentations by a perturbed A* search: the root has a Gumbel value, a node's best child inherits its
value, and a set of other children gets a Gumbel value of its own mass, truncated at the parent's. The
open sets are ranked by these values, the best one is split, and its path is drawn downwards by the
lattice's conditional probabilities. The values at the ends are those of perturbing every
segmentation independently, so the first k are a sample without replacement. With the (k+1)-th value t
as threshold, a segmentation of log probability p has the inclusion probability 1 - exp(-exp(p - t)).

Pieces do not cross into a new word, so the lattice of a distinct word is built and summed once (backward
recursion) and kept in a lexicon of bounded size for the texts of a task, and all words of a block of texts
walk their lattices together in numpy.

Every draw is a hash of the row's key, the sample's number and the place in the text: reruns agree, and
neither chunks nor partitions matter. Decoding joins the pieces and drops the first space; texts are
restored exactly, whatever they contain.

Nulls, ties, repeats: a null text is encoded as an empty one: the leading space alone. A null key is hashed as a key of its own.
Rows with the same key and text get the same samples. A text with fewer than k segmentations gets those
it has. An empty table gives no rows. Open sets of equal value are split in the order they were found. A very long text is
walked whole, with some 60 bytes for each of its pieces. Carried columns whose names clash with the operator's are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.arrow import map_arrow
from weft.llm import lattice
from weft.llm.textops import U64, blocks, mix, prefix_sums, span_hash

CHUNK_BYTES = 5 << 16
WALK_BYTES = 1 << 17
#: A task's lexicon begins again when it has grown beyond this; a chunk adds at most some 50 bytes for each of its own.
LEXICON_BYTES = 24 << 20
LATTICE_WORDS = 1_000
CELL_BITS = 18
SPACE = 0x20
SCHEMA_TAIL = "sample int, pieces binary, n_pieces int, log_prob double, gumbel double, inclusion double, restored boolean"


def _uniform(*keys: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from hashes of the keys."""
    h = mix(keys[0])
    for k in keys[1:]:
        h = mix(h * U64(0x2545F4914F6CDD1D) + k)
    return ((h >> U64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _truncated(mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values of location `mass` that lie below `bound`."""
    free = mass - np.log(-np.log(u))
    low = np.minimum(free, bound)
    with np.errstate(invalid="ignore"):
        value = low - np.log1p(np.exp(-np.abs(bound - free)))
    return np.where(np.isfinite(mass), value, -np.inf)


class Lexicon:
    """Lattices of the words a worker has met: for each node the arcs that leave it, with their conditional probabilities.

    Arc a of node v lies in arc_of[v] .. arc_of[v + 1] - 1 and has a piece, its number of nodes, q, the share of
    paths through v that take it, and upto, the sum of q from the node's first arc on, itself excluded. Longer
    pieces, which are likely ones, come first. An arc of byte pieces has piece -2; byte_of is a node's place in data.
    What a word gets does not depend on the words before it, so it does not matter which are known already.

    Words are found by their 64-bit hash: `cell` has the first word of each range of hashes, `known` all in order.
    """

    ARRAYS = (("root", np.int64), ("end", np.int64), ("hash_of", U64), ("piece", np.int32), ("span", np.int8), ("q", np.float32), ("upto", np.float32),
              ("byte_of", np.int32), ("arc_of", np.int64), ("data", np.uint8))

    def __init__(self, vocab: lattice.Vocabulary):
        self.vocab = vocab
        for name, kind in self.ARRAYS:  # room for all that may be kept; memory is taken when it is written to
            setattr(self, name, np.zeros((LEXICON_BYTES + 64 * CHUNK_BYTES) // np.dtype(kind).itemsize, kind))
        self.cell = np.empty(1 << CELL_BITS, np.int32)
        self.forget()

    def forget(self) -> None:
        """Begin again without any word; frequent ones are soon back."""
        self.used = dict.fromkeys((name for name, _ in self.ARRAYS), 0)
        self._append("arc_of", np.zeros(1, np.int64))
        self.cell.fill(-1)
        self.known, self.number = np.zeros(0, U64), np.zeros(0, np.int32)

    def _append(self, name: str, values: np.ndarray) -> None:
        old, n = getattr(self, name), self.used[name]
        if n + len(values) > len(old):
            grown = np.zeros(max(n + len(values), 2 * len(old)), old.dtype)
            grown[:n] = old[:n]
            setattr(self, name, grown)
            old = grown
        old[n : n + len(values)] = values
        self.used[name] = n + len(values)

    @property
    def bytes(self) -> int:
        return sum(self.used[name] * np.dtype(kind).itemsize for name, kind in self.ARRAYS)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words at spans of data; new ones get their lattices."""
        found = self.cell[hashes >> U64(64 - CELL_BITS)]
        miss = np.flatnonzero((found < 0) | (self.hash_of[found] != hashes))
        if len(miss):
            new, example, kind = np.unique(hashes[miss], return_index=True, return_inverse=True)
            at = np.searchsorted(self.known, new)
            number = np.full(len(new), -1, np.int32)
            old = np.flatnonzero(at < len(self.known))
            old = old[self.known[at[old]] == new[old]]
            number[old] = self.number[at[old]]
            add = np.flatnonzero(number < 0)
            if len(add):
                number[add] = self.used["root"] + np.arange(len(add), dtype=np.int32)
                self.known, self.number = np.insert(self.known, at[add], new[add]), np.insert(self.number, at[add], number[add])
                self._append("hash_of", new[add])
                place = new[add] >> U64(64 - CELL_BITS)
                free = self.cell[place] < 0
                self.cell[place[free][::-1]] = number[add[free]][::-1]
                first, last = starts[miss[example[add]]], ends[miss[example[add]]]
                for lo in range(0, len(add), LATTICE_WORDS):
                    self._build(data, first[lo : lo + LATTICE_WORDS], last[lo : lo + LATTICE_WORDS])
            found[miss] = number[kind]
        return found

    def _build(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        own = ends - starts
        body = data[np.repeat(starts, own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)]
        lat = lattice.build_spans(body, own, self.vocab)
        n, reach = lat.arcs.shape
        leaving = np.full((n, reach), -1, np.int32)
        for size in range(1, min(reach, n - 1) + 1):
            leaving[: n - size, reach - size] = lat.arcs[size:, size - 1]
        at, place = np.nonzero(leaving != -1)
        size = reach - place
        nodes = self.used["byte_of"]
        root, end = np.empty(len(own), np.int64), np.empty(len(own), np.int64)
        root[lat.order], end[lat.order] = nodes + lat.first, nodes + lat.first + lat.chars
        q = lattice.shares(lat, self.vocab, at, size).astype(np.float32)
        count = np.bincount(at, minlength=n)
        first = np.cumsum(count) - count
        upto, running = np.zeros(len(q), np.float32), np.zeros(n, np.float32)
        for nth in range(1, int(count.max()) if len(count) else 0):  # in the order of each node's arcs
            v = np.flatnonzero(count > nth)
            arc = first[v] + nth
            running[v] += q[arc - 1]
            upto[arc] = running[v]
        for name, values in (
            ("root", root), ("end", end), ("piece", leaving[at, place]), ("span", size.astype(np.int8)), ("q", q), ("upto", upto),
            ("byte_of", self.used["data"] + lat.node_byte), ("arc_of", self.used["piece"] + np.cumsum(count)), ("data", body),
        ):
            self._append(name, values)

    def draw(self, lo: np.ndarray, hi: np.ndarray, u: np.ndarray) -> np.ndarray:
        """For each row one of the arcs lo .. hi - 1 of a node, by their probabilities."""
        start = self.upto[lo]
        aim = start + u * (self.upto[hi - 1] + self.q[hi - 1] - start)
        arc = lo.astype(np.int64)
        open_ = np.flatnonzero((hi - lo > 1) & (aim >= self.upto[lo] + self.q[lo]))
        while len(open_):
            arc[open_] += 1
            at = arc[open_]
            open_ = open_[(at < hi[open_] - 1) & (aim[open_] >= self.upto[at] + self.q[at])]
        return arc

    def spell(self, arcs: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of arcs, and how many each arc has: one, or the bytes of a character that is no piece."""
        pieces = self.piece[arcs]
        loose = np.flatnonzero(pieces == -2)
        size = np.ones(len(arcs), np.int64)
        at = self.byte_of[nodes[loose]]
        lead = self.data[at]
        size[loose] = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        out = np.repeat(pieces, size)
        begin = np.cumsum(size) - size
        n = size[loose]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(begin[loose], n) + step] = self.vocab.byte_ids[self.data[np.repeat(at, n) + step]]
        return out, size


class Walk:
    """Steps of one sample in a chunk, text by text: the node left, the arc taken, the arcs it could take."""

    def __init__(self, lex: Lexicon, word: np.ndarray, node: np.ndarray, lo: np.ndarray, hi: np.ndarray, end: np.ndarray, key: np.ndarray):
        """One walker per word; lo, hi restrict its first step (all arcs where hi is 0)."""
        walkers = len(word)
        live, here, found, turn = np.arange(walkers), node, [], 0
        while len(live):
            a, b = lex.arc_of[here], lex.arc_of[here + 1]
            if turn == 0 and hi.any():
                a, b = np.where(hi > 0, lo, a), np.where(hi > 0, hi, b)
            arc = lex.draw(a, b, _uniform(key[live], np.full(len(live), turn, U64)))
            found.append((live, arc, a, b, here))
            to = here + lex.span[arc]
            more = np.flatnonzero(to < end[live])
            live, here = live[more], to[more]
            turn += 1
        steps = np.zeros(walkers, np.int64)
        for x, *_ in found:
            steps[x] += 1
        offset = np.cumsum(steps) - steps
        total = int(steps.sum())
        self.walker, self.arc = np.empty(total, np.int32), np.empty(total, np.int32)
        self.lo, self.hi, self.node = np.empty(total, np.int32), np.empty(total, np.int32), np.empty(total, np.int32)
        for turn, (x, arc, a, b, here) in enumerate(found):
            at = offset[x] + turn
            self.walker[at], self.arc[at], self.lo[at], self.hi[at], self.node[at] = x, arc, a, b, here
        self.word = word[self.walker]


def sample_chunk(data: np.ndarray, at: np.ndarray, keys: np.ndarray, lex: Lexicon, k: int):
    """For each text its samples: [pieces, log probability, Gumbel value, inclusion], best value first.

    data has the texts, each with its leading space; keys are 64-bit row keys. Words that the lexicon has not met
    get their lattices; texts walk them in blocks, so that the steps of a block fit in memory.
    """
    blank = data == SPACE
    before = np.concatenate([[False], blank[:-1]])
    cut = blank & ~before
    cut[at[:-1]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(data))
    first = np.searchsorted(starts, at)
    hashes = np.concatenate(list(_hash_blocks(data, starts, ends))) if len(starts) else np.zeros(0, U64)
    kind = lex.words(data, starts, ends, hashes)
    lo, results = 0, []
    while lo < len(at) - 1:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + WALK_BYTES, "right")) - 1)
        results += _sample_texts(lex, kind[first[lo] : first[hi]], first[lo : hi + 1] - first[lo], keys[lo:hi], k)
        lo = hi
    return results


def _sample_texts(lex: Lexicon, kind: np.ndarray, first: np.ndarray, keys: np.ndarray, k: int):
    """Samples of a block of texts, given as the lexicon's numbers of their words."""
    texts = len(first) - 1
    text_of = np.repeat(np.arange(texts), np.diff(first))
    word_key = mix(keys[text_of] + (np.arange(len(kind)) - first[text_of]).astype(U64) * U64(0x9E3779B97F4A7C15))

    results: list[list[tuple]] = [[] for _ in range(texts)]
    paths: list[dict[int, tuple]] = []  # per sample: text -> (parent sample, steps taken over from it, own steps)
    queue: list[list[tuple]] = [[] for _ in range(texts)]
    chosen = np.arange(texts)
    value = -np.log(-np.log(_uniform(keys, np.full(texts, 1, U64))))
    from_step, parent = np.zeros(texts, np.int64), np.full(texts, -1)
    carried = np.zeros(texts)
    words = np.arange(len(kind))
    node, low, high = lex.root[kind], np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)

    for sample in range(k + 1):
        if sample == k:
            break
        walk = Walk(lex, words, node.copy(), low, high, lex.end[kind[words]], word_key[words] + U64((sample + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
        owner = text_of[walk.word]
        edge = np.searchsorted(owner, np.append(chosen, texts)) if len(owner) else np.zeros(len(chosen) + 1, np.int64)
        log_q = np.log(lex.q[walk.arc], dtype=np.float64)
        running = np.cumsum(log_q)
        head = np.concatenate([[0.0], running])[edge[:-1]]
        count = np.diff(edge)
        nth = np.repeat(np.arange(len(chosen), dtype=np.int32), count)
        # The arcs before and behind the one taken, as two open sets of each step.
        values, prefix_of = [], lambda at: running[at] - log_q[at] + (carried - head)[nth[at]]  # noqa: B023, E731
        for side in (0, 1):
            open_ = np.flatnonzero(walk.arc > walk.lo if side == 0 else walk.arc < walk.hi - 1)
            arc = walk.arc[open_]
            if side == 0:
                mass = lex.upto[arc] - lex.upto[walk.lo[open_]]
            else:
                last = walk.hi[open_] - 1
                mass = lex.upto[last] + lex.q[last] - lex.upto[arc] - lex.q[arc]
            open_, mass = open_[mass > 0], mass[mass > 0]
            own = nth[open_]
            number = open_ - edge[own] + from_step[own]
            u = _uniform(keys[chosen[own]], (number * 2 + side).astype(U64), np.full(len(open_), 7 + sample, U64))
            value_of = np.full(len(owner), -np.inf)
            value_of[open_] = _truncated(prefix_of(open_) + np.log(mass, dtype=np.float64), value[own], u)
            values.append(value_of)
        total = np.add.reduceat(log_q, edge[:-1]) if len(log_q) else np.zeros(0)
        total = np.where(count > 0, total, 0.0) + carried
        best = np.maximum(*values)
        for _ in range(k - sample):  # as many open sets can still be split or give the threshold
            if not len(best):
                break
            top = np.maximum.reduceat(best, edge[:-1])
            hit = np.flatnonzero(best == top[nth])
            hit = hit[np.isfinite(best[hit])]
            new, index = np.unique(owner[hit], return_index=True)
            hit = hit[index]
            side = (values[1][hit] == best[hit]).astype(int)
            before_hit = prefix_of(hit)
            for t, h, s, p in zip(new.tolist(), hit.tolist(), side.tolist(), before_hit.tolist(), strict=True):
                arc = walk.arc[h]
                span = (walk.lo[h], arc) if s == 0 else (arc + 1, walk.hi[h])
                number = int(h - edge[nth[h]] + from_step[nth[h]])
                queue[t].append((best[h], sample, h, number, span, p, walk.word[h]))
            for s in (0, 1):
                values[s][hit[side == s]] = -np.inf
            best[hit] = np.maximum(values[0][hit], values[1][hit])
        paths.append({})
        for i, t in enumerate(chosen.tolist()):
            paths[sample][t] = (int(parent[i]), int(from_step[i]), walk, edge[i], edge[i + 1])
            results[t].append([sample, total[i], value[i]])
        if sample + 1 == k:
            break
        # Split each text's best open set.
        picked = []
        for t in range(texts):
            if queue[t]:
                j = max(range(len(queue[t])), key=lambda x: queue[t][x][0])
                picked.append((t, queue[t].pop(j)))
        if not picked:
            break
        chosen = np.array([t for t, _ in picked])
        value = np.array([x[0] for _, x in picked])
        parent = np.array([x[1] for _, x in picked])
        from_step = np.array([x[3] for _, x in picked])
        carried = np.array([x[5] for _, x in picked])
        branch = np.array([x[6] for _, x in picked])
        tail = first[chosen + 1] - branch
        words = np.repeat(branch, tail) + np.arange(tail.sum()) - np.repeat(np.cumsum(tail) - tail, tail)
        node, low, high = lex.root[kind[words]], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        at_branch = np.cumsum(tail) - tail
        low[at_branch] = [x[4][0] for _, x in picked]
        high[at_branch] = [x[4][1] for _, x in picked]
        node[at_branch] = np.searchsorted(lex.arc_of[: lex.used["arc_of"]], low[at_branch], "right") - 1

    def steps(t: int, sample: int) -> np.ndarray:
        """Arcs and nodes of a sample: its own steps behind those it took over. No recursion: a closure that refers to
        itself would keep a block's walks until the cycle is found."""
        parts, until = [], None
        while sample >= 0:
            up, begin, walk, a, b = paths[sample][t]
            b = b if until is None else a + max(0, until - begin)
            parts.append(np.stack([walk.arc[a:b], walk.node[a:b]]))
            until = begin if until is None else min(begin, until)
            sample = up
        return np.concatenate(parts[::-1], axis=1)

    for sample in range(len(paths)):
        own = list(paths[sample])
        parts = [steps(t, sample) for t in own]
        arcs, nodes = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0), np.int64)
        pieces, size = lex.spell(arcs, nodes)
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *[p.shape[1] for p in parts]])]
        for i, t in enumerate(own):
            results[t][sample][0] = pieces[ends[i] : ends[i + 1]]
    for t in range(texts):
        threshold = max((x[0] for x in queue[t]), default=-np.inf)
        for r in results[t]:
            with np.errstate(over="ignore"):
                r.append(float(-np.expm1(-np.exp(r[1] - threshold))) if np.isfinite(threshold) else 1.0)
    return results


def _hash_blocks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int = 1 << 20):
    """Hashes of spans, by blocks, so that the tables of powers stay small."""
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + size, "right")))
        part = data[starts[lo] : ends[hi - 1]]
        yield span_hash(prefix_sums(part), starts[lo:hi] - starts[lo], ends[lo:hi] - starts[lo])
        lo = hi


def decode(pieces: np.ndarray, vocab: lattice.Vocabulary) -> np.ndarray:
    """Bytes of the text that the piece ids spell, the leading space included."""
    n = vocab.lengths[pieces]
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return vocab.body[np.repeat(vocab.begin[pieces], n) + place]


def _restored(pieces: list[bytes], text: np.ndarray, data: np.ndarray, at: np.ndarray, vocab: lattice.Vocabulary) -> np.ndarray:
    """For each row whether its pieces spell its text."""
    out = np.zeros(len(pieces), bool)
    lo = 0
    while lo < len(pieces):
        hi = max(lo + 1, int(np.searchsorted(at, at[text[lo]] + WALK_BYTES, "right")))
        hi = max(lo + 1, int(np.searchsorted(text, hi)))
        spelled = decode(np.frombuffer(b"".join(pieces[lo:hi]), np.int32), vocab)
        sizes = np.array([vocab.lengths[np.frombuffer(p, np.int32)].sum() for p in pieces[lo:hi]])
        wanted = at[text[lo:hi] + 1] - at[text[lo:hi]]
        if (sizes == wanted).all() and (sizes > 0).all():
            begin = np.cumsum(sizes) - sizes
            source = data[np.repeat(at[text[lo:hi]] - begin, sizes) + np.arange(len(spelled))]
            out[lo:hi] = np.logical_and.reduceat(spelled == source, begin)
        else:
            for i in range(lo, hi):
                out[i] = np.array_equal(decode(np.frombuffer(pieces[i], np.int32), vocab), data[at[text[i]] : at[text[i] + 1]])
        lo = hi
    return out


def _encode(vocab_file: str, k: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = lattice.vocabulary(vocab_file)
        lex = Lexicon(vocab)
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).astype(U64)
            for lo, hi, data, at in blocks(batch.column(1), CHUNK_BYTES):
                rows = hi - lo
                spaced = np.full(len(data) + rows, SPACE, np.uint8)
                spaced[np.arange(len(data)) + np.repeat(np.arange(1, rows + 1), np.diff(at))] = data
                begin = at + np.arange(rows + 1)
                if lex.bytes > LEXICON_BYTES:
                    lex.forget()
                found = sample_chunk(spaced, begin, keys[lo:hi], lex, k)
                row, sample, pieces, size, log_prob, gumbel, inclusion = ([] for _ in range(7))
                for t, samples in enumerate(found):
                    for j, (ids, p, g, i) in enumerate(samples):
                        row.append(lo + t)
                        sample.append(j)
                        pieces.append(ids.tobytes())
                        size.append(len(ids))
                        log_prob.append(p)
                        gumbel.append(g)
                        inclusion.append(i)
                restored = _restored(pieces, np.array(row, np.int64) - lo, spaced, begin, vocab)
                kept = pa.array(row, pa.int64())
                yield pa.record_batch(
                    [*[c.take(kept) for c in batch.columns[2:]], pa.array(sample, pa.int32()), pa.array(pieces, pa.binary()),
                     pa.array(size, pa.int32()), pa.array(log_prob, pa.float64()), pa.array(gumbel, pa.float64()),
                     pa.array(inclusion, pa.float64()), pa.array(restored, pa.bool_())],
                    names=[*names, "sample", "pieces", "n_pieces", "log_prob", "gumbel", "inclusion", "restored"],
                )
                del found, pieces, spaced, kept

    return run


def encode(docs: DataFrame, vocab_file: str, *, samples: int = 2, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), seed: int = 5) -> DataFrame:
    """One row per document and sample: id, carried columns, sample, pieces (ids as packed int32, little endian),
    n_pieces, log_prob (of the segmentation among all of its text), gumbel, inclusion and restored."""
    taken = {"sample", "pieces", "n_pieces", "log_prob", "gumbel", "inclusion", "restored"}
    names = [id_col, *[c for c in carry if c != id_col and c not in taken]]
    slim = docs.select(
        F.xxhash64(F.lit(seed), F.col(id_col).cast("string")).alias("__key"),
        F.col(text_col).alias("__text"),
        *[F.col(c).alias(f"__c{i}") for i, c in enumerate(names)],
    )
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return slim.transform(map_arrow, _encode(vocab_file, samples, names), f"{kinds}, {SCHEMA_TAIL}")


def decoded(encoded: DataFrame, vocab_file: str, pieces_col: str = "pieces", text_col: str = "text") -> DataFrame:
    """encoded with the text its pieces spell."""
    columns = [c for c in encoded.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = lattice.vocabulary(vocab_file)
        for batch in batches:
            at = columns.index(pieces_col)
            texts = [None if x is None else decode(np.frombuffer(x, np.int32), vocab)[1:].tobytes().decode() for x in batch.column(at).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*columns, text_col])

    kinds = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in columns)
    return encoded.select(*columns).transform(map_arrow, run, f"{kinds}, `{text_col}` string")
