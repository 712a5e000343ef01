"""Segmentation lattices of many words at once: which vocabulary pieces match where, and sums over all paths.

A word's lattice has a node before each character and one behind the last; an arc is a piece of the
vocabulary that spells the characters between two nodes. A character that is no piece of its own gets
one arc made of its byte pieces, so every text has a path.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from weft.llm.textops import U64, prefix_sums, span_code, span_hash

#: How the vocabulary writes a space. Lattices are built over texts with plain spaces, so that a text that
#: has this character itself spells it in byte pieces and stays distinct.
MARK = "▁"
MARK_BYTES = b" "
ZIPF_SHIFT = 10.0
NONE = -np.inf


@dataclass
class Vocabulary:
    """Pieces of an existing tokenizer: hash look-up and log probabilities (natural)."""

    hashes: np.ndarray
    ids: np.ndarray
    slot: np.ndarray  # the first piece of each cell, -1 for none
    crowded: np.ndarray  # whether another piece has the cell of this one
    more: np.ndarray  # hashes of those other pieces
    more_at: np.ndarray
    begun: np.ndarray
    log_p: np.ndarray
    byte_ids: np.ndarray
    longest: int
    pieces: list[str]
    body: np.ndarray
    begin: np.ndarray
    lengths: np.ndarray

    def find(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which spans are pieces, their ids, and which spans may be the start of a longer piece.

        Look-ups of a cheap code leave few spans to search; a code that is shared by chance only costs time.
        """
        cell = _cell(span_code(sums, starts, ends))
        place = self.slot[cell >> 2]
        maybe = np.flatnonzero(place >= 0)
        place, some = place[maybe], span_hash(sums, starts[maybe], ends[maybe])
        hit = self.hashes[place] == some
        other = np.flatnonzero(~hit & self.crowded[place])
        if len(other):
            at = np.minimum(np.searchsorted(self.more, some[other]), len(self.more) - 1)
            found = self.more[at] == some[other]
            place[other[found]] = self.more_at[at[found]]
            hit[other[found]] = True
        return maybe[hit], self.ids[place[hit]], self.begun[cell]


def _cell(code: np.ndarray) -> np.ndarray:
    return ((code * U64(0x9E3779B97F4A7C15)) >> U64(42)).astype(np.int64)


@lru_cache(maxsize=2)
def vocabulary(model_file: str) -> Vocabulary:
    """The pieces of a SentencePiece model.

    A BPE model's score is the negated rank of its merge. Ranks follow frequency, so a piece of rank r
    gets a probability in proportion to 1 / (r + ZIPF_SHIFT). A unigram model's scores are taken as they are.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    scores = np.array([model.get_score(i) for i in range(n)])
    byte_ids = np.full(256, -1, np.int64)
    for i in range(n):
        if model.is_byte(i):
            byte_ids[int(pieces[i][3:5], 16)] = i
    plain = np.array([not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)])
    by_rank = bool(np.all(scores[plain] == np.round(scores[plain])))
    if by_rank:
        rank = np.where(scores > -1e8, -scores, n).clip(0)
        weight = np.where(plain, 1.0 / (rank + ZIPF_SHIFT), 0.0)
    else:
        weight = np.where(plain, np.exp(scores), 0.0)
    weight[byte_ids[byte_ids >= 0]] = 1.0 / (n + ZIPF_SHIFT)
    with np.errstate(divide="ignore"):
        log_p = np.log(weight / weight.sum())
    usable = np.flatnonzero(plain)
    body = [pieces[i].replace(MARK, " ").encode() for i in usable]
    ends = np.cumsum([len(b) for b in body])
    data = np.frombuffer(b"".join(body), np.uint8)
    sums, starts = prefix_sums(data), np.concatenate([[0], ends[:-1]])
    h = span_hash(sums, starts, ends)
    order = np.argsort(h)
    slot, begun = np.full(1 << 20, -1, np.int32), np.zeros(1 << 22, bool)
    cell = (_cell(span_code(sums, starts, ends)) >> 2)[order]
    slot[cell[::-1]] = np.arange(len(order), dtype=np.int32)[::-1]
    late = np.flatnonzero(slot[cell] != np.arange(len(order)))
    crowded = np.zeros(len(order), bool)
    crowded[slot[cell[late]]] = True
    for size in range(1, int((ends - starts).max())):  # bytes; a prefix that ends within a character is never looked up
        longer = ends - starts > size
        begun[_cell(span_code(sums, starts[longer], starts[longer] + size))] = True
    longest = max(len(pieces[i]) for i in usable)
    of_byte = {int(i): bytes([b]) for b, i in enumerate(byte_ids) if i >= 0}
    spelled = [of_byte.get(i, p.replace(MARK, " ").encode() if plain[i] else b"") for i, p in enumerate(pieces)]
    lengths = np.array([len(x) for x in spelled], np.int64)
    bodies = np.frombuffer(b"".join(spelled), np.uint8)
    return Vocabulary(
        h[order], usable[order].astype(np.int32), slot, crowded, h[order][late], late, begun, log_p, byte_ids, longest, pieces,
        bodies, np.cumsum(lengths) - lengths, lengths,
    )


@dataclass
class Lattices:
    """Lattices of words, ordered by their number of characters.

    `order` has the words' places in the input; word k has nodes first[k] .. first[k] + chars[k].
    arcs[v, l - 1] is the piece that ends at node v and spells l characters, -1 for none, -2 for the
    byte pieces of one character; byte_log[v] is the log probability of those.
    """

    order: np.ndarray
    first: np.ndarray
    chars: np.ndarray
    arcs: np.ndarray
    node_byte: np.ndarray
    data: np.ndarray


def build(words: list[bytes], vocab: Vocabulary) -> Lattices:
    """Lattices of byte strings in UTF-8."""
    lengths = np.array([len(w) for w in words], np.int64)
    return build_spans(np.frombuffer(b"".join(words), np.uint8), lengths, vocab)


def build_spans(data: np.ndarray, lengths: np.ndarray, vocab: Vocabulary) -> Lattices:
    """Lattices of words of the given lengths that lie one behind the other in data."""
    begin = np.cumsum(lengths) - lengths
    lead = (data & 0xC0) != 0x80
    upto = np.concatenate([[0], np.cumsum(lead)])
    chars = upto[begin + lengths] - upto[begin]
    order = np.argsort(chars, kind="stable")
    # Nodes in the order of `order`.
    count = chars[order] + 1
    first = np.cumsum(count) - count
    total = int(count.sum())
    pos = np.arange(total) - np.repeat(first, count)
    char_byte = np.append(np.flatnonzero(lead), len(data))
    node_char = np.repeat(upto[begin[order]], count) + pos
    node_byte = char_byte[np.minimum(node_char, len(char_byte) - 1)]
    last = first + count - 1
    node_byte[last] = begin[order] + lengths[order]
    sums = prefix_sums(data)
    arcs = np.full((total, vocab.longest), -1, np.int32)
    room = np.repeat(chars[order], count) - pos
    live, reach = np.arange(total), 1
    for size in range(1, vocab.longest + 1):
        live = live[room[live] >= size]
        if not len(live):
            break
        hit, ids, begun = vocab.find(sums, node_byte[live], node_byte[live + size])
        if len(hit):
            arcs[live[hit] + size, size - 1] = ids
            reach = size
        live = live[begun]
    arcs = np.ascontiguousarray(arcs[:, :reach])
    lone = (arcs[:, 0] == -1) & (pos > 0)
    arcs[lone, 0] = -2
    return Lattices(order, first, chars[order], arcs, node_byte, data)


def weights(lat: Lattices, vocab: Vocabulary, log_p: np.ndarray) -> np.ndarray:
    """Log probability of each arc."""
    padded = np.concatenate([log_p, [NONE, NONE]])  # -2 and -1
    w = padded[lat.arcs]
    lone = np.flatnonzero(lat.arcs[:, 0] == -2)
    if len(lone):
        by_byte = np.concatenate([[0.0], np.cumsum(log_p[vocab.byte_ids][lat.data])])
        w[lone, 0] = by_byte[lat.node_byte[lone]] - by_byte[lat.node_byte[lone - 1]]
    return w


def _logsumexp(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(x - safe[:, None]).sum(axis=1))


def forward(lat: Lattices, w: np.ndarray, into: float = 0.0, whole: np.ndarray | None = None) -> np.ndarray:
    """Log of the summed probability of all paths from a word's start to each node.

    `into` is that of the arc before a word's first piece, `whole` that of an arc beside the pieces to each word's end.
    """
    alpha = np.full(len(w) + w.shape[1], NONE)  # the tail stands for what lies before a word
    alpha[lat.first] = into
    reach = np.arange(1, w.shape[1] + 1)
    longest = int(lat.chars.max()) if len(lat.chars) else 0
    for t in range(1, longest + 1):
        v = lat.first[np.searchsorted(lat.chars, t) :] + t
        k = min(t, w.shape[1])
        alpha[v] = _logsumexp(alpha[v[:, None] - reach[:k]] + w[v, :k])
        if whole is not None:
            done = np.arange(np.searchsorted(lat.chars, t), np.searchsorted(lat.chars, t, "right"))
            alpha[lat.first[done] + t] = np.logaddexp(alpha[lat.first[done] + t], whole[done])
    return alpha[: len(w)]


def backward(lat: Lattices, w: np.ndarray) -> np.ndarray:
    """Log of the summed probability of all paths from each node to its word's end."""
    n, reach = len(w), w.shape[1]
    beta = np.full(n + reach, NONE)
    end = lat.first + lat.chars
    beta[end] = 0.0
    sizes = np.arange(1, reach + 1)
    longest = int(lat.chars.max()) if len(lat.chars) else 0
    for t in range(1, longest + 1):  # t characters before the end
        v = end[np.searchsorted(lat.chars, t) :] - t
        k = min(t, reach)
        to = v[:, None] + sizes[:k]
        beta[v] = _logsumexp(beta[to] + w[to, sizes[:k] - 1])
    return beta[:n]


def shares(lat: Lattices, vocab: Vocabulary, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of arcs given by the node they leave and their size, the share of all paths from there to the word's end.

    Sums are taken of probabilities, and of logs where a word is so long that they come near the smallest double.
    """
    padded = np.concatenate([np.exp(vocab.log_p), [0.0, 0.0]])  # -2 and -1
    w = padded[lat.arcs]
    lone = np.flatnonzero(lat.arcs[:, 0] == -2)
    if len(lone):
        w[lone, 0] = np.exp(weights(lat, vocab, vocab.log_p)[lone, 0])
    n, reach = w.shape
    beta = np.zeros(n + reach)
    end = lat.first + lat.chars
    beta[end] = 1.0
    sizes = np.arange(1, reach + 1)
    for t in range(1, (int(lat.chars.max()) if len(lat.chars) else 0) + 1):
        v = end[np.searchsorted(lat.chars, t) :] - t
        k = min(t, reach)
        to = v[:, None] + sizes[:k]
        beta[v] = np.einsum("ij,ij->i", beta[to], w[to, sizes[:k] - 1])
    if len(lat.first) and beta[lat.first].min() < 1e-250:
        w = weights(lat, vocab, vocab.log_p)
        beta = backward(lat, w)
        return np.exp(w[at + size, size - 1] + beta[at + size] - beta[at])
    return w[at + size, size - 1] * beta[at + size] / beta[at]


def log_likelihoods(words: list[bytes], vocab: Vocabulary, models: np.ndarray, step: int = 20_000, into: np.ndarray | None = None, whole: np.ndarray | None = None) -> np.ndarray:
    """Log of the probability of each word under each model (a row of piece probabilities), summed over all segmentations.

    `into` has the log weight of each model's arc into the pieces, `whole` that of one arc from start to end, by model and word.
    """
    out = np.zeros((len(models), len(words)))
    for lo in range(0, len(words), step):
        lat = build(words[lo : lo + step], vocab)
        for k, log_p in enumerate(models):
            alpha = forward(lat, weights(lat, vocab, log_p), 0.0 if into is None else into[k], None if whole is None else whole[k, lo + lat.order])
            out[k, lo + lat.order] = alpha[lat.first + lat.chars]
    return out


def expected_counts(words: list[bytes], vocab: Vocabulary, log_p: np.ndarray, step: int = 20_000) -> np.ndarray:
    """How often each piece is used in the words, in expectation over their segmentations."""
    total = np.zeros(len(log_p))
    for lo in range(0, len(words), step):
        lat = build(words[lo : lo + step], vocab)
        w = weights(lat, vocab, log_p)
        alpha, beta = forward(lat, w), backward(lat, w)
        z = np.repeat(alpha[lat.first + lat.chars], lat.chars + 1)
        for size in range(1, w.shape[1] + 1):
            v = np.flatnonzero(lat.arcs[:, size - 1] >= 0)
            used = np.exp(alpha[v - size] + w[v, size - 1] + beta[v] - z[v])
            total += np.bincount(lat.arcs[v, size - 1], weights=used, minlength=len(total))
    return total
