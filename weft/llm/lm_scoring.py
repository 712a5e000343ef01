"""Language-model scoring with subword lattices: the marginal probability of a text over all segmentations.

Each word, in lower case and behind a space, is a lattice. From its start one arc leads to its end if the training
corpus has the word, and one arc leads into the pieces of an existing tokenizer's vocabulary that spell it; an end piece
closes a spelling. With c the word's count among the N training tokens (ends of texts included) of a class, V its
distinct words and d the DISCOUNT,

    P(whole-word arc) = max(c - d, 0) / N,  P(arc into the pieces) = d V / N,  P(end of the text) = texts / N,

which sum to one: of each distinct word's count d goes to the pieces, which is what unseen words live on. Pieces start at
the vocabulary's own scores and are re-estimated by EM_STEPS steps of expectation maximisation over the distinct training
words of the class. One forward recursion in log space sums all paths, the whole-word arc among them.

Classes are values of a column (the language): the most frequent ones, `classes` - 1 of them, and the rest as one. The
probability of a text is the sum over the classes of their share of the training texts times the product of its words'
probabilities and its end's; the class of a scored text is not looked at. The score is its log10. The probabilities
of all texts sum to less than one only by what the pieces give to sequences that are no word (a space within).

Corpus counts are exact and cover every training text. A text of counts per row is never exploded:

1. Tasks cut their texts into chunks of CHUNK_BYTES. Each chunk is written as word numbers local to the
   chunk, in rows of one block of texts each, and a dictionary (word, count) of the chunk; a frequent word is one row per
   chunk. A task keeps word numbers and the distinct words of each block, not the texts of a chunk.
2. Dictionaries are summed by word. The table of words grows with the input and stays distributed.
3. Each word gets its lattice probability once, returns to the chunks that have it, and the chunks'
   texts are scored with it.

Nulls, ties, repeats: a null text is an empty one: its end alone is scored. Null ids are kept; a null in the condition
that marks training rows is no; a null class is in the rest. Repeated rows are scored alike, and train as often as they
occur. Without training rows the pieces have the vocabulary's own scores, and each token is the end with EMPTY_END. An
empty table gives no rows. Very long texts are hashed in windows; one text is never cut into several chunks. Other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.arrow import map_arrow, release
from weft.llm import lattice
from weft.llm.sums import pack, summed, unpack
from weft.llm.textops import LOWER, blocks, hashed_words
from weft.workspace import Workspace

CHUNK_BYTES = 20 << 20
DICTIONARY_ROWS = 20_000
ROW_GROUP_BYTES = 16 << 20
EM_STEPS = 2
DISCOUNT = 0.75
CLASSES = 6
PIECE_FLOOR = 1e-2
EMPTY_END = 1e-2


def _columns(classes: int) -> list[str]:
    """Count columns of the classes."""
    return [f"c{k}" for k in range(classes)]


@dataclass
class Block:
    """Some texts of a chunk: each distinct word once, with its hash, and the texts' words as numbers of those."""

    hashes: np.ndarray
    words: pa.Array
    local: np.ndarray
    lengths: np.ndarray  # words of each text
    rows: np.ndarray
    learned: np.ndarray  # the class of a training text, else the number of classes


def _block(data: np.ndarray, at: np.ndarray, rows: np.ndarray, learned: np.ndarray) -> Block:
    data = LOWER[data]
    hashes, starts, ends, first = hashed_words(data, at)
    hashes, where, local = np.unique(hashes, return_index=True, return_inverse=True)
    order = np.argsort(where)
    starts, ends = starts[where[order]], ends[where[order]]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    body = data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(where), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return Block(hashes, words.take(pa.array(np.argsort(order))), local.astype(np.int32), np.diff(first), rows, learned)


def _chunk(blocks_of: list[Block], number: int, classes: int) -> Iterator[pa.RecordBatch]:
    """One chunk from its blocks: a row of texts for each, then the dictionary."""
    names = ["chunk", "texts", "local", "word", *_columns(classes)]
    _, at, to = np.unique(np.concatenate([b.hashes for b in blocks_of]), return_index=True, return_inverse=True)
    to = np.split(to.astype(np.int32), np.cumsum([len(b.hashes) for b in blocks_of])[:-1])
    words = pa.concat_arrays([b.words for b in blocks_of]).take(pa.array(at))
    count = np.zeros((len(at), classes), np.int32)
    for b, own in zip(blocks_of, to, strict=True):
        seen = np.bincount(b.local * np.int64(classes + 1) + np.repeat(b.learned, b.lengths), minlength=len(own) * (classes + 1))
        count[own] += seen.reshape(-1, classes + 1)[:, :classes].astype(np.int32)
        texts = b"".join(
            x.tobytes()
            for x in (
                np.array([len(b.rows), len(at)], np.int64),
                b.rows.astype(np.int64),
                b.learned.astype(np.int64),
                np.concatenate([[0], np.cumsum(b.lengths)]).astype(np.int64),
                own[b.local],
            )
        )
        yield pa.record_batch(
            [pa.array([number]), pa.array([texts], pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
             *[pa.array([int((b.learned == k).sum())]) for k in range(classes)]], names=names,
        )
    for lo in range(0, len(at), DICTIONARY_ROWS):
        n = min(DICTIONARY_ROWS, len(at) - lo)
        yield pa.record_batch(
            [pa.array(np.full(n, number)), pa.nulls(n, pa.binary()), pa.array(np.arange(lo, lo + n, dtype=np.int32)), words[lo : lo + n],
             *[pa.array(count[lo : lo + n, k].astype(np.int64)) for k in range(classes)]], names=names,
        )


def _chunks(classes: int):
    """(row, class, text) to chunks and their dictionaries; the class of a row that is not learned is `classes`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            learned = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, data, at in blocks(batch.column(2)):
                parts.append(_block(data, at, rows[lo:hi].copy(), learned[lo:hi]))
                held += len(data)
                if held >= CHUNK_BYTES:
                    yield from _chunk(parts, number, classes)
                    number, parts, held = number + 1, [], 0
        if parts:
            yield from _chunk(parts, number, classes)

    return run


def _marked(words) -> list[bytes]:
    return [lattice.MARK_BYTES + w for w in words]


def piece_log_p(words: DataFrame, vocab_file: str, classes: int) -> np.ndarray:
    """Log probabilities of the pieces in each class, re-estimated over its distinct training words.

    What reaches the driver is one number per class and piece of the vocabulary. An end follows each word.
    """
    spark = words.sparkSession
    start = lattice.vocabulary(vocab_file).log_p
    log_p = np.tile(start, (classes, 1))

    def counted(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocab = lattice.vocabulary(vocab_file)
            total = np.zeros((classes, 1 + len(vocab.log_p)))  # words, then uses of the pieces
            for batch in batches:
                found = _marked(batch.column(0).to_pylist())
                for k in range(classes):
                    own = np.flatnonzero(batch.column(1 + k).to_numpy(zero_copy_only=False))
                    total[k, 1:] += lattice.expected_counts([found[i] for i in own], vocab, shared.value[k])
                    total[k, 0] += len(own)
            yield pa.record_batch([pa.array(range(classes)), pa.array([pack(t) for t in total], pa.binary())], names=["key", "values"])

        return run

    for _ in range(EM_STEPS):
        partial = words.select("word", *_columns(classes)).transform(map_arrow, counted(spark.sparkContext.broadcast(log_p)), "key long, values binary")
        for row in summed(partial, np.float64).collect():
            found = unpack(row["values"], np.float64)
            if found[0]:
                counts = found[1:] + PIECE_FLOOR * (start > -np.inf)
                with np.errstate(divide="ignore"):
                    log_p[row["key"]] = np.log(counts / (counts.sum() + found[0]))
    return log_p


def _end_log_p(log_p: np.ndarray) -> float:
    """What the pieces leave for the end of a word; before any training, one piece in three ends a word."""
    left = 1 - np.exp(log_p).sum()
    return float(np.log(left)) if left > 1e-9 else float(np.log(1 / 3))


def _class_column(docs: DataFrame, learned: Column, class_col: str | None, classes: int) -> tuple[Column, int]:
    """Number of a row's class and how many there are: the most frequent values of training rows, and the rest."""
    if class_col is None or classes < 2:
        return F.lit(0), 1
    named = F.col(class_col).cast("string").alias("k")
    seen = docs.where(learned).groupBy(named).count().orderBy(F.desc("count"), "k").limit(classes + 1).collect()
    top = [r["k"] for r in seen if r["k"] is not None][: classes - 1]
    number = F.lit(len(top))
    for i, k in enumerate(top):
        number = F.when(F.col(class_col).cast("string") == k, F.lit(i)).otherwise(number)
    return number, max(1, len(top) + (len(seen) > len(top)))


def score(
    docs: DataFrame,
    workspace: Workspace,
    learned: Column,
    vocab_file: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    class_col: str | None = "lang",
    classes: int = CLASSES,
) -> DataFrame:
    """id, learned, n_tokens, n_known, train_tokens, base_score and score of each row; learned marks training rows.

    classes is how many models there are at most, the one for the rest of the values included.
    """
    spark = docs.sparkSession
    learned = F.coalesce(learned, F.lit(False))
    null_id = -(1 << 63)
    number, classes = _class_column(docs, learned, class_col, classes)
    counts = _columns(classes)
    plain = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(null_id)).alias("row"),
        F.when(learned, F.least(number, F.lit(classes - 1))).otherwise(F.lit(classes)).alias("k"),
        F.col(text_col).alias("text"),
    )
    schema = "chunk long, texts binary, local int, word binary, " + ", ".join(f"{c} long" for c in counts)
    chunks = workspace.save(plain.transform(map_arrow, _chunks(classes), schema), "chunks", **{"parquet.block.size": ROW_GROUP_BYTES})
    of_text = F.col("local").isNull()  # a filter on texts would read them
    entries = chunks.where(~of_text).select("chunk", "local", "word", *counts)
    words = workspace.save(entries.groupBy("word").agg(*[F.sum(c).alias(c) for c in counts]), "words")
    known = sum((F.col(c) for c in counts), F.lit(0)) > 0
    totals = words.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"n_{c}") for c in counts],
        *[F.count(F.when(F.col(c) > 0, 1)).alias(f"v_{c}") for c in counts],
        F.count(F.when(known, 1)).alias("v"),
    ).first()
    ends = chunks.where(of_text).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]).first()
    facts = Facts(
        np.array([totals[f"n_{c}"] + ends[c] for c in counts], float),
        np.array([totals[f"v_{c}"] for c in counts], float),
        np.array([ends[c] for c in counts], float),
        totals["v"] + (sum(ends) > 0),
    )
    log_p = piece_log_p(words.where(known), vocab_file, classes)
    shared = spark.sparkContext.broadcast(log_p)

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words with their counts to words with their count and log probability in each class."""
        vocab = lattice.vocabulary(vocab_file)
        for batch in batches:
            c = np.stack([x.to_numpy(zero_copy_only=False) for x in batch.columns[1:]], axis=1)
            prices = facts.prices(batch.column(0).to_pylist(), c, vocab, shared.value).T.astype(np.float32)
            packed = pa.array([np.ascontiguousarray(x).tobytes() for x in prices], pa.binary())
            yield pa.record_batch([batch.column(0), pa.array(c.sum(axis=1)), packed], names=["word", "c", "prices"])

    priced = workspace.save(words.transform(map_arrow, price, "word binary, c long, prices binary"), "priced")
    workspace.drop("words")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Dictionary rows to one row of arrays per chunk and batch."""
        for batch in batches:
            chunk, local, c = (x.to_numpy(zero_copy_only=False) for x in batch.columns[:3])
            prices = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.float32).reshape(len(chunk), -1)
            order = np.argsort(chunk, kind="stable")
            edges = np.flatnonzero(np.concatenate(([True], np.diff(chunk[order]) != 0, [True])))
            runs = [order[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)] if len(order) else []
            yield pa.record_batch(
                [pa.array([chunk[r[0]] for r in runs], pa.int64()),
                 pa.array([local[r].astype(np.int32).tobytes() for r in runs], pa.binary()),
                 pa.array([c[r].astype(np.int64).tobytes() for r in runs], pa.binary()),
                 pa.array([prices[r].tobytes() for r in runs], pa.binary())],
                names=["chunk", "local", "c", "prices"],
            )

    back = entries.select("chunk", "local", "word").join(priced, "word").select("chunk", "local", "c", "prices")
    back = back.transform(map_arrow, packed, "chunk long, local binary, c binary, prices binary")
    texts = chunks.where(of_text).select("chunk", "texts")

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        try:
            return _score_chunk(left["texts"], right, facts)
        finally:
            release()

    schema = "row long, learned boolean, n_tokens long, n_known long, base_score double, score double"
    found = texts.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInPandas(scored, schema)
    return found.select(
        F.when(F.col("row") != null_id, F.col("row")).alias(id_col),
        "learned",
        "n_tokens",
        "n_known",
        F.lit(int(facts.tokens)).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@dataclass
class Facts:
    """Training tokens, distinct words and texts by class, and distinct tokens of all."""

    by_class: np.ndarray
    distinct_by_class: np.ndarray
    ends: np.ndarray
    distinct: int

    @property
    def tokens(self) -> float:
        return self.by_class.sum()

    def end_log_p(self, k: int) -> float:
        return float(np.log(self.ends[k] / self.by_class[k])) if self.ends[k] else float(np.log(EMPTY_END))

    def prices(self, words: list[bytes], c: np.ndarray, vocab: lattice.Vocabulary, log_p: np.ndarray) -> np.ndarray:
        """Log of P(word | class), a row per class, of words with their counts (a column per class)."""
        known = self.ends > 0
        n = np.where(known, self.by_class, 1.0)
        with np.errstate(divide="ignore"):
            spell = np.where(known, np.log(DISCOUNT * self.distinct_by_class / n), np.log(1 - EMPTY_END))
            whole = np.where(known[:, None], np.log(np.maximum(c.T - DISCOUNT, 0) / n[:, None]), -np.inf)
        closed = spell + np.array([_end_log_p(p) for p in log_p])
        return lattice.log_likelihoods(_marked(words), vocab, log_p, into=closed, whole=whole)


def _score_chunk(texts: Iterable[bytes], dictionary: pd.DataFrame, facts: Facts) -> pd.DataFrame:
    """Scores of a chunk's texts, block by block."""
    classes, texts = len(facts.ends), list(texts)
    types = int(np.frombuffer(texts[0], np.int64, 2)[1])
    c, prices = np.zeros(types, np.int64), np.zeros((classes, types), np.float32)
    for at, x, y in zip(dictionary["local"], dictionary["c"], dictionary["prices"], strict=True):
        at = np.frombuffer(at, np.int32)
        c[at], prices[:, at] = np.frombuffer(x, np.int64), np.frombuffer(y, np.float32).reshape(-1, classes).T
    base = np.log10((c + 0.5) / (facts.tokens + 0.5 * (facts.distinct + 1)))
    return pd.concat([_score_block(blob, c > 0, base, prices, facts) for blob in texts])


def _score_block(blob: bytes, known: np.ndarray, base: np.ndarray, prices: np.ndarray, facts: Facts) -> pd.DataFrame:
    """Scores of a block's texts; the arrays are the chunk's, by word number."""
    rows = int(np.frombuffer(blob, np.int64, 1)[0])
    ids = np.frombuffer(blob, np.int64, rows, 16)
    learned = np.frombuffer(blob, np.int64, rows, 16 + 8 * rows) < len(facts.ends)
    first = np.frombuffer(blob, np.int64, rows + 1, 16 + 16 * rows)
    local = np.frombuffer(blob, np.int32, -1, 16 + 16 * rows + 8 * (rows + 1))
    length = np.diff(first)
    text = np.repeat(np.arange(rows), length)

    def total(per_token: np.ndarray) -> np.ndarray:
        return np.bincount(text, weights=per_token, minlength=rows)

    ends = facts.ends.sum()
    norm = facts.tokens + 0.5 * (facts.distinct + 1)
    some = np.flatnonzero(facts.ends) if ends else np.array([0])
    by_class = np.empty((len(some), rows))
    for row, k in enumerate(some):
        share = facts.ends[k] / ends if ends else 1.0
        by_class[row] = total(prices[k][local]) + facts.end_log_p(k) + np.log(share)
    top = by_class.max(axis=0)
    score = top + np.log(np.exp(by_class - top).sum(axis=0))
    return pd.DataFrame(
        {
            "row": ids,
            "learned": learned,
            "n_tokens": length + 1,
            "n_known": total(known[local]).astype(np.int64) + int(ends > 0),
            "base_score": total(base[local]) + np.log10((ends + 0.5) / norm),
            "score": score / np.log(10),
        }
    )
