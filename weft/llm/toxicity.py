"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word (run of letters, A-Z lower-cased) is one of 2**VOCABULARY_BITS hashed embeddings. Filters of
WIDTHS words slide over the whole text, each filter's largest response is kept (max pooling), and a
logistic layer on these gives the score, calibrated on learning rows that the training has not seen.
Because a filter is linear before pooling, each word's product with each filter column is tabulated
once; scoring a text is table look-ups and a segmented maximum, with no limit on its length.

The network learns from the whole text of every labelled row that may be learned. Rows are dealt by hashes of their ids into
shards of some SHARD_ROWS rows and SHARD_WORDS words, as many as that takes. In each of EPOCHS rounds every shard goes on alone
from the shared network, batch by batch, and what the shards changed is averaged: an embedding over the shards that changed it, all
else over all shards. Sums are of integers, so the order in which tasks end changes nothing. The driver and a task hold one network
(2 MB with its gradients' squares) and no rows but a shard's. The first embedding dimension starts at the word's smoothed log odds
over all training rows, the others at random; all are trained by backpropagation. Every row is scored.

The scale of the score and the thresholds come from all calibration rows, by sums that Spark makes. Thresholds are calibrated by
language: per language with MIN_POSITIVE positive calibration rows, the threshold of the best F1 on them, else 0.5. They are
used for `flagged` only; the language is no input of the score.

Nulls, ties, repeats: a null text is an empty one and gets the score of a text without words. Rows are
scored one by one, so repeats agree. Labels that contradict each other count as toxic. Without labels
of both kinds every score is the share of toxic labels (0 without labels). Of rows that repeat a labelled id one text is
learned. An empty table gives no rows. Equal scores in the calibration are above or below a threshold together. Very long texts
are hashed and learned in windows. Carried columns whose names clash with the operator's are left out; others are not read.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm import bitmaps
from weft.llm.arrow import map_arrow
from weft.llm.sums import pack, summed, unpack
from weft.llm.textops import LOWER, U64, blocks, word_hashes
from weft.workspace import Workspace

VOCABULARY_BITS = 15
DIMENSIONS = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
SHARD_ROWS = 8000
SHARD_WORDS = 1 << 23
PIECE = 1 << 18
SEED = 7
EPOCHS = 12
BATCH = 64
RATE = 0.05
DECAY = 1e-4
MIN_POSITIVE = 20
PAD = 1 << VOCABULARY_BITS
UNIT = 1 << 32

NO_LETTER = np.ones(256, bool)
NO_LETTER[65:91] = NO_LETTER[97:123] = NO_LETTER[128:] = False


def fold(id_col: Column) -> Column:
    """crc32 of the id as text; a null id is the text null."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("null")))


def word_ids(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding numbers of a block's words, and each text's first word."""
    hashes, first = word_hashes(LOWER[data], at, NO_LETTER)
    return (hashes >> U64(64 - VOCABULARY_BITS)).astype(np.int32), first


def padded(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids with as many pads behind each text as the widest filter; where filters start; each text's first start."""
    wide = max(WIDTHS)
    count = np.diff(first)
    texts = len(count)
    out = np.full(len(ids) + wide * texts, PAD, np.int32)
    place = np.arange(len(ids)) + wide * np.repeat(np.arange(texts), count)
    out[place] = ids
    starts = np.sort(np.concatenate([place, (first[:-1] + wide * np.arange(texts))[count == 0]]))
    begins = np.concatenate([[0], np.cumsum(np.maximum(count, 1))])[:-1]
    return out, starts, begins


@dataclass
class Network:
    """Parameters; `rate` alone is used where nothing could be learned."""

    rate: float = 0.0
    embedding: np.ndarray | None = None
    filters: dict[int, np.ndarray] = field(default_factory=dict)
    bias: dict[int, np.ndarray] = field(default_factory=dict)
    out: np.ndarray | None = None
    offset: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)

    def tables(self) -> dict[int, list[np.ndarray]]:
        """For each width and place in the filter, the response to each word."""
        return {k: [self.embedding @ self.filters[k][o] for o in range(k)] for k in WIDTHS}

    def responses(self, ids, starts, tables, width):
        total = tables[width][0][ids[starts]]
        for o in range(1, width):
            total += tables[width][o][ids[starts + o]]
        total += self.bias[width]
        return total

    def logits(self, ids: np.ndarray, first: np.ndarray, tables) -> np.ndarray:
        ids, starts, begins = padded(ids, first)
        pooled = [np.maximum(np.maximum.reduceat(self.responses(ids, starts, tables, k), begins, axis=0), 0) for k in WIDTHS]
        return np.concatenate(pooled, axis=1) @ self.out + self.offset

    def scores(self, logits: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))


def count_words(texts: Iterable[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Two rows: in how many texts of label 0 and of label 1 each word is; the last column is the number of texts."""
    counts = np.zeros((2, PAD + 1), np.int64)
    for t, y in zip(texts, labels, strict=True):
        counts[y, np.unique(t)] += 1
        counts[y, PAD] += 1
    return counts


def _log_odds(counts: np.ndarray) -> np.ndarray:
    (no, yes), (without, toxic) = counts.astype(float), counts[:, PAD]
    odds = np.log((yes + 0.5) / (toxic + 1)) - np.log((no + 0.5) / (without + 1))
    odds *= (yes + no) / (yes + no + 5)
    odds[PAD] = 0
    return odds


@dataclass
class Past:
    """Adagrad's sums of squared gradients, laid out as the network's parameters."""

    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    offset: float = 1e-2


def begin(counts: np.ndarray, seed: int = SEED) -> tuple[Network, Past]:
    """The network before any step, from count_words of all training rows of both labels."""
    rng = np.random.default_rng(seed)
    net = Network()
    net.embedding = rng.normal(0, 0.05, (PAD + 1, DIMENSIONS)).astype(np.float32)
    net.embedding[:, 0] = _log_odds(counts) / 4
    net.embedding[PAD] = 0
    for k in WIDTHS:
        net.filters[k] = rng.normal(0, 0.2, (k, DIMENSIONS, FILTERS)).astype(np.float32)
        net.filters[k][:, 0, :] += 0.6 / k
        net.bias[k] = np.zeros(FILTERS, np.float32)
    net.out = np.full(len(WIDTHS) * FILTERS, 0.1, np.float32)
    net.offset = float(np.log(counts[1, PAD] / counts[0, PAD]))
    low = lambda x: np.full_like(x, 1e-2)
    past = Past(low(net.embedding), {k: low(net.filters[k]) for k in WIDTHS}, {k: low(net.bias[k]) for k in WIDTHS}, low(net.out))
    return net, past


def peaks(net: Network, ids: np.ndarray, starts: np.ndarray, begins: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text and filter of width k, the start of its first largest response, and that response."""
    ends = np.append(begins[1:], len(starts))
    best = np.zeros((len(begins), FILTERS), np.int64)
    top = np.full((len(begins), FILTERS), -np.inf, np.float32)
    for lo in range(0, len(starts), PIECE):
        own = starts[lo : lo + PIECE]
        vectors = sum(net.embedding[ids[own + o]] @ net.filters[k][o] for o in range(k)) + net.bias[k]
        for t in range(np.searchsorted(begins, lo, "right") - 1, np.searchsorted(begins, lo + len(own))):
            first = max(begins[t] - lo, 0)
            part = vectors[first : min(ends[t] - lo, len(own))]
            at = part.argmax(axis=0)
            value = part[at, np.arange(FILTERS)]
            better = value > top[t]
            best[t, better] = lo + first + at[better]
            top[t, better] = value[better]
    return starts[best], top


def epoch(net: Network, past: Past, texts: list[np.ndarray], labels: np.ndarray, order: np.ndarray) -> None:
    """One pass over the texts in the given order, in batches, changing net and past."""

    def step(now: float | np.ndarray, sums: float | np.ndarray, grad: float | np.ndarray) -> tuple:
        sums = sums + grad * grad
        return now - RATE * grad / np.sqrt(sums), sums

    for lo in range(0, len(order), BATCH):
        chosen = order[lo : lo + BATCH]
        first = np.concatenate([[0], np.cumsum([len(texts[i]) for i in chosen])])
        ids, starts, begins = padded(np.concatenate([texts[i] for i in chosen]), first)
        found = {k: peaks(net, ids, starts, begins, k) for k in WIDTHS}
        hidden = np.concatenate([np.maximum(found[k][1], 0) for k in WIDTHS], axis=1)
        p = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.offset, -30, 30)))
        wrong = ((p - labels[chosen]) / len(chosen)).astype(np.float32)
        back = wrong[:, None] * net.out * (hidden > 0)
        rows, grads = [], []
        for n, k in enumerate(WIDTHS):
            g = back[:, n * FILTERS : (n + 1) * FILTERS]
            grad_w = np.empty_like(net.filters[k])
            for o in range(k):
                at = ids[found[k][0] + o]
                vectors = net.embedding[at]
                grad_w[o] = np.einsum("bfd,bf->df", vectors, g)
                rows.append(at.reshape(-1))
                grads.append((g[:, :, None] * net.filters[k][o].T[None]).reshape(-1, DIMENSIONS))
            net.filters[k], past.filters[k] = step(net.filters[k], past.filters[k], grad_w + DECAY * net.filters[k])
            net.bias[k], past.bias[k] = step(net.bias[k], past.bias[k], g.sum(axis=0))
        net.out, past.out = step(net.out, past.out, hidden.T @ wrong + DECAY * net.out)
        net.offset, past.offset = map(float, step(net.offset, past.offset, float(wrong.sum())))
        rows, spot = np.unique(np.concatenate(rows), return_inverse=True)
        grad = np.zeros((len(rows), DIMENSIONS), np.float32)
        np.add.at(grad, spot, np.concatenate(grads))
        grad[rows == PAD] = 0
        past.embedding[rows] += grad * grad
        net.embedding[rows] -= RATE * grad / np.sqrt(past.embedding[rows])


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = SEED) -> Network:
    """Learn from word-id arrays and 0/1 labels with Adagrad: what `learn` does with the rows of one shard."""
    if not len(labels) or labels.min() == labels.max():
        return Network(rate=float(labels.mean()) if len(labels) else 0.0)
    net, past = begin(count_words(texts, labels), seed)
    for number in range(EPOCHS):
        epoch(net, past, texts, labels, np.random.default_rng((seed, 0, number)).permutation(len(labels)))
    return net


def _dense(x: Network | Past) -> np.ndarray:
    """What every shard changes, in one row of doubles."""
    return np.concatenate([*[x.filters[k].ravel() for k in WIDTHS], *[x.bias[k] for k in WIDTHS], x.out, [x.offset]]).astype(float)


def _set_dense(x: Network | Past, row: np.ndarray) -> None:
    def take(like: np.ndarray) -> np.ndarray:
        nonlocal row
        now, row = row[: like.size].reshape(like.shape).astype(np.float32), row[like.size :]
        return now

    for held in (x.filters, x.bias):
        for k in WIDTHS:
            held[k] = take(held[k])
    x.out, x.offset = take(x.out), float(row[0])


def changes(before: tuple[Network, Past], after: tuple[Network, Past]) -> list[np.ndarray]:
    """What a shard changed, as integers of 1 / UNIT: embeddings, their sums of squares, which of them, and all else with a 1."""
    fixed = lambda x: np.rint(x * UNIT).astype(np.int64)
    words, squares = (b.embedding.astype(float) - a.embedding for a, b in zip(before, after, strict=True))
    rest = [_dense(b) - _dense(a) for a, b in zip(before, after, strict=True)]
    return [fixed(words), fixed(squares), ((words != 0) | (squares != 0)).any(axis=1).astype(np.int64), fixed(np.concatenate([*rest, [1.0]]))]


def average(net: Network, past: Past, sums: list[np.ndarray]) -> None:
    """Add the mean of the shards' changes, of which `sums` are the sums."""
    for x, total in zip((net, past), sums[:2], strict=True):
        mean = total.reshape(x.embedding.shape) / UNIT / np.maximum(sums[2], 1)[:, None]
        x.embedding = (x.embedding + mean).astype(np.float32)
    *rest, shards = sums[3] / UNIT
    for x, mean in zip((net, past), np.split(np.array(rest) / shards, 2), strict=True):
        _set_dense(x, _dense(x) + mean)


def newton(moments: Callable[[float, float], np.ndarray]) -> tuple[float, float]:
    """Scale and offset of the logistic fit, with a ridge on the scale.

    moments(a, b) are the sums over rows of (p - y) * x, p - y, w * x * x, w * x and w, where p is the score of a * x + b and w its slope.
    """
    a, b = 1.0, 0.0
    for _ in range(50):
        gx, g, wxx, wx, w = moments(a, b)
        d = np.linalg.solve(np.array([[wxx + 1, wx], [wx, w]]), np.array([gx + (a - 1), g]))
        a, b = float(a - d[0]), float(b - d[1])
        if np.abs(d).max() < 1e-9:
            break
    return a, b


def calibrate(net: Network, texts: list[np.ndarray], labels: np.ndarray, languages: list[str | None]) -> None:
    """Fit the logistic scale of the score, and thresholds by language, on rows outside the training: `calibrate_rows` for lists."""
    if net.embedding is None or not len(labels) or labels.min() == labels.max():
        return
    tables = net.tables()
    x = np.concatenate([net.logits(t, np.array([0, len(t)]), tables) for t in texts])

    def moments(a: float, b: float) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(a * x.astype(float) + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        return np.array([((p - labels) * x).sum(), (p - labels).sum(), (w * x * x).sum(), (w * x).sum(), w.sum()])

    net.scale = newton(moments)
    scores = net.scores(x)
    for language in sorted({x for x in languages if x is not None}):
        own = np.array([x == language for x in languages])
        if labels[own].sum() >= MIN_POSITIVE:
            order = np.argsort(-scores[own], kind="stable")
            hits = np.cumsum(labels[own][order])
            f1 = 2 * hits / (np.arange(1, len(hits) + 1) + labels[own].sum())
            ranked = scores[own][order]
            f1[:-1][ranked[1:] == ranked[:-1]] = -1  # equal scores are flagged together
            net.thresholds[language] = float(ranked[f1.argmax()])


def calibrate_rows(net: Network, rows: DataFrame, workspace: Workspace) -> None:
    """Fit the scale and the thresholds on all rows (lang, toxic, x) of a written table; x is the network's logit, a float.

    No language has to fit into one task: scores are dealt by range, and the counts above a part are sums of parts.
    """
    kinds = rows.agg(F.count_distinct("toxic")).first()[0]
    if net.embedding is None or kinds < 2:
        return
    x, y = F.col("x").cast("double"), F.col("toxic")

    def moments(a: float, b: float) -> np.ndarray:
        p = 1 / (1 + F.exp(-F.greatest(F.least(a * x + b, F.lit(30.0)), F.lit(-30.0))))
        w = p * (1 - p) + 1e-6
        terms = ((p - y) * x, p - y, w * x * x, w * x, w)
        # decimals add up to the same sum in any order
        return np.array([float(v) for v in rows.agg(*[F.sum(t.cast("decimal(28,12)")) for t in terms]).first()])

    net.scale = newton(moments)
    scaled = Network(scale=net.scale)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = scaled.scores(batch.column(2).to_numpy()).astype(float)
            yield pa.record_batch([*batch.columns[:2], pa.array(own)], names=["lang", "toxic", "score"])

    scored = rows.where("lang IS NOT NULL").select("lang", "toxic", "x").transform(map_arrow, scores, "lang string, toxic int, score double")
    steps = scored.groupBy("lang", "score").agg(F.count("*").alias("n"), F.sum("toxic").alias("hits"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = steps.repartitionByRange(parts, "lang", F.col("score").desc()).withColumn("part", F.spark_partition_id())
    dealt = workspace.save(dealt, "calibration-parts")
    whole = Window.partitionBy("of")
    above = whole.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(F.col("lang").alias("of"), F.col("part").alias("at")).agg(F.sum("n").alias("pn"), F.sum("hits").alias("ph")).select(
        "of", "at", F.sum("ph").over(whole).alias("positive"),
        F.coalesce(F.sum("pn").over(above), F.lit(0)).alias("n0"), F.coalesce(F.sum("ph").over(above), F.lit(0)).alias("h0"),
    ).where(F.col("positive") >= MIN_POSITIVE)
    down = Window.partitionBy("lang", "part").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    run = dealt.select("lang", "part", "score", F.sum("n").over(down).alias("n"), F.sum("hits").over(down).alias("hits"))
    joined = run.join(sizes, (F.col("lang") == F.col("of")) & (F.col("part") == F.col("at")))
    f1 = 2 * (F.col("h0") + F.col("hits")) / (F.col("n0") + F.col("n") + F.col("positive"))
    for language, best in joined.groupBy("lang").agg(F.max(F.struct(f1.alias("f1"), "score")).alias("best")).orderBy("lang").collect():
        net.thresholds[language] = best.score
    workspace.drop("calibration-parts")


def _word_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, lang, pick, text) with the text as embedding numbers."""
    for batch in batches:
        out = []
        for lo, hi, data, at in blocks(batch.column(3)):
            ids, first = word_ids(data, at)
            out += [ids[first[i] : first[i + 1]].astype(np.uint16).tobytes() for i in range(hi - lo)]
        yield pa.record_batch([*batch.columns[:3], pa.array(out, pa.binary())], names=["id", "lang", "pick", "words"])


def _pack_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, toxic, words) in the order of shards to one row for each shard: labels, lengths and all words as bytes."""
    shard, labels, texts = None, [], []

    def row() -> pa.RecordBatch:
        lengths = np.array([len(t) // 2 for t in texts], np.int64).tobytes()
        values = [pa.array([shard], pa.int32()), *[pa.array([v], pa.binary()) for v in (np.array(labels, np.uint8).tobytes(), lengths, b"".join(texts))]]
        return pa.record_batch(values, names=["shard", "toxic", "lengths", "words"])

    for batch in batches:
        for own, toxic, words in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if own != shard and texts:
                yield row()
                labels, texts = [], []
            shard = own
            labels.append(toxic)
            texts.append(words)
    if texts:
        yield row()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """(shard, texts, labels) of packed rows."""
    for batch in batches:
        for i in range(batch.num_rows):
            labels, lengths, words = (np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in ((1, np.uint8), (2, np.int64), (3, np.uint16)))
            yield batch.column(0)[i].as_py(), np.split(words, np.cumsum(lengths)[:-1]), labels.astype(np.int64)


def _over_shards(shards: DataFrame, run: Callable[[int, list[np.ndarray], np.ndarray], list[np.ndarray]]) -> list[np.ndarray]:
    """Sums over all shards of the integer arrays that `run` makes of (shard, texts, labels)."""

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _shards(batches):
            made = run(*own)
            yield pa.record_batch([pa.array(range(len(made)), pa.int32()), pa.array([pack(x) for x in made], pa.binary())], names=["key", "values"])

    found = summed(shards.transform(map_arrow, arrays, "key int, values binary"), np.int64).collect()
    return [unpack(r[1], np.int64) for r in sorted(found, key=lambda r: r[0])]


def fitting(sizes: list[tuple], most: int) -> list:
    """Ids of the texts that fit together into `most`, in their order: each one that still fits into what the ones before it have left.

    For callers that want a small trial set; `learn` takes every labelled row.
    """
    out = []
    for key, size in sizes:
        if size <= most:
            out.append(key)
            most -= size
    return out


def labelled_words(docs: DataFrame, labels: DataFrame, learnable: Column, workspace: Workspace) -> DataFrame:
    """Written rows (id, toxic 0 or 1, lang, words) of all labelled ids that may be learned and have a text, one text of each."""
    kind = docs.schema["doc_id"].dataType
    known = labels.where(learnable & F.col("toxic").isNotNull()).select(F.col("doc_id").try_cast(kind).alias("__id"), "toxic")
    toxic = F.least(F.greatest(F.max("toxic"), F.lit(0)), F.lit(1)).cast("int")
    known = workspace.save(known.where("__id IS NOT NULL").groupBy("__id").agg(toxic.alias("toxic")), "labelled")
    bits = bitmaps.of_keys(known.select("__id"), workspace, "labelled-bits")
    texts = docs.select(F.col("doc_id").alias("id"), "lang", F.xxhash64("text", "lang").alias("pick"), "text")
    texts = bitmaps.flag(texts, bits.rows, bits.slot(F.col("id")), "__known").where("__known").select("id", "lang", "pick", "text")
    texts = texts.transform(map_arrow, _word_arrays, f"id {kind.simpleString()}, lang string, pick long, words binary")
    one = Window.partitionBy("id").orderBy("pick", "lang")
    texts = texts.withColumn("__nth", F.row_number().over(one)).where("__nth = 1")
    return workspace.save(texts.join(known.hint("merge"), F.col("id") == F.col("__id")).select("id", "toxic", "lang", "words"), "words")


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, workspace: Workspace | None = None) -> Network:
    """Train on all labelled rows: those of hash 0 mod 4 calibrate, the others train. labels: doc_id, toxic."""
    workspace = workspace or Workspace(docs.sparkSession, "toxicity")
    rows = labelled_words(docs, labels, learnable, workspace)
    rest = F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(4)) == 0
    count, toxic, words = rows.where(~rest).agg(F.count("*"), F.sum("toxic"), F.sum(F.octet_length("words") / 2)).first()
    if not count or toxic in (0, count):
        return Network(rate=toxic / count if count else 0.0)
    n = max(1, math.ceil(count / SHARD_ROWS), math.ceil(words / SHARD_WORDS))
    dealt = rows.where(~rest).withColumn("__at", F.xxhash64(F.col("id"), F.lit(2))).withColumn("shard", F.pmod("__at", F.lit(n)).cast("int"))
    dealt = dealt.repartitionById(n, F.col("shard")).sortWithinPartitions("shard", "__at", "id").select("shard", "toxic", "words")
    packed = dealt.transform(map_arrow, _pack_shards, "shard int, toxic binary, lengths binary, words binary")
    shards = workspace.save(packed, "shards", maxRecordsPerFile=1)

    counts = _over_shards(shards, lambda _, texts, labels: [count_words(texts, labels).ravel()])[0]
    net, past = begin(counts.reshape(2, PAD + 1))
    for number in range(EPOCHS):
        shared = docs.sparkSession.sparkContext.broadcast((net, past))

        def run(shard: int, texts: list[np.ndarray], labels: np.ndarray, shared=shared, number=number) -> list[np.ndarray]:
            after = copy.deepcopy(shared.value)
            epoch(*after, texts, labels, np.random.default_rng((SEED, shard, number)).permutation(len(labels)))
            return changes(shared.value, after)

        average(net, past, _over_shards(shards, run))
        shared.destroy()

    shared = docs.sparkSession.sparkContext.broadcast((net, net.tables()))

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, tables = shared.value
        for batch in batches:
            texts = [np.frombuffer(v.as_buffer(), np.uint16) for v in batch.column(2)]
            x = [net.logits(t, np.array([0, len(t)]), tables) for t in texts]
            yield pa.record_batch([*batch.columns[:2], pa.array(np.concatenate([*x, []]).astype(np.float32))], names=["lang", "toxic", "x"])

    held = rows.where(rest).select("lang", "toxic", "words").transform(map_arrow, logits, "lang string, toxic int, x float")
    calibrate_rows(net, workspace.save(held, "calibration"), workspace)
    shared.destroy()
    for name in ("labelled", "labelled-bits", "words", "shards", "calibration"):
        workspace.drop(name)
    return net


def score(docs: DataFrame, net: Network, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, carried columns, score, threshold of the language and flagged, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast((net, net.tables() if net.embedding is not None else None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, tables = shared.value
        for batch in batches:
            scores = np.full(batch.num_rows, net.rate)
            if tables is not None:
                for lo, hi, data, at in blocks(batch.column(2), 1 << 19):
                    scores[lo:hi] = net.scores(net.logits(*word_ids(data, at), tables))
            limit = np.array([net.thresholds.get(x, 0.5) for x in batch.column(1).to_pylist()])
            yield pa.record_batch(
                [batch.column(0), *batch.columns[3:], pa.array(scores), pa.array(limit, pa.float64()), pa.array(scores >= limit)],
                names=["doc_id", *carry, "score", "threshold", "flagged"],
            )

    carry = tuple(c for c in carry if c not in ("doc_id", "score", "threshold", "flagged"))
    slim = docs.select("doc_id", "lang", "text", *[F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)])
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return slim.transform(map_arrow, run, f"doc_id {kind}, {kinds + ', ' if kinds else ''}score double, threshold double, flagged boolean")
