"""Language identification by Bayesian fusion of text, declared markup language, address suffix and host.

Text likelihood: a naive Bayes model over hashed byte trigrams, one table of log probabilities per
language, fitted on a bounded sample (of each language the FIT_ROWS labelled rows with the smallest hashes, whole
texts). Every language that any row is labelled with is in the model, which takes 256 KB for each.
Every text is scored whole; its log likelihoods are divided by the square root of its length, since
trigrams that overlap are not independent evidence.

Other evidence of a row (each may be missing): a declared language, a suffix of the address and a host.
What they are worth is learned from the table itself by grouped aggregations of the text's posterior:

- declared: P(declared | language), from how often each declaration meets each language;
- suffix and host: a hierarchy of language shares, each level smoothed by the one above,
  (mass + SMOOTHING * share above) / (n + SMOOTHING), from all rows to the suffix to the host.

The posterior is the softmax of the sum of logs. A row's language is the largest one; a row is rejected
if its text has no letters or the posterior stays under MIN_POSTERIOR.

The aggregations combine on the map side and are one row per host, suffix or declaration; a host with a
third of all rows is one group of them, and its rows join a written table, so a skewed join can be split.

Nulls, ties, repeats: null evidence counts as none (its own group is not built). A null or empty text
has equal likelihoods and is rejected. Equal posteriors go to the language first in code-point order.
Without labelled rows every row is rejected with a null language. An empty table gives no rows. Repeated rows
are answered alike. Very long texts are read in windows. Of the input only the key columns are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.arrow import map_arrow
from weft.llm.sums import pack, summed, unpack
from weft.llm.textops import LOWER, U64, blocks, mix
from weft.workspace import Workspace

TABLE_BITS = 16
FIT_ROWS = 2000
BROADCAST_IDS = 200_000
SMOOTHING = 5.0
MIN_POSTERIOR = 0.5


def trigram_slots(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Table slots of the byte trigrams that start at each byte; behind the ends of texts lie separators."""
    x = LOWER[data].astype(np.uint32)
    x[(x < 0x41)] = 0x20  # white space, digits and punctuation are one separator
    y = np.append(x, [0x20, 0x20]).astype(np.uint32)
    second, third = y[1:-1].copy(), y[2:].copy()
    ends = ends[ends > 0]
    second[ends - 1] = third[ends - 1] = 0x20
    third[ends[ends > 1] - 2] = 0x20
    code = y[:-2] | (second << np.uint32(8)) | (third << np.uint32(16))
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - TABLE_BITS)).astype(np.int64)


def _slot_windows(data: np.ndarray, at: np.ndarray, size: int = 1 << 19) -> Iterator[np.ndarray]:
    """trigram_slots in windows: what is needed at once does not grow with a text."""
    for lo in range(0, len(data), size):
        part = data[lo : lo + size + 2]
        ends = at[(at > lo) & (at <= lo + len(part))] - lo
        yield trigram_slots(part, ends)[: min(size, len(data) - lo)]


@dataclass
class TextModel:
    """Languages and, for each, the log probability of each slot."""

    languages: list[str]
    table: np.ndarray

    def log_likelihoods(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """One row per text: log likelihood by language over the square root of the length."""
        n = np.diff(at)
        if not len(self.languages):
            return np.zeros((len(n), 0))
        out = np.zeros((len(n), len(self.languages)))
        edge, done = np.flatnonzero(n), 0
        for slots in _slot_windows(data, at):  # a text may lie in several windows
            own = edge[(at[edge] < done + len(slots)) & (at[edge + 1] > done)]
            begin = np.maximum(at[own], done) - done
            for k, row in enumerate(self.table):
                out[own, k] += np.add.reduceat(row[slots], begin, dtype=np.float64)
            done += len(slots)
        return out / np.sqrt(np.maximum(n, 1))[:, None]


def fit(docs: DataFrame, language_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", rows: int = FIT_ROWS) -> TextModel:
    """Fit the trigram tables on a bounded sample of labelled rows of each language; counts are summed on the executors."""
    labelled = docs.where(F.col(language_col).isNotNull() & F.col(id_col).isNotNull())
    named = labelled.select(F.col(id_col).alias("__id"), F.col(language_col).cast("string").alias("__language"))
    # Of each language the rows of the first ranges of hashes that hold enough, and of these the first ones.
    hashed = named.withColumn("__hash", F.xxhash64("__id")).withColumn("__range", F.shiftright("__hash", 52))
    ranges = hashed.groupBy("__language", "__range").agg(F.count(F.lit(1)).alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy("__language").orderBy("__range"))
    needed = ranges.withColumn("__before", upto - F.col("__n")).where(F.col("__before") < rows).select("__language", "__range")
    first = F.row_number().over(Window.partitionBy("__language").orderBy("__hash", "__id"))
    named = hashed.join(needed, ["__language", "__range"]).withColumn("__n", first).where(F.col("__n") <= rows).select("__id", "__language")
    named = named.distinct()
    if named.count() <= BROADCAST_IDS:
        named = F.broadcast(named)
    sample = labelled.join(named, (F.col(id_col) == F.col("__id")) & (F.col(language_col).cast("string") == F.col("__language")), "left_semi")
    sample = sample.select(F.col(language_col).cast("string").alias("language"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            for lo, hi, data, at in blocks(batch.column(1)):
                for i in range(hi - lo):
                    own = sums.setdefault(names[lo + i], np.zeros(1 << TABLE_BITS, np.int64))
                    for slots in _slot_windows(data[at[i] : at[i + 1]], at[i : i + 2] - at[i]):
                        own += np.bincount(slots, minlength=1 << TABLE_BITS)
        for language, counts in sums.items():
            yield pa.record_batch([pa.array([language]), pa.array([pack(counts)], pa.binary())], names=["key", "values"])

    found = summed(sample.transform(map_arrow, count, "key string, values binary"), np.int64).toLocalIterator()
    rows_of = {row["key"]: unpack(row["values"], np.int64) + 0.5 for row in found}
    languages = sorted(rows_of)
    table = np.zeros((len(languages), 1 << TABLE_BITS), np.float32)
    for k, name in enumerate(languages):
        table[k] = np.log(rows_of[name] / rows_of[name].sum())
    return TextModel(languages, table)


def _text_evidence(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            logs, letters = [], []
            for lo, hi, data, at in blocks(batch.column(0), 1 << 19):
                logs.append(model.log_likelihoods(data, at))
                alpha = ((data >= 65) & (data < 91)) | ((data >= 97) & (data < 123)) | (data >= 128)
                sums = np.concatenate([[0], np.cumsum(alpha)])
                letters.append(sums[at[1:]] > sums[at[:-1]])
            rows = np.concatenate(logs) if logs else np.zeros((0, len(model.languages)))
            flat = pa.ListArray.from_arrays(
                pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.reshape(-1))
            )
            yield pa.record_batch(
                [*batch.columns[1:], flat, pa.array(np.concatenate(letters) if letters else np.zeros(0, bool))],
                names=[*names, "logs", "letters"],
            )

    return run


def softmax(logs: Column) -> Column:
    """Probabilities of an array of logs."""
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def _mass(n_languages: int) -> list[Column]:
    return [F.sum(F.get("p", F.lit(k))).alias(f"m{k}") for k in range(n_languages)]


def identify(
    rows: DataFrame,
    model: TextModel,
    workspace: Workspace,
    *,
    key_cols: tuple[str, ...],
    text_col: str,
    declared: Column | None = None,
    suffix: Column | None = None,
    host: Column | None = None,
) -> DataFrame:
    """key columns with language, posterior, text_language, declared, suffix, host, rejected; one row per input row."""
    none = F.lit(None).cast("string")
    size = len(model.languages)
    names = [*key_cols, "declared", "suffix", "host"]
    shared = rows.sparkSession.sparkContext.broadcast(model)
    slim = rows.select(
        F.col(text_col).alias("__text"),
        *[F.col(c) for c in key_cols],
        *[(none if c is None else c.cast("string")).alias(n) for c, n in ((declared, "declared"), (suffix, "suffix"), (host, "host"))],
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[1:])
    scored = workspace.save(slim.transform(map_arrow, _text_evidence(shared, names), f"{kinds}, logs array<double>, letters boolean"), "text")
    languages = F.array(*[F.lit(x) for x in model.languages]) if size else F.array().cast("array<string>")
    if not size:
        return scored.select(
            *key_cols, none.alias("language"), F.lit(0.0).alias("posterior"), none.alias("text_language"),
            "declared", "suffix", "host", F.lit(True).alias("rejected"),
        )
    usable = scored.where("letters").withColumn("p", softmax(F.col("logs")))
    total = usable.agg(*_mass(size), F.count(F.lit(1)).alias("n")).first()
    all_n = float(total["n"])
    everyone = [((total[f"m{k}"] or 0.0) + 1.0) / (all_n + size) for k in range(size)]

    def shares(level: DataFrame, above: list[Column]) -> Column:
        return F.array(*[(F.col(f"m{k}") + SMOOTHING * a) / (F.col("n") + SMOOTHING) for k, a in enumerate(above)])

    counted = usable.where("suffix IS NOT NULL OR host IS NOT NULL").groupBy("suffix", "host").agg(*_mass(size), F.count(F.lit(1)).alias("n"))
    hosts = workspace.save(counted, "hosts")
    by_suffix = hosts.where("suffix IS NOT NULL").groupBy("suffix").agg(*[F.sum(f"m{k}").alias(f"m{k}") for k in range(size)], F.sum("n").alias("n"))
    by_suffix = by_suffix.select(F.col("suffix").alias("s_"), shares(by_suffix, [F.lit(x) for x in everyone]).alias("of_suffix"))
    fallback = F.array(*[F.lit(x) for x in everyone])
    priors = hosts.join(by_suffix, hosts["suffix"] == by_suffix["s_"], "left").withColumn("above", F.coalesce("of_suffix", fallback))
    above = [F.get("above", F.lit(k)) for k in range(size)]
    priors = priors.select(
        F.coalesce("suffix", F.lit("")).alias("__s"), F.coalesce("host", F.lit("")).alias("__h"),
        F.when(F.col("host").isNotNull(), shares(priors, above)).otherwise(F.col("above")).alias("prior"),
    )
    priors = workspace.save(priors, "priors")
    declarations = usable.where("declared IS NOT NULL").groupBy("declared").agg(*_mass(size), F.count(F.lit(1)).alias("n"))
    # P(declared | language), smoothed by the declaration's share of all rows.
    worth = F.array(
        *[F.log((F.col(f"m{k}") + SMOOTHING * F.col("n") / F.lit(max(all_n, 1.0))) / F.lit((total[f"m{k}"] or 0.0) + SMOOTHING)) for k in range(size)]
    )
    declarations = workspace.save(declarations.select(F.col("declared").alias("__d"), worth.alias("worth")), "declared")
    joined = (
        scored.withColumns({"s": F.coalesce("suffix", F.lit("")), "h": F.coalesce("host", F.lit(""))})
        .join(priors, (F.col("s") == F.col("__s")) & (F.col("h") == F.col("__h")), "left")
        .join(declarations, F.col("declared") == F.col("__d"), "left")
    )
    nothing = F.array_repeat(F.lit(0.0), size)
    prior = F.transform(F.coalesce("prior", fallback), lambda x: F.log(x))
    evidence = F.zip_with(F.zip_with("logs", prior, lambda a, b: a + b), F.coalesce("worth", nothing), lambda a, b: a + b)
    done = joined.withColumn("posteriors", softmax(evidence)).withColumn("posterior", F.array_max("posteriors"))
    name = lambda array: F.get(languages, (F.array_position(array, F.array_max(array)) - 1).cast("int"))
    return done.select(
        *key_cols,
        name(F.col("posteriors")).alias("language"),
        "posterior",
        name(F.col("logs")).alias("text_language"),
        "declared",
        "suffix",
        "host",
        (~F.col("letters") | (F.col("posterior") < MIN_POSTERIOR)).alias("rejected"),
    )
