"""Secret scans: patterns for known shapes, and a pair of character Markov models for the rest. DataFrame functions only.

Known shapes (`assign`, `access`, `hex`) are found by patterns, leftmost and not overlapping within a kind; their positions are sums
of the lengths of what lies between matches, so a text is never shuffled. Every other run of RUN characters is scored by two
first-order Markov models over characters, one of random strings and one of ordinary identifiers: the sum of the log-likelihood
ratios of its transitions, the first from the start. A run whose sum reaches MARGIN nats is a span of kind `markov`.

The models are counted from labelled samples (text, label, part): label 1 are random strings, label 0 ordinary identifiers. A label's
transition probability is the mean over its parts, each smoothed by SMOOTHING, so that a large part does not drown a small one; a part that
has seen the first character n times has the weight n / (n + SUPPORT).
`labelled_samples` gives random strings of RANDOM_FORMS written from sha256 digests (label 1), the names of a public API in NAME_FORMS (label
0, part names), and all words of the given texts outside of known shapes, with their counts (label 0, part words). The model is at most
67 * 66 ratios in thousandths of a nat, whatever the number of texts; it goes to the tasks as a constant. Sums of integers do not depend
on their order, so reruns agree.

A null text is an empty one: no spans. Rows are scanned one by one: repeated rows agree, null ids are kept, and equal starts are ordered
by kind as listed in KINDS. A text is scanned whole; a run of more than RUN_MOST characters is scored in pieces of RUN_MOST, of which a last
one of under RUN_LEAST is not scored. A run that overlaps a known shape is left out. Without texts the models know the names alone. An
empty table gives no rows. Carried columns that clash with those of the result are left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: In either case by classes, as A-Z and a-z alone are meant.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_LEAST = 6


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = rf"""(?:{"|".join(map(_either_case, KEYWORDS))})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run fails as a whole, so these lengths may stand in the patterns.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KNOWN = f"{ASSIGN}|{ACCESS}|{HEX}"

CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
START = "^"
RUN_LEAST, RUN_MOST = 16, 256
RUN = f"[A-Za-z0-9+/_-]{{{RUN_LEAST},{RUN_MOST}}}"
#: What every text with a run has, and what is found faster.
VISIBLE = f"[!-~]{{{RUN_LEAST}}}"
WORD = "[A-Za-z0-9+/_-]+"
WORD_LEAST, WORD_MOST = 2, 32
SMOOTHING = 0.5
SUPPORT = 50
MARGIN = 10.0
#: Digests of which random strings are made.
DIGESTS = 2000
#: Times that each of RULES counts as a name.
RULE_WEIGHT = 100
#: How many running sums are made by appending, before their blocks are summed.
BLOCK = 256



def public_names() -> list[str]:
    """Names of functions, methods and types of the DataFrame API: ordinary identifiers with underscores and inner capitals."""
    from pyspark.sql import types

    return sorted({n for where in (F, DataFrame, SparkSession, Column, types) for n in dir(where) if n[0] != "_" and len(n) >= WORD_LEAST})


def name_forms(name: Column) -> Column:
    """A name as it is, as a constant, with hyphens, and as the end of a path."""
    return F.array(name, F.upper(name), F.translate(name, "_", "-"), F.concat(F.lit("lib/python/site-packages/pyspark/sql/"), name))


def rules() -> list[str]:
    """Rows of one sign, the alphabet and the digits: no words, but no secrets either."""
    from string import ascii_lowercase, ascii_uppercase, digits

    return [*(c * WORD_MOST for c in "+/_-"), ascii_lowercase, ascii_uppercase, digits * 2]


def random_forms(number: Column) -> Column:
    """Random strings of a number's digest: hex, base 64 in both alphabets, and letters and digits in both cases or one."""
    digest = F.sha2(number.cast("string"), 256)
    coded = F.base64(F.unhex(digest))
    plain = F.translate(coded, "+/=", "")
    bare = F.translate(coded, "=", "")
    return F.array(F.substring(digest, 1, 40), F.upper(F.substring(digest, 1, 40)), bare, F.translate(bare, "+/", "-_"), plain, F.upper(plain), F.lower(plain))


def labelled_samples(spark: SparkSession, texts: Column, docs: DataFrame) -> DataFrame:
    """(text, label, part, n): random strings, public names, and the words of all texts with their counts."""
    random = spark.range(DIGESTS).select(F.explode(random_forms(F.col("id"))).alias("text"), F.lit(1).alias("label"), F.lit("random").alias("part"))
    named = spark.createDataFrame([(n,) for n in public_names()], "name string")
    names = named.select(F.explode(name_forms(F.col("name"))).alias("text"), F.lit(0).alias("label"), F.lit("names").alias("part"))
    ruled = spark.createDataFrame([(r, 0, "names", RULE_WEIGHT) for r in rules()], "text string, label int, part string, n long")
    plain = F.when(holds_known(texts), F.regexp_replace(texts, KNOWN, " ")).otherwise(texts)
    words = docs.select(F.explode(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))).alias("text"))
    counted = words.filter(F.length("text").between(WORD_LEAST, WORD_MOST)).groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    given = random.unionByName(names).withColumn("n", F.lit(1).cast("long"))
    return given.unionByName(ruled).unionByName(counted.select("text", F.lit(0).alias("label"), F.lit("words").alias("part"), "n"))


def train(samples: DataFrame) -> dict[str, int]:
    """Log-likelihood ratio of each transition (a pair of characters) in thousandths of a nat."""
    marked = F.concat(F.lit(START), "text")
    pairs = F.transform(F.sequence(F.lit(1), F.length("text")), lambda i: F.substring(marked, i, F.lit(2)))
    exploded = samples.filter(F.length("text") > 0).select("label", "part", "n", F.explode(pairs).alias("pair"))
    counted = exploded.groupBy("label", "part", "pair").agg(F.sum("n").alias("n"))
    # at most as many rows as there are labels, parts and pairs of CHARACTERS
    rows = counted.filter(F.col("pair").rlike(f"^[A-Za-z0-9+/_{START}-][A-Za-z0-9+/_-]$")).collect()
    counts: dict[tuple, dict[str, int]] = {}
    for r in rows:
        counts.setdefault((r["label"], r["part"]), {})[r["pair"]] = r["n"]

    def probability(label: int, before: str, pair: str) -> float:
        total = weights = 0.0
        for of, seen in parts[label]:
            weight = seen[before] / (seen[before] + SUPPORT)
            total += weight * (of.get(pair, 0) + SMOOTHING) / (seen[before] + SMOOTHING * len(CHARACTERS))
            weights += weight
        return total / weights if weights else 1 / len(CHARACTERS)

    parts: dict[int, list] = {0: [], 1: []}
    for label, part in sorted(counts):
        of = counts[label, part]
        parts[label].append((of, {a: sum(of.get(a + c, 0) for c in CHARACTERS) for a in START + CHARACTERS}))
    ratios = {}
    for a in START + CHARACTERS:
        for b in CHARACTERS:
            ratios[a + b] = round(1000 * math.log(probability(1, a, a + b) / probability(0, a, a + b)))
    return ratios


def holds_assign(text: Column) -> Column:
    """Whether a keyword's beginning is in a text in either case: true wherever ASSIGN matches, and found faster."""
    return let(F.lower(text), lambda low: reduce(or_, [low.contains(w.split("_?")[0]) for w in KEYWORDS]))


def holds_known(text: Column) -> Column:
    """Whether a text can hold known shapes: true wherever KNOWN matches."""
    return holds_assign(text) | text.contains("AKIA") | text.rlike(HEX)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(steps: Column) -> Column:
    """Sums of an array up to each of its elements, in blocks, so that long arrays do not take the square of their length."""

    def plain(x: Column) -> Column:
        return F.aggregate(x, F.array().cast("array<int>"), lambda so_far, v: F.concat(so_far, F.array(F.coalesce(F.get(so_far, F.size(so_far) - 1), F.lit(0)) + v)))

    def joined(blocks: Column) -> Column:
        return let(
            plain(F.transform(blocks, lambda b: F.element_at(b, -1))),
            lambda totals: F.flatten(F.transform(blocks, lambda b, i: F.transform(b, lambda v: v + F.coalesce(F.get(totals, i - 1), F.lit(0))))),
        )

    def blocks_of(x: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int"))
        return F.transform(starts, lambda b: plain(F.slice(x, b * BLOCK + 1, F.lit(BLOCK))))

    return let(steps, lambda x: F.when(F.size(x) == 0, F.array().cast("array<int>")).otherwise(let(blocks_of(x), joined)))


def spans(text: Column, may: Column, pattern: str, kind: str, group: int, keep: Callable[[Column], Column]) -> Column:
    """array of (start, kind's number, end) of a pattern's matches, in characters; `keep` decides by what a group has matched.

    `may` is a faster test that holds wherever the pattern matches.
    """

    def placed(found: Column) -> Column:
        lengths = F.transform(found, F.length)
        between = F.transform(F.split(text, pattern, -1), F.length)
        steps = F.zip_with(F.slice(between, 1, F.size(found)), lengths, lambda gap, own: gap + own)
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
        whole = F.transform(
            F.arrays_zip(running_sums(steps).alias("end"), lengths.alias("own"), values.alias("value")),
            lambda m: F.struct((m["end"] - m["own"]).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"), m["value"].alias("value")),
        )
        kept = F.filter(whole, lambda m: keep(m["value"]))
        return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))

    return F.when(may, let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(no_spans())


def no_spans() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int>>")


def score(run: Column, ratios: dict[str, int]) -> Column:
    """Sum of a run's ratios, from the start; a run holds CHARACTERS only."""
    table = [0] * (128 * 128)
    for pair, ratio in ratios.items():
        table[ord(pair[0]) * 128 + ord(pair[1])] = ratio
    constant = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")

    def step(so_far: Column, pair: Column) -> Column:
        return so_far + F.get(constant, F.ascii(pair) * 128 + F.ascii(F.substring(pair, 2, 1)))

    return let(F.concat(F.lit(START), run), lambda w: F.aggregate(F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substring(w, i, F.lit(2))), F.lit(0), step))


def counted(found: str, kind: str) -> Column:
    """How many spans of a column are of a kind."""
    return F.size(F.filter(found, lambda m: m["kind"] == KINDS.index(kind))).cast("long")


def as_text(found: Column) -> Column:
    """kind:start:end of spans in order of start and kind, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(found), lambda m: F.concat_ws(":", F.get(kinds, m["kind"]), m["start"].cast("string"), m["end"].cast("string"))), ",")


def scan(docs: DataFrame, ratios: dict[str, int], text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), margin: float = MARGIN) -> DataFrame:
    """Carried columns, the spans of known shapes (`known`) and those that the models add (`added`): arrays of (start, kind's number, end)."""
    own = [c for c in carry if c not in ("known", "added")]
    rows = docs.select(*own, F.coalesce(text_col, F.lit("")).alias("__text"))
    text = F.col("__text")
    known = F.concat(
        spans(text, holds_assign(text), ASSIGN, "assign", 1, lambda v: F.length(v) >= ASSIGN_LEAST),
        spans(text, text.contains("AKIA"), ACCESS, "access", 0, lambda v: F.lit(True)),
        spans(text, text.rlike(HEX), HEX, "hex", 0, lambda v: F.lit(True)),
    )
    runs = spans(text, text.rlike(VISIBLE), RUN, "markov", 0, lambda run: score(run, ratios) >= round(1000 * margin))
    both = rows.select(*own, known.alias("known"), runs.alias("__runs"))
    free = F.filter("__runs", lambda m: ~F.exists("known", lambda k: (k["start"] < m["end"]) & (m["start"] < k["end"])))
    return both.select(*own, "known", free.alias("added"))
