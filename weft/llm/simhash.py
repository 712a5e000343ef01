"""Document fingerprints: SimHash in DataFrame operations only, and tables of blocks to search them.

A text's terms are its words (runs without white space). Each term's hash of BITS bits votes on every bit,
for it where the hash has a 1 and against it where it has a 0, with the term's weight: the square of its
length in bytes, at most MAX_WEIGHT, so that long words, which are rare ones, say more than short ones.
A bit is set if the votes for it are a majority.

Votes are sums of exploded words, grouped by document and combined on the map side. Two counters of 32
bits share each sum, so a fingerprint needs BITS / 2 sums; texts of more than LANE_BYTES, whose votes might
not fit, get a sum of 64 bits for each bit (`wide`).

Search: with r the radius, fingerprints are cut into blocks, more than r / 3 of them and of 32 bits at most, so
two fingerprints within r bits of each other have a block in which they differ by 2 bits at most.

- *All pairs* (within_radius). Each distinct value of a block is listed under itself and under all values one bit
  away; values that share a key are at most 2 bits apart, and a key's list is a bit mask of the bits turned, so no
  list is long. The pairs of values, equal ones included, are then joined with their fingerprints.
- *Queries against all* (neighbours). Each query's block values, turned in 0, 1 or 2 bits, are looked up among the
  block values of all fingerprints. A bitmap with a bit for every possible value (INDEX_BITS bits a block at most, of
  fixed size, so it is broadcast) drops most of them before they are shuffled.

A pair of fingerprints counts at the first block that finds it. So every pair within the radius is found once. Only
distinct fingerprints are searched; copies are counted, not paired.

RADIUS is chosen from the distances of different texts whose five-word shingles have a Jaccard index of 0.8 or
more: on documents of sf0.1 36 of 40 such pairs are within 14 bits, 34 within 13, and 3 within 3.

Nulls, ties, repeats: a null text is an empty one; an empty text's fingerprint is all zeros. Equal texts
have equal fingerprints. A document is an id and a text: rows that repeat both are one document, returned as often
as it occurs; rows that repeat an id with another text are documents of their own, ordered by a hash of the text.
Null ids are kept and come last in the order. The document after the last is the first one. An empty table gives no
rows. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.llm import bitmaps
from weft.workspace import Workspace

BITS = 128
MAX_WEIGHT = 64
WHITE = r"[\x20\x09-\x0D]+"
LANES = (1 << 32) | 1
RADIUS = 14
#: A word of b bytes takes b + 1 bytes and weighs min(b * b, MAX_WEIGHT), so up to here votes stay below 2**32.
LANE_BYTES = 1 << 29
#: Blocks of so many bits at most are looked up through a bitmap of all their values.
INDEX_BITS = 26
#: What identifies a document: whether it has an id, the id, a hash of its text.
ROW = ("no_id", "id", "hash")


def rows_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ROW and text, for each row of docs."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))


def fingerprints(texts: DataFrame, key: list[str], text_col: str, wide: bool = False) -> DataFrame:
    """key columns with w0 .. w{BITS // 64 - 1}, the words of the fingerprint as longs."""
    word = texts.select(*key, F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), WHITE)).alias("__word"))
    size = F.octet_length("__word")
    weight = F.least(size * size, F.lit(MAX_WEIGHT)).cast("long")
    hashed = word.select(*key, weight.alias("__w"), *[F.xxhash64(F.col("__word"), F.lit(i)).alias(f"__h{i}") for i in range(BITS // 64)])
    lanes = F.lit(1 if wide else LANES)
    votes = [
        F.sum(F.shiftrightunsigned(F.col(f"__h{i}"), j).bitwiseAND(lanes) * F.col("__w")).alias(f"__v{i}_{j}")
        for i in range(BITS // 64)
        for j in range(64 if wide else 32)
    ]
    summed = hashed.groupBy(*key).agg(F.sum("__w").alias("__total"), *votes)

    def count(i: int, j: int) -> Column:
        if wide:
            return F.col(f"__v{i}_{j}")
        lane = F.col(f"__v{i}_{j % 32}")
        return F.shiftrightunsigned(lane, 32) if j >= 32 else lane.bitwiseAND(F.lit(0xFFFFFFFF))

    words = []
    for i in range(BITS // 64):
        word = F.lit(0).cast("long")
        for j in range(64):
            set_bit = F.lit(1 << j if j < 63 else -(1 << 63))
            word = word.bitwiseOR(F.when(2 * count(i, j) > F.col("__total"), set_bit).otherwise(F.lit(0)).cast("long"))
        words.append(word.alias(f"w{i}"))
    return summed.select(*key, *words)


def as_hex(prefix: str = "w") -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(F.col(f"{prefix}{i}")), 16, "0") for i in range(BITS // 64)]))


def distance(a: str, b: str) -> Column:
    """Differing bits of the fingerprints in columns a0.., b0.."""
    parts = [F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in range(BITS // 64)]
    return sum(parts[1:], parts[0])


def likeness(a: str, b: str) -> Column:
    return F.lit(1.0) - distance(a, b) / F.lit(float(BITS))


def _block(number: int, blocks: int, words: list[Column]) -> tuple[Column, int]:
    """A block of the fingerprint in two words, the high one first, as a long, and how many bits it has."""
    low, high = BITS * number // blocks, BITS * (number + 1) // blocks
    if low >= 64:
        value = F.shiftrightunsigned(words[0], low - 64)
    else:
        value = F.shiftrightunsigned(words[1], low)
        if high > 64:
            value = value.bitwiseOR(F.shiftleft(words[0], 64 - low))
    return value.bitwiseAND(F.lit((1 << (high - low)) - 1)), high - low


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def _value_pairs(values: DataFrame) -> DataFrame:
    """(key_a, key_b), key_a < key_b, of block values (key, bits) that are 1 or 2 bits apart, each pair once."""

    def value(place: Column) -> Column:
        """The value listed at place 0 of a key is the key itself, at place i the key with bit i - 1 turned."""
        return F.when(place == 0, F.col("at")).otherwise(F.col("at").bitwiseXOR(_bit(F.greatest(place - 1, F.lit(0)))))

    listed = values.select(F.col("key").alias("at"), F.explode(F.sequence(F.lit(0), F.col("bits"))).alias("place"))
    lists = listed.select(value(F.col("place")).alias("at"), _bit(F.col("place")).alias("place"))
    lists = lists.groupBy("at").agg(F.bit_or("place").alias("places")).where("bit_count(places) > 1")
    places = F.filter(F.sequence(F.lit(0), F.lit(32)), lambda i: F.col("places").bitwiseAND(_bit(i)) != 0)
    first = lists.select("at", places.alias("places")).select("at", "places", F.explode("places").alias("a"))
    both = first.select("at", "a", F.explode("places").alias("b")).where("a < b")
    return both.select(value(F.col("a")).alias("key_a"), value(F.col("b")).alias("key_b")).where("key_a < key_b")


def _near(distinct: DataFrame, workspace: Workspace, radius: int, extra: tuple[str, ...]) -> DataFrame:
    """Pairs of rows (w0, w1 and extra columns, suffixed _a and _b) of distinct fingerprints within the radius, each once."""
    blocks = max(4, radius // 3 + 1)
    cut = [_block(k, blocks, [F.col("w0"), F.col("w1")]) for k in range(blocks)]
    keys = F.array(*[F.struct(value.bitwiseOR(F.lit(k << 32)).alias("key"), F.lit(bits).alias("bits")) for k, (value, bits) in enumerate(cut)])
    names = ("w0", "w1", *extra)
    members = workspace.save(distinct.select(*names, F.inline(keys)), "members")
    values = workspace.save(members.groupBy("key", "bits").agg(F.count(F.lit(1)).alias("n")), "values")
    pairs = _value_pairs(values).unionByName(values.where("n > 1").select(F.col("key").alias("key_a"), F.col("key").alias("key_b")))
    pairs = workspace.save(pairs, "value-pairs")
    a = members.select(F.col("key").alias("key_a"), *[F.col(c).alias(f"{c}_a") for c in names])
    b = members.select(F.col("key").alias("key_b"), *[F.col(c).alias(f"{c}_b") for c in names])
    x = [F.col(f"w{i}_a").bitwiseXOR(F.col(f"w{i}_b")) for i in range(2)]
    differ = [F.bit_count(_block(k, blocks, x)[0]) for k in range(blocks)]
    at = F.coalesce(*[F.when(d <= 2, F.lit(k)) for k, d in enumerate(differ)])
    once = (F.col("key_a") < F.col("key_b")) | (F.struct("w0_a", "w1_a") < F.struct("w0_b", "w1_b"))
    within = F.bit_count(x[0]) + F.bit_count(x[1]) <= radius
    found = pairs.join(a, "key_a").join(b, "key_b").where(once & within & (at == F.shiftright("key_a", 32)))
    return found.select(*[f"{c}_{side}" for side in "ab" for c in names])


def within_radius(prints: DataFrame, workspace: Workspace, radius: int = RADIUS) -> DataFrame:
    """Pairs (fp_a, fp_b, distance), fp_a < fp_b, of distinct fingerprints (column fp, hexadecimal) within the radius."""
    near = _near(prints.select("fp", "w0", "w1").distinct(), workspace, radius, ("fp",))
    bits = F.bit_count(F.col("w0_a").bitwiseXOR(F.col("w0_b"))) + F.bit_count(F.col("w1_a").bitwiseXOR(F.col("w1_b")))
    return near.select(F.least("fp_a", "fp_b").alias("fp_a"), F.greatest("fp_a", "fp_b").alias("fp_b"), bits.alias("distance"))


def neighbours(prints: DataFrame, workspace: Workspace, queries: Column, radius: int = RADIUS) -> DataFrame:
    """fp of rows of prints that are queries, with n_near: how many other rows of prints have a fingerprint within the radius.

    prints has fp, w0, w1 and what the condition `queries` reads; it is searched whole.
    """
    known = workspace.save(
        prints.groupBy("fp", "w0", "w1").agg(F.count(F.lit(1)).alias("copies"), F.coalesce(F.bool_or(queries), F.lit(False)).alias("asks")), "copies"
    )
    blocks = max(-(-BITS // INDEX_BITS), radius // 3 + 1)

    def cut(prefix: str) -> list[tuple[Column, int]]:
        return [_block(k, blocks, [F.col(f"{prefix}0"), F.col(f"{prefix}1")]) for k in range(blocks)]

    keys = F.array(*[value.bitwiseOR(F.lit(k << INDEX_BITS)) for k, (value, _) in enumerate(cut("w"))])
    index = workspace.save(known.select("w0", "w1", "copies", F.explode(keys).alias("key")), "index")
    bitmap = workspace.save(bitmaps.of_slots(index.select("key").repartition(F.bitmap_bucket_number("key")), "key"), "index-bits")
    turned = [[1 << i for i in range(bits)] for _, bits in cut("w")]
    masks = F.array(*[F.struct(value.bitwiseOR(F.lit(k << INDEX_BITS)).alias("at"), F.array(*map(F.lit, [0, *one, *[x | y for x in one for y in one if x < y]])).alias("turns"))
                      for k, ((value, _), one) in enumerate(zip(cut("q"), turned, strict=True))])
    asked = known.where("asks").select(F.col("w0").alias("q0"), F.col("w1").alias("q1"))
    probes = asked.select("q0", "q1", F.inline(masks)).select("q0", "q1", "at", F.explode("turns").alias("turn"))
    probes = probes.select("q0", "q1", F.col("at").bitwiseXOR(F.col("turn").cast("long")).alias("probe"))
    probes = bitmaps.flag(probes, bitmap, F.col("probe"), "__some").where("__some").drop("__some")
    probes = workspace.save(probes, "probes")
    x = [F.col("q0").bitwiseXOR(F.col("w0")), F.col("q1").bitwiseXOR(F.col("w1"))]
    first = F.coalesce(*[F.when(F.bit_count(_block(k, blocks, x)[0]) <= 2, F.lit(k)) for k in range(blocks)])
    within = F.bit_count(x[0]) + F.bit_count(x[1]) <= radius
    found = probes.join(index, probes["probe"] == index["key"]).where(within & (first == F.shiftright("key", INDEX_BITS)))
    near = found.groupBy("q0", "q1").agg(F.sum("copies").alias("n"))
    asked = known.where("asks").select("fp", "w0", "w1")
    return asked.join(near, (F.col("w0") == F.col("q0")) & (F.col("w1") == F.col("q1"))).select("fp", (F.col("n") - 1).alias("n_near"))


def next_rows(rows: DataFrame, workspace: Workspace, partitions: int) -> DataFrame:
    """Distinct rows (ROW) and the row after each as next_no_id, next_id, next_hash, without one window over all of them.

    Rows are dealt by range into written parts; the next row is found within a part, and at its end from the
    first rows of the parts, of which there are `partitions` at most. The last row is followed by the first.
    """
    row = F.struct(*ROW)
    parts = workspace.save(rows.repartitionByRange(partitions, *ROW).select(*ROW, F.spark_partition_id().alias("part")), "parts")
    in_order = Window.orderBy("part")
    heads = parts.groupBy("part").agg(F.min(row).alias("head")).select(
        F.col("part").alias("__part"), F.coalesce(F.lead("head").over(in_order), F.min("head").over(Window.partitionBy())).alias("after")
    )
    heads = workspace.save(heads, "heads")
    inside = parts.withColumn("__next", F.lead(row).over(Window.partitionBy("part").orderBy(*ROW)))
    joined = inside.join(heads, inside["part"] == heads["__part"]).withColumn("__next", F.coalesce("__next", "after"))
    return joined.select(*ROW, *[F.col(f"__next.{c}").alias(f"next_{c}") for c in ROW])


def edited_texts(texts: DataFrame, workspace: Workspace, partitions: int) -> DataFrame:
    """Distinct rows of texts (see rows_of): ROW, the next row, n_chars, copies and edited, the text with its last quarter
    replaced by as much of the next one's start.

    Texts are shuffled once by row; the starts, a quarter of them at most, once more.
    """
    sizes = texts.groupBy(*ROW).agg(F.first(F.length("text")).cast("long").alias("n_chars"), F.max(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("copies"))
    sizes = workspace.save(sizes, "sizes")
    following = workspace.save(next_rows(sizes.select(*ROW), workspace, partitions), "following")
    wanted = sizes.join(following, list(ROW)).select(
        *[F.col(f"next_{c}").alias(f"__of_{c}") for c in ROW], *[F.col(c).alias(f"__for_{c}") for c in ROW],
        F.floor(F.col("n_chars") / 4).cast("int").alias("__n"), "n_chars", "copies",
    )
    wanted = workspace.save(wanted, "wanted")

    def same(side: str) -> Column:
        return (F.col("no_id") == F.col(f"__{side}_no_id")) & (F.col("id") == F.col(f"__{side}_id")) & (F.col("hash") == F.col(f"__{side}_hash"))

    heads = texts.join(wanted, same("of")).select(
        *[f"__for_{c}" for c in ROW], *[F.col(f"__of_{c}").alias(f"next_{c}") for c in ROW], "n_chars", "copies", "__n", F.left("text", F.col("__n")).alias("head")
    )
    if not wanted.groupBy().agg(F.coalesce(F.max("copies") == 1, F.lit(True))).first()[0]:
        heads, texts = heads.dropDuplicates([f"__for_{c}" for c in ROW]), texts.dropDuplicates(list(ROW))
    whole = texts.join(heads, same("for"))
    kept = F.left("text", (F.col("n_chars") - F.col("__n")).cast("int"))
    return whole.select(*ROW, *[f"next_{c}" for c in ROW], "n_chars", "copies", F.concat(kept, "head").alias("edited"))


def longest(workspace: Workspace, spark: SparkSession) -> int:
    """Bytes of the longest text that edited_texts met."""
    return spark.read.parquet(workspace.path("sizes")).agg(F.coalesce(F.max("bytes"), F.lit(0))).first()[0]
