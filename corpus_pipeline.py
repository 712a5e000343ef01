"""From raw documents to token ids: five stages, each written and read again before the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its decisions take
effect. All but the last return the columns of documents.

For all stages: an empty table gives an empty table with the same columns. Texts are read whole; one of many megabytes is hashed or cut in
windows by the operators, so that a task holds a text and its word numbers at most. Columns whose names an operator uses itself stay
the rows' own: decisions are taken on the columns that a stage selects and are carried back by id, or in one column that holds the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import bitmaps, exact_dedup, language_id, mixing, ngram_join, sentencepiece_sampling
from weft.llm.queries import UNIGRAM_VOCABULARY, label_weights
from weft.sources.tables import table
from weft.workspace import Workspace


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known stay; lang is the declared language and the source stands for the host.

    Null and empty texts and texts without letters are rejected. The decision is taken by id: of rows that repeat an id all
    go if one is rejected, and all rows with a null id go if one of them is. Of languages that are equally likely the first by name
    counts, and without any declared language no text is known. A very long text is one text, scored in windows of trigrams.
    """
    work = Workspace(spark, "language")
    model = language_id.fit(docs)
    found = language_id.identify(
        docs, model, work, key_cols=("doc_id",), text_col="text", declared=F.col("lang"), host=F.col("source")
    )
    rejected = work.save(found.where("rejected").select("doc_id").distinct(), "rejected")
    return bitmaps.without(docs, rejected, work, "rejected-bits", {"doc_id": F.col("doc_id")})


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays.

    A null text equals an empty one. A null id goes if its text has an id; rows that repeat id and text stay together, which is
    the only tie. Very long texts are hashed whole; only those that share length and prefix with another are read a second time.
    """
    return exact_dedup.exact_dedup(docs, Workspace(spark, "copies"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by 80% of their five-word shingles the one with the smallest id stays.

    Null and empty texts are linked with nothing. Rows with a null id stay, and link others; rows that repeat an id are one document. Ids
    are unique otherwise, so there are no ties. A very long text is one set of hashes of its shingles, 8 bytes each.
    """
    return ngram_join.keep_one_per_component(docs, Workspace(spark, "near-copies"), words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their targets: a document is left out, stays, or comes up to three times.

    Labelled quality weighs the exponential keys, as in op1_mix_sources. A null source is one of its own, the last; null and
    empty texts count no words and come as often as whole epochs say. Equal keys are ordered by id; rows with one id share a decision.
    A very long text counts as its words and is taken or left whole. The row travels in one column, so names cannot clash.
    """
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("__row"))
    mixed = mixing.weighed_copies(
        rows, label_weights(spark, sf_dir), Workspace(spark, "mix"), size=mixing.word_count(F.col("text")), row="__row"
    )
    repeated = mixed.where("copies > 0").select("__row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("__row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every row, as token ids.

    A null text is an empty one and has one segmentation; rows with the same id and text get the same ones; ties and very long texts as in
    sentencepiece_sampling: a text is walked whole, with some 60 bytes for each of its pieces. A carried column of the input that clashes with one
    of the result is left out.
    """
    return sentencepiece_sampling.encode(docs, UNIGRAM_VOCABULARY, samples=2, carry=("lang", "source"))


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("SentencePiece", encode),
]

#: Segmentations are drawn and language models are fitted outside SQL: tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = work.save(docs, f"stage-{number}")
    return docs
