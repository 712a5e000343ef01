"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import (
    exact_dedup,
    language_id,
    license_scan,
    lm_scoring,
    mixing,
    ngram_join,
    secret_scan,
    sentencepiece_sampling,
    simhash,
    token_counts,
    toxicity,
    vector_codes,
    whitening,
)
from weft.sources.tables import table
from weft.workspace import Workspace

#: Vocabulary files of public tokenizers, on every machine; WEFT_TOKENIZERS names another folder.
TOKENIZERS = os.environ.get("WEFT_TOKENIZERS", "/opt/tokenizers")
BPE_RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
UNIGRAM_VOCABULARY = f"{TOKENIZERS}/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def label_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the weight of its quality label: 2 for quality 1, 0.5 for quality 0."""
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("__labelled")).agg(F.max("quality").alias("q"))
    return labels.select("__labelled", F.when(F.col("q") > 0, 2.0).when(F.col("q") == 0, 0.5).alias("weight"))


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source; labelled quality weighs the exponential keys."""
    work = Workspace(spark, "op1")
    docs = table(spark, sf_dir, "documents")
    sizes = work.save(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "sizes")
    weights = label_weights(spark, sf_dir)
    weighed = sizes.join(weights, sizes["doc_id"] == weights["__labelled"], "left").drop("__labelled")
    mixed = mixing.mix(weighed, work, size=F.col("size"), weight=F.col("weight"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digest = F.sha2(exact_dedup.normalised(F.col("text")), 256)
    return exact_dedup.decide(
        docs.withColumn("text_sha256", digest), Workspace(spark, "op6"), carry=["text_sha256"]
    ).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every sentence of every document; a token across a sentence's end goes where most of it lies."""
    return token_counts.section_tokens(
        table(spark, sf_dir, "documents"), BPE_RANKS, rule="majority", borders_of=token_counts.sentence_borders
    )


@query
def op3_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document; the pieces themselves are in the operator's output."""
    encoded = sentencepiece_sampling.encode(table(spark, sf_dir, "documents"), UNIGRAM_VOCABULARY, samples=2)
    return encoded.select(
        "doc_id", "sample", "n_pieces", "log_prob", "gumbel", "inclusion", "restored",
        F.sha2(F.col("pieces"), 256).alias("pieces_sha256"),
    )


def document_path() -> Column:
    """Documents as files: source/number of the 64 around it/name; each directory's first one is its LICENSE."""
    folder = F.floor(F.col("doc_id") / 64).cast("long").cast("string")
    name = F.when(F.col("doc_id") % 64 == 0, F.lit("LICENSE")).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return F.concat_ws("/", F.coalesce("source", F.lit("unknown")), folder, name)


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("path", document_path())
    found = license_scan.scan(docs, Workspace(spark, "op4"))
    return found.select("doc_id", "path", "license", "how", "from_directory", F.round("score", 9).alias("score"), "line")


@query
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ngram_join.jaccard_components(docs, Workspace(spark, "op5"), words=4, percent=85)


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts.

    n_near counts the other documents within simhash.RADIUS bits, for documents whose id is divisible by 20 (else null).
    """
    work = Workspace(spark, "op7")
    texts = simhash.rows_of(table(spark, sf_dir, "documents"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row, following = list(simhash.ROW), [f"next_{c}" for c in simhash.ROW]
    edited = simhash.edited_texts(texts, work, partitions).withColumn("edited_sha256", F.sha2("edited", 256))
    wide = 2 * simhash.longest(work, spark) > simhash.LANE_BYTES
    own = work.save(simhash.fingerprints(texts, row, "text", wide).withColumn("fp", simhash.as_hex()), "own")
    votes = simhash.fingerprints(edited, [*row, *following, "n_chars", "copies", "edited_sha256"], "edited", wide)
    edits = work.save(votes.withColumnsRenamed({"w0": "e0", "w1": "e1"}), "edits")
    after = own.select(*[F.col(c).alias(f"next_{c}") for c in row], F.col("w0").alias("n0"), F.col("w1").alias("n1"))
    asks = ~F.col("no_id") & (F.col("id") % 20 == 0)
    near = work.save(simhash.neighbours(own.join(edits.select(*row, "copies"), row).select("*", F.explode(F.sequence(F.lit(1), "copies"))), work, asks), "near")
    joined = edits.join(own, row).join(after, following).join(near, "fp", "left")
    joined = joined.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return joined.select(
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        F.col("fp").alias("fingerprint"),
        simhash.as_hex("e").alias("edited_fingerprint"),
        simhash.likeness("w", "e").alias("near_edited"),
        simhash.likeness("w", "n").alias("near_next"),
        F.when(asks, F.col("n_near")).alias("n_near"),
    )


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = toxicity.learn(docs, table(spark, sf_dir, "labels"), toxicity.fold(F.col("doc_id")) % 5 != 0, Workspace(spark, "op8"))
    return toxicity.score(docs, net).select(
        "doc_id",
        (toxicity.fold(F.col("doc_id")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        "flagged",
    )


@query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = toxicity.fold(F.col("doc_id")) % 5 == 1
    return lm_scoring.score(docs, Workspace(spark, "op10"), ~held_out, UNIGRAM_VOCABULARY).select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, with the text model fitted on documents."""
    model = language_id.fit(table(spark, sf_dir, "documents"))
    pages = table(spark, sf_dir, "pages")
    body = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)", 1))
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-zA-Z]+)", 1))
    found = language_id.identify(
        pages.select("page_id", "url", body.alias("body"), declared.alias("d"), host.alias("h")),
        model,
        Workspace(spark, "op9"),
        key_cols=("page_id",),
        text_col="body",
        declared=F.nullif(F.col("d"), F.lit("")),
        suffix=F.nullif(F.substring_index("h", ".", -1), F.lit("")),
        host=F.nullif(F.col("h"), F.lit("")),
    )
    return found.select("page_id", "language", F.round("posterior", 6).alias("posterior"), "text_language", "declared", "rejected")


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the 32 leading components of their covariance, scaled to variance 1."""
    rows = table(spark, sf_dir, "embeddings")
    return whitening.whiten(rows, Workspace(spark, "op11"), vec_id=F.col("vec_id"), vector=F.col("embedding"))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    coded = vector_codes.encode(rows, Workspace(spark, "op12"), vec_id=F.col("vec_id"), label=F.col("label"), vector=F.col("embedding"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known shapes of secrets and, by the Markov models, other random strings of all documents."""
    docs = table(spark, sf_dir, "documents")
    ratios = secret_scan.train(secret_scan.labelled_samples(spark, F.col("text"), docs))
    found = secret_scan.scan(docs, ratios)
    counts = [secret_scan.counted("known", kind).alias(f"n_{kind}") for kind in secret_scan.KINDS[:3]]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.as_text(F.col("known")), 256).alias("base_sha256"),
        secret_scan.as_text(F.concat("known", "added")).alias("spans"),
    )
