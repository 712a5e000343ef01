"""The pipeline over a small folder of tables against a plain computation of its stages."""

from __future__ import annotations

import collections
import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_llm import brute_components, lower, words
from weft.llm import lattice, mixing, sentencepiece_sampling
from weft.llm.queries import UNIGRAM_VOCABULARY, label_weights
from weft.workspace import Workspace

SAMPLES = {
    "en": "the of and house garden with many people town they were there".split(),
    "de": "der die und haus garten mit vielen menschen stadt sie waren dort".split(),
}


def corpus():
    rng = random.Random(6)
    rows = []
    for i in range(120):
        lang = rng.choice(list(SAMPLES))
        rows.append((lang, " ".join(rng.choice(SAMPLES[lang]) + rng.choice(["", "", "x", "y"]) for _ in range(rng.randrange(6, 50)))))
    texts = list(rows)
    texts += [(lang, t.upper()) for lang, t in rows[:20]] + [(lang, t + " tail") for lang, t in rows[20:40]] + [("en", "12 34 56"), (None, None), ("de", "")]
    rng.shuffle(texts)
    return [(i, t, lang, rng.choice(["s1", "s1", "s1", "s2", "s3", None]), None) for i, (lang, t) in enumerate(texts)]


def plain_mix(rows, labels):
    """Copies of each id, by Efraimidis-Spirakis keys over labelled quality and water-filled targets."""
    shares = (5, 2, 1)
    sources = sorted({s for _, _, _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    size = {r[0]: len((r[1] or "").encode().split()) for r in rows}
    quality = {i: 2.0 if q else 0.5 for i, q, _ in labels}
    total = {s: sum(size[r[0]] for r in rows if r[3] == s) for s in sources}
    weight = {s: shares[k % 3] for k, s in enumerate(sources)}
    target, open_ = {}, set(sources)
    while True:
        left = sum(total.values()) - sum(target.values())
        part = {s: left / sum(weight[x] for x in open_) * weight[s] for s in open_}
        over = [s for s in open_ if part[s] > 3 * total[s]]
        if not over:
            target |= part
            break
        for s in over:
            target[s] = 3 * total[s]
            open_.remove(s)
    copies = {}
    for s in sources:
        own = [r[0] for r in rows if r[3] == s]
        epochs = math.floor(target[s] / total[s]) if total[s] else 0
        key = {}
        for i in own:
            u = (int(hashlib.md5(f"17:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            key[i] = -math.log(u) / quality.get(i, 1.0)
        upto, left = 0, target[s] - epochs * total[s]
        for i in sorted(own, key=lambda i: (key[i], i)):
            upto += size[i]
            copies[i] = epochs + (left > 0 and 2 * upto - size[i] <= 2 * left)
    return copies


def test_pipeline_against_plain_stages(spark, tmp_path):
    rows = corpus()
    labels = [(i, i % 2, 0) for i in range(0, len(rows), 3)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    last = {}
    for r in kept:
        last[lower(r[1])] = max(last.get(lower(r[1]), -1), r[0])
    kept = [r for r in kept if last[lower(r[1])] == r[0]]
    linked = brute_components([(r[0], r[1]) for r in kept], 5, 80)
    kept = [r for r in kept if linked[r[0]][1] == r[0]]
    copies = plain_mix(kept, labels)
    text = {r[0]: r[1] for r in kept}
    assert len(kept) < len(rows) - 30 and set(copies.values()) - {1}

    vocab = lattice.vocabulary(UNIGRAM_VOCABULARY)
    found = collections.Counter()
    for r in out:
        assert r.restored and sentencepiece_sampling.decode(np.frombuffer(r.pieces, np.int32), vocab).tobytes() == (" " + text[r.doc_id]).encode()
        found[r.doc_id, r["sample"]] += 1
    assert found == {(i, k): n for i, n in copies.items() for k in (0, 1) if n}


def test_stages_keep_the_columns_and_bear_edges(spark, tmp_path):
    names = ["doc_id", "text", "lang", "source", "n_chars", "size", "copies", "keep_id", "id"]  # the last ones clash
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string, copies string, keep_id string, id string"
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "word " * 20_000, "en", "a", None), (3, "word " * 20_000, "en", "a", None), (None, "some words here", "en", None, 1), (4, "words", "en", "a", 1)]
    rows = [(*r, "s", "c", "k", "i") for r in rows]
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, data in (("full", rows), ("empty", [])):
        docs = spark.createDataFrame(data, schema)
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = Workspace(spark, "t").save(stage(spark, docs, str(tmp_path)), f"{name}-{number}")
            if number < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == names and docs.where("size <> 's' OR copies <> 'c' OR keep_id <> 'k' OR id <> 'i'").count() == 0
        assert (docs.count() > 0) == bool(data)


def test_mixing_stage_draws_by_labelled_quality(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(SAMPLES["en"]) for _ in range(10)) for _ in range(4000)]
    rows = [(i if i else None, t, "en", "a" if i < 2000 else rng.choice(["b", None]), None) for i, t in enumerate(texts)]
    rows += [(7, "a row with the same id", "en", "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 3 // 2, 0) for i in range(4000) if i % 3], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stage = collections.Counter((r.doc_id, r.text) for r in corpus_pipeline.mix_sources(spark, df, str(tmp_path)).collect())
    weighed = df.join(label_weights(spark, str(tmp_path)).withColumnRenamed("__labelled", "l"), F.col("doc_id") == F.col("l"), "left")
    mixed = mixing.mix(weighed, Workspace(spark, "t"), size=mixing.word_count(F.col("text")), weight=F.col("weight"), carry=["text"])
    assert stage == {(r.doc_id, r.text): r.copies for r in mixed.collect() if r.copies}
    drawn = [sum(stage[i, texts[i]] for i in range(2001, 4000) if i % 3 == k and rows[i][3] is None) for k in (1, 2)]
    assert drawn[1] > 1.5 * drawn[0]


def test_words_helper():
    assert words("A b\x0bC") == [b"a", b"b", b"c"]
