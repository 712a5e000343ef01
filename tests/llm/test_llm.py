"""The text operators against brute force, exact round trips and held-out accuracy, with their edge cases."""

from __future__ import annotations

import collections
import copy
import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weft.llm import (
    bitmaps,
    exact_dedup,
    language_id,
    lattice,
    license_scan,
    lm_scoring,
    mixing,
    ngram_join,
    queries,
    sentencepiece_sampling,
    simhash,
    textops,
    token_counts,
    toxicity,
)
from weft.llm.components import components
from weft.llm.queries import BPE_RANKS, UNIGRAM_VOCABULARY
from weft.workspace import Workspace

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, __x string"
LONG = "word " * 30_000
EDGES = [
    (1, "a b c d e f", "en", "s1"), (2, "a b c d e f", "en", "s1"), (3, "A B C d e f", None, None), (4, None, None, "s2"), (5, "", "en", "s2"),
    (6, " \t\n ", "de", "s1"), (7, LONG, "en", "s1"), (8, "é ü 😀 ▁ x▁y  z\n\nq", "fr", "s3"), (9, "one", "en", None), (None, "a b c d e f", "en", "s1"), (9, "one", "en", None),
]


def docs(spark, rows=EDGES):
    return spark.createDataFrame([(i, t, lang, s, None, "clash", "y") for i, t, lang, s in rows], SCHEMA)


def work(spark):
    return Workspace(spark, "t")


def lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def words(text):
    return lower(text).encode().split()


def random_texts(n, seed=1, vocabulary=200, most=60):
    rng = random.Random(seed)
    names = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(vocabulary)]
    return [" ".join(rng.choice(names) for _ in range(rng.randrange(0, most))) for _ in range(n)]


# words of a batch


def test_word_spans_and_hashes():
    import pyarrow as pa

    texts = ["Ab cd", None, "", " x\ty\x0bz ", "Ab", "é b"]
    seen = {}
    for size in (1, 7, 1 << 20):
        got = []
        for _, _, data, at in textops.blocks(pa.array(texts), size):
            starts, ends, first = textops.spans(data, at)
            h = textops.span_hash(textops.prefix_sums(data), starts, ends)
            for i in range(len(at) - 1):
                got.append([(bytes(data[starts[k] : ends[k]]), int(h[k])) for k in range(first[i], first[i + 1])])
        assert [[w for w, _ in t] for t in got] == [(t or "").encode().split() for t in texts]
        for w, h in itertools.chain(*got):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_bitmap_misses_no_key(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    every = spark.range(3000).withColumnRenamed("id", "doc_id")
    kept = bitmaps.without(every, keys, work(spark), "bits", {"k": F.col("doc_id")})
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(3000) if i % 3]


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 140)]
    random.Random(2).shuffle(links)
    got = {r.v: r.component for r in components(spark.createDataFrame(links, "a long, b long"), work(spark)).collect()}
    assert all(got[v] == 10 for v in range(10, 61)) and all(got[v] == 100 for v in range(100, 140))


# 1 mixing


def mixed(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, weight double, target string")
    return mixing.mix(df, work(spark), size=F.col("size"), weight=F.col("weight"), **options).collect()


def test_mix_targets_by_hand_and_whole_epochs(spark):
    rng = random.Random(5)
    rows = [(i, s, rng.randrange(0, 50), rng.choice([0.5, 1.0, 2.0, None, -1.0]), "c") for i, s in enumerate(["a"] * 50 + ["b"] * 400 + [None] * 300 + ["d"] * 20)]
    rows += [(1000 + i, "d", 0, None, "c") for i in range(5)]  # empty rows of a source at its cap
    got = mixed(spark, rows)
    assert {r.copies for r in got if r.source == "d"} == {3}
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        assert r.epochs <= r.copies <= 3
    total, weight = sum(size.values()), {"a": 5, "b": 2, "d": 1, None: 5}
    want, open_ = {}, set(size)
    while True:
        left = total - sum(want.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * size[s]]
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 3 * size[s]
            open_.remove(s)
    for s in size:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 25
    again = mixed(spark, rows[::-1])
    assert {(r.doc_id, r.copies) for r in got} == {(r.doc_id, r.copies) for r in again}


def test_mix_prefers_weight(spark):
    rows = [(i, "a" if i < 2000 else "b", 10, 4.0 if i % 2 else 0.25, "c") for i in range(10_000)]
    got = mixed(spark, rows, shares=(1, 50))
    heavy = sum(r.copies for r in got if r.source == "a" and r.doc_id % 2)
    light = sum(r.copies for r in got if r.source == "a" and not r.doc_id % 2)
    assert heavy > 2 * light


@pytest.mark.parametrize("scale", [1e-9, 1.0, 1e9])
def test_mix_cuts_any_scale_of_weights_into_small_buckets(spark, scale):
    keyed = spark.range(100_000).select(mixing._bucket(mixing.es_key(F.col("id"), F.lit(scale), 17)).alias("bucket"))
    assert keyed.groupBy("bucket").count().agg(F.max("count")).first()[0] < 100


def test_mix_edges(spark):
    assert mixed(spark, []) == []
    got = mixed(spark, [(None, None, None, None, None), (1, "a", 0, 1.0, None), (1, "a", 0, 1.0, None)])
    assert len(got) == 3 and all(r.target == 0 and r.size == 0 for r in got)
    ties = mixed(spark, [(7, "a", 10, 1.0, None)] * 4)
    assert len({r.copies for r in ties}) == 1
    got = mixing.mix(docs(spark), work(spark), size=mixing.word_count(F.col("text")), carry=["text", "source", "__x"]).collect()
    assert len(got) == len(EDGES) and {r.size for r in got} >= {0, 30_000}


# 2 token counts


def test_tokens_of_sections_add_up(spark):
    for rule in token_counts.RULES:
        got = token_counts.section_tokens(docs(spark), BPE_RANKS, rule=rule, borders_of=token_counts.sentence_borders, carry=("lang", "keep_id")).toPandas()
        for _, g in got.groupby(["doc_id", "lang"], dropna=False):
            copies = len(g) // g["section"].nunique()
            assert g["tokens"].sum() == pytest.approx(copies * g["text_tokens"].iloc[0])
    assert token_counts.section_tokens(docs(spark, []), BPE_RANKS).count() == 0


def test_attribution_rules_against_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        size = rng.randrange(1, 40)
        ends = np.array(sorted({rng.randrange(1, size + 1) for _ in range(rng.randrange(1, 12))} | {size}))
        borders = np.array(sorted({rng.randrange(0, size + 1) for _ in range(rng.randrange(0, 6))} | {0, size}))
        owner = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
        section = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
        for rule in token_counts.RULES:
            want, crossing = np.zeros(len(borders) - 1), np.zeros(len(borders) - 1)
            for t in range(len(ends)):
                parts = collections.Counter(section[owner == t].tolist())
                if rule == "start":
                    want[section[owner == t][0]] += 1
                elif rule == "majority":
                    want[min(parts, key=lambda s: (-parts[s], s))] += 1
                else:
                    for s, n in parts.items():
                        want[s] += n / sum(parts.values())
                if len(parts) > 1:
                    for s in parts:
                        crossing[s] += 1
            got, shared = token_counts.attribute(ends, borders, rule)
            assert got == pytest.approx(want) and (shared == crossing).all()


# 3 SentencePiece


def segmentations(text, vocab):
    plain = {p.replace(lattice.MARK, " "): i for i, p in enumerate(vocab.pieces) if vocab.log_p[i] > -1e8 and i not in set(vocab.byte_ids.tolist())}
    found = {}

    def extend(i, ids, p):
        if i == len(text):
            found[tuple(ids)] = p
        for j in range(i + 1, min(len(text), i + 16) + 1):
            if text[i:j] in plain:
                k = plain[text[i:j]]
                extend(j, [*ids, k], p + vocab.log_p[k])
            elif j == i + 1:
                own = vocab.byte_ids[np.frombuffer(text[i:j].encode(), np.uint8)]
                extend(j, [*ids, *own.tolist()], p + vocab.log_p[own].sum())

    extend(0, [], 0.0)
    whole = np.logaddexp.reduce(list(found.values()))
    return {k: p - whole for k, p in found.items()}, whole


def test_samples_without_replacement_follow_the_lattice():
    vocab = lattice.vocabulary(UNIGRAM_VOCABULARY)
    exact, _ = segmentations(" ab ti", vocab)
    n, body = 4000, b" ab ti"
    keys = textops.mix(np.arange(n, dtype=np.uint64))
    got = sentencepiece_sampling.sample_chunk(np.frombuffer(body * n, np.uint8), np.arange(n + 1) * len(body), keys, sentencepiece_sampling.Lexicon(vocab), 3)
    first, second = collections.Counter(), collections.Counter()
    for r in got:
        ids = [tuple(x[0].tolist()) for x in r]
        assert len(set(ids)) == 3 and r[0][2] > r[1][2] > r[2][2]
        assert all(x[1] == pytest.approx(exact[i], abs=1e-4) for x, i in zip(r, ids, strict=True))
        first[ids[0]] += 1
        second[ids[:2] and (ids[0], ids[1])] += 1
    for ids, p in exact.items():
        assert abs(first[ids] / n - math.exp(p)) < 4 * math.sqrt(math.exp(p) / n) + 1e-3
    a, b = sorted(exact, key=exact.get)[-2:][::-1]
    want = math.exp(exact[a]) * math.exp(exact[b]) / (1 - math.exp(exact[a]))
    assert abs(second[a, b] / n - want) < 4 * math.sqrt(want / n) + 1e-3
    assert np.mean([sum(math.exp(x[1]) / x[3] for x in r) for r in got]) == pytest.approx(1, abs=0.02)


def test_samples_do_not_depend_on_the_lexicon(monkeypatch):
    """Small chunks, a lexicon that is dropped again and again, and words whose hashes share a cell change nothing."""
    import pyarrow as pa

    texts = [t or "" for t in random_texts(80, seed=71, most=60)]
    batch = pa.record_batch([pa.array(range(80), pa.int64()), pa.array(texts), pa.array(range(80), pa.int64())], names=["k", "t", "doc_id"])

    def run():
        return pa.Table.from_batches(list(sentencepiece_sampling._encode(UNIGRAM_VOCABULARY, 3, ["doc_id"])(iter([batch.slice(0, 30), batch.slice(30)])))).to_pylist()

    whole = run()
    for name, value in (("CHUNK_BYTES", 500), ("LEXICON_BYTES", 20_000), ("CELL_BITS", 3), ("LATTICE_WORDS", 7), ("WALK_BYTES", 300)):
        monkeypatch.setattr(sentencepiece_sampling, name, value)
        again = run()
        for a, b in zip(whole, again, strict=True):
            assert a["pieces"] == b["pieces"] and a["doc_id"] == b["doc_id"] and a["inclusion"] == pytest.approx(b["inclusion"])


def test_few_segmentations_and_round_trips(spark):
    encoded = sentencepiece_sampling.encode(docs(spark), UNIGRAM_VOCABULARY, samples=3, carry=("text", "keep_id"))
    back = sentencepiece_sampling.decoded(encoded.withColumnRenamed("text", "was"), UNIGRAM_VOCABULARY).collect()
    assert all(r.restored and r.text == (r.was or "") for r in back)
    counts = collections.Counter(r.doc_id for r in back)
    assert counts[5] == counts[4] == 1 and counts[8] == 3 and counts[9] == 6
    assert all(r.inclusion == 1.0 for r in back if r.doc_id in (4, 5))
    again = sentencepiece_sampling.encode(docs(spark).repartition(5), UNIGRAM_VOCABULARY, samples=3).collect()
    assert {(r.doc_id, r["sample"], bytes(r.pieces)) for r in back} == {(r.doc_id, r["sample"], bytes(r.pieces)) for r in again}
    assert sentencepiece_sampling.encode(docs(spark, []), UNIGRAM_VOCABULARY).count() == 0


def test_lattice_sums_against_enumeration_and_long_words():
    vocab = lattice.vocabulary(UNIGRAM_VOCABULARY)
    for text in (" hello", " tionbleed", " üb", " 日本", " ", " x😀"):
        assert lattice.log_likelihoods([text.encode()], vocab, vocab.log_p[None])[0, 0] == pytest.approx(segmentations(text, vocab)[1])
    counts = lattice.expected_counts([b" hello"], vocab, vocab.log_p)
    exact, _ = segmentations(" hello", vocab)
    want = np.zeros(len(counts))
    for ids, p in exact.items():
        for i in ids:
            want[i] += math.exp(p)
    assert counts == pytest.approx(want, abs=1e-9)
    lat = lattice.build([b" " + b"ab" * 2000, b" hello"], vocab)
    at, place = np.nonzero(lat.arcs != -1)
    at, size = at - (place + 1), place + 1
    q = lattice.shares(lat, vocab, at, size)
    sums = np.bincount(at, weights=q)
    assert sums[np.unique(at)] == pytest.approx(1)


# 4 licenses


def test_licenses_by_header_file_and_directory(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/x.txt", "nothing here"), ("a/b/c/y.txt", None), ("a/b/LICENSE.md", "Licensed under CC BY-NC 4.0."),
        ("z/w.txt", "code " * 40 + "\nThis work is licensed under the GNU General Public License, version 3.\nmore code"), ("z/v.txt", "the license of the work"), ("top.txt", ""), (None, "text"),
        ("LICENSEE/q.txt", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ]
    df = spark.createDataFrame([(i, p, t, "x") for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string, license string")
    got = {r.path: (r.license, r.how, r.from_directory) for r in license_scan.scan(df, work(spark)).collect()}
    assert got["a/LICENSE"][:2] == ("MIT", "file") and got["a/x.txt"] == ("MIT", "inherited", "a")
    assert got["a/b/c/y.txt"] == ("CC-BY-NC-4.0", "inherited", "a/b") and got["z/w.txt"][:2] == ("GPL-3.0", "header")
    assert got["z/v.txt"][:2] == (None, "none") and got["top.txt"][:2] == (None, "none") and got[None][:2] == (None, "none")
    assert got["LICENSEE/q.txt"][:2] == ("MIT", "header")  # a notice is no full text
    assert license_scan.scan(df.limit(0), work(spark)).count() == 0


def test_licenses_in_wrapped_headers_full_texts_and_tags(spark):
    full = dict(license_scan.full_texts())
    mit = full["MIT"].replace("\n", "\nCopyright (c) 2021 Some Body and others\n", 1)
    code = "\nint main(void) { return answer(41); }\nfloat other = value * scale;\n" * 15
    gpl = "".join(f" * {line}\n" for line in (
        "This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by",
        "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version.",
    ))
    bsd = "// Redistribution and use in source and binary forms, with or without modification, are\n// permitted provided that the following conditions are met:\n"
    rows = [
        ("m/LICENSE", mit), ("m/deep/x.c", code), ("g/x.c", "int before = 1;\n/*\n" + gpl + " */" + code), ("b/x.c", "#pragma once\n" + bsd + code),
        ("s/x.c", "first\n/* SPDX-License-Identifier: GPL-2.0-or-later */" + code), ("s/y.c", "# SPDX-License-Identifier: (MIT OR Zlib)"), ("n/x.c", code), ("n/y.c", "the license of this program\nis free software\n" + code),
        ("s/z.c", "SPDX-License-Identifier:\nMIT"), *[(f"{name}/COPYING", text) for name, text in full.items()],
    ]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string")
    got = {r.path: (r.license, r.how, r.line) for r in license_scan.scan(df, work(spark)).collect()}
    assert got["m/LICENSE"][:2] == ("MIT", "file") and got["m/deep/x.c"][:2] == ("MIT", "inherited")
    assert got["g/x.c"] == ("GPL-3.0", "header", 2) and got["b/x.c"][:2] == (None, "none")  # that sentence is of several licenses
    assert got["s/x.c"] == ("GPL-2.0", "header", 1) and got["s/y.c"][:2] == ("(MIT OR Zlib)", "header")
    assert got["n/x.c"][:2] == got["n/y.c"][:2] == (None, "none")
    assert {p: r[:2] for p, r in got.items() if p and p.endswith("COPYING")} == {f"{name}/COPYING": (name, "file") for name in full}


def test_licenses_that_are_alike_or_inside_longer_files(spark):
    full = dict(license_scan.full_texts())
    code = "\nint main(void) { return answer(41); }\nfloat other = value * scale;\n" * 15

    def header(text, width=9):
        own = text.split()
        return "/*\n" + "".join(" * " + " ".join(own[i : i + width]) + "\n" for i in range(0, len(own), width)) + " */\n"

    notice = {name: [t for n, t in license_scan.TEMPLATES if n == name] for name, _ in license_scan.TEMPLATES}
    agpl = next(t for t in notice["AGPL-3.0"] if "redistribute" in t)
    lesser = next(t for t in notice["LGPL-2.1"] if "redistribute" in t)
    only = next(t for t in notice["GPL-2.0"] if "General Public License version 2 as" in t)
    rows = [
        ("c/x.py", header(agpl)), ("c/y.py", code), ("l/x.c", header(lesser) + code), ("l/y.c", header(lesser.replace("version 2.1", "version 3")) + code), ("o/x.c", header(only) + code),
        ("two/COPYING", full["BSD-2-Clause"]), ("three/COPYING", full["BSD-3-Clause"]), ("b/README", "Preface of this project.\n" * 30 + full["BSD-2-Clause"] + "\nThe end of the file." * 30),
        ("long/COPYING", "A preface with words of its own about the work and its authors.\n" * 200 + full["GPL-2.0"] + "\nMore words about other things follow here." * 200),
        ("r/README", "Everything here has a licence. The licence is in a file. See that file for the licence."),
    ]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string")
    got = {r.path: (r.license, r.how) for r in license_scan.scan(df, work(spark)).collect()}
    assert got["c/x.py"] == ("AGPL-3.0", "header") and got["c/y.py"] == (None, "none")  # a header licenses its file only
    assert got["l/x.c"] == ("LGPL-2.1", "header") and got["l/y.c"] == ("LGPL-3.0", "header") and got["o/x.c"] == ("GPL-2.0", "header")
    assert got["two/COPYING"] == ("BSD-2-Clause", "file") and got["three/COPYING"] == ("BSD-3-Clause", "file")
    assert got["b/README"] == ("BSD-2-Clause", "header") and got["r/README"] == (None, "none")
    assert got["long/COPYING"] == ("GPL-2.0", "file")


def test_license_windows_against_all_windows():
    templates = (("A", "alpha beta beta gamma delta"), ("B", "beta gamma eta"), ("", "zeta zeta"))
    terms = license_scan.Terms(templates)
    rng = random.Random(4)
    weight, unseen = np.array([1.0 + 0.3 * i for i in range(len(terms.hashes))]), 2.5
    matrix = terms.counts * weight[:, None]
    matrix /= np.sqrt((matrix**2).sum(axis=0))
    by_word = {}
    for word in "alpha beta gamma delta eta zeta".split():
        data = np.frombuffer(word.encode(), np.uint8)
        by_word[word] = int(license_scan._terms_of(data, np.array([0, len(data)]), terms)[2][0])
    for _ in range(60):
        lines = [" ".join(rng.choice("alpha beta gamma delta eta zeta other word".split()) for _ in range(rng.randrange(1, 4))) for _ in range(8)]
        data = np.frombuffer("\n".join(lines).encode(), np.uint8)
        found = license_scan.window_scores(data, np.array([0, len(data)]), terms, weight, unseen, matrix, 0.6)
        best = 0.0
        for t in (0, 1):
            for i in range(8):
                counts = np.cumsum([len(x.split()) for x in lines[i:]])
                above = int(np.searchsorted(counts, terms.sizes[t]))
                for end in {i + above, min(i + above + 1, 8)}:
                    if end >= i + 2:
                        own = collections.Counter(w for x in lines[i:end] for w in x.split())
                        v = np.zeros(len(weight))
                        for w, n in own.items():
                            if w in by_word:
                                v[by_word[w]] = n * weight[by_word[w]]
                        rest = sum(n for w, n in own.items() if w not in by_word) * unseen**2
                        best = max(best, float(v @ matrix[:, t] / np.sqrt(v @ v + rest)))
        assert (found[0][0] if found else 0.0) == pytest.approx(best if best >= 0.6 else 0.0)


def test_a_long_text_does_not_end_learning():
    assert toxicity.fitting([("a", 90), ("b", 5), ("c", 20), ("d", 10), ("e", 1)], 50) == ["b", "c", "d", "e"]
    assert toxicity.fitting([], 50) == [] and toxicity.fitting([("a", 50), ("b", 1), ("c", 0)], 50) == ["a", "c"]


def test_license_cosine_against_brute_force():
    templates = (("A", "alpha beta beta"), ("B", "beta gamma"))
    terms = license_scan.Terms(templates)
    weight, unseen = np.array([1.0 + i for i in range(len(terms.hashes))]), 5.0
    matrix = terms.counts * weight[:, None]
    matrix /= np.sqrt((matrix**2).sum(axis=0))
    line = "Beta alpha zeta, beta eta"
    data = np.frombuffer(line.encode(), np.uint8)
    best, template = license_scan.unit_scores(data, np.array([0, len(data)]), np.array([0]), terms, weight, unseen, matrix)
    by_word = {}
    for name, text in (("alpha", None), ("beta", None), ("gamma", None)):
        d = np.frombuffer(name.encode(), np.uint8)
        by_word[name] = weight[terms.find(textops.span_hash(textops.prefix_sums(d), np.array([0]), np.array([len(d)])))[0]]
    v = {"alpha": by_word["alpha"], "beta": 2 * by_word["beta"], "zeta": unseen, "eta": unseen}
    t = {"alpha": by_word["alpha"], "beta": 2 * by_word["beta"]}
    cosine = sum(v[k] * t.get(k, 0) for k in v) / math.sqrt(sum(x * x for x in v.values())) / math.sqrt(sum(x * x for x in t.values()))
    assert best[0] == pytest.approx(cosine) and terms.names[template[0]] == "A"


# 5 n-gram join


def brute_components(rows, w, percent):
    sets = {}
    for i, text in rows:
        x = words(text)
        sets[i] = {tuple(x[k : k + w]) for k in range(len(x) - w + 1)} if len(x) >= w else ({tuple(x)} if x else set())
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            label[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_links_of_repeated_and_null_ids(spark):
    rng = random.Random(7)
    a, b, c = ([f"{x}{rng.randrange(1000)}" for _ in range(60)] for x in "abc")
    text = lambda own, *more: " ".join([*own, *more])
    rows = [(1, text(a)), (1, text(b)), (5, text(a, "x")), (6, text(b, "y")), (7, text(c)), (None, text(c, "one", "two", "three", "four")), (9, text(c, "one", "two", "three", "four", "five", "six", "seven")), (1, ""), (3, None)]
    df = docs(spark, [(i, t, "en", "s") for i, t in rows])
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, work(spark), words=3, percent=92).collect())
    # 7 and 9 share 58 of 65 shingles, 89 %, and are linked by the row without an id alone
    assert got == collections.Counter([(1, 58, 1), (1, 58, 1), (5, 59, 1), (6, 59, 1), (7, 58, 7), (None, 62, 7), (9, 65, 7), (1, 0, 1), (3, 0, 3)])


@pytest.mark.parametrize(("w", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_jaccard_components_against_brute_force(spark, w, percent):
    rng = random.Random(w)
    base = random_texts(40, seed=w, most=80)
    texts = list(base)
    for t in base:
        for _ in range(4):
            x = t.split()
            for _ in range(rng.randrange(0, 4)):
                if x:
                    x[rng.randrange(len(x))] = "edited"
            texts.append(" ".join(x).upper() if rng.random() < 0.3 else " ".join(x))
    passage = " ".join(random_texts(1, seed=99, most=80)[0].split()[:30])
    texts += [f"{passage} {t}" for t in random_texts(60, seed=98, most=10)] + ["", None, "one", "one", "ONE two"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, work(spark), words=w, percent=percent).collect()}
    assert got == brute_components(rows, w, percent)


@pytest.mark.parametrize("table", ["rare", "frequent"])
def test_long_tiles_lose_no_link(spark, monkeypatch, table):
    """Families of near copies around the threshold, all through long tiles, cut into many blocks, with and without forest rounds."""
    monkeypatch.setattr(ngram_join, "TILE_ROWS", 5)
    monkeypatch.setattr(ngram_join, "SHORT_TILE", 2)
    monkeypatch.setattr(ngram_join, "BANDS", 0)
    monkeypatch.setattr(ngram_join, "_ODD", ngram_join._ODD[:0])
    if table == "frequent":
        monkeypatch.setattr(ngram_join, "_cells", lambda items, table: np.full(len(items), 255, np.uint8))
    rng = random.Random(3)
    texts = []
    for base in random_texts(4, seed=41, most=120):
        for _ in range(35):
            x = base.split()
            for _ in range(rng.randrange(0, 1 + len(x) // 25)):
                x[rng.randrange(len(x))] = rng.choice(["edited", "changed", "other"])
            texts.append(" ".join(x[: len(x) - rng.randrange(0, 4)]))
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, work(spark), words=3, percent=80).collect()}
    assert got == brute_components(rows, 3, 80)


def postings(tiles):
    """An Arrow batch of postings of {tile: ids}, all of one size, cold ones sorted by tile and some dealt ones first."""
    import pyarrow as pa

    rows = [(t, i) for t, ids in sorted(tiles.items()) for i in ids]
    return pa.record_batch(
        [pa.array([t for t, _ in rows], pa.int64()), pa.array([5 if t < 0 else None for t, _ in rows], pa.int64()), pa.array([i for _, i in rows], pa.int64()),
         pa.array([i for _, i in rows], pa.int64()), pa.array([20 << 32 for _ in rows], pa.int64())], names=["tile", "deal", "id", "comp", "at"],
    )


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_tiles_are_paired_or_passed_on_whole(size):
    import pyarrow as pa

    tiles = {-3: [1, 2], 4: [1], 5: [1, 2, 3], 6: list(range(40)), 7: [7, 8], 8: list(range(100, 100 + ngram_join.SHORT_TILE)), 9: list(range(17, 50))}
    batch = postings(tiles)
    cut = [batch.slice(i, size) for i in range(0, batch.num_rows, size)]
    got = pa.Table.from_batches(list(ngram_join._pairs(80)(iter(cut)))).to_pylist()
    pairs = {(r["a"], r["b"]) for r in got if r["tile"] is None}
    assert pairs == {p for t in (4, 5, 7, 8) for p in itertools.combinations(tiles[t], 2)}
    passed = collections.Counter((r["tile"], r["a"]) for r in got if r["tile"] is not None)
    assert passed == collections.Counter((t, i) for t in (-3, 6, 9) for i in tiles[t])


def test_frequency_table_grows_with_the_input(spark, tmp_path):
    assert ngram_join.frequency_bits(docs(spark, []).select("text")) == ngram_join.FREQUENCY_BITS[0]
    texts = [f"w{i % 7} x{i} y{i} z" for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = df.repartition(3).mapInArrow(ngram_join._classes(2, 19), ngram_join.CLASS_SCHEMA)
    counts = np.zeros(1 << 19)
    for s in (ngram_join.shingle_sets(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]), 2)[0] for t in texts):
        counts[(s >> np.uint64(64 - 19)).astype(int)] += 1
    assert (ngram_join.frequencies(rows, 19) == np.rint(8 * np.log2(1 + counts))).all()


def test_bitmap_bound_is_an_upper_bound():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = textops.mix(rng.integers(0, 1 << 60, 400).astype(np.uint64))
        a, b = np.unique(rng.choice(pool, rng.integers(1, 300))), np.unique(rng.choice(pool, rng.integers(1, 300)))
        bound = ngram_join.overlap_bound(ngram_join.signature(a), len(a), ngram_join.signature(b), len(b))
        assert bound >= len(np.intersect1d(a, b))


def test_join_edges(spark):
    got = ngram_join.jaccard_components(docs(spark), work(spark), words=4, percent=85).collect()
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.doc_id].append((r.n_shingles, r.component_id))
    assert len(got) == len(EDGES) and by_id[1] == by_id[2] == by_id[3] == [(3, 1)] and by_id[None] == [(3, 1)]
    assert by_id[4] == [(0, 4)] and by_id[5] == [(0, 5)] and by_id[7] == [(1, 7)] and by_id[9] == [(1, 9)] * 2
    assert ngram_join.jaccard_components(docs(spark, []), work(spark)).count() == 0
    kept = ngram_join.keep_one_per_component(docs(spark), work(spark))
    assert kept.columns == docs(spark).columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "4", "5", "6", "7", "8", "9", "9", "None"])


# 6 exact de-duplication


def test_exact_decisions_against_brute_force(spark):
    rng = random.Random(8)
    base = random_texts(60, seed=8, most=40)
    long_twins = [("x" * 5000) + c for c in "abab"]
    texts = [t.upper() if rng.random() < 0.3 else t for t in base for _ in range(rng.randrange(1, 4))] + long_twins + [None, "", "É", "é"]
    rng.shuffle(texts)
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    groups = collections.defaultdict(list)
    for i, t in enumerate(texts):
        groups[lower(t)].append(i)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.decide(df, work(spark), carry=["kept"]).collect()}
    assert got == {i: (max(groups[lower(t)]), len(groups[lower(t)]), i == max(groups[lower(t)])) for i, t in enumerate(texts)}
    stay = exact_dedup.exact_dedup(df, work(spark))
    assert stay.columns == df.columns and sorted(r.doc_id for r in stay.collect()) == sorted(max(g) for g in groups.values())


def test_exact_edges(spark):
    got = exact_dedup.decide(docs(spark), work(spark), carry=["__x"]).collect()
    assert len(got) == len(EDGES) and {(r.keep_id, r.group_size) for r in got if r.doc_id in (1, 2, 3, None)} == {(3, 4)}
    assert [r.kept for r in got if r.doc_id is None] == [False] and all(r.kept for r in got if r.doc_id == 9)
    assert exact_dedup.decide(docs(spark, []), work(spark)).count() == 0
    plan = exact_dedup.decide(docs(spark), work(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


# 7 fingerprints


def test_fingerprint_votes_and_edits(spark):
    texts = ["alpha beta beta", "", None, "é" * 40 + " z", "one two three four", LONG]
    df = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string")
    edited = {r.id: r for r in simhash.edited_texts(simhash.rows_of(df), work(spark), 3).collect()}
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        following = plain[(i + 1) % len(plain)]
        r = edited[i * 3]
        assert r.edited == t[: len(t) - len(t) // 4] + following[: len(t) // 4] and r.n_chars == len(t)
    prints = {r.doc_id: (r.w0, r.w1) for r in simhash.fingerprints(df, ["doc_id"], "text").collect()}
    assert prints[3] == prints[6] == (0, 0)
    assert prints == {r.doc_id: (r.w0, r.w1) for r in simhash.fingerprints(df, ["doc_id"], "text", wide=True).collect()}
    assert simhash.edited_texts(simhash.rows_of(df.limit(0)), work(spark), 3).count() == 0


def brute_print(text, hashes):
    """The fingerprint of a text as 128 bits, from hashes (word, number of 64 bits) -> hash."""
    votes, total = [0] * 128, 0
    for w in re.split(r"[\x20\x09-\x0D]+", text):
        weight = min(len(w.encode()) ** 2, simhash.MAX_WEIGHT)
        total += weight
        for b in range(128):
            votes[b] += weight * (hashes[w, 1 - b // 64] >> b % 64 & 1)
    return sum(1 << b for b in range(128) if 2 * votes[b] > total)


@pytest.mark.parametrize("lane_bytes", [simhash.LANE_BYTES, 10])
def test_fingerprint_query_against_brute_force(spark, tmp_path, monkeypatch, lane_bytes):
    """Every column of op7, with null ids, ids that repeat with the same and with another text, and near copies."""
    monkeypatch.setattr(simhash, "LANE_BYTES", lane_bytes)
    rng = random.Random(12)
    texts = [t for t in random_texts(30, seed=14, most=60)]
    texts += [" ".join(w if rng.random() > 0.04 else "changed" for w in t.split()) for t in texts]
    rows = [(20 * (i // 2) + i % 2, t, "clash") for i, t in enumerate(texts)] + [(20, "again\twith other text", "c"), (40, texts[4], "c"), (None, "no id", "c"), (None, None, "c"), (None, "no id", "c"), (999, "", "c")]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, id string").withColumn("hash", F.lit(1)).withColumn("fp", F.lit(2)).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op7_simhash"](spark, str(tmp_path)).collect()

    known = [(i is None, i or 0, t or "") for i, t, _ in rows]
    of_text = {r.t: r.h for r in spark.createDataFrame([(t,) for t in {k[2] for k in known}], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    order = sorted(set(known), key=lambda k: (k[0], k[1], of_text[k[2]]))
    edited = {}
    for k, after in zip(order, order[1:] + order[:1], strict=True):
        n = len(k[2]) // 4
        edited[k] = (k[2][: len(k[2]) - n] + after[2][:n], after)
    words_of = {w for t in [*of_text, *(e for e, _ in edited.values())] for w in re.split(r"[\x20\x09-\x0D]+", t)}
    hashed = spark.createDataFrame([(w,) for w in words_of], "w string").select("w", F.xxhash64("w", F.lit(0)).alias("a"), F.xxhash64("w", F.lit(1)).alias("b")).collect()
    hashes = {(r.w, k): h & (1 << 64) - 1 for r in hashed for k, h in ((0, r.a), (1, r.b))}
    prints = {t: brute_print(t, hashes) for t in {*of_text, *(e for e, _ in edited.values())}}
    want = []
    for k in known:
        e, after = edited[k]
        p, q, r = prints[k[2]], prints[e], prints[after[2]]
        near = sum((p ^ prints[o[2]]).bit_count() <= simhash.RADIUS for o in known) - 1
        asks = not k[0] and k[1] % 20 == 0
        want.append((None if k[0] else k[1], len(k[2]), hashlib.sha256(e.encode()).hexdigest(), f"{p:032x}", f"{q:032x}", 1 - (p ^ q).bit_count() / 128, 1 - (p ^ r).bit_count() / 128, near if asks else None))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert sum((w[-1] or 0) > 0 for w in want) > 10
    plan = queries.QUERIES["op7_simhash"](spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(128) for _ in range(20)]
    prints = base + [x ^ sum(1 << b for b in rng.sample(range(128), rng.randrange(1, 7))) for x in base for _ in range(6)] + base[:3]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(f"{p:032x}", signed(p >> 64), signed(p & (1 << 64) - 1)) for p in prints], "fp string, w0 long, w1 long")
    for radius in (1, 3, 5):
        near = {r.fp: r.n_near for r in simhash.neighbours(df, work(spark), F.col("w0") % 2 == 0, radius).collect()}
        assert len(near) > 20
        for p in {p for p in prints if (p >> 64) % 2 == 0}:
            assert near[f"{p:032x}"] == sum((p ^ q).bit_count() <= radius for q in prints) - 1


def test_wide_radius_finds_every_pair_and_planted_near_copies(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(128) for _ in range(15)]
    prints = [0, (1 << 128) - 1, *base] + [x ^ sum(1 << b for b in rng.sample(range(128), rng.randrange(1, 20))) for x in base for _ in range(15)] + base[:3]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(f"{p:032x}", signed(p >> 64), signed(p & (1 << 64) - 1)) for p in prints], "fp string, w0 long, w1 long")
    near = {r.fp: r.n_near for r in simhash.neighbours(df, work(spark), F.lit(True)).collect()}
    assert near == {f"{p:032x}": sum((p ^ q).bit_count() <= simhash.RADIUS for q in prints) - 1 for p in prints}
    pairs = sorted((r.fp_a, r.fp_b, r.distance) for r in simhash.within_radius(df, work(spark)).collect())
    plain = itertools.combinations(sorted(set(prints)), 2)
    assert pairs == sorted((f"{p:032x}", f"{q:032x}", (p ^ q).bit_count()) for p, q in plain if (p ^ q).bit_count() <= simhash.RADIUS)

    names = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(2000)]
    texts = [[rng.choice(names) for _ in range(200)] for _ in range(60)]
    edited = [t[:50] + [rng.choice(names)] + t[51:150] + [rng.choice(names)] + t[151:] for t in texts]  # Jaccard about 0.9
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts + edited)], "doc_id long, text string")
    own = simhash.fingerprints(df, ["doc_id"], "text").withColumn("fp", simhash.as_hex())
    found = simhash.neighbours(work(spark).save(own, "own"), work(spark), F.lit(True)).collect()
    assert sum(r.n_near >= 1 for r in found) >= 0.95 * len(found)


# 8 toxicity


def toxic_corpus(n, seed):
    rng = random.Random(seed)
    names = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.25
        x = [rng.choice(names) for _ in range(rng.randrange(5, 60))]
        if toxic:
            x.insert(rng.randrange(len(x)), rng.choice(["vile!", "Rotten", "nasty,"]))
        rows.append((i, " ".join(x), "en" if i % 3 else "de", int(toxic)))
    return rows


def test_toxicity_held_out_accuracy(spark):
    rows = toxic_corpus(1500, 1)
    df = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    net = toxicity.learn(df, labels, toxicity.fold(F.col("doc_id")) % 5 != 0)
    got = toxicity.score(df, net).collect()
    truth = {r[0]: r[3] for r in rows}
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum((r.score >= 0.5) == bool(truth[r.doc_id]) for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    again = toxicity.score(df.repartition(7), toxicity.learn(df.repartition(3), labels, toxicity.fold(F.col("doc_id")) % 5 != 0)).collect()
    assert {(r.doc_id, round(r.score, 6)) for r in got} == {(r.doc_id, round(r.score, 6)) for r in again}


def test_toxicity_forward_pass_against_loops():
    texts = [np.array([1, 2, 3, 4], np.int32), np.array([], np.int32), np.array([5], np.int32)] * 40
    labels = np.array([1, 0, 0] * 40)
    net = toxicity.train(texts, labels)
    tables = net.tables()
    batch = [np.array([1, 2, 3, 4, 9]), np.array([], int), np.array([5])]
    first = np.concatenate([[0], np.cumsum([len(x) for x in batch])])
    got = net.logits(np.concatenate(batch).astype(np.int32), first, tables)
    for x, y in zip(batch, got, strict=True):
        ids = [*x.tolist(), *[toxicity.PAD] * 3]
        hidden = []
        for k in toxicity.WIDTHS:
            starts = range(max(1, len(x)))
            hidden += [max(0.0, max(sum(net.embedding[ids[s + o]] @ net.filters[k][o][:, f] for o in range(k)) + net.bias[k][f] for s in starts)) for f in range(toxicity.FILTERS)]
        assert y == pytest.approx(float(np.dot(hidden, net.out) + net.offset), abs=1e-4)


def toxicity_loss(net, texts, labels):
    """Mean cross-entropy, in doubles, by loops over texts."""
    total = 0.0
    for t, y in zip(texts, labels, strict=True):
        ids = np.concatenate([t, [toxicity.PAD] * max(toxicity.WIDTHS)])
        hidden = []
        for k in toxicity.WIDTHS:
            starts = range(max(1, len(ids) - k + 1))
            reach = [sum(net.embedding[ids[s + o]].astype(float) @ net.filters[k][o].astype(float) for o in range(k)) + net.bias[k] for s in starts]
            hidden.append(np.maximum(np.max(reach, axis=0), 0))
        z = float(np.concatenate(hidden) @ net.out.astype(float) + net.offset)
        total += np.log1p(np.exp(-z)) if y else np.log1p(np.exp(z))
    return total / len(labels)


def test_toxicity_step_follows_the_numeric_gradient(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 40, n).astype(np.int32) for n in (1, 2, 5, 9, 12, 20)]
    labels = np.array([1, 0, 1, 0, 0, 1])
    monkeypatch.setattr(toxicity, "EPOCHS", 0)
    net = toxicity.train(texts, labels)
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    after = toxicity.train(texts, labels)

    def implied(before, now):
        """The gradient that one Adagrad step from 1e-2 must have had."""
        moved = (np.asarray(before, float) - np.asarray(now, float)) / toxicity.RATE
        return moved * 0.1 / np.sqrt(np.maximum(1 - moved * moved, 1e-9))

    def numeric(holder, key, above=1e-4, below=1e-4):
        value = holder[key]
        holder[key] = value + above
        up = toxicity_loss(net, texts, labels)
        holder[key] = value - below
        down = toxicity_loss(net, texts, labels)
        holder[key] = value
        return (up - down) / (above + below)

    for k in toxicity.WIDTHS:
        net.filters[k], net.bias[k] = net.filters[k].astype(float), net.bias[k].astype(float)
    net.embedding, net.out = net.embedding.astype(float), net.out.astype(float)
    for k in toxicity.WIDTHS:
        got = implied(net.filters[k], after.filters[k]) - toxicity.DECAY * net.filters[k]
        for at in [(0, 0, 0), (k - 1, 3, 2), (k - 1, 7, 5)]:
            assert got[at] == pytest.approx(numeric(net.filters[k], at), abs=2e-4)
        # a window of pads alone responds with the bias, 0 at first, where the rectifier bends: its slope is that from below
        assert implied(net.bias[k], after.bias[k])[1] == pytest.approx(numeric(net.bias[k], 1, above=0), abs=2e-4)
    out = implied(net.out, after.out) - toxicity.DECAY * net.out
    assert [out[i] for i in range(0, 24, 5)] == pytest.approx([numeric(net.out, i) for i in range(0, 24, 5)], abs=2e-4)
    words = implied(net.embedding, after.embedding)
    for word in sorted(set(np.concatenate(texts).tolist()))[:6]:
        assert words[word, 0] == pytest.approx(numeric(net.embedding, (word, 0)), abs=2e-4)
        assert words[word, 4] == pytest.approx(numeric(net.embedding, (word, 4)), abs=2e-4)
    assert np.array_equal(after.embedding[toxicity.PAD], net.embedding[toxicity.PAD])


def test_toxicity_calibration_is_at_its_minimum_and_thresholds_have_the_best_f1(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 60, rng.integers(1, 12)).astype(np.int32) for _ in range(240)]
    labels = np.array([int((t < 12).any()) for t in texts])
    labels[::9] ^= 1
    net = toxicity.train(texts, labels)
    languages = ["en" if i % 2 else None if i % 5 == 0 else "de" for i in range(240)]
    monkeypatch.setattr(toxicity, "MIN_POSITIVE", 10)
    toxicity.calibrate(net, texts, labels, languages)
    x = np.array([net.logits(t, np.array([0, len(t)]), net.tables())[0] for t in texts])

    def loss(a, b):
        z = a * x + b
        return float(np.where(labels == 1, np.logaddexp(0, -z), np.logaddexp(0, z)).sum() + (a - 1) ** 2 / 2)

    a, b = net.scale
    least = loss(a, b)
    assert all(loss(a + i * 0.01, b + j * 0.01) >= least - 1e-6 for i in (-1, 0, 1) for j in (-1, 0, 1))
    scores = net.scores(x)
    for language in ("en", "de"):
        own = np.array([v == language for v in languages])
        f1 = lambda t, own=own: 2 * (labels[own] * (scores[own] >= t)).sum() / ((scores[own] >= t).sum() + labels[own].sum())
        assert f1(net.thresholds[language]) == pytest.approx(max(f1(t) for t in scores[own]))
    assert set(net.thresholds) == {"en", "de"}


def test_toxicity_edges(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    net = toxicity.learn(docs(spark), none, F.lit(True))
    got = toxicity.score(docs(spark), net, carry=("text", "__x")).collect()
    assert len(got) == len(EDGES) and all(r.score == 0 for r in got)
    one_kind = toxicity.learn(docs(spark), spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id long, toxic int"), F.lit(True))
    assert one_kind.rate == 1.0
    assert toxicity.score(docs(spark, []), net).count() == 0


def test_toxicity_learns_every_labelled_row(spark):
    """Rows beyond any number of smallest hashes count: here they alone are toxic."""
    ids = spark.range(8600).withColumnRenamed("id", "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
    late = {r.doc_id for r in ids.collect()[8000:]}
    rows = [(i, f"w{i % 97} w{i % 89} {'vile' if i in late else 'mild'} w{i % 83}", "en") for i in range(8600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i in late)) for i in range(8600)], "doc_id long, toxic int")
    got = toxicity.score(df, toxicity.learn(df, labels, F.lit(True))).collect()
    assert all((r.score >= 0.5) == (r.doc_id in late) for r in got)


def test_toxicity_shards_are_averaged_as_by_hand(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 100)
    monkeypatch.setattr(toxicity, "EPOCHS", 2)
    rows = toxic_corpus(500, 3)
    df = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    df = df.withColumn("at", F.xxhash64("doc_id", F.lit(2))).withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0)
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    got = toxicity.learn(df, labels, F.lit(True))
    again = toxicity.learn(df.repartition(5), labels.repartition(3), F.lit(True))
    own = sorted(df.where("NOT calibrates").join(labels, "doc_id").collect(), key=lambda r: r["at"])
    n = -(-len(own) // 100)
    assert n > 2

    def numbers(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return toxicity.word_ids(data, np.array([0, len(data)]))[0]

    shards = [([numbers(r.text) for r in own if r["at"] % n == k], np.array([r.toxic for r in own if r["at"] % n == k])) for k in range(n)]
    net, past = toxicity.begin(sum(toxicity.count_words(*x) for x in shards))
    for number in range(2):
        after = []
        for k, (texts, toxic) in enumerate(shards):
            after.append(copy.deepcopy((net, past)))
            toxicity.epoch(*after[-1], texts, toxic, np.random.default_rng((toxicity.SEED, k, number)).permutation(len(texts)))
        moved = np.array([(a.embedding != net.embedding).any(axis=1) | (p.embedding != past.embedding).any(axis=1) for a, p in after])
        for i, x in enumerate((net, past)):
            change = sum(a[i].embedding.astype(float) - x.embedding for a in after)
            x.embedding = (x.embedding + change / np.maximum(moved.sum(axis=0), 1)[:, None]).astype(np.float32)
            for held in ("filters", "bias"):
                for k in toxicity.WIDTHS:
                    getattr(x, held)[k] = np.mean([getattr(a[i], held)[k] for a in after], axis=0)
            x.out, x.offset = np.mean([a[i].out for a in after], axis=0), float(np.mean([a[i].offset for a in after]))
    assert np.allclose(got.embedding, net.embedding, atol=1e-4) and np.allclose(got.out, net.out, atol=1e-4) and got.offset == pytest.approx(net.offset, abs=1e-4)
    assert all(np.allclose(got.filters[k], net.filters[k], atol=1e-4) and np.allclose(got.bias[k], net.bias[k], atol=1e-4) for k in toxicity.WIDTHS)
    assert np.array_equal(got.embedding, again.embedding) and got.scale == again.scale and got.thresholds == again.thresholds


def test_toxicity_long_texts_are_learned_in_windows(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 50, n).astype(np.int32) for n in (0, 3, 200, 7, 1, 64, 0, 31)]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    net, _ = toxicity.begin(toxicity.count_words(texts, np.array([0, 1] * 4)))
    ids, starts, begins = toxicity.padded(np.concatenate(texts), first)
    whole = [toxicity.peaks(net, ids, starts, begins, k) for k in toxicity.WIDTHS]
    monkeypatch.setattr(toxicity, "PIECE", 16)
    for k, (at, top) in zip(toxicity.WIDTHS, whole, strict=True):
        cut_at, cut_top = toxicity.peaks(net, ids, starts, begins, k)
        assert np.allclose(top, cut_top, atol=1e-6)
        ids_at = np.stack([ids[at + o] for o in range(k)]), np.stack([ids[cut_at + o] for o in range(k)])
        assert np.array_equal(*ids_at)


def test_toxicity_calibration_of_a_table_is_that_of_lists(spark, monkeypatch):
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 60, rng.integers(1, 12)).astype(np.int32) for _ in range(300)]
    labels = np.array([int((t < 12).any()) for t in texts])
    labels[::7] ^= 1
    languages = ["en" if i % 2 else None if i % 5 == 0 else "de" if i % 3 else "fr" for i in range(300)]
    monkeypatch.setattr(toxicity, "MIN_POSITIVE", 25)
    net = toxicity.train(texts, labels)
    x = [float(net.logits(t, np.array([0, len(t)]), net.tables())[0]) for t in texts]
    table = spark.createDataFrame(list(zip(languages, labels.tolist(), x, strict=True)), "lang string, toxic int, x float")
    tabled = copy.deepcopy(net)
    toxicity.calibrate_rows(tabled, work(spark).save(table.repartition(6), "rows"), work(spark))
    toxicity.calibrate(net, texts, labels, languages)
    assert tabled.scale == pytest.approx(net.scale, abs=1e-5)
    assert tabled.thresholds == pytest.approx(net.thresholds, abs=1e-5) and len(net.thresholds) >= 2


# 9 language identification


def test_languages_from_text_and_evidence(spark):
    samples = {"en": "the house and the garden of the town with many people", "de": "das haus und der garten der stadt mit vielen menschen", "fr": "la maison et le jardin de la ville avec beaucoup de gens"}
    rng = random.Random(1)
    rows = []
    for i in range(300):
        lang = rng.choice(list(samples))
        x = samples[lang].split()
        rng.shuffle(x)
        rows.append((i, " ".join(x[: rng.randrange(4, 10)]), lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    assert model.languages == ["de", "en", "fr"]
    pages = [(r[0], r[1], "en" if r[0] % 10 == 0 else r[2], f"{r[2]}.example.org", "org") for r in rows] + [(900, "12 34", "de", "de.example.org", "org"), (901, None, None, None, None), (902, "ok", None, "fr.example.org", "org")]
    p = spark.createDataFrame(pages, "page_id long, body string, declared string, host string, tld string")
    got = {r.page_id: r for r in language_id.identify(p, model, work(spark), key_cols=("page_id",), text_col="body", declared=F.col("declared"), suffix=F.col("tld"), host=F.col("host")).collect()}
    assert len(got) == len(pages) and sum(got[r[0]].language == r[2] for r in rows) / len(rows) > 0.98
    assert got[900].rejected and got[901].rejected and got[902].language == "fr" and not any(got[r[0]].rejected for r in rows)


def test_fusion_against_brute_force(spark):
    """Posteriors of rows with all kinds of evidence, recomputed in Python from the text model's log likelihoods."""
    rng = random.Random(21)
    table = np.log(np.random.default_rng(2).dirichlet(np.full(1 << language_id.TABLE_BITS, 0.5), 3)).astype(np.float32)
    model = language_id.TextModel(["a", "b", "c"], table)
    bodies = [t or "1 2" for t in random_texts(120, seed=22, most=6)] + ["12 34", None, "!"]
    rows = [(i, t, rng.choice(["a", "b", "zz", None]), rng.choice(["org", "de", None]), rng.choice(["h1", "h1", "h1", "h2", "h3", None])) for i, t in enumerate(bodies)]
    p = spark.createDataFrame(rows, "page_id long, body string, d string, s string, h string")
    got = {r.page_id: r for r in language_id.identify(p, model, work(spark), key_cols=("page_id",), text_col="body", declared=F.col("d"), suffix=F.col("s"), host=F.col("h")).collect()}

    def soft(x):
        e = np.exp(np.array(x) - max(x))
        return e / e.sum()

    logs, own = {}, {}
    for i, t, *_ in rows:
        data = np.frombuffer((t or "").encode(), np.uint8)
        logs[i] = np.zeros(3) if not len(data) else table[:, language_id.trigram_slots(data, np.array([len(data)]))].astype(float).sum(axis=1) / math.sqrt(len(data))
        if any(c.isalpha() for c in t or ""):
            own[i] = soft(logs[i])
    k, n = language_id.SMOOTHING, len(own)
    everyone = (sum(own.values()) + 1) / (n + 3)

    def level(keep, above):
        mine = [own[i] for i in own if keep(rows[i])]
        return (sum(mine) + k * above) / (len(mine) + k) if mine else None

    for i, t, d, s, h in rows:
        prior = everyone
        if s is not None or h is not None:
            same = [r for r in rows if r[0] in own and r[3] == s and r[4] == h]
            if same:
                if s is not None:
                    prior = level(lambda r: r[3] == s, everyone)  # noqa: B023
                if h is not None:
                    prior = level(lambda r: r[3] == s and r[4] == h, prior)  # noqa: B023
        x = logs[i] + np.log(prior)
        declared = [own[j] for j in own if rows[j][2] == d]
        if d is not None and declared:
            x = x + np.log((sum(declared) + k * len(declared) / n) / (sum(own.values()) + k))
        want = soft(x)
        assert got[i].posterior == pytest.approx(want.max(), abs=1e-6) and got[i].language == "abc"[int(want.argmax())]
        assert got[i].rejected == (i not in own or want.max() < language_id.MIN_POSTERIOR)


def test_every_language_is_fitted_from_rows_of_its_own(spark):
    rows = [(i, f"w{i} text", f"l{i % 230:03d}" if i < 2000 else "huge") for i in range(6000)] + [(9999, "only row", "rare")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df, rows=300)
    assert len(model.languages) == 232 and {"rare", "huge", "l229"} <= set(model.languages)


def test_windows_of_trigrams_change_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    model = language_id.TextModel(["a", "b"], np.log(rng.dirichlet(np.ones(1 << language_id.TABLE_BITS), 2)).astype(np.float32))
    data = rng.integers(60, 130, 1000).astype(np.uint8)
    at = np.array([0, 0, 7, 500, 500, 998, 1000])
    whole = model.log_likelihoods(data, at)
    cut = language_id._slot_windows
    monkeypatch.setattr(language_id, "_slot_windows", lambda d, a, size=37: cut(d, a, size))
    assert np.allclose(model.log_likelihoods(data, at), whole)


def test_language_edges(spark):
    unlabelled = language_id.fit(docs(spark).withColumn("lang", F.lit(None).cast("string")))
    got = language_id.identify(docs(spark), unlabelled, work(spark), key_cols=("doc_id",), text_col="text").collect()
    assert len(got) == len(EDGES) and all(r.rejected and r.language is None for r in got)
    model = language_id.fit(docs(spark))
    got = language_id.identify(docs(spark), model, work(spark), key_cols=("doc_id", "keep_id"), text_col="text", declared=F.col("lang"), host=F.col("source")).collect()
    assert len(got) == len(EDGES) and {r.doc_id for r in got if r.rejected} >= {4, 5, 6}
    assert language_id.identify(docs(spark, []), model, work(spark), key_cols=("doc_id",), text_col="text").count() == 0


# 10 language-model scores


def spellings(word, units):
    """Sum over all ways to spell a word with units {string: probability}."""
    total = [1.0] + [0.0] * len(word)
    for j in range(1, len(word) + 1):
        total[j] = sum(total[i] * units.get(word[i:j], 0.0) for i in range(j))
    return total[-1]


@pytest.mark.parametrize("classes", [1, 2, 6])
def test_scores_against_a_direct_computation(spark, classes):
    texts = [t or "empty" for t in random_texts(30, seed=4, vocabulary=40, most=25)]
    rows = [(i, t, ["en", "de", None, "fr"][i % 4]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in lm_scoring.score(df, work(spark), F.col("doc_id") % 5 != 1, UNIGRAM_VOCABULARY, classes=classes).collect()}
    seen = collections.Counter(lang for i, _, lang in rows if i % 5 != 1)
    top = [k for k in sorted(seen, key=lambda k: (-seen[k], k or "")) if k][: classes - 1]
    name = lambda lang: lang if lang in top else "rest"
    count, ends = collections.defaultdict(collections.Counter), collections.Counter()
    for i, t, lang in rows:
        if i % 5 != 1:
            count[name(lang)].update(words(t))
            ends[name(lang)] += 1
    every, texts_learned = sum(count.values(), collections.Counter()), sum(ends.values())
    tokens, distinct = sum(every.values()) + texts_learned, len(every) + 1
    for i, t, _ in rows:
        x = words(t)
        base = sum(math.log10((every[w] + 0.5) / (tokens + 0.5 * (distinct + 1))) for w in x) + math.log10((texts_learned + 0.5) / (tokens + 0.5 * (distinct + 1)))
        assert got[i].base_score == pytest.approx(base) and got[i].n_tokens == len(x) + 1 and got[i].train_tokens == tokens
        assert got[i].n_known == sum(every[w] > 0 for w in x) + 1
    vocab = lattice.vocabulary(UNIGRAM_VOCABULARY)
    pieces = {}
    for k in count:
        log_p = vocab.log_p
        for _ in range(lm_scoring.EM_STEPS):
            c = lattice.expected_counts([b" " + w for w in count[k]], vocab, log_p) + lm_scoring.PIECE_FLOOR * (vocab.log_p > -np.inf)
            with np.errstate(divide="ignore"):
                log_p = np.log(c / (c.sum() + len(count[k])))
        pieces[k] = log_p
    for i in (0, 1, 6, 11):
        per_class = []
        for k in count:
            n, closed = sum(count[k].values()) + ends[k], 1 - np.exp(pieces[k]).sum()
            units = {vocab.pieces[j].replace("\u2581", " ").encode(): math.exp(pieces[k][j]) for j in np.flatnonzero(np.isfinite(pieces[k])) if not vocab.pieces[j].startswith("<0x")}
            p = math.log(ends[k] / n) + math.log(ends[k] / texts_learned)
            for w in words(texts[i]):
                p += math.log(max(count[k][w] - lm_scoring.DISCOUNT, 0) / n + lm_scoring.DISCOUNT * len(count[k]) / n * closed * spellings(b" " + w, units))
            per_class.append(p)
        assert got[i].score == pytest.approx(np.logaddexp.reduce(per_class) / math.log(10), abs=1e-3)


def spellings(word, units):
    """Sum over all ways to spell a word with units {string: probability}."""
    total = [1.0] + [0.0] * len(word)
    for j in range(1, len(word) + 1):
        total[j] = sum(total[i] * units.get(word[i:j], 0.0) for i in range(j))
    return total[-1]


def test_arcs_of_a_word_and_the_end_sum_to_one():
    """Over known words, the arc into the pieces (whose spellings sum to one) and the end; with and without training."""
    vocab = lattice.vocabulary(UNIGRAM_VOCABULARY)
    counts = np.array([[1], [5], [2], [100]])
    facts = lm_scoring.Facts(np.array([counts.sum() + 9.0]), np.array([4.0]), np.array([9.0]), 5)
    names = [b"the", b"house", b"gardening", b"x"]
    log_p = np.log(np.exp(vocab.log_p[None]) * 0.7)
    with_words, without = (np.exp(facts.prices(names, c, vocab, log_p))[0] for c in (counts, 0 * counts))
    spelled = np.exp(lattice.log_likelihoods([b" " + w for w in names], vocab, log_p))[0] * 0.3
    into = without / spelled
    assert np.allclose(into, into[0]) and (with_words - without).sum() + into[0] + math.exp(facts.end_log_p(0)) == pytest.approx(1)
    nothing = lm_scoring.Facts(np.zeros(1), np.zeros(1), np.zeros(1), 0)
    into = np.exp(nothing.prices(names, 0 * counts, vocab, log_p))[0] / spelled
    assert into[0] + math.exp(nothing.end_log_p(0)) == pytest.approx(1)


def test_score_edges(spark):
    got = lm_scoring.score(docs(spark), work(spark), F.col("doc_id") != 9, UNIGRAM_VOCABULARY).collect()
    assert len(got) == len(EDGES) and sum(r.doc_id is None for r in got) == 1 and all(math.isfinite(r.score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (4, 5, 6)} == {1}
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1 and len({r.score for r in got if r.doc_id == 9}) == 1
    nothing = lm_scoring.score(docs(spark), work(spark), F.lit(False), UNIGRAM_VOCABULARY, class_col=None).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) and math.isfinite(r.base_score) for r in nothing)
    assert lm_scoring.score(docs(spark, []), work(spark), F.lit(True), UNIGRAM_VOCABULARY).count() == 0


def test_chunks_of_texts_take_little_memory(monkeypatch):
    """A task keeps neither a chunk's texts nor an object a word, and no row holds a whole chunk; words and counts stay exact."""
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 8 << 20)
    monkeypatch.setattr(lm_scoring, "TaskContext", type("Context", (), {"get": lambda: type("Task", (), {"partitionId": lambda _: 0})()}))
    rng = np.random.default_rng(6)
    vocabulary = np.array([f"Word{i}" for i in range(50_000)])
    texts = ["" if i % 500 == 3 else " ".join(vocabulary[rng.zipf(1.3, 1000) % len(vocabulary)]) for i in range(1500)]
    rows = [
        pa.record_batch([pa.array(range(lo, lo + 100)), pa.array([i % 3 for i in range(lo, lo + 100)], pa.int32()), pa.array(texts[lo : lo + 100])], names=["row", "k", "text"])
        for lo in range(0, len(texts), 100)
    ]
    tracemalloc.start()
    for _ in lm_scoring._chunks(2)(rows):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    count, text_of, named, largest = [collections.Counter(), collections.Counter()], {}, {}, 0
    for r in (r for batch in lm_scoring._chunks(2)(rows) for r in batch.to_pylist()):
        if r["texts"] is None:
            named[r["chunk"], r["local"]] = r["word"]
            for k in range(2):
                count[k][r["word"]] += r[f"c{k}"]
            continue
        n = int(np.frombuffer(r["texts"], np.int64, 1)[0])
        first = np.frombuffer(r["texts"], np.int64, n + 1, 16 + 16 * n)
        local = np.frombuffer(r["texts"], np.int32, -1, 16 + 16 * n + 8 * (n + 1))
        text_of |= {i: (r["chunk"], local[a:b]) for i, a, b in zip(np.frombuffer(r["texts"], np.int64, n, 16), first[:-1], first[1:], strict=True)}
        largest = max(largest, len(r["texts"]))
    assert len(text_of) == len(texts) and len({c for c, _ in text_of.values()}) > 1
    for i, (chunk, local) in text_of.items():
        assert [named[chunk, j] for j in local] == words(texts[i])
    for k in range(2):
        assert +count[k] == collections.Counter(w for i, t in enumerate(texts) if i % 3 == k for w in words(t))
    assert largest < 1 << 20 and peak < 40 << 20


def test_digests_are_plain_sha256(spark):
    df = docs(spark).select(F.sha2(exact_dedup.normalised(F.col("text")), 256).alias("h"), "text")
    assert all(r.h == hashlib.sha256(lower(r.text).encode()).hexdigest() for r in df.collect())
