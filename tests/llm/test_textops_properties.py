"""Words, shingles and attribution on generated texts."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.test_llm import lower
from weft.llm import lattice, sentencepiece_sampling, textops, token_counts
from weft.llm.ngram_join import shingle_sets
from weft.llm.queries import UNIGRAM_VOCABULARY

TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=60), st.text(" ab\n\tAé▁", max_size=60)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 64))
def test_spans_are_words(texts, size):
    column, got = pa.array(texts, pa.string()), []
    for _, _, data, at in textops.blocks(column, size):
        starts, ends, first = textops.spans(data, at)
        got += [[bytes(data[a:b]) for a, b in zip(starts[i:j], ends[i:j], strict=True)] for i, j in zip(first[:-1], first[1:], strict=True)]
    assert got == [(t or "").encode("utf-8").split() for t in texts]


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_shingles_are_those_of_the_words(texts, w):
    column, got = pa.array(texts, pa.string()), []
    for _, _, data, at in textops.blocks(column, 50):
        got += shingle_sets(data, at, w)
    by_hash = {}
    for t, s in zip(texts, got, strict=True):
        x = lower(t).encode().split()
        want = {tuple(x[k : k + w]) for k in range(len(x) - w + 1)} if len(x) >= w else ({(len(x), *x)} if x else set())
        assert len(s) == len(want)
        key = frozenset(want)
        assert by_hash.setdefault(tuple(s.tolist()), key) == key


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5), st.integers(1, 4))
def test_sampled_segmentations_spell_their_texts(texts, k):
    vocab = lattice.vocabulary(UNIGRAM_VOCABULARY)
    bodies = [b" " + t.encode() for t in texts]
    at = np.cumsum([0, *[len(b) for b in bodies]])
    keys = textops.mix(np.arange(len(texts), dtype=np.uint64))
    found = sentencepiece_sampling.sample_chunk(np.frombuffer(b"".join(bodies), np.uint8), at, keys, sentencepiece_sampling.Lexicon(vocab), k)
    for body, samples in zip(bodies, found, strict=True):
        ids = [tuple(s[0].tolist()) for s in samples]
        assert 1 <= len(ids) == len(set(ids)) <= k
        assert all(sentencepiece_sampling.decode(s[0], vocab).tobytes() == body for s in samples)
        assert all(0 < s[3] <= 1 or s[3] == 0 for s in samples) and [s[2] for s in samples] == sorted((s[2] for s in samples), reverse=True)


@settings(max_examples=100, deadline=None)
@given(st.text(" ab.!?\n", max_size=60))
def test_sentences_cover_the_text(text):
    body = np.frombuffer(text.encode(), np.uint8)
    borders = token_counts.sentence_borders(body)
    assert borders[0] == 0 and borders[-1] == len(body) and (np.diff(borders) > 0).all() or len(body) == 0


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 30))
def test_windows_change_no_word(texts, size):
    bodies = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"".join(bodies), np.uint8)
    at = np.cumsum([0, *map(len, bodies)])
    parts = list(textops.windows(data, at, size=size))
    assert [a for a, _ in parts] == [0, *[b for _, b in parts]][: len(parts)] and (not len(data) or parts[-1][1] == len(data))
    starts, ends, first = textops.spans(data, at)
    cut = set(at.tolist()) | {int(s) for s in starts} | {int(i) for i in np.flatnonzero(textops.WHITE[data])}
    assert all(a == 0 or a in cut for a, _ in parts)
    old = textops.windows
    textops.windows = lambda d, a, apart=textops.WHITE, s=size: old(d, a, apart, size)
    try:
        hashes, begin, end, index = textops.hashed_words(data, at)
    finally:
        textops.windows = old
    assert begin.tolist() == starts.tolist() and end.tolist() == ends.tolist() and index.tolist() == first.tolist()
    assert hashes.tolist() == textops.span_hash(textops.prefix_sums(data), starts, ends).tolist()


def test_a_long_text_takes_little_beside_its_words():
    import tracemalloc

    text = np.frombuffer(b"some words of a text that is long " * 240_000, np.uint8)  # 8 MB
    textops.hashed_words(text[:100_000], np.array([0, 100_000]))
    tracemalloc.start()
    hashes, *_ = textops.hashed_words(text, np.array([0, len(text)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * len(hashes) + 64 * textops.BLOCK_BYTES
