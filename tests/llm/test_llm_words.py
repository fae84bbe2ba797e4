"""The vectorised words, shingles and hashes agree with plain Python."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.llm import langid
from tallyfold.llm.quality import indicators
from tallyfold.llm.words import ngram_hashes, shingle_sets, split_words, text_slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_shingles(text, n=5):
    w = plain_words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


texts = st.lists(st.one_of(st.none(), st.text("aB \t\n.é漢0", max_size=40)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(texts, st.integers(1, 60))
def test_words_and_shingles(rows, limit):
    seen, covered = {}, []
    for row, end, data, offsets in text_slices(pa.array(rows, pa.string()), limit):
        words = split_words(data, offsets)
        h, first = shingle_sets(words)
        for i, text in enumerate(rows[row:end]):
            expected = plain_words(text)
            got = words.hash[words.first[i] : words.first[i + 1]]
            assert len(got) == len(expected)
            for w, x in zip(expected, got):
                assert seen.setdefault(w, x) == x
            assert first[i + 1] - first[i] == len(plain_shingles(text))
        covered += range(row, end)
    assert covered == list(range(len(rows)))
    assert len(set(map(int, seen.values()))) == len(seen)


def test_ngrams_stay_inside_documents():
    data = pa.array(["a b c", "", "d e", None, "f"])
    _, _, buffer, offsets = next(text_slices(data))
    h, doc = ngram_hashes(split_words(buffer, offsets), 2)
    assert doc.tolist() == [0, 0, 2] and len(set(h.tolist())) == 3


def test_letters_of_other_scripts():
    _, _, data, offsets = next(text_slices(pa.array(["Éa1 漢😀", "ß"])))
    c, first = langid.letters(data, offsets)
    assert [chr(x) if x else " " for x in c] == ["é", "a", " ", " ", "漢", " ", "ß"]
    assert first.tolist() == [0, 6, 7]
    for _, at in langid.ngram_buckets(c, first):
        assert np.all(at < len(c))


def test_slices_bound_the_memory_of_a_worker():
    """A slice's arrays are many times as large as its texts: two tasks of an executor hold those of one slice each."""
    data = pa.array(["word and other words " * 100] * 2_000)
    peak = 0
    for _, _, buffer, offsets in text_slices(data):
        split_words(buffer, offsets)  # makes the table of powers, which stays
        tracemalloc.start()
        indicators(buffer, offsets)
        peak = max(peak, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert 0 < peak < 30 << 20
