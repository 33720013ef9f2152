"""Hashes of slices, words and windows against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from bitextile.llm.common import ALPHANUMERIC, NOT_SPACE, TABLE, Slices, chunks, window_min, words


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=2, max_size=60), st.integers(1, 8))
def test_slices_hash_content(data, n):
    n = min(n, len(data))
    s = Slices(TABLE[np.frombuffer(data, np.uint8)])
    at = np.arange(len(data) - n + 1)
    h = s.hash(at, at + n)
    for i in range(len(at)):
        for j in range(i):
            assert (h[i] == h[j]) == (data[i : i + n] == data[j : j + n])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1 \t\n.é-_", max_size=30), max_size=8), st.integers(1, 20))
def test_words_never_cross_texts(texts, size):
    for member, split in ((NOT_SPACE, lambda t: t.encode().lower().split()), (ALPHANUMERIC, lambda t: "".join(c if c.isalnum() else " " for c in t).encode().lower().split())):
        seen, of = {}, []
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        for c in chunks(iter([batch]), size=size):
            ws = words(c, member)
            for i in range(c.n):
                of.append(ws.hashes[ws.first[i] : ws.first[i + 1]].tolist())
        assert [len(x) for x in of] == [len(split(t)) for t in texts]
        for h, w in ((h, w) for hs, t in zip(of, texts, strict=True) for h, w in zip(hs, split(t), strict=True)):
            assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=40), st.integers(1, 20))
def test_window_min(values, w):
    x = np.array(values, np.uint64)
    assert window_min(x, w).tolist() == [min(values[i : i + w]) for i in range(len(values) - w + 1)]
