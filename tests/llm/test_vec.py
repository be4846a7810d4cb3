"""Batch text work against plain Python, text by text."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import vec

TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab1 \t\n\r\x0b\x0cé漢A_-\x1c"), max_size=30)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40), st.integers(1, 4))
def test_words_and_windows(texts, limit, width):
    seen, by_words = [], {}
    for row, data, offsets in vec.slices(pa.array(texts, pa.string()), limit):
        assert row == len(seen)
        start, end, first = vec.words(data, offsets, vec.NOT_SPACE)
        hashes = vec.span_hashes(data, start, end)
        windows, inside = vec.window_hashes(hashes, width), vec.window_starts(first, width)
        assert len(windows) == len(inside)
        for i in range(len(offsets) - 1):
            a, b = first[i], first[i + 1]
            seen.append([data[s:e].tobytes().decode() for s, e in zip(start[a:b], end[a:b])])
            assert inside[a:b].sum() == max(0, len(seen[-1]) - width + 1)
            for j in range(max(0, b - a - width + 1)):
                key = tuple(seen[-1][j:j + width])
                assert by_words.setdefault(key, windows[a + j]) == windows[a + j]
    assert seen == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert len(set(by_words.values())) == len(by_words)


def test_sliced_columns_and_runs_of_other_bytes():
    column = pa.array(["x y", "Ab-Cd 1é", None, "z"]).slice(1)
    (row, data, offsets), = vec.slices(column)
    low = vec.LOWER[data]
    start, end, first = vec.words(low, offsets, vec.ALNUM)
    assert [low[a:b].tobytes().decode() for a, b in zip(start, end)] == ["ab", "cd", "1é", "z"] and first.tolist() == [0, 3, 3, 4]
    assert list(vec.slices(pa.array([], pa.string()))) == []


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40), st.integers(1, 9))
def test_sliding_minimum(values, width):
    got = vec.sliding_min(np.array(values, np.uint64), width).tolist() if len(values) >= width else []
    assert got == [min(values[i:i + width]) for i in range(len(values) - width + 1)]
