"""Long texts don't push short ones out of the training sequences."""

from __future__ import annotations

import numpy as np

from pitval.llm import quality_lines


def test_each_sampled_text_keeps_a_piece():
    width = len(quality_lines.FEATURES)
    texts = [np.full((n, width), i, "<f4").tobytes() for i, n in enumerate([10, 2400, 10, 10, 2400, 24, 25])]
    kept = quality_lines._thinned(texts, 20)
    assert all(len(own) >= 1 for own in kept)
    assert sum(map(len, kept)) <= 20 + len(texts)
    assert [own[0][0, 0] for own in kept] == list(range(7))
    assert [len(own) for own in quality_lines._thinned(texts, 1000)] == [1, 100, 1, 1, 100, 1, 2]
