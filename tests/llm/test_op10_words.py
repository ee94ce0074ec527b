"""Words and shapes of the mixing classifier against a plain count."""

import numpy as np

from fraudmart.llm import op10_mixing as op10


def test_shapes_and_words_of_odd_texts():
    texts = [b"", b"  ", "HELLO a1 $x wow! -- plain\tÜber".encode(), b"A !", b"x" * (op10.PIECE + 1) + b" B2"]
    n, share = op10.shapes(texts)
    assert n.tolist() == [len(t.split()) for t in texts]
    assert np.allclose(share[2], np.array([1, 1, 1, 1, 1, 2]) / 7)  # none, symbol, capitals, digit, bang, other
    assert share[:2].sum() == 0 and np.allclose(share[3], [0.5, 0, 0, 0, 0, 0.5])
    assert op10.cores(b"The, the -- (end).") == {b"the", b"end"}
    assert op10.Softmax(2, ["the", "^endi"]).named(b"THE ending") == [0, 1]
