"""Python steps hold a bounded part of their input, with the same results."""

import numpy as np
import pyarrow as pa

from labelkiln.operators import features as FE


def test_pieces_of_a_batch_in_parts(spark, monkeypatch):
    vocab = FE.Vocab(spark, {"[PAD]": 0, "[UNK]": 1, "[CLS]": 2, "[SEP]": 3, "a": 4, "b": 5, "##a": 6, "##b": 7})
    texts = pa.array([["ab", "a"], [], ["b"] * 9, None, ["c", "ba"]], pa.list_(pa.string()))
    udf = FE.pieces_udf(spark, vocab).func
    whole = udf(texts).to_pylist()
    monkeypatch.setattr(FE, "WORDS", 3)
    assert udf(texts).to_pylist() == whole == [[4, 7, 4], [], [5] * 9, [], [1, 5, 6]]
