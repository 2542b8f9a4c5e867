"""A whole tokenizer in the encoder's place."""

import pytest

from labelkiln.operators import features as FE

public_tokenizers = pytest.importorskip("public_tokenizers")
pytest.importorskip("tokenizers")

TEXTS = ["Hello brave new world, hello!", "", None, "naïve café 中文 42", "word " * 300, "x"]


def library():
    """The loading function, shipped to the workers by value."""
    def load(data):
        import tokenizers
        tok = tokenizers.Tokenizer.from_buffer(data)
        return lambda texts: [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    return load


def test_ids_equal_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = FE.TokenizerFile(spark, path, library())
    with open(path, "rb") as f:
        direct = library()(f.read())
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k long, text string").repartition(3)
    got = {r["k"]: r for r in FE.encode(df, ["k"], "text", None, None, 32, pad_token=7, tokenizer=tok, specials=(1, 2)).collect()}
    for k, text in enumerate(TEXTS):
        ids = [1, *direct([text or ""])[0][:30], 2]
        assert got[k]["input_ids"] == ids + [7] * (32 - len(ids)), k
        assert got[k]["attention_mask"] == [1] * len(ids) + [0] * (32 - len(ids))
    windows = FE.encode(df, ["k"], "text", None, None, 32, tokenizer=tok, specials=(1, 2), overflow="windows")
    joined = {}
    for r in sorted(windows.collect(), key=lambda r: (r["k"], r["window"])):
        n = sum(r["attention_mask"])
        joined.setdefault(r["k"], []).extend(r["input_ids"][1: n - 1])
    assert joined == {k: direct([t or ""])[0] for k, t in enumerate(TEXTS)}


def test_pairs_and_empty_output(spark):
    df = spark.createDataFrame([(1, "a b", None), (2, "", "c")], "k long, a string, b string")
    got = {r["k"]: r["input_ids"] for r in FE.encode(df, ["k"], "a", "b", None, 8, tokenizer=lambda: lambda ts: [[] for _ in ts],
                                                     specials=(101, 102)).collect()}
    assert got == {1: [101, 102, 102, 0, 0, 0, 0, 0], 2: [101, 102, 102, 0, 0, 0, 0, 0]}
    with pytest.raises(Exception, match="id lists"):
        FE.encode(df, ["k"], "a", None, None, 8, tokenizer=lambda: lambda ts: [[1]] * (len(ts) + 1)).collect()


def test_large_files_are_refused(spark, tmp_path):
    (tmp_path / "t.bin").write_bytes(b"x" * 100)
    with pytest.raises(ValueError, match="larger"):
        FE.TokenizerFile(spark, str(tmp_path / "t.bin"), library(), max_bytes=50)
