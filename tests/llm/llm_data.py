"""Small inputs of the tests in this folder."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # further columns whose names the operators use inside
                     T.StructField("size", T.LongType()), T.StructField("cut", T.StringType()),
                     T.StructField("_weight", T.DoubleType()), T.StructField("_content", T.LongType()),
                     T.StructField("id", T.LongType()), T.StructField("_one", T.LongType())])


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, len(text or ""), 7, "x", 0.5, 1, 2, 3)


PROSE = ("the quick brown fox jumps over the lazy dog while many small birds sing in the tall green trees near "
         "the river and children play with a red ball on the wide lawn until the evening sun goes down behind hills "
         "then everyone walks home to eat warm soup with bread and talk about what happened during that long day").split()


def words(seed, n):
    """n seeded words, hardly ever repeating in the same order."""
    import random
    r = random.Random(seed)
    return " ".join(f"{r.choice(PROSE)}{r.randrange(50)}" for _ in range(n))


#: Edge rows: nulls in every column, empty, blank, short, long and repeated texts, ties.
def edge_rows():
    long_text = words(1, 30_000)
    return [(None, None, None, None), (1, "", None, "s"), (2, " \n\t ", "en", None), (3, "one", "en", "s"),
            (4, long_text, "de", "t"), (5, long_text, "de", "t"), (5, long_text, "de", "t"), (6, words(2, 80), "en", "s"),
            (6, words(3, 80), "en", "s"), (None, words(2, 80), "en", "s"), (7, "one", "en", "s"), (8, None, "en", "s")]
