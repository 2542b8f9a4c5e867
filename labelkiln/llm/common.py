"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkiln.session import spread

#: Fixed value: the word pattern of the query contracts (ASCII white space splits words).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's reader (any file system), its
    scan spread over all cores when it has fewer splits than cores."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spare(columns: list[str], name: str) -> str:
    """``name``, or with underscores before it, so that it clashes with no column."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` cuts at exactly the ASCII
    white space that ``WORD`` excludes. Null: no words."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_count(text) -> "F.Column":
    """Number of words (JVM-side); null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def word_blocks(texts: pa.Array, block_bytes: int = 4 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """The words (ASCII white space splits) of runs of texts of about
    ``block_bytes``: ``(starts, which, distinct)`` where the i-th text's words are
    ``distinct[w] for w in which[starts[i]:starts[i + 1]]``. Null: no words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) if len(texts) else []
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + block_bytes, "right")))
        words = pc.ascii_split_whitespace(pc.fill_null(texts.slice(at, to - at), ""))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        which = coded.indices.to_numpy()
        starts = words.offsets.to_numpy().astype(np.int64)
        starts = starts - starts[0]
        if "" in distinct:  # leading and trailing white space leave empty words
            real = which != distinct.index("")
            starts = np.r_[0, np.cumsum(real)][starts]
            which = which[real]
        yield starts, which, distinct
        at = to


class WordTable:
    """Numbers computed once per word, found again by the word's 64-bit hash: sorted
    arrays of ``width`` numbers per word, a few bytes each, for up to ``most`` words
    (beyond that only the words of the present call stay)."""

    def __init__(self, width: int, dtype, most: int = 1 << 21):
        self.hashes, self.values, self.most = np.zeros(0, np.uint64), np.zeros((0, width), dtype), most

    def get(self, words: list[str], compute: Callable[[list[str]], np.ndarray]) -> np.ndarray:
        """One row per word; ``compute`` gives the rows of words not met before."""
        h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        at = np.searchsorted(self.hashes, h)
        old = at < len(self.hashes)
        old[old] = self.hashes[at[old]] == h[old]
        new, first = np.unique(h[~old], return_index=True)
        if len(new):
            fresh = np.flatnonzero(~old)[first]
            rows = np.asarray(compute([words[i] for i in fresh]), self.values.dtype).reshape(len(new), -1)
            if len(self.hashes) + len(new) > self.most:
                stay = np.unique(at[old])
                self.hashes, self.values = self.hashes[stay], self.values[stay]
            place = np.searchsorted(self.hashes, new)
            self.hashes, self.values = np.insert(self.hashes, place, new), np.insert(self.values, place, rows, axis=0)
        return self.values[np.searchsorted(self.hashes, h)]


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values[starts[i]:starts[i + 1]]``; 0 for an empty segment. Each sum
    depends on its own segment only, to the last bit."""
    out, some = np.zeros(len(starts) - 1), starts[1:] > starts[:-1]
    if some.any():
        out[some] = np.add.reduceat(values, starts[:-1][some])
    return out


def lookup(rows: DataFrame, keyed: DataFrame, on: list[str], least: int = 256) -> DataFrame:
    """Left join of ``rows`` (a written table: it is read twice) to ``keyed``, which has
    one row per key. A key held by more rows than a quarter of an even share of a
    partition (``least`` at least) is dealt over salts, its keyed row copied to each.
    At most four keys per shuffle partition can be that frequent, so their list is
    bounded and broadcast. Rows with a null key find nothing and are spread."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    limit = max(least, rows.count() // (4 * parts))
    hot = F.broadcast(rows.groupBy(*on).agg(F.count("*").alias("_n")).filter(F.col("_n") > limit)
                      .select(*on, F.ceil(F.col("_n") / limit).cast("int").alias("_salts")))
    spread_by, none = F.xxhash64(*rows.columns, F.monotonically_increasing_id()), F.lit(False)
    for c in on:
        none = none | F.col(c).isNull()
    dealt = rows.join(hot, on, "left").withColumn(
        "_salt", F.pmod(spread_by, F.when(none, 1 << 16).otherwise(F.coalesce("_salts", F.lit(1))))).drop("_salts")
    copies = keyed.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)).cast("long") - 1))).drop("_salts")
    return dealt.join(copies, [*on, "_salt"], "left").drop("_salt")
