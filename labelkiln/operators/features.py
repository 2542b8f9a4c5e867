"""Text -> fixed-length token features.

``encode`` is row-local: the words of a text (a column expression) go through one
Arrow UDF that turns a batch's word arrays into piece ids -- each different word
of the batch is looked up once, the ids are gathered by index -- and array
functions truncate, wrap and pad them. The vocabulary is a size-checked broadcast
table. Nothing is exploded, shuffled or grouped, so a row's key plays no part:
repeated and null keys are rows of their own, and all columns ride along.

With ``overflow='truncate'`` only the first ``budget`` words of a segment can
survive (each word yields at least one piece), so later words are not looked up
and piece counts are capped at the budget, which leaves the result exact. With
``overflow='windows'`` (single texts) the whole text is encoded, one row per
window of ``budget`` pieces.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from labelkiln.session import cut_lineage
from labelkiln.sources.tasks import CLASSIFICATION, REGRESSION

WORD_SPLIT = "[^\\p{L}\\p{N}]+"
# Special tokens and their ids.
PAD, UNK, CLS, SEP = "[PAD]", "[UNK]", "[CLS]", "[SEP]"
SPECIAL_IDS = {PAD: 0, UNK: 1, CLS: 2, SEP: 3}
MAX_WORD_CHARS = 100
MAX_VOCAB = 200_000
#: Words of a batch that are looked up together.
WORDS = 1 << 18


def words(text: Column) -> Column:
    """Lower-cased words of the whole text (letters and digits), no empties."""
    return F.filter(F.split(F.lower(text), WORD_SPLIT), lambda w: w != "")


# ------------------------------------------------------------------ vocab --
def build_vocab(texts: DataFrame, text_col: str = "text", top_words: int = 500,
                top_suffixes: int = 100) -> DataFrame:
    """Vocabulary ``piece, piece_id`` from a corpus: specials (0-3), then every
    letter and its ``##`` form (sorted), the ``top_words`` most frequent words
    (count desc, word asc) and ``##`` + the ``top_suffixes`` most frequent 2-3
    letter word endings; a piece keeps its first id. Counting is a distributed
    aggregation; only bounded tables (letters, top-k lists) reach the final
    ordering."""
    spark = texts.sparkSession
    # one scan of the corpus: word counts, cut from the lineage in the shared
    # checkpoint folder so the four derived tables below do not rescan the text
    wc = (texts.select(F.explode(F.split(F.lower(F.col(text_col)), WORD_SPLIT)).alias("word"))
          .filter(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))
    wc = cut_lineage(wc)
    letters = wc.select(F.explode(F.split("word", "")).alias("ch")).filter(F.col("ch") != "").distinct()
    top_w = wc.orderBy(F.col("cnt").desc(), F.col("word")).limit(top_words)
    suf = wc.select(F.explode(F.array(
        F.when(F.length("word") > 2, F.substring("word", -2, 2)),
        F.when(F.length("word") > 3, F.substring("word", -3, 3)))).alias("suf"), "cnt") \
        .filter(F.col("suf").isNotNull()).groupBy("suf").agg(F.sum("cnt").alias("cnt"))
    top_s = suf.orderBy(F.col("cnt").desc(), F.col("suf")).limit(top_suffixes)
    special = spark.createDataFrame([(0, i, p) for p, i in SPECIAL_IDS.items()], "grp int, rk bigint, piece string")
    cand = (special
            .unionByName(letters.select(F.lit(1).alias("grp"), F.lit(0).cast("bigint").alias("rk"),
                                        F.col("ch").alias("piece")))
            .unionByName(letters.select(F.lit(2).alias("grp"), F.lit(0).cast("bigint").alias("rk"),
                                        F.concat(F.lit("##"), "ch").alias("piece")))
            .unionByName(top_w.select(F.lit(3).alias("grp"), F.col("cnt").cast("bigint") * -1, F.col("word"))
                         .toDF("grp", "rk", "piece"))
            .unionByName(top_s.select(F.lit(4).alias("grp"), F.col("cnt").cast("bigint") * -1,
                                      F.concat(F.lit("##"), "suf")).toDF("grp", "rk", "piece")))
    first = cand.groupBy("piece").agg(F.min(F.struct("grp", "rk", "piece")).alias("k"))
    # bounded: 4 + 2 x alphabet + top_words + top_suffixes rows
    w = Window.orderBy("k")
    return first.select("piece", (F.row_number().over(w) - 1).cast("int").alias("piece_id"))


def collect_vocab(vocab: DataFrame, limit: int = MAX_VOCAB) -> dict[str, int]:
    """The vocabulary as a driver dict for the tokenizer UDF; its size is
    checked, it is a parameter-bounded table, not data."""
    rows = vocab.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"vocabulary exceeds {limit} pieces")
    return {r["piece"]: r["piece_id"] for r in rows}


class Vocab:
    """A built vocabulary, computed once: the piece -> id dict (shipped to the
    tokenizer) and the same table as a small local DataFrame (for lookups)."""

    def __init__(self, spark, mapping: dict[str, int]):
        self.map = mapping
        self.df = spark.createDataFrame(sorted(mapping.items(), key=lambda kv: kv[1]),
                                        "piece string, piece_id int")
        self.max_piece = max((len(p) for p in mapping), default=1)

    @classmethod
    def of(cls, vocab_df: DataFrame, limit: int = MAX_VOCAB) -> "Vocab":
        return cls(vocab_df.sparkSession, collect_vocab(vocab_df, limit))


# -------------------------------------------------------------- wordpiece --
def greedy_pieces(word: str, vocab: dict[str, int], unk: int = 1, max_chars: int = MAX_WORD_CHARS,
                  max_piece: int | None = None) -> list[int]:
    """Greedy longest-match-first subwords; continuation pieces carry '##'; a
    word with an unmatched part (or longer than max_chars) is one [UNK].
    ``max_piece`` (longest vocabulary entry) only skips lookups that cannot hit."""
    if len(word) > max_chars:
        return [unk]
    out, start = [], 0
    span = max_piece or len(word)
    while start < len(word):
        end, hit = min(len(word), start + span), None
        while end > start:
            piece = word[start:end] if start == 0 else "##" + word[start:end]
            if piece in vocab:
                hit = vocab[piece]
                break
            end -= 1
        if hit is None:
            return [unk]
        out.append(hit)
        start = end
    return out


class PieceTrie:
    """Greedy longest-match-first pieces in one pass over a word.

    A trie of the vocabulary without and with the continuation mark; each node knows
    where to go on when its next letter has no child: the pieces that a greedy reader
    would have cut off by then (``pops``), and the node of what is left of the letters read
    (``fail``). Both follow from the parent's, breadth first, so no letter of a word is
    read again however long its pieces are. A node from which the rest cannot be cut into
    pieces fails for good."""

    def __init__(self, vocab: dict[str, int]):
        # node 0 begins a word, node 1 continues one
        self.next: list[dict[str, int]] = [{}, {}]
        piece: list[int | None] = [None, None]
        for text, i in vocab.items():
            inner = text.startswith("##") and len(text) > 2
            for at in ([(1, text[2:])] if inner else []) + [(0, text)]:
                node, rest = at
                for c in rest:
                    if c not in self.next[node]:
                        self.next[node][c] = len(piece)
                        self.next.append({})
                        piece.append(None)
                    node = self.next[node][c]
                if rest:
                    piece[node] = i
        self.fail: list[int | None] = [None] * len(piece)
        self.pops: list[list[int]] = [[] for _ in piece]
        queue = [0, 1]
        for node in queue:  # grows: breadth first
            for c, child in self.next[node].items():
                queue.append(child)
                if piece[child] is not None:  # all letters read are one piece
                    self.fail[child], self.pops[child] = 1, [piece[child]]
                    continue
                pops, at = list(self.pops[node]), self.fail[node]
                while at is not None and c not in self.next[at]:
                    pops += self.pops[at]
                    at = self.fail[at]
                if at is not None:
                    self.fail[child], self.pops[child] = self.next[at][c], pops

    def pieces(self, word: str, unk: int = 1, max_chars: int = MAX_WORD_CHARS) -> list[int]:
        """Piece ids of a word, ``[unk]`` where no pieces make it up or it is too long."""
        if len(word) > max_chars:
            return [unk]
        out, node, fail, pops, nxt = [], 0, self.fail, self.pops, self.next
        for c in word:
            while c not in nxt[node]:
                if fail[node] is None:
                    return [unk]
                out += pops[node]
                node = fail[node]
            node = nxt[node][c]
        while word and node != 1:  # the end: what is left must be pieces
            if fail[node] is None:
                return [unk]
            out += pops[node]
            node = fail[node]
        return out


def _as_vocab(vocab) -> "Vocab":
    return vocab if isinstance(vocab, Vocab) else Vocab.of(vocab)


def _word_function(spark, v: "Vocab", piece_fn=None):
    """() -> (word -> piece ids) for use in workers: greedy WordPiece over a trie of the
    broadcast vocabulary, built once per worker, or a caller's ``piece_fn(word) ->
    list[int]``."""
    if piece_fn is not None:
        return lambda: lambda w: [int(i) for i in piece_fn(w)]
    name = "pieces", hashlib.sha256(repr(sorted(v.map.items())).encode()).hexdigest()
    bc = spark.sparkContext.broadcast(v.map)
    unk = SPECIAL_IDS[UNK]

    def function():
        if name not in _BUILT:
            _BUILT[name] = PieceTrie(bc.value)
        trie = _BUILT[name]
        return lambda w: trie.pieces(w, unk)

    return function


def pieces_udf(spark, vocab, piece_fn=None):
    """Arrow UDF array<string> -> array<int>: the pieces of all words, in order."""
    function = _word_function(spark, vocab, piece_fn)

    def some(words: pa.Array) -> pa.Array:
        coded = words.flatten().dictionary_encode()
        of = function()
        each = [of(w) for w in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        flat = np.fromiter((i for ids in each for i in ids), np.int32, int(sizes.sum()))
        which = coded.indices.to_numpy(zero_copy_only=False)
        n = sizes[which]
        ends = np.r_[0, np.cumsum(n)]
        take = np.arange(ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], n)
        counts = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        rows = np.r_[0, np.cumsum(counts)].astype(np.int64)
        return pa.ListArray.from_arrays(pa.array(ends[rows].astype(np.int32)), pa.array(flat[take]))

    def tokenize(words: pa.Array) -> pa.Array:
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        ends = np.cumsum(words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        out, lo = [], 0
        while lo < len(words):  # about WORDS words (one row at least) at a time
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + WORDS, "right")))
            out.append(some(words.slice(lo, hi - lo)))
            lo = hi
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))

    return F.arrow_udf(tokenize, "array<int>")


def wordpiece_ids(distinct_words: DataFrame, vocab, word_col: str = "word") -> DataFrame:
    """``word, ids`` for a table of words."""
    ids = pieces_udf(distinct_words.sparkSession, _as_vocab(vocab))
    return distinct_words.select(word_col, ids(F.array(word_col)).alias("ids"))


def segment_pieces(df: DataFrame, text_cols: list[str], vocab, budget: int | None, splitter=words,
                   piece_fn=None) -> DataFrame:
    """``df`` with ``ids_<i>`` (piece ids of the first ``budget`` words of text i,
    in order; all words without a budget) and ``n_<i>`` (their number, at most the
    budget). ``splitter`` (Column -> array<string> Column) is the pluggable word
    step; a null text has no words."""
    tokenize = pieces_udf(df.sparkSession, vocab, piece_fn)
    out = df
    for i, tc in enumerate(text_cols):
        ws = F.coalesce(splitter(F.col(tc)), F.array().cast("array<string>"))
        out = out.withColumn(f"ids_{i}", tokenize(F.slice(ws, 1, budget) if budget else ws))
    for i in range(len(text_cols)):
        if budget:
            out = out.withColumn(f"ids_{i}", F.slice(f"ids_{i}", 1, budget))
        out = out.withColumn(f"n_{i}", F.size(f"ids_{i}"))
    return out


class TokenizerFile:
    """A whole tokenizer as a file: its bytes go to the workers once, and each worker
    builds the batch function ``load(bytes) -> (list of texts -> list of id lists)`` once."""

    def __init__(self, spark, path: str, load, max_bytes: int = 64 << 20):
        with open(path, "rb") as f:
            data = f.read(max_bytes + 1)
        if len(data) > max_bytes:
            raise ValueError(f"{path} is larger than {max_bytes} bytes")
        self._name, self._load, self._data = hashlib.sha256(data).hexdigest(), load, spark.sparkContext.broadcast(data)

    def __call__(self):
        """The batch function, kept per worker."""
        key = self._name, getattr(self._load, "__qualname__", repr(self._load))
        if key not in _BUILT:
            _BUILT[key] = self._load(self._data.value)
        return _BUILT[key]


_BUILT: dict = {}


def text_ids_udf(tokenizer):
    """Arrow UDF string -> array<int> of a tokenizer: a function without arguments that
    gives the batch function (a ``TokenizerFile``, say). A null text is an empty one; a
    text may have no ids at all; the first id list of another length than the batch's
    number of texts is an error."""

    def tokenize(texts: pa.Array) -> pa.Array:
        given = texts.fill_null("").to_pylist()
        ids = tokenizer()(given)
        if len(ids) != len(given):
            raise ValueError(f"the tokenizer gave {len(ids)} id lists for {len(given)} texts")
        return pa.array([list(map(int, i)) for i in ids], pa.list_(pa.int32()))

    return F.arrow_udf(tokenize, "array<int>")


def text_pieces(df: DataFrame, text_cols: list[str], tokenizer, budget: int | None) -> DataFrame:
    """``df`` with ``ids_<i>`` and ``n_<i>`` as ``segment_pieces`` gives them, by a whole
    tokenizer instead of words and pieces."""
    ids, out = text_ids_udf(tokenizer), df
    for i, tc in enumerate(text_cols):
        got = ids(F.col(tc))
        out = out.withColumn(f"ids_{i}", F.slice(got, 1, budget) if budget else got).withColumn(f"n_{i}", F.size(f"ids_{i}"))
    return out


# ----------------------------------------------------------------- encode --
def _fill(v: int, n: Column) -> Column:
    return F.array_repeat(F.lit(v), n)


def pack(a: Column, b: Column | None, max_length: int, pad_on_left: bool = False, pad_token: int = 0,
         pad_token_segment_id: int = 0, mask_padding_with_zero: bool = True,
         specials: tuple[int, int] | None = None) -> list[Column]:
    """[CLS] a [SEP] (b [SEP]) -> (input_ids, attention_mask, token_type_ids),
    each padded to ``max_length``. ``a``/``b`` are already truncated; ``specials`` are
    the ids of the two marks where they are not the vocabulary's own."""
    cls, sep = (F.array(F.lit(i)) for i in specials or (SPECIAL_IDS[CLS], SPECIAL_IDS[SEP]))
    if b is None:
        ids = F.concat(cls, a, sep)
        types = _fill(0, F.size(a) + 2)
    else:
        ids = F.concat(cls, a, sep, b, sep)
        types = F.concat(_fill(0, F.size(a) + 2), _fill(1, F.size(b) + 1))
    n = F.size(ids)
    pad_n = F.lit(max_length) - n
    real, padv = (1, 0) if mask_padding_with_zero else (0, 1)
    mask = _fill(real, n)
    pads = (_fill(pad_token, pad_n), _fill(padv, pad_n), _fill(pad_token_segment_id, pad_n))
    if pad_on_left:
        return [F.concat(pads[0], ids), F.concat(pads[1], mask), F.concat(pads[2], types)]
    return [F.concat(ids, pads[0]), F.concat(mask, pads[1]), F.concat(types, pads[2])]


def truncate_pair(na: Column, nb: Column, budget: int) -> tuple[Column, Column]:
    """Longest-first truncation in closed form: tokens are removed one at a
    time from the longer segment (from the second on ties) until both fit."""
    fits = (na + nb) <= F.lit(budget)
    ka = F.least(na, F.greatest(F.lit(budget) - nb, F.lit((budget + 1) // 2)))
    return (F.when(fits, na).otherwise(ka), F.when(fits, nb).otherwise(F.lit(budget) - ka))


def encode(df: DataFrame, key_cols: list[str], text_a: str, text_b: str | None, vocab,
           max_length: int = 512, pad_on_left: bool = False, pad_token: int = 0, pad_token_segment_id: int = 0,
           mask_padding_with_zero: bool = True, splitter=words, piece_fn=None,
           carry_cols: list[str] = (), overflow: str = "truncate", tokenizer=None,
           specials: tuple[int, int] | None = None) -> DataFrame:
    """``key_cols, carry_cols, input_ids, attention_mask, token_type_ids`` (array<int>
    of ``max_length``) for single texts or text pairs, one row per input row.
    ``splitter`` replaces the word step (any Column -> array<string> expression);
    ``piece_fn`` replaces the subword step (a Python ``word -> list[int]``). Either
    way each word must yield at least one id. ``tokenizer`` replaces both (see
    ``text_ids_udf``; ``vocab`` is not read then, and ``specials`` are its ids of the
    two marks). ``overflow='windows'`` gives a single
    text one row per window of pieces instead of its beginning, with ``window``
    (0, 1, ...); a text without words is one window."""
    texts = [text_a] + ([text_b] if text_b else [])
    budget = max_length - (3 if text_b else 2)
    if overflow not in ("truncate", "windows") or (overflow == "windows" and text_b):
        raise ValueError(f"overflow {overflow!r} with {len(texts)} texts")
    whole = overflow == "windows"
    room = None if whole else budget
    seg = (text_pieces(df, texts, tokenizer, room) if tokenizer is not None
           else segment_pieces(df, texts, _as_vocab(vocab), room, splitter, piece_fn))
    extra = []
    if whole:
        last = F.greatest(F.ceil(F.col("n_0") / budget) - 1, F.lit(0)).cast("int")
        seg = seg.withColumn("window", F.explode(F.sequence(F.lit(0), last)))
        a, b, extra = F.slice("ids_0", F.col("window") * budget + 1, F.lit(budget)), None, ["window"]
    elif text_b:
        ka, kb = truncate_pair(F.col("n_0"), F.col("n_1"), budget)
        a, b = F.slice("ids_0", F.lit(1), ka), F.slice("ids_1", F.lit(1), kb)
    else:
        a, b = F.col("ids_0"), None
    cols = pack(a, b, max_length, pad_on_left, pad_token, pad_token_segment_id, mask_padding_with_zero, specials)
    return seg.select(*key_cols, *carry_cols, *extra, cols[0].alias("input_ids"), cols[1].alias("attention_mask"),
                      cols[2].alias("token_type_ids"))


def length_check(features: DataFrame, max_length: int) -> Column:
    """True when all three arrays have exactly ``max_length`` entries."""
    return ((F.size("input_ids") == max_length) & (F.size("attention_mask") == max_length)
            & (F.size("token_type_ids") == max_length))


def assert_lengths(features: DataFrame, max_length: int) -> DataFrame:
    """Fails the job on the first row with a wrong length."""
    return features.withColumn("_ok", F.assert_true(length_check(features, max_length),
                                                     f"feature length differs from {max_length}")).drop("_ok")


# ----------------------------------------------------------------- labels --
def label_ids(examples: DataFrame, labels: tuple[str, ...] | None, mode: str,
              on_unseen: str = "fail", label_col: str = "label") -> DataFrame:
    """classification: ``label_id`` = position in the label list; regression:
    ``label_value`` = the label as a double (a bad number fails, ANSI cast).
    An unseen class label fails the job (``on_unseen='fail'``) or gets a null
    id (``'quarantine'``; filter ``label_id IS NULL`` for the quarantine)."""
    lab = F.col(label_col)
    if mode == CLASSIFICATION:
        pos = F.array_position(F.array(*[F.lit(x) for x in labels]), lab)
        if on_unseen == "fail":
            lid = F.when(pos > 0, pos - 1).otherwise(
                F.raise_error(F.concat(F.lit("unseen label: "), F.coalesce(lab, F.lit("null")))).cast("bigint"))
        elif on_unseen == "quarantine":
            lid = F.when(pos > 0, pos - 1)
        else:
            raise ValueError(on_unseen)
        return examples.withColumn("label_id", lid.cast("bigint")).withColumn(
            "label_value", F.lit(None).cast("double"))
    if mode == REGRESSION:
        return examples.withColumn("label_id", F.lit(None).cast("bigint")).withColumn(
            "label_value", lab.cast("double"))
    raise KeyError(mode)


def pad_count(ids: Column, pad_token: int = 0) -> Column:
    """Number of padding ids in a row, at least 1."""
    return F.greatest(F.lit(1), F.size(F.filter(ids, lambda x: x == pad_token)))


def convert_examples_to_features(examples: DataFrame, labels: tuple[str, ...] | None, mode: str, vocab,
                                 max_length: int = 512, on_unseen: str = "fail", pair: bool | None = None,
                                 **encode_kw) -> DataFrame:
    """Examples ``set_type, row_idx, guid, text_a, text_b, label`` -> features
    ``set_type, row_idx, guid, input_ids, attention_mask, token_type_ids,
    label_id, label_value``: pair encoding when ``text_b`` is present in any
    row (a null ``text_b`` encodes as an empty second segment), single-text
    otherwise; one feature row per example, also for repeated or null guids; every
    row is checked to have ``max_length`` entries."""
    has_b = pair if pair is not None else examples.filter(F.col("text_b").isNotNull()).limit(1).count() > 0
    keys = ["set_type", "row_idx", "guid"]
    feats = encode(examples, keys, "text_a", "text_b" if has_b else None, vocab, max_length,
                   carry_cols=["label"], **encode_kw)
    out = label_ids(assert_lengths(feats, max_length), labels, mode, on_unseen)
    return out.select("set_type", "row_idx", "guid", "input_ids", "attention_mask", "token_type_ids",
                      "label_id", "label_value")
