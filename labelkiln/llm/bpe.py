"""BPE encoding and decoding with a public tokenizer file.

Encoding is by backtracking: at each position the longest vocabulary token is
proposed by an Aho-Corasick automaton and kept only if it is compatible with
the token before it (greedy merging would not merge across their border);
otherwise the next shorter token is tried, then the last token is taken back.
A bitmap of dead ends makes the walk linear, and the result equals that of
applying the merges in rank order. Decoding gathers token bytes from one
buffer through an offset table.

Normalisation and word splitting follow the file: NFC, white space runs to one
space, lower case, pieces by the file's pattern, bytes as printable characters,
a word-end mark on each piece's last byte.

Null text is the empty text: no ids, decoded as ''. Texts of any length are
encoded whole; equal pieces are encoded once per worker. The special tokens'
strings inside a text are single ids, as in the library.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkiln.llm.common import spare

#: One character that stands for the word-end mark; private use, so no byte maps to it.
END = ""
#: Pieces remembered per worker; beyond it the memory is emptied (results do not change).
MEMO_PIECES = 1 << 18
#: ASCII marks that are pieces of their own after a letter.
MARKS = frozenset(".,;:!?")
#: Bytes of text that are split into words at a time.
BLOCK_BYTES = 4 << 20
#: Rows handed on at a time by ``encode_decode``.
ROWS = 512
#: Ids gathered at a time when decoding.
GATHER = 1 << 20


def byte_characters() -> list[str]:
    """The printable character of each byte: printable Latin-1 bytes stand for
    themselves, the others take the code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in out:
            out[b], spare = chr(spare), spare + 1
    return [out[b] for b in range(256)]


def late_letters() -> frozenset[str]:
    """Code points that are letters or numbers to the regex module but that
    Python's own Unicode tables do not assign yet; to the library most of them
    are neither."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    return frozenset(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")


class Vocabulary:
    """Merge tables, matcher and offset table of one tokenizer file."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        mark = (lambda s: s[: -len(self.suffix)] + END if self.suffix and s.endswith(self.suffix) and s != self.suffix
                else s)
        ids = {mark(s): i for s, i in vocab.items()}
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.special_re = (regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))))
                           if self.specials else None)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # the pattern's \s is Unicode White_Space; Python's also takes the separators 1C-1F
        self.pattern = split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.pieces_of = regex.compile(self.pattern).findall
        self.late = late_letters()
        self.bytes_of = byte_characters()

        # (left, right) -> (rank, merged id), and how each merged token came about
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            left, right, both = ids[mark(a)], ids[mark(b)], ids[mark(a + b)]
            self.pair.setdefault((left, right), (rank, both))
            self.made.setdefault(both, (rank, left, right))

        self.matcher = ahocorasick.Automaton()
        base = {c for c in self.bytes_of} | {c + END for c in self.bytes_of}
        usable = {s: i for s, i in ids.items() if s in base or i in self.made}
        top = max(usable.values()) + 1
        self.size, self.shorter = [0] * top, [-1] * top  # the next shorter token with the same beginning
        for s, i in usable.items():
            self.size[i] = len(s)
            self.matcher.add_word(s, (i, len(s) - 1))
            self.shorter[i] = next((j for n in range(len(s) - 1, 0, -1) if (j := usable.get(s[:n])) is not None), -1)
        self.matcher.make_automaton()
        self.compatible_memo: dict[int, bool] = {}

        everything = {i: s for s, i in vocab.items()} | {i: s for s, i in self.specials.items()}
        coded = [everything.get(i, "").encode() for i in range(max(everything) + 1)]
        self.buffer = np.frombuffer(b"".join(coded), np.uint8)
        self.offsets = np.zeros(len(coded) + 1, np.int64)
        np.cumsum([len(c) for c in coded], out=self.offsets[1:])
        self.memo: dict[str, bytes] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether greedy merging leaves ``left`` and ``right`` side by side.

        Walks back through the merges that built the two tokens, latest first,
        looking at the two symbols that touch the border at each moment: a
        merge of those two that comes earlier than the merges that consumed
        them would have crossed the border. Equal ranks are applied from the
        left, so at a tie the left token's own merge comes first and the right
        token's comes last."""
        key = left << 24 | right
        known = self.compatible_memo.get(key)
        if known is None:
            if len(self.compatible_memo) >= MEMO_PIECES:
                self.compatible_memo.clear()
            known = self.compatible_memo[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        before = float("inf")  # the crossing merge must come strictly before this rank
        while True:
            crossing = self.pair.get((left, right))
            if crossing is not None and crossing[0] < before:
                return False
            l_made, r_made = self.made.get(left), self.made.get(right)
            if l_made is None and r_made is None:
                return True
            # the merge done last is undone first; at equal ranks the right one is the later
            if r_made is None or (l_made is not None and l_made[0] > r_made[0]):
                before, left = l_made[0], l_made[2]
            else:
                before, right = r_made[0] + 0.5, r_made[1]

    def longest_matches(self, s: str) -> list[int]:
        """The longest token that starts at each position (-1: none), from one
        pass of the automaton; matches come by their end, so the last is the longest."""
        best = [-1] * (len(s) + 1)
        for end, (token, back) in self.matcher.iter(s):
            best[end - back] = token
        return best

    def encode_piece(self, piece: str) -> list[int]:
        if piece.isascii() and piece.isprintable():  # these bytes stand for themselves
            s = piece
        else:
            s = "".join(map(self.bytes_of.__getitem__, piece.encode("utf-8", "surrogatepass")))
        s = s + END if self.suffix else s
        longest, n, size, shorter, known = self.longest_matches(s), len(s), self.size, self.shorter, self.compatible_memo
        dead: set[int] = set()
        out: list[int] = []
        at, token, before = 0, longest[0], -1
        while at < n:
            while token >= 0:
                if at + size[token] not in dead:
                    if before < 0:
                        break
                    fits = known.get(before << 24 | token)
                    if fits or fits is None and self.compatible(before, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += size[token]
                before, token = token, longest[at]
            else:  # nothing fits here: never come back to this position
                dead.add(at)
                if not out:
                    raise ValueError(f"no encoding of {piece!r} in this vocabulary")
                token = out.pop()
                at -= size[token]
                before, token = out[-1] if out else -1, shorter[token]
        return out

    def pieces(self, word: str) -> list[str]:
        """The pieces of a normalised word."""
        if word.isalpha():  # as Python's tables have it, so without the late letters
            return [word]
        if word[:-1].isalpha() and " " < word[-1] < "\x80" and not word[-1].isalnum():
            return [word[:-1], word[-1]]
        if self.late.isdisjoint(word):
            return self.pieces_of(word)
        late = f"[{''.join(sorted(self.late.intersection(word)))}]"
        pattern = self.pattern
        for name in (r"\p{L}", r"\p{N}"):
            pattern = pattern.replace(name, f"[{name}--{late}]")
        return regex.findall(pattern, word, regex.V1)

    def encode_word(self, word: str) -> bytes:
        """Ids (int32) of a text without spaces."""
        low, memo = word.lower(), self.memo
        if "Σ" not in word:  # known pieces, alone or before a mark, need no further look
            ids = memo.get(low)
            if ids is not None:
                return ids
            if low[-1:] in MARKS and low[-2:-1].isalpha():
                ids, mark = memo.get(low[:-1]), memo.get(low[-1])
                if ids is not None and mark is not None:
                    return ids + mark
        if self.special_re is not None and self.special_re.search(word):
            parts, at = [], 0
            for m in self.special_re.finditer(word):  # the parts between hold none
                parts += [self.encode_word(word[at : m.start()]), np.int32(self.specials[m[0]]).tobytes()]
                at = m.end()
            return b"".join([*parts, self.encode_word(word[at:])])
        if not word.isascii():  # a capital sigma is lowered without regard to its place in the word
            low = unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()
        out = b""
        for piece in self.pieces(low):
            ids = memo.get(piece)
            if ids is None:
                if len(memo) >= MEMO_PIECES:
                    memo.clear()
                ids = memo[piece] = array("i", self.encode_piece(piece)).tobytes()
            out += ids
        return out

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text. Pieces never reach over a space, and neither do
        composition, lowering and special tokens, so the words between spaces
        are told apart first and each different word is encoded once."""
        parts, at = [], 0
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BLOCK_BYTES, "right")))
            parts.append(self._encode_block(texts.slice(at, to - at)))
            at = to
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    def _encode_block(self, texts: pa.Array) -> pa.ListArray:
        spaced = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        words = pc.split_pattern(spaced, " ")
        coded = words.flatten().dictionary_encode()
        each = [self.encode_word(w) for w in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
        flat = np.frombuffer(b"".join(each), np.int32)
        which = coded.indices.to_numpy()
        n = sizes[which]
        ends = np.r_[0, np.cumsum(n)]
        take = np.arange(ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], n)
        offsets = words.offsets.to_numpy()
        return pa.ListArray.from_arrays(pa.array(ends[offsets - offsets[0]].astype(np.int32)), pa.array(flat[take]))

    def decode(self, ids: np.ndarray) -> str:
        """Token strings joined by single spaces (the file names no decoder)."""
        parts = []
        for at in range(0, len(ids), GATHER):
            block = ids[at : at + GATHER]
            start, size = self.offsets[block], self.offsets[block + 1] - self.offsets[block] + 1
            ends = np.cumsum(size)
            take = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
            got = self.buffer[np.minimum(take, len(self.buffer) - 1)]
            got[ends - 1] = 0x20
            parts.append(got.tobytes())
        return b"".join(parts)[:-1].decode("utf-8")


_LOADED: dict[str, Vocabulary] = {}


def load(spec: str) -> Vocabulary:
    """The tables of a tokenizer file's content, built once per worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(spec)
    return _LOADED[key]


class Bpe:
    """Column functions ``encode`` and ``decode`` for one tokenizer file.

    The file is read on the driver and broadcast (its size is that of a
    vocabulary, checked against ``max_bytes``), so executors need no copy."""

    def __init__(self, spark: SparkSession, path: str, max_bytes: int = 64 << 20):
        with open(path, encoding="utf-8") as f:
            spec = f.read()
        if len(spec) > max_bytes:
            raise ValueError(f"{path} is larger than {max_bytes} bytes")
        shared = spark.sparkContext.broadcast(spec)

        def encode(texts: pa.Array) -> pa.Array:
            return load(shared.value).encode(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts)

        def decode(ids: pa.Array) -> pa.Array:
            v = load(shared.value)
            if isinstance(ids, pa.ChunkedArray):
                ids = ids.combine_chunks()
            values, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            return pa.array([v.decode(values[a:b]) if ok else None
                             for a, b, ok in zip(offsets[:-1], offsets[1:], ids.is_valid().to_pylist())], pa.string())

        def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            v = load(shared.value)
            for b in batches:
                for part in (b.slice(at, ROWS) for at in range(0, b.num_rows, ROWS)):
                    ids = v.encode(part.column(part.num_columns - 1))
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids, decode(ids)],
                                                     [*part.schema.names[:-1], "ids", "decoded"])

        self._both = both
        self._encode = F.arrow_udf(encode, "array<int>")
        self._decode = F.arrow_udf(decode, "string")

    def encode_decode(self, docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
        """The columns ``keep`` with ``ids`` and ``decoded`` (the text of the ids; either
        with underscores before it where a kept column is called so), in one pass
        through Python that hands on ``ROWS`` rows at a time."""
        inside = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)]
        columns = docs.select(*inside)
        schema = T.StructType([*columns.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
                               T.StructField("decoded", T.StringType())])
        coded = docs.select(*inside, F.col(f"`{text_col}`").alias("_text")).mapInArrow(self._both, schema)
        return coded.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)],
                            F.col("ids").alias(spare(keep, "ids")), F.col("decoded").alias(spare(keep, "decoded")))

    def encode(self, text: Column | str) -> Column:
        """Token ids of a text column (null: no ids)."""
        return self._encode(text)

    def decode(self, ids: Column | str) -> Column:
        """Text of an id array column (null: null). The ids pass through an
        expression of Spark's own, so that ids which are encoded in the same plan
        are computed once and not again as a part of this function."""
        ids = F.col(ids) if isinstance(ids, str) else ids
        return self._decode(F.when(ids.isNotNull(), ids))
