"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel of two words sums over all their common subsequences of ``ORDER``
letters, weighted by ``DECAY`` to the power of the letters they span, and is
normalised. All subsequences count, whatever their gaps: an insult with letters put
in still holds every subsequence of the insult. Nystroem landmarks turn the kernel
into a feature vector (similarities to the landmarks, whitened by their own kernel
matrix), on which a linear machine is trained; there are landmarks on both sides, the
insults and the clean words most like them. Since the kernel is an inner product over
subsequences, the trained machine is one weight per subsequence of its landmarks: a
word's value is the sum over its own ones, found letter by letter in a trie, over the
word's norm. Inflected insults share a stem: a word's value is the highest of its own
and of its beginnings'.

Training is on sentences of labelled documents. A sentence's value is that of its
highest word, and which word that is follows from the machine itself (multiple
instances): sentences of toxic documents start with the word or stem whose numbers of
different contexts speak most for label 1, then the machine is fitted and the
sentences without such a word get their witness from it, and the highest words of all
clean documents of the sample are new negatives. Witnesses are also learned with up to
``MOST_INSERTED`` letters put in, and the border is placed by the documents' highest
values and by those of witnesses with one and two letters put in. A logistic curve
over the documents' highest values makes the score. Sentences serve to choose
witnesses only: a text's score is that of its highest word.

All of it is fitted on at most ``MAX_TOXIC`` + ``MAX_CLEAN`` labelled documents
(smallest id hash first, one row of each id); every document's whole text is scored.
Words of more than ``WIDEST`` letters are read in overlapping parts. Single letters
that stand apart in a row (``s c u m``) are also read as one word. Each different
word of a block is scored once.

Edge cases: null, empty and wordless texts get the score of the machine's bias;
repeated rows get equal scores; without labels of both kinds every score is 0; an
empty table gives no rows; labels, language, source and id are never features; an
input column called like the output is replaced by it.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import WordTable, word_blocks
from labelkiln.session import cut_lineage

#: Kernel: letters of a subsequence, decay per letter spanned.
ORDER, DECAY = 3, 0.98
#: Bounds of the fit: documents per label, speaking words, clean words, landmarks of each side, rounds.
MAX_TOXIC, MAX_CLEAN, MAX_WORDS, MAX_HARD, INSULTS, OTHERS, ROUNDS = 4000, 8000, 1000, 12_000, 40, 800, 2
#: A word speaks for a label from this evidence and odds on.
EVIDENCE, ODDS = 12.0, 4.0
#: Letters put into training insults, how many at most, forms of a word for each number.
INSERTED, MOST_INSERTED, FORMS = "abcdefghijklmnopqrstuvwxyz0", 3, 9
#: Letters up to which all triples of letters are one table.
MOST_LETTERS = 128
#: Score at which a text counts as toxic.
DECISION = 0.3
#: Lengths of stems; insults of inflected languages share one.
STEMS = (5, 6, 7, 8)
#: Sentences end at these marks or at a line's end; longer words are read in parts of this many letters.
SENTENCE_END, WIDEST = r"[.!?]+\s|\n", 32


def normal(word: str) -> str:
    """Lower-case letters and digits of a word."""
    word = word.lower()
    return word if word.isalpha() else "".join(filter(str.isalnum, word))


def windows(word: str) -> list[str]:
    """A long word as overlapping parts that cover it."""
    if len(word) <= WIDEST:
        return [word]
    return [word[i : i + WIDEST] for i in range(0, len(word) - WIDEST // 2, WIDEST // 2)]


class Subsequences:
    """All subsequences of ``ORDER`` = 3 letters of some words, as a trie: the letters,
    then the pairs, then the triples that occur. ``vectors`` has one decayed count per
    word and triple (column 0 is that of triples which do not occur)."""

    def __init__(self, words: list[str]):
        self.letters = {c: i for i, c in enumerate(sorted({c for w in words for c in w}), 1)}
        n = len(self.letters) + 1
        self.pairs, self.triples = np.zeros((n, n), np.int32), {}
        rows = [[self.letters[c] for c in w] for w in words]
        known: dict[tuple[int, int], int] = {}
        for w in rows:
            for i, j, _ in combinations(w, 3):
                self.pairs[i, j] = known.setdefault((i, j), len(known) + 1)
        self.ends = np.zeros((len(known) + 1, n), np.int32)
        cells = []
        for r, w in enumerate(rows):
            for i, j, k in combinations(range(len(w)), 3):
                at = self.pairs[w[i], w[j]], w[k]
                if not self.ends[at]:
                    self.ends[at] = self.ends.max() + 1
                cells.append((r, self.ends[at], DECAY ** (k - i + 1)))
        self.vectors = np.zeros((len(words), int(self.ends.max()) + 1))
        for r, c, v in cells:
            self.vectors[r, c] += v

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "vectors"}

    def _codes(self, words: list[str]) -> np.ndarray:
        """Letters of equally long words as numbers, a row per place; 0: none of the trie's."""
        text = "".join(words)
        known = np.fromiter((self.letters.get(c, 0) for c in text), np.int32, len(text))
        return np.ascontiguousarray(known.reshape(len(words), -1).T)

    def sums(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        """For each word the sum of ``weights`` (a row per triple) over its own decayed
        triples: with ``vectors.T`` the kernel with every word of the trie."""
        out = np.zeros((len(words), weights.shape[1]))
        by_length: dict[int, list[int]] = {}
        for r, w in enumerate(words):
            by_length.setdefault(len(w), []).append(r)
        flat = weights.shape[1] == 1 and len(self.pairs) <= MOST_LETTERS
        table = weights[:, 0][self.ends[self.pairs]].ravel() if flat else None  # a weight per three letters
        for length, rows in by_length.items():
            for at in range(0, len(rows), 1 << 14):
                part = np.array(rows[at : at + (1 << 14)])
                if length >= ORDER:
                    codes = self._codes([words[r] for r in part.tolist()])
                    out[part] = self._one_column(codes, table)[:, None] if flat else self._columns(codes, weights)
        return out

    def _one_column(self, codes: np.ndarray, table: np.ndarray) -> np.ndarray:
        """One weight per triple: looked up at once, added up by the letters spanned."""
        length, n = len(codes), len(self.pairs)
        spans = np.zeros((length + 1, codes.shape[1]))
        for i, j in combinations(range(length - 1), 2):
            pair = (codes[i] * n + codes[j]) * n
            for k in range(j + 1, length):
                spans[k - i + 1] += table[pair + codes[k]]
        return DECAY ** np.arange(length + 1) @ spans

    def _columns(self, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Many weights per triple: only triples of the trie are gone through."""
        total = np.zeros((codes.shape[1], weights.shape[1]))
        for i, j in combinations(range(len(codes) - 1), 2):
            pair = self.pairs[codes[i], codes[j]]
            some = np.flatnonzero(pair)
            if not len(some):
                continue
            below = self.ends[pair[some]]
            for k in range(j + 1, len(codes)):
                found = below[np.arange(len(some)), codes[k][some]]
                hit = np.flatnonzero(found)
                total[some[hit]] += weights[found[hit]] * DECAY ** (k - i + 1)
        return total


def self_kernel(words: list[str]) -> np.ndarray:
    """Kernel of each word with itself. Where no letter comes twice, only equal places
    match, and it follows from the length."""
    out = np.zeros(len(words))
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for length, rows in by_length.items():
        if length < ORDER:
            continue
        part = np.array(rows)
        c = np.frombuffer("".join([words[i] for i in rows]).encode("utf-32-le", "surrogatepass"), np.int32).reshape(-1, length)
        ordered = np.sort(c, axis=1)
        twice = np.flatnonzero((ordered[:, 1:] == ordered[:, :-1]).any(axis=1))
        out[part] = sum((length - s + 1) * comb(s - 2, ORDER - 2) * DECAY ** (2 * s) for s in range(ORDER, length + 1))
        if len(twice):
            out[part[twice]] = _self_kernel_rows(np.ascontiguousarray(c[twice].T))
    return out


def _self_kernel_rows(c: np.ndarray) -> np.ndarray:
    """The same by dynamic programming over equally long words (a row per place)."""
    length = len(c)
    held = np.zeros((ORDER, length, c.shape[1]))
    total = np.zeros(c.shape[1])
    for i in range(length):
        match = (c[i][None] == c) * DECAY**2
        for level in range(ORDER, 0, -1):
            hit = match.copy()
            if level > 1:
                hit[0] = 0
                hit[1:] *= held[level - 1][:-1]
            if level == ORDER:
                total += hit.sum(axis=0)
                continue
            for j in range(1, length):
                hit[j] += DECAY * hit[j - 1]
            held[level] = held[level] * DECAY + hit
    return total


def similarity(a: list[str], b: list[str]) -> np.ndarray:
    """Normalised kernel (0 for words shorter than a subsequence)."""
    trie = Subsequences(b)
    norm = np.sqrt(np.outer(self_kernel(a), self_kernel(b)))
    return np.divide(trie.sums(a, trie.vectors.T), norm, out=np.zeros(norm.shape), where=norm > 0)


class Machine:
    """Landmarks, weights over them, bias, and the logistic curve."""

    def __init__(self, landmarks: list[str]):
        self.landmarks, self.trie = landmarks, Subsequences(landmarks)
        self.unit = self.trie.vectors.T / np.sqrt(self_kernel(landmarks))  # a normalised landmark per column
        values, vectors = np.linalg.eigh(similarity(landmarks, landmarks))
        self.whiten = vectors / np.sqrt(np.maximum(values, 1e-3))
        self.curve = (0.0, 0.0)
        self.set_weights(np.zeros(len(landmarks)), -1.0)

    def set_weights(self, weights: np.ndarray, bias: float) -> None:
        """Weights of the landmarks; ``collapsed`` are those of their subsequences."""
        self.weights, self.bias, self.collapsed = weights, bias, self.unit @ weights[:, None]
        self.name = hashlib.sha256(repr((self.landmarks, weights.tolist(), bias)).encode()).hexdigest()

    def __getstate__(self) -> dict:
        """What scoring needs goes to the workers: trie and collapsed weights."""
        return {k: v for k, v in self.__dict__.items() if k not in ("landmarks", "unit", "whiten", "weights")}

    def _over_norm(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        norm = np.sqrt(self_kernel(words))[:, None]
        total = self.trie.sums(words, weights)
        return np.divide(total, norm, out=np.zeros(total.shape), where=norm > 0)

    def similarity(self, words: list[str]) -> np.ndarray:
        """Normalised kernel of words with the landmarks."""
        return self._over_norm(words, self.unit)

    def plain_values(self, words: list[str]) -> np.ndarray:
        """Value of each word as it is."""
        return self._over_norm(words, self.collapsed)[:, 0] + self.bias

    def fit(self, positive: np.ndarray, negative: np.ndarray, penalty: float = 1e-4, rounds: int = 400) -> None:
        """Linear machine with squared hinge loss on whitened similarities, both
        classes weighing the same, by accelerated gradient steps."""
        x = np.r_[positive, negative] @ self.whiten
        x = np.c_[x, np.ones(len(x))]
        y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
        share = np.r_[np.full(len(positive), 0.5 / len(positive)), np.full(len(negative), 0.5 / len(negative))]
        w = before = np.zeros(x.shape[1])
        step = 1 / (2 * np.linalg.eigvalsh(x.T @ (x * share[:, None]))[-1] + penalty)
        for t in range(rounds):
            ahead = w + t / (t + 3) * (w - before)
            slack = np.maximum(0, 1 - y * (x @ ahead))
            before, w = w, ahead - step * (penalty * ahead - 2 * x.T @ (share * y * slack))
        self.set_weights(self.whiten @ w[:-1], float(w[-1]))

    def values(self, words: list[str]) -> np.ndarray:
        """Value of each word: the highest of its parts and beginnings."""
        parts = [instances(w) for w in words]
        every = list(dict.fromkeys(p for ps in parts for p in ps))
        place = {p: i for i, p in enumerate(every)}
        value = self.plain_values(every)
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        return np.maximum.reduceat(value[[place[p] for ps in parts for p in ps]], starts) if len(words) else value

    def calibrate(self, value: np.ndarray, y: np.ndarray, grown: np.ndarray) -> None:
        """Logistic curve over document values: the slope by Newton steps with a small
        ridge, the place so that the border which parts the labels with the highest F1
        (the middle of its gap) scores ``DECISION``. Half of the toxic side are the
        documents, half the values ``grown`` of insults with letters put in."""
        middle, scale = value.mean(), value.std() or 1.0
        x = np.c_[(value - middle) / scale, np.ones(len(value))]
        w = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (p - y) + 0.1 * w * [1, 0]
            hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.1, 1e-6])
            w = w - np.linalg.solve(hessian, gradient)
        slope = max(float(w[0] / scale), 1e-3)
        v = np.r_[value, grown]
        toxic = np.r_[y, np.full(len(grown), y.sum() / max(1, len(grown)))]
        clean = np.r_[1 - y, np.zeros(len(grown))]
        order = np.argsort(-v, kind="stable")
        v, hits, wrong = v[order], np.cumsum(toxic[order]), np.cumsum(clean[order])
        f1 = 2 * hits / (hits + wrong + toxic.sum())
        f1[:-1][v[1:] == v[:-1]] = 0  # no border inside ties
        best = int(np.argmax(f1))
        border = (v[best] + v[best + 1]) / 2 if best + 1 < len(v) else v[best] - 1
        self.curve = (slope, float(np.log(DECISION / (1 - DECISION)) - slope * border))

    def score(self, value: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a * value + b, -500, 500)))


class Reader:
    """Highest word value per text, with the words' values remembered."""

    def __init__(self, machine: Machine):
        self.machine, self.table = machine, WordTable(1, np.float32)

    def word_values(self, words: list[str]) -> np.ndarray:
        return self.table.get(list(map(normal, words)), self.machine.values)[:, 0].astype(np.float64)

    def highest(self, texts: pa.Array) -> np.ndarray:
        parts = [np.zeros(0)]
        for starts, which, distinct in word_blocks(texts):
            value = np.r_[self.word_values(distinct), self.machine.bias]
            n = len(starts) - 1
            best = np.full(n, self.machine.bias)
            some = starts[1:] > starts[:-1]
            if some.any():
                best[some] = np.maximum(best[some], np.maximum.reduceat(value[which], starts[:-1][some]))
            for text, word in self._spelled(starts, which, distinct):
                best[text] = max(best[text], float(self.word_values([word])[0]))
            parts.append(best)
        return np.concatenate(parts)

    @staticmethod
    def _spelled(starts: np.ndarray, which: np.ndarray, distinct: list[str]) -> Iterator[tuple[int, str]]:
        """Runs of three or more single letters, as (text, word)."""
        single = np.array([len(normal(w)) == 1 for w in distinct], bool)[which] if len(which) else which
        at = np.flatnonzero(single)
        if not len(at):
            return
        text = np.searchsorted(starts, at, "right") - 1
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(text) != 0)) + 1
        for run, owner in zip(np.split(at, cut), np.split(text, cut)):
            if len(run) >= 3:
                yield int(owner[0]), "".join(normal(distinct[w]) for w in which[run])


_READERS: dict[str, Reader] = {}


def reader(key: str, machine: Machine) -> Reader:
    """One reader per machine and worker."""
    if key not in _READERS:
        _READERS.clear()
        _READERS[key] = Reader(machine)
    return _READERS[key]


def highest_value(text: Column | str, machine: Machine) -> Column:
    key = machine.name

    def udf(texts: pa.Array) -> pa.Array:
        return pa.array(reader(key, machine).highest(texts))

    return F.arrow_udf(udf, "double")(text)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """The batches in parts, since their texts become many small objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def stems(word: str) -> list[str]:
    """The beginnings of a word."""
    return [word[:n] for n in STEMS if len(word) > n]


def instances(word: str) -> list[str]:
    """What a word's value is taken over: its parts and beginnings."""
    return windows(word) + stems(word)


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, context, y): a slice's different words with the word before, and
    their beginnings with both."""
    for b in _slices(batches):
        found = set()
        for t, y in zip(b.column(0), b.column(1)):
            words = [w for w in map(normal, (t.as_py() or "").split()) if w]
            found.update(zip(words, ["", *words], [y.as_py()] * len(words)))
        rows = [(u, f"{before} {w}", y) for w, before, y in sorted(found) for u in (w, *stems(w))]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                          pa.array([r[1] for r in rows], pa.string()),
                                          pa.array([r[2] for r in rows], pa.int32())], ["unit", "context", "y"])


def _sentences(value_of):
    """(sentence, y): of each text the sentence whose highest word is highest by
    ``value_of`` (a list of words to their values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            texts = [[(s, words) for s in regex.split(SENTENCE_END, t.as_py() or "")
                      if (words := [w for w in map(normal, s.split()) if w])] for t in b.column(0)]
            every = sorted({w for parts in texts for _, words in parts for w in words})
            value = dict(zip(every, value_of(every)))
            best = [(max(parts, key=lambda p: max(map(value.__getitem__, p[1])))[0], y.as_py())
                    for parts, y in zip(texts, b.column(1)) if parts]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in best], pa.string()),
                                              pa.array([y for _, y in best], pa.int32())], ["sentence", "y"])

    return run


def training_documents(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str, text_col: str,
                       label_col: str) -> DataFrame:
    """``(text, y)`` of the bounded sample; ``allowed`` is over the label rows."""
    y = labels.filter(allowed & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    order = [F.xxhash64("id"), F.col("id")]
    some = y.filter("y = 1").orderBy(*order).limit(MAX_TOXIC).union(y.filter("y = 0").orderBy(*order).limit(MAX_CLEAN))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    met = texts.join(F.broadcast(some.distinct()), "id")  # bounded ids; one text of each, however often it is repeated
    return cut_lineage(met.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "y"),
                       "training")


def train(sample: DataFrame) -> Machine | None:
    """A machine from ``sample(text, y)``; None without both labels."""
    # a word counts once for each different word before it: copies of a text add nothing
    contexts = (sample.mapInArrow(_words_of, "unit string, context string, y int").filter(F.length("unit") >= ORDER)
                .groupBy(F.col("unit").alias("word"), "context").agg(F.max("y").alias("n1"), F.max(1 - F.col("y")).alias("n0")))
    counts = cut_lineage(contexts.groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), "words")
    all_ = counts.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).first()
    if not all_["n1"] or not all_["n0"]:
        return None
    odds = F.log((F.col("n1") + 0.5) / all_["n1"]) - F.log((F.col("n0") + 0.5) / all_["n0"])
    top = (counts.withColumn("odds", odds).withColumn("e", F.col("odds") * F.sqrt("n1"))
           .filter((F.col("e") >= EVIDENCE) & (F.col("odds") >= float(np.log(ODDS))))
           .orderBy(F.desc("e"), "word").limit(MAX_WORDS).select("word", "e").collect())
    speaks = {r["word"]: r["e"] for r in top}
    if not speaks:
        return None

    def best_unit(word):
        return max((speaks.get(u, 0.0), u) for u in (word, *stems(word)))

    def by_words(words):
        return [best_unit(w)[0] for w in words]

    got = sample.filter("y = 1").mapInArrow(_sentences(by_words), "sentence string, y int").collect()  # one per document
    toxic = [[w for w in map(normal, r["sentence"].split()) if w] for r in got]
    # all words of a toxic document's sentence that speak for label 1
    known = [u[:WIDEST] for s in toxic for e, u in map(best_unit, s) if e > 0]
    if not known:
        return None
    often = Counter(known)
    names = sorted(often, key=lambda w: (-often[w], w))
    insults = _spread(([w for w in names if len(w) <= 14] or names)[:400], INSULTS)

    # the clean words and beginnings most like an insult, common ones first: of the whole sample's vocabulary
    likeness = F.arrow_udf(lambda w: pa.array(similarity([x.as_py()[:WIDEST] for x in w], insults).max(axis=1)), "double")
    hard = (counts.filter("n0 > 0").withColumn("like", likeness("word"))
            .orderBy(F.desc(F.pow("like", 2) * F.sqrt("n0")), "word").limit(MAX_HARD).select("word").collect())
    negative = list(dict.fromkeys(w for r in hard if (w := r["word"][:WIDEST]) not in speaks))
    if not negative:
        return None
    machine = Machine(insults + [w for w in negative if w not in insults][:OTHERS])
    far, witness = machine.similarity(negative), known
    for _ in range(ROUNDS):
        machine.fit(machine.similarity(_positives(witness)), far)
        found = []
        for s in toxic:
            if s and not any(e > 0 for e, _ in map(best_unit, s)):
                every = sorted({p for w in s for p in instances(w)})
                value = machine.plain_values(every)
                found += [every[int(value.argmax())]] if value.max() > 0 else []
        witness = known + found

        key = machine.name

        def by_machine(words, machine=machine, key=key):
            return reader(key, machine).word_values(words).tolist()

        high = sample.filter("y = 0").mapInArrow(_sentences(by_machine), "sentence string, y int").collect()
        own = [[w for w in map(normal, r["sentence"].split()) if w] for r in high]
        every = sorted({p for s in own for w in s for p in instances(w)})
        value = dict(zip(every, machine.plain_values(every).tolist()))
        more = sorted({max((p for w in s for p in instances(w)), key=value.__getitem__) for s in own if s}
                      .difference(negative, witness, speaks))
        if more:
            negative = negative + more
            far = np.r_[far, machine.similarity(more)]
    machine.fit(machine.similarity(_positives(witness)), far)
    judged = sample.select("y", highest_value("text", machine).alias("v")).toPandas()  # bounded sample
    grown = machine.values([f for n in (1, 2) for f in inserted(witness, n, FORMS)])
    machine.calibrate(judged["v"].to_numpy(), judged["y"].to_numpy(), grown)
    return machine


def inserted(words: list[str], letters: int, forms: int, seed: int = 0) -> list[str]:
    """The different words of five letters and more, ``forms`` times each, with
    ``letters`` seeded letters put in at seeded places inside them."""
    rng = np.random.default_rng([seed, letters])
    out = []
    for w in sorted({w for w in words if len(w) >= 5}):
        for _ in range(forms):
            grown = w
            for _ in range(letters):
                i = int(rng.integers(1, len(grown)))
                grown = grown[:i] + INSERTED[rng.integers(len(INSERTED))] + grown[i:]
            out.append(grown)
    return out


def _positives(words: list[str]) -> list[str]:
    """The different words (once for each number of letters), and longer ones
    again with letters put in."""
    return sorted({*words}) * MOST_INSERTED + [f for n in range(1, MOST_INSERTED + 1) for f in inserted(words, n, FORMS)]


def _spread(words: list[str], most: int) -> list[str]:
    """Landmarks: the first word, then always the one least like those chosen
    (weighted by its place), so that they cover all kinds of words."""
    s = similarity(words, words)
    chosen, near = [0], s[:, 0].copy()
    weight = 1 / np.sqrt(1 + np.arange(len(words)))
    while len(chosen) < min(most, len(words)):
        nxt = int(np.argmax(np.where(np.isin(np.arange(len(words)), chosen), -1, (1 - near) * weight)))
        chosen.append(nxt)
        near = np.maximum(near, s[:, nxt])
    return [words[i] for i in chosen]


def score(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> DataFrame:
    """``docs`` with ``score`` (0 to 1); labels are learned from the label rows for
    which ``allowed`` holds."""
    machine = train(training_documents(docs, labels, allowed, id_col, text_col, label_col))
    if machine is None:
        return docs.withColumn("score", F.lit(0.0))
    a, b = machine.curve
    value = highest_value(F.col(f"`{text_col}`"), machine)
    return docs.withColumn("score", 1 / (1 + F.exp(-(a * value + b))))
