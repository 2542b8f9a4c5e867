"""Pieces in one pass against the longest-match loop."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from labelkiln.operators.features import PieceTrie, greedy_pieces

LETTERS = st.text("abc#", max_size=6)


@settings(max_examples=400, deadline=None)
@given(st.sets(st.one_of(LETTERS, LETTERS.map(lambda x: "##" + x)), max_size=25), st.lists(st.text("abc#d", max_size=12), max_size=10))
def test_equal_to_the_greedy_loop(pieces, words):
    vocab = {p: i + 5 for i, p in enumerate(sorted(pieces - {"", "##"}))}
    trie = PieceTrie(vocab)
    for w in words:
        assert trie.pieces(w) == greedy_pieces(w, vocab), (vocab, w)


def test_long_words_and_limits():
    r = random.Random(4)
    vocab = {p: i for i, p in enumerate(sorted({"".join(r.choice("ab") for _ in range(r.randrange(1, 9))) for _ in range(60)}
                                               | {"##" + "".join(r.choice("ab") for _ in range(r.randrange(1, 9))) for _ in range(60)}
                                               | {"a", "b", "##a", "##b"}))}
    trie = PieceTrie(vocab)
    for _ in range(300):
        w = "".join(r.choice("ab") for _ in range(100))
        assert trie.pieces(w) == greedy_pieces(w, vocab)
    assert trie.pieces("a" * 101) == [1] and trie.pieces("") == [] and trie.pieces("abz") == [1]
