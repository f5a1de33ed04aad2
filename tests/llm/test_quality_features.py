"""Text statistics read every word."""

from folioframe.llm.quality import statistics

ODD = -6


def test_odd_words_of_a_long_text():
    for n in (3, 2000, 20_000):
        words = [b"word"] * n
        words[1] = b"word|"
        assert statistics(b" ".join(words))[ODD] == 1 / n


def test_odd_words_by_hand():
    signs = bytes(range(256))
    for c in signs:
        word = b"x" + bytes([c])
        words = (b"a " + word + b" b").split()
        want = sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:?'\")-" for w in words) / len(words)
        assert statistics(b"a " + word + b" b")[ODD] == want, c
    assert statistics(b"")[ODD] == statistics(b" \n")[ODD] == 0
