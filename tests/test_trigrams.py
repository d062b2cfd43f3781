"""Trigrams as numbers: the same trigrams, counts and profiles as by characters."""

import random
import re
from collections import Counter

import numpy as np

from textforge.operators import language as L

PARTS = "abcABCéüßñİıſK 12_-.\n\t́²あ漢字\U00020000\U0001F600"


def by_characters(text):
    t = "".join(c if c.isalpha() else " " for c in text.lower())
    t = re.sub(" +", " ", t)
    return Counter(t[i : i + 3] for i in range(len(t) - 2))


def test_trigram_keys():
    r, letters = random.Random(3), L.letter_table()
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 80))) for _ in range(500)] + ["", "a", "ab", "abc", "   ", "a  b"]
    for text in texts:
        want = by_characters(text)
        keys = L.trigram_keys(text, letters)
        assert Counter(L.gram_strings(keys) if len(keys) else []) == want
        assert [L.gram_key(g) for g in L.gram_strings(np.unique(keys))] == np.unique(keys).tolist() if len(keys) else not want
        profile = L.profile_keys(keys, 20)
        assert (L.gram_strings(profile) if len(profile) else []) == [g for g, _ in sorted(want.items(), key=lambda x: (-x[1], x[0]))[:20]]
