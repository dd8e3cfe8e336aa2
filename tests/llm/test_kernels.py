import random

import numpy as np
import pytest

from cabflow.llm import kernels as k
from tests.llm.helpers import OTHER_WORD, WORD


def hashes(words, sep=b" "):
    data = np.frombuffer(sep.join(words), np.uint8)
    w = k.words(data, np.array([0, len(data)]), k.NON_SPACE)
    assert len(w.hash) == len(words)
    return w.hash


def test_words_have_their_own_hash_wherever_they_stand():
    rnd = random.Random(1)
    words = {bytes(rnd.choice(b"ab\x01\xc3") for _ in range(rnd.randrange(1, 150))) for _ in range(5000)}
    words |= {b"a" * n for n in range(1, 300)} | {b"\x01" * n for n in range(1, 100)}
    words |= {WORD.encode(), OTHER_WORD.encode()}
    words |= {(a + b).encode() for a in (WORD[:32], OTHER_WORD[:32]) for b in (WORD[:32], OTHER_WORD[:32])}
    words = sorted(words)
    first = hashes(words)
    assert len(np.unique(first)) == len(words)
    order = rnd.sample(range(len(words)), len(words))
    assert (hashes([words[i] for i in order], b"\n  ")[:] == first[order]).all()


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 20, 1024])
def test_runs_of_hashes(size):
    rnd = np.random.default_rng(size)
    h = rnd.integers(0, 3, 3000).astype(np.uint64)  # many equal runs
    at = np.arange(len(h) - size + 1)
    for seed in (0, k.WORD_BASE_2):
        got = k.run_of_hashes(h, size, at, seed)
        names = {}
        for i in at.tolist():
            names.setdefault(h[i : i + size].tobytes(), set()).add(int(got[i]))
        assert all(len(x) == 1 for x in names.values())
        assert len(set.union(*names.values())) == len(names)
    a, b = (np.array([3 if c == "a" else 5 for c in x], np.uint64) for x in (WORD, OTHER_WORD))
    zero = np.zeros(1, np.int64)
    assert k.run_of_hashes(a, 1024, zero) != k.run_of_hashes(b, 1024, zero)
