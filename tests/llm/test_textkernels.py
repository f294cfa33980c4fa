"""The hash kernels against plain integer arithmetic."""

import random

import numpy as np
import pyarrow as pa

from lendlens.llm import textkernels as K

P = (1 << 61) - 1


def thue_morse(n, pair="ab"):
    """Two different words of 2**n letters that collide under every polynomial hash modulo 2**64 for large n."""
    bits = [bin(k).count("1") % 2 for k in range(1 << n)]
    return "".join(pair[b] for b in bits), "".join(pair[1 - b] for b in bits)


def mixed(x):
    return int(K.mix(np.array([x], dtype=np.uint64))[0])


def word_hash(word):
    h = 0
    for k in range(0, len(word), K.PART):
        h = (h * int(K.BYTE_BASE) + int.from_bytes(word[k:k + K.PART], "little")) % P
    return mixed((h * int(K.BYTE_BASE) + len(word)) % P)


def test_products():
    r = np.random.default_rng(1)
    a = np.r_[r.integers(0, P, 500, dtype=np.uint64), np.array([0, 1, P - 1, P - 1, 1 << 60], dtype=np.uint64)]
    b = np.r_[r.integers(0, P, 500, dtype=np.uint64), np.array([5, P - 1, P - 1, 1, 1 << 60], dtype=np.uint64)]
    assert [int(x) for x in K.times(a, b)] == [int(x) * int(y) % P for x, y in zip(a, b)]
    assert [int(x) for x in K.plus(a, b)] == [(int(x) + int(y)) % P for x, y in zip(a, b)]


def test_words_and_windows():
    draw = random.Random(4)
    words = ["".join(draw.choices("ab\x00é漢", k=draw.choice([1, 2, 6, 7, 8, 13, 14, 15, 40, 1700, 2000, 5000]))) for _ in range(60)]
    data, offsets = K.as_bytes(pa.array([" ".join(words[:30]), "", " ".join(words[30:])]))
    starts, ends, first = K.word_spans(data, offsets)
    assert first.tolist() == [0, 30, 30, 60]
    hashes = K.hash_words(data, starts, ends)
    assert [int(h) for h in hashes] == [word_hash(w.encode()) for w in words]
    for width in (1, 2, 3, 5, 8, 13, 60):
        want = []
        for k in range(len(words) - width + 1):
            h = 0
            for w in hashes[k:k + width]:
                h = (h * int(K.WORD_BASE) + int(w)) % P
            want.append(mixed((h * int(K.WORD_BASE) + width) % P))
        assert [int(h) for h in K.window_hashes(hashes, width)] == want
    assert len(K.window_hashes(hashes, 61)) == 0 and len(K.hash_words(data, starts[:0], ends[:0])) == 0


def test_structured_words_differ():
    for n in (3, 10, 12):
        data, offsets = K.as_bytes(pa.array([" ".join(thue_morse(n))]))
        a, b = K.hash_words(data, *K.word_spans(data, offsets)[:2])
        assert a != b
    # The same structure in words.
    a, b = ([{"a": 1, "b": 2}[c] for c in w] for w in thue_morse(10))
    a, b = (K.window_hashes(np.array(x, dtype=np.uint64), 1024)[0] for x in (a, b))
    assert a != b
    assert len({word_hash(b"\x00" * k) for k in range(30)}) == 30
