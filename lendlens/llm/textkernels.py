"""NumPy kernels over one Arrow batch of texts (used inside Spark tasks only).

A batch of UTF-8 texts is one byte buffer plus offsets.  All kernels work on
that buffer with whole-array operations, so a task never loops over words.
Hashes are polynomials (Rabin-Karp) modulo the prime 2**61 - 1: two different
words or windows of m parts collide for at most m of its 2**61 bases, whatever
their structure (modulo 2**64, some words collide for every odd base).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: The modulus, and the bases of words (parts of 7 bytes) and of windows (words).
PRIME = U64((1 << 61) - 1)
BYTE_BASE = U64(0x1E3779B97F4A7C15)
WORD_BASE = U64(0x02B2AE3D27D4EB4F)
PART = 7
#: Words of more parts than this are hashed one by one, in a logarithmic number of steps.
LONG_PARTS = 256
#: Bytes of text hashed together; bounds the kernels' memory.
BLOCK_BYTES = 2 << 20


def times(a: np.ndarray, b) -> np.ndarray:
    """a * b modulo PRIME, for numbers below it; by halves of 30 and 31 bits, so that no step leaves 64 bits."""
    low31, low30, s31, s30, s61 = U64((1 << 31) - 1), U64((1 << 30) - 1), U64(31), U64(30), U64(61)
    a1, a0, b1, b0 = a >> s31, a & low31, b >> s31, b & low31
    mid = a1 * b0 + a0 * b1
    out = ((a1 * b1) << U64(1)) + (mid >> s30) + ((mid & low30) << s31) + a0 * b0
    out = (out & PRIME) + (out >> s61)
    return np.minimum(out, out - PRIME)  # below PRIME the difference wraps to a large number


def plus(a: np.ndarray, b) -> np.ndarray:
    out = a + b
    return np.minimum(out, out - PRIME)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: The word separators of the contracts: space and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    data = np.frombuffer(buffers[2], dtype=np.uint8)[lo:hi] if hi > lo else np.zeros(0, dtype=np.uint8)
    return data, (offsets - lo if len(texts) else np.zeros(1, dtype=np.int64))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; a run never crosses a text boundary."""
    n = len(inside)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    prev = np.zeros(n, dtype=bool)
    prev[1:] = inside[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    prev[inner] = False
    starts = np.flatnonzero(inside & ~prev)
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[inner - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the words `[^\\x20\\x09-\\x0D]+`.

    ``first[i]:first[i+1]`` are the words of text i.
    """
    starts, ends = runs(~SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def window_hashes(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every `width` consecutive words of the whole buffer (entry i starts at word i).

    Windows of 2, 4, 8, ... words come from two halves, any width from those of its binary digits.
    """
    n = len(word_hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    half, size, base = word_hashes % PRIME, 1, np.array([WORD_BASE])
    out, done = np.zeros(n, dtype=U64), 0
    while True:
        if width & size:  # these words stand after the `done` ones
            out = plus(times(out, base), half[done:done + n])
            done += size
        if 2 * size > width:
            break
        half = plus(times(half[:-size], base), half[size:])
        size, base = 2 * size, times(base, base)
    return mix(plus(times(out, WORD_BASE), U64(width)))


def windows_of(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start words of all windows that stay inside their text, and their text's index."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    base = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - base[owner] + first[:-1][owner], owner


def _long_word(data: np.ndarray) -> int:
    """The polynomial of one word's parts, folded from neighbours upwards."""
    padded = np.zeros((-(-len(data) // PART), 8), dtype=np.uint8)
    whole = np.zeros(len(padded) * PART, dtype=np.uint8)
    whole[:len(data)] = data
    padded[:, :PART] = whole.reshape(-1, PART)
    parts, base = padded.view("<u8").ravel(), np.array([BYTE_BASE])
    while len(parts) > 1:
        if len(parts) % 2:  # a leading zero changes nothing
            parts = np.r_[U64(0), parts]
        parts, base = plus(times(parts[::2], base), parts[1::2]), times(base, base)
    return int(parts[0])


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for every word: the polynomial of its parts of 7 bytes and of its length."""
    sizes = ends - starts
    out = np.zeros(len(starts), dtype=U64)
    if not len(starts):
        return out
    at_each = np.ndarray(len(data) + 1, dtype="<u8", buffer=np.r_[data, np.zeros(8, dtype=np.uint8)], strides=(1,))
    full = U64((1 << (8 * PART)) - 1)
    rows = np.flatnonzero(sizes <= PART * LONG_PARTS)
    first, left = starts[rows], sizes[rows]
    while len(rows):
        part = at_each[first] & np.where(left >= PART, full, (U64(1) << (U64(8) * np.minimum(left, PART).astype(U64))) - U64(1))
        out[rows] = plus(times(out[rows], BYTE_BASE), part)
        more = left > PART
        rows, first, left = rows[more], first[more] + PART, left[more] - PART
    for i in np.flatnonzero(sizes > PART * LONG_PARTS):
        out[i] = _long_word(data[starts[i]:ends[i]])
    return mix(plus(times(out, BYTE_BASE), sizes.astype(U64)))


def blocks(sizes: np.ndarray, limit: int = BLOCK_BYTES):
    """Cuts rows into consecutive slices of about `limit` bytes (a longer text stands alone)."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += int(size)
    if len(sizes) > start:
        yield start, len(sizes)


def sizes_of(texts: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text (null: 0)."""
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
