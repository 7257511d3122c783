"""Word and shingle hashes of whole batches of texts, vectorised over their bytes.

Words are split at ASCII white space (space and \\t to \\r), so UTF-8 bytes can be cut without decoding. A word's
hash is a polynomial with random coefficients modulo 2^64, mixed; shingles combine word hashes with one odd factor
a place. The hashes are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20))
CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
PLACES = _rng.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: Texts are worked on in pieces of about this many bytes (a longer text alone).
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(texts: list[bytes], size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of the list with about `size` bytes each."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def word_hashes(texts: list[bytes], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and for each text the number of words up to its end."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    inside = ~IS_SPACE[data]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    lengths = stops - starts
    firsts = np.cumsum(lengths) - lengths
    letters = data[inside]
    place = np.arange(len(letters)) - np.repeat(firsts, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), BASE))
    terms = CODES[FOLD[letters] if fold else letters] * powers[place]
    return mix(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64)), np.searchsorted(starts, ends_at)


def shingles(hashes: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of the k-word windows; of fewer words, of the whole sequence; none of none."""
    n = len(hashes)
    if n == 0:
        return hashes
    if n < k:
        return mix(np.sum(hashes * PLACES[:n], keepdims=True, dtype=np.uint64) + np.uint64(n))
    total = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        total += hashes[j : n - k + 1 + j] * PLACES[j]
    return mix(total)


def texts_of(column) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8; null is empty."""
    import pyarrow as pa

    return [t or b"" for t in column.cast(pa.binary() if column.type != pa.large_string() else pa.large_binary()).to_pylist()]
