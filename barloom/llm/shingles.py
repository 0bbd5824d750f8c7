"""Word shingles of texts as sets of 64-bit numbers, and minwise signatures of such sets."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from barloom.llm.words import list_ends, space_split

WORDS = 5
#: Minwise functions of a signature.
FUNCTIONS = 64
_CHUNK = 4096
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread numbers over 64 bits, so that near numbers don't stay near."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """A sorted array of distinct numbers for each text: its shingles.

    Lower-cased from A to Z; a shingle is a run of five words, or all of a text with fewer. A
    text without words has none. Each distinct word of the column is hashed once.
    """
    lists = space_split(pc.ascii_lower(texts))
    words = lists.flatten()
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    words = words.dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words.dictionary.to_pylist()], np.uint64)
    hashes = hashes[words.indices.to_numpy()]
    ends = np.concatenate([[0], np.cumsum(real)])[list_ends(lists)]
    hashes = hashes[real]
    windows = sum(hashes[k : len(hashes) - WORDS + 1 + k] * _ODD[k] for k in range(WORDS)) if len(hashes) >= WORDS else hashes[:0]
    windows = mixed(windows)
    found = []
    for first, last in zip([0, *ends[:-1]], ends):
        if last - first >= WORDS:
            found.append(np.unique(windows[first : last - WORDS + 1]))
        elif last > first:
            some = hashes[first:last] * _ODD[: last - first]
            found.append(mixed(some.sum(keepdims=True) + np.uint64(last - first)))
        else:
            found.append(hashes[:0])
    return found


def _functions() -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * FUNCTIONS + 1, dtype=np.uint64) * _ODD[0])
    return seeds[:FUNCTIONS, None] | np.uint64(1), seeds[FUNCTIONS:, None]


FACTORS, MASKS = _functions()


def signature(numbers: np.ndarray) -> np.ndarray:
    """The least value of each function over a set, as 32 bits each."""
    least = np.full(FUNCTIONS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(numbers), _CHUNK):
        values = (numbers[None, start : start + _CHUNK] ^ MASKS) * FACTORS
        np.minimum(least, values.min(axis=1), out=least)
    return (mixed(least) >> np.uint64(32)).astype("<u4")


def similarity(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and of the union of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both
