"""Words of Arrow batches as integer codes, so that each distinct word is worked on once.

Splitting and finding the distinct words is done by Arrow on whole columns; Python sees a
word only when a task meets it for the first time. A task's table is bounded: beyond
``WORKER_WORDS`` words it starts anew, and words longer than ``LONGEST`` characters are
not kept.
"""

import re
import sys
import types
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

WORKER_WORDS, LONGEST = 600_000, 48
#: Bytes of text handled at a time, unless one text is longer.
SLICE_BYTES = 8 << 20
#: Marks that make a pre-token of their own behind a letter or digit, and these.
_MARKS = ".,;:!?"
ENDS = frozenset(c for c in map(chr, range(0x100)) if c.isascii() and c.isalnum() or c > "\xbf" and c.isalpha())
#: Letters that stay themselves when lower-cased, and under NFC; and with their capitals.
_SMALL, _LETTERS = re.compile("[a-zß-öø-ÿ]+"), re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The column in runs of rows of about ``size`` bytes; null counts as empty."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield texts.slice(start, end - start)
        start = end


def absent_mark(texts: pa.Array) -> str:
    """A character that none of the texts holds, to mark cuts with; one that is no character if possible."""
    places = chain(range(0xFDD0, 0xFDF0), range(0x10FFFF, 0xFFFF, -1))
    # Looked for as a pattern, as Arrow's search for plain strings goes byte by byte.
    return next(c for c in map(chr, places) if not pc.any(pc.match_substring_regex(texts, c)).as_py())


def space_split(texts: pa.Array) -> pa.Array:
    """Lists of words between runs of the six ASCII white space characters; some are empty."""
    return pc.ascii_split_whitespace(texts)


def worker_cache(name: str, make: Callable):
    """What an earlier task of this worker process made under ``name``, else what ``make`` gives.

    One object at a time is kept, so its own bound is the bound. The place is a module of
    its own, as the library's modules may come with each task anew.
    """
    place = sys.modules.setdefault("barloom_worker_cache", types.ModuleType("barloom_worker_cache"))
    if getattr(place, "name", None) != name:
        place.name, place.value = name, make()
    return place.value


class WordCodes:
    """Codes of words; ``learn(words, first)`` is told of new words, which get codes from ``first``.

    When the table is full, the third of it that was used most stays; ``keep`` is told
    which codes these are, and they are numbered anew from 0.
    """

    def __init__(self, learn: Callable, keep: Callable, limit: int = WORKER_WORDS):
        self.learn, self.keep, self.limit = learn, keep, limit
        self.known, self.next, self.uses = {}, 0, np.zeros(0, np.int64)

    def __call__(self, words: pa.Array) -> np.ndarray:
        if self.next > self.limit:
            self._shrink()
        found = words.dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.known
        new = [w for w in distinct if w not in known]
        if new:
            self.learn(new, self.next)
            known.update(zip(new, range(self.next, self.next + len(new))))
            self.next += len(new)
        codes = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        for word in new:
            if len(word) > LONGEST:
                del known[word]
        found = codes[found.indices.to_numpy()]
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)]) + np.bincount(found, minlength=self.next)
        return found

    def _shrink(self) -> None:
        words = list(self.known)
        codes = np.fromiter(self.known.values(), np.int64, len(words))
        best = np.sort(np.argsort(-self.uses[codes], kind="stable")[: self.limit // 3])
        self.known = {words[k]: n for n, k in enumerate(best)}
        self.next, self.uses = len(best), self.uses[codes[best]] // 2
        self.keep(codes[best])


class Lists:
    """Lists of numbers by code, in one growing array."""

    def __init__(self, kind):
        self.values = np.empty(1 << 16, kind)
        self.start, self.size = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.used = 0

    def add(self, lists: list[list], first: int) -> None:
        """Lists for the codes from ``first`` on."""
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        total, last = int(sizes.sum()), first + len(lists)
        while self.used + total > len(self.values):
            self.values = np.concatenate([self.values, np.empty_like(self.values)])
        while last > len(self.start):
            self.start = np.concatenate([self.start, np.empty_like(self.start)])
            self.size = np.concatenate([self.size, np.empty_like(self.size)])
        self.values[self.used : self.used + total] = np.fromiter(chain.from_iterable(lists), self.values.dtype, total)
        self.size[first:last] = sizes
        self.start[first:last] = self.used + np.cumsum(sizes) - sizes
        self.used += total

    def keep(self, codes: np.ndarray) -> None:
        """Only the lists of ``codes`` stay, and get their places as codes."""
        values, sizes = self.take(codes), self.size[codes]
        self.used = len(values)
        self.values[: self.used] = values
        self.size[: len(codes)] = sizes
        self.start[: len(codes)] = np.cumsum(sizes) - sizes

    def take(self, codes: np.ndarray) -> np.ndarray:
        """The lists of ``codes``, one behind the other."""
        sizes = self.size[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.values[np.repeat(self.start[codes] - ends + sizes, sizes) + np.arange(total)]


def list_ends(lists: pa.Array) -> np.ndarray:
    """Where each list of a column ends in its flattened values."""
    return np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))


def sums_between(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the runs of ``values`` that end at ``ends``."""
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(total[np.concatenate([[0], ends])])


def cores_and_tails(words: list[str]) -> tuple[list[str], list[str]]:
    """Each word without the marks at its end, and the marks; a word may be all core.

    Tokenizers start a pre-token at the first of these marks after a letter or digit.
    """
    cores = [word.rstrip(_MARKS) for word in words]
    cores = [core if core and core[-1] in ENDS else word for core, word in zip(cores, words)]
    return cores, [word[len(core) :] for core, word in zip(cores, words)]


def byte_symbols() -> dict[int, str]:
    """How byte-level BPE shows bytes: printable ones as themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(256 + n) for n, b in enumerate(rest)}


class PreTokens:
    """Ids of words, each a text of its own; plain letters go straight to the library's model.

    A word of letters is one pre-token, so the library's splitting, which takes most of
    its time on short texts, can be left out. All other words take the whole way.
    """

    def __init__(self, tokenizer: Tokenizer, before: str = "", lower: bool = False):
        self.tokenizer, self.before = tokenizer, before
        self.plain = _SMALL if lower else _LETTERS
        self.symbols = byte_symbols()
        self.lead = before.translate(self.symbols)

    def __call__(self, words: list[str]) -> list[list[int]]:
        symbols, lead, tokenize, plain = self.symbols, self.lead, self.tokenizer.model.tokenize, self.plain.fullmatch
        found, others = [], []
        for word in words:
            if plain(word):
                shown = word if word.isascii() else word.encode().decode("latin-1").translate(symbols)
                found.append([t.id for t in tokenize(lead + shown)])
            else:
                others.append(len(found))
                found.append(word)
        texts = [self.before + found[k] for k in others]
        for k, encoded in zip(others, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            found[k] = encoded.ids
        return found


class Values:
    """A number by code."""

    def __init__(self, kind):
        self.values = np.empty(1 << 14, kind)

    def add(self, values: list, first: int) -> None:
        last = first + len(values)
        while last > len(self.values):
            self.values = np.concatenate([self.values, np.empty_like(self.values)])
        self.values[first:last] = values

    def keep(self, codes: np.ndarray) -> None:
        self.values[: len(codes)] = self.values[codes]

    def take(self, codes: np.ndarray) -> np.ndarray:
        return self.values[codes]
