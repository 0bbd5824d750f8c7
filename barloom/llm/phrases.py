"""Phrase collocations by counting candidates in double-array tries.

Texts are read once, into short rows of word numbers (64-bit hashes, checked to be different for
all words of a language), with the words behind them; all later passes read these rows.
A row also holds the first words of the next one, so that no phrase is lost between them.

1. Words are counted; those below the least count are out.
2. A phrase can only be frequent if both its parts (all but its last and all but its first word) are.
   A bitmap of the frequent ones (a superset: two may share a bit) goes to all tasks. Occurrences of
   phrases whose parts are both in it are first added up by a hash of the phrase, in as many
   places as there are bits; places below the least count hold no frequent phrase.
3. Occurrences at the other places are dealt by the phrase's hash to shards, as many as it takes for
   a bounded number of them in each: a task puts equal ones together and sends a packed row
   per shard. In a shard, phrases whose hash comes up often enough are its candidates. They are
   built into a double-array trie; all occurrences with such hashes are walked through it at once, level
   by level, and end states are counted with ``bincount``. So each phrase is in one trie, each occurrence
   is walked once, and the rows of words are read twice for a length, however many phrases are frequent.

Steps 2 and 3 are repeated for each length. Scoring joins the counts by phrase.
"""

from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.llm.phrase_trie import PhraseTrie, walk, walked
from barloom.llm.words import absent_mark, slices
from barloom.operators.keyed import landed, scratch_path, top_k

#: Phrases of a trie at most, bits of a bitmap at least, and places of it, or phrases of a trie, that are added up together.
TRIE_PHRASES, BITS, BLOCK = 1 << 20, 1 << 26, 1 << 14
#: Bits of a bitmap at most; occurrences in a shard at most, on average; and shards at least.
MOST_BITS, SHARD, SHARDS = 1 << 28, 1 << 21, 64
#: Bytes of text cut at a time, unless one text is longer, and words in a row.
SLICE_BYTES, ROW_WORDS = 4 << 20, 512
#: Without use since phrases are proposed and counted in one turn; kept for callers that set it.
FIRST_OF = 8
#: Rows of words that are worked on at a time, and phrases that a task adds up at a time (half of it if it keeps their words).
_TOGETHER, _SUMMED = 2048, 1 << 22
_END = r"[.,;:!?\x0A-\x0D]"
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


# Rows of words


def _words(texts: pa.Array) -> pa.DictionaryArray:
    """The words of all texts one behind the other; null ends a piece."""
    mark = absent_mark(texts)
    cut = pc.replace_substring_regex(pc.ascii_lower(texts), _END, f" {mark} ")
    words = pc.ascii_split_whitespace(pc.binary_join_element_wise(cut, mark, " ")).flatten()
    words = words.filter(pc.not_equal(words, ""))
    return pc.if_else(pc.equal(words, mark), pa.scalar(None, words.type), words).dictionary_encode()


def _dealt(values: pa.Array, rows: int) -> pa.Array:
    """``values`` as ``rows`` lists."""
    ends = np.linspace(0, len(values), rows + 1).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


def word_rows(docs: DataFrame, text_col: str, lang_col: str, longest: int, seed: int) -> DataFrame:
    """(lang, numbers, words, word_numbers, counts) of runs of ``ROW_WORDS`` words.

    ``numbers`` holds 64-bit word numbers, 0 where a piece ends, and those of the next words as far as
    a phrase can reach. The distinct words of a slice of texts, with their numbers and
    counts, are dealt over its rows.
    """
    width = ROW_WORDS + longest - 1

    def cut(batches):
        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                for texts in slices(batch.column(1).filter(pc.equal(batch.column(0), lang)), SLICE_BYTES):
                    found = _words(texts)
                    own = np.array([xxhash.xxh64_intdigest(w, seed) or 1 for w in found.dictionary.to_pylist()], np.uint64)
                    codes = pc.fill_null(found.indices, len(own)).to_numpy()
                    rows = -(-len(codes) // ROW_WORDS)
                    numbers = np.append(own, np.uint64(0))[codes]
                    numbers = np.append(numbers, np.zeros(rows * ROW_WORDS + longest - len(numbers), np.uint64))
                    wide = numbers[np.arange(rows)[:, None] * ROW_WORDS + np.arange(width)]
                    ends = pa.py_buffer((np.arange(rows + 1) * width * 8).astype(np.int32))
                    counts = np.bincount(codes, minlength=len(own) + 1)[: len(own)]
                    columns = [
                        pa.repeat(pa.scalar(lang), rows),
                        pa.Array.from_buffers(pa.binary(), rows, [None, ends, pa.py_buffer(wide)]),
                        _dealt(found.dictionary, rows),
                        _dealt(pa.array(own.view(np.int64)), rows),
                        _dealt(pa.array(counts), rows),
                    ]
                    table = pa.RecordBatch.from_arrays(columns, names)
                    for first in range(0, rows, _TOGETHER):
                        yield table.slice(first, _TOGETHER)

    names = ["lang", "numbers", "words", "word_numbers", "counts"]
    lang, text = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")), F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(lang.alias("lang"), text.alias("text"))
    kinds = "lang string, numbers binary, words array<string>, word_numbers array<long>, counts array<long>"
    return rows.mapInArrow(cut, kinds)


def _read(batches, longest: int):
    """(lang, numbers) of many rows at a time: a row of numbers each."""
    for batch in batches:
        for lang in pc.unique(batch.column("lang")).to_pylist():
            own = batch.column("numbers").filter(pc.equal(batch.column("lang"), lang))
            for first in range(0, len(own), _TOGETHER):
                some = own.slice(first, _TOGETHER)
                start = some.offset
                ends = np.frombuffer(some.buffers()[1], np.int32)[start : start + len(some) + 1]
                numbers = np.frombuffer(some.buffers()[2], np.uint8)[ends[0] : ends[-1]]
                yield lang, numbers.view(np.uint64).reshape(len(some), ROW_WORDS + longest - 1)


def numbered_rows(docs: DataFrame, text_col: str, lang_col: str, longest: int) -> tuple[DataFrame, DataFrame]:
    """Rows of words and (lang, word, w1, f), with numbers that no two words of a language share."""
    seed, spark = 0, docs.sparkSession
    while True:
        path = scratch_path(spark, "word-rows")
        rows = word_rows(docs, text_col, lang_col, longest, seed)
        rows.write.option("compression", "zstd").parquet(path)  # numbers repeat: a third of the default's size
        rows = spark.read.schema(rows.schema).parquet(path)
        met = rows.select("lang", F.explode(F.arrays_zip("words", "word_numbers", "counts")).alias("x"))
        met = met.select("lang", F.col("x.words").alias("word"), F.col("x.word_numbers").alias("w1"), F.col("x.counts").alias("f"))
        words = landed(met.groupBy("lang", "word", "w1").agg(F.sum("f").alias("f")), "phrase-words")
        if words.groupBy("lang", "w1").count().filter("count > 1").isEmpty():
            return rows.select("lang", "numbers"), words
        seed += 1


# Sums by place, packed

_SUMS = "block int, sign int, n int, gaps binary, counts binary"


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, each in as few bytes as hold the greatest."""
    return numbers.astype(np.min_scalar_type(int(numbers.max()))).tobytes()


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, f"u{len(packed) // n}").astype(np.int64)


def _block_rows(places: np.ndarray, counts: np.ndarray, sign: int = 1) -> pa.RecordBatch:
    """``_SUMS`` of counts by place (ascending): a row per block, that holds the gaps between its places."""
    blocks, starts = np.unique(places // BLOCK, return_index=True)
    within, ends = (places % BLOCK).astype(np.int64), np.append(starts[1:], len(places))
    spans = [slice(*span) for span in zip(starts.tolist(), ends.tolist())]
    columns = [
        pa.array(blocks, pa.int32()),
        pa.repeat(pa.scalar(sign, pa.int32()), len(blocks)),
        pa.array(ends - starts, pa.int32()),
        pa.array([_packed(np.diff(within[span], prepend=0)) for span in spans], pa.binary()),
        pa.array([_packed(counts[span]) for span in spans], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["block", "sign", "n", "gaps", "counts"])


def _block_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Each block with the sums of its places, from ``_SUMS`` in order of blocks."""
    rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    for block, own in groupby(rows, itemgetter(0)):
        sums = np.zeros(BLOCK, np.int64)
        for _, sign, n, gaps, counts in own:
            sums[np.cumsum(_unpacked(gaps, n))] += sign * _unpacked(counts, n)
        yield block, sums


def _by_block(sums: DataFrame) -> DataFrame:
    return sums.repartition("block").sortWithinPartitions("block")


# Candidates


def _phrase_hash(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """A number for each phrase of a language, given its words' numbers by place."""
    x = np.array([xxhash.xxh64_intdigest(lang)], np.uint64) * _ODD[3]
    for place, numbers in enumerate(words):
        x = x ^ (numbers * _ODD[place % 3])
        x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x


def _bits(expected: float) -> int:
    """Bits of a bitmap for so many entries: a power of two times ``BITS``."""
    bits = BITS
    while bits < min(expected, MOST_BITS):
        bits *= 2
    return bits


def _place(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(20)) % np.uint64(bits)


def _hit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _place(hashes, 8 * len(bits))
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """The bits of all ``hash`` of a frame, as bytes."""
    at = F.expr(f"shiftrightunsigned(hash, 20) % {bits}").alias("at")
    bit = F.expr("shiftleft(1L, cast(at % 64 as int))")
    held = hashes.select(at).groupBy(F.expr("at div 64").alias("place")).agg(F.bit_or(bit).alias("bits"))
    table = held.toArrow()  # bits / 64 rows at most
    out = np.zeros(bits // 64, np.int64)
    out[table.column("place").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint8)


def phrase_hashes(phrases: DataFrame, size: int) -> DataFrame:
    """(hash) of phrases (lang, w1 ... w<size>)."""

    def made(batches):
        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                own = batch.filter(pc.equal(batch.column(0), lang))
                hashes = _phrase_hash(lang, [own.column(k + 1).to_numpy().view(np.uint64) for k in range(size)])
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["hash"])

    return phrases.select("lang", *_names(size)).mapInArrow(made, "hash long")


def _names(size: int) -> list[str]:
    return [f"w{k + 1}" for k in range(size)]


def _possible(lang: str, numbers: np.ndarray, bits: np.ndarray, size: int) -> list[np.ndarray]:
    """The words, by place, of all phrases in some rows whose two parts are in the bitmap."""
    # The parts of a phrase, all but its last and all but its first word, start at its place and at the next.
    flat = numbers.ravel()
    run = [flat[k : len(flat) - size + 2 + k] for k in range(size - 1)]
    part = np.all([r != 0 for r in run], axis=0)
    part[part] = _hit(bits, _phrase_hash(lang, [r[part] for r in run]))
    at = np.flatnonzero(part[:-1] & part[1:])
    at = at[at % numbers.shape[1] < ROW_WORDS]
    return [flat[at + k] for k in range(size)]


def place_sums(texts: DataFrame, parts, size: int, longest: int, bits: int) -> DataFrame:
    """``_SUMS`` of the places at which phrases with frequent ``parts`` occur, a row per task and block."""

    def add_up(batches):
        held, n = [], 0
        for lang, numbers in _read(batches, longest):
            held.append(_place(_phrase_hash(lang, _possible(lang, numbers, parts.value, size)), bits).astype(np.uint32))
            n += len(held[-1])
            if n >= _SUMMED:
                yield _block_rows(*np.unique(np.concatenate(held), return_counts=True))
                held, n = [], 0
        if n:
            yield _block_rows(*np.unique(np.concatenate(held), return_counts=True))

    return texts.mapInArrow(add_up, _SUMS)


def reached(sums: DataFrame, least: int, bits: int) -> tuple[np.ndarray, int]:
    """The bitmap of the places whose sums are ``least`` or more, and all their sums together."""

    def made(batches):
        for block, own in _block_sums(batches):
            often = own >= least
            if often.any():
                columns = [pa.array([block], pa.int32()), pa.array([np.packbits(often, bitorder="little").tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([own[often].sum()])], ["block", "bits", "n"])

    out, total = np.zeros((bits // BLOCK, BLOCK // 8), np.uint8), 0
    table = _by_block(sums).mapInArrow(made, "block int, bits binary, n long").toArrow()  # bits / BLOCK rows at most
    for block, own, n in zip(*(column.to_pylist() for column in table.columns)):
        out[block] = np.frombuffer(own, np.uint8)
        total += n
    return out.reshape(-1), total


# Occurrences by shard, packed

_DEALT = "shard int, lang string, n int, words binary, counts binary"


def _dealt_rows(lang: str, hashes: np.ndarray, words: list[np.ndarray], shards: int) -> pa.RecordBatch:
    """``_DEALT`` of occurrences of phrases, equal ones put together: a row per shard."""
    order = np.argsort(hashes)
    hashes, words = hashes[order], [w[order] for w in words]
    new = hashes[1:] != hashes[:-1]
    for w in words:  # where two phrases share a hash, one may come in some runs
        new |= w[1:] != w[:-1]
    first = np.flatnonzero(np.append(True, new))
    counts, words = np.diff(np.append(first, len(hashes))), [w[first] for w in words]
    found, starts = np.unique(_shard(hashes[first], shards), return_index=True)  # ascending, as the hashes are
    ends = np.append(starts[1:], len(first))
    spans = [slice(*span) for span in zip(starts.tolist(), ends.tolist())]
    columns = [
        pa.array(found, pa.int32()),
        pa.repeat(pa.scalar(lang), len(found)),
        pa.array(ends - starts, pa.int32()),
        pa.array([b"".join(w[span].tobytes() for w in words) for span in spans], pa.binary()),
        pa.array([_packed(counts[span]) for span in spans], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["shard", "lang", "n", "words", "counts"])


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """By the upper half of the hash, in its order."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def dealt(texts: DataFrame, parts, places, size: int, longest: int, shards: int) -> DataFrame:
    """``_DEALT`` of all phrases with frequent ``parts`` at some ``places``."""

    def deal(batches):
        held, n = {}, 0
        for lang, numbers in _read(batches, longest):
            words = _possible(lang, numbers, parts.value, size)
            hashes = _phrase_hash(lang, words)
            often = _hit(places.value, hashes)
            held.setdefault(lang, []).append([x[often] for x in (hashes, *words)])
            n += len(held[lang][-1][0])
            if 2 * n >= _SUMMED:
                yield from sent(held)
                held, n = {}, 0
        yield from sent(held)

    def sent(held):
        for lang, own in held.items():
            hashes, *words = map(np.concatenate, zip(*own))
            if len(hashes):
                yield _dealt_rows(lang, hashes, words, shards)

    return texts.mapInArrow(deal, _DEALT)


def _by_shard(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray]]:
    """(languages, place of each phrase's language, words (phrase, place), counts) of each shard, from ``_DEALT`` in order of shards."""
    rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    for _, own in groupby(rows, itemgetter(0)):
        _, langs, n, words, counts = zip(*own)
        groups = sorted(set(langs))
        heads = np.repeat([groups.index(lang) for lang in langs], n)
        words = np.concatenate([np.frombuffer(w, np.uint64).reshape(size, -1) for w in words], axis=1)
        yield groups, heads, words.T, np.concatenate([_unpacked(packed, many) for packed, many in zip(counts, n)])


def _often(groups: list[str], heads: np.ndarray, words: np.ndarray, counts: np.ndarray, least: int) -> np.ndarray:
    """Where the phrases are whose hash comes up ``least`` times, the hash's own rows one behind the other."""
    hashes = np.empty(len(heads), np.uint64)
    for label, lang in enumerate(groups):
        own = heads == label
        hashes[own] = _phrase_hash(lang, list(words[own].T))
    order = np.argsort(hashes)
    hashes = hashes[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    enough = np.add.reduceat(counts[order], first) >= least
    return order[np.repeat(enough, np.diff(np.append(first, len(order))))]


def candidates(heads: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Heads and words of the distinct ones of some phrases, of which equal ones often follow each other."""
    new = np.append(True, (heads[1:] != heads[:-1]) | (words[1:] != words[:-1]).any(axis=1))
    heads, words = heads[new], words[new]
    known, codes = np.unique(np.append(words, heads.astype(np.uint64)[:, None], axis=1), return_inverse=True)
    found, _ = _distinct(list(codes.reshape(len(heads), -1).T), len(known))
    *words, heads = (known[f] for f in found)
    return heads.astype(np.int64), np.stack(words, axis=1)


def frequent_phrases(
    texts: DataFrame, shorter: DataFrame, size: int, least: int, longest: int, trie_phrases: int = TRIE_PHRASES
) -> DataFrame:
    """(lang, w1 ... w<size>, f) of the phrases that occur ``least`` times, given those a word shorter."""
    context = texts.sparkSession.sparkContext
    known = shorter.agg(F.count("*"), F.sum("f")).head()
    parts = context.broadcast(bitmap(phrase_hashes(shorter, size - 1), _bits(8 * known[0])))
    bits = _bits((known[1] or 0) / 4)  # a phrase occurs no more often than its first part
    places, n = reached(place_sums(texts, parts, size, longest, bits), least, bits)
    places = context.broadcast(places)
    # Half the bound of a trie, as hashes deal phrases out by chance.
    shards = max(SHARDS, -(-n // SHARD), -(-2 * n // (least * trie_phrases)))
    found = landed(count_dealt(dealt(texts, parts, places, size, longest, shards), size, least), f"phrases-{size}")
    parts.destroy()
    places.destroy()
    return found


def _distinct(columns: list[np.ndarray], words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of codes below ``words`` and how often each occurs."""
    if words ** len(columns) < 2**63:  # a row fits into one number
        key = columns[0].astype(np.int64)
        for column in columns[1:]:
            key *= words
            key += column
        key, counts = np.unique(key, return_counts=True)
        found = []
        for _ in columns:
            key, last = np.divmod(key, words)
            found.insert(0, last)
        return found, counts
    key = columns[0].astype(np.int64)
    for column in columns[1:]:  # numbered anew at each word, so that the key stays small
        key = np.unique(key, return_inverse=True)[1] * np.int64(words) + column
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return [column[first] for column in columns], counts


# Counting


def shared_trie(phrases: pa.Table) -> dict:
    """The trie of phrases (lang, w1, ...) as plain data, with the phrases themselves."""
    langs, words = phrases.column("lang"), phrases.drop_columns("lang").columns
    groups = sorted(pc.unique(langs).to_pylist())
    heads = pc.index_in(langs, pa.array(groups, pa.string())).to_numpy()
    words = np.stack([column.to_numpy().view(np.uint64) for column in words], axis=1)
    return _trie(groups, heads, words)


def _trie(groups: list[str], heads: np.ndarray, words: np.ndarray) -> dict:
    return PhraseTrie(groups, heads, words).arrays() | {"heads": heads, "words": words}


def trie_sums(texts: DataFrame, shared, longest: int) -> DataFrame:
    """``_SUMS`` of the phrases of a shared trie in all rows, by their place in it: a row per task and block."""

    def count(batches):
        trie = shared.value
        ends = np.zeros(len(trie["check"]), np.int64)
        for lang, numbers in _read(batches, longest):
            ends += np.bincount(walk(trie, lang, numbers, ROW_WORDS), minlength=len(ends))
        n = ends[trie["ends"]]
        met = np.flatnonzero(n)
        if len(met):
            yield _block_rows(met, n[met])

    return texts.mapInArrow(count, _SUMS)


def count_dealt(found: DataFrame, size: int, least: int) -> DataFrame:
    """(lang, w1 ... w<size>, f) of the phrases of ``_DEALT`` that occur ``least`` times, a trie per shard."""
    names = _names(size)

    def count(batches):
        for groups, heads, words, counts in _by_shard(batches, size):
            often = _often(groups, heads, words, counts, least)
            if not len(often):
                continue
            heads, words, counts = heads[often], words[often], counts[often]
            trie = _trie(groups, *candidates(heads, words))
            ends = np.zeros(len(trie["check"]), np.int64)
            for label, lang in enumerate(groups):
                own = heads == label
                at, state = walked(trie, lang, words[own], 1)
                ends += np.bincount(state, counts[own][at // size], len(ends)).astype(np.int64)  # sums below 2**53 are exact
            n = ends[trie["ends"]]
            met = np.flatnonzero(n >= least)
            langs = pa.array(groups, pa.string()).take(pa.array(trie["heads"][met]))
            columns = [langs, *(pa.array(w.view(np.int64)) for w in trie["words"][met].T.copy()), pa.array(n[met])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", *names, "f"])

    own = found.repartition("shard").sortWithinPartitions("shard")
    return own.mapInArrow(count, f"lang string, {', '.join(f'{w} long' for w in names)}, f long")


# Scores


def _part_counts(phrases: DataFrame, counts: dict[int, DataFrame], first: int, size: int, name: str) -> DataFrame:
    """``phrases`` with the count of the ``size`` words from place ``first`` on as ``name``."""
    renamed = {f"w{k + 1}": f"w{first + k}" for k in range(size)}
    part = counts[size].select("lang", *(F.col(a).alias(b) for a, b in renamed.items()), F.col("f").alias(name))
    return phrases.join(part, ["lang", *renamed.values()])


def _score(a: str, left: str, right: str) -> Column:
    """floor(10**6 a a / (l r)) in decimals wide enough for counts up to 10**14."""
    wide = lambda c: f"cast({c} as decimal(14,0))"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * {wide(a)} * {wide(a)}) div ({wide(left)} * {wide(right)})")


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    share: int = 50,
    top: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
    trie_phrases: int = TRIE_PHRASES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of each language.

    Texts are lower-cased from A to Z, parted at ``. , ; : ! ?`` and line ends into
    pieces and at spaces and tabs into words; a phrase is 2 to ``longest`` words of a
    piece that occur ``least`` times, overlaps included. ``a`` is its count, ``l`` and
    ``r`` those of its parts at the cut with the least score (the first of equal ones),
    ``n`` the number of all words of the language. Phrases inside a longer one that
    has ``share`` per cent of their occurrences or more are left out. Null text is empty, null
    language is ``und``. Repeated rows count as often as they come; languages without
    such phrases, and empty tables, give no rows.
    """
    texts, words = numbered_rows(docs, text_col, lang_col, longest)
    counts = {1: landed(words.filter(F.col("f") >= least), "phrases-1")}
    for size in range(2, longest + 1):
        counts[size] = frequent_phrases(texts, counts[size - 1], size, least, longest, trie_phrases)

    scored = None
    for size in range(2, longest + 1):
        rows, cuts = counts[size], []
        for k in range(1, size):
            rows = _part_counts(rows, counts, 1, k, f"l{k}")
            rows = _part_counts(rows, counts, k + 1, size - k, f"r{k}")
            score = _score("f", f"l{k}", f"r{k}").alias("score")
            cuts.append(F.struct(score, F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        rows = rows.withColumn("best", F.array_min(F.array(*cuts)))
        for more in range(size + 1, longest + 1):  # the most frequent longer phrase around it
            inside = [
                counts[more].select("lang", *(F.col(f"w{first + k}").alias(f"w{k + 1}") for k in range(size)), "f")
                for first in range(1, more - size + 2)
            ]
            around = inside[0]
            for one in inside[1:]:
                around = around.unionByName(one)
            most = around.groupBy("lang", *_names(size)).agg(F.max("f").alias("most"))
            held = 100 * F.col("most") >= share * F.col("f")
            rows = rows.join(most, ["lang", *_names(size)], "left").filter(F.col("most").isNull() | ~held).drop("most")
        for place in _names(size):
            spelt = counts[1].select("lang", F.col("w1").alias(place), F.col("word").alias(f"{place}_word"))
            rows = rows.join(spelt, ["lang", place])
        phrase = F.concat_ws(" ", *(f"{w}_word" for w in _names(size)))
        rows = rows.select("lang", phrase.alias("phrase"), F.col("f").alias("a"), "best.l", "best.r", "best.score")
        scored = rows if scored is None else scored.unionByName(rows)

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = landed(top_k(landed(scored, "phrases-scored"), ["lang"], top, order), "phrases-top")
    from_best = F.row_number().over(Window.partitionBy("lang").orderBy(*order))  # ``top`` rows each
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    ranked = best.withColumn("rank", from_best.cast("bigint")).join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

