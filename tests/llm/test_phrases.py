"""Collocations against a loop over all positions; tries against a dictionary."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import phrases
from barloom.llm.phrase_trie import PhraseTrie, walk
from barloom.llm.phrases import TRIE_PHRASES, _distinct, collocations, shared_trie
from tests.llm.cases import SCHEMA, TEXTS, documents


def expected(rows, longest=3, least=10, share=50, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, found in counts.items():
        held = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        covered = set()
        for long, f in held.items():
            for size in range(2, len(long)):
                for k in range(len(long) - size + 1):
                    if 100 * f >= share * found[long[k : k + size]]:
                        covered.add(long[k : k + size])
        scored = []
        for phrase, a in held.items():
            cuts = [(10**6 * a * a // (found[phrase[:k]] * found[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            if phrase not in covered:
                text = " ".join(phrase)
                scored.append((-score, -a, text.encode(), text, a, found[phrase[:k]], found[phrase[k:]], score))
        for rank, (_, _, _, text, a, left, right, score) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, text, a, left, right, totals[lang], score))
    return sorted(out)


def mixed_texts(seed=3, rows=300):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["New", "new", "york", "ünï", "a", "a", "a b", "x" * 90, "\x85"]
    marks = [" ", " ", "  ", "\t", ". ", ",", "\n", "! ", " ; "]
    found = []
    for k in range(rows):
        words = draw.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=draw.randint(0, 60))
        found.append((k, "".join(w + draw.choice(marks) for w in words), draw.choice(["en", "en", "de", None])))
    return found + [(900, "a a a a a a a a a a a a a a a", "fr"), (901, None, "en"), (902, "", None), (None, "a b c", None)]


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("options", [{}, {"least": 4, "longest": 4, "top": 25}, {"least": 3, "share": 80, "trie_phrases": 40}])
def test_collocations(spark, options):
    rows = mixed_texts()
    found = collocations(documents(spark, rows).repartition(5), **options)
    assert found.columns == COLUMNS and [f.dataType.simpleString() for f in found.schema][3:] == ["bigint"] * 5
    plain = {k: v for k, v in options.items() if k != "trie_phrases"}
    assert sorted(map(tuple, found.collect())) == expected(rows, **plain)


def test_awkward_texts_and_repeated_rows(spark):
    rows = TEXTS * 10
    assert sorted(map(tuple, collocations(documents(spark, rows)).collect())) == expected(rows)


def test_empty_tables(spark):
    assert collocations(documents(spark, [])).collect() == []
    assert collocations(documents(spark, [(1, None, None), (2, "one two", "en")])).collect() == []


def test_clashing_columns(spark):
    kind = SCHEMA + ", word string, w1 long, f long, n long, words string, codes int"
    rows = [(k, "one two three", "en", "s", 1, 1, True, 1, "r", "w", 1, 2, 3, "x", 4) for k in range(12)]
    found = collocations(spark.createDataFrame(rows, kind)).collect()
    assert [tuple(r) for r in found] == [("en", 1, "one two three", 12, 12, 12, 36, 10**6)]


@pytest.mark.parametrize("first_of", [1, 3, 1000])
def test_places_that_many_phrases_share(spark, monkeypatch, first_of):
    for name, value in {"BITS": 1 << 10, "BLOCK": 1 << 4, "FIRST_OF": first_of, "ROW_WORDS": 8, "_SUMMED": 200}.items():
        monkeypatch.setattr(phrases, name, value)
    rows = mixed_texts(5, 200)
    assert sorted(map(tuple, collocations(documents(spark, rows).repartition(3)).collect())) == expected(rows)


def test_rows_sent_to_count_phrases(spark):
    """A row per task and block of phrases, however many phrases a task meets."""
    draw = random.Random(6)
    rows = [(k, " ".join(f"w{draw.randrange(30)}" for _ in range(400)), "en") for k in range(40)]
    texts, words = phrases.numbered_rows(documents(spark, rows).repartition(4), "text", "lang", 2)
    found = phrases.frequent_phrases(texts, words, 2, 1, 2)
    pairs = Counter(pair for _, text, _ in rows for pair in zip(text.split(), text.split()[1:]))
    assert found.count() == len(pairs) >= 890
    shared = spark.sparkContext.broadcast(shared_trie(found.drop("f").toArrow()))
    held = phrases.trie_sums(texts, shared, 2)
    tasks = texts.select(phrases.F.spark_partition_id()).distinct().count()
    sent = held.toArrow().to_batches()
    assert sum(map(len, sent)) == tasks
    assert sum(sums.sum() for batch in sent for _, sums in phrases._block_sums([batch])) == sum(pairs.values())


@pytest.mark.parametrize("trie_phrases", [4, TRIE_PHRASES])
def test_rows_are_read_twice_however_many_tries_it_takes(spark, trie_phrases):
    rows = mixed_texts(7, 200)
    texts, words = phrases.numbered_rows(documents(spark, rows).repartition(3), "text", "lang", 2)
    n, read = texts.count(), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    found = phrases.frequent_phrases(texts.mapInArrow(seen, texts.schema), words, 2, 3, 2, trie_phrases)
    names = {r.w1: r.word for r in words.collect()}
    pairs = [(r.lang, f"{names[r.w1]} {names[r.w2]}", r.f) for r in found.collect()]
    wanted = expected(rows, longest=2, least=3, top=10**6)
    assert sorted(pairs) == sorted(row[:1] + row[2:4] for row in wanted) and len(pairs) > 100
    assert read.value == 2 * n


def test_phrases_that_share_a_hash(spark, monkeypatch):
    """All phrases of a language have one of 16 hashes, in a few shards; their counts are still their own."""
    whole = phrases._phrase_hash
    monkeypatch.setattr(phrases, "_phrase_hash", lambda lang, words: whole(lang, words) & np.uint64((3 << 60) + (3 << 20)))
    for name, value in {"BITS": 1 << 10, "BLOCK": 1 << 4, "ROW_WORDS": 8, "SHARDS": 3, "_SUMMED": 600}.items():
        monkeypatch.setattr(phrases, name, value)
    rows = mixed_texts(8, 200)
    found = collocations(documents(spark, rows).repartition(3), least=4)
    assert sorted(map(tuple, found.collect())) == expected(rows, least=4)


def test_packed_sums():
    draw = np.random.default_rng(9)
    total = Counter()
    batches = []
    for sign, most in [(1, 200), (1, 1 << 40), (-1, 70_000)]:
        places = np.sort(draw.choice(3 * phrases.BLOCK, 500, replace=False))
        counts = draw.integers(1, most, 500)
        batches.append(phrases._block_rows(places, counts, sign))
        for place, n in zip(places.tolist(), counts.tolist()):
            total[place] += sign * n
    rows = pa.Table.from_batches(batches).sort_by("block").to_batches()
    found = {}
    for block, sums in phrases._block_sums(rows):
        found |= {block * phrases.BLOCK + k: int(sums[k]) for k in np.flatnonzero(sums).tolist()}
    assert found == {place: n for place, n in total.items() if n}


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_trie_walk(depth):
    draw = np.random.default_rng(depth)
    numbers = np.unique(draw.integers(0, 2**63, 60).astype(np.uint64))
    draw.shuffle(numbers)
    words = np.unique(numbers[draw.integers(0, 50, (400, depth))], axis=0)
    heads = draw.integers(0, 2, len(words))
    trie = PhraseTrie(["de", "en"], heads, words)
    data = trie.arrays()
    assert len(np.unique(data["ends"])) == len(words)
    numbers = np.append(numbers, np.uint64(0))
    codes = draw.integers(0, len(numbers), (60, 80 + depth - 1))
    codes[draw.random(codes.shape) < 0.5] %= 8
    texts = numbers[codes]
    for label, lang in enumerate(["de", "en"]):
        seen = Counter(tuple(row[k : k + depth].tolist()) for row in texts for k in range(80) if row[k : k + depth].all())
        counts = np.bincount(walk(data, lang, texts, 80), minlength=len(data["check"]))
        own = heads == label
        assert [int(counts[e]) for e in data["ends"][own]] == [seen[tuple(w)] for w in words[own].tolist()]
    assert len(walk(data, "fr", texts, 80)) == 0


def test_trie_without_phrases():
    data = PhraseTrie([], np.empty(0, np.int64), np.empty((0, 2), np.uint64)).arrays()
    assert len(walk(data, "en", np.array([[3, 3, 0]], np.uint64), 2)) == 0


def test_the_largest_trie_fits_into_the_driver():
    draw, rows = np.random.default_rng(7), 40_000
    pairs = draw.permutation(rows * 5)[:rows]
    columns = [draw.choice(["de", "en"], rows).tolist(), pairs // 500, pairs % 500]
    phrases = pa.table(dict(zip(["lang", "w1", "w2"], columns)))
    tracemalloc.start()
    data = shared_trie(phrases)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(np.unique(data["ends"])) == rows
    assert most / rows * TRIE_PHRASES / 2 < 100 << 20  # half the bound on average


def test_distinct_rows_of_codes():
    draw = np.random.default_rng(4)
    columns = [draw.integers(0, 5, 300) for _ in range(3)]
    seen = Counter(zip(*(c.tolist() for c in columns)))
    for words in (5, 1 << 21):  # in one number, and numbered anew
        rows, counts = _distinct(columns, words)
        assert dict(zip(zip(*(r.tolist() for r in rows)), counts.tolist())) == seen
