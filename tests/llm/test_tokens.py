"""Token counts, packing and the piece lattice against the libraries and plain search."""

import hashlib
import itertools
import tracemalloc
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from barloom.llm.packing import WordIds, fill_patterns, nonnegative_least_squares, pack, plan_sequences
from barloom.llm.piece_lattice import _TOGETHER as SEGMENTED, Pieces, UnitPaths, apply_edits, decode, encode, lattice, n_best, units_of
from barloom.llm.queries import QUERIES, op4_piece_lattice
from barloom.llm.token_counts import RunLengths, load_tokenizer, token_counts
from barloom.llm.words import WordCodes, absent_mark, slices
from tests.llm.cases import TEXTS, documents

WORDS, BYTES = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = st.text(st.sampled_from("ab Z.,!'s\n\t\x1c\x85\u2003<|endoftext>é́Σß▁\ufdd007 "), max_size=60)


@pytest.fixture(scope="module")
def by_bytes():
    return load_tokenizer(BYTES)


@pytest.fixture(scope="module")
def by_words():
    return load_tokenizer(WORDS)


@pytest.fixture(scope="module")
def pieces():
    return Pieces(MODEL)


def test_token_counts(spark, by_bytes):
    found = token_counts(documents(spark), BYTES).collect()
    want = [(i, len((t or "").encode()), len(by_bytes.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in TEXTS]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert token_counts(documents(spark, []), BYTES).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=4))
def test_runs_count_as_whole_texts(by_bytes, texts):
    want = [len(by_bytes.encode(t, add_special_tokens=False).ids) for t in texts]
    assert RunLengths(by_bytes, {}).totals(pa.array(texts)).tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=4))
def test_words_have_the_ids_of_whole_texts(by_words, texts):
    ids, ends = WordIds(by_words)(pa.array(texts))
    found = [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]
    assert found == [by_words.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("letter, mark", [("J", "\u030c"), ("H", "\u0331"), ("T", "\u0308"), ("W", "\u0316\u030a"), ("Y", "\u030a")])
def test_marks_behind_capitals(by_words, letter, mark):
    texts = [f"a {letter}{mark}b, {letter.lower()}{mark} z", f"{letter}. {letter}"]
    ids, ends = WordIds(by_words)(pa.array(texts))
    found = [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]
    assert found == [by_words.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_mark_is_absent_and_found_without_listing_all_characters():
    texts = pa.array(["a", None, "\ufdd0 b\ufdd1", ""])
    tracemalloc.start()
    assert absent_mark(texts) == "\ufdd2" and absent_mark(texts.slice(3)) == absent_mark(texts[:0]) == "\ufdd0"
    assert absent_mark(pa.array(["".join(map(chr, range(0xFDD0, 0xFDF0))), "\U0010ffff"])) == "\U0010fffe"
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1 << 20


def test_a_full_table_of_words_starts_anew():
    seen = {}

    def learn(words, first):
        seen.update({first + k: w for k, w in enumerate(words)})

    def keep(codes):
        kept = [seen[k] for k in codes]
        seen.clear()
        seen.update(enumerate(kept))

    codes = WordCodes(learn, keep, limit=10)
    for turn in range(30):
        words = ["often", *(f"w{turn}-{k}" for k in range(4)), "x" * 100]
        assert [seen[k] for k in codes(pa.array(words)).tolist()] == words
    assert "often" in codes.known and len(codes.known) < 20


def test_pack(spark):
    limit, tokenizer = 256, load_tokenizer(WORDS)
    found = pack(documents(spark), WORDS, limit=limit).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in found:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append((row.offset, row["length"]))
    for doc, text, _ in TEXTS:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want = [(k, s, len(ids[s : s + limit]), zlib.crc32(ids[s : s + limit].tobytes())) for k, s in enumerate(range(0, len(ids), limit))]
        rows = [(r.piece, r.start, r["length"], r.ids_crc32) for r in by_doc[doc]]
        assert all(w in rows for w in want)
        if doc not in (None, 11):
            assert sorted(rows) == want
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    assert set(by_sequence) == set(range(len(by_sequence)))
    assert pack(documents(spark, []), WORDS).count() == 0


def test_units_of_a_batch_take_little_memory(pieces):
    """A task holds the arrays of one slice of texts at a time, however long the batch."""
    texts = pa.array(["the cat sat on a mat " * 100] * 2000)
    paths = UnitPaths(pieces, 3)
    list(paths(texts.slice(0, 1)))
    tracemalloc.start()
    try:
        for some in slices(texts, SEGMENTED):
            list(paths(some))
        assert tracemalloc.get_traced_memory()[1] < 64 << 20
    finally:
        tracemalloc.stop()


def test_pack_batches_of_several_slices(spark):
    sizes = [1_100_000, 3, 1_200_000, 5, 1_300_000, 7]
    docs = documents(spark, [(k, "abc def " * n, "en") for k, n in enumerate(sizes)]).coalesce(1)
    tokens = {row.doc_id: row.n for row in pack(docs, WORDS).groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()}
    each = len(load_tokenizer(WORDS).encode("abc def", add_special_tokens=False).ids)
    assert tokens == {k: each * n + 1 for k, n in enumerate(sizes)}


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_complete_and_near_the_bound(seed):
    draw = np.random.default_rng(seed)
    lengths = np.minimum(2048, draw.lognormal(6 + seed / 4, 1, 5000).astype(int) + 1)
    histogram = np.bincount(lengths, minlength=2049)
    plan, placed = plan_sequences(histogram, 2048), np.zeros(2049, int)
    for piece_lengths, count in plan:
        assert sum(piece_lengths) <= 2048 and count > 0
        for length in piece_lengths:
            placed[length] += count
    assert (placed == histogram).all()
    assert sum(n for _, n in plan) <= best_fit_sequences(lengths, 2048)


def best_fit_sequences(lengths, limit):
    """How many sequences plain best fit takes, longest piece first."""
    rooms = []
    for length in sorted(map(int, lengths), reverse=True):
        at = bisect_left(rooms, length)
        insort(rooms, (rooms.pop(at) if at < len(rooms) else limit) - length)
    return len(rooms)


def test_no_more_sequences_than_best_fit_on_documents(spark):
    packed = QUERIES["op3_best_fit_packing"](spark, "/root/testdata/sf0.01").select("sequence_id", "length").toPandas()
    best = best_fit_sequences(packed.length, 2048)
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    assert packed.sequence_id.nunique() <= best


def test_plan_of_few_or_no_pieces():
    assert plan_sequences(np.zeros(2049, int), 2048) == []
    one = np.zeros(11, int)
    one[[3, 7, 10]] = 1, 1, 2
    assert sorted(tuple(sorted(p)) for p, n in plan_sequences(one, 10) for _ in range(n)) == [(3, 7), (10,), (10,)]


def test_nonnegative_least_squares():
    matrix = fill_patterns(6, 3)
    wanted = matrix @ np.arange(matrix.shape[1], dtype=float)
    x = nonnegative_least_squares(matrix, wanted)
    assert x.min() >= 0 and np.allclose(matrix @ x, wanted, atol=1e-6)


# Piece lattice


def every_path(unit, pieces):
    ending, _ = lattice(unit, pieces)

    def back(at):
        if at == 0:
            yield 0.0, []
        for _, start, score, ids in ending[at]:
            for before, path in back(start):
                yield before + score, [*path, *ids]

    return sorted(back(len(unit)), key=lambda p: -p[0])


@pytest.mark.parametrize("unit", [" the", " token", " abcab", "  x", " é汉▁", "", "\n", " aaaaaaaa"])
def test_n_best_of_a_unit(pieces, unit):
    found, want = n_best(unit, pieces, 5), every_path(unit, pieces)[:5]
    assert [round(s, 4) for s, _ in found] == [round(s, 4) for s, _ in want]
    assert len({tuple(ids) for _, ids in found}) == len(found)


@pytest.mark.parametrize("text", ["the cat sat", "a b", "", "  x  y ", "a.\nb, c", "no no no"])
def test_n_best_of_a_text(pieces, text):
    units = units_of(pa.array([text]), pieces).to_pylist()[0]
    assert "".join(units) == " " + text
    combined = itertools.product(*[every_path(u, pieces)[:6] for u in units])
    want = sorted((sum(s for s, _ in c) for c in combined), reverse=True)[:3]
    best, score, others = next(iter(UnitPaths(pieces, 3)(pa.array([text]))))
    assert np.allclose([score, *(score - lost for lost, _ in others)], want)
    whole = every_path(" " + text, pieces) if len(text) < 9 else None
    assert whole is None or np.isclose(score, whole[0][0])


def test_encode_and_decode(spark, pieces):
    encoded = encode(documents(spark), MODEL)
    rows = decode(encoded, MODEL).collect()
    assert sorted(r.decoded for r in rows) == sorted(t or "" for _, t, _ in TEXTS)
    for row in rows:
        scores = [row.score, *(o.score for o in row.others)]
        assert scores == sorted(scores, reverse=True)
        for other in row.others:
            ids = apply_edits(row.ids, [e.asDict() for e in other.edits])
            assert b"".join(pieces.raw[k] for k in ids).decode()[1:] == row.decoded and ids != row.ids
    assert encode(documents(spark, []), MODEL).count() == 0


def test_piece_lattice_query_returns_paths_and_texts(spark):
    """The paths and the decoded text stand beside their digests and agree with them."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = op4_piece_lattice(spark, folder).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest() == r.ids_sha256
        assert (len(r.ids), len(r.others) + 1) == (r.n_pieces, r.n_paths)
        assert (r.decoded == (r.text or "")) == r.round_trip
        assert r.second_score == (r.others[0]["score"] if r.others else None)
