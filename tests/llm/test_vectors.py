"""Vector codes against loops over whole numbers; neighbour search against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import neighbour_graph as graphs
from barloom.llm.neighbour_graph import build, search, sound_vectors
from barloom.llm.queries import QUERIES
from barloom.llm.vector_codes import codebooks_digest, compress, nearest, reconstructed, whole_numbers, with_label_error

SCHEMA = "vec_id long, embedding array<float>, label int, id long, codes string, vector string, node long, q long"
AWKWARD = [None, [], [1.0, None, 0.0, 1.0] * 4, [float("nan")] * 16, [float("inf")] + [0.0] * 15]


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 7, "c", "v", 8, 9) for i, v, label in rows], SCHEMA)


def vectors(seed=2, rows=90, width=16):
    draw = random.Random(seed)
    grid = [-0.5, -0.25, -1e-5, 0.0, 0.125, 0.5, 0.75]
    found = [(k, [draw.choice(grid) for _ in range(width)], draw.choice([1, 2, None])) for k in range(rows)]
    found += [(k + 1000, list(found[0][1]), 3) for k in range(40)] + [(2, list(found[2][1]), 1), (None, [0.25] * width, 2)]
    return found + [(-k - 1, v, 1) for k, v in enumerate(AWKWARD)]


def kept(rows):
    return [(i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]


def coded(rows, parts=8, entries=16, rounds=6):
    """Codes, errors and codebooks by loops, each part against each entry."""
    rows = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in kept(rows)]
    width = len(rows[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda v, p: min((far(cut(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        nearest = [[best(v, p)[1] for p in range(parts)] for _, v, _ in rows]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), found in zip(rows, nearest) if found[p] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = [[best(v, p) for p in range(parts)] for _, v, _ in rows]
    errors = [sum(d for d, _ in f) for f in found]
    totals = {}
    for (_, _, label), e in zip(rows, errors):
        totals[label] = totals.get(label, 0) + e
    out = [(i, label, tuple(k for _, k in f), e, totals[label]) for (i, _, label), f, e in zip(rows, found, errors)]
    return sorted(out, key=str), books


@pytest.mark.parametrize("rows", [vectors(), vectors(4, 9), vectors(5, 30, 8)])
def test_codes(spark, rows):
    found, books = compress(table(spark, rows).repartition(4))
    wanted, wanted_books = coded(rows)
    assert books.tolist() == wanted_books
    got = with_label_error(found).select("id", "label", "codes", "error", "label_error").collect()
    assert sorted(((i, label, tuple(c), e, t) for i, label, c, e, t in got), key=str) == wanted


def test_equal_average_search():
    draw = np.random.default_rng(1)
    for width in (1, 3, 8):
        for entries in (1, 2, 16):
            parts, book = draw.integers(-6, 6, (500, width)), draw.integers(-6, 6, (entries, width))
            distance = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
            entry, best = nearest(parts, book)
            assert (entry == distance.argmin(axis=1)).all() and (best == distance.min(axis=1)).all()


def test_codes_of_empty_tables_and_other_lengths(spark):
    for rows in ([], [(1, None, 1)], [(None, [1.0] * 8, 1)]):
        found, books = compress(table(spark, rows))
        assert books is None and with_label_error(found).collect() == []
        assert len(codebooks_digest(books)) == 64
    found, books = compress(table(spark, [(1, [1.0] * 8, 1), (2, [1.0] * 16, 1), (3, [0.5] * 8, None)]))
    assert sorted(r.id for r in found.collect()) == [1, 3]
    row = found.filter("id = 3").first()
    assert reconstructed(row.codes, books).tolist() == [2048] * 8 and row.error == 0
    with pytest.raises(ValueError):
        compress(table(spark, [(1, [1.0] * 9, 1)]))
    with pytest.raises(ValueError):
        whole_numbers(np.array([[1e9]]), 4096, 8)


def brute(rows, asked, k):
    ids = [(i, v) for i, v, _ in kept(rows) if i is not None and any(v)]
    width = len(min(ids)[1])
    ids = sorted({(i, tuple(np.float32(v).tolist())) for i, v in ids if len(v) == width})
    out = {}
    for q, v in ids:
        if q in asked:
            v = np.array(v)
            scores = [(-float(graphs.cosine(v, np.array(w))), i) for i, w in ids if i != q]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found_by(spark, rows, asked, k=5):
    sound = sound_vectors(table(spark, rows).repartition(3))
    found = search(build(sound), sound.filter(F.col("id").isin(asked)), k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    out = {}
    for q, rank, i, score in sorted(map(tuple, found.collect())):
        assert rank == len(out.setdefault(q, [])) + 1
        out[q].append((i, score))
    return out


@pytest.mark.parametrize("rows", [vectors(7, 4), vectors(8, 3, 8) + [(50, [0.0] * 8, 1), (51, [1.0] * 4, 1)]])
def test_small_tables_give_all_candidates(spark, rows):
    asked = [0, 1, 2, 5, 1001, -1]
    assert found_by(spark, rows, asked) == brute(rows, asked, 5)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [2.0, 0.0], 1)]
    found = found_by(spark, rows, [1, 2, 3])
    assert found == {1: [(3, 1.0), (2, 0.0)], 2: [(1, 0.0), (3, 0.0)], 3: [(1, 1.0), (2, 0.0)]}
    assert found_by(spark, [(1, [1.0, 0.0], 1)], [1]) == {}
    assert found_by(spark, [], [1]) == {}


def test_hot_vector_and_clusters(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(6, 24))
    rows = [(k, (centres[k % 6] + 0.05 * draw.normal(size=24)).tolist(), 1) for k in range(300)]
    rows += [(1000 + k, draw.normal(size=24).tolist(), 1) for k in range(300)]
    rows += [(5000 + k, centres[0].tolist(), 1) for k in range(300)]
    asked = [k for k, _, _ in rows if k % 20 == 0]
    found, wanted = found_by(spark, rows, asked), brute(rows, asked, 5)
    assert found.keys() == wanted.keys() and all(len(f) == 5 for f in found.values())
    for q in (5000, 5020):  # its copies come first, by id
        assert [i for i, _ in found[q]] == [i for i, _ in wanted[q]]
    hits = sum(len(set(found[q]) & set(wanted[q])) for q in asked)
    assert hits >= 0.95 * 5 * len(asked)


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op11_nearest_neighbours"](spark, folder).collect()
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for at in np.flatnonzero(ids % 50 == 0):
        near = x @ x[at]
        near[at] = -9
        top = set(ids[np.lexsort((ids, -near))[:5]].tolist())
        hits += len(top & {r.vec_id for r in found if r.query_id == ids[at]})
    assert len(found) == 5 * (ids % 50 == 0).sum() and hits >= 0.9 * len(found)
