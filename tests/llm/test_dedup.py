"""Exact and near copies against loops over all documents."""

import hashlib
import re
from collections import defaultdict
from unittest import mock

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from barloom.llm import near_dedup
from barloom.llm.components import components
from barloom.llm.exact_dedup import drop_copies, exact_groups
from tests.llm.cases import TEXTS, corpus, documents, near_components


def plain_groups(rows):
    groups = defaultdict(list)
    for doc, text, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc)
    return groups


@pytest.mark.parametrize("rows", [TEXTS, corpus()], ids=["awkward", "corpus"])
def test_exact_groups(spark, rows):
    found = exact_groups(documents(spark, rows), hash_all=True, prefix_chars=8).collect()
    assert len(found) == len(rows)
    by_hash = defaultdict(list)
    for row in found:
        by_hash[row.text_hash].append(row)
    for text, docs in plain_groups(rows).items():
        group = by_hash.pop(hashlib.sha256(text.encode()).hexdigest())
        least = min((d for d in docs if d is not None), default=None)
        assert {(r.keep_id, r.group_size) for r in group} == {(least, len(docs))}
        assert sorted(map(str, docs)) == sorted(str(r.doc_id) for r in group)
        assert [r.doc_id for r in group if r.kept] == [least]
    assert not by_hash


def test_hashes_are_only_made_for_rows_in_question(spark):
    found = {r.doc_id: r.text_hash for r in exact_groups(documents(spark, [(0, "abc", "en"), (1, "abd", "en"), (2, "abc", "en")])).collect()}
    assert found[1] is None and found[0] == found[2] == hashlib.sha256(b"abc").hexdigest()


def test_drop_copies(spark):
    kept = drop_copies(documents(spark)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(map(str, [0, 1, 2, 4, 5, None, 7, 8, 9, 10]))
    one = next(r for r in kept if r.doc_id == 7)
    assert one.text.startswith("word0") and one["length"] == 1 and one["row"] == "r"
    # "One" and "one" differ; a blank text is one space, not an empty one.


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert exact_groups(empty).count() == 0 and drop_copies(empty).count() == 0
    assert near_dedup.near_groups(empty).count() == 0


def check_near(spark, rows):
    found = {r.doc_id: r for r in near_dedup.near_groups(documents(spark, rows)).collect()}
    want = near_components(rows)
    assert {d: (r.n_shingles, r.component_id) for d, r in found.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


@settings(deadline=None)
@given(st.lists(st.integers(0, 12), max_size=60), st.integers(1, 9), st.integers(1, 6))
def test_runs_of_rows_split_no_node(nodes, size, limit):
    nodes = np.array(sorted(nodes), np.int64)
    batches = [pa.RecordBatch.from_arrays([pa.array(nodes[k : k + size])], ["node"]) for k in range(0, len(nodes), size)]
    with mock.patch.object(near_dedup, "NODE_SIZE", limit):
        runs = [run.column(0).to_pylist() for run in near_dedup._whole_nodes(batches)]
    assert [x for run in runs for x in run] == nodes.tolist() and all(runs)
    assert all(a[-1] != b[0] for a, b in zip(runs, runs[1:]))


def test_near_groups(spark):
    check_near(spark, corpus(2, 40))


def test_near_groups_in_deep_trees_and_blocks(spark, monkeypatch):
    """Nodes of more than six classes branch, and those left at the second level go by blocks."""
    monkeypatch.setattr(near_dedup, "NODE_SIZE", 6)
    monkeypatch.setattr(near_dedup, "DEPTH", 2)
    monkeypatch.setattr(near_dedup, "PIVOTS", 1)
    check_near(spark, corpus(3, 25))


def test_near_groups_of_awkward_rows(spark):
    found = near_dedup.near_groups(documents(spark)).collect()
    assert len(found) == len(TEXTS)
    known = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is not None}
    assert known[0] == (7, 0, True) and known[1] == (7, 0, False) and known[11] == (7, 0, False)
    assert known[2] == known[2][:1] + (2, True) == (0, 2, True) and known[3] == (0, 3, True) and known[4] == (0, 4, True)
    assert known[5] == (1, 5, True) and known[6] == (1, 5, False) and known[8] == (1, 8, True)
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)] * 2


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(201, 200), (200, 201)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
