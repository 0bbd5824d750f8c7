"""The pipeline stage by stage, and every query of these operators against its SQL."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm.queries import ORACLES, QUERIES
from barloom.llm.secrets import base_spans
from tests.llm.cases import near_components
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == []


def test_lattice_query_round_trip(spark):
    rows = QUERIES["op4_piece_lattice"](spark, FOLDER)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert rows.count() == rows.filter("round_trip").count() == documents


def test_secret_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for row in QUERIES["op2_secret_scan"](spark, FOLDER).collect():
        spans = base_spans(texts[row.doc_id])
        kinds = [kind for _, _, kind in spans]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(map(kinds.count, ("assign", "access", "hex")))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {"documents": docs}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{number}")
        docs = seen[name] = spark.read.parquet(f"{tmp_path}/{number}")
        assert name == "best_fit_packing" or docs.columns == columns
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in seen.items()}
    verdicts = QUERIES["op6_quality_rules"](spark, FOLDER)
    assert ids["quality_rules"] == {r.doc_id for r in verdicts.filter("kept").collect()}

    least = {}
    for row in seen["quality_rules"].collect():
        text = re.sub(r"[\x20\x09-\x0D]+", " ", row.text or "")
        least[text] = min(row.doc_id, least.get(text, row.doc_id))
    assert ids["exact_dedup"] == set(least.values())

    rows = [(r.doc_id, r.text, r.lang) for r in seen["exact_dedup"].collect()]
    assert ids["near_dedup"] == {d for d, (_, c) in near_components(rows).items() if d == c}

    assert ids["secret_scan"] == ids["near_dedup"] == ids["best_fit_packing"]
    assert not any(base_spans(r.text or "") for r in seen["secret_scan"].collect())
    before = seen["near_dedup"].select("doc_id", F.col("text").alias("t"), F.col("n_chars").alias("n"))
    for row in seen["secret_scan"].join(before, "doc_id").collect():
        same = row.t == row.text
        assert (row.n_chars == row.n) if same else (row.n_chars - row.n == len(row.text) - len(row.t) and "[SECRET]" in row.text)
