"""Models reach tasks as plain data, and code by value: a worker need not have this package."""

import pickle
import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark import cloudpickle

import barloom.llm.queries  # noqa: F401  (registers the package to be shipped)
from barloom.llm import exact_dedup, language, secrets
from barloom.llm.bigru import BiGru
from barloom.llm.language import WordEvidence
from barloom.llm.queries import ORACLES, QUERIES
from barloom.llm.secrets import all_spans, loaded
from tests.oracle import connect, differences

WORKER = """
import pickle, sys
try:
    import barloom
    sys.exit("the package is there")
except ImportError:
    pass
work, data = pickle.load(open(sys.argv[1], "rb"))
print(pickle.loads(work)(pickle.loads(data)))
"""


def in_a_bare_worker(tmp_path, work, data):
    path = tmp_path / "work"
    path.write_bytes(pickle.dumps((cloudpickle.dumps(work), pickle.dumps(data))))
    command = [sys.executable, "-I", "-c", WORKER, str(path)]
    done = subprocess.run(command, capture_output=True, text=True, cwd=tmp_path, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.strip()


def test_secret_model(tmp_path):
    rows = [(k % 3 == 0, f"key{k % 5}=", f"a{k}b7" * 4 if k % 3 == 0 else f"plain{k}" * 3, " end") for k in range(300)]
    model = secrets.train(rows)
    texts = pa.array(["some key3=a2b7a2b7a2b7a2b7 end", "password=hunter2hunter2", None])
    work = lambda data: all_spans(texts.fill_null(""), loaded(data))
    data = secrets.plain(model)
    assert in_a_bare_worker(tmp_path, work, data) == str(work(data))
    assert b"barloom" not in pickle.dumps(data) and loaded(secrets.plain(None)) is None


def test_language_model(tmp_path):
    model = language.train([("en", w) for w in ("the", "with", "and")] * 9 + [("de", w) for w in ("und", "nicht", "mit")] * 9)
    work = lambda data: WordEvidence(BiGru.of(data[0]), len(data[1]))(pa.array(["the and", "und nicht"])).round(3).tolist()
    data = language.plain(model)
    assert in_a_bare_worker(tmp_path, work, data) == str(work(data))
    assert b"barloom" not in pickle.dumps(data) and language.plain(None) is None


@pytest.mark.parametrize("name", ["row", "norm", "bucket", "hash", "id", "_hash", "_norm", "_bucket", "_key", "key_id", "copies"])
def test_columns_of_any_name_stay(spark, rows, name):
    given = [(1, "a  b", "x"), (2, "a b", "y"), (2, "a b", "y"), (3, "c", "z"), (None, None, None), (None, "", "w")]
    docs = spark.createDataFrame(given, f"doc_id long, text string, `{name}` string")
    found = exact_dedup.drop_copies(docs)
    assert found.columns == ["doc_id", "text", name]
    got = rows(found)
    assert got[1:] == [(1, "a  b", "x"), (3, "c", "z")] and got[0] in given[4:]


def test_conversations_with_backslashes(spark, tmp_path):
    turns = [(1, 0, "user", r"a\b \\ \<|im_end|> </s>"), (1, 1, "assistant", "\\"), (2, 0, "user", None), (2, 1, "assistant", r"[INST]\[/INST]\n")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/c")
    (next((tmp_path / "c").glob("*.parquet"))).rename(tmp_path / "conversations.parquet")
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet'")
    assert differences(QUERIES["op8_chat_format"](spark, str(tmp_path)), con, ORACLES["op8_chat_format"]) == []
