"""The recurrent network against finite differences, and languages on held-out documents."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barloom.llm.bigru import BiGru
from barloom.llm.language import SPAN, TRAINING_WORDS, WordEvidence, _sample, fold, predict_language, sequences, spans_of, train
from barloom.llm.queries import op7_language_id
from tests.llm.cases import LONG, TEXTS, documents

FOLDER = "/root/testdata/sf0.01"


def test_gradients():
    net = BiGru(3, seed=2)
    net.weights = {name: value.astype(np.float64) for name, value in net.weights.items()}
    x, mask, owner = sequences(["ab", "cdé", "x" * (SPAN + 3)])
    y = np.array([0, 2, 1])[owner]

    def loss():
        log_p, _ = net.forward(x, mask)
        return -(log_p[:, np.arange(len(y)), y].T * mask).sum() / mask.sum()

    for name, grad in net.gradients(x, mask, y).items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        net.weights[name][at] += 1e-5
        up = loss()
        net.weights[name][at] -= 2e-5
        assert grad[at] == pytest.approx((up - loss()) / 2e-5, rel=2e-2), name
        net.weights[name][at] += 1e-5


def test_every_position_of_every_word_counts():
    """Evidence by distinct word adds up to the network run over all words of a text."""
    net = BiGru(4, seed=1)
    texts = ["one two, three\ntwo", "", " \t", "y" * 500 + " é́", "one"]
    found = WordEvidence(net, 4)(pa.array(texts))
    for text, row in zip(fold(pa.array(texts)).to_pylist(), found):
        words = text.split()
        if not words:
            assert not row.any()
            continue
        x, mask, _ = sequences(words)
        log_p, _ = net.forward(x, mask)
        assert np.allclose(row, np.einsum("tnc,nt->c", log_p, mask) / len(words), atol=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = op7_language_id(spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_rows(spark):
    found = predict_language(documents(spark), F.col("doc_id") != 7).collect()
    assert len(found) == len(TEXTS)
    answers = {r.doc_id: (r.lang_pred, r.score) for r in found if r.doc_id is not None}
    assert answers[2] == answers[3] == answers[4] == ("und", 0.0)
    assert {a for a, _ in answers.values()} <= {"en", "de", "fr", "es", "xx", "und"} and len(LONG) > 400_000


def test_nothing_to_learn_from(spark):
    assert {r.lang_pred for r in predict_language(documents(spark), F.lit(False)).collect()} == {"und"}
    assert predict_language(documents(spark, []), F.lit(True)).count() == 0
    assert train([]) is None


def unspaced(lang, first, last, docs, seed):
    """Documents of a script without spaces: every clause is far longer than a span."""
    draw = random.Random(seed)
    letters = [chr(c) for c in range(first, last) if chr(c).isalpha()]
    clause = lambda: "".join(draw.choices(letters, k=draw.randint(25, 60)))
    return [(draw.getrandbits(40), "。".join(clause() for _ in range(5)), lang) for _ in range(docs)]


def test_languages_without_spaces(spark):
    """A language whose words are all longer than a span is learnt and predicted like any other."""
    spaced = [(10**13 + k, " ".join(random.Random(k).choices(LONG.split()[:500], k=40)), "en") for k in range(120)]
    rows = spaced + unspaced("zh", 0x4E00, 0x4F00, 120, 1) + unspaced("th", 0xE01, 0xE2F, 120, 2)
    clauses = [w for _, text, lang in rows if lang != "en" for w in fold(pa.array([text]))[0].as_py().split() if w != "。"]
    assert all(len(w.encode()) > SPAN for w in clauses)
    learn_from = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    docs = documents(spark, rows)
    found = predict_language(docs, learn_from).join(docs.select("doc_id", "lang"), "doc_id").filter(~learn_from).collect()
    assert {r.lang for r in found} == {"en", "zh", "th"}
    for lang in ("en", "zh", "th"):
        assert np.mean([r.lang_pred == lang for r in found if r.lang == lang]) >= 0.9, lang


def test_spans_hold_whole_characters():
    words = ["汉" * 25, "a" + "é" * 40, "x" * 61, "a" + "😀" * 9, "short"]
    spans, owner = spans_of(words)
    assert all(len(span) <= SPAN + 2 for span in spans)
    for number, word in enumerate(words):
        assert "".join(span[1:-1].decode() for span, of in zip(spans, owner) if of == number) == word


def test_every_language_is_learnt(spark):
    """70 languages, the last 6 rarer than the others, each in 64 letters of its own."""
    draw, rows = random.Random(5), []
    for k in range(70):
        letters = [chr(0x4E00 + 64 * k + j) for j in range(64)]
        for _ in range(20 if k < 64 else 14):
            words = ["".join(draw.choices(letters, k=3)) for _ in range(32)]
            rows.append((draw.getrandbits(40), " ".join(words), f"l{k:02}"))
    rows += [(3, "q w", "once")] + [(4, "汉字 q", "copies")] * 3000
    learn_from = (F.crc32(F.col("doc_id").cast("string")) % 3 != 1) | (F.col("doc_id") < 5)
    docs = documents(spark, rows)
    pairs = _sample(docs, "doc_id", "text", "lang", learn_from)
    assert {lang for lang, _ in pairs} == {lang for _, _, lang in rows}
    assert sum(lang == "copies" for lang, _ in pairs) <= 2
    found = predict_language(docs, learn_from).join(docs.select("doc_id", "lang"), "doc_id").filter(~learn_from).collect()
    rare = [r.lang_pred == r.lang for r in found if r.lang >= "l64"]
    assert len(rare) > 10 and np.mean(rare) >= 0.5


def test_documents_give_different_words(spark):
    """Documents that share their words do not all give the same 32 of them."""
    words = [f"w{k}" for k in range(300)]
    docs = documents(spark, [(k, " ".join(words), "en") for k in range(60)])
    pairs = _sample(docs, "doc_id", "text", "lang", F.lit(True))
    assert len(pairs) == 60 * TRAINING_WORDS
    assert len({word for _, word in pairs}) > 200
