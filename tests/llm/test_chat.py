"""Reply trees against walks by hand, and the way back from every format."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from barloom.llm.chat import CONTROLS, END, START, escape, format_trees, format_turns, linear_trees, read_back, read_turns, unescape

PARTS = st.lists(st.sampled_from([*CONTROLS, "\\", "\\:", "<|", "|>", "im_start", "\n", "n", "a", "[", "<", "é"]), max_size=8).map("".join)


@settings(deadline=None)
@given(PARTS)
def test_escapes_can_be_undone(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROLS)


@settings(deadline=None)
@given(st.lists(st.tuples(PARTS, PARTS), max_size=4))
def test_turns_come_back(turns):
    text, _ = format_turns(turns)
    assert read_turns(text) == turns
    assert text.count(START) == text.count(END) == len(turns)


def trees(spark, rows):
    frame = spark.createDataFrame(rows, "t string, id long, up long, role string, text string, score double, tree string, branch int")
    columns = [F.col(c) for c in ("t", "id", "up", "score")]
    return lambda branches: format_trees(frame, *columns, branches=branches)


def said(row):
    return [text for _, text in read_turns(row.formatted)]


def row(tree, id, up, text, score=0.0, role="user"):
    return (tree, id, up, role, text, score, "other", 9)


ROWS = [
    row("a", 1, None, "root", 1.0),
    row("a", 2, 1, "low", 0.0, "assistant"),
    row("a", 3, 1, "high", 5.0, "assistant"),
    row("a", 4, 3, "deep", 0.0),
    row("a", 5, 4, "deeper", 0.0, "assistant"),
    row("a", 6, 2, "best", 9.0),
    row("a", 2, 1, "low", 0.0, "assistant"),  # repeated
    row("b", 1, 99, "orphan", None),
    row("b", 2, None, None, None, None),
    row("c", 1, 2, "circle"),
    row("c", 2, 1, "circle"),
    row(None, None, None, "no key", 0.0),
]


def test_branches_are_ranked_by_mean_score(spark):
    found = {(r.tree, r.branch): said(r) for r in trees(spark, ROWS)(None).collect()}
    assert found == {
        ("a", 1): ["root", "low", "best"],
        ("a", 2): ["root", "high", "deep", "deeper"],
        ("b", 1): ["orphan"],
        ("b", 2): [""],
        ("", 1): ["no key"],
    }


def test_only_the_best_branch(spark):
    rows = trees(spark, ROWS)(1).collect()
    best = {r.tree: r for r in rows}
    assert len(rows) == 3 and said(best["a"]) == ["root", "low", "best"]
    (span,) = best["a"].loss_spans
    assert best["a"].formatted[span.start : span.end] == "low"
    assert trees(spark, [])(1).count() == 0


def test_a_deep_chain_takes_few_joins(spark):
    rows = [row("t", k, k - 1 if k else None, f"m{k}", 0.0) for k in range(300)]
    rows += [row("t", 1000 + k, k, f"side{k}", -1.0) for k in range(0, 298, 7)]
    (found,) = trees(spark, rows)(1).collect()
    assert said(found) == [f"m{k}" for k in range(300)]


def test_conversations(spark):
    rows = [(1, 2, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "assistant", "b"), (1, None, None, None), (None, 0, "user", END)]
    turns = linear_trees(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    place = F.col("_at")
    formatted = format_trees(turns, F.col("tree"), place, F.when(place > 1, place - 1), F.lit(0.0))
    assert {r.tree: read_turns(r.formatted) for r in formatted.collect()} == {
        '{"conv_id":1}': [("", ""), ("user", "a"), ("assistant", "b"), ("assistant", "b")],
        "{}": [("user", END)],
    }
    back = {r.tree: r for r in read_back(formatted).collect()}
    assert back['{"conv_id":1}'].loss_chars == 2 and back["{}"].n_turns == 1 and back["{}"].loss_chars == 0
