"""Reply trees as conversations: root-to-leaf paths, ranked by score, one text for each.

Messages know their parent. Self-joins double the reach of every message's pointer to its
ancestors, and the score summed on the way, so a chain of n messages takes log2(n) joins
instead of n. Leaves are then ranked by the mean score of their path, and the same pointers
give the messages of the chosen paths, again doubling by join; only these are formatted. A path is
formatted by one task as its messages stream by, in order.

A text is made of turns ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside roles and
texts are broken up by an escape that can be undone, so a text can't open or end a turn.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.operators.keyed import landed

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of this template and of others a model may know.
CONTROLS = (START, END, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_AT_CONTROL = re.compile(f"(?=({'|'.join(map(re.escape, CONTROLS))}))(.)", re.S)
_ESCAPED, _UNDONE = re.compile(r"\\(.)", re.S), {"\\": "\\", ":": "", "n": "\n"}
LEARNT_ROLE = "assistant"
_FORMATTED = "branch int, n_messages long, formatted string, loss_spans array<struct<start:long,end:long>>"


def escape(text: str) -> str:
    r"""Backslashes twice, and ``\:`` behind the first character of a control string."""
    return _AT_CONTROL.sub(r"\2\\:", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _UNDONE[m[1]], text)


def format_turns(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of a conversation, and where in it the model's own words lie (code points)."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head = f"{START}{escape(role or '').replace(chr(10), chr(92) + 'n')}\n"
        body = escape(text or "")
        if role == LEARNT_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text; exactly what ``format_turns`` was given, null as empty."""
    turns = []
    for turn in formatted.split(f"{END}\n")[:-1]:
        role, _, text = turn.removeprefix(START).partition("\n")
        turns.append((unescape(role), unescape(text)))
    return turns


# Trees


def _jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables (tree, id, up, score, depth): 1, 2, 4, ... messages up; and all messages at the end.

    ``score`` and ``depth`` sum up the messages from id, inclusive, to ``up``, exclusive; a null
    ``up`` says that the root is among them. The tables hold the others only, and a tree
    leaves the rounds once all its messages have reached the root, so a few deep trees
    don't make all others go through their rounds. Messages that answer each other in a
    circle never do; they are given up when the pointers are longer than the table.
    """
    known = nodes.select("tree", F.col("id").alias("parent"), F.lit(True).alias("known"))
    up = F.when(F.col("known"), F.col("parent")).alias("up")
    jump = nodes.join(known, ["tree", "parent"], "left")
    jump = landed(jump.select("tree", "id", up, "score", F.lit(1).cast("bigint").alias("depth")), "jump")
    steps, whole, reach, rows = [], None, 1, nodes.count()
    while reach <= rows:
        on_the_way = jump.filter(F.col("up").isNotNull())
        trees = landed(on_the_way.select("tree").distinct(), "trees")
        if trees.isEmpty():
            break
        steps.append(on_the_way)
        finished = jump.join(trees, "tree", "left_anti")
        whole = finished if whole is None else whole.unionByName(finished)
        live = jump.join(trees, "tree", "left_semi")
        live = landed(live, "live")
        a, b = live.filter(F.col("up").isNotNull()).alias("a"), live.alias("b")
        both = a.join(b, (F.col("a.tree") == F.col("b.tree")) & (F.col("a.up") == F.col("b.id")))
        more = [(F.col(f"a.{c}") + F.col(f"b.{c}")).alias(c) for c in ("score", "depth")]
        moved = both.select("a.tree", "a.id", F.col("b.up").alias("up"), *more)
        jump = landed(moved.unionByName(live.filter(F.col("up").isNull())), "jump")
        reach *= 2
    return steps, jump if whole is None else whole.unionByName(jump)


def paths(nodes: DataFrame, branches: int | None) -> DataFrame:
    """(tree, branch, place, id): the messages of the chosen paths, from the root on.

    ``nodes`` are (tree, id, parent, score). Paths are ranked by mean score, then by the id of
    their leaf; ``branches`` of each tree are chosen, None takes all.
    """
    steps, whole = _jumps(nodes)
    parents = nodes.select("tree", F.col("parent").alias("id")).filter("id is not null")
    leaves = whole.filter(F.col("up").isNull()).join(parents, ["tree", "id"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("score") / F.col("depth")), "id")
    leaves = leaves.withColumn("branch", F.row_number().over(order))
    if branches is not None:
        leaves = leaves.filter(F.col("branch") <= branches)
    found = landed(leaves.select("tree", "branch", F.col("depth").alias("place"), "id"), "paths")
    for step in steps:
        above = found.join(step.select("tree", "id", "up", F.col("depth").alias("by")), ["tree", "id"])
        above = above.select("tree", "branch", (F.col("place") - F.col("by")).alias("place"), F.col("up").alias("id"))
        found = landed(found.unionByName(above), "paths")
    return found


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from rows (tree, branch, role, text) that come path by path, in order."""
    now, turns, done = None, [], []

    def batch():
        columns = list(zip(*done)) if done else [[]] * 5
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), spans]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["tree", "branch", "n_messages", "formatted", "loss_spans"])

    def finish():
        if now is not None:
            text, spans = format_turns(turns)
            done.append((*now, len(turns), text, [{"start": a, "end": b} for a, b in spans]))

    for rows in batches:
        for tree, branch, role, text in zip(*(rows.column(k).to_pylist() for k in range(4))):
            if (tree, branch) != now:
                finish()
                now, turns = (tree, branch), []
            turns.append((role, text))
        yield batch()
    finish()
    yield batch()


def format_trees(
    messages: DataFrame,
    tree: Column,
    id: Column,
    parent: Column,
    score: Column,
    role_col: str = "role",
    text_col: str = "text",
    branches: int | None = 1,
) -> DataFrame:
    """(tree, branch, n_messages, formatted, loss_spans) of the best ``branches`` paths of each tree.

    ``tree`` is a key as text. A message whose parent is null or absent is a root. Null roles
    and texts count as empty, a null score as 0. Of rows that repeat an id in a tree, the first by
    parent, role and text counts; rows without an id are messages that nobody answers, one for
    all that are alike. Messages in a circle have no root and are in no path. An empty table gives
    no rows. ``loss_spans`` are code points in ``formatted``.
    """
    rows = messages.select(
        F.coalesce(tree, F.lit("")).alias("tree"),
        F.coalesce(id.cast("string"), F.concat(F.lit("-"), F.sha2(F.to_json(F.struct(parent.cast("string"), role_col, text_col)), 256))).alias("id"),
        parent.cast("string").alias("parent"),
        F.coalesce(score.cast("double"), F.lit(0.0)).alias("score"),
        F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
    )
    one = F.min(F.struct("parent", "role", "text", "score")).alias("one")
    rows = landed(rows.groupBy("tree", "id").agg(one).select("tree", "id", "one.*"), "messages")
    chosen = paths(rows.select("tree", "id", "parent", "score"), branches)
    turns = chosen.join(rows.select("tree", "id", "role", "text"), ["tree", "id"])
    ordered = turns.repartition("tree", "branch").sortWithinPartitions("tree", "branch", "place")
    return ordered.select("tree", "branch", "role", "text").mapInArrow(_format, f"tree string, {_FORMATTED}")


def read_back(formatted: DataFrame) -> DataFrame:
    """(tree, branch, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from the text and its mask alone."""
    def read(batches):
        for batch in batches:
            rows = []
            for tree, branch, text, spans in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4))):
                turns, digest, learnt, chars = read_turns(text), hashlib.sha256(), hashlib.sha256(), 0
                for role, said in turns:
                    digest.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    said = unescape(text[span["start"] : span["end"]])
                    learnt.update(said.encode())
                    chars += len(said)
                rows.append((tree, branch, len(turns), digest.hexdigest(), chars, learnt.hexdigest(), len(text)))
            columns = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _BACK)

    schema = "tree string, branch int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(read, schema)


_BACK = ["tree", "branch", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def linear_trees(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Conversations as trees without forks: each turn answers the one before.

    Turns are numbered in the order of ``turn_col``, then role and text, so rows that repeat
    a turn stay turns of their own; rows without a turn come first.
    """
    order = Window.partitionBy(id_col).orderBy(turn_col, "role", "text")
    numbered = conversations.select(id_col, turn_col, "role", "text").withColumn("_at", F.row_number().over(order))
    return numbered.select(F.to_json(F.struct(id_col)).alias("tree"), "_at", "role", "text", id_col)
