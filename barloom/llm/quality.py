"""Quality rules with risk-controlled cutoffs; DataFrame functions only.

Counts of words, symbols, repeated lines and repeated words come from each whole text, inside
its row. Fixed base rules reject first. Then each rule of ``RULES`` has a ladder of
cutoffs, from mild to strict, and ``STEPS`` is one fixed sequence of steps: the rungs of the
first rule, then those of the second on top of the first one's strictest, and so on. For each
stratum (a language of the data) a step counts how many labelled documents of good quality all its
cutoffs together would reject; the exact binomial probability of seeing so few, if they
rejected a share of ``risk`` in truth, must be at most the stratum's part of ``alpha``. Steps
are taken until one fails, so a stratum needs no correction for them. ``alpha`` is
shared in equal parts by as many strata, those with the most labels, as could pass with their part
if no good document were rejected; this depends on numbers of labels alone, not on what any
rule does. So the chance that any stratum loses more than ``risk`` of its good
documents is at most ``alpha``. A stratum with too few labels gets no cutoff.
"""

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.operators.columns import compute_once
from barloom.operators.keyed import landed

#: What parts words, the symbols, and the base rules.
SPACES, SYMBOLS, WINDOW = r"[\x20\x09-\x0D]+", "#*$%&|<>", 5
LEAST_WORDS, MOST_REPEATED_PERCENT = 10, 20
RISK, ALPHA = 0.01, 0.05
#: A measure and its cutoffs from mild to strict; at or above one a document is rejected.
RULES = {
    "symbol_share": (0.3, 0.2, 0.1, 0.05, 0.02),
    "line_share": (0.9, 0.7, 0.5, 0.3),
    "repeat_share": (0.19, 0.15, 0.1),
    "word_length": (40.0, 30.0, 20.0, 15.0),
}
#: The rule and the cutoff that each step adds to the steps before it.
STEPS = [(rule, cutoff) for rule, ladder in RULES.items() for cutoff in ladder]


def measures(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", carry: bool = False
) -> DataFrame:
    """(doc_id, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of every row.

    With ``carry``, the row itself comes along as the struct ``row``.
    """
    carried = [F.struct(*docs.columns).alias("row")] if carry else []
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(stratum_col).cast("string"), F.lit("und")).alias("stratum"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *carried,
    )
    text = F.col("text")
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    rows = compute_once(
        rows,
        {
            "words": F.array_remove(F.split(text, SPACES), ""),
            "lines": F.filter(F.split(text, "\n"), has_word),
            "word_chars": F.length(F.regexp_replace(text, SPACES, "")).cast("bigint"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
        },
    )
    lines, words = F.col("lines"), F.col("words")
    rows = rows.select(
        "doc_id",
        "stratum",
        F.size(words).cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        words,
        *["row" for _ in carried],
    )
    return _repeated_words(rows)


def _repeated_words(rows: DataFrame) -> DataFrame:
    """Words in windows that the text holds twice, from 64-bit hashes of the windows.

    Most texts have no such window, which their distinct hashes show. For the others the
    hashes are sorted with their places, so that equal ones are neighbours: n log n
    steps, however often a window is repeated.
    """
    words, n = F.col("words"), F.size("words")
    window = F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda k: F.xxhash64(*[F.get(words, k + step) for step in range(WINDOW)]),
    )
    rows = compute_once(rows, {"hashes": F.when(n >= WINDOW, window)}).drop("words")
    hashes = F.col("hashes")
    twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
    placed = F.array_sort(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
    rows = compute_once(rows, {"placed": F.when(twice, placed)}).drop("hashes")
    placed = F.col("placed")

    def repeated(x, at):
        before, after = F.get(placed, at - 1), F.get(placed, at + 1)
        return F.coalesce(before["h"] == x["h"], F.lit(False)) | F.coalesce(after["h"] == x["h"], F.lit(False))

    places = F.sort_array(F.transform(F.filter(placed, repeated), lambda x: x["k"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("n"))

    def covered(done, place):
        more = F.least(F.lit(WINDOW), place - done["last"]).cast("bigint")
        return F.struct(place.alias("last"), (done["n"] + more).alias("n"))

    found = F.aggregate(places, start, covered, lambda done: done["n"])
    return rows.withColumn("n_repeat_words", F.coalesce(F.when(placed.isNotNull(), found), F.lit(0).cast("bigint"))).drop("placed")


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def shares() -> dict[str, Column]:
    """The measures that rules judge; a text without words or lines has none."""
    return {
        "symbol_share": F.try_divide(F.col("n_symbols"), F.col("word_chars")),
        "line_share": F.try_divide(F.col("n_dup_lines"), F.col("n_lines")),
        "repeat_share": F.try_divide(F.col("n_repeat_words"), F.col("n_words")),
        "word_length": F.try_divide(F.col("word_chars"), F.col("n_words")),
    }


def _rejects(rule: str, cutoff) -> Column:
    return F.coalesce(shares()[rule] >= cutoff, F.lit(False))


def binomial_tail(n: Column, k: Column, share: float) -> Column:
    """P(X <= k) for X binomial over n trials; only meant for k at most n * share."""
    first = F.struct((n * F.log(F.lit(1 - share))).alias("log"), F.exp(n * F.log(F.lit(1 - share))).alias("sum"))

    def add(done, i):
        log = done["log"] + F.log((n - i + 1) / i) + F.log(F.lit(share / (1 - share)))
        return F.struct(log.alias("log"), (done["sum"] + F.exp(log)).alias("sum"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, first, add, lambda done: done["sum"])


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, alpha: float = ALPHA) -> DataFrame:
    """(stratum, one column by rule): the cutoffs after the last step that passes; only strata that have any.

    ``labels`` has doc_id and quality; a document is good if all its labels say 1.
    """
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter(F.col("quality") == 1)
    held_out = measured.filter(~base_failed()).join(good.select("doc_id"), "doc_id", "left_semi")
    # A document is rejected from the first step on that rejects it.
    first = F.least(*[F.when(_rejects(rule, c), step) for step, (rule, c) in enumerate(STEPS)])
    counts = [F.count_if(F.col("first") <= step).alias(f"step_{step}") for step in range(len(STEPS))]
    counted = held_out.select("stratum", first.alias("first")).groupBy("stratum").agg(F.count("*").alias("n"), *counts)
    # Strata that could pass with all of ``alpha``: none of them has fewer than ln(alpha) / ln(1 - risk) labels.
    able = landed(counted.filter(F.col("n") * math.log(1 - risk) <= math.log(alpha)), "steps")
    placed = able.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "stratum")))
    fits = F.col("n") * math.log(1 - risk) <= F.lit(math.log(alpha)) - F.log("place")
    sharing = F.max(F.when(fits, F.col("place"))).over(Window.partitionBy())
    shared = placed.withColumn("sharing", sharing).filter("place <= sharing")

    def passes(rejected):
        few = rejected <= F.col("n") * F.lit(risk)
        sure = F.when(few, binomial_tail(F.col("n"), rejected, risk)) <= F.lit(alpha) / F.col("sharing")
        return F.coalesce(sure, F.lit(False))

    passed = F.array(*[passes(F.col(f"step_{step}")) for step in range(len(STEPS))], F.lit(False))
    steps = compute_once(shared, {"steps": F.array_position(passed, False) - 1}).filter("steps > 0")
    chosen = []
    for rule in RULES:
        own = [(step, cutoff) for step, (r, cutoff) in enumerate(STEPS) if r == rule]
        best = F.lit(None).cast("double")
        for step, cutoff in own:
            best = F.when(F.col("steps") > step, F.lit(cutoff)).otherwise(best)
        chosen.append(best.alias(f"{rule}_cutoff"))
    return steps.select("stratum", *chosen)


def _verdicts(measured: DataFrame, limits: DataFrame) -> DataFrame:
    rejected = reduce(or_, [_rejects(rule, F.col(f"{rule}_cutoff")) for rule in RULES])
    rows = measured.join(limits, "stratum", "left").withColumn("base_failed", base_failed())
    return rows.withColumn("kept", ~F.col("base_failed") & ~rejected)


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The measures of every row, base_failed, kept, and the cutoffs of its stratum.

    A null or blank text has no words and fails the base rules. A null stratum counts
    as ``und``. Rows that repeat are judged alike. Without labels only the base
    rules hold; an empty table gives no rows.
    """
    measured = landed(measures(docs, id_col, text_col, stratum_col), "measures")
    return _verdicts(measured, landed(cutoffs(measured, labels), "cutoffs"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Measured twice, for the cutoffs and for the verdict, so that no text is shuffled.
    """
    limits = landed(cutoffs(measures(docs, id_col, text_col, stratum_col), labels), "cutoffs")
    rows = _verdicts(measures(docs, id_col, text_col, stratum_col, carry=True), limits)
    return rows.filter("kept").select("row.*")
