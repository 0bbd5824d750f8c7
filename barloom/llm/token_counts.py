"""Token counts by a map-side look-up in two tiers; no pre-token is shuffled.

The unit looked up is a run of pre-tokens between two spaces at which the tokenizer always
cuts. The first tier is a compact hash table of frequent runs and their lengths in
tokens, broadcast to all tasks. A miss is encoded by the library, many at a time and
without the marks at its end, and kept in the worker's own table until that is full; then
the worker goes back to the first tier. The tables only save time: every text is cut
and counted in whole, whatever they hold.
"""

import heapq
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from barloom.llm.words import LONGEST, PreTokens, absent_mark, cores_and_tails, list_ends, slices, sums_between, worker_cache

#: Entries of the broadcast table and of a worker's table. Runs longer than ``LONGEST``
#: characters are in neither, so both have a fixed size.
FREQUENT_ENTRIES, WORKER_ENTRIES = 50_000, 600_000
#: Documents, more or less, from which the first tier is filled.
SAMPLE_ROWS = 2_000
#: Characters that some tokenizer may count as white space, and a space beside one of them.
_WHITE = r"\x09-\x0D\x1C-\x20\x{85}\p{Z}"
_DOUBTFUL = rf"(?s)[{_WHITE}] | [{_WHITE}]|^ | $"


def runs(texts: pa.Array) -> pa.Array:
    """Lists of the runs between safe cuts; all but the first had a space before them.

    A cut is at a space behind a character that isn't white space to anyone: a pre-token
    ends there, and what follows is cut without regard to what came before.
    """
    if not pc.any(pc.match_substring_regex(texts, _DOUBTFUL)).as_py():
        return pc.split_pattern(texts, " ")
    mark = absent_mark(texts)
    return pc.split_pattern(pc.replace_substring_regex(texts, rf"([^{_WHITE}]) ", rf"\1{mark}"), mark)


class RunLengths:
    """Lengths of runs in tokens: the broadcast tier, and above it what this worker met."""

    def __init__(self, tokenizer: Tokenizer, frequent: dict[str, int]):
        self.tokenizer, self.frequent, self.table, self.tails = tokenizer, frequent, dict(frequent), {"": 0}
        self.after_space = PreTokens(tokenizer, " ")

    def totals(self, texts: pa.Array) -> np.ndarray:
        lists = runs(texts)
        ends = list_ends(lists)
        words = lists.flatten()
        heads = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        first = self.encode(words.take(pa.array(heads)).to_pylist())
        sizes = self._look_up(words)
        sizes[heads] = first
        return sums_between(sizes, ends)

    def _look_up(self, words: pa.Array) -> np.ndarray:
        if len(self.table) > WORKER_ENTRIES:
            self.table = dict(self.frequent)
        found = words.dictionary_encode()
        distinct = found.dictionary.to_pylist()
        missing = [w for w in distinct if w not in self.table]
        if missing:
            self.table.update(zip(missing, self.lengths(missing)))
        sizes = np.fromiter(map(self.table.__getitem__, distinct), np.int64, len(distinct))
        for word in missing:
            if len(word) > LONGEST:
                del self.table[word]
        return sizes[found.indices.to_numpy()]

    def lengths(self, words: list[str]) -> list[int]:
        """Lengths of runs that have a space before them."""
        cores, tails = cores_and_tails(words)
        unknown = list(set(tails).difference(self.tails))
        if len(self.tails) + len(unknown) > WORKER_ENTRIES:
            self.tails = {"": 0}
            unknown = list(set(tails))
        self.tails.update(zip(unknown, self.encode(unknown)))
        needed = list(dict.fromkeys(cores))
        size = dict(zip(needed, map(len, self.after_space(needed))))
        return [size[core] + self.tails[tail] for core, tail in zip(cores, tails)]

    def encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def load_tokenizer(path: str) -> Tokenizer:
    """The tokenizer as the file has it, without truncation or padding."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def frequent_runs(docs: DataFrame, text_col: str, path: str, sample_rows: int, entries: int) -> dict[str, int]:
    """Lengths of the most frequent runs of about ``sample_rows`` documents.

    Counted in tasks, which read the sampled rows in whole and send their ``entries`` most
    frequent runs at most. The sample decides how often a task has to encode, never
    a result.
    """

    def count(batches):
        found = Counter()
        for batch in batches:
            for part in slices(batch.column(0)):
                for x in pc.value_counts(runs(part).flatten()).to_pylist():
                    found[x["values"]] += x["counts"]
        most = heapq.nlargest(entries, (x for x in found.items() if len(x[0]) <= LONGEST), key=lambda x: (x[1], x[0]))
        columns = [pa.array([r for r, _ in most], pa.string()), pa.array([n for _, n in most], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["run", "n"])

    share = min(1.0, sample_rows / max(1, docs.count()))
    texts = docs.select(F.col(text_col).alias("text")).sample(share, seed=1)
    counted = texts.mapInArrow(count, "run string, n long").groupBy("run").agg(F.sum("n").alias("n"))
    top = [row.run for row in counted.orderBy(F.desc("n"), "run").limit(entries).select("run").collect()]
    return dict(zip(top, RunLengths(load_tokenizer(path), {}).lengths(top))) if top else {}


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    entries: int = FREQUENT_ENTRIES,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row, as the tokenizer file gives them.

    A null text counts as empty: 0 bytes, 0 tokens. Rows that repeat come out as often
    as they come in; a null id stays null; an empty table gives no rows. A task holds
    one slice of a batch, or one text if that is longer.
    """
    spark, key = docs.sparkSession, f"{tokenizer_path} {uuid.uuid4()}"
    frequent = spark.sparkContext.broadcast(frequent_runs(docs, text_col, tokenizer_path, sample_rows, entries))

    def count(batches):
        lengths = worker_cache(f"count {key}", lambda: RunLengths(load_tokenizer(tokenizer_path), frequent.value))
        for batch in batches:
            found = [lengths.totals(part) for part in slices(batch.column(1))]
            totals = np.concatenate(found) if found else np.empty(0, np.int64)
            columns = [batch.column(0), batch.column(2), pa.array(totals, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
