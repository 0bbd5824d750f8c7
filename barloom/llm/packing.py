"""Best-fit packing of token pieces into sequences of a fixed length.

The plan is made from the histogram of piece lengths alone, which has as many entries as
a sequence has tokens, however many pieces there are:

1. patterns of up to four length classes that fill a sequence are enumerated;
2. non-negative least squares fits how often each is repeated to the histogram;
3. the counts are rounded down to what the histogram holds, and classes are
   replaced by the exact lengths of their pieces;
4. what is left over is packed by best fit, longest first, into the open sequences;
5. where that takes more sequences than the tokens need, sequences with much room are opened again
   and their pieces packed by best fit, while that saves sequences.

All steps handle runs of equal sequences, not single pieces. Tasks then look up the
place of a piece by its length and its number among the pieces of that length; these
numbers come from counts per input partition, so no length, however frequent, is ever
sorted or gathered in one task.
"""

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from barloom.llm.token_counts import load_tokenizer
from barloom.llm.words import Lists, PreTokens, WordCodes, list_ends, slices, space_split, sums_between, worker_cache
from barloom.operators.keyed import landed

#: Length classes of the patterns, and the most classes in a pattern.
CLASSES, PATTERN_SIZE = 128, 4
#: Tokens of room from which on sequences are opened again, tried in this order.
ROOMS = (64, 32, 16, 8, 4, 2, 1)
_LEAST_GAIN = 1e-9
_MARKED = "([A-Za-z0-9À-ÖØ-öø-ÿ])([.,;:!?])"
#: What may be part of a special token, or a capital that a combining mark may follow.
_AS_IT_IS = r"\|>|[A-Z][^\x00-\x{2FF}]"


# Plan, on the driver: arrays as long as a sequence


def fill_patterns(classes: int, size: int) -> np.ndarray:
    """Counts of each class (row: class from 1) in each pattern whose classes sum to ``classes``."""
    found = []

    def extend(pattern, least, room):
        if room == 0:
            found.append(pattern)
        elif len(pattern) < size:
            for part in range(least, room + 1):
                if part == room or (2 * part <= room and len(pattern) + 1 < size):
                    extend([*pattern, part], part, room - part)

    extend([], 1, classes)
    matrix = np.zeros((classes, len(found)))
    for column, pattern in enumerate(found):
        for part in pattern:
            matrix[part - 1, column] += 1
    return matrix


def nonnegative_least_squares(matrix: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |matrix @ x - wanted|, by active sets."""
    x, active = np.zeros(matrix.shape[1]), []
    for _ in range(4 * matrix.shape[0]):
        gain = matrix.T @ (wanted - matrix @ x)
        gain[active] = -np.inf
        entering = int(np.argmax(gain))
        if gain[entering] <= _LEAST_GAIN * max(1.0, float(wanted.max(initial=0))):
            break
        active.append(entering)
        while active:
            fit = np.linalg.lstsq(matrix[:, active], wanted, rcond=None)[0]
            if fit.min() > 0:
                x[:] = 0
                x[active] = fit
                break
            now = x[active]
            falling = fit <= 0
            step = np.min(now[falling] / np.maximum(now[falling] - fit[falling], 1e-30))
            x[active] = now + step * (fit - now)
            active = [k for k in active if x[k] > 1e-9]
            x[[k for k in range(len(x)) if k not in set(active)]] = 0
    return x


def _take(pool: list[list[int]], wanted: int) -> list[tuple[int, int]]:
    """Up to ``wanted`` pieces of a class as (length, count), longest first."""
    taken = []
    while wanted and pool:
        length, count = pool[-1]
        used = min(wanted, count)
        taken.append((length, used))
        wanted -= used
        if used == count:
            pool.pop()
        else:
            pool[-1][1] -= used
    return taken


def _zip_runs(columns: list[list[tuple[int, int]]]) -> list[tuple[tuple[int, ...], int]]:
    """Runs of equal tuples from columns that are runs of lengths, all as long."""
    columns, runs = [[list(run) for run in reversed(c)] for c in columns], []
    while columns[0]:
        count = min(c[-1][1] for c in columns)
        runs.append((tuple(c[-1][0] for c in columns), count))
        for c in columns:
            c[-1][1] -= count
            if not c[-1][1]:
                c.pop()
    return runs


def plan_sequences(histogram: np.ndarray, limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as runs (lengths in order, count) for ``histogram[length]`` pieces."""
    width = -(-limit // CLASSES)
    classes = limit // width
    kind = -(-np.arange(limit + 1) // width)  # pieces of class k have at most k * width tokens
    pools = defaultdict(list)
    for length in np.flatnonzero(histogram):
        pools[min(int(kind[length]), classes + 1)].append([int(length), int(histogram[length])])
    wanted = np.array([sum(n for _, n in pools[k]) for k in range(1, classes + 1)], float)
    matrix = fill_patterns(classes, PATTERN_SIZE)
    repeats = np.floor(nonnegative_least_squares(matrix, wanted) + 1e-6).astype(int)
    runs = []
    for column in np.argsort(-repeats, kind="stable"):
        members = np.flatnonzero(matrix[:, column]) + 1
        each = {int(k): int(matrix[k - 1, column]) for k in members}
        times = min([int(repeats[column]), *(sum(n for _, n in pools[k]) // m for k, m in each.items())])
        if times > 0:
            runs += _zip_runs([_take(pools[k], times) for k in sorted(each, reverse=True) for _ in range(each[k])])
    rest = sorted((run for pool in pools.values() for run in pool), reverse=True)
    return _reopened(_best_fit(runs, [tuple(run) for run in rest], limit), limit)


def _reopened(plan, limit):
    """The plan, or one of fewer sequences that keeps only those of it with less room than one of ``ROOMS``."""
    needed = -(-sum(sum(lengths) * count for lengths, count in plan) // limit)
    size = lambda runs: sum(count for _, count in runs)
    best = plan
    for room in ROOMS:
        if size(best) <= needed:
            break
        kept, pieces = [], defaultdict(int)
        for lengths, count in plan:
            if limit - sum(lengths) < room:
                kept.append((lengths, count))
            else:
                for length in lengths:
                    pieces[length] += count
        again = _best_fit(kept, sorted(pieces.items(), reverse=True), limit)
        if size(again) < size(best):
            best = again
    return best


def _best_fit(runs, rest, limit):
    """Add the pieces left over, longest first, where they leave the least room."""
    open_runs, rooms = defaultdict(list), []

    def put(lengths, count):
        room = limit - sum(lengths)
        if not open_runs[room]:
            insort(rooms, room)
        open_runs[room].append((lengths, count))

    for lengths, count in runs:
        put(lengths, count)
    for length, count in rest:
        while count:
            at = bisect_left(rooms, length)
            if at == len(rooms):  # as many as fit in each new sequence
                each = min(limit // length, count)
                put((length,) * each, count // each)
                count -= count // each * each
                continue
            room = rooms[at]
            lengths, there = open_runs[room].pop()
            if not open_runs[room]:
                rooms.pop(at)
            used = min(count, there)
            put((*lengths, length), used)
            if there > used:
                put(lengths, there - used)
            count -= used
    return [run for room in sorted(open_runs) for run in open_runs[room]]


def place_table(plan: list[tuple[tuple[int, ...], int]], limit: int) -> tuple[np.ndarray, ...]:
    """For look-ups: first number of a run of places, by length; its first sequence and its offset.

    Keys are ``length << 40 | number``, sorted; a run of places of one length holds
    pieces with consecutive numbers in consecutive sequences.
    """
    used, rows, sequence = defaultdict(int), [], 0
    for lengths, count in plan:
        offset = 0
        for length in lengths:
            rows.append((length << 40 | used[length], sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    rows.sort()
    return tuple(np.array([row[k] for row in rows], np.int64) for k in range(3))


# Tokens, in tasks


class WordIds:
    """Ids of texts by a tokenizer that drops white space and capitals, each word encoded once."""

    def __init__(self, tokenizer: Tokenizer):
        self.encode, self.ids = PreTokens(tokenizer, lower=True), Lists(np.uint32)
        self.codes = WordCodes(self._learn, self.ids.keep)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other, and where each text's ids end."""
        words = space_split(self._fold(texts))
        codes = self.codes(words.flatten())
        return self.ids.take(codes), sums_between(self.ids.size[codes], list_ends(words)).cumsum()

    def _fold(self, texts: pa.Array) -> pa.Array:
        """Fewer distinct words with the same ids: small letters, and a space before marks.

        The tokenizer lower-cases, drops spaces, and starts a pre-token at such a mark.
        Texts that may hold a special token are left alone, as its letters count. So are those
        with a mark behind a capital: NFC comes first, and joins some marks to a small letter only.
        """
        folded = pc.replace_substring_regex(pc.ascii_lower(texts), _MARKED, r"\1 \2")
        return pc.if_else(pc.match_substring_regex(texts, _AS_IT_IS), texts, folded)

    def _learn(self, words: list[str], first: int) -> None:
        self.ids.add(self.encode(words), first)


def pieces(docs: DataFrame, tokenizer_path: str, limit: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """A row per piece; ``part`` and ``rank`` number the pieces of a length within a task."""

    def cut(batches):
        words = worker_cache(f"pack {tokenizer_path}", lambda: WordIds(load_tokenizer(tokenizer_path)))
        part = TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        for batch in batches:
            docs, rows = iter(batch.column(0).to_pylist()), []
            for texts in slices(batch.column(1)):
                all_ids, ends = words(texts)
                # The ids come last: a zip that ends on another list has taken none too many.
                for first, last, doc in zip([0, *ends[:-1]], ends, docs):
                    ids = np.append(all_ids[first:last], np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), limit)):
                        some = ids[start : start + limit]
                        rows.append((doc, piece, start, len(some), zlib.crc32(some.tobytes()), part, seen[len(some)]))
                        seen[len(some)] += 1
            own, *columns = list(zip(*rows)) if rows else [[]] * (1 + len(schema))
            arrays = [pa.array(own, batch.schema.field(0).type), *(pa.array(c, t) for c, (_, t) in zip(columns, schema))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *(n for n, _ in schema)])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = [("piece", pa.int32())] + [(n, pa.int64()) for n in ("start", "length", "ids_crc32", "part", "rank")]
    return rows.mapInArrow(
        cut,
        f"doc_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long, part long, rank long",
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    A document is its ids and ``end_id``; longer ones are cut into pieces of ``limit``
    ids. A null or empty text is the one id ``end_id``. Rows that repeat are packed as
    often as they come; a null id stays null; an empty table gives no rows. Sequences
    are numbered from 0 without gaps.
    """
    cut = landed(pieces(docs, tokenizer_path, limit, end_id, id_col, text_col), "pieces")
    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = landed(counts, "piece-counts")
    histogram = np.zeros(limit + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``limit`` rows
        histogram[row.length] = row.n
    table = docs.sparkSession.sparkContext.broadcast(place_table(plan_sequences(histogram, limit), limit))

    def place(batches):
        keys, sequences, offsets = table.value
        for batch in batches:
            number = batch.column("number").to_numpy()
            key = batch.column("length").to_numpy() << 40 | number
            at = np.searchsorted(keys, key, side="right") - 1
            found = batch.select(range(5)).columns
            found += [pa.array(sequences[at] + key - keys[at]), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays(found, names)

    # Pieces of a length in earlier partitions: a window has a row per input partition.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = cut.join(landed(firsts, "piece-firsts"), ["part", "length"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    names = [*columns, "sequence_id", "offset"]
    kind = cut.schema["doc_id"].dataType.simpleString()
    return numbered.select(*columns, (F.col("first") + F.col("rank")).alias("number")).mapInArrow(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
