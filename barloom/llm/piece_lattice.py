"""N-best segmentation into the pieces of a SentencePiece model, and back.

The pieces that match a text form a lattice; a path's score is the sum of its pieces'
scores in the model. Pieces with a space hold it in front only, so the lattice falls apart
into units: a run of spaces and the word behind it, or marks and line ends. Within a unit a forward
pass of Viterbi gives the best score to every position, and an A* search runs backward from the end
with these scores as its heuristic. As they are exact, paths come out best first, and no
state is opened that no best path needs. The best paths of a text then follow from
those of its units: only the units with the smallest loss for their second path can
differ from the best.

Characters without a piece become the pieces of their bytes, so decoding gives back
every text. Each task works on a distinct unit once.
"""

import heapq
import re
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from barloom.llm.words import ENDS, Lists, Values, WordCodes, absent_mark, list_ends, slices, worker_cache

#: Paths of a text that are found; how much worse than the worst piece a character without a
#: piece is; and scores that models give to pieces no path should take if it can.
N_BEST, UNKNOWN_PENALTY, NEVER = 3, 10.0, -1e8
#: Distinct units a worker keeps, and bytes of text it segments at a time.
_UNIT_LIMIT, _TOGETHER = 150_000, 1 << 20
_BYTE = re.compile("<0x([0-9A-F]{2})>")


def piece_bytes(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """What each piece stands for in a text; nothing for control pieces."""
    found = []
    for number in range(model.vocab_size()):
        piece = model.id_to_piece(number)
        if model.is_byte(number):
            found.append(bytes([int(_BYTE.fullmatch(piece)[1], 16)]))
        elif model.is_control(number) or model.is_unknown(number) or model.is_unused(number):
            found.append(b"")
        else:
            found.append(piece.replace("▁", " ").encode())
    return found


class Pieces:
    """The pieces of a model file, with a space where the file has its mark for one."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found, self.bytes, self.raw = {}, {}, piece_bytes(model)
        for number, data in enumerate(self.raw):
            if model.is_byte(number):
                self.bytes[data[0]] = number
            elif data:
                text = data.decode()
                found[text] = (len(text), model.get_score(number), (number,))
        whole = list(found)
        self.automaton = ahocorasick.Automaton()
        for text, edge in found.items():
            self.automaton.add_word(text, edge)
        self.automaton.make_automaton()
        self.singles = frozenset(text for text in whole if len(text) == 1)
        self.unknown = min(score for _, score, _ in found.values() if score > NEVER) - UNKNOWN_PENALTY
        pairs = {pair for text in whole for pair in zip(text, text[1:])}
        #: Marks that no piece holds behind a letter or digit, so that the lattice falls apart there.
        self.marks = "".join(m for m in ".,;:!?" if not any(b == m and a in ENDS for a, b in pairs))
        self.lines = not any("\n" in text for text in whole)

    def edges(self, unit: str):
        """(last position, (characters, score, ids)) of all matches, by last position."""
        if self.singles.issuperset(unit):
            return self.automaton.iter(unit)
        others = [
            (at, (1, self.unknown, tuple(self.bytes[b] for b in character.encode())))
            for at, character in enumerate(unit)
            if character not in self.singles
        ]
        return heapq.merge(self.automaton.iter(unit), others, key=_total)


_total = itemgetter(0)


def lattice(unit: str, pieces: Pieces) -> tuple[list[list[tuple]], list[float]]:
    """By end position: the pieces that end there as (best score with it, start, score, ids); and best scores."""
    best, ending = [-np.inf] * (len(unit) + 1), [[] for _ in range(len(unit) + 1)]
    best[0] = 0.0
    for last, (size, score, ids) in pieces.edges(unit):
        end = last + 1
        start = end - size
        total = best[start] + score
        ending[end].append((total, start, score, ids))
        if total > best[end]:
            best[end] = total
    return ending, best


def n_best(unit: str, pieces: Pieces, n: int = N_BEST) -> list[tuple[float, list[int]]]:
    """The ``n`` best paths as (score, ids), best first; those as good in a fixed order.

    A state taken from the queue goes straight on along its best pieces, whose estimate is the
    state's own; only the other pieces on the way go into the queue.
    """
    ending, best = lattice(unit, pieces)
    found, opened = [], 0
    states = [(-best[-1], 0, len(unit), 0.0, None)]  # -(behind + best before), order, position, behind, path
    while states and len(found) < n:
        _, _, at, behind, path = heapq.heappop(states)
        while at:
            pieces_here = ending[at]
            chosen = max(pieces_here, key=_total) if len(pieces_here) > 1 else pieces_here[0]
            for other in pieces_here:
                if other is not chosen:
                    opened += 1
                    total, start, score, ids = other
                    heapq.heappush(states, (-(behind + total), opened, start, behind + score, (ids, path)))
            _, at, score, ids = chosen
            behind, path = behind + score, (ids, path)
        ids = []
        while path is not None:
            ids += path[0]
            path = path[1]
        found.append((behind, ids))
    return found


def best_path(unit: str, pieces: Pieces) -> tuple[list[int], float, float]:
    """Ids and score of the best path by Viterbi, and how much the second best loses.

    At every position of the best path, the best piece that ends there but isn't on the path
    starts another one; as the scores up to it are exact, the least loss among these
    is that of the second path.
    """
    size = len(unit)
    best, second, back = [-np.inf] * (size + 1), [-np.inf] * (size + 1), [None] * (size + 1)
    best[0] = 0.0
    for last, (length, score, ids) in pieces.edges(unit):
        end = last + 1
        total = best[end - length] + score
        if total > best[end]:
            second[end], best[end], back[end] = best[end], total, (end - length, ids)
        elif total > second[end]:
            second[end] = total
    path, loss, at = [], np.inf, size
    while at:
        loss = min(loss, best[at] - second[at])
        at, ids = back[at]
        path.append(ids)
    return [i for ids in reversed(path) for i in ids], best[size], loss


class UnitPaths:
    """Best path by code of a unit, and the loss of its second path.

    The other paths of a unit are only searched for where a text needs them.
    """

    def __init__(self, pieces: Pieces, n: int):
        self.pieces, self.n = pieces, n
        self.ids, self.score, self.loss = Lists(np.int32), Values(np.float64), Values(np.float64)
        self.codes = WordCodes(self._learn, self._keep, _UNIT_LIMIT)

    def _learn(self, units, first):
        paths = [best_path(unit, self.pieces) for unit in units]
        self.ids.add([ids for ids, _, _ in paths], first)
        self.score.add([score for _, score, _ in paths], first)
        self.loss.add([loss for _, _, loss in paths], first)

    def _keep(self, codes):
        for table in (self.ids, self.score, self.loss):
            table.keep(codes)

    def __call__(self, texts: pa.Array):
        """For each text: ids and score of its best path, and the edits and losses of the next ones."""
        lists = units_of(texts, self.pieces)
        units = lists.flatten()
        codes = self.codes(units)
        sizes = self.ids.size[codes]
        ids, ends, loss = self.ids.take(codes), np.cumsum(sizes), self.loss.take(codes)
        score = self.score.take(codes)
        last = 0
        for end in list_ends(lists).tolist():
            some = slice(last, end)
            first = int(ends[last] - sizes[last])
            paths = [(0.0, [])]
            # Only the units that lose least can differ from their best path.
            for place in _least(loss[some], self.n - 1):
                at = last + int(place)
                (top, _), *others = n_best(units[at].as_py(), self.pieces, self.n)
                where = int(ends[at] - sizes[at]) - first, int(ends[at]) - first
                more = [(top - found, (*where, other)) for found, other in others]
                paths = sorted(paths + [(a + lost, [*edits, edit]) for a, edits in paths for lost, edit in more], key=_total)
                paths = paths[: self.n]
            yield ids[first : int(ends[end - 1])], float(score[some].sum()), paths[1:]
            last = end


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` least finite values, by value and place."""
    n = min(n, len(values))
    bound = np.partition(values, n - 1)[n - 1] if n else -np.inf
    places = np.flatnonzero((values <= bound) & (values < np.inf))
    return places[np.argsort(values[places], kind="stable")][:n]


def units_of(texts: pa.Array, pieces: Pieces) -> pa.Array:
    """Lists of units: spaces and the word behind them, a space being put before each text.

    Marks and line ends that no piece ties to a letter are units of their own.
    """
    texts = pc.binary_join_element_wise(" ", texts, "")
    mark = absent_mark(texts)
    cut = pc.replace_substring_regex(texts, "([^ ]) ", rf"\1{mark} ")
    if pieces.marks:
        cut = pc.replace_substring_regex(cut, f"([A-Za-z0-9À-ÖØ-öø-ÿ])([{pieces.marks}])", rf"\1{mark}\2")
    if pieces.lines:
        cut = pc.replace_substring(cut, "\n", f"{mark}\n{mark}")
    return pc.split_pattern(cut, mark)


_EDITS = pa.list_(
    pa.struct(
        [
            ("score", pa.float64()),
            ("edits", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("ids", pa.list_(pa.int32()))]))),
        ]
    )
)
_ENCODED = "ids array<int>, score double, others array<struct<score:double,edits:array<struct<start:int,stop:int,ids:array<int>>>>>"


def encode(docs: DataFrame, model_path: str, n: int = N_BEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, score, others) of every row: the best path, and the next ``n - 1``.

    An entry of ``others`` has a score and edits: ids that stand in for ``ids[start:stop]``, from
    left to right. A null text counts as empty; as each text gets a space in front, as the
    model wants it, an empty one is that space. Rows that repeat get the same paths; an
    empty table gives no rows. A unit of any length is segmented in whole.
    """

    def read(batches):
        paths = worker_cache(f"pieces {n} {model_path}", lambda: UnitPaths(Pieces(model_path), n))
        for batch in batches:
            start = 0
            for texts in slices(batch.column(1), _TOGETHER):
                found = list(paths(texts))
                offsets = np.concatenate([[0], np.cumsum([len(ids) for ids, _, _ in found])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([ids for ids, _, _ in found]), pa.int32()))
                scores = pa.array([score for _, score, _ in found], pa.float64())
                others = [[{"score": score - lost, "edits": _sorted(edits)} for lost, edits in more] for _, score, more in found]
                own = batch.column(0).slice(start, len(found))
                start += len(found)
                yield pa.RecordBatch.from_arrays([own, ids, scores, pa.array(others, _EDITS)], ["doc_id", "ids", "score", "others"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(read, f"doc_id {kind}, {_ENCODED}")


def _sorted(edits):
    return [{"start": start, "stop": stop, "ids": ids} for start, stop, ids in sorted(edits)]


def apply_edits(ids: list[int], edits: list[dict]) -> list[int]:
    """The ids of another path."""
    out, at = [], 0
    for edit in edits:
        out += [*ids[at : edit["start"]], *edit["ids"]]
        at = edit["stop"]
    return out + list(ids[at:])


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of ``ids``; null ids give a null text."""
    place = encoded.columns.index("ids")
    columns = [c for c in encoded.columns if c != "decoded"]

    def read(batches):
        raw = Lists(np.uint8)
        raw.add([list(data) for data in piece_bytes(sentencepiece.SentencePieceProcessor(model_file=model_path))], 0)
        for batch in batches:
            texts, lists = [], batch.column(place)
            for start in range(0, len(lists), 256):
                part = lists.slice(start, 256)
                values = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                data, ends = raw.take(values), np.concatenate([[0], np.cumsum(raw.size[values])])
                cuts = ends[np.concatenate([[0], list_ends(part.fill_null([]))])]
                found = [data[a:b].tobytes().decode("utf-8", "replace")[1:] for a, b in zip(cuts, cuts[1:])]
                texts += [text if known else None for text, known in zip(found, part.is_valid().to_pylist())]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())], [*columns, "decoded"])

    kinds = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in columns)
    return encoded.select(*columns).mapInArrow(read, f"{kinds}, decoded string")
