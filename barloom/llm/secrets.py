"""Secrets in texts: fixed patterns, and a character network over every other candidate.

The patterns always hold. A candidate is any other run of 16 or more characters of a key's
alphabet with a digit in it; a network reads it with what stands around it. It is
trained on all labelled findings of the table: what the patterns found (each as it
is and with the words that gave it away blotted out, so that the value itself is learnt) against candidates
that they did not find. Findings are dealt into shares by hash; in each round every share is
fitted in a task of its own from the same weights, and the mean of the shares' weights is
where the next round starts. The logit is calibrated on findings held out of the fit, each
with its real surroundings and with blotted ones; all windows of one value are on the same
side. A candidate counts from the probability ``SURE`` on, or from a lower one if it takes
that to find ``RECALL`` of the held-out secrets in either form.
"""

import re
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from barloom.llm.charnet import WIDTH, CharNet, encode
from barloom.llm.words import slices
from barloom.operators.keyed import landed

#: Fixed patterns, kinds in their order, and the least length of what counts.
_ANY_CASE = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
_ASSIGN = re.compile(rf"""({_ANY_CASE}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS, _HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
KINDS = ("assign", "access", "hex", "network")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX, LEAST_CANDIDATE = 6, 20, 24, 16
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_CANDIDATE},}}")
_REST = re.compile(r"[A-Za-z0-9+/_=-]+")
#: What a text must hold for a pattern or a candidate to be possible; run by Arrow.
_MAY_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
_MAY_RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST_CANDIDATE}}}"
#: Findings of a share, or more if there would be more than so many shares; a quarter is held out of the fit.
SHARE_ROWS, MOST_SHARES = 4_096, 256
#: Findings of a class that it takes to learn, and rounds of the fit.
LEAST_TRAINING_ROWS, ROUNDS = 40, 8
#: Logits are counted in steps of one in so many, up to this size either way.
_LOGIT_PARTS, _LOGIT_MOST = 256, 64
RECALL, SURE = 0.98, 0.8
BEFORE, INSIDE, AFTER = 32, 48, 16
MASK = "[SECRET]"


def base_spans(text: str, assign: bool = True) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind as listed."""
    found = []
    if assign:
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    # A match is a longest run, so only runs of candidates' length can hold one long enough.
    for run in _CANDIDATE.finditer(text):
        found += [(run.start() + m.start(), run.start() + m.end(), "hex") for m in _HEX.finditer(run[0]) if m.end() - m.start() >= LEAST_HEX]
    return sorted(found, key=_order)


def _order(span):
    return span[0], KINDS.index(span[2]), span[1]


def candidates(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Runs with a digit that no span touches."""
    found, at = [], 0
    ends = sorted((start, end) for start, end, _ in spans)
    for run in _CANDIDATE.finditer(text):
        while at < len(ends) and ends[at][1] <= run.start():
            at += 1
        touched = any(start < run.end() and end > run.start() for start, end in ends[at:] if start < run.end())
        if not touched and any(c.isdigit() for c in run[0]):
            found.append(run.span())
    return found


def windows(text: str, start: int, end: int) -> list[tuple[str, str, str]]:
    """A candidate with its surroundings; a long one in several windows that cover it."""
    before, after = text[max(0, start - BEFORE) : start], text[end : end + AFTER]
    steps = range(start, end, INSIDE) if end - start > INSIDE else [start]
    return [(before, text[k : min(end, k + INSIDE)], after) for k in steps]


def _possible(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    assign = pc.match_substring_regex(texts, _MAY_ASSIGN).to_numpy(zero_copy_only=False)
    return assign, assign | pc.match_substring_regex(texts, _MAY_RUN).to_numpy(zero_copy_only=False)


def labelled(docs: DataFrame, id_col: str, text_col: str, rows: int = SHARE_ROWS) -> DataFrame:
    """(share, secret, before, inside, after) of all different findings, in shares of about ``rows``.

    The windows, at most 96 characters each, are written out, so that the texts are read once.
    """

    def read(batches):
        for batch in batches:
            found = []
            for texts in slices(batch.column(0)):
                assign, possible = _possible(texts)
                for k in np.flatnonzero(possible):
                    text = texts[int(k)].as_py()
                    spans = base_spans(text, bool(assign[k]))
                    for start, end, kind in spans:
                        if kind == "assign":
                            start = _ASSIGN.match(text, start).start(2)
                        found += [(True, *w) for w in windows(text, start, end)]
                    found += [(False, *w) for span in candidates(text, spans) for w in windows(text, *span)]
            columns = list(zip(*found)) if found else [[]] * 4
            kinds = [pa.bool_(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["secret", "before", "inside", "after"])

    schema = "secret boolean, before string, inside string, after string"
    found = docs.select(F.col(text_col).alias("text")).mapInArrow(read, schema)
    found = landed(found.distinct(), "findings")
    shares = min(max(1, found.count() // rows), MOST_SHARES)
    share = F.pmod(F.xxhash64("before", "inside", "after"), F.lit(shares)).cast("int")
    # With a number of partitions, so that adaptive execution does not join shares into one task.
    return found.select(share.alias("share"), *found.columns).repartition(shares, "share")


def _each(found: DataFrame | list, work, columns: str):
    """What ``work(share, rows)`` makes of every share: a frame, or a table for a list, which is one share."""

    kinds = {"long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, columns.split(", "))])

    def made(share, rows):
        return pa.table(list(work(share, sorted(rows))), schema=schema)

    if isinstance(found, list):
        return made(0, found)
    return found.groupBy("share").applyInArrow(
        lambda key, table: made(key[0].as_py(), zip(*(c.to_pylist() for c in table.columns[1:]))), columns
    )


def _forms(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of findings: the class, what is held out, and the codes with real and with blotted surroundings.

    A row held out has a part of its value's hash, so all rows of one value are on one side.
    """
    deal = np.array([zlib.crc32(inside.encode()) for _, _, inside, _ in rows])
    real, blank = encode([row[1:] for row in rows]), encode([_blotted(*row[1:]) for row in rows])
    return np.array([float(row[0]) for row in rows]), deal % 4 == 3, np.stack([real, blank])


def _summed(counts) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their counts, added up over all shares."""
    if isinstance(counts, DataFrame):
        counts = counts.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    keys, at = np.unique(counts.column("key").to_numpy(), return_inverse=True)
    return keys, np.bincount(at, counts.column("n").to_numpy(), len(keys))


def train(found: DataFrame | list[tuple[bool, str, str, str]]) -> tuple[CharNet, float] | None:
    """The network and its threshold; None if a class has too few rows to learn from.

    ``found`` is what ``labelled`` gives, or a list of such findings, which are one share. Only weights and
    counts by logit come to the driver: a row of weights per share, and as many counts as there are steps of a logit.
    """
    counted, weights = "key long, n long", "share long, n long, step long, state binary"

    def sizes(share, rows):
        held = [zlib.crc32(inside.encode()) % 4 == 3 for _, _, inside, _ in rows]
        return np.unique([2 * h + row[0] for h, row in zip(held, rows)], return_counts=True) if rows else ([], [])

    def fit(share, rows):
        y, held, forms = _forms(rows)
        own = CharNet().resume(state, step)
        own.fit(np.concatenate(forms[:, ~held]), np.tile(y[~held], 2), 1, np.random.default_rng([turn, share]))
        return [[share], [int((~held).sum())], [own.step], [own.state().tobytes()]]

    def logits(share, rows):
        y, held, forms = _forms(rows)
        net = CharNet().resume(state, step)
        keys = []
        for form, x in enumerate(forms):
            some = np.clip(net.logits(x[held]), -_LOGIT_MOST, _LOGIT_MOST)
            part = np.floor(some * _LOGIT_PARTS).astype(np.int64) + _LOGIT_MOST * _LOGIT_PARTS
            keys.append(4 * part + 2 * form + y[held].astype(np.int64))
        return np.unique(np.concatenate(keys), return_counts=True)

    keys, n = _summed(_each(found, sizes, counted))
    n_fit_no, n_fit_yes, n_held_no, n_held_yes = (int(n[keys == k].sum()) for k in range(4))
    if min(n_fit_no + n_held_no, n_fit_yes + n_held_yes) < LEAST_TRAINING_ROWS or len(keys) < 4:
        return None
    net = CharNet()
    state, step = net.state(), 0
    for turn in range(ROUNDS):
        learnt = _each(found, fit, weights)
        learnt = learnt if isinstance(found, list) else learnt.toArrow()  # a row per share
        learnt = learnt.filter(pc.greater(learnt.column("n"), 0)).sort_by("share")
        states = np.stack([np.frombuffer(s) for s in learnt.column("state").to_pylist()])
        state = np.average(states, axis=0, weights=learnt.column("n").to_numpy())
        step = pc.max(learnt.column("step")).as_py()
    net.resume(state, step)
    keys, n = _summed(_each(found, logits, counted))
    logit, form, y = keys // 4 / _LOGIT_PARTS - _LOGIT_MOST, keys // 2 % 2, keys % 2
    net.calibrate(logit, y.astype(float), n)
    of = [(y == 1) & (form == k) for k in range(2)]
    return net, min(SURE, *(_found_from(net.calibrated(logit[some]), n[some]) for some in of))


def _blotted(before: str, inside: str, after: str) -> tuple[str, str, str]:
    return re.sub("[A-Za-z]", "x", before), inside, after


def _found_from(probabilities: np.ndarray, counts: np.ndarray) -> float:
    """The greatest threshold at which ``RECALL`` of these are found."""
    order = np.argsort(probabilities)
    missed = np.cumsum(counts[order])
    return float(probabilities[order][np.searchsorted(missed, int((1 - RECALL) * missed[-1]), side="right")])


def plain(model: tuple[CharNet, float] | None) -> tuple[dict, float] | None:
    """A model as data, to be broadcast: tasks need not have the classes of this package."""
    return model and (model[0].plain(), model[1])


def loaded(data: tuple[dict, float] | None) -> tuple[CharNet, float] | None:
    return data and (CharNet.of(data[0]), data[1])


def all_spans(texts: pa.Array, model: tuple[CharNet, float] | None) -> list[list[tuple[int, int, str]]]:
    """Spans of each text: the patterns', and the candidates that the network takes for secrets."""
    assign, possible = _possible(texts)
    spans, asked = [[] for _ in range(len(texts))], []
    for k in np.flatnonzero(possible).tolist():
        text = texts[k].as_py()
        spans[k] = base_spans(text, bool(assign[k]))
        if model:
            asked += [(k, *span, w) for span in candidates(text, spans[k]) for w in windows(text, *span)]
    if asked:
        net, threshold = model
        for at in range(0, len(asked), 4096):
            some = asked[at : at + 4096]
            sure = net.probabilities(encode([w for *_, w in some])) >= threshold
            for (k, start, end, _), good in zip(some, sure):
                if good and (start, end, "network") not in spans[k][-1:]:
                    spans[k].append((start, end, "network"))
    return [sorted(set(found), key=_order) for found in spans]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SHARE_ROWS) -> DataFrame:
    """(doc_id, spans) of every row: an array of (start, end, kind) in code points, by start and kind.

    A null text counts as empty and has no spans. Rows that repeat have the same spans. A
    candidate of any length is read in whole. Where the table holds too few findings to
    learn from, as an empty one does, only the patterns hold.
    """
    model = docs.sparkSession.sparkContext.broadcast(plain(train(labelled(docs, id_col, text_col, rows))))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def scan(batches):
        net = loaded(model.value)
        for batch in batches:
            found = [spans for texts in slices(batch.column(1)) for spans in all_spans(texts, net)]
            rows = [[{"start": s, "end": e, "kind": k} for s, e, k in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    rows_in = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_kind = rows_in.schema["doc_id"].dataType.simpleString()
    return rows_in.mapInArrow(scan, f"doc_id {id_kind}, spans array<struct<start:long,end:long,kind:string>>")


def whole_runs(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The spans, grown over the rest of a run of key characters of which they are a part.

    A key of which a pattern fits only a piece would else stay readable beside it. An assignment
    starts with its own key word, so it grows at its end alone.
    """
    runs = [run.span() for run in _REST.finditer(text)]
    starts, grown = [start for start, _ in runs], []
    for start, end, kind in spans:
        first, last = bisect_right(starts, start) - 1, bisect_right(starts, end - 1) - 1
        if kind != "assign" and first >= 0 and runs[first][1] > start:
            start = runs[first][0]
        grown.append((start, max(end, runs[last][1]) if last >= 0 else end, kind))
    return sorted(grown, key=_order)


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by ``MASK``."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, text_col: str = "text", rows: int = SHARE_ROWS) -> DataFrame:
    """``docs`` with the secrets in its texts replaced, each with the whole run it is a part of; all other columns and texts stay as they are."""
    model = docs.sparkSession.sparkContext.broadcast(plain(train(labelled(docs, "", text_col, rows))))
    place = docs.columns.index(text_col)

    def clean(batches):
        net = loaded(model.value)
        for batch in batches:
            texts, changed = batch.column(place), []
            for part in slices(texts):
                found = all_spans(part, net)
                for k, spans in enumerate(found):
                    text = part[k].as_py()
                    changed.append(mask(text, whole_runs(text, spans)) if spans else None)
            yield batch.set_column(place, batch.schema.field(place), pc.coalesce(pa.array(changed, texts.type), texts))

    return docs.mapInArrow(clean, docs.schema)
