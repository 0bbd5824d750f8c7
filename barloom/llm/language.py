"""Language of whole texts by a bidirectional recurrent network over bytes.

A sequence of the network is a word with a space on either side, so its state starts anew
where a word does, and a position's label depends on its word alone. Each task therefore runs the
network once for a distinct word and adds up, for a text, the evidence of all
positions of all its words; a word longer than ``SPAN`` bytes is cut into spans between its
characters, in training as well, none is left out. The pooled probability of a text is that of its mean evidence by word.
"""

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from barloom.llm.bigru import BiGru
from barloom.llm.words import SLICE_BYTES, WordCodes, list_ends, slices, space_split, worker_cache
from barloom.operators.keyed import landed

#: Bytes of a sequence without its two spaces, and the sequences that run together.
SPAN, TOGETHER = 30, 1024
#: Bounds of the training sample: documents by language (more or less) and of all languages,
#: words by document, and passes over the sample. Each language has one document at least.
TRAINING_DOCS, ALL_DOCS, TRAINING_WORDS, EPOCHS = 400, 25_600, 32, 4
UNKNOWN = "und"
_PAD = 256
_MARKED = r"(\p{L})([^\p{L}\p{M}\s])"
#: Languages up to which a task's tables, slices and sequences have their full size; beyond, they
#: shrink as the languages grow. Places of the hash that documents are sampled by.
_WORD_LIMIT, _FULL = 300_000, 64
_PLACES = 1 << 40


def _fewer(size: int, classes: int) -> int:
    return max(1, size * _FULL // max(_FULL, classes))


def pieces(data: bytes) -> list[bytes]:
    """The bytes of a word, cut between characters into runs of at most ``SPAN``."""
    cut = [0]
    while len(data) - cut[-1] > SPAN:
        end = cut[-1] + SPAN
        while data[end] & 0xC0 == 0x80:
            end -= 1
        cut.append(end)
    return [data[a:b] for a, b in zip(cut, [*cut[1:], len(data)])]


def spans_of(words: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The spans of words, each between two spaces, and the word each span is of."""
    spans, owner = [], []
    for number, word in enumerate(words):
        data = word.encode()
        if len(data) <= SPAN:
            spans.append(b" " + data + b" ")
            owner.append(number)
        else:
            cut = pieces(data)
            spans += [b" " + piece + b" " for piece in cut]
            owner += [number] * len(cut)
    return spans, np.array(owner, np.int64)


def sequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and mask of the spans of words, and the word each span is of."""
    spans, owner = spans_of(words)
    width = max(map(len, spans), default=1)
    mask = np.arange(width)[None] < np.fromiter(map(len, spans), np.int64, len(spans))[:, None]
    data = np.frombuffer(b"".join(span.ljust(width, b"\0") for span in spans), np.uint8).reshape(len(spans), width)
    return np.where(mask, data, _PAD).astype(np.int64), mask.astype(np.float32), owner


def fold(texts: pa.Array) -> pa.Array:
    """Fewer distinct words: small letters, and a space wherever letters and other marks meet."""
    return pc.replace_substring_regex(pc.ascii_lower(texts), _MARKED, r"\1 \2")


class WordEvidence:
    """Evidence for each language by distinct word."""

    def __init__(self, net: BiGru, classes: int):
        self.net, self.rows = net, np.zeros((_fewer(1 << 14, classes), classes))
        self.together = _fewer(TOGETHER, classes)
        self.codes = WordCodes(self._learn, self._keep, _fewer(_WORD_LIMIT, classes))

    def _learn(self, words, first):
        while first + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[first : first + len(words)] = 0
        spans, owner = spans_of(words)
        sizes = np.fromiter(map(len, spans), np.int64, len(spans))
        order = np.argsort(-sizes, kind="stable")
        for start in range(0, len(order), self.together):
            some = order[start : start + self.together]
            width = int(sizes[some[0]])
            data = b"".join(spans[k].ljust(width, b"\0") for k in some.tolist())
            x = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(len(some), width).T)
            np.add.at(self.rows, first + owner[some], self.net.evidence(x, sizes[some]))

    def _keep(self, codes):
        self.rows[: len(codes)] = self.rows[codes]

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """Mean evidence by word of each text; zeros for a text without words."""
        lists = space_split(fold(texts))
        words = lists.flatten()
        codes = self.codes(words)
        real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], list_ends(lists)])
        counts = np.diff(np.concatenate([[0], np.cumsum(real)])[ends])
        # Sums by text, a bounded run of words at a time.
        text_of = np.repeat(np.arange(len(texts)), np.diff(ends))
        sums = np.zeros((len(texts), self.rows.shape[1]))
        for column in range(self.rows.shape[1]):
            sums[:, column] = np.bincount(text_of, self.rows[codes, column] * real, len(texts))
        return sums / np.maximum(counts, 1)[:, None]


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, learn_from: Column) -> list[tuple[str, str]]:
    """(language, word) pairs of a bounded sample of the rows that may be learnt from.

    Every language has a document at least. Of a long word its pieces are sampled, each as a word, so
    that scripts without spaces are learnt too.
    """
    rows = docs.filter(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    key = F.xxhash64(id_col, text_col)
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), key.alias("key"))
    place = F.pmod(F.col("key"), F.lit(_PLACES))
    counts = landed(rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("least")), "languages")
    languages = counts.count()
    if not languages:
        return []
    # A share of the keys by language: as many documents of a rare one as of a common one.
    each = max(1.0, min(TRAINING_DOCS, ALL_DOCS / languages))
    upto = F.greatest(F.least(F.lit(1.0), F.lit(each) / F.col("n")) * _PLACES, F.col("least") + 1.0)
    picked = rows.join(F.broadcast(counts.select("lang", upto.alias("upto"))), "lang").filter(place < F.col("upto"))

    def read(batches):
        for batch in batches:
            langs, keys, words = [], [], []
            for lang, text, key in zip(*(column.to_pylist() for column in batch.columns)):
                words_of = fold(pa.array([text]))[0].as_py().split()
                cut = {piece.decode() for word in set(words_of) for piece in pieces(word.encode())}
                seed = key % (1 << 64)  # each document has an order of its own, so common words do not crowd out others
                found = sorted(cut, key=lambda w: (xxhash.xxh64_intdigest(w, seed), w))[:TRAINING_WORDS]
                langs += [lang] * len(found)
                keys += [key] * len(found)
                words += found
            columns = [pa.array(langs, pa.string()), pa.array(keys, pa.int64()), pa.array(words, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "doc", "word"])

    # Rows that repeat count once, so they take no other language's place.
    pairs = picked.select("lang", "text", "key").mapInArrow(read, "lang string, doc long, word string").distinct()
    pairs = pairs.select("lang", "word", F.xxhash64("lang", "word").alias("key"))
    most = int(2 * each * TRAINING_WORDS * languages)
    return [(row.lang, row.word) for row in pairs.orderBy("key", "lang", "word").limit(most).collect()]


def train(pairs: list[tuple[str, str]], seed: int = 0) -> tuple[BiGru, list[str]] | None:
    """A network and its languages from (language, word) pairs; None without pairs."""
    languages = sorted({lang for lang, _ in pairs})
    if not languages:
        return None
    x, mask, owner = sequences([word for _, word in pairs])
    place = {lang: k for k, lang in enumerate(languages)}
    y = np.array([place[lang] for lang, _ in pairs])[owner]
    net = BiGru(len(languages), seed)
    net.fit(x, mask, y, EPOCHS)
    return net, languages


def plain(model: tuple[BiGru, list[str]] | None) -> tuple[dict, list[str]] | None:
    """A model as data, to be broadcast: tasks need not have the classes of this package."""
    return model and (model[0].weights, model[1])


def predict_language(
    docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; the model learns from the rows of ``learn_from``.

    Only texts and languages of these rows are learnt from; a prediction sees the text alone.
    A null text, or one without letters, is ``und`` with score 0, as are all texts if there
    is nothing to learn from. Rows that repeat get the same answer; an empty table gives no rows.
    """
    context = docs.sparkSession.sparkContext
    model = context.broadcast(plain(train(_sample(docs, id_col, text_col, lang_col, learn_from))))
    name = f"language {uuid.uuid4()}"

    def read(batches):
        languages = model.value[1] if model.value else []
        evidence = worker_cache(name, lambda: WordEvidence(BiGru.of(model.value[0]), len(languages))) if languages else None
        for batch in batches:
            found, scores = [], []
            for texts in slices(batch.column(1), _fewer(SLICE_BYTES, len(languages))):
                letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
                if evidence is None:
                    letters[:] = False
                    pooled = np.zeros((len(texts), 1))
                else:
                    pooled = evidence(texts)
                p = np.exp(pooled - pooled.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                found += [languages[k] if good else UNKNOWN for k, good in zip(best, letters)]
                scores += np.where(letters, p.max(axis=1), 0.0).tolist()
            columns = [batch.column(0), pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(read, f"doc_id {kind}, lang_pred string, score double")
