"""Product codes of vectors, with codebooks in whole numbers and an equal-average search.

Vectors become whole numbers and are cut into equal parts; each part is replaced by the
number of its nearest entry in the codebook of its position. Two vectors whose components
sum to s and t are at least (s - t)² / d apart (d components, squared Euclidean distance).
So a codebook is sorted by component sum, and a search goes outward from the part's own
sum, to whichever side is nearer, until the squared gap over d strictly exceeds the best
distance so far; ties are never cut off. All parts of a batch advance together.

Every round reads all vectors; a task sends one sum and count per entry, which Spark adds
up. The driver holds the codebooks alone, whose size the parameters fix.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barloom.operators.keyed import landed

_ROWS = 4096


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of the nearest entry of each part; ties go to the lower entry."""
    rows, width = parts.shape
    order = np.argsort(book.sum(axis=1), kind="stable")
    sums, own = book.sum(axis=1)[order], parts.sum(axis=1)
    none = np.iinfo(np.int64).max
    right = np.searchsorted(sums, own)
    left = right - 1
    entry, best = np.full(rows, len(book)), np.full(rows, none)
    active = np.arange(rows)
    while len(active):
        below, above = left[active], right[active]
        gap_below = np.where(below >= 0, own[active] - sums[np.maximum(below, 0)], none)
        gap_above = np.where(above < len(book), sums[np.minimum(above, len(book) - 1)] - own[active], none)
        go_left = gap_below <= gap_above
        gap = np.where(go_left, gap_below, gap_above)
        more = gap < none
        first = best[active] == none
        more[more & ~first] = gap[more & ~first] ** 2 <= width * best[active][more & ~first]
        active, go_left = active[more], go_left[more]
        found = order[np.where(go_left, left[active], right[active])]
        distance = ((parts[active] - book[found]) ** 2).sum(axis=1)
        better = (distance < best[active]) | ((distance == best[active]) & (found < entry[active]))
        best[active[better]], entry[active[better]] = distance[better], found[better]
        left[active[go_left]] -= 1
        right[active[~go_left]] += 1
    return entry, best


def whole_numbers(vectors: np.ndarray, scale: float, width: int) -> np.ndarray:
    """floor(scale * x). Beyond 2**28 / width, distances could pass 64 bits: that is an error."""
    found = np.floor(vectors * scale)
    if np.abs(found).max(initial=0) > 2**28 // width:
        raise ValueError(f"a component exceeds {2**28 // width / scale:g}, so distances would not be exact")
    return found.astype(np.int64)


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vector as doubles) of the rows whose vector has only finite components."""
    vector = F.col(vector_col).cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector"))
    return rows.filter(F.coalesce(sound, F.lit(False)) & (F.size("vector") > 0))


def _batches(batches, column, scale, width):
    """Slices of a batch with their vectors as whole numbers."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            some = batch.slice(start, _ROWS)
            flat = some.column(column).flatten().to_numpy(zero_copy_only=False)
            yield some, whole_numbers(flat.reshape(some.num_rows, -1), scale, width)


def _refined(rows: DataFrame, books: np.ndarray, scale: float) -> np.ndarray:
    """Codebooks after one round: entries become the floored means of their parts, unused ones stay."""
    parts, entries, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def add_up(batches):
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for _, numbers in _batches(batches, 0, scale, width):
            for part in range(parts):
                own = numbers[:, part * width : (part + 1) * width]
                entry, _ = nearest(own, shared.value[part])
                np.add.at(sums[part], entry, own)
                counts[part] += np.bincount(entry, minlength=entries)
        part, entry = np.nonzero(counts)
        columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry])]
        columns.append(pa.array(list(sums[part, entry]), pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "sums"])

    found = rows.select("vector").mapInArrow(add_up, "part int, entry int, n long, sums array<long>")
    placed = found.select("part", "entry", "n", F.posexplode("sums").alias("place", "x"))
    total = placed.groupBy("part", "entry", "place").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n"))
    refined = books.copy()
    for row in total.collect():  # at most one row per component of the codebooks
        refined[row.part, row.entry, row.place] = int(row.x) // row.n
    return refined


def codebooks_of(rows: DataFrame, parts: int, entries: int, rounds: int, scale: float) -> np.ndarray | None:
    """Codebooks (part, entry, place) fitted to all ``rows``; None if there is no row with an id."""
    first = rows.filter(F.col("id").isNotNull()).orderBy("id", "vector").limit(entries).collect()
    if not first:
        return None
    seeds = np.array([row.vector for row in first])
    if seeds.shape[1] % parts:
        raise ValueError(f"vectors of {seeds.shape[1]} components can't be cut into {parts} equal parts")
    width = seeds.shape[1] // parts
    books = whole_numbers(seeds, scale, width).reshape(len(seeds), parts, width).transpose(1, 0, 2)
    for _ in range(rounds):
        books = _refined(rows, books, scale)
    return books


def compress(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: float = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, np.ndarray | None]:
    """((id, label, codes, error) of every kept row, codebooks).

    ``codes`` has an entry number per part, ``error`` is the squared distance of the whole
    numbers to what the codes stand for. Rows drop out whose vector is null, empty, or holds a
    null or a component that is not finite, and those of another length than the
    vector with the smallest id. Codebooks start from the vectors with the smallest
    ids (equal ids: the smaller vector); rows without an id are coded but start none.
    Fewer rows than ``entries`` make smaller codebooks. Repeated rows count as often as they come.
    Without any row (with an id) there are no codes and the codebooks are None.
    """
    rows = landed(kept_vectors(vectors, id_col, vector_col, label_col), "vectors")
    least = rows.filter(F.col("id").isNotNull()).orderBy("id", "vector").limit(1)
    size = [row.n for row in least.select(F.size("vector").alias("n")).collect()]
    rows = rows.filter(F.size("vector") == (size[0] if size else 0))
    books = codebooks_of(rows, parts, entries, rounds, scale)
    width = 1 if books is None else books.shape[2]  # without codebooks there are no rows
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def code(batches):
        books = shared.value
        for some, numbers in _batches(batches, 2, scale, width):
            cut = numbers.reshape(len(numbers), parts, -1)
            found = [nearest(cut[:, part], books[part]) for part in range(parts)]
            codes = np.stack([entry for entry, _ in found], axis=1)
            error = sum(distance for _, distance in found)
            columns = [some.column(0), some.column(1), pa.array(list(codes), pa.list_(pa.int64())), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "codes", "error"])

    kinds = {field.name: field.dataType.simpleString() for field in rows.schema}
    schema = f"id {kinds['id']}, label {kinds['label']}, codes array<long>, error long"
    return landed(rows.mapInArrow(code, schema), "codes"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Rows of ``compress`` with the error summed over their label; null is a label too."""
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(landed(totals, "label-errors"), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")


def codebooks_digest(books: np.ndarray | None) -> str:
    """SHA-256 of all components by part, entry and place, as decimals joined by commas."""
    numbers = [] if books is None else books.ravel().tolist()
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def reconstructed(codes: list[int], books: np.ndarray) -> np.ndarray:
    """The whole numbers that a row's codes stand for."""
    return np.concatenate([books[part, entry] for part, entry in enumerate(codes)])
