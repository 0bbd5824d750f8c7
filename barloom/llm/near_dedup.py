"""Near duplicates by a chosen-path set similarity join over minwise tokens.

Documents with the same set of shingles are one class. The classes go down several
random trees. A node of a tree picks one or two minwise functions by a hash of its path, and
sends every class to the child named by its token under each: 1 / threshold functions on
average, so that two classes at the threshold share one child of each shared node on
average. Paths don't depend on other documents, so a level is one map and one count. Nodes
of up to ``NODE_SIZE`` classes are compared exhaustively by their signatures; larger ones
branch on. At ``DEPTH`` a node still larger holds very similar classes; it is then compared in
blocks, each with the same few pivots, and what the blocks leave apart is compared with
all of the node.

In a node of many similar classes not all pairs are written out: a first round takes the
pairs of a spanning forest, most similar first, and confirms them on full sets. Where the
classes of such a node are still in different components, a second round brings their full
sets together and compares all of them exactly, in one product of matrices; only the
links of a spanning forest leave the task. So no link between classes of a node is lost,
and a group of copies costs about as many rows as it has members.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from barloom.llm.components import components
from barloom.llm.shingles import FUNCTIONS, mixed, shingle_sets, signature, similarity
from barloom.llm.words import slices
from barloom.operators.keyed import landed

#: Links: 100 * intersection >= 75 * union.
PERCENT = 75
#: At the threshold a pair shares a node of the first level of a tree with probability 0.81, so
#: that ten trees miss it with probability 1e-7; deep down it is about one in three by tree.
TREES, DEPTH, NODE_SIZE, PIVOTS = 10, 5, 700, 8
#: Shingles that a task multiplies at a time.
_COLUMNS = 2048
#: Equal signature values below which a pair isn't confirmed: four standard deviations
#: below the threshold, so one in 30,000 pairs exactly at it goes missing.
LEAST_EQUAL = 34
_SETS = "doc_id long, n_shingles long, digest string, signature binary"
_PAIRS = "node long, a long, b long"


def shingle_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, digest, signature) of every row; no digest without shingles."""

    def read(batches):
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for texts in slices(batch.column(1)):
                for found in shingle_sets(texts):
                    sizes.append(len(found))
                    digests.append(xxhash.xxh3_128_hexdigest(found.tobytes()) if len(found) else None)
                    signatures.append(signature(found).tobytes() if len(found) else None)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "signature"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(read, _SETS)


# Trees


def _children(paths: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and child nodes of classes (``tokens``: their signatures) at the nodes ``paths``."""
    seed = mixed(paths)
    first = (seed % np.uint64(FUNCTIONS)).astype(np.int64)
    step = (seed >> np.uint64(16)) % np.uint64(FUNCTIONS - 1)
    second = (first + 1 + step.astype(np.int64)) % FUNCTIONS
    # One function always, another in as many nodes as make 100 / PERCENT on average.
    twice = np.flatnonzero((seed >> np.uint64(32)) % np.uint64(PERCENT) < np.uint64(100 - PERCENT))
    rows = np.concatenate([np.arange(len(paths)), twice])
    chosen = np.concatenate([first, second[twice]])
    token = tokens[rows, chosen].astype(np.uint64)
    return rows, mixed(seed[rows] + mixed(token * np.uint64(FUNCTIONS) + chosen.astype(np.uint64)))


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, FUNCTIONS)


def _nodes(ids: pa.Array, rows: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), ids.take(pa.array(rows))], ["node", "id"])


def _roots(batches):
    for batch in batches:
        tokens = _tokens(batch.column(1))
        for tree in range(TREES):
            paths = np.full(len(tokens), tree + 1, np.uint64)
            yield _nodes(batch.column(0), *_children(paths, tokens))


def _branch(batches):
    for batch in batches:
        paths = batch.column(2).to_numpy().view(np.uint64)
        yield _nodes(batch.column(0), *_children(paths, _tokens(batch.column(1))))


def _node_members(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, id) of nodes small enough to compare, and (node, id, n) of those too large at the end."""
    signatures = classes.select("id", "signature")
    level, small = landed(signatures.mapInArrow(_roots, "node long, id long"), "level"), []
    for depth in range(DEPTH):
        sizes = level.groupBy("node").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
        members = level.join(landed(sizes, "sizes"), "node")
        small.append(landed(members.filter(F.col("n") <= NODE_SIZE).select("node", "id"), "small"))
        large = landed(members.filter(F.col("n") > NODE_SIZE), "large")
        if depth == DEPTH - 1 or large.isEmpty():
            break
        level = signatures.join(large, "id").select("id", "signature", "node").mapInArrow(_branch, "node long, id long")
        level = landed(level, "level")
    found = small[0]
    for more in small[1:]:
        found = found.unionByName(more)
    return found, large


def _blocks(large: DataFrame) -> DataFrame:
    """(node, block, id, n_blocks) of the nodes too large: blocks of half the size, dealt by hash."""
    count = F.ceil(F.col("n") / (NODE_SIZE // 2)).cast("int")
    block = F.pmod(F.xxhash64("id", "node"), count.cast("long")).cast("int")
    return large.select("node", block.alias("block"), "id", count.alias("n_blocks"))


def _block_nodes(blocks: DataFrame) -> DataFrame:
    """Blocks as nodes of their own, the least ids of a node's slots in all of them as pivots."""
    slot = F.pmod(F.xxhash64("id"), F.lit(PIVOTS))
    pivots = blocks.groupBy("node", slot.alias("slot")).agg(F.min("id").alias("id"), F.max("n_blocks").alias("n_blocks"))
    spread = pivots.select("node", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"), "id")
    rows = blocks.select("node", "block", "id").unionByName(spread)
    return rows.select(F.xxhash64("node", "block").alias("node"), "id")


# Comparing


def _similar(node, size, tokens):
    """Index pairs within a node that may be linked, by equal signature values."""
    found = []
    for step in range(1, len(node)):
        rows = np.flatnonzero(node[step:] == node[:-step])
        if not len(rows):
            break
        other = rows + step
        near = 100 * np.minimum(size[rows], size[other]) >= PERCENT * np.maximum(size[rows], size[other])
        rows, other = rows[near], other[near]
        equal = (tokens[rows] == tokens[other]).sum(axis=1)
        good = equal >= LEAST_EQUAL
        found.append(np.stack([rows[good], other[good], equal[good]]))
    return np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)


class _Forest:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    def join(self, x, y) -> bool:
        """Whether the two were apart."""
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


def _spanning(node, pairs):
    """Pairs of a spanning forest by node, most similar first; and the nodes with more pairs."""
    a, b, equal = pairs
    order = np.lexsort((-equal, node[a]))
    starts = np.flatnonzero(np.diff(node[a[order]], prepend=node[a[order[0]]] - 1)) if len(order) else []
    kept, dense = [], []
    for first, last in zip(starts, [*starts[1:], len(order)]):
        forest, some, left = _Forest(), order[first:last], 0
        members = len(np.unique(np.concatenate([a[some], b[some]])))
        for k in some.tolist():
            if forest.join(int(a[k]), int(b[k])):
                kept.append(k)
                left += 1
                if left == members - 1:
                    break
        if len(some) > left:
            dense.append(int(node[a[some[0]]]))
    return pairs[:, kept], dense


def _whole_nodes(batches):
    """Runs of rows (node, ...) of about ``NODE_SIZE``, none of which splits a node; rows come by node."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        node = batch.column(0).to_numpy()
        cut = int(np.searchsorted(node, node[-1])) if len(node) else 0
        yield from _runs(batch, node, cut)
        rest = batch.slice(cut)
    if rest is not None and len(rest):
        yield rest


def _runs(batch, node, cut):
    start = 0
    while start < cut:
        end = min(cut, start + NODE_SIZE)
        if end < cut:
            end = int(np.searchsorted(node, node[end]))
        if end <= start:
            end = int(np.searchsorted(node, node[start], side="right"))
        yield batch.slice(start, end - start)
        start = end


def _pairs_of(node, ids, pairs):
    a, b = ids[pairs[0]], ids[pairs[1]]
    real = a != b
    a, b = a[real], b[real]
    return [node[pairs[0]][real], np.minimum(a, b), np.maximum(a, b)]


def _first_round(batches):
    for batch in _whole_nodes(batches):
        node, ids, size = (batch.column(k).to_numpy() for k in range(3))
        kept, dense = _spanning(node, _similar(node, size, _tokens(batch.column(3))))
        columns = _pairs_of(node, ids, kept)
        dense = np.array(dense, np.int64)
        columns = [np.concatenate([c, d]) for c, d in zip(columns, (dense, np.full(len(dense), -1), np.full(len(dense), -1)))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "a", "b"])


def _exact_links(sets: list[np.ndarray], component: np.ndarray) -> list[tuple[int, int]]:
    """Index pairs of linked sets that tie different components together, a forest of them."""
    sizes = np.array([len(x) for x in sets], np.float64)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1  # the others are in no intersection
    number = np.cumsum(shared) - 1
    rows, columns = owner[shared[column]], number[column[shared[column]]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    common = np.zeros((len(sets), len(sets)))
    for start in range(0, int(shared.sum()), _COLUMNS):
        first, last = np.searchsorted(columns, (start, start + _COLUMNS))
        part = np.zeros((len(sets), _COLUMNS), np.float32)
        part[rows[first:last], columns[first:last] - start] = 1
        common += part @ part.T
    linked = 100 * common >= PERCENT * (sizes[:, None] + sizes[None] - common)
    linked &= component[:, None] != component[None]
    forest, found = _Forest(), []
    for x, y in np.argwhere(np.triu(linked, 1)).tolist():
        if forest.join(int(component[x]), int(component[y])):
            found.append((x, y))
    return found


def _second_round(batches):
    for batch in _whole_nodes(batches):
        node, ids, component = (batch.column(k).to_numpy() for k in range(3))
        sets = [np.frombuffer(x, "<u8") for x in batch.column(3).to_pylist()]
        starts = np.flatnonzero(np.diff(node, prepend=node[0] - 1)).tolist()
        found = []
        for first, last in zip(starts, [*starts[1:], len(node)]):
            if len(set(component[first:last].tolist())) > 1:
                found += [(first + x, first + y) for x, y in _exact_links(sets[first:last], component[first:last])]
        pairs = np.array(found, np.int64).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in _pairs_of(node, ids, pairs)], ["node", "a", "b"])


def _compared(rows: DataFrame, function) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node", "id").mapInArrow(function, _PAIRS)


def _texts(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.join(ids, "id", "left_semi")


def _full_sets(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, shingles) of some classes, the numbers as bytes."""

    def read(batches):
        for batch in batches:
            found = [x.tobytes() for texts in slices(batch.column(1)) for x in shingle_sets(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "shingles"])

    return _texts(ids, docs, id_col, text_col).mapInArrow(read, "id long, shingles binary")


def _links(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    needed = landed(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "needed")
    texts = landed(_texts(needed, docs, id_col, text_col), "texts")
    first = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = first.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")

    def confirm(batches):
        for batch in batches:
            good, columns = [], [slices(batch.column(k)) for k in (2, 3)]
            left = (found for part in columns[0] for found in shingle_sets(part))
            right = (found for part in columns[1] for found in shingle_sets(part))
            for x, y in zip(left, right):
                common, union = similarity(x, y)
                good.append(bool(union) and 100 * common >= PERCENT * union)
            yield batch.select(range(2)).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(confirm, "a long, b long")


def _labels(classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, component) of the classes that have links, by both rounds."""
    members, large = _node_members(classes)
    oversize = not large.isEmpty()
    if oversize:
        blocks = landed(_blocks(large), "blocks")
        members = members.unionByName(_block_nodes(blocks))
    rows = members.join(classes, "id").select("node", "id", "size", "signature")
    found = landed(_compared(rows, _first_round), "pairs")
    pairs = landed(found.filter(F.col("a") >= 0).select("a", "b").distinct(), "first-pairs")
    links = landed(_links(pairs, docs, id_col, text_col), "links")
    labels = landed(components(links), "labels")

    every = classes.select("id").join(labels, F.col("id") == F.col("node"), "left")
    every = landed(every.select("id", F.coalesce("component", "id").alias("component")), "labelled")
    dense = landed(found.filter(F.col("a") < 0).select("node").distinct(), "dense")
    again = members.join(dense, "node", "left_semi").join(every, "id")
    torn = again.groupBy("node").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    torn = landed(torn.filter(F.col("x") != F.col("y")).select("node"), "torn")
    again = again.select("node", "id", "component").join(torn, "node", "left_semi")
    if oversize:
        again = again.unionByName(_left_over(blocks, every))
    again = landed(again, "again")
    if again.isEmpty():
        return labels
    needed = landed(again.select("id").distinct(), "needed")
    sets = landed(_full_sets(needed, docs, id_col, text_col), "sets")
    rows = again.join(sets, "id").select("node", "id", "component", "shingles")
    more = landed(_compared(rows, _second_round).select("a", "b").distinct(), "more-links")
    return labels if more.isEmpty() else components(links.unionByName(more))


def _left_over(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes that pair classes outside a large node's main component with each of its blocks."""
    rows = landed(blocks.join(labels, "id"), "block-labels")
    counts = rows.groupBy("node", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("node").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    apart = rows.join(landed(main, "main"), "node").filter(F.col("component") != F.col("main"))
    sizes = landed(apart.groupBy("node").agg(F.count("*").alias("m")), "apart")
    chunks = F.ceil(F.col("m") / (NODE_SIZE // 2)).cast("int")
    chunk = F.pmod(F.xxhash64("id"), chunks.cast("long")).cast("int")
    all_blocks = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block")
    asked = apart.join(sizes, "node").select("node", chunk.alias("chunk"), "id", "component", all_blocks)
    all_chunks = F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk")
    there = rows.join(sizes, "node").select("node", all_chunks, "id", "component", "block")
    every = asked.unionByName(there.select(*asked.columns))
    return every.select(F.xxhash64("node", "block", "chunk").alias("node"), "id", "component")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``; ids are integers.

    A component is what links tie together, named by its smallest id, whose row is kept.
    A null, empty or blank text has no shingles and is linked with nothing. Rows that
    repeat an id with the same text are alike in all columns; with another text, they are
    taken for one document. A row without an id is linked with nothing and kept. An empty
    table gives no rows.
    """
    every = landed(shingle_table(docs, id_col, text_col), "shingles")
    sets = every.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = sets.groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("size"), F.first("signature").alias("signature")
    )
    classes = landed(classes, "classes")
    labels = _labels(classes.drop("digest"), docs, id_col, text_col)
    labels = labels.select(F.col("node").alias("id"), "component")
    named = classes.select("digest", "id").join(labels, "id", "left")
    named = landed(named.select("digest", F.coalesce("component", "id").alias("component")), "named")
    rows = every.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    rows = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns."""
    gone = near_groups(docs, id_col, text_col).filter(~F.col("kept"))
    gone = landed(gone.select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    return docs.join(gone.hint("merge"), docs[id_col] == gone["_gone"], "left_anti")
