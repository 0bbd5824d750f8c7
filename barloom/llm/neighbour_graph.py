"""Nearest neighbours by cosine: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node, so a vector that many rows share is no heavier than another.

*Build.* Nodes start with neighbours from random groups. In a round, the neighbours of a node and a
fixed number of nodes it is a neighbour of meet in its list; a join brings their vectors,
and a task compares them with each other if one is new in its list. What is nearer than a
node's farthest neighbour goes to that node. Rounds end when few lists change. Lists
have fixed lengths: of the nodes that hold a popular one as neighbour, one per hash slot
goes on, picked before the shuffle, and offers are thinned the same way.

*Search.* A query holds its best nodes so far (its beam). A round takes the best ones not yet
expanded, joins their links and vectors, and keeps the best of old and new; the search of a query is over
when all of its beam is expanded. It starts at the best of a fixed number of entry nodes,
and at its own node if its vector is in the graph. Scores of the search are in double precision
on the vectors as given; only the graph is built on half-precision unit vectors.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from barloom.operators.keyed import landed, top_k

#: Neighbours of a node, reverse ones in its list, offers a node gets from one list, slots of offers.
NEIGHBOURS, REVERSE, OFFERS, SLOTS = 32, 24, 6, 128
#: Rounds end when fewer than this share of neighbours is new, or after so many rounds.
SETTLED, ROUNDS = 0.01, 16
#: Members of a starting group, on average.
_GROUP = 64
#: Entry nodes of a search, starts a query takes from them, beam, nodes expanded a round.
ENTRIES, STARTS, BEAM, WIDTH = 256, 4, 128, 24
_CHUNK = 256
_NBRS = "array<struct<score:float,id:bigint,fresh:boolean>>"
_SEEN = "array<struct<score:double,node:bigint,done:boolean>>"


@dataclass(frozen=True)
class Graph:
    """``nodes`` (node, vector, ids of its first rows) and ``links`` (node, others)."""

    nodes: DataFrame
    links: DataFrame


def sound_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vector) of the rows that take part: an id, and a vector of finite components that isn't zero.

    All vectors must be as long as that of the smallest id; others take no part. Repeated rows are one.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    real = F.exists("vector", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.coalesce(finite & real, F.lit(False)))
    rows = landed(rows.distinct(), "vectors")
    first = [r.n for r in rows.orderBy("id", "vector").limit(1).select(F.size("vector").alias("n")).collect()]
    return rows.filter(F.size("vector") == (first[0] if first else 0))


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows. Every pair is summed in the same order, whatever else is in the batch."""
    scale = [np.abs(x).max(axis=-1, keepdims=True) for x in (a, b)]
    a, b = a / scale[0], b / scale[1]
    return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


# Build


def _with_units(nodes: DataFrame) -> DataFrame:
    def unit(batches):
        for batch in batches:
            x = _matrix(batch.column(1)) if batch.num_rows else np.empty((0, 1))
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype("<f2")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["node", "unit"])

    return nodes.select("node", "vector").mapInArrow(unit, "node long, unit binary")


def _compare(lists: DataFrame, most: int) -> DataFrame:
    """(to, id, score): what members of a list (id, fresh, least, unit) offer to each other.

    Pairs of which one is fresh, above the least score a member still takes; ``most`` a member at most.
    """

    def compare(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, _CHUNK):
                members = batch.column(0).slice(start, _CHUNK)
                sizes = np.diff(members.offsets.to_numpy())
                flat = members.flatten()
                ids, fresh, least, units = (flat.field(k) for k in range(4))
                if not len(ids):
                    continue
                vectors = np.stack([np.frombuffer(u, "<f2") for u in units.to_pylist()]).astype(np.float32)
                ids, least = ids.to_numpy(), least.to_numpy(zero_copy_only=False)
                fresh = fresh.to_numpy(zero_copy_only=False).astype(bool)
                wide = np.arange(sizes.max())
                real = wide < sizes[:, None]
                at = np.where(real, (np.cumsum(sizes) - sizes)[:, None] + wide, 0)
                x = vectors[at]
                scores = x @ x.transpose(0, 2, 1)
                fit = real[:, :, None] & real[:, None, :] & (fresh[at][:, :, None] | fresh[at][:, None, :])
                fit &= (ids[at][:, :, None] != ids[at][:, None, :]) & (scores > least[at][:, :, None])
                scores[~fit] = -9
                best = np.argpartition(-scores, min(most, len(wide)) - 1, axis=2)[:, :, :most]
                top = np.take_along_axis(scores, best, axis=2)
                group, row, place = np.nonzero(top > -9)
                other = best[group, row, place]
                columns = [pa.array(ids[at[group, row]]), pa.array(ids[at[group, other]]), pa.array(top[group, row, place])]
                yield pa.RecordBatch.from_arrays(columns, ["to", "id", "score"])

    return lists.select("members").mapInArrow(compare, "to long, id long, score float")


def _neighbour(fresh: bool) -> Column:
    return F.struct("score", "id", F.lit(fresh).alias("fresh"))


def _nearest(neighbours: Column, most: int) -> Column:
    return F.slice(F.sort_array(neighbours, asc=False), 1, most)


def _random_graph(units: DataFrame, size: int, most: int) -> DataFrame:
    """(node, unit, nbrs): the nearest of the two random groups a node is in."""
    groups = -(-size // _GROUP)
    member = F.struct(F.col("node").alias("id"), F.lit(True).alias("fresh"), F.lit(-2.0).cast("float").alias("least"), "unit")
    lists = None
    for salt in (1, 2):
        group = F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(groups)).alias("group")
        some = units.groupBy(group).agg(F.collect_list(member).alias("members"))
        lists = some if lists is None else lists.unionByName(some)
    offers = _compare(lists, most).distinct()
    found = offers.groupBy("to").agg(_nearest(F.collect_list(_neighbour(True)), most).alias("nbrs"))  # from two lists
    joined = units.join(found.withColumnRenamed("to", "node"), "node", "left")
    return joined.withColumn("nbrs", F.coalesce("nbrs", F.array().cast(_NBRS)))


def _reverse(graph: DataFrame, slots: int, salt: int) -> DataFrame:
    """(node, back): some of the nodes that hold a node as neighbour, one per slot, fresh ones first."""
    edges = graph.select("node", F.explode("nbrs").alias("nbr"))
    mixed = F.xxhash64("node", F.lit(salt))
    pick = F.struct((~F.col("nbr.fresh")).alias("old"), mixed.alias("mixed"), "node")
    slot = F.pmod(F.shiftright(mixed, 20), F.lit(slots)).alias("slot")
    picked = edges.groupBy(F.col("nbr.id").alias("of"), slot).agg(F.min(pick).alias("p"))
    holder = F.struct(F.col("p.node").alias("id"), (~F.col("p.old")).alias("fresh"))
    return picked.groupBy(F.col("of").alias("node")).agg(F.collect_list(holder).alias("back"))


def _lists(graph: DataFrame, reverse: int, salt: int) -> DataFrame:
    """(node, list): neighbours and some reverse ones of each node, as (id, fresh)."""
    joined = graph.select("node", "nbrs").join(_reverse(graph, reverse, salt), "node", "left")
    own = F.transform("nbrs", lambda e: F.struct(e["id"].alias("id"), e["fresh"].alias("fresh")))
    known = F.transform("nbrs", lambda e: e["id"])
    others = F.filter("back", lambda e: ~F.array_contains(known, e["id"]))
    others = F.coalesce(others, F.array().cast("array<struct<id:bigint,fresh:boolean>>"))
    return joined.select("node", F.concat(own, others).alias("list"))


def _descended(graph: DataFrame, most: int, reverse: int, salt: int) -> DataFrame:
    """The graph after a round."""
    lists = _lists(graph, reverse, salt).filter(F.exists("list", lambda e: e["fresh"]))
    members = lists.select(F.col("node").alias("of"), F.explode("list").alias("e")).select("of", "e.id", "e.fresh")
    least = F.when(F.size("nbrs") == most, F.element_at("nbrs", -1)["score"]).otherwise(F.lit(-2.0).cast("float"))
    vectors = graph.select(F.col("node").alias("id"), least.alias("least"), "unit")
    tasks = int(graph.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # comparing costs more than its bytes tell
    met = members.join(vectors, "id").repartition(tasks, "of").groupBy("of").agg(F.collect_list(F.struct("id", "fresh", "least", "unit")).alias("members"))
    offers = _compare(met, OFFERS)
    slot = F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(SLOTS)).alias("slot")
    best = offers.groupBy("to", slot).agg(F.max(F.struct("score", "id")).alias("e")).select("to", "e.score", "e.id")
    best = best.groupBy(F.col("to").alias("node")).agg(F.collect_list(_neighbour(True)).alias("offered"))  # a row per slot
    joined = graph.join(best, "node", "left")
    old = F.transform("nbrs", lambda e: F.struct(e["score"].alias("score"), e["id"].alias("id"), F.lit(False).alias("fresh")))
    known = F.transform("nbrs", lambda e: e["id"])
    new = F.filter(F.coalesce("offered", F.array().cast(_NBRS)), lambda e: ~F.array_contains(known, e["id"]))
    return joined.select("node", "unit", _nearest(F.concat(old, new), most).alias("nbrs"))


def build(vectors: DataFrame, neighbours: int = NEIGHBOURS, reverse: int = REVERSE, members: int = 6) -> Graph:
    """The graph of ``sound_vectors``; a node keeps the ``members`` smallest ids of its rows."""
    first = top_k(vectors, ["vector"], members, [F.asc("id")])
    nodes = first.groupBy("vector").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("ids"))
    nodes = landed(nodes, "nodes")
    size = nodes.count()
    graph = landed(_random_graph(landed(_with_units(nodes), "units"), size, neighbours), "graph")
    for salt in range(ROUNDS):
        graph = landed(_descended(graph, neighbours, reverse, salt), "graph")
        new = F.size(F.filter("nbrs", lambda e: e["fresh"]))
        if (graph.agg(F.sum(new).alias("n")).first().n or 0) <= SETTLED * size * neighbours:
            break
    links = _lists(graph, reverse, -1).select("node", F.transform("list", lambda e: e["id"]).alias("others"))
    return Graph(nodes, landed(links, "links"))


# Search


def _started(queries: DataFrame, nodes: DataFrame) -> DataFrame:
    """(q, beam): scores of the best entry nodes, and of the node that is the query's own vector."""
    own = queries.join(nodes.select("vector", "node"), "vector", "left").select("q", "vector", "node")
    entries = nodes.orderBy(F.xxhash64("node")).limit(ENTRIES).select("node", "vector").collect()
    ids = np.array([r.node for r in entries], np.int64)
    vectors = np.array([r.vector for r in entries], np.float64)

    def start(batches):
        for batch in batches:
            queries, beams = _matrix(batch.column(1)) if batch.num_rows else [], []
            for vector, node in zip(queries, batch.column(2).to_pylist()):
                scores = cosine(vector, vectors)
                found = {int(ids[k]): float(scores[k]) for k in np.argsort(-scores, kind="stable")[:STARTS]}
                if node is not None:
                    found[node] = float(cosine(vector, vector))
                beams.append([{"score": s, "node": n, "done": False} for n, s in found.items()])
            kind = pa.list_(pa.struct([("score", pa.float64()), ("node", pa.int64()), ("done", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(beams, kind)], ["q", "beam"])

    started = own.mapInArrow(start, f"q long, beam {_SEEN}")
    return started.withColumn("beam", F.sort_array("beam", asc=False))


def _scored(pairs: DataFrame) -> DataFrame:
    def score(batches):
        for batch in batches:
            found = cosine(_matrix(batch.column(2)), _matrix(batch.column(3))) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], ["q", "node", "score"])

    return pairs.select("q", "node", "own", "vector").mapInArrow(score, "q long, node long, score double")


def _expanded(state: DataFrame, queries: DataFrame, graph: Graph, beam: int, width: int) -> DataFrame:
    """The beams after a round."""
    ahead = F.slice(F.filter("beam", lambda e: ~e["done"]), 1, width)
    state = state.withColumn("ahead", F.transform(ahead, lambda e: e["node"]))
    front = state.select("q", F.explode("ahead").alias("node"))
    pairs = front.join(graph.links, "node").select("q", F.explode("others").alias("node")).distinct()
    own = queries.select("q", F.col("vector").alias("own"))
    met = _scored(pairs.join(graph.nodes.select("node", "vector"), "node").join(own, "q"))
    found = met.groupBy("q").agg(F.collect_list(F.struct("score", "node", F.lit(False).alias("done"))).alias("met"))
    known = F.transform("beam", lambda e: e["node"])
    old = F.transform(
        "beam",
        lambda e: F.struct(
            e["score"].alias("score"), e["node"].alias("node"), (e["done"] | F.array_contains("ahead", e["node"])).alias("done")
        ),
    )
    new = F.filter(F.coalesce("met", F.array().cast(_SEEN)), lambda e: ~F.array_contains(known, e["node"]))
    joined = state.join(found, "q", "left")
    return joined.select("q", F.slice(F.sort_array(F.concat(old, new), asc=False), 1, beam).alias("beam"))


def search(graph: Graph, queries: DataFrame, k: int = 5, beam: int = BEAM, width: int = WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each of ``queries`` (id, vector).

    Nearest first, ties to the smaller id; a row with the query's own id is no
    candidate. Queries with equal vectors are searched once. A graph that keeps fewer than ``k`` + 1
    ids a node may give fewer rows. An empty graph gives none.
    """
    distinct = landed(queries.groupBy("vector").agg(F.min("id").alias("q")), "queries")
    state = landed(_started(distinct, graph.nodes), "beams")
    while not state.filter(F.exists("beam", lambda e: ~e["done"])).isEmpty():
        state = landed(_expanded(state, distinct, graph, beam, width), "beams")

    found = state.select("q", F.explode("beam").alias("e")).select("q", "e.node", "e.score")
    rows = found.join(graph.nodes.select("node", "ids"), "node").select("q", "score", F.explode("ids").alias("vec_id"))
    # One more than asked for, as one may be the query itself; a beam and its ids bound a list.
    first = F.struct((-F.col("score")).alias("far"), "vec_id", "score")
    lists = rows.groupBy("q").agg(F.slice(F.sort_array(F.collect_list(first)), 1, k + 1).alias("found"))
    asked = queries.join(distinct, "vector").select(F.col("id").alias("query_id"), "q")
    others = asked.join(landed(lists, "found"), "q").select(
        "query_id", F.slice(F.filter("found", lambda e: e["vec_id"] != F.col("query_id")), 1, k).alias("found")
    )
    placed = others.select("query_id", F.posexplode("found").alias("at", "e"))
    return placed.select("query_id", (F.col("at") + 1).alias("rank"), "e.vec_id", "e.score")
