"""Maximum-weight bipartite matching per component (S6), and what consolidation builds on it."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType
from pyspark.sql.window import Window

from xmarket.operators.graph import connected_components
from xmarket.session import written

col = F.col


def best_assignment(weight: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of rows and columns with the highest total of positive weights."""
    a, b = np.nonzero(weight > 0)
    chosen = best_edges(a, b, weight[a, b].astype(float))
    return [(int(a[e]), int(b[e])) for e in chosen]


def best_edges(left: np.ndarray, right: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Positions of the edges of a matching of highest total weight; weights are positive, no edge is repeated.

    Hungarian method with potentials on adjacency lists: each node of the smaller side in turn is the start of a search for the
    shortest augmenting path, over edges alone.  Memory grows with the edges, not with the product of the sides.
    """
    if not len(weight):
        return np.zeros(0, np.int64)
    if left.max() > right.max():
        left, right = right, left
    n, m = int(left.max()) + 1, int(right.max()) + 1
    order = np.argsort(left, kind="stable")
    to, cost = right[order], -weight[order]
    starts = np.searchsorted(left[order], np.arange(n + 1))
    # u + v <= cost on all edges, equal on matched ones, v <= 0 and 0 for free columns; u <= 0: a row may stay alone at no cost
    u, v = np.zeros(n), np.zeros(m)
    owner, mine = np.full(m, -1, np.int64), np.full(n, -1, np.int64)  # row of a column, edge of a row
    least, via = np.full(m, np.inf), np.zeros(m, np.int64)  # of the search: distance of a column, edge it was reached by
    done = np.zeros(m, bool)
    for root in range(n):
        row, base, heap, reached, scanned = root, 0.0, [], [], []
        alone, end = np.inf, -1  # the best row to leave alone
        first, last = starts[root], starts[root + 1]
        u[root] = min(0.0, float((cost[first:last] - v[to[first:last]]).min(initial=0.0)))
        while True:
            scanned.append((row, base))
            if base - u[row] < alone:  # leaving this row alone ends the path
                alone, end = base - u[row], row
            first, last = starts[row], starts[row + 1]
            at = to[first:last]
            far = base + (cost[first:last] - u[row] - v[at])
            near = np.flatnonzero((far < least[at]) & (far < alone) & ~done[at])
            if len(near):
                found = at[near]
                least[found], via[found] = far[near], near + first
                reached.append(found)
                free = owner[found] < 0
                if free.any():  # of the free columns only the nearest can end the path
                    best = int(far[near][free].argmin())
                    heapq.heappush(heap, (float(far[near][free][best]), -1, int(found[free][best])))
                for d, c in zip(far[near][~free].tolist(), found[~free].tolist(), strict=True):
                    heapq.heappush(heap, (d, 0, c))
            while heap and (done[heap[0][2]] or heap[0][0] > least[heap[0][2]]):
                heapq.heappop(heap)
            if not heap or heap[0][0] >= alone:
                total, column = alone, -1
                break
            base, _, column = heapq.heappop(heap)
            if owner[column] < 0:
                total = base
                break
            done[column] = True
            row = int(owner[column])
        for r, d in scanned:
            u[r] += total - d
        touched = np.concatenate(reached) if reached else np.zeros(0, np.int64)
        closed = touched[done[touched]]
        closed = np.unique(closed)
        v[closed] -= total - least[closed]
        if column >= 0:
            at_row, edge = -1, via[column]
        else:
            at_row, edge = end, mine[end]
            mine[end] = -1
            if edge >= 0:  # its column goes to the row that reached it
                column = int(to[edge])
                edge = via[column]
        while column >= 0:
            row = int(np.searchsorted(starts, edge, side="right")) - 1
            before, mine[row], owner[column] = mine[row], edge, row
            if row == root:
                break
            column = int(to[before])
            edge = via[column]
        least[touched], done[touched] = np.inf, False
    return order[mine[mine >= 0]]


CHUNK_EDGES = 1 << 20  # edges that a task looks at together
PACKET_EDGES = 1 << 14  # edges in one row of packets
FOREST_EDGES = 1 << 21  # edges of forests that one task can join
PACKET = pa.schema([("root", pa.string()), ("own", pa.list_(pa.string())), ("edges", pa.binary())])


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Per node of 0 to n - 1 the smallest one of its component; a and b are the ends of edges."""
    root = np.arange(n)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (up := root[root]).tobytes() != root.tobytes():
            root = up


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    coded = pa.concat_arrays(column.chunks).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _packets(batches):
    """Edges (k_id, p_id, weight) of one component as far as a chunk shows, in rows: a K node that stands for it, its K nodes (once), edges as an Arrow stream."""

    def packed(edges: pa.Table):
        (k, names), (p, others) = _codes(edges["k_id"]), _codes(edges["p_id"])
        root = _roots(k, p + len(names), len(names) + len(others))  # K nodes have the lower numbers
        order = np.argsort(root[k], kind="stable")
        edges, of = edges.take(order), root[k][order]
        nodes = np.argsort(root[: len(names)], kind="stable")
        node_of = root[: len(names)][nodes]
        for r in np.unique(of):
            first, last = np.searchsorted(of, [r, r + 1])
            own = names.take(pa.array(nodes[slice(*np.searchsorted(node_of, [r, r + 1]))])).to_pylist()
            for at in range(first, last, PACKET_EDGES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, edges.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
                    out.write_table(edges.slice(at, min(PACKET_EDGES, last - at)))
                yield {"root": names[int(r)].as_py(), "own": own if at == first else [], "edges": sink.getvalue().to_pybytes()}

    def rows(edges: list[pa.RecordBatch]):
        made, size = [], 0
        for row in packed(pa.Table.from_batches(edges)):
            made.append(row)
            size += len(row["edges"])
            if size > 1 << 24 or len(made) >= 1000:
                yield pa.RecordBatch.from_pylist(made, PACKET)
                made, size = [], 0
        if made:
            yield pa.RecordBatch.from_pylist(made, PACKET)

    held, n = [], 0
    for batch in batches:
        held, n = [*held, batch], n + len(batch)
        if n >= CHUNK_EDGES:
            yield from rows(held)
            held, n = [], 0
    if n:
        yield from rows(held)


def _whole(batches):
    """Components of the edges (root, node) of all batches, of one task: (node, component), a component by one of its nodes."""
    edges = pa.Table.from_batches(list(batches), pa.schema([("root", pa.string()), ("node", pa.string())]))
    coded = pa.chunked_array([*edges["root"].chunks, *edges["node"].chunks], pa.string()).combine_chunks().dictionary_encode()
    ends, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    found = _roots(ends[: len(edges)], ends[len(edges) :], len(names))
    yield from pa.table({"node": names, "component": names.take(pa.array(found))}).to_batches(10_000)


def maximum_weight_matching(edges: DataFrame, k: str = "k_id", p: str = "p_id", weight: str = "weight") -> DataFrame:
    """The edges of a matching of highest total weight; one component is one task's work.

    Repeated edges count once with their highest weight; edges of weight zero or less are never chosen.  Edges are dealt by P node, and each
    task packs those that its own edges connect: components are found between packets, by a forest of each chunk's K nodes, and edges move in packets.
    """
    named = edges.where(col(weight) > 0).select(col(k).alias("k_id"), col(p).alias("p_id"), col(weight).cast("double").alias("weight"))
    as_text = [col(c).cast("string").alias(c) for c in ("k_id", "p_id")]
    if not all(isinstance(named.schema[c].dataType, (IntegralType, StringType)) for c in ("k_id", "p_id")):
        named = named.select(*as_text, "weight")  # values that differ may have one text
    dealt = named.where("k_id is not null and p_id is not null").repartition("p_id")
    best = dealt.groupBy("p_id", "k_id").agg(F.max("weight").alias("weight")).select(*as_text, "weight")
    packets = written(best.mapInArrow(_packets, "root string, own array<string>, edges binary"), "packets")
    forest = packets.select("root", F.explode("own").alias("node"))
    n, before, labels = forest.count(), np.inf, "node string, component string"
    while FOREST_EDGES < n <= before / 2:  # each task leaves a forest of its edges
        held = forest.repartition(-(-n // FOREST_EDGES)).mapInArrow(_whole, labels).where("node <> component")
        forest = written(held.select(col("component").alias("root"), "node"), "forest")
        n, before = forest.count(), n
    parts = forest.coalesce(1).mapInArrow(_whole, labels) if n <= FOREST_EDGES else connected_components(forest, "root", "node")
    parts = written(parts, "components").select(col("node").alias("root"), "component")
    return _solved(packets.join(parts, "root", "left").withColumn("component", F.coalesce("component", "root")))  # a K node alone has no forest


def _solved(packets: DataFrame) -> DataFrame:
    def solve(packets: pa.Table) -> pa.Table:
        edges = pa.concat_tables([pa.ipc.open_stream(e.as_buffer()).read_all() for e in packets["edges"]])
        ends = [pc.rank(edges[side], tiebreaker="dense").to_numpy().astype(np.int64) - 1 for side in ("k_id", "p_id")]
        order = np.lexsort((ends[1], ends[0]))  # the same matching whatever the order of the rows
        return edges.take(order[best_edges(ends[0][order], ends[1][order], edges["weight"].to_numpy()[order])])

    return packets.select("component", "edges").groupBy("component").applyInArrow(solve, "k_id string, p_id string, weight double")


STAGE_BONUS = {"review": 300, "detail": 200, "frontier": 200, "tiebreak": 300, "cheap": 0, "legacy": 100}


def decision_weight(confidence, quality, score, stage):
    """Whole points: confidence in ten-thousandths, quality, ten per shared keyword, and a bonus of the stage."""
    from xmarket.functions.text import literal_map

    bonus = F.coalesce(F.element_at(literal_map({k: str(v) for k, v in STAGE_BONUS.items()}), stage).cast("int"), F.lit(0))
    return (F.bround(confidence * 10000, 0) + F.coalesce(quality, F.lit(0)) + 10 * F.coalesce(score, F.lit(0)) + bonus).cast("long")


def bridges(records: DataFrame, order) -> DataFrame:
    """Of valid contract matches the first per contract key in a window's order."""
    good = records.where("status = 'valid' and decision = 'MATCH' and candidate_type <> 'event'")
    return good.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def consolidate(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(event matches, contract bridges) from decisions (pair_id, candidate_type, status, decision, weight, ids)."""
    events = maximum_weight_matching(records.where("status = 'valid' and decision = 'MATCH' and candidate_type = 'event'"))
    key = ["k_id", "p_id", "k_bet_id", "p_bet_id"]
    return events, bridges(records, Window.partitionBy(*key).orderBy(F.desc("weight"), "pair_id")).orderBy(*key)
