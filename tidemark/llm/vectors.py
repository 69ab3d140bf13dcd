"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard.

Vectors that may be compared (one label) are dealt to shards; each shard gets a graph. For each pair of shards, the vectors of either
are queried in the other's graph, the beam being widened until an audit against brute force finds the wanted share of links. Links are verified by
cosine in double precision, counted on both sides, and a spanning forest of them goes on to the union of components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components, spanning_forest
from tidemark.plans.durable import cut_lineage

SHARD = 2048
NEIGHBOURS = 12
BUILD_BEAM = 32
AUDITED = 64
RECALL = 0.98


class SmallWorld:
    """A hierarchical graph over unit vectors, built in growing batches; searches run for many queries at once."""

    def __init__(self, vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.vectors = vectors.astype(np.float32)
        # per layer, top first: the nodes, and each node's neighbours as places among them (-1: none)
        self.layers = layers

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int) -> SmallWorld:
        """Node levels fall off by the usual exponential law; every layer is a graph over the nodes that reach it."""
        n = len(vectors)
        rng = np.random.default_rng(seed)
        levels = np.minimum((-np.log(1 - rng.random(n)) / np.log(NEIGHBOURS)).astype(int), 8)
        levels[:1] = max(0, levels.max(initial=0))
        single = vectors.astype(np.float32)
        layers: list[tuple[np.ndarray, np.ndarray]] = []
        for level in range(levels.max(initial=0), -1, -1):
            nodes = np.flatnonzero(levels >= level)
            layers.append((nodes, cls._layer(single[nodes], 2 * NEIGHBOURS if level == 0 else NEIGHBOURS)))
        return cls(vectors, layers)

    @staticmethod
    def _layer(vectors: np.ndarray, most: int) -> np.ndarray:
        """Neighbours of nodes that come in batches, each batch as large as a quarter of those before it: found by beam, linked both ways."""
        n = len(vectors)
        links = np.full((n, most), -1, np.int32)
        done = min(n, 64)
        _link(vectors, links, np.arange(done), [np.arange(done)] * done)
        while done < n:
            fresh = np.arange(done, min(n, done + max(16, done // 4)))
            found, _ = _beam(vectors[:done], links[:done], vectors[fresh], np.zeros((len(fresh), 1), np.int64), BUILD_BEAM)
            near = np.argsort(-(vectors[fresh] @ vectors[fresh].T), axis=1)[:, : most // 2 + 1]
            wanted = [np.unique(np.append(f[f >= 0], fresh[k])) for f, k in zip(found, near, strict=True)]
            _link(vectors, links, fresh, wanted)
            done = int(fresh[-1]) + 1
        return links

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest found per query, best first (-1: none), and their similarities in single precision."""
        entry = np.zeros((len(queries), 1), np.int64)
        queries = queries.astype(np.float32)
        for depth, (nodes, links) in enumerate(self.layers):
            last = depth == len(self.layers) - 1
            found, near = _beam(self.vectors[nodes], links, queries, entry, beam if last else 2)
            if not last:
                below = self.layers[depth + 1][0]
                entry = np.searchsorted(below, nodes[found[:, :1]])
        return np.where(found >= 0, nodes[found], -1), near


def _link(vectors: np.ndarray, links: np.ndarray, fresh: np.ndarray, wanted: list[np.ndarray]) -> None:
    """Link each fresh node with the best of its wanted ones, and those back; a full node keeps neighbours that are closer to it than to a kept one."""
    most = links.shape[1]
    back: dict[int, list[int]] = {}
    for node, others in zip(fresh.tolist(), wanted, strict=True):
        others = others[others != node]
        chosen = _diverse(vectors, node, others, most // 2)
        links[node, : len(chosen)] = chosen
        for other in chosen.tolist():
            back.setdefault(other, []).append(node)
    for node, new in back.items():
        all_ = np.unique(np.append(links[node][links[node] >= 0], new))
        chosen = all_ if len(all_) <= most else _diverse(vectors, node, all_, most)
        links[node] = -1
        links[node, : len(chosen)] = chosen


def _diverse(vectors: np.ndarray, node: int, others: np.ndarray, most: int) -> np.ndarray:
    if len(others) <= most:
        return others
    near = vectors[others] @ vectors[node]
    order = np.argsort(-near, kind="stable")[: 4 * most]
    others, near = others[order], near[order]
    between = vectors[others] @ vectors[others].T
    kept: list[int] = []
    for k in range(len(others)):
        if len(kept) == most:
            break
        if all(between[k, kept] < near[k]) if kept else True:
            kept.append(k)
    if len(kept) < most:
        spare = [k for k in range(len(others)) if k not in set(kept)]
        kept += spare[: most - len(kept)]
    return others[kept]


def _beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search for all queries in step: each step expands every query's best open candidate."""
    n, q = len(vectors), len(queries)
    beam = min(beam, n)
    found = np.full((q, beam), -1, np.int64)
    near = np.full((q, beam), -np.inf, np.float32)
    open_ = np.zeros((q, beam), bool)
    seen = np.zeros((q, n + 1), bool)
    every = np.arange(q)
    first = entry[:, 0]
    found[:, 0], open_[:, 0] = first, True
    near[:, 0] = np.einsum("ij,ij->i", vectors[first], queries)
    seen[every, first] = True
    seen[:, n] = True  # stands for no neighbour
    live = every
    while len(live):
        best = np.where(open_[live], near[live], -np.inf).argmax(axis=1)
        going = open_[live, best]
        live, best = live[going], best[going]
        if not len(live):
            break
        open_[live, best] = False
        around = links[found[live, best]].astype(np.int64)
        around[around < 0] = n
        fresh = ~seen[live[:, None], around]
        seen[live[:, None], around] = True
        near_them = np.einsum("ijk,ik->ij", vectors[np.minimum(around, n - 1)], queries[live])
        near_them[~fresh] = -np.inf
        all_near = np.concatenate([near[live], near_them], axis=1)
        all_found = np.concatenate([found[live], np.where(fresh, around, -1)], axis=1)
        all_open = np.concatenate([open_[live], fresh], axis=1)
        top = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        rows = np.arange(len(live))[:, None]
        near[live], found[live], open_[live] = all_near[rows, top], all_found[rows, top], all_open[rows, top]
        open_[live] &= np.isfinite(near[live])
        found[live] = np.where(np.isfinite(near[live]), found[live], -1)
    return found, near


def linked(graph: SmallWorld, exact: np.ndarray, queries: np.ndarray, least: float, beam: int = 24) -> np.ndarray:
    """Boolean matrix queries by vectors: links with cosine of ``least`` or more, found by beams.

    A query whose beam is full of links is searched with a wider one. Then some queries are compared with all vectors; while the share of
    their links that was found is below ``RECALL``, all are searched with wider beams. A beam as wide as half the shard gives way to a scan of all.
    """
    n, q = len(exact), len(queries)
    result = np.zeros((q, n), bool)
    margin = np.float32(least - 1e-4)
    audited = np.linspace(0, q - 1, min(q, AUDITED)).astype(int)
    truth = queries[audited] @ exact.T >= least
    todo = np.arange(q)
    while len(todo):
        if 2 * beam >= n:
            for at in range(0, len(todo), 256):
                part = todo[at : at + 256]
                result[part] = queries[part] @ exact.T >= least
            break
        full = []
        for at in range(0, len(todo), 1024):
            part = todo[at : at + 1024]
            found, near = graph.search(queries[part], beam)
            hit = (near >= margin) & (found >= 0)
            rows, places = np.nonzero(hit)
            others = found[rows, places]
            sure = np.einsum("ij,ij->i", queries[part[rows]], exact[others]) >= least
            result[part[rows[sure]], others[sure]] = True
            full.append(part[hit.all(axis=1)])
        wanted = int(truth.sum())
        if wanted and (truth & result[audited]).sum() < RECALL * wanted:
            todo = np.arange(q)
        else:
            todo = np.concatenate(full)
        beam *= 3
    return result


def _unpack(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, "<f8").reshape(n, -1)


def _graph_bytes(graph: SmallWorld) -> list[dict]:
    return [{"nodes": nodes.astype("<i8").tobytes(), "links": links.astype("<i4").tobytes()} for nodes, links in graph.layers]


SHARDS = "label string, shard int, rows binary, vectors binary, layers array<struct<nodes:binary,links:binary>>"
SHARDS_ARROW = pa.schema(
    [
        ("label", pa.string()),
        ("shard", pa.int32()),
        ("rows", pa.binary()),
        ("vectors", pa.binary()),
        ("layers", pa.list_(pa.struct([("nodes", pa.binary()), ("links", pa.binary())]))),
    ]
)


def _index(key: tuple, group: pa.Table) -> pa.Table:
    """A shard's unit vectors and graph in one row."""
    rows = group.column("row").to_numpy()
    order = np.argsort(rows)
    flat = group.column("vector").combine_chunks()
    vectors = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)[order]
    vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = SmallWorld.build(vectors, seed=1)
    made = {
        "label": key[0].as_py(),
        "shard": key[1].as_py(),
        "rows": rows[order].astype("<i8").tobytes(),
        "vectors": vectors.astype("<f8").tobytes(),
        "layers": _graph_bytes(graph),
    }
    return pa.Table.from_pylist([made], SHARDS_ARROW)


EDGES = "row long, n long, a long, b long"


def _product(least: float):
    def load(row: dict, side: str) -> tuple[np.ndarray, SmallWorld]:
        rows = np.frombuffer(row[f"rows_{side}"], "<i8")
        vectors = _unpack(row[f"vectors_{side}"], len(rows))
        layers = []
        for layer in row[f"layers_{side}"]:
            nodes = np.frombuffer(layer["nodes"], "<i8")
            layers.append((nodes, np.frombuffer(layer["links"], "<i4").reshape(len(nodes), -1)))
        graph = SmallWorld(vectors, layers)
        return rows, vectors, graph

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                rows_a, a, graph_a = load(row, "a")
                if row["shard_a"] == row["shard_b"]:
                    links = linked(graph_a, a, a, least)
                    np.fill_diagonal(links, False)
                    links |= links.T
                    x, y = np.nonzero(np.triu(links))
                    counts, names = links.sum(axis=1), rows_a
                    first, second = rows_a[x], rows_a[y]
                    kept = spanning_forest(x, y)
                else:
                    rows_b, b, graph_b = load(row, "b")
                    links = linked(graph_b, b, a, least) | linked(graph_a, a, b, least).T
                    x, y = np.nonzero(links)
                    counts, names = np.concatenate([links.sum(axis=1), links.sum(axis=0)]), np.concatenate([rows_a, rows_b])
                    first, second = rows_a[x], rows_b[y]
                    kept = spanning_forest(x, y + len(rows_a))
                some = counts > 0
                number = int(some.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*names[some].tolist(), *[None] * len(kept)], pa.int64()),
                        pa.array([*counts[some].tolist(), *[None] * len(kept)], pa.int64()),
                        pa.array([*[None] * number, *first[kept].tolist()], pa.int64()),
                        pa.array([*[None] * number, *second[kept].tolist()], pa.int64()),
                    ],
                    ["row", "n", "a", "b"],
                )

    return run


def near_duplicates(table: DataFrame, least: float = 0.93, shard: int = SHARD) -> DataFrame:
    """Per row of ``table`` (``vec_id``, ``embedding``, ``label``): ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors of one label (not null) with as many components are linked if their cosine is ``least`` or more. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest vec_id that links lead to, ``kept`` is vec_id = component_id. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, nor do rows with a null label. Repeated rows are vectors of their own. A
    row with a null vec_id links like any other; component_id is then the smallest of the others, and kept false. Other columns are ignored.
    """
    spark = table.sparkSession
    vector = F.col("embedding").cast("array<double>")
    rows = table.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("label").cast("string"), vector.alias("vector"))
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    rows = rows.withColumn("usable", F.coalesce(fine & F.col("label").isNotNull(), F.lit(False)))
    # scaled by the largest component first, so that no square overflows or vanishes
    scale = F.array_max(F.transform("vector", lambda v: F.abs(v)))
    rows = cut_lineage(rows.withColumn("vector", F.when(F.col("usable"), F.transform("vector", lambda v: v / scale))), "vectors")
    usable = rows.where("usable").withColumn("label", F.concat_ws("|", F.size("vector").cast("string"), "label"))
    sizes = usable.groupBy("label").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    dealt = usable.join(sizes, "label").withColumn("shard", F.pmod(F.xxhash64("row"), F.col("shards")).cast("int"))
    index = cut_lineage(dealt.select("label", "shard", "row", "vector").groupBy("label", "shard").applyInArrow(_index, SHARDS), "graphs")
    one = index.select("label", *[F.col(c).alias(f"{c}_a") for c in ("shard", "rows", "vectors", "layers")])
    other = index.select("label", *[F.col(c).alias(f"{c}_b") for c in ("shard", "rows", "vectors", "layers")])
    # every pair of a label's shards once; a row is one task's work
    pairs = one.join(other, "label").where("shard_a <= shard_b")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    found = cut_lineage(pairs.repartition(tasks, "label", "shard_a", "shard_b").mapInArrow(_product(least), EDGES), "links")
    numbers = found.where("row is not null").groupBy("row").agg(F.sum("n").alias("n"))
    groups = components(found.where("a is not null").select("a", "b"))
    named = rows.select("row", "vec_id").join(numbers, "row", "left").join(groups.withColumnRenamed("node", "row"), "row", "left")
    named = named.withColumn("component", F.coalesce("component", "row"))
    least_id = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return named.join(least_id, "component").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).alias("n_links"),
        "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
