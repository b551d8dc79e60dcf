"""Near-duplicate vectors by hierarchical navigable small-world graphs, one a shard.

Equal vectors become one. The distinct ones are dealt into shards by a hash, so a large group of near copies is spread over all of them. A shard's
graph has layers: each vector stands in the lowest, and by its hash in ever sparser upper ones; in a layer it is linked with near vectors that are not nearer to
each other than to it. A search goes down the layers with a beam, and in the lowest one then floods all vectors that are near enough, however many they are.

After building, each shard is audited: members drawn by hash are compared with the whole shard, and the beam is doubled until the graph finds the share of
their links that is asked for; where the widest beam does not do, the graph is built anew
with more links. Then every vector queries every shard: of two shards the vectors of the
later one query the earlier one, and of one shard each vector the earlier ones, so a pair is met once and counts for both.
Every pair found is verified in double precision. A task returns counts and a spanning forest of its links, never the pairs, and the forests are united by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.llm.memory import mapped
from docketlake.llm.words import mix
from docketlake.operators.components import connected_components
from docketlake.session import ship, written


@dataclass(frozen=True)
class Settings:
    """Least cosine; vectors a shard; links of a vector in upper layers (twice as many in the lowest); beam when building; first and widest beam of the audit; members
    audited a shard; share of their links to be found; how far below the least cosine the flood still goes on."""

    cosine: float = 0.9
    shard: int = 32_768
    links: int = 12
    build_beam: int = 40
    beam: int = 32
    widest: int = 256
    audited: int = 1024
    recall: float = 0.999
    slack: float = 0.05


#: Vectors that are inserted, or searched for, at once.
BATCH = 256


class Graph:
    """Layers of links over the rows of ``x``, unit vectors. links[l][i] are the neighbours of row i in layer l, -1 where none; rows are in order of
    falling layers, so layer l has the first sizes[l] rows."""

    def __init__(self, x: np.ndarray, links: list[np.ndarray]):
        self.x, self.links = np.ascontiguousarray(x, dtype=np.float32), links
        self.sizes = [len(k) for k in links]
        self.back: tuple[np.ndarray, np.ndarray] | None = None

    def around(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``rows``, neighbour) of links in the lowest layer from and to rows: a full list may have dropped a row that has its owner in its own."""
        links = self.links[0]
        if self.back is None:
            source, _ = np.nonzero(links >= 0)
            target = links[links >= 0]
            self.back = source[np.argsort(target, kind="stable")].astype(np.int32), np.append(0, np.cumsum(np.bincount(target, minlength=len(links))))
        source, first = self.back
        at, col = np.nonzero(links[rows] >= 0)
        counts = first[rows + 1] - first[rows]
        place = np.arange(counts.sum()) + np.repeat(first[rows] - np.cumsum(counts) + counts, counts)
        return np.append(at, np.repeat(np.arange(len(rows)), counts)), np.append(links[rows[at], col], source[place])

    def beam(self, layer: int, q: np.ndarray, start: np.ndarray, width: int, seen: np.ndarray | None = None, floor: float = 2.0, spread: int = 4):
        """The ``width`` likest rows found of a layer for each query, and their cosines, falling, from ``start`` (a row of rows a query, -1 where none).
        Also all (query, row, cosine) met with a cosine of ``floor`` or more. ``seen`` is marked with what was met."""
        n = self.sizes[layer]
        seen = np.zeros((len(q), n), dtype=bool) if seen is None else seen
        ids, sims, done = np.full((len(q), width), -1, dtype=np.int32), np.full((len(q), width), -2, dtype=np.float32), np.ones((len(q), width), dtype=bool)
        hits, active, fresh = [], np.arange(len(q)), start
        while len(active):
            # what is new, each row once a query
            fresh = np.sort(fresh, axis=1)
            new = fresh >= 0
            new[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
            new &= ~seen[active[:, None], np.maximum(fresh, 0)]
            at, col = np.nonzero(new)
            rows = fresh[at, col]
            seen[active[at], rows] = True
            got = np.full(fresh.shape, -2, dtype=np.float32)
            got[at, col] = np.einsum("ij,ij->i", q[active[at]], self.x[rows])
            if floor < 2 and (near := got[at, col] >= floor).any():
                hits.append((active[at[near]], rows[near], got[at, col][near]))
            # into the beam
            every = np.concatenate([sims[active], got], axis=1)
            order = np.argsort(-every, axis=1, kind="stable")[:, :width]
            sims[active] = np.take_along_axis(every, order, 1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], np.where(new, fresh, -1)], axis=1), order, 1)
            done[active] = np.take_along_axis(np.concatenate([done[active], ~new], axis=1), order, 1)
            # the likest that were not gone from yet
            open_ = ~done[active]
            active, open_ = active[open_.any(axis=1)], open_[open_.any(axis=1)]
            chosen = open_ & (np.cumsum(open_, axis=1) <= spread)
            at, col = np.nonzero(chosen)
            done[active[at], col] = True
            place = np.cumsum(chosen, axis=1)[at, col] - 1
            near = np.full((len(active), spread, self.links[layer].shape[1]), -1, dtype=np.int32)
            near[at, place] = self.links[layer][ids[active[at], col]]
            fresh = near.reshape(len(active), near.shape[1] * near.shape[2])
        return ids, sims, hits

    def descend(self, q: np.ndarray, to: int, width: int) -> np.ndarray:
        """Where to start in layer ``to``: the likest rows of the layers above."""
        start = np.zeros((len(q), 1), dtype=np.int32)
        for layer in range(len(self.links) - 1, to, -1):
            start = self.beam(layer, q, start, width)[0]
        return start

    def near(self, q: np.ndarray, width: int, least: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all rows found with a cosine of ``least`` or more in single precision, by a beam and then a flood from what is near."""
        seen = np.zeros((len(q), len(self.x)), dtype=bool)
        _, _, hits = self.beam(0, q, self.descend(q, 0, max(4, width // 8)), width, seen, least - slack)
        found, front = [], hits
        while front:
            at, rows, sims = (np.concatenate(c) for c in zip(*front, strict=True))
            found.append((at[sims >= least], rows[sims >= least]))
            place, k = self.around(rows)
            a = at[place]
            new = ~seen[a, k]
            code = np.unique(a[new].astype(np.int64) * len(self.x) + k[new])
            a, k = code // len(self.x), code % len(self.x)
            seen[a, k] = True
            front = []
            for i in range(0, len(a), 1 << 16):
                sims = np.einsum("ij,ij->i", q[a[i : i + (1 << 16)]], self.x[k[i : i + (1 << 16)]])
                keep = sims >= least - slack
                if keep.any():
                    front.append((a[i : i + (1 << 16)][keep], k[i : i + (1 << 16)][keep], sims[keep]))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))


def _select(x: np.ndarray, own: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of candidates (falling by cosine, -1 where none) those not nearer to one chosen before than to the row itself; free places go to the likest others."""
    given = np.maximum(ids, 0)
    between = np.matmul(x[given], x[given].transpose(0, 2, 1))
    valid = (ids >= 0) & (ids != own[:, None])
    taken = np.zeros(ids.shape, dtype=bool)
    for j in range(ids.shape[1]):
        rivals = (taken[:, :j] & (between[:, j, :j] > sims[:, j : j + 1])).any(axis=1)
        taken[:, j] = valid[:, j] & ~rivals & (taken.sum(axis=1) < most)
    order = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
    chosen = np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(ids, order, 1), -1)
    if chosen.shape[1] < most:
        chosen = np.pad(chosen, ((0, 0), (0, most - chosen.shape[1])), constant_values=-1)
    return chosen.astype(np.int32)


def _likest(x: np.ndarray, own: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of each row, each once, by falling cosine."""
    ids = np.sort(ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    ids[ids == own[:, None]] = -1
    sims = np.where(ids >= 0, np.einsum("ij,ikj->ik", x[own], x[np.maximum(ids, 0)]), np.float32(-2))
    order = np.argsort(-sims, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _add_back(graph: Graph, layer: int, rows: np.ndarray, most: int) -> None:
    """Links from the neighbours of new rows back to these; a full list is chosen anew from its own and the new ones."""
    to = graph.links[layer][rows]
    at, col = np.nonzero(to >= 0)
    target, source = to[at, col], rows[at]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
    for i in range(0, len(nodes), 512):
        own, room = nodes[i : i + 512], int(counts[i : i + 512].max())
        more = np.full((len(own), room), -1, dtype=np.int32)
        which = np.repeat(np.arange(len(own)), counts[i : i + 512])
        place = np.arange(len(which)) - np.repeat(np.cumsum(counts[i : i + 512]) - counts[i : i + 512], counts[i : i + 512])
        more[which, place] = source[first[i] : first[i] + len(which)]
        ids, sims = _likest(graph.x, own, np.concatenate([graph.links[layer][own], more], axis=1), 3 * most)
        graph.links[layer][own] = _select(graph.x, own, ids, sims, most)


def layers(hashes: np.ndarray, links: int) -> np.ndarray:
    """The uppermost layer of each vector, by its hash: one in ``links`` goes up from each layer."""
    unit = (mix(hashes.view(np.uint64)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.floor(-np.log(np.maximum(unit, 1e-18)) / np.log(links)).astype(np.int64)


def build(x: np.ndarray, top: np.ndarray, s: Settings) -> Graph:
    """The graph of unit vectors given in order of falling layers ``top``. Batches grow with what is there; rows of a batch are compared with each other."""
    x = np.ascontiguousarray(x, dtype=np.float32)
    graph = Graph(x, [])
    for layer in range(int(top.max(initial=0)), -1, -1):
        size, most = int((top >= layer).sum()), s.links * (1 if layer else 2)
        graph.links.insert(0, np.full((size, most), -1, dtype=np.int32))
        graph.sizes.insert(0, size)
        at = 0
        while at < size:
            to = min(size, at + max(1, min(BATCH, at)))
            rows, q = np.arange(at, to), x[at:to]
            ids = np.empty((len(rows), 0), dtype=np.int32)
            if at:
                start = graph.descend(q, 0, 8)
                start = np.where(start < at, start, -1)  # upper rows that are not in this layer yet
                start[(start < 0).all(axis=1), 0] = 0
                ids = graph.beam(0, q, start, s.build_beam)[0]
            each = min(len(rows) - 1, s.build_beam // 2)
            if each:
                same = q @ q.T
                np.fill_diagonal(same, -2)
                ids = np.concatenate([ids, (at + np.argpartition(-same, each - 1, axis=1)[:, :each]).astype(np.int32)], axis=1)
            if ids.shape[1]:
                ids, sims = _likest(x, rows, ids, s.build_beam)
                graph.links[0][rows] = _select(x, rows, ids, sims, most)
                _add_back(graph, 0, rows, most)
            at = to
    return graph


def audit(graph: Graph, members: np.ndarray, s: Settings) -> tuple[int, int, int]:
    """The beam that finds the share of the members' links asked for, their links in the shard, and those found with that beam."""
    links, found = 0, 0
    exact = []
    for i in range(0, len(members), BATCH):
        near = graph.x[members[i : i + BATCH]] @ graph.x.T >= s.cosine
        near[np.arange(len(near)), members[i : i + BATCH]] = False
        links += int(near.sum())
        exact.append(near)
    beam = s.beam
    while True:
        found = 0
        for i, near in zip(range(0, len(members), BATCH), exact, strict=True):
            at, rows = graph.near(graph.x[members[i : i + BATCH]], beam, s.cosine, s.slack)
            found += int(near[at, rows].sum())
        if found >= s.recall * links or beam >= s.widest:
            return beam, links, found
        beam *= 2


def _packed(arrays: list[np.ndarray]) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.RecordBatch.from_arrays([pa.array([a.tobytes() for a in arrays], pa.large_binary()), pa.array([str(a.dtype) for a in arrays]), pa.array([list(a.shape) for a in arrays])], ["data", "dtype", "shape"])
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_batch(table)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> list[np.ndarray]:
    table = pa.ipc.open_stream(blob).read_all()
    return [np.frombuffer(b.as_buffer(), dtype=t.as_py()).reshape(n.as_py()) for b, t, n in zip(table["data"], table["dtype"], table["shape"], strict=True)]


def _vectors(lists: pa.ChunkedArray | pa.ListArray) -> np.ndarray:
    """Doubles, a row a list; shorter ones are followed by zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), int(sizes.max(initial=0))))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
    return out


def _units(v: np.ndarray) -> np.ndarray:
    """Of length one; large and small numbers do not overflow or vanish on the way."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _built(s: Settings):
    def run(key, rows):
        rep, key_, weight = (rows[c].to_numpy() for c in ("rep", "key", "weight"))
        top = layers(key_, s.links)
        order = np.lexsort((rep, key_, -top))
        rep, key_, weight, top, x = rep[order], key_[order], weight[order], top[order], _units(_vectors(rows["v"])[order])
        members = np.argsort(mix(key_.view(np.uint64)))[: s.audited]
        for times in (1, 2, 4):  # the widest beam may not do: then more links
            graph = build(x, top, replace(s, links=times * s.links, build_beam=times * s.build_beam))
            beam, links, found = audit(graph, members, s)
            if found >= s.recall * links:
                break
        blob = _packed([rep, key_, weight, x, *graph.links])
        return pa.table({"shard": [key[0].as_py()], "graph": pa.array([blob], pa.binary()), "beam": [beam], "audited_links": [links], "found_links": [found]})

    return run


class _Cell:
    """A shard's graph, queried by the vectors of one shard. Counts and a spanning forest stay, not the pairs."""

    def __init__(self, blob: bytes, beam: int, own: bool, s: Settings):
        self.rep, self.key, self.weight, self.x, *links = _unpacked(blob)
        self.graph, self.beam, self.own, self.s = Graph(self.x, links), beam, own, s
        self.place = {k: i for i, k in enumerate(zip(self.rep.tolist(), self.key.tolist(), strict=True))} if own else {}
        self.links = np.zeros(len(self.rep), dtype=np.int64)
        self.root = self.rep.copy()

    def query(self, rep: np.ndarray, key: np.ndarray, weight: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Links of the queries to the shard's vectors, which get theirs added; in their own shard, to those before them."""
        counts = np.zeros(len(rep), dtype=np.int64)
        if self.x.shape[1] != x.shape[1]:  # lengths differ between shards
            wide = max(self.x.shape[1], x.shape[1])
            self.x, x = (np.pad(y, ((0, 0), (0, wide - y.shape[1]))) for y in (self.x, x))
            self.graph = Graph(self.x, self.graph.links)
        own = np.array([self.place[k] for k in zip(rep.tolist(), key.tolist(), strict=True)], dtype=np.int64) if self.own else None
        for i in range(0, len(rep), BATCH):
            q = x[i : i + BATCH]
            at, rows = self.graph.near(q.astype(np.float32), self.beam, self.s.cosine - 1e-4, self.s.slack)
            if self.own:
                keep = rows < own[i + at]
                at, rows = at[keep], rows[keep]
            sure = np.concatenate([np.empty(0, bool), *(np.einsum("ij,ij->i", q[at[j : j + (1 << 16)]], self.x[rows[j : j + (1 << 16)]]) >= self.s.cosine for j in range(0, len(at), 1 << 16))])
            at, rows = at[sure], rows[sure]
            counts[i : i + len(q)] += np.bincount(at, self.weight[rows], len(q)).astype(np.int64)
            self.links += np.bincount(rows, weight[i + at], len(self.rep)).astype(np.int64)
            self._unite(rep[i : i + BATCH], own[i : i + BATCH] if self.own else None, at, rows)
        return counts

    def _unite(self, rep: np.ndarray, own: np.ndarray | None, at: np.ndarray, rows: np.ndarray) -> None:
        """Each query's neighbours, and it, get one root: the smallest. What roots became is kept as links in ``forest``."""
        order = np.argsort(at, kind="stable")
        at, rows = at[order], rows[order]
        bounds = np.flatnonzero(np.diff(at, prepend=-1, append=-1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            roots = np.unique(self.root[rows[a:b]])
            mine = int(self.root[own[at[a]]]) if own is not None else int(rep[at[a]])
            least = min(int(roots[0]), mine)
            self.forest.append((mine, least))
            for r in roots:
                if r != least:
                    self.root[self.root == r] = least
                    self.forest.append((int(r), least))
            if own is not None and mine != least:
                self.root[self.root == mine] = least

    @property
    def forest(self) -> list[tuple[int, int]]:
        if not hasattr(self, "_forest"):
            self._forest: list[tuple[int, int]] = []
        return self._forest

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
        at = np.flatnonzero(self.links)
        edges, self._forest = sorted({e for e in self.forest if e[0] != e[1]}), []
        return self.rep[at], self.key[at], self.links[at], edges


_FOUND = "rep long, key long, links long, other long"


def _queried(s: Settings):
    """Rows come by cell, the cell's graph before its queries."""

    def out(rep=(), key=(), links=(), other=()) -> pa.RecordBatch:
        n = len(rep)
        full = lambda c: pa.array(c, pa.int64()) if len(c) else pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), full(key), full(links), full(other)], ["rep", "key", "links", "other"])

    def ended(cell: _Cell) -> Iterator[pa.RecordBatch]:
        rep, key, links, edges = cell.result()
        if len(rep):
            yield out(rep, key, links)
        if edges:
            yield out([a for a, _ in edges], other=[b for _, b in edges])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = None
        for batch in batches:
            graphs = batch.column("graph")
            starts = np.flatnonzero(~graphs.is_null().to_numpy(zero_copy_only=False)).tolist()
            bounds = sorted({0, *starts, *(i + 1 for i in starts), batch.num_rows})
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                part = batch.slice(a, b - a)
                if a in starts:
                    if cell:
                        yield from ended(cell)
                    cell = _Cell(part.column("graph")[0].as_buffer(), part.column("beam")[0].as_py(), part.column("later")[0] == part.column("earlier")[0], s)
                else:
                    rep, key, weight = (part.column(c).to_numpy() for c in ("rep", "key", "weight"))
                    counts = cell.query(rep, key, weight, _units(_vectors(part.column("v"))))
                    if (has := np.flatnonzero(counts)).size:
                        yield out(rep[has], key[has], counts[has])
        if cell:
            yield from ended(cell)

    return run


@dataclass(frozen=True)
class Found:
    """links: one row a vector given; recall: a row a shard (shard, beam, audited_links, found_links)."""

    links: DataFrame
    recall: DataFrame


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings | None = None) -> Found:
    """vec_id, n_links (other vectors linked directly), component_id (smallest id reachable, itself included), kept (vec_id = component_id).

    Rows are vectors: repeated rows are linked with each other, and rows of one id are in one component. Vectors that are null, empty, all zeros, or hold null or
    non-finite components link with nothing, as do rows with a null id, which have a null component and are kept. Vectors of other lengths count as if
    zeros followed them. An empty table gives no rows. Other columns are left out, whatever their names.
    """
    s = settings or Settings()
    spark = vectors.sparkSession
    ship(spark)
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    sound = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    given = written(given.withColumn("digest", F.when(sound, F.sha2(F.col("v").cast("string"), 256))), "vectors")
    distinct = given.where("digest is not null").groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("v").alias("v"))
    distinct = written(distinct.withColumn("key", F.xxhash64("digest")), "distinct")
    n = max(1, -(-distinct.count() // s.shard))
    dealt = distinct.select("rep", "key", "weight", "v", F.pmod(F.xxhash64("key", F.lit(n)), F.lit(n)).cast("long").alias("shard"))
    graphs = written(dealt.groupBy("shard").applyInArrow(_built(s), "shard long, graph binary, beam long, audited_links long, found_links long"), "graphs")
    # a cell is an earlier shard's graph and the vectors of a later one, or its own
    served = graphs.select(F.explode(F.sequence("shard", F.lit(n - 1).cast("long"))).alias("later"), F.col("shard").alias("earlier"), "graph", "beam")
    asking = dealt.select(F.col("shard").alias("later"), F.explode(F.sequence(F.lit(0).cast("long"), "shard")).alias("earlier"), "rep", "key", "weight", "v")
    cells = asking.unionByName(served, allowMissingColumns=True).repartition(n * (n + 1) // 2, "later", "earlier").sortWithinPartitions("later", "earlier", F.desc_nulls_last("beam"))
    found = written(cells.transform(mapped, _queried(s), _FOUND), "found")
    counts = found.where("other is null").groupBy("rep", "key").agg(F.sum("links").alias("links"))
    ids = given.where("digest is not null").join(distinct.select("digest", "rep", "key", "weight"), "digest")
    same = ids.where("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    components = written(connected_components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")).unionByName(same)), "components")
    told = distinct.join(counts, ["rep", "key"], "left").select("digest", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = given.drop("v").join(told, "digest", "left").join(components, F.col("vec_id") == F.col("node"), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return Found(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))), graphs.drop("graph"))
