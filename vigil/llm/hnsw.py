"""Embedding near-duplicates by hierarchical navigable small-world graphs, one per shard.

Vectors are dealt by id hash into shards of at most ``SHARD_ROWS``, and a graph is built over
each in one task: layers of links to near and diverse vectors, built in batches. Then every
vector queries every shard, block by block (``BLOCK_ROWS``). Before a block is searched, the
beam is widened until an audit passes: a fixed share of the block's own vectors and vectors
moved off the shard's members to about the threshold are searched for, and of the links that
comparing them with the whole shard shows a probe must be found at least ``RECALL`` on average. The
average is over probes, not links, and taken apart for both kinds of probes and for those whose
links fit in the beam, in the widest beam and in none, so that a large group, which is always found,
hides nothing missed elsewhere. A vector whose beam
holds links only is searched with a wider one, and beyond ``WIDEST`` compared with the
whole shard, so large groups of copies lose nothing. Every hit near the
threshold is verified by cosine in double precision. A unit takes its hits in pieces of about
``PIECE``, adds them to each vector's number of links and to a spanning forest, and drops them; counts and
forest leave it, never pairs, and the forests' union gives the components. Graphs are files in the
shared folder that the units open, so no index is shuffled; shards are bounded by bytes, too.

Equal vectors are one vector with a multiplicity, so copies are neither indexed nor queried
twice. Vectors of different lengths link with nothing of another length.

Null, empty and zero vectors and such with null or non-finite components link with nothing.
Rows that repeat an id count once (the smallest vector); rows with a null id are left out.
An empty table gives an empty result. Only the id and vector columns are read.
"""

from __future__ import annotations

import pickle  # of arrays that this module wrote itself, in the job's own folder
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import files
from vigil.llm.common import materialize
from vigil.llm.components import components
from vigil.session import scratch_path

LINKS, BUILD_BEAM, BEAM, WIDEST, EXPAND = 12, 48, 48, 768, 3
SHARD_ROWS, SHARDS, BLOCK_ROWS, RECALL, AUDIT = 65_536, 6, 16_384, 0.99, 512
SLACK = 1e-4  # of single precision, before the exact check
PIECE, SHARD_BYTES = 1 << 22, 256 << 20  # hits held at once; vectors of a shard, in both precisions


def _batched(graph: list[np.ndarray], x: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int, seen: np.ndarray, expand: int = EXPAND):
    """Beam search of one layer for a batch of queries in step: the beam's places and similarities.

    ``seen`` is scratch space, a zeroed matrix of queries by vectors; it is zeroed again behind.
    """
    n, rows = len(queries), np.arange(len(queries))[:, None]
    ids = np.full((n, beam), -1, np.int64)
    sims = np.full((n, beam), -2.0, np.float32)
    open_ = np.zeros((n, beam), bool)
    k = entry.shape[1]
    ids[:, :k] = entry
    sims[:, :k] = np.where(entry >= 0, np.matmul(x[entry], queries[:, :, None])[:, :, 0], -2.0)
    open_[:, :k] = entry >= 0
    touched = [(rows.repeat(k, 1)[entry >= 0], entry[entry >= 0])]
    seen[touched[0]] = 1
    active = np.arange(n)
    while len(active):
        r = np.arange(len(active))[:, None]
        rank = np.where(open_[active], sims[active], -3.0)
        pick = np.argpartition(-rank, expand - 1, axis=1)[:, :expand] if beam > expand else np.tile(np.arange(beam), (len(active), 1))
        good = rank[r, pick] > -2.0
        open_[active[:, None], pick] = False
        near = graph[np.where(good, ids[active[:, None], pick], 0)]
        near = np.where(good[:, :, None], near, -1).reshape(len(active), -1)
        a = np.broadcast_to(active[:, None], near.shape)
        fresh = (near >= 0) & (seen[a, near] == 0)
        order = np.broadcast_to(np.arange(2, near.shape[1] + 2, dtype=np.int16), near.shape)
        seen[a[fresh], near[fresh]] = order[fresh]
        fresh &= seen[a, near] == order  # a vector met twice in this step counts once
        touched.append((a[fresh], near[fresh]))
        sim = np.full(near.shape, -2.0, np.float32)
        sim[fresh] = np.einsum("ij,ij->i", x[near[fresh]], queries[a[fresh]])
        all_sims = np.concatenate((sims[active], sim), axis=1)
        top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        ids[active] = np.concatenate((ids[active], np.where(fresh, near, -1)), axis=1)[r, top]
        open_[active] = np.concatenate((open_[active], fresh), axis=1)[r, top]
        sims[active] = all_sims[r, top]
        active = active[open_[active].any(axis=1)]
    for t in touched:
        seen[t] = 0
    return ids, sims


def _diverse(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """For each row of candidates, up to ``most`` that are nearer to the row's vector than to
    any candidate taken before; what room is left goes to the nearest others."""
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    n, c = ids.shape
    v = x[ids]
    among = np.matmul(v, v.transpose(0, 2, 1))
    taken = np.zeros((n, c), bool)
    for j in range(c):
        ok = (ids[:, j] >= 0) & (taken.sum(axis=1) < most)
        taken[:, j] = ok & ~((among[:, j] > sims[:, j, None]) & taken).any(axis=1)
    rank = np.where(ids < 0, 2 * c + 1, np.where(taken, 0, c) + np.arange(c))
    first = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, first, 1)
    return out if out.shape[1] == most else np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def _link(graph: np.ndarray, x: np.ndarray, source: np.ndarray, target: np.ndarray) -> None:
    """Adds source as a neighbour of target; full rows keep a diverse choice."""
    order = np.lexsort((-np.einsum("ij,ij->i", x[source], x[target]), target))
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    width = min(int(count.max()), 2 * graph.shape[1])
    at = first[:, None] + np.arange(width)
    new = np.where(np.arange(width) < count[:, None], source[np.minimum(at, len(source) - 1)], -1)
    both = np.concatenate((graph[nodes], new), axis=1)
    full = (both >= 0).sum(axis=1) > graph.shape[1]
    slim = np.sort(both[~full], axis=1)[:, ::-1][:, :graph.shape[1]]
    graph[nodes[~full]] = slim
    if full.any():
        rows = both[full]
        sims = np.where(rows >= 0, np.matmul(x[rows], x[nodes[full]][:, :, None])[:, :, 0], -2.0)
        keep = np.argsort(-sims, axis=1, kind="stable")[:, :2 * graph.shape[1]]
        graph[nodes[full]] = _diverse(x, np.take_along_axis(rows, keep, 1), np.take_along_axis(sims, keep, 1), graph.shape[1])


@dataclass
class Graph:
    """A shard: unit vectors, exact vectors, ids, multiplicities and the layers' links."""
    ids: np.ndarray
    many: np.ndarray
    exact: np.ndarray
    x: np.ndarray
    layers: list[tuple[np.ndarray, np.ndarray]]  # members of a layer and their links (places among the members); the lowest holds all

    @staticmethod
    def build(ids: np.ndarray, many: np.ndarray, exact: np.ndarray, seed: int = 0) -> Graph:
        rnd = np.random.default_rng(seed)
        unit = exact / np.linalg.norm(exact, axis=1, keepdims=True)
        x = np.ascontiguousarray(unit, np.float32)
        height = np.minimum(rnd.exponential(1 / np.log(LINKS), len(ids)).astype(int), 6)
        height[rnd.integers(len(ids))] = 6  # something to enter by
        layers = []
        for level in range(int(height.max()), 0, -1):
            members = np.flatnonzero(height >= level)
            layers.append((members, _layer(np.ascontiguousarray(x[members]), rnd.permutation(len(members)), LINKS)))
        layers.append((np.arange(len(ids)), _layer(x, rnd.permutation(len(ids)), 2 * LINKS)))
        return Graph(ids, many, unit, x, layers)

    def packed(self) -> bytes:
        layers = [(m.astype(np.int32), links.astype(np.int32)) for m, links in self.layers]
        return pickle.dumps((self.ids, self.many, self.exact, layers), protocol=5)

    @staticmethod
    def unpacked(data: bytes) -> Graph:
        ids, many, exact, layers = pickle.loads(data)
        return Graph(ids, many, exact, exact.astype(np.float32), [(m.astype(np.int64), links.astype(np.int64)) for m, links in layers])

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and similarities of the beams, from the top layer down."""
        out_i, out_s = [], []
        step = max(16, min(512, (32 << 20) // max(1, 2 * len(self.x))))
        seen = np.zeros((step, len(self.x)), np.int16)
        for a in range(0, len(queries), step):
            q = queries[a:a + step]
            entry = np.zeros((len(q), 1), np.int64)  # the first member of the top layer
            above = None
            for members, links in self.layers:
                if above is not None:
                    entry = np.where(entry >= 0, np.searchsorted(members, above[entry]), -1)
                lowest = len(members) == len(self.x)
                width = beam if lowest else min(8, max(1, len(members)))
                space = seen[:len(q)] if lowest else np.zeros((len(q), len(members)), np.int16)
                base = self.x if lowest else self.x[members]
                entry, sims = _batched(links, base, q, entry[:, :width], min(width, max(1, len(members))), space)
                above = members
            out_i.append(entry)
            out_s.append(sims)
        return np.concatenate(out_i), np.concatenate(out_s)


def _layer(x: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Links of one layer, its members added in batches that double up to 512."""
    n = len(x)
    graph = np.full((n, most), -1, np.int64)
    done = 0
    seen = np.zeros((min(512, n), n), np.int16)
    while done < n:
        new = order[done:done + max(1, min(512, done or 64))]
        q = x[new]
        among = q @ q.T
        np.fill_diagonal(among, -2.0)
        k = min(most, len(new) - 1)
        ids, sims = np.empty((len(new), 0), np.int64), np.empty((len(new), 0), np.float32)
        if k > 0:
            top = np.argpartition(-among, k - 1, axis=1)[:, :k]
            ids, sims = new[top], np.take_along_axis(among, top, 1)
        if done:
            entry = np.broadcast_to(order[:min(done, 4)], (len(new), min(done, 4)))
            i, s = _batched(graph, x, q, entry, min(BUILD_BEAM, done), seen[:len(new)])
            ids, sims = np.concatenate((ids, i), axis=1), np.concatenate((sims, s), axis=1)
        if ids.shape[1]:
            chosen = _diverse(x, ids, sims, most // 2)
            graph[new, :chosen.shape[1]] = chosen
            have = chosen >= 0
            _link(graph, x, np.repeat(new, have.sum(axis=1)), chosen[have])
        done += len(new)
    return graph


def _hits(graph: Graph, queries: np.ndarray, threshold: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of ``(query, place, similarity)``: above the threshold, less slack, in single precision.
    A piece holds the hits of some queries, at most about ``PIECE``."""
    low = np.float32(threshold - SLACK)
    todo = np.arange(len(queries))
    while len(todo) and beam < min(WIDEST, len(graph.x)):
        ids, sims = graph.search(queries[todo], beam)
        hit = (sims >= low) & (ids >= 0)
        full = hit.all(axis=1)
        r, c = np.nonzero(hit & ~full[:, None])
        yield todo[r], ids[r, c], sims[r, c]
        todo, beam = todo[full], 4 * beam
    step = max(1, PIECE // max(1, len(graph.x)))
    for a in range(0, len(todo), step):  # what only a scan answers wholly
        sims = queries[todo[a:a + step]] @ graph.x.T
        r, c = np.nonzero(sims >= low)
        yield todo[a:a + step][r], c, sims[r, c]


def audited_beam(graph: Graph, queries: np.ndarray, threshold: float, recall: float = RECALL, audit: int = AUDIT, seed: int = 1,
                 ids: np.ndarray | None = None) -> tuple[int, float]:
    """The narrowest beam, doubled from ``BEAM`` on, that passes the audit, and its recall: the
    lowest of the classes' mean recalls per probe. With the queries' ``ids``, a vector's link to itself counts nothing."""
    rnd = np.random.default_rng(seed)
    picked = rnd.permutation(len(queries))[:audit]
    some = queries[picked]
    member = graph.x[rnd.permutation(len(graph.x))[:audit]]
    noise = rnd.standard_normal(member.shape).astype(np.float32)
    noise -= (noise * member).sum(axis=1, keepdims=True) * member
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-9)
    near = (threshold + (1 - threshold) * rnd.random(len(member), np.float32))[:, None]
    probes = np.concatenate((some, near * member + np.sqrt(1 - near * near) * noise)).astype(np.float32)
    low = np.float32(threshold - SLACK)
    truth = np.empty((len(probes), len(graph.x)), bool)
    for a in range(0, len(probes), 256):
        truth[a:a + 256] = probes[a:a + 256] @ graph.x.T >= low
    if ids is not None:
        truth[:len(some)] &= ids[picked][:, None] != graph.ids
    want, moved, beam = truth.sum(axis=1), np.arange(len(probes)) >= len(some), BEAM
    while True:
        got = np.empty(len(probes))
        for a in range(0, len(probes), 256):
            some_got = np.zeros(len(probes[a:a + 256]))
            for q, p, _ in _hits(graph, probes[a:a + 256], threshold, beam):
                some_got += np.bincount(q, truth[q + a, p], minlength=len(some_got))
            got[a:a + 256] = some_got
        # each probe counts alike, and large groups, always found, speak for no small ones
        size = np.searchsorted([beam, WIDEST], want)
        classes = [(moved == m) & (size == k) & (want > 0) for m in (False, True) for k in range(3)]
        least = min((float((got[c] / want[c]).mean()) for c in classes if c.any()), default=1.0)
        if least >= recall or beam >= min(WIDEST, len(graph.x)):
            return beam, least
        beam *= 2


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _build(folder: str):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids = table.column("id").to_numpy()
        graph = Graph.build(ids, table.column("many").to_numpy(), _matrix(table.column("v")), seed=int(ids[0]) & 0xFFFF)
        uri = files.fresh(folder, "graph", ".bin")
        files.write(uri, [graph.packed()])
        return pa.table({"shard": table.column("shard")[:1], "uri": pa.array([uri])})
    return run


def _roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    x = parent[x]
    while not np.array_equal(up := parent[x], x):
        x = up
    return x


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the trees of each pair under the smaller root."""
    while len(a):
        x, y = _roots(parent, a), _roots(parent, b)
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        pairs = np.unique(np.maximum(x, y) * len(parent) + np.minimum(x, y))  # many links join the same two trees
        np.minimum.at(parent, pairs // len(parent), pairs % len(parent))


def _query(threshold: float):
    def run(block: pa.Table, shard: pa.Table) -> pa.Table:
        out = {"id": [], "n_links": [], "tied": [], "beam": [], "recall": []}
        if block.num_rows and shard.num_rows:
            system, path = files.opened(shard.column("uri")[0].as_py())
            with system.open_input_file(path) as f:
                graph = Graph.unpacked(f.read())
            block = block.sort_by("id")
            ids, exact = block.column("id").to_numpy(), _matrix(block.column("v"))
            exact /= np.linalg.norm(exact, axis=1, keepdims=True)
            queries = exact.astype(np.float32)
            beam, recall = audited_beam(graph, queries, threshold, ids=ids)
            links = np.zeros(len(ids), np.int64)
            # a spanning forest of what is linked: queries first, then the shard's members
            parent = np.arange(len(ids) + len(graph.ids))
            for a in range(0, len(queries), 1024):
                for q, p, s in _hits(graph, queries[a:a + 1024], threshold, beam):
                    q = q + a
                    near = np.flatnonzero(s < threshold + SLACK)  # single precision doesn't decide
                    sure = np.ones(len(q), bool)
                    for n in np.array_split(near, len(near) // (1 << 16) + 1):
                        sure[n] = np.einsum("ij,ij->i", exact[q[n]], graph.exact[p[n]]) >= threshold
                    sure &= ids[q] != graph.ids[p]
                    q, p = q[sure], p[sure]
                    links += np.bincount(q, graph.many[p], minlength=len(ids)).astype(np.int64)
                    _join(parent, q, p + len(ids))
            tied_to = _roots(parent, parent)
            met = np.flatnonzero(tied_to != np.arange(len(parent)))
            names = np.concatenate((ids, graph.ids))
            out = {"id": np.concatenate((ids, names[met])), "n_links": np.concatenate((links, np.zeros(len(met), np.int64))),
                   "tied": np.concatenate((ids, names[tied_to[met]])), "beam": np.full(len(ids) + len(met), beam), "recall": np.full(len(ids) + len(met), recall)}
        kinds = {"id": pa.int64(), "n_links": pa.int64(), "tied": pa.int64(), "beam": pa.int32(), "recall": pa.float64()}
        return pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()})
    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding", shards: int = SHARDS,
                    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``id, n_links, component_id, kept, beam, recall``: the widest beam and the lowest audited recall a vector met."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id is not null")
    rows = materialize(rows.groupBy("id").agg(F.min("v").alias("v")), "vectors")
    sound = F.coalesce(F.forall("v", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))) & F.exists("v", lambda c: c != 0), F.lit(False))
    classes = rows.where(sound).groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("many"))
    classes = materialize(classes.select(F.col("rep").alias("id"), "many", "v"), "classes")
    n = classes.count()
    size = classes.agg(F.sum(F.size("v").cast("long") * 12)).first()[0] or 0
    shards = max(shards, -(-n // shard_rows), -(-size // SHARD_BYTES))
    blocks = max(1, -(-n // block_rows), -(-size // SHARD_BYTES))
    dealt = classes.withColumn("shard", F.xxhash64(F.size("v"), F.pmod(F.xxhash64("id"), F.lit(shards))))
    folder = scratch_path(rows.sparkSession, "graphs")
    graphs = materialize(dealt.groupBy("shard").applyInArrow(_build(folder), "shard long, uri string"), "graphs")
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks))
    asked = classes.withColumn("block", block).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn(
        "shard", F.xxhash64(F.size("v"), F.col("s").cast("long")))
    sent = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    found = asked.select("shard", "block", "id", "v").groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInArrow(
        _query(threshold), "id long, n_links long, tied long, beam int, recall double")
    found = materialize(found, "found")
    comp = components(found.select(F.col("id").alias("src"), F.col("tied").alias("dst")))
    links = found.groupBy("id").agg(F.sum("n_links").alias("n"), F.max("beam").alias("beam"), F.min("recall").alias("recall"))
    per_class = classes.select("id", "many", "v").join(links, "id", "left").join(comp.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("v"), (F.col("n") + F.col("many") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"), "beam", "recall")
    out = rows.join(per_class, "v", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"), "beam", "recall")
    return out.withColumn("kept", F.col("id") == F.col("component_id"))
