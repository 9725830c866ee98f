"""Centroid clustering (Lloyd's rounds, exact in integers) with geometric drift tightening.

Each vector holds an upper bound of the distance to its own centroid and a lower bound of that to any
other. When centroids move, the upper bound grows by its centroid's drift. The lower bound need not
shrink by the largest drift: the vectors of cluster i lie in a sphere around its old centroid m, and
for x in it, and a centroid that moves from c to c' by p,

    |x - c| - |x - c'|  <=  p * max(0, cos(angle at (c + c') / 2 between x and the direction c' - c)),

since the points where the left side is 2a form a branch of a hyperbola with foci c and c', which lies within
its asymptotes, whose angle to the axis has the cosine 2a / p. In the plane through m, c and c' the
sphere is a disc, seen from that middle point under asin(radius / distance) to either side, so the
largest cosine is found by one subtraction of angles (``loosening``). A centroid that moves away
from, or across, a cluster loosens its bounds by little or nothing. Vectors whose bounds no longer
decide are checked, first against their own centroid, then scanned against all, in integers.

Vectors are written once, as integers, to shards: raw files that are read in blocks, and only where a block has an
ambiguous vector. Clusters and bounds are a small table of one row per shard, rewritten each round
in the shared folder; nothing is shuffled but that. Sums are kept by what moves between clusters: the driver gets
one row per cluster. A lost executor costs its tasks: shards are named by the written table only.

Defined results: vectors that are null, of another length, or hold null or non-finite components are left out.
Ties go to the smaller centroid. Empty centroids stay. Repeated rows count as often as they occur. Vectors without an id are
clustered like others, and start as centroids only after all others. With fewer vectors than
centroids there are fewer centroids; an empty table gives an empty result. Components beyond 2**27 (after scaling)
raise an error, as squared distances would not fit in a long. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import files
from vigil.llm.common import materialize, partitions_for, small_batches
from vigil.session import scratch_path

DIM, K, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
SHARD_BYTES, BLOCK_ROWS = 16 << 20, 1024
LIMIT, EXACT = 1 << 27, 1 << 22  # beyond LIMIT no long; below EXACT products of doubles add up exactly
_STATE = ("uri string, n long, cluster binary, upper binary, lower binary, checked long, scanned long, "
          "moved array<struct<cluster:int,radius:double,totals:array<long>>>")


@dataclass(frozen=True)
class Step:
    """What a pass over the shards needs to know; ``old`` is None in the first."""
    new: np.ndarray
    old: np.ndarray | None = None
    radius: np.ndarray | None = None


def usable(vectors: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.where(x.isNotNull() & (F.size(x) == dim)).where(~bad)
    return rows.select(F.col(id_col).cast("long").alias("id"), x.cast("array<double>").alias("vector"))


def starts(rows: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    """The components of the ``k`` vectors whose ids have the smallest hashes."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = rows.orderBy(F.asc_nulls_last(h), "vector").limit(k).select("vector").collect()
    return np.floor(scale * np.array([r.vector for r in first])).astype(np.int64)


# --- shards --------------------------------------------------------------------------------------

def write_shards(rows: DataFrame, dim: int, scale: int, folder: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``uri, n`` of each written shard: n x dim components, then ids, then whether an id is missing."""
    per_shard = max(1, shard_bytes // (4 * dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            parts = [np.concatenate(p) for p in zip(*held)]
            uri = files.fresh(folder, "shard", ".bin")
            files.write(uri, [parts[0].astype("<i4").tobytes(), parts[1].astype("<i8").tobytes(), parts[2].astype("u1").tobytes()])
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(parts[0])], pa.int64())], ["uri", "n"])

        size = 0
        for b in batches:
            ids = b.column("id")
            raw = np.floor(scale * b.column("vector").flatten().to_numpy(zero_copy_only=False)).reshape(-1, dim)
            if raw.size and np.abs(raw).max() > LIMIT:
                raise OverflowError("a component is too large: squared distances would not fit in a long")
            whole = (raw.astype(np.int32), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
            at = 0
            while at < len(raw):
                take = min(per_shard - size, len(raw) - at)
                held.append(tuple(a[at:at + take] for a in whole))
                size, at = size + take, at + take
                if size == per_shard:
                    yield close()
                    held, size = [], 0
        if size:
            yield close()

    return materialize(rows.mapInArrow(run, "uri string, n long"), "shards")


def _blocks(handle, n: int, dim: int, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, their vectors)`` of the wanted rows (sorted), block by block."""
    for block in np.split(wanted, np.flatnonzero(np.diff(wanted // BLOCK_ROWS)) + 1):
        first = int(block[0]) // BLOCK_ROWS * BLOCK_ROWS
        rows = min(BLOCK_ROWS, n - first)
        handle.seek(first * dim * 4)
        data = np.frombuffer(handle.read(rows * dim * 4), "<i4").reshape(rows, dim)
        yield block, data[block - first].astype(np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all of ``c`` (int64)."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < EXACT and x.shape[1] * EXACT < 1 << 31:
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return ((xf * xf).sum(axis=1)[:, None] - 2 * (xf @ cf.T) + (cf * cf).sum(axis=1)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


# --- bounds --------------------------------------------------------------------------------------

def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """``[i, j]``: by how much the distance to centroid j can have shrunk for any vector of cluster i."""
    a, b = old.astype(np.float64), new.astype(np.float64)
    move, middle = b - a, (a + b) / 2
    drift = np.linalg.norm(move, axis=1)
    to = a[:, None, :] - middle[None]  # from j's middle to i's old centroid
    away = np.linalg.norm(to, axis=2)
    with np.errstate(divide="ignore", invalid="ignore"):
        cos = np.clip(np.einsum("ijd,jd->ij", to, move) / (away * drift), -1, 1)
        sin_disc = radius[:, None] / away
    angle = np.arccos(np.nan_to_num(cos, nan=1.0)) - np.arcsin(np.clip(np.nan_to_num(sin_disc, nan=1.0), 0, 1))
    share = np.maximum(0, np.cos(np.maximum(0, angle)))
    share[~(radius[:, None] < away)] = 1  # the middle point is in the sphere
    return drift * np.minimum(1, share + 1e-6)  # the angles' rounding


def _decided(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    return upper * (1 + 1e-9) + 1e-4 < lower


def _nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (the smaller number of equals), its distance, and the next one's."""
    d = squared(x, centroids)
    own = d.argmin(axis=1)
    best = d[np.arange(len(d)), own]
    d[np.arange(len(d)), own] = np.iinfo(np.int64).max
    return own, np.sqrt(best), np.sqrt(d.min(axis=1))


def _assign(step: Step, dim: int):
    k = len(step.new)
    if step.old is not None:
        shrunk = loosening(step.old, step.new, step.radius)
        np.fill_diagonal(shrunk, 0)
        grown, shrunk = np.linalg.norm((step.new - step.old).astype(np.float64), axis=1), shrunk.max(axis=1)

    def shard(uri: str, n: int, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> dict:
        totals, scanned = {}, 0

        def add(c: np.ndarray, x: np.ndarray, sign: int) -> None:
            for i in np.unique(c):
                some = x[c == i]
                totals[i] = totals.get(i, 0) + sign * np.append(some.sum(axis=0), len(some))

        if step.old is None:
            wanted = np.arange(n)
        else:
            upper, lower = upper + grown[cluster], lower - shrunk[cluster]
            wanted = np.flatnonzero(~_decided(upper, lower))
        if len(wanted):
            system, path = files.opened(uri)
            with system.open_input_file(path) as handle:
                for at, x in _blocks(handle, n, dim, wanted):
                    if step.old is not None:  # perhaps the true distance decides
                        upper[at] = np.sqrt(((x - step.new[cluster[at]]) ** 2).sum(axis=1))
                        open_ = ~_decided(upper[at], lower[at])
                        at, x = at[open_], x[open_]
                    if not len(at):
                        continue
                    scanned += len(at)
                    was, (now, upper[at], lower[at]) = cluster[at], _nearest(x, step.new)
                    cluster[at] = now
                    moved = was != now
                    add(was[moved & (was >= 0)], x[moved & (was >= 0)], -1)
                    add(now[moved], x[moved], 1)
        here, radius = np.unique(cluster), np.zeros(k)
        np.maximum.at(radius, cluster, upper)
        rows = [{"cluster": int(c), "radius": float(radius[c]), "totals": np.asarray(totals.get(c, np.zeros(dim + 1, np.int64))).tolist()}
                for c in sorted({*here.tolist(), *totals})]
        return {"uri": uri, "n": n, "cluster": cluster.astype("<i4").tobytes(), "upper": upper.astype("<f8").tobytes(),
                "lower": lower.astype("<f8").tobytes(), "checked": len(wanted), "scanned": scanned, "moved": rows}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("uri", pa.string()), ("n", pa.int64()), ("cluster", pa.binary()), ("upper", pa.binary()), ("lower", pa.binary()),
                          ("checked", pa.int64()), ("scanned", pa.int64()),
                          ("moved", pa.list_(pa.struct([("cluster", pa.int32()), ("radius", pa.float64()), ("totals", pa.list_(pa.int64()))])))])
        for b in batches:
            for row in b.to_pylist():
                n = row["n"]
                held = ([np.frombuffer(row[c], t).copy() for c, t in (("cluster", "<i4"), ("upper", "<f8"), ("lower", "<f8"))] if step.old is not None
                        else [np.full(n, -1, np.int32), np.zeros(n), np.zeros(n)])
                yield pa.RecordBatch.from_pylist([shard(row["uri"], n, *held)], kind)
    return run


# --- rounds --------------------------------------------------------------------------------------

@dataclass
class Clustering:
    centroids: np.ndarray
    state: DataFrame  # a row per shard
    work: list[tuple[int, int]]  # per pass: vectors read, vectors scanned against all centroids


def cluster_shards(shards: DataFrame, centroids: np.ndarray, dim: int, rounds: int) -> Clustering:
    k, n_tasks = len(centroids), partitions_for(shards)
    sums, work = np.zeros((k, dim + 1), object), []  # of Python integers
    state, step = shards, Step(centroids)
    for r in range(rounds + 1):
        state = materialize(state.drop("moved", "checked", "scanned").repartition(n_tasks, "uri").mapInArrow(_assign(step, dim), _STATE), "clusters")
        one = state.select("checked", "scanned").agg(F.sum("checked"), F.sum("scanned")).first()
        work.append((one[0] or 0, one[1] or 0))
        if r == rounds:
            break
        parts = state.select(F.explode("moved").alias("m")).select("m.*")
        radius = np.zeros(k)
        for row in parts.groupBy("cluster").agg(F.max("radius"), *[F.sum(F.col("totals")[i].cast("decimal(38,0)")) for i in range(dim + 1)]).collect():
            radius[row[0]] = row[1]
            sums[row[0]] += np.array([int(v) for v in row[2:]], object)
        moved = step.new.copy()
        for c in range(k):
            if sums[c][dim]:
                moved[c] = [int(s) // int(sums[c][dim]) for s in sums[c][:dim]]
        if (moved == step.new).all():  # no later round changes anything
            break
        step = Step(moved, step.new, radius)
    return Clustering(step.new, state, work)


def _distances(centroids: np.ndarray, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                n, cluster = row["n"], np.frombuffer(row["cluster"], "<i4")
                system, path = files.opened(row["uri"])
                with system.open_input_file(path) as handle:
                    handle.seek(n * dim * 4)
                    ids, missing = np.frombuffer(handle.read(n * 8), "<i8"), np.frombuffer(handle.read(n), "u1").astype(bool)
                    for at, x in _blocks(handle, n, dim, np.arange(n)):
                        d = ((x - centroids[cluster[at]]) ** 2).sum(axis=1)
                        yield pa.RecordBatch.from_arrays([pa.array(ids[at], mask=missing[at]), pa.array(cluster[at], pa.int32()), pa.array(d)], ["id", "cluster", "distance"])
    return run


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM, k: int = K, rounds: int = ROUNDS,
            seed: int = SEED, scale: int = SCALE, folder: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``id, cluster, distance`` (squared)``, cluster_inertia, inertia, centroid_sha256`` of each vector."""
    spark = vectors.sparkSession
    rows = usable(small_batches(vectors), id_col, vector_col, dim)
    centroids = starts(rows, k, seed, scale)
    shards = write_shards(rows, dim, scale, folder or scratch_path(spark, "vectors"), shard_bytes)
    done = cluster_shards(shards, centroids.reshape(-1, dim), dim, rounds)
    schema = "id long, cluster int, distance long"
    if not len(centroids):
        found, texts = spark.createDataFrame([], schema), []
    else:
        dealt = done.state.select("uri", "n", "cluster").repartition(partitions_for(vectors), "uri")
        found = materialize(dealt.mapInArrow(_distances(done.centroids, dim), schema), "clustered")
        texts = [(c, hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()) for c, row in enumerate(done.centroids)]
    by_cluster = {r[0]: r[1] for r in found.groupBy("cluster").agg(F.sum("distance")).collect()}  # k rows at most
    names = spark.createDataFrame([(c, by_cluster.get(c), sum(by_cluster.values()), t) for c, t in texts],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(names), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
