"""MinHash near-duplicates with sequential Bayesian verification.

1. Each text becomes a signature in one pass: ``BANDS`` band keys of ``ROWS`` minima, and
   ``CHECKS`` further minima for verification. Equal sets (by a 128-bit fingerprint) become
   one class, so copies never make pairs.
2. Candidates are classes that share a band key. First each member is paired with the
   smallest member of its bucket only (linear in the bucket). Batches of ``STEP`` check
   values are compared in turn: a pair is pruned once P(similarity >= threshold | matches)
   under a uniform prior is below ``miss``; survivors are verified on their full sets.
3. Links found so far make components. Buckets that lie in one component can't add anything.
   In the others every pair of different components is compared by signature, in units of two
   blocks of at most ``BLOCK`` members, and each unit emits a spanning forest of the
   unpruned pairs. What these connect is a family. Within a family the pairs of different
   components are compared again, block by block, now with the full sets at hand: survivors
   are verified exactly, unless verified links already connect them. Nothing is capped, no
   step emits all pairs of a group, and no group meets in one task.

A link of similarity s is missed with probability (1 - s^ROWS)^BANDS (6e-7 at 0.8) plus
``miss`` for each batch. Components need one path only, so fewer are lost in practice.

Nulls: a null text counts as empty; empty or wordless texts have no set and link with
nothing; rows with a null id are left out. Rows that repeat an id count once. An empty table
gives an empty result. Other columns are never read, so their names can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import fixed_bytes, materialize, runs, sorted_map, text_rows, with_ids
from vigil.llm.components import components
from vigil.llm.shingles import mix, shingle_sets

BANDS, ROWS, CHECKS, STEP = 20, 3, 128, 16
BLOCK, SET_BYTES = 1024, 8 << 20
MISS = 1e-5
_rng = np.random.default_rng(7919)
_XOR = _rng.integers(0, 2**32, BANDS * ROWS + CHECKS, dtype=np.uint32)[:, None]
_MUL = (_rng.integers(0, 2**31, BANDS * ROWS + CHECKS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]


def _minima(hashes: np.ndarray) -> np.ndarray:
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(_XOR), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        low = np.minimum(low, ((x[i:i + 2048][None] ^ _XOR) * _MUL).min(axis=1))
    return low


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, counts, prints, keys, checks = [], [], [], [], []
            for i, s in shingle_sets(b.column(0).to_pylist(), b.column(1).to_pylist(), k):
                ids.append(i)
                counts.append(len(s))
                m = mix(s)
                prints.append(np.array([s.sum(dtype=np.uint64), np.bitwise_xor.reduce(m)], np.uint64).tobytes() if len(s) else None)
                low = _minima(s)
                band = low[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
                key = np.arange(1, BANDS + 1, dtype=np.uint64)
                for j in range(ROWS):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + band[:, j])
                keys.append(key.view(np.int64))
                checks.append(low[BANDS * ROWS:].astype(np.uint16).tobytes())  # the lower halves tell apart well enough
            offsets = pa.array(np.arange(0, BANDS * len(ids) + 1, BANDS, dtype=np.int32))
            flat = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(prints, pa.binary()),
                 pa.ListArray.from_arrays(offsets, flat), pa.array(checks, pa.binary())],
                ["id", "n_shingles", "print", "bands", "checks"])
    return run


def signatures(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, print, bands, checks``: one row per id."""
    rows = text_rows(docs, id_col, text_col).where("id is not null")
    return rows.mapInArrow(_sign(k), "id long, n_shingles long, print binary, bands array<long>, checks binary")


@lru_cache
def fewest_matches(percent: int, miss: float) -> tuple[int, ...]:
    """After each batch, the matches below which P(s >= percent/100 | matches) < miss.

    With a uniform prior the posterior of s after m matches of n is Beta(m + 1, n - m + 1),
    whose tail at t is P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(STEP, CHECKS + 1, STEP):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def surviving(a: np.ndarray, b: np.ndarray, fewest: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places and matches of the row pairs that no batch prunes."""
    left, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for step, least in enumerate(fewest):
        part = slice(step * STEP, (step + 1) * STEP)
        matches = matches + (a[left, part] == b[left, part]).sum(axis=1)
        keep = matches >= least
        left, matches = left[keep], matches[keep]
    return left, matches


def _prune(fewest: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            at, matches = surviving(fixed_bytes(x.column("ca"), np.uint16, CHECKS), fixed_bytes(x.column("cb"), np.uint16, CHECKS), fewest)
            at = pa.array(at)
            yield pa.RecordBatch.from_arrays([x.column("a").take(at), x.column("b").take(at), pa.array(matches, pa.int64())], ["a", "b", "matches"])
    return run


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _spanning(fewest: tuple[int, ...], percent: int | None):
    """Over each run of a unit, a spanning forest of what its pairs of different components and
    sides (or of side 2) show: of the pairs that no batch prunes, or, with ``percent``, of
    those that also prove similar on their full sets. Emits at most one row per node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, "unit"):
            unit, node, comp, side = (t.column(c).to_numpy() for c in ("unit", "node", "comp", "side"))
            check = fixed_bytes(t.column("checks"), np.uint16, CHECKS)
            sets = [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()] if percent else None
            found = []
            edges = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1).tolist(), len(unit)]
            for lo, hi in zip(edges[:-1], edges[1:]):
                if (comp[lo:hi] == comp[lo]).all():
                    continue
                # verified links join whole components; likely pairs only what they show
                first: dict[int, int] = {}
                parent = [first.setdefault(c, p) if percent else p for p, c in enumerate(comp[lo:hi].tolist())]
                for p in range(lo, hi):
                    other = np.arange(p + 1, hi)
                    other = other[(comp[other] != comp[p]) & ((side[other] != side[p]) | (side[p] == 2))]
                    if not len(other):
                        continue
                    at, matches = surviving(np.broadcast_to(check[p], (len(other), CHECKS)), check[other], fewest)
                    for q in other[at[np.argsort(-matches, kind="stable")]].tolist():
                        x, y = _find(parent, p - lo), _find(parent, q - lo)
                        if x != y and (not percent or similar(sets[p], sets[q], percent)):
                            parent[max(x, y)] = min(x, y)
                            found.append((node[p], node[q]))
            if found:
                pairs = np.sort(np.array(found, np.int64), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
    return run


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, of two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, s in shingle_sets(b.column(0).to_pylist(), b.column(1).to_pylist(), k):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([s.tobytes()], pa.binary())], ["id", "set"])
    return run


def _exact(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            keep = [similar(np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64), percent)
                    for sa, sb in zip(x.column("sa").to_pylist(), x.column("sb").to_pylist())]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([x.column("a").filter(mask), x.column("b").filter(mask)], ["a", "b"])
    return run


def shingled(ids: DataFrame, docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """``id, set`` of the given ids."""
    texts = with_ids(text_rows(docs, id_col, text_col), ids).dropDuplicates(["id"])
    return materialize(texts.mapInArrow(_sets(k), "id long, set binary"), "sets")


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    sets = shingled(ids, docs, k, id_col, text_col)
    return (pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
            .select("a", "b", "sa", "sb").mapInArrow(_exact(percent), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, miss: float = MISS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id, kept`` of each id of ``docs``."""
    fewest = fewest_matches(percent, miss)
    signed = materialize(signatures(docs, shingle, id_col, text_col), "signatures")
    # equal sets are one class, named by its smallest id
    classes = signed.where("print is not null").groupBy("print").agg(F.min("id").alias("rep"))
    members = materialize(signed.select("id", "n_shingles", "print").join(classes, "print", "left")
                          .groupBy("id").agg(F.max("n_shingles").alias("n_shingles"), F.min("rep").alias("rep")), "members")
    reps = materialize(signed.join(members.where("rep = id").select("id"), "id", "left_semi")
                       .select("id", "n_shingles", "bands", "checks").dropDuplicates(["id"]), "classes")
    checks = reps.select(F.col("id").alias("node"), "checks")
    banded = reps.select(F.col("id").alias("node"), F.explode("bands").alias("key"))
    heads = banded.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1")
    buckets = materialize(banded.join(heads.select("key", "head"), "key"), "buckets")

    # 1. each member with the head of its buckets; the likeliest of these pairs is verified
    stars = buckets.where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    alive = (stars.join(checks.select(F.col("node").alias("a"), F.col("checks").alias("ca")), "a")
             .join(checks.select(F.col("node").alias("b"), F.col("checks").alias("cb")), "b")
             .select("a", "b", "ca", "cb").mapInArrow(_prune(fewest), "a long, b long, matches long"))
    likeliest = materialize(alive.groupBy("b").agg(F.max_by("a", F.struct("matches", -F.col("a"))).alias("a")), "likeliest")
    first = materialize(verified(likeliest.select("a", "b"), docs, shingle, percent, id_col, text_col), "links")
    comp = materialize(components(first.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "components")

    # 2. families: what the unpruned pairs of the buckets that still hold several components connect
    placed = materialize(buckets.join(comp, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp")), "placed")
    units = block_units(placed, F.lit(BLOCK)).join(checks, "node").select("unit", "node", "comp", "side", "checks")
    likely = sorted_map(units, "unit", _spanning(fewest, None), "a long, b long")
    family = materialize(components(likely.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "families")

    # 3. within a family the unpruned pairs of different components are verified on their sets
    sets = shingled(family.select(F.col("node").alias("id")), docs, shingle, id_col, text_col)
    rows = (family.join(comp.select("node", F.col("component").alias("comp")), "node", "left")
            .select(F.col("component").alias("key"), "node", F.coalesce("comp", "node").alias("comp")))
    sized = rows.join(reps.select(F.col("id").alias("node"), "n_shingles"), "node")
    room = sized.groupBy("key").agg((F.lit(SET_BYTES) / F.avg(F.col("n_shingles") * 8)).cast("int").alias("room"))
    full = (block_units(rows.join(room, "key"), F.least(F.greatest(F.max("room"), F.lit(1)), F.lit(BLOCK)))
            .join(checks, "node").join(sets.select(F.col("id").alias("node"), "set"), "node")
            .select("unit", "node", "comp", "side", "checks", "set"))
    second = materialize(sorted_map(full, "unit", _spanning(fewest, percent), "a long, b long"), "links")

    links = first.union(second).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    final = components(links).select(F.col("node").alias("rep"), "component")
    return (members.join(final, "rep", "left")
            .select("id", "n_shingles", F.coalesce("component", "rep", "id").alias("component_id"))
            .withColumn("kept", F.col("id") == F.col("component_id")))


def block_units(placed: DataFrame, room: Column) -> DataFrame:
    """``unit, node, comp, side``: blocks of about ``room`` members that must meet.

    Of ``key, node, comp``: the members of a key's largest component needn't meet each other;
    the others meet all. Both kinds are dealt into blocks, and each two blocks are a unit.
    ``side`` tells the two blocks of a unit apart; 2: a block that meets itself.
    """
    extra = [c for c in placed.columns if c == "room"]
    per = placed.groupBy("key", "comp", *extra).agg(F.count("*").alias("n"))
    per = per.groupBy("key").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.count("*").alias("comps"),
                                 F.max_by("comp", F.struct("n", "comp")).alias("major"), room.alias("each")).where("comps > 1")
    per = per.select("key", "major", F.ceil(F.col("most") / F.col("each")).cast("int").alias("majors"),
                     F.ceil((F.col("n") - F.col("most")) / F.col("each")).cast("int").alias("minors"))
    rows = placed.drop(*extra).join(per, "key").withColumn("is_major", F.col("comp") == F.col("major"))
    dealt = F.pmod(F.xxhash64("node"), F.when(F.col("is_major"), F.col("majors")).otherwise(F.col("minors"))).cast("int")

    def unit(kind: int, i: Column, j: Column, side: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))

    own = F.col("block")
    to_minors = F.transform(F.sequence(F.lit(0), F.col("minors") - 1), lambda j: unit(0, own, j, F.lit(0)))
    to_majors = F.transform(F.sequence(F.lit(0), F.col("majors") - 1), lambda i: unit(0, i, own, F.lit(1)))
    among = F.transform(F.sequence(F.lit(0), F.col("minors") - 1),
                        lambda j: unit(1, F.least(own, j), F.greatest(own, j), F.when(own == j, 2).when(own < j, 0).otherwise(1)))
    units = rows.withColumn("block", dealt).select(
        "key", "node", "comp", F.explode(F.when(F.col("is_major"), to_minors).otherwise(F.concat(to_majors, among))).alias("u"))
    return units.select(F.xxhash64("key", "u.kind", "u.i", "u.j").alias("unit"), "node", "comp", F.col("u.side").alias("side"))
