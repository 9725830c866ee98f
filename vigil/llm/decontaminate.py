"""Benchmark decontamination by SimHash over item-sized windows.

Words are lower-cased (A-Z) runs between white space; shingles are runs of five words (an item
of fewer words is one shingle). For each item, every window of its size (the whole text, if
that is shorter) that holds at least one of its shingles gets a 64-bit SimHash weighted by
shingle counts; windows without one have similarity 0. Items within ``RADIUS`` bits are found
over ``8`` blocks of 8 bits: two fingerprints that differ in at most ``RADIUS`` bits differ in
at most ``RADIUS // 8`` bits of some block, and each block's table lists the items within that
many bits of every value, so none within the radius is missed. Survivors are verified by
the exact weighted similarity, sum of the smaller counts over sum of the larger ones.

Where all shingles differ, at a similarity of 0.8 a pair of fingerprints differs in 9.7 bits on
average with a deviation of 2.9, so one window in 3,000 at the very threshold lies beyond the
radius; higher similarities lie far within it. A shingle that is repeated weighs more in the
fingerprint, which then says little of the similarity. So an item that repeats a shingle, and
a text that repeats one near the places it shares with an item, take no fingerprints: all
windows are compared exactly, by sums over the shared places.

The benchmark is worked through in blocks of about ``BLOCK_ITEMS`` items or ``BLOCK_BYTES`` bytes, one
pass over the texts each. A task builds a block's index and writes it to the shared folder; tasks that search
read it from there, one at a time, so what any process holds is bounded, however large the benchmark is.

A null text or item is empty; empty ones match nothing. Rows with a null id are searched like
others. Repeated rows give repeated results. Empty tables give empty results. Only the named
columns are read.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import files
from vigil.llm.common import groups_by_bytes, materialize, small_batches, text_rows
from vigil.llm.shingles import sequence_hashes, word_hashes
from vigil.session import scratch_path

SHINGLE, RADIUS, THRESHOLD, BLOCK_ITEMS, BLOCK_BYTES = 5, 20, 0.8, 20_000, 16 << 20
_NEAR = RADIUS // 8
_ONES = np.array([bin(v).count("1") for v in range(256)], np.uint8)


def fingerprints(runs: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash, as 8 bytes a row, of the windows of ``size`` shingles at ``starts``."""
    bits = np.unpackbits(runs.view(np.uint8).reshape(len(runs), 8), axis=1).astype(np.int32) * 2 - 1
    total = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)))
    return np.packbits(total[starts + size] - total[starts] > 0, axis=1)


def _again(runs: np.ndarray) -> np.ndarray:
    """For each place, the first place that repeats a shingle of this place or a later one (the length: none)."""
    order = np.argsort(runs, kind="stable")
    after = np.full(len(runs), len(runs))
    same = runs[order[1:]] == runs[order[:-1]]
    after[order[:-1][same]] = order[1:][same]
    return np.minimum.accumulate(after[::-1])[::-1]


class Index:
    """The items of one block: their shingles, sizes and block tables."""

    def __init__(self, items: list[tuple[int, bytes]], shingle: int):
        words, at = word_hashes([t for _, t in items])
        self.ids, self.runs, self.k = [], [], []
        for (i, _), a, b in zip(items, at[:-1].tolist(), at[1:].tolist()):
            if b > a:
                self.ids.append(i)
                self.k.append(min(shingle, b - a))
                self.runs.append(sequence_hashes(words[a:b], self.k[-1]))
        self.size = np.array([len(r) for r in self.runs], np.int64)
        self.counts = [Counter(r.tolist()) for r in self.runs]
        self.repeats = [len(c) < len(r) for c, r in zip(self.counts, self.runs)]
        self.prints = np.concatenate([fingerprints(r, np.array([0]), len(r)) for r in self.runs] or [np.empty((0, 8), np.uint8)])
        self.holders: dict[int, dict[int, list[int]]] = {}  # shingle size -> shingle -> items
        for n, (k, c) in enumerate(zip(self.k, self.counts)):
            for h in c:
                self.holders.setdefault(k, {}).setdefault(h, []).append(n)
        self.known = {k: np.sort(np.fromiter(h, np.uint64, len(h))) for k, h in self.holders.items()}
        self.sieve = {}
        for k, h in self.known.items():
            self.sieve[k] = np.zeros(1 << 22, bool)
            self.sieve[k][(h >> np.uint64(42)).astype(np.int64)] = True
        # for each block and value, the items whose block is within _NEAR bits, as packed bits
        value = np.arange(256, dtype=np.uint8)
        near = _ONES[value[:, None] ^ value[None]] <= _NEAR
        self.tables = np.stack([np.packbits(near[:, self.prints[:, b]], axis=1) for b in range(8)]) if self.ids else None

    def within(self, prints: np.ndarray, of: int) -> list[np.ndarray]:
        """For each fingerprint, the items of item ``of``'s shingle size and size within the radius."""
        same = np.packbits((self.size == self.size[of]) & (np.array(self.k) == self.k[of]))
        out = []
        for p in prints:
            met = np.bitwise_or.reduce(self.tables[np.arange(8), p]) & same
            near = np.flatnonzero(np.unpackbits(met)[:len(self.ids)])
            out.append(near[_ONES[self.prints[near] ^ p].sum(axis=1) <= RADIUS])
        return out

    def best_window(self, runs: np.ndarray, places: np.ndarray, of: int) -> tuple[float, int]:
        """The best similarity of item ``of`` with any window, and its first window, given the places of its shingles in a text."""
        size = min(int(self.size[of]), len(runs))
        order = np.argsort(runs[places], kind="stable")
        p, h = places[order], runs[places][order]
        new = np.concatenate(([True], h[1:] != h[:-1]))
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        many = np.array([self.counts[of][x] for x in h[new].tolist()])[np.cumsum(new) - 1]
        # a place adds to the windows that hold it and fewer than ``many`` places of its shingle before it
        back = np.arange(len(p)) - many
        begin = np.maximum(np.maximum(p - size + 1, 0), np.where(back >= first, p[np.maximum(back, 0)] + 1, 0))
        end = np.minimum(p, len(runs) - size) + 1
        some = begin < end
        at, which = np.unique(np.concatenate((begin[some], end[some])), return_inverse=True)
        both = np.cumsum(np.bincount(which, np.repeat((1, -1), some.sum()), minlength=len(at)).astype(np.int64))
        s = int(np.argmax(both))
        return int(both[s]) / (size + int(self.size[of]) - int(both[s])), int(at[s])

    def matches(self, runs: np.ndarray, k: int, threshold: float) -> dict[int, tuple[float, int]]:
        """Items found in a text, given its shingles of ``k`` words: best similarity and its first window."""
        hit = np.flatnonzero(self.sieve[k][(runs >> np.uint64(42)).astype(np.int64)])
        known, holders = self.known[k], self.holders[k]
        at = np.minimum(np.searchsorted(known, runs[hit]), len(known) - 1)
        hit = hit[known[at] == runs[hit]]
        places: dict[int, list[int]] = {}
        for p in hit.tolist():
            for n in holders[int(runs[p])]:
                places.setdefault(n, []).append(p)
        best: dict[int, tuple[float, int]] = {}
        done: dict[int, set[int]] = {}
        again = _again(runs) if places else None
        for n, ps in places.items():
            size = min(int(self.size[n]), len(runs))
            p = np.array(ps)
            if self.repeats[n] or (again[np.maximum(p - size + 1, 0)] < p + size).any():
                similarity, s = self.best_window(runs, p, n)
                if similarity >= threshold and (n not in best or (-similarity, s) < (-best[n][0], best[n][1])):
                    best[n] = (similarity, s)
                continue
            starts = np.unique(np.clip(np.concatenate([np.arange(p - size + 1, p + 1) for p in ps]), 0, len(runs) - size))
            for part in np.split(starts, np.flatnonzero(np.diff(starts) > size) + 1):  # close windows share their sums
                lo = int(part[0])
                prints = fingerprints(np.ascontiguousarray(runs[lo:int(part[-1]) + size]), part - lo, size)
                for s, near in zip(part.tolist(), self.within(prints, n)):
                    window = None
                    for m in near.tolist():
                        if s in done.setdefault(m, set()):
                            continue
                        done[m].add(s)
                        window = window or Counter(runs[s:s + size].tolist())
                        both = sum((window & self.counts[m]).values())
                        similarity = both / (size + int(self.size[m]) - both)
                        if similarity >= threshold and (m not in best or (-similarity, s) < (-best[m][0], best[m][1])):
                            best[m] = (similarity, s)
        return best


def _search(index: Index, ids: list, texts: list[bytes], threshold: float):
    """``(row number, item id, similarity, first word, words)`` of all matches in order."""
    row = 0
    for _, some in groups_by_bytes(ids, texts):
        words, at = word_hashes(some)
        for k in sorted(index.holders):
            runs = sequence_hashes(words, k)
            flagged = index.sieve[k][(runs >> np.uint64(42)).astype(np.int64)]
            before = np.concatenate(([0], np.cumsum(flagged)))
            for j, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                end = b - k + 1
                if end > a and before[end] > before[a]:
                    for n, (similarity, s) in sorted(index.matches(runs[a:end], k, threshold).items()):
                        yield row + j, index.ids[n], similarity, s, min(int(index.size[n]), end - a) + k - 1
        row += len(some)


def _build(folder: str, shingle: int):
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("id", "ascending"), ("text", "ascending")])
        index = Index(list(zip(block.column("id").to_pylist(), block.column("text").to_pylist())), shingle)
        uri = None
        if index.ids:
            uri = files.fresh(folder, "index", ".pickle")
            files.write(uri, [pickle.dumps(index, protocol=pickle.HIGHEST_PROTOCOL)])
        return pa.table({"uri": pa.array([uri], pa.string())})
    return run


@lru_cache(1)
def _index(uri: str) -> Index:
    """The index of one block; a worker process holds one at a time."""
    system, path = files.opened(uri)
    with system.open_input_stream(path, compression=None) as f:
        return pickle.loads(f.read())


def _blocks(items: DataFrame, id_col: str, text_col: str, shingle: int, block_items: int) -> list[str]:
    """The files of the indexes of all items, each of about ``block_items`` at most. Tasks build and write them; only
    their names come to the driver."""
    rows = text_rows(items, id_col, text_col)
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n = max(1, -(-size.n // block_items), -(-size.bytes // BLOCK_BYTES))
    # dealt by place, so that copies of an item don't meet in one block
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)))
    folder = scratch_path(items.sparkSession, "benchmark")
    names = rows.groupBy("block").applyInArrow(_build(folder, shingle), "uri string")
    return sorted(r.uri for r in materialize(names, "benchmark").where("uri IS NOT NULL").collect())


def _found(uri: str, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows = b.column("id").to_pylist(), [[], [], [], [], []]
            for row, item, similarity, start, words in _search(_index(uri), ids, b.column("text").to_pylist(), threshold):
                for column, v in zip(rows, (ids[row], item, similarity, start, words)):
                    column.append(v)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], ["doc_id", "item_id", "similarity", "first_word", "n_words"])
    return run


def find(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``doc_id, item_id, similarity, first_word, n_words`` of each text and item that meet."""
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    rows = text_rows(docs, id_col, text_col)
    out = [rows.mapInArrow(_found(b, threshold), schema) for b in _blocks(items, item_id, item_text, shingle, block_items)]
    if not out:
        return docs.sparkSession.createDataFrame([], schema)
    total = out[0]
    for more in out[1:]:
        total = total.unionAll(more)
    return total


def _clean(uri: str, threshold: float, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(t or "").encode() for t in b.column(column).to_pylist()]
            keep = np.ones(len(texts), bool)
            for row, *_ in _search(_index(uri), [None] * len(texts), texts, threshold):
                keep[row] = False
            yield b.filter(pa.array(keep))
    return run


def remove(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` in which no item is found; all columns stay."""
    small_batches(docs)
    for b in _blocks(items, item_id, item_text, shingle, block_items):
        docs = docs.mapInArrow(_clean(b, threshold, docs.columns.index(text_col)), docs.schema)
    return docs
