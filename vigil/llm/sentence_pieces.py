"""SentencePiece encoding and decoding of texts of any length by a max-plus parallel scan.

Byte-pair encodings have a local property: a sequence of pieces is the encoding of a text if and
only if each two neighbours are the encoding of their joint text (a merge across a border would
show between its two neighbours, too). So encoding is a path through the lattice of pieces
whose edges weigh 0 (neighbours agree) or minus infinity, and exactly one path weighs 0.

A giant text is split into chunks. The state at a chunk's border is the piece that holds the
last character before it; the few possible ones follow from the characters around it. Each
chunk yields its transfer matrix from border to border in max-plus terms. Matrices are multiplied
associatively: those of ``GROUP`` neighbouring chunks in one task, their products along the
text, which gives the states at the groups' borders, then within each group from there. With
the states at its borders known, each chunk is backtraced on its own. Where no piece can reach
over a place (before a word mark), paths meet, so a chunk's lattice shrinks to what lies before
its first and behind its last such place, and the library encodes what lies between.

Texts of at most ``CHUNK`` characters are a single chunk and need no matrix: their words are
encoded by the library, each distinct one once per task (a bounded memory).

A null text is empty and has no pieces. Null ids are kept; repeated rows give repeated results.
An empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import materialize, partitions_for, runs, small_batches

CHUNK, GROUP, CACHE_WORDS, REMEMBERED = 16_384, 64, 150_000, 1 << 14
MARK = "▁"
NEVER = -np.inf
State = tuple[int, int]  # where a piece begins and ends, from the border on
Token = tuple[int, int]


class Pieces:
    """The vocabulary of a byte-pair model and what follows from it."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.lib = lib = SentencePieceProcessor(model_file=path)
        n = lib.vocab_size()
        plain = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        self.id = {lib.id_to_piece(i): i for i in plain}
        self.score = {lib.id_to_piece(i): lib.get_score(i) for i in plain}
        self.byte = {int(lib.id_to_piece(i)[3:-1], 16): i for i in range(n) if lib.is_byte(i)}
        self.longest = max(map(len, self.id))
        self.words_end = all(re.fullmatch(f"{MARK}*[^{MARK}]*", p) for p in self.id)  # no piece reaches over a word mark behind another character
        self.bytes_of = [b""] * n
        for p, i in self.id.items():
            self.bytes_of[i] = p.replace(MARK, " ").encode()
        for b, i in self.byte.items():
            self.bytes_of[i] = bytes([b])
        self.merged = lru_cache(REMEMBERED)(self._merged)
        self.agree = lru_cache(REMEMBERED)(self._agree)

    def _merged(self, text: str) -> tuple[str, ...]:
        """Byte-pair merging of a short text: the best-scored pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best = max(((self.score[parts[i] + parts[i + 1]], -i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in self.score), default=None)
            if best is None:
                return tuple(parts)
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def _agree(self, a: str, b: str) -> bool:
        return self.merged(a + b) == (a, b)

    def is_piece(self, s: str) -> bool:
        return len(s) == 1 or s in self.id and self.merged(s) == (s,)

    def ids(self, s: str) -> list[int]:
        """The ids of a piece; a character beyond the vocabulary is its bytes."""
        return [self.id[s]] if s in self.id else [self.byte[b] for b in s.encode()]

    def states(self, text: str, at: int, final: bool) -> list[State]:
        """The pieces that may hold the character before ``at``; at the end, those that end there."""
        if at == 0:
            return [(0, 0)]
        out = []
        for a in range(max(0, at - self.longest), at):
            for b in [at] if final else range(at, min(len(text), a + self.longest) + 1):
                if self.is_piece(text[a:b]):
                    out.append((a - at, b - at))
        return out

    def free(self, text: str, lo: int, hi: int) -> tuple[int, int] | None:
        """The first and last place from ``lo`` to before ``hi`` that no piece reaches over."""
        if not self.words_end:
            return None
        from_ = max(lo - 1, 0)
        places = [m.start() + 1 + from_ for m in re.finditer(f"[^{MARK}]{MARK}", text[from_:hi])]
        return (places[0], places[-1]) if places else None

    def reach(self, text: str, start: list[Token], lo: int, hi: int, final: bool) -> dict[Token, np.ndarray]:
        """For each piece, begun at ``lo`` or behind, that may hold the character before ``hi``: the
        weight of the best path to it from each piece of ``start`` (minus infinity: none)."""
        n = len(start)
        ending: dict[int, list[tuple[Token, np.ndarray]]] = {}
        last: dict[Token, np.ndarray] = {}
        for i, token in enumerate(start):
            weight = np.full(n, NEVER)
            weight[i] = 0.0
            ending.setdefault(token[1], []).append((token, weight))
            if token[1] >= hi and (not final or token[1] == hi):
                last[token] = weight
        for a in range(lo, hi):
            for b in range(a + 1, min(len(text), a + self.longest) + 1):
                piece = text[a:b]
                if not self.is_piece(piece):
                    continue
                best = None
                for (x, y), weight in ending.get(a, ()):
                    if x == y or self.agree(text[x:y], piece):
                        best = weight if best is None else np.maximum(best, weight)
                if best is not None:
                    ending.setdefault(b, []).append(((a, b), best))
                    if b == hi or b > hi and not final:
                        last[a, b] = best
            ending.pop(a, None)
        return last

    def transfer(self, text: str, lo: int, hi: int, final: bool) -> np.ndarray:
        """The chunk's matrix: best weight from each state at ``lo`` to each state at ``hi``."""
        start, end = self.states(text, lo, False), self.states(text, hi, final)
        start_tokens, end_tokens = [(a + lo, b + lo) for a, b in start], [(a + hi, b + hi) for a, b in end]
        free = self.free(text, lo, hi)
        out = np.full((len(start), len(end)), NEVER)
        if free is None:
            found = self.reach(text, start_tokens, lo, hi, final)
            for j, t in enumerate(end_tokens):
                if t in found:
                    out[:, j] = found[t]
            return out
        first, last = free
        into = np.max([np.full(len(start), NEVER), *self.reach(text, start_tokens, lo, first, True).values()], axis=0)
        onward = self.reach(text, [(last, last)], last, hi, final)
        for j, t in enumerate(end_tokens):
            if t in onward:
                out[:, j] = into + onward[t][0]
        return out

    def path(self, text: str, start: Token, end: Token, lo: int, hi: int) -> list[str]:
        """The pieces behind ``start`` up to ``end``, on the one path of weight 0."""
        ending: dict[int, list[tuple[Token, tuple | None]]] = {start[1]: [(start, None)]}
        for a in range(lo, hi):
            for b in range(a + 1, min(len(text), a + self.longest) + 1):
                if not self.is_piece(text[a:b]):
                    continue
                for node in ending.get(a, ()):
                    x, y = node[0]
                    if x == y or self.agree(text[x:y], text[a:b]):
                        ending.setdefault(b, []).append(((a, b), node))
                        break
        if end == start:
            return []
        node = next(n for n in ending[end[1]] if n[0] == end)
        out = []
        while node[1] is not None:
            out.append(text[node[0][0]:node[0][1]])
            node = node[1]
        return out[::-1]

    def backtrace(self, text: str, lo: int, hi: int, start: State, end: State) -> list[int]:
        """The ids of the pieces that begin in the chunk, given the states at its borders."""
        first, last = (start[0] + lo, start[1] + lo), (end[0] + hi, end[1] + hi)
        free = self.free(text, lo, hi)
        if free is None:
            return [i for p in self.path(text, first, last, lo, hi) for i in self.ids(p)]
        a, b = free
        to_free = next(t for t, w in self.reach(text, [first], lo, a, True).items() if w[0] == 0)
        before, behind = self.path(text, first, to_free, lo, a), self.path(text, (b, b), last, b, hi)
        inner = self.lib.encode(text[a + 1:b].replace(MARK, " ")) if b > a else []
        return [i for p in before for i in self.ids(p)] + inner + [i for p in behind for i in self.ids(p)]

    def decode(self, ids: np.ndarray | list[int]) -> bytes:
        """The text of ids in UTF-8, with the blank that encoding puts first."""
        return b"".join([self.bytes_of[i] for i in ids])


@lru_cache(1)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Encoder:
    """Ids (little-endian uint16 or uint32) of whole texts by the library, each distinct word once."""

    def __init__(self, path: str):
        self.pieces, self.seen = pieces(path), {}
        self.kind = "<u2" if len(self.pieces.bytes_of) <= 1 << 16 else "<u4"

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        p = self.pieces
        # words are apart where single blanks are; other texts go to the library whole
        plain = [p.words_end and bool(t) and b"  " not in t and t[:1] != b" " and t[-1:] != b" " and _MARK not in t for t in texts]
        split = [t.split(b" ") if ok else () for t, ok in zip(texts, plain)]
        new = set().union(*split).difference(self.seen)
        if len(self.seen) + len(new) > CACHE_WORDS:
            self.seen, new = {}, set().union(*split)
        new = list(new)
        for i in range(0, len(new), 20_000):
            part = new[i:i + 20_000]
            for w, ids in zip(part, p.lib.encode([x.decode() for x in part], num_threads=1)):
                self.seen[w] = np.array(ids, self.kind).tobytes()
        return [b"".join(map(self.seen.__getitem__, words)) if ok else np.array(p.lib.encode(t.decode(), num_threads=1), self.kind).tobytes()
                for t, words, ok in zip(texts, split, plain)]


_MARK = MARK.encode()


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None]).max(axis=1)


def _kept(m: np.ndarray) -> bytes:
    return np.array(m.shape, "<i4").tobytes() + m.astype("<f4").tobytes()


def _matrix(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<f4", offset=8).reshape(np.frombuffer(data, "<i4", 2))


def walk(matrices: list[np.ndarray], start: int, end: int | None) -> list[int]:
    """The states at all borders on the best path through a row of matrices."""
    ahead = [np.where(np.arange(matrices[0].shape[0]) == start, 0.0, NEVER)]
    for m in matrices:
        ahead.append((ahead[-1][:, None] + m).max(axis=0))
    states = [int(np.argmax(ahead[-1])) if end is None else end]
    for weight, m in zip(ahead[-2::-1], matrices[::-1]):
        states.append(int(np.argmax(weight + m[:, states[-1]])))
    return states[::-1]


def _split(path: str, size: int):
    """Chunks with the characters around them that their border states depend on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = pieces(path).longest
        for b in batches:
            for id_, key, text in zip(*(b.column(c).to_pylist() for c in ("id", "key", "text"))):
                text = MARK + text.replace(" ", MARK)
                n = -(-len(text) // size)
                for i in range(0, n, 64):
                    places = range(i * size, min(n, i + 64) * size, size)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([id_] * len(places), pa.int64()), pa.array([key] * len(places), pa.int64()),
                        pa.array([p // size for p in places], pa.int64()),
                        pa.array([min(p, reach) for p in places], pa.int32()), pa.array([min(size, len(text) - p) for p in places], pa.int32()),
                        pa.array([p + size >= len(text) for p in places]), pa.array([text[max(0, p - reach):p + size + reach] for p in places])],
                        ["id", "key", "chunk", "lo", "n", "final", "text"])
    return run


def _transfers(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for b in batches:
            made = [_kept(p.transfer(t, lo, lo + n, final)) for lo, n, final, t in zip(*(b.column(c).to_pylist() for c in ("lo", "n", "final", "text")))]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("chunk"), pa.array(made, pa.binary())], ["key", "chunk", "matrix"])
    return run


def _of_runs(fn, names: tuple[str, ...], kinds: tuple):
    """Rows that ``fn`` makes of each run of equal units, given its rows as dicts in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, "unit"):
            unit = t.column("unit").to_numpy()
            cuts = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1).tolist(), len(unit)]
            rows = t.to_pylist()
            out = [r for a, e in zip(cuts[:-1], cuts[1:]) for r in fn(rows[a:e])]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], list(names))
    return run


def _multiplied(rows: list[dict]):
    m = _matrix(rows[0]["matrix"])
    for r in rows[1:]:
        m = product(m, _matrix(r["matrix"]))
    yield rows[0]["key"], rows[0]["part"], _kept(m)


def _along(rows: list[dict]):
    states = walk([_matrix(r["matrix"]) for r in rows], 0, None)
    for r, a, b in zip(rows, states[:-1], states[1:]):
        yield r["key"], r["part"], a, b


def _within(rows: list[dict]):
    states = walk([_matrix(r["matrix"]) for r in rows], rows[0]["start"], rows[0]["end"])
    for r, a, b in zip(rows, states[:-1], states[1:]):
        yield r["key"], r["chunk"], a, b


def _traced(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for b in batches:
            made = []
            for lo, n, final, text, a, e in zip(*(b.column(c).to_pylist() for c in ("lo", "n", "final", "text", "start", "end"))):
                states = p.states(text, lo, False)[a], p.states(text, lo + n, final)[e]
                made.append(np.array(p.backtrace(text, lo, lo + n, *states), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), b.column("chunk"), pa.array(made, pa.binary())], ["id", "key", "chunk", "ids"])
    return run


def encode_giants(texts: DataFrame, path: str, chunk: int = CHUNK, group: int = GROUP) -> DataFrame:
    """``id, key, chunk, ids`` (little-endian uint32): the chunks of each row ``id, key, text``; the
    key (long) tells rows apart. The chunks are written once, so the key needn't be stable."""
    n = partitions_for(texts)
    parts = materialize(texts.mapInArrow(_split(path, chunk), "id long, key long, chunk long, lo int, n int, final boolean, text string"), "chunks")
    matrices = parts.mapInArrow(_transfers(path), "key long, chunk long, matrix binary")
    part = F.floor(F.col("chunk") / group).cast("long")
    matrices = materialize(matrices.withColumn("part", part).withColumn("unit", F.xxhash64("key", "part")), "matrices")
    dealt = matrices.repartition(n, "unit").sortWithinPartitions("unit", "chunk")
    products = dealt.mapInArrow(_of_runs(_multiplied, ("key", "part", "matrix"), (pa.int64(), pa.int64(), pa.binary())), "key long, part long, matrix binary")
    whole = products.withColumn("unit", F.xxhash64("key")).repartition(n, "unit").sortWithinPartitions("unit", "part")
    ints = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    borders = whole.mapInArrow(_of_runs(_along, ("key", "part", "start", "end"), ints), "key long, part long, start int, end int")
    inside = matrices.join(borders, ["key", "part"]).repartition(n, "unit").sortWithinPartitions("unit", "chunk")
    states = inside.mapInArrow(_of_runs(_within, ("key", "chunk", "start", "end"), ints), "key long, chunk long, start int, end int")
    return parts.join(states, ["key", "chunk"]).mapInArrow(_traced(path), "id long, key long, chunk long, ids binary")


class _Digest:
    """Number and checksum of ids, and hash and size of the decoded text, as its parts come."""

    def __init__(self):
        self.n = self.crc = self.bytes = 0
        self.sha = hashlib.sha256()

    def take(self, ids: np.ndarray, text: bytes) -> None:
        self.crc = zlib.crc32(ids.astype("<u4").tobytes(), self.crc)
        self.n += len(ids)
        self.sha.update(text)
        self.bytes += len(text)

    def row(self) -> tuple:
        return self.n, self.crc, self.sha.hexdigest(), self.bytes


_DIGEST = (("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_sha256", pa.string()), ("decoded_bytes", pa.int64()))
_MORE = {"ids": pa.list_(pa.int32()), "decoded": pa.string()}


def _batch(first: pa.Array, name: str, rows: list[tuple], columns: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([first, *(pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(columns))], [name, *(n for n, _ in columns)])


def _columns(more: tuple[str, ...]) -> tuple:
    return (*_DIGEST, *((n, _MORE[n]) for n in more))


def _small(path: str, more: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            rows, first, size = [], 0, 0
            for lo in range(0, len(texts), 200):
                for ids in encode(texts[lo:lo + 200]):
                    d, ids = _Digest(), np.frombuffer(ids, encode.kind)
                    text = encode.pieces.decode(ids.tolist())[1:]  # without the blank put first
                    d.take(ids, text)
                    rows.append((*d.row(), *(ids if n == "ids" else text.decode() for n in more)))
            yield _batch(b.column("id"), "id", rows, _columns(more))
    return run


def _joined(path: str, more: tuple[str, ...]):
    """Documents of their chunks, which come in order; without ``more`` nothing is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, key, now, held, texts = pieces(path), None, None, [], []

        def close() -> pa.RecordBatch:
            row = (*now.row(), *(np.concatenate(held).astype(np.int32) if n == "ids" else b"".join(texts).decode() for n in more))
            return _batch(pa.array([key[0]], pa.int64()), "id", [row], _columns(more))

        for b in batches:
            for id_, k, ids in zip(*(b.column(c).to_pylist() for c in ("id", "key", "ids"))):
                if now is None or k != key[1]:
                    if now is not None:
                        yield close()
                    key, now, held, texts = (id_, k), _Digest(), [], []
                ids = np.frombuffer(ids, "<u4")
                text = p.decode(ids.tolist())
                text = text if now.n else text[1:]
                now.take(ids, text)
                if "ids" in more:
                    held.append(ids)
                if "decoded" in more:
                    texts.append(text)
        if now is not None:
            yield close()
    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = (), chunk: int = CHUNK, group: int = GROUP) -> DataFrame:
    """``id, n_tokens, ids_crc32, decoded_sha256, decoded_bytes`` of each row: its ids and what they
    decode to; of ``more`` also ``ids`` (an array) and ``decoded`` (the text) themselves."""
    columns = _columns(more)
    kinds = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.int32()): "array<int>"}
    schema = ", ".join(f"{n} {kinds[k]}" for n, k in columns)
    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    small = rows.where(F.length("text") <= chunk).select("id", F.col("text").cast("binary").alias("text")).mapInArrow(_small(path, more), f"id long, {schema}")
    giant = rows.where(F.length("text") > chunk).withColumn("key", F.monotonically_increasing_id())
    chunks = encode_giants(giant.select("id", "key", "text"), path, chunk, group)
    ordered = chunks.repartition(partitions_for(docs), "key").sortWithinPartitions("key", "chunk")
    return small.unionAll(ordered.mapInArrow(_joined(path, more), f"id long, {schema}"))
