"""Token ids as wavelet matrices: one succinct file a shard, in ascending id order.

File: ``MAGIC``, six little-endian uint64 (tokens, levels, documents, and the byte sizes of the
three parts), the documents' ids and token counts (int64), then for each level, from the
highest bit down, its bits (packed, 8 a byte) and a directory of ones before every 512 bits
(uint32). A level holds one bit of every token, zeros' tokens going before ones' tokens on the
next level. So ids take as many bits as the largest needs, plus a sixteenth for ranks; access, counting and
occurrence lookup read the file itself, nothing is unpacked for them.

Texts are dealt by ranges of id and sorted; each task encodes its rows in order and closes a
shard at ``SHARD_TOKENS`` tokens, so memory is bounded whatever a range holds. A text longer
than that is a shard of its own.

A null text is empty (its only id is the end id). Rows with a null id come first; repeated
rows are documents of their own, side by side. An empty table makes no shard and an empty
result. Only the id and text columns are read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm import files
from vigil.llm.common import materialize, partitions_for, text_rows
from vigil.session import scratch_path

MAGIC, SHARD_TOKENS, CACHE_WORDS, BLOCK = b"WVMTRX01", 4 << 20, 1_000_000, 512


class WaveletMatrix:
    """Read access to one shard."""

    def __init__(self, data: bytes | memoryview):
        view = memoryview(data)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a shard of token ids")
        self.n, self.levels, self.docs, *sizes = np.frombuffer(view[8:56], "<u8").astype(int).tolist()
        at = [56, *(56 + np.cumsum(sizes)).tolist()]
        self.ids = np.frombuffer(view[at[0]:at[1]], "<i8")
        self.lengths = np.frombuffer(view[at[1]:at[2]], "<i8")
        levels = np.frombuffer(view[at[2]:at[3]], np.uint8).reshape(self.levels, -1) if self.levels else np.empty((0, 0), np.uint8)
        width = (self.n + 7) // 8
        self.planes = levels[:, :width]
        self.before = [np.frombuffer(x[width:].tobytes(), "<u4") for x in levels]  # ones before each block, and all ones at the end
        self.zeros = [self.n - int(b[-1]) for b in self.before]

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a level."""
        block = i // BLOCK
        rest = self.planes[level][block * BLOCK // 8:(i + 7) // 8]
        return int(self.before[level][block]) + int(np.unpackbits(rest)[:i - block * BLOCK].sum())

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (7 - (i & 7))) & 1

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        value = 0
        for level in range(self.levels):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value, i = value << 1 | bit, self.zeros[level] + ones if bit else i - ones
        return value

    def count(self, token: int, lo: int, hi: int) -> int:
        """How often ``token`` occurs in places ``lo`` to ``hi`` (exclusive)."""
        lo, hi = self._narrow(token, lo, hi)
        return hi - lo

    def _narrow(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> self.levels or token < 0:
            return 0, 0
        for level in range(self.levels):
            a, b = self._ones(level, lo), self._ones(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.levels - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def select(self, token: int, k: int) -> int:
        """The place of the ``k``-th occurrence (from 0) of ``token``; -1 if there are fewer."""
        lo, hi = self._narrow(token, 0, self.n)
        if not 0 <= k < hi - lo:
            return -1
        i = lo + k
        for level in range(self.levels - 1, -1, -1):
            i = self._find(level, i - self.zeros[level], 1) if token >> (self.levels - 1 - level) & 1 else self._find(level, i, 0)
        return i

    def _find(self, level: int, k: int, bit: int) -> int:
        """The place of the ``k``-th bit (from 0) of that value."""
        ones = self.before[level][:-1].astype(np.int64)
        seen = ones if bit else np.arange(len(ones)) * BLOCK - ones
        block = int(np.searchsorted(seen, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * BLOCK // 8:(block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(seen[block])])

    def decode(self) -> np.ndarray:
        """All ids in order."""
        values = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            bits = np.unpackbits(self.planes[level], count=self.n).view(bool)
            above = np.empty_like(values)
            z = self.zeros[level]
            above[np.flatnonzero(~bits)] = values[:z]
            above[np.flatnonzero(bits)] = values[z:] | values.dtype.type(1 << (self.levels - 1 - level))
            values = above
        return values


def build(ids: np.ndarray, doc_ids: list, lengths: list[int]) -> list[bytes]:
    """The parts of a shard's file."""
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 0
    now = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    body = []
    for level in range(levels):
        bits = (now & now.dtype.type(1 << (levels - 1 - level))) != 0
        packed = np.packbits(bits)
        padded = np.zeros(-(-len(packed) // 64) * 64, np.uint8)
        padded[:len(packed)] = packed
        ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        body += [packed.tobytes(), np.concatenate((np.zeros(1, "<u4"), np.cumsum(ones, dtype="<u4"))).tobytes()]
        now = np.concatenate((np.compress(~bits, now), np.compress(bits, now)))
    parts = [np.array(doc_ids, "<i8").tobytes(), np.array(lengths, "<i8").tobytes(), b"".join(body)]
    return [MAGIC, np.array([len(ids), levels, len(doc_ids), *map(len, parts)], "<u8").tobytes(), *parts]


@lru_cache(1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: letters whose lower case is known and that need no other normalising
_PLAIN = re.compile("[a-zÀ-ÖØ-öø-ÿ]+")
#: a byte-level vocabulary's sign of each byte: itself if printable, else the next free one
_FREE = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_SIGNS = {b: 256 + i for i, b in enumerate(_FREE)}
#: kinds of bytes: 0 white space, 1 ASCII letters and digits, 2 other ASCII, 3 the apostrophe, 4 beyond ASCII
_KIND = np.full(256, 2, np.uint8)
_KIND[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]] = 1
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[0x27] = 3
_KIND[128:] = 4
#: of two neighbouring kinds, those between which a piece surely ends
_CUTS = np.zeros(25, bool)
_CUTS[[1 * 5 + 2, 1 * 5 + 3, 2 * 5 + 1]] = True


# --- fixed values: the rules under which a text may be encoded piece by piece ---------
WORD_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
# --------------------------------------------------------------------------------------


class Encoder:
    """Whole texts to ids (little-endian, of type ``kind``) by a tokenizer of lower-cased words.

    The tokenizer splits at white space and between letters or digits and punctuation, so each
    distinct piece is encoded once; up to ``CACHE_WORDS`` pieces are remembered, which bounds
    memory and changes no result. Pieces of plain letters need no normalising but lower case
    and go to its model directly. Texts that might hold a special token are split at white space only.
    A file with other rules (``WORD_RULES`` says which ones allow this) gets every text whole.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        said = json.loads(self.tokenizer.to_str())
        self.by_words = ({k: said[k] for k in WORD_RULES} == WORD_RULES and said["model"]["type"] == "BPE"
                         and said["model"]["end_of_word_suffix"] is not None and all("<|" in t["content"] for t in said["added_tokens"]))
        self.model = self.tokenizer.model
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.kind = "<u4" if self.wide else "<u2"
        self.seen: dict[bytes, bytes] = {}

    def _pieces(self, texts: list[bytes]) -> list[list[bytes]]:
        """The pieces of each text."""
        buf = np.frombuffer(b"\n".join(texts), np.uint8)
        kind = _KIND[buf]
        cut = np.flatnonzero(_CUTS[kind[:-1] * 5 + kind[1:]]) + 1
        old = np.ones(len(buf) + len(cut), bool)
        old[cut + np.arange(len(cut))] = False
        spaced = np.full(len(old), 0x20, np.uint8)
        spaced[old] = buf
        return [t.split() for t in spaced.tobytes().lower().split(b"\n")]

    def _kept(self, ids: list[int]) -> bytes:
        return array("I" if self.wide else "H", ids).tobytes()

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_words:
            return [self._kept(e.ids) for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        plain = [b"<|" not in t for t in texts]
        # lines keep the texts apart, so a text's own line breaks become blanks
        pieces = iter(self._pieces([t.translate(_ONE_LINE) for t, p in zip(texts, plain) if p]) if any(plain) else [])
        split = [next(pieces) if p else t.split() for t, p in zip(texts, plain)]
        new = set().union(*split).difference(self.seen)
        if len(self.seen) + len(new) > CACHE_WORDS:
            self.seen = {}
            new = set().union(*split)
        rest = []
        for piece in new:
            word = piece.decode()
            if _PLAIN.fullmatch(word):
                if not piece.isascii():
                    word = word.lower().encode().decode("latin-1").translate(_SIGNS)
                self.seen[piece] = self._kept([t.id for t in self.model.tokenize(word)])
            else:
                rest.append(piece)
        for i in range(0, len(rest), 20_000):
            part = rest[i:i + 20_000]
            for piece, e in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)):
                self.seen[piece] = self._kept(e.ids)
        return [b"".join(map(self.seen.__getitem__, words)) for words in split]


@lru_cache(1)
def _encoder(path: str) -> Encoder:
    """One for all tasks of a worker process."""
    return Encoder(path)


_ONE_LINE = bytes(0x20 if i in (0x20, *range(0x09, 0x0E)) else i for i in range(256))


def _write(folder: str, path: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        width, end = np.dtype(encode.kind).itemsize, np.array([end_id], encode.kind).tobytes()
        ids, parts, size = [], [], 0

        def close() -> pa.RecordBatch:
            uri = files.fresh(folder, "shard", ".wvm")
            tokens = np.frombuffer(b"".join(parts), encode.kind)
            # a null id comes first and is kept as the smallest number
            files.write(uri, build(tokens, [_NULL if i is None else i for i in ids], [len(p) // width for p in parts]))
            ends = [_NULL if i is None else i for i in (ids[0], ids[-1])]
            return pa.RecordBatch.from_arrays([pa.array([uri]), *(pa.array([n], pa.int64()) for n in (*ends, len(tokens)))], ["uri", "first_id", "last_id", "n_tokens"])

        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in _slices([len(t) for t in texts]):
                for i, tokens in zip(b.column("id")[lo:hi].to_pylist(), encode(texts[lo:hi])):
                    if size and size + len(tokens) // width + 1 > shard_tokens:
                        yield close()
                        ids, parts, size = [], [], 0
                    ids.append(i)
                    parts.append(tokens + end)
                    size += len(tokens) // width + 1
        if ids:
            yield close()
    return run


_NULL = -(1 << 63)


def _slices(sizes: list[int], limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


def write(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          shard_tokens: int = SHARD_TOKENS, folder: str | None = None) -> DataFrame:
    """Write all texts; returns the kept table of shards ``uri, first_id, last_id, n_tokens, start``.

    Rows of one id, however many, are spread over tasks by their place in the input and come in any order."""
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    rows = text_rows(docs, id_col, text_col).withColumn("place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(partitions_for(docs), "id", "place").sortWithinPartitions("id", "place").drop("place")
    shards = materialize(rows.mapInArrow(_write(folder, tokenizer_path, end_id, shard_tokens), "uri string, first_id long, last_id long, n_tokens long"), "shards")
    earlier = Window.orderBy("first_id", "last_id", "uri").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for uri, start in zip(b.column("uri").to_pylist(), b.column("start").to_pylist()):
            system, path = files.opened(uri)
            with system.open_input_file(path) as f:
                shard = WaveletMatrix(f.read_buffer())
            ids = shard.decode().astype("<u4")
            ends = np.cumsum(shard.lengths)
            crc = [zlib.crc32(ids[e - n:e]) for e, n in zip(ends.tolist(), shard.lengths.tolist())]
            names = pa.array(shard.ids, mask=shard.ids == _NULL)
            yield pa.RecordBatch.from_arrays([names, pa.array(start + ends - shard.lengths), pa.array(shard.lengths), pa.array(crc, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])


def read(shards: DataFrame) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of each document, from the files."""
    spread = shards.select("uri", "start").repartition(partitions_for(shards), "uri")
    return spread.mapInArrow(_read, "id long, start long, n_tokens long, ids_crc32 long")
