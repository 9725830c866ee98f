"""Chat formatting with loss masks aligned by offsets.

A turn is rendered as START role SEP text END. Control strings inside roles and texts are
escaped: a backslash doubles and ``<|`` becomes ``<\\|``, so none is left and unescaping gives
the text back. A whole conversation is encoded once, with offsets; the three marks are
special tokens, so no token reaches over the border of a text. Which tokens bear loss is
found by binary search of their offsets among the sorted spans of the assistant's texts.

Turns go to tasks by (conversation, turn // ``SEGMENT_TURNS``), so a conversation of any length is
spread, and rows are streamed: a segment closes after ``SEGMENT_CHARS`` characters, which changes
no token since special tokens part the turns. Reading back streams a conversation's
segments in order.

Null texts and roles are empty. Rows are ordered by turn (nulls first), then role, then text;
repeated rows are turns of their own. A null id is a conversation of its own. An empty table
gives an empty result. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import partitions_for, small_batches

START, SEP, END = MARKS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
SEGMENT_TURNS, SEGMENT_CHARS = 256, 1 << 20
LEARNT = "assistant"


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


@lru_cache(1)
def _tokenizer(path: str):
    """The tokenizer with the marks as special tokens, offsets untrimmed, and each id's bytes."""
    import json

    from tokenizers import Tokenizer, pre_tokenizers, processors

    t = Tokenizer.from_file(path)
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False)
    t.post_processor = processors.ByteLevel(trim_offsets=False)
    t.add_special_tokens(list(MARKS))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in a byte-level vocabulary
    rest = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(rest)}
    table = [b""] * t.get_vocab_size()
    added = {x["content"] for x in json.loads(t.to_str())["added_tokens"]}
    for token, i in t.get_vocab().items():
        table[i] = token.encode() if token in added else bytes(byte_of[c] for c in token)
    return t, table, [t.token_to_id(m) for m in MARKS]


def rendered(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The formatted text and the spans of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escaped(role)}{SEP}", escaped(text)
        if role == LEARNT and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def loss_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens' spans meet one of the sorted spans."""
    if not len(spans) or not len(offsets):
        return np.zeros(len(offsets), bool)
    at = np.searchsorted(spans[:, 0], offsets[:, 1], side="left") - 1  # the last span that begins before the token ends
    return (at >= 0) & (offsets[:, 0] < spans[np.maximum(at, 0), 1])


_OUT = (("conv_id", pa.int64()), ("segment", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("ids", pa.binary()), ("loss", pa.binary()))


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)[0]
        key, part, held, size = None, 0, [], 0
        done: list[tuple] = []

        def close():
            done.append((*key, part, held))

        def flush() -> pa.RecordBatch:
            made = [rendered(turns) for *_, turns in done]
            rows = []
            for (conv, segment, n, turns), (_, spans), e in zip(done, made, tokenizer.encode_batch([t for t, _ in made], add_special_tokens=False)):
                mask = loss_mask(np.array(e.offsets, np.int64).reshape(-1, 2), spans)
                rows.append((conv, segment, n, len(turns), np.array(e.ids, "<u4").tobytes(), np.packbits(mask).tobytes()))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _OUT)], [n for n, _ in _OUT])

        waiting = 0
        for b in batches:
            for conv, segment, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "segment", "role", "text"))):
                if held and ((conv, segment) != key or size >= SEGMENT_CHARS):
                    close()
                    part = part + 1 if (conv, segment) == key else 0
                    waiting, held, size = waiting + size, [], 0
                    if waiting >= SEGMENT_CHARS:
                        yield flush()
                        waiting = 0
                elif (conv, segment) != key:
                    part = 0
                key = (conv, segment)
                held.append((role, text))
                size += len(role) + len(text) + 40
        if held:
            close()
        if done:
            yield flush()
    return run


def format_chats(rows: DataFrame, tokenizer_path: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, segment, part, n_turns, ids, loss``: token ids (little-endian uint32) and a packed
    mask of those that bear loss; a conversation's rows in order of segment and part."""
    turn = F.col(turn_col).cast("long")
    rows = small_batches(rows).select(F.col(conv_col).cast("long").alias("conv_id"), turn.alias("turn"),
                                      F.coalesce(F.floor(turn / SEGMENT_TURNS), F.lit(-(1 << 60))).cast("long").alias("segment"),
                                      F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = rows.repartition(partitions_for(rows), "conv_id", "segment").sortWithinPartitions("conv_id", "segment", "turn", "role", "text")
    return dealt.mapInArrow(_encode(tokenizer_path), "conv_id long, segment long, part long, n_turns long, ids binary, loss binary")


class _Digest:
    def __init__(self):
        self.turns, self.loss, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0


def _read(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, table, (start, sep, end) = _tokenizer(path)
        key, now, rows = None, None, []

        def close():
            rows.append((key, now.n, now.turns.hexdigest(), now.loss_chars, now.loss.hexdigest(), now.chars))

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                              ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            for conv, ids, loss in zip(*(b.column(c).to_pylist() for c in ("conv_id", "ids", "loss"))):
                if now is None or conv != key:
                    if now is not None:
                        close()
                    key, now = conv, _Digest()
                ids = np.frombuffer(ids, "<u4")
                mask = np.unpackbits(np.frombuffer(loss, np.uint8), count=len(ids)).view(bool)
                words = [table[i] for i in ids.tolist()]
                now.chars += len(b"".join(words).decode())
                for a, m, e in zip(np.flatnonzero(ids == start).tolist(), np.flatnonzero(ids == sep).tolist(), np.flatnonzero(ids == end).tolist()):
                    role, text = (unescaped(b"".join(words[x + 1:y]).decode()) for x, y in ((a, m), (m, e)))
                    now.turns.update(f"{role}\n{text}\n".encode())
                    now.n += 1
                # what the mask holds, a run of tokens at a time
                edge = np.flatnonzero(np.diff(mask, prepend=False, append=False))
                for x, y in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    text = unescaped(b"".join(words[x:y]).decode())
                    now.loss.update(text.encode())
                    now.loss_chars += len(text)
            if len(rows) >= 1000:
                yield batch()
                rows.clear()
        if now is not None:
            close()
        if rows:
            yield batch()
    return run


def read_chats(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per conversation, read back from the token ids: ``conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars``."""
    dealt = small_batches(formatted).select("conv_id", "segment", "part", "ids", "loss").repartition(partitions_for(formatted), "conv_id")
    return dealt.sortWithinPartitions("conv_id", "segment", "part").mapInArrow(
        _read(tokenizer_path), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
