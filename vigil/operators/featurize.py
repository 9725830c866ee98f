"""One-pass featurization with user-supplied extractors (OP-70).

All extractors run in a single ``mapInPandas`` pass over Arrow batches: the input is read
once and each extractor's ``init`` (load a codec, open a model) is called once per task.
The result has one fixed-length float array per modality plus ``status``/``error``. A row
whose extraction fails gets the zero vector of that modality (OP-46) and the whole reason,
so fallbacks can be counted. An extractor that may wait (``stream``: results of an iterator of values, in order) reads on
meanwhile; the batches that it read are held until all their results are there. Use this only for per-row work Spark cannot express (codecs,
external models); everything expressible is done with built-in expressions.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, islice, tee

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Extractor:
    name: str
    dim: int
    init: Callable[[], Callable[[object], object]]  # once per task; gives: one input value -> vector of length `dim`


def featurize(df: DataFrame, key: str, source: str, extractors: list[Extractor], carry: list[str] | None = None) -> DataFrame:
    """``key``, the ``carry`` columns, an array per extractor, ``status`` and ``error``."""
    names = [e.name for e in extractors]
    if len(set(names)) != len(names):
        raise ValueError("extractor names must be unique")
    kept = [key, *(carry or [])]
    schema = ", ".join([*[f"{c} {df.schema[c].dataType.simpleString()}" for c in kept],
                        *[f"{n} array<float>" for n in names], "status string", "error string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = [(e, e.init()) for e in extractors]
        held: deque[pd.DataFrame] = deque()

        def values() -> Iterator[object]:
            for pdf in batches:
                if len(pdf):
                    held.append(pdf)
                    yield from pdf[source]
        try:
            feeds = tee(values(), len(ready) or 1)
            results = [_results(extract, feed) for (_, extract), feed in zip(ready, feeds)] or [feeds[0]]
            nothing = object()
            while (first := next(results[0], nothing)) is not nothing:
                pdf, rows = held.popleft(), [chain([first], results[0]), *results[1:]]
                out = {c: pdf[c] for c in kept}
                errors: list[list[str]] = [[] for _ in range(len(pdf))]
                rows = [list(islice(r, len(pdf))) for r in rows]
                for (e, _), found in zip(ready, rows):
                    out[e.name] = [_vector(e, r, errors[i]) for i, r in enumerate(found)]
                out["status"] = ["fallback" if e else "ok" for e in errors]
                out["error"] = ["; ".join(e) or None for e in errors]
                yield pd.DataFrame(out)
        finally:
            for _, extract in ready:
                getattr(extract, "close", lambda: None)()

    return df.select(*dict.fromkeys([*kept, source])).mapInPandas(run, schema)


def _results(extract: Callable[[object], object], values: Iterator[object]) -> Iterator[tuple[bool, object]]:
    """``(True, answer)`` or ``(False, reason)`` of each value."""
    if hasattr(extract, "stream"):
        yield from extract.stream(values)
        return
    for value in values:
        try:
            found = True, extract(value)
        except Exception as exc:  # a row's failure is that row's status
            found = False, exc
        yield found


def _vector(e: Extractor, found: tuple[bool, object], errors: list[str]) -> np.ndarray:
    good, answer = found
    try:
        if not good:
            raise answer
        v = np.asarray(answer, dtype=np.float32)
        if v.shape == (e.dim,):
            return v
        errors.append(f"{e.name}: shape {v.shape} != ({e.dim},)")
    except Exception as exc:  # a row's failure is that row's status
        errors.append(f"{e.name}: {exc}")
    return np.zeros(e.dim, dtype=np.float32)


def composed_text() -> Extractor:
    """Characters of the text in Unicode composed form, which Spark has no function for."""
    def init() -> Callable[[object], object]:
        from unicodedata import normalize

        return lambda text: [len(normalize("NFC", text))]
    return Extractor("composed", 1, init)
