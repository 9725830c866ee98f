"""Personal data by candidate gradient boosting.

Generators propose spans with high recall, overlaps allowed: the strict base kinds and looser
forms (written-out e-mail addresses, national phone numbers, digit groups, account numbers,
secrets). Boosted trees (``GBTClassifier``) judge each candidate by its format and context;
a threshold calibrated for precision on rows held out of the fit selects what is redacted.

Nobody labelled spans here, so labels are distant: in every document a candidate is positive if its
kind's checks (digit counts, Luhn, octets, mod 97) hold, and each positive is repeated with one digit or
domain spoiled as a negative. Equal examples of a part (fitted, held out) become one weighted row before the
trees are fitted. The trees go to the tasks as small arrays; finding candidates and scanning are a pass each
over whole texts.

Base spans are exact and always stay. Method spans never overlap base spans or each other
(the higher score stays, then the earlier).

A null text is empty and has no spans. Null ids are kept, and fitted like others. Repeated rows
give repeated results. Without candidates or with one class only nothing is added to the
base. An empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import materialize, text_rows

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
PRECISION, TREES, DEPTH = 0.98, 12, 4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# loose forms
_SPOKEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?(?:[\[(]\s?at\s?[\])]|\sat\s)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:[\[(]\s?dot\s?[\])]|\sdot\s|\.)\s?[A-Za-z0-9-]{2,63}){1,4}", re.I)
_NATIONAL = re.compile(r"(?<![0-9+])(?:\([0-9]{2,5}\)[ ]?|0[0-9]{2,5}[ /-])?[0-9]{3,4}[ .-][0-9]{3,4}(?:[ .-][0-9]{2,4})?(?![0-9])")
_DIGITS = re.compile(r"(?<![0-9])[0-9](?:[ .-]?[0-9]){10,18}(?![0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,4})?(?![A-Z0-9])")
_VALUE = re.compile(r"[=:]\s{0,3}[\"']?([A-Za-z0-9_/+.-]{8,})")
_WINDOW = 300  # characters of a span that the features look into
_AT = re.compile(r"[ \[(]at[ \])]", re.I)
_HINT = re.compile(r"(phone|tel|call|mobile|fax)|(card|visa|pay|credit)|(host|server|addr|\bip\b)|(mail|contact|write)|(token|passw|secret|key|auth|credential)|(iban|account|bank)|(ssn|social)", re.I)


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _octets(s: str) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in s.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses in linear time: each @ with the longest local part before it."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        free = found.end() if found else at + 1
        if found:
            yield begin, found.end()
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the strict kinds, sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    if _ANY_DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m[0])]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


_ANY_DIGIT = re.compile("[0-9]")


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates of high recall; they may overlap each other and base spans."""
    out = []
    if _AT.search(text):
        out += [(m.start(), 0, m.end()) for m in _SPOKEN.finditer(text)]
    if _ANY_DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)]
        out += [(m.start(), 2, m.end()) for m in _DIGITS.finditer(text)]
        out += [(m.start(), 3, m.end()) for m in _NATIONAL.finditer(text)]
        out += [(m.start(), 4, m.end()) for m in _IBAN.finditer(text)]
        out += [(m.start(), 5, m.end()) for m in _SSN.finditer(text)]
    if "=" in text or ":" in text:
        out += [(m.start(1), 6, m.end(1)) for m in _VALUE.finditer(text)]
    return out


def _entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def checked(kind: int, s: str, before: str) -> bool:
    """The distant label: whether what its kind asks for holds."""
    digits = re.sub("[^0-9]", "", s)
    if kind == 0:
        return bool(re.search(r"(?:@|\bat\b).*(?:\.|\bdot\b)", s, re.I | re.S)) and bool(re.search("[A-Za-z]{2}$", s)) and ("@" in s or bool(re.search(r"[\[(]|\bdot\b", s, re.I)))
    if kind == 1:
        return _octets(s) if re.fullmatch(r"[0-9.]+", s) else False
    if kind == 2:
        return 12 <= len(digits) <= 19 and _luhn(digits) and len(set(digits)) > 1
    if kind == 3:
        return 9 <= len(digits) <= 15 and (s[0] in "+(0" or bool(m := _HINT.search(before)) and bool(m[1]))
    if kind == 4:
        t = s.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1
    if kind == 5:
        return s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000"
    return any(m[5] for m in _HINT.finditer(before)) and _entropy(s) >= 2.5


def features(kind: int, s: str, before: str, after: str) -> list[float]:
    length, s = len(s), s[:_WINDOW]
    digits = [c for c in s if "0" <= c <= "9"]
    hints = [0.0] * 7
    for m in _HINT.finditer(before):
        hints[m.lastindex - 1] = 1.0
    parts = re.findall("[0-9]+", s)[:8]
    joined = "".join(digits)
    return [float(kind == k) for k in range(len(KINDS))] + hints + [
        float(length), float(len(digits)), len(digits) / len(s), float(len(parts)),
        float(max((len(p) for p in parts), default=0)), max((min(float(p[:9]), 1e6) for p in parts), default=0.0),
        float(len(digits) > 1 and len(digits) < 40 and _luhn(joined)), float(len(set(s))), _entropy(s),
        float(s[0] in "+("), float("@" in s), float(s[0] == "0"), float(sum(c.isupper() for c in s)), float(sum(c in " -.()" for c in s)),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float("." in s[-5:-1]), float("at" in s.lower() and "dot" in s.lower()),
        float(int("".join(str(int(c, 36)) for c in s[4:].replace(" ", "") + s[:4])) % 97 == 1) if kind == 4 else 0.0]


def _around(text: str, a: int, b: int) -> tuple[str, str, str]:
    return text[a:b], text[max(0, a - 32):a], text[b:b + 8]


def _spoiled(kind: int, s: str) -> str:
    """A near miss of a positive: one digit moved on, or the domain's dot lost."""
    if kind == 0:
        return re.sub(r"\.|\bdot\b", "", s, flags=re.I)
    if kind == 1:
        return re.sub("[0-9]+", "931", s, count=1)
    if kind == 3:
        return s[:len(s) // 2]
    if kind == 6:
        return s[:1] * len(s)
    if kind == 5:
        return "000" + s[3:]
    at = max(i for i, c in enumerate(s) if c.isdigit())
    return s[:at] + str((int(s[at]) + 1) % 10) + s[at + 1:]


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, labels, rows = [], [], []
        for i, raw in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
            text = raw.decode()
            for a, kind, e in sorted(set(base_spans(text) + loose_spans(text))):
                s, before, after = _around(text, a, e)
                good = checked(kind, s, before)
                for t, label in [(s, good)] + [(_spoiled(kind, s), False)] * good:
                    if t and (not label or good):
                        ids.append(i)
                        labels.append(float(label and checked(kind, t, before)))
                        rows.append(features(kind, t, before, after))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.float64()), pa.array(rows, pa.list_(pa.float64()))], ["id", "label", "x"])


@dataclass(frozen=True)
class Model:
    """Trees as arrays: the feature asked (-1: a leaf), its bound, children, value times the tree's weight."""
    feature: np.ndarray
    bound: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    threshold: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(DEPTH):
                ask = np.maximum(self.feature[at], 0)
                down = np.where(x[np.arange(len(x)), ask] <= self.bound[at], self.left[at], self.right[at])
                at = np.where(self.feature[at] < 0, at, down)
            total += self.value[at]
        return 1 / (1 + np.exp(-2 * total))


def _exported(fit, threshold: float) -> Model:
    feature, bound, left, right, value, roots = [], [], [], [], [], []

    def add(node, weight: float) -> int:
        at = len(feature)
        for column, v in ((feature, -1), (bound, 0.0), (left, at), (right, at), (value, 0.0)):
            column.append(v)
        if node.subtreeDepth() == 0:
            value[at] = weight * node.prediction()
        else:
            feature[at], bound[at] = node.split().featureIndex(), node.split().threshold()
            left[at], right[at] = add(node.leftChild(), weight), add(node.rightChild(), weight)
        return at

    for tree, weight in zip(fit.trees, fit.treeWeights):
        roots.append(add(tree._java_obj.rootNode(), weight))
    return Model(*(np.array(x) for x in (feature, bound, left, right, value, roots)), threshold)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Trees fitted on the candidates of four fifths of the documents, the threshold set on those of the others."""
    # here and not above: tasks that only scan needn't load them
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = text_rows(docs, id_col, text_col)
    data = rows.mapInArrow(_examples, "id long, label double, x array<double>")
    held = F.coalesce(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(5)) == 0, F.lit(False))
    data = data.groupBy(held.alias("held"), "label", "x").agg(F.count("*").cast("double").alias("n"))
    # in an order of its own: the fit draws its bounds by the place of a row
    data = materialize(data.orderBy("held", "label", "x"), "candidates")
    seen = {(r.held, r.label): r["count"] for r in data.groupBy("held", "label").count().collect()}
    if not all(seen.get(k) for k in ((False, 0.0), (False, 1.0), (True, 0.0), (True, 1.0))):
        return None
    vectors = data.select("label", "held", "n", array_to_vector("x").alias("features"))
    fit = GBTClassifier(weightCol="n", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1, maxBins=32).fit(vectors.where("not held"))
    judged = fit.transform(vectors.where("held")).select("label", "n", F.round(vector_to_array("probability")[1], 2).alias("p"))
    levels = sorted(judged.groupBy("p").agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect(), key=lambda r: -r.p)
    good = total = 0.0
    threshold = 1.01
    for r in levels:  # at most 101 levels
        good, total = good + r.good, total + r.n
        if r.p >= 0.5 and good >= PRECISION * total:
            threshold = r.p - 0.005
    return _exported(fit, threshold)


def find_spans(text: str, model: Model | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and added spans of one text, each ``(start, kind number, end)``."""
    base = base_spans(text)
    loose = sorted(set(loose_spans(text)) - set(base)) if model else []
    free = []
    if loose and base:
        starts = np.array([a for a, _, _ in base])
        most = np.maximum.accumulate([e for _, _, e in base])
        for c in loose:  # the base spans that begin before it ends, and how far they reach
            n = np.searchsorted(starts, c[2])
            if not n or most[n - 1] <= c[0]:
                free.append(c)
    else:
        free = loose
    if not free:
        return base, []
    p = model.probability(np.array([features(k, *_around(text, a, e)) for a, k, e in free]))
    taken: list[tuple[int, int, int]] = []
    for i in sorted(np.flatnonzero(p >= model.threshold), key=lambda i: (-p[i], free[i])):
        a, k, e = free[i]
        at = bisect(taken, (a, k, e))
        if (not at or taken[at - 1][2] <= a) and (at == len(taken) or taken[at][0] >= e):
            taken.insert(at, (a, k, e))
    return base, taken


def _scan(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for raw in b.column("text").to_pylist():
                base, more = find_spans(raw.decode(), model)
                out.append([{"start": a, "kind": k, "end": e, "base": True} for a, k, e in base]
                           + [{"start": a, "kind": k, "end": e, "base": False} for a, k, e in more])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, kind)], ["id", "found"])
    return run


def scan(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, found``: the spans of each row, sorted by start, kind number and end."""
    rows = text_rows(docs, id_col, text_col)
    found = rows.mapInArrow(_scan(model), "id long, found array<struct<start:int,kind:int,end:int,base:boolean>>")
    return found.withColumn("found", F.array_sort("found"))


def written(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _redact(model: Model | None, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column(column).to_pylist():
                if text:
                    base, more = find_spans(text, model)
                    parts, at = [], 0
                    for a, k, e in sorted(base + more):
                        if a >= at:
                            parts += [text[at:a], f"<{KINDS[k].upper()}>"]
                        at = max(at, e)
                    text = "".join([*parts, text[at:]])
                out.append(text)
            yield b.set_column(column, b.schema.field(column), pa.array(out, b.schema.field(column).type))
    return run


def redact(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with each span of the text replaced by its kind; a null text stays null."""
    text_rows(docs, text_col, text_col)  # bounds the batches
    return docs.mapInArrow(_redact(model, docs.columns.index(text_col)), docs.schema)
