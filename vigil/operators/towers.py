"""Mini-batch training of a network with one tower per modality (OP-12, OP-72, OP-73, OP-74, OP-76).

An epoch is one barrier stage over the training rows, shuffled anew by a seeded hash. Its tasks step
together: each takes its next mini-batch, computes the gradient, and the tasks add the gradients up among
themselves through files of the shared folder. Each task owns one slice of the weights: it sums that slice of all
gradients, runs AdamW on it, and all read the new slices. The driver sees a few numbers per task and epoch, never a
gradient. Rows stream through; a task holds a mini-batch, the weights and its slice of the optimizer's two moments.

The first task leaves weights, moments and step count as a file; the driver then scores the validation rows and
adds one record to the history. A run that was ended goes on after its last record and gives the
same history as one that was not: shuffles, masks and sums depend on the seed, the epoch and the
rows only. Training ends after ``patience`` epochs without a better macro-F1.

The barrier needs ``workers`` free task slots at once. A lost task restarts its epoch's stage, which
writes under a folder that the first task of each attempt names.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import storage
from vigil.config import TrainConfig
from vigil.functions.labels import decode_label, sensitive_flag
from vigil.functions.scoring import argmax, softmax


@dataclass(frozen=True)
class Preset:
    """Tower widths per block, dense layers over their concatenation, dropout before the last one;
    blocks in ``pooled`` are reduced to their mean first."""
    towers: dict[str, int]
    fused: tuple[int, ...]
    dropout: float
    pooled: tuple[str, ...] = ()


PRESETS = {
    "fusion": Preset({"frames": 256, "series": 128, "text": 128, "tokens": 64}, (256, 256), 0.5),
    "tiny": Preset({"frames": 128, "series": 128, "text": 128, "tokens": 32}, (128,), 0.2),
    "simple": Preset({"frames": 128, "series": 64, "text": 64, "tokens": 32}, (128,), 0.5, ("frames", "series")),
}


@dataclass
class Spec:
    """What turns rows into network input, and the network's shape. ``tokens`` is the block of hashed
    tokens, given as their places; every other block is an array of its fixed width."""
    preset: str
    widths: dict[str, int]
    classes: int
    mean: dict[str, list[float]] = field(default_factory=dict)
    spread: dict[str, list[float]] = field(default_factory=dict)
    idf: list[float] = field(default_factory=list)


FIRST_POLL_S, POLL_S, PATIENCE_S = 0.0002, 0.005, 900.0  # waits between looks for a file: at first, at most; until it is given up


# --- the network, in numpy -----------------------------------------------------------------------

class Net:
    """Towers (dense, ReLU) -> concatenation -> dense layers (ReLU) -> classes, over one flat vector of weights."""

    def __init__(self, spec: Spec):
        p = PRESETS[spec.preset]
        self.spec, self.preset = spec, p
        self.blocks = [b for b in p.towers if b in spec.widths]
        self.shapes: list[tuple[str, tuple[int, int]]] = [(f"tower {b}", (1 if b in p.pooled else spec.widths[b], p.towers[b])) for b in self.blocks]
        at = sum(p.towers[b] for b in self.blocks)
        for i, n in enumerate((*p.fused, spec.classes)):
            self.shapes.append((f"dense {i}", (at, n)))
            at = n
        self.size = sum((i + 1) * o for _, (i, o) in self.shapes)
        self.scale = {b: (np.array(spec.mean[b]), np.array(spec.spread[b])) for b in self.blocks if b in spec.mean}
        self.idf = np.array(spec.idf)
        self.out: np.ndarray | None = None  # if set, every gradient is written here

    def start(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        return np.concatenate([np.append(rng.uniform(-1, 1, i * o) * np.sqrt(6 / (i + o)), np.zeros(o)) for _, (i, o) in self.shapes])

    def layers(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out, at = [], 0
        for _, (i, o) in self.shapes:
            out.append((flat[at:at + i * o].reshape(i, o), flat[at + i * o:at + (i + 1) * o]))
            at += (i + 1) * o
        return out

    def inputs(self, batch: pa.RecordBatch | pa.Table) -> list[np.ndarray]:
        """A matrix per block."""
        out = []
        for b in self.blocks:
            column = batch.column(b)
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            if b == "tokens":
                width = self.spec.widths[b]
                row = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
                at, count = np.unique(row * width + column.flatten().to_numpy(), return_counts=True)
                row, place = np.divmod(at, width)
                value = count * self.idf[place]
                value /= np.maximum(np.sqrt(np.bincount(row, value * value, len(column))), 1e-12)[row]
                x = np.zeros((len(column), width))
                x[row, place] = value
            else:
                x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), self.spec.widths[b])
                x = (x - self.scale[b][0]) / self.scale[b][1]
                if b in self.preset.pooled:
                    x = x.mean(axis=1, keepdims=True)
            out.append(x)
        return out

    def _forward(self, flat: np.ndarray, x: list[np.ndarray], rng: np.random.Generator | None):
        layers, n = self.layers(flat), len(self.blocks)
        towers = [np.maximum(xb @ w + c, 0) for xb, (w, c) in zip(x, layers)]
        h = [np.concatenate(towers, axis=1)]
        for w, c in layers[n:-1]:
            h.append(np.maximum(h[-1] @ w + c, 0))
        keep = np.ones_like(h[-1]) if rng is None else (rng.random(h[-1].shape) >= self.preset.dropout) / (1 - self.preset.dropout)
        return layers, h, keep, (h[-1] * keep) @ layers[-1][0] + layers[-1][1]

    def logits(self, flat: np.ndarray, x: list[np.ndarray]) -> np.ndarray:
        return self._forward(flat, x, None)[3]

    def gradient(self, flat: np.ndarray, x: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
        """Sums over the rows of the weighted cross-entropy's gradient, and of the cross-entropy."""
        layers, h, keep, z = self._forward(flat, x, rng)
        z = z - z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        at = np.arange(len(y))
        loss = float(-(weight * np.log(np.maximum(p[at, y], 1e-300))).sum())
        d = p
        d[at, y] -= 1
        d *= weight[:, None]
        out = np.empty(self.size) if self.out is None else self.out
        slots = self.layers(out)

        def slope(i: int, below: np.ndarray, d: np.ndarray) -> None:
            np.matmul(below.T, d, out=slots[i][0])
            np.sum(d, axis=0, out=slots[i][1])
        slope(-1, h[-1] * keep, d)
        d = (d @ layers[-1][0].T) * keep
        n = len(self.blocks)
        for i in range(len(layers) - 2, n - 1, -1):
            d = d * (h[i - n + 1] > 0)
            slope(i, h[i - n], d)
            d = d @ layers[i][0].T
        d = d * (h[0] > 0)
        cuts = np.cumsum([o for _, (_, o) in self.shapes[:n]])[:-1]
        for i, (xb, db) in enumerate(zip(x, np.split(d, cuts, axis=1))):
            slope(i, xb, db)
        return out, loss


@dataclass
class State:
    """Weights and what the optimizer remembers."""
    flat: np.ndarray
    first: np.ndarray
    second: np.ndarray
    step: int = 0

    def adamw(self, grad: np.ndarray, cfg: TrainConfig) -> None:
        """One step, in place: large temporaries would cost more than the sums."""
        b1, b2 = 0.9, 0.999
        self.step += 1
        work = np.multiply(grad, 1 - b1)
        self.first *= b1
        self.first += work
        np.multiply(grad, 1 - b2, out=work)
        work *= grad
        self.second *= b2
        self.second += work
        root = np.divide(self.second, 1 - b2 ** self.step, out=work)
        np.sqrt(root, out=root)
        root += 1e-8
        rate = self.first / (1 - b1 ** self.step)
        rate /= root
        rate += np.multiply(self.flat, cfg.weight_decay, out=work)
        rate *= cfg.learning_rate
        self.flat -= rate

    def slice(self, a: int, b: int) -> State:
        """Views of a part of the weights and moments."""
        return State(self.flat[a:b], self.first[a:b], self.second[a:b], self.step)

    def bytes(self) -> bytes:
        return np.concatenate([[float(self.step)], self.flat, self.first, self.second]).astype("<f8").tobytes()

    @classmethod
    def of(cls, data: bytes) -> State:
        a = np.frombuffer(data, "<f8")
        return cls(*(x.copy() for x in a[1:].reshape(3, -1)), int(a[0]))


# --- one epoch in the tasks of a barrier stage -----------------------------------------------------

def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _put(uri: str, *data: bytes | memoryview) -> None:
    """Under its name the file is whole."""
    system, path = _open(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(f"{path}.part", compression=None) as out:
        for d in data:
            out.write(d)
    system.move(f"{path}.part", path)


def _raw(vector: np.ndarray) -> memoryview:
    """Its numbers, as they are written to files."""
    return memoryview(np.ascontiguousarray(vector, "<f8")).cast("B") if vector.size else memoryview(b"")


def _get(uri: str, start: int = 0, size: int | None = None) -> bytes:
    system, path = _open(uri)
    with system.open_input_file(path) as f:
        f.seek(start)
        return f.read(size)


class FileSum:
    """Sums of vectors over the tasks of a barrier stage, by way of files in a shared folder; each task sums, and keeps
    the weights of, the slice ``own``.

    The barrier has all tasks run at once; within a step they wait for each other's files, since a call of Spark's
    own barrier takes a second. If a task is lost, Spark ends the others of its stage."""

    def __init__(self, ctx: BarrierTaskContext, folder: str, size: int):
        self.rank, self.world = ctx.partitionId(), len(ctx.getTaskInfos())
        self.folder, self.step, self.old = f"{folder}-{ctx.allGather(uuid.uuid4().hex)[0]}", 0, []  # the first task names the attempt
        self.cuts = [size * i // self.world for i in range(self.world + 1)]
        self.own = self.cuts[self.rank], self.cuts[self.rank + 1]

    def _names(self, what: str) -> list[str]:
        return [f"{self.folder}/{self.step}/{what}-{r}" for r in range(self.world)]

    def _wait(self, uri: str) -> None:
        (system, path), end, pause = _open(uri), time.monotonic() + PATIENCE_S, FIRST_POLL_S
        while system.get_file_info(path).type == fs.FileType.NotFound:
            if time.monotonic() > end:
                raise TimeoutError(f"no {path} after {PATIENCE_S} s")
            time.sleep(pause)
            pause = min(POLL_S, 1.1 * pause)

    def _part(self, r: int, uri: str) -> tuple[int, float, np.ndarray | None]:
        """Rows, loss and the own slice of what task ``r`` gave; its file is without its own slice."""
        self._wait(uri)
        system, path = _open(uri)
        a, b = self.own
        at = a if a < self.cuts[r] else a - (self.cuts[r + 1] - self.cuts[r])
        with system.open_input_file(path) as f:
            rows, loss = np.frombuffer(f.read_at(16, 0), "<f8")
            return int(rows), float(loss), np.frombuffer(f.read_at((b - a) * 8, 16 + at * 8), "<f8") if rows else None

    def __call__(self, vector: np.ndarray | None, rows: int, loss: float) -> tuple[np.ndarray, int, float]:
        """The own slice of the sum, and rows and loss of all tasks; without rows there is no vector."""
        parts, (a, b) = self._names("part"), self.own
        _put(parts[self.rank], np.array([rows, loss], "<f8").tobytes(), *([_raw(vector[:a]), _raw(vector[b:])] if rows else []))
        got = [(rows, loss, vector[a:b] if rows else None) if r == self.rank else self._part(r, u) for r, u in enumerate(parts)]
        self._forget()  # every task has begun this step, so it has read what the step before left
        self.old = [parts[self.rank]]
        share = np.zeros(b - a)
        for _, _, given in got:
            if given is not None:
                share += given
        return share, sum(g[0] for g in got), float(sum(g[1] for g in got))

    def spread(self, vector: np.ndarray) -> None:
        """Give the own slice of ``vector`` to the others and fill in theirs; ends the step."""
        names, (a, b) = self._names("slice"), self.own
        _put(names[self.rank], _raw(vector[a:b]))
        self.old.append(names[self.rank])
        for r, uri in enumerate(names):
            if r != self.rank:
                self._wait(uri)
                vector[self.cuts[r]:self.cuts[r + 1]] = np.frombuffer(_get(uri), "<f8")
        self.step += 1

    def to_first(self, vectors: list[np.ndarray]) -> None:
        """Fill in ``vectors`` of the first task from the own slices of all."""
        names, (a, b) = self._names("last"), self.own
        if self.rank:
            _put(names[self.rank], *(_raw(v[a:b]) for v in vectors))
            return
        for r, uri in list(enumerate(names))[1:]:
            self._wait(uri)
            for v, given in zip(vectors, np.frombuffer(_get(uri), "<f8").reshape(len(vectors), -1)):
                v[self.cuts[r]:self.cuts[r + 1]] = given

    def _forget(self) -> None:
        for uri in self.old:
            system, path = _open(uri)
            system.delete_file(path)
        self.old = []


def mini_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for b in batches:
        while b.num_rows:
            take = b.slice(0, rows - size)
            held.append(take)
            size, b = size + take.num_rows, b.slice(take.num_rows)
            if size == rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def part_gradient(net: Net, flat: np.ndarray, part: pa.Table | None, seed: tuple[int, ...]) -> tuple[np.ndarray, int, float]:
    """One task's share of a step: gradient, rows, loss; zeros once its rows have run out."""
    if part is None:
        return np.zeros(net.size), 0, 0.0
    y, weight = part.column("label").to_numpy().astype(np.int64), part.column("weight").to_numpy()
    grad, loss = net.gradient(flat, net.inputs(part), y, weight, np.random.default_rng(seed))
    return grad, len(y), loss


def _epoch(spec: Spec, cfg: TrainConfig, epoch: int, given: str | None, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx, net = BarrierTaskContext.get(), Net(spec)
        state = State.of(_get(given)) if given else State(net.start(cfg.seed), np.zeros(net.size), np.zeros(net.size))
        add = FileSum(ctx, f"{folder}/sums-{epoch}", net.size)
        net.out = np.empty(net.size)
        own = state.slice(*add.own)
        parts, seen, lost = mini_batches(batches, cfg.batch_rows), 0, 0.0
        while True:
            share = part_gradient(net, state.flat, next(parts, None), (cfg.seed, epoch, own.step, add.rank))
            grad, rows, loss = add(*share)
            if not rows:
                break
            grad /= rows
            own.adamw(grad, cfg)
            add.spread(state.flat)
            seen, lost = seen + rows, lost + loss
        uri = f"{folder}/state-{epoch}-{uuid.uuid4().hex}"
        add.to_first([state.first, state.second])
        state.step = own.step
        if add.rank == 0:
            _put(uri, state.bytes())
            yield pa.RecordBatch.from_pylist([{"uri": uri, "rows": seen, "loss": lost}])
    return run


def shuffled(train: DataFrame, key: str, workers: int, seed: int, epoch: int) -> DataFrame:
    """The rows dealt to the workers and put in order by a hash of key, seed and epoch."""
    by = F.xxhash64(F.col(key), F.lit(seed), F.lit(epoch))
    return train.withColumn("__by", by).repartition(workers, "__by").sortWithinPartitions("__by", key).drop("__by", key)


# --- training, scoring -----------------------------------------------------------------------------

@dataclass
class Fitted:
    spec: Spec
    uri: str  # of the best state
    history: list[dict]


def describe(train: DataFrame, preset: str, widths: dict[str, int], classes: int) -> Spec:
    """Means and spreads of the blocks and the tokens' weights, from the training rows: aggregates of one row per place."""
    spec = Spec(preset, widths, classes)
    n = train.count()
    for b, width in widths.items():
        if b == "tokens":
            seen = train.select(F.explode(F.array_distinct(b)).alias("place")).groupBy("place").agg(F.count("*").alias("n"))
            spec.idf = [float(np.log(n + 1))] * width
            for r in seen.collect():  # at most `width` rows
                spec.idf[r.place] = float(np.log((n + 1) / (r.n + 1)))
        else:
            got = {r.at: r for r in train.select(F.posexplode(b).alias("at", "x")).groupBy("at").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).collect()}
            spec.mean[b] = [float(got[i].m) if i in got else 0.0 for i in range(width)]
            spec.spread[b] = [float(got[i].s) or 1.0 if i in got else 1.0 for i in range(width)]
    return spec


def weighted(train: DataFrame) -> DataFrame:
    """Adds ``weight``: rows of rare classes count as much as those of common ones."""
    counts = {r[0]: r[1] for r in train.groupBy("label").count().collect()}  # one row a class
    total = sum(counts.values())
    weight = F.lit(1.0)
    for c, n in counts.items():
        weight = F.when(F.col("label") == c, total / (len(counts) * n)).otherwise(weight)
    return train.withColumn("weight", weight)


def _logits(spec: Spec, uri: str, carry: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Net(spec)
        flat = np.frombuffer(_get(uri, 8, net.size * 8), "<f8")  # after the step count
        for b in batches:
            for part in mini_batches(iter([b]), 256):
                z = net.logits(flat, net.inputs(part))
                yield pa.RecordBatch.from_arrays([*(part.column(c).combine_chunks() for c in carry), pa.array(z.tolist(), pa.list_(pa.float64()))], [*carry, "logits"])
    return run


def logits(rows: DataFrame, spec: Spec, uri: str, carry: tuple[str, ...]) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*carry).schema.fields)
    return rows.select(*carry, *(c for c in spec.widths if c not in carry)).mapInArrow(_logits(spec, uri, carry), f"{schema}, logits array<double>")


def score(rows: DataFrame, fitted: Fitted, names: list[str], carry: tuple[str, ...]) -> DataFrame:
    label = decode_label("prediction", names)
    return (logits(rows, fitted.spec, fitted.uri, carry).withColumn("prediction", argmax("logits"))
            .select(*carry, "prediction", label.alias("predicted_label"), sensitive_flag(label).alias("sensitive"),
                    F.array_max(softmax("logits")).alias("confidence")))


def evaluate(rows: DataFrame, spec: Spec, uri: str) -> dict[str, float]:
    """Mean log loss, accuracy and macro-F1 (a class never met on either side counts nothing, one never predicted 0) of labelled rows."""
    scored = logits(rows, spec, uri, ("label",)).select("label", argmax("logits").alias("prediction"), F.get(softmax("logits"), F.col("label")).alias("p"))
    met = scored.groupBy("label", "prediction").agg(F.count("*").alias("n"), F.sum(-F.log(F.greatest("p", F.lit(1e-15)))).alias("loss")).collect()  # classes squared
    n = sum(r.n for r in met)
    hits = {r.label: r.n for r in met if r.label == r.prediction}
    sides = [(sum(r.n for r in met if r.label == c), sum(r.n for r in met if r.prediction == c), hits.get(c, 0)) for c in {x for r in met for x in (r.label, r.prediction)}]
    f1 = sum(2 * hit / (actual + said) for actual, said, hit in sides) / max(len(sides), 1)
    return {"val_log_loss": sum(r.loss for r in met) / n if n else float("inf"), "val_accuracy": sum(hits.values()) / max(n, 1), "val_macro_f1": f1}


def _records(spark: SparkSession, folder: str) -> list[dict]:
    """The history as far as it was written."""
    out = []
    while (said := storage.read_text(spark, f"{folder}/history/{len(out):06d}.json")) is not None:
        out.append(json.loads(said))
    return out


def fit(train: DataFrame, val: DataFrame, key: str, spec: Spec, cfg: TrainConfig, folder: str) -> Fitted:
    """Train in ``folder``, or go on where a run in it ended. Rows hold ``key``, ``label`` (int), the blocks, and ``weight`` for training."""
    spark = train.sparkSession
    if not storage.create_exclusive(spark, f"{folder}/spec.json", json.dumps(asdict(spec))):
        spec = Spec(**json.loads(storage.read_text(spark, f"{folder}/spec.json")))
    columns = ["label", "weight", *spec.widths]
    history = _records(spark, folder)
    for epoch in range(len(history), cfg.max_rounds):
        best = max((h["val_macro_f1"] for h in history), default=-1.0)
        waited = len(history) - 1 - max((i for i, h in enumerate(history) if h["improved"]), default=-1)
        if waited >= cfg.patience:
            break
        rows = shuffled(train.select(key, *columns), key, cfg.workers, cfg.seed, epoch)
        given = history[-1]["uri"] if history else None
        ran = rows.mapInArrow(_epoch(spec, cfg, epoch, given, folder), "uri string, rows long, loss double", barrier=True)
        # one row; behind an exchange, as Spark restarts a barrier stage only if it isn't the job's last
        done = ran.agg(F.max("uri").alias("uri"), F.max("rows").alias("rows"), F.max("loss").alias("loss")).first()
        record = {"epoch": epoch, "train_loss": done.loss / max(done.rows, 1), **evaluate(val, spec, done.uri), "uri": done.uri}
        record["improved"] = record["val_macro_f1"] > best
        history.append(record)
        storage.create_exclusive(spark, f"{folder}/history/{epoch:06d}.json", json.dumps(record))
    return Fitted(spec, [h for h in history if h["improved"]][-1]["uri"], history)


def load(spark: SparkSession, folder: str) -> Fitted:
    """The best state of a training (OP-12), with its history."""
    said, history = storage.read_text(spark, f"{folder}/spec.json"), _records(spark, folder)
    if said is None or not history:
        raise FileNotFoundError(f"no trained model in {folder}")
    return Fitted(Spec(**json.loads(said)), [h for h in history if h["improved"]][-1]["uri"], history)
